"""Spelling variants by asymmetric q-chunks.

Of two words that differ by one edit the shorter (or equally long) one contributes
two disjoint chunks, its first and its last half, and the other one its positional
grams of that size.  One edit cannot touch both chunks, so one of them is
among the grams, at most one place further right.  As half of a short word is
common to many words, the rest of the two words is treated in the same way: it
differs by the same edit, so of its two disjoint chunks, too, one is kept.  Three
quarters of a word are thus the key under which it meets another, and only
pairs that the comparison of the whole words confirms leave the join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import lower_ascii, table, workspace

#: Code points of the shortest word.
SHORTEST = 6
MIN_COUNT = 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: One of so many runs loses a letter, chosen by the checksum of its document and itself.
NOISE = 199

_RUN = r"[a-zÀ-ÿ]{%d,}"


def noisy_words(documents: DataFrame, shortest: int = SHORTEST, least: int = MIN_COUNT) -> DataFrame:
    """word, n: runs of letters, some of them without one letter, of ``shortest`` code points and ``least`` occurrences."""
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(_RUN % shortest), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.char_length("run")))
    found = runs.withColumn("h", h).select(F.when(F.col("h") % NOISE == 0, cut).otherwise(F.col("run")).alias("word"))
    return found.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _keys(word: Column, longer: Column, size: Column) -> Column:
    """What words of ``size`` letters and words ``longer`` than that by 0 or 1 have in common if one edit lies between them.

    A chunk at the left is kept at its place, a chunk at the right is shifted by the letter that the word is longer.  The
    shorter word has its chunks there, the other one the grams that can be equal to them.
    """
    half = F.floor(size / 2).cast("int")
    piece = lambda text, begin, length: F.substring(text, begin, length)
    rest_size = size - half
    first = F.floor(rest_size / 2).cast("int")
    keys = []
    for side, chunk, rest in (
        ("left", piece(word, F.lit(1), half), piece(word, half + 1, rest_size + longer)),
        ("right", piece(word, size - half + 1 + longer, half), piece(word, F.lit(1), rest_size + longer)),
    ):
        for inner, kept in (("left", piece(rest, F.lit(1), first)), ("right", piece(rest, first + 1 + longer, rest_size - first))):
            keys.append(F.struct(size.alias("size"), F.lit(f"{side} {inner}").alias("place"), F.concat(chunk, F.lit(" "), kept).alias("text")))
    return F.array(*keys)


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: both directions of every pair of distinct words that one edit separates (a code point inserted, deleted or replaced).

    ``words`` (word, n) has a row for each word; words of fewer than three code points have no halves to meet by and are
    left out.
    """
    sized = words.withColumn("size", F.char_length("word")).where("size > 2")
    chunks = sized.select("word", "n", F.col("size").alias("own"), F.explode(_keys(F.col("word"), F.lit(0), F.col("size"))).alias("key"))
    grams = sized.select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("size").alias("near_own"),
        F.explode(F.concat(_keys(F.col("word"), F.lit(0), F.col("size")), _keys(F.col("word"), F.lit(1), F.col("size") - 1))).alias("near_key"))
    # The comparison stands in the join, so pairs that only share a key are never written.
    pairs = chunks.join(
        grams, (F.col("key") == F.col("near_key")) & ((F.col("near_own") > F.col("own")) | (F.col("word") < F.col("near")))
        & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n").distinct()
    pairs = workspace(words).stage(pairs, "pairs")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def spelling_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; one row for each word).

    form is the near word of largest n (ties: the smallest by code points) if that is at least ``ratio`` (2 or more)
    times the word's; root is where the forms lead to.  Counts grow along a chain, so chains end and are
    short; a round of joins halves what is left of them.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    work = workspace(words)
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    formed = work.stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.form")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")), "formed")
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for k in range(64):
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = work.stage(roots.join(above, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{k}")
        roots = new.select("word", "root")
        if new.where("moved").isEmpty():
            break
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, shortest: int = SHORTEST, least: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """The forms and roots of all words of the texts; one row for each word.

    Null texts and texts without runs of letters add nothing; a null doc_id counts as an empty one in the checksum.  Repeated rows count
    each time.  An empty table gives no rows.  Only doc_id and text are read.
    """
    words = workspace(documents).stage(noisy_words(documents, shortest, least), "words")
    return spelling_forms(words, ratio)


def op12_qchunk_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
