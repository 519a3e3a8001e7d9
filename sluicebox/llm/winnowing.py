"""Benchmark decontamination by winnowing.

Of the hashes of all K-word grams in every W consecutive grams the least is
kept.  Two texts that share K + W - 1 words share a whole window of grams and
so its least hash: every shared span of that length is found.  Kept hashes of
documents and benchmark items meet in a join; around a hit the spans of WINDOW
words are compared word for word.  DataFrame functions only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import lower_ascii, table, workspace

#: What stands between words, after A-Z were lower-cased and before; splitting there is far cheaper than extracting words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
GRAM = 7


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def count_words(text: Column) -> Column:
    """How many words a text has; its letters need no lower case for that."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_ANY_CASE), "")).cast("long")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row, also where ``use`` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(count: Column, length: int) -> Column:
    """0 .. count - length, empty if there are fewer."""
    return F.when(count >= length, F.sequence(F.lit(0), count - length)).otherwise(F.array().cast("array<int>"))


def _joined(values: Column, shift: int, join) -> Column:
    """``join`` of each value with the one ``shift`` places on."""
    return let(values, lambda v: F.transform(_starts(F.size(v), shift + 1), lambda i: join(F.get(v, i), F.get(v, i + shift))))


def gram_hashes(words: Column, length: int) -> Column:
    """A hash of every ``length`` consecutive words: words are hashed once, runs of 2, 4, ... of them from two halves."""
    def runs(values: Column, size: int, parts: list[tuple[Column, int]]) -> Column:
        # parts: the runs that make up the gram, from its end, and where they begin in it
        used = sum(n for _, n in parts)
        if length // size % 2:
            parts = [*parts, (values, size)]
            used += size
        if used == length:
            offsets, at = [], length
            for run, n in parts:
                at -= n
                offsets.append((run, at))
            return F.transform(_starts(F.size(values) + size - 1, length), lambda i: F.xxhash64(*[F.get(run, i + at) for run, at in reversed(offsets)]))
        return let(_joined(values, size, F.xxhash64), lambda longer: runs(longer, 2 * size, parts))
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: runs(hashes, 1, []))


def fingerprints(hashes: Column, window: int) -> Column:
    """Least hash of every ``window`` consecutive ones, each once."""
    width = 1
    while width < window:
        shift = min(width, window - width)
        hashes, width = _joined(hashes, shift, F.least), width + shift
    return F.array_distinct(hashes)


def _spans(words: Column, length: int) -> Column:
    return let(words, lambda w: F.transform(_starts(F.size(w), length), lambda i: F.struct(
        i.alias("start"), F.array_join(F.slice(w, i + 1, length), " ").alias("span"))))


def row_key() -> Column:
    """Names a row by its doc_id and its text; never null.  Rows with one key have one text and so the same hits."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))


def hit_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """row, start, length, item_id: every place of a text where an item's window stands; row is the text's ``row_key``.

    Items with fewer words than ``window`` are one window each; their whole
    word sequence is their fingerprint.
    """
    work = workspace(documents)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    items = items.withColumn("n", F.size("words")).where("n > 0")
    items = work.stage(items.withColumn("length", F.least("n", F.lit(window))), "items")
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())

    pieces, spans = [], []
    for length in lengths:
        own = items.where(F.col("length") == length)
        kept = (fingerprints(gram_hashes(F.col("words"), gram), window - gram + 1) if length == window
                else gram_hashes(F.col("words"), length))
        pieces.append(own.select(F.lit(length).alias("length"), F.explode(kept).alias("fp")))
        spans.append(own.select("item_id", F.lit(length).alias("length"), F.explode(_spans(F.col("words"), length)).alias("s"))
                     .select("item_id", "length", F.col("s.span").alias("span")))
    if not lengths:
        return documents.select(row_key().alias("row"), F.lit(0).alias("start"), F.lit(0).alias("length"),
                                F.lit("").alias("item_id")).where(F.lit(False))

    def union(frames):
        first, *rest = frames
        for frame in rest:
            first = first.unionByName(frame)
        return first.distinct()

    # Written first, so that the join is planned by their real sizes.
    item_prints = work.stage(union(pieces), "item_prints")
    item_spans = work.stage(union(spans), "item_spans")

    def doc_prints(words, length):
        kept = (fingerprints(gram_hashes(words, gram), window - gram + 1) if length == window
                else F.array_distinct(gram_hashes(words, length)))
        return F.transform(kept, lambda fp: F.struct(F.lit(length).alias("length"), fp.alias("fp")))

    prints = documents.select(row_key().alias("row"), F.explode(let(words_of(F.col("text")), lambda words: F.concat(
        *[doc_prints(words, n) for n in lengths]))).alias("p")).select("row", "p.length", "p.fp")
    met = prints.join(item_prints, ["length", "fp"]).groupBy("row").agg(
        F.collect_set(F.struct("length", "fp")).alias("met"))
    met = work.stage(met, "met")

    near = documents.select(row_key().alias("row"), "text").join(met, "row")

    def near_spans(words, hashes, length):
        """Spans that hold a gram whose hash met an item's."""
        if length < window:
            return let(gram_hashes(words, length), lambda grams: F.filter(
                _spans(words, length), lambda s: F.array_contains(hashes, F.get(grams, s["start"]))))
        places = F.filter(
            F.transform(gram_hashes(words, gram), lambda h, i: F.when(F.array_contains(hashes, h), i)),
            lambda i: i.isNotNull())
        starts = F.when(F.size(words) >= window, F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(
            F.greatest(F.least(p, F.size(words) - window) - (window - gram), F.lit(0)), F.least(p, F.size(words) - window))))))
        return F.transform(starts, lambda i: F.struct(
            i.alias("start"), F.array_join(F.slice(words, i + 1, window), " ").alias("span")))

    def of_length(length):
        mine = F.transform(F.filter("met", lambda m: m["length"] == length), lambda m: m["fp"])
        return near.select("row", F.lit(length).alias("length"), F.explode(
            let(mine, lambda hashes: F.when(F.size(hashes) > 0, let(
                words_of(F.col("text")), lambda words: near_spans(words, hashes, length))))).alias("s"))

    found = [of_length(n) for n in lengths]
    all_found = found[0]
    for frame in found[1:]:
        all_found = all_found.unionByName(frame)
    return all_found.select("row", "length", "s.start", "s.span").join(item_spans, ["length", "span"]).select(
        "row", "start", "length", "item_id").distinct()


def _contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contamination`` with each row's ``row_key`` as row."""
    work = workspace(documents)
    hits = work.stage(hit_spans(documents, benchmark), "hits")
    hit_words = (
        hits.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("word"))
        .distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    )
    hit_items = hits.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = work.stage(hit_words.join(hit_items, "row"), "found")
    counted = documents.select(row_key().alias("row"), "doc_id", count_words(F.col("text")).alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(found, "row", "left").select(
        "row", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    One row per input row.  Null and empty texts have no words and no hits.
    Rows without a doc_id and rows that repeat one are documents of their own.  Repeated items count once; items without words never occur.  Empty
    tables give no rows or no hits.  Other columns are not read.
    """
    return _contamination(documents, benchmark).drop("row")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns."""
    bad = _contamination(documents, benchmark).where("contaminated").select(F.col("row").alias("_bad")).distinct()
    return documents.join(workspace(documents).stage(bad, "contaminated"), row_key() == F.col("_bad"), "left_anti").select(*documents.columns)


def op4_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
