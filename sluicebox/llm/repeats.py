"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every string of LENGTH bytes has an anchor: of its GRAM-byte substrings the
leftmost with the least hash, which depends on the string alone.  It is named by
its bytes and those that half of the rest of the string holds before it or, if
there are not so many before it, after it; so a phrase in other surroundings is
another anchor.  Consecutive strings with one anchor form a piece.  Equal strings
have equal anchors, so pieces can be dealt out by anchor; anchors that stand once
in the corpus are dropped before any text is moved.  Pieces are first dealt out as digests, and of
equal ones only the first goes on; only anchors with different pieces need their
bytes.  In each bin these are sorted into a Burrows-Wheeler transform;
breadth-first backward extension gives the common prefixes by increasing value
and stops at LENGTH, where each interval is one string.

The texts of interest are shuffled once and kept as a table bucketed by
document, which every later join with them reads as it lies.

Copies of whole documents are taken out first.  An anchor with more than HOT
different pieces, such as a frequent line in ever new surroundings, is dealt
out anew by whole strings, so no bin grows with it.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import parts, table, workspace

LENGTH = 100
GRAM = 24
HOT = 1000
BIN_BYTES = 1_000_000
#: Texts up to so many bytes together are looked at at once; arrays of that size stay in a processor's cache.
TOGETHER = 1 << 15
#: A table of at most so many rows of two numbers (16 MB) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Places are kept in the low bits of a hash; longer texts are read in parts that overlap.
_PLACES = np.uint64((1 << 22) - 1)


def gram_hashes(raw: bytes, gram: int = GRAM) -> np.ndarray:
    """A hash of every ``gram`` consecutive bytes."""
    with np.errstate(over="ignore"):
        power, size, sums = _BASE, 1, np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
        out, out_size = None, 0
        left = gram
        while left:
            if left & 1:
                if out is None:
                    out, out_size = sums, size
                else:
                    keep = len(out) - size
                    out, out_size = out[:keep] * power + sums[out_size:out_size + keep], out_size + size
            left >>= 1
            if left:
                sums = sums[:len(sums) - size] * power + sums[size:]
                power, size = power * power, size * 2
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))


def _reach(length: int) -> tuple[int, list[int]]:
    """How far the bytes that name an anchor reach to one side of it, and the places of grams that cover them.

    A string holds so many bytes before its anchor, or else after it.
    """
    gram = min(GRAM, length)
    reach = (length - gram) // 2
    return reach, [*range(0, reach, gram), reach]


def _anchors(raw: bytes, length: int, sizes: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``sizes``: of texts that follow one another in ``raw``; no string lies across two."""
    value = gram_hashes(raw, min(GRAM, length))
    # High bits of the hash, then the place: the least is the leftmost of the least.
    best = (value & ~_PLACES) | np.arange(len(value), dtype=np.uint64)
    width, wanted = 1, length - min(GRAM, length) + 1
    while width < wanted:
        shift = min(width, wanted - width)
        best = np.minimum(best[:len(best) - shift], best[shift:])
        width += shift
    place = (best & _PLACES).astype(np.int64)
    begin, end = _runs(place)
    if sizes is not None:
        # An anchor lies in one text: of its strings those are left that do not begin in the one before or end in the next.
        stops = np.cumsum(sizes)
        text = np.searchsorted(stops, place[begin], "right")
        begin, end = np.maximum(begin, (stops - sizes)[text]), np.minimum(end, stops[text] - length + 1)
        begin, end = begin[begin < end], end[begin < end]
    place = place[begin]
    # Strings with enough bytes before the anchor are named by these, the others by those after it.
    reach, covers = _reach(length)
    border = np.clip(place - reach + 1, begin, end)
    with np.errstate(over="ignore"):
        names = []
        for at in (np.maximum(place - reach, 0), np.minimum(place, len(value) - 1 - reach)):
            name = value[at]
            for k in covers:
                name = (name ^ (name >> np.uint64(32))) * _BASE + value[at + k]
            names.append(name)
    # Before and after by turns; empty ones are left out.
    begin, end = np.column_stack([begin, border]).ravel(), np.column_stack([border, end]).ravel()
    some = begin < end
    return begin[some], end[some], np.repeat(place, 2)[some], np.column_stack(names).ravel()[some]


def anchor_runs(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings of ``length`` bytes with one anchor: first start, end of the starts, place and name of the anchor."""
    step = int(_PLACES) - length
    found = [_anchors(raw[at:at + step + length - 1], length) for at in range(0, len(raw) - length + 1, step)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    begin, end, place = (np.concatenate([part[c] + k * step for k, part in enumerate(found)]) for c in range(3))
    return begin, end, place, np.concatenate([part[3] for part in found])


def text_runs(raws: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of several texts: number of the text, first start in it, end of the starts, name of the anchor."""
    at = [k for k, raw in enumerate(raws) if len(raw) >= length]
    sizes = np.array([len(raws[k]) for k in at], np.int64)
    if len(at) > 1 and sizes.sum() <= int(_PLACES):
        begin, end, place, name = _anchors(b"".join([raws[k] for k in at]), length, sizes)
        stops = np.cumsum(sizes)
        text = np.searchsorted(stops, place, "right")
        start = (stops - sizes)[text]
        return np.array(at)[text], begin - start, end - start, name
    found = [(np.full(len(run[0]), k), run[0], run[1], run[3]) for k in at for run in [anchor_runs(raws[k], length)]]
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))


def anchors(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Of each string of ``length`` bytes, by its start: place and name of its anchor."""
    begin, end, place, value = anchor_runs(raw, length)
    return np.repeat(place, end - begin), np.repeat(value, end - begin)


def _runs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (exclusive) of runs of equal values."""
    cut = np.flatnonzero(np.diff(place)) + 1
    return np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut, [len(place)]]).astype(np.int64)


# --- the transform

#: Two ranks and a place below this fit into one number, and sorting numbers is cheaper than sorting their places.
_PACKED = 1 << 21


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` symbols (int64, below 512; 0 past the end)."""
    n, known = len(text), 7
    padded = np.concatenate([text, np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(known):
        key = key << 9 | padded[k:k + n]
    while True:
        order = np.argsort(key) if known == 7 or n + 2 > _PACKED else np.sort(key * _PACKED + np.arange(n)) % _PACKED
        if known >= depth:
            return order
        changed = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.zeros(n + known, np.int64)
        rank[order] = changed + 1
        key = rank[:n] * (n + 2) + rank[known:known + n]
        known *= 2


def bounded_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): suffixes by their first ``length`` symbols, and the common prefix with the one before.

    ``common`` is exact below ``length``, and ``length`` where at least so much is shared.
    """
    n = len(text)
    order = sorted_suffixes(text, length)
    transform = text[order - 1]
    # Where each row goes when its symbol is put before it: rows by symbol, then by place.
    step = np.empty(n, np.int64)
    step[np.argsort(transform.astype(np.uint16), kind="stable")] = np.arange(n)
    border = np.concatenate([[True], np.diff(text[order]) != 0])
    common = np.full(n + 1, length, np.int64)
    common[0] = common[n] = 0
    # Rows of the intervals in order, and the interval of each; rows that are an interval of their own need no sort.
    rows, interval, single = np.arange(n), np.zeros(n, np.int64), np.zeros(0, np.int64)
    for value in range(length):
        single = step[single]
        single = single[common[single + 1] == length]
        moved = np.sort(step[rows] << 32 | interval)
        rows, interval = moved >> 32, moved & 0xFFFFFFFF
        new = np.concatenate([[True], (np.diff(interval) != 0) | (np.diff(rows) != 1)])[:len(rows)] | border[rows]
        first = np.flatnonzero(new)
        sizes = np.diff(first, append=len(rows))
        ends = rows[first] + sizes
        if value == 0:  # at the symbols' own borders nothing is shared
            common[ends] = 0
            fresh = np.ones(len(ends), bool)
        else:
            fresh = common[ends] == length
            common[ends[fresh]] = value
            common[single + 1] = value
        single = np.concatenate([single, rows[first[fresh & (sizes == 1)]]])
        fresh &= sizes > 1
        rows, interval = rows[np.repeat(fresh, sizes)], np.repeat(np.arange(int(fresh.sum())), sizes[fresh])
        if not len(rows) and not len(single):
            break
    return order, common[:n]


def _first(pieces: list[bytes], keys: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each string of the pieces: number of its piece, place in it, and whether it stands nowhere earlier."""
    by = np.lexsort(tuple(reversed(keys)))
    pieces = [pieces[k] for k in by.tolist()]
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 1
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    text[begins + sizes] = 0
    order, common = bounded_prefixes(text, length)
    counts = sizes - length + 1
    piece = np.repeat(np.arange(len(pieces)), counts)
    at = np.arange(len(piece))
    offset = at - np.repeat(np.cumsum(counts) - counts, counts)
    string = np.zeros(len(text), np.int64)
    string[order] = np.cumsum(common < length)
    name = string[begins[piece] + offset]
    first = np.zeros(len(text) + 1, np.int64)
    first[name[::-1]] = at[::-1]  # the last value put stays: the first string
    return by[piece], offset, first[name] == at


def first_strings(pieces: list[bytes], keys: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Of each piece, which of its strings of ``length`` bytes stand nowhere earlier in the given pieces.

    ``keys`` are columns (most significant first) that order the pieces; the last is the place in the document.  No two
    pieces hold one string of one document.
    """
    piece, offset, kept = _first(pieces, keys, length)
    out = [np.zeros(len(p) - length + 1, bool) for p in pieces]
    for k, o in zip(piece[kept].tolist(), offset[kept].tolist()):
        out[k][o] = True
    return out


# --- tasks

def _raw(column: pa.Array) -> Iterator[bytes]:
    return (b.as_py() or b"" for b in column.cast(pa.binary()))


_RUNS = "anchor bigint, row bigint, run bigint"
_PLACE_BITS = 31


def _mark(salt, length: int):
    """The bits of a salt that fit into one number with a place and a number of strings."""
    return np.asarray(salt, np.int64) & (1 << 63 - _PLACE_BITS - length.bit_length()) - 1


def _list(length):
    """The runs of every text, each in one number: bits of the salt, place, number of strings.  Short texts are looked at together."""
    def run(batches):
        for batch in batches:
            rows, marks = batch.column("row").to_numpy(), _mark(batch.column("salt").to_numpy(), length)
            begun, size, raws, found, listed = 0, 0, [], [], 0
            for k, raw in enumerate(_raw(batch.column("text"))):
                raws.append(raw)
                size += len(raw)
                if size >= TOGETHER or k + 1 == len(rows):
                    text, begin, end, name = text_runs(raws, length)
                    text += begun
                    found.append((name.view(np.int64), rows[text], (marks[text] << _PLACE_BITS | begin) << length.bit_length() | end - begin))
                    begun, size, raws, listed = k + 1, 0, [], listed + len(text)
                    if listed > 100_000 or k + 1 == len(rows):
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["anchor", "row", "run"])
                        found, listed = [], 0
    return run


def _flagged(anchors, runs, salt: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, begin, n) by place of the runs listed for a row, without what another row of the same number lists."""
    run, first = np.unique(runs.values.to_numpy(), return_index=True)  # equal rows list the same
    bits = length.bit_length()
    own = run >> _PLACE_BITS + bits == _mark(salt, length)
    run, anchor = run[own], anchors.values.to_numpy()[first[own]]
    return anchor, run >> bits & (1 << _PLACE_BITS) - 1, run & (1 << bits) - 1


def _pack(batches):
    """Texts as compressed bytes, so that less is shuffled."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [packer.compress(raw) for raw in _raw(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rank"), batch.column("salt"), pa.array(packed, pa.binary())], names=["rank", "salt", "packed"])


def _listed(structs, salt: int, *names: str) -> list[np.ndarray]:
    """Fields of a row's list as arrays, without what another row of the same number lists."""
    if not structs.is_valid:
        return [np.zeros(0, np.int64) for _ in names]
    values = structs.values
    salts = values.field("salt").to_numpy()
    return [values.field(n).to_numpy(zero_copy_only=False)[salts == salt] for n in names]


_DIGESTS = "anchor bigint, digest binary, rank bigint, salt bigint, at bigint, n bigint"


def _digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _digests(length):
    """Pieces of repeated anchors: digest, place, and number of strings."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            digests, parts = [], []
            for row, (salt, packed, anchor, runs) in enumerate(zip(*[batch.column(c) for c in ("salt", "packed", "anchors", "runs")])):
                raw = unpack.decompress(packed.as_py())
                anchor, at, n = _flagged(anchor, runs, salt.as_py(), length)
                found = {}
                for k, (b, e) in enumerate(zip(at.tolist(), (at + n + length - 1).tolist())):
                    found.setdefault(_digest(raw[b:e]), k)  # a later one in this document is never the first
                first = np.fromiter(found.values(), np.int64, len(found))
                digests += found
                parts.append((anchor[first], np.full(len(first), row), at[first], n[first]))
                if digests and (len(digests) > 100_000 or row + 1 == len(batch)):
                    values, rows, at, n = map(np.concatenate, zip(*parts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values), pa.array(digests, pa.binary()), *[batch.column(c).take(pa.array(rows)) for c in ("rank", "salt")],
                         pa.array(at), pa.array(n)], names=["anchor", "digest", "rank", "salt", "at", "n"])
                    digests, parts = [], []
    return run


_PIECES = "bin int, piece binary, rank bigint, salt bigint, at bigint"
_PIECES_ARROW = pa.schema([("bin", pa.int32()), ("piece", pa.binary()), ("rank", pa.int64()), ("salt", pa.int64()), ("at", pa.int64())])
_STRING = -1


def _pieces(length, bins):
    """The bytes of wanted pieces by bin; of hot ones the digest of every string."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for rank, salt, packed, wanted in zip(*[batch.column(n) for n in ("rank", "salt", "packed", "wanted")]):
                rank, salt = rank.as_py(), salt.as_py()
                at, n, hot, anchor = _listed(wanted, salt, "at", "n", "hot", "anchor")
                if not len(at):
                    continue
                raw = unpack.decompress(packed.as_py())
                bin_ = (anchor & 0x7FFFFFFFFFFFFFFF) // 64 % bins
                for a, m, h, b in zip(at.tolist(), n.tolist(), hot.tolist(), bin_.tolist()):
                    if h:
                        rows += [(_STRING, _digest(raw[k:k + length]), rank, salt, k) for k in range(a, a + m)]
                    else:
                        rows.append((b, raw[a:a + m + length - 1], rank, salt, a))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES_ARROW)], schema=_PIECES_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES_ARROW)], schema=_PIECES_ARROW)
    return run


_KEPT = "rank bigint, salt bigint, at bigint, n bigint"


def _expand(length):
    def run(bin_rows: pa.Table) -> pa.Table:
        rank, salt, at = (bin_rows.column(n).to_numpy() for n in ("rank", "salt", "at"))
        piece, offset, kept = _first(bin_rows.column("piece").to_pylist(), [rank, salt, at], length)
        edge = np.concatenate([[True], np.diff(piece) != 0])
        begin = np.flatnonzero(kept & (edge | ~np.roll(kept, 1)))
        end = np.flatnonzero(kept & np.roll(edge | ~kept, -1)) + 1
        k = piece[begin]
        return pa.Table.from_arrays([pa.array(c) for c in (rank[k], salt[k], at[k] + offset[begin], end - begin)], names=["rank", "salt", "at", "n"])
    return run


_RESULT = "rank bigint, salt bigint, n_removed bigint, n_spans bigint, kept_text binary"


def _within(begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in the ranges, no two of which overlap."""
    change = np.zeros(size + 1, np.int8)
    change[begin] += 1
    change[end] -= 1
    return np.cumsum(change[:-1], dtype=np.int8).view(bool)


def _remove(length):
    """Each document without the bytes of repeated strings that are not among the kept ones."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for rank, salt, packed, anchors, runs, kept in zip(*[batch.column(n) for n in ("rank", "salt", "packed", "anchors", "runs", "kept")]):
                raw, salt = unpack.decompress(packed.as_py()), salt.as_py()
                _, begin, count = _flagged(anchors, runs, salt, length)
                at, n = _listed(kept, salt, "at", "n")
                gone = np.concatenate([[False], _within(begin, begin + count, len(raw)) & ~_within(at, at + n, len(raw)), [False]])
                edges = np.flatnonzero(gone[1:] != gone[:-1])
                # Bytes of the strings that go; runs that overlap or touch are one span.
                begin, end = edges[::2], edges[1::2] + length - 1
                apart = begin[1:] > end[:-1]
                begin, end = begin[np.concatenate([[True], apart])[:len(begin)]], end[np.concatenate([apart, [True]])[:len(end)]]
                left = b"".join([raw[e:b] for e, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)])])
                rows.append((rank.as_py(), salt, len(raw) - len(left), len(begin), left))
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                names=["rank", "salt", "n_removed", "n_spans", "kept_text"])
    return run


# --- the operator

def _salt():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _rank():
    return F.coalesce("doc_id", F.lit(2 ** 63 - 1))


def _row():
    """One number for a row's rank and salt; lists by it hold the salt, so that a row of the same number takes nothing else."""
    return F.xxhash64("rank", "salt").alias("row")


def shortened(documents: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(marks, changed) of the documents.

    marks: rank, salt (which name a row), n_bytes, copy of every row; ``copy``
    is true of a text of at least ``length`` bytes that an earlier document has
    as a whole.  changed: rank, salt, n_removed, n_spans, kept_text of the rows,
    copies apart, that hold an anchor which stands more than once.
    """
    work = workspace(documents)
    text = F.coalesce("text", F.lit(""))
    marks = work.stage(documents.select(
        _rank().alias("rank"), _salt().alias("salt"), F.octet_length(text).cast("long").alias("n_bytes"), F.md5(text).alias("digest")), "marks")
    first = work.stage(marks.groupBy("digest").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
                       .where("first < last").select("digest", "first"), "copied")
    copies = work.stage(marks.join(first, "digest").where("rank > first").select("rank", "salt").distinct()
                        .withColumn("copy", F.lit(True)), "copies")
    marks = marks.select("rank", "salt", "n_bytes").join(copies, ["rank", "salt"], "left").select(
        "rank", "salt", "n_bytes", (F.coalesce("copy", F.lit(False)) & (F.col("n_bytes") >= length)).alias("copy"))
    left_out = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    originals = documents.select(_rank().alias("rank"), _salt().alias("salt"), "text").where(F.octet_length("text") >= length).join(
        left_out, ["rank", "salt"], "left_anti").select("rank", "salt", "text")

    # Listed twice: that is cheaper than the room a table of all runs takes.
    listed = originals.select(_row(), "salt", "text").mapInArrow(_list(length), _RUNS)
    repeated = work.stage(listed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeated")
    flagged = listed.join(repeated.hint("shuffle_hash"), "anchor").groupBy("row").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("run").alias("runs"))
    packed = originals.mapInArrow(_pack, "rank bigint, salt bigint, packed binary").select(_row(), "rank", "salt", "packed")
    # Bucketed as the join left it: later joins by document do not move the texts again.
    near_name = f"repeats_near_{uuid.uuid4().hex}"
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed.join(flagged, "row").write.option("compression", "none").bucketBy(buckets, "row").saveAsTable(near_name)
    near = documents.sparkSession.table(near_name)

    firsts = work.stage(
        near.mapInArrow(_digests(length), _DIGESTS).groupBy("anchor", "digest").agg(
            F.min(F.struct("rank", "salt", "at")).alias("f"), F.min("n").alias("n")).select("anchor", "f.rank", "f.salt", "f.at", "n"), "firsts")
    shared = work.stage(firsts.groupBy("anchor").agg(F.count("*").alias("pieces"), F.sum("n").alias("strings")).where("pieces > 1"), "shared")
    total = shared.where(F.col("pieces") <= HOT).agg(F.sum(F.col("strings") + length * F.col("pieces"))).first()[0]
    alone = firsts.join(shared.select("anchor"), "anchor", "left_anti").select("rank", "salt", "at", "n")
    wanted = firsts.join(shared.select("anchor", (F.col("pieces") > HOT).alias("hot")), "anchor").groupBy(_row()).agg(
        F.collect_list(F.struct("salt", "at", "n", "hot", "anchor")).alias("wanted"))
    pieces = work.stage(near.select("row", "rank", "salt", "packed").join(wanted, "row").mapInArrow(_pieces(length, parts(total, BIN_BYTES)), _PIECES), "pieces")
    expanded = pieces.where(F.col("bin") != _STRING).groupBy("bin").applyInArrow(_expand(length), _KEPT)
    hot = pieces.where(F.col("bin") == _STRING).groupBy("piece").agg(
        F.min(F.struct("rank", "salt", "at")).alias("f")).select("f.rank", "f.salt", "f.at", F.lit(1).cast("long").alias("n"))
    kept = alone.unionByName(expanded).unionByName(hot).groupBy(_row()).agg(F.collect_list(F.struct("salt", "at", "n")).alias("kept"))
    changed = work.stage(near.join(kept, "row", "left").mapInArrow(_remove(length), _RESULT), "changed")
    documents.sparkSession.sql(f"DROP TABLE {near_name}")
    return marks, changed


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    Null texts are empty; texts under ``length`` bytes keep all.  Equal rows
    count as one document and get one result; rows with one doc_id and
    different texts are ordered by a hash of the text.  A null doc_id comes
    last.  An empty table gives no rows.  Only doc_id and text are read.
    """
    marks, changed = shortened(documents, length)
    work = workspace(documents)
    facts = changed.select("rank", "salt", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256")).distinct()
    whole = documents.select("doc_id", _rank().alias("rank"), _salt().alias("salt"),
                             F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"))
    known = work.stage(marks.distinct().join(facts, ["rank", "salt"], "left"), "known")
    empty = F.sha2(F.lit(""), 256)
    return whole.join(known, ["rank", "salt"]).select(
        "doc_id", "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copy"), empty).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"))


def cut_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings cut out of their texts, all columns.

    Rows without repeats are passed on as they are, null texts too.  A cut may
    fall inside a character; what is left of it is dropped.  A text of which
    nothing is left is empty.  The column n_chars, if there is one, follows.
    """
    marks, changed = shortened(documents, length)
    work = workspace(documents)
    edits = changed.where("n_removed > 0").select("rank", "salt", "kept_text").unionByName(
        marks.where("copy").select("rank", "salt", F.lit(b"").alias("kept_text"))).distinct()
    edits = work.stage(edits.select("rank", "salt", F.col("kept_text").alias("kept_bytes")), "edits")

    names = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), _rank().alias("rank"), _salt().alias("salt"))
    joined = rows.join(edits, ["rank", "salt"], "left")

    def decode(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = [None if b is None else b.decode("utf-8", "ignore") for b in batch.column("kept_bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "left_over"])

    schema = joined.select("row", F.lit("").alias("left_over")).schema
    for field in schema:
        field.nullable = True
    done = joined.select("row", "kept_bytes").mapInArrow(decode, schema)
    text = F.coalesce("left_over", "row.text")
    column = {"text": text, "n_chars": F.when(F.col("left_over").isNull(), F.col("row.n_chars")).otherwise(
        F.length("left_over").cast(dict(documents.dtypes).get("n_chars", "bigint")))} if "n_chars" in names else {"text": text}
    return done.select(*[column.get(n, F.col(f"row.`{n}`")).alias(n) for n in names])


def op9_bounded_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
