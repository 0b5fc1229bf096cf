"""Repeated passages by suffix arrays (operator 7).

A byte is removed if a ``WINDOW``-byte string that covers it also starts
earlier (in a smaller document, or earlier in the same one).  All texts cannot
share one array, so windows that may be equal are brought together first:

1. Every window is owned by its smallest 32-byte hash (the leftmost of equal
   ones), so equal windows are owned by equal hashes at equal places.  The
   windows that one such anchor owns lie side by side: one row an anchor.
2. Anchors whose hash occurs once own no repeated window and end here.  Of the
   others, copies of the same stretch of text are one variant, and all but its
   first occurrence are repeats.
3. The first occurrences of the variants of a hash go to shards of bounded
   size.  A shard's suffix array is built by induced sorting, common prefixes
   in text order tell which neighbours share a window, and of equal windows all
   but the earliest are repeats.  A hash with very many variants is dealt to
   several shards; the earliest window of each class in each of them then meets
   those of the others by a digest of its bytes.

Results on odd input: null and empty texts, and texts shorter than a window,
keep every byte; texts of any length are read whole; rows without an id come after
all others; rows that share an id are documents of their own, ordered by text;
of equal rows one stays; an empty table gives an empty table; columns are passed
on only if named in ``columns``, so others cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schemelens.llm.common import Scratch, keyed, map_batches, slices
from schemelens.llm.suffix_array import permuted_lcp, suffix_array

WINDOW = 100
ANCHOR = 32
#: Variants of one hash that go to one shard, and bytes of text in one suffix array (a hash's share stays together).
SHARD_VARIANTS = 1024
SHARD_BYTES = 1 << 17
#: Bytes of text whose anchors are found at a time.
SLICE_BYTES = 1 << 19

_RNG = np.random.default_rng(7)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = _RNG.integers(0, 2**64, 5, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 31) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def anchor_runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, hash, variant, first window, windows, anchor's place in the first window) of each anchor."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    h = _BYTE[np.frombuffer(b"".join(texts), np.uint8)]
    for i, m in enumerate(_STEP):
        half = 1 << i
        h = h[:-half] * m + h[half:] if len(h) > half else h[:0]
    h = _mix(h)
    spread = WINDOW - ANCHOR + 1  # hashes in a window
    if len(h) < spread:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    low = h & ~_PLACE | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= spread:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (spread - width)], low[spread - width:])
    windows = np.maximum(sizes - WINDOW + 1, 0)
    number = np.repeat(np.arange(len(texts)), windows)
    first = np.cumsum(windows) - windows
    at = np.arange(len(number)) - first[number] + starts[number]
    owner = (low[at] & _PLACE).astype(np.int64)
    change = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    count = np.diff(np.append(change, len(owner)))
    at, number, owner = at[change], number[change], owner[change]
    end = at + count - 1 + WINDOW
    variant = (end - at).astype(np.uint64) * _STEP[0] + (owner - at).astype(np.uint64) * _STEP[1]
    for i in range(WINDOW // ANCHOR + 2):
        variant = _mix(variant * _STEP[2] + h[np.minimum(at + i * ANCHOR, end - ANCHOR)])
    variant = _mix(variant * _STEP[3] + h[end - ANCHOR])
    return (number, h[owner].view(np.int64), variant.view(np.int64), at - starts[number], count, owner - at)


def runs(texts: DataFrame) -> DataFrame:
    """(hash, variant, _key, first, n, place) of every anchor of ``texts`` (_key, text)."""
    names = ["hash", "variant", "_key", "first", "n", "place"]

    def run(batches):
        for batch in batches:
            for part in slices(batch, [1], SLICE_BYTES):
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
                number, h, variant, first, n, place = anchor_runs(raw)
                if len(number):
                    keys = part.column(0).to_numpy()[number]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(variant), pa.array(keys), pa.array(first.astype(np.int32)),
                         pa.array(n.astype(np.int16)), pa.array(place.astype(np.int16))], names=names)

    return texts.mapInArrow(run, "hash long, variant long, _key long, first int, n smallint, place smallint")


def _regions(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (hash, shard, shards, _key, first, n) with the bytes of its windows."""
    lists = wanted.groupBy("_key").agg(F.collect_list(F.struct("hash", "shard", "shards", "first", "n")).alias("w"))
    rows = texts.join(lists, "_key")

    def run(batch):
        out = []
        for key, text, w in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode("utf-8", "surrogatepass")
            out += [(r["hash"], r["shard"], r["shards"], key, r["first"], r["n"],
                     raw[r["first"]:r["first"] + r["n"] - 1 + WINDOW]) for r in w]
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         names=["hash", "shard", "shards", "_key", "first", "n", "bytes"])

    return map_batches(rows, run, "hash long, shard int, shards int, _key long, first int, n int, bytes binary")


def repeated_windows(keys: np.ndarray, firsts: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For stretches of text that start at (keys, firsts): of every window its stretch, its start in it, whether it
    equals an earlier one, by the suffix array of all stretches."""
    sizes = np.array([len(t) for t in texts])
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8).astype(np.int64) + 2
    joined[joined == 257] = 1  # the byte between stretches sorts first; 0 ends the whole
    t = np.append(joined, 0)
    sa = suffix_array(t, 257)
    same = permuted_lcp(t, sa, WINDOW)[sa] >= WINDOW
    starts = np.cumsum(sizes + 1) - sizes - 1
    number = np.repeat(np.arange(len(texts)), sizes + 1)
    within = np.arange(len(number)) - starts[number]
    is_window = within <= sizes[number] - WINDOW
    group = np.cumsum(~same)
    at = sa[sa < len(number)]
    group = group[sa < len(number)]
    keep = is_window[at]
    at, group = at[keep], group[keep]
    key, place = keys[number[at]], firsts[number[at]] + within[at]
    order = np.lexsort((place, key, group))
    later = np.concatenate(([False], group[order][1:] == group[order][:-1]))
    at = at[order]
    back = np.argsort(at)
    return number[at][back], within[at][back], later[back]


def _spans(keys, firsts, number, within, later):
    """Stretches of neighbouring repeated windows as (key, start, end)."""
    number, within = number[later], within[later]
    if not len(number):
        return ()
    cut = np.concatenate(([True], (np.diff(number) != 0) | (np.diff(within) != 1)))
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(number)) - 1
    start = firsts[number[first]] + within[first]
    return keys[number[first]], start, start + (within[last] - within[first]) + WINDOW


def shard_arrays(regions: DataFrame) -> DataFrame:
    """(kind, _key, start, end, high, low): spans (kind 0), and of hashes in several shards the earliest window of
    each class (kind 1) with the digest of its bytes."""
    dealt = regions.repartition("hash", "shard").sortWithinPartitions("hash", "shard")

    def rows_of(block):
        keys, firsts = np.array([r[3] for r in block]), np.array([r[4] for r in block])
        texts = [r[6] for r in block]
        number, within, later = repeated_windows(keys, firsts, texts)
        out = [(0, int(k), int(a), int(b), 0, 0) for k, a, b in zip(*_spans(keys, firsts, number, within, later))]
        for i, w in zip(number[~later].tolist(), within[~later].tolist()):
            if block[i][2] > 1:
                d = xxhash.xxh3_128_intdigest(texts[i][w:w + WINDOW])
                out.append((1, int(keys[i]), int(firsts[i]) + w, int(firsts[i]) + w + WINDOW,
                            (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)))
        cols = list(zip(*out)) or [()] * 6
        kinds = [pa.int8(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          names=["kind", "_key", "start", "end", "high", "low"])

    def run(batches):
        block, size, group = [], 0, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][:2] != r[:2]:
                    if block and size + sum(len(g[6]) for g in group) > SHARD_BYTES:
                        yield rows_of(block)
                        block, size = [], 0
                    block += group
                    size += sum(len(g[6]) for g in group)
                    group = []
                group.append(r)
        block += group
        if block:
            yield rows_of(block)

    return dealt.mapInArrow(run, "kind byte, _key long, start int, end int, high long, low long")


def repeats(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(_key, start, end): repeated spans of ``texts`` (_key, text), in bytes; spans may overlap."""
    found = runs(texts)
    again = scratch.keep(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    scratch.release()
    shared = scratch.keep(found.join(again.hint("shuffle_hash"), "hash"))
    scratch.drop(again)
    scratch.release()
    variants = scratch.keep(shared.groupBy("hash", "variant").agg(
        F.min(F.struct("_key", "first", "n")).alias("one"), F.count("*").alias("copies")))
    ends = (F.col("first") + F.col("n") - 1 + WINDOW).alias("end")
    copies = shared.join(variants.where("copies > 1").select("hash", "variant", "one"), ["hash", "variant"]).where(
        (F.col("_key") != F.col("one._key")) | (F.col("first") != F.col("one.first"))).select(
        "_key", F.col("first").alias("start"), ends.cast("int").alias("end"))
    copies = scratch.keep(copies)
    scratch.drop(shared)
    scratch.release()
    many = scratch.keep(variants.groupBy("hash").agg(F.count("*").alias("v")).where("v > 1"))
    shards = F.ceil(F.col("v") / SHARD_VARIANTS).cast("int")
    wanted = variants.join(many, "hash").select(
        "hash", F.pmod(F.col("variant"), shards).cast("int").alias("shard"), shards.alias("shards"),
        "one._key", "one.first", F.col("one.n").cast("int").alias("n"))
    regions = scratch.keep(_regions(texts, wanted))
    scratch.drop(variants, many)
    scratch.release()
    arrays = scratch.keep(shard_arrays(regions))
    scratch.drop(regions)
    scratch.release()
    order = Window.partitionBy("high", "low").orderBy("_key", "start")
    later = arrays.where("kind = 1").withColumn("place", F.row_number().over(order)).where("place > 1")
    return copies.unionByName(arrays.where("kind = 0").select("_key", "start", "end")).unionByName(
        later.select("_key", "start", "end"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """(id, columns, n_bytes, spans, kept): the removed spans (start, end in bytes) of each row and the bytes left."""
    scratch = Scratch(df.sparkSession, "suffixes")
    rows, _ = keyed(df.select(id_col, *columns, F.col(text_col).cast("string").alias("_text")), id_col, ["_text"])
    texts = rows.select("_key", F.col("_text").alias("text"))
    spans = scratch.keep(repeats(texts, scratch).groupBy("_key").agg(
        F.collect_set(F.struct("start", "end")).alias("_spans")))
    scratch.release()
    out = rows.join(spans, "_key", "left").select(id_col, *columns, "_text", "_spans")
    keep = out.schema.fields[:-2]

    def run(batch):
        n, cut, left = [], [], []
        for text, spans_ in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()):
            raw = (text or "").encode("utf-8", "surrogatepass")
            own = merged([(s["start"], s["end"]) for s in spans_ or ()])
            ends = [0, *(x for s in own for x in s), len(raw)]
            n.append(len(raw)), cut.append([{"start": a, "end": b} for a, b in own])
            left.append(b"".join(raw[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:len(keep)], pa.array(n, pa.int64()),
             pa.array(cut, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(left, pa.binary())], names=[*(f.name for f in keep), "n_bytes", "spans", "kept"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return map_batches(out, run, f"{kinds}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, with the repeated bytes cut out of ``text_col``; what a cut leaves of a
    character goes with it, and a null text stays null."""
    row = df.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    out = deduplicate(row, "_id", "_t", ("_row",))
    names = df.columns
    at = names.index(text_col)

    def run(batch):
        kept = [k.decode("utf-8", "ignore") for k in batch.column(1).to_pylist()]
        cols = batch.column(0).flatten()
        cols[at] = pa.array([None if not t.is_valid else k for t, k in zip(cols[at], kept)], cols[at].type)
        yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_batches(out.select("_row", "kept"), run, df.schema)
