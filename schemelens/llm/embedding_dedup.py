"""Embedding near-duplicates by bounded comparison of blocks of vectors (operator 5).

Each unit vector goes to the pivot it is nearest to; pivots are some vectors of
the table and decide only the order of the work.  Vectors in the order of pivot
and cosine are cut into blocks, each stored once as one row, and every pair of
blocks whose ranges of the first principal component are near enough is compared
by a cross join that reads the stored blocks: no pair of blocks is shuffled.
Inside a pair of blocks, a group of vectors of one pivot p, whose cosines with p
are v at least, meets only vectors y with y.p >= cos(acos v + acos t): others are
too far by the triangle inequality of angles.  What is left is compared by the
leading principal components, where the other components add at most the product
of the two suffix norms, then by all components in single precision, with room
for rounding.  Survivors get the exact cosine in double precision.  A pair of
blocks hands on the number of links of each vector and one spanning forest,
never all pairs.

Results on odd input: vectors that are null, empty, zero or hold null or
non-finite numbers link with nothing; vectors link only with vectors of their
own length; identical vectors (found by SHA-256 of their scaled numbers) are
compared once for all; repeated rows and rows that share an id are vectors of
their own; null ids come last; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from schemelens.llm.common import Scratch, component_ids, give_back, keyed, map_batches, record_batch
from schemelens.llm.components import components, forest

THRESHOLD = 0.95
#: Most vectors of a block, most bytes of their numbers (the last of a part may have half as many more), and blocks
#: that a small table is cut into.
TILE = 1 << 16
TILE_BYTES = 8 << 20
TILES = 24
#: Vectors a pivot has on average, most bytes of the pivots, and vectors that share one bound.
CELL = 128
PIVOT_BYTES = 8 << 20
GROUP = 64
#: Principal components that are summed before the remaining products are bounded.
LEAD = 16
#: Most tasks that compare pairs of blocks.
TASKS = 1 << 13
#: What a block has of each vector, as bytes.
PARTS = ("cells", "cosines", "reps", "copies", "vecs")
#: Products held at once.
PRODUCTS = 1 << 22


def numbers(column: pa.Array, kind: str, d: int) -> np.ndarray:
    """Stored vectors as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, d)


def exact(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest number first, so that squares neither overflow nor vanish."""
    x = x.astype("<f8")
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def rough(x: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision."""
    x = (x / np.abs(x).max(1, keepdims=True)).astype("<f4")
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def slack(d: int) -> float:
    """Room for rounding in single-precision products of ``d`` numbers of unit vectors."""
    return (d + 32) * 2.0 ** -22


def stored_rows(rows: DataFrame, id_col: str, kind: str) -> DataFrame:
    """(_key, id, d, digest, vec): numbers as bytes, the digest equal for equal directions; d is 0 for vectors that link with nothing."""
    schema = StructType([rows.schema["_key"], rows.schema[id_col], StructField("d", IntegerType()),
                         StructField("digest", BinaryType()), StructField("vec", BinaryType())])

    def run(batch):
        column = batch.column(2)
        offsets = column.offsets.to_numpy()
        x = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)  # nulls become NaN
        sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        d, digest, vec = np.zeros(len(sizes), "<i4"), [None] * len(sizes), [None] * len(sizes)
        for size in np.unique(sizes[sizes > 0]).tolist():
            at = np.flatnonzero(sizes == size)
            m = x[(offsets[at] - offsets[0])[:, None] + np.arange(size)].astype(kind)
            good = np.isfinite(m).all(1) & (m != 0).any(1)
            at, m = at[good], m[good] + 0  # -0.0 is 0.0
            d[at] = size
            scaled = m.astype("<f8")
            scaled /= np.abs(scaled).max(1, keepdims=True, initial=0)
            for i, a, b in zip(at.tolist(), scaled, m):
                digest[i], vec[i] = sha256(a.tobytes()).digest(), b.tobytes()
        yield record_batch(schema, [batch.column(0), batch.column(1), pa.array(d), digest, vec])

    return map_batches(rows.select("_key", id_col, "vector"), run, schema)


def principal_axes(vectors: DataFrame, d: int, kind: str) -> np.ndarray:
    """Orthonormal axes (columns), largest variance first; only d + d*d sums come to the driver."""
    def run(batches):
        total = np.zeros(1 + d + d * d)
        for batch in batches:
            x = exact(numbers(batch.column(0), kind, d))
            total += np.concatenate(([len(x)], x.sum(0), (x.T @ x).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["sums"])

    sums = vectors.select("vec").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
    got = np.zeros(1 + d + d * d)
    for r in sums.groupBy("i").agg(F.sum("v").alias("v")).collect():
        got[r.i] = r.v
    mean = got[1:1 + d] / max(got[0], 1)
    cov = got[1 + d:].reshape(d, d) / max(got[0], 1) - np.outer(mean, mean)
    return np.linalg.eigh(cov)[1][:, ::-1].copy()


def _pivots(vectors: DataFrame, n: int, d: int, kind: str, axis: np.ndarray) -> np.ndarray:
    """Directions that give the vectors their order and bounds, in the order of ``axis``; no result depends on which they are."""
    most = min(n // CELL, PIVOT_BYTES // (4 * d))
    some = vectors.where(F.pmod(F.xxhash64("rep"), F.lit(n)) < most).select("vec").collect()
    found = np.concatenate([axis[None, :].astype("<f4"), *(rough(np.frombuffer(r.vec, kind)[None, :]) for r in some)])
    return found[np.argsort(found @ axis, kind="stable")]


def _assign(vectors: DataFrame, d: int, kind: str, pivots: np.ndarray, scratch: Scratch) -> DataFrame:
    """(cell, cosine, rep, copies, vec): the pivot each vector is nearest to, and its cosine with it."""
    at_once = max(1, PRODUCTS // len(pivots))

    def assign(batches):
        for batch in batches:
            x = rough(numbers(batch.column(2), kind, d))
            cell, cosine = np.zeros(len(x), "<i4"), np.zeros(len(x), "<f4")
            for i in range(0, len(x), at_once):
                s = x[i:i + at_once] @ pivots.T
                cell[i:i + at_once] = best = s.argmax(1)
                cosine[i:i + at_once] = s[np.arange(len(best)), best]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(cosine), *batch.columns],
                                             names=["cell", "cosine", "rep", "copies", "vec"])

    return scratch.keep(vectors.select("rep", "copies", "vec").mapInArrow(
        assign, "cell int, cosine float, rep long, copies long, vec binary"))


def _blocks(assigned: DataFrame, n: int, d: int, kind: str, axes: np.ndarray, scratch: Scratch) -> DataFrame:
    """(place, lo, hi, ...): rows of some thousand vectors in the order of their pivots, lo and hi along the first axis."""
    size = max(1, min(TILE, TILE_BYTES // (d * np.dtype(kind).itemsize), max(1024, -(-n // TILES))))
    order = ["cell", "cosine", "rep"]
    rows = assigned.repartitionByRange(-(-n // size), *order).sortWithinPartitions(*order)

    def run(batches):
        part, k, held, have = None, 0, [], 0

        def block(rows):
            nonlocal k, held, have
            t = pa.Table.from_batches(held)
            held = t.slice(rows).to_batches()
            have -= rows
            t = t.slice(0, rows).combine_chunks()
            along = exact(numbers(t.column("vec"), kind, d)) @ axes[:, 0]
            cells, cosines, reps, copies = (t.column(c).to_numpy().tobytes() for c in ("cell", "cosine", "rep", "copies"))
            k += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k]), pa.array([along.min()]), pa.array([along.max()]),
                 *(pa.array([x], pa.binary()) for x in (cells, cosines, reps, copies,
                                                        b"".join(t.column("vec").to_pylist())))],
                names=["place", "lo", "hi", *PARTS])

        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
                held.append(batch)
                have += batch.num_rows
            while have > size + size // 2:
                yield block(size)
        if have:
            yield block(have)

    body = scratch.keep(rows.select(F.spark_partition_id().alias("part"), *order, "copies", "vec").mapInArrow(
        run, "place long, lo double, hi double, " + ", ".join(f"{c} binary" for c in PARTS)))
    scratch.drop(assigned)
    return body


class Block:
    """Vectors of a stored block as the comparison needs them."""

    def __init__(self, raw: list, d: int, kind: str, axes: np.ndarray):
        self.place = raw[0]
        self.cell, self.cosine, self.rep, self.copies, self.vec = (  # copied, so that the batch they came in can go
            np.frombuffer(x, k).copy() for x, k in zip(raw[1:], ("<i4", "<f4", "<i8", "<i8", kind)))
        self.vec = self.vec.reshape(-1, d)
        self.rough = rough(self.vec)
        lead = self.rough @ axes.astype("<f4")
        rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", lead, lead), 0) + slack(d))
        self.lead = np.concatenate([lead, rest[:, None].astype("<f4")], 1)


def _root(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = x
    while True:
        up = parent[top]
        if (up == top).all():
            parent[x] = top
            return top
        top = up


def _unite(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    while True:
        u, v = _root(parent, u), _root(parent, v)
        apart = u != v
        if not apart.any():
            return
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))


def linked(a: Block, b: Block, pivots: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, copies linked to, smallest rep in reach) of each vector that ``a`` against ``b`` links."""
    same = a.place == b.place
    n, off = len(a.rep), 0 if a.place == b.place else len(a.rep)
    room = slack(a.vec.shape[1])
    cut = np.float32(t - room)
    reps, copies = (x if same else np.concatenate([x, y]) for x, y in ((a.rep, b.rep), (a.copies, b.copies)))
    copies, links, parent = copies.astype("<f8"), np.zeros(len(reps)), np.arange(len(reps))
    first = np.flatnonzero(np.diff(a.cell, prepend=-1))
    begin = np.concatenate([np.arange(i, j, GROUP) for i, j in zip(first, [*first[1:], n])])
    end = np.append(begin[1:], n)
    angle = np.arccos(np.clip(a.cosine[begin].astype("<f8") - room, -1, 1)) + np.arccos(np.clip(t, -1, 1))
    bound = (np.cos(np.minimum(angle, np.pi)) - room).astype("<f4")
    at_once = max(1, PRODUCTS // len(b.rep))
    for g in range(0, len(begin), at_once):
        cells, which = np.unique(a.cell[begin[g:g + at_once]], return_inverse=True)
        near = pivots[cells] @ b.rough.T
        for i, j, least, c in zip(begin[g:g + at_once], end[g:g + at_once], bound[g:g + at_once], which):
            cols = np.flatnonzero(near[c, i:] >= least) + i if same else np.flatnonzero(near[c] >= least)
            step = max(1, PRODUCTS // GROUP)
            for k in range(0, len(cols), step):
                _compare(a, b, np.arange(i, j), cols[k:k + step], t, cut, same, off, copies, links, parent)
    touched = np.flatnonzero(links)
    root = _root(parent, touched)
    low = np.full(len(reps), np.iinfo(np.int64).max)
    np.minimum.at(low, root, reps[touched])
    return reps[touched], links[touched].astype("<i8"), low[root]


def _compare(a: Block, b: Block, rows: np.ndarray, cols: np.ndarray, t: float, cut: np.float32, same: bool, off: int,
             copies: np.ndarray, links: np.ndarray, parent: np.ndarray) -> None:
    for x, y in ((a.lead, b.lead), (a.rough, b.rough)):
        s = x[rows] @ y[cols].T
        c = np.flatnonzero(s.max(0) >= cut)
        if not len(c):
            return
        rows, cols = rows[s[:, c].max(1) >= cut], cols[c]
    m = exact(a.vec[rows]) @ exact(b.vec[cols]).T >= t
    if same:
        m &= rows[:, None] < cols[None, :]
    if not m.any():
        return
    links[rows] += m @ copies[cols + off]
    links[cols + off] += copies[rows] @ m
    low_rows, low_cols = forest(m, rows, cols + off)
    _unite(parent, np.concatenate([rows, cols + off]), np.concatenate([low_rows, low_cols]))


def compare(assigned: DataFrame, n: int, d: int, kind: str, axes: np.ndarray, pivots: np.ndarray, t: float,
            scratch: Scratch) -> DataFrame:
    """(rep, links, low) per linked vector and pair of blocks: copies it is linked to, smallest key in reach."""
    body = _blocks(assigned, n, d, kind, axes, scratch)
    left, right = (body.select(*(F.col(c).alias(f"{c}{i}") for c in body.columns)) for i in (1, 2))
    reach = float(np.sqrt(max(2 - 2 * t, 0))) + 1e-9
    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("place1") <= F.col("place2"))
                      & (F.col("lo1") <= F.col("hi2") + reach) & (F.col("lo2") <= F.col("hi1") + reach))

    def run(batches):
        a = None
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = ([batch.column(f"place{k}")[i].as_py()] + [batch.column(f"{c}{k}")[i].as_buffer() for c in PARTS]
                            for k in (1, 2))
                if a is None or a.place != one[0]:
                    a = Block(one, d, kind, axes)
                out = linked(a, a if one[0] == two[0] else Block(two, d, kind, axes), pivots, t)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["rep", "links", "low"])
            batch = one = two = None
            give_back()

    found = scratch.keep(pairs.coalesce(TASKS).mapInArrow(run, "rep long, links long, low long"))
    scratch.drop(body)
    return found


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of each row."""
    scratch = Scratch(df.sparkSession, "embeddings")
    single = df.schema[vector_col].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"
    rows, own = keyed(df.select(F.col(id_col), F.col(vector_col).cast("array<float>" if single else "array<double>")
                                .alias("vector")), id_col, ["vector"])
    stored = scratch.keep(stored_rows(rows, id_col, kind))
    if not own:
        scratch.drop(rows)
    rows = scratch.keep(stored.select("_key", id_col, "digest"))
    copied = scratch.keep(rows.where("digest is not null").groupBy("digest").agg(
        F.min("_key").alias("rep"), F.count("*").alias("copies")).where("copies > 1"))
    good, one = stored.where("d > 0"), F.lit(1).cast("long")
    if copied.isEmpty():
        heads = stored
        vectors = good.select("d", F.col("_key").alias("rep"), one.alias("copies"), "vec")
    else:
        vectors = heads = scratch.keep(good.join(copied, "digest", "left").where("rep is null or rep = _key").select(
            "d", F.col("_key").alias("rep"), F.coalesce("copies", one).alias("copies"), "vec"))
        scratch.drop(stored)
    parts = []
    for d, n in sorted((r.d, r["count"]) for r in vectors.groupBy("d").count().collect()):
        of = vectors.where(F.col("d") == d)
        axes = principal_axes(of, d, kind)[:, :LEAD].copy()
        pivots = _pivots(of, n, d, kind, axes[:, 0])
        parts.append((_assign(of, d, kind, pivots, scratch), n, d, kind, axes, pivots))
    scratch.drop(heads)
    found = df.sparkSession.createDataFrame([], "rep long, links long, low long")
    for part in parts:
        found = found.unionByName(compare(*part, threshold, scratch))
    comps = components(found.select(F.col("rep").alias("u"), F.col("low").alias("v")), scratch)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    links = scratch.keep(links.join(comps.withColumnRenamed("node", "rep"), "rep", "left"))
    out = rows.join(copied, "digest", "left").select(
        "_key", id_col, F.coalesce("rep", "_key").alias("rep"), F.coalesce("copies", one).alias("copies"))
    out = out.join(links, "rep", "left").select(
        "_key", id_col, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component", "rep").alias("component"))
    return component_ids(out, rows, id_col, own).select(
        id_col, "n_links", "component_id", (F.col("component") == F.col("_key")).alias("kept"))
