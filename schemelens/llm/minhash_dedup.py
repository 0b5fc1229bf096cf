"""Near-duplicate documents by b-bit MinHash (operator 4).

1. Every whole text becomes the set of its distinct shingles of ``width`` words (four
   in the operator's own query, five in the pipeline's stage), and
   copies (same words in order) form classes with one representative each.
2. ``MINIMA`` minima are taken per set, in bands (``tuned``).  The full minima of a band, hashed,
   are its bucket; only the low ``BITS`` bits of each minimum are kept, packed into 64-bit
   words, as the signature.  Buckets are given up as soon as their members are known.
3. All members of a bucket are compared with its smallest member, the centre.
   Two signatures are compared by exclusive or and a count of bits.  A pair is
   tested further if its similarity, estimated from the number of equal values
   less the share 2**-BITS that agree by chance, is not 4.9 standard deviations
   or more below the threshold, and linked if the full shingle sets say so.
4. Members that met the same centre and are still of different components are
   compared in pairs of blocks: those outside the centre's component with all
   others.  Signatures go first and hand on only the members that have a
   likely partner; their full shingle sets then give one spanning forest a
   pair of blocks.  So no bucket is cut, no link between components is left
   out, and no pairs of members are ever rows.

A pair at the threshold p shares no bucket with probability
(1 - p**rows)**bands, below 1e-6; more similar pairs far less often.  Bands and
the estimate's bound follow the threshold: 48 bands of 6 minima and 0.68 at 0.8.

Results on odd input: null texts and texts without words have no shingles and
link with nothing; fewer than ``width`` words are one shingle; texts of any length
are read whole; rows that repeat an id are documents of their own (same
component_id rules); rows without an id come last, and a class of such rows alone has
a null component_id; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import Scratch, component_ids, keyed, map_batches
from schemelens.llm.components import components, forest
from schemelens.llm.shingles import shingle_set, words

MINIMA = 288
#: Share of the pairs at the threshold that may meet in no bucket.
MISSED = 1e-6
#: Bits kept of each minimum, and minima in a 64-bit word of the signature.
BITS = 4
A_WORD = 64 // BITS
#: One bit of each minimum in a word.
ONES = np.uint64(sum(1 << BITS * i for i in range(A_WORD)))
#: 64-bit words of the filter of buckets with several members (one bit a bucket; 2 MB when it is broadcast).
FILTER_WORDS = 1 << 17
THRESHOLD = 80  # percent
#: Words in a shingle unless a caller says otherwise.
WIDTH = 4
#: Members in one block of signatures, and shingles in one block of full sets.
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 1 << 17

_MUL = np.random.default_rng(2024).integers(0, 2**32, MINIMA, dtype=np.uint32) | np.uint32(1)
_ADD = np.random.default_rng(2025).integers(0, 2**32, MINIMA, dtype=np.uint32)
_STEP = 2048


class Tuning(NamedTuple):
    percent: int
    bands: int
    rows: int  # minima in a band
    least: float  # estimated similarity from which pairs are tested further


def tuned(percent: int) -> Tuning:
    """The longest bands that miss at most ``MISSED`` of the pairs at the threshold, and the estimate's bound."""
    p = percent / 100
    fit = [r for r in range(1, MINIMA + 1) if MINIMA % r == 0 and (1 - p**r) ** (MINIMA // r) <= MISSED]
    if not fit or p > 1:
        raise ValueError(f"no {MINIMA} minima find the pairs at {percent} percent")
    least = np.floor(100 * (p - 5 * np.sqrt(p * (1 - p) / MINIMA))) / 100
    return Tuning(percent, MINIMA // fit[-1], fit[-1], float(least))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(_MUL), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), _STEP):
        part = x[None, at:at + _STEP] * _MUL[:, None]
        part += _ADD[:, None]
        np.minimum(low, part.min(1), out=low)
    return low


def band_keys(low: np.ndarray, tuning: Tuning) -> list[int]:
    """One 64-bit bucket number a band."""
    raw = low.tobytes()
    size = 4 * tuning.rows
    return [xxhash.xxh3_64_intdigest(raw[i * size:(i + 1) * size], seed=i) - (1 << 63) for i in range(tuning.bands)]


def pack_bits(low: np.ndarray) -> bytes:
    """The low BITS bits of each minimum, A_WORD of them in one 64-bit word."""
    kept = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, A_WORD)
    return np.bitwise_or.reduce(kept << (np.arange(A_WORD, dtype=np.uint64) * np.uint64(BITS)), axis=1).tobytes()


def unpack(signatures: list[bytes]) -> np.ndarray:
    """Signatures as rows of 64-bit words."""
    return np.frombuffer(b"".join(signatures), np.uint64).reshape(len(signatures), -1)


def unequal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the packed minima differ, by the bits that exclusive or leaves."""
    differ = a ^ b
    shift = 1
    while shift < BITS:  # any bit of a minimum to its lowest one
        differ = differ | differ >> np.uint64(shift)
        shift *= 2
    return np.bitwise_count(differ & ONES).sum(axis=-1, dtype=np.int64)


def describe(rows: DataFrame, width: int, tuning: Tuning) -> DataFrame:
    """(_key, n_shingles, words_hash, buckets, signature); the last three are null for empty sets."""
    def run(batch):
        n, whole, bands, sigs = [], [], [], []
        for t in batch.column(1).to_pylist():
            w = words(t) if t else []
            if not w:
                n.append(0), whole.append(None), bands.append(None), sigs.append(None)
                continue
            s = shingle_set(w, width)
            low = minima(s)
            n.append(len(s)), whole.append(xxhash.xxh3_128_digest(b" ".join(w)))
            bands.append(band_keys(low, tuning)), sigs.append(pack_bits(low))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(whole, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
            names=["_key", "n_shingles", "words_hash", "buckets", "signature"])

    return map_batches(rows, run, "_key long, n_shingles long, words_hash binary, buckets array<long>, signature binary")


def shingle_rows(rows: DataFrame, width: int) -> DataFrame:
    """(_key, shingles array<long>) of each row's whole text."""
    def run(batch):
        sets = [shingle_set(words(t), width).view(np.int64) for t in batch.column(1).to_pylist()]
        ends = pa.array(np.cumsum([0] + [len(s) for s in sets]).astype(np.int32))
        flat = pa.array(np.concatenate(sets)) if sets else pa.array([], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)],
                                         names=["_key", "shingles"])

    return map_batches(rows, run, "_key long, shingles array<long>")


def estimate(pairs: DataFrame, least: float) -> DataFrame:
    """Rows of ``pairs`` (a, b, sig_a, sig_b) whose collision-corrected similarity may reach the threshold."""
    chance = 2.0 ** -BITS

    def run(batch):
        if not batch.num_rows:
            return
        sa, sb = (unpack(batch.column(i).to_pylist()) for i in (2, 3))
        share = 1.0 - unequal(sa, sb) / MINIMA
        keep = (share - chance) / (1 - chance) >= least
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    return map_batches(pairs, run, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the pairs whose full shingle sets are similar enough."""
    a = sets.select(F.col("_key").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("_key").alias("b"), F.col("shingles").alias("sb"))
    same = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b").withColumn("same", same)
            .where(100 * F.col("same") >= percent * (F.size("sa") + F.size("sb") - F.col("same")))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _block_pairs(members: DataFrame, payload: str, per_block: int, weight, scratch: Scratch) -> DataFrame:
    """(a, b): blocks of members (_key, component, payload) that met one centre; every member outside the centre's
    component meets every other member once.  ``members``: centre, _key, component, outside, payload."""
    total = lambda cond: F.ceil(F.sum(F.when(cond, weight)) / per_block).cast("int")
    counts = scratch.keep(members.groupBy("centre").agg(
        total(F.col("outside")).alias("n_out"), F.coalesce(total(~F.col("outside")), F.lit(0)).alias("n_in"),
        F.count("*").alias("n")).where("n > 1 and n_out > 0").drop("n"))
    of = F.when(F.col("outside"), F.col("n_out")).otherwise(F.col("n_in"))
    blocks = (members.join(counts, "centre").withColumn("block", F.pmod(F.xxhash64("_key"), of).cast("int"))
              .groupBy("centre", "outside", "block", "n_out", "n_in")
              .agg(F.collect_list(F.struct("_key", "component", payload)).alias("rows")))
    blocks = scratch.keep(blocks)
    met = F.explode(F.concat(
        F.transform(F.sequence("block", F.col("n_out") - 1), lambda i: F.struct(F.lit(True).alias("o"), i.alias("i"))),
        F.when(F.col("n_in") > 0, F.transform(F.sequence(F.lit(0), F.col("n_in") - 1),
                                              lambda i: F.struct(F.lit(False).alias("o"), i.alias("i"))))
        .otherwise(F.array().cast("array<struct<o:boolean,i:int>>"))))
    a = blocks.where("outside").select("centre", F.col("rows").alias("a"), met.alias("other")).select(
        "centre", "a", F.col("other.o").alias("outside"), F.col("other.i").alias("block"))
    b = blocks.select("centre", "outside", "block", F.col("rows").alias("b"))
    return a.join(b, ["centre", "outside", "block"]).select("centre", "a", "b")


def _columns(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    values = rows.values
    return values.field(0).to_numpy(), values.field(1).to_numpy(), values.field(2)


def likely_members(pairs: DataFrame, least_estimate: float) -> DataFrame:
    """(centre, _key) of the members that have a likely partner of another component, by signatures."""
    chance = 2.0 ** -BITS
    least = int(np.ceil((least_estimate * (1 - chance) + chance) * MINIMA))

    def run(batches):
        for batch in batches:
            for centre, a, b in zip(*batch.columns):
                (ka, ca, sa), (kb, cb, sb) = _columns(a), _columns(b)
                sa, sb = unpack(sa.to_pylist()), unpack(sb.to_pylist())
                in_a, in_b = np.zeros(len(ka), bool), np.zeros(len(kb), bool)
                for i in range(len(ka)):
                    near = (MINIMA - unequal(sb, sa[i]) >= least) & (cb != ca[i])
                    in_a[i] = near.any()
                    in_b |= near
                keys = np.unique(np.concatenate((ka[in_a], kb[in_b])))
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array([centre.as_py()] * len(keys), pa.int64()),
                                                      pa.array(keys)], names=["centre", "_key"])

    return pairs.mapInArrow(run, "centre long, _key long").distinct()


def _shared(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Sizes of the intersections of the sets ``a`` with the sets ``b``."""
    na, nb = (np.diff(x.offsets.to_numpy()) for x in (a, b))
    ea, eb = a.flatten().to_numpy(), b.flatten().to_numpy()
    both = np.intersect1d(ea, eb)
    ra, rb = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    out = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(both), 4096):
        part = both[at:at + 4096]
        dense = []
        for e, r, n in ((ea, ra, len(a)), (eb, rb, len(b))):
            i = np.minimum(np.searchsorted(part, e), len(part) - 1)
            hit = part[i] == e
            m = np.zeros((n, len(part)), np.float32)
            m[r[hit], i[hit]] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def exact_links(pairs: DataFrame, percent: int) -> DataFrame:
    """(u, v) of a spanning forest of the links between the full sets of each pair of blocks."""
    def run(batches):
        for batch in batches:
            for _, a, b in zip(*batch.columns):
                (ka, ca, sa), (kb, cb, sb) = _columns(a), _columns(b)
                same = _shared(sa, sb)
                na, nb = np.diff(sa.offsets.to_numpy()), np.diff(sb.offsets.to_numpy())
                m = (100 * same >= percent * (na[:, None] + nb[None, :] - same)) & (ca[:, None] != cb[None, :])
                if m.any():
                    low_a, low_b = forest(m, ka, kb)
                    u, v = np.concatenate((ka, kb)), np.concatenate((low_a, low_b))
                    yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def crowded(bands: DataFrame, crowd: DataFrame) -> DataFrame:
    """The rows of ``bands`` whose bucket may be one of ``crowd``: a filter of FILTER_WORDS words, whatever the data."""
    word = F.pmod(F.col("bucket"), F.lit(FILTER_WORDS)).cast("int").alias("word")
    bit = F.shiftrightunsigned("bucket", 58).cast("int").alias("bit")
    filled = crowd.select(word, bit).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    return (bands.select("*", word, bit).join(F.broadcast(filled), "word").where(F.getbit("bits", F.col("bit")) == 1)
            .drop("word", "bit", "bits"))


def members_of_buckets(buckets: DataFrame, scratch: Scratch) -> DataFrame:
    """(centre, _key): each other member of a bucket with its smallest one."""
    bands = buckets.select("_key", F.explode("buckets").alias("bucket"))
    crowd = scratch.keep(bands.groupBy("bucket").agg(F.min("_key").alias("centre"), F.count("*").alias("n"))
                         .where("n > 1").drop("n"))
    met = scratch.keep(crowded(bands, crowd).join(crowd, "bucket").where("_key <> centre")
                       .select("centre", "_key").distinct())
    scratch.drop(crowd)
    return met


def link_classes(met: DataFrame, signed: DataFrame, texts: DataFrame, scratch: Scratch, tuning: Tuning,
                 width: int) -> DataFrame:
    """(node, component) of the representatives ``signed`` (_key, signature) that are linked with another one."""
    # the centres of all buckets against the members they met
    known = met.select("_key").union(met.select("centre")).distinct()
    signatures = scratch.keep(signed.join(known, "_key", "left_semi"))
    sig_a = signatures.select(F.col("_key").alias("a"), F.col("signature").alias("sig_a"))
    sig_b = signatures.select(F.col("_key").alias("b"), F.col("signature").alias("sig_b"))
    pairs = met.select(F.col("centre").alias("a"), F.col("_key").alias("b"))
    near = scratch.keep(estimate(pairs.join(sig_a, "a").join(sig_b, "b").select("a", "b", "sig_a", "sig_b"),
                                 tuning.least))
    near_sets = _sets(texts, near.select(F.explode(F.array("a", "b")).alias("_key")), scratch, width)
    linked = scratch.keep(confirm(near, near_sets, tuning.percent))
    comps = scratch.keep(components(linked, scratch))
    # members of several components that met one centre, in blocks
    of_member = comps.select(F.col("node").alias("_key"), "component")
    of_centre = comps.select(F.col("node").alias("centre"), F.col("component").alias("own"))
    members = met.join(of_member, "_key", "left").join(of_centre, "centre", "left").select(
        "centre", "_key", F.coalesce("component", "_key").alias("component"), F.coalesce("own", "centre").alias("own"))
    members = scratch.keep(members.withColumn("outside", F.col("component") != F.col("own")).drop("own"))
    likely = scratch.keep(likely_members(_block_pairs(members.join(signatures, "_key"), "signature", BLOCK_MEMBERS, F.lit(1), scratch),
                                         tuning.least))
    sets = _sets(texts, likely.select("_key"), scratch, width)
    whole = members.join(likely, ["centre", "_key"]).join(sets, "_key")
    more = scratch.keep(exact_links(
        _block_pairs(whole, "shingles", BLOCK_SHINGLES, F.size("shingles"), scratch), tuning.percent))
    star = comps.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v")
    return comps if more.isEmpty() else scratch.keep(components(star.unionByName(more), scratch))


def _sets(texts: DataFrame, keys: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    return scratch.keep(shingle_rows(texts.join(keys.distinct(), "_key", "left_semi"), width))


def _classify(rows: DataFrame, percent: int, width: int) -> DataFrame:
    """(_key, n_shingles, component) of each row (_key, text)."""
    scratch, tuning = Scratch(rows.sparkSession, "minhash"), tuned(percent)
    described = scratch.keep(describe(rows, width, tuning))
    classes = scratch.keep(described.where("words_hash is not null").groupBy("words_hash").agg(
        F.min("_key").alias("rep"), F.count("*").alias("copies")))
    reps = scratch.keep(described.join(classes.select(F.col("rep").alias("_key")), "_key", "left_semi").select(
        "_key", "buckets", "signature"))
    found = scratch.keep(described.select("_key", "n_shingles", "words_hash"))
    scratch.drop(described)
    met = members_of_buckets(reps, scratch)
    signed = scratch.keep(reps.select("_key", "signature"))
    scratch.drop(reps)
    comps = link_classes(met, signed, rows, scratch, tuning, width)
    of_class = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "words_hash", F.coalesce("component", "rep").alias("component"), "rep", "copies")
    # only classes that say more than the row itself does
    of_class = scratch.keep(of_class.where("copies > 1 or component <> rep").select("words_hash", "component"))
    out = found.join(of_class, "words_hash", "left")
    return out.select("_key", "n_shingles", F.coalesce("component", "_key").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row."""
    rows, own = keyed(df.select(F.col(id_col), F.col(text_col).cast("string").alias("text")), id_col, ["text"])
    found = _classify(rows.select("_key", "text"), percent, width)
    result = component_ids(found, rows, id_col, own).select(
        "_key", "n_shingles", "component_id", (F.col("component") == F.col("_key")).alias("kept"))
    if own:
        return result.withColumnRenamed("_key", id_col)
    return result.join(rows.select("_key", id_col), "_key").select(id_col, "n_shingles", "component_id", "kept")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = THRESHOLD,
                width: int = WIDTH) -> DataFrame:
    """The rows of ``df``, all columns, of which one of each component stays."""
    rows, _ = keyed(df.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                              F.col(text_col).cast("string").alias("text")), "_id", ["text"])
    found = _classify(rows.select("_key", "text"), percent, width)
    kept = found.where(F.col("component") == F.col("_key")).select("_key")
    return rows.select("_key", "_row").join(kept, "_key", "left_semi").select("_row.*")
