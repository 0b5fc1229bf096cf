"""Skew-safe keyed order statistics: running sums, states and lags per key.

``Window.partitionBy(key)`` puts every row of a key into one task.  When one
key holds a large share of the rows (a scheme with a third of all claims, one
busy application) that task becomes the whole job.  These helpers cut the
table into ordered pieces and stitch the pieces together exactly:

1. ``repartitionByRange(key, *order)`` deals the rows out by quantiles of the
   whole (key, order) tuple, so a piece is one partition whatever the values
   look like: bursts, many ties in the first order column, one key with all
   rows.  The order is unique per key, hence no tie is too large for a piece.
   The rows are written once with their piece number to the shared folder:
   the passes below read the same pieces, also after a lost executor.
2. An ordinary window over ``(key, piece)`` computes the local result.
3. Totals / last values per (key, piece) give each piece its carry-in.  Only
   a key that goes on over a boundary between two partitions has one, so the
   carry-in table has fewer rows than there are partitions: that bound is
   what allows its broadcast.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemelens.functions.semantics import checkpoint_table

PIECE = "_piece"
PIECES: int | None = None  # number of pieces; None: spark.sql.shuffle.partitions, small ones put together by AQE


def _ordcols(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def in_pieces(df: DataFrame, key: str, order: Sequence, pieces: int | None = None, position: str | None = None) -> DataFrame:
    """``df`` with its piece number, written once; pieces follow one another in (key, order).

    ``position`` names a column for numbers that rise along (key, order).
    """
    n = PIECES if pieces is None else pieces
    by = [F.col(key), *_ordcols(order)]
    dealt = df.repartitionByRange(n, *by) if n else df.repartitionByRange(*by)
    if position:
        dealt = dealt.sortWithinPartitions(*by).withColumn(position, F.monotonically_increasing_id())
    return checkpoint_table(dealt.withColumn(PIECE, F.spark_partition_id()))


def _with_carry(local: DataFrame, carry: DataFrame, key: str, *cols: str) -> DataFrame:
    """Attach the carry-in of a row's piece (fewer rows than partitions, see above); a NULL key is a key too."""
    carry = carry.select(F.col(key).alias("_ck"), F.col(PIECE).alias("_cp"), *cols)
    same = F.col(key).eqNullSafe(F.col("_ck")) & (F.col(PIECE) == F.col("_cp"))
    return local.join(F.broadcast(carry), same, "left").drop("_ck", "_cp")


def running_sum(df: DataFrame, key: str, order: Sequence, value: str | Column, out: str, inclusive: bool = True,
                pieces: int | None = None) -> DataFrame:
    """Per-key cumulative sum of ``value`` in ``order`` (the order columns must
    break ties).  ``inclusive=False`` sums the strictly earlier rows only.
    A frame from ``in_pieces`` (or a subset of its rows) keeps its pieces and
    its piece column (iterative callers)."""
    order = list(order)
    given = PIECE in df.columns
    v = F.col(value) if isinstance(value, str) else value
    base = df.withColumn("_v", v)
    p = base if given else in_pieces(base, key, order, pieces)
    zero = F.lit(0).cast(base.schema["_v"].dataType)
    w = (Window.partitionBy(key, PIECE).orderBy(*_ordcols(order))
         .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = p.withColumn("_local", F.coalesce(F.sum("_v").over(w), zero))
    totals = p.groupBy(key, PIECE).agg(F.sum("_v").alias("_tot"), F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(key).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (totals.withColumn("_off", F.sum("_tot").over(wk)).withColumn("_before", F.sum("_n").over(wk))
             .filter(F.col("_before").isNotNull()))
    res = _with_carry(local, carry, key, "_off")
    res = res.withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), zero)).drop("_v", "_local", "_off")
    return res if given else res.drop(PIECE)


def lag(df: DataFrame, key: str, order: Sequence, col: str, out: str, default=None,
        pieces: int | None = None) -> DataFrame:
    """Per-key previous value of ``col`` in ``order``; ``default`` on a key's
    first row (only when there is no predecessor at all)."""
    order = list(order)
    p = in_pieces(df, key, order, pieces)
    w = Window.partitionBy(key, PIECE).orderBy(*_ordcols(order))
    dflt = default if isinstance(default, Column) else F.lit(default)
    local = p.withColumn("_lag", F.lag(col).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = p.groupBy(key, PIECE).agg(F.max_by(F.struct(F.col(col).alias("x")), F.struct(*_ordcols(order))).alias("_last"))
    wk = Window.partitionBy(key).orderBy(PIECE)
    carry = last.withColumn("_prev", F.lag("_last").over(wk)).filter(F.col("_prev").isNotNull())
    res = _with_carry(local, carry, key, "_prev")
    value = (F.when(~F.col("_first"), F.col("_lag")).when(F.col("_prev").isNotNull(), F.col("_prev.x"))
             .otherwise(dflt))
    return res.withColumn(out, value).drop("_lag", "_first", "_prev", PIECE)


def running_state(df: DataFrame, key: str, order: Sequence, move: str | Column, out: str, pieces: int | None = None) -> DataFrame:
    """Per key, the state that the strictly earlier rows have led to; NULL while the key is still open.

    The machine starts open and stays where it first goes: ``move`` is the state a
    row takes an open key to, NULL where the row leaves it open.  Such a row is a
    map of states (open -> move, any other state -> itself), and maps of this
    kind compose to one of the same kind: the first move that is not NULL.  So a
    piece, like a row, is one map, and the carry-in of a piece is the composition
    of the maps of the pieces before it.  Keys, pieces and ties as in ``running_sum``.
    """
    order = list(order)
    given = PIECE in df.columns
    base = df.withColumn("_m", F.col(move) if isinstance(move, str) else move)
    p = base if given else in_pieces(base, key, order, pieces)
    w = Window.partitionBy(key, PIECE).orderBy(*_ordcols(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = p.withColumn("_local", F.first("_m", ignorenulls=True).over(w))
    maps = p.groupBy(key, PIECE).agg(
        F.min_by(F.col("_m"), F.when(F.col("_m").isNotNull(), F.struct(*_ordcols(order)))).alias("_map"))
    wk = Window.partitionBy(key).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = maps.withColumn("_in", F.first("_map", ignorenulls=True).over(wk)).filter(F.col("_in").isNotNull())
    res = _with_carry(local, carry, key, "_in")
    res = res.withColumn(out, F.coalesce("_in", "_local")).drop("_m", "_local", "_in")
    return res if given else res.drop(PIECE)
