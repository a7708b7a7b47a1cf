"""Exact positions and running totals in a global order, without a one-partition window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into a single task.  Here the
rows are range-partitioned on the full sort key instead (the sampled bounds include the
tie-breaking key, so even a value shared by a third of all rows is split across slices), each
slice is numbered and totalled locally, and per-slice offsets (one row per slice, a bounded
table) are broadcast back.  The slice assignment comes from sampling, so it is frozen with a
reliable checkpoint before the two branches read it; Spark deletes those files when the result is
no longer referenced if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as
:mod:`tillwise.session` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import ensure_checkpoint_dir


def ordered_slices(df: DataFrame, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """``df`` range-partitioned on the full sort key into contiguous slices, numbered ``_slice`` in
    sort order, and checkpointed so the sampled assignment is fixed for every later reader.

    Without ``slices`` AQE merges neighbouring small slices up to the advisory partition size, so the
    number of checkpoint files follows the data and not the shuffle partition setting."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return ranged.withColumn("_slice", F.spark_partition_id()).checkpoint(eager=True)


def global_order(df: DataFrame, order: Sequence[Column], sums: Sequence[str] = (),
                 slices: int | None = None, keep_slice: bool = False) -> DataFrame:
    """Add ``position`` (1-based, in ``order``, which must be total), ``n_rows`` and, for each
    column ``c`` in ``sums``, ``running_c`` (inclusive) and ``total_c``.  Runs the query behind
    ``df`` when it is called (see :func:`ordered_slices`)."""
    ranged = ordered_slices(df, order, slices)

    within = Window.partitionBy("_slice").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_pos", F.row_number().over(within))
    for c in sums:
        local = local.withColumn(f"_run_{c}", F.sum(c).over(upto))

    per_slice = ranged.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_cnt"), *[F.sum(c).alias(f"_tot_{c}") for c in sums])
    # One row per slice: a window over this table is bounded by ``slices``.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    offset_cols = [F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_pos_off"),
                   F.sum("_cnt").over(every).cast("bigint").alias("n_rows")]
    for c in sums:
        offset_cols.append(F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}"))
        offset_cols.append(F.sum(f"_tot_{c}").over(every).alias(f"total_{c}"))
    offsets = per_slice.select("_slice", *offset_cols)

    out = local.join(F.broadcast(offsets), "_slice")
    out = out.withColumn("position", (F.col("_pos") + F.col("_pos_off")).cast("bigint"))
    for c in sums:
        out = out.withColumn(f"running_{c}", F.col(f"_run_{c}") + F.col(f"_off_{c}"))
    drop = ([] if keep_slice else ["_slice"]) + ["_pos", "_pos_off"] + [f"_run_{c}" for c in sums] + [f"_off_{c}" for c in sums]
    return out.drop(*drop)


def ntile_of(position: Column, n_rows: Column, tiles: int) -> Column:
    """The ``ntile(tiles)`` bucket of a 1-based position among ``n_rows`` rows: the first
    ``n_rows mod tiles`` buckets hold one row more than the others."""
    q = F.floor(n_rows / F.lit(tiles)).cast("bigint")
    r = (n_rows - q * F.lit(tiles)).cast("bigint")
    big = r * (q + 1)
    in_big = F.floor((position - 1) / (q + 1)) + 1
    in_small = r + F.floor((position - 1 - big) / F.when(q > 0, q)) + 1
    return F.when(position <= big, in_big).otherwise(in_small).cast("bigint")


def rank_family(df: DataFrame, value: str, key: str, tiles: int = 4,
                descending: bool = True) -> DataFrame:
    """``row_number``, ``rank``, ``dense_rank``, ``ntile``, ``percent_rank`` and ``cume_dist`` of
    ``value`` over the whole frame (ties broken by ``key`` where a position is needed).

    Peers are found by aggregating on (slice, value), then on the value; dense rank is the position
    of the value in the ordered table of distinct values.  Ranks come back to the rows by slice and
    value, so a value held by a third of all rows stays spread over the slices it fills."""
    v = F.col(value).desc() if descending else F.col(value).asc()
    ordered = global_order(df, [v, F.col(key).asc()], keep_slice=True)
    per_slice = ordered.groupBy("_slice", value).agg(F.min("position").alias("_first"),
                                                     F.count(F.lit(1)).alias("_rows"))
    peers = per_slice.groupBy(value).agg(F.min("_first").alias("rank"), F.sum("_rows").alias("_peers"))
    dense = global_order(peers, [v]).select(value, "rank", "_peers", F.col("position").alias("dense_rank"))
    ranks = per_slice.select("_slice", value).join(dense, value)
    out = ordered.join(ranks, ["_slice", value])
    n = F.col("n_rows")
    return out.select(
        *[c for c in df.columns],
        F.col("position").alias("row_number"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("dense_rank").cast("bigint").alias("dense_rank"),
        ntile_of(F.col("position"), n, tiles).alias("ntile"),
        F.when(n > 1, (F.col("rank") - 1).cast("double") / (n - 1).cast("double"))
         .otherwise(F.lit(0.0)).alias("percent_rank"),
        ((F.col("rank") - 1 + F.col("_peers")).cast("double") / n.cast("double")).alias("cume_dist"),
    )
