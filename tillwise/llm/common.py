"""Helpers shared by the corpus operators: text folding, intermediate tables, id ranges, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Rows of a proven table that may be broadcast; beyond it the join is left to the shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` serves the all-ASCII texts, where both agree."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(*cols: str) -> Column:
    """A non-null join key of a row's own content, so null and repeated ids need no special case."""
    return F.xxhash64(*[F.col(c) for c in cols])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Small views of the batches, so that a task turns few texts at a time into Python objects; after
    each batch what Arrow holds unused goes back, as workers live on into later stages."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later steps (and retries after a
    lost executor) start from files instead of recomputing it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a materialised table only if its exact row count is within ``limit``; otherwise
    the same join runs as a shuffled join, which AQE splits on skew."""
    return F.broadcast(df) if df.count() <= limit else df


def id_bounds(df: DataFrame, column: str, buckets: int) -> list[int]:
    """At most ``buckets - 1`` ascending split points of an integer column (approximate quantiles of
    all its rows); the driver holds only these.  Empty for an empty or all-null column."""
    if buckets < 2:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    found = df.select(F.col(column).cast("double").alias("v")).approxQuantile("v", probs, 0.1 / buckets)
    return sorted({int(v) for v in found})


def bucket_of(value: Column, bounds: list[int]) -> Column:
    """Ordered range bucket of an integer: the number of split points at or below it.  Null gives 0,
    so null ids sort with the smallest."""
    if not bounds:
        return F.lit(0)
    points = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.coalesce(F.size(F.filter(points, lambda p: p <= value)), F.lit(0))


def range_starts(df: DataFrame, column: str, ranges: int) -> list[int]:
    """Ascending first values of at most ``ranges`` contiguous ranges of an integer column, but for the
    first range: Spark deals the column alone into ranges, and the driver holds their smallest values."""
    if ranges < 2:
        return []
    dealt = df.select(column).where(F.col(column).isNotNull()).repartitionByRange(ranges, column)
    least = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(column).alias("least")).collect()
    return sorted({r.least for r in least})[1:]


def range_of(ids: pa.Array, starts: np.ndarray) -> np.ndarray:
    """The number of each id's range (null: the first), by binary search."""
    return np.searchsorted(starts, pc.fill_null(ids, -(1 << 63)).to_numpy(zero_copy_only=False), "right").astype(np.int32)


def range_number(column: str, starts: list[int]) -> Column:
    """:func:`range_of` as a column; only the ids go to Python."""
    points = np.asarray(starts, np.int64)
    return F.arrow_udf(lambda ids: pa.array(range_of(ids, points), pa.int32()), "int")(F.col(column).cast("long"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every vertex of an undirected graph ``(a, b)``: rows (id, root).

    Each round every vertex takes the smallest label around it and every label is then replaced by
    the label of the vertex it names (pointer jumping), so a path of n vertices needs about log n
    rounds.  Labels only meet their vertex by equi-joins on ids; the join sides are pre-aggregated
    minima, and a vertex with very many neighbours is split by AQE like any skewed join.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.first("a")).alias("root")), "cc-labels")
    for _ in range(max_rounds):
        near = (both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("nid"))
                .agg(F.min("root").alias("near")))
        taken = (labels.join(near, labels.id == F.col("nid"))
                 .select("id", "root", F.least("root", "near").alias("low")))
        # A vertex's old root learns of the smaller label too (hooking), then labels jump.
        hooks = (taken.where("low < root").groupBy(F.col("root").alias("hid"))
                 .agg(F.min("low").alias("hook")))
        hooked = (taken.join(hooks, taken.id == F.col("hid"), "left")
                  .select("id", "root", F.least("low", F.coalesce("hook", "low")).alias("low")))
        hooked = materialize(hooked, "cc-hooked")
        jump = hooked.select(F.col("id").alias("jid"), F.col("low").alias("jump"))
        new = materialize(hooked.join(jump, hooked.low == F.col("jid"), "left")
                          .select("id", F.col("root").alias("old"),
                                  F.least("low", F.coalesce("jump", "low")).alias("root")), "cc-labels")
        labels = new.select("id", "root")
        if new.where("root <> old").limit(1).count() == 0:
            return labels
    raise RuntimeError("components did not settle")
