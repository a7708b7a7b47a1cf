"""Hard negatives from Hilbert-ordered blocks with zone maps (11).

All rows are written once, in order of label and place on a Hilbert curve through their vectors, to
Parquet files whose row groups are the blocks; each block has a zone map: the smallest and largest value
of every dimension and of the label.  Two searches follow, both of every anchor against every file:

1. positives: the best rows of the anchor's label, from the files that hold the label;
2. negatives: for every positive a window of scores, and the best rows of other labels within it.

In both, interval arithmetic on a block's zone map bounds the anchor's inner product with any of its
rows from below and above.  A block is read only if some anchor at hand can still gain from it: its
label fits, its upper bound reaches the anchor's k-th best so far (at first, the k-th best within the
anchor's own block), and its interval meets one of the anchor's windows.  Blocks are taken by falling
upper bound.  Every anchor keeps k rows per file, and the files' rows meet in one small window.  Nothing
is capped: what the bounds exclude cannot be in the result.

Anchors travel to the files, not rows to anchors, so traffic is anchors times files (of FILE_BYTES) and
no task holds more than a file, a slice of anchors and their scores for one block.

Odd input: null labels, null vectors and vectors with null or non-finite components take no part; empty
and shorter vectors count as padded with zeros; a null vec_id is no anchor, sorts last among ties and is
returned as null; rows that share a vec_id are rows of their own (each an anchor, each other's
candidates).  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import materialize, scratch, slices, table
from tillwise.llm.vector_blocks import (
    NONE, Best, BlockFile, Extent, Scorer, ids_out, queries, takes_part, vectors_of, write_blocks,
)

SCALE = 256
SLICE = 512   # anchors scored together against one block

FOUND = pa.schema([("row", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64()),
                   ("other", pa.int64())])
FOUND_SQL = "row long, slot int, score long, vec_id long, other long"


def _found(rows: np.ndarray, bests: list[Best]) -> pa.RecordBatch:
    parts = [(rows[q], np.full(len(q), slot), s, i, r) for slot, best in enumerate(bests)
             for q, s, i, r in [best.found()]]
    row, slot, score, ids, other = (np.concatenate(c) for c in zip(*parts))
    return pa.RecordBatch.from_arrays(
        [pa.array(row, pa.int64()), pa.array(slot, pa.int32()), pa.array(score, pa.int64()), ids_out(ids),
         pa.array(other, pa.int64())], schema=FOUND)


def _by_file(batches: Iterator[pa.RecordBatch], folder: str, shape: Extent
             ) -> Iterator[tuple[BlockFile, pa.RecordBatch]]:
    """Slices of query rows (file_no first), each with its open file."""
    scorer, part = Scorer(shape), None
    for rows in slices(batches, SLICE):
        numbers = rows.column(0).to_numpy()
        for number in np.unique(numbers):
            if part is None or part.number != number:
                part = BlockFile(folder, int(number), shape, scorer)
            yield part, rows.filter(pa.array(numbers == number))


def _positives(folder: str, shape: Extent, k: int):
    """(file_no, row, label, q, floor) to the k best other rows of the label in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_file(batches, folder, shape):
            row, label, floor = (rows.column(c).to_numpy() for c in (1, 2, 4))
            q = part.scorer.ready(vectors_of(rows.column(3), shape.dtype, shape.dim))
            _, high = part.scorer.bounds(q, part.low, part.high)
            fits = (part.labels[:, 0] <= label[:, None]) & (label[:, None] <= part.labels[:, 1])
            best = Best(len(row), k, floor)
            for b in np.argsort(-high.max(axis=0, initial=NONE + 1), kind="stable"):
                which = np.nonzero(fits[:, b] & (high[:, b] >= best.floor()))[0]
                if not len(which):
                    continue
                ids, labels, others, vectors = part.block(b)
                scores = part.scorer.dots(q[which], part.scorer.ready(vectors))
                scores[(labels[None, :] != label[which][:, None]) | (others[None, :] == row[which][:, None])] = NONE
                best.offer(which, scores, ids, others)
            yield _found(row, [best])

    return run


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole score n with low% of ``score`` <= n <= high% of it, without overflow."""
    def share(percent: int, up: bool) -> np.ndarray:
        whole, rest = score // 100 * percent, score % 100 * percent
        return whole + (-(-rest // 100) if up else rest // 100)
    return share(low, True), share(high, False)


def _negatives(folder: str, shape: Extent, k: int, low: int, high: int):
    """(file_no, row, label, q, scores of the positives) to the k best rows of other labels in the file
    within each positive's window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_file(batches, folder, shape):
            row, label = (rows.column(c).to_numpy() for c in (1, 2))
            q = part.scorer.ready(vectors_of(rows.column(3), shape.dtype, shape.dim))
            sizes = np.asarray(rows.column(4).value_lengths())
            slots = int(sizes.max(initial=0))
            least, most = np.full((len(row), slots), 1), np.full((len(row), slots), 0)
            there = np.arange(slots)[None, :] < sizes[:, None]
            least[there], most[there] = window_of(np.asarray(rows.column(4).flatten()), low, high)
            bests = [Best(len(row), k, least[:, s]) for s in range(slots)]
            under, over = part.scorer.bounds(q, part.low, part.high)
            other = ~((part.labels[:, 0] == part.labels[:, 1]) & (part.labels[:, 0] == label[:, None]))
            for b in np.argsort(-over.max(axis=0, initial=NONE + 1), kind="stable"):
                gains = np.array([other[:, b] & (least[:, s] <= most[:, s]) & (under[:, b] <= most[:, s])
                                  & (over[:, b] >= best.floor()) for s, best in enumerate(bests)]).reshape(slots, -1)
                which = np.nonzero(gains.any(axis=0))[0]
                if not len(which):
                    continue
                ids, labels, others, vectors = part.block(b)
                scores = part.scorer.dots(q[which], part.scorer.ready(vectors))
                scores[labels[None, :] == label[which][:, None]] = NONE
                for s, best in enumerate(bests):
                    mine = gains[s][which]
                    if mine.any():
                        own = scores[mine]
                        best.offer(which[mine], np.where(own <= most[which[mine], s][:, None], own, NONE), ids, others)
            if slots:
                yield _found(row, bests)

    return run


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best per (row, slot) of what the files found, with ``rank`` from 1."""
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int, positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, scale: int = SCALE) -> DataFrame:
    """Hard negatives of ``rows`` (vec_id, label, embedding): for each anchor (its id divisible by
    ``every``) and each of its ``positives`` best rows of the label, the ``negatives`` best rows of other
    labels that score between ``low``% and ``high``% of the positive.

    Columns: anchor_id, anchor_row, positive_id, positive_rank, positive_score, rank, negative_id,
    negative_score; ``anchor_row`` tells anchors that share a vec_id apart."""
    spark = rows.sparkSession
    folder = scratch(spark, "negative-blocks")
    used = rows.select("vec_id", "label", "embedding").where(F.col("label").isNotNull() & takes_part("embedding", scale))
    manifest, shape = write_blocks(used, "embedding", scale, folder)
    files = max(1, manifest.count())
    anchors = materialize(queries(manifest, folder, shape, every, positives, of_label=True), "negative-anchors")

    # Positives: only the files that hold the anchor's label.
    holds = manifest.select("file_no", F.explode("labels").alias("label"))
    sent = anchors.join(holds, "label").select("file_no", "row", "label", "q", "floor")
    found = (sent.repartitionById(files, "file_no")
             .mapInArrow(_positives(folder, shape, positives), FOUND_SQL))
    near = materialize(best_of(found, positives).select(
        "row", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "negative-positives")

    # Negatives: every file, with the windows of all the anchor's positives.
    scores = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("p"))
    windows = anchors.join(scores, "row").select("row", "label", "q", F.col("p.positive_score").alias("scores"))
    sent = windows.select(F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("file_no"), "row", "label", "q", "scores")
    found = (sent.repartitionById(files, "file_no")
             .mapInArrow(_negatives(folder, shape, negatives, low, high), FOUND_SQL))
    hard = best_of(found, negatives).select(
        "row", (F.col("slot") + 1).alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return hard.join(near, ["row", "positive_rank"]).join(named, "row").select(
        "anchor_id", F.col("row").alias("anchor_row"), "positive_id", "positive_rank", "positive_score",
        "rank", "negative_id", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives(rows, every=50).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3
"""
