"""Exact top-k inner products by block-at-a-time pruning (13).

A vector is read as a document whose terms are its dimensions, each with a signed impact.  Documents are
numbered along a Hilbert curve and cut into ranges, the blocks; a block has a forward index (its
documents' impacts, row by row) and, for every term, its greatest and least impact.  For a query the
summed term maxima of a block (greatest impact where the query's weight is positive, least where it is
negative) bound every score in it.  Per query and file, blocks are taken by falling bound and scored
through their forward index until the next bound falls below the k-th best score, so all later blocks are
skipped at once.  The k-th best within the query's own block is its first threshold in every file.

Queries travel to the files of blocks (see vector_blocks); each file returns at most k rows a query, which
one small window brings together.  Nothing is capped: a skipped block cannot hold a row of the result.

Odd input: null vectors and vectors with null or non-finite components take no part; empty and shorter
vectors count as padded with zeros; a null vec_id is no query, sorts last among ties and is returned as
null; rows that share a vec_id are rows of their own, so a query's own row alone is left out and its
copies are candidates.  An empty table gives an empty result.  Other columns are not read.
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

SCALE = 1_024
SLICE = 2_000   # queries whose bounds are held at a time
TOGETHER = 64   # queries that meet a block in one product

FOUND = pa.schema([("row", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64()), ("other", pa.int64())])


def search_file(part: BlockFile, row: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[Best, int]:
    """The k best other rows of ``part`` for each query, and how many (query, block) pairs were scored.

    Queries go through their own orders of blocks side by side: in each round every query that is not
    done asks for its next block, and those that ask for the same block share a product."""
    _, bound = part.scorer.bounds(q, part.low, part.high)
    order = np.argsort(~bound, axis=1, kind="stable")
    best, scored = Best(len(row), k, floor), 0
    going = np.arange(len(row))
    for step in range(len(part)):
        asked = order[going, step]
        on = bound[going, asked] >= best.floor()[going]
        going, asked = going[on], asked[on]
        if not len(going):
            break
        scored += len(going)
        for b in np.unique(asked):
            ids, _, others, vectors = part.block(b)
            ready, wants = part.scorer.ready(vectors), going[asked == b]
            for at in range(0, len(wants), TOGETHER):
                which = wants[at:at + TOGETHER]
                scores = part.scorer.dots(q[which], ready)
                scores[others[None, :] == row[which][:, None]] = NONE
                best.offer(which, scores, ids, others)
    return best, scored


def _search(folder: str, shape: Extent, k: int):
    """(file_no, row, q, floor) to the k best other rows of the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, part = Scorer(shape), None
        for rows in slices(batches, SLICE):
            numbers = rows.column(0).to_numpy()
            for number in np.unique(numbers):
                if part is None or part.number != number:
                    part = BlockFile(folder, int(number), shape, scorer)
                mine = rows.filter(pa.array(numbers == number))
                row, floor = mine.column(1).to_numpy(), mine.column(3).to_numpy()
                q = scorer.ready(vectors_of(mine.column(2), shape.dtype, shape.dim))
                at, score, ids, others = search_file(part, row, q, floor, k)[0].found()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[at], pa.int64()), pa.array(score, pa.int64()), ids_out(ids),
                     pa.array(others, pa.int64())], schema=FOUND)

    return run


def top_k(rows: DataFrame, every: int, k: int = 10, scale: int = SCALE) -> DataFrame:
    """The ``k`` best other rows of ``rows`` (vec_id, embedding) for each row whose id ``every`` divides.

    Columns: query_id, query_row (tells queries that share a vec_id apart), rank, vec_id, score."""
    folder = scratch(rows.sparkSession, "top-k-blocks")
    used = rows.select("vec_id", "embedding").where(takes_part("embedding", scale)).withColumn("label", F.lit(0))
    manifest, shape = write_blocks(used, "embedding", scale, folder)
    files = max(1, manifest.count())
    asked = materialize(queries(manifest, folder, shape, every, k), "top-k-queries")
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("file_no"), "row", "q", "floor")
    found = (sent.repartitionById(files, "file_no")
             .mapInArrow(_search(folder, shape, k), "row long, score long, vec_id long, other long"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("row", F.col("vec_id").alias("query_id")), "row").select(
        "query_id", F.col("row").alias("query_row"), "rank", "vec_id", "score")


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return top_k(rows, every=100).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""
