"""Integer vectors in curve order, in Parquet files of small blocks with a zone map each.

A file holds the rows of one slice of the global order; a row group is a block.  The zone map of a
block (smallest and largest value of every dimension, smallest and largest label) stands in the file's
footer, so a search reads the footer, bounds the inner product of a query with any row of the block by
interval arithmetic, and reads only the row groups that the bounds cannot exclude.  Files are written
under temporary names and renamed; a task that is run again writes the same bytes.

Rows take part if their vector is there and has no null and no component that is not finite once
multiplied by the scale.  Shorter vectors count as padded with zeros.  Inner products are exact: as
doubles while they stay below 2**53, as 64-bit integers below 2**62, as Python integers beyond, where
scores that a long cannot hold saturate.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import materialize, slices
from tillwise.llm.files import AtomicFile, filesystem

NONE = np.iinfo(np.int64).min      # the score of a row that does not count
NO_ID = np.iinfo(np.int64).max     # stands for a null id, which sorts last
BLOCK_BYTES = 1 << 18              # vectors of a block
FILE_BYTES = 128 << 20             # vectors of a file
FILE_ROWS = 16_384  # rows below which a file is not split for the cores


def takes_part(vector: str, scale: int) -> Column:
    """Whether a row's vector is there and finite in every component, also once scaled."""
    limit = F.lit(float("inf"))
    return F.coalesce(F.col(vector).isNotNull()
                      & F.forall(vector, lambda c: F.abs(c.cast("double") * F.lit(float(scale))) < limit), F.lit(False))


def floors(vectors: pa.Array, scale: int, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)`` of a list array as doubles (whole numbers), padded with zeros, and the lengths."""
    sizes = np.asarray(vectors.value_lengths()).astype(np.int64)
    flat = np.floor(np.asarray(vectors.flatten()).astype(np.float64) * scale)
    width = int(sizes.max(initial=0)) if dim is None else dim
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width), sizes
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out, sizes


@dataclass(frozen=True)
class Extent:
    """Rows, and the smallest and largest scaled value of every dimension: bounded by the dimensions."""

    rows: int
    low: np.ndarray
    high: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.low)

    @property
    def largest(self) -> int:
        return int(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0)))

    @property
    def dtype(self) -> np.dtype:
        """The smallest type that holds every value; whole doubles beyond 32 bits."""
        for kind in ("<i1", "<i2", "<i4"):
            if self.largest < np.iinfo(kind).max:
                return np.dtype(kind)
        return np.dtype("<f8")


def extent(df: DataFrame, vector: str, scale: int) -> Extent:
    """The extent of rows that take part, reduced in the tasks and then per dimension."""
    schema = pa.schema([("dim", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n, rows = np.zeros(0), np.zeros(0), np.zeros(0, np.int64), 0
        for part in slices(batches, 2_000):
            values, sizes = floors(part.column(0), scale)
            rows += len(sizes)
            if values.shape[1] > len(low):
                more = values.shape[1] - len(low)
                low, high = np.append(low, np.full(more, np.inf)), np.append(high, np.full(more, -np.inf))
                n = np.append(n, np.zeros(more, np.int64))
            if len(sizes):
                w = values.shape[1]
                low[:w], high[:w] = np.minimum(low[:w], values.min(axis=0)), np.maximum(high[:w], values.max(axis=0))
                n[:w] += (np.arange(w)[None, :] < sizes[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(low)), pa.int32()), pa.array(np.append(0.0, low)),
             pa.array(np.append(0.0, high)), pa.array(np.append(rows, n))], schema=schema)

    found = (df.select(vector).mapInArrow(run, "dim int, low double, high double, n long")
             .groupBy("dim").agg(F.min("low"), F.max("high"), F.sum("n")).orderBy("dim").collect())
    rows = found[0][3] if found else 0
    short = np.array([r[3] < rows for r in found[1:]], bool)
    low, high = (np.array([r[c] for r in found[1:]], np.float64) for c in (1, 2))
    return Extent(rows, np.where(short, np.minimum(low, 0), low), np.where(short, np.maximum(high, 0), high))


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Positions of grid cells (rows of ``bits``-bit whole numbers) on the Hilbert curve, as bytes that
    sort in curve order.  The axes are rotated and Gray-coded in place, all rows at a time."""
    x = np.ascontiguousarray(cells.T.astype(np.uint32))
    if not len(x):
        return [b""] * cells.shape[0]
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for axis in x:
            up = (axis & bit) != 0
            swap = np.where(up, np.uint32(0), (x[0] ^ axis) & below)
            x[0] ^= np.where(up, below, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << level) != 0, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    packed = np.packbits(((x[None, :, :] >> levels[:, None, None]) & 1).reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def curve_bits(dim: int) -> int:
    return max(1, min(8, -(-128 // max(1, dim))))


def _place(shape: Extent, scale: int):
    """Rows (vec_id, label, vector) to (vec_id, label, curve, q): key on the curve, scaled vector."""
    bits = curve_bits(shape.dim)
    span = np.where(shape.high > shape.low, shape.high - shape.low, 1.0)
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("curve", pa.binary()), ("q", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2_000):
            values, _ = floors(part.column(2), scale, shape.dim)
            cells = np.minimum((values - shape.low) / span * (1 << bits), (1 << bits) - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(hilbert_keys(cells, bits), pa.binary()),
                 pa.array([v.tobytes() for v in values.astype(shape.dtype)], pa.binary())], schema=schema)

    return run


def vectors_of(column: pa.Array, dtype: np.dtype, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), dim)


def _write(folder: str, dtype: np.dtype, dim: int):
    rows = max(16, min(1_024, BLOCK_BYTES // max(1, dim * dtype.itemsize)))
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.binary())])
    manifest = pa.schema([("file_no", pa.int32()), ("rows", pa.int64()), ("labels", pa.list_(pa.int64()))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            while len(batch):
                piece = batch.slice(0, rows - n)
                held, n, batch = held + [piece], n + len(piece), batch.slice(len(piece))
                if n == rows:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        out = AtomicFile(folder, block_file(number))
        zones, total, names = [], 0, set()
        with pq.ParquetWriter(out.stream, schema, compression="none", use_dictionary=False) as writer:
            for block in blocks(batches):
                table = pa.table([block.column(c).combine_chunks() for c in schema.names], schema=schema)
                writer.write_table(table, row_group_size=rows)
                q = vectors_of(table.column("q"), dtype, dim)
                labels = np.asarray(table.column("label").to_numpy())
                zones.append((q.min(axis=0), q.max(axis=0), int(labels.min()), int(labels.max())))
                names.update(labels.tolist())
                total += len(table)
            packed = {"low": np.array([z[0] for z in zones], dtype), "high": np.array([z[1] for z in zones], dtype),
                      "labels": np.array([z[2:] for z in zones], "<i8")}
            writer.add_key_value_metadata({k: base64.b64encode(v.tobytes()) for k, v in packed.items()})
        out.commit()
        yield pa.RecordBatch.from_pylist([{"file_no": number, "rows": total, "labels": sorted(names)}], manifest)

    return run


def block_file(number: int) -> str:
    return f"blocks-{number:07d}.parquet"


def write_blocks(rows: DataFrame, vector: str, scale: int, folder: str) -> tuple[DataFrame, Extent]:
    """Write ``rows`` (vec_id, label, ``vector``; all take part) to ``folder`` in order of label, curve
    and vec_id.  Returns the manifest (file_no, rows, labels), one row per file, and the extent.

    The order ends with the row's place in the input, so copies of one vector are spread over files."""
    shape = extent(rows, vector, scale)
    # A file for each core, but none of a few blocks: within a file a search starts without a threshold.
    cores = min(rows.sparkSession.sparkContext.defaultParallelism, -(-shape.rows // FILE_ROWS))
    files = int(max(1, cores, -(-shape.rows * max(1, shape.dim) * shape.dtype.itemsize // FILE_BYTES)))
    order = ["label", "curve", "vec_id", "at"]
    placed = (rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector)
              .mapInArrow(_place(shape, scale), "vec_id long, label long, curve binary, q binary")
              .withColumn("at", F.monotonically_increasing_id())
              .repartitionByRange(files, *order).sortWithinPartitions(*order))
    written = placed.select("vec_id", "label", "q").mapInArrow(
        _write(folder, shape.dtype, shape.dim), "file_no int, rows long, labels array<long>")
    return materialize(written, "blocks-manifest"), shape


class Scorer:
    """Exact inner products of scaled vectors within an extent."""

    def __init__(self, shape: Extent):
        limit = shape.largest ** 2 * max(1, shape.dim)
        self.kind = "f8" if limit < 1 << 53 else "i8" if limit < 1 << 62 else "O"

    def ready(self, vectors: np.ndarray) -> np.ndarray:
        if self.kind == "O":
            return np.array([[int(x) for x in v] for v in vectors], object).reshape(vectors.shape)
        return vectors.astype(self.kind)

    def dots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Products of the rows of two ready matrices, as 64-bit integers."""
        found = a @ b.T
        if self.kind == "O":
            found = np.array([[min(max(int(x), 1 - (1 << 63)), (1 << 63) - 1) for x in r] for r in found], np.int64)
        return found.astype(np.int64).reshape(len(a), len(b))

    def bounds(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest product of each row of ``a`` with any vector between ``low`` and ``high``."""
        up, down = np.where(a > 0, a, 0), np.where(a < 0, a, 0)
        return (self.dots(np.hstack([up, down]), np.hstack([low, high])),
                self.dots(np.hstack([up, down]), np.hstack([high, low])))


class BlockFile:
    """One file of blocks: zone maps from the footer, blocks read when asked for and kept (a file is
    bounded by FILE_BYTES)."""

    def __init__(self, folder: str, number: int, shape: Extent, scorer: Scorer):
        fs, path = filesystem(folder)
        self.number, self.shape, self.scorer, self.held = number, shape, scorer, {}
        self.parquet = pq.ParquetFile(fs.open_input_file(f"{path}/{block_file(number)}"))
        said = self.parquet.metadata.metadata
        zone = lambda k, kind, width: np.frombuffer(base64.b64decode(said[k]), kind).reshape(-1, width)
        n = self.parquet.metadata.num_row_groups
        self.labels = zone(b"labels", "<i8", 2)
        self.low, self.high = (scorer.ready(zone(k, shape.dtype, shape.dim) if shape.dim else np.zeros((n, 0)))
                               for k in (b"low", b"high"))
        self.sizes = [self.parquet.metadata.row_group(i).num_rows for i in range(n)]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids (NO_ID for null), labels, row numbers (unique over all files) and stored vectors of block ``i``."""
        if i not in self.held:
            t = self.parquet.read_row_group(i)
            ids = t.column("vec_id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
            numbers = (self.number << 40) + self.starts[i] + np.arange(len(ids))
            self.held[i] = (ids.astype(np.int64), t.column("label").to_numpy(), numbers,
                            vectors_of(t.column("q"), self.shape.dtype, self.shape.dim))
        return self.held[i]


class Best:
    """The k best rows of each query: by score falling, id, row number."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.scores = np.full((queries, k), NONE, np.int64)
        self.ids, self.rows = np.full((queries, k), NO_ID, np.int64), np.full((queries, k), NO_ID, np.int64)
        self.least = np.full(queries, NONE, np.int64) if floor is None else floor.astype(np.int64)

    def floor(self) -> np.ndarray:
        """A row that scores below this is not among the k best."""
        return np.maximum(self.least, self.scores[:, -1])

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Rows ``ids``/``rows`` with their scores for the queries ``which`` (NONE: does not count)."""
        hit = (scores >= self.floor()[which][:, None]) & (scores != NONE)
        if scores.shape[1] > self.k:
            at = scores.shape[1] - self.k
            hit &= scores >= np.partition(scores, at, axis=1)[:, at][:, None]
        q, c = np.nonzero(hit)
        if not len(q):
            return
        mine = np.unique(q)
        old = np.repeat(mine, self.k)
        q = np.concatenate([old, q])
        s = np.concatenate([self.scores[which[mine]].ravel(), scores[hit]])
        i = np.concatenate([self.ids[which[mine]].ravel(), ids[c]])
        r = np.concatenate([self.rows[which[mine]].ravel(), rows[c]])
        order = np.lexsort((r, i, ~s, q))
        q = q[order]
        first = np.searchsorted(q, mine)
        take = order[(first[:, None] + np.arange(self.k)[None, :])]
        self.scores[which[mine]], self.ids[which[mine]], self.rows[which[mine]] = s[take], i[take], r[take]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query, score, id and row number of everything kept."""
        q, c = np.nonzero(self.scores != NONE)
        return q, self.scores[q, c], self.ids[q, c], self.rows[q, c]


def ids_out(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


QUERIES = "row long, vec_id long, label long, q binary, floor long"


def _queries(folder: str, shape: Extent, every: int, k: int, of_label: bool):
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("q", pa.binary()),
                        ("floor", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shape)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                part = BlockFile(folder, number, shape, scorer)
                for b in range(len(part)):
                    ids, labels, rows, q = part.block(b)
                    part.held.clear()
                    mine = np.nonzero((ids != NO_ID) & (ids % every == 0))[0]
                    if not len(mine):
                        continue
                    ready = scorer.ready(q)
                    scores = scorer.dots(ready[mine], ready)
                    scores[np.arange(len(mine)), mine] = NONE
                    if of_label:
                        scores[labels[mine][:, None] != labels[None, :]] = NONE
                    floor = np.full(len(mine), NONE) if len(ids) < k else np.partition(scores, -k, axis=1)[:, -k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[mine]), pa.array(ids[mine]), pa.array(labels[mine]),
                         pa.array([v.tobytes() for v in q[mine]], pa.binary()), pa.array(floor, pa.int64())], schema=schema)

    return run


def queries(manifest: DataFrame, folder: str, shape: Extent, every: int, k: int, of_label: bool = False) -> DataFrame:
    """The written rows whose id ``every`` divides, with ``floor``, the k-th best score among the other
    rows (of the label, if asked) of their own block: at least k rows reach it (smallest long if none)."""
    files = manifest.count()
    return manifest.select("file_no").repartitionById(max(1, files), "file_no").mapInArrow(
        _queries(folder, shape, every, k, of_label), QUERIES)
