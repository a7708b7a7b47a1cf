"""Mixing sources to target weights over fixed-length blocks of words.

Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share all words; a source whose
share passes ``max_epochs`` times its size is held there and the rest is shared again by weight.

The words of a source, in doc_id order, form one stream cut into blocks of ``block`` words.  The
output is a sequence of shards of ``shard_blocks`` slots.  How many slots of a shard each source gets
is a multinomial draw conditioned on the sources' totals: the totals are split over halves of the
shard range by multivariate hypergeometric draws seeded by the node, so any shard's counts, and the
slots drawn before it, follow from a walk of log2(shards) steps without looking at other shards.  The
k-th slot of a source takes the block at position k of a pseudorandom permutation of its blocks
(a Feistel cipher, one key per pass over the source), and blocks meet documents by an equi-join on
(source, block).  The last slot of a source is cut so that its words add up to its rounded target.

Offsets of documents in their source's stream come from per-(source, id range) totals, so a source
with a third of all rows is ordered range by range, never in one task.  The driver holds two numbers
per source and the split points of the id ranges.

Defined results: null text has size 0; sizes 0 are never taken; null doc_ids come first in their
source; repeated ids are ordered by their text's hash and mixed separately; with no words at all every
target is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import materialize, table

WORD = r"[^\x20\x09-\x0D]+"
DOCS_PER_RANGE = 20_000
ROUNDS = 4
SLOT_TASKS = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source."""
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = per_source.withColumn("w", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
    # In order of (limit / weight) the sources held at their limit come first; ``level`` is the
    # share of a unit of weight if exactly the sources before this one are held.
    limit = (F.col("source_size") * max_epochs).cast("double")
    up = Window.orderBy("ratio", "source").rowsBetween(Window.unboundedPreceding, -1)
    on = Window.orderBy("ratio", "source").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    levels = (weighted.withColumn("limit", limit).withColumn("ratio", limit / F.col("w"))
              .withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
              .withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(up), F.lit(0.0)))
                          / F.sum("w").over(on))
              .withColumn("held", F.col("ratio") < F.col("level")))
    shared = F.min(F.when(~F.col("held"), F.struct("ratio", "source", "level"))).over(all_rows)["level"]
    return levels.select("source", "source_size",
                         F.when(F.col("held"), F.col("limit")).otherwise(shared * F.col("w")).alias("target"))


class Permutation:
    """Pseudorandom permutation of range(n) by a balanced Feistel network with cycle walking."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = np.random.SeedSequence(key).generate_state(ROUNDS, np.uint64)

    def _round(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in (self.keys[::-1] if back else self.keys):
            if back:
                left, right = right ^ self._round(left, key), left
            else:
                left, right = right, left ^ self._round(right, key)
        return (left << half) | right

    def __call__(self, index, back: bool = False) -> np.ndarray:
        x = self._once(np.asarray(index, np.uint64), back)
        while (out := x >= self.n).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)


class Plan:
    """How many slots a source gets, and the block and words of each."""

    def __init__(self, source: int, size: int, target: float, block: int, seed: int):
        self.source, self.size, self.block, self.seed = source, size, block, seed
        self.n = -(-size // block)
        self.words = int(np.floor(target + 0.5))
        self.epochs, rest = divmod(self.words, size) if size else (0, 0)
        self.last = size - (self.n - 1) * block  # words of the last block
        extra = -(-rest // block)
        if rest:
            tail = int(self.order(self.epochs)(np.array([self.n - 1]), back=True)[0])
            held = lambda k: k * block - (block - self.last) * (tail < k)
            extra += held(extra) < rest
            self.final = rest - held(extra - 1)
        else:
            self.final = None
        self.slots = self.epochs * self.n + extra

    def order(self, epoch: int) -> Permutation:
        return Permutation(self.n, [self.seed, self.source, epoch])

    def blocks(self, first: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(epoch, block, words) of slots first .. first + count - 1."""
        k = np.arange(first, first + count)
        epoch, index = k // self.n, k % self.n
        block = np.empty(count, np.int64)
        for e in np.unique(epoch):
            block[epoch == e] = self.order(int(e))(index[epoch == e])
        words = np.where(block == self.n - 1, self.last, self.block)
        if self.final is not None:
            words = np.where(k == self.slots - 1, self.final, words)
        return epoch, block, words


def draw_shard(shard: int, shards: int, per_shard: int, totals: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before this shard, slots of each source in it)."""
    lo, hi, counts, before = 0, shards, totals.astype(np.int64), np.zeros(len(totals), np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _split(counts, min((mid - lo) * per_shard, int(counts.sum())), [seed, lo, hi])
        if shard < mid:
            hi, counts = mid, left
        else:
            lo, counts, before = mid, counts - left, before + left
    return before, counts


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good, of any size: the probabilities around the
    mode relative to each other (their ratios are exact), out to where the rest is below 1e-30."""
    low, high, total = max(0, n - bad), min(good, n), good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    p = good / total
    spread = int(12 * (n * p * (1 - p) * (total - n) / max(total - 1, 1)) ** 0.5) + 40
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1)
    at = k[:-1].astype(np.float64)
    steps = np.log(good - at) + np.log(n - at) - np.log(at + 1) - np.log(bad - n + at + 1)
    weights = np.concatenate([[0.0], np.cumsum(steps)])
    upto = np.cumsum(np.exp(weights - weights.max()))
    return int(k[min(np.searchsorted(upto, rng.random() * upto[-1], "right"), len(k) - 1)])


def _split(counts: np.ndarray, n: int, seed: list[int]) -> np.ndarray:
    """Multivariate hypergeometric draw by its marginals."""
    rng, out, left = np.random.default_rng(seed), np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        others = left - c
        if n == 0 or c == 0:
            take = 0
        elif others == 0:
            take = n
        else:
            take = _hypergeometric(rng, c, others, n)
        out[i], n, left = take, n - take, others
    return out


def _slots(plans: list[Plan], shards: int, per_shard: int, seed: int):
    names = ["shard", "slot", "sid", "epoch", "block", "words"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.array([p.slots for p in plans])
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                before, counts = draw_shard(shard, shards, per_shard, totals, seed)
                parts = [(np.full(c, i), *p.blocks(int(b), int(c)))
                         for i, (p, b, c) in enumerate(zip(plans, before, counts)) if c]
                sid, epoch, block, words = (np.concatenate(x) for x in zip(*parts))
                slot = np.random.default_rng([seed, shard, 1]).permutation(len(sid))
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (
                    np.full(len(sid), shard), slot, sid, epoch, block, words)], schema=schema)

    return run


def mix(docs: DataFrame, block: int = 1024, shard_blocks: int = 1024, max_epochs: int = 3, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Mix ``docs`` (doc_id, text, source).

    Returns (sized, pieces).  sized: k (row key), doc_id, source, size, source_size, target, one row
    per row of ``docs``.  pieces: k, copy, shard, slot, epoch, first, n: the mix takes words
    first .. first + n - 1 (from 0) of that row.  ``copy`` numbers rows of equal id and text.
    """
    spark = docs.sparkSession
    base = materialize(docs.select(F.xxhash64("doc_id", "text", "source").alias("k"),
                                   F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size")),
                       "mix-sizes")
    targets = materialize(source_targets(base, max_epochs).withColumn(
        "sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1), "mix-targets")
    plans = [Plan(r.sid, r.source_size, r.target, block, seed) for r in targets.orderBy("sid").collect()]

    # Offset of each document in the stream of its source.
    ranges = int(max(spark.sparkContext.defaultParallelism, -(-base.count() // DOCS_PER_RANGE)))
    placed = (materialize(base.repartitionByRange(ranges, "doc_id").withColumn("range", F.spark_partition_id()), "mix-ranges")
              .join(targets.select(F.col("source").alias("s"), "source_size", "target", "sid"),
                    F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    totals = placed.groupBy("sid", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("sid").alias("osid"), F.col("range").alias("orange"),
                            F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("sid", "range").orderBy("doc_id", "k").rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("sid", "range").orderBy("doc_id", "k")
    ordered = placed.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0))).withColumn(
        "seq", F.row_number().over(same))
    copies = Window.partitionBy("sid", "range", "doc_id", "k").orderBy("seq")
    sized = materialize(
        ordered.withColumn("copy", F.row_number().over(copies))
        .join(offsets, (F.col("sid") == F.col("osid")) & (F.col("range") == F.col("orange")))
        .select("k", "copy", "doc_id", "source", "sid", "size", "source_size", "target",
                (F.col("start") + F.col("at")).alias("at")), "mix-sized")

    total_slots = sum(p.slots for p in plans)
    shards = -(-total_slots // shard_blocks)
    # Written first: the planner takes what tasks make for as small as the shard numbers they start from,
    # and would broadcast it at any size.
    slots = materialize(spark.range(shards).repartition(max(1, min(shards, SLOT_TASKS))).mapInArrow(
        _slots(plans, shards, shard_blocks, seed),
        "shard long, slot long, sid long, epoch long, block long, words long"), "mix-slots")
    held = (sized.where("size > 0").select(
        "k", "copy", "sid", "size", "at",
        F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))).alias("block")))
    pieces = (held.join(slots, ["sid", "block"])
              .withColumn("from", F.greatest("at", F.col("block") * block))
              .withColumn("to", F.least(F.col("at") + F.col("size"), F.col("block") * block + F.col("words")))
              .where(F.col("to") > F.col("from"))
              .select("k", "copy", "shard", "slot", "epoch", (F.col("from") - F.col("at")).alias("first"),
                      (F.col("to") - F.col("from")).alias("n")))
    return sized, pieces


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: for every pass of the mix over a document one row with the words taken,
    all other columns kept.  A pass that takes the whole document keeps its text as it is; else the
    text is the taken words joined by spaces.  A column ``n_chars`` follows the new text."""
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source",
                        F.xxhash64("doc_id", "text", "source").alias("k"))
    sized, pieces = mix(docs, **options)
    runs = (pieces.groupBy("k", "copy", "epoch")
            .agg(F.sum("n").alias("taken"), F.array_sort(F.collect_list(F.struct("first", "n"))).alias("runs"))
            .groupBy("k").agg(F.collect_list(F.struct("copy", "epoch", "taken", "runs")).alias("passes")))
    # Rows of equal id, text and source share their passes: one of them carries all.
    one = keyed.dropDuplicates(["k"])
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), 1)
    cut = F.array_join(F.flatten(F.transform("p.runs", lambda r: F.slice(
        F.col("words"), r["first"].cast("int") + 1, r["n"].cast("int")))), " ")
    out = (one.join(runs, "k").select("row", "text", F.explode("passes").alias("p"))
           .withColumn("size", n_words(F.col("text")))
           .withColumn("words", F.when(F.col("p.taken") < F.col("size"), words))
           .withColumn("new", F.when(F.col("p.taken") < F.col("size"), cut).otherwise(F.col("text"))))
    fields = {c: F.col("row").getField(c).alias(c) for c in docs.columns}
    fields["text"] = F.col("new").alias("text")
    if "n_chars" in fields:
        fields["n_chars"] = F.char_length("new").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*fields.values())


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, pieces = mix(table(spark, sf_dir, "documents"))
    taken = pieces.groupBy("k", "copy").agg(F.sum("n").alias("taken"))
    return sized.join(taken, ["k", "copy"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
