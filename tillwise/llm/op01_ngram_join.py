"""N-gram Jaccard join: T-occurrence search with DivideSkip over blocks of candidate documents.

A document is its set of distinct 5-word shingles; two link if their Jaccard similarity reaches 0.8.
Equal sets are one vertex.  A partner must share at least T = ceil(0.8 n) of a document's n shingles.

1. Pruning.  In one global order (the shingles' hashes) the partners' first n - T + k shingles share at
   least k.  Only these prefixes are shuffled; shingles that no other set holds in its prefix cannot
   count, and a document with too few that others hold has no partner and goes.
2. Candidate blocks.  Of a remaining document's shared prefix shingles all but its k - 1 most frequent
   are kept (one of these must be common too); documents that keep the same shingle and lie in the same
   or neighbouring size band fall into one block: the components of that relation, found by minima per
   shingle, not by pairs.  Passages that very many documents share are the most frequent shingles and
   tie no block together.
3. Search.  In each block an inverted index over all shingles of its documents answers, for each
   document, the T-occurrence question: which ids stand on at least T of its lists?  The L longest
   lists are set aside, the short ones merged by a heap that skips ahead (by counting where they are
   many), ids on at least T - L of them are looked up in the long lists by binary search, and those
   that reach the exact overlap are linked.  Documents already connected need no further link, so a
   block returns a spanning forest.  A block of more than ``BLOCK`` shingles is split into pairs of
   parts, so a task holds no more than that, whatever the size of a group.

Components of the links give each document the smallest doc_id it reaches.

Defined results: null and empty texts have no shingles and are linked with nothing; texts of fewer
words than a shingle are one shingle; rows of one doc_id are one vertex and each is returned; a null
doc_id takes no part in links and its component is null.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import broadcast_if_small, components, materialize, slices, table
from tillwise.llm.shingles import set_hash, shingle_set

WORDS = 5
BLOCK = 1_000_000  # shingles that one task indexes at most
SEEN = 200_000  # sets that a task remembers, so that it sends the postings of copies once


def least_overlap(n: int) -> int:
    return -(-4 * n // 5)


def extra(n: int) -> int:
    """How many common shingles the prefix guarantees to a partner of equal size."""
    return max(1, -(-n // 16))


def guaranteed(n: int) -> int:
    """The same for the smallest partner."""
    return extra(least_overlap(n))


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= 80 * (n + m - common)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sets = [shingle_set(t, WORDS) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_hash(s) for s in sets], pa.int64())], names=["doc_id", "n", "node"])


def _postings(with_node: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            tokens, nodes, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, WORDS)
                node = set_hash(s)
                if not len(s) or node in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                prefix = min(len(s), len(s) - least_overlap(len(s)) + extra(len(s)))
                tokens.append(s[:prefix].view(np.int64))
                nodes.append(np.full(prefix, node, np.int64))
                sizes.append(np.full(prefix, len(s), np.int32))
            if tokens:
                columns = [pa.array(np.concatenate(tokens))]
                if with_node:
                    columns += [pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "node", "n"][:len(columns)])

    return run


def survivors(docs: DataFrame) -> DataFrame:
    """(node, n, tokens): sets that may have a partner, with the prefix shingles that one may share."""
    texts = docs.select("text").where(F.col("text").isNotNull())
    shared = (texts.mapInArrow(_postings(False), "token long").groupBy("token")
              .agg(F.count("*").cast("int").alias("df")).where("df > 1"))
    posts = texts.mapInArrow(_postings(True), "token long, node long, n int").join(shared, "token")
    size = F.col("n")
    smallest = F.floor((4 * size + 4) / 5)
    needed = F.greatest(F.lit(1), F.floor((smallest + 15) / 16)).cast("int")
    held = (posts.groupBy("node", "n").agg(F.array_sort(F.collect_set(F.struct("df", "token"))).alias("shared"))
            .withColumn("needed", needed).where(F.size("shared") >= F.col("needed")))
    kept = F.slice("shared", F.lit(1), F.size("shared") - F.col("needed") + 1)
    return held.select("node", "n", F.transform(kept, lambda x: x["token"]).alias("tokens"))


def candidate_blocks(found: DataFrame) -> DataFrame:
    """(node, n, block): vertices of blocks of at least two; every link lies inside a block."""
    band = F.floor(F.log("n") / math.log(1.25)).cast("int")
    held = found.select("node", band.alias("band"), F.explode("tokens").alias("token"))
    least = held.groupBy("token", "band").agg(F.min("node").alias("least"))
    # A partner is at most 5/4 as large: it lies in the same band or a neighbouring one.
    own = held.join(least, ["token", "band"]).select(F.col("node").alias("a"), F.col("least").alias("b"))
    up = least.select("token", (F.col("band") - 1).alias("band"), F.col("least").alias("b"))
    across = least.join(up, ["token", "band"]).select(F.col("least").alias("a"), "b")
    roots = components(own.union(across).where("a <> b").distinct())
    return found.select("node", "n").join(roots, found.node == roots.id).select("node", "n", F.col("root").alias("block"))


def merge_skip(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids on at least ``least`` of the ascending lists, with how many; a heap of the lists' heads, from
    which lists that cannot reach ``least`` together jump to the next possible id."""
    heads = [(int(x[0]), i, 0) for i, x in enumerate(lists)]
    heapq.heapify(heads)
    found = {}
    while len(heads) >= least:  # ids come out in ascending order
        top, same = heads[0][0], []
        while heads and heads[0][0] == top:
            same.append(heapq.heappop(heads))
        if len(same) >= least:
            found[top] = len(same)
            goal = top + 1
        else:
            for _ in range(least - 1 - len(same)):
                if heads:
                    same.append(heapq.heappop(heads))
            if not heads:
                break
            goal = max(heads[0][0], top + 1)
        for _, i, at in same:
            at += int(np.searchsorted(lists[i][at:], goal))
            if at < len(lists[i]):
                heapq.heappush(heads, (int(lists[i][at]), i, at))
    return np.array(list(found), np.int64), np.array(list(found.values()), np.int64)


def merge_count(lists: list[np.ndarray], least: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by one counter per id, for lists that hold many times more entries than ids."""
    counts = np.bincount(np.concatenate(lists) - low, minlength=high - low)
    ids = np.flatnonzero(counts >= least)
    return ids + low, counts[ids]


def divide_skip(lists: list[np.ndarray], least: int, low: int, high: int, keep) -> tuple[np.ndarray, np.ndarray]:
    """Ids in [low, high) on at least ``least`` of the ascending lists, with how many; only ids for
    which the mask ``keep(ids)`` holds."""
    none = np.zeros(0, np.int64)
    if len(lists) < least:
        return none, none
    lists = sorted(lists, key=len)
    long = min(least - 1, int(least / (0.01 * math.log2(len(lists[-1]) + 1) + 1)))
    short, rest = lists[:len(lists) - long], lists[len(lists) - long:]
    ids, counts = (merge_skip(short, least - long) if sum(map(len, short)) <= 2_000
                   else merge_count(short, least - long, low, high))
    wanted = keep(ids)
    ids, counts = ids[wanted], counts[wanted]
    if len(ids) * len(rest) * 8 > sum(map(len, rest)):
        counts += np.bincount(np.concatenate(rest) - low, minlength=high - low)[ids - low] if rest else 0
    else:
        for k, x in enumerate(rest):
            at = np.minimum(np.searchsorted(x, ids), len(x) - 1)
            counts += x[at] == ids
            possible = counts + (len(rest) - k - 1) >= least
            ids, counts = ids[possible], counts[possible]
            if not len(ids):
                break
    return ids[counts >= least], counts[counts >= least]


def links_in_block(sets: list[np.ndarray], sides: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets (by position); with ``sides``, of the links
    between sets of different sides."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    count = len(order)
    sizes = np.array([len(sets[i]) for i in order])
    _, tokens = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    # The inverted index: (token, id) pairs in order, so one binary search finds a part of a list.
    flat = np.sort(tokens.astype(np.int64) * count + np.repeat(np.arange(count), sizes))
    index = flat % count
    label, out = np.arange(count), []  # label: component so far
    side = None if sides is None else np.array([sides[i] for i in order])

    def link(a: int, b: int) -> None:
        if label[a] != label[b]:
            label[label == label[b]] = label[a]
            out.append((order[a], order[b]))

    def lists_of(i: int, low: int, high: int) -> list[np.ndarray]:
        own = tokens[cuts[i]:cuts[i + 1]].astype(np.int64) * count
        starts, ends = np.searchsorted(flat, own + low), np.searchsorted(flat, own + high)
        return [index[a:b] for a, b in zip(starts.tolist(), ends.tolist()) if b > a]

    if count > 64 and side is None:
        # Large groups first: one document's full counts link all its partners at once.
        alone = np.ones(count, bool)
        while alone.sum() > 64:
            open_ids = np.flatnonzero(alone)
            i = int(open_ids[len(open_ids) // 2])
            common = np.bincount(np.concatenate(lists_of(i, 0, count)), minlength=count)
            near = np.flatnonzero((100 * common >= 80 * (sizes + sizes[i] - common)) & (np.arange(count) != i))
            for j in near.tolist():
                link(i, j)
            alone[near] = alone[i] = False
            if len(near) < 16:
                break
    for i in range(1, count):
        least = least_overlap(int(sizes[i]))
        low = int(np.searchsorted(sizes, least))

        def keep(ids: np.ndarray) -> np.ndarray:
            fresh = label[ids] != label[i]
            return fresh if side is None else fresh & (side[ids] != side[i])

        if not keep(np.arange(low, i)).any():
            continue
        ids, common = divide_skip(lists_of(i, low, i), least, low, i, keep)
        near = 100 * common >= 80 * (sizes[ids] + sizes[i] - common)
        for j in ids[near].tolist():
            link(i, j)
    return out


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block (or pair of parts) that a set is searched in."""
    schema = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()),
                        ("node", pa.int64()), ("shingles", pa.binary())])
    for batch in slices(batches):
        rows = []
        for block, parts, node, text in zip(*[batch.column(c).to_pylist() for c in ("block", "parts", "node", "text")]):
            data, own = shingle_set(text, WORDS).tobytes(), node % parts
            for other in range(parts):
                i, j = min(own, other), max(own, other)
                rows.append((block, i, j, 0 if i == j else int(own == j), node, data))
                if len(rows) * (len(data) + 1) > 32 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block; rows of a block follow each other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(key, rows) -> list[dict]:
        if len(rows) < 2:
            return []
        sets = [np.frombuffer(data, np.uint64) for _, data, _ in rows]
        sides = None if key[1] == key[2] else [s for _, _, s in rows]
        return [{"a": rows[x][0], "b": rows[y][0]} for x, y in links_in_block(sets, sides)]

    key, rows, out = None, [], []
    for batch in batches:
        for block, i, j, side, node, data in zip(*[batch.column(c).to_pylist() for c in (
                "block", "i", "j", "side", "node", "shingles")]):
            if (block, i, j) != key:
                out += solve(key, rows)
                key, rows = (block, i, j), []
            rows.append((node, data, side))
        if len(out) > 10_000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out + solve(key, rows), schema)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = materialize(docs.mapInArrow(_sets, "doc_id long, n long, node long"), "ngram-sets")
    named = docs.where("doc_id IS NOT NULL")
    blocks = materialize(candidate_blocks(materialize(survivors(named), "ngram-survivors")), "ngram-blocks")
    parts = blocks.groupBy(F.col("block").alias("b")).agg(F.ceil(2 * F.sum("n") / BLOCK).alias("parts"))
    parts = parts.select("b", F.when(F.col("parts") <= 2, F.lit(1)).otherwise(F.col("parts")).cast("int").alias("parts"))
    # One document for each set that is searched.
    holder = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc"))
    wanted = materialize(blocks.join(parts, blocks.block == parts.b).join(holder, "node")
                         .select("doc", "node", "block", "parts"), "ngram-wanted")
    texts = named.join(broadcast_if_small(wanted), named.doc_id == wanted.doc).select("block", "parts", "node", "text")
    rows = texts.mapInArrow(_block_rows, "block long, i int, j int, side int, node long, shingles binary")
    links = materialize(rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "node")
                        .mapInArrow(_search, "a long, b long"), "ngram-links")
    same_id = (sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b"))
    roots = components(links.union(same_id))
    vertices = holder.join(roots, holder.node == roots.id, "left").select(
        "node", "doc", F.coalesce("root", "node").alias("root"))
    low = vertices.groupBy(F.col("root").alias("r")).agg(F.min("doc").alias("component_id"))
    known = vertices.join(low, vertices.root == low.r).select(F.col("node").alias("v"), "component_id")
    return (sets.join(known, (sets.node == known.v) & (sets.n > 0) & sets.doc_id.isNotNull(), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(sh, ' ') AS sh FROM (
      SELECT doc_id, unnest([w[i:i+4] for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS sh FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
