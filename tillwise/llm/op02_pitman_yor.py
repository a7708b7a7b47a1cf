"""LM scoring: a hierarchical Pitman-Yor bigram model, sampled by Gibbs, averaged over samples.

Tokens are words and one end per text.  Every word of the training texts, found by a 64-bit hash, is a
dish and, for the words that follow it, a context restaurant; the start of a text is a context too.  All
contexts share the root restaurant as parent, whose base is uniform over the words and one unknown word.
A context that was never seen gives the root's probabilities.

Words are numbered by the order of their hashes; a pair is one number.  Nothing that grows with the
vocabulary is kept by the driver: the state of the words is a table, and meets the pairs in joins.

Seating.  Given the parent's probabilities and the tables of each restaurant from the sweep before, the
customers of a dish are reseated one after another: the n-th opens a table with odds (theta + d T) p
against n - d t.  Openings are drawn by thinning, so a dish with a million customers costs about as
many steps as it has tables.  Dishes are then independent rows.  A dish with one customer has one table
in every sweep, so only pairs that occur again are joined and seated; the others are counted once.
Random numbers are hashes of (pair, sweep, step), so a rerun or a retried task seats alike.  After
``burn`` sweeps, predictive probabilities are averaged over ``samples`` sweeps.

Scoring.  Documents are packed, once, into units of about ``UNIT`` tokens: a file on the shared folder
with each token as an index into the unit's distinct words.  Only these words and, once they have
numbers, the unit's distinct pairs travel, as arrays by hash part: to be counted, to be answered from the
model's part, and the answers back to the unit.  A unit and a part bound what a task holds, and the
number of parts follows the number of training tokens.

Defined results: null and empty texts hold only the end; a null doc_id has remainder null and counts as
training; repeated rows are learned from and scored each; with no training token every known count is
0 and the model is its base.
"""

from __future__ import annotations

import io
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import BROADCAST_ROWS, materialize, scratch, slices, table
from tillwise.llm.files import AtomicFile, filesystem
from tillwise.llm.shingles import mix

UNIT = 2_000_000
PART = 2_000_000  # training tokens for which there is one part of the keys
THETA = 1.0
END, START = b"", b" "


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII white space, A-Z only


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         names=["word", "c"])
        counts.clear()
        return out

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            counts.update(words_of(text))
            counts[END] += 1
            if len(counts) > 300_000:
                yield flush()
    yield flush()


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([word_hash(w) for w in words], pa.int64()), batch.column("c")], names=["h", "c"])


MAX_WORDS = (1 << 31) - 2


@dataclass
class Vocabulary:
    """The numbers of training tokens and words, and the words: rows (h, id, c).  The start has the number
    ``size``, which as a dish stands for the unknown word, so that every key has a row."""

    tokens: int
    distinct: int
    words: DataFrame

    @property
    def size(self) -> int:
        return self.distinct

    @property
    def parts(self) -> int:
        return max(32, -(-self.tokens // PART))


def base_score(c, tokens: int, distinct: int) -> np.ndarray:
    return np.log10((np.asarray(c) + 1.0) / (tokens + 1 * (distinct + 1)))


def learn_words(training: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary and its words (h, id, c).  A pair of words is one 64-bit key, so a corpus of more
    than ``MAX_WORDS`` distinct words is refused."""
    found = materialize(training.select("text").mapInArrow(_count_words, "word binary, c long")
                        .groupBy("word").agg(F.sum("c").alias("c")).mapInArrow(_hash_words, "h long, c long")
                        .groupBy("h").agg(F.sum("c").alias("c")), "lm-words")
    total = found.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v
    if v > MAX_WORDS:
        raise ValueError(f"{v} distinct words: a pair key holds {MAX_WORDS}")
    # Numbers in the order of the hashes: slices of equal width, and the place in the slice.
    bits = max(5, (v // 500_000).bit_length())
    cut = F.shiftright("h", 64 - bits)
    sizes = sorted((r.q, r.n) for r in found.groupBy(cut.alias("q")).agg(F.count("*").alias("n")).collect())
    offsets, at = {}, 0
    for q, size in sizes:
        offsets[q], at = at, at + size
    spark = training.sparkSession
    known = spark.createDataFrame(sorted(offsets.items()), "q long, offset long")
    place = F.row_number().over(Window.partitionBy("q").orderBy("h")) - 1
    ids = (found.withColumn("q", cut.cast("long")).join(F.broadcast(known), "q")
           .select("h", (F.col("offset") + place).alias("id"), "c"))
    start = spark.createDataFrame([(word_hash(START), v, 0)], "h long, id long, c long")
    words = materialize(ids.union(start), "lm-numbered")
    return Vocabulary(n, v, words), words


ASKED = "unit string, kind int, part int, keys array<long>, counts array<long>"
ASKED_ARROW = pa.schema([("unit", pa.string()), ("kind", pa.int32()), ("part", pa.int32()),
                         ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
PAIR, WORD = 0, 1


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by (part, key), and where each part begins and the last ends."""
    part = part_of(keys, parts)
    order = np.lexsort((keys, part))
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _asked(unit: str, kind: int, keys: np.ndarray, counts: np.ndarray | None, order: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
    rows = []
    for q in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        mine = order[cuts[q]:cuts[q + 1]]
        rows.append((unit, kind, q, keys[mine], None if counts is None else counts[mine]))
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ASKED_ARROW)], schema=ASKED_ARROW)


def _pack(parts: int, folder: str):
    """Write each unit to a file; rows (unit, kind, part, keys, counts) of the words it asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local: dict[bytes, int] = {END: 0, START: 1}
        docs, held, texts, tokens = [], [], [], 0

        def flush() -> pa.RecordBatch:
            keys = np.array([word_hash(w) for w in local], np.int64)
            order, cuts = _by_part(keys, parts)
            place = np.empty(len(keys), np.uint32)
            place[order] = np.arange(len(keys))
            sizes = np.array([len(t) + 1 for t in texts])
            follow = np.zeros(int(sizes.sum()), np.int64)
            inner = np.ones(len(follow), bool)
            inner[np.cumsum(sizes) - 1] = False
            follow[inner] = np.concatenate(texts)
            unit = uuid.uuid4().hex
            data = io.BytesIO()
            np.savez(data, keys=keys[order], cuts=cuts, follow=place[follow], ends=place[:2], sizes=sizes,
                     held=np.array(held, bool), null=np.array([d is None for d in docs]),
                     docs=np.array([d or 0 for d in docs], np.int64))
            out = AtomicFile(folder, unit)
            out.write(_zstd(data.getvalue()))
            out.commit()
            return _asked(unit, WORD, keys, None, order, cuts)

        for batch in slices(batches):
            for doc_id, out, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "held", "text")]):
                found = [local.setdefault(w, len(local)) for w in words_of(text)]
                docs.append(doc_id)
                held.append(out)
                texts.append(np.array(found, np.int64))
                tokens += len(found) + 1
                if tokens >= UNIT:
                    yield flush()
                    local, docs, held, texts, tokens = {END: 0, START: 1}, [], [], [], 0
        if docs:
            yield flush()

    return run


def _unit_pairs(held: dict, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a unit, the pair of each token, and the words (unit's index) of each pair;
    ``ids`` are the words' numbers, NaN for unknown ones."""
    new = np.isnan(ids)
    as_dish = np.where(new, size, ids).astype(np.int64)
    as_context = np.where(new, size + 1, ids).astype(np.int64)
    follow = held["follow"].astype(np.int64)
    lead = np.concatenate([[0], follow[:-1]])
    lead[np.cumsum(held["sizes"]) - held["sizes"]] = held["ends"][1]
    # All unknown words are one dish and, as contexts, alike: their pairs need no more than that.
    pairs, first, at = np.unique(as_context[lead] << 32 | as_dish[follow], return_index=True, return_inverse=True)
    return pairs, at, lead[first], follow[first]


def _answers_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict]]:
    """(unit, {(kind, part): values}) of answers that come unit by unit."""
    unit, answers = None, {}
    for batch in batches:
        for u, kind, part, v in zip(*[batch.column(c).to_pylist() for c in ("unit", "kind", "part")], _lists(batch, "values")):
            if u != unit and unit is not None:
                yield unit, answers
                answers = {}
            unit = u
            answers[kind, part] = v
    if unit is not None:
        yield unit, answers


def _in_order(answers: dict, kind: int, cuts: np.ndarray, width: int) -> np.ndarray:
    values = np.full((int(cuts[-1]), width), np.nan)
    for (k, part), v in answers.items():
        if k == kind:
            values[cuts[part]:cuts[part + 1]] = v.reshape(-1, width)
    return values


def _ask_pairs(parts: int, folder: str, size: int):
    """Rows (unit, kind, part, keys, counts) of the pairs of each unit, from the numbers of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for unit, answers in _answers_of(batches):
            held = _load(fs, f"{path}/{unit}")
            pairs, at, _, _ = _unit_pairs(held, _in_order(answers, WORD, held["cuts"], 1)[:, 0], size)
            train = np.repeat(~held["held"], held["sizes"])
            yield _asked(unit, PAIR, pairs, np.bincount(at[train], minlength=len(pairs)), *_by_part(pairs, parts))

    return run


def _zstd(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _load(fs, path: str) -> dict:
    with fs.open_input_stream(path, compression=None) as stream:
        data = stream.read()
    whole = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return dict(np.load(io.BytesIO(whole)))


PARTS = "part int, keys array<long>, values array<double>"
PARTS_ARROW = pa.schema([("part", pa.int32()), ("keys", pa.list_(pa.int64())), ("values", pa.list_(pa.float64()))])


def _parts_batch(part: int, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([keys], pa.list_(pa.int64())),
                                       pa.array([values.astype(float)], pa.list_(pa.float64()))], schema=PARTS_ARROW)


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(name)
    return [column[i].values.to_numpy(zero_copy_only=False) for i in range(len(column))]


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per key of rows (part, keys, counts) that come part by part; keys without a count go."""
    part, keys, counts = None, [], []

    def done() -> pa.RecordBatch:
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(found))
        return _parts_batch(part, found[total > 0], total[total > 0])

    for batch in batches:
        for q, k, c in zip(batch.column("part").to_pylist(), _lists(batch, "keys"), _lists(batch, "counts")):
            if q != part and keys:
                yield done()
                keys, counts = [], []
            part = q
            keys.append(k)
            counts.append(c)
    if keys:
        yield done()


def total_by_part(asked: DataFrame) -> DataFrame:
    return (asked.select("part", "keys", "counts").repartition("part").sortWithinPartitions("part")
            .mapInArrow(_total, PARTS))


def _split_rows(parts: int, key: str, columns: list[str]):
    """Rows (key, columns) as rows (part, keys, values), the values of a key one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key).to_numpy()
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns], 1)
            order, cuts = _by_part(keys, parts)
            for q in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                mine = order[cuts[q]:cuts[q + 1]]
                yield _parts_batch(q, keys[mine], values[mine].ravel())

    return run


ANSWERS = "unit string, kind int, part int, values array<double>"


def _answer(width: int):
    """``width`` values of each asked key, NaN where the model has none; a part's model rows come first."""
    schema = pa.schema([("unit", pa.string()), ("kind", pa.int32()), ("part", pa.int32()), ("values", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, values, more = None, np.zeros(0, np.int64), np.zeros((0, width)), []
        for batch in batches:
            rows = []
            for unit, kind, part, k, v in zip(*[batch.column(c).to_pylist() for c in ("unit", "kind", "part")],
                                              _lists(batch, "keys"), _lists(batch, "values")):
                if part != now:
                    now, keys, values, more = part, np.zeros(0, np.int64), np.zeros((0, width)), []
                if unit is None:
                    more.append((k, v.reshape(-1, width)))
                    continue
                if more:
                    keys = np.concatenate([m[0] for m in more])
                    order = np.argsort(keys, kind="stable")
                    keys, values, more = keys[order], np.concatenate([m[1] for m in more])[order], []
                found = np.full((len(k), width), np.nan)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                    same = keys[at] == k
                    found[same] = values[at[same]]
                rows.append((unit, kind, part, found.ravel()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def answer(asked: DataFrame, model: DataFrame, width: int) -> DataFrame:
    """(unit, kind, part, values) for rows (unit, kind, part, keys) of one kind from rows (part, keys,
    values) with ``width`` values a key."""
    empty = F.array().cast("array<double>")
    rows = model.select(F.lit(None).cast("string").alias("unit"), F.lit(None).cast("int").alias("kind"), "part", "keys", "values").union(
        asked.select("unit", "kind", "part", "keys", empty.alias("values")))
    return (rows.repartition("part").sortWithinPartitions("part", F.col("unit").asc_nulls_first())
            .mapInArrow(_answer(width), ANSWERS))


def seat(c: np.ndarray, strength: np.ndarray, d: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of c customers of one dish each, by thinning; ``strength`` is (theta + d T) p."""
    t, n = np.minimum(c, 1), np.ones(len(c))
    start = mix(key.astype(np.int64).view(np.uint64) ^ mix(np.full(1, 7919 * sweep + 13, np.uint64)))
    live, step = np.flatnonzero(c > 1), 0
    while len(live):
        a, seated, tables = strength[live], n[live], t[live]
        p = a / (a + seated - d * tables)
        u, v = _uniform(start[live], 2 * step), _uniform(start[live], 2 * step + 1)
        wait = np.floor(np.log(u) / np.log1p(-np.minimum(p, 1 - 1e-12)))  # customers who join a table for sure
        now = seated + np.minimum(wait, 1e15)
        open_ = (now < c[live]) & (v * p <= a / (a + now - d * tables))
        t[live] += open_
        n[live] = now + 1
        live, step = live[n[live] < c[live]], step + 1
    return t


def _uniform(start: np.ndarray, step: int) -> np.ndarray:
    x = mix(start + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def _split(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pairs >> 32, pairs & 0xFFFFFFFF


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of the pairs by word: customers, pairs and pairs that occur once as a context, the
    same two as a dish; pairs that occur twice as a context."""
    names = ["id", "n", "pairs", "once", "dishes", "dishes_once", "twice"]
    for batch in batches:
        for pairs, c in zip(_lists(batch, "keys"), _lists(batch, "values")):
            u, w = _split(pairs)
            ids, at = np.unique(np.concatenate([u, w]), return_inverse=True)
            u, w, k = at[:len(u)], at[len(u):], len(ids)
            sums = [np.bincount(u, c, k), np.bincount(u, minlength=k), np.bincount(u, c == 1, k), np.bincount(w, minlength=k),
                    np.bincount(w, c == 1, k), np.bincount(u, c == 2, k)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(x.astype(np.int64)) for x in sums)], names=names)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, c in zip(_lists(batch, "keys"), _lists(batch, "values")):
            more = c > 1
            u, w = _split(pairs[more])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[more]), pa.array(u), pa.array(w), pa.array(c[more].astype(np.int64))],
                                             names=["key", "u", "w", "c"])


def _once(d: float):
    """What pairs that occur once add to their own probability, before the division."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pairs, c in zip(batch.column("part").to_pylist(), _lists(batch, "keys"), _lists(batch, "values")):
                yield _parts_batch(part, pairs[c == 1], np.full(int((c == 1).sum()), 1 - d))

    return run


def _seat_pairs(d: float, sweep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, c, tables, p = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("key", "c", "tables", "p"))
            t = seat(c, (THETA + d * tables) * p, d, key, sweep) if len(key) else c
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(t.astype(np.int64))], names=["key", "t"])

    return run


def _seat_root(d: float, strength: float, sweep: int):
    """Adds the root's tables of each dish."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, m = batch.column("id").to_numpy(), batch.column("m").to_numpy()
            s = seat(m, np.full(len(m), strength), d, ids, 1000 + sweep) if len(m) else m
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s.astype(np.int64))], names=["id", "met", "tables", "m", "s"])

    return run


def _root(state: DataFrame, d: float, sweep: int, size: int, before: float | None) -> tuple[DataFrame, int]:
    """(id, met, tables, p) from (id, met, tables, m): the root's predictive probabilities over its seated customers
    with a uniform base; and the number of its tables."""
    base = 1.0 / (size + 1)
    strength = (THETA + d * (size if before is None else before)) * base
    seated = materialize(state.mapInArrow(_seat_root(d, strength, sweep), "id long, met boolean, tables long, m long, s long"), "lm-state")
    total = seated.agg(F.sum("m").alias("m"), F.sum("s").alias("s")).first()
    p = (F.col("m") - d * F.col("s") + (THETA + d * total.s) * base) / (THETA + total.m)
    return seated.select("id", "met", "tables", p.alias("p")), total.s


@dataclass
class Model:
    """Per word (h, id, c, n, l0.., p0..): customers as a context, and for each sample the weight of the
    root and the root's probability; per pair that occurs again (key, own) its count less discounts."""

    vocabulary: Vocabulary
    d: float
    samples: int
    words: DataFrame
    again: DataFrame

    @property
    def columns(self) -> list[str]:
        return ["id", "c", "n", *(f"l{i}" for i in range(self.samples)), *(f"p{i}" for i in range(self.samples))]

    def _words(self, ids: np.ndarray) -> np.ndarray:
        rows = {r.id: r[1:] for r in self.words.where(F.col("id").isin(np.unique(ids).tolist())).select("id", *self.columns).collect()}
        return np.array([rows[i] for i in ids.tolist()], float).reshape(len(ids), len(self.columns))

    def unseen(self, pairs: np.ndarray) -> np.ndarray:
        """Averaged probability of a few pairs that were never seen."""
        u, w = _split(pairs)
        return _unseen(self._words(u), self._words(w), self.samples)

    def seen(self, pairs: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Averaged probability of a few pairs with their counts."""
        own = {r.key: r.own for r in self.again.where(F.col("key").isin(pairs.tolist())).collect()}
        added = np.array([own.get(k, 1 - self.d) for k in pairs.tolist()])
        return self.unseen(pairs) + added / (THETA + self._words(_split(pairs)[0])[:, 2])


def _unseen(u: np.ndarray, w: np.ndarray, samples: int) -> np.ndarray:
    return (u[:, 3:3 + samples] * w[:, 3 + samples:]).mean(1)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def learn(pairs: DataFrame, words: DataFrame, vocabulary: Vocabulary, burn: int = 2, samples: int = 3) -> Model:
    """Gibbs sweeps over rows (part, keys, values), pairs and their counts; ``words`` are (h, id, c)."""
    size = vocabulary.size
    names = ["n", "pairs", "once", "dishes", "dishes_once", "twice"]
    found = (pairs.mapInArrow(_sums, "id long, " + ", ".join(f"{n} long" for n in names))
             .groupBy("id").agg(*[F.sum(n).alias(n) for n in names]))
    again = materialize(pairs.mapInArrow(_repeated, "key long, u long, w long, c long"), "lm-again")
    # Only the words of pairs that occur again meet pairs in a sweep.
    met = again.select(F.explode(F.array("u", "w")).alias("id")).distinct().withColumn("met", F.lit(True))
    counted = materialize(words.join(found, "id", "left").join(met, "id", "left").na.fill(0, names).na.fill(False, ["met"])
                          .select("h", "id", "met", "c", *names), "lm-counted")
    total = counted.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice"), F.count_if("met").alias("met")).first()
    d = _discount(total.once or 0, total.twice or 0)
    small = F.broadcast if total.met <= BROADCAST_ROWS else (lambda rows: rows)
    state, tables = _root(counted.select("id", "met", F.col("pairs").alias("tables"), F.col("dishes").alias("m")), d, 0, size, None)
    levels, seated = [], None
    for sweep in range(1, burn + samples + 1):
        own = small(state.where("met"))
        ready = (again.join(own.select(F.col("id").alias("u"), "tables"), "u")
                 .join(own.select(F.col("id").alias("w"), "p"), "w").select("key", "c", F.col("tables").cast("double").alias("tables"), "p"))
        t = materialize(ready.mapInArrow(_seat_pairs(d, sweep), "key long, t long"), "lm-seated")
        none = F.lit(0).cast("long")
        sums = (t.select(F.shiftright("key", 32).alias("id"), F.col("t").alias("tu"), none.alias("tw"))
                .union(t.select(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("id"), none.alias("tu"), F.col("t").alias("tw")))
                .groupBy("id").agg(F.sum("tu").alias("tu"), F.sum("tw").alias("tw")))
        joined = counted.join(small(sums), "id", "left").na.fill(0, ["tu", "tw"])
        state, tables = _root(joined.select("id", "met", (F.col("once") + F.col("tu")).alias("tables"),
                                            (F.col("dishes_once") + F.col("tw")).alias("m")), d, sweep, size, tables)
        if sweep > burn:
            levels.append(state)
            seated = t if seated is None else seated.union(t)
    known = counted.select("h", "id", "c", "n")
    for i, level in enumerate(levels):
        weight = (THETA + d * F.col("tables")) / (THETA + F.col("n"))
        known = known.join(level, "id").select(*known.columns, weight.alias(f"l{i}"), F.col("p").alias(f"p{i}"))
    mean = seated.groupBy("key").agg((F.sum("t") / F.lit(float(samples))).alias("t"))
    own = again.join(mean, "key").select("key", (F.col("c") - d * F.col("t")).alias("own"))
    return Model(vocabulary, d, samples, materialize(known, "lm-known"), materialize(own, "lm-own"))


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def _score(folder: str, samples: int, tokens: int, distinct: int):
    """Scores of the documents of each unit, from its file and its answers, which follow each other."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for unit, answers in _answers_of(batches):
            held = _load(fs, f"{path}/{unit}")
            words = _in_order(answers, WORD, held["cuts"], 3 + 2 * samples)
            ids, start = words[:, 0].copy(), words[held["ends"][1]]
            new = np.isnan(ids)
            words[new, :3 + samples] = [distinct, 0, 0, *[1.0] * samples]
            words[new, 3 + samples:] = start[3 + samples:]  # the start's number is the unknown dish's
            pairs, at, u, w = _unit_pairs(held, ids, distinct)
            order, cuts = _by_part(pairs, len(held["cuts"]) - 1)
            own = np.zeros(len(pairs))
            own[order] = np.nan_to_num(_in_order(answers, PAIR, cuts, 1)[:, 0])
            lp = np.log10(_unseen(words[u], words[w], samples) + own / (THETA + words[u, 2]))
            sizes, n = held["sizes"], len(held["sizes"])
            owner, follow, count = np.repeat(np.arange(n), sizes), held["follow"], words[:, 1]
            base = np.bincount(owner, base_score(count, tokens, distinct)[follow], n)
            known = np.bincount(owner, (count > 0)[follow], n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held["docs"], mask=held["null"]), pa.array(held["held"]), pa.array(sizes.astype(np.int64)),
                 pa.array(known.astype(np.int64)), pa.array(np.full(n, tokens, np.int64)), pa.array(base),
                 pa.array(np.bincount(owner, lp[at], n))], schema=schema)

    return run


def ask_documents(docs: DataFrame, vocabulary: Vocabulary, folder: str) -> DataFrame:
    """Pack ``docs`` (doc_id, held, text) into units in ``folder``; rows of what the units ask."""
    parts = vocabulary.parts
    words = materialize(docs.mapInArrow(_pack(parts, folder), ASKED), "lm-asked")
    ids = vocabulary.words.select("h", "id").mapInArrow(_split_rows(parts, "h", ["id"]), PARTS)
    pairs = (answer(words, ids, 1).repartition("unit").sortWithinPartitions("unit")
             .mapInArrow(_ask_pairs(parts, folder, vocabulary.size), ASKED))
    return words.union(materialize(pairs, "lm-asked"))


def score_documents(docs: DataFrame, burn: int = 2, samples: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs`` (doc_id,
    text); learns from the rows that :func:`held_out` leaves."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), "text")
    vocabulary, words = learn_words(docs.where("NOT held"))
    folder, parts = scratch(docs.sparkSession, "lm-units"), vocabulary.parts
    asked = ask_documents(docs, vocabulary, folder)
    pairs = materialize(total_by_part(asked.where(F.col("kind") == PAIR)), "lm-pairs")
    model = learn(pairs, words, vocabulary, burn, samples)
    known = model.words.mapInArrow(_split_rows(parts, "h", model.columns), PARTS)
    own = pairs.mapInArrow(_once(model.d), PARTS).union(model.again.mapInArrow(_split_rows(parts, "key", ["own"]), PARTS))
    answers = (answer(asked.where(F.col("kind") == WORD), known, len(model.columns))
               .union(answer(asked.where(F.col("kind") == PAIR), own, 1)))
    return (answers.repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(_score(folder, samples, vocabulary.tokens, vocabulary.distinct), SCORES))


def perplexity(scores: DataFrame, column: str = "score") -> DataFrame:
    """Perplexity per token of the held-out and of the training rows of :func:`score_documents`."""
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens")).alias("perplexity"))


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
