"""Toxicity: a weighted lexicon, learned from labels, matched by Aho-Corasick on folded text.

Folding undoes what hides a word and keeps every offset: lower case, look-alike letters of other
scripts, full-width letters, and digits or signs standing for letters inside a word.

Learning.  A bounded sample of the labelled training rows (``label_rows``, the smallest hashes of
doc_id) is broadcast to the documents.  Features are whole words and word beginnings of 4 to 8
letters; for each, the numbers of toxic and other texts that hold it are counted with map-side
combining (equal texts once).  A feature enters the lexicon if the likelihood gain of its toxic share
over the base rate exceeds the log of the number of features tried, so chance finds stay out, and if
no shorter entry says the same.  Its weight is its smoothed log odds; all that pass are kept.  Exception phrases (a match with the word before or after it) are learned likewise from
matches in texts labelled clean; a match inside one counts nothing.  The score is a logistic function
of the summed weights and of that sum over the text's length.

Scoring is one pass over the texts with the lexicon in each task; nothing is shuffled.

Defined results: null or empty text has no match and gets the score of a text without matches;
repeated rows get equal scores; without training labels the lexicon is empty and every score is the
smoothed base rate.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import materialize, slices, table

# Look-alike letters by Latin letter, and signs that stand for a letter inside a word.
LOOKALIKES = {
    "a": "аαɑ", "b": "ЬЪ", "c": "сϲ", "d": "ԁ", "e": "еεҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј",
    "k": "кκ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս",
    "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ",
}
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

FOLD = {ord(c): latin for latin, alike in LOOKALIKES.items() for c in alike}
FOLD |= {0xFF41 + i: chr(97 + i) for i in range(26)} | {0xFF10 + i: chr(48 + i) for i in range(10)}
SIGNS = str.maketrans(STAND_INS)
IN_WORD = re.compile(r"(?<=[^\W\d_])[0134578@$]+|[0134578@$]+(?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 9)


def fold(text: str) -> str:
    """The text with disguises undone, of the same length."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    low = low.translate(FOLD)
    return IN_WORD.sub(lambda m: m[0].translate(SIGNS), low)


def features(folded: str) -> set[str]:
    """Whole words (ending in ``$``) and beginnings of words."""
    found = set()
    for word in set(WORD.findall(folded)):
        found.add(word + "$")
        found.update(word[:n] for n in PREFIXES if n <= len(word))
    return found


@dataclass
class Model:
    """Lexicon (feature to weight), exception phrases, logistic coefficients."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    coef: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def score(self, total: float, words: int) -> float:
        b0, b1, b2 = self.coef
        z = b0 + b1 * math.log1p(total) + b2 * total / (words + 20)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def matches(folded: str, automaton) -> list[tuple[int, int, str, float]]:
    """(start, end, entry, weight) of lexicon entries at word beginnings, longest per word."""
    best: dict[int, tuple[int, int, str, float]] = {}
    if not len(automaton):
        return []
    for last, hits in automaton.iter(folded):
        for entry, weight in hits:
            whole = entry.endswith("$")
            start = last - len(entry) + (2 if whole else 1)
            if start and _letter(folded[start - 1]):
                continue
            if whole and last + 1 < len(folded) and _letter(folded[last + 1]):
                continue
            if start not in best or best[start][1] < last + 1:
                best[start] = (start, last + 1, entry, weight)
    return [best[s] for s in sorted(best)]


def _letter(c: str) -> bool:
    return c.isalpha()


def phrases(folded: str, start: int) -> list[str]:
    """The word at ``start`` with the word before it, and with the word after it."""
    end = start
    while end < len(folded) and _letter(folded[end]):
        end += 1
    last = start
    while last and not _letter(folded[last - 1]):
        last -= 1
    first = last
    while first and _letter(folded[first - 1]):
        first -= 1
    word, after = folded[start:end], WORD.search(folded, end)
    return ([f"{folded[first:last]} {word}"] if last else []) + ([f"{word} {after[0]}"] if after else [])


class Matcher:
    """A model with its automaton; entries that share letters are kept together."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        by_letters: dict[str, list] = {}
        for entry, weight in model.weights.items():
            by_letters.setdefault(entry.removesuffix("$"), []).append((entry, weight))
        self.automaton = ahocorasick.Automaton()
        for letters, entries in by_letters.items():
            self.automaton.add_word(letters, entries)
        if by_letters:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str, float]]:
        if not len(self.automaton):
            return []
        folded = fold(text)
        found = matches(folded, self.automaton)
        if self.model.exceptions:
            found = [m for m in found if not any(p in self.model.exceptions for p in phrases(folded, m[0]))]
        return found


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    toxic, clean = Counter(), Counter()

    def flush():
        keys = list(toxic.keys() | clean.keys())
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                                          pa.array([clean[k] for k in keys], pa.int64())], schema=schema)
        toxic.clear()
        clean.clear()
        return out

    for batch in slices(batches):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            (toxic if label else clean).update(features(fold(text)))
            if len(toxic) + len(clean) > 150_000:
                yield flush()
    yield flush()


def _evidence(model: Model):
    schema = pa.schema([("toxic", pa.int32()), ("total", pa.float64()), ("words", pa.int64()),
                        ("phrases", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = matcher.find(text)
                folded = fold(text) if found else ""
                near = sorted({p for m in found for p in phrases(folded, m[0])})
                rows.append((label, sum(m[3] for m in found), len(text.split()), near))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) \
                if rows else pa.RecordBatch.from_pylist([], schema)

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_rows: int = 40_000) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text); rows whose crc32(doc_id) mod 5
    is 0, or without a label, are never looked at.  A label is that of one text: of several under its
    doc_id, the one with the smallest hash.  So at most ``label_rows`` texts are learned from, and what
    the driver gathers (features and phrases that pass, a sum and a length per text) is bounded by them."""
    wanted = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(label_rows))
    rows = materialize(docs.select("doc_id", "text").where(F.col("text").isNotNull())
                       .join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "toxic")
                       .agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
                       .select("text", "toxic"), "toxic-rows")
    base = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = base.get(1, 0), sum(n for label, n in base.items() if label != 1)
    if not n_toxic or not n_clean:
        rate = (n_toxic + 0.5) / (n_toxic + n_clean + 5.0)
        return Model(coef=(math.log(rate / (1 - rate)), 0.0, 0.0))
    counts = (rows.groupBy("text").agg(F.max("toxic").alias("toxic"))
              .mapInArrow(_count_features, "feature string, toxic long, clean long")
              .groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("n")))
    rate = n_toxic / (n_toxic + n_clean)
    share = F.col("t") / (F.col("t") + F.col("n"))
    gain = (F.col("t") * F.log(share / rate)
            + F.when(F.col("n") > 0, F.col("n") * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    tried = counts.agg(F.count("*")).first()[0]
    best = (counts.where((F.col("t") >= 2) & (share > 0.5) & (share > 2 * rate)).withColumn("gain", gain)
            .where(F.col("gain") > math.log(max(tried, 2))).collect())
    # Of nested entries that say the same, the most specific one: "pathetic", not "path".
    longest: dict[str, int] = {}
    for r in best:
        for n in range(1, len(r.feature)):
            longest[r.feature[:n]] = max(longest.get(r.feature[:n], 0), r.t)
    best = [r for r in best if longest.get(r.feature, 0) < 0.95 * r.t]
    weights: dict[str, float] = {}
    pure: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (len(r.feature), r.feature)):
        purity = r.t / (r.t + r.n)
        shorter = [r.feature[:n] for n in range(1, len(r.feature)) if r.feature[:n] in pure]
        if any(pure[s] >= purity - 0.02 for s in shorter):
            continue
        pure[r.feature] = purity
        weights[r.feature] = math.log((r.t + 0.5) / (r.n + 0.5) * (n_clean + 1) / (n_toxic + 1))
    return _calibrate(rows, Model(weights), rate)


def _calibrate(rows: DataFrame, model: Model, rate: float) -> Model:
    """Exception phrases (all that stand in five clean texts or more and in no toxic one) and logistic
    coefficients, from the at most ``label_rows`` training rows."""
    def seen():
        return rows.mapInArrow(_evidence(model), "toxic int, total double, words long, phrases array<string>")

    near = (seen().select("toxic", F.explode("phrases").alias("p")).groupBy("p")
            .agg(F.sum((F.col("toxic") == 1).cast("int")).alias("t"), F.count("*").alias("n"))
            .where((F.col("t") == 0) & (F.col("n") >= 5)).select("p").collect())
    model.exceptions = {r.p for r in near}
    data = seen().select("toxic", "total", "words").toPandas()
    y = (data["toxic"] == 1).to_numpy(float)
    total, words = data["total"].to_numpy(float), data["words"].to_numpy(float)
    order = np.lexsort((y, words, total))  # independent of the order of partitions
    y, total, words = y[order], total[order], words[order]
    x = np.stack([np.ones(len(y)), np.log1p(np.maximum(total, 0)), total / (words + 20)], 1)
    w, ridge = np.array([math.log(rate / (1 - rate)), 0.0, 0.0]), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    model.coef = tuple(float(c) for c in w)
    return model


def _score(model: Model):
    """Scores of rows (row,) with a field text, or of rows (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in slices(batches):
            first = batch.column(0)
            texts = first.field("text") if pa.types.is_struct(first.type) else batch.column("text")
            scores, counts = [], []
            for text in texts.to_pylist():
                found = matcher.find(text or "")
                scores.append(model.score(max(0.0, sum(m[3] for m in found)), len((text or "").split())))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([first, pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                                             names=[batch.schema.names[0], "score", "n_matches"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row: struct of all columns of ``docs``, score, n_matches) per row."""
    given = docs.select(F.struct("*").alias("row"))
    schema = T.StructType([given.schema["row"], T.StructField("score", T.DoubleType()),
                           T.StructField("n_matches", T.LongType())])
    return given.mapInArrow(_score(model), schema)


def find_matches(text: str | None, model: Model) -> list[tuple[int, int, str, float]]:
    """The spans (code points), lexicon entries and weights that a text's score rests on."""
    return Matcher(model).find(text or "")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(model), "doc_id long, score double, n_matches long")
    return slim.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")
