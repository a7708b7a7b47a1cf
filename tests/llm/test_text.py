"""Language model (2), personal data (3) and toxicity (6): brute force, held-out figures, odd inputs."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.odd import odd
from tillwise.llm import op02_pitman_yor as lm
from tillwise.llm import op03_pii as pii
from tillwise.llm import op06_toxicity as toxicity
from tillwise.llm.common import scratch


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def is_held(doc_id, n, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == rest


def check_base(docs, scores):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    count = Counter(w for i, t in rows if not is_held(i, 7, 2) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), is_held(i, 7, 2), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), 4)) for i, t in rows)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in scores)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(abs(a[5] - b[5]) < 1e-3 for a, b in zip(got, want))


def test_language_model_beats_its_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scored = lm.score_documents(docs)
    rows = scored.collect()
    check_base(docs, rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score < 0 for r in rows)
    found = {r.held_out: r.perplexity for r in lm.perplexity(scored).collect()}
    base = {r.held_out: r.perplexity for r in lm.perplexity(scored, "base_score").collect()}
    for side in (True, False):
        mine = [r for r in rows if r.held_out == side]
        assert abs(math.log10(found[side]) + sum(r.score for r in mine) / sum(r.n_tokens for r in mine)) < 1e-9
        assert found[side] < base[side]


def test_too_many_words_are_refused(spark, monkeypatch):
    monkeypatch.setattr(lm, "MAX_WORDS", 3)
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(ValueError):
        lm.learn_words(docs)


def test_same_scores_in_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = lm.score_documents(docs).collect()
    again = {r.doc_id: r.score for r in lm.score_documents(docs.repartition(5)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 * abs(r.score) for r in rows)


def test_language_model_on_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "UNIT", 5_000)
    rows = lm.score_documents(odd(spark)).collect()
    check_base(odd(spark), rows)
    assert all(math.isfinite(r.score) for r in rows)
    assert lm.score_documents(odd(spark, [])).count() == 0
    only_held = [(i, "some text") for i in range(60) if is_held(i, 7, 2)]
    alone = lm.score_documents(odd(spark, only_held)).collect()
    assert alone and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in alone)


@pytest.mark.parametrize("c, a, d", [(2, 0.5, 0.5), (60, 2.0, 0.6), (400, 0.01, 0.8)])
def test_seating_has_the_distribution_of_one_customer_after_another(c, a, d):
    rng, n = np.random.default_rng(1), 4000
    plain = []
    for _ in range(n):
        t = 1
        for seated in range(1, c):
            t += rng.random() < a / (a + seated - d * t)
        plain.append(t)
    ours = lm.seat(np.full(n, c), np.full(n, a), d, np.arange(n), 1)
    error = 5 * np.std(plain) / math.sqrt(n) * 1.5 + 1e-9
    assert abs(np.mean(ours) - np.mean(plain)) < error and ours.min() >= 1 and ours.max() <= c


def test_model_probabilities_sum_to_one(spark):
    """Over all types that can follow a context: seen pairs and unseen ones."""
    docs = spark.createDataFrame([(i, "a b a c b a b" if i % 2 else "c a b d d") for i in range(30)], "doc_id bigint, text string")
    training = docs.withColumn("held", F.lit(False))
    vocabulary, rare = lm.learn_words(training)
    asked = lm.ask_documents(training, vocabulary, scratch(spark, "test-units"))
    pairs = lm.total_by_part(asked.where(F.col("kind") == lm.PAIR))
    model = lm.learn(pairs, rare, vocabulary)
    seen = {k: c for r in pairs.collect() for k, c in zip(r["keys"], r["values"])}
    for context in {p >> 32 for p in seen}:
        every = np.array([context << 32 | w for w in range(vocabulary.size + 1)])
        p = model.unseen(every)
        known = np.array([x in seen for x in every])
        p[known] = model.seen(every[known], np.array([seen[x] for x in every[known].tolist()]))
        assert abs(p.sum() - 1) < 1e-9


def test_every_training_word_has_a_context_and_a_dish(spark):
    """Rare words that end alike are told apart: each one's own follower is likelier than another's."""
    rare = [f"r{i}xx" for i in range(40)]
    train = [i for i in range(400) if not is_held(i, 7, 2)]
    texts = [(i, f"{rare[n % 40]} f{n % 40}yy " + "a b c " * 40) for n, i in enumerate(train)]
    out = [i for i in range(1000, 2000) if is_held(i, 7, 2)][:2]
    docs = spark.createDataFrame([*texts, (out[0], "r3xx f3yy"), (out[1], "r3xx f4yy")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm.score_documents(docs).where("held_out").collect()}
    assert got[out[0]].score - got[out[1]].score > 1 and got[out[0]].n_known == 3
    vocabulary, words = lm.learn_words(docs)
    assert sorted(r.id for r in words.collect()) == list(range(vocabulary.size + 1)) and vocabulary.size == 40 + 40 + 3 + 1


def test_sweeps_join_only_words_of_pairs_that_occur_again(spark, monkeypatch):
    train = [i for i in range(300) if not is_held(i, 7, 2)]
    docs = spark.createDataFrame([(i, "a b" if n < 9 else f"x{n} y{n}") for n, i in enumerate(train)], "doc_id bigint, text string")
    stored, materialize = {}, lm.materialize

    def keep(df, name):
        stored[name] = materialize(df, name)
        return stored[name]

    monkeypatch.setattr(lm, "materialize", keep)
    few = sorted(lm.score_documents(docs).collect())
    met = {r.h for r in stored["lm-counted"].where("met").collect()}
    assert met == {lm.word_hash(w) for w in (lm.START, lm.END, b"a", b"b")}
    assert stored["lm-counted"].count() > 2 * (len(train) - 9)
    monkeypatch.setattr(lm, "materialize", materialize)
    monkeypatch.setattr(lm, "BROADCAST_ROWS", 0)  # the same joins shuffled
    assert sorted(lm.score_documents(docs).collect()) == few


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_base_patterns_equal_the_plain_expressions():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("ab1@.. -é2%") for _ in range(rng.randint(0, 24)))
        assert [m.span() for m in EMAIL.finditer(t)] == list(pii.emails(t))
        assert [m.span() for m in IP.finditer(t)] == [m.span() for m in pii.IP.finditer(t)]


def test_random_field_splits_what_the_patterns_swallow():
    w = np.array(list(pii.PRIOR.values()))
    base, spans = pii.find_spans("a 4539148803436467 4485275742308327 b", w)
    assert base == [] and spans == [("card", 2, 18), ("card", 19, 35)]
    base, spans = pii.find_spans("é +1 (826) 555-4081 190.137.223.204 x", w)
    assert base == [("ip", 20, 35)] and spans == [("ip", 20, 35), ("phone", 2, 19)]
    for clean in ("Version 2.0, 4.0.", "1.2.3.4.5", "300.1.2.3", "1234567890123456", "+1 2", "a@b", "x@y@z"):
        assert pii.find_spans(clean, w)[1] == pii.find_spans(clean, w)[0]


def test_an_address_part_of_thousands_of_zeros():
    text = "0" * 5000 + "1.2.3.4"
    assert pii.base_spans(text) == [("ip", 0, len(text))] and pii.is_ip("0.00.000.255") and not pii.is_ip("0256.1.1.1")


def test_counts_are_those_of_base_spans(spark):
    texts = ["a 4539148803436467 4485275742308327 b", "é +1 (826) 555-4081 190.137.223.204 x", "a@b.co 10.0.0.1", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(docs, np.array(list(pii.PRIOR.values()))).collect()}
    for i, text in enumerate(texts):
        base = pii.base_spans(text or "")
        kinds = [k for k, _, _ in base]
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [kinds.count(k) for k in pii.KINDS]
        assert got[i].base_sha256 == hashlib.sha256(pii.join_spans(base).encode()).hexdigest()
        assert len([x for x in got[i].spans.split(",") if x]) == len(base) + got[i].n_added
    assert [got[i].n_added for i in range(5)] == [2, 1, 0, 0, 0]


def test_best_spans_equal_the_best_of_all_segmentations():
    rng, w = random.Random(8), np.array(list(pii.PRIOR.values()))
    for _ in range(60):
        t = " ".join(rng.choice(["4539148803436467", "4485 2757 4230 8327", "10.0.0.1", "+1 (826) 555-4081", "12"]) for _ in range(3))
        lat = pii.lattice(t, 0, len(t))
        if not lat:
            continue

        def total(chosen):
            score, state, last = 0.0, "other", None
            for s, e, kind, feats in chosen:
                state = state if last == s else "other"
                score += w[feats].sum() + w[pii.FEATURES[f"after {state}:{kind}"]]
                state, last = kind, e
            return score

        def search(at, chosen):
            yield total(chosen)
            for c in lat[0]:
                if c[0] >= at:
                    yield from search(c[1], [*chosen, c])

        best = max(search(0, []))
        spans = {(s, e, k) for s, e, k in pii.best_spans(lat, w)}
        assert abs(total(sorted((c for c in lat[0] if c[:3] in spans))) - best) < 1e-9


def test_personal_data_of_odd_and_long_texts(spark):
    docs = odd(spark)
    w = pii.train(docs)
    assert len(pii.personal_data(docs, w).collect()) == 19 and np.isfinite(w).all()
    assert pii.personal_data(odd(spark, []), pii.train(odd(spark, []))).count() == 0
    start = time.time()
    for t in ("1" * 50_000, "a@" * 20_000, "+1(" * 10_000, "1.2." * 10_000, "a" * 100_000):
        pii.find_spans(t, w)
    assert time.time() - start < 30


def test_folding_keeps_length_and_undoes_disguises():
    assert toxicity.fold("1D10T cl0wn Іdіot p@thetic ｓcum 1999") == "idiot clown idiot pathetic scum 1999"
    for t in ("İstanbul", "Straße 1a", "", "😀a1"):
        assert len(toxicity.fold(t)) == len(t)


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = (toxicity.score(docs, model).select("row.doc_id", "score").join(labels, "doc_id")
            .where(toxicity.held_out(F.col("doc_id"))).collect())
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.85 and sum(s >= 0.5 for s in clean) / len(clean) < 0.01
    assert toxicity.find_matches("such an 1d10t", model) and not toxicity.find_matches("such a day", model)
    # Held-out labels are never looked at.
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, other) == model


def test_all_phrases_of_a_text_count_and_all_exceptions_are_kept(spark):
    model = toxicity.Model({"scum$": 5.0})
    words = ["".join(chr(97 + n // 26 ** i % 26) for i in range(3)) + "q" for n in range(1100)] + ["zzz"]
    text = ". ".join(f"{w} scum" for w in words)
    rows = spark.createDataFrame([(text, 0)] * 5 + [(text.replace(words[7] + " scum", ""), 1)], "text string, toxic int")
    toxic_holds_none = spark.createDataFrame([(text, 0)] * 5 + [("scum", 1)], "text string, toxic int")
    assert "zzz scum" not in toxicity._calibrate(rows, model, 0.2).exceptions
    found = toxicity._calibrate(toxic_holds_none, toxicity.Model({"scum$": 5.0}), 0.2).exceptions
    assert {f"{w} scum" for w in words} <= found


def test_exception_phrases_and_odd_documents(spark):
    model = toxicity.Model({"scum$": 5.0, "lowei": 4.0}, {"pond scum"}, (-3.0, 2.0, 5.0))
    assert [m[:3] for m in toxicity.find_matches("Scum of loweisch, pond scum", model)] == [(0, 4, "scum$"), (8, 13, "lowei")]
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (2, 0), (2, 0), (99, 1)], "doc_id bigint, toxic int")
    for found in (labels, labels.where("doc_id = 99")):
        scored = toxicity.score(docs, toxicity.train(docs, found))
        assert scored.count() == 19 and scored.select("row.*").columns == docs.columns
        assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.score(odd(spark, []), model).count() == 0


def plain_find(text, model):
    """Every entry tried at every word beginning, the longest kept; whole neighbour words by hand."""
    folded, found = toxicity.fold(text), []
    for start in range(len(folded)):
        if start and folded[start - 1].isalpha():
            continue
        best = None
        for entry, weight in model.weights.items():
            letters, end = entry.removesuffix("$"), start + len(entry.removesuffix("$"))
            if folded[start:end] != letters or entry.endswith("$") and end < len(folded) and folded[end].isalpha():
                continue
            if best is None or best[1] < end:
                best = (start, end, entry, weight)
        if best:
            words = [(m.start(), m[0]) for m in toxicity.WORD.finditer(folded)]
            at = [s for s, _ in words].index(start)
            near = [f"{words[at - 1][1]} {words[at][1]}"] if at else []
            near += [f"{words[at][1]} {words[at + 1][1]}"] if at + 1 < len(words) else []
            if not set(near) & model.exceptions:
                found.append(best)
    return found


def test_matches_and_scores_equal_a_plain_scan(spark):
    model = toxicity.Model({"idio": 2.0, "idiot$": 1.5, "fool$": 1.0, "foolish": 0.7, "pathetic": 3.0, "ab": 0.25, "nasty": 1.25},
                      {"april fool", "nasty weather", "extraordinarily" * 4 + " idiots"}, (-2.0, 1.0, 3.0))
    rng = random.Random(11)
    pool = ["idiot", "1d10ts", "fool", "f00l!", "foolish", "April", "nasty", "weather", "pathetic,", "abba", "xab", "аb", "4b", "é",
            "extraordinarily" * 4, "idiots", "--", " " * 60, "\n", "word"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", "idiot", "nasty weather"]
    for text in texts:
        assert toxicity.find_matches(text, model) == plain_find(text, model), text
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(df, model).collect():
        text = texts[r.row.doc_id]
        found = plain_find(text, model)
        z = -2.0 + math.log1p(sum(m[3] for m in found)) + 3.0 * sum(m[3] for m in found) / (len(text.split()) + 20)
        assert r.n_matches == len(found) and abs(r.score - 1 / (1 + math.exp(-z))) < 1e-12


def test_a_label_is_that_of_one_text(spark):
    docs = spark.createDataFrame([(1, f"clean text number {i}") for i in range(50)] + [(2, "vile filth"), (3, "vile")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, toxic int")
    one = toxicity.train(docs, labels)
    again = toxicity.train(docs.repartition(5), labels.union(labels))
    assert one == again
