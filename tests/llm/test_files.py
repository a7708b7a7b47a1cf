"""Token ids (5), WARC (7), mixing (9) and the pipeline."""

import gzip
import hashlib
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.odd import PASSAGE, odd
from tillwise.llm import op05_token_ids as ids
from tillwise.llm import op07_warc as warc
from tillwise.llm import op09_mix as mixing
from tillwise.llm.common import scratch
from tillwise.llm.elias_fano import EliasFano
from tillwise.llm.files import filesystem


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_elias_fano_round_trip(n):
    v = np.sort(np.random.default_rng(n).integers(-10 ** 6, 10 ** 12, n))
    coded = EliasFano.from_bytes(EliasFano.build(v).to_bytes())
    assert coded.decode().tolist() == v.tolist()
    assert all(coded.get(i) == v[i] for i in range(0, n, max(1, n // 200)))
    if n >= 3000:
        assert len(EliasFano.build(np.arange(n) * 50).to_bytes()) < n * 2
    with pytest.raises(IndexError):
        coded.get(n)


def test_pieces_equal_whole_texts():
    rng, alphabet = random.Random(1), list("ab \n\t '  s.1é  \x1c\x85!,,.. ") + ["<|endoftext|>", "word", "Word,"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(20000)]
    encoder = ids.Encoder(ids.default_tokenizer(), 500)
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(found, "<u2").tolist() == encoder.encode_whole(text).ids, repr(text)


def expected(rows):
    encoder, out, start = ids.Encoder(ids.default_tokenizer()), [], 0
    coded = [(i, encoder.encode_whole(t or "").ids + [0]) for i, t in rows]
    for i, found in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes())):
        out.append((i, start, len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
        start += len(found)
    return out


def test_ids_are_put_together_a_few_pieces_at_a_time(monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " ", "a  b", "one\ntwo three", *(" ".join(rng.choices(["le", "nicht.", "été,", "a\nb", "12", ""], k=n)) for n in range(40))]
    whole = ids.Encoder(ids.default_tokenizer()).encode(texts)
    monkeypatch.setattr(ids, "PIECES_AT_ONCE", 7)
    encoder = ids.Encoder(ids.default_tokenizer())
    assert encoder.encode(texts) == whole
    assert whole == [np.asarray(encoder.encode_whole(t or "").ids, encoder.dtype).tobytes() for t in texts]


def test_putting_ids_together_holds_few_bytes_a_piece():
    encoder, words = ids.Encoder(ids.default_tokenizer()), 1000
    texts = ids.pa.array([" ".join(["le"] * words)] * 2000)
    encoder.encode_slice(texts.slice(0, 1))
    tracemalloc.start()
    out = encoder.encode_slice(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == len(texts) and most < 10 * words * len(texts)  # numpy's arrays; over 24 bytes a piece before


def test_token_files_of_odd_documents(spark):
    docs = odd(spark)
    folder = scratch(spark, "test-ids")
    manifest = ids.write_token_ids(docs, folder, ids.default_tokenizer())
    got = [tuple(r) for r in ids.read_token_ids(manifest, folder).orderBy("start").collect()]
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    fs, path = filesystem(folder)
    for r in manifest.collect():
        part = ids.IdFile(fs, f"{path}/{r.file}")
        assert sum(len(part.ids(i)) for i in range(len(part))) == r.ids and part.ids(0)[-1] == 0
    assert ids.encode_and_read(odd(spark, []), ids.default_tokenizer()).count() == 0


PAGES = [(1, "http://a/", "x" * 200), (2, "http://b/\r\nX: y", "x" * 200), (3, None, None), (4, "u", ""), (5, "u", "small"),
         (6, "u", "small"), (7, "http://é/", "é" * 60), (7, "http://é/", "é" * 60), (None, "n", "x" * 200), (-1, "m", "y" * 300),
         (9, "z", "y" * 300), (10, "long", "<p>" * 100_000)]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


def test_warc_records(spark):
    folder = scratch(spark, "test-warc")
    manifest = warc.write_warc(pages(spark, PAGES), folder, roll_bytes=600)
    got = sorted(warc.read_warc(manifest, folder).collect(), key=str)
    assert len(got) == len(PAGES) and manifest.count() > 2
    kind = {}
    for r in got:
        kind.setdefault(r.page_id, []).append((r.record_type, r.refers_to))
    assert kind[1] == [("response", None)] and kind[2] == [("revisit", 1)] and kind[None] == [("revisit", 1)]
    assert sorted(kind[7], key=str) == [("response", None), ("revisit", 7)] and kind[9] == [("revisit", -1)]
    assert kind[5] == kind[6] == kind[3] == kind[4] == [("response", None)]
    for r in got:
        html = next(h or "" for i, _, h in PAGES if i == r.page_id)
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        assert r.record_type == "revisit" or bytes(r.payload) == html.encode()
    fs, path = filesystem(folder)
    for r in manifest.collect():
        data = fs.open_input_stream(f"{path}/{r.file}", compression=None).read()
        assert hashlib.sha256(data).hexdigest() == r.sha256 and len(data) == r.bytes
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == r.records
    assert not [f for f in fs.get_file_info(__import__("pyarrow.fs").fs.FileSelector(path)) if "_temporary" in f.path]


def test_warc_bytes_do_not_depend_on_the_run(spark):
    shas = []
    for parts in (1, 4):
        folder = scratch(spark, "test-warc")
        manifest = warc.write_warc(pages(spark, PAGES).repartition(parts), folder, roll_bytes=600)
        shas.append(sorted((r.file, r.sha256) for r in manifest.collect()))
    assert shas[0] == shas[1]
    folder = scratch(spark, "test-warc")
    assert warc.read_warc(warc.write_warc(pages(spark, PAGES[:0]), folder), folder).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutations_and_their_inverse(n):
    order = mixing.Permutation(n, [1, 2, 3])
    found = order(np.arange(n))
    assert sorted(found.tolist()) == list(range(n)) and order(found, back=True).tolist() == list(range(n))


def test_shard_draws_add_up_to_the_totals():
    totals, per_shard = np.array([1000, 0, 37, 412, 9]), 64
    shards = -(-int(totals.sum()) // per_shard)
    seen = np.zeros(5, np.int64)
    for s in range(shards):
        before, counts = mixing.draw_shard(s, shards, per_shard, totals, 5)
        assert before.tolist() == seen.tolist() and (s == shards - 1 or counts.sum() == per_shard)
        seen += counts
    assert seen.tolist() == totals.tolist()


def targets(sizes):
    """Resharing step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return held | share
        held |= {s: 3.0 * sizes[s] for s in over}


def test_targets_equal_resharing_step_by_step(spark):
    rng = random.Random(5)
    for _ in range(4):
        sizes = {(None if i == 6 else f"s{i}é" if i % 2 else f"S{i}"): rng.choice([0, 1, 5, 50, 4000]) for i in range(7)}
        df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes), (sizes, got, want)


def test_mix_of_odd_documents(spark):
    docs = odd(spark)
    sized, pieces = mixing.mix(docs, block=16, shard_blocks=8)
    rows = sized.join(pieces.groupBy("k", "copy").agg(F.sum("n").alias("taken")), ["k", "copy"], "left").collect()
    assert len(rows) == 19
    by = {}
    for r in rows:
        taken = r.taken or 0
        assert 0 <= taken <= 3 * r.size
        t = by.setdefault(r.source, [0, 0, r.target, r.source_size])
        t[0], t[1] = t[0] + r.size, t[1] + taken
    for size, taken, target, source_size in by.values():
        assert size == source_size and taken == int(target + 0.5)
    slots = pieces.groupBy("shard").agg(F.countDistinct("slot").alias("n")).collect()
    assert max(r.n for r in slots) <= 8
    one = sorted(map(tuple, pieces.collect()))
    assert one == sorted(map(tuple, mixing.mix(docs.repartition(7), block=16, shard_blocks=8)[1].collect()))
    out = mixing.mixed_documents(docs, block=16, shard_blocks=8)
    assert out.columns == docs.columns
    assert out.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == sum(r.taken or 0 for r in rows)
    assert mixing.mixed_documents(odd(spark, [])).count() == 0
    assert mixing.mixed_documents(odd(spark, [(1, None), (2, " ")])).count() == 0


def test_pipeline_stages_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        path = scratch(spark, f"test-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(docs)
    ids_of = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert ids_of[0] >= ids_of[1] >= ids_of[2] >= ids_of[3]
    assert len(ids_of[1]) == kept[1].count() < len(ids_of[0])
    total = lambda d: d.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert abs(total(kept[3]) - total(kept[2])) <= 21
    assert corpus_pipeline.STAGES[4][1](spark, docs, folder).count() == docs.count()


def test_pipeline_stages_on_odd_documents(spark):
    folder = "/root/testdata/sf0.001"
    for rows in (None, []):
        docs = odd(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.count() <= docs.count() * 3
    alone = corpus_pipeline.one_per_group(spark, odd(spark), folder)
    assert sorted((r.doc_id for r in alone.collect() if r.doc_id is not None)) == [-5, 1, 4, 5, 6, 7, 9, 11, 12, 12, 13, 2 ** 40]
    assert [r.text for r in alone.collect() if r.doc_id is None] == [None]
    again = corpus_pipeline.one_per_group(spark, odd(spark).repartition(7), folder)
    assert sorted(map(str, alone.collect())) == sorted(map(str, again.collect()))


def test_rows_that_share_an_id_go_only_if_a_near_duplicate_stays(spark):
    rows = [(1, PASSAGE), (1, "another text"), (1, "a third text"), (2, PASSAGE + " more"), (2, "not a copy"),
            (None, "no id"), (None, "no id"), (None, PASSAGE), (3, ""), (3, "")]
    kept = corpus_pipeline.one_per_group(spark, odd(spark, rows), "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, PASSAGE), (1, "another text"), (1, "a third text"), (2, "not a copy"), (None, "no id"), (3, ""), (3, "")], key=str)
    lone = corpus_pipeline.one_per_group(spark, odd(spark, [(5, PASSAGE), (5, PASSAGE + " more")]), "")
    assert lone.count() == 1


def test_whole_pipeline_on_odd_and_empty_tables(spark):
    for rows in (None, []):
        folder = scratch(spark, "test-tables")
        for name in ("labels", "benchmark"):
            whole = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
            (whole if rows is None else whole.limit(0)).write.parquet(f"{folder}/{name}.parquet")
        odd(spark, rows).write.parquet(f"{folder}/documents.parquet")
        found = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str)
        assert found == sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str)
        assert bool(found) == (rows is None)


def test_draws_follow_the_hypergeometric_law_at_any_size():
    rng = np.random.default_rng(8)
    good, bad, n = 7, 9, 6
    drawn = np.bincount([mixing._hypergeometric(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1) / 20_000
    law = [math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(n + 1)]
    assert np.abs(drawn - law).max() < 0.015
    for good, bad, n in ((3 * 10 ** 9, 10 ** 9, 2 * 10 ** 9), (5, 10 ** 12, 10 ** 11), (10 ** 12, 5, 10 ** 12)):
        p, total = good / (good + bad), good + bad
        sd = (n * p * (1 - p) * (total - n) / (total - 1)) ** 0.5
        draws = np.array([mixing._hypergeometric(rng, good, bad, n) for _ in range(60)], float)
        assert abs(draws.mean() - n * p) <= 5 * sd / 60 ** 0.5 + 1e-9 and draws.std() <= 2 * sd + 1e-9
        assert draws.min() >= max(0, n - bad) and draws.max() <= min(good, n)


def test_slots_are_never_broadcast_by_an_estimate(spark):
    docs = spark.createDataFrame([(i, "w " * 40, "a") for i in range(6_000)], "doc_id long, text string, source string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        _, pieces = mixing.mix(docs, block=1, shard_blocks=64)
        assert "BroadcastHashJoin" not in pieces._jdf.queryExecution().optimizedPlan().toString()
        assert "SortMergeJoin" in pieces._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
