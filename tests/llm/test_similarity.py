"""N-gram join (1), fingerprints (4), line dedup (8) and decontamination (10) on odd and small inputs."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.odd import LONG, PASSAGE, odd
from tillwise.llm import op01_ngram_join as ngram
from tillwise.llm import op04_imatch as imatch
from tillwise.llm import op08_line_dedup as lines
from tillwise.llm import op10_decontaminate as decon
from tillwise.llm.common import components, materialize
from tillwise.llm.shingles import shingle_set


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def roots(n, links):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_shingle_hashes_stand_for_shingles():
    random.seed(2)
    for _ in range(300):
        t = " ".join(random.choice(["a", "B", "b", "é", "É", "cc\td", "\x0b", "x y"]) for _ in range(random.randint(0, 14)))
        u = " ".join(random.choice(["a", "b", "é"]) for _ in range(random.randint(0, 14)))
        assert len(shingle_set(t)) == len(shingles(t))
        assert len(np.intersect1d(shingle_set(t), shingle_set(u))) == len(shingles(t) & shingles(u))


@pytest.mark.parametrize("share", [0.05, 0.15, 0.3])
def test_block_search_equals_brute_force(share):
    rng = np.random.default_rng(int(share * 100))
    for _ in range(12):
        sets = []
        for _ in range(int(rng.integers(1, 4))):
            base = rng.integers(0, 2 ** 63, int(rng.integers(1, 80))).astype(np.uint64)
            for _ in range(int(rng.integers(2, 50))):
                x, n = base.copy(), int(rng.integers(0, int(len(base) * share) + 1))
                x[rng.choice(len(base), n, replace=False)] = rng.integers(0, 2 ** 63, n).astype(np.uint64)
                sets.append(np.unique(x[:int(rng.integers(max(1, len(x) // 2), len(x) + 1))]))
        sides = rng.integers(0, 2, len(sets)).tolist()
        held = [set(s.tolist()) for s in sets]
        links = [(a, b) for a, b in combinations(range(len(sets)), 2)
                 if ngram.linked(len(held[a] & held[b]), len(held[a]), len(held[b]))]
        assert roots(len(sets), ngram.links_in_block(sets)) == roots(len(sets), links)
        across = [(a, b) for a, b in links if sides[a] != sides[b]]
        assert roots(len(sets), ngram.links_in_block(sets, sides)) == roots(len(sets), across)


def test_merges_agree():
    rng = np.random.default_rng(4)
    lists = [np.unique(rng.integers(0, 40, int(rng.integers(1, 30)))) for _ in range(15)]
    for least in (1, 2, 5, 9, 15):
        heap, count = ngram.merge_skip(lists, least), ngram.merge_count(lists, least, 0, 40)
        assert heap[0].tolist() == count[0].tolist() and heap[1].tolist() == count[1].tolist()


def test_near_duplicates_of_odd_documents(spark):
    got = ngram.jaccard_components(odd(spark)).collect()
    assert len(got) == 19
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i: by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)} == {
        1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9, 10: 9, 11: 11}
    assert by[4].n_shingles == by[5].n_shingles == by[6].n_shingles == 0 and by[9].n_shingles == 1
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert ngram.jaccard_components(odd(spark, [])).count() == 0


def test_large_block_in_parts_finds_the_same(spark, monkeypatch):
    """Blocks split into pairs of parts (as for more shingles than a task may hold)."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(w)))
    links = [(a, b) for a, b in combinations(range(90), 2)
             if ngram.linked(len(shingles(docs[a][1]) & shingles(docs[b][1])), len(shingles(docs[a][1])), len(shingles(docs[b][1])))]
    monkeypatch.setattr(ngram, "BLOCK", 4000)
    got = {r.doc_id: r.component_id for r in ngram.jaccard_components(odd(spark, docs)).collect()}
    assert [got[i] for i in range(90)] == roots(90, links)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(50)] + [(-3, 5), (5, -3)]
    df = materialize(spark.createDataFrame(edges, "a bigint, b bigint"), "edges")
    got = {r.id: r.root for r in components(df).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[1000 + i] for i in range(50)} == {7}
    assert got[5] == got[-3] == -3
    assert components(df.where("a > 10000")).count() == 0


def test_fingerprints_of_odd_documents(spark):
    docs = odd(spark)
    got = imatch.fingerprint_documents(docs, materialize(imatch.lexicon(docs), "lex")).collect()
    assert len(got) == 19
    prints = {}
    texts = [(i, t) for i, t in [(r.doc_id, r.text) for r in docs.collect()]]
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] == prints[3] and prints[5] == prints[4] and prints[9] == prints[10]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    # Descending ids: after -5 come the null ids, after 2**40 comes 13.
    far, after = "far away id", next(t for i, t in texts if i == 13)
    edit = far[:len(far) - len(far) // 2] + after[:len(far) // 2]
    assert by[2 ** 40].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest() and by[7].n_chars == len(LONG)
    empty = odd(spark, [])
    assert imatch.fingerprint_documents(empty, materialize(imatch.lexicon(empty), "lex")).count() == 0
    one = imatch.fingerprint_documents(odd(spark, [(1, "abc")]), materialize(imatch.lexicon(odd(spark, [(1, "abc")])), "lex")).first()
    assert one.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and one.near_next == 1.0


def test_half_edits_are_nearer_than_the_next_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    got = imatch.fingerprint_documents(docs, materialize(imatch.lexicon(docs), "lex")).toPandas()
    assert got["near_edited"].mean() > 2 * got["near_next"].mean()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, times):
    out = list(text)
    for _ in range(times):
        i, how = rng.randint(0, len(out)), rng.random()
        if how < 0.4 or not out:
            out.insert(i, rng.choice("abc"))
        elif how < 0.7:
            out.pop(min(i, len(out) - 1))
        else:
            out[min(i, len(out) - 1)] = rng.choice("abc")
    return "".join(out)


def test_banded_distance_and_segments_against_brute_force():
    rng = random.Random(6)
    for _ in range(6000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 16)))
        b, k = edited(rng, a, rng.randint(0, 4)), rng.randint(0, 4)
        d = distance(a, b)
        assert lines.within(a, b, k) == (d <= k)
        for threshold in (1, 2, 3):
            if d <= threshold:
                left = {(key, p) for key, p, _, _ in lines.entries(a, 0, threshold)}
                assert any((key, not p) in left for key, p, _, _ in lines.entries(b, 0, threshold))


@pytest.mark.parametrize("threshold", [1, 2])
def test_line_links_of_a_family_equal_brute_force(spark, threshold):
    """More lines under one segment than a key may hold, so keys are partitioned again."""
    rng = random.Random(threshold)
    base, found = "the quick brown fox jumps over the lazy dog again", set()
    while len(found) < 220:
        out = list(base)
        for _ in range(rng.randint(1, 2)):
            out[rng.randrange(len(out))] = rng.choice("xyz")
        found.add("".join(out))
    found = sorted(found)
    got = {tuple(sorted(r)) for r in lines.line_links(spark.createDataFrame([(x,) for x in found], "line string"), threshold).collect()}
    name = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert got == {tuple(sorted((name(a), name(b)))) for a, b in combinations(found, 2) if distance(a, b) <= threshold}


def test_line_links_grow_with_the_length_and_equal_brute_force(spark):
    """Lines of 5 to 400 characters and copies with edits around what their length allows; more copies of
    one line than a key may hold, and one passage in lines of every length."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    found = set()
    for n in [*range(5, 70), *range(70, 400, 15)]:
        base = " ".join(word() for _ in range(n))[:n].strip()
        found |= {base, *(edited(rng, base, rng.randint(1, lines.allowed(n) + 2)).strip() for _ in range(4))}
    family = " ".join(word() for _ in range(40))[:120]
    found |= {edited(rng, family, rng.randint(1, 5)).strip() for _ in range(90)}
    passage = " ".join(word() for _ in range(8))
    found |= {" ".join([*(word() for _ in range(rng.randint(0, 9))), passage, word()]) for _ in range(60)}
    found = sorted(found)
    got = {tuple(sorted(r)) for r in lines.line_links(spark.createDataFrame([(x,) for x in found], "line string")).collect()}
    name = lambda x: hashlib.md5(x.encode()).hexdigest()
    want, far = set(), 0
    for a, b in combinations(found, 2):
        k = lines.allowed(max(len(a), len(b)))
        if abs(len(a) - len(b)) <= k and (sum((Counter(a) - Counter(b)).values()) <= k) and (d := distance(a, b)) <= k:
            want.add(tuple(sorted((name(a), name(b)))))
            far += d > 1
    assert got == want and far > 500 and any(len(x) < 20 for x in found)


def test_line_entries_that_meet_nothing_do_not_travel(spark):
    """Of the entries of 400 unlike lines and one near copy, little more than those of the two are sent."""
    rng = random.Random(4)
    found = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(300)).strip() for _ in range(400)]
    found.append(found[0][:150] + "XYZ" + found[0][150:])
    df = spark.createDataFrame([(x,) for x in found], "line string").repartition(4)
    _, kept = lines.kept_entries(df)
    total = sum(len(lines.anchors(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x)]))[0]) for x in found)
    sent = kept.agg({"count": "sum"}).first()[0]
    assert total > 400 * 50 and 2 * 40 < sent < total / 50
    name = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert [tuple(sorted(r)) for r in lines.line_links(df).collect()] == [tuple(sorted((name(found[0]), name(found[-1]))))]


def test_lines_in_several_units_belong_to_one(spark):
    """Units of one batch each, the same lines in all of them: links are those of the distinct lines."""
    rng = random.Random(5)
    found = ["é".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(12)) for _ in range(20)]
    found += [edited(rng, x, 3) for x in found]
    df = spark.createDataFrame([(x,) for x in found * 3], "line string").repartition(7)
    known, kept = lines.kept_entries(df)
    assert known.select("unit").distinct().count() > 1
    assert kept.select("unit", "part").distinct().count() == kept.count()
    name = lambda x: hashlib.md5(x.encode()).hexdigest()
    want = {tuple(sorted((name(a), name(b)))) for a, b in combinations(sorted(set(found)), 2)
            if abs(len(a) - len(b)) <= 6 and distance(a, b) <= lines.allowed(max(len(a), len(b)))}
    assert {tuple(sorted(r)) for r in lines.line_links(df).collect()} == want and len(want) >= 20


def test_line_parts_hold_alike_many_entries():
    """Anchors are the least hashes of their windows; the parts that their hashes choose are even all the same."""
    rng = random.Random(7)
    data = np.frombuffer("".join(rng.choice("abcdefghijklmnop ") for _ in range(200_000)).encode(), np.uint8)
    _, grams = lines.anchors(data, np.array([0]), np.array([len(data)]))
    held = np.bincount(lines._part_of(grams, 16).astype(np.int64), minlength=16)
    assert len(grams) > 40_000 and held.max() < 1.2 * held.mean()


def test_pairs_of_a_part_leave_it_some_at_a_time(monkeypatch):
    """300 lines meet under one gram: all their pairs are found, but few are held at a time; cells of some entries
    at a time are those of all."""
    monkeypatch.setattr(lines, "MEET", 1_000)
    monkeypatch.setattr(lines, "STEP", 64)
    rng = np.random.default_rng(8)
    n = rng.integers(100, 104, 300)
    grams, links, at, line = np.full(300, 9 << 24, np.uint64), np.zeros(300, np.uint64), np.full(300, 40), np.arange(300)
    found = list(lines.meetings(grams, links, n, at, line))
    assert max(map(len, found)) <= 1_000 + 300
    assert {tuple(sorted(p)) for x in found for p in x.tolist()} == set(combinations(range(300), 2))
    assert list(map(len, lines.meetings(*(x[:0] for x in (grams, links, n, at, line))))) == [0]
    at = rng.integers(0, 90, 300)
    (a, b), (c, d) = lines._all_cells(grams, n, at, line), lines.cells(grams, n, at, line)
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(c.tolist(), d.tolist()))


@pytest.mark.parametrize("threshold", [None, 0, 1, 3, 40])
def test_pairs_verified_in_step_equal_one_by_one(threshold, monkeypatch):
    """Pairs of 1 to 900 characters in four alphabets, compared some at a time, and the sketches that rule pairs out."""
    monkeypatch.setattr(lines, "PIECE", 50_000)
    rng = random.Random(9)
    pairs = []
    for _ in range(700):
        letters = rng.choice(["ab", "abcdefgh é", "日本語abc😀", "abcdefghijklmnop"])
        base = "".join(rng.choice(letters) for _ in range(rng.choice([rng.randint(1, 60), rng.randint(60, 660), 900])))
        pairs.append((base, edited(rng, base, rng.randint(0, 2 * lines.allowed(len(base)) + 1))))
    want = [lines.within(a, b, lines.allowed(max(len(a), len(b))) if threshold is None else threshold) for a, b in pairs]
    s, t = (pa.array(x) for x in zip(*pairs))
    assert lines.nears(s, t, threshold).tolist() == want and 20 < sum(want)
    assert lines.nears(s[:0], t[:0], threshold).tolist() == []


def test_class_links_verify_few_pairs_of_a_family_and_keep_its_classes(spark):
    """Families of 40 copies with up to 3 edits: all their pairs are links, few are needed; classes are equal."""
    rng = random.Random(6)
    found = set()
    for size in (120, 90, 40):
        base = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))[:size].strip()
        found |= {edited(rng, base, rng.randint(1, 3)).strip() for _ in range(40)}
    df = spark.createDataFrame([(x,) for x in sorted(found)], "line string")
    every, few = ({tuple(sorted(r)) for r in f(df).collect()} for f in (lines.line_links, lines.class_links))

    def classes(links):
        root = {x: x for pair in every for x in pair}
        find = lambda x: x if root[x] == x else find(root[x])
        for x, y in links:
            root[find(x)] = find(y)
        return {frozenset(x for x in root if find(x) == r) for r in map(find, root)}

    assert few <= every and classes(few) == classes(every) and len(few) < len(every) / 2


def test_line_dedup_of_odd_documents(spark):
    docs = odd(spark)
    kept = {}
    for r in lines.classify_lines(docs.select("doc_id", "text")).collect():
        kept.setdefault((r.doc_id, r.row), []).append((r.at, r.keep))
    assert len(kept) == 19
    by = {}
    for (doc_id, _), found in kept.items():
        by.setdefault(doc_id, []).append(sorted(found, key=str))
    assert by[4] == [[(None, False)]] or by[4][0][0][0] is None
    assert by[1] == [[(0, False)]] and sorted(map(str, by[None]))[0]                       # a null id stands first
    assert by[13] == [[(0, True), (1, True), (2, True), (3, False), (4, True)]]            # near the line of -5
    assert by[-5] == [[(0, True)]]
    out = {r.doc_id: r for r in lines.dedup_documents(docs).where("doc_id IN (13, 9, 10, 4)").collect()}
    assert out[13].text == "a\n\nb\n" and out[9].text == "one" and out[10].text == "" and out[4].text is None
    assert lines.dedup_documents(docs).columns == docs.columns
    assert lines.classify_lines(odd(spark, []).select("doc_id", "text")).count() == 0


def contaminated(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    w, hit, names = split(text), set(), set()
    for item_id, item in items:
        iw = split(item)
        size = min(13, len(iw))
        windows = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if iw else set()
        for s in range(len(w) - size + 1):
            if size and tuple(w[s:s + size]) in windows:
                hit.update(range(s, s + size))
                names.add(str(item_id))
    return len(w), len(hit), sorted(names)


def test_decontamination_of_odd_documents(spark):
    items = [(1, PASSAGE), (1, PASSAGE), (2, "one"), (3, "two words"), (4, None), (5, ""), (6, "..."), (10, "word3 word4"),
             (None, "far away id"), (7, " ".join(["again"] * 20))]
    docs = odd(spark, [(20, " ".join(["again"] * 15)), (21, "x " * 5000 + PASSAGE.upper() + " y" * 10)]
               + [(r.doc_id, r.text) for r in odd(spark).collect()])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decon.find_contamination(docs, bench)
    assert got.select("row.*").columns == docs.columns and got.count() == 21
    for r in got.collect():
        n, hit, names = contaminated(r.row.text, [x for x in items if x[0] is not None])
        extra = contaminated(r.row.text, [x for x in items if x[0] is None])[1]
        assert r.n_words == n and list(r["items"]) == names and (r.n_hit == hit or extra), r.row.doc_id
    assert decon.find_contamination(docs, bench.where("item_id = 4")).agg({"n_hit": "sum"}).first()[0] == 0
    assert decon.find_contamination(odd(spark, []), bench).count() == 0
