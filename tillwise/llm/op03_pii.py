"""Personal data: patterns, and a semi-Markov conditional random field over candidate spans.

Base spans are the leftmost matches of four patterns, one kind at a time; a match that fails its check
(part over 255, digit count, check digit) is dropped with all it swallowed, so a card next to another
number, or a phone number before an address, is lost.  The random field looks at the same places as a
whole: every window of digits and signs is a lattice of tokens (digit runs and single signs) whose
segments are either one token of other text or a candidate entity of at most ``MAX_TOKENS`` tokens.
Each candidate is scored by features of the whole span (check digit, digit count, grouping, parts,
brackets) and of its edges (touching digits, a dotted neighbour), each transition by the kinds of
neighbouring segments; a dynamic programme over (position, last kind) picks boundaries and kinds
together.  Spans that it finds and that overlap no base span are added; base spans always stay.

Weights are learned here by maximising the conditional likelihood of base spans in the windows of a
bounded sample of documents (``sample_docs`` smallest hashes of doc_id, ``sample_windows`` windows),
with a Gaussian prior around fixed starting weights, so that a corpus without personal data leaves
those.  Scoring is one pass over the texts; nothing is shuffled.  Work is linear in the text's length,
also for runs of a hundred thousand digits.

Defined results: null or empty text has no spans; repeated rows get equal results; offsets are code
points of the text as given.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import slices, table

KINDS = ("email", "ip", "card", "phone")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WINDOW = re.compile(r"[+(]?[0-9][0-9\x20().+-]*[0-9]")
TOKEN = re.compile(r"[0-9]+|[^0-9]")
DIGIT = re.compile(r"[0-9]")
DIGIT_RUN = re.compile(r"[0-9]+")
MAX_TOKENS = 40

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 13 <= len(d) <= 19 and luhn(d)


def is_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each at sign, so long words without one cost nothing."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and (c := text[start - 1]) < "\x7f" and (c.isalnum() or c in "._%+-"):
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind as listed, then start."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for kind, pattern, check in (("ip", IP, is_ip), ("card", CARD, is_card), ("phone", PHONE, is_phone)):
            if kind != "phone" or "+" in text:
                found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if check(m[0])]
    return found


# Whole-span features by kind, with the starting weights that the prior holds.
PRIOR: dict[str, float] = {
    "ip:bias": 1.0, "ip:edge digit or dot": -6.0, "ip:leading zero": -1.0,
    "card:bias": 1.0, "card:one run or even groups": 1.5, "card:ragged groups": -3.0, "card:16 digits": 1.0,
    "card:edge digit": -3.0, "card:part of a dotted number": -4.0,
    "phone:bias": 1.0, "phone:brackets": 1.0, "phone:open bracket": -4.0, "phone:last group of 4": 1.0,
    "phone:group over 5": -1.5, "phone:dotted quad inside": -4.0, "phone:double space": -2.0,
    "phone:edge digit": -2.0, "phone:stops inside a group list": -1.0,
}
for _a in ("other", "ip", "card", "phone"):
    for _b in ("ip", "card", "phone"):
        PRIOR[f"after {_a}:{_b}"] = 0.0
FEATURES = {name: i for i, name in enumerate(PRIOR)}
QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


def span_features(kind: str, text: str, a: int, b: int) -> list[str]:
    span, left, right = text[a:b], text[max(0, a - 2):a], text[b:b + 2]
    near_digit = bool(re.search(r"[0-9][ -]?\Z", left)) or bool(re.match(r"[ -]?[0-9]", right))
    dotted = bool(re.search(r"[0-9]\.\Z", left)) or bool(re.match(r"\.[0-9]", right))
    out = [f"{kind}:bias"]
    if kind == "ip":
        if re.search(r"[0-9.]\Z", left) or re.match(r"[0-9]|\.[0-9]", right):
            out.append("ip:edge digit or dot")
        if any(len(p) > 1 and p[0] == "0" for p in span.split(".")):
            out.append("ip:leading zero")
    elif kind == "card":
        groups = [len(g) for g in re.split(r"[ -]", span)]
        even = len(groups) == 1 or len(set(groups[:-1])) == 1 and 1 < groups[-1] <= groups[0] or groups in ([4, 6, 5], [4, 6, 4])
        out.append("card:one run or even groups" if even else "card:ragged groups")
        if sum(groups) == 16:
            out.append("card:16 digits")
        if dotted:
            out.append("card:part of a dotted number")
        if near_digit and len(groups) > 1:
            out.append("card:edge digit")
    else:
        groups = [len(g) for g in DIGIT_RUN.findall(span)]
        if "(" in span or ")" in span:
            out.append("phone:brackets" if re.search(r"\([0-9]{1,5}\)", span) and span.count("(") == span.count(")") == 1
                       else "phone:open bracket")
        if groups[-1] == 4:
            out.append("phone:last group of 4")
        if max(groups) > 5:
            out.append("phone:group over 5")
        if QUAD.search(span):
            out.append("phone:dotted quad inside")
        if "  " in span or "--" in span:
            out.append("phone:double space")
        if dotted or re.match(r"-[0-9]", right):
            out.append("phone:stops inside a group list")
        elif near_digit:
            out.append("phone:edge digit")
    return out


def candidates(text: str, a: int, b: int) -> list[tuple[int, int, str]]:
    """Candidate entities of the window [a, b): they begin and end at token boundaries, hold at most
    MAX_TOKENS tokens and pass the check of their kind."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, a, b)]
    found = []
    for i, (s, _) in enumerate(tokens):
        first = text[s]
        if not (first.isdigit() or first == "+"):
            continue
        n_digits = 0
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            ts, te = tokens[j]
            c = text[ts]
            if not c.isdigit():
                if c == "+" and j > i:
                    break
                continue
            n_digits += te - ts
            if n_digits > 19:
                break
            if n_digits < 4:
                continue
            span = text[s:te]
            if first == "+":
                if n_digits <= 15 and PHONE.fullmatch(span) and is_phone(span):
                    found.append((s, te, "phone"))
            else:
                if n_digits <= 12 and j == i + 6 and IP.fullmatch(span) and is_ip(span):
                    found.append((s, te, "ip"))
                if n_digits >= 13 and CARD.fullmatch(span) and is_card(span):
                    found.append((s, te, "card"))
    return found


Lattice = tuple[list[tuple[int, int, str, list[int]]], list[int]]


def lattice(text: str, a: int, b: int) -> Lattice | None:
    """Candidates with feature numbers, and the positions where one begins or ends."""
    found = [(s, e, k, [FEATURES[f] for f in span_features(k, text, s, e)]) for s, e, k in candidates(text, a, b)]
    if not found:
        return None
    return found, sorted({p for s, e, _, _ in found for p in (s, e)})


STATES = ("other", "ip", "card", "phone")


def _steps(lat: Lattice, w: np.ndarray):
    """(from node, to node, kind or None, candidate number, score without transition)."""
    found, nodes = lat
    at = {p: i for i, p in enumerate(nodes)}
    by_end: list[list] = [[] for _ in nodes]
    for n, (s, e, kind, feats) in enumerate(found):
        by_end[at[e]].append((at[s], kind, n, float(w[feats].sum())))
    return nodes, by_end


def best_spans(lat: Lattice, w: np.ndarray) -> list[tuple[int, int, str]]:
    """Viterbi over (node, last kind); stepping over a node as other text scores 0."""
    found, _ = lat
    nodes, by_end = _steps(lat, w)
    score = [{"other": 0.0}]
    back: list[dict] = [{"other": None}]
    for i in range(1, len(nodes)):
        now, ptr = {}, {}
        for state, v in score[i - 1].items():
            if v > now.get("other", -math.inf):
                now["other"], ptr["other"] = v, (i - 1, state, None)
        for j, kind, n, s in by_end[i]:
            for state, v in score[j].items():
                total = v + s + w[FEATURES[f"after {state}:{kind}"]]
                if total > now.get(kind, -math.inf):
                    now[kind], ptr[kind] = total, (j, state, n)
        score.append(now)
        back.append(ptr)
    i = len(nodes) - 1
    state = max(score[i], key=lambda s: (score[i][s], s))
    out = []
    while back[i][state] is not None:
        j, before, n = back[i][state]
        if n is not None:
            out.append(found[n][:3])
        i, state = j, before
    return out[::-1]


def _expected(lat: Lattice, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Log partition function and expected feature counts, by forward and backward sums."""
    found, _ = lat
    nodes, by_end = _steps(lat, w)
    add = lambda table, key, v: table.__setitem__(key, np.logaddexp(table.get(key, -np.inf), v))
    fwd: list[dict] = [{"other": 0.0}] + [{} for _ in nodes[1:]]
    arcs = []
    for i in range(1, len(nodes)):
        for state, v in fwd[i - 1].items():
            add(fwd[i], "other", v)
            arcs.append((i - 1, state, i, "other", None, 0.0))
        for j, kind, n, s in by_end[i]:
            for state, v in fwd[j].items():
                total = s + w[FEATURES[f"after {state}:{kind}"]]
                add(fwd[i], kind, v + total)
                arcs.append((j, state, i, kind, n, total))
    z = float(np.logaddexp.reduce(list(fwd[-1].values())))
    bwd: list[dict] = [{} for _ in nodes[1:]] + [dict.fromkeys(fwd[-1], 0.0)]
    counts = np.zeros(len(w))
    for j, state, i, kind, n, s in sorted(arcs, key=lambda a: -a[2]):
        tail = bwd[i].get(kind, -np.inf)
        add(bwd[j], state, s + tail)
        if n is not None:
            p = math.exp(min(0.0, fwd[j][state] + s + tail - z))
            counts[found[n][3]] += p
            counts[FEATURES[f"after {state}:{kind}"]] += p
    return z, counts


def _gold(lat: Lattice, spans: list[Span]) -> np.ndarray:
    counts, state, last = np.zeros(len(FEATURES)), "other", None
    wanted = {(s, e, k) for k, s, e in spans}
    for s, e, kind, feats in sorted(lat[0]):
        if (s, e, kind) in wanted and (last is None or s >= last):
            state = state if last == s else "other"
            counts[feats] += 1
            counts[FEATURES[f"after {state}:{kind}"]] += 1
            state, last = kind, e
    return counts


def fit(windows: list[tuple[Lattice, np.ndarray]], rounds: int = 40, variance: float = 4.0) -> np.ndarray:
    """Gradient ascent with adaptive steps on the penalised conditional likelihood; equal lattices
    are weighed, not repeated."""
    prior = np.array(list(PRIOR.values()))
    w, seen = prior.copy(), np.zeros(len(prior))
    for _ in range(rounds if windows else 0):
        gradient = (prior - w) / variance
        for lat, gold in windows:
            gradient += gold - _expected(lat, w)[1]
        seen += gradient ** 2
        w = w + 0.5 * gradient / np.sqrt(seen + 1e-8)
    return w


def _windows_of(text: str) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in WINDOW.finditer(text)] if DIGIT.search(text) else []


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for text in batch.column("text").to_pylist():
            base = [s for s in base_spans(text) if s[0] != "email"]
            kept = {(k, s, e) for k, s, e in base}
            dropped = sorted(m.span() for k, p in (("ip", IP), ("card", CARD), ("phone", PHONE))
                             for m in p.finditer(text) if (k, *m.span()) not in kept)
            for a, b in _windows_of(text):
                # A match that failed its check says nothing about the parts it swallowed.
                found = candidates(text, a, b) if b - a < 2000 else []
                if found and not any(_overlaps(dropped, s, e) and (k, s, e) not in kept for s, e, k in found):
                    gold = [f"{k}:{s - a + 2}:{e - a + 2}" for k, s, e in base if a <= s and e <= b]
                    out.append({"w": ("  " + text + "  ")[a:b + 4], "gold": ",".join(gold)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("w", pa.string()), ("gold", pa.string())]))


def train(docs: DataFrame, sample_docs: int = 5_000, sample_windows: int = 2_000) -> np.ndarray:
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    rows = (docs.where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id").select("text")
            .mapInArrow(_examples, "w string, gold string").distinct()
            .orderBy(F.xxhash64("w"), "w", "gold").limit(sample_windows).collect())
    windows = []
    for r in rows:
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.gold.split(",") if x)]
        lat = lattice(r.w, 2, len(r.w) - 2)
        if lat:
            windows.append((lat, _gold(lat, spans)))
    return fit(windows)


def find_spans(text: str, w: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind as listed, then start."""
    base = base_spans(text)
    added: list[Span] = []
    blocked = sorted((s, e) for _, s, e in base)
    for a, b in _windows_of(text):
        lat = lattice(text, a, b)
        if lat is None or all(_overlaps(blocked, s, e) for s, e, _, _ in lat[0]):
            continue  # nothing that the lattice could add
        added += [(k, s, e) for s, e, k in best_spans(lat, w) if not _overlaps(blocked, s, e)]
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda x: (order[x[0]], x[1], x[2]))


def _overlaps(blocked: list[tuple[int, int]], s: int, e: int) -> bool:
    """Whether [s, e) meets one of the spans, sorted; a few of different kinds may overlap."""
    at = bisect.bisect_left(blocked, (e, 0))
    return any(s < b for _, b in blocked[max(0, at - 8):at])


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _find(w: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                        ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                base, spans = find_spans(text or "", w)
                kinds = [k for k, _, _ in base]
                rows.append((doc_id, *(kinds.count(k) for k in KINDS), hashlib.sha256(join_spans(base).encode()).hexdigest(),
                             join_spans(spans), len(spans) - len(base)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def personal_data(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of the base spans by kind, their digest, all spans, and how
    many of those the random field added."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _find(w), f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data(docs, train(docs))
