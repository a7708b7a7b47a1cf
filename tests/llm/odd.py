"""Documents with every awkward case, and columns whose names clash with the operators' own."""

from __future__ import annotations

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, k bigint, row string, "
          "words string, score double, id bigint, size string")
PASSAGE = " ".join(f"word{i}" for i in range(40))
LONG = " ".join(f"Long{i % 977} tail{i}" for i in range(30_000))

ROWS = [
    (1, PASSAGE), (2, PASSAGE + " more"), (3, PASSAGE), (3, PASSAGE), (4, None), (5, ""), (6, "   \n\t "),
    (7, LONG), (8, LONG + " end"), (9, "one"), (10, "one"), (11, "two words"), (None, PASSAGE), (None, None),
    (12, "Ünïcode ÉÈ text here 😀 and more of it"), (12, "another text under the same id"), (13, "a\n\nb\nA line that is long enough to be compared\n"),
    (-5, "A line that is long enough to be compared!"), (2 ** 40, "far away id"),
]


def odd(spark, rows=None):
    """``rows`` of (doc_id, text); the other columns hold nulls and values by turns."""
    rows = ROWS if rows is None else rows
    full = [(i, t, "en" if n % 3 else None, f"s{n % 4}" if n % 5 else None, None if t is None else len(t),
             n, None if n % 2 else "r", "w", 0.5, n, "big") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
