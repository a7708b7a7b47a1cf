"""Summarise each question's physical plan in two regimes and print a Markdown table.

    python -m tests.plan_report /root/testdata/sf0.01 > PLANS.md

"small": Spark's default broadcast thresholds.  "large": static and adaptive thresholds off, so every
join of tables is a sort-merge join, as on full-size cluster data.  Counts are of the initial adaptive
plan (AQE may still re-plan at runtime); a plan that continues from a checkpoint is counted together
with the plan that was checkpointed.  A subquery is counted once, however often it is printed.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from pyspark.sql.classic.dataframe import DataFrame


def explained(df) -> str:
    """The printed plan, each scalar subquery once."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    tree, seen = buf.getvalue(), set()
    parts = re.split(r"(?=Subquery:\d+ Hosting operator)", tree)
    kept = [parts[0]]
    for part in parts[1:]:
        body = re.sub(r"#\d+L?|\(\d+\)|\[id=#\d+\]|\d+", "", part.split("\n", 1)[-1])
        if body not in seen:
            seen.add(body)
            kept.append(part)
    return "".join(kept)


def summary(question, tables) -> str:
    """Of the question's plan and of the plans it checkpoints while being built."""
    before, texts = DataFrame.checkpoint, []

    def checkpoint(self, eager: bool = True):
        texts.append(explained(self))
        return before(self, eager)

    DataFrame.checkpoint = checkpoint
    try:
        texts.append(explained(question(tables)))
    finally:
        DataFrame.checkpoint = before
    text = "\n".join(texts)
    # One line per node stands in the details as "(n) Name"; exchanges name their partitioning below.
    exchanges = re.findall(r"\(\d+\) Exchange\n(?:.*\n)*?Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text)
    joins = re.findall(r"\(\d+\) (SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", text)
    parts = [f"{exchanges.count('hashpartitioning')} hash"]
    if exchanges.count("rangepartitioning"):
        parts.append(f"{exchanges.count('rangepartitioning')} range")
    if exchanges.count("SinglePartition"):
        parts.append(f"{exchanges.count('SinglePartition')} single")
    join_txt = ", ".join(f"{joins.count(j)} {j.replace('Join', '')}" for j in dict.fromkeys(joins)) or "-"
    extra = []
    if "Expand" in text:
        extra.append("expand")
    if len(texts) > 1:
        extra.append("checkpoint")
    windows = len(re.findall(r"\(\d+\) Window\n", text))
    return f"{' + '.join(parts)} | {join_txt} | {windows} | {', '.join(extra) or '-'}"


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    from tillwise.catalog import QUERIES
    from tillwise.session import build_session
    from tillwise.sources.tables import load_tables
    spark = build_session()
    t = load_tables(spark, sf_dir)
    rows = {}
    for name, q in QUERIES.items():
        rows[name] = [summary(q, t)]
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"),
                       ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    for name, q in QUERIES.items():
        rows[name].append(summary(q, t))
    print("| question | regime | exchanges | joins | windows | notes |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, (small, large) in rows.items():
        print(f"| `{name}` | small | {small} |")
        print(f"| | large | {large} |")


if __name__ == "__main__":
    main(sys.argv[1:])
