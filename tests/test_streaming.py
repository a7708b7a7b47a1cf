"""Event windows over arriving files: late rows, repeated rows, restarts, and the query against its SQL."""

import datetime as dt
import time
import uuid

import pytest

from tests.oracle_compare import compare, duck
from tillwise.session import ensure_checkpoint_dir
from tillwise.streaming import windows

START = dt.datetime(2024, 1, 1)


def place(spark):
    return f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def arrive(spark, folder, rows):
    """One more file; rows are (id, minutes after the start, type, value)."""
    full = [(i, None if m is None else START + dt.timedelta(minutes=m), 1, kind, v, None) for i, m, kind, v in rows]
    spark.createDataFrame(full, windows.EVENTS).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


FILES = [[(1, 5, "a", 1.0), (2, 59, "a", 2.0), (3, 10, "b", 4.0)],
         [(4, 61, "a", 8.0), (5, 200, "a", 16.0)],
         [(6, 20, "a", 32.0), (7, 250, "b", 64.0), (8, None, "a", 1.5), (9, 199, None, None)],   # 6 is late
         [(10, 400, "a", 128.0)]]


def total(rows):
    return {((r.window_start - START).total_seconds() / 60, r.event_type): (r.n_events, float(r.total_value or 0), r.late_events, r.is_final)
            for r in rows}


def test_late_rows_amend_their_window_and_a_restart_goes_on(spark):
    root = place(spark)
    for n, rows in enumerate(FILES):
        arrive(spark, f"{root}/arrived", rows)
        if n in (1, 3):   # two runs, two files each
            windows.maintain_windows(windows.arriving(spark, f"{root}/arrived"), f"{root}/store", "1 hour")
    got = total(windows.window_totals(spark, f"{root}/store", "30 minutes").collect())
    assert got == {(0, "a"): (3, 35.0, 1, True), (0, "b"): (1, 4.0, 0, True), (60, "a"): (1, 8.0, 0, True),
                   (180, "a"): (1, 16.0, 0, True), (240, "b"): (1, 64.0, 0, True), (180, None): (1, 0.0, 0, True),
                   (360, "a"): (1, 128.0, 0, False)}
    windows.maintain_windows(windows.arriving(spark, f"{root}/arrived"), f"{root}/store", "1 hour")   # nothing new
    assert total(windows.window_totals(spark, f"{root}/store", "30 minutes").collect()) == got


def test_a_batch_that_is_run_again_replaces_itself(spark):
    root = place(spark)
    arrive(spark, f"{root}/arrived", FILES[0])
    windows.maintain_windows(windows.arriving(spark, f"{root}/arrived"), f"{root}/store", "1 hour")
    first = total(windows.window_totals(spark, f"{root}/store", "30 minutes").collect())
    batch = spark.read.schema(windows.EVENTS).parquet(f"{root}/arrived")
    windows._sums(batch, "1 hour").write.mode("overwrite").parquet(f"{root}/store/partials/batch=0")
    assert total(windows.window_totals(spark, f"{root}/store", "30 minutes").collect()) == first


def test_closed_windows_come_once_without_late_or_repeated_rows(spark):
    root = place(spark)
    for rows in [*FILES, [(10, 400, "a", 128.0), (11, 900, "a", 1.0)]]:
        arrive(spark, f"{root}/arrived", rows)
    query = (windows.closed_windows(windows.arriving(spark, f"{root}/arrived"), "1 hour", "30 minutes").writeStream
             .format("parquet").option("path", f"{root}/closed").option("checkpointLocation", f"{root}/progress")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    rows = {((r.window_start - START).total_seconds() / 60, r.event_type): r.n for r in spark.read.parquet(f"{root}/closed").collect()}
    assert rows == {(0, "a"): 2, (0, "b"): 1, (60, "a"): 1, (180, "a"): 1, (180, None): 1, (240, "b"): 1, (360, "a"): 1}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_event_windows_match_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    res = compare(windows.event_windows(spark, folder), duck(folder), windows.SQL)
    assert res.get("ok"), res
