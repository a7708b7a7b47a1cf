"""Sources and sinks: explicit schemas, schema validation, result writing, row-bound proofs."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tillwise.operators import descriptive
from tillwise.sources import SCHEMAS, load_tables, write_result


def test_tables_read_with_declared_schemas(sf001_tables):
    for name in SCHEMAS:
        df = getattr(sf001_tables, name)
        assert [f.name for f in df.schema.fields] == [c.split()[0] for c in SCHEMAS[name].split(", ")]


def test_validation_rejects_a_wrong_type(spark):
    folder = tempfile.mkdtemp(prefix="tillwise-badschema-")
    for name in SCHEMAS:
        src = spark.read.parquet(f"{SF001}/{name}.parquet")
        if name == "part":
            src = src.withColumn("p_retailprice", F.col("p_retailprice").cast("string"))
        src.write.parquet(os.path.join(folder, f"{name}.parquet"))
    with pytest.raises(ValueError, match="p_retailprice"):
        load_tables(spark, folder, validate=True)


def test_write_result_round_trip(spark, sf001_tables):
    out = os.path.join(tempfile.mkdtemp(prefix="tillwise-out-"), "returns")
    df = descriptive.returns_by_month(sf001_tables)
    write_result(df, out, partition_by=None)
    back = spark.read.parquet(out)
    assert back.count() == 80 and set(back.columns) == set(df.columns)


def test_tables_replace_reruns_on_changed_conditions(sf001_tables):
    """A question re-run on a filtered table (changed conditions) sees only that slice."""
    only_f = sf001_tables.replace(orders=sf001_tables.orders.where(F.col("o_orderstatus") == "F"))
    n = descriptive.filtered_orders(only_f, min_total=0.0, status="F").count()
    assert n == sf001_tables.orders.where(F.col("o_orderstatus") == "F").count()


def test_cluster_conf_sizes_partitions():
    from tillwise.session import cluster_conf
    big = cluster_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(-(-100 * 10**12 // (256 * 1024 * 1024)))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    small = cluster_conf(10**9, 64)
    assert small["spark.sql.shuffle.partitions"] == "128"       # two waves of the cores
    mid = cluster_conf(10 * 10**12, 4000)
    assert mid["spark.sql.shuffle.partitions"] == str(-(-10 * 10**12 // (256 * 1024 * 1024)))


def test_batch_job_writes_each_question(tmp_path):
    """``python -m tillwise`` runs questions in its own session and writes one folder each."""
    import subprocess
    import sys
    out = tmp_path / "answers"
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--conf spark.ui.enabled=false "
               f"--conf spark.checkpoint.dir={tmp_path / 'ckpt'} pyspark-shell")
    subprocess.run([sys.executable, "-m", "tillwise", "--tables", "/root/testdata/sf0.001",
                    "--out", str(out), "revenue_by_period", "kpi_summary"],
                   check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                   env=env, timeout=600, capture_output=True)
    assert sorted(p.name for p in out.iterdir()) == ["kpi_summary", "revenue_by_period"]
    assert any(p.suffix == ".parquet" for p in (out / "kpi_summary").iterdir())
