"""Hand-made star-schema tables for edge cases, written to Parquet so that Spark and DuckDB
read the very same files."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import duckdb

from tillwise.sources.tables import SCHEMAS, load_tables, schema_of

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def d(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


class Builder:
    """Collects rows; nations 0-24 map to region ``n // 5``."""

    def __init__(self):
        self.rows = {name: [] for name in SCHEMAS}
        self.rows["region"] = [(i, r) for i, r in enumerate(REGIONS)]
        self.rows["nation"] = [(n, f"NATION_{n}", n // 5) for n in range(25)]

    def customer(self, key, nation=0, name=None):
        self.rows["customer"].append((key, name or f"Customer#{key}", nation, 0.0, "BUILDING"))
        return self

    def part(self, key, price=100.0, ptype="STANDARD", name=None):
        self.rows["part"].append((key, name or f"part {key}", "Brand#1", ptype, 1, price))
        return self

    def order(self, key, cust, date, total=1000.0, status="F"):
        self.rows["orders"].append((key, cust, status, total, d(date), "1-URGENT"))
        return self

    def line(self, order, part, qty, price, discount=0.0, flag="N", ship=None):
        if ship is None:
            ship = next(o[4] for o in self.rows["orders"] if o[0] == order)
        else:
            ship = d(ship)
        n = sum(1 for r in self.rows["lineitem"] if r[0] == order) + 1
        self.rows["lineitem"].append((order, part, 0, n, float(qty), float(price), discount, 0.0,
                                      flag, "F", ship))
        return self

    def write(self, spark):
        folder = tempfile.mkdtemp(prefix="tillwise-fixture-")
        for name, rows in self.rows.items():
            spark.createDataFrame(rows, schema_of(name)).coalesce(1).write.parquet(
                os.path.join(folder, f"{name}.parquet"))
        return folder, load_tables(spark, folder)


def duck_on(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return con
