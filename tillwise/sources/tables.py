"""Table loading.

Tables are read with an explicit schema, so no job is spent inferring it from file footers, and
every reader stays lazy: Catalyst prunes the columns each question uses and pushes its filters
into the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType, _parse_datatype_string

# Column names and types of the star schema the questions run on.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def schema_of(name: str) -> StructType:
    return _parse_datatype_string(SCHEMAS[name])


@dataclass(frozen=True)
class Tables:
    """The seven star-schema tables as DataFrames.

    Any DataFrame with the named columns can stand in for a table (a filtered slice, a catalog
    table bucketed on its join key, a JDBC read), so questions can be re-run on changed
    conditions or joined with further tables.
    """

    region: DataFrame
    nation: DataFrame
    customer: DataFrame
    supplier: DataFrame
    part: DataFrame
    orders: DataFrame
    lineitem: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.lineitem.sparkSession

    def replace(self, **tables: DataFrame) -> "Tables":
        current = {f.name: getattr(self, f.name) for f in fields(self)}
        current.update(tables)
        return Tables(**current)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "Tables":
        """Catalog tables, e.g. lineitem and orders bucketed by order key so their join needs no
        shuffle."""
        return cls(**{name: spark.table(f"{database}.{name}") for name in SCHEMAS})


def load_tables(spark: SparkSession, directory: str, fmt: str = "parquet",
                validate: bool = False) -> Tables:
    """Lazy readers for ``<directory>/<table>.<fmt>``.

    With ``validate`` the stored schema of each table (one footer) is checked against
    :data:`SCHEMAS` by column name and type; a mismatch raises before any query runs.
    """
    frames = {}
    for name in SCHEMAS:
        path = f"{directory.rstrip('/')}/{name}.{fmt}"
        expected = schema_of(name)
        if validate:
            stored = spark.read.format(fmt).load(path).schema
            have = {f.name: f.dataType for f in stored.fields}
            for field in expected.fields:
                if field.name not in have:
                    raise ValueError(f"{name}: column {field.name} missing in {path}")
                if have[field.name] != field.dataType:
                    raise ValueError(f"{name}.{field.name}: stored {have[field.name].simpleString()}"
                                     f", expected {field.dataType.simpleString()}")
        frames[name] = spark.read.schema(expected).format(fmt).load(path)
    return Tables(**frames)


def read_jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str,
                    lower_bound: int, upper_bound: int, num_partitions: int,
                    properties: dict[str, str] | None = None) -> DataFrame:
    """Read a database table as ``num_partitions`` parallel range scans on a numeric key.

    Sales data often live in a relational database; a partitioned JDBC read is how such a table
    enters Spark without funnelling it through one connection.  Needs the database's JDBC
    driver on the classpath.
    """
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=properties or {})
