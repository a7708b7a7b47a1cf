"""Small dimension lookups.  Nothing here is hinted: size statistics and AQE choose the join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.tables import Tables


def nation_regions(t: Tables) -> DataFrame:
    """``n_nationkey -> region`` (region name)."""
    return (t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey)
            .select("n_nationkey", F.col("r_name").alias("region")))


def customer_regions(t: Tables) -> DataFrame:
    """``c_custkey -> region``; the region is null where the nation is unknown."""
    regions = nation_regions(t)
    customers = t.customer.select("c_custkey", "c_nationkey")
    return (customers.join(regions, customers.c_nationkey == regions.n_nationkey, "left")
            .select("c_custkey", "region"))
