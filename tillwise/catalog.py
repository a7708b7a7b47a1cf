"""Registry of the questions under their result keys, with default parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from tillwise.operators import descriptive as d
from tillwise.operators import diagnostic as g
from tillwise.operators import distribution as v
from tillwise.operators import forecast as f
from tillwise.operators import maintained as m
from tillwise.operators import retention as r
from tillwise.operators import strategic as s
from tillwise.operators import timeline as w
from tillwise.sources.partitioned import by_month
from tillwise.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # beginner: descriptive
    "revenue_by_period": d.revenue_by_period,
    "top_products": d.top_products,
    "quantity_per_product": d.quantity_per_product,
    "top_customers_by_orders": d.top_customers_by_orders,
    "stock_movement_monthly": d.stock_movement_monthly,
    "returns_by_month": d.returns_by_month,
    "filtered_orders": d.filtered_orders,
    "revenue_cube": d.revenue_cube,
    "revenue_rollup": d.revenue_rollup,
    "customer_rank_family": d.customer_rank_family,
    # intermediate: diagnostic
    "revenue_growth": g.revenue_growth,
    "category_growth": partial(g.growth_ranking, dims=("category",)),
    "region_growth": partial(g.growth_ranking, dims=("region",)),
    "category_region_growth": partial(g.growth_ranking, dims=("category", "region")),
    "supplier_region_growth": partial(g.growth_ranking, dims=("region",), side="supplier"),
    "repeat_rate_by_region": g.repeat_rate_by_region,
    "repeat_rate_by_region_11": partial(g.repeat_rate_by_region, min_orders=11),
    "slow_movers": g.slow_movers,
    "underperformers": g.underperformers,
    "unsold_products": g.unsold_products,
    "avg_purchase_gap": g.avg_purchase_gap,
    "purchase_gaps": g.purchase_gaps,
    "purchase_gap_summary": g.purchase_gap_summary,
    # advanced: strategic
    "customer_ltv": s.customer_ltv,
    "pareto_products": s.pareto_products,
    "pareto_customers": s.pareto_customers,
    "moving_avg_month": s.moving_avg_month,
    "moving_avg_day": s.moving_avg_day,
    "margin_trend": s.margin_trend,
    "margin_volume_corr": s.margin_volume_corr,
    "contribution_margin": s.contribution_margin,
    "kpi_summary": s.kpi_summary,
    # distributions, spans of days, retention
    "value_sketch_rollup": v.value_sketch_rollup,
    "sketch_accuracy": v.sketch_accuracy,
    "line_value_percentiles": v.line_value_percentiles,
    "rolling_region_sales": w.rolling_region_sales,
    "last_shipment_price": w.last_shipment_price,
    "units_in_transit": w.units_in_transit,
    "transit_peaks": w.transit_peaks,
    "cohort_retention": r.cohort_retention,
    "period_changes": r.period_changes,
    # stored layouts and results, forecasts
    "slow_movers_by_month": lambda t: g.slow_movers(by_month(t)),
    "unsold_products_by_month": lambda t: g.unsold_products(by_month(t)),
    "maintained_totals": m.maintained_totals,
    "category_forecast": f.category_forecast,
}
