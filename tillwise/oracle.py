"""Independent DuckDB SQL for every registered question.

Written directly against the raw tables (joins first, one aggregate), so it shares no plan
shape with the Spark side.  Types are cast to the Spark result types: money DECIMAL(28,4),
units DECIMAL(28,4), counts and ranks BIGINT, ratios DOUBLE computed from exact decimals.
"""

from __future__ import annotations

REV = "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))"
UNIT_COST = "CAST(p_retailprice * CAST(0.6 AS DOUBLE) AS DECIMAL(13,4))"
QTY = "CAST(l_quantity AS DECIMAL(18,4))"
LINE_COST = f"({QTY} * {UNIT_COST})"
ODATE = "CAST(o_orderdate AS DATE)"
OMONTH = f"CAST(date_trunc('month', {ODATE}) AS DATE)"
LATEST = f"(SELECT MAX({ODATE}) FROM orders)"
UNCOSTED = "CAST(SUM(CASE WHEN p_partkey IS NULL THEN 1 ELSE 0 END) AS BIGINT)"


def div(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def spine(col: str, step: str) -> str:
    """Every month or day from the first to the last order date."""
    first = f"date_trunc('{step.lower()}', MIN({ODATE}))"
    last = f"date_trunc('{step.lower()}', MAX({ODATE}))"
    return (f"(SELECT CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), "
            f"CAST({last} AS TIMESTAMP), INTERVAL 1 {step})) AS DATE) AS {col} FROM orders)")


MONTHLY_REV = f"""
  SELECT {OMONTH} AS month, CAST(SUM({REV}) AS DECIMAL(28,4)) AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""

SQL: dict[str, str] = {}

SQL["revenue_by_period"] = f"""
WITH f AS (
  SELECT year({ODATE}) AS year, quarter({ODATE}) AS quarter, month({ODATE}) AS month,
         {REV} AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CASE GROUPING(year, quarter, month) WHEN 3 THEN 'year' WHEN 1 THEN 'quarter'
       ELSE 'month' END AS grain,
       year, quarter, month, CAST(SUM(revenue) AS DECIMAL(28,4)) AS revenue,
       CAST(COUNT(*) AS BIGINT) AS n_lines
FROM f GROUP BY GROUPING SETS ((year), (year, quarter), (year, quarter, month))"""

SQL["revenue_rollup"] = f"""
WITH f AS (SELECT year({ODATE}) AS year, quarter({ODATE}) AS quarter, {REV} AS revenue
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT year, quarter, CAST(SUM(revenue) AS DECIMAL(28,4)) AS revenue,
       CAST(GROUPING(year, quarter) AS BIGINT) AS grouping_id
FROM f GROUP BY ROLLUP (year, quarter)"""

SQL["top_products"] = f"""
SELECT p_partkey, p_name, p_type AS category, revenue, revenue_rank
FROM (SELECT l_partkey, CAST(SUM({REV}) AS DECIMAL(28,4)) AS revenue,
             RANK() OVER (ORDER BY SUM({REV}) DESC) AS revenue_rank
      FROM lineitem GROUP BY l_partkey) r
JOIN part ON p_partkey = l_partkey
WHERE revenue_rank <= 10"""

SQL["quantity_per_product"] = f"""
SELECT p_partkey, p_name, p_type AS category,
       CAST(COALESCE(SUM({QTY}), 0) AS DECIMAL(28,4)) AS total_qty,
       COUNT(l_partkey) AS n_lines
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
GROUP BY p_partkey, p_name, p_type"""

SQL["top_customers_by_orders"] = """
SELECT c_custkey, c_name, n_orders, order_rank
FROM (SELECT o_custkey, COUNT(*) AS n_orders, RANK() OVER (ORDER BY COUNT(*) DESC) AS order_rank
      FROM orders GROUP BY o_custkey) r
JOIN customer ON c_custkey = o_custkey
WHERE order_rank <= 10"""

SQL["stock_movement_monthly"] = f"""
WITH m AS (
  SELECT l_partkey AS p_partkey, CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS month,
         SUM({QTY}) AS qty_out,
         SUM(CASE WHEN l_returnflag = 'R' THEN {QTY} ELSE 0 END) AS qty_returned
  FROM lineitem GROUP BY 1, 2)
SELECT p_partkey, month, CAST(qty_out AS DECIMAL(28,4)) AS qty_out,
       CAST(qty_returned AS DECIMAL(28,4)) AS qty_returned,
       CAST(qty_returned - qty_out AS DECIMAL(28,4)) AS net_qty,
       CAST(SUM(qty_returned - qty_out) OVER (PARTITION BY p_partkey ORDER BY month
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,4)) AS balance
FROM m"""

SQL["returns_by_month"] = f"""
WITH m AS (
  SELECT {OMONTH} AS month, COUNT(*) AS n_lines,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned_lines,
         SUM({REV}) AS revenue,
         COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN {REV} END), 0) AS returned_revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT month, CAST(n_lines AS BIGINT) AS n_lines, CAST(returned_lines AS BIGINT) AS returned_lines,
       CAST(revenue AS DECIMAL(28,4)) AS revenue,
       CAST(returned_revenue AS DECIMAL(28,4)) AS returned_revenue,
       {div('returned_lines', 'n_lines')} AS return_rate,
       {div('CAST(returned_revenue AS DECIMAL(28,4))', 'CAST(revenue AS DECIMAL(28,4))')}
         AS returned_revenue_share
FROM m"""

SQL["filtered_orders"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ODATE} AS order_date, o_orderpriority
FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F'"""

SQL["revenue_cube"] = f"""
WITH f AS (
  SELECT r_name AS region, p_type AS category, {REV} AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey)
SELECT region, category, CAST(SUM(revenue) AS DECIMAL(28,4)) AS revenue,
       CAST(GROUPING(region) AS BIGINT) AS g_region,
       CAST(GROUPING(category) AS BIGINT) AS g_category
FROM f GROUP BY CUBE (region, category)"""

SQL["customer_rank_family"] = """
WITH c AS (SELECT c_custkey, COUNT(o_orderkey) AS n_orders
           FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT c_custkey, n_orders,
       ROW_NUMBER() OVER (ORDER BY n_orders DESC, c_custkey) AS row_num,
       RANK() OVER (ORDER BY n_orders DESC) AS rank_num,
       DENSE_RANK() OVER (ORDER BY n_orders DESC) AS dense_rank_num,
       NTILE(4) OVER (ORDER BY n_orders DESC, c_custkey) AS ntile_num,
       PERCENT_RANK() OVER (ORDER BY n_orders DESC) AS pct_rank,
       CUME_DIST() OVER (ORDER BY n_orders DESC) AS cume_dist
FROM c"""

SQL["revenue_growth"] = f"""
WITH m AS ({MONTHLY_REV}),
x AS (SELECT s.month, CAST(COALESCE(m.revenue, 0) AS DECIMAL(28,4)) AS revenue
      FROM {spine('month', 'MONTH')} s LEFT JOIN m ON m.month = s.month),
y AS (SELECT month, revenue,
             LAG(revenue, 1) OVER (ORDER BY month) AS prev_month_revenue,
             LAG(revenue, 12) OVER (ORDER BY month) AS prev_year_revenue FROM x)
SELECT month, revenue, prev_month_revenue, prev_year_revenue,
       {div('revenue - prev_month_revenue', 'prev_month_revenue')} AS mom_growth,
       {div('revenue - prev_year_revenue', 'prev_year_revenue')} AS yoy_growth,
       last_day(month) <= {LATEST} AS is_complete
FROM y"""


def _growth_sql(dims: list[str], side: str = "customer") -> str:
    cols = {"category": "p_type AS category", "region": "r_name AS region"}
    joins = {"category": "LEFT JOIN part ON p_partkey = l_partkey",
             "region": ("LEFT JOIN customer ON c_custkey = o_custkey "
                        "LEFT JOIN nation ON n_nationkey = c_nationkey "
                        "LEFT JOIN region ON r_regionkey = n_regionkey")}
    if side == "supplier":
        joins["region"] = ("LEFT JOIN supplier ON s_suppkey = l_suppkey "
                           "LEFT JOIN nation ON n_nationkey = s_nationkey "
                           "LEFT JOIN region ON r_regionkey = n_regionkey")
    sel = ", ".join(cols[d] for d in dims)
    names = ", ".join(dims)
    return f"""
WITH ends AS (SELECT year(d) AS y, bool_or(month(d) = 1) AS has_first, bool_or(month(d) = 12) AS has_last
  FROM (SELECT {ODATE} AS d FROM orders) GROUP BY 1),
span AS (SELECT MIN(y) AS y0, MAX(y) AS y1, arg_min(has_first, y) AS first_whole, arg_max(has_last, y) AS last_whole FROM ends),
lim AS (SELECT CAST(CASE WHEN last_whole THEN y1 ELSE y1 - 1 END AS BIGINT) AS cur,
               CASE WHEN first_whole THEN y0 ELSE y0 + 1 END AS low FROM span),
f AS (
  SELECT {sel}, year({ODATE}) AS yr, {REV} AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey {' '.join(joins[d] for d in dims)}),
g AS (
  SELECT {names}, lim.cur - 1 AS prev_year, lim.cur AS cur_year,
         CAST(COALESCE(SUM(CASE WHEN yr = lim.cur - 1 THEN revenue END), 0) AS DECIMAL(28,4)) AS revenue_prev,
         CAST(COALESCE(SUM(CASE WHEN yr = lim.cur THEN revenue END), 0) AS DECIMAL(28,4)) AS revenue_cur
  FROM f, lim WHERE yr BETWEEN lim.cur - 1 AND lim.cur AND lim.cur - 1 >= lim.low
  GROUP BY {names}, lim.cur)
SELECT {names}, prev_year, cur_year, revenue_prev, revenue_cur,
       {div('revenue_cur - revenue_prev', 'revenue_prev')} AS growth,
       RANK() OVER (ORDER BY {div('revenue_cur - revenue_prev', 'revenue_prev')} DESC NULLS LAST)
         AS growth_rank
FROM g"""


SQL["category_growth"] = _growth_sql(["category"])
SQL["region_growth"] = _growth_sql(["region"])
SQL["category_region_growth"] = _growth_sql(["category", "region"])
SQL["supplier_region_growth"] = _growth_sql(["region"], side="supplier")


def _repeat_sql(min_orders: int) -> str:
    return f"""
WITH pc AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey),
r AS (SELECT r_name AS region, COUNT(*) AS buyers,
             SUM(CASE WHEN n >= {min_orders} THEN 1 ELSE 0 END) AS repeat_buyers
      FROM pc LEFT JOIN customer ON c_custkey = o_custkey
      LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
      GROUP BY r_name)
SELECT region, CAST({min_orders} AS BIGINT) AS min_orders, CAST(buyers AS BIGINT) AS buyers,
       CAST(repeat_buyers AS BIGINT) AS repeat_buyers,
       {div('repeat_buyers', 'buyers')} AS repeat_rate
FROM r"""


SQL["repeat_rate_by_region"] = _repeat_sql(2)
SQL["repeat_rate_by_region_11"] = _repeat_sql(11)

SQL["slow_movers"] = f"""
WITH q AS (
  SELECT l_partkey, SUM({QTY}) AS qty FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {ODATE} > {LATEST} - 90)
  GROUP BY l_partkey),
x AS (SELECT p_partkey, p_name, p_type AS category,
             CAST(COALESCE(qty, 0) AS DECIMAL(28,4)) AS recent_qty
      FROM part LEFT JOIN q ON l_partkey = p_partkey),
y AS (SELECT *, NTILE(4) OVER (ORDER BY recent_qty, p_partkey) AS quartile FROM x)
SELECT p_partkey, p_name, category, recent_qty, quartile, quartile = 1 AS is_slow FROM y"""

SQL["underperformers"] = f"""
WITH pr AS (
  SELECT p_partkey, p_name, p_type AS category,
         CAST(COALESCE(SUM({REV}), 0) AS DECIMAL(28,4)) AS revenue
  FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_name, p_type),
x AS (
  SELECT p.*,
         (SELECT SUM(q.revenue) FROM pr q WHERE q.category = p.category) AS cat_revenue,
         (SELECT COUNT(*) FROM pr q WHERE q.category = p.category) AS cat_products
  FROM pr p)
SELECT p_partkey, p_name, category, revenue,
       CAST(cat_revenue AS DOUBLE) / CAST(cat_products AS DOUBLE) AS category_avg_revenue,
       {div('revenue', 'CAST(cat_revenue AS DOUBLE) / CAST(cat_products AS DOUBLE)')}
         AS revenue_to_avg
FROM x
WHERE revenue * cat_products < cat_revenue * 0.5"""

SQL["unsold_products"] = f"""
SELECT p_partkey, p_name, p_type AS category FROM part p
WHERE NOT EXISTS (
  SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_partkey = p.p_partkey AND {ODATE} > {LATEST} - 90)"""

SQL["avg_purchase_gap"] = f"""
WITH g AS (
  SELECT o_custkey, {ODATE} AS d,
         date_diff('day', LAG({ODATE}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                   {ODATE}) AS gap
  FROM orders)
SELECT o_custkey, COUNT(*) AS n_orders, MIN(d) AS first_order_date, MAX(d) AS last_order_date,
       CAST(SUM(gap) AS DOUBLE) / NULLIF(CAST(COUNT(gap) AS DOUBLE), 0) AS avg_gap_days
FROM g GROUP BY o_custkey"""

SQL["purchase_gaps"] = f"""
SELECT o_orderkey, o_custkey, {ODATE} AS order_date,
       LAG({ODATE}) OVER w AS prev_order_date,
       date_diff('day', LAG({ODATE}) OVER w, {ODATE}) AS gap_days
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""

SQL["purchase_gap_summary"] = f"""
WITH g AS (SELECT o_custkey, date_diff('day', LAG({ODATE}) OVER w, {ODATE}) AS gap
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
r AS (SELECT r_name AS region, gap FROM g LEFT JOIN customer ON c_custkey = o_custkey
      LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
      WHERE gap IS NOT NULL AND o_custkey IS NOT NULL),
a AS (SELECT 'all' AS scope, NULL AS region, gap FROM r UNION ALL SELECT 'region', region, gap FROM r)
SELECT scope, region, COUNT(*) AS n_gaps, CAST(SUM(gap) AS BIGINT) AS total_gap_days,
       {div('SUM(gap)', 'COUNT(*)')} AS avg_gap_days, CAST(MEDIAN(gap) AS DOUBLE) AS median_gap_days
FROM a GROUP BY scope, region"""

CUSTOMER_MONEY = f"""
  SELECT o_custkey, COUNT(*) AS n_orders,
         CAST(COALESCE(SUM(revenue), 0) AS DECIMAL(28,4)) AS revenue,
         CAST(COALESCE(SUM(cost), 0) AS DECIMAL(28,4)) AS cost,
         CAST(COALESCE(SUM(uncosted), 0) AS BIGINT) AS uncosted_lines,
         MIN({ODATE}) AS first_order_date
  FROM orders LEFT JOIN (
    SELECT l_orderkey, SUM({REV}) AS revenue, SUM({LINE_COST}) AS cost, {UNCOSTED} AS uncosted
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) po
  ON l_orderkey = o_orderkey
  GROUP BY o_custkey"""

SQL["customer_ltv"] = f"""
WITH cu AS ({CUSTOMER_MONEY}),
x AS (SELECT *, CAST(revenue - cost AS DECIMAL(28,4)) AS profit,
             date_diff('day', first_order_date, {LATEST}) AS tenure_days FROM cu)
SELECT o_custkey, n_orders, revenue, cost, uncosted_lines, profit,
       {div('revenue', 'n_orders')} AS aov, {div('profit', 'revenue')} AS margin,
       first_order_date, tenure_days,
       CASE WHEN tenure_days >= 365 THEN {div('profit', 'tenure_days')}
            * CAST(365.25 AS DOUBLE) * CAST(3 AS DOUBLE) END AS projected_ltv
FROM x"""


def _pareto_sql(source: str, key: str) -> str:
    return f"""
WITH x AS ({source})
SELECT {key}, profit, ROW_NUMBER() OVER w AS profit_rank,
       CAST(SUM(profit) OVER w AS DECIMAL(28,4)) AS cum_profit,
       {div('SUM(profit) OVER w', 'SUM(profit) OVER ()')} AS cum_share,
       ROW_NUMBER() OVER w <= CEIL(COUNT(*) OVER () * 0.2) AS is_top
FROM x
WINDOW w AS (ORDER BY profit DESC, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


SQL["pareto_products"] = _pareto_sql(f"""
  SELECT p_partkey, CAST(COALESCE(SUM({REV}), 0) - COALESCE(SUM({LINE_COST}), 0) AS DECIMAL(28,4))
           AS profit
  FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""", "p_partkey")

SQL["pareto_customers"] = _pareto_sql(f"""
  SELECT c_custkey, CAST(COALESCE(cp.profit, 0) AS DECIMAL(28,4)) AS profit
  FROM customer LEFT JOIN (
    SELECT o_custkey, SUM({REV}) - COALESCE(SUM({LINE_COST}), 0) AS profit
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
    GROUP BY o_custkey) cp ON cp.o_custkey = c_custkey""", "c_custkey")

SQL["moving_avg_month"] = f"""
WITH m AS ({MONTHLY_REV}),
x AS (SELECT s.month, CAST(COALESCE(m.revenue, 0) AS DECIMAL(28,4)) AS revenue
      FROM {spine('month', 'MONTH')} s LEFT JOIN m ON m.month = s.month)
SELECT month, revenue, {div('SUM(revenue) OVER f', 'COUNT(*) OVER f')} AS moving_avg,
       COUNT(*) OVER f AS frame_rows, last_day(month) <= {LATEST} AS is_complete
FROM x WINDOW f AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

SQL["moving_avg_day"] = f"""
WITH d AS (SELECT {ODATE} AS order_date, CAST(SUM({REV}) AS DECIMAL(28,4)) AS revenue
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
x AS (SELECT s.order_date, CAST(COALESCE(d.revenue, 0) AS DECIMAL(28,4)) AS revenue
      FROM {spine('order_date', 'DAY')} s LEFT JOIN d ON d.order_date = s.order_date)
SELECT order_date, revenue, {div('SUM(revenue) OVER f', 'COUNT(*) OVER f')} AS moving_avg,
       COUNT(*) OVER f AS frame_rows
FROM x WINDOW f AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

COSTED = f"""
  SELECT {OMONTH} AS month, p_type AS category, {QTY} AS qty, {REV} AS revenue,
         {LINE_COST} AS cost, p_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey"""

SQL["margin_trend"] = f"""
WITH m AS (SELECT month, SUM(qty) AS qty, SUM(revenue) AS revenue, SUM(cost) AS cost, {UNCOSTED} AS uncosted
           FROM ({COSTED}) c GROUP BY month),
z AS (SELECT s.month, CAST(COALESCE(qty, 0) AS DECIMAL(28,4)) AS qty,
             CAST(COALESCE(revenue, 0) AS DECIMAL(28,4)) AS revenue,
             CAST(COALESCE(cost, 0) AS DECIMAL(28,4)) AS cost,
             CAST(COALESCE(uncosted, 0) AS BIGINT) AS uncosted_lines
      FROM {spine('month', 'MONTH')} s LEFT JOIN m ON m.month = s.month),
x AS (SELECT *, CAST(revenue - cost AS DECIMAL(28,4)) AS profit,
             {div('CAST(revenue - cost AS DECIMAL(28,4))', 'revenue')} AS margin FROM z)
SELECT month, qty, revenue, cost, uncosted_lines, profit, margin,
       margin - LAG(margin) OVER (ORDER BY month) AS margin_change,
       last_day(month) <= {LATEST} AS is_complete
FROM x"""

SQL["margin_volume_corr"] = f"""
WITH m AS (SELECT category, month, SUM(qty) AS qty, SUM(revenue) AS revenue, SUM(cost) AS cost
           FROM ({COSTED}) c GROUP BY category, month)
SELECT category, COUNT(*) AS n_months,
       ROUND(NULLIF(CORR(CAST(qty AS DOUBLE), {div('revenue - cost', 'revenue')}),
             CAST('nan' AS DOUBLE)), 6) AS corr_qty_margin
FROM m WHERE category IS NOT NULL GROUP BY category"""

SQL["contribution_margin"] = f"""
WITH pt AS (
  SELECT p_partkey, p_name, p_type AS category,
         CAST(COALESCE(SUM({QTY}), 0) AS DECIMAL(28,4)) AS qty,
         CAST(COALESCE(SUM({REV}), 0) AS DECIMAL(28,4)) AS revenue,
         CAST(COALESCE(SUM({LINE_COST}), 0) AS DECIMAL(28,4)) AS variable_cost
  FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_name, p_type)
SELECT p_partkey, p_name, category, qty, revenue, variable_cost,
       CAST(revenue - variable_cost AS DECIMAL(28,4)) AS contribution_margin,
       {div('CAST(revenue - variable_cost AS DECIMAL(28,4))', 'qty')} AS cm_per_unit,
       {div('CAST(revenue - variable_cost AS DECIMAL(28,4))', 'revenue')} AS cm_ratio
FROM pt"""

SQL["kpi_summary"] = f"""
WITH lc AS (
  SELECT CAST(SUM({REV}) AS DECIMAL(28,4)) AS revenue,
         CAST(COALESCE(SUM({LINE_COST}), 0) AS DECIMAL(28,4)) AS cost, COUNT(*) AS n_lines,
         {UNCOSTED} AS uncosted_lines,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned_lines
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey),
oc AS (SELECT COUNT(*) AS n_orders, COUNT(DISTINCT o_custkey) AS n_buyers FROM orders)
SELECT revenue, cost, CAST(revenue - cost AS DECIMAL(28,4)) AS profit,
       {div('CAST(revenue - cost AS DECIMAL(28,4))', 'revenue')} AS margin,
       n_orders, n_buyers, {div('revenue', 'n_orders')} AS aov, n_lines, uncosted_lines,
       {div('returned_lines', 'n_lines')} AS return_rate
FROM lc, oc"""

CENTS = f"CAST({REV} * 10000 AS BIGINT)"
CUSTOMER_REGION = """
  SELECT c_custkey, r_name AS region FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""
GRAINS = f"""
WITH cr AS ({CUSTOMER_REGION}),
o AS (SELECT o_orderkey, o_custkey, {OMONTH} AS month, region FROM orders LEFT JOIN cr ON c_custkey = o_custkey),
l AS (SELECT {CENTS} AS v, month, region FROM lineitem JOIN o ON l_orderkey = o_orderkey),
grained AS (
  SELECT 'month_region' AS grain, month, region, v FROM l
  UNION ALL SELECT 'month', month, NULL, v FROM l
  UNION ALL SELECT 'region', NULL, region, v FROM l
  UNION ALL SELECT 'all', NULL, NULL, v FROM l),
gbuyers AS (
  SELECT 'month_region' AS grain, month, region, COUNT(DISTINCT o_custkey) AS buyers FROM o GROUP BY month, region
  UNION ALL SELECT 'month', month, NULL, COUNT(DISTINCT o_custkey) FROM o GROUP BY month
  UNION ALL SELECT 'region', NULL, region, COUNT(DISTINCT o_custkey) FROM o GROUP BY region
  UNION ALL SELECT 'all', NULL, NULL, COUNT(DISTINCT o_custkey) FROM o HAVING COUNT(*) > 0)"""


def amount(whole: str) -> str:
    return f"CAST(CAST({whole} AS DECIMAL(22,0)) / 10000 AS DECIMAL(18,4))"


def placed(p: int) -> str:
    """The value at the place of a percentile, from rows numbered ``i`` of ``n`` in order of ``v``."""
    return f"MAX(CASE WHEN i = GREATEST((n * {p} + 99) // 100, 1) THEN v END)"


# The middle of the bucket that keeps an amount's eight leading bits, computed from its power of two.
MIDDLE = """CASE WHEN abs(v) < 256 THEN v ELSE sign(v) * ((abs(v) // w) * w + w // 2) END"""

SQL["value_sketch_rollup"] = f"""{GRAINS},
sized AS (SELECT *, CAST(pow(2, greatest(length(bin(abs(v))) - 8, 0)) AS BIGINT) AS w FROM grained),
numbered AS (
  SELECT grain, month, region, {MIDDLE} AS v,
         row_number() OVER (PARTITION BY grain, month, region ORDER BY v) AS i,
         COUNT(*) OVER (PARTITION BY grain, month, region) AS n
  FROM sized),
q AS (SELECT grain, month, region, MAX(n) AS n_lines, {placed(50)} AS p50, {placed(95)} AS p95
      FROM numbered GROUP BY grain, month, region)
SELECT b.grain, b.month, b.region, COALESCE(q.n_lines, 0) AS n_lines,
       {amount("p50")} AS p50_estimate, {amount("p95")} AS p95_estimate
FROM gbuyers b LEFT JOIN q ON q.grain = b.grain AND q.month IS NOT DISTINCT FROM b.month
 AND q.region IS NOT DISTINCT FROM b.region"""

SQL["sketch_accuracy"] = f"""{GRAINS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grain, month, region ORDER BY v) AS i,
         COUNT(*) OVER (PARTITION BY grain, month, region) AS n
  FROM grained),
q AS (SELECT grain, month, region, MAX(n) AS n_lines, {placed(50)} AS p50, {placed(95)} AS p95
      FROM numbered GROUP BY grain, month, region)
SELECT b.grain, b.month, b.region, b.buyers, COALESCE(q.n_lines, 0) AS n_lines,
       {amount("p50")} AS p50, {amount("p95")} AS p95, TRUE AS buyers_within,
       CASE WHEN p50 IS NOT NULL THEN TRUE END AS p50_within, CASE WHEN p95 IS NOT NULL THEN TRUE END AS p95_within
FROM gbuyers b LEFT JOIN q ON q.grain = b.grain AND q.month IS NOT DISTINCT FROM b.month
 AND q.region IS NOT DISTINCT FROM b.region"""

SQL["line_value_percentiles"] = f"""
WITH cr AS ({CUSTOMER_REGION}),
l AS (SELECT p_type AS category, region, {CENTS} AS v
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      LEFT JOIN cr ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = l_partkey),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY category, region ORDER BY v) AS i,
         COUNT(*) OVER (PARTITION BY category, region) AS n
  FROM l)
SELECT category, region, MAX(n) AS n_lines, {amount(placed(50))} AS p50, {amount(placed(95))} AS p95
FROM numbered GROUP BY category, region"""

SQL["rolling_region_sales"] = f"""
WITH cr AS ({CUSTOMER_REGION}),
o AS (SELECT o_orderkey, o_custkey, {ODATE} AS d, region FROM orders LEFT JOIN cr ON c_custkey = o_custkey),
days AS (SELECT region, unnest(generate_series(CAST((SELECT MIN(d) FROM o) AS TIMESTAMP),
                CAST((SELECT MAX(d) FROM o) AS TIMESTAMP), INTERVAL 1 DAY))::DATE AS order_date
         FROM (SELECT DISTINCT region FROM o WHERE d IS NOT NULL)),
money AS (SELECT region, d, SUM({REV}) AS revenue FROM lineitem JOIN o ON o_orderkey = l_orderkey GROUP BY region, d),
people AS (SELECT DISTINCT region, d, o_custkey FROM o)
SELECT region, order_date,
  CAST(COALESCE((SELECT SUM(revenue) FROM money m WHERE m.region IS NOT DISTINCT FROM days.region
        AND m.d > order_date - 90 AND m.d <= order_date), 0) AS DECIMAL(28,4)) AS rolling_revenue,
  (SELECT COUNT(DISTINCT o_custkey) FROM people p WHERE p.region IS NOT DISTINCT FROM days.region
        AND p.d > order_date - 90 AND p.d <= order_date) AS active_customers
FROM days"""

SQL["last_shipment_price"] = f"""
WITH s AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS last_ship_date, l_extendedprice / NULLIF(l_quantity, 0) AS last_unit_price
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
          ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1),
l AS (SELECT l_orderkey, l_linenumber, l_partkey, {ODATE} AS order_date FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_orderkey, l_linenumber, l.l_partkey, order_date, last_ship_date, last_unit_price,
       CAST(order_date - last_ship_date AS BIGINT) AS days_since_shipment
FROM l ASOF LEFT JOIN s ON s.l_partkey = l.l_partkey AND order_date > last_ship_date"""

TRANSIT = f"""
  SELECT l_orderkey, l_partkey, {QTY} AS qty, {ODATE} AS order_date, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE {ODATE} < CAST(l_shipdate AS DATE)"""

SQL["units_in_transit"] = f"""
WITH tl AS ({TRANSIT}),
m AS (SELECT l_partkey, order_date AS from_date FROM tl UNION SELECT l_partkey, ship_date FROM tl),
steps AS (SELECT l_partkey, from_date, lead(from_date) OVER (PARTITION BY l_partkey ORDER BY from_date) AS to_date FROM m)
SELECT s.l_partkey, s.from_date, s.to_date,
       CAST(COALESCE(SUM(qty), 0) AS DECIMAL(28,4)) AS units
FROM steps s LEFT JOIN tl ON tl.l_partkey IS NOT DISTINCT FROM s.l_partkey
 AND tl.order_date <= s.from_date AND s.from_date < tl.ship_date
WHERE s.to_date IS NOT NULL
GROUP BY s.l_partkey, s.from_date, s.to_date"""

SQL["transit_peaks"] = f"""
WITH steps AS ({SQL["units_in_transit"]}),
tl AS ({TRANSIT}),
peaks AS (SELECT * FROM steps WHERE l_partkey IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY units DESC, from_date) = 1)
SELECT p.l_partkey, p.units AS peak_units, p.from_date, p.to_date, COUNT(*) AS n_lines,
       COUNT(DISTINCT l_orderkey) AS n_orders, CAST(SUM(qty) AS DECIMAL(28,4)) AS line_units
FROM peaks p JOIN tl ON tl.l_partkey = p.l_partkey AND tl.order_date < p.to_date AND tl.ship_date > p.from_date
GROUP BY p.l_partkey, p.units, p.from_date, p.to_date"""

SQL["cohort_retention"] = f"""
WITH m AS (SELECT DISTINCT o_custkey, {OMONTH} AS month FROM orders WHERE o_custkey IS NOT NULL),
c AS (SELECT o_custkey, MIN(month) AS cohort_month FROM m GROUP BY o_custkey),
n AS (SELECT cohort_month, COUNT(*) AS cohort_size FROM c GROUP BY cohort_month)
SELECT cohort_month, date_diff('month', cohort_month, month) AS months_since, cohort_size, COUNT(*) AS active,
       {div("COUNT(*)", "cohort_size")} AS retention
FROM m JOIN c USING (o_custkey) JOIN n USING (cohort_month)
GROUP BY cohort_month, month, cohort_size"""

SQL["period_changes"] = f"""
WITH b AS (SELECT year(MAX({ODATE})) - CASE WHEN month(MAX({ODATE})) = 12 THEN 0 ELSE 1 END AS cur,
                  year(MIN({ODATE})) + CASE WHEN month(MIN({ODATE})) = 1 THEN 0 ELSE 1 END AS lo FROM orders),
y AS (SELECT o_custkey, year({ODATE}) AS year, cur FROM orders, b WHERE o_custkey IS NOT NULL AND cur - 1 >= lo),
s AS (SELECT o_custkey, BOOL_OR(year = cur - 1) AS was, BOOL_OR(year = cur) AS is_now, BOOL_OR(year < cur) AS earlier
      FROM y GROUP BY o_custkey),
cr AS ({CUSTOMER_REGION})
SELECT region, COUNT(*) FILTER (was AND is_now) AS kept, COUNT(*) FILTER (was AND NOT is_now) AS lost,
       COUNT(*) FILTER (is_now AND NOT earlier) AS new, COUNT(*) FILTER (is_now AND earlier AND NOT was) AS returned,
       {div("COUNT(*) FILTER (was AND is_now)", "COUNT(*) FILTER (was)")} AS kept_share
FROM s LEFT JOIN cr ON c_custkey = o_custkey
WHERE was OR is_now
GROUP BY region"""

SQL["slow_movers_by_month"] = SQL["slow_movers"]
SQL["unsold_products_by_month"] = SQL["unsold_products"]

SQL["maintained_totals"] = f"""
WITH cr AS ({CUSTOMER_REGION}),
f AS (SELECT year({ODATE}) AS year, {OMONTH} AS month, region, p_type AS category, {REV} AS revenue, {QTY} AS qty
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      LEFT JOIN cr ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = l_partkey)
SELECT CASE GROUPING(year, month, region, category) WHEN 3 THEN 'month' WHEN 7 THEN 'year' WHEN 12 THEN 'region_category'
       ELSE 'all' END AS grain, year, month, region, category, CAST(SUM(revenue) AS DECIMAL(28,4)) AS revenue,
       CAST(SUM(qty) AS DECIMAL(28,4)) AS qty, COUNT(*) AS n_lines
FROM f GROUP BY GROUPING SETS ((year, month), (year), (region, category), ()) HAVING COUNT(*) > 0"""

# Normal equations in another form: the slope from deviations, row by row, of each month of the year.
SQL["category_forecast"] = f"""
WITH b AS (SELECT MIN({OMONTH}) AS first, CASE WHEN MAX({ODATE}) = last_day(MAX({ODATE})) THEN MAX({OMONTH})
                  ELSE CAST(MAX({OMONTH}) - INTERVAL 1 MONTH AS DATE) END AS last FROM orders),
r AS (SELECT p_type AS category, {OMONTH} AS month, SUM({REV}) AS revenue
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
m AS (SELECT CAST(unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month, first FROM b),
s AS (SELECT c.category, m.month, CAST(date_diff('month', m.first, m.month) AS DOUBLE) AS t, month(m.month) AS season,
             CAST(COALESCE(r.revenue, 0) AS DOUBLE) AS y
      FROM (SELECT DISTINCT category FROM r) c CROSS JOIN m
      LEFT JOIN r ON r.category IS NOT DISTINCT FROM c.category AND r.month = m.month),
d AS (SELECT *, t - AVG(t) OVER w AS dt, y - AVG(y) OVER w AS dy, AVG(t) OVER w AS mt, AVG(y) OVER w AS my
      FROM s WINDOW w AS (PARTITION BY category, season)),
g AS (SELECT category, COALESCE(SUM(dt * dy) / NULLIF(SUM(dt * dt), 0), 0) AS slope, COUNT(*) AS n_months, MAX(t) AS last_t,
             MAX(month) AS last FROM d GROUP BY category),
l AS (SELECT d.category, season, ANY_VALUE(my - slope * mt) AS level FROM d JOIN g ON g.category IS NOT DISTINCT FROM d.category
      GROUP BY d.category, season),
e AS (SELECT d.category, sqrt(AVG((d.dy - slope * d.dt) ** 2)) AS rmse FROM d JOIN g ON g.category IS NOT DISTINCT FROM d.category
      GROUP BY d.category),
k AS (SELECT *, unnest([1, 2, 3]) AS ahead FROM g)
SELECT k.category, CAST(k.last + to_months(CAST(ahead AS INTEGER)) AS DATE) AS month,
       round(COALESCE((SELECT level FROM l WHERE l.category IS NOT DISTINCT FROM k.category
                        AND l.season = month(k.last + to_months(CAST(k.ahead AS INTEGER)))),
                      (SELECT AVG(level) FROM l WHERE l.category IS NOT DISTINCT FROM k.category)) + slope * (last_t + ahead), 2) AS forecast,
       round(slope, 2) AS monthly_slope, round(rmse, 2) AS rmse, n_months
FROM k JOIN e ON e.category IS NOT DISTINCT FROM k.category"""
