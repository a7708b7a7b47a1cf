"""tillwise: retail business analytics as Spark DataFrame plans.

Every question (revenue by period, top products, growth, repeat rate, LTV, Pareto, ...) is a
function from DataFrames plus explicit business parameters to a DataFrame.  Nothing is computed
until an action runs; Catalyst plans the joins and AQE re-plans them at runtime.
"""

from tillwise.sources.tables import Tables, load_tables
from tillwise.session import build_session, cluster_conf, ensure_checkpoint_dir

__all__ = ["Tables", "load_tables", "build_session", "cluster_conf", "ensure_checkpoint_dir"]
