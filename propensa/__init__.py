"""propensa: point-in-time features, labels, scoring and ranking on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins (aggregates, windows, joins, scalar subqueries).  Most are lazy;
those that write a derived table, check a broadcast's size, need quantile
bounds or fit a model (target_mean, clip_and_scale, metrics, auc, leaderboard,
customer_dimension, fit_score, the sinks) run jobs when called.
"""

from propensa.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
