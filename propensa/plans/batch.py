"""Batch queries over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa import defaults
from propensa.functions import parse_prop, parse_props
from propensa.operators import clean, encode, evaluate, joins, rank, report
from propensa.operators import features as feat
from propensa.operators import sequence as seq
from propensa.operators.model import fit_score
from propensa.plans.registry import register
from propensa.functions import ts_lit
from propensa.sources import events, load
from propensa.session import written


@register("p01_load")
def q_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir)


@register("p02_parse_props")
def q_parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", parse_prop("props", "k", "int").alias("k"))


@register("p02_parse_props_struct")
def q_parse_props_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", parse_props("props", "k int").alias("p")).select("event_id", "p.k")


@register("p03_observe")
def q_observe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.observe(events(spark, sf_dir))


@register("p04_label")
def q_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.label(events(spark, sf_dir))


@register("p05_rollup_features")
def q_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.rollup_features(feat.observe(events(spark, sf_dir)), scale=defaults.MONEY_SCALE)


@register("p06_type_counts")
def q_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.type_counts(feat.observe(events(spark, sf_dir)))


@register("p07_horizon_features")
def q_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.horizon_features(events(spark, sf_dir), scale=defaults.MONEY_SCALE)


@register("p09_recency")
def q_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.recency(events(spark, sf_dir))


@register("p10_gaps")
def q_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.gaps(feat.observe(events(spark, sf_dir)))


@register("training_table")
def q_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.training_table(events(spark, sf_dir), scale=defaults.MONEY_SCALE)


# ---------------------------------------------------------------- sequences

@register("p08_rolling")
def q_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.rolling(events(spark, sf_dir), days=defaults.ROLLING_DAYS, scale=defaults.MONEY_SCALE)


@register("p11_asof_last_view")
def q_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    purchases = (ev.filter(F.col("event_type") == "purchase")
                   .select("event_id", "user_id", "ts", "value"))
    views = (ev.filter(F.col("event_type") == "view")
               .select("user_id", "ts", "value", "event_id"))
    return seq.asof_last(purchases, views, right_cols=["value", "event_id"],
                         right_order="event_id")


@register("p12_sessionize")
def q_sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.sessionize(events(spark, sf_dir), keep=["event_id"])


@register("p12_sessions")
def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seq.sessions(events(spark, sf_dir), scale=defaults.MONEY_SCALE)


# ---------------------------------------------------------------- cleaning

@register("p25_dedup_batch")
def q_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # purchases arrive again an hour later; the first copies stay
    ev = events(spark, sf_dir)
    again = ev.filter(F.col("event_type") == defaults.TARGET_TYPE).withColumn(
        "ts", F.col("ts") + F.expr("interval 1 hour"))
    return clean.dedup(ev.unionByName(again), "event_id", ["ts"])


# ---------------------------------------------------------------- joins

@register("p13_enrich")
def q_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_user = (feat.observe(events(spark, sf_dir))
                .groupBy("user_id")
                .agg(*feat.rollup_aggs(scale=defaults.MONEY_SCALE)[:2]))
    dim = joins.customer_dimension(load(spark, sf_dir, "customer"),
                                   load(spark, sf_dir, "nation"),
                                   load(spark, sf_dir, "region"))
    return joins.enrich(per_user, dim)


# ---------------------------------------------------------------- encodings

def _k_and_y(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", parse_prop("props", "k", "int").alias("k"),
        F.when(F.col("event_type") == defaults.TARGET_TYPE, 1).otherwise(0).alias("y"))


@register("p14_target_mean")
def q_target_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.target_mean(_k_and_y(spark, sf_dir), "k", "y")


@register("p15_clip_and_scale")
def q_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "value")
    return encode.clip_and_scale(ev, "value", defaults.CLIP_P, scale=defaults.MONEY_SCALE).drop("value")


@register("p16_hash_split")
def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).select("user_id").distinct()
    return encode.hash_split(users, "user_id", defaults.N_FOLDS)


# ---------------------------------------------------------------- ranking

@register("p17_top_k")
def q_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("user_id", "event_id", "value")
    return rank.top_k(ev, "user_id", "value", defaults.TOP_K, tiebreak="event_id")


def baseline_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed purchase rate before the cutoff as a score, with the label."""
    t = feat.training_table(events(spark, sf_dir), scale=defaults.MONEY_SCALE)
    score = ((F.col(f"n_{defaults.TARGET_TYPE}") + 1).cast("double")
             / (F.col("n_events") + 2).cast("double"))
    return t.select("user_id", score.alias("score"), "label")


@register("p18_metrics")
def q_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics(baseline_scored(spark, sf_dir))


@register("p19_leaderboard")
def q_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = events(spark, sf_dir).select(F.col("user_id"), F.col("value"))
    return rank.leaderboard(subs, "user_id", "value")


# ---------------------------------------------------------------- reports

def _with_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_type", F.to_date("ts").alias("day"), "value")


@register("p20_report_cube")
def q_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report(_with_day(spark, sf_dir), ["event_type", "day"], "cube", scale=defaults.MONEY_SCALE)


@register("p20_report_rollup")
def q_report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report(_with_day(spark, sf_dir), ["event_type", "day"], "rollup", scale=defaults.MONEY_SCALE)


def _buyers(ev: DataFrame, start: str, end: str) -> DataFrame:
    return ev.filter((F.col("event_type") == defaults.TARGET_TYPE)
                     & (F.col("ts") >= ts_lit(start)) & (F.col("ts") < ts_lit(end)))


@register("p21_cohort_diff")
def q_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    first = _buyers(ev, "2024-01-01 00:00:00", "2024-01-03 00:00:00")
    last = _buyers(ev, "2024-01-28 00:00:00", "2024-01-31 00:00:00")
    return report.cohort_diff(first, last, "user_id")


# ---------------------------------------------------------------- model

MODEL_FEATURES = (
    "n_events", "sum_value", "mean_value", "std_value", "median_value",
    "active_days", "n_click", "n_error", "n_purchase", "n_signup", "n_view",
    "n_1d", "sum_1d", "n_3d", "sum_3d", "n_7d", "sum_7d", "n_14d", "sum_14d",
    "days_since_last", "mean_gap_s",
)


@register("p22_fit_score")
def q_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one pass over events for both splits
    t = written(encode.hash_split(feat.training_table(events(spark, sf_dir), scale=defaults.MONEY_SCALE), "user_id"), "features")
    return fit_score(t.filter(F.col("fold") != 0), t.filter(F.col("fold") == 0),
                     MODEL_FEATURES)


@register("p22_fit_score_check")
def q_fit_score_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is certain of the scores: the test users, their labels, and that
    each score is a probability."""
    scored = q_fit_score(spark, sf_dir)
    return scored.select("user_id", "label", ((F.col("score") > 0) & (F.col("score") < 1)).alias("in_range"))
