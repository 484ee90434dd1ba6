"""Registered queries: one per operator of the inventory, over the given tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose column names
match the DuckDB twin in ``oracle_sql``. Floating aggregates are rounded to 6 dp on
both sides so that summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testview as tv
from .operators import clean, panel, stats
from .staging import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _round(df: DataFrame, cols, n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c in cols})


def laps(spark, sf):
    return tv.laps(spark, sf)


def pits(spark, sf):
    return panel.detect_pit_stops(laps(spark, sf))


def valid(spark, sf):
    return clean.validate_laps(laps(spark, sf))


def features(spark, sf):
    """W9 input as the pipeline builds it: P7-cleaned laps, pits from unfiltered laps."""
    l = laps(spark, sf)
    return panel.engineer_features(clean.normalise_columns(clean.remove_invalid_laps(l)),
                                   panel.detect_pit_stops(l))


FEAT_ROUND = ["gap_to_leader", "rolling_avg_lap_time_3", "rolling_avg_lap_time_5", "relative_performance"]


# --- P -----------------------------------------------------------------------
@query
def q_require_columns(spark, sf):
    return clean.structure_report(laps(spark, sf))


@query
def q_normalise_columns(spark, sf):
    return clean.normalise_columns(laps(spark, sf))


@query
def q_drop_missing_critical(spark, sf):
    return clean.drop_missing_critical(clean.normalise_columns(laps(spark, sf)))


@query
def q_filter_lap_time_range(spark, sf):
    return clean.filter_lap_time_range(laps(spark, sf))


@query
def q_filter_max_stint(spark, sf):
    return clean.filter_max_stint(clean.normalise_columns(laps(spark, sf)))


@query
def q_filter_valid_compound(spark, sf):
    return clean.filter_valid_compound(clean.normalise_columns(laps(spark, sf)))


@query
def q_remove_invalid_laps(spark, sf):
    return clean.remove_invalid_laps(laps(spark, sf))


@query
def q_validity_flags(spark, sf):
    return clean.validity_flags(laps(spark, sf))


@query
def q_interval_to_seconds(spark, sf):
    l = laps(spark, sf).select("lap_id", clean.seconds_to_interval("lap_time").alias("lap_interval"))
    return l.select("lap_id", clean.interval_to_seconds("lap_interval").alias("lap_seconds"))


@query
def q_default_position_gap(spark, sf):
    d = panel.default_position_gap(laps(spark, sf))
    return _round(d.select("lap_id", "position", "gap_to_leader"), ["gap_to_leader"])


@query
def q_predicted_degradation(spark, sf):
    d = panel.predicted_degradation(clean.normalise_columns(laps(spark, sf)))
    return d.select("lap_id", "tire_compound", "tire_age", "tire_degradation_rate", "predicted_degradation")


@query
def q_one_hot_compound(spark, sf):
    d = panel.one_hot_compound(clean.normalise_columns(laps(spark, sf)))
    return d.select("lap_id", "tire_compound", "compound_SOFT", "compound_MEDIUM", "compound_HARD")


@query
def q_slice_laps(spark, sf):
    return clean.slice_laps(laps(spark, sf), years=[2022, 2023], circuits=["monza", "spa"])


@query
def q_iqr_filter(spark, sf):
    return clean.iqr_filter(laps(spark, sf), "lap_time")


@query
def q_iqr_bounds_by_circuit(spark, sf):
    b = clean.iqr_bounds(laps(spark, sf), "lap_time", by=["circuit"])
    return _round(b, ["q1", "q3", "lower_bound", "upper_bound"])


@query
def q_validate_laps(spark, sf):
    return valid(spark, sf)


@query
def q_validation_counts(spark, sf):
    return clean.validation_counts(laps(spark, sf))


@query
def q_select_features(spark, sf):
    d = panel.select_features(features(spark, sf), keep=["lap_id"])
    return _round(d, FEAT_ROUND)


@query
def q_process_laps(spark, sf):
    """P17 without pits, every feature column, train and test."""
    from .oracle_sql import FEAT_NAMES
    return _round(clean.process_laps(laps(spark, sf)), FEAT_ROUND).select(*FEAT_NAMES, "split_rank", "is_test")


# --- W / J -------------------------------------------------------------------
@query
def q_detect_pit_stops(spark, sf):
    return pits(spark, sf)


@query
def q_position_change(spark, sf):
    l = laps(spark, sf).withColumn("position", F.coalesce(F.col("position"), F.lit(20.0)))
    return panel.position_change(l).select("lap_id", "position", "position_change")


@query
def q_rolling_mean_lap_time(spark, sf):
    l = laps(spark, sf)
    l = panel.rolling_mean(l, 3, out="rolling_avg_lap_time_3")
    l = panel.rolling_mean(l, 5, out="rolling_avg_lap_time_5")
    l = panel.rolling_mean(l, 3, out="prior_avg_lap_time_3", include_current=False)
    return _round(l.select("lap_id", "rolling_avg_lap_time_3", "rolling_avg_lap_time_5", "prior_avg_lap_time_3"),
                  ["rolling_avg_lap_time_3", "rolling_avg_lap_time_5", "prior_avg_lap_time_3"])


@query
def q_stint_length(spark, sf):
    return panel.stint_length(clean.normalise_columns(laps(spark, sf))).select("lap_id", "stint_length")


@query
def q_relative_performance(spark, sf):
    d = panel.relative_performance(laps(spark, sf))
    return _round(d.select("lap_id", "relative_performance"), ["relative_performance"])


@query
def q_laps_since_pit(spark, sf):
    l = laps(spark, sf)
    return panel.laps_since_pit(l, panel.detect_pit_stops(l)).select("lap_id", "laps_since_pit")


@query
def q_label_encode(spark, sf):
    return panel.fit_label_mappings(laps(spark, sf), ["driver", "circuit", "compound"])


@query
def q_label_encode_extended(spark, sf):
    """Codes fitted on the early years, values unseen there appended in order."""
    l = laps(spark, sf)
    out = None
    for c in ("driver", "compound"):
        fitted = panel.fit_label_mapping(l.where("year < 2023"), c)
        m = panel.extend_label_mapping(fitted, l, c).select(F.lit(c).alias("column_name"), "value", "code")
        out = m if out is None else out.unionByName(m)
    return out


@query
def q_chronological_split(spark, sf):
    """The valid laps are staged: the split reads them several times."""
    return panel.chronological_split(stage(valid(spark, sf), "valid")).select("lap_id", "split_rank", "is_test")


@query
def q_engineer_features(spark, sf):
    from .oracle_sql import FEAT_NAMES
    return _round(features(spark, sf), FEAT_ROUND).select(*FEAT_NAMES)


# --- A / T / U ---------------------------------------------------------------
@query
def q_yearly_mean_lap_time(spark, sf):
    return stats.yearly_mean_lap_time(valid(spark, sf))


@query
def q_compound_usage(spark, sf):
    return stats.compound_usage(valid(spark, sf))


@query
def q_compound_performance(spark, sf):
    return stats.compound_performance(valid(spark, sf))


@query
def q_pit_lap_histogram(spark, sf):
    return stats.pit_lap_histogram(pits(spark, sf))


@query
def q_common_tyre_changes(spark, sf):
    return stats.common_tyre_changes(pits(spark, sf))


@query
def q_top_tyre_changes(spark, sf):
    """The first ten rows of the A5 report (ties broken by the compound pair)."""
    return stats.common_tyre_changes(pits(spark, sf), n=10)


@query
def q_historical_performance(spark, sf):
    return stats.historical_performance(laps(spark, sf))


@query
def q_stint_performance(spark, sf):
    return stats.stint_performance(laps(spark, sf))


@query
def q_percentile_stats(spark, sf):
    return stats.percentile_stats(laps(spark, sf), "lap_time")


@query
def q_percentile_stats_by_circuit(spark, sf):
    return stats.percentile_stats(laps(spark, sf), "lap_time", by=["circuit"])


@query
def q_percentile_stats_lineitem(spark, sf):
    return stats.percentile_stats(tv.big(spark, sf), "l_extendedprice", by=["l_returnflag"])


@query
def q_processed_data_metrics(spark, sf):
    return stats.processed_data_metrics(features(spark, sf), panel.FEATURES)


QUALITY_COLS = ["year", "circuit", "compound", "stint", "tyre_life", "track_status"]


@query
def q_data_quality(spark, sf):
    return stats.data_quality(laps(spark, sf).select(*QUALITY_COLS))


@query
def q_duplicate_rows(spark, sf):
    return stats.duplicate_rows(laps(spark, sf).select(*QUALITY_COLS))


@query
def q_data_completeness(spark, sf):
    """A11 on the laps, on a table without nulls and on an empty one."""
    l = laps(spark, sf)
    ids = l.select("lap_id", "year")
    out = None
    for name, df in (("laps", l), ("clean", ids), ("empty", ids.where("lap_id < 0"))):
        part = stats.data_completeness(df).withColumn("input", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query
def q_data_summary(spark, sf):
    return stats.data_summary(laps(spark, sf))


@query
def q_processed_data_valid(spark, sf):
    """A13 on all laps, on valid ones, on valid ones of which some lack a tyre life, on none."""
    l, v = laps(spark, sf), valid(spark, sf)
    part = v.withColumn("tyre_life", F.when(F.col("lap_id") % 41 != 0, F.col("tyre_life")))
    out = None
    for name, df in (("laps", l), ("valid", v), ("missing_life", part), ("empty", v.where("lap_id < 0"))):
        one = stats.processed_data_valid(df).withColumn("input", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query
def q_ingest_report(spark, sf):
    return stats.ingest_report(laps(spark, sf))


@query
def q_distinct_sorted(spark, sf):
    l = laps(spark, sf)
    y = stats.distinct_sorted(l, "year").select(F.lit("year").alias("picker"), F.col("year").cast("string").alias("value"))
    c = stats.distinct_sorted(l, "circuit", year=2022).select(F.lit("circuit").alias("picker"), F.col("circuit").alias("value"))
    d = stats.distinct_sorted(l, "driver", year=2022, circuit="monza").select(
        F.lit("driver").alias("picker"), F.col("driver").alias("value"))
    return y.unionByName(c).unionByName(d)


@query
def q_union_laps(spark, sf):
    cols = ["year", "circuit", "driver", "lap_number", "lap_time", "compound"]
    l = laps(spark, sf).select(*cols)
    a = l.where(F.col("year") == 2021)
    b = l.where(F.col("year") != 2021).withColumn("session_type", F.lit("R"))
    return stats.union_laps(a, b)


@query
def q_sort_laps(spark, sf):
    return stats.sort_laps(laps(spark, sf))
