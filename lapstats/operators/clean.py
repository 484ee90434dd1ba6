"""Cleaning and validation operators.

Every operator takes a DataFrame and returns a lazy DataFrame; the only values that
reach the driver are bounded sketches of the quantile step (see ``quantiles``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from .ordering import split_join
from .quantiles import exact_quantiles

RAW_REQUIRED = ["LapTime", "Compound", "Driver", "LapNumber"]
PROCESSED_REQUIRED = ["lap_time", "compound", "tyre_life", "stint", "driver",
                      "track_status", "lap_number", "year", "circuit"]


# P1 -------------------------------------------------------------------------
def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str] = PROCESSED_REQUIRED,
                    check_empty: bool = True) -> DataFrame:
    """Raise ``ValueError`` when a required column is absent or the input is empty."""
    miss = missing_columns(df, required)
    if miss:
        raise ValueError(f"Invalid data structure: missing columns {miss}")
    if check_empty and df.isEmpty():
        raise ValueError("Invalid data structure: no rows")
    return df


def structure_report(df: DataFrame) -> DataFrame:
    """Lazy one-row report: non-empty flag plus missing raw / processed column names."""
    return df.agg((F.count(F.lit(1)) > 0).alias("non_empty")).select(
        "non_empty",
        F.lit(",".join(missing_columns(df, RAW_REQUIRED))).alias("missing_raw"),
        F.lit(",".join(missing_columns(df, PROCESSED_REQUIRED))).alias("missing_processed"))


# P2 -------------------------------------------------------------------------
def normalise_columns(df: DataFrame) -> DataFrame:
    """Add ``tire_compound``/``tire_age`` from ``compound``/``tyre_life`` when absent."""
    cols = set(df.columns)
    if "compound" in cols and "tire_compound" not in cols:
        df = df.withColumn("tire_compound", F.col("compound"))
    if "tyre_life" in cols and "tire_age" not in cols:
        df = df.withColumn("tire_age", F.col("tyre_life"))
    return df


# P3-P6 ----------------------------------------------------------------------
def drop_missing_critical(df: DataFrame,
                          subset: Sequence[str] = ("lap_time", "tire_compound", "tire_age", "driver")
                          ) -> DataFrame:
    return df.dropna(subset=list(subset))


def lap_time_in_range(col: Column | str = "lap_time") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.between(dims.MIN_LAP_TIME, dims.MAX_LAP_TIME)


def filter_lap_time_range(df: DataFrame, col: str = "lap_time") -> DataFrame:
    """Inclusive [60, 180]; null lap times are dropped."""
    return df.where(lap_time_in_range(col))


def filter_max_stint(df: DataFrame, col: str = "tire_age") -> DataFrame:
    return df.where(F.col(col) <= dims.MAX_STINT_LENGTH)


def filter_valid_compound(df: DataFrame, col: str = "tire_compound") -> DataFrame:
    """Case-sensitive membership in the three dry compounds."""
    return df.where(F.col(col).isin(dims.COMPOUNDS))


# P7 -------------------------------------------------------------------------
def remove_invalid_laps(df: DataFrame) -> DataFrame:
    """Range + nulls (lap_time, compound, tyre_life) + green-flag laps; no IQR step."""
    out = df.where(lap_time_in_range("lap_time")).dropna(subset=["lap_time", "compound", "tyre_life"])
    if "track_status" in df.columns:
        out = out.where(F.col("track_status") == "1")
    return out


# P8 -------------------------------------------------------------------------
def validity_flags(df: DataFrame, stint_col: str = "tyre_life",
                   compound_col: str = "compound") -> DataFrame:
    """Per-row validity booleans (null input -> false)."""
    return df.select(
        "*",
        F.coalesce(lap_time_in_range("lap_time"), F.lit(False)).alias("lap_time_valid"),
        F.coalesce(F.col(compound_col).isin(dims.COMPOUNDS), F.lit(False)).alias("compound_valid"),
        F.coalesce(F.col("circuit").isin(list(dims.CIRCUITS)), F.lit(False)).alias("circuit_valid"),
        F.coalesce(F.col(stint_col).between(1, dims.MAX_STINT_LENGTH), F.lit(False)).alias("stint_valid"),
    )


# P9 -------------------------------------------------------------------------
def interval_to_seconds(col: Column | str) -> Column:
    """Day-time interval -> double seconds (microsecond precision)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("decimal(18,6)").cast("double")


def seconds_to_interval(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c.cast("decimal(18,6)"))


# P14 ------------------------------------------------------------------------
def slice_laps(df: DataFrame, years: Sequence[int] | None = None,
               circuits: Sequence[str] | None = None,
               drivers: Sequence[str] | None = None) -> DataFrame:
    """Filter by optional year / circuit / driver lists; empty or None = no filter.

    On a table written with ``partitionBy('year','circuit')`` these are partition filters.
    """
    if years:
        df = df.where(F.col("year").isin(list(years)))
    if circuits:
        df = df.where(F.col("circuit").isin(list(circuits)))
    if drivers:
        df = df.where(F.col("driver").isin(list(drivers)))
    return df


# P15 ------------------------------------------------------------------------
def iqr_bounds(df: DataFrame, col: str = "lap_time", by: Sequence[str] = (),
               k: float = 1.5, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Q1, Q3 and the ``k``·IQR fences, globally or per group of ``by``."""
    by = list(by)
    if approx:
        agg = F.percentile_approx(F.col(col), [0.25, 0.75], accuracy)
        x = df.where(F.col(col).isNotNull())
        q = (x.groupBy(*by).agg(agg.alias("_q")) if by else x.agg(agg.alias("_q"))) \
            .select(*by, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    else:
        q = exact_quantiles(df, col, [0.25, 0.75], ["q1", "q3"], by=by)
    iqr = F.col("q3") - F.col("q1")
    return q.select(*by, "q1", "q3", (F.col("q1") - k * iqr).alias("lower_bound"),
                    (F.col("q3") + k * iqr).alias("upper_bound"))


def iqr_filter(df: DataFrame, col: str = "lap_time", by: Sequence[str] = (), k: float = 1.5,
               approx: bool = False) -> DataFrame:
    """Keep rows with ``Q1 - k·IQR <= x <= Q3 + k·IQR`` (inclusive; null x dropped).

    The global form joins a one-row bounds table (broadcast, size 1); the grouped form
    joins one row per group.
    """
    b = iqr_bounds(df, col, by, k, approx).select(*by, "lower_bound", "upper_bound")
    joined = df.crossJoin(F.broadcast(b)) if not by else split_join(df, b, list(by), "inner")
    return joined.where(F.col(col).between(F.col("lower_bound"), F.col("upper_bound"))) \
                 .drop("lower_bound", "upper_bound")


# P16 ------------------------------------------------------------------------
def validate_laps(df: DataFrame, approx: bool = False) -> DataFrame:
    """P2 -> P3 -> P4 -> P5 -> P15 -> P6, in that order (IQR sees invalid compounds)."""
    df = normalise_columns(df)
    df = drop_missing_critical(df)
    df = filter_lap_time_range(df)
    df = filter_max_stint(df)
    df = iqr_filter(df, "lap_time", approx=approx)
    return filter_valid_compound(df)


def validation_counts(df: DataFrame) -> DataFrame:
    """Rows surviving each step of ``validate_laps``."""
    d = normalise_columns(df)
    s3 = F.col("lap_time").isNotNull() & F.col("tire_compound").isNotNull() & \
        F.col("tire_age").isNotNull() & F.col("driver").isNotNull()
    s4 = s3 & lap_time_in_range("lap_time")
    s5 = s4 & (F.col("tire_age") <= dims.MAX_STINT_LENGTH)
    b = iqr_bounds(d.where(s5)).select("lower_bound", "upper_bound")     # one row
    s6 = s5 & F.col("lap_time").between(F.col("lower_bound"), F.col("upper_bound"))
    s7 = s6 & F.col("tire_compound").isin(dims.COMPOUNDS)
    return d.crossJoin(F.broadcast(b)).agg(F.count(F.lit(1)).alias("input_rows"),
                 F.count_if(s3).alias("after_missing"),
                 F.count_if(s4).alias("after_range"),
                 F.count_if(s5).alias("after_stint"),
                 F.count_if(s6).alias("after_iqr"),
                 F.count_if(s7).alias("after_compound"))


# P17 ------------------------------------------------------------------------
def process_laps(df: DataFrame, pits: DataFrame | None = None) -> DataFrame:
    """P1 (raises, on an empty input too) -> P7 -> W9 -> W7; one frame with an ``is_test`` flag.

    ``train = out.where(~is_test)``, ``test = out.where(is_test)``. The clean and the engineered
    laps are each written to the shared folder once, as the steps after them read them more
    than once.
    """
    from ..staging import stage
    from .panel import chronological_split, engineer_features
    require_columns(df, PROCESSED_REQUIRED)
    clean = normalise_columns(stage(remove_invalid_laps(df), "clean"))
    return chronological_split(stage(engineer_features(clean, pits), "features"))
