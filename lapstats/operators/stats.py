"""Aggregations, reports, sorts and set operations.

All are single-pass ``groupBy``/``agg`` plans (partial aggregation on the map side),
so a hot group costs one partial row per task. Report-style results are one row or
one row per column, never a collected frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.exprs import fixed
from .quantiles import exact_quantiles


def _r(c: Column, n: int = 6) -> Column:
    return F.round(c, n)


# A1 -------------------------------------------------------------------------
def yearly_mean_lap_time(laps: DataFrame, circuit: str | None = None) -> DataFrame:
    """Mean lap time by year for one circuit, or by (circuit, year) for all."""
    if circuit is not None:
        return laps.where(F.col("circuit") == circuit).groupBy("year") \
                   .agg(_r(F.avg("lap_time")).alias("mean_lap_time"))
    return laps.groupBy("circuit", "year").agg(_r(F.avg("lap_time")).alias("mean_lap_time"))


# A2 -------------------------------------------------------------------------
def compound_usage(laps: DataFrame, compound: str = "tire_compound") -> DataFrame:
    return laps.groupBy("year", F.col(compound).alias("tire_compound")).agg(
        F.count(F.lit(1)).alias("laps"))


# A3 -------------------------------------------------------------------------
def compound_performance(laps: DataFrame, compound: str = "tire_compound",
                         age: str = "tire_age") -> DataFrame:
    """Per compound: mean and sample std of lap time, mean tyre age; rounded to 3 dp."""
    return laps.groupBy(F.col(compound).alias("tire_compound")).agg(
        F.round(F.avg("lap_time"), 3).alias("mean_lap_time"),
        F.round(F.stddev_samp("lap_time"), 3).alias("std_lap_time"),
        F.round(F.avg(age), 3).alias("mean_tire_age"),
        F.count(F.lit(1)).alias("laps"))


# A4 -------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Exactly ``bins`` equal-width bins over [min, max] (D10); the max falls in the
    last bin; empty bins are omitted. Edges come from a one-row aggregate."""
    mm = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / w), F.lit(bins - 1))).cast("int")
    x = df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(mm)).select(b.alias("bin"), "_lo", "_hi")
    return x.groupBy("bin").agg(
        F.count(F.lit(1)).alias("count"),
        _r(F.first("_lo") + F.col("bin") * (F.first("_hi") - F.first("_lo")) / bins).alias("bin_start"),
        _r(F.first("_lo") + (F.col("bin") + 1) * (F.first("_hi") - F.first("_lo")) / bins).alias("bin_end"))


def pit_lap_histogram(pits: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(pits, "pit_lap", bins)


# A5 / T3 --------------------------------------------------------------------
def common_tyre_changes(pits: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` (out, in) compound pairs by count, ties by the pair (a top-k report)."""
    return (pits.groupBy("tire_compound_out", "tire_compound_in").agg(F.count(F.lit(1)).alias("changes"))
                .orderBy(F.desc("changes"), F.asc_nulls_first("tire_compound_out"),
                         F.asc_nulls_first("tire_compound_in"))
                .limit(n))


# A6 -------------------------------------------------------------------------
def historical_performance(laps: DataFrame, compound: str = "compound") -> DataFrame:
    """Per (circuit, compound): mean lap time; per circuit: data points, plus the
    constant window / rate / safety-car fields, in one fixed schema for all circuits."""
    per = laps.groupBy("circuit", F.col(compound).alias("compound")).agg(
        _r(F.avg("lap_time")).alias("average_lap_time"), F.count(F.lit(1)).alias("compound_laps"))
    tot = laps.groupBy("circuit").agg(F.count(F.lit(1)).alias("data_points"))
    rate = dims.rate_expr(F.col("compound"))
    return per.join(tot, "circuit").select(
        "circuit", "compound", "average_lap_time", "compound_laps", "data_points",
        rate.alias("degradation_rate"), F.lit("15,25,35").alias("typical_pit_windows"),
        F.lit(0.3).alias("safety_car_frequency"))


# A7 -------------------------------------------------------------------------
def stint_performance(laps: DataFrame, keys: Sequence[str] = ("year", "circuit", "driver", "stint"),
                      y: str = "lap_time", x: str = "tyre_life") -> DataFrame:
    """Per stint: mean/min/max, OLS slope of y on x (0 for n=1 or constant x),
    population std, count. Rows with a null y or x are ignored."""
    d = laps.where(F.col(y).isNotNull() & F.col(x).isNotNull())
    return d.groupBy(*keys).agg(
        _r(F.avg(y)).alias("average_lap_time"), F.min(y).alias("fastest_lap"), F.max(y).alias("slowest_lap"),
        _r(F.coalesce(F.regr_slope(y, x), F.lit(0.0))).alias("degradation_rate"),
        _r(F.stddev_pop(y)).alias("consistency"), F.count(F.lit(1)).alias("stint_length"))


# A8 -------------------------------------------------------------------------
def percentile_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """min, q25, median, q75, max, iqr, mean, sample std (0 when n = 1); exact
    interpolated quartiles. Global form: one row, nulls on empty input."""
    by = list(by)
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], ["q25", "median", "q75"], by=by)
    x = df.where(F.col(col).isNotNull())
    aggs = [F.min(F.col(col).cast("double")).alias("min"), F.max(F.col(col).cast("double")).alias("max"),
            F.avg(col).alias("mean"), F.stddev_samp(col).alias("_sd"), F.count(F.lit(1)).alias("n")]
    a = x.groupBy(*by).agg(*aggs) if by else x.agg(*aggs)
    j = a.join(q, by) if by else a.crossJoin(q)
    std = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(F.col("_sd"))
    return j.select(*by, "min", _r(F.col("q25")).alias("q25"), _r(F.col("median")).alias("median"),
                    _r(F.col("q75")).alias("q75"), "max", _r(F.col("q75") - F.col("q25")).alias("iqr"),
                    _r(F.col("mean")).alias("mean"), _r(std).alias("std"), "n")


# A9 -------------------------------------------------------------------------
def processed_data_metrics(df: DataFrame, features: Sequence[str], target: str = "lap_time",
                           compound: str = "tire_compound") -> DataFrame:
    cols = [c for c in [*features, target] if c in df.columns]
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in cols], F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.lit(len([c for c in features if c in df.columns])).alias("total_features"),
        nulls.cast("bigint").alias("missing_values"),
        F.count_distinct("driver").alias("unique_drivers"), F.count_distinct("circuit").alias("unique_circuits"),
        F.concat_ws("-", F.min("year").cast("string"), F.max("year").cast("string")).alias("year_range"),
        F.concat(fixed(F.min("lap_time"), 2), F.lit("-"), fixed(F.max("lap_time"), 2)).alias("lap_time_range"),
        F.array_join(F.array_sort(F.collect_set(compound)), ",").alias("tire_compounds"),
        (F.count(F.lit(1)) < 1000).alias("low_volume"))


# A10 / U3 -------------------------------------------------------------------
def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows (one row per such group).

    Digests of 128 bits are counted first, so 16 bytes a row are shuffled; whole rows are
    grouped only where a digest comes twice, and compared in full there."""
    cols = [F.col(c) for c in df.columns]
    digest = F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols, F.lit(2)).alias("b"))
    twice = df.select(digest.alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    rows = df.withColumn("_digest", digest).join(twice.select("_digest"), "_digest", "left_semi").drop("_digest")
    return rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1) \
               .withColumn("extra_copies", F.col("_c") - 1).drop("_c")


def data_quality(df: DataFrame) -> DataFrame:
    """rows, null cells, duplicate rows beyond the first, column types, quality score
    ``max(0, 1 - .5·nulls/cells - .3·dups/rows)`` (1.0 when empty)."""
    ncols = len(df.columns)
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns], F.lit(0))
    a = df.agg(F.count(F.lit(1)).alias("total_rows"), nulls.cast("bigint").alias("missing_values"))
    d = duplicate_rows(df).agg(F.coalesce(F.sum("extra_copies"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    j = a.crossJoin(d)
    rows = F.col("total_rows")
    score = F.when(rows == 0, F.lit(1.0)).otherwise(F.greatest(
        F.lit(0.0), 1 - 0.5 * F.col("missing_values") / (rows * ncols) - 0.3 * F.col("duplicate_rows") / rows))
    return j.select("total_rows", "missing_values", "duplicate_rows",
                    F.lit(ncols).alias("total_columns"),
                    F.lit(",".join(f"{c}:{t}" for c, t in df.dtypes)).alias("column_types"), _r(score).alias("quality_score"))


# A11 ------------------------------------------------------------------------
def data_completeness(df: DataFrame) -> DataFrame:
    """One row for the table (``column_name`` null) and one per column with nulls: count,
    percent of the rows (of the cells for the table), table score and validity. A clean table
    is valid with score 1, an empty one invalid with score 0."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    total = reduce(lambda a, b: a + b, [F.col(f"_n{i}") for i in range(len(cols))], F.lit(0))
    wide = wide.withColumn("_tot", total.cast("bigint"))
    stack = "stack({}, cast(null as string), _tot, {}) as (column_name, missing_count)".format(
        len(cols) + 1, ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols)))
    long = wide.selectExpr("_rows", "_tot", stack)
    cells = F.col("_rows") * len(cols)
    of = F.when(F.col("column_name").isNull(), cells).otherwise(F.col("_rows"))
    return long.where((F.col("missing_count") > 0) | F.col("column_name").isNull()).select(
        "column_name", F.col("missing_count").cast("bigint").alias("missing_count"),
        _r(F.coalesce(F.try_divide(F.col("missing_count") * 100.0, of), F.lit(0.0))).alias("missing_percentage"),
        _r(F.when(cells > 0, 1 - F.col("_tot") / cells).otherwise(0.0)).alias("completeness_score"),
        ((F.col("_tot") == 0) & (F.col("_rows") > 0)).alias("is_valid"))


# A12 ------------------------------------------------------------------------
def data_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
                  F.min("lap_time").alias("min_lap_time"), F.max("lap_time").alias("max_lap_time"),
                  F.min("year").alias("first_year"), F.max("year").alias("last_year"),
                  F.count_distinct("circuit").alias("circuits"))


# A13 ------------------------------------------------------------------------
def processed_data_valid(df: DataFrame, life: str = "tyre_life") -> DataFrame:
    """All lap times in [60,180] and (if present) all tyre lives <= 50; a missing value fails
    its check; empty -> false."""
    ok = F.bool_and(F.coalesce(F.col("lap_time").between(dims.MIN_LAP_TIME, dims.MAX_LAP_TIME), F.lit(False)))
    checks = [ok]
    if life in df.columns:
        checks.append(F.bool_and(F.coalesce(F.col(life) <= dims.MAX_STINT_LENGTH, F.lit(False))))
    allok = reduce(lambda a, b: a & b, checks)
    return df.agg(F.coalesce(allok, F.lit(False)).alias("is_valid"), F.count(F.lit(1)).alias("rows"))


# A14 ------------------------------------------------------------------------
def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """R², MAE, RMSE and mean / sample std of the target in one aggregate. R² is null
    for a constant target."""
    e = F.col(y) - F.col(p)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("_sse"), F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(y).alias("target_mean"),
            F.stddev_samp(y).alias("target_std"), F.var_pop(y).alias("_vp")]
    a = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    r2 = 1 - F.try_divide(F.col("_sse"), F.col("_vp") * F.col("n"))
    return a.select(*by, "n", _r(r2).alias("r2"), _r(F.col("mae")).alias("mae"), _r(F.col("rmse")).alias("rmse"),
                    _r(F.col("target_mean")).alias("target_mean"), _r(F.col("target_std")).alias("target_std"))


# A15 ------------------------------------------------------------------------
def ingest_report(laps: DataFrame, years: Sequence[int] = dims.ANALYSIS_YEARS,
                  circuits: Sequence[str] = tuple(dims.CIRCUITS)) -> DataFrame:
    """Rows per expected (year, circuit) unit; ``ok`` when it has rows; plus the
    ok/total counts. The expected grid is years x circuits (20 rows)."""
    spark = laps.sparkSession
    grid = spark.createDataFrame([(y, c) for y in years for c in circuits], "year int, circuit string")
    cnt = laps.groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("rows"))
    r = grid.join(cnt, ["year", "circuit"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("bigint"))
    r = r.withColumn("ok", F.col("rows") > 0)
    tot = r.agg(F.count_if("ok").alias("ok_units"), F.count(F.lit(1)).alias("total_units"))
    return r.crossJoin(F.broadcast(tot))


# T1 / T6 --------------------------------------------------------------------
def sort_laps(df: DataFrame, by: Sequence[str] = ("year", "circuit", "driver", "lap_number"),
              tie: str = "lap_id") -> DataFrame:
    """Rows in order; ``tie`` (where present) settles rows that agree on all of ``by``."""
    return df.orderBy(*by, *([tie] if tie in df.columns and tie not in by else []))


def distinct_sorted(df: DataFrame, col: str, year: int | None = None, circuit: str | None = None) -> DataFrame:
    """Cascading pickers: years; circuits of a year; drivers of a year and circuit."""
    if year is not None:
        df = df.where(F.col("year") == year)
    if circuit is not None:
        df = df.where(F.col("circuit") == circuit)
    return df.select(col).distinct().orderBy(col)


# U1 -------------------------------------------------------------------------
def union_laps(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns absent from a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
