"""Sources and sinks (S1-S11, U1): lap files in, partitioned Parquet tables out.

Raw laps arrive as files in a landing directory (Parquet, JSON or CSV, optionally
partitioned ``year=/circuit=``); the HTTP client of the reference is replaced by
that directory. Stored tables are Parquet partitioned by ``year, circuit`` so that
year/circuit filters prune whole directories.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims
from ..functions.exprs import parse_lap_time
from ..operators.clean import interval_to_seconds
from ..operators.ordering import fan_out
from ..session import ensure_checkpoint_dir

PARTITIONS = ["year", "circuit"]

RAW_SCHEMA = T.StructType([
    T.StructField("Driver", T.StringType()), T.StructField("LapNumber", T.IntegerType()),
    T.StructField("LapTime", T.DayTimeIntervalType(0, 3)), T.StructField("Compound", T.StringType()),
    T.StructField("TyreLife", T.IntegerType()), T.StructField("TrackStatus", T.StringType()),
    T.StructField("Position", T.DoubleType()), T.StructField("Stint", T.IntegerType()),
    T.StructField("IsPersonalBest", T.BooleanType()),
])

PLAN_JSON_SCHEMA = "pit_stops array<int>, compounds array<string>, type string"

# landing directories are partitioned year=/circuit=; the schema is declared, never inferred
LANDING_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField("year", T.IntegerType()),
                                                   T.StructField("circuit", T.StringType())])


EMPTY_BYTES = 1 << 20       # a Parquet file without rows is smaller


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp)."""
    return os.path.join(ensure_checkpoint_dir(spark), "lapstats-tables", f"{name}-{uuid.uuid4().hex[:12]}")


def lap_seconds(df: DataFrame, col: str = "LapTime"):
    """Lap time column as double seconds, whatever the raw type (interval, text, number)."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.DayTimeIntervalType):
        return interval_to_seconds(col)
    if isinstance(dt, T.StringType):
        return parse_lap_time(F.col(col))
    return F.col(col).cast("double")


def _valid_raw(raw: DataFrame):
    secs = lap_seconds(raw)
    return raw.withColumn("_secs", secs).where(
        F.col("_secs").between(dims.MIN_LAP_TIME, dims.MAX_LAP_TIME) & (F.col("TrackStatus") == "1"))


def _opt(raw: DataFrame, col: str, default):
    return F.coalesce(F.col(col), F.lit(default)) if col in raw.columns else F.lit(default)


# S1 -------------------------------------------------------------------------
def ingest_race_laps(raw: DataFrame, year: int | None = None, circuit: str | None = None) -> DataFrame:
    """Raw session laps -> ``race_data``: green-flag laps with 60 <= time <= 180 s,
    null position -> 20, gap_to_leader = (position - 1) x 0.5."""
    v = _valid_raw(raw)
    pos = _opt(v, "Position", 20.0).cast("double")
    return v.select(
        (F.col("year") if "year" in raw.columns else F.lit(year)).cast("int").alias("year"),
        (F.col("circuit") if "circuit" in raw.columns else F.lit(circuit)).alias("circuit"),
        F.col("Driver").alias("driver"), F.col("LapNumber").cast("int").alias("lap_number"),
        F.col("_secs").alias("lap_time"), F.col("Compound").alias("tire_compound"),
        F.col("TyreLife").cast("int").alias("tire_age"), F.col("TrackStatus").alias("track_status"),
        pos.alias("position"), ((pos - 1) * 0.5).alias("gap_to_leader"))


# S2 -------------------------------------------------------------------------
def ingest_session_laps(raw: DataFrame, session_type: str = "R", year: int | None = None,
                        circuit: str | None = None) -> DataFrame:
    """Same filter for any session type -> ``laps`` shape; stint defaults to 1 and
    is_personal_best to false when absent or null."""
    v = _valid_raw(raw)
    return v.select(
        (F.col("year") if "year" in raw.columns else F.lit(year)).cast("int").alias("year"),
        (F.col("circuit") if "circuit" in raw.columns else F.lit(circuit)).alias("circuit"),
        F.lit(session_type).alias("session_type"), F.col("Driver").alias("driver"),
        F.col("LapNumber").cast("int").alias("lap_number"), F.col("_secs").alias("lap_time"),
        F.col("Compound").alias("compound"), _opt(v, "Stint", 1).cast("int").alias("stint"),
        F.col("TyreLife").cast("int").alias("tyre_life"), F.col("TrackStatus").alias("track_status"),
        _opt(v, "IsPersonalBest", False).cast("boolean").alias("is_personal_best"))


# S3 -------------------------------------------------------------------------
def read_landing(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """One read over a landing directory (partition columns discovered). Unreadable files do
    not fail it; ``_file`` names each row's file, and for text formats ``_corrupt_record``
    holds a malformed record, so that ``landing_report`` can count both."""
    r = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "false")
    if fmt in ("json", "csv"):
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        if fmt == "csv":
            r = r.option("header", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.format(fmt).load(path).withColumn("_file", F.col("_metadata.file_path"))


def footer_rows(spark: SparkSession, path: str, raw: DataFrame) -> DataFrame:
    """(year, circuit, footer_rows): rows that the Parquet footers under ``path`` name, no data
    page read: the count is pushed to the scan, in a session of its own whose settings allow
    it. One row per unit comes to the driver. Text formats have no footers: no rows."""
    units = []
    if "_corrupt_record" not in raw.columns:
        own = spark.newSession()
        for key, value in (("spark.sql.sources.useV1SourceList", ""), ("spark.sql.parquet.aggregatePushdown", "true"),
                           ("spark.sql.files.ignoreCorruptFiles", "true")):
            own.conf.set(key, value)
        data = T.StructType([f for f in raw.schema.fields if f.name != "_file"])
        units = [tuple(r) for r in own.read.schema(data).parquet(path).groupBy("year", "circuit").count().collect()]
    return spark.createDataFrame(units, "year int, circuit string, footer_rows long")


def landing_report(spark: SparkSession, path: str, raw: DataFrame, race: DataFrame, years: Sequence[int],
                   circuits: Sequence[str]) -> DataFrame:
    """Per expected (year, circuit) unit: valid rows, files, bad_files (files that gave no row and
    are not whole, empty Parquet files), bad_records (malformed text records), lost_rows (rows
    that the Parquet footers name and the read did not give: a file that breaks half way) and
    ``ok``: rows, and nothing bad or lost; plus the ok/total counts."""
    on = ["year", "circuit"]
    unit = lambda c: (F.regexp_extract(c, r"[/]year=([^/]+)/", 1).cast("int").alias("year"),
                      F.regexp_extract(c, r"[/]circuit=([^/]+)/", 1).alias("circuit"))
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .withColumn("f", F.regexp_replace("path", "^file:/+", "/"))
              .where(~F.element_at(F.split("f", "/"), -1).rlike("^[_.]")))
    # the content is read of small files alone (the length is checked before): an empty Parquet
    # file has its mark at both ends
    mark = F.lit("PAR1").cast("binary")
    whole = listed.where(F.col("length") < EMPTY_BYTES).where(
        (F.substring("content", 1, 4) == mark) & (F.expr("substring(content, -4)") == mark)).select("f", F.lit(True).alias("whole"))
    listed = listed.select("f")         # names only
    bad = F.count_if(F.col("_corrupt_record").isNotNull()) if "_corrupt_record" in raw.columns else F.lit(0)
    read = raw.groupBy(F.regexp_replace("_file", "^file:/+", "/").alias("f")).agg(bad.cast("bigint").alias("bad"))
    files = (listed.join(read, "f", "left").join(whole, "f", "left").select(*unit(F.col("f")), "bad", "whole").groupBy(*on).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("bad").isNull() & F.col("whole").isNull()).alias("bad_files"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_records")))
    # the hash makes the count read every column: a count alone would not touch a broken page
    cells = F.max(F.xxhash64(*[F.col(c) for c in raw.columns if c != "_file"]))
    got = raw.groupBy(*on).agg(F.count(F.lit(1)).alias("_got"), cells.alias("_cells")).where(F.col("_cells").isNotNull())
    lost = footer_rows(spark, path, raw).join(got, on, "left") \
        .select(*on, F.greatest(F.col("footer_rows") - F.coalesce("_got", F.lit(0)), F.lit(0)).alias("lost_rows"))
    grid = spark.createDataFrame([(y, c) for y in years for c in circuits], "year int, circuit string")
    rows = race.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    counts = ["rows", "files", "bad_files", "bad_records", "lost_rows"]
    r = grid.join(rows, on, "left").join(files, on, "left").join(lost, on, "left").na.fill(0, counts)
    r = r.withColumn("ok", (F.col("rows") > 0) & (F.col("bad_files") == 0) & (F.col("bad_records") == 0) & (F.col("lost_rows") == 0))
    tot = r.agg(F.count_if("ok").alias("ok_units"), F.count(F.lit(1)).alias("total_units"))
    return r.crossJoin(F.broadcast(tot))


def ingest_all(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
               years: Sequence[int] = dims.ANALYSIS_YEARS,
               circuits: Sequence[str] = tuple(dims.CIRCUITS)) -> tuple[DataFrame, DataFrame]:
    """All (year, circuit) units of a landing directory -> (race_data, report). One broken
    unit does not fail the others, and the report (``landing_report``) names what was lost."""
    raw = read_landing(spark, path, fmt, schema or LANDING_SCHEMA)
    race = ingest_race_laps(raw)
    return race, landing_report(spark, path, raw, race, years, circuits)


# S4 -------------------------------------------------------------------------
def append_table(df: DataFrame, path: str, idempotent: bool = False) -> None:
    """Append rows partitioned by year/circuit. Plain append duplicates rows when run
    twice (as the reference does); ``idempotent`` replaces only the partitions present
    in ``df`` (dynamic partition overwrite). Rows are clustered by unit and a hash bucket
    first, so a unit gets a few files and no task holds a whole large unit."""
    n = fan_out(df)
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(n))
    w = df.repartition(*PARTITIONS, bucket).write.partitionBy(*PARTITIONS)
    if idempotent:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)


# S5 / S6 / S7 ---------------------------------------------------------------
def _filtered(df: DataFrame, years, circuits) -> DataFrame:
    if years:
        df = df.where(F.col("year").isin(list(years)))
    if circuits:
        df = df.where(F.col("circuit").isin(list(circuits)))
    return df


def load_combined(spark: SparkSession, race_path: str, pit_path: str, years: Sequence[int] | None = None,
                  circuits: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Race and pit rows, optionally restricted to years / circuits (partition pruning)."""
    return (_filtered(spark.read.parquet(race_path), years, circuits),
            _filtered(spark.read.parquet(pit_path), years, circuits))


def load_all_laps(spark: SparkSession, laps_path: str) -> DataFrame:
    return spark.read.parquet(laps_path)


def available_sessions(laps: DataFrame) -> DataFrame:
    return laps.select("year", "circuit", "session_type").distinct().orderBy(F.desc("year"), "circuit")


# S8 / S9 --------------------------------------------------------------------
def adhoc_sql(spark: SparkSession, query: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run user SQL over the given tables, whose names are views while Spark analyses the text:
    it goes to Spark as it is, with comments, quoted names, ``WITH RECURSIVE`` and all. A view
    of the caller under one of the names is put back. Errors raise (D9)."""
    quoted = {name: "`" + name.replace("`", "``") + "`" for name in tables}
    before = {name: spark.table(q) for name, q in quoted.items()
              if spark.catalog.tableExists(q) and spark.catalog.getTable(q).isTemporary}
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(quoted[name])
        return spark.sql(query)
    finally:
        for name, q in quoted.items():
            spark.catalog.dropTempView(name)
            if name in before:
                before[name].createOrReplaceTempView(q)


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table, as one union of count aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# S10 ------------------------------------------------------------------------
def plans_to_json(plans: DataFrame) -> DataFrame:
    """Plan columns -> one JSON document per plan (``pit_stops``, ``compounds``, ``type``)."""
    doc = F.struct(F.col("pit_laps").alias("pit_stops"), F.col("compounds").alias("compounds"),
                   F.col("plan_type").alias("type"))
    return plans.withColumn("plan_json", F.to_json(doc))


def plans_from_json(df: DataFrame, col: str = "plan_json") -> DataFrame:
    p = F.from_json(F.col(col), PLAN_JSON_SCHEMA)
    return df.withColumn("_p", p).select("*", F.col("_p.pit_stops").alias("pit_laps_parsed"),
                                         F.col("_p.compounds").alias("compounds_parsed"),
                                         F.col("_p.type").alias("plan_type_parsed")).drop("_p")


# S11 ------------------------------------------------------------------------
def append_metric_rows(metrics: DataFrame, path: str) -> None:
    """Append (metric, value) rows of a frame, stamped with the time, without a detour."""
    metrics.withColumn("run_ts", F.current_timestamp()).write.mode("append").parquet(path)


def append_run_metrics(spark: SparkSession, metrics: Mapping[str, float], path: str) -> DataFrame:
    """Append one timestamped (run_ts, metric, value) row per metric; returns the rows."""
    rows = [(k, float(v) if v is not None else None) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "metric string, value double").withColumn("run_ts", F.current_timestamp())
    df.write.mode("append").parquet(path)
    return df

