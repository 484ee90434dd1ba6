"""Adapter views that give the driver's generated tables the lap-data shape.

``laps`` turns one user of ``events`` into one driver and each event into one lap
(definition fixed in FIXTURES.md §2.1). The other views are derived from it, or
from ``orders`` / ``lineitem``, so every operator can run on the given tables at
any scale factor. ``LAPS_CTE`` is the same definition as DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.ordering import row_index
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e = row_index(e, ["user_id"], ["ts", "event_id"], "_rn0").withColumn("rn", F.col("_rn0") + 1).drop("_rn0")
    sidx = F.expr("(rn - 1) div 12")
    long_run = (F.col("user_id") % 50) == 7
    mod4 = (F.col("user_id") + sidx) % 4
    eid = F.col("event_id")
    circuit = (F.when(F.col("user_id") % 6 == 0, "monaco").when(F.col("user_id") % 6 == 1, "silverstone")
               .when(F.col("user_id") % 6 == 2, "monza").when(F.col("user_id") % 6 == 3, "spa")
               .when(F.col("user_id") % 6 == 4, "suzuka").otherwise("bahrain"))
    return e.select(
        eid.alias("lap_id"),
        (F.lit(2021) + F.col("user_id") % 4).cast("int").alias("year"),
        circuit.alias("circuit"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("driver"),
        F.col("rn").cast("int").alias("lap_number"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
         .when(eid % 89 == 0, F.lit(40.0) + F.col("value") / 50)
         .otherwise(F.lit(70.0) + F.col("value") / 4).alias("lap_time"),
        F.when(long_run, "HARD").when(mod4 == 0, "SOFT").when(mod4 == 1, "MEDIUM")
         .when(mod4 == 2, "HARD").otherwise("INTERMEDIATE").alias("compound"),
        F.when(long_run, F.lit(1)).otherwise((sidx + 1).cast("int")).alias("stint"),
        F.when(long_run, F.col("rn").cast("int"))
         .otherwise(((F.col("rn") - 1) % 12 + 1).cast("int")).alias("tyre_life"),
        F.when(F.col("event_type") == "error", "4").otherwise("1").alias("track_status"),
        F.when(eid % 23 == 0, F.lit(None).cast("double"))
         .otherwise((eid % 20 + 1).cast("double")).alias("position"),
        F.when(eid % 31 == 0, F.lit(None).cast("double"))
         .otherwise((eid % 20).cast("double") * 0.5).alias("gap_to_leader"),
    )


def states(laps_df: DataFrame) -> DataFrame:
    """One race state per lap with a valid compound (FIXTURES.md §2.2)."""
    from .dims import COMPOUNDS
    total = laps_df.groupBy("year", "circuit").agg(
        F.max("lap_number").alias("total_laps"), F.count_if(F.col("compound").isin(COMPOUNDS)).alias("_laps"))
    from .operators.ordering import split_join
    s = split_join(laps_df.where(F.col("compound").isin(COMPOUNDS)), total, ["year", "circuit"], "inner", rows="_laps")
    return s.select(
        F.col("lap_id").alias("state_id"), "year", "circuit", "driver",
        F.col("lap_number").alias("current_lap"), F.col("total_laps").cast("int").alias("total_laps"),
        F.coalesce(F.col("position"), F.lit(20.0)).cast("int").alias("current_position"),
        F.col("compound").alias("current_tire_compound"),
        F.col("tyre_life").alias("current_tire_age"),
    )


def races(laps_df: DataFrame) -> DataFrame:
    """One row per session with its length and mean lap time."""
    return laps_df.groupBy("year", "circuit").agg(
        F.max("lap_number").cast("int").alias("total_laps"),
        F.avg("lap_time").alias("base_lap_time"))


def incidents(laps_df: DataFrame) -> DataFrame:
    """One safety-car lap per session: half distance."""
    return (laps_df.groupBy("year", "circuit").agg(F.max("lap_number").alias("t"))
            .select("year", "circuit", F.expr("cast(t div 2 as int)").alias("sc_lap")))


def raw_text_laps(laps_df: DataFrame) -> DataFrame:
    """Lap times as text: ``m:ss.mmm``, every 7th as plain seconds, every 50th corrupted."""
    ms = F.floor(F.col("lap_time") * 1000).cast("bigint")
    mss = F.concat((ms / 60000).cast("bigint").cast("string"), F.lit(":"),
                   F.lpad(((ms % 60000) / 1000).cast("bigint").cast("string"), 2, "0"), F.lit("."),
                   F.lpad((ms % 1000).cast("string"), 3, "0"))
    secs = F.concat((ms / 1000).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((ms % 1000).cast("string"), 3, "0"))
    lid = F.col("lap_id")
    text = (F.when(lid % 100 == 0, F.lit("1:23:45.678")).when(lid % 50 == 0, F.lit("n/a"))
            .when(lid % 7 == 0, secs).otherwise(mss))
    return laps_df.select("lap_id", text.alias("lap_text"))


def fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 5000.0).alias("fuel_kg"),
                    (F.lit(70.0) + (F.col("o_orderkey") % 30).cast("double")).alias("base"))


def big(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity",
                                                   "l_extendedprice", "l_discount")


# DuckDB twin of ``laps`` (FIXTURES.md §2.1), inlined as a CTE by every oracle query.
LAPS_CTE = """laps as (
with e as (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events),
s as (select *, cast(floor((rn - 1) / 12.0) as bigint) as sidx, user_id % 50 = 7 as long_run from e)
select event_id as lap_id,
 cast(2021 + user_id % 4 as int) as year,
 case user_id % 6 when 0 then 'monaco' when 1 then 'silverstone' when 2 then 'monza'
   when 3 then 'spa' when 4 then 'suzuka' else 'bahrain' end as circuit,
 concat('D', cast(user_id as varchar(20))) as driver,
 cast(rn as int) as lap_number,
 case when event_id % 97 = 0 then cast(null as double)
      when event_id % 89 = 0 then cast(40 as double) + value / 50
      else cast(70 as double) + value / 4 end as lap_time,
 case when long_run then 'HARD'
      when (user_id + sidx) % 4 = 0 then 'SOFT'
      when (user_id + sidx) % 4 = 1 then 'MEDIUM'
      when (user_id + sidx) % 4 = 2 then 'HARD' else 'INTERMEDIATE' end as compound,
 case when long_run then 1 else cast(sidx + 1 as int) end as stint,
 case when long_run then cast(rn as int) else cast((rn - 1) % 12 + 1 as int) end as tyre_life,
 case when event_type = 'error' then '4' else '1' end as track_status,
 case when event_id % 23 = 0 then cast(null as double) else cast(1 + event_id % 20 as double) end as position,
 case when event_id % 31 = 0 then cast(null as double)
      else (event_id % 20) * cast(0.5 as double) end as gap_to_leader
from s)"""

STATES_CTE = """total as (select year, circuit, max(lap_number) as total_laps from laps group by 1, 2),
states as (
select l.lap_id as state_id, l.year, l.circuit, l.driver, l.lap_number as current_lap,
 cast(t.total_laps as int) as total_laps,
 cast(coalesce(l.position, 20.0) as int) as current_position,
 l.compound as current_tire_compound, l.tyre_life as current_tire_age
from laps l join total t on l.year = t.year and l.circuit = t.circuit
where l.compound in ('SOFT', 'MEDIUM', 'HARD'))"""

RACES_CTE = """races as (select year, circuit, cast(max(lap_number) as int) as total_laps,
 avg(lap_time) as base_lap_time from laps group by 1, 2)"""

INCIDENTS_CTE = """incidents as (select year, circuit, cast(max(lap_number) // 2 as int) as sc_lap
 from laps group by 1, 2)"""

RAW_TEXT_CTE = """raw_text_laps as (
select lap_id,
 case when lap_id % 100 = 0 then '1:23:45.678' when lap_id % 50 = 0 then 'n/a'
      when lap_id % 7 = 0 then cast(ms // 1000 as varchar) || '.' || lpad(cast(ms % 1000 as varchar), 3, '0')
      else cast(ms // 60000 as varchar) || ':' || lpad(cast((ms % 60000) // 1000 as varchar), 2, '0')
           || '.' || lpad(cast(ms % 1000 as varchar), 3, '0') end as lap_text
from (select lap_id, cast(floor(lap_time * 1000) as bigint) as ms from laps))"""

FUEL_CTE = """fuel as (select o_orderkey as id, o_totalprice / 5000.0 as fuel_kg,
 70.0 + cast(o_orderkey % 30 as double) as base from orders)"""
