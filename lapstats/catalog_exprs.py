"""Registered queries for the scalar operators (F1-F15, F22, F23) and dimension joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import dims
from . import testview as tv
from .catalog import _round, laps, query, valid
from .functions import exprs as X
from .operators import enrich
from .oracle_sql import L, SQL, RATE, VALID, w

STATES = lambda spark, sf: tv.states(laps(spark, sf))
ST = w(tv.LAPS_CTE, tv.STATES_CTE)


@query
def q_parse_lap_time(spark, sf):
    r = tv.raw_text_laps(laps(spark, sf))
    return _round(r.select("lap_id", "lap_text", X.parse_lap_time("lap_text").alias("lap_seconds")),
                  ["lap_seconds"]).withColumn("is_valid", F.col("lap_seconds").isNotNull())


SQL["parse_lap_time"] = w(tv.LAPS_CTE, tv.RAW_TEXT_CTE) + """select lap_id, lap_text, lap_seconds,
 lap_seconds is not null as is_valid from (select lap_id, lap_text, round(case when contains(lap_text, ':')
 then case when len(string_split(lap_text, ':')) = 2 then try_cast(split_part(lap_text, ':', 1) as double) * 60
 + try_cast(split_part(lap_text, ':', 2) as double) end else try_cast(trim(lap_text) as double) end, 6)
 as lap_seconds from raw_text_laps)"""


@query
def q_format_lap_time(spark, sf):
    return laps(spark, sf).select("lap_id", X.format_lap_time("lap_time").alias("lap_text"))


SQL["format_lap_time"] = L + """select lap_id, printf('%d:%06.3f', cast(floor(lap_time / 60) as int),
 lap_time % 60) as lap_text from laps"""


@query
def q_format_time_delta(spark, sf):
    l = laps(spark, sf)
    return l.select("lap_id", X.format_time_delta(F.col("lap_time") * F.col("lap_number")).alias("elapsed_text"),
                    X.format_time_delta(F.col("lap_time") - 90.0).alias("delta_text"))


FTD = """case when {s} is null then null when {s} = 0 then '0.00s' when {s} < 60 then printf('%.2fs', {s})
 when {s} < 3600 then printf('%dm %.2fs', cast(floor({s} / 60) as int), {s} % 60)
 else printf('%dh %dm %.2fs', cast(floor({s} / 3600) as int), cast(floor(({s} % 3600) / 60) as int), {s} % 60) end"""
SQL["format_time_delta"] = L + "select lap_id, " + FTD.format(s="(lap_time * lap_number)") + \
    " as elapsed_text, " + FTD.format(s="(lap_time - 90.0)") + " as delta_text from laps"

NAME_SUFFIXES = [" ver", "-ham", "", " o'neil-rus", " lec", " x", "  sai", "", " nor", " pia alo", " str", " per"]


@query
def q_clean_driver_name(spark, sf):
    c = tv.table(spark, sf, "customer").select("c_custkey", "c_name")
    suffix = F.element_at(F.array(*[F.lit(s) for s in NAME_SUFFIXES]), (F.col("c_custkey") % 12 + 1).cast("int"))
    raw = F.when(F.col("c_custkey") % 25 == 0, F.lit("")).otherwise(
        F.concat(F.lit("  "), F.lower("c_name"), suffix, F.lit(" ")))
    return c.select("c_custkey", raw.alias("raw_name")).select(
        "c_custkey", "raw_name", X.clean_driver_name("raw_name").alias("clean_name"))


_ab = " ".join(f"when ends_with(t, '{a}') then replace(t, '{a}', '{a.upper()}')" for a in dims.NAME_ABBREVIATIONS)
SQL["clean_driver_name"] = """with c as (select c_custkey, case when c_custkey % 25 = 0 then '' else
 '  ' || lower(c_name) || (""" + "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in NAME_SUFFIXES) + \
    """])[c_custkey % 12 + 1] || ' ' end as raw_name from customer),
s as (select c_custkey, raw_name, regexp_replace(raw_name, '^\\s+|\\s+$', '', 'g') as st from c),
t as (select c_custkey, raw_name, array_to_string(list_transform(string_split(st, ''), lambda ch, i:
 case when i = 1 or not regexp_matches(string_split(st, '')[i - 1], '^\\p{L}$') then upper(ch) else lower(ch) end),
 '') as t from s)
select c_custkey, raw_name, case when raw_name is null or raw_name = '' then 'Unknown' else
 case """ + _ab + """ else t end end as clean_name from t"""

CODES = ["max", "PER", "ham", "Rus", "lec", "SAI", "nor", "pia", "ALO", "str", "XYZ", "d1"]


@query
def q_driver_full_name(spark, sf):
    d = laps(spark, sf).select("driver").distinct()
    num = F.substring("driver", 2, 20).cast("bigint")
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (num % 12 + 1).cast("int"))
    return d.select("driver", code.alias("code")).select("driver", "code", X.driver_full_name("code").alias("full_name"))


SQL["driver_full_name"] = L + """, d as (select driver, ([""" + ", ".join(f"'{c}'" for c in CODES) + \
    """])[cast(substr(driver, 2) as bigint) % 12 + 1] as code from (select distinct driver from laps))
select driver, code, coalesce(case upper(code) """ + " ".join(
        f"when '{k}' then '{v}'" for k, v in dims.DRIVER_NAMES.items()) + """ end, code) as full_name from d"""


@query
def q_time_gap(spark, sf):
    return laps(spark, sf).select("lap_id", X.time_gap("lap_time", F.lit(90.0), F.col("lap_number")).alias("time_gap"))


SQL["time_gap"] = L + "select lap_id, (lap_time - 90.0::double) * lap_number as time_gap from laps"


@query
def q_fuel_adjusted_lap_time(spark, sf):
    f = tv.fuel(spark, sf)
    return _round(f.select("id", X.fuel_adjusted_lap_time("base", "fuel_kg").alias("fuel_adjusted_lap_time")),
                  ["fuel_adjusted_lap_time"])


SQL["fuel_adjusted_lap_time"] = w(tv.FUEL_CTE) + \
    "select id, round(base + fuel_kg * 0.03::double, 6) as fuel_adjusted_lap_time from fuel"


@query
def q_track_position_value(spark, sf):
    return laps(spark, sf).select("lap_id", X.track_position_value("position").alias("track_position_value"))


SQL["track_position_value"] = L + \
    "select lap_id, greatest(0.0::double, (20 - position + 1) / 20) as track_position_value from laps"


@query
def q_overtaking_difficulty(spark, sf):
    c = laps(spark, sf).select("circuit").distinct()
    return c.select("circuit", X.overtaking_difficulty("circuit").alias("overtaking_difficulty"))


SQL["overtaking_difficulty"] = L + """select circuit, cast(case circuit when 'monaco' then 5 when 'silverstone'
 then 2 when 'monza' then 1 when 'spa' then 2 when 'suzuka' then 3 else 3 end as double) as overtaking_difficulty
 from (select distinct circuit from laps)"""


@query
def q_safety_car_probability(spark, sf):
    s = STATES(spark, sf)
    return _round(s.select("state_id", X.safety_car_probability("current_lap", "total_laps", "circuit")
                           .alias("safety_car_probability")), ["safety_car_probability"])


SQL["safety_car_probability"] = ST + """, b as (select state_id, current_lap::double / total_laps as prog,
 case circuit when 'monaco' then 0.4 when 'silverstone' then 0.2 when 'monza' then 0.15 when 'spa' then 0.25
 when 'suzuka' then 0.2 else 0.2 end::double as base from states)
select state_id, round(least(1.0::double, case when prog > 0.8 then base * 1.5 when prog < 0.2 then base * 0.7
 else base end), 6) as safety_car_probability from b"""


@query
def q_championship_impact(spark, sf):
    return laps(spark, sf).select("lap_id", X.championship_impact(F.lit(10.0) - F.col("position"))
                                  .alias("points_change"))


SQL["championship_impact"] = L + "select lap_id, cast(trunc((10.0 - position) * 2.0) as int) as points_change from laps"


def _state_compounds(spark, sf):
    s = STATES(spark, sf)
    comp = F.explode(F.array(*[F.lit(c) for c in dims.COMPOUNDS])).alias("new_compound")
    return s.select("*", comp).where(F.col("new_compound") != F.col("current_tire_compound"))


SC = ST + """, sc as (select s.*, c.new_compound from states s, (values ('SOFT'), ('MEDIUM'), ('HARD'))
 c(new_compound) where c.new_compound <> s.current_tire_compound)"""


@query
def q_tire_advantage(spark, sf):
    s = _state_compounds(spark, sf)
    return _round(s.select("state_id", "new_compound", X.tire_advantage(
        "current_tire_compound", "new_compound", F.col("total_laps") - F.col("current_lap")).alias("tire_advantage")),
        ["tire_advantage"])


SQL["tire_advantage"] = SC + """select state_id, new_compound, round((total_laps - current_lap) / 2 *
 coalesce(""" + RATE.format(c="current_tire_compound") + """, 0.25) - (total_laps - current_lap) / 2 *
 coalesce(""" + RATE.format(c="new_compound") + """, 0.25), 6) as tire_advantage from sc"""


@query
def q_stint_band(spark, sf):
    c = valid(spark, sf).select("tire_compound").distinct()
    r = X.degradation_rate("tire_compound")
    return c.select("tire_compound", F.concat(X.fixed(r, 2), F.lit(" s/lap")).alias("degradation_rate"),
                    X.performance_at(r, F.lit(10)).alias("performance_at_10"),
                    X.performance_at(r, F.lit(20)).alias("performance_at_20"),
                    X.stint_band(r).alias("optimal_stint"),
                    F.lit(f"{dims.MAX_STINT_LENGTH} laps").alias("max_recommended"))


SQL["stint_band"] = w(tv.LAPS_CTE, VALID) + """, r as (select tire_compound, """ + RATE.format(c="tire_compound") + \
    """ as rate from (select distinct tire_compound from valid))
select tire_compound, printf('%.2f s/lap', rate) as degradation_rate, printf('%.1fs', 90.0::double + 10 * rate)
 as performance_at_10, printf('%.1fs', 90.0::double + 20 * rate) as performance_at_20,
 case when rate <= 0.2 then '25-30 laps' when rate <= 0.3 then '15-25 laps' else '10-15 laps' end as optimal_stint,
 '50 laps' as max_recommended from r"""


@query
def q_window_confidence(spark, sf):
    s = _state_compounds(spark, sf)
    return _round(s.select("state_id", "new_compound", X.window_confidence(
        "new_compound", "current_lap", "total_laps", "current_position").alias("confidence")), ["confidence"])


SQL["window_confidence"] = SC + """select state_id, new_compound, round(greatest(0.0::double, least(1.0::double,
 0.8::double + case when new_compound = 'MEDIUM' then 0.1::double when new_compound = 'SOFT'
 and total_laps - current_lap < 15 then 0.1::double else 0.0::double end
 - case when current_position <= 5 then 0.1::double else 0.0::double end
 - case when total_laps - current_lap < 10 then 0.2::double else 0.0::double end)), 6) as confidence from sc"""


@query
def q_static_position_loss(spark, sf):
    return STATES(spark, sf).select("state_id", X.static_position_loss().alias("track_position_loss"))


SQL["static_position_loss"] = ST + "select state_id, 25 as track_position_loss from states"


@query
def q_pit_traffic_loss(spark, sf):
    return STATES(spark, sf).select("state_id", X.pit_traffic_loss(F.lit(dims.PIT_STOP_PENALTY),
                                                                   "current_position").alias("positions_lost"))


SQL["pit_traffic_loss"] = ST + """select state_id, least(5, case when current_position <= 5 then 3 + 1
 when current_position >= 15 then greatest(1, 3 - 1) else 3 end) as positions_lost from states"""


@query
def q_baseline_lap_time(spark, sf):
    s = STATES(spark, sf)
    return _round(s.select("state_id", X.baseline_lap_time("circuit", "current_tire_compound", "current_tire_age")
                           .alias("baseline_lap_time")), ["baseline_lap_time"])


BASE = """(case {c} when 'silverstone' then 88.0 when 'monaco' then 72.0 when 'spa' then 105.0 when 'monza' then 81.0
 when 'suzuka' then 90.0 when 'interlagos' then 70.0 when 'barcelona' then 78.0 else 88.0 end)::double"""
MOD = """(case {c} when 'SOFT' then -0.8 when 'HARD' then 0.6 else 0.0 end)::double"""
RATE2 = """(case {c} when 'SOFT' then 0.025 when 'HARD' then 0.010 else 0.018 end)::double"""
SQL["baseline_lap_time"] = ST + "select state_id, round(" + BASE.format(c="circuit") + " + " + \
    MOD.format(c="current_tire_compound") + " + current_tire_age * " + RATE2.format(c="current_tire_compound") + \
    ", 6) as baseline_lap_time from states"


@query
def q_enrich_dims(spark, sf):
    l = laps(spark, sf).select("lap_id", "circuit", "driver", F.col("compound").alias("tire_compound"))
    return _round(enrich.enrich_dims(l), ["degradation_rate", "safety_car_base", "baseline_lap_time"])


SQL["enrich_dims"] = L + """, d as (select lap_id, circuit, driver, compound as tire_compound from laps)
select lap_id, circuit, driver, tire_compound, round(""" + RATE.format(c="tire_compound") + """, 6) as degradation_rate,
 cast(case circuit when 'monaco' then 5 when 'silverstone' then 2 when 'monza' then 1 when 'spa' then 2
   when 'suzuka' then 3 else 3 end as double) as overtaking_difficulty,
 cast(case circuit when 'monaco' then 2 when 'silverstone' then 4 when 'monza' then 3 when 'spa' then 3
   when 'suzuka' then 4 else 3 end as double) as tire_wear,
 round(""" + BASE.format(c="circuit") + """, 6) as baseline_lap_time,
 round((case circuit when 'monaco' then 0.4 when 'silverstone' then 0.2 when 'monza' then 0.15 when 'spa' then 0.25
   when 'suzuka' then 0.2 else 0.2 end)::double, 6) as safety_car_base,
 case circuit when 'monaco' then 'Monaco Grand Prix' when 'silverstone' then 'British Grand Prix'
   when 'monza' then 'Italian Grand Prix' when 'spa' then 'Belgian Grand Prix' when 'suzuka' then 'Japanese Grand Prix'
   end as circuit_name,
 coalesce(case upper(driver) """ + " ".join(f"when '{k}' then '{v}'" for k, v in dims.DRIVER_NAMES.items()) + \
    """ end, driver) as driver_name from d"""
