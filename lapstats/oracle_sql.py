"""DuckDB twins of the registered queries (the correctness oracle).

Only the raw tables are registered on the DuckDB side, so each statement inlines the
adapter views as CTEs. These strings are written independently of the Spark code.
"""

from __future__ import annotations

from .testview import LAPS_CTE

PITS = """pits as (
select year, circuit, driver, cast(pit_lap as int) as pit_lap, cast(25.0 as double) as pit_time,
 tire_compound_out, tire_compound_in
from (select year, circuit, driver, lap_number as pit_lap, compound as tire_compound_in,
        lag(compound) over w as tire_compound_out, lag(tyre_life) over w as pt,
        lag(lap_number) over w as ps, tyre_life as t
      from laps window w as (partition by year, circuit, driver order by lap_number, lap_id))
where ps is not null and (tire_compound_in is distinct from tire_compound_out or coalesce(t < pt, false)))"""

NORM = """norm as (select *, compound as tire_compound, tyre_life as tire_age from laps)"""

VALID = """v0 as (select *, compound as tire_compound, tyre_life as tire_age from laps
 where lap_time is not null and compound is not null and tyre_life is not null and driver is not null
   and lap_time between 60 and 180 and tyre_life <= 50),
vq as (select quantile_cont(lap_time, 0.25) as q1, quantile_cont(lap_time, 0.75) as q3 from v0),
valid as (select v0.* from v0, vq
 where lap_time between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
   and tire_compound in ('SOFT', 'MEDIUM', 'HARD'))"""

RATE = ("cast(case {c} when 'SOFT' then 0.35 when 'MEDIUM' then 0.25 "
        "when 'HARD' then 0.15 end as double)")

FEAT = """b0 as (select *, compound as tire_compound, tyre_life as tire_age from laps
 where lap_time between 60 and 180 and compound is not null and tyre_life is not null
   and track_status = '1'),
b1 as (select * replace (coalesce(position, 20.0) as position),
 """ + RATE.format(c="tire_compound") + """ as tire_degradation_rate from b0),
gm as (select quantile_cont(gap_to_leader, 0.5) as m from b1),
b2 as (select * replace (coalesce(gap_to_leader, (select m from gm)) as gap_to_leader),
 tire_age * tire_degradation_rate as predicted_degradation,
 max(tire_age) over (partition by year, circuit, driver, tire_compound) as stint_length,
 coalesce(position - lag(position) over w, 0.0) as position_change,
 avg(lap_time) over (w rows between 2 preceding and current row) as rolling_avg_lap_time_3,
 avg(lap_time) over (w rows between 4 preceding and current row) as rolling_avg_lap_time_5,
 lap_time / avg(lap_time) over (partition by year, circuit, lap_number) as relative_performance,
 cast(coalesce(lap_number - (select max(p.pit_lap) from pits p where p.year = b1.year
   and p.circuit = b1.circuit and p.driver = b1.driver and p.pit_lap <= b1.lap_number), 0) as int)
   as laps_since_pit,
 cast(case circuit when 'monaco' then 5 when 'silverstone' then 2 when 'monza' then 1 when 'spa' then 2
   when 'suzuka' then 3 else 3 end as double) as overtaking_difficulty,
 cast(case circuit when 'monaco' then 2 when 'silverstone' then 4 when 'monza' then 3 when 'spa' then 3
   when 'suzuka' then 4 else 3 end as double) as tire_wear,
 cast(dense_rank() over (order by circuit) - 1 as int) as circuit_encoded,
 cast(dense_rank() over (order by driver) - 1 as int) as driver_encoded,
 cast(dense_rank() over (order by tire_compound) - 1 as int) as tire_compound_encoded,
 cast(tire_compound = 'SOFT' as int) as compound_SOFT,
 cast(tire_compound = 'MEDIUM' as int) as compound_MEDIUM,
 cast(tire_compound = 'HARD' as int) as compound_HARD
 from b1 window w as (partition by year, circuit, driver order by lap_number, lap_id)),
feat as (select * from b2 where tire_age is not null and tire_compound_encoded is not null
 and circuit_encoded is not null and driver_encoded is not null and lap_number is not null
 and position is not null and gap_to_leader is not null and tire_degradation_rate is not null
 and stint_length is not null and laps_since_pit is not null and rolling_avg_lap_time_3 is not null
 and rolling_avg_lap_time_5 is not null and position_change is not null
 and relative_performance is not null and lap_time is not null)"""

FEAT_NAMES = ["lap_id", "year", "circuit", "driver", "lap_number", "lap_time", "compound", "stint",
              "tyre_life", "track_status", "position", "gap_to_leader", "tire_compound", "tire_age",
              "tire_degradation_rate", "predicted_degradation", "stint_length", "position_change",
              "rolling_avg_lap_time_3", "rolling_avg_lap_time_5", "relative_performance", "laps_since_pit",
              "overtaking_difficulty", "tire_wear", "circuit_encoded", "driver_encoded",
              "tire_compound_encoded", "compound_SOFT", "compound_MEDIUM", "compound_HARD"]
FEAT_ROUNDED = ["gap_to_leader", "rolling_avg_lap_time_3", "rolling_avg_lap_time_5", "relative_performance"]
FEAT_COLS = ", ".join(f"round({c}, 6) as {c}" if c in FEAT_ROUNDED else c for c in FEAT_NAMES)

SPLIT = """select lap_id, split_rank, split_rank >= n - t as is_test from (
 select lap_id, cast(row_number() over (order by year, circuit, lap_number, driver, lap_id) - 1 as bigint)
   as split_rank, count(*) over () as n,
   case when floor(count(*) over () * 0.2) = 0 then 1 else cast(floor(count(*) over () * 0.2) as bigint) end as t
 from {src})"""


def w(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


L = w(LAPS_CTE)
SQL: dict[str, str] = {}

# --- P: cleaning -------------------------------------------------------------
SQL["require_columns"] = L + """select count(*) > 0 as non_empty,
 'LapTime,Compound,Driver,LapNumber' as missing_raw, '' as missing_processed from laps"""
SQL["normalise_columns"] = w(LAPS_CTE, NORM) + "select * from norm"
SQL["drop_missing_critical"] = w(LAPS_CTE, NORM) + """select * from norm where lap_time is not null
 and tire_compound is not null and tire_age is not null and driver is not null"""
SQL["filter_lap_time_range"] = L + "select * from laps where lap_time between 60 and 180"
SQL["filter_max_stint"] = w(LAPS_CTE, NORM) + "select * from norm where tire_age <= 50"
SQL["filter_valid_compound"] = w(LAPS_CTE, NORM) + \
    "select * from norm where tire_compound in ('SOFT', 'MEDIUM', 'HARD')"
SQL["remove_invalid_laps"] = L + """select * from laps where lap_time between 60 and 180
 and compound is not null and tyre_life is not null and track_status = '1'"""
SQL["validity_flags"] = L + """select *,
 coalesce(lap_time between 60 and 180, false) as lap_time_valid,
 coalesce(compound in ('SOFT', 'MEDIUM', 'HARD'), false) as compound_valid,
 coalesce(circuit in ('monaco', 'silverstone', 'monza', 'spa', 'suzuka'), false) as circuit_valid,
 coalesce(tyre_life between 1 and 50, false) as stint_valid from laps"""
SQL["interval_to_seconds"] = L + """select lap_id,
 cast(cast(lap_time as decimal(18,6)) as double) as lap_seconds from laps"""
SQL["default_position_gap"] = L + """select lap_id, coalesce(position, 20.0) as position,
 round(coalesce(gap_to_leader, (select quantile_cont(gap_to_leader, 0.5) from laps)), 6) as gap_to_leader
 from laps"""
SQL["predicted_degradation"] = w(LAPS_CTE, NORM) + "select lap_id, tire_compound, tire_age, " + \
    RATE.format(c="tire_compound") + " as tire_degradation_rate, tire_age * " + \
    RATE.format(c="tire_compound") + " as predicted_degradation from norm"
SQL["one_hot_compound"] = w(LAPS_CTE, NORM) + """select lap_id, tire_compound,
 cast(tire_compound = 'SOFT' as int) as compound_SOFT, cast(tire_compound = 'MEDIUM' as int) as compound_MEDIUM,
 cast(tire_compound = 'HARD' as int) as compound_HARD from norm"""
SQL["slice_laps"] = L + "select * from laps where year in (2022, 2023) and circuit in ('monza', 'spa')"
SQL["iqr_filter"] = L + """, q as (select quantile_cont(lap_time, 0.25) as q1, quantile_cont(lap_time, 0.75) as q3
 from laps) select laps.* from laps, q where lap_time between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"""
SQL["iqr_bounds_by_circuit"] = L + """select circuit, round(q1, 6) as q1, round(q3, 6) as q3,
 round(q1 - 1.5 * (q3 - q1), 6) as lower_bound, round(q3 + 1.5 * (q3 - q1), 6) as upper_bound
 from (select circuit, quantile_cont(lap_time, 0.25) as q1, quantile_cont(lap_time, 0.75) as q3
       from laps where lap_time is not null group by circuit)"""
SQL["validate_laps"] = w(LAPS_CTE, VALID) + "select * from valid"
SQL["validation_counts"] = w(LAPS_CTE, NORM, VALID) + """select count(*) as input_rows,
 count(*) filter (where lap_time is not null and tire_compound is not null and tire_age is not null
   and driver is not null) as after_missing,
 count(*) filter (where lap_time is not null and tire_compound is not null and tire_age is not null
   and driver is not null and lap_time between 60 and 180) as after_range,
 count(*) filter (where lap_time is not null and tire_compound is not null and tire_age is not null
   and driver is not null and lap_time between 60 and 180 and tire_age <= 50) as after_stint,
 (select count(*) from v0, vq where lap_time between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as after_iqr,
 (select count(*) from valid) as after_compound from norm"""
SQL["select_features"] = w(LAPS_CTE, PITS, FEAT) + """select lap_id, tire_age, tire_compound_encoded,
 circuit_encoded, driver_encoded, lap_number, position, round(gap_to_leader, 6) as gap_to_leader,
 tire_degradation_rate, stint_length, laps_since_pit, round(rolling_avg_lap_time_3, 6) as rolling_avg_lap_time_3,
 round(rolling_avg_lap_time_5, 6) as rolling_avg_lap_time_5, position_change,
 round(relative_performance, 6) as relative_performance, lap_time from feat"""
NO_PITS = """pits as (select 0 as year, '' as circuit, '' as driver, 0 as pit_lap where false)"""
SQL["process_laps"] = w(LAPS_CTE, NO_PITS, FEAT) + "select " + ", ".join(
    f"round(f.{c}, 6) as {c}" if c in FEAT_ROUNDED else f"f.{c}" for c in FEAT_NAMES
) + ", s.split_rank, s.is_test from feat f join (" + SPLIT.format(src="feat") + ") s on f.lap_id = s.lap_id"

# --- W / J: panel ------------------------------------------------------------
SQL["detect_pit_stops"] = w(LAPS_CTE, PITS) + "select * from pits"
SQL["position_change"] = L + """select lap_id, coalesce(position, 20.0) as position,
 coalesce(coalesce(position, 20.0) - lag(coalesce(position, 20.0)) over
   (partition by year, circuit, driver order by lap_number, lap_id), 0.0) as position_change from laps"""
SQL["rolling_mean_lap_time"] = L + """select lap_id,
 round(avg(lap_time) over (w rows between 2 preceding and current row), 6) as rolling_avg_lap_time_3,
 round(avg(lap_time) over (w rows between 4 preceding and current row), 6) as rolling_avg_lap_time_5,
 round(avg(lap_time) over (w rows between 3 preceding and 1 preceding), 6) as prior_avg_lap_time_3
 from laps window w as (partition by year, circuit, driver order by lap_number, lap_id)"""
SQL["stint_length"] = w(LAPS_CTE, NORM) + """select lap_id,
 max(tire_age) over (partition by year, circuit, driver, tire_compound) as stint_length from norm"""
SQL["relative_performance"] = L + """select lap_id,
 round(lap_time / avg(lap_time) over (partition by year, circuit, lap_number), 6) as relative_performance
 from laps"""
SQL["laps_since_pit"] = w(LAPS_CTE, PITS) + """select l.lap_id,
 cast(coalesce(l.lap_number - (select max(p.pit_lap) from pits p where p.year = l.year
   and p.circuit = l.circuit and p.driver = l.driver and p.pit_lap <= l.lap_number), 0) as int)
   as laps_since_pit from laps l"""
SQL["label_encode"] = L + """select 'driver' as column_name, value, cast(row_number() over
 (order by value) - 1 as int) as code from (select distinct driver as value from laps)
 union all select 'circuit', value, cast(row_number() over (order by value) - 1 as int)
 from (select distinct circuit as value from laps)
 union all select 'compound', value, cast(row_number() over (order by value) - 1 as int)
 from (select distinct compound as value from laps)"""
_EXT = """select '{c}' as column_name, value, cast(row_number() over (order by late, value) - 1 as int) as code from
 (select {c} as value, cast(min(cast(year >= 2023 as int)) as int) as late from laps where {c} is not null group by 1)"""
SQL["label_encode_extended"] = L + _EXT.format(c="driver") + " union all " + _EXT.format(c="compound")
SQL["chronological_split"] = w(LAPS_CTE, VALID) + SPLIT.format(src="valid")
SQL["engineer_features"] = w(LAPS_CTE, PITS, FEAT) + "select " + FEAT_COLS + " from feat"

# --- A / T / U: aggregates ---------------------------------------------------
SQL["yearly_mean_lap_time"] = w(LAPS_CTE, VALID) + """select circuit, year,
 round(avg(lap_time), 6) as mean_lap_time from valid group by circuit, year"""
SQL["compound_usage"] = w(LAPS_CTE, VALID) + """select year, tire_compound, count(*) as laps
 from valid group by year, tire_compound"""
SQL["compound_performance"] = w(LAPS_CTE, VALID) + """select tire_compound,
 round(avg(lap_time), 3) as mean_lap_time, round(stddev_samp(lap_time), 3) as std_lap_time,
 round(avg(tire_age), 3) as mean_tire_age, count(*) as laps from valid group by tire_compound"""
SQL["pit_lap_histogram"] = w(LAPS_CTE, PITS) + """, mm as (select cast(min(pit_lap) as double) as lo,
 cast(max(pit_lap) as double) as hi from pits)
select bin, count(*) as count, round(first(lo) + bin * (first(hi) - first(lo)) / 20, 6) as bin_start,
 round(first(lo) + (bin + 1) * (first(hi) - first(lo)) / 20, 6) as bin_end
from (select cast(case when (hi - lo) / 20 = 0 then 0 else least(floor((pit_lap - lo) / ((hi - lo) / 20)), 19) end
   as int) as bin, lo, hi from pits, mm where pit_lap is not null) group by bin"""
SQL["common_tyre_changes"] = w(LAPS_CTE, PITS) + """select tire_compound_out, tire_compound_in,
 count(*) as changes from pits group by 1, 2 order by changes desc, tire_compound_out nulls first,
 tire_compound_in nulls first limit 10"""
SQL["top_tyre_changes"] = w(LAPS_CTE, PITS) + """select tire_compound_out, tire_compound_in,
 count(*) as changes from pits group by 1, 2 order by changes desc, tire_compound_out nulls first,
 tire_compound_in nulls first limit 10"""
SQL["historical_performance"] = L + """, per as (select circuit, compound, round(avg(lap_time), 6) as average_lap_time,
 count(*) as compound_laps from laps group by 1, 2),
tot as (select circuit, count(*) as data_points from laps group by 1)
select per.circuit, compound, average_lap_time, compound_laps, data_points,
 """ + RATE.format(c="compound") + """ as degradation_rate, '15,25,35' as typical_pit_windows,
 0.3::double as safety_car_frequency from per join tot on per.circuit = tot.circuit"""
SQL["stint_performance"] = L + """select year, circuit, driver, stint,
 round(avg(lap_time), 6) as average_lap_time, min(lap_time) as fastest_lap, max(lap_time) as slowest_lap,
 round(coalesce(case when var_pop(tyre_life) > 0 then regr_slope(lap_time, tyre_life) end, 0.0), 6)
   as degradation_rate,
 round(stddev_pop(lap_time), 6) as consistency, count(*) as stint_length
 from laps where lap_time is not null and tyre_life is not null group by 1, 2, 3, 4"""
PSTATS = """select {by} min(x) as min, round(quantile_cont(x, 0.25), 6) as q25,
 round(quantile_cont(x, 0.5), 6) as median, round(quantile_cont(x, 0.75), 6) as q75, max(x) as max,
 round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) as iqr, round(avg(x), 6) as mean,
 round(case when count(x) = 1 then 0.0 else stddev_samp(x) end, 6) as std, count(x) as n
 from (select {by} cast({col} as double) as x from {src} where {col} is not null) {grp}"""
SQL["percentile_stats"] = L + PSTATS.format(by="", col="lap_time", src="laps", grp="")
SQL["percentile_stats_by_circuit"] = L + PSTATS.format(by="circuit,", col="lap_time", src="laps",
                                                       grp="group by circuit")
SQL["percentile_stats_lineitem"] = "" + PSTATS.format(by="l_returnflag,", col="l_extendedprice",
                                                      src="lineitem", grp="group by l_returnflag")
SQL["processed_data_metrics"] = w(LAPS_CTE, PITS, FEAT) + """select count(*) as total_rows,
 14 as total_features, cast(0 as bigint) as missing_values, count(distinct driver) as unique_drivers,
 count(distinct circuit) as unique_circuits, cast(min(year) as varchar) || '-' || cast(max(year) as varchar)
 as year_range, printf('%.2f-%.2f', min(lap_time), max(lap_time)) as lap_time_range,
 array_to_string(list_sort(list_distinct(list(tire_compound))), ',') as tire_compounds,
 count(*) < 1000 as low_volume from feat"""
QCOLS = "year, circuit, compound, stint, tyre_life, track_status"
SQL["data_quality"] = L + f""", t as (select {QCOLS} from laps),
a as (select count(*) as total_rows, cast(count(*) filter (where year is null) + count(*) filter (where circuit is null)
 + count(*) filter (where compound is null) + count(*) filter (where stint is null)
 + count(*) filter (where tyre_life is null) + count(*) filter (where track_status is null) as bigint)
 as missing_values from t),
d as (select cast(coalesce(sum(c - 1), 0) as bigint) as duplicate_rows from
 (select count(*) as c from t group by year, circuit, compound, stint, tyre_life, track_status))
select total_rows, missing_values, duplicate_rows, 6 as total_columns,
 'year:int,circuit:string,compound:string,stint:int,tyre_life:int,track_status:string' as column_types,
 round(case when total_rows = 0 then 1.0 else greatest(0.0, 1 - 0.5 * missing_values / (total_rows * 6)
   - 0.3 * duplicate_rows / total_rows) end, 6) as quality_score from a, d"""
SQL["duplicate_rows"] = L + f"""select {QCOLS}, count(*) - 1 as extra_copies from laps
 group by all having count(*) > 1"""
LAP_COLS = ["lap_id", "year", "circuit", "driver", "lap_number", "lap_time", "compound", "stint",
            "tyre_life", "track_status", "position", "gap_to_leader"]
SQL["data_completeness"] = L + ", i as (select count(*) as r, " + ", ".join(
    f"count(*) - count({c}) as n_{c}" for c in LAP_COLS) + " from laps), u as (" + \
    " union all ".join(f"select '{c}' as column_name, n_{c} as m from i" for c in LAP_COLS) + \
    """), t as (select sum(m) as m, (select r from i) as r, count(*) as c from u),
allrows as (select column_name, m, m * 100.0 / (select r from t) as pct from u where m > 0
 union all select null, (select m from t), (select m * 100.0 / (r * c) from t))
select 'laps' as input, column_name, cast(m as bigint) as missing_count, round(pct, 6) as missing_percentage,
 round(1 - (select m / (r * c) from t), 6) as completeness_score, (select m = 0 and r > 0 from t) as is_valid from allrows
union all select 'clean', null, count(*) - count(lap_id) + count(*) - count(year), 0.0, 1.0, count(*) > 0 from laps
union all select 'empty', null, 0, 0.0, 0.0, false"""
SQL["data_summary"] = L + """select count(*) as rows, 12 as columns, min(lap_time) as min_lap_time,
 max(lap_time) as max_lap_time, min(year) as first_year, max(year) as last_year,
 count(distinct circuit) as circuits from laps"""
_BAD = "count(*) filter (where lap_time is null or lap_time < 60 or lap_time > 180 or {life} is null or {life} > 50)"
SQL["processed_data_valid"] = w(LAPS_CTE, VALID) + f"""select 'laps' as input, count(*) > 0 and
 {_BAD.format(life='tyre_life')} = 0 as is_valid, count(*) as rows from laps
union all select 'valid', count(*) > 0 and {_BAD.format(life='tyre_life')} = 0, count(*) from valid
union all select 'missing_life', count(*) > 0 and {_BAD.format(life='(case when lap_id % 41 = 0 then null else tyre_life end)')} = 0,
 count(*) from valid
union all select 'empty', false, 0"""
SQL["ingest_report"] = L + """, g as (select y.year, c.circuit from (values (2021), (2022), (2023), (2024)) y(year),
 (values ('monaco'), ('silverstone'), ('monza'), ('spa'), ('suzuka')) c(circuit)),
r as (select g.year, g.circuit, cast(coalesce(n.rows, 0) as bigint) as rows from g left join
 (select year, circuit, count(*) as rows from laps group by 1, 2) n on g.year = n.year and g.circuit = n.circuit)
select year, circuit, rows, rows > 0 as ok, (select count(*) filter (where rows > 0) from r) as ok_units,
 (select count(*) from r) as total_units from r"""
SQL["distinct_sorted"] = L + """select 'year' as picker, cast(year as varchar) as value from
 (select distinct year from laps) union all select 'circuit', circuit from (select distinct circuit from laps
 where year = 2022) union all select 'driver', driver from (select distinct driver from laps
 where year = 2022 and circuit = 'monza')"""
SQL["union_laps"] = L + """select year, circuit, driver, lap_number, lap_time, compound, null::varchar as session_type
 from laps where year = 2021 union all select year, circuit, driver, lap_number, lap_time, compound,
 'R' as session_type from laps where year <> 2021"""
SQL["sort_laps"] = L + "select * from laps order by year, circuit, driver, lap_number"
