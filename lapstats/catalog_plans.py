"""Registered queries for candidate plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import dims
from . import testview as tv
from .catalog import QUERIES, _round, laps, query
from .functions import exprs as X
from .oracle_sql import L, SQL, w
from .plans import race as R
from .plans import state as S

RACES = lambda spark, sf: tv.races(laps(spark, sf))
STATES = lambda spark, sf: tv.states(laps(spark, sf))


def _keystr(col):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ",")


# --- SQL building blocks -----------------------------------------------------
RC = w(tv.LAPS_CTE, tv.RACES_CTE)
OPTS = """so as (select year, circuit, total_laps, base_lap_time, p as l1, cast(null as bigint) as l2, k, 1 as stops
 from races, range(15, 35, 5) g(p), (values (0), (1)) pat(k) where p < least(total_laps - 10, 35)),
do_ as (select year, circuit, total_laps, base_lap_time, f as l1, f + 15 + 4 * j as l2, k, 2 as stops
 from races, range(12, 25, 4) a(f), range(0, 3) b(j), (values (0), (1)) pat(k)
 where f + 15 + 4 * j < least(total_laps - 8, f + 25)),
pl as (select *, case when stops = 1 then 'single_stop' else 'two_stop' end as plan_type,
 case k when 0 then 'SOFT' else 'MEDIUM' end as c1,
 case when stops = 1 then case k when 0 then 'MEDIUM' else 'HARD' end else case k when 0 then 'MEDIUM' else 'SOFT' end end as c2,
 case when stops = 2 then case k when 0 then 'HARD' else 'MEDIUM' end end as c3 from ({src})),
grid as (select *, cast(l1 as varchar) || coalesce(',' || cast(l2 as varchar), '') || '|' || c1 || ',' || c2
 || coalesce(',' || c3, '') as plan_key,
 cast(row_number() over (partition by year, circuit order by grp, l1, l2 nulls first, k) - 1 as int) as option_idx
 from pl)"""
GRID26 = OPTS.format(src="select *, 0 as grp from so union all select *, 1 from do_")
GRID34 = OPTS.format(src="select *, 0 as grp from so union all select *, 1 from so union all select *, 2 from do_")

RT = "coalesce(" + """cast(case {c} when 'SOFT' then 0.35 when 'MEDIUM' then 0.25 when 'HARD' then 0.15 end as double)""" \
    + ", 0.02::double)"


def _stints_sql(full: bool) -> str:
    """n1..n3, r1..r3 per grid plan (n as double, clipped at 0)."""
    d = 0 if full else 1
    return f"""st as (select *, coalesce(base_lap_time, 90.0::double) as b,
 greatest(l1 - 1 + {1 - d}, 0)::double as n1,
 greatest(case when stops = 1 then total_laps - (l1 + 1) + {1 - d} else l2 - (l1 + 1) + {1 - d} end, 0)::double as n2,
 case when stops = 2 then greatest(total_laps - (l2 + 1) + {1 - d}, 0)::double end as n3,
 case when stops = 1 then total_laps - (l1 + 1) else l2 - (l1 + 1) end as len2,
 case when stops = 2 then total_laps - (l2 + 1) end as len3,
 {RT.format(c='c1')} as r1, {RT.format(c='c2')} as r2, {RT.format(c='c3')} as r3 from grid),
ev as (select *, (0.0::double + (n1 * b + {deg('r1', 'n1', full)}) + (n2 * b + {deg('r2', 'n2', full)})
 + coalesce(n3 * b + {deg('r3', 'n3', full)}, 0.0)) + 25.0 * stops as total_race_time,
 0.0::double + {deg('r1', 'n1', full)} + {deg('r2', 'n2', full)} + coalesce({deg('r3', 'n3', full)}, 0.0)
   as tire_degradation_loss,
 0.0::double + case when l1 - 1 > 25 then 0.1 else 0.0 end + case when len2 > 25 then 0.1 else 0.0 end
 + coalesce(case when len3 > 25 then 0.1 else 0.0 end, 0.0) as track_position_risk from st)"""


def deg(r, n, full):
    return f"{r} * {n} * ({n} + 1) / 2" if full else f"{r} * {n} * ({n} - 1) / 2"


EVAL_COLS = """year, circuit, plan_key, plan_type, option_idx, round(total_race_time, 6) as total_race_time,
 round(total_race_time / total_laps, 6) as average_lap_time, round(tire_degradation_loss, 6) as tire_degradation_loss,
 25.0::double * stops as pit_stop_time_loss, 0.1::double as safety_car_risk, round(track_position_risk, 6) as track_position_risk,
 round(1000.0::double - total_race_time / 60, 6) as strategy_score"""


# --- G1 / U2 -----------------------------------------------------------------
@query
def q_plan_grid(spark, sf):
    g = R.plan_grid(RACES(spark, sf))
    return g.select("year", "circuit", "option_idx", "plan_key", "plan_type",
                    F.size("pit_laps").alias("stops"))


SQL["plan_grid"] = RC + ", " + GRID26 + " select year, circuit, option_idx, plan_key, plan_type, stops from grid"


@query
def q_distinct_plans(spark, sf):
    g = R.distinct_plans(R.plan_grid(RACES(spark, sf), repeat_singles=True))
    return g.select("year", "circuit", "option_idx", "plan_key")


SQL["distinct_plans"] = RC + ", " + GRID34 + """ select year, circuit, min(option_idx) as option_idx, plan_key
 from grid group by year, circuit, plan_key"""


# --- G2 ----------------------------------------------------------------------
def _eval_q(spark, sf, conv):
    e = R.evaluate_plans(R.plan_grid(RACES(spark, sf)), conv)
    cols = ["total_race_time", "average_lap_time", "tire_degradation_loss", "track_position_risk", "strategy_score"]
    return _round(e.select("year", "circuit", "plan_key", "plan_type", "option_idx", *cols, "pit_stop_time_loss",
                           "safety_car_risk"), cols)


@query
def q_evaluate_plans(spark, sf):
    return _eval_q(spark, sf, "full")


@query
def q_evaluate_plans_compat(spark, sf):
    return _eval_q(spark, sf, "compat")


SQL["evaluate_plans"] = RC + ", " + GRID26 + ", " + _stints_sql(True) + " select " + EVAL_COLS + " from ev"
SQL["evaluate_plans_compat"] = RC + ", " + GRID26 + ", " + _stints_sql(False) + " select " + EVAL_COLS + " from ev"


# --- G3 / T5 / F20 / F21 -----------------------------------------------------
@query
def q_optimize_plans(spark, sf):
    l = laps(spark, sf)
    o = R.optimize_plans(tv.races(l), history=l)
    return _round(o, ["total_race_time", "strategy_score", "confidence"])


SQL["optimize_plans"] = RC + ", " + GRID34 + ", " + _stints_sql(True) + """,
rk as (select *, row_number() over (partition by year, circuit order by round(1000.0::double - total_race_time / 60, 9)
 desc, option_idx) as rank, count(*) over (partition by year, circuit) as evaluated from ev),
h as (select circuit, count(*) as history_rows from laps group by circuit)
select rk.year, rk.circuit, cast(rank as int) as rank, rank = 1 as is_recommended, plan_key, plan_type, total_laps,
 round(total_race_time, 6) as total_race_time, round(1000.0::double - total_race_time / 60, 6) as strategy_score,
 round(greatest(0.0::double, least(1.0::double, 0.7::double - 0.1::double * 0.2 - track_position_risk * 0.15
   + least(0.1::double, coalesce(h.history_rows, 0) / 1000))), 6) as confidence,
 case plan_type when 'single_stop' then 'Single Stop' else 'Two Stop' end || ' strategy with ' || cast(stops as varchar)
   || ' pit stop(s)' as description, evaluated, 'medium' as overall_risk, 0.75::double as probability_of_success,
 '8-12' as position_range, 0.78::double as success_probability, false as weather_impact
from rk left join h on rk.circuit = h.circuit where rank <= 4"""


def _projection(parent: str, name: str, cols: list[str]) -> None:
    """Register ``name`` as the ``cols`` view of ``parent`` (its own check on those columns)."""
    base = QUERIES[parent]
    QUERIES[name] = lambda spark, sf: base(spark, sf).select(*cols)
    SQL[name] = f"select {', '.join(cols)} from ({SQL[parent]})"


_projection("optimize_plans", "rank_plans", ["year", "circuit", "rank", "plan_key", "strategy_score"])
_projection("optimize_plans", "evaluation_confidence", ["year", "circuit", "rank", "confidence"])
_projection("optimize_plans", "plan_score_text", ["year", "circuit", "rank", "strategy_score", "description"])


# --- G4 / A16 / G5 -----------------------------------------------------------
@query
def q_expand_plan_laps(spark, sf):
    e = R.expand_plan_laps(R.plan_grid(RACES(spark, sf)))
    return _round(e, ["lap_time"])


SQL["expand_plan_laps"] = RC + ", " + GRID26 + """,
x as (select g.*, s.lap as lap_number from grid g, generate_series(1, g.total_laps) s(lap)),
y as (select *, case when lap_number <= l1 then 1 when stops = 1 or lap_number <= l2 then 2 else 3 end as stint_number from x),
z as (select *, case stint_number when 1 then 1 when 2 then l1 + 1 else l2 + 1 end as start_lap,
 case stint_number when 1 then l1 when 2 then coalesce(l2, total_laps) else total_laps end as end_lap,
 case stint_number when 1 then c1 when 2 then c2 else c3 end as compound from y)
select year, circuit, plan_key, cast(lap_number as int) as lap_number, stint_number, compound,
 cast(lap_number - start_lap + 1 as int) as tire_age,
 round(coalesce(base_lap_time, 90.0::double) + (lap_number - start_lap + 1) * """ + RT.format(c="compound") + """, 6) as lap_time,
 case when lap_number = end_lap and end_lap < total_laps then 'Pit stop at lap ' || cast(lap_number as varchar) end as key_event
from z"""


@query
def q_stint_cost_summary(spark, sf):
    s = R.stint_cost_summary(R.plan_grid(RACES(spark, sf)))
    return _round(s, ["average_time", "plan_total_time"])


SQL["stint_cost_summary"] = RC + ", " + GRID26 + ", " + _stints_sql(True) + """,
u as (select year, circuit, plan_key, b, total_race_time, total_laps, 1 as stint_number, 1 as start_lap, l1 as end_lap, c1 as compound from ev
 union all select year, circuit, plan_key, b, total_race_time, total_laps, 2, l1 + 1, coalesce(l2, total_laps), c2 from ev
 union all select year, circuit, plan_key, b, total_race_time, total_laps, 3, l2 + 1, total_laps, c3 from ev where stops = 2)
select year, circuit, plan_key, stint_number, cast(start_lap as int) as start_lap, cast(end_lap as int) as end_lap,
 compound, cast(greatest(end_lap - start_lap + 1, 0) as int) as laps, cast(end_lap - start_lap as int) as stint_length,
 case when end_lap - start_lap + 1 > 0 then round(b + """ + RT.format(c="compound") + """ * (end_lap - start_lap + 1 + 1) / 2, 6) end as average_time,
 cast(greatest(end_lap - start_lap + 1, 0) as int) as degradation, round(total_race_time, 6) as plan_total_time from u"""


def _driver_stints(spark, sf):
    l = laps(spark, sf)
    return l.groupBy("year", "circuit", "driver", "stint").agg(
        F.min("lap_number").alias("start_lap"), F.max("lap_number").alias("end_lap"),
        F.min("compound").alias("compound"), F.min("tyre_life").alias("starting_tire_life"))


@query
def q_stint_cost(spark, sf):
    return _round(R.stint_cost(_driver_stints(spark, sf)), ["total_time", "average_lap_time"])


SQL["stint_cost"] = L + """, s as (select year, circuit, driver, stint, min(lap_number) as start_lap,
 max(lap_number) as end_lap, min(compound) as compound, min(tyre_life) as starting_tire_life from laps group by 1, 2, 3, 4),
c as (select *, greatest(end_lap - start_lap + 1, 0)::double as n, coalesce(starting_tire_life, 1) as a0,
 """ + RT.format(c="compound") + """ as r from s)
select year, circuit, driver, stint, start_lap, end_lap, compound, starting_tire_life,
 round(n * 85.0 + r * (n * a0 + n * (n - 1) / 2), 6) as total_time,
 case when n > 0 then round((n * 85.0 + r * (n * a0 + n * (n - 1) / 2)) / n, 6) end as average_lap_time,
 cast(n as int) as tire_degradation from c"""


# --- G8 ----------------------------------------------------------------------
@query
def q_compound_windows(spark, sf):
    return R.compound_windows(RACES(spark, sf))


SQL["compound_windows"] = RC + """, c as (select year, circuit, total_laps, compound,
 cast(case compound when 'SOFT' then least(25, floor(total_laps / 2)) when 'MEDIUM' then least(35, floor(total_laps / 1.5::double))
   else least(45, total_laps) end as int) as s
 from races, (values ('SOFT'), ('MEDIUM'), ('HARD')) v(compound)),
wn as (select year, circuit, total_laps, compound, s as optimal_stint, 'early' as window, greatest(8, s - 5) as start_lap,
 least(s + 5, total_laps - 5) as end_lap, case when compound = 'SOFT' then 'high' else 'medium' end as priority from c
 union all select year, circuit, total_laps, compound, s, 'late', greatest(s + 10, total_laps - 20),
 least(greatest(s + 10, total_laps - 20) + 10, total_laps - 3), 'medium' from c where total_laps > 35)
select *, start_lap <= end_lap as is_valid from wn"""


# --- G6 / W8 / J3 / G7 / T4 --------------------------------------------------
BASE = """(case {c} when 'silverstone' then 88.0 when 'monaco' then 72.0 when 'spa' then 105.0 when 'monza' then 81.0
 when 'suzuka' then 90.0 when 'interlagos' then 70.0 when 'barcelona' then 78.0 else 88.0 end)::double"""
MOD = "(case {c} when 'SOFT' then -0.8 when 'HARD' then 0.6 else 0.0 end)::double"
RATE2 = "(case {c} when 'SOFT' then 0.025 when 'HARD' then 0.010 else 0.018 end)::double"


def st_sql(circ, comp, n, a):
    nn = f"greatest({n}, 0)::double"
    return (f"({nn} * ({BASE.format(c=circ)} + {MOD.format(c=comp)}) + {RATE2.format(c=comp)} * "
            f"({nn} * {a} + {nn} * ({nn} - 1) / 2))")


ST = w(tv.LAPS_CTE, tv.STATES_CTE)


def cand_sql(st, hi="least(total_laps - 5, current_lap + 16) - 1", key="cost"):
    """Candidate pit laps, the best per (state, compound) and the ranked windows; ``st`` prices a stint."""
    return """sc as (select s.*, c.compound, c.compound_idx from states s,
 (values (0, 'SOFT'), (1, 'MEDIUM'), (2, 'HARD')) c(compound_idx, compound) where c.compound <> s.current_tire_compound),
cand as (select sc.*, cast(g.p as int) as candidate, """ + st("circuit", "current_tire_compound", "g.p - current_lap", "current_tire_age") + \
    " + 25.0 + " + st("circuit", "compound", "total_laps - g.p", "1") + """ as cost
 from sc, generate_series(current_lap + 1, """ + hi + """) g(p)),
best as (select state_id, compound, candidate, cost, cnt from (select *, row_number() over
 (partition by state_id, compound order by """ + key + """, candidate) as rn, count(*) over (partition by state_id, compound) as cnt
 from cand) where rn = 1),
win as (select sc.*, cast(coalesce(b.candidate, sc.current_lap + 1) as int) as optimal_lap, b.cost as estimated_total_time,
 coalesce(b.cnt, 0) as candidates from sc left join best b on sc.state_id = b.state_id and sc.compound = b.compound),
wr as (select *, row_number() over (partition by state_id order by estimated_total_time nulls last, compound_idx) as rank from win)"""


CAND = cand_sql(st_sql)


@query
def q_optimal_pit_lap(spark, sf):
    return _round(S.optimal_pit_lap(STATES(spark, sf)), ["estimated_total_time"])


SQL["optimal_pit_lap"] = ST + ", " + CAND + """ select state_id, current_lap, total_laps, compound_idx, compound,
 optimal_lap, round(estimated_total_time, 6) as estimated_total_time, cast(candidates as int) as candidates from win"""


@query
def q_best_candidate(spark, sf):
    b = S.best_candidate(S.candidate_grid(STATES(spark, sf)), ["state_id", "compound"])
    return _round(b, ["cost"])


SQL["best_candidate"] = ST + ", " + CAND + " select state_id, compound, candidate, round(cost, 6) as cost from best"


@query
def q_grid_join(spark, sf):
    g = S.candidate_grid(STATES(spark, sf))
    return _round(g.select("state_id", "compound", "candidate", "cost"), ["cost"])


SQL["grid_join"] = ST + ", " + CAND + " select state_id, compound, candidate, round(cost, 6) as cost from cand"


WIN_COLS = """state_id, year, circuit, driver, current_lap, total_laps, cast(rank as int) as rank, compound, optimal_lap,
 cast(greatest(current_lap + 1, optimal_lap - 2) as int) as window_start,
 cast(least(total_laps - 5, optimal_lap + 2) as int) as window_end,
 round(estimated_total_time, 6) as estimated_total_time,
 round((total_laps - current_lap) / 2 * coalesce(""" + RT.format(c="current_tire_compound").replace("0.02", "0.25") + \
    """, 0.25) - (total_laps - current_lap) / 2 * """ + RT.format(c="compound").replace("0.02", "0.25") + """, 6) as tire_advantage,
 25 as track_position_loss,
 round(greatest(0.0::double, least(1.0::double, 0.8::double + case when compound = 'MEDIUM' then 0.1::double
 when compound = 'SOFT' and total_laps - current_lap < 15 then 0.1::double else 0.0::double end
 - case when current_position <= 5 then 0.1::double else 0.0::double end
 - case when total_laps - current_lap < 10 then 0.2::double else 0.0::double end)), 6) as confidence"""


@query
def q_pit_windows_for_state(spark, sf):
    return _round(S.pit_windows_for_state(STATES(spark, sf)), ["estimated_total_time", "tire_advantage", "confidence"])


SQL["pit_windows_for_state"] = ST + ", " + CAND + " select " + WIN_COLS + " from wr"


@query
def q_rank_windows(spark, sf):
    return S.pit_windows_for_state(STATES(spark, sf)).select("state_id", "compound", "rank")


SQL["rank_windows"] = ST + ", " + CAND + " select state_id, compound, cast(rank as int) as rank from wr"


# --- G9 / G10 / F16 / F17 ----------------------------------------------------
def _rec(spark, sf):
    r = S.recommend_plans(STATES(spark, sf))
    return r.select("state_id", "year", "circuit", "total_laps", "rank", "plan_kind",
                    _keystr("pit_laps").alias("pit_laps"), F.array_join("compounds_in", ",").alias("compounds_in"),
                    "total_time", "confidence_score", "risk_level", F.col("pit_laps").alias("_pits"))


@query
def q_recommend_plans(spark, sf):
    return _round(_rec(spark, sf).drop("_pits"), ["total_time", "confidence_score"])


def _adj(lap):
    return (f"case when total_laps - {lap} < 5 then -0.3::double when total_laps - {lap} > total_laps * 0.8 "
            f"then -0.1::double else 0.0::double end")


def rec_sql(st, cand):
    """The candidate plans of each state by ``st``, ranked."""
    return cand + """, rs as (select s.*, w.optimal_lap as bl, w.compound as bc from states s left join wr w
 on s.state_id = w.state_id and w.rank = 1),
o as (
 select rs.*, 0 as option_idx, 'best_window' as plan_kind, cast(bl as varchar) as pit_laps, bc as compounds_in, 1 as n,
  case when bl <= total_laps then (0.0::double + """ + st("circuit", "current_tire_compound", "bl - current_lap", "current_tire_age") + \
    " + " + st("circuit", "bc", "total_laps + 1 - bl", "0") + ") + 1 * 25.0 else (0.0::double + " + \
    st("circuit", "current_tire_compound", "total_laps + 1 - current_lap", "current_tire_age") + """) + 0 * 25.0 end as total_time,
  0.7::double + 0.2::double + (0.0::double + """ + _adj("bl") + """) as conf_raw,
  (case when bc = 'SOFT' and total_laps - bl > 20 then 1 else 0 end) + (case when total_laps - bl < 5 then 1 else 0 end) as risk_k
 from rs where bl is not null
 union all select rs.*, 1, 'conservative', cast(current_lap + cast(floor((total_laps - current_lap) / 2) as int) as varchar), 'MEDIUM', 1,
  (0.0::double + """ + st("circuit", "current_tire_compound", "(current_lap + cast(floor((total_laps - current_lap) / 2) as int)) - current_lap", "current_tire_age") + " + " + \
    st("circuit", "'MEDIUM'", "total_laps + 1 - (current_lap + cast(floor((total_laps - current_lap) / 2) as int))", "0") + """) + 1 * 25.0,
  0.7::double + 0.2::double + (0.0::double + """ + _adj("(current_lap + cast(floor((total_laps - current_lap) / 2) as int))") + """),
  case when total_laps - (current_lap + cast(floor((total_laps - current_lap) / 2) as int)) < 5 then 1 else 0 end
 from rs
 union all select rs.*, 2, 'aggressive', cast(total_laps - 15 as varchar), 'SOFT', 1,
  (0.0::double + """ + st("circuit", "current_tire_compound", "total_laps - 15 - current_lap", "current_tire_age") + " + " + \
    st("circuit", "'SOFT'", "16", "0") + """) + 1 * 25.0,
  0.7::double + 0.2::double + (0.0::double + """ + _adj("(total_laps - 15)") + """),
  (case when total_laps - (total_laps - 15) > 20 then 1 else 0 end)
 from rs where total_laps - 15 > current_lap
 union all select rs.*, 3, 'two_stop', cast(current_lap + 10 as varchar) || ',' || cast(total_laps - 15 as varchar),
  'MEDIUM,SOFT', 2,
  (0.0::double + """ + st("circuit", "current_tire_compound", "10", "current_tire_age") + " + " + \
    st("circuit", "'MEDIUM'", "total_laps - 15 - (current_lap + 10)", "0") + " + " + \
    st("circuit", "'SOFT'", "16", "0") + """) + 2 * 25.0,
  0.7::double + 0.0::double + (0.0::double + """ + _adj("(current_lap + 10)") + " + " + _adj("(total_laps - 15)") + """),
  0
 from rs where total_laps - current_lap > 25
 union all select rs.*, 4, 'no_stop', '', '', 0,
  (0.0::double + """ + st("circuit", "current_tire_compound", "total_laps + 1 - current_lap", "current_tire_age") + """) + 0 * 25.0,
  0.5::double, 0
 from rs where current_tire_age + (total_laps - current_lap) <= 50),
rec as (select *, cast(row_number() over (partition by state_id order by total_time nulls last, option_idx) as int) as rank,
 case when n = 0 then 0.5::double else greatest(0.0::double, least(1.0::double, conf_raw)) end as confidence_score,
 case when risk_k = 0 then 'LOW' when risk_k <= 2 then 'MEDIUM' else 'HIGH' end as risk_level from o)"""


REC = rec_sql(st_sql, CAND)
REC_COLS = """state_id, year, circuit, total_laps, rank, plan_kind, pit_laps, compounds_in, round(total_time, 6) as total_time,
 round(confidence_score, 6) as confidence_score, risk_level"""
SQL["recommend_plans"] = ST + ", " + REC + " select " + REC_COLS + " from rec"


@query
def q_plan_cost_from_state(spark, sf):
    s = STATES(spark, sf)
    out = S.plan_cost_from_state(s, F.array(F.least(F.col("current_lap") + 5, F.col("total_laps"))),
                                 F.array(F.lit("HARD")))
    return _round(out.select("state_id", "total_time"), ["total_time"])


SQL["plan_cost_from_state"] = ST + """, p as (select *, least(current_lap + 5, total_laps) as pl from states)
select state_id, round((0.0::double + """ + st_sql("circuit", "current_tire_compound", "pl - current_lap", "current_tire_age") + \
    " + " + st_sql("circuit", "'HARD'", "total_laps + 1 - pl", "0") + ") + 1 * 25.0, 6) as total_time from p"


@query
def q_plan_confidence(spark, sf):
    r = _rec(spark, sf)
    return _round(r.select("state_id", "rank", X.plan_confidence(F.col("_pits"), F.col("total_laps"))
                           .alias("confidence_score")), ["confidence_score"])


SQL["plan_confidence"] = ST + ", " + REC + " select state_id, rank, round(confidence_score, 6) as confidence_score from rec"


@query
def q_plan_risk(spark, sf):
    return _rec(spark, sf).select("state_id", "rank", "risk_level")


SQL["plan_risk"] = ST + ", " + REC + " select state_id, rank, risk_level from rec"


# --- G11 / J4 / F18 / F19 ----------------------------------------------------
@query
def q_assess_incidents(spark, sf):
    l = laps(spark, sf)
    r = S.recommend_plans(tv.states(l))
    a = S.assess_incidents(r, tv.incidents(l))
    return _round(a.select("state_id", "rank", "sc_lap", _keystr("pit_laps").alias("pit_laps"),
                           "safety_car_benefit", "recommended_change"), ["safety_car_benefit"])


def _ben(lap):
    return f"(case when abs({lap} - sc_lap) <= 3 then 1.0::double when abs({lap} - sc_lap) <= 6 then 0.5::double else 0.0::double end)"


SQL["assess_incidents"] = ST + ", " + tv.INCIDENTS_CTE + ", " + REC + """,
j as (select rec.*, i.sc_lap, case when n >= 1 then cast(split_part(pit_laps, ',', 1) as int) end as p1,
 case when n = 2 then cast(split_part(pit_laps, ',', 2) as int) end as p2
 from rec join incidents i on rec.year = i.year and rec.circuit = i.circuit)
select state_id, rank, sc_lap, pit_laps,
 round(case when n = 0 then 0.0::double when n = 1 then (0.0::double + """ + _ben("p1") + """) / 1
   else (0.0::double + """ + _ben("p1") + " + " + _ben("p2") + """) / 2 end, 6) as safety_car_benefit,
 case when n = 0 then 'Consider pitting during safety car period'
  when (case when n = 2 and abs(p2 - sc_lap) < abs(p1 - sc_lap) then abs(p2 - sc_lap) else abs(p1 - sc_lap) end) <= 2
   then 'Strategy well-positioned for safety car'
  when (case when n = 2 and abs(p2 - sc_lap) < abs(p1 - sc_lap) then p2 else p1 end) > sc_lap + 5
   then 'Consider advancing pit stop to safety car period'
  else 'Consider delaying pit stop if safety car extends' end as recommended_change
from j"""
_projection("assess_incidents", "incident_join", ["state_id", "rank", "sc_lap", "pit_laps"])
_projection("assess_incidents", "incident_benefit", ["state_id", "rank", "safety_car_benefit"])
_projection("assess_incidents", "incident_recommendation", ["state_id", "rank", "recommended_change"])


# --- G12 ---------------------------------------------------------------------
@query
def q_degradation_curves(spark, sf):
    pairs = laps(spark, sf).where(F.col("compound").isin(dims.COMPOUNDS)) \
        .select("circuit", "compound").distinct()
    return _round(S.degradation_curves(pairs), ["lap_time", "degradation"])


SQL["degradation_curves"] = L + """, p as (select distinct circuit, compound from laps where compound in ('SOFT', 'MEDIUM', 'HARD'))
select circuit, compound, cast(a.age as int) as tire_age, round(90.0::double + a.age * """ + RT.format(c="compound") + """, 6) as lap_time,
 round(90.0::double + a.age * """ + RT.format(c="compound") + """ - 90.0, 6) as degradation
from p, generate_series(1, 30) a(age)"""


@query
def q_lap_time_grid(spark, sf):
    pairs = laps(spark, sf).where(F.col("compound").isin(dims.COMPOUNDS)) \
        .select("circuit", "compound").distinct()
    return _round(S.lap_time_grid(pairs), ["lap_time"])


SQL["lap_time_grid"] = L + """, p as (select distinct circuit, compound from laps where compound in ('SOFT', 'MEDIUM', 'HARD'))
select circuit, compound, cast(a.age as int) as tire_age, round(""" + BASE.format(c="circuit") + " + " + MOD.format(c="compound") + \
    " + a.age * " + RATE2.format(c="compound") + """, 6) as lap_time from p, generate_series(1, 30) a(age)"""


# --- G6 with a fitted lap model (prefix-sum lap-cost table) ------------------
@query
def q_optimal_pit_lap_model(spark, sf):
    """G6 where lap times come from the per-(circuit, compound) linear baseline (M8),
    evaluated through the cumulative lap-cost table (SURVEY §4.3)."""
    from .operators.model import linear_degradation
    from .plans import lapmodel as LM
    l = laps(spark, sf)
    st = tv.states(l)
    cum = LM.cumulative_lap_table(LM.linear_lap_times(linear_degradation(l)))
    return _round(LM.optimal_pit_lap_with(st, cum), ["estimated_total_time"])


SQL["optimal_pit_lap_model"] = ST + """, fit as (select circuit, compound, regr_slope(lap_time, tyre_life) as s,
 regr_intercept(lap_time, tyre_life) as i from laps where lap_time is not null and tyre_life is not null group by 1, 2),
mx as (select max(current_tire_age) + max(total_laps) + 1 as m from states),
lt as (select circuit, compound, a.age as tire_age, i + s * a.age as lap_time from fit, mx, generate_series(0, mx.m) a(age)),
cm as (select circuit, compound, tire_age, coalesce(sum(lap_time) over (partition by circuit, compound order by tire_age
 rows between unbounded preceding and 1 preceding), 0.0) as c from lt
 union all select circuit, compound, max(tire_age) + 1, sum(lap_time) from lt group by 1, 2),
arr as (select circuit, compound, list(c order by tire_age) as cum from cm group by 1, 2),
sc as (select s.*, c.compound, c.compound_idx from states s,
 (values (0, 'SOFT'), (1, 'MEDIUM'), (2, 'HARD')) c(compound_idx, compound) where c.compound <> s.current_tire_compound),
cand as (select sc.state_id, sc.compound, g.p as candidate,
 (ac.cum[sc.current_tire_age + (g.p - sc.current_lap) + 1] - ac.cum[sc.current_tire_age + 1]) + 25.0
 + (an.cum[1 + (sc.total_laps - g.p) + 1] - an.cum[1 + 1]) as cost
 from sc join arr ac on ac.circuit = sc.circuit and ac.compound = sc.current_tire_compound
 join arr an on an.circuit = sc.circuit and an.compound = sc.compound,
 generate_series(sc.current_lap + 1, least(sc.total_laps - 5, sc.current_lap + 16) - 1) g(p)),
best as (select * from (select *, row_number() over (partition by state_id, compound order by round(cost, 9), candidate)
 as rn from cand where cost is not null) where rn = 1)
select sc.state_id, sc.current_lap, sc.total_laps, sc.compound_idx, sc.compound,
 cast(coalesce(b.candidate, sc.current_lap + 1) as int) as optimal_lap, round(b.cost, 6) as estimated_total_time
from sc left join best b on sc.state_id = b.state_id and sc.compound = b.compound"""


# --- G6 and G9 with lines per band of ages, over the whole rest of the race ---
def _bands(spark, sf):
    from .plans import lapmodel as LM
    l = laps(spark, sf)
    return tv.states(l), LM.cumulative_lap_table(LM.banded_lap_times(l))


@query
def q_optimal_pit_lap_bands(spark, sf):
    """G6 with a fitted model of many segments and no limit on how far away the stop may be."""
    from .plans import lapmodel as LM
    return _round(LM.optimal_pit_lap_with(*_bands(spark, sf), reach=None), ["estimated_total_time"])


@query
def q_recommend_plans_bands(spark, sf):
    """G9 with the same model."""
    states, cum = _bands(spark, sf)
    r = S.recommend_plans(states, cum_table=cum, reach=None)
    return _round(r.select("state_id", "rank", "plan_kind", _keystr("pit_laps").alias("pit_laps"), F.array_join(
        "compounds_in", ",").alias("compounds_in"), "total_time", "confidence_score", "risk_level"),
        ["total_time", "confidence_score"])


def band_sql(circ, comp, n, a):
    return f"(cums[{comp}][{a} + greatest({n}, 0) + 1] - cums[{comp}][{a} + 1])"


# every age is priced one by one and summed up, every candidate lap is tried
BANDS = ST.replace("states as (", "plain as (") + """, fit as (select circuit, compound, tyre_life // 10 * 10 as lo,
 regr_slope(lap_time, tyre_life) as s, regr_intercept(lap_time, tyre_life) as i, avg(lap_time) as m
 from laps where lap_time is not null and tyre_life >= 0 group by 1, 2, 3),
age as (select unnest(generate_series(0, (select max(current_tire_age) + max(total_laps) + 1 from plain))) as age),
lt as (select circuit, compound, age, arg_max(coalesce(i + s * age, m), lo) filter (lo <= age) as t,
 arg_min(coalesce(i + s * age, m), lo) as t0 from fit, age group by 1, 2, 3),
cm as (select circuit, compound, age, coalesce(sum(coalesce(t, t0)) over (partition by circuit, compound order by age
 rows between unbounded preceding and 1 preceding), 0.0) as c from lt),
per as (select circuit, compound, list(c order by age) as cum from cm group by 1, 2),
known as (select circuit, map(list(compound), list(cum)) as cums from per group by 1),
states as (select plain.*, cums from plain left join known using (circuit))"""
BAND_CAND = cand_sql(band_sql, "total_laps - 6", "round(cost, 9) nulls last")
SQL["optimal_pit_lap_bands"] = BANDS + ", " + BAND_CAND + """ select state_id, current_lap, total_laps, compound_idx, compound,
 optimal_lap, round(estimated_total_time, 6) as estimated_total_time from win"""
SQL["recommend_plans_bands"] = BANDS + ", " + rec_sql(band_sql, BAND_CAND) + """ select state_id, rank, plan_kind, pit_laps,
 compounds_in, round(total_time, 6) as total_time, round(confidence_score, 6) as confidence_score, risk_level from rec"""
