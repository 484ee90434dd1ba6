"""State-level plans: G6, G7, G9, G10, G11, G12, J3, J4, W8, T4.

A *state* is one row describing a car mid-race (``testview.states``): current lap,
race length, position, compound, tyre age. Every recorded state is planned at once.
Candidate laps and candidate plans live in arrays inside the state row and are
costed in closed form, so the whole optimisation is one narrow stage over the states
table: no explode-and-regroup, no shuffle, and the work grows linearly with states.

Lap times come from the deterministic lap model F23 (circuit base + compound
modifier + age x compound rate; the reference's random variation is omitted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import exprs as X
from ..operators.ordering import split_join

STATE_KEYS = ("state_id",)


def _mod(c: Column) -> Column:
    return X._lookup({k: v[0] for k, v in dims.COMPOUND_MODIFIERS.items()}, c, dims.COMPOUND_MODIFIERS["MEDIUM"][0])


def _rate2(c: Column) -> Column:
    return X._lookup({k: v[1] for k, v in dims.COMPOUND_MODIFIERS.items()}, c, dims.COMPOUND_MODIFIERS["MEDIUM"][1])


def stint_time(circuit: Column, compound: Column, n: Column, first_age: Column) -> Column:
    """Sum of F23 lap times over ``n`` laps with ages ``first_age .. first_age+n-1``."""
    return _stint(X.circuit_baseline(circuit) + _mod(compound), _rate2(compound), n, first_age)


def _stint(base_mod: Column, rate: Column, n: Column, first_age: Column) -> Column:
    """``stint_time`` with the per-compound constants already resolved."""
    n = F.greatest(n, F.lit(0)).cast("double")
    return n * base_mod + rate * (n * first_age + n * (n - 1) / 2)


def _prep(states: DataFrame) -> DataFrame:
    """Resolve per-state constants and the per-compound candidate pair once, in
    separate projections, so no expression is re-evaluated inside another."""
    cur, t, age = F.col("current_lap"), F.col("total_laps"), F.col("current_tire_age")
    x = states.withColumns({"_B": X.circuit_baseline(F.col("circuit")),
                            "_rc": _rate2(F.col("current_tire_compound"))}) \
              .withColumn("_bmc", F.col("_B") + _mod(F.col("current_tire_compound")))
    lo, hi = cur + 1, F.least(t - 5, cur + 16) - 1
    clamp = lambda v: F.least(F.greatest(v.cast("int"), lo), hi)
    verts = {}
    for idx, comp in enumerate(dims.COMPOUNDS):
        mod, rate = dims.COMPOUND_MODIFIERS[comp]
        bmn, rn = F.col("_B") + F.lit(mod), F.lit(rate)
        rs = F.col("_rc") + rn
        verts[f"_v{idx}"] = (bmn - F.col("_bmc") - F.col("_rc") * age + F.col("_rc") * cur + rn * t + rs / 2) / rs
    x = x.withColumns(verts)
    x = x.withColumns({c: clamp(F.floor(F.col(f"_v{i}")) if c.startswith("_a") else F.ceil(F.col(f"_v{i}")))
                       for i in range(len(dims.COMPOUNDS)) for c in (f"_a{i}", f"_b{i}")})
    costs = {}
    for idx, comp in enumerate(dims.COMPOUNDS):
        mod, rate = dims.COMPOUND_MODIFIERS[comp]
        bmn, rn = F.col("_B") + F.lit(mod), F.lit(rate)
        cost = lambda p: (_stint(F.col("_bmc"), F.col("_rc"), p - cur, age) + F.lit(dims.PIT_STOP_PENALTY)
                          + _stint(bmn, rn, t - p, F.lit(1)))
        costs[f"_ca{idx}"] = cost(F.col(f"_a{idx}"))
        costs[f"_cb{idx}"] = cost(F.col(f"_b{idx}"))
    return x.withColumns(costs)


# G6 / W8 --------------------------------------------------------------------
def _candidate_cost(cur, t, age, circuit, cur_c, new_c, pit) -> Column:
    """Current tyres on laps cur..pit-1, 25 s stop, new tyres (ages 1..) to the end."""
    return stint_time(circuit, cur_c, pit - cur, age) + F.lit(dims.PIT_STOP_PENALTY) + \
        stint_time(circuit, new_c, t - pit, F.lit(1))


def _windows(states: DataFrame) -> Column:
    """Per state (after ``_prep``): array of (compound_idx, compound, optimal_lap,
    estimated_total_time, candidates) for each compound other than the current one.

    With the F23 lap model the C1 cost is a convex quadratic in the pit lap (curvature
    ``(r_cur + r_new)/2 > 0``), so the first minimum over the integer candidates is
    the better of the two integers around the vertex, clamped to the candidate range:
    plain arithmetic in generated code instead of a scan per candidate. ``candidate_grid``
    + ``best_candidate`` keep the scan form for arbitrary cost tables."""
    cur, t = F.col("current_lap"), F.col("total_laps")
    cur_c = F.col("current_tire_compound")
    lo, hi = cur + 1, F.least(t - 5, cur + 16) - 1
    has = lo <= hi
    out = []
    for idx, comp in enumerate(dims.COMPOUNDS):
        a, b, ca, cb = (F.col(f"_{k}{idx}") for k in ("a", "b", "ca", "cb"))
        out.append(F.when(cur_c != F.lit(comp), F.struct(
            F.lit(idx).alias("compound_idx"), F.lit(comp).alias("compound"),
            F.when(has, F.when(cb < ca, b).otherwise(a)).otherwise(lo).alias("optimal_lap"),
            F.when(has, F.least(ca, cb)).alias("estimated_total_time"),
            F.greatest(hi - lo + 1, F.lit(0)).alias("candidates"))))
    return F.array_compact(F.array(*out))


def optimal_pit_lap(states: DataFrame) -> DataFrame:
    """Per (state, compound != current): the first lap with minimal C1 cost among
    ``cur+1 .. min(T-5, cur+16)-1``. An empty range gives lap cur+1 and a null cost (D8)."""
    return _prep(states).select(*STATE_KEYS, "current_lap", "total_laps", F.explode(_windows(states)).alias("w")) \
                 .select(*STATE_KEYS, "current_lap", "total_laps", "w.*")


def best_candidate(candidates: DataFrame, keys, cand: str = "candidate", cost: str = "cost") -> DataFrame:
    """Generic W8 over an exploded candidate table: first minimum per key (lowest cost,
    then lowest candidate). ``min`` of a struct is a partial aggregate, so a key with
    many candidates costs one row per task before the shuffle."""
    best = F.min(F.struct(F.col(cost).alias("c"), F.col(cand).alias("k")))
    return candidates.groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.col("_b.k").alias(cand), F.col("_b.c").alias(cost))


def candidate_grid(states: DataFrame) -> DataFrame:
    """J3 state x compound (!= current) x candidate lap, with the C1 cost of each."""
    cur, t = F.col("current_lap"), F.col("total_laps")
    stop = F.least(t - 5, cur + 16)
    comp = F.explode(F.array(*[F.lit(c) for c in dims.COMPOUNDS])).alias("compound")
    x = states.select("*", comp).where(F.col("compound") != F.col("current_tire_compound"))
    x = x.where(cur + 1 <= stop - 1).select("*", F.explode(F.sequence(cur + 1, stop - 1)).alias("candidate"))
    return x.withColumn("cost", _candidate_cost(cur, t, F.col("current_tire_age"), F.col("circuit"),
                                                F.col("current_tire_compound"), F.col("compound"),
                                                F.col("candidate")))


# G7 / T4 --------------------------------------------------------------------
def _sorted_windows(states: DataFrame) -> Column:
    """A state's windows by estimated time, null last, then compound order."""
    return F.array_sort(_windows(states), lambda a, b: F.when(
        a["estimated_total_time"].isNull() & b["estimated_total_time"].isNotNull(), 1)
        .when(a["estimated_total_time"].isNotNull() & b["estimated_total_time"].isNull(), -1)
        .when(a["estimated_total_time"] < b["estimated_total_time"], -1)
        .when(a["estimated_total_time"] > b["estimated_total_time"], 1)
        .otherwise(a["compound_idx"] - b["compound_idx"]))


def pit_windows_for_state(states: DataFrame) -> DataFrame:
    """G6 plus the window around the optimum, tyre advantage (F12), position loss
    (F15) and confidence (F14); ``rank`` orders a state's windows by estimated time
    (null last, then compound order), inside the state row."""
    x = _prep(states).select("*", F.posexplode(_sorted_windows(states)).alias("_r", "w"))
    cur, t, opt = F.col("current_lap"), F.col("total_laps"), F.col("w.optimal_lap")
    return x.select(
        *STATE_KEYS, "year", "circuit", "driver", "current_lap", "total_laps", (F.col("_r") + 1).alias("rank"),
        F.col("w.compound").alias("compound"), opt.alias("optimal_lap"),
        F.greatest(cur + 1, opt - 2).alias("window_start"), F.least(t - 5, opt + 2).alias("window_end"),
        F.col("w.estimated_total_time").alias("estimated_total_time"),
        X.tire_advantage(F.col("current_tire_compound"), F.col("w.compound"), t - cur).alias("tire_advantage"),
        X.static_position_loss().alias("track_position_loss"),
        X.window_confidence(F.col("w.compound"), cur, t, F.col("current_position")).alias("confidence"))


# G10 ------------------------------------------------------------------------
def plan_cost_expr(pits: Column, comps_in: Column) -> Column:
    """C2 time of a plan from the state in the row: laps cur..T, current tyres (age
    from the state) until the first stop, each stop 25 s and fresh tyres from age 0.
    Stops outside cur..T never trigger; stops are applied in lap order."""
    cur, t, age = F.col("current_lap"), F.col("total_laps"), F.col("current_tire_age")
    circuit, cur_c = F.col("circuit"), F.col("current_tire_compound")
    z = F.array_sort(F.filter(F.arrays_zip(pits.alias("lap"), comps_in.alias("cin")),
                              lambda s: (s["lap"] >= cur) & (s["lap"] <= t)))
    k = F.size(z)
    bounds = F.concat(F.array(cur), F.transform(z, lambda s: s["lap"]), F.array(t + 1))
    tyres = F.concat(F.array(cur_c), F.transform(z, lambda s: s["cin"]))
    per = F.transform(F.sequence(F.lit(0), k), lambda j: stint_time(
        circuit, F.get(tyres, j), F.get(bounds, j + 1) - F.get(bounds, j),
        F.when(j == 0, age).otherwise(F.lit(0))))  # at most 3 stints per plan
    return F.aggregate(per, F.lit(0.0), lambda a, b: a + b) + k * dims.PIT_STOP_PENALTY


def plan_cost_from_state(states: DataFrame, pits: Column, comps_in: Column) -> DataFrame:
    return states.select("*", plan_cost_expr(pits, comps_in).alias("total_time"))


# G9 / T5 --------------------------------------------------------------------
def recommend_plans(states: DataFrame, n: int = 5, cum_table: DataFrame | None = None,
                    reach: int | None = 16) -> DataFrame:
    """Up to five plans per state (best window; MEDIUM at mid-distance; SOFT 15 from the
    end if still ahead; two-stop MEDIUM then SOFT when > 25 laps remain; no stop when
    the tyre lasts), each with C2 time, confidence (F16) and risk (F17); ranked by
    time (ties keep that order), first ``n`` kept. Positions are not simulated.

    Each option's C2 time is a closed form over its (at most three) stints, computed
    in plain projections; the ranking sorts a five-element array inside the row.
    With ``cum_table`` (``lapmodel.cumulative_lap_table``) lap times come from that fitted
    lap model instead of F23, and the best window is looked for within ``reach`` laps; plans
    with tyres that the model does not know have a null time and come last."""
    from . import lapmodel as LM
    cur, t, age = F.col("current_lap"), F.col("total_laps"), F.col("current_tire_age")
    if cum_table is None:
        s = _prep(states).withColumn("_best", F.get(_sorted_windows(states), 0))
        bmc, rc = F.col("_bmc"), F.col("_rc")
        st_cur = lambda m: _stint(bmc, rc, m, age)

        def st_new(comp, m):
            c = F.lit(comp) if isinstance(comp, str) else comp
            return _stint(F.col("_B") + _mod(c), _rate2(c), m, F.lit(0))
    else:
        model, circuit = LM.LapTable(cum_table), F.col("circuit")
        s = states.withColumn("_best", F.get(model.sorted_windows(reach), 0))
        st_cur = lambda m: model.stint(circuit, F.col("current_tire_compound"), m, age)

        def st_new(comp, m):
            c = F.lit(comp) if isinstance(comp, str) else comp
            return model.stint(circuit, c, m, F.lit(0))
    s = s.withColumns({"_bl": F.col("_best.optimal_lap"), "_bc": F.col("_best.compound"),
                       "_mid": cur + F.floor((t - cur) / 2).cast("int")})

    pen = dims.PIT_STOP_PENALTY
    no_stop = (F.lit(0.0) + st_cur(t + 1 - cur)) + 0 * pen
    s = s.withColumns({
        "_t0": F.when(F.col("_bl") <= t, (F.lit(0.0) + st_cur(F.col("_bl") - cur) + st_new(F.col("_bc"), t + 1 - F.col("_bl")))
                      + 1 * pen).otherwise(no_stop),
        "_t1": (F.lit(0.0) + st_cur(F.col("_mid") - cur) + st_new("MEDIUM", t + 1 - F.col("_mid"))) + 1 * pen,
        "_t2": (F.lit(0.0) + st_cur(t - 15 - cur) + st_new("SOFT", F.lit(16))) + 1 * pen,
        "_t3": (F.lit(0.0) + st_cur(F.lit(10)) + st_new("MEDIUM", t - 15 - (cur + 10)) + st_new("SOFT", F.lit(16)))
               + 2 * pen,
        "_t4": no_stop})

    def opt(i, pits, comps, kind):
        return F.struct(F.col(f"_t{i}").isNull().alias("unknown"), F.col(f"_t{i}").alias("total_time"), F.lit(i).alias("option_idx"), pits.alias("pit_laps"),
                        comps.alias("compounds_in"), F.lit(kind).alias("plan_kind"))
    opts = F.array(
        F.when(F.col("_bl").isNotNull(), opt(0, F.array(F.col("_bl")), F.array(F.col("_bc")), "best_window")),
        opt(1, F.array(F.col("_mid")), F.array(F.lit("MEDIUM")), "conservative"),
        F.when(t - 15 > cur, opt(2, F.array(t - 15), F.array(F.lit("SOFT")), "aggressive")),
        F.when(t - cur > 25, opt(3, F.array(cur + 10, t - 15), F.array(F.lit("MEDIUM"), F.lit("SOFT")), "two_stop")),
        F.when(age + (t - cur) <= dims.MAX_STINT_LENGTH,
               opt(4, F.array().cast("array<int>"), F.array().cast("array<string>"), "no_stop")))
    # struct order (unknown, total_time, option_idx, ...) makes sort_array rank by time, then option order
    ranked = F.slice(F.sort_array(F.array_compact(opts)), 1, n)
    x = s.select(*states.columns, F.posexplode(ranked).alias("_r", "p"))
    return x.select(
        *[c for c in states.columns], (F.col("_r") + 1).alias("rank"), F.col("p.plan_kind").alias("plan_kind"),
        F.col("p.pit_laps").alias("pit_laps"), F.col("p.compounds_in").alias("compounds_in"),
        F.col("p.total_time").alias("total_time"),
        X.plan_confidence(F.col("p.pit_laps"), t).alias("confidence_score"),
        X.plan_risk(F.col("p.pit_laps"), F.col("p.compounds_in"), t).alias("risk_level"))


# G11 / J4 -------------------------------------------------------------------
def assess_incidents(plans: DataFrame, incidents: DataFrame, keys=("year", "circuit")) -> DataFrame:
    """Plans joined with their session's safety-car lap (J4): benefit (F18) and advice."""
    j = split_join(plans, incidents, list(keys), "inner")
    return j.select("*", X.incident_benefit("pit_laps", "sc_lap").alias("safety_car_benefit"),
                    X.incident_recommendation("pit_laps", "sc_lap").alias("recommended_change"))


# G12 / J3 -------------------------------------------------------------------
def degradation_curves(pairs: DataFrame, ages: int = 30, base: float = 90.0) -> DataFrame:
    """Rows of ``pairs`` (carrying ``compound``) x tyre age 1..``ages``: fallback lap time
    ``base + age·rate`` and degradation vs ``base``."""
    x = pairs.select("*", F.explode(F.sequence(F.lit(1), F.lit(ages))).alias("tire_age"))
    lt = F.lit(base) + F.col("tire_age") * X.degradation_rate(F.col("compound"))
    return x.select("*", lt.alias("lap_time"), (lt - base).alias("degradation"))


def lap_time_grid(pairs: DataFrame, ages: int = 30) -> DataFrame:
    """J3 (circuit, compound) x age 1..``ages`` with the F23 lap time."""
    x = pairs.select("*", F.explode(F.sequence(F.lit(1), F.lit(ages))).alias("tire_age"))
    return x.withColumn("lap_time", X.baseline_lap_time(F.col("circuit"), F.col("compound"), F.col("tire_age")))
