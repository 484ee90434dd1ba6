"""Race-level candidate plans: G1-G5, G8, A16, U2, T5.

A *plan* row carries ``pit_laps array<int>`` and ``compounds array<string>`` (one more
compound than stops). Plans per race are generated with ``sequence``/``transform``
inside the race row and costed in closed form with array higher-order functions, so
costing is a narrow projection: no lap explosion and no shuffle. Only the ranking
(T5) groups by race, and a race has at most 34 options.

Cost conventions (SURVEY §2.9):

* ``full`` (C4, default): every lap 1..T is driven; stint ``i`` covers
  ``start..end`` inclusive, ages start at 1; lap time ``base + age·rate``.
* ``compat`` (C3): a stint counts ``end - start`` laps with ages from 0 and the
  next stint starts at ``pit + 1``, so each stop drops one lap.

Both add 25 s per stop and use the compound's rate (0.02 for an unknown compound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import exprs as X

RACE = ("year", "circuit")
SINGLE_PATTERNS = [["SOFT", "MEDIUM"], ["MEDIUM", "HARD"]]
DOUBLE_PATTERNS = [["SOFT", "MEDIUM", "HARD"], ["MEDIUM", "SOFT", "MEDIUM"]]


def _arr(xs) -> Column:
    return F.array(*[F.lit(x) for x in xs])


def _range(start: Column, stop: Column, step: int) -> Column:
    """Python ``range(start, stop, step)`` (exclusive stop, empty when start >= stop)."""
    return F.when(start <= stop - 1, F.sequence(start, stop - 1, F.lit(step))) \
            .otherwise(F.array().cast("array<int>"))


def _plan(pits: Column, comps, kind: str) -> Column:
    return F.struct(pits.alias("pit_laps"), _arr(comps).alias("compounds"), F.lit(kind).alias("plan_type"))


def plan_options(total_laps: Column, max_stops: int = 2) -> Column:
    """Array of plan structs in generation order for a race of ``total_laps``."""
    t = total_laps.cast("int")
    singles = F.flatten(F.transform(_range(F.lit(15), F.least(t - 10, F.lit(35)), 5),
                                    lambda p: F.array(*[_plan(F.array(p), c, "single_stop")
                                                        for c in SINGLE_PATTERNS])))
    if max_stops < 2:
        return singles
    doubles = F.flatten(F.transform(_range(F.lit(12), F.lit(25), 4), lambda f: F.flatten(F.transform(
        _range(f + 15, F.least(t - 8, f + 25), 4),
        lambda s: F.array(*[_plan(F.array(f, s), c, "two_stop") for c in DOUBLE_PATTERNS])))))
    return F.concat(singles, doubles)


def plan_key(pit_laps="pit_laps", compounds="compounds") -> Column:
    """Readable plan identity, e.g. ``15,30|SOFT,MEDIUM,HARD`` (no stops: ``|HARD``)."""
    p = F.col(pit_laps) if isinstance(pit_laps, str) else pit_laps
    c = F.col(compounds) if isinstance(compounds, str) else compounds
    return F.concat(F.array_join(F.transform(p, lambda x: x.cast("string")), ","), F.lit("|"),
                    F.array_join(c, ","))


# G1 / U2 --------------------------------------------------------------------
def plan_grid(races: DataFrame, repeat_singles: bool = False) -> DataFrame:
    """One row per candidate plan per race. ``repeat_singles`` reproduces the option
    list of the race optimizer, where one-stop options are listed twice (max_stops 1,
    then 2); ``option_idx`` is the 0-based generation order."""
    opts = plan_options(F.col("total_laps"), 2)
    if repeat_singles:
        opts = F.concat(plan_options(F.col("total_laps"), 1), opts)
    x = races.select("*", F.posexplode(opts).alias("option_idx", "_p"))
    return x.select(*races.columns, "option_idx", "_p.pit_laps", "_p.compounds", "_p.plan_type") \
            .withColumn("plan_key", plan_key())


def distinct_plans(plans: DataFrame, keys=RACE) -> DataFrame:
    """Drop repeated plans of a race, keeping the first generated copy."""
    first = plans.groupBy(*keys, "plan_key").agg(F.min("option_idx").alias("option_idx"))
    return plans.join(first, [*keys, "plan_key", "option_idx"], "left_semi")


# G2 -------------------------------------------------------------------------
def _stints(pits: Column, comps: Column, t: Column) -> Column:
    """Array of (i, start, end, compound, rate, is_pit) for the stints of a plan."""
    k = F.size(pits)

    def one(i):
        start = F.when(i == 0, F.lit(1)).otherwise(F.get(pits, i - 1) + 1)
        end = F.when(i < k, F.get(pits, i)).otherwise(t)
        comp = F.get(comps, F.least(i, F.size(comps) - 1))
        rate = X.degradation_rate(comp, dims.DEFAULT_RATE_PLAN)
        return F.struct(i.alias("i"), start.alias("start"), end.alias("end"), comp.alias("compound"),
                        rate.alias("rate"), (end < t).alias("is_pit"))
    return F.transform(F.sequence(F.lit(0), k), one)


def _sum(arr: Column, f) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, s: acc + f(s))


def evaluate_plans(plans: DataFrame, convention: str = "full", base_col: str | None = "base_lap_time",
                   default_base: float = 90.0) -> DataFrame:
    """Adds total_race_time, average_lap_time, tire_degradation_loss, pit_stop_time_loss,
    safety_car_risk (0.1), track_position_risk (+0.1 per stint longer than 25 laps) and
    strategy_score (1000 - total/60)."""
    if convention not in ("full", "compat"):
        raise ValueError("convention must be 'full' or 'compat'")
    t = F.col("total_laps").cast("int")
    base = F.lit(default_base) if base_col is None or base_col not in plans.columns else \
        F.coalesce(F.col(base_col), F.lit(default_base))
    st = _stints(F.col("pit_laps"), F.col("compounds"), t)

    def n_of(s):
        n = s["end"] - s["start"] + (1 if convention == "full" else 0)
        return F.greatest(n, F.lit(0)).cast("double")

    if convention == "full":   # ages 1..n
        deg = lambda s: s["rate"] * n_of(s) * (n_of(s) + 1) / 2
    else:                      # ages 0..n-1
        deg = lambda s: s["rate"] * n_of(s) * (n_of(s) - 1) / 2
    lap_time = _sum(st, lambda s: n_of(s) * base + deg(s))
    pit = _sum(st, lambda s: F.when(s["is_pit"], dims.PIT_STOP_PENALTY).otherwise(0.0))
    risk = _sum(st, lambda s: F.when(s["end"] - s["start"] > 25, 0.1).otherwise(0.0))
    out = plans.withColumn("total_race_time", lap_time + pit)
    return out.select(
        "*",
        F.when(t > 0, F.col("total_race_time") / t).otherwise(F.lit(90.0)).alias("average_lap_time"),
        _sum(st, deg).alias("tire_degradation_loss"),
        (F.size("pit_laps") * dims.PIT_STOP_PENALTY).alias("pit_stop_time_loss"),
        F.lit(0.1).alias("safety_car_risk"), risk.alias("track_position_risk"),
        X.plan_score(F.col("total_race_time")).alias("strategy_score"))


# G3 / T5 --------------------------------------------------------------------
def optimize_plans(races: DataFrame, history: DataFrame | None = None, convention: str = "full",
                   top: int = 4, weather_conditions: dict | None = None) -> DataFrame:
    """Per race: all options (singles listed twice) costed, ranked by score (ties keep
    generation order); the best plus the next ``top-1`` with confidence (F20) and
    description (F21). ``history`` (laps) gives the data-availability bonus per circuit.
    Weather conditions only set ``weather_impact`` (their presence), as in the reference."""
    p = evaluate_plans(plan_grid(races, repeat_singles=True), convention)
    # scores compared at 1e-9 so that float noise cannot reorder mathematically equal plans
    w = Window.partitionBy(*RACE).orderBy(F.desc(F.round("strategy_score", 9)), "option_idx")
    p = p.withColumn("rank", F.row_number().over(w)) \
         .withColumn("evaluated", F.count(F.lit(1)).over(Window.partitionBy(*RACE)))
    p = p.where(F.col("rank") <= top)
    if history is not None:
        h = history.groupBy("circuit").agg(F.count(F.lit(1)).alias("history_rows"))
        p = p.join(h, "circuit", "left").withColumn("history_rows", F.coalesce("history_rows", F.lit(0)))
    else:
        p = p.withColumn("history_rows", F.lit(0))
    return p.select(
        *RACE, "rank", (F.col("rank") == 1).alias("is_recommended"), "plan_key", "plan_type", "total_laps",
        "total_race_time", "strategy_score",
        X.evaluation_confidence("safety_car_risk", "track_position_risk", "history_rows").alias("confidence"),
        X.plan_description("plan_type", F.size("pit_laps")).alias("description"), "evaluated",
        F.lit("medium").alias("overall_risk"), F.lit(0.75).alias("probability_of_success"),
        F.lit("8-12").alias("position_range"), F.lit(0.78).alias("success_probability"),
        F.lit(weather_conditions is not None).alias("weather_impact"))


# G4 -------------------------------------------------------------------------
LAP_CHUNK = 1000


def expand_plan_laps(plans: DataFrame, base_col: str | None = "base_lap_time",
                     default_base: float = 90.0, keys=(*RACE, "plan_key")) -> DataFrame:
    """One row per lap 1..T (C4): stint, compound, tyre age from 1, lap time, and the
    key event text on each stop lap. A stint is expanded in chunks of ``LAP_CHUNK`` laps, so
    no array grows with the length of a race."""
    t = F.col("total_laps").cast("int")
    base = F.lit(default_base) if base_col is None or base_col not in plans.columns else \
        F.coalesce(F.col(base_col), F.lit(default_base))
    st = plans.select(*keys, base.alias("_base"), F.explode(_stints(F.col("pit_laps"), F.col("compounds"), t))
                      .alias("s"))
    st = st.select(*keys, "_base", F.col("s.i").alias("stint_idx"), "s.start", "s.compound", "s.rate", "s.is_pit", "s.end") \
           .where(F.col("start") <= F.col("end"))
    chunk = F.explode(F.sequence(F.lit(0), ((F.col("end") - F.col("start")) / LAP_CHUNK).cast("int")))
    first = F.col("start") + F.col("_chunk") * LAP_CHUNK
    laps = st.withColumn("_chunk", chunk).withColumn(
        "lap_number", F.explode(F.sequence(first, F.least(first + (LAP_CHUNK - 1), F.col("end"))))).drop("_chunk")
    age = F.col("lap_number") - F.col("start") + 1
    return laps.select(
        *keys, "lap_number", (F.col("stint_idx") + 1).alias("stint_number"), "compound", age.alias("tire_age"),
        (F.col("_base") + age * F.col("rate")).alias("lap_time"),
        F.when(F.col("is_pit") & (F.col("lap_number") == F.col("end")),
               F.concat(F.lit("Pit stop at lap "), F.col("lap_number").cast("string"))).alias("key_event"))


# A16 ------------------------------------------------------------------------
def stint_cost_summary(plans: DataFrame, base_col: str | None = "base_lap_time",
                       default_base: float = 90.0, keys=(*RACE, "plan_key")) -> DataFrame:
    """Per (plan, stint) in closed form (C4): laps, mean lap time, degradation (= laps),
    stint length (pit - start), plus the plan total repeated on each stint row."""
    t = F.col("total_laps").cast("int")
    base = F.lit(default_base) if base_col is None or base_col not in plans.columns else \
        F.coalesce(F.col(base_col), F.lit(default_base))
    e = evaluate_plans(plans, "full", base_col, default_base)
    st = e.select(*keys, base.alias("_base"), "total_race_time",
                  F.explode(_stints(F.col("pit_laps"), F.col("compounds"), t)).alias("s"))
    n = F.greatest(F.col("s.end") - F.col("s.start") + 1, F.lit(0))
    return st.select(
        *keys, (F.col("s.i") + 1).alias("stint_number"), F.col("s.start").alias("start_lap"),
        F.col("s.end").alias("end_lap"), F.col("s.compound").alias("compound"), n.alias("laps"),
        (F.col("s.end") - F.col("s.start")).alias("stint_length"),
        F.when(n > 0, F.col("_base") + F.col("s.rate") * (n + 1) / 2).alias("average_time"),
        n.alias("degradation"), F.col("total_race_time").alias("plan_total_time"))


# G5 -------------------------------------------------------------------------
def stint_cost(stints: DataFrame, base: float = 85.0) -> DataFrame:
    """Closed-form cost of ``start_lap..end_lap`` on ``compound`` from
    ``starting_tire_life`` (default 1) with base 85 s (C5): total, mean, degradation."""
    a0 = F.coalesce(F.col("starting_tire_life"), F.lit(1)) if "starting_tire_life" in stints.columns else F.lit(1)
    n = F.greatest(F.col("end_lap") - F.col("start_lap") + 1, F.lit(0)).cast("double")
    rate = X.degradation_rate(F.col("compound"), dims.DEFAULT_RATE_PLAN)
    total = n * base + rate * (n * a0 + n * (n - 1) / 2)
    return stints.select("*", total.alias("total_time"),
                         F.when(n > 0, total / n).alias("average_lap_time"),
                         n.cast("int").alias("tire_degradation"))


# G8 -------------------------------------------------------------------------
def compound_windows(races: DataFrame) -> DataFrame:
    """Per (race, compound): early window around the compound's stint length and, for
    races over 35 laps, a late one. Inverted windows are kept with is_valid = false."""
    t = F.col("total_laps").cast("int")
    comp = F.explode(_arr(dims.COMPOUNDS)).alias("compound")
    x = races.select(*RACE, "total_laps", comp)
    s = (F.when(F.col("compound") == "SOFT", F.least(F.lit(25), F.floor(t / 2)))
          .when(F.col("compound") == "MEDIUM", F.least(F.lit(35), F.floor(t / 1.5)))
          .otherwise(F.least(F.lit(45), t))).cast("int")
    x = x.withColumn("optimal_stint", s)
    early = F.struct(F.lit("early").alias("window"), F.greatest(F.lit(8), s - 5).alias("start_lap"),
                     F.least(s + 5, t - 5).alias("end_lap"),
                     F.when(F.col("compound") == "SOFT", "high").otherwise("medium").alias("priority"))
    late_start = F.greatest(s + 10, t - 20)
    late = F.struct(F.lit("late").alias("window"), late_start.alias("start_lap"),
                    F.least(late_start + 10, t - 3).alias("end_lap"), F.lit("medium").alias("priority"))
    arr = F.when(t > 35, F.array(early, late)).otherwise(F.array(early))
    y = x.select(*RACE, "total_laps", "compound", "optimal_stint", F.explode(arr).alias("w")).select(
        *RACE, "total_laps", "compound", "optimal_stint", "w.*")
    return y.withColumn("is_valid", F.col("start_lap") <= F.col("end_lap"))
