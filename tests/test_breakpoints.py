"""The stop found at breakpoints and turning points against a scan of every lap."""

import random

from pyspark.sql import functions as F

from lapstats.dims import PIT_STOP_PENALTY
from lapstats.plans import lapmodel as LM
from lapstats.plans import state as S

COMPOUNDS = ("SOFT", "MEDIUM", "HARD")
STATE = "state_id long, circuit string, current_lap int, total_laps int, current_tire_compound string, current_tire_age int"
SEGMENT = "circuit string, compound string, tire_age int, lap_time double, slope double"


def lap_time(segments, age):
    start, rate, slope = max(s for s in segments if s[0] <= age)
    return rate + slope * (age - start)


def scan(state, model, reach):
    """{compound: (lap, cost)} by trying every lap and pricing every lap of both stints."""
    _, circuit, cur, total, compound, age = state
    end = total - 5 if reach is None else min(total - 5, cur + reach)
    out = {}
    for new in COMPOUNDS:
        if new == compound:
            continue
        old_s, new_s = model.get((circuit, compound)), model.get((circuit, new))
        tried = []
        if old_s and new_s and age is not None:
            for p in range(cur + 1, end):
                cost = sum(lap_time(old_s, age + k) for k in range(p - cur)) + PIT_STOP_PENALTY \
                    + sum(lap_time(new_s, 1 + k) for k in range(total - p))
                tried.append((round(cost, 6), p))
        out[new] = (min(tried)[1], min(tried)[0]) if tried else (cur + 1, None)
    return out


def random_model(rng):
    """Segments with values in quarters and eighths, so that sums are exact and ties are real."""
    model = {}
    for circuit in ("spa", "monza", "suzuka"):
        for compound in COMPOUNDS:
            if (circuit, compound) == ("suzuka", "HARD"):
                continue                                    # a tyre the model does not know
            starts = sorted({0} | {rng.randrange(1, 90) for _ in range(rng.choice([0, 1, 3, 12, 40]))})
            model[circuit, compound] = [(s, 80 + rng.randrange(0, 24) / 4, rng.choice([0.0, 0.0, .125, .25, 1.0, -.125]))
                                        for s in starts]
    return model


def test_breakpoints_equal_the_scan(spark):
    rng = random.Random(11)
    for reach in (16, None):
        model = random_model(rng)
        states = [(i, rng.choice(["spa", "monza", "suzuka", "nowhere"]), cur := rng.randrange(1, 70),
                   cur + rng.choice([0, 3, 6, 7, 8, 20, 60, 150]), rng.choice(COMPOUNDS), rng.choice([None, 0, 1, 5, 33, 95]))
                  for i in range(250)]
        table = LM.cumulative_lap_table(spark.createDataFrame(
            [(c, k, *s) for (c, k), segs in model.items() for s in segs], SEGMENT))
        got = {}
        for r in LM.optimal_pit_lap_with(spark.createDataFrame(states, STATE), table, reach).collect():
            cost = None if r.estimated_total_time is None else round(r.estimated_total_time, 6)
            got.setdefault(r.state_id, {})[r.compound] = (r.optimal_lap, cost)
        assert got == {s[0]: scan(s, model, reach) for s in states}


def test_candidates_follow_segments_not_laps(spark):
    x = spark.createDataFrame([(1, 5000, 3)], "current_lap int, total_laps int, current_tire_age int")
    seg = "array(named_struct('start', 0, 'cum', 0D, 'rate', 90D, 'slope', {b}), " \
          "named_struct('start', 40, 'cum', 3600D, 'rate', 95D, 'slope', {b}))"
    laps = x.select(LM._candidates(F.expr(seg.format(b="0.1D")), F.expr(seg.format(b="0.2D")),
                                   F.col("current_lap") + 1, F.col("total_laps") - 6).alias("c")).first().c
    assert len(laps) <= 10


def test_bands_follow_a_tyre_that_falls_off(spark):
    laps = spark.range(1, 400).selectExpr("'spa' as circuit", "'SOFT' as compound", "cast(id % 25 as int) as tyre_life",
                                          "90 + if(id % 25 < 10, 0.5, 2) * (id % 25) as lap_time")
    other = spark.createDataFrame([("spa", "HARD", 14, 95.0), ("spa", "HARD", 14, 97.0), ("spa", "HARD", None, 1.0),
                                   ("spa", "HARD", 3, None)], "circuit string, compound string, tyre_life int, lap_time double")
    got = {(r.compound, r.tire_age): (round(r.lap_time, 6), round(r.slope, 6))
           for r in LM.banded_lap_times(laps.unionByName(other)).collect()}
    assert got == {("SOFT", 0): (90.0, 0.5), ("SOFT", 10): (110.0, 2.0), ("SOFT", 20): (130.0, 2.0), ("HARD", 0): (96.0, 0.0)}


def test_plans_with_unknown_tyres_come_last(spark):
    model = [("spa", c, 0, 90.0, 0.1) for c in ("SOFT", "HARD")]
    states = spark.createDataFrame([(1, "spa", 10, 60, "SOFT", 4), (2, "nowhere", 10, 60, "SOFT", 4)], STATE) \
        .withColumns({"year": F.lit(2024), "driver": F.lit("D"), "current_position": F.lit(3)})
    rows = S.recommend_plans(states, cum_table=LM.cumulative_lap_table(spark.createDataFrame(model, SEGMENT))).collect()
    known = [r.total_time is not None for r in sorted(rows, key=lambda r: (r.state_id, r["rank"])) if r.state_id == 1]
    assert known == sorted(known, reverse=True) and any(known) and not all(known)
    assert all(r.total_time is None for r in rows if r.state_id == 2)
