"""Exact values from the reference tests and hand-computed goldens (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from lapstats.functions import exprs as X
from lapstats.operators import clean, panel, stats
from lapstats.operators.quantiles import exact_quantiles
from lapstats.plans import race as R


def test_format_time_delta(spark):
    vals = [(30.5, "30.50s"), (90.5, "1m 30.50s"), (125.25, "2m 5.25s"), (3665.5, "1h 1m 5.50s"),
            (7325.25, "2h 2m 5.25s"), (0.0, "0.00s"), (-1.36, "-1.36s")]
    df = spark.createDataFrame(vals, "s double, want string")
    got = df.select("want", X.format_time_delta("s").alias("got")).collect()
    assert all(r.got == r.want for r in got), got


def test_format_and_parse_lap_time(spark):
    df = spark.createDataFrame([(83.3125, "1:23.312"), (65.0, "1:05.000")], "s double, want string")
    assert [r.got for r in df.select(X.format_lap_time("s").alias("got")).collect()] == ["1:23.312", "1:05.000"]
    t = spark.createDataFrame([("1:23.456",), ("83.5",), ("1:2:3",), ("n/a",), (None,)], "t string")
    got = [r.v for r in t.select(X.parse_lap_time("t").alias("v")).collect()]
    assert got[0] == pytest.approx(83.456) and got[1] == 83.5 and got[2:] == [None, None, None]


def test_percentile_stats_one_to_ten(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    r = stats.percentile_stats(df, "x").first()
    assert (r["min"], r["max"], r["median"], r["mean"]) == (1.0, 10.0, 5.5, 5.5)
    assert (r["q25"], r["q75"], r["iqr"]) == (3.25, 7.75, 4.5)
    one = stats.percentile_stats(spark.createDataFrame([(42.5,)], "x double"), "x").first()
    assert one["std"] == 0.0 and one["iqr"] == 0.0 and one["median"] == 42.5


def test_bracket_quantiles_match_builtin(spark):
    from lapstats import testview
    laps = testview.laps(spark, "/root/testdata/sf0.001")
    probs, names = [0.1, 0.25, 0.5, 0.9], ["a", "b", "c", "d"]
    for by in ([], ["circuit"]):
        for accuracy in (50, 100, 100000):
            a = exact_quantiles(laps, "lap_time", probs, names, by=by, accuracy=accuracy)
            b = laps.where("lap_time is not null").groupBy(*by).agg(*[F.percentile("lap_time", p).alias(n) for p, n in zip(probs, names)])
            ra = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in a.collect())
            rb = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in b.collect())
            assert ra == rb


def test_iqr_filter_sample(spark, sample):
    b = clean.iqr_bounds(sample).first()
    assert b.q1 == pytest.approx(91.9) and b.q3 == pytest.approx(93.1)
    kept = clean.iqr_filter(sample).select("lap_time").collect()
    assert len(kept) == 8 and 168.0 not in [r.lap_time for r in kept]


def test_remove_invalid_laps_sample(spark, sample):
    assert clean.remove_invalid_laps(sample).count() == 8


def test_validity_boundaries(spark):
    df = spark.createDataFrame([(60.0, 1), (180.0, 50), (59.999, 0), (180.001, 51)],
                               "lap_time double, tyre_life int").withColumn("compound", F.lit("SOFT")) \
        .withColumn("circuit", F.lit("monza"))
    got = [(r.lap_time_valid, r.stint_valid) for r in clean.validity_flags(df).collect()]
    assert got == [(True, True), (True, True), (False, False), (False, False)]


def test_split_sample(spark, sample):
    s = sample
    out = panel.chronological_split(s).collect()
    test = [r for r in out if r.is_test]
    assert len(out) == 9 and [r.lap_id for r in test] == [14]


def test_engineer_features_sample(spark, sample):
    f = panel.engineer_features(clean.normalise_columns(clean.remove_invalid_laps(sample)), None)
    rows = f.collect()
    assert len(rows) == 8
    assert all(r.compound_SOFT + r.compound_MEDIUM + r.compound_HARD == 1 for r in rows)
    assert sorted({(r.driver, r.driver_encoded) for r in rows}) == [("ALO", 0), ("GAS", 1), ("NOR", 2)]


def _race(spark, t=50, base=90.0):
    return spark.createDataFrame([(2023, "test", t, base)], "year int, circuit string, total_laps int, base_lap_time double")


def _plan(spark, pits, comps, t=50, base=90.0):
    return spark.createDataFrame([(2023, "test", t, base, pits, comps, "x")],
                                 "year int, circuit string, total_laps int, base_lap_time double, "
                                 "pit_laps array<int>, compounds array<string>, plan_type string") \
        .withColumn("plan_key", R.plan_key())


def test_plan_grid_counts(spark):
    assert R.plan_grid(_race(spark)).count() == 26
    assert R.plan_grid(_race(spark), repeat_singles=True).count() == 34
    assert R.distinct_plans(R.plan_grid(_race(spark), repeat_singles=True)).count() == 26
    assert R.plan_grid(_race(spark, t=25)).where("plan_type = 'single_stop'").count() == 0


def test_evaluate_plan_goldens(spark):
    p = _plan(spark, [20], ["SOFT", "MEDIUM"])
    c3 = R.evaluate_plans(p, "compat").first()
    assert c3.total_race_time == pytest.approx(4506.35) and c3.tire_degradation_loss == pytest.approx(161.35)
    assert c3.track_position_risk == pytest.approx(0.1)
    assert R.evaluate_plans(p, "full").first().total_race_time == pytest.approx(4714.75)
    p2 = _plan(spark, [15, 35], ["SOFT", "MEDIUM", "HARD"])
    assert R.evaluate_plans(p2, "full").first().total_race_time == pytest.approx(4662.50)
    laps = R.expand_plan_laps(p).collect()
    assert len(laps) == 50 and len({r.stint_number for r in laps}) == 2


def test_optimize_plans_best(spark):
    full = R.optimize_plans(_race(spark)).where("rank = 1").first()
    assert full.plan_key == "20|MEDIUM,HARD" and full.total_race_time == pytest.approx(4647.25)
    compat = R.optimize_plans(_race(spark), convention="compat").where("rank = 1").first()
    assert compat.plan_key == "12,27|SOFT,MEDIUM,HARD" and compat.total_race_time == pytest.approx(4356.65)
    assert compat.evaluated == 34 and compat.description == "Two Stop strategy with 2 pit stop(s)"


def test_stint_cost_golden(spark):
    s = spark.createDataFrame([(1, 20, "SOFT", 1)], "start_lap int, end_lap int, compound string, starting_tire_life int")
    r = R.stint_cost(s).first()
    assert r.total_time == pytest.approx(1773.5) and r.average_lap_time == pytest.approx(88.675)
    assert r.tire_degradation == 20


def test_compound_windows_golden(spark):
    w = {(r.compound, r.window): (r.start_lap, r.end_lap, r.is_valid)
         for r in R.compound_windows(_race(spark)).collect()}
    assert w[("SOFT", "early")] == (20, 30, True) and w[("SOFT", "late")] == (35, 45, True)
    assert w[("MEDIUM", "early")] == (28, 38, True) and w[("MEDIUM", "late")] == (43, 47, True)
    assert w[("HARD", "early")] == (40, 45, True) and w[("HARD", "late")] == (55, 47, False)


def test_evaluation_confidence_golden(spark):
    df = spark.createDataFrame([(0.1, 0.3, 150)], "sc double, tp double, n int")
    assert df.select(X.evaluation_confidence("sc", "tp", "n")).first()[0] == pytest.approx(0.735)


def test_clean_driver_name(spark):
    df = spark.createDataFrame([("  max ver ",), ("",), (None,), ("o'brien-ham",)], "n string")
    got = [r[0] for r in df.select(X.clean_driver_name("n")).collect()]
    assert got == ["Max VER", "Unknown", "Unknown", "O'Brien-HAM"]


def test_prefix_sum_planner_matches_closed_form(spark):
    """The lap-cost-table planner, fed the F23 lap model, must pick the same laps and
    costs as the closed-form (vertex) planner."""
    from lapstats import testview
    from lapstats.dims import COMPOUNDS
    from lapstats.plans import lapmodel as LM, state as S
    st = testview.states(testview.laps(spark, "/root/testdata/sf0.001"))
    comps = spark.createDataFrame([(c,) for c in COMPOUNDS], "compound string")
    grid = st.select("circuit").distinct().crossJoin(comps).crossJoin(
        st.agg((F.max("current_tire_age") + F.max("total_laps") + 1).alias("max_age"))) \
        .select("circuit", "compound", F.explode(F.sequence(F.lit(0), F.col("max_age").cast("int"))).alias("tire_age"))
    lt = grid.withColumn("lap_time", X.baseline_lap_time("circuit", "compound", "tire_age"))
    a = LM.optimal_pit_lap_with(st, LM.cumulative_lap_table(lt))
    b = S.optimal_pit_lap(st)
    norm = lambda df: sorted((r.state_id, r.compound, r.optimal_lap,
                              None if r.estimated_total_time is None else round(r.estimated_total_time, 6))
                             for r in df.collect())
    assert norm(a) == norm(b)


def test_recommend_with_lap_table_matches_closed_form(spark):
    from lapstats import testview
    from lapstats.dims import COMPOUNDS
    from lapstats.plans import lapmodel as LM, state as S
    st = testview.states(testview.laps(spark, "/root/testdata/sf0.001"))
    comps = spark.createDataFrame([(c,) for c in COMPOUNDS], "compound string")
    grid = st.select("circuit").distinct().crossJoin(comps).crossJoin(
        st.agg((F.max("current_tire_age") + F.max("total_laps") + 1).alias("max_age"))) \
        .select("circuit", "compound", F.explode(F.sequence(F.lit(0), F.col("max_age").cast("int"))).alias("tire_age"))
    cum = LM.cumulative_lap_table(grid.withColumn("lap_time", X.baseline_lap_time("circuit", "compound", "tire_age")))
    norm = lambda df: sorted((r.state_id, r.rank, r.plan_kind, round(r.total_time, 6)) for r in df.collect())
    assert norm(S.recommend_plans(st, cum_table=cum)) == norm(S.recommend_plans(st))
