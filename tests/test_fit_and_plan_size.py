"""What a fit exchanges and what planning and scoring carry in a row must not grow with the input."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from lapstats.operators import forest as FT
from lapstats.operators import model as M
from lapstats.plans import lapmodel as LM

NAMES = ["tire_age", "lap_number"]


def _laps(spark, rows=2000, files=64):
    return spark.range(rows).repartition(files).selectExpr(
        "id as lap_id", "cast(id * 7919 % 31 as int) as tire_age", "cast(id % 60 as int) as lap_number",
        "80 + (id * 7919 % 31) * 0.11 + (id % 60) * 0.03 as lap_time")


def test_the_fit_has_as_many_tasks_as_cores_however_many_files(spark, monkeypatch):
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: seen.append(df.rdd.getNumPartitions()) or fit(self, df, *a))
    cores = spark.sparkContext.defaultParallelism
    M.fit_degradation_model(_laps(spark, files=cores + 24), NAMES, num_trees=2, max_depth=2)
    assert seen == [cores]
    assert M.fit_tasks(12, 5_000_000) == 12 and M.fit_tasks(12, 10 * 12 * M.FIT_ROWS) == 120


def test_scored_laps_carry_no_trees(spark):
    laps = _laps(spark, 500, 4).withColumn("tire_age", F.expr("if(lap_id % 9 = 0, null, tire_age)"))
    model = M.fit_degradation_model(laps, NAMES, num_trees=3, max_depth=4)
    got = FT.score_with_nodes(laps, FT.forest_nodes(model, spark), NAMES, depth=4)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {r.lap_id: r.prediction for r in M.score_laps(model, laps).collect()}
    have = {r.lap_id: r.prediction for r in got.collect()}
    assert have.keys() == want.keys() and all(abs(have[k] - want[k]) < 1e-9 for k in have)
    assert got.columns == [*laps.columns, "prediction"]


def test_planned_states_carry_no_segments(spark):
    model = spark.createDataFrame([(c, k, a, 90.0 + a / 8, None if k == "HARD" else 0.25) for c in ("spa", None)
                                   for k in ("SOFT", "MEDIUM", "HARD") for a in (0, 8)],
                                  "circuit string, compound string, tire_age int, lap_time double, slope double")
    states = spark.createDataFrame(
        [(1, "spa", 10, 60, "SOFT", 4), (2, None, 10, 60, "SOFT", 4), (3, "spa", 10, None, "SOFT", 4),
         (4, "spa", 10, 60, "SOFT", None), (4, "spa", 10, 60, "SOFT", None), (5, "spa", 58, 60, "MEDIUM", 4)],
        "state_id long, circuit string, current_lap int, total_laps int, current_tire_compound string, current_tire_age int")
    got = LM.optimal_pit_lap_with(states, LM.cumulative_lap_table(model))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "cums" not in plan
    rows = sorted((r.state_id, r.compound, r.optimal_lap, r.estimated_total_time is None) for r in got.collect())
    lap = {r[:2]: r[2:] for r in rows}
    assert len(rows) == 12
    assert lap[1, "MEDIUM"] == lap[2, "MEDIUM"] and not lap[1, "MEDIUM"][1]         # a null circuit is a circuit
    assert lap[1, "HARD"] == (11, True)                                             # a fit without a slope has no price
    assert all(lap[i, "MEDIUM"] == (11, True) for i in (3, 4)) and lap[5, "SOFT"] == (59, True)


def test_the_fit_keeps_no_node_ids_and_grows_the_same_forest(spark, monkeypatch):
    """A cache of node ids is a number per lap and tree, several times over; the splits need none."""
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: seen.append((self, df)) or fit(self, df, *a))
    model = M.fit_degradation_model(_laps(spark), NAMES, num_trees=3, max_depth=5)
    pipe, data = seen[0]
    forest = pipe.getStages()[-1]
    assert not forest.getCacheNodeIds()
    cached = fit(Pipeline(stages=[pipe.getStages()[0], forest.copy({forest.cacheNodeIds: True})]), data)
    trees = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (model.pipeline, cached)]
    assert trees[0] == trees[1] and "feature" in trees[0]


def test_a_pass_of_the_fit_holds_few_nodes_and_grows_the_same_forest(spark, monkeypatch):
    """Statistics of all trees at once lie far from the core; fewer in a pass give the same splits."""
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: seen.append((self, df)) or fit(self, df, *a))
    model = M.fit_degradation_model(_laps(spark), NAMES, num_trees=3, max_depth=5)
    pipe, data = seen[0]
    forest = pipe.getStages()[-1]
    assert forest.getMaxMemoryInMB() <= 16
    trees = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    for mb in (0, 256):     # 0: one node a pass
        other = fit(Pipeline(stages=[pipe.getStages()[0], forest.copy({forest.maxMemoryInMB: mb})]), data)
        assert trees(other) == trees(model.pipeline) and "feature" in trees(other)


def test_staged_laps_lie_in_target_order_and_none_is_lost(spark):
    """Laps that follow each other add to the same nodes, which then stay near the core."""
    laps = _laps(spark, 3000, 5).selectExpr("*", "2021 as year", "'spa' as circuit", "concat('D', lap_id % 7) as driver")
    laps = laps.withColumn("lap_time", F.expr("if(lap_id % 10 < 3, 88.0, lap_time)"))
    split = M.training_split(laps)
    rows = split.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "lap_time", "tire_age", "lap_number", "lap_id").collect()
    files = {}
    for r in sorted(rows, key=lambda r: r.i):
        files.setdefault(r.f, []).append((r.lap_time, r.tire_age, r.lap_number))
    assert len(files) > 1 and all(v == sorted(v) for v in files.values())
    assert sorted(r.lap_id for r in rows) == list(range(3000)) and split.where("is_test").count() == 600


def test_raw_laps_are_computed_once_however_often_the_features_read_them(spark):
    laps = _laps(spark, 400, 3).selectExpr(
        "lap_id", "2021 as year", "if(lap_id % 5 = 0, null, 'spa') as circuit", "concat('D', lap_id % 7) as driver",
        "cast(lap_id div 7 as int) as lap_number", "if(lap_id % 31 = 0, null, lap_time) as lap_time", "'SOFT' as compound",
        "tire_age as tyre_life", "cast(lap_id % 20 as double) as position", "if(lap_id % 11 = 0, null, 0.5) as gap_to_leader")
    from lapstats.operators.clean import normalise_columns
    clean = normalise_columns(laps)
    learned = M.FeatureStage.fit(clean)
    rows = learned.transform(clean)
    model = M.fit_degradation_model(rows, num_trees=2, max_depth=3)
    model.stage = learned
    raw = M.score_raw_laps(model, laps)
    assert "Range (" in laps._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in raw._jdf.queryExecution().optimizedPlan().toString()
    want = {r.lap_id: r.prediction for r in M.score_laps(model, rows).collect()}
    got = {r.lap_id: r.prediction for r in raw.collect()}
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
