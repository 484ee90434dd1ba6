"""The forest as a node table against MLlib and against DuckDB over the same table; the saved
feature stage on laps of another session."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lapstats.operators import forest as FT
from lapstats.operators import model as M
from lapstats.operators.panel import detect_pit_stops
from lapstats.sources.lapfiles import scratch_path

NAMES = ["tire_age", "lap_number", "position"]


@pytest.fixture(scope="module")
def laps(spark):
    return spark.range(3000).selectExpr(
        "id as lap_id", "cast(id * 7919 % 31 as int) as tire_age", "cast(id % 60 as int) as lap_number",
        "if(id % 50 = 0, null, double(id * 13 % 20)) as position",
        "80 + (id * 7919 % 31) * 0.11 + (id % 60) * 0.03 + (id * 31 % 17) * 0.05 as lap_time")


@pytest.fixture(scope="module")
def model(laps):
    return M.fit_degradation_model(laps, NAMES, num_trees=7, max_depth=5)


def test_scores_equal_the_model_and_duckdb(spark, laps, model):
    nodes = FT.forest_nodes(model, spark)
    got = {r.lap_id: r.prediction for r in FT.score_with_nodes(laps, nodes, NAMES, depth=5).collect()}
    want = {r.lap_id: r.prediction for r in M.score_laps(model, laps).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    con = duckdb.connect()
    con.register("nodes", nodes.toPandas())
    con.register("laps", laps.dropna().toPandas())
    sql = """WITH RECURSIVE x AS (SELECT lap_id, unnest(['tire_age', 'lap_number', 'position']) AS feature,
      unnest([tire_age::DOUBLE, lap_number::DOUBLE, position]) AS value FROM laps),
    walk(lap_id, tree, node) AS (SELECT lap_id, tree, 0 FROM laps, (SELECT DISTINCT tree FROM nodes)
      UNION ALL SELECT w.lap_id, w.tree, CASE WHEN x.value <= n.threshold THEN n.left_child ELSE n.right_child END
      FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN x ON x.lap_id = w.lap_id AND x.feature = n.feature)
    SELECT lap_id, sum(prediction) / 7 FROM walk JOIN nodes USING (tree, node) WHERE feature_index < 0 GROUP BY lap_id"""
    duck = dict(con.execute(sql).fetchall())
    assert duck.keys() == got.keys() and all(abs(got[k] - duck[k]) < 1e-9 for k in got)


def test_importances_equal_the_model(spark, model):
    got = {r.feature: r.importance for r in FT.importance_from_nodes(FT.forest_nodes(model, spark)).collect()}
    want = {r.feature: r.importance for r in M.feature_importance(model, spark).collect()}
    assert all(abs(got.get(k, 0.0) - v) < 1e-9 for k, v in want.items()) and abs(sum(got.values()) - 1) < 1e-9


def test_scoring_moves_no_laps(spark, laps, model):
    plan = FT.score_with_nodes(laps, FT.forest_nodes(model, spark), NAMES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_loaded_model_scores_raw_laps_of_another_session(spark):
    import __spark_entry__  # noqa: F401
    from lapstats import testview as tv
    from lapstats.operators import clean
    all_laps = clean.normalise_columns(clean.remove_invalid_laps(tv.laps(spark, "/root/testdata/sf0.001")))
    first, other = all_laps.where("year < 2023"), all_laps.where("year >= 2023")
    learned = M.FeatureStage.fit(first)
    model = M.fit_degradation_model(learned.transform(first, detect_pit_stops(first)), num_trees=3, max_depth=3)
    model.stage = learned
    path = scratch_path(spark, "t-model")
    M.save_model(model, path)
    back = M.load_model(path)
    assert back.stage.gap_median == learned.gap_median
    score = lambda m: {r.lap_id: (r.driver_encoded, r.prediction) for r in M.score_raw_laps(
        m, other, detect_pit_stops(other)).collect()}
    a, b = score(model), score(back)
    assert a and a == b
    codes = {r.value: r.code for r in back.stage.codes.where("column_name = 'driver'").collect()}
    known = {r.driver: r.driver_encoded for r in M.score_raw_laps(back, other).select("driver", "driver_encoded").distinct().collect()}
    assert all(codes[d] == c for d, c in known.items() if d in codes) and len(set(known.values())) == len(known)
    assert M.load_model(path + "-nothing") is None
    spark.read.text(path + "/meta").selectExpr("replace(value, 'features', 'x') as value").write.text(path + "-broken/meta")
    with pytest.raises(Exception):
        M.load_model(path + "-broken")
