"""Registered queries for sources/sinks (S1-S12) and model operators.

Sink queries write under a fresh folder of the shared checkpoint folder and read the
result back, so the check covers the round trip. Model queries share one fitted
model per (session, input) to avoid refitting the forest for every report.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle_sql as O
from . import testview as tv
from .catalog import _round, features, laps, query, valid
from .catalog_plans import GRID26
from .oracle_sql import L, SQL, VALID, w
from .operators import clean, forest as FT, model as M, panel, stats
from .operators.ledger import Ledger
from .plans import race as R
from .sources import lapfiles as S
from .staging import stage


def raw_laps(spark, sf, with_optional=True):
    """The lap view in the raw source shape (interval lap times, source column names)."""
    l = laps(spark, sf)
    cols = [F.col("driver").alias("Driver"), F.col("lap_number").alias("LapNumber"),
            clean.seconds_to_interval("lap_time").alias("LapTime"), F.col("compound").alias("Compound"),
            F.col("tyre_life").alias("TyreLife"), F.col("track_status").alias("TrackStatus"),
            F.col("position").alias("Position"), "year", "circuit"]
    if with_optional:
        cols += [F.col("stint").alias("Stint"), (F.col("lap_id") % 13 == 0).alias("IsPersonalBest")]
    return l.select(*cols)


SECS = "cast(cast(lap_time as decimal(18,6)) as double)"
S1 = L + f""", r as (select *, {SECS} as secs from laps where {SECS} between 60 and 180 and track_status = '1')"""


@query
def q_ingest_race_laps(spark, sf):
    return S.ingest_race_laps(raw_laps(spark, sf))


SQL["ingest_race_laps"] = S1 + """ select year, circuit, driver, lap_number, secs as lap_time, compound as tire_compound,
 tyre_life as tire_age, track_status, coalesce(position, 20.0) as position, (coalesce(position, 20.0) - 1) * 0.5
 as gap_to_leader from r"""


@query
def q_ingest_session_laps(spark, sf):
    return S.ingest_session_laps(raw_laps(spark, sf, with_optional=False), "R")


SQL["ingest_session_laps"] = S1 + """ select year, circuit, 'R' as session_type, driver, lap_number, secs as lap_time,
 compound, 1 as stint, tyre_life, track_status, false as is_personal_best from r"""


@query
def q_ingest_all(spark, sf):
    """S3 on one file per unit; one unit has a broken file beside its good one."""
    path = S.scratch_path(spark, "landing")
    raw_laps(spark, sf).repartition("year", "circuit").write.partitionBy("year", "circuit").parquet(path)
    spark.range(1).selectExpr("'not a lap file' as value").coalesce(1).write.mode("append").text(path + "/year=2022/circuit=monza/")
    _, report = S.ingest_all(spark, path)
    return report


SQL["ingest_all"] = S1 + """, g as (select y.year, c.circuit from (values (2021), (2022), (2023), (2024)) y(year),
 (values ('monaco'), ('silverstone'), ('monza'), ('spa'), ('suzuka')) c(circuit)),
k as (select year, circuit, 0 as broken from laps group by 1, 2 union all select 2022, 'monza', 1),
u as (select g.year, g.circuit, cast(coalesce(n.rows, 0) as bigint) as rows, coalesce(m.files, 0) as files,
 cast(coalesce(m.bad, 0) as bigint) as bad_files from g left join
 (select year, circuit, count(*) as rows from r group by 1, 2) n on g.year = n.year and g.circuit = n.circuit left join
 (select year, circuit, count(*) as files, sum(broken) as bad from k group by 1, 2) m on g.year = m.year and g.circuit = m.circuit)
select year, circuit, rows, files, bad_files, cast(0 as bigint) as bad_records, cast(0 as bigint) as lost_rows, rows > 0 and bad_files = 0 as ok,
 (select count(*) filter (where rows > 0 and bad_files = 0) from u) as ok_units, (select count(*) from u) as total_units from u"""


@query
def q_append_laps(spark, sf):
    """Appending twice duplicates rows; the idempotent mode keeps one copy."""
    v = valid(spark, sf).select("year", "circuit", "driver", "lap_number", "lap_time", "tire_compound", "tire_age")
    a, b = S.scratch_path(spark, "append"), S.scratch_path(spark, "idem")
    for _ in range(2):
        S.append_table(v, a)
        S.append_table(v, b, idempotent=True)
    ra = spark.read.parquet(a).groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("rows_append"))
    rb = spark.read.parquet(b).groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("rows_idempotent"))
    return ra.join(rb, ["year", "circuit"], "full")


SQL["append_laps"] = w(tv.LAPS_CTE, VALID) + """select year, circuit, 2 * count(*) as rows_append,
 count(*) as rows_idempotent from valid group by 1, 2"""


@query
def q_append_pits(spark, sf):
    """S4 for pit stops: two plain appends double the rows, idempotent appends do not."""
    p = panel.detect_pit_stops(laps(spark, sf))
    a, b = S.scratch_path(spark, "pits_append"), S.scratch_path(spark, "pits_idem")
    for _ in range(2):
        S.append_table(p, a)
        S.append_table(p, b, idempotent=True)
    ra = spark.read.parquet(a).groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("rows_append"))
    rb = spark.read.parquet(b).groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("rows_idempotent"))
    return ra.join(rb, ["year", "circuit"], "full")


SQL["append_pits"] = L + """, p as (select year, circuit from (select year, circuit, compound, lag(compound) over w as pc,
 lag(tyre_life) over w as pt, lag(lap_number) over w as ps, tyre_life as t from laps
 window w as (partition by year, circuit, driver order by lap_number, lap_id))
 where ps is not null and (compound is distinct from pc or coalesce(t < pt, false)))
select year, circuit, 2 * count(*) as rows_append, count(*) as rows_idempotent from p group by 1, 2"""


@query
def q_stream_ingest_race_laps(spark, sf):
    """S1 as a stream: raw lap files land partitioned by year/circuit, the stream runs
    to completion (availableNow) into the race table, which is read back."""
    from .streaming.ingest import start_race_laps_ingest
    landing, table = S.scratch_path(spark, "landing"), S.scratch_path(spark, "race_stream")
    raw_laps(spark, sf).write.partitionBy("year", "circuit").parquet(landing)
    q = start_race_laps_ingest(spark, landing, table, S.scratch_path(spark, "stream_ckpt"), trigger_once=True)
    q.awaitTermination()
    return spark.read.parquet(table).select("year", "circuit", "driver", "lap_number", "lap_time", "tire_compound",
                                            "tire_age", "track_status", "position", "gap_to_leader")


SQL["stream_ingest_race_laps"] = SQL["ingest_race_laps"]


@query
def q_load_combined(spark, sf):
    l = laps(spark, sf)
    rp, pp = S.scratch_path(spark, "race_data"), S.scratch_path(spark, "pit_stops")
    S.append_table(S.ingest_race_laps(raw_laps(spark, sf)), rp)
    S.append_table(panel.detect_pit_stops(l), pp)
    race, pits = S.load_combined(spark, rp, pp, years=[2022, 2023], circuits=["monza", "spa"])
    rc = race.groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("race_rows"))
    pc = pits.groupBy("year", "circuit").agg(F.count(F.lit(1)).alias("pit_rows"))
    return rc.join(pc, ["year", "circuit"], "full")


SQL["load_combined"] = S1 + """, pits as (select year, circuit from (select year, circuit, lap_number, compound,
 lag(compound) over w as pc, lag(tyre_life) over w as pt, lag(lap_number) over w as ps, tyre_life as t
 from laps window w as (partition by year, circuit, driver order by lap_number, lap_id))
 where ps is not null and (compound is distinct from pc or coalesce(t < pt, false)))
select coalesce(a.year, b.year) as year, coalesce(a.circuit, b.circuit) as circuit, a.race_rows, b.pit_rows from
 (select year, circuit, count(*) as race_rows from r where year in (2022, 2023) and circuit in ('monza', 'spa') group by 1, 2) a
 full join (select year, circuit, count(*) as pit_rows from pits where year in (2022, 2023) and circuit in ('monza', 'spa')
 group by 1, 2) b on a.year = b.year and a.circuit = b.circuit"""


@query
def q_load_all_laps(spark, sf):
    path = S.scratch_path(spark, "laps")
    S.append_table(S.ingest_session_laps(raw_laps(spark, sf), "R"), path)
    return S.load_all_laps(spark, path).select("year", "circuit", "session_type", "driver", "lap_number", "lap_time",
                                               "compound", "stint", "tyre_life", "track_status", "is_personal_best")


SQL["load_all_laps"] = S1 + """ select year, circuit, 'R' as session_type, driver, lap_number, secs as lap_time,
 compound, coalesce(stint, 1) as stint, tyre_life, track_status, coalesce(lap_id % 13 = 0, false) as is_personal_best from r"""


@query
def q_available_sessions(spark, sf):
    s = S.ingest_session_laps(raw_laps(spark, sf), "R")
    q = S.ingest_session_laps(raw_laps(spark, sf).withColumn("year", F.col("year") + 1), "Q")
    return S.available_sessions(stats.union_laps(s, q))


SQL["available_sessions"] = S1 + """ select distinct year, circuit, 'R' as session_type from r union
  select distinct year + 1, circuit, 'Q' from r"""

ADHOC = "select circuit, count(*) as laps, round(avg(lap_time), 6) as mean_lap_time from laps group by circuit"


@query
def q_adhoc_sql(spark, sf):
    return S.adhoc_sql(spark, ADHOC, {"laps": laps(spark, sf)})


SQL["adhoc_sql"] = L + ADHOC


@query
def q_table_inventory(spark, sf):
    l = laps(spark, sf)
    return S.table_inventory({"laps": l, "pit_stops": panel.detect_pit_stops(l), "races": tv.races(l)})


SQL["table_inventory"] = w(tv.LAPS_CTE, tv.RACES_CTE) + """, pits as (select * from (select lag(lap_number) over w as ps,
 compound, lag(compound) over w as pc, tyre_life as t, lag(tyre_life) over w as pt from laps
 window w as (partition by year, circuit, driver order by lap_number, lap_id))
 where ps is not null and (compound is distinct from pc or coalesce(t < pt, false)))
select 'laps' as table_name, count(*) as rows from laps union all select 'pit_stops', count(*) from pits
 union all select 'races', count(*) from races"""


@query
def q_plans_json_roundtrip(spark, sf):
    g = R.plan_grid(tv.races(laps(spark, sf)))
    j = S.plans_from_json(S.plans_to_json(g))
    ok = (F.col("pit_laps") == F.col("pit_laps_parsed")) & (F.col("compounds") == F.col("compounds_parsed")) & \
        (F.col("plan_type") == F.col("plan_type_parsed"))
    return j.select("year", "circuit", "option_idx", "plan_json", ok.alias("roundtrip_ok"))


@query
def q_plans_to_json(spark, sf):
    g = R.plan_grid(tv.races(laps(spark, sf)))
    return S.plans_to_json(g).select("year", "circuit", "option_idx", "plan_json")


@query
def q_plans_from_json(spark, sf):
    docs = q_plans_to_json(spark, sf)
    back = S.plans_from_json(docs)
    return back.select("year", "circuit", "option_idx",
                       F.array_join(F.transform("pit_laps_parsed", lambda x: x.cast("string")), ",").alias("pit_laps"),
                       F.array_join("compounds_parsed", ",").alias("compounds"),
                       F.col("plan_type_parsed").alias("plan_type"))


# --- rows-only: sinks with timestamps, models --------------------------------
@query
def q_append_run_metrics(spark, sf):
    v = valid(spark, sf).agg(F.count(F.lit(1)).cast("double").alias("rows"), F.avg("lap_time").alias("mean_lap_time"))
    path = S.scratch_path(spark, "run_metrics")
    for names in (["rows", "mean_lap_time"], ["rows"]):
        S.append_metric_rows(v.select(*names).unpivot([], names, "metric", "value"), path)
    return spark.read.parquet(path).select("metric", F.round("value", 6).alias("value"))


_MODELS: dict = {}      # folders of the last fitted model and its split, by application and input


def fitted(spark, sf):
    """A forest fitted on the engineered laps, and the split, which is read from the shared folder:
    made once for the queries of the model, with nothing cached."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        l = laps(spark, sf)
        good = clean.normalise_columns(stage(clean.remove_invalid_laps(l), "clean"))
        learned = M.FeatureStage.fit(good)
        split = M.training_split(learned.transform(good, panel.detect_pit_stops(l)))
        m = M.fit_degradation_model(split.where(~F.col("is_test")))
        m.stage = learned
        _MODELS.clear()
        _MODELS[key] = (m, split)
    return _MODELS[key]


@query
def q_fit_degradation_model(spark, sf):
    m, _ = fitted(spark, sf)
    return spark.createDataFrame([(k, float(v) if v is not None else None) for k, v in sorted(m.metrics.items())
                                  if k.startswith("train")], "metric string, value double")


@query
def q_score_laps(spark, sf):
    m, split = fitted(spark, sf)
    return _round(M.score_laps(m, split.where(F.col("is_test"))).select("lap_id", "lap_time", "prediction"),
                  ["prediction"])


@query
def q_evaluate_model(spark, sf):
    m, split = fitted(spark, sf)
    return M.evaluate_model(m, split.where(F.col("is_test")))


@query
def q_feature_importance(spark, sf):
    m, _ = fitted(spark, sf)
    return M.feature_importance(m, spark)


@query
def q_top_features(spark, sf):
    m, _ = fitted(spark, sf)
    return M.feature_importance(m, spark, top=10)


@query
def q_model_summary(spark, sf):
    m, _ = fitted(spark, sf)
    return M.model_summary(m, spark)


@query
def q_score_condition_grid(spark, sf):
    m, split = fitted(spark, sf)
    return _round(M.score_condition_grid(m, split), ["prediction"])


@query
def q_quality_gate(spark, sf):
    m, split = fitted(spark, sf)
    return M.quality_gate(M.evaluate_model(m, split.where(F.col("is_test"))))


@query
def q_optimal_pit_lap_forest(spark, sf):
    """G6 planned with the fitted forest: scored once on the (circuit, compound, age)
    grid, turned into the cumulative lap-cost table, joined to every state."""
    from .plans import lapmodel as LM
    m, split = fitted(spark, sf)
    st = tv.states(laps(spark, sf))
    cum = LM.cumulative_lap_table(M.forest_lap_times(m, split))
    return _round(LM.optimal_pit_lap_with(st, cum), ["estimated_total_time"])


@query
def q_recommend_plans_forest(spark, sf):
    """G9 with lap times from the fitted forest (via the cumulative lap-cost table)."""
    from .plans import lapmodel as LM
    from .plans import state as PS
    m, split = fitted(spark, sf)
    st = tv.states(laps(spark, sf))
    cum = LM.cumulative_lap_table(M.forest_lap_times(m, split))
    r = PS.recommend_plans(st, cum_table=cum)
    return _round(r.select("state_id", "rank", "plan_kind", F.array_join(F.transform("pit_laps", lambda x: x.cast(
        "string")), ",").alias("pit_laps"), "total_time", "confidence_score", "risk_level"),
        ["total_time", "confidence_score"])


@query
def q_train_pipeline(spark, sf):
    l = laps(spark, sf)
    _, metrics = M.train_pipeline(l, panel.detect_pit_stops(l))
    return metrics


@query
def q_save_model(spark, sf):
    """S12 save: pipeline + metadata written; the metadata document is read back."""
    m, _ = fitted(spark, sf)
    path = S.scratch_path(spark, "model")
    M.save_model(m, path)
    return spark.read.text(f"{path}/meta")


@query
def q_save_load_model(spark, sf):
    m, split = fitted(spark, sf)
    path = S.scratch_path(spark, "model")
    M.save_model(m, path)
    back = M.load_model(path)
    a = M.score_laps(m, split.where(F.col("is_test"))).select("lap_id", F.col("prediction").alias("p1"))
    b = M.score_laps(back, split.where(F.col("is_test"))).select("lap_id", F.col("prediction").alias("p2"))
    return a.join(b, "lap_id").select("lap_id", (F.col("p1") == F.col("p2")).alias("same_prediction"),
                                      F.lit(M.load_model(path + "-missing") is None).alias("missing_is_none"))


@query
def q_load_model(spark, sf):
    """S12 load: per test lap, whether the loaded model's prediction is the original's, and its
    features and target are the saved ones."""
    m, split = fitted(spark, sf)
    path = S.scratch_path(spark, "model")
    M.save_model(m, path)
    back = M.load_model(path)
    test = split.where("is_test")
    both = M.score_laps(back, M.score_laps(m, test).withColumnRenamed("prediction", "p1"))
    return both.select("lap_id", (F.col("p1") == F.col("prediction")).alias("same_prediction"),
                       F.lit(back.features == m.features and back.target == m.target).alias("same_meta"))


# --- properties of the model that SQL can check ---------------------------------
FEAT_SPLIT = w(tv.LAPS_CTE, O.PITS, O.FEAT) + ", split as (" + O.SPLIT.format(src="feat") + "), labelled as " \
    "(select f.*, s.is_test from feat f join split s on f.lap_id = s.lap_id)"


@query
def q_score_laps_bounded(spark, sf):
    """M2: every test lap is scored, within the range of the training target."""
    m, split = fitted(spark, sf)
    lo, hi = split.where("not is_test").agg(F.min("lap_time"), F.max("lap_time")).first()
    s = M.score_laps(m, split.where("is_test"))
    return s.select("lap_id", F.col("prediction").between(lo - 1e-9, hi + 1e-9).alias("in_range"))


SQL["score_laps_bounded"] = FEAT_SPLIT + " select lap_id, true as in_range from labelled where is_test"
SQL["save_load_model"] = FEAT_SPLIT + """ select lap_id, true as same_prediction, true as missing_is_none
 from labelled where is_test"""
SQL["load_model"] = FEAT_SPLIT + " select lap_id, true as same_prediction, true as same_meta from labelled where is_test"


@query
def q_score_raw_laps(spark, sf):
    """A loaded model's own codes and median turn raw laps into features and give every
    lap the prediction that the fitted one gives its engineered row."""
    m, split = fitted(spark, sf)
    path = S.scratch_path(spark, "model")
    M.save_model(m, path)
    l = laps(spark, sf)
    raw = M.score_raw_laps(M.load_model(path), clean.remove_invalid_laps(l), panel.detect_pit_stops(l))
    a = raw.select("lap_id", F.col("prediction").alias("p1"))
    b = M.score_laps(m, split).select("lap_id", F.col("prediction").alias("p2"))
    return a.join(b, "lap_id", "full").select("lap_id", F.coalesce(F.abs(F.col("p1") - F.col("p2")) < 1e-9, F.lit(False)).alias("same_prediction"))


SQL["score_raw_laps"] = FEAT_SPLIT + " select lap_id, true as same_prediction from labelled"


@query
def q_forest_table_scores(spark, sf):
    """M2, M3: the node table's prediction of every test lap is the model's."""
    m, split = fitted(spark, sf)
    both = FT.score_with_nodes(M.score_laps(m, split.where("is_test")).withColumnRenamed("prediction", "p1"),
                               FT.forest_nodes(m, spark), m.features)
    return both.select("lap_id", (F.abs(F.col("p1") - F.col("prediction")) < 1e-9).alias("same_prediction"))


SQL["forest_table_scores"] = FEAT_SPLIT + " select lap_id, true as same_prediction from labelled where is_test"


@query
def q_forest_table_importance(spark, sf):
    """The importances computed from the node table are the model's, feature by feature."""
    m, _ = fitted(spark, sf)
    own = M.feature_importance(m, spark).withColumnRenamed("importance", "p1")
    j = own.join(FT.importance_from_nodes(FT.forest_nodes(m, spark)), "feature", "left")
    return j.select("feature", (F.abs(F.col("p1") - F.coalesce("importance", F.lit(0.0))) < 1e-9).alias("same_importance"))


SQL["forest_table_importance"] = "select feature, n > 0 as same_importance from (values " + ", ".join(
    f"('{c}')" for c in panel.FEATURES) + ") t(feature), (select count(*) as n from events) e"


@query
def q_forest_table_metrics(spark, sf):
    """Test metrics of the node table's predictions next to the model's own."""
    m, split = fitted(spark, sf)
    test = split.where("is_test")
    a = M.evaluate_model(m, test)
    b = stats.regression_metrics(FT.score_with_nodes(test, FT.forest_nodes(m, spark), m.features), "lap_time", "prediction")
    names = ["r2", "mae", "rmse"]
    j = a.select(*[F.col(c).alias(f"a_{c}") for c in names], "n").crossJoin(F.broadcast(b.select(*names)))     # one row each
    return j.select("n", *[(F.abs(F.col(f"a_{c}") - F.col(c)) < 1e-6).alias(f"same_{c}") for c in names])


SQL["forest_table_metrics"] = FEAT_SPLIT + """ select count(*) as n, true as same_r2, true as same_mae, true as same_rmse
 from labelled where is_test"""


@query
def q_feature_importance_shape(spark, sf):
    """The fourteen features by name, none negative, sum 1, the top ten the largest."""
    m, _ = fitted(spark, sf)
    f = M.feature_importance(m, spark)
    name, value = f.columns[0], f.columns[1]
    top = M.feature_importance(m, spark, top=10).agg(F.min(value).alias("_least"), F.count(F.lit(1)).alias("_n"))
    tot = f.agg(F.round(F.sum(value), 6).alias("_sum"))
    return (f.crossJoin(tot).crossJoin(top).select(
        F.col(name).alias("feature"), (F.col(value) >= 0).alias("not_negative"), (F.col("_sum") == 1).alias("sums_to_one"),
        (F.col("_n") == 10).alias("ten_on_top")))


SQL["feature_importance_shape"] = "select * from (values " + ", ".join(
    f"('{c}', true, true, true)" for c in panel.FEATURES) + ") t(feature, not_negative, sums_to_one, ten_on_top), " \
    "(select count(*) as n from events) e where n > 0"
SQL["feature_importance_shape"] = SQL["feature_importance_shape"].replace("select * from", "select feature, not_negative, sums_to_one, ten_on_top from", 1)


@query
def q_condition_grid_cells(spark, sf):
    """M6: every circuit and compound of the features at each tyre age, all scored."""
    m, split = fitted(spark, sf)
    return M.score_condition_grid(m, split).select(
        "circuit", "tire_compound", "tire_age", F.col("prediction").isNotNull().alias("scored"))


SQL["condition_grid_cells"] = FEAT_SPLIT + """ select circuit, tire_compound, age as tire_age, true as scored from
 (select distinct circuit, tire_compound from labelled) g, (values (5), (15), (25)) a(age)"""


@query
def q_evaluate_model_target(spark, sf):
    """Rows, mean and deviation of the test target, which do not depend on the fit."""
    m, split = fitted(spark, sf)
    return M.evaluate_model(m, split.where("is_test")).select("n", "target_mean", "target_std")


SQL["evaluate_model_target"] = FEAT_SPLIT + """ select count(*) as n, round(avg(lap_time), 6) as target_mean,
 round(stddev_samp(lap_time), 6) as target_std from labelled where is_test"""

# --- M8 + A14 (SQL-checkable baseline) ---------------------------------------
@query
def q_linear_degradation(spark, sf):
    return _round(M.linear_degradation(laps(spark, sf)), ["slope", "intercept"])


SQL["linear_degradation"] = L + """select circuit, compound, round(regr_slope(lap_time, tyre_life), 6) as slope,
 round(regr_intercept(lap_time, tyre_life), 6) as intercept, count(*) as n
 from laps where lap_time is not null and tyre_life is not null group by circuit, compound"""


@query
def q_regression_metrics(spark, sf):
    l = laps(spark, sf)
    p = M.linear_predict(l.where(F.col("lap_time").isNotNull()), M.linear_degradation(l))
    return stats.regression_metrics(p.where(F.col("prediction").isNotNull()), "lap_time", "prediction", by=["circuit"])


SQL["regression_metrics"] = L + """, f as (select circuit, compound, regr_slope(lap_time, tyre_life) as s,
 regr_intercept(lap_time, tyre_life) as i from laps where lap_time is not null and tyre_life is not null group by 1, 2),
p as (select l.circuit, l.lap_time as y, f.i + f.s * l.tyre_life as p from laps l join f on l.circuit = f.circuit
 and l.compound = f.compound where l.lap_time is not null and f.i + f.s * l.tyre_life is not null)
select circuit, count(*) as n, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2,
 round(avg(abs(y - p)), 6) as mae, round(sqrt(avg((y - p) * (y - p))), 6) as rmse, round(avg(y), 6) as target_mean,
 round(stddev_samp(y), 6) as target_std from p group by circuit"""


SQL["plans_json_roundtrip"] = w(tv.LAPS_CTE, tv.RACES_CTE) + ", " + GRID26 + """ select year, circuit, option_idx,
 cast(to_json({'pit_stops': case when stops = 1 then [cast(l1 as int)] else [cast(l1 as int), cast(l2 as int)] end,
  'compounds': case when stops = 1 then [c1, c2] else [c1, c2, c3] end, 'type': plan_type}) as varchar) as plan_json,
 true as roundtrip_ok from grid"""


SQL["plans_to_json"] = w(tv.LAPS_CTE, tv.RACES_CTE) + ", " + GRID26 + """ select year, circuit, option_idx,
 cast(to_json({'pit_stops': case when stops = 1 then [cast(l1 as int)] else [cast(l1 as int), cast(l2 as int)] end,
  'compounds': case when stops = 1 then [c1, c2] else [c1, c2, c3] end, 'type': plan_type}) as varchar) as plan_json
 from grid"""
SQL["plans_from_json"] = w(tv.LAPS_CTE, tv.RACES_CTE) + ", " + GRID26 + """ select year, circuit, option_idx,
 cast(l1 as varchar) || coalesce(',' || cast(l2 as varchar), '') as pit_laps,
 c1 || ',' || c2 || coalesce(',' || c3, '') as compounds, plan_type from grid"""

SQL["append_run_metrics"] = w(tv.LAPS_CTE, VALID) + """select 'rows' as metric, cast(count(*) as double) as value from valid
 union all select 'mean_lap_time', round(avg(lap_time), 6) from valid
 union all select 'rows', cast(count(*) as double) from valid"""


@query
def q_quality_gate_linear(spark, sf):
    """M7 gates applied to the linear baseline's per-circuit metrics (SQL-checkable)."""
    return M.quality_gate(q_regression_metrics(spark, sf))


SQL["quality_gate_linear"] = "select *, coalesce(r2 < 0.75, true) as retrain, coalesce(r2 < 0.75, true) as warn_r2, " \
    "coalesce(mae > 0.5, true) as warn_mae from (" + SQL["regression_metrics"] + ")"


# A9-A13, A15 from the ledger: recorded without one session, which is added then; the table is
# not read again by the reports
LEDGER_COLS = ["year", "circuit", "driver", "lap_number", "lap_time", "compound", "stint", "tyre_life", "track_status"]
_LEDGERS: dict = {}


def ledger(spark, sf) -> Ledger:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LEDGERS:
        l = laps(spark, sf).select(*LEDGER_COLS)
        path, late = S.scratch_path(spark, "ledger-laps"), F.col("year").eqNullSafe(2022) & F.col("circuit").eqNullSafe("monza")
        book = Ledger(l, S.scratch_path(spark, "ledger"))
        S.append_table(l.where(~late), path)
        book.record(spark.read.schema(l.schema).parquet(path))
        S.append_table(l.where(late), path)
        book.record(spark.read.schema(l.schema).parquet(path), units=[(2022, "monza")])
        _LEDGERS[key] = book
    return _LEDGERS[key]


@query
def q_ledger_summary(spark, sf):
    return ledger(spark, sf).summary()


@query
def q_ledger_completeness(spark, sf):
    return ledger(spark, sf).completeness()


@query
def q_ledger_quality(spark, sf):
    return ledger(spark, sf).quality()


@query
def q_ledger_metrics(spark, sf):
    return ledger(spark, sf).metrics(["stint", "tyre_life", "lap_number"])


@query
def q_ledger_valid(spark, sf):
    return ledger(spark, sf).valid()


@query
def q_ledger_ingest_report(spark, sf):
    return ledger(spark, sf).ingest_report()


@query
def q_ledger_numbers(spark, sf):
    return ledger(spark, sf).numbers_report().drop("quantiles")


_LC = f"lc as (select {', '.join(LEDGER_COLS)} from laps)"
_GAPS = " + ".join(f"count(*) - count({c})" for c in LEDGER_COLS)
SQL["ledger_summary"] = L + f""", {_LC} select count(*) as rows, {len(LEDGER_COLS)} as columns, min(lap_time) as min_lap_time,
 max(lap_time) as max_lap_time, min(year) as first_year, max(year) as last_year, count(distinct circuit) as circuits from lc"""
SQL["ledger_completeness"] = L + f""", {_LC}, i as (select count(*) as r, {_GAPS} as m from lc), u as (""" + " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as n from lc" for c in LEDGER_COLS) + f""")
select column_name, cast(n as bigint) as missing_count, round(n * 100.0 / r, 6) as missing_percentage,
 round(1 - m / (r * {len(LEDGER_COLS)}), 6) as completeness_score, false as is_valid from u, i where n > 0
union all select null, m, round(m * 100.0 / (r * {len(LEDGER_COLS)}), 6), round(1 - m / (r * {len(LEDGER_COLS)}), 6), m = 0 and r > 0 from i"""
SQL["ledger_quality"] = L + f""", {_LC}, i as (select count(*) as r, {_GAPS} as m from lc),
d as (select cast(coalesce(sum(c - 1), 0) as bigint) as d from (select count(*) as c from lc group by {', '.join(LEDGER_COLS)}))
select r as total_rows, cast(m as bigint) as missing_values, d as duplicate_rows, {len(LEDGER_COLS)} as total_columns,
 'year:int,circuit:string,driver:string,lap_number:int,lap_time:double,compound:string,stint:int,tyre_life:int,track_status:string'
 as column_types, round(greatest(0.0, 1 - 0.5 * m / (r * {len(LEDGER_COLS)}) - 0.3 * d / r), 6) as quality_score from i, d"""
SQL["ledger_metrics"] = L + """ select count(*) as total_rows, 3 as total_features, cast(count(*) filter (where stint is null)
 + count(*) filter (where tyre_life is null) + count(*) filter (where lap_number is null)
 + count(*) filter (where lap_time is null) as bigint) as missing_values, count(distinct driver) as unique_drivers,
 count(distinct circuit) as unique_circuits, cast(min(year) as varchar) || '-' || cast(max(year) as varchar) as year_range,
 printf('%.2f-%.2f', min(lap_time), max(lap_time)) as lap_time_range,
 array_to_string(list_sort(list_distinct(list(compound))), ',') as tire_compounds, count(*) < 1000 as low_volume from laps"""
SQL["ledger_valid"] = L + f""" select count(*) > 0 and {O._BAD.format(life='tyre_life')} = 0 as is_valid, count(*) as rows from laps"""
SQL["ledger_ingest_report"] = SQL["ingest_report"]
SQL["ledger_numbers"] = L + " union all ".join(f""" select '{c}' as column_name, count({c}) as n,
 cast(min({c}) as double) as lo, cast(max({c}) as double) as hi, round(avg({c}), 6) as mean from laps""" for c in ("lap_time", "year"))
