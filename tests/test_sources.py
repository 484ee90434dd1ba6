"""Sources, sinks and model persistence (S1-S12) on small inline inputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lapstats.operators import model as M
from lapstats.sources import lapfiles as S


def _raw(spark, lap_time_type):
    rows = [("HAM", 1, 85.5, "SOFT", 1, "1", None), ("HAM", 2, 59.0, "SOFT", 2, "1", 3.0),
            ("VER", 1, 90.25, "HARD", 1, "4", 1.0), ("VER", 2, 181.0, "HARD", 2, "1", 1.0),
            ("LEC", 1, 100.0, "MEDIUM", 5, "1", 2.0)]
    df = spark.createDataFrame(rows, "Driver string, LapNumber int, secs double, Compound string, TyreLife int, "
                                     "TrackStatus string, Position double")
    if lap_time_type == "interval":
        lt = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("secs").cast("decimal(18,6)"))
    elif lap_time_type == "string":
        lt = F.concat(F.floor(F.col("secs") / 60).cast("string"), F.lit(":"),
                      F.format_string("%06.3f", F.col("secs") % 60))
    else:
        lt = F.col("secs")
    return df.withColumn("LapTime", lt).drop("secs")


@pytest.mark.parametrize("kind", ["interval", "string", "double"])
def test_ingest_race_laps_any_lap_time_type(spark, kind):
    out = S.ingest_race_laps(_raw(spark, kind), 2023, "monza").orderBy("driver").collect()
    assert [(r.driver, r.lap_time, r.position, r.gap_to_leader) for r in out] == \
        [("HAM", 85.5, 20.0, 9.5), ("LEC", 100.0, 2.0, 0.5)]
    assert {r.year for r in out} == {2023} and {r.circuit for r in out} == {"monza"}


def test_ingest_session_defaults(spark):
    out = S.ingest_session_laps(_raw(spark, "double"), "Q", 2023, "monza").collect()
    assert all(r.stint == 1 and r.is_personal_best is False and r.session_type == "Q" for r in out)


def test_append_plain_and_idempotent(spark):
    df = S.ingest_race_laps(_raw(spark, "double"), 2023, "monza")
    a, b = S.scratch_path(spark, "t-append"), S.scratch_path(spark, "t-idem")
    for _ in range(2):
        S.append_table(df, a)
        S.append_table(df, b, idempotent=True)
    assert spark.read.parquet(a).count() == 4 and spark.read.parquet(b).count() == 2
    race, pits = S.load_combined(spark, a, b, years=[2023], circuits=["spa"])
    assert race.count() == 0 and pits.count() == 0


def test_adhoc_sql_raises(spark):
    with pytest.raises(Exception):
        S.adhoc_sql(spark, "select no_such_column from t", {"t": spark.range(3)}).collect()


def test_adhoc_sql_takes_any_shape(spark):
    """Leading comments, WITH, WITH RECURSIVE, quoted names; the caller's view comes back."""
    spark.range(7).createOrReplaceTempView("t")
    t = {"t": spark.range(3), "my laps": spark.range(5)}
    count = lambda q: S.adhoc_sql(spark, q, t).first()[0]
    assert count("-- a remark with select\n/* and another */ select count(*) from t") == 3
    assert count("with u as (select id + 1 as id from t) select sum(id) from u") == 6
    assert count("WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 4) SELECT sum(n) + (SELECT count(*) FROM t) FROM r") == 13
    assert count("select count(*) from `my laps` where 'from t' <> ''") == 5
    assert spark.table("t").count() == 7 and not spark.catalog.tableExists("`my laps`")
    spark.catalog.dropTempView("t")


def test_half_broken_file_is_reported(spark):
    """A file whose second row group is damaged gives its first rows; the footer tells the rest."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    root = S.scratch_path(spark, "t-half")
    spark.range(1).write.parquet(root)      # makes the folder
    base = root.removeprefix("file:")
    row = {"Driver": "HAM", "LapNumber": 1, "LapTime": 90_000_000, "Compound": "SOFT", "TyreLife": 3, "Stint": 1,
           "TrackStatus": "1", "Position": 2.0, "IsPersonalBest": False}
    schema = S.LANDING_SCHEMA
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "bigint": pa.int64(),
             "interval day to second": pa.int64()}
    fields = [(f.name, kinds[f.dataType.simpleString()]) for f in schema if f.name not in ("year", "circuit")]
    full = pa.table({n: pa.array([row.get(n)] * 40_000, t) for n, t in fields})
    for circuit in ("monza", "spa", "monaco"):
        os.makedirs(f"{base}/landing/year=2023/circuit={circuit}")
        pq.write_table(full, f"{base}/landing/year=2023/circuit={circuit}/a.parquet", row_group_size=20_000, compression="none",
                       use_dictionary=False)
    pq.write_table(full.slice(0, 0), f"{base}/landing/year=2023/circuit=spa/empty.parquet")
    name = f"{base}/landing/year=2023/circuit=monza/a.parquet"
    start = pq.read_metadata(name).row_group(1).column(0).data_page_offset
    with open(name, "r+b") as f:
        f.seek(start)
        f.write(b"\xff" * 4096)
    with open(f"{base}/landing/year=2023/circuit=monaco/junk.parquet", "wb") as f:
        f.write(b"junk" * 20)
    _, report = S.ingest_all(spark, f"{base}/landing", years=[2023], circuits=["monza", "spa", "monaco"])
    got = {r.circuit: (r.lost_rows, r.bad_files, r.ok) for r in report.collect()}
    assert got == {"monza": (20_000, 0, False), "spa": (0, 0, True), "monaco": (0, 1, False)}


def test_duplicates_are_compared_in_full(spark):
    from lapstats.operators import stats
    rows = [(1, None, "a"), (None, 1, "a"), (1, None, "a"), (2, 2, None), (2, 2, None), (2, 2, None), (None, None, None)]
    df = spark.createDataFrame(rows, "x int, y int, z string")
    assert sorted(((r.x, r.y, r.z, r.extra_copies) for r in stats.duplicate_rows(df).collect()), key=repr) == \
        sorted([(1, None, "a", 1), (2, 2, None, 2)], key=repr)
    assert stats.data_quality(df).first().duplicate_rows == 3


def test_plans_json_roundtrip(spark):
    df = spark.createDataFrame([([20], ["SOFT", "MEDIUM"], "single_stop")],
                               "pit_laps array<int>, compounds array<string>, plan_type string")
    r = S.plans_from_json(S.plans_to_json(df)).first()
    assert r.plan_json == '{"pit_stops":[20],"compounds":["SOFT","MEDIUM"],"type":"single_stop"}'
    assert r.pit_laps_parsed == [20] and r.compounds_parsed == ["SOFT", "MEDIUM"]


def test_run_metrics_accumulate(spark):
    path = S.scratch_path(spark, "t-metrics")
    S.append_run_metrics(spark, {"r2": 0.8, "mae": 0.4}, path)
    S.append_run_metrics(spark, {"r2": 0.9}, path)
    assert spark.read.parquet(path).count() == 3


def test_model_fit_persist_and_gates(spark):
    import random
    rnd = random.Random(42)
    rows = []
    for i in range(120):
        age = 1 + i % 29
        soft, hard = int(i % 3 == 0), int(i % 3 == 2)
        rows.append((age, soft, 1 - soft - hard, hard, 82 + 0.05 * age - soft + hard + rnd.gauss(0, 0.2)))
    df = spark.createDataFrame(rows, "tyre_life int, compound_SOFT int, compound_MEDIUM int, compound_HARD int, "
                                     "lap_time double")
    feats = ["tyre_life", "compound_SOFT", "compound_MEDIUM", "compound_HARD"]
    m = M.fit_degradation_model(df, feats, num_trees=20, max_depth=5)
    imp = M.feature_importance(m, spark).collect()
    assert len(imp) == 4 and abs(sum(r.importance for r in imp) - 1) < 1e-3
    with pytest.raises(ValueError):
        M.score_laps(m, df.drop("tyre_life"))
    with pytest.raises(ValueError):
        M.score_laps(None, df)
    p1 = M.score_laps(m, df).select("prediction").collect()
    path = S.scratch_path(spark, "t-model")
    M.save_model(m, path)
    back = M.load_model(path)
    assert back.features == feats and [r.prediction for r in M.score_laps(back, df).select("prediction").collect()] \
        == [r.prediction for r in p1]
    assert M.load_model(path + "-absent") is None
    again = M.fit_degradation_model(df, feats, num_trees=20, max_depth=5)
    assert [r.prediction for r in M.score_laps(again, df).select("prediction").collect()] == \
        [r.prediction for r in p1]
    gate = M.quality_gate(M.evaluate_model(m, df)).first()
    assert gate.retrain == (gate.r2 < 0.75)


def test_streaming_ingest_matches_batch(spark):
    from lapstats.streaming.ingest import start_race_laps_ingest
    raw = _raw(spark, "interval").withColumn("year", F.lit(2023)).withColumn("circuit", F.lit("monza"))
    landing, table = S.scratch_path(spark, "t-landing"), S.scratch_path(spark, "t-stream")
    raw.write.partitionBy("year", "circuit").parquet(landing)
    q = start_race_laps_ingest(spark, landing, table, S.scratch_path(spark, "t-ckpt"), trigger_once=True)
    q.awaitTermination()
    got = sorted((r.driver, r.lap_time) for r in spark.read.parquet(table).collect())
    assert got == [("HAM", 85.5), ("LEC", 100.0)]


def test_ingest_all_skips_corrupt_files(spark):
    raw = _raw(spark, "interval").withColumn("year", F.lit(2023)).withColumn("circuit", F.lit("monza"))
    landing = S.scratch_path(spark, "t-corrupt")
    raw.write.partitionBy("year", "circuit").parquet(landing)
    bad_dir = os.path.join(landing, "year=2022", "circuit=spa")
    os.makedirs(bad_dir)
    with open(os.path.join(bad_dir, "part-broken.parquet"), "wb") as fh:
        fh.write(b"not a parquet file")
    race, report = S.ingest_all(spark, landing)
    assert race.count() == 2
    rows = {(r.year, r.circuit): (r.rows, r.ok) for r in report.collect()}
    assert rows[(2023, "monza")] == (2, True) and rows[(2022, "spa")] == (0, False)
    assert report.first().ok_units == 1 and report.first().total_units == 20
