"""The one plan of the ordered operators against DuckDB, on inputs that break careless joins:
null group keys, null values, sums above 2**53 and one key with a third of the rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lapstats.operators import ordering, panel
from lapstats.operators.quantiles import exact_quantiles

SF = "/root/testdata/sf0.001"
SCHEMA = ("year int, circuit string, driver string, lap_number int, compound string, tyre_life int, "
          "lap_time double, position double, lap_id bigint")


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(3000):
        hot = i % 3 == 0
        out.append((2021 if hot else 2021 + i % 4, None if i % 11 == 0 else "spa" if hot else f"c{i % 5}",
                    None if i % 7 == 0 else "HOT" if hot else f"d{i % 40}", (i * 7919) % 3000, ("SOFT", "HARD", None)[i // 9 % 3],
                    None if i % 13 == 0 else i % 25, None if i % 17 == 0 else 80 + i % 50 / 4, None if i % 5 == 0 else float(i % 20), i))
    return out


@pytest.fixture(scope="module")
def laps(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def con(rows):
    c = duckdb.connect()
    import pandas as pd
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    frame = pd.DataFrame({n: pd.array([r[i] for r in rows], dtype={"int": "Int64", "bigint": "Int64", "double": "Float64"}.get(
        SCHEMA.split(", ")[i].split()[1], "string")) for i, n in enumerate(names)})
    c.register("frame", frame)
    c.execute("CREATE TABLE laps AS SELECT * FROM frame")
    return c


W = "(partition by year, circuit, driver order by lap_number nulls first, lap_id)"


def same(df, con, sql):
    norm = lambda rs: sorted(repr(tuple(round(float(v), 6) if isinstance(v, float) else v for v in r)) for r in rs)
    assert norm(map(tuple, df.collect())) == norm(con.execute(sql).fetchall())


def test_lag_and_rolling_means(laps, con):
    same(panel.position_change(laps).select("lap_id", "position_change"), con,
         f"select lap_id, coalesce(position - lag(position) over {W}, 0.0) from laps")
    for n, cur in ((3, True), (5, False), (2, False)):
        end = "current row" if cur else "1 preceding"
        same(panel.rolling_mean(laps, n, out="m", include_current=cur).select("lap_id", "m"), con,
             f"select lap_id, avg(lap_time) over (partition by year, circuit, driver order by lap_number, lap_id "
             f"rows between {n - 1 if cur else n} preceding and {end}) from laps")


def test_pit_stops_and_laps_since(laps, con):
    pits = (f"select year, circuit, driver, lap_number as pit_lap from (select *, lag(compound) over {W} as pc, "
            f"lag(tyre_life) over {W} as pt, lag(lap_number) over {W} as pl from laps) "
            "where pl is not null and (compound is distinct from pc or coalesce(tyre_life < pt, false))")
    found = panel.detect_pit_stops(laps)
    same(found.select("year", "circuit", "driver", "pit_lap"), con, pits)
    same(panel.laps_since_pit(laps, found).select("lap_id", "laps_since_pit"), con,
         f"with p as ({pits}) select lap_id, coalesce(lap_number - (select max(pit_lap) from p where p.pit_lap <= l.lap_number "
         "and p.year is not distinct from l.year and p.circuit is not distinct from l.circuit "
         "and p.driver is not distinct from l.driver), 0) from laps l")


def test_group_aggregates(laps, con):
    same(panel.stint_length(laps, compound="compound", age="tyre_life").select("lap_id", "stint_length"), con,
         "select lap_id, max(tyre_life) over (partition by year, circuit, driver, compound) from laps")
    same(panel.relative_performance(laps).select("lap_id", F.round("relative_performance", 6)), con,
         "select lap_id, round(lap_time / avg(lap_time) over (partition by year, circuit, lap_number), 6) from laps")


def test_running_sum_keeps_large_integers(laps, con):
    big = laps.withColumn("v", F.lit(9007199254740993) - F.col("lap_id"))
    got = ordering.grouped_prefix(big, ["driver"], ["lap_number", "lap_id"], F.col("v"), "sum", True, "s")
    assert dict(got.dtypes)["s"] == "bigint"
    same(got.select("lap_id", "s"), con, "select lap_id, cast(sum(9007199254740993 - lap_id) over (partition by driver "
         "order by lap_number, lap_id) as bigint) from laps")


def test_split_rank_is_the_global_order(laps, con):
    same(panel.chronological_split(laps).select("lap_id", "split_rank", "is_test"), con,
         "select lap_id, r, r >= 2400 from (select lap_id, row_number() over (order by year nulls first, circuit nulls first, "
         "lap_number nulls first, driver nulls first, lap_id) - 1 as r from laps)")


def test_quantiles_with_null_groups(laps, con):
    for accuracy in (20, 100000):
        got = exact_quantiles(laps, "lap_time", [0.1, 0.5, 0.93], ["a", "b", "c"], by=["circuit"], accuracy=accuracy)
        same(got.select("circuit", *[F.round(c, 6) for c in "abc"]), con,
             "select circuit, round(quantile_cont(lap_time, 0.1), 6), round(quantile_cont(lap_time, 0.5), 6), "
             "round(quantile_cont(lap_time, 0.93), 6) from laps where lap_time is not null group by 1")


def test_a_hot_group_is_cut_into_blocks(spark, laps):
    x = ordering.Ordered(laps, ["driver"], ["lap_number", "lap_id"]).rows
    per = {r[ordering.BLOCK]: r["count"] for r in x.where("driver = 'HOT'").groupBy(ordering.BLOCK).count().collect()}
    share = laps.count() / ordering.block_count(laps)
    assert len(per) >= 2 and max(per.values()) < 1.6 * share
    light = x.where("driver <> 'HOT'").groupBy("driver").agg(F.max(ordering.BLOCK).alias("b")).collect()
    assert light and all(r.b == 0 for r in light)


def test_repeated_laps_are_cut_by_the_tie(spark):
    """One entity, 60 distinct lap numbers: its rows spread over all blocks."""
    laps = spark.range(20000).selectExpr("2024 as year", "'spa' as circuit", "'X' as driver", "cast(id % 60 as int) as lap_number",
                                         "id as lap_id")
    x = ordering.Ordered(laps, panel.PANEL, ["lap_number", "lap_id"]).rows
    per = [r["count"] for r in x.groupBy(ordering.BLOCK).count().collect()]
    assert len(per) == ordering.block_count(laps) and max(per) < 2 * min(per)


def test_joins_copy_no_key(spark, laps):
    """The table beside the facts goes in once, plus its most frequent keys, one per partition."""
    small = laps.groupBy("driver").agg(F.max("lap_number").alias("m"), F.count(F.lit(1)).alias("n"))
    plan = ordering.split_join(laps, small, ["driver"], rows="n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    same_rows = ordering.split_join(laps, small, ["driver"], rows="n").count()
    assert same_rows == laps.count()


@pytest.mark.parametrize("mod", [1, 2, 7, 100000])
def test_selection_finds_the_key(spark, mod):
    """Against a plain sort, with and without repeated keys, on more rows than one sample."""
    df = spark.range(30000).selectExpr(f"(id * 7919) % {mod} as k", "if(id % 5 = 0, null, id % 3) as j")
    rows = sorted(((r.k, r.j) for r in df.collect()), key=lambda r: [(v is not None, v or 0) for v in r])
    for at in (0, 1, 14999, 23999, 29999):
        assert ordering.key_at(df, ["k", "j"], lambda n: at) == rows[at]
    assert ordering.key_at(df, ["k"], lambda n: None) is None


def test_building_a_query_runs_only_the_samples(spark):
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    E.queries()["engineer_features"](spark, SF)
    jobs = sc.statusTracker().getJobIdsForGroup("build")
    sc.setJobGroup("other", "other")
    # bounded samples of key columns, nothing is written
    assert len(jobs) <= 16
    plan = E.queries()["engineer_features"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "RDDScan" not in plan and "Scan ExistingRDD" not in plan
