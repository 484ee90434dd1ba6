"""The statistics ledger against full runs: steps, repeats, emptied sessions, broken neighbours."""

import os

import pytest
from pyspark.sql import functions as F

from lapstats.operators import stats
from lapstats.operators.ledger import Ledger
from lapstats.sources import lapfiles as S

COLS = "year int, circuit string, driver string, lap_time double, compound string, tyre_life int"
SPA = [(2021, "spa", "NOR", 91.5, "SOFT", 1), (2021, "spa", "NOR", 91.5, "SOFT", 1), (2021, "spa", "ALO", None, "HARD", 4),
       (2021, "spa", None, 92.25, None, 60)]
MONZA = [(2022, "monza", "GAS", 80.125, "SOFT", 2), (2022, "monza", "NOR", 81.0, "", None)]
NONE = [(None, None, "ALO", 99.0, "HARD", 3), (None, None, "ALO", 99.0, "HARD", 3), (None, "spa", "ALO", 70.0, "HARD", 3)]


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def rows(df):
    return sorted(map(repr, df.collect()))


def same(book, df):
    """Every exact report of the ledger equals the full run over ``df``."""
    assert rows(book.summary()) == rows(stats.data_summary(df))
    assert rows(book.completeness()) == rows(stats.data_completeness(df))
    assert rows(book.quality()) == rows(stats.data_quality(df))
    assert rows(book.valid()) == rows(stats.processed_data_valid(df))
    assert rows(book.metrics(["tyre_life", "nothing"])) == rows(stats.processed_data_metrics(df, ["tyre_life", "nothing"], compound="compound"))
    assert rows(book.ingest_report()) == rows(stats.ingest_report(df))


@pytest.fixture()
def book(spark):
    return Ledger(frame(spark, []), S.scratch_path(spark, "ledger-test"))


def test_empty_ledger_equals_empty_table(spark, book):
    same(book, frame(spark, []))
    book.record(frame(spark, []))
    same(book, frame(spark, []))


def test_sessions_added_one_by_one_equal_a_full_run(spark, book):
    book.record(frame(spark, SPA + NONE))
    book.record(frame(spark, SPA + MONZA + NONE), units=[(2022, "monza")])
    again = Ledger(frame(spark, []), book.path)      # an existing ledger is opened as it is
    same(again, frame(spark, SPA + MONZA + NONE))


def test_a_unit_recorded_again_replaces_its_row(spark, book):
    book.record(frame(spark, SPA + MONZA))
    book.record(frame(spark, SPA + MONZA), units=[(2021, "spa")])
    changed = SPA[2:] + MONZA                        # the driver and laps that went are gone
    book.record(frame(spark, changed), units=[(2021, "spa")])
    same(book, frame(spark, changed))


def test_emptied_units_count_nothing(spark, book):
    book.record(frame(spark, SPA + MONZA + NONE))
    book.record(frame(spark, MONZA + NONE), units=[(2021, "spa")])
    same(book, frame(spark, MONZA + NONE))
    book.record(frame(spark, MONZA))                 # a full run drops units that are no longer there
    same(book, frame(spark, MONZA))


def test_values_of_a_run_that_broke_off_do_not_count(spark, book):
    book.record(frame(spark, MONZA))
    stray = spark.read.parquet(f"{book.path}/values").select(
        F.lit("99999999999999999999-x").alias("batch"), "unit", "column_name", F.lit("GHOST").alias("value"), "rows")
    stray.write.mode("append").parquet(f"{book.path}/values")
    same(book, frame(spark, MONZA))


def test_adding_a_session_reads_that_session_only(spark, book):
    path = S.scratch_path(spark, "ledger-laps")
    S.append_table(frame(spark, SPA + MONZA), path)
    folder = path.removeprefix("file:") + "/year=2021/circuit=spa"
    with open(os.path.join(folder, "part-broken.parquet"), "wb") as f:
        f.write(b"no lap file")
    table = spark.read.schema(COLS).parquet(path)
    with pytest.raises(Exception):
        table.select("driver").collect()
    book.record(table, units=[(2022, "monza")])
    same(book, frame(spark, MONZA))


def test_merged_quantiles_stay_near_the_exact_ranks(spark, book):
    df = spark.range(20_000).select(
        (F.lit(2021) + F.col("id") % 7).cast("int").alias("year"), F.lit("spa").alias("circuit"), F.lit("NOR").alias("driver"),
        (60 + F.pmod(F.xxhash64("id"), F.lit(10_000)) / 100).alias("lap_time"), F.lit("SOFT").alias("compound"),
        F.lit(1).alias("tyre_life"))
    book.record(df)
    got = {r["column_name"]: r for r in book.numbers_report((0.1, 0.5, 0.9)).collect()}["lap_time"]
    exact = df.agg(F.avg("lap_time"), F.min("lap_time"), F.max("lap_time")).first()
    assert (got["n"], got["lo"], got["hi"]) == (20_000, exact[1], exact[2]) and abs(got["mean"] - exact[0]) < 1e-5
    for share, value in zip((0.1, 0.5, 0.9), got["quantiles"]):
        assert abs(df.where(F.col("lap_time") <= value).count() / 20_000 - share) < 0.03
