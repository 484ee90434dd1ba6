"""Statistics ledger (A9-A13, A15): a session is summarised once, reports merge the summaries.

``record`` reads the named units (sessions) of a table alone and appends one row per unit; a unit
recorded again replaces its older row, one that has lost all rows becomes a row of zeros. The
reports read the ledger only, never the laps, and give what a full run gives: rows, null cells,
extremes and repeated rows are exact (equal rows have equal units, so the copies of units add
up); quantiles are estimates from merged sketches, sums are doubles.

Two tables: ``values`` (the distinct values of the named text columns per unit) and ``units``. A
unit's row is written after its values, and values count only under the batch of the row that is
valid, so a run that breaks off leaves nothing behind. Null units are units.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims
from ..functions.exprs import fixed
from .stats import duplicate_rows

CELL = "struct<column_name:string,missing:bigint,lo:double,hi:double,total:double,sketch:binary>"


class Ledger:
    """The ledger under ``path`` of tables with the columns of ``like``. ``unit``: the columns that
    name a session; ``numbers``: columns with extremes, sums and quantiles; ``texts``: columns
    whose distinct values are kept."""

    def __init__(self, like: DataFrame, path: str, unit: Sequence[str] = ("year", "circuit"),
                 numbers: Sequence[str] = ("lap_time", "year"), texts: Sequence[str] = ("driver", "circuit", "compound"),
                 life: str = "tyre_life"):
        self.spark, self.path, self.dtypes, self.columns = like.sparkSession, path, like.dtypes, like.columns
        self.unit, self.life = list(unit), life
        self.numbers = [c for c in numbers if c in self.columns]
        self.texts = [c for c in texts if c in self.columns]
        self.kind = T.StructType([T.StructField(c, like.schema[c].dataType) for c in self.unit])
        key = f"batch string, unit {self.kind.simpleString()}, "
        for name, rest in (("values", "column_name string, value string, rows long"),
                           ("units", f"rows long, bad long, extra_copies long, cells array<{CELL}>")):
            self.spark.createDataFrame([], key + rest).write.mode("ignore").parquet(f"{path}/{name}")

    # writing --------------------------------------------------------------------
    def _cell(self, c: str) -> Column:
        number = c in self.numbers
        x = F.col(c).cast("double") if number else F.lit(None).cast("double")
        sketch = F.kll_sketch_agg_double(x) if number else F.lit(None).cast("binary")
        return F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("missing"),
                        F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum(x).alias("total"), sketch.alias("sketch"))

    def record(self, table: DataFrame, units: Sequence[tuple] | None = None) -> None:
        """Summarise the rows of ``units`` (tuples of unit values; all if None) and append them. The
        filter is on the unit columns, so a table partitioned by them is pruned."""
        x = table.select(*self.columns)
        if units is None:
            asked = self.current().select("unit")
        else:
            asked = self.spark.createDataFrame([(tuple(u),) for u in units], T.StructType([T.StructField("unit", self.kind)]))
            same = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(self.unit, u)]) for u in units]
            x = x.where(reduce(Column.__or__, same, F.lit(False)))
        batch, unit = F.lit(f"{time.time_ns():020d}-{uuid.uuid4().hex}"), F.struct(*self.unit)
        wrong = ~F.coalesce(F.col("lap_time").between(dims.MIN_LAP_TIME, dims.MAX_LAP_TIME), F.lit(False))
        if self.life in self.columns:
            wrong = wrong | ~F.coalesce(F.col(self.life) <= dims.MAX_STINT_LENGTH, F.lit(False))
        per = x.groupBy(unit.alias("unit")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("bad"),
                                                F.array(*[self._cell(c) for c in self.columns]).alias("cells"))
        copies = duplicate_rows(x).groupBy(unit.alias("unit")).agg(F.sum("extra_copies").alias("extra_copies"))
        pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                   for c in self.texts])).alias("_v")
        values = (x.select(unit.alias("unit"), pair).select("unit", "_v.*").where("value is not null")
                  .groupBy("unit", "column_name", "value").agg(F.count(F.lit(1)).alias("rows")))
        values.select(batch.alias("batch"), "*").write.mode("append").parquet(f"{self.path}/values")
        rows = asked.join(per, "unit", "full").join(copies, "unit", "left").na.fill(0, ["rows", "bad", "extra_copies"])
        rows.select(batch.alias("batch"), "unit", "rows", "bad", "extra_copies", "cells") \
            .write.mode("append").parquet(f"{self.path}/units")

    # reading --------------------------------------------------------------------
    def current(self) -> DataFrame:
        """(unit, batch, rows, bad, extra_copies, cells): the last row of each unit."""
        u = self.spark.read.parquet(f"{self.path}/units")
        last = F.max_by(F.struct("batch", "rows", "bad", "extra_copies", "cells"), "batch").alias("_l")
        return u.groupBy("unit").agg(last).select("unit", "_l.*")

    def _columns(self) -> DataFrame:
        """(column_name, missing, lo, hi, total, n, sketch) merged over the units, each column once."""
        every = self.spark.createDataFrame([(i, c) for i, c in enumerate(self.columns)], "position int, column_name string")
        c = self.current().select("rows", F.explode("cells").alias("_c")).select("rows", "_c.*")
        c = c.groupBy("column_name").agg(
            F.sum("missing").alias("missing"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("total").alias("total"),
            (F.sum("rows") - F.sum("missing")).alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
        return every.join(c, "column_name", "left").na.fill(0, ["missing", "n"])

    def _total(self) -> DataFrame:
        """One row: rows, bad, extra_copies; per column its merged cell (``_c``: a map)."""
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("rows", "bad", "extra_copies")]
        cells = self._columns().agg(F.map_from_entries(F.collect_list(F.struct(
            "column_name", F.struct("missing", "lo", "hi")))).alias("_c"))      # one entry per column
        return self.current().agg(*sums).crossJoin(F.broadcast(cells))

    def _distinct(self) -> DataFrame:
        """(column_name, value) of the valid batches, each value once."""
        v = self.spark.read.parquet(f"{self.path}/values")
        return v.join(self.current().select("unit", "batch"), ["unit", "batch"], "left_semi").select("column_name", "value").distinct()

    def _counts(self, *columns: str) -> DataFrame:
        return self._distinct().agg(*[F.count_if(F.col("column_name") == c).alias(f"_n_{c}") for c in columns])

    def _missing(self, columns: Sequence[str]) -> Column:
        return reduce(lambda a, b: a + b, [F.col("_c")[c]["missing"] for c in columns], F.lit(0)).cast("bigint")

    # reports --------------------------------------------------------------------
    def summary(self) -> DataFrame:
        """A12."""
        c, kind = F.col("_c"), dict(self.dtypes)["year"]
        return self._total().crossJoin(F.broadcast(self._counts("circuit"))).select(
            "rows", F.lit(len(self.columns)).alias("columns"), c["lap_time"]["lo"].alias("min_lap_time"),
            c["lap_time"]["hi"].alias("max_lap_time"), c["year"]["lo"].cast(kind).alias("first_year"),
            c["year"]["hi"].cast(kind).alias("last_year"), F.col("_n_circuit").alias("circuits"))

    def metrics(self, features: Sequence[str], target: str = "lap_time", compound: str = "compound") -> DataFrame:
        """A9."""
        have = [f for f in features if f in self.columns]
        c, kind = F.col("_c"), dict(self.dtypes)["year"]
        kinds = self._distinct().agg(F.array_join(F.array_sort(F.collect_set(
            F.when(F.col("column_name") == compound, F.col("value")))), ",").alias("tire_compounds"))
        year = [c["year"][e].cast(kind).cast("string") for e in ("lo", "hi")]
        x = self._total().crossJoin(F.broadcast(self._counts("driver", "circuit"))).crossJoin(F.broadcast(kinds))
        return x.select(
            F.col("rows").alias("total_rows"), F.lit(len(have)).alias("total_features"),
            self._missing([*have, target]).alias("missing_values"), F.col("_n_driver").alias("unique_drivers"),
            F.col("_n_circuit").alias("unique_circuits"), F.concat_ws("-", *year).alias("year_range"),
            F.concat(fixed(c["lap_time"]["lo"], 2), F.lit("-"), fixed(c["lap_time"]["hi"], 2)).alias("lap_time_range"),
            "tire_compounds", (F.col("rows") < 1000).alias("low_volume"))

    def quality(self) -> DataFrame:
        """A10."""
        n, rows = len(self.columns), F.col("total_rows")
        x = self._total().select(F.col("rows").alias("total_rows"), self._missing(self.columns).alias("missing_values"),
                                 F.col("extra_copies").alias("duplicate_rows"))
        score = F.when(rows == 0, F.lit(1.0)).otherwise(F.greatest(
            F.lit(0.0), 1 - 0.5 * F.col("missing_values") / (rows * n) - 0.3 * F.col("duplicate_rows") / rows))
        return x.select("*", F.lit(n).alias("total_columns"),
                        F.lit(",".join(f"{c}:{t}" for c, t in self.dtypes)).alias("column_types"),
                        F.round(score, 6).alias("quality_score"))

    def completeness(self) -> DataFrame:
        """The table's row and one per column with nulls."""
        t = self._total().select("rows", self._missing(self.columns).alias("all_missing"))
        per = self._columns().where("missing > 0").select("column_name", "missing").crossJoin(F.broadcast(t))
        whole = t.select(F.lit(None).cast("string").alias("column_name"), F.col("all_missing").alias("missing"), "rows", "all_missing")
        cells = F.col("rows") * len(self.columns)
        of = F.when(F.col("column_name").isNull(), cells).otherwise(F.col("rows"))
        return per.unionByName(whole).select(
            "column_name", F.col("missing").cast("bigint").alias("missing_count"),
            F.round(F.coalesce(F.try_divide(F.col("missing") * 100.0, of), F.lit(0.0)), 6).alias("missing_percentage"),
            F.round(F.when(cells > 0, 1 - F.col("all_missing") / cells).otherwise(0.0), 6).alias("completeness_score"),
            ((F.col("all_missing") == 0) & (F.col("rows") > 0)).alias("is_valid"))

    def valid(self) -> DataFrame:
        """A13."""
        return self._total().select(((F.col("rows") > 0) & (F.col("bad") == 0)).alias("is_valid"), "rows")

    def ingest_report(self, years: Sequence[int] = dims.ANALYSIS_YEARS, circuits: Sequence[str] = tuple(dims.CIRCUITS)) -> DataFrame:
        """A15 for a ledger whose units are (year, circuit)."""
        grid = self.spark.createDataFrame([(y, c) for y in years for c in circuits], "year int, circuit string")
        r = grid.join(self.current().select("unit.*", "rows"), ["year", "circuit"], "left").na.fill(0, ["rows"])
        r = r.select("year", "circuit", "rows", (F.col("rows") > 0).alias("ok"))
        return r.crossJoin(F.broadcast(r.agg(F.count_if("ok").alias("ok_units"), F.count(F.lit(1)).alias("total_units"))))

    def numbers_report(self, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """Per number column: count, extremes, mean, and estimated quantiles (column ``quantiles``)."""
        q = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))) for s in shares])
        return self._columns().where(F.col("column_name").isin(self.numbers)).select(
            "column_name", F.col("n").cast("bigint").alias("n"), "lo", "hi",
            F.round(F.try_divide(F.col("total"), F.col("n")), 6).alias("mean"), F.when(F.col("n") > 0, q).alias("quantiles"))
