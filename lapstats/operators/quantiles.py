"""Exact, linearly interpolated quantiles that scale past one task.

Spark's ``percentile`` keeps a value->count map per group and merges it in one task,
so a global quantile over billions of distinct values does not fit. Here the exact
order statistics are found with one lazy plan and no driver round trip:

1. One aggregate per group: ``count`` and a ``percentile_approx`` sketch read at
   ``p - d`` and ``p + d`` (``d = 3/accuracy``). The sketch's rank error is at most
   ``n/accuracy``, so for ``n > accuracy`` the exact rank ``(n-1)·p`` lies between
   the two values; smaller groups use their whole range.
2. Rows inside the bracket (about ``6n/accuracy`` per group) are collapsed with
   ``groupBy(value).count()`` (a hot value becomes one row); in the same pass all rows below
   it become one row, which gives its rank offset. The bracket is cut into even
   cells, as many as shuffle partitions; running counts of cells tell which one or two hold
   the ranks ``floor`` and ``ceil`` of ``(n-1)·p``, and only their values are put in order.

The same plan runs at every size.

The interpolation is DuckDB ``quantile_cont``'s / pandas': ``lo + (hi-lo)·frac``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import block_count, split_join


def null_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of two small tables where null keys match null keys."""
    key = F.struct(*on).alias("_key")
    return a.select("*", key).join(b.select(key, *[c for c in b.columns if c not in on]), "_key").drop("_key")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str],
                    by: Sequence[str] = (), accuracy: int = 100000) -> DataFrame:
    """One row per group of ``by`` (one row overall if empty) with a column per prob.

    Nulls are ignored; a group with no values gets null quantiles (only the global
    form emits such a row).
    """
    by = list(by)
    x = df.select(*by, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    k = len(probs)
    d = 3.0 / accuracy
    pcts = [max(0.0, p - d) for p in probs] + [min(1.0, p + d) for p in probs]
    sk = F.percentile_approx("_x", pcts, accuracy)
    aggs = [F.count(F.lit(1)).alias("_n"), sk.alias("_ap")]
    ap = x.groupBy(*by).agg(*aggs) if by else x.agg(*aggs)
    small = F.col("_n") <= F.lit(accuracy)
    ap = ap.select(*by, "_n", *[
        c for i in range(k) for c in (
            F.when(small, F.lit(float("-inf"))).otherwise(F.col("_ap")[i]).alias(f"_lo{i}"),
            F.when(small, F.lit(float("inf"))).otherwise(F.col("_ap")[k + i]).alias(f"_hi{i}"))])
    xj = x.crossJoin(F.broadcast(ap)) if not by else split_join(x, ap, by, "inner", rows="_n")

    # per bracket: its distinct values with their counts, and one row for all that is below
    n = block_count(df)
    ends = [F.struct(F.lit(i).alias("qi"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")) for i in range(k)]
    near = F.filter(F.array(*ends), lambda e: F.col("_x") <= e["hi"])
    at = F.when(F.col("_x") >= F.col("_e.lo"), F.col("_x"))
    # a group without finite ends has at most ``accuracy`` values: one cell
    width = F.col("_e.hi") - F.col("_e.lo")
    cell = F.when(at.isNull(), F.lit(-1)).when(
        (F.col("_e.hi") < F.lit(float("inf"))) & (width > 0),
        F.least(F.floor((F.col("_x") - F.col("_e.lo")) / width * n), F.lit(n - 1))).otherwise(F.lit(0))
    vc = (xj.select(*by, "_x", F.explode(near).alias("_e"))
            .select(*by, F.col("_e.qi").alias("qi"), cell.cast("int").alias("_cell"), at.alias("_x"))
            .groupBy(*by, "qi", "_cell", "_x").agg(F.count(F.lit(1)).alias("_vc")))

    pr = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    pos = (F.col("_n") - 1) * F.col("_m.p")
    meta = ap.select(*by, "_n", F.explode(pr).alias("_m")).select(
        *by, F.col("_m.qi").alias("qi"), F.floor(pos).alias("_klo"), F.ceil(pos).alias("_khi"),
        (pos - F.floor(pos)).alias("_frac"))
    inside = lambda r: (F.col(r) >= F.col("_from")) & (F.col(r) < F.col("_to"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)

    cells = vc.groupBy(*by, "qi", "_cell").agg(F.sum("_vc").alias("_cc"))
    earlier = F.sum("_cc").over(before(Window.partitionBy(*by, "qi").orderBy("_cell")))
    cells = null_join(cells.withColumn("_from", F.coalesce(earlier, F.lit(0))), meta, [*by, "qi"])
    cells = (cells.withColumn("_to", F.col("_from") + F.col("_cc")).where(inside("_klo") | inside("_khi"))
                  .select(*by, "qi", "_cell", "_from", "_klo", "_khi", "_frac"))
    earlier = F.sum("_vc").over(before(Window.partitionBy(*by, "qi", "_cell").orderBy("_x")))
    j = null_join(vc, cells, [*by, "qi", "_cell"]).withColumn("_from", F.col("_from") + F.coalesce(earlier, F.lit(0)))
    j = j.withColumn("_to", F.col("_from") + F.col("_vc"))
    per_q = j.groupBy(*by, "qi").agg(F.max(F.when(inside("_klo"), F.col("_x"))).alias("lo"),
                                     F.max(F.when(inside("_khi"), F.col("_x"))).alias("hi"),
                                     F.first("_frac").alias("_frac"))
    per_q = per_q.withColumn("q", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("_frac"))
    cols = [F.max(F.when(F.col("qi") == i, F.col("q"))).alias(n) for i, n in enumerate(names)]
    # grouped: one row per non-empty group; global: always one row (nulls if empty)
    return per_q.groupBy(*by).agg(*cols) if by else per_q.agg(*cols)
