"""Running values over an order, with heavy groups cut into blocks.

Rows are exchanged once on (group, block) and ordinary windows run there. A group with less
than one partition's share of the rows is one block (0), as with any window. A group with
more -- there are fewer of them than partitions -- is cut along its order into as many blocks
(1, 2, ...) as it has shares, so no task holds more than about one share, however the rows
are spread over the groups. The boundaries come from a bounded random sample of rows, drawn
by one pass over the key columns when the query is built (as a range partitioner does), and
stand in the plan as literals, so the block of a row is a pure function of its key and stays
the same when a lost task is run again. The sample is of rows, not of keys: where keys repeat,
the columns that break ties cut them too.

What a window would see before its block is carried in from a summary of the heavy groups
alone: one row per (heavy group, block), at most twice as many rows as partitions, joined
back by broadcast. Without a heavy group there is nothing to carry and no such join.

Groups are compared as structs, so a null in a group column is a group like any other, and
values keep their type (integers stay integers).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_BLOCK = 32       # sampled rows for each block boundary
SELECTION_SAMPLE = 16384    # sampled rows of a selection step
GROUP, BLOCK = "_group", "_block"


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_count(df: DataFrame) -> int:
    """Shares into which the rows are cut: as many as shuffle partitions."""
    return max(2, partitions(df))


def fan_out(df: DataFrame) -> int:
    """Salts of a hot key in an exchange: half the shuffle partitions."""
    return max(2, ceil(partitions(df) / 2))


def group_of(by: Sequence[str]) -> Column:
    return F.struct(*by) if by else F.struct(F.lit(0).alias("all"))


def _nulls_first(key: Sequence) -> list[tuple]:
    """Sort key of a row as Spark orders structs: nulls first."""
    return [(False,) if v is None else (True, v) for v in key]


@dataclass
class Cuts:
    """Where the heavy groups of (``by``, ``order``) are cut: (group, boundaries) pairs."""
    by: list[str]
    order: list[str]
    groups: list[tuple] = field(default_factory=list)

    @property
    def any(self) -> bool:
        return bool(self.groups)

    def block(self, df: DataFrame) -> Column:
        """0 in light groups; in a heavy one, 1 + the number of boundaries not above the key."""
        if not self.groups:
            return F.lit(0)
        types = {f.name: f.dataType for f in df.schema}
        struct = lambda names, row: F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(names, row)])
        key, names = F.struct(*self.order), self.by or ["all"]
        types.setdefault("all", "int")
        above = lambda arr: F.size(F.filter(arr, lambda b: b <= key))
        at = F.array_position(F.array(*[struct(names, g) for g, _ in self.groups]), group_of(self.by))
        step = max(1, isqrt(max(len(c) for _, c in self.groups)))    # two short scans, not one long
        coarse = F.get(F.array(*[F.array(*[struct(self.order, k) for k in c[::step]]) for _, c in self.groups]), at - 1)
        fine = F.get(F.array(*[F.array(*[F.array(*[struct(self.order, k) for k in c[i:i + step]])
                                         for i in range(0, len(c), step)]) for _, c in self.groups]), at - 1)
        first = above(coarse)
        within = F.when(first == 0, F.lit(0)).otherwise((first - 1) * step + above(F.get(fine, first - 1)))
        return F.when(at > 0, within + 1).otherwise(F.lit(0)).cast("int")


def find_cuts(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> Cuts:
    """Cut every group that holds more than one share of the rows of ``df``. A sample of the
    groups tells which these are; where there are any, a sample of their keys tells where."""
    by, order, n = list(by), list(order), block_count(df)
    m = SAMPLE_PER_BLOCK * n
    draw = lambda x: x.orderBy(F.rand(17)).limit(m).collect()
    parts = {(0,): n}
    if by:
        drawn = Counter(tuple(r.g) for r in draw(df.select(group_of(by).alias("g"))))
        share = max(1.0, sum(drawn.values()) / n)
        parts = {g: ceil(c / share) for g, c in drawn.items() if c > share}
        if not parts:
            return Cuts(by, order, [])
        hot = F.array(*[F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(by, g)]) for g in parts])
        df = df.where(F.array_contains(hot, group_of(by)))
    seen = defaultdict(list)
    for r in draw(df.select(group_of(by).alias("g"), F.struct(*order).alias("k"))):
        seen[tuple(r.g)].append(tuple(r.k))
    groups = []
    for g, keys in seen.items():
        keys = sorted(keys, key=_nulls_first)
        groups.append((g, list(dict.fromkeys(keys[len(keys) * i // parts[g]] for i in range(1, parts[g])))))
    return Cuts(by, order, groups)


class Ordered:
    """Rows in (group, block) partitions, for any number of values along one order.

    ``lag`` and ``last`` look back over rows, ``running`` accumulates; each adds a column and
    asks for what must be carried. ``kind`` may name a 0/1 column: rows with 0 take part in
    running values alone and are passed over by ``lag`` and ``last`` (an as-of side table in
    the same order). ``like`` has the same keys at less cost than ``df``, for the sample."""

    def __init__(self, df: DataFrame, by: Sequence[str], order: Sequence[str], like: DataFrame | None = None,
                 cuts: Cuts | None = None, kind: str | None = None):
        self.by, self.order, self.kind = list(by), list(order), kind
        self.cuts = cuts if cuts is not None else find_cuts(df if like is None else like, by, order)
        self.rows = df.withColumns({GROUP: group_of(self.by), BLOCK: self.cuts.block(df)})
        if self.cuts.any or kind:       # several windows and a join: all on the one exchange
            self.rows = self.rows.repartition(GROUP, BLOCK)

    def window(self, *more: str):
        return Window.partitionBy(GROUP, BLOCK, *more).orderBy(*self.order)

    def carry(self, tail: Sequence[str] = (), tail_rows: int = 1, sums: dict[str, Column] | None = None,
              maxima: dict[str, Column] | None = None) -> Ordered:
        """Bring in what lies before each block of a heavy group: sums and maxima under their
        names (null where nothing comes before) and the ``tail`` columns of the last
        ``tail_rows`` rows under ``_tail``, an array in order."""
        sums, maxima, tail = sums or {}, maxima or {}, list(dict.fromkeys(tail))
        if not self.cuts.any:
            for name, c in (sums | maxima).items():
                self.rows = self.rows.withColumn(name, F.lit(None))
            return self
        heavy = self.rows.where(F.col(BLOCK) > 0)
        aggs = [F.sum(c).alias(n) for n, c in sums.items()] + [F.max(c).alias(n) for n, c in maxima.items()]
        if tail:
            split = [self.kind] if self.kind else []
            back = Window.partitionBy(GROUP, BLOCK, *split).orderBy(*[F.desc(c) for c in self.order])
            heavy = heavy.withColumn("_back", F.row_number().over(back))
            near = F.col("_back") <= tail_rows
            near = near & (F.col(self.kind) == 1) if self.kind else near
            item = F.struct((-F.col("_back")).alias("_at"), F.struct(*tail).alias("row"))
            aggs.append(F.sort_array(F.collect_list(F.when(near, item))).alias("_tail"))
        per = heavy.groupBy(GROUP, BLOCK).agg(*(aggs or [F.count(F.lit(1)).alias("_rows")]))
        before = Window.partitionBy(GROUP).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        out = [F.sum(n).over(before).alias(n) for n in sums] + [F.max(n).over(before).alias(n) for n in maxima]
        if tail:
            rows = F.transform(F.flatten(F.collect_list("_tail").over(before)), lambda s: s["row"])
            out.append(F.slice(rows, F.greatest(F.size(rows) - tail_rows + 1, F.lit(1)), tail_rows).alias("_tail"))
        # at most one row per block of a heavy group: fewer than two per shuffle partition
        self.rows = self.rows.join(F.broadcast(per.select(GROUP, BLOCK, *out)), [GROUP, BLOCK], "left")
        return self

    def _steps(self):
        return self.window(*([self.kind] if self.kind else []))

    def previous(self, *cols: str) -> Column:
        """The row before as a struct, null on a group's first (``carry(tail=cols)`` first)."""
        own = F.lag(F.struct(*cols)).over(self._steps())
        if not self.cuts.any:
            return own
        last = F.get("_tail", F.size("_tail") - 1)
        return F.coalesce(own, F.when(last.isNotNull(), F.struct(*[last[c].alias(c) for c in cols])))

    def mean_of_last(self, col: str, n: int, include_current: bool = True) -> Column:
        """Mean of the last ``n`` rows, fewer at a group's start (``carry`` at least ``n`` rows)."""
        w = self._steps()
        frame = w.rowsBetween(-(n - 1), 0) if include_current else w.rowsBetween(-n, -1)
        if not self.cuts.any:
            return F.avg(col).over(frame)
        own = F.transform(F.collect_list(F.struct(col)).over(frame), lambda r: r[col])
        back = F.coalesce(F.reverse(F.transform("_tail", lambda r: r[col])), F.array().cast("array<double>"))
        values = F.array_compact(F.concat(F.slice(back, 1, F.greatest(F.lit(n) - F.size(own), F.lit(0))), own))
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(values), F.lit(0))

    def running_max(self, value: str, carried: str, inclusive: bool = True) -> Column:
        w = self.window().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        own = F.max(value).over(w)
        return F.greatest(carried, own) if self.cuts.any else own

    def running_sum(self, value: str, carried: str, inclusive: bool = True) -> Column:
        w = self.window().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        zero = F.lit(0).cast(self.rows.select(F.sum(value)).schema[0].dataType)
        own = F.coalesce(F.sum(value).over(w), zero)
        return F.coalesce(F.col(carried), zero) + own if self.cuts.any else own

    def done(self, *drop: str) -> DataFrame:
        return self.rows.drop(GROUP, BLOCK, "_tail", *drop)


def grouped_prefix(df: DataFrame, by: Sequence[str], order_cols: Sequence[str], value: Column | None = None,
                   how: str = "sum", inclusive: bool = False, out: str = "_before") -> DataFrame:
    """Add ``out`` = sum or maximum (``how``) of ``value`` (1 per row if None) over the rows of
    the same ``by`` group before the row in ``order_cols`` order (and the row itself if
    ``inclusive``). ``by`` + ``order_cols`` must order each group's rows totally."""
    val = F.lit(1).cast("bigint") if value is None else value
    # ties and groups come from df's own columns, so the sample need not compute the value
    x = Ordered(df.withColumn("_val", val), by, order_cols, like=df)
    kind = "sums" if how == "sum" else "maxima"
    x.carry(**{kind: {"_sofar": F.col("_val")}})
    res = (x.running_sum if how == "sum" else x.running_max)("_val", "_sofar", inclusive)
    x.rows = x.rows.withColumn(out, res)
    return x.done("_val", "_sofar")


def global_prefix(df: DataFrame, order_cols: Sequence[str], weight: str | None = None,
                  out: str = "_before") -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 per row if None) over all rows earlier in the
    global ``order_cols`` order (which must be total)."""
    val = None if weight is None else F.col(weight).cast("bigint")
    return grouped_prefix(df, [], order_cols, val, "sum", False, out).withColumn(out, F.col(out).cast("bigint"))


def row_index(df: DataFrame, by: Sequence[str], order_cols: Sequence[str], out: str = "_rn") -> DataFrame:
    """0-based position of each row within its ``by`` group (order must be total)."""
    return grouped_prefix(df, by, order_cols, None, "sum", False, out).withColumn(out, F.col(out).cast("bigint"))


def key_at(df: DataFrame, order: Sequence[str], rank) -> tuple | None:
    """The key of the row at position ``rank(n)`` (from 0; None: no row wanted) of the ``n`` rows in
    ``order``, by selection: two keys of a random sample enclose the rank, one pass counts the
    rows below, at and between them, and the next sample is drawn where the rank lies, until a
    sample holds all rows there. Each pass reads the key columns alone and brings a bounded
    sample to the driver; nothing is exchanged. Repeated keys end the search early."""
    keys, m = df.select(F.struct(*order).alias("k")), SELECTION_SAMPLE
    types = [df.schema[c].dataType for c in order]
    lit = lambda row: F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(order, row, types)])
    inside, below, size, at, turn = keys, 0, None, None, 0
    while True:
        # one more than the sample, so that the whole of what is left is known as such
        rows = sorted((tuple(r.k) for r in inside.orderBy(F.rand(17 + turn)).limit(m + 1).collect()), key=_nulls_first)
        if size is None:
            size = len(rows) if len(rows) <= m else keys.count()
            at = rank(size)
            if at is None:
                return None
        if len(rows) <= m:
            return rows[at - below]
        guess, slack = (at - below) * len(rows) // size, 2 * isqrt(len(rows))
        lo, hi = lit(rows[max(0, guess - slack)]), lit(rows[min(len(rows) - 1, guess + slack)])
        k = F.col("k")
        under, first, mid, last = inside.agg(F.count_if(k < lo), F.count_if(k == lo), F.count_if((k > lo) & (k < hi)),
                                             F.count_if((k == hi) & (k > lo))).first()
        here = at - below - under
        if here < 0:
            inside, size = inside.where(k < lo), under
        elif here < first:
            return rows[max(0, guess - slack)]
        elif here < first + mid:
            inside, below, size = inside.where((k > lo) & (k < hi)), below + under + first, mid
        elif here < first + mid + last:
            return rows[min(len(rows) - 1, guess + slack)]
        else:
            gone = under + first + mid + last
            inside, below, size = inside.where(k > hi), below + gone, size - gone
        turn += 1


def with_heavy(big: DataFrame, small: DataFrame, on: Sequence[str], rows: str) -> DataFrame:
    """Left join of facts to a table with one row per key (null keys match null keys) and, in
    column ``rows``, how many facts each key has.

    The most frequent keys, one per shuffle partition and so bounded, are broadcast: whichever
    key has more than a partition's share is among them. Facts that have found theirs are dealt
    by a hash of the row in the join of the rest, so no key is a whole task and none is copied."""
    n = block_count(big)
    rest = [c for c in small.columns if c not in on and c != rows]
    small = small.select(F.struct(*on).alias("_key"), F.struct(*rest).alias("_val"), rows)
    top = small.orderBy(F.desc(rows), "_key").limit(n).select("_key", F.col("_val").alias("_top"))
    b = big.withColumn("_key", F.struct(*on)).join(F.broadcast(top), "_key", "left")
    salt = F.when(F.col("_top").isNotNull(), F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(n)) + 1)
    b = b.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("bigint"))
    light = small.select("_key", F.lit(0).cast("bigint").alias("_salt"), "_val")
    j = b.join(light, ["_key", "_salt"], "left").withColumn("_val", F.coalesce("_top", "_val"))
    return j.select(*big.columns, *[F.col("_val")[c].alias(c) for c in rest], F.col("_val").isNotNull().alias("_found"))


def split_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
               rows: str | None = None) -> DataFrame:
    """Join facts to a table with one row per key where one key may hold a large share of the
    facts. ``rows`` names the column of ``small`` that has the facts per key, where the
    aggregate that made it has counted them; otherwise the keys of the facts are counted."""
    on = list(on)
    if rows is None:
        rows = "_rows"
        counts = big.groupBy(F.struct(*on).alias("_key")).agg(F.count(F.lit(1)).alias(rows))
        small = small.withColumn("_key", F.struct(*on)).join(counts, "_key").drop("_key")
    j = with_heavy(big, small, on, rows)
    return (j.where("_found") if how == "inner" else j).drop("_found")
