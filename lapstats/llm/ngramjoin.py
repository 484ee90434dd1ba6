"""Exact n-gram Jaccard join in the metric space of shingle sets (operator 6).

The Jaccard distance d = 1 - |A and B| / |A or B| is a metric. Documents with the same
shingle set are one point. The join works on regions:

1. *Regions.* A pair within the radius differs in at most D shingles, D from the sizes. Each
   set is cut by hash range into more than D parts, so that a linked pair has an equal
   non-empty part (parts empty in both are allowed for; see ``Parts``). Points with an equal
   part share a region, so every link lies inside some region. Of regions with the same
   members one is kept.
2. *Pivots.* Inside a region points are compared by sketches (a byte for each of half as
   many parts again): a linked pair differs in no more parts than shingles, which rules out nearly
   all other pairs exactly. Each point with a possible partner takes the most similar one as
   a pivot; that distance is counted on the texts. The nearest pivot counted gives the
   point's Voronoi cell, and pivots within the radius are links.
3. *Windows and recursion.* Links join points into components. Regions whose members are one
   component are finished. The others are joined again: pairs of different components that
   finer sketches allow and whose distances to a common pivot differ by no more than the radius
   (triangle inequality). In each round every component proposes its best such pairs in each
   region; those are counted, links join components, and regions that have become one
   component are done. A round proposes ``QUOTA_GROWTH`` times as many as the one before, until
   none had more to propose. Nothing is capped: every pair that can be linked is counted or
   lies in one component; but a large group of near copies needs links, not all its pairs.

Copies never multiply rows: a region holds points, not documents. A region with more than
``BLOCK`` members is cut into blocks, and each pair of blocks is a task's own group, so no
group in a task grows with the data.

Shingles, sets and parts are compared by 64-bit hashes; distances are counted on the sets of
both texts. Defined cases: texts without words (or null) have the empty set and no links;
fewer words than n form one shingle; null ids take part and count as largest; repeated rows
are copies of one point.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (LOWER, PACKED, chunks, components, discard, map_arrow, materialise, mix, packed, packed_hash,
                     staged, text_buffer, words)

STEP = np.uint64(0x9E3779B97F4A7C15)
FINE = 16           # half parts of a fine sketch for each part of a region key
QUOTA_GROWTH = 8    # pairs that a component proposes in a region: 1, 8, 64, ...
HELD = 1 << 17      # pairs that a task holds before it drops those beyond the quota
BLOCK = 1024        # members of a region that one task compares with one another


# --- sets -----------------------------------------------------------------------------
def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: mixed from its bytes, by blake2b where it has more than
    PACKED of them, so that no two kinds of words collide by their form."""
    size = ends - starts
    h = packed_hash(packed(raw, starts, size), size)
    for i in np.flatnonzero(size > PACKED).tolist():
        h[i] = int.from_bytes(blake2b(raw[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (bytes ``raw`` cut at ``offsets``)."""
    raw = LOWER[raw]
    starts, ends, rows = words(raw, offsets)
    sets = [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    if not len(starts):
        return sets
    w = word_hashes(raw, starts, ends)
    have = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(have) - have
    fold = w[:max(0, len(w) - n + 1)].copy()
    for j in range(1, n):
        fold = mix(fold * STEP + w[j:j + len(fold)])
    for r in np.flatnonzero(have):
        a, c = first[r], have[r]
        if c >= n:
            sets[r] = np.unique(fold[a:a + c - n + 1])
        else:
            h = w[a:a + 1].copy()
            for j in range(1, c):
                h = mix(h * STEP + w[a + j:a + j + 1])
            sets[r] = mix(h + np.uint64(c))
    return sets


def column_sets(column, n: int):
    """(first row, sets) over an Arrow string column, a bounded number of bytes at a time."""
    raw, offsets = text_buffer(column)
    for a, b in chunks(offsets):
        yield a, shingle_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)


def point(s: np.ndarray) -> int:
    """A signed 64-bit id of a set."""
    with np.errstate(over="ignore"):
        total = mix(s).sum(dtype=np.uint64) + np.uint64(len(s)) * STEP
    return int(mix(np.array([total]))[0].astype(np.int64))


# --- parts ----------------------------------------------------------------------------
class Parts:
    """How sets are cut into parts for links at ``percent`` similarity.

    Sizes fall into classes; a pair meets in the class of the larger set. In class j no two
    linked sets differ in more than D shingles, so of D + 1 + slack parts at least 1 + slack
    are equal. A set with at most ``slack`` empty parts then shares a non-empty one; a set
    with more emits its empty parts too, which covers pairs where both have more.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.cuts: dict[int, np.ndarray] = {}
        self.edges = [1]
        grow = (100 / percent) ** 2
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * grow)))
        # the low bits of a region's key hold the class: as many as the last class needs
        self.low = (1 << len(self.edges).bit_length()) - 1

    @lru_cache(maxsize=None)
    def shape(self, j: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(parts, slack, lower ends of the hash ranges, keys of the parts) of class j."""
        low, high = self.edges[j], self.edges[j + 1] - 1
        differ = 2 * high * (100 - self.percent) // (100 + self.percent)
        empty = (differ + 1) * math.exp(-low * self.percent / 100 / (differ + 1))     # expected in the smallest sets
        slack = math.ceil(empty + 4 * math.sqrt(empty) + 1) if differ else 0
        k = differ + 1 + slack
        cuts = np.array([p * (1 << 64) // k for p in range(k)], np.uint64)
        seeds = mix(np.arange(k, dtype=np.uint64) + np.array([j], np.uint64) * STEP)
        return k, slack, cuts, seeds

    def classes(self, n: int) -> list[int]:
        """The classes in which a set of n shingles meets others, smallest first."""
        found = [bisect_right(self.edges, n) - 1]
        while 100 * n >= self.percent * self.edges[found[-1] + 1]:
            found.append(found[-1] + 1)
        return [j for j in found if self.shape(j)[0] > 1]     # smaller sets are linked only when equal

    def differ(self, a, b):
        """The most shingles in which linked sets of sizes a and b differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def keys(self, s: np.ndarray, j: int, total: np.ndarray) -> np.ndarray:
        """Region keys of a sorted set in class j; ``total`` are its running sums."""
        k, slack, cuts, seeds = self.shape(j)
        ends = np.append(np.searchsorted(s, cuts), len(s))
        sums = total[ends[1:]] - total[ends[:-1]]
        full = ends[1:] > ends[:-1]
        if k - int(full.sum()) > slack:
            full[:] = True
        low = np.uint64(self.low)
        return mix(sums[full] ^ seeds[full]) & ~low | np.uint64(j)

    def sketch(self, s: np.ndarray, j: int, total: np.ndarray, halves: int = 3) -> bytes:
        """A byte for each of ``halves`` * k / 2 parts; sets differ in no more parts than shingles."""
        n = halves * self.shape(j)[0] // 2
        cuts = np.array([p * (1 << 64) // n for p in range(n)], np.uint64) if n not in self.cuts else self.cuts[n]
        self.cuts[n] = cuts
        ends = np.append(np.searchsorted(s, cuts), len(s))
        return (mix(total[ends[1:]] - total[ends[:-1]]) >> np.uint64(56)).astype(np.uint8).tobytes()


def running(s: np.ndarray) -> np.ndarray:
    """Running sums of a sorted set's mixed hashes."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(s + STEP), dtype=np.uint64)))


# --- the join --------------------------------------------------------------------------
def points(docs: DataFrame, n: int, percent: int, id_col: str, text: str) -> DataFrame:
    """(id, h, n_shingles, node, sketches): the point of each document, null for the empty set, and
    a hash of its text."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    kind = pa.list_(pa.struct([("j", pa.int32()), ("s", pa.binary())]))

    def run(batches):
        parts = Parts(percent)
        for batch in batches:
            for a, sets in column_sets(batch.column("text"), n):
                sums = [running(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, len(sets)), batch.column("h").slice(a, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([point(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([[{"j": j, "s": parts.sketch(s, j, t)} for j in parts.classes(len(s))] if len(s) else []
                              for s, t in zip(sets, sums)], kind)], names=["id", "h", "n_shingles", "node", "sketches"])

    return map_arrow(src, run, "id long, h long, n_shingles long, node long, sketches array<struct<j:int,s:binary>>")


def regions(docs: DataFrame, n: int, percent: int, text: str) -> DataFrame:
    """(key, node, members): regions of at least two points, one for each set of members."""

    def run(batches):
        parts = Parts(percent)
        for batch in batches:
            for _, sets in column_sets(batch.column(0), n):
                found = {point(s): s for s in sets if len(s)}
                keys, nodes = [], []
                for node, s in found.items():
                    total = running(s)
                    for j in parts.classes(len(s)):
                        keys.append(parts.keys(s, j, total))
                        nodes.append(np.full(len(keys[-1]), node, np.int64))
                if not keys:
                    continue
                key, node = np.concatenate(keys).astype(np.int64), np.concatenate(nodes)
                for i in range(0, len(key), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(key[i:i + 200_000]), pa.array(node[i:i + 200_000])],
                                                     names=["key", "node"])

    # one shuffle: a point has rows in very many regions, so no region outweighs a task
    rows = map_arrow(docs.select(F.col(text)), run, "key long, node long").repartition("key").dropDuplicates()
    whole = Window.partitionBy("key")
    rows = (rows.withColumn("lo", F.min("node").over(whole)).withColumn("hi", F.max("node").over(whole))
            .withColumn("members", F.count("*").over(whole))
            .withColumn("mark", F.expr("bit_xor(xxhash64(node))").over(whole)).where("lo < hi"))
    rows = materialise(rows, "region-rows")
    once = (rows.groupBy(F.expr(f"key & {Parts(percent).low}").alias("j"), "members", "lo", "hi", "mark")
            .agg(F.min("key").alias("key")).select("key"))
    found = materialise(rows.join(once, "key", "left_semi").select("key", "node", "members"), "regions")
    discard(rows)
    return found


def grouped(rows: DataFrame, sketches: DataFrame, percent: int, compare, schema: str) -> DataFrame:
    """``compare`` over each region, or each pair of blocks of a larger one.

    It gets (class, side of each member, columns of the members) and yields Arrow batches."""
    extra = [c for c in rows.columns if c not in ("key", "node", "members")]
    rows = rows.withColumn("j", F.expr(f"cast(key & {Parts(percent).low} as int)"))
    rows = rows.join(sketches, ["node", "j"])
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = (rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("b1", F.least("mine", "other")).withColumn("b2", F.greatest("mine", "other"))
            .select("key", "b1", "b2", "j", "mine", "node", "n", "s", *extra)
            .repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2"))

    def run(batches):
        held, size, last = [], 0, None

        def groups():
            table = pa.Table.from_batches(held)
            ids = np.stack([table.column(c).to_numpy() for c in ("key", "b1", "b2")])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), table.num_rows]):
                part = table.slice(a, b - a)
                if b - a > 1:
                    yield from compare(part.column("j")[0].as_py(), part.column("mine").to_numpy(), part)

        for batch in batches:
            if not batch.num_rows:
                continue
            # whole groups only: what follows the last change of group waits
            ids = np.stack([batch.column(c).to_numpy() for c in ("key", "b1", "b2")])
            change = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0))
            first = tuple(ids[:, 0])
            if held and first != last:
                yield from groups()
                held = []
            if len(change):
                held.append(batch.slice(0, int(change[-1]) + 1))
                yield from groups()
                held = [batch.slice(int(change[-1]) + 1)]
            else:
                held.append(batch)
            last = tuple(ids[:, -1])
        if held:
            yield from groups()

    return map_arrow(rows, run, schema)


def allowed(parts: Parts, j: int, side: np.ndarray, sketch: np.ndarray, sizes: np.ndarray, i: int) -> tuple:
    """(members after i that may be linked with i, their numbers of equal parts)."""
    equal = (sketch[i + 1:] == sketch[i]).sum(axis=1)
    ok = sketch.shape[1] - equal <= parts.differ(sizes[i + 1:], sizes[i])
    if side[0] != side[-1] or (side != side[0]).any():      # two blocks: only pairs across
        ok &= side[i + 1:] != side[i]
    found = np.flatnonzero(ok)
    return found + i + 1, equal[found]


def pivots(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(key, x, p): for each member of a region that may be linked with another of its members,
    the one with the most equal parts."""

    def compare(j, side, table):
        parts = Parts(percent)
        node, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("s").to_pylist()), np.uint8).reshape(len(node), -1)
        best, who = np.zeros(len(node), np.int64), np.full(len(node), -1)
        for i in range(len(node) - 1):
            found, equal = allowed(parts, j, side, sketch, sizes, i)
            if len(found):
                k = int(equal.argmax())
                if equal[k] > best[i]:
                    best[i], who[i] = equal[k], found[k]
                better = found[equal > best[found]]
                best[better], who[better] = equal[equal > best[found]], i
        has = np.flatnonzero(who >= 0)
        if len(has):
            x, p = node[has], node[who[has]]
            yield pa.RecordBatch.from_arrays([table.column("key").combine_chunks().slice(0, 1).take([0] * len(has)),
                                              pa.array(np.minimum(x, p)), pa.array(np.maximum(x, p))], names=["key", "x", "p"])

    return materialise(grouped(rows, sketches, percent, compare, "key long, x long, p long"), "pivot-pairs")


def best_pairs(a: np.ndarray, b: np.ndarray, same: np.ndarray, comp: np.ndarray, quota: int) -> np.ndarray:
    """Places of the pairs that are among the ``quota`` with the most equal parts of a component."""
    owner = np.concatenate((comp[a], comp[b]))          # both components of a pair have it
    pair = np.tile(np.arange(len(a)), 2)
    order = np.lexsort((pair, -same[pair], owner))
    owner, pair = owner[order], pair[order]
    start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    place = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    return np.unique(pair[place < quota])


def crossing(rows: DataFrame, sketches: DataFrame, percent: int, quota: int) -> DataFrame:
    """(key, x, p, more): pairs of different components that sketches and windows allow. In each
    region every component proposes the ``quota`` pairs with the most equal parts; ``more``
    tells whether it had others."""
    radius = 1 - percent / 100 + 1e-9

    def compare(j, side, table):
        parts = Parts(percent)
        node, sizes, comp, cell = (table.column(c).to_numpy() for c in ("node", "n", "comp", "cell"))
        far = table.column("far").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("s").to_pylist()), np.uint8).reshape(len(node), -1)
        held, size, more = [], 0, False

        def settle():       # a pair beyond the quota of what is held is beyond it of all
            a, b, same = (np.concatenate(c) for c in zip(*held))
            chosen = best_pairs(a, b, same, comp, quota)
            return [(a[chosen], b[chosen], same[chosen])], len(chosen), len(chosen) < len(a)

        for i in range(len(node) - 1):
            if (comp[i + 1:] == comp[i]).all():
                continue
            found, equal = allowed(parts, j, side, sketch, sizes, i)
            ok = ((comp[found] != comp[i]) & (cell[found] != node[i]) & (cell[i] != node[found])
                  & ((cell[found] != cell[i]) | (np.abs(far[found] - far[i]) <= radius)))
            if ok.any():
                held.append((np.full(int(ok.sum()), i), found[ok], equal[ok]))
                size += len(held[-1][0])
                if size > HELD:
                    held, size, dropped = settle()
                    more |= dropped
        if not held:
            return
        held, size, dropped = settle()
        x, p = node[held[0][0]], node[held[0][1]]
        yield pa.RecordBatch.from_arrays(
            [table.column("key").combine_chunks().slice(0, 1).take([0] * size), pa.array(np.minimum(x, p)),
             pa.array(np.maximum(x, p)), pa.array(np.full(size, more or dropped))], names=["key", "x", "p", "more"])

    return materialise(grouped(rows, sketches, percent, compare, "key long, x long, p long, more boolean"), "window-pairs")


def point_texts(nodes: DataFrame, where: DataFrame, docs: DataFrame, n: int, id_col: str, text: str) -> DataFrame:
    """(node, text) of some points; no other text is kept."""
    asked = nodes.join(where, "node")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    texts = src.join(asked, src["id"].eqNullSafe(asked["id"])).select("node", "text")

    def right(batches):     # an id that several texts share: only the point's own text
        for batch in batches:
            for a, sets in column_sets(batch.column("text"), n):
                part = batch.slice(a, len(sets))
                nodes = part.column("node").to_pylist()
                yield part.filter(pa.array([len(s) > 0 and point(s) == k for s, k in zip(sets, nodes)], pa.bool_()))

    return materialise(map_arrow(texts, right, texts.schema).dropDuplicates(["node"]), "region-texts")


def fine_sketches(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, n, j, s): sketches of so many parts that nearly every shingle in which two sets
    differ shows, so few pairs beyond the radius are left to be counted."""

    def run(batches):
        parts = Parts(percent)
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for a, sets in column_sets(batch.column("text"), n):
                rows = [(nodes[a + i], len(s), j, parts.sketch(s, j, t, FINE)) for i, s in enumerate(sets)
                        for t in (running(s),) for j in parts.classes(len(s))]
                cols = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["node", "n", "j", "s"])

    return materialise(map_arrow(texts, run, "node long, n long, j int, s binary"), "fine-sketches")


def measured(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(x, p, distance, linked) of pairs of points, counted on the sets of their texts."""
    rows = (pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("xt")), "x")
            .join(texts.select(F.col("node").alias("p"), F.col("text").alias("pt")), "p")
            .select("x", "p", "xt", "pt"))

    def run(batches):
        last = (None, None)
        for batch in batches:
            xs, ps = batch.column("x").to_pylist(), batch.column("p").to_pylist()
            pt = batch.column("pt")
            for a, sets in column_sets(batch.column("xt"), n):
                out = ([], [], [], [])
                for i, s in enumerate(sets, a):
                    if ps[i] != last[0]:
                        last = (ps[i], next(column_sets(pt.slice(i, 1), n))[1][0])
                    both = len(np.intersect1d(s, last[1], assume_unique=True))
                    union = len(s) + len(last[1]) - both
                    for c, v in zip(out, (xs[i], ps[i], 1 - both / union, 100 * both >= percent * union)):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()),
                     pa.array(out[3], pa.bool_())], names=["x", "p", "distance", "linked"])

    return materialise(map_arrow(rows, run, "x long, p long, distance double, linked boolean"), "distances")


def links(docs: DataFrame, found: DataFrame, where: DataFrame, n: int, percent: int, id_col: str, text: str) -> DataFrame:
    """(id, component) of the points that have a link: components of the link graph."""
    rows = regions(docs, n, percent, text)
    # one document for each point, so that copies do not meet in one task
    one = where.join(rows.select("node").distinct(), "node", "left_semi").withColumnsRenamed({"node": "_node", "id": "_id"})
    sketches = materialise(
        found.join(one, (F.col("node") == F.col("_node")) & F.col("id").eqNullSafe(F.col("_id"))).dropDuplicates(["node"])
        .select("node", F.col("n_shingles").alias("n"), F.explode("sketches").alias("_s")).select("node", "n", "_s.j", "_s.s"),
        "sketches")
    chosen = pivots(rows, sketches, percent)
    discard(rows)
    discard(sketches)
    pairs = materialise(chosen.select("x", "p").distinct(), "pairs")
    ends = pairs.select(F.col("x").alias("node")).union(pairs.select("p")).distinct()
    texts = point_texts(ends, where, docs, n, id_col, text)
    got = measured(pairs, texts, n, percent)
    discard(pairs)
    edges = got.where("linked").select(F.col("x").alias("a"), F.col("p").alias("b"))
    comp = components(edges)
    near = got.select(F.col("x").alias("node"), F.struct("distance", F.col("p").alias("cell")).alias("_d")).union(
        got.select("p", F.struct("distance", F.col("x").alias("cell")))).groupBy("node").agg(F.min("_d").alias("_d"))
    # a point without any possible partner in a region is done with that region
    rows = chosen.select("key", F.col("x").alias("node")).union(chosen.select("key", "p")).distinct()
    members = rows.groupBy("key").agg(F.count("*").alias("members"))
    rows = materialise(rows.join(members, "key").join(
        near.select("node", "_d.cell", F.col("_d.distance").alias("far")), "node"), "cells")
    discard(chosen)
    tested, quota, fine = got.select("x", "p"), 1, fine_sketches(texts, n, percent)
    while True:
        left = (rows.join(comp.withColumnRenamed("id", "node"), "node", "left")
                .withColumn("comp", F.coalesce("component", "node")).drop("component"))
        mixed = (left.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
                 .where("_lo < _hi").select("key"))
        asked = crossing(left.join(mixed, "key", "left_semi"), fine, percent, quota)
        state = asked.agg(F.count("*").alias("n"), F.max("more").alias("more")).first()
        if not state["n"]:
            return comp
        new = measured(asked.select("x", "p").distinct().join(tested, ["x", "p"], "left_anti"), texts, n, percent)
        linked = new.where("linked").select(F.col("x").alias("a"), F.col("p").alias("b"))
        comp = components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(linked))
        if not state["more"]:
            return comp
        # regions that have proposed all they had are done
        rows = rows.join(asked.where("more").select("key").distinct(), "key", "left_semi")
        tested, quota = tested.unionByName(new.select("x", "p")), quota * QUOTA_GROWTH


def named(docs: DataFrame, found: DataFrame, n: int, percent: int, id_col: str, text: str) -> DataFrame:
    """(node, comp) of every point."""
    where = found.where("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    comp = links(docs, found, where, n, percent, id_col, text)
    return (where.select("node").join(comp.withColumnRenamed("id", "node"), "node", "left")
            .select("node", F.coalesce("component", "node").alias("comp")))


def join(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) per document: component_id is the smallest id that
    is reachable over links of at least ``percent`` percent similarity, its own included."""
    found = materialise(points(docs, n, percent, id_col, text), "points")
    names = named(docs, found, n, percent, id_col, text)
    # the smallest id of a point first, so that copies of one text never meet in a component's task
    ids = found.where("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    least = names.join(ids, "node").groupBy("comp").agg(F.min("id").alias("component_id"))
    names = names.join(least, "comp").select("node", "component_id")
    return (found.join(names, "node", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id")))


def op6_ngram_join(spark, sf_dir) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)


def near_copies(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(_row): id and text hash of the rows that are not the first of their group of near duplicates."""
    found = materialise(points(docs, n, percent, "doc_id", "text"), "points")
    names = named(docs, found, n, percent, "doc_id", "text")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("h").alias("h"))
    first = found.where("node is not null").groupBy("node").agg(F.min(order).alias("first"))
    least = names.join(first, "node").groupBy("comp").agg(F.min("first").alias("least"))
    names = names.join(least, "comp").select("node", "least")
    return (found.join(names, "node").where(order != F.col("least"))
            .select(F.struct("id", "h").alias("_row")).distinct())


def stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Pipeline stage: of each group of near duplicates (five words, similarity 0.8) one row
    stays: that with the smallest id (null ids last) and, of rows that share it, that with the
    smallest text hash. Each row is decided by its own text: rows that share an id keep every
    text that has no near duplicate, and rows with a null id are deduplicated like others. Rows
    without words stay; of rows equal in id and text one stays. The tables of the join are
    deleted before the rows are read again."""
    row = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"))
    gone = staged(spark, "near-copies", lambda: near_copies(docs, 5, 80))
    again = materialise(docs.select(row.alias("_row")).groupBy("_row").agg(F.count("*").alias("n")).where("n > 1")
                        .select("_row"), "repeated-rows")
    kept = docs.withColumn("_row", row).join(gone, "_row", "left_anti")
    if again.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(again, "_row", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "_row", "left_anti").unionByName(once).select(*docs.columns)
