"""Suffix-array deduplication of repeated byte strings (operator 1).

Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the
same document or another, is removed. A position is handled through its window, the
``length`` bytes from it on:

1. *Anchors.* In each window the k-gram with the smallest hash is the anchor; equal windows
   have equal anchors at equal offsets. A document has about one anchor per ``length / 3``
   bytes, each serving a run of consecutive windows; the bytes of that run of windows are
   the anchor's context. Anchors whose k-gram occurs once in the corpus are dropped by an
   aggregation, which leaves the text around true repeats.
2. *Equal contexts* (the inside of copied passages, copies of documents) are found by hash
   and settled: all their windows repeat. One of them stands for all from here on.
3. *Suffix sort.* The contexts that share an anchor are sorted from the anchor on, and
   again, reversed, from the anchor back, by a mergesort whose comparisons find the common
   extension by binary search over prefix polynomial hashes. Adjacent common extensions are
   verified on the bytes. Their lengths bound the windows that can repeat; those windows
   are then matched by two independent hashes.
4. *Hot anchors*, with more than ``HOT`` different contexts, are never brought together:
   offsets are cut into ranges, a range is settled when its whole string repeats or when the
   string common to all its windows is unique, and the windows of the others are counted by
   hash. All of it is aggregation that combines before the shuffle.

Texts move once, reduced to one per distinct text. Defined cases: null text counts as empty;
texts shorter than ``length`` lose nothing; repeated rows are copies, so they lose all bytes
if long enough; null ids keep their row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BYTE_VALUE, chunks, discard, forget, map_arrow, materialise, mix, prefix_hash, span_hash, staged,
                     text_buffer)

LENGTH = 400
HOT = 512
CHUNK = 1 << 20
SECOND = mix(BYTE_VALUE + np.uint64(0xA0761D6478BD642F))      # byte values of a second hash
TEXT = ["t1", "t2"]      # two hashes that stand for a text
SEED = 7                  # makes the second independent of the first
SPAN = "t1 long, t2 long, lo int, hi int"


# --- anchors -----------------------------------------------------------------------------
def anchors(raw: np.ndarray, offsets: np.ndarray, prefix: np.ndarray, length: int):
    """(row, anchor, lo, hi) of each anchor in a buffer of texts: it serves the windows that
    start at lo..hi (places in the buffer)."""
    k = max(1, length // 4)
    w = length - k + 1
    n = len(raw)
    z = np.zeros(0, np.int64)
    if n < length:
        return z, z, z, z
    at = np.arange(n - k + 1)
    h = span_hash(prefix, at, at + k)
    h = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)      # leftmost on ties
    # minimum over w places: suffix minima of one block and prefix minima of the next
    size = -(-len(h) // w) * w
    pad = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    pad[:len(h)] = h
    pad = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    p = np.arange(n - length + 1)
    least = (np.minimum(back[p], ahead[p + w - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(offsets, p, side="right") - 1
    ok = p + length <= offsets[row + 1]
    p, least, row = p[ok], least[ok], row[ok]
    if not len(p):
        return z, z, z, z
    new = np.ones(len(p), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return row[first], least[first], p[first], p[last]


def anchor_table(texts: DataFrame, length: int) -> DataFrame:
    """(h, c, t1, t2, a, lo, hi): anchor k-gram, context, text and places."""
    k = max(1, length // 4)

    def run(batches):
        for batch in batches:
            t1, t2 = (batch.column(c).to_numpy() for c in TEXT)
            raw, offsets = text_buffer(batch.column("text"))
            for x, y in chunks(offsets, CHUNK):
                part, off = raw[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x]
                prefix = prefix_hash(part)
                row, a, lo, hi = anchors(part, off, prefix, length)
                base = off[row]
                one, two = t1[x:y][row], t2[x:y][row]
                with np.errstate(over="ignore"):
                    c = mix(span_hash(prefix, lo, hi + length) + (a - lo).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(span_hash(prefix, a, a + k).astype(np.int64)),
                    pa.array(c.astype(np.int64)), pa.array(one), pa.array(two),
                    *(pa.array((v - base).astype(np.int32)) for v in (a, lo, hi))],
                    names=["h", "c", "t1", "t2", "a", "lo", "hi"])

    return map_arrow(texts, run, "h long, c long, t1 long, t2 long, a int, lo int, hi int")


# --- suffix sort ---------------------------------------------------------------------------
class Suffixes:
    """Suffixes ``start``..``end`` of a buffer, compared through prefix hashes."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.raw, self.start, self.end = raw, start, end
        self.prefix = prefix_hash(raw)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of suffixes i and j, by binary search."""
        si, sj = self.start[i], self.start[j]
        low = np.zeros(len(i), np.int64)
        high = np.minimum(self.end[i] - si, self.end[j] - sj)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = span_hash(self.prefix, si, si + mid) == span_hash(self.prefix, sj, sj + mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before suffix j."""
        n = self.extension(i, j)
        pi, pj = self.start[i] + n, self.start[j] + n
        done_i, done_j = pi >= self.end[i], pj >= self.end[j]
        last = len(self.raw) - 1
        return np.where(done_i | done_j, done_i & ~done_j,
                        self.raw[np.minimum(pi, last)] < self.raw[np.minimum(pj, last)])

    def sort(self, sizes: np.ndarray) -> np.ndarray:
        """Bottom-up mergesort inside consecutive groups of the given sizes, all at once: each
        step compares the heads of every pair of runs that is being merged."""
        ends = np.cumsum(sizes)
        begins = ends - sizes
        order, width = np.arange(int(ends[-1]) if len(ends) else 0), 1
        while len(sizes) and width < sizes.max():
            per = -(-sizes // (2 * width))
            group = np.repeat(np.arange(len(sizes)), per)
            nth = np.arange(len(group)) - np.repeat(np.cumsum(per) - per, per)
            left = begins[group] + nth * 2 * width
            middle, stop = left + width, np.minimum(left + 2 * width, ends[group])
            has = middle < stop
            left, middle, stop = left[has], middle[has], stop[has]
            out, right, new = left.copy(), middle.copy(), order.copy()
            live = np.arange(len(left))
            while len(live):
                li, ri = left[live], right[live]
                both = ri < stop[live]
                take = np.zeros(len(live), bool)
                b = np.flatnonzero(both)
                take[b] = self.less(order[ri[b]], order[li[b]])
                new[out[live]] = np.where(take, order[np.minimum(ri, len(order) - 1)], order[li])
                right[live] += take
                left[live] += ~take
                out[live] += 1
                live = live[left[live] < middle[live]]      # the rest of a right run is in place
            order, width = new, 2 * width
        return order

    def neighbours(self, sizes: np.ndarray) -> np.ndarray:
        """For each suffix the longest extension it shares with another of its group: that of a
        neighbour in sorted order, verified on the bytes."""
        order = self.sort(sizes)
        best = np.zeros(len(order), np.int64)
        if len(order) < 2:
            return best
        group = np.repeat(np.arange(len(sizes)), sizes)
        pair = np.flatnonzero(group[1:] == group[:-1])
        i, j = order[pair], order[pair + 1]
        n = self.extension(i, j)
        n = self.verified(i, j, n)
        np.maximum.at(best, i, n)
        np.maximum.at(best, j, n)
        return best

    def verified(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The extensions, shortened to what the bytes really share."""
        n, step = n.copy(), 1 << 11
        for a in range(0, len(i), step):
            m = n[a:a + step]
            place = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            pi = np.repeat(self.start[i[a:a + step]], m) + place
            pj = np.repeat(self.start[j[a:a + step]], m) + place
            wrong = np.flatnonzero(self.raw[pi] != self.raw[pj])
            if len(wrong):
                which = np.repeat(np.arange(len(m)), m)[wrong]
                np.minimum.at(n, a + which, place[wrong])
        return n


def repeated_windows(contexts: list[bytes], left: np.ndarray, sizes: np.ndarray, length: int):
    """(context, first window, last window) ranges that occur in another context of the same
    group; ``left`` is the anchor's place in each context."""
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    n = np.array([len(c) for c in contexts], np.int64)
    base = np.cumsum(n) - n
    ahead = Suffixes(raw, base + left, base + n).neighbours(sizes)
    total = len(raw)
    behind = Suffixes(np.ascontiguousarray(raw[::-1]), total - base - left, total - base).neighbours(sizes)
    # the window at distance d before the anchor needs d bytes behind and length - d ahead
    first = np.maximum(left - behind, 0)
    last = np.minimum(left + ahead - length, n - length)
    count = np.maximum(last - first + 1, 0)
    who = np.repeat(np.arange(len(contexts)), count)
    window = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    if not len(who):
        return who, window, window
    at = base[who] + window
    group = np.repeat(np.arange(len(sizes)), sizes)[who]
    one, two = (span_hash(prefix_hash(raw, values), at, at + length) for values in (BYTE_VALUE, SECOND))
    order = np.lexsort((two, one, group))
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1]) & (group[order][1:] == group[order][:-1])
    twice = np.zeros(len(who), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    who, window = who[twice], window[twice]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (window[1:] != window[:-1] + 1)
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(who)) - 1
    return who[start], window[start], window[stop]


def sorted_groups(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the contexts that share an anchor (columns h, t1, t2, a, lo, alone,
    context); a bounded number of whole groups is sorted at a time."""

    def settle(held):
        sizes = np.unique(np.array([r[0] for r in held]), return_counts=True)[1]
        who, first, last = repeated_windows([r[6] for r in held], np.array([r[3] - r[4] for r in held], np.int64),
                                            sizes, length)
        rows = [(held[w][1], held[w][2], held[w][4] + f, held[w][4] + t)
                for w, f, t in zip(who.tolist(), first.tolist(), last.tolist()) if held[w][5]]
        cols = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["t1", "t2", "lo", "hi"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("h", "t1", "t2", "a", "lo", "alone", "context"))):
                if size > CHUNK and held[-1][0] != r[0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[6])
        if held:
            yield settle(held)

    return map_arrow(contexts.repartition("h").sortWithinPartitions("h"), run, SPAN)


# --- hot anchors ---------------------------------------------------------------------------
def hot_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts, by counting hashes only.

    Windows are taken by their distance from the anchor, in cells of ever fewer distances,
    down to one. A cell whose whole string comes twice repeats; one whose common string (the
    bytes that all windows of the cell share) is unique does not; the others go on."""
    settled, todo = None, contexts
    for grid in (max(1, length // 12), max(1, length // 66), 1):
        cells = materialise(cells_of(todo, length, grid), "cells")
        hulls = cells.groupBy("core", "hull").agg(F.count("*").alias("same"))
        marked = cells.join(hulls, ["core", "hull"])
        found = marked.where("same > 1 and alone").select("t1", "t2", "lo", "hi")
        settled = found if settled is None else settled.unionByName(found)
        if grid == 1:
            break
        mixed = (hulls.groupBy("core").agg(F.count("*").alias("kinds"), F.min("same").alias("least"))
                 .where("kinds > 1 and least = 1").select("core"))
        # cells that repeat stay as partners of the others
        wanted = (marked.join(mixed, "core", "left_semi")
                  .select("t1", "t2", "a", F.col("lo").alias("first"), F.col("hi").alias("last"),
                          F.expr("alone and same = 1").alias("open")))
        todo = materialise(
            todo.join(wanted, ["t1", "t2", "a"]).where(f"first >= lo and last <= lo + length(context) - {length}")
            .select("t1", "t2", "a", F.col("first").alias("lo"), F.col("open").alias("alone"),
                    F.expr(f"substring(context, first - lo + 1, last - first + {length})").alias("context")), "mixed-cells")
    return settled


def cells_of(contexts: DataFrame, length: int, grid: int) -> DataFrame:
    """(t1, t2, a, lo, hi, alone, core, hull): the cells of ``grid`` distances of each context."""

    def run(batches):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
        for batch in batches:
            out = [[] for _ in kinds]
            for t1, t2, a, lo, alone, c in zip(*(batch.column(x).to_pylist() for x in ("t1", "t2", "a", "lo", "alone", "context"))):
                raw = np.frombuffer(c, np.uint8)
                prefix, left, windows = prefix_hash(raw), a - lo, len(raw) - length + 1
                far = (left - windows + 1, left)                    # distances of the windows from the anchor
                cells = np.arange(far[0] // grid, far[1] // grid + 1)
                small, large = np.maximum(cells * grid, far[0]), np.minimum(cells * grid + grid - 1, far[1])
                # common to all windows of the cell, whether served here or not
                core = span_hash(prefix, left - cells * grid, left - (cells + 1) * grid + 1 + length)
                hull = span_hash(prefix, left - large, left - small + length)
                core = mix(core ^ mix(cells.astype(np.uint64))).astype(np.int64)
                hull = mix(hull ^ mix((small * 65536 + large).astype(np.uint64))).astype(np.int64)
                n = len(cells)
                for col, v in zip(out, ([t1] * n, [t2] * n, [a] * n, (a - large).tolist(), (a - small).tolist(), [alone] * n,
                                        core.tolist(), hull.tolist())):
                    col.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["t1", "t2", "a", "lo", "hi", "alone", "core", "hull"])

    return map_arrow(contexts, run, "t1 long, t2 long, a int, lo int, hi int, alone boolean, core long, hull long")


# --- whole operator ------------------------------------------------------------------------
def keyed(docs: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(SEED), body).alias("t2"), body.alias("text"))


def distinct_texts(texts: DataFrame) -> DataFrame:
    """One text for each pair of hashes; a join on them needs no second shuffle of the texts."""
    return texts.groupBy(*TEXT).agg(F.max("text").alias("text"))


def repeats(texts: DataFrame, length: int) -> DataFrame:
    """(t1, t2, lo, hi): windows that repeat, per distinct text. Every step reads the table of the one
    before, which is deleted then, so that neither tables nor shuffle files of the steps add up."""
    u = F.xxhash64(*TEXT, "a").alias("u")      # an occurrence, made where it is asked for and not carried along
    table = materialise(anchor_table(texts.where(F.octet_length("text") >= length), length), "anchors")
    twice = materialise(table.select("h", u).groupBy("h").agg(F.min("u").alias("_lo"), F.max("u").alias("_hi"))
                        .where("_lo <> _hi").select("h"), "repeated-grams")
    forget(texts.sparkSession)
    rows = materialise(table.join(twice, "h", "left_semi").distinct(), "repeated-anchors")
    discard(table)
    discard(twice)
    found = rows.select("*", u)
    same = found.groupBy("h", "c").agg(F.min("u").alias("first"), F.max("u").alias("_last")) \
        .withColumn("alone", F.expr("first = _last")).drop("_last")
    marked = materialise(found.join(same, ["h", "c"]).select("h", *TEXT, "a", "lo", "hi", "alone", F.expr("u = first").alias("one")),
                         "marked-anchors")
    discard(rows)
    settled = marked.where("not alone").select("t1", "t2", "lo", "hi")
    ones = marked.where("one")
    kinds = ones.groupBy("h").agg(F.count("*").alias("kinds"), F.max("alone").alias("some")).where("some and kinds > 1")
    asked = (ones.join(kinds.select("h", (F.col("kinds") > HOT).alias("hot")), "h")
             .groupBy(*TEXT).agg(F.collect_list(F.struct("h", "a", "lo", "hi", "alone", "hot")).alias("asked")))
    lists = materialise(asked, "contexts-asked")

    def slices(batches):
        kinds_ = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary())
        names = ["h", "t1", "t2", "a", "lo", "alone", "hot", "context"]
        for batch in batches:
            cols, size = [[] for _ in names], 0
            for t1, t2, text, want in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "text", "asked"))):
                raw = text.encode()
                for x in want:
                    c = raw[x["lo"]:x["hi"] + length]
                    for col, v in zip(cols, (x["h"], t1, t2, x["a"], x["lo"], x["alone"], x["hot"], c)):
                        col.append(v)
                    size += len(c)
                if size > CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_)], names=names)
                    cols, size = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_)], names=names)

    contexts = materialise(map_arrow(distinct_texts(texts).join(lists, TEXT).select(*TEXT, "text", "asked"), slices,
                                     "h long, t1 long, t2 long, a int, lo int, alone boolean, hot boolean, context binary"),
                           "contexts")
    discard(lists)
    runs = settled.unionByName(sorted_groups(contexts.where("not hot").drop("hot"), length))
    hot = contexts.where("hot").drop("hot")
    if not hot.isEmpty():
        runs = runs.unionByName(hot_windows(hot, length))
    return runs.groupBy(*TEXT).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(t1, t2, runs): the windows lo..hi of each distinct text that repeat, as a scratch table; all other
    tables made on the way are deleted."""
    return staged(texts.sparkSession, "repeated-windows", lambda: repeats(texts, length))


def cut(raw: bytes, found: list, length: int) -> tuple[list, str, bytes]:
    """(byte runs, text without them, bytes without them) of one text with the windows ``found``;
    the text is cut at whole characters."""
    merged = []
    for lo, hi in sorted((x["lo"], x["hi"] + length) for x in found):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    rest, whole, at, end = [], [], 0, 0
    for lo, hi in merged:
        rest.append(raw[at:lo])
        at = hi
        a, b = lo, hi
        while a < b and raw[a] & 0xC0 == 0x80:           # not inside a character
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        whole.append(raw[end:a])
        end = b
    return merged, b"".join([*whole, raw[end:]]).decode(), b"".join([*rest, raw[at:]])


def removals(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """Per distinct text with a repeat: t1, t2, removed (byte runs start..end), n_removed,
    n_spans, kept (the text without them, cut at whole characters) and kept_sha256 (of the
    remaining bytes)."""
    texts = keyed(docs, text)
    lists = spans(texts, length)

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = [[] for _ in range(7)]
            for t1, t2, body, found in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "text", "runs"))):
                merged, left, rest = cut(body.encode(), found, length)
                for col, v in zip(out, (t1, t2, [{"start": a, "end": b} for a, b in merged], sum(b - a for a, b in merged),
                                        len(merged), left, hashlib.sha256(rest).hexdigest())):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), span, pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["t1", "t2", "removed", "n_removed", "n_spans", "kept", "kept_sha256"])

    return map_arrow(distinct_texts(texts).join(lists, TEXT).select(*TEXT, "text", "runs"), run,
                     "t1 long, t2 long, removed array<struct<start:int,end:int>>, n_removed long, n_spans long, "
                     "kept string, kept_sha256 string")


def copies(docs: DataFrame, length: int, text: str) -> DataFrame:
    """Texts that more than one row has, long enough to be removed whole."""
    body = F.coalesce(F.col(text), F.lit(""))
    return (docs.where(F.octet_length(body) >= length).select(
        F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(SEED), body).alias("t2"))
        .groupBy(*TEXT).agg(F.count("*").alias("n")).where("n > 1").select(*TEXT, F.lit(True).alias("copied")))


def digest(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("_sha"),
                       F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(SEED), body).alias("t2"))
    found = removals(docs, length, text).drop("removed", "kept")
    out = rows.join(found, TEXT, "left").join(copies(docs, length, text), TEXT, "left")
    gone = F.col("copied").isNotNull()
    return out.select(
        id_col, "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"))


def op1_suffix_dedup(spark, sf_dir) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


STAGE_LENGTH = 200      # bytes: a passage of fifty short words


def stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Pipeline stage: every string of ``STAGE_LENGTH`` bytes that occurs twice is cut out. The rows move
    once, to the windows of their texts."""
    names = [f"_suffix_dedup_1_{c}" for c in (*TEXT, "runs", "copied")]
    key, (runs, copied) = names[:2], names[2:]
    lists = spans(keyed(docs, "text"), STAGE_LENGTH).toDF(*key, runs)
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn(key[0], F.xxhash64(body)).withColumn(key[1], F.xxhash64(F.lit(SEED), body))
    out = rows.join(lists, key, "left").join(copies(docs, STAGE_LENGTH, "text").toDF(*key, copied), key, "left")
    columns = docs.columns

    def run(batches):
        for batch in batches:
            left = ["" if gone else t if not found else cut(t.encode(), found, STAGE_LENGTH)[1]
                    for t, found, gone in zip(*(batch.column(c).to_pylist() for c in ("text", runs, copied)))]
            cols = {c: batch.column(c) for c in columns}
            cols["text"] = pa.array(left, batch.column("text").type)
            yield pa.RecordBatch.from_arrays([cols[c] for c in columns], names=columns)

    return map_arrow(out.select(*columns, runs, copied), run, docs.schema) \
        .withColumn("n_chars", F.length("text").cast("long")).select(*columns)
