"""Packing documents into token sequences by minimum bin slack (operator 12).

Documents longer than a sequence are cut into full sequences and a remainder. Only the
histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) is brought to the
driver. There each window starts with the longest length left; a subset-sum table over the
other lengths, one bit a sum, tells which multiset fills the rest of the window closest to
capacity, and the counts of each length are traced back through the table's states. A
multiset is used as often as the counts left allow, so the number of windows that are planned
depends on the distinct lengths, not on the documents.

Where no multiset fills a window, one more piece is cut to fill it exactly, and its rest stays
for later windows. Only the very last window can then be short; it is cut into sequences whose
lengths are powers of two, which need no padding. So no sequence is padded.

The plan is a list of runs: the pieces of one length with ranks a to b lie, with these ids of
theirs, in as many consecutive sequences at one offset. Ranks come from counts per (length,
partition), so no length, however common, meets in one task. Ids are kept beside the pieces
in the shared folder and read again for the few pieces that the plan cuts.

Defined cases: null or empty text is a document of the closing id alone; equal documents,
repeated ids and null ids are packed each; an empty table packs into nothing; columns other
than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import extend, map_arrow, materialise
from .tokens import default_tokenizer, encode_batches


# --- pieces -------------------------------------------------------------------------
def pieces(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, doc_tokens, start, length, ids (little-endian), ids_crc32, and its
    place in the table: ``_part`` and ``_no`` within it, ``_rank`` among the part's pieces of
    its length."""
    src = df.select(F.col(id_col), F.col(text), F.spark_partition_id().alias("_part"))
    schema = extend(src.select(id_col).schema, "doc_tokens long, start long, length long, ids binary, "
                                               "ids_crc32 long, _part int, _no long, _rank long")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        seen, no = defaultdict(int), 0
        for batch in batches:
            for a, coded in encode_batches(batch.column(text), tokenizer):
                row, cols = [], [[] for _ in range(8)]
                for k, raw in enumerate(coded):
                    raw += end
                    n = len(raw) // 4
                    for at in range(0, n, capacity):
                        size, part = min(capacity, n - at), raw[at * 4:(at + capacity) * 4]
                        row.append(a + k)
                        for c, v in zip(cols, (n, at, size, part, zlib.crc32(part), 0, no, seen[size])):
                            c.append(v)
                        seen[size] += 1
                        no += 1
                take = pa.array(row, pa.int64())
                cols[5] = batch.column("_part").take(take)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).take(take),
                     *(c if isinstance(c, pa.Array) else pa.array(c, pa.binary() if i == 3 else pa.int64())
                       for i, c in enumerate(cols))], names=schema.names)

    return map_arrow(src, run, schema)


# --- the plan, from the histogram ------------------------------------------------------
def closest(left: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths (each at most as often as it is left) with the largest sum up to
    ``room``. Bit s of a state says that the lengths so far, longest first, reach sum s; the
    counts are traced back from the last state."""
    mask, states, full = (1 << (room + 1)) - 1, [(0, 1)], 1 << room
    for length in sorted((k for k, n in left.items() if n and k <= room), reverse=True):
        bits, copies, step = states[-1][1], min(left[length], room // length), 1
        while copies:                       # 1, 2, 4, ... copies and the rest: any number
            step = min(step, copies)
            bits |= bits << (length * step)
            copies -= step
            step *= 2
        states.append((length, bits & mask))
        if states[-1][1] & full:
            break
    at, found = states[-1][1].bit_length() - 1, {}
    for i in range(len(states) - 1, 0, -1):
        length, n = states[i][0], 0
        while not states[i - 1][1] >> (at - n * length) & 1:
            n += 1
        if n:
            found[length] = n
            at -= n * length
    return found


class Stock:
    """Pieces left, by length: stretches [count, original length, first rank, start]."""

    def __init__(self, histogram: dict[int, int]):
        self.left = dict(histogram)
        self.stretches = {k: [[n, k, 0, 0]] for k, n in histogram.items()}

    def add(self, length: int, stretch: list[int]) -> None:
        self.left[length] = self.left.get(length, 0) + stretch[0]
        self.stretches.setdefault(length, []).append(stretch)

    def take(self, length: int, n: int) -> list[list[int]]:
        out, held = [], self.stretches[length]
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
        while n:
            count, orig, rank, start = held[-1]
            step = min(n, count)
            out.append([step, orig, rank, start])
            n -= step
            if step == count:
                held.pop()
            else:
                held[-1] = [count - step, orig, rank + step, start]
        return out


def plan(histogram: dict[int, int], capacity: int = 1024) -> list[tuple[int, int, int, int, int, int, int]]:
    """Runs (original length, first rank, count, start in the piece, length, first sequence,
    offset)."""
    stock, out, sequence = Stock(histogram), [], 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        for count, orig, rank, start in stock.take(length, n):
            out.append((orig, rank, count, start, length, first, offset))
            first += count

    while stock.left:
        longest = max(stock.left)
        rest = dict(stock.left)
        rest[longest] -= 1
        window = closest(rest, capacity - longest)
        window[longest] = window.get(longest, 0) + 1
        slack = capacity - sum(k * n for k, n in window.items())
        after = [k for k, n in stock.left.items() if n > window.get(k, 0)]
        if slack and not after:
            break
        cut = max(after) if slack else 0
        need = dict(window)
        if slack:
            need[cut] = need.get(cut, 0) + 1
        times, offset = min(stock.left[k] // n for k, n in need.items()), 0
        for length in sorted(window, reverse=True):
            for _ in range(window[length]):
                place(length, times, sequence, offset)
                offset += length
        if slack:                           # the cut piece fills the window, its rest stays
            first = sequence
            for count, orig, rank, start in stock.take(cut, times):
                out.append((orig, rank, count, start, slack, first, offset))
                first += count
                stock.add(cut - slack, [count, orig, rank, start + slack])
        sequence += times
    # one window at most is left: sequences of powers of two
    total, room, used = sum(k * n for k, n in stock.left.items()), 0, 0
    while stock.left:
        if used == room:
            sequence, used, room = sequence + (room > 0), 0, 1 << (total.bit_length() - 1)
            total -= room
        length = max(stock.left)
        (_, orig, rank, start), = stock.take(length, 1)
        size = min(length, room - used)
        out.append((orig, rank, 1, start, size, sequence, used))
        used += size
        if size < length:
            stock.add(length - size, [1, orig, rank, start + size])
    return out


class Places:
    """The plan as arrays: for a (length, rank), the parts of its piece."""

    def __init__(self, runs: list[tuple]):
        ends, by = defaultdict(set), defaultdict(list)
        for orig, rank, count, *_ in runs:
            ends[orig] |= {rank, rank + count}
        for run in runs:
            by[run[0]].append(run)
        keys, parts, self.bounds = [], [], [0]
        for orig in sorted(by):
            edges = sorted(ends[orig])
            at, cells = {e: i for i, e in enumerate(edges)}, [[] for _ in edges]
            for _, rank, count, start, length, first, offset in by[orig]:
                for i in range(at[rank], at[rank + count]):
                    cells[i].append((start, length, first + edges[i] - rank, offset))
            for e, cell in zip(edges[:-1], cells):
                keys.append(orig << 40 | e)
                parts += sorted(cell)
                self.bounds.append(len(parts))
        self.keys, self.bounds = np.array(keys, np.int64), np.array(self.bounds, np.int64)
        self.rank = self.keys & ((1 << 40) - 1)
        self.parts = np.array(parts, np.int64).reshape(-1, 4)

    def of(self, length: np.ndarray, rank: np.ndarray):
        """Row of each part, and its start in the piece, length, sequence and offset."""
        cell = np.searchsorted(self.keys, length << 40 | rank, side="right") - 1
        n = self.bounds[cell + 1] - self.bounds[cell]
        row = np.repeat(np.arange(len(cell)), n)
        part = self.parts[np.repeat(self.bounds[cell] - np.cumsum(n) + n, n) + np.arange(len(row))]
        return row, part[:, 0], part[:, 1], part[:, 2] + (rank - self.rank[cell])[row], part[:, 3]


# --- packing ----------------------------------------------------------------------------
def pack(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece of a document."""
    kept = materialise(pieces(df, tokenizer, capacity, end_id, id_col, text), "slack-pieces")
    counts = materialise(kept.groupBy("_part", "length").agg(F.count("*").alias("_n")), "slack-counts")
    runs = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}, capacity)
    places = Places(runs)
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = kept.drop("ids").join(before, ["_part", "length"])
    names = [id_col, "doc_tokens", "start", "length", "ids_crc32", "_part", "_no", "_at", "sequence_id", "offset"]
    schema = extend(kept.select(id_col).schema, "doc_tokens long, start long, length long, ids_crc32 long, _part int, "
                                                "_no long, _at long, sequence_id long, offset long")

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            num = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            size = num("length").astype(np.int64)
            row, at, length, sequence, offset = places.of(size, num("_rank") + num("_before"))
            take = pa.array(row)
            crc = batch.column("ids_crc32").take(take).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(take), batch.column("doc_tokens").take(take),
                 pa.array(num("start")[row] + at), pa.array(length),
                 pa.array(crc, mask=length != size[row]),      # unknown for a part of a piece
                 batch.column("_part").take(take), batch.column("_no").take(take), pa.array(at),
                 pa.array(sequence), pa.array(offset)], names=names)

    placed = materialise(map_arrow(ranked, place, schema), "slack-places")
    # a table of its own, so that Spark knows its size when it chooses how to join the ids
    cut = materialise(placed.where("ids_crc32 IS NULL"), "slack-cut")
    cut = cut.join(kept.select("_part", "_no", "ids"), ["_part", "_no"]).select(*names, "ids")

    def sums(batches):
        for batch in batches:
            got = [zlib.crc32(raw[a * 4:(a + n) * 4]) for raw, a, n in zip(
                batch.column("ids").to_pylist(), batch.column("_at").to_pylist(), batch.column("length").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(got, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in names], names=names)

    whole = placed.where("ids_crc32 IS NOT NULL").unionByName(map_arrow(cut, sums, schema))
    return whole.select(id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op12_min_bin_slack(spark, sf_dir) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
