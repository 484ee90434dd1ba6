"""Packing documents into token sequences by linear grouping (operator 5).

Only the histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) is
brought to the driver. There

1. lengths above ``capacity // SMALL_PART`` are sorted and dealt into ``GROUPS`` groups of
   equal cardinality, and rounded up to the largest length of their group;
2. configurations (multisets of the few rounded lengths that fit one sequence) are chosen:
   the largest length left is completed to the fullest sum by a bounded knapsack table over
   the others, and the configuration is used as often as its counts allow;
3. actual lengths take the slots of their group in falling order, which can only shorten;
4. the small lengths go, longest first, to the sequences with the least room that holds
   them, and what is left to new sequences.

The plan is a list of runs (so many equal sequences, each with these lengths at these
offsets), whose number depends on the distinct lengths, not on the documents. Every piece
then finds its place by its rank among the pieces of its length; ranks come from counts per
(length, partition), so no length, however common, meets in one task.

Defined cases: null or empty text is a document of the closing id alone; equal documents
are packed each; an empty table packs into nothing.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import extend, map_arrow, materialise
from .tokens import default_tokenizer, encode_batches

GROUPS = 256
SMALL_PART = 8


# --- pieces -------------------------------------------------------------------------
def pieces(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32. Documents longer than
    ``capacity`` are cut from the end, so that only their first piece is shorter."""
    src = df.select(id_col, text)
    schema = extend(src.select(id_col).schema, "piece int, start long, length long, ids_crc32 long")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        for batch in batches:
            for a, coded in encode_batches(batch.column(text), tokenizer):
                row, cols = [], ([], [], [], [])
                for k, raw in enumerate(coded):
                    raw += end
                    n, at, p = len(raw) // 4, 0, 0
                    while at < n:
                        size = (n - at) % capacity or capacity
                        row.append(a + k)
                        for c, v in zip(cols, (p, at, size, zlib.crc32(raw[at * 4:(at + size) * 4]))):
                            c.append(v)
                        at, p = at + size, p + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in cols[1:])], names=schema.names)

    return map_arrow(src, run, schema)


# --- the plan, from the histogram ------------------------------------------------------
def group_lengths(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Groups of near-equal cardinality, largest lengths first: [[length, count], ...]; a
    length may be split between two groups."""
    size = max(1, -(-sum(counts.values()) // groups))
    out, held = [[]], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if held == size:
                out.append([])
                held = 0
            take = min(left, size - held)
            out[-1].append([length, take])
            held, left = held + take, left - take
    return [g for g in out if g]


def fullest(sizes: list[int], left: list[int], first: int, capacity: int) -> dict[int, int]:
    """A configuration that holds size ``first`` and, by a bounded knapsack over the sizes
    after it, reaches the fullest sum."""
    room = capacity - sizes[first]
    reach = np.full(room + 1, -1, np.int64)       # the size index that last reached a sum
    used = np.zeros(room + 1, np.int64)
    reach[0] = len(sizes)
    for i in range(first, len(sizes)):
        s, have = sizes[i], left[i] - (i == first)
        if have <= 0 or s > room:
            continue
        new, used[:] = reach.copy(), 0
        for at in range(s, room + 1):
            if new[at] < 0 and new[at - s] >= 0 and used[at - s] < have:
                new[at], used[at] = i, used[at - s] + 1
        reach = new
        if reach[room] >= 0:
            break
    at, found = int(np.flatnonzero(reach >= 0)[-1]), {first: 1}
    while at:
        i = int(reach[at])
        found[i] = found.get(i, 0) + 1
        at -= sizes[i]
    return found


def plan(histogram: dict[int, int], capacity: int = 2048, groups: int = GROUPS,
         small_part: int = SMALL_PART) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Runs (first sequence, number of sequences, [(length, offset), ...])."""
    edge = capacity // small_part
    large = group_lengths({k: v for k, v in histogram.items() if k > edge}, groups)
    sizes, left = [g[0][0] for g in large], [sum(c for _, c in g) for g in large]
    runs: list[list] = []          # [count, lengths, room]
    for i in range(len(sizes)):
        while left[i]:
            config = fullest(sizes, left, i, capacity)
            times = min(left[k] // n for k, n in config.items())
            for k, n in config.items():
                left[k] -= n * times
            # substitute actual lengths: each slot takes a stretch of its group, in order
            slots = [k for k, n in config.items() for _ in range(n)]
            stretches = [_take(large[k], times) for k in slots]
            done = 0
            while done < times:
                step = min(s[0][1] for s in stretches)
                lengths = [s[0][0] for s in stretches]
                runs.append([step, lengths, capacity - sum(lengths)])
                done += step
                for s in stretches:
                    s[0][1] -= step
                    if not s[0][1]:
                        s.pop(0)
    # best fit of the small lengths into the least room that holds them
    by_room = sorted(range(len(runs)), key=lambda r: runs[r][2])
    rooms = [runs[r][2] for r in by_room]
    for length in sorted((k for k in histogram if k <= edge), reverse=True):
        count = histogram[length]
        while count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                times, rest = divmod(count, per)
                for t, n in ((times, per), (1 if rest else 0, rest)):
                    if t:
                        runs.append([t, [length] * n, capacity - length * n])
                        _insert(rooms, by_room, runs, len(runs) - 1)
                break
            r = by_room[at]
            have, lengths, room = runs[r]
            per = min(room // length, count)
            times = min(have, count // per)
            del rooms[at], by_room[at]
            if times < have:
                runs.append([have - times, list(lengths), room])
                _insert(rooms, by_room, runs, len(runs) - 1)
            runs[r] = [times, lengths + [length] * per, room - length * per]
            _insert(rooms, by_room, runs, r)
            count -= times * per
    out, sequence = [], 0
    for times, lengths, _ in runs:
        offsets = np.cumsum([0, *lengths[:-1]]).tolist()
        out.append((sequence, times, list(zip(lengths, offsets))))
        sequence += times
    return out


def _take(group: list[list[int]], n: int) -> list[list[int]]:
    """The next n members of a group as [[length, count], ...]."""
    out = []
    while n:
        length, have = group[0]
        step = min(n, have)
        out.append([length, step])
        n -= step
        if step == have:
            group.pop(0)
        else:
            group[0][1] = have - step
    return out


def _insert(rooms: list[int], by_room: list[int], runs: list, r: int) -> None:
    at = bisect.bisect_left(rooms, runs[r][2])
    rooms.insert(at, runs[r][2])
    by_room.insert(at, r)


def slots(runs, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank) with each stretch's first rank, sequence and offset."""
    rank, rows = {}, []
    for first, times, items in runs:
        for length, offset in items:
            r = rank.get(length, 0)
            rows.append((length << 40 | r, r, first, offset))
            rank[length] = r + times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in (zip(*rows) if rows else ([],) * 4))


# --- packing ----------------------------------------------------------------------------
def pack(rows: DataFrame, capacity: int = 2048, length: str = "length") -> DataFrame:
    """``rows`` with sequence_id and offset. Every row of the input (columns as they are) must
    have a length from 1 to ``capacity``."""
    kept = materialise(rows.withColumn("_part", F.spark_partition_id()), "pieces")
    counts = kept.groupBy("_part", length).agg(F.count("*").alias("_n"))
    runs = plan({r[length]: r["n"] for r in
                 kept.groupBy(length).agg(F.count("*").alias("n")).collect()}, capacity)
    key, base, first, offset = slots(runs, capacity)
    earlier = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    # ordered by the whole row, so that a task run again gives the same ranks
    inside = Window.partitionBy("_part", length).orderBy(*[c for c in kept.columns if c not in ("_part", length)])
    ranked = (kept.withColumn("_rank", F.row_number().over(inside) - 1)
              .join(counts, ["_part", length])
              .withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_part"))
    schema = extend(kept.drop("_part").schema, "sequence_id long, offset long")

    def place(batches):
        for batch in batches:
            size = batch.column(length).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, size << 40 | rank, side="right") - 1
            cols = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(first[at] + rank - base[at]), pa.array(offset[at])], names=schema.names)

    return map_arrow(ranked, place, schema)


def op5_packing(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(pieces(docs, default_tokenizer()))


def stage(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Pipeline stage: the pieces of the documents and their places in sequences."""
    return pack(pieces(docs, default_tokenizer()))
