"""Ranked lexical search by two trees (operator 11).

Items and documents are sparse vectors over the items' terms, with whole numbers that are
never negative: an item's coordinate is the term's weight times its occurrences, a document's
is its saturated term frequency, and the score is their inner product. Both sides stand in
hierarchies whose nodes hold the maximum of every coordinate below them, so the product of an
item node and a document node bounds every score between the two. A pair of nodes whose bound
is below the weakest k-th score among the node's items is dropped with all that is below it;
pairs that are left are split on both sides, and pairs of leaves are scored in full, those
with the highest bounds first. Nothing that could enter a result is dropped, ties included.

How it runs on Spark:

1. The items are dealt into groups of about ``ITEM_BYTES`` of text (one group, unless there are
   very many). A group's terms and tree are what every task gets, so their size is bounded;
   each group makes its own pass over the documents.
2. One map over the whole texts finds, per document, its number of terms and the occurrences
   of the group's terms, and writes blocks of sparse vectors with their counts to the shared
   folder. Terms are compared byte by byte, not by hash. The counts (documents, terms,
   documents per term) are summed by Spark.
3. One map over the blocks builds each block's document tree and walks it against the item
   tree; the k-th scores go on from block to block within a task. A task returns at most k
   rows per item, and a ranking per item merges the tasks.

Defined cases: a null or empty text has no term, is not counted and never found; rows of
documents that repeat an id are ranked each; null document ids come last among ties; items
equal in id and text are one item, others that share an id are ranked each; an item without
terms, or whose terms no document has, returns nothing. Other columns are not read.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import LOWER, PACKED, chunks, map_arrow, materialise, packed, packed_hash, text_buffer, words

ITEM_BYTES = 4 << 20        # text of the items of one group
BLOCK_ROWS = 1024           # documents of a block
BLOCK_CELLS = 1 << 17       # term occurrences (distinct per document) of a block
DENSE_CELLS = 1 << 23       # documents x terms that are laid out at once
ITEM_LEAF, DOC_LEAF = 8, 16
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
NO_TERM = np.ones(256, bool)
NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


# --- terms ----------------------------------------------------------------------------
def terms(text: str | None) -> Counter:
    """Occurrences of each term of a text; only A-Z are lower-cased."""
    return Counter(TERM.findall(text.encode().lower())) if text else Counter()


class Vocabulary:
    """The terms of a group of items, found in texts by exact comparison."""

    def __init__(self, found: list[bytes]):
        self.size = len(found)
        self.long = {t: i for i, t in enumerate(found) if len(t) > PACKED}
        short = [(t, i) for i, t in enumerate(found) if len(t) <= PACKED]
        raw = np.frombuffer(b"".join(t for t, _ in short), np.uint8)
        length = np.array([len(t) for t, _ in short], np.int64)
        key = packed(raw, np.cumsum(length) - length, length)
        h = packed_hash(key, length)
        order = np.argsort(h, kind="stable")
        self.hash, self.key, self.length = h[order], key[:, order], length[order]
        self.index = np.array([i for _, i in short], np.int64)[order]
        # terms that share a hash stand side by side; all of them are compared
        self.most = int(np.unique(self.hash, return_counts=True)[1].max()) if len(short) else 0

    def find(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Term number of each stretch of lower-cased bytes, or -1."""
        out, length = np.full(len(start), -1, np.int64), end - start
        if self.most:
            at = np.flatnonzero(length <= PACKED)
            key = packed(raw, start[at], length[at])
            h = packed_hash(key, length[at])
            first = np.searchsorted(self.hash, h)
            for step in range(self.most):
                c = np.minimum(first + step, len(self.hash) - 1)
                same = np.flatnonzero((self.hash[c] == h) & (self.length[c] == length[at]))
                same = same[(self.key[:, c[same]] == key[:, same]).all(axis=0)]
                out[at[same]] = self.index[c[same]]
        if self.long:
            for i in np.flatnonzero(np.isin(length, [len(t) for t in self.long])).tolist():
                out[i] = self.long.get(raw[start[i]:end[i]].tobytes(), -1)
        return out


# --- documents as blocks of sparse vectors -----------------------------------------------
def blocks(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text: str) -> DataFrame:
    """One row per block: ``block`` (ids, terms per document, row ends, term numbers,
    occurrences of documents with a term of the vocabulary), how many documents have a term
    at all, their terms, and documents per term number."""

    def run(batches):
        ids, n, ends, idx, tf = [], [], [0], [], []
        count = [0, 0]

        def block():
            cells = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (idx, tf)]
            df_of, df = np.unique(cells[0], return_counts=True)
            body = pickle.dumps((list(ids), np.array(n, np.int64), np.array(ends, np.int64), *cells), 5)
            row = {"block": body, "docs": count[0], "terms": count[1], "df_of": df_of.tolist(), "df": df.tolist()}
            for x in (ids, n, idx, tf):
                x.clear()
            ends[:], count[:] = [0], [0, 0]
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("block", pa.binary()), ("docs", pa.int64()), ("terms", pa.int64()),
                ("df_of", pa.list_(pa.int64())), ("df", pa.list_(pa.int64()))]))

        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, b in chunks(offsets):
                part = LOWER[raw[offsets[a]:offsets[b]]]
                start, end, row = words(part, offsets[a:b + 1] - offsets[a], NO_TERM)
                size = np.bincount(row, minlength=b - a)
                term = vocabulary.find(part, start, end)
                hit = term >= 0
                pair, often = np.unique(row[hit] * vocabulary.size + term[hit], return_counts=True)
                owner = pair // max(vocabulary.size, 1)
                have, first = np.unique(owner, return_index=True)
                count[0] += int((size > 0).sum())
                count[1] += int(size.sum())
                last, cells = np.append(first[1:], len(pair)), pair - owner * vocabulary.size
                names = batch.column(0).slice(a, b - a).to_pylist()
                for d, i, j in zip(have.tolist(), first.tolist(), last.tolist()):
                    ids.append(names[d])
                    n.append(int(size[d]))
                    idx.append(cells[i:j])
                    tf.append(often[i:j])
                    ends.append(ends[-1] + j - i)
                    if len(ids) >= BLOCK_ROWS or ends[-1] >= BLOCK_CELLS:
                        yield block()
        if count[0] or ids:
            yield block()

    return map_arrow(docs.select(id_col, text), run, "block binary, docs long, terms long, df_of array<long>, df array<long>")


# --- trees ------------------------------------------------------------------------------
class ItemTree:
    """Items as sparse vectors; level 0 has the leaves, the last level the root."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors = vectors
        # items with the same strongest terms stand together
        order = sorted(range(len(vectors)), key=lambda i: vectors[i][0][np.argsort(-vectors[i][1], kind="stable")[:4]].tolist())
        self.leaves = [order[i:i + ITEM_LEAF] for i in range(0, len(order), ITEM_LEAF)]
        self.levels = [[self._top([vectors[i] for i in leaf]) for leaf in self.leaves]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([self._top(below[i:i + 2]) for i in range(0, len(below), 2)])
        self.tables = []
        for leaf, (idx, _) in zip(self.leaves, self.levels[0]):
            table = np.zeros((len(idx), len(leaf)), np.int64)
            for j, i in enumerate(leaf):
                table[np.searchsorted(idx, vectors[i][0]), j] = vectors[i][1]
            # float64 sums are exact below 2**53; a coordinate of a document is at most 10**6
            self.tables.append(table.astype(np.float64) if table.sum(axis=0).max() * 10 ** 6 < 1 << 53 else table)

    @staticmethod
    def _top(vectors) -> tuple[np.ndarray, np.ndarray]:
        idx = np.unique(np.concatenate([i for i, _ in vectors]))
        top = np.zeros(len(idx), np.int64)
        for i, w in vectors:
            at = np.searchsorted(idx, i)
            top[at] = np.maximum(top[at], w)
        return idx, top


class Best:
    """The k best documents of each item so far: (score, id), ties to the smaller id."""

    def __init__(self, items: int, k: int):
        self.k, self.rows, self.floor = k, [[] for _ in range(items)], np.ones(items, np.int64)

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        rows = self.rows[item] + list(zip(scores.tolist(), ids))
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        self.rows[item] = rows[:self.k]
        if len(rows) >= self.k:
            self.floor[item] = self.rows[item][-1][0]   # an equal score may still win by its id


def walk(tree: ItemTree, best: Best, ids: list, dense: np.ndarray, columns: np.ndarray) -> int:
    """Search one block; ``dense`` has the documents' coordinates at the term numbers
    ``columns``. Returns the number of (item, document) pairs scored."""
    levels, scored = [], 0
    pad = -len(dense) % DOC_LEAF
    top = np.concatenate((dense, np.zeros((pad, dense.shape[1]), dense.dtype))) if pad else dense
    levels.append(top.reshape(-1, DOC_LEAF, dense.shape[1]).max(axis=1))
    while len(levels[-1]) > 1:
        below = levels[-1]
        if len(below) % 2:
            below = np.concatenate((below, np.zeros((1, below.shape[1]), below.dtype)))
        levels.append(below.reshape(-1, 2, below.shape[1]).max(axis=1))

    def at(idx):        # columns of a node's terms in this block, and which of its terms these are
        pos = np.searchsorted(columns, idx)
        ok = (pos < len(columns)) & (columns[np.minimum(pos, len(columns) - 1)] == idx)
        return pos[ok], ok

    def bounds(level, nodes, docs, deep):
        cols, ok = at(tree.levels[level][nodes][0])
        weight = tree.levels[level][nodes][1][ok].astype(np.float64)
        return levels[deep][docs][:, cols].astype(np.float64) @ weight * (1 + 1e-9)

    # weakest k-th score below each item node
    weakest = [np.array([best.floor[leaf].min() for leaf in tree.leaves])]
    for below in tree.levels[1:]:
        last = weakest[-1]
        weakest.append(np.array([last[2 * i:2 * i + 2].min() for i in range(len(below))]))
    level, deep = len(tree.levels) - 1, len(levels) - 1
    front = {0: np.zeros(1, np.int64)}
    while True:
        kept = {}
        for node, docs in front.items():
            bound = bounds(level, node, docs, deep)
            live = bound >= weakest[level][node]
            if live.any():
                kept[node] = (docs[live], bound[live])
        if not level and not deep or not kept:
            break
        front = {node: docs for node, (docs, _) in kept.items()}
        if deep:
            deep -= 1
            n = len(levels[deep])
            front = {node: (c := (docs[:, None] * 2 + np.arange(2)).ravel())[c < n] for node, docs in front.items()}
        if level:
            level -= 1
            n = len(tree.levels[level])
            front = {child: docs for node, docs in front.items() for child in (2 * node, 2 * node + 1) if child < n}
    for leaf, (docs, bound) in kept.items():
        order = np.argsort(-bound, kind="stable")
        docs, bound, items = docs[order], bound[order], tree.leaves[leaf]
        cols, ok = at(tree.levels[0][leaf][0])
        table = tree.tables[leaf][ok]
        done, step = 0, 2
        while done < len(docs) and bound[done] >= best.floor[items].min():
            rows = (docs[done:done + step][:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            rows = rows[rows < len(dense)]
            score = (dense[np.ix_(rows, cols)].astype(table.dtype) @ table).astype(np.int64)
            scored += score.size
            for j, item in enumerate(items):
                good = np.flatnonzero(score[:, j] >= best.floor[item])
                if len(good) > best.k:      # the k-th of these, ties with it included
                    kth = np.partition(score[good, j], -best.k)[-best.k]
                    good = good[score[good, j] >= kth]
                if len(good):
                    best.add(item, score[good, j], [ids[r] for r in rows[good].tolist()])
            done, step = done + step, step * 2
    return scored


def lay_out(ids: list, m: np.ndarray, ends: np.ndarray, idx: np.ndarray, tf: np.ndarray, weight: np.ndarray):
    """Parts of a block as (ids, dense, columns), documents with the same strong terms together;
    a block is halved until a part's documents x terms stay within DENSE_CELLS."""
    n = len(ids)
    owner = np.repeat(np.arange(n), np.diff(ends))
    value = (10 ** 9 * tf) // (1000 * tf + 8 * m[owner])
    strong = np.lexsort((-(value * weight[idx]), owner))[ends[:-1]]     # each document's strongest cell
    order = np.lexsort((-value[strong], idx[strong]))
    todo = [order]
    while todo:
        rows = todo.pop()
        cells = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in rows.tolist()])
        columns, col = np.unique(idx[cells], return_inverse=True)
        if len(rows) > 1 and len(rows) * len(columns) > DENSE_CELLS:
            todo += [rows[len(rows) // 2:], rows[:len(rows) // 2]]
            continue
        dense = np.zeros((len(rows), len(columns)), np.float32)     # whole numbers up to 10**6
        dense[np.repeat(np.arange(len(rows)), np.diff(ends)[rows]), col] = value[cells]
        yield [ids[r] for r in rows.tolist()], dense, columns


# --- search -----------------------------------------------------------------------------
def group_of(items: DataFrame, id_col: str, text: str, item_bytes: int) -> list[DataFrame]:
    """The items in groups of about ``item_bytes`` of text, by a hash of the row."""
    rows = items.select(id_col, text).distinct()
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = -(-size // item_bytes)
    part = F.pmod(F.xxhash64(id_col, text), F.lit(max(groups, 1)))
    return [rows.where(part == g) for g in range(groups)]


def top_k(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text",
          item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    schema = StructType([StructField("_item", items.schema[item_id].dataType), *StructType.fromDDL("_no int").fields,
                         StructField("doc_id", docs.schema[doc_id].dataType), *StructType.fromDDL("score long").fields])
    out = docs.sparkSession.createDataFrame([], schema).withColumn("_group", F.lit(0))
    for g, rows in enumerate(group_of(items, item_id, item_text, item_bytes)):
        asked = [(r[0], terms(r[1])) for r in rows.collect()]       # about item_bytes of text
        asked = [(i, t) for i, t in asked if t]
        if asked:
            out = out.unionByName(_search(docs, asked, k, doc_id, doc_text, schema).withColumn("_group", F.lit(g)))
    order = Window.partitionBy("_group", "_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("_item").alias(item_id), "rank", "doc_id", "score"))


def _search(docs: DataFrame, asked: list, k: int, doc_id: str, text: str, schema: StructType) -> DataFrame:
    known = sorted({t for _, ts in asked for t in ts})
    number = {t: i for i, t in enumerate(known)}
    kept = materialise(blocks(docs, Vocabulary(known), doc_id, text), "term-blocks")
    total = kept.agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    df = np.zeros(len(known), np.int64)
    for r in (kept.select(F.explode(F.arrays_zip("df_of", "df")).alias("x")).groupBy("x.df_of")
              .agg(F.sum("x.df").alias("n")).collect()):         # one row per term of the group
        df[r["df_of"]] = r["n"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    vectors = []
    for _, ts in asked:
        idx = np.array(sorted(number[t] for t in ts), np.int64)
        vectors.append((idx, weight[idx] * np.array([ts[known[i]] for i in idx.tolist()], np.int64)))
    tree, names = ItemTree(vectors), [i for i, _ in asked]
    kinds = [pa.int32(), pa.int64()]

    def run(batches):
        best = Best(len(names), k)
        for batch in batches:
            for body in batch.column(0):
                ids, n, ends, idx, tf = pickle.loads(body.as_py())
                if not ids:
                    continue
                m = np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], np.int64)
                for part in lay_out(ids, m, ends, idx, tf, weight):
                    walk(tree, best, *part)
        rows = [(names[i], i, d, s) for i, found in enumerate(best.rows) for s, d in found]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], to_arrow(schema[0])), pa.array(cols[1], kinds[0]), pa.array(cols[2], to_arrow(schema[2])),
             pa.array(cols[3], kinds[1])], names=schema.names)

    return map_arrow(kept.select("block"), run, schema)


def to_arrow(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(field.dataType)


def op11_dual_tree(spark, sf_dir) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + _PATTERN + "')"
SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, {_WORDS.format("text")} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark) WHERE text IS NOT NULL),
iq AS (SELECT q, unnest(t) AS term FROM i),
ic AS (SELECT q, term, count(*) AS times FROM iq GROUP BY q, term),
dt AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM dt, s GROUP BY term, s.n),
m AS (SELECT r, doc_id, 25 + (75 * len(t) * s.n) // s.l AS m FROM d, s),
z AS (SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM ic JOIN dt USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r),
k AS (SELECT q, m.doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, m.doc_id NULLS LAST)::INTEGER AS rank
      FROM z JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k JOIN i USING (q) WHERE rank <= 10
"""
