"""Dual-tree search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lapstats.llm import common, dualtree

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text.translate(LOWER)) if text else []


def brute(docs, items, k=10):
    d = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    d = [x for x in d if x[2]]
    n, total, df = len(d), sum(x[2] for x in d), Counter(t for x in d for t in x[1])
    out = []
    for item, text in set(items):
        rows = []
        for i, tf, size in d:
            m = 25 + 75 * size * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t, c in Counter(words(text)).items() if tf[t])
            if s > 0:
                rows.append((-s, i is None, i))
        rows.sort()
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(rows[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


ITEMS = "item_id long, text string, doc_id string, score int"


def test_awkward_rows(spark, awkward, nothing):
    items = [(1, "The same line"), (1, "The same line"), (1, "others OTHERS others"), (2, None), (3, ""), (4, "... !!"),
             (5, "é ÄÖ x" + "x" * 69_999), (None, "words that end well"), (6, "nobody-has zzz")]
    asked = spark.createDataFrame([(i, t, "a", 1) for i, t in items], ITEMS)
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    want = brute(docs, items)
    assert want and got(dualtree.top_k(awkward, asked)) == want
    assert got(dualtree.top_k(awkward, asked, item_bytes=40_000)) == want   # several groups of items
    assert got(dualtree.top_k(nothing, asked)) == [] and got(dualtree.top_k(awkward, asked.where("false"))) == []


@pytest.mark.parametrize("cells", [64, 1 << 23])
def test_random_texts_with_ties(spark, monkeypatch, cells):
    monkeypatch.setattr(dualtree, "DENSE_CELLS", cells)
    rg = random.Random(8)
    text = lambda n: " ".join(f"w{min(rg.randrange(1, 300), rg.randrange(1, 300))}" for _ in range(n))
    docs = [(i, text(rg.randint(0, 40))) for i in range(700)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(3, docs[9][1])]
    items = [(i, text(rg.randint(1, 30))) for i in range(40)] + [(90, docs[5][1])]
    found = dualtree.top_k(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                           spark.createDataFrame([(i, t, "", 0) for i, t in items], ITEMS))
    assert got(found) == brute(docs, items)


def test_node_pairs_are_pruned():
    """Of two kinds of texts, items of one kind score almost none of the other."""
    rg = np.random.default_rng(1)
    make = lambda base, n: [np.unique(base + rg.integers(0, 50, 12)) for _ in range(n)]
    tree = dualtree.ItemTree([(i, np.full(len(i), 100)) for i in make(0, 40)])
    cells = make(0, 64) + make(50, 960)
    ends = np.cumsum([0] + [len(c) for c in cells])
    (part,) = dualtree.lay_out(list(range(1024)), np.full(1024, 25), ends, np.concatenate(cells), np.ones(ends[-1], np.int64),
                               np.full(100, 10))
    best = dualtree.Best(40, 10)
    scored = dualtree.walk(tree, best, *part)
    assert all(len(r) == 10 for r in best.rows) and scored <= 40 * 64 * 1.5


def test_terms_are_compared_not_hashed():
    """Complementary words whose polynomial hashes collide are told apart; long ones too."""
    flip = {"a": "b", "b": "a"}
    w = "a"
    while len(w) < 1024:
        w += "".join(flip[c] for c in w)
    other = "".join(flip[c] for c in w)
    v = dualtree.Vocabulary([b"ab", w.encode()])
    raw = np.frombuffer((w + " " + other + " ab ba").encode(), np.uint8)
    s, e, _ = common.words(raw, np.array([0, len(raw)]), dualtree.NO_TERM)
    assert v.find(raw, s, e).tolist() == [1, -1, 0, -1]


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    assert got(dualtree.op11_dual_tree(spark, sf)) == brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
