"""Suffix-array dedup, line dedup and the n-gram join against brute force."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from lapstats.llm import common, linededup, ngramjoin, suffixdedup
from lapstats.llm.common import components


def brute_removal(texts, length):
    seen = collections.defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen[t[p:p + length]].append((i, p))
    cover = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                cover[i][p:p + length] = True
    out = []
    for t, c in zip(texts, cover):
        edges = np.diff(np.concatenate(([0], c.astype(int), [0])))
        kept = bytes(np.frombuffer(t, np.uint8)[~c])
        out.append((len(t), int(c.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed, letters="abcdé"):
    rg = random.Random(seed)
    word = lambda: "".join(rg.choice(letters) for _ in range(rg.randint(1, 4)))
    shared = [" ".join(word() for _ in range(rg.randint(10, 40))) for _ in range(8)]
    texts = [None, "", " ", "ab" * 200, "x" * 300]
    for _ in range(70):
        texts.append(" ".join(rg.choice(shared) if rg.random() < 0.4 else " ".join(word() for _ in range(rg.randint(3, 30)))
                              for _ in range(rg.randint(1, 5))))
    return texts + [texts[9], texts[9], texts[20]]


@pytest.mark.parametrize("hot", [512, 2])
@pytest.mark.parametrize("length", [24, 40])
def test_suffix_dedup(spark, monkeypatch, hot, length):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    texts = passages(length)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.digest(df, length).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removal([(t or "").encode() for t in texts], length)


def test_suffix_sort_is_a_suffix_sort():
    rg = np.random.default_rng(1)
    raw = rg.integers(97, 99, 400).astype(np.uint8)
    start, end = np.arange(0, 400, 4), np.full(100, 400)
    s = suffixdedup.Suffixes(raw, start, end)
    sizes = np.array([1, 2, 3, 60, 34])
    order, a = s.sort(sizes), 0
    for n in sizes:
        assert order[a:a + n].tolist() == sorted(range(a, a + n), key=lambda i: raw[start[i]:end[i]].tobytes())
        a += n


def test_suffix_verification_shortens_wrong_extensions():
    raw = np.frombuffer(b"abcdeabcXe", np.uint8)
    s = suffixdedup.Suffixes(raw, np.array([0, 5]), np.array([5, 10]))
    assert s.verified(np.array([0]), np.array([1]), np.array([5])).tolist() == [3]


def test_suffix_dedup_awkward(awkward, nothing, spark):
    got = suffixdedup.digest(awkward)
    want = brute_removal([(r.text or "").encode()[:9000] for r in awkward.collect()], 400)
    assert got.count() == awkward.count() == len(want)
    by = {r.doc_id: r for r in got.collect() if r.doc_id}
    assert by[9].n_removed == 70_000 and by[10].n_spans == 1 and by[6].n_removed == 0 and by[1].n_bytes == 0
    assert suffixdedup.digest(nothing).count() == 0
    staged = suffixdedup.stage(spark, awkward, None)
    assert staged.columns == awkward.columns and staged.count() == awkward.count()
    assert suffixdedup.stage(spark, nothing, None).count() == 0


def brute_groups(docs, n, percent):
    sets = {}
    for k, t in docs.items():
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        sets[k] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("n,percent,block", [(3, 90, 1024), (5, 80, 1024), (2, 50, 3)])
def test_ngram_join_with_chains_of_edits(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    rg = random.Random(n * percent)
    word = lambda: "".join(rg.choice("abcde") for _ in range(rg.randint(1, 3)))
    docs = {1: None, 2: "", 3: "one", 4: "ONE", 5: "one two"}
    for _ in range(12):
        base = [word() for _ in range(rg.randint(5, 160))]
        for _ in range(rg.randint(1, 14)):      # each copy starts from the one before: long chains
            for _ in range(rg.randint(0, 3)):
                base[rg.randrange(len(base))] = word()
            docs[len(docs) + 1] = rg.choice([" ", "\n"]).join(base)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.join(df, n, percent).collect()}
    assert got == brute_groups(docs, n, percent)


def test_ngram_join_links_texts_of_high_size_classes(spark):
    rg = random.Random(97)
    docs = {}
    for _ in range(4):
        base = [f"w{rg.randrange(10**9)}" for _ in range(302)]      # 300 shingles
        for _ in range(3):
            docs[len(docs) + 1] = " ".join(base)
            base[rg.randrange(len(base))] = f"w{rg.randrange(10**9)}"
    assert min(ngramjoin.Parts(97).classes(300)) >= 64
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.join(df, 3, 97).collect()}
    assert got == brute_groups(docs, 3, 97) and {c for _, c in got.values()} == {1, 4, 7, 10}


def test_region_keys_hold_every_size_class():
    s = np.sort(np.random.default_rng(5).integers(0, 2**64, 200, dtype=np.uint64))
    for percent in (50, 80, 90, 97, 99):
        parts = ngramjoin.Parts(percent)
        assert len(parts.edges) - 2 <= parts.low
        for j in parts.classes(len(s)):
            assert set((parts.keys(s, j, ngramjoin.running(s)) & np.uint64(parts.low)).tolist()) == {j}


def test_parts_always_meet():
    rg = np.random.default_rng(4)
    for percent in (50, 80, 90):
        parts = ngramjoin.Parts(percent)
        for n in (2, 9, 11, 40, 333):
            for _ in range(40):
                a = np.unique(rg.integers(0, 2**64, n, dtype=np.uint64))
                drop = rg.integers(0, n * (100 - percent) // 100 + 1)
                b = np.sort(rg.permutation(a)[: len(a) - drop])
                if len(b) and 100 * len(b) >= percent * len(a) and len(a) != len(b):
                    meet = set(parts.classes(len(a))) & set(parts.classes(len(b)))
                    keys = [[parts.keys(s, j, ngramjoin.running(s)) for j in meet] for s in (a, b)]
                    assert any(np.intersect1d(x, y).size for x, y in zip(*keys))
                    for j in meet:
                        x, y = (np.frombuffer(parts.sketch(s, j, ngramjoin.running(s)), np.uint8) for s in (a, b))
                        assert (x != y).sum() <= len(a) - len(b) <= parts.differ(len(a), len(b))


def test_ngram_join_awkward(awkward, nothing, spark):
    got = ngramjoin.join(awkward, 3, 90).collect()
    assert len(got) == awkward.count()
    assert {r.component_id for r in got if r.doc_id == 7} == {7}
    assert ngramjoin.join(nothing).count() == 0
    staged = ngramjoin.stage(spark, awkward, None)
    assert staged.columns == awkward.columns
    assert sorted(r.doc_id for r in staged.collect() if r.doc_id) == [1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13]


def near_copies(count, words, edits, seed=5):
    rg = random.Random(seed)
    base = [f"w{rg.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(rg.randint(0, edits)):
            copy[rg.randrange(words)] = f"v{rg.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("edits", [1, 4])
def test_a_large_group_needs_links_not_pairs(spark, monkeypatch, edits):
    """Rows of proposed pairs follow the members of a group, not their pairs; no link is lost
    where most pairs of the group are too far apart."""
    made = []
    plain = ngramjoin.crossing
    monkeypatch.setattr(ngramjoin, "crossing", lambda *a: (lambda df: (made.append(df.count()), df)[1])(plain(*a)))
    counts = []
    for size in (100, 300):
        made.clear()
        docs = dict(enumerate(near_copies(size, 120, edits)))
        df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.join(df, 3, 90).collect()}
        assert got == brute_groups(docs, 3, 90)
        counts.append(made[0] if made else 0)
    assert counts[1] <= 6 * max(counts[0], 30)


def test_words_of_like_form_are_different_shingles():
    flip, w = {"a": "b", "b": "a"}, "a"
    while len(w) < 1024:
        w += "".join(flip[c] for c in w)
    pair = [w.encode(), "".join(flip[c] for c in w).encode()]
    sets = ngramjoin.shingle_sets(np.frombuffer(b"".join(pair), np.uint8), np.array([0, 1024, 2048]), 3)
    assert sets[0].tolist() != sets[1].tolist()


def test_join_stage_decides_each_row(spark):
    a, b, c = near_copies(1, 60, 0, 1)[0], near_copies(1, 60, 0, 2)[0], near_copies(1, 60, 0, 3)[0]
    rows = [(1, a), (1, b), (2, a + " end"), (3, c), (3, c), (None, c), (None, b + " x"), (None, "lonely text of its own"),
            (None, None), (None, None), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "de", None, 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in ngramjoin.stage(spark, df, None).collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (3, c), (None, "lonely text of its own"), (None, None), (4, None), (5, "")], key=repr)


def test_components(spark):
    rg = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rg.randint(100, 300), rg.randint(100, 300)) for _ in range(150)] + [(500, 500)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {v: find(v) for v in parent if v != find(v)}
    assert {k: v for k, v in got.items() if k != v} == want


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_line_dedup(spark, unit):
    gap = "\n" if unit == "line" else "\n\n"
    a, b, c = "A line that comes more than once.", "Another one with enough words in it.", "Short one."
    texts = [(2, gap.join([a, b, a])), (1, gap.join([c, a.upper() + "  "])), (3, gap.join([b, c, "own words of the third one"])), (4, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.text, [(x.unit, x.start, x.end) for x in r.removed]) for r in linededup.dedup(df, unit).collect()}
    g = len(gap)
    assert got[1] == (texts[1][1], [])
    assert got[2] == (b + gap, [(0, 0, len(a)), (2, len(a) + len(b) + 2 * g, 2 * len(a) + len(b) + 2 * g)])
    assert got[3] == (gap.join([c, "own words of the third one"]), [(0, 0, len(b))])
    assert got[4] == (None, [])


def test_line_dedup_awkward(awkward, nothing):
    got = linededup.dedup(awkward)
    assert got.columns == [*awkward.columns, "n_units_removed", "removed"] and got.count() == awkward.count()
    rows = got.collect()
    assert all(r["_doc"] == "k" for r in rows)
    assert [r.n_units_removed for r in rows if r.doc_id == 6] == [0]
    assert [r.n_units_removed for r in rows if r.doc_id == 7] == [1, 1]
    assert linededup.dedup(nothing).count() == 0


def test_op2_takes_short_lines_and_scripts_without_spaces(spark, tmp_path):
    texts = [(1, "Share\n \n我们的产品非常好用请联系客服\nown"), (2, "share \n \n我们的产品非常好用请联系客服\nother"), (3, "Share")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_units_removed) for r in linededup.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (texts[0][1], 0), 2: (" \nother", 2), 3: ("", 1)}


def test_line_dedup_rows_without_id_or_with_a_shared_one(spark):
    a, b, c, d = (f"line {x} of five words" for x in "abcd")
    texts = [(1, f"{a}\n{b}"), (None, f"{c}\n{b}"), (None, f"{d}\nits own line stays here"), (None, f"{d}\nand this one stays too"),
             (5, "one text of this id"), (5, "another text of this id"), (6, "x y z u v"), (6, "X y z u v")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = linededup.dedup(df).collect()
    assert {r.text for r in got if r.doc_id == 5} == {"one text of this id", "another text of this id"}
    assert sorted(r.n_units_removed for r in got if r.doc_id == 6) == [0, 1]
    lone = {r.text for r in got if r.doc_id is None}
    assert f"{c}\n" in lone and len(lone) == 3
    assert lone - {f"{c}\n"} in ({f"{d}\nits own line stays here", "and this one stays too"},
                                {"its own line stays here", f"{d}\nand this one stays too"})
    # equal texts without an id are different documents
    same = linededup.dedup(spark.createDataFrame([(None, a), (None, a)], df.schema)).collect()
    assert sorted(r.text for r in same) == ["", a]


def test_scratch_tables_go_with_their_stage(spark, monkeypatch, tmp_path):
    """What a stage wrote on the way is deleted once its documents are written, and so are the
    documents that it read; the result stays whole."""
    docs = spark.createDataFrame([(i, f"{'abcdefg ' * 40}{i}", "en", "s", 1) for i in range(6)] + [(9, "own text", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(suffixdedup.stage(spark, docs, None).collect(), key=str)
    made, path = [], common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda s, name: made.append((name, path(s, name))) or made[-1][1])
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("plain", lambda s, d, f: d), ("cut", suffixdedup.stage), ("last", lambda s, d, f: d)])
    got = corpus_pipeline.run(spark, str(tmp_path))
    left = {name for name, p in made if os.path.exists(p.removeprefix("file:"))}
    assert left == {"cut"} and {"plain", "anchors", "contexts"} <= {name for name, _ in made}
    assert sorted(got.collect(), key=str) == want


@pytest.mark.parametrize("stage, left", [(suffixdedup.stage, {"repeated-windows"}),
                                         (ngramjoin.stage, {"near-copies", "repeated-rows"})])
def test_a_stage_keeps_only_what_its_rows_need(spark, monkeypatch, stage, left):
    """Tables made on the way are gone when the stage returns, before its rows are written; null texts,
    other columns and repeated rows come through."""
    long = "abcdefg " * 40
    rows = [(i, f"{long}{i} é", "en", float(i)) for i in range(4)] + [(4, None, None, None), (5, "own text", "en", 0.5), (5, "own text", "en", 0.5)]
    docs = spark.createDataFrame([*rows, (6, long, "en", 1.0), (7, long, "en", 1.0)], "doc_id long, text string, lang string, score double")
    made, path = [], common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda s, name: made.append((name, path(s, name))) or made[-1][1])
    got = stage(spark, docs, None)
    assert {name for name, p in made if os.path.exists(p.removeprefix("file:"))} == left
    assert got.columns == docs.columns and len(made) > 3
    found = {r.doc_id: r for r in got.collect()}
    assert found[4] == (4, None, None, None) and found[5].text == "own text"
    if stage is suffixdedup.stage:
        assert [found[i].text for i in (0, 1, 6, 7)] == ["0 é", "1 é", "", ""] and got.count() == len(rows) + 2


def test_a_stage_that_fails_leaves_no_scratch_tables(spark, monkeypatch):
    made, path = [], common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda s, name: made.append(path(s, name)) or made[-1])

    def broken():
        common.materialise(spark.range(3), "half")
        raise RuntimeError("stage")
    with pytest.raises(RuntimeError, match="stage"):
        common.staged(spark, "whole", broken)
    assert len(made) == 1 and not os.path.exists(made[0].removeprefix("file:"))
    kept = common.materialise(spark.range(3), "kept")
    assert kept.count() == 3 and common._MADE.get() is None
