"""MaxScore search over several blocks: what is joined or sent to the driver must not grow with the queries."""

import pickle

from lapstats.llm import search


def _vectors(spark, rows=90, dim=5):
    data = [(i // 2 if i % 9 == 0 else i, [((i * 31 + j * 17) % 23 - 11) / (16.0 if j else 8e4 ** (i % 2) / 64) for j in range(dim - (i % 13 == 0))])
            for i in range(rows)] + [(None, [1.0] * dim), (500, None), (501, []), (502, [float("nan")] * dim)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3), data


def test_queries_are_neither_joined_nor_broadcast(spark, monkeypatch):
    monkeypatch.setattr(search, "CANDIDATE_BLOCK", 7)
    monkeypatch.setattr(search, "QUERY_BLOCK", 4)
    df, data = _vectors(spark)
    found = search.top_k(df, df.where("vec_id % 3 = 0"), k=4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    ok = [(i, q) for i, v in data if i is not None and (q := search.quantise(v, 256)) is not None]
    want = set()
    for qi in {i for i, _ in ok if i % 3 == 0}:
        best = sorted(((-sum(a * b for a, b in zip(q, v)), i) for j, q in ok if j == qi
                       for i, v in ok if i != qi and len(v) == len(q)))[:4]
        want |= {(qi, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in found.collect()} == want


def test_blocks_are_written_in_few_bytes_and_read_back_whole(spark):
    for top in (3, 40_000, 1 << 40):
        vectors = search.exact([[top, -top, 0], [1, 2, 3]])
        block = search.small(vectors)
        assert block.dtype == object or block.itemsize < 8
        back = search.unpacked(pickle.dumps(([1, 2], block), 5))
        assert back[0] == [1, 2] and back[1].dtype == vectors.dtype and (back[1] == vectors).all()
