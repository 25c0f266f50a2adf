import numpy as np

from tidemark.llm.ann import nearest_neighbours


def brute(rows, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) == 16 and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in ok if i != q)[:k]
            out[q] = near
    return out


def rows(n=1500):
    r = np.random.default_rng(1)
    x = r.standard_normal((n, 16)).astype(np.float32)
    x[600:900] = x[600]
    out = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    return out + [(100000, None), (100100, [0.0] * 16), (100200, [float("nan")] * 16), (100300, [1.0, None] * 8), (100400, [1.0] * 3), (None, out[3][1]), (100500, [])]


def test_recall_scores_and_ties(spark):
    data = rows()
    df = spark.createDataFrame([(v, i, 1) for i, v in data], "embedding array<float>, vec_id long, label int").repartition(4)
    got = {}
    for r in nearest_neighbours(spark, df, df.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = brute(data)
    assert set(got) == set(want)
    hits = total = 0
    vectors = {i: np.array(v, float) for i, v in data if i in want or i is not None and i < 1500}
    for q, near in want.items():
        found = sorted(got[q])
        assert [r for r, *_ in found] == list(range(1, 11)) and [x[1:] for x in found] == sorted(x[1:] for x in found)
        for _, score, v in found:
            assert v != q and abs(score - np.sqrt(((vectors[q] - vectors[v]) ** 2).sum())) < 1e-9
        hits += len({v for *_, v in found} & {v for _, v in near})
        total += len(near)
    assert hits / total >= 0.9
    assert [v for *_, v in sorted(got[600])] == list(range(601, 611))  # copies, by id


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in nearest_neighbours(spark, df, df.filter("vec_id % 100 = 0")).collect()] == [(0, 1, 2), (0, 2, 1)]
    assert nearest_neighbours(spark, df.filter("vec_id = 9"), df).collect() == []
    one = df.filter("vec_id = 0")
    assert nearest_neighbours(spark, one, one).collect() == []


def test_small_lists_are_probed_on_until_k_are_found(spark):
    r = np.random.default_rng(3)
    spots = r.standard_normal((300, 8)) * 100
    data = [(100 * i + j, [float(c) for c in spots[i] + 0.01 * r.standard_normal(8)]) for i in range(300) for j in range(3)]
    data += [(50_000 + i, [float(c) for c in spots[0]]) for i in range(900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    n = {}
    for x in nearest_neighbours(spark, df, df.filter("vec_id % 100 = 0"), lists=250).collect():
        n[x.query_id] = n.get(x.query_id, 0) + 1
    assert set(n.values()) == {10} and len(n) == sum(i % 100 == 0 for i, _ in data)


def test_split_lists_give_the_same(spark, monkeypatch):
    import tidemark.llm.ann as m

    df = spark.createDataFrame([(v, i) for i, v in rows(1000)], "embedding array<float>, vec_id long")
    run = lambda: sorted(map(tuple, m.nearest_neighbours(spark, df, df.filter("vec_id % 100 = 0"), lists=3).collect()))
    whole = run()
    monkeypatch.setattr(m, "BLOCK", 50)
    monkeypatch.setattr(m, "QUERIES", 1)
    assert run() == whole
