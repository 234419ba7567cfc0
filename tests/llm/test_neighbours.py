import numpy as np
import pytest

from tickloom.llm import neighbours as nb
from tickloom.llm.queries import QUERIES


def brute(rows, k):
    """query -> [(score, id)] by comparing with all."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % 20 == 0:
            found = sorted((-float(v @ w), i) for i, w in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


@pytest.mark.parametrize("radius", [0, 1, 3, 20, 64])
def test_probing_finds_all_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 63, (300, 2), np.uint64)
    codes[100:200] = codes[:100] ^ (np.uint64(1) << rng.integers(0, 64, (100, 2), np.uint64))
    queries = codes[50:60]
    got = nb.MultiIndex(codes, 128).within(queries, radius)
    assert (got == np.array([nb.distances(codes, q) <= radius for q in queries])).all()


def test_recall_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, 20)
    got = {}
    for r in QUERIES["op8_multi_index_neighbours"](spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    vectors = dict(rows)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in {f[1] for f in found}
        assert [f[1:] for f in found] == sorted((f[1:] for f in found), key=lambda f: (-f[1], f[0]))
        assert np.allclose([f[2] for f in found], [np.dot(np.array(vectors[q], float), np.array(vectors[f[1]], float)) for f in found], rtol=1e-12)
    hits = sum(len({f[1] for f in got[q]} & {w[0] for w in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_equal_vectors_tie_wherever_they_stand():
    """3,000 equal vectors among 8,192 of 64 components: one score, smaller ids first."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(8192, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    same = rng.permutation(8192)[:3000]
    vectors[same] = vectors[same[0]]
    coder = nb.Coder(vectors[:2000], 1.0, 20)
    queries = np.concatenate([vectors[same[:1]], rng.normal(size=(5, 64))])
    best = nb.best_in_shard(nb.MultiIndex(coder.codes(vectors), coder.bits), np.arange(8192), vectors, np.arange(-6, 0), queries, coder.query_codes(queries), coder.radius, coder.bits, 20)
    assert best[0][0].tolist() == sorted(same.tolist())[:20] and len(set(best[0][1].tolist())) == 1
    for (found, scores), q in zip(best, queries):
        assert scores.tolist() == [nb.products(vectors[[i]], q)[0] for i in found]


def test_many_equal_vectors_over_shards(spark, monkeypatch):
    monkeypatch.setattr(nb, "SHARD", 300)
    rng = np.random.default_rng(5)
    common = rng.normal(size=64)
    rows = [(i, (common if i % 3 else rng.normal(size=64)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nb.nearest(df.where("vec_id % 20 = 0"), df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 1500, 20):
        if q % 3:
            assert [v for _, v, _ in sorted(got[q])] == [i for i in range(1500) if i % 3 and i != q][:20]
            assert len({s for _, _, s in got[q]}) == 1


def test_lengths_that_differ(spark, monkeypatch):
    """Inner product, not angle; several shards, blocks and groups."""
    for name, value in (("SHARD", 100), ("BLOCK", 4), ("QUERIES", 7)):
        monkeypatch.setattr(nb, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=12) * rng.uniform(0.2, 3)).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = brute(rows, 20), {}
    for r in nb.nearest(df.where("vec_id % 20 = 0"), df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert sum(len(got[q] & {w[0] for w in want[q]}) for q in want) / (20 * len(want)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (20, [-1.0, 0.0]), (40, None), (1, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, v int")
    got = [tuple(r) for r in nb.nearest(df.where("vec_id % 20 = 0"), df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.5), (0, 3, 20, -1.0), (20, 1, 2, -0.5), (20, 2, 0, -1.0), (20, 3, 1, -1.0)]
    assert nb.nearest(df.limit(0), df).collect() == [] == nb.nearest(df, df.limit(0)).collect()
    one = df.where("vec_id = 0")
    assert nb.nearest(one, one).collect() == []


def test_one_very_common_vector(spark):
    rng = np.random.default_rng(9)
    common = rng.normal(size=16)
    rows = [(i, (common if i % 3 else rng.normal(size=16)).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = {}, brute(rows, 20)
    for r in nb.nearest(df.where("vec_id % 20 = 0"), df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in want:
        if q % 3:
            assert [v for _, v in sorted(got[q])] == [i for i in range(900) if i % 3 and i != q][:20]


@pytest.mark.parametrize("copies", ["every row twice", "one row twenty times"])
def test_repeated_ids_take_one_place(spark, copies, monkeypatch):
    """One group of small shards: copies meet in a shard and on merging."""
    for name, value in (("SHARD", 100), ("BLOCK", 4)):
        monkeypatch.setattr(nb, name, value)
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    rows[7] = (7, (1.2 * np.array(rows[0][1])).tolist())  # near to query 0
    want, got = brute(rows, 20), {}
    more = rows * 2 if copies == "every row twice" else rows + [rows[7]] * 19
    df = spark.createDataFrame(more, "vec_id long, embedding array<double>")
    for r in nb.nearest(df.where("vec_id % 20 = 0"), df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(got) == set(want)
    assert all([r for r, _ in g] == list(range(1, 21)) and len({v for _, v in g}) == 20 for g in got.values())
    assert got[0][0] == (1, 7)
    assert sum(len({v for _, v in got[q]} & {w[0] for w in want[q]}) for q in want) / (20 * len(want)) >= 0.9
