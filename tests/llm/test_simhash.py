import random

import numpy as np
import pytest
import xxhash

from tickloom.llm import components, simhash
from tickloom.llm.queries import QUERIES


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(fps, radius=2):
    """doc -> smallest doc reachable, by comparing all with all."""
    docs = sorted(fps)
    values = np.array([fps[d] for d in docs], np.uint64)
    label = np.arange(len(docs))
    near = np.array([np.bitwise_count(values ^ v) <= radius for v in values])
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return {d: docs[k] for d, k in zip(docs, label)}
        label = new


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one two", "a b c", "a b c d", "É é A a\x0bb\x0cc\x1cd  e", "the cat " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_pairs(seed, radius):
    rng = random.Random(seed)
    values, group = [], []
    for g in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 70, 5])):
            v = base
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
            group.append(g)
    got = {(i, j) for a, b in simhash.near_pairs(np.array(values, np.uint64), np.array(group), radius) for i, j in zip(a.tolist(), b.tolist())}
    n = len(values)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if group[i] == group[j] and (values[i] ^ values[j]).bit_count() <= radius}
    assert got == want
    root = simhash._forest(n, simhash.near_pairs(np.array(values, np.uint64), np.array(group), radius))
    assert all(root[i] == root[j] for i, j in want) and (root <= np.arange(n)).all()


def test_query_on_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    want = classes(fps)
    got = QUERIES["op5_simhash_near_dedup"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {d: (fps[d], want[d]) for d in fps}
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("max_bucket", [1024, 4])
def test_links_are_whole(spark, max_bucket, monkeypatch):
    """Chains, stars and hot buckets, over both cuts."""
    rng = random.Random(7)
    monkeypatch.setattr(simhash, "CHUNK", 50)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            values.add(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
    values |= {1 << b for b in range(64)} | {0}
    values = sorted(values)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    nodes = spark.createDataFrame(rows, "fp long")
    links = simhash.links_in_buckets(simhash.buckets(nodes, 2, max_bucket), 2)
    found = components.components(links).collect()
    root = {r.node & (1 << 64) - 1: r.root for r in found}
    want = classes(dict(enumerate(values)))
    groups = {}
    for k, v in enumerate(values):
        groups.setdefault(want[k], set()).add(root.get(v, ("alone", v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(100, 180)] + [(5, k) for k in range(6, 90)] + [(3, 3), (7, 6), (500, 400)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 181)}, **{k: 5 for k in range(5, 90)}, 400: 400, 500: 400}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark):
    base = [f"word{k}" for k in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    rows = [(5, " ".join(base), 1), (3, " ".join(near), 2), (9, " ".join(base), 3), (4, "quite another text", 4), (4, "quite another text", 4)]
    rows += [(7, None, 5), (8, "", 6), (None, "no id", 7), (None, " ".join(base), 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, r.component_id) for r in kept.collect())
    apart = (simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])).bit_count()
    assert got == [(-1, 7), (-1, 8), (3, 2), (4, 4), *([] if apart <= 2 else [(5, 1)]), (7, 5)]
    assert simhash.drop_near_duplicates(docs.limit(0)).collect() == []


def test_many_copies(spark):
    rows = [(k, "the same text in many rows of the table" if k % 3 else f"own text of row {k} {k * 7} {k * 13}") for k in range(600)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] == 1 for k in range(600) if k % 3)
