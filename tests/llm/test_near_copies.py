import random
from itertools import combinations

import numpy as np

import corpus_pipeline as cp
from tickloom.llm import near_copies as nc


def plain(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def least_of_group(texts, at_least=0.8):
    sets, least = {d: plain(t) for d, t in texts.items()}, {d: d for d in texts}
    for a, b in combinations(sorted(texts), 2):
        if least[a] != least[b] and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= at_least * len(sets[a] | sets[b])):
            old, new = max(least[a], least[b]), min(least[a], least[b])
            least = {d: new if x == old else x for d, x in least.items()}
    return least


def planted(seed=3):
    """Texts, copies with words changed, cut ends, and chains of edits of edits."""
    rng = random.Random(seed)
    texts, d = {}, 0
    for k in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([8, 60, 300]))]
        texts[d] = " ".join(words)
        for e in range(1, 6):
            new = list(words)
            for _ in range(rng.randint(1, max(1, len(words) // 40))):
                new[rng.randrange(len(new))] = f"new{rng.randrange(10**6)}"
            if e == 5:
                new = new[: -len(new) // 10]
            if k % 5 == 0:
                words = new
            texts[d + e] = " ".join(new)
        d += 6
    return texts


def test_planted_edits(spark):
    texts = planted()
    least = least_of_group(texts)
    assert 30 < len(set(least.values())) < 140
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(cp.STAGES)["near_dedup"](spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d in texts if least[d] == d}


def test_stage_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    least = least_of_group(texts)
    kept = {r.doc_id for r in cp.without_near_copies(spark, docs, sf_dir).collect()}
    assert kept == {d for d in texts if least[d] == d}


def test_rows_that_share_an_id(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = [(1, a, 0), (1, b, 1), (1, a, 0), (2, b, 2), (3, None, 3), (4, " ", 4), (None, a, 5), (None, a, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash int")
    assert sorted(r["_hash"] for r in nc.drop_near_copies(docs).collect()) == [0, 1, 3, 5, 6]
    assert nc.drop_near_copies(docs.limit(0)).collect() == []


def test_bands_hold_pairs_at_the_coefficient():
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(500):
        x = rng.integers(0, 1 << 63, 180, np.uint64)
        met += any(p == q for p, q in zip(nc.bands(x[:162]), nc.bands(x[18:])))  # 144 of 180: 0.8
    assert met >= 495


def distance(a, b):
    return ((nc.fingerprint(a) ^ nc.fingerprint(b)) & (1 << 64) - 1).bit_count()


def near_and_unlike():
    """Eight unlike long texts, each with a copy (the next doc_id) that has one word changed."""
    rng = random.Random(11)
    long = [[f"w{rng.randrange(9000)}" for _ in range(900)] for _ in range(8)]
    texts = {}
    for k, words in enumerate(long):
        new = list(words)
        new[400] = "changed"
        texts[10 * k], texts[10 * k + 1] = " ".join(words), " ".join(new)
    return texts


def test_simhash_alone_finds_pairs_within_its_radius(spark, monkeypatch):
    """Without a MinHash band every pair within the radius is a candidate."""
    monkeypatch.setattr(nc, "bands", lambda own: [])
    texts = near_and_unlike()
    apart = [distance(texts[d], texts[d + 1]) for d in range(0, 80, 10)]
    near = {d + 1 for d, n in zip(range(0, 80, 10), apart) if n <= nc.RADIUS}
    assert len(near) >= 6
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in cp.without_near_copies(spark, docs, "").collect()} == set(texts) - near


def test_simhash_links_are_confirmed_on_the_sets(spark, monkeypatch):
    """Equal fingerprints do not make copies of unlike texts."""
    monkeypatch.setattr(nc, "fingerprint", lambda text: 5)
    texts = near_and_unlike()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in cp.without_near_copies(spark, docs, "").collect()} == {d for d in texts if d % 10 == 0}


def test_fingerprints_of_distinct_shingles():
    from tests.llm.test_simhash import plain_fingerprint

    for text in (None, "", "one", "a b c", "a b c d e f"):
        assert nc.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    line = "the same line again " * 50
    assert distance(line + a, line + b) > nc.RADIUS
