import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import fingerprints as fp
from tickloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def windows(text):
    x = bytes(30) + text + bytes(max(0, 2 - len(text)))
    return [x[k : k + 32] for k in range(len(x) - 31)] if text else []


def plain_bin(window):
    s = sum(round(4096 * c * math.log2(c)) for c in Counter(window).values() if c > 1)
    return round(1000 * (1 - s / (4096 * 160)))


def plain_ranks(texts):
    n = Counter(plain_bin(w) for t in texts for w in windows(t))
    order = sorted(range(1001), key=lambda b: (n[b], -b))
    return {b: k for k, b in enumerate(order)}


def plain_digest(text, ranks):
    own = windows(text)
    rank = [ranks[plain_bin(w)] for w in own]
    votes = Counter()
    for k in range(len(own)):
        run = range(k, min(k + 16, len(own)))
        votes[min(run, key=lambda j: (rank[j], j))] += 1
    chosen = [w for k, w in enumerate(own) if len(own) <= 64 or votes[k] >= 4]
    filters = []
    for start in range(0, len(chosen), 128):
        bits = 0
        for w in chosen[start : start + 128]:
            h = 0
            for k in range(4):
                h = (h ^ int.from_bytes(w[8 * k : 8 * k + 8], "little")) * int(fp._ODD[k]) % 2**64
                h ^= h >> 29
            h = h * int(fp._ODD[0]) % 2**64
            h ^= h >> 32
            for k in range(5):
                bits |= 1 << (h >> 11 * k & 2047)
        filters.append(bits)
    return len(chosen), filters


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a[0] or not b[0]:
        return 0.0
    key = lambda d: (d[0], b"".join(f.to_bytes(256, "little") for f in d[1]))
    a, b = sorted((a, b), key=key)
    total = 0
    for k, f in enumerate(a[1]):
        weight, best = min(128, a[0] - 128 * k), 0.0
        for g in b[1]:
            n, m, e = f.bit_count(), g.bit_count(), (f & g).bit_count()
            chance = n * m / 2048
            if e > chance + 3 * math.sqrt(chance * (1 - m / 2048)):
                best = max(best, (e - chance) / (min(n, m) - chance))
        total += weight * best
    return min(1.0, total / a[0])


def plain(d):
    return d.features, [int.from_bytes(f.tobytes(), "little") for f in d.filters]


def some_texts(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 8)))
    texts = ["", "a", "ab", "\0", "\0\0\0", "é\U0001f600" * 40, "aaaa" * 500, "The The " * 100, " ".join(word() for _ in range(3000))]
    texts += [" ".join(word() for _ in range(n)) for n in (1, 2, 5, 9, 12, 16, 20, 40, 80, 150)]
    return [t.encode() for t in texts]


def test_against_plain_loops(monkeypatch):
    texts = some_texts()
    ranks = plain_ranks(texts)
    want = [plain_digest(t, ranks) for t in texts]
    for size in (1 << 18, 300):  # long texts in stretches too
        monkeypatch.setattr(fp, "BUFFER", size)
        counts = fp.count_bins(texts)
        learned = fp.ranks_of(counts)
        assert learned.tolist() == [ranks[b] for b in range(1001)]
        got = fp.digests(texts, learned)
        assert [plain(d) for d in got] == want
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert fp.likeness(got[a], got[b]) == pytest.approx(plain_likeness(want[a], want[b]), abs=1e-12)
    assert all(plain(fp.Digest.parse(str(d))) == plain(d) for d in got)


def check(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    ranks = plain_ranks([(t or "").encode() for _, t in rows])
    got = sorted(map(tuple, fp.compare_edits(df, **more).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2:]))
    assert len(got) == len(rows)
    by_id = {d: t or "" for d, t in rows}
    if len(by_id) < len(rows):
        return got
    order = sorted(by_id, key=lambda d: (d is not None, d or 0))
    digest = {d: plain_digest(t.encode(), ranks) for d, t in by_id.items()}
    for (d, n, sha, own, after, near_edited, near_next), k in zip(got, range(len(order))):
        text, then = by_id[order[k]], by_id[order[(k + 1) % len(order)]]
        changed = text[: len(text) - len(text) // 4] + then[: len(text) // 4]
        assert (d, n, sha) == (order[k], len(text), hashlib.sha256(changed.encode()).hexdigest())
        other = plain_digest(changed.encode(), ranks)
        assert plain(fp.Digest.parse(own)) == digest[order[k]] and plain(fp.Digest.parse(after)) == other
        assert near_edited == pytest.approx(plain_likeness(digest[order[k]], other), abs=1e-12)
        assert near_next == pytest.approx(plain_likeness(digest[order[k]], digest[order[(k + 1) % len(order)]]), abs=1e-12)
    return got


@pytest.mark.parametrize("part_bytes", [1 << 25, 700])
def test_order_and_ranges(spark, part_bytes):
    """One range, and more ranges than some have rows for; ids null, negative, far apart."""
    ids = [None, -5, 0, 3, 4, 9, 10**12, *range(100, 112)]
    texts = [t.decode() for t in some_texts(2)]
    rows = [*zip(ids, texts)]
    random.Random(4).shuffle(rows)
    check(spark, rows, part_bytes=part_bytes)


def test_odd_tables(spark):
    assert check(spark, []) == []
    assert check(spark, [(7, "Alone it stands and is followed by itself.")])[0][6] == 1.0
    assert [r[5:] for r in check(spark, [(1, None), (2, "")])] == [(1.0, 1.0)] * 2
    same = check(spark, [(k % 3, "The same text for all of them, many times.") for k in range(60)], part_bytes=64)
    assert len({r[3] for r in same}) == 1 and {r[6] for r in same} == {1.0}
    wide = spark.createDataFrame([(1, "One text.", 2, "x"), (2, "Two texts.", 3, "y")], SCHEMA + ", hash int, fingerprint string")
    assert fp.compare_edits(wide).count() == 2


def test_the_table(spark, sf_dir):
    """Edited texts are near, others are not; equal texts have equal fingerprints and only they all bits alike."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    text = {r.doc_id: r.text or "" for r in docs}
    got = QUERIES["op11_improbable_features"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(text) and all(r.n_chars == len(text[r.doc_id]) for r in got)
    order = sorted(text)
    then = dict(zip(order, order[1:] + order[:1]))
    near, unlike = np.array([r.near_edited for r in got]), [r.near_next for r in got if text[r.doc_id] != text[then[r.doc_id]]]
    assert near.min() > 0.3 and np.quantile(near, 0.05) > 0.6
    assert np.quantile(unlike, 0.95) < 0.1
    seen = {}
    for r in got:
        assert seen.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        features, filters = r.fingerprint.split(":")
        assert len(base64.b64decode(filters)) == 256 * -(-int(features) // 128)
