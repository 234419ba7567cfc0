import random
import re

import numpy as np
import pytest

from tickloom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window):
    out = []
    for t in texts:
        w, hit, own, longest = words(t), set(), set(), 0
        for item, text in items:
            v = words(text)
            size = min(window, len(v))
            for k in range(len(v) - size + 1) if v else ():
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == v[k : k + size]:
                        hit |= {*range(p, p + size)}
                        own.add(item)
                        n = size
                        while p + n < len(w) and k + n < len(v) and w[p + n] == v[k + n]:
                            n += 1
                        longest = max(longest, n)
        out.append((len(w), len(hit), sorted(own), longest))
    return out


def digest(found):
    return [(f["n_words"], sum(b - a for a, b in f["spans"]), f["items"], f["longest"][1] if f["longest"] else 0) for f in found]


@pytest.mark.parametrize("seed", range(25))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = [*"abcdefgh"][: rng.randint(1, 8)] + (["é", "Zz", "9"] if seed % 2 else [])
    some = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(0, n)))
    items = [(k, some(9)) for k in range(6)]
    texts = [some(40) for _ in range(20)] + [None, "", "xx " + items[0][1] + " yy", items[1][1] * 3]
    for window in (2, 4):
        found = dc.find_in_shard(texts, dc.Benchmark(items, window))
        assert digest(found) == brute(texts, items, window)


def test_suffixes_are_sorted():
    rng = np.random.default_rng(0)
    numbers = rng.integers(0, 4, 400)
    array = dc.SuffixArray(numbers, np.array([0, 150, 400]), 3)
    suffix = lambda k: tuple(array.words[k : k + list(array.words[k:]).index(0)])
    got = [suffix(k) for k in array.order]
    assert got == sorted(got) and all(len(s) >= 3 for s in got) and len(got) > 50


def test_runs_that_are_all_too_short():
    bench = dc.Benchmark([(1, "a b c d")], 4)
    assert digest(dc.find_in_shard(["a b c", "x a y", None], bench)) == [(3, 0, [], 0), (3, 0, [], 0), (0, 0, [], 0)]


def test_equal_hashes_of_other_words_do_not_match(monkeypatch):
    plain = dc.Words.__init__

    def coarse(self, texts):
        plain(self, texts)
        self.hash &= np.uint64(3)

    monkeypatch.setattr(dc.Words, "__init__", coarse)
    items = [(1, "a b c d")]
    bench = dc.Benchmark(items, 3)
    if len(bench.hashes) == 4:
        texts = ["e f g h i j k l m n o p q r s t", "x a b c d y"]
        assert digest(dc.find_in_shard(texts, bench))[0][1] == 0


def test_blocks_give_what_one_pass_gives(spark):
    items = [(k, f"item number {k} has these words and shares some words with all others") for k in range(6)]
    rows = [(k, f"Item NUMBER {k} has these words, and {'shares some words with all others' if k % 2 else 'no more'}", "own", 3) for k in range(12)]
    docs = spark.createDataFrame([*rows, (99, None, None, None)], "doc_id long, text string, spans string, items int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, dc.find_matches(docs, bench, 4).collect()))
    assert one == sorted(map(str, dc.find_matches(docs, bench, 4, block_bytes=1).collect()))
    texts = [r[1] for r in rows]
    want = {k: b for k, b in enumerate(brute(texts, items, 4))}
    for r in dc.find_matches(docs, bench, 4).collect():
        if r.doc_id < 99:
            assert (r.n_words, sum(s.end - s.begin for s in r.spans), r["items"], r.longest.n_words if r.longest else 0) == want[r.doc_id]
    kept = dc.remove_contaminated(docs, bench, 4)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, b in want.items() if not b[1]} | {99}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "...")], "item_id long, text string")
    for bench in (none, blank):
        assert [(r.n_words, r.spans, r["items"]) for r in dc.find_matches(docs, bench).collect()] == [(2, [], [])]
    assert dc.find_matches(docs.limit(0), none).collect() == []
