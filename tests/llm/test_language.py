import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import language
from tickloom.llm.queries import QUERIES
from tickloom.llm.sampling import sample_per_class


def plain_ranks(text, top):
    """n-grams of one to three characters of the padded words, counted one by one."""
    counts = {}
    padded = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    padded = " ".join(("x" + padded + "x").split(" ")).replace("x ", " ", 1)
    words = padded[:-1].split()
    line = " " + " ".join(words) + " "
    for size in (1, 2, 3):
        for k in range(len(line) - size + 1):
            g = line[k : k + size]
            if g.strip() and " " not in g[1:-1]:
                counts[g] = counts.get(g, 0) + 1
    return counts


@pytest.mark.parametrize("text", ["The cat, the hat.", "é è À 12 ab", "a", "ab  cd\nef", "日本語 テキスト"])
def test_counts(text):
    grams, counts = language.gram_counts(text)
    unpack = lambda g: "".join(chr(c) if c else " " for c in ([g] if g < 1 << 61 else [g >> 21 & (1 << 21) - 1, g & (1 << 21) - 1] if not g >> 62 else [g >> 42 & (1 << 20) - 1, g >> 21 & (1 << 21) - 1, g & (1 << 21) - 1]))
    assert {unpack(int(g)): int(n) for g, n in zip(grams, counts)} == plain_ranks(text, 10)


def test_distance_is_out_of_place():
    p = language.Profiles({"xx": [10, 11, 12], "yy": [12, 11, 10]}, top=3)
    assert p.languages == ["xx", "yy"]
    ranks = language.ranked("aab", 3)
    q = language.Profiles({"same": ranks.tolist(), "turned": ranks[::-1].tolist()}, top=3)
    assert q.identify("aab") == ("same", 1.0)
    assert q.identify(None) == q.identify("") == q.identify("12 !?") == ("und", 0.0)
    assert q.identify("zzz")[1] == 0.0


def test_held_out_accuracy(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op3_rank_order_language"](spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(langs) and len(got) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out]
    assert np.mean(held) > 0.93


def test_odd_rows(spark):
    rows = [(1, "the cat", "en", 1.0), (2, None, "en", 1.0), (None, "der hund", "de", 1.0), (3, "der hund", "de", 1.0), (4, "...", None, 1.0), (5, "le chat " * 4000, None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    profiles = language.learn(docs, F.col("doc_id").isNotNull())
    got = language.identify(docs, profiles).collect()
    assert [r.lang_pred for r in got[:5]] == ["en", "und", "de", "de", "und"] and got[5].lang_pred in ("en", "de")
    assert docs.columns == ["doc_id", "text", "lang", "score"] and got[0].score == 1.0
    none = language.learn(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), none).collect() == []


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "rare").otherwise("often").alias("lang"))
    a, b = (sorted(map(tuple, sample_per_class(r, "lang", "doc_id", 150).collect())) for r in (rows, rows.repartition(7)))
    assert a == b and sum(r[1] == "rare" for r in a) == 100 and 120 <= sum(r[1] == "often" for r in a) <= 150
    assert sample_per_class(rows.limit(0), "lang", "doc_id", 5).collect() == []
