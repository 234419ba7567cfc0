"""Stages against brute force, each on what the one before it kept."""

import re

import corpus_pipeline as cp
from tests.llm.test_decontaminate import brute
from tests.llm.test_near_copies import least_of_group
from tests.llm.test_packing import check

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_lines(texts, at_least=3):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\r\x0b\x0c"))
    holders = {}
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(d)
    lost = {k: max(d) for k, d in holders.items() if len(d) >= at_least}
    return {d: t and "\n".join(x for x in t.split("\n") if lost.get(key(x), d) == d) for d, t in texts.items()}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", None, 0), (-2, "123 456 --", "en", "s", 10), (-3, "", None, "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(cp.STAGES)
    assert list(stages) == ["language", "line_dedup", "near_dedup", "decontamination", "packing"]

    kept = cp.keep(stages["language"](spark, docs, sf_dir), "t")
    assert kept.columns == COLUMNS
    texts = {d: t for d, t in texts.items() if d >= 0}  # all others are in a language
    assert {r.doc_id: r.text for r in kept.collect()} == texts

    kept = cp.keep(stages["line_dedup"](spark, kept, sf_dir), "t")
    assert kept.columns == COLUMNS and kept.schema == docs.schema
    texts = plain_lines(texts)
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()} == {d: (t, len(t)) for d, t in texts.items()}

    kept = cp.keep(stages["near_dedup"](spark, kept, sf_dir), "t")
    assert kept.columns == COLUMNS
    least = least_of_group(texts)
    texts = {d: t for d, t in texts.items() if least[d] == d}
    assert {r.doc_id: r.text for r in kept.collect()} == texts

    kept = cp.keep(stages["decontamination"](spark, kept, sf_dir), "t")
    assert kept.columns == COLUMNS
    ids = list(texts)
    hit = brute([texts[d] for d in ids], bench, 10)
    texts = {d: texts[d] for d, h in zip(ids, hit) if not h[1]}
    assert {r.doc_id: r.text for r in kept.collect()} == texts and len(texts) < len(ids)

    check(stages["packing"](spark, kept, sf_dir).collect(), texts)


def test_odd_tables(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_pred int, score string, _whole int, spans int, n_lines int"
    rows = [(1, "The cat sat on the mat.", "en", "s", 23, 1, "a", 1, 1, 1), (1, "The cat sat on the mat.", "en", "s", 23, 1, "a", 1, 1, 1), (None, "the dog and the cat", None, None, None, None, None, None, None, None), (2, None, "en", "s", 0, 1, "a", 1, 1, 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES[:-1]:
            names = docs.columns
            docs = cp.keep(stage(spark, docs, sf_dir), name)
            assert docs.columns == names
            assert {(r.lang_pred, r.score, r["_whole"], r.spans, r.n_lines) for r in docs.collect()} <= {(1, "a", 1, 1, 1), (None,) * 5}
        assert sorted(((r.doc_id or 0), r.text) for r in docs.collect()) == ([(0, "the dog and the cat"), (1, "The cat sat on the mat.")] if data else [])
        assert cp.STAGES[-1][1](spark, docs, sf_dir).count() == (2 if data else 0)


def test_run(spark, sf_dir):
    assert cp.run(spark, sf_dir).count() > 100
