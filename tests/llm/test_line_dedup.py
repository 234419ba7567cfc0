import time

import numpy as np
import pytest

from tickloom.llm import line_dedup as ld

A, B, C = "the first of the long lines", "another line of good length", "ä" * 20


def run(spark, rows, schema="doc_id long, text string"):
    return {r.doc_id: r for r in ld.dedup_lines(spark.createDataFrame(rows, schema)).collect()}


def test_three_documents_keep_a_line_in_the_last(spark):
    got = run(spark, [(1, f"{A}\nx\n {A.upper()}\t"), (2, A), (3, f"y\n{A}\n{A}"), (4, B), (5, B), (6, C), (7, f"{C}\n\n"), (8, C + "\n" + "short")])
    assert [got[k].text for k in range(1, 9)] == ["x", "", f"y\n{A}\n{A}", B, B, "", "\n", f"{C}\nshort"]
    assert [(got[k].n_lines, got[k].n_dropped) for k in (1, 2, 3, 7)] == [(3, 2), (1, 1), (3, 0), (3, 1)]


def test_empty_null_and_clashing_columns(spark):
    got = run(spark, [(1, None, "q", 5), (2, "", "q", 5), (None, A, "q", 5), (3, A, "q", 5), (4, f"\n{A}", "q", 5)], "doc_id long, text string, n_lines string, _lines int")
    assert got[1].text is None and got[2].text == "" and got[1].n_lines == got[2].n_lines == 1
    assert got[None].text == "" and got[3].text == "" and got[4].text == f"\n{A}"
    assert got[1]["_lines"] == 5 and got[1].n_dropped == 0
    assert run(spark, []) == {}


def test_rows_of_one_document_count_once(spark):
    got = ld.dedup_lines(spark.createDataFrame([(1, A), (1, A), (2, A), (3, B), (3, B), (4, B), (5, B)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, A), (1, A), (2, A), (3, ""), (3, ""), (4, ""), (5, B)]


def test_documents_that_lose_many_lines(spark):
    """16,000 lines each: looked up, not searched for."""
    long = "\n".join(f"line number {k} of the long ones" for k in range(16_000))
    start = time.perf_counter()
    got = run(spark, [(1, long), (2, long + "\nown"), (3, long)])
    assert (got[1].text, got[2].text, got[3].text) == ("", "own", long) and got[2].n_dropped == 16_000
    assert time.perf_counter() - start < 30  # a search in a list takes minutes with the rest


def test_a_line_in_a_third_of_all_documents(spark):
    rows = [(k, f"{A}\nown line number {k} of this one" if k % 3 == 0 else f"line of its own, number {k}") for k in range(900)]
    got = run(spark, rows)
    assert all((A in got[k].text) == (k == 897) for k in range(0, 900, 3))
    assert sum(r.n_dropped for r in got.values()) == 299


def test_small_filter_gives_the_same(spark, monkeypatch):
    rows = [(k, f"line that is shared by group {k % 50}\nline of number {k} and long enough") for k in range(400)]
    whole = run(spark, rows)
    monkeypatch.setattr(ld, "filter_size", lambda n: 64)
    assert {k: r.text for k, r in run(spark, rows).items()} == {k: r.text for k, r in whole.items()}


def test_merged_filters_know_what_two_tasks_saw():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 1 << 63, 500, np.uint64) for _ in range(2))
    shared = rng.integers(0, 1 << 63, 100, np.uint64)
    pairs = []
    for own in (a, b):
        once = ld.Bloom(1 << 16)
        once.add(np.concatenate([own, shared]))
        pairs.append((once.bits, ld.Bloom(1 << 16).bits))
    twice = ld.Bloom(1 << 16, ld.merge(*pairs)[1].tobytes())
    assert twice.has(shared).all()
    assert twice.has(np.concatenate([a, b])).mean() < 0.05


@pytest.mark.parametrize("n, bits", [(0, 1 << 16), (1 << 10, 1 << 16), (1 << 20, 1 << 26), (1 << 40, 1 << 30)])
def test_filter_size_is_bounded(n, bits):
    assert ld.filter_size(n) == bits
