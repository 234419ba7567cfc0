import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tickloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_cut_leaves_all_but_the_first_full():
    assert packing.cut(1, 8) == [(0, 1)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_packer_is_best_fit_and_bounded():
    rng = random.Random(1)
    packer, open_now = packing.Packer(64, 5), {}
    used: dict[int, int] = {}
    for _ in range(5000):
        n = rng.randint(1, 64)
        space = {b: 64 - u for b, u in open_now.items()}
        best = min((s for s in space.values() if s >= n), default=None)
        number, offset = packer.place(n)
        assert offset == used.get(number, 0)
        if best is None:
            assert number not in used
        else:
            assert 64 - offset == best
        used[number] = offset + n
        open_now[number] = offset + n
        if used[number] == 64:
            del open_now[number]
        if len(open_now) > 5:
            fullest = max(open_now.values())
            gone = [b for b, u in open_now.items() if u == fullest]
            # of equally full ones the packer closes the last to reach that level
            del open_now[number if number in gone else _last(packer, gone, 64 - fullest)]
        assert packer.n_open == len(open_now) <= 5
    assert sum(used.values()) / (64 * len(used)) > 0.8


def _last(packer, gone, space):
    left = set(packer.bins[space])
    return next(b for b in gone if b not in left)


def check(rows, texts):
    whole = Tokenizer.from_file(PATH)
    ids = {d: np.array([*(whole.encode(t, add_special_tokens=False).ids if t else []), 0], "<u4") for d, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for d, rs in by_doc.items():
        rs.sort(key=lambda r: r.piece)
        assert [r.piece for r in rs] == list(range(len(rs)))
        at = 0
        for r in rs:
            assert r.start == at and 1 <= r.length <= 2048 and (r.piece == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(ids[d][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[d]) and len(rs) == -(-at // 2048)
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:k]) for k in range(len(rs))]
        assert sum(r.length for r in rs) <= 2048
    total = sum(map(len, ids.values()))
    assert len(by_seq) <= 1.05 * total / 2048 + 2


def test_query_is_whole_and_gapless(spark, sf_dir):
    from tickloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(QUERIES["op4_best_fit_packing"](spark, sf_dir).collect(), texts)


def test_odd_rows(spark):
    schema = "doc_id long, text string, length string, ids binary, sequence_id string"
    long = "word " * 9000
    rows = [(1, None, "x", None, None), (2, "", "x", None, None), (3, long, "x", None, None), (4, "a b", None, None, None)]
    got = packing.pack(spark.createDataFrame(rows, schema), PATH).collect()
    check(got, {1: None, 2: "", 3: long, 4: "a b"})
    assert packing.pack(spark.createDataFrame([], schema), PATH).collect() == []
    twice = packing.pack(spark.createDataFrame([(None, "a"), (7, "b"), (7, "b")], "doc_id long, text string"), PATH).collect()
    assert [r.doc_id for r in sorted(twice, key=lambda r: r.offset)] == [None, 7, 7]
    assert sorted(r.offset for r in twice) == [0, 2, 4]


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(k, "some words " * k) for k in range(40)], "doc_id long, text string")
    packed = packing.pack(docs, PATH, capacity=64, with_ids=True).cache()
    made = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert made[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32
