import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import rans, token_files
from tickloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 63, 64, 1000, 70_000, 300_001])
@pytest.mark.parametrize("kinds", [1, 3, 5000])
def test_block_round_trip(n, kinds):
    rng = np.random.default_rng(n + kinds)
    ids = (np.minimum(rng.geometric(0.01, n), kinds) * 7).astype(np.uint32)
    table = rans.Table.unpack(rans.Table.of(ids).pack())
    block = rans.encode(ids, table)
    assert np.array_equal(rans.decode(block, table), ids)
    lanes = rans.lanes_of(n)
    for k in range(1, len(block["checkpoints"])):
        assert np.array_equal(rans.decode(block, table, k), ids[k * rans.CHECKPOINT_STEPS * lanes :])


def test_size_is_near_the_entropy_and_damage_is_found():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.3, 200_000), 40_000).astype(np.uint32)
    table = rans.Table.of(ids)
    block = rans.encode(ids, table)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert len(block["words"]) * 8 / len(ids) < 1.02 * -(share * np.log2(share)).sum() + 0.1
    damaged = block | {"words": block["words"][:100] + bytes([block["words"][100] ^ 1]) + block["words"][101:]}
    with pytest.raises((ValueError, IndexError)):
        rans.decode(damaged, table)


def expected(rows):
    whole, at, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*(whole.encode(text, add_special_tokens=False).ids if text else []), 1], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op7_rans_token_files"](spark, sf_dir).collect()]
    assert sorted(got) == expected(rows)


def test_parts_segments_and_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", 300)
    rows = [(k * 3 - 100, ("some words of text " * (k % 40)) if k % 7 else None) for k in range(200)] + [(None, "null id"), (10_000, "x " * 3000)]
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, part string, ids int")
    token_files.write_ids(docs, PATH, str(tmp_path / "a"), per_part=30)
    assert spark.read.parquet(str(tmp_path / "a")).count() > 10
    got = token_files.read_documents(spark, str(tmp_path / "a"), with_ids=True).collect()
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == expected(rows)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    token_files.write_ids(docs.limit(0), PATH, str(tmp_path / "b"))
    assert token_files.read_documents(spark, str(tmp_path / "b")).collect() == []


def test_rows_that_repeat(spark, tmp_path):
    token_files.write_ids(spark.createDataFrame([(1, "b"), (1, "b"), (0, "a")], "doc_id long, text string"), PATH, str(tmp_path / "a"))
    got = token_files.read_documents(spark, str(tmp_path / "a")).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in got) == [(0, 0, 2), (2, 1, 2), (4, 1, 2)]


@pytest.mark.parametrize("top", [300, rans.DENSE_IDS + 5, (1 << 32) - 1])
def test_tables_count_and_find_ids_without_sorting(top, monkeypatch):
    """Small ids are counted and looked up by place, great ones sorted and searched, with equal tables."""
    rng = np.random.default_rng(top)
    ids = np.concatenate([rng.integers(0, 300, 5000), [top]]).astype("<u4")
    symbols, counts = np.unique(ids, return_counts=True)
    if top < rans.DENSE_IDS:
        monkeypatch.setattr(np, "unique", None)
        monkeypatch.setattr(np, "searchsorted", None)
    table = rans.Table.of(ids)
    assert table.symbols.tolist() == symbols.tolist() and int(table.freqs.sum()) == 1 << table.bits
    assert (table.freqs[np.argsort(counts)[-1]] >= table.freqs).all()
    assert table.symbols[table.places(ids)].tolist() == ids.tolist()
    assert rans.decode(rans.encode(ids, table), table).tolist() == ids.tolist()
