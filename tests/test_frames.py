"""Frames: what is written is read, in order; half a frame waits; a restart loses and repeats nothing."""

import random

import pytest

from tickloom.sources import frames


@pytest.fixture(scope="module")
def session(spark):
    frames.register(spark)
    return spark


def pack(*messages):
    return b"".join(len(m).to_bytes(4, "big") + m for m in messages)


def run(session, folder, out, checkpoint):
    stream = session.readStream.format("frames").load(folder)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted((r.file, r.at, bytes(r.value)) for r in session.read.schema(frames.SCHEMA).parquet(out).collect())


def test_round_trip(session, tmp_path):
    rng = random.Random(1)
    messages = [rng.randbytes(rng.choice([0, 1, 30, 5000])) for _ in range(400)] + [None]
    for part in (messages[:150], messages[150:]):
        df = session.createDataFrame([(k, m) for k, m in enumerate(part)], "n int, value binary").repartition(4)
        df.write.format("frames").mode("append").save(str(tmp_path / "f"))
    rows = session.read.format("frames").load(str(tmp_path / "f")).collect()
    assert sorted(bytes(r.value) for r in rows) == sorted(m for m in messages if m is not None)
    assert not list((tmp_path / "f").glob("*.draft")) and session.read.format("frames").load(str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="appended"):
        session.createDataFrame([(b"x",)], "value binary").write.format("frames").mode("overwrite").save(str(tmp_path / "f"))


def test_stream_goes_on_at_its_byte(session, tmp_path, monkeypatch):
    """The last file grows, also by half a frame; new files follow; each run reads what is new, once."""
    folder = tmp_path / "in"
    folder.mkdir()
    steps = [
        [("1", pack(b"a", b"bb") + pack(b"ccc")[:5])],
        [("1", pack(b"ccc")[5:])],
        [],
        [("1", pack(b"d")), ("2", pack(b"", b"e" * 100_000)), ("3", pack(b"f")[:2])],
        [("3", pack(b"f")[2:] + pack(b"g"))],
    ]
    want = [["a", "bb"], ["a", "bb", "ccc"], ["a", "bb", "ccc"], ["a", "bb", "ccc", "d", "", "e" * 100_000], ["a", "bb", "ccc", "d", "", "e" * 100_000, "f", "g"]]
    for step, now in zip(steps, want):
        for name, data in step:
            with open(folder / f"{name}.frames", "ab") as f:
                f.write(data)
        got = run(session, str(folder), str(tmp_path / "out"), str(tmp_path / "cp"))
        assert [v.decode() for _, _, v in got] == now


def test_batches_are_bounded(monkeypatch, tmp_path):
    monkeypatch.setattr(frames, "BATCH_BYTES", 1000)
    (tmp_path / "1.frames").write_bytes(pack(*[bytes([k]) * 300 for k in range(20)], b"x" * 5000))
    batches = list(frames._read(str(tmp_path), frames.Stretch("1.frames", 0, None)))
    assert sum(b.num_rows for b in batches) == 21 and max(b.num_rows for b in batches) == 4
