"""Log lines with the characters that break them."""

import gzip

from tickloom.sources import logs


def json_line(message, level="INFO"):
    return (
        '{"timestamp": "2024-01-02 03:04:05.678", "level": "%s", "service": "loader", '
        '"version": "0.1.0", "environment": "production", "module": "mod", '
        '"function": "run", "line": 12, "message": "%s"}' % (level, message)
    )


def test_json_files(spark, tmp_path):
    lines = [json_line("plain"), json_line('has "quote"'), json_line("back\\slash"), json_line("two\nlines")]
    with gzip.open(tmp_path / "app.log.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    rows = logs.read_json_logs(spark, str(tmp_path)).collect()
    good = [r for r in rows if r["_corrupt"] is None]
    assert [r["message"] for r in good] == ["plain"]
    assert good[0]["component"] == "mod" and good[0]["extra"]["line"] == "12"
    assert str(good[0]["timestamp"]) == "2024-01-02 03:04:05.678000"
    # A line break makes two broken lines; nothing is lost.
    assert len(rows) == 5
    assert all(r["message"] is None for r in rows if r["_corrupt"] is not None)


def test_text_lines(spark):
    head = "2024-01-02 03:04:05.678 | WARNING  | loader | mod:run:12 | "
    colour = "\u001b[32m2024-01-02 03:04:05.678\u001b[0m | \u001b[1mINFO    \u001b[0m | s | m:f:1 | x"
    df = spark.createDataFrame(
        [(1, head + "a | b"), (2, head), (3, colour), (4, "no separators"), (5, "a | b | c | d | e")],
        "id int, line string",
    )
    rows = {r["id"]: r for r in logs.parse_text_logs(df, "line", "id").collect()}
    assert rows[1]["message"] == "a | b" and rows[1]["log_level"] == "WARNING"
    assert rows[2]["message"] == ""
    assert rows[3]["log_level"] == "INFO" and rows[3]["extra"]["function"] == "f"
    assert rows[4]["_corrupt"] == "no separators"
    assert rows[5]["_corrupt"] == "a | b | c | d | e" and rows[5]["extra"] is None


def test_long_line_without_location_is_quick(spark):
    df = spark.createDataFrame([("a | b | c | " + "x: | " * 20_000,)], "line string")
    assert logs.parse_text_logs(df, "line").first()["_corrupt"] is not None
