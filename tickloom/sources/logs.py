"""Log lines, as JSON or as text, in the shape of the processing_logs table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import CORRUPT

# Keys of a JSON log line, and the clock format of both line forms.
LINE_SCHEMA = (
    "timestamp string, level string, service string, version string, environment string, "
    "module string, function string, line bigint, message string"
)
CLOCK = "yyyy-MM-dd HH:mm:ss.SSS"

_ANSI = "\u001b\\[[0-9;]*m"


def _to_table_shape(fields: dict[str, Column], extras: list[str], corrupt: Column) -> list[Column]:
    """The lines do not print a component, so the module stands in for it."""
    entries = [x for name in extras for x in (F.lit(name), fields[name].cast("string"))]
    return [
        fields["level"].alias("log_level"),
        fields["module"].alias("component"),
        fields["message"].alias("message"),
        F.when(corrupt.isNull(), F.create_map(*entries)).alias("extra"),
        F.try_to_timestamp(fields["timestamp"], F.lit(CLOCK)).alias("timestamp"),
        corrupt.alias(CORRUPT),
    ]


def parse_json_logs(df: DataFrame, line: str, *keep: str) -> DataFrame:
    """Parse a column of JSON lines.

    Messages are written unescaped, so a quote or a line break in one makes the line
    invalid; such lines stay, whole, in `_corrupt`.
    """
    parsed = df.select(
        *keep,
        F.from_json(
            line,
            f"{LINE_SCHEMA}, {CORRUPT} string",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
        ).alias("_log"),
    )
    names = [part.split()[0] for part in LINE_SCHEMA.split(", ")]
    fields = {n: F.col(f"_log.{n}") for n in names}
    extras = ["service", "version", "environment", "function", "line"]
    return parsed.select(*keep, *_to_table_shape(fields, extras, F.col(f"_log.{CORRUPT}")))


def parse_text_logs(df: DataFrame, line: str, *keep: str) -> DataFrame:
    """Parse a column of text lines: five fields, the fourth being module:function:line.

    Colours are removed first. Only the first four separators count; the message may hold more.
    """
    clean = df.select(*keep, F.regexp_replace(line, _ANSI, "").alias("_line"))
    # Splitting with a limit is linear; one pattern with several open ends is not.
    parsed = clean.withColumn("_parts", F.split("_line", r" \| ", 5)).withColumn(
        "_place", F.split(F.get("_parts", F.lit(3)), ":")
    )
    fits = (
        (F.size("_parts") == 5) & (F.size("_place") == 3) & F.get("_place", F.lit(2)).rlike(r"^\d+$")
    )
    parsed = parsed.withColumn("_fits", F.coalesce(fits, F.lit(False)))

    def part(pieces: str, i: int) -> Column:
        return F.when(F.col("_fits"), F.get(pieces, F.lit(i)))

    fields = {
        "timestamp": part("_parts", 0),
        "level": F.trim(part("_parts", 1)),
        "service": part("_parts", 2),
        "module": part("_place", 0),
        "function": part("_place", 1),
        "line": part("_place", 2),
        "message": part("_parts", 4),
    }
    corrupt = F.when(~F.col("_fits"), F.col("_line"))
    return parsed.select(*keep, *_to_table_shape(fields, ["service", "function", "line"], corrupt))


def read_json_logs(spark: SparkSession, path: str) -> DataFrame:
    """JSON log files, plain or gzipped, one record per line."""
    return parse_json_logs(spark.read.text(path), "value")


def read_text_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_text_logs(spark.read.text(path), "value")


# Keys of a JSON line in their order, and the colours of a text line.
LINE_KEYS = ("timestamp", "level", "service", "version", "environment", "module", "function", "line", "message")


def format_json_line(**fields: Column) -> Column:
    """A JSON line from a Column for each of LINE_KEYS; messages are escaped, so any text reads back.

    `timestamp` is an instant, shown in the session's zone; missing fields are left out.
    """
    shown = {**fields, "timestamp": F.date_format(fields["timestamp"], CLOCK)}
    return F.to_json(F.struct(*[shown[k].alias(k) for k in LINE_KEYS if k in shown]))


def format_text_line(**fields: Column) -> Column:
    """A text line without colours; line breaks in a message are written as \\n, so a record stays one line."""
    one_line = F.replace(F.replace(fields["message"], F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n"))
    place = F.concat_ws(":", fields["module"], fields["function"], fields["line"].cast("string"))
    level = F.when(F.length(fields["level"]) < 8, F.rpad(fields["level"], 8, " ")).otherwise(fields["level"])
    return F.concat_ws(" | ", F.date_format(fields["timestamp"], CLOCK), level, fields["service"], place, one_line)
