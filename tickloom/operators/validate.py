"""Validation in one pass, duplicates, cleansing, quarantine and its summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import rules as R
from tickloom.operators.ordered import ROWS_PER_TASK, Profile, join_on, ordered
from tickloom.operators.normalize import TYPE_ERRORS
from tickloom.schemas import TABLES

REASONS = "reasons"
COPIES = "copies"
IS_VALID = "is_valid"


def table_rules(table: str) -> dict[str, Column]:
    """Rules over typed rows of a market table that need one row only."""
    spec = TABLES[table]
    text_keys = [c for c in spec.key if spec.type_of(c).simpleString() == "string"]
    text_keys = [c for c in text_keys if c != "option_type"]
    prices = [
        c
        for c in ("open", "high", "low", "close", "last", "prev_close")
        if c in spec.columns
    ]
    bounded = [c for c in ("open", "close", "last") if c in spec.columns]
    quantity = "total_traded_quantity" if table == "equity" else "volume"
    value = {"equity": "total_traded_value", "derivatives": "value", "indices": None}[table]
    found = {
        "required": R.blank(*text_keys) | R.missing("timestamp"),
        "range": R.out_of_range(*prices, *spec.unsigned, upper=spec.unsigned),
        "price_bounds": R.outside_bounds(*bounded),
    }
    if value:
        found["value"] = R.implausible_value(value, quantity)
    if table == "derivatives":
        found["leg"] = R.wrong_leg()
    return found


def feed_rules(table: str) -> dict[str, Column]:
    """Rules over records straight from a feed: `table_rules`, prices are there, all was readable."""
    found = table_rules(table)
    found["required"] = found["required"] | R.missing("open", "high", "low", "close")
    return {**found, "unreadable": F.size(TYPE_ERRORS) > 0}


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Name every rule a row fails in `reasons`, after those already there."""
    named = F.array_compact(F.array(*[F.when(fails, F.lit(n)) for n, fails in rules.items()]))
    if REASONS in df.columns:
        named = F.concat(F.col(REASONS), named)
    return df.withColumn(REASONS, named)


def check_derived(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    points: tuple[str, str, str] | None = ("close", "points_change", "percent_change"),
    interest: tuple[str, str] | None = None,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Flag rows whose stored change does not follow from the row before, in `derived_fails`.

    `points` names the price, its change and its change in percent (which may be None);
    `interest` names open interest and its change. The first row of a key has nothing to
    compare with and passes.
    """

    def compare(frame: DataFrame, w) -> DataFrame:
        checks = []
        if points:
            price, change, percent = points
            before = F.lag(price).over(w)
            checks.append(R.differs(F.col(change), F.col(price) - before))
            if percent:
                share = F.try_divide((F.col(price) - before) * 100, before)
                checks.append(R.differs(F.col(percent), share))
        if interest:
            held, change = interest
            checks.append(R.differs(F.col(change), F.col(held) - F.lag(held).over(w)))
        failed = checks[0]
        for check in checks[1:]:
            failed = failed | check
        return frame.withColumn("derived_fails", failed)

    return ordered(df, keys, order, rows_per_task).rows_back(1, compare).result()


def count_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add to each row how many rows share its key.

    Keys are counted with partial counts before the shuffle, and those that repeat are joined back, so a
    key of any size is small counts and nothing is counted before the query runs. While they are few,
    Spark broadcasts them and the rows stay where they are; else a hot key's rows may be split.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1)
    return join_on(df, repeated, keys, "left").withColumn(COPIES, F.coalesce(COPIES, F.lit(1)).cast("bigint"))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row, with the number of copies."""
    return count_copies(df, keys).filter(F.col(COPIES) > 1)


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: the newest, remaining columns breaking ties.

    An aggregate, so copies are reduced before the shuffle and a group of copies of any
    size costs its task one row per input partition.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    maps = [c for c in rest if isinstance(df.schema[c].dataType, T.MapType)]
    plain = [c for c in rest if c not in maps]
    # maps have no order of their own: their sorted entries stand for them
    entries = [F.sort_array(F.map_entries(c)).alias(f"_of_{c}") for c in maps]
    best = F.max(F.struct(*newest_by, *plain, *entries)).alias("_best")
    grouped = df.groupBy(*keys).agg(best)
    shown = {c: F.col(f"_best.{c}") for c in [*newest_by, *plain]}
    shown |= {c: F.map_from_entries(f"_best._of_{c}") for c in maps}
    return grouped.select(*[F.col(c) if c in keys else shown[c].alias(c) for c in df.columns])


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reasons)."""
    good = F.size(REASONS) == 0
    return df.filter(good).drop(REASONS), df.filter(~good)


def write_split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """`split_valid` of written rows: both sides come from one run of what lies before, and each reads its own folder."""
    df.withColumn(IS_VALID, F.size(REASONS) == 0).write.mode("overwrite").partitionBy(IS_VALID).parquet(path)
    kept = df.sparkSession.read.schema(T.StructType([*df.schema, T.StructField(IS_VALID, T.BooleanType())])).parquet(path)
    return kept.where(IS_VALID).drop(REASONS, IS_VALID), kept.where(~F.col(IS_VALID)).drop(IS_VALID)


def rule_summary(df: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """Rows that failed each rule, per batch."""
    failed = df.select(*batch, F.explode(REASONS).alias("rule"))
    return failed.groupBy(*batch, "rule").agg(F.count(F.lit(1)).alias("rows_failed"))


def batch_success(df: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Rows and success rate per batch: the input of batch metrics."""
    good = F.count_if(F.size(REASONS) == 0)
    rows = F.count(F.lit(1))
    return df.groupBy(*batch).agg(
        rows.alias("records_processed"), (good / rows).alias("success_rate")
    )


def observe_quality(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows and failures while the data passes to its sink, without another scan."""
    seen = Observation(name)
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(REASONS) > 0).alias("rows_failed"),
    )
    return watched, seen
