"""Figures that Spark keeps per key from batch to batch: newest rows, outages, running averages.

All of them are stateful processors: their values lie in Spark's own state store and are written with
its checkpoints, so a batch that is repeated after a failure finds what it found the first time. No
processor holds the rows of a key: they pass one by one, and what must wait for its turn in event
time waits in the store until a timer calls for it.

State of this kind needs the RocksDB store; `use_state_store` sets it for a session's streams.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.indicators import ema_alpha

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MS = 1000
HOUR = timedelta(hours=1)


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _delay(span: timedelta) -> str:
    return f"{_micros(span)} microseconds"


def use_state_store(session: SparkSession) -> None:
    """Let the streams of a session keep their state in RocksDB, as stateful processors must."""
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)


def _instants(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]


def _as_numbers(df: DataFrame) -> DataFrame:
    """Instants as microseconds: in Python they would depend on the zone of a worker."""
    return df.withColumns({c: F.unix_micros(c) for c in _instants(df)})


# Newest row per key -----------------------------------------------------------------------


class _Newest(StatefulProcessor):
    """Keeps the greatest row of a key by its first `width` fields, NULLs lowest."""

    def __init__(self, schema: T.StructType, width: int, ttl_ms: int | None):
        self.schema, self.width, self.ttl_ms = schema, width, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.schema, self.ttl_ms)

    def _place(self, row) -> tuple:
        return tuple((v is not None, v) if v is not None else (False, 0) for v in row[: self.width])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = self.newest.get() if self.newest.exists() else None
        place, changed = best and self._place(best), False
        for row in rows:
            own = row[-len(self.schema) :]
            if best is None or self._place(own) > place:
                best, place, changed = own, self._place(own), True
        if changed:
            self.newest.update(tuple(best))
            yield Row(*self.schema.names)(*best)

    def close(self) -> None:
        pass


SALT = "_salt"


def newest_rows(
    rows: DataFrame, keys: Sequence[str], timestamp: str, tiebreak: Sequence[str], salts: int = 8, ttl: timedelta | None = None
) -> DataFrame:
    """A stream of each key's newest rows as they change: write it in update mode, then `read_newest`.

    The newest row has the greatest time, then the greatest `tiebreak`; NULLs are lowest. A key's rows are
    dealt over `salts` states by their tiebreak, so a key with most of a stream is many tasks'
    work; its newest row is the best of these. Spark's own aggregate keeps them, and a batch's rows shrink
    to one of a state before the shuffle; a state that a batch's rows reach is told again, changed or not. With `ttl` a state that was not
    changed for so long is forgotten, which takes a processor; the stream then goes by processing time.
    """
    front = [timestamp, *tiebreak]
    numbers = _as_numbers(rows.select(*front, *[c for c in rows.columns if c not in front]))
    schema = numbers.schema
    salt = F.pmod(F.xxhash64(*front), F.lit(salts)).cast("int")
    dealt = numbers.select(*[F.col(k).alias(f"_key_{k}") for k in keys], salt.alias(SALT), *schema.names)
    grouped = dealt.groupBy(*[f"_key_{k}" for k in keys], SALT)
    if ttl is None:
        return grouped.agg(F.max_by(F.struct(*schema.names), F.struct(*front)).alias("_newest")).select("_newest.*")
    return grouped.transformWithState(_Newest(schema, len(front), _micros(ttl) // _MS), schema, "Update", "ProcessingTime")


def read_newest(spark: SparkSession, checkpoint: str, keys: Sequence[str], timestamp: str, tiebreak: Sequence[str], schema: T.StructType) -> DataFrame:
    """The newest row of every key, out of the store of a stream of `newest_rows` whose rows have this schema."""
    store, kept = spark.read.format("statestore").option("path", checkpoint), "value"
    if spark.read.format("state-metadata").load(checkpoint).first()["operatorName"].startswith("transformWithState"):
        stored = store.option("stateVarName", "newest").load()
    else:
        stored, kept = store.load(), "value.valueWithExtremumOrdering"
    kinds = {f.name: f.dataType for f in schema}
    back = [F.timestamp_micros(f"{kept}.{c}").alias(c) if isinstance(kinds[c], T.TimestampType) else F.col(f"{kept}.{c}").alias(c) for c in schema.names]
    rows = stored.select(*back)
    place = F.struct(timestamp, *tiebreak)
    rest = [c for c in schema.names if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("r")).select(*[c if c in keys else F.col(f"r.{c}").alias(c) for c in schema.names])


# Outages ----------------------------------------------------------------------------------

_SPAN = "begin bigint, until bigint"


def merge_span(spans: list[tuple[int, int]], begin: int, until: int) -> None:
    """Put a span into an ascending list of spans that do not touch."""
    at = bisect_left(spans, (begin, until))
    if at and spans[at - 1][1] >= begin:
        at -= 1
        begin, until = spans[at][0], max(until, spans[at][1])
        del spans[at]
    while at < len(spans) and spans[at][0] <= until:
        until = max(until, spans[at][1])
        del spans[at]
    spans.insert(at, (begin, until))


class _Watch(StatefulProcessor):
    """Spans in which a key was alive, until event time has passed them."""

    def __init__(self, limit_us: int, names: Sequence[str]):
        self.limit_us, self.told = limit_us, Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", _SPAN)
        self.down = handle.getValueState("down", "since bigint")

    def _since(self) -> int | None:
        down = self.down.get()
        return None if down is None else down[0]

    def _call_next(self, spans: list[tuple[int, int]], down: int | None) -> None:
        """Ask for a call at the first begin or end to tell of; that call asks for the next one.

        A span that began after a key went down tells its begin first. One timer at a time is what makes a
        batch cost a call for each key, not for each span.
        """
        begin, until = spans[0]
        self.handle.registerTimer(-(-(until if down is None else begin) // _MS))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spans = sorted((r[0], r[1]) for r in self.spans.get())
        known = list(spans)
        passed = timerValues.getCurrentWatermarkInMs() * _MS
        for row in rows:
            if row.at > passed:  # what happened until then is told
                merge_span(spans, row.at, row.at + self.limit_us)
        if spans != known:
            self.spans.put(spans)
            if spans[:1] != known[:1]:
                self._call_next(spans, self._since())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Tell of every begin and end that event time has passed; ends of passed spans are final."""
        now = timerValues.getCurrentWatermarkInMs() * _MS
        spans = sorted((r[0], r[1]) for r in self.spans.get())
        if not spans:
            return
        was = down = self._since()
        left, told = [], []
        for begin, until in spans:
            if down is not None and begin <= now:
                told.append(self.told(*key, "up", begin))
                down = None
            if until <= now:
                told.append(self.told(*key, "down", until))
                down = until
            else:
                left.append((begin, until))
        if told:
            if down != was:
                self.down.clear() if down is None else self.down.update((down,))
            if len(left) < len(spans):
                self.spans.put(left) if left else self.spans.clear()
        if left:
            self._call_next(left, down)
        yield from told

    def close(self) -> None:
        pass


def outages(heartbeats: DataFrame, key: str, timestamp: str, limit: timedelta, lateness: timedelta = HOUR) -> DataFrame:
    """A stream of what happens to each key: `event` is 'down' or 'up', `moment` when.

    A key is down from `limit` after a heartbeat that no other follows until then, and up at the next. Each
    is told once event time has passed it, so heartbeats may come in any order within `lateness`;
    those later are left out. The first heartbeat of a key is no 'up'. What a key holds is the
    spans of time that are not over, whatever the number of its heartbeats. Rows without a time or a key are
    not looked at.
    """
    kind = heartbeats.schema[key].dataType.simpleString()
    timed = heartbeats.where(F.col(key).isNotNull() & F.col(timestamp).isNotNull()).withWatermark(timestamp, _delay(lateness))
    rows = timed.select(F.col(key), F.col(timestamp), F.unix_micros(timestamp).alias("at"))
    told = rows.groupBy(key).transformWithState(_Watch(_micros(limit), [key, "event", "moment"]), f"{key} {kind}, event string, moment bigint", "Append", "EventTime")
    return told.withColumn("moment", F.timestamp_micros("moment"))


# Rows in order of event time --------------------------------------------------------------


class _InTurn(StatefulProcessor):
    """Rows wait by bucket of event time; a bucket that is over is told of in order.

    A row is a tuple that begins with its time in microseconds. `row_type` is its type, and
    `kept_type` that of what a key keeps from bucket to bucket.
    """

    def __init__(self, row_type: T.StructType, kept_type: T.StructType, bucket_us: int, at_once: int, names: Sequence[str]):
        self.row_type, self.kept_type = row_type, kept_type
        self.bucket_us, self.at_once, self.told = bucket_us, at_once, Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        rows = T.StructType([T.StructField("rows", T.ArrayType(self.row_type))])
        self.waiting = handle.getMapState("waiting", "bucket bigint, part bigint", rows)
        self.parts = handle.getMapState("parts", "bucket bigint", "n bigint")
        self.kept = handle.getValueState("kept", self.kept_type)

    def in_order(self, key, rows: list[tuple], kept: tuple | None) -> tuple[list[Row], tuple | None]:
        """What to tell of a bucket's rows, and what to keep after them."""
        raise NotImplementedError

    def without_time(self, key, row: tuple) -> Iterator[Row]:
        return iter(())

    def _put(self, held: dict[int, list]) -> None:
        for bucket, rows in held.items():
            n = self.parts.getValue((bucket,))[0] if self.parts.containsKey((bucket,)) else 0
            self.waiting.updateValue((bucket, n), (rows,))
            self.parts.updateValue((bucket,), (n + 1,))
            self.handle.registerTimer((bucket + 1) * self.bucket_us // _MS)
        held.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, count = {}, 0
        passed = timerValues.getCurrentWatermarkInMs() * _MS
        for row in rows:
            own = tuple(row[-len(self.row_type) :])
            if own[0] is None:
                yield from self.without_time(key, own)
                continue
            bucket = own[0] // self.bucket_us
            if (bucket + 1) * self.bucket_us <= passed:
                continue  # it is told of
            held.setdefault(bucket, []).append(own)
            count += 1
            if count % self.at_once == 0:
                self._put(held)
        self._put(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        bucket = expiredTimerInfo.getExpiryTimeInMs() * _MS // self.bucket_us - 1
        if not self.parts.containsKey((bucket,)):
            return
        n, rows = self.parts.getValue((bucket,))[0], []
        for part in range(n):
            rows += [tuple(r) for r in self.waiting.getValue((bucket, part))[0]]
            self.waiting.removeKey((bucket, part))
        self.parts.removeKey((bucket,))
        kept = tuple(self.kept.get()) if self.kept.exists() else None
        told, kept = self.in_order(key, rows, kept)
        if kept is not None:
            self.kept.update(kept)
        yield from told

    def close(self) -> None:
        pass


def _nulls_first(values: Sequence) -> tuple:
    return tuple((v is not None, v) if v is not None else (False, 0) for v in values)


class _RunningMean(_InTurn):
    """Rows are (time, id, x); keeps the mean."""

    def __init__(self, alpha: float, *how):
        super().__init__(*how)
        self.alpha = alpha

    def in_order(self, key, rows, kept):
        mean, told = kept[0] if kept else None, []
        for at, i, x in sorted(rows, key=lambda r: r[:2]):
            if x is not None:
                mean = x if mean is None else mean + self.alpha * (x - mean)
            told.append(self.told(*key, at, i, mean))
        return told, None if mean is None else (mean,)


def stream_ema(
    ticks: DataFrame,
    n: int = 12,
    key: str = "symbol",
    timestamp: str = "ts",
    trade_id: str = "trade_id",
    price: str = "price",
    lateness: timedelta = HOUR,
    bucket: timedelta = HOUR,
    at_once: int = 10_000,
) -> DataFrame:
    """EMA per key over all batches, in order of time and id, told once event time has passed a bucket.

    Rows may come in any order within `lateness`; later ones are left out (`sinks.running_ema` marks
    them). They wait in the state store; what is in memory is one bucket of one key, or `at_once`
    rows on their way to the store. A key is one task's work here; `sinks.running_ema` splits it.
    NULL prices change nothing. Rows without a key, time or id are not looked at.
    """
    kind = ticks.schema[key].dataType.simpleString()
    whole = ticks.where(F.col(key).isNotNull() & F.col(timestamp).isNotNull() & F.col(trade_id).isNotNull()).withWatermark(timestamp, _delay(lateness))
    x: Column = F.col(price).cast("double")
    rows = whole.select(key, timestamp, F.unix_micros(timestamp).alias("at"), F.col(trade_id).cast("bigint").alias("id"), x.alias("x"))
    types = T.StructType.fromDDL("at bigint, id bigint, x double"), T.StructType.fromDDL("mean double")
    processor = _RunningMean(ema_alpha(n), *types, _micros(bucket), at_once, [key, timestamp, trade_id, "ema"])
    output = f"{key} {kind}, {timestamp} bigint, {trade_id} bigint, ema double"
    told = rows.groupBy(key).transformWithState(processor, output, "Append", "EventTime")
    return told.withColumn(timestamp, F.timestamp_micros(timestamp))


class _WithPrevious(_InTurn):
    """Rows as they came, with values of the row before and the number of rows like them at their time."""

    def __init__(self, order: list[int], previous: list[int], copies: list[int], *how):
        super().__init__(*how)
        self.order, self.previous, self.copies = order, previous, copies

    def in_order(self, key, rows, kept):
        like = lambda r: (r[0], *[r[k] for k in self.copies])
        counts = Counter(map(like, rows))
        told = []
        for row in sorted(rows, key=lambda r: (r[0], *_nulls_first([r[k] for k in self.order]))):
            told.append(self.told(*row, *(kept or [None] * len(self.previous)), counts[like(row)]))
            kept = tuple(row[k] for k in self.previous)
        return told, kept

    def without_time(self, key, row):
        yield self.told(*row, *[None] * len(self.previous), 1)


COPIES = "copies"


def with_previous(
    rows: DataFrame,
    key: str,
    timestamp: str,
    order: Sequence[str],
    previous: dict[str, str],
    copies_by: Sequence[str] = (),
    lateness: timedelta = HOUR,
    bucket: timedelta = HOUR,
    at_once: int = 10_000,
) -> DataFrame:
    """A stream's rows in order of event time, each with what rules need that compare rows, over all batches.

    `previous` names columns to add and where they come from in the key's row before, by time and
    `order`; `copies` is the number of the key's rows of the same time and `copies_by`, the row itself
    included. A row is told once event time has passed its bucket: no copy of it within `lateness`
    can come after that, and later rows are left out. Rows without a time have nothing before them and are
    told at once. A key is one task's work; its rows wait in the store, not in memory.
    """
    at = "_at"
    numbers = _as_numbers(rows.withColumn(at, F.col(timestamp)))
    names = [at, *rows.columns]
    schema = T.StructType([numbers.schema[c] for c in names])
    kept = T.StructType([T.StructField(n, schema[c].dataType) for n, c in previous.items()])
    output = T.StructType([*schema, *kept, T.StructField(COPIES, T.LongType())])
    place = {c: k for k, c in enumerate(names)}
    processor = _WithPrevious([place[c] for c in order], [place[c] for c in previous.values()], [place[c] for c in copies_by], schema, kept, _micros(bucket), at_once, output.names)
    timed = rows.withWatermark(timestamp, _delay(lateness)).withColumns({"_key": F.col(key), "_time": F.col(timestamp), at: F.col(timestamp)})
    instants = set(_instants(rows)) | {at}
    sent = timed.select("_key", "_time", *[F.unix_micros(c).alias(c) if c in instants else F.col(c) for c in names])
    told = sent.groupBy("_key").transformWithState(processor, output, "Append", "EventTime")
    back = instants | {n for n, c in previous.items() if c in instants}
    return told.select(*[F.timestamp_micros(c).alias(c) if c in back else F.col(c) for c in output.names if c != at])
