"""Velocity count of the stream in Spark's own keyed state.

``transformWithState`` keeps, per (group of accounts, piece of an hour of event
time), the accounts and times of the events in a list of the RocksDB state store;
an event-time timer removes them ``retention_seconds`` after the watermark has
passed the hour. Spark checkpoints the store with the query, so a restart goes on
where the last committed batch ended and a replayed batch finds the state before
it. What a batch reads and writes are the lists of the groups and pieces it has
events for, not the history.

Each key of the state costs its batch some round trips between Spark and the
Python worker, whatever it holds, so accounts share a fixed number of ``groups``
and a list is read once for all of its accounts: the round trips follow groups
and time, not the events. A list holds a piece of some minutes and not the
hour, because a batch reads it whole. Its elements are compressed: documents
repeat their field names, and the store and the checkpoint keep every element
in several files until the batches that may be restored no longer need them.

A hot account is cut into its pieces. The window of an event reaches at most one
piece back, so an event within a window's length of its piece's end is also
entered, as a bare time, under the piece after it.

Modes
-----
``arrival``     counts on event time, at once: an event sees the events in the
                window before it that arrived earlier (at one instant the
                earlier batches come first, then its own batch in event order).
``clock``       counts on arrival time (a column; by default the batch's time).
``event_time``  holds the events of an hour (a bucket) until the watermark passes its end;
                out-of-order input then gets the batch counts.

No mode drops an event: the watermark column is not handed to the operator, so
Spark's late-row filter does not apply. A late event is counted at once against
the times still kept; once its hour's times have been removed the count may be
too low, and ``janela_completa`` is false. An event without a time has a count
of 1.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sentinela.functions.timefn import epoch_micros
from sentinela.streaming.events import event_json, parse_events

MODES = ("arrival", "clock", "event_time")
US = 1_000_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A bucket is cut into pieces of about this length, or of the window if that is longer.
PIECE_SECONDS = 300
#: Events in one element of a list at most; a batch adds an element to a list, not one for each event.
ELEMENT_EVENTS = 10_000
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Groups among which events without a time are spread.
TIMELESS_GROUPS = 64
TIMELESS = "sem data"
#: The event that ends a finite stream: it moves the watermark past all others and is not counted.
END_ID = "__fim__"


@dataclass(frozen=True)
class Velocity:
    """Options of the count. ``window_seconds`` is at most ``bucket_seconds``; ``groups`` stays as it is for a checkpoint."""

    key: str = "id_conta"
    window_seconds: int = 60
    mode: str = "arrival"
    delay_seconds: int = 120
    retention_seconds: int = 3600
    bucket_seconds: int = 3600
    order_col: str = "evento_id"
    ts_col: str = "event_ts"
    clock: Column | None = None
    groups: int = 16

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if not 0 < self.window_seconds <= self.bucket_seconds:
            raise ValueError("the window must be positive and no longer than a bucket")
        if self.groups < 1:
            raise ValueError("at least one group of accounts")

    def pieces(self) -> int:
        """Pieces of a bucket: equal, in whole milliseconds and no shorter than the window."""
        k = max(1, self.bucket_seconds // max(self.window_seconds, PIECE_SECONDS))
        while self.bucket_seconds * 1000 % k:
            k -= 1
        return k


def counts_of(batch: list[tuple], before: dict[str, list[int]], window_us: int) -> Iterator[tuple[str, int]]:
    """(document, count) of events ``batch`` (account, time, order, document), sorted here, after each account's sorted times ``before``.

    A row without a document is a bare time of the piece before; it stands first at its time.
    """
    batch.sort(key=lambda r: (r[0], r[1], r[3] is not None, r[2] or ""))
    for account, rows in groupby(batch, key=lambda r: r[0]):
        mine, seen = list(rows), before.get(account, [])
        own = [r[1] for r in mine]
        for place, (_, us, _, doc) in enumerate(mine):
            if doc is not None:
                low = us - window_us
                yield doc, (bisect_right(seen, us) - bisect_right(seen, low) + place + 1 - bisect_right(own, low))


def elements(rows: list[tuple]) -> list[tuple]:
    """Rows as the elements of a list state: a tuple of columns for each ``ELEMENT_EVENTS`` rows."""
    return [tuple([*c] for c in zip(*rows[i:i + ELEMENT_EVENTS])) for i in range(0, len(rows), ELEMENT_EVENTS)]


def packed(rows: list[tuple]) -> list[tuple[bytes, int]]:
    """Rows as the compressed elements of a list state: bytes and their length before."""
    texts = [json.dumps(e, ensure_ascii=False).encode() for e in elements(rows)]
    return [(pa.compress(t, codec="zstd", asbytes=True), len(t)) for t in texts]


def unpacked(element: tuple[bytes, int]) -> Iterator[tuple]:
    """The rows of an element of :func:`packed`."""
    return zip(*json.loads(pa.decompress(bytes(element[0]), element[1], codec="zstd", asbytes=True)))


def processor(window_us: int, piece_ms: int, pieces: int, retention_ms: int, waits: bool) -> StatefulProcessor:
    """The keyed operator; a class of its own call, so that it travels to the workers by value."""
    out = Row("doc", "janela_n", "janela_completa")

    class VelocityProcessor(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            # Elements of (chave, us) and of (chave, us, ordem, doc), packed.
            self.times = handle.getListState("tempos", "linhas binary, tamanho int")
            self.waiting = handle.getListState("espera", "linhas binary, tamanho int")

        def bucket_end(self, key) -> int:
            return (key[1] // pieces + 1) * pieces * piece_ms

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            # Rows by place: conta, balde, chave, us, ordem, doc.
            if key[0] == TIMELESS:
                for r in rows:
                    if r[5] is not None:
                        yield out(r[5], 1, True)
                return
            batch = [tuple(r[2:]) for r in rows]
            watermark, end = timerValues.getCurrentWatermarkInMs(), self.bucket_end(key)
            if waits and watermark < end:
                if not self.waiting.exists():
                    self.handle.registerTimer(end)
                self.waiting.appendList(packed(batch))
                return
            yield from self.counted(batch, end, watermark < end + retention_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            end = self.bucket_end(key)
            if self.waiting.exists():
                batch = [r for element in self.waiting.get() for r in unpacked(element)]
                self.waiting.clear()
                yield from self.counted(batch, end, True)
            else:
                self.times.clear()

        def counted(self, batch: list[tuple], end: int, complete: bool) -> Iterator[Row]:
            before, kept = {r[0]: [] for r in batch}, False
            for element in self.times.get():
                kept = True
                for account, us in unpacked(element):
                    if account in before:
                        before[account].append(us)
            if not kept:
                self.handle.registerTimer(end + retention_ms + 1)
            for seen in before.values():
                seen.sort()
            for doc, n in counts_of(batch, before, window_us):
                yield out(doc, n, complete)
            self.times.appendList(packed([r[:2] for r in batch]))

        def close(self) -> None:
            pass

    return VelocityProcessor()


def count_stream(events: DataFrame, options: Velocity) -> DataFrame:
    """Every event of the stream once, with ``janela_n`` and ``janela_completa``; END_ID events go."""
    spark = events.sparkSession
    spark.conf.set(PROVIDER, ROCKSDB)
    pieces = options.pieces()
    window_us, piece_us = options.window_seconds * US, options.bucket_seconds * US // pieces
    us = epoch_micros(options.ts_col)
    if options.mode == "clock":
        us = F.unix_micros((options.clock if options.clock is not None else F.current_timestamp()).cast("timestamp"))
    ends = F.col("evento_id").eqNullSafe(END_ID)
    seen = events.select("*", us.alias("_us"), ends.alias("_fim"))
    seen = (seen.withColumn("_relogio", F.timestamp_micros("_us"))
            .withWatermark("_relogio", f"{options.delay_seconds} seconds"))
    ordem = F.coalesce(F.col(options.order_col).cast("string"), F.lit(""))
    bucket = F.floor(F.col("_us") / piece_us)
    own = F.struct(bucket.alias("balde"), ordem.alias("ordem"), event_json(seen).alias("doc"))
    later = F.struct((bucket + 1).alias("balde"), F.lit(None).cast("string").alias("ordem"), F.lit(None).cast("string").alias("doc"))
    timeless = F.struct(F.pmod(F.xxhash64(ordem), F.lit(TIMELESS_GROUPS)).alias("balde"), ordem.alias("ordem"), event_json(seen).alias("doc"))
    reaches = F.pmod(F.col("_us"), F.lit(piece_us)) >= piece_us - window_us
    # The end goes through the operator without a document: a filter would be moved below the watermark.
    end = F.struct(F.lit(0).cast("long").alias("balde"), F.lit("").alias("ordem"), F.lit(None).cast("string").alias("doc"))
    entered = F.when(F.col("_fim"), F.array(end)).when(F.col("_us").isNull(), F.array(timeless)).when(reaches, F.array(own, later)).otherwise(F.array(own))
    # Events without an account form one account.
    key = F.col(options.key)
    chave = F.coalesce(key.cast("string"), F.lit(""))
    # The name of the group: integer accounts are dealt by their remainder, others by their digest.
    number = key if isinstance(events.schema[options.key].dataType, INTEGERS) else F.xxhash64(chave)
    group = F.concat(F.lit("c"), F.coalesce(F.pmod(number.cast("long"), F.lit(options.groups)).cast("string"), F.lit("")))
    conta = F.when(F.col("_fim") | F.col("_us").isNull(), TIMELESS).otherwise(group)
    # The watermark's column stays behind here.
    rows = (seen.select(conta.alias("conta"), chave.alias("chave"), F.coalesce("_us", F.lit(0)).alias("us"), F.explode(entered).alias("e"))
            .select("conta", F.col("e.balde").alias("balde"), "chave", "us", F.col("e.ordem").alias("ordem"), F.col("e.doc").alias("doc")))
    done = rows.groupBy("conta", "balde").transformWithState(
        processor(window_us, piece_us // 1000, pieces, options.retention_seconds * 1000, options.mode == "event_time"),
        "doc string, janela_n bigint, janela_completa boolean", "Append", "EventTime")
    return parse_events(done, "doc", ("janela_n", "janela_completa"))
