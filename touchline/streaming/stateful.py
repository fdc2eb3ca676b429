"""Streaming last touch (T1-T6) with ``transformWithStateInPandas``.

Per visitor ``(ip, user_agent)`` two ``ValueState``s hold the live touch and
the time of the last hit.  Inside a micro-batch the visitor's rows are sorted
by the processing order (arrival ``seq``, or hit time then ``seq``); across
micro-batches arrival order holds (T5).  Arrival is one number (``seq``) or a
struct of numbers (hit files: file, split, place), which stays apart as columns
``seq_<field>`` in the state operator's rows.  Expiry is the strict ``>`` gap test on
arrival, exactly as in batch (T2); state lives in the checkpointed state store
(T4), and with an idle limit an event-time timer frees it (see
:func:`stream_last_touch`).

The fold inside a batch reads the visitor's rows chunk by chunk into packed
arrays (``Hits``: 37 bytes a hit, touches as numbers), orders and scans those
with numpy and emits its rows chunk by chunk, so a visitor with millions of hits
in one micro-batch never stands as one frame of texts.
"""

from __future__ import annotations

from typing import Iterator, Optional, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..operators.normalize import normalize_hits, observe_hits, parse_hits
from ..options import AttributionOptions
from ..session import ship_package

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTPUT_SCHEMA = StructType(
    [
        StructField("ip", StringType()),
        StructField("user_agent", StringType()),
        StructField("seq", LongType()),
        StructField("hit_time", LongType()),
        StructField("is_purchase", BooleanType()),
        StructField("revenue", DecimalType(38, 10)),
        StructField("own_domain", StringType()),
        StructField("own_keyword", StringType()),
        StructField("live_domain", StringType()),
        StructField("live_keyword", StringType()),
        StructField("new_session", BooleanType()),
    ]
)

def arrival_columns(hits: DataFrame) -> list[str]:
    """The columns that hold the arrival key of ``hits`` in the flat rows."""
    kind = hits.schema["seq"].dataType
    return [f"seq_{name}" for name in kind.names] if isinstance(kind, StructType) else ["seq"]


def output_schema(arrival: Sequence[str]) -> StructType:
    """``OUTPUT_SCHEMA`` with the arrival key's columns in place of ``seq``."""
    out = StructType()
    for field in OUTPUT_SCHEMA:
        for name in arrival if field.name == "seq" else [field.name]:
            out = out.add(name, field.dataType)
    return out


TOUCH_STATE = StructType([StructField("domain", StringType()), StructField("keyword", StringType())])
TIME_STATE = StructType([StructField("t", LongType())])


#: output rows of a visitor that leave the fold at a time
EMIT_ROWS = 10_000


class Hits:
    """One visitor's hits of a micro-batch as packed arrays."""

    MONEY = pa.decimal128(38, 10)

    def __init__(self, arrival: Sequence[str] = ("seq",)) -> None:
        self.arrival = arrival
        self.touches: list[tuple[str, str]] = []
        self._code: dict[tuple[str, str], int] = {}
        self._parts: list[tuple] = []

    def code(self, touch: tuple[str, str]) -> int:
        """The number of a touch; the same touch has one number."""
        if touch not in self._code:
            self._code[touch] = len(self.touches)
            self.touches.append(touch)
        return self._code[touch]

    def add(self, pdf: pd.DataFrame) -> None:
        domain, keyword = pdf["own_domain"].to_numpy(dtype=object), pdf["own_keyword"].to_numpy(dtype=object)
        own = np.full(len(pdf), -1, np.int32)
        at = np.flatnonzero(pdf["own_domain"].notna().to_numpy())
        own[at] = [self.code(touch) for touch in zip(domain[at], keyword[at], strict=True)]
        self._parts.append(
            (
                pdf["hit_time"].to_numpy(dtype=np.int64),
                np.stack([pdf[name].to_numpy(dtype=np.int64) for name in self.arrival]),
                own,
                pdf["is_purchase"].fillna(False).to_numpy(dtype=bool),
                pa.Array.from_pandas(pdf["revenue"], type=self.MONEY),
            )
        )

    def in_order(self, by_time: bool) -> None:
        """Bring the hits into the processing order: time, seq, own, purchase, revenue."""
        parts, self._parts = self._parts, []
        time, seq, own, purchase = (np.concatenate([p[k] for p in parts], axis=-1) for k in range(4))
        revenue = pa.chunked_array([p[4] for p in parts], self.MONEY)
        at = np.lexsort((*seq[::-1], time) if by_time else seq[::-1])
        self.time, self.seq, self.own, self.purchase = time[at], seq[:, at], own[at], purchase[at]
        self.revenue = revenue.combine_chunks().take(pa.array(at))

    def scan(self, timeout: Optional[int], before: Optional[int], touch: Optional[tuple[str, str]]) -> None:
        """Sessions and the live touch of every hit (``new_session``, ``live``),
        going on from the time of the last hit and the touch before."""
        place = np.arange(len(self.time))
        # gaps in whole seconds: a float would lose them beyond 2**53
        gap = np.diff(self.time, prepend=self.time[0] if before is None else np.int64(before))
        self.new_session = np.zeros(len(place), bool) if timeout is None else gap > timeout
        last = np.maximum.accumulate(np.where(self.own >= 0, place, -1))
        begun = np.maximum.accumulate(np.where(self.new_session, place, -1))
        carried = -1 if touch is None else self.code(touch)
        self.live = np.where(last >= np.maximum(begun, 0), self.own[last], np.where(begun < 0, carried, -1))

    def rows(self, key, at: np.ndarray) -> pd.DataFrame:
        # -1, no touch, takes the last name
        domain, keyword = (np.array([*(t[k] for t in self.touches), None], object) for k in (0, 1))
        own, live = self.own[at], self.live[at]
        paid = self.revenue.take(pa.array(at))
        revenue = np.full(len(at), None, object)
        known = np.flatnonzero(paid.is_valid().to_numpy(zero_copy_only=False))
        revenue[known] = paid.take(pa.array(known)).to_pylist()
        return pd.DataFrame(
            {
                "ip": key[0],
                "user_agent": key[1],
                **{name: part[at] for name, part in zip(self.arrival, self.seq, strict=True)},
                "hit_time": self.time[at],
                "is_purchase": self.purchase[at],
                "revenue": revenue,
                "own_domain": domain[own],
                "own_keyword": keyword[own],
                "live_domain": domain[live],
                "live_keyword": keyword[live],
                "new_session": self.new_session[at],
            }
        )


class LastTouchProcessor(StatefulProcessor):
    """Session-scoped last touch per visitor; emits search hits and purchases."""

    def __init__(self, session_timeout: Optional[int], order: str, emit_all: bool = False, idle_limit: Optional[int] = None, arrival: Sequence[str] = ("seq",)):
        self.arrival = tuple(arrival)
        self.timeout = session_timeout
        self.by_time = order != "file"
        self.emit_all = emit_all
        self.idle_limit = idle_limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.touch = handle.getValueState("touch", TOUCH_STATE)
        self.last_time = handle.getValueState("last_time", TIME_STATE)

    def _expiry(self, last: Optional[int]) -> Optional[int]:
        """When a visitor last seen at ``last`` is forgotten (ms); a visitor whose
        last hit has no time never is."""
        return None if self.idle_limit is None or not last else (last + self.idle_limit) * 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hits, n = Hits(self.arrival), 0
        for pdf in rows:
            n += len(pdf)
            if len(pdf):
                hits.add(pdf)
        if not n:
            return
        hits.in_order(self.by_time)
        known, held = self.last_time.get(), self.touch.get()
        before, held = None if known is None else int(known[0]), None if held is None else tuple(held)
        hits.scan(self.timeout, before, held)
        last = int(hits.time[-1])
        self.last_time.update((last,))
        if hits.live[-1] >= 0:
            self.touch.update(hits.touches[hits.live[-1]])
        elif held is not None:
            self.touch.clear()
        old, new = self._expiry(before), self._expiry(last)
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)
        out = np.arange(n) if self.emit_all else np.flatnonzero((hits.own >= 0) | hits.purchase)
        for at in range(0, len(out), EMIT_ROWS):
            yield hits.rows(key, out[at : at + EMIT_ROWS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.touch.clear()
        self.last_time.clear()
        return iter(())

    def close(self) -> None:
        pass


def _flat(prepared: DataFrame) -> DataFrame:
    return prepared.select(
        "ip",
        "user_agent",
        *[F.col(name.replace("_", ".", 1)).cast("long").alias(name) for name in arrival_columns(prepared)],
        "hit_time",
        "is_purchase",
        F.col("revenue").cast("decimal(38,10)").alias("revenue"),
        F.col("touch.domain").alias("own_domain"),
        F.col("touch.keyword").alias("own_keyword"),
        F.when(~F.col("time_blank") & ~F.col("time_bad"), F.timestamp_seconds("hit_time")).alias("event_time"),
    )


def stream_last_touch(
    raw_stream: DataFrame,
    options: Optional[AttributionOptions] = None,
    metrics_name: str = "hits",
    emit_all: bool = False,
    idle_limit: Optional[int] = None,
    max_delay: int = 3600,
) -> DataFrame:
    """Streaming form of the attribution window.

    ``raw_stream`` is a streaming raw-hits frame whose ``seq`` is a number or a
    struct of numbers.  The
    output holds one row per search hit and per purchase (all rows with
    ``emit_all``) with the visitor's live touch.  Row-level counters are
    observed under ``metrics_name`` (``query.lastProgress['observedMetrics']``).

    With ``idle_limit`` (seconds, at least the session timeout) the state of a
    visitor goes when the watermark, the largest hit time less ``max_delay``
    seconds, has passed the visitor's last hit by that much.  The clock is the
    hits' own, so a stream that was down forgets nobody too early, and credits
    don't change: a later hit would have begun a new session anyway.  Hits older
    than the watermark are dropped and counted (``numRowsDroppedByWatermark``);
    hits without a time aren't, they find no touch once a visitor is forgotten.
    """
    options = options or AttributionOptions()
    if idle_limit is not None and (options.session_timeout is None or idle_limit < options.session_timeout):
        raise ValueError(f"an idle limit of {idle_limit} s needs a session timeout that is no longer")
    spark = raw_stream.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != STATE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    prepared = observe_hits(parse_hits(normalize_hits(raw_stream), options.engines), metrics_name, options.internal_suffixes)
    if options.session_timeout is None and options.prefilter and not emit_all:
        prepared = prepared.filter(F.col("touch").isNotNull() | F.col("is_purchase"))
    arrival = arrival_columns(prepared)
    hits = _flat(prepared)
    hits = hits.drop("event_time") if idle_limit is None else hits.withWatermark("event_time", f"{max_delay} seconds")
    return hits.groupBy("ip", "user_agent").transformWithStateInPandas(
        statefulProcessor=LastTouchProcessor(options.session_timeout, options.order, emit_all, idle_limit, arrival),
        outputStructType=output_schema(arrival),
        outputMode="Append",
        timeMode="None" if idle_limit is None else "EventTime",
    )


def as_attributed(stream_output: DataFrame) -> DataFrame:
    """Shape stream output like the batch window output (for the batch reports)."""
    touch = F.when(
        F.col("own_domain").isNotNull(),
        F.struct(F.col("own_domain").alias("domain"), F.col("own_keyword").alias("keyword")),
    )
    live = F.when(
        F.col("live_domain").isNotNull(),
        F.struct(F.col("live_domain").alias("domain"), F.col("live_keyword").alias("keyword")),
    )
    out = stream_output.withColumns({"touch": touch, "live_touch": live})
    arrival = [c for c in stream_output.columns if c.startswith("seq_")]
    if not arrival:
        return out
    return out.withColumn("seq", F.struct(*[F.col(c).alias(c.removeprefix("seq_")) for c in arrival])).drop(*arrival)
