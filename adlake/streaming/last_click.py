"""Last-click attribution of a stream by keyed state: one final row for each order.

For each user and advertiser the state has the last click before the watermark, the clicks
after it, and the orders after it.  When the watermark has passed an order, no click before the order can come any more,
so the order gets its last click and leaves the state.  What is kept thus is one click a key and what the watermark's
delay holds, not the clicks of the whole look-back; a timer drops a key's last click when the look-back has passed.

Keys are dealt to a fixed number of parts.  Every call for state goes from the Python worker to the JVM and back, so a part's
rows travel together, column by column: the calls grow with parts and micro-batches, not with keys.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import islice
from operator import itemgetter
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ListState, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, StructField, StructType

from adlake.operators.attribution import _ORDER, _TOUCH, _finish, _micros, _there

#: Rows of one element of a list in the state.
_CHUNK = 10_000


def _columns(rows: Sequence[tuple]) -> list[tuple]:
    """Rows as elements of a list in the state, each with the columns of some rows."""
    return [tuple(list(c) for c in zip(*rows[k : k + _CHUNK])) for k in range(0, len(rows), _CHUNK)]


def _held(state: ListState) -> list[tuple]:
    return [row for columns in state.get() for row in zip(*columns)]


def _hold(state: ListState, rows: Sequence[tuple]) -> None:
    state.put(_columns(rows)) if rows else state.clear()


class LastClick(StatefulProcessor):
    """order, click: columns of the input rows that an order and a click are described by; they begin with the time in microseconds, the event_id, the user and the advertiser.

    Gives each order's columns and those of its last click, or nulls, by position.
    """

    def __init__(self, order: StructType, click: StructType, out: Sequence[str], lookback: int) -> None:
        self.order, self.click, self.out, self.lookback = order, click, out, lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        lists = lambda row: StructType([StructField(f.name, ArrayType(f.dataType)) for f in row])
        self.handle = handle
        self.last = handle.getListState("last", lists(self.click))
        self.clicks = handle.getListState("clicks", lists(self.click))
        self.orders = handle.getListState("orders", lists(self.order))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        earliest = []
        while some := list(islice(rows, _CHUNK)):
            at = some[0].__fields__.index
            kind, order, click = at("event_type"), itemgetter(*map(at, self.order.names)), itemgetter(*map(at, self.click.names))
            some = [tuple(r) for r in some]
            clicks, orders = [click(r) for r in some if r[kind] == "click"], [order(r) for r in some if r[kind] == "order"]
            if clicks:
                self.clicks.appendList(_columns(clicks))
            if orders:
                self.orders.appendList(_columns(orders))
            earliest.append(min(r[0] for r in [*clicks, *orders]))
        # the watermark has to pass the earliest of the new rows; a part has one timer
        at, timers = min(earliest), list(self.handle.listTimers())
        if not timers or self._after(at) < timers[0]:
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(self._after(at))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        known, out, no_click = defaultdict(list), Row(*self.out), (None,) * len(self.click)
        for c in sorted(_held(self.last) + _held(self.clicks), key=itemgetter(0, 1)):
            known[c[2:4]].append(c)
        waiting = []
        for o in _held(self.orders):
            if o[0] >= now:
                waiting.append(o)
                continue
            clicks = known.get(o[2:4], ())
            at = bisect_right(clicks, o[0], key=itemgetter(0)) - 1
            near = at >= 0 and clicks[at][0] >= o[0] - self.lookback
            yield out(*o, *(clicks[at] if near else no_click))
        last, later = [], []
        for clicks in known.values():
            at = bisect_right(clicks, now - 1, key=itemgetter(0))
            later += clicks[at:]
            if at and clicks[at - 1][0] >= now - self.lookback:
                last.append(clicks[at - 1])
        _hold(self.last, last)
        _hold(self.clicks, later)
        _hold(self.orders, waiting)
        wake = [r[0] for r in [*later, *waiting]] + [c[0] + self.lookback for c in last]
        if wake:
            self.handle.registerTimer(self._after(min(wake)))

    def _after(self, at: int) -> int:
        """The watermark, in milliseconds, that is later than *at*."""
        return at // 1000 + 2

    def close(self) -> None:
        pass


def final_touches(events: DataFrame, lookback: str = "30 days", watermark: str = "10 minutes", parts: int = 4096) -> DataFrame:
    """The rows of `last_touch` for a stream of events, each order once, when the watermark has passed it; events may come without names.

    Needs the RocksDB state store (`jobs.rocksdb`).  Events later than the watermark are dropped, as in windowed metrics.
    parts: users and advertisers are dealt to so many; it stays as it is as long as the checkpoint does.  A micro-batch reads
    and writes the state of the parts that it has rows for, and a task holds one part's at a time.
    """
    # Spark describes the state in a process of its own, which need not know this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = events.filter("event_type IN ('order', 'click')").withWatermark("event_ts", watermark).withColumn("_at", F.unix_micros("event_ts"))
    fields = {f.name: f.dataType for f in rows.schema}
    first = ("_at", "event_id", "user_id", "advertiser_id")
    ordered, touched = _there(_ORDER, events), _there(_TOUCH, events)
    order, click = ([*first, *(n for n in names if n not in (*first, "event_ts"))] for names in (ordered, touched))
    out = [*(f"_order_{n}" for n in order), *(f"_click_{n}" for n in click)]
    types = lambda names: [fields[n] for n in names]
    struct = lambda names, kinds: StructType([StructField(n, k) for n, k in zip(names, kinds)])
    known = F.col("user_id").isNotNull() & F.col("advertiser_id").isNotNull()
    # only what the state holds goes to the Python workers
    dealt = rows.filter(known).select("event_ts", "event_type", *dict.fromkeys([*order, *click]), F.pmod(F.xxhash64("user_id", "advertiser_id"), F.lit(parts)).cast("int").alias("_part"))
    processor = LastClick(struct(order, types(order)), struct(click, types(click)), out, _micros(lookback))
    found = dealt.groupBy("_part").transformWithState(processor, struct(out, types(order) + types(click)), "Append", "EventTime")
    # null keys match nothing, so their orders need no state
    alone = rows.filter((F.col("event_type") == "order") & ~known).select(*[F.col(n).alias(f"_order_{n}") for n in order], *[F.lit(None).cast(fields[n]).alias(f"_click_{n}") for n in click])
    both = found.union(alone)

    def given(side: str, names: dict[str, str]) -> list:
        return [(F.timestamp_micros(f"_{side}__at") if c == "event_ts" else F.col(f"_{side}_{c}")).alias(n) for c, n in names.items()]

    return _finish(both.select(given("order", ordered) + given("click", touched)))
