"""Stateful streaming: refresh coalescing and element lifecycle as ``transformWithState`` processors."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, MutableMapping

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import ids
from . import model
from .model import Coalescer, Element, Held, Lifecycle, Observation, Snapshot, Ttl

OBSERVATION = "element_id string, contributor_id string, observed_ns long, kind string, type string, source_id string, target_id string, attributes map<string, string>"
EVENT = "schema_version string, event_id string, event_type string, element_id string, observed_at_unix_nano long, emitted_at_unix_ms long, operation string, payload_hash string, kind string, type string, source_id string, target_id string, attributes map<string, string>"
_FIELDS = ("element_id", "contributor_id", "observed_ns", "kind", "type", "source_id", "target_id")


def _send_by_value() -> None:
    """Processors start in a Python process beside the driver too, which sent files don't reach: they carry their code."""
    for module in (model, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)


def observations(contributions: DataFrame) -> DataFrame:
    """Contributions with attributes as JSON literals, the processors' input."""
    return contributions.select(*_FIELDS, F.transform_values("attributes", lambda _, x: ids.literal(x)).alias("attributes"))


def _read(r: Row) -> Observation:
    return Observation(*(r[f] for f in _FIELDS), tuple(sorted(dict(r["attributes"] or ()).items())))


def _row(o: Observation) -> Row:
    return Row(**{f: getattr(o, f) for f in _FIELDS}, attributes=dict(o.attributes))


def _pack(o: Observation) -> str:
    return json.dumps([*(getattr(o, f) for f in _FIELDS), o.attributes])


def _unpack(text: str) -> Observation:
    *head, attributes = json.loads(text)
    return Observation(*head, tuple((k, v) for k, v in attributes))


class CoalesceProcessor(StatefulProcessor):
    """One timer per (element, contributor): a pending refresh, or silent cleanup."""

    def __init__(self, rules: Coalescer) -> None:
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("held", "newest string, sent_at long, seen_at long, waiting boolean")

    def _held(self) -> Held | None:
        if not self.state.exists():
            return None
        newest, *rest = self.state.get()
        return Held(_unpack(newest), *rest)

    def _keep(self, held: Held | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if held is None:
            self.state.clear()
        else:
            self.state.update((_pack(held.newest), held.sent_at, held.seen_at, held.waiting))
            self.handle.registerTimer(self.rules.wake_at(held))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        now, held, out = timerValues.getCurrentProcessingTimeInMs(), self._held(), []
        for r in rows:
            held, sent, _ = self.rules.observe(held, _read(r), now)
            if sent:
                out.append(_row(sent))
        if self.rules.interval_s:
            self._keep(held)
        return iter(out)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        held = self._held()
        if held is None:
            return iter(())
        held, sent = self.rules.wake(held, timerValues.getCurrentProcessingTimeInMs())
        self._keep(held)
        return iter([_row(sent)] if sent else ())


class _Contributors(MutableMapping):
    """Snapshots by contributor, read from a map state one by one and only when asked for."""

    def __init__(self, state: object) -> None:
        self.state, self.known = state, {}

    def __getitem__(self, k: str) -> Snapshot:
        if k not in self.known:
            if not self.state.containsKey((k,)):
                raise KeyError(k)
            newest, *due = self.state.getValue((k,))
            self.known[k] = Snapshot(_unpack(newest), *due)
        return self.known[k]

    def __setitem__(self, k: str, s: Snapshot) -> None:
        self.known[k] = s
        self.state.updateValue((k,), (_pack(s.observation), s.event_deadline_ns, s.processing_deadline_ms))

    def __delitem__(self, k: str) -> None:
        self.known.pop(k, None)
        self.state.removeKey((k,))

    def __iter__(self) -> Iterator[str]:
        return iter([k[0] for k in self.state.keys()])

    def __len__(self) -> int:
        return sum(1 for _ in self.state.keys())


class LifecycleProcessor(StatefulProcessor):
    """Contributors of an element in a map state, its index in a value state, one processing-time timer per element.

    Runs in ``ProcessingTime`` mode so that late rows are kept; event deadlines
    are compared with the watermark whenever the element is looked at.
    """

    def __init__(self, rules: Lifecycle) -> None:
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.contributors = handle.getMapState("contributors", "contributor string", "newest string, event_ns long, processing_ms long")
        self.index = handle.getValueState("index", "index string")

    def _load(self) -> Element:
        held = _Contributors(self.contributors)
        if not self.index.exists():
            return Element(held, shape=())
        published, shape, *rest = json.loads(self.index.get()[0])
        return Element(held, published, tuple(shape), *rest)

    def _save(self, e: Element, times: object) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not e.shape:
            self.index.clear()
            return
        self.index.update((json.dumps([e.published, e.shape, e.owners, e.values, e.event_due_ns, e.processing_due_ms]),))
        self.handle.registerTimer(self.rules.wake_at(e, self._watermark(times), times.getCurrentProcessingTimeInMs()))

    @staticmethod
    def _watermark(times: object) -> int:
        return max(0, times.getCurrentWatermarkInMs()) * 1_000_000

    @staticmethod
    def _event(x: object, now: int) -> Row:
        o = x.observation
        shape = (o.kind, o.type, o.source_id, o.target_id) if o else (None,) * 4
        return Row(
            schema_version="3.0", event_id=x.event_id, event_type="graph_element_state_changed", element_id=x.element_id, observed_at_unix_nano=x.observed_ns,
            emitted_at_unix_ms=now, operation=x.operation, payload_hash=x.payload_hash, kind=shape[0], type=shape[1], source_id=shape[2], target_id=shape[3], attributes=x.attributes,
        )

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        now, watermark = timerValues.getCurrentProcessingTimeInMs(), self._watermark(timerValues)
        e = self._load()
        found = [x for r in rows if (x := self.rules.observe(e, _read(r), watermark, now))]
        self._save(e, timerValues)
        return iter([self._event(x, now) for x in found])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        e = self._load()
        x = self.rules.expire(e, self._watermark(timerValues), now)
        self._save(e, timerValues)
        return iter([self._event(x, now)] if x else ())


def coalesce_stream(rows: DataFrame, interval_s: int, ttl: Ttl | None = None) -> DataFrame:
    """Observations of a stream, refreshes of unchanged ones limited to one per interval; 0 passes everything."""
    if not interval_s:
        return rows
    _send_by_value()
    processor = CoalesceProcessor(Coalescer(interval_s, ttl or Ttl()))
    return rows.groupBy("element_id", "contributor_id").transformWithState(processor, OBSERVATION, "Append", "ProcessingTime")


def lifecycle_stream(rows: DataFrame, ttl: Ttl | None = None, lateness: str = "60 seconds") -> DataFrame:
    """Graph events of a stream of observations (after coalescing: the watermark is declared here)."""
    _send_by_value()
    timed = rows.withColumn("observed_at", F.timestamp_micros(F.expr("observed_ns DIV 1000"))).withWatermark("observed_at", lateness)
    return timed.groupBy("element_id").transformWithState(LifecycleProcessor(Lifecycle(ttl or Ttl())), EVENT, "Append", "ProcessingTime")
