"""The two stateful operators as plain Python: the streaming processors drive them, tests compare batches with them.

Attributes are dicts of name to JSON literal text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, MutableMapping
from dataclasses import dataclass, field, replace

NS = 1_000_000_000
#: A time after all others.
FAR = 1 << 62


@dataclass(frozen=True)
class Observation:
    element_id: str
    contributor_id: str
    observed_ns: int
    kind: str
    type: str
    source_id: str | None
    target_id: str | None
    attributes: tuple[tuple[str, str], ...]  # sorted

    @property
    def shape(self) -> tuple:
        return self.kind, self.type, self.source_id, self.target_id


class IdentityConflict(ValueError):
    """Contributors disagree on what an element is."""


@dataclass(frozen=True)
class Ttl:
    """Seconds to live by type."""

    default: int = 300
    overrides: tuple[tuple[str, int], ...] = ()

    def seconds(self, o: Observation) -> int:
        table = dict(self.overrides)
        if o.kind == "node":
            return table.get(o.type, self.default)
        ends = min(table.get(str(x).split(":")[0], self.default) for x in (o.source_id, o.target_id))
        return min(table.get(o.type, ends), ends)


# ------------------------------------------------------------------------------ refresh coalescing
@dataclass(frozen=True)
class Held:
    """What the coalescer keeps of one contributor of one element (times in ms)."""

    newest: Observation
    sent_at: int
    seen_at: int
    waiting: bool


@dataclass(frozen=True)
class Coalescer:
    interval_s: int
    ttl: Ttl

    def observe(self, held: Held | None, o: Observation, now: int) -> tuple[Held | None, Observation | None, str]:
        """New state, what to forward, and which counter moves."""
        if not self.interval_s:
            return None, o, "passed"
        if held is None:
            return Held(o, now, now, False), o, "new"
        if o.observed_ns < held.newest.observed_ns:
            return held, None, "out_of_order"
        if (o.shape, o.attributes) != (held.newest.shape, held.newest.attributes):
            return Held(o, now, now, False), o, "changed"
        if now >= held.sent_at + 1000 * self.interval_s:
            return Held(o, now, now, False), o, "unchanged"
        return Held(o, held.sent_at, now, True), None, "suppressed"

    def wake_at(self, held: Held) -> int:
        """When the next timer is due: a refresh if one waits, else silent cleanup."""
        if held.waiting:
            return held.sent_at + 1000 * self.interval_s
        return held.seen_at + 1000 * self.ttl.seconds(held.newest)

    def wake(self, held: Held, now: int) -> tuple[Held | None, Observation | None]:
        if held.waiting:
            return replace(held, sent_at=now, waiting=False), held.newest
        return (None if now >= self.wake_at(held) else held), None


# ------------------------------------------------------------------------------ element lifecycle
@dataclass(frozen=True)
class Snapshot:
    observation: Observation
    event_deadline_ns: int
    processing_deadline_ms: int


@dataclass
class Element:
    """State of one element: its contributors, the payload last published, and an index of attribute winners.

    The index (``shape``, ``owners``, ``values``) spares a refresh the other
    contributors: it reads owners of the attributes it carries and no one else.
    The two ``due`` times are lower bounds of the contributors' deadlines.
    """

    contributors: MutableMapping[str, Snapshot]
    published: str | None = None
    shape: tuple | None = None
    owners: dict[str, str] = field(default_factory=dict)
    values: dict[str, str] = field(default_factory=dict)
    event_due_ns: int = FAR
    processing_due_ms: int = FAR

    def __post_init__(self) -> None:
        if self.shape is None and self.contributors:
            self.reindex()

    def reindex(self) -> None:
        """The index from all contributors; needed only when an owner no longer has what it owned."""
        held = list(self.contributors.items())
        self.owners, self.values, self.shape = {}, {}, held[0][1].observation.shape if held else None
        for k, s in sorted(held, key=lambda x: _rank(x[1].observation)):
            for name, value in s.observation.attributes:
                if self.owners.setdefault(name, k) == k:
                    self.values[name] = value
        self.event_due_ns = min((s.event_deadline_ns for _, s in held), default=FAR)
        self.processing_due_ms = min((s.processing_deadline_ms for _, s in held), default=FAR)

    def put(self, known: Snapshot | None, s: Snapshot) -> bool:
        """Take in a contributor's newer snapshot in place of the one ``known``; whether the merged attributes may have changed."""
        o = s.observation
        self.contributors[o.contributor_id] = s
        self.shape = o.shape
        has = dict(o.attributes)
        if known and any(self.owners.get(name) == o.contributor_id and name not in has for name, _ in known.observation.attributes):
            self.reindex()
            return True
        changed = False
        for name, value in o.attributes:
            owner = self.owners.get(name)
            if owner in (None, o.contributor_id) or _rank(o) < _rank(self.contributors[owner].observation):
                changed |= self.values.get(name) != value
                self.owners[name], self.values[name] = o.contributor_id, value
        self.event_due_ns = min(self.event_due_ns, s.event_deadline_ns)
        self.processing_due_ms = min(self.processing_due_ms, s.processing_deadline_ms)
        return changed


def _rank(o: Observation) -> tuple:
    """The least wins an attribute: the newest observation, ties to the smallest contributor."""
    return -o.observed_ns, o.contributor_id


def merged(contributors: Mapping[str, Snapshot]) -> dict[str, str]:
    """Each attribute from the newest observation that has it, ties to the smallest contributor: what the index has to equal."""
    out: dict[str, str] = {}
    for s in sorted(contributors.values(), key=lambda s: _rank(s.observation)):
        for name, value in s.observation.attributes:
            out.setdefault(name, value)
    return dict(sorted(out.items()))


def _digest(parts: list[tuple[str, str]]) -> str:
    return hashlib.sha256(("{" + ",".join(f'"{k}":{v}' for k, v in parts) + "}").encode()).hexdigest()


def _js(text: str | None) -> str:
    return json.dumps(text, ensure_ascii=False)


def payload_hash(o: Observation, attributes: dict[str, str]) -> str:
    body = "{" + ",".join(f"{_js(k)}:{v}" for k, v in sorted(attributes.items())) + "}"
    parts = [("kind", _js(o.kind)), ("id", _js(o.element_id)), ("type", _js(o.type)), ("attributes", body)]
    if o.kind == "edge":
        parts += [("source_id", _js(o.source_id)), ("target_id", _js(o.target_id))]
    return _digest(parts)


def event_id(operation: str, element_id: str, observed_ns: int, hash_: str | None) -> str:
    return _digest([("operation", _js(operation)), ("element_id", _js(element_id)), ("observed_at_unix_nano", str(observed_ns)), ("payload_hash", _js(hash_))])


@dataclass(frozen=True)
class Event:
    operation: str
    element_id: str
    observed_ns: int
    payload_hash: str | None
    observation: Observation | None
    attributes: dict[str, str] | None

    @property
    def event_id(self) -> str:
        return event_id(self.operation, self.element_id, self.observed_ns, self.payload_hash)


@dataclass(frozen=True)
class Lifecycle:
    ttl: Ttl

    def observe(self, e: Element, o: Observation, watermark_ns: int, now_ms: int) -> Event | None:
        """Take in an observation; late ones live from the watermark on, older ones of a contributor are ignored."""
        known = e.contributors.get(o.contributor_id)
        if known and o.observed_ns < known.observation.observed_ns:
            return None
        if e.shape and e.shape != o.shape:
            raise IdentityConflict(o.element_id)
        seconds = self.ttl.seconds(o)
        changed = e.put(known, Snapshot(o, max(o.observed_ns, watermark_ns) + seconds * NS, now_ms + 1000 * seconds))
        if e.published and not changed:
            return None
        return self._publish(e, o.element_id, o.observed_ns)

    def expire(self, e: Element, watermark_ns: int, now_ms: int) -> Event | None:
        """Drop contributors that either clock has passed; an upsert if that changes the element, a delete if none is left."""
        if e.event_due_ns > watermark_ns and e.processing_due_ms > now_ms:
            return None
        gone = {k: s for k, s in e.contributors.items() if s.event_deadline_ns <= watermark_ns or s.processing_deadline_ms <= now_ms}
        for k in gone:
            del e.contributors[k]
        e.reindex()
        if not gone:
            return None
        at = max(s.event_deadline_ns for s in gone.values())
        element_id = next(iter(gone.values())).observation.element_id
        if e.shape:
            return self._publish(e, element_id, at)
        e.published = None
        return Event("delete", element_id, at, None, None, None)

    def _publish(self, e: Element, element_id: str, at: int) -> Event | None:
        kind, type_, source, target = e.shape
        o = Observation(element_id, "", at, kind, type_, source, target, ())
        hash_ = payload_hash(o, e.values)
        if hash_ == e.published:
            return None
        e.published = hash_
        return Event("upsert", element_id, at, hash_, o, dict(sorted(e.values.items())))

    def wake_at(self, e: Element, watermark_ns: int, now_ms: int) -> int:
        """Next whole second (ms) at which a contributor may expire on either clock; perhaps too early, never too late."""
        ahead = -(-(e.event_due_ns - watermark_ns) // 1_000_000)
        return -(-min(e.processing_due_ms, now_ms + max(1000, ahead)) // 1000) * 1000
