"""Element lifecycle over batches: latest observation per contributor, attribute winners, expiry, events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from ..functions import ids

NS = 1_000_000_000
_BODY = ("kind", "type", "source_id", "target_id", "attributes")
_KEY = ("element_id", "contributor_id")
_VALUE = "struct<t: string, v: string>"


def _by_arrival() -> WindowSpec:
    return W.partitionBy(*_KEY).orderBy("point_id")


def not_stale(contributions: DataFrame) -> DataFrame:
    """Observations that are not older than what the same contributor of the element had sent before, in order of arrival (``point_id``)."""
    newest = F.max("observed_ns").over(_by_arrival().rowsBetween(W.unboundedPreceding, -1))
    return contributions.withColumn("_newest", newest).where("_newest IS NULL OR observed_ns >= _newest").drop("_newest")


def coalesce_changes(contributions: DataFrame) -> DataFrame:
    """The observations an unlimited refresh interval lets pass: in order of arrival, the first of an
    (element, contributor) and each whose attributes changed; stale ones are ignored."""
    live = not_stale(contributions)
    text = ids.attributes_json(F.col("attributes"))
    before = F.lag("_text").over(_by_arrival())
    return live.withColumn("_text", text).withColumn("_before", before).where("_before IS NULL OR _before <> _text").drop("_text", "_before")


def latest(contributions: DataFrame) -> DataFrame:
    """The newest observation of each contributor of each element; of equally new ones the last to arrive."""
    body = F.struct("observed_ns", "point_id", *_BODY)
    return contributions.groupBy(*_KEY).agg(F.max_by(body, F.struct("observed_ns", "point_id")).alias("b")).select(*_KEY, "b.*")


def check_identity(contributions: DataFrame) -> DataFrame:
    """Elements of which contributors disagree on kind, type or endpoints."""
    shape = F.to_json(F.struct("kind", "type", "source_id", "target_id"))
    found = contributions.groupBy("element_id").agg(F.min(shape).alias("a"), F.max(shape).alias("b"))
    return found.where("a <> b").select("element_id")


def _gathered(snapshots: DataFrame, within: tuple[str, ...], sums: dict[str, Callable], newest: tuple[str, ...]) -> DataFrame:
    """One row per element: ``sums`` over its snapshots, and ``values`` with what ``newest`` is of each attribute's winner.

    A snapshot is read once: it becomes a row without a name and one per attribute.  ``newest`` columns never fall while
    ``observed_ns`` rises, so that a winner's are the greatest.  Where snapshots lie partitioned by ``within``, those of
    an element are put together there before the one shuffle.
    """
    head = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast(_VALUE).alias("value"))
    named = F.transform(F.map_entries("attributes"), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
    shape = ("kind", "type", "source_id", "target_id")
    rows = snapshots.select(*within, "element_id", *shape, "contributor_id", *{**sums, **dict.fromkeys(newest)}, F.inline(F.concat(F.array(head), named)))
    winner = F.struct("value", F.when(F.col("name").isNotNull(), F.col("contributor_id")).alias("contributor_id"), F.col("observed_ns"))
    rows = rows.select(*within, "element_id", "name", *shape, winner.alias("w"), *{**sums, **dict.fromkeys(newest)})
    first = [F.first(c).alias(c) for c in shape]
    best = F.min_by("w", F.struct(-F.col("w.observed_ns"), F.col("w.contributor_id"))).alias("w")
    both = [f(c).alias(c) for c, f in {**dict.fromkeys(newest, F.max), **sums}.items()]
    if within:
        rows = rows.groupBy(*within, "element_id", "name").agg(*first, best, *both).repartition("element_id")
    rows = rows.groupBy("element_id", "name").agg(*first, best, *both)
    value = F.struct("name", F.col("w.value").alias("value"), *newest)
    heads = [F.max(F.when(F.col("name").isNull(), F.col(c))).alias(c) for c in sums]
    return rows.groupBy("element_id").agg(*first, *heads, F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), value))).alias("values"))


def _map(values: Column) -> Column:
    return F.map_from_entries(F.transform(values, lambda v: F.struct(v["name"], v["value"])))


def merge_attributes(snapshots: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """One row per element: each attribute from the newest observation that has it, ties to the smallest contributor."""
    rows = _gathered(snapshots.withColumn("contributors", F.lit(1).cast("long")), within, {"contributors": F.sum, "observed_ns": F.max}, ())
    return rows.withColumn("attributes", _map(F.col("values"))).drop("values")


def states(dated: DataFrame, as_of_ns: int, within: tuple[str, ...] = ()) -> DataFrame:
    """One row per element: what ``merge_attributes`` says of all contributors and ``expire_as_of`` of those live at a time.

    ``contributors`` and ``attributes`` are of all, ``left`` and ``live_attributes`` of live ones; ``expired_ns`` is the
    latest expiry, null if none expired.  An element's ``deadlines`` never fall while observations get newer, so an
    attribute's winner is the winner among live ones too, or none of them has it; ``observed_ns`` is that of live ones if
    any is left.
    """
    live = F.col("deadline_ns") > as_of_ns
    marked = dated.withColumns({"contributors": F.lit(1).cast("long"), "left": live.cast("long"), "expired_ns": F.when(~live, F.col("deadline_ns"))})
    sums = {"contributors": F.sum, "left": F.sum, "observed_ns": F.max, "expired_ns": F.max}
    rows = _gathered(marked, within, sums, ("deadline_ns",))
    stays = F.filter("values", lambda v: v["deadline_ns"] > as_of_ns)
    return rows.withColumns({"attributes": _map(F.col("values")), "live_attributes": _map(stays)}).drop("values")


def events(found: DataFrame) -> DataFrame:
    """Events of elements' ``states``, in order of ``seq``: upserts of all (1), upserts of those that are left (2), deletes of the others (3)."""
    null = F.lit(None).cast("string")
    shape = ("kind", "type", "source_id", "target_id")

    def upsert(seq: int, attributes: str) -> Column:
        hash_ = ids.payload_hash(*(F.col(c) for c in ("kind", "element_id", "type", attributes, "source_id", "target_id")))
        return F.struct(F.lit(seq).alias("seq"), F.col("observed_ns"), F.lit("upsert").alias("operation"), hash_.alias("payload_hash"), *shape, F.col(attributes).alias("attributes"))

    gone = [F.lit(3).alias("seq"), F.col("expired_ns").alias("observed_ns"), F.lit("delete").alias("operation"), null.alias("payload_hash")]
    gone += [null.alias(c) for c in shape] + [F.lit(None).cast(ids.ATTRIBUTES).alias("attributes")]
    then = F.when(F.col("left") > 0, upsert(2, "live_attributes")).otherwise(F.struct(*gone))
    rows = found.select("element_id", F.explode(F.array(upsert(1, "attributes"), then)).alias("e")).select("element_id", "e.*")
    return _event(rows, "seq")


def winners(snapshots: DataFrame) -> DataFrame:
    """Owner and value of each attribute of each element."""
    values = snapshots.select("element_id", "contributor_id", "observed_ns", F.explode("attributes").alias("name", "value"))
    won = values.groupBy("element_id", "name").agg(F.min_by(F.struct("value", "contributor_id"), F.struct(-F.col("observed_ns"), F.col("contributor_id"))).alias("w"))
    return won.select("element_id", "name", ids.literal(F.col("w.value")).alias("value"), F.col("w.contributor_id").alias("owner"))


def ttl_seconds(default: int, overrides: dict[str, int]) -> Column:
    """A node's type's time to live; an edge's is never longer than its endpoints'."""
    of = F.lit(default)
    if overrides:
        table = F.create_map(*[x for k, v in overrides.items() for x in (F.lit(k), F.lit(v))])
        of = lambda t: F.coalesce(F.try_element_at(table, t), F.lit(default))
    else:
        of = lambda t: F.lit(default)
    ends = F.least(of(ids.type_of_id(F.col("source_id"))), of(ids.type_of_id(F.col("target_id"))))
    own = F.try_element_at(table, F.col("type")) if overrides else F.lit(None).cast("int")
    return F.when(F.col("kind") == "node", of(F.col("type"))).otherwise(F.least(F.coalesce(own, ends), ends))


def deadlines(snapshots: DataFrame, watermark_ns: int, default: int, overrides: dict[str, int] | None = None) -> DataFrame:
    """``deadline_ns``: the later of observation and watermark, plus the time to live."""
    ttl = ttl_seconds(default, overrides or {}).cast("long")
    return snapshots.withColumn("deadline_ns", F.greatest("observed_ns", F.lit(watermark_ns)) + ttl * NS)


def expire_as_of(dated: DataFrame, as_of_ns: int) -> tuple[DataFrame, DataFrame]:
    """Live contributors at a time, and the elements that lost some: their latest expiry, how many stay."""
    live = F.col("deadline_ns") > as_of_ns
    lost = dated.groupBy("element_id").agg(F.max(F.when(~live, F.col("deadline_ns"))).alias("expired_ns"), F.count_if(live).alias("left"))
    return dated.where(live), lost.where("expired_ns IS NOT NULL")


def element_hash() -> Column:
    return ids.payload_hash(*(F.col(c) for c in ("kind", "element_id", "type", "attributes", "source_id", "target_id")))


def upserts(merged: DataFrame) -> DataFrame:
    """Upsert events of merged elements."""
    rows = merged.withColumn("payload_hash", element_hash()).withColumn("operation", F.lit("upsert"))
    return _event(rows)


def deletes(lost: DataFrame) -> DataFrame:
    """Delete events of elements without contributors left."""
    gone = lost.where(F.col("left") == 0).select("element_id", F.col("expired_ns").alias("observed_ns"))
    null = F.lit(None).cast("string")
    rows = gone.withColumns({"operation": F.lit("delete"), "payload_hash": null, "kind": null, "type": null, "source_id": null, "target_id": null, "attributes": F.lit(None).cast(ids.ATTRIBUTES)})
    return _event(rows)


def _event(rows: DataFrame, *more: str) -> DataFrame:
    id_ = ids.event_id(F.col("operation"), F.col("element_id"), F.col("observed_ns"), F.col("payload_hash"))
    return rows.select(
        F.lit("3.0").alias("schema_version"), id_.alias("event_id"), F.lit("graph_element_state_changed").alias("event_type"), "element_id",
        F.col("observed_ns").alias("observed_at_unix_nano"), "operation", "payload_hash", "kind", "type", "source_id", "target_id", "attributes", *more,
    )


def suppress_unchanged(events: DataFrame) -> DataFrame:
    """Events in order of observation without those whose payload is that of the one before."""
    order = W.partitionBy("element_id").orderBy("observed_at_unix_nano", "event_id")
    marked = events.withColumn("_before", F.lag(F.coalesce("payload_hash", F.lit(""))).over(order))
    return marked.where(F.col("_before").isNull() | (F.col("_before") != F.coalesce("payload_hash", F.lit("")))).drop("_before")
