"""From decoded datapoints to contributions and rejections, without a shuffle.

A datapoint row has ``point_id, metric_id, metric_name, is_sum, temporality,
value, observed_ns, attributes``.  Its entities, edges and merged attributes are
array expressions over the row, so a datapoint succeeds or fails as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ids
from ..registry import Entity, Field, Registry, default

INTERACTION, DISCOVERY = "traces_service_graph_request_total", "semconv.graph.discovery.calls"
NODE = "struct<id: string, type: string, attributes: map<string, struct<t: string, v: string>>>"
_SIDES = ("client", "server")


def scalar_attributes(pairs: Column) -> Column:
    """Attribute map of ``array<struct<key, t, v>>``: null kinds (not scalar) dropped, the last of a key wins."""
    scalars = F.filter(pairs, lambda p: p["t"].isin("s", "b", "i", "d"))
    last = F.filter(F.transform(scalars, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda x: ~F.exists(F.slice(scalars, x["i"] + 2, F.greatest(F.size(scalars), F.lit(1))), lambda q: q["key"] == x["p"]["key"]))
    entries = F.transform(last, lambda x: F.struct(x["p"]["key"].alias("key"), F.struct(x["p"]["t"].alias("t"), x["p"]["v"].alias("v")).alias("value")))
    return F.map_from_entries(F.array_sort(entries))


def _valid(value: Column, kind: str, required: bool, members: tuple[str, ...]) -> Column:
    t, v = value["t"], value["v"]
    if kind == "enum":
        return (t == "s") & v.isin(*members)
    if kind == "str":
        return (t == "s") & (v != "") if required else t == "s"
    if kind == "int":
        return t == "i"
    if kind == "num":
        return t.isin("i", "d") & ~v.isin("NaN", "Infinity", "-Infinity")
    if kind == "bool":
        return t == "b"
    return F.lit(False)


def _under(attributes: Column, prefix: str) -> Column:
    return F.map_filter(attributes, lambda k, _: k.startswith(prefix) & (k != prefix))


def _checker(f: Field):
    return lambda x: _valid(x, f.item, False, f.members)


def extract_entity(attributes: Column, entity: Entity) -> Column:
    """The entity as ``NODE``; null if an identity attribute is missing or any modelled one invalid."""
    get = lambda name: F.try_element_at(attributes, F.lit(name))
    good = F.lit(True)
    for f in entity.fields:
        if f.is_map:
            prefix = f.name + "."
            good &= F.forall(F.map_values(_under(attributes, prefix)), _checker(f))
        elif f.kind.endswith("-array"):
            good &= get(f.name).isNull()  # a scalar is no array
        else:
            ok = F.coalesce(_valid(get(f.name), f.kind, f.required, f.members), F.lit(False))
            good &= ok if f.required else get(f.name).isNull() | ok
    names = [f.name for f in entity.fields if not f.is_map]
    prefixes = [f.name + "." for f in entity.fields if f.is_map]
    numbers = [f.name for f in entity.fields if f.kind == "num"]

    def modelled(k: Column, _: Column) -> Column:
        c = k.isin(*names)
        for p in prefixes:
            c |= k.startswith(p) & (k != p)
        return c

    def coerced(k: Column, x: Column) -> Column:
        double = F.struct(F.lit("d").alias("t"), x["v"].cast("double").cast("string").alias("v"))
        return F.when(k.isin(*numbers), double).otherwise(x)

    kept = F.map_filter(attributes, modelled)
    kept = F.transform_values(kept, coerced) if numbers else kept
    text = lambda name: F.when(get(name)["t"] == "b", F.initcap(get(name)["v"])).otherwise(get(name)["v"])
    node = F.struct(ids.node_id(entity.type, *map(text, entity.identity)).alias("id"), F.lit(entity.type).alias("type"), kept.alias("attributes"))
    return F.when(good, node).cast(NODE)


def extract_entities(attributes: Column, lane: str | None = None, registry: Registry | None = None, types: list[str] | None = None) -> Column:
    """All valid entities of the attributes, of one lane's types or of all; invalid ones don't hide others."""
    r = registry or default()
    chosen = types if types is not None else sorted(r.entities) if lane is None else r.lane_types(lane)
    found = F.array(*[extract_entity(attributes, r.entities[t]) for t in chosen]).cast(f"array<{NODE}>")
    return F.filter(found, lambda e: e.isNotNull())


def extract_strict(attributes: Column, lane: str | None = None, registry: Registry | None = None, types: list[str] | None = None) -> Column:
    """All entities whose identity attributes are all there; one that isn't valid then is an error in the query."""
    r = registry or default()
    chosen = types if types is not None else sorted(r.entities) if lane is None else r.lane_types(lane)

    def strict(t: str) -> Column:
        named = F.forall(F.array(*map(F.lit, r.entities[t].identity)), lambda k: F.map_contains_key(attributes, k))
        return F.when(named, require_entity(attributes, t, r))

    return F.filter(F.array(*map(strict, chosen)).cast(f"array<{NODE}>"), lambda e: e.isNotNull())


def require_entity(attributes: Column, type_: str, registry: Registry | None = None) -> Column:
    """The entity, or an error in the query where it isn't valid or has no identity."""
    e = extract_entity(attributes, (registry or default()).entities[type_])
    return F.when(e.isNotNull(), e).otherwise(F.raise_error(F.lit(f"no valid {type_}")).cast(NODE))


def id_map(nodes: Column) -> Column:
    """Entity ids by type; a set has one entity of a type at most."""
    return F.map_from_entries(F.transform(nodes, lambda n: F.struct(n["type"], n["id"])))


def expand_edges(sources: Column, targets: Column, lane: str, scope: str, connection: Column | None = None, registry: Registry | None = None, types: list[str] | None = None) -> Column:
    """Edges between two entity sets (id maps) by the registry's rules, without self-loops.

    Rules whose endpoints can't be there (``types``) are left out when the plan is made.
    """
    rules = (registry or default()).rules(lane, scope)
    edges = []
    for x in rules:
        if types is None or {x.source, x.target} <= set(types):
            s, d = F.try_element_at(sources, F.lit(x.source)), F.try_element_at(targets, F.lit(x.target))
            holds = s.isNotNull() & d.isNotNull() & (s != d)
            if connection is not None:
                holds &= connection == x.connection_type
            edges.append(F.when(holds, F.struct(F.lit(x.type).alias("type"), s.alias("source_id"), d.alias("target_id"))))
    found = F.array(*edges).cast("array<struct<type: string, source_id: string, target_id: string>>")
    return F.filter(found, lambda e: e.isNotNull())


def side(attributes: Column, name: str, service: Column) -> Column:
    """Attributes of one side, prefix stripped; the service's name unless the side names it itself."""
    prefix = name + "_"
    own = F.transform_keys(F.map_filter(attributes, lambda k, _: k.startswith(prefix)), lambda k, _: F.substring(k, F.lit(len(prefix) + 1), F.length(k)))
    named = F.map_from_arrays(F.array(F.lit("service.name")), F.array(F.struct(F.lit("s").alias("t"), service.alias("v")))).cast(ids.ATTRIBUTES)
    return F.when(F.map_contains_key(own, "service.name"), own).otherwise(F.map_concat(named, own))


def connection_type(attributes: Column) -> Column:
    """Null and empty count as ``unset``."""
    return F.coalesce(F.nullif(F.try_element_at(attributes, F.lit("connection_type"))["v"], F.lit("")), F.lit("unset"))


def merge_nodes(left: Column, right: Column) -> Column:
    """Nodes of both; of one that is in both, attributes that differ take the value whose JSON text is smaller."""
    smaller = lambda _, a, b: F.when(a.isNull() | (b.isNotNull() & (ids.literal(b) < ids.literal(a))), b).otherwise(a)

    def with_other(n: Column) -> Column:
        other = F.filter(right, lambda m: m["id"] == n["id"])
        both = F.map_zip_with(n["attributes"], F.get(other, 0)["attributes"], smaller)
        return F.when(F.size(other) > 0, n.withField("attributes", both)).otherwise(n)

    mine = F.transform(left, lambda n: n["id"])
    return F.concat(F.transform(left, with_other), F.filter(right, lambda n: ~F.array_contains(mine, n["id"])))


def classify(points: DataFrame) -> DataFrame:
    """Datapoints of the two known metrics with the ``reason`` for which a point is refused, or null."""
    a = F.col("attributes")
    named = lambda name: F.coalesce((F.try_element_at(a, F.lit(name))["t"] == "s") & (F.try_element_at(a, F.lit(name))["v"] != ""), F.lit(False))
    connection = F.try_element_at(a, F.lit("connection_type"))
    usable = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")) & (F.col("value") > 0) & (F.col("observed_ns") > 0)
    pair = named("client") & named("server") & (connection.isNull() | F.coalesce(connection["t"] == "s", F.lit(False)))
    reason = (
        F.when(~F.col("is_sum"), "invalid_servicegraph_metric_type")
        .when(F.col("temporality") != "delta", "invalid_servicegraph_temporality")
        .when(~F.coalesce(usable, F.lit(False)), "invalid_servicegraph_datapoint")
        .when((F.col("metric_name") == INTERACTION) & ~pair, "invalid_servicegraph_datapoint")
    )
    return points.where(F.col("metric_name").isin(INTERACTION, DISCOVERY)).withColumn("reason", reason)


def newest(points: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """The newest accepted service-graph point of each contributor, of equally new ones the last to arrive, with its ``contributor_id``.

    That id is a hash of all the attributes a point's elements are made of, so points of one contributor give the same
    contributions, and those of its newest point are what ``lifecycle.latest`` leaves of them: points are fewer than
    contributions, and nothing is extracted in vain.  ``within`` names columns that a contributor determines; where
    points lie partitioned by them, they aren't shuffled again.
    """
    rows = points.where(F.col("reason").isNull() & (F.col("metric_name") == INTERACTION)).withColumn("contributor_id", _contributor(F.col("attributes")))
    order = W.partitionBy(*within, "contributor_id").orderBy(F.desc("observed_ns"), F.desc("point_id"))
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def _contributor(a: Column) -> Column:
    text = lambda name: F.try_element_at(a, F.lit(name))["v"]
    dimensions = F.map_filter(a, lambda k, _: ~k.isin("client", "server", "connection_type"))
    return ids.interaction_contributor(text("client"), text("server"), connection_type(a), dimensions)


def _contributions(points: DataFrame, nodes: Column, edges: Column, contributor: Column | None, keep: tuple[str, ...] = ()) -> DataFrame:
    empty = F.expr(ids.NO_ATTRIBUTES)
    null = F.lit(None).cast("string")
    shape = lambda kind, e, s, d: F.struct(F.lit(kind).alias("kind"), e["id"].alias("element_id"), e["type"].alias("type"), s.alias("source_id"), d.alias("target_id"), e["attributes"].alias("attributes"))
    whole = F.transform(nodes, lambda n: shape("node", n, null, null))
    named = F.transform(edges, lambda e: F.struct(ids.edge_id(e["source_id"], e["type"], e["target_id"]).alias("id"), e["type"].alias("type"), empty.alias("attributes"), e["source_id"], e["target_id"]))
    both = F.concat(whole, F.transform(named, lambda e: shape("edge", e, e["source_id"], e["target_id"])))
    rows = points.withColumn("_contributor", contributor if contributor is not None else null).select("point_id", "observed_ns", "_contributor", *keep, F.explode(both).alias("e")).select("point_id", "observed_ns", "_contributor", *keep, "e.*")
    id_ = F.col("_contributor") if contributor is not None else ids.discovery_contributor(DISCOVERY, F.col("element_id"), F.col("attributes"))
    return rows.select("point_id", id_.alias("contributor_id"), "observed_ns", "element_id", "kind", "type", "source_id", "target_id", "attributes", *keep)


def interactions(points: DataFrame, registry: Registry | None = None, types: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Contributions of accepted service-graph points, with the columns ``keep`` of their points; a ``contributor_id`` of ``newest`` is taken over."""
    lane = "service_graph"
    a = F.col("attributes")
    text = lambda name: F.try_element_at(a, F.lit(name))["v"]
    rows = points.where(F.col("reason").isNull() & (F.col("metric_name") == INTERACTION))
    # One projection after the other: each is evaluated once per row, however often the next refers to it.
    rows = rows.withColumns({"_connection": connection_type(a), **{f"_{s}_side": side(a, s, text(s)) for s in _SIDES}})
    rows = rows.withColumns({f"_{s}": extract_entities(F.col(f"_{s}_side"), lane, registry, types) for s in _SIDES})
    rows = rows.withColumns({f"_{s}_ids": id_map(F.col(f"_{s}")) for s in _SIDES})
    mine, theirs = (F.col(f"_{s}_ids") for s in _SIDES)
    observed = [expand_edges(x, x, lane, "observation", None, registry, types) for x in (mine, theirs)]
    between = expand_edges(mine, theirs, lane, "interaction", F.col("_connection"), registry, types)
    contributor = F.col("contributor_id") if "contributor_id" in points.columns else _contributor(a)
    return _contributions(rows, merge_nodes(F.col("_client"), F.col("_server")), F.array_distinct(F.concat(*observed, between)), contributor, keep)


def discoveries(points: DataFrame, registry: Registry | None = None, types: list[str] | None = None) -> DataFrame:
    """Contributions of accepted discovery points."""
    lane = "span_metrics"
    rows = points.where(F.col("reason").isNull() & (F.col("metric_name") == DISCOVERY))
    rows = rows.withColumn("_own", extract_entities(F.col("attributes"), lane, registry, types))
    rows = rows.withColumn("_own_ids", id_map(F.col("_own")))
    edges = expand_edges(F.col("_own_ids"), F.col("_own_ids"), lane, "observation", None, registry, types)
    return _contributions(rows, F.col("_own"), edges, None)


def parse(points: DataFrame, registry: Registry | None = None, types: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(contributions, rejections)``."""
    marked = classify(points)
    return interactions(marked, registry, types).unionByName(discoveries(marked, registry, types)), rejections(marked, registry)


def rejections(marked: DataFrame, registry: Registry | None = None) -> DataFrame:
    """What is refused of classified points, a metric once.  An unsupported connection type is a rejection, yet the point's nodes count."""
    r = registry or default()
    metric = F.col("reason").isin("invalid_servicegraph_metric_type", "invalid_servicegraph_temporality")
    refused = marked.where("reason IS NOT NULL").select("reason", F.when(metric, F.col("metric_id")).otherwise(F.col("point_id")).alias("of"), F.lit("").alias("detail"), metric.alias("whole"))
    once = refused.where("whole").dropDuplicates(["reason", "of"]).unionByName(refused.where("NOT whole")).drop("whole")
    kind = connection_type(F.col("attributes"))
    odd = marked.where(F.col("reason").isNull() & (F.col("metric_name") == INTERACTION) & ~kind.isin(r.connection_types("service_graph")))
    odd = odd.select(F.lit("unsupported_servicegraph_connection_type").alias("reason"), F.col("point_id").alias("of"), F.left(kind, F.lit(512)).alias("detail"))
    return once.unionByName(odd)


def rejection_counts(rejections: DataFrame) -> DataFrame:
    return rejections.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
