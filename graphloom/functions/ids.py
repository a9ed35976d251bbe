"""Identities and hashes as Column expressions.

Attributes are a ``map<string, struct<t, v>>``: ``t`` is s, b, i or d (string,
boolean, integer, double) and ``v`` the value's text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ATTRIBUTES = "map<string, struct<t: string, v: string>>"
NO_ATTRIBUTES = f"cast(map() as {ATTRIBUTES})"


def js(text: Column) -> Column:
    """A string as a JSON literal."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def literal(value: Column) -> Column:
    """An attribute value as a JSON literal."""
    return F.when(value["t"] == "s", js(value["v"])).otherwise(value["v"])


def attributes_json(attributes: Column) -> Column:
    """The map as a compact JSON object, keys sorted."""
    entries = F.array_sort(F.map_entries(attributes))
    return F.concat(F.lit("{"), F.concat_ws(",", F.transform(entries, lambda e: F.concat(js(e["key"]), F.lit(":"), literal(e["value"])))), F.lit("}"))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def pct(text: Column) -> Column:
    """Percent-encoding that keeps A-Z a-z 0-9 - . _ ~ only."""
    form = F.url_encode(text)
    return F.replace(F.replace(F.replace(form, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def node_id(type_: str, *values: Column) -> Column:
    """``type:value:...``; null where a value is null."""
    return F.concat(F.lit(type_), *[x for v in values for x in (F.lit(":"), pct(v))])


def edge_id(source: Column, type_: Column, target: Column) -> Column:
    body = F.concat(F.lit('{"source_id":'), js(source), F.lit(',"target_id":'), js(target), F.lit(',"type":'), js(type_), F.lit("}"))
    return F.concat(F.lit("edge:"), sha256(body))


def interaction_contributor(client: Column, server: Column, connection: Column, dimensions: Column) -> Column:
    parts = (("client", js(client)), ("server", js(server)), ("connection_type", js(connection)), ("dimensions", attributes_json(dimensions)))
    return sha256(json_object(parts))


def discovery_contributor(source: str, element_id: Column, attributes: Column) -> Column:
    parts = (("source", js(F.lit(source))), ("element_id", js(element_id)), ("attributes", attributes_json(attributes)))
    return F.concat(F.lit("spanmetrics:"), sha256(json_object(parts)))


def json_object(parts: tuple) -> Column:
    """JSON object of names and JSON texts."""
    pieces: list[Column] = []
    for i, (name, value) in enumerate(parts):
        pieces += [F.lit(("{" if not i else ",") + f'"{name}":'), value]
    return F.concat(*pieces, F.lit("}"))


def element_json(kind: Column, id_: Column, type_: Column, attributes: Column, source: Column, target: Column) -> Column:
    node = json_object((("kind", js(kind)), ("id", js(id_)), ("type", js(type_)), ("attributes", attributes_json(attributes))))
    ends = F.concat(F.lit(',"source_id":'), js(source), F.lit(',"target_id":'), js(target), F.lit("}"))
    return F.when(kind == "node", node).otherwise(F.concat(F.substring(node, F.lit(1), F.length(node) - 1), ends))


def payload_hash(*element: Column) -> Column:
    return sha256(element_json(*element))


def event_id(operation: Column, element_id: Column, observed: Column, hash_: Column) -> Column:
    """``hash_`` is null for a delete."""
    shown = F.coalesce(js(hash_), F.lit("null"))
    shown = F.when(hash_.isNull(), F.lit("null")).otherwise(shown)
    return sha256(json_object((("operation", js(operation)), ("element_id", js(element_id)), ("observed_at_unix_nano", observed.cast("string")), ("payload_hash", shown))))


def document_key(element_id: Column) -> Column:
    return sha256(element_id)


def type_of_id(element_id: Column) -> Column:
    return F.substring_index(element_id, ":", 1)
