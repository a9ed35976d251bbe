"""Projection of lifecycle events into vertex and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from ..registry import Registry, default

#: Lost ends up to which they are broadcast.
FEW = 10_000
_ENVELOPE = ("schema_version", "event_id", "payload_hash", "observed_at_unix_nano")


class ContractError(ValueError):
    """Events break the schema-3.0 contract; nothing of the batch is applied."""


def violations(events: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Events (flat columns) that break the contract, with the reason."""
    r = registry or default()
    edge = F.col("kind") == "edge"
    ends = ids.type_of_id(F.col("source_id")).isin(*r.graph_types()) & ids.type_of_id(F.col("target_id")).isin(*r.graph_types())
    upsert = F.col("operation") == "upsert"
    metrics = F.map_contains_key("attributes", "metrics")
    if "metrics" in events.columns:
        metrics = metrics | F.col("metrics")
    nodes = F.col("element_id").startswith("edge:") | ids.type_of_id(F.col("element_id")).isin(*r.graph_types())
    reason = (
        F.when(F.coalesce(F.col("schema_version") != "3.0", F.lit(True)), "schema version")
        .when(F.coalesce(F.col("event_type") != "graph_element_state_changed", F.lit(True)), "event type")
        .when(~F.coalesce(F.col("operation").isin("upsert", "delete"), F.lit(False)), "operation")
        .when(F.col("element_id").isNull(), "element id")
        .when(upsert & ~F.coalesce(F.col("kind").isin("node", "edge"), F.lit(False)), "kind")
        .when(upsert & ~edge & ~F.coalesce(F.col("type").isin(*r.graph_types()), F.lit(False)), "vertex type")
        .when(upsert & edge & ~F.coalesce(F.col("type").isin(*r.edge_types()), F.lit(False)), "edge type")
        .when(upsert & edge & ~F.coalesce(ends, F.lit(False)), "endpoints")
        .when(upsert & F.coalesce(metrics, F.lit(False)), "metrics")
        .when(~upsert & ~nodes, "type of a deleted node")
    )
    return events.withColumn("violation", reason).where("violation IS NOT NULL")


def removed(events: DataFrame, registry: Registry | None = None, order: str = "seq") -> DataFrame:
    """Documents that the events delete; an edge's id doesn't tell its collection, which is null."""
    gone = latest_per_element(events, order).where(F.col("operation") == "delete")
    return gone.select("element_id", ids.document_key(F.col("element_id")).alias("_key"), _collection(ids.type_of_id(F.col("element_id")), registry or default()).alias("collection"))


def refuse_violations(events: DataFrame, registry: Registry | None = None) -> None:
    if bad := violations(events, registry).select("element_id", "violation").limit(1).collect():
        raise ContractError(f"{bad[0]['element_id']}: {bad[0]['violation']}")


def latest_per_element(events: DataFrame, order: str = "seq") -> DataFrame:
    """The last event of each element in log order."""
    rest = [c for c in events.columns if c != "element_id"]
    return events.groupBy("element_id").agg(F.max_by(F.struct(*rest), order).alias("e")).select("element_id", "e.*")


def plain(value: Column) -> Column:
    return value["v"]


def _documents(upserts: DataFrame, r: Registry, edges: bool) -> DataFrame:
    a = F.col("attributes")
    aliases = [plain(F.try_element_at(a, F.lit(name))).alias(alias) for name, alias in r.aliases().items()]
    ends: list[Column] = []
    if edges:
        place = lambda c: F.concat(_collection(ids.type_of_id(F.col(c)), r), F.lit("/"), ids.document_key(F.col(c)))
        ends = [place("source_id").alias("_from"), place("target_id").alias("_to"), F.col("source_id"), F.col("target_id")]
    return upserts.select(ids.document_key(F.col("element_id")).alias("_key"), "element_id", F.col("type").alias("semantic_type"), "attributes", *_ENVELOPE, *ends, *aliases)


def _collection(type_: Column, r: Registry) -> Column:
    names = r.graph_schema()["vertices"]
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), type_)


def project(events: DataFrame, registry: Registry | None = None, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Vertices and edges after all events, latest per element; a node's deletion leaves its edges dangling."""
    r = registry or default()
    last = latest_per_element(events, order).where(F.col("operation") == "upsert")
    return _documents(last.where(F.col("kind") == "node"), r, False), _documents(last.where(F.col("kind") == "edge"), r, True)


def apply_batch(snapshot: DataFrame | None, events: DataFrame, registry: Registry | None = None, order: str = "seq") -> DataFrame:
    """The element table after a batch: its elements replaced or deleted; replaying a batch changes nothing.

    Any event that breaks the contract fails the batch.
    """
    refuse_violations(events, registry)
    last = latest_per_element(events, order)
    fresh = last.where(F.col("operation") == "upsert")
    if snapshot is None:
        return fresh
    kept = snapshot.join(last.select("element_id"), "element_id", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def ensure_tables(spark: SparkSession, database: str, registry: Registry | None = None) -> str:
    """Create or check the two tables; ``created``, ``updated`` (one was missing) or ``unchanged``; another schema is an error."""
    r = registry or default()
    empty = spark.createDataFrame([], T.StructType.fromDDL("element_id string, type string, kind string, source_id string, target_id string, schema_version string, event_id string, payload_hash string, observed_at_unix_nano long, attributes " + ids.ATTRIBUTES))
    made = 0
    for name, edges in (("vertices", False), ("edges", True)):
        want = _documents(empty, r, edges)
        full = f"{database}.{name}"
        if spark.catalog.tableExists(full):
            have = spark.table(full).schema
            if [(f.name, f.dataType) for f in have] != [(f.name, f.dataType) for f in want.schema]:
                raise ContractError(f"table {full} has another schema")
        else:
            want.write.saveAsTable(full)
            made += 1
    return ("unchanged", "updated", "created")[made]


def duplicates(table: DataFrame) -> DataFrame:
    """Element ids that a table holds more than once (a unique index would refuse them)."""
    return table.groupBy("element_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dangling_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges of which an endpoint is no vertex.

    Ends are looked up first, each once, and kept; edges themselves are shuffled only where lost ends are many.
    """
    ends = edges.select(F.explode(F.array("source_id", "target_id")).alias("end")).distinct()
    lost = ends.join(vertices.select(F.col("element_id").alias("v")), F.col("end") == F.col("v"), "left_anti").persist()
    found = F.broadcast(lost) if lost.limit(FEW + 1).count() <= FEW else lost
    both = [edges.join(found, F.col(c).eqNullSafe(F.col("end")), "left_semi") for c in ("source_id", "target_id")]
    return both[0].unionByName(both[1]).dropDuplicates(["element_id"])
