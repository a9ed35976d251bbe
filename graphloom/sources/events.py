"""Graph events as JSON records (schema 3.0), and the tables a stream of them keeps up to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from ..operators import projection as pj
from ..registry import Registry, default

_ELEMENT = ("kind", "element_id", "type", "attributes", "source_id", "target_id")


# ------------------------------------------------------------------------------ records
def _element(attributes: Column, typed: bool) -> Column:
    """The element's JSON; ``attributes`` are typed values or JSON literals."""
    if not typed:
        attributes = F.transform_values(attributes, lambda _, x: F.struct(F.lit("i").alias("t"), x.alias("v")))
    kind, id_, type_, _, *ends = (F.col(c) for c in _ELEMENT)
    return ids.element_json(kind, id_, type_, attributes, *ends)


def records(events: DataFrame) -> DataFrame:
    """``key`` (the element's id) and ``value`` (JSON) of events; a delete has neither element nor hash.

    ``attributes`` is the batch's map of typed values or the stream's map of JSON literals.
    """
    typed = isinstance(events.schema["attributes"].dataType.valueType, T.StructType)
    emitted = F.col("emitted_at_unix_ms") if "emitted_at_unix_ms" in events.columns else F.unix_millis(F.current_timestamp())
    upsert = F.col("operation") == "upsert"
    text = lambda c: ids.js(F.col(c))
    fields = {
        "schema_version": text("schema_version"),
        "event_id": text("event_id"),
        "event_type": text("event_type"),
        "element_id": text("element_id"),
        "observed_at_unix_nano": F.col("observed_at_unix_nano").cast("string"),
        "emitted_at_unix_ms": emitted.cast("string"),
        "operation": text("operation"),
        "payload_hash": F.when(upsert, text("payload_hash")).otherwise("null"),
        "element": F.when(upsert, _element(F.col("attributes"), typed)).otherwise("null"),
    }
    return events.select(F.col("element_id").cast("binary").alias("key"), ids.json_object(tuple(fields.items())).alias("value"))


def _typed(x: Column) -> Column:
    """A parsed attribute value as kind and text; lists and objects keep their JSON."""
    schema = F.schema_of_variant(x)
    kind = F.when(schema == "STRING", "s").when(schema == "BOOLEAN", "b").when(schema == "BIGINT", "i").when(schema.rlike("^(DOUBLE|FLOAT|DECIMAL)"), "d").otherwise("j")
    return F.struct(kind.alias("t"), F.when(schema == "STRING", x.cast("string")).otherwise(F.to_json(x)).alias("v"))


def decode(rows: DataFrame, value: str = "value") -> DataFrame:
    """Flat events of JSON records, other columns carried along.

    Nothing is dropped: a value that is no JSON object has no schema version, an
    element that isn't the event's own or has the wrong JSON types leaves nulls
    behind, and :func:`projection.violations` names them.
    """
    v = F.try_parse_json(F.col(value).cast("string"))
    get = lambda path, type_="string": F.try_variant_get("_v", "$." + path, type_)
    text = lambda path: F.when(F.schema_of_variant(F.try_variant_get("_v", "$." + path, "variant")) == "STRING", get(path))
    own = text("element.id").eqNullSafe(text("element_id"))
    attributes = F.try_variant_get("_v", "$.element.attributes", "map<string, variant>")
    out = {c: text(c) for c in ("schema_version", "event_id", "event_type", "element_id")}
    out |= {"observed_at_unix_nano": get("observed_at_unix_nano", "bigint"), "operation": text("operation"), "payload_hash": text("payload_hash")}
    out |= {"kind": F.when(own, text("element.kind")), "type": text("element.type"), "source_id": text("element.source_id"), "target_id": text("element.target_id")}
    out |= {"attributes": F.transform_values(attributes, lambda _, x: _typed(x)).cast(ids.ATTRIBUTES), "metrics": F.try_variant_get("_v", "$.element.metrics", "variant").isNotNull()}
    rest = [F.col(c) for c in rows.columns if c != value]
    return rows.withColumn("_v", v).select(*rest, *[c.alias(name) for name, c in out.items()])


# ------------------------------------------------------------------------------ tables kept by a stream
class ElementStore:
    """Current elements as a base table and one small table per batch since.

    A batch costs its own size; every ``fold`` batches the base is written anew.
    Folders are named by batch, so a batch that is run again replaces what it
    wrote.  Only folders that were finished are read, and a base replaces all
    batches up to its own.
    """

    def __init__(self, spark: SparkSession, root: str, fold: int = 50) -> None:
        self.spark, self.root, self.fold = spark, root.rstrip("/"), fold

    def _finished(self, kind: str) -> list[int]:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath() for s in fs.listStatus(folder)]
        return sorted(int(p.getName()) for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def log(self, before: int | None = None) -> DataFrame | None:
        """The base and the later batches, with ``batch``; null where nothing was written."""
        wanted = [n for n in self._finished("base") if before is None or n < before]
        base = wanted[-1] if wanted else -1
        later = [n for n in self._finished("batch") if n > base and (before is None or n < before)]
        paths = [f"{self.root}/base/{base}"] * (base >= 0) + [f"{self.root}/batch/{n}" for n in later]
        return self.spark.read.parquet(*paths) if paths else None

    def elements(self) -> DataFrame | None:
        """Current elements as upserts."""
        log = self.log()
        return None if log is None else pj.latest_per_element(log, "batch").where("operation = 'upsert'")

    def apply(self, events: DataFrame, batch: int, order: str = "seq", registry: Registry | None = None) -> None:
        """Write the last event of each element of a batch; one broken event fails the batch before anything is written."""
        events = events.persist()
        try:
            pj.refuse_violations(events, registry)
            last = pj.latest_per_element(events, order).drop(order, "metrics").withColumn("batch", F.lit(batch).cast("long"))
            last.write.mode("overwrite").parquet(f"{self.root}/batch/{batch}")
            if (batch + 1) % self.fold == 0:
                kept = pj.latest_per_element(self.log(batch + 1), "batch").where("operation = 'upsert'")
                kept.write.mode("overwrite").parquet(f"{self.root}/base/{batch}")
        finally:
            events.unpersist()

    def tables(self, registry: Registry | None = None) -> tuple[DataFrame, DataFrame]:
        """Vertices and edges as :func:`projection.project` gives them."""
        log = self.log()
        if log is None:
            raise ValueError(f"nothing was indexed in {self.root}")
        return pj.project(log, registry or default(), "batch")


def index_stream(rows: DataFrame, store: ElementStore, checkpoint: str, order: str = "offset", registry: Registry | None = None, **trigger: object) -> object:
    """Start keeping ``store`` by a stream of records: decode, check, apply; offsets are committed after the batch.

    ``order`` is the log order within an element: all its records have one key, so
    the offset of its partition will do.
    """

    def run(batch: DataFrame, number: int) -> None:
        store.apply(decode(batch), number, order, registry)

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
