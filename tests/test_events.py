"""Graph events over JSON: round trip, contract, and the tables a stream keeps."""

import json

import pytest
from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.operators import lifecycle as lc
from graphloom.operators import projection as pj
from graphloom.plans import queries as Q
from graphloom.sources.events import ElementStore, decode, index_stream, records

DIR = "/root/testdata/sf0.001"
NODE = {
    "schema_version": "3.0", "event_id": "e", "event_type": "graph_element_state_changed", "element_id": "service:a", "observed_at_unix_nano": 5, "emitted_at_unix_ms": 6,
    "operation": "upsert", "payload_hash": "h", "element": {"kind": "node", "id": "service:a", "type": "service", "attributes": {"service.name": "a"}},
}
DELETE = NODE | {"operation": "delete", "payload_hash": None, "element": None}


def lines(spark, *events):
    rows = [(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "seq long, value string")


def test_record_shape(spark):
    a = F.from_json(F.lit('{"service.name":{"t":"s","v":"a \\"b\\" é"},"x":{"t":"i","v":"7"},"y":{"t":"d","v":"1.5"},"z":{"t":"b","v":"true"}}'), ids.ATTRIBUTES)
    node = spark.range(1).select(F.lit("node").alias("kind"), F.lit("service:a").alias("element_id"), F.lit("service").alias("type"), a.alias("attributes"), F.lit(5).cast("long").alias("observed_ns"), *[F.lit(None).cast("string").alias(c) for c in ("source_id", "target_id")])
    events = lc.upserts(node)
    row = records(events).first()
    got = json.loads(row.value)
    assert bytes(row.key) == b"service:a"
    assert set(got) == set(NODE) and got["element"] == {"kind": "node", "id": "service:a", "type": "service", "attributes": {"service.name": 'a "b" é', "x": 7, "y": 1.5, "z": True}}
    back = decode(records(events).drop("key")).drop("metrics")
    assert back.first() == events.select(*back.columns).first()
    stream = events.withColumn("attributes", F.transform_values("attributes", lambda _, x: ids.literal(x)))
    assert json.loads(records(stream).first().value)["element"] == got["element"]
    gone = lc.deletes(spark.createDataFrame([("service:a", 9, 0)], "element_id string, expired_ns long, left long"))
    assert json.loads(records(gone).first().value)["element"] is None


@pytest.mark.parametrize(
    "event, why",
    [
        ("no json", "schema version"),
        ("[1]", "schema version"),
        (NODE | {"schema_version": "2.0"}, "schema version"),
        (NODE | {"schema_version": 3.0}, "schema version"),
        (NODE | {"element_id": 7}, "element id"),
        (NODE | {"element": None}, "kind"),
        (NODE | {"element": NODE["element"] | {"id": "service:b"}}, "kind"),
        (NODE | {"element": NODE["element"] | {"metrics": {}}}, "metrics"),
        (NODE | {"element": NODE["element"] | {"type": "odd"}}, "vertex type"),
        (DELETE | {"element_id": "odd:a"}, "type of a deleted node"),
        (NODE, None),
        (DELETE, None),
    ],
)
def test_contract(spark, event, why):
    bad = [r.violation for r in pj.violations(decode(lines(spark, event))).collect()]
    assert bad == ([why] if why else [])


def test_stream_ends_in_the_tables_of_a_batch(spark, tmp_path):
    events = Q.QUERIES["project_latest_per_element"] and Q._events(spark, DIR)
    for n in (1, 2, 3):
        part = events.where(F.col("seq") == n)
        records(part).select(F.col("value"), F.lit(n).cast("long").alias("offset")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    store = ElementStore(spark, str(tmp_path / "out"), fold=2)
    source = spark.readStream.schema("value string, offset long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second time nothing is new
        index_stream(source, store, str(tmp_path / "cp"), availableNow=True).awaitTermination()
        got, want = store.tables(), pj.project(events)
        for x, y in zip(got, want, strict=True):
            key = ["_key", "element_id", "semantic_type", "payload_hash", "observed_at_unix_nano"]
            assert sorted(map(tuple, x.select(key).collect())) == sorted(map(tuple, y.select(key).collect()))


def test_store_batches(spark, tmp_path):
    store = ElementStore(spark, str(tmp_path), fold=2)
    assert store.elements() is None
    other = NODE | {"element_id": "service:b", "element": NODE["element"] | {"id": "service:b"}}
    batches = [(NODE, other), (DELETE,), (NODE | {"payload_hash": "new"}, DELETE | {"element_id": "service:b"})]
    for n, b in enumerate(batches):
        for _ in range(2):  # run again, as after a failure
            store.apply(decode(lines(spark, *b)), n)
    assert [(r.element_id, r.payload_hash) for r in store.elements().collect()] == [("service:a", "new")]
    with pytest.raises(pj.ContractError):
        store.apply(decode(lines(spark, NODE, "broken")), 3)
    assert store.elements().count() == 1
