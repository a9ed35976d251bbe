"""The lifecycle stream over files against the batch result."""

import random
import time

from pyspark.sql import functions as F

from graphloom.streaming.model import FAR, NS, Element, Lifecycle, Observation, Ttl, merged
from graphloom.streaming.processors import OBSERVATION, coalesce_stream, lifecycle_stream


def test_stream_equals_model_and_expires(spark, tmp_path):
    rows = [("service:a", "x", 10**18, "node", "service", None, None, {"v": '"1"'}), ("service:a", "y", 10**18 + 1, "node", "service", None, None, {"v": '"2"'})]
    spark.createDataFrame(rows, OBSERVATION).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(OBSERVATION).parquet(str(tmp_path / "in"))
    events = lifecycle_stream(coalesce_stream(source, 1, Ttl(3)), Ttl(3))
    query = events.writeStream.format("memory").queryName("events").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    try:
        until = time.time() + 90
        while time.time() < until and not spark.table("events").where("operation = 'delete'").count():
            time.sleep(1)
        got = spark.table("events").select("operation", F.col("attributes")["v"].alias("v")).collect()
    finally:
        query.stop()
    assert got[0].operation == "upsert" and got[-1].operation == "delete"
    assert '"2"' in [r.v for r in got]


def test_index_equals_full_merge():
    """Refreshes, lost attributes, older rows and expiry of a crowd of contributors, each step against a merge of all."""
    rng = random.Random(5)
    rules, e, watermark = Lifecycle(Ttl(40)), Element({}), 0
    for step in range(3_000):
        if rng.random() < 0.1:
            watermark += rng.randrange(12) * NS
            x = rules.expire(e, watermark, 0)
            assert all(s.event_deadline_ns > watermark for s in e.contributors.values())
            assert x is None or (x.operation == "delete") == (not e.contributors)
        else:
            names = rng.sample("abcdef", rng.randrange(4))
            who = f"c{rng.randrange(30)}"
            at = max(0, watermark + rng.randrange(-10, 30) * NS)
            rules.observe(e, Observation("service:x", who, at, "node", "service", None, None, tuple(sorted((n, str(step % 7)) for n in names))), watermark, 0)
        assert dict(sorted(e.values.items())) == merged(e.contributors)
        assert e.event_due_ns <= min((s.event_deadline_ns for s in e.contributors.values()), default=FAR)
        assert all(n in dict(e.contributors[k].observation.attributes) for n, k in e.owners.items())


def test_refresh_does_not_read_other_contributors():
    class Counted(dict):
        read = 0

        def __getitem__(self, k):
            Counted.read += 1
            return super().__getitem__(k)

        def values(self):
            raise AssertionError("all contributors read")

        items = values

    rules, e = Lifecycle(Ttl(10**6)), Element(Counted())
    for i in range(2_000):
        rules.observe(e, Observation("service:x", f"c{i}", i, "node", "service", None, None, (("a", "1"), ("b", str(i)))), 0, 0)
    assert Counted.read <= 2 * 2_000
