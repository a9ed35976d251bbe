"""Identities, registry, the lifecycle model, traversal rules, sources."""

import json
import random

import pytest
from pyspark.sql import functions as F

from graphloom import registry as R
from graphloom.functions import ids
from graphloom.operators import evidence as ev
from graphloom.operators import lifecycle as lc
from graphloom.operators import projection as pj
from graphloom.operators import traversal as tv
from graphloom.operators import upstream as up
from graphloom.plans import fixtures as fx
from graphloom.sources import kafka, otlp
from graphloom.streaming.model import Coalescer, Element, IdentityConflict, Lifecycle, Observation, Ttl, event_id, merged, payload_hash

SERVICE_HASH = "8cda6b52db893c36b9f1666e8598ece8e904b8201485f7d8c9732a54b3199659"
EVENT_ID = "bdf8240de5f8f6ed1e714375257d720d44b842305181ec9faa8d2a87edbc8457"
CONTRIBUTOR = "304cd3684aee2ba32409d769dfb4f8081d92a35134e94e9fa1bd5a56345cda27"
EDGE = "edge:2861668fed035e86438961428a6cb86070881310f4b4a4b40c09b5fbdd73f5dc"


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def obs(contributor="c", at=1, element="service:one", **attributes):
    return Observation(element, contributor, at, "node", "service", None, None, tuple(sorted((k, json.dumps(v)) for k, v in attributes.items())))


def test_hash_vectors(spark):
    a = fx.attributes(client_service__version=fx.text("1.2.3"))
    row = one(
        spark,
        ids.interaction_contributor(F.lit("checkout"), F.lit("payments"), F.lit("unset"), a).alias("c"),
        ids.edge_id(F.lit("service:checkout"), F.lit("calls"), F.lit("service:payments")).alias("e"),
        ids.event_id(F.lit("upsert"), F.lit("service:one"), F.lit(1), F.lit(SERVICE_HASH)).alias("v"),
        ids.node_id("transaction", F.lit("worker"), F.lit("reconcile customers"), F.lit("SPAN_KIND_INTERNAL")).alias("n"),
    )
    assert (row.c, row.e, row.v) == (CONTRIBUTOR, EDGE, EVENT_ID)
    assert row.n == "transaction:worker:reconcile%20customers:SPAN_KIND_INTERNAL"
    nested = Observation("service:one", "c", 1, "node", "service", None, None, (("a", "2"), ("nested", '{"a":2,"z":1}'), ("z", "1")))
    assert payload_hash(nested, dict(nested.attributes)) == SERVICE_HASH
    assert event_id("upsert", "service:one", 1, SERVICE_HASH) == EVENT_ID


def test_registry_counts_and_rules():
    r = R.default()
    assert [len(r.lane_types(x)) for x in ("service_graph", "span_metrics")] == [29, 33]
    schema = r.graph_schema()
    assert [len(schema[x]) for x in ("vertices", "edges", "aliases")] == [33, 10, 92]
    R.verify_schema(schema)
    with pytest.raises(R.RegistryError):
        R.verify_schema(schema | {"aliases": {}})
    bad = R.Registry.of({"entities": {"a": {"identity": {"a.id": "str"}}}, "relationships": [["a", "calls", "b", "sg", "observation"]]})
    with pytest.raises(R.RegistryError):
        R.validate(bad)
    with pytest.raises(ValueError):
        R.quote_identity([1.5])
    assert R.quote_identity([True, 3, "x"]) == ["True", "3", "x"]


def test_bad_points_are_refused(spark):
    a = fx.attributes(client=fx.text("a"), server=fx.text("b"))
    rows = [(1, True, "delta", 1.0), (2, True, "delta", 0.0), (3, True, "delta", float("nan")), (4, True, "delta", float("inf")), (5, False, None, 1.0), (6, True, "cumulative", 1.0), (7, True, "delta", None)]
    df = spark.createDataFrame(rows, "point_id long, is_sum boolean, temporality string, value double")
    df = df.select("*", F.col("point_id").alias("metric_id"), F.lit(ev.INTERACTION).alias("metric_name"), F.lit(5).cast("long").alias("observed_ns"), a.alias("attributes"))
    contributions, rejections = ev.parse(df, types=["service"])
    assert {r.point_id for r in contributions.collect()} == {1}
    assert {(r.of, r.reason) for r in rejections.collect()} == {
        *((i, "invalid_servicegraph_datapoint") for i in (2, 3, 4, 7)), (5, "invalid_servicegraph_metric_type"), (6, "invalid_servicegraph_temporality"),
    }


def test_metrics_without_points_are_refused_once(spark):
    request = otlp.message()()
    metrics = request.resource_metrics.add().scope_metrics.add().metrics
    for fill in (lambda m: None, lambda m: m.gauge.SetInParent(), lambda m: setattr(m.sum, "aggregation_temporality", 2), lambda m: setattr(m.sum, "aggregation_temporality", 1)):
        m = metrics.add(name=ev.INTERACTION)
        fill(m)
    points, bad = otlp.decode(spark.createDataFrame([(5, bytearray(request.SerializeToString()))], "payload_id long, value binary"))
    got = ev.rejections(ev.classify(points)).collect()
    assert sorted(r.reason for r in got) == ["invalid_servicegraph_metric_type"] * 2 + ["invalid_servicegraph_temporality"] and not bad.count()


def test_doubles_as_the_jvm_writes_them(spark):
    values = [0.0, -0.0, 1.5, 100.0, 1e7, 1e16, 1.25e-5, 123456789.0, -2.5e-300, 9999999.0, 0.001, float("nan"), float("-inf")]
    want = [r.v for r in spark.createDataFrame([(x,) for x in values], "x double").selectExpr("CAST(x AS STRING) AS v").collect()]
    assert [otlp.double_text(x) for x in values] == want


def test_all_entity_types_plan(spark):
    a = fx.attributes(service__name=fx.text("s"), service__criticality=fx.text("odd"), process__pid=fx.integer(F.lit(7)), process__creation__time=fx.text("t"), k8s__namespace__name=fx.text("n"), k8s__namespace__label__x=fx.text("y"))
    found = one(spark, ev.extract_entities(a, "service_graph").alias("e")).e
    assert {x.id for x in found} == {"process:7:t", "k8s.namespace:n"}  # an invalid optional field hides the service only


def test_model_winners_fall_back_and_expire():
    model, e = Lifecycle(Ttl(10)), Element({})
    assert model.observe(e, obs("a", 5, x="1", y="1"), 0, 0).operation == "upsert"
    assert model.observe(e, obs("b", 6, x="2"), 0, 1000).attributes == {"x": '"2"', "y": '"1"'}
    assert model.observe(e, obs("b", 6, x="2"), 0, 1000) is None  # unchanged
    assert model.observe(e, obs("b", 4, x="9"), 0, 1000) is None  # older
    back = model.observe(e, obs("b", 7), 0, 1000)
    assert back.attributes == {"x": '"1"', "y": '"1"'}
    with pytest.raises(IdentityConflict):
        model.observe(e, Observation("service:one", "z", 9, "node", "app", None, None, ()), 0, 0)
    part = model.expire(e, 0, 10_000)
    assert part.operation == "upsert" and part.observed_ns == 5 + 10 * 10**9
    assert model.expire(e, 0, 11_000).operation == "delete"


def test_model_coalescer():
    c, held = Coalescer(5, Ttl(60)), None
    counters = []
    for now, o in ((0, obs(at=1, x="1")), (1000, obs(at=2, x="1")), (1500, obs(at=1, x="1")), (2000, obs(at=3, x="2")), (8000, obs(at=4, x="2"))):
        held, _, what = c.observe(held, o, now)
        counters.append(what)
    assert counters == ["new", "suppressed", "out_of_order", "changed", "unchanged"]
    held, _, _ = c.observe(held, obs(at=5, x="2"), 9000)
    assert c.wake_at(held) == 13_000
    held, sent = c.wake(held, 13_000)
    assert sent.observed_ns == 5 and c.wake_at(held) == 69_000
    assert c.wake(held, 69_000) == (None, None)


def test_batch_merge_equals_model(spark):
    rng, e, model = random.Random(72), Element({}), Lifecycle(Ttl(10**6))
    rows = []
    for step in range(400):
        o = obs(f"c{rng.randrange(12)}", 1 + step // 4, **{f"f{i}": str(rng.randrange(5)) for i in range(6) if rng.random() < 0.6})
        model.observe(e, o, 0, 0)
        rows.append((step, o.contributor_id, o.observed_ns, {k: ("s", json.loads(v)) for k, v in o.attributes}))
    df = spark.createDataFrame(rows, f"point_id long, contributor_id string, observed_ns long, attributes {ids.ATTRIBUTES}")
    df = df.select("*", F.lit("service:one").alias("element_id"), F.lit("node").alias("kind"), F.lit("service").alias("type"), *[F.lit(None).cast("string").alias(c) for c in ("source_id", "target_id")])
    got = lc.merge_attributes(lc.latest(df)).first()
    assert {k: json.dumps(v.v) for k, v in got.attributes.items()} == merged(e.contributors)


def test_refused_steps(spark):
    g = tv.GraphClient(*fx.nation_graph(spark, "/root/testdata/sf0.001"))
    with pytest.raises(tv.UnsupportedStepError):
        g.g.V().timeLimit(5)
    with pytest.raises(tv.UnsupportedStepError):
        g.g.V().where(tv.__.timeLimit(5))
    with pytest.raises(tv.StepKindError):
        g.g.V().match(tv.__.out())
    with pytest.raises(tv.StepKindError):
        g.g.V().match(tv.__.as_("a").out().as_("b"), tv.__.as_("c").out().as_("a"))


def test_names_and_order(spark):
    g = tv.GraphClient(*fx.nation_graph(spark, "/root/testdata/sf0.001"))
    edges = [(r.source_id, r.target_id) for r in g.query(lambda g: g.E()).collect()]
    there = sorted((a, b) for a, b in edges if (b, a) in edges)
    got = g.g.V().match(tv.__.as_("a").out().as_("b"), tv.__.as_("b").out().as_("a")).select("a", "b")
    assert sorted(map(tuple, got.collect())) == there
    once = g.g.V("service:n1").as_("x").out().as_("y").out().as_("x", "z").select("x", "y", "z").collect()
    assert once and all(r.x == r.z and ("service:n1", r.y) in edges and (r.y, r.z) in edges for r in once)
    only = g.g.V().match(tv.__.as_("a").out().as_("b"), tv.__.as_("b").in_("queries")).select("a", "b").distinct().collect()
    queried = {r.target_id for r in g.query(lambda g: g.E().hasLabel("queries")).collect()}
    assert sorted(map(tuple, only)) == sorted((a, b) for a, b in edges if b in queried)
    rows = [(r.id, r.attributes["region"], r.attributes["name"]) for r in g.query(lambda g: g.V()).collect()]
    want = sorted(sorted(rows, key=lambda r: r[2]), key=lambda r: r[1], reverse=True)
    ordered = g.g.V().order().by("region", True).by("name")
    assert [r.id for r in ordered.rows.collect()] == [r[0] for r in want]
    assert [r.id for r in ordered.tail(4).rows.collect()] == [r[0] for r in want[-4:]]
    assert [r.id for r in ordered.limit(9).tail(2).rows.collect()] == [r[0] for r in want[7:9]]
    assert [r.id for r in g.g.V().tail(2).rows.collect()] == sorted(r[0] for r in rows)[-2:]


def test_traversal_rules(spark):
    g = tv.GraphClient(*fx.nation_graph(spark, "/root/testdata/sf0.001"))
    with pytest.raises(tv.MutationError):
        g.g.V().addE("x")
    with pytest.raises(tv.UnsupportedStepError):
        g.g.V().repeat()
    with pytest.raises(tv.StepKindError):
        g.g.V().inV()
    with pytest.raises(tv.StepKindError):
        g.g.out()
    with pytest.raises(tv.TraversalError):
        g.query(lambda t: 5)
    g.close()
    with pytest.raises(tv.ClosedClientError):
        g.query(lambda t: t.V())


def test_contract_is_checked_before_anything_is_applied(spark):
    row = ("3.0", "e", "graph_element_state_changed", "service:a", 1, "upsert", "h", "node", "nonsense", None, None, {}, 1)
    kinds = f"schema_version string, event_id string, event_type string, element_id string, observed_at_unix_nano long, operation string, payload_hash string, kind string, type string, source_id string, target_id string, attributes {ids.ATTRIBUTES}, seq int"
    with pytest.raises(pj.ContractError):
        pj.apply_batch(None, spark.createDataFrame([row], kinds))


def test_otlp_round_trip(spark):
    request = otlp.message()()
    metric = request.resource_metrics.add().scope_metrics.add().metrics.add(name=ev.INTERACTION)
    metric.sum.aggregation_temporality = 1
    p = metric.sum.data_points.add(time_unix_nano=9, as_int=2)
    for k, v in (("client", "a"), ("server", "b"), ("client", "c")):
        p.attributes.add(key=k).value.string_value = v
    p.attributes.add(key="client").value.bytes_value = b"x"
    df = spark.createDataFrame([(1, request.SerializeToString()), (2, bytes([0x0A, 5, 1]))], "payload_id long, value binary")
    points, bad = otlp.decode(df)
    row = points.first()
    assert (row.value, row.observed_ns, row.temporality) == (2.0, 9, "delta")
    assert {k: v.v for k, v in row.attributes.items()} == {"client": "c", "server": "b"}
    assert [r.reason for r in bad.collect()] == ["invalid_otlp_protobuf"]


def test_kafka_settings():
    with pytest.raises(kafka.ConfigError):
        kafka.Security(username="u").options()
    options = kafka.Security("SASL_SSL", "SCRAM-SHA-256", "u", 'p"\\').options()
    assert options["kafka.sasl.jaas.config"].endswith('username="u" password="p\\"\\\\";')
    with pytest.raises(kafka.ConfigError):
        kafka.EngineConfig(default_ttl_s=10, refresh_interval_s=10)
    with pytest.raises(kafka.ConfigError):
        kafka.EngineConfig(ttl_by_type=(("odd", 5),))


def test_strict_extraction_refuses_what_lenient_extraction_skips(spark):
    good = fx.attributes(service__name=fx.text("a"), k8s__node__uid=fx.text("n"))
    bad = fx.attributes(service__name=fx.text("a"), k8s__node__uid=fx.integer(F.lit(1)))
    short = fx.attributes(service__namespace=fx.text("x"), http__route=fx.text("/"))
    types = ["service", "k8s.node", "app.endpoint", "service.namespace"]
    found = lambda a: [e["id"] for e in spark.range(1).select(ev.extract_strict(a, types=types).alias("e")).first()["e"]]
    assert sorted(found(good)) == ["k8s.node:n", "service:a"]
    assert found(short) == ["service.namespace:x"]  # an endpoint's identity isn't whole: no error
    assert found(F.expr(ids.NO_ATTRIBUTES)) == []
    with pytest.raises(Exception, match="no valid k8s.node"):
        found(bad)


def test_pair_dimensions(spark):
    null = F.lit(None).cast(ids.ATTRIBUTES)
    columns = {
        "client_resource": fx.attributes(a__b=fx.text("resource")), "client_attributes": fx.attributes(a__b=fx.text("span"), c=fx.text("span"), d=fx.text("no")),
        "server_resource": null, "server_attributes": fx.attributes(c=fx.integer(F.lit(7))),
    }
    got = spark.range(1).withColumns(columns).select(up.pair_dimensions(["a.b", "c"]).alias("m")).first()["m"]
    assert {k: tuple(v) for k, v in got.items()} == {"client_a.b": ("s", "resource"), "client_c": ("s", "span"), "server_c": ("i", "7")}
    nothing = spark.range(1).withColumns(dict.fromkeys(columns, null)).select(up.pair_dimensions(["a.b"]).alias("m")).first()["m"]
    assert nothing == {}
