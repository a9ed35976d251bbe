"""Evidence, spans and graphs made of the star-schema tables by fixed formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..operators.evidence import DISCOVERY, INTERACTION


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nanos(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp")) * 1000


def text(value: Column | str) -> Column:
    v = F.lit(value) if isinstance(value, str) else value
    return F.struct(F.lit("s").alias("t"), v.cast("string").alias("v"))


def integer(value: Column) -> Column:
    return F.struct(F.lit("i").alias("t"), value.cast("string").alias("v"))


def attributes(**values: Column) -> Column:
    """Attribute map; ``__`` in a name stands for a dot, null values are left out."""
    entries = F.array(*[F.struct(F.lit(k.replace("__", ".")).alias("key"), v.alias("value")) for k, v in sorted(values.items())])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"]["v"].isNotNull())).cast(ids.ATTRIBUTES)


#: Bytes of line items (as files) a partition of points: a task sorts what it makes of them in memory.
SHARE = 1 << 20


def interaction_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One service-graph datapoint per line item; some of each kind of fault.  They lie partitioned by ``server_key``."""
    supplier = read(spark, sf_dir, "supplier").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 20).alias("client_key"))
    line = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    # The join's output is cut into few partitions by its bytes, but what follows costs CPU time.  The line items are
    # shuffled, as points are many times as wide; all points of a server lie together, and so do most of its elements.
    share = int(str(items._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // SHARE
    line = line.repartition(max(4 * spark.sparkContext.defaultParallelism, share), "l_suppkey")
    line = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    point = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    line = line.withColumn("point_id", ((point * 1000 + F.col("l_partkey") % 1000) * 100 + F.col("l_suppkey") % 100) * 64 + F.col("l_quantity").cast("long"))
    connection = F.when(F.col("l_linenumber") == 7, "future_protocol").when(F.col("l_returnflag") == "A", "messaging_system").when(F.col("l_returnflag") == "R", "database")
    method = F.element_at(F.array(*map(F.lit, ("GET", "POST", "BREW"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    a = attributes(
        client=text(F.when(point % 107 == 0, "").otherwise(F.concat(F.lit("cust-"), F.col("client_key")))),
        server=text(F.concat(F.lit("supp-"), F.col("l_suppkey"))),
        connection_type=text(connection),
        client_service__version=text(F.concat(F.lit("v"), F.col("l_linenumber"))),
        server_service__namespace=text(F.col("n_name")),
        server_http__request__method=text(method),
        server_http__route=text(F.concat(F.lit("/part/"), F.col("l_partkey") % 5)),
    )
    return line.select(
        "point_id",
        F.col("point_id").alias("metric_id"),
        F.when(point % 13 == 0, "other_metric").otherwise(INTERACTION).alias("metric_name"),
        (point % 101 != 0).alias("is_sum"),
        F.when(point % 103 == 0, "cumulative").otherwise("delta").alias("temporality"),
        F.when(point % 97 == 0, 0.0).when(point % 89 == 0, -1.0).otherwise(F.col("l_quantity")).alias("value"),
        nanos("l_shipdate").alias("observed_ns"),
        a.alias("attributes"),
        F.col("l_suppkey").alias("server_key"),
    )


def discovery_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One discovery datapoint per event; each fifth has a span kind that no transaction may have."""
    e = read(spark, sf_dir, "events")
    i = F.col("event_id")
    kind = F.element_at(F.array(*map(F.lit, ("SPAN_KIND_INTERNAL", "SPAN_KIND_PRODUCER", "SPAN_KIND_CONSUMER", "SPAN_KIND_UNSPECIFIED", "SPAN_KIND_CLIENT"))), (i % 5 + 1).cast("int"))
    a = attributes(
        service__name=text(F.concat(F.lit("svc "), F.col("user_id"))),
        span__name=text(F.col("event_type")),
        span__kind=text(kind),
        etl__pipeline__id=text(F.when(i % 3 == 0, F.concat(F.lit("p"), i % 7))),
        etl__run__id=text(F.when(i % 6 == 0, F.concat(F.lit("r"), i % 11))),
        etl__part__run__id=text(F.when(i % 12 == 0, F.concat(F.lit("q"), i % 13))),
    )
    return e.select(
        i.alias("point_id"), i.alias("metric_id"), F.lit(DISCOVERY).alias("metric_name"), F.lit(True).alias("is_sum"), F.lit("delta").alias("temporality"),
        F.lit(1.0).alias("value"), nanos("ts").alias("observed_ns"), a.alias("attributes"),
    )


def shared_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datapoints whose two sides are the same service with different versions, one per order."""
    o = read(spark, sf_dir, "orders")
    name = F.concat(F.lit("svc-"), F.col("o_custkey") % 5)
    a = attributes(
        client=text(name),
        server=text(name),
        client_service__version=text(F.concat(F.lit("v"), F.col("o_custkey") % 11)),
        server_service__version=text(F.concat(F.lit("v"), F.col("o_orderkey") % 13)),
    )
    return o.select(
        F.col("o_orderkey").alias("point_id"), F.col("o_orderkey").alias("metric_id"), F.lit(INTERACTION).alias("metric_name"), F.lit(True).alias("is_sum"),
        F.lit("delta").alias("temporality"), F.lit(1.0).alias("value"), nanos("o_orderdate").alias("observed_ns"), a.alias("attributes"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trace per conversation, a span per turn; users are clients and assistants servers, 2 s apart."""
    c = read(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "CLIENT").when(F.col("role") == "assistant", "SERVER").otherwise("INTERNAL")
    return c.select(
        F.col("conv_id").cast("string").alias("trace_id"),
        F.col("turn").cast("string").alias("span_id"),
        F.when(F.col("turn") > 0, (F.col("turn") - 1).cast("string")).alias("parent_span_id"),
        kind.alias("kind"),
        F.concat(F.col("role"), F.lit("-"), F.col("conv_id") % 5).alias("service"),
        F.concat(F.lit("turn "), F.col("turn") % 3).alias("name"),
        F.timestamp_seconds(F.col("conv_id") * 7 + F.col("turn") * 2).alias("ts"),
        attributes(service__version=text(F.concat(F.lit("v"), F.col("conv_id") % 2))).alias("resource"),
        attributes(service__version=text(F.when(F.col("conv_id") % 3 == 0, "v1"))).alias("attributes"),
    )


def nation_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vertices are nations, edges where customers of one deal with another."""
    n = read(spark, sf_dir, "nation").join(F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    null = F.lit(None).cast("string")
    v = n.select(
        F.concat(F.lit("service:n"), F.col("n_nationkey")).alias("id"), F.lit("service").alias("label"), null.alias("source_id"), null.alias("target_id"),
        attributes(name=text(F.col("n_name")), region=text(F.col("r_name")), rank=integer(F.col("n_nationkey"))).alias("attributes"),
    )
    pair = read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("a"), ((F.col("c_custkey") % 40) * 7 % 25).alias("b"))
    pair = pair.where("a <> b").distinct()
    label = F.when((F.col("a") + F.col("b")) % 2 == 0, "calls").otherwise("queries")
    ends = pair.select(F.concat(F.lit("service:n"), F.col("a")).alias("source_id"), F.concat(F.lit("service:n"), F.col("b")).alias("target_id"), label.alias("label"))
    e = ends.select(ids.edge_id(F.col("source_id"), F.col("label"), F.col("target_id")).alias("id"), "label", "source_id", "target_id", F.expr(ids.NO_ATTRIBUTES).alias("attributes"))
    return v, e
