"""What a collector does with spans before evidence: pairing, root filter, counts, cumulative to delta."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import ids


def pair_spans(spans: DataFrame, ttl_seconds: int = 10) -> DataFrame:
    """Client spans with the server span they are the parent of, within a trace and ``ttl_seconds`` of each other.

    Works on batches, and on streams whose ``ts`` has a watermark (a stream-stream interval join).
    """
    c = spans.where(F.col("kind") == "CLIENT").select(*[F.col(x).alias("client_" + x) for x in spans.columns])
    s = spans.where(F.col("kind") == "SERVER").select(*[F.col(x).alias("server_" + x) for x in spans.columns])
    near = F.expr(f"server_ts BETWEEN client_ts - INTERVAL {ttl_seconds} SECONDS AND client_ts + INTERVAL {ttl_seconds} SECONDS")
    return c.join(s, (c["client_trace_id"] == s["server_trace_id"]) & (s["server_parent_span_id"] == c["client_span_id"]) & near)


def pair_dimensions(names: list[str], resource: str = "resource", attributes: str = "attributes") -> Column:
    """Attribute map of a pair's dimensions, named ``client_...`` and ``server_...``: of each side the attributes
    ``names`` lists, the resource's value before the span's.  A null map counts as empty."""
    empty = F.expr(ids.NO_ATTRIBUTES)

    def of(side: str) -> Column:
        listed = [F.map_filter(F.coalesce(F.col(f"{side}_{m}"), empty), lambda k, _: k.isin(*names)) for m in (resource, attributes)]
        both = F.map_zip_with(*listed, lambda _, r, a: F.coalesce(r, a))
        return F.transform_keys(both, lambda k, _: F.concat(F.lit(side + "_"), k))

    return F.map_concat(of("client"), of("server"))


def edge_counts(pairs: DataFrame, *dimensions: str, window: str | None = None) -> DataFrame:
    """Requests per client and server service (and dimensions, and window)."""
    keys: list[Column | str] = [F.col("client_service").alias("client"), F.col("server_service").alias("server"), *dimensions]
    if window:
        keys.append(F.window("client_ts", window))
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("requests"))


def cumulative_to_delta(points: DataFrame, series: list[str], order: str = "observed_ns", value: str = "value") -> DataFrame:
    """Difference to the point before in a series; the first counts from zero, as does one below the last (a reset). Zeros go."""
    before = F.lag(value).over(W.partitionBy(*series).orderBy(order))
    delta = F.when(before.isNull() | (F.col(value) < before), F.col(value)).otherwise(F.col(value) - before)
    return points.withColumn("delta", delta).where("delta <> 0")


def root_spans(spans: DataFrame, modelled: list[str], resource: str = "resource", attributes: str = "attributes") -> DataFrame:
    """Roots that are neither client nor server and whose resource and span agree on modelled attributes."""
    get = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    clash = F.lit(False)
    for k in modelled:
        clash |= F.coalesce(get(resource, k) != get(attributes, k), F.lit(False))
    return spans.where(F.col("parent_span_id").isNull() & ~F.col("kind").isin("CLIENT", "SERVER") & ~clash)


def root_span_metrics(roots: DataFrame, *dimensions: str, window: str = "60 seconds") -> DataFrame:
    """Calls per service, span name, kind (and dimensions) in each flush window."""
    at = F.window("ts", window)
    return roots.groupBy(at.alias("w"), "service", "name", "kind", *dimensions).agg(F.count(F.lit(1)).alias("calls"))


def route(spans: DataFrame, n: int, *keys: str) -> DataFrame:
    """All spans of a trace (or of the keys given) to one of ``n`` partitions."""
    return spans.repartition(n, *(keys or ("trace_id",)))
