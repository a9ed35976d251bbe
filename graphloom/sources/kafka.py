"""Options and plans for evidence and event streams on Kafka; the connector's jar is the cluster's to provide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .events import records


# ---- fixed values: what brokers and clients agree on
PROTOCOLS = ("PLAINTEXT", "SASL_PLAINTEXT", "SASL_SSL")
MECHANISM = "SCRAM-SHA-256"
LOGIN = 'org.apache.kafka.common.security.scram.ScramLoginModule required username="{}" password="{}";'
# ---- end of fixed values


class ConfigError(ValueError):
    """Settings that contradict each other."""


@dataclass(frozen=True)
class Security:
    protocol: str = "PLAINTEXT"
    mechanism: str | None = None
    username: str | None = None
    password: str | None = None

    def options(self) -> dict[str, str]:
        """``kafka.*`` options; only SCRAM-SHA-256 over SASL, and no credentials in plain text."""
        if self.protocol not in PROTOCOLS:
            raise ConfigError(f"security protocol {self.protocol}")
        if self.protocol == "PLAINTEXT":
            if self.mechanism or self.username or self.password:
                raise ConfigError("credentials under PLAINTEXT")
            return {"kafka.security.protocol": "PLAINTEXT"}
        if self.mechanism != MECHANISM or not self.username or not self.password:
            raise ConfigError(f"SASL needs {MECHANISM}, a user name and a password")
        quoted = [x.replace("\\", "\\\\").replace('"', '\\"') for x in (self.username, self.password)]
        login = LOGIN.format(*quoted)
        return {"kafka.security.protocol": self.protocol, "kafka.sasl.mechanism": self.mechanism, "kafka.sasl.jaas.config": login}


@dataclass(frozen=True)
class EngineConfig:
    """Settings of the streaming job; validated when made."""

    default_ttl_s: int = 300
    ttl_by_type: tuple[tuple[str, int], ...] = ()
    refresh_interval_s: int = 0
    lateness_s: int = 60

    def __post_init__(self) -> None:
        from ..registry import default

        ttls = [self.default_ttl_s, *(v for _, v in self.ttl_by_type)]
        if min(ttls) <= 0 or self.refresh_interval_s < 0 or self.lateness_s < 0:
            raise ConfigError("times can't be negative, and time to live not zero")
        if self.refresh_interval_s and self.refresh_interval_s >= min(ttls):
            raise ConfigError("the refresh interval has to be less than every time to live")
        known = {*default().graph_types(), *default().edge_types()}
        if odd := {k for k, _ in self.ttl_by_type} - known:
            raise ConfigError(f"unknown types: {sorted(odd)}")


def evidence_stream(spark: SparkSession, servers: str, topic: str, security: Security | None = None) -> DataFrame:
    """Raw evidence payloads; committed offsets, or the earliest."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(startingOffsets="earliest", **(security or Security()).options()).load().select("value")


def event_stream(spark: SparkSession, servers: str, topic: str, security: Security | None = None) -> DataFrame:
    """Records of graph events with the offset that orders an element's; for :func:`events.index_stream`."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(startingOffsets="earliest", **(security or Security()).options()).load().select("value", "offset")


def event_sink(events: DataFrame, servers: str, topic: str, checkpoint: str, security: Security | None = None) -> object:
    """Start writing events, at least once."""
    writer = records(events).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.options(checkpointLocation=checkpoint, **(security or Security()).options()).start()
