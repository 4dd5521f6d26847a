"""Threat profiles: history and live alerts of every source in one plan."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.functions import scoring
from threatlens.operators.alerts import alert_summary_by_ip
from threatlens.sinks.keyed_tables import read_key

# Attack types a profile lists, in this order; longest accepted address.
KNOWN_ATTACK_TYPES = ["PORT_SCAN", "SQLI", "XSS", "LFI", "TOOL_DETECTED", "BRUTE_FORCE"]
MAX_ADDRESS_LENGTH = 45
CONTROL_OR_BLANK = r"^[\x00-\x20]+|[\x00-\x20]+$"


def ip_attack_types(patterns: DataFrame) -> DataFrame:
    """The known attack types of each source, in the fixed order.

    One boolean per type instead of a collected set: it aggregates in place.
    """
    seen = [F.bool_or(F.col("attack_type") == t).alias(t) for t in KNOWN_ATTACK_TYPES]
    listed = F.array_compact(F.array(*[F.when(F.col(t), F.lit(t)) for t in KNOWN_ATTACK_TYPES]))
    return (
        patterns.filter(F.col("attack_type").isin(KNOWN_ATTACK_TYPES))
        .groupBy("source_ip")
        .agg(*seen)
        .select("source_ip", listed.alias("attack_types"))
    )


def global_stats(reputation_table: DataFrame) -> DataFrame:
    return reputation_table.agg(
        F.count("*").alias("total_ips_analyzed"),
        F.count_if(F.col("score") > scoring.HIGH_RISK_SCORE).alias("high_risk_ips"),
    )


def _asked(side: DataFrame, key: str, keys: DataFrame | str | None) -> DataFrame:
    """The rows of a side that belong to the asked addresses: a column `ip`, or one address."""
    if keys is None:
        return side
    if isinstance(keys, str):
        return side.filter(F.col(key) == keys)
    return side.join(keys.select(F.col("ip").alias(key)), key, "left_semi")


def threat_profile_flat(
    reputation_table: DataFrame,
    pattern_table: DataFrame,
    alerts: DataFrame,
    keys: DataFrame | str | None = None,
) -> DataFrame:
    """One row per source known to any side; a missing side reads as empty.

    All three sides are aggregated by source, so the full joins meet one row per key
    and reuse the partitioning of the aggregates. With `keys` every side is first cut to
    the asked addresses; one address becomes a filter that reaches the files.
    """
    history, types, live = _sides(
        _asked(reputation_table, "source_ip", keys),
        _asked(pattern_table, "source_ip", keys),
        alert_summary_by_ip(_asked(alerts, "ip_source", keys)),
    )
    return _completed(history.join(types, "ip", "full").join(live, "ip", "full"))


def _sides(reputation_table: DataFrame, pattern_table: DataFrame, summaries: DataFrame) -> list[DataFrame]:
    """History, attack types and live summary, one row per `ip` each."""
    return [
        reputation_table.select(
            F.col("source_ip").alias("ip"),
            F.col("score").alias("reputation_score"),
            F.col("total_events").alias("total_historical_events"),
            F.col("last_seen").alias("last_batch_update"),
        ),
        ip_attack_types(pattern_table).select(
            F.col("source_ip").alias("ip"), F.col("attack_types").alias("attack_types_detected")
        ),
        summaries.withColumnRenamed("ip_source", "ip"),
    ]


def profile_of(spark: SparkSession, address: str, reputation: str, patterns: str, live: str) -> DataFrame:
    """The profile of one address from the stored keyed tables; an unknown one is empty.

    Each table is clustered by address: one part of each is read, and nothing is shuffled.
    `live` holds the summaries that `store_live_state` keeps. An unacceptable address gives
    no row.
    """
    address = re.sub(CONTROL_OR_BLANK, "", address or "") if len(address or "") <= MAX_ADDRESS_LENGTH else ""
    sides = _sides(
        read_key(spark, reputation, source_ip=address),
        read_key(spark, patterns, source_ip=address),
        read_key(spark, live, ip_source=address).filter("active_alerts > 0"),
    )
    # A row per side, one partition: their maximum is the profile.
    rows = [
        side.select(*[F.struct(side.columns).alias("side") if other is side else F.lit(None).alias("side") for other in sides])
        .toDF("history", "types", "live")
        for side in sides
    ]
    united = rows[0].union(rows[1]).union(rows[2]).coalesce(1)
    found = united.agg(*[F.max(c).alias(c) for c in united.columns])
    known = found.select("history.*", "types.*", "live.*").drop("ip").withColumn("ip", F.lit(address))
    return _completed(known.filter(F.lit(bool(address))))


def _completed(joined: DataFrame) -> DataFrame:
    no_types = F.array().cast("array<string>")
    filled = joined.select(
        "ip",
        F.coalesce("reputation_score", F.lit(0)).cast("bigint").alias("reputation_score"),
        F.coalesce("total_historical_events", F.lit(0)).cast("bigint").alias("total_historical_events"),
        F.coalesce("attack_types_detected", no_types).alias("attack_types_detected"),
        "last_batch_update",
        F.coalesce("active_alerts", F.lit(0)).alias("active_alerts"),
        "last_seen",
        F.coalesce("current_threat_score", F.lit(0)).alias("current_threat_score"),
        F.coalesce("recent_attack_types", no_types).alias("recent_attack_types"),
        F.coalesce("recent_alert_bytes", F.lit(0)).cast("bigint").alias("recent_alert_bytes"),
    )
    history, live = F.col("reputation_score"), F.col("current_threat_score")
    return filled.withColumns({
        "recommendation": scoring.recommendation(history, F.col("active_alerts")),
        "confidence": scoring.confidence(history, live),
    })


def threat_profile(flat: DataFrame) -> DataFrame:
    """The profile with its two layers as structs."""
    return flat.select(
        "ip",
        F.struct(
            "reputation_score",
            "total_historical_events",
            "attack_types_detected",
            F.lit(None).cast("timestamp_ntz").alias("first_seen"),
            "last_batch_update",
        ).alias("batch_layer"),
        F.struct(
            "active_alerts",
            "last_seen",
            "current_threat_score",
            "recent_attack_types",
            "recent_alert_bytes",
        ).alias("speed_layer"),
        "recommendation",
        "confidence",
    )


def threat_profile_json(flat: DataFrame) -> DataFrame:
    """The profile with its two layers as JSON text, stamps as yyyy-MM-dd HH:mm:ss."""
    form = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    layers = {c: F.to_json(c, form) for c in ("batch_layer", "speed_layer")}
    return threat_profile(flat).withColumns(layers)


def valid_addresses(requests: DataFrame) -> DataFrame:
    """The requested addresses that are acceptable, trimmed, once each."""
    trimmed = F.regexp_replace("ip", CONTROL_OR_BLANK, "")
    return (
        requests.filter((F.length("ip") <= MAX_ADDRESS_LENGTH) & (trimmed != ""))
        .select(trimmed.alias("ip"))
        .distinct()
    )


def profile_lookup(
    requests: DataFrame, reputation_table: DataFrame, pattern_table: DataFrame, alerts: DataFrame
) -> DataFrame:
    """Profiles of the requested addresses; an unknown address gets an empty profile."""
    asked = valid_addresses(requests)
    known = threat_profile_flat(reputation_table, pattern_table, alerts, asked)
    return _completed(asked.join(known, "ip", "left"))
