"""Source reputation from the whole history."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatlens.functions import scoring

BAD_LABELS = ["suspicious", "malicious"]
REPORT_SIZE = 10


def _has_label(label: str) -> Column:
    return F.col("threat_label") == label


def suspicious_events(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("threat_label").isin(BAD_LABELS))


def label_breakdown(logs: DataFrame) -> DataFrame:
    return logs.groupBy("source_ip", "log_type", "threat_label").agg(
        F.count("*").alias("count_by_label"),
        F.sum("bytes_transferred").alias("bytes_by_label"),
    )


def suspicious_by_ip_logtype(logs: DataFrame) -> DataFrame:
    return suspicious_events(logs).groupBy("source_ip", "log_type").agg(
        F.count("*").alias("total_events"),
        F.count_distinct("dest_ip").alias("unique_targets"),
        F.sum("bytes_transferred").alias("total_bytes"),
    )


def label_count_by_ip(logs: DataFrame, label: str) -> DataFrame:
    return logs.filter(_has_label(label)).groupBy("source_ip").agg(
        F.count("*").alias(f"{label}_count")
    )


def reputation(logs: DataFrame) -> DataFrame:
    """Every (source, log type) of the sources seen with both bad labels.

    One scan and one aggregate instead of three aggregates and two joins. The window
    only totals the few log types of a source, after aggregation.
    """
    per_source = Window.partitionBy("source_ip")
    malicious, suspicious = F.col("malicious_count"), F.col("suspicious_count")
    return (
        suspicious_events(logs)
        .groupBy("source_ip", "log_type")
        .agg(
            F.count("*").alias("total_events"),
            F.count_distinct("dest_ip").alias("unique_targets"),
            F.sum("bytes_transferred").alias("total_bytes"),
            F.count_if(_has_label("malicious")).alias("malicious_here"),
            F.count_if(_has_label("suspicious")).alias("suspicious_here"),
        )
        .withColumns({
            "malicious_count": F.sum("malicious_here").over(per_source),
            "suspicious_count": F.sum("suspicious_here").over(per_source),
        })
        .drop("malicious_here", "suspicious_here")
        .filter((malicious > 0) & (suspicious > 0))
        .withColumn("reputation_score", _score())
    )


def reputation_join(logs: DataFrame) -> DataFrame:
    """The same rows as `reputation`, written as two inner joins."""
    return (
        suspicious_by_ip_logtype(logs)
        .join(label_count_by_ip(logs, "malicious"), "source_ip")
        .join(label_count_by_ip(logs, "suspicious"), "source_ip")
        .withColumn("reputation_score", _score())
    )


def _score() -> Column:
    return scoring.reputation_score(
        F.col("malicious_count"), F.col("suspicious_count"), F.col("total_events")
    )


def top_malicious_ips(logs: DataFrame, size: int = REPORT_SIZE) -> DataFrame:
    """The busiest (source, log type) pairs; ties are broken by key."""
    return (
        reputation(logs)
        .orderBy(F.desc("total_events"), "source_ip", "log_type")
        .limit(size)
    )
