"""Scores, severities and decisions as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Detection thresholds (all strict) and severity steps.
PORT_SCAN_TARGETS = 20
PORT_SCAN_HIGH = 50
PORT_SCAN_CRITICAL = 100
BRUTE_FORCE_ATTEMPTS = 5
BRUTE_FORCE_CRITICAL = 10
MEBIBYTE = 1024 * 1024
VOLUME_BYTES = 10 * MEBIBYTE
VOLUME_CRITICAL = 100 * MEBIBYTE
HIGH_RISK_SCORE = 70


def capped(score: Column) -> Column:
    return F.least(F.lit(100), score)


def reputation_score(malicious: Column, suspicious: Column, total: Column) -> Column:
    weight = malicious * 10 + suspicious * 5
    return capped((weight / total * 100).cast("bigint"))


def port_scan_score(targets: Column) -> Column:
    return capped(60 + targets - PORT_SCAN_TARGETS).cast("int")


def port_scan_severity(targets: Column) -> Column:
    return (
        F.when(targets > PORT_SCAN_CRITICAL, "CRITICAL")
        .when(targets > PORT_SCAN_HIGH, "HIGH")
        .otherwise("MEDIUM")
    )


def brute_force_score(attempts: Column) -> Column:
    return capped(70 + (attempts - BRUTE_FORCE_ATTEMPTS) * 2).cast("int")


def brute_force_severity(attempts: Column) -> Column:
    return F.when(attempts > BRUTE_FORCE_CRITICAL, "CRITICAL").otherwise("HIGH")


def volume_score(total_bytes: Column) -> Column:
    magnitude = F.log(10.0, total_bytes / F.lit(float(MEBIBYTE)))
    return capped((80 + magnitude * 5).cast("int"))


def volume_severity(total_bytes: Column) -> Column:
    return F.when(total_bytes > VOLUME_CRITICAL, "CRITICAL").otherwise("HIGH")


def recommendation(history_score: Column, active_alerts: Column) -> Column:
    return (
        F.when((history_score > 80) & (active_alerts >= 1), "BLOCK")
        .when((history_score >= 50) | (active_alerts > 0), "MONITOR")
        .otherwise("ALLOW")
    )


def confidence(history_score: Column, live_score: Column) -> Column:
    """min(1, round(0.4 h + 0.6 l) / 100), rounded in integers to avoid float ties."""
    tenths = history_score.cast("bigint") * 4 + live_score.cast("bigint") * 6
    return F.least(F.lit(1.0), F.floor((tenths + 5) / 10) / 100.0)
