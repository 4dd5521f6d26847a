"""Presentation of alerts as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from threatlens.functions.times import date_key

# Labels per alert type, the types drawn in the distribution, size units.
MISSING = "—"
ALERT_LABELS = {
    "BRUTE_FORCE": "🔑 Brute Force",
    "SQLI_DETECTED": "💉 SQL Injection",
    "XSS_DETECTED": "🕷️ XSS",
    "LFI_DETECTED": "📁 LFI",
    "KNOWN_ATTACK_TOOL": "🛠️ Outil Malveillant",
    "VOLUME_ANOMALY": "📈 Anomalie Volume",
    "PORT_SCAN": "🔍 Port Scan",
    "SIGNATURE_MATCH": "⚠️ Signature",
}
CHARTED_TYPES = [
    "BRUTE_FORCE", "SQLI_DETECTED", "PORT_SCAN", "KNOWN_ATTACK_TOOL", "VOLUME_ANOMALY",
]
UNITS = [("GB", 1024**3), ("MB", 1024**2), ("KB", 1024)]


def alert_label(alert_type: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in ALERT_LABELS.items() for x in pair])
    named = F.coalesce(F.try_element_at(labels, alert_type), alert_type)
    return F.when(named == "", MISSING).otherwise(F.coalesce(named, F.lit(MISSING)))


def score_band(score: Column) -> Column:
    return (
        F.when(score >= 80, "critical")
        .when(score >= 60, "high")
        .when(score >= 40, "medium")
        .otherwise("low")
    )


def readable_bytes(size: Column) -> Column:
    """One decimal, rounded half up. Integer steps, because the quotients can tie."""
    shown = F.when(size.isNull() | (size == 0), "0 B")
    for unit, factor in UNITS:
        rest = size % factor
        tenths = F.floor(size / factor) * 10 + F.floor((rest * 20 + factor) / (2 * factor))
        text = F.concat_ws("", F.floor(tenths / 10), F.lit("."), tenths % 10, F.lit(f" {unit}"))
        shown = shown.when(size >= factor, text)
    return shown.otherwise(F.concat_ws("", size, F.lit(".0 B")))


def clock_time(moment: Column) -> Column:
    return F.coalesce(F.substring(moment.cast("string"), 12, 8), F.lit(MISSING))


def hour_label(moment: Column) -> Column:
    return F.concat_ws("", date_key(moment), F.lit(" "), F.hour(moment), F.lit("h"))
