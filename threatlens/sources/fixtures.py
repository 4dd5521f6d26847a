"""The security-log view over the events table (FIXTURES.md, section 4)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlens.functions.times import EPOCH
from threatlens.schema import LOG_COLUMNS, LOG_MESSAGE

FIRST_EVENT = "TIMESTAMP_NTZ'2023-10-15 00:00:00'"


def security_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per event: `log_id` and the ten log columns.

    Projections only, so column pruning reaches the Parquet scan: a query that
    never reads bytes does not read `value`.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.selectExpr(
        "event_id AS e",
        "user_id AS u",
        "event_type AS et",
        "value AS v",
        f"{FIRST_EVENT} + INTERVAL '1' SECOND * event_id AS ts",
        "(event_id * 7919 + user_id * 104729) % 1000 AS h",
        "(event_id DIV 300) % 4 AS phase",
    ).withColumn(
        "k",
        F.expr(
            "CASE WHEN phase = 1 AND h < 600 THEN 0 WHEN phase = 1 AND h < 800 THEN 1"
            " WHEN phase <> 1 AND h < 200 THEN 0 WHEN phase <> 1 AND h < 320 THEN 1"
            " WHEN h >= 900 THEN 2 ELSE 9 END"
        ),
    )
    return base.selectExpr(
        "e AS log_id",
        "ts AS timestamp",
        "CASE WHEN k < 9 THEN concat('203.0.113.', k)"
        " ELSE concat('10.0.', u DIV 256, '.', u % 256) END AS source_ip",
        "concat('192.168.', h % 4, '.', e % 251) AS dest_ip",
        "CASE WHEN k = 0 THEN 'TCP' ELSE elt(CAST(h % 4 AS INT) + 1, 'TCP', 'HTTP', 'SSH', 'UDP') END AS protocol",
        "CASE WHEN k = 1 OR et = 'error' THEN 'blocked' ELSE 'allowed' END AS action",
        "CASE WHEN h % 10 < 3 THEN 'malicious' WHEN h % 10 < 5 THEN 'suspicious'"
        " ELSE 'benign' END AS threat_label",
        "elt(CAST(h % 3 AS INT) + 1, 'firewall', 'ids', 'application') AS log_type",
        "CASE WHEN h % 41 = 0 THEN NULL WHEN k = 2 THEN 2097152 * (1 + e % 97)"
        " ELSE CAST(floor(v * 100) AS BIGINT) END AS bytes_transferred",
        "CASE h % 50 WHEN 0 THEN 'sqlmap/1.7.8#stable' WHEN 1 THEN 'Nikto/2.1.6'"
        " WHEN 2 THEN 'nmap/7.94 scripting engine' WHEN 3 THEN 'hydra/9.4' WHEN 4 THEN NULL"
        " ELSE 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/118.0' END AS user_agent",
        r"CASE h % 53 WHEN 0 THEN '/product.php?id=1\' OR \'1\'=\'1'"
        " WHEN 1 THEN '/product?id=1 UNION SELECT username,password FROM users--'"
        " WHEN 2 THEN '/search?q=<script>alert(document.cookie)</script>'"
        " WHEN 3 THEN '/download?f=../../etc/passwd' WHEN 4 THEN '/x?p=%2E%2E%2Fsecret'"
        " WHEN 5 THEN '/q?s=DELETE FROM logs' WHEN 6 THEN '/img?onload=x'"
        " WHEN 7 THEN '/f?p=/proc/self/environ' WHEN 8 THEN NULL"
        " ELSE '/index.html' END AS request_path",
    )


# The demonstration scenario, minus its time stamps
# (repeat, source_ip, dest_ip, protocol, action, label, log_type, bytes, agent, path).
SCENARIO = [
    (8, "10.10.10.1", "192.168.0.10", "HTTP", "blocked", "malicious", "firewall",
     512, "hydra/9.4", "/admin/login"),
    (1, "10.20.30.40", "192.168.0.20", "HTTP", "blocked", "malicious", "ids",
     2048, "sqlmap/1.7.8#stable", "/product.php?id=1' OR '1'='1"),
    (1, "172.16.0.5", "8.8.8.8", "TCP", "allowed", "suspicious", "firewall",
     15728640, "", "/data/export"),
]


def with_hourly_scenario(logs: DataFrame) -> DataFrame:
    """The logs with the demonstration attack replayed at the start of every hour they cover."""
    attack = F.array(*[
        F.struct(*[
            F.lit(value).cast(LOG_MESSAGE[name].dataType).alias(name)
            for name, value in zip(LOG_COLUMNS[1:], row[1:])
        ])
        for row in SCENARIO
        for _ in range(row[0])
    ])
    # Negative ids keep the injected rows apart from the logged ones.
    hour_number = F.expr(f"CAST(CAST(timestamp - {EPOCH} AS INTERVAL HOUR) AS BIGINT)")
    replay = (
        logs.groupBy(F.window("timestamp", "1 hour"))
        .count()
        .select(F.col("window.start").alias("timestamp"), F.posexplode(attack).alias("step", "row"))
        .select((-(hour_number * 100 + F.col("step"))).alias("log_id"), "timestamp", "row.*")
    )
    return logs.unionByName(replay)
