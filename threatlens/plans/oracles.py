"""The same queries in DuckDB SQL, over the same tables."""

# Each SQL names the common table expressions it needs; they are emitted in this order.
VIEWS = {
    "b": """
        SELECT event_id AS e, user_id AS u, event_type AS et, value AS v,
          TIMESTAMP '2023-10-15 00:00:00' + to_seconds(event_id) AS ts,
          (event_id * 7919 + user_id * 104729) % 1000 AS h,
          CAST((event_id - event_id % 300) / 300 AS BIGINT) % 4 AS phase
        FROM events""",
    "a": """
        SELECT *, CASE WHEN phase = 1 AND h < 600 THEN 0 WHEN phase = 1 AND h < 800 THEN 1
          WHEN phase <> 1 AND h < 200 THEN 0 WHEN phase <> 1 AND h < 320 THEN 1
          WHEN h >= 900 THEN 2 ELSE 9 END AS k FROM b""",
    "security_logs": """
        SELECT e AS log_id, ts AS "timestamp",
          CASE WHEN k < 9 THEN concat('203.0.113.', CAST(k AS VARCHAR))
            ELSE concat('10.0.', CAST(CAST((u - u % 256) / 256 AS BIGINT) AS VARCHAR), '.',
              CAST(u % 256 AS VARCHAR)) END AS source_ip,
          concat('192.168.', CAST(h % 4 AS VARCHAR), '.', CAST(e % 251 AS VARCHAR)) AS dest_ip,
          CASE WHEN k = 0 THEN 'TCP' WHEN h % 4 = 0 THEN 'TCP' WHEN h % 4 = 1 THEN 'HTTP'
            WHEN h % 4 = 2 THEN 'SSH' ELSE 'UDP' END AS protocol,
          CASE WHEN k = 1 OR et = 'error' THEN 'blocked' ELSE 'allowed' END AS action,
          CASE WHEN h % 10 < 3 THEN 'malicious' WHEN h % 10 < 5 THEN 'suspicious'
            ELSE 'benign' END AS threat_label,
          CASE WHEN h % 3 = 0 THEN 'firewall' WHEN h % 3 = 1 THEN 'ids'
            ELSE 'application' END AS log_type,
          CASE WHEN h % 41 = 0 THEN NULL WHEN k = 2 THEN 2097152 * (1 + e % 97)
            ELSE CAST(floor(v * 100) AS BIGINT) END AS bytes_transferred,
          CASE h % 50 WHEN 0 THEN 'sqlmap/1.7.8#stable' WHEN 1 THEN 'Nikto/2.1.6'
            WHEN 2 THEN 'nmap/7.94 scripting engine' WHEN 3 THEN 'hydra/9.4' WHEN 4 THEN NULL
            ELSE 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/118.0' END AS user_agent,
          CASE h % 53 WHEN 0 THEN '/product.php?id=1'' OR ''1''=''1'
            WHEN 1 THEN '/product?id=1 UNION SELECT username,password FROM users--'
            WHEN 2 THEN '/search?q=<script>alert(document.cookie)</script>'
            WHEN 3 THEN '/download?f=../../etc/passwd' WHEN 4 THEN '/x?p=%2E%2E%2Fsecret'
            WHEN 5 THEN '/q?s=DELETE FROM logs' WHEN 6 THEN '/img?onload=x'
            WHEN 7 THEN '/f?p=/proc/self/environ' WHEN 8 THEN NULL
            ELSE '/index.html' END AS request_path
        FROM a""",
    "moment": """SELECT max("timestamp") AS as_of FROM security_logs""",
    "scenario": """
        SELECT * FROM (VALUES
          (0, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (1, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (2, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (3, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (4, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (5, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (6, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (7, '10.10.10.1', '192.168.0.10', 'HTTP', 'blocked', 'malicious', 'firewall', 512, 'hydra/9.4', '/admin/login'),
          (8, '10.20.30.40', '192.168.0.20', 'HTTP', 'blocked', 'malicious', 'ids', 2048, 'sqlmap/1.7.8#stable', '/product.php?id=1'' OR ''1''=''1'),
          (9, '172.16.0.5', '8.8.8.8', 'TCP', 'allowed', 'suspicious', 'firewall', 15728640, '', '/data/export')
        ) AS s(step, source_ip, dest_ip, protocol, action, threat_label, log_type,
               bytes_transferred, user_agent, request_path)""",
    # `logs` is what the detectors read; scenario_alerts redefines it.
    "logs": "SELECT * FROM security_logs",
    "flagged": r"""
        SELECT *,
          regexp_matches(user_agent, '(?i)(sqlmap|nikto|nmap|masscan|burpsuite|dirbuster|hydra|metasploit|w3af|acunetix|openvas)') AS is_tool,
          regexp_matches(request_path, '(?i)(''\s+OR|UNION\s+SELECT|1=1--|DROP\s+TABLE|xp_cmdshell|EXEC\(|INSERT\s+INTO|DELETE\s+FROM)') AS is_sqli,
          regexp_matches(request_path, '(?i)(<script|javascript:|onerror=|alert\(|document\.cookie|eval\(|onload=)') AS is_xss,
          regexp_matches(request_path, '(?i)(\.\./\.\./|/etc/passwd|/etc/shadow|/proc/self|%2e%2e%2f)') AS is_lfi
        FROM logs""",
    "patterns": """
        SELECT *,
          CASE WHEN is_tool THEN 'TOOL_DETECTED' WHEN is_sqli THEN 'SQLI' WHEN is_xss THEN 'XSS'
            WHEN is_lfi THEN 'LFI' ELSE 'UNKNOWN' END AS attack_category,
          CAST(CASE WHEN is_tool THEN 95 WHEN is_sqli THEN 85 WHEN is_xss THEN 75
            WHEN is_lfi THEN 70 ELSE 60 END AS INTEGER) AS threat_score,
          'CRITICAL' AS severity
        FROM flagged WHERE is_tool OR is_sqli OR is_xss OR is_lfi""",
    "live_flagged": r"""
        SELECT *,
          regexp_matches(user_agent, '(?i)(sqlmap|nikto|nmap|masscan|burpsuite|dirbuster|hydra|metasploit|w3af|acunetix|openvas)') AS is_tool,
          regexp_matches(request_path, '(?i)(''\s+OR|UNION\s+SELECT|1=1--|DROP\s+TABLE|xp_cmdshell|EXEC\(|INSERT\s+INTO)') AS is_sqli,
          regexp_matches(request_path, '(?i)(<script|javascript:|onerror=|alert\(|document\.cookie|eval\()') AS is_xss,
          regexp_matches(request_path, '(?i)(\.\./\.\./|/etc/passwd|/etc/shadow|%2e%2e%2f)') AS is_lfi
        FROM logs""",
    "signatures": """
        SELECT log_id, "timestamp", source_ip, dest_ip, protocol, action, threat_label, log_type,
          bytes_transferred, user_agent, request_path,
          CASE WHEN is_tool THEN 'KNOWN_ATTACK_TOOL' WHEN is_sqli THEN 'SQLI_DETECTED'
            WHEN is_xss THEN 'XSS_DETECTED' WHEN is_lfi THEN 'LFI_DETECTED'
            ELSE 'SIGNATURE_MATCH' END AS alert_type,
          CAST(CASE WHEN is_tool THEN 95 WHEN is_sqli THEN 85 WHEN is_xss THEN 75
            WHEN is_lfi THEN 70 ELSE 60 END AS INTEGER) AS threat_score,
          'CRITICAL' AS severity, CAST(1 AS INTEGER) AS event_count,
          bytes_transferred AS bytes_total
        FROM live_flagged WHERE is_tool OR is_sqli OR is_xss OR is_lfi""",
    "scans": """
        SELECT source_ip, distinct_targets, event_count, last_event, log_type,
          'PORT_SCAN' AS attack_type,
          CAST(least(100, 60 + distinct_targets - 20) AS INTEGER) AS threat_score,
          CASE WHEN distinct_targets > 100 THEN 'CRITICAL' WHEN distinct_targets > 50 THEN 'HIGH'
            ELSE 'MEDIUM' END AS severity,
          w AS window_start, w + INTERVAL 5 MINUTE AS window_end
        FROM (
          SELECT source_ip, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w,
            count(DISTINCT dest_ip) AS distinct_targets, count(*) AS event_count,
            max("timestamp") AS last_event, first(log_type ORDER BY "timestamp", log_type) AS log_type
          FROM logs WHERE protocol = 'TCP' GROUP BY 1, 2)
        WHERE distinct_targets > 20""",
    "brute": """
        SELECT source_ip, blocked_count, bytes_total, last_event, user_agent, log_type,
          CAST(least(100, 70 + 2 * (blocked_count - 5)) AS INTEGER) AS threat_score,
          CASE WHEN blocked_count > 10 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
          'BRUTE_FORCE' AS alert_type, blocked_count AS event_count,
          w AS window_start, w + INTERVAL 1 MINUTE AS window_end
        FROM (
          SELECT source_ip, time_bucket(INTERVAL 1 MINUTE, "timestamp") AS w,
            count(*) AS blocked_count, CAST(sum(bytes_transferred) AS BIGINT) AS bytes_total,
            max("timestamp") AS last_event,
            first(user_agent ORDER BY "timestamp", user_agent NULLS FIRST, log_type) AS user_agent,
            first(log_type ORDER BY "timestamp", user_agent NULLS FIRST, log_type) AS log_type
          FROM logs WHERE action = 'blocked' GROUP BY 1, 2)
        WHERE blocked_count > 5""",
    "bursts": """
        SELECT source_ip, bytes_total, event_count, last_event, log_type, user_agent, dest_ip,
          'VOLUME_ANOMALY' AS alert_type,
          least(100, CAST(trunc(80 + ln(bytes_total / 1048576.0::DOUBLE) / ln(10.0::DOUBLE) * 5)
            AS INTEGER)) AS threat_score,
          CASE WHEN bytes_total > 104857600 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
          w AS window_start, w + INTERVAL 10 SECOND AS window_end
        FROM (
          SELECT source_ip, time_bucket(INTERVAL 10 SECOND, "timestamp") AS w,
            CAST(sum(bytes_transferred) AS BIGINT) AS bytes_total, count(*) AS event_count,
            max("timestamp") AS last_event,
            first(log_type ORDER BY "timestamp", log_type, user_agent NULLS FIRST, dest_ip) AS log_type,
            first(user_agent ORDER BY "timestamp", log_type, user_agent NULLS FIRST, dest_ip) AS user_agent,
            first(dest_ip ORDER BY "timestamp", log_type, user_agent NULLS FIRST, dest_ip) AS dest_ip
          FROM logs GROUP BY 1, 2)
        WHERE bytes_total > 10485760""",
    "detections": """
        SELECT source_ip, window_start AS bucket_time, last_event AS last_seen, threat_score,
          alert_type, severity, event_count, bytes_total, user_agent, log_type, NULL AS row_identity
        FROM brute
        UNION ALL SELECT source_ip, "timestamp", "timestamp", threat_score, alert_type, severity,
          event_count, bytes_total, user_agent, log_type, CAST(log_id AS VARCHAR) FROM signatures
        UNION ALL SELECT source_ip, window_start, last_event, threat_score, alert_type, severity,
          event_count, bytes_total, user_agent, log_type, NULL FROM bursts
        UNION ALL SELECT source_ip, window_start, last_event, threat_score, attack_type, severity,
          event_count, NULL, NULL, log_type, NULL FROM scans""",
    "all_alerts": """
        SELECT source_ip AS ip_source, bucket_time,
          sha256(concat_ws('|', alert_type, source_ip, CAST(bucket_time AS VARCHAR), row_identity)) AS alert_id,
          last_seen, threat_score, alert_type AS attack_types, alert_type, severity, event_count,
          coalesce(bytes_total, 0) AS bytes_total, coalesce(user_agent, 'unknown') AS user_agents,
          coalesce(log_type, 'unknown') AS log_sources
        FROM detections""",
    "alerts": """
        SELECT all_alerts.* FROM all_alerts, moment
        WHERE last_seen > as_of - INTERVAL 24 HOUR""",
    "recent": """
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ip_source
          ORDER BY bucket_time DESC, alert_id) AS INTEGER) AS recency FROM alerts) WHERE recency <= 10""",
    "recent_types": """
        SELECT ip_source, string_agg(alert_type, ',' ORDER BY first_seen) AS recent_attack_types
        FROM (SELECT ip_source, alert_type, min(recency) AS first_seen FROM recent GROUP BY 1, 2)
        GROUP BY 1""",
    "summary": """
        SELECT ip_source, active_alerts, current_threat_score, recent_alert_bytes,
          recent_attack_types, last_seen
        FROM (SELECT ip_source, CAST(count(*) AS INTEGER) AS active_alerts,
            max(threat_score) AS current_threat_score,
            CAST(sum(bytes_total) AS BIGINT) AS recent_alert_bytes,
            max(last_seen) FILTER (recency = 1) AS last_seen
          FROM recent GROUP BY 1) JOIN recent_types USING (ip_source)""",
    "bad": """SELECT * FROM security_logs WHERE threat_label IN ('suspicious', 'malicious')""",
    "reputation": """
        SELECT source_ip, log_type, total_events, unique_targets, total_bytes, malicious_count,
          suspicious_count,
          least(100, CAST(trunc((malicious_count * 10 + suspicious_count * 5)
            / CAST(total_events AS DOUBLE) * 100) AS BIGINT)) AS reputation_score
        FROM (SELECT source_ip, log_type, count(*) AS total_events,
            count(DISTINCT dest_ip) AS unique_targets,
            CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes FROM bad GROUP BY 1, 2)
        JOIN (SELECT source_ip, count(*) AS malicious_count FROM security_logs
          WHERE threat_label = 'malicious' GROUP BY 1) USING (source_ip)
        JOIN (SELECT source_ip, count(*) AS suspicious_count FROM security_logs
          WHERE threat_label = 'suspicious' GROUP BY 1) USING (source_ip)""",
    "top_ips": """
        SELECT * FROM reputation ORDER BY total_events DESC, source_ip, log_type LIMIT 10""",
    "reputation_table": """
        SELECT source_ip, score, total_events, unique_targets, total_bytes, log_types,
          as_of AS last_seen
        FROM (SELECT source_ip, reputation_score AS score, total_events, unique_targets,
            total_bytes, log_type AS log_types,
            row_number() OVER (PARTITION BY source_ip ORDER BY total_events, log_type DESC) AS n
          FROM top_ips), moment
        WHERE n = 1""",
    "pattern_table": """
        SELECT DISTINCT attack_category AS attack_type, source_ip, CAST(NULL AS BIGINT) AS "count",
          CAST(NULL AS BIGINT) AS event_count, as_of AS last_seen FROM patterns, moment
        UNION ALL
        SELECT attack_type, source_ip, distinct_targets, event_count, as_of
        FROM (SELECT *, row_number() OVER (PARTITION BY source_ip
            ORDER BY distinct_targets, window_start DESC) AS n FROM scans), moment
        WHERE n = 1""",
    "ip_types": """
        SELECT source_ip, string_agg(attack_type, ',' ORDER BY list_position(
          ['PORT_SCAN', 'SQLI', 'XSS', 'LFI', 'TOOL_DETECTED', 'BRUTE_FORCE'], attack_type)) AS attack_types
        FROM pattern_table
        WHERE attack_type IN ('PORT_SCAN', 'SQLI', 'XSS', 'LFI', 'TOOL_DETECTED', 'BRUTE_FORCE')
        GROUP BY 1""",
    "keys": """
        SELECT source_ip AS ip FROM reputation_table UNION SELECT source_ip FROM ip_types
        UNION SELECT ip_source FROM summary""",
    "requests": """
        SELECT DISTINCT trim(ip) AS ip FROM (
          SELECT CASE log_id % 6 WHEN 0 THEN concat('  ', source_ip, ' ') WHEN 1 THEN '   '
            WHEN 2 THEN repeat(source_ip, 6) WHEN 3 THEN concat('9', source_ip) ELSE source_ip END AS ip
          FROM security_logs WHERE action = 'blocked')
        WHERE length(ip) <= 45 AND trim(ip) <> ''""",
    "timeline": """
        SELECT strftime("timestamp", '%Y%m%d') AS event_date,
          CAST(hour("timestamp") AS INTEGER) AS event_hour,
          count(*) FILTER (threat_label = 'malicious') AS malicious_count,
          count(*) FILTER (threat_label = 'suspicious') AS suspicious_count,
          count(*) FILTER (threat_label = 'benign') AS benign_count
        FROM security_logs WHERE threat_label IN ('malicious', 'suspicious', 'benign')
        GROUP BY 1, 2""",
}

SCENARIO_LOGS = """
        SELECT * FROM security_logs UNION ALL
        SELECT -(CAST(epoch(hour_start) AS BIGINT) // 3600 * 100 + step), hour_start, source_ip, dest_ip,
          protocol, action, threat_label, log_type, bytes_transferred, user_agent, request_path
        FROM (SELECT DISTINCT date_trunc('hour', "timestamp") AS hour_start FROM security_logs), scenario"""

LOGS = ["b", "a", "security_logs"]
ALERTS = LOGS + [
    "moment", "logs", "live_flagged", "signatures", "scans", "brute", "bursts",
    "detections", "all_alerts", "alerts",
]
SUMMARY = ALERTS + ["recent", "recent_types", "summary"]
PATTERNS = LOGS + ["logs", "flagged", "patterns"]
REPUTATION = LOGS + ["moment", "bad", "reputation", "top_ips", "reputation_table"]
PATTERN_TABLE = LOGS + ["moment", "logs", "flagged", "patterns", "scans", "pattern_table", "ip_types"]
PROFILES = [v for v in VIEWS if v in SUMMARY + REPUTATION + PATTERN_TABLE + ["keys", "requests"]]

ALERT_FIELDS = (
    "ip_source, bucket_time, alert_id, last_seen, threat_score, attack_types, alert_type, severity,"
    " event_count, bytes_total, user_agents, log_sources"
)
TEN_COLUMNS = (
    '"timestamp", source_ip, dest_ip, protocol, action, threat_label, log_type,'
    " bytes_transferred, user_agent, request_path"
)
PARTITIONS = (
    "strftime(\"timestamp\", '%Y') AS \"year\", strftime(\"timestamp\", '%m') AS \"month\","
    " strftime(\"timestamp\", '%d') AS \"day\""
)
LOG_PARTITION = (
    "CAST(CASE log_type WHEN 'ids' THEN 1 WHEN 'application' THEN 2 ELSE 0 END AS INTEGER)"
    ' AS "partition"'
)
PROFILE_FIELDS = """
    coalesce(r.score, 0) AS reputation_score, coalesce(r.total_events, 0) AS total_historical_events,
    coalesce(t.attack_types, '') AS attack_types_detected, r.last_seen AS last_batch_update,
    coalesce(s.active_alerts, 0) AS active_alerts, s.last_seen AS last_seen,
    coalesce(s.current_threat_score, 0) AS current_threat_score,
    coalesce(s.recent_attack_types, '') AS recent_attack_types,
    coalesce(s.recent_alert_bytes, 0) AS recent_alert_bytes,
    CASE WHEN coalesce(r.score, 0) > 80 AND coalesce(s.active_alerts, 0) >= 1 THEN 'BLOCK'
      WHEN coalesce(r.score, 0) >= 50 THEN 'MONITOR'
      WHEN coalesce(s.active_alerts, 0) > 0 THEN 'MONITOR' ELSE 'ALLOW' END AS recommendation,
    least(1.0::DOUBLE, round(coalesce(r.score, 0) * 0.4::DOUBLE
      + coalesce(s.current_threat_score, 0) * 0.6::DOUBLE) / 100.0::DOUBLE) AS confidence"""
PROFILE_SIDES = """
    LEFT JOIN reputation_table r ON r.source_ip = k.ip
    LEFT JOIN ip_types t ON t.source_ip = k.ip LEFT JOIN summary s ON s.ip_source = k.ip"""
STAMP = "%Y-%m-%d %H:%M:%S"
LISTED = "CASE WHEN {0} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({0}, ',') END"
READABLE_BYTES = """
    CASE WHEN bytes_total = 0 THEN '0 B' WHEN bytes_total < 1024 THEN concat(bytes_total, '.0 B')
      ELSE concat(tenths // 10, '.', tenths % 10, ' ', unit) END"""


def _select(views: list[str], sql: str, **override: str) -> str:
    bodies = {**VIEWS, **override}
    return "WITH " + ", ".join(f"{v} AS ({bodies[v]})" for v in views) + f" {sql}"


def _spread(views: list[str], sql: str, **override: str) -> str:
    """A query over the logs dealt over five days, as the view `spread`."""
    bodies = {
        "spread": 'SELECT * REPLACE ("timestamp" + to_days(CAST(log_id % 5 AS INTEGER)) AS "timestamp") FROM security_logs',
        "logs": "SELECT * FROM spread",
        "moment": 'SELECT max("timestamp") AS as_of FROM spread',
        "timeline": VIEWS["timeline"].replace("FROM security_logs", "FROM spread"),
        **override,
    }
    return _select([*LOGS, "spread", *[v for v in views if v not in LOGS]], sql, **bodies)


def _logs(sql: str) -> str:
    return _select(LOGS, sql)


def oracle_sql() -> dict[str, str]:
    detector = lambda view, sql="SELECT * FROM {}", **override: _select(
        LOGS + ["logs"] + (["live_flagged"] if view == "signatures" else []) + [view], sql.format(view), **override
    )
    stream = lambda types: _select(
        ALERTS, f"SELECT {ALERT_FIELDS} FROM all_alerts WHERE alert_type IN ({types})"
    )
    signature_types = "'KNOWN_ATTACK_TOOL', 'SQLI_DETECTED', 'XSS_DETECTED', 'LFI_DETECTED'"
    reputation = _select(LOGS + ["bad", "reputation"], "SELECT * FROM reputation")
    timeline = _select(LOGS + ["timeline"], "SELECT * FROM timeline")
    ten_columns = _logs(f"SELECT {TEN_COLUMNS} FROM security_logs")
    return {
        "log_count": _logs("SELECT count(*) AS logs FROM security_logs"),
        "tcp_only": _logs("SELECT * FROM security_logs WHERE protocol = 'TCP'"),
        "blocked_only": _logs("SELECT * FROM security_logs WHERE action = 'blocked'"),
        "suspicious_events": _select(LOGS + ["bad"], "SELECT * FROM bad"),
        "partition_columns": _logs(f"SELECT *, {PARTITIONS} FROM security_logs"),
        "log_type_partition": _logs(f"SELECT log_id, log_type, {LOG_PARTITION} FROM security_logs"),
        "csv_ingest": ten_columns,
        "lake_scan": _logs(
            f"SELECT {PARTITIONS}, protocol, count(*) AS events,"
            " CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes FROM security_logs GROUP BY ALL"
        ),
        "lake_roundtrip": _logs(f"SELECT {TEN_COLUMNS}, {PARTITIONS} FROM security_logs"),
        "lake_range": _spread(
            LOGS,
            f"""SELECT {TEN_COLUMNS}, {PARTITIONS} FROM spread
            WHERE CAST("timestamp" AS DATE) IN (DATE '2023-10-16', DATE '2023-10-17')""",
        ),
        "sink_roundtrip": _select(
            [v for v in VIEWS if v in PATTERNS + REPUTATION + ["scans"]],
            """SELECT 'attack_patterns' AS result, concat_ws('|', attack_category, CAST(log_id AS VARCHAR)) AS "key",
              CAST(threat_score AS BIGINT) AS amount FROM patterns
            UNION ALL SELECT 'ip_reputation', concat_ws('|', source_ip, log_type), total_events FROM top_ips
            UNION ALL SELECT 'port_scans', concat_ws('|', source_ip, CAST(window_start AS VARCHAR)), distinct_targets
              FROM scans
            UNION ALL SELECT 'volume_analysis', concat_ws('|', threat_label, log_type, protocol),
              quantile_disc(bytes_transferred, 0.95) FROM security_logs GROUP BY threat_label, log_type, protocol""",
        ),
        "keyed_upsert": _select(
            PATTERN_TABLE + ["late_keys"],
            """SELECT attack_type, source_ip, CAST(NULL AS BIGINT) AS "count", CAST(NULL AS BIGINT) AS event_count,
              as_of AS last_seen FROM late_keys, moment
            UNION ALL SELECT attack_type, source_ip, 7, NULL, as_of - INTERVAL 1 DAY FROM (
              SELECT attack_category AS attack_type, source_ip FROM patterns WHERE log_id % 2 = 0
              EXCEPT SELECT * FROM late_keys), moment
            UNION ALL SELECT * FROM pattern_table WHERE attack_type = 'PORT_SCAN'""",
            late_keys="SELECT DISTINCT attack_category AS attack_type, source_ip FROM patterns WHERE log_id % 2 = 1 OR log_id % 3 > 0",
        ),
        "json_parse": _logs(
            "SELECT log_id, "
            + ", ".join(
                f"CASE WHEN log_id % 13 = 0 THEN NULL ELSE {c} END AS {c}"
                for c in TEN_COLUMNS.replace("\n", " ").split(", ")
                for c in [c.strip()]
            )
            + " FROM security_logs"
        ),
        "json_quarantine": _logs(
            """SELECT log_id, fault, body FROM (
              SELECT log_id,
                CASE WHEN log_id % 13 = 0 THEN 'body: not JSON' WHEN log_id % 13 = 1 THEN 'body: not an object'
                  WHEN log_id % 13 = 2 THEN 'timestamp: not a time, bytes_transferred: not a whole number'
                  WHEN log_id % 13 = 3 THEN 'bytes_transferred: not a whole number'
                  WHEN log_id % 13 = 4 THEN 'body: missing' END AS fault,
                CASE WHEN log_id % 13 = 0 THEN '{"source_ip":"' || source_ip
                  WHEN log_id % 13 = 1 THEN '["' || source_ip || '"]'
                  WHEN log_id % 13 = 2 THEN '{"source_ip":"' || source_ip || '","timestamp":"soon","bytes_transferred":{}}'
                  WHEN log_id % 13 = 3 THEN '{"source_ip":"' || source_ip || '","bytes_transferred":"n/a"}' END AS body
              FROM security_logs) WHERE fault IS NOT NULL"""
        ),
        "json_publish": _logs(f"SELECT *, {LOG_PARTITION} FROM security_logs"),
        "normalize_raw_logs": _select(
            LOGS + ["moment"],
            """SELECT log_id,
              CASE WHEN log_id % 7 < 3 THEN strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ')
                WHEN log_id % 7 = 4 THEN concat('on ', CAST("timestamp" AS VARCHAR))
                WHEN log_id % 7 = 5 THEN '2023-13-45 10:00:00'
                ELSE strftime(as_of, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
              source_ip, dest_ip, protocol, action, threat_label, log_type,
              CASE WHEN log_id % 6 < 3 THEN 0 ELSE coalesce(bytes_transferred, 0) END AS bytes_transferred,
              '' AS user_agent, request_path, log_id % 7 NOT IN (4, 5) AS stamp_readable
            FROM security_logs, moment""",
        ),
        "label_breakdown": _logs(
            "SELECT source_ip, log_type, threat_label, count(*) AS count_by_label,"
            " CAST(sum(bytes_transferred) AS BIGINT) AS bytes_by_label FROM security_logs GROUP BY 1, 2, 3"
        ),
        "suspicious_by_ip_logtype": _select(
            LOGS + ["bad"],
            "SELECT source_ip, log_type, count(*) AS total_events, count(DISTINCT dest_ip) AS unique_targets,"
            " CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes FROM bad GROUP BY 1, 2",
        ),
        "malicious_count_by_ip": _logs(
            "SELECT source_ip, count(*) AS malicious_count FROM security_logs"
            " WHERE threat_label = 'malicious' GROUP BY 1"
        ),
        "suspicious_count_by_ip": _logs(
            "SELECT source_ip, count(*) AS suspicious_count FROM security_logs"
            " WHERE threat_label = 'suspicious' GROUP BY 1"
        ),
        "reputation_all_ips": reputation,
        "reputation_join": reputation,
        "top_malicious_ips": _select(
            LOGS + ["bad", "reputation", "top_ips"], "SELECT * FROM top_ips"
        ),
        "ip_reputation_table": _select(REPUTATION, "SELECT * FROM reputation_table"),
        "port_scan": detector("scans"),
        "brute_force_alerts": detector("brute"),
        "volume_anomaly_alerts": detector("bursts"),
        "brute_force_sliding": detector("brute", brute=VIEWS["brute"].replace(
            'time_bucket(INTERVAL 1 MINUTE, "timestamp")', 'time_bucket(INTERVAL 20 SECOND, "timestamp") - to_seconds(20 * k)'
        ).replace("FROM logs", "FROM logs, range(3) s(k)")),
        "attack_patterns": _select(PATTERNS, "SELECT * FROM patterns"),
        "signature_alerts": detector("signatures"),
        "attack_category_distribution": _select(
            PATTERNS, 'SELECT attack_category, count(*) AS "count" FROM patterns GROUP BY 1'
        ),
        "attack_pattern_table": _select(PATTERN_TABLE, "SELECT * FROM pattern_table"),
        "volume_analysis": _logs(
            """SELECT threat_label, log_type, protocol,
              CAST(sum(bytes_transferred) AS DOUBLE) / count(bytes_transferred) AS avg_bytes,
              max(bytes_transferred) AS max_bytes, quantile_disc(bytes_transferred, 0.95) AS p95_bytes,
              count(*) AS event_count, CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
            FROM security_logs GROUP BY 1, 2, 3"""
        ),
        "threat_timeline": timeline,
        "timeline_full_join": timeline,
        "timeline_range": _spread(
            LOGS + ["timeline"], "SELECT * FROM timeline WHERE event_date BETWEEN '20231016' AND '20231018'"
        ),
        "timeline_last_days": _spread(
            LOGS + ["moment", "timeline"],
            """SELECT timeline.* FROM timeline, moment WHERE event_date BETWEEN
              strftime(as_of - INTERVAL 1 DAY, '%Y%m%d') AND strftime(as_of, '%Y%m%d')""",
        ),
        "stored_timeline": _spread(
            LOGS + ["timeline"], "SELECT * FROM timeline WHERE event_date BETWEEN '20231016' AND '20231017'"
        ),
        "active_threats_of_days": _spread(ALERTS, f"SELECT {ALERT_FIELDS} FROM alerts"),
        "volume_sketches": _spread(
            LOGS,
            """SELECT threat_label, log_type, protocol, avg(bytes_transferred) AS avg_bytes,
              max(bytes_transferred) AS max_bytes, count(*) AS event_count,
              CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, TRUE AS rank_within_error
            FROM spread WHERE CAST("timestamp" AS DATE) BETWEEN '2023-10-16' AND '2023-10-17' GROUP BY 1, 2, 3""",
        ),
        "target_sketches": _spread(
            LOGS,
            """SELECT source_ip, log_type, count(*) AS total_events,
              CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, TRUE AS targets_within_error
            FROM spread WHERE threat_label IN ('suspicious', 'malicious') GROUP BY 1, 2""",
        ),
        "stored_active_alerts": _spread(
            ALERTS,
            f"""SELECT {ALERT_FIELDS} FROM (
              SELECT *, max(last_seen) OVER () AS newest FROM all_alerts
              WHERE alert_type IN ('BRUTE_FORCE', 'VOLUME_ANOMALY'))
            WHERE last_seen > newest - INTERVAL 24 HOUR
            ORDER BY threat_score DESC, last_seen DESC, alert_id LIMIT 100""",
        ),
        "active_threats": _select(ALERTS, f"SELECT {ALERT_FIELDS} FROM alerts"),
        "recent_alerts_by_ip": _select(SUMMARY, f"SELECT {ALERT_FIELDS}, recency FROM recent"),
        "active_alerts_top100": _select(
            ALERTS,
            f"SELECT {ALERT_FIELDS} FROM alerts ORDER BY threat_score DESC, last_seen DESC, alert_id LIMIT 100",
        ),
        "alert_summary_by_ip": _select(SUMMARY, "SELECT * FROM summary"),
        "severity_counts": _select(
            ALERTS,
            "SELECT count(*) FILTER (severity = 'CRITICAL') AS critical,"
            " count(*) FILTER (severity = 'HIGH') AS high, count(*) AS total FROM alerts",
        ),
        "alerts_by_severity": _select(
            ALERTS, f"SELECT {ALERT_FIELDS} FROM alerts WHERE severity = 'HIGH'"
        ),
        "attack_type_distribution": _select(
            ALERTS,
            """SELECT c.alert_type, count(a.alert_id) AS alerts
            FROM (VALUES ('BRUTE_FORCE'), ('SQLI_DETECTED'), ('PORT_SCAN'), ('KNOWN_ATTACK_TOOL'),
              ('VOLUME_ANOMALY'), ('OTHER')) AS c(alert_type)
            LEFT JOIN (SELECT alert_id, CASE WHEN alert_type IN ('BRUTE_FORCE', 'SQLI_DETECTED',
              'PORT_SCAN', 'KNOWN_ATTACK_TOOL', 'VOLUME_ANOMALY') THEN alert_type ELSE 'OTHER' END AS alert_type
              FROM alerts) a ON a.alert_type = c.alert_type
            GROUP BY 1""",
        ),
        "top_alert_ips": _select(
            ALERTS,
            """SELECT CAST(row_number() OVER (ORDER BY max_score DESC, ip_source) AS INTEGER) AS "rank",
              ip_source, alerts, max_score,
              CAST(round(max_score / CAST(max(max_score) OVER () AS DOUBLE) * 100) AS INTEGER) AS bar_percent
            FROM (SELECT ip_source, count(*) AS alerts, max(threat_score) AS max_score FROM alerts
              GROUP BY 1 ORDER BY max_score DESC, ip_source LIMIT 10)""",
        ),
        "alert_board": _select(
            ALERTS,
            f"""SELECT alert_id, ip_source,
              CASE alert_type WHEN 'BRUTE_FORCE' THEN '🔑 Brute Force' WHEN 'SQLI_DETECTED' THEN '💉 SQL Injection'
                WHEN 'XSS_DETECTED' THEN '🕷️ XSS' WHEN 'LFI_DETECTED' THEN '📁 LFI'
                WHEN 'KNOWN_ATTACK_TOOL' THEN '🛠️ Outil Malveillant'
                WHEN 'VOLUME_ANOMALY' THEN '📈 Anomalie Volume' WHEN 'PORT_SCAN' THEN '🔍 Port Scan'
                WHEN 'SIGNATURE_MATCH' THEN '⚠️ Signature' ELSE alert_type END AS alert_label,
              severity, threat_score,
              CASE WHEN threat_score >= 80 THEN 'critical' WHEN threat_score >= 60 THEN 'high'
                WHEN threat_score >= 40 THEN 'medium' ELSE 'low' END AS score_band,
              event_count, {READABLE_BYTES} AS bytes,
              strftime(last_seen, '%H:%M:%S') AS last_seen_time,
              concat(strftime(last_seen, '%Y%m%d'), ' ', hour(last_seen), 'h') AS hour_label
            FROM (SELECT *, (bytes_total // factor) * 10
                + ((bytes_total % factor) * 20 + factor) // (2 * factor) AS tenths
              FROM (SELECT *,
                  CASE WHEN bytes_total >= 1073741824 THEN 1073741824 WHEN bytes_total >= 1048576 THEN 1048576
                    ELSE 1024 END AS factor,
                  CASE WHEN bytes_total >= 1073741824 THEN 'GB' WHEN bytes_total >= 1048576 THEN 'MB'
                    ELSE 'KB' END AS unit FROM alerts))""",
        ),
        "scenario_alerts": _select(
            LOGS + ["scenario"] + ALERTS[3:],
            "SELECT ip_source, bucket_time, alert_id, last_seen, threat_score, alert_type, severity,"
            " event_count, bytes_total FROM alerts",
            logs=SCENARIO_LOGS,
            moment=f'SELECT max("timestamp") AS as_of FROM ({SCENARIO_LOGS})',
        ),
        "ip_attack_types": _select(PATTERN_TABLE, "SELECT * FROM ip_types"),
        "global_stats": _select(
            REPUTATION,
            "SELECT count(*) AS total_ips_analyzed, count(*) FILTER (score > 70) AS high_risk_ips"
            " FROM reputation_table",
        ),
        "stored_stats": _select(
            REPUTATION,
            "SELECT count(*) AS total_ips_analyzed, count(*) FILTER (score > 70) AS high_risk_ips"
            " FROM reputation_table",
        ),
        "threat_profile": _select(
            PROFILES,
            f"""SELECT ip,
              CAST(to_json(struct_pack(reputation_score := reputation_score,
                total_historical_events := total_historical_events,
                attack_types_detected := {LISTED.format('attack_types_detected')}, first_seen := NULL,
                last_batch_update := strftime(last_batch_update, '{STAMP}'))) AS VARCHAR) AS batch_layer,
              CAST(to_json(struct_pack(active_alerts := active_alerts, last_seen := strftime(last_seen, '{STAMP}'),
                current_threat_score := current_threat_score,
                recent_attack_types := {LISTED.format('recent_attack_types')},
                recent_alert_bytes := recent_alert_bytes)) AS VARCHAR) AS speed_layer,
              recommendation, confidence
            FROM (SELECT k.ip, {PROFILE_FIELDS} FROM keys k {PROFILE_SIDES})""",
        ),
        "recommendation": _select(
            PROFILES,
            "SELECT ip, reputation_score, active_alerts, recommendation FROM"
            f" (SELECT k.ip, {PROFILE_FIELDS} FROM keys k {PROFILE_SIDES})",
        ),
        "threat_profile_flat": _select(
            PROFILES, f"SELECT k.ip, {PROFILE_FIELDS} FROM keys k {PROFILE_SIDES}"
        ),
        "stored_profile": _select(
            PROFILES,
            f"""SELECT k.ip, {PROFILE_FIELDS} FROM (
              SELECT source_ip AS ip FROM security_logs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) k {PROFILE_SIDES}""",
        ),
        "profile_lookup": _select(
            PROFILES, f"SELECT k.ip, {PROFILE_FIELDS} FROM requests k {PROFILE_SIDES}"
        ),
        "stream_brute_force": stream("'BRUTE_FORCE'"),
        "stream_signature": stream(signature_types),
        "stream_volume": stream("'VOLUME_ANOMALY'"),
        "stream_all": stream(f"'BRUTE_FORCE', 'VOLUME_ANOMALY', {signature_types}"),
        "stream_port_scan": stream("'PORT_SCAN'"),
        "stream_port_scan_early": stream("'PORT_SCAN'"),
        "stream_live_state": _spread(
            SUMMARY, "SELECT * FROM summary",
            alerts="""SELECT * FROM all_alerts
              WHERE last_seen > (SELECT max(last_seen) FROM all_alerts) - INTERVAL 24 HOUR""",
        ),
        "stream_restart": stream(f"'BRUTE_FORCE', {signature_types}"),
    }
