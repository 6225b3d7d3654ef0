"""DuckDB SQL for the ingest, normalization and profiling queries.

The feeds are restated as columns; nothing here parses JSON.
"""

from __future__ import annotations

from oracles.base import EVENTS

# The canonical target fields, in mapping order; only the first is required.
TARGET_FIELDS = (
    "timestamp",
    "source_system",
    "event_type",
    "username",
    "source_ip",
    "destination_ip",
    "asset",
    "action",
    "outcome",
    "severity",
    "mitre_technique_id",
    "message",
)

# Names that suggest a target field when a schema is inspected, targets in order.
SUGGESTED = {
    "timestamp": (
        "timestamp", "time", "event_time", "eventTime", "activityDateTime", "published",
        "createdDateTime", "observed_at", "datetime",
    ),
    "source_system": (
        "source_system", "source", "system", "log_source", "product", "eventSource", "service",
        "appDisplayName",
    ),
    "event_type": (
        "event_type", "type", "event_name", "request_category", "alert_type", "category",
        "riskEventType",
    ),
    "username": (
        "username", "user", "user_name", "account", "actor", "userPrincipalName", "principal",
        "src_user", "actor.alternateId", "userIdentity.userName",
    ),
    "source_ip": (
        "source_ip", "src_ip", "client_ip", "ipAddress", "sourceIPAddress", "client.ipAddress",
        "remote_ip", "ip", "sourceAddress",
    ),
    "destination_ip": (
        "destination_ip", "dest_ip", "dst_ip", "target_ip", "assigned_private_ip", "server_ip",
    ),
    "asset": (
        "asset", "host", "hostname", "device", "computer", "device_name", "device.hostname",
        "deviceDetail.displayName", "target_resource", "resource",
    ),
    "action": (
        "action", "operation", "operationName", "activity", "eventName", "event_action",
    ),
    "outcome": (
        "outcome", "result", "status", "status_code", "response_code", "errorCode",
        "status.errorCode", "status.failureReason",
    ),
    "severity": ("severity", "level", "risk", "priority", "riskLevelDuringSignIn"),
    "mitre_technique_id": ("mitre_technique_id", "technique_id", "mitre", "technique"),
    "message": ("message", "reason", "description", "details", "alert", "failureReason"),
}

BASE = EVENTS.strip() + """,
r AS (SELECT s.event_id, s.u, s.kind, s.k, e.t, 'user-' || s.u AS usr, '203.0.113.' || (s.u % 200) AS ip,
        'part-' || (s.event_id % 4) || '.ndjson' AS file_name
      FROM src s JOIN ev e USING (event_id))"""

COLS = (
    "t, source_system, event_type, username, source_ip, destination_ip, asset, action, outcome, severity, "
    "mitre_technique_id, normalized_message"
)

SOURCES = """
n_auth AS (
  SELECT event_id, t, 'CLOUD-IAM' AS source_system, CASE WHEN k % 11 = 0 THEN 'auth_event' ELSE 'interactive_login' END AS event_type,
    CASE WHEN k <> 99 THEN usr END AS username, ip AS source_ip, CAST(NULL AS VARCHAR) AS destination_ip, 'IAM-' || (u % 4) AS asset,
    'login' AS action, CASE WHEN kind = 'error' THEN 'failure' ELSE 'success' END AS outcome,
    CASE WHEN k % 3 = 0 THEN 'High' END AS severity, CAST(NULL AS VARCHAR) AS mitre_technique_id,
    CASE WHEN k % 4 <> 0 THEN 'reason ' || k END AS normalized_message
  FROM r WHERE kind IN ('error', 'signup')
),
n_vpn AS (
  SELECT event_id, t, 'vpn' AS source_system, 'vpn_' || a AS event_type, usr AS username, ip AS source_ip,
    '10.8.0.' || (u % 250) AS destination_ip, 'LAPTOP-' || u AS asset, a AS action, CASE WHEN k % 6 <> 0 THEN 'success' END AS outcome,
    CAST(NULL AS VARCHAR) AS severity, CAST(NULL AS VARCHAR) AS mitre_technique_id,
    'VPN ' || a || ' ' || CASE WHEN k % 6 <> 0 THEN 'success' ELSE 'unknown' END || ' for session '
      || CASE WHEN k % 5 <> 0 THEN 's-' || event_id ELSE 'unknown' END AS normalized_message
  FROM (SELECT *, CASE k % 4 WHEN 0 THEN 'connect' WHEN 1 THEN 'vpn_event' ELSE 'disconnect' END AS a FROM r WHERE kind = 'view')
),
n_cloud AS (
  SELECT event_id, t, 'cloud_' || CASE k % 3 WHEN 0 THEN 'identity' WHEN 1 THEN 'object-storage' ELSE 'audit' END AS source_system,
    op AS event_type, CASE WHEN k % 9 <> 0 THEN usr END AS username, ip AS source_ip, CAST(NULL AS VARCHAR) AS destination_ip,
    'CLOUD-IAM' AS asset, op AS action, 'success' AS outcome, CAST(NULL AS VARCHAR) AS severity,
    CAST(NULL AS VARCHAR) AS mitre_technique_id,
    CASE WHEN k % 9 <> 0 THEN usr ELSE 'unknown actor' END || ' performed ' || op || ' on '
      || CASE WHEN k % 8 <> 0 THEN 'res/' || (u % 9) ELSE 'unknown resource' END AS normalized_message
  FROM (SELECT *, CASE k % 10 WHEN 0 THEN 'CreateAccessKey' WHEN 1 THEN 'AttachUserPolicy' WHEN 2 THEN 'cloud_audit_event'
               ELSE 'ListUsers' END AS op FROM r WHERE kind = 'click')
),
n_api AS (
  SELECT event_id, t, 'api_gateway' AS source_system, CASE WHEN k % 3 <> 0 THEN 'bulk_export' ELSE 'api_access' END AS event_type,
    usr AS username, ip AS source_ip, CAST(NULL AS VARCHAR) AS destination_ip, 'API-GATEWAY-01' AS asset, rq AS action,
    st AS outcome, CAST(NULL AS VARCHAR) AS severity, CAST(NULL AS VARCHAR) AS mitre_technique_id,
    rq || ' returned ' || st || ' with ' || CASE WHEN k % 4 <> 0 THEN (k * 10)::VARCHAR ELSE 'unknown' END || ' records and '
      || (k * 1000) || ' bytes' AS normalized_message
  FROM (SELECT *, CASE WHEN k % 6 = 0 THEN 'REQUEST' ELSE 'GET' END || ' ' || CASE WHEN k % 7 <> 0 THEN '/api/v1/export' ELSE 'unknown_path' END AS rq,
               CASE WHEN k % 5 = 0 THEN '403' ELSE '200' END AS st FROM r WHERE kind = 'purchase' AND k < 50)
),
n_endpoint AS (
  SELECT event_id, t, 'endpoint-edr' AS source_system, CASE WHEN k % 5 = 4 THEN 'credential_access' ELSE 'endpoint_event' END AS event_type,
    usr AS username, CAST(NULL AS VARCHAR) AS source_ip, CASE WHEN k % 3 = 0 THEN '198.51.100.24' END AS destination_ip,
    'LAPTOP-' || (u % 50) AS asset, 'alert' AS action, 'blocked' AS outcome,
    CASE WHEN k % 4 = 0 THEN 'critical' ELSE 'medium' END AS severity, CASE WHEN k % 5 = 4 THEN 'T1003.001' END AS mitre_technique_id,
    CASE WHEN k % 2 = 1 THEN 'detail ' || k END AS normalized_message
  FROM r WHERE kind = 'purchase' AND k >= 50
),
n_all AS (
  SELECT 'auth' AS source_name, * FROM n_auth UNION ALL SELECT 'vpn', * FROM n_vpn UNION ALL SELECT 'cloud_audit', * FROM n_cloud
  UNION ALL SELECT 'api_access', * FROM n_api UNION ALL SELECT 'endpoint_alert', * FROM n_endpoint
)"""

UPLOADS = """
up AS (
  SELECT *, 1 + u % 6 AS dataset_id, ['auth', 'vpn', 'cloud', 'api', 'endpoint', 'generic'][1 + u % 6] AS source_type,
    CASE WHEN k % 5 < 2 THEN 'GET' END AS method,
    CASE WHEN k % 5 < 3 THEN CASE WHEN k % 2 = 0 THEN '/api/v1/export' ELSE '/api/v1/profile' END END AS path
  FROM r
),
acts AS (
  SELECT *, CASE WHEN method IS NOT NULL AND path IS NOT NULL THEN method || ' ' || path WHEN k % 5 = 3 THEN 'login'
                 WHEN k % 5 = 4 THEN 'Op' || (k % 10) END AS act,
    CASE WHEN k % 3 = 2 AND k = 98 THEN NULL WHEN k % 3 = 2 AND k % 2 = 0 THEN t - t % 1000000 ELSE t END AS auto_t,
    CASE k % 4 WHEN 0 THEN usr WHEN 1 THEN NULL WHEN 2 THEN usr ELSE 'svc-' || (u % 10) END AS who,
    CASE WHEN k % 2 = 0 THEN 'LAPTOP-' || (u % 50) ELSE 'bucket/' || (u % 9) END AS thing
  FROM up
),
typed AS (
  SELECT *, CASE WHEN k % 6 = 0 THEN 'custom_event' WHEN k % 5 = 4 THEN 'Op' || (k % 10) WHEN k % 6 = 1 THEN 'cat-' || (k % 4)
      WHEN source_type = 'auth' THEN 'interactive_login' WHEN source_type = 'vpn' AND act IS NOT NULL THEN 'vpn_' || act
      WHEN source_type = 'cloud' AND act IS NOT NULL THEN act
      WHEN source_type = 'api' THEN CASE WHEN lower(concat_ws(' ', act, path)) LIKE '%export%' THEN 'bulk_export' ELSE 'api_access' END
      WHEN source_type = 'endpoint' THEN 'endpoint_event' ELSE 'uploaded_event' END AS etype
  FROM acts
),
auto AS (
  SELECT dataset_id, event_id AS record_no, file_name, k, u, usr, source_type, t AS true_t, auto_t AS t,
    CASE WHEN k % 10 = 0 THEN 'siem' WHEN source_type = 'cloud' AND k % 2 = 0 THEN 'cloud_storage'
         ELSE CASE source_type WHEN 'auth' THEN 'CLOUD-IAM' WHEN 'vpn' THEN 'vpn' WHEN 'cloud' THEN 'cloud_identity'
              WHEN 'api' THEN 'api_gateway' WHEN 'endpoint' THEN 'endpoint-edr' ELSE 'uploaded_generic' END END AS source_system,
    etype AS event_type, who AS username, ip AS source_ip, CAST(NULL AS VARCHAR) AS destination_ip, thing AS asset, act AS action,
    CASE k % 3 WHEN 0 THEN '200' WHEN 1 THEN 'Failure' END AS outcome,
    CASE k % 8 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS severity,
    CASE WHEN k % 9 = 0 THEN 'T1003.001' END AS mitre_technique_id,
    CASE WHEN k % 7 = 0 THEN 'note ' || k ELSE coalesce(who, 'unknown user') || ' ' || coalesce(act, etype) || ' on ' || thing END
      AS normalized_message
  FROM typed
),
mapped AS (
  SELECT dataset_id, record_no, file_name, k,
    CASE dataset_id WHEN 1 THEN CASE WHEN k % 3 = 1 THEN true_t END
      WHEN 4 THEN CASE WHEN k % 3 = 0 THEN true_t ELSE epoch_us(TIMESTAMP '2024-01-01 00:00:00') END
      WHEN 6 THEN CASE WHEN k % 3 <> 2 OR k = 98 THEN NULL WHEN k % 2 = 0 THEN true_t - true_t % 1000000 ELSE true_t END
      ELSE t END AS t,
    CASE WHEN dataset_id = 1 THEN CASE WHEN k % 5 = 0 THEN 'literal' ELSE 'nested' || (k % 2) END ELSE source_system END AS source_system,
    CASE WHEN dataset_id = 6 THEN 'uploaded_event' ELSE event_type END AS event_type,
    CASE dataset_id WHEN 1 THEN NULL WHEN 6 THEN CASE WHEN k % 4 IN (1, 2) THEN upper(usr) ELSE 'NOBODY' END ELSE username END AS username,
    source_ip, destination_ip, CASE WHEN dataset_id = 1 THEN 'H' || (u % 20) ELSE asset END AS asset,
    CASE WHEN dataset_id = 4 THEN CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END ELSE action END AS action,
    CASE WHEN dataset_id = 4 THEN CASE WHEN k % 3 = 0 THEN '200' ELSE 'unknown' END ELSE outcome END AS outcome,
    CASE WHEN dataset_id = 1 THEN CASE WHEN k % 8 = 1 THEN 'low' ELSE 'medium' END ELSE severity END AS severity,
    mitre_technique_id,
    CASE WHEN dataset_id = 4 THEN '["A","T' || (k % 2) || '"]' ELSE normalized_message END AS normalized_message
  FROM auto
)"""

ISO = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(({0} % 1000000)::VARCHAR, 6, '0')"
SPACED = "strftime(make_timestamp(t), '%Y-%m-%d %H:%M:%S') || '.' || lpad((t % 1000000)::VARCHAR, 6, '0')"

PATHS = f"""
leaves AS (
  SELECT dataset_id, event_id AS record_no, file_name, unnest([
    {{'path': 'timestamp', 'sample': CASE k % 3 WHEN 0 THEN {ISO.format('t')} || 'Z' WHEN 1 THEN '' END}},
    {{'path': 'eventTime', 'sample': CASE WHEN k % 3 = 1 THEN CASE WHEN k % 7 = 0 THEN {SPACED} ELSE {ISO.format('t')} || 'Z' END END}},
    {{'path': 'observed_at', 'sample': CASE WHEN k % 3 = 2 THEN CASE WHEN k = 98 THEN 'not-a-time'
        WHEN k % 2 = 0 THEN strftime(make_timestamp(t), '%Y%m%dT%H%M%SZ')
        ELSE {ISO.format('(t + 7200000000)')} || '+02:00' END END}},
    {{'path': 'username', 'sample': CASE k % 4 WHEN 0 THEN '  ' || usr || ' ' WHEN 1 THEN '  ' END}},
    {{'path': 'actor', 'sample': CASE WHEN k % 4 IN (1, 2) THEN usr END}},
    {{'path': 'src_user', 'sample': CASE WHEN k % 4 = 3 THEN 'svc-' || (u % 10) END}},
    {{'path': 'src_ip', 'sample': ip}},
    {{'path': 'ip', 'sample': '10.0.0.1'}},
    {{'path': 'host', 'sample': CASE WHEN k % 2 = 0 THEN 'LAPTOP-' || (u % 50) END}},
    {{'path': 'resource', 'sample': CASE WHEN k % 2 = 1 THEN 'bucket/' || (u % 9) END}},
    {{'path': 'method', 'sample': method}},
    {{'path': 'path', 'sample': path}},
    {{'path': 'action', 'sample': CASE WHEN k % 5 = 3 THEN 'login' END}},
    {{'path': 'operation', 'sample': CASE WHEN k % 5 = 4 THEN 'Op' || (k % 10) END}},
    {{'path': 'event_type', 'sample': CASE WHEN k % 6 = 0 THEN 'custom_event' END}},
    {{'path': 'category', 'sample': CASE WHEN k % 6 = 1 THEN 'cat-' || (k % 4) END}},
    {{'path': 'service', 'sample': CASE WHEN k % 2 = 0 THEN 'storage' END}},
    {{'path': 'source', 'sample': CASE WHEN k % 10 = 0 THEN 'siem' END}},
    {{'path': 'status', 'sample': CASE WHEN k % 3 = 0 THEN '200' END}},
    {{'path': 'result', 'sample': CASE WHEN k % 3 = 1 THEN 'Failure' END}},
    {{'path': 'severity', 'sample': CASE WHEN k % 8 = 0 THEN ' HIGH ' END}},
    {{'path': 'priority', 'sample': CASE WHEN k % 8 = 1 THEN 'Low' END}},
    {{'path': 'technique_id', 'sample': CASE WHEN k % 9 = 0 THEN 'T1003.001' END}},
    {{'path': 'message', 'sample': CASE WHEN k % 7 = 0 THEN 'note ' || k END}},
    {{'path': 'reason', 'sample': CASE WHEN k % 7 = 1 THEN ' ' END}},
    {{'path': 'machine.hostname', 'sample': 'h' || (u % 20)}},
    {{'path': 'machine.os.name', 'sample': 'linux'}},
    {{'path': 'geo.city', 'sample': CASE WHEN k % 5 = 0 THEN 'literal' END}},
    {{'path': 'geo.city', 'sample': 'nested' || (k % 2)}},
    {{'path': 'tags', 'sample': '["a","t' || (k % 2) || '"]'}},
    {{'path': 'flag', 'sample': CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END}}
  ], max_depth := 2) FROM up
),
paths AS (SELECT * FROM leaves WHERE sample IS NOT NULL)"""


def _aliases() -> str:
    rows = [
        f"({place}, '{target}', '{alias}')"
        for place, (target, aliases) in enumerate(SUGGESTED.items())
        for alias in aliases
    ]
    return "aliases(place, target, alias) AS (VALUES " + ", ".join(rows) + ")"


SUGGEST = f"""
{_aliases()},
fields AS (
  SELECT dataset_id, path, min(file_name || lpad(record_no::VARCHAR, 12, '0')) AS seen,
    regexp_replace(lower(path), '[^a-z0-9]', '', 'g') AS whole,
    regexp_replace(lower(split_part(path, '.', -1)), '[^a-z0-9]', '', 'g') AS leaf
  FROM paths GROUP BY dataset_id, path
),
matches AS (
  SELECT f.dataset_id, f.path, f.whole, f.seen, a.target, 'high' AS confidence, 0 AS grade, a.place, 0 AS part
  FROM fields f JOIN aliases a ON a.alias = f.path
  UNION ALL SELECT f.dataset_id, f.path, f.whole, f.seen, a.target, 'high', 1, a.place, 0
  FROM fields f JOIN aliases a ON regexp_replace(lower(a.alias), '[^a-z0-9]', '', 'g') = f.whole
  UNION ALL SELECT f.dataset_id, f.path, f.whole, f.seen, a.target, 'medium', 1, a.place, 1
  FROM fields f JOIN aliases a ON f.path LIKE '%.%' AND regexp_replace(lower(a.alias), '[^a-z0-9]', '', 'g') = f.leaf
),
best AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY dataset_id, path ORDER BY grade, place, part) = 1),
winners AS (
  SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY dataset_id, target ORDER BY
    CASE confidence WHEN 'high' THEN 0 ELSE 1 END, CASE WHEN whole = regexp_replace(target, '[^a-z0-9]', '', 'g') THEN 0 ELSE 1 END,
    lower(path), seen, path) = 1
),
suggestions AS (
  SELECT f.dataset_id, f.path, w.target AS target_field, w.confidence
  FROM fields f LEFT JOIN winners w ON w.dataset_id = f.dataset_id AND w.path = f.path
)"""

TARGET_LIST = ", ".join(f"'{name}'" for name in (*TARGET_FIELDS, "bogus"))
KNOWN_TARGETS = ", ".join(f"'{name}'" for name in TARGET_FIELDS)

S = f"WITH {BASE},{SOURCES}"
U = f"WITH {BASE},{UPLOADS}"
P = f"WITH {BASE},{UPLOADS},{PATHS}"
W = f"WITH {BASE},{UPLOADS},{PATHS},{SUGGEST}"


def _source(name: str) -> str:
    return f"{S} SELECT event_id AS record_no, {COLS} FROM {name}"


# Rows that are written to files and read back.
FILE_ROWS = (
    f"WITH {EVENTS.strip()} SELECT event_id, coalesce(username, '') AS username, "
    "'first \"' || coalesce(asset, '') || '\"' || chr(10) || 'second, ' || event_id AS note FROM ev"
)

SQL: dict[str, str] = {
    "csv_records": FILE_ROWS,
    "ndjson_records": FILE_ROWS,
    "json_array_records": FILE_ROWS,
    "upload_records": FILE_ROWS,
    "source_files": f"{S} SELECT {COLS} FROM n_all",
    "upload_loaded": f"{U} SELECT dataset_id, {COLS} FROM auto WHERE dataset_id = 2 AND t IS NOT NULL",
    "mappings_replaced": f"{W} SELECT dataset_id, path AS source_field, target_field, "
    "CASE WHEN dataset_id IN (2, 4) THEN 'uppercase' ELSE 'direct' END AS transformation_type, "
    "CASE WHEN dataset_id IN (2, 4) THEN 'mapping_required' WHEN bool_or(target_field = 'timestamp') OVER (PARTITION BY dataset_id) "
    "THEN 'ready_to_normalize' ELSE 'mapping_required' END AS status FROM suggestions WHERE target_field IS NOT NULL "
    "QUALIFY NOT (dataset_id IN (2, 4) AND target_field = 'timestamp')",
    "source_types": f"{U} SELECT dataset_id, source_type, count(*) AS n FROM up GROUP BY 1, 2",
    "upload_listing": f"{U}, per_file AS (SELECT dataset_id, file_name, count(*) AS n FROM up GROUP BY 1, 2), "
    "sets AS (SELECT dataset_id, sum(n)::BIGINT AS record_count, string_agg(file_name || ':' || (n * 100), ' ' ORDER BY file_name) AS files "
    "FROM per_file GROUP BY 1) SELECT *, row_number() OVER (ORDER BY dataset_id % 3 DESC, dataset_id DESC) AS place FROM sets",
    "normalize_auth": _source("n_auth"),
    "normalize_vpn": _source("n_vpn"),
    "normalize_cloud": _source("n_cloud"),
    "normalize_api": _source("n_api"),
    "normalize_endpoint": _source("n_endpoint"),
    "normalize_all": f"{S} SELECT source_name, event_id AS record_no, {COLS} FROM n_all",
    "normalize_generic": f"{U} SELECT dataset_id, record_no, {COLS} FROM auto",
    "normalize_mapped": f"{U} SELECT dataset_id, record_no, {COLS} FROM mapped",
    "timestamp_gate": f"{U} SELECT dataset_id, file_name, record_no, 'A valid timestamp is required for every normalized record. File '''"
    " || file_name || ''', record ' || record_no || ' did not produce one. Review the dataset field mapping first.' AS reason "
    "FROM mapped WHERE t IS NULL",
    "mapping_preview": f"{U} SELECT dataset_id, scan_no, CASE WHEN t IS NULL THEN 'Record ' || scan_no || "
    "' has no valid timestamp and cannot be normalized until its mapping is corrected.' END AS warning, "
    f"{COLS} FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY file_name, record_no) AS scan_no FROM mapped) "
    "WHERE scan_no <= 10",
    "bounded_scan": f"{U} SELECT dataset_id, file_name, record_no, row_number() OVER (PARTITION BY dataset_id ORDER BY file_name, record_no) "
    "AS scan_no FROM auto QUALIFY scan_no <= 100",
    "raw_dedupe": f"{S} SELECT CAST(NULL AS BIGINT) AS dataset_id, source_system, event_type, "
    "'part-' || (event_id % 4) || '.ndjson' AS file_name, event_id AS record_no, t FROM n_all",
    "raw_dedupe_other_day": f"{S} SELECT CASE WHEN event_id % 3 = 1 THEN event_id + (SELECT max(event_id) FROM n_all WHERE event_id % 3 <> 1) "
    "ELSE event_id END AS event_id, source_system, event_type, CASE WHEN event_id % 3 = 1 THEN t + 86400000000 ELSE t END AS t FROM n_all",
    "ndjson_reject_audit": f"{U} SELECT dataset_id, file_name, event_id AS line_no, CASE event_id % 50 WHEN 13 THEN 'invalid JSON' "
    "ELSE 'not a JSON object' END AS reason FROM up WHERE event_id % 50 IN (13, 21, 34)",
    "flatten_paths": f"{P} SELECT dataset_id, record_no, path, sample FROM paths",
    "field_profile": f"""{W},
firsts AS (SELECT dataset_id, path, sample, min((file_name, record_no)) AS seen FROM paths GROUP BY ALL),
three AS (SELECT *, row_number() OVER (PARTITION BY dataset_id, path ORDER BY seen, sample) AS place FROM firsts QUALIFY place <= 3)
SELECT t.dataset_id, t.path, string_agg(t.sample, ' | ' ORDER BY t.place) AS samples, any_value(s.target_field) AS target_field,
  any_value(s.confidence) AS confidence
FROM three t JOIN suggestions s ON s.dataset_id = t.dataset_id AND s.path = t.path GROUP BY t.dataset_id, t.path""",
    "mapping_suggest": f"{W} SELECT * FROM suggestions",
    "dataset_readiness": f"{W} SELECT dataset_id, CASE WHEN bool_or(coalesce(target_field = 'timestamp', false)) THEN 'ready_to_normalize' "
    "ELSE 'mapping_required' END AS status FROM suggestions GROUP BY dataset_id",
    "mapping_audit": f"""{W},
numbered AS (SELECT dataset_id, path, row_number() OVER (PARTITION BY dataset_id ORDER BY path) AS n FROM fields),
first_set AS (
  SELECT dataset_id, n AS ordinal, CASE WHEN n % 11 = 5 THEN '' WHEN n % 7 = 3 THEN 'nope.' || path ELSE path END AS source_field,
    [{TARGET_LIST}][1 + n % 13] AS target_field,
    CASE n % 5 WHEN 0 THEN 'direct' WHEN 1 THEN 'lowercase' WHEN 2 THEN 'uppercase' WHEN 3 THEN 'direct' ELSE 'reverse' END AS transformation_type
  FROM numbered
),
both_sets AS (
  SELECT * FROM first_set
  UNION ALL SELECT dataset_id, ordinal + 100, source_field, 'message', transformation_type FROM first_set WHERE ordinal % 6 = 0
),
judged AS (
  SELECT b.*, CASE WHEN b.source_field = '' THEN 'source_field cannot be empty'
    WHEN f.path IS NULL THEN 'Unknown source field: ' || b.source_field
    WHEN b.target_field NOT IN ({KNOWN_TARGETS}) THEN 'Invalid target field: ' || b.target_field
    WHEN b.transformation_type = 'reverse' THEN 'Invalid transformation_type: reverse'
    WHEN EXISTS (SELECT 1 FROM both_sets o WHERE o.dataset_id = b.dataset_id AND o.source_field = b.source_field AND o.ordinal < b.ordinal)
      THEN 'Duplicate source field mapping: ' || b.source_field
    WHEN EXISTS (SELECT 1 FROM both_sets o WHERE o.dataset_id = b.dataset_id AND o.target_field = b.target_field AND o.ordinal < b.ordinal)
      THEN 'Duplicate target field mapping: ' || b.target_field END AS reason
  FROM both_sets b LEFT JOIN fields f ON f.dataset_id = b.dataset_id AND f.path = b.source_field
)
SELECT j.*, j.reason IS NOT NULL AND j.ordinal = min(CASE WHEN j.reason IS NOT NULL THEN j.ordinal END) OVER (PARTITION BY j.dataset_id) AS blocks
FROM judged j""",
}
