"""Shared DuckDB fragments: the telemetry adapter and the six rules as plain joins."""

EVENTS = """
src AS (
  SELECT event_id::BIGINT AS event_id, ts, user_id::BIGINT AS u, event_type AS kind, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(date_trunc('week', ts)) AS week_us
  FROM events
),
ev AS (
  SELECT event_id,
    CASE WHEN u % 3 <> 0 THEN u % 3 END AS dataset_id,
    week_us + (epoch_us(ts) - week_us) // 84 AS t,
    CASE WHEN kind IN ('error','signup') THEN 'CLOUD-IAM' WHEN kind = 'view' THEN 'vpn'
         WHEN kind = 'click' THEN 'cloud_identity' WHEN k < 50 THEN 'api_gateway'
         ELSE 'endpoint-edr' END AS source_system,
    CASE WHEN kind IN ('error','signup') THEN 'interactive_login' WHEN kind = 'view' THEN 'vpn_event'
         WHEN kind = 'click' THEN 'cloud_event' WHEN k < 50 THEN 'bulk_export'
         WHEN k % 5 = 4 THEN 'credential_access' ELSE 'process_start' END AS event_type,
    CASE WHEN k <> 99 THEN 'user-' || u END AS username,
    CASE WHEN u % 5 = 0 THEN '198.51.100.24' ELSE '203.0.113.' || (u % 200) END AS source_ip,
    CAST(NULL AS VARCHAR) AS destination_ip,
    CASE WHEN kind IN ('error','signup') THEN 'IAM-' || (u % 4) WHEN kind = 'view' THEN 'LAPTOP-' || u
         WHEN kind = 'click' THEN 'CLOUD-IAM' WHEN k < 50 THEN 'API-GATEWAY-01'
         ELSE 'LAPTOP-' || (u % 50) END AS asset,
    CASE WHEN kind IN ('error','signup') THEN 'login'
         WHEN kind = 'view' THEN CASE WHEN k % 4 = 0 THEN 'connect' ELSE 'posture_check' END
         WHEN kind = 'click' THEN CASE k % 10 WHEN 0 THEN 'CreateAccessKey' WHEN 1 THEN 'AttachUserPolicy'
                                  WHEN 2 THEN 'DisableMFADevice' ELSE 'ListUsers' END
         WHEN k < 50 THEN 'GET /api/v1/export' ELSE 'alert' END AS action,
    CASE WHEN kind = 'error' THEN 'failure'
         WHEN kind = 'purchase' AND k < 50 THEN CASE WHEN k % 5 = 0 THEN '403' ELSE '200' END
         ELSE 'success' END AS outcome,
    CASE WHEN value >= 200 THEN 'critical' WHEN value >= 90 THEN 'high'
         WHEN value >= 35 THEN 'medium' ELSE 'low' END AS severity,
    CASE WHEN kind = 'purchase' AND k >= 50 AND k % 5 = 4 THEN 'T1003.001' END AS mitre_technique_id,
    CASE WHEN kind = 'purchase' AND k >= 50 AND k % 10 = 7 THEN 'Malware signature ' || k
         WHEN kind = 'purchase' AND k >= 50 AND k % 10 = 2 THEN 'Store of CREDENTIALs read, code ' || k
         WHEN k % 7 = 3 THEN 'Observed code ' || k || ' of user ' || u
         WHEN k % 7 = 5 THEN '' END AS normalized_message
  FROM src
)"""

ALERTS = """
login AS (
  SELECT * FROM ev WHERE source_system = 'CLOUD-IAM' AND event_type = 'interactive_login' AND action = 'login'
),
r1_pairs AS (
  SELECT s.event_id AS sid, f.event_id AS fid, f.t AS ft
  FROM login s JOIN login f
    ON s.outcome = 'success' AND f.outcome = 'failure'
   AND s.dataset_id IS NOT DISTINCT FROM f.dataset_id
   AND s.username IS NOT DISTINCT FROM f.username AND s.source_ip IS NOT DISTINCT FROM f.source_ip
   AND f.t BETWEEN s.t - 900000000 AND s.t
),
r1 AS (
  SELECT s.dataset_id, 1 AS rule_no, 'Brute force followed by successful login' AS alert_rule_name,
    'high' AS severity,
    coalesce(s.username, 'None') || ' had ' || g.n || ' failed logins followed by a successful login from '
      || coalesce(s.source_ip, 'None') || '.' AS description,
    s.username AS related_username, s.asset AS related_asset, 'T1110' AS mitre_technique_id,
    s.event_id AS normalized_event_id, g.first_t AS first_us, s.t AS last_us, g.n + 1 AS evidence_count,
    s.event_id AS lead_event_id, s.t AS anchor_t, s.event_id AS anchor_id
  FROM login s JOIN (SELECT sid, count(*) AS n, min(ft) AS first_t FROM r1_pairs GROUP BY sid HAVING count(*) >= 3) g
    ON g.sid = s.event_id
),
r2 AS (
  SELECT dataset_id, 2 AS rule_no, 'Successful login from unusual IP' AS alert_rule_name, 'medium' AS severity,
    coalesce(username, 'None') || ' successfully logged in from unusual IP ' || source_ip || '.' AS description,
    username AS related_username, asset AS related_asset, 'T1078' AS mitre_technique_id,
    event_id AS normalized_event_id, t AS first_us, t AS last_us, 1 AS evidence_count,
    event_id AS lead_event_id, t AS anchor_t, event_id AS anchor_id
  FROM login WHERE outcome = 'success' AND source_ip NOT IN ('198.51.100.24', '10.20.5.15') AND source_ip <> ''
),
priv AS (
  SELECT * FROM ev WHERE source_system = 'cloud_identity'
    AND action IN ('AttachUserPolicy', 'CreateAccessKey', 'DisableMFADevice', 'UpdateSecurityGroup')
),
r3_pairs AS (
  SELECT v.event_id AS vid, p.event_id AS pid, p.t AS pt, p.asset AS passet
  FROM ev v JOIN priv p
    ON v.source_system = 'vpn' AND v.action = 'connect' AND v.outcome = 'success' AND v.username <> ''
   AND v.dataset_id IS NOT DISTINCT FROM p.dataset_id AND v.username = p.username
   AND p.t BETWEEN v.t AND v.t + 3600000000
),
r3 AS (
  SELECT v.dataset_id, 3 AS rule_no, 'VPN login followed by privilege escalation' AS alert_rule_name,
    'high' AS severity,
    v.username || ' connected to VPN and then performed ' || g.n || ' privilege-sensitive cloud actions.' AS description,
    v.username AS related_username, coalesce(nullif(g.last_asset, ''), v.asset) AS related_asset,
    'T1098' AS mitre_technique_id, g.last_id AS normalized_event_id, v.t AS first_us, g.last_t AS last_us,
    g.n + 1 AS evidence_count, v.event_id AS lead_event_id, v.t AS anchor_t, v.event_id AS anchor_id
  FROM ev v JOIN (
    SELECT vid, count(*) AS n, max(pt) AS last_t, arg_max(pid, (pt, pid)) AS last_id,
           arg_max_null(passet, (pt, pid)) AS last_asset
    FROM r3_pairs GROUP BY vid) g ON g.vid = v.event_id
),
r4 AS (
  SELECT dataset_id, 4 AS rule_no, 'Suspicious API data download' AS alert_rule_name, 'high' AS severity,
    coalesce(username, 'None') || ' performed suspicious API download: ' || coalesce(action, 'None') || '.' AS description,
    username AS related_username, asset AS related_asset, 'T1530' AS mitre_technique_id,
    event_id AS normalized_event_id, t AS first_us, t AS last_us, 1 AS evidence_count,
    event_id AS lead_event_id, t AS anchor_t, event_id AS anchor_id
  FROM ev WHERE source_system = 'api_gateway' AND event_type IN ('bulk_export', 'file_archive_download') AND outcome = '200'
),
r5 AS (
  SELECT dataset_id, 5 AS rule_no, 'Endpoint malware or credential access' AS alert_rule_name,
    coalesce(nullif(severity, ''), 'high') AS severity,
    coalesce(nullif(normalized_message, ''), 'Endpoint malware or credential access activity observed.') AS description,
    username AS related_username, asset AS related_asset, mitre_technique_id,
    event_id AS normalized_event_id, t AS first_us, t AS last_us, 1 AS evidence_count,
    event_id AS lead_event_id, t AS anchor_t, event_id AS anchor_id
  FROM ev WHERE source_system = 'endpoint-edr'
    AND (event_type IN ('credential_access', 'malware_detected') OR coalesce(mitre_technique_id, '') = 'T1003.001'
         OR lower(coalesce(normalized_message, '')) LIKE '%credential%'
         OR lower(coalesce(normalized_message, '')) LIKE '%malware%')
),
high_ev AS (SELECT * FROM ev WHERE username <> '' AND lower(severity) IN ('high', 'critical')),
r6_windows AS (
  SELECT a.dataset_id, a.username, a.t AS start_t, a.event_id AS start_id, b.event_id AS bid, b.t AS bt, b.asset AS basset
  FROM high_ev a JOIN high_ev b
    ON a.dataset_id IS NOT DISTINCT FROM b.dataset_id AND a.username = b.username
   AND (b.t, b.event_id) >= (a.t, a.event_id) AND b.t <= a.t + 86400000000
),
r6_starts AS (
  SELECT dataset_id, username, start_t, start_id, count(*) AS n, max(bt) AS last_t,
         arg_max(bid, (bt, bid)) AS last_id, arg_max_null(basset, (bt, bid)) AS last_asset
  FROM r6_windows GROUP BY ALL HAVING count(*) >= 3
),
r6_first AS (
  SELECT * FROM r6_starts
  QUALIFY row_number() OVER (PARTITION BY dataset_id, username ORDER BY start_t, start_id) = 1
),
r6_anchor AS (
  SELECT dataset_id, username, t AS anchor_t, event_id AS anchor_id FROM high_ev
  QUALIFY row_number() OVER (PARTITION BY dataset_id, username ORDER BY t, event_id) = 1
),
r6 AS (
  SELECT f.dataset_id, 6 AS rule_no, 'Multiple high-severity events by same user within 24 hours' AS alert_rule_name,
    'critical' AS severity,
    f.username || ' generated ' || f.n || ' high or critical events within 24 hours.' AS description,
    f.username AS related_username, f.last_asset AS related_asset, CAST(NULL AS VARCHAR) AS mitre_technique_id,
    f.last_id AS normalized_event_id, f.start_t AS first_us, f.last_t AS last_us, f.n AS evidence_count,
    f.start_id AS lead_event_id, a.anchor_t, a.anchor_id
  FROM r6_first f JOIN r6_anchor a ON a.dataset_id IS NOT DISTINCT FROM f.dataset_id AND a.username = f.username
),
alerts AS (
  SELECT *, rule_no || '-' || lead_event_id || '-' || evidence_count AS alert_id FROM (
    SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3
    UNION ALL SELECT * FROM r4 UNION ALL SELECT * FROM r5 UNION ALL SELECT * FROM r6)
)"""

EVIDENCE = """
alert_evidence AS (
  SELECT DISTINCT dataset_id, alert_id, event_id FROM (
    SELECT a.dataset_id, a.alert_id, a.lead_event_id AS event_id FROM alerts a
    UNION ALL SELECT a.dataset_id, a.alert_id, p.fid FROM alerts a JOIN r1_pairs p ON a.rule_no = 1 AND p.sid = a.lead_event_id
    UNION ALL SELECT a.dataset_id, a.alert_id, p.pid FROM alerts a JOIN r3_pairs p ON a.rule_no = 3 AND p.vid = a.lead_event_id
    UNION ALL SELECT a.dataset_id, a.alert_id, w.bid FROM alerts a JOIN r6_windows w ON a.rule_no = 6 AND w.start_id = a.lead_event_id)
)"""

# Grouping: islands for alerts with a user; for the rest the literal first-fit, one alert at a time.
ASSIGNED = """
user_flags AS (
  SELECT *, CASE WHEN first_us <= max(last_us) OVER (PARTITION BY dataset_id, related_username
      ORDER BY first_us, rule_no, anchor_t, anchor_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 86400000000
      THEN 0 ELSE 1 END AS opens
  FROM alerts WHERE related_username <> ''
),
user_numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY dataset_id, related_username
      ORDER BY first_us, rule_no, anchor_t, anchor_id ROWS UNBOUNDED PRECEDING) AS island FROM user_flags
),
user_groups AS (
  SELECT dataset_id, alert_id, first_value(alert_id) OVER (PARTITION BY dataset_id, related_username, island
      ORDER BY first_us, rule_no, anchor_t, anchor_id) AS opener FROM user_numbered
),
bare AS (
  SELECT coalesce(a.dataset_id, 0) AS scope, a.dataset_id, a.alert_id, a.related_asset AS asset, a.first_us, a.last_us,
    e.ids, row_number() OVER (PARTITION BY a.dataset_id ORDER BY a.first_us, a.rule_no, a.anchor_t, a.anchor_id) AS rn
  FROM alerts a JOIN (SELECT dataset_id, alert_id, list(event_id) AS ids FROM alert_evidence GROUP BY ALL) e
    ON e.alert_id = a.alert_id AND e.dataset_id IS NOT DISTINCT FROM a.dataset_id
  WHERE coalesce(a.related_username, '') = ''
),
walk AS (
  SELECT scope, rn, [{'opener': alert_id, 'assets': [asset], 'ids': ids, 'lo': first_us, 'hi': last_us}] AS groups,
         alert_id AS opener FROM bare WHERE rn = 1
  UNION ALL
  SELECT scope, rn,
    CASE WHEN home IS NULL
      THEN list_append(groups, {'opener': alert_id, 'assets': [asset], 'ids': ids, 'lo': first_us, 'hi': last_us})
      ELSE list_transform(groups, lambda g: CASE WHEN g.opener = home
        THEN {'opener': g.opener, 'assets': list_append(g.assets, asset), 'ids': list_concat(g.ids, ids),
              'lo': least(g.lo, first_us), 'hi': greatest(g.hi, last_us)} ELSE g END) END AS groups,
    coalesce(home, alert_id) AS opener
  FROM (
    SELECT b.scope, b.rn, b.alert_id, b.asset, b.ids, b.first_us, b.last_us, w.groups,
      list_filter(w.groups, lambda g: (list_has_any(g.ids, b.ids) OR (coalesce(b.asset, '') <> '' AND list_contains(g.assets, b.asset)))
        AND b.first_us <= g.hi + 86400000000 AND b.last_us >= g.lo - 86400000000)[1].opener AS home
    FROM walk w JOIN bare b ON b.scope = w.scope AND b.rn = w.rn + 1)
),
assigned AS (
  SELECT a.*, 'inc-' || g.opener AS incident_id FROM alerts a JOIN (
    SELECT dataset_id, alert_id, opener FROM user_groups
    UNION ALL SELECT b.dataset_id, b.alert_id, w.opener FROM walk w JOIN bare b ON b.scope = w.scope AND b.rn = w.rn) g
  ON g.alert_id = a.alert_id AND g.dataset_id IS NOT DISTINCT FROM a.dataset_id
)"""

INCIDENTS = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY first_us, rule_no, anchor_t, anchor_id) AS pos,
    CASE lower(severity) WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 ELSE 0 END AS rank
  FROM assigned
),
paths AS (
  SELECT incident_id, string_agg(alert_rule_name, ' -> ' ORDER BY pos) AS suspected_attack_path
  FROM (SELECT incident_id, alert_rule_name, min(pos) AS pos FROM ranked GROUP BY ALL) GROUP BY incident_id
),
assets AS (
  SELECT incident_id, string_agg(related_asset, ', ' ORDER BY related_asset) AS asset_text
  FROM (SELECT DISTINCT incident_id, related_asset FROM ranked WHERE related_asset <> '') GROUP BY incident_id
),
top_users AS (
  SELECT incident_id, related_username FROM (
    SELECT incident_id, related_username, count(*) AS n, min(pos) AS pos FROM ranked
    WHERE related_username <> '' GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY n DESC, pos) = 1
),
heads AS (
  SELECT incident_id, any_value(dataset_id) AS dataset_id, count(*) AS alert_count, min(first_us) AS first_us,
         max(last_us) AS last_us, arg_max(severity, (rank, -pos)) AS severity
  FROM ranked GROUP BY incident_id
),
incidents AS (
  SELECT h.incident_id, h.dataset_id, 'open' AS status, h.severity,
    upper(h.severity[1]) || lower(h.severity[2:]) || ' security incident for '
      || coalesce(u.related_username, s.asset_text, 'unknown target') AS title,
    p.suspected_attack_path,
    'Correlated ' || h.alert_count || ' alerts involving ' || coalesce(u.related_username, 'an unknown user')
      || ' and ' || coalesce(s.asset_text, 'unknown assets') || '.' AS description,
    u.related_username AS affected_user, coalesce(s.asset_text, '') AS asset_text, h.first_us, h.last_us, h.alert_count
  FROM heads h JOIN paths p USING (incident_id) LEFT JOIN assets s USING (incident_id)
  LEFT JOIN top_users u USING (incident_id)
),
incident_events AS (
  SELECT DISTINCT a.incident_id, a.dataset_id, e.event_id FROM assigned a JOIN alert_evidence e
    ON e.alert_id = a.alert_id AND e.dataset_id IS NOT DISTINCT FROM a.dataset_id
)"""

# Scoped evidence. Adapter incidents never mix scopes, but the condition is stated anyway.
BUNDLE = """
b_alerts AS (
  SELECT a.* FROM assigned a JOIN incidents i ON i.incident_id = a.incident_id AND i.dataset_id IS NOT DISTINCT FROM a.dataset_id
),
b_events AS (
  SELECT l.incident_id, e.* FROM incident_events l JOIN incidents i USING (incident_id) JOIN ev e ON e.event_id = l.event_id
  WHERE e.dataset_id IS NOT DISTINCT FROM i.dataset_id
),
sizes AS (
  SELECT i.incident_id, i.dataset_id, coalesce(a.n, 0) AS alerts, coalesce(e.n, 0) AS events, e.lo AS first_event_id, e.hi AS last_event_id
  FROM incidents i LEFT JOIN (SELECT incident_id, count(*) AS n FROM b_alerts GROUP BY 1) a USING (incident_id)
  LEFT JOIN (SELECT incident_id, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi FROM b_events GROUP BY 1) e USING (incident_id)
),
entities AS (
  SELECT DISTINCT incident_id, kind, value FROM (
    SELECT incident_id, 'user' AS kind, affected_user AS value FROM incidents
    UNION ALL SELECT incident_id, 'user', related_username FROM b_alerts
    UNION ALL SELECT incident_id, 'user', username FROM b_events
    UNION ALL SELECT incident_id, 'asset', related_asset FROM b_alerts
    UNION ALL SELECT incident_id, 'asset', asset FROM b_events)
  WHERE value <> ''
),
texts AS (
  SELECT z.*, u.names AS users, s.names AS assets, r.names AS rules, d.ids
  FROM sizes z
  LEFT JOIN (SELECT incident_id, string_agg(value, ', ' ORDER BY value) AS names FROM entities WHERE kind = 'user' GROUP BY 1) u USING (incident_id)
  LEFT JOIN (SELECT incident_id, string_agg(value, ', ' ORDER BY value) AS names FROM entities WHERE kind = 'asset' GROUP BY 1) s USING (incident_id)
  LEFT JOIN (SELECT incident_id, string_agg(alert_rule_name, ', ' ORDER BY alert_rule_name) AS names
             FROM (SELECT DISTINCT incident_id, alert_rule_name FROM b_alerts) GROUP BY 1) r USING (incident_id)
  LEFT JOIN (SELECT incident_id, string_agg(event_id::VARCHAR, ', ' ORDER BY event_id) AS ids FROM b_events GROUP BY 1) d USING (incident_id)
),
summaries AS (
  SELECT i.incident_id, i.dataset_id, 'mock-deterministic-v1' AS model_name,
    'Incident ' || i.incident_id || ' is a ' || coalesce(nullif(i.severity, ''), 'unknown') || ' severity investigation involving '
      || coalesce(t.users, 'unknown users') || ' and ' || coalesce(t.assets, 'unknown assets')
      || '. The suspected attack path is: ' || coalesce(nullif(i.suspected_attack_path, ''), 'not available') || '.' AS executive_summary,
    'Correlated ' || t.alerts || ' alerts and ' || t.events || ' normalized events. Alert rules observed: '
      || coalesce(t.rules, 'none') || '. Evidence event IDs: ' || coalesce(t.ids, '') || '.' AS technical_summary,
    coalesce(t.users, '') AS users, coalesce(t.assets, '') AS assets,
    concat_ws(chr(10),
      'Preserve incident evidence and keep original normalized event IDs attached to the case.',
      'Review and validate each alert before taking irreversible remediation action.',
      'Disable or reset sessions for affected user accounts: ' || t.users || '.',
      'Isolate or increase monitoring on affected assets: ' || t.assets || '.',
      'Revoke suspicious access keys, tokens, and VPN sessions tied to the incident.',
      'Review API export activity and confirm whether data left the environment.') AS steps,
    t.alerts AS alert_count, t.events AS event_count
  FROM incidents i JOIN texts t USING (incident_id)
)"""


def chain(*parts: str, events: str = EVENTS) -> str:
    """A WITH clause of the adapter and the given parts."""
    return "WITH RECURSIVE " + ",\n".join([events.strip(), *(part.strip() for part in parts)])
