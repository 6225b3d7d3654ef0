"""DuckDB SQL for the detection, correlation, browse, summary and dashboard queries."""

from __future__ import annotations

import re

from oracles.base import ALERTS, ASSIGNED, BUNDLE, EVENTS, EVIDENCE, INCIDENTS, chain

A = chain(ALERTS)
E = chain(ALERTS, EVIDENCE)
G = chain(ALERTS, EVIDENCE, ASSIGNED)
I = chain(ALERTS, EVIDENCE, ASSIGNED, INCIDENTS)
B = chain(ALERTS, EVIDENCE, ASSIGNED, INCIDENTS, BUNDLE)

ALERT_COLS = (
    "dataset_id, alert_id, rule_no, alert_rule_name, severity, description, related_username, "
    "related_asset, mitre_technique_id, normalized_event_id, first_us, last_us, evidence_count, lead_event_id"
)
EVENT_COLS = (
    "event_id, dataset_id, t, source_system, event_type, username, source_ip, asset, action, outcome, severity"
)
FROM_US = "epoch_us(TIMESTAMP '2024-01-08 00:00:00')"
TO_US = "epoch_us(TIMESTAMP '2024-01-22 02:00:00')"
RERUN_US = "epoch_us(TIMESTAMP '2024-01-15 00:00:00')"


def utc(expr: str) -> str:
    return f"strftime(make_timestamp({expr}), '%Y-%m-%d %H:%M:%S') || ' UTC'"


def fraction(expr: str) -> str:
    return f"CASE WHEN {expr} % 1000000 = 0 THEN '' ELSE '.' || lpad(({expr} % 1000000)::VARCHAR, 6, '0') END"


def iso(expr: str, separator: str) -> str:
    return f"strftime(make_timestamp({expr}), '%Y-%m-%d{separator}%H:%M:%S') || {fraction(expr)} || '+00:00'"


EARLY = chain(
    ALERTS,
    events=EVENTS.replace("ev AS (", "ev_all AS (")
    + f",\nev AS (SELECT * FROM ev_all WHERE t < {RERUN_US})",
)
SPLIT_EVENTS = (
    EVENTS.replace("ev AS (", "ev_all AS (")
    + ",\nev AS (SELECT * REPLACE (dataset_id * 10 + length(source_system) % 10 AS dataset_id) "
    "FROM ev_all WHERE dataset_id IS NOT NULL)"
)
STORED_SUMMARIES = (
    "stored AS (SELECT incident_id, dataset_id, 1 AS summary_id, severity FROM incidents WHERE severity <> 'high' "
    "UNION ALL SELECT incident_id, dataset_id, 2, severity FROM incidents WHERE severity = 'critical')"
)
OWNED = (
    "legacy AS (SELECT a.* REPLACE (e.dataset_id AS dataset_id), 'legacy-' || a.related_asset AS incident_id "
    "FROM alerts a JOIN ev e ON e.event_id = a.normalized_event_id)"
)

PIECES = f"""
b_last AS (SELECT incident_id, min(event_id) AS lo FROM b_events GROUP BY 1),
doc AS (
  SELECT i.incident_id, 1 AS section, '' AS place,
    '# Incident Investigation Report: ' || i.title || chr(10) || chr(10) || '**Generated:** 2024-02-01 00:00:00 UTC' || chr(10)
    || '**Incident ID:** ' || i.incident_id || chr(10) || chr(10) || '## Incident Overview' || chr(10) || chr(10) || i.description
    || chr(10) || chr(10) || '- **Severity:** ' || i.severity || chr(10) || '- **Status:** ' || i.status || chr(10)
    || '- **Affected user:** ' || coalesce(i.affected_user, 'Not set') || chr(10)
    || '- **Affected assets:** ' || coalesce(nullif(i.asset_text, ''), 'Not identified') || chr(10)
    || '- **First seen:** ' || {utc('i.first_us')} || chr(10) || '- **Last seen:** ' || {utc('i.last_us')} || chr(10)
    || '- **Suspected attack path:** ' || i.suspected_attack_path || chr(10) || chr(10)
    || '## Executive Summary' || chr(10) || chr(10) || @EXEC@ || chr(10) || chr(10)
    || '## Technical Summary' || chr(10) || chr(10) || @TECH@ AS text
  FROM incidents i JOIN summaries s USING (incident_id) JOIN sizes z USING (incident_id)
  UNION ALL SELECT i.incident_id, 3, '', @DOT@ || chr(10) || chr(10) || '## Attack Timeline' || chr(10) || chr(10)
  FROM incidents i
  UNION ALL SELECT incident_id, 4, t || ',' || event_id,
    '- **' || {utc('t')} || '** - Event ' || event_id || ': ' || source_system || ' / ' || event_type || @MESSAGE@ || chr(10)
  FROM b_events
  UNION ALL SELECT i.incident_id, 5, '', chr(10) || '## Triggered Alerts' || chr(10) || chr(10)
    || '| Rule | Severity | User | Asset | Description |' || chr(10) || '| --- | --- | --- | --- | --- |' || chr(10) FROM incidents i
  UNION ALL SELECT incident_id, 6, rule_no || ',' || anchor_t || ',' || anchor_id,
    '| ' || alert_rule_name || ' | ' || severity || ' | ' || coalesce(related_username, 'Not set') || ' | '
    || coalesce(related_asset, 'Not set') || ' | ' || replace(replace(description, '|', '\\|'), chr(10), ' ') || ' |' || chr(10)
  FROM b_alerts
  UNION ALL SELECT i.incident_id, 7, '', chr(10) || '## Evidence Event IDs' || chr(10) || chr(10) FROM incidents i
  UNION ALL SELECT incident_id, 8, event_id::VARCHAR, CASE WHEN event_id = lo THEN '' ELSE ', ' END || event_id
  FROM b_events JOIN b_last USING (incident_id)
  UNION ALL SELECT i.incident_id, 9, '', chr(10) || chr(10) || '## Recommended Containment Steps' || chr(10) || chr(10)
    || @STEPS@ || chr(10) || chr(10) || '## Analyst Notes' || chr(10) || chr(10)
    || '_Add analyst observations, validation results, decisions, and follow-up actions here._' || chr(10) || chr(10)
    || '## Limitations' || chr(10) || chr(10)
    || '- This report is generated from incident, alert, event, and summary data currently stored in the platform.' || chr(10)
    || '- Missing or incomplete source telemetry may affect the investigation narrative.' || chr(10)
    || '- AI-assisted content should be validated by a qualified analyst before operational or legal use.' || chr(10)
    || '- This Markdown export is intended for investigation support and is not a formal forensic report.' || chr(10)
  FROM incidents i JOIN summaries s USING (incident_id)
)"""


def _pieces(**marks: str) -> str:
    text = PIECES
    for name, value in marks.items():
        text = text.replace(f"@{name}@", value)
    return text.strip()


FALLBACK = dict(
    EXEC="'Incident ' || i.incident_id || ' is a ' || i.severity || ' severity investigation affecting ' "
    "|| coalesce(i.affected_user, 'Not set') || '. Generate an LLM summary for a richer narrative.'",
    TECH="'The incident currently contains ' || z.alerts || ' linked alerts and ' || z.events || ' normalized evidence events.'",
    STEPS="'No containment recommendations are available.'",
)
SUMMARIZED = _pieces(
    EXEC="s.executive_summary", TECH="s.technical_summary", DOT="''", MESSAGE="''",
    STEPS="'- ' || replace(s.steps, chr(10), chr(10) || '- ')",
)
PLAIN = _pieces(
    EXEC=FALLBACK["EXEC"], TECH=FALLBACK["TECH"],
    DOT="''", MESSAGE="' - ' || coalesce(nullif(normalized_message, ''), 'Not set')",
    STEPS=FALLBACK["STEPS"],
)
# Two summary runs: the first saw the evidence of each week's first hour and left high incidents out, the
# second saw all evidence of critical incidents.
EARLY_BUNDLE = re.sub(
    r"\b(b_events|sizes|entities|texts|summaries)\b", r"early_\1", BUNDLE[BUNDLE.index("sizes AS (") :]
).strip()
VERSIONS = f"""
early_b_events AS (SELECT * FROM b_events WHERE t - epoch_us(date_trunc('week', make_timestamp(t))) < 3600000000),
{EARLY_BUNDLE},
held AS (
  SELECT e.*, 1 AS version, s.alert_count, s.event_count FROM early_b_events e JOIN early_summaries s USING (incident_id)
  WHERE incident_id IN (SELECT incident_id FROM incidents WHERE severity <> 'high')
  UNION ALL SELECT e.*, 2, s.alert_count, s.event_count FROM b_events e JOIN summaries s USING (incident_id)
  WHERE incident_id IN (SELECT incident_id FROM incidents WHERE severity = 'critical')
)""".strip()
AS_OF = f"""
chosen AS (
  SELECT s.incident_id, 2 AS version, s.executive_summary, s.technical_summary, s.steps
  FROM summaries s JOIN incidents i USING (incident_id) WHERE i.severity = 'critical'
  UNION ALL SELECT s.incident_id, 1, s.executive_summary, s.technical_summary, s.steps
  FROM early_summaries s JOIN incidents i USING (incident_id) WHERE i.severity NOT IN ('critical', 'high')
  UNION ALL SELECT i.incident_id, 0, {FALLBACK['EXEC']}, {FALLBACK['TECH']}, NULL
  FROM incidents i JOIN sizes z USING (incident_id) WHERE i.severity = 'high'
),
listed AS (
  SELECT h.incident_id, h.event_id, h.t, h.source_system, h.event_type, '' AS message FROM held h JOIN chosen USING (incident_id, version)
  UNION ALL SELECT e.incident_id, e.event_id, e.t, e.source_system, e.event_type, ' - ' || coalesce(nullif(e.normalized_message, ''), 'Not set')
  FROM b_events e JOIN chosen c USING (incident_id) WHERE c.version = 0
),
told AS (
  SELECT * FROM listed
  UNION ALL SELECT e.incident_id, e.event_id, e.t, e.source_system, e.event_type, ' - ' || coalesce(nullif(e.normalized_message, ''), 'Not set')
  FROM b_events e WHERE incident_id NOT IN (SELECT incident_id FROM listed)
),
""".strip() + "\n" + (
    _pieces(
        EXEC="s.executive_summary", TECH="s.technical_summary", DOT="''", MESSAGE="message",
        STEPS="coalesce('- ' || replace(s.steps, chr(10), chr(10) || '- '), 'No containment recommendations are available.')",
    )
    .replace("JOIN summaries s", "JOIN chosen s").replace("AS lo FROM b_events", "AS lo FROM listed")
    .replace("FROM b_events JOIN b_last", "FROM listed JOIN b_last").replace("FROM b_events", "FROM told")
    .replace(
        "'## Evidence Event IDs' || chr(10) || chr(10) FROM",
        "'## Evidence Event IDs' || chr(10) || chr(10) || CASE WHEN i.incident_id IN (SELECT incident_id FROM listed) THEN '' "
        "ELSE 'No evidence event IDs are available.' END FROM",
    )
)
# Order of pieces inside a document: numeric, like the event times and ids they come from.
PIECE_ORDER = (
    "section, TRY_CAST(split_part(place, ',', 1) AS BIGINT) NULLS FIRST, "
    "TRY_CAST(split_part(place, ',', 2) AS BIGINT) NULLS FIRST, TRY_CAST(split_part(place, ',', 3) AS BIGINT) NULLS FIRST"
)


def _rule(n: int) -> str:
    return f"{A} SELECT {ALERT_COLS} FROM alerts WHERE rule_no = {n}"



# Documents are cut into parts of fixed length.
PART_LENGTH = 8192


def parts(text: str) -> str:
    return f"unnest(range(0, CAST(ceil(length({text}) / {PART_LENGTH}.0) AS BIGINT))) AS p(part_no)"


def cut(text: str) -> str:
    return f"substr({text}, CAST(part_no * {PART_LENGTH} + 1 AS BIGINT), {PART_LENGTH}) AS text"


SQL: dict[str, str] = {
    "rule_brute_force": _rule(1),
    "rule_unusual_ip": _rule(2),
    "rule_vpn_privilege": _rule(3),
    "rule_api_download": _rule(4),
    "rule_endpoint_credential": _rule(5),
    "rule_multi_high": _rule(6),
    "alerts_all": f"{A} SELECT {ALERT_COLS} FROM alerts",
    "alerts_by_scope": f"{A} SELECT dataset_id, rule_no, count(*) AS alerts, sum(evidence_count)::BIGINT AS evidence, "
    "max(last_us) AS last_us FROM alerts GROUP BY dataset_id, rule_no",
    "alerts_new": f"SELECT n.* FROM ({A} SELECT {ALERT_COLS} FROM alerts) n "
    f"ANTI JOIN ({EARLY} SELECT dataset_id, alert_id FROM alerts) o "
    "ON o.alert_id = n.alert_id AND o.dataset_id IS NOT DISTINCT FROM n.dataset_id",
    "alert_evidence": f"{E} SELECT dataset_id, alert_id, event_id FROM alert_evidence",
    "incident_groups": f"{G} SELECT incident_id, dataset_id, count(*) AS alerts, min(first_us) AS first_us, "
    "max(last_us) AS last_us FROM assigned GROUP BY incident_id, dataset_id",
    "alert_assignment": f"{G} SELECT dataset_id, alert_id, incident_id FROM assigned",
    "incidents": f"{I} SELECT * FROM incidents",
    "attack_path": f"{I} SELECT dataset_id, suspected_attack_path, count(*) AS incidents FROM incidents GROUP BY 1, 2",
    "incident_evidence": f"{I} SELECT incident_id, dataset_id, event_id FROM incident_events",
    "alerts_unassigned": f"{I} SELECT {', '.join('a.' + c.strip() for c in ALERT_COLS.split(','))}, "
    "CASE WHEN a.rule_no <= 3 THEN a.incident_id END AS incident_id FROM assigned a "
    "JOIN incidents i ON i.incident_id = a.incident_id WHERE a.rule_no > 3 OR a.dataset_id = 2",
    "ownership_alerts": f"{A}, {OWNED} SELECT {ALERT_COLS} FROM legacy",
    "ownership_incidents": f"{A}, {OWNED} SELECT incident_id, CASE WHEN count(*) = count(dataset_id) "
    "AND count(DISTINCT dataset_id) = 1 THEN min(dataset_id) END AS dataset_id, count(*) AS alert_count "
    "FROM legacy WHERE incident_id IS NOT NULL GROUP BY incident_id",
    "scope_guard": f"{A}, {OWNED} SELECT incident_id, CAST(NULL AS BIGINT) AS dataset_id, count(*) AS alert_count "
    "FROM legacy WHERE incident_id IS NOT NULL GROUP BY incident_id HAVING count(dataset_id) = 0",
    "browse_events": f"{chain()} SELECT {EVENT_COLS} FROM ev WHERE dataset_id IS NULL AND severity = 'high' "
    f"AND source_system = 'cloud_identity' AND t BETWEEN {FROM_US} AND {TO_US} "
    "ORDER BY t DESC NULLS FIRST, event_id DESC LIMIT 50 OFFSET 5",
    "browse_alerts": f"{A} SELECT {ALERT_COLS} FROM alerts WHERE dataset_id IS NULL AND severity = 'medium' "
    "AND alert_rule_name = 'Successful login from unusual IP' "
    "ORDER BY first_us DESC NULLS FIRST, rule_no DESC, anchor_t DESC, anchor_id DESC LIMIT 100 OFFSET 10",
    "browse_incidents": f"{I} SELECT * FROM incidents WHERE dataset_id IS NULL AND status = 'open' AND severity = 'high' "
    f"AND first_us >= {FROM_US} AND last_us <= {TO_US} ORDER BY first_us DESC NULLS FIRST, incident_id DESC LIMIT 40",
    "browse_dataset": f"{chain()} SELECT {EVENT_COLS} FROM ev WHERE dataset_id = 2 "
    "ORDER BY t DESC NULLS FIRST, event_id DESC LIMIT 200",
    "incident_detail": f"{B} SELECT incident_id, dataset_id, 'alert' AS item, alert_id AS item_id, alert_rule_name AS name, "
    "severity, related_username AS username, related_asset AS asset, first_us AS seen_us FROM b_alerts "
    "UNION ALL SELECT incident_id, dataset_id, 'event', event_id::VARCHAR, event_type, severity, username, asset, t FROM b_events",
    "evidence_bundle": f"{B} SELECT * FROM sizes",
    "affected_entities": f"{B} SELECT * FROM entities",
    "attack_timeline": f"{B} SELECT incident_id, event_id, {iso('t', 'T')} AS timestamp_text, source_system, event_type, "
    "username, asset, action, outcome, severity, t, normalized_message AS message FROM b_events",
    "summary_store": f"{B}, {VERSIONS} SELECT incident_id || '@' || epoch_us(CASE version WHEN 1 THEN TIMESTAMP '2024-02-01 00:00:00' "
    "ELSE TIMESTAMP '2024-02-02 00:00:00' END) AS summary_id, incident_id, event_id, t, source_system, event_type, username, asset, "
    "action, outcome, severity, normalized_message AS message, alert_count, event_count FROM held",
    "report_after_late_evidence": f"{B}, {VERSIONS}, {AS_OF} SELECT incident_id, part_no, {cut('document')} FROM "
    f"(SELECT incident_id, string_agg(text, '' ORDER BY {PIECE_ORDER}) AS document FROM doc GROUP BY 1), {parts('document')}",
    "incident_summary": f"{B} SELECT * EXCLUDE (technical_summary), {cut('technical_summary')} FROM summaries, {parts('technical_summary')}".replace("AS text", "AS technical_summary"),
    "latest_summary": f"{I}, {STORED_SUMMARIES} SELECT incident_id, dataset_id, max(summary_id) AS summary_id "
    "FROM stored GROUP BY incident_id, dataset_id",
    "missing_summaries": f"{I}, {STORED_SUMMARIES} SELECT * FROM incidents WHERE dataset_id IS NOT NULL "
    "AND incident_id NOT IN (SELECT incident_id FROM stored)",
    "evidence_prompt": f"""{B},
ids AS (
  SELECT e.dataset_id, e.alert_id, string_agg(e.event_id::VARCHAR, ', ' ORDER BY
    CASE WHEN e.event_id <> a.lead_event_id THEN 1 WHEN a.rule_no = 1 THEN 2 ELSE 0 END, v.t, e.event_id) AS ids
  FROM alert_evidence e JOIN alerts a ON a.alert_id = e.alert_id AND a.dataset_id IS NOT DISTINCT FROM e.dataset_id
  JOIN ev v ON v.event_id = e.event_id GROUP BY 1, 2
),
alert_lines AS (
  SELECT incident_id, string_agg(chr(10) || '- Alert ' || alert_id || ': ' || alert_rule_name || '; severity=' || severity
    || '; user=' || coalesce(related_username, 'None') || '; asset=' || coalesce(related_asset, 'None')
    || '; events=[' || ids.ids || ']', '' ORDER BY rule_no, anchor_t, anchor_id) AS lines
  FROM b_alerts JOIN ids USING (alert_id) GROUP BY 1
),
event_lines AS (
  SELECT incident_id, string_agg(chr(10) || '- Event ' || event_id || ': ' || {iso('t', ' ')} || '; ' || source_system || '; '
    || event_type || '; user=' || coalesce(username, 'None') || '; asset=' || coalesce(asset, 'None') || '; action='
    || coalesce(action, 'None') || '; outcome=' || coalesce(outcome, 'None') || '; message=' || coalesce(normalized_message, 'None'),
    '' ORDER BY event_id) AS lines
  FROM b_events GROUP BY 1
)
SELECT incident_id, part_no, {cut('document')} FROM (
SELECT i.incident_id, 'You are summarizing a breach investigation.' || chr(10)
  || 'Use only the incident, alert, and event evidence below.' || chr(10)
  || 'Do not invent users, assets, timelines, impacts, or containment actions.' || chr(10)
  || 'Incident: ' || i.incident_id || ' - ' || i.title || chr(10) || 'Suspected attack path: ' || i.suspected_attack_path || chr(10)
  || 'Alerts:' || a.lines || chr(10) || 'Events:' || e.lines AS document
FROM incidents i JOIN alert_lines a USING (incident_id) JOIN event_lines e USING (incident_id)), {parts('document')}""",
    "incident_report": f"{B}, {SUMMARIZED} SELECT incident_id, file_name, part_no, {cut('document')} FROM (SELECT d.incident_id, any_value(CASE WHEN i.dataset_id IS NULL THEN '' ELSE "
    "'dataset-' || i.dataset_id || '-' END || 'incident-' || i.incident_id || '-report.md') AS file_name, "
    f"string_agg(d.text, '' ORDER BY {PIECE_ORDER}) AS document FROM doc d JOIN incidents i USING (incident_id) GROUP BY d.incident_id), {parts('document')}",
    "incident_report_pieces": f"{B}, {PLAIN} SELECT * FROM doc",
    "dashboard_counts": f"{I}, {STORED_SUMMARIES}, scopes AS (SELECT DISTINCT dataset_id FROM ev) "
    "SELECT s.dataset_id, (SELECT count(*) FROM ev e WHERE e.dataset_id IS NOT DISTINCT FROM s.dataset_id) AS events, "
    "(SELECT count(*) FROM alerts e WHERE e.dataset_id IS NOT DISTINCT FROM s.dataset_id) AS alerts, "
    "(SELECT count(*) FROM incidents e WHERE e.dataset_id IS NOT DISTINCT FROM s.dataset_id) AS incidents, "
    "(SELECT count(*) FROM stored e WHERE e.dataset_id IS NOT DISTINCT FROM s.dataset_id) AS summaries, "
    "(SELECT count(DISTINCT source_system) FROM ev e WHERE e.dataset_id = s.dataset_id) AS uploads FROM scopes s",
    "dataset_state": f"{chain(ALERTS, EVIDENCE, ASSIGNED, INCIDENTS, events=SPLIT_EVENTS)}, "
    "ds AS (SELECT dataset_id, CASE source_system WHEN 'vpn' THEN 'ready_to_normalize' WHEN 'api_gateway' THEN 'workflow_complete' "
    "ELSE 'normalized' END AS status FROM ev GROUP BY dataset_id, source_system) "
    "SELECT ds.dataset_id, ds.status, count(i.incident_id) AS incidents, ds.status = 'ready_to_normalize' AS needs_normalization, "
    "ds.status = 'normalized' AND count(i.incident_id) = 0 AS needs_analysis "
    "FROM ds LEFT JOIN incidents i USING (dataset_id) GROUP BY ds.dataset_id, ds.status",
    "severity_mix": f"{chain()} SELECT dataset_id, CASE WHEN lower(coalesce(severity, '')) IN ('low', 'medium', 'high', 'critical') "
    "THEN lower(severity) ELSE 'unknown' END AS severity_class, count(*) AS n FROM ev GROUP BY 1, 2",
    "run_counters": f"""{I},
found AS (SELECT a.dataset_id, o.alert_id IS NOT NULL AS known FROM alerts a
  LEFT JOIN ({EARLY} SELECT dataset_id, alert_id FROM alerts) o
  ON o.alert_id = a.alert_id AND o.dataset_id IS NOT DISTINCT FROM a.dataset_id)
SELECT e.dataset_id, e.n AS events_analyzed, f.fresh AS alerts_created, f.known AS alerts_skipped,
  a.n AS alerts_analyzed, i.n AS incidents_created, a.n AS alerts_linked, l.n AS incident_events_linked
FROM (SELECT dataset_id, count(*) AS n FROM ev GROUP BY 1) e
JOIN (SELECT dataset_id, count(*) FILTER (NOT known) AS fresh, count(*) FILTER (known) AS known FROM found GROUP BY 1) f
  ON f.dataset_id IS NOT DISTINCT FROM e.dataset_id
JOIN (SELECT dataset_id, count(*) AS n FROM assigned GROUP BY 1) a ON a.dataset_id IS NOT DISTINCT FROM e.dataset_id
JOIN (SELECT dataset_id, count(*) AS n FROM incidents GROUP BY 1) i ON i.dataset_id IS NOT DISTINCT FROM e.dataset_id
JOIN (SELECT dataset_id, count(*) AS n FROM incident_events GROUP BY 1) l ON l.dataset_id IS NOT DISTINCT FROM e.dataset_id""",
}
