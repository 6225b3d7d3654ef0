"""DuckDB SQL for the streaming queries: the same results as over the stored feed."""

from __future__ import annotations

from oracles.base import ALERTS, chain
from oracles.ingest import S

A = chain(ALERTS)

SQL: dict[str, str] = {
    "stream_brute_force": f"{A} SELECT s.dataset_id, s.username, s.source_ip, s.event_id, s.t, g.n AS failures, "
    "g.first_t AS first_us FROM login s JOIN (SELECT sid, count(*) AS n, min(ft) AS first_t FROM r1_pairs GROUP BY sid) g "
    "ON g.sid = s.event_id WHERE g.n >= 3",
    "stream_vpn_privilege": f"{A} SELECT dataset_id, related_username AS username, lead_event_id AS event_id, anchor_t AS t, "
    "evidence_count - 1 AS actions, last_us, normalized_event_id AS last_event_id FROM r3",
    "stream_multi_high": f"{A} SELECT dataset_id, related_username AS username, lead_event_id, first_us, last_us, normalized_event_id AS last_event_id, evidence_count "
    "FROM r6",
    "stream_sessions": f"""{A},
flags AS (
  SELECT *, CASE WHEN first_us <= max(last_us) OVER (PARTITION BY dataset_id, related_username
      ORDER BY first_us, last_us, alert_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 86400000000 THEN 0 ELSE 1 END AS opens
  FROM alerts WHERE related_username <> ''
),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY dataset_id, related_username ORDER BY first_us, last_us, alert_id ROWS UNBOUNDED PRECEDING) AS session
  FROM flags
)
SELECT dataset_id, related_username AS username, min(first_us) AS first_us, max(last_us) AS last_us, count(*) AS alerts,
  max(CASE lower(severity) WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 ELSE 0 END) AS severity_rank
FROM numbered GROUP BY dataset_id, related_username, session""",
    # Both deliveries of a record carry its number, so the copy that is kept does not matter.
    "stream_ingest": f"{S} SELECT source_name, event_id AS record_no, source_system, event_type, t FROM n_all",
}
