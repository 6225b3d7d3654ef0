"""Evidence bundles, summaries and prompts, for all incidents at once.

Texts that list event ids grow with the evidence, so they are produced as ordered pieces
(``section``, ``place`` and ``text``) whose concatenation is the document. No incident is ever
folded into a single row on the way. ``document_parts`` joins them
into numbered parts of a fixed length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.text import blank_to_null, iso_text, none_text
from sentrel.operators.browse import visible_incidents
from sentrel.operators.rules import RULES, Rule
from sentrel.session import materialize

#: Characters of one part of a document.
PART_LENGTH = 8192

# Provider name and the wording of summaries and prompts.
MODEL_NAME = "mock-deterministic-v1"
FIRST_STEPS = (
    "Preserve incident evidence and keep original normalized event IDs attached to the case.",
    "Review and validate each alert before taking irreversible remediation action.",
)
USER_STEP = "Disable or reset sessions for affected user accounts: "
ASSET_STEP = "Isolate or increase monitoring on affected assets: "
LAST_STEPS = (
    "Revoke suspicious access keys, tokens, and VPN sessions tied to the incident.",
    "Review API export activity and confirm whether data left the environment.",
)
PROMPT_RULES = (
    "You are summarizing a breach investigation.",
    "Use only the incident, alert, and event evidence below.",
    "Do not invent users, assets, timelines, impacts, or containment actions.",
)


@dataclass(frozen=True)
class Evidence:
    """Scoped evidence of the visible incidents: three tables keyed by ``incident_id``."""

    incidents: DataFrame
    alerts: DataFrame
    events: DataFrame


def _in_incident_scope(rows: DataFrame, incidents: DataFrame) -> DataFrame:
    """Rows of the given incidents whose scope is their incident's scope."""
    head = incidents.select("incident_id", F.col("dataset_id").alias("__scope"))
    joined = rows.join(head, "incident_id")
    return joined.where(F.col("__scope").eqNullSafe(F.col("dataset_id"))).drop("__scope")


def gather_evidence(
    incidents: DataFrame, alerts: DataFrame, links: DataFrame, events: DataFrame
) -> Evidence:
    """Evidence of all visible incidents, other scopes' alerts and events left out.

    All three are written once, since everything below reads them several times and the event
    table itself is by far the largest input.
    """
    shown = visible_incidents(incidents, alerts)
    evidence = links.select("incident_id", "event_id").distinct().join(events, "event_id")
    shown = materialize(shown, "visible-incidents")
    return Evidence(
        shown,
        materialize(_in_incident_scope(alerts, shown), "incident-alerts"),
        materialize(_in_incident_scope(evidence, shown), "incident-evidence"),
    )


def evidence_bundle(evidence: Evidence) -> DataFrame:
    """Size and id range of the scoped evidence of every visible incident."""
    alert_counts = evidence.alerts.groupBy("incident_id").agg(F.count(F.lit(1)).alias("alerts"))
    event_counts = evidence.events.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_id").alias("first_event_id"),
        F.max("event_id").alias("last_event_id"),
    )
    return (
        evidence.incidents.select("incident_id", "dataset_id")
        .join(alert_counts, "incident_id", "left")
        .join(event_counts, "incident_id", "left")
        .select(
            "incident_id", "dataset_id",
            F.coalesce("alerts", F.lit(0)).alias("alerts"),
            F.coalesce("events", F.lit(0)).alias("events"),
            "first_event_id", "last_event_id",
        )
    )


def affected_entities(evidence: Evidence) -> DataFrame:
    """(incident_id, kind, value): distinct users and assets over incident, alerts, events."""
    pairs = F.explode(
        F.array(
            F.struct(F.lit("user").alias("kind"), F.col("user").alias("value")),
            F.struct(F.lit("asset").alias("kind"), F.col("asset").alias("value")),
        )
    )
    own = evidence.incidents.select(
        "incident_id", F.lit("user").alias("kind"), F.col("affected_user").alias("value")
    ).unionByName(
        evidence.incidents.select(
            "incident_id", F.lit("asset").alias("kind"),
            F.explode("affected_assets").alias("value"),
        )
    )
    from_alerts = evidence.alerts.select(
        "incident_id", F.col("related_username").alias("user"), F.col("related_asset").alias("asset")
    )
    from_events = evidence.events.select("incident_id", F.col("username").alias("user"), "asset")
    spread = from_alerts.unionByName(from_events).select("incident_id", pairs.alias("pair"))
    return (
        own.unionByName(spread.select("incident_id", "pair.kind", "pair.value"))
        .where(blank_to_null(F.col("value")).isNotNull())
        .distinct()
    )


def attack_timeline(evidence: Evidence) -> DataFrame:
    """Timeline entries of every visible incident; order by ``timestamp`` (nulls first), id."""
    return evidence.events.select(
        "incident_id",
        "event_id",
        F.col("event_timestamp").alias("timestamp"),
        iso_text(F.col("event_timestamp")).alias("timestamp_text"),
        "source_system", "event_type", "username", "asset", "action", "outcome", "severity",
        F.col("normalized_message").alias("message"),
    )


def _name_list(rows: DataFrame, name: str, column: str) -> DataFrame:
    """Distinct names per incident, sorted and joined; callers pass distinct names only."""
    return rows.groupBy("incident_id").agg(
        F.array_join(F.array_sort(F.collect_list(column)), ", ").alias(name)
    )


def summarize(evidence: Evidence) -> DataFrame:
    """One summary per visible incident.

    ``technical_summary`` ends where the list of evidence ids begins; the ids themselves are
    the incident's links, and ``technical_pieces`` yields the full text.
    """
    entities = affected_entities(evidence)
    names = entities.groupBy("incident_id").agg(
        *(
            F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("value")))).alias(column)
            for kind, column in (("user", "affected_users"), ("asset", "affected_assets"))
        )
    )
    rule_names = _name_list(
        evidence.alerts.select(
            "incident_id", blank_to_null(F.col("alert_rule_name")).alias("rule")
        ).where("rule IS NOT NULL").distinct(),
        "rules", "rule",
    )
    sizes = evidence_bundle(evidence).drop("dataset_id")
    rows = (
        evidence.incidents.drop("affected_assets")
        .join(sizes, "incident_id")
        .join(names, "incident_id", "left")
        .join(rule_names, "incident_id", "left")
    )
    empty = F.array().cast("array<string>")
    users = F.coalesce("affected_users", empty)
    assets = F.coalesce("affected_assets", empty)
    user_text = blank_to_null(F.array_join(users, ", "))
    asset_text = blank_to_null(F.array_join(assets, ", "))
    executive = F.concat(
        F.lit("Incident "), F.col("incident_id"), F.lit(" is a "),
        F.coalesce(blank_to_null(F.col("severity")), F.lit("unknown")),
        F.lit(" severity investigation involving "),
        F.coalesce(user_text, F.lit("unknown users")), F.lit(" and "),
        F.coalesce(asset_text, F.lit("unknown assets")),
        F.lit(". The suspected attack path is: "),
        F.coalesce(blank_to_null(F.col("suspected_attack_path")), F.lit("not available")),
        F.lit("."),
    )
    technical = F.concat(
        F.lit("Correlated "), F.col("alerts").cast("string"), F.lit(" alerts and "),
        F.col("events").cast("string"), F.lit(" normalized events. Alert rules observed: "),
        F.coalesce("rules", F.lit("none")), F.lit(". Evidence event IDs: "),
    )
    steps = F.filter(
        F.array(
            *(F.lit(step) for step in FIRST_STEPS),
            F.concat(F.lit(USER_STEP), user_text, F.lit(".")),
            F.concat(F.lit(ASSET_STEP), asset_text, F.lit(".")),
            *(F.lit(step) for step in LAST_STEPS),
        ),
        lambda step: step.isNotNull(),
    )
    return rows.select(
        "incident_id",
        "dataset_id",
        F.lit(MODEL_NAME).alias("model_name"),
        executive.alias("executive_summary"),
        technical.alias("technical_summary"),
        users.alias("affected_users"),
        assets.alias("affected_assets"),
        "suspected_attack_path",
        steps.alias("recommended_containment_steps"),
        F.col("alerts").alias("alert_count"),
        F.col("events").alias("event_count"),
    )


def latest_summary(summaries: DataFrame) -> DataFrame:
    """The newest stored summary of each incident."""
    newest = Window.partitionBy("incident_id").orderBy(F.desc("created_at"), F.desc("summary_id"))
    return (
        summaries.withColumn("__place", F.row_number().over(newest))
        .where(F.col("__place") == 1)
        .drop("__place")
    )


def missing_summaries(incidents: DataFrame, summaries: DataFrame) -> DataFrame:
    """Dataset-owned incidents that have no summary yet."""
    return incidents.where(F.col("dataset_id").isNotNull()).join(
        summaries.select("incident_id"), "incident_id", "left_anti"
    )


# --------------------------------------------------------------------------- pieces


def pieces(rows: DataFrame, section: int, text: Column, *place: Column) -> DataFrame:
    """Rows as document pieces, ordered by section and then by ``place``."""
    return rows.select(
        "incident_id",
        F.lit(section).alias("section"),
        F.array(*(part.cast("bigint") for part in place)).cast("array<bigint>").alias("place"),
        text.alias("text"),
    )


def instant(value: Column) -> Column:
    """Sortable instant; a missing time sorts first."""
    return F.coalesce(F.unix_micros(value), F.lit(-(2**62)).cast("bigint"))


def id_pieces(evidence_ids: DataFrame, section: int) -> DataFrame:
    """Comma-separated ids, one piece each; the smallest id carries no separator."""
    smallest = evidence_ids.groupBy("incident_id").agg(F.min("event_id").alias("smallest"))
    separator = F.when(F.col("event_id") == F.col("smallest"), F.lit("")).otherwise(F.lit(", "))
    return pieces(
        evidence_ids.join(smallest, "incident_id"),
        section,
        F.concat(separator, F.col("event_id").cast("string")),
        F.col("event_id"),
    )


def technical_pieces(summaries: DataFrame, evidence_ids: DataFrame) -> DataFrame:
    """The full technical summary as pieces."""
    listed = evidence_ids.join(summaries.select("incident_id"), "incident_id", "left_semi")
    return (
        pieces(summaries, 1, F.col("technical_summary"))
        .unionByName(id_pieces(listed, 2))
        .unionByName(pieces(summaries, 3, F.lit(".")))
    )


def document_parts(all_pieces: DataFrame, length: int = PART_LENGTH) -> DataFrame:
    """(incident_id, part_no, text): every document cut into parts of ``length`` characters.

    The parts in order are the document, whatever its size; only the last part is shorter. Pieces
    are sorted over ranges that may cut inside a document. Each range's share of a document is
    summed up, so that a piece finds its offset without its document being gathered.
    """
    order = ["incident_id", "section", "place"]
    placed = materialize(
        all_pieces.where(F.length("text") > 0).orderBy(*order)
        .withColumn("row", F.monotonically_increasing_id())
        # Ranges are cut further: a block holds at most 4,096 neighbouring pieces.
        .withColumn("block", F.shiftright("row", 12)).select("incident_id", "row", "block", "text"),
        "document-pieces",
    )
    in_block = Window.partitionBy("incident_id", "block").orderBy("row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = Window.partitionBy("incident_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row stands for a block here.
    blocks = (
        placed.groupBy("incident_id", "block").agg(F.sum(F.length("text")).alias("size"))
        .withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0))).drop("size")
    )
    start = F.col("before") + F.coalesce(F.sum(F.length("text")).over(in_block), F.lit(0))
    spans = placed.join(blocks, ["incident_id", "block"]).withColumn("start", start)
    last = F.col("start") + F.length("text") - 1
    cuts = spans.withColumn(
        "part_no",
        F.explode(F.sequence(F.floor(F.col("start") / length), F.floor(last / length))),
    )
    begin = F.greatest(F.col("part_no") * length - F.col("start"), F.lit(0))
    end = F.least((F.col("part_no") + 1) * length - F.col("start"), F.length("text"))
    cuts = cuts.withColumn(
        "text", F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("row", "text")))
    return cuts.groupBy("incident_id", "part_no").agg(
        F.array_join(F.transform(ordered, lambda piece: piece["text"]), "").alias("text")
    )


def prompt_pieces(
    evidence: Evidence, alert_evidence: DataFrame, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Evidence prompt of every visible incident, as pieces.

    ``alert_evidence`` comes from ``evidence.alert_evidence``. Lines: fixed rules, incident,
    one per alert with its event ids, one per event.
    """
    shown, own_alerts = evidence.incidents, evidence.alerts
    header = F.concat(
        F.lit("\n".join(PROMPT_RULES) + "\nIncident: "),
        F.col("incident_id"), F.lit(" - "), none_text(F.col("title")),
        F.lit("\nSuspected attack path: "), none_text(F.col("suspected_attack_path")),
        F.lit("\nAlerts:"),
    )
    line_start = F.concat(
        F.lit("\n- Alert "), F.col("alert_id"), F.lit(": "),
        none_text(F.col("alert_rule_name")), F.lit("; severity="), none_text(F.col("severity")),
        F.lit("; user="), none_text(F.col("related_username")),
        F.lit("; asset="), none_text(F.col("related_asset")), F.lit("; events=["),
    )
    created = [F.col("rule_no"), instant(F.col("anchor_ts")), F.col("anchor_id")]
    ids = alert_evidence.select(
        F.col("dataset_id").alias("__scope"), F.col("alert_id").alias("__alert"),
        "event_id", "lead", "t",
    )
    listed = own_alerts.join(
        ids,
        own_alerts["dataset_id"].eqNullSafe(ids["__scope"])
        & (own_alerts["alert_id"] == ids["__alert"]),
    )
    # Every list either starts or ends with its lead event, so only the lead has no comma.
    lead_last = F.col("rule_no").isin(*(rule.rule_no for rule in rules if rule.lead_last))
    id_text = F.col("event_id").cast("string")
    id_item = (
        F.when(F.col("lead"), id_text)
        .when(lead_last, F.concat(id_text, F.lit(", ")))
        .otherwise(F.concat(F.lit(", "), id_text))
    )
    inside = F.when(~F.col("lead"), 1).when(lead_last, 2).otherwise(0)
    event_line = F.concat(
        F.lit("\n- Event "), F.col("event_id").cast("string"), F.lit(": "),
        none_text(F.replace(iso_text(F.col("event_timestamp")), F.lit("T"), F.lit(" "))),
        F.lit("; "), none_text(F.col("source_system")), F.lit("; "),
        none_text(F.col("event_type")), F.lit("; user="), none_text(F.col("username")),
        F.lit("; asset="), none_text(F.col("asset")), F.lit("; action="),
        none_text(F.col("action")), F.lit("; outcome="), none_text(F.col("outcome")),
        F.lit("; message="), none_text(F.col("normalized_message")),
    )
    step = F.lit
    parts = [
        pieces(shown, 1, header),
        pieces(own_alerts, 2, line_start, *created, step(0)),
        pieces(listed, 2, id_item, *created, step(1), inside, F.col("t"), F.col("event_id")),
        pieces(own_alerts, 2, F.lit("]"), *created, step(2)),
        pieces(shown, 3, F.lit("\nEvents:")),
        pieces(evidence.events, 4, event_line, F.col("event_id")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
