"""Markdown reports, as ordered document pieces for all incidents at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrel.functions.text import blank_to_null, display, utc_text
from sentrel.operators.summary import Evidence, instant, pieces
from sentrel.session import materialize

# Wording and layout of the report.
NO_DESCRIPTION = "No incident description is available."
NO_TIMELINE = "No timeline events are available."
NO_ALERTS = "No alerts are linked to this incident."
NO_IDS = "No evidence event IDs are available."
NO_STEPS = "No containment recommendations are available."
TABLE_HEAD = "| Rule | Severity | User | Asset | Description |\n| --- | --- | --- | --- | --- |\n"
CLOSING = "\n".join(
    [
        "",
        "## Analyst Notes",
        "",
        "_Add analyst observations, validation results, decisions, and follow-up actions here._",
        "",
        "## Limitations",
        "",
        "- This report is generated from incident, alert, event, and summary data currently stored in the platform.",
        "- Missing or incomplete source telemetry may affect the investigation narrative.",
        "- AI-assisted content should be validated by a qualified analyst before operational or legal use.",
        "- This Markdown export is intended for investigation support and is not a formal forensic report.",
        "",
    ]
)


def _cell(value: Column) -> Column:
    """Table cell: pipes escaped, line breaks flattened."""
    return F.replace(
        F.replace(display(value), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")
    )


def report_name() -> Column:
    """File name of an incident's report."""
    sample = F.concat(F.lit("incident-"), F.col("incident_id"), F.lit("-report.md"))
    owned = F.concat(
        F.lit("dataset-"), F.col("dataset_id").cast("string"), F.lit("-"), sample
    )
    return F.coalesce(owned, sample)


def report_pieces(
    evidence: Evidence, generated_at: Column, summaries: DataFrame | None = None,
    timeline: DataFrame | None = None,
) -> DataFrame:
    """Report of every visible incident as (incident_id, section, place, text) pieces.

    ``summaries`` holds at most one summary per incident (see ``summary.latest_summary``);
    incidents without one get the fallback wording. A report shows the timeline and the evidence
    ids that its summary rests on: ``timeline`` holds them as stored with these summaries
    (``incident_id, event_id, event_timestamp, source_system, event_type``), whatever evidence
    came later; without it the summaries are taken to be of now. Where a summary's timeline is empty,
    the timeline section lists today's events. Concatenating an incident's texts in (section,
    place) order gives its document.
    """
    shown, own_alerts, own_events = evidence.incidents, evidence.alerts, evidence.events
    alert_counts = own_alerts.groupBy("incident_id").agg(F.count(F.lit(1)).alias("alerts"))
    event_counts = _counted(own_events, "events", "smallest")
    if timeline is None:
        held_counts = event_counts.toDF("incident_id", "held", "smallest_held")
    else:
        held_counts = _counted(timeline, "held", "smallest_held")
    heads = (
        shown.join(alert_counts, "incident_id", "left")
        .join(event_counts, "incident_id", "left")
        .join(held_counts, "incident_id", "left")
        .fillna(0, ["alerts", "events", "held"])
    )
    if summaries is None:
        heads = heads.select(
            "*",
            F.lit(None).cast("string").alias("executive_summary"),
            F.lit(None).cast("string").alias("technical_summary"),
            F.lit(None).cast("array<string>").alias("recommended_containment_steps"),
        )
    else:
        heads = heads.join(
            summaries.select(
                "incident_id", "executive_summary", "technical_summary",
                "recommended_containment_steps",
            ),
            "incident_id",
            "left",
        )
    heads = materialize(heads, "report-heads")
    summarized = F.col("technical_summary").isNotNull()
    executive = F.coalesce(
        "executive_summary",
        F.concat(
            F.lit("Incident "), F.col("incident_id"), F.lit(" is a "),
            display(F.col("severity")), F.lit(" severity investigation affecting "),
            display(F.col("affected_user")),
            F.lit(". Generate an LLM summary for a richer narrative."),
        ),
    )
    technical = F.coalesce(
        "technical_summary",
        F.concat(
            F.lit("The incident currently contains "), F.col("alerts").cast("string"),
            F.lit(" linked alerts and "), F.col("events").cast("string"),
            F.lit(" normalized evidence events."),
        ),
    )
    assets = F.coalesce(
        blank_to_null(F.array_join("affected_assets", ", ")), F.lit("Not identified")
    )
    opening = F.concat(
        F.lit("# Incident Investigation Report: "), F.col("title"),
        F.lit("\n\n**Generated:** "), utc_text(generated_at),
        F.lit("\n**Incident ID:** "), F.col("incident_id"),
        F.lit("\n\n## Incident Overview\n\n"),
        F.coalesce(blank_to_null(F.col("description")), F.lit(NO_DESCRIPTION)),
        F.lit("\n\n- **Severity:** "), display(F.col("severity")),
        F.lit("\n- **Status:** "), display(F.col("status")),
        F.lit("\n- **Affected user:** "), display(F.col("affected_user")),
        F.lit("\n- **Affected assets:** "), assets,
        F.lit("\n- **First seen:** "), utc_text(F.col("first_seen")),
        F.lit("\n- **Last seen:** "), utc_text(F.col("last_seen")),
        F.lit("\n- **Suspected attack path:** "), display(F.col("suspected_attack_path")),
        F.lit("\n\n## Executive Summary\n\n"), executive,
        F.lit("\n\n## Technical Summary\n\n"), technical,
    )
    told = summarized & (F.col("held") > 0)
    timeline_opening = F.concat(
        F.when(summarized, F.lit(".")).otherwise(F.lit("")),
        F.lit("\n\n## Attack Timeline\n\n"),
        F.when(~told & (F.col("events") == 0), F.lit(NO_TIMELINE + "\n")).otherwise(F.lit("")),
    )
    alerts_opening = F.concat(
        F.lit("\n## Triggered Alerts\n\n"),
        F.when(F.col("alerts") == 0, F.lit(NO_ALERTS + "\n")).otherwise(F.lit(TABLE_HEAD)),
    )
    ids_opening = F.concat(
        F.lit("\n## Evidence Event IDs\n\n"),
        F.when(F.when(summarized, F.col("held")).otherwise(F.col("events")) == 0, F.lit(NO_IDS))
        .otherwise(F.lit("")),
    )
    steps = F.col("recommended_containment_steps")
    bullets = F.array_join(
        F.transform(steps, lambda step: F.concat(F.lit("- "), step)), "\n"
    )
    ending = F.concat(
        F.lit("\n\n## Recommended Containment Steps\n\n"),
        F.coalesce(blank_to_null(bullets), F.lit(NO_STEPS)),
        F.lit("\n" + CLOSING),
    )
    def line(*ending: Column) -> Column:
        return F.concat(
            F.lit("- **"), utc_text(F.col("event_timestamp")), F.lit("** - Event "),
            F.col("event_id").cast("string"), F.lit(": "), display(F.col("source_system")),
            F.lit(" / "), display(F.col("event_type")), *ending, F.lit("\n"),
        )

    alert_line = F.concat(
        F.lit("| "),
        F.concat_ws(
            " | ",
            *(
                _cell(F.col(name))
                for name in (
                    "alert_rule_name", "severity", "related_username", "related_asset",
                    "description",
                )
            ),
        ),
        F.lit(" |\n"),
    )
    # Every head and every event is read once and gives all its pieces.
    head_pieces = [
        _piece(section, text)
        for section, text in (
            (1, opening), (3, timeline_opening), (5, alerts_opening), (7, ids_opening), (9, ending)
        )
    ]

    def listed(smallest: str) -> Column:
        first = F.when(F.col("event_id") == F.col(smallest), F.lit("")).otherwise(F.lit(", "))
        return F.concat(first, F.col("event_id").cast("string"))

    event, when = F.col("event_id"), instant(F.col("event_timestamp"))
    # A stored timeline names system and type; today's adds the message.
    of_summary = F.array(
        _piece(2, listed("smallest_held"), event), _piece(4, line(), when, event),
        _piece(8, listed("smallest_held"), event),
    )
    fallback = _piece(4, line(F.lit(" - "), display(F.col("normalized_message"))), when, event)
    of_today = F.array(fallback, _piece(8, listed("smallest"), event))
    marks = heads.select("incident_id", summarized.alias("summarized"), told.alias("told"), "smallest", "smallest_held")
    today = own_events.join(marks, "incident_id")
    if timeline is None:
        events = today.select("incident_id", F.inline(F.when(F.col("told"), of_summary).otherwise(of_today)))
    else:
        events = today.where(~F.col("told")).select(
            "incident_id", F.inline(F.when(F.col("summarized"), F.array(fallback)).otherwise(of_today))
        ).unionByName(
            timeline.join(marks.where("told"), "incident_id").select("incident_id", F.inline(of_summary))
        )
    return (
        heads.select("incident_id", F.inline(F.array(*head_pieces)))
        .unionByName(events)
        .unionByName(
            pieces(
                own_alerts, 6, alert_line,
                F.col("rule_no"), instant(F.col("anchor_ts")), F.col("anchor_id"),
            )
        )
    )


def _counted(events: DataFrame, count: str, smallest: str) -> DataFrame:
    return events.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias(count), F.min("event_id").alias(smallest)
    )


def _piece(section: int, text: Column, *place: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        F.array(*(part.cast("bigint") for part in place)).cast("array<bigint>").alias("place"),
        text.alias("text"),
    )
