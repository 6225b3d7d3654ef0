"""The six detection rules as DataFrame jobs, and the registry they are run from.

A rule takes canonical events and returns alert candidates for every scope at once: the
dataset id is part of every key, so one pass serves all datasets and never mixes them.

Windowed rules do not list their evidence. Each alert carries a lead event and a closed time
window over the rule's *pool* (the failures, privilege actions or serious events of one user),
so an alert row has a fixed size however busy its window is. ``operators/evidence.py`` turns
the references into ids.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.text import blank_to_null, floor_cell, none_text
from sentrel.schema import ALERT_COLUMNS
from sentrel.session import materialize

MINUTE_US = 60 * 1_000_000
HOUR_US = 60 * MINUTE_US


@dataclass(frozen=True)
class RuleSettings:
    """Thresholds and lists of the rules."""

    # Windows, thresholds and lists the rule results depend on.
    brute_force_window_us: int = 15 * MINUTE_US
    brute_force_failures: int = 3
    normal_login_ips: tuple[str, ...] = ("198.51.100.24", "10.20.5.15")
    vpn_window_us: int = 1 * HOUR_US
    privilege_actions: tuple[str, ...] = (
        "AttachUserPolicy", "CreateAccessKey", "DisableMFADevice", "UpdateSecurityGroup",
    )
    download_event_types: tuple[str, ...] = ("bulk_export", "file_archive_download")
    endpoint_event_types: tuple[str, ...] = ("credential_access", "malware_detected")
    endpoint_technique: str = "T1003.001"
    endpoint_words: tuple[str, ...] = ("credential", "malware")
    high_severities: tuple[str, ...] = ("high", "critical")
    high_window_us: int = 24 * HOUR_US


DEFAULTS = RuleSettings()


# Predicates are plain comparisons, so that they can be pushed to the scan; a comparison with
# a missing value is unknown, which a filter treats as false.


def is_login(outcome: str) -> Column:
    return (
        (F.col("source_system") == "CLOUD-IAM")
        & (F.col("event_type") == "interactive_login")
        & (F.col("action") == "login")
        & (F.col("outcome") == outcome)
    )


def is_vpn_connect() -> Column:
    return (
        (F.col("source_system") == "vpn")
        & (F.col("action") == "connect")
        & (F.col("outcome") == "success")
    )


def is_privilege_action(cfg: RuleSettings = DEFAULTS) -> Column:
    return (F.col("source_system") == "cloud_identity") & F.col("action").isin(
        *cfg.privilege_actions
    )


def is_endpoint_detection(cfg: RuleSettings = DEFAULTS) -> Column:
    message = F.lower(F.col("normalized_message"))
    signs = F.col("event_type").isin(*cfg.endpoint_event_types) | (
        F.col("mitre_technique_id") == cfg.endpoint_technique
    )
    for word in cfg.endpoint_words:
        signs = signs | message.contains(word)
    return (F.col("source_system") == "endpoint-edr") & signs


def is_serious(cfg: RuleSettings = DEFAULTS) -> Column:
    return F.lower("severity").isin(*cfg.high_severities) & has_user()


def has_user() -> Column:
    return F.col("username") != ""


# --------------------------------------------------------------------------- assembly


def _layout(rule_no: int, rule_name: str, **columns: Column) -> list[Column]:
    """A rule's columns in the alert layout; those not named are null."""
    defaults: dict[str, Column] = {
        "mitre_technique_id": F.lit(None).cast("string"),
        "evidence_ip": F.lit(None).cast("string"),
        "window_from": F.lit(None).cast("timestamp"),
        "window_to": F.lit(None).cast("timestamp"),
    }
    values = {**defaults, **columns}
    values["dataset_id"] = F.col("dataset_id")
    values["rule_no"] = F.lit(rule_no).cast("int")
    values["alert_rule_name"] = F.lit(rule_name)
    # Events are only ever appended, so windows of one lead event are nested and the count
    # tells them apart: the id names the rule and the exact evidence set.
    values["alert_id"] = F.concat_ws(
        "-", values["rule_no"], values["lead_event_id"], values["evidence_count"]
    )
    return [values[name].alias(name) for name in ALERT_COLUMNS]


def _candidate(df: DataFrame, rule_no: int, rule_name: str, **columns: Column) -> DataFrame:
    return df.select(*_layout(rule_no, rule_name, **columns))


@dataclass(frozen=True)
class SingleEvent:
    """A rule that fires on one event: where, and the alert's columns."""

    fires: Column
    columns: list[Column]


def _single_event(fires: Column, rule_no: int, rule_name: str, **columns: Column) -> SingleEvent:
    when = F.col("event_timestamp")
    return SingleEvent(fires, _layout(
        rule_no,
        rule_name,
        related_username=F.col("username"),
        related_asset=F.col("asset"),
        normalized_event_id=F.col("event_id"),
        first_seen=when,
        last_seen=when,
        evidence_count=F.lit(1).cast("bigint"),
        lead_event_id=F.col("event_id"),
        anchor_ts=when,
        anchor_id=F.col("event_id"),
        **columns,
    ))


def fired(events: DataFrame, rules: list[SingleEvent]) -> DataFrame:
    """Alerts of all these rules, in one scan; an event may fire several."""
    alerts = F.array(*(F.when(rule.fires, F.struct(*rule.columns)) for rule in rules))
    return events.where(reduce(Column.__or__, (rule.fires for rule in rules))).select(
        F.inline(F.filter(alerts, lambda alert: alert.isNotNull()))
    )


# --------------------------------------------------------------------------- rules


def brute_force(events: DataFrame, cfg: RuleSettings = DEFAULTS) -> DataFrame:
    """Three or more failed logins, then a success, same user and address, within the window.

    Counting is a running total, not a self-join: each success puts an opening mark at the
    window start and a closing mark at its own time into the ordered failures; the difference
    of the two totals is the number of failures between them. Keys are cut into window-sized
    time cells, so a busy account is many partitions; successes of one instant share their
    marks, so a cell holds no more rows than its window has instants.
    """
    keys = ["dataset_id", "username", "source_ip"]
    width = cfg.brute_force_window_us
    columns = [*keys, "event_id", "event_timestamp", "asset"]
    timed = events.where(F.col("event_timestamp").isNotNull()).withColumn("at", F.unix_micros("event_timestamp"))
    successes = timed.where(is_login("success")).select(*columns, F.col("at").alias("s_t"))

    at, nothing = F.col("at"), F.lit(None).cast("bigint")
    cell = floor_cell(at, width)

    def row(t: Column, cell: Column, mark: int, n: int, failure_t: Column, s_t: Column) -> Column:
        return F.struct(
            t.alias("t"), cell.alias("cell"), F.lit(mark).alias("mark"), F.lit(n).cast("bigint").alias("n"),
            failure_t.alias("failure_t"), s_t.alias("s_t"),
        )

    # Marks 0 and 2 sort before and after failures of the same instant: closed bounds.
    marks = F.array(row(at - width, cell, 0, 0, nothing, at), row(at, cell, 2, 0, nothing, at))
    counted_in = F.array(row(at, cell, 1, 1, at, nothing), row(at, cell + 1, 1, 1, at, nothing))
    # Partial aggregation makes a burst of equal times cost one row.
    rows = (
        timed.where(is_login("failure") | is_login("success"))
        .select(*keys, F.inline(F.when(is_login("failure"), counted_in).otherwise(marks)))
        .groupBy(*keys, "cell", "t", "mark", "failure_t", "s_t").agg(F.sum("n").alias("n"))
    )
    order = "PARTITION BY dataset_id, username, source_ip, cell ORDER BY t, mark"
    counted = (
        rows.withColumn(
            "running",
            F.expr(f"sum(n) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
        )
        .withColumn("next_t", F.expr(f"lead(failure_t, 1) IGNORE NULLS OVER ({order})"))
        .where(F.col("mark") != 1)
    )
    hits = (
        counted.groupBy(*keys, "s_t")
        .agg(
            (
                F.max(F.when(F.col("mark") == 2, F.col("running")))
                - F.max(F.when(F.col("mark") == 0, F.col("running")))
            ).alias("failures"),
            F.max(F.when(F.col("mark") == 0, F.col("next_t"))).alias("first_t"),
        )
        .where(F.col("failures") >= cfg.brute_force_failures)
    )
    hits = null_safe_join(successes, hits, [*keys, "s_t"], "inner")
    when = F.timestamp_micros("s_t")
    return _candidate(
        hits,
        1,
        "Brute force followed by successful login",
        severity=F.lit("high"),
        description=F.concat(
            none_text(F.col("username")), F.lit(" had "), F.col("failures").cast("string"),
            F.lit(" failed logins followed by a successful login from "),
            none_text(F.col("source_ip")), F.lit("."),
        ),
        related_username=F.col("username"),
        related_asset=F.col("asset"),
        mitre_technique_id=F.lit("T1110"),
        normalized_event_id=F.col("event_id"),
        first_seen=F.timestamp_micros("first_t"),
        last_seen=when,
        evidence_count=F.col("failures") + 1,
        lead_event_id=F.col("event_id"),
        evidence_ip=F.col("source_ip"),
        window_from=F.timestamp_micros("first_t"),
        window_to=when,
        anchor_ts=when,
        anchor_id=F.col("event_id"),
    )


def _unusual_ip(cfg: RuleSettings) -> SingleEvent:
    ip = F.col("source_ip")
    return _single_event(
        is_login("success") & (ip != "") & ~ip.isin(*cfg.normal_login_ips),
        2,
        "Successful login from unusual IP",
        severity=F.lit("medium"),
        description=F.concat(
            none_text(F.col("username")), F.lit(" successfully logged in from unusual IP "),
            ip, F.lit("."),
        ),
        mitre_technique_id=F.lit("T1078"),
    )


def unusual_ip(events: DataFrame, cfg: RuleSettings = DEFAULTS) -> DataFrame:
    """Successful login from an address outside the allowlist."""
    return fired(events, [_unusual_ip(cfg)])


def vpn_privilege(events: DataFrame, cfg: RuleSettings = DEFAULTS) -> DataFrame:
    """VPN connect, then privilege actions of the same user within the window.

    Same marks as :func:`brute_force`, opening at the connect and closing one window later;
    the last action seen at the closing mark is the primary event.
    """
    keys = ["dataset_id", "username"]
    width = cfg.vpn_window_us
    columns = [*keys, "event_id", "event_timestamp", "asset"]
    timed = events.where(has_user() & F.col("event_timestamp").isNotNull()).withColumn(
        "at", F.unix_micros("event_timestamp")
    )
    connects = timed.where(is_vpn_connect()).select(*columns, F.col("at").alias("v_t"))

    at = F.col("at")
    cell = floor_cell(at, width)
    event = F.struct("event_id", "asset")

    def row(t: Column, cell: Column, mark: int, n: int, last: Column, v_t: Column) -> Column:
        return F.struct(
            t.alias("t"), cell.alias("cell"), F.lit(mark).alias("mark"), F.lit(n).cast("bigint").alias("n"),
            last.alias("last"), v_t.alias("v_t"),
        )

    no_event, nothing = F.when(F.lit(False), event), F.lit(None).cast("bigint")
    marks = F.array(row(at, cell, 0, 0, no_event, at), row(at + width, cell, 2, 0, no_event, at))
    counted_in = F.array(row(at, cell, 1, 1, event, nothing), row(at, cell - 1, 1, 1, event, nothing))
    is_action = is_privilege_action(cfg)
    rows = (
        timed.where(is_action | is_vpn_connect())
        .select(*keys, F.inline(F.when(is_action, counted_in).otherwise(marks)))
        .groupBy(*keys, "cell", "t", "mark", "v_t").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        .withColumn("action", F.when(F.col("mark") == 1, F.struct("t", "last.event_id", "last.asset")))
    )
    so_far = (
        Window.partitionBy(*keys, "cell")
        .orderBy("t", "mark")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = (
        rows.withColumn("running", F.sum("n").over(so_far))
        .withColumn("latest", F.last("action", ignorenulls=True).over(so_far))
        .where(F.col("mark") != 1)
    )
    hits = (
        counted.groupBy(*keys, "v_t")
        .agg(
            (
                F.max(F.when(F.col("mark") == 2, F.col("running")))
                - F.max(F.when(F.col("mark") == 0, F.col("running")))
            ).alias("actions"),
            F.max(F.when(F.col("mark") == 2, F.col("latest"))).alias("last"),
        )
        .where(F.col("actions") >= 1)
    )
    hits = null_safe_join(connects, hits, [*keys, "v_t"], "inner")
    start = F.timestamp_micros("v_t")
    return _candidate(
        hits,
        3,
        "VPN login followed by privilege escalation",
        severity=F.lit("high"),
        description=F.concat(
            F.col("username"), F.lit(" connected to VPN and then performed "),
            F.col("actions").cast("string"), F.lit(" privilege-sensitive cloud actions."),
        ),
        related_username=F.col("username"),
        related_asset=F.coalesce(blank_to_null(F.col("last.asset")), F.col("asset")),
        mitre_technique_id=F.lit("T1098"),
        normalized_event_id=F.col("last.event_id"),
        first_seen=start,
        last_seen=F.timestamp_micros("last.t"),
        evidence_count=F.col("actions") + 1,
        lead_event_id=F.col("event_id"),
        window_from=start,
        window_to=F.timestamp_micros("last.t"),
        anchor_ts=start,
        anchor_id=F.col("event_id"),
    )


def _api_download(cfg: RuleSettings) -> SingleEvent:
    return _single_event(
        (F.col("source_system") == "api_gateway")
        & F.col("event_type").isin(*cfg.download_event_types)
        & (F.col("outcome") == "200"),
        4,
        "Suspicious API data download",
        severity=F.lit("high"),
        description=F.concat(
            none_text(F.col("username")), F.lit(" performed suspicious API download: "),
            none_text(F.col("action")), F.lit("."),
        ),
        mitre_technique_id=F.lit("T1530"),
    )


def api_download(events: DataFrame, cfg: RuleSettings = DEFAULTS) -> DataFrame:
    """Successful bulk export or archive download through the API gateway."""
    return fired(events, [_api_download(cfg)])


def _endpoint_credential(cfg: RuleSettings) -> SingleEvent:
    return _single_event(
        is_endpoint_detection(cfg),
        5,
        "Endpoint malware or credential access",
        severity=F.coalesce(blank_to_null(F.col("severity")), F.lit("high")),
        description=F.coalesce(
            blank_to_null(F.col("normalized_message")),
            F.lit("Endpoint malware or credential access activity observed."),
        ),
        mitre_technique_id=F.col("mitre_technique_id"),
    )


def endpoint_credential(events: DataFrame, cfg: RuleSettings = DEFAULTS) -> DataFrame:
    """Credential-access or malware detection on an endpoint."""
    return fired(events, [_endpoint_credential(cfg)])


def multiple_high(events: DataFrame, cfg: RuleSettings = DEFAULTS) -> DataFrame:
    """First 24-hour window in which a user has three or more serious events.

    Only the first three events of a user's day can decide where that window starts: a day
    with three events qualifies by its first one, so later ones never matter. The ranking is
    a group limit, which Spark also applies before the shuffle, so however busy a user is, a
    task passes on three rows per user and day.
    """
    keys = ["dataset_id", "username"]
    width = cfg.high_window_us
    serious = events.where(is_serious(cfg)).select(
        *keys, "event_id", "asset", F.unix_micros("event_timestamp").alias("t")
    )
    day = Window.partitionBy(*keys, "day").orderBy("t", "event_id")
    leading = (
        serious.select(*keys, "t", "event_id", floor_cell(F.col("t"), width).alias("day"))
        .withColumn("place", F.row_number().over(day))
        .where(F.col("place") <= 3)
    )
    # Events without a time come first in a user's order and never start a window.
    by_user = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("t"), "event_id")
    starts = (
        leading.withColumn("third_t", F.lead("t", 2).over(by_user))
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("third_t") <= F.col("t") + width, F.struct("t", "event_id")))
            .alias("start"),
            F.min(F.struct("t", "event_id")).alias("anchor"),
        )
        .where(F.col("start").isNotNull())
        .select(
            *keys,
            F.col("start.t").alias("start_t"),
            F.col("start.event_id").alias("start_id"),
            F.col("anchor.t").alias("anchor_t"),
            F.col("anchor.event_id").alias("anchor_id"),
        )
    )
    cells = F.explode(
        F.sequence(
            floor_cell(F.col("start_t"), width), floor_cell(F.col("start_t") + width, width)
        )
    )
    windows = starts.withColumn("day", cells)
    members = serious.withColumn("day", floor_cell(F.col("t"), width))
    joined = null_safe_join(members, windows, [*keys, "day"], "inner").where(
        F.col("t").between(F.col("start_t"), F.col("start_t") + width)
    )
    hits = joined.groupBy(*keys, "start_t", "start_id", "anchor_t", "anchor_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("t", "event_id", "asset")).alias("last"),
    )
    start = F.timestamp_micros("start_t")
    return _candidate(
        hits,
        6,
        "Multiple high-severity events by same user within 24 hours",
        severity=F.lit("critical"),
        description=F.concat(
            F.col("username"), F.lit(" generated "), F.col("n").cast("string"),
            F.lit(" high or critical events within 24 hours."),
        ),
        related_username=F.col("username"),
        related_asset=F.col("last.asset"),
        normalized_event_id=F.col("last.event_id"),
        first_seen=start,
        last_seen=F.timestamp_micros("last.t"),
        evidence_count=F.col("n"),
        lead_event_id=F.col("start_id"),
        window_from=start,
        window_to=F.timestamp_micros("last.t"),
        anchor_ts=F.timestamp_micros("anchor_t"),
        anchor_id=F.col("anchor_id"),
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which a missing key matches a missing key; keys are kept once."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"__{key}"])
    joined = left.join(renamed, condition, how)
    return joined.drop(*(f"__{key}" for key in keys))


# --------------------------------------------------------------------------- registry


@dataclass(frozen=True)
class Rule:
    """A rule and, if it is windowed, the pool its windows refer to.

    ``lead_last`` says whether the lead event ends or starts the evidence list. Alerts of a windowed rule must only refer to events of the alert's own user.
    """

    rule_no: int
    candidates: Callable[[DataFrame, RuleSettings], DataFrame]
    pool: Callable[[RuleSettings], Column] | None = None
    pool_by_ip: bool = False
    lead_last: bool = False
    width_us: Callable[[RuleSettings], int] | None = None
    #: The events the rule looks at; without it, all.
    reads: Callable[[RuleSettings], Column] | None = None
    #: For a rule that fires on one event: those of a registry share one scan.
    single: Callable[[RuleSettings], SingleEvent] | None = None


RULES: tuple[Rule, ...] = (
    Rule(1, brute_force, pool=lambda cfg: is_login("failure"), pool_by_ip=True, lead_last=True,
         width_us=lambda cfg: cfg.brute_force_window_us,
         reads=lambda cfg: is_login("failure") | is_login("success")),
    Rule(2, unusual_ip, single=_unusual_ip),
    Rule(3, vpn_privilege, pool=is_privilege_action, width_us=lambda cfg: cfg.vpn_window_us,
         reads=lambda cfg: is_privilege_action(cfg) | is_vpn_connect()),
    Rule(4, api_download, single=_api_download),
    Rule(5, endpoint_credential, single=_endpoint_credential),
    Rule(6, multiple_high, pool=is_serious, width_us=lambda cfg: cfg.high_window_us, reads=is_serious),
)


def relevant_events(
    events: DataFrame, rules: tuple[Rule, ...] = RULES, cfg: RuleSettings = DEFAULTS
) -> DataFrame:
    """The events that some rule looks at, written once: the only scan of the event table itself.

    Every lead and every pool event of an alert is among them.
    """
    masks = [
        rule.single(cfg).fires if rule.single else rule.reads(cfg) if rule.reads else F.lit(True) for rule in rules
    ]
    return materialize(events.where(reduce(Column.__or__, masks)), "rule-events")


def detect(
    events: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    cfg: RuleSettings = DEFAULTS,
) -> DataFrame:
    """All candidates of all rules, for all scopes, from one scan of the events."""
    return detect_in(relevant_events(events, rules, cfg), rules, cfg)


def detect_in(
    relevant: DataFrame, rules: tuple[Rule, ...] = RULES, cfg: RuleSettings = DEFAULTS
) -> DataFrame:
    """The same, from the events that the rules look at; single-event rules share one scan of them."""
    single = [rule.single(cfg) for rule in rules if rule.single]
    found = [rule.candidates(relevant, cfg) for rule in rules if not rule.single]
    return reduce(DataFrame.unionByName, found + ([fired(relevant, single)] if single else []))


def in_scope(df: DataFrame, dataset_id: int | None) -> DataFrame:
    """Rows of one dataset, or of the built-in sample when no dataset is given."""
    if dataset_id is None:
        return df.where(F.col("dataset_id").isNull())
    return df.where(F.col("dataset_id") == dataset_id)


def new_alerts(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates whose scope, rule and evidence are not stored yet.

    The alert id spells out rule, lead event and evidence size, so equal ids in one scope are
    equal evidence sets.
    """
    known = stored.select(F.col("dataset_id").alias("__scope"), F.col("alert_id").alias("__id"))
    return candidates.join(
        known,
        candidates["dataset_id"].eqNullSafe(known["__scope"])
        & (candidates["alert_id"] == known["__id"]),
        "left_anti",
    )


def alert_order(prefix: str = "") -> Column:
    """Sort key of alerts: time, then creation order (rule, then anchor event)."""
    return F.struct(
        F.coalesce(f"{prefix}first_seen", f"{prefix}last_seen").alias("t"),
        F.col(f"{prefix}rule_no").alias("rule_no"),
        F.col(f"{prefix}anchor_ts").alias("anchor_ts"),
        F.col(f"{prefix}anchor_id").alias("anchor_id"),
        F.col(f"{prefix}alert_id").alias("alert_id"),
    )
