"""Group alerts into incidents.

The grouping rule is first-fit in alert order: an alert joins the first open group that
shares evidence, its user, or (when neither side has a user) its asset, and that was active
within 24 hours; otherwise it opens a group. Three exact ways to compute it:

* Alerts with a user. Rules never mix users in one alert, so first-fit is gaps-and-islands
  per (scope, user). Alerts whose first-seen times fall in the same 24-hour cell always
  share a group, so cells, not alerts, are windowed: a user has one row per active day.
* Alerts without a user whose asset is not tied to another asset: the same, per asset.
* Alerts without a user on assets tied together by shared login evidence: order matters, so
  the literal first-fit runs over each component in sorted order, as a stream that holds
  only the groups still open.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.functions.text import blank_to_null, floor_cell, severity_rank
from sentrel.operators.rules import HOUR_US, null_safe_join
from sentrel.session import materialize

# Fixed value: alerts further apart than this do not correlate.
CORRELATION_GAP_US = 24 * HOUR_US

_ORDER = ("first_t", "rule_no", "anchor_t", "anchor_id", "alert_id")


def _timed(alerts: DataFrame, run_at: Column | None) -> DataFrame:
    """Add first/last times with their fallbacks, and the normalised identity columns."""
    created = F.lit(None).cast("timestamp") if run_at is None else run_at
    return alerts.select(
        "*",
        F.unix_micros(F.coalesce("first_seen", "last_seen", created)).alias("first_t"),
        F.unix_micros(F.coalesce("last_seen", "first_seen", created)).alias("last_t"),
        F.unix_micros("anchor_ts").alias("anchor_t"),
        blank_to_null(F.col("related_username")).alias("user"),
        blank_to_null(F.col("related_asset")).alias("asset"),
    )


def _day_islands(timed: DataFrame, keys: list[str], gap_us: int) -> DataFrame:
    """Gaps-and-islands over (keys, cell): which group each cell belongs to."""
    cells = timed.groupBy(*keys, "cell").agg(
        F.min("first_t").alias("cell_first"),
        F.max("last_t").alias("cell_last"),
        F.min(F.struct(*_ORDER)).alias("opener"),
    )
    in_order = Window.partitionBy(*keys).orderBy("cell")
    reach = F.max("cell_last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = reach.isNull() | (F.col("cell_first") > reach + gap_us)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        cells.withColumn("opens", opens)
        .withColumn(
            "group_opener",
            F.last(F.when(F.col("opens"), F.col("opener.alert_id")), True).over(so_far),
        )
        .select(*keys, "cell", "group_opener")
    )


def _islands(timed: DataFrame, keys: list[str], gap_us: int) -> DataFrame:
    celled = timed.withColumn("cell", floor_cell(F.col("first_t"), gap_us))
    groups = _day_islands(celled, keys, gap_us)
    return null_safe_join(celled, groups, [*keys, "cell"], "left").drop("cell")


def _login_chains(logins: DataFrame, cell_us: int) -> DataFrame:
    """Chains of user-less login alerts that share failed logins.

    Two brute-force alerts of one address share a failure exactly when their spans touch, so
    chains are islands with no gap. Two levels keep a busy address from being one partition:
    inside a time cell, then across cells.
    """
    keys = ["dataset_id", "evidence_ip"]
    celled = logins.withColumn("cell", floor_cell(F.col("first_t"), cell_us))
    inner = Window.partitionBy(*keys, "cell").orderBy(*_ORDER)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    celled = celled.withColumn("inner_reach", F.max("last_t").over(before))

    across = Window.partitionBy(*keys).orderBy("cell")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        celled.groupBy(*keys, "cell").agg(F.max("last_t").alias("cell_last"))
        .withColumn("outer_reach", F.max("cell_last").over(earlier))
        .drop("cell_last")
    )
    marked = null_safe_join(celled, reach, [*keys, "cell"], "left")
    so_far = F.greatest("inner_reach", "outer_reach")
    marked = marked.withColumn(
        "opened_t", F.when(so_far.isNull() | (F.col("first_t") > so_far), F.col("first_t"))
    ).withColumn("inner_open", F.max("opened_t").over(upto))
    opens = (
        marked.groupBy(*keys, "cell").agg(F.max("opened_t").alias("cell_open"))
        .withColumn("outer_open", F.max("cell_open").over(earlier))
        .drop("cell_open")
    )
    return null_safe_join(marked, opens, [*keys, "cell"], "left").withColumn(
        "chain",
        F.to_json(
            F.struct(
                "dataset_id", "evidence_ip",
                F.coalesce("inner_open", "outer_open").alias("open_t"),
            )
        ),
    )


def _components(ties: DataFrame) -> DataFrame:
    """Connected components of (chain, asset_node) ties by repeated minimum labels."""
    ties = materialize(ties, "ties")
    labels = ties.select("asset_node").distinct().withColumn("label", F.col("asset_node"))
    while True:
        chains = ties.join(labels, "asset_node").groupBy("chain").agg(F.min("label").alias("low"))
        fresh = (
            ties.join(chains, "chain").groupBy("asset_node").agg(F.min("low").alias("low"))
            .join(labels, "asset_node")
            .select(
                "asset_node",
                F.least("low", "label").alias("label"),
                (F.col("low") < F.col("label")).alias("moved"),
            )
        )
        fresh = materialize(fresh, "labels")
        labels = fresh.drop("moved")
        if fresh.where("moved").isEmpty():
            return labels


def _asset_node() -> Column:
    return F.when(F.col("asset").isNotNull(), F.to_json(F.struct("dataset_id", "asset")))


class _OpenGroup:
    """A group that can still take alerts, as the first-fit stream holds it."""

    def __init__(self, opener: str) -> None:
        self.opener = opener
        self.assets: set[str] = set()
        self.last = 0
        self.reach: dict[str, int] = {}
        self.leads: dict[int, int] = {}
        self.ends: list[tuple[int, int]] = []

    def accepts(self, row) -> bool:
        if row.asset is not None and row.asset in self.assets:
            return True
        if row.windowed:
            return self.reach.get(row.ip_key, row.first_t - 1) >= row.first_t
        return row.lead_event_id in self.leads

    def add(self, row) -> None:
        if row.asset is not None:
            self.assets.add(row.asset)
        self.last = max(self.last, row.last_t)
        if row.windowed:
            self.reach[row.ip_key] = max(self.reach.get(row.ip_key, row.last_t), row.last_t)
            self.leads[row.lead_event_id] = row.last_t
            heappush(self.ends, (row.last_t, row.lead_event_id))
        # Ends come in no order, so what the oldest can no longer reach goes at every step.
        while self.ends and self.ends[0][0] < row.first_t:
            end, lead = heappop(self.ends)
            if self.leads.get(lead) == end:
                del self.leads[lead]


def _first_fit(gap_us: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, groups = None, []
        for batch in batches:
            openers = []
            for row in batch.itertuples(index=False):
                if row.component != current:
                    current, groups = row.component, []
                groups = [g for g in groups if row.first_t <= g.last + gap_us]
                home = next((g for g in groups if g.accepts(row)), None)
                if home is None:
                    home = _OpenGroup(row.alert_id)
                    groups.append(home)
                home.add(row)
                openers.append(home.opener)
            yield pd.DataFrame(
                {
                    "scope": batch["scope"],
                    "alert_id": batch["alert_id"],
                    "group_opener": openers,
                }
            )

    return run


def _tied_groups(tied: DataFrame, gap_us: int) -> DataFrame:
    """Literal first-fit over each component; quiet gaps split components further."""
    spans = _islands(tied.withColumnRenamed("component", "whole"), ["whole"], gap_us)
    rows = spans.select(
        F.coalesce(F.col("dataset_id"), F.lit(-1)).alias("scope"),
        F.to_json(F.struct("whole", "group_opener")).alias("component"),
        *_ORDER,
        "last_t",
        "asset",
        F.col("window_from").isNotNull().alias("windowed"),
        # A missing address is a key of its own, apart from an empty one.
        F.coalesce(F.concat(F.lit("="), "evidence_ip"), F.lit("")).alias("ip_key"),
        "lead_event_id",
    )
    ordered = rows.repartition("component").sortWithinPartitions("component", *_ORDER)
    return ordered.mapInPandas(
        _first_fit(gap_us), "scope bigint, alert_id string, group_opener string"
    )


def assign_incidents(
    alerts: DataFrame,
    run_at: Column | None = None,
    gap_us: int = CORRELATION_GAP_US,
    chain_cell_us: int = HOUR_US,
) -> DataFrame:
    """Alerts with the ``incident_id`` of their group.

    An incident is named after the alert that opens it. ``run_at`` stands in for the time of
    alerts that carry none.
    """
    columns = alerts.columns
    timed = _timed(alerts, run_at)
    with_user = _islands(timed.where(F.col("user").isNotNull()), ["dataset_id", "user"], gap_us)

    bare = timed.where(F.col("user").isNull())
    chained = _login_chains(bare.where(F.col("window_from").isNotNull()), chain_cell_us)
    chain_rows = materialize(
        chained.select(
            "dataset_id", "alert_id", "lead_event_id", "asset", "chain",
            _asset_node().alias("asset_node"),
        ),
        "login-chains",
    )
    tying = (
        chain_rows.groupBy("chain")
        .agg(
            F.count_distinct("asset").alias("assets"),
            F.max(F.col("asset").isNull()).alias("has_bare"),
        )
        .where((F.col("assets") >= 2) | F.col("has_bare"))
        .select("chain")
    )
    tied_rows = chain_rows.join(tying, "chain")

    grouped = with_user.select(*columns, "group_opener")
    if tied_rows.isEmpty():
        loose = bare
    else:
        ties = tied_rows.where("asset_node IS NOT NULL").select("chain", "asset_node").distinct()
        by_asset = _components(ties)
        chain_label = tied_rows.join(by_asset, "asset_node", "left").groupBy("chain").agg(
            F.coalesce(F.min("label"), F.col("chain")).alias("component")
        )
        # Alerts without an asset reach their chain through the login they lead with.
        by_login = (
            tied_rows.where("asset IS NULL").join(chain_label, "chain")
            .select("lead_event_id", F.col("component").alias("login_component")).distinct()
        )
        labelled = (
            bare.withColumn("asset_node", _asset_node())
            .join(by_asset, "asset_node", "left")
            .join(by_login, "lead_event_id", "left")
            .withColumn(
                "component",
                F.when(F.col("asset").isNotNull(), F.col("label"))
                .otherwise(F.col("login_component")),
            )
        )
        tied = labelled.where(F.col("component").isNotNull())
        loose = labelled.where(F.col("component").isNull()).select(*bare.columns)
        homes = _tied_groups(tied.select(*bare.columns, "component"), gap_us)
        matched = tied.join(
            homes.withColumnRenamed("alert_id", "__id"),
            (F.coalesce(tied["dataset_id"], F.lit(-1)) == F.col("scope"))
            & (tied["alert_id"] == F.col("__id")),
        )
        grouped = grouped.unionByName(matched.select(*columns, "group_opener"))

    by_asset_islands = _islands(
        loose.where(F.col("asset").isNotNull()), ["dataset_id", "asset"], gap_us
    )
    alone = loose.where(F.col("asset").isNull()).withColumn("group_opener", F.col("alert_id"))
    grouped = grouped.unionByName(by_asset_islands.select(*columns, "group_opener")).unionByName(
        alone.select(*columns, "group_opener")
    )
    return grouped.withColumn(
        "incident_id", F.concat(F.lit("inc-"), F.col("group_opener"))
    ).drop("group_opener")


def build_incidents(assigned: DataFrame, run_at: Column | None = None) -> DataFrame:
    """One row per incident.

    Alerts are first reduced to their distinct (user, asset, rule, severity) combinations, so
    the lists built per incident hold names, never alerts.
    """
    timed = _timed(assigned, run_at)
    combos = timed.groupBy(
        "incident_id", "dataset_id", "user", "asset", "alert_rule_name", "severity"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(*_ORDER)).alias("place"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
    )
    by_rule = combos.groupBy("incident_id", "dataset_id", "user", "alert_rule_name", "severity").agg(
        F.sum("n").alias("n"),
        F.min("place").alias("place"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.collect_set("asset").alias("assets"),
    )
    by_user = by_rule.groupBy("incident_id", "dataset_id", "user").agg(
        F.sum("n").alias("n"),
        F.min("place").alias("place"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.array_distinct(F.flatten(F.collect_list("assets"))).alias("assets"),
        F.collect_list(F.struct("place", F.col("alert_rule_name").alias("rule"))).alias("rules"),
        F.min(F.struct((-severity_rank(F.col("severity"))).alias("rank"), "place", "severity"))
        .alias("worst"),
    )
    rows = by_user.groupBy("incident_id", "dataset_id").agg(
        F.sum("n").alias("alert_count"),
        F.min(F.when(F.col("user").isNotNull(), F.struct((-F.col("n")).alias("n"), "place", "user")))
        .alias("top_user"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("assets")))).alias("assets"),
        F.sort_array(F.flatten(F.collect_list("rules"))).alias("rules"),
        F.min("worst").alias("worst"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
    )
    user, assets = F.col("top_user.user"), F.col("assets")
    asset_text = blank_to_null(F.array_join(assets, ", "))
    severity = F.col("worst.severity")
    return rows.select(
        "incident_id",
        "dataset_id",
        F.lit("open").alias("status"),
        severity.alias("severity"),
        F.concat(
            F.initcap(severity), F.lit(" security incident for "),
            F.coalesce(user, asset_text, F.lit("unknown target")),
        ).alias("title"),
        F.array_join(
            F.array_distinct(F.transform("rules", lambda rule: rule["rule"])), " -> "
        ).alias("suspected_attack_path"),
        F.concat(
            F.lit("Correlated "), F.col("alert_count").cast("string"),
            F.lit(" alerts involving "), F.coalesce(user, F.lit("an unknown user")),
            F.lit(" and "), F.coalesce(asset_text, F.lit("unknown assets")), F.lit("."),
        ).alias("description"),
        user.alias("affected_user"),
        assets.alias("affected_assets"),
        F.timestamp_micros("first_t").alias("first_seen"),
        F.timestamp_micros("last_t").alias("last_seen"),
        "alert_count",
    )


def unassigned_alerts(alerts: DataFrame, incidents: DataFrame) -> DataFrame:
    """Stored alerts a correlation run should take up.

    A dataset's alert is free when it has no incident, or when its incident belongs to no or
    another dataset; a sample alert only when it has no incident.
    """
    owner = incidents.select(
        F.col("incident_id").alias("__incident"), F.col("dataset_id").alias("__owner")
    )
    joined = alerts.join(owner, alerts["incident_id"] == owner["__incident"], "left")
    owned = F.col("dataset_id").isNotNull()
    elsewhere = F.col("__owner").isNull() | (F.col("__owner") != F.col("dataset_id"))
    return joined.where(
        F.col("incident_id").isNull() | (owned & F.coalesce(elsewhere, F.lit(True)))
    ).drop("__incident", "__owner")


