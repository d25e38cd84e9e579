"""Licence, runtime-policy and audit reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.functions import epoch_to_ts, json_fields, json_object_entries, pct_label
from postura.operators import labelled_rows
from postura.plans.blocks import licenses
from postura.plans.context import Ctx
from postura.sources.tables import Tables


def license_stats(t: Tables, ctx: Ctx) -> DataFrame:
    """Repositories and enforcers: used, licensed, utilization. Both rows divide by the
    licensed enforcer count, as the source does. Three single-row aggregates, one row each."""
    lic = licenses(t).select("licensed_enforcers")
    repos = t["registry_images"].agg(F.count_distinct("repository_id").alias("used_repositories"))
    agents = t["hosts"].agg(
        F.count_if((F.col("type") == "agent") & (F.col("status") == "connect")).alias("used_enforcers")
    )
    one = lic.crossJoin(repos).crossJoin(agents)
    rows = labelled_rows(
        one,
        [("Repositories", F.col("used_repositories")), ("Enforcers", F.col("used_enforcers"))],
        ("metric", "used"),
        keep=[F.col("licensed_enforcers").cast("bigint").alias("licesned")],
    )
    return rows.select("metric", "used", "licesned", pct_label("used", "licesned").alias("utilization"))


def policy_runtime_enabled(t: Tables, ctx: Ctx) -> DataFrame:
    """One row per control of an enabled runtime policy whose own ``enabled`` is 'true'."""
    rp = t["runtime_policies"]
    top = json_fields("policy", ["enabled", "enforce"])
    enabled = rp.select("name", "lastupdate", "author", "policy", top.alias("p")).where(F.col("p.enabled") == "true")
    entries = enabled.select(
        "name",
        "lastupdate",
        F.col("p.enabled").alias("enabled"),
        F.col("p.enforce").alias("enforced"),
        "author",
        F.explode(json_object_entries("policy")).alias("control", "value"),
    )
    control_enabled = F.try_variant_get(F.col("value"), "$.enabled", "string")
    return entries.select(
        "name", "lastupdate", "enabled", "enforced", "author", "control", control_enabled.alias("control_enabled")
    ).where(F.col("control_enabled") == "true")


_AUDIT_FIELDS = ("signature_name", "control", "result", "malware", "malware_type", "malware_scan_type",
                 "resource", "host", "action")


def _audit(t: Tables) -> DataFrame:
    """Audit events with their JSON document parsed once into text fields."""
    return t["audit"].select("*", json_fields("data", _AUDIT_FIELDS).alias("d"))


def _control() -> F.Column:
    return F.coalesce(F.col("d.signature_name"), F.col("d.control"))


def _response() -> F.Column:
    return F.when(F.col("d.result") == "2", F.lit("Blocked")).otherwise(F.lit("Detected"))


def _event_rollup(df: DataFrame, keys: list) -> DataFrame:
    # the latest time is max(createtime) converted once per group
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max("id").alias("latest_id"),
        F.max("createtime").alias("latest_epoch"),
    )


def audit_hosts_findings_by_action(t: Tables, ctx: Ctx) -> DataFrame:
    """All audit events by type, category, action, control and response: count, latest id and
    latest time."""
    a = _audit(t).select("type", "category", "action", _control().alias("control"), _response().alias("response"),
                         "id", "createtime")
    return (
        _event_rollup(a, ["type", "category", "action", "control", "response"])
        .select("type", "category", "action", "control", "response", "event_count", "latest_id",
                epoch_to_ts("latest_epoch").alias("latest_date"))
        .orderBy(F.col("event_count").desc())
    )


def audit_incidents_by_detection_type(t: Tables, ctx: Ctx) -> DataFrame:
    """Runtime, host runtime, malware and docker events except scans, by workload. Groups on
    the raw type, category and action and prints them lower-cased, so rows can repeat."""
    workload = (
        F.when(F.col("type") == "Runtime", F.lit("Container"))
        .when(F.col("type") == "host.runtime", F.lit("VM"))
        .when(F.col("type") == "Docker", F.lit("Container"))
        .otherwise(F.lit("VM"))
    )
    a = (
        _audit(t)
        .where(F.col("type").isin("Runtime", "host.runtime", "Malware", "Docker") & (F.col("action") != "Scan"))
        .select("type", "category", "action", _control().alias("control"), _response().alias("response"),
                "id", "createtime")
        .where(F.col("control").isNotNull())
    )
    return (
        _event_rollup(a, ["type", "category", "action", "control", "response"])
        .orderBy(F.col("event_count").desc())
        .select(
            workload.alias("workload"),
            F.lower("category").alias("category"),
            F.lower("action").alias("action"),
            "control",
            "response",
            "event_count",
            "latest_id",
            epoch_to_ts("latest_epoch").alias("latest_date"),
        )
    )


def audit_malware_list(t: Tables, ctx: Ctx) -> DataFrame:
    """Malware events (not scans), newest first."""
    a = _audit(t).where((F.col("type") == "Malware") & (F.col("action") != "Scan"))
    return a.orderBy(F.col("createtime").desc_nulls_first()).select(
        epoch_to_ts("createtime").alias("to_timestamp"),
        F.col("d.malware").alias("malware_name"),
        F.col("d.malware_type").alias("malware_type"),
        F.col("d.malware_scan_type").alias("detected_in"),
        F.col("d.resource").alias("path"),
        F.col("d.host").alias("host"),
        F.col("d.action").alias("response"),
    )
