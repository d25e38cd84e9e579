"""Host reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.functions import avg_int, month_key, pct_label, round_ratio, vuln_score, vuln_severity
from postura.functions.vulns import SEVERITY_COLUMNS
from postura.operators import month_spine, splittable_side
from postura.plans.blocks import bench_documents, bench_results, first_scans, host_cloud, host_tags, scan_totals_per_host
from postura.plans.context import Ctx
from postura.sources.tables import Tables

_AVG_NAMES = {
    "crit_vulns": "average_critical_vulns",
    "high_vulns": "average_high_vulns",
    "med_vulns": "average_medium_vulns",
    "low_vulns": "average_low_vulns",
    "neg_vulns": "average_neg_vulns",
}


def host_added_over_time(t: Tables, ctx: Ctx) -> DataFrame:
    """Hosts whose first scan falls in each of the last 12 months, newest month first."""
    per_month = first_scans(t).groupBy(month_key("date").alias("mkey")).agg(F.count("host_id").alias("n"))
    # at most 1200 rows: one per two-digit month/year key
    spine = month_spine(ctx.spark, ctx.as_of)
    return (
        spine.join(F.broadcast(per_month), "mkey", "left")
        .orderBy(F.col("datemonth").desc())
        .select("month", F.coalesce(F.col("n"), F.lit(0)).alias("hosts_added"))
    )


def host_findings_over_time(t: Tables, ctx: Ctx) -> DataFrame:
    """Finished host scans per month of the last 12: hosts, scans and summed findings."""
    sh = t["scan_history"].where(F.col("host_id").isNotNull() & (F.col("status") == "finished"))
    per_month = sh.groupBy(month_key("date").alias("mkey")).agg(
        F.count_distinct("host_id").alias("host_count"),
        F.count("id").alias("scans"),
        F.sum("malware").alias("malware_found"),
        F.sum("sensitive").alias("secrets_found"),
        F.sum("crit_vulns").alias("critical_vulns_found"),
    )
    spine = month_spine(ctx.spark, ctx.as_of)
    zero = F.lit(0).cast("bigint")
    return (
        spine.join(F.broadcast(per_month), "mkey", "left")
        .orderBy(F.col("datemonth").desc())
        .select(
            "month",
            F.coalesce("host_count", zero).alias("host_count"),
            F.coalesce("scans", zero).alias("scans"),
            F.coalesce("malware_found", zero).alias("malware_found"),
            F.coalesce("secrets_found", zero).alias("secrets_found"),
            F.coalesce("critical_vulns_found", zero).alias("critical_vulns_found"),
        )
    )


def _assurance_summary(t: Tables, scan_type: str, subject: str) -> DataFrame:
    sar = t["scan_assurance_results"]
    sc = t["scans"].where(F.col("type") == scan_type).select(F.col("id").alias("s_id"), subject)
    ia = t["image_assurance"].select(F.col("id").alias("policy_id"))
    # the two facts meet first on the scan id (shuffle-free when both are bucketed by it);
    # the policy filter is a semi join against a small dimension
    return sar.join(sc, sar["scan_id"] == sc["s_id"]).join(ia, "policy_id", "left_semi")


def subject_counts(t: Tables, scan_type: str, subject: str) -> DataFrame:
    """Per control: subjects (hosts or images) checked, failed and passed, each counted once. The fact is
    aggregated once per (control, subject), so no row is repeated for several distinct counts."""
    per_subject = _assurance_summary(t, scan_type, subject).groupBy("control", subject).agg(
        F.max(F.col("failed") == F.lit(True)).alias("any_failed"), F.max(F.col("failed") == F.lit(False)).alias("any_passed")
    )
    return per_subject.groupBy("control").agg(
        F.count(subject).alias("checked"),
        F.count(F.when(F.col("any_failed"), F.col(subject))).alias("failed"),
        F.count(F.when(F.col("any_passed"), F.col(subject))).alias("passed"),
    )


def host_assurance_summary(t: Tables, ctx: Ctx) -> DataFrame:
    """Per assurance control over host scans: hosts scanned, hosts failed and the pass rate."""
    return (
        subject_counts(t, "host", "host_id")
        .withColumnsRenamed({"checked": "hosts_scanned", "failed": "hosts_failed", "passed": "hosts_passed"})
        .select("control", "hosts_scanned", "hosts_failed", pct_label("hosts_passed", "hosts_scanned").alias("pass_rate"))
        .orderBy(F.col("hosts_scanned").desc())
    )


def host_findings_region(t: Tables, ctx: Ctx) -> DataFrame:
    """Per cloud and region: host-scan rows and summed findings. Scans are summed per host
    before the host and agent joins (``host_count`` counts joined scan rows, as the source does)."""
    per_host = scan_totals_per_host(t, "host")
    hosts = t["hosts"].select(F.col("id").alias("host_id"))
    ad = host_cloud(t).select(F.col("hostid").alias("host_id"), "cloud", "region")
    zero = F.lit(0).cast("bigint")
    return (
        hosts.join(ad, "host_id")
        .join(per_host, "host_id")
        .groupBy("cloud", "region")
        .agg(
            F.sum("n_scans").alias("host_count"),
            F.coalesce(F.sum("s_malware"), zero).alias("malware_found"),
            F.coalesce(F.sum("s_sensitive"), zero).alias("secrets_found"),
            F.coalesce(F.sum("s_crit_vulns"), zero).alias("critical_vulns_found"),
        )
        .orderBy(F.col("cloud").asc_nulls_last(), F.col("region").asc_nulls_last())
    )


def _tag_sums() -> list:
    return [F.sum(f"s_{c}").alias(f"t_{c}") for c in _AVG_NAMES] + [F.sum(f"n_{c}").alias(f"m_{c}") for c in _AVG_NAMES]


def _tag_averages() -> list:
    return [avg_int(f"t_{c}", f"m_{c}").alias(name) for c, name in _AVG_NAMES.items()]


def host_vulnerabilities_by_cloud_tag(t: Tables, ctx: Ctx) -> DataFrame:
    """Per tag name and value: hosts carrying it (more than one) and average scan counts,
    each scan weighted once per occurrence of the tag on its host."""
    per_host = scan_totals_per_host(t)
    tags = host_tags(t).withColumnRenamed("hostid", "host_id")
    return (
        tags.join(per_host, "host_id")
        .groupBy("tag_name", "tag_value")
        .agg(F.count_distinct("host_id").alias("num_hosts"), *_tag_sums())
        .where(F.col("num_hosts") > 1)
        .select("tag_name", "tag_value", "num_hosts", *_tag_averages())
        .orderBy(F.col("num_hosts").desc(), F.col("tag_name").asc_nulls_last(), F.col("tag_value").asc_nulls_last())
    )


def host_vulnerabilities_by_region(t: Tables, ctx: Ctx) -> DataFrame:
    """Per cloud and region of hosts that have tags: hosts and average scan counts."""
    per_host = scan_totals_per_host(t)
    hc = host_cloud(t).where(F.col("vm_tags").isNotNull()).select(F.col("hostid").alias("host_id"), "cloud", "region")
    return (
        hc.join(per_host, "host_id")
        .groupBy("cloud", "region")
        .agg(F.count_distinct("host_id").alias("num_hosts"), *_tag_sums())
        .select("cloud", "region", "num_hosts", *_tag_averages())
        .orderBy(F.col("num_hosts").desc(), F.col("cloud").asc_nulls_last(), F.col("region").asc_nulls_last())
    )


_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def _guarded_date(col: str):
    c = F.col(col).cast("string")
    return F.when(c.rlike(_ISO_DATE), F.try_to_date(c, "yyyy-MM-dd"))


def host_vulnerability_scan_details(t: Tables, ctx: Ctx) -> DataFrame:
    """Host scan x resource x vulnerability detail rows.

    Join order: vulnerability dimension first (vulnerabilities with their resource), host
    scans with their host, then the scan/resource bridge against both, so the largest
    table meets already-filtered sides, once per key.
    """
    krv = t["known_resource_vulnerabilities"].where(F.col("issue_type") == "vulnerability")
    kr = t["known_resources"].select(
        F.col("id").alias("resource_id"),
        F.col("type").alias("resource_type"),
        F.col("format").alias("resource_format"),
        F.col("name").alias("resource_name"),
        F.col("version").alias("resource_version"),
    )
    vulns = krv.select(
        "resource_id",
        F.col("name").alias("vuln_id"),
        vuln_score().alias("vuln_score"),
        vuln_severity("", ctx.severity_fn).alias("vuln_severity"),
        _guarded_date("publish_date").alias("vuln_publish_date"),
        _guarded_date("created").alias("vuln_first_seen_date"),
    )
    hosts = t["hosts"].select(F.col("id").alias("host_id"), "logicalname")
    host_scans = (
        t["scans"]
        .where(F.col("type") == "host")
        .select(F.col("id").alias("scan_id"), "host_id", "scan_date", *SEVERITY_COLUMNS)
        .join(hosts, "host_id")
    )
    sr = t["scan_resources"].select("scan_id", "resource_id")
    # resource and vulnerability dimensions are joined first, so the bridge meets one
    # resource-keyed side (one skew-splittable join instead of two chained on the same key)
    vuln_dim = splittable_side(vulns.join(kr, "resource_id"))
    rows = sr.join(host_scans, "scan_id").join(vuln_dim, "resource_id")
    return rows.select(
        "scan_date",
        F.col("host_id").cast("string").alias("host_id"),
        F.col("logicalname").cast("string").alias("host_full_name"),
        F.split_part(F.col("logicalname"), F.lit("."), F.lit(1)).alias("host_short_name"),
        F.col("crit_vulns").alias("host_critical_vulns"),
        F.col("high_vulns").alias("host_high_vulns"),
        F.col("med_vulns").alias("host_med_vulns"),
        F.col("low_vulns").alias("host_low_vulns"),
        F.col("neg_vulns").alias("host_neg_vulns"),
        (F.col("crit_vulns") + F.col("high_vulns") + F.col("med_vulns") + F.col("low_vulns") + F.col("neg_vulns")).alias(
            "host_total_vulns"
        ),
        "scan_id",
        "resource_type",
        "resource_format",
        "resource_name",
        "resource_version",
        "vuln_id",
        "vuln_score",
        "vuln_severity",
        "vuln_publish_date",
        "vuln_first_seen_date",
    )


_BENCH_MEASURES = ("pass", "fail", "info", "warn")


def host_bench_results_details(t: Tables, ctx: Ctx) -> DataFrame:
    """Benchmark test rows of known hosts with pass/fail/info/warn percentages at host,
    category and section level.

    The three levels are additive, so they are computed as one aggregate per
    (host, category, section), rolled up to category and host, and joined back once. A host
    with many tests is aggregated map-side instead of being sorted in one window task. The rows and the totals
    come from documents that are read, parsed and shuffled once. As in
    the source, a NULL category or section matches no totals.
    """
    br = bench_results(bench_documents(t))
    hosts = t["hosts"].select(F.col("id").alias("host_id"))
    known = br.join(hosts, "host_id")

    def sums(prefix: str, src: str = "") -> list:
        if src:
            return [F.sum(f"{src}_tests").alias(f"{prefix}_tests")] + [
                F.sum(f"{src}_{m}").alias(f"{prefix}_{m}") for m in _BENCH_MEASURES
            ]
        return [F.count("test_result").alias(f"{prefix}_tests")] + [
            F.sum(f"test_{m}").alias(f"{prefix}_{m}") for m in _BENCH_MEASURES
        ]

    sec = br.groupBy("host_id", "category", "section").agg(*sums("sec"))
    cat = sec.groupBy("host_id", "category").agg(*sums("cat", "sec"))
    host = sec.groupBy("host_id").agg(*sums("host", "sec"))
    cat_k = cat.withColumnRenamed("host_id", "c_host").withColumnRenamed("category", "c_category")
    totals = (
        sec.join(cat_k, (sec["host_id"] == cat_k["c_host"]) & sec["category"].eqNullSafe(cat_k["c_category"]))
        .drop("c_host", "c_category")
        .join(host, "host_id")
        .withColumnRenamed("host_id", "t_host")
        .withColumnRenamed("category", "t_category")
        .withColumnRenamed("section", "t_section")
    )

    def pct(prefix: str, m: str, valid):
        # round(m / tests, 2) * 100, exact: hundredths of the ratio, half away from zero
        v = round_ratio(f"{prefix}_{m}", f"{prefix}_tests", scale=100).cast("double")
        return (F.when(valid, v) if valid is not None else v).alias(f"{_LEVEL[prefix]}_{m}_pct")

    cat_ok = F.col("category").isNotNull()
    sec_ok = cat_ok & F.col("section").isNotNull()
    pcts = (
        [pct("host", m, None) for m in _BENCH_MEASURES]
        + [pct("cat", m, cat_ok) for m in _BENCH_MEASURES]
        + [pct("sec", m, sec_ok) for m in _BENCH_MEASURES]
    )
    keyed = known.join(
        totals,
        (known["host_id"] == totals["t_host"])
        & known["category"].eqNullSafe(totals["t_category"])
        & known["section"].eqNullSafe(totals["t_section"]),
    )
    return keyed.select(
        "scan_date", "host_id", "category", "config_file", "section", "section_number", "test_number",
        "test_desc", "test_result", "test_warn", "test_fail", "test_info", "test_pass", *pcts,
    )


_LEVEL = {"host": "host", "cat": "category", "sec": "section"}
