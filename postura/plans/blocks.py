"""Shared building blocks of the reports (the CTEs and derived tables they repeat)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.functions import epoch_to_ts, json_array_text, json_text, total_vulns
from postura.functions.vulns import SEVERITY_COLUMNS
from postura.operators import first_per_key, labelled_rows, pack, splittable_side, unpack
from postura.sources.tables import Tables


def scan_order(date_col: str = "scan_date", id_col: str = "id") -> list[Column]:
    """Order for "latest scan first": DESC puts NULL dates first (the source database's rule),
    then the highest scan id, so ties resolve the same way on every run."""
    return [F.col(date_col).desc_nulls_first(), F.col(id_col).desc_nulls_last()]


# names under which a run may hand over a block that it has written (see ``plans.shared``)
FAILURES = "block_assurance_failures"
VULN_SUMMARY = "block_latest_image_vuln_summary"


# ---------------------------------------------------------------- policy failures


def container_default_failures(t: Tables) -> DataFrame:
    """One 'Default' row per built-in control a container violates (root, privileged,
    not registered). NULL flags do not count."""
    c = t["containers"]
    flags = labelled_rows(
        c,
        [("root", F.col("isroot")), ("privileged", F.col("isprivileged")), ("not_registered", ~F.col("isregistered"))],
        ("failed_control", "control_result"),
        keep=[F.col("id").cast("string").alias("scan_id")],
    )
    return flags.where(F.col("control_result") == F.lit(True)).select(
        "scan_id",
        "failed_control",
        F.lit("Default").alias("failed_policy"),
        F.lit("container").alias("failed_policy_type"),
    )


def scans_of_keys(t: Tables, keys: DataFrame | None) -> DataFrame:
    """(s_id, failed_policy_type) of the scans, or of those whose id, as text, is among ``keys(key)``. The keys take the id's
    own type before the join, so scans that lie bucketed by id are read as they lie."""
    sc = t["scans"].select(F.col("id").alias("s_id"), F.col("type").alias("failed_policy_type"))
    if keys is None:
        return sc
    typed = F.col("key").try_cast(sc.schema["s_id"].dataType)
    # an outer explode of none or one id: a plain filter would move below the shuffle that the keys share with other uses
    same = F.array_compact(F.array(F.when(typed.cast("string") == F.col("key"), typed)))
    ids = keys.select(F.explode_outer(same).alias("k_id")).where(F.col("k_id").isNotNull())
    return sc.join(ids, F.col("s_id") == F.col("k_id"), "left_semi")


def assurance_failures(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Failed assurance controls of the scans, or of the scans among ``keys``, keyed by scan id (text)."""
    if FAILURES in t:
        written = t[FAILURES]
        return written if keys is None else written.join(keys.withColumnRenamed("key", "scan_id"), "scan_id", "left_semi")
    sar = t["scan_assurance_results"].where(F.col("failed") == F.lit(True)).select("scan_id", "policy_id", "control")
    ia = t["image_assurance"].select(F.col("id").alias("ia_id"), F.col("name").alias("failed_policy"))
    sc = scans_of_keys(t, keys)
    return (
        sar.join(sc, sar["scan_id"] == sc["s_id"])
        .join(ia, sar["policy_id"] == ia["ia_id"])
        .select(
            F.col("scan_id").cast("string").alias("scan_id"),
            F.col("control").alias("failed_control"),
            "failed_policy",
            "failed_policy_type",
        )
    )


def policy_failures(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Failed assurance controls keyed by scan id (text), plus the containers' built-in
    violations keyed by container id in the same text column. With ``keys`` (a distinct column ``key``) the assurance
    fact only meets the scans among them: all that a join on these keys can use."""
    return assurance_failures(t, keys).unionByName(container_default_failures(t))


# ---------------------------------------------------------------- image vulnerability summaries


def latest_image_vuln_summary(t: Tables) -> DataFrame:
    """Image x metadata x repository x image scan, reduced to one scan per docker id (latest scan, then highest
    scan and image id). A container's pick depends only on its image, so the scans are reduced to one
    per image before any join (a partial limit ahead of the shuffle, so a hot image costs one row
    a task), and then to one per docker id."""
    if VULN_SUMMARY in t:
        return t[VULN_SUMMARY]
    sc = t["scans"].where((F.col("type") == "image") & F.col("image_id").isNotNull()).select(
        F.col("id").alias("scan_id"), "image_id", "scan_date", *SEVERITY_COLUMNS
    )
    latest = first_per_key(sc, ["image_id"], scan_order("scan_date", "scan_id"))
    ri = t["registry_images"].select(F.col("id").alias("image_id"), F.col("name").alias("image_name"), "repository_id")
    im = t["image_metadata"].select("image_id", "docker_id")
    rr = t["registry_repositories"].select(F.col("id").alias("repository_id"), F.col("name").alias("repo_name"))
    rows = (
        ri.join(im, "image_id")
        .join(rr, "repository_id")
        .join(latest, "image_id")
        .select(
            "image_id", "docker_id", "image_name", "repo_name", *SEVERITY_COLUMNS,
            total_vulns().alias("total_vulns"), "scan_id", "scan_date",
        )
    )
    return first_per_key(rows, ["docker_id"], [*scan_order("scan_date", "scan_id"), F.col("image_id").desc()])


def container_presence(t: Tables) -> DataFrame:
    """Per docker id, the ``containers_exist`` values the container/metadata join produces:
    0 for a container without image name, 1 for one with it."""
    return (
        t["containers"]
        .where(F.col("oci_image_id").isNotNull())
        .groupBy(F.col("oci_image_id").alias("docker_id"))
        .agg(
            F.max(F.col("image_name").isNull().cast("int")).alias("has_unnamed"),
            F.max(F.col("image_name").isNotNull().cast("int")).alias("has_named"),
        )
    )


def image_vuln_distribution_rows(t: Tables, with_repo: bool) -> DataFrame:
    """Distinct (image, name, [repo], containers_exist, counts) rows of the container /
    metadata / image / scan join. Metadata without containers contributes containers_exist 0."""
    im = t["image_metadata"].select("image_id", "docker_id")
    pres = container_presence(t)
    exist = F.when(F.col("has_unnamed").isNull(), F.array(F.lit(0))).otherwise(
        F.array_compact(
            F.array(
                F.when(F.col("has_unnamed") == 1, F.lit(0)),
                F.when(F.col("has_named") == 1, F.lit(1)),
            )
        )
    )
    meta = im.join(pres, "docker_id", "left").select("image_id", F.explode(exist).alias("containers_exist"))
    ri = t["registry_images"].select(F.col("id").alias("image_id"), F.col("name").alias("image_name"), "repository_id")
    # names follow from the image, so scans are reduced to their distinct counts per image first
    sc = t["scans"].where(F.col("type") == "image").select("image_id", *SEVERITY_COLUMNS).distinct()
    rows = meta.join(ri, "image_id")
    cols = ["image_id", "image_name"]
    if with_repo:
        rr = t["registry_repositories"].select(F.col("id").alias("repository_id"), F.col("name").alias("repo_name"))
        rows = rows.join(rr, "repository_id")
        cols.append("repo_name")
    rows = splittable_side(rows.select(*cols, "containers_exist").distinct()).join(sc, "image_id")
    return rows.select(*cols, "containers_exist", *SEVERITY_COLUMNS, total_vulns().alias("total_vulns"))


# ---------------------------------------------------------------- latest image / host risk


def image_risk(t: Tables) -> DataFrame:
    """Latest scan (any type) per docker id, with its counts."""
    im = t["image_metadata"].select("image_id", "docker_id")
    sc = t["scans"].where(F.col("image_id").isNotNull())
    rows = im.join(sc, "image_id").select(
        F.col("id").alias("ir_scan_id"),
        "docker_id",
        F.col("malware").alias("i_malware"),
        F.col("crit_vulns").alias("i_critical_vulns"),
        F.col("high_vulns").alias("i_high_vulns"),
        F.col("med_vulns").alias("i_med_vulns"),
        F.col("low_vulns").alias("i_low_vulns"),
        F.col("neg_vulns").alias("i_nelg_vulns"),
        total_vulns().alias("i_total_vulns"),
        "scan_date",
    )
    top = first_per_key(rows, ["docker_id"], scan_order("scan_date", "ir_scan_id"))
    return top.drop("scan_date").withColumn("i_scan_entry", F.lit(1))


def host_risk(t: Tables) -> DataFrame:
    """Latest scan per host. Scans without host id can never join a container, so they are
    dropped before the shuffle instead of forming one huge NULL group."""
    sc = t["scans"].where(F.col("host_id").isNotNull())
    rows = sc.select(
        F.col("id").alias("hr_scan_id"),
        "host_id",
        F.col("malware").alias("h_malware"),
        F.col("crit_vulns").alias("h_critical_i_vulns"),
        F.col("high_vulns").alias("h_high_vulns"),
        F.col("med_vulns").alias("h_med_vulns"),
        F.col("low_vulns").alias("h_low_vulns"),
        F.col("neg_vulns").alias("h_nelg_vulns"),
        total_vulns().alias("h_total_vulns"),
        "scan_date",
    )
    top = first_per_key(rows, ["host_id"], scan_order("scan_date", "hr_scan_id"))
    return top.drop("scan_date").withColumn("h_scan_entry", F.lit(1))


# ---------------------------------------------------------------- hosts


def host_cloud(t: Tables) -> DataFrame:
    """agent_details with cloud vendor, region and the raw tag array parsed once."""
    ad = t["agent_details"]
    info = F.from_json(F.col("cloud_info"), "vm_vendor_name string, vm_location string, vm_tags string")
    return ad.select("hostid", info.alias("ci")).select(
        "hostid",
        F.col("ci.vm_vendor_name").alias("cloud"),
        F.col("ci.vm_location").alias("region"),
        F.col("ci.vm_tags").alias("vm_tags"),
    )


def host_tags(t: Tables) -> DataFrame:
    """One row per host tag: the text up to the first comma, split at its last colon into
    name and value."""
    hc = host_cloud(t).where(F.col("vm_tags").isNotNull())
    tag = F.explode(json_array_text(F.col("vm_tags"))).alias("tag")
    tags = hc.select("hostid", tag)
    head = F.split_part(F.col("tag"), F.lit(","), F.lit(1))
    tag_string = F.regexp_replace(head, r"(?s)^(.*):", "$1,")
    return tags.select("hostid", tag_string.alias("tag_string")).select(
        "hostid",
        F.split_part(F.col("tag_string"), F.lit(","), F.lit(1)).alias("tag_name"),
        F.split_part(F.col("tag_string"), F.lit(","), F.lit(2)).alias("tag_value"),
    )


def scan_totals_per_host(t: Tables, scan_type: str | None = None) -> DataFrame:
    """Per host id: number of scans and, per severity column, its sum and non-null count.
    Aggregating the scan fact before it meets the host dimension keeps one row per host in
    the join, however many scans a single host has."""
    sc = t["scans"].where(F.col("host_id").isNotNull())
    if scan_type is not None:
        sc = sc.where(F.col("type") == scan_type)
    aggs = [F.count(F.lit(1)).alias("n_scans")]
    for c in ("malware", "sensitive", *SEVERITY_COLUMNS):
        aggs += [F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
    return sc.groupBy("host_id").agg(*aggs)


def first_scans(t: Tables) -> DataFrame:
    """Earliest scan date per (non-NULL) host."""
    return t["scan_history"].where(F.col("host_id").isNotNull()).groupBy("host_id").agg(F.min("date").alias("date"))


# ---------------------------------------------------------------- licences


def licensed(quantity: str) -> Column:
    """Licensed amount over Active licences: -1 (unlimited) if any licence says -2, else the
    sum of the entries that are not -1."""
    q = F.col(quantity)
    return F.when(F.min(q) == -2, F.lit(-1).cast("bigint")).otherwise(F.sum(F.when(q != -1, q)))


def licenses(t: Tables) -> DataFrame:
    """One row: licensed amounts over Active licences for each licensed quantity."""
    return t["license"].where(F.col("status") == "Active").agg(
        licensed("enforcers").alias("licensed_enforcers"),
        licensed("repositories").alias("licensed_repositories"),
        licensed("micro_enforcers").alias("licensed_micro"),
        licensed("vm_enforcers").alias("licensed_vms"),
    )


# ---------------------------------------------------------------- benchmark results

_BENCH_SECTIONS = (
    "array<struct<`desc`:string, section:string, "
    "results:array<struct<test_number:string, test_desc:string, status:string>>>>"
)


_BENCH_DOCUMENT = ("scan_date", "host_id", "category", "config_file", "sections")


def bench_documents(t: Tables) -> DataFrame:
    """Host benchmark documents, each parsed once and packed, as several relations are made from them. Two document shapes:
    ``result.Controls[0].tests`` and ``result.tests.results``."""
    sections_json = F.coalesce(json_text("data", "result", "Controls", 0, "tests"), json_text("data", "result", "tests", "results"))
    test_type = F.col("test_type").cast("string")
    documents = t["host_scan"].select(
        epoch_to_ts("lastupdate").alias("scan_date"),
        F.col("host_id").cast("string").alias("host_id"),
        F.when(test_type == "cis", F.lit("dockerbench")).otherwise(test_type).alias("category"),
        F.col("config_file_name").cast("string").alias("config_file"),
        F.from_json(sections_json, _BENCH_SECTIONS).alias("sections"),
    )
    return splittable_side(pack(documents, ["host_id"]))


def bench_results(documents: DataFrame) -> DataFrame:
    """Benchmark documents flattened to host x section x test rows."""
    rows = unpack(documents, _BENCH_DOCUMENT, ["host_id"])
    # an inner explode would filter on the sections below the shuffle, where they would be parsed once more
    sec = rows.select("scan_date", "host_id", "category", "config_file", F.explode_outer("sections").alias("s")).where(F.col("s").isNotNull())
    tests = sec.select("*", F.explode(F.col("s.results")).alias("tst"))
    status = F.col("tst.status")
    return tests.select(
        "scan_date",
        "host_id",
        "category",
        "config_file",
        F.col("s.desc").alias("section"),
        F.col("s.section").alias("section_number"),
        F.col("tst.test_number").alias("test_number"),
        F.col("tst.test_desc").alias("test_desc"),
        status.alias("test_result"),
        F.instr(status, "WARN").alias("test_warn"),
        F.instr(status, "FAIL").alias("test_fail"),
        F.instr(status, "INFO").alias("test_info"),
        F.instr(status, "PASS").alias("test_pass"),
    )
