"""Container reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postura.functions import as_of_literal, avg_int, epoch_to_ts
from postura.functions.vulns import SEVERITY_COLUMNS
from postura.operators import any_key_join, distinct_counts, pack, row_keys, splittable_side, unpack
from postura.plans.blocks import host_risk, image_risk, latest_image_vuln_summary, policy_failures
from postura.plans.context import Ctx
from postura.sources.tables import Tables


def _running(t: Tables) -> DataFrame:
    return t["containers"].where(F.col("status") == "running")


def container_assurance_summary(t: Tables, ctx: Ctx) -> DataFrame:
    """Running containers with at least one failed control, per failed policy type and control.

    A container matches a failure when the failure's key equals the container's scan id, the
    id of any scan of its image, or the container id. Keys come first, each with its owner: a container
    for its own two, an image for those of its scans (resolved once per image, of the images that run). The
    assurance fact meets only the scans among the keys; the (owner, type, control) rows found are made
    distinct and joined once to the containers, each of which stands under two owners, itself and its image.
    Containers and keys are each shuffled once for all of this.
    """
    columns = ["id", "scan_id", "oci_image_id", "image_name", "level1", "level2", "level3"]
    packed = pack(_running(t).select(*columns), ["id"], "id").repartition("id")
    # never null, as its id is not: no filter on it can part the uses of one shuffle
    itself = F.concat(F.lit("container "), F.coalesce(F.col("id").cast("string"), F.lit("")))
    image = F.concat(F.lit("image "), F.col("docker_id").cast("string"))
    own = row_keys(unpack(packed, columns), "id", [F.col("scan_id"), F.col("id")]).select(itself.alias("owner"), "key")
    used = row_keys(unpack(packed, columns), "id", [F.col("oci_image_id")]).select(F.col("key").alias("docker_id")).distinct()
    images = t["image_metadata"].select("image_id", "docker_id").join(used, "docker_id", "left_semi")
    scans = t["scans"].where(F.col("image_id").isNotNull()).select("image_id", F.col("id").cast("string").alias("key"))
    of_images = images.join(scans, "image_id").select(image.alias("owner"), "key")
    both = ["owner", "key"]
    keyed = unpack(splittable_side(pack(own.union(of_images), both)), both, both)

    failures = (
        policy_failures(t, keyed.select("key").distinct())
        .where(F.col("failed_control").isNotNull())
        .select(F.col("scan_id").alias("key"), "failed_control", F.col("failed_policy_type").alias("failed_control_type"))
    )
    what = ["failed_control_type", "failed_control"]
    found = keyed.join(failures, "key").select("owner", *what).distinct()
    owners = F.array_compact(F.array(itself, F.concat(F.lit("image "), F.col("oci_image_id").cast("string"))))
    owned = unpack(packed, columns).select("id", "image_name", "level1", "level2", "level3", F.explode_outer(owners).alias("owner"))
    rows = owned.join(found, "owner").drop("owner").distinct()
    counted = {"image_count": "image_name", "cluster_count": "level1", "namespace_count": "level2", "controller_count": "level3"}
    counts = distinct_counts(rows, what, counted, {"container_count": F.lit(1)})
    return counts.select(*what, "container_count", *counted)


def _container_vulns(t: Tables) -> DataFrame:
    """One row per running container joined with the latest image scan of its image."""
    best = splittable_side(latest_image_vuln_summary(t))
    running = _running(t).select(
        "id", "name", "level1", "level2", "level3", "level3_type", "level4", "create_time", "oci_image_id"
    )
    return running.join(best, running["oci_image_id"] == best["docker_id"])


def container_vuln_list(t: Tables, ctx: Ctx) -> DataFrame:
    """One row per running container whose image has an image scan, with the latest scan's counts."""
    cv = _container_vulns(t)
    return cv.select(
        F.col("name").alias("container_name"),
        F.col("level1").alias("cluster"),
        F.col("level2").alias("namespace"),
        F.col("level3").alias("controller"),
        F.col("level3_type").alias("controller_type"),
        F.col("level4").alias("pod_name"),
        epoch_to_ts("create_time").alias("create_time"),
        "image_id",
        "docker_id",
        "image_name",
        "repo_name",
        *SEVERITY_COLUMNS,
        "total_vulns",
    )


def container_ns_vuln_summary(t: Tables, ctx: Ctx) -> DataFrame:
    """Per namespace and controller: clusters, containers and images, and the rounded average
    vulnerability counts of the containers' latest image scans (one row a container)."""
    cv = _container_vulns(t).withColumnsRenamed({"level2": "namespace", "level3": "controller"})
    cols = ("crit_vulns", "high_vulns", "med_vulns", "low_vulns", "neg_vulns", "total_vulns")
    sums = {f"s_{c}": F.col(c) for c in cols} | {f"n_{c}": F.col(c).isNotNull().cast("int") for c in cols}
    counts = {"cluster_count": "level1", "image_count": "docker_id"}
    agg = distinct_counts(cv, ["namespace", "controller"], counts, {"container_count": F.lit(1), **sums})
    return agg.select(
        "namespace", "controller", "cluster_count", "container_count", "image_count",
        *[avg_int(f"s_{c}", f"n_{c}").alias(f"avg_{c}") for c in cols],
    )


def containers_running_with_findings_list(t: Tables, ctx: Ctx) -> DataFrame:
    """Every running container with its latest image scan, latest host scan and each failed
    control that matches any of its four keys (one row with empty failure columns when none)."""
    c = _running(t)
    # one row per image / host; re-shuffled so a hot image or host of the containers can be split
    ir = splittable_side(image_risk(t))
    hr = splittable_side(host_risk(t))
    c = c.select(
        "id", "name", "image_name", "oci_image_id", "hostid", "scan_id", "registry_id", "level1", "level2", "level3", "level3_type",
        "level4", "create_time", "audit_block_events", "audit_detect_events",
    )
    base = c.join(ir, c["oci_image_id"] == ir["docker_id"], "left").join(hr, c["hostid"] == hr["host_id"], "left")
    keys = [F.col("scan_id"), F.col("ir_scan_id"), F.col("hr_scan_id"), F.col("id")]
    keyed = any_key_join(base, "id", keys, lambda needed: policy_failures(t, needed), "scan_id")
    entry_order = [
        F.col("failed_policy_type").asc_nulls_last(),
        F.col("failed_policy").asc_nulls_last(),
        F.col("failed_control").asc_nulls_last(),
    ]
    entry = F.row_number().over(Window.partitionBy("id").orderBy(*entry_order))
    return keyed.select(
        as_of_literal(ctx.as_of).alias("query_time"),
        F.col("name").alias("container_name"),
        entry.alias("container_entry"),
        F.col("id").alias("container_id"),
        "image_name",
        F.col("registry_id").alias("registry_name"),
        F.col("level1").alias("cluster"),
        F.col("level2").alias("namespace"),
        F.col("level3").alias("controller"),
        F.col("level3_type").alias("controller_type"),
        F.col("level4").alias("pod_name"),
        (F.col("audit_block_events") + F.col("audit_detect_events")).alias("c_runtime_events"),
        epoch_to_ts("create_time").alias("create_time"),
        "ir_scan_id", "docker_id", "i_malware", "i_critical_vulns", "i_high_vulns", "i_med_vulns",
        "i_low_vulns", "i_nelg_vulns", "i_total_vulns", "i_scan_entry",
        "hr_scan_id", "host_id", "h_malware", "h_critical_i_vulns", "h_high_vulns", "h_med_vulns",
        "h_low_vulns", "h_nelg_vulns", "h_total_vulns", "h_scan_entry",
        "failed_control", "failed_policy", "failed_policy_type",
    )
