"""Image and repository reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postura.functions import as_of_date, as_of_literal, avg_int, pct_label, vuln_score, vuln_severity
from postura.functions.vulns import SEVERITY_COLUMNS
from postura.operators import labelled_rows, month_spine, pack, splittable_side, top_per_key, unpack
from postura.plans.blocks import image_vuln_distribution_rows
from postura.plans.context import Ctx
from postura.plans.hosts import subject_counts
from postura.sources.tables import Tables


def image_assurance_control_summary(t: Tables, ctx: Ctx) -> DataFrame:
    """Per assurance control over image scans: images checked, pass and fail rates (they may
    add up to more than 100%: an image can pass in one scan and fail in another)."""
    return (
        subject_counts(t, "image", "image_id")
        .withColumnRenamed("checked", "images_checked")
        .select(
            "control",
            "images_checked",
            pct_label("passed", "images_checked").alias("pass_rate"),
            pct_label("failed", "images_checked").alias("fail_rate"),
        )
        .orderBy(F.col("images_checked").desc())
    )


def image_count_over_time(t: Tables, ctx: Ctx) -> DataFrame:
    """Per month of the last 12: images created up to that spine instant (running count) and
    images created in that calendar month (by 'MMyy' key).

    Instead of one ``created <= instant`` count per spine row, every image gets the index of
    the first spine instant at or after its creation (equi-join on year-month against the
    12-row spine), the images are counted per (index, 'MMyy' key) in one aggregation, and
    the running count is a cumulative sum over 12 rows.
    """
    spine = month_spine(ctx.spark, ctx.as_of)
    now = as_of_literal(ctx.as_of)
    hi = F.year(now) * 12 + F.month(now) - 1
    lo = hi - 11
    ri = t["registry_images"].where(F.col("created").isNotNull()).select(
        "created",
        (F.year("created") * 12 + F.month("created") - 1).alias("ym"),
        F.date_format("created", "MMyy").alias("mkey"),
    )
    inst = spine.select(F.col("ym").alias("s_ym"), F.col("idx").alias("s_idx"), F.col("datemonth").alias("s_at"))
    placed = ri.join(F.broadcast(inst), F.col("ym") == F.col("s_ym"), "left")
    bucket = (
        F.when(F.col("ym") < lo, F.lit(1))
        .when(F.col("ym") > hi, F.lit(None))
        .when(F.col("created") <= F.col("s_at"), F.col("s_idx"))
        .when(F.col("s_idx") < 12, F.col("s_idx") + 1)
    )
    counts = placed.groupBy(bucket.alias("bucket"), "mkey").agg(F.count(F.lit(1)).alias("n"))
    # counts has at most 13 x 1200 rows (bucket x two-digit month/year key)
    by_bucket = counts.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("n").alias("n_bucket"))
    by_key = counts.groupBy("mkey").agg(F.sum("n").alias("added"))
    running = F.sum(F.coalesce(F.col("n_bucket"), F.lit(0))).over(
        Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        spine.join(F.broadcast(by_bucket), spine["idx"] == by_bucket["bucket"], "left")
        .join(F.broadcast(by_key), "mkey", "left")
        .select("datemonth", "month", running.alias("running_count"), F.coalesce("added", F.lit(0)).alias("added"))
        .orderBy(F.col("datemonth").desc())
        .select(
            "month",
            F.col("running_count").cast("bigint").alias("running_count"),
            F.col("added").cast("bigint").alias("added"),
        )
    )


def image_growth_metrics(t: Tables, ctx: Ctx) -> DataFrame:
    """Images created in the ISO week and in the calendar month of the report date (each paired
    with the calendar year)."""
    today = as_of_date(ctx.as_of)
    c = F.col("created")
    same_year = F.year(c) == F.year(today)
    counts = t["registry_images"].agg(
        F.count_if((F.weekofyear(c) == F.weekofyear(today)) & same_year).alias("week"),
        F.count_if((F.month(c) == F.month(today)) & same_year).alias("month"),
    )
    return labelled_rows(
        counts,
        [("Images added this week", F.col("week")), ("Images added this month", F.col("month"))],
        ("metric", "value"),
    )


def _image_scans(t: Tables) -> DataFrame:
    """Image scans with their image's repository name."""
    ri = t["registry_images"].select(F.col("id").alias("image_id"), "repository_id")
    rr = t["registry_repositories"].select(F.col("id").alias("repository_id"), F.col("name").alias("repo_name"))
    return ri.join(rr, "repository_id").select("image_id", "repo_name")


def image_ia_repo_results(t: Tables, ctx: Ctx) -> DataFrame:
    """Top 10 repositories by assurance-control fail rate (ties: repository name)."""
    sc = t["scans"].where(F.col("type") == "image").select(F.col("id").alias("scan_id"), "image_id")
    sar = t["scan_assurance_results"].select("scan_id", "control", "failed")
    rows = sc.join(_image_scans(t), "image_id").join(sar, "scan_id")
    # the fact is reduced once; images and controls are counted on the small relation
    per_image = rows.groupBy(F.col("repo_name").alias("repository_name"), "image_id", "control").agg(
        F.max(F.col("failed") == F.lit(True)).alias("any_failed"), F.max(F.col("failed") == F.lit(False)).alias("any_passed")
    )
    images = per_image.groupBy("repository_name").agg(F.count_distinct("image_id").alias("num_of_images"))
    per_control = per_image.groupBy("repository_name", "control").agg(F.max("any_failed").alias("f"), F.max("any_passed").alias("p"))
    controls = per_control.groupBy(F.col("repository_name").alias("c_name")).agg(
        F.count("control").alias("controls_checked"),
        F.count(F.when(F.col("p"), F.col("control"))).alias("passed"),
        F.count(F.when(F.col("f"), F.col("control"))).alias("failed"),
    )
    agg = images.join(controls, F.col("repository_name").eqNullSafe(F.col("c_name")))
    return (
        agg.orderBy(
            (F.col("failed").cast("double") / F.col("controls_checked")).desc_nulls_first(),
            F.col("repository_name").asc_nulls_last(),
        )
        .limit(10)
        .select(
            "repository_name",
            "num_of_images",
            "controls_checked",
            pct_label("passed", "controls_checked").alias("pass_rate"),
            pct_label("failed", "controls_checked").alias("fail_rate"),
        )
    )


def image_inventory_stats(t: Tables, ctx: Ctx) -> DataFrame:
    """Six inventory figures as (metric, value) text rows. Each distinct count is an aggregate of its own over
    one column, reduced map-side: a columnar table is read no more than once in all, and no row is repeated."""

    def distinct(table: DataFrame, column: str, name: str) -> DataFrame:
        return table.agg(F.count_distinct(column).alias(name))

    c, ri = t["containers"], t["registry_images"]
    one = (
        distinct(c.where(F.col("status") == "running"), "id", "running")
        .crossJoin(distinct(c, "oci_image_id", "images_in_containers"))
        .crossJoin(distinct(ri, "registry_id", "registries"))
        .crossJoin(distinct(ri, "repository_id", "repositories"))
        .crossJoin(distinct(ri, "id", "images"))
    )
    txt = lambda name: F.col(name).cast("string")
    return labelled_rows(
        one,
        [
            ("Number of containers", txt("running")),
            ("Number of registries", txt("registries")),
            ("Number of repositories", txt("repositories")),
            ("Number of images", txt("images")),
            ("Number of images in running containers", txt("images_in_containers")),
            ("% of images scanned and running", pct_label("images_in_containers", "images", "fm990D00%")),
        ],
        ("metric", "value"),
    )


def image_repo_scans(t: Tables, ctx: Ctx) -> DataFrame:
    """Top 10 repositories by number of image scans (ties: name). Scans are counted per
    image before the repository join."""
    per_image = (
        t["scans"].where(F.col("type") == "image").groupBy("image_id").agg(F.count("id").alias("n"))
    )
    return (
        per_image.join(_image_scans(t), "image_id")
        .groupBy(F.col("repo_name").alias("name"))
        .agg(F.sum("n").alias("scans"))
        .orderBy(F.col("scans").desc(), F.col("name").asc_nulls_last())
        .limit(10)
    )


_SHARE_NAMES = ("critical", "high", "medium", "low", "negligible")


def image_repo_vuln_severity_distribution(t: Tables, ctx: Ctx) -> DataFrame:
    """Top 10 repositories by total vulnerabilities with the share of each severity
    (denominator total + 0.1, evaluated exactly as (10 x part) / (10 x total + 1))."""
    rows = image_vuln_distribution_rows(t, with_repo=True)
    agg = rows.groupBy("repo_name").agg(
        F.count("image_name").alias("num_images"),
        F.sum("total_vulns").alias("s_total"),
        *[(F.sum(c) * 10).alias(f"x_{c}") for c in SEVERITY_COLUMNS],
    )
    top = (
        agg.withColumn("total_vulns", F.col("s_total").cast("bigint"))
        .orderBy(F.col("total_vulns").desc_nulls_first(), F.col("repo_name").asc_nulls_last())
        .limit(10)
    )
    return top.withColumn("den", F.col("s_total") * 10 + 1).select(
        "repo_name",
        "num_images",
        "total_vulns",
        *[pct_label(f"x_{c}", "den").alias(label) for c, label in zip(SEVERITY_COLUMNS, _SHARE_NAMES)],
    )


def image_vulns_distribution(t: Tables, ctx: Ctx) -> DataFrame:
    """Severity shares for images used by containers vs. other scanned images."""
    rows = image_vuln_distribution_rows(t, with_repo=False)
    label = (
        F.when(F.col("containers_exist") == 1, F.lit("In running containers"))
        .when(F.col("containers_exist") == 0, F.lit("In other scanned images"))
    )
    return (
        rows.groupBy("containers_exist")
        .agg(F.sum("total_vulns").alias("s_total"), *[F.sum(c).alias(f"s_{c}") for c in SEVERITY_COLUMNS])
        .orderBy(F.col("containers_exist").desc())
        .select(
            label.alias("images"),
            *[pct_label(f"s_{c}", "s_total", "99D00%").alias(n) for c, n in zip(SEVERITY_COLUMNS, _SHARE_NAMES)],
        )
    )


# ---------------------------------------------------------------- vulnerability fix age


def _repo_images(t: Tables) -> DataFrame:
    """Images that have metadata, with repository and creation date; one row an image, packed, as both
    the findings and the picks are made from it."""
    ri = t["registry_images"].where(F.col("repository_id").isNotNull()).select(
        F.col("id").alias("image_id"),
        F.to_date("created").alias("create_date"),
        F.col("repository_id").alias("repo_id"),
        F.col("name").alias("image_name"),
    )
    return splittable_side(pack(ri.join(t["image_metadata"].select("image_id"), "image_id", "left_semi"), ["image_id", "repo_id"]))


_IMAGE = ("image_id", "create_date", "repo_id", "image_name")
_VULN = ("vuln_id", "resource_id", "vuln_name")
_VULN_DETAIL = ("resource_name", "resource_version", "vuln_severity", "vuln_score", "fix_version")


def _vulnerabilities(t: Tables, ctx: Ctx, detail: bool) -> DataFrame:
    """Vulnerabilities of known resources, packed; with what the detail report prints of them if asked for."""
    krv = t["known_resource_vulnerabilities"].where(F.col("issue_type") == "vulnerability")
    columns = [F.col("id").alias("vuln_id"), "resource_id", F.col("name").alias("vuln_name")]
    kr = t["known_resources"].select(F.col("id").alias("resource_id"), F.col("name").alias("resource_name"), F.col("version").alias("resource_version"))
    if not detail:
        return splittable_side(pack(krv.select(*columns).join(kr.select("resource_id"), "resource_id", "left_semi"), _VULN[:2]))
    columns += [vuln_severity("", ctx.severity_fn).alias("vuln_severity"), vuln_score().alias("vuln_score"), "fix_version"]
    return splittable_side(pack(krv.select(*columns).join(kr, "resource_id").select(*_VULN, *_VULN_DETAIL), _VULN[:2]))


def _repo_vuln_facts(t: Tables, dim: DataFrame, vulns: DataFrame) -> DataFrame:
    """Per (repository, vulnerability name): lowest vulnerability id and the first and last
    creation date of the scanned images affected.

    The image scans meet their resources first, both by scan id (no shuffle where a snapshot lies bucketed by it), and are
    reduced to (repository, resource) date ranges before they meet the vulnerabilities; min/max are
    unaffected by that reduction.
    """
    sc = t["scans"].where((F.col("type") == "image") & F.col("image_id").isNotNull()).select(F.col("id").alias("scan_id"), "image_id")
    sr = t["scan_resources"].select("scan_id", "resource_id")
    per_resource = (
        sc.join(sr, "scan_id")
        .select("image_id", "resource_id")
        .join(unpack(dim, ["image_id", "repo_id", "create_date"], ["image_id", "repo_id"]), "image_id")
        .groupBy("repo_id", "resource_id")
        .agg(F.min("create_date").alias("lo"), F.max("create_date").alias("hi"))
    )
    return (
        per_resource.join(unpack(vulns, _VULN, _VULN[:2]), "resource_id")
        .groupBy("repo_id", "vuln_name")
        .agg(F.min("vuln_id").alias("vuln_id"), F.min("lo").alias("min_date"), F.max("hi").alias("max_date"))
        .where(F.col("min_date").isNotNull())
    )


def _repo_picks(t: Tables, dim: DataFrame) -> DataFrame:
    """One row per repository: its days (``days``, and beside them in ``picks`` the lowest and the highest image of each
    day), its newest image (``top``: date DESC NULLS FIRST, id DESC) and its second-newest dated one.

    The images are reduced to one row per repository and day, then to one per repository with at most as many
    entries as there are days since its first image. The second-newest image comes from a top-2 that is
    limited ahead of the shuffle.
    """
    image = F.struct("image_id", "image_name")
    rows = unpack(dim, _IMAGE, ["image_id", "repo_id"])
    per_day = rows.groupBy("repo_id", "create_date").agg(F.min(image).alias("lowest"), F.max(image).alias("highest"))
    dated = F.col("create_date").isNotNull()
    per_repo = per_day.groupBy("repo_id").agg(
        F.collect_list(F.when(dated, F.struct("create_date", "lowest", "highest"))).alias("days"),
        F.max(F.when(dated, F.struct("create_date", "highest"))).alias("newest"),
        F.max(F.when(~dated, F.col("highest"))).alias("undated"),
    )
    second = (
        top_per_key(
            rows, ["repo_id"], [F.col("create_date").desc_nulls_last(), F.col("image_id").desc()], k=2, rank_col="rk"
        )
        .where((F.col("rk") == 2) & dated)
        .select("repo_id", F.col("image_id").alias("second_id"), F.col("create_date").alias("second_date"), F.col("image_name").alias("second_name"))
    )
    top = F.coalesce("undated", "newest.highest")
    rr = t["registry_repositories"].select(F.col("id").alias("repo_id"), F.col("registry_id").alias("registry"), F.col("name").alias("repo_name"))
    return (
        per_repo.join(second, "repo_id", "left")
        .join(rr, "repo_id")
        .select(
            "repo_id", "registry", "repo_name",
            F.col("days.create_date").alias("days"),
            F.transform("days", lambda d: F.struct(d["lowest"].alias("lowest"), d["highest"].alias("highest"))).alias("picks"),
            top["image_id"].alias("top_id"),
            F.when(F.col("undated").isNull(), F.col("newest.create_date")).alias("top_date"),
            top["image_name"].alias("top_name"),
            "second_id", "second_date", "second_name",
        )
    )


def _repo_vulns(t: Tables, ctx: Ctx, detail: bool) -> DataFrame:
    """Per repository x vulnerability: where it was first and last seen, the repository's newest
    image, the image that fixed it, the age in days and whether it is fixed.

    first = lowest image id created on the first date; last = highest image id created on the
    last date; top = newest image (date DESC NULLS FIRST, id DESC); next = the second-newest
    image with a date after the first date, else top. The second is the rank-2 image among
    dated images: dated images after the first date are a prefix of that order.

    All images come from one relation, which is shuffled once: the findings join it on the image, the picks
    are aggregated from it, and the findings join the picks once, by repository. A repository has at
    most one finding for each vulnerability name, so no repository is hot in that join.
    """
    dim, vulns = _repo_images(t), _vulnerabilities(t, ctx, detail)
    facts = _repo_vuln_facts(t, dim, vulns)
    picked = facts.join(_repo_picks(t, dim), "repo_id")

    def pick(day: str, which: str) -> Column:
        return F.get("picks", (F.array_position("days", F.col(day)) - 1).cast("int"))[which]

    j = picked.select(
        "repo_id", "vuln_name", "vuln_id", "min_date", "max_date", "registry", "repo_name",
        "top_id", "top_date", "top_name", "second_id", "second_date", "second_name",
        pick("min_date", "lowest").alias("first"),
        pick("max_date", "highest").alias("last"),
    ).select(
        "*",
        F.col("first.image_id").alias("first_id"), F.col("first.image_name").alias("first_name"),
        F.col("last.image_id").alias("last_id"), F.col("last.image_name").alias("last_name"),
    ).drop("first", "last")
    use_second = F.col("second_date") > F.col("min_date")
    next_id = F.when(use_second, F.col("second_id")).otherwise(F.col("top_id"))
    next_date = F.when(use_second, F.col("second_date")).otherwise(F.col("top_date"))
    next_name = F.when(use_second, F.col("second_name")).otherwise(F.col("top_name"))
    today = as_of_date(ctx.as_of)
    same_date = F.col("max_date") == F.col("min_date")
    is_top = F.col("top_id") == F.col("last_id")
    age = (
        F.when(F.col("last_id") == F.col("first_id"), F.datediff(today, F.col("min_date")))
        .when(is_top, F.datediff(today, F.col("min_date")))
        .when(same_date, F.datediff(next_date, F.col("min_date")))
        .otherwise(F.datediff(F.col("max_date"), F.col("min_date")))
    )
    fixed = F.when(is_top, F.lit(False)).otherwise(F.lit(True))
    j = j.select("*", age.alias("age_in_days"), fixed.alias("fixed"))
    if not detail:
        return j
    vd = unpack(vulns, ["vuln_id", *_VULN_DETAIL], ["vuln_id"])
    fixed_in = F.when(is_top, F.lit("")).when(same_date, next_name).otherwise(F.col("last_name"))
    fix_date = F.when(is_top, F.lit(None).cast("date")).when(same_date, next_date).otherwise(F.col("max_date"))
    return j.join(vd, "vuln_id").select(
        "registry",
        "repo_name",
        "vuln_name",
        "resource_name",
        "resource_version",
        "vuln_severity",
        "vuln_score",
        "fix_version",
        F.col("first_name").alias("first_found_image"),
        F.col("min_date").alias("first_found_image_date"),
        "age_in_days",
        "fixed",
        fixed_in.alias("fixed_in_image"),
        fix_date.alias("fix_image_date"),
    )


def vuln_fix_age_detail(t: Tables, ctx: Ctx) -> DataFrame:
    """The per-vulnerability relation the fix-age summary averages, with its image, score and
    severity columns, in no order (its only reader aggregates it)."""
    return _repo_vulns(t, ctx, detail=True)


def image_vuln_fix_age_summary(t: Tables, ctx: Ctx) -> DataFrame:
    """Average age in days of each vulnerability per registry, repository name and fixed flag."""
    rv = _repo_vulns(t, ctx, detail=False)
    return (
        rv.groupBy("registry", "repo_name", "fixed")
        .agg(F.sum("age_in_days").alias("s_age"), F.count("age_in_days").alias("n_age"))
        .select("registry", "repo_name", "fixed", avg_int("s_age", "n_age").alias("avg_age_in_days"))
        .orderBy(F.col("avg_age_in_days").desc_nulls_first())
    )
