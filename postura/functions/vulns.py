"""Vulnerability-count and vulnerability-score expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVERITY_COLUMNS = ("crit_vulns", "high_vulns", "med_vulns", "low_vulns", "neg_vulns")


def total_vulns(prefix: str = "") -> Column:
    """crit + high + med + low + neg; NULL as soon as one addend is NULL."""
    cols = [F.col(prefix + c) for c in SEVERITY_COLUMNS]
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def vuln_score(krv: str = "") -> Column:
    """Score ladder: vendor CVSS3, NVD CVSS3 (no vendor severity), vendor CVSS2, NVD CVSS2, else 0."""
    p = krv
    vendor_sev_empty = F.col(p + "vendor_severity") == ""
    return (
        F.when(F.col(p + "vendor_cvss3_score") > 0, F.col(p + "vendor_cvss3_score"))
        .when((F.col(p + "nvd_cvss3_score") > 0) & vendor_sev_empty, F.col(p + "nvd_cvss3_score"))
        .when(F.col(p + "vendor_cvss2_score") > 0, F.col(p + "vendor_cvss2_score"))
        .when(vendor_sev_empty, F.col(p + "nvd_cvss2_score"))
        .otherwise(F.lit(0.0))
        .cast("double")
    )


def default_severity(krv: str = "") -> Column:
    """Stand-in for the product's own severity function, whose body is not published:
    vendor severity, else NVD CVSS3 severity, else 'unknown' (empty strings count as missing)."""
    return F.coalesce(
        F.nullif(F.col(krv + "vendor_severity"), F.lit("")),
        F.nullif(F.col(krv + "nvd_cvss3_severity"), F.lit("")),
        F.lit("unknown"),
    )


SeverityFn = Callable[[str], Column]


def catalog_severity(function: str, arguments: Sequence[str]) -> SeverityFn:
    """A severity rule kept in the catalogue: ``function`` (any SQL or other scalar function the session can resolve) of
    the named vulnerability columns. A SQL function (``CREATE FUNCTION ... RETURN ...``) becomes part of the plan."""
    return lambda krv: F.call_function(function, *[F.col(krv + a) for a in arguments])


def vuln_severity(krv: str = "", severity_fn: SeverityFn = default_severity) -> Column:
    """NVD CVSS3 severity when only it is present, else ``severity_fn`` of the same row."""
    nvd = F.col(krv + "nvd_cvss3_severity").cast("string")
    vendor = F.col(krv + "vendor_severity").cast("string")
    return F.when((nvd != "") & (vendor == ""), nvd).otherwise(severity_fn(krv))
