from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from postura.functions.vulns import SeverityFn, default_severity


@dataclass(frozen=True)
class Ctx:
    """What a report needs besides its tables.

    ``as_of`` replaces ``now()`` / ``current_date`` / ``current_timestamp`` so a report is a
    pure function of its inputs. ``severity_fn`` stands in for the product's severity
    function (see ``functions.vulns.default_severity``).
    """

    spark: SparkSession
    as_of: str
    severity_fn: SeverityFn = default_severity
