from postura.functions.jsonfn import json_array_text, json_fields, json_object_entries, json_text
from postura.functions.numeric import avg_int, idiv, pct_label, round_ratio
from postura.functions.timefn import as_of_date, as_of_literal, epoch_to_ts, month_key, month_label
from postura.functions.vulns import catalog_severity, default_severity, total_vulns, vuln_score, vuln_severity

__all__ = [
    "as_of_date",
    "as_of_literal",
    "avg_int",
    "catalog_severity",
    "default_severity",
    "epoch_to_ts",
    "idiv",
    "json_array_text",
    "json_fields",
    "json_object_entries",
    "json_text",
    "month_key",
    "month_label",
    "pct_label",
    "round_ratio",
    "total_vulns",
    "vuln_score",
    "vuln_severity",
]
