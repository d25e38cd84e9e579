"""CSV sink: one header-first CSV output per report, as one file or as a folder of parts.

Executors write the part files in parallel; no row is collected to the driver or gathered in one task. One file is
put together from a header and headerless parts by the file system (``files.Files.join``). The path may
be local, HDFS or an object store (``s3a://bucket/<env>-<timestamp>/``), which replaces the
separate upload step of the source tool. NULL and the empty string are both written as an
empty field, as the source tool's ``csv.writer`` does; quotes are doubled likewise. Reports print
wall-clock timestamps in UTC, without an offset.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura.sources.files import Files


def _timestamp_text(name: str):
    """'yyyy-MM-dd HH:mm:ss', with '.SSSSSS' only when the fraction is not zero."""
    c = F.col(name)
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    ).alias(name)


def _bool_text(name: str):
    c = F.col(name)
    return F.when(c, F.lit("True")).when(~c, F.lit("False")).alias(name)


def csv_ready(df: DataFrame) -> DataFrame:
    """Text forms of a Python CSV writer: timestamps as ``str(datetime)``, booleans as
    ``True``/``False``."""
    ts = (T.TimestampType, T.TimestampNTZType)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ts):
            cols.append(_timestamp_text(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(_bool_text(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _written(df: DataFrame, path: str, header: bool, mode: str) -> None:
    (
        csv_ready(df)
        .write.mode(mode)
        .option("header", header)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')  # a quote inside a value is doubled, as Python's csv module does
        .option("ignoreLeadingWhiteSpace", False)  # keep the padding of labels such as '  40.00%'
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as header-first CSV part files under ``path``."""
    _written(df, path, True, mode)


def write_csv_file(df: DataFrame, path: str) -> int:
    """Write ``df`` as one CSV file ``path``: the header, then the rows in the order of its partitions. Returns the number
    of rows, which is counted while they are written."""
    files = Files(df.sparkSession, path)
    parts = f"{path}.parts"
    rows = Observation()
    files.delete(parts)
    try:
        _written(df.observe(rows, F.count(F.lit(1)).alias("rows")), parts, False, "overwrite")
        header = io.StringIO()
        csv.writer(header, lineterminator="\n").writerow(df.columns)
        files.write(path, header.getvalue().encode())
        files.join(path, files.parts(parts))
    finally:
        files.delete(parts)
    return rows.get["rows"]


def report_path(out_dir: str, key: str, single: bool = True) -> str:
    """``<out_dir>/<key>_results.csv``, the file of one report, or ``<out_dir>/<key>_results``, its folder."""
    return f"{out_dir.rstrip('/')}/{key}_results{'.csv' if single else ''}"
