from postura.sources.csv_sink import report_path, write_csv, write_csv_file
from postura.sources.files import Files
from postura.sources.slicing import Slicing, fact_slicing
from postura.sources.snapshot import read_snapshot, write_snapshot
from postura.sources.tables import JdbcSource, Partitioning, Tables

__all__ = [
    "Files", "JdbcSource", "Partitioning", "Slicing", "Tables", "fact_slicing", "read_snapshot", "report_path", "write_csv",
    "write_csv_file", "write_snapshot",
]
