"""Table registry: the reports read their inputs by name from a ``Tables`` object.

Loaders:
  * ``from_parquet``  – one directory (or file) per table under a root path.
  * ``from_jdbc``     – the operational and audit databases over JDBC, fact tables in parallel
                        slices (``slicing``).
  * ``from_catalog``  – tables registered in the session catalog (lakehouse/metastore).
  * ``from_frames``   – DataFrames built by the caller (unit tests).

Tables are created lazily on first use and cached in the registry, so a report only
touches the sources it reads. Schema-qualified names (``public.audit``) resolve to the bare
name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postura.schemas import AUDIT_TABLES, COLUMNS, FACT_TABLES, POSTURE_TABLES
from postura.sources.slicing import Slicing, small_result


def wall_clock(df: DataFrame) -> DataFrame:
    """Zoned timestamp columns become wall-clock TIMESTAMP_NTZ (in the session zone, UTC in
    the shipped session settings), so every report compares like with like and its result
    does not change with the session zone. A projection only: no extra pass over the data."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Tables:
    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]]):
        self._factories = dict(factories)
        self._cache: dict[str, DataFrame] = {}

    @staticmethod
    def _bare(name: str) -> str:
        return name.split(".")[-1]

    def __getitem__(self, name: str) -> DataFrame:
        key = self._bare(name)
        if key not in self._cache:
            if key not in self._factories:
                raise KeyError(f"table {name!r} is not registered")
            self._cache[key] = self._factories[key]()
        return self._cache[key]

    def __contains__(self, name: str) -> bool:
        return self._bare(name) in self._factories

    def names(self) -> list[str]:
        return sorted(self._factories)

    def missing_columns(self, required: Mapping[str, Iterable[str]] = COLUMNS) -> dict[str, list[str]]:
        """Columns the reports read that a registered table lacks (schema only, no job)."""
        out = {}
        for name, cols in required.items():
            if name in self:
                have = {c.lower() for c in self[name].columns}
                lacking = [c for c in cols if c.lower() not in have]
                if lacking:
                    out[name] = lacking
        return out

    def having(self, frames: Mapping[str, Callable[[], DataFrame]]) -> Tables:
        """These tables and more, or others under the same names."""
        more = Tables(self._factories | dict(frames))
        more._cache = {k: df for k, df in self._cache.items() if k not in frames}
        return more

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Tables:
        return cls({k: (lambda df=df: df) for k, df in frames.items()})

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        root: str,
        names: Iterable[str] = POSTURE_TABLES,
        fmt: str = "parquet",
        suffix: str = "",
    ) -> Tables:
        base = root.rstrip("/")
        return cls({n: (lambda n=n: wall_clock(spark.read.format(fmt).load(f"{base}/{n}{suffix}"))) for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names: Iterable[str] = POSTURE_TABLES) -> Tables:
        """Tables registered in the session catalog (lakehouse or metastore tables), e.g. a
        snapshot whose scan-keyed facts are bucketed by scan id so their joins need no shuffle."""
        return cls({n: (lambda n=n: wall_clock(spark.table(f"{database}.{n}"))) for n in names})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        operational: JdbcSource,
        audit: JdbcSource | None = None,
        names: Iterable[str] = POSTURE_TABLES,
    ) -> Tables:
        """The audit table comes from ``audit`` (the audit database); every other table from
        ``operational``. A missing audit source falls back to the operational one."""
        audit_src = audit or operational
        return cls(
            {n: (lambda n=n: wall_clock((audit_src if n in AUDIT_TABLES else operational).read(spark, n))) for n in names}
        )


@dataclass(frozen=True)
class Partitioning:
    """Parallel JDBC read with bounds given by hand: ``num_partitions`` equal ranges of a numeric column."""

    column: str
    lower: int
    upper: int
    num_partitions: int


@dataclass(frozen=True)
class JdbcSource:
    """One database. A table is read by one task, by equal ranges (``partitioning``) or by slices whose cuts the database
    itself gives (``slicing``); a fact table must have one of the last two."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str = "org.postgresql.Driver"
    schema: str = "public"
    fetch_size: int = 10000
    partitioning: Mapping[str, Partitioning] = field(default_factory=dict)
    slicing: Mapping[str, Slicing] = field(default_factory=dict)

    def relation(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def connection(self) -> dict[str, str]:
        opts = {"driver": self.driver, "fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true"}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        return opts

    def options(self, table: str) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.relation(table), **self.connection()}
        part = self.partitioning.get(table)
        if part is not None:
            opts.update(
                partitionColumn=part.column,
                lowerBound=str(part.lower),
                upperBound=str(part.upper),
                numPartitions=str(part.num_partitions),
            )
        return opts

    def query(self, spark: SparkSession, sql: str) -> list:
        """The few rows of a query that the database answers."""
        return small_result(spark.read.format("jdbc").options(url=self.url, query=sql, **self.connection()).load())

    def predicates(self, spark: SparkSession, table: str) -> list[str]:
        """One condition a slice; together they hold for each row exactly once."""
        slicing = self.slicing[table]
        return slicing.predicates(self.query(spark, slicing.cuts_query(self.relation(table))))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if table in self.partitioning:
            return spark.read.format("jdbc").options(**self.options(table)).load()
        if table in self.slicing:
            return spark.read.jdbc(self.url, self.relation(table), predicates=self.predicates(spark, table), properties=self.connection())
        if table in FACT_TABLES:
            raise ValueError(f"{table} is a fact table: read it in slices (slicing or partitioning), not in one task")
        return spark.read.format("jdbc").options(**self.options(table)).load()
