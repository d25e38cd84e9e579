"""Slices of a database table, with cuts that the database itself gives.

A table is read over JDBC in one query a slice. Equal ranges between the smallest and the largest key leave most
slices empty where keys are uneven (old rows purged, ids from several sequences), so the cuts are quantiles of the key,
by default of a sample of the table's pages. The cuts only place the borders: the first slice also holds all smaller
keys and the rows without key, the last one all larger keys, so every row is in exactly one slice however
the cuts were found and whatever was written since.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from postura.schemas import FACT_TABLES


def small_result(df: DataFrame) -> list:
    """The rows of a one-row aggregate."""
    return df.limit(1).collect()  # bounded: one row with one number a slice


@dataclass(frozen=True)
class Slicing:
    """``slices`` slices of ``column``. ``sample_percent`` 100 takes the quantiles of the whole table, less those of a
    sample of its pages; ``even`` takes equal ranges between the bounds instead, which an index answers at once."""

    column: str
    slices: int
    sample_percent: float = 1.0
    even: bool = False

    def __post_init__(self) -> None:
        if self.slices < 1 or not 0 < self.sample_percent <= 100:
            raise ValueError("slices must be positive and the sample a percentage above 0")

    def cuts_query(self, relation: str) -> str:
        """SQL of one row: (lo, hi) for equal ranges, else ``cuts``, the inner quantiles."""
        if self.even:
            return f"SELECT min({self.column}) AS lo, max({self.column}) AS hi FROM {relation}"
        shares = ", ".join(f"{i / self.slices:.6f}" for i in range(1, self.slices))
        sample = "" if self.sample_percent == 100 else f" TABLESAMPLE SYSTEM ({self.sample_percent:g})"
        quantiles = f"percentile_disc(ARRAY[{shares}]::double precision[]) WITHIN GROUP (ORDER BY {self.column})"
        return f"SELECT {quantiles} AS cuts FROM {relation}{sample}"

    def predicates(self, rows: list) -> list[str]:
        """Conditions of the slices from the row of ``cuts_query``; a table without keys is one slice."""
        row = rows[0].asDict() if rows else {}
        if self.even:
            lo, hi = row.get("lo"), row.get("hi")
            cuts = [] if lo is None else [lo + (hi - lo + 1) * i // self.slices for i in range(1, self.slices)]
        else:
            cuts = row.get("cuts") or []
        return predicates(self.column, cuts)


def predicates(column: str, cuts: Iterable) -> list[str]:
    """Conditions that part the table at the cuts; equal cuts (a key with many rows) count once."""
    borders = sorted({c for c in cuts if c is not None})
    if not borders:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(borders, borders[1:])]
    return [f"{column} < {borders[0]} OR {column} IS NULL", *inner, f"{column} >= {borders[-1]}"]


def fact_slicing(slices: int, given: Mapping[str, Slicing] | None = None) -> dict[str, Slicing]:
    """A slicing for every fact table, ``given`` ones first."""
    return {t: Slicing(column, slices) for t, column in FACT_TABLES.items()} | dict(given or {})
