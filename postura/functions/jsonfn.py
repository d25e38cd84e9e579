"""JSON text columns (PostgreSQL jsonb in the source system).

``->>`` maps to ``get_json_object`` (JSON null gives SQL NULL, nested values come back as raw
JSON text). When one report reads several top-level fields of the same document, parse it once
with ``from_json`` into a struct of strings instead of calling ``get_json_object`` per field.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(col: str | Column, *path: str | int) -> Column:
    """``col #>> '{path}'``: a field as text. Integers in ``path`` index arrays."""
    expr = "$"
    for step in path:
        expr += f"[{step}]" if isinstance(step, int) else f".{step}"
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, expr)


def json_fields(col: str | Column, fields: Iterable[str]) -> Column:
    """Parse a JSON object once into a struct whose fields are all strings."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def json_array_text(col: str | Column) -> Column:
    """``jsonb_array_elements_text`` source: a JSON array as array<string> (numbers as text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, "array<string>")


def json_object_entries(col: str | Column) -> Column:
    """``jsonb_each`` source: a JSON object as map<string,variant>, so that a text value that looks like an
    object stays a text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, "map<string,variant>")
