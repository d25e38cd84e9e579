"""Slices of a table read over JDBC: queries and conditions only, as no database may be started here. DuckDB answers
the conditions over a plain table, so that each row is seen to fall into exactly one slice."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import Row

from postura.runner import arguments, jdbc_sources
from postura.schemas import COLUMNS, FACT_TABLES
from postura.sources import JdbcSource, Slicing, fact_slicing
from postura.sources.slicing import predicates


def _counts(keys, conditions):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT)")
    con.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])
    return [con.execute(f"SELECT count(*) FROM t WHERE {c}").fetchone()[0] for c in conditions]


@pytest.mark.parametrize("cuts", [[], [5], [3, 3, 3], [1, 7, 7, 90], [-4, 0, 100]])
def test_every_row_is_in_one_slice(cuts):
    keys = [None, None, -10, -4, 0, 1, 3, 3, 3, 5, 7, 50, 90, 100, 10**12]
    conditions = predicates("k", cuts)
    assert sum(_counts(keys, conditions)) == len(keys) and len(conditions) == len(set(cuts)) + 1


def test_quantiles_part_uneven_keys_evenly():
    r = random.Random(1)
    # two sequences far apart, most rows in the second
    keys = [r.randrange(1000) for _ in range(300)] + [10**9 + r.randrange(5000) for _ in range(2700)]
    slicing = Slicing("k", 10, sample_percent=100)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT)")
    con.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])
    shares = [i / 10 for i in range(1, 10)]
    assert f"ARRAY[{', '.join(f'{s:.6f}' for s in shares)}]" in slicing.cuts_query("t") and "TABLESAMPLE" not in slicing.cuts_query("t")
    cuts = con.execute(f"SELECT quantile_disc(k, {shares}) FROM t").fetchone()[0]
    counts = _counts(keys, slicing.predicates([Row(cuts=cuts)]))
    assert len(counts) == 10 and sum(counts) == 3000 and max(counts) < 400
    even = Slicing("k", 10, even=True)
    assert even.cuts_query("s.t") == "SELECT min(k) AS lo, max(k) AS hi FROM s.t"
    counts = _counts(keys, even.predicates([Row(lo=min(keys), hi=max(keys))]))
    assert sum(counts) == 3000 and max(counts) == 2700  # equal ranges leave most slices empty


def test_queries_and_edges():
    assert Slicing("id", 4).cuts_query("public.scans") == (
        "SELECT percentile_disc(ARRAY[0.250000, 0.500000, 0.750000]::double precision[]) WITHIN GROUP (ORDER BY id) AS cuts "
        "FROM public.scans TABLESAMPLE SYSTEM (1)"
    )
    for empty in ([], [Row(cuts=None)], [Row(cuts=[])], [Row(cuts=[None])]):
        assert Slicing("id", 4).predicates(empty) == ["1 = 1"]
    assert Slicing("id", 4, even=True).predicates([Row(lo=None, hi=None)]) == ["1 = 1"]
    assert Slicing("id", 2, even=True).predicates([Row(lo=0, hi=9)]) == ["id < 5 OR id IS NULL", "id >= 5"]
    for bad in ((0, 1.0), (3, 0), (3, 101)):
        with pytest.raises(ValueError):
            Slicing("id", bad[0], sample_percent=bad[1])


def test_facts_are_sliced_by_a_column_they_have():
    assert all(column in COLUMNS[table] for table, column in FACT_TABLES.items())
    given = Slicing("createtime", 9)
    slicing = fact_slicing(16, {"audit": given})
    assert set(slicing) == set(FACT_TABLES) and slicing["audit"] is given and slicing["scans"] == Slicing("id", 16)


def test_the_source_asks_the_database_and_reads_by_its_cuts():
    asked, read = [], []

    class Answering(JdbcSource):
        def query(self, spark, sql):
            asked.append(sql)
            return [Row(cuts=[10, 20])]

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            read.append((url, table, predicates, properties["user"]))
            return "frame"

    class Session:
        read = Reader()

    source = Answering(url="jdbc:x", user="u", slicing=fact_slicing(3))
    assert source.read(Session(), "scan_resources") == "frame"
    assert asked == [Slicing("scan_id", 3).cuts_query("public.scan_resources")]
    assert read == [("jdbc:x", "public.scan_resources", ["scan_id < 10 OR scan_id IS NULL", "scan_id >= 10 AND scan_id < 20", "scan_id >= 20"], "u")]


def test_flags():
    base = ["--jdbc-url", "jdbc:x", "--out", "o"]
    op, audit = jdbc_sources(arguments(base))
    assert op.slicing == audit.slicing == fact_slicing(64)
    op, _ = jdbc_sources(arguments([*base, "--slices", "8", "--slice", "audit:createtime:5", "--slice", "hosts:id:2:even"]))
    assert op.slicing == fact_slicing(8) | {"audit": Slicing("createtime", 5), "hosts": Slicing("id", 2, even=True)}
    op, _ = jdbc_sources(arguments([*base, "--slices", "0"]))
    assert op.slicing == {}
    with pytest.raises(ValueError):
        jdbc_sources(arguments([*base, "--slice", "audit:id:5:odd"]))
