"""Merkle manifest, mixture and periodic runs against plain versions: given and odd tables, repeated rows and null ids,
several blocks, skewed sources and keys, and their own parts."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from test_queries import ODD, SF, empty_dir, odd_dir, rows  # noqa: E402, F401

from postura.llm import merkle, mixture as mixing, periodic  # noqa: E402
from postura.llm.queries import QUERIES  # noqa: E402

COLUMNS = {
    "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_threshold_mixture": ["doc_id", "size", "source_size", "target", "taken"],
    "op13_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}
FIELDS = {"op11_merkle_manifest": brute.LEAF_FIELDS, "op12_threshold_mixture": ("doc_id", "source", "text"), "op13_periodic_runs": ("doc_id", "text")}
PLAIN = {"op11_merkle_manifest": brute.op11, "op12_threshold_mixture": brute.op12, "op13_periodic_runs": brute.op13}


@pytest.fixture(scope="module")
def repeated_dir(spark, odd_dir, tmp_path_factory):  # noqa: F811
    """The odd rows again, some of them many times, with null ids, null sources and every column null."""
    path = tmp_path_factory.mktemp("repeated")
    docs = spark.read.parquet(f"{odd_dir[0]}/documents.parquet")
    some = docs.filter("doc_id between 10 and 30")
    more = [some] * 12 + [some.selectExpr("cast(null as long) as doc_id", *docs.columns[1:]), some.selectExpr("doc_id", "text", "lang", "cast(null as string) as source", *docs.columns[4:])]
    more.append(docs.limit(3).selectExpr(*[f"cast(null as {t}) as {c}" for c, t in docs.dtypes]))
    for m in more:
        docs = docs.union(m)
    docs.repartition(5).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.mark.parametrize("name", sorted(COLUMNS))
@pytest.mark.parametrize("which", ["given", "odd", "repeated"])
def test_plain(spark, odd_dir, repeated_dir, name, which):  # noqa: F811
    where = {"given": SF, "odd": odd_dir[0], "repeated": repeated_dir}[which]
    given = [tuple(r) for r in spark.read.parquet(f"{where}/documents.parquet").select(*FIELDS[name]).collect()]
    assert rows(QUERIES[name](spark, where), COLUMNS[name]) == sorted(PLAIN[name](given), key=repr)


def fold(leaf: str, proof: str, steps: str) -> str:
    """The root by hand: a leaf goes into its slot between the siblings of its proof."""
    for step in steps.split():
        slot, width = map(int, step.split("/"))
        run = [proof[i * 64 : i * 64 + 64] for i in range(width - 1)]
        proof, leaf = proof[(width - 1) * 64 :], brute.sha("".join([*run[:slot], leaf, *run[slot:]]))
    assert not proof
    return leaf


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 1000])
def test_manifest_over_many_blocks(spark, n):
    """Blocks of 16 leaves of fan-out 4, so that nodes go up and paths come down through several tables."""
    docs = spark.range(n).selectExpr("id * 7 % 1009 as doc_id", "concat('g', if(id % 3 = 0, id, 1)) as lang", "concat('t', id) as text")
    digest = merkle.row_digest([merkle.F.col("text")])
    found = merkle.merkle_manifest(docs, digest, merkle.F.when(merkle.F.col("doc_id") % 2 == 0, digest).otherwise(merkle.F.lit("0" * 64)), shape=merkle.Shape(4, 2)).collect()
    assert len(found) == n and len({r["root"] for r in found}) == 1
    for r in found:
        assert fold(r["leaf"], r["proof"], r["steps"]) == r["root"]
        assert r["verified"] == (r["doc_id"] % 2 == 0) == (r["folded_root"] == r["root"])


def test_parent_resumes_the_state_before_a_slot():
    children = [brute.sha(str(i)).encode() for i in range(8)]
    parent = merkle.Parent(children)
    for slot in range(8):
        other = brute.sha("other").encode()
        assert parent.fold(slot, other).decode() == brute.sha("".join(c.decode() for c in [*children[:slot], other, *children[slot + 1 :]]))
        assert parent.fold(slot, children[slot]) == parent.digest and parent.siblings(slot) == b"".join(c for c in children if c != children[slot])


def test_mixture_meets_its_targets_under_skew(spark):
    """A third of the rows in one source, a third equal in all columns, one source a row, one of a single long document."""
    text = "repeat('w ', cast(1 + id % 17 as int))"
    docs = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 5, id) as doc_id",
        "case when id % 3 = 0 then 'copies' when id % 3 = 1 then 'hot' when id = 2 then 'long' when id % 30 = 5 then concat('own', id) else concat('s', id % 5) end as source",
        f"case when id % 3 = 0 then 'one two three' when id = 2 then repeat('w ', 5000) else {text} end as text",
    )
    found = mixing.mixture(docs).collect()
    sizes, taken, target, biggest = {}, {}, {}, {}
    for r in found:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        biggest[r["source"]] = max(biggest.get(r["source"], 0), r["size"])
        target[r["source"]] = r["target"]
        assert r["source_size"] >= r["size"] and 0 <= r["copies"] <= 2
    want = brute.mix_targets(sizes)
    assert len(found) == 3000 and abs(sum(target.values()) * 2 - 3 * sum(sizes.values())) < 1e-6
    for source in sizes:
        assert abs(target[source] - float(want[source])) < 1e-6
        assert abs(taken[source] - target[source]) <= biggest[source] / 2
    again = mixing.mixture(docs.repartition(13)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_smaller_budgets_are_nested(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    small, large = (mixing.mixture(docs, share, (1,), 1).filter("copies > 0").select("doc_id") for share in ((1, 4), (3, 4)))
    assert 0 < small.count() < large.count() and small.subtract(large).count() == 0
    with pytest.raises(ValueError):
        mixing.mixture(docs, (5, 2), (1,), 2)


def test_runs_of_random_words():
    r = random.Random(3)
    for _ in range(1500):
        n, kinds = r.randint(0, 70), r.choice([1, 2, 3, 6])
        words = [str(r.randrange(kinds)) for _ in range(n)]
        if n > 5 and r.random() < 0.5:
            a = r.randrange(n)
            p = 1 + r.randrange(max(1, (n - a) // 2))
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        for least in (2, 5, 12):
            want = brute.runs(words, least)
            assert sorted(periodic.runs_of([int(w) for w in words], least), key=lambda r: (r[0], r[2])) == want
            # neighbours in one batch do not lend each other words
            found, collapsed = periodic._documents([words[:7], words, words], least)
            assert found[1] == found[2] == want
            gone = {i for s, m, q in want for i in range(s + q, s + m)}
            assert collapsed[1] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_pieces_of_a_batch(monkeypatch):
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(periodic, "ROWS_AT_ONCE", 3)
    texts = [None, "", "a b", *[f"w{i} " * (i * 13 % 70) for i in range(20)], "end"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    pieces = list(periodic._slices(batch))
    assert [d for ids, _ in pieces for d in ids] == list(range(len(texts))) and len(pieces) > 5
    assert [w for _, words in pieces for w in words] == [brute.WORD.findall(t or "") for t in texts]


def test_runs_of_a_long_text(spark):
    """Long periods and a run within a run."""
    base = [f"w{i}" for i in range(700)]
    words = [*base[:650], *base, *base, *base[:33], *["a", "b"] * 40, "x", *(["c"] * 20 + base[5:50]) * 3]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(3)] + [(9, "short")], "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.periodic_runs(docs).collect()}
    assert found[0] == found[1] == found[2] == brute.runs(words) and found[9] == []
    assert any(q == 700 for _, _, q in found[0])
