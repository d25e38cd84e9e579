"""The pipeline's stages: each decision against the operator's plain version, and odd and empty tables."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
from test_queries import ODD, odd_dir  # noqa: E402, F401

import corpus_pipeline as P  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, odd_dir, tmp_path_factory):  # noqa: F811
    """Input and output rows of every stage, over the given and the odd documents together."""
    path = tmp_path_factory.mktemp("stages")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.read.parquet(f"{odd_dir[0]}/documents.parquet").select(*COLUMNS).withColumn("doc_id", P.F.col("doc_id") + 1_000_000)
    given.select(*COLUMNS).union(odd).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, str(path)).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        out[name] = ([tuple(r) for r in before.collect()], docs.columns, [tuple(r) for r in docs.collect()])
    return out


def texts(rows):
    return {r[0]: r[1] for r in rows}


def test_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "substrings", "secrets", "packing"]
    for name in ("toxicity", "simhash", "substrings", "secrets"):
        assert stages[name][1] == COLUMNS


def test_toxicity_only_drops(stages):
    before, _, after = stages["toxicity"]
    assert set(after) <= set(before) and len(after) > 0.7 * len(before)


def test_simhash_keeps_the_first_of_each_group(stages):
    before, _, after = stages["simhash"]
    groups = brute.op5([(r[0], r[1]) for r in before])
    assert sorted(texts(after)) == sorted({c for _, _, c in groups}) and set(after) <= set(before)


def test_substrings_removes_repeats(stages):
    before, _, after = stages["substrings"]
    want = {d: (gone, sha) for d, _, gone, sha in brute.op8([(r[0], r[1]) for r in before])}
    old, new = texts(before), texts(after)
    assert old.keys() == new.keys()
    for d, text in new.items():
        gone, sha = want[d]
        assert (text == old[d]) if not gone else brute.sha(text) == sha
    assert any(gone for gone, _ in want.values())


def test_secrets_are_replaced(spark, odd_dir, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{odd_dir[0]}/documents.parquet")
    after = P.secrets(spark, docs, str(tmp_path))
    assert after.columns == COLUMNS
    old, new = dict(ODD), {r["doc_id"]: r["text"] for r in after.collect()}
    found = {r["doc_id"]: r["spans"] for r in P.scan(docs).collect()}
    for d, text in old.items():
        out, at = [], 0
        for s in found[d]:
            if s["start"] >= at:
                out.append(text[at : s["start"]] + f"[{s['kind']}]")
            at = max(at, s["end"])
        assert new[d] == ("".join(out) + text[at:] if found[d] else text)
    kinds = {s["kind"] for spans in found.values() for s in spans}
    assert {"assign", "access", "hex", "github", "slack", "private_key"} <= kinds
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if r["text"] is not None and r["text"] != old[r["doc_id"]])


def test_packing_holds_all_ids(stages):
    before, columns, after = stages["packing"]
    rows = [dict(zip(columns, r, strict=True)) for r in after]
    digests = [(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows]
    assert sorted(digests) == sorted(brute.pieces([(r[0], r[1]) for r in before]))
    brute.check_packing([(r["sequence_id"], r["offset"], r["length"]) for r in rows])


def test_sequences_decode_to_the_texts(stages):
    """The packed tokens, taken from their sequences, are the texts that the stage before kept."""
    before, columns, after = stages["packing"]
    rows = [dict(zip(columns, r, strict=True)) for r in after]
    sequences = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        own = sequences.setdefault(r["sequence_id"], [])
        assert len(own) == r["offset"] and len(r["ids"]) == 4 * r["length"]
        own.extend(np.frombuffer(r["ids"], "<u4").tolist())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        texts.setdefault(r["doc_id"], []).extend(sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]])
    for d, text, *_ in before:
        assert texts[d][-1] == 2 and tokenizer.decode(texts[d][:-1], skip_special_tokens=False) == (text or "")


def test_run_and_empty(spark, odd_dir, tmp_path):  # noqa: F811
    out = P.run(spark, odd_dir[0])
    assert out.count() > 0
    folder = Path(out.inputFiles()[0].removeprefix("file://")).parents[1]
    assert [p.name for p in folder.iterdir()] == ["packing"]  # the other stages' files are gone
    for name in ("documents", "labels"):
        spark.read.parquet(f"{odd_dir[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_null_and_repeated_ids(spark, odd_dir, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{odd_dir[0]}/documents.parquet")
    docs.union(docs).union(docs.withColumn("doc_id", P.F.lit(None).cast("long"))).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{odd_dir[0]}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = P.simhash(spark, frame, str(tmp_path)).collect()
    named = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    assert len(named) == len(set(named)) and sum(r["doc_id"] is None for r in kept) == len(ODD)
    assert P.run(spark, str(tmp_path)).count() > 0
