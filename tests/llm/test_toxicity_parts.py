"""The toxicity model's features, gradient and scores against plain versions; recall and misspellings on held-out rows."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from postura.llm import toxicity as X

WHERE = "/root/testdata/sf0.1"
ALL = (1 << 64) - 1


def mix(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & ALL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & ALL
    return x ^ (x >> 31)


def buckets_of(word: str, buckets: int) -> list[int]:
    """N-grams of 3 to 5 characters and the whole word, one at a time."""
    marked = f"<{X.EDGES.sub('', word.lower())}>"
    points, out = [ord(c) for c in marked], []
    if len(points) < 3:
        return []
    for size in (3, 4, 5):
        for at in range(len(points) - size + 1):
            value = size
            for p in points[at : at + size]:
                value = (value * 1_000_003 + p) & ALL
            out.append(mix(value) % buckets)
    return [*out, mix(sum(mix((p * 1_000_003 + i) & ALL) for i, p in enumerate(points)) & ALL) % buckets]


def plain_score(text: str | None, model: X.Model) -> float:
    words = (text or "").split()
    total, weight = X.BLANKS, 0.0
    for word, n in Counter(words).items():
        own, times = buckets_of(word, len(model.weights)), min(n, 1 + X.MOST * len(words))
        total += times * len(own)
        weight += times * sum(model.weights[b] for b in own)
    return 1 / (1 + math.exp(-(model.offset + weight / total)))


def test_features():
    words = ["Hello", "a", "", "...", "naïve!", "(x)", "日本語テキスト", "don't", "HELLO,", "ab", "😀😀😀"]
    found, n = X.features(words, 1 << 12)
    ends = np.cumsum(n)
    for i, word in enumerate(words):
        assert sorted(found[ends[i] - n[i] : ends[i]].tolist()) == sorted(buckets_of(word, 1 << 12)), word
    assert buckets_of("Hello", 1 << 12) == buckets_of("HELLO,", 1 << 12)


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = (spark.read.parquet(f"{WHERE}/{t}.parquet") for t in ("documents", "labels"))
    model = X.fit_model(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    tested = [d for d in texts if d in toxic and zlib.crc32(str(d).encode()) % 4 == 2]
    return model, texts, toxic, tested


def test_scores_are_the_plain_ones(spark, trained):
    model, texts, _, _ = trained
    some = sorted(texts.items())[:300] + [(-1, None), (-2, ""), (-3, " \n "), (-4, "word " * 5000), (-5, "!!!")]
    found = X.score(spark.createDataFrame(some, "doc_id long, text string"), model).collect()
    want = dict(some)
    assert len(found) == len(some)
    for r in found:
        assert r["score"] == pytest.approx(plain_score(want[r["doc_id"]], model), rel=1e-6, abs=1e-9)


def test_recall_on_held_out_rows(trained):
    """With the 2,976 labelled rows of this size; with those of check_s recall is 0.98."""
    model, texts, toxic, tested = trained
    found = {d: plain_score(texts[d], model) >= 0.3 for d in tested}
    bad = [d for d in tested if toxic[d]]
    good = [d for d in tested if not toxic[d]]
    assert len(bad) > 50 and sum(found[d] for d in bad) / len(bad) >= 0.6
    assert sum(not found[d] for d in good) / len(good) >= 0.93


def test_misspellings_share_the_vectors_of_their_words(trained):
    """The words that speak most for toxicity, each with two letters exchanged, still speak for it."""
    model, texts, toxic, _ = trained
    words = Counter(w.lower() for d, t in texts.items() if toxic.get(d) for w in set((t or "").split()) if len(w) >= 7 and w.isalpha())
    weight = lambda w: sum(model.weights[b] for b in buckets_of(w, len(model.weights))) / len(buckets_of(w, len(model.weights)))
    strong = sorted((w for w, n in words.items() if n >= 5), key=weight)[-20:]
    usual = float(np.mean([weight(w) for w in words]))
    misspelt = [w[:3] + w[4] + w[3] + w[5:] for w in strong if w[3] != w[4]]
    assert not set(misspelt) & set(words)
    assert np.mean([weight(w) > usual for w in misspelt]) >= 0.9


def test_training_separates_planted_words():
    """Two made-up vocabularies: the model tells the classes apart, and its offset carries the share it is given."""
    r = np.random.default_rng(1)
    kinds = [[f"{a}{b}ling" for a in "bdfg" for b in "aeiou"], [f"{a}{b}mort" for a in "ktvz" for b in "aeiou"]]
    labels = [int(i % 4 == 0) for i in range(400)]
    texts = [" ".join([*r.choice(kinds[0], 30), *r.choice(kinds[y], 30)]) for y in labels]
    model = X.train(texts, labels, 0.5, X.Fit(buckets=1 << 12, epochs=30))
    scores = [plain_score(t, model) for t in texts]
    assert min(s for s, y in zip(scores, labels, strict=True) if y) > max(s for s, y in zip(scores, labels, strict=True) if not y)
    rare = X.train(texts, labels, 0.01, X.Fit(buckets=1 << 12, epochs=30))
    assert model.offset - rare.offset == pytest.approx(math.log(99), rel=1e-5)
