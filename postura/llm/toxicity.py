"""Toxicity scores from a subword-bag model.

Method: every word and its character n-grams (3 to 5 characters, word ends marked) are hashed to rows of
one embedding table. A text is the average of all of them, and a linear softmax over that average
gives the two classes; table and softmax are trained jointly in numpy (cross entropy, Adam with weight
decay and a falling rate). A misspelt or unseen word still has most n-grams of the word it resembles, and so its vectors.
A word counts as often as it occurs, up to one 64th of the text's words and one more, and every average holds
``BLANKS`` zero vectors besides, so that neither a repeated line nor a text of a few words is carried by chance.

Fitting uses a bounded sample (``Fit``: texts of each class, and characters of a text), picked by a hash of
doc_id among labelled rows outside the held-out fold, so that the driver holds a bounded amount whatever the
input. The sample has more toxic rows than the labels do; the softmax's offset is set back to the
share among all permitted labels. Scoring covers every row and whole texts: as the softmax is linear in the
average, a word's n-grams reduce to one number, which is kept in a bounded cache.

Defined results: null, empty and wordless texts get the score of the offset alone; a doc_id with several labels
counts as toxic if one says so; labels other than 0 and 1 are left out; without labels of both classes every
text gets the share of toxic ones (0 without any); repeated rows give repeated results; a null doc_id is
never held out; other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.llm.common import id_text, map_batches, reach_workers

CACHE_ENTRIES = 200_000
TEXTS_AT_ONCE = 256
WORDS_AT_ONCE = 8192
BLANKS = 500.0
MOST = 1 / 64
EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample and settings of the training."""

    toxic_texts: int = 2500
    other_texts: int = 5000
    longest_text: int = 20_000
    buckets: int = 1 << 17
    width: int = 8
    epochs: int = 15
    batch: int = 64
    rate: float = 0.02
    decay: float = 0.002
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """What scoring needs: ``weights`` of each bucket in the toxic-against-other logit, and the offset."""

    offset: float
    weights: np.ndarray | None = field(default=None, repr=False)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words (as split at white space) and of their n-grams, and how many each word has."""
    marked = [f"<{EDGES.sub('', w.lower())}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    n, base = len(points), np.uint64(1_000_003)
    owner = np.repeat(np.arange(len(marked)), lengths)
    inside = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.repeat(lengths, lengths) - inside  # characters from here to the word's end
    real = np.repeat(lengths > 2, lengths)
    found, owners = [], []
    for size in (3, 4, 5):
        at = np.flatnonzero(real & (left >= size))
        value = np.full(len(at), size, np.uint64)
        for k in range(size):
            value = value * base + points[at + k]
        found.append(value)
        owners.append(owner[at])
    # the whole word: a sum over its characters, each mixed with its place
    whole = np.zeros(len(marked), np.uint64)
    if n:
        whole = np.add.reduceat(_mix(points * base + inside.astype(np.uint64)), np.cumsum(lengths) - lengths)
    at = np.flatnonzero(lengths > 2)
    found.append(whole[at])
    owners.append(at)
    all_owners = np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    bucket = (_mix(np.concatenate(found)) % np.uint64(buckets)).astype(np.int64)
    return bucket[order], np.bincount(all_owners, minlength=len(marked))


def train(texts: list[str], toxic: list[int], share: float, fit: Fit) -> Model:
    """Table and softmax by Adam over minibatches; ``share`` is the share of toxic ones to which the offset is set back."""
    idx, cnt, ends = [], [], []
    for text in texts:
        all_words = text.split()
        words, most = Counter(all_words), 1 + MOST * len(all_words)
        found, n = features(list(words), fit.buckets)
        b, at = np.unique(found, return_inverse=True)
        c = np.bincount(at, np.repeat(np.minimum(np.fromiter(words.values(), float, len(words)), most), n), len(b))
        idx.append(b.astype(np.int32))
        cnt.append((c / (c.sum() + BLANKS)).astype(np.float32))
        ends.append(len(b))
    y = np.array(toxic)
    rng = np.random.default_rng(fit.seed)
    table = rng.normal(0, 0.01, (fit.buckets, fit.width)).astype(np.float32)
    soft = rng.normal(0, 0.5, (fit.width, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (table, soft, bias)]
    scale, step = np.float32(100), 0  # averages of small vectors; the factor only sets their unit
    steps = fit.epochs * -(-len(y) // fit.batch) + 1
    for _ in range(fit.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), fit.batch):
            rows = [r for r in order[at : at + fit.batch] if ends[r]]
            if not rows:
                continue
            sizes = np.array([ends[r] for r in rows])
            i, c = np.concatenate([idx[r] for r in rows]), np.concatenate([cnt[r] for r in rows])
            average = np.add.reduceat(table[i] * c[:, None], np.cumsum(sizes) - sizes) * scale
            logits = average @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            down = (p @ soft.T) * scale
            weights = np.repeat(down, sizes, axis=0) * c[:, None]
            g_table = np.stack([np.bincount(i, weights[:, k], fit.buckets) for k in range(fit.width)], 1).astype(np.float32)
            step += 1
            table *= np.float32(1 - fit.decay)
            for param, grad, (m, v) in zip((table, soft, bias), (g_table, average.T @ p, p.sum(0)), state, strict=True):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad * grad
                param -= np.float32(fit.rate * (1 - step / steps)) * (m / np.float32(1 - 0.9**step)) / (np.sqrt(v / np.float32(1 - 0.99**step)) + np.float32(1e-8))
    own = y.mean()
    shift = np.log(share / (1 - share)) - np.log(own / (1 - own))
    return Model(float(bias[1] - bias[0] + shift), ((table @ (soft[:, 1] - soft[:, 0])) * scale).astype(np.float64))


def fit_model(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Train on labelled rows outside the held-out fold; ``labels`` has doc_id and toxic."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    share = n.get(1, 0) / total if total else 0.0
    if 0 < share < 1:
        picked = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for t, k in ((1, fit.toxic_texts), (0, fit.other_texts))]
        # at most toxic_texts + other_texts rows of two numbers
        sample = id_text(docs).join(F.broadcast(picked[0].union(picked[1])), "doc_id").filter(F.length("text").between(1, fit.longest_text))
        # at most that many texts of at most longest_text characters; of several rows with one doc_id the smallest text
        rows = sorted(sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect())
        toxic = [r["toxic"] for r in rows]
        if 0 < sum(toxic) < len(toxic):
            return train([r["text"] for r in rows], toxic, share, fit)
    return Model(float(np.log(share / (1 - share))) if 0 < share < 1 else np.inf if share else -np.inf)


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score) of every row, and the columns named in ``carry``, prefixed ``doc_``; the score is the softmax share of the toxic class."""
    reach_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"doc_{c}") for c in carry])
    carried = "".join(f", `doc_{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema.fields) if carry else ""
    # one number for each bucket: ``Fit.buckets`` doubles
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = sent.value
        cache: dict[str, complex] = {}  # a word's sum of weights and number of features

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                split = [(t or "").split() for t in batch.column(1).slice(at, TEXTS_AT_ONCE).to_pylist()]
                if own.weights is None:
                    out += [0j] * len(split)
                    continue
                if len(cache) > CACHE_ENTRIES:
                    cache.clear()
                missing = list({w for words in split for w in words if w not in cache})
                for k in range(0, len(missing), WORDS_AT_ONCE):
                    new = missing[k : k + WORDS_AT_ONCE]
                    buckets, n = features(new, len(own.weights))
                    sums = np.bincount(np.repeat(np.arange(len(new)), n), own.weights[buckets], len(new))
                    cache.update(zip(new, (sums + 1j * n).tolist(), strict=True))
                for words in split:
                    most = 1 + MOST * len(words)
                    out.append(sum([cache[w] * n if n < most else cache[w] * most for w, n in Counter(words).items()], 0j))
            total = np.array(out)
            logit = total.real / (total.imag + BLANKS) + own.offset
            with np.errstate(over="ignore"):
                scores = 1 / (1 + np.exp(-logit))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]])

        return each

    return map_batches(rows, make, f"doc_id long, score double{carried}")
