"""Token counts under a word-level BPE vocabulary with word ends.

Method: whole-token shortcut. Which vocabulary strings encode alone as one token is proved once,
offline, on the driver: a string qualifies if normalising leaves it as it is, the pre-tokeniser takes
it as one piece and its own merges end in a single token. A pre-token found in that set counts
one without merging; only the rest is merged.

White space never lies inside a pre-token, so texts are cut at white space and equal parts share one
count in a bounded cache. Special strings inside a text are one token each, as the library has it by default.

Defined results: null text is the empty text with no tokens and no bytes; repeated rows give repeated
results; other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from postura.llm.common import id_text, map_batches
from postura.llm.merging import PairMerges

CACHE_ENTRIES = 1_000_000
LONGEST_CACHED = 64
TEXTS_AT_ONCE = 1024
# White space of the library's patterns, and its pre-token pattern for this vocabulary.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
NEWER = re.compile("[^\x00-\u052f\u2000-\u206f]")  # beyond Latin, Greek, Cyrillic and common punctuation
SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split() only


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def normalise(text: str) -> str:
    """Canonical composition and lower case by character (a capital sigma never becomes a final one)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Merger:
    """The vocabulary's merges."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.letters = byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"]]
        ids = {t: i for i, t in enumerate(self.vocab)}
        for c in self.letters.values():
            ids.setdefault(c, len(ids))
            ids.setdefault(c + self.end, len(ids))
        self.known = np.array([t in self.vocab for t in ids])
        self.pairs = PairMerges(*([ids[x] for x in col] for col in zip(*((a, b, a + b) for a, b in self.ranks), strict=True)), list(self.ranks.values()), len(ids))
        self.inner = np.array([ids[self.letters[b]] for b in range(256)], np.int32)
        self.last = np.array([ids[self.letters[b] + self.end] for b in range(256)], np.int32)

    def counts(self, pretokens: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        if not pretokens:
            return []
        raw = [p.encode() for p in pretokens]
        lengths = np.array([len(r) for r in raw], np.int64)
        ends, flat = np.cumsum(lengths), np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        symbols[ends - 1] = self.last[flat[ends - 1]]
        ids, n = self.pairs.run(symbols, lengths)
        return np.add.reduceat(self.known[ids], np.cumsum(n) - n, dtype=np.int64).tolist()

    def tokens(self, pretoken: str) -> list[str]:
        symbols = [self.letters[b] for b in pretoken.encode()]
        symbols[-1] += self.end
        ranks, none = self.ranks, len(self.ranks)
        while len(symbols) > 1:
            found = [ranks.get(p, none) for p in zip(symbols, symbols[1:], strict=False)]
            best = min(found)
            if best == none:
                break
            merged, i = [], 0
            while i < len(symbols):
                if i < len(found) and found[i] == best:
                    merged.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    merged.append(symbols[i])
                    i += 1
            symbols = merged
        return [s for s in symbols if s in self.vocab]


def whole_tokens(path: str) -> frozenset[str]:
    """The pre-tokens that are proved to encode alone as one token; at most one for each vocabulary entry."""
    merger = Merger(path)
    byte_of = {c: b for b, c in merger.letters.items()}
    proved = set()
    for token in merger.vocab:
        if not token.endswith(merger.end) or token in merger.special:
            continue
        try:
            text = bytes(byte_of[c] for c in token.removesuffix(merger.end)).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and normalise(text) == text and PRETOKEN.findall(text) == [text] and merger.tokens(text) == [token]:
            proved.add(text)
    return frozenset(proved)


class Counter:
    def __init__(self, path: str, whole: frozenset[str]) -> None:
        self.merger, self.whole = Merger(path), whole
        self.special = re.compile("|".join(map(re.escape, self.merger.special))) if self.merger.special else None
        self.library = Tokenizer.from_file(path)
        self.cache: dict[str, int] = {}

    def pretokens(self, part: str) -> list[str]:
        return PRETOKEN.findall(normalise(part)) if NEWER.search(part) is None else self._library(part)

    def _library(self, part: str) -> list[str]:
        """Pre-tokens by the library's own tables of characters, as scripts and symbols differ by Unicode version."""
        byte_of = {c: b for b, c in self.merger.letters.items()}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [bytes(byte_of[c] for c in p).decode() for p, _ in pieces]

    def learn(self, parts: list[str]) -> list[int]:
        """Tokens of each part: its whole tokens count one each, the rest is merged."""
        whole, rest = self.whole, {}
        split = [self.pretokens(p) for p in parts]
        for pretokens in split:
            for p in pretokens:
                if p not in whole:
                    rest[p] = 0
        rest = dict(zip(rest, self.merger.counts(list(rest)), strict=True))
        return [sum([1 if p in whole else rest[p] for p in pretokens]) for pretokens in split]

    def parts(self, text: str) -> tuple[list[str], int]:
        """Parts of a text that hold its pre-tokens, and how many special strings it has."""
        special, texts = 0, [text]
        if self.special is not None and self.special.search(text):
            special, texts = len(self.special.findall(text)), self.special.split(text)
        return [p for t in texts for p in ([t] if SEPARATORS.search(t) else t.split())], special

    def batch(self, texts: list[str]) -> list[int]:
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        split = [self.parts(t) for t in texts]
        missing: set[str] = set()
        for parts, _ in split:
            missing.update([p for p in parts if p not in cache])
        short, long = [p for p in missing if len(p) <= LONGEST_CACHED], [p for p in missing if len(p) > LONGEST_CACHED]
        cache.update(zip(short, self.learn(short), strict=True))
        once = dict(zip(long, self.learn(long), strict=True))
        return [special + sum([cache[p] if p in cache else once[p] for p in parts]) for parts, special in split]


@lru_cache(maxsize=2)
def counter(path: str, whole: frozenset[str]) -> Counter:
    return Counter(path, whole)


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document: doc_id, ``n_bytes`` of the UTF-8 text and ``n_tokens``."""
    # at most one short string for each entry of the vocabulary file, whatever the size of the input
    proved = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocabulary_path))

    def make():
        own = counter(vocabulary_path, proved.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = [len(t.encode()) for t in texts]
            counts = [n for at in range(0, len(texts), TEXTS_AT_ONCE) for n in own.batch(texts[at : at + TEXTS_AT_ONCE])]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

        return each

    return map_batches(id_text(docs), make, "doc_id long, n_bytes long, n_tokens long")
