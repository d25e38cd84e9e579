"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Method: a score-ordered agenda of adjacent symbol pairs. The text is normalised, cut into symbols
(characters, or whole user-defined pieces), every adjacent pair whose joined string is a piece goes
on a heap ordered by (score descending, position ascending), and the best pair still intact is merged
until the agenda is empty. Symbols without a piece fall back to bytes.

If no piece of the vocabulary holds a space mark after another character (checked when the
vocabulary is read), no merge crosses the place before a run of space marks. The agendas of the
parts between those places are then independent, and equal parts share one result in a bounded cache.
The agendas of many short parts run together as arrays (``merging``); a long part has a heap of its own.

Check: in each Arrow batch the parts that were merged anew are encoded by the sentencepiece library
as well; a difference raises. Every id that leaves the operator has passed that check.

Defined results: null text is the empty text; the empty text has no ids besides the end id; repeated
rows give repeated results; other columns of the input are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postura.llm.common import id_text, int_lists, map_batches
from postura.llm.merging import PairMerges

SPACE = "▁"
CACHE_ENTRIES = 400_000
LONGEST_CACHED = 64
TEXTS_AT_ONCE = 1024
SCHEMA = "doc_id long, ids array<int>, decoded string"


def _fields(message: bytes) -> dict[int, bytes | int]:
    """The last value of each field of a serialised protocol message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    out: dict[int, bytes | int] = {}
    at = 0
    while at < len(message):
        key, at = varint(at)
        if key & 7 == 0:
            out[key >> 3], at = varint(at)
        else:
            length, at = (8, at) if key & 7 == 1 else (4, at) if key & 7 == 5 else varint(at)
            out[key >> 3] = message[at : at + length]
            at += length
    return out


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES) -> None:
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = _fields(lib.serialized_model_proto())
        trainer, normalizer = _fields(model.get(2, b"")), _fields(model.get(3, b""))
        if trainer.get(3, 1) != 2:
            raise ValueError(f"{path} is not a merge-type (BPE) model")
        self.plain = not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(3, 1) and normalizer.get(5, 1)
        self.strips = bool(normalizer.get(3, 1) or normalizer.get(4, 1))
        self.strips_all = bool(normalizer.get(4, 1))
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.control = {i for i in range(n) if lib.is_control(i)}
        self.unk, self.eos = lib.unk_id(), lib.eos_id()
        byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.bytes = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        special = self.control | set(self.byte_of) | {self.unk}
        if any(lib.is_unused(i) for i in range(n)):
            raise ValueError("unused pieces are not supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.rank = {p: -lib.get_score(i) for p, i in self.ids.items()}
        # user-defined pieces (score 0, matched before merging) would need a matcher
        self.independent = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        # symbols of the array form: every piece, and characters that are no piece but begin or end one
        self.symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                self.symbols.setdefault(c, n + len(self.symbols))
        order = {r: i for i, r in enumerate(sorted(set(self.rank.values())))}
        halves = [(p[:i], p[i:], p) for p in self.ids for i in range(1, len(p)) if p[:i] in self.symbols and p[i:] in self.symbols]
        sid = self.symbols.__getitem__
        self.pairs = PairMerges([sid(a) for a, _, _ in halves], [sid(b) for _, b, _ in halves], [sid(p) for _, _, p in halves], [order[self.rank[p]] for _, _, p in halves], n + len(self.symbols))
        self.first_unknown = n
        self.without_piece = {i: c for c, i in self.symbols.items() if i >= n}
        self.symbol_of = -3 - np.arange(0x110000, dtype=np.int32)
        for p, i in self.symbols.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.texts = ["" if i in self.control else " ⁇ " if i == self.unk else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.cache_entries = cache_entries

    def merge(self, text: str) -> list[int]:
        """Ids of normalised text by the agenda."""
        rank, symbols = self.rank, list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if (r := rank.get(pair)) is not None:
                agenda.append((r, i, i + 1, pair))
        heapify(agenda)
        while agenda:
            _, left, right, pair = heappop(agenda)
            # stale if either symbol was merged since: then the two no longer spell the pair
            if symbols[left] is None or symbols[right] is None or len(symbols[left]) + len(symbols[right]) != len(pair):
                continue
            symbols[left], symbols[right] = pair, None
            nxt = after[left] = after[right]
            if nxt >= 0:
                before[nxt] = left
                joined = pair + symbols[nxt]
                if (r := rank.get(joined)) is not None:
                    heappush(agenda, (r, left, nxt, joined))
            prev = before[left]
            if prev >= 0:
                joined = symbols[prev] + pair
                if (r := rank.get(joined)) is not None:
                    heappush(agenda, (r, prev, left, joined))
        ids = self.ids
        out = []
        for s in symbols:
            if s is not None:
                if (i := ids.get(s)) is not None:
                    out.append(i)
                elif self.bytes:
                    out.extend(map(self.bytes.__getitem__, s.encode()))
                else:
                    out.append(self.unk)
        return out

    def merge_all(self, parts: list[str], lead: str) -> dict[str, list[int]]:
        """As ``merge``, for many short parts at once."""
        if not parts:
            return {}
        words = [lead + p for p in parts]
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        flat, counts = self.pairs.run(self.symbol_of[points], np.array(list(map(len, words)), np.int64))
        odd = (flat < 0) | (flat >= self.first_unknown)
        ends, ids = np.cumsum(counts).tolist(), flat.tolist()
        out = {p: ids[e - n : e] for p, e, n in zip(parts, ends, counts.tolist(), strict=True)}
        for w in set(np.repeat(np.arange(len(parts)), counts)[odd].tolist()):  # characters without a piece
            out[parts[w]] = [x for i in out[parts[w]] for x in ((i,) if 0 <= i < self.first_unknown else self.fallback(i))]
        return out

    def fallback(self, symbol: int) -> list[int]:
        """Ids of a symbol that is no piece."""
        c = self.without_piece[symbol] if symbol >= 0 else chr(-3 - symbol)
        return [self.bytes[b] for b in c.encode()] if self.bytes else [self.unk]

    def pieces_text(self, ids: list[int]) -> str:
        """Text of ids, before the space mark at the very start is dropped."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.texts.__getitem__, ids))
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.texts[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def parts(self, text: str) -> list[str]:
        """Independent parts of the normalised text, each without its first space mark where the model adds one."""
        if not text:
            return []
        if self.plain and self.independent and SPACE not in text and "  " not in text and text[0] != " ":
            return text.split(" ")
        whole = SPACE + text.replace(" ", SPACE) if self.plain else self.library.normalize(text).replace(" ", SPACE)
        if not self.independent or not whole.startswith(SPACE):
            return [whole]
        return [p[1:] for p in re.findall(f"{SPACE}+[^{SPACE}]*", whole)]

    def learn(self, parts: set[str]) -> dict[str, tuple[bytes, str]]:
        """Merge new parts, check them against the library, and return (ids, text) of each."""
        lead = SPACE if self.independent else ""
        new = self.merge_all([p for p in parts if len(p) < LONGEST_CACHED], lead)
        new |= {p: self.merge(lead + p) for p in parts if len(p) >= LONGEST_CACHED}
        if self.plain:
            asked = [p for p in new if p]
            for p, want in zip(asked, self.library.encode([p.replace(SPACE, " ") for p in asked], num_threads=1), strict=True):
                if new[p] != want:
                    raise AssertionError(f"agenda and library differ on {p!r}: {new[p]} and {want}")
        flat = [i for ids in new.values() for i in ids]
        raw, at, out = np.array(flat, "<i4").tobytes(), 0, {}
        for p, ids in new.items():
            end = at + 4 * len(ids)
            out[p] = (raw[at:end], self.pieces_text(ids))
            at = end
        return out

    def batch(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """Ids (as bytes, end id included) and decoded text of each text."""
        split = [self.parts(t or "") for t in texts]
        cache = self.cache
        if len(cache) > self.cache_entries:
            cache.clear()
        once: dict[str, tuple[bytes, str]] = {}
        end = np.array([self.eos], "<i4").tobytes()
        out, decoded = [], []
        missing: set[str] = set()
        for parts in split:
            missing.update([p for p in parts if p not in cache])
        for p, got in self.learn(missing).items():
            (cache if len(p) <= LONGEST_CACHED else once)[p] = got
        for t, parts in zip(texts, split, strict=True):
            found = [cache[p] if p in cache else once[p] for p in parts]
            text = "".join([f[1] for f in found])
            if self.strips:
                text = text.lstrip(" ") if self.strips_all else text.removeprefix(" ")
            ids = b"".join([f[0] for f in found])
            if not self.plain and t and np.frombuffer(ids, "<i4").tolist() != self.library.encode(t):
                raise AssertionError("agenda and library differ on a text")
            out.append(ids + end)
            decoded.append(text)
        return out, decoded


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec, with its cache, in each Python worker."""
    return Codec(path)


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: ``ids`` of its whole text, end id last, and ``decoded``, the text of those ids."""

    def make():
        own = codec(model_path)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, decoded, texts = [], [], batch.column(1).to_pylist()
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                i, d = own.batch(texts[at : at + TEXTS_AT_ONCE])
                ids += i
                decoded += d
            return pa.RecordBatch.from_arrays([batch.column(0), int_lists(ids), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

        return each

    return map_batches(id_text(docs), make, SCHEMA)
