"""Substring dedup: words covered by a repeat of ``least`` or more consecutive words are removed, but for
the first occurrence (smallest doc_id, then smallest start).

Method: seed and extend. Seeds are winnowed anchors: the smallest hash among the ``anchor``-word grams of
each window of ``least`` words. The choice depends on the window's words alone, so two equal windows have
equal anchors at equal places, and documents need only be joined on anchors. The windows that share
one anchor occurrence form a run; its text is the anchor extended both ways as far as windows reach.

1. Occurrences meet on their anchor. Of those whose extended texts are equal the first stays, and the others are
   repeats as a whole. Copies within one batch are reduced before the shuffle, so that a hot passage
   sends a row for each batch and not for each document.
2. Anchors with several different extended texts go back to their documents, where the extension is compared
   window by window: equal windows meet on a 128-bit hash, and all but the first are repeats. Again those of one piece of
   the documents are reduced before the shuffle, so that a passage between varying neighbours sends a row for each piece.
3. Repeats of a document are merged to maximal repeats, whose words are removed.

No pairs of documents are formed: the cost of an anchor or window grows with its occurrences. An anchor whose extensions all
differ meets in one task, sorted on disk and read as a stream.

Defined results: words are runs of anything but the six ASCII white-space bytes; null text has no words;
rows without doc_id come after all others; rows equal in doc_id and text are one document, rows equal in
doc_id only are ordered by a hash of the text; other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postura.llm.common import cut, reach_workers

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
WORDS_AT_ONCE = 300_000
ROWS_AT_ONCE = 200_000
LAST = (1 << 63) - 1
ROWS = "anchor long, run long, doc_id long, version long, start int, windows int"
FOUND = "doc_id long, version long, start int, windows int, sure boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class _Sums:
    """Hashes of any stretches of one array of word hashes."""

    def __init__(self, hashes: np.ndarray, base: np.uint64) -> None:
        n = len(hashes)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, base)])
            self.back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, inverse)])
            self.sums = np.r_[np.uint64(0), np.cumsum(hashes * powers[:n], dtype=np.uint64)]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _windows(lengths: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows in documents laid end to end, and their documents."""
    n = np.maximum(lengths - least + 1, 0)
    document = np.repeat(np.arange(len(lengths)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(np.cumsum(lengths) - lengths, n), document


def seeds(texts: list[list[bytes]], least: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor occurrences of documents: (anchor hash, run hash, document, start of the first window, windows)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    hashes = _word_hashes([w for t in texts for w in t])
    start, document = _windows(lengths, least)
    if not len(start):
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    sums = _Sums(hashes, BASES[0])
    at = np.arange(len(hashes) - anchor + 1)
    grams = sums.of(at, at + anchor)
    best, place = grams[start], np.zeros(len(start), np.int64)
    for k in range(1, least - anchor + 1):
        other = grams[start + k]
        less = other < best
        best = np.where(less, other, best)
        place[less] = k
    place += start
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (document[1:] != document[:-1])])
    count = np.diff(np.r_[first, len(start)])
    begin = start[first]
    run = _mix(sums.of(begin, begin + count - 1 + least) + (place[first] - begin).astype(np.uint64))
    document = document[first]
    return best[first], run, document, begin - (np.cumsum(lengths) - lengths)[document], count


def _merge(document: np.ndarray, start: np.ndarray, windows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that touch or overlap become one."""
    order = np.lexsort((start, document))
    document, start, windows = document[order], start[order], windows[order]
    # in order of start their ends ascend too, as runs of one document do not hold each other
    fresh = np.r_[True, (document[1:] != document[:-1]) | (start[1:] > start[:-1] + windows[:-1])] if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    end = (start + windows)[np.r_[first[1:], len(start)] - 1] if len(first) else start
    return document[first], start[first], end - start[first]


def _sow(least: int, anchor: int):
    """Documents to anchor rows; repeats within a batch come out as rows without anchor (windows negative)."""

    def rows(doc: list[int], version: list[int], texts: list[list[bytes]]) -> pa.RecordBatch:
        seed, run, document, start, windows = seeds(texts, least, anchor)
        ids, versions = np.array(doc, np.int64), np.array(version, np.int64)
        order = np.lexsort((start, versions[document], ids[document], run, seed))
        s, r = seed[order], run[order]
        first = np.r_[True, (s[1:] != s[:-1]) | (r[1:] != r[:-1])] if len(s) else np.zeros(0, bool)
        # a row equal in doc_id and text is the same document and repeats nothing
        d, a = document[order], start[order]
        leader = np.flatnonzero(first)[np.cumsum(first) - 1]
        same = (ids[d] == ids[d[leader]]) & (versions[d] == versions[d[leader]]) & (a == a[leader])
        again = ~first & ~same
        k_doc, k_start, k_windows = _merge(d[again], a[again], windows[order][again], least)
        keep = order[first]
        n = len(k_doc)
        cols = [
            np.r_[seed[keep].view(np.int64), _mix(k_doc.astype(np.uint64)).view(np.int64)],
            np.r_[run[keep].view(np.int64), np.zeros(n, np.int64)],
            np.r_[ids[document[keep]], ids[k_doc]],
            np.r_[versions[document[keep]], versions[k_doc]],
            np.r_[start[keep], k_start].astype(np.int32),
            np.r_[windows[keep], -k_windows].astype(np.int32),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", "run", "doc_id", "version", "start", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, version, texts, held = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for d, v, text in zip(*(c.slice(at, 256).to_pylist() for c in batch.columns), strict=True):
                    words = text.encode().split()
                    if len(words) < least:
                        continue
                    doc.append(d)
                    version.append(v)
                    texts.append(words)
                    held += len(words)
                    if held >= WORDS_AT_ONCE:
                        yield rows(doc, version, texts)
                        doc, version, texts, held = [], [], [], 0
        if texts:
            yield rows(doc, version, texts)

    return run


def _reap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchor rows sorted by (anchor, run, doc_id, version, start) to repeats (``sure``) and to runs whose anchor has other runs."""

    def out(rows: np.ndarray, sure: np.ndarray | bool) -> pa.RecordBatch:
        cols = [rows[:, 2], rows[:, 3], rows[:, 4].astype(np.int32), np.abs(rows[:, 5]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.broadcast_to(sure, len(rows)))], names=["doc_id", "version", "start", "windows", "sure"])

    before: int | None = None  # anchor of the last finished run
    held = np.zeros((0, 6), np.int64)

    def finish(rows: np.ndarray, after: int | None) -> pa.RecordBatch:
        """All rows of some whole runs; ``after``: anchor of the run that follows."""
        anchor, run = rows[:, 0], rows[:, 1]
        first = np.r_[True, (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])]
        at = np.flatnonzero(first)
        leader = rows[at][np.cumsum(first) - 1]
        repeat = ~first & (rows[:, 2:5] != leader[:, 2:5]).any(1)
        own = anchor[at]
        left = np.r_[before is not None and own[0] == before, own[1:] == own[:-1]]
        right = np.r_[own[:-1] == own[1:], after is not None and own[-1] == after]
        asked = rows[at[left | right]]
        return out(np.concatenate([rows[repeat], asked]), np.r_[np.ones(repeat.sum(), bool), np.zeros(len(asked), bool)])

    for batch in batches:
        new = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)
        known = new[:, 5] < 0
        if known.any():
            yield out(new[known], True)
            new = new[~known]
        held = np.concatenate([held, new])
        if len(held) < ROWS_AT_ONCE:
            continue
        differs = np.flatnonzero((held[:, :2] != held[-1, :2]).any(1))
        if len(differs):
            cut_at = int(differs[-1]) + 1
            yield finish(held[:cut_at], int(held[-1, 0]))
            before, held = int(held[cut_at - 1, 0]), held[cut_at:]
        elif len(held) > 1:  # one long run: all but its first are repeats
            yield out(held[1:][(held[1:, 2:5] != held[0, 2:5]).any(1)], True)
            held = held[:1]
    if len(held):
        yield finish(held, None)


def _extend(least: int):
    """(doc_id, version, text, asked runs, ...) to its windows: two hashes, and where each begins. Of equal windows that
    come together the first goes on; the others are repeats (windows negative, joined to runs) and take hashes of
    their place, so that a window of many documents meets as one row for each piece of its documents."""

    def out(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, version: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((start, version, doc, h2, h1))
        h1, h2, doc, version, start = (x[order] for x in (h1, h2, doc, version, start))
        first = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        leader = np.flatnonzero(first)[np.cumsum(first) - 1]
        # rows equal in all are the same window and repeat nothing
        again = (doc != doc[leader]) | (version != version[leader]) | (start != start[leader])
        known, k_start, k_windows = _merge_keyed(doc[again], version[again], start[again], least)
        own = [known[:, 0], known[:, 1]]
        place = _mix(own[0].astype(np.uint64) ^ _mix(own[1].astype(np.uint64) ^ _mix(k_start.astype(np.uint64)))).view(np.int64)
        cols = [
            np.r_[h1[first], place],
            np.r_[h2[first], np.zeros(len(place), np.int64)],
            np.r_[doc[first], own[0]],
            np.r_[version[first], own[1]],
            np.r_[start[first], k_start].astype(np.int32),
            np.r_[np.ones(first.sum(), np.int32), -k_windows.astype(np.int32)],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h1", "h2", "key", "version", "start", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        total = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for d, v, text, asked in zip(*(batch.column(i).slice(at, 256).to_pylist() for i in range(4)), strict=True):
                    hashes = _word_hashes(text.encode().split())
                    begin = np.array([a["start"] for a in asked], np.int64)
                    n = np.array([a["windows"] for a in asked], np.int64)
                    start = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    h1, h2 = (_Sums(hashes, b).of(start, start + least).view(np.int64) for b in BASES)
                    held.append((h1, h2, np.full(len(start), d, np.int64), np.full(len(start), v, np.int64), start))
                    total += len(start)
                    if total >= ROWS_AT_ONCE:
                        yield out(*map(np.concatenate, zip(*held, strict=True)))
                        held, total = [], 0
        if held:
            yield out(*map(np.concatenate, zip(*held, strict=True)))

    return run


def _merge_keyed(doc: np.ndarray, version: np.ndarray, start: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single windows, repeated rows among them, merged to runs: (document and version, start, windows)."""
    keys = np.stack([doc, version], 1)
    if not len(keys):
        return keys, start, start
    known, number = np.unique(keys, axis=0, return_inverse=True)
    places = np.unique(np.stack([number.ravel(), start], 1), axis=0)
    own, k_start, k_windows = _merge(places[:, 0], places[:, 1], np.ones(len(places), np.int64), least)
    return known[own], k_start, k_windows


def _remove(least: int):
    """(doc_id, text, repeats) to the text that is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, repeats in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                n, gone = len(words), 0
                if repeats:
                    change = np.zeros(n + 1, np.int64)
                    start = np.array([r["start"] for r in repeats])
                    np.add.at(change, start, 1)
                    np.add.at(change, start + np.array([r["windows"] for r in repeats]) - 1 + least, -1)
                    stays = np.cumsum(change[:n]) == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                    gone = n - len(words)
                total.append(n)
                removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), *batch.columns[3:]], names=["doc_id", "n_words", "n_removed", "kept", *batch.schema.names[3:]])

    return run


def substring_dedup(docs: DataFrame, least: int = 20, anchor: int = 8, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row's doc_id, n_words, n_removed, ``kept`` (the words that stay, joined by one space) and the columns named
    in ``carry``, prefixed ``doc_``."""
    if not 0 < anchor <= least:
        raise ValueError("an anchor has at least one word and at most as many as a repeat")
    reach_workers(docs.sparkSession)
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *[F.col(c).alias(f"doc_{c}") for c in carry])
    keyed = base.select(F.coalesce("doc_id", F.lit(LAST)).alias("key"), F.xxhash64("text").alias("version"), "*")
    rows = keyed.filter("text is not null").select("key", "version", "text").mapInArrow(_sow(least, anchor), ROWS)
    rows = rows.repartition("anchor").sortWithinPartitions("anchor", "run", "doc_id", "version", "start")
    found = cut(rows.mapInArrow(_reap, FOUND)).toDF("key", "version", "start", "windows", "sure")
    spans = F.collect_list(F.struct("start", "windows")).alias("spans")
    asked = found.filter("not sure").groupBy("key", "version").agg(spans)
    # all columns go along, though unread, so that both joins need the same shuffle of the texts and Spark makes it once
    asking = keyed.join(asked, ["key", "version"]).select("key", "version", "text", "spans", *base.columns[:1], *base.columns[2:])
    windows = asking.mapInArrow(_extend(least), "h1 long, h2 long, key long, version long, start int, windows int")
    order = F.dense_rank().over(Window.partitionBy("h1", "h2").orderBy("key", "version", "start"))
    again = windows.withColumn("nth", order).filter("nth > 1 or windows < 0").select("key", "version", "start", F.abs("windows").alias("windows"))
    repeats = found.filter("sure").select("key", "version", "start", "windows").union(again).groupBy("key", "version").agg(spans)
    joined = keyed.join(repeats, ["key", "version"], "left").select("doc_id", "text", "spans", *[f"doc_{c}" for c in carry])
    carried = "".join(f", `doc_{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema.fields) if carry else ""
    return joined.mapInArrow(_remove(least), f"doc_id long, n_words long, n_removed long, kept string{carried}")
