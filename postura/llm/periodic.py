"""Periodic runs of words: stretches that repeat themselves, found with a suffix automaton under link-cut access.

A run is a stretch of words of smallest period q and length at least max(``least``, 2q) that no neighbouring word extends.

Method: the states of the suffix automaton hang on their suffix links, each path from a prefix to the root holding all its
suffixes. The tree is kept as a link-cut tree whose preferred paths are the suffixes that last ended at one word. Appending word i
accesses its prefix, and the path of i falls into segments of one last end e each: the suffixes of up to ``reach`` words of the
segment ended at e and end at i now. Where the distance i - e is at most ``reach``, the words up to i hold a
square of that period, which ``reach`` extends to the left and a comparison of words to the right. The access recolours the
whole path with i; a path changes preferred children O(log n) times on average, so a text costs O(n log^2 n).

In a run each group of ceil(least / 2) words comes again one period before or after. Words in no repeated group of their document
are in no run, so that only stretches of repeated groups (numpy; equal hashes of different groups merely widen a stretch)
go through the automaton. Documents are independent: no shuffle. Memory grows with the longest stretch of one document.

Defined results: words are runs of anything but the six ASCII white-space bytes; null text has no words; rows are kept as they
come, repeated and without doc_id too; other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postura.llm.common import id_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS_AT_ONCE = 256
WORDS_AT_ONCE = 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)
FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def automaton(words: list[int]) -> tuple[array, array, array]:
    """(length, link) of the states of the suffix automaton, and the state of each prefix. Most states have one
    way on, which two arrays hold; the others keep the rest in a dictionary."""
    length, link, word, to = array("i", [0]), array("i", [-1]), array("i", [-1]), array("i", [-1])
    more: dict[int, dict[int, int]] = {}
    prefix, last = array("i"), 0
    for i, c in enumerate(words):
        state, p, q = len(length), last, -1
        length.append(i + 1)
        link.append(0)
        word.append(-1)
        to.append(-1)
        while p >= 0:
            w = word[p]
            if w == c:
                q = to[p]
                break
            if w < 0:
                word[p], to[p] = c, state
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {c: state}
                elif c in others:
                    q = others[c]
                    break
                else:
                    others[c] = state
            p = link[p]
        if q >= 0:
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                word.append(word[q])
                to.append(to[q])
                if q in more:
                    more[clone] = more[q].copy()
                while p >= 0:
                    if word[p] == c:
                        if to[p] != q:
                            break
                        to[p] = clone
                    else:
                        others = more[p]
                        if others[c] != q:
                            break
                        others[c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
        prefix.append(state)
    return length, link, prefix


def runs_of(words: list[int], least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``words``."""
    length, up, prefix = automaton(words)  # ``up``: parent in the splay tree, or for its root the path above
    none = array("i", [-1])
    left, right, seen = none * len(length), none * len(length), none * len(length)  # ``seen`` counts at splay roots
    done: dict[int, int] = {}  # end of the last run of each period
    out, n = [], len(words)
    for i in range(n):
        x, below = prefix[i], -1
        while x >= 0:
            # splay x to the root of its path, which keeps the path's last end
            while (p := up[x]) >= 0 and (left[p] == x or right[p] == x):
                g = up[p]
                if g >= 0 and (left[g] == p or right[g] == p):
                    top, over = g, up[g]
                    if (left[g] == p) == (left[p] == x):  # p over g, then x over p
                        if left[g] == p:
                            b = right[p]
                            left[g], right[p] = b, g
                        else:
                            b = left[p]
                            right[g], left[p] = b, g
                        if b >= 0:
                            up[b] = g
                        up[g] = p
                        if left[p] == x:
                            b = right[x]
                            left[p], right[x] = b, p
                        else:
                            b = left[x]
                            right[p], left[x] = b, p
                        if b >= 0:
                            up[b] = p
                        up[p] = x
                    else:  # x over both
                        if left[p] == x:
                            a, b = left[x], right[x]
                            right[g], left[p] = a, b
                            left[x], right[x] = g, p
                            if a >= 0:
                                up[a] = g
                            if b >= 0:
                                up[b] = p
                        else:
                            a, b = left[x], right[x]
                            right[p], left[g] = a, b
                            left[x], right[x] = p, g
                            if a >= 0:
                                up[a] = p
                            if b >= 0:
                                up[b] = g
                        up[p] = up[g] = x
                else:
                    top, over = p, g
                    if left[p] == x:
                        b = right[x]
                        left[p], right[x] = b, p
                    else:
                        b = left[x]
                        right[p], left[x] = b, p
                    if b >= 0:
                        up[b] = p
                    up[p] = x
                up[x] = over
                if over >= 0 and left[over] == top:
                    left[over] = x
                elif over >= 0 and right[over] == top:
                    right[over] = x
                else:
                    seen[x] = seen[top]
            end, reach = seen[x], length[x]
            if (r := right[x]) >= 0:  # longer suffixes, which do not end here, keep their last end
                seen[r] = end
            right[x] = below
            if end >= 0 and (period := i - end) <= reach and done.get(period, -1) <= i:
                j = i + 1
                while j < n and words[j] == words[j - period]:
                    j += 1
                done[period] = j
                start = i - period - reach + 1
                if j - start >= least:
                    out.append((start, j - start, period))
            below, x = x, up[x]
        seen[below] = i
    return out


def repeated_stretches(ids: np.ndarray, document: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches of at least ``least`` words in which each word is in a group of words that comes
    again in the stretch; ``ids`` are the words of documents laid end to end."""
    group = (least + 1) // 2
    part = document.astype(np.uint64)
    place = np.arange(len(ids))
    values = ids.astype(np.uint64)
    while len(place) >= group:
        n = len(place) - group + 1
        with np.errstate(over="ignore"):
            sums = part[:n] * np.uint64(0xD1342543DE82EF95)
            for k in range(group):
                sums = sums * BASE + values[k : k + n]
            sums ^= sums >> np.uint64(29)
            sums *= BASE
        inside = (part[:n] == part[group - 1 :]) & (place[group - 1 :] - place[:n] == group - 1)
        order = np.sort(sums[inside])
        again = np.unique(order[1:][order[1:] == order[:-1]])
        at = np.searchsorted(again, sums)
        marked = inside & (np.append(again, 0)[at] == sums) & (at < len(again))
        edges = np.zeros(len(place) + 1, np.int64)
        edges[:n] += marked
        edges[group : group + n] -= marked
        covered = np.cumsum(edges[:-1]) > 0
        # consecutive covered words of one part are the next parts
        kept = np.flatnonzero(covered)
        if not len(kept):
            return []
        fresh = np.r_[True, (place[kept][1:] != place[kept][:-1] + 1) | (part[kept][1:] != part[kept][:-1])]
        number = np.cumsum(fresh) - 1
        long = np.bincount(number)[number] >= least
        same = len(kept) == len(place) and long.all()
        place, values, part = place[kept][long], values[kept][long], number[long].astype(np.uint64)
        if same:
            break
    else:
        return []
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    last = np.r_[first[1:], len(part)] - 1
    return list(zip(place[first].tolist(), (place[last] + 1).tolist(), strict=True))


def _collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words but those in a run after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return " ".join([words[i] for i in kept.tolist()])


def _documents(texts: list[list[str]], least: int) -> tuple[list[list[tuple[int, int, int]]], list[str]]:
    index: defaultdict[str, int] = defaultdict(count(1).__next__)
    lengths = np.array([len(t) for t in texts], np.int64)
    ids = np.fromiter((index[w] for t in texts for w in t), np.int64, int(lengths.sum()))
    begin = np.cumsum(lengths) - lengths
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in repeated_stretches(ids, np.repeat(np.arange(len(texts)), lengths), least):
        d = int(np.searchsorted(begin, a, "right")) - 1
        shift = a - int(begin[d])
        small: dict[int, int] = {}
        words = [small.setdefault(w, len(small)) for w in ids[a:b].tolist()]
        runs[d] += [(start + shift, length, period) for start, length, period in runs_of(words, least)]
    for own in runs:
        own.sort(key=lambda r: (r[0], r[2]))
    return runs, [_collapse(t, r) if r else " ".join(t) for t, r in zip(texts, runs, strict=True)]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Documents of a batch by pieces of about WORDS_AT_ONCE words."""
    ids, texts, held = [], [], 0
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        rows = batch.slice(at, ROWS_AT_ONCE)
        for d, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
            words = WORD.findall(text.as_py() or "")
            ids.append(d)
            texts.append(words)
            held += len(words)
            if held >= WORDS_AT_ONCE:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start and period, and its words without those that
    repeat an earlier period of a run, joined by spaces."""
    if least < 2:
        raise ValueError("a run has at least two words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slices(batch):
                runs, collapsed = _documents(texts, least)
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(rows, pa.list_(RUN)), pa.array(collapsed, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return id_text(docs).mapInArrow(run, FOUND)
