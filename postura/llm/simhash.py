"""SimHash near-duplicate groups.

Fingerprints: 64 bits; bit i is 1 if it is set in over half of the XXH64 values (seed 42) of a
text's word shingles. Two documents are linked if their fingerprints differ in at most ``max_bits``
bits; a group is a connected component of links, named by its smallest doc_id.

Method: a Gray-order hierarchical index. Copies are first reduced to one row a fingerprint. Two
fingerprints at most 3 bits apart agree on one whole quarter of the bits, so each is dealt to four
lists, one for each quarter's value (``max_bits + 1`` lists in general); none of the links is lost. A list is sorted by the Gray
rank of the fingerprint, so that neighbours share most bits. Runs of FAN neighbours form a node
that holds the bits on which all of its members agree (mask and pattern), and so on upwards; a
node's children keep only what the node has not. Node pairs are compared from the top: the
differences on shared masks add up on the way down, and a pair beyond ``max_bits`` falls with
all that is below it. A pair whose remaining free bits cannot exceed ``max_bits`` is linked as a
whole, and pairs already connected are skipped, so that a large group of near copies costs
neither all its pairs nor rows for them: a list gives at most one link for each of its members.

Lists over BLOCK members are dealt into blocks by hash, and each pair of blocks is a list of its own.

Defined results: null and wordless texts have fingerprint zero and link like any other; repeated
rows fall into one group; rows without doc_id have their fingerprint but no component; other input
columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.llm.common import cut, id_text, map_batches
from postura.llm.components import connected_components

SEED = 42
FAN = 8
BLOCK = 8192
CHUNK_ROWS = 65_536
FRONTIER = 1 << 19


def fingerprint(text: str, shingle: int) -> int:
    words = text.encode().lower().split()  # on bytes: A-Z, and the six ASCII white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 16_384):
        some = values[at : at + 16_384].view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(some, axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint long, its 64 bits as a signed number) of every row."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            slices = (batch.column(1).slice(at, 256).to_pylist() for at in range(0, batch.num_rows, 256))
            prints = np.array([fingerprint(t or "", shingle) for texts in slices for t in texts], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"])

        return each

    return map_batches(id_text(docs), make, "doc_id long, fingerprint long")


def _gray_rank(bits):
    """Column: place of the 64-bit code in the reflected Gray sequence, as an unsigned number."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


class GrayIndex:
    """Index over lists of fingerprints; members of a list are adjacent and in Gray order."""

    def __init__(self, lists: np.ndarray, prints: np.ndarray) -> None:
        """lists: number of each member's list, ascending."""
        ones = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.levels = [(prints, np.full(len(prints), ones), np.arange(len(prints)), np.arange(len(prints)) + 1, lists)]
        while len(self.levels[-1][0]) > len(np.unique(self.levels[-1][4])):
            pattern, mask, _, _, of = self.levels[-1]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            inside = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
            begin = np.flatnonzero(inside % FAN == 0)
            both_one = np.bitwise_and.reduceat(pattern & mask, begin)
            both_zero = np.bitwise_and.reduceat(~pattern & mask, begin)
            self.levels.append((both_one, both_one | both_zero, begin, np.r_[begin[1:], len(of)], of[begin]))
        n = len(self.levels[-1][0])
        self.labels = np.arange(len(prints))
        self.roots = (np.arange(n), np.arange(n))

    def spans(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last member below each node of a level."""
        if not hasattr(self, "_spans"):
            first, last = self.levels[0][2], self.levels[0][2]
            self._spans = [(first, last)]
            for _, _, begin, end, _ in self.levels[1:]:
                first, last = first[begin], last[end - 1]
                self._spans.append((first, last))
        return self._spans[level]

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the components of members a[i] and b[i]."""
        labels = self.labels
        while len(a):
            la, lb = labels[a], labels[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            if not len(a):
                break
            np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
            while not np.array_equal(labels, nxt := labels[labels]):
                labels = nxt
        self.labels = labels

    def uniform(self, level: int) -> np.ndarray:
        """Label that all members below a node share, or -1."""
        first, last = self.spans(level)
        low, high = np.minimum.reduceat(self.labels, first), np.maximum.reduceat(self.labels, first)
        return np.where(low == high, low, -1)

    def components(self, max_bits: int) -> np.ndarray:
        """Label of every member: the first member of its list that it is connected to."""
        top = len(self.levels) - 1
        a, b = self.roots
        stack = [(top, a, b, np.zeros(len(a), np.int64), np.zeros(len(a), np.uint64))]
        while stack:
            level, a, b, spent, seen = stack.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                stack += [(level, a[half:], b[half:], spent[half:], seen[half:]), (level, a[:half], b[:half], spent[:half], seen[:half])]
                continue
            if level and len(a) > 64:
                own = self.uniform(level)
                keep = (own[a] < 0) | (own[a] != own[b])
                a, b, spent, seen = a[keep], b[keep], spent[keep], seen[keep]
            pattern, mask, begin, end, _ = self.levels[level]
            shared = mask[a] & mask[b]
            spent = spent + np.bitwise_count((pattern[a] ^ pattern[b]) & shared & ~seen)
            near = spent <= max_bits
            a, b, spent, shared = a[near], b[near], spent[near], shared[near]
            if not len(a):
                continue
            free = 64 - np.bitwise_count(shared).astype(np.int64)
            all_near = spent + free <= max_bits
            if all_near.any():
                first, last = self.spans(level)
                heads = first[a[all_near]]
                for side in (a[all_near], b[all_near]):
                    n = last[side] - first[side] + 1
                    members = np.repeat(first[side] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    self.link(np.repeat(heads, n), members)
                rest = ~all_near
                a, b, spent, shared = a[rest], b[rest], spent[rest], shared[rest]
            if level == 0 or not len(a):
                continue
            na, nb = end[a] - begin[a], end[b] - begin[b]
            n = na * nb
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(nb, n)
            ca, cb = np.repeat(begin[a], n) + inside // wide, np.repeat(begin[b], n) + inside % wide
            keep = ca <= cb
            stack.append((level - 1, ca[keep], cb[keep], np.repeat(spent, n)[keep], np.repeat(shared, n)[keep]))
        return self.labels


def _links(max_bits: int):
    """Sorted rows (quarter, value, low, high, fingerprint, first) to links (a, b)."""

    def within(rows: list[np.ndarray]) -> pa.RecordBatch:
        key, prints, first = rows
        number = np.cumsum(np.r_[0, (key[1:] != key[:-1]).any(1)])
        size = np.bincount(number)
        many = size[number] > 1
        labels = GrayIndex(number[many], prints[many]).components(max_bits) if many.any() else np.zeros(0, np.int64)
        first = first[many]
        linked = labels != np.arange(len(labels))
        return pa.RecordBatch.from_arrays([pa.array(first[linked]), pa.array(first[labels[linked]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new = [np.stack(cols[:4], 1), cols[4].view(np.uint64), cols[5]]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if len(held[0]) >= CHUNK_ROWS and (held[0][0] != held[0][-1]).any():
                last = int(np.flatnonzero((held[0] != held[0][-1]).any(1))[-1]) + 1  # the last list may go on
                yield within([x[:last] for x in held])
                held = [x[last:] for x in held]
        if held is not None:
            yield within(held)

    return run


def near_links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) that connect all rows of ``prints(fingerprint, first)``, unique in both columns, whose
    fingerprints differ in at most ``max_bits`` bits."""
    lists = max_bits + 1
    width = -(-64 // lists)
    if width > 18:
        width = 16  # more lists than needed, so that the table of list sizes stays bounded
        lists = 4
    # a list's own bits come first, then Gray order over all bits turned so that those lead
    turned = "shiftleft(fingerprint, 64 - {0}) | shiftrightunsigned(fingerprint, {0})"
    dealt = prints.select(F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("quarter"), "fingerprint", "first")
    value = F.expr(f"shiftrightunsigned(fingerprint, quarter * {width}) & {(1 << width) - 1}L")
    dealt = dealt.withColumn("value", value)
    # the turn puts the list's bits, which all members share, above the others
    turns = [F.expr(turned.format((i + 1) * width % 64) if (i + 1) * width % 64 else "fingerprint") for i in range(lists)]
    rank = F.element_at(F.array(*map(_gray_rank, turns)), F.col("quarter") + 1)
    # one row for each BLOCK members of a list at most, and at most lists * 2^width rows (262,144 for 3 bits)
    long = dealt.groupBy("quarter", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    dealt = dealt.join(F.broadcast(long), ["quarter", "value"], "left")
    blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), blocks.cast("long")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    keys = [F.col("quarter").cast("long").alias("quarter"), "value", F.least("own", "other").cast("long").alias("low"), F.greatest("own", "other").cast("long").alias("high")]
    # unsigned order
    rows = dealt.select(*keys, "fingerprint", "first", rank.bitwiseXOR(F.lit(-(1 << 63))).alias("rank"))
    rows = rows.repartition("quarter", "value", "low", "high").sortWithinPartitions("quarter", "value", "low", "high", "rank")
    return rows.drop("rank").mapInArrow(_links(max_bits), "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint as a signed long, component_id) of every row of ``docs``."""
    rows = cut(fingerprints(docs, shingle))
    prints = cut(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    names = connected_components(near_links(prints.filter("first is not null"), max_bits))
    named = prints.join(names, F.col("first") == F.col("node"), "left").select("fingerprint", F.coalesce("component", "first").alias("component_id"))
    # written once more so that the last join shuffles both sides and Spark can split a hot fingerprint
    joined = rows.join(cut(named), "fingerprint")
    return joined.select("doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
