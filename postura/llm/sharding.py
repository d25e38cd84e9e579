"""Shards of equal row counts along a Hilbert curve, in DataFrame operations only.

Method: several metadata dimensions (text size, doc_id, lang, source) are quantised to eight levels each,
numbers at their eighths and strings by hash; the cell's index on the Hilbert curve orders the rows, and the
order is cut into runs. Rows near in several dimensions lie in one shard, so the minima and maxima of its
files let a reader skip most of them for a filter on any of the dimensions.

Law ``rows``: row p of n goes to shard floor(p * shards / n), so counts differ by one at most. No global sort:
the rows of a cell are dealt by hash into one group for each ROWS_A_GROUP of them, so there are at most rows / ROWS_A_GROUP + 4096
groups; group sizes give each group's first place by running sums (over the cells, and over the groups of one cell), and
a row adds its place in its own group. A cell with a third of all rows has as many groups as it needs.

Defined results: null text has no bytes and the checksum of the empty text; null metadata is a level of its
own or the lowest; ties in the order are broken by size and checksum, and rows equal in these are
interchangeable; the cuts between the levels are approximate eighths, which over very many rows may differ a little between runs
(the law holds for any cuts); an empty table gives an empty one. Other input columns are carried only if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postura.llm.common import cut

BITS, DIMENSIONS = 3, 4
LEVELS = 1 << BITS
ROWS_A_GROUP = 10_000


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Index of a cell on the Hilbert curve (Skilling's transform)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    index = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | ((x[i] ^ t) >> b & 1)
    return index


def _curve(levels: list[Column]) -> Column:
    """Index of the cell, from a constant table with one entry for each of the 4096 cells."""
    cells = [()]
    for _ in range(DIMENSIONS):
        cells = [(*c, v) for c in cells for v in range(LEVELS)]
    table = F.expr(f"array({','.join(str(hilbert_index(c, BITS)) for c in cells)})")
    at = levels[0]
    for v in levels[1:]:
        at = at * LEVELS + v
    return F.element_at(table, (at + 1).cast("int"))


def _level(column: Column, cuts: list[float] | None) -> Column:
    """Number of cuts that the value exceeds; null is the lowest level."""
    return sum((F.when(column > c, 1).otherwise(0) for c in sorted(set(cuts or []))), F.lit(0))


def _hashed(column: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("\0"))), F.lit(LEVELS)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int, keep: tuple[str, ...] = (), rows_a_group: int = ROWS_A_GROUP) -> DataFrame:
    """(doc_id, size, text_crc32, cell, shard, slot) of every row, ``cell`` its index on the curve, and the columns named in
    ``keep``, prefixed ``doc_``."""
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.col("text").cast("string")
    rows = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            _hashed(F.col("lang")).alias("_lang"),
            _hashed(F.col("source")).alias("_source"),
            *[F.col(c).alias(f"doc_{c}") for c in keep],
        )
    )
    eighths = F.array(*[F.lit(i / LEVELS) for i in range(1, LEVELS)])
    # one row: the number of rows and seven cuts of each number
    n, by_size, by_id = rows.agg(F.count(F.lit(1)), F.percentile_approx("size", eighths), F.percentile_approx("doc_id", eighths)).first()
    hashed = F.xxhash64("doc_id", "size", "text_crc32")
    levels = [_level(F.col("size"), by_size), _level(F.col("doc_id"), by_id), F.col("_lang"), F.col("_source")]
    placed = rows.withColumn("cell", _curve(levels)).withColumn("_hash", hashed)
    sums = Window.rowsBetween(Window.unboundedPreceding, -1)
    # at most 4096 rows
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.select("cell", F.ceil(F.col("_n") / rows_a_group).alias("_groups"), F.coalesce(F.sum("_n").over(sums.orderBy("cell")), F.lit(0)).alias("_cells_before"))
    placed = placed.join(F.broadcast(cells), "cell").withColumn("_group", F.pmod(F.col("_hash"), F.col("_groups")))
    sizes = placed.groupBy("cell", "_group", "_cells_before").agg(F.count(F.lit(1)).alias("_n"))
    groups_before = F.coalesce(F.sum("_n").over(sums.partitionBy("cell").orderBy("_group")), F.lit(0))
    starts = sizes.select("cell", "_group", (F.col("_cells_before") + groups_before).alias("_first"))
    own = F.row_number().over(Window.partitionBy("cell", "_group").orderBy("_hash", "doc_id", "size", "text_crc32"))
    placed = placed.withColumn("_own", own).join(starts, ["cell", "_group"])
    place = F.col("_first") + F.col("_own") - 1
    placed = placed.withColumn("_place", place).withColumn("shard", F.expr(f"_place * {shards} div {max(n, 1)}").cast("int"))
    begin = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return placed.select("doc_id", "size", "text_crc32", "cell", "shard", (F.col("_place") - begin).alias("slot"), *[f"doc_{c}" for c in keep])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in curve order."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
