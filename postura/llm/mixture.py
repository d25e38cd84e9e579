"""Mixing sources to target weights: how often each document is taken, in DataFrame operations only.

Targets: the sources, ordered by code point (null last), weigh ``weights`` in turn and share ``share`` of all words.
A target stops at ``most`` times its source's words; what is over is shared again by weight until no target is above.

Method: hash-threshold histograms. A source takes each of its documents floor(target / words) times; the budget that is
left takes, once more, the documents whose key lies below the source's threshold. A key is the hash of doc_id and
text, so a larger budget only adds documents. The threshold comes from nested histograms: words summed by source and
leading hex digits of the key, of which the bucket where the running sum passes the budget is refined by the next digits,
and only that one, until it holds one document; that one is taken if this brings the sum nearer to the budget. No rows
are sorted: a level is one scan of (source, words, key) and a histogram of at most 4,096 buckets a source, so a
hot source costs as many partial sums as any other.

Defined results: null text has no words; null is a source of its own; a source without words has target 0. Rows equal
in doc_id and text are told apart by digits of their place in the input; as they are interchangeable, reruns agree.
Other input columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postura.llm.common import cut, join_small, ranked

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3
KEY_DIGITS = 48


def source_targets(sizes: DataFrame, share: tuple[int, int], weights: Sequence[int], most: int) -> DataFrame:
    """``sizes(source, source_size)`` with each source's target; the driver sees two sums a round."""
    order = ranked(sizes, [F.col("source").asc_nulls_last()], "_no")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_no") % len(weights) + 1).cast("int"))
    sources = cut(order.withColumn("_weight", weight.cast("decimal(38,0)")).withColumn("_size", F.col("source_size").cast("decimal(38,0)")))
    part, whole = share
    words, weigh = sources.agg(F.sum("_size"), F.sum("_weight")).first()
    # every target below its stop is its weight times level = num / den
    num, den = part * int(words or 0), whole * int(weigh or 1)
    while True:
        above = F.expr(f"_weight * {num}BD > _size * {most * den}BD")
        stopped, others = sources.agg(F.sum(F.when(above, F.col("_size"))), F.sum(F.when(~above, F.col("_weight")))).first()
        step = part * int(words or 0) - whole * most * int(stopped or 0), whole * int(others or 1)
        if step == (num, den):
            break
        num, den = step
    target = F.when(above, (F.col("_size") * most).cast("double")).otherwise((F.col("_weight") * F.expr(f"{num}BD")).cast("double") / F.lit(float(den)))
    return sources.select("_no", "source", "source_size", target.alias("target"))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(_no, _edge, _before) of each source whose words pass its budget: the leading digits that only the document at the
    threshold has, and the words below. ``rows`` are (_no, size, _key) with words, ``budgets`` (_no, budget)."""
    edges, digits, left = budgets.select("_no", "budget", F.lit("").alias("_edge"), F.lit(0).cast("long").alias("_before")), 0, 2
    while left > 1 and digits < KEY_DIGITS:
        inside = join_small(rows, edges, ["_no"]).filter(F.substring("_key", 1, digits) == F.col("_edge"))
        digits += DIGITS
        bucket = F.substring("_key", 1, digits).alias("_edge")
        sums = inside.groupBy("_no", "budget", "_before", bucket).agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
        # at most 4,096 rows a source
        upto = F.sum("_words").over(Window.partitionBy("_no").orderBy("_edge"))
        passed = sums.withColumn("_upto", F.col("_before") + upto).filter("_upto > budget and _upto - _words <= budget")
        edges = cut(passed.select("_no", "budget", "_edge", (F.col("_upto") - F.col("_words")).alias("_before"), "_rows"))
        left = edges.agg(F.max("_rows")).first()[0] or 0
        edges = edges.drop("_rows")
    return edges.select("_no", "_edge", "_before")


def mixture(docs: DataFrame, share: tuple[int, int] = (3, 2), weights: Sequence[int] = (3, 1, 2), most: int = 2) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row: ``size`` in words, ``copies`` how often the mix takes it."""
    part, whole = share
    if not weights or min(weights) < 1 or whole < 1 or not 0 <= part <= most * whole:
        raise ValueError("weights must be positive and the share between 0 and the most copies")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    key = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    apart = F.lower(F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), KEY_DIGITS - 32, "0"))
    rows = cut(
        docs.select(
            doc_id.alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.concat(key, apart).alias("_key"),
        )
    )
    targets = source_targets(cut(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), share, weights, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plans = targets.withColumn("_times", times).withColumn("budget", F.col("target") - F.col("_times") * F.col("source_size"))
    plans = cut(plans.withColumn("_known", F.col("source").isNotNull()).withColumn("_name", F.coalesce("source", F.lit(""))))
    named = rows.withColumn("_known", F.col("source").isNotNull()).withColumn("_name", F.coalesce("source", F.lit("")))
    planned = cut(join_small(named, plans.drop("source"), ["_known", "_name"]).drop("_known", "_name"))
    edges = _thresholds(planned.filter("size > 0").select("_no", "size", "_key"), plans.select("_no", "budget"))
    few = edges.limit(100_001).count() <= 100_000
    found = planned.join(F.broadcast(edges) if few else edges, "_no", "left")
    at_edge = F.col("_key").startswith(F.col("_edge")) & ((F.col("budget") - F.col("_before")) * 2 >= F.col("size"))
    more = F.coalesce((F.col("_key") < F.col("_edge")) | at_edge, F.lit(False)).cast("int")
    return found.select("doc_id", "source", "size", "source_size", "target", (F.col("_times") + more).alias("copies"))
