"""Secret scans with a trigram inverted index, in DataFrame operations only.

Method: from each rule's regular expression a Boolean query over trigrams is derived that every text with a
match satisfies: its mandatory literal runs, an OR over alternatives of ANDs over their trigrams. The
inverted index has a row (trigram, doc_id) for each trigram of these queries that a lower-cased text holds;
postings are intersected by document, and only candidate documents run the rule's expression.
A rule without mandatory trigrams (long hexadecimal strings) scans every document.

Matches are leftmost and do not overlap within a kind; positions are code points, end exclusive. A rule may drop
matches after the fact (a short value, a short key), which never lets another match begin inside.

Defined results: null text is the empty text without matches; rows that repeat a doc_id share index entries and are each
verified by themselves; rows without doc_id have no index entry and run every rule; other input columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re._constants as C
from dataclasses import dataclass
from itertools import product
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.llm.common import id_text

BITS_A_WORD = 60


@dataclass(frozen=True)
class Rule:
    """``group`` of a match (0: all of it) must have ``least`` characters or more, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds. A run of 32 or more is the only part of a run that counts, so hex states the length at once.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Published formats of tokens and keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE + MORE

# A query is an AND of clauses; a clause is an OR of alternatives; an alternative is an AND of trigrams.
Query = list[frozenset[frozenset[str]]]


def trigram_query(pattern: str, most: int = 64) -> Query:
    """Clauses that every text with a match satisfies once lower-cased; none if nothing is mandatory."""
    clauses: Query = []

    def flush(runs: set[str]) -> None:
        clause = frozenset(frozenset(r[i : i + 3] for i in range(len(r) - 2)) for r in runs)
        if all(clause):
            clauses.append(clause)

    def strings(op: object, arg: object) -> set[str] | None:
        """All strings an element can be, lower-cased, or None if they are too many."""
        if op is C.LITERAL:
            return {chr(arg).lower()}
        if op is C.IN and all(o is C.LITERAL for o, _ in arg):
            return {chr(v).lower() for _, v in arg}
        if op is C.SUBPATTERN:
            return sequence(arg[3])
        if op is C.BRANCH:
            parts = [sequence(b) for b in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is C.MAX_REPEAT and arg[1] == 1:
            inner = sequence(arg[2])
            return None if inner is None else inner | ({""} if arg[0] == 0 else set())
        return None

    def sequence(items: object) -> set[str] | None:
        out = {""}
        for op, arg in items:
            found = strings(op, arg)
            if found is None or len(out) * len(found) > most:
                return None
            out = {a + b for a, b in product(out, found)}
        return out

    def walk(items: object, runs: set[str]) -> set[str]:
        for op, arg in items:
            found = strings(op, arg)
            if found is not None and len(runs) * len(found) <= most:
                runs = {a + b for a, b in product(runs, found)}
            elif op is C.SUBPATTERN:
                runs = walk(arg[3], runs)
            else:
                flush(runs)
                runs = found if found is not None else {""}
        return runs

    flush(walk(parser.parse(pattern), {""}))
    return clauses


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, doc_id) for each of ``trigrams`` that a lower-cased text holds."""
    vocabulary = F.array(*map(F.lit, trigrams))
    # the one-element array gives the lower-cased text a name, so that it is made once a row
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(vocabulary, lambda t: F.contains(low, t)))
    return docs.filter("doc_id is not null and text <> ''").select(F.explode(F.flatten(held)).alias("trigram"), "doc_id")


def candidates(index: DataFrame, queries: list[Query], trigrams: list[str]) -> DataFrame:
    """(doc_id, rules): bit i of ``rules`` is set if the document's postings satisfy query i."""
    number = F.array_position(F.array(*map(F.lit, trigrams)), F.col("trigram")).cast("int") - 1
    words = range(-(-len(trigrams) // BITS_A_WORD))
    bit = F.expr(f"shiftleft(1L, _number % {BITS_A_WORD})")
    held = index.withColumn("_number", number).groupBy("doc_id")
    held = held.agg(*[F.coalesce(F.bit_or(F.when(F.expr(f"_number div {BITS_A_WORD}") == w, bit)), F.lit(0).cast("long")).alias(f"_held{w}") for w in words])

    def has(alternative: frozenset[str]) -> Column:
        masks = [0 for _ in words]
        for t in alternative:
            k = trigrams.index(t)
            masks[k // BITS_A_WORD] |= 1 << k % BITS_A_WORD
        terms = [F.col(f"_held{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in zip(words, masks, strict=True) if m]
        out = terms[0]
        for t in terms[1:]:
            out &= t
        return out

    rules = F.lit(0).cast("long")
    for i, query in enumerate(queries):
        if query:
            holds = F.lit(True)
            for clause in query:
                some = F.lit(False)
                for alternative in sorted(clause, key=sorted):
                    some |= has(alternative)
                holds &= some
            rules = rules + F.when(holds, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return held.select("doc_id", rules.alias("rules")).filter("rules <> 0")


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, end, kind) of a rule's matches, from the matches and the gaps between them."""
    none = F.expr("cast(array() as array<struct<start:int,order:int,end:int,kind:string>>)")
    pattern = F.lit(rule.pattern)

    def add(state: Column, match: Column) -> Column:
        start = state["at"] + F.length(match["gap"])
        end = start + F.length(match["found"])
        long_enough = F.length(F.regexp_extract(match["found"], rule.pattern, rule.group)) >= rule.least
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        kept = F.when(long_enough, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    def place(found: Column) -> Column:
        gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
        pairs = F.arrays_zip(gaps.alias("gap"), found.alias("found"))
        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.element_at(F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none)), 1)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row's doc_id, text (null: empty), ``spans`` (start, order, end, kind; by start, then order of the rule) and the
    columns named in ``carry``, prefixed ``doc_``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *[F.col(c).alias(f"doc_{c}") for c in carry]
    )
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted({t for q in queries for clause in q for alternative in clause for t in alternative})
    if trigrams:
        found = candidates(postings(id_text(docs), trigrams), queries, trigrams)
        rows = rows.join(found, "doc_id", "left")
    else:
        rows = rows.withColumn("rules", F.lit(0).cast("long"))
    every = F.col("doc_id").isNull()
    none = F.expr("cast(array() as array<struct<start:int,order:int,end:int,kind:string>>)")
    parts = []
    for i, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        spans = _spans(F.col("text"), rule, i)
        wanted = every | (F.coalesce(F.col("rules"), F.lit(0).cast("long")).bitwiseAND(F.lit(1 << i)) != 0)
        parts.append(F.when(wanted, spans).otherwise(none) if query else spans)
    return rows.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"), *[f"doc_{c}" for c in carry])


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""

    def add(state: Column, s: Column) -> Column:
        before = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        new = F.concat(state["out"], before, F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], new).otherwise(state["out"]).alias("out"))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add, finish)).otherwise(text)
