"""The registered queries: each applies one operator to its whole table, with production parameters,
and derives the digest columns its contract names."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postura.llm.common import cut, table
from postura.llm.cover_tree import top_k
from postura.llm.merkle import merkle_manifest, row_digest
from postura.llm.mixture import mixture
from postura.llm.packing import cut_documents, pack
from postura.llm.periodic import periodic_runs
from postura.llm.rotated_codes import approximate_nearest
from postura.llm.secrets import BASE, RULES, scan, span_text
from postura.llm.sentencepieces import encode_decode
from postura.llm.sharding import hilbert_shards
from postura.llm.simhash import simhash_groups
from postura.llm.substrings import substring_dedup
from postura.llm.token_counts import count_tokens
from postura.llm.toxicity import fit_model, held_out, score

PIECE_MODEL, WORD_VOCABULARY, BYTE_VOCABULARY = "piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"
TOP_K, TOP_K_EVERY, TOP_K_SCALE = 10, 100, 1024
NEAREST, NEAREST_EVERY = 5, 50
TOKEN_LIMIT = 2048
SHINGLE_WORDS, FINGERPRINT_BITS = 3, 3
SHARDS = 8
REPEAT_WORDS = 20
SEQUENCE_TOKENS, END_ID = 1024, 2
TOXIC_FROM = 0.3
LEAF_FIELDS, TAMPERED_EVERY = ("doc_id", "source", "lang", "n_chars", "text"), 3
RUN_WORDS, PLANTED_EVERY = 12, 10
MIX_SHARE, MIX_WEIGHTS, MIX_MOST = (3, 2), (3, 1, 2), 2


def op1_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), TOP_K, TOP_K_EVERY, TOP_K_SCALE)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in BASE]

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *map(of, kinds), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), SHINGLE_WORDS, FINGERPRINT_BITS)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op6_rotated_codes_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approximate_nearest(table(spark, sf_dir, "embeddings"), NEAREST, NEAREST_EVERY)


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = hilbert_shards(table(spark, sf_dir, "documents"), SHARDS)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(table(spark, sf_dir, "documents"), REPEAT_WORDS)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = cut_documents(docs, public_tokenizers.path(BYTE_VOCABULARY), END_ID, SEQUENCE_TOKENS)
    digests = cut(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return pack(digests, SEQUENCE_TOKENS)


def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = score(docs, fit_model(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in LEAF_FIELDS]
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(TAMPERED_EVERY)) == 0
    lowered = [F.translate(c, ascii_uppercase, ascii_lowercase) if name == "text" else c for name, c in zip(LEAF_FIELDS, fields, strict=True)]
    claim = F.when(tampered, row_digest(lowered)).otherwise(row_digest(fields))
    proved = merkle_manifest(docs, row_digest(fields), claim, "lang", "doc_id")
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op12_threshold_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(table(spark, sf_dir, "documents"), MIX_SHARE, MIX_WEIGHTS, MIX_MOST)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def _planted(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of every tenth document, by the checksum of its id, repeated from some word on."""
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    chosen = (F.pmod(h, F.lit(PLANTED_EVERY)) == 0) & F.col("text").isNotNull()
    n, a, p = F.col("_n"), F.col("_a"), F.col("_p")
    docs = docs.select("doc_id", "text", F.when(chosen, words).alias("_words"), F.floor(h / PLANTED_EVERY).alias("_g")).withColumn("_n", F.size("_words"))
    docs = docs.withColumn("_a", F.when(n > 0, F.col("_g") % n)).withColumn("_p", F.floor((n - a) / (3 + F.col("_g") % 8)) + 1)
    period = F.slice("_words", (a + 1).cast("int"), p.cast("int"))
    tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
    whole = F.slice(F.concat(F.slice("_words", F.lit(1), a.cast("int")), tail), F.lit(1), n)
    return docs.select("doc_id", F.when(n > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_planted(table(spark, sf_dir, "documents")), RUN_WORDS)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    best = found.withColumn("_best", longest).withColumn("length", F.col("_best.length")).withColumn("period", -F.col("_best.col3"))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.col2")).alias("start"),
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece_codec": op1_sentencepiece_codec,
    "op2_cover_tree_topk": op2_cover_tree_topk,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_counts": op4_token_counts,
    "op5_simhash_groups": op5_simhash_groups,
    "op6_rotated_codes_ann": op6_rotated_codes_ann,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pattern_packing": op9_pattern_packing,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_threshold_mixture": op12_threshold_mixture,
    "op13_periodic_runs": op13_periodic_runs,
}

def _secrets_sql() -> str:
    """Matches and the gaps between them give the places of the matches, as in the operator; every rule scans every text."""
    parts = []
    for order, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT id, {order} AS ord, '{rule.kind}' AS kind, {rule.group} AS grp, {rule.least} AS least, '{pattern}' AS pattern,
         regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps
  FROM docs""")
    kinds = ", ".join(f"'{r.kind}'" for r in BASE)
    text = "string_agg({0}kind || ':' || a || ':' || b, ',' ORDER BY a, ord) FILTER (WHERE {1})"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(parts)}),
each AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches WHERE len(found) > 0),
placed AS (
  SELECT *, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0) AS BIGINT) AS a
  FROM each
  WHERE length(CASE WHEN grp = 0 THEN found[i] ELSE regexp_extract(found[i], '{BASE[0].pattern.replace("'", "''")}', 2) END) >= least
),
spans AS (SELECT id, ord, kind, a, a + length(found[i]) AS b FROM placed)
SELECT doc_id, {counts}, sha256(coalesce({text.format("", f"kind IN ({kinds})")}, '')) AS base_sha256,
       coalesce({text.format("", "kind IS NOT NULL")}, '') AS spans
FROM docs LEFT JOIN spans USING (id)
GROUP BY id, doc_id"""


def _merkle_sql() -> str:
    """Levels by recursion; a proof joins a leaf with the runs above it, and claims are folded level by level over whole runs."""

    def field(name: str) -> str:
        value = f"CAST({name} AS VARCHAR)"
        return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(text if f == "text" else field(f) for f in LEAF_FIELDS) + ")"

    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    # bit by bit: each byte of the decimal doc_id, then eight shifts
    crc = "list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], flatten([list_concat([CAST(ascii(c) AS UBIGINT)], repeat([CAST(256 AS UBIGINT)], 8)) for c in string_split(CAST(doc_id AS VARCHAR), '')])), lambda a, b: CASE WHEN b < 256 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"
    return f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS id, doc_id, lang, {digest(field("text"))} AS leaf,
         CASE WHEN xor({crc}, 4294967295) % {TAMPERED_EVERY} = 0 THEN {digest(field(lowered))} END AS other
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
up AS (
  SELECT lang, 0 AS level, pos AS idx, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8 FROM up WHERE n > 1 GROUP BY lang, level, idx // 8, n
),
subroots AS (SELECT lang, digest, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM up WHERE n = 1),
over_up AS (
  SELECT 0 AS level, pos AS idx, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8 FROM over_up WHERE n > 1 GROUP BY level, idx // 8, n
),
runs AS (
  SELECT p.id, u.level, u.idx, u.digest, u.idx = p.pos // CAST(8 ** u.level AS BIGINT) AS own
  FROM placed p JOIN up u ON p.lang IS NOT DISTINCT FROM u.lang AND u.n > 1 AND u.idx // 8 = p.pos // CAST(8 ** (u.level + 1) AS BIGINT)
  UNION ALL
  SELECT p.id, s.height + u.level, u.idx, u.digest, u.idx = s.pos // CAST(8 ** u.level AS BIGINT)
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN over_up u ON u.n > 1 AND u.idx // 8 = s.pos // CAST(8 ** (u.level + 1) AS BIGINT)
),
proofs AS (SELECT id, sha256(coalesce(string_agg(digest, '' ORDER BY level, idx) FILTER (WHERE NOT own), '')) AS proof_sha256 FROM runs GROUP BY id),
folds AS (
  SELECT id, 0 AS level, coalesce(other, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.id, f.level + 1, sha256(string_agg(CASE WHEN r.own THEN f.digest ELSE r.digest END, '' ORDER BY r.idx))
  FROM folds f JOIN runs r ON r.id = f.id AND r.level = f.level GROUP BY f.id, f.level
),
folded AS (SELECT id, arg_max(digest, level) AS folded_root FROM folds GROUP BY id)
SELECT p.doc_id, p.leaf, s.digest AS subroot, o.digest AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = o.digest AS verified
FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN over_up o ON o.n = 1 LEFT JOIN proofs q ON q.id = p.id JOIN folded f ON f.id = p.id"""


def _mixture_sql() -> str:
    """Targets from running sums over the sources in the order in which they stop, takings from running sums over keys."""
    (part, whole), most = MIX_SHARE, MIX_MOST
    weights = ", ".join(map(str, MIX_WEIGHTS))
    return f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(MIX_WEIGHTS)} + 1] AS HUGEINT) AS weight
  FROM docs GROUP BY source
),
stops AS (
  SELECT *, {part} * sum(source_size) OVER () - {whole * most} * coalesce(sum(source_size) OVER earlier, 0) AS num,
         {whole} * (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS den
  FROM sources
  WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT num, den FROM stops WHERE weight * num <= {most} * source_size * den ORDER BY source_size / weight LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN weight * l.num > {most} * source_size * l.den THEN CAST({most} * source_size AS DOUBLE)
              ELSE CAST(weight * l.num AS DOUBLE) / CAST(l.den AS DOUBLE) END AS target
  FROM sources, level l
),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM targets
),
running AS (
  SELECT doc_id, size, source_size, target, times, target - times * source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (times + CASE WHEN upto <= budget THEN 1 WHEN upto - size <= budget AND 2 * (budget - (upto - size)) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running"""


ORACLES: dict[str, str] = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_threshold_mixture": _mixture_sql(),
    "op2_cover_tree_topk": f"""
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({TOP_K_SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % {TOP_K_EVERY} = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {TOP_K}""",
    "op3_secret_scan": _secrets_sql(),
    # windows of REPEAT_WORDS = 20 words are put together from windows of 2, 4 and 8
    "op8_substring_dedup": f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
of2 AS (SELECT *, word || ' ' || lead(word) OVER o AS w2 FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
of4 AS (SELECT *, w2 || ' ' || lead(w2, 2) OVER o AS w4 FROM of2 WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
of8 AS (SELECT *, w4 || ' ' || lead(w4, 4) OVER o AS w8 FROM of4 WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
of20 AS (
  SELECT doc_id, place AS s, w8 || ' ' || lead(w8, 8) OVER o || ' ' || lead(w4, 16) OVER o AS w20 FROM of8
  WINDOW o AS (PARTITION BY doc_id ORDER BY place)
),
again AS (
  SELECT doc_id, s FROM of20 WHERE w20 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY w20 ORDER BY doc_id, s) > 1
),
gone AS (SELECT DISTINCT doc_id, s + k AS place FROM again, range({REPEAT_WORDS}) AS r(k)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)""",
}
