"""The registered opN_ queries and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import brown, chat, decontaminate, html, minhash, mixing, neighbours, quality, secrets, toxicity
from millrace.llm.common import bucket_of, table


def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = brown.fit(docs.where(~brown.held_out(F.col("doc_id"))).select("text"))
    return brown.score(docs, model).withColumn("held_out", brown.held_out(F.col("doc_id")))


def op2_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


#: The exact neighbours. On the small tables the graph finds them all; on larger ones its recall is measured in the tests.
OP2_SQL = r"""
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank, vec_id, score FROM d
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), F.col("src").alias("source"), "rate", "copies")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["ord"] == k)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.joined("base").cast("binary"), 256).alias("base_sha256"), secrets.joined("spans").alias("spans"),
    )


#: A conversation whose texts hold the template's own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return chat.read_back(chat.windows(turns.unionByName(extra)))


OP6_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT conv_id, turn, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
    4 + length(role) + 2 + length(replace(replace(replace(text, '\', '\\'), '#', '\h'), '</turn>', '\l/turn>')) + 8 AS chars FROM t
), p AS (
  SELECT *, row_number() OVER w AS idx, (sum(tokens) OVER w - tokens) // 32768 AS block, first_value(role) OVER w = 'system' AND row_number() OVER w > 1 AS sys,
    first_value(tokens) OVER w AS t0, first_value(chars) OVER w AS c0, lag(tokens, 1) OVER w AS t1, lag(chars, 1) OVER w AS c1, lag(tokens, 2) OVER w AS t2, lag(chars, 2) OVER w AS c2
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), h AS (
  SELECT *, coalesce(t1 <= 512 AND NOT (sys AND idx = 2), false) AS h1, coalesce(t1 + t2 <= 512 AND NOT (sys AND idx <= 3), false) AS h2, sys AND t0 <= 1024 AS s FROM p
), v AS (
  SELECT *, CASE WHEN s THEN t0 ELSE 0 END AS st, CASE WHEN s THEN c0 ELSE 0 END AS sc,
    CASE WHEN h2 THEN t1 + t2 WHEN h1 THEN t1 ELSE 0 END AS ht, CASE WHEN h2 THEN c1 + c2 WHEN h1 THEN c1 ELSE 0 END AS hc FROM h
), r AS MATERIALIZED (
  SELECT conv_id, idx, block, role, text, tokens, chars, CASE WHEN tokens + st + ht <= 2048 THEN st + ht WHEN tokens + st <= 2048 THEN st ELSE 0 END AS rt,
    CASE WHEN tokens + st + ht <= 2048 THEN sc + hc WHEN tokens + st <= 2048 THEN sc ELSE 0 END AS rc FROM v
), walk AS (
  SELECT conv_id, idx, block, rt + tokens AS used, chars + rc AS total FROM r WHERE idx = 1
  UNION ALL SELECT r.conv_id, r.idx, r.block, CASE WHEN r.block <> walk.block OR walk.used + r.tokens > 2048 THEN r.rt ELSE walk.used END + r.tokens,
    r.chars + CASE WHEN r.block <> walk.block OR walk.used + r.tokens > 2048 THEN r.rc ELSE 0 END
  FROM walk JOIN r ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.idx = walk.idx + 1
)
SELECT r.conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY r.idx)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY r.idx) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(total)::BIGINT AS formatted_chars
FROM r JOIN walk ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.idx = walk.idx GROUP BY r.conv_id
"""


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = quality.features(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.score(feats, quality.train(feats))


def op10_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = bucket_of(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 5)
    model = [tuple(r) for r in toxicity.train(docs, labels.where(fold != 0)).collect()]
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, list_sort(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS sh FROM w
), x AS MATERIALIZED (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS MATERIALIZED (
  SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c) UNION ALL SELECT b, a FROM p WHERE 100 * c >= 75 * (na + nb - c)
), reach AS (
  SELECT doc_id AS d, doc_id AS r FROM s UNION SELECT reach.d, e.b FROM reach JOIN e ON e.a = reach.r
), c AS (
  SELECT d, min(r) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept,
  CASE WHEN len(sh) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY sh) END AS class_id
FROM s JOIN c ON c.d = s.doc_id
"""

def _op5_sql() -> str:
    """The scan in SQL. RE2 folds case by Unicode, so letters are spelled out; windows count their characters anew."""
    word = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    names = "|".join(map(word, ("password", "passwd", "secret", "token"))) + "|" + word("api") + "_?" + word("key")
    assign = rf"""(?:{names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    run = "[A-Za-z0-9+/_=-]{20,}"
    allow = secrets.EntropyRule().allow.replace("'", "''")
    total = lambda xs, to: f"coalesce(list_sum(list_transform({xs}[1:{to}], lambda y: length(y))), 0)"

    def found(kind: int, pattern: str, group: int) -> str:
        at = f"({total('g', 'i')} + {total('h', 'i - 1')})"
        return (
            f"SELECT doc_id, {kind} AS ord, unnest(list_transform(range(1, len(h) + 1), lambda i: {{'start': {at}, 'hit': h[i], 'grp': r[i]}}), recursive := true) FROM "
            f"(SELECT doc_id, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS h, regexp_extract_all(t, '{pattern}', {group}) AS r FROM d)"
        )

    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({found(0, assign, 1)} UNION ALL {found(1, 'AKIA[A-Z0-9]{12,}', 0)} UNION ALL {found(2, '[0-9a-f]{32,}', 0)}),
base AS (SELECT doc_id, ord, start, start + length(hit) AS stop FROM a WHERE ord <> 0 OR length(grp) >= 8),
c AS ({found(3, run, 0)}),
k AS (SELECT doc_id, start, hit, CASE WHEN regexp_full_match(hit, '[0-9a-fA-F]+') THEN 3.0 WHEN regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') THEN 3.8 ELSE 3.6 END AS bits
  FROM c WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT regexp_matches(hit, '{allow}')),
v AS (SELECT doc_id, start, hit, bits, i, string_split(substr(hit, i, 20), '') AS cs FROM (SELECT *, unnest(range(1, length(hit) - 18)) AS i FROM k)),
e AS (SELECT doc_id, start, hit, i FROM v WHERE list_sum(list_transform(list_distinct(cs), lambda x: -(len(list_filter(cs, lambda y: y = x)) / 20) * log2(len(list_filter(cs, lambda y: y = x)) / 20))) >= bits),
h AS (SELECT doc_id, start + min(i) - 1 AS start, start + max(i) + 19 AS stop FROM e GROUP BY doc_id, e.start, hit),
n AS (SELECT h.doc_id, 3 AS ord, h.start, h.stop FROM h WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = h.doc_id AND b.start <= h.start AND h.stop <= b.stop)),
s AS (SELECT doc_id, ord, start, ['assign', 'access', 'hex', 'entropy'][ord + 1] || ':' || start || ':' || stop AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM n))
SELECT d.doc_id, count(s.span) FILTER (s.ord = 0) AS n_assign, count(s.span) FILTER (s.ord = 1) AS n_access, count(s.span) FILTER (s.ord = 2) AS n_hex,
  sha256(coalesce(string_agg(s.span, ',' ORDER BY s.start, s.ord) FILTER (s.ord < 3), '')) AS base_sha256, coalesce(string_agg(s.span, ',' ORDER BY s.start, s.ord), '') AS spans
FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


QUERIES = {"op1_brown_lm": op1_brown_lm, "op2_hnsw_neighbours": op2_hnsw_neighbours, "op7_html_main_text": op7_html_main_text, "op9_quality_cotraining": op9_quality_cotraining, "op10_toxicity_ftrl": op10_toxicity_ftrl, "op8_benchmark_leaks": op8_benchmark_leaks, "op4_minhash_dedup": op4_minhash_dedup, "op3_source_mix": op3_source_mix, "op5_secret_scan": op5_secret_scan, "op6_chat_windows": op6_chat_windows}
ORACLES: dict[str, str] = {"op2_hnsw_neighbours": OP2_SQL, "op4_minhash_dedup": OP4_SQL, "op5_secret_scan": _op5_sql(), "op6_chat_windows": OP6_SQL}
