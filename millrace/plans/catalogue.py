"""Registered queries of the engine's own operators, with their DuckDB twins.

Documents map to rows as _ord = doc_id, title = source, body = text. The twins spell regular expressions for RE2, whose
classes are ASCII; on these tables both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import canonical, pii, simhash, text
from millrace.operators import dedup, quality
from millrace.operators.filtering import filter_rows, reason_counts
from millrace.operators.staging import new_path, spread, staged
from millrace.plans.config import FilterConfig, NearConfig, OutputConfig, QualityConfig, RunConfig
from millrace.plans.pipeline import ledger
from millrace.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

FILTER = FilterConfig(min_body_chars=100, max_body_chars=20_000, enable_pii_redaction=True, boilerplate_patterns=(r"https?://[^ ]+",))
NEAR_MD5 = NearConfig(simhash="md5")

# Fragments of the twins. Patterns whose results must match the engine's own.
_CONTROL = r"[\x00-\x08\x0B-\x1F\x7F]"
_EMAIL = r"\b[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}\b"
_PHONE = r"\b(?:\+?\d{1,3}[\s.\-]?)?(?:\(?\d{2,4}\)?[\s.\-]?)?\d{3,4}[\s.\-]?\d{4}\b"
_IPV4 = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"


def _norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '{_CONTROL}', ' ', 'g'), '\s+', ' ', 'g'))"


def _redact(x: str) -> str:
    for pattern, mark in ((_EMAIL, "EMAIL_ADDRESS"), (_PHONE, "PHONE_NUMBER"), (_IPV4, "IP_ADDRESS")):
        x = f"regexp_replace({x}, '{pattern}', '<{mark}>', 'g')"
    return x


def _contains(x: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({x}, '{p}')" for p in (_EMAIL, _PHONE, _IPV4)) + ")"


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(readers.read_documents(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# Scalar functions.


@query("strip_control", rf"SELECT doc_id, regexp_replace(text, '{_CONTROL}', ' ', 'g') AS cleaned FROM documents")
def strip_control(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.strip_control("text").alias("cleaned"))


@query("collapse_space", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS cleaned FROM documents")
def collapse_space(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.collapse_space("text").alias("cleaned"))


@query("normalize_text", f"SELECT doc_id, {_norm('text')} AS cleaned FROM documents")
def normalize_text(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.normalize_text("text").alias("cleaned"))


@query("html_strip_pages", f"""SELECT page_id, {_norm("regexp_replace(html, '<[^>]+>', ' ', 'g')")} AS body FROM pages""")
def html_strip_pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", text.normalize_text(text.strip_tags("html")).alias("body"))


_WIKI = "'[[' || source || '|' || lang || ']] ''''''' || text || ''''''' {{cite|x}} [' || doc_id || '] <b>' || source || '</b> [[' || lang || ']]'"


@query("wiki_fallback", "WITH t AS (SELECT doc_id, " + _WIKI + r""" AS w FROM documents)
SELECT doc_id, """ + _norm(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(w, '\[\[(?:[^|\]]+\|([^\]]+)|([^|\]]+))\]\]', '\1\2', 'g'), '''''''', ''), '''''', ''), '\{\{[^{}]*\}\}', ' ', 'g'), '\{\|[^{}]*\|\}', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\[[0-9]+\]', ' ', 'g'), '<[^>]+>', ' ', 'g')") + " AS body FROM t")
def wiki_fallback(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    w = F.concat(F.lit("[["), "source", F.lit("|"), "lang", F.lit("]] '''"), "text", F.lit("''' {{cite|x}} ["), F.col("doc_id").cast("string"), F.lit("] <b>"), "source", F.lit("</b> [["), "lang", F.lit("]]"))
    return d.select("doc_id", text.wikitext_to_text(w).alias("body"))


@query("wiki_url", r"""SELECT doc_id, 'https://en.wikipedia.org/wiki/' || replace(replace(replace(replace(replace(replace(replace(
  url_encode(replace(source || ': ' || text, ' ', '_')), '%3A', ':'), '%2F', '/'), '%3F', '?'), '%26', '&'), '%3D', '='), '%23', '#'), '%25', '%') AS url FROM documents""")
def wiki_url(spark, sf_dir):
    """Source and whole text stand for a title, so that all of a text's characters are tried."""
    return _table(spark, sf_dir, "documents").select("doc_id", text.wiki_url(F.concat("source", F.lit(": "), "text")).alias("url"))


@query("pii_detect", f"SELECT doc_id, {_contains('text')} AS found FROM documents")
def pii_detect(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", pii.contains(F.col("text")).alias("found"))


@query("pii_redact", f"SELECT doc_id, {_redact('text')} AS redacted FROM documents")
def pii_redact(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", pii.redact(F.col("text")).alias("redacted"))


@query("pii_kinds", f"""WITH r AS (SELECT text, {_redact('text')} AS t FROM documents)
SELECT sum(len(regexp_extract_all(t, '<EMAIL_ADDRESS>')) - len(regexp_extract_all(text, '<EMAIL_ADDRESS>')))::BIGINT AS emails,
  sum(len(regexp_extract_all(t, '<PHONE_NUMBER>')) - len(regexp_extract_all(text, '<PHONE_NUMBER>')))::BIGINT AS phones,
  sum(len(regexp_extract_all(t, '<IP_ADDRESS>')) - len(regexp_extract_all(text, '<IP_ADDRESS>')))::BIGINT AS addresses FROM r""")
def pii_kinds(spark, sf_dir):
    c = pii.counts(F.col("text"))
    d = _table(spark, sf_dir, "documents").select(*[c[m].alias(n) for m, n in (("<EMAIL_ADDRESS>", "emails"), ("<PHONE_NUMBER>", "phones"), ("<IP_ADDRESS>", "addresses"))])
    return d.agg(*[F.sum(n).cast("long").alias(n) for n in d.columns])


@query("canonical_hash", f"SELECT doc_id, sha256(concat_ws(chr(10), nullif({_norm('source')}, ''), nullif({_norm('text')}, ''))) AS canonical_hash FROM documents")
def canonical_hash(spark, sf_dir):
    c = canonical.canonical_text([F.col("source"), F.col("text")])
    return _table(spark, sf_dir, "documents").select("doc_id", canonical.canonical_hash(c).alias("canonical_hash"))


# Sources.


@query("parse_tsv", r"""WITH l AS (SELECT doc_id AS n, CASE WHEN doc_id % 17 = 0 THEN source || chr(9) || lang ELSE concat_ws(chr(9), doc_id, 'http://x/' || source, lang, replace(text, chr(10), chr(9))) END AS line FROM documents)
SELECT n, string_split(line, chr(9))[1] AS doc_id, string_split(line, chr(9))[2] AS url, string_split(line, chr(9))[3] AS title, array_to_string(string_split(line, chr(9))[4:], chr(9)) AS body
FROM l WHERE len(string_split(line, chr(9))) >= 4""")
def parse_tsv(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    line = F.when(F.col("doc_id") % 17 == 0, F.concat_ws("\t", "source", "lang")).otherwise(F.concat_ws("\t", F.col("doc_id").cast("string"), F.concat(F.lit("http://x/"), "source"), "lang", F.translate("text", "\n", "\t")))
    return d.select(F.col("doc_id").alias("n"), readers.parse_tsv(line).alias("d")).where("d IS NOT NULL").select("n", "d.*")


@query("parse_labelled", r"""WITH l AS (SELECT doc_id, quality, CASE WHEN doc_id % 5 = 0 THEN ' ' || quality ELSE '__label__' || quality || ' ' || text || ' ' END AS line FROM documents JOIN labels USING (doc_id)),
s AS MATERIALIZED (SELECT doc_id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t FROM l)
SELECT doc_id, string_split(t, ' ')[1] AS label, substr(t, instr(t, ' ') + 1) AS body FROM s WHERE instr(t, ' ') > 0""")
def parse_labelled(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id")
    q = F.col("quality").cast("string")
    line = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit(" "), q)).otherwise(F.concat(F.lit("__label__"), q, F.lit(" "), "text", F.lit(" ")))
    return d.select("doc_id", readers.parse_labelled(line).alias("s")).where("s IS NOT NULL").select("doc_id", "s.label", F.col("s.text").alias("body"))


@query("clean_tsv_docs", f"SELECT doc_id::VARCHAR AS doc_id, '' AS url, {_norm('source')} AS title, {_norm('text')} AS body, 'msmarco' AS source, 'docs' AS version FROM documents")
def clean_tsv_docs(spark, sf_dir):
    return readers.clean_tsv(_docs(spark, sf_dir)).drop("_ord")


@query("clean_wiki_docs", rf"""SELECT doc_id::VARCHAR AS id, {_norm('source')} AS title, {_norm(r"regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\[[0-9]+\]', ' ', 'g'), '<[^>]+>', ' ', 'g')")} AS body,
  'https://en.wikipedia.org/wiki/' || source AS url, 'wikipedia' AS source, 'latest' AS dump_date FROM documents WHERE length({_norm('text')}) >= 20""")
def clean_wiki_docs(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_ord"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), "text")
    return readers.clean_wiki(d, min_body_chars=20).where("drop_reason IS NULL").drop("_ord", "drop_reason")


def _dump(spark, sf_dir):
    """Path of a dump that the XML writer makes of all documents; XML has no place for control characters."""
    d = _table(spark, sf_dir, "documents")
    page = d.select(F.col("source").alias("title"), F.lit("0").alias("ns"), F.col("doc_id").cast("string").alias("id"), F.struct(text.strip_control("text").alias("text")).alias("revision"))
    path = new_path(spark, "xml")
    page.write.option("rootTag", "mediawiki").option("rowTag", "page").format("xml").save(path)
    return path


@query("xml_pages", f"SELECT doc_id::VARCHAR AS id, source AS title, regexp_replace(text, '{_CONTROL}', ' ', 'g') AS text FROM documents WHERE trim(regexp_replace(text, '{_CONTROL}', ' ', 'g')) <> ''")
def xml_pages(spark, sf_dir):
    """Every document written as a page of a dump and read back by the XML source."""
    return readers.read_pages(spark, _dump(spark, sf_dir)).drop("_ord")


@query("resume_skip_limit", f"SELECT doc_id AS _ord, {_norm('text')} AS body FROM documents WHERE doc_id >= 100 AND doc_id < 400")
def resume_skip_limit(spark, sf_dir):
    """The feature itself: skipping committed rows and a row budget."""
    d = readers.skip_and_limit(_docs(spark, sf_dir), 100, 300)
    return d.select("_ord", text.normalize_text("body").alias("body"))


# The filter.

_FILTERED = rf"""n AS (SELECT doc_id AS _ord, {_norm('source')} AS title, {_norm("regexp_replace(" + _norm('text') + ", 'https?://[^ ]+', ' ', 'g')")} AS body FROM documents),
f AS (SELECT _ord, {_contains('title')} OR {_contains('body')} AS found, body AS seen, {_redact('title')} AS title, {_redact('body')} AS body FROM n),
filtered AS MATERIALIZED (SELECT _ord, title, body, CASE WHEN seen = '' THEN 'empty_body' WHEN length(body) < 100 THEN 'too_short' WHEN length(body) > 20000 THEN 'too_long' END AS drop_reason,
  sha256({_norm('body')}) AS canonical_hash, {_norm('body')} AS canonical_text, found, seen FROM f)"""


@query("filter_kept", f"WITH {_FILTERED} SELECT _ord, title, body, canonical_hash FROM filtered WHERE drop_reason IS NULL")
def filter_kept(spark, sf_dir):
    return filter_rows(_docs(spark, sf_dir), FILTER).where("drop_reason IS NULL").select("_ord", "title", "body", "canonical_hash")


@query("filter_reasons", f"WITH {_FILTERED} SELECT drop_reason, count(*) AS rows FROM filtered GROUP BY 1")
def filter_reasons(spark, sf_dir):
    return reason_counts(filter_rows(_docs(spark, sf_dir), FILTER))


@query("pii_block", f"WITH {_FILTERED} SELECT _ord, CASE WHEN seen = '' THEN 'empty_body' WHEN found THEN 'pii_blocked' ELSE drop_reason END AS drop_reason FROM filtered")
def pii_block(spark, sf_dir):
    return filter_rows(_docs(spark, sf_dir), replace(FILTER, pii_block_on_match=True)).select("_ord", "drop_reason")


@query("filter_disabled", f"SELECT doc_id AS _ord, text AS body, sha256({_norm('text')}) AS canonical_hash FROM documents")
def filter_disabled(spark, sf_dir):
    return filter_rows(_docs(spark, sf_dir), FilterConfig(enabled=False)).select("_ord", "body", "canonical_hash")


# Dedup.


def _canonical(spark, sf_dir):
    return _docs(spark, sf_dir).select("_ord", text.normalize_text("body").alias("canonical_text")).withColumn("canonical_hash", canonical.canonical_hash(F.col("canonical_text")))


@query("exact_dedup", f"SELECT min(doc_id) AS _ord, sha256({_norm('text')}) AS canonical_hash FROM documents GROUP BY 2")
def exact_dedup(spark, sf_dir):
    return dedup.exact_kept(_canonical(spark, sf_dir).select("_ord", "canonical_hash")).select("_ord", "canonical_hash")


@query("exact_dup_groups", f"SELECT sha256({_norm('text')}) AS canonical_hash, count(*) AS copies, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    g = _canonical(spark, sf_dir).groupBy("canonical_hash").agg(F.count(F.lit(1)).alias("copies"), F.min("_ord").alias("first"))
    return g.where("copies > 1")


_MD5 = rf"""t AS (SELECT doc_id, unnest(string_split({_norm('text')}, ' ')) AS w FROM documents),
h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM t WHERE w <> ''),
b AS (SELECT doc_id, i, count(*) AS n, sum(((h >> i) & 1)::INT) AS ones FROM h, range(64) r(i) GROUP BY 1, 2),
fp AS (SELECT doc_id, sum(CASE WHEN 2 * ones >= n THEN (1::HUGEINT << i::INT) ELSE 0 END) AS u FROM b GROUP BY 1),
s AS MATERIALIZED (SELECT d.doc_id, (CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE coalesce(u, 0) END)::BIGINT AS fp FROM documents d LEFT JOIN fp USING (doc_id))"""


@query("simhash_md5", f"WITH {_MD5} SELECT doc_id AS _ord, fp FROM s")
def simhash_md5(spark, sf_dir):
    return dedup.fingerprints(_canonical(spark, sf_dir), NEAR_MD5).select("_ord", "fp")


@query("simhash_blake2b")
def simhash_blake2b(spark, sf_dir):
    return dedup.fingerprints(_canonical(spark, sf_dir)).select("_ord", "fp")


@query("lsh_bands", f"WITH {_MD5} SELECT doc_id AS _ord, i::INT AS band, ((fp >> (16 * i)::INT) & 65535)::BIGINT AS segment FROM s, range(4) r(i)")
def lsh_bands(spark, sf_dir):
    f = dedup.fingerprints(_canonical(spark, sf_dir), NEAR_MD5)
    return f.select("_ord", F.inline(simhash.bands(F.col("fp"))))


_FIRST = "g AS MATERIALIZED (SELECT fp, min(doc_id) AS _ord FROM s GROUP BY fp)"


def _first_fps(spark, sf_dir):
    return dedup.fingerprints(_canonical(spark, sf_dir), NEAR_MD5).groupBy("fp").agg(F.min("_ord").alias("_ord"))


@query("near_pairs", f"WITH {_MD5}, {_FIRST} SELECT a._ord AS lo, b._ord AS hi FROM g a JOIN g b ON a._ord < b._ord AND bit_count(xor(a.fp, b.fp)) <= 3")
def near_pairs(spark, sf_dir):
    return dedup.near_pairs(staged(_first_fps(spark, sf_dir), "fps"), NEAR_MD5)


_GREEDY = """o AS MATERIALIZED (SELECT fp, _ord, row_number() OVER (ORDER BY _ord) AS k FROM g),
walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS kept, []::BIGINT[] AS ids
  UNION ALL SELECT o.k, CASE WHEN len(list_filter(kept, lambda x: bit_count(xor(x, o.fp)) <= 3)) = 0 THEN list_append(kept, o.fp) ELSE kept END,
    CASE WHEN len(list_filter(kept, lambda x: bit_count(xor(x, o.fp)) <= 3)) = 0 THEN list_append(ids, o._ord) ELSE ids END FROM walk JOIN o ON o.k = walk.k + 1)"""


@query("near_dedup_greedy", f"WITH RECURSIVE {_MD5}, {_FIRST}, {_GREEDY} SELECT unnest(ids) AS _ord FROM (SELECT ids FROM walk ORDER BY k DESC LIMIT 1)")
def near_dedup_greedy(spark, sf_dir):
    f = staged(dedup.fingerprints(_canonical(spark, sf_dir), NEAR_MD5).select("_ord", "fp"), "fps")
    return f.join(dedup.near_duplicates(f, NEAR_MD5), "_ord", "left_anti").select("_ord")


@query("near_dedup_blake2b")
def near_dedup_blake2b(spark, sf_dir):
    f = staged(dedup.fingerprints(_canonical(spark, sf_dir)).select("_ord", "fp"), "fps")
    return f.join(dedup.near_duplicates(f), "_ord", "left_anti").select("_ord")


@query("incremental_dedup", f"SELECT min(doc_id) AS _ord FROM documents GROUP BY sha256({_norm('text')})")
def incremental_dedup(spark, sf_dir):
    """Two runs, the second against the first one's index, keep what one run keeps."""
    c = staged(_canonical(spark, sf_dir).select("_ord", "canonical_hash"), "hashes")
    middle = c.agg(F.percentile_approx("_ord", 0.5)).first()[0] or 0
    first, second = c.where(F.col("_ord") <= middle), c.where(F.col("_ord") > middle)
    one = first.join(dedup.exact_duplicates(first), "_ord", "left_anti")
    two = second.join(dedup.exact_duplicates(second, dedup.checked_index(one.select("canonical_hash"))), "_ord", "left_anti")
    return one.unionByName(two).select("_ord")


# Quality.

_SCORE = rf"""c AS (SELECT doc_id AS _ord, {_norm('text')} AS t FROM documents),
w AS (SELECT _ord, t, list_filter(string_split(t, ' '), lambda x: x <> '') AS ws FROM c),
q AS (SELECT _ord, CASE WHEN len(ws) = 0 THEN 0.0 ELSE (length(regexp_replace(t, '[^A-Za-z]', '', 'g'))::DOUBLE / length(t) + len(list_filter(ws, lambda x: length(x) BETWEEN 2 AND 12))::DOUBLE / len(ws)
  + len(list_distinct(ws))::DOUBLE / len(ws) + least(len(ws) / 50.0::DOUBLE, 1.0)) / 4 END AS score FROM w)"""


def _scores(spark, sf_dir):
    return quality.scored(_canonical(spark, sf_dir), QualityConfig(enabled=True), quality.HeuristicModel()).select("_ord", "quality_score")


@query("quality_score", f"WITH {_SCORE} SELECT _ord, round(score, 6) AS score FROM q")
def quality_score(spark, sf_dir):
    return _scores(spark, sf_dir).select("_ord", F.round("quality_score", 6).alias("score"))


@query("quality_filter", f"WITH {_SCORE} SELECT _ord FROM q WHERE score >= 0.75")
def quality_filter(spark, sf_dir):
    return _scores(spark, sf_dir).where("quality_score >= 0.75").select("_ord")


@query("quality_stats", f"""WITH {_SCORE}, s AS (SELECT round(score, 6) AS score, row_number() OVER (ORDER BY _ord) AS k FROM q)
SELECT count(*) AS count, round(sum(score), 4) AS sum, round(avg(score), 6) AS mean, min(score) AS min, max(score) AS max,
  round(quantile_cont(score, 0.1) FILTER (k <= 50000), 6) AS p10, round(quantile_cont(score, 0.5) FILTER (k <= 50000), 6) AS p50, round(quantile_cont(score, 0.9) FILTER (k <= 50000), 6) AS p90 FROM s""")
def quality_stats(spark, sf_dir):
    s = quality.score_stats(_scores(spark, sf_dir).withColumn("quality_score", F.round("quality_score", 6)))
    return s.select("count", F.round("sum", 4).alias("sum"), F.round("mean", 6).alias("mean"), "min", "max", *[F.round(p, 6).alias(p) for p in ("p10", "p50", "p90")])


@query("calibrate_threshold", f"""WITH {_SCORE}, s AS (SELECT floor(score * 100 + 1e-9) AS cell, quality AS y FROM q JOIN labels ON _ord = doc_id),
g AS (SELECT t, sum((cell >= t AND y = 1)::INT) AS tp, sum((cell >= t AND y <> 1)::INT) AS fp, sum((cell < t AND y = 1)::INT) AS fn FROM s, range(5, 96) r(t) GROUP BY t),
p AS (SELECT t, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM g),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM p)
SELECT t / 100 AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM f ORDER BY round(f1, 12) DESC, t LIMIT 1""")
def calibrate_threshold(spark, sf_dir):
    y = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_ord"), F.col("quality").alias("label"))
    c = quality.calibrate(_scores(spark, sf_dir).withColumnRenamed("quality_score", "score").join(y, "_ord"))
    return c.select("threshold", *[F.round(x, 9).alias(x) for x in ("precision", "recall", "f1")])


@query("train_quality")
def train_quality(spark, sf_dir):
    """A linear model trained on the labels scores all documents."""
    c = _canonical(spark, sf_dir)
    y = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_ord"), F.col("quality").cast("double").alias("label"))
    model = quality.LinearModel.train(c.join(y, "_ord").select(F.col("canonical_text").alias("text"), "label"))
    return quality.scored(c, QualityConfig(enabled=True), model).select("_ord", "quality_score")


# The whole plan.

PLAN = RunConfig(filtering=FILTER, near=NEAR_MD5, quality=QualityConfig(enabled=True, min_score=0.75))

_PLAN = rf"""{_FILTERED},
x AS (SELECT *, row_number() OVER (PARTITION BY canonical_hash ORDER BY _ord) AS copy FROM filtered WHERE drop_reason IS NULL),
e AS MATERIALIZED (SELECT * FROM x WHERE copy = 1),
t AS (SELECT _ord, unnest(string_split(canonical_text, ' ')) AS w FROM e),
h AS (SELECT _ord, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM t WHERE w <> ''),
b AS (SELECT _ord, i, count(*) AS n, sum(((h >> i) & 1)::INT) AS ones FROM h, range(64) r(i) GROUP BY 1, 2),
u AS (SELECT _ord, sum(CASE WHEN 2 * ones >= n THEN (1::HUGEINT << i::INT) ELSE 0 END) AS u FROM b GROUP BY 1),
s AS MATERIALIZED (SELECT _ord, (CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END)::BIGINT AS fp FROM u),
g AS MATERIALIZED (SELECT fp, min(_ord) AS _ord FROM s GROUP BY fp), {_GREEDY},
k AS MATERIALIZED (SELECT unnest(ids) AS _ord FROM (SELECT ids FROM walk ORDER BY k DESC LIMIT 1)),
w AS (SELECT _ord, canonical_text AS t, list_filter(string_split(canonical_text, ' '), lambda x: x <> '') AS ws FROM e JOIN k USING (_ord)),
q AS (SELECT _ord, CASE WHEN len(ws) = 0 THEN 0.0 ELSE (length(regexp_replace(t, '[^A-Za-z]', '', 'g'))::DOUBLE / length(t) + len(list_filter(ws, lambda x: length(x) BETWEEN 2 AND 12))::DOUBLE / len(ws)
  + len(list_distinct(ws))::DOUBLE / len(ws) + least(len(ws) / 50.0::DOUBLE, 1.0)) / 4 END AS score FROM w),
book AS (SELECT f._ord, CASE WHEN f.drop_reason IS NOT NULL THEN f.drop_reason WHEN e._ord IS NULL THEN 'exact_duplicate' WHEN q._ord IS NULL THEN 'near_duplicate' WHEN q.score < 0.75 THEN 'low_quality' END AS drop_reason, f.canonical_hash
  FROM filtered f LEFT JOIN e ON e._ord = f._ord LEFT JOIN q ON q._ord = f._ord)"""


def plan_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(_docs(spark, sf_dir), PLAN, quality.HeuristicModel())


@query("pipeline_ledger", f"WITH RECURSIVE {_PLAN} SELECT _ord, drop_reason, canonical_hash FROM book")
def pipeline_ledger(spark, sf_dir):
    return plan_ledger(spark, sf_dir).select("_ord", "drop_reason", "canonical_hash")


@query("drop_reason_summary", f"WITH RECURSIVE {_PLAN} SELECT drop_reason, count(*) AS rows FROM book GROUP BY 1")
def drop_reason_summary(spark, sf_dir):
    return reason_counts(plan_ledger(spark, sf_dir))


@query("shard_manifest", f"WITH {_FILTERED}, r AS (SELECT row_number() OVER (ORDER BY _ord) AS rn FROM filtered WHERE drop_reason IS NULL) SELECT ((rn - 1) // 128)::INT AS shard_id, printf('docs-%05d.parquet', (rn - 1) // 128) AS name, count(*) AS num_rows FROM r GROUP BY ALL")
def shard_manifest(spark, sf_dir):
    kept = filter_rows(_docs(spark, sf_dir), FILTER).where("drop_reason IS NULL").select("_ord")
    return sinks.shard_manifest(staged(kept, "kept"), OutputConfig(shard_rows=128, prefix="docs"))


@query("streaming_dedup", f"SELECT min(doc_id) AS _ord, sha256({_norm('text')}) AS canonical_hash FROM documents GROUP BY 2")
def streaming_dedup(spark, sf_dir):
    """Exact dedup over a stream whose files come in input order: each run of the stream takes the files that have come since the last as one
    micro-batch, which is joined with what was kept before. So a micro-batch has as many files as the scan has tasks."""
    from millrace.streaming import incremental

    base = new_path(spark, "stream")
    rows = readers.read_documents(spark, sf_dir)
    lo, hi = rows.agg(F.min("_ord"), F.max("_ord")).first()
    step = 1 if lo is None else (hi - lo) // 3 + 1
    config = RunConfig(filtering=FilterConfig(enabled=False), near=NearConfig(enabled=False))
    for k in range(3):
        part = rows if lo is None else rows.where((F.col("_ord") >= lo + k * step) & (F.col("_ord") < lo + (k + 1) * step))
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        incremental.start(stream, f"{base}/out", f"{base}/checkpoint", config).awaitTermination()
    return incremental.results(spark, f"{base}/out").where("drop_reason IS NULL").select("_ord", "canonical_hash")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_ledger(spark, sf_dir).where("drop_reason IS NULL").select("_ord", "doc_id", "title", "body", "canonical_hash", "quality_score")
