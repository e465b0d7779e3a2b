"""Readers: wiki XML dumps, tab-separated documents, labelled samples and Parquet tables.

Every reader assigns ``_ord``, the input order, before any shuffle. File readers use the engine's increasing ids:
ordered, with gaps between partitions; ``dense_order`` closes the gaps where counts of rows matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import normalize_text, parsed_wikitext, strip_space, wiki_url
from millrace.operators.filtering import CLEANER_DROPPED, MALFORMED
from millrace.operators.staging import staged
from millrace.plans.config import malformed_policy
from millrace.plans.state import chunk_size

# Repeated revisions: the first counts, which only an array keeps apart.
PAGE = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("ns", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
    T.StructField("revision", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
])


def with_order(df: DataFrame) -> DataFrame:
    return df.withColumn("_ord", F.monotonically_increasing_id())


def dense_order(df: DataFrame) -> DataFrame:
    """_ord becomes 0, 1, 2, ...: rows are counted by partition of origin, and offsets added; no global sort.

    df must have _ord from ``with_order``, whose upper bits are the partition. Counts come from staged ids, so a
    second scan agrees with the first.
    """
    part = F.shiftright("_ord", 33)
    sizes = staged(df.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.min("_ord").alias("__least")), "sizes")
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy("_ord"))
    return df.withColumn("__part", part).withColumn("__rank", rank).join(offsets, "__part").withColumn("_ord", F.col("__before") + F.col("__rank") - 1).drop("__part", "__rank", "__before")


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """_ord, is_malformed, title, ns, id, redirect, revision of every page of a dump, plain or compressed.

    The file is cut at page ends, so large files are split among tasks, a dump needs no root element, and markup that
    is broken (unclosed elements, characters that XML forbids) makes one malformed row, not the end of the scan.
    """
    records = spark.read.option("lineSep", "</page>").text(path)
    records = with_order(records).withColumn("__at", F.regexp_instr(F.col("value"), F.lit(r"<page[\s>/]")))
    xml = F.concat(F.col("value").substr(F.col("__at"), F.length("value")), F.lit("</page>"))
    bad = "__bad"
    schema = T.StructType([*PAGE.fields, T.StructField(bad, T.StringType())])
    page = F.from_xml(xml, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "ignoreSurroundingSpaces": "false"})
    parsed = records.where("__at > 0").select("_ord", page.alias("p"))
    broken = F.col("p").isNull() | F.col(f"p.{bad}").isNotNull()
    return parsed.select("_ord", broken.alias("is_malformed"), *[F.col(f"p.{f.name}").alias(f.name) for f in PAGE.fields])


def accepted_pages(pages: DataFrame, namespace: int = 0, include_redirects: bool = False) -> DataFrame:
    """_ord, id, title, text of the articles among well-formed pages."""
    text = F.element_at("revision", 1)["text"]
    ok = F.expr(f"try_cast(trim(ns) AS int) = {int(namespace)}") & F.col("title").isNotNull() & F.col("id").isNotNull() & F.col("revision").isNotNull()
    if not include_redirects:
        ok = ok & F.col("redirect").isNull()
    return pages.where(~F.col("is_malformed") & ok & (F.length(strip_space(F.coalesce(text, F.lit("")))) > 0)).select("_ord", "id", "title", text.alias("text"))


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """df, which one file that can't be split has put into one task, dealt to tasks of a work unit each; after _ord is assigned."""
    workers = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, -(-rows // chunk_size(rows, workers))))


def read_pages(spark: SparkSession, path: str, namespace: int = 0, include_redirects: bool = False, policy: str = "skip") -> DataFrame:
    """_ord, id, title, text of a dump's accepted pages; malformed pages are skipped, or fail the scan under "raise"."""
    return accepted_pages(apply_malformed_policy(scan_pages(spark, path), policy), namespace, include_redirects)


def parse_tsv(line: Column) -> Column:
    """struct(doc_id, url, title, body); null where the line hasn't four fields. Further tabs stay in the body."""
    parts = F.split(line, "\t", 4)
    return F.when(F.size(parts) == 4, F.struct(*[parts[i].alias(n) for i, n in enumerate(("doc_id", "url", "title", "body"))]))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """_ord, line, is_malformed, doc_id, url, title, body of every line; bytes that aren't UTF-8 become U+FFFD."""
    lines = with_order(spark.read.text(path)).select("_ord", F.make_valid_utf8("value").alias("line"))
    return lines.withColumn("d", parse_tsv(F.col("line"))).select("_ord", "line", F.col("d").isNull().alias("is_malformed"), "d.*")


def apply_malformed_policy(parsed: DataFrame, policy: str = "skip") -> DataFrame:
    """The well-formed rows. "skip" drops malformed ones; "raise" fails on the first that the scan meets, in a filter that no
    projection can prune away."""
    if malformed_policy(policy) == "skip":
        return parsed.where(~F.col("is_malformed"))
    failed = F.raise_error(F.concat(F.lit("malformed row at "), F.col("_ord").cast("string")))
    return parsed.where(F.when(F.col("is_malformed"), failed.cast("boolean")).otherwise(F.lit(True)))


def parse_labelled(line: Column) -> Column:
    """struct(label, text); null for blank lines and lines of one word."""
    parts = F.split(strip_space(line), " ", 2)
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("label"), parts[1].alias("text")))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(parse_labelled(F.make_valid_utf8("value")).alias("d")).where("d IS NOT NULL").select("d.*")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as cleaned rows: body is its text, title its source, _ord its doc_id."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(F.col("doc_id").cast("long").alias("_ord"), F.col("doc_id").cast("string").alias("doc_id"), F.lit("").alias("url"), F.col("source").alias("title"), F.col("text").alias("body"))


def clean_wiki(pages: DataFrame, source: str = "wikipedia", dump_date: str = "latest", collapse: bool = True, min_body_chars: int = 0, drop_empty_title: bool = False, parser: str = "patterns", required: bool = False) -> DataFrame:
    """Six text columns in the order of the output schema, after _ord; rows that the cleaner drops have drop_reason.

    parser: "patterns", or "library" for the wikitext library where it is installed (``required``: an ImportError where it isn't).
    """
    title = normalize_text(F.coalesce("title", F.lit("")), collapse)
    body = parsed_wikitext(F.coalesce("text", F.lit("")), collapse, parser, required)
    out = pages.select("_ord", *_marks(pages), F.coalesce("id", F.lit("")).alias("id"), title.alias("title"), body.alias("body"))
    out = out.select("*", wiki_url(F.col("title")).alias("url"), F.lit(source).alias("source"), F.lit(dump_date).alias("dump_date"))
    return _cleaner_drops(out, min_body_chars, drop_empty_title)


def clean_tsv(docs: DataFrame, source: str = "msmarco", version: str = "docs", collapse: bool = True, min_body_chars: int = 0, drop_empty_title: bool = False) -> DataFrame:
    """Six text columns in the order of the output schema, after _ord; rows that are malformed or that the cleaner drops have drop_reason."""
    norm = lambda c: normalize_text(F.coalesce(c, F.lit("")), collapse).alias(c)
    out = docs.select("_ord", *_marks(docs), F.coalesce("doc_id", F.lit("")).alias("doc_id"), norm("url"), norm("title"), norm("body"), F.lit(source).alias("source"), F.lit(version).alias("version"))
    return _cleaner_drops(out, min_body_chars, drop_empty_title)


def _marks(df: DataFrame) -> list[str]:
    return ["is_malformed"] if "is_malformed" in df.columns else []


def _cleaner_drops(df: DataFrame, min_body_chars: int, drop_empty_title: bool) -> DataFrame:
    """df with a drop_reason column where rows can be malformed or dropped by the cleaner."""
    reasons = [F.when(F.col("is_malformed"), MALFORMED)] if "is_malformed" in df.columns else []
    if drop_empty_title:
        reasons.append(F.when(F.col("title") == "", CLEANER_DROPPED))
    if min_body_chars:
        reasons.append(F.when(F.length("body") < min_body_chars, CLEANER_DROPPED))
    return df.withColumn("drop_reason", F.coalesce(*reasons)).drop("is_malformed") if reasons else df


def skip_and_limit(df: DataFrame, skip: int = 0, limit: int | None = None) -> DataFrame:
    """Rows skip .. skip + limit - 1 of a dense order; a filter, so it is deterministic and can be pushed down."""
    out = df.where(F.col("_ord") >= skip) if skip else df
    return out if limit is None else out.where(F.col("_ord") < skip + limit)
