"""Line deduplication by site-relative frequency: a line goes from the pages of a host if more than a given share of the host's
pages has it.

A page counts once for each of its different lines; white space around a line is ignored, and blank lines are neither counted
nor dropped. Counting is by key with partial sums, so a line that a third of all pages has is summed before the shuffle. The
boilerplate lines of a host are at most its lines a page divided by the ratio. If all of them are few enough (a checked count),
they are broadcast as one list a host, and no text is shuffled; else pages meet them by a join on host and line, and then by a
key made from the whole page.

The query counts every row, as its SQL says. The pipeline's stage runs before near copies go, so there (`copies=False`) all rows of a
host with equal texts are one page: a large group of exact copies does not make its own lines boilerplate.

Defined results: a null text stays null; a null host is a host of its own; a page that loses every line has an empty text;
repeated rows are pages of their own when counted (with `copies=False` one page) and are treated alike; an empty table gives an empty table. All columns are
kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, table, wide_hash


@dataclass(frozen=True)
class Boilerplate:
    """ratio: share of a host's pages above which a line goes. min_pages: a line on fewer pages stays, however small the host. broadcast_lines: boilerplate lines up to which they are broadcast."""

    ratio: float = 0.02
    min_pages: int = 5
    broadcast_lines: int = 50_000


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Null for a blank line."""
    line = F.btrim(line, F.lit(" \t\r\x0b\x0c"))
    return F.when(line != "", wide_hash(line))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", limits: Boilerplate = Boilerplate(), copies: bool = True) -> DataFrame:
    """host, line (its key), n_pages, host_pages of the lines that go. copies: whether each copy of a text is a page of its own."""
    rows = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    if not copies:
        # only hosts, hashes and the keys of lines are shuffled; copies meet in partial sums first
        keyed = rows.select("host", wide_hash("text").alias("copy"), F.array_distinct(F.array_compact(F.transform(lines_of(F.col("text")), line_key))).alias("keys"))
        rows = cut(keyed.groupBy("host", "copy").agg(F.first("keys").alias("keys")))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    keys = F.array_distinct(F.array_compact(F.transform(lines_of(F.col("text")), line_key))) if copies else F.col("keys")
    counts = rows.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= limits.min_pages)
    # a host's total is one row, yet its lines may be many: they are dealt by host and line, and hosts meet them by a broadcast if Spark sees that they are few
    return counts.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).where(F.col("n_pages") > limits.ratio * F.col("host_pages")).select("host", "line", "n_pages", "host_pages")


def drop_lines(pages: DataFrame, host: str = "source", text: str = "text", limits: Boilerplate = Boilerplate(), dropped: str | None = None, copies: bool = True) -> DataFrame:
    """pages without their boilerplate lines. dropped: a name for the number of lines dropped."""
    common = cut(boilerplate(pages, host, text, limits, copies).select("host", "line"))
    whole = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"))
    body, at = F.col("page").getField(text), F.col("page").getField(host)
    if common.count() <= limits.broadcast_lines:
        lists = common.groupBy("host").agg(F.collect_list("line").alias("gone"))
        whole = whole.join(F.broadcast(lists), at.eqNullSafe(F.col("host")), "left")
    else:
        key = F.struct(wide_hash(at, body), F.xxhash64(body, at))
        own = whole.select(key.alias("key"), at.alias("h"), F.explode(F.array_distinct(F.array_compact(F.transform(lines_of(body), line_key)))).alias("l"))
        hits = own.join(common, F.col("h").eqNullSafe(F.col("host")) & (F.col("l") == F.col("line"))).groupBy("key").agg(F.collect_set("line").alias("gone"))
        whole = whole.withColumn("k", key).join(hits, F.col("k") == F.col("key"), "left")
    stays = lambda line: F.coalesce(~F.array_contains(F.col("gone"), line_key(line)), F.lit(True))
    kept = F.when(F.col("gone").isNull(), lines_of(body)).otherwise(F.filter(lines_of(body), stays))
    whole = whole.select("page", kept.alias("kept"))
    out = [F.col("page").getField(c).alias(c) if c != text else F.when(body.isNotNull(), F.array_join("kept", "\n")).alias(c) for c in pages.columns]
    return whole.select(*out, *([F.coalesce(F.size(lines_of(body)) - F.size("kept"), F.lit(0)).cast("long").alias(dropped)] if dropped else []))


def op10_site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), dropped="n_dropped")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """documents without their boilerplate lines, counted over different texts; n_chars follows the text."""
    return drop_lines(docs, copies=False).withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


def sql(documents: str, columns: str, limits: Boilerplate = Boilerplate()) -> str:
    """DuckDB SQL for drop_lines() over a table or common table expression whose rows have a number rn."""
    blank = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"
    return f"""
SELECT {columns}, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text, CAST(coalesce(gone, 0) AS BIGINT) AS n_dropped
FROM {documents} d LEFT JOIN (
  SELECT l.rn, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE b.line IS NULL) AS kept, count(b.line) AS gone
  FROM (SELECT rn, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {documents}) l
  LEFT JOIN (
    SELECT c.source, c.line
    FROM (SELECT source, line, count(*) AS n_pages
          FROM (SELECT DISTINCT rn, source, trim(line, {blank}) AS line FROM (SELECT rn, source, unnest(string_split(text, chr(10))) AS line FROM {documents}))
          WHERE line <> '' GROUP BY source, line) c
    JOIN (SELECT source, count(*) AS host_pages FROM {documents} GROUP BY source) t ON c.source IS NOT DISTINCT FROM t.source
    WHERE n_pages >= {limits.min_pages} AND n_pages > {limits.ratio} * host_pages) b
  ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, {blank}) = b.line
  GROUP BY l.rn) k ON d.rn = k.rn"""


OP10_SQL = f"WITH docs AS (SELECT doc_id, source, text, row_number() OVER () AS rn FROM documents) {sql('docs', 'd.doc_id, d.source')}"
