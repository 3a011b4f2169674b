"""Line dedup by site-relative frequency.

For each host and line, the pages that contain the line are divided by the host's pages; a line above the
ratio is boilerplate of that host and goes from all its pages. DataFrame operations only. A page is a distinct
text of its host: the same text under many ids is one page seen often, so a large group of exact copies doesn't
make its own text boilerplate.

Lines and pages travel as 64-bit hashes and are counted by (host, line, page) before (host, line), so neither a
hot host nor a hot line meets in one task. The text is not shuffled while the boilerplate table is small: a
host has at most (its lines a page / ratio) such lines. Beyond that, a host's rows are dealt to SALTS tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._session import keep, unused

#: A line on more than this share of its host's pages is boilerplate.
RATIO = 0.1
#: And on at least so many pages, as a host of a few pages has no boilerplate to speak of.
MIN_PAGES = 5
#: So many boilerplate lines in all (8 bytes each) are broadcast; beyond, each host's list goes to so many tasks.
BROADCAST_LINES = 1_000_000
SALTS = 64


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r\x0b\x0c"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): for each host the hashes of its boilerplate lines. Written to the shared folder."""
    hashes = lambda text: F.array_distinct(F.transform(F.filter(_lines(text), lambda x: _trimmed(x) != ""), lambda x: F.xxhash64(_trimmed(x))))
    page = docs.select(F.col(host).alias("host"), F.xxhash64("text").alias("page"), hashes(F.coalesce("text", F.lit(""))).alias("lines"))
    pages = page.select(F.col("host").alias("h"), "page").distinct().groupBy("h").agg(F.count("*").alias("pages"))
    on = page.select("host", F.explode("lines").alias("line"), "page").distinct()
    counts = on.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    frequent = counts.join(pages, counts["host"].eqNullSafe(pages["h"])).where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return keep(frequent.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def _with_boilerplate(docs: DataFrame, found: DataFrame, host: str, to: str) -> DataFrame:
    """docs with its host's list as column `to`, null where there is none."""
    h, salt, salt_of = unused(docs, "h"), unused(docs, "salt"), unused(docs, "salt_of")
    found = found.select(F.col("host").alias(h), F.col("lines").alias(to))
    total = found.agg(F.sum(F.size(to))).first()[0] or 0
    if total <= BROADCAST_LINES:
        return docs.join(F.broadcast(found), docs[host].eqNullSafe(found[h]), "left").drop(h)
    found = found.withColumn(salt_of, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = docs.withColumn(salt, F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    return dealt.join(found, dealt[host].eqNullSafe(found[h]) & (dealt[salt] == found[salt_of]), "left").drop(h, salt, salt_of)


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """docs with the boilerplate lines of its hosts gone from `text`; other columns and all rows stay.

    Lines end at \\n and are compared without white space around them; a line of white space only is never
    boilerplate. A line counts once a page, however often it stands there, and once for all rows of a host with
    equal texts; such rows are one of the host's pages, and lose the same lines. Lines exactly at the ratio stay.
    Null text stays null and is a page, too; empty text stays empty; very long texts and lines are read whole; a
    null host is a host of its own. A page all of whose lines are boilerplate becomes the empty text. With
    counts, n_lines and n_dropped follow (lines of white space only count for neither); columns of these names
    are replaced. Other columns stay, whatever their names; an empty table gives an empty result.
    """
    told_at, known_at = unused(docs, "told"), unused(docs, "known")
    joined = _with_boilerplate(docs, boilerplate(docs, host, ratio, min_pages), host, known_at)
    known = F.coalesce(known_at, F.array().cast("array<bigint>"))
    told = lambda x: F.struct(x.alias("line"), (_trimmed(x) != "").alias("full"), (F.array_contains(known, F.xxhash64(_trimmed(x))) & (_trimmed(x) != "")).alias("hit"))
    joined = joined.withColumn(told_at, F.transform(_lines(F.coalesce("text", F.lit(""))), told))
    if counts:
        size = lambda part: F.size(F.filter(told_at, lambda x: x[part])).cast("long")
        joined = joined.withColumns({"n_lines": size("full"), "n_dropped": size("hit")})
    kept = F.array_join(F.transform(F.filter(told_at, lambda x: ~x["hit"]), lambda x: x["line"]), "\n")
    change = F.col("text").isNotNull() & F.exists(told_at, lambda x: x["hit"])
    return joined.withColumn("text", F.when(change, kept).otherwise(F.col("text"))).drop(told_at, known_at)


#: DuckDB's twin of drop_boilerplate(documents, counts=True) as op5 selects it.
SQL = f"""
WITH page AS (
  SELECT doc_id, source, text, row_number() OVER () AS page FROM documents
), line AS (
  SELECT page, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM page
), trimmed AS (
  SELECT *, trim(raw, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM line
), seen AS (
  SELECT DISTINCT source, key, text FROM trimmed WHERE key <> ''
), boiler AS (
  SELECT t.source, t.key
  FROM seen t JOIN (SELECT source, count(*) AS pages FROM (SELECT DISTINCT source, text FROM page) GROUP BY source) p
    ON t.source IS NOT DISTINCT FROM p.source
  GROUP BY t.source, t.key, p.pages
  HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * p.pages
), judged AS (
  SELECT t.*, b.key IS NOT NULL AS gone
  FROM trimmed t LEFT JOIN boiler b ON t.source IS NOT DISTINCT FROM b.source AND t.key = b.key
), joined AS (
  SELECT page, string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text,
         count(*) FILTER (WHERE key <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
  FROM judged GROUP BY page
)
SELECT p.doc_id, p.source, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(j.text, '') END AS text, j.n_lines, j.n_dropped
FROM page p JOIN joined j USING (page)
"""
