"""Queries of the URL blocklist and of URL dedup, over ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators import urls
from corpusloom.queries.common import table


def _pages(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


BLOCKED = {"adult": ["example.org", "blocked.example"], "agressif": ["example.net", "example.org"]}


def _blocked(spark) -> DataFrame:
    one = lambda ds: spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{d}')" for d in ds) + " AS t(domain)")
    return urls.blocklist({k: one(v) for k, v in BLOCKED.items()})


def _flagged(spark, sf_dir: str) -> DataFrame:
    return urls.with_reason(_pages(spark, sf_dir), _blocked(spark))


def _others(spark, sf_dir: str) -> list[DataFrame]:
    """Two other datasets: what the first pages of each host hold, and a null address."""
    pages = _pages(spark, sf_dir)
    first = pages.groupBy(urls.host(F.col("url")).alias("h")).agg(F.min("url").alias("url")).select("url")
    return [first, spark.sql("SELECT CAST(NULL AS STRING) AS url"), first]


def _target(spark, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).unionByName(spark.sql("SELECT -1L AS page_id, CAST(NULL AS STRING) AS url"))


_PROBES = (
    "http://a.b.co.uk/x", "https://co.uk/", "http://x.y.z.ck/", "http://www.ck/a", "http://ck/", "http://10.0.0.1:80/x", "user@Host.Example.COM:81?q", "localhost", "ftp://deep.sub.domain.org.sa#f",
)


def _addresses(spark, sf_dir: str) -> DataFrame:
    """Pages, and addresses that reach every rule."""
    probes = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({-i - 1}L, '{u}')" for i, u in enumerate(_PROBES)) + " AS t(page_id, url)")
    return _pages(spark, sf_dir).unionByName(probes)


def _domain_sql() -> str:
    """Longest rule that fits, but for exceptions; its labels and one more."""
    fits = ", ".join(
        f"CASE WHEN n >= {r.count('.') + 1} AND array_to_string(l[-{r.count('.') + (r[0] != '*')}:], '.') = '{r.lstrip('!').removeprefix('*.')}' THEN {100 if r[0] == '!' else r.count('.') + 1} ELSE 1 END" for r in urls.SUFFIXES
    )
    exception = max(r.count(".") for r in urls.SUFFIXES if r[0] == "!")
    probes = ", ".join(f"({-i - 1}, '{u}')" for i, u in enumerate(_PROBES))
    return f"""
SELECT page_id, h AS host, CASE WHEN regexp_matches(h, '^[0-9]+(\\.[0-9]+){{3}}$') OR n < k + 1 THEN h || '.' ELSE array_to_string(l[-(k + 1):], '.') END AS domain FROM (
  SELECT *, CASE WHEN m = 100 THEN {exception} ELSE m END AS k FROM (
    SELECT *, greatest({fits}) AS m FROM (
      SELECT page_id, h, string_split(h, '.') AS l, len(string_split(h, '.')) AS n FROM (
        SELECT page_id, {_HOST} AS h FROM (SELECT page_id, url FROM pages UNION ALL SELECT * FROM (VALUES {probes}) v(page_id, url))))))"""


_DOMAIN = """CASE WHEN regexp_matches(h, '^[0-9]+(\\.[0-9]+){3}$') OR len(string_split(h, '.')) < 2 THEN h || '.'
  ELSE array_to_string(string_split(h, '.')[-2:], '.') END"""
_HOST = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:@]*)', 1))"
_FLAGGED = f"""SELECT page_id, url, CASE WHEN d IN ('example.org', 'blocked.example') THEN 'adult' WHEN d = 'example.net' THEN 'agressif' END AS reason
  FROM (SELECT page_id, url, {_DOMAIN} AS d FROM (SELECT page_id, url, {_HOST} AS h FROM pages))"""
_OTHERS = f"SELECT min(url) AS url FROM (SELECT url, {_HOST} AS h FROM pages) GROUP BY h UNION SELECT NULL"
_TARGET = "SELECT page_id, url FROM pages UNION ALL SELECT -1, NULL"

QUERIES = {
    "url_domain": lambda s, d: _addresses(s, d).select("page_id", urls.host(F.col("url")).alias("host"), urls.registered_domain(F.col("url")).alias("domain")),
    "url_blacklist_reason": _flagged,
    "url_blacklist_anti": lambda s, d: urls.unblocked(_pages(s, d), _blocked(s)),
    "url_reason_counts": lambda s, d: urls.reason_counts(_flagged(s, d)),
    "url_removed_report": lambda s, d: urls.removed_report(_flagged(s, d)),
    "url_union_all": lambda s, d: urls.union_all([_pages(s, d), *_others(s, d)]),
    "url_union_distinct": lambda s, d: urls.union_urls(_others(s, d)),
    "url_dedup_anti": lambda s, d: urls.not_in(_target(s, d), urls.union_urls(_others(s, d))),
    "url_dedup_counts": lambda s, d: urls.dedup_counts(_target(s, d), urls.union_urls(_others(s, d))),
    "url_dedup_counts_by_file": lambda s, d: urls.dedup_counts(_target(s, d).withColumn("file", F.col("page_id") % 3), urls.union_urls(_others(s, d)), by="file"),
    "url_first_per_url": lambda s, d: urls.first_per_url(urls.union_all([_pages(s, d), _pages(s, d).withColumn("page_id", F.col("page_id") + 1_000_000)]), "page_id"),
}

ORACLE_SQL = {
    "url_domain": _domain_sql(),
    "url_dedup_counts_by_file": f"""SELECT file, count(*) AS before, count(*) FILTER (NOT hit) AS after, count(*) FILTER (hit) AS removed
  FROM (SELECT page_id % 3 AS file, EXISTS (SELECT 1 FROM ({_OTHERS}) o WHERE o.url IS NOT DISTINCT FROM t.url) AS hit FROM ({_TARGET}) t) GROUP BY file""",
    "url_blacklist_reason": _FLAGGED,
    "url_blacklist_anti": f"SELECT page_id, url FROM ({_FLAGGED}) WHERE reason IS NULL",
    "url_reason_counts": f"SELECT reason, count(*) AS removed FROM ({_FLAGGED}) WHERE reason IS NOT NULL GROUP BY ROLLUP (reason)",
    "url_removed_report": f"SELECT reason, url FROM ({_FLAGGED}) WHERE reason IS NOT NULL",
    "url_union_all": f"SELECT page_id, url FROM pages UNION ALL SELECT NULL, url FROM ({_OTHERS}) UNION ALL SELECT NULL, url FROM ({_OTHERS}) WHERE url IS NOT NULL",
    "url_union_distinct": _OTHERS,
    "url_dedup_anti": f"SELECT page_id, url FROM ({_TARGET}) t WHERE NOT EXISTS (SELECT 1 FROM ({_OTHERS}) o WHERE o.url IS NOT DISTINCT FROM t.url)",
    "url_dedup_counts": f"""SELECT count(*) AS before, count(*) FILTER (NOT hit) AS after, count(*) FILTER (hit) AS removed
  FROM (SELECT EXISTS (SELECT 1 FROM ({_OTHERS}) o WHERE o.url IS NOT DISTINCT FROM t.url) AS hit FROM ({_TARGET}) t)""",
    "url_first_per_url": "SELECT min(page_id) AS page_id, url FROM pages GROUP BY url",
}
