"""URL blocklists and dedup of a table's URLs against other tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.plans.shared import save

#: Common public suffixes of more than one label, for want of the whole list, which ``sources.files.read_suffixes`` reads.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.kr", "co.in", "com.br", "com.cn", "com.tr", "com.sa", "com.eg", "gov.sa", "edu.sa", "org.sa", "com.mx", "co.za", "com.ar", "com.lb", "com.jo", "com.kw", "com.qa", "*.ck", "!www.ck")
#: Blocklists up to so many domains are broadcast; larger ones are joined by a shuffle.
MOST_BROADCAST = 200_000


def host(url: Column) -> Column:
    """Lower-cased host of an address with or without scheme; '' where there is none."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:@]*)", 1))


def _suffix_labels(h: Column, rules: tuple[str, ...]) -> Column:
    """How many labels of a host its public suffix has: of the rules that fit an exception (!x.y) wins, else the longest; 1 without any."""
    kinds: dict[tuple[str, int], list[str]] = {}
    for r in rules:
        kind = r[0] if r[0] in "*!" else "="
        kinds.setdefault((kind, r.count(".") + 1), []).append({"*": r[2:], "!": r[1:], "=": r}[kind])
    labels = F.size(F.split(h, r"\.", -1))
    fits = {
        (kind, n): (labels >= n) & F.substring_index(h, ".", -(n - 1 if kind == "*" else n)).isin(*found)
        for (kind, n), found in kinds.items()
        if kind != "*" or n > 1
    }
    exceptions = [F.when(f, F.lit(n - 1)) for (kind, n), f in fits.items() if kind == "!"]
    longest = [F.when(f, F.lit(n)).otherwise(F.lit(1)) for (kind, n), f in fits.items() if kind != "!"]
    return F.coalesce(*exceptions, F.greatest(F.lit(1), F.lit(1), *longest))


def registered_domain(url: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The label before the public suffix, and that; 'x.' for an IP address or a host without suffix, which no list holds.

    ``suffixes`` are rules as the public suffix list writes them; single labels needn't be among them.
    """
    h = host(url)
    n = _suffix_labels(h, suffixes) + 1
    labels = F.split(h, r"\.", -1)
    bare = h.rlike(r"^[0-9]+(\.[0-9]+){3}$") | (F.size(labels) < n)
    return F.when(bare, F.concat(h, F.lit("."))).otherwise(F.array_join(F.slice(labels, -n, n), "."))


def blocklist(lists: dict[str, DataFrame]) -> DataFrame:
    """(domain, reason): each domain under the first list that has it. ``lists`` have a column domain."""
    rows = [df.select("domain", F.lit(k).alias("reason"), F.lit(i).alias("prio")) for i, (k, df) in enumerate(lists.items())]
    return reduce(DataFrame.unionByName, rows).groupBy("domain").agg(F.min_by("reason", "prio").alias("reason"))


def with_reason(rows: DataFrame, blocked: DataFrame, url_col: str = "url") -> DataFrame:
    """``rows`` with reason, null where the address isn't blocked. Addresses that are null never are."""
    blocked = save(blocked, "blocklist")
    small = blocked.count() <= MOST_BROADCAST
    side = F.broadcast(blocked) if small else blocked
    keyed = rows.withColumn("_domain", registered_domain(F.col(url_col)))
    if small:
        return keyed.join(side.withColumnRenamed("domain", "_domain"), "_domain", "left").drop("_domain")
    # A domain may have most rows: deal each over salts, the list's rows under each salt.
    salts = 16
    keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(url_col), F.lit(salts)).cast("int"))
    side = side.withColumnRenamed("domain", "_domain").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return keyed.join(side, ["_domain", "_salt"], "left").drop("_domain", "_salt")


def unblocked(rows: DataFrame, blocked: DataFrame, url_col: str = "url") -> DataFrame:
    return with_reason(rows, blocked, url_col).filter(F.col("reason").isNull()).drop("reason")


def reason_counts(flagged: DataFrame) -> DataFrame:
    """Rows removed by reason, and in all (reason null)."""
    removed = flagged.filter(F.col("reason").isNotNull())
    return removed.rollup("reason").agg(F.count("*").alias("removed"))


def removed_report(flagged: DataFrame, url_col: str = "url") -> DataFrame:
    """A row for each removed row, numbered within its reason's partition of the report."""
    return flagged.filter(F.col("reason").isNotNull()).select("reason", F.col(url_col))


def union_urls(tables: list[DataFrame], url_col: str = "url") -> DataFrame:
    """Distinct addresses of several tables, null once."""
    return reduce(DataFrame.unionByName, [t.select(url_col) for t in tables]).distinct()


def union_all(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _hits(rows: DataFrame, urls: DataFrame, url_col: str) -> DataFrame:
    """``rows`` with _hit, null where the address isn't among ``urls``; null equals null.

    Rows without an address, which may be many, aren't joined: whether ``urls`` has a null is one bit.
    """
    other = urls.select(F.col(url_col).alias("_u")).distinct()
    no_url = not other.filter(F.col("_u").isNull()).isEmpty()
    with_url = rows.filter(F.col(url_col).isNotNull()).join(other.filter(F.col("_u").isNotNull()).withColumn("_hit", F.lit(1)), F.col(url_col) == F.col("_u"), "left").drop("_u")
    return with_url.unionByName(rows.filter(F.col(url_col).isNull()).withColumn("_hit", F.lit(1 if no_url else None).cast("int")))


def not_in(rows: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Rows whose address isn't among ``urls``; null equals null; repeats within ``rows`` stay."""
    return _hits(rows, urls, url_col).filter(F.col("_hit").isNull()).drop("_hit")


def dedup_counts(rows: DataFrame, urls: DataFrame, url_col: str = "url", by: str | None = None) -> DataFrame:
    """Rows before, after and removed, by the values of ``by`` (an input file, say) or in all."""
    flagged = _hits(rows, urls, url_col)
    hit = F.col("_hit").isNotNull()
    out = (flagged.groupBy(by) if by else flagged.groupBy()).agg(F.count("*").alias("before"), F.count_if(~hit).alias("after"), F.count_if(hit).alias("removed"))
    return out


def first_per_url(rows: DataFrame, order_col: str, url_col: str = "url") -> DataFrame:
    """One row per address, also within the table: the one with the least ``order_col``."""
    w = Window.partitionBy(url_col).orderBy(order_col)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
