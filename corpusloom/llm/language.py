"""Language of web pages by Bayesian fusion of text, declared markup language, address suffix and host.

    log P(language | page) = log prior(host) + log P(declared | language) + log P(suffix | language) + text evidence

The text evidence is that of byte trigrams, fitted on a bounded sample of documents of known language, in which each
language has a document at least. Every language that documents have is told apart. All other terms are counted over all pages by
grouped aggregation of what the text says by itself. A host's prior is smoothed towards its domain's, and that towards the prior
of all pages; a page's own text is taken out of its host's counts.

Cases: null or empty html has no text evidence; null or odd addresses have host, domain and suffix ''; a language tag that no
document has counts as none; of a language whose documents are all held out or without trigrams the text says nothing; equal
rows are counted as often as they stand there; very long pages are read whole; null and repeated ids are no special case; without
documents of known language the result has no rows, nor has it without pages; further columns pass through, but those named like
one of the result (host, declared, language, confidence, posterior) are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.samples import fit, held_out
from corpusloom.plans.keys import hidden, join_per_key, row_key
from corpusloom.plans.shared import save, ship, spread

#: Documents that the trigram model is fitted on at most, but for one of each language.
SAMPLE_ROWS = 6_000
#: Counts by trigram and language that a training waits for before it adds them up.
WAITING = 1 << 22
#: Up to so many cells the table of tags is broadcast; beyond it only its hot rows are.
MOST_BROADCAST = 1_000_000
SLOTS, SMOOTH = 1 << 16, 0.5
#: Trigrams of a text depend on each other: a text counts as so many of them at most, at this weight.
MOST_TRIGRAMS, TRIGRAM_WEIGHT = 400, 0.25
#: Pages that a host's and a domain's own counts are weighed against.
HOST_STRENGTH, DOMAIN_STRENGTH, TABLE_STRENGTH = 5.0, 20.0, 10.0


_RESULT = ("host", "declared", "language", "confidence", "posterior")


def _trigrams(text: str) -> np.ndarray:
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    return ((((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _trainer(n: int):
    """A table of the trigrams that were seen, by slot and language, so its size is that of the sample, not of ``n``."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys))

    def train(rows: Iterator[tuple[str, int]]) -> bytes:
        parts, waiting = [(np.empty(0, np.int64), np.empty(0))], 0
        for text, label in rows:
            slots, times = np.unique(_trigrams(text), return_counts=True)
            parts.append((slots * n + label, times.astype(np.float64)))
            waiting += len(slots)
            if waiting > WAITING:
                parts, waiting = [merged(parts)], 0
        keys, counts = merged(parts)
        labels = keys % n
        totals = np.bincount(labels, counts, n)
        return pickle.dumps({
            "starts": np.searchsorted(keys // n, np.arange(SLOTS + 1)), "labels": labels.astype(np.int32), "gains": np.log1p(counts / SMOOTH).astype(np.float32),
            "unseen": np.log(SMOOTH / (SMOOTH * SLOTS + totals)), "taught": totals > 0,
        })

    return train


def fit_languages(docs: DataFrame, max_rows: int = SAMPLE_ROWS) -> tuple[list[str], bytes]:
    """Languages by code point, and the log probability of each trigram slot in each.

    A language's first document in a hashed order of ids is always learnt from. Others come by the place that they may be
    expected to have among those of their language, so rare languages are learnt whole and common ones equally.
    """
    teaches = ~held_out("doc_id") & (F.coalesce(F.octet_length("text"), F.lit(0)) >= 3)
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    known = known.select(F.col("doc_id").alias("k"), "lang", teaches.alias("teaches"), F.crc32(F.concat(F.lit("language:"), F.col("doc_id").cast("string"))).alias("h"))
    found = known.groupBy("lang").agg(F.count_if("teaches").alias("n"), F.min(F.when(F.col("teaches"), F.struct("h", "k"))).alias("first"))
    found = save(found, "languages")
    languages = sorted(r["lang"] for r in found.select("lang").collect())
    if not languages:
        return [], b""
    label = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    place = F.when(F.struct("h", "k") == F.col("first"), F.lit(-1.0)).otherwise(F.col("h") * F.col("n").cast("double"))
    ids = known.filter("teaches").join(F.broadcast(found.withColumn("label", label)), "lang").select("k", "lang", "label", "h", place.alias("place")).dropDuplicates(["k", "lang"])
    ids = ids.orderBy("place", "h", "k", "label").limit(max(max_rows, len(languages))).select("k", "lang", "label")
    texts = docs.select(F.col("doc_id").alias("k"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    return languages, fit(texts.join(F.broadcast(ids), ["k", "lang"]), _trainer(len(languages)))


def visible_text(html):
    """Text of a page without scripts, styles, comments and tags; common entities are decoded."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def text_evidence(docs: DataFrame, text, model: bytes, name: str = "evidence") -> DataFrame:
    """``docs`` with the weighed log likelihood of ``text`` in each language; null for those that the model wasn't taught."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = pickle.loads(shared.value)
        starts, labels, gains, unseen = m["starts"], m["labels"], m["gains"], m["unseen"]
        untaught = np.flatnonzero(~m["taught"]) if m["taught"].any() else ()
        for texts in batches:
            out = []
            for t in texts:
                i = _trigrams(t)
                weight = TRIGRAM_WEIGHT * min(1.0, MOST_TRIGRAMS / max(1, len(i)))
                slots, times = np.unique(i, return_counts=True)
                size = starts[slots + 1] - starts[slots]
                at = np.repeat(starts[slots] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                logs = ((unseen * len(i) + np.bincount(labels[at], gains[at] * np.repeat(times, size), len(unseen))) * weight).tolist()
                for k in untaught:
                    logs[k] = None
                out.append(logs)
            yield pd.Series(out)

    return docs.withColumn(name, evidence(text))


def _let(value, then):
    """``then(value)``, where the value is made once, not anew for each element of an array."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _total(values):
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _likelihoods(logs, then):
    """``then`` of the logs' largest, and of all as shares of that; what is null has none."""
    return _let(logs, lambda v: _let(F.array_max(v), lambda top: _let(F.transform(v, lambda x: F.coalesce(F.exp(x - top), F.lit(0.0))), lambda e: then(top, e))))


def _posterior(logs):
    return _likelihoods(logs, lambda top, e: _let(_total(e), lambda s: F.transform(e, lambda x: x / s)))


def _silent(logs):
    """The mean likelihood, as a log, of the languages whose likelihood is known: what stands for one that isn't."""
    return _likelihoods(logs, lambda top, e: top + F.log(_total(e) / F.size(F.filter(logs, lambda x: x.isNotNull()))))


def _summed(d: DataFrame, counts: str, pages, *keys: str) -> DataFrame:
    """(keys, pages, c): the arrays ``counts`` added up, as rows per place of the array, which may be any number."""
    d = d.select(*keys, pages.alias("_n"), F.posexplode(counts).alias("_i", "_x"))
    d = d.groupBy(*keys, "_i").agg(F.sum("_n").alias("_n"), F.sum("_x").alias("_x"))
    c = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"])
    return d.groupBy(*keys).agg(F.max("_n").alias("pages"), c.alias("c"))


def _by_hosts(by_host: DataFrame, key: str) -> DataFrame:
    """(key, pages, c, hosts): what the hosts of each domain or suffix sum up to, and how many there are."""
    return _summed(by_host, "c", F.col("pages"), key).join(by_host.groupBy(key).agg(F.count("*").alias("hosts")), key)


def identify_pages(pages: DataFrame, languages: list[str], model: bytes, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """``pages`` with host, declared, language, confidence and posterior (one share per language)."""
    own, named, back = hidden(pages)
    own = row_key(own, named[id_col])
    url_col, html_col = named[url_col], named[html_col]
    n = len(languages)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    p = own.withColumn("_host", host).withColumn("_domain", F.substring_index("_host", ".", -2)).withColumn("_suffix", F.substring_index("_host", ".", -1))
    p = p.withColumn("_declared", F.when(declared.isin(*languages), declared).otherwise(F.lit("")))
    p = text_evidence(p, visible_text(F.col(html_col)), model, "_text").withColumn("said", _posterior(F.col("_text")))
    # The page itself isn't kept: what is joined below is narrow.
    p = save(p.select("_row", "_host", "_domain", "_suffix", "_declared", "_text", "said"), "evidence")
    by_host = save(_summed(p, "said", F.lit(1), "_host", "_domain", "_suffix"), "hosts")
    total = _summed(by_host, "c", F.col("pages")).first()
    if not total or not total["pages"]:
        kinds = dict.fromkeys(_RESULT[:3], "string") | {"confidence": "double", "posterior": "array<double>"}
        return back(own.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()}), *_RESULT)
    overall = [(c + 1 / n) / (total["pages"] + 1) for c in total["c"]]
    totals = F.array(*map(F.lit, total["c"]))

    def log_share(table: DataFrame, name: str) -> DataFrame:
        """``table`` with the log of each language's share of what its rows count."""
        many = table.count()
        return table.withColumn(name, F.transform("c", lambda x, i: F.log((x + TABLE_STRENGTH / many) / (F.get(totals, i) + TABLE_STRENGTH))))

    # P(tag | language); the same for suffixes. There is a row per language that a page declares, and one for none.
    tags = log_share(save(_summed(p, "said", F.lit(1), "_declared"), "tags"), "log_tag").select("_declared", F.col("pages").alias("tag_pages"), "log_tag")
    suffixes = log_share(save(_by_hosts(by_host, "_suffix"), "suffixes"), "log_suffix").select("_suffix", "hosts", "log_suffix")
    domains = save(_by_hosts(by_host, "_domain").select("_domain", "hosts", F.col("pages").alias("domain_pages"), F.col("c").alias("domain_c")), "domains")
    n_hosts = by_host.count()
    prior = save(join_per_key(by_host, domains, "_domain", "hosts", n_hosts).drop("hosts"), "priors")
    prior = join_per_key(prior, save(suffixes, "suffixes"), "_suffix", "hosts", n_hosts)
    prior = save(prior.select("_host", "pages", "domain_pages", "log_suffix", F.col("c").alias("host_c"), "domain_c"), "priors")
    j = join_per_key(p, prior, "_host", "pages", total["pages"])
    j = j.join(F.broadcast(tags), "_declared") if (n + 1) * n <= MOST_BROADCAST else join_per_key(j, save(tags, "tags"), "_declared", "tag_pages", total["pages"])
    j = j.withColumn("_silent", _silent(F.col("_text")))
    alpha = F.array(*map(F.lit, overall))

    def smoothed(i):
        own = F.get("said", i)
        domain = (F.get("domain_c", i) - own + DOMAIN_STRENGTH * F.get(alpha, i)) / (F.col("domain_pages") - 1 + DOMAIN_STRENGTH)
        return (F.greatest(F.get("host_c", i) - own, F.lit(0.0)) + HOST_STRENGTH * F.greatest(domain, F.lit(1e-9))) / (F.col("pages") - 1 + HOST_STRENGTH)

    logs = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.log(smoothed(i)) + F.get("log_tag", i) + F.get("log_suffix", i) + F.coalesce(F.get("_text", i), F.col("_silent")))
    j = j.withColumn("posterior", _posterior(logs))
    top = F.array_max("posterior")
    language = F.get(F.array(*map(F.lit, languages)), F.array_position("posterior", top).cast("int") - 1)
    said = j.select("_row", F.col("_host").alias("host"), F.col("_declared").alias("declared"), language.alias("language"), top.alias("confidence"), "posterior")
    return back(own.join(said, "_row"), *_RESULT)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each page; the text model learns from documents, whose language is known."""
    languages, model = fit_languages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    pages = spread(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "html")
    if not languages:
        return pages.limit(0).select("page_id", F.lit("").alias("host"), F.lit("").alias("declared"), F.lit("").alias("language"), F.lit(0.0).alias("confidence"))
    return identify_pages(pages, languages, model).select("page_id", "host", "declared", "language", "confidence")
