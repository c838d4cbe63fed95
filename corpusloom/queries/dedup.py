"""Queries of MinHash near-dedup: tokens, signatures, bands, pairs, lists, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators import minhash as M
from corpusloom.plans.shared import new_path, save
from corpusloom.queries.common import docs, table


def _sigs(spark, sf_dir: str, tokens: str = "word") -> DataFrame:
    return M.signatures(docs(spark, sf_dir), "doc_id", tokens=tokens)


def exact_jaccard(spark, sf_dir: str) -> DataFrame:
    """Near pairs with the share of words that they really have in common."""
    pairs = save(M.near_pairs(_sigs(spark, sf_dir)), "pairs")
    # Only words of documents that are in a pair, made once, each as 64 bits; arrays of numbers are compared without an interpreter.
    paired = pairs.select(F.explode(F.array("id", "dup_id")).alias("doc_id")).distinct()
    words = docs(spark, sf_dir).join(paired, "doc_id", "left_semi")
    words = save(words.select("doc_id", F.array_distinct(F.transform(M.word_tokens(F.col("text")), lambda w: F.xxhash64(w))).alias("w")), "words")
    p = pairs.join(words.select(F.col("doc_id").alias("id"), F.col("w").alias("a")), "id").join(words.select(F.col("doc_id").alias("dup_id"), F.col("w").alias("b")), "dup_id")
    p = p.select("id", "dup_id", (F.size("a") + F.size("b")).alias("n"), F.size(F.array_intersect("a", "b")).alias("both"))
    return p.select("id", "dup_id", (F.col("both") / (F.col("n") - F.col("both"))).alias("jaccard"))


def cross_shard(spark, sf_dir: str) -> DataFrame:
    """Documents of one half of the sources against those of the other."""
    d = table(spark, sf_dir, "documents").withColumn("upper", F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 1) >= "8")
    return M.cross_pairs(*(M.signatures(d.filter(F.col("upper") == k), "doc_id") for k in (False, True)))


def _shards(spark, sf_dir: str) -> str:
    """A saved index of three shards of documents; where it is."""
    d = table(spark, sf_dir, "documents")
    path = new_path(spark, "shards")
    sigs = M.signatures(d, "doc_id")
    M.write_index(sigs.withColumn("shard", M.shard_of(F.concat(F.lit("/hashes/shard_"), (F.col("unique_id") % 3).cast("string")))), path)
    return path


def all_shards(spark, sf_dir: str) -> DataFrame:
    """Every pair of shards, a shard with itself too."""
    return M.shard_duplicates(spark, _shards(spark, sf_dir))


def one_shard_pair(spark, sf_dir: str) -> DataFrame:
    """Lists of what shard 1 has of shard 0."""
    found = M.shard_duplicates(spark, _shards(spark, sf_dir), indexed=("0",), asked=("1",))
    return found.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("dup_id")), ",").alias("dup_ids"))


def last_of_id(spark, sf_dir: str) -> DataFrame:
    """Ids that repeat: the last row's signature is theirs."""
    d = docs(spark, sf_dir)
    twice = d.withColumn("at", F.lit(1)).unionByName(d.select((F.col("doc_id") - F.col("doc_id") % 5).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text"), (F.col("doc_id") % 5 + 2).cast("int").alias("at")))
    return M.signatures(twice, "doc_id", order_col="at").select("unique_id", F.array_join("sig", ",").alias("sig"))


_TOKENS = r"regexp_extract_all(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g'), '\S+')"
_CHARS = r"list_distinct(regexp_extract_all(text, '[\p{L}\p{N}_]'))"


def _sig_sql(source: str, key: str, tokens: str = _TOKENS) -> str:
    tokens = tokens.replace("text", "coalesce(text, '')")
    return f"""SELECT {key}, list_transform(range(1, {M.PERMUTATIONS + 1}), lambda i: coalesce(list_min(list_transform(h, lambda x: (x * ({M.A}::BIGINT[])[i] + ({M.B}::BIGINT[])[i]) % {M.PRIME})), {M.PRIME})) AS sig
  FROM (SELECT {key}, list_transform(list_distinct({tokens}), lambda t: ('0x' || substr(sha1(t), 1, 8))::BIGINT) AS h FROM {source})"""


_SIG = _sig_sql("documents", "doc_id")
_CLASS = "SELECT min(doc_id) AS rep, sig FROM s GROUP BY sig"
_PAIRS = f"""
WITH s AS ({_SIG}), c AS ({_CLASS}), b AS (SELECT rep, sig, unnest(range(0, {M.BANDS})) AS band FROM c),
k AS (SELECT rep, sig, band, sig[band * 4 + 1:band * 4 + 4] AS bucket FROM b),
p AS (SELECT DISTINCT x.rep AS id, y.rep AS dup_id, x.sig AS a, y.sig AS b FROM k x JOIN k y ON x.band = y.band AND x.bucket = y.bucket AND x.rep < y.rep)
SELECT id, dup_id, jaccard_est FROM (SELECT id, dup_id, a, b, len(list_filter(range(1, {M.PERMUTATIONS + 1}), lambda i: a[i] = b[i])) / {M.PERMUTATIONS}::DOUBLE AS jaccard_est FROM p) WHERE jaccard_est > 0.5"""

QUERIES = {
    "tokens_word": lambda s, d: docs(s, d).select("doc_id", F.size(M.word_tokens(F.col("text"))).cast("bigint").alias("n_tokens"), F.array_join(M.word_tokens(F.col("text")), " ").alias("tokens")),
    "tokens_char": lambda s, d: docs(s, d).select("doc_id", F.array_join(F.array_sort(M.char_tokens(F.col("text"))), "").alias("tokens")),
    "minhash_signature": lambda s, d: _sigs(s, d).select("unique_id", F.array_join("sig", ",").alias("sig")),
    "minhash_signature_char": lambda s, d: _sigs(s, d, "char").select("unique_id", F.array_join("sig", ",").alias("sig")),
    "lsh_bands": lambda s, d: M.bands(_sigs(s, d)).groupBy("band").agg(F.count("*").alias("n_rows"), F.count_distinct("bucket").alias("buckets")),
    "near_dup_pairs": lambda s, d: M.near_pairs(_sigs(s, d)),
    "near_dup_membership": lambda s, d: M.membership(_sigs(s, d)),
    "near_dup_lists": lambda s, d: M.near_lists(M.near_pairs(_sigs(s, d))).select("id", F.array_join("dup_ids", ",").alias("dup_ids")),
    "near_dup_keep_one": lambda s, d: M.keep_one(docs(s, d), _sigs(s, d), "doc_id").select("doc_id"),
    "near_dup_cross_shard": cross_shard,
    "near_dup_all_shards": all_shards,
    "near_dup_shard_pair": one_shard_pair,
    "minhash_last_of_id": last_of_id,
    "exact_jaccard": exact_jaccard,
}

_SHARDS = f"""
WITH s AS ({_SIG}), c AS (SELECT doc_id % 3 AS shard, min(doc_id) AS rep, sig FROM s GROUP BY ALL),
k AS (SELECT shard, rep, sig, band, sig[band * 4 + 1:band * 4 + 4] AS bucket FROM (SELECT *, unnest(range(0, {M.BANDS})) AS band FROM c)),
p AS (SELECT DISTINCT x.shard, y.shard AS dup_shard, x.rep AS id, y.rep AS dup_id, x.sig AS a, y.sig AS b FROM k x JOIN k y ON x.band = y.band AND x.bucket = y.bucket AND x.rep <> y.rep),
e AS (SELECT *, len(list_filter(range(1, {M.PERMUTATIONS + 1}), lambda i: a[i] = b[i])) / {M.PERMUTATIONS}::DOUBLE AS jaccard_est FROM p)"""

ORACLE_SQL = {
    "tokens_word": f"SELECT doc_id, len({_TOKENS}) AS n_tokens, array_to_string({_TOKENS}, ' ') AS tokens FROM documents",
    "tokens_char": f"SELECT doc_id, array_to_string(list_sort({_CHARS}), '') AS tokens FROM documents",
    "minhash_signature": f"SELECT doc_id AS unique_id, array_to_string(sig, ',') AS sig FROM ({_SIG})",
    "minhash_signature_char": f"SELECT doc_id AS unique_id, array_to_string(sig, ',') AS sig FROM ({_sig_sql('documents', 'doc_id', _CHARS)})",
    "lsh_bands": f"WITH s AS ({_SIG}), b AS (SELECT sig, CAST(unnest(range(0, {M.BANDS})) AS INTEGER) AS band FROM s) SELECT band, count(*) AS n_rows, count(DISTINCT sig[band * 4 + 1:band * 4 + 4]) AS buckets FROM b GROUP BY band",
    "near_dup_pairs": _PAIRS,
    "near_dup_membership": f"WITH s AS ({_SIG}), c AS ({_CLASS}) SELECT s.doc_id AS unique_id, c.rep FROM s JOIN c ON s.sig = c.sig",
    "near_dup_lists": f"WITH q AS ({_PAIRS}), e AS (SELECT id, dup_id FROM q UNION ALL SELECT dup_id, id FROM q) SELECT id, string_agg(CAST(dup_id AS VARCHAR), ',' ORDER BY dup_id) AS dup_ids FROM e GROUP BY id",
    "near_dup_keep_one": f"""
WITH RECURSIVE q AS ({_PAIRS}), s AS ({_SIG}), m AS (SELECT s.doc_id, c.rep FROM s JOIN ({_CLASS}) c ON s.sig = c.sig),
e AS (SELECT id, dup_id FROM q UNION ALL SELECT dup_id, id FROM q),
r AS (SELECT DISTINCT rep AS node, rep AS seen FROM m UNION SELECT r.node, e.dup_id FROM r JOIN e ON e.id = r.seen),
t AS (SELECT node, min(seen) AS root FROM r GROUP BY node)
SELECT m.doc_id FROM m JOIN t ON t.node = m.rep WHERE m.doc_id = t.root""",
    "near_dup_cross_shard": f"""
WITH d AS (SELECT doc_id, text, substr(md5(coalesce(source, '')), 1, 1) >= '8' AS upper FROM documents), s AS ({_sig_sql('d', 'doc_id, upper')}),
c AS (SELECT min(doc_id) AS rep, sig, upper FROM s GROUP BY sig, upper),
k AS (SELECT upper, rep, sig, band, sig[band * 4 + 1:band * 4 + 4] AS bucket FROM (SELECT *, unnest(range(0, {M.BANDS})) AS band FROM c)),
p AS (SELECT DISTINCT x.rep AS id, y.rep AS dup_id, x.sig AS a, y.sig AS b FROM k x JOIN k y ON x.band = y.band AND x.bucket = y.bucket AND NOT x.upper AND y.upper)
SELECT id, dup_id, jaccard_est FROM (SELECT id, dup_id, len(list_filter(range(1, 33), lambda i: a[i] = b[i])) / 32::DOUBLE AS jaccard_est FROM p) WHERE jaccard_est > 0.5""",
    "near_dup_all_shards": f"""{_SHARDS}
SELECT CAST(shard AS VARCHAR) AS shard, CAST(dup_shard AS VARCHAR) AS dup_shard, id, dup_id, jaccard_est FROM e WHERE jaccard_est > 0.5 AND (shard > dup_shard OR shard = dup_shard AND id > dup_id)""",
    "near_dup_shard_pair": f"""{_SHARDS}
SELECT id, string_agg(CAST(dup_id AS VARCHAR), ',' ORDER BY dup_id) AS dup_ids FROM e WHERE jaccard_est > 0.5 AND shard = 1 AND dup_shard = 0 GROUP BY id""",
    "minhash_last_of_id": f"""
WITH t AS (SELECT doc_id, text, 1 AS pos FROM documents UNION ALL SELECT doc_id - doc_id % 5, text || ' more', doc_id % 5 + 2 FROM documents),
l AS (SELECT doc_id, arg_max(text, pos) AS text FROM t GROUP BY doc_id)
SELECT doc_id AS unique_id, array_to_string(sig, ',') AS sig FROM ({_sig_sql('l', 'doc_id')})""",
    "exact_jaccard": f"""
WITH q AS ({_PAIRS}), w AS (SELECT doc_id, list_distinct({_TOKENS}) AS w FROM documents)
SELECT id, dup_id, len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)))::DOUBLE AS jaccard FROM q JOIN w a ON a.doc_id = id JOIN w b ON b.doc_id = dup_id""",
}
