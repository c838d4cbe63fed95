"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

Each source gets words in proportion to its weight, but at most ``max_epochs`` times its own; what a
capped source can't take is reshared by weight until no source is above its cap. A source's target is
met by whole repetitions of all its documents plus one more of those that come first in a seeded order.

Cases: null or empty text has size 0 and is taken 0 times; a null source is a source, last in order; an
empty table gives no rows; rows without id share a draw; equal rows may take different numbers of copies but any run gives the same rows;
a source whose texts are all empty has target 0; further columns pass through, but for those named
like a column of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.plans.keys import hidden
from corpusloom.plans.shared import save, spread

#: A row's draw is one of so many; a source's documents, in the order of their draws, are dealt over so many slices. Only the
#: slice in which the words still to take end is sorted; with more than FEW rows it is sliced again first.
DRAWS, SLICES, FEW = 1 << 52, 1024, 50_000
#: Up to so many sources, the table with a row per source is broadcast; beyond it is joined over salts.
MOST_BROADCAST = 50_000
SALTS = 32
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _draw(id_col: str, seed: int) -> Column:
    """52 seeded bits of a row's id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint")


def _small(per_source: DataFrame) -> DataFrame:
    """To be broadcast, if the table with a row per source has few enough rows for that."""
    return F.broadcast(per_source) if per_source.count() <= MOST_BROADCAST else per_source


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Add ``weight``: the cycle repeated over the sources by code point, null last."""
    no = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (no % len(cycle) + 1).cast("int")))


def water_fill(sources: DataFrame, times: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, weight) -> the same with ``target``; a row per source.

    With sources ordered by cap over weight, let level i be what is left per weight if all before i are
    capped. It rises as long as sources are capped and falls after, so the final level is the largest.
    """
    whole = Window.partitionBy()
    by = whole.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * max_epochs
    s = sources.withColumn("cap", cap).withColumn("ratio", cap.cast("double") / F.col("weight"))
    left = F.lit(float(times)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left / weight.cast("double"))
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), F.max("level").over(whole) * F.col("weight")))
    return s.drop("cap", "ratio", "level")


def _straddling(slices: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, lo, hi, n, from): of each source the slice in which its running size, from ``base`` on, passes what is still to take."""
    w = Window.partitionBy("source").orderBy("lo")
    run = slices.withColumn("upto", F.sum("size").over(w)).withColumnRenamed("source", "_s")
    run = run.join(sources.select("source", "rest", "base"), F.col("_s").eqNullSafe(F.col("source")))
    start = F.col("base") + F.col("upto") - F.col("size")
    # One that ends there is taken whole, so the next is it.
    found = run.filter((F.col("rest") > 0) & (start <= F.col("rest")) & (start + F.col("size") > F.col("rest")))
    return found.select("source", "lo", "hi", "n", start.alias("from"))


def _slices(sized: DataFrame, lo: Column, width: Column) -> DataFrame:
    """(source, lo, hi, size, n): rows by the slice, ``width`` draws wide from ``lo`` on, that their draw is in."""
    at = lo + F.floor((F.col("_u") - lo) / width) * width
    return sized.groupBy(F.col("_source").alias("source"), at.cast("bigint").alias("lo"), (at + width).cast("bigint").alias("hi")).agg(F.sum("mix_size").alias("size"), F.count("*").alias("n"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, size_col: str | None = None,
        cycle: tuple[int, ...] = (5, 2, 1), times: float = 1.5, max_epochs: int = 2, seed: int = 7) -> DataFrame:
    """Every row of ``docs`` with mix_size, mix_source_size, mix_target, mix_copies.

    Texts are read twice (sizes, then the rows themselves) and, but for one small slice of each source, never moved.
    ``size_col``, a bigint without nulls, takes the place of the words of ``text_col`` where given.
    """
    own, named, back = hidden(docs)
    id_col, source_col = named[id_col], named[source_col]
    size = F.col(named[size_col]) if size_col else words(F.col(named[text_col]))
    rows = own.withColumn("mix_size", size).withColumn("_u", _draw(id_col, seed))
    sized = save(rows.select(F.col(source_col).alias("_source"), "_u", "mix_size"), "sizes")
    slices = save(_slices(sized, F.lit(0).cast("bigint"), F.lit(DRAWS // SLICES)), "slices")
    sources = water_fill(cycled_weights(slices.groupBy("source").agg(F.sum("size").alias("source_size")), cycle), times, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = save(sources.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "sources")
    cut = save(_straddling(slices, sources.withColumn("base", F.lit(0))), "cut")
    while True:  # what is cut is cut anew until few rows are left in it
        large = cut.filter((F.col("n") > FEW) & (F.col("hi") - F.col("lo") > 1))
        if large.isEmpty():
            break
        large = save(large.withColumnRenamed("source", "_s"), "large")
        inside = sized.join(_small(large), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi")))
        width = F.greatest(F.floor((F.col("hi") - F.col("lo")) / SLICES), F.lit(1)).cast("bigint")
        finer = save(_slices(inside.select("_source", "_u", "mix_size", F.col("lo").alias("_lo"), width.alias("_width")), F.col("_lo"), F.col("_width")), "slices")
        part = sources.select("source", "rest").join(large.select("_s", F.col("from").alias("base")), F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
        cut = save(cut.filter(~((F.col("n") > FEW) & (F.col("hi") - F.col("lo") > 1))).unionByName(_straddling(finer, part)), "cut")
    # Without a cut, nothing is still to take, or no less than the whole source.
    plan = sources.join(cut.withColumnRenamed("source", "_s"), F.col("_s").eqNullSafe(F.col("source")), "left")
    end = F.when(F.col("rest") > 0, F.lit(DRAWS)).otherwise(F.lit(0)).cast("bigint")
    plan = save(plan.select(
        F.col("source").alias("_source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("whole").alias("_whole"), F.col("rest").alias("_rest"),
        F.coalesce("lo", end).alias("_lo"), F.coalesce("hi", end).alias("_hi"), F.coalesce("from", F.lit(0)).alias("_from"),
    ), "plan")
    on = F.col(source_col).eqNullSafe(F.col("_source"))
    if plan.count() <= MOST_BROADCAST:
        joined = rows.join(F.broadcast(plan), on)
    else:
        salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("_at", (F.col("_u") % SALTS).cast("int")).join(salted.hint("merge"), on & (F.col("_at") == F.col("_salt"))).drop("_at", "_salt")
    at_edge = (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))
    clear = joined.filter(~at_edge).withColumn("_more", (F.col("_u") < F.col("_lo")).cast("int"))
    w = Window.partitionBy("_source").orderBy("_u", F.col(id_col).asc_nulls_first(), "mix_size")
    upto = F.col("_from") + F.sum("mix_size").over(w) - F.col("mix_size")
    edge = joined.filter(at_edge).withColumn("_more", (upto + F.col("mix_size") / 2.0 <= F.col("_rest")).cast("int"))
    out = clear.unionByName(edge)
    out = out.withColumn("mix_copies", F.col("_whole") + F.col("_more"))
    return back(out, "mix_size", "mix_source_size", "mix_target", "mix_copies")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sized = save(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "sized")
    return mix(sized, size_col="size").select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
      - CAST(coalesce(sum(2 * source_size) OVER (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM s
), t AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN target - whole * source_size > 0 AND CAST(upto AS DOUBLE) + size / 2.0::DOUBLE <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
