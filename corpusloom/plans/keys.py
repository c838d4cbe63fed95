"""Row keys, and joins of a large table to a per-key table when few keys may hold most rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from corpusloom.plans.shared import save

#: A key with at least one of so many rows is hot. At most HOT_PARTS keys can be.
HOT_PARTS = 1000
#: Slots of the filter in ``without``.
SLOTS = 1 << 20


def hidden(df: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[..., DataFrame]]:
    """``df`` with columns named by position, so that an operator's own never clash with them; their names; the way back.

    ``back(out, *more)`` gives the columns their names again and adds the columns ``more``, each in the place of one of its name.
    """
    named = {n: f"_in{i}" for i, n in enumerate(df.columns)}

    def back(out: DataFrame, *more: str) -> DataFrame:
        own = {m.lower() for m in more}
        return out.select(*(F.col(i).alias(n) for n, i in named.items() if n.lower() not in own), *more)

    return df.toDF(*named.values()), named, back


def row_key(df: DataFrame, id_col: str, key: str = "_row") -> DataFrame:
    """Add a bigint ``key`` that is unique per row, in the order of ``id_col`` (null last), and the same in every later run of the plan.

    ``id_col`` itself serves where it is an integer, never null and never repeated (one job over the
    ids alone tells). Otherwise the rows are sorted and written to the shared folder with numbers, as numbers
    drawn anew by a recomputed task could differ. Rows of equal id are spread over tasks by the hash of all they hold.
    """
    kind = dict(df.dtypes)[id_col]
    if kind in ("bigint", "int", "smallint", "tinyint"):
        n, ids, distinct = (
            df.groupBy(F.col(id_col).alias("k")).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0)), F.count("k"))
            .first()
        )
        if n == ids == distinct:
            return df.withColumn(key, F.col(id_col).cast("bigint"))
    whole = F.xxhash64(*(F.col(f"`{c.replace('`', '``')}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t))
    return save(df.sort(F.col(id_col).asc_nulls_last(), whole).withColumn(key, F.monotonically_increasing_id()), "rows")


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` but those whose ``key`` stands in ``gone``, a written table of that column alone.

    Wide rows aren't shuffled for the sake of a few: the slots of the keys that go are broadcast, at most SLOTS of them whatever
    the input, and only rows whose slot is among them are joined to ``gone``. ``rows`` are read twice.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")
    slots = save(gone.select(slot.alias("_slot")).distinct(), "slots")
    dealt = rows.withColumn("_slot", slot)
    clear = dealt.join(F.broadcast(slots), "_slot", "left_anti")
    doubtful = dealt.join(F.broadcast(slots), "_slot", "left_semi").join(gone, key, "left_anti")
    return clear.unionByName(doubtful).drop("_slot")


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str | list[str], size_col: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``per_key`` (one row per key, none null, with its number of rows in ``size_col``).

    Keys that hold a thousandth of all rows or more are at most a thousand whatever the input, so
    those go by a broadcast join and never land in one task; the rest goes by a shuffle.
    Both inputs are read twice and should be written tables.
    """
    keys = [key] if isinstance(key, str) else key
    least = max(2, total // HOT_PARTS + 1)
    is_hot = F.col(size_col) >= F.lit(least)
    hot, cold = per_key.filter(is_hot), per_key.filter(~is_hot)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(*keys)), key, "left_anti").join(cold.hint("merge"), key)
    )
