"""Aggregates.

All of them combine on the map side before the shuffle, so a key with very many rows sends at
most one partial row per task. Distinct counts shuffle by key and value together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard.functions.decode import or_zero
from scanyard.operators.joins import one_per_key
from scanyard.operators.projection import as_text


def where_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
              condition: Column) -> DataFrame:
    """Groups whose aggregates meet a condition."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()]).where(condition)


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    """Several distinct counts in one grouping: {name: column}."""
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(n) for n, c in counted.items()])


def count_distinct_through(parents: DataFrame, children: DataFrame, keys: Sequence[str],
                           via: str, child: str, name: str,
                           kind: str | None = None, unique: bool = False) -> DataFrame:
    """Distinct children per parent, where ``via`` links the two many-to-many.

    A child that occurs under one link only is counted per link first, so the join carries one
    row per link however many children or parents it has. Children found under several links
    may reach a parent twice. Those with the same set of links reach the same parents, so one of
    them stands for all; sets are told apart by 128 bits of their links' hashes.
    With ``kind``, children of several kinds are counted apart in one go. ``unique`` says that no
    two rows of ``children`` are alike, so they need not be compared.
    Parents without children are not listed.
    """
    kinds = [kind] if kind else []
    links = parents.select(*keys, via).where(F.col(via).isNotNull()).distinct()
    pairs = children.select(*kinds, via, child).where(
        F.col(via).isNotNull() & F.col(child).isNotNull())
    if not unique:
        pairs = pairs.distinct()
    hashes = [F.bit_xor(F.xxhash64(via, F.lit(seed))).alias(f"_set{seed}") for seed in (1, 2)]
    each = pairs.groupBy(*kinds, child).agg(
        F.count("*").alias("_links"), F.min(via).alias(via), *hashes)
    single = each.where("_links = 1").groupBy(*kinds, via).agg(F.count("*").alias("_n"))
    sets = one_per_key(each.where("_links > 1"), [*kinds, "_links", "_set1", "_set2"],
                       F.min(child).alias(child), F.count("*").alias("_n"))
    shared = pairs.join(sets.select(*kinds, child, "_n"), [*kinds, child])
    once = links.join(single, via).select(*keys, *kinds, "_n")
    many = links.join(shared, via).select(*keys, *kinds, child, "_n").distinct().select(
        *keys, *kinds, "_n")
    return once.unionByName(many).groupBy(*keys, *kinds).agg(F.sum("_n").alias(name))


def sum_case(groups: DataFrame, keys: Sequence[str], label: str, measure: str,
             names: Sequence[str]) -> DataFrame:
    """Cross-tab: one column per label, summed; absent labels give 0."""
    wide = [or_zero(F.sum(F.when(F.col(label) == n, F.col(measure)))).alias(n) for n in names]
    return groups.groupBy(*keys).agg(or_zero(F.sum(measure)).alias("ImageCount"), *wide)


def rollup_total(df: DataFrame, key: str, measures: Sequence[str], label: str = "Total",
                 always: bool = False) -> DataFrame:
    """Sums per key and one total row.

    The total row is told apart by its grouping level, so a NULL key stays NULL. Without rows
    there is no total, unless ``always`` asks for one (of NULLs).
    """
    sums = [F.sum(f"`{m}`").alias(m) for m in measures]
    if not always:
        rolled = df.rollup(key).agg(F.grouping(key).alias("_level"), *sums)
        named = F.when(F.col("_level") == 1, label).otherwise(F.col(key).cast("string"))
        return rolled.select(named.alias(key), *[F.col(f"`{m}`") for m in measures])
    rows = df.groupBy(F.col(key).cast("string").alias(key)).agg(*sums)
    return rows.unionByName(df.agg(F.lit(label).alias(key), *sums))


def mean_pivot(df: DataFrame, keys: Sequence[str], values: Sequence[str],
               missing: str = "-") -> DataFrame:
    """Mean of each value per complete key, as text; value columns in name order.

    Rows with a NULL in any key are left out, as are groups without any value at all.
    """
    complete = df.dropna(subset=list(keys))
    ordered = sorted(values)
    means = complete.groupBy(*keys).agg(*[F.avg(f"`{v}`").alias(v) for v in ordered])
    return means.dropna(how="all", subset=ordered).select(
        *keys,
        *[F.coalesce(F.col(f"`{v}`").cast("string"), F.lit(missing)).alias(v) for v in ordered],
    )


def flag_max(df: DataFrame, cols: Sequence[str], key: str | None = None,
             total: str = "Total") -> DataFrame:
    """Mark, per column, the rows that hold the column's maximum; all rows are compared.

    With ``key``, the total row is marked too, in ``is total``.
    """
    flags = {
        f"{c} is max": F.col(f"`{c}`") == df.agg(F.max(f"`{c}`")).scalar() for c in cols
    }
    if key is not None:
        flags["is total"] = F.col(key).eqNullSafe(total)
    return df.withColumns(flags)


def column_widths(df: DataFrame, null_text: str = "None") -> DataFrame:
    """Per column, the width that fits its longest text and its header."""
    text = as_text(df)
    widest = text.agg(*[
        F.greatest(
            F.lit(len(c)),
            F.coalesce(F.max(F.length(F.coalesce(F.col(f"`{c}`"), F.lit(null_text)))), F.lit(0)),
        ).alias(c) for c in df.columns
    ])
    return widest.unpivot([], widest.columns, "column", "width")
