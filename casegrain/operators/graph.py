"""Undirected pairs with stable indices and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.functions.keys import ordered_pair, pair_key, uid_article, uid_case
from casegrain.operators.batches import total_index


def candidate_pairs(links: DataFrame) -> DataFrame:
    """Distinct undirected pairs (case_a_uid, case_b_uid, pair_key) of directed links, in numeric orientation; no loops."""
    p = links.where(F.col("src") != F.col("dst")).select(ordered_pair(F.col("src"), F.col("dst")).alias("p"))
    p = p.select(F.col("p.a").alias("case_a_uid"), F.col("p.b").alias("case_b_uid")).distinct()
    return p.withColumn("pair_key", pair_key(F.col("case_a_uid"), F.col("case_b_uid")))


ORDER = ["__aa", "__ac", "__ba", "__bc"]


def with_order(pairs: DataFrame) -> DataFrame:
    a, b = F.col("case_a_uid"), F.col("case_b_uid")
    return pairs.select("*", *[x.alias(n) for n, x in zip(ORDER, (uid_article(a), uid_case(a), uid_article(b), uid_case(b)), strict=True)])


def indexed_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` with pair_index: the position in the total numeric order, from 0.

    A global row number would pass all rows through one task, and one by article all of a hot article; the pairs are sorted by
    range instead, and the offsets of the ranges added.
    """
    return total_index(with_order(pairs), ORDER, "pair_index").select("pair_index", *pairs.columns)


def pair_problems(pairs: DataFrame) -> DataFrame:
    """Rows that break the pair contract, one row per problem."""
    a, b = F.col("case_a_uid"), F.col("case_b_uid")
    # structs with a null would compare too
    swapped = a.isNotNull() & b.isNotNull() & (F.struct(uid_article(b), uid_case(b)) <= F.struct(uid_article(a), uid_case(a)))
    checks = F.array_compact(
        F.array(
            F.when(F.col("pair_index").isNull() | (F.col("pair_index") < 0), "bad_index"),
            F.when(a.isNull() | b.isNull(), "missing_end"),
            F.when(swapped, "wrong_orientation"),
            F.when(~F.col("pair_key").eqNullSafe(pair_key(a, b)), "wrong_key"),
        )
    )
    return pairs.select("pair_index", F.explode(checks).alias("problem"))
