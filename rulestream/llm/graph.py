"""Connected components of an undirected link table, by alternating large-star and small-star rounds.

Every round is two hash joins and two aggregations over the links; nothing is collected except a checksum of the
link table that tells when a round changed nothing.  A round's table is read in as many tasks as its links need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import cut


LINKS_PER_TASK = 1 << 18


def _sum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(u % 1000003 as bigint))")).first())


def _dealt(e: DataFrame, links: int) -> DataFrame:
    return e.coalesce(max(1, -(-links // LINKS_PER_TASK)))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id that occurs in a link; component_id is the smallest reachable id.

    ``a`` and ``b`` hold integers; links with a null end or with equal ends are ignored; repeated links count once.
    """
    x, y = F.col(a).cast("bigint"), F.col(b).cast("bigint")
    e = cut(links.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    seen = _sum(e)
    while seen[0]:
        e = _dealt(e, seen[0])
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = _sum(e)
        if now == seen:
            break
        seen = now
    e = _dealt(e, seen[0])
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)
