"""Connected components of a link table by alternating star contractions.

Large-star: every node joins its larger neighbours to the smallest node it
sees. Small-star: every node joins itself and its smaller neighbours to the
smallest one. Repeated, the links become stars whose centre is the smallest
node of the component. Each step is a grouped minimum (combined before the
shuffle) and a join, which adaptive execution splits where a node has very
many links; every second step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links ``(u, v)`` with ``u > v``."""
    u, v = F.col("u"), F.col("v")
    if large:
        seen = links.select("u", "v").unionByName(links.select(v.alias("u"), u.alias("v")))
    else:
        seen = links.select("u", "v")
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    both = seen.join(least, "u")
    if large:
        out = both.where(v > u).select(v.alias("u"), F.col("m").alias("v"))
    else:
        out = both.where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(u > v).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` of every node that has a link ``(a, b)``.

    ``component`` is the smallest node reachable. Links of a node to itself
    and null ends are left out; no links give an empty table.
    """
    a, b = F.col("a"), F.col("b")
    now = saved(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .distinct(), f"{name}-links")

    def mark(df: DataFrame):
        r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        return r[0], r[1]

    was, step = None, 0
    while (is_now := mark(now)) != was and is_now[0]:
        was, step = is_now, step + 1
        now = saved(_star(_star(now, True), False), f"{name}-{step}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
