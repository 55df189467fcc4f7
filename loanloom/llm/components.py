"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import cut


def smallest_reachable(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    Alternating star steps: every node points its larger neighbours, then its smaller
    ones, at the smallest node it knows, until nothing changes. Each step is one
    combined minimum and one join, its result cut in the shared folder; the number of
    steps grows with the logarithm of a component's size. Links may repeat or be loops;
    links with a null end are left out. An empty table gives an empty result.
    """
    pairs = links.selectExpr(f"greatest({a}, {b}) AS u", f"least({a}, {b}) AS v").where(
        f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}"
    )
    pairs = cut(pairs.distinct())
    before = _signature(pairs)
    while True:
        both = pairs.union(pairs.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.expr("least(u, min(v)) AS m"))
        large = (
            both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        )
        lowest = large.groupBy("u").agg(F.expr("min(v) AS m"))
        small = large.join(lowest, "u").selectExpr("CASE WHEN v = m THEN u ELSE v END AS u", "m AS v")
        pairs = cut(small.where("u <> v").distinct())
        after = _signature(pairs)
        if after == before:
            break
        before = after
    return pairs.selectExpr("u AS node", "v AS component").union(
        pairs.selectExpr("v AS node", "v AS component").distinct()
    )


def _signature(pairs: DataFrame) -> tuple:
    """One row that tells two sets of links apart."""
    return tuple(
        pairs.selectExpr(
            "count(*)",
            "sum(CAST(xxhash64(u, v) AS DECIMAL(38, 0)))",
            "bit_xor(xxhash64(v, u))",
        ).first()
    )
