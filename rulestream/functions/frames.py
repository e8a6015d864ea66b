"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_ns(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (group keys may be NULL).

    Output keeps the left key columns once, like ``join(on=keys)``.
    """
    r = right.select(*[right[k].alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])
