"""Join helper for a right side on which one key may hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_splittable(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left outer join whose hot right-hand keys can still be cut into several tasks.

    AQE may split either side of an inner join but never the right side of a left
    outer join. So the matches are an inner join, and the left rows without a match
    are an anti join against the distinct keys, which partial aggregation has
    already shrunk before the shuffle. Both parts together are exactly the left join.

    The keys are compared null-safely against non-null right keys, which means the same
    but keeps the optimizer from filtering the left input of the inner part only: both
    parts read one shuffle of the left side instead of computing it twice.
    """
    keys = list(on)
    theirs = {k: f"_right_{k}" for k in keys}
    present = right.dropna(subset=keys).withColumnsRenamed(theirs)
    same = reduce(
        lambda a, b: a & b, [F.col(mine).eqNullSafe(F.col(other)) for mine, other in theirs.items()]
    )
    matched = left.join(present, same, "inner").drop(*theirs.values())
    seen = present.select(*theirs.values()).distinct()
    unmatched = left.join(seen, same, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
