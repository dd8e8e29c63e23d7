"""Exact conditional distinct counts without copying each row once per count.

A plain query with a dozen ``count(distinct case ...)`` expressions makes Spark copy every row once per
expression before the first shuffle. Here the conditions of a row become bits of one number. One
aggregation per (keys, id) ORs the bits, with map-side combine, so a hot id or a hot key is already
down to one row per task before anything is shuffled. A second aggregation counts the bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Distinct:
    """Distinct counts of one id: output name -> SQL condition, or None to count every non-null id."""

    id: str
    counts: dict[str, str | None] = field(default_factory=dict)

    def bits(self) -> str:
        return " | ".join(
            f"{1 << n}L" if condition is None else f"IF({condition}, {1 << n}L, 0L)"
            for n, condition in enumerate(self.counts.values())
        )


def distinct_counts(
    df: DataFrame, keys: dict[str, str], distincts: list[Distinct], sums: dict[str, str] | None = None
) -> DataFrame:
    """Distinct counts per key combination; every combination in ``df`` gets a row, as in GROUP BY.

    ``keys`` maps output names to SQL expressions. With several ids each row is tagged once per id, not once
    per count. ``sums`` adds plain integer sums to the same pass; they ride on the rows of the first id.
    """
    sums = sums or {}
    key_columns = [f"{expression} AS {name}" for name, expression in keys.items()]
    ids = []
    for tag, distinct in enumerate(distincts):
        riders = [f"'{name}', CAST({value if tag == 0 else 0} AS BIGINT)" for name, value in sums.items()]
        fields = [f"'_tag', {tag}", f"'_id', CAST({distinct.id} AS STRING)", f"'_bits', {distinct.bits()}", *riders]
        ids.append(f"named_struct({', '.join(fields)})")
    if len(ids) == 1:
        tagged = df.selectExpr(*key_columns, f"{ids[0]} AS _one").selectExpr(*keys, "_one.*")
    else:
        tagged = df.selectExpr(*key_columns, f"inline(array({', '.join(ids)}))")
    per_id = tagged.groupBy(*keys, "_tag", "_id").agg(*_all(["bit_or(_bits) AS _bits", *[f"sum({n}) AS {n}" for n in sums]]))
    counts = [
        f"count_if(_tag = {tag} AND _id IS NOT NULL AND (_bits & {1 << n}L) <> 0) AS {name}"
        for tag, distinct in enumerate(distincts)
        for n, name in enumerate(distinct.counts)
    ]
    totals = [f"coalesce(sum({name}), 0L) AS {name}" for name in sums]
    return per_id.groupBy(*keys).agg(*_all([*counts, *totals]))


def _all(expressions: list[str]):
    return [F.expr(e) for e in expressions]
