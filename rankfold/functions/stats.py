"""K4: Student-t two-sided p-value for a regression t statistic, as a column expression.

For whole degrees of freedom the distribution function is a finite sum in
the angle theta = atan(|t| / sqrt(df)): about df/2 terms, each the previous one
times a ratio, folded by ``aggregate`` in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value P(|T| >= |t|) for whole ``df`` of at least 1; null where t or df is null."""
    nu = df.cast("long")
    odd = nu % 2 == 1
    theta = F.atan(F.abs(t.cast("double")) / F.sqrt(nu.cast("double")))
    cos2 = F.cos(theta) * F.cos(theta)
    # terms: even df 1, 1/2 c^2, 3/8 c^4, ...; odd df c, 2/3 c^3, 8/15 c^5, ... (none for df = 1)
    n_terms = F.floor(nu / 2)
    one = F.lit(1.0)

    def add(acc: Column, j: Column) -> Column:
        i = j.cast("double")
        ratio = F.when(odd, 2 * i / (2 * i + 1)).otherwise((2 * i - 1) / (2 * i))
        term = acc["term"] * ratio * cos2
        return F.struct((acc["total"] + term).alias("total"), term.alias("term"))

    first = F.when(odd, F.cos(theta)).otherwise(one)
    steps = F.when(n_terms > 1, F.sequence(F.lit(1).cast("long"), n_terms - 1)).otherwise(
        F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(first.alias("total"), first.alias("term")), add, lambda acc: acc["total"])
    total = F.when(n_terms == 0, F.lit(0.0)).otherwise(total)
    inside = F.when(odd, (theta + F.sin(theta) * total) * (2.0 / 3.141592653589793)).otherwise(F.sin(theta) * total)
    p = F.greatest(F.lit(0.0), one - inside)
    return F.when(t.isNotNull() & (nu >= 1), p)
