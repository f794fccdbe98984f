"""Two-tailed p-values of Student's t as plain expressions.

With theta = atan(|t| / sqrt(df)) the distribution function is a finite sum of
powers of cos(theta): no table, no iteration and no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def p_value_sql(t: str, df: int) -> str:
    """SQL for the p-value of the expression t with df degrees of freedom; null where t is."""
    theta, c = f"atan(abs({t}) / sqrt({df}e0))", f"cos(atan(abs({t}) / sqrt({df}e0)))"
    weight, terms = 1.0, []
    if df % 2:
        for power in range(1, df - 1, 2):
            if power > 1:
                weight *= (power - 1) / power
            terms.append(f"{weight!r}e0 * power({c}, {power})")
        inner = f"{theta} + sin({theta}) * ({' + '.join(terms)})" if terms else theta
        return f"(1e0 - 2e0 / pi() * ({inner}))"
    for power in range(0, df - 1, 2):
        if power:
            weight *= (power - 1) / power
        terms.append(f"{weight!r}e0 * power({c}, {power})" if power else "1e0")
    return f"(1e0 - sin({theta}) * ({' + '.join(terms)}))"


def p_value(t: Column | str, df: Column | str) -> Column:
    """p-value of t with any whole number of degrees of freedom; null where t is or df is below 1.

    The finite sum is a fold over df / 2 terms, each the one before times a ratio and the squared cosine.
    """
    t, df = (F.col(x) if isinstance(x, str) else x for x in (t, df))
    theta = F.atan(F.abs(t) / F.sqrt(df))
    c, odd = F.cos(theta), df % 2
    first = F.when(odd == 0, F.lit(1.0)).when(df > 1, c).otherwise(F.lit(0.0))
    steps = F.floor(df / 2).cast("int") - 1
    terms = F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    whole = F.aggregate(
        terms, F.struct(first.alias("term"), first.alias("sum")),
        lambda s, k: F.struct((s["term"] * (2 * k - 1 + odd) / (2 * k + odd) * c * c).alias("term"), (s["sum"] + s["term"] * (2 * k - 1 + odd) / (2 * k + odd) * c * c).alias("sum")),
        lambda s: s["sum"],
    )
    inner = F.sin(theta) * whole
    return F.when(df >= 1, 1 - F.when(odd == 0, inner).otherwise((theta + inner) * 2 / F.pi()))
