"""Statistical helper expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Abramowitz & Stegun 7.1.26 rational approximation of erf
# (absolute error below 1.5e-7), and the two-sided 95% normal quantile.
AS_P = 0.3275911
AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
Z_95 = 1.959963984540054


def erf_nonneg(x) -> Column:
    """erf(x) for x >= 0 by A&S 7.1.26 (Horner form)."""
    x = as_col(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(AS_P) * x)
    a1, a2, a3, a4, a5 = AS_A
    poly = t * (F.lit(a1) + t * (F.lit(a2) + t * (F.lit(a3) + t * (F.lit(a4) + t * F.lit(a5)))))
    return F.lit(1.0) - poly * F.exp(-(x * x))


def two_sided_probability(z) -> Column:
    """P(|N(0,1)| < |z|) = 2 Phi(|z|) - 1 = erf(|z| / sqrt 2)."""
    return erf_nonneg(F.abs(as_col(z)) / F.lit(2.0 ** 0.5))


def two_sided_probability_sql(z: str) -> str:
    """SQL text of ``two_sided_probability`` for an expression ``z``."""
    x = f"(abs({z}) / {2.0 ** 0.5!r}D)"
    t = f"(1.0D / (1.0D + {AS_P!r}D * {x}))"
    a1, a2, a3, a4, a5 = (f"{a!r}D" for a in AS_A)
    poly = f"{t} * ({a1} + {t} * ({a2} + {t} * ({a3} + {t} * ({a4} + {t} * {a5}))))"
    return f"(1.0D - {poly} * exp(-({x} * {x})))"
