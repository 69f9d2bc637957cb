"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from riskframe.functions.expr import (  # noqa: F401
    age_band,
    binary_flag,
    clip01,
    datediff_days,
    finite_or_null,
    keep_if,
    safe_div,
)
