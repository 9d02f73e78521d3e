from lendlens.functions.numeric import (
    hashed_int,
    hashed_order,
    hashed_uniform,
    numeric_columns,
    row_stats,
    safe_ratio,
    string_columns,
    vector_spread,
    vector_sum_abs,
    years,
    yeo_johnson,
)

__all__ = [
    "hashed_int",
    "hashed_order",
    "hashed_uniform",
    "numeric_columns",
    "row_stats",
    "safe_ratio",
    "string_columns",
    "vector_spread",
    "vector_sum_abs",
    "years",
    "yeo_johnson",
]
