from plumbline.functions.columns import (
    absolute_offset,
    clamp,
    euclidean,
    fraction_threshold,
    nan_to_null,
    ratio,
    row_key,
    threshold_flag,
)
from plumbline.functions.moments import (
    adjusted_kurtosis,
    adjusted_skewness,
    jarque_bera,
    pearson,
    student_t_two_sided,
)

__all__ = [
    "absolute_offset",
    "adjusted_kurtosis",
    "adjusted_skewness",
    "clamp",
    "euclidean",
    "fraction_threshold",
    "jarque_bera",
    "nan_to_null",
    "pearson",
    "ratio",
    "row_key",
    "student_t_two_sided",
    "threshold_flag",
]
