"""Reusable column expressions (built-in Spark functions only)."""

from carelake.functions.columns import (  # noqa: F401
    integral_key,
    iso_date_text,
    lenient_double,
    month_of,
    non_negative_amount,
    number_or_zero,
    safe_bigint,
    strip_ws,
)
