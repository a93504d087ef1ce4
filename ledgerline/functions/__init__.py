from ledgerline.functions.numeric import (
    annuity_payment,
    cap_above,
    floor_below,
    is_missing,
    kurtosis_corrected,
    month_difference,
    nan_to_null,
    quote_name,
    ratio_plus_one,
    skewness_corrected,
)
from ledgerline.functions.text import (
    iso_to_date,
    leading_integer,
    lookup,
    month_text_to_date,
    null_tokens_to_null,
    ordinal_position,
    numeric_text,
    percent_to_double,
    to_double,
)

__all__ = [
    "annuity_payment", "cap_above", "floor_below", "is_missing", "iso_to_date", "kurtosis_corrected",
    "leading_integer", "lookup", "month_difference", "month_text_to_date", "nan_to_null",
    "null_tokens_to_null", "numeric_text", "ordinal_position", "percent_to_double", "quote_name", "ratio_plus_one",
    "skewness_corrected", "to_double",
]
