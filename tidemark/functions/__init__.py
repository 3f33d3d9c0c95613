"""Column-level building blocks: parsing, predicates, recoding."""

from tidemark.functions.parsing import decode_cp1252, parse_decimal, parse_integer, parse_month
from tidemark.functions.predicates import (
    has_padding,
    has_replacement_char,
    in_domain,
    in_period,
    is_blank,
    matches,
    not_numeric,
    outside_domain,
)
from tidemark.functions.recoding import (
    band,
    count_where,
    percent_where,
    ratio,
    ratio_of_sums,
    recode,
    row_hash,
    sum_where,
    unit_code,
    zero_fill,
)

__all__ = [
    "band",
    "count_where",
    "decode_cp1252",
    "has_padding",
    "has_replacement_char",
    "in_domain",
    "in_period",
    "is_blank",
    "matches",
    "not_numeric",
    "outside_domain",
    "parse_decimal",
    "parse_integer",
    "parse_month",
    "percent_where",
    "ratio",
    "ratio_of_sums",
    "recode",
    "row_hash",
    "sum_where",
    "unit_code",
    "zero_fill",
]
