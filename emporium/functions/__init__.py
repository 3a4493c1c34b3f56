"""Scalar helpers: exact money and ratios, time buckets, seeded picks."""

from emporium.functions.exact import (cents, exact_mean, int_div, money, percent,
                                      round_money_mean, round_ratio)
from emporium.functions.picks import seeded_key, seeded_uniform
from emporium.functions.predicates import (between_filter, eq_filter, ilike_match, in_list,
                                           late_flag, like_prefix, not_null, range_cmp)
from emporium.functions.text import or_default, padded_id
from emporium.functions.time import (date_literal, days_between, format_ts, micros_between,
                                     month_start, seconds_between, ts_literal,
                                     year_range)

__all__ = [
    "cents", "exact_mean", "int_div", "money", "percent", "round_money_mean",
    "round_ratio", "seeded_key", "seeded_uniform", "date_literal",
    "days_between", "micros_between", "month_start", "seconds_between",
    "ts_literal", "year_range", "format_ts", "or_default", "padded_id",
    "between_filter", "eq_filter", "ilike_match", "in_list", "late_flag", "like_prefix",
    "not_null", "range_cmp",
]
