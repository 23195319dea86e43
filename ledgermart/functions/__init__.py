"""Column helpers (built-in Spark expressions only: all stay in codegen)."""

from ledgermart.functions.dates import (
    add_months_,
    generated_date,
    month_diff,
    month_from_parts,
    month_key,
    month_label,
    month_start,
    period_from_url,
    period_text,
    quarter_start,
    valid_period,
    year_start,
)
from ledgermart.functions.keys import surrogate_key
from ledgermart.functions.numbers import (
    MACRO,
    MONEY,
    decimal_text,
    differs,
    growth,
    locale_decimal_text,
    money,
    parse_locale_decimal,
    safe_divide,
)
from ledgermart.functions.text import (
    blank_to_null,
    code_prefix,
    first_text,
    flag,
    is_synthetic,
    join_set,
    lenient_bool,
    message_list,
    strict_bool,
    strip_all,
)
from ledgermart.functions.types import contract_type, type_name


def stage(df, mapping):
    """Typed 1:1 projection (P1): ``{output name: Column}``, no filter."""
    return df.select(*[c.alias(name) for name, c in mapping.items()])

__all__ = [
    "MACRO", "MONEY", "add_months_", "blank_to_null", "code_prefix", "stage", "contract_type", "decimal_text",
    "differs", "first_text", "flag", "generated_date", "growth", "is_synthetic", "join_set",
    "lenient_bool", "locale_decimal_text", "message_list", "money", "month_diff",
    "month_from_parts", "month_key", "month_label", "month_start", "parse_locale_decimal",
    "period_from_url", "period_text", "quarter_start", "safe_divide", "strict_bool",
    "strip_all", "surrogate_key", "type_name", "valid_period", "year_start",
]
