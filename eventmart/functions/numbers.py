"""Numbers: dirty text, rounding, money and how numbers are written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.functions.times import column
from eventmart.functions.values import TAX_RATE


def blank_to_null(text: Column | str) -> Column:
    """Trim all white space at both ends; null for what is then empty."""
    return F.nullif(F.btrim(column(text).cast("string"), F.lit(" \t\n\r\f\v")), F.lit(""))


def premium_value(text: Column | str) -> Column:
    """Premium as a number; null if it is missing, blank or no number."""
    return blank_to_null(text).try_cast("double")


def half_even(value: Column | str, digits: int = 0) -> Column:
    """Round with ties to the even neighbour, the rule for binary floats here."""
    return F.bround(column(value), digits)


def number_text(name: str) -> str:
    """SQL for a number as text without exponent, trailing zeros or a bare point."""
    plain = f"cast(`{name}` as string)"
    text = f"if(instr({plain}, 'E') > 0, cast(cast(`{name}` as decimal(38,6)) as string), {plain})"
    return (f"if(instr({text}, '.') > 0, trim(TRAILING '.' FROM trim(TRAILING '0' FROM {text})), "
            f"{text})")


def money(value: Column | str) -> Column:
    return column(value).cast("decimal(18,2)")


def exact_sum(value: Column | str) -> Column:
    """Sum of money in decimals, so that the order of the addends cannot matter."""
    return F.sum(money(value)).cast("double")


def price_parts(premium: Column | str, rate: Column | str) -> dict[str, Column]:
    """Discount, tax and net amount of a premium, each rounded to two places."""
    gross = F.coalesce(money(premium), F.lit(0).cast("decimal(18,2)"))
    discount = F.round(gross * column(rate).cast("decimal(6,4)"), 2).cast("decimal(18,2)")
    tax = F.round((gross - discount) * F.lit(TAX_RATE).cast("decimal(3,2)"), 2).cast(
        "decimal(18,2)")
    return {
        "discount_amount": discount,
        "tax_amount": tax,
        "net_amount": (gross - discount + tax).cast("decimal(18,2)"),
    }
