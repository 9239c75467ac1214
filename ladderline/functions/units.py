"""Fixed-point money and sizes: price in millionths of a dollar, size in hundredths of a contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits after the point, and the largest value that a field holds.
PRICE_SCALE, QTY_SCALE = 6, 2
U32_MAX, U64_MAX, I64_MAX = 4294967295, 18446744073709551615, 9223372036854775807
DOLLAR = 1_000_000

_DECIMAL = r"^-?[0-9]+(\.[0-9]+)?$"


def _unscaled(text: Column, scale: int) -> Column:
    """Digits of the text as a whole number with `scale` decimals, as text with its sign."""
    whole = F.regexp_extract(text, r"^(-?[0-9]+)", 1)
    part = F.regexp_extract(text, r"\.([0-9]+)$", 1)
    return F.concat(whole, F.rpad(part, scale, "0"))


def parse_error(text: Column, scale: int, most: int, signed: bool = False) -> Column:
    """Null for a number that parses; else empty, not_numeric, too_many_decimals, negative or overflow.

    No sign but a leading minus, no exponent, no blanks; an unsigned field refuses the minus
    sign itself, so "-0" too.
    """
    n = _unscaled(text, scale).try_cast("decimal(38,0)")
    least = -most - 1 if signed else 0
    return (
        F.when(text.isNull() | (text == ""), F.lit("empty"))
        .when(~text.rlike(_DECIMAL), F.lit("not_numeric"))
        .when(F.length(F.regexp_extract(text, r"\.([0-9]+)$", 1)) > scale, F.lit("too_many_decimals"))
        .when(F.lit(not signed) & text.startswith("-"), F.lit("negative"))
        .when(n.isNull() | (n > F.lit(most).cast("decimal(38,0)")) | (n < F.lit(least).cast("decimal(38,0)")), F.lit("overflow"))
    )


def parse_scaled(text: Column, scale: int, most: int, signed: bool = False) -> Column:
    """The scaled whole number, null where ``parse_error`` is not."""
    n = _unscaled(text, scale).try_cast("decimal(38,0)")
    return F.when(parse_error(text, scale, most, signed).isNull(), n.try_cast("bigint"))


def parse_price(text: Column) -> Column:
    return parse_scaled(text, PRICE_SCALE, U32_MAX)


def parse_qty(text: Column) -> Column:
    return parse_scaled(text, QTY_SCALE, I64_MAX)


def parse_delta(text: Column) -> Column:
    return parse_scaled(text, QTY_SCALE, I64_MAX, signed=True)


def format_scaled(n: Column, scale: int) -> Column:
    """Exact decimal text of a scaled whole number: sign, whole part, all decimals."""
    unit = 10**scale
    a = F.abs(n)
    body = F.concat(((a - a % unit).cast("decimal(38,0)") / unit).cast("bigint").cast("string"), F.lit("."), F.lpad((a % unit).cast("string"), scale, "0"))
    return F.when(n < 0, F.concat(F.lit("-"), body)).otherwise(body)


def sum_or_null(n: Column) -> Column:
    """Sum of whole numbers, added up exactly; null where the total doesn't fit in 64 bits."""
    return F.sum(n.cast("decimal(19,0)")).try_cast("bigint")


def dollars(micro: Column) -> Column:
    return micro.cast("double") / F.lit(1e6)


def contracts(centi: Column) -> Column:
    return centi.cast("double") / F.lit(1e2)


def complement(micro: Column) -> Column:
    """What a yes costs where a no is bid at this price, at least 0."""
    return F.greatest(F.lit(DOLLAR) - micro, F.lit(0)).cast("bigint")


def mid(bid: Column, ask: Column) -> Column:
    """Whole-number midpoint, rounded down; null if a side is missing."""
    s = bid + ask
    return ((s - F.pmod(s, F.lit(2))) / 2).cast("bigint")


def spread(bid: Column, ask: Column) -> Column:
    return (ask - bid).cast("bigint")


def imbalance(yes_total: Column, no_total: Column) -> Column:
    """(yes - no) / (yes + no), null where both are 0."""
    total = yes_total + no_total
    return F.when(total != 0, (yes_total - no_total).cast("double") / total.cast("double"))
