"""Numbers and tag text. Bad input gives null instead of failing the job under ANSI mode."""

import re
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.fixed import TAG_QUOTE, TAG_SEPARATOR

# A plain decimal that starts with its point, after blanks and a sign; digits after a point at the end.
WITHOUT_WHOLE_PART = r"^([\x00-\x20]*[+-]?)(?=\.[0-9]*[\x00-\x20]*$)"
DECIMALS = r"(?<=[0-9])\.[0-9]*(?=[\x00-\x20]*$)"


def to_long(text):
    """Text to long: decimal text is cut to its whole part, other text gives null.

    The patterns are for decimals only: text that the plain cast takes never meets them.
    """
    text = F.col(text) if isinstance(text, str) else text
    whole = F.regexp_replace(text, WITHOUT_WHOLE_PART, "$10")
    return F.coalesce(text.try_cast("long"), F.regexp_replace(whole, DECIMALS, "").try_cast("long"))


def ratio(numerator, denominator):
    """Quotient as double; null where the denominator is zero."""
    return F.try_divide(numerator, denominator)


# A quotient of two longs lies within these powers of two, or is zero.
LEAST_POWER, STEPS = -63, 1 << 52
LONGS = 10**20


def quotient_order(quotient):
    """A whole number in the order of a quotient of two longs, as decimal(20): equal only for equal doubles.

    The power of two below the size and the 52 bits of what is left of it, which are the bits of the double.
    """
    quotient = F.col(quotient) if isinstance(quotient, str) else quotient
    size = F.abs(quotient)
    rough = F.floor(F.log2(size))
    two = F.lit(2.0)
    power = rough - F.when(F.pow(two, rough) > size, 1).otherwise(0) + F.when(F.pow(two, rough + 1) <= size, 1).otherwise(0)
    rest = (size / F.pow(two, power) - 1) * STEPS
    order = F.when(size == 0, 0).otherwise((power - LEAST_POWER + 1) * STEPS + rest.cast("long"))
    return F.when(quotient < 0, -order).otherwise(order).cast("decimal(20,0)")


def pair_order(quotient, number):
    """One decimal in the order of (quotient of longs, long), nulls of either first; it combines in hash aggregates,
    where a struct would be sorted."""
    first = F.coalesce(quotient_order(quotient), F.lit(-9 * 10**17).cast("decimal(20,0)"))
    second = F.coalesce(F.col(number).cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(0).cast("decimal(20,0)"))
    return (first * F.lit(Decimal(LONGS))).cast("decimal(38,0)") + second


def number_of_pair(order):
    """The long of a pair's order."""
    second = F.pmod(F.col(order), F.lit(Decimal(LONGS)))
    return F.when(second > 0, (second - F.lit(Decimal(2**63 + 1))).cast("long"))


def split_tags(text):
    """Tag text to an array, quotes removed. Empty text holds one empty tag."""
    return F.split(F.replace(text, F.lit(TAG_QUOTE), F.lit("")), re.escape(TAG_SEPARATOR))


def spread(values):
    """Largest minus smallest element of an array."""
    return F.array_max(values) - F.array_min(values)
