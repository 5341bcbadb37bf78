"""DECIMAL(12,2) carried as base64 of the unscaled big-endian two's-complement integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.schema import AMOUNT

_BASE64 = "^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
# More than 64 bits, where every further byte only repeats the sign.
_PADDED = "^(?:00)+[0-7][0-9A-F]{15}$|^(?:FF)+[89A-F][0-9A-F]{15}$"


def decode_amount(text: Column) -> Column:
    """NULL for anything that is not strict base64 or does not fit the type."""
    # A NULL input runs through the rest, so no branch repeats the decoding.
    strict = F.when(text.rlike(_BASE64), text)
    digits = F.hex(F.try_to_binary(strict, F.lit("base64")))
    # Hex digits sort like their values, so '8' and above at the front is a set sign bit.
    sign = F.when(digits >= "8", F.lit("F" * 16)).otherwise(F.lit("0" * 16))
    word = F.substring(F.concat(sign, digits), -16, 16)
    fits = (F.length(digits) <= 16) | digits.rlike(_PADDED)
    # Adding a NULL instead of branching lets the digits be computed once per row.
    cents = F.conv(word, 16, -10).cast("bigint") + F.when(fits, F.lit(0))
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).try_cast(AMOUNT)


def encode_amount(amount: Column) -> Column:
    """Inverse of ``decode_amount``: shortest two's-complement bytes, base64."""
    cents = (amount.cast(AMOUNT) * 100).cast("bigint")
    digits = F.hex(cents)
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    positive = F.when(even >= "8", F.concat(F.lit("00"), even)).otherwise(even)
    negative = F.regexp_replace(digits, "^(?:FF)+(?=[89A-F])", "")
    return F.base64(F.unhex(F.when(cents < 0, negative).otherwise(positive)))
