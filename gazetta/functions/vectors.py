"""Exact vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-9


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a norm is next to nothing."""
    n = norm(a) * norm(b)
    return F.when(n > TINY, dot(a, b) / n).otherwise(F.lit(0.0))


def parse_binary(data: Column) -> Column:
    """Vectors stored as a two-byte length and big-endian 32-bit floats; null where the length does not fit.

    Bits are taken apart by arithmetic: sign, exponent and fraction of each number.
    """
    number = lambda at, size: F.conv(F.hex(F.substring(data, at, F.lit(size))), 16, 10).cast("long")

    def real(i: Column) -> Column:
        bits = number(i * 4 + 3, 4)
        exponent, fraction = F.shiftright(bits, 23).bitwiseAND(F.lit(255)), bits.bitwiseAND(F.lit((1 << 23) - 1))
        size = F.when(exponent == 0, fraction * 2.0**-149).otherwise((1 + fraction * 2.0**-23) * F.pow(F.lit(2.0), exponent - 127))
        return F.when(bits >= 1 << 31, -size).otherwise(size).cast("float")

    n = number(F.lit(1), 2).cast("int")
    return F.when((n > 0) & (F.octet_length(data) == n * 4 + 2), F.transform(F.sequence(F.lit(0), n - 1), real))


def parse(text: Column) -> Column:
    return F.from_json(text, "array<float>")
