"""Short upper-case codes packed as 4-byte numbers: one letter a byte, A is 1, 0 pads on the right."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decode(c: Column) -> Column:
    byte = lambda shift: F.shiftright(c.cast("long"), shift).bitwiseAND(F.lit(255))
    letter = lambda b: F.when(b == 0, F.lit("")).otherwise(F.char(b + 64))
    return F.concat(*(letter(byte(s)) for s in (24, 16, 8, 0)))


def encode(c: Column) -> Column:
    letter = lambda i: F.when(F.length(c) >= i, F.ascii(F.substring(c, i, 1)) - 64).otherwise(F.lit(0)).cast("long")
    return F.shiftleft(letter(1), 24) + F.shiftleft(letter(2), 16) + F.shiftleft(letter(3), 8) + letter(4)
