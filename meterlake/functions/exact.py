"""Exact sums of doubles that do not depend on the order of addition.

A double is cut into its whole part and ``LIMBS`` pieces of ``LIMB_BITS`` fraction
bits; every piece is a whole number that a double holds exactly, so cutting loses nothing down to
2**-96 (all bits of a number of at least 1e-13). The pieces are summed as longs: partial sums combine
map-side, merge over panes or days, and give the same total on any partitioning and after any retry. The total is brought
back to one double at the end. Unlike a decimal of a fixed scale this does not round
the data, however many decimals a reading carries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.functions import columns as C

LIMB_BITS = 24
LIMBS = 4
BASE = 1 << LIMB_BITS


def limbs(x: Column | str) -> list[Column]:
    """Whole part and fraction pieces of a usable number (signed longs, toward zero); NULL for NaN, infinities
    and numbers beyond ``MAX_READING``."""
    x = F.col(x) if isinstance(x, str) else x
    rest = F.when(C.usable_reading(x), x)
    out = []
    for _ in range(LIMBS + 1):
        whole = rest.cast("long")
        out.append(whole)
        rest = (rest - whole.cast("double")) * F.lit(float(BASE))
    return out


def limb_sums(x: Column | str, prefix: str) -> list[Column]:
    """Aggregates ``<prefix>0 .. <prefix>4``: sums of the pieces (NULL where no number was usable)."""
    return [F.sum(p).alias(f"{prefix}{i}") for i, p in enumerate(limbs(x))]


def merged_limbs(prefix: str) -> list[Column]:
    """Aggregates that add up the sums of several groups."""
    return [F.sum(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range(LIMBS + 1)]


def _carried(parts: list[Column]) -> list[Column]:
    """Pieces with every fraction piece in [0, 2**24): what exceeds it is added to the piece above."""
    out, carry = [], F.lit(0).cast("long")
    for p in reversed(parts[1:]):
        p = p + carry
        out.append(p.bitwiseAND(F.lit(BASE - 1)))
        carry = F.shiftright(p, LIMB_BITS)
    return [parts[0] + carry, *reversed(out)]


def _sticky(*parts: Column) -> Column:
    """1 if a piece is not zero: what is left out must still tip a tie."""
    any_bit = parts[0]
    for p in parts[1:]:
        any_bit = any_bit.bitwiseOR(p)
    return F.when(any_bit != 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


def limb_total(prefix: str) -> Column:
    """The total of summed pieces, rounded once to the nearest double: one addition of two exactly held halves."""
    parts = [F.col(f"{prefix}{i}") for i in range(LIMBS + 1)]
    sign = F.when(_carried(parts)[0] < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    p0, p1, p2, p3, p4 = _carried([p * sign for p in parts])
    pair = lambda high, low: (high * F.lit(BASE) + low).cast("double")
    large = p0.cast("double") + pair(p1, p2.bitwiseOR(_sticky(p3, p4))) * F.lit(2.0 ** -48)
    medium = pair(p0, p1) * F.lit(2.0 ** -24) + pair(p2, p3.bitwiseOR(_sticky(p4))) * F.lit(2.0 ** -72)
    small = pair(p2, p3) * F.lit(2.0 ** -72) + p4.cast("double") * F.lit(2.0 ** -96)
    total = F.when(p0 >= F.lit(1 << 29), large).when((p0 != 0) | (p1 != 0), medium).otherwise(small)
    return total * sign.cast("double")
