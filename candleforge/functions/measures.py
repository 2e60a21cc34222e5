"""Amounts, ratios and the order of trades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Larger than the number of bigint values, so that time always outweighs the id.
ID_SPAN = 20_000_000_000_000_000_000

# Amounts below this fit 18 digits, a machine word.
NARROW = 10_000_000_000

# Bits of an id that fit a long beside the microseconds of an hour.
ID_BITS = 31
ID_MASK = (1 << ID_BITS) - 1


def notional(price: Column, quantity: Column, exact: bool = True) -> Column:
    """Traded value of one row.

    Exact mode multiplies 18-digit operands, which keeps all 16 decimals; it is for
    operands below ``NARROW``, others take ``wide_notional``. Otherwise decimal(38,8)
    operands are multiplied and each product is rounded to six decimals.
    """
    operand = "decimal(18,8)" if exact else "decimal(38,8)"
    return price.cast(operand) * quantity.cast(operand)


def is_narrow(price: Column, quantity: Column) -> Column:
    """Whether both operands fit 18 digits."""
    return (price < NARROW) & (quantity < NARROW)


def wide_notional(price: Column, quantity: Column) -> Column:
    """Exact product of positive decimal(38,8) operands, null from about 10^21 on.

    Whole and fractional parts are multiplied one by one, so no product is rounded; the types
    are such that neither is a sum.
    """
    parts = []
    for operand in (price, quantity):
        whole = F.floor(operand)
        rest = operand % F.lit(1).cast("decimal(1,0)")
        parts.append((whole.try_cast("decimal(18,0)"), rest.cast("decimal(8,8)")))
    (p, p_rest), (q, q_rest) = parts
    return (p * q).try_cast("decimal(21,0)") + (p * q_rest + p_rest * q + p_rest * q_rest)


def whole_sum(amount: str | Column) -> Column:
    """Sum that is null, not partial or an error, when a value is null or the sum too large."""
    return F.when(F.count(amount) == F.count("*"), F.try_sum(amount))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else null."""
    return F.when(denominator > 0, numerator / denominator)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals, exact half-up rounding."""
    return F.round(F.lit(100).cast("decimal(3,0)") * part / whole, 2)


def trade_order(time: Column, trade_id: Column) -> Column:
    """One exact number ordering trades by time, then id, over all times and ids.

    Wide decimals are slow to compare; use it on aggregated rows.
    """
    micros = F.unix_micros(time).cast("decimal(19,0)")
    span = F.lit(str(ID_SPAN)).cast("decimal(20,0)")
    return (micros * span + trade_id.cast("decimal(19,0)")).cast("decimal(38,0)")


def id_block(trade_id: Column) -> Column:
    """The upper bits of an id; ids of one block differ in ``ID_BITS`` bits only."""
    return F.shiftright(trade_id, ID_BITS)


def position(time: Column, hour: Column, trade_id: Column) -> Column:
    """A long ordering the trades of one hour and id block by time, then id.

    Microseconds of an hour take 32 bits, which leaves 31 for the id.
    """
    offset = F.unix_micros(time) - F.unix_micros(hour)
    return F.shiftleft(offset, ID_BITS).bitwiseOR(trade_id.bitwiseAND(F.lit(ID_MASK)))


def position_time(hour: Column, place: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(hour) + F.shiftright(place, ID_BITS))


def position_id(block: Column, place: Column) -> Column:
    return F.shiftleft(block, ID_BITS).bitwiseOR(place.bitwiseAND(F.lit(ID_MASK)))
