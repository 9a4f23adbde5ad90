"""Decimal places of doubles as their exact binary value has them, ties to even: what a correctly rounded print or round gives.

A double is a whole number of up to 53 bits times a power of two. Times a power of ten that is a quotient of whole numbers,
which fit into Spark's decimals wherever the places asked for can show anything, so quotient and remainder decide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.functions.text import bind

#: Bits of a double's whole number.
MANTISSA = 52
WHOLE = "decimal(38,0)"


def _scaled(x: Column, digits: int) -> Column:
    """The whole number (bigint) nearest to |x| * 10^digits, for finite x of less than 2^52 in size; ties to even."""
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")

    def exact(e: Column) -> Column:
        """e: the power of two that size lies at or above."""
        mantissa = (size * F.pow(F.lit(2.0), (MANTISSA - e).cast("double"))).cast("bigint")
        shift = MANTISSA - e  # |x| = mantissa / 2^shift
        part = lambda s: F.pow(F.lit(2.0), F.greatest(F.lit(0), F.least(F.lit(62), s)).cast("double")).cast("bigint").cast(WHOLE)
        below = (part(shift) * part(shift - 62)).cast(WHOLE)
        above = (mantissa.cast("decimal(16,0)") * F.lit(10**digits).cast(f"decimal({digits + 1},0)")).cast(WHOLE)

        def nearest(both: Column) -> Column:
            q = F.call_function("div", both["above"], both["below"])
            twice = (both["above"] - (q.cast(WHOLE) * both["below"]).cast(WHOLE)) * F.lit(2).cast("decimal(1,0)")
            up = F.when(twice > both["below"], 1).when(twice == both["below"], q % 2).otherwise(0)
            return q + up.cast("bigint")

        return bind(F.struct(above.alias("above"), below.alias("below")), nearest)

    # a logarithm may be off next to a power of two
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    e = bind(guess, lambda g: F.when(power(g) > size, g - 1).when(power(g + 1) <= size, g + 1).otherwise(g))
    # beyond this shift |x| * 10^digits is less than a half
    return F.when(size < 0.4 * 10.0**-digits, F.lit(0).cast("bigint")).otherwise(bind(e, exact))


def _check(digits: int) -> None:
    if not 0 <= digits <= 15:
        raise ValueError("digits are from 0 to 15")


def round_exact(x: Column, digits: int) -> Column:
    """x (double) rounded to so many places (0 to 15) by its exact value, ties to even, as a double. Null stays null; what isn't finite, and numbers too large to have such places, stay as they are."""
    _check(digits)

    def rounded(v: Column) -> Column:
        near = _scaled(v, digits).cast("double") / F.lit(float(10**digits))
        # beyond 2^53 steps of the last place, doubles are further apart than these
        return F.when((F.abs(v) * float(10**digits) < 2.0**53) & (F.abs(v) < 2.0**MANTISSA), F.when(v < 0, -near).otherwise(near)).otherwise(v)

    return bind(x.cast("double"), rounded)


def fixed_exact(x: Column, digits: int) -> Column:
    """x (double) as text with so many places (0 to 15), rounded by its exact value, ties to even. Null stays null; infinities are `inf` and `-inf`, what isn't a number `nan`; of numbers of 2^63 and more the shortest digits that tell them from others are shown."""
    _check(digits)

    def shown(v: Column) -> Column:
        sign = F.when((v < 0) | (v.cast("string") == "-0.0"), "-").otherwise("")
        ten = F.lit(10**digits).cast("bigint")
        size = F.abs(v)
        whole = F.floor(size)
        parted = lambda k: F.concat((whole + F.call_function("div", k, ten)).cast("string"), F.lit("."), F.lpad((k % ten).cast("string"), digits, "0"))
        places = bind(_scaled(size - whole, digits), parted) if digits else _scaled(size, 0).cast("string")
        large = F.concat(F.coalesce(size.try_cast("bigint").cast("string"), size.try_cast(WHOLE).cast("string"), size.cast("string")), F.lit("." + "0" * digits if digits else ""))
        finite = F.when(size < 2.0**MANTISSA, places).otherwise(large)
        return F.when(F.isnan(v), "nan").when(size == float("inf"), F.concat(sign, F.lit("inf"))).otherwise(F.concat(sign, finite))

    return F.when(x.isNotNull(), bind(x.cast("double"), shown))
