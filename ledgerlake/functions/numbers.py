"""Exact numbers: hex words, unit scaling, money products, deterministic sums.

Everything stays in JVM expressions. Raw integers and scaled values travel as
plain text, because a 256-bit word does not fit a 38-digit decimal; arithmetic
on them is exact for any length.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

from ledgerlake.functions.text import strip

WHOLE = "decimal(38,0)"

_BASE_DIGITS = 28
_LIMB_DIGITS = 8


def _hex_limb(text: Column) -> Column:
    return F.conv(text, 16, 10).cast(WHOLE)


def _two_limbs(digits: Column) -> Column:
    """Up to 30 hex digits: two limbs of 15 digits, each below 2^60."""
    padded = F.lpad(digits, 30, "0")
    high = _hex_limb(F.substring(padded, 1, 15))
    low = _hex_limb(F.substring(padded, 16, 15))
    return (high * F.lit(Decimal(16**15)) + low).cast("string")


def _many_limbs(digits: Column) -> Column:
    """Any length: fold 8-digit limbs into groups of 28 decimal digits."""
    base = F.lit(Decimal(10**_BASE_DIGITS)).cast(WHOLE)
    shift = F.lit(Decimal(16**_LIMB_DIGITS)).cast(WHOLE)
    count = F.ceil(F.length(digits) / _LIMB_DIGITS).cast("int")
    padded = F.lpad(digits, count * _LIMB_DIGITS, F.lit("0"))
    limbs = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: _hex_limb(F.substring(padded, i * _LIMB_DIGITS + 1, F.lit(_LIMB_DIGITS))),
    )

    def push(groups: Column, limb: Column) -> Column:
        start = F.struct(limb.alias("carry"), F.array().cast(f"array<{WHOLE}>").alias("done"))

        def step(state: Column, group: Column) -> Column:
            total = (group * shift + state["carry"]).cast(WHOLE)
            rest = (total % base).cast(WHOLE)
            return F.struct(
                F.floor((total - rest) / base).cast(WHOLE).alias("carry"),
                F.concat(state["done"], F.array(rest)).alias("done"),
            )

        def close(state: Column) -> Column:
            return F.when(state["carry"] > 0, F.concat(state["done"], F.array(state["carry"]))).otherwise(
                state["done"]
            )

        return F.aggregate(groups, start, step, close)

    zero = F.array(F.lit(Decimal(0)).cast(WHOLE))
    groups = F.aggregate(limbs, zero, push)
    joined = F.array_join(
        F.transform(F.reverse(groups), lambda g: F.lpad(g.cast("string"), _BASE_DIGITS, "0")), ""
    )
    return F.ltrim(joined, F.lit("0"))


def once(col: Column, use: Callable[[Column], Column]) -> Column:
    """``use(col)`` with ``col`` computed a single time, however often ``use`` names it.

    A plain expression repeats its input wherever it is named, and does so again
    at every level it is nested in.
    """
    return F.transform(F.array(col), use)[0]


def _from_digits(digits: Column) -> Column:
    length = F.length(digits)
    return (
        F.when(length == 0, F.lit("0"))
        .when(length <= 15, F.conv(digits, 16, 10))
        .when(length <= 30, _two_limbs(digits))
        .when(length > 30, _many_limbs(digits))
    )


def _decode(text: Column) -> Column:
    """Clean lower-case text; anything but hex digits (after an optional 0x) gives null."""
    digits = F.when(text.rlike("^(0x)?[0-9a-f]+$"), F.ltrim(text, F.lit("0x")))
    return once(digits, _from_digits)


def hex_to_decimal(col: Column) -> Column:
    """Hex text of any length, with or without ``0x``, as exact decimal digits.

    Blank, a bare ``0x`` and text that is not hex give null.
    """
    return once(F.lower(strip(col)), _decode)


def integer_text(col: Column) -> Column:
    """Hex text (marked by 0x) decoded, any other text as it is, blank as null."""
    decode = lambda text: F.when(text.startswith("0x"), _decode(text)).otherwise(F.nullif(text, F.lit("")))
    return once(F.lower(strip(col)), decode)


def to_bigint(col: Column) -> Column:
    """Block numbers and the like: hex or decimal text as bigint, else null."""
    return integer_text(col).try_cast("bigint")


def unit_scale_text(digits: Column, decimals: Column) -> Column:
    """Divide whole-number text by ``10^decimals`` by moving the point; exact for any length, no trailing zeros."""

    def move(state: Column) -> Column:
        text, places = state["text"], state["places"]
        padded = F.lpad(text, F.greatest(F.length(text), places + 1), F.lit("0"))
        whole = F.left(padded, F.length(padded) - places)
        return F.rtrim(F.rtrim(F.concat(whole, F.lit("."), F.right(padded, places)), F.lit("0")), F.lit("."))

    plain = F.when(digits.rlike("^[0-9]+$"), F.regexp_replace(digits, "^0+(?=[0-9])", ""))
    return once(F.struct(plain.alias("text"), decimals.cast("int").alias("places")), move)


def _unsigned(text: Column) -> Column:
    return F.ltrim(text, F.lit("-"))


def _signed(text: Column, negative: Column) -> Column:
    return F.when(negative & text.rlike("[1-9]"), F.concat(F.lit("-"), text)).otherwise(text)


def _places(text: Column) -> Column:
    """Number of decimals of a plain number."""
    point = F.instr(text, ".")
    return F.when(point > 0, F.length(text) - point).otherwise(F.lit(0))


def shift_point(text: Column, places: Column) -> Column:
    """A plain number divided by ``10^places``, exact for any length."""
    digits = F.replace(_unsigned(text), F.lit("."), F.lit(""))
    return _signed(unit_scale_text(digits, _places(text) + places.cast("int")), text.startswith("-"))


def wei_to_units(col: Column) -> Column:
    """A movement value: hex is a count of 10^-18 units, other text is already in units. Exact plain text."""
    scale = lambda text: F.when(text.startswith("0x"), unit_scale_text(_decode(text), F.lit(18))).otherwise(
        plain_decimal(text)
    )
    return once(F.lower(strip(col)), scale)


_FACTOR_DIGITS = 14


def _limbs(digits: Column) -> Column:
    """Digit text as limbs of 14 digits, the lowest first."""
    count = F.ceil(F.length(digits) / _FACTOR_DIGITS).cast("int")
    padded = F.lpad(digits, count * _FACTOR_DIGITS, F.lit("0"))
    limb = lambda i: F.substring(padded, (count - 1 - i) * _FACTOR_DIGITS + 1, F.lit(_FACTOR_DIGITS)).cast(WHOLE)
    return F.transform(F.sequence(F.lit(0), count - 1), limb)


def _carried(sums: Column, limb_digits: int) -> Column:
    """Digits of a number given by its limbs, the lowest first; limbs may hold more than their digits, or be negative."""
    base = F.lit(Decimal(10**limb_digits)).cast(WHOLE)
    start = F.struct(F.lit(Decimal(0)).cast(WHOLE).alias("carry"), F.lit("").alias("text"))

    def step(state: Column, limb: Column) -> Column:
        total = (limb + state["carry"]).cast(WHOLE)
        low = F.pmod(total, base).cast(WHOLE)
        return F.struct(
            ((total - low) / base).cast(WHOLE).alias("carry"),
            F.concat(F.lpad(low.cast("string"), limb_digits, "0"), state["text"]).alias("text"),
        )

    whole = lambda state: F.concat(F.when(state["carry"] == 0, "").otherwise(state["carry"].cast("string")), state["text"])
    return F.aggregate(sums, start, step, whole)


def _digit_product(pair: Column) -> Column:
    """Product of two digit texts of any length, limb by limb."""
    left, right = pair["left"], pair["right"]
    zero = F.lit(Decimal(0)).cast(WHOLE)

    def place(k: Column) -> Column:
        parts = F.transform(right, lambda limb, j: F.coalesce((limb * F.get(left, k - j)).cast(WHOLE), zero))
        return F.aggregate(parts, zero, lambda total, part: (total + part).cast(WHOLE))

    return _carried(F.transform(F.sequence(F.lit(0), F.size(left) + F.size(right) - 2), place), _FACTOR_DIGITS)


def exact_amount(value: Column, price: Column) -> Column:
    """``value * price`` of two plain numbers as exact plain text; any length, no rounding."""

    def multiply(pair: Column) -> Column:
        value, price = pair["value"], pair["price"]
        left, right = (F.replace(_unsigned(x), F.lit("."), F.lit("")) for x in (value, price))
        # Products of up to 38 digits are one decimal multiplication; the limbs give the same digits.
        short = F.length(left) + F.length(right) <= 38
        quick = F.try_multiply(left.try_cast(WHOLE), right.try_cast(WHOLE)).cast("string")
        limbs = once(F.struct(_limbs(left).alias("left"), _limbs(right).alias("right")), _digit_product)
        digits = F.when(short, quick).otherwise(limbs)
        scaled = unit_scale_text(digits, _places(value) + _places(price))
        return _signed(scaled, value.startswith("-") != price.startswith("-"))

    texts = F.struct(plain_decimal(value).alias("value"), plain_decimal(price).alias("price"))
    return once(texts, lambda pair: F.when(pair["value"].isNotNull() & pair["price"].isNotNull(), multiply(pair)))


def add_text(left: Column, right: Column) -> Column:
    """Exact sum of two plain numbers that are not negative."""

    def add(pair: Column) -> Column:
        places = F.greatest(_places(pair["left"]), _places(pair["right"]))
        raised = lambda x: F.concat(F.replace(x, F.lit("."), F.lit("")), F.repeat(F.lit("0"), places - _places(x)))
        width = F.greatest(F.length(raised(pair["left"])), F.length(raised(pair["right"])))
        wide = lambda x: _limbs(F.lpad(raised(x), width, F.lit("0")))
        sums = F.zip_with(wide(pair["left"]), wide(pair["right"]), lambda a, b: (a + b).cast(WHOLE))
        return unit_scale_text(_carried(sums, _FACTOR_DIGITS), places)

    return once(F.struct(left.alias("left"), right.alias("right")), add)


_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,5})?$"


def plain_decimal(col: Column) -> Column:
    """A number, or a text that is one, as text without exponent and without trailing zeros; any length, exact.

    Text that is no number, or with an exponent beyond five digits, gives null.
    """

    def show(text: Column) -> Column:
        simple = text.rlike("^(?:0|[1-9][0-9]*)(?:\\.[0-9]*[1-9])?$")
        mantissa = F.regexp_replace(text, "[eE].*$", "")
        exponent = F.coalesce(F.nullif(F.regexp_extract(text, "[eE]([+-]?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
        bare = F.regexp_replace(mantissa, "[+.-]", "")
        places = _places(mantissa) - exponent
        digits = F.when(places < 0, F.concat(bare, F.repeat(F.lit("0"), -places))).otherwise(bare)
        moved = unit_scale_text(digits, F.greatest(places, F.lit(0)))
        return F.when(simple, text).when(text.rlike(_NUMBER), _signed(moved, text.startswith("-")))

    return once(F.btrim(col.cast("string")), show)


_SUM_DIGITS = 18
_SHORT = 28  # digits of a whole number that is added up in one piece


def number_limbs(col: Column) -> Column:
    """A plain number as (place, part): ``part`` x 10^(18 place), added up, is the number. Zero has one part, null none."""
    limb = "array<struct<place:int,part:decimal(28,0)>>"
    none = F.array().cast(limb)
    sign = F.when(col.startswith("-"), F.lit(Decimal(-1))).otherwise(F.lit(Decimal(1))).cast("decimal(1,0)")
    size = _unsigned(col)
    whole = F.substring_index(size, ".", 1)
    point = F.instr(size, ".")
    tail = F.when(point > 0, F.substring(size, point + 1, F.length(size))).otherwise("")

    def part(digits: Column, place: Column) -> Column:
        return F.struct(place.cast("int").alias("place"), (digits.cast("decimal(28,0)") * sign).cast("decimal(28,0)").alias("part"))

    def stretches(digits: Column, count: Column, place: Callable[[Column], Column]) -> Column:
        piece = lambda i: F.substring(digits, (i * _SUM_DIGITS + 1).cast("int"), F.lit(_SUM_DIGITS))
        all_ = F.transform(F.sequence(F.lit(0), (count - 1).cast("int")), lambda i: part(piece(i), place(i)))
        return F.filter(all_, lambda x: x["part"] != 0)

    count = F.ceil(F.length(whole) / _SUM_DIGITS)
    wide = stretches(F.lpad(whole, (count * _SUM_DIGITS).cast("int"), F.lit("0")), count, lambda i: count - 1 - i)
    left = F.when(F.length(whole) <= _SHORT, F.array(part(whole, F.lit(0)))).otherwise(wide)
    places = F.ceil(F.length(tail) / _SUM_DIGITS)
    long = stretches(F.rpad(tail, (places * _SUM_DIGITS).cast("int"), F.lit("0")), places, lambda i: -1 - i)
    short = F.array(part(F.rpad(tail, _SUM_DIGITS, "0"), F.lit(-1)))
    right = F.when(tail == "", none).when(F.length(tail) <= _SUM_DIGITS, short).otherwise(long)
    return F.when(col.isNotNull(), F.concat(left.cast(limb), right.cast(limb)))


def limbs_text(limbs: Column) -> Column:
    """Plain text of what parts by place (place, part), one of each place, add up to; null without any."""

    def close(parts: Column) -> Column:
        low = F.least(F.lit(0), F.array_min(F.transform(parts, lambda x: x["place"])))
        high = F.greatest(F.lit(0), F.array_max(F.transform(parts, lambda x: x["place"])))
        by_place = F.map_from_entries(parts)
        part = lambda place: F.coalesce(F.try_element_at(by_place, place), F.lit(Decimal(0)).cast(WHOLE)).cast(WHOLE)

        def text(bounds: Column) -> Column:
            dense = F.transform(F.sequence(bounds["low"], bounds["high"]), part)
            up = _carried(dense, _SUM_DIGITS)
            negative = up.startswith("-")
            down = lambda: _carried(F.transform(dense, lambda x: (-x).cast(WHOLE)), _SUM_DIGITS)
            digits = F.when(negative, down()).otherwise(up)
            return _signed(unit_scale_text(digits, -bounds["low"] * _SUM_DIGITS), negative)

        return once(F.struct(low.alias("low"), high.alias("high")), text)

    single = (F.size(limbs) == 1) & (F.get(limbs, F.lit(0))["place"] == 0)
    return F.when(F.size(limbs) == 0, None).when(single, F.get(limbs, F.lit(0))["part"].cast("string")).otherwise(once(limbs, close))


# Room of ``sum_text``, an aggregate with a fixed buffer: whole parts of 108 digits and 270 decimals.
_SUM_WHOLE, _SUM_PART = 6, 15


def sum_text(col: Column) -> Column:
    """Exact sum of plain numbers in text form, as plain text, whatever their order and number; null without any.

    A single expression has to fix its width: numbers beyond 108 whole digits or
    270 decimals fail. ``operators.sums.add_up`` takes any width.
    """
    size = _unsigned(col)
    point = F.instr(size, ".")
    before = F.substring_index(size, ".", 1)
    after = F.when(point > 0, F.substring(size, point + 1, F.length(size))).otherwise("")
    fits = (F.length(before) <= _SUM_WHOLE * _SUM_DIGITS) & (F.length(after) <= _SUM_PART * _SUM_DIGITS)
    checked = F.when(~fits, F.raise_error(F.lit("sum_text: a number has more digits than the sum has room for"))).otherwise(before)
    whole = F.lpad(checked, _SUM_WHOLE * _SUM_DIGITS, "0")
    part = F.rpad(after, _SUM_PART * _SUM_DIGITS, "0")
    sign = F.when(col.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    limb = lambda text, k: F.sum((F.substring(text, k * _SUM_DIGITS + 1, _SUM_DIGITS).cast("bigint") * sign).cast("decimal(28,0)"))
    limbs = [limb(part, k) for k in reversed(range(_SUM_PART))] + [limb(whole, k) for k in reversed(range(_SUM_WHOLE))]
    both = F.struct(F.array(*[x.cast(WHOLE) for x in limbs]).alias("up"), F.array(*[(-x).cast(WHOLE) for x in limbs]).alias("down"))

    def close(sums: Column) -> Column:
        up = _carried(sums["up"], _SUM_DIGITS)
        negative = up.startswith("-")
        digits = F.when(negative, _carried(sums["down"], _SUM_DIGITS)).otherwise(up)
        return _signed(unit_scale_text(digits, F.lit(_SUM_PART * _SUM_DIGITS)), negative)

    return F.when(F.count(col) > 0, once(both, close))


def sum_exact(df: DataFrame, column: str) -> Column:
    """Sum of a column of ``df`` as double that does not depend on row order, at any size.

    Exact digits are added and turned into a double at the end: numbers in text
    form limb by limb, decimals in one sum where the type has ten digits of
    room, else in three parts.
    """
    kind, col = df.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        return sum_text(col).cast("double")
    if not isinstance(kind, DecimalType) or kind.precision <= 28:
        return F.sum(col.cast(f"decimal(28,{getattr(kind, 'scale', 0)})")).cast("double")
    split = F.lit(Decimal(10**19))
    whole = (col - col % 1).cast(WHOLE)
    parts = ((whole - whole % split) / split, whole % split)
    high, low = (F.sum(part.cast("decimal(28,0)")).cast("double") for part in parts)
    return high * 1e19 + low + F.sum((col % 1).cast("decimal(28,18)")).cast("double")
