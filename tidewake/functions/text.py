"""Text rules: port and ship names, weather reports, berth limits, AIS bit strings, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.geo import c

#: The six-bit alphabet of AIS text.
SIX_BIT_TEXT = "@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_ !\"#$%&'()*+,-./0123456789:;<=>?"
#: The armour of six bits in a sentence, and base 64; hexadecimal digits of the longest message of two parts.
ARMOUR = "0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVW`abcdefghijklmnopqrstuvw"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LONGEST_HEX = 128
#: Lower bounds in metres per second of the wind levels 0 to 12.
WIND_LEVELS = (0.0, 0.3, 1.6, 3.4, 5.5, 8.0, 10.8, 13.9, 17.2, 20.8, 24.5, 28.5, 32.7)


def normal_name(name) -> Column:
    """Lower case without spaces."""
    return F.lower(F.replace(c(name), F.lit(" "), F.lit("")))


def port_name(name, known: list[str]) -> Column:
    """The name without digits, capitalised, when that is a known port; the name as it is otherwise."""
    plain = F.initcap(F.regexp_replace(c(name), "[0-9]", ""))
    return F.when(plain.isin(known), plain).otherwise(c(name))


def without_separators(text) -> Column:
    return F.translate(c(text), ", ", "")


def commas_to_semicolons(text) -> Column:
    return F.translate(c(text), ",", ";")


def numeric_or_zero(text) -> Column:
    return F.when(c(text).rlike(r"^[0-9.]+$"), c(text)).otherwise(F.lit("0"))


def without_labels(text) -> Column:
    """Without 【…】 labels."""
    return F.regexp_replace(c(text), "【[^】]*】", "")


def entities_decoded(text) -> Column:
    """``&#NNN;`` as its character, by code point."""
    parts = F.split(c(text), r"(?=&#[0-9]+;)|(?<=&#[0-9]{1,7};)")
    code = lambda x: F.regexp_extract(x, "^&#([0-9]+);$", 1)
    char = lambda x: F.decode(F.unhex(F.lpad(F.hex(code(x).cast("long")), 8, "0")), "UTF-32")
    return F.array_join(F.transform(parts, lambda x: F.when(code(x) != "", char(x)).otherwise(x)), "")


def wind_level(metres_per_second) -> Column:
    """The level whose range holds the speed given to one decimal; null below 0."""
    v = F.round(c(metres_per_second), 1)
    level = F.lit(None).cast("int")
    for i, low in enumerate(WIND_LEVELS):
        level = F.when(v >= low, F.lit(i)).otherwise(level)
    return level


def wind_tokens(report) -> Column:
    """Wind forces named in a report: ranges before 级, forces reached, and gusts; ``3-4`` where it names none."""
    text = c(report)
    ranged = F.regexp_extract_all(text, F.lit(r"风(?:力)?([0-9]+-[0-9]+)级"), F.lit(1))
    reached = F.regexp_extract_all(text, F.lit(r"到([0-9]+(?:-[0-9]+)?)级"), F.lit(1))
    found = F.array_union(ranged, reached)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("3-4")))


def gust_tokens(report) -> Column:
    return F.regexp_extract_all(c(report), F.lit(r"阵风([0-9]+(?:-[0-9]+)?)级"), F.lit(1))


def strongest(tokens) -> Column:
    """The largest force of tokens ``a-b`` or ``n``."""
    return F.array_max(F.transform(c(tokens), lambda x: F.element_at(F.split(x, "-"), -1).cast("int")))


def worst_wind_and_sight(report) -> tuple[Column, Column]:
    pattern = r"最大风力达到([0-9]+)级，最小能见度达到([0-9]+)米"
    number = lambda i: F.nullif(F.regexp_extract(c(report), pattern, i), F.lit("")).cast("int")
    return number(1), number(2)


def published(report) -> Column:
    """``YYYY-MM-DD HH:MM`` from a Chinese date and clock; null without one."""
    pattern = r"([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日([0-9]{1,2})时(?:([0-9]{1,2})分)?"
    part = lambda i: F.regexp_extract(c(report), pattern, i)
    text = F.concat(part(1), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(part(3), 2, "0"), F.lit(" "), F.lpad(part(4), 2, "0"), F.lit(":"), F.lpad(part(5), 2, "0"))
    return F.when(part(1) != "", text)


def tonnage_range(text) -> Column:
    """``struct<low, high>`` in tonnes of ``7-10万``, ``5万`` or ``3000``."""
    unit = F.when(F.endswith(c(text), F.lit("万")), 10_000.0).otherwise(1.0)
    first, second = F.regexp_extract(c(text), r"^([0-9.]+)", 1), F.regexp_extract(c(text), r"^[0-9.]+-([0-9.]+)", 1)
    high = F.when(second != "", second).otherwise(first)
    low = F.when(second != "", first.try_cast("double") * unit).otherwise(0.0)
    return F.struct(low.alias("low"), (high.try_cast("double") * unit).alias("high"))


def berth_name(text) -> Column:
    """Port and number of a berth: ``<port><number>泊``."""
    port, number = F.regexp_extract(c(text), r"^(\D+)", 1), F.regexp_extract(c(text), r"([0-9]+)", 1)
    return F.when(number != "", F.concat(port, number, F.lit("泊")))


def reasons(*rules: tuple[Column, str]) -> tuple[Column, Column]:
    """``status`` 1 or 2 and the texts of the rules that failed, joined by ``;``; a rule that is unknown passes."""
    failed = F.concat_ws(";", *[F.when(rule, F.lit(text)) for rule, text in rules])
    return F.when(failed == "", 1).otherwise(2), failed


def armour_bits(payload) -> Column:
    """A sentence's payload as hexadecimal digits, four bits each: its armour is base 64 with another alphabet."""
    plain = F.translate(c(payload), ARMOUR, BASE64)
    filled = F.concat(plain, F.repeat(F.lit("A"), F.pmod(-F.length(plain), F.lit(4))))
    return F.rpad(F.hex(F.try_to_binary(filled, F.lit("base64"))), LONGEST_HEX, "0")


def bits_unsigned(bits, start: int, length: int) -> Column:
    """The field of ``length`` bits at ``start``: the digits that hold it, shifted and masked."""
    first, last = start // 4, (start + length - 1) // 4
    digits = F.conv(F.substring(c(bits), first + 1, last - first + 1), 16, 10).cast("long")
    return F.shiftright(digits, 4 * (last + 1) - start - length).bitwiseAND(F.lit((1 << length) - 1))


def bits_signed(bits, start: int, length: int) -> Column:
    """Two's complement."""
    raw = bits_unsigned(bits, start, length)
    return F.when(raw >= 1 << (length - 1), raw - (1 << length)).otherwise(raw)


def bits_text(bits, start: int, characters: int) -> Column:
    """Six-bit text up to the first ``@``, without trailing spaces; whole digits that make whole groups of 24 bits are read as base 64."""
    if start % 4 == 0 and characters % 4 == 0:
        digits = F.substring(c(bits), start // 4 + 1, characters * 3 // 2)
        whole = F.unhex(F.rpad(digits, characters * 3 // 2, "0"))
        return F.rtrim(F.substring_index(F.translate(F.base64(whole), BASE64, SIX_BIT_TEXT), "@", 1))
    one = lambda i: F.substring(F.lit(SIX_BIT_TEXT), bits_unsigned(bits, start + 6 * i, 6).cast("int") + 1, F.lit(1))
    text = F.concat(*[F.coalesce(one(i), F.lit("")) for i in range(characters)])
    return F.rtrim(F.substring_index(text, "@", 1))


def within(value, low, high, sentinel: int = -999) -> Column:
    return F.when(c(value).between(low, high), c(value)).otherwise(F.lit(sentinel))


def armoured(bits, length: int) -> Column:
    """The payload of the first ``length`` bits of a string of bits, filled up to whole groups of 24; the inverse of ``armour_bits``."""
    padded, groups = F.rpad(c(bits), -(-length // 24) * 24, "0"), -(-length // 24)
    digits = [F.lpad(F.conv(F.substring(padded, 24 * i + 1, 24), 2, 16), 6, "0") for i in range(groups)]
    return armoured_digits(F.concat(*digits), length)


def armoured_digits(digits, length: int) -> Column:
    """The same from hexadecimal digits, which need no conversion of number by number."""
    whole = F.unhex(F.rpad(c(digits), -(-length // 24) * 6, "0"))
    return F.substring(F.translate(F.base64(whole), BASE64, ARMOUR), 1, -(-length // 6))


def digits_of(value, length: int) -> Column:
    """``bits_of`` as hexadecimal digits, for whole digits."""
    return F.lpad(F.hex(c(value).cast("long").bitwiseAND(F.lit((1 << length) - 1))), length // 4, "0")


def text_digits(text, characters: int) -> Column:
    """``text_bits`` as hexadecimal digits, for four characters or a multiple."""
    padded = F.regexp_replace(F.rpad(F.upper(c(text)), characters, "@"), "[^ -_]", "?")
    return F.hex(F.unbase64(F.translate(padded, SIX_BIT_TEXT, BASE64)))


def bits_of(value, length: int) -> Column:
    """The low ``length`` bits of an integer, two's complement for a negative one."""
    return F.lpad(F.bin(c(value).cast("long").bitwiseAND(F.lit((1 << length) - 1))), length, "0")


def text_bits(text, characters: int) -> Column:
    """Six-bit text, filled up with ``@``."""
    padded = F.rpad(F.upper(c(text)), characters, "@")
    return F.array_join(F.transform(F.split(padded, ""), lambda ch: F.when(ch != "", F.lpad(F.bin((F.instr(F.lit(SIX_BIT_TEXT), ch) - 1).cast("long")), 6, "0")).otherwise("")), "")


def parsed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with ``columns`` worked out once a row: a later filter or field does not write the expression out again."""
    return rows.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))
