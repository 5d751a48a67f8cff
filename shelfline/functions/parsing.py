"""Typed reading of text columns. ``parse_*`` give null on bad text, ``strict_*`` fail the job."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfline.schemas import QTY0

ISO = "yyyy-MM-dd"
US = "MM/dd/yyyy"
COMPACT = "yyyyMMdd"

# The date layout each retailer sends.
RETAILER_DATES = {"WMT": ISO, "KRO": US, "TGT": COMPACT}
# Layouts tried, in order, where none is named.
AUTO_DATES = (ISO, US)


def parse_date(text: Column, layout: str) -> Column:
    """Date of a text in exactly this layout of ``yyyy``, ``MM`` and ``dd``.

    The shape is checked first and the parts are cast in ISO order, which stays in
    generated code; a formatter would raise and catch an exception for every bad text.
    """
    shape = re.escape(layout)
    parts = []
    for token in ("yyyy", "MM", "dd"):
        if layout.count(token) != 1:
            return F.try_to_date(text, layout)
        shape = shape.replace(token, rf"\d{{{len(token)}}}")
        parts.append(F.substring(text, layout.index(token) + 1, len(token)))
    if re.search("[A-Za-z]", re.sub("yyyy|MM|dd", "", layout)):
        return F.try_to_date(text, layout)
    iso = text if layout == ISO else F.concat_ws("-", *parts)
    return F.when(text.rlike(rf"\A{shape}\z"), iso.try_cast("date"))


def parse_date_auto(text: Column, layouts: tuple[str, ...] = AUTO_DATES) -> Column:
    return F.coalesce(*[parse_date(text, layout) for layout in layouts])


def _by_source(code: Column, named: dict[str, Column], default: Column) -> Column:
    first, *rest = named.items()
    chain = F.when(code == first[0], first[1])
    return reduce(lambda acc, item: acc.when(code == item[0], item[1]), rest, chain).otherwise(default)


def parse_date_by_source(
    code: Column,
    text: Column,
    layouts: dict[str, str] | None = None,
    default: tuple[str, ...] = AUTO_DATES,
) -> Column:
    """Date text whose layout depends on who sent it."""
    layouts = RETAILER_DATES if layouts is None else layouts
    return _by_source(
        code, {k: parse_date(text, v) for k, v in layouts.items()}, parse_date_auto(text, default)
    )


def parse_date_named(text: Column, layout: Column, layouts: tuple[str, ...], default: tuple[str, ...] = AUTO_DATES) -> Column:
    """Date text in the layout that ``layout`` names, one of ``layouts``; in one of ``default`` where it is null."""
    return _by_source(layout, {name: parse_date(text, name) for name in layouts}, parse_date_auto(text, default))


def strict_date_by_source(
    code: Column, text: Column, layouts: dict[str, str] | None = None, default: str = ISO
) -> Column:
    layouts = RETAILER_DATES if layouts is None else layouts
    return _by_source(
        code, {k: F.to_date(text, v) for k, v in layouts.items()}, F.to_date(text, default)
    )


def parse_decimal(text: Column, precision: int, scale: int) -> Column:
    return text.try_cast(DecimalType(precision, scale))


def parse_wide_integer(text: Column) -> Column:
    """Whole number of up to 38 digits; a fraction rounds half away from zero."""
    return text.try_cast(DecimalType(38, 0))


def parse_integer(text: Column) -> Column:
    """The same, narrowed to the 18 digits that tables hold; null if it does not fit."""
    return parse_wide_integer(text).try_cast(QTY0)


def strict_integer(text: Column) -> Column:
    return text.cast(DecimalType(38, 0)).cast("bigint")


def strict_float(text: Column) -> Column:
    return text.cast("double")


def yes_flag(text: Column) -> Column:
    """``'Y'`` is true, other text false, null stays null."""
    return text == F.lit("Y")


def flag_number(flag: Column) -> Column:
    return flag.cast("int")


def tidy_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def upc_has_length(text: Column, *lengths: int) -> Column:
    return F.length(digits(text)).isin(*lengths)


def check_digit_ok(text: Column, size: int = 12) -> Column:
    """Mod-10 check digit of a ``size``-digit code (weights 3,1 from the right of the body).

    Not part of any job: feeds often carry codes that fail it.
    """
    code = digits(text)
    weighted = [
        F.substring(code, i + 1, 1).try_cast("int") * (1 if (size - 1 - i) % 2 == 0 else 3)
        for i in range(size)
    ]
    return (F.length(code) == size) & (reduce(lambda a, b: a + b, weighted) % 10 == 0)
