"""Keys, numbers and prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts: Column) -> Column:
    """md5 of the parts joined by '_'; null if any part is null.

    concat_ws alone skips nulls, so (null, 5) and (5,) would share a key.
    """
    complete = F.lit(True)
    for part in parts:
        complete = complete & part.isNotNull()
    joined = F.concat_ws("_", *[part.cast("string") for part in parts])
    return F.when(complete, F.md5(joined))


def half_up(value: Column, digits: int) -> Column:
    """Rounds as a decimal, so a half that a double only nearly holds still goes up."""
    return F.round(value.cast("decimal(30,10)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """part as a percentage of whole in double, null where whole is 0."""
    share = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return half_up(share, digits)


def text_to_int(value: Column) -> Column:
    """Whole number from text or number; unreadable text gives null."""
    return F.trim(value.cast("string")).try_cast("int")


def price_cents(price: Column) -> Column:
    """0 where the price is missing or empty, null where it is no number."""
    text = price.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(text.try_cast("int"))


def price_label(price: Column) -> Column:
    """'Free', or dollars with two decimals."""
    text = price.cast("string")
    free = text.isNull() | text.isin("", "0")
    dollars = text.try_cast("double") / 100.0
    return F.when(free, F.lit("Free")).when(
        dollars.isNotNull(), F.format_string("$%.2f", dollars)
    )
