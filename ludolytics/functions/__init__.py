"""Column expressions. Everything here stays on the JVM side."""

from ludolytics.functions.text import clean_text, excerpt, strip_fences, without_links, words
from ludolytics.functions.times import epoch_to_ntz, hour_bucket, hours_between, iso_to_ntz, ntz
from ludolytics.functions.values import (
    half_up,
    md5_key,
    percent,
    price_cents,
    price_label,
    text_to_int,
)

__all__ = [
    "clean_text",
    "epoch_to_ntz",
    "excerpt",
    "half_up",
    "hour_bucket",
    "hours_between",
    "iso_to_ntz",
    "md5_key",
    "ntz",
    "percent",
    "price_cents",
    "price_label",
    "strip_fences",
    "text_to_int",
    "without_links",
    "words",
]
