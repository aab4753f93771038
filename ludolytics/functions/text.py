"""Text expressions.

The character classes name letters, digits and white space by Unicode property,
because the meaning of \\w and \\s differs between regular expression engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = r"\p{L}\p{N}_"
SPACES = r"\s\x0B\x1C-\x1F\x85\p{Z}"

URL = rf"http[^{SPACES}]+|www[^{SPACES}]+"
KEPT = LETTERS + """.,!?'"-"""
# What becomes one blank: a run of other characters, but not a single blank, which is
# the usual case and need not be replaced by itself.
GAP = rf"[^{KEPT}]{{2,}}|[^ {KEPT}]"
WORD = rf"[{LETTERS}]+(?:['-][{LETTERS}]+)*"


def without_links(text: Column) -> Column:
    """Lower case without links; null becomes ''."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), URL, "")


def clean_text(text: Column, max_chars: int | None = None) -> Column:
    """Lower case, without links, odd characters and repeated white space.

    Null becomes ''. The whole text is kept unless max_chars asks for a cut.
    """
    cleaned = F.trim(F.regexp_replace(without_links(text), GAP, " "))
    return cleaned if max_chars is None else F.substring(cleaned, 1, max_chars)


def words(text: Column) -> Column:
    """The words of a text in order; contractions and hyphenated words stay whole."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def excerpt(text: Column, max_chars: int = 300) -> Column:
    """The text, or its first max_chars characters followed by '...'."""
    cut = F.concat(F.substring(text, 1, max_chars), F.lit("..."))
    return F.when(F.length(text) > max_chars, cut).otherwise(text)


def strip_fences(text: Column) -> Column:
    """Removes the Markdown fences around a JSON answer."""
    bare = F.regexp_replace(text, r"```(?:json)?\s*", "")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")
