"""Text column expressions (JVM-side, codegen friendly; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import CJK_CLASS, MAX_TEXT_CHARS, WHITESPACE_CHARS, WHITESPACE_CLASS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(text) -> Column:
    """``" ".join(s.split())``: runs of Unicode whitespace become one space,
    leading and trailing whitespace removed.  Null stays null.

    Every whitespace character is first mapped to a space with
    ``translate`` (a per-character table lookup), then runs of two or more
    spaces are collapsed; this gives the same result as one Unicode-class
    regular expression at about 1.6x its speed."""
    spaced = F.translate(_col(text), WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    return F.trim(F.regexp_replace(spaced, "  +", " "))


def strip_whitespace(text) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_col(text), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def normalize_text(text, max_chars: int = MAX_TEXT_CHARS) -> Column:
    """Collapse whitespace, trim, then keep the first ``max_chars`` code points
    (``max_chars <= 0`` keeps everything).  No second trim after the cut."""
    compact = collapse_whitespace(text)
    if max_chars and max_chars > 0:
        return F.substring(compact, 1, int(max_chars))
    return compact


def contains_cjk(text) -> Column:
    """True iff the text holds a CJK unified ideograph; null text -> false."""
    return F.coalesce(_col(text).rlike(CJK_CLASS), F.lit(False))


def same_language(a, b) -> Column:
    """Both texts contain CJK, or neither does."""
    return contains_cjk(a) == contains_cjk(b)


def language_tag(text) -> Column:
    """'zh' when the text contains CJK, else 'en'."""
    return F.when(contains_cjk(text), F.lit("zh")).otherwise(F.lit("en"))


def whitespace_tokens(text) -> Column:
    """Array of the whitespace-separated words of a text (empty array for
    empty or null text)."""
    return F.filter(F.split(F.coalesce(collapse_whitespace(text), F.lit("")), " "),
                    lambda w: w != "")
