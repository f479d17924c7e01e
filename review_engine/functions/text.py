"""Text normalisation, tokens and title cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace, spelled out because regex engines disagree on ``\s``.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(point) for point in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# What collapsing has to touch: runs of whitespace, and single ones that are not a space.
SPACE_TO_COLLAPSE = SPACE_CLASS + r"{2,}|[\t-\r\x1c-\x1f\x85\p{Z}&&[^ ]]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
WORD_CLASS = r"[\p{L}\p{N}_]"

# Texts that older writers left behind in place of NULL.
NULL_SENTINELS = ("nan", "<na>", "none", "")

# Month stems as they appear in scraped dates.
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"

# What surrounds a title in scraped link text.
TITLE_LEAD_LINK = r"(?i)^\s*Link to\s+"
TITLE_LEAD_SCORES = r"^\s*[\d%\s]+"
TITLE_TAIL_NOISE = r"(?:[Ss]treaming|[Oo]pened|[Ll]ink\s+to\s+).*$"
TITLE_TAIL_DATE = rf"(?i)\s+(?:{MONTHS})[a-z]?\s+\d{{1,2}},?\s+\d{{4}}\s*$"

# The shapes looked for in free text.
PERCENT_TEXT = r"\d{1,3}%"
DATE_TEXT = rf"(?i)(?:{MONTHS})[a-z]?\s+\d{{1,2}},?\s+\d{{4}}"
SENTIMENT_TEXT = "(POSITIVE|NEGATIVE|NEUTRAL)"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def to_null(c: Column) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(strip(c), F.lit(""))


def collapse_space(c: Column) -> Column:
    """Runs of whitespace become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE_TO_COLLAPSE, " "))


def normalize_space(c: Column) -> Column:
    """Collapsed text; blank becomes NULL."""
    return F.nullif(collapse_space(c), F.lit(""))


def has_text(c: Column) -> Column:
    return c.rlike(NOT_SPACE)


def canonical_title(c: Column) -> Column:
    return F.lower(normalize_space(c))


def null_sentinels(c: Column) -> Column:
    return F.when(~F.lower(F.btrim(c)).isin(*NULL_SENTINELS), c)


def tokens(c: Column) -> Column:
    """Lower-case word tokens of three characters or more, in text order.

    One pass: splitting at everything that is not a word character and keeping
    the long pieces is the same as collecting the long runs of word characters.
    """
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_CLASS + "{3,}"), F.lit(0))


def keyword_letters(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]", "")


def clean_title(c: Column) -> Column:
    """Title proper out of scraped link text."""
    text = F.regexp_replace(c, TITLE_LEAD_LINK, "")
    text = F.regexp_replace(text, TITLE_LEAD_SCORES, "")
    text = F.regexp_replace(text, TITLE_TAIL_NOISE, "")
    text = F.regexp_replace(text, TITLE_TAIL_DATE, "")
    return normalize_space(text)


def percents(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(PERCENT_TEXT), F.lit(0))


def critics_and_audience_percent(c: Column) -> tuple[Column, Column]:
    """First and second percentage found in free text."""
    found = percents(c)
    return F.try_element_at(found, F.lit(1)), F.try_element_at(found, F.lit(2))


def date_text(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, DATE_TEXT, 0), F.lit(""))


def sentiment_from_name(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, SENTIMENT_TEXT, 1), F.lit("")), F.lit("UNKNOWN"))


def label_text(*parts: Column) -> Column:
    """Display label; a missing part reads ``unknown``."""
    return F.concat_ws(" · ", *[F.coalesce(part, F.lit("unknown")) for part in parts])
