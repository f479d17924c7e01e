"""HTML character references, decoded without leaving the JVM."""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_engine.functions.text import collapse_space, has_text

# The reference that may follow an ampersand.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

# Numeric references 128..159 mean the Windows-1252 character, where there is one.
C1_TEXT = "".join(
    chr(point) if point in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([point]).decode("cp1252")
    for point in range(0x80, 0xA0)
)


@lru_cache(maxsize=1)
def _legacy_pattern() -> str:
    names = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return "^(" + "|".join(names) + ")"


def _entity_map() -> Column:
    # A literal, so the optimizer folds it into one constant map.
    return F.from_json(F.lit(json.dumps(html5)), T.MapType(T.StringType(), T.StringType()))


def _code_point(number: Column) -> Column:
    """The character of a code point; NULL number means it did not fit."""
    # Not a character at all: control codes and the last two points of each plane.
    ignored = (
        number.between(0x1, 0x8)
        | (number == 0xB)
        | number.between(0xE, 0x1F)
        | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF)
        | ((number >= 0xFFFE) & (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    )
    return (
        F.when(number.isNull() | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF) | (number == 0), "\ufffd")
        .when(number.between(0x80, 0x9F), F.substr(F.lit(C1_TEXT), (number - 0x7F).cast("int"), F.lit(1)))
        .when(number == 0x0D, "\r")
        .when(ignored, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def _decode_piece(piece: Column) -> Column:
    """Decode one piece of text that followed an ampersand."""
    ref = F.regexp_extract(piece, REFERENCE, 1)
    rest = F.substr(piece, F.length(ref) + 1)
    digits = F.rtrim(ref, F.lit(";"))
    significant = F.regexp_replace(digits, "^#[xX]0*(?=.)", "")
    hexadecimal = ref.rlike("^#[xX]")
    number = F.when(
        hexadecimal,
        F.when(F.length(significant) <= 10, F.conv(significant, 16, 10).try_cast("bigint")),
    ).otherwise(F.substr(digits, F.lit(2)).try_cast("bigint"))
    named = F.try_element_at(_entity_map(), ref)
    legacy = F.regexp_extract(piece, _legacy_pattern(), 1)
    return (
        F.when(ref == "", F.concat(F.lit("&"), piece))
        .when(ref == "amp;", F.concat(F.lit("&"), rest))  # by far the most frequent
        .when(ref.startswith("#"), F.concat(_code_point(number), rest))
        .when(named.isNotNull(), F.concat(named, rest))
        .when(
            legacy != "",
            F.concat(F.try_element_at(_entity_map(), legacy), F.substr(piece, F.length(legacy) + 1)),
        )
        .otherwise(F.concat(F.lit("&"), piece))
    )


def html_unescape(c: Column) -> Column:
    """Decode named, decimal and hexadecimal references once, left to right."""
    # the piece before the first ampersand is kept as it is
    pieces = F.transform(F.split(c, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(_decode_piece(piece)))
    return F.when(F.contains(c, F.lit("&")), F.array_join(pieces, "")).otherwise(c)


def clean_review_text(c: Column) -> Column:
    """Decoded, lower-case text with single spaces and single full stops; blank becomes NULL."""
    text = collapse_space(F.lower(html_unescape(c)))
    return F.when(has_text(c), F.regexp_replace(text, r"\.{2,}", "."))
