"""Fields out of page HTML by patterns over known tags."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.functions.markup import html_unescape
from review_engine.functions.text import (
    MONTHS,
    clean_title,
    critics_and_audience_percent,
    date_text,
    normalize_space,
)
from review_engine.operators.dedup import first_per_key

# --- patterns ----------------------------------------------------------------


def open_tag(tag: str, attribute: str | None = None, value: str | None = None) -> str:
    if attribute is None:
        return rf"<{tag}\b[^>]*>"
    return rf'<{tag}\b[^>]*\b{re.escape(attribute)}="{re.escape(value)}"[^>]*>'


def tag_body(tag: str, attribute: str | None = None, value: str | None = None) -> str:
    return rf"(?s){open_tag(tag, attribute, value)}(.*?)</{tag}>"


def attribute_of(tag: str, wanted: str, attribute: str | None = None, value: str | None = None) -> str:
    """Pattern whose group 1 is the wanted attribute of a tag; the two may come in any order."""
    marked = "" if attribute is None else rf'(?=[^>]*\b{re.escape(attribute)}="{re.escape(value)}")'
    return rf'<{tag}\b{marked}[^>]*\b{wanted}="([^"]*)"'


def find(html: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags out, references decoded, blank is NULL."""
    bare = html_unescape(F.regexp_replace(html, "(?s)<!--.*?-->|<[^>]*>", ""))
    return normalize_space(bare)


@dataclass(frozen=True)
class CardRules:
    """Where a page keeps its cards and a card its fields (pattern, group 1)."""

    card: str  # the tag that opens a card
    text: dict[str, str] = field(default_factory=dict)
    attributes: dict[str, str] = field(default_factory=dict)
    base_url: str = ""


# Markup of a title card.
TITLE_CARD = CardRules(
    card=open_tag("div", "data-qa", "discovery-media-list-item"),
    text={
        "title": tag_body("span", "data-qa", "discovery-media-list-item-title"),
        "release_date": tag_body("span", "data-qa", "discovery-media-list-item-start-date"),
        "critics_score": tag_body("rt-text", "slot", "criticsScore"),
        "audience_score": tag_body("rt-text", "slot", "audienceScore"),
    },
    attributes={
        "url": attribute_of("a", "href", "data-qa", "discovery-media-list-item-caption"),
        "poster_url": attribute_of("rt-img", "src", "class", "posterImage"),
    },
    base_url="https://www.rottentomatoes.com",
)


def extract_cards(pages: DataFrame, rules: CardRules = TITLE_CARD, page: str = "page_id",
                  html: str = "html") -> DataFrame:
    """One row per card with its fields; an absent field is NULL."""
    pieces = F.split(F.col(html), f"(?={rules.card})")
    # what precedes the first card is not a card
    cards = pages.select(page, F.posexplode(pieces).alias("pos", "card")).filter(F.col("card").rlike(f"^{rules.card}"))
    patterns = rules.text | rules.attributes
    found = [find(F.col("card"), p) for p in patterns.values()]
    raw = cards.select(page, F.col("pos").cast("bigint").alias("pos"), F.array(*found).alias("found"))
    # an attribute holds no tags, so the same cleaning serves both
    read = raw.select(page, "pos", F.transform("found", lambda f: plain_text(f)).alias("found"))
    fields = {name: F.get("found", F.lit(i)) for i, name in enumerate(patterns)}
    if "url" in fields:
        fields["url"] = F.concat(F.lit(rules.base_url), fields["url"])
    return read.select(page, "pos", *[c.alias(n) for n, c in fields.items()])


# --- links -------------------------------------------------------------------

LINK = r'(?s)<a\b[^>]*\bhref="({href}[^"]*)"[^>]*>.*?</a>'


def links(pages: DataFrame, href: str, page: str = "page_id", html: str = "html") -> DataFrame:
    """Links whose target starts like ``href``: the first of each target per page."""
    pattern = LINK.format(href=href)
    found = pages.select(page, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))).alias("pos", "link"))
    targets = found.withColumn("href", find(F.col("link"), pattern))
    return first_per_key(targets, [F.col(page), F.col("href")], [F.col("pos")])


PERCENT_ONLY = r"^\d+%$"
TITLE_NOISE = r"[Ss]treaming|[Oo]pened|[Ll]ink\s+to"
_SCORE = "rt-text"


def _scorecard(details: DataFrame) -> DataFrame:
    """Scores of detail pages (``href``, ``html``): by slot, else the percentages in order."""
    card = F.col("card")
    slots = [find(card, tag_body(_SCORE, "slot", slot)) for slot in ("criticsScore", "audienceScore")]
    every = F.regexp_extract_all(card, F.lit(tag_body(_SCORE)), F.lit(1))
    cards = details.select("href", find(F.col("html"), tag_body("media-scorecard")).alias("card"))
    read = cards.select("href", F.transform(F.concat(F.array(*slots), every), lambda t: plain_text(t)).alias("t"))
    percents = F.filter(F.slice("t", 3, F.size("t")), lambda t: t.rlike(PERCENT_ONLY))
    return read.select("href", F.get("t", F.lit(0)).alias("slot_critics"), F.get("t", F.lit(1)).alias("slot_audience"),
                       percents.alias("card_percents"))


def _fill_scores(critics: Column, audience: Column, candidates: Column) -> tuple[Column, Column]:
    """Fill missing scores from candidates in order; a candidate is used once."""
    first, second = F.try_element_at(candidates, F.lit(1)), F.try_element_at(candidates, F.lit(2))
    return (
        F.coalesce(critics, first),
        F.coalesce(audience, F.when(critics.isNull(), second).otherwise(first)),
    )


def extract_links(pages: DataFrame, details: DataFrame | None = None, href: str = "/m/", page: str = "page_id",
                  html: str = "html", base_url: str = TITLE_CARD.base_url) -> DataFrame:
    """Titles from plain links, for pages without cards.

    Per field the sources are tried in this order. Scores: slots of the link,
    percentages in its text, the scorecard of the detail page, its spans. Date:
    the link text, its spans. Title: marked elements, the first telling span,
    the whole text.
    """
    link = F.col("link")
    marked = [
        find(link, tag_body("span", "data-qa", "discovery-media-list-item-title")),
        find(link, tag_body(_SCORE, "slot", "title")),
        find(link, tag_body(_SCORE, "slot", "criticsScore")),
        find(link, tag_body(_SCORE, "slot", "audienceScore")),
    ]
    spans = F.regexp_extract_all(link, F.lit(tag_body("span")), F.lit(1))
    # the text of the whole link keeps its parts apart, so its tags become spaces first
    whole = F.regexp_replace(link, "<[^>]*>", " ")
    raw = links(pages, href, page, html).select(
        page, "pos", "href", find(link, attribute_of("img", "src")).alias("poster_url"),
        F.concat(F.array(*marked, whole), spans).alias("found"),
    )
    read = raw.withColumn("found", F.transform("found", lambda f: plain_text(f)))
    part = lambda i: F.get("found", F.lit(i))
    rows = read.select(
        page, "pos", "href", "poster_url",
        clean_title(F.coalesce(part(0), part(1))).alias("marked_title"),
        part(2).alias("slot_c"), part(3).alias("slot_a"), part(4).alias("text"),
        F.filter(F.slice("found", 6, F.size("found")), lambda s: s.isNotNull()).alias("spans"),
    )
    first, second = critics_and_audience_percent(F.col("text"))
    rows = rows.withColumns({"critics": F.coalesce("slot_c", first), "audience": F.coalesce("slot_a", second)})

    if details is not None:
        incomplete = F.col("critics").isNull() | F.col("audience").isNull()
        rows = rows.join(_scorecard(details), "href", "left")
        by_slot = {
            "critics": F.when(incomplete, F.coalesce("slot_critics", "critics")).otherwise(F.col("critics")),
            "audience": F.when(incomplete, F.coalesce("slot_audience", "audience")).otherwise(F.col("audience")),
        }
        rows = rows.withColumns(by_slot)
        c, a = _fill_scores(F.col("critics"), F.col("audience"), F.coalesce("card_percents", F.array()))
        rows = rows.withColumns({"critics": c, "audience": a})

    untitled = F.col("marked_title").isNull()
    is_percent = lambda s: s.rlike(PERCENT_ONLY)
    is_date = lambda s: s.rlike(MONTHS)
    telling = F.filter("spans", lambda s: ~is_percent(s) & ~s.rlike(TITLE_NOISE) & ~is_date(s) & clean_title(s).isNotNull())
    dated = F.filter("spans", lambda s: ~is_percent(s) & ~s.rlike(TITLE_NOISE) & is_date(s))
    span_percents = F.when(untitled, F.filter("spans", is_percent)).otherwise(F.array().cast("array<string>"))
    c, a = _fill_scores(F.col("critics"), F.col("audience"), span_percents)
    return rows.select(
        page,
        F.col("pos").cast("bigint").alias("pos"),
        F.coalesce("marked_title", clean_title(F.try_element_at(telling, F.lit(1))), clean_title(F.col("text"))).alias("title"),
        F.coalesce(date_text(F.col("text")), F.when(untitled, F.try_element_at(dated, F.lit(1)))).alias("release_date"),
        c.alias("critics_score"),
        a.alias("audience_score"),
        F.concat(F.lit(base_url), "href").alias("url"),
        "poster_url",
    )


# --- embedded properties -----------------------------------------------------

# Where a review page keeps its properties, and the path per media type.
PROPS = r'(?s)<page-media-reviews-manager\b[^>]*>.*?<script\b[^>]*\bdata-json="props"[^>]*>(.*?)</script>'
PATH_BY_MEDIA_TYPE = {"Movie": "movies", "TvEpisode": "tv/episodes", "TvSeason": "tv/seasons"}
ENDPOINT = "https://www.rottentomatoes.com/napi/rtcf/v1/%s/%s/reviews"


def extract_props(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """Media type, id and review endpoint of pages that state both."""
    body = find(F.col(html), PROPS)
    props = pages.select(
        page,
        F.get_json_object(body, "$.vanity.mediaType").alias("media_type"),
        F.get_json_object(body, "$.vanity.emsId").alias("ems_id"),
    ).filter((F.col("media_type") != "") & (F.col("ems_id") != ""))
    path = F.coalesce(*[F.when(F.col("media_type") == t, p) for t, p in PATH_BY_MEDIA_TYPE.items()])
    return props.withColumn("api_url", F.when(path.isNotNull(), F.printf(F.lit(ENDPOINT), path, F.col("ems_id")))).filter(
        F.col("api_url").isNotNull()
    )


def script_bodies(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """Every script body of a page, in order."""
    bodies = F.regexp_extract_all(F.col(html), F.lit(tag_body("script")), F.lit(1))
    return pages.select(page, F.posexplode(bodies).alias("pos", "body"))
