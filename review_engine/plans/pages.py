"""Extraction from page HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from review_engine.operators import extraction as ex
from review_engine.plans.expressions import sql_unescape
from review_engine.plans.registry import query
from review_engine.plans.tables import table

# The navigation items of the driver pages, read as cards.
NAV_CARD = ex.CardRules(
    card=ex.open_tag("li"),
    text={"title": ex.tag_body("a")},
    attributes={"url": ex.attribute_of("a", "href")},
    base_url="http://site",
)


@query("extract_cards", rf"""
WITH cards AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<li>.*?</li>')) AS card FROM pages)
SELECT page_id, nullif(trim({sql_unescape("regexp_extract(card, '<a [^>]*>(.*?)</a>', 1)")}), '') AS title,
       'http://site' || {sql_unescape("regexp_extract(card, 'href=.([^\"]*)', 1)")} AS url FROM cards""")
def extract_cards(spark, folder):
    return ex.extract_cards(table(spark, folder, "pages"), NAV_CARD).drop("pos")


# Cards in the markup of the real browse pages, one per part.
CARD_HTML = """concat('<div class="js" data-qa="discovery-media-list-item"><rt-img alt="x" class="posterImage" src="/i/', p_partkey,
 '.jpg"></rt-img><a href="/m/', p_partkey, '" data-qa="discovery-media-list-item-caption"><rt-text slot="criticsScore">', p_size,
 '%</rt-text>', if(p_partkey % 2 = 0, concat('<rt-text size="1" slot="audienceScore"> ', p_size + 1, '% </rt-text>'), ''),
 '<span class="p" data-qa="discovery-media-list-item-title">\n ', p_name, ' &amp; co </span>',
 if(p_partkey % 3 = 0, '<span data-qa="discovery-media-list-item-start-date">Opened May 12, 2026</span>', ''), '</a></div>')"""


@query("extract_title_cards", """
SELECT p_partkey AS page_id, p_name || ' & co' AS title,
       CASE WHEN p_partkey % 3 = 0 THEN 'Opened May 12, 2026' END AS release_date, p_size || '%' AS critics_score,
       CASE WHEN p_partkey % 2 = 0 THEN (p_size + 1) || '%' END AS audience_score,
       'https://www.rottentomatoes.com/m/' || p_partkey AS url, '/i/' || p_partkey || '.jpg' AS poster_url FROM part""")
def extract_title_cards(spark, folder):
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_id"), F.concat(F.lit("<main>no card</main>"), F.expr(CARD_HTML)).alias("html"))
    return ex.extract_cards(pages).drop("pos")


@query("extract_links_distinct", r"""
WITH found AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a\b[^>]*\bhref="(/[^"]*)"[^>]*>.*?</a>', 1)) AS href FROM pages)
SELECT DISTINCT page_id, href FROM found""")
def extract_links_distinct(spark, folder):
    return ex.links(table(spark, folder, "pages"), "/").select("page_id", "href")


# Plain links without cards: scores in slots, in the text, or only on the detail page.
LINK_HTML = """concat('<p><a class="x" href="/m/', p_partkey, '">', case p_partkey % 4
 when 0 then concat('<span data-qa="discovery-media-list-item-title">', p_name, 'Streaming</span><rt-text slot="criticsScore">', p_size, '%</rt-text><rt-text slot="audienceScore">7%</rt-text>')
 when 1 then concat(p_size, '% 95% ', p_name, ' Streaming May 12, 2026')
 when 2 then concat('<span>', p_size, '%</span><span>Opened May 2, 2025</span><span>', p_name, '</span><img src="/p.jpg">')
 else p_name end, '</a><a href="/m/', p_partkey, '">again</a><a href="/tv/1">other</a></p>')"""
DETAIL_HTML = """concat('<media-scorecard>', if(p_partkey % 8 = 3, '<rt-text slot="criticsScore">50%</rt-text><rt-text slot="audienceScore">60%</rt-text>',
 '<rt-text>x</rt-text><rt-text> 70% </rt-text><rt-text>80%</rt-text>'), '</media-scorecard>')"""


@query("extract_links", """
SELECT p_partkey AS page_id, p_name AS title,
       CASE p_partkey % 4 WHEN 1 THEN 'May 12, 2026' WHEN 2 THEN 'May 2, 2025' END AS release_date,
       CASE WHEN p_partkey % 4 < 3 THEN p_size || '%' WHEN p_partkey % 8 = 3 THEN '50%' ELSE '70%' END AS critics_score,
       CASE p_partkey % 4 WHEN 0 THEN '7%' WHEN 1 THEN '95%' WHEN 2 THEN '70%'
                          ELSE CASE WHEN p_partkey % 8 = 3 THEN '60%' ELSE '80%' END END AS audience_score,
       'https://www.rottentomatoes.com/m/' || p_partkey AS url,
       CASE WHEN p_partkey % 4 = 2 THEN '/p.jpg' END AS poster_url FROM part""")
def extract_links(spark, folder):
    part = table(spark, folder, "part")
    pages = part.select(F.col("p_partkey").alias("page_id"), F.expr(LINK_HTML).alias("html"))
    details = part.select(F.concat(F.lit("/m/"), F.col("p_partkey").cast("string")).alias("href"), F.expr(DETAIL_HTML).alias("html"))
    return ex.extract_links(pages, details).drop("pos")


@query("extract_scripts", r"""
SELECT page_id, unnest(regexp_extract_all(html, '(?s)<script\b[^>]*>(.*?)</script>', 1)) AS body FROM pages""")
def extract_scripts(spark, folder):
    return ex.script_bodies(table(spark, folder, "pages")).drop("pos")


PROPS_HTML = """concat('<html><page-media-reviews-manager a="1"><script data-json="props" type="application/json">', case p_partkey % 5
 when 0 then concat('{"vanity":{"mediaType":"Movie","emsId":"id-', p_partkey, '"}}')
 when 1 then concat('{"vanity":{"mediaType":"TvSeason","emsId":"id-', p_partkey, '"}}')
 when 2 then '{"vanity":{"mediaType":"Movie"}}' when 3 then '{broken' else '{"vanity":{"mediaType":"Other","emsId":"x"}}' end,
 '</script></page-media-reviews-manager></html>')"""


@query("extract_props", """
SELECT p_partkey AS page_id, CASE p_partkey % 5 WHEN 0 THEN 'Movie' ELSE 'TvSeason' END AS media_type, 'id-' || p_partkey AS ems_id,
       'https://www.rottentomatoes.com/napi/rtcf/v1/' || CASE p_partkey % 5 WHEN 0 THEN 'movies' ELSE 'tv/seasons' END || '/id-' ||
       p_partkey || '/reviews' AS api_url FROM part WHERE p_partkey % 5 < 2""")
def extract_props(spark, folder):
    pages = table(spark, folder, "part").select(F.col("p_partkey").alias("page_id"), F.expr(PROPS_HTML).alias("html"))
    return ex.extract_props(pages)
