"""HTML extraction queries (H1-H9, R3-R6, J2, N1, N2, P17), with oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators.windows import carry_forward
from ..schema import OLD_LAYOUT_BOX, OLD_LAYOUT_FIELDS
from ..sources import html_pages as H
from ..sources.files import read_table
from ..sources.json_payloads import split_rejects
from .registry import register
from .standins import (AS_OF, RAW_HTML_CARDS_SQL, area_name_at, area_values_sql, captured_html_pages,
                       silver_listings, with_listings)

AS_OF_DATE = dt.date.fromisoformat(AS_OF)
CARD_COLUMNS = ["source_id", "page_num", "pos", "last_updated", "price", "n_beds", "n_baths", "available_date",
                "location", "area", "utilities", "amenities", "agent_name", "agent_email", "agent_phone",
                "agent_fees"]


def _kept_cards(spark, sf_dir):
    cards = H.stage_cards(captured_html_pages(spark, sf_dir))
    cutoff = H.page_cutoff(H.page_facts(cards))
    return H.apply_cutoff(cards, cutoff), cutoff


@register("html_cards", with_listings(f""", {RAW_HTML_CARDS_SQL}
SELECT {", ".join(CARD_COLUMNS)} FROM cards"""))
def q_html_cards(spark, sf_dir):
    kept, _ = _kept_cards(spark, sf_dir)
    clean, _ = split_rejects(H.clean_cards(kept, AS_OF_DATE))
    return clean.select(*CARD_COLUMNS)


@register("html_rejects", with_listings(f""", {RAW_HTML_CARDS_SQL}
SELECT source_id, page_num, pos, concat_ws('; ', CASE WHEN id % 101 = 0 THEN 'unparsable price' END,
  CASE WHEN id % 103 = 0 THEN 'unparsable n_baths' END,
  CASE WHEN id % 107 = 0 AND id % 13 <> 0 THEN 'unparsable available_date' END) AS _reject_reason
FROM all_cards WHERE id % 101 = 0 OR id % 103 = 0 OR (id % 107 = 0 AND id % 13 <> 0)"""))
def q_html_rejects(spark, sf_dir):
    """Cards with a cell that is there but cannot be parsed."""
    kept, _ = _kept_cards(spark, sf_dir)
    _, bad = split_rejects(H.clean_cards(kept, AS_OF_DATE))
    return bad.select("source_id", "page_num", "pos", "_reject_reason")


PAGE_CUTOFF_SQL = with_listings(f""", {RAW_HTML_CARDS_SQL}
SELECT source_id, CAST(CASE WHEN source_id = 'src0' THEN n ELSE n + 1 END AS INTEGER) AS last_page
FROM npages""")


@register("page_cutoff", PAGE_CUTOFF_SQL)
def q_page_cutoff(spark, sf_dir):
    _, cutoff = _kept_cards(spark, sf_dir)
    return cutoff


@register("carry_forward", with_listings(f""", {RAW_HTML_CARDS_SQL}
SELECT source_id, page_num, pos, last_value(available_date IGNORE NULLS) OVER (
   PARTITION BY source_id ORDER BY page_num, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   AS available_date
FROM cards"""))
def q_carry_forward(spark, sf_dir):
    kept, _ = _kept_cards(spark, sf_dir)
    clean, _ = split_rejects(H.clean_cards(kept, AS_OF_DATE))
    clean = clean.select("source_id", "page_num", "pos", "available_date")
    return carry_forward(clean, ["available_date"], ["source_id"], ["page_num", "pos"])


@register("page_agents", with_listings(f""", {RAW_HTML_CARDS_SQL}
, pg AS (SELECT DISTINCT source_id, p AS orig_p, p AS page_num FROM base
   UNION ALL SELECT c.source_id, c.p, n.n + c.off
   FROM (VALUES ('src0', 1, 2), ('src1', 1, 1), ('src1', 2, 2), ('src2', 2, 1), ('src2', 3, 2))
     AS c(source_id, p, off) JOIN npages n ON n.source_id = c.source_id),
cnt AS (SELECT source_id, p, count(*) AS n_cards FROM base GROUP BY source_id, p)
SELECT pg.source_id, CAST(pg.page_num AS INTEGER) AS page_num, a.a_name AS agent_name, a.a_email AS agent_email,
 a.a_phone AS agent_phone, cnt.n_cards AS n_rows
FROM pg JOIN cnt ON cnt.source_id = pg.source_id AND cnt.p = pg.orig_p
JOIN agents a ON a.source_id = pg.source_id AND a.p = pg.orig_p
UNION ALL
SELECT n.source_id, CAST(n.n + 1 AS INTEGER), a.a_name, a.a_email, a.a_phone, 1
FROM npages n JOIN agents a ON a.source_id = n.source_id AND a.p = 1 WHERE n.source_id = 'src0'"""))
def q_page_agents(spark, sf_dir):
    """H3 + J2: page-level agents joined back to every card row of the page."""
    cards = H.stage_cards(captured_html_pages(spark, sf_dir))
    agents = H.page_agents(cards)
    slim = cards.select("source_id", "page_num", "pos")
    joined = H.join_page_agent(slim, agents)
    return (joined.groupBy("source_id", "page_num", "agent_name", "agent_email", "agent_phone")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _unescape(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), "
            f"'&amp;', '&')")


def _inner_text(tag_re: str) -> str:
    return _unescape(f"regexp_replace(regexp_extract(html, '(?s){tag_re}', 1), '<[^>]*>', '', 'g')")


_PAGE_SPEC = {
    "title": ("title", None, "text"),
    "heading": ("h1", None, "text"),
    "ad_text": ("div", "ad", "text"),
    "n_links": ("a", None, "count"),
    "n_paragraphs": ("p", None, "count"),
}


@register("page_fields", f"""
SELECT page_id, {_inner_text('<title>(.*?)</title>')} AS title, {_inner_text('<h1>(.*?)</h1>')} AS heading,
 {_inner_text('<div class="ad">(.*?)</div>')} AS ad_text,
 CAST(len(regexp_extract_all(html, '<a[\\s>]')) AS INTEGER) AS n_links,
 CAST(len(regexp_extract_all(html, '<p[\\s>]')) AS INTEGER) AS n_paragraphs
FROM pages""")
def q_page_fields(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", spread_rows=True)
    return H.extract_page_fields(pages, "page_id", _PAGE_SPEC)


@register("page_first_href", f"""
SELECT page_id, {_unescape("regexp_extract(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)")} AS first_href,
 split_part(url, ':', 2) AS url_payload
FROM pages""")
def q_page_first_href(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", spread_rows=True)
    f = H.extract_page_fields(pages, "page_id", {"first_href": ("a", None, "href")}, keep=["url"])
    return f.select("page_id", "first_href", C.href_payload("url").alias("url_payload"))


@register("nonempty_pages", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<p[\\s>]')) AS INTEGER) AS n_paragraphs FROM pages
WHERE len(regexp_extract_all(html, '<p[\\s>]')) > 0""")
def q_nonempty_pages(spark, sf_dir):
    """H9: pages whose target element exists (here: at least one paragraph)."""
    pages = read_table(spark, sf_dir, "pages", spread_rows=True)
    f = H.extract_page_fields(pages, "page_id", {"n_paragraphs": ("p", None, "count")})
    return f.filter(F.col("n_paragraphs") > 0)


@register("expand_page_urls", """
SELECT page_id, CAST(g.n AS INTEGER) AS page_num, concat(url, '&page=', CAST(g.n AS VARCHAR)) AS page_url
FROM pages, generate_series(1, CAST(length(html) // 5000 + 1 AS BIGINT)) AS g(n)""")
def q_expand_page_urls(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", "url", (F.length("html") / 5000).cast("int").alias("n0"))
    out = H.expand_page_urls(pages.withColumn("n_pages", F.col("n0") + 1), "n_pages")
    return out.select("page_id", "page_num", "page_url")


@register("url_params", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS param_pos, url_decode(split_part(pair, '=', 1)) AS param_key,
 url_decode(CASE WHEN strpos(pair, '=') > 0 THEN substr(pair, strpos(pair, '=') + 1) ELSE '' END) AS param_value
FROM (SELECT page_id, unnest(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')) AS pair,
        unnest(range(1, len(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')) + 1)) AS i
      FROM pages) t
WHERE pair <> ''""")
def q_url_params(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return H.url_query_params(pages).select("page_id", "param_pos", "param_key", "param_value")


@register("seed_areas", f"""
SELECT c_custkey AS id, c_mktsegment AS city, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE dim.name END AS area
FROM customer JOIN {area_values_sql()} ON dim.k = c_custkey % 31""")
def q_seed_areas(spark, sf_dir):
    """The ``areas[]`` filters of a seed URL per customer."""
    c = read_table(spark, sf_dir, "customer")
    value = F.when(c.c_custkey % 3 == 0, c.c_mktsegment).otherwise(
        F.concat(c.c_mktsegment, F.lit(":"), area_name_at(c.c_custkey)))
    urls = c.select(c.c_custkey.alias("id"), F.concat(F.lit("https://x.example/s?beds=2&areas%5B%5D="), F.url_encode(value),
                                                      F.lit("&page=1")).alias("url"))
    return H.seed_areas(urls).select("id", "city", "area")


_OLD_SQL = {"last_updated": "'updated ' || id", "price": "'$' || price", "n_beds": "CAST(n_beds AS VARCHAR)",
            "n_baths": "CAST(n_baths AS VARCHAR)", "avbl_date": "CAST(available_date AS VARCHAR)",
            "location": "CASE WHEN id % 5 <> 0 THEN location END", "utilities": "utilities",
            "amenities": "CASE WHEN id % 7 <> 0 THEN amenities END"}


@register("old_layout_boxes", with_listings(f"""
SELECT id AS page_id, CAST(0 AS INTEGER) AS box_pos, {", ".join(f"{x} AS {c}" for c, x in _OLD_SQL.items())}
FROM listings"""))
def q_old_layout_boxes(spark, sf_dir):
    """H7 on the older layout: eight fields; the location is the text of the child link, if there is one."""
    k, text = F.col("id"), lambda c: F.col(c).cast("string")
    inner = {
        "last_updated": F.concat(F.lit("updated "), text("id")), "price": F.concat(F.lit("$"), text("price")),
        "n_beds": text("n_beds"), "n_baths": text("n_baths"), "avbl_date": text("available_date"),
        "location": F.when(k % 5 == 0, F.col("location")).otherwise(
            F.concat(F.lit("At <a>"), F.col("location"), F.lit("</a> now"))),
        "utilities": F.col("utilities"),
        "amenities": F.when(k % 7 == 0, F.lit("<b>no</b> single text")).otherwise(F.col("amenities"))}
    cells = [F.concat(F.lit(f'<{spec[0]} class="{spec[1]}">'), inner[c], F.lit(f"</{spec[0]}>"))
             for c, spec in OLD_LAYOUT_FIELDS.items()]
    pages = silver_listings(spark, sf_dir).select(k.alias("page_id"), F.concat(
        F.lit(f'<html><body><{OLD_LAYOUT_BOX[0]} class="{OLD_LAYOUT_BOX[1]}">'), *cells,
        F.lit(f"</{OLD_LAYOUT_BOX[0]}></body></html>")).alias("html"))
    return H.extract_boxes(pages, "page_id")


_BOX_FIELDS = {"title": ("h1", None), "lead": ("b", None), "ad": ("div", "ad")}


_ART = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
_H1 = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"


@register("page_boxes", f"""
SELECT page_id, CAST(0 AS INTEGER) AS box_pos,
 CASE WHEN {_H1} = '' OR contains({_H1}, '<') THEN NULL ELSE {_unescape(_H1)} END AS title,
 CASE WHEN regexp_matches({_ART}, '<b>[^<]+</b>')
      THEN {_unescape(f"regexp_extract({_ART}, '<b>([^<]+)</b>', 1)")} END AS lead,
 NULL::VARCHAR AS ad
FROM pages WHERE html LIKE '%<article>%'""")
def q_page_boxes(spark, sf_dir):
    """H7: boxes found by (tag, class); a field is its single string, else NULL."""
    pages = read_table(spark, sf_dir, "pages", spread_rows=True)
    return H.extract_boxes(pages, "page_id", box=("article", None), fields=_BOX_FIELDS, how="string")
