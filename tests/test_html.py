"""HTML extraction on the FIXTURES.md §1.2 card page, crawl cutoff, URLs."""

import datetime as dt

from pyspark.sql import functions as F

from rentlens.operators.windows import carry_forward
from rentlens.schema import PAGES
from rentlens.sources import html_pages as H

CARD_PAGE = """<div class="contacts"><ul><li>Agent 7</li><li><a href="tel:617-555-0007">call</a></li>
  <li><a href="mailto:agent7@example.com">mail</a></li></ul></div>
<div class="counter">Page {n} of 3</div>
<div class="search_results_area">{cards}</div>"""
CARD = """<div class="property_item"><a class="item_title" href="/l/{i}">12 Main St (Back Bay)</a>
    <div class="item_props"><div class="column">$2,895</div><div class="column">2 Beds</div>
      <div class="column">1.5 Baths</div>{avail}</div></div>"""
AVAIL = '<div class="column">Available 09/01/2023</div>'


def page(n, counter, n_cards, src="s", drop_avail=()):
    cards = "".join(CARD.format(i=i, avail="" if i in drop_avail else AVAIL) for i in range(n_cards))
    html = CARD_PAGE.format(n=counter, cards=cards)
    if counter is None:
        html = html.replace('<div class="counter">Page None of 3</div>', "")
    return (src, n, f"https://x.example/{src}?page={n}", html)


def test_extract_and_clean_card(spark):
    pages = spark.createDataFrame([page(1, 1, 1)], PAGES)
    cards = H.clean_cards(H.extract_cards(pages), dt.date(2024, 6, 30)).collect()
    assert len(cards) == 1
    r = cards[0]
    assert (r.price, r.n_beds, r.n_baths) == (2895, 2.0, 1.5)
    assert r.available_date == dt.date(2023, 9, 1)
    assert (r.location, r.area) == ("12 Main St (Back Bay)", "Back Bay")
    assert (r.agent_name, r.agent_phone, r.agent_email) == ("Agent 7", "617-555-0007", "agent7@example.com")
    assert r.utilities == r.amenities == "/l/0" and r.agent_fees == "Yes"


def _cutoff(spark, rows):
    pages = spark.createDataFrame(rows, PAGES)
    facts = H.page_facts(H.extract_cards(pages))
    return {r.source_id: r.last_page for r in H.page_cutoff(facts).collect()}


def test_cutoff_repeated_counter(spark):
    # counters 1,2,1,2 -> pages 1-3 kept
    assert _cutoff(spark, [page(1, 1, 2), page(2, 2, 2), page(3, 1, 2), page(4, 2, 2)]) == {"s": 3}


def test_cutoff_empty_page(spark):
    # cards 20,20,0,20 -> pages 1-2 kept
    rows = [page(1, 1, 20), page(2, 2, 20), page(3, 3, 0), page(4, 4, 20)]
    assert _cutoff(spark, rows) == {"s": 2}


def test_cutoff_no_stop(spark):
    assert _cutoff(spark, [page(1, 1, 1), page(2, 2, 1), page(3, None, 1)]) == {"s": 3}


def test_carry_forward_blocks(spark):
    # Block size 2 pages: carry crosses block boundaries through the block frame.
    rows = [("a", p, i, (None if (p * 10 + i) % 3 else p * 10 + i)) for p in range(1, 8) for i in range(3)]
    df = spark.createDataFrame(rows, "src string, p int, pos int, v int")
    out = carry_forward(df, ["v"], ["src"], ["p", "pos"], block=F.floor(F.col("p") / 2))
    got = [r.v for r in out.orderBy("p", "pos").collect()]
    last, want = None, []
    for _, p, i, v in rows:
        last = v if v is not None else last
        want.append(last)
    assert got == want


def test_generic_boxes(spark):
    html = ('<div class="col-sm-6 col-xs-12"><div class="rentPrice">$1,000</div>'
            '<div class="fa-fw fas fa-bed">2</div><div class="listingLocation col-xs-12"><a>1 A St</a></div>'
            '<span class="listingHHW">Heat</span><div class="listingAmenities"><b>x</b>y</div></div>'
            '<div class="col-sm-6">not a box</div>')
    df = spark.createDataFrame([(1, html)], "k long, html string")
    rows = H.extract_boxes(df, "k").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.price, r.n_beds, r.location, r.utilities, r.amenities, r.last_updated) == \
        ("$1,000", "2", "1 A St", "Heat", None, None)


def test_urls(spark):
    seed = ("https://example.test/agent?areas%5B%5D=Boston&areas%5B%5D=Boston%3AAllston"
            "&areas%5B%5D=Boston%3ABack+Bay&page=1")
    df = spark.createDataFrame([(seed, 3)], "url string, n int")
    got = [(r.city, r.area) for r in H.seed_areas(df).orderBy("param_pos").collect()]
    assert got == [("Boston", None), ("Boston", "Allston"), ("Boston", "Back Bay")]
    urls = [r.page_url for r in H.expand_page_urls(df, "n").orderBy("page_num").collect()]
    assert urls[0] == seed + "&page=1" and urls[2].endswith("page=1&page=3")


def _tree(n):
    kids = []
    for c in n.children:
        if isinstance(c, str):
            if kids and isinstance(kids[-1], str):
                kids[-1] += c
            else:
                kids.append(c)
        else:
            kids.append(_tree(c))
    return (n.tag, tuple(sorted(n.attrs.items(), key=lambda kv: kv[0])), tuple(kids))


SNIPPETS = ['<p>a < b &amp; c<br/>d</p>', '<div class="x y">t</div><!-- c --><script>if (a<b) {x="</p>"}</script>z',
            '<A HREF="/X?a=1&amp;b=2">L</A><img src=x.png alt>', '<p>unclosed <b>bold <i>it</p> tail',
            '<?xml x?><p>x</p>', '<div><![CDATA[x]]></div>', '</ p>', 'a <3 b', '<p title=\'q"\'>x</p>',
            '<style>p{}</style><p>&copy;&#39;</p>', '<!DOCTYPE html><ul><li>1<li>2</ul>', '<a href="x">', '']


def test_fast_parser_matches_html_parser():
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"]).column(0).to_pylist()
    docs += SNIPPETS + [CARD_PAGE.format(n=1, cards=CARD.format(i=0, avail=AVAIL))]
    for d in docs:
        assert _tree(H.parse_html(d)) == _tree(H.parse_html(d, fast=False)), d[:120]


def _batch(n_pages, n_cards):
    import pyarrow as pa

    card = '<div class="property_item"><a class="item_title" href="/l/1">x (Allston)</a></div>'
    page = f'<html><body><div class="search_results_area">{card * n_cards}</div></body></html>'
    return pa.RecordBatch.from_pydict({"source_id": ["s"] * n_pages, "page_num": pa.array(range(n_pages), pa.int32()),
                                       "html": [page] * n_pages})


def test_cards_are_handed_on_in_bounded_batches():
    out = list(H._extract_cards_batches([_batch(5, 1500)]))
    rows = [r for b in out for r in b.to_pylist()]
    assert max(b.num_rows for b in out) <= H._ROWS
    assert [(r["page_num"], r["pos"]) for r in rows] == [(p, i) for p in range(5) for i in range(1500)]


def test_trees_of_read_pages_are_not_kept():
    import gc

    gc.collect()
    gc.disable()
    try:
        known = sum(isinstance(x, H.Node) for x in gc.get_objects())
        list(H._extract_cards_batches([_batch(50, 20)]))
        assert sum(isinstance(x, H.Node) for x in gc.get_objects()) - known < 100
    finally:
        gc.enable()


def test_whole_tags_and_odd_ones_give_the_same_tree():
    odd = ["<p a b=c>x</p >", '<P A="1"B=2>', "<br/><br />", "</a b>", "</a/>", "<div a=\"<\">y</div>", "<script/>a</script>",
           "<style >a<b</style>", "<a href='x&amp;y'>z</a>", "<i\n>w</i>"]
    for d in odd:
        fast = H._fast_parse(d)
        assert fast is None or _tree(fast) == _tree(H.parse_html(d, fast=False)), d
