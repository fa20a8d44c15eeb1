"""Captured HTML pages.

The only Python stage of the package: one ``mapInArrow`` pass parses each
page with the standard-library ``html.parser`` and emits raw strings (card
title, property cells, agent hrefs, counter text). Cleaning then happens in
Spark expressions. Pages are independent, so the pass is narrow: it runs
where the page rows are and never shuffles.
"""

from __future__ import annotations

import datetime as dt
import re
from html import unescape as html_unescape
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean as C
from ..functions.area import area_from_paren
from ..schema import (HTML_CARD, HTML_CONTACTS, HTML_CONTAINER, HTML_COUNTER, HTML_PROP_CELL, HTML_PROPS,
                      HTML_TITLE, OLD_LAYOUT_BOX, OLD_LAYOUT_FIELDS)
from ..session import scratch_path

# Rows a Python task hands on at a time; it holds the tree of one page.
_ROWS = 1024

# --- a small DOM over html.parser ------------------------------------------

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_NO_TEXT = {"script", "style", "template"}


class Node:
    """An element. Every element of a page is also kept in document order in
    ``doc`` (shared by the whole tree); ``order``/``end`` delimit its subtree
    there, so searches scan a list slice instead of walking the tree."""
    __slots__ = ("tag", "attrs", "children", "doc", "order", "end")

    def __init__(self, tag, attrs, doc=None):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.doc = doc if doc is not None else []
        self.order = len(self.doc)
        self.end = None
        self.doc.append(self)

    def descendants(self):
        end = self.end if self.end is not None else len(self.doc)
        return self.doc[self.order + 1:end]

    def iter(self):
        return iter(self.descendants())

    def _found(self, tag, cls, attr):
        for n in self.descendants():
            if tag is not None and n.tag != tag:
                continue
            if cls is not None:
                c = n.attrs.get("class")
                if c is None or (c != cls and cls not in c.split()):
                    continue
            if attr is None or n.attrs.get(attr) is not None:
                yield n

    def find_all(self, tag=None, cls=None, attr=None):
        return list(self._found(tag, cls, attr))

    def find(self, tag=None, cls=None, attr=None):
        return next(self._found(tag, cls, attr), None)

    def text(self):
        """All descendant text except scripts, styles and comments."""
        out = []
        stack = [iter(self.children)]
        while stack:
            for ch in stack[-1]:
                if isinstance(ch, Node):
                    if ch.tag not in _NO_TEXT:
                        stack.append(iter(ch.children))
                        break
                else:
                    out.append(ch)
            else:
                stack.pop()
        return "".join(out)

    def string(self):
        """The single string of a node: NULL unless it has exactly one child."""
        node = self
        while True:
            if len(node.children) != 1:
                return None
            ch = node.children[0]
            if isinstance(ch, str):
                return ch
            node = ch


class _Tree:
    def __init__(self):
        self.root = Node("[document]", {})
        self.doc = self.root.doc
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        n = Node(tag, dict(attrs), self.doc)
        self.stack[-1].children.append(n)
        if tag not in _VOID:
            self.stack.append(n)
        else:
            n.end = len(self.doc)

    def handle_startendtag(self, tag, attrs):
        n = Node(tag, dict(attrs), self.doc)
        n.end = len(self.doc)
        self.stack[-1].children.append(n)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                end = len(self.doc)
                for n in self.stack[i:]:
                    n.end = end
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


class _Builder(_Tree, HTMLParser):
    def __init__(self):
        HTMLParser.__init__(self, convert_charrefs=True)
        _Tree.__init__(self)


# Fast path: simple, well-formed markup is tokenised with a few regexes and
# built with the same tree rules; anything outside this grammar sends the
# whole page to html.parser.
_TOKEN = re.compile(r"<(?:(!--)|(/)?([a-zA-Z][a-zA-Z0-9:_-]*)|(!)|)")
_ATTRS = re.compile(r"""((?:\s+[a-zA-Z_:][-a-zA-Z0-9_:.]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`]+))?)*)\s*(/?)>""")
_ATTR = re.compile(r"""\s+([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_END = re.compile(r"\s*>")
# A whole tag at once; what it does not match is looked at piece by piece.
_TAG = re.compile("<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)" + _ATTRS.pattern)
_DOCTYPE = re.compile(r"!doctype[^<>]*>", re.I)


def _unescape_text(t: str) -> str:
    return html_unescape(t) if "&" in t else t


def _attributes(inner: str) -> list[tuple[str, str | None]]:
    attrs = []
    for am in _ATTR.finditer(inner):
        name, double, single, bare = am.groups()
        v = double if double is not None else single if single is not None else bare
        attrs.append((name.lower(), None if v is None else _unescape_text(v)))
    return attrs


def _fast_parse(doc: str) -> Node | None:
    b = _Tree()
    pos, n = 0, len(doc)
    while pos < n:
        i = doc.find("<", pos)
        if i < 0:
            b.handle_data(_unescape_text(doc[pos:]))
            break
        whole = _TAG.match(doc, i)
        if whole:
            slash, name, inner, closed = whole.groups()
            tag = name.lower()
            if slash:
                if inner or closed:
                    return None
                if i > pos:
                    b.handle_data(_unescape_text(doc[pos:i]))
                b.handle_endtag(tag)
                pos = whole.end()
                continue
            if tag not in ("script", "style"):
                if i > pos:
                    b.handle_data(_unescape_text(doc[pos:i]))
                (b.handle_startendtag if closed else b.handle_starttag)(tag, _attributes(inner) if inner else ())
                pos = whole.end()
                continue
        m = _TOKEN.match(doc, i)
        comment, slash, name, bang = m.group(1), m.group(2), m.group(3), m.group(4)
        if not (comment or name or bang):
            nxt = doc[i + 1:i + 2]
            if nxt in ("/", "?", ""):
                return None  # odd end tags, processing instructions, trailing '<'
            j = doc.find("<", i + 1)  # '<' followed by text: plain data
            j = n if j < 0 else j
            b.handle_data(_unescape_text(doc[pos:j]))
            pos = j
            continue
        if i > pos:
            b.handle_data(_unescape_text(doc[pos:i]))
        if comment:
            j = doc.find("-->", i + 4)
            if j < 0 or "--!>" in doc[i:j + 3] or doc.startswith("<!-->", i) or doc.startswith("<!--->", i):
                return None
            pos = j + 3
            continue
        if bang:
            d = _DOCTYPE.match(doc, i + 1)
            if not d:
                return None
            pos = d.end()
            continue
        tag = name.lower()
        if slash:
            e = _END.match(doc, m.end())
            if not e:
                return None
            b.handle_endtag(tag)
            pos = e.end()
            continue
        a = _ATTRS.match(doc, m.end())
        if not a:
            return None
        attrs = _attributes(a.group(1))
        pos = a.end()
        if a.group(2):
            b.handle_startendtag(tag, attrs)
            continue
        b.handle_starttag(tag, attrs)
        if tag in ("script", "style"):
            e = re.compile(r"</" + tag + r"[\t\n\r\f />]", re.I).search(doc, pos)
            if not e:
                return None
            close = doc.find(">", e.end() - 1)
            if close < 0 or doc[e.end():close].strip(" \t\n\r\f/"):
                return None
            if e.start() > pos:
                b.handle_data(doc[pos:e.start()])
            b.handle_endtag(tag)
            pos = close + 1
    return b.root


def parse_html(html: str | None, fast: bool = True) -> Node:
    """The page as a tree. Simple markup takes the regex fast path; anything
    else (and ``fast=False``) is parsed by the standard-library html.parser."""
    if html and fast:
        root = _fast_parse(html)
        if root is not None:
            return root
    b = _Builder()
    if html:
        b.feed(html)
        b.close()
    return b.root


# --- H1-H6: listing cards ---------------------------------------------------

CARD_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("page_num", T.IntegerType()),
    T.StructField("has_container", T.BooleanType()),
    T.StructField("n_cards", T.IntegerType()),
    T.StructField("counter_text", T.StringType()),
    T.StructField("agent_name_text", T.StringType()),
    T.StructField("agent_phone_href", T.StringType()),
    T.StructField("agent_email_href", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("title_text", T.StringType()),
    T.StructField("first_href", T.StringType()),
    T.StructField("props", T.ArrayType(T.StringType())),
])


def _li_href(items, i):
    if len(items) <= i:
        return None
    a = items[i].find("a", attr="href")
    return a.attrs.get("href") if a is not None else None


def _cards_of_page(source_id, page_num, root):
    container = root.find("div", HTML_CONTAINER)
    cards = container.find_all("div", HTML_CARD) if container is not None else []
    counter = root.find("div", HTML_COUNTER)
    contacts = root.find("div", HTML_CONTACTS)
    items = contacts.find_all("li") if contacts is not None else []
    page = {
        "source_id": source_id, "page_num": page_num, "has_container": container is not None,
        "n_cards": len(cards), "counter_text": counter.text() if counter is not None else None,
        "agent_name_text": items[0].text() if items else None,
        "agent_phone_href": _li_href(items, 1), "agent_email_href": _li_href(items, 2),
    }
    if not cards:
        yield {**page, "pos": None, "title_text": None, "first_href": None, "props": None}
        return
    for pos, card in enumerate(cards):
        props = card.find("div", HTML_PROPS)
        cells = [c.text() for c in props.find_all("div", HTML_PROP_CELL)] if props is not None else []
        title = card.find("a", HTML_TITLE)
        first_a = card.find("a")
        yield {**page, "pos": pos, "title_text": title.text() if title is not None else None,
               "first_href": first_a.attrs.get("href") if first_a is not None else None, "props": cells}


_ARROW = {T.StringType: "string", T.IntegerType: "int32", T.BooleanType: "bool_", T.LongType: "int64"}


def _arrow_schema(schema: T.StructType):
    import pyarrow as pa

    def conv(dt):
        if isinstance(dt, T.ArrayType):
            return pa.list_(conv(dt.elementType))
        return getattr(pa, _ARROW[type(dt)])()
    return pa.schema([pa.field(f.name, conv(f.dataType)) for f in schema.fields])


def _each_page(pages):
    """Number and tree of each page in turn; a tree is taken apart before the next is built.

    The elements and their list refer to each other, so the trees of a batch
    would else stay until the garbage collector finds them.
    """
    for i in range(len(pages)):
        root = parse_html(pages[i].as_py())
        yield i, root
        root.doc.clear()


def _extract_cards_batches(batches):
    """mapInArrow body: Arrow batches of pages in, Arrow batches of cards out
    (no pandas round trip; columns are built as Python lists)."""
    import pyarrow as pa

    schema = _arrow_schema(CARD_SCHEMA)
    names = CARD_SCHEMA.fieldNames()
    for batch in batches:
        cols = {n: [] for n in names}
        src, num = batch.column("source_id"), batch.column("page_num")
        for i, root in _each_page(batch.column("html")):
            for row in _cards_of_page(src[i].as_py(), num[i].as_py(), root):
                for n in names:
                    cols[n].append(row[n])
                if len(cols["pos"]) >= _ROWS:
                    yield pa.RecordBatch.from_pydict(cols, schema=schema)
                    cols = {n: [] for n in names}
        yield pa.RecordBatch.from_pydict(cols, schema=schema)


def extract_cards(pages: DataFrame) -> DataFrame:
    """H1-H6, H9: one row per card ``(source_id, page_num, pos, raw fields...)``.

    A page without cards (or without the results container) yields one row
    with ``pos`` NULL and ``n_cards`` 0, so the page still counts for the
    crawl cutoff.
    """
    return pages.select("source_id", "page_num", "html").mapInArrow(_extract_cards_batches, CARD_SCHEMA)


def stage_cards(pages: DataFrame) -> DataFrame:
    """``extract_cards``, written once to the shared scratch folder and read back.

    The crawl cutoff, the kept cards and the page agents all read the cards;
    on the lazy frame each of them would parse every page again, and parsing is
    what costs. Cards are far smaller than their pages, and the written columns
    are pruned for each reader.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "cards")
    extract_cards(pages).write.parquet(path)
    return spark.read.schema(CARD_SCHEMA).parquet(path)


def page_facts(cards: DataFrame) -> DataFrame:
    """One row per page (its first card row): ``(source_id, page_num, n_cards, counter)``."""
    first = cards.filter(F.col("pos").isNull() | (F.col("pos") == 0))
    return first.select("source_id", "page_num", "n_cards",
                        C.first_number(C.strip_text("counter_text")).alias("counter"))


def page_cutoff(facts: DataFrame, counter_stop: bool = True) -> DataFrame:
    """The last page the crawl stores, per source: ``(source_id, last_page)``.

    (a) The first page with no cards stops the crawl and is not stored.
    (b) The first page showing a counter number stores it; the first later
        page showing the same number is stored and stops the crawl.
    Computed with grouped aggregates (partial on the map side), not a
    window over a whole source.
    """
    agg = facts.groupBy("source_id").agg(
        F.min(F.when(F.col("n_cards") == 0, F.col("page_num"))).alias("empty_page"),
        F.min(F.when(F.col("counter").isNotNull(), F.col("page_num"))).alias("first_counter_page"),
        F.min_by("counter", F.when(F.col("counter").isNotNull(), F.col("page_num"))).alias("first_counter"),
        F.max("page_num").alias("max_page"))
    if counter_stop:
        f = facts.alias("f").join(agg.alias("a"), "source_id")
        repeat = (f.filter((F.col("f.page_num") > F.col("a.first_counter_page"))
                           & (F.col("f.counter") == F.col("a.first_counter")))
                  .groupBy("source_id").agg(F.min("f.page_num").alias("repeat_page")))
        agg = agg.join(repeat, "source_id", "left")
    else:
        agg = agg.withColumn("repeat_page", F.lit(None).cast("int"))
    # Stop at the empty page (exclusive) or the repeat page (inclusive), whichever comes first.
    last = F.least(F.col("empty_page") - 1, F.col("repeat_page"))
    return agg.select("source_id", F.coalesce(last, F.col("max_page")).alias("last_page"))


def apply_cutoff(cards: DataFrame, cutoff: DataFrame) -> DataFrame:
    """Keep card rows on pages up to the cutoff; the cutoff frame has one row per source."""
    return (cards.join(cutoff, "source_id")
            .filter((F.col("page_num") <= F.col("last_page")) & F.col("pos").isNotNull())
            .drop("last_page"))


def clean_cards(cards: DataFrame, as_of: dt.date, fees: str | None = "Yes") -> DataFrame:
    """P3, P5, P6, P9, P13, P17, P18 over extracted cards -> listing columns.

    Missing property cells are NULL here; ``carry_forward`` restores the
    stale-value behaviour on request. A cell that is there but cannot be
    parsed is a reject: ``_reject_reason`` names it (NULL: clean row).
    """
    prop = lambda i: F.get(F.col("props"), i)
    # Texts first, in their own projection: the rules read each of them
    # several times, and Spark does not share work across CASE branches.
    texts = cards.select(
        "source_id", "page_num", "pos", "first_href",
        C.strip_text("title_text").alias("__location"),
        C.strip_text(prop(0)).alias("__price"),
        prop(1).alias("__beds_raw"),
        F.regexp_replace(C.strip_text(prop(1)), r"[^0-9.]", "").alias("__beds"),
        C.strip_text(prop(2)).alias("__baths"),
        C.available_digits(prop(3)).alias("__avail"), prop(3).isNull().alias("__no_avail"),
        C.strip_text("agent_name_text").alias("agent_name"),
        C.href_payload("agent_email_href").alias("agent_email"),
        C.href_payload("agent_phone_href").alias("agent_phone"))
    location, beds, baths = F.col("__location"), F.col("__beds"), F.col("__baths")
    clean = texts.select(
        "source_id", "page_num", "pos",
        F.lit(None).cast("date").alias("last_updated"),
        C.clean_price_html("__price").alias("price"),
        F.when(F.col("__beds_raw").isNull(), F.lit(None).cast("double"))
        .when(beds.isin("0", ""), F.lit(1.0)).otherwise(beds.try_cast("double")).alias("n_beds"),
        F.when(baths.isNull(), F.lit(None).cast("double"))
        .otherwise(C.clean_count_raw_default(baths)).alias("n_baths"),
        F.when(F.col("__no_avail"), F.lit(None).cast("date"))
        .otherwise(C.clean_available_html("__avail", as_of, digits=True).cast("date")).alias("available_date"),
        location.alias("location"),
        F.when(location.isNull(), F.lit(None).cast("string")).otherwise(area_from_paren(location)).alias("area"),
        F.col("first_href").alias("utilities"),
        F.col("first_href").alias("amenities"),
        "agent_name", "agent_email", "agent_phone",
        F.lit(fees).cast("string").alias("agent_fees"),
        F.col("__price").isNotNull().alias("__has_price"), F.col("__beds_raw").isNotNull().alias("__has_n_beds"),
        baths.isNotNull().alias("__has_n_baths"), (~F.col("__no_avail")).alias("__has_available_date"))
    cells = ("price", "n_beds", "n_baths", "available_date")
    reason = F.concat_ws("; ", *[F.when(F.col(f"__has_{c}") & F.col(c).isNull(), f"unparsable {c}") for c in cells])
    return (clean.withColumn("_reject_reason", F.when(reason != "", reason))
            .drop(*[f"__has_{c}" for c in cells]))


def page_agents(cards: DataFrame) -> DataFrame:
    """H3 as its own frame: one agent row per page."""
    first = cards.filter(F.col("pos").isNull() | (F.col("pos") == 0))
    return first.select("source_id", "page_num", C.strip_text("agent_name_text").alias("agent_name"),
                        C.href_payload("agent_email_href").alias("agent_email"),
                        C.href_payload("agent_phone_href").alias("agent_phone"))


def join_page_agent(cards: DataFrame, agents: DataFrame) -> DataFrame:
    """Attach the page-level agent to every card of the page.

    The key (source, page) is one page, so no key can be hot.
    """
    return cards.join(agents, ["source_id", "page_num"], "left")


# --- H7: generic field extraction --------------------------------------------

def _field_value(box: Node, spec, how: str):
    tag, cls = spec[0], spec[1]
    n = box.find(tag, cls)
    for child_tag in spec[2:]:
        if n is None:
            break
        n = n.find(child_tag)
    if n is None:
        return None
    if how == "string":
        return n.string()
    if how == "text":
        return n.text()
    return n.attrs.get(how)


def extract_boxes(pages: DataFrame, key_col: str, html_col: str = "html", box=OLD_LAYOUT_BOX,
                  fields=None, how: str = "string") -> DataFrame:
    """H7: one row per box ``(page_key, box_pos, *fields)`` found by (tag, exact class).

    ``fields`` maps a name to ``(tag, class[, child_tag...])``; ``how`` is
    'string' (text only when the tag holds exactly one string), 'text', or an
    attribute name.
    """
    import pyarrow as pa

    fields = dict(fields or OLD_LAYOUT_FIELDS)
    schema = T.StructType([pages.schema[key_col], T.StructField("box_pos", T.IntegerType())]
                          + [T.StructField(n, T.StringType()) for n in fields])

    types = [pa.int64(), pa.int32(), *[pa.string() for _ in fields]]

    def batch(keys, rows):
        page, *cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([keys.take(page), *cols], names=schema.names)

    def run(batches):
        for b in batches:
            rows = []
            for i, root in _each_page(b.column(1)):
                for k, found in enumerate(root.find_all(box[0], box[1])):
                    rows.append((i, k, *[_field_value(found, spec, how) for spec in fields.values()]))
                    if len(rows) >= _ROWS:
                        yield batch(b.column(0), rows)
                        rows = []
            if rows:
                yield batch(b.column(0), rows)

    return pages.select(key_col, html_col).mapInArrow(run, schema)


def _page_field(root, tag, cls, how):
    if how == "count":
        return len(root.find_all(tag, cls))
    node = root.find(tag, cls, None if how in ("text", "string") else how)
    if node is None:
        return None
    return node.text() if how == "text" else node.string() if how == "string" else node.attrs.get(how)


def extract_page_fields(pages: DataFrame, key_col: str, spec: dict, html_col: str = "html", keep=()) -> DataFrame:
    """H4/H5/H7 on whole pages: the first element per spec ``{name: (tag, class, how)}``.

    ``how`` is 'text', 'string', 'count' (number of matches) or an attribute
    name (first element that has it). ``keep`` columns are carried through.
    """
    import pyarrow as pa

    kept = [key_col, *keep]
    schema = T.StructType([pages.schema[c] for c in kept]
                          + [T.StructField(n, T.IntegerType() if how == "count" else T.StringType())
                             for n, (_, _, how) in spec.items()])
    types = [pa.int32() if how == "count" else pa.string() for _, _, how in spec.values()]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, _ROWS):
                part = b.slice(at, _ROWS)
                rows = [[_page_field(root, *one) for one in spec.values()] for _, root in _each_page(part.column(len(kept)))]
                cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], *cols], names=schema.names)

    return pages.select(*kept, html_col).mapInArrow(run, schema)


# --- R4, R5: URLs -------------------------------------------------------------

def expand_page_urls(sources: DataFrame, n_pages_col: str, url_col: str = "url") -> DataFrame:
    """One row per page ``url + '&page=' + n`` for n in 1..n_pages."""
    return (sources.withColumn("page_num", F.explode(F.sequence(F.lit(1), F.col(n_pages_col).cast("int"))))
            .withColumn("page_url", F.concat(F.col(url_col), F.lit("&page="), F.col("page_num").cast("string"))))


def url_query_params(df: DataFrame, url_col: str = "url") -> DataFrame:
    """All query parameters of a URL: one row per ``(param_pos, param_key, param_value)``,
    percent- and plus-decoded."""
    q = F.regexp_extract(F.col(url_col), r"\?([^#]*)", 1)
    pairs = F.split(q, "&")
    exploded = df.select("*", F.posexplode(pairs).alias("param_pos", "pair")).filter(F.col("pair") != "")
    key = F.get(F.split(F.col("pair"), "=", 2), 0)
    val = F.coalesce(F.get(F.split(F.col("pair"), "=", 2), 1), F.lit(""))
    return (exploded.withColumn("param_key", F.try_url_decode(key))
            .withColumn("param_value", F.try_url_decode(val)).drop("pair"))


def seed_areas(df: DataFrame, url_col: str = "url", param: str = "areas[]") -> DataFrame:
    """The ``areas[]`` filters of seed URLs as ``(city, area)``; a bare city has NULL area."""
    p = url_query_params(df, url_col).filter(F.col("param_key") == param)
    parts = F.split(F.col("param_value"), ":", 2)
    return p.withColumn("city", F.get(parts, 0)).withColumn("area", F.get(parts, 1))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages ``(source_id, page_num, url, html)`` from Parquet."""
    from ..schema import PAGES

    return spark.read.schema(PAGES).parquet(path)
