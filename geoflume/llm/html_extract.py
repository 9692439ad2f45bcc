"""Main text of web pages by template deduction from equivalence classes.

Tokens are elements and text blocks with their element path. Over the distinct
pages of a host, tokens with the same occurrence vector form a class. A class
is valid if it holds on nearly every page, has an element as its frame and its
text tokens follow the same element wherever they occur; by their paths classes
nest in the slots that elements of outer classes leave. Valid classes make up
the host's template, and its text goes. What is left are the slots; those of
menus, notices and the like go by tag, role and name, and all others are the
page's main text. What stands in an article element is never template text.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.llm.common import stage

#: Distinct pages that a host needs for a template (one page has no vectors to compare), the share of them that its classes must cover, and tokens of a class.
MIN_PAGES, COVER, MIN_CLASS = 2, 0.9, 2
SALTS = 16
_OPEN = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)|<[!?]")
_MARK = re.compile("[>\"']")
_LONG_NUMBER = re.compile(r"&#([0-9]{8,})")
_ATTR = re.compile(r"""([a-zA-Z_:@][-\w:.@]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SCRIPT = {"script", "style"}
#: Skipped to their end tag if they have one; else they are elements like others.
_RAW = _SCRIPT | {"noscript", "template", "textarea", "title", "iframe", "svg", "canvas"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "aside", "head"}
_BOILER_TAG = {"nav", "footer", "aside", "button", "select", "dialog", "menu", "head", "fieldset", "datalist", "label"} | _RAW
_BOILER_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}
#: Elements that a name in class or id can mark; it does if all its parts are of these words, one of the first kind at least.
_NAMED = {"div", "section", "ul", "ol", "dl", "table", "center", "ins", "header"}
_BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert comment comments disqus "
    "respond response responses reply replies sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead header footer social share sharing related recommended "
    "recommendations newsletter subscribe subscription popup modal overlay widget widgets toolbar pagination pager login signup search".split()
)
_FRAME_WORDS = frozenset("box bar list section area container wrapper wrap inner outer block links link widget form slot unit site page main top bottom left right side global primary secondary items item buttons panel reader user thread posts articles content".split())
_WORDS = re.compile(r"[a-z]+")
#: Closing one of these also ends an open element of the set given here.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SPACE = re.compile(r"\s+")
_CONTENT = re.compile(r"<(?:article|main|h1)\b", re.I)


def _boiler_name(value: str) -> bool:
    for name in value.lower().split():
        words = _WORDS.findall(name)
        if any(w in _BOILER_WORDS for w in words) and all(w in _BOILER_WORDS or w in _FRAME_WORDS for w in words):
            return True
    return False


def _boiler(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in _BOILER_TAG or tag == "header" and not inside_article:
        return True
    if not attrs or not attrs.strip():
        return False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value.lower() in _BOILER_ROLE:
            return True
        if name in ("class", "id") and tag in _NAMED and not (tag == "header" and inside_article) and _boiler_name(value):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def unescape(text: str) -> str:
    """Text with its character references decoded; decimal ones of any length, which int() would refuse."""
    return html.unescape(_LONG_NUMBER.sub(lambda m: f"&#{m[1].lstrip('0')[:8] or 0}", text))


class _Marks:
    """Places in a page that many tags ask for, found once each, so that a page is read in time linear in its length."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.last = page.rfind(">")
        self.ends: dict[int, int] = {}
        self.next: dict[object, tuple[int, int, int]] = {}

    def find(self, pattern: re.Pattern, at: int) -> tuple[int, int]:
        """Start and end of the pattern's first match from here; the page's size, twice, if there is none. Asked with growing places."""
        asked, start, end = self.next.get(pattern, (self.size + 1, 0, 0))
        if not asked <= at <= start:
            m = pattern.search(self.page, at)
            start, end = m.span() if m else (self.size, self.size)
            self.next[pattern] = (at, start, end)
        return start, end

    def close(self, at: int) -> int:
        """Place of the > that ends the tag whose attributes begin here, -1 if none does; those in quotes don't."""
        if at > self.last:
            return -1
        mark, seen, found = self.find(_MARK, at)[0], [], -1
        while mark < self.size:
            if mark in self.ends:
                found = self.ends[mark]
                break
            seen.append(mark)
            if self.page[mark] == ">":
                found = mark
                break
            shut = self.page.find(self.page[mark], mark + 1)
            m = _MARK.search(self.page, shut + 1) if shut >= 0 else None
            mark = m.start() if m else self.size
        for x in seen:
            self.ends[x] = found
        return found


_END_TAG: dict[str, re.Pattern] = {x: re.compile(rf"</{x}\s*>", re.I) for x in (*_RAW, "form")}
_HOLDS = {"ul", "ol", "dl", "table", "article", "section", "div", "nav", "body", "blockquote"}


class _Open:
    """The open elements: for each its tag, whether it is boilerplate, a hash of its path and the place of the nearest one that holds lists or paragraphs."""

    def __init__(self):
        self.stack: list[tuple[str, bool, str, int]] = []
        self.places: dict[str, list[int]] = {}
        self.bad = 0

    @property
    def path(self) -> str:
        return self.stack[-1][2] if self.stack else ""

    def push(self, tag: str, boiler: bool) -> None:
        limit, n = (self.stack[-1][3] if self.stack else -1), len(self.stack)
        path = xxhash.xxh3_128_hexdigest(f"{self.path}/{tag}".encode()) if tag in _BLOCK else self.path
        self.stack.append((tag, boiler, path, n if tag in _HOLDS else limit))
        self.places.setdefault(tag, []).append(n)
        self.bad += boiler

    def cut(self, n: int) -> None:
        """Close all but the n outermost."""
        while len(self.stack) > n:
            tag, boiler, _, _ = self.stack.pop()
            self.places[tag].pop()
            self.bad -= boiler

    def has(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def ended_by(self, tag: str) -> int | None:
        """Place of the outermost element that this one's start closes."""
        limit = self.stack[-1][3] if self.stack else -1
        inner = [x[i] for t in _ENDS[tag] if (x := self.places.get(t)) and (i := bisect_right(x, limit)) < len(x)]
        return min(inner) if inner else None


def tokens_of(page: str) -> tuple[list[tuple[str, str]], list[tuple[str, str, str, bool]]]:
    """The page's elements outside boilerplate as (token, element before), and its blocks there as (token, element before, text, in an article).

    Takes time linear in the page's length, but for the hash of a path per element and the logarithm of the depth.
    """
    marks, el = _Marks(page), _Open()
    tokens: list[tuple[str, str]] = []
    blocks: list[tuple[str, str, str, bool]] = []
    run: list[str] = []
    at, text_from, n, path, before = 0, 0, len(page), "", ""

    def flush() -> None:
        if run:
            text = _SPACE.sub(" ", unescape("".join(run))).strip()
            run.clear()
            if text:
                blocks.append((f"{path}#{text}", before, text, el.has("article")))

    while at < n:
        m = _OPEN.search(page, at)
        start = m.start() if m else n
        if m and not m[1]:
            if page.startswith("<!--", start):
                shut = page.find("-->", start + 4)
                end = n if shut < 0 else shut + 3
            elif page.startswith("<![CDATA[", start):
                shut = page.find("]]>", start + 9)
                end = n if shut < 0 else shut + 3
            else:
                end = page.find(">", start) + 1 if start < marks.last else 0
        elif m:
            end = marks.close(m.end()) + 1
        if m and not end:  # no tag, so text
            at = m.end()
            continue
        piece = page[text_from:start]
        if piece and not m and (cut := piece.rfind("<")) >= 0 and re.match(r"</?[a-zA-Z][^>]*\Z|<!.*\Z", piece[cut:], re.S):
            piece = piece[:cut]  # a tag that the page's end cuts off
        if piece and not el.bad:
            run.append(piece)
        if not m:
            break
        at = end
        tag, closing = (m[1] or "").lower(), page.startswith("</", start)
        if not tag:
            if page.startswith("<![CDATA[", start) and not el.bad:
                run.append(html.escape(page[start + 9 : end].removesuffix("]]>")))
            text_from = at
            continue
        attrs = page[m.end() : end - 1]
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            run.append(" ")
        if closing:
            if el.has(tag):
                el.cut(el.places[tag][-1])
        else:
            if tag in _ENDS and (outer := el.ended_by(tag)) is not None:
                el.cut(outer)
            boiler = _boiler(tag, attrs, el.has("article"))
            closed = attrs.rstrip().endswith("/")
            shut, after = marks.find(_END_TAG[tag], at) if tag in _END_TAG else (n, n)
            if tag == "form":  # one that wraps the page's content is a frame
                boiler = marks.find(_CONTENT, at)[0] >= shut
            if tag in _SCRIPT or tag in _RAW and shut < n and not closed:
                at = after
            elif tag not in _VOID and not closed:
                boiler &= tag not in _RAW
                el.push(tag, boiler)
                if tag in _BLOCK and not el.bad:
                    tokens.append((f"{path}<{tag}>", before))
        if tag in _BLOCK:
            path = el.path
            before = f"{path}<{'/' if closing else ''}{tag}>"
        text_from = at
    flush()
    return tokens, blocks


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) - (1 << 63)


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


_PAGE = "page_id long, url string, host string, page long, blocks array<struct<token:long,before:long,text:string,fixed:boolean>>, tokens array<struct<token:long,before:long,element:boolean,times:int>>"


def _page_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page: its blocks, its tokens, and as `page` a hash of all its blocks, so that pages of the same text are one."""
    block = pa.list_(pa.struct([("token", pa.int64()), ("before", pa.int64()), ("text", pa.string()), ("fixed", pa.bool_())]))
    token = pa.list_(pa.struct([("token", pa.int64()), ("before", pa.int64()), ("element", pa.bool_()), ("times", pa.int32())]))
    for b in batches:
        hosts, keys, blocks, tokens = [], [], [], []
        for url, page in zip(b.column(1).to_pylist(), b.column(2)):
            elements, texts = tokens_of(page.as_py().decode("utf-8", "replace"))
            hosts.append(host_of(url))
            keys.append(_hash("\0".join(x[2] for x in texts)))
            blocks.append([{"token": _hash(k), "before": _hash(p), "text": t, "fixed": a} for k, p, t, a in texts])
            free = [(x["token"], x["before"]) for x in blocks[-1] if not x["fixed"]]
            seen = [(_hash(k), _hash(p), True) for k, p in elements] + [(k, p, False) for k, p in free]
            first: dict[int, tuple] = {}
            for x in seen:
                first.setdefault(x[0], x)
            times = Counter(x[0] for x in seen)
            tokens.append([{"token": k, "before": p, "element": e, "times": times[k]} for k, p, e in first.values()])
        cols = [b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(blocks, block), pa.array(tokens, token)]
        yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "host", "page", "blocks", "tokens"])


def templates(parsed: DataFrame) -> DataFrame:
    """(host, template): the text tokens of each host's valid classes; pages of the same text count once."""
    pages = parsed.select("host", "page", "tokens").dropDuplicates(["host", "page"])
    size = pages.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") >= MIN_PAGES)
    v = pages.select("host", "page", F.explode("tokens").alias("x")).select("host", "page", "x.*")
    v = v.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.expr("bit_xor(xxhash64(page, times))").alias("vector"), F.bool_or("element").alias("element"), (F.min("before") == F.max("before")).alias("ordered")
    )
    v = v.where(F.col("pages") >= MIN_PAGES).join(size, "host").where(F.col("pages") >= COVER * F.col("host_pages"))
    ordered = F.collect_list(F.when(~F.col("element") & F.col("ordered"), F.col("token")))
    classes = v.groupBy("host", "pages", "vector").agg(ordered.alias("tokens"), F.count("*").alias("n"), F.bool_or("element").alias("framed"))
    return classes.where(F.col("framed") & (F.col("n") >= MIN_CLASS)).groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("template"))


def extract(pages: DataFrame) -> DataFrame:
    """Main text of pages (page_id, url, html; other columns are ignored): page_id, url, text, n_chars.

    A row per input row. Null and blank pages, and pages without main text, give
    an empty text; a page without a host, or of a host whose pages all have the
    same text, has no template and keeps all text outside boilerplate elements.
    Repeated pages are extracted each on its own. An empty table gives no rows.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"))
    parsed = stage(p.mapInArrow(_page_rows, _PAGE), "html-pages")
    t = stage(templates(parsed.where("host <> ''")).where(F.size("template") > 0), "html-templates")
    t = t.select(F.col("host").alias("__host"), "template", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    rows = parsed.select("page_id", "url", "host", "blocks")
    j = rows.join(t, (F.col("host") == F.col("__host")) & (F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)) == F.col("__salt")), "left")
    slots = F.when(F.col("template").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b: b["fixed"] | ~F.array_contains("template", b["token"])))
    text = F.array_join(F.transform(slots, lambda b: b["text"]), "\n\n")
    return j.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def op10_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
