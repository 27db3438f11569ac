"""Main text of web pages by deducing the templates of their hosts.

A page is a sequence of tokens: its elements, told apart by their path of names, classes
and ids, and its runs of text, told apart by path and content. A token's occurrence
vector says how often it stands on each page of the host. Tokens that share a vector form
an equivalence class; classes that stand on most pages, in one order and within each
other's elements, are the host's template. What the template does not hold are slots,
and the main text is what fills the slots of its main container: the page's article
where it is marked as one, else the container that most of the host's free text is in.

Vectors are never built: a class is known by the exclusive or of hashes of (page, count)
over the pages that hold a token, which is equal for equal vectors, adds up before the
shuffle, and takes eight bytes however many pages a host has.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import saved

# Names of elements and words of classes and ids, by what they stand for.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = set(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr""".split()
)
CLOSES_P = set(
    """address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul""".split()
)
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table select article section div main body".split())
NEVER = RAW | set("head nav aside footer form button select option input dialog menu svg math canvas object audio video map".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ASIDE = set(
    """ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disclaimer discussion disqus footer gdpr legal login masthead menu modal nav navbar
    navigation newsletter notice notices notification pager pagination popup popover promo promotion promoted recommended
    related replies reply respond responses rail search share sharing sidebar sidebars signup skip social sponsor sponsored
    subscribe subscription teaser toolbar topbar widget widgets""".split()
)
ARTICLE = set("article post entry story content".split())  # an article's own header is no page header
LAYOUT = set("has with no without".split())  # as in "with-sidebar": what is around, not what it is
CONTAINERS = ("article", "main")
HEADINGS = {"h1", "h2"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>?)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(frozen=True)
class Template:
    """``share``: of a host's pages, how many hold a template token at least.

    ``least_pages``: a host with fewer pages has no template, nor has a token on fewer.
    ``inner``: a container is entered while it holds this share of the text around it.
    ``broadcast_bytes``: templates that are larger in all are joined by a shuffle.
    """

    share: float = 0.8
    least_pages: int = 8
    inner: float = 0.7
    broadcast_bytes: int = 8 << 20


@dataclass
class Element:
    name: str
    token: int
    parent: "Element | None"
    out: bool  # not main text by its name, role or words
    link: bool
    words_out: bool = False  # out by its classes and ids only
    main: str = ""  # the name of the container it is or lies in
    holds: bool = False  # a container lies within it
    chars: int = 0
    links: int = 0


@dataclass
class Block:
    """A run of text between the bounds of blocks."""

    element: Element
    pieces: list[str] = field(default_factory=list)
    links: int = 0
    heading: bool = False
    text: str = ""


def _hash(parent: int, label: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent}/{label}".encode("utf-8", "surrogatepass"))


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """The blocks of a page that no element's name excludes, in their order, and its elements.

    Closing tags that are left out follow from what opens next; unclosed ones end with
    the element around them. Markup that breaks off at the page's end is no text.
    """
    root = Element("", 0, None, False, False)
    stack, elements, blocks, block = [root], [root], [], None
    at, size = 0, len(page)

    def close(element: Element) -> None:
        while stack[-1] is not element:
            stack.pop()
        stack.pop()

    def end_block() -> None:
        nonlocal block
        block = None

    def text(piece: str) -> None:
        nonlocal block
        top = stack[-1]
        if top.out or not piece:
            return
        if block is None:
            if piece.isspace():
                return
            home = next((e for e in reversed(stack) if e.name not in INLINE), root)
            block = Block(home, heading=home.name in HEADINGS)
            blocks.append(block)
        block.pieces.append(piece)
        if top.link:
            block.links += len(piece.strip())

    while at < size:
        tag = TAG.search(page, at)
        if tag is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)
            text(html.unescape(rest[: cut.start()] if cut else rest))
            break
        if tag.start() > at:
            text(html.unescape(page[at : tag.start()]))
        at = tag.end()
        if tag.group(2) is None:
            continue
        if not tag.group(4):  # a stray quote, or the page breaks off within the tag
            past = page.find(">", at)
            at = past + 1 if past >= 0 else size
            if past < 0:
                break
        name = tag.group(2).lower()
        if name not in INLINE:
            end_block()
        if tag.group(1):
            match = next((e for e in reversed(stack[1:]) if e.name == name), None)
            if match:
                close(match)
            continue
        if name in CLOSES_P:
            for e in reversed(stack[1:]):
                if e.name == "p":
                    close(e)
                    break
                if e.name not in INLINE:
                    break
        if name in SAME:
            for e in reversed(stack[1:]):
                if e.name in SAME[name]:
                    close(e)
                    if name != "tr":
                        break
                elif e.name in SCOPE:
                    break
        given = _attributes(tag.group(3)) if tag.group(3).strip(" /") else {}
        top = stack[-1]
        marks = f"{given.get('class', '')} {given.get('id', '')}"
        label = name
        if marks != " ":  # ids count pages, and so do long numbers in classes
            label += "".join("." + re.sub(r"\d{3,}", "#", c) for c in sorted(given.get("class", "").split()))
            label += "#" + re.sub(r"\d+", "#", given.get("id", ""))
        role = given.get("role", "").lower()
        main = "article" if given.get("itemprop") == "articleBody" else "main" if role == "main" else role if role == "article" else name
        element = Element(name, _hash(top.token, label), top, top.out, top.link or name == "a")
        element.main = main if main in CONTAINERS and top.main != "article" else top.main
        # a page's header goes, an article's own stays
        fixed = name in NEVER or role in ROLES or (name == "header" and not top.main) or "hidden" in given
        fixed = fixed or given.get("aria-hidden") == "true" or bool(HIDDEN.search(given.get("style", "")))
        words = {w.lower() for w in WORDS.findall(marks)} if marks != " " else set()
        element.words_out = bool(words & ASIDE) or ("header" in words and not top.main and not words & ARTICLE)
        element.words_out &= not words & LAYOUT
        element.out = top.out or fixed
        if name not in VOID:
            elements.append(element)
            if element.main and element.main != top.main and not element.out:
                around = top
                while around is not None and not around.holds:
                    around.holds, around = True, around.parent
        if name in RAW:
            ending = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            past = page.find(">", ending.end()) if ending else -1
            at = past + 1 if past >= 0 else size
            continue
        if name not in VOID:
            stack.append(element)
        elif name == "br":
            text(" ")
    for b in blocks:
        b.text = " ".join("".join(b.pieces).split())
    return [b for b in blocks if b.text and not _out(b.element)], elements


def _out(element: Element | None) -> bool:
    """Whether classes and ids exclude it: those of an element around the article do not."""
    while element is not None:
        if element.words_out and not element.holds and element.name not in ("html", "body"):
            return True
        element = element.parent
    return False


def _tokens(blocks: list[Block], elements: list[Element]) -> dict[int, list]:
    """token -> [parent, is text, is heading, count, characters, of them in links, position], of one page."""
    for b in blocks:
        e = b.element
        e.chars += len(b.text)
        e.links += min(b.links, len(b.text))
    for e in reversed(elements):  # children come after their parents
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.links += e.links
    found: dict[int, list] = {}
    for place, e in enumerate(elements):
        row = found.setdefault(e.token, [e.parent.token if e.parent else 0, False, e.name in HEADINGS, 0, 0, 0, place])
        row[3] += 1
        row[4] += e.chars
        row[5] += e.links
    for place, b in enumerate(blocks):
        row = found.setdefault(text_token(b), [b.element.token, True, b.heading, 0, 0, 0, place])
        row[3] += 1
        row[4] += len(b.text)
        row[5] += min(b.links, len(b.text))
    return found


def text_token(block: Block) -> int:
    return _hash(block.element.token, "text " + block.text)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


OCCURRENCES = (
    "host string, token long, parent long, is_text boolean, heading boolean, vector long, n long, chars long, links long, place long"
)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in OCCURRENCES.split(", ")]
    for batch in batches:
        hosts, pages = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out: list[list] = [[] for _ in names]
        for host, page in zip(hosts, pages):
            key = xxhash.xxh3_64_intdigest(page.encode("utf-8", "surrogatepass"))
            for token, (parent, is_text, heading, n, chars, links, place) in _tokens(*parse(page)).items():
                vector = _hash(key, str(n))
                row = (host, _signed(token), _signed(parent), is_text, heading, _signed(vector), n, chars, links, place)
                for column, value in zip(out, row):
                    column.append(value)
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


def occurrences(pages: DataFrame, p: Template) -> DataFrame:
    """One row a host and token with its class (``vector``, pages, n) and its text; rare tokens are left out.

    Pages that are equal count once. Of a host's tokens only those on a large share of its
    pages are left, so that their number is bounded by the size of a page.
    """
    texts = pages.select("host", "html").filter("host is not null and host <> '' and html is not null").distinct()
    seen = texts.mapInArrow(_occurrences, OCCURRENCES)
    by_token = seen.groupBy("host", "token").agg(
        F.min("parent").alias("parent"),
        F.max("is_text").alias("is_text"),
        F.max("heading").alias("heading"),
        F.expr("bit_xor(vector)").alias("vector"),
        F.count("*").alias("pages"),
        F.sum("n").alias("n"),
        F.sum("chars").alias("chars"),
        F.sum("links").alias("links"),
        F.avg("place").alias("place"),
    )
    common = saved(by_token.filter(F.col("pages") >= p.least_pages))
    # the root, token 0, is on every page
    totals = common.filter("token = 0").select(F.col("host").alias("of"), F.col("pages").alias("of_pages"))
    return common.join(totals, F.expr("host = of")).filter(F.col("pages") >= F.lit(p.share) * F.col("of_pages")).drop("of")


def deduce(rows: pd.DataFrame, p: Template) -> tuple[list[int], list[int], int]:
    """A host's template from its common tokens: the order of its elements, its texts, its main container.

    Tokens of equal vectors form classes. A class is valid if its tokens lie once on each
    of its pages; it is nested into the template if its elements lie within elements
    of the template. 0 stands for no container.
    """
    rows = rows.sort_values(["place", "token"])
    classes: dict[tuple, list] = {}
    for r in rows.itertuples():
        classes.setdefault((r.vector, r.pages, r.n), []).append(r)
    valid = [c for (_, pages, n), c in classes.items() if n == pages]
    nested, texts, grown = {0}, [], True
    while grown:
        grown = False
        for members in valid:
            for r in members:
                if not r.is_text and r.token not in nested and r.parent in nested:
                    nested.add(r.token)
                    grown = True
    order = [r.token for r in rows.itertuples() if r.token in nested and not r.is_text and r.token]
    fixed_text: dict[int, float] = {}
    parents = {r.token: r.parent for r in rows.itertuples()}
    for r in rows.itertuples():
        if r.is_text:
            texts.append(r.token)
            at = r.parent
            while True:  # what the template holds is no slot's text
                fixed_text[at] = fixed_text.get(at, 0) + r.chars - r.links
                if at == 0 or at not in parents:
                    break
                at = parents[at]
    free = {r.token: r.chars - r.links - fixed_text.get(r.token, 0) for r in rows.itertuples() if not r.is_text}
    headings = [r.token for r in rows.itertuples() if r.heading and not r.is_text and free.get(r.token, 0) > 0]
    return order, texts, _container(order, parents, free, headings, p.inner)


def _container(order: list[int], parents: dict[int, int], free: dict[int, float], headings: list[int], inner: float) -> int:
    """From the root to the container that most free text is in; no heading is left behind."""

    def within(token: int, ancestor: int) -> bool:
        while token != ancestor:
            if token == 0 or token not in parents:
                return False
            token = parents[token]
        return True

    at = 0
    while free.get(at, 0) > 0:
        children = [t for t in order if parents[t] == at and free.get(t, 0) >= inner * free[at]]
        if not children:
            break
        best = max(children, key=lambda t: free[t])
        if any(within(h, at) and not within(h, best) for h in headings) or best in headings:
            break
        at = best
    return at


def _templates(p: Template):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        order, texts, container = deduce(rows, p)
        return pd.DataFrame(
            {"host": [rows["host"].iloc[0]], "elements": [order], "texts": [texts], "container": [container]}
        )

    return run


def templates(pages: DataFrame, p: Template = Template()) -> DataFrame:
    """(host, elements, texts, container): one row a host with a template. ``pages``: (host, html)."""
    form = "host string, elements array<long>, texts array<long>, container long"
    return saved(occurrences(pages, p).groupBy("host").applyInPandas(_templates(p), form))


def extract(page: str, elements: list[int] | None = None, texts: list[int] | None = None, container: int = 0, p: Template = Template()) -> str:
    """The main text of a page, one block a line; without a template by the page alone."""
    blocks, found = parse(page)
    invariant = set(texts or ())
    free = [b for b in blocks if _signed(text_token(b)) not in invariant] if invariant else blocks
    for name in CONTAINERS:
        marked = [b for b in free if b.element.main == name]
        if marked:
            return "\n".join(b.text for b in marked)
    if elements and container and _follows(found, elements):
        inside = [b for b in free if _within(b.element, container)]
    else:
        tokens = _tokens(blocks, found)
        parents = {t: row[0] for t, row in tokens.items()}
        once = [t for t, row in tokens.items() if not row[1] and row[3] == 1 and t]
        weight = {t: row[4] - row[5] for t, row in tokens.items() if not row[1]}
        headings = [t for t, row in tokens.items() if row[2] and not row[1]]
        own = _container(once, parents, weight, headings, p.inner)
        inside = [b for b in free if _within(b.element, _signed(own))]
    # lists of links are menus
    return "\n".join(b.text for b in inside if 2 * b.links <= len(b.text))


def _within(element: Element | None, token: int) -> bool:
    while element is not None:
        if _signed(element.token) == token:
            return True
        element = element.parent
    return False


def _follows(found: list[Element], elements: list[int]) -> bool:
    """Whether the elements of the template that the page has stand in its order."""
    place = {token: k for k, token in enumerate(elements)}
    met = [place[t] for t in (_signed(e.token) for e in found) if t in place]
    return bool(met) and met == sorted(set(met))


def _texts(p: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, elements, texts, container in zip(*(batch.column(c).to_pylist() for c in range(1, 5))):
                out.append(extract(page or "", elements, texts, container or 0, p))
            rows = [batch.column(0), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, names=["page_row", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, p: Template = Template()) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html).

    A page without main text, or with a null or empty html, has an empty text. A page
    without a host in its url, or of a host with few pages, is judged by its own elements.
    Character references are decoded, white space within a block becomes one blank, and
    blocks are joined by line ends in the order of the page. Repeated rows, also of one
    page_id, each have their result. Other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id"), F.col("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    found = templates(rows, p)
    found = found.select(F.col("host").alias("of"), "elements", "texts", "container")
    bytes_ = found.select(F.sum(8 * (F.size("elements") + F.size("texts")) + F.length("of") + 64)).first()[0] or 0
    if bytes_ <= p.broadcast_bytes:
        found = F.broadcast(found)
    both = rows.join(found, F.expr("host = of"), "left")
    whole = both.select(F.struct("page_id", "url").alias("page_row"), "html", "elements", "texts", "container")
    row = pages.schema
    form = f"page_row struct<page_id: {row['page_id'].dataType.simpleString()}, url: {row['url'].dataType.simpleString()}>, text string, n_chars long"
    return whole.mapInArrow(_texts(p), form).select("page_row.page_id", "page_row.url", "text", "n_chars")
