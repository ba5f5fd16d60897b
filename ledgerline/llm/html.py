"""Main text of web pages: site templates are subtrees that recur across a host's pages.

One pass hashes the element subtrees of every page; Spark counts around how many different texts of a
host each stands, so copies of a page are one; a second pass deletes the subtrees that recur, and those whose element says what they are (menus,
forms, adverts and the like), and writes the blocks of what is left. Passages and whole articles are
quoted and copied, also within one site, so text blocks inside an article are templates only if at
least half of the host's articles have them.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

# element names of the HTML standard, by their role here (fixed values)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes".split())
DROPPED = set("script style head title nav footer aside form noscript template iframe svg math object embed canvas audio video "
              "button select option textarea input label fieldset dialog menu map".split())
BLOCKS = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
             "h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dt dd td th li caption".split())
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "option": {"select"}}
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
# words in class and id that name a part that is no article text
PARTS = set("ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner nav navbar navigation menu "
            "breadcrumb breadcrumbs header masthead topbar footer sidebar aside rail widget cookie cookies consent gdpr notice notices "
            "alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
            "comment comments commentlist reply replies respond disqus discussion form pagination pager toolbar disclaimer".split())
# words that name the site itself; in an article they may be its subject
SITE = set("brand branding logo".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|$))""", re.I)
NAMES = re.compile(r"[a-z0-9]+")
DEEPEST = 512  # what is nested deeper counts as siblings, as in browsers


@dataclass
class Element:
    tag: str
    marks: str = ""
    role: str = ""
    hidden: bool = False
    parts: list[Element | str] = field(default_factory=list)


def parse(source: str) -> Element:
    """A lenient tree: unclosed elements end with their parent, a block ends an open paragraph, stray ends are ignored."""
    root = Element("html")
    stack = [root]
    at, n = 0, len(source)
    while at < n:
        m = TOKEN.search(source, at)
        if m is None:
            stack[-1].parts.append(html.unescape(source[at:]))
            break
        if m.start() > at:
            stack[-1].parts.append(html.unescape(source[at:m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in BLOCKS:
            _end(stack, {"p"}, {"table", "td", "th", "li", "button", "object"})
        if tag in ENDS_LIKE:
            _end(stack, ENDS_LIKE[tag], SCOPES[tag])
        element = Element(tag)
        if m[3] and not m[3].isspace():
            told = {a[1].lower(): (a[2] or "").strip("\"'").lower() for a in ATTRIBUTE.finditer(m[3])}
            element.marks = f"{told.get('class', '')} {told.get('id', '')}".strip()
            element.role, element.hidden = told.get("role", ""), "hidden" in told
        stack[-1].parts.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
        elif tag not in VOID and len(stack) < DEEPEST:
            stack.append(element)
    return root


def _end(stack: list[Element], tags: set[str], scope: set[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in scope:
            return


def is_part(element: Element, in_article: bool) -> bool:
    """The element's own name, role or class says that it is no article text."""
    if element.tag in DROPPED or element.hidden or element.role in ROLES:
        return True
    if element.tag in ("article", "main", "body", "html"):
        return bool({"comment", "comments", "reply", "related", "ad", "ads", "advert"} & set(NAMES.findall(element.marks)))
    if element.tag == "header":
        return not in_article  # an article's own header holds its title
    if not element.marks:
        return False
    names = set(NAMES.findall(element.marks))
    return not PARTS.isdisjoint(names) or not in_article and not SITE.isdisjoint(names)


def _digest(told: str) -> int:
    return int.from_bytes(hashlib.blake2b(told.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def hashes(root: Element) -> dict[int, int]:
    """Hash of each element's subtree by id(): name, class, id, text and children. Iterative, for any depth."""
    done: dict[int, int] = {}
    todo = [(root, False)]
    while todo:
        element, ready = todo.pop()
        if not ready:
            todo.append((element, True))
            todo += [(x, False) for x in element.parts if isinstance(x, Element)]
            continue
        text = "\0".join(" ".join(x.split()) if isinstance(x, str) else f"\1{done[id(x)]}" for x in element.parts)
        done[id(element)] = _digest(f"{element.tag}\2{element.marks}\2{text}")
    return done


CONTAINER, TEXT_BLOCK, ARTICLE_TEXT = range(3)  # kinds of subtrees that may be templates


def kind_of(element: Element, inside: bool) -> int | None:
    """None: no template, as it is no block, or an article or larger. Inline elements go with their block."""
    if element.tag in ("html", "body", "article", "main", "head") or not element.parts:
        return None
    if element.tag not in BLOCKS and "-" not in element.tag:
        return None
    return CONTAINER if element.tag not in PROSE else ARTICLE_TEXT if inside else TEXT_BLOCK


def _texts(element: Element) -> Iterator[int]:
    """Digests of the texts in ``element``."""
    todo: list[Element] = [element]
    while todo:
        for x in todo.pop().parts:
            if isinstance(x, Element):
                todo.append(x)
            elif x and not x.isspace():
                yield _digest(" ".join(x.split()))


def template_candidates(root: Element) -> dict[int | None, tuple[int, int]]:
    """Hashes of the page's subtrees that may belong to the site, each with its kind and a digest of the text around it.

    In an article or main element that is the least digest of its other texts, so that near copies of
    an article mostly agree; elsewhere the digest of the page's other texts. Named parts do not
    count. None: the digest of the whole page.
    """
    known = hashes(root)
    order: list[tuple[Element, Element, bool]] = []  # parents before their parts
    todo = [(root, root, False)]
    while todo:
        element, around, inside = todo.pop()
        order.append((element, around, inside))
        own = inside or element.tag in ("article", "main")
        todo += [(x, element if own and not inside else around, own) for x in reversed(element.parts)
                 if isinstance(x, Element) and not is_part(x, own)]  # named parts are deleted anyhow
    sums: dict[int, int] = {}  # of the digests of an element's texts
    article: dict[int, list[int]] = {}  # digests of the texts in an article
    for element, around, inside in reversed(order):
        own_texts = [_digest(" ".join(x.split())) for x in element.parts if isinstance(x, str) and x and not x.isspace()]
        sums[id(element)] = sum(own_texts) + sum(sums.get(id(x), 0) for x in element.parts if isinstance(x, Element))
        if inside:
            article.setdefault(id(around), []).extend(own_texts)
    for texts in article.values():
        texts.sort()
    found: dict[int | None, tuple[int, int]] = {None: (CONTAINER, _signed(sums[id(root)]))}
    for element, around, inside in order:
        kind = kind_of(element, inside)
        key = _key(known[id(element)], kind)
        if kind is None or key in found:
            continue
        if inside:
            mine = set(_texts(element))
            rest = next((t for t in article.get(id(around), ()) if t not in mine), 0)
        else:
            rest = _signed(sums[id(around)] - sums[id(element)])
        found[key] = kind, rest
    return found


def _key(known: int, kind: int | None) -> int:
    """Text blocks in articles are told from the same elsewhere."""
    return known ^ 1 if kind == ARTICLE_TEXT else known


def _signed(number: int) -> int:
    return (number + (1 << 63)) % (1 << 64) - (1 << 63)


def main_text(source: str, templates: frozenset[int]) -> str:
    """Blocks of the page's main element and articles, or of its body if no main has text, without templates and named parts.

    Articles alone do not narrow the body: an embedded post or a teaser is an article as well.
    """
    root = parse(source)
    known = hashes(root) if templates else {}
    blocks: list[list[str]] = [[]]
    articles: list[tuple[int, int]] = []  # block ranges
    mains: list[tuple[int, int]] = []

    def new() -> None:
        if blocks[-1]:
            blocks.append([])

    todo: list[tuple[Element | str | None, Element | None, int, bool]] = [(root, None, 0, False)]
    while todo:
        item, ended, since, inside = todo.pop()
        if ended is not None:  # an element's end
            if ended.tag in BLOCKS:
                new()
            if ended.tag == "article":
                articles.append((since, len(blocks) - 1))
            elif ended.tag == "main" or ended.role == "main":
                mains.append((since, len(blocks) - 1))
            continue
        if isinstance(item, str):
            blocks[-1].append(item)
            continue
        if item.tag == "br":
            blocks[-1].append(" ")
        elif not is_part(item, inside) and not (known and (kind := kind_of(item, inside)) is not None and _key(known[id(item)], kind) in templates):
            if item.tag in BLOCKS:
                new()
            own = inside or item.tag in ("article", "main") or item.role == "main"
            todo.append((None, item, len(blocks) - 1, inside))
            todo += [(x, None, 0, own) for x in reversed(item.parts)]
    lines = [" ".join("".join(b).split()) for b in blocks]
    if any(lines[a] for s, e in mains for a in range(s, e)):
        lines = [lines[k] for k in sorted({k for s, e in mains + articles for k in range(s, e)})]
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, min_pages: int = 5, min_share: float = 0.3, many_pages: int = 50, article_share: float = 0.5) -> DataFrame:
    """page_id, url, text, n_chars of every page of ``pages`` (page_id, url, html).

    A subtree is a template of a host if it stands among at least ``min_pages`` different texts, and
    among ``min_share`` as many as the host has pages of different text: pages that are copies of one
    another count once. ``many_pages`` different texts are enough for a container (div, section,
    list, table ...), however large the host. Text blocks (p, h1, li ...) need the share, as lines are
    quoted, and those in articles ``article_share``. Null html: empty text. Null or odd url: the page counts to the host "".
    Repeated rows are all returned; other columns are not read. Any
    markup gives some text. The list of templates has at most (subtrees of a page / min_share) rows
    a host, and on hosts with more than many_pages / min_share pages (containers of all pages /
    many_pages); Spark broadcasts it if its size on disk allows and else joins it by host, where it may
    split a large host.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = rows.withColumn("host", host)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a null hash counts the pages
            told = {(name, h, kind, rest) for name, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    for h, (kind, rest) in template_candidates(parse(source.as_py() or "")).items()}
            kinds = pa.string(), pa.int64(), pa.int32(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in told], kind) for i, kind in enumerate(kinds)],
                                             names=["host", "hash", "kind", "rest"])

    counted = staged(rows.select("host", "html").mapInArrow(candidates, "host string, hash long, kind int, rest long").distinct()
                     .groupBy("host", "hash", "kind").agg(F.count(F.lit(1)).alias("pages"))
                     .filter(F.col("hash").isNull() | (F.col("pages") >= min_pages)), "subtrees")
    totals = counted.filter("hash is null").select("host", F.col("pages").alias("total"))
    share = F.when(F.col("kind") == ARTICLE_TEXT, F.lit(article_share)).otherwise(F.lit(min_share))
    recurs = (F.col("pages") >= share * F.col("total")) | ((F.col("kind") == CONTAINER) & (F.col("pages") >= many_pages))
    templates = staged(counted.filter("hash is not null").join(totals, "host").filter(recurs)
                       .groupBy("host").agg(F.collect_list("hash").alias("hashes")), "templates")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset[int]] = {}
        for batch in batches:
            out = []
            for name, source, listed in zip(*(batch.column(c) for c in ("host", "html", "hashes")), strict=True):
                key = name.as_py()
                if key not in known:
                    if len(known) >= 10_000:
                        known.clear()
                    known[key] = frozenset(listed.as_py() or ())
                out.append(main_text(source.as_py() or "", known[key]))
            text = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text, pa.array(map(len, out), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.join(templates, "host", "left").mapInArrow(texts, "page_id long, url string, text string, n_chars long")
