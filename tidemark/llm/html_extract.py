"""Main text of web pages by consensus container paths of their hosts.

Pages of one host come from few templates. Each page's containers are scored by the text of their paragraphs, less what
is in links; the best one, with what its ancestors add to it, casts a vote for its path, the tag and class names from the
body down with digits generalised. Votes are summed per host and path in Spark, and every page of the host is extracted
again along the winning path. A page without that path falls back on its own best container, which may be its body.

Some elements are never text: scripts, controls, nav, footer, aside. Others only look like noise, by a class name, a role
or as a form, and templates put such names on wrappers of the whole page, too. These don't count for the containers around them,
and containers inside count little, but they can win; only what looks like noise inside the winning container is left out.
Parsing takes time and memory in proportion to the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch

#: A tag's quotes are followed for 50 attributes; one with more, or with a quote that never ends, stops at its first `>`.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*'){0,100}+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)([^>]*)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])([A-Za-z_:][^\s"'>/=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: A character reference beyond any code point, whose digits Python won't read.
HUGE_REFERENCE = re.compile(r"&#(?:[0-9]{9,}|[xX][0-9A-Fa-f]{9,})")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article main section div td body".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: End tags of inline elements don't reach beyond these.
BARRIERS = frozenset("article main section td table body".split())
IN_HEAD = frozenset("head base link meta title noscript style script template".split())
#: Elements that are never main text, wherever they stand.
NOISE = frozenset("nav footer aside button select option label legend menu dialog svg head object audio video canvas".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: Parts of class names and ids that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner header sidebar menu nav navbar navigation navigationbar breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended comment comments commentlist respond reply replies disqus masthead topbar toolbar pagination pager skip hidden".split()
)
#: Those that also hold for article, main and the paragraphs inside them.
STRONG_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored comment comments commentlist respond reply replies".split())
#: Parts of a name that tell a state or layout, or what a header belongs to.
STATES = frozenset("no not has with without open closed opened enabled disabled active inactive allowed layout".split())
OF_ARTICLE = frozenset("entry post article content story title".split())
#: A start tag that ends the open elements of the second set, up to the nearest one of the third.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
}
NAMES = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
#: What a container counts for every element that looks like noise around it, and what a parent gets of its children.
SUSPECT, FADE = 0.03, 0.9
#: Characters from which on text that stands only in what is named like noise is taken for the article; a notice has fewer.
ALONE = 500


class Element:
    __slots__ = ("tag", "names", "up", "digest", "hard", "link", "main", "region")

    def __init__(self, tag: str, names: str, up: Element | None):
        self.tag, self.names, self.up, self.digest = tag, names, up, b""
        self.hard, self.link, self.main, self.region = (up.hard, up.link, up.main, up.region) if up else (False, False, False, 0)

    def step(self) -> str:
        return ".".join([self.tag, *sorted(re.sub(r"\d+", "#", x) for x in self.names.split())])


@dataclass
class Region:
    """A container, or a block element that looks like noise; what stands in it directly."""

    element: Element
    parent: int
    container: bool
    suspect: bool
    named: bool  # this or a region around it is suspect for more than being a form
    score: float = 0.0


@dataclass
class Page:
    regions: list[Region] = field(default_factory=list)  # the first is the body
    blocks: list[tuple[int, str]] = field(default_factory=list)  # region and text


def _digest(above: bytes, step: str) -> bytes:
    return blake2b(above + step.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def digest_of(element: Element) -> bytes:
    """Stands for the path; computed once for each element."""
    open_ = []
    while not element.digest and element.up is not None:
        open_.append(element)
        element = element.up
    for e in reversed(open_):
        e.digest = _digest(e.up.digest, e.step()) if e.tag in BLOCKS else e.up.digest
    return open_[0].digest if open_ else element.digest


def path_of(element: Element) -> str:
    steps = []
    while element.up is not None:
        if element.tag in BLOCKS:
            steps.append(element.step())
        element = element.up
    return " ".join(reversed(steps))


def digest_of_path(path: str) -> bytes:
    digest = b""
    for step in path.split(" ") if path else ():
        digest = _digest(digest, step)
    return digest


def _looks_like_noise(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    role = attributes.get("role", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if role in NOISE_ROLES and tag not in ("main", "article"):
        return True
    weak = in_main and tag not in CONTAINERS and tag in BLOCKS or tag in ("main", "article")
    wanted = STRONG_NAMES if weak else NOISE_NAMES
    for name in (*attributes.get("class", "").split(), *attributes.get("id", "").split()):
        parts = {x.lower() for x in NAMES.split(name)}
        found = parts & wanted
        if found and not parts & STATES and not (found == {"header"} and (in_main or parts & OF_ARTICLE)):
            return True
    return tag == "form" or tag == "header" and not in_main and not any({x.lower() for x in NAMES.split(n)} & OF_ARTICLE for n in attributes.get("class", "").split())


def _decoded(text: str) -> str:
    return html.unescape(HUGE_REFERENCE.sub("&#xFFFD", text)) if "&" in text else text


class _Parser:
    def __init__(self) -> None:
        body = Element("body", "", None)
        self.page = Page([Region(body, -1, True, False, False)])
        self.stack = [body]
        self.depths: dict[str, list[int]] = defaultdict(list)  # of open elements by tag
        self.blocks: list[int] = []
        self.barriers: list[int] = []
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        words = " ".join("".join(self.text).split())
        self.text.clear()
        if words:
            region = self.stack[-1].region
            self.page.blocks.append((region, words))
            self.page.regions[region].score += max(0, len(words) - 2 * self.linked)
        self.linked = 0

    def push(self, element: Element) -> None:
        depth, tag = len(self.stack), element.tag
        self.stack.append(element)
        self.depths[tag].append(depth)
        if tag in BLOCKS:
            self.blocks.append(depth)
        if tag in BARRIERS:
            self.barriers.append(depth)

    def close(self, depth: int) -> None:
        if self.blocks and self.blocks[-1] >= depth:
            self.flush()
        while len(self.stack) > depth:
            self.depths[self.stack.pop().tag].pop()
        for depths in (self.blocks, self.barriers):
            while depths and depths[-1] >= depth:
                depths.pop()

    def characters(self, text: str) -> None:
        top = self.stack[-1]
        if not top.hard:
            self.text.append(_decoded(text))
            if top.link:
                self.linked += len(text.strip())

    def end(self, tag: str) -> None:
        at = self.depths.get(tag)
        if at and (tag in BLOCKS or not self.barriers or self.barriers[-1] < at[-1]):
            self.close(at[-1])

    def start(self, tag: str, raw: str) -> None:
        if self.depths["head"] and tag not in IN_HEAD:
            self.close(self.depths["head"][-1])
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.text.append(" " if not self.stack[-1].hard else "")
        if tag in BLOCKS:
            if self.blocks and self.stack[self.blocks[-1]].tag == "p":
                self.close(self.blocks[-1])
            ends, within = IMPLIED.get(tag, ((), ()))
            limit = max((self.depths[t][-1] for t in within if self.depths[t]), default=0)
            ended = [self.depths[t][-1] for t in ends if self.depths[t] and self.depths[t][-1] > limit]
            if ended:
                self.close(min(ended))
            self.flush()
        if tag in VOID or raw.endswith("/") and tag not in BLOCKS:
            return
        up = self.stack[-1]
        if up.hard:
            element = Element(tag, "", up)
        else:
            attributes = {name.lower(): a or b or c for name, a, b, c in ATTRIBUTE.findall(raw)} if raw and not raw.isspace() else {}
            element = Element(tag, attributes.get("class", ""), up)
            element.main = up.main or tag in ("article", "main") or attributes.get("role") == "main"
            element.link = up.link or tag == "a"
            suspect = _looks_like_noise(tag, attributes, up.main)
            element.hard = tag in NOISE or suspect and tag not in BLOCKS and "-" not in tag
            if not element.hard and tag in BLOCKS and (tag in CONTAINERS or suspect):
                element.region = len(self.page.regions)
                named = self.page.regions[up.region].named or suspect and (tag != "form" or _looks_like_noise("div", attributes, up.main))
                self.page.regions.append(Region(element, up.region, tag in CONTAINERS, suspect, named))
        self.push(element)


def parse(source: str) -> Page:
    """Regions and blocks of text of a page, in page order. Never fails, however broken the page."""
    parser, at = _Parser(), 0
    for m in TOKEN.finditer(source):
        if at < m.start():
            parser.characters(source[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        if m[2] or m[5]:
            parser.end(tag.lower())
        else:
            parser.start(tag.lower(), m[4] or m[7] or "")
    if at < len(source):
        parser.characters(source[at:])
    parser.flush()
    return parser.page


def best(page: Page) -> int | None:
    """The container of most text, or the ancestor that adds text to it which isn't mostly links, up to an article or main.

    For the most, parents get what their children have, less a tenth a level; article and main count double, and what is
    in elements that look like noise little. The body is such an ancestor only if text stands in it directly, not for other
    containers beside the best one. None if the best one is named like noise, or inside such, and has fewer than ALONE characters.
    """
    regions = page.regions
    total, score, length, weight = [r.score for r in regions], [r.score for r in regions], [0] * len(regions), [1.0] * len(regions)
    for k, words in page.blocks:
        length[k] += len(words)
    for k in range(len(regions) - 1, 0, -1):
        if not regions[k].suspect:
            up = regions[k].parent
            total[up] += FADE * total[k]
            score[up] += score[k]
            length[up] += length[k]
    for k in range(1, len(regions)):
        weight[k] = weight[regions[k].parent] * (SUSPECT if regions[k].suspect else 1)
    value = [t * w * (2 if r.element.tag in ("article", "main") else 1) if r.container else -1.0 for t, w, r in zip(total, weight, regions, strict=True)]
    top = at = max(range(len(value)), key=lambda k: (value[k], -k))
    if regions[top].named and length[top] < ALONE:
        return None
    while at and not regions[at].suspect and regions[top].element.tag not in ("article", "main"):
        at = regions[at].parent
        added = length[at] - length[top]
        if added and (2 * (score[at] - score[top]) < added or at == 0 and not regions[0].score):
            break
        if added and regions[at].container:
            top = at
    return top


def text_of(page: Page, path: str | None) -> str:
    """The blocks inside containers of a path, without what looks like noise inside, joined by line ends; without such containers, those of the best one."""
    wanted: set[int | None] = set()
    if path is not None:
        digest = digest_of_path(path)
        wanted = {k for k, r in enumerate(page.regions) if r.container and digest_of(r.element) == digest}
    return _inside(page, wanted or {best(page)})


def _inside(page: Page, wanted: set[int | None]) -> str:
    inside = [False] * len(page.regions)
    for k, r in enumerate(page.regions):
        inside[k] = k in wanted or k > 0 and inside[r.parent] and not r.suspect
    return "\n".join(t for k, t in page.blocks if inside[k])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: Counter[tuple[str | None, str]] = Counter()
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if source:
                page = parse(source)
                if page.blocks and (top := best(page)) is not None:
                    votes[host, path_of(page.regions[top].element)] += 1
        if votes:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(list(votes.values()), pa.int64())], names=["host", "path", "votes"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [c for c in batch.schema.names if c not in ("html", "path")]
        out = [text_of(parse(source), path) if source else "" for source, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), batch.column("path"), pa.array(out, pa.string())], names=[*keep, "path", "text"])


def host_of(url) -> object:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, path (the host's winning path, null if none) and text of every page.

    A null, empty or textless page gives an empty text. Pages whose url is null or has no host vote together. Votes tie
    to the smaller path. Other columns of pages take no part.
    """
    scratch = Scratch(spark, "html")
    pages = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    winners = scratch.keep(votes.groupBy("host").agg(F.max_by("path", F.struct("votes", F.expr("-length(path)"), "path")).alias("path")))
    joined = pages.join(winners, "host", "left").select("page_id", "url", "html", "path")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields if f.name not in ("html", "path"))
    return joined.mapInArrow(_texts, f"{schema}, path string, text string")
