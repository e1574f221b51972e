"""Main text of web pages by consensus of each host's pages.

First pass: score each page's containers and name the best one by its generalised tag-class path.
Spark sums the votes for each host and path. Second pass: extract each page again from the
container at its host's winning path, or from its own best one where it has none there.

A page is read once into a list of elements and a list of text runs; what lies outside, what a
container holds and its score follow from passes over these lists, so time and memory are linear
in the page, however deep it is nested.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, materialise, small_batches, text_of

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^<>]*)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([A-Za-z_:-]+)")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text for a program, up to their end tag.
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
BLOCK = frozenset(
    "html body address article aside blockquote br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CONTAINER = frozenset("body article main section div td center form".split())
#: Elements that are never main text. A form is one only as a name is: not where it holds the page.
DROP = RAW | frozenset("head nav header footer aside button select input menu dialog object embed canvas audio video svg template".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
#: Words in a class or id that name parts outside the main text.
OUTSIDE = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar aside rail widget widgets notice notices alert banner cookie cookies consent gdpr ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations newsletter subscribe subscription signup login popup modal overlay form search pagination pager skip toolbar"
    .split()
)
#: In such names the word says that the page has a part, not that the element is one.
ABOUT = frozenset("has with no without is".split())
#: A name with such a word is of what lies around or beside the part, or of the page's own content.
LAYOUT = frozenset("layout wrap wrapper wrapped container page content main body grid row results with".split())
#: Names that are outside as a whole, but not as a word of a compound.
ALONE = frozenset("bottom side hidden".split())
#: Words that name a part at a name's end (login-form), but at its head only what is in one (form-text).
TAIL = frozenset("form overlay skip".split())
#: Words that only say what kind of part it is behind a word of OUTSIDE (comment-list, share-buttons, footer-left).
GENERIC = frozenset(
    "list item items box bar area block section panel module region zone slot unit holder left right top bottom inner outer middle link links button buttons icon icons post posts article articles story stories title heading label count counter meta author avatar thread message messages text col column columns group strip feed info bg toggle close open icon image images logo small large sticky fixed primary secondary"
    .split()
)
#: Reader comments: outside whatever they hold, on sections too.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Words whose parts may hold the whole page all the same, where a layout is named oddly.
ROOMY = frozenset("sidebar aside rail widget widgets header masthead topbar toolbar form overlay modal popup search banner notice notices alert".split())
#: Elements whose classes and ids name parts; of others a whole class that is a word of OUTSIDE does, and for headings a class.
NAMED = frozenset("div ul ol dl table tbody tr td th fieldset figure center details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("input select textarea button".split())
#: Characters of a block outside named parts that is article enough.
ARTICLE_CHARS = 80
#: Levels of a name: it needs links or forms to prevail (a heading's words may be its id), or it is enough.
MAYBE, SURELY = 1, 2
#: An element that closes others of its kind when it begins.
CLOSES = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dd": {"dl"}, "dt": {"dl"}, "option": {"select"}}
PARAGRAPH, AROUND = {"p"}, CONTAINER | {"table", "ul", "ol", "dl", "blockquote"}
#: Of the page's unlinked text, what a container holds at least to be taken where no article is.
SHARE = 0.8
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
DIGITS = re.compile(r"[0-9]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Hosts whose winners are broadcast: two integers each.
MOST_HOSTS = 1_000_000
#: A vote is counted in thousandths, as an integer: sums don't depend on their order.
UNIT = 1000


def _outside(tag: str, attributes: dict[str, str]) -> bool:
    if tag in DROP:
        return True
    if not attributes:
        return False
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES or UNSEEN.search(attributes.get("style", "")) is not None


@lru_cache(maxsize=1 << 16)
def _level(name: str) -> int:
    """Whether a class or id names a part outside: by a word of OUTSIDE at its end, or at its head before words of GENERIC; before others maybe."""
    words = [w.lower() for w in WORD.findall(name)]
    if not words or len(name) >= 200 or words[0] in ABOUT:
        return 0
    if name.lower() in ALONE or name.lower() in OUTSIDE:
        return SURELY
    if not LAYOUT.isdisjoint(words):
        return 0
    if words[-1] in OUTSIDE:
        return SURELY
    if words[0] not in OUTSIDE - TAIL:
        return 0
    return SURELY if all(w in GENERIC or w in OUTSIDE or w.isdigit() for w in words[1:]) else MAYBE


def _named_outside(tag: str, attributes: dict[str, str]) -> int:
    """The level at which an element's class or id names a part outside.

    A section's id is its heading's words as a rule, as in documents made from markup, so it needs
    links or forms to prevail, unless it is of comments; so does that of a div of class section.
    Ids of headings, paragraphs and inline elements name nothing.
    """
    if tag == "form":
        return SURELY
    if not attributes:
        return 0
    classes, own = attributes.get("class", "").split(), attributes.get("id", "")
    if tag == "section" or tag == "div" and "section" in classes:
        by_id = SURELY if own.lower() in COMMENTS else min(_level(own), MAYBE)
        return max([by_id, *(_level(c) for c in classes if c != "section")])
    if tag in NAMED:
        return max([_level(own), *map(_level, classes)])
    if tag in HEADINGS:
        return SURELY if any(_level(c) == SURELY for c in classes) else 0
    return SURELY if tag in ("p", "li") and any(c.lower() in OUTSIDE for c in classes) else 0


def _roomy(attributes: dict[str, str]) -> bool:
    """Whether the words of OUTSIDE in an element's names leave room for a page's text."""
    words = {w.lower() for name in (*attributes.get("class", "").split(), attributes.get("id", "")) for w in WORD.findall(name)}
    return words & OUTSIDE <= ROOMY


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A path step: the tag, its classes and its id, digits generalised."""
    names = sorted({DIGITS.sub("0", c) for c in attributes.get("class", "").split()})
    own = DIGITS.sub("0", attributes.get("id", "").strip())
    return ".".join([tag, *names]) + ("#" + own if own else "")


class Page:
    """A page's elements by start tag, each after its parent, and its text runs in order.

    Element 0 is the page itself. A run is (element, text, whether it is linked); None ends a block.
    """

    def __init__(self, html: str):
        self.tags, self.parents, self.steps = [""], [-1], [""]
        self.hard, self.named, self.roomy, self.controls = [False], [0], [True], [0]
        self.runs: list[tuple[int, str, bool] | None] = []
        self._read(html)

    def _read(self, html: str) -> None:
        tags, parents, steps, hard, named, roomy, controls, runs = self.tags, self.parents, self.steps, self.hard, self.named, self.roomy, self.controls, self.runs
        stack, open_ = [0], Counter()
        links = at = 0
        size = len(html)

        def pop() -> None:
            open_[tags[stack.pop()]] -= 1

        while at <= size:
            match = TOKEN.search(html, at)
            text = html[at : match.start() if match else size]
            if text:
                # references are decoded within a run: a tag inside one ends it
                runs.append((stack[-1], unescape(text), links > 0))
            if not match:
                break
            at = match.end()
            # the second form has a quote that isn't closed
            tag = (match[2] or match[5] or "").lower()
            if not tag:
                if match[0].startswith("<![CDATA["):
                    runs.append((stack[-1], match[0][9:].removesuffix("]]>"), links > 0))
                continue
            block = tag in BLOCK
            if match[1] or match[4]:
                if tag == "a":
                    links = max(0, links - 1)
                if block:
                    runs.append(None)
                while open_[tag]:
                    last = tags[stack[-1]]
                    if last != tag and last in BLOCK and not block:
                        break  # a stray inline end tag doesn't close blocks
                    pop()
                    if last == tag:
                        break
                continue
            inner = match[3] or match[6]
            attributes = {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(inner)} if inner else {}
            if block:
                runs.append(None)
                ends = CLOSES.get(tag, PARAGRAPH if tag != "br" else ())
                if any(open_[e] for e in ends):
                    stops = STOPS.get(tag, AROUND)
                    for i in range(len(stack) - 1, 0, -1):
                        if tags[stack[i]] in ends:
                            while len(stack) > i:
                                pop()
                            break
                        if tags[stack[i]] in stops:
                            break
            controls[stack[-1]] += tag in CONTROLS
            if tag in VOID:
                continue
            # a tag that closes itself holds nothing; for HTML's own blocks and raw texts the slash means nothing
            if match[0].endswith("/>") and not block and tag not in RAW:
                continue
            if tag in RAW:
                # up to the end tag, whatever it holds
                end = _end_of(tag).search(html, at)
                at = end.end() if end else size
                continue
            links += tag == "a"
            stack.append(len(tags))
            open_[tag] += 1
            tags.append(tag)
            parents.append(stack[-2])
            steps.append(_step(tag, attributes) if block else "")
            hard.append(_outside(tag, attributes))
            named.append(_named_outside(tag, attributes))
            roomy.append(_roomy(attributes))
            controls.append(0)
        runs.append(None)

    def _parts(self) -> list[bool]:
        """Whether each element's name puts it outside: surely, or where its links or form controls prevail."""
        n, parents = len(self.tags), self.parents
        if MAYBE not in self.named:
            return [level == SURELY for level in self.named]
        plain, linked, controls = [0] * n, [0] * n, list(self.controls)
        for run in self.runs:
            if run:
                (linked if run[2] else plain)[run[0]] += len(run[1].strip())
        for i in range(n - 1, 0, -1):
            for counts in (plain, linked, controls):
                counts[parents[i]] += counts[i]
        return [level == SURELY or level == MAYBE and (linked[i] > plain[i] or 200 * controls[i] > plain[i]) for i, level in enumerate(self.named)]

    def _shown(self) -> list[bool]:
        """Whether each element is main text, as far as tags and names say.

        A name puts no element outside that holds the page's article or main. On a page without
        these, and without a block of text outside named parts, the parts that hold most of the
        text stay, but for those that never are main text, such as comments, footers and menus.
        """
        n, tags, parents = len(self.tags), self.tags, self.parents
        own = self._parts()
        gone, part = [False] * n, [False] * n
        for i in range(1, n):
            gone[i] = gone[parents[i]] or self.hard[i]
            part[i] = part[parents[i]] or own[i]
        articles = [i for i in range(1, n) if tags[i] in ("article", "main") and not gone[i]]
        exempt: set[int] = set()
        if any(part) and not any(not part[i] for i in articles):
            held, longest, chars = [0] * n, 0, 0
            for run in self.runs:
                if run is None:
                    longest, chars = max(longest, chars), 0
                elif not run[2] and not gone[run[0]]:
                    held[run[0]] += len(run[1].strip())
                    chars += 0 if part[run[0]] else len(run[1].strip())
            for i in range(n - 1, 0, -1):
                held[parents[i]] += held[i]
            inside = [i for i in articles if not self._never(i, own)]
            if inside:
                i = inside[0]
                while i > 0:
                    exempt.add(i)
                    i = parents[i]
            elif longest < ARTICLE_CHARS:
                exempt = {i for i in range(1, n) if 2 * held[i] > held[0] and self.roomy[i]}
        shown = [True] * n
        for i in range(1, n):
            shown[i] = shown[parents[i]] and not self.hard[i] and (not own[i] or i in exempt)
        return shown

    def _never(self, element: int, own: list[bool]) -> bool:
        """Whether an element lies in a part that is never main text."""
        while element > 0:
            if own[element] and not self.roomy[element]:
                return True
            element = self.parents[element]
        return False

    def _blocks(self, shown: list[bool]) -> tuple[list[int], list[str], list[int]]:
        """The blocks of main text: holder (a container, or 0), text and linked characters."""
        holder = [0] * len(self.tags)
        for i in range(1, len(self.tags)):
            holder[i] = i if self.tags[i] in CONTAINER else holder[self.parents[i]]
        holders, texts, linked = [], [], []
        buffer, links, first = [], 0, 0
        for run in self.runs:
            if run is None:
                if buffer and (text := " ".join("".join(buffer).split())):
                    holders.append(holder[first])
                    texts.append(text)
                    linked.append(min(links, len(text)))
                buffer, links = [], 0
            elif shown[run[0]]:
                if not buffer:
                    first = run[0]
                buffer.append(run[1])
                links += len(run[1]) if run[2] else 0
        return holders, texts, linked

    def path(self, element: int) -> str:
        steps = []
        while element > 0:
            if self.steps[element]:
                steps.append(self.steps[element])
            element = self.parents[element]
        return "".join(f"/{s}" for s in reversed(steps))


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?:[\s/][^>]*)?>", re.IGNORECASE)


@dataclass(slots=True)
class Node:
    """A container: its element, its blocks of the page (from, to) and the text credited to it."""

    page: Page
    texts: list[str]
    element: int
    order: int
    begin: int
    end: int
    chars: int
    linked: int
    stops: int

    @property
    def tag(self) -> str:
        return self.page.tags[self.element]

    @property
    def path(self) -> str:
        return self.page.path(self.element)


def containers(html: str) -> list[Node]:
    """The page's containers in page order, each with the blocks of main text in it.

    An article, or else main, has the credit for all within it; elsewhere all containers around a
    text have it. A page without containers is one itself.
    """
    page = Page(html)
    shown = page._shown()
    holders, texts, linked = page._blocks(shown)
    n, tags, parents = len(page.tags), page.tags, page.parents
    article, main = [False] * n, [False] * n
    for i in range(1, n):
        article[i] = article[parents[i]] or tags[i] == "article"
        main[i] = main[parents[i]] or tags[i] == "main"
    # blocks of a container lie side by side
    begin, end = [len(texts)] * n, [0] * n
    for b, h in enumerate(holders):
        begin[h] = min(begin[h], b)
        end[h] = b + 1
    for i in range(n - 1, 0, -1):
        p = parents[i]
        begin[p], end[p] = min(begin[p], begin[i]), max(end[p], end[i])
    values = [(len(t), k, t.count(".") + t.count("!") + t.count("?") + t.count(",")) for t, k in zip(texts, linked, strict=True)]

    def sums(counts: list[bool]) -> list[list[int]]:
        return [list(accumulate((v[k] if c else 0 for v, c in zip(values, counts, strict=True)), initial=0)) for k in range(3)]

    whole = sums([True] * len(texts))
    no_article = sums([not article[h] for h in holders])
    neither = sums([not article[h] and not main[h] for h in holders])
    found: list[Node] = []
    for i in range(1, n):
        if tags[i] not in CONTAINER or not shown[i]:
            continue
        p = parents[i]
        if tags[i] == "article":
            have = None if article[p] else whole
        elif tags[i] == "main":
            have = None if article[p] or main[p] else no_article
        else:
            have = None if article[i] or main[i] else neither
        low, high = begin[i], max(begin[i], end[i])
        credit = [s[high] - s[low] for s in have] if have else [0, 0, 0]
        found.append(Node(page, texts, i, len(found) + 1, low, high, *credit))
    return found or [Node(page, texts, 0, 0, 0, len(texts), *(s[-1] for s in whole))]


def best(nodes: list[Node]) -> Node:
    """The article or main with the highest score, or the lowest other container that holds most text.

    That is SHARE of the unlinked text outside articles and main; the higher score of the two wins.
    """
    plain = [n for n in nodes if n.tag not in ("article", "main")]
    most = max((n.chars - n.linked for n in plain), default=0)
    held = [n for n in plain if most and n.chars - n.linked >= SHARE * most]
    # over half of the text is in each of them, so each holds the next
    pool = [n for n in nodes if n.tag in ("article", "main")] + (held[-1:] or plain)
    return max(pool, key=lambda n: (weight(n), -n.order))


def weight(node: Node) -> float:
    lift = 3.0 if node.tag in ("article", "main") else 1.0
    plain = max(0.0, node.chars - 2 * node.linked)
    return lift * (plain + 10 * min(node.stops, plain / 20)) + (0.001 if node.tag in ("article", "main") else 0)


def path_key(path: str) -> int:
    """64 bits for a path: its CRC-32, which grows step by step, above half of its xxHash."""
    return (zlib.crc32(path.encode("utf-8", "surrogatepass")) << 32 | xxhash.xxh32_intdigest(path.encode("utf-8", "surrogatepass"))) - (1 << 63)


def text_at(nodes: list[Node], path: str | int | None) -> str:
    """The text of the containers at ``path`` (or its key), else of the page's own best one."""
    chosen: list[Node] = []
    if path:
        key = path_key(path) if isinstance(path, str) else path
        page, want = nodes[0].page, (key + (1 << 63)) >> 32
        crc = [0] * len(page.tags)
        for i in range(1, len(page.tags)):
            crc[i] = zlib.crc32(f"/{page.steps[i]}".encode("utf-8", "surrogatepass"), crc[page.parents[i]]) if page.steps[i] else crc[page.parents[i]]
        chosen = [n for n in nodes if crc[n.element] == want and n.begin < n.end and path_key(n.path) == key]
    # of containers in one another the outer has all blocks
    parts, done = [], 0
    for node in chosen or [best(nodes)]:
        parts += node.texts[max(done, node.begin) : node.end]
        done = max(done, node.end)
    return " ".join(parts)


def host_of(column: str = "url"):
    """The url's host in lower case without port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(column), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def vote(html: str) -> tuple[int, int]:
    """A page's vote: the key of its best container's path, and its weight, more the more text there is."""
    top = best(containers(html))
    path = top.path
    return (path_key(path), round(UNIT * math.log1p(weight(top)))) if path else (0, 0)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text for every row of ``pages`` (page_id, url, html).

    The text leaves out header and footer elements wherever they are, in articles too, and headings
    of a main element before its article; of several articles on a page it is the best one, with
    those at the same path. Null html is
    empty and has no text; pages with a null or odd url vote together as one host; ties between
    paths go to the larger key; repeated rows give repeated rows; an empty table gives an empty
    result; further columns are ignored. A page is the unit, in time and memory linear in its length.
    """
    rows = pages.select("page_id", "url", text_of("html").alias("html"), F.xxhash64(host_of()).alias("host"))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            cast = [vote(h) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for k, _ in cast], pa.int64()), pa.array([v for _, v in cast], pa.int64())], names=["host", "path", "votes"])

    summed = rows.select("host", "html").mapInArrow(votes, "host bigint, path bigint, votes bigint").where("votes > 0").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    winners = materialise(summed.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("path")), "paths")
    small = checked_broadcast(winners, MOST_HOSTS)
    if small is winners:
        # too many hosts for a broadcast: deal each host's pages over several keys
        salts = 32
        spread = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(spread, ["host", "salt"], "left")
    else:
        joined = rows.join(small, "host", "left")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [text_at(containers(h), p) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "path").mapInArrow(again, f"page_id {kind}, url string, text string")
