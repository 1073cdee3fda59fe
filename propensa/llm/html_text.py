"""Main text of web pages, without what a site repeats (op 5).

Pages are parsed into elements with their places in the source.  Each element
that could belong to a site's template is hashed with all below it, from the
innermost out, inline ones that make up a line as well.  Spark counts, per host, beside how many different
contents each hash occurs.  Subtrees that recur beside ``PAGES`` contents of
their host are deleted, however many pages it has, and so are those that name
themselves as menus, footers, adverts and the like, which is all that pages of
small hosts have to go by.  What is left of the article gives the blocks of
text.

What a page has beside a subtree is known by its longest block outside of it,
and by the next one if that is half as long as both.  So copies of a page, which differ
in a date or an advert at most, count once, and their paragraphs are no
template.  A subtree with more text than the rest of its page is its content
and does not count there.

Paragraphs, headings and list items inside an article are never template: a
sentence that many articles of a host share stays.

Cases: a null or empty page has an empty text; a page whose url is null or
has no host is in no host's counts; repeated pages count once; an element
that is not closed ends with its parent; other columns are ignored; an empty
table gives none.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import field_type
from propensa.session import written

#: A subtree is template from so many different contents of a host's pages.
PAGES = 5

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp "
                   "small span strike strong sub sup time tt u var".split())
#: What a start tag closes, if it is open below the nearest of the others.
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})} | {b: ({"p"}, BLOCKS - {"p"} | {"td", "th", "li", "dd"}) for b in BLOCKS}
#: Elements whose content is no text of an article.
NEVER = frozenset("head script style title noscript iframe textarea template svg math object nav footer aside form "
                  "button select menu dialog audio video canvas".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
SCOPE = frozenset("article main body html".split())
NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent\w*|notices?|popup|modal|"
                   r"newsletter\w*|subscribe\w*|signup|sidebar\w*|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|footer|"
                   r"masthead|comments?|commentlist|disqus|replies|reply|share|sharing|social|related|recommend\w*|pagination|pager|login|"
                   r"searchform)(?:$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply)(?:$|[\s_-])", re.I)
HEADER = re.compile(r"(?:^|[\s_-])(?:header|topbar)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
WORD, UNQUOTED = re.compile(r"\w"), re.compile(r"=[^\s\"']*/\Z")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


class Page:
    """Elements (tag, attributes, start, end, parent) in page order, and
    pieces: (element, raw text), or (element, None) between blocks."""

    def __init__(self, source: str):
        self.source = source
        self.elements: list[list] = [["html", "", 0, len(source), -1]]
        self.pieces: list[tuple[int, str | None]] = []
        #: Inline elements that are all there is in their lines.
        self.alone: set[int] = set()
        self._line: list[int] = []
        self._bare = False
        self._open, self._depth = 0, 0
        stack = [0]
        at = 0
        while True:
            m = TOKEN.search(source, at)
            if m is None:
                break
            if m.start() > at:
                self._text(stack[-1], source[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in INLINE:
                self._inline(stack[-1], tag, m)
            elif m[1]:
                self._end(stack, tag, m)
            elif tag == "hr":
                self._boundary(stack[-1], m.start())
            elif tag in VOID:
                self._text(stack[-1], " " if tag == "br" else "")
            elif tag in RAW:
                close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(source, at)
                at = close.end() if close else len(source)
            elif not m[3].endswith("/"):
                self._start(stack, tag, m)
        if at < len(source):
            self._text(stack[-1], source[at:])
        self._boundary(0, len(source))

    def _text(self, element: int, raw: str) -> None:
        self.pieces.append((self._open or element, raw))
        self._bare = self._bare or not self._open and WORD.search(raw) is not None

    def _boundary(self, element: int, at: int) -> None:
        """End of a line; an inline element that is open goes no further."""
        if self._open:
            self.elements[self._open][3] = at
            self._line.remove(self._open)
        if not self._bare:
            self.alone.update(self._line)
        self._line, self._bare, self._open = [], False, 0
        self.pieces.append((element, None))

    def _inline(self, element: int, tag: str, m: re.Match) -> None:
        """Outermost inline elements of lines outside paragraphs."""
        empty = m[3].endswith("/") and not UNQUOTED.search(m[3])
        if self._open:
            if tag == self.elements[self._open][0]:
                self._depth += -1 if m[1] else not empty
            if not self._depth:
                self.elements[self._open][3] = m.end()
                self._open = 0
        elif not m[1] and not empty and self.elements[element][0] not in TEXT | {"li"}:
            self.elements.append([tag, m[3], m.start(), len(self.source), element])
            self._open, self._depth = len(self.elements) - 1, 1
            self._line.append(self._open)

    def _start(self, stack: list[int], tag: str, m: re.Match) -> None:
        closed, fence = CLOSES.get(tag, ((), ()))
        for k in range(len(stack) - 1, 0, -1):
            name = self.elements[stack[k]][0]
            if name in closed:
                for e in stack[k:]:
                    self.elements[e][3] = m.start()
                del stack[k:]
                break
            if name in fence:
                break
        # the element is the next one
        self._boundary(len(self.elements), m.start())
        self.elements.append([tag, m[3], m.start(), len(self.source), stack[-1]])
        stack.append(len(self.elements) - 1)

    def _end(self, stack: list[int], tag: str, m: re.Match) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.elements[stack[k]][0] == tag:
                for e in stack[k:]:
                    self.elements[e][3] = m.start()
                self.elements[stack[k]][3] = m.end()
                del stack[k:]
                self._boundary(stack[-1], m.start())
                return

    def marks(self) -> tuple[list[bool], list[bool]]:
        """For each element: whether it or one around it names itself as no
        article text; whether it is in an article."""
        gone, inside = [False], [False]
        for tag, attributes, _, _, parent in self.elements[1:]:
            within = inside[parent] or tag == "article"
            inside.append(within)
            gone.append(gone[parent] or tag not in INLINE and (tag in NEVER or _named(tag, attributes, within)))
        return gone, inside

    def templates(self) -> Iterator[tuple[int, int]]:
        """Elements that could be a site's, with the hash of their subtree."""
        gone, inside = self.marks()
        hashes = self.hashes()
        for i, (tag, _, _, _, parent) in enumerate(self.elements):
            if i and tag not in SCOPE and not gone[parent] and not (inside[i] and (tag in TEXT or tag == "li")) \
                    and (tag not in INLINE or i in self.alone):
                yield i, hashes[i] - (1 << 63)

    def hashes(self) -> list[int]:
        """A hash of each element's subtree, from the innermost out: its tag,
        its own text without needless white space, and its children's hashes.
        Attributes do not count: menus differ in links and marks."""
        own: list[list[str]] = [[] for _ in self.elements]
        for element, raw in self.pieces:
            if raw is not None:
                own[element].append(raw)
        children: list[list[int]] = [[] for _ in self.elements]
        found = [0] * len(self.elements)
        for i in range(len(self.elements) - 1, -1, -1):      # children come after their parent
            tag, _, _, _, parent = self.elements[i]
            text = " ".join("".join(own[i]).split())
            nested = ",".join(map(str, reversed(children[i])))
            found[i] = xxhash.xxh64_intdigest(f"{tag}\0{text}\0{nested}".encode("utf-8", "replace"))
            if i:
                children[parent].append(found[i])
        return found

    def evidence(self) -> Iterator[tuple[int, int, int | None]]:
        """Hash of each element that could be a site's, 0, and the hash of the
        longest block of the page outside it (none if the element has most of
        the text); the same with 1 and the next block, if that is half as long
        as both."""
        n = len(self.elements)
        last = list(range(n))
        for i in range(n - 1, 0, -1):
            parent = self.elements[i][4]
            last[parent] = max(last[parent], last[i])
        blocks = sorted(self._blocks(self.marks()[0]), key=lambda b: -len(b[1]))
        upto = [0] * (n + 1)
        for owner, text in blocks:
            upto[owner + 1] += len(text)
        for i in range(n):
            upto[i + 1] += upto[i]
        for i, code in self.templates():
            within = upto[last[i] + 1] - upto[i]
            if not blocks or 2 * within > upto[n]:
                yield code, 0, None
                continue
            beside = list(islice((text for owner, text in blocks if not i <= owner <= last[i]), 2))
            for k, text in enumerate(beside):
                if not k or 2 * len(text) >= max(within, len(beside[0])):
                    yield code, k, xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)

    def text(self, recurring: frozenset[int]) -> str:
        """Blocks of the article, one a line."""
        gone, _ = self.marks()
        if recurring:
            found = {i for i, code in self.templates() if code in recurring}
            for i in range(1, len(self.elements)):
                gone[i] = gone[i] or i in found or gone[self.elements[i][4]]
        return "\n".join(text for _, text in self._blocks(gone))

    def _blocks(self, gone: list[bool]) -> Iterator[tuple[int, str]]:
        """Blocks of the article, each with the element that holds it."""
        scope = self._scope(gone)
        owners, block = set(), []
        for element, raw in self.pieces:
            if raw is None:
                text = " ".join(html.unescape("".join(block)).split())
                if text:
                    # several inline elements are held by the one around them
                    one = min(owners)
                    yield one if len(owners) == 1 or self.elements[one][0] not in INLINE else self.elements[one][4], text
                owners, block = set(), []
            elif scope[element] and not gone[element]:
                block.append(raw)
                if raw.strip():
                    owners.add(element)

    def _scope(self, gone: list[bool]) -> list[bool]:
        """Elements of the articles, or of the main part, or all."""
        for wanted in ("article", "main"):
            scope = [False] * len(self.elements)
            for i, (tag, attributes, _, _, parent) in enumerate(self.elements):
                main = tag == wanted or wanted == "main" and attributes and _role(attributes) == "main"
                scope[i] = not gone[i] and (bool(main) or parent >= 0 and scope[parent])
            if any(scope):
                return scope
        return [True] * len(self.elements)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def _role(raw: str) -> str:
    return _attributes(raw).get("role", "").lower() if "role" in raw.lower() else ""


def _named(tag: str, raw: str, within: bool) -> bool:
    """Whether a tag and its attributes say that it is no article text."""
    if tag == "header" and not within:
        return True
    if not raw or tag in ("body", "html", "main"):
        return False
    given = _attributes(raw)
    names = f"{given.get('class', '')} {given.get('id', '')}"
    if tag == "article":
        return bool(COMMENTS.search(names))
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return False
    return bool(NAMED.search(names)) or not within and bool(HEADER.search(names)) \
        or given.get("role", "").lower() in ROLES or re.search(r"\shidden(?:\s|$|=)", raw) is not None \
        or "display:none" in given.get("style", "").replace(" ", "")


def host(url: Column) -> Column:
    """Lower-case host of a url; null if it has none."""
    found = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(found, F.lit(""))


def site_templates(pages: DataFrame, least: int = PAGES) -> DataFrame:
    """host, page (hash of the html) and the hashes of the page's recurring
    subtrees, of pages that have some.  ``pages`` has host, html and page.
    Pages that share a hash share the list, which changes no text: a page
    looks for its own subtrees in it."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(zip(*set(Page(source.as_py() or "").evidence()))) or [(), (), ()] for source in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("page"), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.int8())), pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                ["host", "page", "code", "place", "beside"])

    known = pages.where("host is not null").select("host", "page", "html").mapInArrow(
        hashes, "host string, page bigint, code array<bigint>, place array<tinyint>, beside array<bigint>")
    known = written(known.select("host", "page", F.inline(F.arrays_zip("code", "place", "beside"))), "subtrees")
    counts = known.where("beside is not null").groupBy("host", "code", "place", "beside").agg(F.lit(1).alias("one")).groupBy(
        "host", "code", "place").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    # joined tables are written, so that joins shuffle both sides and may split
    # a subtree of all pages of a hot host, or a page with many copies
    recurring = written(counts.select("host", "code").distinct(), "recurring")
    return written(known.where("place = 0").select("host", "page", "code").distinct().join(recurring, ["host", "code"]).groupBy(
        "host", "page").agg(F.collect_list("code").alias("codes")), "templates")


def main_text(pages: DataFrame, least: int = PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    table = pages.select(pages["page_id"].alias("page_id"), pages["url"].cast("string").alias("url"),
                         host(pages["url"].cast("string")).alias("host"), pages["html"].cast("string").alias("html"))
    table = table.withColumn("page", F.xxhash64("html"))
    joined = table.join(site_templates(table, least), ["host", "page"], "left").select("page_id", "url", "html", "codes")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source.as_py() or "").text(frozenset(codes.as_py() or ()))
                     for source, codes in zip(batch.column("html"), batch.column("codes"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(extract, f"page_id {field_type(table, 'page_id')}, url string, text string, n_chars bigint")
