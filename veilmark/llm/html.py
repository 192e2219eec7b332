"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: elements (by their path of tags and classes), blocks of
text at such a path, and contents (all the blocks below an element with several). A
token's occurrence vector says how often it occurs on each page of its host, where pages
with equal texts count once. Tokens with equal vectors over at least ``SUPPORT`` pages and
most pages of the host form a class; a text or a content whose class holds its element
stands there each time, so the two nest into the host's template, and all that is below a
constant element goes with it. What is left of a page are its slots. All pages are
compared, those with an ``article`` too: a menu or a share line inside it goes under any
name, a passage that pages share stays, because other texts stand at its path. Where more
than half of an article would go as template, the host's pages are copies with small
changes, and the article stays whole.

Tags and names are a prior. The main text is the slots inside ``article`` or ``main``
where a page has one, otherwise all slots, without those below elements whose tag, role,
class or id says navigation, header, footer, sidebar, notice, advert, form, script, style
or comment. Inside an article only clear names (adverts, comments, share boxes,
newsletters) are apart; text under the other names goes only if it is template, whatever
is left of the article.

A host's template texts are each on most of its distinct pages, so they are at most twice
as many as the blocks of an average page: a row carries no more than that.

White space inside a block becomes one space (``br`` is white space), blocks are joined
by an empty line, character references are decoded. NULL html is empty and has no text;
rows are independent, so repeated ids and pages are extracted each; pages without a host
share the empty host; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.llm.arrow import batch, text_groups
from veilmark.llm.urls import split_url
from veilmark.sources.shared import cut

SUPPORT = 3
#: Most template texts that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

# HTML's element kinds.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var picture audio video canvas object map".split()
)
#: An opening tag ends an open element of these kinds.
ENDS = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
    **{t: {"p"} for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()},
}
#: Elements whose end a search for an open element does not cross.
SCOPES = frozenset("article aside body div footer form header html main nav section table ul ol dl td th".split())
APART = frozenset("head nav header footer aside form button select menu dialog".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar alert dialog".split())
APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager header masthead footer foot sidebar sidebars "
    "aside rail notice notices cookie cookies consent gdpr disclaimer copyright popup modal overlay alert "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended "
    "newsletter subscribe subscription signup login form search widget widgets toolbar skip".split()
)

#: Inside an article only these are apart by name, alone or with words for their boxes.
APART_INSIDE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsored comments commentlist disqus share sharing newsletter".split()
)
BOX_NAMES = frozenset("area bar block box button buttons container form icons inner item links list section slot thread unit wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Contents are named by a polynomial of their texts' hashes, modulo a prime.
PRIME, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
_NAME = re.compile(r"[a-z]+")


@lru_cache(maxsize=100_000)
def _element(tag: str, attributes: str) -> tuple[str, bool, int]:
    """An element's name in a path, whether what is in it is apart from the text, and what
    it is inside an article: text (0), text unless it is template (1) or apart (2)."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    names = found.get("class", "").split()
    parts = [frozenset(_NAME.findall(n)) for n in (*names, found.get("id", ""))]
    apart = tag in APART or found.get("role") in APART_ROLES or any(p & APART_NAMES for p in parts)
    apart = apart and tag not in ("html", "body", "article", "main")
    clear = (tag in APART and tag != "header") or found.get("role") in APART_ROLES
    clear |= tag not in HEADINGS and any(p & APART_INSIDE and p <= APART_INSIDE | BOX_NAMES for p in parts)
    return ".".join([tag, *sorted(names)]), apart, (2 if clear else 1) if apart else 0


class Page:
    """The blocks and elements of one page."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, bool, bool]] = []  # path, text, inside article or main, under a name that may be apart
        self.hashes: list[int] = []  # of the blocks' texts
        self.contents: list[tuple[str, int, int, int]] = []  # path, hash, first block, block after the last
        self.elements: Counter = Counter()
        self.has_main = False
        self._sums = [0]  # polynomials of the first blocks
        # tag, path, apart (0 to 2), main, text before (inline) or first block
        self._stack: list[tuple[str, str, int, bool, list | int]] = []
        self._text: list[str] = []
        at = 0
        while m := _TAG.search(source, at):
            if m.start() > at:
                self._text.append(source[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._close(tag)
                continue
            attributes = (m[3] if m[2] else m[6]) or ""
            if tag in _RAW_END and not attributes.endswith("/"):
                end = _RAW_END[tag].search(source, at)
                at = end.end() if end else len(source)
            elif tag == "br":
                self._text.append(" ")
            elif tag == "hr":
                self._flush()
            elif tag not in VOID:
                self._open(tag, attributes)
        self._text.append(source[at:])
        self._end(0)
        self._flush()

    def _flush(self) -> None:
        if self._text:
            text = "".join(self._text)
            self._text.clear()
            if "&" in text:
                text = entities.unescape(text)
            text = " ".join(text.split())
            _, path, apart, main, _ = self._stack[-1] if self._stack else ("", "", 0, False, None)
            if text and apart < 2:
                self.blocks.append((path, text, main, apart == 1))
                self.hashes.append(_hash(text))
                self._sums.append((self._sums[-1] * BASE + self.hashes[-1]) % PRIME)

    def _open(self, tag: str, attributes: str) -> None:
        name, apart, inside = _element(tag, attributes)
        if tag in INLINE:
            above = self._stack[-1][1:4] if self._stack else ("", 0, False)
            if inside == 2 if above[2] else apart:  # its text goes, and the block goes on after it
                self._stack.append((tag, above[0], 2, above[2], self._text))
                self._text = []
            return
        self._flush()
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] in ENDS.get(tag, ()):
                self._end(i)
                break
            if self._stack[i][0] in SCOPES:
                break
        _, path, was_apart, was_main, _ = self._stack[-1] if self._stack else ("", "", 0, False, None)
        main = was_main or (tag in ("article", "main") and not was_apart)
        level = inside if was_main else 2 * apart
        self.has_main |= main
        path = f"{path}/{name}"
        self.elements[path] += 1
        self._stack.append((tag, path, max(level, was_apart), main, len(self.blocks)))

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == tag:
                self._end(i)
                return
            if tag in INLINE and self._stack[i][0] in SCOPES:
                return
        if tag not in INLINE:
            self._flush()

    def _end(self, i: int) -> None:
        """End the elements from number ``i`` on."""
        while len(self._stack) > i:
            _, path, _, _, before = self._stack[-1]
            if isinstance(before, list):
                self._text = before
            else:
                self._flush()
                if len(self.blocks) - before > 1:
                    self.contents.append((path, self._content(before, len(self.blocks)), before, len(self.blocks)))
            self._stack.pop()

    def _content(self, lo: int, hi: int) -> int:
        return (self._sums[hi] - self._sums[lo] * pow(BASE, hi - lo, PRIME)) % PRIME ^ hi - lo

    def digest(self) -> int:
        """Of the texts of all blocks."""
        return self._content(0, len(self.blocks))

    def tokens(self) -> Counter:
        """(path, text): occurrences. ``text`` is 0 for an element."""
        found = Counter({(_path(p), 0): n for p, n in self.elements.items()})
        found.update((_path(b[0]), h) for b, h in zip(self.blocks, self.hashes, strict=True))
        found.update((_path(p), h) for p, h, _, _ in self.contents)
        return found

    def slots(self) -> list[tuple[str, str]]:
        """Path and text of the blocks that may be main text."""
        return [(p, t) for p, t, main, _ in self.blocks if main or not self.has_main]

    def text(self, fixed: set[tuple[int, int]]) -> str:
        """The slots without the template texts and contents ``fixed`` (path, hash)."""
        fix = [bool(fixed) and (_path(b[0]), h) in fixed for b, h in zip(self.blocks, self.hashes, strict=True)]
        before = len(fix)  # an element is listed after those in it: backwards, these follow it
        for path, content, lo, hi in reversed(self.contents) if fixed else ():
            if hi <= before and (_path(path), content) in fixed:
                fix[lo:hi] = [True] * (hi - lo)
                before = lo
        kept = [(t, f, main, unsure) for (_, t, main, unsure), f in zip(self.blocks, fix, strict=True) if main or not self.has_main]
        if self.has_main:
            copies = 2 * sum(len(t) for t, f, _, _ in kept if f) > sum(len(t) for t, _, _, _ in kept)
            kept = [(t, f and (unsure or not copies), main, unsure) for t, f, main, unsure in kept]
        return "\n\n".join(t for t, f, _, _ in kept if not f)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def occurrences(pages: DataFrame) -> DataFrame:
    """host, path, text, vector, n_pages, n: the tokens of each host, where pages with
    equal texts count once (of these, the one with the least hash of its elements).
    ``text`` is 0 for an element. Path 0 stands for the page itself."""
    token = pa.struct([("path", pa.int64()), ("text", pa.int64()), ("n", pa.int64())])
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("form", pa.int64()), ("tokens", pa.list_(token))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hosts = part["host"].to_pylist()
            for lo, sources in text_groups(part["html"]):
                found = {}
                for k, source in enumerate(sources, lo):
                    page = Page(source)
                    tokens = page.tokens()
                    if tokens:
                        tokens[0, 0] = 1
                        form = _hash(repr((sorted(page.elements.items()), page.blocks)))
                        found[hosts[k], page.digest(), form] = [{"path": p, "text": t, "n": n} for (p, t), n in tokens.items()]
                if found:
                    yield batch(schema, *zip(*((*k, v) for k, v in found.items()), strict=True))

    distinct = pages.select("host", "html").mapInArrow(
        count, "host string, page long, form long, tokens array<struct<path: long, text: long, n: long>>"
    ).groupBy("host", "page").agg(F.min_by("tokens", "form").alias("tokens"))
    return distinct.select("host", "page", F.inline_outer("tokens")).groupBy("host", "path", "text").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("n_pages"), F.sum("n").alias("n")
    )


@lru_cache(maxsize=100_000)
def _path(path: str) -> int:
    return _hash(path)


def templates(tokens: DataFrame) -> DataFrame:
    """host, path, text of the texts and contents that are in the class of the element
    around them, on most of the host's distinct pages."""
    hosts = tokens.where("path = 0 AND text = 0").select("host", F.col("n_pages").alias("n_host"))
    frequent = tokens.where((F.col("n_pages") >= SUPPORT) & (F.col("path") != 0))
    elements = frequent.where("text = 0").drop("text")
    nested = frequent.where("text != 0").join(elements, ["host", "path", "vector", "n_pages", "n"])
    return nested.join(hosts, "host").where("2 * n_pages > n_host").select("host", "path", "text")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    hosted = pages.select("page_id", "url", "html", split_url("url")[0].alias("host"))
    template = cut(templates(cut(occurrences(hosted), "tokens")), "template")
    by_host = template.groupBy("host").agg(F.collect_list(F.struct("path", "text")).alias("fixed"))
    joined = hosted.join(F.broadcast(by_host) if template.count() <= BROADCAST_ROWS else by_host, "host", "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for lo, sources in text_groups(part["html"]):
                texts = []
                for k, source in enumerate(sources, lo):
                    texts.append(Page(source).text({(x["path"], x["text"]) for x in part["fixed"][k].as_py() or ()}))
                n = len(texts)
                yield batch(schema, part["page_id"].slice(lo, n), part["url"].slice(lo, n), texts, [len(t) for t in texts])

    return joined.select("page_id", "url", "html", "fixed").mapInArrow(fill, "page_id long, url string, text string, n_chars long")
