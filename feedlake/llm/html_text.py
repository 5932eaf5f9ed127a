"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Pass 1 decides blocks by rules:
blocks in menus, headers, footers, sidebars, notices, adverts, forms and comments
(by element or by words of class, id and role) are out; the others by length,
stop-word density and link density.  Blocks that are too short or too plain to
tell are left open, and pass 2 gives them the label of the nearest decided
neighbours of their region.  A region is the closest article, main or excluded
element; where a page has an article with text, only articles can hold main text
and their open blocks without decided neighbours stay in.  An article inside an
element that is out by a class word alone (``has-sidebar``), or a post with such a
word itself, is in doubt: it counts where the page has no other article, and only
with blocks that pass 1 or a decided neighbour lets in.  Comments stay out.

Scripts, styles, comments, heads and hidden elements are dropped while reading.
Character references are decoded, white space becomes one space, kept blocks are
joined in page order by an empty line; nothing else is cut.  Null html counts as
empty and gives an empty text; every row gives a row; an empty table gives none.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W

MIN_LENGTH = 70          # shorter blocks are left open
STOP_LOW = 0.15          # least share of stop words of a decided block
LINK_HIGH = 0.4          # greatest share of linked characters

# Common function words of the four languages, elements, class words.
STOP_WORDS = frozenset("""
a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its
more no not of on one or our she so some such than that the their them then there these they this to was we were
what when which who will with would you your
aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch ein eine einem einen einer
er es für hat hatte ich ihr im in ist ja kann mit nach nicht noch nur ob oder sein sich sie sind so über um und uns
vom von vor war was wenn wer wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais me même mes moi
ne nos notre nous on ou où par pas pour qu que qui sa se ses son sur ta te tu un une vos votre vous
al algo como con cual de del desde donde el ella ellos en entre era es esta este esto fue ha hay la las le lo los
más me mi muy no nos o para pero por que se ser si sin sobre son su sus también te tiene todo tu un una uno y ya
""".split())
BLOCK_TAGS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul
""".split())
RAW_TAGS = frozenset("script style noscript template textarea iframe svg math object select canvas title".split())
OUT_TAGS = frozenset("nav menu footer aside form dialog button fieldset".split())
MAIN_TAGS = frozenset("article main".split())
OUT_WORDS = frozenset("""
ad ads adv advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments
consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation navigationbar newsletter
notice notices notification pager pagination popup promo promoted promotion recommended related replies reply
respond search share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription teaser
toolbar widget complementary contentinfo
""".split())
HEAD_WORDS = frozenset("header topbar".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
POST_WORDS = frozenset("article entry hentry post story".split())       # as whole words of class, id or role

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[^a-z0-9]+")


class _Region:
    """An article, an excluded element or the rest of the page.

    ``doubt``: an element that is out by a class word alone, or an article in one.
    """
    __slots__ = ("tag", "main", "out", "doubt")

    def __init__(self, tag: str, main: bool, out: bool, doubt: bool = False):
        self.tag, self.main, self.out, self.doubt = tag, main, out, doubt

    @property
    def article(self) -> bool:
        return self.main or self.doubt and not self.out


def _is_comment(words: set[str], whole: set[str]) -> bool:
    return bool(COMMENT_WORDS & whole or COMMENT_WORDS & words and not POST_WORDS & whole)


def _attributes(text: str) -> tuple[set[str], set[str], bool]:
    """(words of class, id and role; the same uncut; hidden)."""
    words, whole, hidden = set(), set(), False
    for name, value in _ATTR.findall(text):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(
                r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif name in ("class", "id", "role"):
            words.update(_PARTS.split(value))
            whole.update(value.split())
    return words, whole, hidden


def _blocks(page: str) -> list[tuple[str, int, _Region]]:
    """(text, linked characters, region) of the blocks with text, in page order."""
    out: list[tuple[str, int, _Region]] = []
    root = _Region("", False, False)
    stack: list[tuple[str, _Region]] = []       # open elements that have a say, with their regions
    parts: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, linked, stack[-1][1] if stack else root))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def excluded(name: str, words: set[str], whole: set[str], hard: bool) -> _Region:
        """Out; in doubt if only by a class word, outside of articles and comments."""
        above = stack[-1][1] if stack else root
        doubt = not (hard or above.article or above.out and not above.doubt or _is_comment(words, whole))
        return _Region(name, False, True, doubt)

    while m := _TAG.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, closing = name.lower(), bool(m["close"] or m["close2"])
        if name in RAW_TAGS or name == "head":
            if not closing and not page[m.end() - 2:m.end()] == "/>":
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)|\Z" if name != "head" else
                                 r"(?i)</head\b[^>]*>|(?=<body\b)|\Z", re.I).search(page, at)
                at = end.end()
            continue
        if name == "a":
            in_link = not closing
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in BLOCK_TAGS:
            if not closing and m["attrs"]:
                words, whole, hidden = _attributes(m["attrs"])
                if hidden or OUT_WORDS.intersection(words):
                    flush()
                    stack.append((name, excluded(name, words, whole, hidden)))
            elif closing and stack and stack[-1][0] == name:
                flush()
                stack.pop()
            continue
        flush()
        in_link = False
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in ("p", "hr", "html", "body", "br"):
            if name != "p":
                continue
        region = stack[-1][1] if stack else root
        words, whole, hidden = _attributes(m["attrs"] or m["attrs2"] or "")
        inside = region.article
        named = bool(OUT_WORDS.intersection(words))
        post = bool(POST_WORDS & whole) and not _is_comment(words, whole)
        if name in MAIN_TAGS and (not named or post and not inside) and not hidden:
            # An article cannot stand in a menu or page header: that one was not closed.
            while stack and stack[-1][0] in ("nav", "menu", "header", "ul", "li"):
                stack.pop()
            region = stack[-1][1] if stack else root
            doubt = named or region.doubt
            stack.append((name, region if region.out and not region.doubt else _Region(name, not doubt, False, doubt)))
        elif hidden or name in OUT_TAGS or named or not inside and (name == "header" or HEAD_WORDS.intersection(words)):
            hard = hidden or name in OUT_TAGS or name in MAIN_TAGS or name == "header"
            stack.append((name, excluded(name, words, whole, hard)))
        elif name != "p":
            stack.append((name, region))
    add(page[at:])
    flush()
    return out


def _label(text: str, linked: int, region: _Region) -> bool | None:
    """Pass 1: in (True), out (False) or open (None)."""
    if region.out:
        return False
    words = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    dense = linked > LINK_HIGH * len(text)
    if len(text) >= MIN_LENGTH and stops >= STOP_LOW and not dense:
        return True
    if region.main:
        return None
    if dense or text.startswith("\N{COPYRIGHT SIGN}"):
        return False
    return None


def main_text(page: str) -> str:
    """The kept blocks of a page, joined by an empty line."""
    blocks = _blocks(page)
    has_main = any(r.main for _, _, r in blocks)
    labels = [False if has_main and not r.main else _label(t, n, r) for t, n, r in blocks]
    decided: dict[int, list[int]] = {}
    for i, (_, _, r) in enumerate(blocks):
        if labels[i] is not None:
            decided.setdefault(id(r), []).append(i)
    kept, last = [], {}
    for i, (text, linked, r) in enumerate(blocks):
        label = labels[i]
        if label is not None:
            last[id(r)] = last.get(id(r), 0) + 1
        else:
            near, k = decided.get(id(r), []), last.get(id(r), 0)
            around = [j for j in (near[k - 1] if k else None, near[k] if k < len(near) else None) if j is not None]
            # The nearest decided block; of two as near, one that stays in wins.
            label = labels[min(around, key=lambda j: (abs(j - i), not labels[j]))] if around else r.main or not (linked or r.doubt)
        if label:
            kept.append(text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("binary").alias("html"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.blocks(batches, "html", 8 << 20):
            texts = [main_text(h.decode("utf-8", "replace")) for h in W.utf8(part.column("html"))]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
