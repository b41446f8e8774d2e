"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block; a line's length is its visible text,
zero inside what is never article (menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) and, where the page
names its article, outside of it.  The lengths are summed over sliding windows of
``WINDOW`` lines: text begins where a sum surges from zero and ends where it dives
back, and the stretches in between whose peak reaches ``PEAK`` characters are kept
(any text at all inside a named article; the highest stretch if none reaches it).
All text between surge and dive stays but page furniture: a heading between two parts
of a named article does, whoever holds it, if fewer than ``WINDOW`` lines part them.
An article element or content label names the article only if it holds most of the
text; ``<main>`` does however short.  Where nothing is named, text that is not all
links stays too if it shares its container with a kept line.

A class or id label is no more than a hint: one that tells a state (``has-sidebar``,
``comments-open``) says nothing, and an element that holds nearly all of the page's
text, or its named article and most of the text, is no furniture whatever its label.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by one newline.  ``<br>`` is white space, as are
table cell borders; a table row is a block.

Cases: null, empty and markup-free input give whatever text there is (the empty
string if none); unclosed and stray tags are closed as browsers do; very long pages
are read in one pass; repeated rows and null urls are kept; an empty table gives an
empty result; extra columns are kept, ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import html as references
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
PEAK = 60
LABEL, MAIN, ARTICLE = 1, 2, 4                 # bits of an article mark

# HTML element names by role, and class or id words of page furniture.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
    menu nav ol optgroup option p pre search section summary table tbody tfoot thead title tr ul""".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
SPACES = frozenset("br td th wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("""head nav aside footer form dialog button select textarea input label fieldset
    noscript template svg math canvas object iframe audio video map menu search""".split())
RAW = frozenset("script style noscript template textarea iframe title xmp noembed noframes".split())
ROLES = frozenset("""navigation banner contentinfo complementary search alert alertdialog dialog form
    menu menubar toolbar""".split())
FURNITURE = frozenset("""ad ads advert adverts advertisement advertisements advertising adsense adbox
    sponsor sponsored sponsors promo promos promoted promotion banner banners cookie cookies consent gdpr
    notice notices alert alerts notification notifications menu menus nav navbar navigation navi
    breadcrumb breadcrumbs sidebar sidebars aside footer footers header masthead topbar toolbar comment
    comments commentlist disqus reply replies respond discussion share sharing shares social related
    recommended recommendations newsletter subscribe subscription signup login popup modal overlay widget
    widgets pagination pager paywall skip copyright""".split())
STATE_BEFORE = frozenset("has no with without category tag".split())
STATE_AFTER = frozenset("open opened closed enabled disabled".split())
OTHER_TEXT = frozenset("""comment comments commentlist disqus reply replies respond discussion cookie cookies
    consent gdpr copyright""".split())            # furniture that may well be longer than the article
ARTICLE_WORDS = frozenset("article post entry content story main body".split())
CONTENT = frozenset("""content article post story entry main articlebody postcontent entrycontent articlecontent storybody postbody
    maincontent contentmain contentbody articletext""".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_READ = frozenset("class id role itemprop hidden style aria-hidden".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW | {"script", "style"}}
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(text: str) -> dict[str, str]:
    return {n: m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)
            if (n := m[1].lower()) in _READ}


def _is_furniture(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds no article text, by its name, role or style."""
    if name in SKIPPED or name == "header" and not in_article:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" \
            or _HIDING.search(attributes.get("style", "")):
        return True
    return name not in ("html", "body", "main") and attributes.get("role", "").lower() in ROLES


def _furniture_words(name: str, attributes: dict[str, str], in_article: bool) -> set[str]:
    """Words of page furniture in an element's class and id labels, without those that tell a state."""
    out = set()
    if name in ("html", "body", "main"):
        return out
    for label in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = [w.lower() for w in _WORD.findall(label)]
        found = {w for i, w in enumerate(words) if w in FURNITURE
                 and not STATE_BEFORE.intersection(words[:i]) and not STATE_AFTER.intersection(words[i + 1:])}
        # entry-header, post-header: the article's own heading
        if not (found == {"header"} and (in_article or ARTICLE_WORDS.intersection(words))):
            out |= found
    return out


def _names_article(name: str, attributes: dict[str, str]) -> int:
    """How an element is named the article: ARTICLE, MAIN, LABEL (by class or id) or 0."""
    if name == "article" or attributes.get("itemprop", "").lower() == "articlebody":
        return ARTICLE
    if name == "main" or attributes.get("role", "").lower() == "main":
        return MAIN
    labels = attributes.get("class", "") + " " + attributes.get("id", "")
    return LABEL if any(re.sub(r"[^a-z]", "", x.lower()) in CONTENT for x in labels.split()) else 0


def _cleared(lines: list, labelled: list[tuple[int, set[str]]]) -> list[bool]:
    """Whether each element with a furniture label is none, as the page's text is in it."""
    own, named = [0] * len(labelled), [False] * len(labelled)
    rest, rest_named = 0, False
    for text, odd, mark, links, _, label in lines:
        n = 0 if odd else max(0, len(text) - 2 * links)
        if label < 0:
            rest, rest_named = rest + n, rest_named or not odd and mark >= MAIN
        else:
            own[label], named[label] = own[label] + n, named[label] or not odd and mark >= MAIN
    total, whole = rest + sum(own), own[:]
    for e in range(len(labelled) - 1, -1, -1):     # outer elements have the smaller numbers
        if labelled[e][0] >= 0:
            whole[labelled[e][0]] += whole[e]
    out = []
    for e, (outer, words) in enumerate(labelled):
        clear = (outer < 0 or out[outer]) and 2 * whole[e] >= total and (
            rest == 0 or not own[e] or not words & OTHER_TEXT and (
                own[e] >= 4 * rest or named[e] and not rest_named and own[e] > rest))
        out.append(clear)
        if clear:
            rest, rest_named = rest + own[e], rest_named or named[e]
    return out


def lines_of(page: str) -> list[tuple[str, bool, int, int, int]]:
    """(text, furniture, enclosing article marks, characters in links, container) per block, in page order.

    ``container`` numbers the element around the block: its own, or a text block's parent.
    """
    out, pieces, links, labelled = [], [], 0, []
    # open elements: (name, furniture, article mark, whether its text is passed over within a block,
    # number of the container, and of the innermost element with a furniture label)
    stack: list[tuple[str, bool, int, bool, int, int]] = []
    furniture, mark, silent, container, label, link_depth, opened = False, 0, False, 0, -1, 0, 0

    def end_block():
        nonlocal pieces, links
        if pieces:
            text = " ".join(references.unescape("".join(pieces)).split())
            if text:
                out.append((text, furniture, mark, links, container, label))
            pieces, links = [], 0

    at, size = 0, len(page)
    while at < size:
        tag = _TOKEN.search(page, at)
        stop = tag.start() if tag else size
        if stop > at and not silent:
            piece = page[at:stop]
            pieces.append(piece)
            if link_depth:
                links += len(piece.strip())
        if not tag:
            break
        at = tag.end()
        if tag[2] is None:
            if tag[0].startswith("<![CDATA["):
                pieces.append(tag[0][9:].removesuffix("]]>"))
            continue
        name = tag[2].lower()
        if name in SPACES:
            pieces.append(" ")
        if not tag[1]:
            if name in _ENDS and not tag[3].rstrip().endswith("/>"):
                end = _ENDS[name].search(page, at)
                at = end.end() if end else size
                if name in BLOCKS:
                    end_block()
                continue
            if name == "a":
                link_depth += 1
            if name in BLOCKS:
                end_block()
                for i in range(len(stack) - 1, -1, -1):     # a block ends an open paragraph,
                    if stack[i][0] == "p" or name == "li" and stack[i][0] == "li":   # an item the last
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCKS:
                        break
                furniture, mark, silent, container, label = \
                    stack[-1][1:] if stack else (False, 0, False, 0, -1)
            if name in VOID or name == "a" or tag[3].endswith("/>") and name not in BLOCKS:
                continue
            attributes = _attributes(tag[3]) if len(tag[3]) > 6 else {}
            if name in BLOCKS or name in SKIPPED or attributes:
                odd = not furniture and _is_furniture(name, attributes, mark >= MAIN)
                words = set() if furniture or odd else _furniture_words(name, attributes, mark >= MAIN)
                inline = (odd or bool(words)) and name not in BLOCKS
                if words and not inline:
                    labelled.append((label, words))
                    label = len(labelled) - 1
                if name in BLOCKS and name not in TEXT_BLOCKS:
                    opened += 1
                    container = opened
                stack.append((name, furniture or odd and not inline,
                              mark | _names_article(name, attributes), silent or inline, container, label))
                furniture, mark, silent, container, label = stack[-1][1:]
        else:
            if name == "a":
                link_depth = max(0, link_depth - 1)
            known = name in BLOCKS
            if known:
                end_block()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if not known and stack[i][0] in BLOCKS:     # an inline end doesn't close a block
                    break
            furniture, mark, silent, container, label = \
                    stack[-1][1:] if stack else (False, 0, False, 0, -1)
    end_block()
    clear = _cleared(out, labelled)
    return [(text, odd or label >= 0 and not clear[label], mark, n, container)
            for text, odd, mark, n, container, label in out]


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of each stretch of lines whose sliding sums stay above zero."""
    out, start, last, total, peak = [], None, -1, 0, 0
    for i, n in enumerate([*lengths, *[0] * window]):
        total += n - (lengths[i - window] if i >= window else 0)
        if n:
            start = i if start is None else start
            last = i
        peak = max(peak, total)
        if start is not None and total == 0:
            out.append((start, last + 1, peak))
            start, peak = None, 0
    return out


def main_text(page: str | None, window: int = WINDOW, peak: int = PEAK) -> str:
    lines = lines_of(page or "")
    surest = _surest(lines)
    lengths = []
    for text, odd, mark, links, _ in lines:
        if odd or surest and not mark & surest:
            lengths.append(0)
        else:
            lengths.append(len(text) if surest else max(0, len(text) - 2 * links))
    found = stretches(lengths, window)
    least = 1 if surest else peak
    kept = [s for s in found if s[2] >= least]
    if not kept and found:
        kept = [max(found, key=lambda s: s[2])]
    chosen = {i for begin, end, _ in kept for i in range(begin, end) if not lines[i][1]}
    if not surest:                              # short text beside what is kept, like a parted title
        shared = {lines[i][4] for i in chosen if lengths[i]}
        chosen |= {i for i, (text, odd, _, links, container) in enumerate(lines)
                   if not odd and container in shared and links < len(text)}
    return "\n".join(lines[i][0] for i in sorted(chosen))


def _surest(lines: list) -> int:
    """The article mark to go by: an article or a label must hold most of the text, <main> need not."""
    def most(bit):
        inside = sum(len(text) for text, odd, mark, _, _ in lines if not odd and mark & bit)
        return inside and inside >= sum(max(0, len(text) - 2 * links) for text, odd, mark, links, _ in lines
                                        if not odd and not mark & bit)

    if most(ARTICLE):
        return ARTICLE
    if any(not odd and mark & MAIN for _, odd, mark, _, _ in lines):
        return MAIN
    return LABEL if most(LABEL) else 0


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` without html, plus text and n_chars (its code points)."""
    @F.pandas_udf("string")
    def text_of(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in batch], dtype=object)

    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    found = pages.select(*kept, text_of(F.coalesce(F.col("html"), F.lit(""))).alias("text"))
    return found.select(*kept, "text", F.char_length("text").cast("long").alias("n_chars"))
