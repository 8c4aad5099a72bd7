"""Main text of HTML pages by two passes of block rules.

The first pass judges each block by its stop-word density, its length and its link density, inside
an article, beside one and without one: good, bad, or undecided; a place that isn't content rules it
out. Beside an article a block must be longer to be good, and inside one few stop words leave it
undecided, as articles hold lists and tables. In the second pass undecided blocks take the label
of the nearest decided neighbour of their place; between two as near that differ, and with none,
the place decides.
"""

from __future__ import annotations

import html as entities
import re
import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from opsledger.llm.common import apart, table

DENSE = 0.2  # stop words among words of a good block
SPARSE = 0.02  # and of a bad one, below
LONG = 70  # characters of a block that can be good by itself
BESIDE = 200  # and of one beside the page's article
LINKED = 0.4  # characters in links of a bad block
# fixed values: frequent function words of English, German, French and Spanish
STOP = frozenset("a about after all an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on one only or other our out she so some than that the their them then there these they this to up was we were what when which who will with would you your der die das den dem des ein eine einer eines einem einen und oder aber ist sind war im in zu zum zur von vom mit für auf an als auch sich nicht es er sie wir ihr bei nach aus um wie wenn nur noch über durch le la les un une des du de et ou mais est sont dans en au aux pour par sur avec ce cette ces il elle ils elles nous vous qui que se ne pas plus son sa ses leur el los las uno unos unas y o pero es son con por para del al lo su sus se que no más como este esta".split())
DROPPED = frozenset("script style noscript template head title iframe object svg math canvas audio video select option button label textarea datalist map".split())
BLOCKS = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split())
HELD = frozenset("article aside blockquote body center dialog details div dl fieldset figure footer form header main menu nav ol section span table ul p li".split())
BOILER = frozenset("nav aside footer form menu dialog".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
# class and id words of the places that aren't content, and words that only say where something stands
NAMES = frozenset("ad ads advert adverts banner breadcrumb breadcrumbs comment comments cookie cookies footer header masthead menu nav navbar navigation newsletter notice notices promo related reply replies share sidebar social sponsor sponsored subscribe toolbar widget".split())
PLACES = frozenset("site page main top bottom left right list item items box bar wrap wrapper inner outer section block container post posts signup area".split())
READERS = frozenset("comment comments reply replies related promo ad ads".split())


def named(value: str, names: frozenset[str] = NAMES) -> bool:
    """Whether a class token of ``value`` is of ``names``, alone or with words that only say where it stands."""
    for token in value.lower().split():
        words = re.split("[-_]+", token)
        if any(w in names for w in words) and all(w in NAMES or w in PLACES or w.isdigit() or not w for w in words):
            return True
    return False


EDGES = string.punctuation + string.digits + "«»“”‘’„…¿¡–—"
OTHER = re.compile("[^\\W\\d_\u0041-\u024f]")
OUTER, MARKED, SURE = 1, 2, 3  # bad places: by the name of an element around the article, by name, by the element itself
TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>|!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|[!?/][^>]*+>)", re.S)
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def _boiler(name: str, attrs: str, inside: bool) -> int:
    """How surely an element isn't content: 0, MARKED or SURE."""
    mark = 0
    if name in BOILER or (name == "header" and not inside):
        return SURE
    if len(attrs) < 3 or name in ("html", "body"):
        return 0
    for key, a, b, c in ATTR.findall(attrs):
        value = a or b or c
        key = key.lower()
        if key in ("class", "id"):
            if named(value, READERS if name in ("article", "main") else NAMES) and not (name == "header" and inside):
                mark = MARKED
        elif key == "role":
            if value.lower() in ROLES:
                return SURE
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return SURE
    return mark


def density(s: str, stop: frozenset[str] = STOP) -> float | None:
    """Stop words among the words of a block; None where most letters are of another script than the stop words', Latin."""
    if not s.isascii() and 2 * len(OTHER.findall(s)) > sum(map(str.isalpha, s)):
        return None
    words = s.lower().split()
    return sum(w.strip(EDGES) in stop for w in words) / len(words)


def judged(s: str, linked: int, bad: bool, inside: bool, article: bool) -> bool | None:
    """The first look at a block by its place, link density, length and stop words: content, not content, or None if they don't tell.

    A place that isn't content rules a block out; no place makes one good, and beside the page's
    article it takes a longer block.
    """
    if bad:
        return False
    if linked > LINKED * len(s):
        return None if inside and linked < 0.9 * len(s) else False
    if len(s) < (BESIDE if article and not inside else LONG):
        return None
    found = density(s)
    if found is None or found >= DENSE:
        return True
    return False if found < SPARSE and not inside else None


def _settled(found: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, bool, bool]]:
    """``found`` with the places that aren't content decided: names are evidence only while other text remains."""
    least = MARKED
    if any(inside and not bad for _, _, bad, inside in found):
        least = OUTER
    elif not any(inside and bad == OUTER for _, _, bad, inside in found) and not any(not bad and len(s) >= LONG and linked <= LINKED * len(s) for s, linked, bad, _ in found):
        least = SURE
    return [(s, linked, bad >= least, inside) for s, linked, bad, inside in found]


def blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters in links, in a place that isn't content, in an article) of each block, in page order."""
    out: list[tuple[str, int, int, bool]] = []
    stack: list[tuple[str, int, bool]] = []  # name, boilerplate, article: each holds for what is inside
    text: list[str] = []
    linked, in_link, bad, inside, at, end = 0, False, 0, False, 0, len(page)

    def close() -> None:
        nonlocal linked
        s = "".join(text)
        if "&" in s:
            s = entities.unescape(s)
        if s := " ".join(s.split()):
            out.append((s, linked, bad, inside))
        text.clear()
        linked = 0

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            text.append(page[at:lt])
            if in_link:
                linked += lt - at
        if lt == end:
            break
        m = TAG.match(page, lt)
        if not m:
            text.append("<")
            at = lt + 1
            continue
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            if m["data"]:
                text.append(m["data"])
            continue
        name = name.lower()
        ending = m["end"] or m["end2"]
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in DROPPED and not ending:
            if attrs.endswith("/") and name not in ("script", "style", "title", "textarea"):
                continue
            done = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if done:
                at = done.end()
            elif name in ("script", "style", "title", "textarea", "iframe"):
                at = end
            continue
        if name == "a":
            in_link = not ending
            continue
        if name == "br":
            text.append(" ")
            continue
        block = name in BLOCKS
        if block:
            close()
        if name not in HELD or name in VOID:
            continue
        if ending:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if (stack[k][1] != bad or stack[k][2] != inside) and not block:
                        close()
                    del stack[k:]
                    break
                if name in ("p", "li", "span") and stack[k][0] not in ("p", "span"):
                    break
        elif not attrs.endswith("/"):
            if name == "p":
                while stack and stack[-1][0] in ("p", "span"):
                    stack.pop()
            elif name == "li" and stack and stack[-1][0] in ("li", "p"):
                while stack and stack[-1][0] in ("li", "p", "span"):
                    stack.pop()
            was_bad, was_in = (stack[-1][1], stack[-1][2]) if stack else (0, False)
            own = _boiler(name, attrs, was_in)
            if was_bad == MARKED and not own and (name == "main" or name == "article") and all(x[0] != "article" for x in stack):
                was_bad = OUTER
            now = max(was_bad, own)
            if now != bad and not block:
                close()
            stack.append((name, now, was_in or name in ("article", "main")))
        bad, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
    close()
    return _settled(out)


def labels(found: list[tuple[str, int, bool, bool]]) -> list[bool]:
    """Whether each block belongs to the main text."""
    article = any(inside and not bad for _, _, bad, inside in found)
    first = [judged(*b, article) for b in found]
    good = any(first)
    out, n = [], len(first)
    ahead, behind = [n + 1] * n, [n + 1] * n
    nxt: list[bool | None] = [None] * n
    prev: list[bool | None] = [None] * n
    # a block doesn't inherit across the border of its place
    for k in range(n):
        if first[k] is not None:
            prev[k], behind[k] = first[k], 0
        elif k and found[k - 1][2:] == found[k][2:]:
            prev[k], behind[k] = prev[k - 1], behind[k - 1] + 1
    for k in range(n - 1, -1, -1):
        if first[k] is not None:
            nxt[k], ahead[k] = first[k], 0
        elif k + 1 < n and found[k + 1][2:] == found[k][2:]:
            nxt[k], ahead[k] = nxt[k + 1], ahead[k + 1] + 1
    for k in range(n):
        place = found[k][3] or (not article and not good)
        if prev[k] is None and nxt[k] is None:
            out.append(place)
        elif prev[k] is None or nxt[k] is None:
            out.append(prev[k] if nxt[k] is None else nxt[k])
        elif prev[k] == nxt[k]:
            out.append(prev[k])
        else:
            out.append((prev[k] if behind[k] < ahead[k] else nxt[k]) if behind[k] != ahead[k] else place)
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n\n".join(b[0] for b, good in zip(found, labels(found), strict=True) if good)


@F.pandas_udf(StringType())
def _extract(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(main_text, na_action=None)


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text and n_chars, its code points.

    Null or empty pages have the empty text. Pages of any length are read whole, each by
    itself, so repeated rows get equal texts. An empty table gives an empty result. Other
    columns are kept, whatever their names; those named text or n_chars are replaced.
    """
    back, held = apart(pages, [], ["text", "n_chars"])
    text = _extract(f"_in{pages.columns.index(html_col)}")
    return held.withColumn("text", text).select(*back, "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
