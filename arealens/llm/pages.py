"""Main text of web pages.

Method: line-block distribution. Markup is stripped into lines, one per block of text, with
an empty line where a container begins or ends. The text lengths of `WINDOW` lines are summed
from each line on. Where the sums surge above `SURGE` the main text begins, and it ends where
they dive to nothing; lines between are kept. Text in menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments by readers is left out beforehand.
Where lines kept stand in an article or main element, all its lines are kept with them, so
short lines at its edges stay; lines kept outside stay as well. A run takes in the short lines
just before it, up to the border of a container: its title and byline. Without a surge, every
line that is not mostly links is kept. A paragraph that is a link stays between two that are not.

Class names and ids mark what is not main text by whole names, not by any word in them. A name
that tells of the layout (has-sidebar, no-comments) or of a text's own heading (entry-header)
marks nothing, and one that goes on after its mark (share-page) only elements that hold less
than half of the page's text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 86
LINKED = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre section select
    summary table tbody td template tfoot th thead tr ul video audio canvas svg object""".split())
CONTAINERS = frozenset("article aside body div footer form header main nav ol section table ul".split())
CLOSES_P = BLOCKS - {"td", "th", "tr"}
LEFT_OUT = frozenset("""aside button canvas datalist dialog fieldset footer form head iframe menu nav noembed noframes noscript object
    option script select style svg template textarea title""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar alert dialog alertdialog".split())
#: Words of class names and ids that mark what is not main text.
MARKS = re.compile(
    r"ads?|advert\w*|adsense|adslot|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|disclaimer|footer|gdpr|"
    r"header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notification|outbrain|overlay|pager|pagination|paywall|popup|promo\w*|"
    r"recommend\w*|related|replies|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|taboola|"
    r"toolbar|topbar|widget|login")
#: Words that may follow a mark in the name of an element that is nothing else.
PARTS = frozenset("""area bar block body box button buttons container content footer form grid group header inner items left lg link links list
    main md menu module outer pane panel right row section sm slot strip text title top unit widget widgets wrap wrapper xs articles news posts stories""".split())
#: Words that make a name tell of the layout around, or of a state.
LAYOUT = frozenset("closed disabled enabled free has hidden hide is none no not off on open without with".split())
HEADED = frozenset("article content entry post story".split())
#: Attributes of an element that holds the heading of the text after it.
HEADING = re.compile(r"[\s\"'=](?:article|content|entry|post|story)[_-]header(?:$|[\s\"'>_-])", re.I)

TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"[ \t\n\r\f\v   -     　\u0085]+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _mark(name: str, inside: bool) -> int:
    """What a class name or id says of its element: 2 not main text, 1 perhaps not, 0 nothing. Inside an article a header is its heading."""
    words = [w for w in re.split(r"[_-]+", name.lower()) if w]
    at = [i for i, w in enumerate(words) if MARKS.fullmatch(w)]
    if not at or LAYOUT & set(words):
        return 0
    if words[at[-1]] == "header" and (HEADED & set(words[:at[-1]]) or inside) or (inside and words == ["search"]):
        return 0
    return 2 if all(w in PARTS or w.isdigit() for w in words[at[-1] + 1:]) else 1


def _unwanted(tag: str, rest: str, inside: bool) -> int:
    """Whether an element holds no main text: 2 for sure, 1 perhaps, 0 no. A header inside an article is its heading."""
    if tag in LEFT_OUT or (tag == "header" and not inside):
        return 2
    if tag in ("html", "body") or "=" not in rest and "hidden" not in rest:
        return 0
    given = _attributes(rest)
    if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in ROLES:
        return 2
    if re.search(r"display\s*:\s*none", given.get("style", "")):
        return 2
    if tag == "main":
        return 0
    return max((_mark(name, inside) for name in f"{given.get('class', '')} {given.get('id', '')}".split()), default=0)


def lines_of(page: str, perhaps: frozenset[int] | None = None, sizes: dict[int, int] | None = None) -> Iterator[tuple[str, int, int]]:
    """Lines of a page's wanted text: (text, characters of it in links, number of its article or main element, 0 for none).

    An empty line stands where a container begins or ends, one where several do. Of elements that
    perhaps hold no main text those at the places `perhaps` are left out; `sizes` takes the
    text of each that is not, by place.
    """
    # Open elements: tag, whether unwanted, article number before, text before, place if in doubt, whether the heading of what follows.
    stack: list[tuple[str, bool, int, int, int, bool]] = []
    seen = 0
    open_tags: dict[str, int] = {}
    unwanted = links = article = articles = 0
    parts: list[str] = []
    linked = 0
    parted = True

    def flush() -> Iterator[tuple[str, int, int]]:
        nonlocal linked, parted, seen
        text = SPACES.sub(" ", "".join(parts)).strip(" ")
        parts.clear()
        if text:
            seen += max(len(text) - linked, 0)
            yield text, linked, article
            parted = False
        linked = 0

    def pop() -> None:
        nonlocal unwanted, links, article
        tag, bad, before, text_before, place, _ = stack.pop()
        if place >= 0 and sizes is not None:
            sizes[place] = seen - text_before
        open_tags[tag] -= 1
        unwanted -= bad
        links -= tag == "a"
        if tag in ("article", "main"):
            article = before

    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        text = page[at:token.start() if token else len(page)]
        if text and not unwanted:
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not token:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            yield from flush()
            heading = bool(token[1] and stack) and stack[-1][0] == tag and stack[-1][5]
            if tag in CONTAINERS and not parted and not heading:
                yield "", 0, article
                parted = True
        if token[1]:
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and open_tags.get("p"):
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == "p":
                    # Formatting left open in a paragraph ends with it.
                    while len(stack) > place:
                        pop()
                    break
                if stack[place][0] in CONTAINERS:
                    break
        sure = 0 if unwanted else _unwanted(tag, token[3], article > 0)
        bad = sure == 2 or (sure == 1 and token.start() in (perhaps or ()))
        if not token[3].endswith("/>") or tag in BLOCKS or tag in RAW:
            stack.append((tag, bad, article, seen, token.start() if sure == 1 and not bad else -1, bool(HEADING.search(token[3]))))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            unwanted += bad
            links += tag == "a"
            if tag in ("article", "main") and not unwanted:
                if article == 0:
                    articles += 1
                    article = articles
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else len(page)
    yield from flush()
    while stack:
        pop()
    if sizes is not None:
        sizes[-1] = seen


def wanted_lines(page: str) -> list[tuple[str, int, int]]:
    """The lines of a page without elements that perhaps hold no main text and hold less than half of the text."""
    sizes: dict[int, int] = {}
    lines = list(lines_of(page, None, sizes))
    whole = sizes.pop(-1)
    small = frozenset(place for place, size in sizes.items() if 2 * size < whole)
    return list(lines_of(page, small)) if small else lines


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by one space; empty if there is none."""
    if not page:
        return ""
    lines = wanted_lines(page)
    # Text in links tells of menus, so it does not count.
    sizes = [max(len(t) - linked, 0) for t, linked, _ in lines]
    sums = [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]
    keep = [False] * len(lines)
    i = 0
    while i < len(lines):
        if sums[i] > SURGE and sizes[i] and any(sizes[i + 1:i + WINDOW + 1] + [sizes[i] > SURGE]):
            j = i
            while j and lines[j - 1][0] and not keep[j - 1] and lines[j - 1][1] <= LINKED * len(lines[j - 1][0]):
                j -= 1
                keep[j] = True
            j = i
            while j < len(lines) and sums[j] > 0:
                keep[j] = True
                j += 1
            i = j
        else:
            i += 1
    if not any(keep):
        # No surge: a page of short lines.
        keep = [n > 0 for n in sizes]
    own = [bool(t) and k and linked <= LINKED * len(t) for (t, linked, _), k in zip(lines, keep)]
    plain = [o or (k and 0 < i < len(own) - 1 and own[i - 1] and own[i + 1]) for i, (o, k) in enumerate(zip(own, keep))]
    found = {a for (_, _, a), k in zip(lines, keep) if k and a}
    return " ".join(t for (t, _, a), k in zip(lines, plain) if t and (k or a in found))


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of each row's whole page as column `out`, which replaces one of that name.

    Character references are decoded; white space inside a block becomes one space. Null and
    empty pages, and pages without main text, give an empty text. Repeated rows stay; an
    empty table gives an empty table.
    """

    @F.pandas_udf("string")
    def extracted(column):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([main_text(p) for p in column], dtype="object")

    return pages.withColumn(out, extracted(F.col(html_col).cast("string")))
