"""HTML extraction: the maximum-scoring subsequence of a page's words and tags.

A page is a sequence of words and tags.  Labelled pages, those whose landmark (``<article>``,
``<main>``, ``role="main"``) holds most of their words, give each kind of token its weight: the
log-odds of its share inside against its share outside.  A word's kind is the block around
it, whether it is linked, and its place: inside a landmark, outside one, or (each word counts
here too) on a page of which nothing is known.  Words outside a landmark score between the
last two weights, by the share of the page's words that landmarks hold, so a landmark with a
teaser or an image says little.  Tags never add.  One linear scan finds the contiguous region
with the best sum; its blocks, without the elements that are never article text (menus,
forms, adverts, comments, hidden ones ...), are the text.

Defined results: null, empty and wordless pages give an empty text; of regions with equal
sums the first and shortest counts; broken markup is read as far as it goes (an unclosed
element ends with its parent, an open quote ends nothing); pages are independent, so
repeated rows repeat their result; extra columns stay.  No length limit.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import ship, text_of

ship(__name__)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<""", re.S)
_ATTRIBUTE = re.compile(r"""(?:\s|^)(class|id|role|aria-label|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)""", re.I)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Elements whose content is no markup; elements without content.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start a new block of text.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul""".split())
#: Elements that never hold article text, and names that mark such elements in class, id or role.
SKIP = frozenset("""head title script style noscript template svg math iframe object embed canvas audio video map nav footer aside form
button select textarea input label fieldset menu dialog search xmp noembed noframes""".split())
SKIP_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar
menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert
popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments
disqus respond replies pagination pager widget skip complementary contentinfo""".split())
#: Of these, names that also qualify article text ("share-price"): a compound counts only if it
#: ends in a skip name or in the name of a part of a page.
WEAK_NAMES = frozenset("""ad ads alert banner comment login menu notice notices pager promo promotion recommended related replies respond
share sharing signup skip social sponsor widget""".split())
PART_NAMES = frozenset("""area bar block body bottom box button buttons card container content form frame group header icon icons inner item
items left link links list main message outer page panel primary right row section secondary slot text title top unit wrap wrapper""".split())
#: A header so named is the article's own, not the page's.
ARTICLE_NAMES = frozenset("article entry post story content".split())
LANDMARK = frozenset(("article", "main"))
#: Elements that a start tag of a block closes, with what they hold.
_LIGHT = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li option".split())

#: A tag takes at least this from a region's sum; a word of an unlabelled place adds at least this.
LEAST = 0.05
#: No weight is larger, either way: one kind of token is no surer than twenty to one.
MOST = 3.0
#: Counted beforehand for each kind on both sides.
PRIOR = 0.5
#: Share of a page's words in landmarks from which on it is a labelled page.
LABELLED = 0.5


def _names_skip(value: str) -> bool:
    for compound in re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower().split():
        parts = _NAME.findall(compound)
        named = SKIP_NAMES.intersection(parts)
        if named - WEAK_NAMES or named and (parts[-1] in SKIP_NAMES or parts[-1] in PART_NAMES):
            return True
    return False


def _skips(name: str, attributes: str, in_article: bool) -> bool:
    if name in SKIP or name == "header" and not in_article:
        return True
    if not attributes or name in ("body", "html"):
        return False
    given = [(key.lower(), value.strip("\"'")) for key, value in _ATTRIBUTE.findall(attributes)]
    if (_HIDDEN.search(_QUOTED.sub("", attributes)) or any(key == "style" and _UNSEEN.search(value) for key, value in given)
            or ("aria-hidden", "true") in given):
        return True
    if name in LANDMARK:
        return False
    values = [value for key, value in given if key not in ("style", "aria-hidden")]
    parts = {part for value in values for part in _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())}
    return any(map(_names_skip, values)) or "header" in parts and not in_article and not parts & ARTICLE_NAMES


def _marks(name: str, attributes: str) -> bool:
    return name in LANDMARK or any(key.lower() == "role" and value.strip("\"'").lower() == "main"
                                   for key, value in _ATTRIBUTE.findall(attributes))


def tokens(page: str) -> list[tuple[str, str]]:
    """(kind, value): ``w:block`` a text outside skipped elements and links, ``a:block`` one in a
    link, ``<name`` and ``</name`` tags; kinds end in @ inside a landmark.  A skipped element
    leaves its start and end tags only, as ``<name!`` and ``</name!``."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements, whether they are skipped, whether landmarks
    skipped = links = article = 0
    blocks: list[str] = []
    end, at = len(page), 0

    def close(to: int) -> None:
        nonlocal skipped, links, article
        while len(stack) > to:
            name, skip, mark = stack.pop()
            skipped -= skip
            links -= name == "a"
            article -= mark
            if name in BLOCK:
                blocks.pop()

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if page[m.start()] != "<" or at - m.start() == 1:
                if not skipped:
                    out.append((("a:" if links else "w:") + (blocks[-1] if blocks else "") + "@" * bool(article), m[0]))
            continue
        name, attributes = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            where = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if where is not None:
                was = skipped
                close(where)
                if was:
                    if not skipped:
                        out.append((f"</{name}!" + "@" * bool(article), ""))
                    continue
            if not skipped:
                out.append((f"</{name}" + "@" * bool(article), ""))
            continue
        if name in BLOCK and stack:  # a block ends the paragraph that it follows, or what was left open in it
            light = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK), None)
            if light is not None and stack[light][0] in _LIGHT and (stack[light][0] in ("p",) or stack[light][0] == name):
                close(light)
        if name in LANDMARK and skipped and stack[-1][0] not in RAW:
            close(next(k for k, (_, skip, _) in enumerate(stack) if skip))  # an unclosed advert or menu
        skip = _skips(name, attributes, bool(article))
        if not skipped:
            out.append((f"<{name}" + "!" * skip + "@" * bool(article), ""))
        if name in VOID or attributes.endswith("/") and name in ("svg", "path", "a"):
            continue
        if name in RAW:
            close_at = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = end if close_at is None else page.find(">", close_at.start()) + 1 or end
            continue
        skipped += skip
        mark = not skipped and _marks(name, attributes)
        stack.append((name, skip, mark))
        links += name == "a"
        article += mark
        if name in BLOCK:
            blocks.append(name)
    return out


def _size(kind: str, text: str) -> int:
    return len(text.split()) if kind[0] in "wa" else 1


def marked_share(found: list[tuple[str, str]]) -> float:
    """Share of the unlinked words that landmarks hold; 0 without words."""
    sizes = Counter()
    for kind, text in found:
        if kind[0] == "w":
            sizes[kind[-1] == "@"] += len(text.split())
    return sizes[True] / (sizes.total() or 1)


def label_counts(page: str) -> tuple[Counter, Counter]:
    """Token kinds inside and outside the landmarks of a labelled page; nothing of others."""
    inside, outside = Counter(), Counter()
    found = tokens(page)
    if marked_share(found) >= LABELLED:
        for kind, text in found:
            n, placed = _size(kind, text), kind.endswith("@")
            base = kind.rstrip("@")
            side = inside if placed else outside
            if kind[0] == "<":
                side[kind] += n
                continue
            letter = kind[0]
            for k in (base, letter, *((base + "@", letter + "@") if placed else (base + "-", letter + "-"))):
                side[k] += n
    return inside, outside


def fit(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weights of token kinds from all labelled pages; their number is that of HTML's tags."""
    known = sorted(BLOCK | SKIP | VOID | RAW | frozenset("a b i em strong span u s small big sub sup code tt font cite q abbr mark "
                                                         "time del ins kbd samp var picture".split()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = set(known)
        for batch in batches:
            total: dict[str, list[int]] = {}
            for page in batch["page"]:
                for k, counts in enumerate(label_counts(page)):
                    for kind, n in counts.items():
                        if kind[0] == "<" and kind.strip("</!@") not in names:
                            kind = "<other" + "@" * kind.endswith("@")
                        total.setdefault(kind, [0, 0])[k] += n
            yield pd.DataFrame([(k, a, b) for k, (a, b) in total.items()], columns=["kind", "inside", "outside"])

    rows = (pages.select(text_of(html_col).alias("page")).mapInPandas(count, "kind string, inside long, outside long")
            .groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect())
    counts = {r["kind"]: (r["inside"], r["outside"]) for r in rows}
    # what a landmark says by itself, and that links are rather menus, before any page is seen
    places = {"w": (1, 0), "a": (0, 1), "w@": (1, 0), "w-": (0, 1), "a@": (0, 0), "a-": (0, 1)}
    places = {kind: tuple(x + y for x, y in zip(seen, counts.get(kind, (0, 0)), strict=True)) for kind, seen in places.items()}

    def clipped(odds: float) -> float:
        return max(-MOST, min(MOST, odds))

    def odds(part: tuple[int, int], whole: tuple[int, int]) -> float:
        """Of a part of a whole, drawn to 0 where one side is hardly seen."""
        prior = PRIOR * sum(part) / (sum(whole) or 1)
        a, b = ((n + prior) / (total + PRIOR) for n, total in zip(part, whole, strict=True))
        return math.log(a / b) if a and b else 0.0

    words = tuple(counts.get("w", (0, 0))[k] + counts.get("a", (0, 0))[k] for k in (0, 1))
    weights = {kind: clipped(math.log((a + PRIOR) / (words[0] + 2 * PRIOR)) - math.log((b + PRIOR) / (words[1] + 2 * PRIOR)))
               for kind, (a, b) in places.items()}
    tags = tuple(sum(n[k] for kind, n in counts.items() if kind[0] == "<") for k in (0, 1))
    for kind, n in counts.items():
        if kind[0] == "<":
            weights[kind] = clipped(odds(n, tags))
        elif kind not in weights:  # words of a block: what the block adds to what the place says
            letter = kind[0] + kind[-1] * (kind[-1] in "@-")
            weights[kind] = clipped(weights[letter] + odds(n, counts[letter]))
    return weights


def _weight(weights: dict[str, float], *kinds: str) -> float:
    """Of the first kind that has one; 0 if none has."""
    return next((weights[k] for k in kinds if k in weights), 0.0)


def score(kind: str, weights: dict[str, float], share: float) -> float:
    """Of one word, or one tag, on a page whose landmarks hold this share of the words."""
    place, base = kind.endswith("@"), kind.rstrip("@")
    letter = base[0]
    if letter == "<":
        return min(-LEAST, _weight(weights, kind))
    if place:
        return _weight(weights, kind, letter + "@", base, letter)
    free = _weight(weights, base, letter)
    if letter == "w" and "w" in weights:  # plain words may be the article wherever nothing speaks against it
        free = max(LEAST, free) if weights["w"] > 0 else free
    return share * _weight(weights, base + "-", letter + "-") + (1 - share) * free if share else free


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) with the largest sum, the first and shortest of such; (0, 0) if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best + 1e-9:
            best, region = total, (start, k + 1)
    return region


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text of one page."""
    found = tokens(page)
    share = marked_share(found)
    start, end = best_region([_size(kind, text) * score(kind, weights, share) for kind, text in found])
    blocks, part = [], []
    for kind, text in found[start:end]:
        kind = kind.rstrip("@")
        if kind[0] != "<":
            part.append(text)
        elif kind == "<br":
            part.append(" ")
        elif kind.strip("</!") in BLOCK:
            blocks.append("".join(part))
            part = []
    blocks.append("".join(part))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def extracted(pages: DataFrame, html_col: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with ``main_text``."""
    weights = fit(pages, html_col) if weights is None else weights

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(page, weights) for page in batch], dtype=object)

    return pages.withColumn("main_text", F.pandas_udf(run, "string")(text_of(html_col)))
