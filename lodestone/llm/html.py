"""Main text of web pages by the maximum-scoring contiguous subsequence.

A page is a sequence of blocks of words with tags between them. Words and tags score by their context, the block's tag,
class and links, with weights learned from labelled pages: those that mark their article with article or main, at most
max_pages of them, the ones whose ids hash lowest. Words score positive unless their context speaks against it, tags negative; in a
marked article every word that isn't left out scores positive, and tags cost little. One linear scan
finds the contiguous run of blocks with the largest total; what the run holds of menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments is left out.

An element is left out by its tag, or by a class, id or role all of whose parts are hints, unless it holds the page's largest
article or main element, or, where there is none, its first h1 outside headers, menus, footers and sidebars. Parsing
takes time linear in the page, whatever its nesting.

Results for odd input: a null or empty page, or one without any word that counts, has an empty text; unclosed tags,
comments and quotes end where a browser would end them or at the page's end; rows with null or repeated ids are extracted like any other; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import hash_sample

# Names of HTML elements and words in class, id or role that mark what isn't main text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mrow mfrac msup msub msqrt mtext svg g text tspan".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title video audio select".split())
ASIDE = frozenset("nav header footer aside form button dialog menu head".split())
HINTS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice alert popup modal newsletter subscribe signup login share sharing social related recommended comment comments reply replies disqus form search pagination pager toolbar skip hidden".split())
FILLERS = frozenset("site page top bottom left right main box block bar area list container wrapper wrap inner section links item items content text global js is".split())  # say nothing beside a hint
COMMENTS = frozenset("comment comments reply replies disqus".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    """text; context: of its words; tags: contexts of the tags since the block before; out: part of what is left out; inside: of the marked article."""

    text: str
    context: str
    tags: list[str]
    out: bool
    inside: bool
    links: float = 0.0


def _hinted(attributes: str) -> str | None:
    """The first hint in class, id or role, or "hidden". A name counts if its parts are hints, or hints and fillers."""
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden":
            return "hidden"
        if name == "role" and value in ROLES:
            return value
        if name != "role":
            for token in value.split():
                parts = PART.findall(token)
                hints = [p for p in parts if p in HINTS]
                if hints and all(p in HINTS or p in FILLERS for p in parts):
                    return hints[0]
    return None


class _Zone:
    """An element that is left out, by why, within another one; spared if it turns out to hold the article."""

    __slots__ = ("why", "above", "tag", "spared", "known")

    def __init__(self, why: str, tag: str, above: _Zone | None):
        self.why, self.tag, self.above, self.spared, self.known = why, tag, above, False, None

    def spare(self, firm: frozenset = frozenset()) -> None:
        """Spare this and what it is in, but comments and tags in firm."""
        zone = self
        while zone:
            zone.spared = zone.why not in COMMENTS and zone.tag not in firm
            zone = zone.above

    def out(self) -> str | None:
        """Why this is left out, if it is; what it is in counts as well."""
        chain, zone = [], self
        while zone and zone.known is None:
            chain.append(zone)
            zone = zone.above
        why = zone.known if zone else ""
        for zone in reversed(chain):
            why = zone.known = why if zone.spared else zone.why
        return self.known or None


@dataclass
class _Open:
    """An open element: its tag, the nearest one that isn't inline, zone, number of the article it is in (0: none), and whether it is in a link."""

    tag: str
    holder: str
    zone: _Zone | None
    article: int
    linked: bool


class _Stack:
    """Open elements, with the places of each tag, so that no search walks the stack."""

    def __init__(self):
        self.all = [_Open("", "body", None, 0, False)]
        self.places: dict[str, list[int]] = {}

    def top(self) -> _Open:
        return self.all[-1]

    def push(self, tag: str, zone: _Zone | None, article: int) -> None:
        top = self.all[-1]
        self.places.setdefault(tag, []).append(len(self.all))
        self.all.append(_Open(tag, top.holder if tag in INLINE else tag, zone, article, top.linked or tag == "a"))

    def pop(self, tag: str, stop: frozenset | set = frozenset()) -> None:
        """Close the innermost tag and all in it, unless one of stop is open within."""
        at = self.places.get(tag)
        if not at or any(self.places.get(s, [0])[-1:] > at[-1:] for s in stop):
            return
        for element in self.all[at[-1] :][::-1]:
            self.places[element.tag].pop()
            self.all.pop()


_P_STOPS = frozenset({"td", "th", "table", "button", "object"} | (CLOSES_P - {"p"}))
_INLINE_STOPS = frozenset(CLOSES_P | {"li", "td", "th"})
_ASIDES = frozenset("header nav footer aside menu head".split())


def blocks(page: str | None) -> list[Block]:
    """The page's blocks of text, in order."""
    page = page or ""
    found: list[tuple[str, str, list[tuple[str, _Zone | None]], _Zone | None, int, float]] = []
    stack, text, tags = _Stack(), [], []
    articles: list[_Zone | None] = [None]
    sizes, parents, headline = [0], [0], None
    linked, at = 0, 0

    def close() -> None:
        nonlocal linked, tags
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            top = stack.top()
            found.append((joined, top.holder, tags, top.zone, top.article, min(1.0, linked / len(joined))))
            sizes[top.article] += len(joined)
            tags = []
        text.clear()
        linked = 0

    while m := TOKEN.match(page, at):
        at = m.end()
        tag = (m[2] or m[5] or "").lower()[:32]
        if not tag:
            piece = m[0]
            if not piece.startswith(("<!", "<?")):
                text.append(piece)
                if stack.top().linked:
                    linked += len(piece.strip())
            continue
        ends = bool(m[1] or m[4])
        if tag in RAW and not ends:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            tags.append((f"<{tag}", stack.top().zone))
            continue
        if tag == "br" or tag == "hr":
            text.append(" ")
        top = stack.top()
        if tag in INLINE or tag == "br":
            if tag not in VOID:
                if ends:
                    stack.pop(tag, _INLINE_STOPS)
                else:
                    why = _hinted(m[3] or m[6] or "") if tag in ("span", "a") else None
                    stack.push(tag, _Zone(why, tag, top.zone) if why else top.zone, top.article)
            continue
        close()
        tags.append((f"</{tag}" if ends else f"<{tag}", top.zone))
        if ends:
            stack.pop(tag)
            continue
        if tag in CLOSES_P:
            stack.pop("p", _P_STOPS)
        for other in SELF_CLOSE.get(tag, ()):
            stack.pop(other, SCOPES[tag])
        if tag in VOID:
            continue
        top = stack.top()
        why, article = _hinted(m[3] or m[6] or ""), top.article
        if tag in ("body", "html", "main", "article") or (tag == "h1" and article):
            why = "comment" if why in COMMENTS and tag == "article" else None
        if tag in ASIDE and not (tag == "header" and article):
            why = tag
        elif article and why in ("header", "masthead"):
            why = None
        zone = _Zone(why, tag, top.zone) if why else top.zone
        if tag in ("article", "main") and not why:
            articles.append(zone)
            sizes.append(0)
            parents.append(article)
            article = len(sizes) - 1
        if tag == "h1" and headline is None and zone and not any(stack.places.get(t) for t in _ASIDES):
            headline = zone
        stack.push(tag, zone, article)
    close()
    if len(sizes) > 1:
        for k in range(len(sizes) - 1, 0, -1):  # an article holds what is in the articles in it
            sizes[parents[k]] += sizes[k] if parents[k] else 0
        largest = max(range(1, len(sizes)), key=lambda k: (sizes[k], -k))
        if articles[largest]:
            articles[largest].spare()
    elif headline:
        headline.spare(_ASIDES)
    out = []
    for joined, holder, names, zone, article, share in found:
        why = zone.out() if zone else None
        context = f"{holder}{'.' + why if why else ''}{'/a' if share > 0.5 else ''}"
        out.append(Block(joined, context, [n + (f".{w}" if z and (w := z.out()) else "") for n, z in names], why is not None, article > 0, share))
    return out


TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())


@dataclass(frozen=True)
class Weights:
    """Scores of a word by context and of a tag by name. What wasn't learned falls back on the context without its class, then on a default."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, block: Block) -> float:
        for context in (block.context, block.context.removesuffix("/a")):
            if context in self.words:
                learned = self.words[context]
                break
        else:
            if block.out or block.context.endswith("/a"):
                learned = -1.0
            else:
                learned = self.words.get(block.context.split(".")[0], 0.5 if block.context in TEXT_TAGS else 0.25)
        return max(learned, 0.5) if block.inside and not block.out else learned

    def tag(self, name: str, inside: bool = False) -> float:
        """Of a tag that wasn't seen in training, or one in the marked article, not much."""
        return max(-0.05, self.tags.get(name, -0.05)) if inside else self.tags.get(name, -0.05 if "." not in name else -0.5)


def best_region(page: list[Block], weights: Weights) -> tuple[int, int]:
    """The run [from, to) of blocks whose words and tags have the largest total; the first of equals. A run starts after the tags before its first block."""
    best, top, since, total = 0.0, (0, 0), 0, 0.0
    for k, block in enumerate(page):
        within = block.inside and k > 0 and page[k - 1].inside
        total += sum(weights.tag(t, within) for t in block.tags)
        if total <= 0:
            since, total = k, 0.0
        total += weights.word(block) * len(block.text.split())
        if total > best:
            best, top = total, (since, k + 1)
    return top


def main_text(page: str | None, weights: Weights) -> str:
    """The text of the best region, blocks joined by an empty line."""
    found = blocks(page)
    since, to = best_region(found, weights)
    return "\n\n".join(b.text for b in found[since:to] if not b.out)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column(0):
            found = blocks(page.as_py())
            if not any(b.inside for b in found):
                continue
            inside = [b.inside and not b.out for b in found]
            for b, yes, before in zip(found, inside, [False, *inside]):
                counts["w", b.context, yes] += len(b.text.split())
                for tag in b.tags:
                    counts["t", tag, yes and before] += 1
    keys = list(counts)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.bool_()), pa.array([counts[k] for k in keys], pa.int64())], ["kind", "name", "inside", "n"])


def fit(pages: DataFrame, max_pages: int = 2000, max_names: int = 1000) -> Weights:
    """Weights from at most max_pages pages that mark their article; the max_names most frequent contexts and tags."""
    marked = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    sample = hash_sample(marked.select("page_id", "html"), max_pages, "page_id").select("html")
    counted = sample.mapInArrow(_count, "kind string, name string, inside boolean, n long").groupBy("kind", "name").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("no"))
    rows = counted.orderBy(F.desc(F.col("yes") + F.col("no")), "kind", "name").limit(max_names).collect()
    words = {r["name"]: math.log((r["yes"] + 1) / (r["no"] + 1)) for r in rows if r["kind"] == "w"}
    tags = {r["name"]: min(-0.05, 0.5 * math.log((r["yes"] + 1) / (r["no"] + 1))) for r in rows if r["kind"] == "t"}
    clip = lambda x, most: max(-most, min(most, x))
    return Weights({k: clip(v, 2.0) for k, v in words.items()}, {k: clip(v, 1.0) for k, v in tags.items()})


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
