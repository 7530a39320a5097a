"""Main text of web pages by a maximum-scoring contiguous run of tokens.

A page is a sequence of words, tags and skipped elements. A word scores one, every tag its learned
weight, which is negative; one pass finds the contiguous run of the greatest sum, and the blocks
inside it are the text. Weights come from labelled pages, kept as data beside this module: how often
tags and the names in class, id and role lie in content, hold it, or lie outside. Elements whose
names and tag together speak against content are skipped with all they hold, unless they hold the
page's article: its article or main element of most words or, without one, the element that most
words are in. Inside the article tags cost little, so its lists and links stay.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm.shared import broadcast_value, small_batches

#: A comment, a tag or a declaration. As in browsers a quote mark opens a string only after an equals sign, and a tag
#: reaches to the first ">" outside such strings. Nothing is tried twice, so a page takes time in proportion to its length.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+)>|<[!?][^>]*+>", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z_:][-A-Za-z0-9_:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Letters of scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")
WHITE = re.compile(r"\s+")
#: Elements whose content is never text of the page.
RAW = frozenset("script style template noscript textarea title svg math iframe object canvas select".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand inside a line; all others begin and end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag of one of these ends an open paragraph, as browsers do.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

#: Labelled pages: content lies in elements marked data-content, except what is marked data-out.
LABELLED = tuple(x for x in (Path(__file__).parent / "labelled_pages.html").read_text(encoding="utf-8").split("<!-- page -->\n")[1:])
#: Summed log odds from which an element is skipped; single features count within these bounds.
SKIP_FROM, LEAST, MOST = 1.25, -2.0, 3.0
#: Share of the words outside boilerplate that the article of a page without article and main has at least.
ARTICLE_SHARE = 0.8
#: Score of a word outside an article or main element that has at least half of the words, and outside another article; a headline's words score one.
OUTSIDE_MARKED, OUTSIDE_OTHER = -0.3, 0.0
#: First parts of names that say what a page has or lacks.
HAVING = frozenset("has have with without no hide show is".split())


def names_of(attributes: str) -> Iterator[str]:
    """Names in class, id and role, in lower case, parts joined by one dash."""
    if not attributes:
        return
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for word in html.unescape(a or b or c).split():
                parts = re.findall(r"[^\W\d_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", word))
                if parts:
                    yield "-".join(parts).lower()


def parsed(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", words, ""), ("open", tag, attributes) and ("close", tag, "") in page order.

    Comments, declarations and the content of raw elements are left out; a raw element that isn't
    closed reaches to the end, as does a comment.
    """
    at, n = 0, len(page)
    last = page.rfind(">") + 1  # nothing after it is a whole tag
    while at < n:
        found = TOKEN.search(page, at, last) if at < last else None
        if found is None:
            rest = page[at:]
            cut = re.search(r"<(?:!--|[/!?A-Za-z][^<>]*\Z)", rest)  # a tag or comment that the page's end cuts off
            yield "text", rest[: cut.start()] if cut else rest, ""
            return
        if found.start() > at:
            yield "text", page[at : found.start()], ""
        at = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            return
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            yield "close", tag, ""
            continue
        if tag in ("svg", "math") and found[0].endswith("/>"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*+>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        yield "open", tag, found[3] or ""


#: Open elements beyond which a closing tag of an element inside a line, a paragraph or a list item doesn't look.
BOUNDS = ("table", "article", "body")


class _Open:
    """The stack of open elements, closed as browsers do in the common cases; a step takes the same time at any depth."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.places: dict[str, list[int]] = defaultdict(list)

    def opened(self, tag: str) -> None:
        if tag in ENDS_P:
            self._end("p", ("table", "td", "th", "button", "object"))
        elif tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
            peers = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            for p in peers:
                self._end(p, ("ul", "ol", "dl", "table"))
        if tag not in VOID:
            self.places[tag].append(len(self.tags))
            self.tags.append(tag)

    def _last(self, tag: str) -> int:
        """The place of the innermost open element of a tag, -1 without one."""
        held = self.places.get(tag)
        return held[-1] if held else -1

    def _end(self, tag: str, within: tuple[str, ...]) -> None:
        """Close the innermost element of a tag and what is in it, unless one of ``within`` is open inside it."""
        at = self._last(tag)
        if at >= 0 and all(self._last(w) < at for w in within):
            while len(self.tags) > at:
                self.places[self.tags.pop()].pop()

    def closed(self, tag: str) -> None:
        self._end(tag, BOUNDS if tag in INLINE or tag in ("p", "li") else ())


def _odds(outside: float, inside: float) -> float:
    return min(max(math.log((outside + 0.5) / (inside + 0.5)), LEAST), MOST)


@dataclass(frozen=True)
class Weights:
    """What labelled pages say: scores of tags, and how often names lie outside and inside content."""

    outer: dict[str, float]
    inner: dict[str, float]
    tags: dict[str, float]
    whole: dict[str, tuple[int, int]]
    part: dict[str, tuple[int, int]]
    other: float = -0.5

    def against(self, tag: str, names: Iterable[str]) -> float:
        """Log odds that an element isn't content.

        A name of several parts counts as a whole, if it is known, and by its parts, the last of which
        is what it names; a word alone counts as it does alone where that is known. Names that say what
        a page has or lacks (has-sidebar) count as a whole only.
        """
        out = self.tags.get(tag, 0.0)
        for name in set(names):
            parts = name.split("-")
            if len(parts) > 1 and name in self.whole:
                out += _odds(*self.whole[name])
            if parts[0] in HAVING and len(parts) > 1:
                continue
            for k, p in enumerate(parts):
                known, other = (self.whole, self.part) if len(parts) == 1 else (self.part, self.whole)
                own = _odds(*(known.get(p) or other.get(p) or (0, 0)))
                out += own if k == len(parts) - 1 else own / 2
        return out


def is_hidden(attributes: str) -> bool:
    """Whether an element's own attributes say that it isn't shown."""
    low = attributes.lower()
    if "hidden" not in low and "display" not in low:
        return False
    for name, a, b, c in ATTRIBUTE.findall(low):
        if name == "hidden" or name == "style" and re.search(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", html.unescape(a or b or c)):
            return True
    return False


class Page:
    """A parsed page as its events and the tree of its elements, in page order."""

    def __init__(self, page: str) -> None:
        self.events = list(parsed(page))
        self.tag, self.attributes, self.parent, self.words, self.hidden = ["html"], [""], [-1], [0.0], [False]
        self.holder: list[int] = []
        #: The element of each event: that a tag opens or closes, or that a text is in.
        stack, opened = _Open(), []
        for kind, what, attributes in self.events:
            if kind == "open":
                stack.opened(what)
                del opened[len(stack.tags) - (what not in VOID) :]
                self.tag.append(what)
                self.attributes.append(attributes)
                self.parent.append(opened[-1] if opened else 0)
                self.words.append(0.0)
                self.hidden.append(is_hidden(attributes))
                if what not in VOID:
                    opened.append(len(self.tag) - 1)
                self.holder.append(len(self.tag) - 1)
            elif kind == "close":
                inner = opened[-1] if opened else 0
                stack.closed(what)
                del opened[len(stack.tags) :]
                self.holder.append(inner)
            else:
                self.holder.append(opened[-1] if opened else 0)
                self.words[self.holder[-1]] += _words(html.unescape(what))

    def path(self, e: int) -> list[int]:
        """The element and all around it."""
        out = []
        while e >= 0:
            out.append(e)
            e = self.parent[e]
        return out


def learn(pages: Sequence[str] = LABELLED) -> Weights:
    """Weights from labelled pages. Elements around content count as inside for their names, not for their tags."""
    inside, outside, cut = Counter(), Counter(), Counter()
    whole, part = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for text in pages:
        page = Page(text)
        content = [False] * len(page.tag)
        out = [False] * len(page.tag)
        around: set[int] = set()
        for e in range(1, len(page.tag)):
            content[e] = "data-content" in page.attributes[e] or content[page.parent[e]]
            out[e] = "data-out" in page.attributes[e] or out[page.parent[e]]
            if "data-content" in page.attributes[e]:
                around.update(page.path(e)[1:])
        for e in range(1, len(page.tag)):
            good = content[e] and not out[e]
            if good:
                inside[page.tag[e]] += 1
            elif e not in around:
                outside[page.tag[e]] += 1
                cut[page.tag[e]] += out[e]
            for name in set(names_of(page.attributes[e])):
                parts = name.split("-")
                whole[name][good or e in around] += 1
                for p in parts if len(parts) > 1 and parts[0] not in HAVING else ():
                    part[p][good or e in around] += 1
    tags = set(inside) | set(outside)
    odds = {t: math.log((outside[t] + 0.5) / (inside[t] + 0.5)) for t in tags}
    outer = {t: -max(0.25, odds[t]) for t in tags}
    inner = {t: -max(0.05, (cut[t] + 0.5) / (cut[t] + inside[t] + 1) / 2) for t in tags}
    against = {t: min(x, MOST) for t, x in odds.items() if x > SKIP_FROM and not inside[t] and t not in INLINE and outside[t] > 1}
    against |= {t: MOST for t in ("nav", "footer", "aside", "form", "button", "head")} | {"header": SKIP_FROM + 0.1}
    held = lambda counts: {n: tuple(c) for n, c in counts.items()}
    return Weights(outer, inner, against, held(whole), held(part))


def _words(text: str) -> float:
    """Words of a text; two letters of a script without spaces count as one more."""
    return len(text.split()) + (0 if text.isascii() else len(UNSPACED.findall(text)) / 2)


def _skipped(page: Page, against: list[float], kept: set[int]) -> list[bool]:
    """Whether each element is boilerplate or not shown, or inside such; those of ``kept`` aren't boilerplate."""
    out = [False] * len(page.tag)
    for e in range(1, len(out)):
        out[e] = out[page.parent[e]] or page.hidden[e] or (against[e] > SKIP_FROM and e not in kept)
    return out


def _totals(page: Page, skipped: list[bool]) -> list[float]:
    """Words in each element and all it holds, without skipped ones."""
    out = [0.0 if s else w for w, s in zip(page.words, skipped)]
    for e in range(len(out) - 1, 0, -1):
        out[page.parent[e]] += out[e]
    return out


def article_of(page: Page, against: list[float]) -> tuple[int, set[int]]:
    """The element of the article, 0 if none stands out, and the elements that names don't speak against.

    These are the article, what it is in, and its first headline with all between the two.
    """
    marked = [e for e in range(1, len(page.tag)) if page.tag[e] in ("article", "main") or "main" in names_of(page.attributes[e]) and "role" in page.attributes[e]]
    plain = _totals(page, [False] * len(page.tag))
    # an article inside boilerplate, such as a reader's comment, is none; the page's wrappers say little
    under = [False] * len(page.tag)
    for e in range(1, len(page.tag)):
        a = page.parent[e]
        under[e] = under[a] or (against[a] > SKIP_FROM and plain[a] < ARTICLE_SHARE * plain[0])
    good = [e for e in marked if plain[e] and not under[e] and (against[e] <= SKIP_FROM or page.tag[e] == "main")]
    best = max(good, key=lambda e: (plain[e], e), default=0)
    if not best:
        total = _totals(page, _skipped(page, against, set()))
        if total[0] < plain[0] / 4:  # names have left out nearly all
            total = plain
        kids = defaultdict(list)
        for e in range(1, len(page.tag)):
            kids[page.parent[e]].append(e)
        at = 0
        while at is not None:
            best = at
            at = next((k for k in kids[at] if total[k] and total[k] >= ARTICLE_SHARE * total[0]), None)
        while best and page.tag[best] in INLINE | {"p", "h1", "h2"}:
            best = page.parent[best]
        if page.tag[best] in ("html", "body"):
            return 0, set(page.path(best))
    path = set(page.path(best))
    inside = [e == best for e in range(len(page.tag))]
    for e in range(1, len(page.tag)):
        inside[e] |= inside[page.parent[e]]
        if page.tag[e] == "h1" and inside[e]:
            path.update(page.path(e))
            break
    return best, path


def best_run(scores: Sequence[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of the greatest sum above 0, the first of equal ones; (0, 0) if there is none."""
    best, at, run, start, end = 0.0, 0, 0.0, 0, 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, at = 0.0, i
        run += score
        if run > best:
            best, start, end = run, at, i + 1
    return start, end


def blocks(text: str, weights: Weights) -> list[str]:
    """The blocks of the best run of a page, in order."""
    page = Page(text)
    against = [weights.against(t, names_of(a)) for t, a in zip(page.tag, page.attributes)]
    article, kept = article_of(page, against)
    skipped = _skipped(page, against, kept)
    total = _totals(page, skipped)
    if not total[0]:  # names speak against all that the page has, so they say nothing
        against = [weights.against(t, ()) for t in page.tag]
        article, kept = article_of(page, against)
        skipped = _skipped(page, against, kept)
        total = _totals(page, skipped)
    inside = [False] * len(page.tag)
    for e in range(len(page.tag)):
        inside[e] = e == article and e > 0 or e > 0 and inside[page.parent[e]]
    marked = page.tag[article] in ("article", "main")
    outside_word = 1.0 if not article or 2 * total[article] < total[0] else OUTSIDE_MARKED if marked else OUTSIDE_OTHER
    tokens: list[tuple[float, str | None]] = []  # (score, text); None ends a block
    for (kind, what, _), e in zip(page.events, page.holder):
        if skipped[e]:
            if kind == "open" and not skipped[page.parent[e]]:
                tokens.append((weights.other, None))
        elif kind == "text":
            plain = html.unescape(what)
            own = inside[e] or page.tag[e] == "h1" or page.tag[page.parent[e]] == "h1"
            tokens.append(((1.0 if own else outside_word) * _words(plain), plain))
        else:
            cost = (weights.inner if inside[e] else weights.outer).get(what, weights.other)
            tokens.append((cost, " " if what == "br" else "" if what in INLINE else None))
    start, end = best_run([score for score, _ in tokens])
    out, line = [], []
    for _, piece in [*tokens[start:end], (0.0, None)]:
        if piece is None:
            if joined := WHITE.sub(" ", "".join(line)).strip():
                out.append(joined)
            line = []
        else:
            line.append(piece)
    return out


def extracted(pages: DataFrame, labelled: Sequence[str] = LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html); blocks are joined by two line feeds.

    page_id is an integer. Null and empty html, and pages without words, give the empty text; pages of
    any length are taken whole. Repeated rows and null ids
    are kept one to one; other columns are ignored; an empty table stays empty.
    """
    small_batches(pages.sparkSession)
    held = broadcast_value(pages.sparkSession, learn(labelled))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(blocks(p, held.value)) if p else "" for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema=schema)

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(made, "page_id bigint, url string, text string")
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))
