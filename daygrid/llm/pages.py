"""Main text of web pages: the maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from html import unescape
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import per_row

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|object|svg|math|select|canvas)\b[^>]*+>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^\"'>]++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>"
    r"|<[!?/][^>]*+>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?"
)
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")

#: Elements of other matter, and containers of the main text, which count inside those too.
_DROPPED = {"nav", "footer", "aside", "button", "dialog", "menu", "head", "label", "header"}
_MAIN = {"article", "main"}
#: Words in class, id or role that speak against a container, and those that name sections too.
_OTHER = set(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer foot masthead topbar "
    "cookie cookies consent gdpr notice alert popup modal overlay dialog comment comments disqus "
    "reply replies respond discussion share sharing social follow related recommended recommendations "
    "newsletter subscribe subscription signup login search pagination pager widget toolbar "
    "complementary contentinfo header skip copyright disclaimer".split()
)
_AMBIGUOUS = set(
    "side foot notice alert dialog menu navigation banner promotion advertising comment reply respond "
    "discussion share sharing social follow related search subscription header skip".split()
)
#: Ambiguous words that also title a part of a text, and words that say nothing beside others.
_TOPICS = set(
    "side foot menu navigation discussion share sharing social follow search subscription header respond".split()
)
_FILLERS = set(
    "list lists thread threads form box area section bar wrap wrapper container holder block inner outer "
    "item items info panel unit slot row top bottom by google".split()
)
#: Clear words that stand together with a filler as one.
_COMPOUND = re.compile(
    r"(?:comment|disqus|sidebar|advert|sponsor|cookie|newsletter|breadcrumb|promo|ads)(?:%s|bygoogle)"
    % "|".join(sorted(_FILLERS, key=len, reverse=True))
)
_NAMED = set("article main content story post entry body".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr input picture source link meta base".split()
)
_INLINE_BOXES = {"ins", "span"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = set(
    "article main section div nav header footer aside form ul ol dl table tbody thead tfoot tr td th li "
    "dd dt figure figcaption blockquote pre details summary fieldset button dialog menu head body html "
    "center address hgroup label".split()
)
#: What an opening tag closes where end tags are left out, and up to where.
_CELLS, _ROWS = ("td", "th"), ("td", "th", "tr")
_SECTIONS = (*_ROWS, "thead", "tbody", "tfoot")
_CLOSES = {
    "td": (_CELLS, ("table", "tr")), "th": (_CELLS, ("table", "tr")), "tr": (_ROWS, ("table",)),
    "thead": (_SECTIONS, ("table",)), "tbody": (_SECTIONS, ("table",)), "tfoot": (_SECTIONS, ("table",)),
    "dt": (("dt", "dd"), ("dl", "table")), "dd": (("dt", "dd"), ("dl", "table")),
    "li": (("li",), ("ul", "ol", "menu", "table")),
}
_CLOSES_P = _CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "hr"}

#: Weights before any labelled page is seen, and how many tokens they count for.
PRIOR = {
    "w:p": 1.5, "w:h": 1.0, "w:li": 0.6, "w:td": 0.4, "w:pre": 1.0, "w:div": 0.5,
    "w:link": -0.6, "t:p": -0.2, "t:h": -0.3, "t:a": -0.6, "t:li": -0.4, "t:div": -0.8,
    "t:inline": -0.1, "t:other": -0.6,
}
PRIOR_TOKENS = 200
LIMIT = 3.0
#: Extra weight of words in and out of an element that the page itself marks as its main one.
IN_MAIN, OUT_OF_MAIN = 2.0, -4.0
#: Extra weight of words in a container whose name speaks against it, outside of a main element
#: and in one, and the share of the page's words beyond which the container is the page's own
#: layout and its name says nothing: for names of ambiguous words, names that hold a clear one,
#: names of such words alone, and forms.
NAMED_OTHER = {
    "weak": (-1.0, -2.5, 0.5), "part": (-3.5, -2.5, 0.5), "full": (-3.5, -5.5, 0.8), "form": (-3.5, -5.5, 0.5),
}


def _place(tag: str) -> str:
    if tag in ("p", "blockquote", "figcaption", "dd", "summary"):
        return "p"
    if tag[0] == "h" and tag[1:] in ("1", "2", "3", "4", "5", "6"):
        return "h"
    if tag in ("li", "dt"):
        return "li"
    return {"td": "td", "th": "td", "pre": "pre", "a": "a"}.get(tag, "div")


def _against(tag: str, attribute: str, part: str) -> str:
    """How a word group of a class, id or role speaks against an element: a key of NAMED_OTHER, or
    nothing. Groups of such words alone speak fully, unless they can also title a part of a text."""
    words = _WORD.findall(_CAMEL.sub(r"\1 \2", part).lower())
    if len(words) > 3:
        return ""
    compound = {w for w in words if _COMPOUND.fullmatch(w)}
    found = compound.union(_OTHER.intersection(words))
    if not found:
        return ""
    clear = attribute == "role" or bool(found - _AMBIGUOUS)
    topic = found <= _TOPICS and (attribute == "id" or tag == "section" or "header" in found)
    if found.union(_FILLERS).issuperset(words) and (clear or not topic):
        return "full"
    return "part" if clear else "weak"


def _role(tag: str, attributes: str) -> str:
    """What an element says of its text: 'h' hidden, 'm' main text, 'n' main text by its name
    only, 'x' other matter, a key of NAMED_OTHER if its name speaks against it, else ''."""
    if tag in ("body", "html"):
        return ""
    covered, named, other = False, False, ""
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name == "hidden" and value.lower() != "until-found" or name == "style" and _UNSEEN.search(value):
            return "h"
        covered = covered or name == "aria-hidden" and value.lower() == "true"
        if name not in ("class", "id", "role", "itemprop"):
            continue
        for part in value.split():
            words = _WORD.findall(_CAMEL.sub(r"\1 \2", part).lower())
            named = named or len(words) < 4 and not _NAMED.isdisjoint(words)
            if kind := _against(tag, name, part):
                other = min(other or kind, kind, key=("full", "part", "weak").index)
    if tag in _MAIN:
        return other if other == "full" and tag == "article" and not named else "m"
    if tag in _DROPPED or covered:
        return "x"
    if tag == "form":
        return "form"
    return other or ("n" if named else "")


class _Open:
    """Containers that are open, with their places; an opening or closing tag costs the entries
    that it closes, however deep they are nested."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.at: dict[str, list[int]] = {}

    def last(self, tags: tuple[str, ...]) -> int:
        return max((self.at[tag][-1] for tag in tags if self.at.get(tag)), default=-1)

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            self.at[self.stack.pop()[0]].pop()

    def close(self, tag: str) -> None:
        if (k := self.last((tag,))) >= 0:
            self.cut(k)

    def push(self, tag: str, make: Callable[[int], int]) -> None:
        """Opens ``tag`` at the place that ``make`` gives for the one around it."""
        closed, bounds = _CLOSES.get(tag, ((), ()))
        bound = self.last(bounds)
        while (k := self.last(closed)) > bound:
            self.cut(k)
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, make(self.place())))

    def place(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def inner(self) -> str:
        """The kind of text in the innermost block that is open."""
        return next((_place(tag) for tag, _ in reversed(self.stack) if tag not in _INLINE_BOXES), "div")


class _Places:
    """Kinds of places in a page; each is made from the one around it and an element's role."""

    def __init__(self):
        self.made: list[tuple[int, str, str]] = [(0, "", "")]
        #: How much other matter is around a place, and around the main element it is in.
        self.around, self.main_in = [0], [-1]

    def inside(self, outer: int, tag: str, role: str) -> int:
        if not role or role == "n" and self.main_in[outer] >= 0:
            return outer
        around, main_in = self.around[outer], self.main_in[outer]
        if role == "m":
            if main_in == around:
                return outer  # in a main element already, with nothing between
            main_in = around
        elif role in NAMED_OTHER:
            around += 1
        elif role == "h" or role == "x" and not (tag == "header" and main_in >= 0):
            around, main_in = around + 1_000_000, -1
        self.made.append((outer, tag, role))
        self.around.append(around)
        self.main_in.append(main_in)
        return len(self.made) - 1

    def resolve(self, words: Counter) -> list[tuple[int, tuple[int, str] | None]]:
        """(level, name that speaks against it) of every place, by the words in each.

        Main elements count where the least other matter is around them, so one in a wrapper of
        other matter counts if the page has none outside, and a teaser in a side column doesn't.
        """
        least = min((self.main_in[k] for k in words if self.main_in[k] >= 0), default=-1)
        out: list[tuple[int, int]] = [(0, 0)]
        for k, (outer, tag, role) in enumerate(self.made[1:], 1):
            level, name = out[outer]
            if role == "h" or level == -2:
                level, name = -2, 0
            elif role == "m" and self.around[k] == least:
                level, name = 2, 0
            elif role == "x" and not (tag == "header" and level == 2):
                level, name = -1, 0
            elif role == "n" and level == 0:
                level = 1
            elif role in NAMED_OTHER and level >= 0:
                name = k
            out.append((level, name))
        held = [0] * len(out)
        for k in range(len(out) - 1, -1, -1):
            held[k] += words[k]
            if k:
                held[self.made[k][0]] += held[k]
        total = sum(n for k, n in words.items() if out[k][0] >= 0)
        against: list[tuple[int, str] | None] = [None]
        for k, (outer, _, role) in enumerate(self.made[1:], 1):
            level, name = out[k]
            before = against[outer] if name else None
            if name == k and held[k] <= NAMED_OTHER[role][2] * total:
                column = 1 if level == 2 else 0
                if before is None or NAMED_OTHER[role][column] < NAMED_OTHER[before[1]][column]:
                    before = (k, role)
            against.append(before)
        return [(max(level, -1), a) for (level, _), a in zip(out, against, strict=True)]


def tokens(html: str) -> list[tuple]:
    """The page in order: ('w', type, text, level, block, name) or ('t', type, level, name).

    ``level`` is -1 in other matter, 2 in an element of main text, 1 in one named so, else 0.
    ``name`` is None, or number and kind of the container around whose name speaks against it.
    """
    out: list[tuple] = []
    places = _Places()
    opened = _Open()
    here, inner, links, block = 0, "div", 0, 0

    at = 0
    for found in _MARKUP.finditer(html):
        if found.start() > at:
            text = html[at : found.start()]
            if text.strip():
                kind = "w:link" if links else f"w:{inner}"
                out.append(("w", kind, text, here, block))
            elif out:
                out.append(("w", "", " ", here, block))
        at = found.end()
        name = found[3]
        if not name:
            continue
        tag, closing = name.lower(), bool(found[2])
        if tag == "br":
            out.append(("w", "", " ", here, block))
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        place = _place(tag)
        kind = {"a": "t:a", "p": "t:p", "h": "t:h", "li": "t:li"}.get(place, "t:div")
        kind = "t:inline" if tag in _INLINE and tag != "a" else kind
        if tag not in _INLINE:
            block += 1
            inner = "div" if closing else place
            links = 0 if tag in _CLOSES_P else links
        if tag in _INLINE_BOXES:  # held open for its name, but no block of its own
            if closing:
                opened.close(tag)
            else:
                role = _role(tag, found[4])
                role = role if role in ("full", "h", "x") else ""
                opened.push(tag, lambda outer, tag=tag, role=role: places.inside(outer, tag, role))
            here = opened.place()
        elif tag in _CONTAINERS:
            if closing:
                opened.close(tag)
                inner = opened.inner()
            else:
                role = _role(tag, found[4])
                opened.push(tag, lambda outer, tag=tag, role=role: places.inside(outer, tag, role))
            here = opened.place()
        elif tag not in _INLINE:
            here = opened.place()
            if not closing and tag not in _VOID:  # a paragraph's role holds until the next block
                role = _role(tag, found[4])
                here = places.inside(here, tag, role) if role != "n" else here
        out.append(("t", kind, here))
    if at < len(html) and html[at:].strip():
        out.append(("w", "w:link" if links else f"w:{inner}", html[at:], here, block))
    words: Counter = Counter()
    for token in out:
        if token[0] == "w" and token[1]:
            words[token[3]] += len(token[2].split())
    final = places.resolve(words)
    return [
        (*t[:3], final[t[3]][0], t[4], final[t[3]][1]) if t[0] == "w" else (*t[:2], *final[t[2]]) for t in out
    ]


def labelled_counts(html: str | None) -> Counter:
    """(type, in main text) counts of a page that marks its main element; empty for others.

    Other matter that names itself as such teaches nothing.
    """
    page = tokens(html or "")
    counts: Counter = Counter()
    if any(token[3 if token[0] == "w" else 2] == 2 for token in page):
        for token in page:
            if token[-1] is not None:
                continue
            if token[0] == "w" and token[1] and token[3] >= 0:
                counts[token[1], token[3] == 2] += len(token[2].split())
            elif token[0] == "t" and token[2] >= 0:
                counts[token[1], token[2] == 2] += 1
    return counts


def fit_weights(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weight of every token type by its log-odds within the main text of labelled pages.

    Labelled pages are those that mark their main element. Counts of a fixed set of types are
    summed over all pages; PRIOR stands in where few or no labelled pages are there.
    """

    def make(batch):
        total: Counter = Counter()
        for html in batch.column(0).to_pylist():
            total.update(labelled_counts(html))
        return {
            "type": [t for t, _ in total],
            "inside": [i for _, i in total],
            "n": list(total.values()),
        }

    counted = per_row(
        pages.select(F.col(html_col).alias("html")), "type string, inside boolean, n long", make
    )
    sums = {
        (row["type"], row["inside"]): row["n"]
        for row in counted.groupBy("type", "inside").agg(F.sum("n").alias("n")).collect()
    }
    weights = {}
    for kind, prior in PRIOR.items():
        inside, outside = sums.get((kind, True), 0), sums.get((kind, False), 0)
        seen = inside + outside
        learned = max(-LIMIT, min(LIMIT, log((inside + 1) / (outside + 1))))
        if kind[0] == "t":
            learned = min(learned, 0.0) - 0.1  # tags stay negative
        weights[kind] = (seen * learned + PRIOR_TOKENS * prior) / (seen + PRIOR_TOKENS)
    weights["w:p"] = max(weights["w:p"], 0.5)
    return weights


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """Blocks of the best contiguous region, joined by line breaks.

    Names that speak against a container are weights among others: its own words and tags are
    left out if they score nothing with it. If nothing else scores, names don't count.
    """
    page = tokens(html or "")
    left_out = {token[-1] for token in page if token[-1] is not None}
    if left_out:
        totals: Counter = Counter()
        for token in page:
            level = token[3 if token[0] == "w" else 2]
            if token[-1] is not None and level >= 0 and token[1]:
                totals[token[-1]] += _weight(token, level, 2 if level == 2 else 0, weights, True)
        left_out = {name for name in left_out if totals[name] <= 0}
    text = _best_region(page, weights, left_out, True)
    return text if text or not left_out else _best_region(page, weights, set(), False)


def _weight(token: tuple, level: int, best_level: int, weights: dict[str, float], names: bool) -> float:
    word = token[0] == "w"
    weight = weights.get(token[1], -0.3)
    named = token[-1] if names else None
    if best_level == 2:
        weight = weight + IN_MAIN if level == 2 and word else weight + OUT_OF_MAIN * word
        if named is None:
            weight = max(weight, 0.5) if level == 2 and word else weight
        weight = max(weight, -0.2) if level == 2 and not word else weight
    if word:
        if named is not None:
            weight += NAMED_OTHER[named[1]][1 if level == 2 else 0]
        weight *= len(token[2].split())
    return weight


def _best_region(page: list[tuple], weights: dict[str, float], left_out: set, names: bool) -> str:
    levels = {token[3] for token in page if token[0] == "w" and token[1]}
    best_level = 2 if 2 in levels else 0
    best, best_from, best_to = 0.0, 0, 0
    score, begin = 0.0, 0
    for k, token in enumerate(page):
        word = token[0] == "w"
        if word and not token[1]:
            continue
        level = token[3] if word else token[2]
        if level < 0 or token[-1] in left_out:
            continue  # other matter is left out below and neither joins nor parts a region
        # What a main element holds and isn't left out is a part of it like any other.
        weight = _weight(token, level, best_level, weights, names and level != 2)
        if score <= 0:
            score, begin = 0.0, k
        score += weight
        if score > best:
            best, best_from, best_to = score, begin, k + 1
    blocks: list[str] = []
    parts: list[str] = []
    last = None
    for token in page[best_from:best_to]:
        if token[0] != "w" or token[3] < 0 or token[-1] in left_out:
            continue
        if token[4] != last:
            blocks.append("".join(parts))
            parts, last = [], token[4]
        parts.append(token[2])
    blocks.append("".join(parts))
    cleaned = (" ".join(unescape(b).split()) for b in blocks)
    return "\n".join(b for b in cleaned if b)


def extract(
    pages: DataFrame, weights: dict[str, float], id_col="page_id", url_col="url", html_col="html"
) -> DataFrame:
    """page_id, url, text, n_chars for every row; null or empty html and pages without words
    give an empty text. Rows that repeat are extracted each, a null page_id stays null, and of
    equally good regions the first is taken. An empty table gives an empty result. Whole pages are
    read, columns other than the three named ones are not."""

    def make(batch):
        texts = [main_text(h, weights) for h in batch.column(2).to_pylist()]
        return {
            "page_id": batch.column(0),
            "url": batch.column(1),
            "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    return per_row(source, "page_id long, url string, text string, n_chars long", make)
