"""HTML extraction by tag-path ratios.

A page becomes a sequence of blocks, each with its root-to-leaf path of tags. Per path, the text
outside of links, the punctuation and the link text of all its blocks are summed and divided by
the number of blocks: paths of running text have long, punctuated blocks, paths of menus short
ones. The ratios are smoothed over the sequence of blocks and fused into one weight, and paths
whose weight exceeds a share of the page's spread are content. All of it is the answer, and with it
the headings and short paragraphs in the smallest element around all of it, or in an <article> or
<main> that holds nine tenths of it. In an <article> or <main> lists of links come too (sources,
say); around other elements they don't, for they may be menus. A page that has no text outside of
links gives what its <article> or <main> holds.

What a page says about its own elements is one more factor of a path's weight, not a verdict:
navigation, footers, asides and elements whose class, id or role speaks of menus, adverts,
comments and the like count ``STRONG`` of their ratio, words that may mean less ``WEAK``. So a
page that is one large "notice" still gives its text, and a long section called so may stand.
Only what isn't text to be read never competes: scripts, styles, forms, hidden elements.

A block ends where a block-level element begins or ends; a line break inside is white space.
Character references are decoded. Unclosed paragraphs and list items close as HTML says; an
unclosed comment, script or tag runs to the end. A null page is empty; pages are independent
rows, so order, ties and repeats don't matter, and nothing is dropped or capped by length.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from math import exp, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspan.llm.common import parts

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|math|object|textarea|select|title)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span strike strong sub sup time tt u var label br wbr img".split())
#: Elements that hold nothing to read, and those that say they are beside the matter.
_OUT = frozenset("form button dialog menu head input fieldset".split())
_BESIDE = frozenset("nav aside footer".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words in the name of a class or id, as separated by anything but letters: one of the first is
#: enough, of the second all words of a name must be.
_SAYS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus pagination pager toolbar widget widgets".split()
)
_MAY_SAY = frozenset("banner menu header notice notices alert respond reply replies share sharing social related recommended skip copyright login search".split())
#: What paths of such elements count of their ratio, and the least share of the best path's weight that content has.
STRONG, WEAK, LEAST = 0.01, 0.3, 0.1
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr figcaption caption address".split())
_ROOTS = frozenset("html body main article".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOP = re.compile(r"[.,;:!?…。，；：！？]")
_SPACE = re.compile(r"\s+")


def _factor(name: str, attrs: str, inside: bool) -> float:
    """What the element's text counts, by what the element says of itself; 0: it is not text to be read."""
    if name in _ROOTS:
        return 1
    if name in _OUT:
        return 0
    out = STRONG if name in _BESIDE or name == "header" and not inside else 1
    for m in _ATTR.finditer(attrs) if attrs.strip() else ():
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 0
        if key == "role" and value in _ROLES:
            out = STRONG
        for called in value.split() if key in ("class", "id") else ():
            said = [w for w in re.split(r"[^a-z]+", called) if w]
            if _SAYS.intersection(said):
                out = STRONG
            elif said and _MAY_SAY.issuperset(said):
                out = min(out, WEAK)
    return out


class _Block:
    __slots__ = ("path", "chain", "parts", "linked")

    def __init__(self, path: tuple[str, float], chain: tuple[int, ...]):
        self.path, self.chain, self.parts, self.linked = path, chain, [], 0


def blocks(page: str) -> list[_Block]:
    """The blocks of a page in order; ``path``: tags and what they count, ``chain``: its elements' numbers."""
    out: list[_Block] = []
    stack: list[list] = []  # name, number, factor
    now, links, drop, count = None, 0, 0, 0

    def pop():
        nonlocal links, drop, now
        name, _, factor = stack.pop()
        drop -= factor == 0
        links -= name == "a"
        if name not in _INLINE:
            now = None

    def close(names, stop):
        """Close the nearest open element of these names, unless one of ``stop`` is nearer."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in stop:
                return

    def text(raw: str):
        nonlocal now
        if not raw or drop:
            return
        if now is None:
            if raw.isspace():
                return
            held = [x for x in stack if x[0] not in _INLINE]
            now = _Block(("/".join(x[0] for x in held), min((x[2] for x in stack), default=1)), tuple(x[1] for x in held))
            out.append(now)
        said = html.unescape(raw)
        now.parts.append(said)
        if links:
            now.linked += len(said)

    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at : m.start()])
        at, name = m.end(), (m[3] or "").lower()
        if not name:
            if m[1] and m[1].lower() not in ("svg", "math", "object", "script", "style"):
                now = None
            continue
        if m[2]:
            if name == "br":
                text(" ")
            elif name == "p" or name not in _VOID:
                close((name,), ("table", "td", "th") if name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "html", "body", "article", "main", "div", "section") else ())
            continue
        if name == "br":
            text(" ")
            continue
        if name not in _INLINE:
            now = None
            if name in _CLOSES_P:
                close(("p",), ("table", "td", "th", "button", "article", "div", "section", "li", "body"))
            if name in _SELF:
                close(_SELF[name], ("ul", "ol", "dl", "table", "body"))
            while stack and stack[-1][0] in _INLINE and stack[-1][0] != "a":  # formatting doesn't hold blocks
                pop()
        if name in _VOID or m[4].endswith("/") and name in _INLINE:
            continue
        count += 1
        factor = _factor(name, m[4], any(x[0] in ("article", "main") for x in stack))
        stack.append([name, count, factor])
        drop += factor == 0
        links += name == "a"
        if factor < 1:
            now = None
    text(page[at:])
    return out


def path_weights(found: list[tuple[_Block, str]]) -> dict[tuple[str, float], float]:
    """The fused weight of each path: its smoothed text and punctuation ratios, its share of text outside of links, and its factor."""
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for b, said in found:
        s, linked = sums[b.path], min(b.linked, len(said))
        for k, v in enumerate((1, len(said) - linked, len(_STOP.findall(said)), linked)):
            s[k] += v
    own = {p: (plain / n) * (1 + stops / n) * (plain / max(1, plain + linked)) if plain >= linked else 0.0 for p, (n, plain, stops, linked) in sums.items()}
    raw = [own[b.path] for b, _ in found]
    kernel = [exp(-(k * k) / 2) for k in range(-2, 3)]
    smooth = defaultdict(list)
    for i, (b, _) in enumerate(found):
        near = [(raw[j], kernel[j - i + 2]) for j in range(max(0, i - 2), min(len(raw), i + 3))]
        smooth[b.path].append(sum(x * w for x, w in near) / sum(w for _, w in near))
    # the larger of a path's own ratio and what its surroundings give it
    return {p: p[1] * sqrt(w * max(w, sum(smooth[p]) / len(smooth[p]))) for p, w in own.items()}


def _said_to_be(found: list[tuple[_Block, str]]) -> list[tuple[_Block, str]]:
    """The blocks of the largest <article>, or <main> if there is none, but for what says it is something else."""
    held, named = defaultdict(int), {}
    for b, said in found:
        for e, name in zip(b.chain, b.path[0].split("/"), strict=False):
            if name in ("article", "main") and b.path[1] == 1:
                held[e] += len(said)
                named[e] = name
    home = max(held, key=lambda e: (named[e] == "article", held[e], -e), default=None)
    return [(b, said) for b, said in found if home in b.chain and b.path[1] == 1]


def main_text(page: str | None) -> str:
    """The main text of one page; empty if there is none."""
    found = []
    for b in blocks(page or ""):
        said = _SPACE.sub(" ", "".join(b.parts)).strip()
        if said:
            found.append((b, said))
    if not found:
        return ""
    fused = path_weights(found)
    weights, most = [fused[b.path] for b, _ in found], max(fused.values())
    mean = sum(weights) / len(weights)
    spread = sqrt(sum((w - mean) ** 2 for w in weights) / len(weights))
    bar = max(min(spread, 0.5 * most), LEAST * most)
    chosen = [(b, said) for b, said in found if fused[b.path] >= bar > 0]
    if not chosen:  # nothing but links: an element that says it is the article is believed
        chosen = _said_to_be(found)
    if not chosen:
        return ""
    whole = sum(len(said) for _, said in chosen)
    inside, held, named, depth = defaultdict(int), defaultdict(int), {}, {}
    for b, said in chosen:
        for d, (e, name) in enumerate(zip(b.chain, b.path[0].split("/"), strict=False)):
            inside[e] += len(said)
            held[e] += 1
            named[e], depth[e] = name, d
    # what may be added stands in the innermost element around all that is chosen, or in an
    # element that says it is the article and holds nine tenths of it
    around = [e for e, n in inside.items() if named[e] not in _LEAVES and (held[e] == len(chosen) or named[e] in ("article", "main") and n >= 0.9 * whole)]
    home = max(around, key=lambda e: (named[e] == "article", named[e] == "main", depth[e], -e), default=None)
    taken = {id(b) for b, _ in chosen}
    # lists of links belong to an element that says it is the article (its sources, say); around
    # anything else they may be menus and stay out, and so does what says it is something else
    sure = named.get(home) in ("article", "main")
    return "\n".join(said for b, said in found if id(b) in taken or home in b.chain and b.path[1] == 1 and (sure or b.linked < max(1, len(said) / 2)))


def extract(pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``'s columns, text and n_chars (code points) of every page."""
    rows = pages.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(page).alias("_page"))
    kinds = ", ".join(f"_{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(keep)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p) for part in parts(b) for p in part.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*b.schema.names[:-1], "text", "n_chars"])

    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long").toDF(*keep, "text", "n_chars")


def op7(pages: DataFrame) -> DataFrame:
    return extract(pages)
