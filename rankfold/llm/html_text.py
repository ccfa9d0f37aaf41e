"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into flat blocks at block-level tags. A block is described by its
word count and link density, those of the blocks before and behind it, and
what encloses it. Names such as "sidebar" describe what is inside an element,
except on html, body, main, article and the wrapper of a page's text (see
``settled``), whose names tell of the page's layout. A decision tree says which
blocks belong to the article. It is grown here on a small labelled table: the pages
of ``LABELLED``, and pages built by rule: some with an article element, whose blocks are
of any size (``tagged_pages``, ``twins``), and some that have neither telling tags nor names, where
word counts and link densities of a block and its neighbours have to decide (``plain_pages``).

Null and empty pages give the empty text. Markup may be broken: an end tag
without a start is ignored, an unclosed one ends with its parent, an unclosed
script, style, textarea, title or comment takes the rest of the page; of other
elements without text of the page, an unclosed one hides nothing. Pages are read whole, whatever
their length. Repeated rows give repeated rows; a null page_id is passed
through.
"""

from __future__ import annotations

import html
import random
import re

from pyspark.sql import DataFrame

from rankfold.llm.common import map_batches, text_rows

# Elements that hold no text of the page, blocks, and elements without an end tag (fixed HTML values).
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select button title".split())
TO_THE_END = frozenset("script style textarea title".split())  # also when unclosed
FOREIGN = frozenset("svg math".split())  # may close themselves
UNNESTED = frozenset("iframe canvas audio video select button".split())  # a second start means that the first is unclosed
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset head".split())

HINT = re.compile(
    r"(?:^|[\W_])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|menu|nav(?:bar|igation)?|sidebar|widget|cookies?|consent|gdpr|"
    r"notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|"
    r"breadcrumbs?|comments?|disqus|repl(?:y|ies)|respond|toolbar|pagination|pager|skip|hidden|complementary|search)(?:$|[\W_])", re.I)
EDGE_HINT = re.compile(r"(?:^|[\W_])(?:header|footer|masthead|topbar|copyright|colophon|contentinfo)(?:$|[\W_])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*>?|(?P<text>[^<]+|<)", re.S | re.I)
RAW_ENDS = {tag: re.compile(rf"<{'/?' if tag in UNNESTED else '/'}{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b|(display\s*:\s*none)", re.I)

IN_BOILERPLATE, HINTED, IN_ARTICLE, HEADING = 1, 2, 4, 8


LAYOUT = frozenset("html body main article".split())  # their names tell of the page


def hinted(flags: int, tag: str, names: str) -> bool:
    """Whether an element with these flags inside is named as something beside the article."""
    return bool(names) and tag not in LAYOUT and bool(HINT.search(names) or not flags & IN_ARTICLE and EDGE_HINT.search(names))


def enter(flags: int, tag: str) -> int:
    """Flags inside an element, from those outside it; HINTED isn't among them."""
    if tag in ("article", "main"):
        flags = IN_ARTICLE  # an article is its own place, also where something before it was left open
    if tag in BOILERPLATE or tag == "header" and not flags & IN_ARTICLE:
        flags |= IN_BOILERPLATE
    if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
        flags |= HEADING
    return flags


def tokens(page: str):
    """Matches of TOKEN, without elements that hold no text of the page."""
    at, unclosed = 0, set()
    while m := TOKEN.match(page, at):
        at = m.end()
        tag = m["tag"] and m["tag"].lower()
        if tag not in RAW or m["end"]:
            yield m
        elif tag not in unclosed and not (tag in FOREIGN and m["attrs"].endswith("/")):
            stop = RAW_ENDS[tag].search(page, at)
            if stop and stop[0][1] == "/":
                at = stop.end()
            elif tag in TO_THE_END:
                at = len(page)
            elif not stop:
                unclosed.add(tag)


def settled(found: list[tuple], outer: list[int]) -> list[tuple[str, int, int, int]]:
    """Blocks with flags, of (text, words, linked words, flags, innermost hinted element or -1, top heading).

    ``outer`` has the hinted element (or -1) around each hinted element. A hinted element is the wrapper of the
    page's text, and its hint is none, if no unhinted article and no unhinted top heading stands outside it, and
    it holds either a top heading and more unlinked words than all that is neither hinted nor boilerplate outside
    it, or most unlinked words of the page in three blocks or more.
    """
    total = plain = places = 0
    inside = [[0, 0, 0] for _ in outer]  # unlinked words, blocks, top headings
    for _, words, linked, flags, hint, top in found:
        total += words - linked
        if hint >= 0:
            inside[hint] = [x + y for x, y in zip(inside[hint], (words - linked, 1, top))]
        elif not flags & IN_BOILERPLATE:
            plain += words - linked
            places += bool(flags & IN_ARTICLE or top)
    for e in range(len(outer) - 1, -1, -1):  # inner ones have larger numbers
        if outer[e] >= 0:
            inside[outer[e]] = [x + y for x, y in zip(inside[outer[e]], inside[e])]
    holds: list[bool] = []  # whether a hint holds in it
    for (words, n, tops), o in zip(inside, outer):
        wrapper = not places and (tops and words > plain or n >= 3 and 2 * words > total)
        holds.append(not wrapper or o >= 0 and holds[o])
    return [(text, words, linked, flags | (HINTED if hint >= 0 and holds[hint] else 0)) for text, words, linked, flags, hint, _ in found]


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """The flat blocks of a page with text: (text, words, linked words, flags)."""
    out: list[tuple] = []
    stack: list[tuple[str, int, int]] = []
    flags, linked, parts, link_parts = 0, False, [], []
    hint, top = -1, False
    outer: list[int] = []

    def flush() -> None:
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                out.append((" ".join(words), len(words), len(html.unescape(" ".join(link_parts)).split()), flags, hint, top))
            parts.clear()
            link_parts.clear()

    for m in tokens(page):
        text = m["text"]
        if text is not None:
            parts.append(text)
            if linked:
                link_parts.append(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            linked = not m["end"]
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            linked = False
            if m["end"]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        flags, hint = stack[i][1:]
                        del stack[i:]
                        break
            elif tag not in VOID:
                if stack and stack[-1][0] == tag and tag in ("p", "li", "td", "th", "tr", "dt", "dd"):
                    flags, hint = stack.pop()[1:]
                elif stack and stack[-1][0] == "p":
                    flags, hint = stack.pop()[1:]
                stack.append((tag, flags, hint))
                names = " ".join(x for g in NAMES.findall(m["attrs"]) for x in g if x) if m["attrs"] else ""
                flags = enter(flags, tag)
                if tag in ("article", "main"):
                    hint = -1
                if hinted(flags, tag, names):
                    outer.append(hint)
                    hint = len(outer) - 1
            top = tag == "h1" and not m["end"]
    flush()
    return settled(out, outer)


def features(found: list[tuple[str, int, int, int]]) -> list[tuple[float, ...]]:
    """Word count and link density of each block and its neighbours, and its four flags."""
    size = [(w, min(1.0, k / w)) for _, w, k, _ in found]
    around = [(0, 0.0), *size, (0, 0.0)]
    return [(*around[i + 1], *around[i], *around[i + 2], *(float(f & b > 0) for b in (1, 2, 4, 8)))
            for i, (*_, f) in enumerate(found)]


#: Labelled pages: (enclosing elements as tag.name, words, linked words, belongs to the article).
LABELLED = (
    (("nav li", 1, 1, 0), ("nav li", 1, 1, 0), ("nav li", 2, 2, 0), ("div.ad", 9, 0, 0), ("article h1", 8, 0, 1),
     ("article p", 60, 0, 1), ("article p", 2, 0, 1), ("article p", 1, 0, 1), ("article p", 45, 3, 1), ("footer", 14, 0, 0)),
    (("header", 5, 0, 0), ("nav li", 1, 1, 0), ("nav li", 1, 1, 0), ("article h1", 5, 0, 1), ("article p", 1, 0, 1),
     ("article li", 4, 4, 1), ("article li", 12, 0, 1), ("article div.ad", 12, 0, 0), ("article p", 33, 0, 1),
     ("article aside", 25, 0, 0), ("article div.share", 3, 3, 0), ("div.comments p", 30, 0, 0), ("footer p", 20, 2, 0)),
    (("div.header", 4, 0, 0), ("div.menu li", 1, 1, 0), ("div.menu li", 1, 1, 0), ("div.content h1", 6, 0, 1),
     ("div.content p", 70, 2, 1), ("div.content p", 50, 0, 1), ("div.content p", 4, 0, 1), ("div.content p", 40, 0, 1),
     ("div.sidebar p", 22, 0, 0), ("div.sidebar li", 3, 3, 0), ("div.footer", 18, 4, 0)),
    (("div.cookie-notice", 30, 2, 0), ("form", 6, 0, 0), ("div a-list li", 2, 2, 0), ("div a-list li", 3, 3, 0),
     ("section h2", 7, 0, 1), ("section p", 55, 1, 1), ("section p", 3, 0, 1), ("section p", 38, 0, 1),
     ("section p", 5, 5, 0), ("section p", 4, 4, 0), ("aside p", 50, 0, 0), ("footer", 9, 1, 0)),
    (("header p", 12, 0, 0), ("main h1", 4, 0, 1), ("main p", 26, 0, 1), ("main blockquote", 11, 0, 1), ("main td", 2, 0, 1),
     ("main td", 1, 0, 1), ("main p", 80, 10, 1), ("main section.comments p", 45, 0, 0), ("main div.related li", 6, 6, 0),
     ("main form", 8, 0, 0), ("footer", 40, 0, 0)),
    (("nav", 6, 6, 0), ("div.banner", 40, 0, 0), ("article h1", 9, 0, 1), ("article h2", 3, 0, 1), ("article p", 120, 0, 1),
     ("article nav li", 2, 2, 0), ("article p", 6, 6, 1), ("article footer", 10, 0, 0), ("div", 2, 0, 0), ("div", 3, 3, 0)),
    (("div", 1, 1, 0), ("div", 1, 1, 0), ("div", 2, 0, 0), ("div h1", 6, 0, 1), ("div", 90, 0, 1), ("div", 12, 0, 1),
     ("div", 64, 4, 1), ("div", 2, 2, 0), ("div", 5, 5, 0), ("div.newsletter", 20, 0, 0), ("div.copyright", 6, 0, 0)),
    (("article p", 1, 0, 1), ("footer", 12, 0, 0)),
    (("article h1", 1, 0, 1), ("article p", 1, 0, 1), ("article p", 2, 0, 1), ("article p", 1, 1, 1)),
    (("nav li", 1, 1, 0), ("div.ad", 3, 0, 0), ("article h1", 1, 0, 1), ("article p", 3, 0, 1), ("footer", 4, 0, 0)),
    (("div.ad", 60, 0, 0), ("div.ad p", 1, 0, 0), ("aside", 90, 0, 0), ("footer p", 100, 0, 0), ("nav li", 12, 0, 0)),
    (("p", 70, 0, 1), ("p", 30, 0, 1), ("p", 2, 0, 1), ("p", 44, 1, 1)),
    (("body.no-sidebar.comments-open nav li", 1, 1, 0), ("body.no-sidebar.comments-open div.content h1", 5, 0, 1),
     ("body.no-sidebar.comments-open div.content p", 62, 0, 1), ("body.no-sidebar.comments-open div.content p", 3, 0, 1),
     ("body.no-sidebar.comments-open div.comments p", 35, 0, 0), ("body.no-sidebar.comments-open footer", 9, 1, 0)),
    (("nav li", 2, 2, 0), ("article.has-sidebar h1", 6, 0, 1), ("article.has-sidebar p", 51, 2, 1),
     ("article.has-sidebar p", 4, 0, 1), ("article.has-sidebar div.sidebar p", 21, 0, 0), ("footer p", 15, 0, 0)),
    (("main.search-results h1", 3, 0, 1), ("main.search-results p", 48, 1, 1), ("main.search-results p", 30, 0, 1),
     ("main.search-results div.related li", 4, 4, 0), ("footer", 11, 0, 0)),
    (("div.menu li", 1, 1, 0), ("div.has-sidebar h1", 7, 0, 1), ("div.has-sidebar p", 58, 0, 1), ("div.has-sidebar p", 2, 0, 1),
     ("div.has-sidebar div.sidebar p", 24, 0, 0), ("div.comments p", 40, 0, 0), ("div.footer", 12, 2, 0)),
)


PLAIN_SEED, PLAIN_PAGES = 8, 240


def plain_pages(seed: int = PLAIN_SEED, n: int = PLAIN_PAGES, named: bool = False) -> list[tuple]:
    """Labelled pages of divs, paragraphs and headings, in the form of ``LABELLED``: masthead, menu, notice, article, links, imprint;
    with ``named``, some have parts whose names tell beside the article."""
    rng, pages = random.Random(seed), []
    for _ in range(n):
        page = []
        if named and rng.random() < 0.5:
            page.append((rng.choice(("div.cookie-notice", "div.comments p", "div.header h1")), rng.randrange(1, 320), 0, 0))
        if not named or rng.random() < 0.3:
            if rng.random() < 0.5:
                page.append(("div", w := rng.randrange(1, 5), w if rng.random() < 0.5 else 0, 0))
            for _ in range(rng.randrange(3, 9)):
                page.append(("div", w := rng.randrange(1, 4), w, 0))
        if not named and rng.random() < 0.4:  # a notice or advert under the menu
            page.append(("div", w := rng.randrange(5, 16), rng.choice((0, 0, w // 2)), 0))
            page.append(("div", w := rng.randrange(1, 4), w, 0))
        if rng.random() < 0.8:
            page.append(("div h1", rng.randrange(3, 13), 0, 1))
        else:
            page.append(("div p", rng.randrange(20, 90), 0, 1))
        for k in range(rng.randrange(2, 7)):
            page.append(("div p", w := rng.choice((rng.randrange(18, 130), rng.randrange(18, 130), rng.randrange(18, 1000))), rng.choice((0, 0, w // 12)), 1))
            if rng.random() < 0.3:
                page.append(("div h2", rng.randrange(2, 8), 0, 1))
                page.append(("div p", w := rng.randrange(18, 130), 0, 1))
            elif rng.random() < 0.3:  # short paragraphs between long ones
                for _ in range(rng.randrange(1, 3)):
                    page.append(("div p", rng.randrange(1, 11), 0, 1))
                page.append(("div p", rng.randrange(18, 90), 0, 1))
        if named:
            if rng.random() < 0.4:
                page.append(("div p", rng.randrange(1, 11), 0, 1))
            if rng.random() < 0.7:
                part = rng.choice(("div.comments p", "div.cookie-notice", "div.sidebar p"))
                page += [(part, rng.randrange(1, 320), 0, 0) for _ in range(rng.randrange(1, 9))]
            pages.append(tuple(page))
            continue
        for _ in range(rng.randrange(2, 7)):
            page.append(("div", w := rng.randrange(2, 9), w, 0))
        if rng.random() < 0.7:
            page.append(("div", w := rng.randrange(4, 15), rng.choice((0, w // 3)), 0))
        pages.append(tuple(page))
    return pages


def tagged_pages(seed: int = PLAIN_SEED, n: int = PLAIN_PAGES) -> list[tuple]:
    """Labelled pages with an article of their own, whose blocks are of any size and density; so are those around it."""
    rng, pages = random.Random(seed + 1), []
    for _ in range(n):
        def block(path, label):
            words = rng.choice((rng.randrange(1, 9), rng.randrange(1, 130), rng.randrange(1, 130), rng.randrange(1, 10 ** rng.randrange(1, 7))))
            page.append((path, words, rng.choice((0, 0, 0, words, words // 3)), label))

        page: list[tuple] = []
        root = rng.choice(("article", "article", "main", "article.post", "main div.content"))
        for path in rng.sample(("nav li", "nav li", "header", "div.menu li", "div.ad", "div.cookie-notice", "form", "aside p"), rng.randrange(0, 6)):
            block(path, 0)
        if rng.random() < 0.8:
            block(f"{root} h1", 1)
        for _ in range(rng.randrange(1, 12)):
            block(f"{root} {rng.choice(('p', 'p', 'p', 'li', 'h2', 'td', 'blockquote', 'div'))}", 1)
            if rng.random() < 0.15:
                block(f"{root} {rng.choice(('aside', 'div.ad', 'div.share', 'form', 'nav li', 'div.related li', 'div.comments p'))}", 0)
        for path in rng.sample(("footer", "footer p", "div.comments p", "div.sidebar li", "div.newsletter", "aside", "nav li"), rng.randrange(0, 5)):
            block(path, 0)
        pages.append(tuple(page))
    return pages


def twins(pages: list[tuple]) -> list[tuple]:
    """The same pages inside an article element: every block belongs to it, whatever its size."""
    return [tuple(("article " + path.split()[-1], words, linked, 1) for path, words, linked, _ in page if "." not in path) for page in pages]


def labelled_rows() -> tuple[list[tuple[float, ...]], list[int]]:
    rows, labels = [], []
    for page in (*LABELLED, *plain_pages(), *twins(plain_pages()), *plain_pages(named=True), *twins(plain_pages(named=True)), *tagged_pages()):
        found, outer, known = [], [], {}
        for path, words, links, _ in page:
            flags, hint, steps = 0, -1, path.split()
            for i, step in enumerate(steps):
                tag, _, name = step.partition(".")
                flags = enter(flags, tag)
                if tag in ("article", "main"):
                    hint = -1
                if hinted(flags, tag, name):
                    at = " ".join(steps[: i + 1])
                    if at not in known:
                        known[at] = len(outer)
                        outer.append(hint)
                    hint = known[at]
            found.append(("", words, links, flags, hint, steps[-1] == "h1"))
        rows += features(settled(found, outer))
        labels += [x[3] for x in page]
    return rows, labels


def grow(rows: list[tuple[float, ...]], labels: list[int], depth: int = 24):
    """A decision tree by Gini impurity: a label, or (feature, threshold, tree if at most, tree if above)."""
    ones, n = sum(labels), len(labels)
    if depth == 0 or ones in (0, n):
        return int(2 * ones >= n)
    best = None
    for f in range(len(rows[0])):
        order = sorted(range(n), key=lambda i: rows[i][f])
        left = 0
        for k, i in enumerate(order[:-1], 1):
            left += labels[i]
            a, b = rows[i][f], rows[order[k]][f]
            if a == b:
                continue
            right = ones - left
            cost = left * (k - left) / k + right * (n - k - right) / (n - k)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, (a + b) / 2)
    if best is None or best[0] >= ones * (n - ones) / n - 1e-12:
        return int(2 * ones >= n)
    _, f, cut = best
    side = [r[f] <= cut for r in rows]
    part = lambda want: grow([r for r, s in zip(rows, side) if s == want], [y for y, s in zip(labels, side) if s == want], depth - 1)
    return f, cut, part(True), part(False)


def classify(tree, row: tuple[float, ...]) -> int:
    while not isinstance(tree, int):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def main_text(tree, page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b[0] for b, row in zip(found, features(found)) if classify(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", *others: str) -> DataFrame:
    """id, the other named columns, text and n_chars of every page."""
    tree = grow(*labelled_rows())
    kept = [id_col, *others]

    def run(tree, cols):
        texts = [main_text(tree, p) for p in cols[html_col]]
        return {c: cols[c] for c in kept} | {"text": texts, "n_chars": [len(t) for t in texts]}

    x = text_rows(pages, *kept, html_col)
    kinds = {f.name: f.dataType.simpleString() for f in x.schema}
    return map_batches(x, run, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", text string, n_chars long", init=lambda: tree)


def op2(pages: DataFrame) -> DataFrame:
    return extract(pages, "page_id", "html", "url")
