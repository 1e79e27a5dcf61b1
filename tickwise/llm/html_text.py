"""Main text of a page by composite text density over its DOM.

Each node gets C characters, T tags, LC link characters and LT link tags of its
subtree; its composite density is ``C/T`` on a logarithm whose base grows with
the share of link text (body-wide share ``LCb/Cb`` included), so long plain
blocks score high and link lists near zero.  The node whose children's
densities have the largest sum is the main block; the smallest density on the
path from it up to the body is the threshold which any further block must
reach.  Where the main block's own children are less dense (a block's density
grows with its length), their median is the threshold, so that a part of the
article isn't held to more than the parts of the main block.  Of each block that
reaches it, the node below with the largest sum is kept, and text directly in a
block if that text reaches it; a heading stays with kept text that follows it,
an ``article`` or ``main`` around the main block stays whole.  Elements that never
hold article text (menus, headers, footers, asides, forms, scripts, styles, notices,
adverts, comment lists) count as empty; one that is told by its name only stays if it
holds the article or most of the text, and the header of an article stays unless most of
its text is links.

A null or empty page gives an empty text; broken markup is read as browsers read it (a
tag, comment or script that never ends takes the rest of the page with it); the tree is
walked without recursion and in linear time, so depth and length are unbounded.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p
    pre section summary table tbody td tfoot th thead tr ul""".split())
#: Elements without article text.
DROPPED = frozenset("""aside button canvas datalist dialog footer form head header iframe input label
    menu nav noscript object option script select style svg template textarea title""".split())
#: Last words of names (class, id, role) that mark a part as something other than the article.
WORDS = frozenset("""ad adbox ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs
    cc complementary consent contentinfo cookie cookies disclaimer footer gdpr header masthead menu modal nav navbar
    navigation newsletter notice notices pagination popup promo promos promotion recommendation recommendations
    recommended related search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe
    toolbar widget widgets""".split())
#: Plain nouns that may follow them.
NOUNS = frozenset("""area bar block box button buttons container form inner item items link links list panel posts
    section site slot unit window wrap wrapper""".split())
#: Words that make a name tell of a state (no-sidebar, has-header) or of the article's own header.
STATES = frozenset("has hidden hide is no non not with without".split())
OWN = frozenset("article content entry page post story title".split())
#: Readers' words are never the article, however long they are; a discussion is only outside of it.
READERS = frozenset("comment comments commentlist disqus discussion replies reply respond responses".split())
#: Parts told by a whole name.
WHOLE = frozenset("author-box author-bio author-card about-author about-the-author".split())
JOINTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
#: Open elements that a start tag closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
#: Elements that such closing doesn't reach across.
FENCE = frozenset("table ul ol dl div article section main body html td th".split())
CLOSE_P = BLOCK - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html"}
SHUT = {t: [*CLOSES.get(t, ()), *(["p"] if t in CLOSE_P else [])] for t in {*CLOSES, *CLOSE_P}}
CONTAINERS = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKUP = frozenset("/!?abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
NAME = re.compile(r"<(/?)([A-Za-z][^ \t\n\r\f/>]*+)")
#: ">" or "/>"; or a name with its value in quotes (and the closing quote, if there is one) or without
ATTRIBUTE = re.compile(r"""[ \t\n\r\f]*+(?:(/?>)|/|(=?[^ \t\n\r\f/>=]*+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+
    (?:"([^"]*+)("?)|'([^']*+)('?)|([^ \t\n\r\f>"'][^ \t\n\r\f>]*+)?))?)""", re.X)
COMMENT_END = re.compile("--!?>")
#: Elements whose content isn't markup, and what ends it.
RAW = {t: re.compile(f"</{t}(?=[ \\t\\n\\r\\f/>])", re.I) for t in ("iframe", "script", "style", "textarea", "title")}


def _part(named: str) -> tuple[bool, bool, bool]:
    """Whether a name marks another part than the article, readers' words, and a discussion:
    its last word that is no plain noun decides."""
    marked = readers = talk = False
    for token in named.split():
        words = [w.lower() for w in JOINTS.split(token) if w]
        if "-".join(words) in WHOLE:
            marked = True
        while len(words) > 1 and words[-1] in NOUNS:
            words.pop()
        if not words or not STATES.isdisjoint(words):
            continue
        last = words[-1]
        if last == "discussion":
            marked = talk = True
        elif last in READERS:
            marked = readers = True
        elif last in WORDS:
            marked = marked or not (last == "header" and not OWN.isdisjoint(words))
    return marked, readers, talk


class _Tree:
    """Nodes in page order (a parent before its children) and the text events.

    Pages are scanned as browsers do: a tag, comment or script that never ends takes
    the rest of the page.  Every step either moves on in the page or closes elements, and
    the open elements are looked up by name, so that time grows with the page only."""

    def __init__(self) -> None:
        self.parent, self.tag, self.dropped, self.link = [-1], ["#"], [False], [False]
        self.within = [False]                            # an article or main element
        self.open = [0]
        self.depths: dict[str, list[int]] = {}           # of open elements, by name
        self.fences = [0]                                # depths of open elements on FENCE
        self.marked: list[int] = []                      # by name only, for drop_marked
        self.headers: list[int] = []                     # of articles, for drop_marked
        self.share = 0.0                                 # of link text in the body, known with the densities
        self.events: list[tuple[int, str | None]] = []   # text, or None at a block edge

    def feed(self, html: str) -> None:
        at = since = 0          # since: where text begins that isn't an event yet
        n = len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                lt = n
            elif html[lt + 1:lt + 2] not in MARKUP:
                at = lt + 1     # a "<" of the text
                continue
            if lt > since:
                self._text(html[since:lt])
            since = n           # of what the page ends within, nothing is text
            if lt == n:
                return
            name = NAME.match(html, lt)
            if name is None:
                if html.startswith("<!--", lt):
                    end = COMMENT_END.search(html, lt + 2)
                    at = end.end() if end else n
                else:
                    at = html.find(">", lt) + 1 or n
                since = at
                continue
            tag = name[2].lower()
            if name[1]:
                at = html.find(">", name.end()) + 1
                if not at:
                    return
                self._end(tag)
                since = at
                continue
            named, at = [], name.end()
            while True:
                m = ATTRIBUTE.match(html, at)
                at = m.end()
                if m[1]:            # ">"
                    break
                if at >= n or m[4] == "" or m[6] == "":
                    return          # the page ends within the tag
                if m[2] and m[2].lower() in ("class", "id", "role"):
                    named.append(m[3] or m[5] or m[7] or "")
            self._start(tag, unescape(" ".join(named)))
            if m[1] == "/>" and tag not in VOID:
                self._end(tag)
            elif tag in RAW:
                end = RAW[tag].search(html, at)
                if not end:
                    return
                at = end.start()
            since = at
        if since < n:
            self._text(html[since:])

    def _text(self, data: str) -> None:
        self.events.append((self.open[-1], unescape(data) if "&" in data else data))

    def _close_to(self, depth: int) -> None:
        for n in self.open[depth:]:
            if self.tag[n] in BLOCK:
                self.events.append((self.parent[n], None))
                break
        for d in range(len(self.open) - 1, depth - 1, -1):
            self.depths[self.tag[self.open[d]]].pop()
        del self.open[depth:]
        while self.fences[-1] >= depth:
            self.fences.pop()

    def _start(self, tag: str, named: str) -> None:
        shut = SHUT.get(tag)
        while shut:     # the nearest element that this tag closes, unless a fence is nearer
            d = 0
            for t in shut:
                if self.depths.get(t):
                    d = max(d, self.depths[t][-1])
            if not d or d < self.fences[-1]:
                break
            same = self.tag[self.open[d]] == tag or tag in CLOSE_P
            self._close_to(d)
            if same:
                break
        above = self.open[-1]
        n = len(self.tag)
        within = self.within[above]
        never = tag in DROPPED and not (tag == "header" and within)
        if tag == "header" and within:
            self.headers.append(n)
        if not never and named and tag not in ("body", "html", "article", "main"):
            marked, never, talk = _part(named)
            never = never or (talk and not within)
            if marked and not never and not talk:
                self.marked.append(n)
        self.parent.append(above)
        self.tag.append(tag)
        self.within.append(within or tag in CONTAINERS)
        self.dropped.append(never or self.dropped[above])
        self.link.append(tag == "a" or self.link[above])
        if tag in BLOCK:
            self.events.append((above, None))
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            if tag in FENCE:
                self.fences.append(len(self.open))
            self.open.append(n)

    def _end(self, tag: str) -> None:
        if self.depths.get(tag):
            self._close_to(self.depths[tag][-1])

    def drop_marked(self) -> None:
        """Drop the parts marked by name, and headers of articles that are mostly links.  A
        part stays if two of three hold: it has an article or main element, no such element is
        outside marked parts, and it has most of the page's text outside links."""
        if not self.marked and not self.headers:
            return
        n = len(self.tag)
        named, headers = set(self.marked), set(self.headers)
        under, free = [False] * n, False
        articles, chars, links = [0] * n, [0] * n, [0] * n
        for i in range(1, n):
            under[i] = i in named or under[self.parent[i]]
            if self.tag[i] in CONTAINERS and not self.dropped[i]:
                articles[i] = 1
                free = free or not under[i]
        for node, text in self.events:
            if text is not None and not self.dropped[node]:
                (links if self.link[node] else chars)[node] += len(_spaced([text]))
        for i in range(n - 1, 0, -1):
            articles[self.parent[i]] += articles[i]
            chars[self.parent[i]] += chars[i]
            links[self.parent[i]] += links[i]
        for i in range(1, n):
            stays = (articles[i] > 0) + (not free) + (2 * chars[i] > chars[0]) > 1
            self.dropped[i] = self.dropped[i] or self.dropped[self.parent[i]] or (i in named and not stays) \
                or (i in headers and links[i] > chars[i])


def _spaced(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def densities(tree: _Tree) -> tuple[list[float], list[float]]:
    """Composite density of each node, and the sum of its children's."""
    n = len(tree.tag)
    chars, links = [0] * n, [0] * n
    tags, link_tags = [0] * n, [0] * n
    for node, text in tree.events:
        if text is not None and not tree.dropped[node]:
            k = len(_spaced([text]))
            chars[node] += k
            if tree.link[node]:
                links[node] += k
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        own = not tree.dropped[i]
        tags[p] += tags[i] + own
        link_tags[p] += link_tags[i] + (own and tree.tag[i] == "a")
    body = next((i for i, t in enumerate(tree.tag) if t == "body"), 0)
    tree.share = share = links[body] / max(1, chars[body])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        density[i] = _density(chars[i], tags[i], links[i], link_tags[i], share)
        if i:
            total[tree.parent[i]] += density[i]
    return density, total


def _density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    if not c:
        return 0.0
    base = math.log(c * max(1, lc) / max(1, c - lc) + share * c + math.e)
    t, lc, lt = max(1, t), max(1, lc), max(1, lt)
    # both logarithms stay above 0, so that the shortest text still counts as text
    return c / t * math.log(max(1.0, c * t / (lc * lt)) + 1e-6) / math.log(base + 1e-6)


def _reaching(tree: _Tree, density: list[float], total: list[float],
              threshold: float) -> tuple[list[bool], list[bool]]:
    """Nodes to keep whole, and nodes whose text lies directly in a block that is to be kept."""
    n = len(tree.tag)
    best = [i if tree.tag[i] in BLOCK else -1 for i in range(n)]
    for i in range(n - 1, 0, -1):
        p, b = tree.parent[i], best[i]
        if b >= 0 and density[b] and (best[p] < 0 or total[b] > total[best[p]]):
            best[p] = b
    kept = [False] * n
    for i in range(n):
        if tree.tag[i] in BLOCK and density[i] >= threshold:
            kept[best[i]] = True
    # text directly in a block, with the inline elements around it
    block = [0] * n
    chars, tags, links, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        inline = tree.tag[i] not in BLOCK
        block[i] = block[tree.parent[i]] if inline else i
        if inline and not tree.dropped[i]:
            tags[block[i]] += 1
            link_tags[block[i]] += tree.tag[i] == "a"
    for node, text in tree.events:
        if text is not None and not tree.dropped[node]:
            k = len(_spaced([text]))
            chars[block[node]] += k
            links[block[node]] += k * tree.link[node]
    reach = [_density(chars[i], tags[i], links[i], link_tags[i], tree.share) >= threshold for i in range(n)]
    return kept, [reach[b] for b in block]


def _with_headings(tree: _Tree, stays: list[bool]) -> list[bool]:
    """``stays`` of the text events, with headings directly before text that stays;
    an h1 reaches over dropped parts, too."""
    head = [""] * len(tree.tag)
    for i in range(1, len(head)):
        head[i] = tree.tag[i] if tree.tag[i] in HEADINGS else head[tree.parent[i]]
    after = over = False
    out = list(stays)
    for e in range(len(out) - 1, -1, -1):
        node, text = tree.events[e]
        if text is None or not text.strip():
            continue
        if tree.dropped[node]:
            after = False
        elif head[node]:
            out[e] = out[e] or (over if head[node] == "h1" else after)
        else:
            after = over = out[e]
    return out


def main_text(html: str | None) -> str:
    """The article text of one page."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.drop_marked()
    density, total = densities(tree)
    n = len(tree.tag)
    top = max(range(n), key=lambda i: (total[i] or density[i] * 1e-9, -i))
    if not density[top]:
        return ""
    path, node = [], top
    while node >= 0 and tree.tag[node] not in ("body", "html", "#"):
        path.append(node)
        node = tree.parent[node]
    parts = sorted(density[i] for i in range(n)
                   if tree.parent[i] == top and density[i] and tree.tag[i] in BLOCK - HEADINGS)
    # node is the body now, or what stands for it
    threshold = min([density[i] for i in [*path, node] if i >= 0] + parts[(len(parts) - 1) // 2:][:1])
    # the article element around the main block, if there is one
    root = next((i for i in reversed(path) if tree.tag[i] in CONTAINERS), top)
    kept, own = _reaching(tree, density, total, threshold)
    kept[root] = True
    for i in range(1, n):
        kept[i] = kept[i] or kept[tree.parent[i]]
    texts = _with_headings(tree, [text is not None and (kept[node] or own[node]) and not tree.dropped[node]
                                  for node, text in tree.events])
    blocks, run = [], []
    for (_, text), stays in zip(tree.events, texts, strict=True):
        if text is None:
            blocks.append(_spaced(run))
            run = []
        elif stays:
            run.append(text)
    blocks.append(_spaced(run))
    return " ".join(b for b in blocks if b)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and its length in code points."""
    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])
        return step

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return map_batches(pages.select(id_col, url_col, html_col), make,
                       f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")
