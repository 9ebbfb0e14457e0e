"""Main text of web pages from a tree-structured graphical model.

The block elements of a page form a tree. Each is content or not; potentials of the element
come from its own features, potentials of the edge from parent to child favour or
disfavour each pair of labels. Sum-product messages go up from the leaves and down from the root
and give every element its marginal probability of being content. The text of elements that are
more likely content than not is the main text.

Weights are learned by gradient ascent on the exact likelihood, from two sets of labelled
pages: layouts listed below, filled with words, and a bounded sample of the given pages that mark their article themselves.

A null or empty html gives an empty text, as does a page without content. Markup may be broken: tags that are
not closed end with their parent, a head with the first thing that may not stand in one. Whole pages are read. A page's own text of every element is kept
or dropped as a whole. Rows with the same html get the same text. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadweld.llm.labelled import least_hashes

#: Given pages that are read for labels at most, and their largest size.
TRAIN_PAGES, TRAIN_CHARS = 200, 20_000
STEPS, RATE, PENALTY = 200, 0.1, 0.5

#: Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "head title script style noscript template svg math iframe object select button textarea canvas audio video".split()
)
RAW = {tag: re.compile(f"</{tag}\\b[^>]*>?", re.I) for tag in "script style textarea title noscript iframe".split()}
#: What may stand in a head; anything else ends one that is open.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
PLAIN = frozenset("html body div section main article span center".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
}
SCOPES = frozenset("ul ol dl table html body div section article main nav aside footer header form td th".split())
#: Words in class, id and role that speak for or against content.
AGAINST = (
    "ad ads advert advertisement advertising adbox banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies "
    "disqus feedback foot footer form gdpr head header login masthead menu meta modal nav navbar navigation newsletter notice alert "
    "overlay pager pagination popup promo promoted recommended related reply replies respond rail search share sharing sidebar side signup skip social "
    "sponsor sponsored subscribe tags teaser toolbar topbar widget"
).split()
FOR = "article articlebody body content entry hentry main post posttext story text".split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*+)>",
    re.S,
)
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HINT = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "hints", "parent", "texts", "link_chars", "chars", "marked", "children")

    def __init__(self, tag: str, hints: frozenset[str], parent: int, marked: str = ""):
        self.tag, self.hints, self.parent, self.marked = tag, hints, parent, marked
        self.texts: list[int] = []
        self.chars = self.link_chars = self.children = 0


def hints_of(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    found: set[str] = set()
    for m in _NAMES.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "")
        found.update(_HINT.findall(value.lower()))
    return frozenset(found)


def parsed(page: str) -> tuple[list[Node], list[str]]:
    """Block elements in page order, parents first, and the text blocks; nodes list the blocks they own."""
    nodes, blocks = [Node("html", frozenset(), -1)], []
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements with their block element
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a tag are
    buffer: list[str] = []
    links = silent = 0
    at = 0

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                owner = nodes[stack[-1][1]]
                owner.texts.append(len(blocks))
                owner.chars += len(text)
                blocks.append(text)

    def hear(piece: str) -> None:
        if piece and not silent:
            piece = html.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            if links:
                nodes[stack[-1][1]].link_chars += len(piece.strip())

    def close(upto: int) -> None:
        nonlocal links, silent
        while len(stack) > upto:
            tag = stack[-1][0]
            if tag not in INLINE:
                flush()
            links -= tag == "a"
            silent -= tag in SILENT
            stack.pop()
            places[tag].pop()

    def push(tag: str, node: int) -> None:
        if tag not in places:
            places[tag] = []
        places[tag].append(len(stack))
        stack.append((tag, node))

    def innermost(tags) -> int:
        """Where the innermost open element of the tags is; 0 without any."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def leave_head(due: bool) -> None:
        if due and stack[-1][0] == "head":
            close(len(stack) - 1)

    # No tag ends after the last ">".
    tags_end = page.rfind(">") + 1
    while m := _TOKEN.search(page, at, tags_end):
        shut, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        leave_head(page[at : m.start()].strip() != "")
        hear(page[at : m.start()])
        at = m.end()
        if not tag:
            if at == tags_end and m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            continue
        tag = tag.lower()
        leave_head(tag in ("html", "body", "br") if shut else tag not in IN_HEAD and tag != "html")
        if shut:
            k = innermost((tag,))
            if k and (tag not in INLINE or k > innermost(SCOPES)):
                close(k)
            continue
        if tag in ("html", "body"):
            continue
        if tag == "br" or tag in VOID:
            # Only a line break parts words.
            buffer.append(" " if tag == "br" else "")
            if tag == "hr":
                flush()
            continue
        if tag in CLOSES_P or tag in CLOSED_BY:
            ends = CLOSED_BY.get(tag, frozenset()) | (frozenset({"p"}) if tag in CLOSES_P else frozenset())
            barriers = [t for t in SCOPES if t not in ends]
            while (k := innermost(ends)) > innermost(barriers):
                close(k)
                if tag != "tr":
                    break
        if tag in RAW:
            # Only its own end tag ends a script or style, and none of these is heard.
            end = RAW[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in INLINE or tag in SILENT:
            push(tag, stack[-1][1])
            links += tag == "a"
            silent += tag in SILENT
        else:
            flush()
            parent = stack[-1][1]
            marked = re.search(r"data-label=(\w)", rest)
            nodes.append(Node(tag, hints_of(rest), parent, marked[1] if marked else ""))
            nodes[parent].children += 1
            push(tag, len(nodes) - 1)
        if rest.endswith("/") and tag not in PLAIN:
            close(len(stack) - 1)
    rest = page[at:].partition("<!--")[0]
    leave_head(rest.strip() != "")
    hear(rest)
    close(1)
    flush()
    return nodes, blocks


TAGS = "article main section div p h li ul ol nav header footer aside form table td dl blockquote pre figure".split()
WIDTH = len(TAGS) + 18
_AGAINST, _FOR = frozenset(AGAINST), frozenset(FOR)
_AGAINST_TAGS, _FOR_TAGS = frozenset("nav footer aside form menu".split()), frozenset("article main".split())


def features(nodes: list[Node], blocks: list[str]) -> np.ndarray:
    """One row per node: its element, its names, its text, and what its ancestors and subtree are like."""
    n = len(nodes)
    out = np.zeros((n, WIDTH))
    chars, links = np.array([v.chars for v in nodes], float), np.array([v.link_chars for v in nodes], float)
    below, linked = chars.copy(), links.copy()
    for i in range(n - 1, 0, -1):
        below[nodes[i].parent] += below[i]
        linked[nodes[i].parent] += linked[i]
    whole = max(below[0], 1.0)
    against, within, outside = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    k = len(TAGS)
    for i, v in enumerate(nodes):
        up = v.parent
        bad_name, good_name = not v.hints.isdisjoint(_AGAINST), not v.hints.isdisjoint(_FOR)
        bad = bad_name or v.tag in _AGAINST_TAGS or (v.tag == "header" and not (up >= 0 and within[up]))
        against[i] = bad or (up >= 0 and against[up])
        within[i] = v.tag in _FOR_TAGS or good_name or (up >= 0 and within[up])
        tag = "h" if len(v.tag) == 2 and v.tag[0] == "h" and v.tag[1].isdigit() else "td" if v.tag == "th" else v.tag
        row = out[i]
        if tag in TAGS:
            row[TAGS.index(tag)] = 1
        texts = [blocks[b] for b in v.texts]
        row[k : k + 18] = (
            1.0,
            bad_name,
            good_name and not bad_name,
            bad,
            up >= 0 and against[up],
            up >= 0 and within[up],
            within[i] and not against[i],
            tag == "h" and not within[i],
            v.chars > 0,
            np.log1p(v.chars) / 5,
            v.chars >= 80,
            min(1.0, v.link_chars / v.chars) if v.chars else 0.0,
            min(1.0, linked[i] / below[i]) if below[i] else 0.0,
            np.log1p(below[i]) / 8,
            below[i] / whole,
            any(t[-1] in ".!?:;\"”»" for t in texts),
            sum(t.count(",") + t.count(".") for t in texts) / (v.chars + 20) * 20,
            i == 0,
        )
    return out


class Tree:
    """Unary weights ``w`` for content and edge potentials ``t[parent, child]``."""

    def __init__(self, width: int = WIDTH):
        self.w, self.t = np.zeros(width), np.zeros((2, 2))

    def marginals(self, x: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]):
        """Probability of content for all nodes of a forest, and expected label pairs over its edges.

        ``levels`` hold the nodes by depth; messages of a level go at once.
        """
        u = np.clip(x @ self.w, -30, 30)
        local = np.stack([-u / 2, u / 2], axis=1)
        up, own = np.zeros_like(local), local.copy()
        for level in reversed(levels[1:]):
            # What the children say to their parent, summed over the child's label.
            up[level] = _log_sum(own[level][:, None, :] + self.t[None])
            np.add.at(own, parent[level], up[level])
        down, pairs = np.zeros_like(local), np.zeros((2, 2))
        belief = own.copy()
        for level in levels[1:]:
            above = belief[parent[level]] - up[level]
            joint = above[:, :, None] + self.t[None] + own[level][:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            down[level] = _log_sum(np.swapaxes(above[:, :, None] + self.t[None], 1, 2))
            belief[level] = own[level] + down[level]
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), pairs

    def fit(self, x, y, parent, levels, steps=STEPS, rate=RATE, penalty=PENALTY) -> Tree:
        edges = np.concatenate(levels[1:])
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[parent[edges]], y[edges]), 1)
        mean, square = np.zeros(len(self.w) + 4), np.zeros(len(self.w) + 4)
        for k in range(1, steps + 1):
            content, pairs = self.marginals(x, parent, levels)
            theta = np.concatenate([self.w, self.t.ravel()])
            gradient = (np.concatenate([x.T @ (y - content), (seen - pairs).ravel()]) - penalty * theta) / len(y)
            mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
            theta = theta + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
            self.w, self.t = theta[:-4], theta[-4:].reshape(2, 2)
        return self


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1)
    return top + np.log(np.exp(x - top[..., None]).sum(axis=-1))


def forest(trees: list[list[Node]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Parents (numbered through all trees) and nodes by depth."""
    parent, depth, offset = [], [], 0
    for nodes in trees:
        base = len(depth)
        for v in nodes:
            parent.append(v.parent + offset if v.parent >= 0 else -1)
            depth.append(0 if v.parent < 0 else depth[base + v.parent] + 1)
        offset += len(nodes)
    depths = np.array(depth, np.int64)
    return np.array(parent), np.split(np.argsort(depths, kind="stable"), np.cumsum(np.bincount(depths))[:-1])


def main_texts(tree: Tree, pages: list[str | None]) -> list[str]:
    found = [parsed(p or "") for p in pages]
    if not found:
        return []
    parent, levels = forest([nodes for nodes, _ in found])
    content, _ = tree.marginals(np.vstack([features(*f) for f in found]), parent, levels)
    out, at = [], 0
    for nodes, blocks in found:
        kept = sorted(b for i, v in enumerate(nodes) for b in v.texts if content[at + i] >= 0.5)
        out.append("\n".join(blocks[b] for b in kept))
        at += len(nodes)
    return out


#: Layouts of labelled pages: 1 content, 0 not, inherited by what is inside. H, S, M, L stand for words of a
#: heading, a short text, a middling one and a long one; A is a link.
LAYOUTS = (
    "<nav data-label=0><ul><li>A</li><li>A</li><li>A</li></ul></nav><div data-label=0 class=ad>S</div><article data-label=1><h1>H</h1><p>L</p><p>M</p><p>S</p></article><footer data-label=0>S</footer>",
    "<header data-label=0><h2>H</h2><ul class=menu><li>A</li><li>A</li></ul></header><main data-label=1><h1>H</h1><p>M</p><p>L</p><ul><li>S</li><li>M</li></ul></main><aside data-label=0><h3>H</h3><p>M</p><p>A</p></aside><footer data-label=0><p>S</p></footer>",
    "<div data-label=0 class=header><div>H</div><div class=nav>A A A</div></div><div class=wrapper><div data-label=1 class=content><h1>H</h1><p>L</p><p>L</p><h2>H</h2><p>M</p></div><div data-label=0 class=sidebar><h3>H</h3><ul><li>A</li><li>A</li></ul><p>M</p></div></div><div data-label=0 class=footer>S</div>",
    "<div data-label=0 class=cookie-notice><p>M</p><p>S</p></div><nav data-label=0><a>A</a></nav><article data-label=1><h1>H</h1><p>L</p><div data-label=0 class=ad><p>M</p></div><p>L</p><p>S</p></article><section data-label=0 class=comments><h3>H</h3><div><p>M</p><p>S</p></div><div><p>L</p></div></section><footer data-label=0><p>M</p></footer>",
    "<article data-label=1><h1>H</h1><p>S</p><blockquote>M</blockquote><p>L</p><div data-label=0 id=comments><ul><li><p>M</p></li><li><p>L</p></li></ul></div><footer data-label=0>S</footer></article><form data-label=0><label>S</label><p>S</p></form>",
    "<div data-label=0 class=menu>A A A A</div><div data-label=1 id=story><h1>H</h1>L<p>M</p><table><tr><td>S</td><td>S</td></tr></table><pre>M</pre></div><div data-label=0 class=related><h3>H</h3><p>A</p><p>A</p></div><div data-label=0 class=newsletter><p>M</p></div>",
    "<div data-label=0>A A A</div><div data-label=1><h1>H</h1><p>L</p><p>L</p><p>M</p></div><div data-label=0>S A</div>",
    "<h1 data-label=1>H</h1><p data-label=1>L</p><p data-label=1>M</p><p data-label=1>S</p>",
    "<p data-label=1>S</p><p data-label=1>S</p><ul data-label=1><li>S</li><li>S</li></ul>",
    "<div data-label=1><h1>H</h1><p>S</p><p>S</p></div><div data-label=0 class=footer><p>S</p></div>",
    "<table data-label=0><tr><td>A</td><td>A</td></tr></table><div data-label=1 class=post><h2>H</h2><p>M</p><p>M</p><p>L</p><dl><dt>S</dt><dd>M</dd></dl></div><div data-label=0 class=share>A A</div><div data-label=0 class=pagination>A A</div>",
    "<header data-label=0><p>S</p></header><section data-label=1><h2>H</h2><p>L</p><p>S</p><p>S</p></section><section data-label=0 class=promo><h2>H</h2><p>M</p></section><section data-label=0 class='user-comments'><p>L</p><p>M</p></section><footer data-label=0><ul><li>A</li></ul><p>M</p></footer>",
    "<div data-label=0 class=banner>M</div><main><article data-label=1><header><h1>H</h1></header><p>M</p><figure><p>S</p></figure><p>L</p><ol><li>M</li><li>S</li></ol></article><aside data-label=0><p>L</p></aside></main><div data-label=0 role=alert><p>M</p></div>",
)
_SIZES = {"H": (2, 10), "S": (1, 12), "M": (12, 40), "L": (40, 160)}


def labelled_layouts(rounds: int = 8) -> Iterator[str]:
    """Every layout some times over, filled with words of random length."""
    rng = np.random.default_rng(7)

    def words(kind: str) -> str:
        sentence, out = 0, []
        for _ in range(int(rng.integers(*_SIZES[kind]))):
            word = "".join(rng.choice(list("aeiourstlnmdc"), int(rng.integers(2, 9))))
            sentence += 1
            stop = kind != "H" and rng.random() < 0.08
            out.append((word.capitalize() if sentence == 1 else word) + ("." if stop else "," if rng.random() < 0.06 else ""))
            sentence = 0 if stop else sentence
        return " ".join(out) + ("" if kind == "H" or rng.random() < 0.15 else ".")

    for _ in range(rounds):
        for layout in LAYOUTS:
            yield re.sub(
                r"(?<![\w=])([HSMLA])(?![\w=])",
                lambda m: f"<a href=x>{words('S')[:24]}</a>" if m[1] == "A" else words(m[1]),
                layout,
            )


def labels_of(nodes: list[Node]) -> np.ndarray:
    """Labels from marks, inherited; a node without any takes that of most of the text below it."""
    label = np.full(len(nodes), -1)
    for i, v in enumerate(nodes):
        label[i] = int(v.marked) if v.marked else label[v.parent] if v.parent >= 0 else -1
    votes = np.zeros(len(nodes))
    for i in range(len(nodes) - 1, -1, -1):
        v = nodes[i]
        if label[i] >= 0:
            votes[i] += v.chars * (1 if label[i] == 1 else -1)
        if v.parent >= 0:
            votes[v.parent] += votes[i]
    return np.where(label >= 0, label, (votes > 0).astype(int))


def labels_by_landmark(nodes: list[Node]) -> np.ndarray | None:
    """Content is what stands in the one article or main element; None if there is none with text."""
    marks = [i for i, v in enumerate(nodes) if v.tag == "article"] or [i for i, v in enumerate(nodes) if v.tag == "main"]
    if len(marks) != 1:
        return None
    for i, v in enumerate(nodes):
        v.marked = "1" if i == marks[0] else "0" if v.parent == 0 else ""
        if v.tag in _AGAINST_TAGS or not v.hints.isdisjoint(_AGAINST):
            v.marked = "0"
    if nodes[marks[0]].parent > 0:
        nodes[marks[0]].marked = "1"
    return labels_of(nodes)


def learn(pages: DataFrame, at_most: int = TRAIN_PAGES) -> Tree:
    """Weights from the layouts and from given pages with an article element, chosen by a digest."""
    own = [parsed(p) for p in labelled_layouts()]
    held = [(f, labels_of(f[0])) for f in own]
    marked = pages.where(F.length("html").between(1, TRAIN_CHARS) & F.lower("html").contains("<article")).select("html")
    sample = least_hashes(marked, F.xxhash64("html"), at_most, "html")
    for row in sample.collect():
        found = parsed(row["html"])
        label = labels_by_landmark(found[0])
        if label is not None:
            held.append((found, label))
    parent, levels = forest([f[0] for f, _ in held])
    x = np.vstack([features(*f) for f, _ in held])
    return Tree().fit(x, np.concatenate([y for _, y in held]), parent, levels)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url and main text of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(tree or learn(pages))
    rows = pages.select("page_id", "url", "html")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:2])

    def run(batches, piece=200):
        for batch in batches:
            htmls = batch.column(2).to_pylist()
            texts = [t for i in range(0, len(htmls), piece) for t in main_texts(shared.value, htmls[i : i + piece])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return rows.mapInArrow(run, f"{fields}, text string")


def op5_html_text(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
