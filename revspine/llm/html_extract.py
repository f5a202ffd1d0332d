"""Main text of web pages by a tree-structured graphical model.

Every element of a page's DOM is a variable: main content or not.  A node's
potential comes from its tag, the words of its class, id and role, its length
and its share of linked text; parent-child potentials say how often children
agree with their parents.  Sum-product messages run upward from the leaves and
downward from the root, which on a tree gives exact marginals.  The potentials
are counts over a bounded sample of labelled pages: pages that mark their
article or main part, whose elements inside it (and not in a part of a known
other kind) are content.  Known kinds of other parts (menus, forms, comments
and the like) also get prior counts, for pages unlike the sample's.

Text nodes belong to the block of their nearest block-level element; blocks
whose element is more likely content than not are joined in page order.

Defined results: NULL or empty html gives the empty text; text outside any
element hangs on the root; an unclosed tag at the end of a cut page is markup;
a button or select without its end tag is no element; a raw element (script and
the like) without one reaches to the end; a quote in a tag opens a value only
behind an equals sign; an element at exactly 0.5 is not content; repeated rows
get equal texts; columns named ``text`` or ``n_chars`` are replaced, others are
kept; an empty table gives no rows; without labelled pages the prior counts decide.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, pieces

SAMPLE_PAGES = 1500  # bound of the training sample

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
CONTROL = frozenset(("button", "select"))  # inline variables of their own
BLOCK = frozenset("""html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - frozenset("html head body caption td th tr tbody thead tfoot legend option optgroup".split())
#: An opening tag ends these open ones, up to the named boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}

# Known kinds of parts, by words of tag, class, id and role.
OTHER_TAGS = frozenset("nav header footer aside form menu dialog fieldset button select".split())
OTHER_WORDS = frozenset("""ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs
header footer masthead topbar toolbar comment comments disqus reply replies respond notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe
subscription signup login share sharing social related recommended more widget pagination pager copyright legal disclaimer skip search""".split())
MAIN_TAGS = frozenset(("article", "main"))
FRAME = frozenset(("#root", "html", "head", "body"))
MAIN_WORDS = frozenset("article articlebody content entry main post story text body".split())
PRIOR = 20  # pseudo-counts of the known kinds
#: Pseudo-counts of (parent's state, state) by whether parent and child are of a
#: known other kind: such children leave the content, and nothing enters below them.
EDGE_PRIOR = {"plain": ((57, 3), (1, 59)), "child": ((999, 1), (950, 50)), "parent": ((9995, 5), (10, 990))}
LEAST_LEAVE = 0.005  # a plain child may leave the content at least so often
CLIP = 6.0  # of a node's own evidence
CLIP_FEATURE = {"tag": 1.0, "size": 1.0, "link": 3.0}  # of what one feature says; a sample of few layouts says too much

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>|</[^>]*>""", re.DOTALL)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.IGNORECASE) for t in RAW}
_NEXT = {t: re.compile(rf"<(/?){t}(?=[\s/>])", re.IGNORECASE) for t in CONTROL}
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_UNCLOSED = re.compile(r"<(?:[a-zA-Z/!?][^>]*)?\Z")


class Node:
    __slots__ = ("tag", "kind", "parent", "own", "links", "depth")

    def __init__(self, tag: str, kind: str, parent: int):
        self.tag, self.kind, self.parent = tag, kind, parent
        self.own = self.links = 0


def _kind(tag: str, attributes: str) -> str:
    words = set()
    if attributes:
        for m in _ATTR.finditer(attributes):
            words.update(_WORDS.findall((m[2] or m[3] or m[4] or "").lower()))
        if _HIDDEN.search(attributes):
            return "hidden"
    if words & OTHER_WORDS:
        return "other"
    return "main" if words & MAIN_WORDS else "plain"


def parse(page: str) -> tuple[list[Node], list[tuple[int, str | None]]]:
    """Elements (parents before children; inline ones belong to their block)
    and text pieces as (element, raw text); a change of block is (element, None)."""
    nodes = [Node("#root", "plain", -1)]
    stack: list[tuple[str, int]] = [("#root", 0)]  # inline tags carry their block's element
    texts: list[tuple[int, str | None]] = []
    links = at = 0
    page = _UNCLOSED.sub("", page)

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            here = nodes[stack[-1][1]]
            n = len(raw)
            here.own += n
            if links:
                here.links += n
        if raw:
            texts.append((stack[-1][1], raw))

    def close(tags, boundary) -> None:
        nonlocal links
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                links -= sum(t == "a" for t, _ in stack[k:])
                del stack[k:]
                texts.append((stack[-1][1], None))
                return
            if stack[k][0] in boundary:
                return

    while m := _TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "p" and not any(t == "p" for t, _ in stack):
                texts.append((stack[-1][1], None))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    block = any(t in BLOCK for t, _ in stack[k:])
                    del stack[k:]
                    if block:
                        texts.append((stack[-1][1], None))
                    break
                if tag not in BLOCK and tag not in CONTROL and stack[k][0] in BLOCK:
                    break  # an inline end tag does not close a block
            continue
        if tag in VOID:
            texts.append((stack[-1][1], None if tag == "hr" else " " if tag == "br" else ""))
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if m[3].rstrip().endswith("/") and tag not in BLOCK:
            continue
        if tag in CONTROL and not ((following := _NEXT[tag].search(page, at)) and following[1]):
            continue  # never closed: what follows is not inside it
        if tag in CLOSES_P:
            close({"p"}, BLOCK - {"p"} | CONTROL)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in BLOCK:
            nodes.append(Node(tag, _kind(tag, m[3]), stack[-1][1]))
            stack.append((tag, len(nodes) - 1))
            texts.append((len(nodes) - 1, None))
        else:
            kind = _kind(tag, m[3]) if m[3] else "plain"
            if tag in CONTROL or kind in ("other", "hidden") and tag != "a":  # an inline part of another kind is a variable too
                nodes.append(Node(tag if tag in CONTROL else "inline", kind, stack[-1][1]))
                stack.append((tag, len(nodes) - 1))
            else:
                stack.append((tag, stack[-1][1]))
            links += tag == "a"
    text(page[at:])
    return nodes, texts


def features(nodes: list[Node]) -> list[tuple]:
    """(tag, kind, length class, link class) of each node; lengths over its subtree."""
    total, linked = [n.own for n in nodes], [n.links for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        total[nodes[k].parent] += total[k]
        linked[nodes[k].parent] += linked[k]
    out = []
    for n, t, x in zip(nodes, total, linked, strict=True):
        out.append((("tag", n.tag), ("kind", n.kind), ("size", 0 if not t else 1 if t < 25 else 2 if t < 100 else 3 if t < 1000 else 4), ("link", 0 if 5 * x < t or not t else 1 if 5 * x < 3 * t else 2)))
    return out


def edge_groups(nodes: list[Node]) -> list[str]:
    """Which parent-child potential ties each node to its parent."""
    other = [n.tag in OTHER_TAGS or n.kind in ("other", "hidden") for n in nodes]
    return ["child" if o else "parent" if n.parent >= 0 and other[n.parent] else "plain" for n, o in zip(nodes, other, strict=True)]


def labels(nodes: list[Node]) -> list[int] | None:
    """1 for content, from the page's own marks; None for a page without any."""
    if not any(n.tag in MAIN_TAGS for n in nodes):
        return None
    inner = "article" if any(n.tag == "article" for n in nodes) else "main"
    out = [0] * len(nodes)
    for k, n in enumerate(nodes[1:], 1):
        other = n.tag in OTHER_TAGS or n.kind in ("other", "hidden")
        # an article inside a part of another kind (a comment, say) starts nothing
        out[k] = int(not other and (out[n.parent] or n.tag == inner and not _within_other(nodes, k)))
    return out


def _within_other(nodes: list[Node], k: int) -> bool:
    while (k := nodes[k].parent) > 0:
        if nodes[k].tag in OTHER_TAGS or nodes[k].kind in ("other", "hidden"):
            return True
    return False


def train(counts: Counter) -> dict:
    """Log potentials from counts of ("f", state, name, value) and ("e", group, parent's state, state)."""
    own = Counter(counts)
    for s, tags, words in ((0, OTHER_TAGS, ("other", "hidden")), (1, MAIN_TAGS, ("main",))):
        for name, values in (("tag", sorted(tags)), ("kind", words)):
            for v in values:
                own["f", s, name, v] += PRIOR
    for group, prior in EDGE_PRIOR.items():
        for a in (0, 1):
            for b in (0, 1):
                own["e", group, a, b] += prior[a][b]
    values: dict[str, set] = {}
    for key in own:
        if key[0] == "f":
            values.setdefault(key[2], set()).add(key[3])
    ratio: dict[str, dict] = {}
    for name, seen in values.items():
        all_ = [sum(own["f", s, name, v] for v in seen) + len(seen) + 1 for s in (0, 1)]
        # evidence per feature, content against not; values that are new to the model say nothing
        ratio[name] = {v: math.log((own["f", 1, name, v] + 1) / all_[1]) - math.log((own["f", 0, name, v] + 1) / all_[0]) for v in sorted(seen, key=str)}
    for name, most in CLIP_FEATURE.items():
        for v, x in ratio.get(name, {}).items():
            if v not in OTHER_TAGS | MAIN_TAGS:  # these say what they are
                bound = 3.0 if v in FRAME else most
                ratio[name][v] = max(-bound, min(bound, x))
    edge = {g: [own["e", g, a, b] / (own["e", g, a, 0] + own["e", g, a, 1]) for a in (0, 1) for b in (0, 1)] for g in EDGE_PRIOR}
    if edge["plain"][2] < LEAST_LEAVE:
        edge["plain"][2:] = LEAST_LEAVE, 1 - LEAST_LEAVE
    return {"ratio": ratio, "edge": edge}


def marginals(nodes: list[Node], model: dict) -> list[float]:
    """P(content) of each node by sum-product: messages up, then down."""
    ratio, edge = model["ratio"], model["edge"]
    n = len(nodes)
    own = [math.exp(max(-CLIP, min(CLIP, sum(ratio.get(name, {}).get(value, 0.0) for name, value in f)))) for f in features(nodes)]
    # beliefs as odds-free pairs (no, yes), scaled to sum to 1
    below = [(1 / (1 + x), x / (1 + x)) for x in own]
    up: list = [None] * n
    tie = [edge[g] for g in edge_groups(nodes)]
    for k in range(n - 1, 0, -1):
        e00, e01, e10, e11 = tie[k]
        no, yes = below[k]
        m0, m1 = e00 * no + e01 * yes, e10 * no + e11 * yes
        up[k] = (m0, m1)
        p = nodes[k].parent
        a, b = below[p][0] * m0, below[p][1] * m1
        s = a + b
        below[p] = (a / s, b / s)
    belief = list(below)
    a, b = below[0][0] * 0.999, below[0][1] * 0.001  # a page as a whole is not its article
    belief[0] = (a / (a + b), b / (a + b))
    for k in range(1, n):
        e00, e01, e10, e11 = tie[k]
        no, yes = belief[nodes[k].parent]
        m0, m1 = up[k]
        no, yes = no / m0, yes / m1  # the parent without this child's message
        a, b = below[k][0] * (no * e00 + yes * e10), below[k][1] * (no * e01 + yes * e11)
        s = a + b
        belief[k] = (a / s, b / s)
    return [b for _, b in belief]


def extract(page: str | None, model: dict) -> str:
    """The page's main text, one block a line."""
    if not page:
        return ""
    nodes, texts = parse(page)
    keep = [p > 0.5 for p in marginals(nodes, model)]
    blocks: list[str] = []
    now: list[str] = []
    for element, raw in [*texts, (0, None)]:
        if raw is None and now:
            if line := " ".join(entities.unescape("".join(now)).split()):
                blocks.append(line)
            now = []
        elif raw is not None and keep[element]:
            now.append(raw)
    return "\n".join(blocks)


def _count(batches):
    counts: Counter = Counter()
    for b in batches:
        for page in b.column(0).to_pylist():
            nodes, _ = parse(page or "")
            states = labels(nodes)
            if states is None:
                continue
            for n, s, f, g in zip(nodes, states, features(nodes), edge_groups(nodes), strict=True):
                for name, value in f:
                    counts["f", s, name, value] += 1
                if n.parent >= 0:
                    counts["e", g, states[n.parent], s] += 1
    keys = sorted(counts, key=str)
    kinds = [k[0] for k in keys]
    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([k[1] if k[0] == "f" else k[3] for k in keys], pa.int32()), pa.array([str(k[2] if k[0] == "f" else k[1]) for k in keys], pa.string()), pa.array([str(k[3] if k[0] == "f" else k[2]) for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())], ["what", "state", "name", "value", "n"])


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> dict:
    """Potentials from the ``sample_pages`` different pages of smallest hash."""
    drawn = bounded_sample(pages.where(F.col(html_col).isNotNull()).select(F.col(html_col).alias("html")), "html", sample_pages, 9).select("html")
    rows = drawn.mapInArrow(_count, "what string, state int, name string, value string, n bigint").groupBy("what", "state", "name", "value").agg(F.sum("n").alias("n")).collect()  # a count per tag and feature value
    counts: Counter = Counter()
    for r in rows:
        if r["what"] == "e":
            counts["e", r["name"], int(r["value"]), r["state"]] += r["n"]
        else:
            counts["f", r["state"], r["name"], r["value"] if r["name"] in ("tag", "kind") else int(r["value"])] += r["n"]
    return train(counts)


def main_text(pages: DataFrame, model: dict, html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` and ``n_chars`` (code points)."""
    names = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def run(batches):
        for b in pieces(batches, len(names)):
            out = [extract(p, model) for p in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], [*b.schema.names[: len(names)], "text", "n_chars"])

    rows = pages.select(*[F.col(f"`{c}`") for c in names], F.col(html_col).cast("string").alias("_html"))
    shape = rows.drop("_html").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("bigint")}).schema
    return rows.mapInArrow(run, shape)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Fit on a bounded sample, extract every whole page."""
    return main_text(pages.select("page_id", "url", "html"), fit(pages))
