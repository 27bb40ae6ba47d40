"""Main text of web pages with a tree-structured graphical model.

A page's block elements form a tree. Each node is main content or not; it has an observation (element, words of its
class, id and role, length, links, punctuation, share of the page) and each parent-child pair a potential that
depends on the child's kind. Both are learned by counting over labelled pages, which are made by rule from many ways to
mark up the parts of a page (``labelled_pages``). Sum-product messages go up from the leaves to the root and down
again; the product at a node is its exact marginal. Text of nodes more likely content than not is the main text.

Defined results: null html is empty and gives an empty text; white space inside a block becomes one space; blocks
are joined in page order by an empty line; unclosed or crossed elements are closed as browsers do for blocks; text
without any markup is judged like a block of its own; nothing else is dropped or cut, however long the page.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import defaultdict
from functools import partial
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termfold.llm.shared import ship_package, table

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.S)
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.!?,;:]")
_PARTS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text.
SILENT = frozenset("script style template noscript svg math iframe object canvas head title textarea select option datalist audio video".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr br img input button meter progress output picture source map area".split()
)
#: A start of these closes an open paragraph.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section summary table ul li dd dt td th tr".split()
)
#: Same for items of lists and tables: open element that is closed, and what bounds the search for it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
P_BOUNDS = frozenset("article aside section div main body td th li blockquote table form header footer nav figure".split())

#: Words in class, id, role or label that tell what a part is for; the first group that has one counts.
HINTS = {
    "comment": "comment comments reply replies respond disqus discussion commentlist".split(),
    "ad": "ad ads advert advertisement adsense banner promo promotion sponsor sponsored outbrain taboola".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall warning announcement dialog".split(),
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs topbar skip toolbar".split(),
    "foot": "footer foot copyright legal colophon bottom contentinfo".split(),
    "head": "header masthead head logo brand top".split(),
    "side": "side sidebar aside widget rail complementary tags".split(),
    "share": "share sharing social newsletter subscribe subscription follow signup login search searchbox form".split(),
    "related": "related recommended recommendations more popular trending teaser also".split(),
    "content": "content article post entry story body text main page prose".split(),
}
_HINT = {w: g for g, words in reversed(HINTS.items()) for w in words}
_RANK = {g: i for i, g in enumerate(HINTS)}


class Node:
    __slots__ = ("tag", "hint", "parent", "children", "blocks", "mark", "chars", "links", "stops")

    def __init__(self, tag: str, hint: str, parent: int, mark: str):
        self.tag, self.hint, self.parent, self.mark = tag, hint, parent, mark
        self.children: list[int] = []
        self.blocks: list[tuple[int, str]] = []      # place on the page, text
        self.chars = self.links = self.stops = 0


def _hint(tag: str, attributes: str) -> tuple[str, str]:
    """(group of the hints, mark of a labelled page)."""
    if not attributes.strip():
        return "none", ""
    best, mark = None, ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "data-mark":
            mark = value
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            best = "notice"
        elif name in ("class", "id", "role", "aria-label") and tag not in ("html", "body"):
            for w in _PARTS.findall(value):
                g = _HINT.get(w)
                if g and (best is None or _RANK[g] < _RANK[best]):
                    best = g
    return best or "none", mark


def parse(page: str) -> list[Node]:
    """Block elements in page order, the root first; a node's parent comes before it."""
    nodes = [Node("root", "none", -1, "")]
    stack: list[tuple[str, int]] = [("root", 0)]      # open elements, with the block that holds their text
    places: defaultdict[str, list[int]] = defaultdict(list)     # where in the stack each kind of element is open
    silent = links = place = 0
    text: list[str] = []
    holder = 0

    def flush():
        nonlocal place
        if text:
            joined = _SPACE.sub(" ", "".join(text)).strip()
            text.clear()
            if joined:
                nodes[holder].blocks.append((place, joined))
                place += 1

    def close_to(k: int):
        nonlocal silent, links, holder
        while len(stack) > k:
            tag, _ = stack.pop()
            places[tag].pop()
            if tag in SILENT:
                silent -= 1
            if tag == "a":
                links -= 1
            if tag not in INLINE:
                flush()
        holder = stack[-1][1]

    def opened(tag: str):
        places[tag].append(len(stack))
        stack.append((tag, holder))

    def last(tags) -> int:
        """Place of the innermost open element of these kinds, 0 without one."""
        return max((places[t][-1] for t in tags if places[t]), default=0)

    pos, size = 0, len(page)
    while pos < size:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m.group(2) or m.group(5)
        if tag is None:
            run = m.group()
            if run[0] == "<" and len(run) > 1 or silent:
                continue
            run = entities.unescape(run)
            text.append(run)
            n = len(run.strip())
            node = nodes[holder]
            node.chars += n
            if links:
                node.links += n
            else:
                node.stops += len(_PUNCTUATION.findall(run))
            continue
        tag, closing, attributes = tag.lower(), m.group(1) or m.group(4), (m.group(3) if m.group(2) else m.group(6)) or ""
        if closing:
            if tag == "br":
                text.append(" ")
            if places[tag]:
                close_to(places[tag][-1])
            continue
        if tag in ("br", "wbr", "hr") or tag in VOID:
            if tag not in INLINE:
                flush()
            text.append(" " if tag != "wbr" else "")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else size
            continue
        if tag in CLOSES_P and last("p") > last(P_BOUNDS):
            close_to(last("p"))
        if tag in CLOSES:
            ends, bounds = CLOSES[tag]
            while (k := last(ends)) > last(bounds):
                close_to(k)
                if tag != "tr":
                    break
        if tag == "body" and places["head"]:
            close_to(places["head"][0])
        if attributes.endswith("/") and tag in SILENT:
            continue
        if tag in SILENT:
            silent += 1
        if tag == "a":
            links += 1
        if tag in INLINE:
            opened(tag)
            continue
        flush()
        hint, mark = _hint(tag, attributes)
        nodes.append(Node(tag, hint, holder, mark))
        nodes[holder].children.append(len(nodes) - 1)
        holder = len(nodes) - 1
        opened(tag)
    close_to(1)
    flush()
    if not any(n.tag == "body" for n in nodes):
        nodes[0].tag = "body"
    return nodes


_KNOWN = frozenset("root html body nav header footer aside article main section div p h1 h2 h3 h4 h5 h6 ul ol li form table tr td th blockquote pre figure figcaption dl dt dd address fieldset details".split())


_MAIN = frozenset(("article", "main", "content"))
_TELLING = frozenset("nav header footer aside form article main".split())


def _step(value: float, edges) -> int:
    return sum(value >= e for e in edges)


def observations(nodes: list[Node]) -> list[tuple]:
    """What is seen at each node, as discrete values."""
    chars, links, stops = ([getattr(n, k) for n in nodes] for k in ("chars", "links", "stops"))
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
    whole = max(1, chars[0])
    out, under = [], []
    for i, n in enumerate(nodes):
        tag = n.tag if n.tag in _KNOWN else "other"
        # the nearest part of the page, from this node up, that says what it is
        above = under[n.parent] if i else "none"
        own = n.hint if n.hint != "none" else tag if tag in _TELLING else above
        under.append(above if own in _MAIN and above != "none" and above not in _MAIN else own)
        out.append((
            ("tag", tag), ("hint", n.hint), ("under", under[i]), ("own", tag in ("p", "li", "td", "div", "section"), _step(n.chars, (1, 20, 60, 150, 400))),
            ("links", _step(links[i] / max(1, chars[i]), (0.01, 0.2, 0.5, 0.9)) if chars[i] else -1),
            ("stops", _step(stops[i], (1, 2, 5, 20))), ("share", _step(chars[i] / whole, (0.02, 0.2, 0.5, 0.8))),
        ))
    return out


def _kind(n: Node) -> tuple:
    """What a parent-child potential depends on."""
    return (n.tag if n.tag in _KNOWN else "other", n.hint)


class Model:
    """Log potentials: of observations by label, and of (parent label, label) by the child's kind."""

    def __init__(self, pages: list[str], smooth: float = 0.5):
        seen = [defaultdict(lambda: smooth) for _ in range(2)]
        total = [defaultdict(lambda: smooth * 8) for _ in range(2)]
        step = defaultdict(lambda: [[smooth, smooth], [smooth, smooth]])
        by_tag = defaultdict(lambda: [[smooth, smooth], [smooth, smooth]])
        self.keys: set = set()
        for page in pages:
            nodes = parse(page)
            labels = [0] * len(nodes)
            for i, n in enumerate(nodes):
                labels[i] = 1 if n.mark == "main" else 0 if n.mark == "skip" else labels[n.parent] if i else 0
            for i, (n, o) in enumerate(zip(nodes, observations(nodes))):
                for f in o:
                    seen[labels[i]][f] += 1
                    total[labels[i]][f[0]] += 1
                    self.keys.add(f)
                if i:
                    step[_kind(n)][labels[n.parent]][labels[i]] += 1
                    by_tag[_kind(n)[0]][labels[n.parent]][labels[i]] += 1
        #: log odds of content for an observation; those never seen say nothing
        self.unary = {f: log(seen[1][f] / total[1][f[0]]) - log(seen[0][f] / total[0][f[0]]) for f in self.keys}
        self.step = {k: self._rows(v) for k, v in step.items()}
        self.by_tag = {k: self._rows(v) for k, v in by_tag.items()}
        self.any = self._rows([[9.0, 1.0], [1.0, 9.0]])

    @staticmethod
    def _rows(counts):
        return tuple(tuple(log(c / sum(row)) for c in row) for row in counts)

    def potential(self, n: Node):
        kind = _kind(n)
        return self.step.get(kind) or self.by_tag.get(kind[0]) or self.any

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content at each node, by messages up the tree and down again."""
        n = len(nodes)
        own = [(0.0, sum(self.unary.get(f, 0.0) for f in o)) for o in observations(nodes)]
        up = [list(x) for x in own]                                         # belief from below
        sent = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            s, (a, b) = self.potential(nodes[i]), up[i]
            sent[i] = (_add(s[0][0] + a, s[0][1] + b), _add(s[1][0] + a, s[1][1] + b))
            p = up[nodes[i].parent]
            p[0] += sent[i][0]
            p[1] += sent[i][1]
        full = [None] * n
        full[0] = tuple(up[0])
        for i in range(1, n):
            s, p, m = self.potential(nodes[i]), full[nodes[i].parent], sent[i]
            a, b = p[0] - m[0], p[1] - m[1]                                 # the parent without this child
            full[i] = (up[i][0] + _add(s[0][0] + a, s[1][0] + b), up[i][1] + _add(s[0][1] + a, s[1][1] + b))
        return [1.0 / (1.0 + exp(min(500.0, max(-500.0, a - b)))) for a, b in full]

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        nodes = parse(page)
        blocks = [x for n, p in zip(nodes, self.marginals(nodes)) if n.blocks and p >= 0.5 for x in n.blocks]
        return "\n\n".join(t for _, t in sorted(blocks))


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return max(a, b) + log(1.0 + exp(-abs(a - b)))


def labelled_pages(count: int = 400, seed: int = 11) -> list[str]:
    """Pages made by rule; data-mark says which elements are main content, and which parts inside of it are not."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulnrstdm") for _ in range(r.randint(2, 9)))
    phrase = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda a=3, b=16: phrase(a, b).capitalize() + r.choice([".", ".", ",", "!", "?"])
    link = lambda: f'<a href="/{word()}">{phrase(1, 3)}</a>'

    def named(*names) -> str:
        return r.choice(["", f' class="{r.choice(names)}"', f' class="{r.choice(names)}"', f' id="{r.choice(names)}"', f' class="{word()} {r.choice(names)}"'])

    def must(*names) -> str:
        return r.choice([f' class="{r.choice(names)}"', f' id="{r.choice(names)}"', f' class="{word()} {r.choice(names)}-{word()}"'])

    def linked(tag: str) -> str:
        items = "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 9)))
        return r.choice([f"<ul>{items}</ul>", " ".join(link() for _ in range(r.randint(2, 8)))]) if tag else items

    def nav() -> str:
        return r.choice([f"<nav{named('nav', 'menu')}>{linked('ul')}</nav>", f"<div{must('nav', 'menu', 'breadcrumb', 'navbar')}>{linked('ul')}</div>"])

    def head() -> str:
        inner = r.choice([f"<h1>{phrase(1, 3)}</h1>", f"<p>{phrase(2, 6)}</p>", f"<div class=\"logo\">{phrase(1, 2)}</div>"]) + r.choice(["", nav()])
        return r.choice([f"<header{named('header', 'masthead')}>{inner}</header>", f"<div{must('header', 'masthead', 'topbar')}>{inner}</div>"])

    def foot() -> str:
        inner = r.choice([f"&copy; {word()}.example &middot; {sentence()}", f"<p>{sentence()}</p>{linked('ul')}", f"<p>{phrase(2, 8)}</p>"])
        return r.choice([f"<footer{named('footer')}>{inner}</footer>", f"<div{must('footer', 'copyright', 'legal')}>{inner}</div>"])

    def side() -> str:
        inner = f"<h3>{phrase(1, 3)}</h3>" + r.choice([linked("ul"), f"<p>{sentence()}</p>", f"<p>{sentence()} {sentence()}</p>{linked('ul')}"])
        return r.choice([f"<aside{named('sidebar', 'widget')}>{inner}</aside>", f"<div{must('sidebar', 'widget', 'related', 'popular')}>{inner}</div>"])

    def ad() -> str:
        inner = r.choice([sentence(), f"{sentence()} {sentence()}", f"<p>{sentence()}</p>", link()])
        return f"<div{must('ad', 'ads', 'advert', 'banner', 'sponsored', 'promo')}>{inner}</div>"

    def notice() -> str:
        inner = r.choice([f"<p>{sentence()} {link()}</p>", f"{sentence()} <button>{word()}</button>", f"<p>{sentence()}</p><p>{sentence()}</p>"])
        return r.choice([f"<div{must('cookie', 'consent', 'notice', 'popup', 'modal')}>{inner}</div>", f'<div role="alert">{inner}</div>', f"<section{must('cookie', 'notice')}>{inner}</section>"])

    def form() -> str:
        return f"<form{named('search', 'newsletter', 'subscribe')}><label>{phrase(1, 3)}</label><input name=q><p>{phrase(2, 6)}</p><button>{word()}</button></form>"

    def comments() -> str:
        one = lambda: r.choice(["<li{}>{}</li>", "<div{}>{}</div>", "<article{}>{}</article>"]).format(named("comment"), f"<p>{' '.join(sentence() for _ in range(r.randint(1, 4)))}</p>")
        inner = f"<h3>{phrase(1, 2)}</h3>" + "".join(one() for _ in range(r.randint(1, 5)))
        return r.choice([f"<section{must('comments', 'discussion', 'replies')}>{inner}</section>", f"<div{must('comments', 'comment', 'disqus')}>{inner}</div>"])

    def share() -> str:
        return f"<div{must('share', 'social', 'newsletter', 'tags', 'related')}>{r.choice([linked('ul'), phrase(1, 5)])}</div>"

    def paragraph() -> str:
        body = " ".join(sentence(1, 22) for _ in range(r.choice([1, 1, 1, 2, 3, 5, 8])))
        if r.random() < 0.15:
            body += " " + link() + " " + sentence()
        if r.random() < 0.12:
            return f"<p><b>{sentence(1, 6)}<br>"
        return r.choice(["<p>{}</p>"] * 8 + ["<p>{}", "<p><em>{}</em></p>", "<div>{}</div>"]).format(body)

    def main() -> str:
        parts = [f"<h1>{phrase(1, 9)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12])):
            x = r.random()
            if x < 0.74:
                parts.append(paragraph())
            elif x < 0.82:
                parts.append(f"<h{r.choice('2234')}>{phrase(1, 6)}</h2>".replace("</h2>", "") + "</h2></h3></h4>")
            elif x < 0.9:
                parts.append("<ul>" + "".join(f"<li>{phrase(1, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.93:
                parts.append(f"<blockquote><p>{sentence()}</p></blockquote>")
            elif x < 0.95:
                parts.append(f"<pre>{phrase(2, 12)}</pre>")
            elif x < 0.97:
                parts.append(f"<table><tr><td>{phrase(1, 4)}</td><td>{phrase(1, 4)}</td></tr></table>")
            else:
                parts.append(f"<figure><figcaption>{sentence()}</figcaption></figure>")
        return "".join(parts)

    def mark(part: str, what: str) -> str:
        return re.sub(r"^<(\w+)", rf'<\1 data-mark="{what}"', part)

    def page() -> str:
        inside = main()
        for make in r.sample([ad, share, side, comments, form], r.choice([0, 0, 0, 1, 1, 2])):
            extra = mark(make(), "skip")
            inside = inside + extra if r.random() < 0.7 or "</p>" not in inside else inside.replace("</p>", "</p>" + extra, 1)
        x = r.random()
        if x < 0.55:
            body = f'<article data-mark="main"{named("post", "entry", "story")}>{inside}</article>'
        elif x < 0.7:
            body = f'<main data-mark="main"{named("content")}>{inside}</main>'
        elif x < 0.75:
            body = f'<section data-mark="main"{must("content", "article", "story")}>{inside}</section>'
        elif x < 0.95:
            body = f'<div data-mark="main"{must("content", "article", "post", "entry", "story", "main")}>{inside}</div>'
        else:
            body = f'<div data-mark="main">{inside}</div>'
        if r.random() < 0.25:
            body = r.choice([f"<main>{body}</main>", f'<div{must("page", "wrapper", "container")}>{body}</div>', f"<section>{body}</section>"])
        if r.random() < 0.08:
            return f'<html><body data-mark="main">{inside}</body></html>'
        before = [make() for make in r.sample([nav, head, ad, notice, form, side], r.randint(0, 4))]
        after = [make() for make in r.sample([foot, side, ad, comments, share, notice, form], r.randint(0, 4))]
        whole = "".join(before) + body + "".join(after) + (foot() if r.random() < 0.5 else "")
        return f"<!DOCTYPE html><html><head><title>{phrase(1, 6)}</title></head><body>{whole}</body></html>"

    return [page() for _ in range(count)]


_models: dict[tuple[int, int], Model] = {}


def trained(count: int = 400, seed: int = 11) -> Model:
    """The model; fitting takes under a second, so each worker fits it once."""
    if (count, seed) not in _models:
        _models[count, seed] = Model(labelled_pages(count, seed))
    return _models[count, seed]


def _extract(batches):
    model = trained()
    for b in batches:
        texts = [model.text(x) for x in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    ship_package(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
