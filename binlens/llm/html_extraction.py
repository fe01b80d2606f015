"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: the text between two block boundaries, with its ancestor tags.
Scripts, styles, the head and markup comments are no blocks.  Each block has features from its
ancestor tags, from the class, id and role words along its path, and from its text (length, share of
links, punctuation).  The field has a weight per feature and label (main text or not) and per pair of
neighbouring labels; it is trained by maximum likelihood on labelled pages and decoded by Viterbi.
The input has no page labels, so the labelled pages are composed from a grammar of page parts whose
labels are known (``labelled_pages``).

Character references are decoded, white space in a block becomes one blank, blocks are joined by
one line break in page order.  Null and empty pages, and pages without main text, give an empty text.
Broken or cut markup is read as far as it goes.  Equal and repeated rows are handled one by one.
Extra columns are ignored; ``passthrough`` names those that are returned.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binlens.llm.common import with_fields

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|title|iframe|svg)\b[^>]*+(?:>|\Z).*?(?:</(?P=raw)\s*+[^>]*+(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b|(display:\s*none)", re.I)
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 header footer nav aside ul ol li dl dt dd table thead tbody"
    " tfoot tr td th caption blockquote pre figure figcaption form fieldset legend label button select option textarea"
    " address details summary center hr menu dialog head".split())
_VOID = frozenset("br hr img input meta link source wbr area base col embed track param".split())
# start tags that close an open one, up to the nearest of the stoppers
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
# words of class, id and role by what they stand for
GROUPS = {
    "nav": "nav navbar navigation menu menus submenu breadcrumb breadcrumbs topbar toolbar tabs pager pagination toc skip",
    "head": "header masthead logo brand branding top hero",
    "foot": "footer foot bottom copyright legal colophon imprint contentinfo",
    "side": "side sidebar aside rail widget widgets related recommended recommend popular trending more teaser complementary",
    "ad": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion affiliate",
    "notice": "cookie cookies consent gdpr notice alert banner popup modal overlay paywall disclaimer message toast announcement",
    "form": "form search login signup subscribe newsletter register contact poll input",
    "comment": "comment comments commentlist reply replies respond disqus discussion review reviews thread",
    "social": "share sharing social follow like tweet facebook tags meta byline author date",
    "main": "article content post entry story body main text prose articlebody page paragraph lead",
}
_GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}


@dataclass
class Block:
    path: tuple      # ancestors' tags and groups of class words, once each; the last tag
    text: str
    link_chars: int


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[str] = []
    opened: Counter[str] = Counter()
    paths: list[tuple] = [((), None)]  # an element that adds no feature shares its parent's tuple
    buffer: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = "".join(buffer)
            buffer.clear()
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text and not opened["head"]:
                out.append(Block(paths[-1], text, linked))
            linked = 0

    def pop(n: int) -> None:
        opened.subtract(stack[n:])
        del stack[n:], paths[n + 1:]

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            buffer.append(text)
            if links:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "a":
                links = 0 if m["end"] else 1
            elif tag == "br":
                buffer.append(" ")
            continue
        flush()
        if m["end"]:
            if opened[tag]:
                pop(next(i for i in range(len(stack) - 1, -1, -1) if stack[i] == tag))
            if tag in ("li", "p", "div", "ul"):
                links = 0
            continue
        if stack and stack[-1] == "p":
            pop(len(stack) - 1)
        if tag in _CLOSES:
            closed, stops = _CLOSES[tag]
            for i in range(len(stack) - 1, -1, -1) if any(opened[x] for x in closed) else ():
                if stack[i] in stops:
                    break
                if stack[i] in closed:
                    pop(i)
                    break
        if tag in _VOID:
            continue
        found = [f"t={tag}"]
        if attrs := m["attrs"]:
            for a in _ATTRIBUTE.finditer(attrs):
                if a[4] or a[5]:
                    found.append("g=hidden")
                else:
                    for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", a[1] or a[2] or a[3] or "").lower()):
                        if g := _GROUP_OF.get(w):
                            found.append(f"g={g}")
        stack.append(tag)
        opened[tag] += 1
        above = paths[-1][0]
        new = [f for f in found if f not in above]
        paths.append(((*above, *new) if new else above, f"o={tag}"))
    flush()
    return out


_ENDS = (".", "!", "?", "…", ".\"", ".”", ".»", "。", ":")


def text_features(b: Block) -> list[str]:
    n = b.text.count(" ") + 1
    share = b.link_chars / max(1, len(b.text))
    low = b.text.lower()
    return [f"n={'1' if n < 4 else '4' if n < 10 else '10' if n < 25 else '25'}",
            f"l={'0' if share < 0.05 else '1' if share < 0.5 else '2'}",
            f"e={b.text.endswith(_ENDS)}",
            *(["x=rights"] if "©" in low or "all rights reserved" in low or "copyright" in low else []),
            *(["x=cookie"] if "cookie" in low else [])]


def path_features(path: tuple) -> list[str]:
    """Ancestors' features once each, and the last tag as the own one."""
    above, own = path
    return [*above, own] if own else [*above]


# ---- labelled pages -------------------------------------------------------------------------------------------
PAGES = 400
_SYLLABLES = "ka lo mi ren tas vel dor an ish pel gra su on ti bar que fo nem ul ze".split()


_LABEL = {0: "\ue000", 1: "\ue001"}


def labelled_pages(pages: int = PAGES, seed: int = 7) -> list[str]:
    """Pages composed from parts whose labels are known; each block's text begins with the mark of its label."""
    r = Random(seed)

    def word() -> str:
        return "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 3)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(r.randint(a, b))).capitalize()

    def prose(a: int = 6, b: int = 90) -> str:
        return ". ".join(words(4, 14) for _ in range(r.randint(1, max(1, r.randint(a, b) // 9)))) + "."

    def mark(text: str, label: int) -> str:
        return _LABEL[label] + text

    def put(tag: str, text: str, label: int, attrs: str = "", link: bool = False) -> str:
        text = mark(text, label)
        return f"<{tag}{attrs}>" + (f'<a href="/{len(text)}">{text}</a>' if link else text) + f"</{tag}>"

    def links(n: int, tag: str = "li") -> str:
        return "".join(put(tag, words(1, 3), 0, link=True) for _ in range(n))

    def cls(words_: str) -> str:
        w = r.choice(words_.split())
        return r.choice([f' class="{w}"', f' id="{w}"', f' class="{word()} {w}"', f' class="{w}-{word()}"'])

    def boiler(kind: str) -> str:
        group = cls(GROUPS[kind])
        if kind == "nav":
            tag, attrs = r.choice([("nav", ""), ("nav", group), ("div", group), ("ul", group)])
            return f"<{tag}{attrs}><ul>{links(r.randint(2, 7))}</ul></{tag}>"
        if kind == "head":
            tag, attrs = r.choice([("header", ""), ("header", group), ("div", group)])
            inner = put(r.choice(["div", "p", "h2"]), words(1, 6), 0) + r.choice(["", put("p", prose(4, 12), 0)])
            return f"<{tag}{attrs}>{inner}</{tag}>"
        if kind == "foot":
            tag, attrs = r.choice([("footer", ""), ("footer", group), ("div", group)])
            text = r.choice(["© " + words(2, 8), "Copyright " + words(2, 8), words(2, 6) + " · " + prose(5, 30), prose(5, 40)])
            return f"<{tag}{attrs}>{mark(text, 0)}" + r.choice(["", f"<ul>{links(3)}</ul>"]) + f"</{tag}>"
        if kind == "side":
            tag, attrs = r.choice([("aside", ""), ("aside", group), ("div", group), ("section", group)])
            body = put("h3", words(1, 3), 0) + r.choice([f"<ul>{links(r.randint(2, 5))}</ul>", put("p", prose(6, 50), 0)])
            return f"<{tag}{attrs}>{body}</{tag}>"
        if kind == "form":
            tag, attrs = r.choice([("form", ""), ("form", group), ("div", group)])
            return f"<{tag}{attrs}>" + put("label", words(1, 4), 0) + "<input name=q>" + put("button", words(1, 2), 0) + r.choice(
                ["", put("p", prose(5, 20), 0)]) + f"</{tag}>"
        if kind == "comment":
            tag = r.choice(["div", "section", "ol"])
            many = "".join(f"<div{cls('comment reply review')}>" + put("p", words(1, 2), 0) + put("p", prose(5, 60), 0)
                           + "</div>" for _ in range(r.randint(1, 3)))
            return f"<{tag}{group}>{r.choice(['', put('h3', words(1, 2), 0)])}{many}</{tag}>"
        if kind == "social":
            return f"<div{group}>" + r.choice([f"<ul>{links(3)}</ul>", put("p", words(1, 4), 0)]) + "</div>"
        text = r.choice([prose(5, 60), words(3, 12), "We use cookies. " + prose(5, 30)] if kind == "notice" else [prose(5, 60), words(3, 10)])
        tag = r.choice(["div", "div", "section", "p"])
        attrs = r.choice([group, ' role="alert"' if kind == "notice" else group])
        if tag == "p":
            return put("p", text, 0, attrs)
        if r.random() < 0.5:
            return f"<{tag}{attrs}>{mark(text, 0)}</{tag}>"
        return f"<{tag}{attrs}>" + put("p", text, 0) + f"</{tag}>"

    def article() -> str:
        opening, closing = r.choice([
            ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
            (f"<article{cls(GROUPS['main'])}>", "</article>"), (f"<div{cls('content post entry story article prose')}>", "</div>"),
            (f"<div id=main><div{cls('body text articlebody content')}>", "</div></div>"), ("<div>", "</div>"), ("", ""),
            (f"<section{cls('content entry article')}>", "</section>")])
        para = r.choice(["p", "p", "p", "p", "div"])
        title = put(r.choice(["h1", "h1", "h2"]), words(2, 12), 1)
        if "article" in opening and r.random() < 0.2:
            title = f"<header>{title}</header>"
        body = [opening, title]
        if "article" in opening and r.random() < 0.3:
            body.append(boiler("social"))
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.74:
                body.append(put(para, prose(), 1))
            elif kind < 0.80:
                body.append(put(para, words(1, 6) + r.choice(["", "."]), 1))
            elif kind < 0.86:
                body.append(put(r.choice(["h2", "h3"]), words(1, 6), 1))
            elif kind < 0.91:
                body.append("<ul>" + "".join(put("li", r.choice([prose(4, 15), words(2, 8)]), 1) for _ in range(r.randint(2, 4))) + "</ul>")
            elif kind < 0.94:
                body.append("<blockquote>" + put("p", prose(5, 40), 1) + "</blockquote>")
            elif kind < 0.97:
                body.append("<table><tr>" + "".join(put(r.choice(["td", "th"]), words(1, 4), 1) for _ in range(3)) + "</tr></table>")
            else:
                body.append(boiler(r.choice(["ad", "side", "notice"])))
        return "".join([*body, closing])

    out = []
    for _ in range(pages):
        before = [boiler(k) for k in r.sample(["nav", "head", "notice", "ad", "form", "social", "side"], r.randint(1, 4))]
        middle = article()
        after = [boiler(k) for k in r.sample(["comment", "side", "ad", "form", "nav", "notice", "social"], r.randint(0, 4))] + [boiler("foot")]
        out.append("".join(["<html><head><title>x</title></head><body>", *before, middle, *after, "</body></html>"]))
    return out


# ---- the field ------------------------------------------------------------------------------------------------
@dataclass
class Field:
    weights: dict[str, float]  # main text less other text
    bias: float
    transitions: np.ndarray    # 2 x 2
    start: np.ndarray          # 2

    def emission(self, b: Block, known: dict) -> float:
        key = b.path
        if (s := known.get(key)) is None:
            s = known[key] = sum(self.weights.get(f, 0.0) for f in path_features(key)) + self.bias
        return s + sum(self.weights.get(f, 0.0) for f in text_features(b))

    def decode(self, found: list[Block], known: dict) -> list[int]:
        """Viterbi; ties go to other text."""
        if not found:
            return []
        (t00, t01), (t10, t11) = self.transitions.tolist()
        other, main = float(self.start[0]), float(self.start[1]) + self.emission(found[0], known)
        back = []
        for b in found[1:]:
            e = self.emission(b, known)
            from_other, from_main = (0 if other + t00 >= main + t10 else 1), (0 if other + t01 >= main + t11 else 1)
            back.append((from_other, from_main))
            other, main = max(other + t00, main + t10), max(other + t01, main + t11) + e
        label = 1 if main > other else 0
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def read_labels(page: str) -> tuple[list[Block], list[int]]:
    """Blocks of a labelled page without the marks, and their labels."""
    found = blocks(page)
    return [Block(b.path, b.text[1:], b.link_chars) for b in found], [int(b.text[0] == _LABEL[1]) for b in found]


def train(pages: list[str], steps: int = 300, rate: float = 0.1, ridge: float = 2e-3) -> Field:
    """Maximum likelihood by Adam, all pages padded and run through forward-backward side by side."""
    chains = [read_labels(page) for page in pages]
    names = sorted({f for found, _ in chains for b in found for f in (*path_features(b.path), *text_features(b))})
    index = {f: i for i, f in enumerate(names)}
    longest = max(len(found) for found, _ in chains)
    x = np.zeros((len(chains), longest, len(names) + 1))
    y = np.zeros((len(chains), longest), int)
    real = np.zeros((len(chains), longest), bool)
    for i, (found, labels) in enumerate(chains):
        for t, b in enumerate(found):
            for f in (*path_features(b.path), *text_features(b)):
                x[i, t, index[f]] = 1
            x[i, t, -1] = 1
            y[i, t], real[i, t] = labels[t], True
    n, last = len(chains), real.sum(axis=1) - 1
    truth = np.eye(2)[y]
    pairs_true = np.einsum("ita,itb,it->ab", truth[:, :-1], truth[:, 1:], real[:, 1:])
    theta = np.zeros(len(names) + 1 + 4 + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, trans, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        e = np.stack([np.zeros(x.shape[:2]), x @ w], axis=2)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = start + e[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + trans, axis=1) + e[:, t]
        for t in range(longest - 2, -1, -1):
            nxt = np.logaddexp.reduce(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], nxt, 0)
        z = np.logaddexp.reduce(alpha[np.arange(n), last], axis=1)
        mark = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + trans + (e + beta)[:, 1:, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
        gradient = np.concatenate([np.einsum("itf,it->f", x, (y - mark[..., 1]) * real),
                                   (pairs_true - pair.sum(axis=(0, 1))).ravel(), (truth[:, 0] - mark[:, 0]).sum(axis=0)]) / n
        gradient -= ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(dict(zip(names, theta[:-7].tolist())), float(theta[-7]), theta[-6:-2].reshape(2, 2), theta[-2:])


def main_text(page: str | None, field: Field, known: dict) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, label in zip(found, field.decode(found, known)) if label)


def extract(pages: DataFrame, field: Field, page: str = "html", passthrough: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``passthrough`` columns, text, n_chars of every whole page."""
    shared = pages.sparkSession.sparkContext.broadcast(field)  # some hundred weights
    rows = pages.select(*passthrough, F.col(page).cast("string").alias("__page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if len(known) > 50_000:
                    known = {}
                texts = [main_text(p, shared.value, known) for p in part.column("__page").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*part.schema.names[:-1], "text", "n_chars"])

    return rows.mapInArrow(run, with_fields(rows, "text string, n_chars long"))
