"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read to its leaf blocks: runs of text between block-level tags, each with the
elements around it. Features are the ancestors' tags, the words of their class, id and role
attributes, and figures of the text (length, links, signs). The field labels each block of
a page as main text or not; Viterbi finds the best labelling of the whole page. It is
trained on labelled pages that ``labelled_pages`` composes from a rule: page parts of both
kinds in varying order, nesting and markup, every block with its known label.
"""

from __future__ import annotations

import functools
import html as html_lib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_or_empty
from .crf import train

#: Elements that start and end a block. Fixed by the markup language.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol optgroup "
    "option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
#: Elements whose content is no text of the page, read up to their end tag.
SKIPPED = frozenset("script style title template iframe svg".split())
#: Elements whose content is text without markup, read up to their end tag.
RAW = frozenset("xmp noembed".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes, and where the search for it ends.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
          "body": ({"head"}, {"html"})}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)", re.S)
_ATTRIBUTE = re.compile(r"(?<![-\w])(class|id|role|itemprop|hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    ancestors: tuple[str, ...]  # features of the elements around it, outermost first
    linked: int  # characters inside links


def element_features(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id, role and itemprop attributes."""
    out = ["t:" + tag]
    if attributes and "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), html_lib.unescape((m[2] or "").strip("\"'"))
            if name == "hidden":
                out.append("a:hidden")
            elif name == "style":
                if re.search(r"display\s*:\s*none", value):
                    out.append("a:hidden")
            else:
                for w in _PART.findall(value):
                    w = w.lower()
                    out.append("a:" + (w[:-1] if len(w) > 3 and w.endswith("s") and not w.endswith("ss") else w))
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in page order; markup errors are read as browsers read them."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[tuple[str, bool]] = []
    links, at, end = 0, 0, len(page)

    def flush() -> None:
        if text:
            whole = " ".join(html_lib.unescape("".join(t for t, _ in text)).split())
            if whole:
                linked = sum(len(t.strip()) for t, a in text if a)
                found.append(Block(whole, tuple(f for _, fs in stack for f in fs), linked))
            text.clear()

    def close(tags: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                flush()
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append((page[at:], links > 0))
            break
        if m.start() > at:
            text.append((page[at:m.start()], links > 0))
        at = m.end()
        if m[2] is None:
            continue
        closing, tag = m[1] == "/", m[2].lower()
        if tag in SKIPPED:
            if not closing and not m[0].endswith("/>"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag in RAW:
            if not closing:
                close({"p"}, {"td", "th", "button"})
                flush()
                stop = re.compile(rf"</{tag}\s*>?", re.I).search(page, at)
                text.append((html_lib.escape(page[at:stop.start() if stop else end]), False))
                stack.append((tag, element_features("pre", "")))
                flush()
                stack.pop()
                at = stop.end() if stop else end
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        elif tag == "br":
            text.append((" ", links > 0))
        elif tag in BLOCK_TAGS or tag == "head":
            if closing:
                if any(t == tag for t, _ in stack):
                    flush()
                    while stack.pop()[0] != tag:
                        pass
                    links = 0
            else:
                close({"p"}, {"td", "th", "button"})
                if tag in CLOSES:
                    close(*CLOSES[tag])
                flush()
                if tag not in VOID:
                    stack.append((tag, element_features(tag, m[3])))
                links = 0
    flush()
    return found


def text_features(block: Block, place: tuple[str, str]) -> list[str]:
    """Figures of a block's own text, alone and with its ``place`` (own tag, telling element)."""
    t = block.text
    words = t.count(" ") + 1
    linked = "l:%d" % min(4, 4 * block.linked // max(1, len(t)))
    return ["w:%d" % min(6, int(math.log2(words) / 1.2)), linked, linked + place[0], linked + place[1],
            "e:" + (t[-1] if t[-1] in ".!?:;,|" else "x"), "c" if "©" in t else "-c", "y" if "|" in t or "·" in t else "-y"]


def kind_of(block: Block | None) -> str:
    """A neighbour in one letter: none, mostly links, short or long."""
    if block is None:
        return "n"
    if 2 * block.linked > len(block.text):
        return "k"
    return "l" if block.text.count(" ") >= 8 else "s"


def around_features(page: list[Block]) -> list[list[str]]:
    """For each block of a page: the kinds of its neighbours, and its place among the page's plain texts."""
    kinds = [kind_of(None), *map(kind_of, page), kind_of(None)]
    most = max((len(b.text) for b, k in zip(page, kinds[1:], strict=False) if k != "k"), default=1)
    return [[f"nb:{a}{k}{c}", f"r:{k}{min(3, 4 * len(b.text) // max(1, most))}"]
            for b, a, k, c in zip(page, kinds, kinds[1:], kinds[2:], strict=False)]


# Labelled pages: words of attributes and the parts of a page, by kind.
_MAIN = "article content post entry body main story text page news".split()
_PARTS = {
    "nav": "nav menu navigation navbar topnav breadcrumb pagination pager toc tab sitemap skip link".split(),
    "header": "header masthead banner topbar logo brand branding site title toolbar".split(),
    "footer": "footer bottom copyright legal colophon imprint credit".split(),
    "aside": "sidebar aside widget related recommended trending popular rail more teaser promo".split(),
    "ad": "ad advert advertisement sponsor sponsored promo promotion banner commercial adsense dfp".split(),
    "notice": "notice cookie consent gdpr alert warning popup modal overlay message subscribe paywall announcement".split(),
    "form": "form newsletter signup login search subscribe contact register feedback field".split(),
    "comments": "comment reply discussion respond disqus thread commentlist reaction responses feedback".split(),
    "share": "share social sharing follow like meta byline tag author".split(),
}
_TAG_OF = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "ad": "div", "notice": "div",
           "form": "form", "comments": "section", "share": "div"}


class _Composer:
    """Composes one labelled page; blocks are listed with their label as they are written."""

    def __init__(self, rng: random.Random):
        self.rng, self.labels = rng, []
        self.nameless = rng.choice([0.0, 0.25, 0.7])  # share of parts whose elements say nothing

    def sentence(self, low: int, high: int) -> str:
        words = ["".join(self.rng.choice("bcdfglmnprst") + self.rng.choice("aeiouéü") for _ in range(
            self.rng.randint(1, 4))) for _ in range(self.rng.randint(low, high))]
        return " ".join(words).capitalize()

    def leaf(self, tag: str, text: str, label: int) -> str:
        self.labels.append(label)
        return f"<{tag}>{text}</{tag}>"

    def unknown(self) -> str:
        """A name that says nothing."""
        return "".join(self.rng.choice("bcdfghklmnprstvwxz") + self.rng.choice("aeiou0123") for _ in range(
            self.rng.randint(2, 4)))

    def wrap(self, kind: str, inner: str, plain: float = 0.5) -> str:
        words = _PARTS[kind]
        if kind in ("nav", "footer", "header", "form") and self.rng.random() < self.nameless:
            # what these hold tells them apart without a name
            return f'<div{self.rng.choice(["", f" class={self.unknown()}"])}>{inner}</div>'
        named = f' {self.rng.choice(["class", "id"])}="{self.rng.choice(["", "site-", "page_", "js-", "c-"])}' \
                f'{self.rng.choice(words)}{self.rng.choice(["", "-box", " clearfix", "-inner", "s"])}"'
        if _TAG_OF[kind] != "div" and self.rng.random() < plain:
            return f"<{_TAG_OF[kind]}{named if self.rng.random() < 0.4 else ''}>{inner}</{_TAG_OF[kind]}>"
        tag = self.rng.choice(["div", "div", "section", "aside" if kind in ("ad", "aside", "share", "notice") else "div"])
        return f"<{tag}{named}>{inner}</{tag}>"

    def paragraphs(self, label: int, low: int, high: int) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            text = ". ".join(self.sentence(1, 14) for _ in range(self.rng.randint(1, 5))) + self.rng.choice(["."] * 5 + [""])
            for _ in range(self.rng.choice([0, 0, 0, 1, 1, 3])):
                text = f'{text} <a href="#">{self.sentence(1, 5)}</a> {self.sentence(1, 5)}.'
            self.labels.append(label)
            out.append(f"<p>{text}" + ("</p>" if self.rng.random() < 0.8 else ""))
        return "".join(out)

    def boilerplate(self, kind: str) -> str:
        r = self.rng
        if kind in ("nav", "share") or kind in ("footer", "header", "aside") and r.random() < 0.4:
            body = "<ul>" + "".join(self.leaf("li", f'<a href="#">{self.sentence(1, 3)}</a>', 0)
                                    for _ in range(r.randint(2, 7))) + "</ul>"
        elif kind == "form":
            if r.random() < 0.5:
                body = self.leaf("label", self.sentence(1, 3), 0) + '<input name="q">'
            else:
                body = self.leaf("p", self.sentence(3, 12) + ".", 0) + "<div><input></div>" + self.leaf(
                    "button", self.sentence(1, 2), 0)
        elif kind == "comments":
            body = self.leaf("h3", self.sentence(1, 3), 0)
            for _ in range(r.randint(1, 4)):
                tag = r.choice(["article", "div", "li", "section", "p"])
                inner = self.paragraphs(0, 1, 2) if tag != "p" else ""
                if tag == "p":
                    body += self.leaf("p", self.sentence(4, 30) + ".", 0)
                else:
                    body += f'<{tag}{r.choice(["", " class=comment", " class=reply"])}>{inner}</{tag}>'
        elif kind == "footer":
            body = self.leaf("p", f"© 20{r.randint(10, 30)} {self.sentence(1, 12)}.", 0)
        elif r.random() < 0.5:
            body = self.paragraphs(0, 1, 3)
        else:
            self.labels.append(0)
            body = self.sentence(2, 25) + r.choice([".", ""])
        return self.wrap(kind, body)

    def article(self) -> str:
        r, out = self.rng, []
        if r.random() < 0.85:
            title = self.leaf(r.choice(["h1", "h1", "h2"]), self.sentence(3, 12), 1)
            out.append(f"<header>{title}</header>" if r.random() < 0.15 else title)
        for _ in range(r.randint(1, 6)):
            kind = r.random()
            if kind < 0.5:
                out.append(self.paragraphs(1, 1, 5))
            elif kind < 0.58:
                out.append(self.leaf(r.choice(["h2", "h3", "h4"]), self.sentence(2, 8), 1))
            elif kind < 0.7:
                tag = r.choice(["ul", "ul", "ol"])
                out.append(f"<{tag}>" + "".join(self.leaf("li", self.sentence(1, 14), 1) for _ in range(r.randint(2, 5)))
                           + f"</{tag}>")
            elif kind < 0.76:
                out.append("<blockquote>" + self.paragraphs(1, 1, 2) + "</blockquote>")
            elif kind < 0.79:
                out.append("<table><tr>" + "".join(self.leaf("td", self.sentence(1, 3), 1) for _ in range(4)) + "</tr></table>")
            elif kind < 0.81:
                out.append(self.leaf("pre", self.sentence(2, 20), 1))
            elif kind < 0.84:
                out.append("<figure><img>" + self.leaf("figcaption", self.sentence(3, 10), 1) + "</figure>")
            else:
                out.append(self.boilerplate(r.choice(["ad", "aside", "share", "form", "notice", "ad", "comments", "nav"])))
        body = "".join(out)
        for _ in range(r.randint(0, 2)):
            body = f'<div{r.choice(["", " class=" + r.choice(_MAIN), " id=" + r.choice(_MAIN)])}>{body}</div>'
        if r.random() < self.nameless:
            return r.choice([body, f"<div>{body}</div>", f'<div class="{self.unknown()}">{body}</div>',
                             f"<table><tr><td>{body}</td></tr></table>"])
        tag = r.choice(["article", "article", "article", "main", "div", "section"])
        name = f' class="{r.choice(["", "post-", "article-", "entry-"])}{r.choice(_MAIN)}"'
        return f"<{tag}{name if tag in ('div', 'section') or r.random() < 0.3 else ''}>{body}</{tag}>"

    def page(self) -> str:
        r = self.rng
        before = [k for k in ("header", "nav", "notice", "ad", "form", "aside") if r.random() < 0.45]
        after = [k for k in ("comments", "aside", "share", "ad", "form", "nav", "notice") if r.random() < 0.4]
        r.shuffle(before)
        r.shuffle(after)
        bare = r.random() < 0.3  # the page begins with its article
        if bare and r.random() < 0.6:  # or holds little else
            after = after[:r.randint(0, 1)]
        body = "" if bare else "".join(self.boilerplate(k) for k in before)
        if r.random() < 0.4 * self.nameless:  # a table lays the page out, links in its first cell
            self.labels.append(0)
            links = r.choice(["<br>", " | ", " "]).join(f'<a href="#">{self.sentence(1, 3)}</a>' for _ in range(r.randint(1, 6)))
            body += f"<table><tr><td>{links}</td><td>{self.article()}</td></tr></table>"
        else:
            body += self.article()
        body += "".join(self.boilerplate(k) for k in after)
        if r.random() < (0.3 if bare else 0.8):
            body += self.boilerplate("footer")
        for _ in range(r.randint(0, 2)):
            body = f'<div{r.choice(["", " id=page", " class=wrapper", " class=container", " id=main"])}>{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.sentence(2, 6)}</title></head><body>{body}</body></html>"


def labelled_pages(n: int = 700, seed: int = 3) -> list[tuple[str, list[int]]]:
    """(page, label of each block) by the rule above."""
    out = []
    for i in range(n):
        c = _Composer(random.Random(seed * 1_000_003 + i))
        out.append((c.page(), c.labels))
    return out


@dataclass
class Field:
    """A trained field: two scores per feature, transitions and start, and a memo of ancestor sums."""

    weights: dict[str, tuple[float, float]]
    transitions: list[list[float]]
    start: list[float]
    memo: dict[tuple[str, ...], tuple[float, float, tuple[str, str]]] = field(default_factory=dict)

    def _sum(self, names) -> tuple[float, float]:
        a = b = 0.0
        for f in names:
            w = self.weights.get(f)
            if w:
                a += w[0]
                b += w[1]
        return a, b

    def emission(self, block: Block, beside: list[str]) -> tuple[float, float]:
        known = self.memo.get(block.ancestors)
        if known is None:
            if len(self.memo) > 50_000:
                self.memo.clear()
            around = ancestor_features(block.ancestors)
            known = self.memo[block.ancestors] = (*self._sum(around), place_of(around))
        own = self._sum([*text_features(block, known[2]), *beside])
        return known[0] + own[0], known[1] + own[1]

    def labels(self, page: list[Block]) -> list[int]:
        """Viterbi over the page's blocks."""
        if not page:
            return []
        (t00, t01), (t10, t11) = self.transitions
        beside = around_features(page)
        a, b = (s + e for s, e in zip(self.start, self.emission(page[0], beside[0]), strict=True))
        back = []
        for block, near in zip(page[1:], beside[1:], strict=True):
            ea, eb = self.emission(block, near)
            from_a, from_b = a + t00 >= b + t10, a + t01 >= b + t11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = (a + t00 if from_a else b + t10) + ea, (a + t01 if from_b else b + t11) + eb
        path = [0 if a >= b else 1]
        for pair in reversed(back):
            path.append(pair[path[-1]])
        return path[::-1]

    def main_text(self, page: str) -> str:
        found = blocks(page)
        return "\n\n".join(b.text for b, y in zip(found, self.labels(found), strict=True) if y)


#: Names that may say what an element holds.
_NAMES = frozenset(f for words in (_MAIN, *_PARTS.values()) for w in words for f in element_features("x", f'class="{w}"')[1:])
#: Pages that a feature has to occur on to be learned.
RARE = 4
#: Elements that say what they hold.
_TELLING = frozenset("t:" + t for t in "article main nav aside header footer form".split())


def ancestor_features(ancestors: tuple[str, ...]) -> list[str]:
    """Each feature of the elements around once, the innermost tags, and the innermost element that tells its kind.

    Names outside of the known words tell nothing.
    """
    tags, telling, named = [], ["s:none"], []
    for f in ancestors:
        if f.startswith("t:"):
            tags.append(f)
            named = ["s:" + f] if f in _TELLING else []
            telling = named or telling
        elif f in _NAMES:
            if not named:
                telling = named = []
            named.append("s:" + f)
            telling = named
    return [*dict.fromkeys(ancestors), *telling, "p:" + (tags[-1] if tags else ""), "pp:" + ">".join(tags[-2:])]


def place_of(around: list[str]) -> tuple[str, str]:
    """Own tag and first feature of the telling element, out of ``ancestor_features``."""
    return around[-2], next(f for f in around if f.startswith("s:"))


@functools.cache
def trained(pages: int = 1500, rounds: int = 80) -> Field:
    """Train on the labelled pages; features of fewer than ``RARE`` pages are left out, as new names are."""
    read, seen = [], Counter()
    for page, labels in labelled_pages(pages):
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError("a labelled page's blocks and labels differ in number")
        rows = []
        for block, beside in zip(found, around_features(found), strict=True):
            around = ancestor_features(block.ancestors)
            rows.append([*around, *text_features(block, place_of(around)), *beside])
        read.append((rows, labels))
        seen.update({f for fs in rows for f in fs})
    names: dict[str, int] = {}
    index, counts, gold, lengths = [], [], [], []
    for rows, labels in read:
        for fs, y in zip(rows, labels, strict=True):
            kept = [names.setdefault(f, len(names)) for f in fs if seen[f] >= RARE]
            index += kept
            counts.append(len(kept))
            gold.append(y)
        lengths.append(len(rows))
    model = train(np.array(index), np.array(counts), np.array(gold), np.array(lengths), [0, 1], len(names),
                  rounds=rounds, rate=0.15, l2=1e-4)
    return Field({f: (float(model.weights[i, 0]), float(model.weights[i, 1])) for f, i in names.items()},
                 model.transitions.tolist(), model.start.tolist())


def _extract(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model: Field = shared.value
        for batch in batches:
            for part in slices(batch, 512, 2, 4 << 20):
                texts = [model.main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every whole page: (page_id, url, text, n_chars), one row per input row.

    Blocks are joined by two newlines; white space inside a block is one space; character
    references are decoded. Null html: the empty page, an empty text. Null and repeated ids: a
    row each. An empty table gives an empty result. Extra columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(trained())  # of a fixed size
    base = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        text_or_empty(pages, html_col).alias("html"))
    return base.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")
