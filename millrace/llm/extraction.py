"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A block's features are the tags and the words of class, id and role of the elements around it, and what its text is like: length,
share inside links, signs at its end, repetition of a path, and how much of the page's text its container holds.  The field has weights for features and for the step from one block to the next,
apart for blocks of one container and others.  It is trained in numpy by maximum likelihood (forward-backward, Adam) on
labelled pages that ``labelled_pages`` lays out: articles in many containers, with menus, headers, footers, sidebars, notices,
adverts, forms and reader comments around and inside them.  Viterbi gives the labels; the blocks labelled as main text are
joined by a line feed.

Defined results: a null or empty page has no blocks and an empty text; every row of repeated pages gets its text; a page of
any length is handled whole; of labellings that are equally likely the one with fewer blocks is taken; an empty table gives an empty result;
further columns are kept, those named like a result column, in whatever case, are replaced.
"""

from __future__ import annotations

import random
from functools import lru_cache
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.dom import Block, blocks_of

PAGES = 1000
ROUNDS = 120
#: Shares of laid-out pages with a very short article, an article without an element of its own, one whose element has a misleading name, and
#: nothing beside the article.
SHORT, BARE, MISLEADING, ALONE = 0.15, 0.12, 0.3, 0.1

# How pages name their parts.
MAIN_MARKS = "content article post entry body story main text page blog single news maincontent detail".split()
OUTER_MARKS = "wrapper container page site layout row col inner wrap app root grid".split()
OTHER_MARKS = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs links tabs pagination pager toc skip".split(),
    "head": "header masthead topbar logo brand banner site tagline hero".split(),
    "foot": "footer bottom copyright legal colophon imprint credits".split(),
    "side": "sidebar side aside widget related recommended popular trending more rail latest tags".split(),
    "notice": "cookie cookies notice consent gdpr alert banner popup modal privacy warning subscribe paywall newsletter".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promoted adsense adbox partner".split(),
    "form": "form login search signup contact register field newsletter".split(),
    "comments": "comment comments reply replies respond discussion disqus feedback reviews thread commentlist".split(),
    "share": "share social sharing follow buttons tools".split(),
}
BLOCK_TAGS = {"menu": ["nav", "div", "ul"], "head": ["header", "div"], "foot": ["footer", "div"], "side": ["aside", "div", "section"],
              "notice": ["div", "section", "dialog", "aside"], "advert": ["div", "aside", "section"], "form": ["form", "form", "div"],
              "comments": ["section", "div", "ol"], "share": ["div", "ul"]}


#: Elements that stand for a piece of a container, not for one.
PIECES = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figure figcaption caption".split())


def container(path: tuple) -> tuple:
    """The elements around a block without those that only part its text."""
    end = len(path)
    while end and path[end - 1].tag in PIECES and not path[end - 1].marks:
        end -= 1
    return path[:end]


def features(blocks: list[Block]) -> list[list[str]]:
    """The features of every block of a page."""
    homes = [container(b.path) for b in blocks]
    held: dict[tuple, int] = {}
    for home, b in zip(homes, blocks):
        held[home] = held.get(home, 0) + len(b.text) - b.linked
    total, most = max(1, sum(held.values())), max(held.values(), default=0)
    shares = {
        # A name means less on an element that holds much of the page.
        home: (f"holds:{int(4 * n / total)}", *(["most"] if n == most else []), *(f"{'big' if 4 * n >= total else 'small'}:{m}" for e in home[-1:] for m in e.marks))
        for home, n in held.items()
    }
    out, before = [], None
    for i, (home, b) in enumerate(zip(homes, blocks)):
        out.append([*path_features(b.path), *text_features(b, before, i), *shares[home]])
        before = b
    return out


@lru_cache(maxsize=20_000)
def path_features(path) -> tuple[str, ...]:
    found = {f"in:{e.tag}" for e in path if e.tag not in ("html", "body")}
    found |= {f"mark:{m}" for e in path for m in e.marks}
    if path:
        found |= {f"tag:{path[-1].tag}", *(f"near:{m}" for e in path[-2:] for m in e.marks)}
    return tuple(sorted(found))


def text_features(block: Block, before: Block | None, place: float) -> list[str]:
    text, n = block.text, len(block.text)
    share = block.linked / max(1, n)
    found = ["any", f"size:{min(n.bit_length(), 11)}", f"links:{int(share * 3.999)}"]
    if text[-1] in ".!?:;\"'”»…":
        found.append("end:sign")
    if "©" in text or "(c)" in text.lower():
        found.append("copyright")
    if "|" in text or "·" in text:
        found.append("bars")
    if place == 0:
        found.append("first")
    if before is not None and before.path[:-1] == block.path[:-1]:
        found.append("sibling")
    return found


# --- labelled pages -----------------------------------------------------------------------------------------------------------

class Layout:
    """One random page with labels: text of the article inside marker characters."""

    def __init__(self, rng: random.Random):
        self.r = rng

    def words(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        syllables = "an er in on re ti en st th nd le ou ar de la es ist al or ne".split()
        return " ".join("".join(self.r.choice(syllables) for _ in range(self.r.randint(1, 3))) for _ in range(n))

    def sentence(self, low: int = 1, high: int = 25) -> str:
        said = self.words(low, high).capitalize() + self.r.choice([".", ".", ".", "!", "?", ""])
        return self.r.choice([said] * 8 + [said.upper(), said.replace(" ", " | "), said.replace(" ", "*** ")])

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(self.r.choice([1, 1, 1, 2, 3, 5, 9])))

    def marks(self, words: list[str], often: float) -> str:
        if self.r.random() > often:
            return ""
        name = self.r.choice(["class", "class", "id"])
        some = self.r.sample(words, min(len(words), self.r.randint(1, 2)))
        return f' {name}="{self.r.choice(["-", "_", " "]).join(some)}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{escape(self.words(1, 4))}</a>' for i in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" | ", " ", " · "]).join(items)

    def other(self, kind: str) -> str:
        tag = self.r.choice(BLOCK_TAGS[kind])
        plain = tag in ("div", "section", "ul", "ol", "dialog")
        # Boxes are often called after what they stand beside: main-menu, page-footer, article-tools.
        names = OTHER_MARKS[kind] if self.r.random() < 0.75 else [*self.r.sample(OTHER_MARKS[kind], 1), self.r.choice(MAIN_MARKS)]
        marks = self.marks(names, 1.0 if plain else 0.4)
        p = lambda low, high: f"<p>{escape(self.sentence(low, high))}</p>"
        if kind == "menu":
            inside = self.links(2, 9)
        elif kind == "head":
            inside = self.r.choice([f"<h1>{escape(self.words(1, 4))}</h1>", f'<a href="/">{escape(self.words(1, 3))}</a>']) + self.r.choice(["", p(2, 8), self.links(2, 5)])
        elif kind == "foot":
            inside = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {escape(self.sentence(1, 12))}", p(2, 14) + p(1, 6), self.links(2, 6) + p(2, 9), "<p>&copy; 2024 " + self.words(1, 4) + "</p>"])
        elif kind == "side":
            inside = f"<{(h := self.r.choice(['h2', 'h3', 'h4']))}>{escape(self.words(1, 3))}</{h}>" + self.r.choice([self.links(2, 7), p(3, 20), p(5, 20) + self.links(1, 4)])
        elif kind == "notice":
            inside = self.r.choice([p(4, 25), escape(self.sentence(4, 25))]) + self.r.choice(["", "<button>OK</button>", '<a href="#">more</a>'])
        elif kind == "advert":
            inside = self.r.choice([escape(self.paragraph()), p(2, 20), f"<h4>{self.words(1, 5)}</h4>" + p(2, 20)])
        elif kind == "form":
            inside = f"<label>{self.words(1, 3)}</label><input type=text>" + self.r.choice(["", p(2, 12), f"<legend>{self.words(1, 3)}</legend>"]) + "<button>go</button>"
        elif kind == "comments":
            one = lambda: f"<{self.r.choice(['div', 'li', 'article'])}{self.marks(OTHER_MARKS['comments'], 0.6)}>" + f"<b>{self.words(1, 2)}</b>" + "".join(f"<p>{escape(self.paragraph())}</p>" for _ in range(self.r.randint(1, 3)))
            inside = self.r.choice(["", f"<h3>{self.words(1, 3)}</h3>"])
            for _ in range(self.r.randint(1, 5)):
                made = one()
                inside += made + f"</{made[1:].split(' ')[0].split('>')[0]}>"
        else:
            inside = self.r.choice([self.links(2, 5), self.links(2, 5), escape(self.words(1, 5)), "".join(f"<span>{self.words(1, 2)}</span> " for _ in range(self.r.randint(2, 4)))])
        return f"<{tag}{marks}>{inside}</{tag}>"

    def article(self) -> str:
        """The main text; its blocks stand between \\x01 and \\x02."""
        said = lambda x: f"\x01{escape(x)}\x02"
        short = self.r.random() < SHORT
        parts = [f"<h1>{said(self.words(2, 10))}</h1>"] if self.r.random() < (0.2 if short else 0.8) else []
        for _ in range(1 if short else self.r.choice([1, 1, 2, 3, 5, 8, 14])):
            if short:
                parts.append(f"<p>{said(self.sentence(1, 5))}</p>")
                continue
            what = self.r.random()
            if what < 0.75:
                text = self.paragraph()
                parts.append(self.r.choice([f"<p>{said(text)}</p>", f"<p>{said(text)}</p>", f"<p>{said(text)}", f"{said(text)}<br>", f"<p><b>{said(text)}</b></p>", f"<div>{said(text)}</div>"]))
            elif what < 0.85:
                parts.append(f"<h2>{said(self.words(1, 7))}</h2>")
            elif what < 0.92:
                parts.append("<ul>" + "".join(f"<li>{said(self.sentence(1, 12))}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif what < 0.95:
                parts.append("<table>" + "".join(f"<tr><td>{said(self.words(1, 4))}</td><td>{said(self.words(1, 3))}</td></tr>" for _ in range(self.r.randint(1, 4))) + "</table>")
            else:
                parts.append(f"<blockquote>{said(self.paragraph())}</blockquote>")
            if self.r.random() < 0.15:
                parts.append(self.other(self.r.choice(["advert", "share", "share", "share", "side", "form", "notice"])))
        tag = self.r.choice(["article", "article", "main", "div", "div", "section", "td"])
        marks = self.marks(MAIN_MARKS, 0.3 if tag in ("article", "main") else 0.9)
        inside = "".join(parts)
        if self.r.random() < BARE:
            return inside
        if tag in ("article", "main") and self.r.random() < MISLEADING:
            # An article's own element may be called like something else.
            marks = self.marks(OTHER_MARKS[self.r.choice(sorted(OTHER_MARKS))], 1.0)
        return f"<table><tr><td{marks}>{inside}</td></tr></table>" if tag == "td" else f"<{tag}{marks}>{inside}</{tag}>"

    def page(self) -> str:
        some = lambda kinds, share: "".join(self.other(k) for k in kinds if self.r.random() < share)
        above, below = ["head", "menu", "notice", "advert", "form", "side"], ["share", "side", "advert", "comments", "form", "menu", "notice"]
        self.r.shuffle(above)
        self.r.shuffle(below)
        middle = self.article()
        if self.r.random() < 0.2:
            tag = self.r.choice(["main", "main", "div", "section"])
            middle = f"<{tag}{self.marks(MAIN_MARKS + OUTER_MARKS, 0.4)}>{middle}{some(['side', 'share', 'advert'], 0.5)}</{tag}>"
        body = some(above, 0.45) + middle + some(below, 0.4) + (self.other("foot") if self.r.random() < 0.85 else "")
        if self.r.random() < ALONE:
            body = middle
        for _ in range(self.r.randint(0, 2)):
            body = f"<div{self.marks(OUTER_MARKS, 0.8)}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 9)}</title></head><body>{body}</body></html>"


def labelled_pages(n: int = PAGES, seed: int = 23) -> list[tuple[list[Block], np.ndarray]]:
    """Pages as blocks with a label each: 1 for main text."""
    out, rng = [], random.Random(seed)
    for _ in range(n):
        blocks = blocks_of(Layout(rng).page())
        labels = np.array(["\x01" in b.text for b in blocks], int)
        out.append(([Block(b.text.replace("\x01", "").replace("\x02", "") or ".", b.path, b.linked) for b in blocks], labels))
    return out


# --- the field -------------------------------------------------------------------------------------------------------------------

class Field:
    """Weights by feature and label, and by kind of step (same container or not), label before and label."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers
        self.node = np.zeros((len(numbers), 2))
        self.step = np.zeros((2, 2, 2))

    def rows(self, blocks: list[Block]) -> tuple[list[list[int]], np.ndarray]:
        """Feature numbers of each block, and whether it has the container of the block before."""
        found = [[n for f in own if (n := self.numbers.get(f)) is not None] for own in features(blocks)]
        same = np.zeros(len(blocks), int)
        for i, (before, block) in enumerate(zip(blocks, blocks[1:])):
            same[i + 1] = before.path[:-1] == block.path[:-1]
        return found, same

    def labels(self, blocks: list[Block]) -> list[int]:
        """The most likely labels of a page."""
        if not blocks:
            return []
        found, same = self.rows(blocks)
        scores = [self.node[f].sum(axis=0).tolist() for f in found]
        step = self.step.tolist()
        a, b = scores[0]
        back = []
        for (x, y), s in zip(scores[1:], same[1:].tolist()):
            t = step[s]
            from_a, from_b = (a + t[0][0], b + t[1][0]), (a + t[0][1], b + t[1][1])
            back.append((int(from_a[1] > from_a[0]), int(from_b[1] > from_b[0])))
            a, b = max(from_a) + x, max(from_b) + y
        out = [int(b > a)]
        for choice in reversed(back):
            out.append(choice[out[-1]])
        return out[::-1]


def train(pages: list[tuple[list[Block], np.ndarray]], rounds: int = ROUNDS, l2: float = 0.05, rate: float = 0.15) -> Field:
    """Maximum likelihood with an L2 penalty; all pages are padded to one length and go through the chain together."""
    seen: dict[str, int] = {}
    for blocks, _ in pages:
        for own in features(blocks):
            for f in own:
                seen[f] = seen.get(f, 0) + 1
    field = Field({f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 3))})
    pages = [p for p in pages if p[0]]
    n, longest = len(pages), max(len(b) for b, _ in pages)
    flat, owner, label = [], [], np.zeros((n, longest), int)
    same, there = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (blocks, y) in enumerate(pages):
        found, same[i, : len(blocks)] = field.rows(blocks)
        label[i, : len(blocks)], there[i, : len(blocks)] = y, True
        for t, f in enumerate(found):
            flat += f
            owner += [i * longest + t] * len(f)
    flat, owner = np.array(flat), np.array(owner)
    weights = np.concatenate([field.node.reshape(-1), field.step.reshape(-1)])
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    lines = np.arange(n)
    for turn in range(1, rounds + 1):
        node, step = weights[: field.node.size].reshape(-1, 2), weights[field.node.size :].reshape(2, 2, 2)
        scores = np.zeros((n * longest, 2))
        np.add.at(scores, owner, node[flat])
        scores = scores.reshape(n, longest, 2)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = scores[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + step[same[:, t]], axis=1) + scores[:, t]
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 1, 0, -1):
            new = np.logaddexp.reduce(step[same[:, t]] + (scores[:, t] + behind[:, t])[:, None, :], axis=2)
            behind[:, t - 1] = np.where(there[:, t, None], new, behind[:, t])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        wrong = np.exp(ahead + behind - total[:, None, None])
        wrong[lines[:, None], np.arange(longest), label] -= 1
        wrong[~there] = 0
        g_node, g_step = np.zeros_like(node), np.zeros_like(step)
        np.add.at(g_node, flat, wrong.reshape(-1, 2)[owner])
        for t in range(1, longest):
            on = there[:, t]
            both = np.exp(ahead[:, t - 1, :, None] + step[same[:, t]] + (scores[:, t] + behind[:, t])[:, None, :] - total[:, None, None])
            both[lines, label[:, t - 1], label[:, t]] -= 1
            np.add.at(g_step, same[on, t], both[on])
        g = np.concatenate([g_node.reshape(-1), g_step.reshape(-1)]) / n + l2 / n * weights
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        weights -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    field.node, field.step = weights[: field.node.size].reshape(-1, 2), weights[field.node.size :].reshape(2, 2, 2)
    return field


def main_text(field: Field, html: str | None) -> str:
    blocks = blocks_of(html) if html else []
    return "\n".join(b.text for b, label in zip(blocks, field.labels(blocks)) if label)


def extracted(pages: DataFrame, field: Field, html_col: str = "html", into: str = "text", chars: str = "n_chars") -> DataFrame:
    """``pages`` without their html but with the main text of the whole page and its number of code points."""
    keep = [c for c in pages.columns if c != html_col and c.lower() not in (into.lower(), chars.lower())]

    def made(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                texts = [main_text(field, html) for html in some.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, into, chars]
                )

    rows = pages.select(*[pages[c] for c in keep], pages[html_col])
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(made, f"{schema}`{into}` string, `{chars}` long")
