"""Blocks of pages, the field's training and decoding, and extraction."""

import itertools
import random

import numpy as np

from millrace.llm import extraction
from millrace.llm.dom import blocks_of


def texts(html):
    return [b.text for b in blocks_of(html)]


def test_blocks():
    assert texts("<p>a <b>b</b>c\n d<p>e<br>f</p><!-- <p>x</p> --><script>var p='</p>';</script>g &amp; &copy;h &am") == ["a bc d", "e", "f", "g & ©h &am"]
    assert texts("") == [] and texts("plain") == ["plain"] and texts("<div><div></div></div>") == []
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<textarea>no</textarea><select><option>no</select><style>p{}") == []
    paths = [[e.tag for e in b.path] for b in blocks_of("<nav>m</nav><div class='a b-c' id=X><p>t</div>u")]
    assert paths == [["nav"], ["div", "p"], []]
    assert blocks_of("<div class='fooBar x_y' role=main>t</div>")[0].path[0].marks == ("foo", "bar", "x", "y", "main")
    assert blocks_of("<p>ab<a href='>'>cd</a></p>")[0].linked == 2


def test_malformed_pages_keep_their_text():
    texts = lambda html: [b.text for b in blocks_of(html)]
    for tag in ("button", "noscript", "svg", "object", "canvas", "select", "option"):
        assert texts(f"<p>one</p><{tag}><p>two</p><{tag}><p>three</p>") == ["one", "two", "three"]
        assert texts(f"<p>one</p><{tag}>no</{tag}><p>two</p>") == ["one", "two"]
    for tag in ("script", "style", "textarea", "title"):
        assert texts(f"<p>one</p><{tag}><p>two</p>") == ["one"]
    assert texts("<p>sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> here</p>") == ["sum x+1 here"]
    assert texts("<p title=Don't>Two is text</p><p>It's three</p>") == ["Two is text", "It's three"]
    assert texts("<p title=\"a > b\" data-x = 'c > d'>four</p>") == ["four"]


def test_viterbi_finds_the_best_labels():
    pages = extraction.labelled_pages(30, 5)
    field = extraction.train(pages, rounds=15)
    for blocks, _ in pages:
        blocks = blocks[:9]
        found, same = field.rows(blocks)

        def total(labels):
            score = sum(field.node[f, y].sum() for f, y in zip(found, labels))
            return score + sum(field.step[same[i], labels[i - 1], labels[i]] for i in range(1, len(labels)))

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=total)
        assert np.isclose(total(best), total(field.labels(blocks)))


def test_field_on_pages_it_has_not_seen(spark):
    field = extraction.train(extraction.labelled_pages())
    right = wrong = 0
    for blocks, labels in extraction.labelled_pages(150, 77):
        got = field.labels(blocks)
        right += sum(int(a == b) for a, b in zip(got, labels))
        wrong += sum(int(a != b) for a, b in zip(got, labels))
    assert right / (right + wrong) > 0.98
    page = (
        "<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<div class='cookie-notice'><p>We use cookies.</p></div><article><h1>Title &amp; more</h1><p>First  words\n here.<p>Second.</article>"
        "<aside class=sidebar><a href=/x>other</a></aside><section class=comments><p>Nice article, I liked reading it very much indeed.</p></section>"
        "<form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"
    )
    long = page.replace("Second.", "word " * 50000)
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", long, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    out = sorted(extraction.extracted(frame, field).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    text = "Title & more\nFirst words here.\nSecond."
    assert [(r.text, r.n_chars) for r in out[:4]] == [(text, len(text))] * 2 + [("", 0)] * 2
    assert out[4].n_chars == len("Title & more\nFirst words here.\n") + 50000 * 5 - 1
    assert extraction.extracted(frame.limit(0), field).count() == 0


def second_pages(n, seed=3):
    """Pages written apart from the field's own layouts: (html, main text), in four styles."""
    rng = random.Random(seed)
    stock = "river mountain government library music weather season market history science children village kitchen garden".split()

    def line(low, high):
        return " ".join(rng.choice(stock) for _ in range(rng.randint(low, high))).capitalize()

    def prose(sentences):
        return " ".join(line(5, 18) + rng.choice([".", ".", "?", "!"]) for _ in range(sentences))

    def said(paragraphs):
        return [line(2, 7), *[prose(rng.randint(1, 6)) for _ in range(paragraphs)]]

    out = []
    for i in range(n):
        text = said(rng.randint(1, 9))
        body = f"<h1>{text[0]}</h1>" + "".join(f"<p>{p}</p>" for p in text[1:])
        menu = "".join(f"<li><a href='/{k}'>{line(1, 2)}</a></li>" for k in range(rng.randint(3, 7)))
        others = "".join(f"<li><a href='/r{k}'>{line(3, 6)}</a></li>" for k in range(rng.randint(2, 5)))
        style = i % 4
        if style == 0:  # a weblog
            page = (
                f"<div id='masthead'><a href='/'>{line(1, 3)}</a></div><ul class='main-menu'>{menu}</ul><div class='entry-content'>{body}"
                f"<div class='sharing'><a href='#'>Send</a> <a href='#'>Print</a></div></div><div id='sidebar-right'><h3>Archive</h3><ul>{others}</ul></div>"
                f"<div class='comments-area'><h3>Replies</h3><ol>" + "".join(f"<li class='comment'><p>{prose(2)}</p></li>" for _ in range(rng.randint(0, 3))) + "</ol></div>"
                f"<div class='site-footer'><p>&copy; 2021 {line(1, 3)}</p></div>"
            )
        elif style == 1:  # a newspaper
            page = (
                f"<header><nav><ul>{menu}</ul></nav></header><div class='cookie-consent'>{prose(1)} <button>Accept</button></div><main><article>{body}</article>"
                f"<aside class='related'><h2>Also read</h2><ul>{others}</ul></aside></main><div class='newsletter'><p>{line(3, 8)}.</p><form><input><button>Join</button></form></div>"
                f"<footer><ul>{menu}</ul><p>Imprint</p></footer>"
            )
        elif style == 2:  # an old page of tables
            page = f"<table><tr><td class='nav'>{' | '.join(f'<a href=/{k}>{line(1, 1)}</a>' for k in range(4))}</td></tr><tr><td class='content'>{body}</td></tr><tr><td class='footer'>&copy; {line(1, 2)}</td></tr></table>"
        else:  # a manual
            page = f"<div class='toc'><ul>{menu}</ul></div><div role='main'>{body}</div><div class='ads'><p>{line(4, 9)}!</p></div><footer><p>{line(2, 6)}</p></footer>"
        out.append((f"<!doctype html><html><head><title>x</title><style>p{{}}</style></head><body>{page}</body></html>", text))
    return out


def test_pages_written_apart_and_probes():
    field = extraction.train(extraction.labelled_pages())
    right = total = whole = 0
    pages = second_pages(400)
    for html, text in pages:
        blocks = blocks_of(html)
        got = [b.text for b, label in zip(blocks, field.labels(blocks)) if label]
        wanted = set(text)
        right += sum((b.text in wanted) == bool(label) for b, label in zip(blocks, field.labels(blocks)))
        total += len(blocks)
        whole += got == text
    assert right / total >= 0.99 and whole / len(pages) >= 0.9
    said = "The quick sentence went over the lazy hill and came back again. "
    main = lambda html: extraction.main_text(field, html)
    assert main(f"<p>{said}</p><p>{said}</p><p>{said}</p>") == "\n".join([said.strip()] * 3)
    assert main("<article><p>Short note</p></article>") == "Short note"
    assert main("<article class='comment-policy widget'>" + f"<p>{said * 4}</p>" * 5 + "</article>").count("\n") == 4
    assert main(f"<article><p>if a<b then c</p><p>{said}</p></article>") == f"if a<b then c\n{said.strip()}"
    assert main(f"<article><p>{said * 3}</p><div class='share'>Tweet Share</div><p>{said}</p></article>") == f"{(said * 3).strip()}\n{said.strip()}"
    assert main(f"<article><p>{said}</p><svg><svg>x</svg>hidden</svg><p>{said}</p></article>") == f"{said.strip()}\n{said.strip()}"


def test_elements_end_at_their_own_depth():
    assert texts("<p>a</p><svg><g><svg>x</svg></g>y</svg><p>b</p>") == ["a", "b"]
    assert texts("<select><option>x<select><option>y</select>z</select>after") == ["after"]
    assert texts("<svg/>shown<p>b</p>") == ["shown", "b"]
    assert texts("<p>1 < 2 and a<b</p><p>next</p>") == ["1 < 2 and a<b", "next"]
