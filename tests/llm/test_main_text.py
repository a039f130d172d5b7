"""Main text of generated pages whose article is known, with and without article tags, and of parts that are easily lost."""

from __future__ import annotations

import html
import random

import pytest

from larkspar.llm.html_text import extract_main_text, lines, main_text, stretches

MENU = "<nav><ul><li><a href=/>Home</a><li><a href=/n>News of the day</a></ul></nav>"
ASIDE = '<aside><p>Our newsletter, every week in your post box, with all that happened here and elsewhere.</p></aside>'
FOOT = "<footer><p>&copy; 2024 The paper. All rights reserved, in all countries and for all purposes.</p></footer>"
ADVERT = '<div class="ad">Buy now and save a lot of money on things you did not know that you need.</div>'
COMMENTS = '<div class="comments"><p>What a long and thoughtful article, I read all of it twice, thank you.</p></div>'


def page(rng, marked):
    """A page and the blocks of its article: a headline, short lines, paragraphs, a list of links, a short end."""
    words = ["tide", "harbour", "crew", "wind", "salt", "&amp;", "caf&eacute;", "&#x65e5;", "<b>rope</b>", "<a href=/x>deck</a>"]
    sentence = lambda n: " ".join(rng.choices(words, k=n))
    blocks = [("h1", "The headline"), ("p", "By A. Writer"), ("p", "1 May")]
    blocks += [("p", sentence(rng.randint(30, 90))) for _ in range(rng.randint(2, 5))]
    blocks += [("li", f"<a href=/{i}>Source {i}</a>") for i in range(4)] + [("p", "Short end.")]
    blocks.insert(4, ("h2", "A heading"))
    body = "".join(f"<{t}>{x}</{t}>" + rng.choice(["", "\n", ADVERT, "<!-- x -->"]) for t, x in blocks)
    tag = rng.choice(["article", "main"]) if marked else 'div class="content"'
    whole = f"<html><head><title>T</title></head><body>{MENU}{ASIDE}<{tag}>{body}</{tag.split()[0]}>{COMMENTS}{FOOT}</body></html>"
    plain = [html.unescape(x.replace("<b>", "").replace("</b>", "")) for _, x in blocks]
    return whole, [" ".join(_without_links(x).split()) for x in plain]


def _without_links(text):
    while "<a " in text:
        before, _, rest = text.partition("<a ")
        text = before + rest.partition(">")[2].replace("</a>", "", 1)
    return text


@pytest.mark.parametrize("marked", [True, False])
def test_generated_pages(marked):
    rng = random.Random(4)
    for _ in range(150):
        whole, blocks = page(rng, marked)
        assert main_text(whole) == "\n\n".join(blocks)


LONG = "word " * 60


def test_parts_that_stay():
    flat = main_text(f"<body><h1>Head</h1><p>By A</p><p>May 1</p><p>{LONG}</p><p>{LONG}</p></body>").split("\n\n")
    assert flat[:3] == ["Head", "By A", "May 1"] and len(flat) == 5
    links = "".join(f"<li><a href=/>l{i}</a>" for i in range(3))
    end = main_text(f"<body><div><p>{LONG}</p><ul>{links}</ul><p>Short end.</p></div><ul><li><a>beside</a></ul></body>")
    assert end.split("\n\n")[1:] == ["l0", "l1", "l2", "Short end."]
    part = main_text(
        f'<main><h1>T</h1><p>{LONG}</p><section class="related-work"><h2>Related work</h2><p>Others did.</p></section>'
        f'<section id="comments-on-method"><p>Few.</p></section><section class="comments"><p>{LONG}</p></section></main>'
    )
    assert part.split("\n\n")[2:] == ["Related work", "Others did.", "Few."]
    assert main_text("<article><p>Brief.</p></article><p>Beside it</p>") == "Brief."
    assert main_text(f"<article><p>teaser</p></article><article><p>{LONG}</p><p>x</p></article>").split("\n\n")[-1] == "x"
    assert "teaser" not in main_text(f"<article><p>teaser</p></article><article><p>{LONG}</p></article>")


def test_the_distribution_decides():
    rows = lines(f"<article><h1>Head</h1><p>{LONG}</p><p>x</p></article><p>{LONG}</p>")
    assert [r.article > 0 for r in rows] == [True, True, True, False]
    assert stretches([r.plain if r.article else 0 for r in rows]) == [(0, 3)]
    assert stretches([20, 15, 12, 400, 300]) == [(1, 5)] and stretches([]) == [] and stretches([5, 5]) == []


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p>" * 3000 + "deep" + "</div>"), (5, "u", "plain text"),
        (6, "u", "<article>" + f"<p>{LONG}</p>" * 3000), (None, "u", "<p>a&nbsp;b\tc"), (7, "u", "<script>var x = '</p>'"), (7, "u", "<script>"),
    ]
    got = {(r["page_id"], r["n_chars"]): r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    texts = {k[0]: v for k, v in got.items()}
    assert texts[1] == texts[2] == texts[7] == "" and texts[4] == "deep" and texts[5] == "plain text" and texts[None] == "a b c"
    assert texts[6] == "\n\n".join([LONG.strip()] * 3000) and all(n == len(t) for (_, n), t in got.items())
