"""Main text: exact articles of the tables' pages, other layouts, the field against enumeration."""

import itertools
import re
from html import unescape

import numpy as np
import pytest

from lastmile.llm import html_text
from lastmile.llm.html_blocks import blocks
from lastmile.llm.html_pages import labelled_pages
from lastmile.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field():
    return html_text.fit()


def article(html):
    inside = html[html.index("<article>") + 9 : html.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", inside)
    texts = [" ".join(unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " "))).split()) for p in parts]
    return "\n\n".join(t for t in texts if t)


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op5_html_text"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_unseen_layouts(field):
    wrong = total = 0
    for html, labels in labelled_pages(200, seed=77):
        page = blocks(html)
        assert len(page) == len(labels)
        wrong += sum(a != b for a, b in zip(field.decode([b.features for b in page]), labels))
        total += len(labels)
    assert wrong <= 0.01 * total


HAND = """<html><head><title>T</title></head><body><div id="cookie-banner"><p>We use cookies. Accept?</p></div>
<header class="site-header"><a href="/">Daily News</a></header><nav><ul><li><a>Home</a><li><a>World</a></ul></nav>
<main><article><h1>Storm &amp; flood</h1><p>The river rose  quickly on&nbsp;Monday, and people left their homes.
<p>Nobody was hurt,<br>officials said.<div class="advert">Buy boots today</div><p>More rain is expected.</article>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>Ann says:</p><p>Stay safe, everyone, it looks very bad.</p></div></section></main>
<aside class="sidebar"><h4>Popular</h4><ul><li><a>One</a></li></ul></aside><form><p>Subscribe to our newsletter</p></form>
<footer>&copy; 2024 Daily News</footer><script>if (a < b) document.write("<p>x</p>")</script></body></html>"""


def test_hand_written_page(field):
    assert html_text.main_text(HAND, field) == (
        "Storm & flood\n\nThe river rose quickly on Monday, and people left their homes.\n\n"
        "Nobody was hurt, officials said.\n\nMore rain is expected."
    )


def test_decoding_is_the_best_labelling(field):
    for html, _ in labelled_pages(40, seed=5):
        page = [b.features for b in blocks(html)][:9]
        score = lambda ls: field.start[ls[0]] + sum(field.weight[f].sum() for f, x in zip(page, ls) if x) + sum(field.step[a, b] for a, b in zip(ls, ls[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(page)), key=score)
        assert score(field.decode(page)) == pytest.approx(score(best))


def test_marginals_against_enumeration():
    rnd = np.random.default_rng(2)
    gain, start, step = rnd.normal(size=(2, 4)), rnd.normal(size=2), rnd.normal(size=(2, 2))
    real = np.array([[True] * 4, [True, True, False, False]])
    one, pairs = html_text.ChainField._marginals(gain, real, start, step)
    want_pairs = np.zeros((2, 2))
    for i, n in enumerate((4, 2)):
        every = list(itertools.product((0, 1), repeat=n))
        weight = np.array([np.exp(start[ls[0]] + sum(gain[i, j] * ls[j] for j in range(n)) + sum(step[a, b] for a, b in zip(ls, ls[1:]))) for ls in every])
        weight /= weight.sum()
        assert np.allclose(one[i, :n], [sum(w for w, ls in zip(weight, every) if ls[j]) for j in range(n)])
        for w, ls in zip(weight, every):
            for a, b in zip(ls, ls[1:]):
                want_pairs[a, b] += w
    assert np.allclose(pairs, want_pairs)


def test_odd_rows(spark, field):
    texts = [
        None, "", "plain text only", "<p>", "<article><p>a<p>b", "<div>" * 20_000 + "deep", "<!-- open", "<script>never closed",
        "<article>" + "<p>Some words of a long page, again and again.</p>" * 20_000 + "</article>", "&lt;p&gt; &amp;amp; <b", "</div></p>x", "<p a='>'>y</p>",
    ]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("*", "'c' AS text", "'u' AS url", "1 AS n_chars")
    out = html_text.extracted(pages.unionAll(pages), field=field)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = {r.page_id: r for r in out.collect()}
    assert out.count() == 2 * len(texts) and all(r.text is not None and r.n_chars == len(r.text) for r in rows.values())
    assert rows[0].text == rows[1].text == rows[3].text == rows[6].text == rows[7].text == ""
    assert rows[8].text.count("\n\n") == 19_999
    assert html_text.extracted(pages.limit(0), field=field).count() == 0


STORY = "<article><p>The river rose quickly on Monday.</p><p>Nobody was hurt, officials said.</p></article>"


@pytest.mark.parametrize(
    "html",
    [
        f"<html><head><title>t</title><meta charset=utf-8><body>{STORY}", f"<head><title>t</title><style>p {{}}</style>{STORY}",
        f"<body><div class=share><button>Share</div>{STORY}", f"<body><button>Share{STORY}<button>Top</button>",
        f"<body><div><svg viewBox='0 0 1 1'><path d=''></div>{STORY}", f"<body><svg><path d=''>{STORY}",
        f"<body><form><select><option>One</form>{STORY}", f"<body><div><noscript><p>Enable scripts</div>{STORY}",
        f"<body><div><object><video><canvas>no</div>{STORY}", f"<body><noscript><div><p>Enable scripts</noscript>{STORY}",
        f"<head><title>t</title></head><body><button><div>Share</div></button>{STORY}<svg><title>x</title><text>y</text></svg>",
    ],
)
def test_elements_without_an_end_tag(html):
    assert [b.text for b in blocks(html)] == ["The river rose quickly on Monday.", "Nobody was hurt, officials said."]


def test_left_out_elements_do_not_cut_a_block():
    assert [b.text for b in blocks("<p>One <noscript><div><p>no</div></noscript>two</p>")] == ["One two"]


def test_a_slash_ends_no_raw_element():
    assert [b.text for b in blocks(f"<script src=/js/>var a=\"x\"; foo()</script>{STORY}")] == [b.text for b in blocks(STORY)]
    assert [b.text for b in blocks(f"<style media=/all/>p{{color:red}}</style>{STORY}")] == [b.text for b in blocks(STORY)]
    assert [b.text for b in blocks(f"<svg/>{STORY}<script src='x'/>")] == [b.text for b in blocks(STORY)]
    assert [b.text for b in blocks(f"<noscript data-x=/a/>no</noscript>{STORY}")] == [b.text for b in blocks(STORY)]


@pytest.mark.parametrize("tag", ["div", "p"])
@pytest.mark.parametrize("lead", ["", "Dear reader, this is how the pages that you see here are made and paid for by those who make them. " * 4])
def test_notices_say_what_they_are_anywhere(field, tag, lead):
    notice = f"<{tag}>{lead}We use cookies to improve your visit. By continuing you accept our privacy policy.</{tag}>"
    text = html_text.main_text(f"<html><body>{notice}{STORY}</body></html>", field)
    assert text == "The river rose quickly on Monday.\n\nNobody was hurt, officials said."
    inside = STORY.replace("Nobody was hurt", f"{lead}Nobody was hurt by the cookie factory")
    assert "cookie factory" in html_text.main_text(f"<html><body>{inside}</body></html>", field)
