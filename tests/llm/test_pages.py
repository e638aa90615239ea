"""Main text: wrappers with telling names, pages without an article element, and pages made to take long."""

from __future__ import annotations

import html
import random
import time

import pytest

from centerline.llm import pages

ARTICLE = (
    "<article><h1>Head</h1><p>A first paragraph, with commas, and words for the article body.</p>"
    "<p>A second one, of text, which is long enough.</p></article>"
)
TEXT = "Head\n\nA first paragraph, with commas, and words for the article body.\n\nA second one, of text, which is long enough."
AROUND = (
    "<html><body><nav><a href='/'>Home</a> <a href='/b'>News</a></nav>%s"
    "<div class='sidebar'><p>Side text, related, things</p></div><footer>Foot</footer></body></html>"
)


@pytest.mark.parametrize("wrapper", [
    "<div id='content-sidebar-wrap'>%s</div>", "<div class='content has-sidebar'>%s</div>", "<div class='wrapper header-fixed'>%s</div>",
    "<div class='page menu-closed'>%s</div>", "<form action='/all'>%s</form>", "<div class='ad'><div id='cookie-ok'>%s</div></div>", "%s",
])
def test_names_of_wrappers_do_not_hide_the_article(wrapper):
    assert pages.main_text(AROUND % (wrapper % ARTICLE)) == TEXT
    bare = ARTICLE.replace("article>", "div>")
    if wrapper.count("<div") < 2:  # two names against a text of three lines are believed
        assert pages.main_text(AROUND % (wrapper % bare)) == TEXT


@pytest.mark.parametrize("kind", ["article", "div"])
def test_a_header_in_the_text_is_part_of_it(kind):
    named = ARTICLE.replace("article>", f"{kind}>").replace("<h1>Head</h1>", "<div class='entry-header'><h1>Head</h1></div>")
    assert pages.main_text(AROUND % named) == TEXT
    assert pages.main_text(AROUND % ("<div class='site-header'><p>Name of the site, and more</p></div>" + named)) == TEXT


def test_parts_of_an_article_that_are_no_text():
    inner = ARTICLE.replace("</p><p>", "</p><div class='share-bar'>Share this, now, with all</div><aside>Aside, from it</aside><p>")
    inner = inner.replace("and words", "and <span class='ad'>buy</span><label>Mail</label>words").replace("of text", "of <b>te</b>xt")
    comments = "<section id='comments'>" + "<p>A comment, of some length, with commas, and words, and more words.</p>" * 6 + "</section>"
    assert pages.main_text(AROUND % inner.replace("</article>", comments + "</article>")) == TEXT
    assert pages.main_text(AROUND % (inner + comments)) == TEXT


def test_pages_without_article_against_their_plan():
    """Paragraphs of one container, dealt out at random with parts that are named after what they are."""
    rng = random.Random(6)
    words = lambda n: " ".join(rng.choice(["wind", "rain,", "a", "storm", "of", "x<y", "fish & chips,", "the"]) for _ in range(n))
    esc = lambda t: html.escape(t, quote=False)
    for _ in range(150):
        want, inside = [], []
        for _ in range(rng.randint(3, 9)):
            text = words(rng.randint(15, 60))
            if rng.random() < 0.2:
                inside.append(f"<ul><li>{esc(text)}</li><li>{esc(text)} b</li></ul>")
                want += [text, text + " b"]
            else:
                tag = rng.choice(["p", "p", "P", "blockquote", "h2"])
                inside.append(f"<{tag} class=x{rng.randint(0, 9)}>{esc(text)}" + ("" if tag == "p" else f"</{tag}>"))
                want.append(text)
        for noise in (
            "<div class='ad-slot'>Buy, this, now</div>", "<aside>Aside text, too</aside>", "<script>if (a < b) { x(); }</script>",
            "<div role='navigation'><a href=#>next</a></div>", "<form><p>Name, please</p><input name=q></form>", "<!-- <p>gone</p> -->",
            "<div style='display: none'>hidden, text</div>",
        ):
            if rng.random() < 0.5:
                inside.insert(rng.randint(0, len(inside)), noise)
        page = "<body><div id=top><a href=/>Home</a> <a href=/x>All</a></div><div class='%s'>%s</div><div class=footer>%s</div></body>" % (
            rng.choice(["main-text", "story", "c1 has-sidebar"]), "".join(inside), words(8)
        )
        assert pages.main_text(page) == "\n\n".join(" ".join(t.split()) for t in want), page


@pytest.mark.parametrize("page", [
    "<a" * 50_000, "<a \"" * 25_000 + "'>", "<a x=\"" * 20_000, "<div>x, y" * 50_000, "<b>" * 50_000 + "x<p>y</p>" * 20_000,
    "<p><td>" + "<div>x" * 50_000, "<ul>" + "<div>" * 20_000 + "<li>a" * 20_000, "<div>" * 30_000 + "</span>" * 30_000,
    "<ul><li>x" * 30_000, "<svg>" * 50_000, "<!--" * 50_000, "<" * 100_000, "&amp" * 50_000, "</p" * 50_000, "<p\n" * 50_000,
], ids=range(15))
def test_time_is_in_proportion(page):
    began = time.process_time()
    pages.main_text(page)
    assert time.process_time() - began < 5  # fractions of it, as a rule; what is not linear takes minutes


def test_markup_that_does_not_end_is_text():
    assert pages.main_text("<p>one</p> <a x=\"two") == "one\n\n<a x=\"two"
    assert pages.main_text("a < b <3 <p>c</p>") == "a < b <3\n\nc"
