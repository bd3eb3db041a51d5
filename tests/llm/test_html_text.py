"""Main text: names of wrappers, broken pages, neighbours, and a twin that parses pages by another way."""

import time
from html.parser import HTMLParser

import pytest

from releasekit.llm import html_text
from releasekit.llm.html_text import main_text

P = " ".join(f"word{k}" for k in range(40))
TEXT = f"<p>{P}</p>" * 3
WANT = "\n".join([P] * 3)


@pytest.mark.parametrize("wrapper", [
    '<article class="post has-sidebar">{}</article>', '<article class="post comments-open">{}</article>', '<article class="post category-legal">{}</article>', '<article class="ad-free widget">{}</article>',
    '<main class="content no-sidebar">{}</main>', '<div class="main no-ads">{}</div>', "<article><form>{}</form></article>", "<form>{}</form>", "<form action=x><main>{}</main></form>",
    '<div class="sidebar-layout"><div class="sidebar"><p>menu of things</p></div><main>{}</main></div>', '<div id="content" data-id="comments">{}</div>', "<div class=content-with-sidebar>{}</div>",
    '<article>{}</article><div class="user-feedback"><p>Nice text, I have read it all and want more of it.</p><p>So did I, and my friends too.</p></div>',
    '<article>{}<section class="post-comments"><article class="comment"><p>A reader says something here.</p></article></section></article>',
    '<div class="cookie-banner"><p>We use cookies, and so do many of our friends who pay.</p></div><div class="post-content">{}</div><div class="related-posts"><article><p>Another one</p></article></div>',
    '<header><h1>Site</h1></header><nav>a b c</nav><article>{}</article><aside><article><p>Teaser</p></article></aside><footer>me</footer>',
    '<div role="navigation">go on</div><div role="main">{}</div><div role="contentinfo">me</div>',
    "<article>{}</article><p class=\"x", "<article title=don't>{}</article>", "<article class='a\" b'>{}</article>", "<article><a name=x >{}</article>",
])
def test_wrappers(wrapper):
    assert main_text(f'<html><body class="single has-sidebar no-comments">{wrapper.format(TEXT)}</body></html>') == WANT


def test_marked_areas_stay_or_go_whole():
    grid = [(words, links, area) for area in (1, -1) for words in (1, 3, 10, 60) for links in (0.0, 0.6, 1.0)]
    for around in ((), ((1, 1.0, 0),), ((50, 0.0, 0),), ((80, 0.0, 1),), ((2, 0.0, 1),)):
        for block in grid:
            page = [*around, block, *around]
            kept = html_text.classify(html_text.default_tree(), html_text.features(page))[len(around)]
            assert kept == (block[2] == 1), (page, kept)


def test_neighbours_decide_where_nothing_is_marked():
    tree = html_text.default_tree()

    def used(t):
        return set() if len(t) == 1 else {html_text.FEATURES[t[0]]} | used(t[2]) | used(t[3])
    assert used(tree) & {"prev_words", "prev_density", "next_words", "next_density"}
    link = '<li><a href="x">Go there</a></li>'
    # the same two words: a heading between paragraphs, a caption between links
    assert main_text(f"<ul>{link}</ul><p>{P}</p><div>Two words</div><p>{P}</p><p>{P}</p>") == f"{P}\nTwo words\n{P}\n{P}"
    assert main_text(f"<p>{P}</p><p>{P}</p><ul>{link * 3}</ul><div>Two words</div><ul>{link * 3}</ul>") == f"{P}\n{P}"


@pytest.mark.parametrize("bad", ["<a x ", '<a x="', "<a x='", "<!", "<!--", '<div class="ad">', "</div>", "<p>x</div>", "<a href=x>y", "&lt;", "<script>", "<=   ", "<p ", '<a class="', "<form>", "<h1>"])
def test_long_broken_pages_take_time_in_proportion(bad):
    page = bad * (1_000_000 // len(bad))
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 15  # it was hours for some of these


def test_one_long_page_is_read_whole():
    page = f"<nav><a href=x>Home</a></nav><article>{f'<p>{P}</p>' * 20_000}</article><footer>me</footer>"
    assert main_text(page) == "\n".join([P] * 20_000)


class Twin(HTMLParser):
    """The article of a page as the standard parser sees it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.open, self.skip = [""], 0, 0

    def handle_starttag(self, tag, attrs):
        self.open += tag == "article"
        self.skip += tag in ("script", "style")
        if tag == "br":
            self.handle_data(" ")
        elif tag not in html_text.INLINE:
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag not in html_text.INLINE:
            self.blocks.append("")
        self.open -= tag == "article"
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if self.open and not self.skip:
            self.blocks[-1] += data


def test_given_pages_equal_the_standard_parser(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        twin = Twin()
        twin.feed(r["html"])
        twin.close()
        assert main_text(r["html"]) == "\n".join(x for x in (" ".join(b.split()) for b in twin.blocks) if x)
