"""Main text of pages with class and id names as sites have them."""

import pytest
from millrace.llm import html_extract

OPEN, CLOSE = "<html><body><nav>Menu</nav><article><h1>Title</h1><p>Start of the text.</p>", "<p>End of the text.</p></article><footer>Foot</footer></body></html>"


def inside(part):
    """What of ``part`` stays in an article."""
    blocks = html_extract.main_texts([OPEN + part + CLOSE])[0].split("\n\n")
    assert blocks[:2] == ["Title", "Start of the text."] and blocks[-1] == "End of the text."
    return "|".join(blocks[2:-1])


LONG = " ".join(f"word{k}" for k in range(60))


@pytest.mark.parametrize(
    "part, text",
    [
        ('<h2 id="search">Search</h2>', "Search"),
        ('<h2 id="navigation" class="related">Navigation</h2>', "Navigation"),
        ('<h2 id="comments">Comments</h2>', "Comments"),
        ('<section id="search"><p>How to search</p></section>', "How to search"),
        ('<section id="related"><p>Related work</p></section>', "Related work"),
        ('<section id="advertising"><p>On advertising</p></section>', "On advertising"),
        ('<section id="comments"><p>On comments in code</p></section>', "On comments in code"),
        ('<div class="section" id="comments"><h2>Comments</h2><p>' + LONG + "</p></div>", "Comments|" + LONG),
        ('<div class="section-search"><p>A section</p></div>', "A section"),
        ('<div class="widget-area content"><p>Content</p></div>', "Content"),
        ('<div class="notice"><p>Mind the step</p></div>', "Mind the step"),
        ('<div class="advertising-history"><p>' + LONG + "</p></div>", LONG),
        ('<blockquote class="reply">As they said</blockquote>', "As they said"),
        ('<pre class="comment"># code</pre>', "# code"),
        ('<p>Text <span class="comment">inline</span></p>', "Text inline"),
        ('<div class="article-header"><p>By someone</p></div>', "By someone"),
        ('<div class="header"><h2>Part</h2><p>Intro</p></div>', "Part|Intro"),
        ('<ul class="menu"><li>Soup of the day</li><li>Bread</li></ul>', "Soup of the day|Bread"),
        ('<table><tr><td class="sidebar">Cell</td></tr></table>', "Cell"),
        ('<figure class="social"><figcaption>Caption</figcaption></figure>', "Caption"),
    ],
)
def test_text_stays(part, text):
    assert inside(part) == text


@pytest.mark.parametrize(
    "part",
    [
        '<div class="ad">Buy now</div>',
        f'<div class="ad">{LONG}</div>',
        '<aside class="sponsored">Buy</aside>',
        '<div class="ad-slot">Buy now</div>',
        '<div class="site-header">Welcome to our site</div>',
        '<div class="header">Head</div>',
        '<ul class="share-links"><li>Share this</li></ul>',
        '<div class="newsletter-signup"><p>Get our letter</p></div>',
        '<div class="related"><a href="/a">One more</a> <a href="/b">Another</a></div>',
        '<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul>',
        f'<div class="comments"><p>{LONG}</p></div>',
        '<div id="comments"><p>Reader says</p></div>',
        f'<div id="comments"><div class="comment"><p>{LONG}</p></div></div>',
        f'<section id="comments"><p>{LONG}</p><form>Reply</form></section>',
        f'<ol class="comment-list"><li>{LONG}</li></ol>',
        "<form>Search</form>",
        '<div style="display: none">Hidden</div>',
        "<nav>Contents</nav>",
    ],
)
def test_furniture_goes(part):
    assert inside(part) == ""


def test_repeated_notices_go():
    """A long notice in articles goes where another page of the host has it, too."""
    notice = f'<div class="newsletter-box"><p>{LONG}</p></div>'
    one, two = (f"<article><p>Text {k}</p>{notice}</article>" for k in range(2))
    assert html_extract.main_texts([one]) == [f"Text 0\n\n{LONG}"]
    assert html_extract.main_texts([one, one]) == [f"Text 0\n\n{LONG}"] * 2  # one page twice is no evidence
    assert html_extract.main_texts([one, two]) == ["Text 0", "Text 1"]


@pytest.mark.parametrize("part", ['<div class="site-header">Welcome to our site</div>', '<div class="header">Head</div>', '<div id="page-header">Head</div>', '<div class="masthead">Head</div>'])
def test_headers_go_without_an_article(part):
    assert html_extract.main_texts([f"<body>{part}<p>Text</p><div class='entry-header'>By me</div></body>"]) == ["Text\n\nBy me"]


def recipe(k, wrap):
    parts = f"<h1>Recipe {k}</h1><h2>Ingredients</h2><p>flour {k} sugar{k}</p><h2>Method</h2><p>mix{k} {k}</p><h2>Serving notes</h2><p>eat{k} {k}</p>"
    return f"<body><div>Welcome to our nice site</div>{wrap[0]}{parts}{wrap[1]}<div>All rights are reserved</div></body>"


@pytest.mark.parametrize("n", [1, 7, 8, 20])
def test_headings_of_every_page_stay(n):
    """The same text however many pages a host has."""
    texts = html_extract.main_texts([recipe(k, ("<article>", "</article>")) for k in range(n)])
    assert texts[0] == "Recipe 0\n\nIngredients\n\nflour 0 sugar0\n\nMethod\n\nmix0 0\n\nServing notes\n\neat0 0"


def test_template_without_an_article():
    """Where no element says what the article is, the template's blocks go, but for headings over text that stays."""
    texts = html_extract.main_texts([recipe(k, ("<div>", "</div>")) for k in range(10)])
    assert texts[3] == "Recipe 3\n\nIngredients\n\nflour 3 sugar3\n\nMethod\n\nmix3 3\n\nServing notes\n\neat3 3"


def by_hand(page):
    """Blocks of a page of known elements by a plain parser: those in an article, without elements that are marked to go."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__()
            self.stack, self.blocks, self.text = [], [], ""

        def close_block(self):
            if words := " ".join(self.text.split()):
                if "article" in (s[0] for s in self.stack) and not any(s[1] for s in self.stack):
                    self.blocks.append(words)
            self.text = ""

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                self.text += " "
                return
            if tag not in ("b", "a", "em"):
                self.close_block()
            self.stack.append((tag, tag in ("nav", "form", "aside", "footer") or "data-go" in dict(attrs)))

        def handle_endtag(self, tag):
            if tag not in ("b", "a", "em"):
                self.close_block()
            self.stack.pop()

        def handle_data(self, data):
            self.text += data

    p = P()
    p.feed(page)
    p.close()
    p.close_block()
    return "\n\n".join(p.blocks)


@pytest.mark.parametrize("seed", range(40))
def test_blocks_against_a_plain_parser(seed):
    """Random articles of text elements and furniture, nested; furniture is marked for the plain parser alone."""
    import random

    r = random.Random(seed)
    keep = ["<p>{}</p>", '<section id="search">{}</section>', '<div class="chapter">{}</div>', '<blockquote class="reply">{}</blockquote>', '<h2 id="comments">{}</h2>', "<ul><li>{}</li></ul>", "<p>a <b>{}</b>&amp; c<br>d</p>", "<table><tr><td>{}</td></tr></table>"]
    drop = ['<div class="ad" data-go>{}</div>', "<nav>{}</nav>", '<div class="comments" data-go>{}</div>', "<form>{}</form>", '<div class="related" data-go><a href="/x">{}</a></div>', "<aside>{}</aside>"]

    def part(depth):
        shape = r.choice(keep if r.random() < 0.7 else drop)
        deep = depth < 3 and not any(t in shape for t in ("<p>", "<h2", "<a ")) and r.random() < 0.5
        return shape.format("".join(part(depth + 1) for _ in range(r.randint(1, 3))) if deep else " ".join(f"w{r.randint(0, 999)}" for _ in range(r.randint(1, 40))))

    page = f"<html><body><nav>Menu</nav><div>Outside</div><article>{''.join(part(0) for _ in range(8))}</article><footer>Foot</footer></body></html>"
    assert html_extract.main_texts([page]) == [by_hand(page)]
