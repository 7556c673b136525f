"""A small labelled table of text blocks: example pages, each block with 1 (article) or 0.

Written for this library. A page is a list of pieces; a piece with a label is markup that
holds one block of text, the others open or close what is around it. ``{n}`` in a piece is
replaced by that many words of running text.
"""

from __future__ import annotations

NAV = '<ul><li><a href="/a">Home</a></li>'

PAGES: tuple[tuple[tuple[int | None, str], ...], ...] = (
    # An article element, with a menu, an advert in prose and a footer in prose.
    (
        (None, "<nav><ul>"),
        (0, '<li><a href="/1">{1}</a></li>'),
        (0, '<li><a href="/2">{1}</a></li>'),
        (0, '<li><a href="/3">{2}</a></li>'),
        (None, "</ul></nav>"),
        (0, '<div class="ad">{14}</div>'),
        (None, "<article>"),
        (1, "<h1>{9}</h1>"),
        (1, "<p>{12}</p>"),
        (1, "<p>{45}</p>"),
        (1, "<p>{1}</p>"),
        (1, "<p>{3}</p>"),
        (1, '<p>{20} <a href="/x">{4}</a> {9}</p>'),
        (1, "<p>{80}</p>"),
        (None, "</article>"),
        (0, "<footer>{11}</footer>"),
    ),
    # One paragraph between boilerplate that is longer than it.
    (
        (0, "<header>{6}</header>"),
        (0, '<div id="cookie-notice">{30}</div>'),
        (None, "<main>"),
        (1, "<h1>{3}</h1>"),
        (1, "<p>{2}</p>"),
        (None, "</main>"),
        (0, "<aside>{40}</aside>"),
        (0, "<footer>{25}</footer>"),
    ),
    # Readers' comments and a form after the article.
    (
        (0, "<header>{2}</header>"),
        (None, "<article>"),
        (1, "<h1>{7}</h1>"),
        (1, "<p>{60}</p>"),
        (1, "<ul><li>{5}</li>"),
        (1, '<li><a href="/y">{3}</a></li>'),
        (1, "<li>{8}</li></ul>"),
        (1, "<blockquote>{22}</blockquote>"),
        (1, '<p><a href="/z">{6}</a></p>'),
        (None, "</article>"),
        (None, '<section id="comments">'),
        (0, "<h3>{2}</h3>"),
        (0, '<div class="comment">{35}</div>'),
        (0, '<div class="comment">{4}</div>'),
        (None, "</section>"),
        (None, "<form>"),
        (0, "<p>{10}</p>"),
        (None, "</form>"),
        (0, '<div class="sidebar">{18}</div>'),
        (0, '<footer><a href="/c">{2}</a></footer>'),
    ),
    # No article element: long blocks with few links are the text.
    (
        (0, '<div><a href="/1">{2}</a> <a href="/2">{1}</a> <a href="/3">{2}</a></div>'),
        (0, '<div><a href="/4">{3}</a></div>'),
        (1, "<h1>{8}</h1>"),
        (1, "<div>{70}</div>"),
        (1, "<div>{35} {5}</div>"),
        (1, "<p>{18}</p>"),
        (1, '<p>{30} <a href="/q">{2}</a> {20}</p>'),
        (1, "<p>{55}</p>"),
        (0, '<div><a href="/5">{2}</a></div>'),
        (0, '<div><a href="/6">{4}</a> <a href="/7">{4}</a></div>'),
        (0, "<div>{3}</div>"),
    ),
    (
        (0, '<p><a href="/1">{1}</a> <a href="/2">{1}</a></p>'),
        (1, "<h2>{5}</h2>"),
        (1, "<p>{25}</p>"),
        (1, "<p>{6}</p>"),
        (1, "<p>{28}</p>"),
        (0, '<p><a href="/8">{5}</a></p>'),
        (0, '<p><a href="/9">{3}</a> {1}</p>'),
    ),
    # Boilerplate inside the article element.
    (
        (None, "<article>"),
        (1, "<h1>{6}</h1>"),
        (1, "<p>{33}</p>"),
        (0, '<div class="advertisement">{20}</div>'),
        (1, "<p>{4}</p>"),
        (0, '<div class="share-buttons"><a href="/s">{1}</a></div>'),
        (1, "<p>{29}</p>"),
        (0, '<nav><a href="/n">{2}</a></nav>'),
        (0, "<footer>{7}</footer>"),
        (None, "</article>"),
        (0, '<div role="alert">{16}</div>'),
    ),
    # Nothing is named: short blocks are text among long ones, and not among links or other short ones.
    (
        (0, '<div><a href="/1">{2}</a></div>'),
        (0, "<div>{9}</div>"),
        (0, '<div><a href="/2">{3}</a> <a href="/3">{2}</a></div>'),
        (1, "<div>{7}</div>"),
        (1, "<div>{64}</div>"),
        (1, "<div>{9}</div>"),
        (1, "<div>{41}</div>"),
        (1, "<div>{3}</div>"),
        (1, "<div>{52}</div>"),
        (0, '<div><a href="/4">{4}</a></div>'),
        (0, "<div>{12}</div>"),
        (0, '<div><a href="/5">{1}</a> <a href="/6">{1}</a></div>'),
        (0, "<div>{5}</div>"),
    ),
    (
        (0, "<p>{4}</p>"),
        (0, '<p><a href="/1">{2}</a></p>'),
        (0, "<p>{7}</p>"),
        (0, '<p><a href="/2">{2}</a> {1}</p>'),
        (1, "<h1>{10}</h1>"),
        (1, "<p>{38}</p>"),
        (1, "<p>{5}</p>"),
        (1, "<p>{47}</p>"),
        (1, "<p>{13}</p>"),
        (1, '<p>{22} <a href="/x">{3}</a></p>'),
        (1, "<p>{8}</p>"),
        (1, "<p>{33}</p>"),
        (0, '<p><a href="/3">{6}</a></p>'),
        (0, "<p>{13}</p>"),
        (0, '<p><a href="/4">{5}</a></p>'),
        (0, "<p>{8}</p>"),
        (0, '<p><a href="/5">{7}</a></p>'),
    ),
    # A link of its own between long blocks is part of the text; so is a list of links among them.
    (
        (0, '<div><a href="/1">{1}</a> <a href="/2">{1}</a> <a href="/3">{1}</a></div>'),
        (0, "<div>{3}</div>"),
        (0, '<div><a href="/4">{2}</a></div>'),
        (1, "<h1>{6}</h1>"),
        (1, "<p>{44}</p>"),
        (1, '<p><a href="/y">{5}</a></p>'),
        (1, "<p>{51}</p>"),
        (1, "<p>{26}</p>"),
        (1, '<p>{4} <a href="/z">{9}</a></p>'),
        (1, "<p>{37}</p>"),
        (1, "<p>{6}</p>"),
        (0, '<ul><li><a href="/5">{4}</a></li>'),
        (0, '<li><a href="/6">{3}</a></li>'),
        (0, "<li>{2}</li>"),
        (0, '<li><a href="/7">{5}</a></li></ul>'),
        (0, "<div>{10}</div>"),
        (0, '<div><a href="/8">{1}</a></div>'),
    ),
    # A long teaser between links is none of the text, nor is a line of rights after them.
    (
        (0, '<div><a href="/1">{3}</a></div>'),
        (0, '<div><a href="/2">{8}</a></div>'),
        (0, "<div>{15}</div>"),
        (0, '<div><a href="/3">{7}</a></div>'),
        (0, "<div>{14}</div>"),
        (0, '<div><a href="/4">{9}</a></div>'),
        (1, "<h1>{7}</h1>"),
        (1, "<div>{90}</div>"),
        (1, "<div>{15}</div>"),
        (1, "<div>{75}</div>"),
        (1, "<div>{14}</div>"),
        (1, "<div>{60}</div>"),
        (0, '<div><a href="/5">{3}</a> <a href="/6">{2}</a></div>'),
        (0, "<div>{11}</div>"),
    ),
    # The text begins without a heading, right after the links.
    (
        (0, '<div><a href="/1">{2}</a> <a href="/2">{1}</a></div>'),
        (0, "<div>{5}</div>"),
        (0, '<div><a href="/3">{3}</a> <a href="/4">{1}</a></div>'),
        (1, "<div>{58}</div>"),
        (1, "<div>{6}</div>"),
        (1, "<div>{31}</div>"),
        (0, '<div><a href="/5">{2}</a> <a href="/6">{2}</a></div>'),
        (0, "<div>{6}</div>"),
        (0, '<div><a href="/7">{2}</a></div>'),
    ),
    (
        (0, '<p><a href="/1">{5}</a></p>'),
        (1, "<p>{72}</p>"),
        (1, '<p><a href="/y">{6}</a></p>'),
        (1, "<p>{43}</p>"),
        (1, "<p>{7}</p>"),
        (1, "<p>{29}</p>"),
        (0, '<p><a href="/2">{2}</a></p>'),
    ),
    # Inside an article a link of its own is text wherever it stands.
    (
        (0, '<nav><a href="/1">{2}</a></nav>'),
        (None, "<article>"),
        (1, "<h1>{7}</h1>"),
        (1, '<p><a href="/x">{5}</a></p>'),
        (1, "<p>{60}</p>"),
        (1, "<p>{9}</p>"),
        (1, '<p><a href="/y">{4}</a></p>'),
        (1, "<p>{48}</p>"),
        (1, '<p><a href="/z">{6}</a></p>'),
        (1, "<h2>{4}</h2>"),
        (1, '<p><a href="/v">{3}</a></p>'),
        (1, "<p>{52}</p>"),
        (None, "</article>"),
        (0, '<div><a href="/2">{3}</a></div>'),
    ),
)
