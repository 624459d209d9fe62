"""A small labelled table: blocks of invented pages, + for main text and - for the rest.

Each page is a list of (label, opening, text, closing). ``variants`` repeats the texts of a page in turn, so that
containers and neighbours count for more than the lengths that happen to stand in the table. Pages with plain
containers only are told by words, links and neighbours: headings stand before text, menus and their titles among
links, and lists of links at the end of an article are not part of it.
"""

PROSE = "The river had risen in the night and by morning the lower fields were under water as far as the old mill. "
LINKS = '<a href="/1">Home</a> <a href="/2">News</a> <a href="/3">Sport</a> <a href="/4">Contact us</a>'

PAGES = [
    [
        ("-", "<nav><ul><li>", '<a href="/">Home</a>', "</li>"),
        ("-", "<li>", '<a href="/about">About us</a>', "</li></ul></nav>"),
        ("-", '<div class="ad">', "Buy two and get the third one free until Sunday evening only.", "</div>"),
        ("+", "<article><h1>", "Flood in the valley", "</h1>"),
        ("+", "<p>", PROSE * 3, "</p>"),
        ("+", "<p>", "It rained.", "</p>"),
        ("+", "<p>", PROSE, "</p></article>"),
        ("-", "<footer>", "Copyright example.org. All rights reserved and so on.", "</footer>"),
    ],
    [
        ("-", "<header><h1>", "The Valley Times", "</h1></header>"),
        ("-", "<nav>", LINKS, "</nav>"),
        ("+", "<main><h2>", "Market day", "</h2>"),
        ("+", "<p>", PROSE * 2, "</p>"),
        ("+", "<ul><li>", "Eggs", "</li>"),
        ("+", "<li>", "Flour and milk", "</li></ul>"),
        ("+", "<p>", 'See <a href="/x">the full list of stalls</a>', "</p></main>"),
        ("-", "<aside><p>", "More stories from the region that you may like to read next week.", "</p></aside>"),
        ("-", "<form><p>", "Subscribe to our newsletter and never miss a story again.", "</p></form>"),
        ("-", "<footer><p>", PROSE, "</p></footer>"),
    ],
    [
        ("-", "<div>", LINKS, "</div>"),
        ("+", "<div><h1>", "A walk in the hills", "</h1>"),
        ("+", "<p>", PROSE * 2, "</p>"),
        ("+", "<p>", "We went on.", "</p>"),
        ("+", "<p>", PROSE * 4, "</p></div>"),
        ("-", "<div>", LINKS, "</div>"),
        ("-", "<div>", "Imprint", "</div>"),
    ],
    [
        ("-", "<div>", "Menu", "</div>"),
        ("-", "<div>", '<a href="/login">Log in</a>', "</div>"),
        ("-", "<div>", LINKS, "</div>"),
        ("+", "<div>", PROSE, "</div>"),
        ("+", "<div>", PROSE * 2, "</div>"),
        ("-", "<div>", '<a href="/5">Older</a> <a href="/6">Newer</a>', "</div>"),
        ("-", "<div>", "Share", "</div>"),
        ("-", "<div>", LINKS, "</div>"),
    ],
    [
        ("-", '<div class="cookie-notice"><p>', PROSE, "</p></div>"),
        ("+", '<div id="content"><h1>', "Bread", "</h1>"),
        ("+", "<p>", "Mix. Wait. Bake.", "</p>"),
        ("+", "<p>", PROSE, "</p></div>"),
        ("-", '<div class="comments"><p>', "Great recipe, I made it twice and my whole family loved it, thanks!", "</p>"),
        ("-", "<p>", PROSE * 2, "</p></div>"),
        ("-", '<div id="sidebar"><p>', PROSE, "</p></div>"),
    ],
    [
        ("+", "<article><p>", PROSE, "</p>"),
        ("-", '<div class="advert"><p>', PROSE, "</p></div>"),
        ("+", "<p>", "Then it stopped.", "</p>"),
        ("+", "<blockquote>", "Nobody saw it coming.", "</blockquote>"),
        ("-", '<section class="comments"><p>', "First!", "</p></section></article>"),
        ("-", "<div>", '<a href="/7">Next article</a>', "</div>"),
    ],
    [
        ("-", "<p>", '<a href="/8">Skip to text</a>', "</p>"),
        ("+", "<p>", PROSE * 3, "</p>"),
        ("+", "<p>", PROSE, "</p>"),
        ("-", "<p>", '<a href="/9">Back to top</a>', "</p>"),
    ],
    [
        ("-", "<div>", LINKS, "</div>"),
        ("+", "<div>", "The ferry does not sail today because of the wind.", "</div>"),
        ("+", "<div>", "Tomorrow it will leave an hour later than usual.", "</div>"),
        ("-", "<div>", LINKS, "</div>"),
        ("-", "<div>", "Imprint", "</div>"),
    ],
    [
        ("+", "<article><h1>", '<a href="/self">Flood in the valley</a>', "</h1>"),
        ("+", "<p>", PROSE * 3, "</p>"),
        ("+", "<p>", "It rained.", "</p>"),
        ("+", "<p>", PROSE, "</p>"),
        ("-", "<ul><li>", '<a href="/11">Other story</a>', "</li>"),
        ("-", "<li>", '<a href="/12">More from the region this week</a>', "</li>"),
        ("-", "<li>", '<a href="/13">All stories</a>', "</li></ul></article>"),
    ],
    [
        ("+", "<main><h1>", '<a href="/self">Market day</a>', "</h1>"),
        ("+", "<p>", PROSE * 2, "</p>"),
        ("+", "<p>", 'See <a href="/x">the full list of stalls</a>', "</p>"),
        ("+", "<h2>", "Prices", "</h2>"),
        ("+", "<p>", PROSE, "</p>"),
        ("-", "<p>", '<a href="/14">Next market</a>', "</p>"),
        ("-", "<p>", '<a href="/15">Last market</a> <a href="/16">Overview</a>', "</p></main>"),
    ],
    [
        ("-", "<div>", LINKS, "</div>"),
        ("+", "<div><h1>", "Ferry cancelled", "</h1>"),
        ("+", "<p>", "The ferry does not sail today because of the wind.", "</p></div>"),
        ("-", "<div>", LINKS, "</div>"),
        ("-", "<div>", "Imprint", "</div>"),
    ],
    [
        ("-", "<div>", "Sections", "</div>"),
        ("-", "<div>", LINKS, "</div>"),
        ("+", "<div><h1>", "Harbour closed", "</h1>"),
        ("+", "<p>", PROSE * 2, "</p>"),
        ("+", "<h2>", "Why", "</h2>"),
        ("+", "<p>", "A storm came.", "</p>"),
        ("+", "<p>", PROSE, "</p></div>"),
        ("-", "<div>", "Read on", "</div>"),
        ("-", "<div>", '<a href="/17">Older</a> <a href="/18">Newer</a>', "</div>"),
        ("-", "<div>", LINKS, "</div>"),
        ("-", "<div>", "Contact", "</div>"),
    ],
    # Text to the very end of the page.
    [("-", "<ul><li>", '<a href="/">Home</a>', "</li></ul>"), ("+", "<div><p>", PROSE, "</p></div>")],
    [("-", "<div>", LINKS, "</div>"), ("+", "<div><h1>", "Snow", "</h1>"), ("+", "<p>", PROSE * 2, "</p>"), ("+", "<p>", PROSE, "</p></div>")],
    [("+", "<div>", PROSE, "</div>")],
    [("+", "<div>", "The shop opens at nine and closes at noon on Saturdays.", "</div>")],
    [("+", "<article><h1>", "Rain", "</h1>"), ("+", "<p>", "It rained.", "</p></article>")],
    [("+", "<main><p>", PROSE * 3, "</p>"), ("+", "<p>", "Nobody came.", "</p></main>")],
    [("-", "<nav>", LINKS, "</nav>"), ("+", "<main><p>", PROSE, "</p>"), ("+", "<p>", "Then it stopped.", "</p></main>")],
]

REPEATS = ((1, 1, 1, 1), (1, 2, 4, 8), (4, 1, 8, 2), (8, 4, 2, 1), (2, 8, 1, 4))


def variants(page: list[tuple[str, str, str, str]]) -> list[list[tuple[str, str, str, str]]]:
    """The page with its texts repeated; titles of one or two words outside main text stay what they are."""

    def repeated(label: str, text: str, times: int) -> str:
        return text if label == "-" and len(text.split()) < 3 else " ".join([text] * times)

    return [
        [(label, opening, repeated(label, text, times[i % 4]), closing) for i, (label, opening, text, closing) in enumerate(page)]
        for times in REPEATS
    ]
