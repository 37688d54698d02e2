from __future__ import annotations

import random

import pytest

from ledgerloom.llm.html import extract_main_text, main_blocks
from tests.conftest import rows

LONG = "word " * 40


@pytest.mark.parametrize(
    ("page", "blocks"),
    [
        ("", []),
        ("<p>x", ["x"]),
        ("no markup &amp; one line", ["no markup & one line"]),
        ("<!-- <p>a</p> --><script>'<p>b</p>'</script><style>p{}</style>", []),
        ("<article><h1>T</h1><p>a\n  b&nbsp;c<br>d</p><p></p><p>e</article><footer>f</footer>", ["T", "a b c d", "e"]),
        ("<main><header><h1>T</h1><p>by x</p></header><p>one</p><form><p>mail</p></form><aside>s</aside></main>", ["T", "one"]),
        ("<article><p>a</p><p class='advert'>buy</p><section id=comments><article><p>c</p></article></section></article>", ["a"]),
        ("<body class='has-sidebar'><article><p title='1>0'>a <b>b</b></p><div class=cookie-notice>c</div></article>", ["a b"]),
        ("<article><p>1 < 2 &lt;b&gt; &copy; x</p></article>", ["1 < 2 <b> © x"]),
        ("<article><div hidden>h</div><div style='display: none'>n</div><p>a</p></article>", ["a"]),
    ],
)
def test_pages(page, blocks):
    assert main_blocks(page) == blocks


def test_surge_and_dive_without_an_article():
    page = (
        "<ul><li><a>Home</a></li><li><a>News</a></li></ul>"
        f"<div><h1>Head</h1><p>{LONG}</p><p>short</p><p>{LONG}</p></div>"
        "<ul><li><a>one</a></li><li><a>two</a></li><li><a>three</a></li></ul><p>© 2020 us</p>"
    )
    assert main_blocks(page) == ["Head", LONG.strip(), "short", LONG.strip()]


def test_hostile_markup_is_read_in_linear_time():
    assert main_blocks("<a '" * 20_000) is not None
    assert main_blocks("<div>" * 3000 + "<p>deep</p>") == ["deep"]
    assert len(main_blocks("<p>x" * 50_000)) == 50_000


def test_awkward_rows(spark):
    table = [(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<p>a<p>b", "t"), (3, "u", "<p></p>", None)]
    pages = spark.createDataFrame(table, "page_id long, url string, html string, text string")
    found = extract_main_text(pages, "page_id", "url")
    assert sorted(rows(found), key=repr) == sorted([(1, "u", ""), (1, "u", ""), (None, None, "a\n\nb"), (3, "u", "")], key=repr)
    assert rows(extract_main_text(pages.limit(0), "page_id", "url")) == []


CARD = "<article><h3><a>Another story</a></h3><p>Its teaser.</p></article>"
LINKS = "<ul><li><a>one</a></li><li><a>two</a></li><li><a>three</a></li></ul>"


@pytest.mark.parametrize("page", [f"{CARD}{LINKS}<div><p>{LONG}</p><p>end</p></div>", f"<div><p>{LONG}</p><p>end</p></div>{LINKS}{CARD}"])
def test_an_article_card_does_not_hide_a_body_in_a_div(page):
    assert main_blocks(page) == [LONG.strip(), "end"]


def test_long_cards_beside_a_body_hide_nothing():
    page = f"<div><p>{LONG * 3}</p></div>{LINKS}<article><p>{LONG}</p></article>"
    assert main_blocks(page) == [(LONG * 3).strip(), LONG.strip()]


def test_boilerplate_in_main_is_left_by_surge_and_dive():
    page = f"<main><p>Welcome</p>{LINKS}<div><h1>Head</h1><p>{LONG}</p></div>{LINKS}<p>Call us</p></main>"
    assert main_blocks(page) == ["Head", LONG.strip()]


def test_an_article_with_most_of_the_text_is_whole():
    aside = "<aside><p>a</p><p>b</p><p>c</p></aside>"
    page = f"<article><h1><a>Head</a></h1><p>{LONG}</p>{aside}<p>short</p>{LINKS}<p>end</p></article>"
    assert main_blocks(page) == ["Head", LONG.strip(), "short", "one", "two", "three", "end"]
    assert main_blocks("<div>Shop</div><article><a>only a link</a></article>") != []


def test_a_short_page_is_of_its_main_part():
    assert main_blocks("<div>Shop</div><main><p>short text</p></main>") == ["short text"]
    assert main_blocks(f"<div><p>A short text of the page</p></div>{CARD}") == ["A short text of the page", "Its teaser."]


@pytest.mark.parametrize("tag", ["<svg/>", "<svg class='i' viewBox='0 0 1 1' />", "<math/>", "<svg a=b/ />", "<noscript>", "<object>", "<canvas>", "<template>", "<select>", "<iframe>", "<svg>"])
def test_what_is_never_closed_hides_no_later_text(tag):
    assert main_blocks(f"<article><p>a</p>{tag}<p>b</p></article>") == ["a", "b"]


def test_what_is_closed_is_still_skipped():
    assert main_blocks("<p>a</p><svg/><p>b</p><svg><text>c</text></svg><noscript>d</noscript><p>e</p>") == ["a", "b", "e"]
    assert main_blocks("<p>a</p><script>b<p>c</p>") == ["a"]
    assert len(main_blocks("<p>x<object>" * 20_000)) == 20_000


ASIDE = "<aside><p>a</p><p>b</p><p>c</p></aside>"
ADVERTS = "<div class='ad'><p>buy</p><p>now</p><p>cheap</p></div>"


@pytest.mark.parametrize("between", [ASIDE, LINKS, ADVERTS, ASIDE + LINKS, f"<div>{LINKS}</div>"])
@pytest.mark.parametrize("holder", ["div", "section"])
def test_closing_paragraphs_of_a_body_that_goes_on_are_kept(between, holder):
    body = f"<h1>Head</h1><p>{LONG}</p>{between}<p>A short closing paragraph.</p>"
    page = f"<body><nav><a>Home</a></nav><{holder}>{body}</{holder}><div><p>Call us</p></div></body>"
    assert main_blocks(page) == ["Head", LONG.strip(), "A short closing paragraph."]


def test_opening_lines_and_list_items_of_a_body_are_kept():
    page = f"<div><p>By A. Writer</p>{LINKS}<p>{LONG}</p>{ASIDE}<ul><li>first point</li><li>last point</li></ul></div>"
    assert main_blocks(page) == ["By A. Writer", LONG.strip(), "first point", "last point"]


def test_what_lies_around_the_body_is_still_left():
    page = f"<div><p>Welcome</p>{LINKS}<div><p>{LONG}</p></div>{LINKS}<p>Call us</p></div>"
    assert main_blocks(page) == [LONG.strip()]


def windows_by_hand(lengths):
    """Which lines the window rule keeps, stated over all places at once: lines from a surge back
    to the last empty line and on to the first window without text."""
    n = len(lengths)
    sums = [sum(lengths[i : i + 3]) for i in range(n)]
    kept = set()
    for i in range(n):
        if sums[i] >= 86 and lengths[i]:
            start = i
            while start and lengths[start - 1]:
                start -= 1
            end = next((j for j in range(i, n) if not sums[j]), n)
            kept.update(range(start, end))
    return kept


@pytest.mark.parametrize("seed", range(30))
def test_surge_and_dive_equal_the_rule_stated_plainly(seed):
    rnd = random.Random(seed)
    lengths = [rnd.choice([0, 0, 0, 5, 20, 40, 90]) for _ in range(30)]
    page = "".join(f"<p>{'x' * n}</p>" if n else f"<p><a>link {i}</a></p>" for i, n in enumerate(lengths))
    texts = ["x" * n if n else f"link {i}" for i, n in enumerate(lengths)]
    kept = windows_by_hand(lengths) or {i for i, n in enumerate(lengths) if n}
    assert main_blocks(page) == [t for i, t in enumerate(texts) if i in kept]
