import random
import time

import pytest
import zstandard

from recon360.llm import html_diff as h

SCHEMA = "page_id long, url string, html string, text string, page long, others string"


def _texts(spark, work, rows):
    pages = spark.createDataFrame([(*r, "own text", 5, "x") for r in rows], SCHEMA)
    return {r.page_id: r for r in h.extract(pages, work).collect()}


def _page(body, host="h.example"):
    return f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_structure_and_references():
    page = _page(
        '<header><p>Site</p></header><nav><ul><li><a href="/">Home</a></ul></nav><script>var a="</p>";</script><!-- <p>no</p> -->'
        "<article><header><h1>The  &amp;\n title</h1></header><p>One <b>bo</b>ld<br>line &eacute;&#x41;<p>Two"
        '<form><p>Mail</form><div class="ad-slot"><p>Buy</div><aside>Side</aside><section class="comments"><p>Nice</section>'
        '<div hidden>No</div><ul><li>a<li>b</ul><p>1 < 2 &am</article><footer>&copy; x'
    )
    assert h.main_text(h.lines(page), set()) == "The & title\n\nOne bold line éA\n\nTwo\n\na\n\nb\n\n1 < 2 &am"


def test_broken_markup():
    assert h.lines(None) == [] and h.lines("") == []
    assert [x.text for x in h.lines("a<p>b</div></p>c<b")] == ["a", "b", "c"]
    assert [x.text for x in h.lines("x<script>never ends <p>y")] == ["x"]
    assert [x.text for x in h.lines('<p title="a > b">x</p><p class=>y')] == ["x", "y"]
    assert len(h.lines("<div>" * 5000 + "deep")) == 1


def _brute(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 20])
def test_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(h, "ROW_BITS", bits)
    random.seed(2)
    for _ in range(500):
        a, b = ([random.randint(0, 6) for _ in range(random.randint(0, 14))] for _ in range(2))
        kept = sorted(h.common_lines(a, b))
        assert len(kept) == _brute(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in kept)  # in order


def test_lines_that_repeat_do_not_stall_a_page():
    random.seed(7)
    a, b = ([random.choice((0, 1)) for _ in range(8000)] for _ in range(2))
    start = time.process_time()
    kept = h.common_lines(a, b)
    assert time.process_time() - start < 5 and len(kept) > 5000


def test_shared_lines_go_without_an_article(spark, work):
    page = "<div>Example Shop</div><div>Choose your language</div><p>{}</p><p>{}</p><div>Back to the top</div>"
    rows = [
        (1, "http://a.example/x/1", page.format("first story " * 9, "more of it " * 9)),
        (2, "http://a.example/x/2?q=1", page.format("second story " * 9, "other " * 9)),
        (3, "http://a.example/zz", page.format("third " * 9, "last " * 9)),
        (4, "http://alone.example/", page.format("x", "y")),
    ]
    got = _texts(spark, work, rows)
    assert got[1].text == ("first story " * 9).strip() + "\n\n" + ("more of it " * 9).strip()
    assert got[3].text.startswith("third") and "Back" not in got[3].text and got[3].n_chars == len(got[3].text)
    assert got[4].text.startswith("Example Shop")  # no neighbour


def test_copies_and_quotes_stay(spark, work):
    story = "<nav>Menu</nav><article><h1>Title</h1><p>A passage that is quoted.</p><p>{}</p></article><div>Foot</div>"
    rows = [
        (1, "http://a.example/1", story.format("own " * 5)),
        (2, "http://a.example/2", story.format("own " * 5)),
        (3, "http://a.example/3", story.format("different " * 5)),
        (4, "http://b.example/1", "<p>same words on both</p>"),
        (5, "http://b.example/1", "<p>same words on both</p>"),
        (5, "http://b.example/1", "<p>same words on both</p>"),
    ]
    pages = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    got = sorted((r.page_id, r.text) for r in h.extract(pages, work).collect())
    assert got[0][1] == "Title\n\nA passage that is quoted.\n\nown own own own own"
    assert got[2][1].endswith("different different")
    assert [t for _, t in got[3:]] == ["same words on both"] * 3


def test_article_of_the_template_goes(spark, work):
    teaser = "<article><p>Most read</p><p>Old news</p></article>"
    rows = [(i, f"http://a.example/{i}", f"<main><p>Story number {i} {'long ' * 20}</p></main>{teaser}") for i in (1, 2)]
    got = _texts(spark, work, rows)
    assert got[1].text.startswith("Story number 1") and "Most read" not in got[1].text


def test_neighbours_span_partitions(spark, work):
    rows = [(f"h{i % 3}", f"/{i:04d}", i, [i]) for i in range(500)]
    hashed = spark.createDataFrame(rows, "host string, path string, page long, hashes array<long>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {(r.page, r.other) for r in h.neighbours(hashed, work).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got == {(i, j) for i in range(500) for j in (i - 3, i + 3) if 0 <= j < 500}


def test_messy_table(spark, work):
    rows = [
        (1, None, "<p>no address</p>"), (None, "http://a.example/1", "<p>x</p>"), (2, "http://a.example/2", None),
        (3, "not a url", ""), (4, "", "<p>no address either</p>"), (4, "", "<p>no address either</p>"), (None, None, None),
    ]
    pages = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    got = h.extract(pages, work).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == sorted(
        (str(i), t, len(t)) for i, t in ((1, "no address"), (None, "x"), (2, ""), (3, ""), (4, "no address either"), (4, "no address either"), (None, ""))
    )
    assert h.extract(pages.limit(0), type(work)(spark, work.path("none"))).count() == 0


def test_a_long_template_goes_from_short_pages(spark, work):
    page = "<div>{}</div><p>short story {}</p><div>{}</div>"
    rows = [(i, f"http://a.example/{i}", page.format("the shop's banner " * 9, i, "its terms of use " * 9)) for i in range(1, 6)]
    assert {i: r.text for i, r in _texts(spark, work, rows).items()} == {i: f"short story {i}" for i in range(1, 6)}


def test_copies_are_held_against_the_nearest_different_page(spark, work):
    page = "<div>Example Shop</div><p>{}</p><div>Back to the top</div>"
    rows = [(i, f"http://a.example/copy/{i:02d}", page.format("one story " * 9)) for i in range(12)]
    rows += [(i, f"http://a.example/other/{i}", page.format(f"story number {i} " * 9)) for i in (50, 51)]
    got = _texts(spark, work, rows)
    assert {got[i].text for i in range(12)} == {("one story " * 9).strip()}
    assert got[50].text == ("story number 50 " * 9).strip()


def test_a_near_copy_tells_nothing_while_another_page_is_around(spark, work):
    page = "<div>Example Shop</div><p>{}</p><p>{}</p><div>Back to the top</div>"
    rows = [(i, f"http://a.example/a/{i}", page.format("one long story " * 9, f"seen {i} times")) for i in (1, 2)]
    rows += [(3, "http://a.example/b", page.format("another story " * 9, "never seen"))]
    assert _texts(spark, work, rows)[1].text == ("one long story " * 9).strip() + "\n\nseen 1 times"


def test_recurring_lines_go_from_an_article(spark, work):
    page = "<article><p>{}</p><p>Share this story</p></article>"
    rows = [(i, f"http://a.example/{i}", page.format(f"story number {i} " * 9)) for i in range(1, 5)]
    got = _texts(spark, work, rows)
    assert {i: r.text for i, r in got.items()} == {i: (f"story number {i} " * 9).strip() for i in range(1, 5)}
    # near copies agree on the story as well, which is no template
    rows = [(i, f"http://b.example/{i}", f"<article><p>{'one story ' * 9}</p><p>seen {i} times</p></article>") for i in range(1, 5)]
    assert _texts(spark, type(work)(spark, work.path("b")), rows)[1].text == ("one story " * 9).strip() + "\n\nseen 1 times"


def _own(page):
    return h.main_text(h.lines(page), set()).split("\n\n")


def test_drawings_and_custom_elements_take_no_text_with_them():
    assert _own('<p>first</p><svg class="icon"/><p>second</p><math/><p>third</p>') == ["first", "second", "third"]
    assert _own("<p>a <svg><title>no</title><svg><text>no</text></svg><text>no</text></svg> b</p><svg><path><p>c</p>") == ["a b", "c"]
    assert _own("<svg><foreignObject><p>no</p></foreignObject></svg><p>x</p>") == ["x"]
    assert _own("<video-player><p>x</p></video-player><select-list><p>y</p></select-list><video>no</video><p>z</p>") == ["x", "y", "z"]


def test_names_that_merely_contain_a_word_take_no_text():
    for name in ("content has-sidebar", "page no-comments", "entry-header", "widget-free"):
        assert _own(f'<div class="{name}"><p>text</p></div><p>more</p>') == ["text", "more"]
    assert _own('<div class="Cookie_Banner">no</div><div id="sidebar">no</div><p>a</p><p>b</p>') == ["a", "b"]


def test_elements_around_the_text_are_wanted():
    assert _own('<form><nav>no</nav><div class="widget"><main><p>text</p></main></div></form>') == ["text"]
    assert _own('<form id="all"><nav>no</nav><article>text</article></form><footer>no</footer>') == ["text"]
    assert _own(f'<div class="header"><p>{"text " * 9}</p><nav>no</nav></div><div class="comments">nice</div>') == [("text " * 9).strip()]
    # comments are articles of their own where the page has its article
    assert _own(f'<article>text</article><section class="comments"><article>{"nice " * 9}</article></section>') == ["text"]


def test_packed_lines_come_back_and_are_less_than_the_page():
    press, unpress = zstandard.ZstdCompressor(level=9), zstandard.ZstdDecompressor()
    random.seed(3)
    story = " ".join(str(random.random()) for _ in range(40))
    marked = "".join(f'<div class="c{random.random()}">{part}</div>' for part in story.split())
    for page in (None, "", "<p></p>", "<p>\u2028 a\x1f\x00b &#x85;<p>\U0001f600 &#xD800; \\ \"", f"<nav>Menu</nav><main>{marked}</main><article>x</article>"):
        assert h.unpack_lines(h.pack_lines(h.lines(page), press), unpress) == h.lines(page)
    assert len(h.pack_lines(h.lines(marked), press)) < 0.6 * len(press.compress(marked.encode()))
