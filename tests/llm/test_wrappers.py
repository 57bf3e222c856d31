"""Main texts of pages of several templates, wrappers, and broken html."""

import random

import pytest

from gneiss.llm import wrappers

PAGES = "page_id BIGINT, url STRING, html STRING"


def semantic(title, blocks, i):
    body = "".join(f"<p>{b}</p>" for b in blocks)
    return (f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{x:1}}</style><script>var a="<p>no</p>";</script></head><body>'
            f'<header><p>Site name</p></header><nav><ul><li><a href="/a">Menu {i}</a></li></ul></nav><!-- ad --><div class="ad">Buy {i}</div>'
            f'<aside><p>Related {i}</p></aside><article><h1>{title}</h1>{body}<form><p>Subscribe</p></form><section class="comments"><p>Reader {i}</p></section></article>'
            f'<div id="cookie-notice"><p>We use cookies</p></div><footer>&copy; {i}</footer></body></html>')


def plain_divs(title, blocks, i):
    body = "".join(f'<div class="line">{b}</div>' for b in blocks)
    return (f'<html><body><div class="top"><a href="/">Home</a> <a href="/n">News {i}</a></div><div class="story"><h2>{title}</h2><div class="text">{body}</div></div>'
            f'<div class="bottom">All rights reserved</div></body></html>')


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(2)
    rows = []
    for i in range(60):
        blocks = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "sit"], k=rng.randint(8, 40))) for _ in range(rng.randint(2, 6))]
        rows.append((i, f"http://www.a.example/{i}", semantic(f"Title {i}", blocks, i), "\n".join([f"Title {i}", *blocks])))
    return rows


def test_article_of_the_semantic_template(spark, pages):
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame([p[:3] for p in pages], PAGES).repartition(3)).collect()}
    assert got == {p[0]: p[3] for p in pages}


def test_wrapper_finds_the_main_part_without_an_article(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(20):
        blocks = [" ".join(rng.choices(["one", "two", "three"], k=30)) + f" {i}" for _ in range(3)]
        rows.append((i, f"https://b.example/{i}?q", plain_divs(f"Head {i}", blocks, i)))
        want[i] = blocks
    got = {r.page_id: r.text.split("\n") for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    for i, blocks in want.items():
        assert set(blocks) <= set(got[i]) and "All rights reserved" not in got[i] and not any("News" in x for x in got[i])


def test_groups_merge_into_optional_repeated_and_slots():
    def tree(page):
        return wrappers.Group.of(wrappers.parse(page))

    one = tree("<div><p>same</p><p>a</p><p>b</p></div><table><tr><td>x</td></tr></table>")
    two = tree("<div><p>same</p></div>")
    merged = one.merge(two)
    by_mark = {g.mark: g for g in merged.inside}
    assert by_mark["table"].optional and not by_mark["div"].optional
    assert by_mark["div"].inside[0].mark == "p" and by_mark["div"].inside[0].repeated
    assert tree("<p>same</p>").merge(tree("<p>same</p>")).inside[0].inside[0].constant is not None
    assert tree("<p>same</p>").merge(tree("<p>other</p>")).inside[0].inside[0].constant is None


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<article><p>a &amp; b&#33;<p>c\n d  e</article>", "a & b!\nc d e"),
    ("<article><p>one<br>two</p><ul><li>x<li>y</ul>", "one two\nx\ny"), ("<article>a<b>b</b>c <i>d</i></article>", "abc d"),
    ("<article><p>x</p><div class='comments'><p>no</p></div><p>y</p></article>", "x\ny"), ("<main><p>m</p></main><p>out</p>", "m"),
    ("<article><p>a</p><script>if (1 < 2) {</script><p>b</p><style>p</style>", "a\nb"), ("<p>a</p><!-- <p>b</p> --><p>c</p>", "a\nc"),
    ("<article><p>a</p></article><nav>n</nav><article><p>b</p></article>", "a\nb"), ("<" * 50, "<" * 50),
])
def test_broken_and_small_pages(page, text):
    assert wrappers.extract(page, None) == text


def test_deep_and_long_pages():
    deep = wrappers.extract("<div>" * 3000 + "x" + "</div>" * 3000, None)
    assert deep == "x"
    for depth in (1, 97, 98, 99, 150, 3000):
        page = "<article>" + "<div>" * depth + "<p>a<p>b<nav>menu<div>more</div></nav>c" + "</div>" * depth + "<p>tail</p></article><p>out</p>"
        assert wrappers.extract(page, None) == "a\nb\nc\ntail", depth
    assert wrappers.extract("<div>" * 200 + "x</section></p>" + "</div>" * 150 + "y", None) == "x\ny"
    long = "word " * 200_000
    assert wrappers.extract(f"<article><p>{long}</p></article>", None) == long.strip()
    wrappers.infer([wrappers.Group.of(wrappers.parse("<div>" * 500 + str(i))) for i in range(3)])


def test_large_wrappers_are_joined_by_host(spark, pages, monkeypatch):
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame([p[:3] for p in pages], PAGES)).collect()}
    assert got == {p[0]: p[3] for p in pages}


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "", ""), (1, "", ""), (2, "no host", "<p>x</p>"), (3, "http://H.example:80/x", "<p>y</p>"), (4, "//u@h.example", "<p>z</p>")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS host", "2 AS wrapper", "3 AS salt")
    got = wrappers.main_text(df).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == [("1", ""), ("1", ""), ("2", "x"), ("3", "y"), ("4", "z"), ("None", "")]
    hosts = [r[0] for r in df.select(wrappers.host(df.url)).collect()]
    assert hosts == ["", "", "", "", "h.example", "h.example"]
    assert wrappers.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ('<div class="layout with-sidebar"><article><p>a</p></article></div>', "a"), ('<div class="page sidebar"><div><article><p>a</p></article></div></div>', "a"),
    ('<article><h2 id="related-work">Related work</h2><p>a</p></article>', "Related work\na"),
    ('<article><section id="search-algorithms"><p>a</p></section></article>', "a"),
    ('<article><p>a</p></article><div class="related"><article><p>teaser</p></article></div>', "a"),
    ('<article><p>a</p></article><aside><article><p>no</p></article></aside>', "a"), ('<article><p>a</p><div class="social-share">no</div></article>', "a"),
])
def test_names_do_not_drop_the_article(page, text):
    assert wrappers.extract(page, None) == text


def test_varying_text_overrules_a_weak_word_within_the_article(spark):
    rows = [(i, f"http://c.example/{i}", f'<article><p>text {i}</p><div class="alert"><p>Mind step {i} of the recipe</p></div>'
             f'<div class="notice">Subscribe now</div><div class="related"><a href="/{i}">Other page {i}</a></div>'
             f'<section class="comments"><p>Reader {i} says</p></section></article>') for i in range(20)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"text {i}\nMind step {i} of the recipe" for i in range(20)}


def notice_pages(n):
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(n):
        lines = [" ".join(rng.choices(["one", "two", "three"], k=12)) + f" {i} {k}" for k in range(3)]
        mail = ["<p>Subscribe to our daily mail for more.</p>"] if i % 5 else []
        rows.append((i, f"http://d.example/{i}", "<article><h2>Summary</h2>" + "".join(f"<p>{x}</p>" for x in lines) + "".join(mail) + "</article>"))
        want[i] = "\n".join(["Summary", *lines])
    return rows, want


def test_wrapper_takes_the_template_out_of_articles(spark):
    """A notice within the article, told from its text by the wrapper alone; a recurring heading stays."""
    rows, want = notice_pages(15)
    assert {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()} == want
    assert all(("daily mail" in wrappers.extract(html, None)) == bool(i % 5) for i, _, html in rows)
    # Two pages don't tell what is template.
    two = wrappers.main_text(spark.createDataFrame(rows[1:3], PAGES)).collect()
    assert all("daily mail" in r.text for r in two)


def test_copies_of_a_page_keep_their_text(spark):
    rows, want = notice_pages(15)
    copies = [(100 + i, f"http://e.example/{i}", rows[0][2]) for i in range(9)] + [(200 + i, f"http://e.example/x{i}", rows[i][2]) for i in range(2, 4)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(copies, PAGES)).collect()}
    assert all(got[100 + i] == want[0] for i in range(9)) and all(want[i].split("\n")[1] in got[200 + i] for i in range(2, 4))


@pytest.mark.parametrize("name", ["social-science", "menu-recipes", "newsletter-issue-12", "ads-economics", "related", "search-algorithms"])
def test_varying_slots_overrule_what_a_name_says(spark, name):
    rows = [(i, f"http://f.example/{i}", f'<article><p>text {i}</p><div class="{name}"><p>part {i} of the article</p></div><p class="comment">note {i}</p>'
             f'<div class="newsletter-box"><p>no {i}</p></div><div class="ad-slot">Buy {i}</div><section class="comments"><p>Reader {i}</p></section></article>') for i in range(6)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"text {i}\npart {i} of the article\nnote {i}" for i in range(6)}


def test_each_template_of_a_host_has_its_wrapper_however_rare(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(400):
        lines = [" ".join(rng.choices(["four", "five", "six"], k=15)) + f" {i} {k}" for k in range(2)]
        if i % 50:
            page = f"<body><main>{''.join(f'<p>{x}</p>' for x in lines)}<p>Sign up today.</p></main></body>"
        else:
            page = f"<body><section><article>{''.join(f'<p>{x}</p>' for x in lines)}<p>Written by our staff.</p></article></section></body>"
        rows.append((i, f"http://g.example/{i}", page))
        want[i] = "\n".join(lines)
    df = spark.createDataFrame(rows, PAGES).repartition(5)
    assert {r.page_id: r.text for r in wrappers.main_text(df).collect()} == want


def test_wrappers_do_not_depend_on_how_pages_are_dealt(spark, monkeypatch):
    rows, _ = notice_pages(40)
    found = []
    for parts, held in ((1, 512), (7, 512), (7, 1)):
        monkeypatch.setattr(wrappers, "HELD", held)
        found.append([tuple(r) for r in wrappers.wrappers(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()])
    assert found[0] == found[1] == found[2] and "http" not in found[0][0][1]


def test_slots_count_frequent_texts_within_bounds():
    groups = [wrappers.Group.of(wrappers.parse(f"<p>{f'same' if i % 3 else i}</p>" + "".join(f"<p>{i} {k}</p>" for k in range(5)))) for i in range(600)]
    whole = groups[0]
    for g in groups[1:]:
        whole.merge(g)
    slot = whole.inside[0].inside[0]
    same = wrappers.xxhash.xxh3_64_hexdigest("same")
    assert len(slot.often) <= wrappers.COUNTED and slot.pages == 600 and 300 < slot.often[same] <= 400
