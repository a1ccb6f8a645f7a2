import pytest

from gridcast.llm import extract

SCHEMA = "page_id long, url string, html string, path string, host string"


def page(title, body, wrap="article", extra=""):
    return (f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body>'
            f'<header><h1>Site</h1></header><nav><ul><li><a href="/x">Home</a></li></ul></nav><div class="ad">Buy now.</div>'
            f'<{wrap}><h1>{title}</h1>{body}</{wrap.split(" ")[0]}>{extra}<div class="comments"><p>Reader says a lot of things here, more than the article says.</p></div>'
            f'<aside>Side text</aside><form><input><p>Sign up</p></form><footer>&copy; footer</footer></body></html>')


def texts(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return {r.id: r.text for r in extract.main_texts(docs).collect()}


def test_article_without_the_rest(spark):
    body = "<p>First &amp;&amp; <b>bo</b>ld\n  text.<br>Next line<p>Second&nbsp;one.</p><ul><li>Item<li>Other</ul><p class='newsletter'>Join us</p><p>End.</p>"
    rows = [(i, f"https://u@site.example:80/{i}", page(f"T{i}", body)) for i in range(3)]
    assert texts(spark, rows) == {i: f"T{i} First && bold text. Next line Second one. Item Other End." for i in range(3)}


def test_host_paths_win_over_single_pages(spark):
    # On one page a long list outweighs the story; the host's other pages vote for the story's path.
    story = '<div class="post-{0}"><p>Story {0} begins here and goes on for a while, as stories do.</p></div>'
    list_ = '<div class="list"><p>' + "Teaser text that is much longer than the story itself. " * 10 + "</p></div>"
    rows = [(i, "http://h/p", "<body><div id=main>" + story.format(i) + (list_ if i == 4 else "<div class=list><p>Short</p></div>") + "</div></body>") for i in range(5)]
    got = texts(spark, rows)
    assert got[4] == "Story 4 begins here and goes on for a while, as stories do."
    # A page of another host keeps its own best container.
    assert texts(spark, [(9, "http://other/p", rows[4][2])])[9].startswith("Teaser")


def test_defined_cases(spark):
    rows = [(1, None, None), (2, "http://a", ""), (3, "nonsense", "<p>Loose text"), (4, "http://a", "<article><p>Cut <b>off <a hre"), (4, "http://a", "<article><p>Cut <b>off <a hre"),
            (None, "http://b", "<div><p>No id</p></div>"), (5, "http://c", "<article>" + "<p>word </p>" * 20_000 + "</article>"), (6, "http://d", "<script>only()"),
            (7, "http://e", "a < b and c > d"), (8, "http://f", "<article><header><h1>Kept</h1></header><p>Body</p><footer>gone</footer></article>")]
    got = texts(spark, rows)
    assert got == {1: "", 2: "", 3: "Loose text", 4: "Cut off", None: "No id", 5: " ".join(["word"] * 20_000), 6: "", 7: "a < b and c > d", 8: "Kept Body"}
    assert texts(spark, []) == {}


@pytest.mark.parametrize("wrap", ["main", "div class='content'", "section id=story-12"])
def test_other_templates(spark, wrap):
    body = "<p>" + "Plain sentences of an article go on. " * 6 + "</p>"
    got = texts(spark, [(i, "http://w/x", page("T", body, wrap)) for i in range(3)])
    assert set(got.values()) == {"T " + ("Plain sentences of an article go on. " * 6).strip()}


def test_hosts(spark):
    urls = ["http://A.b/c", "https://u:p@X.y:81?q", "//z/p", "ftp://f#t", "/rel", None, "no scheme"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(extract.host(extract.F.col("u"))).collect()
    assert [r[0] for r in rows] == ["a.b", "x.y", "z", "f", "", "", ""]


A, B = "First part of the story, told at some length. " * 12, "Second part of the story, shorter. " * 10


def words(*parts):
    return " ".join(" ".join(parts).split())


@pytest.mark.parametrize("html, want", [
    (f"<article><div class=text><section class=a><p>{A}</section><section class=b><p>{B}</section></div></article>", words(A, B)),
    (f"<article><h1>Title</h1><div class=one><p>{A}</div><div class=two><p>{B}</div></article>", words("Title", A, B)),
    (f"<div class=post><h1>Title</h1><div class=text><p>{A}</div></div><div class=latest><p>Other</div>", words("Title", A)),
    (f"<article><div class=social-history><p>{A}</div><div class='share-buttons'>Share this</div></article>", words(A)),
    (f"<main><div class=article-related-content><p>{A}<p>{B}</div></main>", words(A, B))])
def test_nothing_of_an_article_is_lost(spark, html, want):
    rows = [(i, "http://n/x", f"<body><nav><a href=/>Home</a></nav>{html}<div class=comments><p>{B * 4}</div></body>") for i in range(4)]
    assert set(texts(spark, rows).values()) == {want}


def test_a_host_with_two_templates(spark):
    common = [(i, "http://t/x", f"<body><div class=story><p>{A} {i}</div></body>") for i in range(20)]
    other = [(100 + i, "http://t/y", f"<body><div class=story><p>Read more.</div><div class=report><p>{B} {i}</div></body>") for i in range(4)]
    got = texts(spark, [*common, *other])
    assert all(got[i] == words(A, str(i)) for i in range(20)) and all(got[100 + i] == words(B, str(i)) for i in range(4))
