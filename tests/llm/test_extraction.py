"""Pages with a known article."""

import html as escapes
import re
from collections import Counter

from barloom.llm import extraction

ARTICLE = "<h1>Head &amp; line</h1><p>First  paragraph\nwith <a href=x>a link</a> in&nbsp;it.<p>Second one, <b>bold</b>ly.<ul><li>point one<li>point two</ul>"
WANT = "Head & line First paragraph with a link in it. Second one, boldly. point one point two"


def test_articles_are_whole():
    around = "<!DOCTYPE html><title>T</title><style>p{}</style><script>var a='</p>'</script><nav><a href=/>Home</a></nav>{}<footer>&copy; us</footer>"
    for box in (
        "<article>{}</article>",
        "<main><div class='ad banner'>Buy!</div>{}<aside>More</aside><section id=comments>First!</section></main>",
        "<article>{}<form><label>Mail</label><input></form><div class=cookie-notice>ok?</div><div role=navigation>n</div></article>",
        "<ARTICLE><div hidden>x</div><div style='display: none'>y</div>{}</ARTICLE><div>Some teaser outside of the article</div>",
    ):
        assert extraction.main_text(around.replace("{}", box.replace("{}", ARTICLE))) == WANT


def test_unmarked_page_by_tag_ratio():
    links = "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(12))
    long = [f"Sentence {i} of a long paragraph that has a good number of words in it, and no tags at all." for i in range(6)]
    page = f"<body><ul>{links}</ul><div><h2>Title</h2>{''.join(f'<p>{x}</p>' for x in long)}</div><ul>{links}</ul></body>"
    assert extraction.main_text(page) == " ".join(["Title", *long])


def test_hard_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "plain <b>text"), (3, "w", "<p>" * 20_000 + "deep"), (4, "x", "<article>" + "word " * 200_000), (4, "x", "&#x41;&bogus;<"), (5, "y", "<nav>only</nav>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extraction.extract(pages).collect())
    text = {u: t for _, u, t, _ in got if u != "x"}
    assert len(got) == len(rows) and all(n == len(t) for _, _, t, n in got)
    assert text == {"u": "", "": "", "v": "plain text", "w": "deep", "y": ""}
    assert {t[:9] for _, u, t, _ in got if u == "x"} == {"A&bogus;<", "word word"}
    assert extraction.extract(pages.limit(0)).collect() == []


def test_pages_table(spark):
    got = {r.page_id: r.text for r in extraction.op9_extraction(spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        assert got[r.page_id] == " ".join(escapes.unescape(re.sub("<[^>]+>", " \0 ", inside)).replace("\0", " ").split())


BODY = [f"Sentence {i} of a long paragraph that has a good number of words in it, and no tags at all, so it reads on." for i in range(8)]


def test_body_outside_of_article_elements():
    body = "".join(f"<p>{x}</p>" for x in BODY)
    cards = "".join(f"<article><h3>Card {i}</h3><p>Short teaser {i}</p></article>" for i in range(4))
    links = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(12)) + "</ul>"
    for page in (f"<body>{links}<div class=text>{body}</div>{cards}{links}</body>", f"<body>{links}<article><p>{BODY[0]}</p></article>{body}{links}</body>"):
        got = extraction.main_text(page)
        assert all(x in got for x in BODY) and "Link 3" not in got


def test_pages_without_their_article_tags(spark):
    shared = wanted = found = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        want = Counter(escapes.unescape(re.sub("<[^>]+>", " ", inside)).split())
        got = Counter(extraction.main_text(re.sub("</?article>", " ", r.html)).split())
        shared, wanted, found = shared + (want & got).total(), wanted + want.total(), found + got.total()
    assert shared > 0.98 * wanted and shared > 0.98 * found


def test_names_that_mention_a_dropped_word():
    body = "".join(f"<p>{x}</p>" for x in BODY)
    for box in ("<div class='content with-sidebar'>{}</div>", "<main class='has-comments'>{}</main>", "<div id='social-history'>{}</div>", "<section class='legal-news'>{}</section>"):
        assert extraction.main_text(f"<body>{box.replace('{}', body)}</body>") == " ".join(BODY)
        two = f"<body><div>{body}</div>{box.replace('{}', '<p>' + BODY[0] + ' Once more.</p>')}</body>"
        assert "Once more." in extraction.main_text(two)
    small = f"<body><div>{body}</div><div class=comments><p>{BODY[0]} First!</p></div><div class='page-sidebar'>{BODY[1]} Aside.</div></body>"
    assert extraction.main_text(small) == " ".join(BODY)


def test_comments_and_notices_of_any_length():
    """Longer than the article, inside and beside it; readers' comments are often articles themselves."""
    body = "".join(f"<p>{x}</p>" for x in BODY)
    talk = "".join(f"<article class=comment-item><p>{x.replace('Sentence', 'Opinion')}</p></article>" for x in BODY * 4)
    flat = "".join(f"<p>{x.replace('Sentence', 'Opinion')}</p>" for x in BODY * 4)
    for page in (
        f"<article>{body}<div id=comments>{flat}</div></article>",
        f"<article>{body}</article><section class='post-comments'>{talk}</section>",
        f"<div>{body}</div><div id=comments>{flat}</div>",
        f"<div>{body}</div><ol class=comments>{talk}</ol>",
        f"<main>{body}<div class='cookie-notice'>{flat}</div></main>",
        f"<div>{body}</div><div class='cookie-notice'>{flat}</div>",
        f"<div class='page-search'><article>{body}</article></div><div class=sidebar>{flat}</div>",
    ):
        assert extraction.main_text(f"<body>{page}</body>") == " ".join(BODY), page[:60]


def test_names_around_everything():
    body = "".join(f"<p>{x}</p>" for x in BODY)
    assert extraction.main_text(f"<body><div class='site-modal'>{body}</div></body>") == " ".join(BODY)
    assert extraction.main_text(f"<body><div class='site-modal'><div class=article-body>{body}</div></div><p>Small print.</p></body>").startswith(" ".join(BODY))
    assert extraction.main_text(f"<body><div class=comments>{body}</div></body>") == ""
