"""Operator 4: templates by equivalence classes, boilerplate by whole names, long and broken pages."""

import time
from collections import defaultdict

import pytest

from curbflow.llm import html_extract
from curbflow.llm.html_extract import Page, main_text

BODY = "The first sentence of a story that is long enough.", "And the second one, which is longer still than the first."
STORY = f"<p>{BODY[0]}</p><p>{BODY[1]}</p>"


@pytest.mark.parametrize(
    "page, wanted",
    [
        (f"<body class='with-sidebar'><article>{STORY}</article>", BODY),
        (f"<div id=page class='single has-header'><article>{STORY}</article></div>", BODY),
        (f"<article class='post no-comments'>{STORY}</article>", BODY),
        (f"<article id='notice-of-appeal' class=post>{STORY}</article>", BODY),
        (f"<article><h2 id='related-work'>Related work</h2>{STORY}</article>", ("Related work", *BODY)),
        (f"<article class=lead><p>Lead.</p></article><article class=story>{STORY}</article>", ("Lead.", *BODY)),
        (f"<p class=lead>Lead.</p><div class=story>{STORY}</div>", ("Lead.", *BODY)),
        (f"<p>Intro to it all.</p><article class=teaser>Read on</article>{STORY}", ("Intro to it all.", "Read on", *BODY)),
        (f"<form id=aspnet><article>{STORY}</article></form>", BODY),
        (f"<div class=sidebar>{STORY}</div>", BODY),
        (f"<article>{STORY}</article><div class='site-footer'>x</div><div class='ad_slot'>x</div><section class=comments><article>Me too</article></section>", BODY),
        (f"<main>{STORY}<div class=comments><div class=comment>Nice</div></div></main><form>Name <input></form>", BODY),
        (f"<article>{STORY}<ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", (*BODY, "one", "two", "a", "b")),
    ],
)
def test_boilerplate_by_whole_names(page, wanted):
    assert main_text(page, None) == "\n".join(wanted)


def site(box, story, pages=12, host="h.org"):
    return [(k, f"http://{host}/{k}", f"<html><body><nav>n{k}</nav>{box(k)}{story(k)}</body></html>") for k in range(pages)]


def story(k):
    return f"<p>Story {k} begins here.</p><p>It goes on with words of its own, {k * 7919}, and more of them.</p>"


LETTER = "Get our letter every week."
TERMS = "Terms and conditions apply to all of it."


@pytest.mark.parametrize(
    "box, around",
    [
        (lambda k: f"<div class=legal-box>{TERMS}</div>", "{}"),
        (lambda k: f"<div class=css-{k * 31337:x}>{LETTER}</div>", "{}"),
        (lambda k: f"<div class=legal-box>{TERMS}</div>", "<article>{}</article>"),
        (lambda k: "", f"<article>{{}}<div class=x>{LETTER}</div></article>"),
        (lambda k: f"<section><div>{TERMS}</div><div>{LETTER}</div></section>" if k % 3 else "", "{}"),
    ],
)
def test_texts_of_the_template_go(spark, box, around):
    rows = site(box, lambda k: around.format(story(k)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_extract.extract_text(pages).collect()}
    assert found == {k: f"Story {k} begins here.\nIt goes on with words of its own, {k * 7919}, and more of them." for k in range(12)}


def test_copies_headings_and_single_texts_stay(spark):
    """Copies of one page are no template, nor is a heading inside articles, nor a text that shares its vector with nothing."""
    copies = [(100 + k, f"http://copies.org/{k}", f"<body><p>{BODY[0]}</p><div>{BODY[1]}</div></body>") for k in range(10)]
    near = [(200 + k, f"http://near.org/{k}", f"<body>{STORY}<p>Version {k}.</p></body>") for k in range(10)]
    headed = site(lambda k: "", lambda k: f"<article><h2>Summary</h2>{story(k)}</article>", host="headed.org")
    single = [(300 + k, f"http://single.org/{k}", f"<body>{story(k)}" + ("<p>Same.</p>" if k % 5 else "<p>Not</p><p>two</p>") + "</body>") for k in range(10)]
    pages = spark.createDataFrame(copies + near + headed + single, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_extract.extract_text(pages).collect()}
    assert all(found[100 + k] == "\n".join(BODY) for k in range(10))
    assert all(found[200 + k].startswith(BODY[0]) for k in range(10))
    assert all(found[k].startswith("Summary\nStory") for k in range(12))
    assert all(found[300 + k].endswith("Same." if k % 5 else "two") for k in range(10))


def test_classes_against_brute_force(spark):
    rows = site(lambda k: f"<div class=c{k % 2}>{TERMS}</div>" + ("<p>often</p><p>both</p>" if k % 4 else ""), story)
    rows += site(lambda k: f"<section><b>{LETTER}</b></section>" * (k % 3), story, pages=9, host="other.org")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", html_extract.url_host(html_extract.F.col("url")))
    found = {r["host"]: {frozenset(c) for c in r["classes"]} for r in html_extract.templates(html_extract.template_tokens(pages)).collect()}

    wanted = {}
    for host in ("h.org", "other.org"):
        counts, held, parsed = defaultdict(dict), defaultdict(set), [(i, Page(h)) for i, u, h in rows if f"//{host}/" in u]
        for page_id, page in parsed:
            for key, (count, up) in page.tokens().items():
                counts[key][page_id] = count
                held[key].add(up)
        often = {key for key, vector in counts.items() if 2 * len(vector) >= len(parsed)}
        classes = defaultdict(set)
        for key in often:
            classes[tuple(sorted(counts[key].items()))].add(key)
        wanted[host] = {frozenset(keys) for keys in classes.values() if len(keys) >= 2 and all(min(held[key]) in often for key in keys)}
    assert found == wanted and all(wanted.values())


@pytest.mark.parametrize(
    "page",
    [
        "<ul>" + "<li>x " * 170_000,
        "<a " * 350_000,
        "<![CDATA[" * 110_000,
        '<a "' * 250_000,
        "<!--" * 250_000,
        "<div>x" * 170_000,
        "<ul><li>" * 125_000,
        "<script></script" * 60_000,
    ],
)
def test_long_broken_pages_take_linear_time(page):
    start = time.process_time()
    main_text(page, None)
    assert time.process_time() - start < 15


def test_deep_pages_keep_their_text():
    deep = "<div>" * 2000 + "inside" + "</div>" * 2000 + "<p>after</p>"
    assert main_text(deep, None) == "inside\nafter"


def test_tag_ends():
    assert main_text("<p title='a > b'>one</p><!-- <p>x --><p>two &lt;p&gt;</p><![CDATA[ x > y ]]>three <br>four a < b", None) == "one\ntwo <p>\nthree four a < b"
    assert main_text('<p title="never closed>one</p><p>two</p>', None) == "one\ntwo"
