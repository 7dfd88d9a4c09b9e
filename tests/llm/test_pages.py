"""Main text and web archives."""

import base64
import hashlib
import html
import re

import pytest

from lakeloom.llm import main_region, warc
from lakeloom.llm.main_region import main_text, read_page
from lakeloom.llm.queries import QUERIES, SQL
from lakeloom.llm.shared import read_whole, scratch_path
from tests.conftest import SF, rows


def frame(spark, pages, ids=None):
    ids = list(range(len(pages))) if ids is None else ids
    links = [None if p is None else f"http://x.example/{i}" for i, p in enumerate(pages)]
    return spark.createDataFrame(
        list(zip(ids, links, pages, pages)), "page_id long, url string, html string, text string"
    )


FULL = """<html><head><title>T</title><style>p{}</style></head><body class="page"><header class="site-header">
<h1>Site</h1><nav><ul><li><a href=x>Home</a></ul></nav></header>
<div id="cookie-notice">We use cookies. <button>OK</button></div>
<div class="content"><h2>Real &amp; title</h2><p>First   para with <a href="q?a>b">a link</a> and&nbsp;<i>it</i>alics.
<div class="ad-slot">Buy now</div><p>Second para, 3 &lt; 4.<ul><li>one item<li>two item</ul><table><tr><td>c1<td>c2</table>
<form><input name=q>Subscribe<textarea>hi</textarea></form><pre>code   here
 next</pre><script>var t = "</p>";</script></div><aside>side text is here</aside>
<section id="comments"><article class="comment"><p>A very long comment with many many words in it</article></section>
<footer>&copy; 2020 All rights</footer></body></html>"""


def test_blocks_of_a_full_page():
    assert main_text(read_page(FULL), {}).split("\n") == [
        "Real & title", "First para with a link and italics.", "Second para, 3 < 4.", "one item", "two item",
        "c1", "c2", "code here next",
    ]


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""), ("", ""), ("plain words only", "plain words only"), ("<nav>menu</nav>", ""),
        ("<p>a<br>b<p>c &#233; &bogus;", "a b\nc é &bogus;"), ("<p>a < b > c</p>", "a < b > c"),
        ("<!-- x --><p>one</p><!-- never closed <p>two", "one"), ("<p>one</p><script>var x", "one"),
        ("<p hidden>no</p><p>yes</p>", "yes"), ("<main><p>in</p></main><p>out of it</p>", "in"),
        ("<article><header><h1>Head</h1></header><p>Body</article>", "Head\nBody"),
    ],
)
def test_blocks(source, text):
    assert main_text(read_page(source), {}) == text


def test_best_stretch_is_the_best_of_all():
    """The linear scan against every stretch there is."""
    page = read_page("".join(f"<p>{'w ' * n}</p><div><a></a><b></b></div>" for n in (1, 0, 2, 1, 5, 0, 0, 1, 4)))
    weights = {"tag p": -1.7, "tag /p": -0.9, "tag a": -0.4, "in p": -0.5}

    def score(event):
        if isinstance(event, str):
            return min(-0.05, weights.get(f"tag {event}", main_region.TAG))
        return 0.5 * event.words

    scores = [score(e) for e in page.events]
    n = len(scores)
    a, b = max(((i, j) for i in range(n) for j in range(i, n + 1)), key=lambda s: sum(scores[s[0] : s[1]]))
    expected = [e.text for e in page.events[a:b] if not isinstance(e, str)]
    assert main_text(page, weights).split("\n") == expected


def article_blocks(source):
    inner = re.search("<article>(.*)</article>", source, re.S)[1].replace("<br>", " ")
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_main_text_of_the_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = {r.page_id: r for r in QUERIES["op5_main_region"](spark, SF).collect()}
    assert found.keys() == pages.keys()
    for page, source in pages.items():
        assert found[page].text == article_blocks(source) and found[page].n_chars == len(found[page].text)


def test_articles_are_found_without_their_tags(spark):
    """Weights learned where articles are marked serve pages that mark none."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = main_region.learn(pages)
    assert all(w < 0 for f, w in weights.items() if f.startswith("tag "))
    for r in pages.limit(60).collect():
        bare = r.html.replace("<article>", "<div class=x>").replace("</article>", "</div>")
        assert main_text(read_page(bare), weights) == article_blocks(r.html)


def test_main_text_of_odd_rows(spark):
    df = frame(spark, [None, "", FULL, FULL, "<p>" + "long words " * 50_000], [1, None, 2, 2, 3])
    found = main_region.extract(df).collect()
    assert sorted(r.n_chars for r in found)[:2] == [0, 0] and len(found) == 5
    assert max(r.n_chars for r in found) == len("long words " * 50_000) - 1
    assert main_region.extract(df.limit(0)).count() == 0


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives_of_the_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    last = {}
    for page, source in pages:
        last[source] = max(page, last.get(source, page))
    expected = [
        (p, len(s.encode()), sha(s), "response" if last[s] == p else "revisit", None if last[s] == p else last[s])
        for p, s in pages
    ]
    assert rows(QUERIES["op10_sharded_warc"](spark, SF)) == sorted(expected, key=repr)


def test_archives_have_sql():
    assert "op10_sharded_warc" in SQL


ODD = ["<p>same", "<p>same", None, "", "é" * 9, "<p>same", "big " * 60_000, "<p>same", "nul \x00 here", "nameless", "nameless"]
IDS = [5, 9, 1, 2, 3, 9, 4, None, 6, None, None]


@pytest.mark.parametrize("least", [0, 8])
def test_archives_of_odd_rows(spark, least):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(frame(spark, ODD, IDS).repartition(4), folder, revisit_bytes=least, file_bytes=100)
    assert manifest.count() > 3
    found = warc.read_archives(manifest, folder)
    kinds = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found.collect()), key=repr)
    if least:
        assert {k for _, n, k, _ in kinds if n < least} == {"response"}
    else:
        assert (5, 7, "revisit", 9) in kinds and (9, 7, "response", None) in kinds and (9, 7, "revisit", 9) in kinds
        assert (None, 7, "revisit", 9) in kinds and (1, 0, "revisit", 2) in kinds
        assert [k for k in kinds if k[0] is None and k[1] == 8] == [
            (None, 8, "response", None), (None, 8, "revisit", None),
        ]
    assert {r.html for r in found.collect() if r.html} == {t for t in ODD if t}
    assert {r.payload_digest for r in found.collect()} == {sha(t) for t in ODD}


def test_archive_files_are_warc_and_repeat(spark):
    """Gzip member by member, every reference resolves, and a second run writes equal bytes."""
    df = frame(spark, ODD, IDS)
    contents = []
    for _ in range(2):
        folder = scratch_path(spark, "warc-test")
        names = sorted(r.file for r in warc.write_archives(df, folder).collect())
        contents.append({n: read_whole(folder, n) for n in names})
    assert contents[0] == contents[1]
    fields = [f for c in contents[0].values() for f, _ in warc.records_of(c)]
    assert len({f["WARC-Record-ID"] for f in fields}) == len(fields)
    responses = {f["WARC-Record-ID"]: f for f in fields if f["WARC-Type"] == "response"}
    for f in fields:
        if f["WARC-Type"] == "revisit":
            assert responses[f["WARC-Refers-To"]]["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
    with pytest.raises(ValueError, match="other content"):
        for name, content in contents[0].items():
            for f, block in warc.records_of(content):
                if f["WARC-Type"] == "response" and warc.payload_digest(block[:-1]) != f["WARC-Block-Digest"][5:]:
                    raise ValueError("other content")


def test_empty_table_writes_no_archive(spark):
    df = frame(spark, ODD, IDS).limit(0)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(df, folder)
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0


def test_reading_takes_time_in_proportion(spark):
    """Four times the archive takes about four times as long; whole-file copies for each record would take sixteen."""
    import random
    import time

    rng = random.Random(1)
    member = [warc._member(warc.record(i, "u", p := rng.randbytes(3000), warc.payload_digest(p), None, 0, "1970-01-01T00:00:00Z")) for i in range(3000)]
    took = []
    for n in (750, 3000):
        content = b"".join(member[:n])
        best = float("inf")
        for _ in range(3):
            start = time.perf_counter()
            assert sum(1 for _ in warc.records_of(content)) == n
            best = min(best, time.perf_counter() - start)
        took.append(best)
    assert took[1] < 8 * took[0]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_of(content[:-20]))


def test_one_page_id_for_all_rows_is_spread(spark, settings):
    settings(spark__sql__shuffle__partitions="6", spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(300).selectExpr("cast(null as long) page_id", "'u' url", "concat('page ', id % 200) html")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(df, folder)
    assert manifest.count() > 3 and spark.read.parquet(f"{folder}/manifest").count() == manifest.count()
    found = warc.read_archives(manifest, folder)
    assert found.count() == 300 and found.filter("record_type = 'response'").count() == 200
    assert found.rdd.getNumPartitions() > 1
