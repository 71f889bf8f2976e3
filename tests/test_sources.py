import json

import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.sources import day_cache as dc
from pressmill.sources import feeds as fd
from pressmill.sources import pages as pg


def test_day_cache_layout(spark, tmp_path):
    def put(source, topic, body):
        folder = tmp_path / source / topic
        folder.mkdir(parents=True)
        (folder / "cache.json").write_text(body, encoding="utf-8")

    item = {"url": "u1", "title": "т", "date": "2024-01-01", "text": "x", "matched_keyword": "k"}
    days = {"2024-01-01": {"date": "2024-01-01", "links_found": 3, "items": [item, {**item, "url": "u2"}]}}
    old = {"2024-01-02": {"items": [], "articles": [{"url": "u3", "review_date": "d", "category": "c"}]}}
    put("cbr", "taxes", json.dumps({"days": days}, indent=2, ensure_ascii=False))
    put("cbr", "ssem", '{"days": {"2024-')
    put("rbc", "ssem", json.dumps({"days": ["no map"]}))
    put("consultant", "ssem", json.dumps({"reviews": old}))
    put("consultant", "taxes", json.dumps({"days": days}))
    docs = dc.read_documents(spark, str(tmp_path))
    rows = dc.scan_articles(docs).collect()
    assert sorted((r.source, r.topic, r.day, r.pos, r.url) for r in rows) == [
        ("cbr", "taxes", "2024-01-01", 0, "u1"),
        ("cbr", "taxes", "2024-01-01", 1, "u2"),
        ("consultant", "ssem", "2024-01-02", 0, "u3"),
    ]
    broken = {(r.source, r.topic) for r in dc.parse_documents(docs).filter("broken").collect()}
    assert broken == {("cbr", "ssem"), ("rbc", "ssem"), ("consultant", "taxes")}
    assert dc.scan_all(docs, ["cbr"], ["taxes", "ssem"]).count() == 2
    few = dc.read_documents(spark, str(tmp_path), sources=["cbr"], topics=["taxes", "ssem"])
    assert 0 < few.count() <= docs.count() and {r.source for r in few.collect()} == {"cbr"}
    assert dc.read_documents(spark, str(tmp_path), sources=["none"]).count() == 0


def test_upsert_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "source string, topic string, day string, url string, links_found long"
    dc.upsert_days(spark.createDataFrame([("s", "t", "2024-01-01", "a", 1), ("s", "t", "2024-01-02", "b", 1)], schema), path)
    dc.upsert_days(spark.createDataFrame([("s", "t", "2024-01-02", "c", 2)], schema), path)
    rows = spark.read.parquet(path).collect()
    assert {(str(r.day), r.url, r.links_found, r.status) for r in rows} == {
        ("2024-01-01", "a", 1, "processed"),
        ("2024-01-02", "c", 2, "processed"),
    }
    # A day worked on again without any article left is emptied.
    worked = spark.createDataFrame([("s", "t", "2024-01-01"), ("s", "t", "2024-01-03")], "source string, topic string, day string")
    new = spark.createDataFrame([("s", "t", "2024-01-03", "d", 1)], schema)
    dc.upsert_days(new, path, processed=worked)
    assert {str(r.day) for r in spark.read.parquet(path).collect()} == {"2024-01-02", "2024-01-03"}


def test_rss_and_sitemap(spark, tmp_path):
    rss = """<?xml version="1.0"?><rss><channel><title>t</title>
    <item>
      <title> A &amp;  B </title>
      <link>/x</link>
<pubDate>Tue, 05 Mar 2024 10:00:00 +0300</pubDate></item>
    <item><title>later copy</title><link>/x</link><pubDate>Tue, 05 Mar 2024 10:00:00 +0300</pubDate></item>
    <item><title>no date</title><link>/y</link><pubDate>soon</pubDate></item>
    <item><title></title><link>/z</link><pubDate>2024-03-05</pubDate></item></channel></rss>"""
    (tmp_path / "a.xml").write_text(rss, encoding="utf-8")
    items = fd.rss_items(fd.read_feed_documents(spark, str(tmp_path)), "https://s.x/").collect()
    assert [(r.title, r.url, str(r.news_date)) for r in items] == [("A & B", "https://s.x/x", "2024-03-05")]
    site = """<urlset xmlns="http://x"><url><loc>https://s/news/1/</loc><lastmod>2024-03-05T10:00:00+03:00</lastmod></url>
    <url><loc>https://s/news/2/</loc><lastmod>2024-01-05</lastmod></url><url><loc>https://s/news/3/</loc></url>
    <url><loc>https://s/about/</loc></url></urlset>"""
    docs = spark.createDataFrame([("f", site)], "file string, body string")
    urls = fd.sitemap_urls(docs, F.lit("2024-02-01").cast("date")).collect()
    assert sorted(r.url for r in urls) == ["https://s/news/1/", "https://s/news/3/"]


def read(spark, profile, html):
    df = spark.createDataFrame([(1, html)], "id long, html string")
    return pg.extract_articles(df, pg.PROFILES[profile], "id").first()


def test_page_profiles(spark):
    body = "<h1>T &amp; t</h1><article><p> a  b <b>c</b><p>d<script>x()</script></article><p>out</p>"
    assert read(spark, "banki", body).text == "a b c\nd"
    assert read(spark, "banki", "<article></article><p>x</p>").text == ""
    assert read(spark, "banki", "<main><p>m</p></main><p>x</p>").text == "m"
    assert read(spark, "minfin", "<article></article><div class='big content'><p>c</p></div>").text == "c"
    assert read(spark, "nalog", "<div class='text_block'><p>a <i>b</i></p><p></p><p>c</p></div>").text == "ab c"
    page = "<meta itemprop='datePublished' content='2024'><h1>H</h1><article itemprop='articleBody'>x<aside>no</aside><p>y</p></article>"
    row = read(spark, "interfax", page)
    assert (row.title, row.date, row.text) == ("H", "2024", "x\ny")
    page = "<div class='article_text_wrapper'><p class='doc__text'>long enough</p><p class='doc__text'>ab</p></div>"
    assert read(spark, "kommersant", page).text == "long enough"
    page = "<div class='doc__body'><div class='adv'>no</div><p>short</p><li>a line of text</li></div>"
    assert read(spark, "kommersant", page).text == "a line of text"
    assert read(spark, "kommersant", "<div class='doc__body'>tiny</div>").text == "tiny"
    assert read(spark, "kommersant", "<meta property='og:description' content=' d '>").text == "d"
    page = "<h1>G</h1><time datetime='2024-03-05T10:00:00'></time><div class='clearfix'><p>a</p><ul><li>b</li></ul></div>"
    row = read(spark, "garant", page)
    assert (row.date, row.text) == ("2024-03-05", "a\n\nb")
    page = "<script type='application/ld+json'>{\"datePublished\": \"2024-03-06T01:00:00+03:00\"}</script>"
    assert read(spark, "garant", page).date == "2024-03-06"
    page = "<a class='link' title='Full title'>Short</a><div class='article__content'>x <p>y</p></div>"
    row = read(spark, "palata", page)
    assert (row.title, row.text) == ("Full title", "x y")
    assert read(spark, "rbc", "<span class='js-article-pro-anons-text'> q </span>").text == "q"
    assert read(spark, "rbc", None).text == ""


def test_few_pages_are_read_at_a_time():
    seen = []
    ids = pa.array(range(1000), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array([f"<p>{i}</p>" for i in range(1000)])], ["id", "html"])

    def read(html):
        seen.append(html)
        return [(html,)] * (len(seen) % 2)

    parts = pg._read_batches(iter([batch]), read, {"text": "string"})
    first = next(parts)
    assert 0 < len(seen) <= 64
    rows = [row for part in [first, *parts] for row in part.to_pylist()]
    assert rows == [{"id": i, "text": f"<p>{i}</p>"} for i in range(0, 1000, 2)]


def test_review_entries(spark):
    html = """<h3>Other</h3><p><a href="cons_doc_LAW_0">{long} zero</a></p>
    <h3>Tax and duties</h3><p><a href="/cons_doc_LAW_1">{long} one</a></p><p><strong>Headline</strong></p><p>line 1</p><p>line 2</p>
    <p><a href="/cons_doc_LAW_2">{long} two</a></p><p>first</p><p>second</p><hr><p>after</p>
    <p><a href="/cons_doc_LAW_3">short</a></p>
    <h3>Something else</h3><p><a href="/cons_doc_LAW_4">{long} four</a></p>""".replace("{long}", "x" * 31)
    df = spark.createDataFrame([(1, html)], "id long, html string")
    rows = pg.review_entries(df, ("Tax", "Bank"), "cons_doc_LAW", "id").orderBy("pos").collect()
    assert [(r.category, r.href, r.title, r.text) for r in rows] == [
        ("TAX", "/cons_doc_LAW_1", "Headline", "line 1\nline 2"),
        ("TAX", "/cons_doc_LAW_2", "first", "second"),
    ]


def test_links(spark):
    html = """<!-- <a href="/no/1">n</a> --><a class="x" href='/news/12/'>A <b>b</b></a>
    <a href="https://o.x/news/z">c &amp; d</a><a name="e">no href</a><a href="/other/3">o</a>"""
    df = spark.createDataFrame([(1, html)], "id long, html string")
    rows = pg.extract_links(df, "https://s.x", keep=("/news/",)).orderBy("pos").collect()
    assert [(r.link, r.anchor, r.is_article) for r in rows] == [
        ("https://s.x/news/12/", "A b", True),
        ("https://o.x/news/z", "c & d", False),
    ]
