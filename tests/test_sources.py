import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from inkweir import schemas
from inkweir.functions.language import train_profiles
from inkweir.sources import files, markup, ranges
from inkweir.streaming import filters


@pytest.mark.parametrize(("codec", "end"), [("gzip", "gz"), ("bzip2", "bz2"), (None, "json")])
def test_jsonl_round_trip(spark, tmp_path, codec, end):
    rows = spark.createDataFrame([("u", [["a b.", "c."]], "t")], "canonical_url string, paragraphs array<array<string>>, title string")
    files.write_jsonl(rows, str(tmp_path / "out"), codec, rows_per_file=1)
    assert any(p.name.endswith(end) for p in (tmp_path / "out").iterdir())
    got = files.read_jsonl(spark, str(tmp_path / "out"), schemas.DOCUMENTS).first()
    assert (got["canonical_url"], got["paragraphs"], got["date"]) == ("u", [["a b.", "c."]], None)


def test_articles_have_number_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"title": "T", "page_id": 1, "sections": [], "references": {"2": {"type": "cite web", "url": "u"}}}) + "\n")
    assert files.read_articles(spark, str(tmp_path)).first()["references"][2]["url"] == "u"


def test_multistream_dump(spark, tmp_path):
    page = "<page><title>{0}</title><id>{1}</id><revision><id>9</id><text xml:space='preserve'>{2}</text></revision></page>\n"
    parts = ["<mediawiki>\n", page.format("A", 1, "x [[Category:Living people]]"), page.format("B", 2, " "), page.format("C", 3, "y"), "</mediawiki>"]
    (tmp_path / "d.xml.bz2").write_bytes(b"".join(bz2.compress(p.encode()) for p in parts))
    assert sorted((r["title"], r["page_id"]) for r in files.read_dump(spark, str(tmp_path / "d.xml.bz2")).collect()) == [("A", 1), ("C", 3)]
    (tmp_path / "i.txt").write_text("100:1:A\n100:2:B\n250:3:C\n")
    assert sorted(r[0] for r in files.read_dump_index(spark, str(tmp_path / "i.txt")).collect()) == [100, 250]


def test_cdx(spark, tmp_path):
    lines = ["k,a)/ 2019 " + json.dumps({"status": "404", "filename": "f", "length": "1", "offset": "2"}), "k,a)/ 2020 " + json.dumps({"status": "200", "filename": "g", "length": "3", "offset": "40000000000"}), "z,b)/ 2020 {}"]
    (tmp_path / "cdx-00001.txt").write_text("\n".join(lines))
    keys = spark.createDataFrame([("k,a)/",)], "canonical_url string")
    got = files.read_cdx(spark, str(tmp_path), keys).where("status = 200").collect()
    assert [(r["filename"], r["offset"], r["file"]) for r in got] == [("g", 40000000000, "cdx-00001.txt")]
    assert files.with_shard(spark.read.text(str(tmp_path))).first()["shard"] == 1


def test_annotations_round_trip(spark, tmp_path):
    row = json.dumps({"id": "1", "sentence": 'say "x",\nand y'})
    table = spark.createDataFrame([(row, "Yes"), (row, "Error")], "`Input.json` string, `Answer.category.label` string")
    files.write_annotation_tasks(table, str(tmp_path / "csv"))
    assert sorted((r["sentence"], r["label"]) for r in files.read_annotations(spark, str(tmp_path / "csv")).collect()) == [('say "x",\nand y', -1), ('say "x",\nand y', 1)]


def test_word_frequencies(spark, tmp_path):
    (tmp_path / "df.txt.gz").write_bytes(gzip.compress(b'3\n2.5\n{"word": "a", "df": 2}\n'))
    words, stats = files.read_legacy_word_frequencies(spark, str(tmp_path / "df.txt.gz"))
    assert (words.first()["df"], tuple(stats.first())) == (2, (3, 2.5))
    files.write_word_frequencies(words, stats, str(tmp_path / "t"))
    assert files.read_word_frequencies(spark, str(tmp_path / "t"))[0].count() == 1


def test_store(spark, tmp_path):
    files.write_store(spark.createDataFrame([("a", "x"), ("b", ""), ("c", None)], "key string, data string"), str(tmp_path / "s"))
    keys = spark.createDataFrame([("a",), ("b",), ("q",)], "key string")
    assert {r["key"]: r["data"] for r in files.read_store(spark, str(tmp_path / "s"), keys).collect()} == {"a": "x", "b": None, "q": None}


def test_last_row_wins_and_files_per_row(spark, tmp_path):
    for name, v in (("documents-1.jsonl", "old"), ("documents-2.jsonl", "new")):
        (tmp_path / name).write_text(json.dumps({"canonical_url": "u", "title": v}) + "\n")
    (tmp_path / "documents-index.jsonl").write_text("{}\n")
    docs = files.read_jsonl(spark, str(tmp_path), schemas.DOCUMENTS, "documents-[0-9].jsonl")
    assert [r["title"] for r in files.last_row_wins(docs, "canonical_url").collect()] == ["new"]
    assert files.write_rows_as_files(docs.select("title"), str(tmp_path / "each"), "title", 5) == 2
    files.write_buckets(spark.createDataFrame([(1, "0_0.00_1.00")], "v int, label string"), str(tmp_path / "b"))
    assert (tmp_path / "b" / "label=0_0.00_1.00").is_dir()


def test_captures(spark, tmp_path):
    record = b"WARC/1.0\r\nx: y\r\n\r\nHTTP/1.1 200 OK\r\n\r\n<p>h\xc3\xa9</p>\r\n\r\n"
    packed = gzip.compress(record)
    (tmp_path / "w.gz").write_bytes(b"junk" + packed)
    rows = [("a", "w.gz", len(packed), 4), ("b", "w.gz", 3, 4), ("c", "none.gz", 9, 4), ("d", None, 9, 4), ("e", "w.gz", None, None)]
    locations = spark.createDataFrame(rows, "canonical_url string, filename string, length bigint, offset bigint")
    got = {r["canonical_url"]: r["html"] for r in ranges.read_captures(locations, f"file://{tmp_path}/", qps=1000, tasks=2).collect()}
    assert got == {"a": "<p>hé</p>", "b": None, "c": None, "d": None, "e": None}
    assert ranges.read_captures(locations.where("false"), f"file://{tmp_path}/").count() == 0
    assert tuple(ranges.capture_stats(ranges.read_captures(locations, f"file://{tmp_path}/"), 2.0).first()) == (5, 1, 20.0, 2.5)


def test_captures_written_and_read(spark, tmp_path):
    pages = spark.createDataFrame([("a", "<p>é"), ("b", ""), ("c", None), ("d", "x" * 100_000)], "canonical_url string, html string")
    locations = spark.createDataFrame(ranges.write_captures(pages, f"file://{tmp_path}/out").collect())
    got = {r["canonical_url"]: r["html"] for r in ranges.read_captures(locations, f"file://{tmp_path}/out/").collect()}
    assert got == {"a": "<p>é", "b": "", "d": "x" * 100_000}


def test_page_views_and_files_fetched_once(spark, tmp_path):
    for title, answer in (("A%2FB", '{"items": [{"views": 3}, {"views": 4}]}'), ("Bad", "not json")):
        (tmp_path / title / "monthly" / "1").mkdir(parents=True)
        (tmp_path / title / "monthly" / "1" / "2").write_text(answer)
    (tmp_path / "A%2FB").rename(tmp_path / "A%2FB_")
    (tmp_path / "A").mkdir()
    (tmp_path / "A%2FB_").rename(tmp_path / "A" / "B")
    pages = spark.createDataFrame([("A/B", 1), ("A/B", 1), ("Bad", 2), ("None", 3), (None, 4)], "page_title string, page_id bigint")
    assert [tuple(r) for r in ranges.fetch_page_views(pages, f"file://{tmp_path}", 0, "1", "2").collect()] == [("A/B", 1, 7)]
    source = (tmp_path / "x.txt")
    source.write_text("hello")
    assert files.fetch_file(f"file://{source}", str(tmp_path / "y.txt")) and not files.fetch_file("file:///nowhere", str(tmp_path / "y.txt"))
    (tmp_path / "c.json").write_text('{"data_dir":\n "d"}')
    assert files.read_config(spark, str(tmp_path / "c.json")) == {"data_dir": "d"}


def test_last_line_of_the_last_file_wins(spark, tmp_path):
    line = lambda k, v: json.dumps({"page_id": k, "page_title": "t", "views": v}) + "\n"
    (tmp_path / "views-1.jsonl").write_text("".join(line(k, k) for k in range(2000)) + line(5, 100))
    (tmp_path / "views-2.jsonl").write_text(line(7, 1) + "".join(line(9, v) for v in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")  # several splits a file
    try:
        got = {r["page_id"]: r["views"] for r in files.read_views(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: k for k in range(2000)} | {5: 100, 7: 1, 9: 2999}


def test_whole_mean_length_of_a_frequency_file(spark, tmp_path):
    (tmp_path / "df.txt").write_text('30\n2\n{"word": "a", "df": 2}\n')
    assert tuple(files.read_legacy_word_frequencies(spark, str(tmp_path / "df.txt"))[1].first()) == (30, 2.0)


def test_rate_limit_and_budget():
    now = [0.0]
    limiter = ranges.RateLimiter(2.0, 30.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(10):
        limiter.take()
    assert now[0] >= 4.4
    budget = ranges.FailureBudget(2, sleep=lambda s: None)
    budget.spend(OSError())
    with pytest.raises(OSError):
        budget.spend(OSError())


ARTICLE = """<body><p> First. Lead sentence<sup>[1]</sup>. More</p><h2>One</h2><p>Text a.<!-- c --> Text b.<span>[2] trailing</span></p><h3>Sub</h3><ul><li>x</li></ul><p>listed</p><h2>Two</h2><p>{{skip}}</p><ul><li>y</li></ul><p>last</p>
<ol class="mw-references x"><li><span class="mw-reference-text"><span data-mw='{"parts":[{"template":{"target":{"wt":" Cite Web "},"params":{"archiveurl":{"wt":""},"url":{"wt":"http://u"},"accessdate":{"wt":"bad"},"date":{"wt":"2 May 2012"},"title":{"wt":" T "},"x":{}}}}]}'></span></span></li>
<li>plain</li><li><span class="mw-reference-text"><span data-mw='{"parts":["text"]}'></span></span></li><li><span class="mw-reference-text"><span data-mw='{"parts":[{"template":{"target":{"wt":"cite news"},"params":{"url":{"wt":"http://v"}}}}]}'></span></span></li></ol></body>"""


def test_article():
    got = markup.parse_article("T", 1, ARTICLE)
    assert [(s["id"], s["headings"][:2], [p["text"] for p in s["paragraphs"]]) for s in got["sections"]] == [(0, ["", ""], ["First. Lead sentence. More"]), (1, ["One", ""], ["Text a. Text b."]), (2, ["Two", ""], ["last"])]
    first = got["sections"][0]["paragraphs"][0]
    assert first["citations"] == [{"reference_id": 1, "offset": 21}] and first["sentence_offsets"][0] == [0, 6]
    assert markup.parse_article("T", 1, ARTICLE, adjust_offsets=True)["sections"][0]["paragraphs"][0]["citations"][0]["offset"] == 20
    assert got["references"] == {"1": {"type": "cite web", "title": "T", "url": None, "date": "2012-05-02"}, "4": {"type": "cite news", "title": None, "url": "http://v", "date": None}}
    assert markup.parse_article("T", 1, "<body><p>x</p></body>") is None and markup.parse_article("T", 1, None) is None


def test_article_frames(spark):
    pages = spark.createDataFrame([("T", 1, ARTICLE), ("N", 2, None)], "title string, page_id bigint, html string")
    assert [r["page_id"] for r in markup.parse_articles(pages).collect()] == [1]
    web = spark.createDataFrame([("u", "<title>T</title><nav><p>menu</p></nav><article><p>One. Two<p>Three.</article><footer><p>f</p></footer>"), ("v", ""), ("w", None)], "canonical_url string, html string")
    row = markup.extract_bodies(web).collect()
    assert [(r["canonical_url"], r["title"], r["paragraphs"]) for r in row] == [("u", "T", [["One.", "Two"], ["Three."]])]


def test_streams(spark, tmp_path):
    docs = [{"canonical_url": "u", "paragraphs": [["the cat and the dog of the house"]]}, {"canonical_url": "v", "paragraphs": [["der Hund und die Katze"]]}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(x) for x in ({"id": "1", "documents": docs}, {"id": "2", "documents": docs[1:]})))
    told = spark.createDataFrame([("the cat and the dog ran through the old house of the town", "en"), ("der Hund und die Katze liefen durch das alte Haus der Stadt", "de")], "text string, language string")
    stream = filters.keep_english(filters.stream_jsonl(spark, str(tmp_path / "in"), schemas.INSTANCES), train_profiles(told))
    filters.run_once(stream.select("id", F.size("documents").alias("n")), str(tmp_path / "out"), str(tmp_path / "cp"))
    filters.run_once(stream.select("id", F.size("documents").alias("n")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("1", 1)]
    (tmp_path / "cap").mkdir()
    (tmp_path / "cap" / "a.json").write_text("\n".join(json.dumps({"canonical_url": u, "site": "s", "fetched_at": t}) for u, t in (("u", "2019-01-01T00:10:00Z"), ("u", "2019-01-01T00:20:00Z"), ("v", "2019-01-01T05:00:00Z"))))
    captures = filters.stream_jsonl(spark, str(tmp_path / "cap"), spark.sql("SELECT '' AS canonical_url, '' AS site, current_timestamp() AS fetched_at").schema)
    filters.run_once(filters.first_captures(captures).select("canonical_url"), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "o2")).collect()) == ["u", "v"]
    filters.run_once(filters.captures_per_window(captures), str(tmp_path / "o3"), str(tmp_path / "c3"))
    assert spark.read.parquet(str(tmp_path / "o3")).where("n = 2").count() == 1


def test_rendered_articles(spark):
    from inkweir.operators import articles

    parsed = spark.createDataFrame([(markup.parse_article("T", 1, ARTICLE) | {"page_id": 1})], schemas.ARTICLES)
    known = spark.createDataFrame([("http://v",), (None,)], "url string")
    row = articles.rendered(parsed, known).first()
    assert row["html"] == "<p>First. Lead sentence.[1] More</p>\n<h1>One</h1>\n<p>Text a. Text b.[2]</p>\n<h1>Two</h1>\n<p>last</p>" and row["saved"] == []
    cites = ARTICLE.replace("[2] trailing", "[4]")
    parsed = spark.createDataFrame([markup.parse_article("T", 1, cites)], schemas.ARTICLES)
    row = articles.rendered(parsed, known).first()
    assert 'Text b.<a href="4.json">[4]</a></p>' in row["html"] and row["saved"] == [4]
    assert articles.resolvable(parsed, known).count() == 1 and articles.resolvable(parsed, known.where("url is null")).count() == 0


def test_lines_filtered_between_input_and_output(spark):
    import io

    told = spark.createDataFrame([("the cat and the dog ran through the old house of the town", "en"), ("der Hund und die Katze liefen durch das alte Haus der Stadt", "de")], "text string, language string")
    en, de = {"paragraphs": [["the dog of the town ran through the house"]], "extra": 1}, {"paragraphs": [["der Hund der Stadt lief durch das Haus"]]}
    lines = [json.dumps(x) + "\n" for x in ({"id": "1", "documents": [de, en], "more": "x"}, {"id": "2", "documents": [de]}, {"id": "3", "documents": None}, {"id": "4", "documents": [en]})] + ["broken\n"]
    out, report = io.StringIO(), io.StringIO()
    assert filters.filter_lines(spark, lines, out, train_profiles(told), 2, report) == (5, 2)
    assert [json.loads(x) for x in out.getvalue().splitlines()] == [{"id": "1", "documents": [en], "more": "x"}, {"id": "4", "documents": [en]}]
    assert report.getvalue().splitlines()[-1] == "2 of 5 kept"
