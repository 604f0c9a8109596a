import io
import tarfile

from pyspark.sql import functions as F
from tests.conftest import rows

from foliomill.sources import files, sinks


def test_journal(spark):
    lines = [
        ("f", 1, '{"source_identifier":"a","document_url":"u","status":"failed","recorded_at":"2024-01-01T00:00:00Z"}'),
        ("f", 2, '{"source_identifier":"a","document_url":"u","status":"stored","recorded_at":"2024-01-02T00:00:00Z"}'),
        ("f", 3, '{"source_ident'),
        ("g", 1, '{"x'),
        ("g", 2, "{}"),
        ("g", 3, " "),
    ]
    df = spark.createDataFrame(lines, "object_key string, line_no int, line_text string")
    assert ("a", "u", "stored") in [tuple(r)[:3] for r in files.latest_records(df).collect()]
    assert rows(files.torn_tail_only(df, "object_key", "line_no")) == [("f", 1, True), ("g", 1, False)]


def test_listing_and_kinds(spark, tmp_path):
    for name, data in {"a.pdf": b"%PDF-1.7 x", "b/c.json": b' {"a":1}', "d": b"", "e.html": b"<!DOCTYPE html><p>", "f": b"??"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    assert [r["size"] for r in files.listing(spark, str(tmp_path)).orderBy("size").collect()] == [2, 8, 10, 18]
    kinds = {r["key"].rsplit("/", 1)[1]: r["kind"] for r in files.file_digests(spark, str(tmp_path)).collect()}
    assert kinds == {"a.pdf": "pdf", "c.json": "json", "e.html": "html", "f": "unknown"}


def test_anchors(spark):
    html = '<a href="https://h.example/x.PDF"> One <b>file</b></a><a name=q>no</a><a href="https://o.example/y.pdf">two</a>'
    links = files.anchors(spark.createDataFrame([(1, html), (2, None)], "page int, html string"), "page", "html")
    assert rows(links.select("place", "text")) == [(0, "One file"), (1, "two")]
    assert [r["url"] for r in files.document_links(links, "page", "h.example", ".pdf").collect()] == ["https://h.example/x.PDF"]
    assert rows(files.single_link(links, "page")) == [(1, None, 2)]


def test_links_of_one_kind(spark):
    base = "https://h.example/list/page.html?x=1"
    html = "".join(f'<a href="{h}">{t}</a>' for h, t in [("a.pdf", "first"), ("/b.PDF", "b"), ("//o.example/c.pdf", "c"), ("a.pdf", "last"), ("mailto:x@y", "m")])
    pages = spark.createDataFrame([(1, html, base)], "page int, html string, base string")
    links = files.resolved(files.anchors(pages, "page", "html").withColumn("base", F.lit(base)), "base")
    assert [r["href"] for r in links.orderBy("place").collect()] == ["https://h.example/list/a.pdf", "https://h.example/b.PDF", "https://o.example/c.pdf", "https://h.example/list/a.pdf", "mailto:x@y"]
    assert {r["text"] for r in files.document_links(links, "page", "h.example", ".pdf").collect()} == {"first", "b"}
    assert {r["text"] for r in files.document_links(links, "page", "H.example", ".pdf", last=True).collect()} == {"last", "b"}
    assert rows(files.single_link(links, "page", "o.example", ".pdf")) == [(1, "https://o.example/c.pdf", 1)]
    assert rows(files.single_link(links, "page", "z.example")) == [(1, None, 0)]


def test_recognised_lines(spark):
    words = [(1, 1, 1, 1, 2, 50.0, "mundo"), (1, 1, 1, 1, 1, 90.0, "hola"), (1, 1, 1, 2, 1, 70.0, "fin"), (2, 1, 1, 1, 1, 10.0, "x")]
    df = spark.createDataFrame(words, "page_num int, block_num int, par_num int, line_num int, word_num int, conf double, text string")
    assert rows(files.recognised_lines(df).select("page_num", "line_num", "text", "confidence")) == [(1, 1, "hola mundo", 70.0), (1, 2, "fin", 70.0), (2, 1, "x", 10.0)]
    assert rows(files.confidence_stats(df).select("page_num", "n_words", F.round("low_share", 3))) == [(1, 3, 0.333), (2, 1, 1.0)]
    assert spark.range(1).select(files.forbidden_in_xml(F.lit("a\x01b\x02\n"))).first()[0] == 2


def test_markup_words_and_table(spark, tmp_path):
    (tmp_path / "l.xml").write_text('<doc><page width="100" height="50"><word xMin="1" yMin="2" xMax="9" yMax="4">uno</word><word xMin="80" yMin="2" xMax="90" yMax="4">dos</word></page></doc>')
    assert rows(files.layout_words(spark, str(tmp_path / "l.xml")).select("page", "word", "side")) == [(1, "dos", "right"), (1, "uno", "left")]
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    (tmp_path / "w.tsv").write_text(head + "5\t1\t1\t1\t1\t1\t0\t0\t1\t1\t91.5\thola\n5\t1\t1\t1\t1\t2\t0\t0\t1\t1\t-1\t\n")
    assert rows(files.word_table(spark, str(tmp_path / "w.tsv")).select("text", "conf")) == [("hola", 91.5)]
    assert spark.range(1).select(files.clean_xml(F.lit("a\x01b\n"))).first()[0] == "a�b\n"


def test_archives(spark):
    blob = io.BytesIO()
    with tarfile.open(fileobj=blob, mode="w:gz") as t:
        for name in ("a/1.txt", "b.txt"):
            info = tarfile.TarInfo(name)
            info.size = 2
            t.addfile(info, io.BytesIO(b"hi"))
    df = spark.createDataFrame([("k", bytearray(blob.getvalue()))], "key string, content binary")
    got = files.archive_members(df, "key", "content").select("member", F.decode("payload", "UTF-8"))
    assert rows(got) == [("a/1.txt", "hi"), ("b.txt", "hi")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, sha string")
    path = str(tmp_path / "t")
    assert sinks.put_immutable(df, path, "k", "sha").isEmpty()
    more = spark.createDataFrame([("a", "9"), ("c", "3")], "k string, sha string")
    assert rows(sinks.put_immutable(more, path, "k", "sha")) == [("a", "9", "1")]
    assert spark.read.parquet(path).count() == 2
    a = sinks.publish(df, str(tmp_path / "p"), "k")
    b = sinks.publish(df.repartition(3), str(tmp_path / "q"), "k")
    assert a == b and len(a) == 64
