import base64
import hashlib
from html.parser import HTMLParser

from postlens.llm import warc as W

PAGE = """<!DOCTYPE html><html><head><meta charset="UTF-8"><title>A &amp; B</title><style>p{}</style>
<script>var t="</p>";</script></head><body><!-- x --><nav><a href="/x?a=1&amp;b=2">X</a><a class=k href='y'>Y</a><a href=/x>Z</a></nav>
<p>One <b>two</b>&nbsp;three &#8364; &lt;tag&gt;<p>Four<br>five</body></html>"""


class Plain(HTMLParser):
    BLOCK = {"p", "br", "nav", "body", "html", "head", "title"}

    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.out += ["\n"] if tag in self.BLOCK else []

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        self.out += ["\n"] if tag in self.BLOCK else []

    def handle_data(self, data):
        self.out += [] if self.skip else [data]


def test_text_equals_a_parser():
    own = Plain()
    own.feed(PAGE)
    lines = [" ".join(x.split()) for x in "".join(own.out).split("\n")]
    assert W.plain_text(PAGE).split("\n") == [x for x in lines if x]


def test_records_are_linked(spark):
    pages = [(1, "http://a/b", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<p>" + "wörd " * 50_000)]
    df = spark.createDataFrame([(*p, "q") for p in pages], "page_id long, url string, html string, block string")
    captured = W.responses(df)
    rows = W.derive(captured).select("*", W.serialized().alias("record")).collect()
    assert len(rows) == 2 * len(pages)
    ids = [r.record_id for r in captured.collect()]
    assert len(set(ids)) == len(pages) and len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        page = next(p for p in pages if str(p[0]) == r.source_id)
        assert r.refers_to in ids and r.record_id == W.record_name(r.warc_type, r.refers_to)
        own = "sha1:" + base64.b32encode(hashlib.sha1((page[2] or "").encode()).digest()).decode()
        assert r.source_digest == own and "HTTP/1.1 200 OK" in r.source_headers
        body = r.block.encode()
        assert r.content_length == len(body) and r.block_digest == W.digest(body)
        head, _, rest = r.record.partition("\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        size = int(fields["Content-Length"])
        assert rest.encode()[:size] == body and rest.encode()[size:] == b"\r\n\r\n"
        assert fields["WARC-Refers-To"] == r.refers_to and fields["WARC-Date"] == W.UNDATED and ("WARC-Target-URI" in fields) == (page[1] is not None)
        if r.warc_type == "conversion":
            assert r.block == W.plain_text(page[2] or "")
        else:
            assert f"source-payload-digest: {own}\r\n" in r.block
    first = next(r.block for r in rows if r.source_id == "1" and r.warc_type == "metadata")
    assert "title: A & B\r\ncharset: utf-8\r\noutlink: /x?a=1&b=2\r\noutlink: y\r\noutlink: /x\r\n" in first
    assert W.derive(captured.limit(0)).count() == 0


def test_dates_and_unique_ids(spark):
    pages = [(1, "u", "x", "2024-05-06 07:08:09")] * 7 + [(2, None, "x", None), (2, "", "x", None), (2, "", None, None), (None, None, None, None)]
    df = spark.createDataFrame(pages * 3, "page_id long, url string, html string, seen string").repartition(4)
    df = df.withColumn("seen", df.seen.cast("timestamp")).withColumn("again", df.page_id).withColumn("name", df.url)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = W.derive(W.responses(df, date=df.seen)).collect()
    spark.conf.unset("spark.sql.session.timeZone")
    assert len(rows) == len({r.record_id for r in rows}) == 2 * 3 * len(pages)
    assert len({r.refers_to for r in rows}) == 3 * len(pages)
    assert {(r.source_id, r.warc_date) for r in rows} == {("1", "2024-05-06T07:08:09Z"), ("2", W.UNDATED), (None, W.UNDATED)}
    assert {r.warc_date for r in W.derive(W.responses(df, date="2025-01-02T03:04:05Z")).collect()} == {"2025-01-02T03:04:05Z"}
