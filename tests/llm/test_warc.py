import gzip
import hashlib
import re

from pressloom.llm import warc

HTML = '<html><head><title>t</title></head><body><h1>Grüße</h1><p>One <a href="/x?a=1&amp;b=2">two</a><img src=i.png></p><script>no()</script></body></html>'


def sha(data):
    return "sha256:" + hashlib.sha256(data).hexdigest()


def pages(spark):
    rows = [(1, "http://a/1", HTML, "x"), (2, None, None, None), (2, None, None, None), (None, "http://a/3", "", "y"), (4, "http://a/4", "<p>z</p>" * 50_000, "y")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, block string")


def test_links_between_records(spark):
    responses = warc.responses(pages(spark))
    by = {}
    for r in warc.derive(responses, carry=("page_id",)).collect():
        by.setdefault(r["page_id"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {1: 2, 2: 4, None: 2, 4: 2}
    source = {r["page_id"]: r for r in responses.collect()}
    for number, made in by.items():
        for r in made:
            assert r["headers"].get("WARC-Refers-To") == source[number]["record_id"]
            assert r["headers"].get("WARC-Refers-To-Target-URI") == r["target_uri"] == source[number]["target_uri"]
            assert r["headers"]["WARC-Source-Payload-Digest"] == source[number]["headers"]["WARC-Payload-Digest"]
            assert r["headers"]["WARC-Block-Digest"] == sha(bytes(r["block"])) and r["payload_intact"] is True
            assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", r["record_id"]) and r["record_id"] != source[number]["record_id"]
    kinds = {r["warc_type"]: r for r in by[1]}
    assert bytes(kinds["conversion"]["block"]).decode() == "Grüße\nOne two"
    assert kinds["conversion"]["headers"]["WARC-Source-Content-Type"] == "text/html; charset=utf-8"
    assert "outlink: /x?a=1&b=2 a/@href\r\noutlink: i.png img/@src\r\n" in bytes(kinds["metadata"]["block"]).decode()
    assert sha(HTML.encode()) in bytes(kinds["metadata"]["block"]).decode()
    again = {(r["page_id"], r["record_id"]) for r in warc.derive(responses, carry=("page_id",)).collect()}
    assert again == {(k, r["record_id"]) for k, v in by.items() for r in v}


def test_odd_records(spark):
    rows = [
        ("response", None, None, None, None, b"no header <p>x</p>"),
        ("response", "<urn:uuid:1>", "u", "d", {"WARC-Payload-Digest": "sha256:0"}, b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>\xe9</p>"),
        ("response", "<urn:uuid:2>", "u", "d", {}, b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG"),
        ("request", "<urn:uuid:3>", "u", "d", {}, b"GET /"),
        ("response", "<urn:uuid:4>", "u", "d", {}, None),
    ]
    got = warc.derive(spark.createDataFrame(rows, warc.RECORD)).collect()
    text = {r["headers"].get("WARC-Refers-To"): bytes(r["block"]).decode() for r in got if r["warc_type"] == "conversion"}
    assert text == {None: "no header\nx", "<urn:uuid:1>": "é", "<urn:uuid:2>": "", "<urn:uuid:4>": ""}
    assert {r["payload_intact"] for r in got if r["headers"].get("WARC-Refers-To") == "<urn:uuid:1>"} == {False}
    assert {r["payload_intact"] for r in got if r["headers"].get("WARC-Refers-To") == "<urn:uuid:2>"} == {None}


def test_all_source_headers_are_preserved(spark, tmp_path):
    """Every field of a response that was read from a file, also repeated and folded ones, reaches its derivatives."""
    http = b"HTTP/1.1 200 OK\r\nLast-Modified: Mon, 1 Jan 2024\r\nETag: \"x\"\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nX-Long: one\r\n two\r\nContent-Type: text/html\r\n\r\n<p>t</p>"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:7>\r\nWARC-Truncated: length\r\nWARC-Concurrent-To: <urn:a>\r\nWARC-Concurrent-To: <urn:b>\r\nWARC-IP-Address: 1.2.3.4\r\nContent-Type: application/http\r\n"
    (tmp_path / "one.warc").write_bytes(head + b"Content-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n")
    made = warc.derive(warc.read(spark, str(tmp_path / "one.warc")))
    warc.write(made, str(tmp_path / "out"))
    for rows in (made.collect(), warc.read(spark, str(tmp_path / "out")).collect()):
        assert len(rows) == 2
        for r in rows:
            assert r["headers"]["WARC-Source-Truncated"] == "length" and r["headers"]["WARC-IP-Address"] == "1.2.3.4"
            assert r["headers"]["WARC-Source-Concurrent-To"].split("\n") == ["<urn:a>", "<urn:b>"]
            assert r["headers"]["WARC-Source-Record-Content-Type"] == "application/http"
        text = next(bytes(r["block"]).decode() for r in rows if r["warc_type"] == "metadata")
        want = ['Last-Modified: Mon, 1 Jan 2024', 'ETag: "x"', "Set-Cookie: a=1", "Set-Cookie: b=2", "X-Long: one two", "Content-Type: text/html"]
        assert [line.removeprefix("http-header: ") for line in text.split("\r\n") if line.startswith("http-header: ")] == want


def test_files_round_trip(spark, tmp_path):
    made = warc.derive(warc.responses(pages(spark)))
    warc.write(made, str(tmp_path / "out"))
    plain = lambda rows: sorted((r["warc_type"], r["record_id"], r["target_uri"] or "", r["warc_date"], sorted((k, v) for k, v in r["headers"].items() if k != "Content-Length"), bytes(r["block"])) for r in rows)
    assert plain(warc.read(spark, str(tmp_path / "out")).collect()) == plain(made.collect())
    (tmp_path / "own").mkdir()
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 6\r\n\r\na\r\n\r\nb\r\n\r\n"
    (tmp_path / "own" / "a.warc").write_bytes(record * 2)
    (tmp_path / "own" / "b.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    assert [bytes(r["block"]) for r in warc.read(spark, str(tmp_path / "own")).collect()] == [b"a\r\n\r\nb"] * 4


def test_query_columns_and_empty_table(spark):
    assert warc.report(pages(spark)).where("block_digest is null or source_payload_digest is null").count() == 0
    assert warc.report(pages(spark).where("false")).collect() == []
