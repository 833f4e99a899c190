import gzip
import zlib

from pyspark.sql import functions as F

from wavetrawl.operators.records import decode_pages, html_responses
from wavetrawl.sources.archives import read_archives

ZH = "我们在这里说的是一个新的广播节目，大家可以在网上听到。"
TW = "我們在這裡說的是一個新的廣播節目，大家可以在網上聽到。"
KO = "우리는 여기에서 새로운 라디오 방송을 들을 수 있고 인터넷에서도 들을 수 있습니다."
RU = "Мы слушаем новую передачу, и её можно найти в сети."
JA = "これはテストです。ラジオの音声。"


def test_decoding(spark):
    cases = [
        (JA.encode(), JA),
        (JA.encode("shift_jis"), JA),
        (JA.encode("euc_jp"), JA),
        (JA.encode("iso2022_jp"), JA.encode("iso2022_jp").decode()),
        ("café à la carte".encode("cp1252"), "café à la carte"),
        (b'<meta charset="koi8-r">' + "привет".encode("koi8-r"), '<meta charset="koi8-r">привет'),
        (b'<meta charset="no-such">' + "né".encode("cp1252"), '<meta charset="no-such">né'),
        (ZH.encode("gb18030"), ZH),
        (TW.encode("big5"), TW),
        (KO.encode("euc_kr"), KO),
        (RU.encode("cp1251"), RU),
        (b"<p>Naive " + "Größe über façade, señor".encode("cp1252"), "<p>Naive Größe über façade, señor"),
        (("カタカナ" * 5 + "です").encode("shift_jis"), "カタカナ" * 5 + "です"),
        ("abc é".encode("utf-16"), "abc é"),
        (b"\xfe\xff" + "abc é".encode("utf-16-be"), "abc é"),
        ("abc é".encode("utf-32"), "abc é"),
        (b"\xff\xfe\x00", None),
        ('<script>charset="koi8-r"</script><meta charset=cp1252>é'.encode("cp1252"), '<script>charset="koi8-r"</script><meta charset=cp1252>é'),
        (b"\x81\x00\xff\xfe\x8d", None),
        (b"", ""),
        (None, None),
    ]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, (b, _) in enumerate(cases)], "i int, payload binary")
    got = {r.i: r.html for r in decode_pages(df).collect()}
    assert [got.get(i) for i in range(len(cases))] == [text for _, text in cases]


def test_html_responses(spark):
    rows = [("response", "text/html", True), ("response", "TEXT/HTML", False), ("response", None, False), ("request", "text/html", False), ("response", "application/xhtml+xml", True)]
    df = spark.createDataFrame(rows, "rec_type string, content_type string, kept boolean")
    assert [r.kept for r in html_responses(df).collect()] == [True, True]


def _record(kind, body, uri="http://h/", http=b""):
    block = http + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    return head + block + b"\r\n\r\n"


def _http(*headers):
    return b"HTTP/1.1 200 OK\r\n" + b"".join(h.encode() + b"\r\n" for h in headers) + b"\r\n"


def test_archive_scan(spark, tmp_path):
    deflated = zlib.compress(b"<p>deflated</p>")
    chunked = b"5\r\n<p>ch\r\n7;x=1\r\nunk</p>\r\n0\r\n\r\n"
    records = [
        _record("warcinfo", b"software: x\r\n"),
        _record("request", b"GET / HTTP/1.1\r\n\r\n"),
        _record("response", b"<p>\r\n\r\nplain</p>", "http://h/1", _http("Content-Type: text/html")),
        _record("response", chunked, "http://h/2", _http("content-type: text/html", "Transfer-Encoding: chunked")),
        _record("response", gzip.compress(b"<p>zip</p>"), "http://h/3", _http("Content-Encoding: gzip")),
        _record("response", deflated, "http://h/4", _http("Content-Encoding: deflate")),
        _record("metadata", b"x: y"),
    ]
    whole, cut, plain = tmp_path / "a.warc.gz", tmp_path / "b.warc.gz", tmp_path / "c.warc"
    whole.write_bytes(b"".join(gzip.compress(r) for r in records))
    cut.write_bytes(b"".join(gzip.compress(r) for r in records[:4])[:-30])
    plain.write_bytes(b"".join(records))
    expected = [
        ("http://h/1", "text/html", b"<p>\r\n\r\nplain</p>"),
        ("http://h/2", "text/html", b"<p>chunk</p>"),
        ("http://h/3", None, b"<p>zip</p>"),
        ("http://h/4", None, b"<p>deflated</p>"),
    ]

    def scan(path, **options):
        rows = read_archives(spark, [str(path)], **options).orderBy("pos").collect()
        return [(r.target_uri, r.content_type, bytes(r.payload)) for r in rows if r.rec_type == "response"], len(rows)

    assert scan(whole) == (expected, 7)
    assert scan(plain, rec_type="response") == (expected, 4)
    assert scan(cut, rec_type="response") == (expected[:1], 1)
    assert read_archives(spark, [str(cut)]).orderBy(F.desc("pos")).first().rec_type == "broken"
    pushed = read_archives(spark, [str(whole), str(plain)]).filter("rec_type = 'metadata'")
    assert pushed.rdd.getNumPartitions() == 2
    assert [r.pos for r in pushed.collect()] == [6, 6]
