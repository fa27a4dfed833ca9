"""WARC round trips with hostile payloads, and URL rules against a plain judge."""

from __future__ import annotations

import hashlib
import random

from gridloom.llm import url_rules, warc
from gridloom.llm.queries import URL_RULES
from tests.llm.conftest import with_clashes

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def plain_records(pages):
    first = {}
    for page_id, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page_id is not None:
            first[raw] = max(page_id, first.get(raw, page_id))
    out = []
    for page_id, _, html in pages:
        raw = (html or "").encode()
        leader = first.get(raw)
        again = leader is not None and page_id != leader
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", leader if again else None))
    return sorted(out, key=str)


def hostile_pages():
    draw = random.Random(3)
    big = "é" * 700
    pages = [
        (1, "http://a.example/x", big),
        (2, "http://a.example/y\r\nWARC-Type: metadata", big),
        (3, None, big),
        (4, "http://b.example", None),
        (5, "http://b.example", ""),
        (6, "http://c.example", FAKE),
        (7, "http://c.example", "WARC/1.1\r\n"),
        (8, "http://c.example", "x" + FAKE * 30),
        (9, "http://c.example", "\r\n\r\n" + FAKE + "\n\n"),
        (10, "http://d.example", "a" * 999),
        (11, "http://d.example", "a" * 999),
        (None, "http://d.example", big),
        (None, "http://d.example", "z" * 2000),
        (12, "http://e.example", "q" * 300000),
        (13, "u", FAKE[:-4]),
        (13, "u", FAKE[:-4]),
        (14, "v", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\nWARC/1.1\r\n"),
    ]
    return pages + [(100 + i, f"http://f.example/{i}", "".join(draw.choice(["WARC/1.1\r\n", "\r\n", "Content-Length: 2\r\n", "t", "ü"]) for _ in range(draw.randint(0, 40)))) for i in range(120)]


def test_hostile_payloads_come_back(spark):
    pages = hostile_pages()
    frame = with_clashes(spark, pages, "page_id long, url string, html string").repartition(3)
    got = sorted(map(tuple, warc.round_trip(frame).collect()), key=str)
    assert got == plain_records(pages)


def test_archives_are_read_the_same_way_when_they_are_cut_anywhere(spark):
    pages = hostile_pages()
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    from gridloom.session import fresh_path

    folder = fresh_path(spark, "warc-test")
    warc.write_archives(frame, folder)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1777")
        got = sorted(map(tuple, warc.read_archives(spark, folder).collect()), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain_records(pages)


def test_written_bytes_are_warc(spark):
    from gridloom.session import fresh_path

    folder = fresh_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(1, "http://a", "<p>")], "page_id long, url string, html string").coalesce(1), folder)
    raw = bytes(next(r.content for r in spark.read.format("binaryFile").load(f"{folder}/part-*").collect() if r.length))
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    assert head.startswith(b"WARC/1.1\r\n") and fields[b"WARC-Type"] == b"response"
    assert rest[: int(fields[b"Content-Length"])].endswith(b"\r\n\r\n<p>") and rest[int(fields[b"Content-Length"]) :] == b"\r\n\r\n"


def test_no_pages(spark):
    empty = with_clashes(spark, [], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0


def test_broken_chain_ends_where_it_breaks(spark):
    rows = [("f", 0, 10), ("f", 10, 25), ("f", 20, 30), ("f", 30, None), ("g", 0, 7), ("g", 7, 9), ("g", 9, 100), ("h", 5, 9)]
    got = warc.on_chain(spark.createDataFrame(rows, "file string, offset long, next long")).collect()
    assert sorted(map(tuple, got)) == [("f", 0), ("f", 10), ("g", 0), ("g", 7), ("g", 9)]


def plain_verdict(url, rules, default="allow"):
    if not url or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
        tail = rest[at:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h) + len(p), len(h), a, h + p) for h, p, a in rules if (host == h or h == "" or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else default


def judged(spark, rows, rules):
    frame = with_clashes(spark, rows, "page_id long, url string")
    found = url_rules.judge_urls(frame, spark.createDataFrame(rules, "host string, path string, action string"))
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=str)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://NET", "http://net/", "http://x.net?q=/", "HTTPS://A.Example.NET/en/x#y", "http://example.net/en", "http://fakeexample.com/de/1"]
    urls += ["http://example.com/de/", "http://u:p@example.com:80/de/", "a://b://c.net/", "http://m.org/fr/?x", "http://org/fr/é", "http://deep." + "a." * 500 + "net/" + "b/" * 500, "http://..net/", "http://é.net//x"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(3, "http://"), (None, "http://net/"), (None, None)]
    assert judged(spark, rows, URL_RULES) == sorted(((i, *plain_verdict(u, URL_RULES)) for i, u in rows), key=str)
    assert judged(spark, [], URL_RULES) == []


def test_urls_with_other_rules(spark):
    draw = random.Random(9)
    name = lambda: ".".join(draw.choice("ab") for _ in range(draw.randint(1, 4)))
    path = lambda: draw.choice(["", "/", "/a", "/a/", "/a/b", "/a/b/", "/ab", "/a/b/c.html", "a"])
    rules = list({(draw.choice([name(), ""]), path()): None for _ in range(40)})
    rules = [(h, p, draw.choice(["allow", "block"])) for h, p in rules]
    rows = [(i, f"http://{name()}{path()}{draw.choice(['', '?a/b', '#/a'])}") for i in range(300)]
    assert judged(spark, rows, rules) == sorted(((i, *plain_verdict(u, rules)) for i, u in rows), key=str)
    assert {r[4] for r in judged(spark, rows[:3], rules[:0])} == {"allow"}
