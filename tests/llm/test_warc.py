"""Archives and their index: look-ups against a plain search, and payloads against what was written."""

import base64
import hashlib
import random

from terracat.llm import warc as W
from terracat.llm.common import fresh_path

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(4)
    hosts = ["a.example.com", "b.example.com", "example.com", "münchen.example", "x.org"]
    rows = [(k, f"https://{rng.choice(hosts)}/{rng.randint(0, 40)}?q={rng.randint(0, 2)}", rng.choice(["", "<p>same</p>", f"<p>page {k} é</p>"])) for k in range(400)]
    return rows + [(1000 + k, "http://hot.example/", f"<p>{k}</p>") for k in range(150)] + [(2000, None, None), (2001, "", "<p>same</p>"), (2002, "not a url", "z" * 300_000)]


def test_look_up(spark, request):
    rows = pages()
    lines = W.write_archives(spark.createDataFrame(rows, PAGES).repartition(4), fresh_path(spark, "archives"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    request.addfinalizer(lambda: spark.conf.unset(name))
    parts = W.write_index(lines, fresh_path(spark, "index"), block_lines=20)
    assert parts.count() > 1
    asked = {W.url_key(u) for u in ("http://hot.example/", None, "https://example.com/7?q=1", "https://never.example/")} | {W.url_key(rows[5][1]), W.url_key(rows[6][1])}
    keys = spark.createDataFrame([(k,) for k in asked] * 2, "key string")
    want = sorted(tuple(r) for r in lines.collect() if r["key"] in asked)
    assert len(want) > 150 and sorted(tuple(r) for r in W.look_up(keys, parts).collect()) == want


def test_round_trip(spark):
    rows = pages()
    lines = W.write_archives(spark.createDataFrame(rows, PAGES).repartition(4), fresh_path(spark, "archives"))
    html = {i: (h or "").encode() for i, _, h in rows}
    latest = {}
    for i in sorted(html):
        latest[html[i]] = i
    got = {r["page_id"]: r for r in W.read_captures(lines).collect()}
    assert got.keys() == html.keys()
    for i, body in html.items():
        r = got[i]
        last = latest[body]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if last == i else ("revisit", last))
        assert r["payload"] == (body if last == i else None)
