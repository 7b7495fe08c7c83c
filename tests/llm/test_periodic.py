"""op13's runs against a plain version that tries every period at every place."""

import hashlib
import random
from zlib import crc32

import numpy as np

from terracat.llm import queries as Q
from terracat.llm.periodic_runs import periodic_runs, repeat_tail, scan


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q), q)  # periods rise: the first is the smallest
    return sorted((s, e - s, q) for (s, e), q in found.items())


def got_runs(texts):
    spans, kept = scan(texts)
    return [[(r["start"], r["length"], r["period"]) for r in s] for s in spans], kept


def periodic(rng, alphabet, q, n):
    base = [rng.choice(alphabet) for _ in range(q)]
    return [base[i % q] for i in range(n)]


def test_all_runs():
    rng = random.Random(4)
    texts = []
    for k in range(400):
        alphabet = [b"%d" % i for i in range(rng.choice([1, 2, 3, 50]))]
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
            q = rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 40, 63, 64, 65])
            words += periodic(rng, alphabet, q, rng.randint(3 * q, 6 * q + 3))
        texts.append(words)
    got, kept = got_runs(texts)
    assert sum(map(len, got)) > 300
    for words, runs, stay in zip(texts, got, kept, strict=True):
        assert runs == plain_runs(words)
        gone = set()
        for s, n, q in runs:
            gone |= set(range(s + q, s + n))
        assert stay == [w for i, w in enumerate(words) if i not in gone]


def test_nested_and_fibonacci():
    inner = [b"a"] * 9 + [b"b"]
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 3000:
        a, b = b, b + a
    texts = [inner * 12, (inner * 5 + [b"c"]) * 5, b, [b"x"] * 5, [b"x"] * 6, [b"x", b"y"] * 3 + [b"x"], [b"x", b"y"] * 4, []]
    got, _ = got_runs(texts)
    assert got == [plain_runs(t) for t in texts]
    assert got[4] == [(0, 6, 1)] and got[3] == [] and got[5] == [] and got[6] == [(0, 8, 2)]


def test_long_period():
    rng = np.random.default_rng(3)
    base = [b"%d" % v for v in rng.integers(0, 10**6, 60_000)]
    words = base * 4 + base[:7]
    got, kept = got_runs([[b"z"], words, [b"z"]])
    assert got[1] == [(0, 240_007, 60_000)] and kept[1] == base


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in Q.op13_periodic_runs(spark, sf).collect()}
    assert rows.keys() == docs.keys()
    for doc, text in docs.items():
        words = (text or "").encode().split()
        h, n = crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert words == repeat_tail(doc, (text or "").encode().split())
        if len(words) > 3000:
            runs = got_runs([words])[0][0]
        else:
            runs = plain_runs(words)
        gone = set()
        for s, m, q in runs:
            gone |= set(range(s + q, s + m))
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        want = (len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4))
        r = rows[doc]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    assert any(r.n_runs for r in rows.values())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a a a a a a a"), (1, None), (1, ""), (2, "b\n\n"), (2, "b b b b b b")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, len(r.runs), r.collapsed_text) for r in periodic_runs(docs.selectExpr("*", "1 as runs", "2 as n_words")).collect())
    assert got == [(0, 7, 1, "a"), (1, 0, 0, ""), (1, 0, 0, ""), (2, 1, 0, "b"), (2, 6, 1, "b")]
