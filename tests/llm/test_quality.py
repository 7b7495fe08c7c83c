"""op3's verdict against a plain fit that goes over documents one by one."""

import math
import random

from terracat.llm.quality import RULES, features, judge_quality


def plain_fit(votes, rounds=60):
    """Posterior of good for each document, from each document's own votes (0 none, 1 good, 2 bad)."""
    p = []
    for v in votes:
        bad, good = v.count(2), v.count(1)
        p.append(min(0.98, max(0.02, 1 - 2 * bad / max(1, bad + good))))
    start = {"good": [2.0, 8.0, 0.2], "bad": [2.0, 2.0, 6.0]}
    for _ in range(rounds):
        mass = {"good": 9.0 + sum(p), "bad": 1.0 + sum(1 - x for x in p)}
        tables = {c: [list(start[c]) for _ in RULES] for c in start}
        for x, v in zip(p, votes, strict=True):
            for r, o in enumerate(v):
                tables["good"][r][o] += x
                tables["bad"][r][o] += 1 - x
        def told(v, c):
            return math.log(mass[c]) + sum(math.log(tables[c][r][o] / sum(tables[c][r])) for r, o in enumerate(v))
        p = [1 / (1 + math.exp(min(500, told(v, "bad") - told(v, "good")))) for v in votes]
    return p


def votes(pattern):
    out = []
    for _ in RULES:
        out.insert(0, pattern % 3)
        pattern //= 3
    return out


def test_verdict(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [prose(rng.randint(20, 120)) for _ in range(80)]
    texts += [" ".join(rng.choice(["#x", "$$y", "BUY!!", "%%", "NOW!!"]) for _ in range(40)) for _ in range(12)]
    texts += [(prose(8) + "\n") * 6 for _ in range(8)] + [prose(4), prose(60).upper(), prose(30) + " ## $$ ||", "", None, prose(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counted = [features((t or "").encode(), {}) for t in texts]
    want = plain_fit([votes(f[5]) for f in counted])
    got = {r.doc_id: r for r in judge_quality(docs).collect()}
    assert len(got) == len(texts)
    for k, p in enumerate(want):
        assert abs(got[k].p_good - p) < 1e-6, k
        n, repeat = counted[k][0], counted[k][4]
        failed = n < 10 or 100 * repeat > 20 * n
        assert (got[k].base_failed, got[k].kept) == (failed, not failed and p >= 0.5)
    assert all(got[k].kept for k in range(80)) and not any(got[k].kept for k in range(80, 92))
