"""The numbered queries against plain Python versions of their contracts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from terracat.llm import queries as Q
from terracat.llm.decontaminate import find_contamination
from terracat.llm.near_dup import near_duplicates
from terracat.llm.packing import best_fit, pack_documents
from terracat.llm.quality import judge_quality
from terracat.llm.substring_dedup import dedup_substrings
from terracat.llm.suffix_dedup import dedup_bytes, prefix_classes
from terracat.llm.tokens import Encoder, pack_ranks, token_index, unpack_ranks
from terracat.llm.toxicity import fit_toxicity, score_toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, odd blanks, and every odd case."""
    rng = random.Random(seed)
    vocab = [("".join(rng.choice("abcdéñü") for _ in range(rng.randint(1, 7)))) for _ in range(300)]
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    texts = []
    for k in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([3, 30, 120, 300]))]
        if k % 5 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = passage.split()
        sep = rng.choice([" ", " ", "\n", "  ", "\t"])
        texts.append(sep.join(words))
    for k in range(n // 3):
        words = texts[k].split()
        for _ in range(max(0, len(words) // 25 - k % 3)):
            words[rng.randrange(len(words))] = rng.choice(vocab).upper()
        texts.append(" ".join(words))
    texts += [texts[0], texts[1].title(), "", None, "   \n", "one", "One", passage, "ab " * 400, "ab " * 300, "#$ %% && " * 30]
    rng.shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(3 * k + 5, t, "xx", "s", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def check_near(rows, texts, ids, size):
    sets = {}
    for d, t in zip(ids, texts, strict=True):
        w = words(lower(t))
        sets[d] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got == {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, texts, size):
    ids = [3 * k + 5 for k in range(len(texts))]
    check_near(near_duplicates(docs, shingle=size).collect(), texts, ids, size)


def test_near_duplicates_chain(spark):
    """A chain of texts of which only neighbours are close, in one large group."""
    rng = random.Random(3)
    w = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(60):
        texts.append(" ".join(w))
        for _ in range(4):
            w[rng.randrange(200)] = f"n{k}{rng.random()}"
    ids = list(range(60))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in zip(ids, texts, strict=True)], SCHEMA)
    check_near(near_duplicates(df, shingle=2).collect(), texts, ids, 2)


def brute_contamination(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for t in texts:
        w = word.findall(lower(t))
        hit, found = set(), set()
        for i, x in items:
            v = word.findall(lower(x))
            n = min(10, len(v))
            for s in range(len(v) - n + 1) if v else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[s : s + n]:
                        hit.update(range(p, p + n))
                        found.add(str(i))
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_contamination(spark, docs, texts):
    rng = random.Random(5)
    items = [(k, x) for k, x in enumerate([" ".join(words(rng.choice([t for t in texts if t and len(t) > 50]))[3 : 3 + n]) for n in (4, 10, 12, 30, 1, 2, 25)] + ["", None, "one", "never seen words here at all", "Ab, ab; ab!"])]
    items += [(100, items[3][1])]
    got = {r["doc_id"]: tuple(r)[1:6] for r in find_contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_contamination(texts, items)
    assert got == {3 * k + 5: x for k, x in enumerate(want)}


def test_quality_base(docs, texts):
    got = {r["doc_id"]: tuple(r)[1:7] for r in judge_quality(docs).collect()}
    for k, t in enumerate(texts):
        w = words(t)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        twice = Counter(grams)
        rep = {i + j for i, g in enumerate(grams) if twice[g] > 1 for j in range(5)}
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        assert got[3 * k + 5] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(rep), failed)


def covered(seqs, ids, window):
    first = {}
    for d, s in sorted(zip(ids, seqs, strict=True)):
        for p in range(len(s) - window + 1):
            first.setdefault(s[p : p + window], d)
    out = {}
    for d, s in zip(ids, seqs, strict=True):
        gone = set()
        for p in range(len(s) - window + 1):
            if first[s[p : p + window]] < d:
                gone.update(range(p, p + window))
        out[d] = gone
    return out


def test_substring_dedup(docs, texts):
    ids = [3 * k + 5 for k in range(len(texts))]
    seqs = [tuple(words(t)) for t in texts]
    gone = covered(seqs, ids, 50)
    got = {r["doc_id"]: tuple(r)[1:4] for r in dedup_substrings(docs).collect()}
    for d, s in zip(ids, seqs, strict=True):
        kept = " ".join(x for i, x in enumerate(s) if i not in gone[d])
        assert got[d] == (len(s), len(gone[d]), hashlib.sha256(kept.encode()).hexdigest())


def test_byte_dedup(docs, texts, monkeypatch):
    ids = [3 * k + 5 for k in range(len(texts))]
    seqs = [(t or "").encode() for t in texts]
    gone = covered(seqs, ids, 50)
    got = {r["doc_id"]: tuple(r)[1:5] for r in dedup_bytes(docs).collect()}
    for d, s in zip(ids, seqs, strict=True):
        kept = bytes(x for i, x in enumerate(s) if i not in gone[d])
        runs = sum(1 for i in gone[d] if i - 1 not in gone[d])
        assert got[d] == (len(s), len(gone[d]), runs, hashlib.sha256(kept).hexdigest()), d


def test_prefix_classes():
    import numpy as np

    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 4, 3000).astype(np.uint8), 0)
    text[500:900] = text[1500:1900]
    order, cls = prefix_classes(text, 20)
    by = defaultdict(set)
    for p, c in zip(order.tolist(), cls.tolist(), strict=True):
        if p + 20 <= 3000:
            by[c].add(text[p : p + 20].tobytes())
    assert all(len(x) == 1 for x in by.values())
    assert len(by) == len({text[p : p + 20].tobytes() for p in range(2981)})


@pytest.mark.parametrize(("path", "blanks"), [(Q.WORD_BPE, "dropped"), (Q.BYTE_BPE, "kept")])
def test_encoder(path, blanks, texts):
    rng = random.Random(9)
    odd = ["a", "'s", "It's", " ", "  ", "\n", "\t x", "é", "ñ", " ", "\x85", "\x1c", "١", "<|endoftext|>", "don't", "123", "_", "…", "é", "　", "Σ", "ΑΣ", "​", "🙂"]
    mixed = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 30))) for _ in range(400)] + [t or "" for t in texts]
    e = Encoder(path, blanks)
    for t, ids in zip(mixed, e.encode(mixed), strict=True):
        assert ids.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_rank_code():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 5, 1000):
        x = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = pack_ranks(x)
        assert (unpack_ranks(control, data, n) == x).all()


def test_token_index(docs, texts):
    from tokenizers import Tokenizer

    model, start = Tokenizer.from_file(Q.WORD_BPE), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in token_index(docs, Q.WORD_BPE).collect()}
    for k, t in enumerate(texts):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
        assert got[3 * k + 5] == (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)


def test_packing(spark, docs, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(Q.BYTE_BPE)
    rows = pack_documents(docs, Q.BYTE_BPE, capacity=256).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 256
    for k, t in enumerate(texts):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        mine = sorted((r for r in rows if r["doc_id"] == 3 * k + 5), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert [r["length"] for r in mine[1:]] == [256] * (len(mine) - 1)
        assert sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    total = sum(r["length"] for r in rows)
    assert len(bins) <= 1.15 * total / 256 + 1


def test_packing_tree(spark, monkeypatch):
    """Many parts of few items end with about as few bins as one part."""
    import numpy as np

    from terracat.llm import packing

    monkeypatch.setattr(packing, "ITEMS", 300)
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 1500, 5000)
    items = spark.createDataFrame([(k, int(n)) for k, n in enumerate(sizes)], "item long, size int")
    got = packing.pack_items(items, 2048).collect()
    assert len(got) == 5000
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], int(sizes[r["item"]])))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= 1.03 * len(best_fit(sizes, 2048)[2])


def test_toxicity_fold(spark):
    got = {r["doc_id"]: r["held_out"] for r in score_toxicity(spark.createDataFrame([(k, "a", "", "", 1) for k in range(50)], SCHEMA), fit_toxicity(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int"))).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in range(50)}


def test_packing_rounds(spark):
    """Few items go through the tree too: several parts at first, and no more bins than one part would need."""
    import numpy as np

    from terracat.llm import packing

    sizes = np.random.default_rng(6).integers(1, 1500, 1600)
    items = spark.createDataFrame([(k, int(n)) for k, n in enumerate(sizes)], "item long, size int").repartition(4)
    got = packing.pack_items(items, 2048).collect()
    rounds = {r["sequence_id"] >> 56 for r in got}
    assert max(rounds) > 1 and len({r["sequence_id"] for r in got}) <= 1.03 * len(best_fit(sizes, 2048)[2])


@pytest.mark.parametrize("labels", [[], [(1, 0, 0), (2, 0, 0)], [(1, 0, 1)]])
def test_toxicity_untrained(spark, labels):
    """Without both labels nothing is learned: one score for texts of any length."""
    docs = spark.createDataFrame([(1, "a b c", "", "", 5), (2, "word " * 2000, "", "", 1), (3, None, "", "", 0)], SCHEMA)
    model = fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in score_toxicity(docs, model).collect()} == {0.5}
