import hashlib
import random

import numpy as np
import pytest

from wellmart.llm import suffixes as sx


def brute(rows, k=100):
    """Contract columns per (doc_id, text) row; rows of equal ids count apart."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - k + 1):
            w = hashlib.blake2b(b[i:i + k], digest_size=12).digest()
            least[w] = min(least.get(w, sx.NO_ID), sx.NO_ID if d is None else d)
    out = []
    for d, t in rows:
        b, had, gone = (t or "").encode(), set(), bytearray(len((t or "").encode()))
        for i in range(len(b) - k + 1):
            w = hashlib.blake2b(b[i:i + k], digest_size=12).digest()
            if least[w] < (sx.NO_ID if d is None else d) or w in had:
                gone[i:i + k] = b"\x01" * k
            had.add(w)
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def digest(df, **settings):
    return sorted(str(tuple(r)) for r in sx.suffix_digest(df, **settings).collect())


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_two_stage_order_is_the_suffix_order():
    r = random.Random(1)
    for trial in range(400):
        text = bytes(r.choice([b"ab", b"aaab\xff", b"\x00\x01\xfe", bytes(range(97, 123))][trial % 4]) for _ in range(r.randint(1, 90))) + b"\xff"
        assert sx.suffix_order(text, 96).tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    for text in (b"a" * 5000 + b"b" * 3000 + b"a" * 5000, b"abc" * 4000):
        order = sx.suffix_order(text, 100)
        cut = [text[i:i + 100] for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and cut == sorted(cut)


def test_common_prefixes():
    r = random.Random(2)
    text = bytes(r.choice(b"ab") for _ in range(600)) + b"a" * 300
    a, b = np.array([r.randrange(500) for _ in range(500)]), np.array([r.randrange(500, 700) for _ in range(500)])
    want = [next((n for n in range(100) if text[x + n] != text[y + n]), 100) for x, y in zip(a, b)]
    assert sx.common_prefixes(sx._words(text, 100), a, b, 100).tolist() == want


def test_runs_do_not_depend_on_pieces():
    r = random.Random(3)
    data = [bytes(r.choice(b"abcdefgh ") for _ in range(n)) for n in (5, 99, 100, 101, 3000)] + [b"xy" * 900]
    for piece in (64, 1 << 20):
        runs = sx.Runs(data, 100, 32, True, piece)
        assert sum(runs.count) == sum(max(0, len(t) - 99) for t in data)
        for i, s in enumerate(runs.strings(np.arange(len(runs.text)))):
            assert data[runs.text[i]][runs.at[i]:].startswith(s)
        assert runs.twice[runs.text == 5].all() and not runs.twice[runs.text < 5].any()


@pytest.fixture(scope="module")
def made(spark):
    """Copies, shared passages, repeats inside a text, periodic texts, characters cut by window borders, clashing columns."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuvwé漢") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line, long = prose(60), "=" * 40 + " notice " + "=" * 40, prose(15000)
    rows = [(i, prose(r.randint(0, 120))) for i in range(60)]
    rows += [(100 + i, prose(20) + passage + prose(9)) for i in range(40)] + [(200 + i, passage) for i in range(30)]
    rows += [(300 + i, prose(5) + line + prose(30) + line) for i in range(60)]
    rows += [(400, passage + passage[:110] + prose(3) + passage), (401, "a" * 5000), (402, "a" * 99), (403, "ab" * 700 + "c" + "ab" * 700),
             (404, (prose(30) + "\n") * 9), (405, long), (406, long[:50000] + "!" + long[50000:]), (407, None), (407, ""), (408, "é" * 400),
             (409, passage), (409, passage), (409, passage + " x"), (None, passage), (None, passage), (None, prose(50) * 2), (None, None)]
    rows = [(d, t, 1, b"x", "y") for d, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, chunk long, places binary, key string").repartition(7)


@pytest.mark.parametrize("hot", [sx.HOT, 3])
def test_matches_brute_force(made, hot):
    assert digest(made, hot=hot) == brute(rows_of(made))


def test_small_chunks_buckets_and_sorts(made, docs, monkeypatch):
    for name, value in (("HASH_BUCKET", 500), ("STRING_BUCKET", 20_000), ("SORT_BYTES", 5_000)):
        monkeypatch.setattr(sx, name, value)
    assert digest(made) == brute(rows_of(made))
    assert digest(docs) == brute(rows_of(docs))


def test_edges(edge, empty):
    assert digest(edge) == brute(rows_of(edge))
    assert digest(empty) == []


def test_spans_and_kept_bytes_make_the_text(made):
    texts = {}
    for d, t in rows_of(made):
        texts.setdefault(d, []).append((t or "").encode())
    for r in sx.dedup_bytes(made).collect():
        def kept(b):
            for s in reversed(r["spans"]):
                b = b[:s["start"]] + b[s["end"]:]
            return b
        assert any(len(b) == r["n_bytes"] and kept(b) == bytes(r["kept"]) for b in texts[r["doc_id"]])
        assert all(x["end"] < y["start"] for x, y in zip(r["spans"], r["spans"][1:]))
