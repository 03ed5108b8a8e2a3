import pytest

from wellmart.llm import tokencount as tc


@pytest.fixture(scope="module")
def pieces():
    return tc.load_pieces()


def brute(word, pieces, unknown):
    best = [(0.0, 0)] + [(float("-inf"), 0)] * len(word)
    for i in range(len(word)):
        for j in range(i + 1, len(word) + 1):
            p = pieces.get(word[i:j])
            if p is not None and best[i][0] + p > best[j][0]:
                best[j] = (best[i][0] + p, best[i][1] + 1)
        if word[i] not in pieces and best[i][0] + unknown > best[i + 1][0]:
            best[i + 1] = (best[i][0] + unknown, best[i][1] + len(word[i].encode()))
    return best[-1][1]


def test_against_naive_dynamic_programming(rows, pieces):
    small, trie = tc.PrefixTrie(pieces, 500), tc.PrefixTrie(pieces)
    words = {w for r in list(rows.values())[:60] for w in r["text"].split()} | {"漢字", "x\U0001F600y", "a" * 50}
    for w in sorted(words):
        want = brute(tc.MARK + w, pieces, trie.unknown)
        assert trie.tokens(tc.MARK + w) == small.tokens(tc.MARK + w) == want


def test_long_words_need_no_trie(pieces):
    import random

    trie, r = tc.PrefixTrie(pieces), random.Random(4)
    for n in (tc.LONG_WORD, tc.LONG_WORD + 1, 2 * tc.LONG_WORD, 5000):
        w = "".join(r.choice("abceinorstu漢é0") for _ in range(n))
        assert trie.tokens(tc.MARK + w) == brute(tc.MARK + w, pieces, trie.unknown)
    assert len(trie.score) <= tc.LONG_WORD + 1


def test_against_public_unigram_model(rows, pieces):
    from tokenizers import Tokenizer, models

    model = Tokenizer(models.Unigram([("<unk>", -100.0), *pieces.items()], 0, False))
    trie = tc.PrefixTrie(pieces)
    for r in list(rows.values())[:40]:
        for w in r["text"].split():
            ids = model.encode(tc.MARK + w, add_special_tokens=False).ids
            if 0 not in ids:
                assert trie.tokens(tc.MARK + w) == len(ids)


def test_rows(docs, edge, empty, rows, pieces):
    trie = tc.PrefixTrie(pieces)
    for r in tc.token_counts(docs).collect():
        parts = rows[r["doc_id"]]["text"].split()
        assert (r["n_words"], r["n_tokens"]) == (len(parts), sum(trie.tokens(tc.MARK + p) for p in parts))
    got = tc.token_counts(edge).collect()
    assert len(got) == edge.count()
    assert all(r["n_tokens"] == 0 for r in got if r["doc_id"] in (0, 1, 2))
    assert tc.token_counts(empty).count() == 0
