"""Unigram token counts by trie-shared dynamic programming.

The vocabulary file gives pieces in rank order; a piece's log-probability is
the rank's Zipf share (no training). A text is cut into pre-tokens (words
parted by white space, each with the mark U+2581 in front, pieces never cross
them). The best segmentation of a pre-token ends in its last character, and
the best score of a prefix does not depend on what follows, so all pre-tokens
are put into one trie: a node holds the best forward score and the token count
of its prefix, computed once for all words that share it.

The trie lives as long as a task and is emptied when it holds ``max_nodes``
nodes, which bounds memory and changes no count. A pre-token longer than
``LONG_WORD`` characters (a blob without white space) shares no prefix worth
keeping: its scores are computed the same way, of which only those that the
longest piece can reach are held. Rows never move, so nothing is shuffled and
no row waits for another task's words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import texts

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MAX_NODES = 600_000
LONG_WORD = 1024


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Piece to log-probability, of the ordinary pieces of a sentencepiece file (ids in rank order)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(names))))
    return {p: -math.log(r + 1) - total for r, p in enumerate(names)}


class PrefixTrie:
    """Forward scores of prefixes. An unknown character falls back to its UTF-8 bytes, at a score below all pieces."""

    def __init__(self, pieces: dict[str, float], max_nodes: int = MAX_NODES):
        self.pieces, self.max_nodes = pieces, max_nodes
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self._empty()

    def _empty(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def _step(self, word: str, i: int, path, score: list[float], count: list[int]) -> tuple[float, int]:
        """Best score and token count of ``word[:i + 1]``; those of ``word[:j]`` are at ``path[j]``."""
        ch, pieces, node = word[i], self.pieces, path[i]
        best, tokens = score[node] + self.unknown, count[node] + len(ch.encode("utf-8", "surrogatepass"))
        if ch in pieces:
            best, tokens = score[node] + pieces[ch], count[node] + 1
        for j in range(max(0, i + 1 - self.longest), i):
            p = pieces.get(word[j:i + 1])
            if p is not None and (s := score[path[j]] + p) > best:
                best, tokens = s, count[path[j]] + 1
        return best, tokens

    def _long(self, word: str) -> int:
        """Token count without the trie, holding the scores of ``LONG_WORD`` prefixes and those a piece reaches back to."""
        start, score, count = 0, [0.0], [0]
        for s in range(0, len(word), LONG_WORD):
            part = word[start:s + LONG_WORD]
            for i in range(s - start, len(part)):
                best, tokens = self._step(part, i, range(i + 1), score, count)
                score.append(best)
                count.append(tokens)
            score, count = score[-self.longest - 1:], count[-self.longest - 1:]
            start += len(part) + 1 - len(score)
        return count[-1]

    def tokens(self, word: str) -> int:
        """Token count of one pre-token (given with its mark)."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        if len(word) > LONG_WORD:
            return self._long(word)
        if len(self.score) + len(word) > self.max_nodes and len(self.score) > 1:
            self._empty()
        children, score, count = self.children, self.score, self.count
        path, node = [0], 0
        for i, ch in enumerate(word):
            nxt = children.get((node, ch))
            if nxt is None:
                best, tokens = self._step(word, i, path, score, count)
                nxt = len(score)
                children[node, ch] = nxt
                score.append(best)
                count.append(tokens)
            path.append(nxt)
            node = nxt
        self.terminal[word] = count[node]
        return count[node]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 max_nodes: int = MAX_NODES) -> DataFrame:
    """``doc_id, n_words, n_tokens, max_word_tokens``, one row per input row.

    Null, empty and blank texts count zero. The vocabulary (a file the driver
    reads, tens of thousands of pieces) is broadcast; executors need no file.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PrefixTrie(held.value, max_nodes)
        for b in batches:
            words, total, most = [], [], []
            for t in texts(b):
                parts = t.decode("utf-8", "replace").split() if t else []
                n = [trie.tokens(MARK + p) for p in parts]
                words.append(len(n))
                total.append(sum(n))
                most.append(max(n, default=0))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, total, most))],
                names=["doc_id", "n_words", "n_tokens", "max_word_tokens"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, max_word_tokens long")
