"""Token counts by a unigram model, with dynamic programming shared in a trie.

The pieces of a public vocabulary are scored as a unigram model by Zipf's law
on their rank, log(1 / (rank + 1)); a character no piece has costs its UTF-8
bytes, each scored FALLBACK.  A text's pre-tokens are its words, each led by
the vocabulary's word mark.  A task inserts the distinct pre-tokens of a chunk in
a trie, kept in arrays: a node is a prefix, and its forward score, the best score
of any way to cut the prefix into pieces and the fewest pieces among the best, is
computed once, when the node is made, from those of the nodes above it, for all
pre-tokens that share it.  The node where a pre-token ends stores its count.  A
trie that has NODES nodes is done with and the next pre-tokens go to a new one:
some prefixes are then computed again, with the same scores.

A document's count is the sum over its words.  Nothing is shuffled; counts are
remembered by word, within a bound of bytes, in a task.

Defined cases: a null or empty text has no tokens; repeated rows give equal
rows; a null doc_id stays null; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, byte_chunks, id_text

MARK = "▁"
FALLBACK = -20.0
#: Nodes of a trie at most, and the rest of the last pre-token (24 bytes each).
NODES = 1 << 20
SCHEMA = "doc_id long, n_words long, n_tokens long"

_MODELS: dict[str, Unigram] = {}


class Unigram:
    """Best segmentations under piece scores."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        # By last character: the lengths of the pieces that end with it, so few are tried.
        self.lengths: dict[str, list[int]] = {}
        for piece in scores:
            self.lengths.setdefault(piece[-1], []).append(len(piece))
        self.lengths = {c: sorted(set(n)) for c, n in self.lengths.items()}

    @classmethod
    def from_sentencepiece(cls, path: str) -> Unigram:
        """The normal pieces of a model file, scored by rank; one model for all tasks of a Python worker."""
        if path not in _MODELS:
            from sentencepiece import SentencePieceProcessor

            sp = SentencePieceProcessor(model_file=path)
            normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
            _MODELS[path] = cls({sp.id_to_piece(i): -float(np.log(rank + 1)) for rank, i in enumerate(normal, 1)})
        return _MODELS[path]

    def counts(self, words: Iterable[str], nodes: int = NODES) -> dict[str, int]:
        """Tokens of each distinct word, by tries of about ``nodes`` nodes at most."""
        out, trie = {}, Trie(self)
        for word in sorted(words):
            if len(trie) >= nodes:
                trie = Trie(self)
            out[word] = trie.ends[trie.insert(word)]
        return out


class Trie:
    """Words in sorted order, led by the mark, as a trie with forward scores.

    Node 0 is the empty prefix; a node comes after its parent.  As words come in
    order, the node of a shared prefix is on the path of the word before."""

    def __init__(self, model: Unigram):
        self.model = model
        self.parent, self.label = array("i", [-1]), array("I", [0])
        self.score, self.pieces = array("d", [0.0]), array("i", [0])
        self.ends = array("i", [0])  # tokens of the word that ends at a node, 0 for none
        self._path, self._nodes = "", [0]

    def __len__(self) -> int:
        return len(self.parent)

    def insert(self, word: str) -> int:
        """The node where the word ends."""
        path, before, nodes = MARK + word, self._path, self._nodes
        if path < before:
            raise ValueError("words must come in order")
        shared = 0
        for a, b in zip(before, path):
            if a != b:
                break
            shared += 1
        del nodes[shared + 1 :]
        for end in range(shared + 1, len(path) + 1):
            score, pieces = self._forward(path, end)
            self.parent.append(nodes[-1])
            self.label.append(ord(path[end - 1]))
            self.score.append(score)
            self.pieces.append(pieces)
            self.ends.append(0)
            nodes.append(len(self.parent) - 1)
        self.ends[nodes[-1]] = self.pieces[nodes[-1]]
        self._path = path
        return nodes[-1]

    def _forward(self, path: str, end: int) -> tuple[float, int]:
        """Best score of a prefix and its fewest pieces, from the nodes above."""
        char, nodes, scores = path[end - 1], self._nodes, self.model.scores
        size, above = len(char.encode()), nodes[end - 1]
        best, fewest = self.score[above] + FALLBACK * size, self.pieces[above] + size
        for n in self.model.lengths.get(char, ()):
            if n > end:
                break
            own = scores.get(path[end - n : end])
            if own is not None:
                above = nodes[end - n]
                score, pieces = self.score[above] + own, self.pieces[above] + 1
                if score > best or score == best and pieces < fewest:
                    best, fewest = score, pieces
        return best, fewest

    def terminals(self) -> Iterator[tuple[str, int]]:
        """The words and the counts stored where they end."""
        prefix = [""]  # of the node at hand, by depth
        depth = array("i", [0])
        for node in range(1, len(self.parent)):
            d = depth[self.parent[node]] + 1
            depth.append(d)
            del prefix[d:]
            prefix.append(chr(self.label[node]))
            if self.ends[node]:
                yield "".join(prefix[2:]), self.ends[node]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens of every whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = Unigram.from_sentencepiece(model_path), Memo()
        for ids, texts in byte_chunks(batches):
            words = [t.decode().split() for t in texts]
            memo.trim()
            memo.update(model.counts(list(set().union(*words) - memo.keys())))
            tokens = [sum(map(memo.__getitem__, ws)) for ws in words]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(map(len, words), pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return id_text(docs, id_col, text_col).mapInArrow(rows, SCHEMA)
