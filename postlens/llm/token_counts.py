"""Token counts under a unigram vocabulary, by dynamic programming over a trie of words.

The distinct pre-tokens (words) of a batch in ascending order are the depth-first walk of
their trie, so only the path from the root to the current node is held.  A node is a
prefix; its forward score is the best sum of piece scores that spells the prefix, computed
once however many words share it.  The number of tokens on the best way is stored at the
terminal nodes, and a document's count is the sum over its words.

Ties between ways go to fewer tokens.  A character that no piece covers becomes one token a
byte, each with the score ``UNKNOWN`` below the worst piece.

Defined results: null text is empty text with no words; repeated rows count each; a null id
is kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import bounded, slices, split_words

# What stands for the white space before a word.
MARK = "▁"

# A byte of an uncovered character scores so much less than the worst piece.
UNKNOWN = 10.0

# Words whose counts a task keeps; beyond it the store starts anew.
MAX_WORDS = 1_000_000


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a SentencePiece model with log scores by Zipf's law on their rank.

    The model's own scores order the pieces; the log score of the piece of rank ``r`` is
    ``-ln(r + 2.7)`` minus the log of the sum over all, a distribution over the pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranked = sorted(usable, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (r + 2.7) for r in range(len(ranked))))
    return {model.id_to_piece(i): -math.log(r + 2.7) - total for r, i in enumerate(ranked)}


class Counter:
    """Counts tokens of words.  ``nodes`` says how many trie nodes were scored."""

    def __init__(self, pieces: Mapping[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.counts: dict[str, int] = {}
        self.nodes = 0

    def learn(self, words: list[str]) -> None:
        """Stores the counts of distinct words."""
        score, tokens = [0.0], [0]  # along the path to the current node
        path, get, longest, unknown, counts = "", self.pieces.get, self.longest, self.unknown, self.counts
        for word in sorted(words):
            text = MARK + word
            shared, most = 0, min(len(path), len(text))
            while shared < most and path[shared] == text[shared]:
                shared += 1
            del score[shared + 1 :], tokens[shared + 1 :]
            for at in range(shared + 1, len(text) + 1):
                width = len(text[at - 1].encode("utf-8", "surrogatepass"))
                best, count = score[at - 1] + width * unknown, tokens[at - 1] + width
                for begin in range(max(0, at - longest), at):
                    own = get(text[begin:at])
                    if own is not None:
                        own += score[begin]
                        if own > best or (own == best and tokens[begin] + 1 < count):
                            best, count = own, tokens[begin] + 1
                score.append(best)
                tokens.append(count)
            self.nodes += len(text) - shared
            path = text
            counts[word] = tokens[-1]

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of each text."""
        codes, words, offsets = split_words(texts)
        names = words.to_pylist()
        if len(self.counts) + len(names) > MAX_WORDS:
            self.counts = {}
        self.learn([w for w in names if w not in self.counts])
        own = np.fromiter(map(self.counts.__getitem__, names), np.int64, len(names))
        total = np.concatenate([[0], np.cumsum(own[codes])])
        return np.diff(offsets), total[offsets[1:]] - total[offsets[:-1]]


def count_tokens(docs: DataFrame, pieces: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_tokens)`` per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(pieces))
    source = bounded(docs).select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("v"))
    key = source.schema["k"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for part in slices(batch):
                words, tokens = counter.count(part.column("v"))
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(words), pa.array(tokens)], ["k", "n_words", "n_tokens"])

    return source.mapInArrow(work, f"k {key}, n_words long, n_tokens long").withColumnRenamed("k", id_col)
