"""Texts to token ids with the ``tokenizers`` library, distinct words encoded once.

For a tokenizer that drops white space and never merges across it, the ids of a text are
the ids of its words in a row.  Words repeat far more than texts do, so a task keeps the
ids of the words it has met.  Other tokenizers encode whole texts.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from postlens.llm.batches import split_words

# Stems kept per task, some 200 bytes each; beyond it the store starts anew.
MAX_WORDS = 250_000

# Punctuation that is a token of its own behind a letter or digit.
_TAIL = ".,!?;:#$%&*"


# Bytes that are a letter or digit of ASCII.
_ASCII_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])


def _last_bytes(texts: pa.Array) -> np.ndarray:
    """The last byte of each large string, 0 for an empty one."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    out = np.zeros(len(texts), dtype=np.uint8)
    filled = np.diff(offsets) > 0
    out[filled] = data[offsets[1:][filled] - 1]
    return out


class Encoder:
    """``encode`` gives the ids of texts, as the tokenizer gives them without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        probe = ["Ab,", "cD", "e.f!"]
        self.by_words = self._whole(" \n".join(probe)) == [i for w in probe for i in self._whole(w)]
        self.lowers = self._whole("AbCd") == self._whole("abcd")
        words = ["a", "zq", "thereof", "unfathomableness"]
        self.plain = all([t.id for t in self.tokenizer.model.tokenize(w)] == self._whole(w) for w in words)
        # Tokens that end a word, by the mark that the model's vocabulary has for it.
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.is_end = np.zeros(self.vocabulary, dtype=bool)
        if mark:
            self.is_end[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(mark)]] = True
        self._clear()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self):
        self.known = {"": 0}  # stem or punctuation: its entry
        self.ids, self.ends = array("I"), array("q", [0, 0])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: row ``i`` has ``ids[offsets[i]:offsets[i + 1]]``."""
        if not self.by_words:
            rows = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            flat = np.fromiter((i for r in rows for i in r), dtype=np.uint32, count=sum(map(len, rows)))
            return flat, np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int64)
        codes, words, offsets = split_words(texts)
        if len(self.known) > MAX_WORDS:
            self._clear()
        heads, tails = self._entries(words)
        entries = np.empty(2 * len(codes), dtype=np.int64)
        entries[0::2], entries[1::2] = heads[codes], tails[codes]
        ends = np.frombuffer(self.ends, dtype=np.int64)
        lengths = (ends[1:] - ends[:-1])[entries]
        stop = np.cumsum(lengths)
        at = np.repeat(ends[:-1][entries] - stop + lengths, lengths) + np.arange(stop[-1] if len(stop) else 0)
        ids = np.frombuffer(self.ids, dtype=np.uint32)[at] if len(at) else np.empty(0, np.uint32)
        return ids, np.concatenate([[0], stop])[2 * offsets]

    def _entries(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per word, the entries of its stem and of the punctuation behind it.

        Trims and tests are Arrow masks over all words; only distinct stems are looked up one by one.
        """
        words = words.cast(pa.large_string())
        stems = pc.utf8_rtrim(words, _TAIL)
        if self.lowers:  # one entry for all cases of A-Z
            stems = pc.ascii_lower(stems)
        size, own = (np.asarray(pc.binary_length(x), dtype=np.int64) for x in (words, stems))
        last = _last_bytes(stems)
        cut = (own < size) & (own > 0)
        joins = cut & ~_ASCII_ALNUM[last]
        # Ends beyond ASCII are judged one by one.
        for at in np.flatnonzero(joins & (last >= 128)):
            joins[at] = not self._ends_alnum(stems[int(at)].as_py())
        # The mark of a special token stays as it is.
        whole = (own == 0) | joins | np.asarray(pc.match_substring(words, "<|"))
        stems = pc.if_else(pa.array(whole), words, stems)
        heads = self._known(stems)
        cut &= ~whole
        tails = np.zeros(len(words), dtype=np.int64)
        if cut.any():
            rest = (size - own)[cut]  # punctuation is ASCII
            kept = [w[-n:] for w, n in zip(words.filter(pa.array(cut)).to_pylist(), rest.tolist(), strict=True)]
            tails[cut] = self._known(pa.array(kept, pa.large_string()))
        return heads, tails

    def _known(self, texts: pa.Array) -> np.ndarray:
        """The entries of stems or punctuation; new ones are encoded."""
        coded = texts.dictionary_encode()
        names, known = coded.dictionary.to_pylist(), self.known
        self._learn(w for w in names if w not in known)
        return np.fromiter(map(known.__getitem__, names), np.int64, len(names))[np.asarray(coded.indices, dtype=np.int64)]

    def _ends_alnum(self, stem: str) -> bool:
        """Whether a stem ends in a letter or digit, also after the tokenizer's normalizer, which may leave a mark there."""
        if not stem[-1].isascii() and self.tokenizer.normalizer is not None:
            stem = self.tokenizer.normalizer.normalize_str(stem)
        return stem[-1:].isalnum()

    def _learn(self, words) -> None:
        words = list(words)
        for lo in range(0, len(words), 10_000):
            part = words[lo : lo + 10_000]
            for word, own in zip(part, self._ids(part), strict=True):
                self.known[word] = len(self.ends) - 1
                self.ids.extend(own)
                self.ends.append(len(self.ids))

    def _ids(self, words: list[str]) -> list[list[int]]:
        """The ids of each word."""
        out: list = [None] * len(words)
        joined, rest = [], []
        for i, word in enumerate(words):
            if self.plain and word.isascii() and word.isalpha() and (word.islower() or not self.lowers):
                out[i] = [t.id for t in self.tokenizer.model.tokenize(word)]
            elif word.isalpha():
                joined.append(i)
            else:
                rest.append(i)
        for lo in range(0, len(joined), 1000):
            part = joined[lo : lo + 1000]
            ids = np.array(self._whole(" ".join(words[i] for i in part)), dtype=np.int64)
            stops = np.flatnonzero(self.is_end[ids]) + 1
            if len(stops) != len(part):  # not one piece per word
                rest += part
                continue
            for i, own in zip(part, np.split(ids, stops[:-1]), strict=True):
                out[i] = own.tolist()
        encoded = self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, encoded, strict=True):
            out[i] = e.ids
        return out
