"""Token ids of texts by a public tokenizer file, inside Spark tasks."""

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Letters, then signs that the tokenizer splits off: the two parts have their own
# ids. Apostrophes and the signs of special tokens are left out.
_TAIL = re.compile(r"([^\W\d_]+)([!-&(-/:;=?@\[-`{}~]+)")
# Separators for Python's split() that are no white space to the tokenizers.
_ODD = "\x1c\x1d\x1e\x1f"


def _byte_signs() -> dict[int, str]:
    """The sign that a byte-level vocabulary writes for each byte: itself where
    it is visible in Latin-1, else the next one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SIGNS = _byte_signs()


def _plain(word: str) -> bool:
    """Whether a word is Latin letters that normalising only lower-cases."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and word.lower().isalpha()))


class _Words(dict):
    """Ids of words as bytes, each found when it is first asked for; those of up to 64
    characters are remembered."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if _plain(word):
            made = self._model(word)
        elif (m := _TAIL.fullmatch(word)) and _plain(m[1]):
            made = self[m[1]] + self[m[2]]
        else:
            made = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()
        if len(word) <= 64:
            self[word] = made
        return made

    def _model(self, word: str) -> bytes:
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_SIGNS)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()


class Encoder:
    """``tokenizers`` without special tokens added.

    ``by_word`` is for byte-level tokenizers that lower-case, split at white space
    and drop it, and keep runs of letters whole (as ``word_bpe_49k.json`` does): a
    text's ids are then its words' ids one after the other. Only words that this
    worker has not met are encoded, and words of plain letters go straight to the
    tokenizer's model. About ``most_words`` words of up to 64 characters are
    remembered, then all are forgotten.
    """

    def __init__(self, path: str, by_word: bool, most_words: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        self.most_words = most_words
        self.known = _Words(self.tokenizer)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers."""
        if not self.by_word:
            return [np.frombuffer(b, np.uint32) for b in self._encode(texts)]
        out = []
        for text in texts:
            if any(c in text for c in _ODD):
                out.append(np.frombuffer(self._encode([text])[0], np.uint32))
                continue
            if len(self.known) > self.most_words:
                self.known.clear()
            out.append(np.frombuffer(b"".join(map(self.known.__getitem__, text.split())), np.uint32))
        return out

    def learned(self, texts: list[str], spans: list[list[tuple[int, int]]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text, and for each id whether it holds a character of the
        text's spans (code points, ends exclusive)."""
        out = []
        for e, text, own in zip(self.tokenizer.encode_batch(texts, add_special_tokens=False), texts, spans, strict=True):
            inside = np.zeros(len(text), np.int64)
            for a, b in own:
                inside[max(a, 0) : max(b, 0)] = 1
            before = np.concatenate(([0], np.cumsum(inside)))
            place = np.array(e.offsets, np.int64).reshape(-1, 2)
            out.append((np.array(e.ids, np.uint32), before[place[:, 1]] > before[place[:, 0]]))
        return out


@lru_cache(maxsize=4)
def encoder(path: str, by_word: bool) -> Encoder:
    """One encoder for each worker process and tokenizer."""
    return Encoder(path, by_word)


def texts_of(column: pa.Array, start: int, n: int) -> list[str]:
    """Some rows' texts; null is empty."""
    return [t or "" for t in column.slice(start, n).to_pylist()]
