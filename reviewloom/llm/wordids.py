"""Token ids of words, each distinct word encoded once per Python worker.

Both public vocabularies part a text at its spaces first, so the ids of a text are the
ids of its words in a row. A bounded memory of words makes the cost that of the distinct
words, not of all of them.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from reviewloom.llm.common import hash_spans

LIMIT = 2_000_000  # words remembered per worker; beyond it the memory starts anew

_memories: dict[str, "WordIds"] = {}


class WordIds:
    """Maps words, known by a 64-bit hash, to rows of one flat array of ids.

    ``encode`` gives the ids of new words: one flat array, and the number of ids of each.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = LIMIT):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.known, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.at = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        """Remember new words; ``keys`` are sorted."""
        flat, sizes = self.encode(words)
        first, n = len(self.known), len(self.known) + len(keys)
        low = self.at[first]
        high = low + len(flat)
        while len(self.ids) < high:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.at) <= n:
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.ids[low:high] = flat
        self.at[first + 1 : n + 1] = low + np.cumsum(sizes)
        place = np.searchsorted(self.known, keys)
        self.known = np.insert(self.known, place, keys)
        self.rows = np.insert(self.rows, place, np.arange(first, n))

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.known, keys), max(len(self.known) - 1, 0))
        found = self.known[place] == keys if len(self.known) else np.zeros(len(keys), bool)
        return place, found

    def lookup(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words (byte spans of ``data``) in a row, and the number of ids of each word."""
        if len(self.known) > self.limit:
            self._clear()
        keys, sample, back = np.unique(hashes, return_index=True, return_inverse=True)
        place, found = self._find(keys)
        if not found.all():
            new = np.flatnonzero(~found)
            text = data.tobytes()
            spans = zip(starts[sample[new]].tolist(), ends[sample[new]].tolist())
            self._add(keys[new], [text[a:b].decode() for a, b in spans])
            place, _ = self._find(keys)
        rows = self.rows[place][back] if len(keys) else np.zeros(0, np.int32)
        low, sizes = self.at[rows], self.at[rows + 1] - self.at[rows]
        stops = np.cumsum(sizes)
        take = np.arange(stops[-1] if len(stops) else 0) + np.repeat(low - (stops - sizes), sizes)
        return self.ids[take], sizes


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter((i for row in rows for i in row), np.int32, int(sizes.sum())), sizes


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_with_bytes(path: str) -> tuple[WordIds, np.ndarray]:
    """Word ids of a sentence-piece vocabulary, and which of its ids stand for a byte."""
    import sentencepiece

    if path not in _memories:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        memory = WordIds(lambda words: _flat(model.encode(words, num_threads=1)))
        memory.is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])
        _memories[path] = memory
    return _memories[path], _memories[path].is_byte


# The letters by which byte-level vocabularies write bytes: printable ones as themselves,
# the others in order from U+0100.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = dict(zip([b for b in range(256) if b not in _PRINTABLE], map(chr, range(256, 324))))
_BYTE_LETTERS |= {b: chr(b) for b in _PRINTABLE}


def _plain(word: str) -> tuple[str, str] | None:
    """A word of Latin-1 letters and the ASCII marks behind it: both parts encode alone."""
    core = word.rstrip(".,;:!?")
    if core.isalpha() and max(core) < "Ā":
        return core.lower(), word[len(core) :]
    return None


def word_pairs(path: str) -> WordIds:
    """Word ids of a byte-pair vocabulary of the ``tokenizers`` library, without special tokens.

    Its splitter parts letters from marks, so a plain word is encoded as its lower-case
    letters and the marks behind them, each once; letters alone go to the library's model
    without its splitter.
    """
    if path not in _memories:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        pairs = library.model.tokenize

        def direct(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            rows = []
            for part in parts:
                if _plain(part) == (part, ""):
                    written = part if part.isascii() else "".join(map(_BYTE_LETTERS.__getitem__, part.encode()))
                    rows.append([t.id for t in pairs(written)])
                else:
                    rows.append(library.encode(part, add_special_tokens=False).ids)
            return _flat(rows)

        memory = WordIds(direct)

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            split = [_plain(w) or (w, "") for w in words]
            parts = [p.encode() for pair in split for p in pair if p]
            each = np.fromiter((1 + bool(marks) for _, marks in split), np.int64, len(split))
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            data = np.frombuffer(b"".join(parts), np.uint8)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            flat, sizes = memory.lookup(data, starts, ends, hash_spans(data, starts, ends))
            return flat, np.add.reduceat(sizes, np.cumsum(each) - each)

        _memories[path] = WordIds(encode)
    return _memories[path]
