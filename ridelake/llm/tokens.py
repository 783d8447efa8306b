"""Token ids by the tokenizers library, for many texts at a time.

Encoding a piece costs microseconds and most pieces of a corpus have been seen before, so ids are remembered for
pieces between which a tokenizer never merges: runs of letters, of signs, and digits, as both tokenizers part texts; for
byte-level ones with the space before them. The bytes of many texts are parted together by their kinds, and each different piece
is looked up once for them all; new ones go to the tokenizer's model. Words with an apostrophe, which may begin a part, or with other
than printable ASCII and Latin letters stay whole and go to the tokenizer. Texts with unusual white space, on which the library and Python
might differ, and for byte-level tokenizers those where spaces meet other white space, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Where a byte-level tokenizer may join a space with what stands before it.
_RUNS = ("  ", "\n ", " \n", "\n\n\n", "\t", "\r", "\x0b", "\x0c")
_UNUSUAL = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
# Beyond these letters may be composed, or lowered to several; such texts keep their case until the tokenizer sees them.
_KEPT_CASE = r"[^\x{0}-\x{24f}]|\x{130}"
# Byte-level models spell bytes as letters: printable Latin-1 as itself, the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

# Kinds of bytes. The letters up to U+023F are whole by themselves: no normal form changes them.
_GAP, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KINDS = np.full(256, _ODD, np.uint8)
for _kind, _bytes in (
    (_GAP, [*range(9, 14), 32]),
    (_SIGN, range(33, 127)),
    (_DIGIT, range(48, 58)),
    (_LETTER, [*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xC9)]),
    (_ODD, [39]),
):
    _KINDS[list(_bytes)] = _kind
# What is one part if all its bytes are of one kind.
_SIMPLE = re.compile(" ?[!-&(-~\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u023f]+")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Pieces with their ids, which lie in ``flat`` one after the other. Some twenty bytes and the ids for each."""

    def __init__(self, dtype: np.dtype) -> None:
        self.texts = pa.array([], pa.large_string())
        self.flat, self.starts, self.sizes = np.empty(0, dtype), np.empty(0, np.int64), np.empty(0, np.int32)

    def __len__(self) -> int:
        return len(self.texts)

    def find(self, texts: pa.Array) -> np.ndarray:
        """Places of pieces, -1 for those that are not there."""
        if not len(self):
            return np.full(len(texts), -1)
        return pc.fill_null(pc.index_in(texts, value_set=self.texts), -1).to_numpy().astype(np.int64)

    def add(self, texts: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        ends = np.cumsum(sizes, dtype=np.int64) + len(self.flat)
        self.texts = pa.concat_arrays([self.texts, texts])
        self.flat = np.concatenate([self.flat, flat])
        self.starts, self.sizes = np.concatenate([self.starts, ends - sizes]), np.concatenate([self.sizes, sizes])

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``places``, one after the other, and where each one's end."""
        counts = self.sizes[places]
        ends = np.cumsum(counts, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        # By how much the places in ``flat`` are off those in the result.
        at = np.repeat((self.starts[places] - ends + counts).astype(kind), counts)
        at += np.arange(total, dtype=kind)
        return self.flat[at], ends


class Encoder:
    """``keeps_space``: whether white space is part of tokens."""

    def __init__(self, path: str, keeps_space: bool, limit: int = 600_000, together: int = 4 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space, self.limit, self.together = keeps_space, limit, together
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Pieces seen lately, and those seen before them.
        self.known, self.older = Pieces(self.dtype), Pieces(self.dtype)
        self.mark = " ".translate(_BYTE_LETTERS)
        self.model = self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = added if keeps_space else [x.lower() for x in added]

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.dtype.char, x.ids).tobytes() for x in found]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and how many each has."""
        tokenize, mark, cased, found, others = self.model.tokenize, self.mark, self.keeps_space, [], []
        for piece in pieces:
            if not _SIMPLE.fullmatch(piece) or not cased and piece != piece.lower():
                others.append(len(found))
                found.append([])
                continue
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            elif piece[0] == " ":
                piece = mark + piece[1:]
            found.append([t.id for t in tokenize(piece)])
        if others:
            for at, ids in zip(others, self._plain([pieces[at] for at in others])):
                found[at] = np.frombuffer(ids, self.dtype).tolist()
        return np.fromiter(chain.from_iterable(found), self.dtype), np.fromiter(map(len, found), np.int32, len(found))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where different pieces are in ``known``. When there are too many to remember, those not seen lately are forgotten."""
        if len(self.known) > self.limit // 2:
            self.known, self.older = Pieces(self.dtype), self.known
        places = self.known.find(pieces)
        missing = np.flatnonzero(places < 0)
        if len(missing):
            before = self.older.find(pieces.take(pa.array(missing)))
            for at, own in ((missing[before >= 0], before[before >= 0]), (missing[before < 0], None)):
                texts, first = pieces.take(pa.array(at)), len(self.known)
                self.known.add(texts, *(self._learn(texts.to_pylist()) if own is None else (self.older.ids(own)[0], self.older.sizes[own])))
                places[at] = first + np.arange(len(at))
        return places

    def _parted(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts that lie one after the other, and the number of the first piece of each text, and of the end."""
        kinds = _KINDS[data]
        # U+00D7 and U+00F7 are signs among letters, U+0130 is lowered to two.
        for lead, rest in ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0)):
            at = np.flatnonzero(data == lead)
            kinds[at[data[at + 1] == rest]] = _ODD
        first = np.zeros(len(data), bool)
        first[offsets[:-1]] = True
        begins, gap = first.copy(), kinds == _GAP
        begins[1:] |= kinds[1:] != kinds[:-1]
        # ``words``: where a word begins, or what is between words.
        words = first.copy()
        if self.keeps_space:
            space = data == 32
            words |= gap
            words[1:] |= data[:-1] == 10
            begins[1:] &= ~space[:-1]
            begins |= words
        else:
            words[1:] |= gap[1:] != gap[:-1]
            begins |= kinds == _DIGIT
        odd = np.flatnonzero(kinds == _ODD)
        if len(odd):
            heads = np.append(np.flatnonzero(words), len(data))
            for word in np.unique(np.searchsorted(heads, odd, "right") - 1).tolist():
                begins[heads[word] + 1 : heads[word + 1]] = False
        if not self.keeps_space:
            kept = ~gap
            bounds = np.searchsorted(np.flatnonzero(begins & kept), offsets)
            data, begins = data[kept], begins[kept]
        ends = np.append(np.flatnonzero(begins), len(data))
        if self.keeps_space:
            bounds = np.searchsorted(ends[:-1], offsets)
        return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data)), bounds

    def _encode_together(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
        split, bounds = self._parted(np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]], offsets)
        pieces = split.dictionary_encode()
        places = self._places(pieces.dictionary)
        every, ends = self.known.ids(places[pieces.indices.to_numpy()])
        bounds = np.append(0, ends)[bounds].tolist()
        return [every[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; texts are taken together up to about ``together`` characters."""
        group: list[str | None] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text or "") + 100
            if size >= self.together:
                yield from self._encode_group(group)
                group, size = [], 0
        if group:
            yield from self._encode_group(group)

    def _encode_group(self, group: list[str | None]) -> Iterator[np.ndarray]:
        column = pa.array([x or "" for x in group], pa.large_string())
        odd = pc.match_substring_regex(column, _UNUSUAL).to_pylist()
        plain, lowered = [], group
        if not self.keeps_space:
            # The tokenizer lowers the case too, but looks for added tokens before; text that looks like one afterwards is none.
            lowered = [x and x.lower() for x in group]
            kept = pc.match_substring_regex(column, _KEPT_CASE).to_pylist()
        for at, text in enumerate(lowered):
            if not text:
                continue
            odd[at] |= any(x in text for x in self.added)
            if self.keeps_space:
                odd[at] |= text.endswith("\n\n") or any(x in text for x in _RUNS)
            if not odd[at]:
                plain.append(group[at] if not self.keeps_space and kept[at] else text)
        together = iter(self._encode_together(pa.array(plain, pa.large_string())))
        for text, whole in zip(group, odd):
            if not text:
                yield np.empty(0, self.dtype)
            elif whole:
                yield np.frombuffer(self._plain([text])[0], self.dtype)
            else:
                yield next(together)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text]))


@cache
def encoder(path: str, keeps_space: bool) -> Encoder:
    """One encoder in each worker process, which later tasks find warm."""
    return Encoder(path, keeps_space)
