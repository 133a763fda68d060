"""Token ids of whole texts by a published word-end BPE tokenizer file, with a bounded memory of words.

The tokenizer splits at white space before anything else, so the ids of a text are those of its words in order. A lot of
texts is split into words at once, and each different word is looked up once: words that a task has seen come from
memory, the pieces of new ones are encoded in one call for many words. What decides the ids is always the tokenizer
itself: pieces are only cut beforehand where its own pre-tokenizer cuts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_REMEMBERED = 400_000
# The pre-tokenizer's own pattern, for lower-case Latin-1 text (fixed value: its letters and numbers spelled out). Words
# are matched as lines of one text, and the ends of lines are matched too.
_LATIN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+|\n"
)
_CALL = 200  # pieces that are encoded as one text
_LOT = 1 << 14  # new words or pieces at a time of which Python or the tokenizer has objects
_GROUP = 1 << 23  # bytes of text that are split together


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the other
    bytes are numbered from 256."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in itself]
    return {b: chr(b) for b in itself} | {b: chr(256 + k) for k, b in enumerate(others)}


def _offsets(array: pa.LargeStringArray | pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]


def _joined(codes: pa.LargeBinaryArray, bounds: np.ndarray) -> pa.LargeBinaryArray:
    """The codes between each bound and the next as one."""
    cuts = pa.py_buffer(_offsets(codes)[bounds])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, cuts, codes.buffers()[2]])


def _lines(strings: pa.LargeStringArray, between: str) -> str:
    listed = pa.ListArray.from_arrays([0, len(strings)], strings)
    return pc.binary_join(listed, pa.scalar(between, pa.large_string()))[0].as_py()


class _Memory:
    """Codes of strings, learned once each. When there are more than _REMEMBERED, only those of the last call stay."""

    def __init__(self, learn: Callable[[pa.LargeStringArray], pa.LargeBinaryArray]):
        self._learn = learn
        self._known, self._codes = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def codes(self, strings: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The code of each string, in order."""
        coded = strings.dictionary_encode()
        different, known = coded.dictionary, self._known
        places = pc.index_in(different, value_set=known)
        new = different.filter(places.is_null())
        learned = pa.concat_arrays([self._codes, self._learn(new)]) if len(new) else self._codes
        at = places.fill_null(-1).to_numpy().copy()
        at[at < 0] = np.arange(len(known), len(known) + len(new))
        codes = learned.take(pa.array(at))
        if len(learned) <= _REMEMBERED:
            self._known, self._codes = pa.concat_arrays([known, new]), learned
        else:
            self._known, self._codes = different[:_REMEMBERED], codes[:_REMEMBERED]
        return codes.take(coded.indices)


class WordTokenizer:
    """encoded(texts) gives each text's ids as bytes, four a token, little-endian."""

    _by_path: dict[str, WordTokenizer] = {}

    @classmethod
    def at(cls, path: str) -> WordTokenizer:
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # The same model behind a plain split at blanks, for pieces that are normalised and cut already.
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._letters = np.arange(256, dtype="<u4")
        for byte, letter in _byte_letters().items():
            self._letters[byte] = ord(letter)
        self._letters[ord(" ")] = ord(" ")  # between pieces; no piece has one
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._words, self._pieces = _Memory(self._word_codes), _Memory(self._piece_codes)

    def encoded(self, texts: pa.Array) -> Iterator[bytes]:
        sizes = pc.binary_length(texts).fill_null(0).to_numpy()
        first, size = 0, 0
        for at, more in enumerate(sizes.tolist(), 1):
            size += more
            if size > _GROUP or at == len(texts):
                group = texts[first:at].cast(pa.large_string()).fill_null("")
                split = pc.ascii_split_whitespace(group)
                ids = _joined(self._words.codes(split.flatten()), split.offsets.to_numpy())
                del group, split
                yield from ids.to_pylist()
                del ids
                # Between tasks a worker waits, and would keep what its arrays took.
                pa.default_memory_pool().release_unused()
                first, size = at, 0

    def _word_codes(self, words: pa.LargeStringArray) -> pa.LargeBinaryArray:
        starts = _offsets(words)
        data = np.frombuffer(words.buffers()[2], np.uint8)[: starts[-1]]
        other = np.zeros(len(words), bool)
        # Characters beyond Latin-1 begin with a byte of C4 or more.
        other[np.searchsorted(starts, np.flatnonzero(data >= 0xC4), "right") - 1] = True
        latin = words.filter(pa.array(~other))
        lots = [_lines(latin[k : k + _LOT], "\n").lower() + "\n" for k in range(0, len(latin), _LOT)]
        found = [pa.array(_LATIN.findall(lot), pa.large_string()) for lot in lots]
        pieces = pa.concat_arrays(found) if found else pa.array([], pa.large_string())
        end = pc.equal(pieces, "\n")
        ends = np.flatnonzero(end.to_numpy(False))
        codes = _joined(self._pieces.codes(pieces.filter(pc.invert(end))), np.append(0, ends - np.arange(len(ends))))
        texts = words.filter(pa.array(other)).to_pylist()
        encoded = self._tokenizer.encode_batch(texts, add_special_tokens=False) if texts else []
        rest = pa.array([np.array(code.ids, "<u4").tobytes() for code in encoded], pa.large_binary())
        places = np.where(other, len(codes) + np.cumsum(other), np.cumsum(~other)) - 1
        return pa.concat_arrays([codes, rest]).take(pa.array(places))

    def _piece_codes(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        lots = []
        for start in range(0, len(pieces), _LOT):
            lot = pieces[start : start + _LOT]
            calls = [self._lettered(_lines(lot[k : k + _CALL], " ")) for k in range(0, len(lot), _CALL)]
            codes = self._model.encode_batch_fast(calls, add_special_tokens=False)
            lots.append(np.array([i for code in codes for i in code.ids], "<u4"))
        ids = np.concatenate(lots) if lots else np.zeros(0, "<u4")
        # Each piece ends with a token that ends a word, so the ids of all fall apart again.
        cuts = np.append(0, np.flatnonzero(self._ends[ids]) + 1)
        if len(cuts) != len(pieces) + 1:
            raise ValueError("the tokenizer cuts words elsewhere than expected")
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(pieces), [None, pa.py_buffer(4 * cuts), pa.py_buffer(ids)]
        )

    def _lettered(self, pieces: str) -> str:
        return self._letters[np.frombuffer(pieces.encode(), np.uint8)].tobytes().decode("utf-32-le")
