"""Token ids of whole texts by the tokenizers library, a batch at a time in arrays.

Both vocabularies cut a text into pieces that never reach across a single space or line end between two
characters that are not white space, so a text may be cut before each of them and its stretches encoded alone.
Arrow counts a batch's distinct stretches; only those are looked up or given to the library, many in one
call, and numpy gathers their ids by stretch.

The word vocabulary takes a piece for itself wherever a letter of ASCII meets another sign of it, knows neither
line ends from spaces nor capitals, and marks the last id of each piece. So its stretches are folded and end before
such signs, most of them are known, and the ids of new ones are told apart by their number of pieces.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

END_ID = 1
MEMO_WORDS = 1_000_000
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
_SPACE = re.compile(r"\s")
#: Stands between words that a vocabulary without white space encodes together; no special token, which would cost more.
_MARK = "\0"
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True
#: What a byte is in the pieces of the word vocabulary.
_SPACES, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[10, 32]] = _SPACES
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[39, 60]] = _ODD  # ' stands with letters in one piece, < may begin a special token
#: Signs that end a stretch after a letter; within a special token | is one.
_ENDS_LETTERS = (_KIND == _SIGN) | (_KIND == _DIGIT)
_ENDS_LETTERS[60], _ENDS_LETTERS[124] = True, False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[10] = 32


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to a white space character."""
    space = _ASCII_SPACE[data]
    two = np.flatnonzero(data[:-1] == 0xC2)
    two = two[(data[two + 1] == 0x85) | (data[two + 1] == 0xA0)]
    space[two] = space[two + 1] = True
    three = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))
    if len(three):
        code = (data[three].astype(np.int32) & 15) << 12 | (data[three + 1].astype(np.int32) & 63) << 6 | data[three + 2] & 63
        three = three[(code == 0x1680) | ((code >= 0x2000) & (code <= 0x200A)) | np.isin(code, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
        space[three] = space[three + 1] = space[three + 2] = True
    return space


class Encoder:
    """``ids(texts)`` gives each text's ids, those of ``encode(text, add_special_tokens=False)``.

    ``keeps_space``: a space belongs to the piece that follows it (byte-level vocabularies); otherwise
    white space is dropped.
    """

    def __init__(self, path: str, keeps_space: bool, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # words are remembered here
        self.keeps_space, self.memo_words = keeps_space, memo_words
        self.between = "\n" if keeps_space else f" {_MARK} "
        (self.cut_id,) = self.encode(self.between)
        self.line_end = self.encode("\n").tobytes()
        self.memo: dict[bytes, bytes] = {}
        suffix = None if keeps_space else self.tokenizer.model.end_of_word_suffix
        self.last_of_piece = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.last_of_piece[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.by_pieces = bool(suffix) and np.array_equal(self.encode("Ab\nc."), self.encode("ab c ."))

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def stretches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Borders of stretches in the joined texts: those of the texts, and before each space or line end that is safe.

        A vocabulary that drops white space can be cut at every one, one of pieces between a letter and a sign as well.
        """
        cut = np.append((data == 32) | (data == 10), False)
        if self.by_pieces:
            cut[1:-1] |= (_KIND == _LETTER)[data[:-1]] & _ENDS_LETTERS[data[1:]]
        if self.keeps_space and len(data):
            space = white_space(data)
            cut[1:-1] &= ~space[:-1]
            cut[:-2] &= ~space[1:]
        cut[offsets] = True
        return np.flatnonzero(cut)

    def learn_pieces(self, stretches: list[bytes]) -> list[bytes]:
        """Encode new stretches of plain ASCII, many in one call, and cut their ids by their pieces; the others are left."""
        left, at_once = [], 2000
        for i in range(0, len(stretches), at_once):
            some = stretches[i : i + at_once]
            joined = b" ".join(some)
            kind = _KIND[np.frombuffer(joined + b" ", np.uint8)]
            sizes = np.fromiter(map(len, some), np.int64, len(some)) + 1
            starts = np.cumsum(sizes) - sizes
            odd = np.add.reduceat(kind == _ODD, starts, dtype=np.int64) > 0
            if odd.any():
                left += [s for s, x in zip(some, odd.tolist(), strict=True) if x]
                some = [s for s, x in zip(some, odd.tolist(), strict=True) if not x]
                joined, kind = b" ".join(some), kind[np.repeat(~odd, sizes)]
                sizes = sizes[~odd]
                starts = np.cumsum(sizes) - sizes
            if not some:
                continue
            new = (kind != _SPACES) & (np.append(True, kind[1:] != kind[:-1]) | (kind == _DIGIT))
            last = np.cumsum(np.add.reduceat(new, starts, dtype=np.int64))
            ids = self.encode(joined.decode())
            ends = np.append(0, np.flatnonzero(self.last_of_piece[ids]) + 1)
            if len(ends) != last[-1] + 1 or ends[-1] != len(ids):
                left += some
                continue
            raw, cuts = ids.tobytes(), (4 * ends[np.append(0, last)]).tolist()
            self.memo.update((s, raw[a:b]) for s, a, b in zip(some, cuts[:-1], cuts[1:], strict=True))
        return left

    def learn(self, stretches: list[bytes]) -> None:
        """Encode new stretches, many in one call with a mark between them; odd ones alone."""
        if self.by_pieces:
            stretches = self.learn_pieces(stretches)
        joined, bodies = [], []
        for s in stretches:
            text = s.decode()
            line_end = self.keeps_space and text[0] == "\n"
            odd = self.keeps_space and (_SPACE.search(text, 1) or (text[0] not in " \n" and text[0].isspace()) or len(text) == 1 and text.isspace())
            if odd or _MARK in text:
                self.memo[s] = self.encode(text).tobytes()
            else:
                joined.append((s, self.line_end if line_end else b""))
                bodies.append(text[1:] if line_end else text)
        at_once = 2000
        for i in range(0, len(joined), at_once):
            ids = self.encode(self.between.join(bodies[i : i + at_once]))
            cut = np.flatnonzero(ids == self.cut_id)
            some, raw = joined[i : i + at_once], ids.tobytes()
            if len(cut) != len(some) - 1:
                raise ValueError("the mark between words was merged or taken from a word")
            for (s, before), a, b in zip(some, [0, *(4 * (cut + 1)).tolist()], [*(4 * cut).tolist(), len(raw)], strict=True):
                self.memo[s] = before + raw[a:b]

    def ids(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without an end id."""
        texts = (pa.array(texts, pa.string()) if isinstance(texts, list) else texts).cast(pa.large_string())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if offsets[-1] > offsets[0] else pa.py_buffer(b"")
        offsets = offsets - offsets[0]
        if self.by_pieces and b"<|" not in raw.to_pybytes():  # folding could make a special token
            raw = pa.py_buffer(_FOLD[np.frombuffer(raw, np.uint8)])
        bounds = self.stretches(np.frombuffer(raw, np.uint8), offsets)
        found = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), raw]).dictionary_encode()
        if len(self.memo) > self.memo_words:
            self.memo = {}
        known = found.dictionary.to_pylist()
        self.learn([s for s in known if s not in self.memo])
        each = [self.memo[s] for s in known]
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat, which = np.frombuffer(b"".join(each), np.uint32), found.indices.to_numpy()
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        begin = (np.cumsum(sizes) - sizes)[which] - (ends - lengths)
        out = flat[np.repeat(begin, lengths) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        cut = (4 * np.append(0, ends)[np.searchsorted(bounds, offsets)]).tolist()
        return [out[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keeps_space)
    return _ENCODERS[key]
