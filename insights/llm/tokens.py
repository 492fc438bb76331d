"""Token ids of whole texts, worked out inside tasks with the tokenizers library.

A text is cut where no token can cross (beside single spaces and line ends), and the
ids of a piece are kept in the worker for the next time it comes up: natural text
repeats its words.  Arrow cuts a slice of texts, numbers its distinct pieces and parts
them into letters and the signs behind; only distinct words are looked up, and Arrow
puts the texts' ids together again by number.  What a piece's ids are is always the
tokenizer's own answer for it, so the result equals encoding the whole text at once; a
text with white space that the cuts don't cover is encoded at once.  New words go to
the tokenizer in runs of ``JOINED``, a space between them, and the tokens that begin
(or end) a word tell their ids apart.  Memory is bounded: a table holds ``KEPT_WORDS``
in two generations, the older of which goes when the newer is full, so words in use stay.
"""

from __future__ import annotations

import os
import string
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
KEPT_WORDS = 600_000
JOINED = 64
ID = np.dtype("<u2")  # both vocabularies have fewer than 65,536 ids
_ENDINGS = string.punctuation.replace("'", "")  # signs of one class; an apostrophe can begin a token with letters

_encoders: dict[str, Encoder] = {}


class Kept:
    """Ids by word, worked out by ``ids_of`` for the words not met before."""

    def __init__(self, ids_of: Callable[[list[str]], list[bytes]]):
        self.ids_of = ids_of
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, words: list[str]) -> list[bytes]:
        if len(self.newer) > KEPT_WORDS // 2:
            self.older, self.newer = self.newer, {}
        newer, older = self.newer, self.older
        out = list(map(newer.get, words))
        if missing := [i for i, x in enumerate(out) if x is None]:
            fresh = {}
            for i in missing:
                w = words[i]
                if (x := older.get(w)) is None:
                    fresh[w] = None
                else:
                    newer[w] = x
            newer.update(zip(fresh, self.ids_of(list(fresh)), strict=True))
            for i in missing:
                out[i] = newer[words[i]]
        return out


class Encoder:
    """``byte_level``: spaces belong to the word behind them; else white space is dropped and
    letters are lower-cased."""

    def __init__(self, path: str, byte_level: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library would start a thread for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path}: ids need more than 16 bits")
        self.byte_level = byte_level
        self.words, self.others = Kept(self.joined), Kept(self.raw)
        self.edge = np.zeros(1 << 16, bool)  # tokens that begin a word (byte level) or end one
        for token, i in self.tokenizer.get_vocab().items():
            self.edge[i] = token.startswith("Ġ") if byte_level else token.endswith("</w>")

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, ID).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, words: list[str]) -> list[bytes]:
        """As ``raw``, for words of letters alone; byte level: a space goes before each."""
        out: list[bytes] = []
        runs = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        before, size = " " if self.byte_level else "", ID.itemsize
        texts = [before + " ".join(r) for r in runs]
        for run, e in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, ID)
            at, x = np.flatnonzero(self.edge[ids]), ids.tobytes()
            at = [*(at * size).tolist(), len(x)] if self.byte_level else [0, *((at + 1) * size).tolist()]
            if len(at) == len(run) + 1 and at[0] == 0 and at[-1] == len(x):
                out.extend([x[i:j] for i, j in zip(at, at[1:], strict=False)])
            else:  # a letter that the tokenizer takes for a sign
                out.extend(self.raw([before + w for w in run]))
        return out

    def cut(self, text: str | None) -> str | None:
        """The text with its pieces between single spaces; None if it must be encoded at once.

        Byte level: the first piece has no space before it, others have one, and those
        that start with a line end stand at the start of a line."""
        if not self.byte_level:
            return (text or "").replace("\n", " ")
        return ("\r" + text).replace("\n", " \n") if text and "\r" not in text else None

    def _parts(self, piece: str) -> tuple[str, str, str] | None:
        """Line end, word and signs of a piece that isn't just letters and signs; None if it can't stand alone."""
        if not self.byte_level:
            return "", piece, ""
        line, body = (piece[0], piece[1:]) if piece[:1] in ("\n", "\r") else (" ", piece)
        if not body or body != body.strip():
            return None
        word = body.rstrip(_ENDINGS)
        end = body[len(word):] if word.isalpha() else ""
        return "\n" if line == "\n" else "", (" " if line == " " else "") + (word if end else body), end

    def _ids(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of distinct pieces; null for one that can't stand alone."""
        word = pc.utf8_rtrim(pieces, _ENDINGS)
        plain = pc.utf8_is_alpha(word)
        if not self.byte_level:
            # a letter and a sign when lowered or normalised: the sign goes with those behind it
            plain = pc.and_not(plain, pc.match_substring(word, "İ"))
            beyond = pc.and_not(plain, pc.string_is_ascii(word)).to_numpy(zero_copy_only=False)
            stable = np.ones(len(word), bool)
            stable[beyond] = [unicodedata.is_normalized("NFC", w) for w in _strings(word.filter(pa.array(beyond)))]
            plain = pc.and_(plain, pa.array(stable))
        whole, word = pieces.filter(plain), word.filter(plain)
        end = _behind(whole, word).dictionary_encode()
        word = (word if self.byte_level else pc.utf8_lower(word)).dictionary_encode()
        words = pa.array(self.words(_strings(word.dictionary)), pa.large_binary())
        ends = pa.array(self.others(_strings(end.dictionary)), pa.large_binary())
        of_plain = pc.binary_join_element_wise(words.take(word.indices), ends.take(end.indices),
                                               pa.scalar(b"", pa.large_binary()))
        parts = [self._parts(p) for p in _strings(pieces.filter(pc.invert(plain)))]
        known = iter(self.others([x for p in parts if p for x in p]))
        of_rest = pa.array([next(known) + next(known) + next(known) if p else None for p in parts], pa.large_binary())
        mask = plain.to_numpy(zero_copy_only=False)
        place = np.empty(len(pieces), np.int64)
        place[mask], place[~mask] = np.arange(len(whole)), np.arange(len(whole), len(pieces))
        return pa.concat_arrays([of_plain, of_rest]).take(pa.array(place))

    def encode(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        """The ids of each text as little-endian 16-bit numbers, with ``end`` appended."""
        cuts = [self.cut(t) for t in texts]
        apart = pc.split_pattern(pa.array([c for c in cuts if c is not None], pa.large_string()), " ")
        coded = apart.flatten().dictionary_encode()
        ids = self._ids(coded.dictionary).take(coded.indices)
        # a text with a piece that can't stand alone is encoded at once
        alone = np.concatenate([[0], np.cumsum(ids.is_null().to_numpy(zero_copy_only=False))])
        first = apart.offsets.to_numpy()
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[first].tolist()
        odd = (alone[first[1:]] > alone[first[:-1]]).tolist()
        data = memoryview(ids.buffers()[2] or b"")
        last = b"" if end is None else np.array([end], ID).tobytes()
        out, k = [], 0
        for t, c in zip(texts, cuts, strict=True):
            if c is None or odd[k]:
                out.append((self.raw([t])[0] if t else b"") + last)
            else:
                out.append(bytes(data[ends[k] : ends[k + 1]]) + last)
            k += c is not None
        return out


def _strings(x: pa.Array) -> list[str]:
    return x.to_numpy(zero_copy_only=False).tolist()


def _behind(whole: pa.LargeStringArray, first: pa.LargeStringArray) -> pa.LargeStringArray:
    """What stands in each string behind its first part."""
    size = pc.binary_length(first).to_numpy()
    n = pc.binary_length(whole).to_numpy() - size
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole)] + size
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[np.repeat(at - offsets[:-1], n) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(data))


def encoder(name: str) -> Encoder:
    """The worker's encoder of a public vocabulary, kept between tasks."""
    if name not in _encoders:
        import public_tokenizers

        _encoders[name] = Encoder(public_tokenizers.path(name), byte_level=name == BYTE_BPE)
    return _encoders[name]


def slices(texts: list, most_chars: int = 2_000_000) -> Iterable[tuple[int, int]]:
    """Ranges of rows of about ``most_chars`` characters, one row at least."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= most_chars:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
