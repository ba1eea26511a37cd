"""Token ids of Arrow text columns from a public vocabulary file, each distinct word encoded once."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from florilege.llm.shingles import chunks, text_buffers

#: Distinct words a worker remembers; beyond it the memory starts anew.
REMEMBERED_WORDS = 400_000
CHUNK_BYTES = 2 << 20

_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_SECOND = np.zeros(256, bool)  # after 0xC3: the second byte of a Latin letter
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_SECOND = np.arange(256, dtype=np.uint8)
_LOWER_SECOND[0x80:0x9F] += 32


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the rest follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Encodes whole texts with a tokenizers file whose rule never joins text across ASCII white space.

    A text is cut at white space, and a word of plain Latin letters is also cut from the run of ASCII marks that ends it;
    the vocabulary's own splitting rule cuts there too, so the ids are those of the whole text (tests hold this against
    the library on whole texts). Plain words, lower-cased as the vocabulary's normaliser does, go straight to the
    library's model; everything else goes through its full encoder.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = str.maketrans(_byte_letters())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 16, np.int64)  # word k has ids first[k] to first[k + 1]

    def _learn(self, words: list[str]) -> None:
        n, found = len(self.known), []
        odd = [w for w in words if not _PLAIN.fullmatch(w)]
        encoded = dict(zip(odd, self.tokenizer.encode_batch(odd, add_special_tokens=False), strict=True)) if odd else {}
        for w in words:
            if (e := encoded.get(w)) is not None:
                found.append(e.ids)
            else:
                spelt = w if w.isascii() else w.encode().decode("latin-1").translate(self.letters)
                found.append([t.id for t in self.model.tokenize(spelt)])
            self.known[w] = len(self.known)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        start, stop = int(self.first[n]), int(self.first[n] + lengths.sum())
        while stop > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(words) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.ids[start:stop] = np.fromiter((i for x in found for i in x), np.uint32, stop - start)
        self.first[n + 1 : n + 1 + len(words)] = start + np.cumsum(lengths)

    def _units(self, part: np.ndarray, cuts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of text to encode, in order, and how many each text has."""
        inside = np.ones(len(part) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(_SPACE[part], out=inside[1:-1])
        start, stop = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        inner = cuts[1:-1]
        inner = inner[(inner > 0) & (inner < len(part))]
        touching = inner[inside[inner] & inside[inner + 1]]
        start[touching] = stop[touching] = True
        starts, stops = np.flatnonzero(start), np.flatnonzero(stop)
        second = np.zeros(len(part), bool)
        second[1:] = (part[:-1] == 0xC3) & _SECOND[part[1:]]
        plain = _LETTER[part] | second
        plain[:-1] |= second[1:]
        unplain = np.zeros(len(part) + 1, np.int32)
        np.cumsum(~plain, out=unplain[1:])
        last = np.maximum.accumulate(np.where(_MARK[part], np.int32(-1), np.arange(len(part), dtype=np.int32))) if len(part) else np.zeros(0, np.int32)
        core = np.maximum(last[stops - 1] + 1, starts) if len(stops) else stops
        simple = (core > starts) & (unplain[core] == unplain[starts])
        mask = np.zeros(len(part) + 1, np.int8)
        mask[starts[simple]] += 1
        mask[core[simple]] -= 1
        lower = np.cumsum(mask[:-1]).astype(bool)
        text = np.where(lower, np.where(second, _LOWER_SECOND[part], _LOWER[part]), part)
        marked = simple & (core < stops)
        begins = np.sort(np.concatenate([starts, core[marked]]))
        ends = np.sort(np.concatenate([stops, core[marked]]))
        offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
        data = np.ascontiguousarray(text[inside[1:-1]])
        units = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data))
        return units, np.diff(np.searchsorted(begins, cuts))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and their counts."""
        low = offsets[0]
        units, per_text = self._units(data[low : offsets[-1]], offsets - low)
        coded = units.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each word first
        if len(self.known) + len(words) > REMEMBERED_WORDS:
            self._forget()
        if new := [w for w in words if w not in self.known]:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()] if words else np.zeros(0, np.int64)
        first = self.first[at]
        counts = self.first[at + 1] - first
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(per_text)])])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a vocabulary file; its memory lasts over the tasks that the worker runs."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ended_documents(column: pa.Array, path: str, end_id: int):
    """For chunks of texts: the first text's number, the ids of all texts of the chunk each with ``end_id`` after it, and their counts."""
    data, offsets = text_buffers(column)
    words = encoder(path)
    for first, last in chunks(offsets, CHUNK_BYTES):
        ids, counts = words.encode(data, offsets[first : last + 1])
        out = np.full(len(ids) + len(counts), end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        yield first, out, counts + 1
