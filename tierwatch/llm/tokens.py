"""Token ids of Arrow text batches with a public tokenizer; runs inside tasks only.

A byte-level BPE never merges over the borders of its split pattern. Some borders show in the
bytes: before a space, before other white space after a word, and between an ASCII letter and an
ASCII mark (the apostrophe aside, as it may begin a contraction). Texts are cut there, and every
distinct segment goes to the tokenizers library's model once, so the ids are those of the whole
text. Texts where such a cut could matter (white space on both sides of a space, strings of added
tokens) and tokenizers of any other make go to the library whole. A test compares both ways.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tierwatch.llm.words import SPACES, byte_class, chunks, count_between, give_back, hash_spans, raw

#: Distinct segments that a worker remembers before it starts afresh.
CACHED_SEGMENTS = 500_000
CHUNK_BYTES = 3 << 20
#: The published split pattern of this kind of tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LEFT = SPACES | (np.arange(256) >= 0x80)
#: First bytes of all white space beyond ASCII.
_RIGHT = SPACES | np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_PLAIN = ~SPACES & (np.arange(256) < 0x80)
_LETTER = byte_class([(65, 90), (97, 122)])
_MARK = byte_class([(33, 38), (40, 47), (58, 64), (91, 96), (123, 126)])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_names() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: bytes that print stand for
    themselves, the others for the characters from 256 on, in order."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printed]
    return [chr(b) if b in printed else chr(256 + others.index(b)) for b in range(256)]


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        split = made.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in made.get("added_tokens", [])]
        self.by_parts = (made.get("normalizer") is None and split.get("type") == "ByteLevel"
                         and not split.get("add_prefix_space") and split.get("use_regex", True)
                         and made["model"]["type"] == "BPE" and not made["model"].get("continuing_subword_prefix"))
        self.split, self.model = regex.compile(SPLIT), self.tokenizer.model
        self.byte_names = _byte_names()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.first = array("I"), array("q", [0])

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, key: int, segment: bytes) -> int:
        text = segment.decode()
        alone = text.isalpha() or text[:1] == " " and text[1:].isalpha()
        for word in (segment,) if alone else map(str.encode, self.split.findall(text)):
            self.flat.extend([t.id for t in self.model.tokenize("".join([self.byte_names[b] for b in word]))])
        place = self.known[key] = len(self.first) - 1
        self.first.append(len(self.flat))
        return place

    def _by_segments(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        cut = np.zeros(len(data) + 1, bool)
        left, right = data[:-1], data[1:]
        cut[1:-1] = ((right == 32) | (_PLAIN[left] & SPACES[right]) | (_LETTER[left] & _MARK[right])
                     | (_MARK[left] & _LETTER[right]))
        cut[offsets] = True
        borders = np.flatnonzero(cut)
        starts, ends = borders[:-1], borders[1:]
        codes, distinct = pd.factorize(hash_spans(data, starts, ends))
        if len(self.known) > CACHED_SEGMENTS:
            self._forget()
        example = np.zeros(len(distinct), np.int64)
        example[codes[::-1]] = np.arange(len(codes))[::-1]
        keys = distinct.tolist()
        places = [self.known.get(k, -1) for k in keys]
        for i in np.flatnonzero(np.array(places, np.int64) < 0).tolist():
            at = example[i]
            places[i] = self._learn(keys[i], data[starts[at]:ends[at]].tobytes())
        which = np.array(places, np.int64)[codes]
        first, flat = np.array(self.first), np.array(self.flat, np.uint32)
        size = first[which + 1] - first[which]
        after = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(first[which] - after[:-1], size) + np.arange(after[-1])]
        return np.split(ids, after[np.searchsorted(starts, offsets[1:-1])])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (null: none) of a small batch."""
        texts = texts.fill_null("")
        data, offsets = raw(texts)
        if not self.by_parts or not len(data):
            return self._whole(texts.to_pylist())
        risky = np.zeros(len(data), bool)
        risky[1:-1] = _LEFT[data[:-2]] & (data[1:-1] == 32) & _RIGHT[data[2:]]
        whole = count_between(risky, offsets) > 0
        for added in self.added:
            whole |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        out = self._by_segments(data, offsets)
        rows = np.flatnonzero(whole)
        for row, ids in zip(rows, self._whole(texts.take(pa.array(rows)).to_pylist())):
            out[row] = ids
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id and token ids of every row of (id, text) batches, a few MB of text at a time."""
    made = encoder(path)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for row, part in chunks(batch.column(1), CHUNK_BYTES):
            yield from zip(ids[row:row + len(part)], made.encode(part))
    give_back()
