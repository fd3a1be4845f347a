"""Token ids of a byte-level BPE, by the tokenizers library, at the cost of one look-up a word.

In this vocabulary's pre-tokenization a word takes the one space before it, so a text may be cut before any space, as long
as no three white space characters stand together and no two at the end: the words' ids, put together, are the text's ids. Each
distinct word (told by a 64-bit hash) goes through the library once per worker, many in one call; other texts, and those that
hold the special string, go through it whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .common import BYTE_HASH, mix64, powers

#: Words that a worker remembers (about 40 bytes each) before it starts anew, and bytes taken at once.
MAX_WORDS, BUFFER_BYTES = 3_000_000, 1_000_000
_BLANKS = re.compile(r"\s\s(?:\s|\Z)")
_EDGE = re.compile(r"\A\s|\s\Z")
_loaded: dict[str, ByteBpe] = {}


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class ByteBpe:
    """encode() many texts; one object per process and vocabulary file (see load)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)  # ids whose text begins with a space (written as U+0120)
        self.spaced[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self._forget()

    def _forget(self) -> None:
        self.flat, self.start, self.n = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32)  # by number of the word
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.known = [none, none]  # sorted hashes and numbers: of most words, and of the latest

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text (uint32)."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < BUFFER_BYTES):
                size += len(texts[end])
                end += 1
            out += self._some(texts[at:end])
            at = end
        return out

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        whole = [k for k, t in enumerate(texts) if _BLANKS.search(t) or any(s in t for s in self.special)]
        aside = set(whole)
        parts = [b"" if k in aside else t.encode("utf-8", "surrogatepass") for k, t in enumerate(texts)]
        ends = np.cumsum([len(p) for p in parts])
        raw = np.frombuffer(b"".join(parts), np.uint8)
        out = [np.zeros(0, np.uint32)] * len(texts)
        if len(raw):
            begins = raw == 32
            first = np.concatenate([[0], ends[:-1]])
            begins[first[first < ends]] = True
            at = np.flatnonzero(begins)
            stop = np.append(at[1:], len(raw))
            number = self._numbers(raw, at, stop)
            n = self.n[number].astype(np.int64)
            done = np.cumsum(n)
            flat = self.flat[np.repeat(self.start[number] - (done - n), n) + np.arange(done[-1])]
            cut = np.concatenate([[0], done])[np.searchsorted(at, np.concatenate([[0], ends]))]
            out = [flat[a:b] for a, b in zip(cut, cut[1:])]
        if whole:
            for k, ids in zip(whole, self._library([texts[k] for k in whole])):
                out[k] = np.array(ids, np.uint32)
        return out

    def _numbers(self, raw: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The number of each word raw[at:stop]; new words are learned."""
        forward, back = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE_HASH[raw] * forward[: len(raw)], dtype=np.uint64, out=total[1:])
        h = mix64((total[stop] - total[at]) * back[at] + (stop - at).astype(np.uint64))
        words, first, place = np.unique(h, return_index=True, return_inverse=True)
        if len(self.start) + len(words) > MAX_WORDS:
            self._forget()
        number = self._find(words)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = len(self.start) + np.arange(len(new))
            data = raw.tobytes()
            self._learn([data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(at[first[new]].tolist(), stop[first[new]].tolist())])
            keys, numbers = np.concatenate([self.known[1][0], words[new]]), np.concatenate([self.known[1][1], number[new]])
            if len(keys) > max(50_000, len(self.known[0][0]) // 3):
                keys, numbers = np.concatenate([self.known[0][0], keys]), np.concatenate([self.known[0][1], numbers])
                order = np.argsort(keys)
                self.known = [(keys[order], numbers[order]), (keys[:0], numbers[:0])]
            else:
                order = np.argsort(keys)
                self.known[1] = keys[order], numbers[order]
        return number[place]

    def _find(self, words: np.ndarray) -> np.ndarray:
        number = np.full(len(words), -1, np.int64)
        for keys, numbers in self.known:
            if len(keys):
                k = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
                hit = keys[k] == words
                number[hit] = numbers[k[hit]]
        return number

    def _learn(self, words: list[str]) -> None:
        alone = [k for k, p in enumerate(words) if len(p) < 2 or p[0] != " " or _EDGE.search(p[1:])]
        lone = set(alone)
        joint = [k for k in range(len(words)) if k not in lone]
        # words with their spaces, one after the other: an id that begins with a space begins the next word
        ids = np.array(self._library(["".join([words[k] for k in joint])])[0], np.uint32)
        begin = np.flatnonzero(self.spaced[ids])
        assert len(begin) == len(joint)
        n = np.zeros(len(words), np.int32)
        n[np.array(joint, np.int64)] = np.diff(np.append(begin, len(ids)))
        rest = self._library([words[k] for k in alone])
        n[np.array(alone, np.int64)] = [len(x) for x in rest]
        order = np.array([*joint, *alone], np.int64)
        start = np.zeros(len(words), np.int64)
        start[order] = len(self.flat) + np.cumsum(n[order]) - n[order]
        self.flat = np.concatenate([self.flat, ids, np.array([i for x in rest for i in x], np.uint32)])
        self.start, self.n = np.concatenate([self.start, start]), np.concatenate([self.n, n])


def load(path: str) -> ByteBpe:
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
