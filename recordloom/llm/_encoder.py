"""Encoding whole texts with a public tokenizer, each different word of a worker once."""

from __future__ import annotations

import functools
import json
import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _by_word(spec: dict) -> bool:
    """Whether no token can hold or see white space: then a text's ids are its words' ids in order."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    folds = (spec.get("normalizer") or {}).get("normalizers") or []
    drops = steps and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and steps[0]["pattern"].get("Regex", "").endswith(r"|[^\s\p{L}\p{N}]+") and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] for s in steps[1:])
    plain = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["content"] == " " for n in folds)
    return bool(drops and plain and not spec.get("post_processor") and not any(set(a["content"]) & set(" \n\t\r") or a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec.get("added_tokens", [])))


class Encoder:
    """encode(texts): the ids of all texts in a row, and each text's number of ids. Holds about max_words words.

    texts is an Arrow array of strings; it is split, and its different words are found, by Arrow. Words that a call has twice
    are held for later calls, the others only meanwhile.
    """

    #: Words that are encoded in one go; a comma or full stop after a letter is a piece of its own.
    JOINED, ENDS = 128, ".,"

    def __init__(self, path: str, max_words: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_file(path), max_words
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = _by_word(spec)
        if self.by_word:
            last = spec["model"].get("end_of_word_suffix") or ""
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for w, i in vocabulary.items() if last and w.endswith(last)]] = True
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.pool, self.start, self.length = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.used = self.filled = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, places: list[int], flat: np.ndarray, n: np.ndarray) -> None:
        while len(self.start) < self.filled:
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while len(self.pool) < self.used + len(flat):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.start[places], self.length[places] = self.used + np.cumsum(n) - n, n
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _learn(self, new: list[str]) -> None:
        """Encodes new words, as the next ones of start and length. Words of letters are one piece, with a comma or full stop behind them two, so that many can
        be encoded as one text: the tokens that end a piece tell where each word's ids end."""
        first, odd = self.filled, []
        self.filled += len(new)
        pieces = [1 if w.isalpha() else 2 if w[-1:] in self.ENDS and w[:-1].isalpha() else 0 for w in new]
        plain = [i for i, n in enumerate(pieces) if n]
        groups = [plain[i : i + self.JOINED] for i in range(0, len(plain), self.JOINED)]
        for group, ids in zip(groups, self._whole([" ".join([new[i] for i in g]) for g in groups])):
            ids = np.array(ids, np.int32)
            ends = np.flatnonzero(self.last[ids]) + 1
            each = np.cumsum([pieces[i] for i in group])
            if len(ends) == each[-1] and ends[-1] == len(ids):
                ends = ends[each - 1]
                self._add([first + i for i in group], ids, np.diff(ends, prepend=0))
            else:
                odd += group
        odd += [i for i, n in enumerate(pieces) if not n]
        if odd:
            ids = self._whole([new[i] for i in odd])
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            self._add([first + i for i in odd], np.fromiter(chain.from_iterable(ids), np.int32, int(n.sum())), n)

    def _take(self, different: list[str], places: np.ndarray, at: np.ndarray, held: bool) -> None:
        own = [different[i] for i in at.tolist()]
        places[at] = self.filled + np.arange(len(own))
        if held:
            self.at.update(zip(own, range(self.filled, self.filled + len(own))))
        if own:
            self._learn(own)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
        """The place of each word, each text's number of words, and what used and filled are to be afterwards."""
        if len(self.at) > self.max_words:
            self._clear()
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        different, each = words.dictionary.to_pylist(), words.indices.to_numpy()
        places = np.fromiter(map(self.at.get, different, repeat(-1)), np.int64, len(different))
        new, once = places < 0, np.bincount(each, minlength=len(different)) == 1
        self._take(different, places, np.flatnonzero(new & ~once), held=True)
        after = self.used, self.filled
        self._take(different, places, np.flatnonzero(new & once), held=False)
        return places[each], pc.list_value_length(lists).to_numpy().astype(np.int64), after

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            ids = self._whole(pc.fill_null(texts, "").to_pylist())
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), np.int32, int(n.sum())), n
        k, words, after = self._words(texts)
        n = self.length[k]
        at = np.repeat((self.start[k] - np.cumsum(n) + n).astype(np.int32), n)  # a pool has far fewer than 2**31 ids
        at += np.arange(len(at), dtype=np.int32)
        flat = self.pool[at]
        self.used, self.filled = after
        return flat, sums(n, words)

    def count(self, texts: pa.Array) -> np.ndarray:
        if not self.by_word:
            return self.encode(texts)[1]
        k, words, (self.used, self.filled) = self._words(texts)
        return sums(self.length[k], words)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sums of successive runs of such lengths."""
    at = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return at[ends] - at[ends - lengths]


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """The worker's own encoder of this file."""
    return Encoder(path)
