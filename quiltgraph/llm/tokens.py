"""Token ids of whole texts, through a public tokenizer whose file path is a parameter."""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

from quiltgraph.llm.common import memory

VOCABULARY = "word_bpe_49k.json"
SPECIAL_TOKENS = 2  # the file holds this many ids after the largest ordinary one


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: A stop or comma next to another sign: together they are one unit of the pre-tokeniser.
_JOINED = re.compile(r"[.,](?:(?<=[^\w\s][.,])|(?<=_[.,])|(?=[^\w\s]|_))")
#: Beyond the Latin letters (and for the dotted I, whose lower case ends in a mark) words are left as they are.
_WIDE = re.compile("[^\\x00-\u012f\u0131-\u024f]")
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to Python's split, but not to the vocabulary


def pieces(text: str) -> list[str]:
    """Parts of a text that can be encoded one by one: blank-separated words, where possible in lower
    case and apart from the stop or comma behind them (the vocabulary does both itself)."""
    if any(c in text for c in _SEPARATORS):
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
    if not _WIDE.search(text):
        text = text.lower()
        if not _JOINED.search(text):
            text = text.replace(",", " , ").replace(".", " . ")
    return text.split()


def encoder(path: str) -> WordIds:
    """One encoder for all tasks of a worker process."""
    held = memory("tokens")
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


class WordIds:
    """Encode texts word by word with a bounded memory of known words.

    The vocabulary's pre-tokeniser drops white space and never joins across it, so the ids
    of a text are those of its pieces, one after the other (tests compare with the library on
    whole texts). Each distinct piece is encoded once; when the memory is full, the half used
    least is forgotten. New words of letters only are encoded in one go, told apart by their word ends.
    """

    def __init__(self, path: str, most_words: int = 300_000, most_chars: int = 10_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(names.values(), default=0) + 64, bool)
        self.ends[[i for t, i in names.items() if t.endswith("</w>")]] = True
        self.most_words, self.most_chars = most_words, most_chars
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 15, np.int64)
        self.uses = np.zeros(1 << 15, np.int64)
        self.n = 0

    def _forget(self) -> None:
        """Keep the half used most, and at most half of the characters."""
        keep = np.sort(np.argsort(-self.uses[: self.n], kind="stable")[: self.most_words // 2])
        words, ids, at = list(self.known), self.ids, self.at
        names = [words[i] for i in keep.tolist()]
        if sum(map(len, names)) > self.most_chars // 2:
            self._clear()
            return
        uses = self.uses[keep] // 2
        sizes = (at[1:] - at[:-1])[keep]
        self._clear()
        end = np.cumsum(sizes)
        self.ids = ids[np.repeat(at[keep] - (end - sizes), sizes) + np.arange(int(sizes.sum()))]
        self.at, self.uses = np.concatenate([[0], end]), uses
        self.known, self.n, self.chars = dict(zip(names, range(len(names)), strict=True)), len(names), sum(map(len, names))

    def _learn(self, new: list[str]) -> None:
        plain, other, ids, sizes = [], [], [], []
        for x in new:
            (plain if x.isalpha() and not _WIDE.search(x) else other).append(x)
        for k in range(0, len(plain), 1000):
            part = plain[k : k + 1000]
            got = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            stop = np.flatnonzero(self.ends[got]) + 1
            if len(stop) != len(part):  # cannot be told apart after all
                each = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                got, stop = np.array([i for x in each for i in x], np.uint32), np.cumsum([len(x) for x in each])
            ids.append(got)
            sizes.append(np.diff(stop, prepend=0))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        ids.append(np.fromiter((i for x in found for i in x), np.uint32, int(sizes[-1].sum())))
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        end = self.at[self.n] + len(ids)
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        while self.n + len(new) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
        if self.n + len(new) > len(self.uses):
            self.uses = np.concatenate([self.uses, np.zeros(len(self.at) - len(self.uses), np.int64)])
        self.ids[self.at[self.n] : end] = ids
        self.at[self.n + 1 : self.n + 1 + len(new)] = self.at[self.n] + np.cumsum(sizes)
        self.known.update(zip(plain + other, range(self.n, self.n + len(new)), strict=True))
        self.n += len(new)
        self.chars += sum(map(len, new))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the texts' offsets in them (one more than texts)."""
        if len(self.known) > self.most_words or self.chars > self.most_chars:
            self._forget()
        parts: list[str] = []
        ends = [0]
        for t in texts:
            parts += pieces(t)
            ends.append(len(parts))
        k = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(k < 0)
        if len(missing):
            names = [parts[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(names)))
            k[missing] = [self.known[x] for x in names]
        self.uses[: self.n] += np.bincount(k, minlength=self.n)
        sizes = (self.at[1:] - self.at[:-1])[k]
        out = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.repeat(self.at[k] - out[:-1], sizes) + np.arange(out[-1])
        return self.ids[flat], out[np.array(ends)]


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with ``end_id`` after each."""
    n = len(at) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[at[1:] + np.arange(n)] = False
    out[keep] = ids
    return out, at + np.arange(n + 1)
