"""Token ids of whole texts with a public tokenizer file, one BPE run per distinct word.

The tokenizer drops white space and never joins what it parts, so a text's ids are its words' ids one after another.
"""

from __future__ import annotations

import os
import re
import sys
import types
from itertools import chain

import numpy as np


#: UTF-8 words of ASCII letters and the letters of the Latin-1 block (no signs, no combining marks).
LATIN = re.compile(rb"(?:[a-zA-Z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def shared_tokenizer(path: str | None = None) -> WordTokenizer:
    """The tokenizer of this Python process: a worker that is used again keeps its words from task to task."""
    kept = sys.modules.setdefault("_tessera_kept", types.ModuleType("_tessera_kept"))
    found = kept.__dict__.setdefault("tokenizers", {})
    if path not in found:
        found[path] = WordTokenizer(path)
    return found[path]


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codes(dict):
    """Numbers of words; a word that is not known yet gets the next one and is noted in new."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        self.new.append(word)
        return k


class WordTokenizer:
    """Ids of texts; the ids of words seen lately are kept, in bounded memory."""

    #: A word that is one token by itself; it parts the words that are encoded in one call.
    MARK = "@"

    def __init__(self, path: str | None = None, limit: int = 300_000, step: int = 2000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path or default_path())
        #: For words of lower-case ASCII letters, which the normaliser and the parting by classes leave as they are.
        self.plain = Tokenizer.from_file(path or default_path())
        self.plain.normalizer, self.plain.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        #: The tokens that end a word; every piece has one, as its last.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.limit, self.step = limit, step
        mark = self._one(self.MARK)
        if mark.size != 1:
            raise ValueError("the tokenizer file has no single token for the mark")
        self.mark = int(mark[0])
        self._clear()
        self._check()

    def _check(self) -> None:
        """Raises ValueError where the file's tokenizer does not give a text's ids word by word."""
        probes = ["the quick  brown fox, jumped. over", "Don't STOP\n\nit's 1,234.5 (é) naïve", "a\tb c_d x@y.z 北京 hi!", "word " * 40]
        for text, mine in zip(probes, self.encode([p.encode() for p in probes]), strict=True):
            if mine.tolist() != self._one(text).tolist():
                raise ValueError("this tokenizer does not encode word by word; its file cannot be used here")
        self._clear()

    def _clear(self) -> None:
        self.codes = Codes()
        self.start, self.size, self.flat, self.used = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(4096, np.uint32), 0

    def _one(self, text: str) -> np.ndarray:
        return self._ids(self.tokenizer, text)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has."""
        ids = self._one(f" {self.MARK} ".encode().join(words).decode("utf-8", "replace"))
        own = ids != self.mark
        ends = np.append(np.flatnonzero(~own), ids.size)
        if ends.size == len(words):
            return ids[own], np.diff(ends, prepend=-1) - 1
        return self._alone(words)  # a word gave the mark's token

    def _letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As _many, for words of lower-case ASCII letters: each is one piece."""
        ids = self._ids(self.plain, b" ".join(words).decode())
        at = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(at, prepend=-1)) if at.size == len(words) else self._alone(words)

    def _latin(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As _letters, for words of letters of the Latin-1 block as well."""
        ids = self._one(b" ".join(words).decode())
        at = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(at, prepend=-1)) if at.size == len(words) else self._alone(words)

    def _alone(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        alone = [self._one(w.decode("utf-8", "replace")) for w in words]
        return np.concatenate(alone), np.array([x.size for x in alone])

    def _keep(self, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        used = self.used + ids.size
        while used > self.flat.size:
            self.flat = np.concatenate([self.flat, self.flat])
        self.start[codes] = self.used + np.cumsum(sizes) - sizes
        self.size[codes] = sizes
        self.flat[self.used : used] = ids
        self.used = used

    def _learn(self) -> None:
        #: A run of these marks after an ASCII letter is a piece of its own, so such a word is its two parts.
        marks, mark, codes = b".,!?;:#*$%&", self.MARK.encode(), self.codes
        letters, latin, many, odd, parted = [], [], [], [], []
        words = codes.new
        for w in words:  # the list grows by the parts that are new themselves
            if w.isalpha():
                (letters if w.islower() else latin).append(w)
                continue
            b = w.rstrip(marks)
            if b and len(b) < len(w) and 97 <= b[-1] <= 122:
                parted += [codes[w], codes[b], codes[w[len(b) :]]]
            elif LATIN.fullmatch(w):
                latin.append(w)
            else:
                (odd if mark in w or b"<|" in w else many).append(w)
        codes.new = []
        while len(codes) > self.start.size:
            self.start, self.size = np.concatenate([self.start, self.start]), np.concatenate([self.size, self.size])
        for own, run in ((letters, self._letters), (latin, self._latin), (many, self._many), (odd, self._alone)):
            for low in range(0, len(own), self.step):
                part = own[low : low + self.step]
                self._keep(np.fromiter(map(codes.__getitem__, part), np.int64, len(part)), *run(part))
        if parted:
            whole, pairs = np.split(np.array(parted, np.int64).reshape(-1, 3), [1], axis=1)
            sizes = self.size[pairs.ravel()]
            self._keep(whole.ravel(), self._gather(pairs.ravel(), sizes), sizes.reshape(-1, 2).sum(axis=1))

    def _gather(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes, dtype=np.int32 if sizes.sum() < 1 << 31 else np.int64)
        at = np.repeat(self.start[codes] - (ends - sizes), sizes)
        at += np.arange(at.size, dtype=at.dtype)
        return self.flat[at]

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each UTF-8 text; a null or blank text has none."""
        if len(self.codes) > self.limit:
            self._clear()
        #: The tokenizer lower-cases; only its special tokens, which hold "<|", are told apart by case.
        split = [(t.split() if b"<|" in t else t.lower().split()) if t else [] for t in texts]
        counts = np.array([len(words) for words in split], np.int64)
        c = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.codes.new:
            self._learn()
        sizes = self.size[c]
        ids = self._gather(c, sizes)
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return [ids[low:high] for low, high in zip(np.concatenate([[0], stops[:-1]]), stops, strict=True)]


def in_groups(ids: list, texts: list[bytes | None], most: int = 1_000_000):
    """Rows in groups of so many bytes of text, or of one text that is longer."""
    low = size = 0
    for k, t in enumerate(texts):
        size += len(t or b"")
        if size >= most:
            yield ids[low : k + 1], texts[low : k + 1]
            low, size = k + 1, 0
    if low < len(texts):
        yield ids[low:], texts[low:]
