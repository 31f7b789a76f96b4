"""Whole texts to token ids by the tokenizers library, each distinct word encoded once.

Merges never cross words, so the library's ids of the words, one after the other, are its ids
of the whole text. The words are found for many texts at once (``words``), only the distinct
ones are handed to the library, and a task remembers the packed ids of those it has seen. New
words are handed over as one text wherever the library finds the same words in it.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

from tabloom.llm.words import remember, words_of

TOGETHER = 500      # new words in one text for the library

KINDS = ("byte_level", "lower_words", "whole")


class Encoder:
    """The library's tokenizer of one file, with words remembered.

    ``kind`` names the word pattern: ``byte_level`` is the usual one of byte-level BPE,
    ``lower_words`` that of lower-casing BPE which drops white space, ``whole`` hands whole
    texts to any tokenizer. Texts with a special string in them always go whole, as do those
    beyond Latin-1 where letters are lower-cased and composed first.
    """

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}; expected one of {KINDS}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = kind
        added = self.tokenizer.get_added_tokens_decoder().values()
        odd = [re.escape(t.content) for t in added]
        if kind == "lower_words":
            odd.append("[^\\x00-\\xff]")
        self.odd = re.compile("|".join(odd) or r"(?!)")
        largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        self.type = np.dtype("<u2" if largest < 2**16 else "<u4")
        self.code = "H" if largest < 2**16 else "I"
        self.words: dict[str, bytes] = {}
        # Where words end among the ids of a text: by the bytes of each id (a byte-level token
        # has a character for each), or by a mark that a word's last token ends in.
        self.size = np.zeros(largest + 1, np.int64)
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.marked = kind == "lower_words" and bool(mark)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.size[i] = token.endswith(mark) if self.marked else len(token)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _new(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words that are so again in a text of such words are handed over
        as texts of ``TOGETHER``; the rest, and all where no cuts fit, one by one."""
        joined, rest = [], []
        for w in words:
            again = self.marked or (self.kind == "byte_level" and len(w) > 1 and w[0] == " "
                                    and not w[1].isspace())
            (joined if again else rest).append(w)
        blank = " " if self.marked else ""
        texts = [blank.join(joined[i:i + TOGETHER]) for i in range(0, len(joined), TOGETHER)]
        packed = self._cut(texts, joined)
        if packed is None:
            packed, rest = [], words
        found = dict(zip(joined, packed)) | dict(zip(rest, self._whole(rest), strict=True))
        return [found[w] for w in words]

    def _cut(self, texts: list[str], words: list[str]) -> list[bytes] | None:
        """The ids of each of the words that the texts are made of, unless they don't end there."""
        if any(map(self.odd.search, texts)):
            return None
        packed = b"".join(self._whole(texts))
        done = np.cumsum(self.size[np.frombuffer(packed, self.type)])
        wanted = np.cumsum([1 if self.marked else len(w.encode()) for w in words], dtype=np.int64)
        ends = np.searchsorted(done, wanted) + 1
        if (ends[-1:] != len(done)).any() or (done[ends - 1] != wanted).any():
            return None
        cuts = (ends * self.type.itemsize).tolist()
        return [packed[a:b] for a, b in zip([0, *cuts], cuts)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, of type ``self.type``."""
        if self.kind == "whole":
            return [np.frombuffer(b, self.type) for b in self._whole(texts)]
        odd = [i for i, t in enumerate(texts) if self.odd.search(t)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        out = self._by_words([t.lower() for t in plain] if self.kind == "lower_words" else plain)
        for i, b in zip(odd, self._whole([texts[i] for i in odd]), strict=True):
            out[i] = np.frombuffer(b, self.type)
        return out

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        words = words_of(texts, self.kind)
        packed = list(map(self.words.get, words.distinct))
        gaps = [i for i, b in enumerate(packed) if b is None]
        new = [words.distinct[i] for i in gaps]
        made = self._new(new)
        for i, b in zip(gaps, made, strict=True):
            packed[i] = b
        remember(self.words, new, made, len(packed))
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.type.itemsize
        known = np.frombuffer(b"".join(packed), self.type)
        at = np.cumsum(sizes) - sizes
        many = sizes[words.place]                       # ids of each word of the texts
        before = np.cumsum(many) - many
        ids = known[np.repeat(at[words.place] - before, many) + np.arange(many.sum())]
        ends = np.cumsum(np.bincount(words.owner, many, len(texts)).astype(np.int64))
        return np.split(ids, ends[:-1])


@lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(path, kind)
