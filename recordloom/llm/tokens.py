"""Token ids of whole texts, by a vocabulary file of the tokenizers library."""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: White space of other kinds than a space or a line break, and line breaks in a row.
_OTHER = re.compile(r"[^\S \n]|\n\n")
_PUNCTUATION = ".,;:!?%$&*#|"
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Encodes texts to little-endian ids, 16 bits wide if the vocabulary allows.

    Byte-level BPE never merges across the start of a word with its leading space, nor across a single line break, nor
    between a word and the punctuation after it; so a text's ids are those of its parts.  Parts are encoded by the
    library and remembered, the most recent ``cache_limit`` to twice as many; texts with runs of white space or with an
    added token of the vocabulary, and vocabularies of another kind, go to the library whole.
    """

    def __init__(self, path: str, cache_limit: int = 450_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.fast = getattr(self.library, "encode_batch_fast", self.library.encode_batch)  # without offsets, which nobody reads
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.newline = self._whole("\n")
        self.by_part = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer") and len(self.newline) == self.dtype.itemsize
        self.cache_limit = cache_limit
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _first(self, word: str) -> bytes:
        """The ids of a text's first word, which no space stands before; short ones are remembered."""
        if len(word) > 40:
            return self._whole(word)
        if (ids := self.firsts.get(word)) is None:
            if len(self.firsts) >= 50_000:
                self.firsts.clear()
            ids = self.firsts[word] = self._whole(word)
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_part or any(t in text for t in self.added):
            return self._whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")  # a part is a word after a space, or a line break and a word
        if _OTHER.search(first.lstrip("\n")):
            return self._whole(text)
        ids = list(map(self.parts.get, rest))  # each part is looked up once
        if lacking := [i for i, x in enumerate(ids) if x is None]:
            new = {rest[i] for i in lacking}
            if "" in new or "\n" in new or _OTHER.search("".join(new)):  # runs of white space, or other kinds of it
                return self._whole(text)
            self._learn(new)
            for i in lacking:
                ids[i] = self.parts[rest[i]]
        return self._first(first) + b"".join(ids)

    def _learn(self, new: set[str]) -> None:
        if len(self.parts) > self.cache_limit:
            self.older, self.parts = self.parts, {}
        parts, older, marks = self.parts, self.older, self.marks
        fresh: dict[str, list[tuple[str, bytes]]] = {}
        for w in new:
            if w in older:
                parts[w] = older[w]
                continue
            word, mark = w.rstrip(_PUNCTUATION), b""
            if len(word) < len(w):
                if word and word[-1].isalnum():
                    end = w[len(word) :]
                    mark = marks.get(end) or marks.setdefault(end, self._whole(end))
                    if ids := parts.get(word) or older.get(word):
                        parts[w] = ids + mark
                        continue
                else:
                    word = w
            if word in fresh:
                fresh[word].append((w, mark))
            else:
                fresh[word] = [(w, mark)]
        if len(marks) > 50_000:
            marks.clear()
        if fresh:
            self._spread(fresh)

    def _spread(self, fresh: dict[str, list[tuple[str, bytes]]]) -> None:
        """Encode words, joined by line breaks, at once: those after a space, then those after a line break."""
        after_space = [w for w in fresh if w[0] != "\n"]
        after_break = [w for w in fresh if w[0] == "\n"]
        words, text = after_space + after_break, "\n".join([" " + w for w in after_space] + [w[1:] for w in after_break])
        raw = self._ids(text)
        ends = np.append(np.flatnonzero(raw == np.frombuffer(self.newline, self.dtype)[0]), len(raw)).tolist()
        if len(ends) != len(words):
            raise AssertionError("a word held a line break")
        data, size, start, parts = raw.tobytes(), self.dtype.itemsize, 0, self.parts
        for w, e in zip(words, ends):
            ids = data[start * size : e * size] if w[0] != "\n" else self.newline + data[start * size : e * size]
            for name, mark in fresh[w]:
                parts[name] = ids + mark
            start = e + 1


def encoder(path: str) -> Encoder:
    """One encoder per process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
