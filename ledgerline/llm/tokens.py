"""Token ids by the tokenizers library, fast over words seen before.

A byte-level BPE tokenizer splits a text by pattern before it merges, and
a space or line feed that does not follow white space always starts a new
piece. So a text in which they never do is cut before each of them, and the
ids of a word with its space, which the library makes, are remembered. Every
other text, and every tokenizer of another kind, is encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

ID = np.dtype("<u4")
_RUN = re.compile(r"\s[ \n]")
_loaded: dict[tuple[str, int], "Encoder"] = {}


def default_tokenizer() -> str:
    """Path of the byte-level vocabulary used by the registered queries."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, remember: int = 500_000) -> "Encoder":
    """The encoder of this worker process for a tokenizer file."""
    if (path, remember) not in _loaded:
        _loaded[path, remember] = Encoder(path, remember)
    return _loaded[path, remember]


class Encoder:
    """``encode(texts)``: for each text its ids as little-endian unsigned
    32-bit integers. ``remember`` bounds the words kept: when half as many
    are known, those of the half before that were not met again are dropped."""

    def __init__(self, path: str, remember: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.library, self.remember = Tokenizer.from_file(path), remember
        split = self.library.pre_tokenizer
        self.by_word = (isinstance(split, ByteLevel) and split.use_regex
                        and not split.add_prefix_space and self.library.normalizer is None)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.feed = self.library.encode("\n", add_special_tokens=False).ids if self.by_word else []
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = [array("I", e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        if ID != np.dtype("I"):  # another byte order
            return [np.array(x, ID).tobytes() for x in found]
        return [x.tobytes() for x in found]

    def _learn(self, words: set[str]) -> None:
        """Make every word known. A word that starts with a line feed stands
        for itself, any other for itself after a space."""
        if len(self.known) >= self.remember // 2:
            self.older, self.known = self.known, {}
        new = []
        for w in words.difference(self.known):
            ids = self.older.get(w)
            if ids is None:
                new.append(w)
            else:
                self.known[w] = ids
        odd = []
        for spaced in (True, False):
            some = [w for w in new if (w[:1] != "\n") == spaced]
            joined = [some[i:i + 32] for i in range(0, len(some), 32)]
            texts = [" " + "\n ".join(part) if spaced else "".join(part) for part in joined]
            for part, ids in zip(joined, self._whole(texts)):
                self._share(part, ids, spaced) or odd.extend(part)
        self.known.update(zip(odd, self._whole([w if w[:1] == "\n" else " " + w for w in odd])))

    def _share(self, words: list[str], ids: bytes, spaced: bool) -> bool:
        """Note the ids of words encoded together, cut at the line feeds
        between (spaced) or before them; not if they hold other white space
        or nothing, as then a feed may not stand alone."""
        bare = [w[not spaced:] for w in words]
        if len(self.feed) != 1 or "" in bare or len("".join(bare).split()) != 1 or any(map(str.isspace, (bare[0][0], bare[-1][-1]))):
            return False
        cuts = 4 * np.flatnonzero(np.frombuffer(ids, ID) == self.feed[0])
        if len(cuts) != len(words) - spaced:
            return False
        begins = [0, *(cuts + 4)] if spaced else cuts.tolist()
        ends = [*cuts, len(ids)] if spaced else [*cuts[1:], len(ids)]
        self.known.update((w, ids[b:e]) for w, b, e in zip(words, begins, ends))
        return True

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole, split, words = [], [], set()
        for i, text in enumerate(texts):
            if self.by_word and not _RUN.search(text) and not any(s in text for s in self.special):
                head, *units = text.replace("\n", " \n").split(" ")
                split.append((i, head, units))
                words.update(units)
            else:
                whole.append(i)
        self._learn(words)
        known = self.known.__getitem__
        for (i, _, units), ids in zip(split, self._whole([head for _, head, _ in split])):
            out[i] = ids + b"".join(map(known, units))
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        return out


def in_small_batches(rows, size_of, limit: int = 2_000_000):
    """Lists of consecutive rows of about ``limit`` in size, one row at least."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += size_of(row)
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some
