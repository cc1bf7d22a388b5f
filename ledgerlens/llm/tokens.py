"""Encoders for tasks: the tokenizers library behind exact caches.

Vocabulary files are given by path and opened once per Python worker.
"""

from __future__ import annotations

import gc
import json
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes that a worker's words, and their parts, may take; the table is emptied
#: when it has more. ENTRY_BYTES: what an entry takes besides its strings.
CACHE_BYTES = 220 << 20
ENTRY_BYTES = 190
#: Words that the library encodes as one text.
JOINED_WORDS = 1000


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library_tokenizer(path: str):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


#: Words, one a line: letters of ASCII and Latin-1, then at most punctuation;
#: other words match with both groups empty.
SIMPLE_WORDS = re.compile(
    "^(?:([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!?:;]*)$|[^\n]*$)", re.M).findall
#: Normaliser steps under which such letters just turn to lower case.
LOWER_STEPS = ["NFC", "Replace", "Lowercase"]


def joined_ids(tokenizer, words: list[str]) -> list[bytes]:
    """Ids of each word as little-endian uint32. Many words are encoded as
    one text; the offsets of the ids tell them apart again."""
    found: list[bytes] = []
    for i in range(0, len(words), 64 * JOINED_WORDS):
        groups = [words[k:k + JOINED_WORDS] for k in range(i, min(len(words), i + 64 * JOINED_WORDS), JOINED_WORDS)]
        for group, c in zip(groups, tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            starts = np.fromiter((a for a, _ in c.offsets), np.int64, len(c.ids))
            stops = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)) + 1)
            cuts = (4 * np.searchsorted(starts, stops)).tolist()
            raw = np.array(c.ids, "<u4").tobytes()
            found += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
    return found


class WordIds(dict):
    """White-space separated word (UTF-8) -> its ids as little-endian uint32.

    Exact for a tokenizer that drops white space and never joins characters
    across it: a text's ids are then its words' ids one after another. In the
    same way a simple word is its lower-case letters, encoded by the library's
    model alone, and its punctuation, so the variants of a word share one
    encoding; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = library_tokenizer(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if steps[0].get("behavior") != "Removed" or not steps[0].get("invert"):
            raise ValueError("this tokenizer does not drop white space")
        self.letters = None
        split = steps[0]["pattern"].get("Regex", "")
        if ([n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == LOWER_STEPS
                and r"|[\p{L}]+|" in split and r"|[^\s\p{L}\p{N}]+" in split):
            from tokenizers import Tokenizer, normalizers, pre_tokenizers
            self.letters = Tokenizer.from_file(path)
            self.letters.normalizer = normalizers.Sequence([])
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.parts: dict[str, bytes] = {"": b""}
        self.held = self.held_parts = 0

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, given in UTF-8."""
        words = [t.split() for t in texts]
        self.learn(set().union(*words))
        found = [b"".join(map(self.__getitem__, w)) for w in words]
        self.trim()
        return found

    def trim(self, most: int | None = None) -> None:
        """Forget all if there are more than ``most`` words (if given) or more
        than CACHE_BYTES."""
        if most is not None and len(self) > most or self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        if most is not None and len(self.parts) > most or self.held_parts > CACHE_BYTES // 2:
            self.parts = {"": b""}
            self.held_parts = 0

    def learn(self, words: set) -> None:
        """Encode the words that are not known yet."""
        collecting = gc.isenabled()
        gc.disable()  # many short-lived tuples, no cycles
        try:
            self._learn([w for w in words if w not in self])
        finally:
            if collecting:
                gc.enable()

    def _learn(self, new: list[bytes]) -> None:
        if not new:
            return
        joined = b"\n".join(new)
        # An id takes four bytes and seldom stands for less than one.
        self.held += 3 * len(joined) + ENTRY_BYTES * len(new)
        joined = joined.decode("utf-8")
        if self.letters is None:
            self.update(zip(new, joined_ids(self.tokenizer, joined.split("\n"))))
            return
        # One match per word; a word that is not simple has an empty stem.
        stems, ends = zip(*SIMPLE_WORDS(joined))
        stems = "\n".join(stems).lower().split("\n")
        parts = self.parts
        for texts, tokenizer in ((stems, self.letters), (ends, self.tokenizer)):
            unknown = [t for t in set(texts) if t not in parts]
            self.held_parts += sum(map(len, unknown)) * 3 + ENTRY_BYTES * len(unknown)
            parts.update(zip(unknown, joined_ids(tokenizer, unknown)))
        known = parts.__getitem__
        self.update(zip(new, [a + b for a, b in zip(map(known, stems), map(known, ends))]))
        hard = [w for w, s in zip(new, stems) if not s]
        self.update(zip(hard, joined_ids(self.tokenizer, [w.decode("utf-8") for w in hard])))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


#: Split pattern of the byte-level pre-tokenizer (a fixed value).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


class ByteIds:
    """Byte-level BPE ids of whole texts, as the tokenizers library gives
    them. When the file's merges are in the order of their ids, the same
    ranks run in tiktoken (no offsets, faster); else the library itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = library_tokenizer(path)
        letters, model = byte_letters(), spec["model"]
        self.vocabulary = {bytes(letters[c] for c in piece): i for piece, i in model["vocab"].items()
                           if all(c in letters for c in piece)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        pre = spec["pre_tokenizer"] or {}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.fast = None
        if (order == sorted(set(order)) and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                and not pre.get("add_prefix_space") and not spec["normalizer"]
                and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            import tiktoken
            self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=BYTE_LEVEL_PATTERN,
                                          mergeable_ranks=self.vocabulary, special_tokens=self.special)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            return np.array(self.fast.encode_to_numpy(text, allowed_special="all"), np.uint32)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)
