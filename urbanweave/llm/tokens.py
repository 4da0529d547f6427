"""Token ids of whole texts from a public tokenizer file, many texts at once.

Any file of the ``tokenizers`` library works. For the word BPE kind (NFC, lower case, words by one pattern, ``</w>`` word ends) texts
of ASCII and Latin-1 letters take a shorter way to the same ids: words are split and hashed with numpy, each distinct word of
a piece is encoded once, and the ids are put in place by one gather. All other texts are encoded by the library itself.
"""

from __future__ import annotations

import json
import os
from functools import cache, cached_property

import numpy as np

from urbanweave.llm.kernels import Flat

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each task its core

#: Fixed values of the word BPE kind: the pattern of its words and its normalisers.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]

_CLASS = np.full(256, 3, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 other
_CLASS[[32, 9, 10, 11, 12, 13]] = 0
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[128:192] = _CLASS[0xC3] = 1
_CLASS[48:58] = 2

_PLAIN = np.zeros(256, bool)  # bytes of texts that take the short way
_PLAIN[9:14] = _PLAIN[32:127] = _PLAIN[128:192] = _PLAIN[0xC3] = True


class Tokenizer:
    """Ids of texts as the library gives them, without special tokens added."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.words = _word_encoder(stated) if _is_word_bpe(stated) else None

    @cached_property
    def library(self):
        """Loaded when the first text needs it."""
        from tokenizers import Tokenizer as Library

        return Library.from_file(self.path)

    def encode(self, flat: Flat) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a piece, one after the other, and the ids before each text."""
        if self.words is None:
            return self._whole(flat, np.arange(len(flat)))
        odd = _odd_texts(flat)
        if not len(odd):
            return self._short(flat)
        ids, first = self._short(flat, odd)
        own, own_first = self._whole(flat, odd)
        counts = np.diff(first)
        counts[odd] = np.diff(own_first)
        parts = [own[own_first[k]:own_first[k + 1]] for k in range(len(odd))]
        cut = np.split(ids, first[odd])
        joined = [cut[0]]
        for part, rest in zip(parts, cut[1:], strict=True):
            joined += [part, rest]
        return np.concatenate(joined), np.concatenate([[0], np.cumsum(counts)])

    def _whole(self, flat: Flat, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = [flat.raw[flat.first[k]:flat.first[k + 1]].tobytes().decode("utf-8", "replace") for k in texts.tolist()]
        found = [np.array(x.ids, np.uint32) for x in self.library.encode_batch(raw, add_special_tokens=False)]
        first = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        return (np.concatenate(found) if found else np.empty(0, np.uint32)), first

    def _short(self, flat: Flat, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        raw, low = flat.raw, flat.low
        accented = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)) + 1
        low[accented] += 0x20  # capitals of Latin-1
        kind = _CLASS[raw]
        if skip is not None:
            for k in skip.tolist():
                kind[flat.first[k]:flat.first[k + 1]] = 0
        change = np.ones(len(raw) + 1, bool)
        change[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        change[flat.first] = True
        edge = np.flatnonzero(change)
        start, end = edge[:-1], edge[1:]
        solid = kind[start] > 0
        start, end = start[solid], end[solid]
        hashes = flat.span_hash(start, end)
        _, at, place = np.unique(hashes, return_index=True, return_inverse=True)
        bytes_ = low.tobytes()
        text = b"".join([bytes_[s:e] + b" " for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]).decode()
        ids = self.words.encode_to_numpy(text)
        ends = np.flatnonzero(self.closing[ids]) + 1  # each word ends with one closing token
        own = np.diff(ends, prepend=0)
        counts = own[place]
        total = np.concatenate([[0], np.cumsum(counts)])
        gather = np.repeat((ends - own)[place] - total[:-1], counts) + np.arange(total[-1])
        return ids[gather], total[np.searchsorted(start, flat.first)]

    @property
    def closing(self) -> np.ndarray:
        return self.words.closing


def _is_word_bpe(stated: dict) -> bool:
    steps = [x.get("type") for x in (stated.get("normalizer") or {}).get("normalizers", [])]
    cuts = (stated.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = stated["model"]
    return (steps == WORD_NORMALIZERS and len(cuts) == 2 and cuts[0].get("pattern") == {"Regex": WORD_PATTERN} and cuts[1].get("type") == "ByteLevel"
            and model.get("end_of_word_suffix") == "</w>" and not model.get("continuing_subword_prefix") and not model.get("dropout"))


def _word_encoder(stated: dict):
    """The vocabulary as ranked bytes, with a blank in place of the word end: no word holds a blank."""
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    back = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    special = {x["content"] for x in stated["added_tokens"]}
    ranks = {}
    for token, rank in stated["model"]["vocab"].items():
        if token not in special:
            closed = token.endswith("</w>") and len(token) > 4
            ranks[bytes(back[c] for c in (token[:-4] if closed else token)) + b" " * closed] = rank
    encoder = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
    encoder.closing = np.zeros(max(ranks.values()) + 1, bool)
    encoder.closing[[rank for token, rank in ranks.items() if token.endswith(b" ") and len(token) > 1]] = True
    return encoder


def _odd_texts(flat: Flat) -> np.ndarray:
    """Texts with other characters, with an apostrophe before a letter, or with what may be a special token."""
    raw = flat.raw
    odd = ~_PLAIN[raw]
    if len(raw) > 1:
        after = raw[1:]
        odd[:-1] |= (raw[:-1] == 0xC3) & ((after == 0x97) | (after == 0xB7))
        odd[:-1] |= (raw[:-1] == 39) & (_CLASS[after] == 1)
        odd[:-1] |= (raw[:-1] == 60) & (after == 124)
    return np.unique(np.searchsorted(flat.first, np.flatnonzero(odd), side="right") - 1)


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)
