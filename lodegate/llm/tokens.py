"""Token ids of many texts by a byte-level BPE file, one call of the tokenizer per new word.

The tokenizer's first step splits a text by a fixed pattern: contractions, letters, numbers and
other marks, each with one space before them, and runs of white space. That step runs here on
arrays of code points; each distinct piece goes to the `tokenizers` library once per worker while
it stays in a cache of bounded size. Texts with code points beyond the class table go to the
library whole. Ids are those of encode(text, add_special_tokens=False), except that the string of
a special token inside a text also goes the whole way.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

from lodegate.llm.arrays import mix, powers, stream

TOKENIZER = "byte_bpe_50k.json"
_TABLE = 0x3000
_SLOTS, _INLINE = 1 << 20, 6
_BLOCK = 1 << 20
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
# Unicode white space.
_BLANKS = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(_TABLE)], dtype=np.uint8)
    table[[c for c in _BLANKS if c < _TABLE]] = _SPACE
    # Unassigned code points may be letters to the library's tables.
    table[[c for c in range(_TABLE) if unicodedata.category(chr(c)) == "Cn"]] = 255
    return table


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}


def split_points(points: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin; ``first`` flags the first code point of each text."""
    n = points.size
    new = first.copy()
    new[1:] |= kinds[1:] != kinds[:-1]
    starts = new.copy()
    space = kinds == _SPACE
    # A space run before something else gives up its last code point: a space joins what
    # follows, anything else stands alone.
    at = np.flatnonzero(new[1:] & ~first[1:] & space[:-1]) + 1
    starts[at - 1] = True
    starts[at[points[at - 1] == 32]] = False
    # An apostrophe alone takes the letters of a contraction with it.
    quotes = np.flatnonzero(starts & (points == 39))
    quotes = quotes[quotes + 1 < n]
    quotes = quotes[new[quotes + 1] & (kinds[quotes + 1] == _LETTER) & ~first[quotes + 1]]
    for letters in _CONTRACTIONS:
        hit = quotes[quotes + len(letters) < n]
        for k, letter in enumerate(letters, 1):
            hit = hit[points[hit + k] == ord(letter)]
            if k > 1:
                hit = hit[~new[hit + k]]
        starts[hit + 1] = False
        after = hit + 1 + len(letters)
        starts[after[after < n]] = True
    return np.flatnonzero(starts)


class Encoder:
    """Token ids of texts; keeps a direct-mapped cache of pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        config = json.loads(self.library.to_str())
        splitter = config.get("pre_tokenizer") or {}
        self.by_piece = (
            splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
            and not config.get("normalizer") and config["model"].get("type") == "BPE"
        )
        specials = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.keys = np.zeros(_SLOTS, dtype=np.uint64)
        self.sizes = np.zeros(_SLOTS, dtype=np.uint8)
        self.ids = np.zeros((_SLOTS, _INLINE), dtype=np.uint32)
        self.values = stream(4242, _TABLE)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts, owners = [], []
        for k, text in enumerate(texts):
            at = 0
            while len(text) - at > _BLOCK and (cut := _SAFE_CUT.search(text, at + _BLOCK)):
                parts.append(text[at : cut.start()])
                owners.append(k)
                at = cut.start()
            parts.append(text[at:] if at else text)
            owners.append(k)
        encoded, low = [], 0
        while low < len(parts):
            high, size = low + 1, len(parts[low])
            while high < len(parts) and size + len(parts[high]) <= _BLOCK:
                size += len(parts[high])
                high += 1
            encoded += self._encode_parts(parts[low:high])
            low = high
        if len(parts) == len(texts):
            return encoded
        joined: list[list[np.ndarray]] = [[] for _ in texts]
        for owner, ids in zip(owners, encoded):
            joined[owner].append(ids)
        return [ids[0] if len(ids) == 1 else np.concatenate(ids) for ids in joined]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _piece(self, word: str) -> list[int]:
        letters = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(_byte_letters())
        return [token.id for token in self.library.model.tokenize(letters)]

    def _encode_parts(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_piece:
            return [self._whole(text) for text in texts]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
        table = _classes()
        odd = points >= _TABLE
        kinds = table[np.where(odd, 0, points)]
        odd |= kinds == 255
        hits = np.concatenate([[0], np.cumsum(odd)])
        whole = hits[bounds[1:]] > hits[bounds[:-1]]
        if self.special is not None:
            whole |= np.array([bool(self.special.search(text)) for text in texts])
        out: list[np.ndarray | None] = [self._whole(text) if own else None for text, own in zip(texts, whole)]
        plain = np.flatnonzero(~whole)
        if plain.size:
            if whole.any():
                keep = np.repeat(~whole, np.diff(bounds))
                points, kinds = points[keep], kinds[keep]
                bounds = np.concatenate([[0], np.cumsum(np.diff(bounds)[plain])])
            for k, ids in zip(plain, self._encode_plain(points, kinds, bounds)):
                out[k] = ids
        return out

    def _encode_plain(self, points: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        if not points.size:
            return [np.zeros(0, dtype=np.uint32)] * (bounds.size - 1)
        first = np.zeros(points.size + 1, dtype=bool)
        first[bounds] = True
        starts = split_points(points, kinds, first[:-1])
        ends = np.append(starts[1:], points.size)
        up, down = powers(points.size + 1)
        sums = np.zeros(points.size + 1, dtype=np.uint64)
        np.cumsum(self.values[points] * up[: points.size], out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts]) | np.uint64(1)
        slots = (keys >> np.uint64(64 - _SLOTS.bit_length() + 1)).astype(np.int64)
        sizes = np.zeros(keys.size, dtype=np.int64)
        missing = np.flatnonzero(self.keys[slots] != keys)
        if missing.size:
            _, where, inverse = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[where]
            string = points.tobytes().decode("utf-32-le", "surrogatepass")
            new = [self._piece(string[s:e]) for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            counts = np.array([len(ids) for ids in new])
            sizes[missing] = counts[inverse]
        found = np.ones(keys.size, dtype=bool)
        found[missing] = False
        sizes[found] = self.sizes[slots[found]]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.empty(offsets[-1], dtype=np.uint32)
        hit = np.flatnonzero(found)
        for k in range(_INLINE):
            hit = hit[sizes[hit] > k]
            flat[offsets[hit] + k] = self.ids[slots[hit], k]
        if missing.size:
            held = np.concatenate([[0], np.cumsum(counts)])
            values = np.fromiter((x for ids in new for x in ids), dtype=np.uint32, count=held[-1])
            own = sizes[missing]
            step = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            flat[np.repeat(offsets[missing], own) + step] = values[np.repeat(held[inverse], own) + step]
            short = np.flatnonzero(counts <= _INLINE)
            slot = slots[at[short]]
            self.keys[slot], self.sizes[slot] = keys[at[short]], counts[short]
            # Where two new pieces share a slot, neither keeps it.
            for k in range(_INLINE):
                more = counts[short] > k
                self.ids[slot[more], k] = values[held[short[more]] + k]
            clash = self.keys[slot] != keys[at[short]]
            if clash.any():
                self.keys[slot[clash]] = 0
        cuts = offsets[np.searchsorted(starts, bounds)]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)
