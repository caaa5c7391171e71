"""A word-level BPE vocabulary file and its pre-tokenisation, as the public tokenizers library reads it.

The file names a normaliser (NFC, white space, lower case), a splitting pattern, a byte alphabet and
ranked merges with a word-end suffix.  Everything happens inside stretches without white space
("chunks"), so results are computed once per distinct chunk and kept in a cache of bounded size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex

#: Characters Python's str.split() takes for white space and the pattern's ``\s`` doesn't.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE_RUN = re.compile("[\t-\r \x85\xa0  -     　]+")


def byte_alphabet() -> list[str]:
    """Printable stand-ins for the 256 byte values: printable bytes stand for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merges, ids and splitting rules of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens: list[str] = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        #: (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        alphabet = byte_alphabet()
        self.inner = np.array([self.ids[c] for c in alphabet], dtype=np.int64)
        self.final = np.array([self.ids[c + self.suffix] for c in alphabet], dtype=np.int64)
        names = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, names))) if names else None

    def pieces(self, chunk: str) -> list[bytes]:
        """Pre-tokens of one chunk, as UTF-8."""
        if not chunk.isascii():
            # per character, as the library does: no final-sigma rule
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return [p.encode("utf-8", "surrogatepass") for p in self.pattern.findall(chunk.lower())]

    def symbols(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths): what pre-tokens start from, end to end: one id a byte, each last one with the word end."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        out = self.inner[data]
        last = np.cumsum(lengths) - 1
        out[last] = self.final[data[last]]
        return out, lengths

    def distinct_pieces(self, chunks: list[str]) -> tuple[list[bytes], list[int], list[int]]:
        """(distinct pre-tokens, place of each pre-token among them, pre-tokens of each chunk)."""
        places: dict[bytes, int] = {}
        order: list[int] = []
        sizes: list[int] = []
        for chunk in chunks:
            own = self.pieces(chunk)
            sizes.append(len(own))
            for p in own:
                order.append(places.setdefault(p, len(places)))
        return list(places), order, sizes

    def parts(self, text: str) -> list[str | int]:
        """A text as chunks and, where special strings stand, their ids."""
        if self.specials is None or "<" not in text or not self.specials.search(text):
            return split_space(text)
        out: list[str | int] = []
        at = 0
        for m in self.specials.finditer(text):
            out += split_space(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + split_space(text[at:])


class PairTable:
    """Merge ranks by pair, looked up for whole arrays."""

    def __init__(self, vocab: Vocabulary):
        keys = np.array([(a << 32) | b for a, b in vocab.merges], dtype=np.int64)
        made = np.array(list(vocab.merges.values()), dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], made[order, 0]
        self.made = np.zeros(int(self.ranks.max()) + 1 if len(keys) else 1, dtype=np.int64)
        self.made[made[:, 0]] = made[:, 1]
        self.by_pair = dict(zip(keys.tolist(), made[:, 0].tolist(), strict=True))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NO_RANK`` where it doesn't merge."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)


NO_RANK = np.int64(1) << 30


def split_space(text: str) -> list[str]:
    if _ODD_SPACE.search(text):
        return [x for x in _SPACE_RUN.split(text) if x]
    return text.split()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read once per Python worker."""
    return Vocabulary(path)


class TwoGenerations:
    """A cache that holds between ``size`` and twice as many of the entries used last."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys) -> list:
        """Bring known keys to the young generation; the distinct rest is returned."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        absent = []
        for k in set(keys).difference(young):
            v = old.get(k)
            if v is None:
                absent.append(k)
            else:
                young[k] = v
        return absent
