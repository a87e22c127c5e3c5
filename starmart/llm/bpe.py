"""Byte-level BPE: two-tier lookup, exact decoding (operator 5).

A text is cut into pre-tokens by the pattern of the vocabulary. Tier one: a
minimal perfect hash over the vocabulary resolves a pre-token that is an entry
as a whole. Tier two: a miss is merged pair by pair, lowest rank first, with a
heap over a linked list of its bytes. The results of recent pre-tokens are kept
in a memo of bounded size.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterable

import numpy as np
import regex

MEMO_ENTRIES = 300_000
# Longer pre-tokens are not worth remembering.
MEMO_CHARS = 64


class PerfectHash:
    """Minimal perfect hash of byte strings: as many slots as keys.

    Keys fall into buckets by a first hash. Large buckets first, each bucket
    gets the smallest seed that sends its keys to free slots by a second hash.
    A bucket of one key is given any slot that is left: a negative seed names it.
    """

    LOAD = 3

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.buckets = max(1, self.size // self.LOAD)
        self.seeds = np.zeros(self.buckets, np.int64)
        self.slots: list[int] = [-1] * self.size
        self.keys = keys
        grouped: dict[int, list[int]] = {}
        codes = [self._code(k) for k in keys]
        for i, code in enumerate(codes):
            grouped.setdefault(code % self.buckets, []).append(i)
        free = 0
        for bucket, members in sorted(grouped.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                while self.slots[free] >= 0:
                    free += 1
                self.slots[free] = members[0]
                self.seeds[bucket] = -1 - free
                continue
            seed = 0
            while True:
                places = [self._place(codes[i], seed) for i in members]
                if len(set(places)) == len(places) and all(self.slots[p] < 0 for p in places):
                    break
                seed += 1
            self.seeds[bucket] = seed
            for place, i in zip(places, members, strict=True):
                self.slots[place] = i
        self._seed_list = self.seeds.tolist()

    @staticmethod
    def _code(key: bytes) -> int:
        """Of this process only: a table is built where it is used."""
        return hash(key) & 0xFFFFFFFFFFFFFFFF

    def _place(self, code: int, seed: int) -> int:
        if seed < 0:
            return -1 - seed
        x = (code ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 29)) % self.size

    def find(self, key: bytes) -> int | None:
        """The number of the key, None for a string that is none."""
        if not self.size:
            return None
        code = self._code(key)
        i = self.slots[self._place(code, self._seed_list[code % self.buckets])]
        return i if self.keys[i] == key else None


def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Entries of a rank file: base64 of the bytes, blank, rank."""
    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


# The pattern over texts of these characters only, in classes that the standard
# library matches faster; equal to the general pattern there.
_PLAIN = re.compile(r"[\t\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PLAIN_TOKENS = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)|\x20?[A-Za-zÀ-ÖØ-öø-ÿ]+|\x20?[0-9]+"
    r"|\x20?[^\s0-9A-Za-zÀ-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"
)


class Memo(dict):
    """Results by pre-token in two generations of at most ``most`` entries: a
    full one becomes the old one, and what is asked for again moves back."""

    def __init__(self, make: Callable[[str], str | bytes], most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, token: str) -> str | bytes:
        found = self.old.get(token)
        if found is None:
            found = self.make(token)
        if len(token) <= MEMO_CHARS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[token] = found
        return found


class Tokenizer:
    """Encodes and decodes by ``ranks``; ``pattern`` cuts the pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO_ENTRIES):
        self.ranks = ranks
        self.names = {rank: token for token, rank in ranks.items()}
        entries = list(ranks)
        self._entry_ranks = [ranks[e] for e in entries]
        self._whole = PerfectHash(entries)
        self._cut = regex.compile(pattern).findall
        self._ids = Memo(self._ids_text, memo)
        self._bytes = Memo(self._decoded, memo)
        # The fast cut holds for this pattern alone.
        self._plain = pattern == _KNOWN_PATTERN

    def pre_tokens(self, text: str) -> list[str]:
        if self._plain and _PLAIN.fullmatch(text):
            return _PLAIN_TOKENS.findall(text)
        return self._cut(text)

    def encode_piece(self, piece: bytes) -> list[int]:
        found = self._whole.find(piece)
        return [self._entry_ranks[found]] if found is not None else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Merges the pair of lowest rank, leftmost first, until none is left.
        The heap holds rank and start of each pair; an entry whose pair has
        changed since is skipped. Linear space, n log n time."""
        rank_of, n = self.ranks.get, len(piece)
        # Per part, by its start: where it ends, where the part before starts,
        # and the rank of the pair that it begins (-1: none, or merged away).
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n)]
        pair[-1] = -1
        heap = [rank * n + i for i, rank in enumerate(pair) if rank >= 0]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            if pair[i] != rank:
                continue
            middle = after[i]
            end = after[i] = after[middle]
            pair[middle] = pair[i] = -1
            if end < n:
                before[end] = i
                rank = pair[i] = rank_of(piece[i : after[end]], -1)
                if rank >= 0:
                    heapq.heappush(heap, rank * n + i)
            if i:
                i = before[i]
                rank = pair[i] = rank_of(piece[i:end], -1)
                if rank >= 0:
                    heapq.heappush(heap, rank * n + i)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.names[i] for i in ids])

    def _ids_text(self, token: str) -> str:
        return " ".join(map(str, self.encode_piece(token.encode("utf-8", "surrogatepass"))))

    def _decoded(self, token: str) -> bytes:
        return self.decode(map(int, self._ids[token].split()))

    def encoded(self, text: str | None) -> tuple[str, int, bytes]:
        """Ids of the whole text joined by blanks, their number, and the bytes
        that the ids decode to. Null counts as empty."""
        if not text:
            return "", 0, b""
        tokens = self.pre_tokens(text)
        ids = " ".join(map(self._ids.__getitem__, tokens))
        decoded = b"".join(map(self._bytes.__getitem__, tokens))
        return ids, ids.count(" ") + 1, decoded

    def encode(self, text: str | None) -> list[int]:
        ids = self.encoded(text)[0]
        return [int(i) for i in ids.split()]


# Fixed value: the pattern of the public vocabularies.
_KNOWN_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
