"""Token counts: byte-level BPE by rank-synchronous merging of ragged numpy arrays.

A slice of texts is split into pre-tokens; the distinct ones not counted before are laid out
as one flat array of symbols with the number of the pre-token beside each. In every round each
pre-token finds the lowest rank among its neighbouring pairs and merges all pairs of that rank
at once; pre-tokens without a pair leave the arrays. What remains of a pre-token is its count.

Any two occurrences of a pair merge independently of order unless they overlap, which only a
run of one symbol can do; there every second pair from the left merges, as a left-to-right
scan would. A merge list in which every part is made by an earlier merge cannot create a pair
of lower rank than the one applied, so rounds reach the same symbols as merging one by one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pretokens import (
    between_specials,
    patterns,
    sufficient_lookahead,
    vocabulary,
)
from tidemark.llm.texts import map_texts

# Counts a Python worker remembers, about 150 bytes each.
REMEMBERED = 300_000
# Pre-token bytes merged at once, and the longest pre-token worth remembering.
MERGED_BYTES = 1 << 20
LONGEST_REMEMBERED = 256
# Bytes of a longer pre-token that are settled in one turn.
WINDOW = 4096

_NONE = np.iinfo(np.int64).max
_EMPTY = np.uint64(np.iinfo(np.uint64).max)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """Ranks and results of symbol pairs, in a hash table that looks up whole arrays."""

    def __init__(self, path: str):
        held = vocabulary(path)
        left = np.array([held.ids[a] for a, _ in held.merges], np.uint64)
        right = np.array([held.ids[b] for _, b in held.merges], np.uint64)
        self.result = np.array([held.ids[a + b] for a, b in held.merges], np.int64)
        self.byte = np.array([held.ids[bytes([b])] for b in range(256)], np.int64)
        self.length = np.zeros(1 + max(held.ids.values()), np.int64)
        for token, i in held.ids.items():
            self.length[i] = len(token)
        self.special = held.special
        self.lookahead = sufficient_lookahead(held.merges)
        self.width = max(4, (8 * len(left) + 1).bit_length())
        self.keys = np.full(1 << self.width, _EMPTY)
        self.ranks = np.full(1 << self.width, _NONE)
        keys, todo = self._key(left, right), np.arange(len(left))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == _EMPTY
            first = np.unique(slot[todo[free]], return_index=True)[1]
            placed = todo[free][first]
            self.keys[slot[placed]] = keys[placed]
            self.ranks[slot[placed]] = placed
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) % len(self.keys)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.width)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        slot = self._slot(keys)
        there = self.keys[slot]
        rank = np.where(there == keys, self.ranks[slot], _NONE)
        todo = np.flatnonzero((there != keys) & (there != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % len(self.keys)
            there = self.keys[slot[todo]]
            found = there == keys[todo]
            rank[todo[found]] = self.ranks[slot[todo[found]]]
            todo = todo[~found & (there != _EMPTY)]
        return rank

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbol = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(symbol), _NONE)  # of each symbol's pair with the next one
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.of(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(symbol)])
            lowest = np.repeat(np.minimum.reduceat(rank, first), size)
            stays = lowest != _NONE
            if not stays.all():
                done.append((owner[~stays], symbol[~stays]))
            at = _without_overlaps(np.flatnonzero(stays & (rank == lowest)))
            symbol[at] = self.result[rank[at]]
            stays[at + 1] = False
            new = (np.cumsum(stays) - 1)[at]
            symbol, owner, rank = symbol[stays], owner[stays], rank[stays]
            changed = np.r_[new, new[new > 0] - 1]
            rank[changed] = _NONE
            changed = changed[changed + 1 < len(owner)]
            changed = changed[owner[changed] == owner[changed + 1]]
            rank[changed] = self.of(symbol[changed], symbol[changed + 1])
        if not done:
            return symbol, sizes
        owners, ids = (np.concatenate(x) for x in zip(*done))
        return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(pieces))

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each piece once no pair can merge.

        Of a piece longer than a window only the part that the rest cannot change is counted
        in a turn, so the rounds of a turn stay bounded whatever the piece.
        """
        window = WINDOW + self.lookahead
        total = np.zeros(len(pieces), np.int64)
        rest, owner = pieces, np.arange(len(pieces))
        while rest:
            parts = [p[:window] for p in rest]
            ids, sizes = self.merged(parts)
            total[owner] += sizes
            longer = [i for i, p in enumerate(rest) if len(p) > window]
            if not longer:
                break
            start = np.r_[0, np.cumsum(sizes)]
            left = []
            for i in longer:
                ends = np.cumsum(self.length[ids[start[i] : start[i + 1]]])
                stable = int(np.searchsorted(ends, WINDOW, "right"))
                total[owner[i]] -= sizes[i] - stable
                left.append(rest[i][ends[stable - 1] :])
            rest, owner = left, owner[longer]
        return total


def _without_overlaps(at: np.ndarray) -> np.ndarray:
    """Of positions that follow each other directly, every second one from the first."""
    run_start = np.r_[True, np.diff(at) > 1]
    if run_start.all():
        return at
    place = np.arange(len(at))
    within = place - np.maximum.accumulate(np.where(run_start, place, 0))
    return at[within % 2 == 0]


@lru_cache(maxsize=2)
def _ranks(path: str) -> tuple[Ranks, dict[str, int]]:
    return Ranks(path), {}


def counter(path: str):
    """A function from texts to [bytes, tokens] of each; counts are remembered per worker."""
    ranks, known = _ranks(path)

    def count_new(pieces: list[str], into: dict[str, int]) -> None:
        start = 0
        encoded = [p.encode() for p in pieces]
        while start < len(encoded):
            end, held = start, 0
            while end < len(encoded) and (end == start or held < MERGED_BYTES):
                held += len(encoded[end])
                end += 1
            into.update(zip(pieces[start:end], ranks.counts(encoded[start:end]).tolist()))
            start = end

    def tokens(texts: list) -> list:
        if len(known) > REMEMBERED:
            known.clear()
        sizes, totals = [], []
        split: list[list[str]] = []
        missing: set[str] = set()
        for text in texts:
            text = text or ""
            parts = between_specials(text, ranks.special)
            found: list[str] = []
            for part in parts:
                found += patterns(part)["split"].findall(part)
            sizes.append(len(text.encode()))
            totals.append(len(parts) - 1)
            split.append(found)
            missing.update(found)
        here = {p: known[p] for p in missing if p in known}
        new = [p for p in missing if p not in here]
        count_new(new, here)
        for row, found in enumerate(split):
            totals[row] += sum(map(here.__getitem__, found))
        known.update((p, here[p]) for p in new if len(p) <= LONGEST_REMEMBERED)
        return [sizes, totals]

    return tokens


def token_counts(
    documents: DataFrame,
    vocabulary_path: str,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    Tokens are those of the library's `encode` without added tokens; the special token's
    string inside a text is that one token, the library's default. A null or empty text has
    no bytes and no tokens. Rows are counted one by one: ties, repeated rows and null ids
    come out as they came in, an empty table gives no rows, other columns are not read.
    `vocabulary_path` must name the same file on every executor.
    """
    counted = map_texts(
        documents,
        [id_col],
        text_col,
        lambda: counter(vocabulary_path),
        "n_bytes long, n_tokens long",
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
