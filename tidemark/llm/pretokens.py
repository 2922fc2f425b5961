"""What the byte-level BPE operators share: the vocabulary file and the split before merging."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from typing import NamedTuple

import regex

# Code points that the installed `regex` knows as letters or numbers but that the
# tokenizer library's Unicode tables (version 16) leave unassigned. There they count as neither.
_NEWER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf"
    "\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7"
    "\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1"
    "\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2"
    "\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    "\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f"
)


def _patterns(letter: str, number: str, other: str) -> dict[str, regex.Pattern]:
    """The split itself, and per kind of run a pattern that follows one that is still open."""
    # The split is a fixed value of the vocabulary format.
    split = rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+"
    runs = {"split": split, "letter": f"{letter}+", "number": f"{number}+", "other": f"{other}+"}
    runs["space"] = r"\s+"
    return {name: regex.compile(p, regex.V1) for name, p in runs.items()}


_USUAL = _patterns(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
_CAREFUL = _patterns(
    rf"[\p{{L}}--[{_NEWER}]]",
    rf"[\p{{N}}--[{_NEWER}]]",
    rf"(?:[^\s\p{{L}}\p{{N}}]|[{_NEWER}])",
)
_maybe_newer = re.compile("[\u0558-\U0010ffff]").search
_has_newer = regex.compile(f"[{_NEWER}]").search


def patterns(text: str) -> dict[str, regex.Pattern]:
    newer = not text.isascii() and _maybe_newer(text) and _has_newer(text)
    return _CAREFUL if newer else _USUAL


class Vocabulary(NamedTuple):
    ids: dict[bytes, int]
    merges: list[tuple[bytes, bytes]]
    special: dict[str, int]


def _byte_of_char() -> dict[str, int]:
    """The format writes each byte as a printable character, those without one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {chr(b): b for b in shown}
    return table | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file; refuse one whose rules these operators do not implement."""
    with open(path, encoding="utf-8") as source:
        stored = json.load(source)
    model, split = stored["model"], stored["pre_tokenizer"]
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback"))
        and not model.get("ignore_merges")
        and stored["normalizer"] is None
        and split["type"] == "ByteLevel"
        and split["use_regex"]
        and not split["add_prefix_space"]
    )
    added = stored["added_tokens"]
    if not plain or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    if any(a["normalized"] for a in added) or len(added) > 1:
        raise ValueError("one added token, matched before normalisation, is supported")
    byte = _byte_of_char()
    special = {a["content"]: a["id"] for a in added}
    ids = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = [tuple(bytes(map(byte.__getitem__, t)) for t in pair) for pair in pairs]
    made = {t for t in ids if len(t) == 1}
    for left, right in merges:
        if left not in made or right not in made or left + right not in ids:
            raise ValueError("a merge uses a token that no earlier merge makes")
        made.add(left + right)
    return Vocabulary(ids, merges, special)


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes behind a token that settle it, whatever follows them.

    A merge (u, v) takes part in a change that later bytes cause if v starts where the change
    has reached so far, and it carries the change back by the length of u. The next merge of
    the chain has a higher rank and a right part with u on the left edge of its derivation.
    The result is the length of the longest chain.
    """
    edge: dict[bytes, tuple[bytes, ...]] = {}  # a token's left edge, from its first byte on
    reach: dict[bytes, int] = {}  # of the merges so far with this left part, the longest chain
    longest = 0
    for left, right in merges:
        for part in (left, right):
            if len(part) == 1:
                edge.setdefault(part, (part,))
        chain = len(left) + max(reach.get(t, 0) for t in edge[right])
        reach[left] = max(reach.get(left, 0), chain)
        longest = max(longest, chain)
        edge.setdefault(left + right, (*edge[left], left + right))
    return longest


def between_specials(text: str, special: dict[str, int]) -> list[str]:
    """The texts before, between and after the special token's occurrences."""
    return text.split(next(iter(special))) if special else [text]
