"""Quality rules: base counts of a text, then compression bands.

A text that passes the base rules is compressed with zstandard, as a whole and in chunks of
fixed size. The compressed size over the size in bytes must lie in a band that depends on the
size: short inputs compress worse, headers and the lack of context weigh more. Below the band
a text repeats itself, above it it is noise (encoded binaries, random strings). The whole text
shows repetition over long distances; a chunk shows a repetitive or incompressible passage
inside an otherwise ordinary text, which is rejected when such chunks make up too large a
share of all chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import SPACES, map_texts

SYMBOLS = "#*$%&|<>"
_DROP_SPACES = str.maketrans("", "", SPACES)
_DROP_SYMBOLS = str.maketrans("", "", SYMBOLS)


@dataclass(frozen=True)
class Band:
    """Least and most compressed size over size, for inputs of at least `from_bytes` bytes.

    `most_wide` is the most for texts of many code points beyond one byte: their characters
    are many, so short texts compress worse than Latin ones.
    """

    from_bytes: int
    least: float
    most: float
    most_wide: float


@dataclass(frozen=True)
class Rules:
    """Limits of the base rules and of the compression bands (smallest first)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3
    chunk_bytes: int = 4096
    bands: tuple[Band, ...] = (
        # Most: a little above the highest ratio of natural text cut at the band's first byte.
        Band(0, 0.0, 1.20, 1.20),
        Band(192, 0.36, 0.92, 1.10),
        Band(256, 0.25, 0.83, 1.06),
        Band(512, 0.25, 0.75, 0.92),
        Band(1024, 0.20, 0.68, 0.80),
        Band(2048, 0.20, 0.60, 0.68),
        Band(4096, 0.17, 0.56, 0.60),
        Band(32768, 0.12, 0.50, 0.50),
    )
    wide_from: float = 1.1
    max_bad_chunks: float = 0.25

    def within(self, compressed: int, size: int, wide: bool = False) -> bool:
        band = max((b for b in self.bands if b.from_bytes <= size), key=lambda b: b.from_bytes)
        return band.least * size <= compressed <= (band.most_wide if wide else band.most) * size

    def is_wide(self, data: bytes) -> bool:
        """Whether the bytes per code point are at least `wide_from`."""
        points = np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
        return len(data) >= self.wide_from * points


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    encoded = text.encode()
    words = encoded.split()  # bytes split at exactly the six blanks
    word_chars = len(text.translate(_DROP_SPACES))
    symbols = len(text) - len(text.translate(_DROP_SYMBOLS))
    seen: set[bytes] = set()
    repeated = 0
    for line in encoded.split(b"\n"):
        if line in seen:
            repeated += not not line.split()
        else:
            seen.add(line)
    return len(words), word_chars, symbols, repeated, _repeated_windows(words)


def _repeated_windows(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three numbers would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    starts = np.zeros(len(words), bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = starts.copy()
    covered[1:] |= starts[:-1]
    covered[2:] |= starts[:-2]
    return int(covered.sum())


def chunks(data: bytes, size: int) -> list[bytes]:
    """Chunks of `size` bytes; a rest of less than half of that belongs to the last chunk."""
    whole = max(1, (len(data) + size // 2) // size)
    return [data[i * size : (i + 1) * size] for i in range(whole - 1)] + [data[(whole - 1) * size :]]


def ratios(text: str, rules: Rules, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole, share of chunks outside their band, and the verdict of the bands."""
    data = text.encode()
    if not data:
        return 0.0, 0.0, False
    whole = len(packer.compress(data))
    cuts = chunks(data, rules.chunk_bytes)
    if len(cuts) > 1:
        sizes = [len(packer.compress(c)) for c in cuts]
        bad = sum(
            not rules.within(s, len(c), rules.is_wide(c)) for s, c in zip(sizes, cuts)
        ) / len(cuts)
        inside = rules.within(whole, len(data), rules.is_wide(data))
    else:
        inside = rules.within(whole, len(data), rules.is_wide(data))
        bad = float(not inside)
    inside = inside and bad <= rules.max_bad_chunks
    return whole / len(data), bad, inside


def _judge(rules: Rules):
    def make():
        packer = zstandard.ZstdCompressor(level=rules.level, write_checksum=False)

        def judge(texts: list) -> list:
            rows = []
            for text in texts:
                counts = base_counts(text or "")
                failed = (
                    counts[0] < rules.min_words
                    or 100 * counts[4] > rules.max_repeat_percent * counts[0]
                )
                whole, bad, inside = ratios(text or "", rules, packer)
                rows.append((*counts, failed, not failed and inside, whole, bad))
            return [list(column) for column in zip(*rows)]

        return judge

    return make


def quality_rules(
    documents: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    ratio, bad_chunks) of every row.

    A null or empty text has no words, so it fails the base rules; its ratio is 0. Rows are
    judged one by one over their whole text: repeated rows and null ids come out as they came
    in, an empty table gives no rows, other columns are not read.
    """
    return map_texts(
        documents,
        [id_col],
        text_col,
        _judge(rules),
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, bad_chunks double",
    )


def keep_passing(
    documents: DataFrame, rules: Rules = Rules(), text_col: str = "text"
) -> DataFrame:
    """The rows, all columns, whose text the rules keep; one pass, no join."""

    @F.pandas_udf("boolean")
    def kept(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        judge = _judge(rules)()
        for texts in parts:
            rows = texts.tolist()
            yield pd.Series(judge(rows)[6] if rows else [], dtype=bool)

    return documents.where(kept(F.col(f"`{text_col}`")))
