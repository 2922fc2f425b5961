"""Quality classifier: sizes under two zstandard dictionaries, one of good, one of bad text.

Both dictionaries are trained on labelled text. A text is cut into chunks, small enough that a
dictionary matters in each; every chunk is compressed with either dictionary. From the summed
sizes G and B come the normalised differences (B - G) / bytes and (B - G) / (B + G), and the
ratio G / bytes that tells how much a difference means. A logistic model, fitted to labelled
texts the dictionaries have not seen, turns them into the probability of the good label.

The fit takes a bounded sample: `Sample` limits the rows per class and the characters per row; of
a longer text it takes pieces spread evenly from its first character to its last. Everything
else, all scoring, covers every row and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import map_texts

# Characters of a piece of a text that is too long for the sample.
PIECE = 1000


@dataclass(frozen=True)
class Sample:
    """Bounds of what is brought to the driver to fit a model."""

    rows_per_class: int = 1500
    characters: int = 20_000


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the calibration; `weights` is None where a class had no rows."""

    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...] | None
    prior: float
    chunk_bytes: int
    level: int


def spread(text: Column, most: int) -> Column:
    """A text of up to `most` characters; of a longer one pieces from its start to its end."""
    count = max(2, most // PIECE)
    last = F.char_length(text) - PIECE

    def piece(number: Column) -> Column:
        start = F.floor(number * last / (count - 1)).cast("int") + 1
        return F.substr(text, start, F.lit(PIECE))

    pieces = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), piece)
    return F.when(F.char_length(text) <= most, text).otherwise(F.array_join(pieces, ""))


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    sample: Sample,
    id_col: str,
    text_col: str,
    label_col: str,
) -> tuple[list[str], list[str]]:
    """Texts labelled 1 and texts labelled 0, the same ones on every run.

    Ids with a null or with both labels are left out. Ids are chosen in the order of a hash,
    per class by a top-k over the labels, and only their texts are brought along. Labels whose
    id has no document count towards the rows of a class, so several times the rows are chosen
    first and cut afterwards.
    """
    labels = labels.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").alias("y"))
    clear = (
        labels.where("i IS NOT NULL AND y IN (0, 1)")
        .groupBy("i")
        .agg(F.min("y").alias("y"), F.max("y").alias("z"))
        .where("y = z")
    )
    chosen = []
    for value in (1, 0):
        first = clear.where(F.col("y") == value).orderBy(F.xxhash64("i"), "i")
        chosen += first.select("i", "y").limit(2 * sample.rows_per_class).collect()
    spark = documents.sparkSession
    wanted = spark.createDataFrame(chosen, clear.select("i", "y").schema)
    texts = documents.select(
        F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")
    ).where("t IS NOT NULL")
    # At most four times rows_per_class ids.
    rows = (
        texts.join(F.broadcast(wanted), "i")
        .select("i", "y", spread(F.col("t"), sample.characters).alias("t"))
        .orderBy(F.xxhash64("i"), "i", "t")
    )
    found: dict[int, list[str]] = {0: [], 1: []}
    for value in (0, 1):
        part = rows.where(F.col("y") == value).limit(sample.rows_per_class)
        found[value] = [row.t for row in part.collect()]
    return found[1], found[0]


def _dictionary(texts: list[str], size: int, chunk_bytes: int) -> bytes:
    cuts = [c for t in texts for c in _chunks(t.encode(), chunk_bytes) if c]
    try:
        return zstandard.train_dictionary(size, cuts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: use it as it is
        return b"".join(cuts)[-size:]


def _chunks(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


class _Features:
    """Compressed-size features of texts under a model's dictionaries."""

    def __init__(self, good: bytes, bad: bytes, chunk_bytes: int, level: int):
        self.chunk_bytes = chunk_bytes
        self.packers = []
        for content in (good, bad):
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=level)
            self.packers.append(
                zstandard.ZstdCompressor(
                    level=level, dict_data=held, write_checksum=False,
                    write_content_size=False, write_dict_id=False,
                )
            )

    def __call__(self, texts: list[str]) -> np.ndarray:
        sizes = []
        good, bad = (p.compress for p in self.packers)
        for text in texts:
            data = text.encode()
            cuts = _chunks(data, self.chunk_bytes) or [b""]
            sizes.append(
                (sum(len(good(c)) for c in cuts), sum(len(bad(c)) for c in cuts), len(data))
            )
        g, b, n = np.array(sizes, float).reshape(-1, 3).T
        n = np.maximum(n, 1)
        return np.c_[(b - g) / n, (b - g) / (b + g), g / n]


def _logistic(features: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.c_[features, np.ones(len(features))]
    weights, ridge = np.zeros(x.shape[1]), 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, x.T @ (label - p) - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(
    documents: DataFrame,
    labels: DataFrame,
    sample: Sample = Sample(),
    dictionary_bytes: int = 65_536,
    chunk_bytes: int = 1024,
    level: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Fit on the rows of `labels`; take out rows that must not be learnt from beforehand.

    Of each class every second sampled text goes into the dictionary, the others into the
    calibration. Only ids, texts and labels are read, and ids only to join.
    """
    good, bad = labelled_sample(documents, labels, sample, id_col, text_col, label_col)
    prior = len(good) / (len(good) + len(bad)) if good or bad else 0.5
    if len(good) < 2 or len(bad) < 2:
        return Model(b"", b"", (), (), None, prior, chunk_bytes, level)
    dictionaries = [_dictionary(t[::2], dictionary_bytes, chunk_bytes) for t in (good, bad)]
    features = _Features(*dictionaries, chunk_bytes, level)([*good[1::2], *bad[1::2]])
    label = np.r_[np.ones(len(good[1::2])), np.zeros(len(bad[1::2]))]
    centre, scale = features.mean(0), features.std(0)
    scale[scale == 0] = 1
    weights = _logistic((features - centre) / scale, label)
    return Model(
        *dictionaries, tuple(centre), tuple(scale), tuple(weights), prior, chunk_bytes, level
    )


def _scorer(model: Model):
    if model.weights is None:
        return lambda texts: np.full(len(texts), model.prior)
    features = _Features(model.good, model.bad, model.chunk_bytes, model.level)
    weights = np.array(model.weights)

    def score(texts: list) -> np.ndarray:
        x = (features([t or "" for t in texts]) - model.centre) / model.scale
        return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))

    return score


def score(
    documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted) of every row: score in 0..1, predicted 1 from 0.5 on.

    A null text scores like an empty one: the sizes of an empty chunk under either dictionary.
    A model without rows of both classes gives the share of good rows to all (0.5 without any
    rows). Rows are scored one by one over whole texts; repeated rows and null ids come out as
    they came in, an empty table gives no rows, other columns are not read.
    """

    def make():
        scorer = _scorer(model)
        return lambda texts: [scorer(texts)]

    scored = map_texts(documents, [id_col], text_col, make, "score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(
    documents: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows, all columns, that score at least `threshold`; one pass, no join."""

    @F.pandas_udf("boolean")
    def kept(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(model)
        for texts in parts:
            rows = texts.tolist()
            yield pd.Series(scorer(rows) >= threshold if rows else [], dtype=bool)

    return documents.where(kept(F.col(f"`{text_col}`")))
