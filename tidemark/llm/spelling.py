"""Spelling variants: words one edit apart, by composing finite-state machines.

The vocabulary of a partition becomes its minimal acceptor A. Composed with a transducer T that
makes exactly one edit, and with A again, it accepts the pairs of near words: A.T.A runs through
A once for both words up to the edit, then through A in two states at once, which must end
together. Edits are taken at the first letter that differs, so a pair is accepted once.

Partitions are those of A's initial states. Words that share their first letters, half the least
length, lie in one partition and are composed there when they differ behind these letters. Words
that differ within them share as many last letters: they meet among the reversed words, where
only edits near the end are taken. A partition with too many words is split by one letter more;
its words can then also differ in that letter itself, and such pairs have the rest in common: they
meet under it, at most one word a letter of the alphabet and the word without it.

A partition sends on the number of near words and the best one for each of its words, not the
pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import slices
from tidemark.session import scratch_path

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
# Words of a partition, and words counted in a task before they are sent on.
PARTITION_WORDS = 20_000
COUNTED = 400_000
_NEAR = "word string, near long, best_n long, best string"


def word_counts(
    documents: DataFrame,
    damage: int | None,
    least_length: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n) of all words of `least_length` letters, added up inside each task first.

    With `damage`, a word whose CRC-32 behind its document's id and a colon the number divides
    loses a letter in that document.
    """

    def lost(word: str, crc: int) -> str:
        if damage is None or crc % damage:
            return word
        at = crc % len(word)
        return word[:at] + word[at + 1 :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch):
                for owner, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = (text or "").encode().lower().decode()  # lower-cases A-Z only
                    start = zlib.crc32(f"{owner or ''}:".encode())
                    for word, n in Counter(_RUNS.findall(text)).items():
                        if len(word) >= least_length:
                            word = lost(word, zlib.crc32(word.encode(), start))
                            if len(word) >= least_length:
                                counts[word] += n
                if len(counts) > COUNTED:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    chosen = documents.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string")
    )
    counted = chosen.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


class Acceptor:
    """The minimal acceptor of words that come sorted and distinct."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self._known: dict[tuple, int] = {}
        path = [0]  # the states along the last word
        last = ""
        for word in words:
            shared = 0
            while shared < min(len(last), len(word)) and last[shared] == word[shared]:
                shared += 1
            self._settle(path, last, shared)
            for letter in word[shared:]:
                self.edges.append({})
                self.final.append(False)
                self.edges[path[-1]][letter] = len(self.edges) - 1
                path.append(len(self.edges) - 1)
            self.final[path[-1]] = True
            last = word
        self._settle(path, last, 0)
        self._live: dict[tuple[int, int], bool] = {}

    def _settle(self, path: list[int], word: str, depth: int) -> None:
        """States of the last word below `depth` get no further edges: join equal ones."""
        while len(path) - 1 > depth:
            state = path.pop()
            form = (self.final[state], *self.edges[state].items())
            same = self._known.setdefault(form, state)
            if same != state:
                self.edges[path[-1]][word[len(path) - 1]] = same

    def live(self, a: int, b: int) -> bool:
        """Whether some string leads both states to an end."""
        known = self._live
        stack = [(a, b)]
        while stack:
            pair = stack[-1]
            a, b = pair
            if pair in known:
                stack.pop()
            elif a == b or (self.final[a] and self.final[b]):
                known[pair] = True
                stack.pop()
            else:
                left, right = self.edges[a], self.edges[b]
                below = [(left[c], right[c]) for c in left.keys() & right.keys()]
                found = [known.get(p) for p in below]
                open_at = next((p for p, f in zip(below, found) if f is None), None)
                if any(found) or open_at is None:
                    known[pair] = any(found)
                    stack.pop()
                else:
                    stack.append(open_at)
        return known[pair]

    def common(self, a: int, b: int, banned: str, most: int | None) -> Iterator[str]:
        """Strings that lead both states to an end, none that begins with `banned`."""
        stack = [(a, b, None, 0)] if self.live(a, b) else []
        while stack:
            a, b, path, length = stack.pop()
            if self.final[a] and self.final[b]:
                yield _spelled(path)
            if most is None or length < most:
                left, right = self.edges[a], self.edges[b]
                for c in left.keys() & right.keys():
                    if (length or c != banned) and self.live(left[c], right[c]):
                        stack.append((left[c], right[c], (path, c), length + 1))

    def edits(self, state: int, most: int | None) -> list[tuple[str, str]]:
        """Pairs of strings accepted from a state that differ by an edit of the first letter."""
        found = []
        letters = sorted(self.edges[state])
        for i, c in enumerate(letters):
            below = self.edges[state][c]
            for d in letters[:i]:
                for rest in self.common(self.edges[state][d], below, "", most):
                    found.append((d + rest, c + rest))
            for rest in self.common(state, below, c, most):
                found.append((rest, c + rest))
        return found

    def near_pairs(self, most: int | None = None) -> Iterator[tuple[str, str]]:
        """All pairs of words one edit apart, with at most `most` letters behind the edit."""
        made: dict[int, list[tuple[str, str]]] = {}
        stack = [(0, None)]
        while stack:
            state, path = stack.pop()
            if state not in made:
                made[state] = self.edits(state, most)
            if made[state]:
                before = _spelled(path)
                for u, v in made[state]:
                    yield before + u, before + v
            stack.extend((below, (path, c)) for c, below in self.edges[state].items())


def _spelled(path: tuple | None) -> str:
    letters = []
    while path is not None:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


def _partition_near(rows: list[tuple], half: int) -> pa.RecordBatch | None:
    """Near words inside a partition; rows are (side, part, text, n), sorted by text."""
    side, part = rows[0][:2]
    turn = -1 if side else 1
    count = {text: n for _, _, text, n in rows}
    near: dict[str, int] = defaultdict(int)
    best: dict[str, tuple[int, str]] = {}
    acceptor = Acceptor([text[len(part) :] for text in count])
    # Behind an edit of the first letters, the reversed words have fewer letters than these.
    for u, v in acceptor.near_pairs(half - 1 if side else None):
        u, v = part + u, part + v
        a, b = u[::turn], v[::turn]
        if side and a[:half] == b[:half]:
            continue  # found among the words read forwards
        for word, other, n in ((a, b, count[v]), (b, a, count[u])):
            near[word] += 1
            if word not in best or (-n, other) < best[word]:
                best[word] = (-n, other)
    if near:
        return _near_rows(near, best)


def _near_rows(near: dict, best: dict) -> pa.RecordBatch:
    words = list(near)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(words, pa.string()),
            pa.array([near[w] for w in words], pa.int64()),
            pa.array([-best[w][0] for w in words], pa.int64()),
            pa.array([best[w][1] for w in words], pa.string()),
        ],
        names=["word", "near", "best_n", "best"],
    )


def _partitioned(sides: DataFrame, half: int, most: int, root: str) -> DataFrame:
    """(side, text, n, depth): the letters that name the partition of each word.

    Only partitions that are too large are looked at again with a letter more.
    """
    spark = sides.sparkSession
    schema = "side int, text string, n long"
    part = lambda depth: F.substring("text", 1, depth).alias("part")
    settled, open_words, depth = [], sides.select("side", "text", "n"), half
    while True:
        counts = open_words.groupBy("side", part(depth)).agg(F.count("*").alias("words"))
        large = counts.where(F.col("words") > most).select("side", "part")
        large.write.parquet(f"{root}/large-{depth}")
        large = spark.read.schema("side int, part string").parquet(f"{root}/large-{depth}")
        if large.isEmpty():
            settled.append(open_words.withColumn("depth", F.lit(depth)))
            break
        named = open_words.withColumn("part", part(depth))
        small = named.join(large, ["side", "part"], "left_anti").drop("part")
        settled.append(small.select("side", "text", "n", F.lit(depth).alias("depth")))
        again = named.join(large, ["side", "part"], "left_semi")
        again.select("side", "text", "n").write.parquet(f"{root}/open-{depth}")
        open_words = spark.read.schema(schema).parquet(f"{root}/open-{depth}")
        depth += 1
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result


def _near_in_partitions(words: DataFrame, half: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] != held[-1][:2]:
                    if len(held) > 1 and (made := _partition_near(held, half)):
                        yield made
                    held = []
                held.append(row)
        if len(held) > 1 and (made := _partition_near(held, half)):
            yield made

    part = F.expr("substring(text, 1, depth)").alias("part")
    named = words.select("side", part, "text", "n").repartition("side", "part")
    return named.sortWithinPartitions("side", "part", "text").mapInArrow(run, _NEAR)


def _near_across(words: DataFrame, half: int) -> DataFrame:
    """Near words that differ in a letter by which their partition was split.

    Words with the same letters before and after such a place meet: one a letter, and the one
    that has no letter there.
    """
    deep = words.where(F.col("depth") > half)
    at = F.explode(F.sequence(F.lit(half), F.col("depth") - 1)).alias("at")
    placed = deep.select("side", "text", "n", at).where(F.char_length("text") >= F.col("at"))
    before = F.expr("substring(text, 1, at)").alias("before")
    cut = placed.where(F.char_length("text") > F.col("at")).select(
        "side", "at", before, F.expr("substring(text, at + 2)").alias("rest"),
        F.expr("substring(text, at + 1, 1)").alias("letter"), "text", "n",
    )
    whole = placed.select(
        "side", "at", before, F.expr("substring(text, at + 1)").alias("rest"),
        F.lit("").alias("letter"), "text", "n",
    )
    met = (
        cut.unionAll(whole)
        .groupBy("side", "at", "before", "rest")
        .agg(F.collect_list(F.struct("letter", "text", "n")).alias("met"))
        .where(F.size("met") > 1)
        .select("side", "met", F.substring("rest", 1, 1).alias("next"), F.explode("met").alias("w"))
    )
    word = lambda text: F.when(F.col("side") == 1, F.reverse(text)).otherwise(text)
    # The place must be the first that differs, and the pair one of this side.
    differs = lambda o: (
        (o["letter"] != F.col("w.letter"))
        & ((F.col("w.letter") != "") | (o["letter"] != F.col("next")))
        & ((o["letter"] != "") | (F.col("w.letter") != F.col("next")))
        & (
            (F.col("side") == 0)
            | (F.substring(word(o["text"]), 1, half) != F.substring(word(F.col("w.text")), 1, half))
        )
    )
    others = met.select(
        word(F.col("w.text")).alias("word"),
        F.transform(
            F.filter("met", differs),
            lambda o: F.struct((-o["n"]).alias("minus"), word(o["text"]).alias("word")),
        ).alias("others"),
    ).where(F.size("others") > 0)
    best = F.array_min("others")
    return others.select(
        "word", F.size("others").cast("long").alias("near"),
        (-best["minus"]).alias("best_n"), best["word"].alias("best"),
    )


def _roots(forms: DataFrame, root: str) -> DataFrame:
    """(word, root) of the words with a form, by doubling the steps taken each round.

    Counts grow by a factor from word to form, so chains are short.
    """
    spark = forms.sparkSession
    schema = "word string, root string"
    forms.select("word", F.col("form").alias("root")).write.parquet(f"{root}/roots-0")
    reached = spark.read.schema(schema).parquet(f"{root}/roots-0")
    number = 0
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if reached.join(further, "root", "left_semi").isEmpty():
            return reached
        number += 1
        reached.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        ).write.parquet(f"{root}/roots-{number}")
        reached = spark.read.schema(schema).parquet(f"{root}/roots-{number}")


def spelling_variants(
    documents: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    damage: int | None = None,
    partition_words: int = PARTITION_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the vocabulary.

    Words are runs of Latin letters (A to Z and U+00C0 to U+00FF), A-Z lower-cased, of
    `least_length` letters that occur `least_count` times in all texts. Near words differ by
    exactly one letter put in, left out or replaced. A word's form is its near word with the
    largest count, ties to the first in code-point order, if that has `ratio` times the word's
    count; its root is what forms lead to in the end, the word itself without a form. With
    `damage` (a divisor, see `word_counts`) some words lose a letter before they are counted.

    A null or empty text has no words; a null id counts as empty text. Rows that repeat an id
    count each. An empty table gives no rows; other columns are not read. `partition_words`
    bounds what one task composes at a time, its memory is in proportion to their letters.
    """
    if least_length < 2:
        raise ValueError("words need two letters at least")
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word, or forms could go in circles")
    spark = documents.sparkSession
    root = scratch_path(spark, "spelling")
    half = least_length // 2
    counted = word_counts(documents, damage, least_length, id_col, text_col)
    counted.where(F.col("n") >= least_count).write.parquet(f"{root}/words")
    vocabulary = spark.read.schema("word string, n long").parquet(f"{root}/words")

    sides = vocabulary.select(F.lit(0).alias("side"), F.col("word").alias("text"), "n").unionAll(
        vocabulary.select(F.lit(1), F.reverse("word"), "n")
    )
    words = _partitioned(sides, half, partition_words, root)
    found = _near_in_partitions(words, half).unionAll(_near_across(words, half))
    near = found.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word"))).alias("best"),
    )
    fits = -F.col("best.minus") >= ratio * F.col("n")
    vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"),
        F.when(fits, -F.col("best.minus")).alias("form_n"),
    ).write.parquet(f"{root}/forms")
    schema = "word string, n long, n_near long, form string, form_n long"
    forms = spark.read.schema(schema).parquet(f"{root}/forms")
    roots = _roots(forms.where("form IS NOT NULL"), root)
    return forms.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
