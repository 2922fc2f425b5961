"""Quality rules against a plain count, the classifier by held-out accuracy."""

import os
import random
import re
from base64 import b64encode
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.corpora import edge_documents, edge_texts, empty_documents, prose
from tidemark.llm import quality_classifier as classifier
from tidemark.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = text.split("\n")
    again = sum(1 for i, line in enumerate(lines) if WORD.search(line) and line in lines[:i])
    signs = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), signs, again, len(inside)


def test_base_counts():
    rng = random.Random(5)
    texts = [t for t in edge_texts() if t is not None]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += ["\n".join(rng.choice(["a b", "c", "", " "]) for _ in range(9)) for _ in range(50)]
    for text in texts:
        assert rules.base_counts(text) == plain_counts(text), text[:80]


def verdict(text):
    import zstandard

    return rules.ratios(text, rules.Rules(), zstandard.ZstdCompressor(level=3))


def test_bands():
    rng = random.Random(2)
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(9000))
    clean = prose(rng, 2000)
    assert verdict("The river runs under the old stone bridge and over again. " * 8)[2] is False
    assert verdict(noise)[2] is False
    assert not verdict("x" * 50_000)[2] and not verdict("")[2]
    assert rules.Rules().within(45, 100) and not rules.Rules().within(10, 10_000)
    # Half of the chunks being noise is bearable, more is not.
    assert verdict(clean + " " + noise[: len(clean) // 9])[2]
    assert not verdict(clean[:2000] + noise)[2]


def spaced(text, size):
    return " ".join(text[i : i + size] for i in range(0, len(text), size))


def test_bands_reject_encoded_text():
    rng = random.Random(4)
    encoded = lambda n: spaced(b64encode(rng.randbytes(n)).decode()[:n], 16)
    for size in (220, 300, 450, 600, 940, 1500, 2700, 5000, 30_000):
        assert not verdict(encoded(size))[2], size
    wide = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    assert not verdict(wide(9000))[2] and not verdict(spaced(wide(9000), 6))[2]
    assert not verdict(spaced(wide(900), 6))[2]
    assert verdict("The river runs under the old stone bridge and over again. " * 4)[2] is False
    # Half of a long text: encoded, or random printable characters.
    clean = prose(rng, 2700)[:24_000]
    printable = "".join(chr(rng.randrange(33, 127)) for _ in range(24_000))
    assert verdict(clean)[2]
    assert not verdict(clean + " " + encoded(23_000))[2]
    assert not verdict(clean + " " + spaced(printable, 12))[2]


def test_rules_table(spark):
    documents = edge_documents(spark)
    rows = rules.quality_rules(documents).collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == 3 * len(edge_texts())
    for number, text in enumerate(t or "" for t in edge_texts()):
        counts = plain_counts(text)
        row = by_id[number]
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert tuple(row)[1:6] == counts and row.base_failed == failed
        assert row.kept == (not failed and verdict(text)[2])
    kept = rules.keep_passing(documents)
    assert kept.columns == documents.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert rules.quality_rules(empty_documents(spark)).count() == 0
    assert rules.keep_passing(empty_documents(spark)).count() == 0


def good_and_bad(spark, count=120):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(count):
        good = i % 3 > 0
        text = prose(rng, 150)
        rows.append((i, text if good else "!! ".join(text.upper().split())))
        labels.append((i, int(good)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    return documents, spark.createDataFrame(labels, "doc_id long, quality int")


def test_classifier(spark):
    documents, labels = good_and_bad(spark)
    extra = spark.createDataFrame(
        [(None, 1), (3, None), (1, 1), (999, 0), (5, 1), (5, 0)], "doc_id long, quality int"
    )
    train = labels.where("doc_id % 2 = 0").unionAll(extra)
    model = classifier.fit(documents, train)
    assert classifier.fit(documents, train) == model
    scored = classifier.score(documents, model).join(labels, "doc_id").where("doc_id % 2 = 1")
    right = scored.where("predicted = quality").count()
    assert right >= 0.95 * scored.count()
    kept = classifier.keep_good(documents, model)
    assert kept.columns == documents.columns
    assert kept.count() == classifier.score(documents, model).where("predicted = 1").count()


def test_sample_reaches_from_start_to_end(spark):
    texts = ["a" * 2000, "é" * 2001, "".join(chr(0x4E00 + i) for i in range(9000)), "", "x" * 1999]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = [r.t for r in rows.orderBy("i").select(classifier.spread(F.col("t"), 2000).alias("t")).collect()]
    assert got[0] == texts[0] and got[1] == "é" * 2000 and got[3:] == texts[3:]
    assert got[2] == texts[2][:1000] + texts[2][-1000:]
    rows = rows.select(classifier.spread(F.col("t"), 4000).alias("t")).where("length(t) > 3000")
    starts = [0, 2666, 5333, 8000]
    assert [r.t for r in rows.collect()] == ["".join(texts[2][s : s + 1000] for s in starts)]


def test_classifier_edges(spark):
    documents, labels = good_and_bad(spark, 60)
    model = classifier.fit(documents, labels)
    rows = classifier.score(edge_documents(spark), model).collect()
    assert len(rows) == 3 * len(edge_texts())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    by_text = {}
    for row in rows:
        if row.doc_id is not None:
            by_text.setdefault(row.doc_id, set()).add(row.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert by_text[0] == by_text[1]  # null scores like empty
    assert classifier.score(empty_documents(spark), model).count() == 0
    one_class = classifier.fit(documents, labels.where("quality = 1"))
    assert {r.score for r in classifier.score(documents, one_class).collect()} == {1.0}
    none = classifier.fit(documents, labels.limit(0))
    assert {r.score for r in classifier.score(documents, none).collect()} == {0.5}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables not there")
def test_held_out_accuracy(spark):
    from tidemark.llm.queries import op2_quality_classifier

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = op2_quality_classifier(spark, folder).where("held_out").join(labels, "doc_id")
    share = held.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")))
    assert all(value >= 0.95 for _, value in share.collect())
