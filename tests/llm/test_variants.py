"""Pivot search, importance resampling and spelling variants against plain versions."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.corpora import CLASHING, edge_documents, edge_texts, empty_documents, prose
from tidemark.llm import importance, pivot_search, spelling

# --- Exact top-k by pivots --------------------------------------------------------------------


def vectors_of(spark, rows, kind="array<float>"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int")
    return frame.withColumns({c: frame["label"] for c in CLASHING})


def plain_top(rows, k, scale=64.0):
    """Every query row against every other row, in Python's whole numbers."""
    whole = []
    for place, (vec_id, vector, _) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.append((place, vec_id, [math.floor(scale * x) for x in vector]))
    found = []
    for place, asker, q in whole:
        if asker is None or asker % 20:
            continue
        others = [
            (-min(max(sum(a * b for a, b in zip(q, x)), 1 - 2**63), 2**63 - 1), i is None, i)
            for p, i, x in whole
            if p != place and len(x) == len(q)
        ]
        best = sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k]
        found += [(asker, at + 1, i, -score) for at, (score, _, i) in enumerate(best)]
    return sorted(found, key=repr)


def searched(frame, k=20):
    return sorted(
        map(tuple, pivot_search.top_products(frame, F.col("vec_id") % 20 == 0, k).collect()),
        key=repr,
    )


def floats(values):
    return [float(np.float32(v)) for v in values]


def clustered(rng, count, size):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    return [floats(x + rng.gauss(0, 0.1) for x in rng.choice(centres)) for _ in range(count)]


def test_pivot_search_equals_all_products(spark):
    rng = random.Random(3)
    rows = [(i, v, i % 5) for i, v in enumerate(clustered(rng, 900, 12))]
    # A vector that a third of all rows hold, ties in plenty, and rows that repeat an id.
    rows += [(5_000 + i, rows[20][1], 1) for i in range(450)]
    rows += [(40, floats(rng.gauss(0, 1) for _ in range(12)), 1), rows[60], rows[60]]
    assert searched(vectors_of(spark, rows), 7) == plain_top(rows, 7)


def test_pivot_search_in_many_groups(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("GROUP_QUERIES", 8), ("GROUP_CANDIDATES", 64), ("STEP", 4)):
        monkeypatch.setattr(pivot_search, name, value)
    rng = random.Random(4)
    rows = [(i, v, 0) for i, v in enumerate(clustered(rng, 500, 6))]
    assert searched(vectors_of(spark, rows), 5) == plain_top(rows, 5)


def test_pivots_leave_out_far_blocks():
    rng = np.random.default_rng(1)
    near, far = rng.integers(-3, 4, (40, 8)) + 50.0, rng.integers(-3, 4, (40, 8)) - 50.0
    pivots = pivot_search.Pivots([(8, v.astype(np.int8).tobytes()) for v in (*near, *far)], 4)

    def block(kind, x):
        rows = [(kind, i, 8, bytes(16), v.astype(np.int8).tobytes()) for i, v in enumerate(x)]
        return pivot_search._Block(pivot_search._block(rows, pivots, 2).to_pylist()[0])

    tile, beside, away = block(1, near), block(0, near), block(0, far)
    assert tile.bound_of(away) < pivot_search.products(near, near).min() < tile.bound_of(beside)
    assert (tile.bounds_of(beside) >= pivot_search.products(near, near)).all()
    assert (tile.bounds_of(away) >= pivot_search.products(near, far)).all()


def test_pivot_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.01], 1), (20, None, 1), (40, [], 1), (60, [], 1), (80, [1.0, None], 1),
        (100, [nan, 1.0], 1), (120, [inf, 1.0], 1), (140, [0.0, -0.0], 1), (None, [3.0, 1.0], 1),
        (None, [3.0, 1.0], None), (160, [1.0], 1), (7, [1e30, 1e30], 1), (180, [-1e30, 2e30], 1),
        (8, [1e17, 3.0], 1), (200, [-1e16, 5.0], 1), (-20, [0.25, 0.25], 1),
    ]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    got = searched(vectors_of(spark, rows))
    assert got == plain_top(rows, 20)
    assert {r[0] for r in got} == {0, 40, 60, 140, 180, 200, -20}  # 160 has no other of its size
    assert searched(vectors_of(spark, rows, "array<double>"), 3) == plain_top(rows, 3)
    assert searched(vectors_of(spark, [])) == []
    assert searched(vectors_of(spark, rows[:1])) == []


# --- Importance resampling --------------------------------------------------------------------

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_features(text, longest):
    words = _WORD.findall(lower(text))
    runs = [
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]
    return len(words), runs


def plain_resample(rows, targets, percent, longest, buckets, least):
    def counts(texts):
        found = Counter()
        for text in texts:
            found.update(zlib.crc32(f.encode()) % buckets for f in plain_features(text, longest)[1])
        return found

    s, t = counts(text for _, text in rows), counts(targets)
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
        for b in range(buckets)
    ]
    scored = []
    for doc, text in rows:
        n_words, features = plain_features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        h = int(sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((n_words >= least, doc, len(features), weight, weight + noise))
    fits = [r for r in scored if r[0]]
    order = sorted(fits, key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = len(fits) * percent // 100
    result = [(*r[1:], n + 1 if n < drawn else None) for n, r in enumerate(order)]
    return sorted([*result, *((*r[1:], None) for r in scored if not r[0])], key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_edges(spark, longest):
    rng = random.Random(9)
    texts = edge_texts() + [prose(rng, rng.randrange(10, 60)) for _ in range(80)]
    documents = edge_documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    targets = [prose(rng, 200), None, "", "Été 日本語 a1"]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = importance.resample(documents, target, 30, longest, 500, 20)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(
        rows, targets, 30, longest, 500, 20
    )


def test_features_stop_at_the_end_of_a_document():
    buckets, documents, words = importance.Features(2, 1 << 30)(["a b", None, "", "b", "a\nb c"])
    of = dict.fromkeys(range(5), ())
    for bucket, document in zip(buckets.tolist(), documents.tolist()):
        of[document] += (bucket,)
    hashed = {f: zlib.crc32(f.encode()) % (1 << 30) for f in ("a", "b", "c", "a b", "b c")}
    assert [set(of[i]) for i in range(5)] == [
        {hashed["a"], hashed["b"], hashed["a b"]}, set(), set(), {hashed["b"]}, set(hashed.values()),
    ]
    assert words.tolist() == [2, 0, 0, 1, 3]


def test_resampling_of_nothing(spark):
    nothing = empty_documents(spark)
    assert importance.resample(nothing, nothing).collect() == []
    some = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in importance.resample(some, nothing, 100).collect()}
    assert rows[1].rank == 1 and rows[2].rank is None and rows[2].weight == 0


# --- Spelling variants ------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :])


def plain_variants(rows, damage, least_length=6, least_count=5, ratio=5):
    counts = Counter()
    for doc, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(word)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if damage and h % damage == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    held = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in held if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in held}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-held[o], o), default=None)
        form[word] = best if best and held[best] >= ratio * held[word] else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return sorted(
        (w, n, len(near[w]), form[w], held.get(form[w]), root(w)) for w, n in held.items()
    )


def found(documents, **options):
    return sorted(map(tuple, spelling.spelling_variants(documents, **options).collect()))


def variant_texts(rng):
    """Words, frequent and rare, and edits of them at any place; chains; runs of one letter."""
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(6, 10))) for _ in range(60)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa", "aaaaaab", "cacaca", "acacac", "cacacac"]
    edited = []
    for word in words:
        at = rng.randrange(len(word))
        edited += [word[:at] + word[at + 1 :], word[:at] + "b" + word[at:], word[:at] + "c" + word[at + 1 :]]
    texts = []
    for word in words + edited:
        texts += [f"{word.upper()} {word}, {word}\n"] * rng.choice([1, 2, 12, 70])
    rng.shuffle(texts)
    return ["".join(texts[i::40]) for i in range(40)]


@pytest.mark.parametrize("most", [spelling.PARTITION_WORDS, 3])
@pytest.mark.parametrize("damage", [None, 7])
def test_variants_equal_all_pairs(spark, most, damage):
    rng = random.Random(21)
    texts = variant_texts(rng) + edge_texts()
    documents = edge_documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = plain_variants(rows, damage)
    assert found(documents, damage=damage, partition_words=most) == want
    assert {row[2] for row in want} > {0, 1, 2} and any(r[3] != r[5] for r in want if r[3])


def test_variants_of_other_lengths(spark):
    texts = variant_texts(random.Random(5))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length, most in ((2, 2), (5, 4), (9, 1)):
        got = found(documents, least_length=length, partition_words=most)
        assert got == plain_variants(list(enumerate(texts)), None, length)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", max_size=6), max_size=40))
def test_composition_accepts_each_pair_once(words):
    acceptor = spelling.Acceptor(sorted(words))
    pairs = [tuple(sorted(p)) for p in acceptor.near_pairs()]
    assert sorted(pairs) == sorted(
        (a, b) for a in words for b in words if a < b and one_edit(a, b)
    )


def test_acceptor_is_minimal():
    words = sorted({a + b for a in ("ab", "cd", "e") for b in ("", "x", "xyz")})
    acceptor = spelling.Acceptor(words)
    reached, stack = set(), [0]
    while stack:
        if (state := stack.pop()) not in reached:
            reached.add(state)
            stack += acceptor.edges[state].values()
    assert len(reached) == 1 + 2 + 4  # start, after a and c, then the shared ends


def test_very_long_words(spark):
    long = "x" * 15_000
    texts = [f"{long} {long}y"] * 6 + [long] * 30 + [None]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(documents) == [
        (long, 36, 1, None, None, long), (long + "y", 6, 1, long, 36, long),
    ]


def test_variants_of_nothing(spark):
    assert found(empty_documents(spark)) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(empty_documents(spark), ratio=1)
