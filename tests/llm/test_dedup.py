"""Line dedup, n-gram join and embedding near-dedup against brute force."""

import math
import random
import re

import numpy as np
import pytest

from tests.llm.corpora import edge_documents, edge_texts, empty_documents, near_copies
from tidemark.llm import line_dedup, ngram_join, vector_dedup
from tidemark.llm.components import components
from tidemark.llm.ngram_sets import Shingler

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    """Disjoint sets that answer with their smallest member."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)]
    sets = Sets()
    for a, b in links:
        if a != b:
            sets.join(a, b)
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.id, r.component) for r in rows) == sorted((x, sets.find(x)) for x in sets.parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Lines ----------------------------------------------------------------------------------


def plain_lines(rows):
    """{id: (lines, dropped, kept text)} for rows (id, text) with distinct ids."""
    first, holders = {}, {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(doc)
                first[key] = min(first.get(key, doc), doc)
    found = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(key) < 10 or len(holders[key]) < 2 or first[key] == doc:
                kept.append(line)
        found[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return found


@pytest.mark.parametrize("batches, fan_out", [(1, 2), (7, 2), (5, 3)])
def test_lines(spark, batches, fan_out):
    rng = random.Random(batches)
    pool = [f"line number {i} of the pool" for i in range(60)] + ["short", "", "ÀÉ été déjà vu"]
    rows = []
    for doc in rng.sample(range(10_000), 150):
        lines = [rng.choice(pool) for _ in range(rng.randrange(1, 9))]
        lines = [rng.choice([s, s.upper(), f"\t{s} ", s + "\r"]) for s in lines]
        rows.append((doc, "\n".join([*lines, "a line in every document"])))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = line_dedup.drop_repeated_lines(frame, batches, fan_out=fan_out).collect()
    got = {r.doc_id: (*r["line counts"], r.text) for r in kept}
    assert got == plain_lines(rows)


def test_lines_edges(spark):
    texts = [*edge_texts(), *edge_texts()]  # every text under two ids
    documents = edge_documents(spark, texts)
    kept = line_dedup.drop_repeated_lines(documents, 3)
    assert [c for c in kept.columns if c != "line counts"] == documents.columns
    rows = kept.collect()
    assert len(rows) == 3 * len(texts)
    want = plain_lines([*enumerate(texts)])
    for row in rows:
        if row.doc_id is None:
            assert row["line counts"].n_dropped == 0
        else:
            assert (*row["line counts"], row.text or "") == want[row.doc_id]
            assert (row.text is None) == (texts[row.doc_id] is None)
    assert line_dedup.drop_repeated_lines(empty_documents(spark)).count() == 0


# --- N-grams ----------------------------------------------------------------------------------


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_components(texts):
    found, sets = [shingles(t) for t in texts], Sets()
    for i, x in enumerate(found):
        sets.find(i)
        for j in range(i):
            common = len(x & found[j])
            if x and 100 * common >= 75 * (len(x) + len(found[j]) - common) > 0:
                sets.join(i, j)
    return [(i, len(x), sets.find(i)) for i, x in enumerate(found)]


@pytest.mark.parametrize("small_group", [2, 8])
def test_ngrams(spark, small_group):
    texts = near_copies(random.Random(small_group)) + edge_texts()
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(7)
    rows = ngram_join.ngram_classes(frame, small_group=small_group).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows)
    assert got == plain_components(texts)
    smallest = {}
    for i, text in enumerate(texts):
        smallest.setdefault(shingles(text) or i, i)
    assert all(r.class_id == smallest[shingles(texts[r.doc_id]) or r.doc_id] for r in rows)


def test_ngram_edges(spark):
    rows = ngram_join.ngram_classes(edge_documents(spark)).collect()
    want = plain_components(edge_texts())
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id is not None) == (
        sorted([*want, *want])
    )
    nameless = [r for r in rows if r.doc_id is None]
    assert len(nameless) == len(edge_texts())
    assert all(r.class_id is None and r.component_id is None for r in nameless)
    # One id with two texts joins what either is linked with.
    texts = [(9, "a b c d e f g h"), (4, "a b c d e f g h"), (9, "k l m n o p q"), (2, "k l m n o p q")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = ngram_join.ngram_classes(frame).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(9, 2), (4, 2), (2, 2)}
    assert ngram_join.ngram_classes(empty_documents(spark)).count() == 0


def test_sets_around_a_passage(spark, tmp_path, monkeypatch):
    """what has less than three quarters in common goes no further, and scratch is given back."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    passage = rng.choices(words, k=40)
    texts = [" ".join([*rng.choices(words, k=30), *passage]) for _ in range(60)]
    own = rng.choices(words, k=80)
    texts += [" ".join([*own[:i], f"edit{i}", *own[i:]]) for i in (0, 20, 40, 80)]
    signed = []

    def seen(sets, *rest, real=ngram_join._dealt_signatures):
        signed.extend(r.id for r in sets.select("id").collect())
        return real(sets, *rest)

    monkeypatch.setattr(ngram_join, "_dealt_signatures", seen)
    monkeypatch.setattr(ngram_join, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = ngram_join.ngram_classes(frame).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == plain_components(texts)
    assert sorted(signed) == [60, 61, 62, 63]
    left = {p.name for p in (tmp_path / "ngram-join").iterdir()}
    assert "met-sets" in left and not left & {"scanned", "sets"}


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_records_are_narrow(buckets):
    """a record takes a few bytes, and the same keys meet, with the same lowest bit."""
    rng = np.random.default_rng(buckets)
    keys = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    keys = np.r_[keys, keys[:1500], keys[:700] ^ np.uint64(1)]
    for low, high in [(0, 1), (5, 200), (10**12, 10**12 + 200_000), (-(1 << 63), (1 << 63) - 1)]:
        owners = rng.integers(low, high, len(keys), endpoint=True)
        for exact in (False, True):
            dealt = ngram_join._deal(keys, owners, buckets, exact)
            got = [*ngram_join._by_bucket(iter([dealt]), buckets, exact)]
            key, owner = (np.concatenate(x) for x in zip(*got))
            assert sorted(owner) == sorted(owners)
            if exact:
                assert sorted(zip(key, owner)) == sorted(zip(keys, owners))
            else:
                assert sorted(np.unique(key, return_counts=True)[1]) == (
                    sorted(np.unique(keys, return_counts=True)[1])
                )
                assert sorted(key & np.uint64(1)) == sorted(keys & np.uint64(1))
            if not exact and high - low < 1 << 24:
                size = sum(len(x) for c in dealt.columns[1:] for x in c.to_pylist())
                assert size <= 8 * len(keys) + 9 * buckets


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for size in [1, 2, 3, 4, 5, 7, 9, 12, 18, 30, 60, 150, 400, 1500]:
        for _ in range(25):
            x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            # As different as a link allows: replace, drop or add shingles.
            drop = rng.integers(0, size // 4 + 1)
            add = 0
            while 100 * (size - drop) >= 75 * (size + add + 1) and rng.random() < 0.95:
                add += 1
            y = np.unique(np.r_[rng.permutation(x)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            common = np.intersect1d(x, y).size
            if 100 * common < 75 * (len(x) + len(y) - common):
                continue
            mine, other = (ngram_join.signatures(s, 75) for s in (x, y))
            shared = np.intersect1d(mine >> np.uint64(1), other >> np.uint64(1))
            roles = np.isin(np.r_[mine, other], shared << np.uint64(1) | np.uint64(1))
            assert roles.any(), (size, drop, add)
            apart = ngram_join._sketch_distance(ngram_join._sketch(x), ngram_join._sketch(y))
            assert apart <= len(x) + len(y) - 2 * common


def test_shingle_counts():
    assert [len(Shingler()(t)) for t in edge_texts()] == [len(shingles(t)) for t in edge_texts()]


# --- Vectors ----------------------------------------------------------------------------------


def plain_links(rows, threshold):
    """{id: (links, component)} for rows (id, vector, label) with distinct ids."""
    usable = [
        (i, np.array(v, float) / max(map(abs, v)), l) for i, v, l in rows
        if l is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
    ]
    sets, count = Sets(), {i: 0 for i, _, _ in rows}
    for n, (i, v, l) in enumerate(usable):
        for j, w, m in usable[:n]:
            if l == m and len(v) == len(w):
                if v @ w / math.sqrt((v @ v) * (w @ w)) >= threshold:
                    sets.join(i, j)
                    count[i] += 1
                    count[j] += 1
    return {i: (count[i], sets.find(i)) for i, _, _ in rows}


def test_vectors(spark):
    rng = np.random.default_rng(6)
    rows = []
    for centre in rng.normal(size=(40, 16)):
        for spread in (0.0, 0.05, 0.12, 0.2):
            rows.append((centre + spread * rng.normal(size=16)).tolist())
    hot = rng.normal(size=16)
    rows += [(hot + 0.12 * rng.normal(size=16)).tolist() for _ in range(160)]
    rows += [hot.tolist()] * 30
    rows = [(i, v, i % 2) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 8]
    rows += [(9000 + i, v, 0) for i, v in enumerate([*odd, [2.0] * 8, [1e300] * 16, [1e-300] * 16])]
    rows += [(9100, [1.0] * 16, None), (9101, [1.0] * 16, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.withColumns({"id": frame.label, "unit": frame.label, "a": frame.label})
    twice = frame.unionAll(frame.where("vec_id = 3"))
    got = vector_dedup.near_vectors(twice).collect()
    want = plain_links(rows, 0.93)
    assert len(got) == len(rows) + 1
    found = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert found == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_between_dense_groups(spark):
    """Groups whose members have only members of their own group among their nearest 32."""
    rng = np.random.default_rng(8)
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0].T

    def cloud(centre, count):
        # Spread in dimensions 8 and on: cosine about 0.985 within.
        noise = rng.normal(size=(count, 56)) @ axes[8:]
        noise *= 0.12 / np.linalg.norm(noise, axis=1)[:, None]
        return (centre / np.linalg.norm(centre) + noise).tolist()

    def turned(angle, plane):
        return np.cos(angle) * axes[plane] + np.sin(angle) * axes[plane + 1]

    vectors = []
    for angle in (0.0, 0.31, 0.62):  # neighbours linked in part, the outer two not
        vectors += cloud(turned(angle, 0), 150)
    for angle in (0.0, 0.6):  # not linked
        vectors += cloud(turned(angle, 2), 60)
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    units = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    cosine = units @ units.T
    linked = cosine >= 0.93
    assert 0 < linked[:150, 150:300].sum() and not linked[:150, 300:450].any()
    nearest = np.argsort(-cosine, axis=1)[:, :33]
    assert all((nearest[:450] // 150 == np.arange(450)[:, None] // 150).ravel())

    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(frame).collect()}
    want = plain_links(rows, 0.93)
    assert sorted({c for _, c in want.values()}) == [0, 450, 510]
    assert got == want


def test_vector_audit(spark, monkeypatch):
    """Few links, none at an id divisible by four; one large group beside pairs."""
    rng = np.random.default_rng(3)
    vectors = np.repeat(rng.normal(size=(300, 64)), 2, axis=0)
    vectors[1::2] += 0.1 * rng.normal(size=(300, 64))
    hot = rng.normal(size=64)
    group = [(hot + 0.05 * rng.normal(size=64)).tolist() for _ in range(200)]
    # No pair has an id divisible by four, the group lies beside them under another label.
    rows = [(4 * i + 1, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(4 * i, v, 1) for i, v in enumerate(group)]
    schema = "vec_id long, embedding array<double>, label int"
    frame = spark.createDataFrame(rows, schema)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(frame).collect()}
    want = plain_links(rows, 0.93)
    assert sum(n for n, _ in want.values()) == 600 + 200 * 199
    assert got == want

    # A search that loses all pairs but finds the large group must not pass.
    def blind(points, *rest):
        return points.where("label = 1").selectExpr("0L AS a", "id AS b")

    monkeypatch.setattr(vector_dedup, "_search", blind)
    for part, reached in ((frame, "0.[1-5]"), (frame.where("label = 0"), "0.0000")):
        with pytest.raises(RuntimeError, match=f"recall {reached}.* after 12 orders"):
            vector_dedup.near_vectors(part, attempts=2)


def test_vector_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_dedup.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, None, None)]
    got = vector_dedup.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.kept) for r in got) == [
        (-1, 0, True), (-1, 0, True), (4, 0, True)
    ]
