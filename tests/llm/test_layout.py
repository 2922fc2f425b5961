"""Packing, sharding, license scans, the pipeline and the registered queries."""

import os
import random
from hashlib import md5

import duckdb
import pytest

import corpus_pipeline
from tests.llm.corpora import edge_documents, edge_texts, empty_documents, prose
from tidemark.llm import license_scan, packing, queries, sharding

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


# --- Packing ----------------------------------------------------------------------------------


def plain_best_fit(items, capacity, per_source):
    """Bins by trying all of them for each item, in the given order."""
    bins, placed = [], []
    for length, source, cluster in items:
        fitting = [
            (b["room"], n) for n, b in enumerate(bins)
            if b["room"] >= length and b["sources"].count(source) < per_source
            and cluster not in b["clusters"]
        ]
        if fitting:
            number = min(fitting)[1]
        else:
            number = len(bins)
            bins.append({"room": capacity, "sources": [], "clusters": []})
        bins[number]["room"] -= length
        bins[number]["sources"].append(source)
        bins[number]["clusters"].append(cluster)
        placed.append(number)
    return placed


def test_bins_are_the_tightest_compatible_ones():
    rng = random.Random(8)
    for per_source in (1, 3):
        items = [
            (rng.randrange(1, 100), rng.choice("aaabcd"), rng.randrange(120)) for _ in range(400)
        ]
        items.sort(reverse=True)
        bins = packing._Bins(per_source)
        got = [bins.put(*item, 100) for item in items]
        assert got == plain_best_fit(items, 100, per_source)


def checked_bins(rows, texts, capacity, per_source, sources):
    """Every byte is in one piece; no bin breaks a limit."""
    room, seen = {}, {}
    pieces = {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append((row.start, row.length))
        if row.bin_id is None:
            assert row.length == 0
            continue
        room[row.bin_id] = room.get(row.bin_id, 0) + row.length
        text = " ".join((texts[row.doc_id] or "").lower().split())
        for kind in (("source", sources.get(row.doc_id)), ("cluster", text)):
            seen[row.bin_id, kind] = seen.get((row.bin_id, kind), 0) + 1
    assert max(room.values(), default=0) <= capacity
    for (_, kind), count in seen.items():
        assert count <= (per_source if kind[0] == "source" else 1)
    return pieces


def test_packing_edges(spark):
    texts = edge_texts()
    documents = edge_documents(spark, texts).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.best_fit(documents, 1000, 2).collect()
    pieces = checked_bins(rows, texts, 1000, 2, {i: "s" for i in range(len(texts))})
    for doc, text in enumerate(texts):
        size = len((text or "").encode())
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at
            at += length
        assert at == size
    # Repeated rows and rows without an id: all bytes are there, and no bin is too full.
    rows = packing.best_fit(edge_documents(spark, texts), 1000, 2).collect()
    assert sum(r.length for r in rows) == 3 * sum(len((t or "").encode()) for t in texts)
    room = {}
    for row in rows:
        room[row.bin_id] = room.get(row.bin_id, 0) + row.length
    assert max(v for b, v in room.items() if b) <= 1000
    assert packing.best_fit(empty_documents(spark)).count() == 0


# --- Sharding ---------------------------------------------------------------------------------


def plain_shards(rows, limit):
    """{shard: keys} by splitting one shard after the other."""
    def bits(key):
        digest = md5(("" if key is None else str(key)).encode()).hexdigest()
        return format(int(digest[:15], 16), "060b")

    todo, done = {"": rows}, {}
    while todo:
        name, held = todo.popitem()
        if sum(size for _, size in held) <= limit or len(name) == 60:
            done["s" + name] = held
        else:
            for bit in "01":
                half = [r for r in held if bits(r[0])[len(name)] == bit]
                if half:
                    todo[name + bit] = half
    return done


@pytest.mark.parametrize("bits_a_round", [2, 8])
def test_shards(spark, bits_a_round):
    rng = random.Random(11)
    rows = [(i, "x" * rng.choice([0, 5, 100, 900, 5000])) for i in range(500)]
    rows += [(7, "y" * 3000)] * 3 + [(None, "z" * 400)] * 2 + [(1000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({"depth": frame.doc_id, "prefix": frame.doc_id, "bytes": frame.text})
    got = sharding.shards(frame, 6000, bits_a_round).collect()
    assert len(got) == len(rows)
    want = plain_shards([(i, len(t or "")) for i, t in rows], 6000)
    held = {}
    for row in got:
        held.setdefault(row.shard, []).append((row.doc_id, row.n_bytes))
    order = lambda x: sorted(x, key=repr)
    assert {s: order(r) for s, r in held.items()} == {s: order(r) for s, r in want.items()}
    for row in got:
        total = sum(size for _, size in held[row.shard])
        assert row.shard_bytes == total and row.fits == (total <= 6000)


def test_shard_edges(spark):
    got = sharding.shards(edge_documents(spark), 1 << 30).collect()
    assert {r.shard for r in got} == {"s"} and len(got) == 3 * len(edge_texts())
    assert sharding.shards(empty_documents(spark), 100).count() == 0


# --- Licenses -----------------------------------------------------------------------------------


def plain_matched(template, words):
    """Most tokens any local alignment matches, over the whole table without a band."""
    best = 0
    above = [(0, 0)] * (len(words) + 1)
    for t in template:
        row = [(0, 0)]
        for j, w in enumerate(words, 1):
            options = [
                (above[j - 1][0] + (2 if t == w else -1), above[j - 1][1] + (t == w)),
                (above[j][0] - 1, above[j][1]),
                (row[j - 1][0] - 1, row[j - 1][1]),
                (0, 0),
            ]
            row.append(max(options, key=lambda o: o[0]))
            best = max(best, row[-1][1])
        above = row
    return best


def test_packing_by_given_clusters(spark):
    rows = [(i, f"the same text but for word {i}", f"s{i}", 7 if i < 3 else None) for i in range(5)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, part long")

    def bins(**more):
        return {r.doc_id: r.bin_id for r in packing.best_fit(documents, 1000, **more).collect()}

    assert len(set(bins().values())) == 1  # near copies are no exact copies
    given = bins(cluster_col="part")
    assert len({given[i] for i in range(3)}) == 3 and given[3] == given[4]


def test_licenses_against_full_alignment():
    rng = random.Random(12)
    scan = license_scan.Scan()
    tokens = lambda t: license_scan._TOKEN.findall(license_scan.plain(t))
    for name, notice in license_scan.NOTICES.items():
        index = license_scan.Index({name: notice}, scan)
        for edits in range(4):
            words = notice.split()
            for _ in range(edits):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], [prose(rng, 1)], [words[at], prose(rng, 1)]])
            text = prose(rng, 30) + "\n" + " ".join(words) + "\n" + prose(rng, 30)
            found = license_scan.scan_text(text, index)
            most = plain_matched(tokens(notice), tokens(text)) / len(tokens(notice))
            if found:
                assert found[0][1] <= most
                inside = tokens(text[found[0][3] : found[0][4]])
                assert plain_matched(tokens(notice), inside) == found[0][2]
            elif edits < 2:
                # One edit leaves a run of three tokens in all but the shortest notices.
                assert most < scan.min_coverage or len(tokens(notice)) < 6 + edits


def test_license_table(spark):
    texts = edge_texts() + [
        "Intro.\nAll rights reserved. ALL RIGHTS RESERVED!\n" + license_scan.NOTICES["mit"],
        "x " * 5000 + license_scan.NOTICES["gpl-3.0"].upper(),
    ]
    rows = license_scan.license_scan(edge_documents(spark, texts)).collect()
    first = len(edge_texts())
    mine = sorted((r.start, r.license) for r in rows if r.doc_id == first)
    assert [name for _, name in mine] == ["all-rights-reserved"] * 4 + ["mit"] * 2
    long = [r for r in rows if r.doc_id == first + 1]
    assert len(long) == 2 and long[0].coverage == 1.0
    assert texts[first + 1][long[0].start : long[0].end].startswith("THIS WORK")
    assert sum(r.doc_id is None for r in rows) == 4
    assert license_scan.license_scan(empty_documents(spark)).count() == 0
    assert license_scan.license_scan(edge_documents(spark), {}).count() == 0
    with pytest.raises(ValueError):
        license_scan.license_scan(edge_documents(spark), {"x": "a" * (9 << 20)})


# --- Pipeline and queries -------------------------------------------------------------------


@needs_tables
def test_pipeline(spark, tmp_path):
    from tests.llm.test_dedup import plain_components, plain_lines
    from tests.llm.test_quality import plain_counts, verdict

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF_DIR).write.parquet(str(tmp_path / str(number)))
        tables.append(spark.read.parquet(str(tmp_path / str(number))))
    held = [{r.doc_id: r for r in t.collect()} for t in tables[:5]]
    for table in tables[:5]:
        assert table.columns == docs.columns

    def passes(text):
        counts = plain_counts(text or "")
        return counts[0] >= 50 and 2 * counts[4] <= counts[0] and verdict(text)[2]

    assert set(held[1]) == {i for i, r in held[0].items() if passes(r.text)}
    scores = queries.op2_quality_classifier(spark, SF_DIR).where("predicted = 1").collect()
    assert set(held[2]) == set(held[1]) & {r.doc_id for r in scores}
    lines = plain_lines([(i, r.text) for i, r in held[2].items()])
    assert {i: r.text for i, r in held[3].items()} == {i: t for i, (_, _, t) in lines.items()}
    assert all(r.n_chars == len(r.text) for r in held[3].values())
    ids = sorted(held[3])
    groups = plain_components([held[3][i].text for i in ids])
    assert set(held[4]) == {ids[i] for i, _, first in groups if i == first}
    texts = {i: r.text for i, r in held[4].items()}
    sources = {i: r.source for i, r in held[4].items()}
    pieces = checked_bins(tables[5].collect(), texts, queries.BIN_BYTES, 4, sources)
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == {
        i: len(t.encode()) for i, t in texts.items()
    }
    assert corpus_pipeline.run(spark, SF_DIR).count() == tables[5].count()


@needs_tables
@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_against_sql(spark, name):
    run = {q.__name__: q for q in queries.QUERIES}[name]
    connection = duckdb.connect()
    for table in os.listdir(SF_DIR):
        view = table.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF_DIR}/{table}'")
    result = run(spark, SF_DIR)
    expected = connection.execute(queries.ORACLE_SQL[name])
    named = [d[0] for d in expected.description]
    assert sorted(named) == sorted(result.columns)
    want = sorted(expected.fetchall())
    assert sorted(tuple(r[c] for c in named) for r in result.collect()) == want


@needs_tables
def test_scans_return_every_row(spark):
    count = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for query in (queries.op5_compression_bands, queries.op7_token_counts, queries.op8_bpe_round_trip):
        assert query(spark, SF_DIR).count() == count
