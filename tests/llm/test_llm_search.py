"""Searches and vector codes against brute force: hostile rows, ties, several passes, no rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from wattledger.functions.plans import scratch_path
from wattledger.llm import grid_codes, impact_search, lexical
from wattledger.llm.impact_search import Segments

VECTORS = "vec_id long, embedding array<float>, label int, v int, row string, code string, _label string"
SMALL = "/root/testdata/sf0.001"


def hostile_vectors():
    """Nulls, components that are not finite, unequal lengths, ties, repeated rows and ids."""
    random.seed(4)
    rows = [(i, [random.gauss(0, 0.3) for _ in range(16)], i % 3) for i in range(150)]
    rows += [(None, [0.5] * 16, None), (None, [0.5] * 16, 1), (200, None, 1), (300, [0.1] * 15 + [None], 1)]
    rows += [(400, [float("nan")] * 16, None), (500, [float("inf")] + [0.0] * 15, 2), (600, [], 2), (700, [0.25, -0.5], None)]
    rows += [(800, [0.5] * 16, None)] * 2 + [(800, [0.1] * 16, 5), (900, [0.0] * 16, None)]
    rows += [(1000 + i, [0.5] * 16, 7) for i in range(40)] + [(1100, [3.0, -9.5] * 9, 8)]
    return [(i, v and [float(np.float32(x)) if x is not None else None for x in v], k) for i, v, k in rows]


@pytest.fixture(scope="module")
def vector_rows():
    return hostile_vectors()


@pytest.fixture(scope="module")
def vectors(spark, vector_rows):
    table = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in vector_rows], VECTORS)
    path = scratch_path(spark, "test-vectors")
    table.repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_top_products(vectors, vector_rows):
    expected = sorted(brute.best_products(vector_rows), key=repr)
    assert len(expected) > 60
    for block_rows, block_queries in ((8192, 4096), (30, 3)):
        found = impact_search.top_products(vectors, block_rows=block_rows, block_queries=block_queries)
        assert listed(found, "query_id", "rank", "vec_id", "score") == expected


def test_a_search_stops_on_proof_before_all_rows_are_scored():
    """What is left out is proved not to be among the best, whatever the query's signs and zeros."""
    random_ = np.random.default_rng(8)
    rows = np.floor(random_.normal(size=(3000, 32)) * 180).astype(np.int64)
    rows[:, 3] = 0
    block = Segments(rows)
    scored = 0
    for query in [*rows[:40], *(rows[:20] * random_.integers(0, 2, size=(20, 32))), np.zeros(32, np.int64)]:
        members, scores = block.best(query, 10, -np.inf, None)
        whole = np.sort(rows @ query)[-10:]
        assert np.array_equal(np.sort(scores)[-10:], whole)
        scored += len(members) if query.any() else 0
        # With a better floor known, only rows that reach it need to be there.
        assert set(block.best(query, 10, float(whole[-1]), None)[0]) >= set(np.flatnonzero(rows @ query >= whole[-1]))
    assert scored < 0.2 * 60 * len(rows)


def test_too_large_products_raise(spark):
    table = spark.createDataFrame([(0, [4e9, 1.0]), (1, [4e9, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        impact_search.top_products(table).collect()


def test_vector_codes(vectors, vector_rows):
    found = grid_codes.grid_codes(vectors, ["vec_id"])
    assert listed(found, "vec_id", "code", "error", "label_error", "codebooks_sha256") == sorted(
        brute.vector_codes(vector_rows), key=repr
    )


def test_codes_of_fewer_vectors_than_entries(spark):
    rows = [(i, [0.1 * i, -0.2, 0.3], None) for i in (5, 3, 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = grid_codes.grid_codes(table, ["vec_id"])
    assert listed(found, "vec_id", "code", "error", "label_error", "codebooks_sha256") == sorted(
        brute.vector_codes(rows), key=repr
    )


@pytest.mark.parametrize("cell", [1, 37, 300, 5000])
def test_cells_keep_the_nearest_entry(cell):
    """Whatever the width of a cell, ties included, also when the memory starts afresh or hashes collide."""
    random_ = np.random.default_rng(cell)
    entries = random_.integers(-600, 600, size=(16, 4))
    entries[7] = entries[2]
    points = random_.integers(-800, 800, size=(4000, 4))
    points[:16] = entries
    points[16:40] = (entries[:8].repeat(3, axis=0) + entries[8:].repeat(3, axis=0)) // 2
    distances = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for most_cells in (10**6, 500):
        grid = grid_codes.Grid(entries, cell, most_cells)
        for at in range(0, len(points), 450):
            code, distance = grid.nearest(points[at : at + 450])
            assert np.array_equal(code, distances[at : at + 450].argmin(axis=1))
            assert np.array_equal(distance, distances[at : at + 450].min(axis=1))
    if cell in (37, 300):
        assert grid.open.mean() < 0.9


def test_colliding_cells_keep_every_entry(monkeypatch):
    monkeypatch.setattr(grid_codes, "_FACTORS", np.zeros(8, np.uint64))
    random_ = np.random.default_rng(1)
    entries, points = random_.integers(-500, 500, size=(16, 3)), random_.integers(-500, 500, size=(900, 3))
    code, _ = grid_codes.Grid(entries, 50).nearest(points)
    assert np.array_equal(code, ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1))


def documents_and_items(spark):
    random.seed(6)
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    given += [(None, items[0][1]), (None, None), (-4, ""), (-3, " .,-"), (5000, items[1][1]), (5000, items[1][1])]
    given += [(6000 + i, items[2][1].upper()) for i in range(70)]
    given += [(7000, " ".join(f"w{random.randrange(4000)}" for _ in range(50_000)) + " " + items[3][1])]
    given += [(7001, "Ñandu, thé x1 DON'T éa\u0080 中文"), (7002, "thé thé THé")]
    items += [(None, "thé x1"), (None, "THÉ"), (901, None), (902, "..."), (903, "nowhere to be found zzzzzz"), items[0]]
    return given, items


@pytest.fixture(scope="module")
def corpus(spark):
    return documents_and_items(spark)


def test_ranked_documents(spark, corpus):
    docs, items = corpus
    expected = sorted(brute.ranked(docs, items), key=repr)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "terms", "item")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("item", "term")})
    for block_terms, partitions in ((lexical.BLOCK_TERMS, 4), (300, 1)):
        found = lexical.ranked_documents(table.repartition(partitions), asked, block_terms=block_terms)
        assert listed(found, "item_id", "rank", "doc_id", "score") == expected


def test_accumulators_are_limited(spark, corpus, monkeypatch):
    """Common terms come last and make no accumulators once the best documents are out of reach."""
    made = []
    plain = lexical.Segment.ranked

    def counted(self, terms, count, least):
        found = plain(self, terms, count, least)
        made.append((len(found[0]), len(np.unique(np.concatenate([self.doc[self.begin[t] : self.begin[t + 1]] for t in terms])))))
        return found

    random_ = np.random.default_rng(3)
    n, terms = 2000, 30
    counts = random_.integers(1, 4, size=(n, terms)) * (random_.random((n, terms)) < np.linspace(0.005, 0.9, terms))
    doc, term = np.nonzero(counts)
    held = (counts > 0).sum(axis=0)
    weight = np.floor(1000 * np.log((2 * n + 2) / (2 * held + 1))).astype(np.int64)
    numbers = lexical.Corpus(n, int(counts.sum()), held, weight)
    bounds = np.concatenate([[0], np.cumsum((counts > 0).sum(axis=1))])
    segment = lexical.Segment(counts.sum(axis=1), bounds, term, counts[doc, term].astype(np.int64), numbers)
    order = np.argsort(held)
    at, scores = counted(segment, order, 10, 0)
    m = 50 + 50 * counts.sum(axis=1) * n // counts.sum()
    whole = (weight * (1_000_000_000 * counts // (1000 * counts + 20 * m[:, None]))).sum(axis=1)
    assert np.array_equal(whole[at], scores) and np.array_equal(np.sort(scores)[-10:], np.sort(whole)[-10:])
    limited, matching = made[0]
    assert limited < matching


def test_empty_tables(spark, vectors, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string")
    items = spark.createDataFrame(corpus[1], "item_id long, text string")
    made = [
        impact_search.top_products(vectors.limit(0)), grid_codes.grid_codes(vectors.limit(0), ["vec_id"]),
        lexical.ranked_documents(docs.limit(0), items), lexical.ranked_documents(docs, items.limit(0)),
    ]
    assert [df.count() for df in made] == [0] * len(made)
