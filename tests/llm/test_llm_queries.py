"""The registered queries themselves, with the columns they derive: DuckDB statements or brute force."""

import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import llm_brute as brute
from __spark_entry__ import oracle_sql, queries
from checks.compare import differences
from wattledger.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pairs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    assert differences(QUERIES[name](spark, SMALL).toPandas(), duck.execute(ORACLES[name]).df()) == ""


def test_op1(spark, pairs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = QUERIES["op1_token_files"](spark, SMALL)
    assert listed(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(brute.token_rows(pairs, tokenizer), key=repr)


def test_op3(spark, pairs):
    found = QUERIES["op3_simhash"](spark, SMALL)
    assert listed(found, "doc_id", "fingerprint", "component_id") == sorted(brute.near_rows(pairs), key=repr)


def test_op4(spark, pairs):
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality").collect()]
    expected = dict(zip((d for d, _ in pairs), brute.quality_scores(pairs, labels)))
    found = QUERIES["op4_quality"](spark, SMALL).collect()
    assert {r.doc_id for r in found} == set(expected) and len(found) == len(pairs)
    for r in found:
        assert r.score == pytest.approx(expected[r.doc_id], abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)


def test_op7(spark, pairs):
    found = QUERIES["op7_shard_lpt"](spark, SMALL).collect()
    sizes = {d: len((t or "").encode()) + 16 for d, t in pairs}
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in found} == {
        (d, sizes[d], zlib.crc32((t or "").encode()), "bytes", None) for d, t in pairs
    }
    groups = Counter()
    for d, t in pairs:
        groups[t or ""] += sizes[d]
    loads, slots, texts = Counter(), defaultdict(list), dict(pairs)
    for r in found:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(texts[r.doc_id], r.shard) for r in found}) == len(groups)
    expected = Counter()
    for group, shard in brute.lpt(Counter({brute.sha(t): n for t, n in groups.items()}), 40).items():
        expected[shard] += {brute.sha(t): n for t, n in groups.items()}[group]
    assert loads == expected


def test_op8(spark, pairs):
    found = QUERIES["op8_repeats"](spark, SMALL)
    assert listed(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.without_repeats(pairs), key=repr)


def test_op10(spark, pairs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in pairs]
    found = QUERIES["op10_token_counts"](spark, SMALL).collect()
    assert {(r.n_tokens, r.n_docs, r.truncated_total) for r in found} == {
        (n, lengths.count(n), sum(min(x, n) for x in lengths)) for n in lengths
    }


def test_pipeline_run(spark, pairs):
    """All five stages by brute force, from the documents to loads of shards."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, score in zip(rows, brute.quality_scores([r[:2] for r in rows], labels)) if score >= 0.3]
    roots = brute.linked([brute.fingerprint(r[1]) for r in rows])
    least = {}
    for r, root in sorted(zip(rows, roots)):
        least.setdefault(root, r)
    rows = [r for r in least.values() if not next(brute.hits([r[:2]], items))[2]]
    rows = [rows[i] for i in brute.training_order(rows)]
    sizes = Counter()
    for _, text, _ in rows:
        sizes[brute.sha(text or "")] += len((text or "").encode()) + 16
    loads = Counter()
    for group, shard in brute.lpt(sizes, 40).items():
        loads[shard] += sizes[group]
    found = corpus_pipeline.run(spark, SMALL)
    assert Counter(r.doc_id for r in found.collect()) == Counter(r[0] for r in rows)
    assert {r.shard: r.b for r in found.groupBy("shard").agg(F.sum("size").alias("b")).collect()} == dict(loads)
