"""Ranked lexical search: term-at-a-time with a limited set of accumulators.

A first scan turns each document into its length and the counts of the terms that items ask for.
From that table come the corpus statistics, and each batch of its documents is then an index
segment of its own: postings by term, with the exact amount a posting adds to a score. An item's
terms are taken rarest first. Once all terms that are left cannot lift a document without an
accumulator to the kth partial score, no more accumulators are made; the others are still updated
to the end, so the scores of all documents that can be ranked are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions.plans import scratch_path
from wattledger.llm.common import named, staged, whole_text
from wattledger.llm.encoding import slices
from wattledger.llm.wordscan import SLICE_BYTES, Words

TOP = 50
# Different terms of all items that go to the executors at a time; more take more passes.
BLOCK_TERMS = 200_000
FOUND = "item long, doc_id long, score long"


def item_terms(items: DataFrame) -> DataFrame:
    """From (item, text): a row per item and different term, the term as bytes."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                words = Words(part)
                owner, found = words.text_of().tolist(), range(len(words.starts))
                pairs = sorted({(owner[i], words.join(i, 1)) for i in found})
                numbers = batch.column(0).slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [numbers.take(pa.array([i for i, _ in pairs], pa.int64())), pa.array([t for _, t in pairs], pa.binary())],
                    ["item", "term"],
                )

    return items.select("item", "text").mapInArrow(split, "item long, term binary")


class Vocabulary:
    """The terms of one block, numbered in byte order, found again in scanned words."""

    def __init__(self, terms: list[bytes]) -> None:
        self.terms = terms
        hashes = Words(pa.array(terms, pa.binary())).hashes()
        self.order = np.argsort(hashes, kind="stable")
        self.keys = hashes[self.order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two terms share a 64-bit hash")
        self.lengths = np.array([len(t) for t in terms], dtype=np.int64)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(terms), np.uint8)
        # A table of the upper bits turns most other words away before the search.
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that are terms of the block, and their numbers; compared byte by byte."""
        hashes = words.hashes()
        if not len(self.keys) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        near = np.minimum(np.searchsorted(self.keys, hashes[place]), len(self.keys) - 1)
        same = self.keys[near] == hashes[place]
        place, term = place[same], self.order[near[same]]
        good = words.ends[place] - words.starts[place] == self.lengths[term]
        place, term = place[good], term[good]
        equal, rest, at = np.ones(len(place), dtype=bool), np.arange(len(place)), 0
        while len(rest):
            rest = rest[self.lengths[term[rest]] > at]
            given = words.buffer[words.starts[place[rest]] + at]
            equal[rest[given != self.letters[self.begin[term[rest]] + at]]] = False
            at += 1
        return place[equal], term[equal]


def term_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """From (doc_id, text): doc_id, n (all terms of the whole text), and the block's terms in it
    with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one bounded block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        size = max(1, len(block.terms))
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                words = Words(part)
                place, term = block.find(words)
                owner = np.searchsorted(words.bounds, place, side="right") - 1
                pairs, often = np.unique(owner * size + term, return_counts=True)
                held = np.bincount(pairs // size, minlength=len(part))
                bounds = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(part)), pa.array(np.diff(words.bounds), pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array(pairs % size, pa.int32())),
                        pa.ListArray.from_arrays(bounds, pa.array(often, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )
                at += len(part)

    made = "doc_id long, n long, terms array<int>, counts array<long>"
    return docs.select("doc_id", "text").mapInArrow(count, made)


@dataclass
class Corpus:
    """Numbers over all documents: how many have terms, how many terms they have, and per term of
    the block its weight and the number of documents that hold it."""

    documents: int
    length: int
    held: np.ndarray
    weight: np.ndarray


def corpus_of(counted: DataFrame, terms: int) -> Corpus:
    """The numbers of `term_counts`; the driver gets a row per term of the block."""
    documents, length = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(terms, dtype=np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        held[row.term] = row.df
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()]
    return Corpus(documents, length, held, np.array(weight, dtype=np.int64))


class Segment:
    """The postings of one batch of documents, by term, each with what it adds to a score."""

    def __init__(self, length: np.ndarray, bounds: np.ndarray, terms: np.ndarray, counts: np.ndarray, corpus: Corpus) -> None:
        self.size = len(length)
        doc = np.repeat(np.arange(self.size), np.diff(bounds))
        order = np.argsort(terms, kind="stable")
        self.doc, terms, counts = doc[order], terms[order], counts[order]
        spread = 100 - 50 + (50 * length * corpus.documents) // max(1, corpus.length)
        share = (1_000_000_000 * counts) // (1000 * counts + 20 * spread[self.doc])
        self.adds = corpus.weight[terms] * share
        self.begin = np.searchsorted(terms, np.arange(len(corpus.weight) + 1))
        self.most = np.zeros(len(corpus.weight), dtype=np.int64)
        some = np.flatnonzero(np.diff(self.begin))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.adds, self.begin[some])

    def ranked(self, terms: np.ndarray, count: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that score above 0 and at least `least`, with exact scores; those below the
        kth best of the segment may be missing. `terms` come rarest first."""
        most = self.most[terms]
        terms, most = terms[most > 0], most[most > 0]
        # The most that the terms from here on can add to any document.
        rest = np.cumsum(most[::-1])[::-1]
        scores = np.zeros(self.size, dtype=np.int64)
        open_to_all = True
        for term, left in zip(terms.tolist(), rest.tolist()):
            if open_to_all and (left < least or left < scores.max(initial=0)):
                kth = np.partition(scores, self.size - count)[self.size - count] if self.size > count else 0
                open_to_all = left >= max(least, kth)
            at, adds = (x[self.begin[term] : self.begin[term + 1]] for x in (self.doc, self.adds))
            if not open_to_all:
                started = scores[at] > 0
                at, adds = at[started], adds[started]
            scores[at] += adds
        found = np.flatnonzero(scores >= max(least, 1))
        return found, scores[found]


def search(counted: DataFrame, asked: list[tuple[int, np.ndarray]], corpus: Corpus, count: int) -> DataFrame:
    """For each item the best documents of each task, as FOUND; `asked` has the items' terms."""
    ordered = [(item, terms[np.lexsort((terms, corpus.held[terms]))]) for item, terms in asked]
    shared = counted.sparkSession.sparkContext.broadcast((ordered, corpus))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, numbers = shared.value
        # Of each item: score, id (null last) of the best documents so far.
        best: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(2)
            bounds = np.asarray(lists.offsets, dtype=np.int64)
            terms, counts = (np.asarray(batch.column(i).flatten(), dtype=np.int64) for i in (2, 3))
            segment = Segment(np.asarray(batch.column(1)), bounds, terms, counts, numbers)
            for n, (_, wanted) in enumerate(items):
                found = best[n]
                least = -found[-1][0] if len(found) == count else 0
                at, scores = segment.ranked(wanted, count, least)
                if len(at) > count:
                    enough = scores >= np.partition(scores, len(at) - count)[len(at) - count]
                    at, scores = at[enough], scores[enough]
                found += [(-s, ids[a] is None, ids[a] or 0) for s, a in zip(scores.tolist(), at.tolist())]
                best[n] = sorted(found)[:count]
        flat = [(items[n][0], None if none else name, -s) for n, found in enumerate(best) for s, none, name in found]
        columns = list(map(list, zip(*flat))) if flat else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return counted.select("doc_id", "n", "terms", "counts").mapInArrow(rank, FOUND)


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    count: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The `count` best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of digits, letters and non-ASCII characters, A-Z lowered. A score sums, over
    the item's different terms, the term's weight times its saturated share of the document, all
    in whole numbers. Ties go to the smaller id; only scores above 0 are ranked.

    Items go out in blocks of about `block_terms` terms; a block takes one scan of the texts. Each
    task gives at most `count` documents an item, which are ranked by a window that is limited
    ahead of its shuffle.

    Cases: null and empty texts have no terms; an item without terms gets no rows; items repeated
    under one id, null too, are ranked each for itself; a null document id comes last among ties;
    repeated documents are documents of their own; a very long text is one row of counts, at most
    one for each term; other columns are not looked at; empty tables give an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(named(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    given = items.select(named(item_id_col).alias("item_id"), whole_text(item_text_col).alias("text"))
    given = staged(given.withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    terms = staged(item_terms(given), "lexical-terms")
    blocks = max(1, -(-terms.count() // block_terms))
    found = scratch_path(spark, "lexical-found")
    for nth in range(blocks):
        pairs = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == nth).toArrow()
        coded = pairs["term"].combine_chunks().dictionary_encode() if pairs.num_rows else None
        vocabulary = Vocabulary(coded.dictionary.to_pylist() if coded is not None else [])
        number, term = np.asarray(pairs["item"]), np.asarray(coded.indices if coded is not None else [], dtype=np.int64)
        order = np.argsort(number, kind="stable")
        each, first = np.unique(number[order], return_index=True)
        asked = list(zip(each.tolist(), np.split(term[order], first[1:])))
        counted = staged(term_counts(texts, vocabulary), "lexical-counts")
        corpus = corpus_of(counted, len(vocabulary.terms))
        search(counted, asked, corpus, count).write.parquet(f"{found}/block={nth}")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = spark.read.schema(FOUND).parquet(found).withColumn("rank", F.row_number().over(ranked))
    # At most `count` rows for each item, whose ids are joined back.
    return best.where(F.col("rank") <= count).join(given.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score"
    )
