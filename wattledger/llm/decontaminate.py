"""Benchmark decontamination: a prefix-filtered set join of item windows with documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import sized
from wattledger.llm.common import named, schema_of, staged
from wattledger.llm.encoding import slices
from wattledger.llm.wordscan import SLICE_BYTES, Words, run_hashes

WINDOW = 10
SHINGLE = 3
# Item windows that go to the executors at a time, by number and by bytes of their words; more
# take more passes.
BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 32 << 20


def windows_by_item(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """The items' windows: item, words, n_words, shingle hashes in order.

    A window is `window` words in a row, or all words of a shorter item; null has no words.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, sizes, shingles = [], [], [], []
            words = Words(batch.column(1))
            hashes = words.hashes()
            for i, name in enumerate(batch.column(0).to_pylist()):
                first, last = words.bounds[i], words.bounds[i + 1]
                size = min(window, last - first)
                width = min(shingle, size)
                for at in range(first, last - size + 1) if size else ():
                    names.append(name)
                    texts.append(words.join(at, size))
                    sizes.append(size)
                    inside = run_hashes(hashes, np.arange(at, at + size - width + 1), width)
                    shingles.append(inside.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()), pa.array(texts, pa.binary()),
                    pa.array(sizes, pa.int32()), pa.array(shingles, pa.list_(pa.int64())),
                ],
                ["item", "words", "n_words", "shingles"],
            )

    item = F.coalesce(named(id_col).cast("string"), F.lit("")).alias("item")
    given = items.select(item, named(text_col).alias("text"))
    return given.mapInArrow(cut, "item string, words binary, n_words int, shingles array<long>")


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The different windows, numbered (window, words, n_words, shingles), and which items hold
    them (window, item)."""
    each = staged(windows_by_item(items, id_col, text_col, window, shingle), "bench-each")
    different = each.groupBy("words").agg(F.first("n_words").alias("n_words"), F.first("shingles").alias("shingles"))
    windows = staged(different.select(F.monotonically_increasing_id().alias("window"), "*"), "bench-windows")
    holders = each.select("words", "item").distinct().join(sized(windows.select("words", "window")), "words")
    return windows, staged(holders.select("window", "item"), "bench-holders")


def shingle_counts(docs: DataFrame, text_col: str, wanted: dict[int, np.ndarray]) -> DataFrame:
    """How often each wanted shingle stands in all documents: shingle, n (absent: never).

    `wanted` has sorted hashes by the number of words in the shingle. A task counts all it reads
    and gives a row per shingle that it met.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {width: np.zeros(len(keys), np.int64) for width, keys in wanted.items()}
        for batch in batches:
            for part in slices(batch.column(0), SLICE_BYTES):
                words = Words(part)
                hashes = words.hashes()
                for width, keys in wanted.items():
                    at = shingle_hits(words, hashes, width, keys)[1]
                    totals[width] += np.bincount(at, minlength=len(keys))
        for width, keys in wanted.items():
            met = np.flatnonzero(totals[width])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[met].view(np.int64)), pa.array(totals[width][met])], ["shingle", "n"]
            )

    counted = docs.select(named(text_col)).mapInArrow(count, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def shingle_hits(
    words: Words, hashes: np.ndarray, width: int, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which a shingle of `keys` (sorted) starts, and its place in `keys`."""
    first = np.arange(max(0, len(hashes) - width + 1))
    text = words.text_of()
    first = first[text[: len(first)] == text[width - 1 :]] if len(first) else first
    if not len(first) or not len(keys):
        return first[:0], first[:0]
    made = run_hashes(hashes, first, width)
    # A table of the upper bits turns nearly all positions away before the search.
    seen = np.zeros(1 << 20, dtype=bool)
    seen[(keys >> np.uint64(44)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(made >> np.uint64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(keys, made[maybe]), len(keys) - 1)
    same = keys[at] == made[maybe]
    return first[maybe[same]], at[same]


@dataclass
class Prefixes:
    """The join's index: each window under its rarest shingle, sorted by that shingle's hash.

    To contain a window whole, a text must contain every shingle of it, so one prefix token, the
    rarest, is enough. `offset` is where it stands in the window.
    """

    width: int
    keys: np.ndarray  # different prefix shingles, sorted
    begin: np.ndarray  # windows of key i: begin[i] to begin[i + 1]
    offset: np.ndarray
    n_words: np.ndarray
    words: list[bytes]
    window: np.ndarray  # numbers of the windows


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """The windows with their prefix token: shingle, offset."""
    each = windows.select("window", F.posexplode("shingles").alias("offset", "shingle"))
    ranked = each.join(counts, "shingle", "left").groupBy("window").agg(
        F.min_by(
            F.struct("shingle", "offset"), F.struct(F.coalesce("n", F.lit(0)), "shingle", "offset")
        ).alias("prefix")
    )
    return windows.join(ranked, "window").select("window", "words", "n_words", "prefix.*")


def index_of(rows: pa.Table, shingle: int) -> list[Prefixes]:
    """The index of one block, by the width of its shingles."""
    found = []
    widths = np.minimum(np.asarray(rows["n_words"]), shingle)
    for width in np.unique(widths).tolist():
        part = rows.filter(pa.array(widths == width))
        shingles = np.asarray(part["shingle"]).view(np.uint64)
        order = np.argsort(shingles, kind="stable")
        part, shingles = part.take(pa.array(order)), shingles[order]
        keys, begin = np.unique(shingles, return_index=True)
        found.append(
            Prefixes(
                width, keys, np.append(begin, len(shingles)), np.asarray(part["offset"]),
                np.asarray(part["n_words"]), part["words"].to_pylist(), np.asarray(part["window"]),
            )
        )
    return found


def occurrences(words: Words, hashes: np.ndarray, index: Prefixes) -> Iterator[tuple[int, int]]:
    """(first word, window) wherever a window of the index stands in one text, word for word."""
    at, key = shingle_hits(words, hashes, index.width, index.keys)
    several = index.begin[key + 1] - index.begin[key]
    at = np.repeat(at, several)
    window = np.repeat(index.begin[key] - (np.cumsum(several) - several), several) + np.arange(len(at))
    first = at - index.offset[window]
    # Length and position bounds: as many words before and after as the window needs.
    text = np.searchsorted(words.bounds, at, side="right") - 1
    fits = (first >= words.bounds[text]) & (first + index.n_words[window] <= words.bounds[text + 1])
    for start, nth in zip(first[fits].tolist(), window[fits].tolist()):
        if words.join(start, int(index.n_words[nth])) == index.words[nth]:
            yield start, nth


def indexes(
    docs: DataFrame, text_col: str, windows: DataFrame, shingle: int, block_windows: int
) -> Iterator[list[Prefixes]]:
    """The join's index, a bounded block of windows at a time.

    The driver holds one block: up to about `block_windows` windows or BLOCK_BYTES of their words,
    with nothing of the items that hold them. At least one block, empty without windows.
    """
    n, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("words")), F.lit(0))).first()
    blocks = max(1, -(-n // block_windows), -(-size // BLOCK_BYTES))
    for nth in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == nth)
        width = F.least("n_words", F.lit(shingle)).alias("width")
        tokens = part.select(width, F.explode("shingles").alias("shingle")).distinct().toArrow()
        widths, shingles = np.asarray(tokens["width"]), np.asarray(tokens["shingle"]).view(np.uint64)
        wanted = {w: np.sort(shingles[widths == w]) for w in np.unique(widths).tolist()}
        counts = staged(shingle_counts(docs, text_col, wanted), "bench-shingles")
        yield index_of(rarest(part, counts).toArrow(), shingle)


def hits_of(texts: pa.Array, index: list[Prefixes]) -> tuple[Words, np.ndarray, dict[int, set[int]]]:
    """The words of the texts, whether each is hit, and the windows that each text holds, if any."""
    words = Words(texts)
    hashes = words.hashes()
    hit = np.zeros(len(hashes), dtype=bool)
    found: dict[int, set[int]] = {}
    for prefixes in index:
        for start, nth in occurrences(words, hashes, prefixes):
            hit[start : start + prefixes.n_words[nth]] = True
            text = int(np.searchsorted(words.bounds, start, side="right")) - 1
            found.setdefault(text, set()).add(int(prefixes.window[nth]))
    return words, hit, found


RUNS = "array<struct<first:int,last:int>>"
_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def mark_hits(docs: DataFrame, carry: list[str], index: list[Prefixes], only_hit: bool) -> DataFrame:
    """`carry`, n_words, runs (of hit words, from 0) and windows of each document in _scanned; with
    `only_hit` just the documents that hold a window."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # one bounded block

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(0), SLICE_BYTES):
                words, hit, found = hits_of(part, shared.value)
                chosen = sorted(found) if only_hit else range(len(part))
                runs = []
                for i in chosen:
                    own = hit[words.bounds[i] : words.bounds[i + 1]] if i in found else hit[:0]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                    runs.append([{"first": a, "last": b - 1} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())])
                made = [
                    pa.array(np.diff(words.bounds)[list(chosen)], pa.int64()), pa.array(runs, _RUNS),
                    pa.array([sorted(found.get(i, ())) for i in chosen], pa.list_(pa.int64())),
                ]
                passed = [c.slice(at, len(part)).take(pa.array(chosen, pa.int64())) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*passed, *made], [*batch.schema.names[1:], "n_words", "runs", "windows"])
                at += len(part)

    made = schema_of(docs, carry, f"n_words long, runs {RUNS}, windows array<long>")
    return docs.select("_scanned", *[named(c) for c in carry]).mapInArrow(mark, made)


def merged(runs: Column) -> Column:
    """Sorted runs that may overlap or touch, as runs that do not."""

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], run["last"]).alias("last"))),
        )
        apart = (F.size(done) == 0) | (run["first"] > F.try_element_at(done, F.lit(-1))["last"] + 1)
        return F.when(apart, F.concat(done, F.array(run))).otherwise(joined)

    return F.aggregate(F.array_sort(runs), F.array().cast(RUNS), add)


def contaminated_words(
    docs: DataFrame,
    items: DataFrame,
    carry: list[str],
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Every document with what benchmark items it holds: `carry`, n_words, n_hit, runs, items.

    Words are runs of digits, letters and non-ASCII characters, A-Z lowered. A document word is
    hit when it lies in any occurrence of an item window. `items` lists the items with occurring
    windows, sorted; `runs` has the first and last word (from 0) of each run of hit words.

    The windows' shingles are counted in all documents and each window is filed under its rarest
    one. A second scan looks only those up, checks that the document has room for the window
    around the shingle, and compares the window word for word. The windows are sent out by number
    in bounded blocks; with more than one the documents are stored once, and scanned for each
    block. Spark joins the numbers to the items that hold the windows, however many do.

    Cases: null and empty texts have no words; a very long text is scanned whole, in one task; an
    item of fewer words than a window is one window, one without words is none; a null item id
    reads as the empty string; items repeated under one id count once; repeated documents are
    marked alike; no documents or no items give no hits; `carry` may name any columns except those
    made here and _doc.
    """
    windows, holders = item_windows(items, item_id_col, item_text_col, window, shingle)
    scanned = docs.select(named(text_col).alias("_scanned"), F.monotonically_increasing_id().alias("_doc"), *[named(c) for c in carry])
    passes = indexes(docs, text_col, windows, shingle, block_windows)
    first, second = next(passes), next(passes, None)
    if second is not None:
        scanned = staged(scanned, "bench-texts")
    marked = staged(mark_hits(scanned, ["_doc", *carry], first, False), "bench-marked")
    hit = marked.where("size(windows) > 0").select("_doc", "runs", "windows")
    if second is not None:
        for index in (second, *passes):
            hit = hit.unionByName(staged(mark_hits(scanned, ["_doc"], index, True), "bench-block").drop("n_words"))
        hit = hit.groupBy("_doc").agg(
            merged(F.flatten(F.collect_list("runs"))).alias("runs"), F.flatten(F.collect_list("windows")).alias("windows")
        )
        hit = staged(hit, "bench-hit")
    held = hit.select("_doc", F.explode("windows").alias("window")).join(sized(holders), "window")
    held = held.select("_doc", "item").distinct().groupBy("_doc").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = hit.select("_doc", "runs").join(held, "_doc")
    # A document's number is its own, so this join has no hot key.
    whole = marked.drop("runs", "windows").join(found.hint("merge"), "_doc", "left")
    runs = F.coalesce("runs", F.array().cast(RUNS))
    n_hit = F.aggregate(runs, F.lit(0).cast("long"), lambda n, run: n + run["last"] - run["first"] + 1)
    items_held = F.coalesce("items", F.array().cast("array<string>"))
    return whole.select(*[named(c) for c in carry], "n_words", n_hit.alias("n_hit"), runs.alias("runs"), items_held.alias("items"))


def clean_texts(docs: DataFrame, index: list[Prefixes]):
    """A function of a text column: whether the text holds no window of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # one bounded block

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        kept: list[bool] = []
        for part in slices(texts, SLICE_BYTES):
            found = hits_of(part, shared.value)[2]
            kept += [i not in found for i in range(len(part))]
        return pa.array(kept, pa.bool_())

    return clean


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The rows of `docs` whose text holds no window of any item, as they are.

    The same index and scan as `contaminated_words`, whose cases hold. Only the text goes through
    Python; the rows stay where they are and nothing is shuffled.
    """
    windows, _ = item_windows(items, item_id_col, item_text_col, window, shingle)
    rows = docs
    for nth, index in enumerate(indexes(docs, text_col, windows, shingle, block_windows)):
        # Several blocks in one plan would stand in the workers' memory at once.
        rows = staged(rows, "bench-clean") if nth else rows
        rows = rows.where(clean_texts(docs, index)(named(text_col)))
    return rows
