"""Repeated passages by prefix-free parsing of the corpus.

A rolling hash over TRIGGER bytes marks trigger positions by content alone; the text between two
of them is a phrase. A window of WINDOW bytes that starts in a phrase is the phrase's suffix from
there, then a prefix of the parse from the next trigger on. So equal windows have their first
trigger at the same offset, and windows are compared trigger by trigger: the parse behind a
trigger prunes what occurs once, blocks of offsets settle most of the rest as a whole, and only
blocks at the edge of a repeated passage are compared window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.plans import sized
from wattledger.llm.common import join_groups, staged, whole_text
from wattledger.llm.encoding import slices
from wattledger.llm.wordscan import BASE, byte_view, powers

WINDOW = 400
TRIGGER = 16
# One position in SPACING is a trigger; in stretches without one, as text that repeats itself has
# them, one in SPARE_SPACING of another kind.
SPACING = 64
SPARE_SPACING = 4
# A window is filed under its first trigger if that starts within its first REACH bytes, else under
# its first spare trigger there; the few windows without either are compared by themselves. The
# rest of the window is behind any trigger.
REACH = 340
# Offsets of windows that are settled together.
BLOCK = 32
SLICE_BYTES = 1 << 18
# Fingerprints of documents that may be sent to every executor.
BROADCAST_DOCS = 500_000

_BASES = (BASE, 0xD1342543DE82EF95)
_TABLES = [np.random.default_rng(n).integers(1, 1 << 63, 256, dtype=np.uint64) for n in (31, 32)]


class Parse:
    """The texts of one slice: positions count over all of them, `offsets` bound the texts."""

    def __init__(self, texts: pa.Array) -> None:
        self.buffer, self.offsets = byte_view(texts)
        size = len(self.buffer)
        self.sums, self.back = [], []
        for base, table in zip(_BASES, _TABLES):
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(table[self.buffer] * powers(base, size), out=sums[1:])
            self.sums.append(sums)
            self.back.append(powers(pow(base, -1, 1 << 64), size + 1))
        at = np.arange(max(0, size - TRIGGER + 1))
        rolled = self.digest(at, at + TRIGGER)
        text = self.text_of(at)
        inside = at + TRIGGER <= self.offsets[text + 1]
        main = inside & ((rolled >> np.uint64(40)) % np.uint64(SPACING) == 0)
        self.triggers, self.text = at[main], text[main]
        # The gap to the trigger before, or to the text's start.
        begin = self.offsets[self.text]
        before = np.concatenate([[-1], self.triggers[:-1]])[: len(self.triggers)]
        gap = np.where(before >= begin, self.triggers - before, self.triggers - begin + 1)
        # Offsets of the windows that have this trigger as their first one.
        self.least = np.maximum(0, self.triggers + WINDOW - self.offsets[self.text + 1])
        self.most = np.minimum(gap, REACH) - 1
        self.add_spares(at[inside & ((rolled >> np.uint64(20)) % np.uint64(SPARE_SPACING) == 0)])

    def add_spares(self, spares: np.ndarray) -> None:
        """Files windows without a trigger under their first spare one, where there is any."""
        alone = self.bare()
        if not len(alone) or not len(spares):
            return
        place = np.searchsorted(spares, alone)
        spare = spares[np.minimum(place, len(spares) - 1)]
        near = (place < len(spares)) & (spare - alone < REACH) & (self.text_of(spare) == self.text_of(alone))
        alone, spare = alone[near], spare[near]
        # The windows of a spare trigger are neighbours: those before it up to the one before that.
        spare, first, count = np.unique(spare, return_index=True, return_counts=True)
        self.triggers = np.append(self.triggers, spare)
        self.text = np.append(self.text, self.text_of(spare))
        self.most = np.append(self.most, spare - alone[first])
        self.least = np.append(self.least, spare - alone[first + count - 1])

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def digest(self, start: np.ndarray, stop: np.ndarray, nth: int = 0) -> np.ndarray:
        """A 64-bit hash of the bytes from start to stop; equal bytes, equal hash."""
        made = (self.sums[nth][stop] - self.sums[nth][start]) * self.back[nth][start]
        return made ^ (made >> np.uint64(32))

    def bare(self) -> np.ndarray:
        """Starts of windows that no trigger has."""
        covered = np.zeros(len(self.buffer) + 1, dtype=np.int64)
        filed = self.most >= self.least
        np.add.at(covered, (self.triggers - self.most)[filed], 1)
        np.add.at(covered, (self.triggers - self.least)[filed] + 1, -1)
        lengths = np.diff(self.offsets)
        room = np.maximum(lengths - WINDOW + 1, 0)
        valid = np.repeat(self.offsets[:-1] - (np.cumsum(room) - room), room) + np.arange(room.sum())
        return valid[np.cumsum(covered)[valid] == 0]


def spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of the `count` numbers from `first`, and the place it comes from."""
    source = np.repeat(np.arange(len(first)), count)
    return first[source] + np.arange(len(source)) - (np.cumsum(count) - count)[source], source


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers in a rising list."""
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    return at[np.concatenate([[0], cut])] if len(at) else at, at[np.append(cut - 1, len(at) - 1)] if len(at) else at


def parsed(docs: DataFrame) -> DataFrame:
    """From (doc, text), rows (kind, h1, h2, doc, at, last):

    - trigger: windows are filed under the trigger at `at`; h1 hashes the parse right behind it;
    - window: a window without a trigger starts at `at`, hashed whole, once for each text;
    - settled: windows without a trigger start at `at` to `last` and occur in this text again.

    The last kind keeps text that repeats itself closely, and so may have no trigger for long
    stretches, from giving a row per byte.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, at = np.asarray(batch.column(0)), 0
            for part in slices(batch.column(1), SLICE_BYTES):
                found, own = Parse(part), names[at : at + len(part)]
                at += len(part)
                used = found.least <= found.most
                trigger, alone = found.triggers[used], found.bare()
                key = found.digest(trigger, trigger + WINDOW - REACH)
                h1, h2 = found.digest(alone, alone + WINDOW), found.digest(alone, alone + WINDOW, 1)
                order = np.lexsort((h2, h1, found.text_of(alone)))
                sorted_rows = np.stack([found.text_of(alone)[order].astype(np.uint64), h1[order], h2[order]])
                new = np.append(True, (sorted_rows[:, 1:] != sorted_rows[:, :-1]).any(axis=0))[: len(order)]
                group = np.cumsum(new) - 1
                again = np.bincount(group)[group] > 1 if len(group) else new
                one = order[new]
                first, last = runs(np.sort(alone[order[again]]))
                # Runs may touch across texts; they are cut at the bounds of the texts.
                inner = found.offsets[1:-1]
                cuts = np.searchsorted(first, inner, side="right") - 1
                across = (cuts >= 0) & (first[cuts] < inner) & (last[cuts] >= inner) if len(first) else inner < 0
                first, last = np.sort(np.append(first, inner[across])), np.sort(np.append(last, inner[across] - 1))
                where = np.concatenate([trigger, alone[one], first])
                kind = np.repeat(["trigger", "window", "settled"], [len(trigger), len(one), len(first)])
                none = np.zeros(len(first), np.uint64)
                text = found.text_of(where)
                base = found.offsets[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kind.tolist(), pa.string()), longs(np.concatenate([key, h1[one], none])),
                        longs(np.concatenate([key * 0, h2[one], none])), pa.array(own[text]), pa.array(where - base),
                        pa.array(np.concatenate([trigger, alone[one], last]) - base),
                    ],
                    ["kind", "h1", "h2", "doc", "at", "last"],
                )

    made = "kind string, h1 long, h2 long, doc long, at long, last long"
    return docs.select("doc", "text").mapInArrow(parse, made)


def blocks_of(docs: DataFrame) -> DataFrame:
    """From (doc, text, places = live triggers): a row per block of offsets of each trigger.

    Window starts first to last belong to the block. h1 and h2 hash the bytes from its first
    window's start to its last one's end; core hashes the bytes that all windows of a full block
    share, so windows of blocks with different cores differ.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, places, at = np.asarray(batch.column(0)), batch.column(2), 0
            for part in slices(batch.column(1), SLICE_BYTES):
                found, own = Parse(part), names[at : at + len(part)]
                lists = places.slice(at, len(part))
                at += len(part)
                counts = np.diff(np.asarray(lists.offsets))
                live = np.asarray(lists.flatten()) + np.repeat(found.offsets[:-1], counts)
                nth = np.flatnonzero(np.isin(found.triggers, live))
                low, high = found.least[nth] // BLOCK, found.most[nth] // BLOCK
                block, source = spread(low, high - low + 1)
                nth = nth[source]
                trigger = found.triggers[nth]
                least = np.maximum(block * BLOCK, found.least[nth])
                most = np.minimum(block * BLOCK + BLOCK - 1, found.most[nth])
                first, last = trigger - most, trigger - least
                core_stop = trigger + WINDOW - (block * BLOCK + BLOCK - 1)
                base = found.offsets[found.text[nth]]
                yield pa.RecordBatch.from_arrays(
                    [
                        longs(found.digest(first, last + WINDOW)),
                        longs(found.digest(first, last + WINDOW, 1)),
                        longs(found.digest(trigger - block * BLOCK, core_stop)),
                        pa.array(own[found.text[nth]]), pa.array(first - base), pa.array(last - base),
                    ],
                    ["h1", "h2", "core", "doc", "first", "last"],
                )

    made = "h1 long, h2 long, core long, doc long, first long, last long"
    return docs.select("doc", "text", "places").mapInArrow(cut, made)


def windows_of(docs: DataFrame) -> DataFrame:
    """From (doc, text, places = structs of first and last): a row (h1, h2, doc, at) per window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, places, at = np.asarray(batch.column(0)), batch.column(2), 0
            for part in slices(batch.column(1), SLICE_BYTES):
                found, own = Parse(part), names[at : at + len(part)]
                lists = places.slice(at, len(part))
                at += len(part)
                text = np.repeat(np.arange(len(part)), np.diff(np.asarray(lists.offsets)))
                first, last = (np.asarray(lists.flatten().field(i)) for i in (0, 1))
                start, source = spread(first + found.offsets[text], last - first + 1)
                text = text[source]
                yield pa.RecordBatch.from_arrays(
                    [
                        longs(found.digest(start, start + WINDOW)),
                        longs(found.digest(start, start + WINDOW, 1)),
                        pa.array(own[text]), pa.array(start - found.offsets[text]),
                    ],
                    ["h1", "h2", "doc", "at"],
                )

    return docs.select("doc", "text", "places").mapInArrow(cut, "h1 long, h2 long, doc long, at long")


def removed_of(docs: DataFrame) -> DataFrame:
    """From (doc, text, places = structs of start and stop): doc, n_removed, n_spans, kept_sha256."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, places in zip(*(batch.column(i) for i in range(3))):
                data = text.as_buffer().to_pybytes()
                start, stop = (np.asarray(places.values.field(i)) for i in (0, 1))
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, stop, -1)
                gone = np.cumsum(edge)[:-1] > 0
                runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                rows.append((doc.as_py(), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
            made = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(made, kinds)], ["doc", "n_removed", "n_spans", "kept_sha256"]
            )

    return docs.select("doc", "text", "places").mapInArrow(
        cut, "doc long, n_removed long, n_spans long, kept_sha256 string"
    )


def with_places(texts: DataFrame, rows: DataFrame, place: Column) -> DataFrame:
    """The texts that have rows, with their places as a list; a list is bounded by its text."""
    lists = rows.groupBy("doc").agg(F.collect_list(place).alias("places"))
    lists = staged(lists, "repeat-places")
    named = texts.join(sized(lists.select("doc"), BROADCAST_DOCS), "doc", "left_semi")
    return named.join(lists.hint("merge"), "doc")


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with what is left without repeated passages: id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 (of the remaining bytes).

    A byte goes if it lies in a string of WINDOW bytes that starts at another position too, in
    this text or another; all strings are judged on the input. Texts are UTF-8 bytes and never
    run on into each other. Strings are told apart by 128 bits of hash, texts by 64 of their
    SHA-256.

    Cases: a null text is empty; texts below WINDOW bytes stay whole; a text that stands in
    several rows (under any ids, null too) goes whole from all of them, and only one of the rows
    is parsed; other columns are not looked at; an empty table gives an empty result.
    """
    sha = F.sha2(whole_text(text_col), 256)
    named = docs.select(
        F.col(id_col), F.xxhash64(sha).alias("doc"), whole_text(text_col).cast("binary").alias("text"), sha.alias("_sha")
    )
    rows = staged(named.select(id_col, "doc", F.length("text").cast("long").alias("n_bytes"), "_sha"), "repeat-rows")
    copies = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("_copies"), F.min(id_col).alias("_least"))
    copies = staged(copies.where("_copies > 1"), "repeat-copies")
    long_ones = named.where(F.length("text") >= WINDOW).select(id_col, "doc", "text")
    chosen = long_ones.join(sized(copies, BROADCAST_DOCS), "doc", "left")
    chosen = chosen.where(F.col("_copies").isNull() | F.col(id_col).eqNullSafe(F.col("_least")))
    texts = chosen.select("doc", "text")

    parse = staged(parsed(texts), "repeat-parse")
    triggers = parse.where("kind = 'trigger'")
    often = triggers.groupBy("h1").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    live = join_groups(triggers.select("h1", "doc", "at"), staged(often, "repeat-often"), "h1", "_n")
    live = live.where(F.col("_n") > 1)

    blocks = staged(blocks_of(with_places(texts, live, F.col("at"))), "repeat-blocks")
    span = F.struct("doc", "first", "last", "core")
    wholes = blocks.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n"), F.min(span).alias("one"))
    wholes = staged(wholes, "repeat-wholes")
    settled = join_groups(blocks, wholes.where("_n > 1").drop("one"), ["h1", "h2"], "_n")
    settled = settled.where(F.col("_n") > 1)
    # One block of each kind is enough to compare windows; cores that only one kind has need none.
    kinds = wholes.select("one.*")
    shared = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("_kinds")).where("_kinds > 1")
    edges = kinds.join(shared.select("core"), "core", "left_semi")

    windows = windows_of(with_places(texts, edges, F.struct("first", "last")))
    windows = windows.unionByName(parse.where("kind = 'window'").select("h1", "h2", "doc", "at"))
    windows = staged(windows, "repeat-windows")
    twice = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    twice = join_groups(windows, staged(twice, "repeat-twice"), ["h1", "h2"], "_n").where(F.col("_n") > 1)

    settled = settled.select("doc", "first", "last").unionByName(
        parse.where("kind = 'settled'").select("doc", F.col("at").alias("first"), "last")
    )
    spans = settled.select("doc", F.col("first").alias("start"), (F.col("last") + WINDOW).alias("stop"))
    spans = spans.unionByName(twice.select("doc", F.col("at").alias("start"), (F.col("at") + WINDOW).alias("stop")))
    single = spans.join(sized(copies.select("doc"), BROADCAST_DOCS), "doc", "left_anti")
    cut = staged(removed_of(with_places(texts, single, F.struct("start", "stop"))), "repeat-cut")
    cut = cut.withColumn("_rows", F.lit(1))
    copied = copies.select(
        "doc", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"), F.col("_copies").alias("_rows"),
    )
    found = join_groups(rows, staged(cut.unionByName(copied), "repeat-found"), "doc", "_rows")
    gone = F.col("n_spans").isNotNull() & (F.col("n_bytes") >= WINDOW)
    return found.select(
        F.col(id_col),
        "n_bytes",
        F.when(gone, F.coalesce("n_removed", "n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(gone, F.col("n_spans")).otherwise(0).cast("long").alias("n_spans"),
        F.when(gone, F.col("kept_sha256")).otherwise(F.col("_sha")).alias("kept_sha256"),
    )
