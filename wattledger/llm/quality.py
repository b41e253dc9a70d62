"""Quality scores: random Fourier features, ridge from summed normal equations, isotonic calibration."""

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
from wattledger.llm.wordscan import SLICE_BYTES, Words, byte_view, run_hashes

FOURIER = 256
KERNEL_WIDTH = 8.0
RIDGE = 1e-4
SEED = 7
FOLDS = 5
THRESHOLD = 0.3
# Raw scores are calibrated in steps of this width between -1 and 2.
STEP = 0.005
# Share of the raw score that keeps the order within a level of the calibration.
ORDER_SHARE = 1e-3
# Standardised statistics are held within this range.
REACH = 6.0

STATISTICS = (
    "log_bytes", "log_words", "upper", "digit", "space", "newline", "mark", "symbol", "beyond_ascii",
    "word_length", "long_words", "short_words", "different_words", "top_word", "repeated_neighbour",
    "different_triples", "sentence_ends", "words_per_line", "different_lines",
)


def byte_classes() -> np.ndarray:
    """0 lower letter, 1 upper letter, 2 digit, 3 space, 4 line end, 5 mark, 6 symbol, 7 beyond ASCII."""
    kinds = np.full(256, 6, dtype=np.int64)
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 0, 1, 2, 7
    kinds[[9, 11, 12, 13, 32]] = 3
    kinds[10] = 4
    kinds[[ord(c) for c in ".,;:!?'\"()-"]] = 5
    return kinds


CLASSES = byte_classes()


def different(owner: np.ndarray, values: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner, the number of different values and how often the most frequent one occurs."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(new)
    often = np.diff(np.append(first, len(owner)))
    most = np.zeros(owners, dtype=np.int64)
    np.maximum.at(most, owner[first], often)
    return np.bincount(owner[first], minlength=owners), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each whole text; shares of an empty text are zero."""
    n = len(texts)
    if not n:
        return np.zeros((0, len(STATISTICS)))
    words = Words(texts)
    sizes = np.diff(words.offsets)
    raw = byte_view(texts)[0]
    text_of_byte = np.repeat(np.arange(n), sizes)
    classes = np.bincount(text_of_byte * 8 + CLASSES[raw], minlength=n * 8).reshape(n, 8)
    ends = np.bincount(text_of_byte[np.isin(raw, [46, 33, 63])], minlength=n)

    owner, hashes = words.text_of(), words.hashes()
    count = np.bincount(owner, minlength=n)
    length = words.ends - words.starts
    kinds, most = different(owner, hashes, n)
    same = owner[1:][(owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1])]
    at = np.arange(max(0, len(owner) - 2))
    at = at[owner[: len(at)] == owner[2:]] if len(at) else at
    triples, _ = different(owner[at], run_hashes(hashes, at, 3), n)

    breaks = np.flatnonzero(raw == 10)
    line_ends = np.union1d(breaks, words.offsets[1:])
    line_starts = np.concatenate([[0], line_ends[:-1]])
    line_owner = np.searchsorted(words.offsets, line_starts, side="right") - 1
    filled = line_ends > line_starts
    first = np.searchsorted(words.starts, line_starts[filled])
    last = np.searchsorted(words.starts, line_ends[filled])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)])
    line_owner = np.minimum(line_owner[filled], n - 1)
    with_words = last > first
    lines = np.bincount(line_owner[with_words], minlength=n)
    line_kinds, _ = different(line_owner[with_words], (sums[last] - sums[first])[with_words], n)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    return np.column_stack(
        [
            np.log1p(sizes), np.log1p(count),
            *[share(classes[:, k], sizes) for k in (1, 2, 3, 4, 5, 6, 7)],
            share(np.bincount(owner, weights=length, minlength=n), count),
            share(np.bincount(owner[length > 20], minlength=n), count),
            share(np.bincount(owner[length <= 3], minlength=n), count),
            share(kinds, count), share(most, count), share(np.bincount(same, minlength=n), count),
            share(triples, np.maximum(count - 2, 0)), share(ends, count),
            np.log1p(share(count, lines)), share(line_kinds, lines),
        ]
    )


def document_statistics(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """`carry` and _stats, the statistics of the whole text (null: empty)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [statistics(p) for p in slices(batch.column(0), SLICE_BYTES)]
            rows = np.concatenate([np.zeros((0, len(STATISTICS))), *parts])
            bounds = pa.array(np.arange(len(rows) + 1) * len(STATISTICS), pa.int32())
            made = pa.ListArray.from_arrays(bounds, pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], made], [*batch.schema.names[1:], "_stats"])

    given = docs.select(named(text_col).alias("_text"), *[named(c) for c in carry])
    return given.mapInArrow(measure, schema_of(docs, carry, "_stats array<double>"))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray  # of all folds together, or one column for each fold left out
    knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of the Gaussian kernel, and a constant."""
        standard = np.clip((x - self.mean) / self.spread, -REACH, REACH)
        waves = np.cos(standard @ self.frequency + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.column_stack([waves, np.ones(len(x))])

    def scores(self, raw: np.ndarray) -> np.ndarray:
        level = np.interp(raw, *self.knots)
        return (1 - ORDER_SHARE) * level + ORDER_SHARE * np.clip(raw, 0, 1)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS))


def normal_equations(train: DataFrame, model: Model) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """Per fold: the features' product matrix, their product with the labels, the number of rows.

    Each task sums over its rows and gives one row per cell; Spark adds the cells. The driver
    gets as many cells as the features' number squared, whatever the number of rows.
    """
    size = len(model.phase) + 1
    row, col = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            fold, y, x = (np.asarray(batch.column(0)), np.asarray(batch.column(1)), matrix(batch.column(2)))
            z = model.features(x)
            for k in np.unique(fold).tolist():
                own, label = z[fold == k], y[fold == k]
                cells = np.concatenate([(own.T @ own)[row, col], own.T @ label, [len(own)]])
                total[k] = total.get(k, 0) + cells
        for k, cells in total.items():
            place = np.arange(len(cells), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cells), k, np.int32)), pa.array(place), pa.array(cells)],
                ["fold", "cell", "v"],
            )

    cells = train.select("fold", "y", "_stats").mapInArrow(sums, "fold int, cell int, v double")
    summed = cells.groupBy("fold", "cell").agg(F.sum("v").alias("v")).toArrow()
    fold, cell, v = (np.asarray(summed[c]) for c in ("fold", "cell", "v"))
    found = {}
    for k in np.unique(fold).tolist():
        flat = np.zeros(len(row) + size + 1)
        flat[cell[fold == k]] = v[fold == k]
        product = np.zeros((size, size))
        product[row, col] = flat[: len(row)]
        product[col, row] = flat[: len(row)]
        found[k] = (product, flat[len(row) : -1], int(flat[-1]))
    return found


def ridge(parts: list[tuple[np.ndarray, np.ndarray, int]], size: int, strength: float) -> np.ndarray:
    """Weights of the summed parts; the constant is not shrunk. No rows give zero weights."""
    product, right, rows = (sum(p[i] for p in parts) for i in range(3)) if parts else (0, 0, 0)
    if not rows:
        return np.zeros(size)
    shrink = np.full(size, strength * rows)
    shrink[-1] = 1e-9
    return np.linalg.solve(product + np.diag(shrink), right)


def rising(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours; knots are the pools' mean raw score and label."""
    pools: list[list[float]] = []
    for x, y, w in zip(raw, label, weight):
        pools.append([x * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    made = np.array(pools)
    return made[:, 0] / made[:, 2], made[:, 1] / made[:, 2]


def fold_of(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id reads as empty."""
    return (F.crc32(F.coalesce(named(id_col).cast("string"), F.lit(""))) % FOLDS).cast("int")


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """A model of `label_col` (0 or 1, null: unlabelled) from all labelled rows outside fold 0.

    `stats` has the id and _stats. The normal equations are kept per fold, so the rows of a fold can
    be scored by a model of the other folds; those scores, counted in steps, are what the
    isotonic calibration sees. Without labelled rows every score is 0.5.
    """
    marks = labels.select(F.col(id_col), F.col(label_col).cast("double").alias("y")).where("y is not null")
    train = stats.select(id_col, "_stats").join(marks.where(fold_of(id_col) > 0), id_col)
    train = staged(train.select(fold_of(id_col).alias("fold"), "y", "_stats"), "quality-train")
    each = [F.col("_stats")[i] for i in range(len(STATISTICS))]
    moments = train.agg(*[F.avg(c) for c in each], *[F.stddev_pop(c) for c in each]).first()
    size = len(STATISTICS)
    mean = np.array([v or 0.0 for v in moments[:size]])
    spread = np.array([v if v and v > 1e-9 else 1.0 for v in moments[size:]])
    random = np.random.default_rng(SEED)
    frequency = random.normal(size=(size, FOURIER)) / KERNEL_WIDTH
    model = Model(mean, spread, frequency, random.uniform(0, 2 * np.pi, FOURIER), np.zeros(FOURIER + 1))
    parts = normal_equations(train, model)
    model.weights = ridge(list(parts.values()), FOURIER + 1, RIDGE)
    if not parts:
        return model
    others = np.column_stack(
        [ridge([p for k, p in parts.items() if k != out], FOURIER + 1, RIDGE) for out in range(FOLDS)]
    )

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, x = np.asarray(batch.column(0)), matrix(batch.column(2))
            raw = np.clip((model.features(x) @ others)[np.arange(len(x)), fold], -1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1)], ["raw", "y"])

    scored = train.mapInArrow(crossed, "raw double, y double")
    steps = scored.groupBy(F.round(F.col("raw") / STEP).alias("step")).agg(
        F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")
    )
    counted = steps.orderBy("step").toArrow()  # at most 3 / STEP rows
    model.knots = rising(*(np.asarray(counted[c], dtype=float) for c in ("raw", "y", "n")))
    return model


def score(stats: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """`carry` and score, from 0 to 1."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.features(matrix(batch.column(0))) @ model.weights
            made = pa.array(model.scores(raw))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], made], [*batch.schema.names[1:], "score"])

    given = stats.select("_stats", *[named(c) for c in carry])
    return given.mapInArrow(scored, schema_of(stats, carry, "score double"))


def text_scores(model: Model):
    """A function of a text column: the score of each whole text."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [model.scores(model.features(statistics(p)) @ model.weights) for p in slices(texts, SLICE_BYTES)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return scored


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """`fit` on documents: only the labelled ones are measured."""
    wanted = labels.where(fold_of(id_col) > 0).select(named(id_col)).distinct()
    labelled = docs.select(named(id_col), named(text_col)).join(sized(wanted), id_col, "left_semi")
    return fit(staged(document_statistics(labelled, [id_col], text_col), "quality-labelled"), labels, id_col)


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of `docs` that score `threshold` or more, as they are; cases as in `quality_scores`.

    Only the text goes through Python, once; the rows stay where they are and nothing is shuffled.
    """
    scored = text_scores(fit_documents(docs, labels, id_col, text_col))
    return docs.where(scored(named(text_col)) >= threshold)


def quality_scores(
    docs: DataFrame, labels: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row with its score and prediction: `carry`, held_out, score, predicted.

    Only statistics of the whole text enter the score. Labels come from rows outside fold 0.

    Cases: null and empty texts are scored like any other; a very long text is measured whole, in
    one task; repeated rows and ties are scored alike; a null id is held out and has no label; an id with several labels counts each; labels of one kind only give scores near that
    kind, no labels give 0.5; an empty table gives an empty result; `carry` may name any columns
    except those made here.
    """
    stats = document_statistics(docs, list(dict.fromkeys([*carry, id_col])), text_col)
    stats = staged(stats, "quality-statistics")
    scored = score(stats, fit(stats, labels, id_col), list(dict.fromkeys([*carry, id_col])))
    return scored.select(
        *[named(c) for c in carry], (fold_of(id_col) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
