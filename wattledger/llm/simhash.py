"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import join_groups, named, schema_of, staged
from wattledger.llm.components import components
from wattledger.llm.encoding import slices

SEED = 42
DISTANCE = 3
# Members of one table entry that are compared directly; larger entries are indexed once more.
ENTRY_MEMBERS = 1000
# Text that is hashed at a time.
SLICE_BYTES = 1 << 20
BLOCK_SHINGLES = 1 << 16


def text_fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """SimHash of each text as int64: words without white space, A-Z lowered, XXH64 per shingle."""
    import xxhash

    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    flat = words.flatten()
    bounds = np.asarray(words.offsets, dtype=np.int64)
    filled = np.asarray(pc.not_equal(flat, ""))
    bounds = np.concatenate([[0], np.cumsum(filled)])[bounds - bounds[0]]
    flat = flat.filter(pa.array(filled))
    # All words in a row with one space after each: a shingle is one slice of that.
    line = " ".join(flat.to_pylist()).encode()
    length = np.asarray(pc.binary_length(flat), dtype=np.int64)
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    n_words = np.diff(bounds)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    total = int(n_shingles.sum())
    result = np.zeros(len(texts), dtype=np.uint64)
    if not total:
        return result.view(np.int64)
    first = np.repeat(bounds[:-1] - (np.cumsum(n_shingles) - n_shingles), n_shingles) + np.arange(total)
    last = np.minimum(first + shingle, np.repeat(bounds[1:], n_shingles)) - 1
    digest = xxhash.xxh64_intdigest
    some = np.flatnonzero(n_shingles)
    begin = (np.cumsum(n_shingles) - n_shingles)[some]
    set_bits = np.zeros((len(some), 64), dtype=np.int64)
    # A block of shingles at a time, so that one very long text needs no more memory than others.
    for at in range(0, total, BLOCK_SHINGLES):
        block = slice(at, at + BLOCK_SHINGLES)
        pairs = zip(starts[first[block]].tolist(), ends[last[block]].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low = np.searchsorted(begin, at, side="right") - 1
        high = np.searchsorted(begin, at + len(hashes))
        here = np.maximum(begin[low:high], at) - at
        set_bits[low:high] += np.add.reduceat(bits, here, axis=0, dtype=np.int64)
    above = 2 * set_bits > n_shingles[some][:, None]
    result[some] = np.packbits(above, axis=1, bitorder="little").view("<u8").ravel()
    return result.view(np.int64)


def fingerprints(docs: DataFrame, carry: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """`carry` and fp, the 64-bit SimHash of the whole text as a long; no words give zero."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [text_fingerprints(p, shingle) for p in slices(batch.column(0), SLICE_BYTES)]
            made = pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], made], [*batch.schema.names[1:], "fp"])

    given = docs.select(named(text_col).alias("_text"), *[named(c) for c in carry])
    return given.mapInArrow(hashed, schema_of(docs, carry, "fp long"))


def ball(value: Column, bits: int) -> Column:
    """The value and each value with one more bit set.

    Of two values that differ in one bit, one has it unset, so they meet in the other's entry.
    """
    powers = F.array(*[F.lit(1 << i).cast("long") for i in range(bits)])
    return F.array_distinct(F.array_append(F.transform(powers, value.bitwiseOR), value))


def spanning(distance: int):
    """Links that join the members of each entry, by complete distance: a tree for each set of
    members that are linked within the entry, not all their pairs."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column(0):
                rest = np.unique(np.asarray(members.values)).view(np.uint64)
                while len(rest):
                    queue, rest = [rest[0]], rest[1:]
                    while queue and len(rest):
                        node = queue.pop()
                        near = np.bitwise_count(rest ^ node) <= distance
                        found, rest = rest[near], rest[~near]
                        left += [node] * len(found)
                        right += found.tolist()
                        queue += list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (left, right)], ["a", "b"]
            )

    return link


def near_links(prints: DataFrame, distance: int = DISTANCE, entry_members: int = ENTRY_MEMBERS) -> DataFrame:
    """Links (a, b) between different fingerprints that connect whatever is within `distance`.

    `prints` has a column fp without repeats. Two fingerprints at most three bits apart differ in
    at most one bit of their upper or lower half, so each enumerates the ball of radius one around
    each half and fetches the table entries it hits; complete distances decide. An entry with
    more than `entry_members` members is indexed again by the quarters of the other half in the
    same way. An entry yields a spanning tree of its links, so its rows are linear in its members.
    """
    if distance > 3:
        raise ValueError("halves with balls of radius one cover distances up to three")
    half = F.lit(0xFFFFFFFF)
    upper, lower = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(half)
    sides = F.explode(
        F.array(
            F.struct(F.lit(0).alias("side"), upper.alias("own"), lower.alias("other")),
            F.struct(F.lit(1).alias("side"), lower.alias("own"), upper.alias("other")),
        )
    )
    sided = prints.select("fp", sides.alias("s")).select("fp", "s.*")
    entries = sided.select("fp", "side", "other", F.col("own").alias("key"))
    probes = sided.select("fp", "side", "own", "other", F.explode(ball(F.col("own"), 32)).alias("key"))
    probes = probes.where("key <> own").drop("own")
    keys = entries.select("side", "key").distinct()
    hits = probes.join(keys, ["side", "key"], "left_semi")
    members = entries.unionByName(hits.select("fp", "side", "other", "key"))
    members = staged(members, "simhash-members")
    counted = members.groupBy("side", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = members.join(counted, ["side", "key"])
    small = counted.where(F.col("n") <= entry_members).groupBy("side", "key")
    large = counted.where(F.col("n") > entry_members)
    quarter = F.lit(0xFFFF)
    quarters = F.explode(
        F.array(
            F.struct(F.lit(0).alias("part"), F.shiftrightunsigned("other", 16).alias("value")),
            F.struct(F.lit(1).alias("part"), F.col("other").bitwiseAND(quarter).alias("value")),
        )
    )
    finer = large.select("fp", "side", "key", quarters.alias("q")).select("fp", "side", "key", "q.*")
    finer = finer.select("fp", "side", "key", "part", F.explode(ball(F.col("value"), 16)).alias("near"))
    groups = [small, finer.groupBy("side", "key", "part", "near")]
    lists = [g.agg(F.collect_list("fp").alias("members")).where("size(members) > 1") for g in groups]
    both = lists[0].select("members").unionByName(lists[1].select("members"))
    return both.mapInArrow(spanning(distance), "a long, b long")


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    carry: tuple[str, ...] = (),
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per input row: id, `carry`, fp, label (the component's least fingerprint) and
    component_id (the least id reachable over links).

    Fingerprints are linked when they differ in `distance` (three at most) bits or fewer; rows with
    one fingerprint are one node, so copies are never paired.

    Cases: null and empty texts have fingerprint zero, which is linked like any other; fewer
    words than a shingle give one shingle of all words; a very long text is hashed whole, a block
    of shingles at a time; a component without any id has a null component_id; repeated rows and
    equal texts get the same result; an empty table gives an empty result; `carry` may name any
    columns except those made here.
    """
    marked = staged(fingerprints(docs, [id_col, *carry], text_col, shingle), "simhash-docs")
    prints = marked.groupBy("fp").agg(F.min(named(id_col)).alias("_least"), F.count(F.lit(1)).alias("_rows"))
    prints = staged(prints, "simhash-prints")
    labels = components(near_links(prints.select("fp"), distance))
    nodes = prints.join(labels, prints["fp"] == labels["node"], "left").select(
        "fp", "_least", "_rows", F.coalesce("label", "fp").alias("label")
    )
    nodes = staged(nodes, "simhash-nodes")
    least = nodes.groupBy("label").agg(F.min("_least").alias("component_id"))
    placed = staged(nodes.join(least, "label").select("fp", "_rows", "label", "component_id"), "simhash-placed")
    found = join_groups(marked, placed, "fp", "_rows")
    return found.select(*[named(c) for c in (id_col, *carry)], "fp", "label", "component_id")


def hex_print(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
