"""Secret scans over a history of versions: an incremental ledger of content-addressed blobs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.plans import scratch_path, sized
from wattledger.llm.common import join_groups, named, staged, whole_text


@dataclass(frozen=True)
class Rule:
    """A kind of secret: every match of `pattern` whose `group` has `at_least` characters.

    `hint` is a cheaper pattern that every text with such a match contains.
    """

    kind: str
    pattern: str
    group: int
    at_least: int
    hint: str


# The kinds in the order in which ties at one start are listed.
RULES = (
    Rule(
        "assign",
        r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        r"""(?i)(?:word|passwd|secret|token|key)["']?\x20*[:=]""",
    ),
    Rule("access", r"(AKIA[A-Z0-9]+)", 1, 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"([0-9a-f]+)", 1, 16, r"[0-9a-f]{16}"),
)
RULE_VERSION = "1"

SPAN = "struct<start:bigint,nth:int,stop:bigint>"
FINDINGS = f"blob_id string, rule_version string, findings array<{SPAN}>"


def spans_of(text: Column, rule: Rule, nth: int) -> Column:
    """Spans (start, nth, stop) of the rule's matches, in code points, the end exclusive.

    The text between matches comes from a split by the same pattern, so match i starts after
    i + 1 pieces and i matches. Matches are never empty, so pieces and matches alternate.
    """
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    judged = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    steps = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), judged.alias("judged"))

    def extend(state: Column, step: Column) -> Column:
        start = state["at"] + step["piece"]
        stop = start + step["whole"]
        span = F.struct(
            start.cast("long").alias("start"), F.lit(nth).alias("nth"), stop.cast("long").alias("stop")
        )
        long_enough = step["judged"] >= rule.at_least
        found = F.when(long_enough, F.concat(state["found"], F.array(span)))
        return F.struct(
            F.coalesce(stop, start).cast("long").alias("at"),
            F.coalesce(found, state["found"]).alias("found"),
        )

    none = F.array().cast(f"array<{SPAN}>")
    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("found"))
    return F.when(
        text.rlike(rule.hint), F.aggregate(steps, begin, extend, lambda state: state["found"])
    ).otherwise(none)


def ledger_of(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows of all runs and attempts, one per blob and rule version, also when two
    runs scanned a blob at the same time."""
    rows = spark.read.schema(FINDINGS).option("recursiveFileLookup", True).parquet(path)
    return rows.dropDuplicates(["blob_id", "rule_version"])


def scan_history(
    versions: DataFrame,
    path_cols: list[str],
    text_col: str = "text",
    ledger: str | None = None,
    run: str = "first",
    earlier: bool = False,
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Findings of every version of every path: `path_cols`, blob_id, findings.

    A version's content is addressed by its SHA-256. Of the blobs in `versions`, those that the
    ledger folder has under this rule version are not scanned again (`earlier` says that the
    folder has runs); each other blob is scanned once, however many paths hold it. Findings are
    joined back to all paths. The ledger only grows: every call adds a part of its own below
    run `run`, with the blobs that no part had. So a run may be repeated, or several batches
    written under one name, and what was found before is found again without a new scan; a
    part that was not finished is not seen by readers.

    Cases: null content is the empty blob; null or repeated paths give a row each; a very long
    text is one blob, scanned whole; other columns are not looked at; an empty table adds no rows
    to the ledger and gives an empty result.
    """
    spark = versions.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    text = whole_text(text_col)
    blobs = versions.select(*[named(c) for c in path_cols], F.sha2(text, 256).alias("blob_id"), text.alias("_text"))
    paths = staged(blobs.select(*[named(c) for c in path_cols], "blob_id"), "secret-paths")
    if earlier:
        done = ledger_of(spark, ledger).where(F.col("rule_version") == rule_version)
        blobs = blobs.join(sized(done.select("blob_id")), "blob_id", "left_anti")
    # The first copy in each task is all that is shuffled, so a hot blob is no hot key.
    unseen = blobs.groupBy("blob_id").agg(F.first("_text").alias("_text"))
    found = F.concat(*[spans_of(F.col("_text"), rule, i) for i, rule in enumerate(rules)])
    unseen.select(
        "blob_id", F.lit(rule_version).alias("rule_version"), F.array_sort(found).alias("findings")
    ).write.parquet(f"{ledger}/run-{run}/attempt={uuid.uuid4().hex}")
    known = ledger_of(spark, ledger).where(
        (F.col("rule_version") == rule_version) & (F.size("findings") > 0)
    )
    held = paths.groupBy("blob_id").agg(F.count(F.lit(1)).alias("_paths"))
    known = staged(known.select("blob_id", "findings").join(held, "blob_id"), "secret-findings")
    none = F.array().cast(f"array<{SPAN}>")
    return join_groups(paths, known, "blob_id", "_paths").select(
        *[named(c) for c in path_cols], "blob_id", F.coalesce("findings", none).alias("findings")
    )


def span_text(findings: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """`kind:start:end` of all findings, comma-joined, by start and then kind as listed."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(
            findings,
            lambda f: F.concat_ws(":", F.get(kinds, f["nth"]), f["start"].cast("string"), f["stop"].cast("string")),
        ),
        ",",
    )


def kind_count(findings: Column, nth: int) -> Column:
    return F.size(F.filter(findings, lambda f: f["nth"] == nth)).cast("long")
