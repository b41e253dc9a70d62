"""Token counts: an exact length histogram that answers every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import running_totals, staged
from wattledger.llm.encoding import slices, worker_encoder

# Lengths that share a bucket of the suffix sums.
LENGTH_BUCKET = 4096


def token_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """The encoded length of each row's whole text (column n_tokens); null and empty give 0.

    A very long text is encoded whole in its task, whose memory grows with it; ids, ties and
    repeated rows play no part; other columns are not looked at.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch.column(0)):
                counts = encoder.encode(part)[1]
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return docs.select(text_col).mapInArrow(lengths, "n_tokens long")


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """One row per encoded length: n_tokens, n_docs. Exact; a row per length, not per document."""
    lengths = token_lengths(docs, tokenizer, text_col)
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """What each length answers when it is taken as context limit.

    Per n_tokens: n_docs of that length; docs_at_most and tokens_at_most (this length included);
    docs_longer and tokens_longer (suffix sums); truncated_total, the tokens left when every
    document is cut at this length; total_docs and total_tokens.
    The histogram is read four times and should be a stage table. Empty in, empty out.
    """
    bucketed = histogram.withColumn("_bucket", F.floor(F.col("n_tokens") / LENGTH_BUCKET))
    bucketed = bucketed.withColumn("_all", F.lit(0))
    tokens = F.col("n_tokens") * F.col("n_docs")
    sums = running_totals(
        bucketed, ["_all"], "_bucket", ["n_tokens"],
        {"docs_before": F.col("n_docs"), "tokens_before": tokens},
    )
    total = histogram.agg(
        F.sum("n_docs").alias("total_docs"), F.sum(tokens).alias("total_tokens")
    )
    docs_at_most, tokens_at_most = F.col("docs_before") + F.col("n_docs"), F.col("tokens_before") + tokens
    longer = F.col("total_docs") - docs_at_most
    return sums.join(F.broadcast(total)).select(  # the totals are one row
        "n_tokens",
        "n_docs",
        docs_at_most.alias("docs_at_most"),
        tokens_at_most.alias("tokens_at_most"),
        longer.alias("docs_longer"),
        (F.col("total_tokens") - tokens_at_most).alias("tokens_longer"),
        (tokens_at_most + longer * F.col("n_tokens")).alias("truncated_total"),
        "total_docs",
        "total_tokens",
    )


def truncated_total(contexts: DataFrame, limit: int) -> DataFrame:
    """One row: limit, truncated_total, the tokens left of all documents cut at any `limit`."""
    below = F.col("n_tokens") <= limit
    longer = F.col("n_docs") * F.lit(limit)
    kept = F.when(below, F.col("n_tokens") * F.col("n_docs")).otherwise(longer)
    return contexts.agg(
        F.lit(limit).alias("limit"), F.coalesce(F.sum(kept), F.lit(0)).alias("truncated_total")
    )


def length_quantile(contexts: DataFrame, q: float) -> DataFrame:
    """One row: q, n_tokens, the smallest length that at least the share `q` of documents does
    not exceed; null on an empty table."""
    reached = F.col("docs_at_most") >= F.ceil(F.lit(q) * F.col("total_docs"))
    return contexts.where(reached).agg(F.lit(q).alias("q"), F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """`context_table` of the documents' own histogram."""
    return context_table(staged(length_histogram(docs, tokenizer, text_col), "token-lengths"))
