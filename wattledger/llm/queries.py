"""The registered queries of this package and, where SQL can express them, their statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.plans import scratch_path
from wattledger.llm import decontaminate, grid_codes, impact_search, lexical, mixing, quality, secret_scan, sharding, simhash
from wattledger.llm import exact_dedup as exact
from wattledger.llm import repeats, token_counts, token_files
from wattledger.llm.common import table

WORD_TOKENIZER = "word_bpe_49k.json"


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path(WORD_TOKENIZER)
    token_files.write_token_files(table(spark, folder, "documents"), path, tokenizer)
    return token_files.token_digests(spark, path)


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    marked = decontaminate.contaminated_words(docs, items, ["doc_id"])
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_components(table(spark, folder, "documents"))
    return near.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.quality_scores(docs, labels, ["doc_id"])


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_history(table(spark, folder, "documents"), ["doc_id"])
    spans = secret_scan.span_text(F.col("findings"))
    counts: list[Column] = [
        secret_scan.kind_count(F.col("findings"), i).alias(f"n_{rule.kind}")
        for i, rule in enumerate(secret_scan.RULES)
    ]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), ["doc_id"])
    ordered = mixed.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")
    return ordered.select(
        "doc_id", "size", "source_size", "target", "taken", "passes", "first_position", "second_position"
    )


def op7_shard_lpt(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_groups(table(spark, folder, "documents"), ["doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_bytes(table(spark, folder, "documents"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"), digest_all=True)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per encoded length, read as context limit."""
    tokenizer = public_tokenizers.path(WORD_TOKENIZER)
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer)


def op11_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return impact_search.top_products(table(spark, folder, "embeddings"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return grid_codes.grid_codes(table(spark, folder, "embeddings"), ["vec_id"])


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_secret_scan": op5_secret_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_shard_lpt": op7_shard_lpt,
    "op8_repeats": op8_repeats,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_vector_codes": op12_vector_codes,
    "op13_lexical_search": op13_lexical_search,
}

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _kind_spans(name: str, nth: int, pattern: str, group: int, at_least: int) -> str:
    """Spans of one kind from the pieces between matches and the matches themselves."""
    return f"""
    {name} as (
      select row_no, pieces, whole, judged from (
        select row_no, list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) as pieces,
          list_transform(regexp_extract_all(t, '{pattern}', 0), lambda x: length(x)) as whole,
          list_transform(regexp_extract_all(t, '{pattern}', {group}), lambda x: length(x)) as judged
        from docs) where len(whole) > 0),
    {name}_each as (
      select row_no, pieces, whole, judged, unnest(range(1, len(whole) + 1)) as i from {name}),
    {name}_spans as (
      select row_no, {nth} as nth, '{name}' as kind,
        list_sum(pieces[1:i]) + coalesce(list_sum(whole[1:i - 1]), 0) as start,
        list_sum(pieces[1:i]) + list_sum(whole[1:i]) as stop
      from {name}_each where judged[i] >= {at_least})"""


def _code_round(nth: int) -> str:
    """The nearest entries of round `nth`, and the codebooks that follow from them."""
    return f"""
    near{nth} as materialized (
      select r, part, any_value(v) as v, arg_min(entry, distance * 16 + entry) as entry, min(distance) as distance
      from (
        select r, part, v, entry,
          (list_dot_product(v, v) - 2 * list_dot_product(v, e) + list_dot_product(e, e))::bigint as distance
        from parts join books{nth} using (part))
      group by r, part),
    moved{nth} as (
      select part, entry, list(mean order by place) as e from (
        select part, entry, place, floor(sum(x) / count(*)) as mean
        from (select part, entry, unnest(v) as x, unnest(range(1, len(v) + 1)) as place from near{nth})
        group by part, entry, place)
      group by part, entry),
    books{nth + 1} as materialized (
      select part, entry, coalesce(moved{nth}.e, books{nth}.e) as e
      from books{nth} left join moved{nth} using (part, entry))"""


ORACLES = {
    "op2_decontaminate": r"""
    with
    docs as (
      select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from documents),
    items as (
      select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from benchmark),
    item_windows as (
      select distinct coalesce(item_id::varchar, '') as item, least(len(w), 10) as n,
        array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
      from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from items where len(w) > 0)),
    doc_windows as (
      select r, i, n, array_to_string(w[i:i + n - 1], ' ') as win
      from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
        from docs, (select distinct n from item_windows) where len(w) >= n)),
    found as (select r, i, d.n, item from doc_windows d join item_windows using (n, win)),
    hit as (
      select r, count(distinct p) as n_hit
      from (select r, unnest(range(i, i + n)) as p from (select distinct r, i, n from found)) group by r),
    held as (
      select r, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct r, item from found) group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
      coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
      coalesce(n_hit, 0) > 0 as contaminated
    from docs left join hit using (r) left join held using (r)""",
    "op5_secret_scan": f"""
    with docs as (select row_number() over () as row_no, doc_id, coalesce(text, '') as t from documents),
    {_kind_spans("assign", 0, _ASSIGN, 2, 12)},
    {_kind_spans("access", 1, "AKIA[A-Z0-9]+", 0, 18)},
    {_kind_spans("hex", 2, "[0-9a-f]{16,}", 0, 16)},
    every as (select * from assign_spans union all select * from access_spans union all select * from hex_spans),
    per_row as (
      select row_no, count(*) filter (nth = 0) as n_assign, count(*) filter (nth = 1) as n_access,
        count(*) filter (nth = 2) as n_hex,
        string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, nth) as spans
      from every group by row_no)
    select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
      coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(spans, '')) as base_sha256,
      coalesce(spans, '') as spans
    from docs left join per_row using (row_no)""",
    "op6_mix_sources": r"""
    with docs as (
      select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        sha256(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')) as o
      from documents),
    per_source as (select source, sum(size)::bigint as source_size from docs group by source),
    ranked as (
      select *, row_number() over (order by source nulls last) - 1 as rank from per_source),
    weighed as (
      select *, [5.0, 2.0, 1.0][(rank % 3 + 1)::int]::double as weight,
        [1.0, 0.5, 1.5][(rank % 3 + 1)::int]::double as w0, [1.0, 1.5, 0.5][(rank % 3 + 1)::int]::double as w1,
        source_size * 2.0::double as stop, (sum(source_size) over ())::double * 1.5::double as total
      from ranked),
    filled as (
      select *, (total - coalesce(sum(stop) over (order by stop / weight, rank
          rows between unbounded preceding and 1 preceding), 0.0::double))
        / sum(weight) over (order by stop / weight, rank rows between current row and unbounded following) as lvl
      from weighed),
    targets as (
      select source, source_size, w0, w1,
        least(stop, coalesce(max(case when lvl * weight <= stop then lvl end) over (), 'infinity'::double) * weight)
          as target
      from filled),
    placed as (
      select doc_id, size, source_size, target, w0, w1, floor(target + 0.5::double)::bigint as demand,
        coalesce(sum(size) over (partition by docs.source order by o, size
          rows between unbounded preceding and 1 preceding), 0)::bigint as before
      from docs join targets on docs.source is not distinct from targets.source)
    select doc_id, size, source_size, target,
      (greatest(0, least(size, demand - before)) + greatest(0, least(size, demand - source_size - before)))::bigint as taken,
      ((demand - before > 0)::int + (demand - source_size - before > 0)::int)::int as passes,
      case when demand - before > 0 then (before / target * 2.0::double)
        / (w0 + sqrt(w0 * w0 + (w1 - w0) * 2.0::double * (before / target))) end as first_position,
      case when demand - source_size - before > 0 then ((before + source_size) / target * 2.0::double)
        / (w0 + sqrt(w0 * w0 + (w1 - w0) * 2.0::double * ((before + source_size) / target))) end as second_position
    from placed""",
    "op9_exact_dedup": """
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
      doc_id is not distinct from max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window same as (partition by coalesce(text, ''))""",
    "op11_exact_top_k": """
    with v as (
      select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
      from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
      select q.vec_id as query_id, q.r as query, c.vec_id, c.r, list_dot_product(q.v, c.v)::bigint as score
      from v q join v c on q.r <> c.r where q.vec_id % 100 = 0)
    select query_id, row_number() over (partition by query order by score desc, vec_id nulls last, r)::int as rank,
      vec_id, score
    from scored qualify rank <= 10""",
    "op12_vector_codes": f"""
    with kept as (
      select row_number() over (order by vec_id) as r, vec_id, label,
        list_transform(embedding, lambda x: floor(4096 * x::double)) as v
      from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    parts as materialized (
      select r, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] as v
      from (select r, v, unnest(range(8)) as part from kept)),
    books0 as (select part, r - 1 as entry, v as e from parts where r <= 16),
    {",".join(_code_round(i) for i in range(7))},
    coded as (
      select vec_id, label, string_agg(printf('%02x', entry), '' order by part) as code, sum(distance)::bigint as error
      from near6 join kept using (r) group by r, vec_id, label)
    select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
      (select sha256(string_agg(x::bigint::varchar, ',' order by part, entry, place))
        from (select part, entry, unnest(e) as x, unnest(range(len(e))) as place from books6)) as codebooks_sha256
    from coded""",
    "op13_lexical_search": r"""
    with docs as (
      select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from documents),
    items as (
      select row_number() over () as i, item_id, unnest(list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) as term
      from benchmark),
    corpus as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from docs),
    counts as (
      select r, doc_id, n, term, count(*) as tf
      from (select r, doc_id, len(w) as n, unnest(w) as term from docs) group by r, doc_id, n, term),
    weights as (
      select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
      from counts, corpus group by term, n_docs),
    scored as (
      select i, item_id, r, doc_id,
        sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::bigint as score
      from items join counts using (term) join weights using (term), corpus
      group by i, item_id, r, doc_id)
    select item_id, row_number() over (partition by i order by score desc, doc_id nulls last)::int as rank, doc_id, score
    from scored where score > 0 qualify rank <= 50""",
}
