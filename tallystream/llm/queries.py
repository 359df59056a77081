"""The package's queries over the driver tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallystream.llm import (
    decontaminate,
    hard_negatives,
    html_extract,
    license_scan,
    minhash,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.with_token_counts(table(spark, sf_dir, "documents"))
    return token_counts.with_suffix_sums(token_counts.length_histogram(counts))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op3_decontaminate",
    rf"""
    with docs as (
        select doc_id, row_number() over () as doc_row, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as words from documents
    ), items as (
        select item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as words from benchmark
    ), windows as (
        select distinct item_id, least(10, len(words)) as size, list_slice(words, s, s + least(10, len(words)) - 1) as words
        from items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as u(s) where len(words) > 0
    ), sizes as (select distinct size from windows), places as (
        select doc_row, s, size, list_slice(words, s, s + size - 1) as words
        from docs, sizes, unnest(range(1, len(words) - size + 2)) as u(s)
    ), hits as (
        select doc_row, s, a.size, item_id from places a join windows w on a.size = w.size and a.words = w.words
    ), covered as (
        select doc_row, count(distinct p) as n_hit from hits, unnest(range(s, s + size)) as u(p) group by doc_row
    ), named as (
        select doc_row, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
        from hits group by doc_row
    )
    select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
        sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
    from docs left join covered using (doc_row) left join named using (doc_row)
    """,
)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    counts = [pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(spans, pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.joined(spans, pii.KINDS).alias("spans"),
    )


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op9_quality_rules",
    rf"""
    with docs as (
        select doc_id, row_number() over () as doc_row, coalesce(text, '') as text, {_WORDS} as words from documents
    ), lines as (
        select doc_row, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
        from docs, unnest(string_split(text, chr(10))) as u(line) where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_row
    ), windows as (
        select doc_row, s, list_slice(words, s, s + 2) as w from docs, unnest(range(1, len(words) - 1)) as u(s)
    ), twice as (
        select doc_row, s from windows qualify count(*) over (partition by doc_row, w) > 1
    ), repeats as (
        select doc_row, count(distinct p) as n_repeat_words from twice, unnest(range(s, s + 3)) as u(p) group by doc_row
    ), base as (
        select doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
            cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
            coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines
        from docs left join lines using (doc_row) left join repeats using (doc_row)
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > 3 * n_words
            or 2 * n_dup_lines > n_lines or not word_chars between 2 * n_words and 20 * n_words) as kept
    from base
    """,
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


@query("op10_html_extract")
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query(
    "op1_minhash_dedup",
    rf"""
    with recursive docs as (
        select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as words from documents
    ), shingles as (
        select distinct doc_id, list_slice(words, s, s + 4) as shingle
        from docs, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as u(s) where len(words) > 0
    ), sizes as (select doc_id, count(*) as n from shingles group by doc_id), commons as (
        select a.doc_id as u, b.doc_id as v, count(*) as c from shingles a join shingles b using (shingle)
        where a.doc_id <> b.doc_id group by all
    ), links as (
        select u, v from commons join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * c >= 85 * (x.n + y.n - c)
    ), reach as (
        select doc_id, doc_id as other from documents union select r.doc_id, v from reach r join links on r.other = u
    )
    select doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id, doc_id = min(other) as kept
    from reach left join sizes using (doc_id) group by doc_id
    """,
)
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query(
    "op7_substring_dedup",
    rf"""
    with docs as (select doc_id, {_WORDS} as words from documents), windows as (
        select doc_id, s, sha256(array_to_string(list_slice(words, s, s + 19), ' ')) as w
        from docs, unnest(range(1, len(words) - 18)) as u(s)
    ), later as (
        select doc_id, s from windows qualify row_number() over (partition by w order by doc_id, s) > 1
    ), gone as (select distinct doc_id, p from later, unnest(range(s, s + 20)) as u(p)), left_over as (
        select d.doc_id, string_agg(d.words[i], ' ' order by i) as kept, count(*) as n_kept
        from docs d, unnest(range(1, len(words) + 1)) as u(i) anti join gone on d.doc_id = gone.doc_id and i = gone.p group by d.doc_id
    )
    select doc_id, cast(len(words) as bigint) as n_words, len(words) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
    from docs left join left_over using (doc_id)
    """,
)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the host, the language a path below it."""
    scored = quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang")
    )
    return scored.select(
        "doc_id", "host", "path", *[F.round(c, 6).alias(c) for c in scored.columns if c.endswith(("_quality", "_toxic"))], "kept"
    )


@query(
    "op11_hard_negatives",
    """
    with v as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select a.vec_id as anchor_id, a.label as mine, b.vec_id as other, b.label, cast(list_inner_product(a.q, b.q) as bigint) as score
        from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
    ), p as (
        select anchor_id, other as positive_id, score as positive_score from s where label = mine
        qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
    )
    select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, other) as integer) as rank,
        other as negative_id, positive_score, score as negative_score
    from p join s using (anchor_id)
    where label <> mine and 80 * positive_score <= 100 * score and score <= positive_score
    qualify rank <= 5
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


@query(
    "op13_spelling_variants",
    rf"""
    with recursive crc as (
        select list(c order by i) as t from (
            select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
            from range(256) as r(i)
        )
    ), runs as (
        select doc_id, run, count(*) as n from (
            select doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents
        ) where len(run) >= 7 group by all
    ), hashed as (
        select run, n, xor(list_reduce(
            list_transform(range(1, octet_length(b) + 1), lambda i: cast(('0x' || hex(b)[2 * i - 1:2 * i]) as bigint)),
            lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) as h
        from (select run, n, encode(coalesce(cast(doc_id as varchar), '') || ':' || run) as b from runs), crc
    ), words as (
        select case when h % 31 = 0 then run[1:h % len(run)] || run[h % len(run) + 2:] else run end as word, n from hashed
    ), vocabulary as (
        select word, cast(sum(n) as bigint) as n from words where len(word) >= 7 group by word having sum(n) >= 2
    ), cut as (
        select word, n, word[1:i] || word[i + 2:] as rest, i from vocabulary, unnest(range(0, len(word))) as u(i)
        union all select word, n, word, null from vocabulary
    ), near as (
        select distinct a.word, a.n, b.word as near, b.n as near_n from cut a join cut b using (rest)
        where a.word <> b.word and (a.i = b.i or (a.i is null) <> (b.i is null))
    ), around as (
        select word, n, count(*) as n_near, arg_min(near, (-near_n, encode(near))) as near, max(near_n) as near_n from near group by word, n
    ), judged as (
        select v.word, v.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * v.n then near end as form,
            case when near_n >= 10 * v.n then near_n end as form_n
        from vocabulary v left join around a on a.word = v.word
    ), way as (
        select word, word as at from judged
        union all select way.word, judged.form from way join judged on judged.word = way.at where judged.form is not null
    ), ends as (select way.word, way.at as root from way join judged on judged.word = way.at where judged.form is null)
    select word, form, root, n, n_near, form_n from judged join ends using (word)
    """,
)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("licenses", lambda s: s["base"])
    return license_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["start"])).alias("last_word"),
        license_scan.labels(base).alias("base_labels"),
        license_scan.labels(F.col("licenses")).alias("labels"),
        license_scan.score(F.col("licenses")).alias("score"),
    )
