"""The registered queries of this subpackage: thin calls of its operators over whole tables, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.llm import (chat_format, decontamination, language_id, mixing, ngram_join, packing, pii_boost,
                          quality_rules, resampling, secret_scan, token_rollup, url_filter, whitening)
from visitlab.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES, url_filter.train())


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secret_scan.find_secrets(docs, secret_scan.train(docs))
    count = [secret_scan.count_kind("spans", k).alias(f"n_{k}") for k in secret_scan.KINDS]
    base, every = secret_scan.digest(F.col("spans"), secret_scan.KINDS[:3])
    return found.select("doc_id", *count, base.alias("base_sha256"), every.alias("spans"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """The conversations as raw transcripts: two thirds of them with speaker markers of two styles, a fifth of whose
    turns lost theirs, one third without any.  Roles are not part of the result."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(3))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0
    plain = F.initcap(F.col("role"))
    other = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise(plain)
    mark = (F.when(lost | (style == 2) | F.col("role").isNull(), "").when(style == 0, F.concat(plain, F.lit(": ")))
            .otherwise(F.concat(F.lit("### "), other, F.lit(":\n"))))
    return conversations.select("conv_id", "turn", F.concat(mark, F.coalesce("text", F.lit(""))).alias("text"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations")
    raw = transcripts(chats)
    roles = chats.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "role")
    known = raw.join(roles, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")))
    model = chat_format.train(known)
    return chat_format.parse(raw, model).select(F.col("conv").cast("long").alias("conv_id"), F.col("seq").alias("turn"),
                                                "line", "role", "opens", "content", "rendered")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~_held_out()))
    return language_id.predict(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score",
                                                   "rejected")


VERSIONS = {"words-1": token_rollup.word_count, "bytes-1": token_rollup.byte_count}


def _changes(docs: DataFrame, op: str) -> DataFrame:
    """One change per document and tokenizer version; a revision takes the counts of the text without its '|' cells."""
    counted = docs.select("source", "lang", F.explode(F.array(*[
        F.struct(F.lit(v).alias("version"), f("text").alias("tokens"), f("cleaned").alias("cleaned"))
        for v, f in VERSIONS.items()])).alias("v")).select("source", "lang", "v.*")
    if op == "revise":
        return counted.select("source", "lang", "version", F.lit(op).alias("op"), F.col("cleaned").alias("tokens"),
                              F.col("tokens").alias("old_tokens"))
    return counted.select("source", "lang", "version", F.lit(op).alias("op"), "tokens",
                          F.lit(None).cast("long").alias("old_tokens"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, those under 50 words go out again, tables lose their '|' marks; the deletes are
    committed twice and one batch is replayed after compaction."""
    docs = _table(spark, sf_dir, "documents").withColumn("cleaned", F.replace(F.col("text"), F.lit("|"), F.lit("")))
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "op6-rollup"))
    short = token_rollup.word_count() < 50
    rollup.commit("0-insert", _changes(docs, "insert"))
    rollup.commit("1-delete", _changes(docs.where(short), "delete"))
    rollup.commit("1-delete", _changes(docs.where(short), "delete"))
    rollup.compact()
    rollup.commit("1-delete", _changes(docs.where(short), "delete"))
    rollup.commit("2-revise", _changes(docs.where(~short & F.col("text").contains("|")), "revise"))
    return rollup.totals()


OP6_SQL = r"""
with d as (
  select source, lang, coalesce(text, '') as text, replace(coalesce(text, ''), '|', '') as cleaned,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from documents),
kept as (select * from d where words >= 50)
select source, lang, 'words-1' as version, count(*) as docs,
       cast(sum(len(regexp_extract_all(cleaned, '[^\x20\x09-\x0D]+'))) as bigint) as tokens
from kept group by source, lang
union all
select source, lang, 'bytes-1', count(*), cast(sum(octet_length(encode(cleaned))) as bigint)
from kept group by source, lang
"""


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_components(_table(spark, sf_dir, "documents")).documents.select(
        "doc_id", "n_shingles", "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii_boost.find_personal_data(docs, pii_boost.train(docs))
    count = [secret_scan.count_kind("spans", k).alias(f"n_{k}") for k in pii_boost.BASE]
    base, every = secret_scan.digest(F.col("spans"), pii_boost.BASE)
    return found.select("doc_id", *count, base.alias("base_sha256"), every.alias("spans"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


# crc32 by its definition, once per distinct word: the table of 256 entries comes from the polynomial.
OP13_SQL = r"""
with recursive
steps(b, i, c) as (
  select b, 0, b from range(256) t(b)
  union all
  select b, i + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where i < 8),
crc_table as (select list(c order by b) as t from steps where i = 8),
texts as (
  select 'corpus' as side, doc_id as id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
  union all
  select 'target', item_id, row_number() over (),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  from benchmark),
counted as (
  select side, id, r, w, count(*) as n
  from (select side, id, r, unnest(words) as w from texts) group by side, id, r, w),
hashed as (
  select w, xor(list_reduce(
           list_prepend(4294967295::bigint,
                        list_transform(range(1, octet_length(encode(w)) + 1),
                                       lambda i: ('0x' || hex(encode(w))[2 * i - 1 : 2 * i])::bigint)),
           lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8)), 4294967295) % 10000 as bucket
  from (select distinct w from counted), crc_table),
sizes as (
  select b.bucket, coalesce(sum(n) filter (side = 'corpus'), 0)::double as s,
         coalesce(sum(n) filter (side = 'target'), 0)::double as t
  from range(10000) b(bucket) left join (select * from counted join hashed using (w)) h on h.bucket = b.bucket
  group by b.bucket),
totals as (select sum(s) as s_all, sum(t) as t_all from sizes),
gains as (
  select bucket, floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::bigint as gain
  from sizes, totals),
weights as (
  select r, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n))::bigint as weight
  from counted join hashed using (w) join gains using (bucket) where side = 'corpus' group by r),
scored as (
  select id as doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || sha256(concat('2024:', id::varchar))[1:8])::bigint + 0.5::double) / 4294967296)))::bigint as score
  from texts left join weights using (r) where side = 'corpus'),
drawn as (
  select *, row_number() over (order by score desc, doc_id) as place, count(*) over () as candidates
  from scored where n_features >= 20)
select doc_id, n_features, weight, score, place as rank from drawn where place <= 10 * candidates // 100
union all
select doc_id, n_features, weight, score, null from drawn where place > 10 * candidates // 100
union all
select doc_id, n_features, weight, score, null from scored where n_features < 20
"""


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_secret_scans": op2_secret_scans,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_mixing": op8_mixing,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_pii": op10_pii,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_importance_resampling": op13_importance_resampling,
}

SQL: dict[str, str] = {"op6_token_counts": OP6_SQL, "op13_importance_resampling": OP13_SQL}
