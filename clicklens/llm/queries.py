"""One query for each operator, over its whole table, with production parameters.

``queries()`` and ``oracle_sql()`` have the form of ``__spark_entry__``. Each
query calls its operator and derives the digests of the contract from what the
operator returns. SQL is given where DuckDB can state the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.config import shared_dir
from clicklens.llm.bpe import encoded_and_decoded
from clicklens.llm.common import table
from clicklens.llm.conversation_repair import damaged, repair
from clicklens.llm.decontaminate import contamination
from clicklens.llm.exact_dedup import exact_groups
from clicklens.llm.html_extract import extract
from clicklens.llm.langid import learn as learn_languages
from clicklens.llm.langid import predictions
from clicklens.llm.lexical_search import search
from clicklens.llm.pii_crf import find as find_personal_data
from clicklens.llm.pii_crf import learn as learn_personal_data
from clicklens.llm.quality import learn as learn_quality
from clicklens.llm.quality import scores as quality_scores
from clicklens.llm.secret_ledger import BASE_KINDS, findings, scan_unseen
from clicklens.llm.simhash import near_duplicates
from clicklens.llm.suffix_dedup import removed
from clicklens.llm.toxicity import learn as learn_toxicity
from clicklens.llm.toxicity import scores as toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str,
                       path: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    """Operator 1 over ``documents``: every text to ids and back, with the vocabulary file at ``path``."""
    out = encoded_and_decoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over ``documents``; learns from rows with a language outside fold 1 of 3."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    net = learn_languages(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return predictions(docs.select("doc_id", held_out.alias("held_out"), "text"), net)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over ``pages``."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def _joined(spans):
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _number(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over ``documents``: every document a path, against a ledger of this run's own.

    The documents come as two batches of the history; the second one scans the
    blobs that the first did not bring.
    """
    docs, ledger = table(spark, sf_dir, "documents").select("doc_id", "text"), shared_dir(spark, "llm", "ledger")
    second = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    for batch in (docs.where(~second), docs.where(second)):
        scan_unseen(batch, ledger)
    found, spans = findings(docs, ledger), F.col("findings")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[_number(spans, k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over ``documents``: shingles of 3 words, linked at 3 differing bits or fewer."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over ``documents``; counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs, learn_personal_data(docs))
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *[_number(base, k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over ``documents``: strings of 50 bytes."""
    out = removed(table(spark, sf_dir, "documents"), length=50)
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over ``documents``; learns from rows of ``labels`` outside fold 0 of 5."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lexicon = learn_toxicity(docs, labels.where(~held_out))
    out = toxicity_scores(docs.select("doc_id", "text"), lexicon)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over ``documents`` and ``benchmark``: windows of 13 words, contaminated from one word in 20."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=13, share=20)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = f"""
with w as (
  select doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
),
i as (
  select item_id, w, least(len(w), 13) as n from (
    select item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark)
  where len(w) > 0
),
iw as (
  select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as g
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as p from i)
),
sizes as (select distinct n from i),
dw as (
  select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from w cross join sizes)
),
hit as (select doc_id, p, dw.n, item_id from dw join iw using (n, g)),
per as (
  select doc_id, count(distinct q) as n_hit
  from (select doc_id, unnest(range(p, p + n)) as q from (select distinct doc_id, p, n from hit)) group by doc_id
),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as s
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hit) group by doc_id
)
select w.doc_id, len(w.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(s, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w.w) as contaminated
from w left join per using (doc_id) left join items using (doc_id)
"""


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over ``documents``: of equal texts the row with the largest doc_id stays."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


OP10_SQL = f"""
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept,
       sha256(t) as text_sha256
from (select doc_id, {LOWER} as t from documents)
window g as (partition by t)
"""


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over ``documents``; learns from rows of ``labels`` outside fold 1 of 3."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = learn_quality(docs, labels.where(~held_out))
    out = quality_scores(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: the 50 best of ``documents`` for each row of ``benchmark``."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


TERMS = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"
OP12_SQL = f"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all({LOWER}, {TERMS}) as w from documents
),
totals as (select count(*) filter (where len(w) > 0) as big_n, sum(len(w)) as big_l from d),
i as (
  select distinct item_id, unnest(regexp_extract_all({LOWER}, {TERMS})) as term from benchmark
),
tf as (
  select r, doc_id, n, term, count(*) as tf
  from (select r, doc_id, len(w) as n, unnest(w) as term from d) where term in (select term from i) group by all
),
weight as (
  select term, cast(floor(1000 * ln((2.0 * max(big_n) + 2) / (2 * count(*) + 1))) as bigint) as weight
  from tf, totals group by term
),
scored as (
  select item_id, r, doc_id, cast(sum(weight * ((1000000000 * tf) //
    (1000 * tf + 20 * (50 + (50 * n * cast(big_n as bigint)) // cast(big_l as bigint))))) as bigint) as score
  from tf join weight using (term) join i using (term), totals group by item_id, r, doc_id
)
select item_id, cast(rk as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rk from scored where score > 0)
where rk <= 50
"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over ``conversations``, damaged by the contract's rule; every conversation has a row."""
    given = table(spark, sf_dir, "conversations")
    return repair(damaged(given), every=given.select("conv_id"))


_QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_bpe_round_trip": (op1_bpe_round_trip, None),
    "op2_language_id": (op2_language_id, None),
    "op3_html_extraction": (op3_html_extraction, None),
    "op4_secret_ledger": (op4_secret_ledger, None),
    "op5_simhash_near_dedup": (op5_simhash_near_dedup, None),
    "op6_personal_data": (op6_personal_data, None),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_toxicity": (op8_toxicity, None),
    "op9_benchmark_decontamination": (op9_benchmark_decontamination, OP9_SQL),
    "op10_exact_dedup": (op10_exact_dedup, OP10_SQL),
    "op11_quality": (op11_quality, None),
    "op12_lexical_search": (op12_lexical_search, OP12_SQL),
    "op13_conversation_repair": (op13_conversation_repair, None),
}


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _QUERIES.items() if v[1] is not None}
