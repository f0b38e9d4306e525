"""The package's queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.llm import impact, language, maxent, packing, periodic, pieces, quality, simhash, suffixes, turns, urls, warc, winnowing
from accountloom.llm.common import table
from accountloom.llm.sql import ORACLES
from accountloom.settings import scratch_folder

URL_RULES = [
    urls.Rule("allow", "org/"),
    urls.Rule("block", "example.org/es/"),
    urls.Rule("block", "example.org/en/1"),
    urls.Rule("allow", "com/fr/"),
    urls.Rule("block", "com/de/"),
]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identified(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.judged(table(spark, sf_dir, "documents"), trusted)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.decoded(pieces.encoded(table(spark, sf_dir, "documents")))
    same = F.col("decoded").cast("binary") == F.col("text")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", same.alias("round_trip"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = impact.quantised(table(spark, sf_dir, "embeddings"))
    return impact.top_k(vectors, F.col("vec_id") % 100 == 0)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turns.audited(turns.Repairs(turns.damaged(conversations), conversations))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic.summarised(periodic.periodic_runs(docs))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return winnowing.counted(found)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_warc": op2_warc,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_language_id": op4_language_id,
        "op5_quality_rules": op5_quality_rules,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_url_filters": op7_url_filters,
        "op8_simhash": op8_simhash,
        "op9_top_k": op9_top_k,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_decontamination": op13_decontamination,
    }


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
