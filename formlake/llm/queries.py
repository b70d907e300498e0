"""Named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.llm import packing
from formlake.llm.bpe_count import token_counts
from formlake.llm.common import table
from formlake.llm.decontaminate import find_matches
from formlake.llm.html_extract import extract
from formlake.llm.language_id import identify
from formlake.llm.near_dedup import near_duplicates
from formlake.llm.oracle import NEAR_DEDUP, RANKED_SEARCH, SUFFIX_DEDUP, WARC
from formlake.llm.quality_rules import quality_verdicts
from formlake.llm.ranked_search import ranked_search
from formlake.llm.suffix_dedup import cut_repeats
from formlake.llm.token_alignment import alignment
from formlake.llm.toxicity import score_toxicity
from formlake.llm.url_filter import judge_urls
from formlake.llm.warc import archived

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def _remainder(n: int):
    """crc32(doc_id as text) mod n: the fixed split into learning and held-out rows."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, num=4, den=5)


def op2_url_template_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"), train=_remainder(3) != 1)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=_remainder(5) != 0)
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_bpe_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op10_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived(table(spark, sf_dir, "pages"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment(table(spark, sf_dir, "documents"), *files)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_url_template_filter": op2_url_template_filter,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_html_extraction": op7_html_extraction,
    "op8_toxicity": op8_toxicity,
    "op9_bpe_token_counts": op9_bpe_token_counts,
    "op10_swap_packing": op10_swap_packing,
    "op11_reversed_search": op11_reversed_search,
    "op12_warc": op12_warc,
    "op13_token_alignment": op13_token_alignment,
}

# the operators without an entry train models, match approximately or call tokenizers; tests hold them
# against brute force, the libraries or held-out rows
ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": NEAR_DEDUP,
    "op3_suffix_array_dedup": SUFFIX_DEDUP,
    "op11_reversed_search": RANKED_SEARCH,
    "op12_warc": WARC,
}
