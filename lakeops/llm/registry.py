"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import functions as F

from lakeops.llm import (conversations, html_extract, license_scan, line_dedup, merkle, mixing, near_dedup,
                         packing, quality_classifier, quality_rules, substring_dedup, token_output, topk)
from lakeops.llm._common import table
from lakeops.llm.sql import (CONVERSATIONS_SQL, LINE_DEDUP_SQL, MANIFEST_SQL, QUALITY_RULES_SQL,
                             SUBSTRING_DEDUP_SQL, TOPK_SQL)

#: file of the tokenizer; a parameter of the operators
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SEQ_LEN = 2048


def op1_exact_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.filter("vec_id % 100 = 0"), k=10)


def op2_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, SEQ_LEN)


def op5_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op7_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), digest=True)


def op8_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_token_output(spark, sf_dir):
    return token_output.packed_matrices(table(spark, sf_dir, "documents"), TOKENIZER, SEQ_LEN)


def op10_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).drop("removed")


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)").cast("string")
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    rows = merkle.manifest(docs, {"n_chars": F.when(hit, more).otherwise(F.col("n_chars").cast("string"))})
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
                       "verified")


def op12_conversation_repair(spark, sf_dir):
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")), F.col("present"))


def op13_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable] = {f.__name__: f for f in (
    op1_exact_topk, op2_quality_rules, op3_near_dedup, op4_best_fit_packing, op5_license_scan,
    op6_quality_classifier, op7_source_mixing, op8_html_extraction, op9_token_output, op10_line_dedup,
    op11_merkle_manifest, op12_conversation_repair, op13_substring_dedup)}

ORACLE: dict[str, str] = {"op1_exact_topk": TOPK_SQL, "op2_quality_rules": QUALITY_RULES_SQL,
                          "op10_line_dedup": LINE_DEDUP_SQL, "op11_merkle_manifest": MANIFEST_SQL,
                          "op12_conversation_repair": CONVERSATIONS_SQL,
                          "op13_substring_dedup": SUBSTRING_DEDUP_SQL}
