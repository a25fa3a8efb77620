"""The registered corpus queries and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.session import scratch_path

from . import (exact_dedup, host_reputation, huffman, mixing, packing, phrases, pseudonyms, quality_rules, rule_ensemble, signature_tree,
               spelling, sql, vector_graph, warc)
from .tables import given


URL_RULES = [
    host_reputation.UrlRule("block", "net", "/"),
    host_reputation.UrlRule("allow", "example.net", "/en/"),
    host_reputation.UrlRule("block", "example.com", "/de/"),
    host_reputation.UrlRule("allow", "org", "/fr/"),
]


def op1_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page. A page's outcome is the quality label of the document its url numbers."""
    pages, labels = given(spark, folder, "pages"), given(spark, folder, "labels")
    numbered = pages.select("url", F.expr(r"try_cast(regexp_extract(url, '/(\\d+)', 1) AS BIGINT)").alias("doc_id"))
    outcomes = numbered.join(labels, "doc_id").select("url", F.col("quality").alias("good"))
    return host_reputation.judged(pages, outcomes, URL_RULES)


def op2_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document, packed into windows of 1024 ids."""
    pieces = packing.packed(given(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# The key of the registered query; a deployment passes its own, kept secret.
PSEUDONYM_KEY = b"registered query"


def op3_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its personal values replaced by pseudonyms."""
    docs = given(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, PSEUDONYM_KEY)


def op4_huffman_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids as the written files give them back."""
    path = scratch_path(spark, "coded")
    huffman.write(given(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return huffman.read(spark, path).select("doc_id", "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_pruned_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Direct links, component and verdict of every vector."""
    return vector_graph.near_duplicates(given(spark, folder, "embeddings"))


def op6_warc_revisit(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as the written archives give it back."""
    path = scratch_path(spark, "archives")
    pages = given(spark, folder, "pages")
    mean_bytes = pages.agg(F.avg(F.octet_length("html"))).first()[0]
    warc.write_archives(warc.resolved(pages), path, mean_bytes or 0)
    records = warc.resolve_revisits(warc.read_archives(spark, path))
    return records.select(F.expr("try_cast(record_id AS BIGINT)").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op7_rule_bitmask_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, base verdict and strict verdict of every document."""
    table = quality_rules.ledger(given(spark, folder, "documents"))
    base, strict = quality_rules.passes(quality_rules.BASE), quality_rules.passes(quality_rules.STRICT)
    return table.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        (~base).alias("base_failed"), (base & strict).alias("kept"), "failure_bits")


def op8_mixed_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Size, target and words taken of every document."""
    table = mixing.taken_words(*mixing.mix(given(spark, folder, "documents")))
    return table.select("held.doc_id", "size", "source_size", "target", "taken")


def op9_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; rows whose id hashes to 0 modulo 5 are never learned from."""
    def held_out(column: str):
        return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))

    labels = given(spark, folder, "labels").where(~held_out("doc_id"))
    scores, _ = rule_ensemble.scored(given(spark, folder, "documents"), labels.select("doc_id", F.col("quality").alias("label")))
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_signature_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document: three-word shingles, similarity of at least 0.9."""
    return signature_tree.jaccard_components(given(spark, folder, "documents"), words=3, percent=90).drop("node", "class")


def op11_weighted_automata(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 phrases of every language: two or three words that occur at least ten times."""
    return phrases.collocations(given(spark, folder, "documents"))


def op12_grace_hash(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document, and the row of it that stays."""
    return exact_dedup.verdicts(given(spark, folder, "documents"))


def op13_trie_node_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Near words, form and root of every word that occurs at least five times."""
    return spelling.spelling_variants(given(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Packed pieces of what all stages of the corpus pipeline keep."""
    return corpus_pipeline.run(spark, folder)


QUERIES = (op1_host_reputation, op2_minimum_bin_slack, op3_feistel_pseudonyms, op4_huffman_blocks,
           op5_pruned_graph, op6_warc_revisit, op7_rule_bitmask_ledger,
           op8_mixed_blocks, op9_rule_ensemble, op10_signature_trees, op11_weighted_automata, op12_grace_hash,
           op13_trie_node_pairs, pipeline)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the subpackage."""
    return {q.__name__: q for q in QUERIES}


def statements() -> dict[str, str]:
    """The statements of the queries that SQL can express."""
    return sql.statements()
