"""Registered queries of these operators: thin views of their results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from starsift.llm import (
    chunk_codec, conversation_trie, decontaminate, language_id, line_dedup, merkle_manifest, packing, quality_ledger, secret_scan, simhash_dedup, token_counts, toxicity,
    url_filter,
)
from starsift.llm.common import crc_mod, table
from starsift.llm.url_filter import Rule

TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
]


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_decontaminate(spark, sf):
    """Words of documents inside windows of benchmark items."""
    found = decontaminate.mark_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op2_packing(spark, sf):
    """Packed id rows of all documents."""
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_path())


def op3_bpe_codec(spark, sf):
    """Digests of the ids and of the text they decode to."""
    coded = chunk_codec.encode_documents(table(spark, sf, "documents"), tokenizer_path(), ["doc_id"])
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_url_filter(spark, sf):
    """Verdict on every page."""
    judged = url_filter.filter_urls(table(spark, sf, "pages"), URL_RULES)
    return judged.withColumns({"trust": F.round("trust", 4), "distrust": F.round("distrust", 4)})


def linked_url_filter(spark, sf):
    """The same with a link to another page's host in every third page, as the given pages link to no other host."""
    pages = table(spark, sf, "pages")
    n = pages.count()
    other = pages.select(F.col("page_id").alias("other"), url_filter.host_of(F.col("url")).alias("other_host"), F.col("url").contains("://").alias("has_host"))
    joined = pages.join(other, (F.col("page_id") * 7 + 3) % n == F.col("other"), "left")
    link = F.when((F.col("page_id") % 3 == 0) & F.col("has_host"), F.concat(F.lit('<a href="//'), "other_host", F.lit('/x">'))).otherwise("")
    linked = joined.select("page_id", "url", F.concat("html", link).alias("html"))
    judged = url_filter.filter_urls(linked, URL_RULES)
    return judged.withColumns({"trust": F.round("trust", 4), "distrust": F.round("distrust", 4)})


def op5_language_id(spark, sf):
    """Predicted language, learnt from the documents that are not held out."""
    docs = table(spark, sf, "documents").withColumn("held_out", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)))
    model = language_id.fit(docs.where(~F.col("held_out")))
    found = language_id.identify(docs, model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_simhash_dedup(spark, sf):
    """Fingerprint and component of every document."""
    return simhash_dedup.near_duplicates(table(spark, sf, "documents"))


def op7_token_counts(spark, sf):
    """Bytes and tokens of every document."""
    counted = token_counts.count_tokens(table(spark, sf, "documents"), tokenizer_path(), ["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op8_toxicity(spark, sf):
    """Toxicity of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf, "documents").withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)))
    learn = docs.where(~F.col("held_out")).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    scored = toxicity.score_toxicity(docs, toxicity.fit(learn), ["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_quality_ledger(spark, sf):
    """Measurements and verdict of the current policy."""
    rows = quality_ledger.ledger(table(spark, sf, "documents"), ["doc_id"])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_ledger.passes("base")).alias("base_failed"), quality_ledger.passes("v1").alias("kept"), "fail_bits",
    )


def op10_secret_scan(spark, sf):
    """Secrets of every document as spans."""
    found = secret_scan.scan(table(spark, sf, "documents"), ["doc_id"])
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *map(count, kinds), F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op11_prefix_trie(spark, sf):
    """Nodes of the trie of rebuilt conversations."""
    return conversation_trie.prefix_trie(table(spark, sf, "conversations"))


def op12_line_dedup(spark, sf):
    """Lines of every document that are frequent in all documents, dropped."""
    found = line_dedup.dedup_lines(table(spark, sf, "documents"), ["doc_id"])
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark, sf):
    """Leaf, roots and proof of every document, and what a tampered leaf folds to."""
    docs = table(spark, sf, "documents")
    rows = merkle_manifest.verify(merkle_manifest.manifest(docs, tampered=merkle_manifest.lower_cased_text(docs)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def pipeline(spark, sf):
    """All stages of ``corpus_pipeline``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_packing, op3_bpe_codec, op4_url_filter, linked_url_filter, op5_language_id, op6_simhash_dedup,
        op7_token_counts, op8_toxicity, op9_quality_ledger, op10_secret_scan, op11_prefix_trie, op12_line_dedup,
        op13_merkle_manifest, pipeline,
    )
}
