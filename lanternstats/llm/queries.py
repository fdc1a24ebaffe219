"""Registered queries of this folder; each applies its operator to the whole of its table."""

from lanternstats.llm import decontaminate, filter_audit, language_id, lattice_lm, lexical_search, mixing, near_duplicates, ngram_join, quality_bands, secrets, token_counts, toxicity, warc_zstd
from lanternstats.llm.common import table


def op1_lattice_lm(spark, folder):
    return lattice_lm.score_documents(table(spark, folder, "documents"))


def op2_secret_scan(spark, folder):
    return secrets.digests(secrets.scan(table(spark, folder, "documents")))


def op3_compression_bands(spark, folder):
    return quality_bands.compression_bands(table(spark, folder, "documents"))


def op4_mix_sources(spark, folder):
    plan = mixing.mix_plan(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return plan.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken")


def op5_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"))


def op6_decontaminate(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans", "items")


def op7_toxicity(spark, folder):
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_language_id(spark, folder):
    return language_id.language_id(table(spark, folder, "documents"))


def op9_near_duplicates(spark, folder):
    docs = table(spark, folder, "documents")
    return near_duplicates.near_duplicates(docs, words=3, similarity=(85, 100))


def op10_warc_zstd(spark, folder):
    return warc_zstd.round_trip(table(spark, folder, "pages"))


def op11_ngram_join(spark, folder):
    return ngram_join.ngram_join(table(spark, folder, "documents"))


def op12_lexical_search(spark, folder):
    return lexical_search.lexical_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_filter_audit(spark, folder):
    return filter_audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_lattice_lm,
        op2_secret_scan,
        op3_compression_bands,
        op4_mix_sources,
        op5_token_counts,
        op6_decontaminate,
        op7_toxicity,
        op8_language_id,
        op9_near_duplicates,
        op10_warc_zstd,
        op11_ngram_join,
        op12_lexical_search,
        op13_filter_audit,
    )
}
ORACLES = {
    "op4_mix_sources": mixing.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op10_warc_zstd": warc_zstd.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
