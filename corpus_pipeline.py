"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, mixing.

A stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``, with the columns of ``documents``;
the last one returns each document as often as the mix takes it, numbered in a further column.
"""

from pyspark.sql import functions as F

from lanternstats.llm import decontaminate as leaks
from lanternstats.llm import language_id as languages
from lanternstats.llm import mixing
from lanternstats.llm import near_duplicates as duplicates
from lanternstats.llm import secrets
from lanternstats.llm.common import stored, table, workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keyed(docs):
    """Rows of a Parquet table, each with a key of its own: that of its file and its place in there.

    It is the same whenever the table is read, and null ids, repeated ids and equal rows do not share it.
    """
    return docs.select(*COLUMNS, F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("key"))


def language_id(spark, docs, sf_dir):
    """Documents in a language; those without a letter in them go, also if no label tells a language."""
    rows = keyed(docs)
    labelled = docs.select("doc_id", "text", "lang")
    found = languages.language_id(rows, id_col="key", fold=None, labelled=labelled, labelled_id_col="doc_id")
    rejected = found.where("lang_pred = 'und'").select("key", F.lit(True).alias("rejected"))
    # Without any label everything is undetermined.
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return rows.join(rejected, "key", "left").where(F.col("rejected").isNull() | has_letter).select(COLUMNS)


def near_duplicates(spark, docs, sf_dir):
    """One row of each group: that with the smallest id, of several the first by key; no id comes last."""
    rows = keyed(docs)
    found = duplicates.near_duplicates(rows, id_col="key", words=5, similarity=(80, 100)).select("key", "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "key")
    first = rows.select("key", "doc_id").join(found, "key").groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select("first.key"), "key", "left_semi").select(COLUMNS)


def decontaminate(spark, docs, sf_dir):
    """Rows without any window of the benchmark, each judged alone."""
    return leaks.clean_documents(keyed(docs), table(spark, sf_dir, "benchmark"), id_col="key").select(COLUMNS)


def secret_scan(spark, docs, sf_dir):
    """All documents, with every secret replaced by a mark."""
    rows = keyed(docs)
    found = secrets.scan(rows, id_col="key").where(F.size("spans") > 0).select("key", "spans")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(secrets.redact(F.col("text"), F.col("spans")))
    n_chars = F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length("new").cast("long"))
    return (
        rows.join(found, "key", "left")
        .withColumn("new", text)
        .withColumn("n_chars", n_chars)
        .withColumn("text", F.col("new"))
        .select(COLUMNS)
    )


def mix(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.emit(mixing.mix_plan(docs.select(COLUMNS))).select(*COLUMNS, "copy")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("mix", mix),
]

#: Language ID, MinHash and the linking of secrets are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """What the stages leave of ``documents``; each stage is written and read again."""
    docs, folder = table(spark, sf_dir, "documents"), workspace(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
