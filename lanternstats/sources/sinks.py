"""Writers: fact tables, wide CSV files, bulk export, document archive."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanternstats import schemas
from lanternstats.plans.keyed_tables import with_date
from lanternstats.plans.summaries import wide

NOT_AVAILABLE = "NA"
EXPORT_NULL = "\\N"
EXPORT_ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def append_facts(rows, path, table):
    """Append new facts, one folder per date.

    Rows are dealt out by date first, large dates over several tasks, so that
    not every task writes a file into every folder.
    """
    dated = with_date(rows, schemas.EVENT_TIME[table]).hint("rebalance", "date")
    dated.write.mode("append").partitionBy("date").parquet(path)


def as_text(df, null=NOT_AVAILABLE):
    """Every column as text with a mark for null."""
    columns = []
    for f in df.schema.fields:
        text = F.col(f.name).cast("string")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DoubleType):
            text = F.format_string("%.2f", F.col(f.name))
            text = F.when(F.col(f.name).isNotNull(), text)
        elif isinstance(f.dataType, T.BooleanType) and null == EXPORT_NULL:
            text = F.when(F.col(f.name), "t").when(~F.col(f.name), "f")
        elif isinstance(f.dataType, T.BinaryType):
            text = F.concat(F.lit("\\\\x" if null == EXPORT_NULL else "\\x"), F.lower(F.hex(f.name)))
        elif isinstance(f.dataType, T.StringType) and null == EXPORT_NULL:
            for plain, escaped in EXPORT_ESCAPES:
                text = F.replace(text, F.lit(plain), F.lit(escaped))
        columns.append(F.coalesce(text, F.lit(null)).alias(f.name))
    return df.select(*columns)


def write_csv(df, path, order=()):
    """A sorted CSV file with a header and ``NA`` for null.

    A total order makes the part files, read in name order, one sorted list.
    """
    rows = as_text(df)
    if order:
        rows = rows.orderBy(*order)
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_wide_csv(rows, path, key, column, value, columns=None):
    """One column per country or bundle; ``zy`` is headed ``all``."""
    table = wide(rows, key, column, value, columns, rename={"zy": "all"})
    write_csv(table, path, order=key)


def write_bulk_export(df, path):
    """Tab-separated rows for bulk loading: ``t``/``f``, a mark for null, hex for bytes, escaped text."""
    as_text(df, EXPORT_NULL).write.mode("overwrite").option("sep", "\t").option(
        "quote", ""
    ).option("escape", "").option("emptyValue", "").csv(path)


def archive_rows(docs, doc_type, digest, time):
    """Documents keyed by content digest, placed by type and month."""
    return docs.select(
        F.lit(doc_type).alias("type"),
        F.date_format(time, "yyyy").alias("year"),
        F.date_format(time, "MM").alias("month"),
        F.date_format(time, "dd").alias("day"),
        F.col(digest).alias("digest"),
        "content",
    )


def store_documents(rows, stored, path):
    """Add documents to the archive whose type and digest it does not hold yet."""
    new = rows.groupBy("type", "digest").agg(
        F.min(F.struct("year", "month", "day", "content")).alias("_row")
    ).select("type", "digest", "_row.*")
    if stored is not None:
        new = new.join(stored.select("type", "digest").distinct(), ["type", "digest"], "left_anti")
    new.hint("rebalance", "type", "year", "month").write.mode("append").partitionBy("type", "year", "month").parquet(path)
