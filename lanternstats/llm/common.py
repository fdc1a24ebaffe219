"""Small helpers the operators of this folder share."""

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F

#: White space of the contracts: blank and the control characters 09 to 0D.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(module):
    """Send the functions of ``module`` to the executors by value, so that they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def workspace(spark):
    """A new folder of this run under the shared folder that the cluster names.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lantern-llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df, folder, name):
    """``df`` written as Parquet in a shared folder and read again: it cuts the lineage and is computed once."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, UPPER, LOWER)


def is_in_fold(id_column, modulus, remainder):
    """Whether crc32 of the id, as text, leaves ``remainder``; a null id is in no fold."""
    fold = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(modulus))
    return F.coalesce(fold == remainder, F.lit(False))


def slices(batches, rows=256):
    """Arrow batches in pieces of a few rows, so that only those are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


ship(__name__)
