"""The batch jobs driven by a stream of new files."""

from pyspark.sql import functions as F

from lanternstats.plans import warehouse
from lanternstats.sources.archive import unpacked

BINARY_FILES = "path string, modificationTime timestamp, length long, content binary"


def document_stream(spark, folder, files_per_batch=1000):
    """New files below a folder; the stream's checkpoint knows their paths, ``new_names`` their names."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", F.substring_index("path", "/", -1).alias("name"), F.col("modificationTime").alias("modified"), "content")
    )


def new_names(spark, root, batch, files):
    """The files of a micro-batch whose base name no earlier batch has had; of one name the first path.

    The names of a batch are stored before its files are read.  A batch that is run again replaces them, and
    compares itself with earlier batches only, so a restart neither repeats nor loses a file.  Contents are not shuffled: a
    batch has at most ``files_per_batch`` files, whose paths are broadcast.
    """
    path = f"{root}/imported"
    first = files.groupBy("name").agg(F.min("path").alias("path"))
    if warehouse.exists(spark, path):
        before = spark.read.schema("name string, path string, batch bigint").parquet(path).where(F.col("batch") < batch)
        first = first.join(before.select("name").distinct(), "name", "left_anti")
    first.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    chosen = spark.read.schema("name string, path string").parquet(f"{path}/batch={batch}")
    return files.join(F.broadcast(chosen.select("path")), "path", "left_semi")


def load_batch(root):
    """A ``foreachBatch`` function: load the facts of new files and refresh the dates they touch."""
    def run(files, batch_id):
        spark = files.sparkSession
        files = new_names(spark, root, batch_id, files)
        docs = warehouse.stage_documents(spark, root, unpacked(files))
        warehouse.load_facts(spark, root, batch_id, warehouse.relay_facts(docs))
        updates = warehouse.pending_updates(spark, root)
        fact = lambda name: warehouse.fact_table(spark, root, name)
        warehouse.refresh(
            spark, root, batch_id,
            fact("statusentry"), fact("descriptor"), fact("bwhist"), fact("dirreq_stats"), updates,
        )

    return run


def start(spark, folder, root, checkpoint):
    """Process the files at hand and stop; run it as often as new files arrive."""
    return (
        document_stream(spark, folder)
        .writeStream.foreachBatch(load_batch(root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
