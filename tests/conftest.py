import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lanternstats.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            # Compiling the plans takes longer than running them on a few rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.adaptive.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Documents from texts: ``doc``, ``content`` and ``text``."""
    from pyspark.sql import functions as F

    def make(*texts):
        rows = [(i, bytearray(t, "latin-1")) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "doc int, content binary")
        return frame.withColumn("text", F.decode("content", "ISO-8859-1"))

    return make
