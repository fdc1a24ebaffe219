"""Physical plans under the settings of production: no pairwise joins, pruned columns, parsing without shuffles.

No join is a broadcast here, so what is looked at are the plans for large tables.
"""

import re

import pytest

from lanternstats.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def production(spark):
    """Adaptive execution and code generation on, no broadcast; the other tests' settings afterwards."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.codegen.wholeStage": "true",
        "spark.sql.codegen.factoryMode": "FALLBACK",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize(
    "name",
    ["user_stats", "bridge_users", "bridge_unknown_only", "ip_country", "ip_country_gaps", "ip_overlay", "timing_quartiles",
     "statuses_to_rewrite", "flag_matrix", "flag_overlap", "archive_completeness", "missing_references", "relink_statuses"],
)
def test_no_pairwise_join(production, name):
    text = plan(production, name)
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize(
    "name", ["split_documents", "parse_status_entries", "parse_server_descriptors", "history_explode", "scrub_servers"]
)
def test_parsing_does_not_shuffle(production, name):
    """Only the spreading of a one-file table over the slots may move rows."""
    text = plan(production, name)
    assert "hashpartitioning" not in text and "rangepartitioning" not in text


def test_only_needed_columns_are_read(production):
    schema = re.findall(r"ReadSchema: (\S+)", plan(production, "relay_statuses_per_day"))
    assert schema == ["struct<ts:timestamp_ntz>"]


def test_each_fact_table_is_read_once(production):
    assert len(re.findall(r"ReadSchema:", plan(production, "user_stats"))) == 3


def test_documents_are_not_shuffled_to_leave_relays_out(production):
    """The bridges that are relays meet parsed rows."""
    for _, columns in re.findall(r"Exchange\n(?:.*\n)*?Input \[\d+\]: (.*)\n(?:.*\n)*?Arguments: (hash.*)", plan(production, "bridge_unknown_only")):
        assert "content" not in columns and "text" not in columns
