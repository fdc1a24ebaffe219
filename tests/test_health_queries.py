"""Queries on all status documents parse each of them once."""

from lanternstats import queries
from lanternstats.operators import statuses

ENTRY = "r nick{k}x{i} AAAAAAAAAAAAAAAAAAAAAAAAAAA BBBBBBBBBBBBBBBBBBBBBBBBBBB 2010-02-01 00:00:00 1.2.3.4 9001 0\ns {flags}\n"
HEAD = "network-status-version 3\n{kind}valid-after 2010-02-01 0{hour}:00:00\nknown-flags Exit Running\ndir-source {dir} FP 10.0.0.1 80 443\n"


def text(dir_, vote, hour, *flags):
    entries = "".join(ENTRY.format(k=dir_, i=i, flags=f) for i, f in enumerate(flags))
    return HEAD.format(kind="vote-status vote\n" if vote else "", hour=hour, dir=dir_) + entries


def rows(spark):
    texts = [
        text("a", True, 1, "Exit Running", "Fast"), text("b", True, 1), text("c", False, 1, "Running", "Exit", "Running"),
        text("c", False, 1, "Running"), text("d", False, 2), text("d", False, 2, "Running"),
    ]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def parsed_once(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return "LogicalRDD" not in plan and "/parsed" in "".join(frame.inputFiles())


def test_counts(spark):
    """Of two consensuses of a time the first counts, though it lists nothing."""
    got = queries.vote_relay_counts(rows(spark))
    assert {(r.validafter.hour, r.dir, r.total, r.running) for r in got.collect()} == {(1, "a", 2, 1), (1, "consensus", 3, 2)}
    assert parsed_once(got)


def test_overlap(spark):
    """A vote without entries still names the flags it knows."""
    got = queries.flag_overlap_documents(rows(spark))
    assert {(r.dir, r.flag): (r.lost, r.agree, r.missing) for r in got.collect()} == {
        ("a", "Exit"): (1, None, 1), ("a", "Running"): (None, 1, None), ("b", "Exit"): (None,) * 3, ("b", "Running"): (None,) * 3,
    }
    assert parsed_once(got)


def test_outer_entries(spark):
    frame = rows(spark)
    assert statuses.vote_entries(frame, keep=["doc_id"]).count() == 7
    outer = statuses.vote_entries(frame, keep=["doc_id"], outer=True).select("doc_id", "has_flags").collect()
    assert len(outer) == 9 and {r.doc_id for r in outer if r.has_flags is None} == {1, 4}
