"""State carried along the lines of a document grows with the lines, not with their square."""

import random
import time

from pyspark.sql import functions as F

from lanternstats.functions import text as tx
from lanternstats.operators import bridges, descriptors


def test_held(spark):
    rng = random.Random(5)
    lines = [rng.choice(["a 1", "a 2", "b 3", "ab", "a", "", "c a 9"]) for _ in range(200)]
    frame = spark.createDataFrame([(lines,), (["x", "a 7"],), ([],)], "lines array<string>")
    got = [r.h for r in frame.select(tx.held(F.col("lines"), "a ").alias("h")).collect()]
    want, last = [], None
    for line in lines:
        last = line if line.startswith("a ") else last
        want.append(last)
    assert got[:2] == [want, [None, "a 7"]]
    numbers = frame.select(tx.held(F.col("lines"), "a ", lambda line: tx.to_int(tx.field(line, 1))).alias("h")).first().h
    assert numbers == [None if w is None else int(w[2:]) for w in want]


def extra(lists):
    body = "".join(
        f"published 2010-02-10 00:00:0{i % 10}\nwrite-history 2010-02-09 12:00:00 (900 s) {i}\n"
        f"dirreq-stats-end 2010-02-09 00:30:00 ({86400 + i} s)\ndirreq-v3-reqs de=8,us=16,de={i + 4}\n"
        for i in range(lists)
    )
    return f"extra-info nick {'AB' * 20}\n{body}router-signature\nx"


def bridge(lists):
    body = "".join(f"published 2010-02-{1 + i % 28:02d} 00:00:00\ngeoip-client-origins de={8 + i},us=16\nbridge-ips fr=8\n" for i in range(lists))
    return f"extra-info nick {'AB' * 20}\ngeoip-start-time 2010-01-01 00:00:00\nbridge-stats-end 2010-02-09 00:00:00 (86400 s)\n{body}router-signature\nx"


def test_requests_follow_their_header(docs):
    rows = descriptors.directory_requests(docs(extra(40))).collect()
    assert {(r.seconds, r.country): r.requests for r in rows} == {
        (86400 + i, c): n for i in range(40) for c, n in (("de", i), ("us", 12), ("zy", 16 + i))
    }


def test_users_follow_their_header(docs):
    rows = bridges.bridge_users(bridges.with_identity(docs(bridge(28)))).where("kind = 'geoip' AND country = 'us'").collect()
    assert {r.seen.day: r.users for r in rows} == {d: round(12 / (30 + d), 2) for d in range(1, 29)}


def test_four_times_the_lines(docs):
    for make, parse in (
        (extra, descriptors.history_values),
        (extra, descriptors.directory_requests),
        (bridge, lambda d: bridges.bridge_users(bridges.with_identity(d))),
    ):
        def seconds(lists):
            frame = docs(make(lists))
            start = time.perf_counter()
            parse(frame).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        seconds(10)
        small, large = min(seconds(2_000) for _ in range(2)), seconds(8_000)
        # Four times the lines; the square would take sixteen times as long.
        assert large < 9 * small + 1


def test_long_list_of_countries(docs):
    pairs = ",".join(f"{c}{d}={8 * (1 + k)}" for k in range(40) for c in "abcdefghij" for d in "abcdefghij")
    text = f"extra-info nick {'AB' * 20}\npublished 2010-02-10 00:00:00\ndirreq-stats-end 2010-02-09 00:30:00 (86400 s)\ndirreq-v3-reqs {pairs}\nrouter-signature\nx"
    rows = {r.country: r.requests for r in descriptors.directory_requests(docs(text)).collect()}
    assert len(rows) == 101 and rows["ab"] == 8 * 40 - 4 and rows["zy"] == sum(100 * (8 * (1 + k) - 4) for k in range(40))
