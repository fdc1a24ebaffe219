"""Secret scans: multipart credential linking.

Strong patterns are reported wherever they match.  Weak ones (a user name, a short or oddly named secret, the
address of a service) are reported only next to a part of another kind: access identifiers, secrets and
endpoints of a document are joined on the scopes, stretches of the text, that they lie in.  Only DataFrame
functions are used.
"""

from pyspark.sql import functions as F

from lanternstats.llm.common import stored, workspace

VALUE = "[A-Za-z0-9+/_.=-]+"
#: Strong kinds in their order: pattern, group that has a least length, that length, what a text must contain.
STRONG = (
    (
        "assign",
        rf"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({VALUE})""",
        2,
        12,
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    ("hex", "[0-9a-f]{16,}", 0, 16, ()),  # the same matches as of one or more, and fewer to drop
)
#: Weak kinds, each with the role it plays: pattern, group, least length, what a text must contain.
WEAK = (
    (
        "weak_access",
        rf"""(?i:\b(access_?(?:key_?)?id|client_?id|key_?id|user(?:_?name)?|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)""",
        2,
        3,
        ("id", "user", "login"),
    ),
    (
        "weak_secret",
        rf"""(?i:\b(pwd|passphrase|credential|(?:secret|private|access)_key|auth))["']?\x20*[:=]\x20*["']?({VALUE})""",
        2,
        6,
        ("pwd", "passphrase", "credential", "_key", "auth"),
    ),
    (
        "weak_short",
        rf"""(?i:\b(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{{6,11}})(?![A-Za-z0-9+/_.=-])""",
        2,
        6,
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
    ),
    (
        "endpoint",
        r"""\b(?:https?|ftp|s3|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)://[^\x20\x09-\x0D"'<>]+""",
        0,
        8,
        ("://",),
    ),
)
ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret", "weak_short": "secret",
        "access": "access", "weak_access": "access", "endpoint": "endpoint"}
#: Parts lie in the same scope if at most so many characters are between them.
SCOPE = 200
#: A weak candidate needs a neighbour with one of these roles.
PARTNERS = {"access": ("secret",), "secret": ("access", "endpoint"), "endpoint": ("secret",)}

#: Matches or spans of a text that an array grows by at a time: growing copies it, so stretches keep the work linear.
STRETCH = 512

_SPAN = "array<struct<kind:string,start:int,stop:int>>"


def _once(column, fn):
    """``fn`` of a column that is computed once per row."""
    return F.element_at(F.transform(F.array(column), fn), 1)


def _stretches(column):
    """An array cut into arrays of ``STRETCH`` members."""
    last = F.floor((F.size(column) - 1) / STRETCH).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(column, k * STRETCH + 1, STRETCH))
    return F.filter(cut, lambda stretch: F.size(stretch) > 0)


def spans_of(text, lowered, kind, pattern, group, least, hints):
    """Spans of the leftmost matches of ``pattern`` whose group is long enough, in code points."""

    def find(t):
        matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        sized = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else matches
        gaps = F.transform(F.split(t, pattern, -1), F.length)
        parts = F.arrays_zip(gaps.alias("gap"), F.transform(matches, F.length).alias("size"), F.transform(sized, F.length).alias("value"))
        inside = F.filter(parts, lambda p: p["size"].isNotNull())  # the last gap has no match after it
        return _once(inside, lambda p: _once(F.transform(_stretches(p), places), moved))

    def places(stretch):
        """Characters up to the end of a stretch's last match, and spans that count from its beginning."""
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

        def step(state, part):
            start = state["at"] + part["gap"]
            stop = start + part["size"]
            span = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop")))
            grown = F.when(part["value"] >= least, F.concat(state["spans"], span)).otherwise(state["spans"])
            return F.struct(stop.alias("at"), grown.alias("spans"))

        return F.aggregate(stretch, begin, step)

    def moved(stretches):
        """The spans of all stretches, counted from the beginning of the text."""
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
        step = lambda state, x: F.struct((state["at"] + x["at"]).alias("at"), F.concat(state["begins"], F.array(state["at"])).alias("begins"))
        by = lambda n: lambda s: F.struct(s["kind"].alias("kind"), (s["start"] + n).alias("start"), (s["stop"] + n).alias("stop"))
        begins = F.aggregate(stretches, begin, step, lambda state: state["begins"])
        return F.flatten(F.zip_with(stretches, begins, lambda x, n: F.transform(x["spans"], by(n))))

    may = F.lit(True)
    if hints:
        may = F.contains(lowered, F.lit(hints[0]))
        for hint in hints[1:]:
            may = may | F.contains(lowered, F.lit(hint))
    return F.when(may & F.regexp_like(text, F.lit(pattern)), _once(text, find)).otherwise(F.array().cast(_SPAN))


def in_order(spans):
    """Spans by start, then kind as listed."""
    kinds = [k[0] for k in STRONG + WEAK]
    place = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), place(s).alias("b"), s["stop"].alias("c"), s["kind"].alias("d")))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["d"].alias("kind"), s["a"].alias("start"), s["c"].alias("stop"))
    )


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def scan(df, id_col="doc_id", text_col="text", scope=SCOPE):
    """Strong spans, linked weak spans and all of them, per row of ``df``.

    Null and empty texts have no spans.  Rows are told apart by their place, not by their id: null and repeated
    ids give a row each.  Spans count code points from 0, the end is exclusive.  A weak span that overlaps a
    strong one is not reported.  Empty tables give no rows.  Very long texts are scanned whole, in time that grows with
    their length and their spans.  Extra columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = df.select(F.col(id_col).alias("id"), text.alias("t"))
    found = found.select("id", "t", F.lower("t").alias("low"))
    of = lambda kinds: in_order(F.concat(*[spans_of(F.col("t"), F.col("low"), *k) for k in kinds]))
    found = found.select(F.monotonically_increasing_id().alias("row"), "id", of(STRONG).alias("strong"), of(WEAK).alias("weak"))
    # Spans are small beside the texts; written once, the row numbers stay what they are.
    found = stored(found, workspace(df.sparkSession), "spans")
    linked = linked_weak(found, scope)
    return found.join(linked, "row", "left").select(
        F.col("id").alias(id_col),
        "strong",
        F.coalesce("linked", F.array().cast(_SPAN)).alias("linked"),
        in_order(F.concat("strong", F.coalesce("linked", F.array().cast(_SPAN)))).alias("spans"),
    )


def linked_weak(found, scope=SCOPE):
    """Weak spans with a complementary part within ``scope`` characters.

    Texts are cut into stretches of ``scope`` characters.  A part is in every stretch it touches, a candidate
    also in the neighbouring ones, so an equality join on (row, stretch) finds all pairs; a stretch holds only as
    many parts as fit into it.
    """
    part = lambda name, reach: found.select("row", F.inline(name)).withColumn(
        "cell", F.explode(F.sequence(F.floor((F.col("start") - reach) / scope), F.floor((F.col("stop") + reach) / scope)))
    )
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
    weak = part("weak", scope).withColumn("wants", role[F.col("kind")])
    rest = found.where(F.size("weak") > 0).select("row", F.concat("strong", "weak").alias("parts"))
    rest = (
        rest.select("row", F.inline("parts"))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("stop") / scope))))
        .select("row", "cell", F.col("kind").alias("kind2"), F.col("start").alias("start2"), F.col("stop").alias("stop2"))
    )
    strong = F.col("kind2").isin(*[k[0] for k in STRONG])
    apart = F.greatest(F.col("start2") - F.col("stop"), F.col("start") - F.col("stop2"))
    fits = F.lit(False)
    for own, others in PARTNERS.items():
        fits = fits | ((F.col("wants") == own) & role[F.col("kind2")].isin(*others))
    pairs = weak.join(rest, ["row", "cell"]).groupBy("row", "kind", "start", "stop").agg(
        F.max((fits & (apart >= 0) & (apart <= scope)).cast("int")).alias("linked"),
        F.max((strong & (apart < 0)).cast("int")).alias("covered"),
    )
    return (
        pairs.where("linked = 1 AND covered = 0")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "stop")).alias("linked"))
    )


def redact(text, spans, mark="[SECRET]"):
    """``text`` with every span, and spans that overlap, replaced by ``mark``; ``spans`` are in order.

    Each stretch of spans looks only into its own part of the text, so that the work grows with the text and the spans.
    """
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))

    def within(base, part):
        """How a span continues the pieces of ``part``, which is the text from ``base`` on."""

        def step(state, span):
            before = F.substring(part, state["at"] - base + 1, span["start"] - state["at"])
            fresh = span["start"] >= state["at"]
            pieces = F.when(fresh, F.concat(state["pieces"], F.array(before, F.lit(mark)))).otherwise(state["pieces"])
            return F.struct(F.greatest(state["at"], span["stop"]).alias("at"), pieces.alias("pieces"))

        return step

    def step(state, stretch):
        base = state["at"]
        part = F.substring(text, base + 1, F.greatest(F.element_at(stretch, -1)["start"] - base, F.lit(0)))
        start = F.struct(base.alias("at"), F.array().cast("array<string>").alias("pieces"))
        done = _once(part, lambda p: F.aggregate(stretch, start, within(base, p)))
        grown = lambda d: F.struct(d["at"].alias("at"), F.concat(state["pieces"], F.array(F.array_join(d["pieces"], ""))).alias("pieces"))
        return _once(done, grown)

    end = lambda s: F.concat(F.array_join(s["pieces"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    return _once(spans, lambda x: F.aggregate(_stretches(x), begin, step, end))


def digests(scanned, id_col="doc_id"):
    """Counts and digests of what ``scan`` returned."""
    count = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.col("strong")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
