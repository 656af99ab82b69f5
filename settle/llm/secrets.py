"""Secret scan with corpus-wide ownership of the values found, in DataFrame functions only.

Candidates are found by three patterns. The hash of each candidate's value is
counted over the corpus by distinct owners and by distinct repositories: a value
that many owners hold, or few in many of their repositories, is a copied example;
one that few owners hold in few repositories and that looks random is
live-looking. Live-looking values add a span of kind
`live` over the value; the spans of the patterns stay.

Owners and repositories are columns of the caller; `documents` has one column,
`source`, which serves as owner, and each document as a repository. A null owner
is an owner of its own.

Only spans are shuffled, never texts; masking keeps a stored copy of the documents. Owners of a value are made distinct with
map-side combine before they are counted, so a value copied into any share of
the corpus is a few rows per task; the join back splits hot values.

Null texts are empty. Repeated rows are scanned one by one; they share a
doc_id, so they count as one repository. Of patterns that overlap each reports its
own span; a value they share counts once as live. An empty table gives no rows. A
text of very many values takes time in proportion to them. Masking allows columns
of any names; `scan` adds `_base`, `_live`, `_n_copied`, `_n_owners` and
`_n_repositories`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.llm.common import store

ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
# Runs of one class: with the least length in the pattern the same runs match.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex")
LIVE = "live"
LIVE_OWNERS = 3  # held by so many owners at most
LIVE_REPOSITORIES = 25  # and in so many repositories of theirs
BLOCK = 256  # results that a fold appends one by one
MASK = "<secret>"
LIVE_DISTINCT = 8  # distinct characters that a random-looking value has at least

SPAN = "struct<start: bigint, rank: int, end: bigint, kind: string, value: string, end_byte: bigint>"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}


def running(items: Column, zero: Column, found: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Results of a left fold that appends one result, of type `found`, for each item.

    step(state, item) gives the next state and the result. Results are appended
    in blocks and the blocks put together at the end: appending to one array
    copies it each time, which takes a text of many values for ever.
    """
    none, nothing = F.array().cast(f"array<{found}>"), F.array().cast(f"array<array<{found}>>")
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))

    def add(done: Column, item: Column) -> Column:
        state, result = step(done["state"], item)
        return F.struct(state.alias("state"), F.concat(done["found"], F.array(result)).alias("found"))

    def add_block(done: Column, block: Column) -> Column:
        within = F.aggregate(block, F.struct(done["state"].alias("state"), none.alias("found")), add)
        return F.struct(within["state"].alias("state"), F.concat(done["found"], F.array(within["found"])).alias("found"))

    start = F.struct(zero.alias("state"), nothing.alias("found"))
    return F.aggregate(blocks, start, add_block, lambda done: F.flatten(done["found"]))


def steps_of(matches: Column, between: Column, kind: str) -> Column:
    """For each match its value and the lengths, in code points and bytes, of what precedes it and of itself.

    `between` is the text split by the pattern, so the start of a match is the
    length of all before it.
    """
    def step(match: Column, gap: Column) -> Column:
        value = F.regexp_extract(match, ASSIGN, 2) if kind == "assign" else match
        return F.struct(
            F.char_length(gap).alias("gap"), F.char_length(match).alias("size"), F.octet_length(gap).alias("gap_bytes"),
            F.octet_length(match).alias("size_bytes"), value.alias("value"),
        )

    return F.zip_with(matches, F.slice(between, 1, F.size(matches)), step)


def spans_of(steps: Column, kind: str) -> Column:
    """Matches as spans in code points and bytes, ends exclusive."""
    def place(at: Column, step: Column) -> tuple[Column, Column]:
        begin, begin_byte = at["at"] + step["gap"], at["byte"] + step["gap_bytes"]
        end, end_byte = begin + step["size"], begin_byte + step["size_bytes"]
        span = F.struct(
            begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            step["value"].alias("value"), end_byte.alias("end_byte"),
        )
        return F.struct(end.alias("at"), end_byte.alias("byte")), span

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("byte"))
    return running(steps, zero, SPAN, place)


def with_base_spans(documents: DataFrame, text: str) -> DataFrame:
    """Adds `_spans`: those of the three patterns by start, then kind; `value` is the secret itself."""
    none = F.array().cast(f"array<{SPAN}>")
    made = documents
    for kind, pattern in PATTERNS.items():
        made = made.withColumn(f"_{kind}", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    for kind, pattern in PATTERNS.items():
        some = F.size(f"_{kind}") > 0
        made = made.withColumn(f"_{kind}_between", F.when(some, F.split(text, pattern, -1)))
    for kind in PATTERNS:
        steps = steps_of(F.col(f"_{kind}"), F.col(f"_{kind}_between"), kind)
        made = made.withColumn(f"_{kind}_steps", F.when(F.size(f"_{kind}") > 0, steps))
    each = []
    for kind in PATTERNS:
        found = spans_of(F.col(f"_{kind}_steps"), kind)
        if kind == "assign":
            found = F.filter(found, lambda span: F.char_length(span["value"]) >= ASSIGN_LENGTH)
        each.append(F.when(F.size(f"_{kind}") > 0, found).otherwise(none))
    return made.withColumn("_spans", F.array_sort(F.concat(*each)))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def candidates(documents: DataFrame, columns: list[str], owner: str, repository: str) -> DataFrame:
    """`columns` of every document with its spans, owner and repository; stored, so that texts are scanned once.

    A hash stands for the value from here on; no secret is written by itself.
    """
    picked = documents.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*columns).alias("_kept"),
        F.col(owner).cast("string").alias("_owner"),
        F.col(repository).cast("string").alias("_repository"),
        F.coalesce("text", F.lit("")).alias("_scanned"),
    )
    hashed = F.transform("_spans", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        F.sha2(s["value"], 256).alias("hash"), F.char_length(s["value"]).alias("size"),
        (s["end_byte"] - F.octet_length(s["value"])).alias("start_byte"), s["end_byte"].alias("end_byte"),
        F.size(F.array_distinct(F.split(s["value"], ""))).alias("distinct"),
    ))
    scanned = with_base_spans(picked, "_scanned")
    return store(scanned.select("_row", "_kept", "_owner", "_repository", hashed.alias("_spans")), "secret_candidates")


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories and n_found of every candidate value."""
    each = found.select(F.col("_owner"), F.col("_repository"), F.explode("_spans.hash").alias("hash"))
    # By repository first: repeats within one are combined before anything is shuffled.
    by_repository = each.groupBy("hash", "_owner", "_repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("hash", "_owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_found")
    )


def is_live() -> Column:
    """Held by few owners and in few of their repositories, and random in looks: no widely copied example."""
    few = (F.col("n_owners") <= LIVE_OWNERS) & (F.col("n_repositories") <= LIVE_REPOSITORIES)
    return few & (F.col("distinct") >= LIVE_DISTINCT)


def judged_spans(documents: DataFrame, kept: list[Column], owner: str, repository: str) -> DataFrame:
    """`kept` of every document as `_kept`, base spans, spans of live-looking values, and counts over its values."""
    found = candidates(documents, kept, owner, repository)
    some = F.size("_spans") > 0
    each = found.where(some).select("_row", F.explode("_spans").alias("span")).select("_row", "span.*")
    # A value lies at the end of its span.
    live = F.struct(
        (F.col("end") - F.col("size")).alias("start"), F.lit(len(KINDS)).alias("rank"), "end", F.lit(LIVE).alias("kind"),
        "start_byte", "end_byte",
    )
    copied = (F.col("n_owners") > LIVE_OWNERS) | (F.col("n_repositories") > LIVE_REPOSITORIES)
    judged = each.join(ownership(found).drop("n_found"), "hash").groupBy("_row").agg(
        # Overlapping patterns find a value twice; it is reported once.
        F.array_sort(F.collect_set(F.when(is_live(), live))).alias("_live"),
        F.count_if(copied).alias("_n_copied"), F.max("n_owners").alias("_n_owners"), F.max("n_repositories").alias("_n_repositories"),
    )
    base = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    none = F.array().cast("array<struct<start: bigint, rank: int, end: bigint, kind: string, start_byte: bigint, end_byte: bigint>>")
    counts = ["_n_copied", "_n_owners", "_n_repositories"]
    # Documents without a candidate, most of the corpus, take no part in the shuffle.
    quiet = found.where(~some).select("_kept", base.alias("_base"), none.alias("_live"), *[F.lit(0).cast("bigint").alias(c) for c in counts])
    return found.where(some).join(judged, "_row").select("_kept", base.alias("_base"), "_live", *counts).unionByName(quiet)


def scan(documents: DataFrame, columns: list[str], owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """`columns` of every document, its base spans and those of live-looking values.

    `_base` and `_live` are arrays of (start, rank, end, kind) in order;
    `_n_copied` counts values that are widely copied, `_n_owners` and
    `_n_repositories` are the most that any value of the document has.
    """
    found = judged_spans(documents, columns, owner, repository)
    live = F.transform("_live", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.select("_kept.*", "_base", live.alias("_live"), "_n_copied", "_n_owners", "_n_repositories")


def masked(text: Column, spans: Column) -> Column:
    """The text with `<secret>` in place of every span; spans are in order and may overlap.

    Cut by bytes, since finding a code point means reading from the start.
    """
    data = text.cast("binary")

    def cut(at: Column, span: Column) -> tuple[Column, Column]:
        apart = span["start_byte"] >= at
        gap = F.when(apart, F.substring(data, (at + 1).cast("int"), (span["start_byte"] - at).cast("int")))
        return F.greatest(at, span["end_byte"]), F.coalesce(F.concat(gap, F.lit(MASK).cast("binary")), F.lit("").cast("binary"))

    end = F.array_max(F.transform(spans, lambda s: s["end_byte"]))
    rest = F.substring(data, (end + 1).cast("int"), F.lit(2**31 - 1))
    pieces = running(spans, F.lit(0).cast("bigint"), "binary", cut)
    return F.concat(F.array_join(F.transform(pieces, lambda p: p.cast("string")), ""), rest.cast("string"))


def mask_live(documents: DataFrame, owner: str = "source") -> DataFrame:
    """Every document, live-looking secrets replaced by a mask; copied examples stay as they are."""
    columns = [f"`{c}`" for c in documents.columns]
    found = judged_spans(documents, columns, owner, "doc_id")
    text = F.when(F.size("_live") > 0, masked(F.col("_kept.text"), F.col("_live"))).otherwise(F.col("_kept.text"))
    return found.select(F.col("_kept").withField("text", text).alias("_kept")).select("_kept.*").select(*columns)
