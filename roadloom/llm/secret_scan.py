"""Secret scans with corpus-wide ownership frequency, DataFrame functions only.

Regular expressions propose candidates with code-point spans. Each candidate value's hash is
counted over the whole corpus by distinct owners and repositories: values that many owners or many
repositories share are copied examples, values that few hold look like live credentials. The
listed base kinds always stay; the further kinds are spans only where they look live.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checked_broadcast, materialise, text_of

#: What may stand before a key: the text's start, or a character that no key holds.
EDGE = "(?:^|[^A-Za-z0-9_-])"


class Kind(NamedTuple):
    name: str
    pattern: str
    #: the group that holds the value, and its least length
    group: int
    least: int
    base: bool
    #: a cheap test that a text can hold the kind at all
    probe: str
    #: the span is the group alone, as the pattern takes in what stands before it
    edged: bool = False
    #: the value must have digits and letters of both cases
    mixed: bool = False
    #: its form alone marks a key: always, if it has the part of one, or never
    masked: str = "always"


KINDS = (
    Kind("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12, True, r"(?i)password|passwd|secret|token|api_?key", masked="key part"),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18, True, "AKIA"),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16, True, r"[0-9a-f]{16}", masked="never"),
    Kind(
        "hosted", EDGE + r"((?:gh[pousr]|github_pat|sk_live)_[A-Za-z0-9_]{16,}|glpat-[A-Za-z0-9_-]{16,}|xox[abpr]-[A-Za-z0-9-]{16,}|sk-(?:[a-z0-9]{1,20}-){0,3}[A-Za-z0-9]{20,})", 1, 20, False,
        r"gh[pousr]_|github_pat_|sk_live_|glpat-|xox[abpr]-|(?:^|[^A-Za-z0-9_-])sk-", edged=True, mixed=True,
    ),
    Kind("webtoken", EDGE + r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 26, False, "eyJ", edged=True),
    Kind("pemkey", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]{16,}", 0, 32, False, "-----BEGIN "),
)
BASE = [k.name for k in KINDS if k.base]
#: A value held by more owners or more repositories than these is a widely copied example.
MOST_OWNERS, MOST_REPOSITORIES = 2, 4
#: Parts of letters and digits alone that dotted names, dates, addresses, versions and compounds don't have: letters and digits mixed,
#: long ones or those of both cases; longer letters of one case than words have; and the groups of a universally unique identifier.
KEY_PARTS = (
    "(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{12,}(?![A-Za-z0-9])",
    "(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[A-Z0-9]*[a-z])(?=[a-z0-9]*[A-Z])[A-Za-z0-9]{8,}(?![A-Za-z0-9])",
    "(?<![A-Za-z0-9])(?:[a-z]{21,}|[A-Z]{21,})(?![A-Za-z0-9])",
    "(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])",
)


def _proposals(text: Column, number: int) -> Column:
    """Array of (kind, i, gap, length, value) for one kind's matches, leftmost and apart.

    gap is the text between a match and the one before, so running sums give the offsets.
    """
    kind = KINDS[number]
    whole, value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    zipped = F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(F.lit(number).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("length"), x["value"].alias("value")),
    )
    # the last gap has no match after it
    return F.when(text.rlike(kind.probe), F.filter(rows, lambda x: x["length"].isNotNull()))


def _in(kind: Column, which: list[int]) -> Column:
    return kind.isin(which) if which else F.lit(False)


def _fits(kind: Column, value: Column) -> Column:
    """Whether a match is a candidate of its kind: long enough and, where asked for, mixed."""
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), kind + 1)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    return (F.length(value) >= least) & (~_in(kind, [n for n, k in enumerate(KINDS) if k.mixed]) | mixed)


def _is_key(value: Column) -> Column:
    """Whether an assigned value has a part, between signs, that only a credential has: see KEY_PARTS."""
    return value.rlike("|".join(KEY_PARTS))


def _maskable(kind: Column, value: Column) -> Column:
    """Whether the form alone marks a key: a known form, or an assigned value with the part of one."""
    named = _in(kind, [n for n, k in enumerate(KINDS) if k.masked == "always"])
    return named | (_in(kind, [n for n, k in enumerate(KINDS) if k.masked == "key part"]) & _is_key(value))


def scan(docs: DataFrame, owner: str = "source", repository: str = "lang", most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> tuple[DataFrame, DataFrame]:
    """(rows, spans) of ``docs`` (doc_id, text and the columns that name owner and repository).

    rows: row_id, doc_id and digest for every row of docs. spans: row_id, kind (position in
    KINDS), start, end, value_start (code points, end exclusive), maskable, owners, repositories
    and live, for every base candidate and every live candidate of the other kinds. Live is a value
    of at most ``most_owners`` owners and ``most_repositories`` repositories. A repository is named
    by its owner and its own name; null names count as one name. Null text is empty text and has no
    span, as an empty table has none; repeated rows have spans each, and count once as holders.
    """
    text = F.col("text")
    scanned = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", text_of().alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,length:int,value:string>>")
    found = F.concat(*[F.coalesce(_proposals(text, n), none) for n in range(len(KINDS))])
    hashed = F.transform(found, lambda x: F.struct(
        x["kind"].alias("kind"), x["i"].alias("i"), x["gap"].alias("gap"), x["length"].alias("length"), F.length(x["value"]).alias("value_length"),
        F.unhex(F.sha2(x["value"], 256)).alias("hash"), _fits(x["kind"], x["value"]).alias("fits"), _maskable(x["kind"], x["value"]).alias("maskable"),
    ))
    # the ids are fixed by this table; no text in it
    rows = materialise(scanned.select("row_id", "doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), "owner", "repository", hashed.alias("found")), "scanned")
    each = rows.where(F.size("found") > 0).select("row_id", "owner", "repository", F.explode("found").alias("x")).select("row_id", "owner", "repository", "x.*")
    before = Window.partitionBy("row_id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(before)).where("fits")
    value_start = F.col("end") - F.col("value_length")
    start = F.when(_in(F.col("kind"), [n for n, k in enumerate(KINDS) if k.edged]), value_start).otherwise(F.col("end") - F.col("length"))
    placed = materialise(placed.select("row_id", "owner", "repository", "hash", "kind", start.alias("start"), "end", value_start.alias("value_start"), "maskable"), "candidates")
    # one row for each hash, owner and repository first: a value copied everywhere collapses before it moves
    held = placed.select("hash", "owner", "repository").distinct()
    frequency = held.groupBy("hash").agg(F.countDistinct("owner").alias("owners"), F.count(F.lit(1)).alias("repositories"))
    shared = materialise(frequency.where("owners > 1 or repositories > 1"), "ownership")
    owners, repositories = F.coalesce("owners", F.lit(1)), F.coalesce("repositories", F.lit(1))
    spans = placed.join(checked_broadcast(shared), "hash", "left").select(
        "row_id", "kind", "start", "end", "value_start", "maskable", owners.alias("owners"), repositories.alias("repositories"),
        ((owners <= most_owners) & (repositories <= most_repositories)).alias("live"),
    )
    return rows.select("row_id", "doc_id", "digest"), spans.where(_in(F.col("kind"), [n for n, k in enumerate(KINDS) if k.base]) | F.col("live"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` comma-joined from an array of structs with start, kind and end, in order."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


SPANS = "array<struct<start:bigint,kind:int,end:bigint,live:boolean,owners:bigint,repositories:bigint>>"


def find_secrets(docs: DataFrame, **options) -> DataFrame:
    """A row for each row of ``docs``: doc_id and spans, an array as SPANS, by start, then kind.

    Null text is empty text and has no spans; repeated rows give repeated rows; an empty table gives
    an empty result; further columns are ignored.
    """
    rows, spans = scan(docs, **options)
    packed = spans.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "owners", "repositories"))).alias("spans"))
    return rows.join(packed, "row_id", "left").select("doc_id", F.coalesce(F.col("spans").cast(SPANS), F.array().cast(SPANS)).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with the values of live keys masked, n_chars recounted, all columns kept.

    Masked are live candidates of a known key form, and live assigned values with a part that only
    keys have, so that names, paths, dates, addresses and versions in code and prose stay; runs of hexadecimal digits without such a name are commits and checksums as a rule and stay, as
    do widely copied examples. Spans that overlap are masked once. Rows without a mask stay as they
    are, null texts too; repeated rows stay repeated; an empty table stays empty.
    """
    columns = docs.columns
    rows, spans = scan(docs, **options)
    # spans depend on the text alone and verdicts on the value, so texts that are equal share them
    live = spans.where("live and maskable").join(rows.select("row_id", "digest"), "row_id").select("digest", "value_start", "end").distinct()
    order = Window.partitionBy("digest").orderBy("value_start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = live.withColumn("new", (reach.isNull() | (F.col("value_start") >= reach)).cast("int"))
    group = fresh.withColumn("g", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = group.groupBy("digest", "g").agg(F.min("value_start").alias("s"), F.max("end").alias("e"))
    packed = merged.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("__cut"))
    packed = materialise(packed.withColumnRenamed("digest", "__digest"), "cuts")
    text = text_of()
    joined = docs.withColumn("__own", F.unhex(F.sha2(text, 256))).join(checked_broadcast(packed, items="__cut"), F.col("__own") == F.col("__digest"), "left")
    n = F.size("__cut")
    pieces = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(
        text,
        F.when(i > 0, F.get(F.col("__cut"), i - 1)["e"]).otherwise(F.lit(0)).cast("int") + 1,
        (F.coalesce(F.get(F.col("__cut"), i)["s"], F.length(text)) - F.when(i > 0, F.get(F.col("__cut"), i - 1)["e"]).otherwise(F.lit(0))).cast("int"),
    ))
    masked = joined.withColumn("text", F.when(F.col("__cut").isNotNull(), F.array_join(pieces, mask)).otherwise(F.col("text")))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.col("__cut").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return masked.select(*columns)
