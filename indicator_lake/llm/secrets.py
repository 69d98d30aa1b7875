"""Secret scans with an incremental blob ledger, in DataFrame functions alone.

A version is a text under a path at some time. Its blob is the SHA-256 of the text; the ledger holds, for each blob
and version of the rules, the spans found. Only blobs without an entry for the asked rules are scanned, once each,
and the findings are joined back to every path that holds the blob.

Spans are (start, end, kind) in code points, end exclusive. Positions come from splitting the text at the matches:
the lengths of the parts between them and of the matches add up to every start.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_lake.llm.tables import quoted, unused

# The patterns of the base kinds, in the order in which kinds at the same place are listed.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a shorter run after AKIA has no longer one within it
HEX = r"[0-9a-f]{32,}"  # the same spans as whole runs of 32 and more
KEY_BLOCK = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"  # not a base kind

BASE_KINDS = ("assign", "access", "hex")
RULES = (("assign", ASSIGN, 8), ("access", ACCESS, 0), ("hex", HEX, 0), ("keyblock", KEY_BLOCK, 0))
RULES_VERSION = "rules-1"

# What follows a private key's header: all up to its END line, else PEM fields and base64 lines. Repeats are possessive,
# so that a long key needs no deep stack.
KEY_END = r"(?s)\A.*?-----END [A-Z ]*PRIVATE KEY-----"
_GAP = r"(?:\s|\\[rn])++"
KEY_BODY = rf"\A(?:{_GAP}(?:Proc-Type|DEK-Info):[^\n]*+)*+(?:{_GAP}[A-Za-z0-9+/]{{16,}}+=*+)*+(?:{_GAP}[A-Za-z0-9+/]++=++)?"
MASK = "[SECRET]"

_SPAN = "array<struct<start: bigint, kind: int, end: bigint>>"


def _spans(text: Column, pattern: str, kind: int, least: int) -> Column:
    """Spans of the leftmost non-overlapping matches; with ``least``, those whose group 2 has so many characters."""
    rule = F.lit(pattern)
    found = F.regexp_extract_all(text, rule, F.lit(0))
    value = F.regexp_extract_all(text, rule, F.lit(2)) if least else found
    gaps = F.split(text, pattern, -1)
    steps = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("hit"), value.alias("value")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["value"]).alias("value")),
    )
    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["hit"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        fits = x["hit"].isNotNull() & (x["value"] >= least)
        return F.struct(end.alias("at"), F.when(fits, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def placed(piece: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.array().cast(_SPAN).alias("spans"))
        return F.aggregate(piece, start, step, lambda acc: acc["spans"])

    def size(piece: Column) -> Column:
        return F.aggregate(piece, F.lit(0).cast("bigint"), lambda n, x: n + x["gap"] + F.coalesce(x["hit"], F.lit(0)))

    # places are running sums: of whole pieces of the list first, then inside each piece, so that no long array is copied
    scanned = _bound(_pieces(steps), lambda p: F.flatten(F.zip_with(p, _sums_before(F.transform(p, size)), placed)))
    return F.when(text.rlike(pattern), scanned).otherwise(F.array().cast(_SPAN))


PIECE = 512  # items of a long list that are folded with a growing array


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value found once, however often and deep the body asks for it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pieces(items: Column) -> Column:
    """The list in pieces of ``PIECE`` items; an empty list is one empty piece."""

    def cut(x: Column) -> Column:
        count = F.greatest(F.ceil(F.size(x) / PIECE), F.lit(1))
        return F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), lambda i: F.slice(x, (i * PIECE + 1).cast("int"), PIECE))

    return _bound(items, cut)


def _sums_before(values: Column) -> Column:
    """For each value the sum of those before it; values are few."""
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(
        values, none, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")), lambda acc: acc["all"]
    )


def _most_before(values: Column, first: Column) -> Column:
    """For each value the largest of those before it and ``first``; values are few."""
    none = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(
        values,
        none,
        lambda acc, x: F.struct(F.greatest(acc["at"], x).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")),
        lambda acc: acc["all"],
    )


def scan(blobs: DataFrame) -> DataFrame:
    """(blob, rules_version, spans) for blobs (blob, text); spans by start, then kind as listed."""
    every = F.concat(*(_spans(F.col("text"), p, i, least) for i, (_, p, least) in enumerate(RULES)))
    return blobs.select("blob", F.lit(RULES_VERSION).alias("rules_version"), F.array_sort(every).alias("spans"))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def unseen(versions: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The distinct blobs (blob, text) of versions (blob, text) without a ledger entry for the present rules."""
    if ledger is not None:
        known = ledger.where(F.col("rules_version") == RULES_VERSION).select("blob").distinct()
        versions = versions.join(known, "blob", "left_anti")
    return versions.select("blob", "text").dropDuplicates(["blob"])


def new_entries(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows (blob, rules_version, spans) to append for the texts of docs."""
    versions = docs.select(blob_of(F.col("text")).alias("blob"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return scan(unseen(versions, ledger))


def record(docs: DataFrame, path: str) -> DataFrame:
    """The ledger stored at ``path`` after the blobs of docs that it did not know were scanned and added.

    Two runs at once may both add a blob; its entries are equal, and one of them counts.
    """
    spark = docs.sparkSession
    new = new_entries(docs, _stored_ledger(spark, path))
    new.write.mode("append").parquet(path)
    return spark.read.schema(new.schema).parquet(path).dropDuplicates(["blob", "rules_version"])


def _stored_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _hits(docs: DataFrame, ledger: DataFrame | None, complete: bool) -> DataFrame:
    """(blob, spans) of the blobs with spans; a blob without any need not travel back."""
    known = None if ledger is None else ledger.where(F.col("rules_version") == RULES_VERSION).select("blob", "rules_version", "spans")
    if known is None or not complete:
        entries = new_entries(docs, ledger)
        known = entries if known is None else entries.union(known)
    return known.where(F.size("spans") > 0).select("blob", "spans")


def findings(docs: DataFrame, ledger: DataFrame | None = None, complete: bool = False) -> DataFrame:
    """docs' rows (doc_id, blob, spans): each path with the spans of its blob, scanned now or found in the ledger.

    A ``complete`` ledger (what ``record`` returns for docs) has them all. Null texts are empty; each row of docs
    gives one row, repeated ones too; other columns are ignored.
    """
    paths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob_of(F.col("text")).alias("blob"))
    return paths.join(_hits(docs, ledger, complete), "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(_SPAN)).alias("spans")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(name) for name, _, _ in RULES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def _only(kind: int):
    return lambda k: F.when(k == kind, k)


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of findings."""
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        F.size(F.array_compact(F.transform(kinds, _only(i)))).cast("long").alias(f"n_{name}") for i, name in enumerate(BASE_KINDS)
    ]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), "blob"
    )


def whole_keys(text: Column, spans: Column) -> Column:
    """Spans with those of private key headers drawn out over the key itself."""
    header = [name for name, _, _ in RULES].index("keyblock")

    def drawn(s: Column) -> Column:
        rest = F.substring_index(F.substr(text, (s["end"] + 1).cast("int")), "-----BEGIN ", 1)
        closed = F.length(F.regexp_extract(rest, KEY_END, 0))
        more = F.when(closed > 0, closed).otherwise(F.length(F.regexp_extract(rest, KEY_BODY, 0)))
        end = F.when(s["kind"] == header, s["end"] + more).otherwise(s["end"])
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), end.alias("end"))

    return F.transform(spans, drawn)


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones together and private keys whole, replaced by a mark."""
    zero = F.lit(0).cast("bigint")

    def kept(piece: Column, at: Column) -> Column:
        # one cut of the text for the piece, and short ones inside it
        stop = F.element_at(piece, -1)["start"]
        cut = F.substr(text, (at + 1).cast("int"), F.greatest(stop - at, zero).cast("int"))

        def inside(part: Column) -> Column:
            before = _most_before(F.transform(piece, lambda s: s["end"]), at)
            apart = F.filter(F.arrays_zip(piece.alias("s"), before.alias("b")), lambda x: x["s"]["start"] >= x["b"])
            return F.transform(apart, lambda x: F.substr(part, (x["b"] - at + 1).cast("int"), (x["s"]["start"] - x["b"]).cast("int")))

        return _bound(cut, inside)

    def joined(pieces: Column) -> Column:
        ends = F.transform(pieces, lambda x: F.aggregate(x, zero, lambda n, y: F.greatest(n, y["end"])))

        def with_ends(tops: Column) -> Column:
            last = F.array_max(tops)
            tail = F.substr(text, (last + 1).cast("int"), F.length(text))
            # spans come by start: what is masked before a span ends at the largest end before it
            return F.array_join(F.concat(F.flatten(F.zip_with(pieces, _most_before(tops, zero), kept)), F.array(tail)), MASK)

        return _bound(ends, with_ends)

    return F.when(F.size(spans) > 0, _bound(_pieces(whole_keys(text, spans)), joined)).otherwise(text)


def without_secrets(docs: DataFrame, ledger: DataFrame | None = None, complete: bool = False) -> DataFrame:
    """docs with the secrets of their texts masked and n_chars, where there is one, brought up to date.

    No row goes; a null text stays null; all other columns stay as they are.
    """
    own = {c: unused(docs, c) for c in ("blob", "spans", "clean")}
    hits = _hits(docs, ledger, complete).select(F.col("blob").alias(own["blob"]), F.col("spans").alias(own["spans"]))
    spans = F.col(own["spans"])
    both = docs.withColumn(own["blob"], blob_of(F.col("text"))).join(hits, own["blob"], "left")
    both = both.withColumn(own["clean"], F.when(spans.isNull(), F.col("text")).otherwise(masked(F.col("text"), spans)))
    changed = {"text": F.col(own["clean"])}
    if "n_chars" in docs.columns:
        size = F.when(spans.isNull(), F.col("n_chars")).otherwise(F.length(own["clean"]))
        changed["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return both.select(*(changed[c].alias(c) if c in changed else F.col(quoted(c)) for c in docs.columns))
