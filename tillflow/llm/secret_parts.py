"""Secrets in texts, and credentials whose parts lie apart, with built-in expressions only.

Positions of all matches of a pattern come from one replacement: every match is
put between two control characters, the text is cut there, and the running sum
of the pieces' lengths gives starts and ends.  Only the lengths leave the scan.

Strong spans (assignments, access identifiers, hex runs) are always reported.
Weak candidates are parts of a credential that mean little alone: a login or
client identifier, a token of mixed characters or a short assigned password, an
endpoint.  Parts that follow each other within ``REACH`` code points, without a
blank line between, form a scope.  Scopes are intervals of the text that never
overlap, so instead of an interval join, running window sums over the parts of
a row number the scopes, and a part meets its scope's totals and never the other
parts one by one.  A weak
part is reported only if its scope holds all three: an identifier, a secret and
an endpoint, each strong or weak.  A weak part that overlaps a strong span counts
for its scope and is not reported itself.

One shuffle moves the spans (a few numbers each) to their row's task; its
largest unit is the spans of one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest gap between neighbouring parts of a scope, in code points.
REACH = 200

# The strong patterns, the same for every user of the report.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"()()AKIA[A-Z0-9]{14,}"
HEX = r"()()[0-9a-f]{16,}"
STRONG = ("assign", "access", "hex")

# Patterns of weak parts; group 2 is what counts.
IDENTIFIER = r"""(?i)()(?<![A-Za-z0-9_])(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]+)"""
PHRASE = r"""(?i)()(?<![A-Za-z0-9_])(?:password|passwd|pwd|pass)["']?\x20*[:=]\x20*["']?([^\x00-\x20"',;<>]+)"""
MIXED = r"()(?<![A-Za-z0-9+/_-])((?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{20,})"
ENDPOINT = r"""(?i)()(?<![A-Za-z0-9_])((?:https?|wss?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}:[0-9]{2,5}(?![0-9]))"""
BLANK_LINE = r"()()\n[\x20\x09]*\r?\n"

#: (kind, part, pattern, fewest characters of group 2); the order of kinds is that of the report.
KINDS = [
    ("assign", "secret", ASSIGN, 12),
    ("access", "identifier", ACCESS, 0),
    ("hex", "secret", HEX, 0),
    ("identifier", "identifier", IDENTIFIER, 1),
    ("phrase", "secret", PHRASE, 1),
    ("mixed", "secret", MIXED, 20),
    ("endpoint", "endpoint", ENDPOINT, 1),
    ("blank", "blank", BLANK_LINE, 0),
]
OPEN, INNER = "\x01", "\x02"


def cuts(text: Column, number: int, pattern: str) -> Column:
    """Per piece of the text between and within matches: kind, place, code points, of group 2; empty without a match."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{OPEN}$0{INNER}$2{OPEN}"))
    pieces = F.transform(
        F.split(marked, OPEN, -1),
        lambda piece, place: F.struct(
            F.lit(number).alias("kind"),
            place.alias("place"),
            F.char_length(F.substring_index(piece, INNER, 1)).alias("long"),
            F.when(piece.contains(INNER), F.char_length(F.substring_index(piece, INNER, -1))).alias("inner"),
        ),
    )
    return F.when(F.size(pieces) > 1, pieces).otherwise(F.slice(pieces, 1, 0))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: key and found, an array of (start, kind, end, strong) in report order.

    Starts and ends count code points; ends are exclusive.  Null and empty
    texts have no spans.  Repeated keys stay apart; other columns are not read.
    """
    # The piece without a kind stands for the row itself, so that rows without spans stay.
    kinds = F.array(*[F.lit(k) for k, *_ in KINDS])
    parts = F.array(*[F.lit(p) for _, p, *_ in KINDS])
    fewest = F.array(*[F.lit(n) for *_, n in KINDS])
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), OPEN + INNER, "\x03\x03")
    rows = docs.select(F.col(key).alias("key"), clean.alias("clean")).withColumn("row", F.monotonically_increasing_id())
    none = F.lit(None).cast("int")
    itself = F.array(F.struct(none.alias("kind"), F.lit(0).alias("place"), F.lit(0).alias("long"), none.alias("inner")))
    pieces = F.concat(itself, *[cuts(F.col("clean"), i, k[2]) for i, k in enumerate(KINDS)])
    lengths = rows.select("key", "row", F.explode(pieces).alias("p")).select("key", "row", "p.*").repartition("row")

    in_kind = Window.partitionBy("row", "kind").orderBy("place")
    matches = (
        lengths.withColumn("end", F.sum("long").over(in_kind.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("kind").isNull() | ((F.col("place") % 2 == 1) & (F.col("inner") >= F.get(fewest, F.col("kind")))))
        .select("key", "row", "kind", (F.col("end") - F.col("long")).alias("start"), "end")
        .withColumns({"strong": F.col("kind") < len(STRONG), "part": F.get(parts, F.col("kind"))})
    )

    row, upto, after = Window.partitionBy("row").orderBy("start", "kind"), (Window.unboundedPreceding, 0), (0, Window.unboundedFollowing)
    strong = F.col("strong")
    apart = (
        matches.withColumns({
            "covered": F.max(F.when(strong, F.col("end"))).over(row.rowsBetween(*upto)),
            "next": F.min(F.when(strong, F.col("start"))).over(row.rowsBetween(*after)),
        })
        .withColumn("free", (F.coalesce("covered", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))
        .withColumn("reached", F.max(F.when(F.col("part") != "blank", F.col("end"))).over(row.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("breaks", ((F.col("part") == "blank") | (F.col("start") - F.col("reached") > reach)).cast("int"))
        .withColumn("scope", F.sum(F.coalesce("breaks", F.lit(0))).over(row.rowsBetween(*upto)))
    )
    scope = Window.partitionBy("row", "scope")
    held = [F.max((F.col("part") == p).cast("int")).over(scope) == 1 for p in ("identifier", "secret", "endpoint")]
    linked = apart.withColumn("linked", held[0] & held[1] & held[2]).where(F.col("kind").isNull() | strong | (F.col("linked") & F.col("free") & (F.col("part") != "blank")))
    listed = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end", "strong"))
    found = linked.groupBy("row").agg(F.first("key").alias("key"), F.array_sort(F.collect_list(listed)).alias("found"))
    named = F.transform("found", lambda x: F.struct(x["start"].alias("start"), F.get(kinds, x["kind"]).alias("kind"), x["end"].alias("end"), x["strong"].alias("strong")))
    return found.select(F.col("key").alias(key), named.alias("found"))


def listing(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
