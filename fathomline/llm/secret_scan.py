"""Secrets: patterns for strong ones, and weak parts that are reported only where complementary parts stand together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import landed, small_or_shuffled
from fathomline.llm.spans import described, found_if

KINDS = ("assign", "access", "hex")
WEAK = ("identifier", "secret", "endpoint")

ASSIGN = (r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)")
#: Maximal runs that are long enough; a shorter run holds no match, and none begins inside a run.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"

#: Weak parts. A name or key id after a label, a mixed random-looking word, and an address.
IDENTIFIER = (r"(?i)(?<![a-z0-9])(?:client_?id|access_?(?:key_?)?id|key_?id|account|user(?:_?name|_?id)?|login)[\"']?+"
              r"\x20*+[:=]\x20*+[\"']?+[a-z0-9_.@-]{3,}+|(?<![A-Za-z0-9])(?-i:A(?:KI|SI|GP|ID|RO|NP)A[A-Z0-9]{4,}+)")
SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}+"
ENDPOINT = r"(?i)(?<![a-z0-9])(?:https?|ftp|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]++"


def strong(text: Column) -> dict[str, Column]:
    """Checked matches of each base kind as arrays of (start, end, found)."""
    value = F.lit(r"(?s)^(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+")
    long_enough = lambda s: F.length(F.regexp_replace(s["found"], value, F.lit(""))) >= 6
    return {
        "assign": F.filter(found_if(text.rlike("[:=]"), text, ASSIGN), long_enough),
        "access": found_if(text.contains("AKIA"), text, ACCESS),
        "hex": found_if(text.rlike(HEX), text, HEX),
    }


def weak(text: Column) -> dict[str, Column]:
    """Weak parts as arrays of (start, end, found). A weak secret has a digit, a lower-case and an upper-case letter."""
    mixed = lambda s: (s["found"].rlike("[0-9]") & s["found"].rlike("[a-z]") & s["found"].rlike("[A-Z]"))
    return {
        "identifier": found_if(text.rlike(r"[:=]|A(?:KI|SI|GP|ID|RO|NP)A"), text, IDENTIFIER),
        "secret": F.filter(found_if(text.rlike(r"[A-Za-z0-9+/_-]{16}"), text, SECRET), mixed),
        "endpoint": found_if(text.contains("://"), text, ENDPOINT),
    }


def _in_order(arrays: dict[str, Column], kinds: tuple[str, ...]) -> Column:
    """One array of (start, order, end, kind), by start, then kind as listed."""
    def of_kind(kind: str):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(kinds.index(kind)).alias("order"),
                                  s["end"].alias("end"), F.lit(kind).alias("kind"))
    return F.array_sort(F.concat(*[F.transform(spans, of_kind(kind)) for kind, spans in arrays.items()]))


def link_parts(parts: DataFrame, scope_chars: int = 200) -> DataFrame:
    """Weak parts with their complement in scope: the rows of `parts` (row, role, weak, start, end) that are reported.

    Roles are identifier, secret and endpoint. An identifier is reported with a secret in scope, a secret with an
    identifier, an endpoint with both. Two parts are in scope if at most `scope_chars` lie between them. It is an
    interval join by a sweep in order of position: the farthest end before and the nearest start after, of each role,
    decide, so the rows never multiply, however many parts a document has.
    """
    # Parts that begin together are before and after each other: both frames include peers, and roles differ.
    upto = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.partitionBy("row").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)

    def near(role: str) -> Column:
        of_role = F.col("role") == role
        last = F.max(F.when(of_role, F.col("end"))).over(upto)
        following = F.min(F.when(of_role, F.col("start"))).over(onward)
        return (F.coalesce(F.col("start") - last <= scope_chars, F.lit(False))
                | F.coalesce(following - F.col("end") <= scope_chars, F.lit(False)))

    role = F.col("role")
    linked = (F.when(role == "identifier", near("secret")).when(role == "secret", near("identifier"))
              .otherwise(near("identifier") & near("secret")))
    return parts.withColumn("linked", linked).filter("weak and linked").drop("linked")


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scope_chars: int = 200) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base, linked (arrays of start, order, end, kind).

    Base secrets are found by the patterns, on whole texts, as expressions of the scan. Weak parts that overlap no base
    secret are reported only if linked (see link_parts); there a base access key counts as identifier and the other base
    kinds as secrets. Nulls are empty texts, a null id stays null, repeated rows each get their row, an empty table
    gives no rows. Positions are code points, ends exclusive; spans that begin together are ordered by kind as listed.

    Only DataFrame functions run. One scan writes a narrow table without texts; documents with weak parts alone take
    part in the sweep, one document's parts in one task.
    """
    at = docs.columns.index
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.coalesce(F.col(f"c{at(text_column)}").cast("string"), F.lit(""))
    rows = plain.select(F.col(f"c{at(id_column)}").alias("id"), text.alias("text"))
    rows = rows.withColumns(strong(F.col("text")) | weak(F.col("text")))
    rows = rows.select(
        "id", F.monotonically_increasing_id().alias("row"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        _in_order({k: F.col(k) for k in KINDS}, KINDS).alias("base"),
        _in_order({k: F.col(k) for k in WEAK}, KINDS + WEAK).alias("parts"))
    rows = landed(rows.withColumn("parts", F.filter("parts", lambda p: ~F.exists(
        "base", lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])))), "secrets")
    role = F.when(F.col("part.kind") == "access", "identifier").when(F.col("part.kind").isin("assign", "hex"), "secret")
    parts = (rows.filter(F.size("parts") > 0).select("row", F.explode(F.concat("base", "parts")).alias("part"))
             .select("row", "part", "part.start", "part.end", F.col("part.kind").isin(*WEAK).alias("weak"),
                     F.coalesce(role, F.col("part.kind")).alias("role")))
    linked = landed(link_parts(parts, scope_chars).groupBy("row").agg(F.array_sort(F.collect_list("part")).alias("linked")),
                    "linked-parts")
    return (rows.join(small_or_shuffled(linked), "row", "left")
            .withColumn("linked", F.coalesce("linked", F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")))
            .select("id", *[f"n_{k}" for k in KINDS], "base", "linked"))


def described_spans() -> tuple[Column, Column]:
    """Base spans, and all spans, as comma-joined kind:start:end in order of start."""
    return described(F.col("base")), described(F.array_sort(F.concat("base", "linked")))
