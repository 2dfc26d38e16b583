"""Personal data: patterns for direct identifiers, and corpus statistics for terms that give them away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, small_or_shuffled
from fathomline.llm.components import components
from fathomline.llm.spans import described, digits_of, found, found_if

KINDS = ("email", "ip", "card", "phone")

#: The patterns of the contract with possessive repeats, and starts only where a run begins: the same matches, without
#: going back over long runs. A local part may also begin where the last match ended.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: A number of at most 255, with any leading zeros.
_OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"

#: A term: letters and digits, beginning with a letter.
TERM = r"\p{L}[\p{L}\p{N}]++"

#: Near copies of a context are proposed by so many bands of so many MinHash values: 0.9996 at a similarity of 0.6.
BANDS, BAND_HASHES = 32, 3


def _luhn(number: Column) -> Column:
    """Luhn sum of a digit string is a multiple of ten."""
    size = F.length(number)

    def weight(k: Column) -> Column:
        digit = F.substr(number, size - k + 1, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, digit).otherwise(F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit))

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda total, k: total + weight(k)) % 10 == 0


def identifiers(text: Column) -> dict[str, Column]:
    """Checked matches of each kind as arrays of (start, end, found)."""
    digit = text.rlike("[0-9]")
    is_ip = lambda s: F.forall(F.split(s["found"], r"\."), lambda part: part.rlike(_OCTET))
    count = lambda s: F.length(digits_of(s["found"]))
    return {
        "email": found_if(text.contains("@"), text, EMAIL),
        "ip": F.filter(found_if(text.rlike(r"[0-9]\.[0-9]"), text, IP), is_ip),
        "card": F.filter(found_if(digit, text, CARD),
                         lambda s: F.when(count(s).between(16, 19), _luhn(digits_of(s["found"]))).otherwise(F.lit(False))),
        "phone": F.filter(found_if(text.contains("+"), text, PHONE), lambda s: count(s).between(8, 15)),
    }


def _kinds(arrays: dict[str, Column]) -> Column:
    """One array of (kind, start, end, found), kinds in the given order."""
    def of_kind(kind: str):
        return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                  s["found"].alias("found"))
    return F.concat(*[F.transform(spans, of_kind(kind)) for kind, spans in arrays.items()])


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def near_copy_groups(passages: DataFrame, near_copy: float) -> DataFrame:
    """place, group for the contexts (place, entity, terms) that have a near copy among the contexts of their entity.

    Near copies share `near_copy` or more of all their distinct words; what near copies connect is one group. Contexts of an
    entity that agree in a band meet its smallest one and are compared with it word by word, so there are never pairs.
    """
    def band(t: Column) -> Column:
        return F.xxhash64("entity", t, F.transform(F.sequence(F.lit(0), F.lit(BAND_HASHES - 1)), lambda k: F.array_min(
            F.transform("terms", lambda term: F.xxhash64(t, k, term)))))

    bands = landed(passages.filter(F.size("terms") > 0).select("place", F.explode(
        F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)).alias("band")), "context-bands")
    first = bands.groupBy("band").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    met = bands.join(first, "band").filter("place <> first").select("place", "first").distinct()
    links = (met.join(passages.select("place", "terms"), "place")
             .join(passages.select(F.col("place").alias("first"), F.col("terms").alias("others")), "first")
             .filter(F.size(F.array_intersect("terms", "others")) >= near_copy * F.size(F.array_union("terms", "others"))))
    return components(links.select(F.col("place").alias("u"), F.col("first").alias("v"))).toDF("place", "group")


def disclosing_terms(rows: DataFrame, context_chars: int = 80, min_contexts: int = 3, near_copy: float = 0.6,
                     generalise: float = 0.7, remove: float = 0.9) -> DataFrame:
    """Terms that reveal a protected entity, with what to do about them: term, action, disclosure.

    `rows` (text, base) are all documents with their identifiers. The context of an identifier is the text within
    `context_chars` on either side, without cut words and without other identifiers. Over the whole corpus, with N documents, d(t) of them with
    term t, d(e) with entity e and d(t, e) with t in a context of e, the disclosure of t is PMI(t; e) / IC(e) =
    log(d(t, e) N / (d(t) d(e))) / log(N / d(e)): 1 where the term never occurs without the entity, 0 where they are
    independent. A term counts only with `min_contexts` different contexts of the entity, where copies and edited copies of
    one passage (see near_copy_groups) are one context: they say nothing. From `remove` on it is removed, from `generalise`
    on generalised; its strongest entity decides.

    All counts are sums combined in the tasks before the shuffle; contexts are de-duplicated by their digest first.
    """
    one = (rows.select("row", "text", F.explode("base").alias("entity"))
           .withColumn("before", F.regexp_replace(F.substr("text", F.greatest(F.lit(1), F.col("entity.start") - context_chars + 1),
                                                           F.least(F.col("entity.start"), F.lit(context_chars))), r"^\S*+", ""))
           .withColumn("after", F.regexp_replace(F.substr("text", F.col("entity.end") + 1, F.lit(context_chars)), r"\S*$", ""))
           .withColumn("context", F.regexp_replace(F.lower(F.concat_ws(" ", "before", "after")), rf"{EMAIL}|\S*[0-9@]\S*", " "))
           .select("row", F.concat_ws(":", "entity.kind", F.lower(
               F.when(F.col("entity.kind").isin("card", "phone"), digits_of(F.col("entity.found")))
               .otherwise(F.col("entity.found")))).alias("entity"), "context"))
    contexts = landed(one.select("row", "entity", F.xxhash64("entity", "context").alias("place"),
                                 _terms(F.col("context")).alias("terms")), "contexts")
    entity_docs = contexts.groupBy("entity", "row").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("d_e"))
    # Entities of fewer contexts can't have a term of enough: they leave before the terms are spread out.
    frequent = (contexts.groupBy("entity", "place").agg(F.lit(1).alias("one")).groupBy("entity")
                .agg(F.count("*").alias("contexts")).filter(F.col("contexts") >= min_contexts))
    contexts = landed(contexts.join(frequent, "entity", "left_semi"), "frequent-contexts")
    passages = landed(contexts.groupBy("place").agg(F.first("entity").alias("entity"), F.first("terms").alias("terms")), "passages")
    groups = landed(near_copy_groups(passages, near_copy), "near-contexts")
    spread = (contexts.join(small_or_shuffled(groups), "place", "left").withColumn("group", F.coalesce("group", "place"))
              .select("row", "entity", "group", F.explode("terms").alias("term")))
    support = (spread.groupBy("term", "entity", "group").agg(F.lit(1).alias("one")).groupBy("term", "entity")
               .agg(F.count("*").alias("groups")).filter(F.col("groups") >= min_contexts).select("term", "entity"))
    together = (spread.join(support, ["term", "entity"], "left_semi").groupBy("term", "entity", "row").agg(F.lit(1).alias("one"))
                .groupBy("term", "entity").agg(F.count("*").alias("d_te")))
    candidates = landed(together.join(entity_docs, "entity"), "candidate-terms")
    terms = landed(candidates.select("term").distinct(), "terms")
    documents = rows.count()
    with_term = (rows.select(F.explode(_terms(F.col("text"))).alias("term")).join(small_or_shuffled(terms), "term", "left_semi")
                 .groupBy("term").agg(F.count("*").alias("d_t")))
    score = F.when(F.col("d_e") < documents, F.log(F.col("d_te") * float(documents) / (F.col("d_t") * F.col("d_e")))
                   / F.log(float(documents) / F.col("d_e"))).otherwise(F.lit(0.0))
    scored = (candidates.join(with_term, "term").withColumn("disclosure", score).groupBy("term")
              .agg(F.max("disclosure").alias("disclosure")).filter(F.col("disclosure") >= generalise))
    return scored.withColumn("action", F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise"))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **thresholds) -> DataFrame:
    """One row per document: id, text, n_email, n_ip, n_card, n_phone, base, terms (arrays of kind, start, end, found).

    Identifiers are found by the patterns, on whole texts, as expressions of the scan. Terms that disclose a protected
    entity (see disclosing_terms) are marked with the kind `generalise` or `remove` at every place they occur as a whole
    word, in any document. Nulls are empty texts; a null id stays null; repeated rows each get their row and count as
    documents; an empty table gives no rows. Positions are code points, ends exclusive. Ties can't arise.

    Only DataFrame functions run. Rows are written once with their text and identifiers; contexts, counts and marks are
    joins and sums of that table, so frequent terms are combined in each task before they meet.
    """
    at = docs.columns.index
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.coalesce(F.col(f"c{at(text_column)}").cast("string"), F.lit(""))
    rows = plain.select(F.col(f"c{at(id_column)}").alias("id"), text.alias("text"))
    arrays = identifiers(F.col("text"))
    rows = rows.withColumns(arrays)
    rows = landed(rows.select(
        "id", "text", F.monotonically_increasing_id().alias("row"),
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        _kinds({kind: F.col(kind) for kind in KINDS}).alias("base")), "personal-data")
    terms = landed(disclosing_terms(rows, **thresholds), "disclosing")
    # What can't hold a term is out before the join: only documents with one go through it with their text.
    hits = landed(rows.select("row", F.explode(_terms(F.col("text"))).alias("term")).join(small_or_shuffled(terms), "term")
                  .groupBy("row").agg(F.sort_array(F.collect_set(F.struct("term", "action"))).alias("marks")), "term-hits")

    def marked(action: str) -> Column:
        words = F.transform(F.filter("marks", lambda m: m["action"] == action), lambda m: m["term"])
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{N}])"))
        return F.when(F.size(words) > 0, found(F.col("text"), pattern)).otherwise(F.array().cast(
            "array<struct<start:int,end:int,found:string>>"))

    terms_found = _kinds({"generalise": marked("generalise"), "remove": marked("remove")})
    free = F.filter(terms_found, lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return (rows.join(small_or_shuffled(hits), "row", "left")
            .withColumn("terms", F.when(F.col("marks").isNotNull(), free).otherwise(
                F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")))
            .select("id", "text", *[f"n_{kind}" for kind in KINDS], "base", "terms"))


def described_spans() -> tuple[Column, Column]:
    """Base spans, and all spans, as comma-joined kind:start:end."""
    return described(F.col("base")), described(F.concat("base", "terms"))


def sanitise(found_rows: DataFrame) -> DataFrame:
    """id, text with identifiers and generalised terms as [KIND] and removed terms left out; of overlapping spans the first."""
    spans = F.array_sort(F.transform(F.concat("base", "terms"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(so_far: Column, s: Column) -> Column:
        between = F.substr(F.col("text"), so_far["at"] + 1, s["start"] - so_far["at"])
        mask = F.when(s["kind"] == "remove", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.when(s["start"] < so_far["at"], so_far).otherwise(F.struct(
            s["end"].alias("at"), F.concat(so_far["text"], between, mask).alias("text")))

    clean = F.aggregate(spans, start, step, lambda so_far: F.concat(
        so_far["text"], F.substr(F.col("text"), so_far["at"] + 1, F.length("text"))))
    return found_rows.select("id", clean.alias("text"))


