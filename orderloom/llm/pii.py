"""Personal data by pattern, and the terms that give it away by their company.

Base findings are e-mail and IP addresses, card and telephone numbers. A value found is a protected
entity. Masking it is of little use where another word still tells who is meant, so the corpus is asked
how much a term says about an entity: over distinct texts, with n(e) texts that hold the entity, n(t) that
hold the term anywhere and n(t, e) where the term stands within `REACH` characters of the entity,

    pointwise mutual information  log(N n(t,e) / (n(t) n(e)))   over   information content  log(N / n(e))

is the share of the entity's information that the term discloses. From `DISCLOSED` on, with at least
`SUPPORT` texts, the term is generalised to a placeholder in every text that holds the entity; where
the term occurs with the entity only, it is removed. Copies of a text count once, or each word of a text
copied often would seem to belong to the addresses in it.

Pairs are bound by the neighbourhoods of entities, so a text with many entities makes as many pairs as its
length allows, not all terms times all entities. Term counts cover all texts: a bitmap of fixed size
keeps the words of interest in the row that holds the text, and the join with the terms verifies them.

Matches of a pattern are found by marking them in the text and splitting at the marks, in one pass. The
patterns are written with possessive repeats and without second starts inside a run, so that matching takes
time linear in the text; they match what the plain forms in `KINDS` match. The offset of a match is a sum over the parts
before it, so a text with very many matches takes time that grows with their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bitmaps
from orderloom.llm.common import SEPARATORS, lower_ascii, picked, small_enough, words_of, written

# kind: plain pattern (fixed values), the same pattern without needless search, what a text must hold.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = {
    "email": (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        "@",
    ),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+", "."),
    # Shorter runs than twelve digits are no card, so they need no mark.
    "card": (r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9]){11,}+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
TERM = "term"
MARK, INSTEAD = "\x01", "\x02"
SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"

REACH = 80
SUPPORT = 3
DISCLOSED = 0.8
SHORTEST_TERM = 4
BROADCAST_BYTES = 32 * 1024 * 1024


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _parts(text: Column, kind: str) -> Column:
    """The text split around matches: every second part, from the second on, is a match."""
    _, pattern, needed = KINDS[kind]
    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    return F.when(F.contains(text, F.lit(needed)), marked) if needed else marked


def _spans(parts: Column, kind: str, rank: int) -> Column:
    places = F.filter(
        F.sequence(F.lit(0), F.coalesce(F.size(parts), F.lit(1)) - 1),
        lambda k: (k % 2 == 1) & _valid(kind, parts[k]),
    )
    found = F.transform(
        places,
        lambda k: F.struct(
            F.aggregate(F.slice(parts, 1, k), F.lit(0), lambda n, part: n + F.length(part)).alias("start"),
            parts[k].alias("value"),
        ),
    )
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (x["start"] + F.length(x["value"])).alias("end"),
            F.lit(kind).alias("kind"),
            x["value"].alias("value"),
        ),
    )


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, text, spans: validated matches by start, then kind; offsets in code points."""
    marked = picked(docs, doc_id=id_col, text=text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("marked", F.translate("text", MARK, INSTEAD))
    parts = marked.select(
        "row", "doc_id", "text", *[_parts(F.col("marked"), kind).alias(f"parts_{kind}") for kind in KINDS]
    )
    spans = [
        F.when(F.col(f"parts_{kind}").isNotNull(), _spans(F.col(f"parts_{kind}"), kind, rank)).otherwise(
            F.array().cast(f"array<{SPAN}>")
        )
        for rank, kind in enumerate(KINDS)
    ]
    return parts.select("row", "doc_id", "text", F.array_sort(F.concat(*spans)).alias("spans"))


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], lower_ascii(span["value"]))


def _near(text: Column, span: Column) -> Column:
    """The words within reach of a span. A word that is cut off by the reach is left out."""
    before = F.substring(
        text, F.greatest(span["start"] - REACH + 1, F.lit(1)), F.least(span["start"], F.lit(REACH))
    )
    after = F.substring(text, span["end"] + 1, F.lit(REACH))
    whole_before = F.when(span["start"] > REACH, F.regexp_replace(before, r"^[0-9A-Za-z\x{80}-\x{10FFFF}]+", ""))
    whole_after = F.when(F.length(after) == REACH, F.regexp_replace(after, r"[0-9A-Za-z\x{80}-\x{10FFFF}]+$", ""))
    return F.filter(
        F.array_distinct(
            F.concat(words_of(F.coalesce(whole_before, before)), words_of(F.coalesce(whole_after, after)))
        ),
        lambda w: F.length(w) >= SHORTEST_TERM,
    )


def neighbourhoods(found: DataFrame) -> DataFrame:
    """entity, text_key, terms: one row per entity found in a text."""
    beside = F.transform(
        "spans", lambda s: F.struct(_entity(s).alias("entity"), _near(F.col("text"), s).alias("terms"))
    )
    return found.where(F.size("spans") > 0).select("text_key", F.inline(beside))


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """entity, term, disclosure: the terms over the threshold, from the counts of all distinct texts."""
    texts = F.lit(float(found.select("text_key").distinct().count()))
    near = written(neighbourhoods(found), "near")
    entities = near.select("entity", "text_key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    beside = near.select("text_key", F.explode("terms").alias("term")).distinct()
    beside = beside.groupBy("term").agg(F.count(F.lit(1)).alias("n_beside"))
    # A term is in as many texts at least as it is beside any entity, which settles common words without counting
    # them everywhere: more texts only lower the disclosure.
    pairs = written(
        near.select("entity", "text_key", F.explode("terms").alias("term"))
        .distinct()
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_te"))
        .where(F.col("n_te") >= SUPPORT)
        .join(entities.where(F.col("n_e") >= SUPPORT), "entity")
        .join(beside, "term")
        .where(_disclosure(texts, "n_beside") >= DISCLOSED)
        .select("entity", "term", "n_e", "n_te"),
        "pairs",
    )
    terms = written(pairs.select("term").distinct(), "terms")
    if terms.isEmpty():
        return pairs.select("entity", "term", F.lit(1.0).alias("disclosure"))
    table = bitmaps.constant(bitmaps.gathered(terms, bitmaps.bit_of(F.col("term"))))
    seen = picked(docs, text=text_col).select(
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_key"),
        F.array_distinct(
            F.filter(words_of(F.col("text")), lambda w: bitmaps.holds(table, bitmaps.bit_of(w)))
        ).alias("words"),
    )
    counts = (
        seen.select("text_key", F.explode("words").alias("term"))
        .join(small_enough(terms, F.length("term") + 64, BROADCAST_BYTES), "term")
        .distinct()
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_t"))
    )
    return (
        pairs.join(counts, "term")
        .withColumn("disclosure", _disclosure(texts, "n_t"))
        .where(F.col("disclosure") >= DISCLOSED)
        .select("entity", "term", "disclosure")
    )


def _disclosure(texts: Column, n_term: str) -> Column:
    """The share of an entity's information in a term that occurs in `n_term` of the texts; null for an entity that
    every text holds, which has no information."""
    content = F.log(texts / F.col("n_e"))
    shared = F.log(texts * F.col("n_te") / (F.col(n_term) * F.col("n_e")))
    return F.when(content > 0, shared / content)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is worked out once. Written out where a lambda function uses it, it would be worked
    out for every element."""
    return F.transform(F.array(value), use)[0]


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Where the terms stand in the text, but for what a base span covers already."""

    def found(words: Column, between: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: F.array_contains(terms, lower_ascii(words[i])),
        )
        return F.transform(
            places,
            lambda i: F.struct(
                (
                    F.aggregate(F.slice(between, 1, i + 1), F.lit(0), lambda n, x: n + F.length(x))
                    + F.aggregate(F.slice(words, 1, i), F.lit(0), lambda n, x: n + F.length(x))
                ).alias("start"),
                words[i].alias("value"),
            ),
        )

    split = F.struct(
        F.filter(F.split(text, SEPARATORS), lambda w: w != "").alias("words"),
        F.split(text, r"[0-9A-Za-z\x{80}-\x{10FFFF}]+", -1).alias("between"),
    )
    starts = _with(split, lambda x: found(x["words"], x["between"]))
    spans = F.transform(
        starts,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(len(KINDS)).alias("rank"),
            (x["start"] + F.length(x["value"])).alias("end"),
            F.lit(TERM).alias("kind"),
            x["value"].alias("value"),
        ),
    )
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def _redacted(text: Column, spans: Column, removed: Column) -> Column:
    """The text with a placeholder for each span; of spans that overlap, the first names the place."""
    state = F.struct(F.lit(0).alias("upto"), F.lit("").alias("out"))
    filled = F.aggregate(
        spans,
        state,
        lambda acc, s: F.when(
            s["start"] >= acc["upto"],
            F.struct(
                s["end"].alias("upto"),
                F.concat(
                    acc["out"],
                    F.substring(text, acc["upto"] + 1, s["start"] - acc["upto"]),
                    F.when(F.array_contains(removed, lower_ascii(s["value"])), F.lit("")).otherwise(
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
                    ),
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), acc["out"].alias("out"))),
    )
    return F.concat(filled["out"], F.substring(text, filled["upto"] + 1, F.length(text)))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base, spans, redacted.

    `base` and `spans` are arrays of (start, rank, end, kind, value), by start and then kind; `spans` has the
    terms as well. `redacted` is the sanitised text, null where nothing was found and the text stands as it is.
    A null text counts as empty. Each row is judged by its own text and the counts of all texts, so repeated
    rows and null ids get equal results; an empty table gives an empty result.
    """
    found = base_spans(docs, id_col, text_col)
    nothing = F.size("spans") == 0
    found = written(
        found.select(
            "row",
            "doc_id",
            F.sha2("text", 256).alias("text_key"),
            F.when(~nothing, F.col("text")).alias("text"),
            "spans",
        ),
        "entities",
    )
    disclosing = written(disclosing_terms(docs, found, text_col), "disclosing")
    by_entity = disclosing.groupBy("entity").agg(
        F.collect_set("term").alias("terms"),
        F.collect_set(F.when(F.col("disclosure") >= 1 - 1e-9, F.col("term"))).alias("removed"),
    )
    with_spans = found.where(F.size("spans") > 0)
    given_away = (
        with_spans.select("row", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity"))
        .join(by_entity, "entity")
        .groupBy("row")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"),
            F.array_distinct(F.flatten(F.collect_list("removed"))).alias("removed"),
        )
    )
    none = F.array().cast("array<string>")
    masked = (
        with_spans.join(given_away, "row", "left")
        .withColumn("terms", F.coalesce("terms", none))
        .withColumn("removed", F.coalesce("removed", none))
        .withColumn(
            "all",
            F.when(F.size("terms") == 0, F.col("spans")).otherwise(
                F.array_sort(F.concat("spans", _term_spans(F.col("text"), F.col("terms"), F.col("spans"))))
            ),
        )
        .select(
            "doc_id",
            F.col("spans").alias("base"),
            F.col("all").alias("spans"),
            _redacted(F.col("text"), F.col("all"), F.col("removed")).alias("redacted"),
        )
    )
    clean = found.where(F.size("spans") == 0).select(
        "doc_id", F.col("spans").alias("base"), "spans", F.lit(None).cast("string").alias("redacted")
    )
    return masked.unionByName(clean)


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
