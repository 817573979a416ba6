"""Sanitisation of personal data guided by corpus co-occurrence, in DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers; their values are the protected
entities. A word of the same text can give an entity away even after masking. How strongly it does is
estimated from the corpus, with N documents, n(e) with the entity, n(t) with the term and n(e, t) with
both, anywhere in the text; the words of a document are those that no base span touches:

    IC(e) = log2(N / n(e))                      information that has to be protected
    PMI(e, t) = log2(n(e, t) * N / (n(e) * n(t)))  information about it that the term gives
    disclosure = PMI / IC                        1 if the term occurs with the entity only

A term with ``disclosure >= threshold`` that shares at least ``support`` documents with the entity is
generalised to its class in the documents that hold both (``[NAME]`` for capitalised words, ``[TERM]``
else) and removed if it holds a digit. Base spans become ``[EMAIL]`` and so on.

Entities and distinct words of each document are extracted once. Entities are counted first: one in fewer
than ``support`` documents has no such term, which leaves few documents whose entities are paired with
their words. Pairs are counted with partial aggregation, so an entity or term shared by a third of all
documents sends one row per task; the joins on them have sides that adaptive execution splits.

Defined results: a null text is empty and has no spans, and stays null when sanitised; every row counts as
a document; the terms of a text are its own, also if other texts have its id or none has an id; equal rows get
equal results; no rows give no rows. Columns of the input named like a result are replaced by it, the rest is passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import read_table, stored
from regchron.llm.spans import count_of, gaps, labelled, let, matches, ordered, rest, with_reach, written

# The four base kinds. Possessive repetitions and look-behinds keep matching linear on
# long runs and change no match: a run that fails from its first character fails from every later one.
# \G lets a match begin right after the one before.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words at either end of a stretch of text; the look-behind keeps long runs linear.
_CUT = rf"\A{WORD}+|(?<!{WORD[:-1]}){WORD}+\z"

THRESHOLD = 0.9
SUPPORT = 3
RESULTS = ("base", "terms", "spans", "clean")
_NO_SPANS = "cast(array() AS array<struct<start:int,rank:int,end:int,kind:string,value:string>>)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip_holds(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(False))


def _card_holds(value: Column) -> Column:
    def luhn(r: Column) -> Column:
        def weight(i: Column) -> Column:
            d = F.substring(r, i, 1).cast("int")
            return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

        return F.aggregate(F.sequence(F.lit(1), F.length(r)), F.lit(0), lambda s, i: s + weight(i)) % 10 == 0

    return let(F.reverse(_digits(value)), lambda r: F.when(F.length(r).between(12, 19), luhn(r)).otherwise(False))


def _phone_holds(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds by start, then kind."""
    each = (
        matches(text, EMAIL),
        F.filter(matches(text, IP), lambda s: _ip_holds(s.value)),
        F.filter(matches(text, CARD), lambda s: _card_holds(s.value)),
        F.filter(matches(text, PHONE), lambda s: _phone_holds(s.value)),
    )
    return ordered([labelled(spans, kind, rank) for rank, (kind, spans) in enumerate(zip(KINDS, each, strict=True))])


def _entity(span: Column) -> Column:
    value = F.when(span.kind.isin("card", "phone"), _digits(span.value)).otherwise(F.lower(span.value))
    return F.concat_ws(":", span.kind, value)


def _words(text: Column, base: Column) -> Column:
    """Distinct lower-case words that no base span touches."""
    # With one character of the spans (or a blank) on both sides, so that a word they cut stands at the end.
    padded = F.concat(F.lit(" "), text, F.lit(" "))

    def between(reached: Column) -> Column:
        stretches = F.concat(gaps(padded, reached, 1), F.array(rest(padded, reached)))
        return F.array_join(F.transform(stretches, lambda g: F.regexp_replace(g, _CUT, "")), " ")

    free = F.when(F.size(base) > 0, let(with_reach(base), between)).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(free), F.lit(WORD), F.lit(0)))


def disclosing_terms(documents: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(id, mark, terms): for documents (id, mark, text, base) the distinct terms that disclose one of their entities.

    ``mark`` tells texts of one id, or without one, apart.
    """
    text = F.coalesce("text", F.lit(""))
    held = stored(
        documents.select(
            "id",
            "mark",
            F.monotonically_increasing_id().alias("row"),
            F.array_distinct(F.transform("base", _entity)).alias("entities"),
            _words(text, F.col("base")).alias("words"),
        ),
        "held",
        "zstd",
    )
    every = held.count()
    own = held.select("row", F.explode("entities").alias("entity"))
    of_entity = own.groupBy("entity").agg(F.count("*").alias("n_e"))
    # Fewer documents than support cannot share as many with a term; entities seen in every document have nothing to protect.
    of_entity = stored(of_entity.where((F.col("n_e") >= support) & (F.col("n_e") < every)), "entities")
    of_term = held.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    paired = own.join(of_entity.select("entity"), "entity").groupBy("row").agg(F.collect_list("entity").alias("entities"))
    paired = stored(held.select("id", "mark", "row", "words").join(paired, "row").drop("row"), "paired", "zstd")
    pairs = paired.select("id", "mark", F.explode("entities").alias("entity"), "words")
    pairs = pairs.select("id", "mark", "entity", F.explode("words").alias("term"))
    together = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support)
    ic = F.log2(F.lit(every) / F.col("n_e"))
    pmi = F.log2(F.col("n_et") * F.lit(float(every)) / (F.col("n_e") * F.col("n_t")))
    strong = together.join(of_entity, "entity").join(of_term, "term").where(pmi >= threshold * ic).select("entity", "term")
    strong = stored(strong, "strong")
    found = pairs.join(strong, ["entity", "term"]).groupBy("id", "mark")
    return found.agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    free = F.filter(
        matches(text, WORD),
        lambda w: F.array_contains(terms, F.lower(w.value)) & ~F.exists(base, lambda b: (b.start < w.end) & (w.start < b.end)),
    )
    return F.when(F.size(terms) > 0, labelled(free, TERM, len(KINDS))).otherwise(F.expr(_NO_SPANS))


def _label(span: Column) -> Column:
    general = F.when(span.value.rlike("[0-9]"), "").when(span.value.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
    return F.when(span.kind == TERM, general).otherwise(F.concat(F.lit("["), F.upper(span.kind), F.lit("]")))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span replaced; of overlapping spans the first labels the whole stretch."""

    def joined(reached: Column) -> Column:
        labels = F.transform(reached, lambda x: F.when(x.span.start >= x.at, _label(x.span)).otherwise(""))
        both = F.zip_with(gaps(text, reached), labels, lambda g, label: F.concat(g, label))
        return F.concat(F.array_join(both, ""), rest(text, reached))

    return F.when(F.size(spans) > 0, let(with_reach(spans), joined)).otherwise(text)


def sanitise(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    support: int = SUPPORT,
) -> DataFrame:
    """The documents with ``base``, ``terms``, ``spans`` (base and term spans) and ``clean`` (sanitised text)."""
    kept = documents.drop(*[c for c in RESULTS if c not in (doc_id, text)])
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    mark = F.struct(F.xxhash64(own), F.xxhash64(own, F.lit(1)))
    found = kept.select(F.col(doc_id).alias("id"), mark.alias("mark"), own.alias("text"), base_spans(own).alias("base"))
    terms = disclosing_terms(found, threshold, support)
    terms = stored(terms.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), "terms"), "terms")
    same = kept[doc_id].eqNullSafe(terms["__id"]) & (mark == terms["__mark"])
    joined = kept.join(terms, same, "left").drop("__id", "__mark")
    joined = joined.withColumn("base", base_spans(own)).withColumn(
        "terms", F.coalesce("terms", F.expr("cast(array() AS array<string>)"))
    )
    spans = ordered([F.col("base"), _term_spans(own, F.col("terms"), F.col("base"))])
    return joined.withColumn("spans", spans).withColumn("clean", sanitised(F.col(text).cast("string"), F.col("spans")))


def op3(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    found = sanitise(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        count_of(F.col("spans"), TERM).alias("n_term"),
    )


def pipeline_stage(spark, documents: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with sanitised texts and their new length."""
    clean = sanitise(documents)
    changed = clean.withColumn("text", F.col("clean")).withColumn(
        "n_chars", F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("n_chars")).cast("bigint")
    )
    return changed.select("doc_id", "text", "lang", "source", "n_chars")
