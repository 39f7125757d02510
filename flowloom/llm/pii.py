"""Personal data: base patterns, and terms that disclose the entities found, by corpus co-occurrence.

Four patterns give base spans, which always stay. Their values (an address, a number) are the protected
entities. A term discloses an entity by as much as seeing it tells about it: the point-wise mutual
information of term and entity over the corpus, divided by the information content of the entity, is 1
where the term occurs with that entity only. A term counts as occurring with an entity where it stands
within ``WINDOW`` tokens of it, and a pair is evidence only in several different contexts, so copies of
one document or passage prove nothing. Terms that disclose more than a threshold are generalised, those
above a second one removed, wherever they occur.

All of it is SQL functions. The patterns are written so that they match in linear time and without
recursion: possessive, and not started again inside of what has already failed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.plans.bounded import small_table

from .merkle import lower_ascii
from .store import saved

#: Kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for any match that counts.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
CARD_DIGITS, PHONE_DIGITS, MOST_PART = (13, 19), (9, 15), 255

#: A token is an e-mail address or, between these, a run with the shape of another entity or a term: a run of
#: ASCII letters, digits and non-ASCII characters.
LEAST_TERM = 3
TERM = rf"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{{{LEAST_TERM},}}+"
SHAPES = "|".join([PATTERNS["phone"], PATTERNS["ip"], r"[0-9](?:[\x20-]?[0-9]){12,}+"])
TOKEN = f"({SHAPES}|{TERM})"
IS_TERM = rf"^(?![0-9]{{13,}}$){TERM}$"

#: Tokens on either side of an entity; contexts in which a pair must occur; shares of an entity's information.
WINDOW, LEAST_CONTEXTS, GENERALISE, REMOVE = 8, 3, 0.9, 0.97

SPAN = "struct<order: int, start: long, end: long>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each element the fold of those before it, from 0, in two levels: n to the power 1.5 steps for n values."""

    def fold(part: Column, start: Column) -> Column:
        return F.aggregate(part, start, step)

    def folded(v: Column) -> Column:
        n = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))

        def two_levels(c: Column) -> Column:
            zero = F.lit(0).cast("long")
            groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / c).cast("int")), lambda g: fold(F.slice(v, g * c + 1, c), zero))
            heads = let(groups, lambda g: F.transform(g, lambda x, i: fold(F.slice(g, 1, i), zero)))
            return let(heads, lambda h: F.transform(v, lambda x, i: fold(F.slice(v, i - i % c + 1, i % c), F.element_at(h, ((i - i % c) / c).cast("int") + 1))))

        return F.when(F.size(v) == 0, v).otherwise(let(n, two_levels))

    return let(values, folded)


def located(text: Column, pattern: str) -> Column:
    """All matches, leftmost and not overlapping: ``value``, ``start``, ``end`` in code points."""

    def place(x: Column) -> Column:
        gaps = F.transform(x["gaps"], lambda g: F.length(g).cast("long"))
        steps = F.zip_with(F.slice(gaps, 1, F.size(x["values"])), x["values"], lambda g, v: F.struct(g.alias("gap"), (g + F.length(v)).alias("both"), v.alias("value")))
        return let(steps, lambda s: F.zip_with(s, before(s["both"], lambda a, b: a + b), lambda y, at: F.struct(y["value"].alias("value"), (at + y["gap"]).alias("start"), (at + y["both"]).alias("end"))))

    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")), place)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the pattern counts."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= MOST_PART, F.lit(False)))
    if kind == "card":
        return F.length(digits(value)).between(*CARD_DIGITS) & F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(*PHONE_DIGITS)
    return F.lit(True)


def hinted(kind: str, text: Column) -> Column:
    return F.contains(text, F.lit(HINTS[kind])) if kind == "email" else text.rlike(HINTS[kind])


def base_spans(text: Column) -> Column:
    """Base spans of a text (not null) as ``order`` of the kind, ``start``, ``end``, by kind and start."""
    none = F.array().cast(f"array<{SPAN}>")

    def of(order: int, kind: str) -> Column:
        found = F.filter(located(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        spans = F.transform(found, lambda m: F.struct(F.lit(order).alias("order"), m["start"].alias("start"), m["end"].alias("end")))
        return F.when(hinted(kind, text), spans).otherwise(none)

    return F.concat(*(of(i, k) for i, k in enumerate(KINDS)))


def _pieces(text: Column) -> Column:
    """The text between e-mail addresses as ``gap``, where it starts (``at``), and the address after it, null for the last."""

    def cut(m: Column) -> Column:
        starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(m, lambda x: x["end"]))
        return F.arrays_zip(F.split(text, PATTERNS["email"], -1).alias("gap"), starts.alias("at"), F.transform(m, lambda x: x["value"]).alias("email"))

    whole = F.array(F.struct(text.alias("gap"), F.lit(0).cast("long").alias("at"), F.lit(None).cast("string").alias("email")))
    return F.when(hinted("email", text), let(located(text, PATTERNS["email"]), cut)).otherwise(whole)


def tokens(text: Column) -> Column:
    def of(p: Column) -> Column:
        inner = F.regexp_extract_all(p["gap"], F.lit(TOKEN), F.lit(0))
        return F.when(p["email"].isNull(), inner).otherwise(F.concat(inner, F.array(p["email"])))

    return F.flatten(F.transform(_pieces(text), of))


def located_terms(text: Column) -> Column:
    """The terms of a text with their places."""

    def of(p: Column) -> Column:
        terms = F.filter(located(p["gap"], TOKEN), lambda m: is_term(m["value"]))
        return F.transform(terms, lambda m: F.struct(m["value"].alias("value"), (m["start"] + p["at"]).alias("start"), (m["end"] + p["at"]).alias("end")))

    return F.flatten(F.transform(_pieces(text), of))


def is_term(token: Column) -> Column:
    return token.rlike(IS_TERM)


def entity(token: Column) -> Column:
    """A name for the protected entity that a token is, null if it is none: its kind, and its value without layout."""
    value = F.when(token.rlike("@"), F.concat(F.lit("email:"), lower_ascii(token)))
    value = value.when(token.startswith("+"), F.when(valid("phone", token), F.concat(F.lit("phone:"), digits(token))))
    value = value.when(token.rlike(r"\."), F.when(valid("ip", token), F.concat(F.lit("ip:"), token)))
    return value.when(token.rlike(r"^[0-9](?:[\x20-]?[0-9]){12,}+$"), F.when(valid("card", token), F.concat(F.lit("card:"), digits(token))))


def contexts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row``, ``entity``, ``context`` (a hash of the terms around it), ``terms``: one row for each entity in a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    any_hint = hinted("email", text) | hinted("ip", text) | hinted("card", text) | hinted("phone", text)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), text.alias("text")).where(any_hint).select("row", tokens(F.col("text")).alias("tokens"))

    def around(t: Column, i: Column) -> Column:
        part = F.slice("tokens", F.greatest(i + 1 - window, F.lit(1)), F.least(i, F.lit(window)) + 1 + window)
        return F.struct(entity(t).alias("entity"), F.transform(F.filter(part, is_term), lower_ascii).alias("terms"))

    # only tokens that are no terms can be entities: their places first, then what stands around them
    places = F.filter(F.transform("tokens", lambda t, i: F.when(~is_term(t), i)), lambda i: i.isNotNull())
    found = F.transform(places, lambda i: let(F.element_at("tokens", i + 1), lambda t: around(t, i)))
    out = rows.select("row", F.explode(found).alias("x")).where(F.col("x.entity").isNotNull())
    return out.select("row", F.col("x.entity").alias("entity"), F.md5(F.array_join("x.terms", " ").cast("binary")).alias("context"), F.array_distinct("x.terms").alias("terms"))


def candidates(found: DataFrame, n_rows: int, least_contexts: int = LEAST_CONTEXTS, generalise: float = GENERALISE) -> DataFrame:
    """``entity``, ``term``, ``together`` (rows that hold both), ``of_entity``: pairs that may reach the threshold.

    A pair needs enough different contexts. The rows in which a term stands near any entity are a lower
    bound of its rows, so a pair that misses the threshold with these can be left out; common words go
    here, before any text is read again.
    """
    in_row = found.select("row", "entity", "context", F.explode("terms").alias("term")).groupBy("entity", "term", "row").agg(F.min("context").alias("context"))
    in_row = saved(in_row, "in_row")
    by_context = in_row.groupBy("entity", "term", "context").agg(F.count("*").alias("rows"))
    both = by_context.groupBy("entity", "term").agg(F.sum("rows").alias("together"), F.count("*").alias("contexts")).where(F.col("contexts") >= least_contexts)
    of_entity = found.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("of_entity")).where(F.col("of_entity") < n_rows)
    least = in_row.select("row", "term").distinct().groupBy("term").agg(F.count("*").alias("of_term"))
    met = both.drop("contexts").join(of_entity, "entity").join(least, "term")
    return met.where(disclosure(n_rows) >= generalise).select("entity", "term", "together", "of_entity")


def disclosure(n_rows: int) -> Column:
    """Mutual information of term and entity as a share of the entity's information content."""
    n = F.lit(float(n_rows))
    return F.log(F.col("together") * n / (F.col("of_entity").cast("double") * F.col("of_term"))) / F.log(n / F.col("of_entity"))


def disclosing(pairs: DataFrame, held: DataFrame, n_rows: int) -> DataFrame:
    """``term``, ``disclosure``: the largest share of an entity's information that the term gives away."""
    of_term = held.groupBy("term").agg(F.sum("rows").alias("of_term"))
    return pairs.join(of_term, "term").groupBy("term").agg(F.max(disclosure(n_rows)).alias("disclosure"))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _with_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``key`` of a text, ``term``, ``rows`` that have the text, for each of ``terms`` that it holds.

    A few terms go to every task; many are met in a shuffle of the texts' distinct terms.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    distinct = F.filter(F.array_distinct(tokens(lower_ascii(text))), is_term)  # small letters change no token's ends
    each = docs.select(_text_key(text).alias("key"), F.explode(distinct).alias("term"))
    few = small_table(terms)
    return each.join(terms if few is None else F.broadcast(few), "term", "left_semi").groupBy("key", "term").agg(F.count("*").alias("rows"))


def marked_texts(docs: DataFrame, window: int, least_contexts: int, generalise: float, remove: float) -> DataFrame:
    """``key`` of each text that holds disclosing terms, and these ``terms`` (term, action)."""
    n_rows = docs.count()
    found = saved(contexts(docs, window), "contexts")
    pairs = saved(candidates(found, n_rows, least_contexts, generalise), "pairs")
    held = saved(_with_terms(docs, pairs.select("term").distinct()), "held")
    told = disclosing(pairs, held, n_rows).where(F.col("disclosure") >= generalise)
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    return saved(held.join(told, "term").groupBy("key").agg(F.collect_list(F.struct("term", action.alias("action"))).alias("terms")), "marked", keep=True)


def _cleaned(text: Column, spans: Column) -> Column:
    """The text with every span replaced: base kinds by their names, terms by a category or by nothing."""

    def pieces(s: Column) -> Column:
        return let(
            before(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b)),
            lambda upto: F.concat(
                F.array_join(F.zip_with(s, upto, lambda x, at: F.concat(F.substr(text, (at + 1).cast("int"), F.greatest(x["start"] - at, F.lit(0)).cast("int")), F.when(x["start"] >= at, x["by"]).otherwise(""))), ""),
                F.substr(text, (F.greatest(F.array_max(F.transform(s, lambda x: x["end"])), F.lit(0)) + 1).cast("int")),
            ),
        )

    return F.when(F.size(spans) == 0, text).otherwise(let(F.array_sort(spans), pieces))


def sanitise(
    docs: DataFrame, window: int = WINDOW, least_contexts: int = LEAST_CONTEXTS, generalise: float = GENERALISE, remove: float = REMOVE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``spans`` (kind, start, end; by kind, then start) and ``clean`` text of each row of ``docs``.

    Kinds are those of the base patterns and ``term``. Base spans are replaced by ``<EMAIL>`` and so on;
    terms by ``<NUMBER>``, ``<NAME>`` (capitalised) or ``<WORD>``, or by nothing where they disclose at
    least ``remove``. Null and empty texts have no spans, a null stays null. Rows are counted as they
    are, so repeated rows weigh in all counts alike; what makes a pair evidence is different contexts.
    Ids are carried, never used: they may be null or repeat. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    marked = marked_texts(rows, window, least_contexts, generalise, remove)
    whole = F.coalesce(F.col("text"), F.lit(""))
    few = small_table(marked)
    with_key = rows.withColumn("key", _text_key(whole))
    met = with_key.join(marked if few is None else F.broadcast(few), "key", "left").select("doc_id", "text", "terms", base_spans(whole).alias("base"))
    none = F.array().cast(f"array<struct<start: long, end: long, kind: string, by: string>>")

    def told(m: Column) -> Column:
        by = F.when(m["value"].rlike("^[0-9]+$"), "<NUMBER>").when(m["value"].rlike(r"^\p{Lu}"), "<NAME>").otherwise("<WORD>")
        action = F.element_at(F.map_from_entries("terms"), lower_ascii(m["value"]))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit("term").alias("kind"), F.when(action == "remove", "").otherwise(by).alias("by"))

    names = F.transform("terms", lambda x: x["term"])
    added = F.transform(F.filter(located_terms(whole), lambda m: F.array_contains(names, lower_ascii(m["value"]))), told)
    kinds = F.array(*map(F.lit, KINDS))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(kinds, s["order"] + 1).alias("kind"), F.concat(F.lit("<"), F.upper(F.element_at(kinds, s["order"] + 1)), F.lit(">")).alias("by")))
    spans = F.concat(base, F.when(F.col("terms").isNotNull(), added).otherwise(none))
    out = met.select("doc_id", "text", spans.alias("spans"))
    return out.select("doc_id", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"), _cleaned(F.col("text"), F.col("spans")).alias("clean"))


def digest(sanitised: DataFrame) -> DataFrame:
    """Counts by base kind, the hash of the base spans, and all spans as text."""

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == kind

    counts = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return sanitised.select("doc_id", *counts, F.sha2(shown(F.filter("spans", lambda s: s["kind"] != "term")), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
