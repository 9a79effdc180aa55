"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is a column expression on one row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import around, matches, pieces, text_of, with_spans

#: Kinds in output order.  The patterns give the leftmost non-overlapping matches of the plain forms;
#: a look-behind (or the end of the match before) keeps long runs from being tried at every character,
#: and possessive groups from deep recursion.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
#: A character that every match of the kind has, to skip texts quickly.
_NEEDS = {"email": "@", "phone": "+", "ip": "."}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Score of a span without context, and words whose presence around it adds CONTEXT_BONUS.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8}
CONTEXT = {
    "email": "mail|contact|write to|reach",
    "ip": r"\bip\b|address|server|host|login",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto|compte|cuenta",
}
CONTEXT_BONUS, CONTEXT_WIDTH = 0.2, 40


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn checksum."""
    turned = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1 modulo 97 (letters count 10 to 35)."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))

    def add(acc: Column, i: Column) -> Column:
        c = F.substring(moved, i, F.lit(1))
        letter = c >= "A"
        return (acc * F.when(letter, 100).otherwise(10) + F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        return v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(v, " ", ""))
    return F.lit(True)


def _confirmed(number: int, kind: str) -> Column:
    """The spans of one kind that their checksum or form confirms, with scores."""

    def scored(x: Column) -> Column:
        near = around(F.col("cut"), x["s"], x["e"], CONTEXT_WIDTH)
        score = F.lit(SCORES[kind]) + F.when(F.lower(near).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(F.lit(number).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("name"), F.round(score, 2).alias("score"))

    return F.transform(F.filter(F.col(kind), lambda x: _valid(kind, x["v"])), scored)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): all confirmed spans of a row, array<struct<k, s, e, name, score>> by kind, then start."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    text, none = F.col("text"), F.array().cast("array<string>")

    def every(kind: str) -> Column:
        found = matches(text, PATTERNS[kind])
        return (F.when(F.contains(text, F.lit(_NEEDS[kind])), found).otherwise(none) if kind in _NEEDS else found).alias(kind)

    rows = rows.select("doc_id", "text", *map(every, PATTERNS))
    some = sum((F.size(kind) for kind in PATTERNS), F.lit(0)) > 0
    rows = rows.withColumn("cut", F.when(some, pieces(text)).otherwise(none))
    rows = with_spans(rows, "text", PATTERNS)
    return rows.select("doc_id", F.concat(*(_confirmed(number, kind) for number, kind in enumerate(PATTERNS))).alias("found"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban, scores.

    spans and scores have the base kinds and iban.  A null or empty text has no spans; repeated rows and
    null ids stay; an empty table gives an empty result; other columns are ignored.
    """
    rows = find(docs, id_col, text_col)
    found = F.col("found")

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["name"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(found, lambda x: x["k"] < 4)
    scores = F.array_join(F.transform(found, lambda x: x["score"].cast("string")), ",")
    return rows.select("doc_id", *map(count, ("email", "ip", "card", "phone")), F.sha2(text_of(base), 256).alias("base_sha256"), text_of(found).alias("spans"), count("iban"), scores.alias("scores"))
