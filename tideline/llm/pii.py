"""Personal data by patterns, checksums and context words, in DataFrame expressions only.

A pattern proposes spans, a validator (Luhn, mod-97, number ranges) confirms them and words nearby move the
score. Patterns start at the beginning of a run (``\\G`` or a look-behind) and match possessively, so the work
is linear in the text; what they match is what the plain forms in the comments match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import whole_text

CONTEXT_CHARS = 40
REPORTED = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a cheap pattern without which the main one cannot match
    base: bool
    start_score: float
    confirmed: float  # added by a passed checksum
    context: str  # words that add ``near``
    near: float


# Pattern forms and limits of the base kinds, in their order; then the added kinds.
KINDS = [
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", True, 0.8, 0.0, "mail|contact|kontakt|correo|courriel", 0.2,
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]", True, 0.6, 0.0, "ip|host|server|address|adresse", 0.2,
    ),
    # [0-9]([\x20-]?[0-9])+, 13 to 19 digits passing Luhn
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+",
        r"[0-9][ -]?[0-9]", True, 0.4, 0.4, "card|credit|visa|karte|tarjeta|carte", 0.2,
    ),
    # \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9]", True, 0.6, 0.0, "phone|tel|call|mobile|fax", 0.2,
    ),
    Kind(
        "iban",
        r"[A-Z][A-Z][0-9][0-9](?: ?[A-Z0-9][A-Z0-9][A-Z0-9][A-Z0-9]){2,7}(?: ?[A-Z0-9]{1,3})?",
        r"[A-Z][A-Z][0-9][0-9]", False, 0.2, 0.5, "iban|account|konto|cuenta|compte", 0.2,
    ),
    Kind(
        "ssn",
        r"[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]",
        r"[0-9]-[0-9][0-9]-[0-9]", False, 0.2, 0.2, "ssn|social|security|taxpayer", 0.3,
    ),
]
BASE_KINDS = [k.name for k in KINDS if k.base]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    number = digits(value)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, -place, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(place % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def passes_mod97(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, place: Column) -> Column:
        c = F.substring(turned, place, F.lit(1))
        digit = c.cast("int")
        return F.when(c <= "9", rest * 10 + digit).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def passes(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"\A{part}\.{part}\.{part}\.{part}\z")
    if kind == "card":
        return n.between(13, 19) & passes_luhn(value)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34) & passes_mod97(value)
    if kind == "ssn":
        return ~value.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _spans(kind: Kind, gaps: Column, hits: Column) -> Column:
    """Confirmed spans: pieces of the text between and of the matches add up to places."""
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"))
    kind_of_span = "array<struct<kind:string,start:int,stop:int,score:double,value:string>>"

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        around = F.lower(F.concat_ws(" ", F.right(x["gap"], F.lit(CONTEXT_CHARS)), F.left(x["next"], F.lit(CONTEXT_CHARS))))
        score = F.lit(kind.start_score + kind.confirmed) + F.when(around.rlike(kind.context), kind.near).otherwise(0.0)
        span = F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), stop.alias("stop"), score.alias("score"), x["hit"].alias("value")
        )
        held = x["hit"].isNotNull() & passes(kind.name, x["hit"])
        if not kind.base:
            held = held & (score >= REPORTED)
        return F.struct(
            F.coalesce(stop, start).alias("at"), F.when(held, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")
        )

    none = F.array().cast(kind_of_span)
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]
    return F.when(F.size(hits) > 0, found).otherwise(none)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, stop, score, value) of each row of ``docs`` (doc_id, text, any other columns).

    Places are code points, the end exclusive; spans come by kind as listed, then by start. A null or empty
    text has none; repeated rows and ids give a row each.
    """
    text = F.col("text")
    hits = [
        F.when(text.rlike(k.needs), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        for k in KINDS
    ]
    # Going through a generator keeps the optimizer from matching again wherever the hits are used.
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).select(
        "doc_id", "text", F.inline(F.array(F.struct(*[h.alias(f"hits_{k.name}") for k, h in zip(KINDS, hits)])))
    )
    gaps = [
        F.when(F.size(f"hits_{k.name}") > 0, F.split(text, k.pattern, -1)).otherwise(F.array().cast("array<string>")) for k in KINDS
    ]
    cut = found.select("doc_id", "text", *[F.col(f"hits_{k.name}") for k in KINDS], F.inline(F.array(F.struct(*[g.alias(f"gaps_{k.name}") for k, g in zip(KINDS, gaps)]))))
    spans = [_spans(k, F.col(f"gaps_{k.name}"), F.col(f"hits_{k.name}")) for k in KINDS]
    return cut.select("doc_id", F.concat(*spans).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds, all spans as text, and the highest score (null without spans)."""
    spans = F.col("spans")

    def count_of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    found = find_pii(docs).select("doc_id", F.explode(F.array("spans")).alias("spans"))
    return found.select(
        "doc_id",
        *[count_of(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(written(F.filter(spans, lambda s: s["kind"].isin(BASE_KINDS))), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )
