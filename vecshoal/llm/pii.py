"""Personal data in texts: patterns propose spans, checks confirm them, words nearby move the score.

Everything is DataFrame functions. For each kind a text is split at its matches and the matches are
extracted; the lengths of gaps and matches give the places, in code points. No rows move.

Kinds ``email ip card phone`` are kept whenever their check holds. The further kinds start from a lower score, which a
passed checksum or a word nearby that speaks of them lifts over the threshold: ``iban`` (length by country, mod 97), ``ssn`` (ranges, context)
and ``local_phone`` (no country code, context). Matches of one kind do not overlap; kinds may.

Cases: a NULL or empty text has no spans; repeated rows give the same spans each; an empty table gives an empty
result. Of the input only id and text are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import whole

SPANS = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


#: The length of account numbers by country, as their registry gives it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
    32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """Two letters of a country and as many signs, in groups or not, as its numbers have: what follows a number is no part of it."""
    each = "|".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{size - 4}}}" for size, codes in IBAN_LENGTHS.items())
    return rf"(?<![A-Za-z0-9])(?:{each})(?![A-Za-z0-9])"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    from_right = F.transform(
        F.sequence(F.lit(1), F.length(number)),
        lambda i: F.substring(F.reverse(number), i, F.lit(1)).cast("int") * (F.lit(2) - i % 2),
    )
    return F.aggregate(from_right, F.lit(0), lambda total, x: total + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether an account number without blanks leaves 1 on division by 97, letters counting from 10."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))
    signs = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substring(turned, i, F.lit(1))))
    rest = F.aggregate(
        signs,
        F.lit(0),
        lambda rest, sign: F.when(sign >= 65, (rest * 100 + sign - 55) % 97).otherwise((rest * 10 + sign - 48) % 97),
    )
    return rest == 1


def short_parts(match: Column) -> Column:
    return match.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")


def card_number(match: Column) -> Column:
    number = digits(match)
    return F.when(F.length(number).between(16, 19), luhn(number)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` is written so that a long run of its signs is read once: repeats are possessive, and a match
    starts at the start of such a run or where the match before ended, which leaves the leftmost matches as they are.
    """

    name: str
    pattern: str
    needs: Column
    check: Callable[[Column], Column]
    context: str
    score: float
    base: bool = True


def kinds(text: Column) -> list[Kind]:
    has_digit = text.rlike("[0-9]")
    return [
        Kind(
            "email",
            r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
            text.contains("@"),
            lambda match: F.lit(True),
            "mail|contact|write to",
            0.9,
        ),
        Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", has_digit & text.contains("."),
             short_parts, "ip|host|server|address", 0.6),
        Kind("card", r"[0-9](?:[\x20-]?[0-9])++", has_digit, card_number, "card|visa|credit|payment", 0.9),
        Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", text.contains("+"),
             lambda match: F.length(digits(match)).between(8, 15), "phone|tel|call|mobile|fax", 0.6),
        Kind("iban", iban_pattern(), has_digit,
             lambda match: mod_97(F.replace(match, F.lit(" "), F.lit(""))), "iban|account|bank", 0.8, base=False),
        Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
             has_digit & text.contains("-"), lambda match: F.lit(True), "ssn|social security", 0.3, base=False),
        Kind("local_phone", r"(?<![0-9+]|[0-9+]\x20)\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])", text.contains("("),
             lambda match: F.lit(True), "phone|tel|call|mobile|fax", 0.3, base=False),
    ]


BASE = ("email", "ip", "card", "phone")


def find_pii(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, lift: float = 0.3, reach: int = 40
) -> DataFrame:
    """``doc_id`` and ``spans``, by kind in the order of :func:`kinds`, then by start; ends are exclusive.

    ``lift`` is what a context word within ``reach`` code points adds to the score of a match.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("_text"))
    body = F.col("_text")
    found = kinds(body)
    rows = rows.withColumns({f"_hits_{k.name}": F.when(k.needs, F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0))) for k in found})
    some = {k.name: F.size(f"_hits_{k.name}") > 0 for k in found}
    rows = rows.withColumns({f"_gaps_{k.name}": F.when(some[k.name], F.split(body, k.pattern, -1)) for k in found})
    rows = rows.withColumns({f"_at_{k.name}": places(F.col(f"_gaps_{k.name}"), F.col(f"_hits_{k.name}")) for k in found})

    def confirmed(kind: Kind) -> Column:
        gaps = F.col(f"_gaps_{kind.name}")
        seen = F.arrays_zip(
            F.col(f"_hits_{kind.name}").alias("value"),
            F.col(f"_at_{kind.name}").alias("start"),
            F.transform(gaps, lambda gap: F.right(gap, F.lit(reach))).alias("before"),
            F.transform(F.slice(gaps, 2, F.size(gaps)), lambda gap: F.left(gap, F.lit(reach))).alias("after"),
        )
        words = rf"(?i)\b(?:{kind.context})"
        spans = F.transform(
            F.filter(seen, lambda x: x["value"].isNotNull() & kind.check(x["value"])),
            lambda x: F.struct(
                F.lit(kind.name).alias("kind"),
                x["start"].alias("start"),
                (x["start"] + F.length(x["value"])).alias("end"),
                x["value"].alias("value"),
                F.least(
                    F.lit(1.0),
                    kind.score + F.when(x["before"].rlike(words) | x["after"].rlike(words), lift).otherwise(0.0),
                ).alias("score"),
            ),
        )
        if not kind.base:
            spans = F.filter(spans, lambda x: x["score"] >= threshold)
        return F.when(some[kind.name], spans).otherwise(F.array().cast(SPANS)).cast(SPANS)

    return rows.select("doc_id", F.flatten(F.array(*map(confirmed, found))).alias("spans"))


def places(gaps: Column, hits: Column) -> Column:
    """Where each match starts: the gaps and matches before it, in code points."""
    sizes = F.arrays_zip(
        F.transform(gaps, lambda gap: F.length(gap)).alias("gap"), F.transform(hits, lambda hit: F.length(hit)).alias("hit")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        sizes,
        start,
        lambda so_far, x: F.struct(
            (so_far["at"] + x["gap"] + F.coalesce(x["hit"], F.lit(0))).alias("at"),
            F.array_append(so_far["starts"], so_far["at"] + x["gap"]).alias("starts"),
        ),
        lambda so_far: so_far["starts"],
    )
