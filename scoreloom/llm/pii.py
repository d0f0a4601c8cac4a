"""Personal data: regular expressions propose, checksums confirm, context adjusts the score.

For each kind a pattern proposes spans, leftmost and without overlap. A validator confirms or drops them: address parts
up to 255, the Luhn sum for card numbers, the number of digits for phones, mod 97 for account numbers (IBAN, whose length
is that of their country, so a word that follows is never taken in). The score
of a confirmed span is its kind's prior, raised where a context word stands within 40 characters. The kinds email, ip,
card and phone are reported whatever their score; the further kinds iban and ssn only from ``LEAST_SCORE`` on, so a bare
number of the form of an ssn counts in context only.

Everything is a column expression over one row: no shuffle, no Python. The patterns are possessive and start only where
a run of their characters starts, so time stays in proportion to the text even in a long run of letters or digits.
Positions come from the lengths of the pieces between matches, summed in blocks.

Null and empty texts have no spans. Each row stands alone: repeated rows give repeated results, an empty table an empty
one. Other columns pass through ``masked`` as they are and are not read by ``found``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 128
NEAR = 40
LEAST_SCORE = 0.6

LOCAL, DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    step = lambda rest, c: F.when(c <= "9", rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(step(rest, c))) == 1


#: The number of characters of each country's IBAN, by the registry and by the use of further countries.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban(countries: str, characters: int) -> str:
    """Country, check digits and the rest, in blocks of four or without a blank."""
    blocks, rest = divmod(characters - 4, 4)
    last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{blocks}}}{last}"


#: kind: (a quick sign that a text may hold one, pattern, validator, prior, context words)
KINDS = {
    "email": (
        lambda t: F.contains(t, F.lit("@")),
        rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{DOMAIN}]++(?:\.[{DOMAIN}]++)++",
        lambda m: F.lit(True),
        0.9,
        "mail|contact|write to|kontakt|contacto",
    ),
    "ip": (
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        0.7,
        r"\bip\b|address|server|host|login",
    ),
    "card": (
        lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
        r"[0-9](?:[\x20-]?[0-9]){11,}+",  # shorter runs fail in any case, and a run is always taken whole
        lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m)),
        0.7,
        "card|visa|credit|payment|karte|carte|tarjeta",
    ),
    "phone": (
        lambda t: F.contains(t, F.lit("+")),
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(_digits(m)).between(9, 15),
        0.7,
        "phone|tel|call|mobile|fax",
    ),
    "iban": (
        lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
        rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(_iban(c, n) for n, c in IBAN.items())})(?![A-Za-z0-9])",
        _mod97,
        0.7,
        "iban|account|bank|konto|cuenta|compte",
    ),
    "ssn": (
        lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
        0.3,
        r"ssn|social security|taxpayer",
    ),
}
BASE = ("email", "ip", "card", "phone")


def _running(lengths: Column) -> Column:
    """For each element of an array of numbers the sum of those before it; in blocks, so long arrays stay cheap."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)),
    )
    push = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all"))
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    sums = lambda xs: F.aggregate(xs, start, push)["all"]
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    before = sums(F.transform(blocks, total))
    return F.flatten(F.zip_with(blocks, before, lambda xs, b: F.transform(sums(xs), lambda s: s + b)))


def _of_kind(text: Column, kind: str, order: int) -> Column:
    """The confirmed spans of one kind, in order."""
    sign, pattern, valid, prior, words = KINDS[kind]
    matches, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    length = F.transform(matches, lambda m: F.length(m))
    gap = F.slice(F.transform(pieces, lambda p: F.length(p)), F.lit(1), F.size(length))
    at = F.zip_with(_running(F.zip_with(gap, length, lambda g, n: g + n)), gap, lambda s, g: s + g)
    spans = F.transform(
        matches,
        lambda m, i: F.struct(
            F.get(at, i).alias("start"),
            F.lit(order).alias("order"),
            (F.get(at, i) + F.length(m)).alias("end"),
            F.lit(kind).alias("kind"),
            m.alias("match"),
            F.lower(F.concat(F.right(F.get(pieces, i), F.lit(NEAR)), F.lit(" "), F.left(F.get(pieces, i + 1), F.lit(NEAR)))).alias("near"),
        ),
    )
    scored = F.transform(
        F.filter(spans, lambda s: valid(s["match"])),
        lambda s: F.struct(
            s["start"], s["order"], s["end"], s["kind"], s["match"],
            F.when(s["near"].rlike(words), F.lit(min(1.0, prior + 0.3))).otherwise(F.lit(prior)).alias("score"),
        ),
    )
    kept = scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,match:string,score:double>>")
    return F.when(sign(text), F.when(F.size(matches) > 0, kept)).otherwise(none)


def spans_of(text: Column) -> Column:
    """All spans of a text by start, then by kind: ``array<struct<start, order, end, kind, match, score>>``."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,match:string,score:double>>")
    return F.array_sort(F.concat(*(F.coalesce(_of_kind(text, k, i), none) for i, k in enumerate(KINDS))))


def found(docs: DataFrame, text: str = "text", carry: list[str] | None = None, out: str = "pii") -> DataFrame:
    """The columns ``carry`` of ``docs`` (all by default) and the spans of each text as ``out``."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != out]
    return docs.select(*(F.col(f"`{c}`") for c in carry), spans_of(F.col(f"`{text}`")).alias(out))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def masked(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; of overlapping spans the first one stands.

    ``length``: a column that holds the number of characters and is set anew; other columns stay as they are.
    """
    name = "pii"
    while name in docs.columns:
        name += "_"
    body, spans = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.col(name)
    push = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
        F.struct(
            s["end"].alias("at"),
            F.concat(
                acc["out"],
                F.array(F.substr(body, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))),
            ).alias("out"),
        )
    )
    whole = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        push,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(body, acc["at"] + 1)),
    )
    rows = found(docs, text, out=name).withColumn(text, F.when(F.size(spans) > 0, whole).otherwise(F.col(f"`{text}`")))
    if length in docs.columns:
        counted = F.length(F.col(f"`{text}`")).cast(docs.schema[length].dataType)
        rows = rows.withColumn(length, F.when(F.size(spans) > 0, counted).otherwise(F.col(f"`{length}`")))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
