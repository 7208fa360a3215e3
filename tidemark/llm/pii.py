"""Personal data by patterns, checksums and context (native columns only).

A regular expression proposes spans of a kind, leftmost and without overlap. A validator then
confirms or drops each: at most 255 in the parts of an IP address, Luhn's sum for cards, a
remainder of 1 modulo 97 for IBANs, a number of digits for phones. The words just before a
confirmed span raise its score.

An IBAN is proposed at every place where one can begin, with all that could belong to it. It ends
where its country's length says; for two letters that are no listed country, at the last end of
a run of capitals and figures at which the remainder holds.

The patterns are written so that a scan takes time in proportion to the text: runs are
possessive, and a match starts where a run starts (or where the last match ended), which is
where the leftmost match of the plain pattern starts too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import sums_before

CONTEXT = 40
CONTEXT_BONUS = 0.2
# The length of an IBAN by its country (the registry's fixed lengths).
IBAN_LENGTHS = {
    country: size
    for size, countries in {
        15: "NO",
        16: "BE",
        18: "DK FI FK FO GL NL SD",
        19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST",
        26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA",
        30: "JO KW MU YE",
        31: "MT SC",
        32: "LC",
        33: "RU",
    }.items()
    for country in countries.split()
}


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _address(span: Column) -> Column:
    number = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(
        F.split(span, r"\."),
        lambda p: F.when(F.length(number(p)) > 3, False).otherwise(
            F.coalesce(F.try_to_number(F.concat(F.lit("0"), F.right(number(p), F.lit(3))), F.lit("9999")), F.lit(0)) <= 255
        ),
    )


def _luhn(span: Column) -> Column:
    def worth(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    figures = F.reverse(F.regexp_extract_all(_digits(span), F.lit("([0-9])")))
    total = F.aggregate(F.transform(figures, worth), F.lit(0), lambda a, x: a + x)
    size = F.length(_digits(span))
    return F.when((size >= 13) & (size <= 19), total % 10 == 0).otherwise(False)


def _phone(span: Column) -> Column:
    size = F.length(_digits(span))
    return (size >= 9) & (size <= 15)


def _iban(span: Column) -> Column:
    plain = F.regexp_replace(span, " ", "")
    turned = F.concat(F.substring(plain, 5, 60), F.substring(plain, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    rest = F.aggregate(F.regexp_extract_all(turned, F.lit("([A-Z0-9])")), F.lit(0), step)
    size = F.length(plain)
    return F.when((size >= 15) & (size <= 34), rest == 1).otherwise(False)


def _iban_part(proposal: Column) -> Column:
    """The IBAN a proposal begins with, or an empty text."""
    words = F.split(proposal, " ")
    starts = F.transform(
        F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, F.lit(1), i), " ")
    )
    country = F.substring(proposal, 1, 2)
    size = F.lit(0)
    for length in sorted(set(IBAN_LENGTHS.values())):
        listed = [c for c, n in IBAN_LENGTHS.items() if n == length]
        size = F.when(country.isin(listed), F.lit(length)).otherwise(size)
    held = F.filter(
        starts, lambda s: size.isin(0, F.length(F.regexp_replace(s, " ", ""))) & _iban(s)
    )
    return F.coalesce(F.get(held, F.size(held) - 1), F.lit(""))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    # A cheap pattern or string that every text with a span has.
    sign: str
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    # What a proposal (group 1; the match itself is its first character) is cut to; empty: no span.
    part: Callable[[Column], Column] | None = None


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda span: F.lit(True),
        0.8,
        r"mail|contact|write|reach",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        _address,
        0.5,
        r"\bip\b|address|host|server",
    ),
    Kind("card", r"(?<![0-9])[0-9](?:[ -]?[0-9])++", "", _luhn, 0.7, r"card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", _phone, 0.6, r"call|phone|tel|mobile|fax"),
    Kind(
        "iban",
        # One character more than an IBAN can have, so that a longer run is seen to be longer.
        r"(?<![A-Z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,31}))[A-Z]",
        "",
        lambda span: F.length(span) > 0,
        0.8,
        r"iban|account|bank",
        base=False,
        part=_iban_part,
    ),
)


def _span(k: Kind) -> Callable[[Column], Column]:
    def span(found: Column) -> Column:
        m, gap = found["m"], found["gap"]
        start = found["before"] + F.length(gap)
        near = F.lower(F.right(gap, F.lit(CONTEXT))).rlike(k.context)
        score = F.lit(k.score) + F.when(near, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(k.name).alias("kind"),
            start.alias("start"),
            (start + F.length(m)).alias("end"),
            score.alias("score"),
            F.lit(k.base).alias("base"),
            k.confirmed(m).alias("confirmed"),
        )

    return span


def _apart(spans: Column) -> Column:
    """Without the spans that begin inside one before them."""
    kind = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean,confirmed:boolean>>"
    return F.aggregate(
        spans,
        F.array().cast(kind),
        lambda kept, s: F.when(
            s["start"] >= F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0)), F.concat(kept, F.array(s))
        ).otherwise(kept),
    )


def find_spans(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, id_col: str = "doc_id", text_col: str = "text", least_score: float = 0.5
) -> DataFrame:
    """The id and `spans` of every row: an array of kind, start, end (code points, end exclusive),
    score and base, by kind as listed, then by start.

    Base kinds always stay; spans of the added kinds (IBAN) stay with `least_score` or more. A
    null or empty text has no spans. Equal texts have equal spans, repeated rows each get them;
    kinds are looked for independently, so spans of different kinds may overlap. Only the two
    named columns are read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    for k in kinds:
        some = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(1 if k.part else 0))
        some = F.transform(some, k.part) if k.part else some
        sign = text.contains(k.sign) if k.sign else text.rlike("[0-9]")
        found = found.withColumn(f"m_{k.name}", F.when(sign, some).otherwise(F.array().cast("array<string>")))
    for k in kinds:
        # What lies between the matches; their lengths give the places.
        found = found.withColumn(
            f"g_{k.name}",
            F.when(F.size(f"m_{k.name}") > 0, F.split(text, k.pattern, -1)).otherwise(F.array().cast("array<string>")),
        )
    found = found.drop("text")
    for k in kinds:
        steps = F.zip_with(
            F.col(f"m_{k.name}"),
            F.col(f"g_{k.name}"),
            lambda m, g: (F.length(g) + F.coalesce(F.lit(1) if k.part else F.length(m), F.lit(0))).cast("bigint"),
        )
        found = found.withColumn(f"b_{k.name}", sums_before(steps))
    lists = []
    for k in kinds:
        # Zipped, not looked up in a lambda: an expression inside a lambda may be worked out per element.
        matches = F.col(f"m_{k.name}")
        gaps = F.slice(F.col(f"g_{k.name}"), F.lit(1), F.size(matches))
        before = F.slice(F.col(f"b_{k.name}"), F.lit(1), F.size(matches))
        zipped = F.zip_with(
            matches, gaps, lambda m, gap: F.struct(m.alias("m"), gap.alias("gap"))
        )
        zipped = F.zip_with(zipped, before, lambda x, b: x.withField("before", b))
        spans = F.filter(F.transform(zipped, _span(k)), lambda s: s["confirmed"])
        if k.part:
            spans = _apart(spans)
        if not k.base:
            spans = F.filter(spans, lambda s: s["score"] >= least_score)
        lists.append(F.transform(spans, lambda s: s.dropFields("confirmed")))
    return found.select(F.col("id").alias(id_col), F.concat(*lists).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, a hash of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    return found.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
