"""Personal data: patterns propose spans, checksums confirm them, context words weigh them.

All of it is column expressions. Base kinds: e-mail addresses, IP addresses, card numbers and
international phone numbers; what passes their checks is always a span. Further kinds, IBANs,
social security numbers, and card and phone numbers in their usual grouping inside a longer run of
digits that failed as a whole, are spans if their score reaches the threshold. A score starts at the
kind's own value, which a checksum makes high, and a context word among the CONTEXT characters
before the span, back to the previous match of the kind, raises it. Social security numbers alone
depend on such a word; for them all CONTEXT characters before and after the span are read, across
other matches. A match that fails its check is dropped, not tried again.

Cost: a text is searched for a kind only if it holds the sign or digits that the kind needs. All
repetitions are possessive and start at the beginning of a run, so that a long run of letters or
digits takes linear time and no stack.

Defined cases: a null or empty text has no spans. Equal spans of one kind cannot occur; spans of
different kinds may overlap and are all reported, and are masked as one. Texts are read whole.
Other columns than the one that is added are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import between, cut, folds_before, let, match_spans

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "ssn", "card_number", "phone_number"]
# Only where no span of this base kind is.
INSTEAD_OF = {"card_number": "card", "phone_number": "phone"}
CONTEXT = 40
# Matches that fill the context, by kind: a social security number has 11 characters.
ACROSS = {"ssn": 4}
THRESHOLD = 0.6
SCORE_OF_WORD = 0.3

# A word that stands near a span raises its score. Fixed values.
WORDS = {
    "email": "e-?mail|contact|write|reach",
    "ip": "ip|address|host|server|from",
    "card": "card|visa|mastercard|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax|contact",
    "iban": "iban|account|bank|transfer|konto|cuenta|compte",
    "ssn": "ssn|social|security|insurance",
    "card_number": "card|visa|mastercard|credit|debit|payment",
    "phone_number": "phone|tel|call|mobile|fax|contact",
}
# Score of a span by its pattern and, where the kind has one, its checksum alone.
OWN_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "card_number": 0.8, "phone_number": 0.6}

_LOCAL = "[A-Za-z0-9._%+-]"
# \G lets a match begin where the last one ended; otherwise it begins where its run begins.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
    "card_number": r"(?<![A-Za-z0-9_])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![A-Za-z0-9_])",
    "phone_number": r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![A-Za-z0-9_])",
}
# What a text must hold to be searched at all.
_NEEDS = {
    "email": "@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"(?:[0-9][\x20-]?+){14}",
    "phone": r"\+[0-9][\x20().0-9-]",
    "iban": r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]",
    "ssn": r"[0-9]{3}-[0-9]{2}-",
    "card_number": r"[0-9]{13}|(?:[0-9]{4}[\x20-]){3}",
    "phone_number": r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2}",
}


def _luhn(digits: Column) -> Column:
    """Whether the sum of digits, every second one from the right doubled, ends in 0."""
    places = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, F.ascii(d) - 48).otherwise(
            F.when(d >= "5", (F.ascii(d) - 48) * 2 - 9).otherwise((F.ascii(d) - 48) * 2)
        ),
    )
    return F.aggregate(places, F.lit(0), lambda a, d: a + d) % 10 == 0


def _mod_97(text: Column) -> Column:
    """Whether the number of an IBAN, first four signs last and letters as 10 to 35, is 1 modulo 97."""
    moved = F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(4)))

    def step(rest: Column, sign: Column) -> Column:
        letter = F.ascii(sign) - 55
        return F.when(F.ascii(sign) >= 65, (rest * 100 + letter) % 97).otherwise(
            (rest * 10 + F.ascii(sign) - 48) % 97
        )

    signs = F.filter(F.split(moved, ""), lambda s: s != "")
    return F.aggregate(signs, F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        # Three digits without leading zeros decide; longer numbers are above 255 anyway.
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substr(p, F.lit(1), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(F.substr(digits, F.lit(1), F.lit(19)))
    if kind == "card_number":
        return _luhn(digits)
    if kind in ("phone", "phone_number"):
        return F.length(digits).between(10, 15)
    if kind == "iban":
        bare = F.regexp_replace(match, " ", "")
        return F.length(bare).between(15, 34) & _mod_97(bare)
    return F.lit(True)


def _word_near(kind: str, s: Column) -> Column:
    """Whether a context word stands before a span, or after it where both sides are read."""
    word = F.lit(rf"\b(?:{WORDS[kind]})\b")
    before = F.regexp_like(F.lower(s["before"]), word)
    return before | F.regexp_like(F.lower(s["after"]), word) if kind in ACROSS else before


def _spans(text: Column, kind: str) -> Column:
    def scored(s: Column) -> Column:
        near = F.when(_word_near(kind, s), SCORE_OF_WORD).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.least(F.lit(1.0), F.round(F.lit(OWN_SCORE[kind]) + near, 2)).alias("score"),
            s["match"].alias("match"),
        )

    found = F.transform(
        F.filter(
            match_spans(text, F.lit(PATTERNS[kind]), CONTEXT, ACROSS.get(kind, 0)),
            lambda s: _confirmed(kind, s["match"]),
        ),
        scored,
    )
    if kind not in BASE_KINDS:
        found = F.filter(found, lambda s: s["score"] >= THRESHOLD)
    return F.when(F.regexp_like(text, F.lit(_NEEDS[kind])), found)




def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


# Behind the end of any text.
_FAR = (1 << 31) - 1
_EMPTY = "array<struct<kind:string,start:int,end:int,score:double,match:string>>"


def pii_spans(text: Column) -> Column:
    """array<struct<kind, start, end, score, match>> in the order of start and KINDS."""
    # Each kind's spans are in order already; sorting puts them together by start and kind.
    found = F.concat(*(F.coalesce(_spans(text, kind), F.array().cast(_EMPTY)) for kind in KINDS))

    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        found, lambda s: F.struct(s["start"].alias("at"), F.array_position(order, s["kind"]).alias("k"), s.alias("s"))
    )
    spans = let(F.transform(F.array_sort(keyed), lambda x: x["s"]), _without_covered)
    return F.when(F.regexp_like(text, F.lit("[@0-9]")), spans).otherwise(F.array().cast(_EMPTY))


def _without_covered(spans: Column) -> Column:
    """Sorted spans without those of a kind that stands in for a base kind where that has a span.

    A span meets one of the base kind if an earlier one ends after its start, or the next later one
    starts before its end.
    """

    def bounds(base: str) -> Column:
        ends = F.transform(spans, lambda s: F.when(s["kind"] == base, s["end"]).otherwise(0))
        starts = F.transform(spans, lambda s: F.when(s["kind"] == base, s["start"]).otherwise(_FAR))
        last_end = let(ends, lambda e: folds_before(e, F.lit(0), _larger))
        next_start = let(F.reverse(starts), lambda r: F.reverse(folds_before(r, F.lit(_FAR), _smaller)))
        return F.struct(last_end.alias("last_end"), next_start.alias("next_start"))

    def stay(known: Column) -> Column:
        def stays(s: Column, i: Column) -> Column:
            met = [
                (s["kind"] == own)
                & ((F.get(known[base]["last_end"], i) > s["start"]) | (F.get(known[base]["next_start"], i) < s["end"]))
                for own, base in INSTEAD_OF.items()
            ]
            return ~(met[0] | met[1])

        return F.filter(spans, stays)

    known = F.struct(*(bounds(base).alias(base) for base in INSTEAD_OF.values()))
    doubtful = F.exists(spans, lambda s: s["kind"].isin(list(INSTEAD_OF)))
    return F.when(doubtful, let(known, stay)).otherwise(spans)


def described(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with ``<KIND>`` in place of every span; overlapping spans become the first one."""

    def put(x: Column) -> Column:
        parts, reached = x["parts"], x["reached"]
        rows = F.transform(
            spans,
            lambda s, i: F.when(
                s["start"] >= F.get(reached, i),
                F.concat(between(parts, F.get(reached, i), s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")),
            ).otherwise(""),
        )
        last = F.greatest(F.element_at(spans, -1)["end"], F.element_at(reached, -1))
        return F.concat(F.array_join(rows, ""), between(parts, last, F.length(text)))

    ends = F.transform(spans, lambda s: s["end"])
    # Up to where the spans before each one reach.
    reached = let(ends, lambda e: folds_before(e, F.lit(0), _larger))
    whole = let(F.struct(cut(text).alias("parts"), reached.alias("reached")), put)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def with_spans(docs: DataFrame, name: str = "pii_spans", text: str = "text") -> DataFrame:
    """``docs`` with its spans in a column ``name``, in place of one of that name."""
    return docs.withColumn(name, pii_spans(F.coalesce(docs[text], F.lit(""))))


def without_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` masked; all columns keep their place."""
    return docs.withColumn(text, let(F.col(text), lambda t: let(pii_spans(t), lambda s: masked(t, s))))
