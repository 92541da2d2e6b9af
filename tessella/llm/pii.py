"""Personal data spans, in DataFrame operations only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod-97 for IBANs, ranges for addresses and
digit counts), and words near a span move its score. Spans of the base kinds email, ip, card and phone are always kept
once valid; those of the further kinds iban, ssn and secret need a score of at least LEAST. A secret is a value of 16
characters or more, with letters and digits, that is assigned to a name such as token or password, or a key of a known form.

Offsets come without a Python worker: matches are wrapped in a control character, which the text itself is rid of
first (its occurrences become another control character, of the same length and in no pattern), the text is split
there, and starts are the prefix sums of the pieces' lengths. Patterns use possessive repeats and look-behinds that
keep the leftmost, greedy reading but never rescan a run, so that long runs stay linear.

Defined results: a null text is empty and has no spans; a row stays a row, whatever else is null or repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, OTHER = "\x01", "\x02"
LOCAL = "[A-Za-z0-9._%+-]"
#: Length of a country's IBANs -> countries. Other countries' may have 15 to 34 characters.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(" ".join(IBAN_LENGTHS.values()).split())
_IBANS = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
_TOKEN = "[A-Za-z0-9_+/-]"
_NAMES = "token|api[_-]?key|access[_-]?key|secret[_-]?key|secret|passwo?r?d|pwd"
#: kind -> pattern, in the order of the results. The first four are the base kinds.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS}|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "secret": rf"(?<!{_TOKEN})(?:(?<=(?i:{_NAMES})[\"']?\x20{{0,2}}[:=]\x20{{0,2}}[\"']?){_TOKEN}{{16,}}+|(?:AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{36,}}+|sk-[A-Za-z0-9_-]{{20,}}+|xox[abprs]-[A-Za-z0-9-]{{20,}}+)(?!{_TOKEN}))",
}
BASE = ("email", "ip", "card", "phone")
#: kind -> (score of a valid span, words that raise it when they stand before it).
SCORES = {
    "email": (0.9, "mail|contact|write"),
    "ip": (0.6, "address|host|server|ip"),
    "card": (0.8, "card|visa|credit|payment"),
    "phone": (0.7, "phone|call|tel|mobile|fax"),
    "iban": (0.8, "iban|account|bank"),
    "ssn": (0.3, "ssn|social security|tax id"),
    "secret": (0.7, "token|key|secret|password"),
}
RAISE, NEAR, LEAST = 0.25, 40, 0.5
#: Strings of which one must occur for a pattern to match; it spares the others the search.
NEEDS = {"email": ("@",), "ip": (".",), "phone": ("+",), "ssn": ("-",), "secret": ("=", ":", "AKIA", "gh", "sk-", "xox")}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_STEP = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, wherever and however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _luhn(digits: Column) -> Column:
    def step(total: Column, k: Column) -> Column:
        d = F.substring(digits, F.length(digits) - k, 1).cast("int")
        return total + F.when(k % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _mod97(iban: Column) -> Column:
    def step(rest: Column, k: Column) -> Column:
        c = F.ascii(F.substring(iban, ((k + 4) % F.length(iban)) + 1, 1))
        return F.when(c < 65, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(0), F.length(iban) - 1), F.lit(0), step) == 1


def valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return let(F.replace(found, F.lit(" "), F.lit("")), _mod97)
    if kind == "secret":
        return found.rlike("[0-9]") & found.rlike("[A-Za-z]")
    return F.lit(True)


def _starts(lengths: Column) -> Column:
    """Prefix sums, over blocks of _STEP, so that thousands of matches in a text stay far from quadratic."""

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    def blocks(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(xs) - 1) / F.lit(_STEP)).cast("int")), lambda b: total(F.slice(xs, b * _STEP + 1, _STEP)))

    def within(bases: Column) -> Column:
        return F.transform(lengths, lambda _, i: F.element_at(bases, F.floor(i / F.lit(_STEP)).cast("int") + 1) + total(F.slice(lengths, F.floor(i / F.lit(_STEP)).cast("int") * _STEP + 1, i % _STEP)))

    def bases(sums: Column) -> Column:
        return F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))

    return let(blocks(lengths), lambda sums: let(bases(sums), within))


def _spans(kind: str, marked: Column) -> Column:
    """array<struct<kind, start, end, score>> of the valid matches, in order."""
    score, words = SCORES[kind]

    def of_pieces(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda p: F.length(p).cast("long"))

        def of_starts(starts: Column, sizes: Column) -> Column:
            odd = F.filter(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: i % 2 == 1)

            def span(i: Column) -> Column:
                near = F.lower(F.right(F.element_at(pieces, i), F.lit(NEAR)))
                raised = F.when(near.rlike(rf"\b(?:{words})"), F.lit(RAISE)).otherwise(F.lit(0.0))
                start = F.element_at(starts, i + 1)
                return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.element_at(sizes, i + 1)).alias("end"), F.least(F.lit(1.0), F.lit(score) + raised).alias("score"))

            return F.transform(F.filter(odd, lambda i: valid(kind, F.element_at(pieces, i + 1))), span)

        return let(lengths, lambda sizes: let(_starts(sizes), lambda starts: of_starts(starts, sizes)))

    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint, score: double>>")
    spans = F.when(F.instr(marked, MARK) > 0, let(F.split(marked, MARK, -1), of_pieces)).otherwise(none)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= LEAST)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array<struct<kind, start, end, score>> by kind as listed, then start; code points, end exclusive."""
    clean = docs.select(F.col("doc_id").alias("doc_id"), F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(MARK), F.lit(OTHER)).alias("clean"))

    def marked(kind: str) -> Column:
        found = F.regexp_replace("clean", PATTERNS[kind], f"{MARK}$0{MARK}")
        if kind not in NEEDS:
            return found
        may = F.lit(False)
        for needed in NEEDS[kind]:
            may = may | F.contains(F.col("clean"), F.lit(needed))
        return F.when(may, found).otherwise(F.lit(""))

    wrapped = clean.select("doc_id", *[marked(kind).alias(kind) for kind in PATTERNS])
    return wrapped.select("doc_id", F.concat(*[_spans(kind, F.col(kind)) for kind in PATTERNS]).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
