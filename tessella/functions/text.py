"""Scalar text expressions (F01-F15, F20-F32): Catalyst expressions only, Unicode classes throughout."""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions import official as O

NBSP = " "
#: What `(?U)\\s` matches.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
CODE = r"(?U)\b\d{2}-\d{2}-\d{3}-\d{2}\b"
#: The letters that the quality figures count.
LETTERS = r"[A-Za-zА-Яа-яЁё]"


def strip(c: Column) -> Column:
    """Unicode white space off both ends; null becomes empty."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE))


#: First characters of patterns, and all that match them in any case.
FIRST = {c: c for c in "№©—"} | {c: c + c.swapcase() + {"k": "\u212a", "s": "\u017f"}.get(c.lower(), "") for c in ascii_letters} | {chr(n): "\u0400-\u045f\u1c80-\u1c88" for n in range(0x410, 0x450)}


def guarded(patterns: Sequence[str]) -> str:
    """The alternatives as one pattern, tried only where one of their first characters may stand, if all of them begin with a character as such."""
    plain = all(p and p[0] in FIRST and "|" not in p and p[1:2] not in ("*", "?", "{") for p in patterns)
    return (f"(?=(?-iuU:[{''.join(sorted({FIRST[p[0]] for p in patterns}))}]))" if plain else "") + f"(?:{'|'.join(patterns)})"


def first_nonempty(*cs: Column) -> Column:
    """The first argument that isn't null or empty, stripped; null if none is (an empty string is as good as absent)."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cs])


def lenient_int(c: Column, default: int | None = None) -> Column:
    """integers from numbers or numeric strings, towards zero, else the default."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(default).cast("int"))


def clean_text(c: Column) -> Column:
    """no-break spaces, runs of blanks, runs of line feeds, blanks before line feeds, in this order."""
    out = strip(F.replace(c, F.lit(NBSP), F.lit(" ")))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(out, r"[ \t]+\n", "\n"))


def clean_page(c: Column, footers: Sequence[str] = O.FOOTERS, artifacts: tuple[str, str] = (O.ARTIFACTS, O.ARTIFACT_WORD)) -> Column:
    """carriage returns and no-break spaces become blanks; artefacts, footers, hyphens at line ends, runs of three
    line feeds and of blanks go, in this order. A footer leaves nothing, not even a blank."""
    out = F.translate(F.coalesce(c, F.lit("")), "\r" + NBSP, "  ")
    out = F.regexp_replace(out, f"{O.FLAGS}{artifacts[0]}", artifacts[1])
    if footers:
        out = F.regexp_replace(out, f"{O.FLAGS}(?d){guarded(footers)}", "")
    out = F.regexp_replace(out, r"(?Us)(?=.-)(\w)-\s*\n\s*(\w)", "$1$2")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(out, r"[ \t]+", " "))


def drop_notes(c: Column, notes: str = O.NOTES, footers: Sequence[str] = O.FOOTERS) -> Column:
    """editorial parentheses go, then F05."""
    return clean_page(F.regexp_replace(c, f"{O.FLAGS}(?d){notes}", ""), footers)


def drop_stamps(c: Column, stamps: str = O.STAMPS) -> Column:
    """lines that hold a stamp and blank lines go."""
    lines = F.split(F.coalesce(c, F.lit("")), "\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]", -1)
    return strip(F.array_join(F.filter(lines, lambda x: (strip(x) != "") & ~x.rlike(f"{O.FLAGS}{guarded(stamps.split('|')) if '(' not in stamps else stamps}")), "\n"))


def quality(c: Column) -> Column:
    """struct<len, letter_ratio, digit_ratio, noisy>; an empty text is noisy."""
    n = F.length(c)
    letters = F.regexp_count(c, F.lit(LETTERS)) / n
    digits = F.regexp_count(c, F.lit("[0-9]")) / n
    empty = F.coalesce(n == 0, F.lit(True))
    zero = F.lit(0.0)
    return F.struct(
        F.coalesce(n, F.lit(0)).alias("len"),
        F.when(empty, zero).otherwise(F.round(letters, 4)).alias("letter_ratio"),
        F.when(empty, zero).otherwise(F.round(digits, 4)).alias("digit_ratio"),
        F.when(empty, F.lit(True)).otherwise((letters < 0.3) & (digits > 0.3)).alias("noisy"),
    )


def page_range(c: Column) -> Column:
    """struct<low, high> of the page marks, zeros without any."""
    pages = F.transform(F.regexp_extract_all(c, F.lit(O.PAGE_MARK), F.lit(1)), lambda p: p.cast("int"))
    none = F.lit(0)
    return F.struct(F.coalesce(F.array_min(pages), none).alias("low"), F.coalesce(F.array_max(pages), none).alias("high"))


def strip_page_marks(c: Column) -> Column:
    return F.regexp_replace(c, O.PAGE_MARK, "")


def strip_part(c: Column, part: str = O.PART) -> Column:
    """a trailing part suffix goes."""
    return strip(F.regexp_replace(strip(c), f"{O.FLAGS}{part}", ""))


def signature(chunk_id: Column, text: Column) -> Column:
    """by id, else by the first 220 characters."""
    cid = strip(chunk_id.cast("string"))
    return F.when(cid != "", F.concat(F.lit("cid:"), cid)).otherwise(F.concat(F.lit("txt:"), F.substring(strip(text), 1, 220)))


def truncate_title(c: Column, limit: int = 200) -> Column:
    """F21."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("…"))).otherwise(c)


def rate_code(c: Column) -> Column:
    """the first code of the form NN-NN-NNN-NN, or empty."""
    return F.regexp_extract(c, CODE, 0)


def qa_text(question: Column, answer: Column) -> Column:
    """F22."""
    return F.concat(F.lit(f"{O.QUESTION}: "), question, F.lit(f"\n\n{O.ANSWER}: "), answer)


def uniq(xs: Column) -> Column:
    """F32: stripped non-empty strings in first-occurrence order."""
    return F.array_distinct(F.filter(F.transform(xs, strip), lambda x: x != ""))


def tokens(c: Column) -> Column:
    """White space tokens, case kept."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda x: x != "")


def scoring_sentences(c: Column) -> Column:
    """stripped sentences longer than 15 characters that aren't only digits and signs (trap Q1)."""
    parts = F.transform(F.split(c, f"(?dU){O.SENTENCE_GAP}+", -1), strip)
    return F.filter(parts, lambda s: (F.length(s) > 15) & ~s.rlike(r"(?U)^[\W\d]+$"))


def truncate_sentences(c: Column, cap: int, spaced: bool = False, mark: str = O.CUT) -> Column:
    """the longest prefix of sentences whose running length, a blank counted before each but the first, stays within
    cap, else a hard cut; a mark follows a shorter result. Sentences join without the blank (trap Q2), or with it if spaced."""
    whole = strip(c)
    parts = F.filter(F.transform(F.split(whole, f"(?dU){O.SENTENCE_GAP}", -1), strip), lambda x: x != "")

    def step(acc: Column, x: Column) -> Column:
        n = acc["n"] + F.length(x) + F.when(acc["n"] > 0, 1).otherwise(0)
        fits = ~acc["done"] & (n <= cap)
        return F.struct(F.when(fits, F.concat(acc["text"], F.when(acc["n"] > 0, F.lit(" " if spaced else "")).otherwise(""), x)).otherwise(acc["text"]).alias("text"), F.when(fits, n).otherwise(acc["n"]).alias("n"), (~fits).alias("done"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(False).alias("done"))
    kept = F.aggregate(parts, start, step, lambda a: strip(a["text"]))
    cut = F.when(kept == "", F.substring(whole, 1, cap)).otherwise(kept)
    marked = F.when(F.length(cut) < F.length(whole), F.concat(cut, F.lit(mark))).otherwise(cut)
    return F.when(F.lit(cap <= 0) | (F.length(whole) <= cap), whole).otherwise(marked)


def weighted_score(relevance: Column, faith: Column, answer: Column, weights: tuple[float, float, float] = (1.0, 1.2, 1.1)) -> Column:
    """F28."""
    return weights[0] * relevance + weights[1] * faith + weights[2] * answer


def source_label(code: Column, title: Column, source: Column, clause: Column, page: Column) -> Column:
    """struct<work_code, title, source_file, anchor>; clause and page stand in parentheses after a blank, if there are any."""
    clause, page = strip(clause), strip(page.cast("string"))
    inside = F.concat_ws(", ", F.when(clause != "", F.concat(F.lit("п. "), clause)), F.when(page != "", F.concat(F.lit("стр. "), page)))
    anchor = F.when(inside != "", F.concat(F.lit(" ("), inside, F.lit(")"))).otherwise("")
    return F.struct(strip(code).alias("work_code"), strip_part(title).alias("title"), strip(source).alias("source_file"), anchor.alias("anchor"))


def source_line(s: Column) -> Column:
    """the line of a source struct, empty if it says nothing but its dash."""
    main = strip(F.concat(F.when(s["work_code"] != "", F.concat(F.lit("["), s["work_code"], F.lit("] "))).otherwise(""), s["title"]))
    tail = F.when(s["source_file"] != "", strip(F.concat(F.lit(" — "), s["source_file"], s["anchor"]))).otherwise(s["anchor"])
    return strip(F.concat(F.lit("- "), F.when(main == "", F.lit(O.DOCUMENT)).otherwise(main), tail))


def prefixed(c: Column, prefix: str = O.ANSWER) -> Column:
    """The answer's prefix, where a text that isn't empty doesn't begin with it in any case."""
    return F.when((c != "") & ~F.lower(c).startswith(prefix.lower()), F.concat(F.lit(f"{prefix}: "), c)).otherwise(c)


def drafted(c: Column) -> Column:
    """F24, the draft: a heading of sources goes only where one more of its signs stands around it (trap Q4), question lines
    go, runs of line feeds shrink first."""
    body = F.regexp_replace(strip(c), rf"{O.FLAGS}\n\s*[{{0,2}}\s]{O.SOURCES}\s*[{{0,2}}\s]:?\s*\n", "")
    body = F.regexp_replace(F.regexp_replace(body, r"\n{3,}", "\n\n"), rf"(?imuUd)^\s*{O.QUESTION}\s*:\s*.*$", "")
    return prefixed(strip(body))


def finish_answer(c: Column, sources: Column, limit: int = 20) -> Column:
    """F24, the end: the prefix, and at most `limit` distinct lines of sources (array<struct> of F12)."""
    lines = F.slice(uniq(F.transform(sources, source_line)), 1, limit)
    body = prefixed(strip(c))
    return F.when(F.size(lines) > 0, F.concat(F.rtrim(body), F.lit(f"\n\n{O.SOURCES}:\n"), F.array_join(lines, "\n"))).otherwise(body)


def coerced(c: Column, kind: str) -> Column:
    """numbers, booleans and strings as they are; arrays, maps and structs as JSON with null members; anything else as stripped text."""
    if kind.startswith(("array", "map", "struct")):
        return F.nullif(F.to_json(c, {"ignoreNullFields": "false"}), F.lit(""))
    if kind in ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double"):
        return c
    return F.nullif(strip(c.cast("string")), F.lit(""))


def embedder_text(c: Column, prefix: str = "search_document: ") -> Column:
    """what an embedder with task prefixes reads."""
    return F.concat(F.lit(prefix), F.coalesce(c, F.lit("")))


def optional_dims(value: str | None) -> int | None:
    """an optional size from a setting; comments, blanks, 0 and what isn't a number mean none."""
    try:
        return int((value or "").split("#", 1)[0]) or None
    except ValueError:
        return None
