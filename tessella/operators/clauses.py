"""Clause and sub-clause chunks of numbered documents."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import official as O
from tessella.operators.chunking import force_split, merge_small
from tessella.operators.relational import small_batches

NUMBER = r"\d+(?:\.\d+){0,3}"
CLAUSE = re.compile(rf"(?:^|\n)\s*({NUMBER})\.\s+")
TABLE = re.compile(rf"(?:^|\n)\s*{O.TABLE}\s+({NUMBER})\s*", re.I)
SUB = re.compile(r"(?:^|\n)\s*(\d+|[а-яё])\)\s+", re.I)
MARK = re.compile(O.PAGE_MARK)
CLAUSE_TITLE, TABLE_TITLE = re.compile(rf"{NUMBER}\.\s*(.+?)(?:\n|$)"), re.compile(rf"{O.TABLE}\s+{NUMBER}\s*(.+)", re.I)
FOOTER, NOTE, ARTIFACT = re.compile("|".join(O.FOOTERS), re.I), re.compile(O.NOTES, re.I), re.compile(O.ARTIFACTS, re.I)
SCHEMA = "chunk_id string, doc_id string, clause string, subclause string, title string, level int, parent_id string, has_children boolean, page_start int, page_end int, text string"


def clean(text: str) -> str:
    """F05, for use inside the chunker, after page marks are gone."""
    out = MARK.sub("", text).translate({13: " ", 160: " "})
    out = FOOTER.sub("", ARTIFACT.sub(O.ARTIFACT_WORD, out))
    out = re.sub(r"\n{3,}", "\n\n", re.sub(r"(\w)-\s*\n\s*(\w)", r"\1\2", out))
    return re.sub(r"[ \t]+", " ", out).strip()


def edited(text: str) -> str:
    """F05, then F06."""
    return clean(NOTE.sub("", clean(text)))


def boundaries(text: str) -> list[tuple[int, str, bool]]:
    """(offset, number, is a table) in order. A clause whose match starts right after a letter doesn't count: the match
    begins at the line feed, so that a line which ends in a letter hides the number below it (trap Q5)."""
    found = [(m.start(), m[1], False) for m in CLAUSE.finditer(text) if m.start() == 0 or not text[m.start() - 1].isalpha()]
    return sorted([*found, *((m.start(), m[1], True) for m in TABLE.finditer(text))], key=lambda x: x[0])


def sub_boundaries(block: str) -> list[tuple[int, str]]:
    """(offset, label); a letter of the alphabet counts only if it comes after the last one less two, other labels always do."""
    out, last = [], -1
    for m in SUB.finditer(block):
        at = O.ALPHABET.find(m[1])
        if at < 0 or at > last - 2:
            out.append((m.start(), m[1]))
            last = at if at >= 0 else last
    return out


def pages(text: str, default: tuple[int, int]) -> tuple[int, int]:
    found = [int(p) for p in MARK.findall(text)]
    low, high = (min(found), max(found)) if found else (0, 0)
    return (low if low > 0 else default[0], high if high > 0 else default[1])


def clause_rows(text: str | None, doc: str, least: int = 50, intro_least: int = 30, most: int = 1500, table_most: int = 2000) -> Iterator[tuple]:
    """The rows of one document, in order. Blocks keep their numbers and labels. Clauses and tables share the counter
    that tells repeated numbers apart; a document without pages has 0 for them. A repeated label repeats its id (trap Q25),
    and a clause whose text before its first label is short has no row of its own (trap Q26)."""
    text = (text or "").strip()
    if not text:
        return
    every = pages(text, (0, 0))

    def rows(made: str, stem: str, clause: str, label: str | None, title: str, level: int, parent: str | None, children: bool, at: tuple[int, int], limit: int, merge: bool = True) -> Iterator[tuple]:
        parts = [{"text": t, "page_end": at[1]} for t in force_split(made, limit)]
        parts = merge_small(parts, limit) if merge else parts
        for k, part in enumerate(parts, 1):
            yield (stem if len(parts) == 1 else f"{stem}.{k}", doc, clause, label, title, level, parent, children, at[0], part["page_end"], part["text"])

    marks = boundaries(text)
    head = text[: marks[0][0]].strip() if marks else text
    made = clean(head)
    if len(made) >= least:
        yield from rows(made, f"{doc}__0", "0", None, O.INTRODUCTION if marks else O.WHOLE, 1, None, False, pages(head, every), most, merge=False)
    seen: Counter = Counter()
    for (start, number, table), end in zip(marks, [*(m[0] for m in marks[1:]), len(text)], strict=False):  # without marks, none
        seen[number] += 1
        clause = number if seen[number] == 1 else f"{number}_{seen[number]}"
        stem, block = f"{doc}__{clause}", text[start:end].strip()
        at = pages(block, every)
        found = (TABLE_TITLE if table else CLAUSE_TITLE).search(block)
        title = found[1].strip()[:150] if found else f"{O.TABLE if table else O.CLAUSE} {number}"
        subs = sub_boundaries(block)
        made = edited(block[: subs[0][0]].strip() if subs else block)
        if made and len(made) >= (intro_least if subs else least):
            yield from rows(made, stem, clause, None, title, 1, None, bool(subs), at, table_most if table and not subs else most)
        for (a, label), b in zip(subs, [*(x[0] for x in subs[1:]), len(block)], strict=False):  # without subs, none
            made = edited(block[a:b].strip())
            if len(made) >= least:
                yield from rows(made, f"{stem}__{label}", clause, label, title, 2, stem, False, at, most)


def clause_chunks(docs: DataFrame, least: int = 50) -> DataFrame:
    """T04 over documents (doc_id, text); rows under `least` characters go."""
    names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for d, t in zip(frame["doc_id"], frame["text"], strict=True) for r in clause_rows(t, str(d), least) if len(r[-1]) >= least]
            yield pd.DataFrame(rows, columns=names)

    return small_batches(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, SCHEMA)


def reassembled(parts: DataFrame) -> DataFrame:
    """Clauses from their parts (doc, clause, part, line, text, page_start, page_end), in part order."""
    rows = parts.groupBy("doc", "clause").agg(
        F.sort_array(F.collect_list(F.struct("part", "line", "text"))).alias("p"),
        F.min("page_start").alias("page_start"),
        F.max("page_end").alias("page_end"),
        F.min("line").alias("first_line"),
        F.count(F.lit(1)).alias("orig_parts"),
    )
    return rows.select("doc", "clause", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("text"), "page_start", "page_end", "first_line", "orig_parts")
