"""Sequential chunkers (T01-T08, F15): state machines over one text each, as Arrow-batched UDFs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tessella.functions import text as X
from tessella.operators.relational import small_batches

SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def _pieces(text: str, separator: str) -> list[str]:
    """Split with the separator at the start of the piece that follows it."""
    if separator == "":
        return list(text)
    first, *rest = text.split(separator)
    return [p for p in (first, *(separator + r for r in rest)) if p]


def _merge(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    window: list[str] = []
    total = 0
    for part in parts:
        if window and total + len(part) > size:
            if made := "".join(window).strip():
                yield made
            while window and (total > overlap or (total + len(part) > size and total > 0)):
                total -= len(window.pop(0))
        window.append(part)
        total += len(part)
    if made := "".join(window).strip():
        yield made


def recursive_split(text: str, size: int = 1500, overlap: int = 300, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """The coarsest separator that occurs, finer ones for pieces that are still too long."""
    at = next(k for k, s in enumerate(separators) if s == "" or s in text)
    finer = separators[at + 1 :]
    out: list[str] = []
    small: list[str] = []
    for piece in _pieces(text, separators[at]):
        if len(piece) < size:
            small.append(piece)
            continue
        out += _merge(small, size, overlap)
        small = []
        out += recursive_split(piece, size, overlap, finer) if finer else [piece]
    return [*out, *_merge(small, size, overlap)]


def tidy(text: str) -> str:
    """F04, for use inside the chunkers."""
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text.replace("\xa0", " ").strip()))
    return re.sub(r"[ \t]+\n", "\n", text).strip()


def tidy_chunks(text: str | None, size: int = 1500, overlap: int = 300) -> list[str]:
    """A text is cleaned before it is split, and each chunk once more."""
    clean = tidy(text or "")
    return [c for c in map(tidy, recursive_split(clean, size, overlap)) if c] if clean else []


def recursive_chunks(docs: DataFrame, size: int = 1500, overlap: int = 300) -> DataFrame:
    """(doc_id, part, chunk, total_parts), parts counted from 1; null and blank texts give no rows."""

    @F.pandas_udf(ArrayType(StringType()))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: tidy_chunks(t, size, overlap))

    parts = small_batches(docs).select("doc_id", split("text").alias("chunks"))
    return parts.select("doc_id", F.size("chunks").alias("total_parts"), F.posexplode("chunks").alias("part", "chunk")).withColumn("part", F.col("part") + 1)


def merge_split(docs: DataFrame, size: int = 1500, overlap: int = 300, least: int = 100) -> DataFrame:
    """Texts are cleaned; only those over twice the size are split; `__p<i>` marks parts of several; short ones go after
    numbering. A text that the splitter leaves nothing of stays whole."""

    @F.pandas_udf(ArrayType(StringType()))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: tidy_chunks(t, size, overlap) or [t])

    # Only long texts meet Python.
    clean = small_batches(docs).select("doc_id", X.clean_text(F.col("text")).alias("text")).where("text <> ''")
    long = F.length("text") > 2 * size
    several = clean.where(long).select("doc_id", split("text").alias("chunks"))
    parts = several.unionByName(clean.where(~long).select("doc_id", F.array("text").alias("chunks")))
    rows = parts.select("doc_id", F.size("chunks").alias("total_parts"), F.posexplode("chunks").alias("part", "chunk")).withColumn("part", F.col("part") + 1)
    name = F.concat(F.col("doc_id").cast("string"), F.when(F.col("total_parts") > 1, F.concat(F.lit("__p"), F.col("part").cast("string"))).otherwise(F.lit("")))
    return rows.where(F.length("chunk") >= least).select(name.alias("chunk_id"), "doc_id", "part", "total_parts", "chunk")


def split_sentences(text: str) -> list[str]:
    """white space becomes single blanks; sentences end after every ! and ?; a full stop ends one only as the first character (trap Q3)."""
    flat = re.sub(r"\s+", " ", text)
    found = re.findall(r"\A\.|[^!?]*[!?]|[^!?]+", flat)
    return [s for s in map(str.strip, found) if s]


def pack(parts: list[str], most: int) -> list[str]:
    """Parts joined by blanks while they stay within most; a single part may be longer."""
    out: list[str] = []
    held = ""
    for part in parts:
        if held and len(held) + 1 + len(part) > most:
            out.append(held.strip())
            held = part
        else:
            held = f"{held} {part}" if held else part
    return [*out, held.strip()] if held else out


def force_split(text: str, most: int = 1500, overlap: int = 100) -> list[str]:
    """Sentences packed greedily, and what is still too long in overlapping windows; a text of one sentence is packed by words alone."""
    if len(text) <= most:
        return [text]
    sentences = split_sentences(text)
    if len(sentences) <= 1:
        return pack(text.split(), most)
    out: list[str] = []
    for held in pack(sentences, most):
        out += [held[a : a + most].strip() for a in range(0, len(held), most - overlap)] if len(held) > most else [held]
    return out


def merge_small(chunks: list[dict], most: int) -> list[dict]:
    """Neighbours of the same parent and sub-clause join while their lengths stay within most. The blank between them isn't counted
    for the pair at hand, but is part of what was joined before; the last page is the greater."""
    out: list[dict] = []
    for c in chunks:
        last = out[-1] if out else None
        if last and all(last.get(k) == c.get(k) for k in ("parent_id", "subclause")) and len(last["text"]) + len(c["text"]) <= most:
            out[-1] = last | {"text": f"{last['text']} {c['text']}", "page_end": max(last.get("page_end", 0), c.get("page_end", 0))}
        else:
            out.append(dict(c))
    return out


def sentence_chunks(docs: DataFrame, most: int = 1500) -> DataFrame:
    """T07 over documents: (doc_id, part, chunk)."""

    @F.pandas_udf(ArrayType(StringType()))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: force_split(t, most) if t else [])

    return small_batches(docs).select("doc_id", F.posexplode(split("text")).alias("part", "chunk"))
