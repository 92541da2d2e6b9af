"""Context building and packing, source collection and answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import official as O
from tessella.functions import text as X
from tessella.operators.relational import first_wins

SEPARATOR = "\n\n---\n\n"
#: Parts into which the rows of a group are cut.
PARTS = 64


def packed(rows: DataFrame, limit: int = 12_000, counted: int = 5) -> DataFrame:
    """Rows (qid, rank, block) until the running length, `counted` characters for each separator from the second block
    on, exceeds the limit. Blank blocks don't count. The separator has seven characters though five are counted (trap Q6); counted=7 holds
    the limit exactly.

    Parts of a group are cut first, each where it is, behind its first row that exceeds the limit: that row does so among all rows too, and so does whatever follows it."""
    order = Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.withColumn("block", X.strip(F.col("block"))).where("block <> ''")
    part = Window.partitionBy("qid", "_part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    first = blocks.withColumn("_part", F.pmod(F.xxhash64("rank"), F.lit(PARTS)))
    running = lambda over: F.sum(F.length("block").cast("long") + counted).over(over) - counted
    return first.withColumn("_running", running(part) - F.length("block") - counted).where(F.col("_running") <= limit).drop("_part", "_running").withColumn("running", running(order)).where(F.col("running") <= limit)


def contexts(rows: DataFrame, limit: int = 12_000) -> DataFrame:
    """W02 alone: (qid, context, blocks) of whole blocks. A group whose first block overflows, or without any, has an empty context."""
    got = packed(rows, limit).groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "block"))).alias("b"))
    every = rows.select("qid").distinct().join(got, "qid", "left")
    blocks = F.coalesce(F.transform("b", lambda x: x["block"]), F.array().cast("array<string>"))
    return every.select("qid", F.array_join(blocks, SEPARATOR).alias("context"), F.size(blocks).alias("blocks"))


def headed(text: Column, code: Column, title: Column, source: Column, cap: int = 5_000) -> Column:
    """A document's block: its code and title, its source, and its text truncated to cap."""
    name = strip_pair(code, title)
    head = F.concat_ws("\n", F.nullif(name, F.lit("")), F.when(X.strip(source) != "", F.concat(F.lit(f"{O.DOCUMENT}: "), X.strip(source))))
    body = X.truncate_sentences(text, cap)
    return X.strip(F.when(head != "", F.concat(head, F.lit("\n"), body)).otherwise(body))


def strip_pair(code: Column, title: Column) -> Column:
    """`[code] title`; the brackets stay around an empty code if there is a title."""
    code, title = X.strip(code), X.strip_part(title)
    return F.when((code != "") | (title != ""), X.strip(F.concat(F.lit("["), code, F.lit("] "), title))).otherwise("")


def docs_to_context(rows: DataFrame, limit: int = 12_000, per_doc_cap: int = 5_000) -> DataFrame:
    """V14 over rows (qid, rank, text, work_code, title, source): (qid, context, blocks), a row for each group."""
    return contexts(rows.select("qid", "rank", headed(F.col("text"), F.col("work_code"), F.col("title"), F.col("source"), per_doc_cap).alias("block")), limit)


def sources(rows: DataFrame, columns: list[str], limit: int = 25) -> DataFrame:
    """Distinct source tuples in first-occurrence order, at most `limit` a query."""
    unique = first_wins(rows, ["qid", *columns], ["rank"])
    return unique.withColumn("source_rank", F.row_number().over(Window.partitionBy("qid").orderBy("rank"))).where(F.col("source_rank") <= limit)


def collected(rows: DataFrame, limit: int = 25) -> DataFrame:
    """V15 over rows (qid, rank, work_code, title, source, clause, page): (qid, sources array<struct>) by first occurrence."""
    labelled = rows.select("qid", "rank", X.source_label(*[F.col(c) for c in ("work_code", "title", "source", "clause", "page")]).alias("s")).select("qid", "rank", "s.*")
    parts = ["work_code", "title", "source_file", "anchor"]
    some = labelled.where(F.concat(*parts) != "")
    kept = sources(some, parts, limit)
    return kept.groupBy("qid").agg(F.transform(F.sort_array(F.collect_list(F.struct("source_rank", F.struct(*parts).alias("s")))), lambda x: x["s"]).alias("sources"))


def prompt(question: Column, context: Column) -> Column:
    """the user's part of a prompt."""
    return F.concat(F.lit("Контекст:\n"), context, F.lit(f"\n\n{O.QUESTION}: "), X.strip(question), F.lit(f"\n\n{O.ANSWER}: "))


def reflection(question: Column, context: Column, draft: Column) -> Column:
    """the second prompt shows the draft."""
    return F.concat(F.lit("Контекст:\n"), context, F.lit(f"\n\n{O.QUESTION}: "), X.strip(question), F.lit("\n\nDraft: "), draft)


def extractive(prompts: Column) -> Column:
    """The default generator: the first line of the first block after the context's heading, or the draft it is shown. It is no language model."""
    draft = F.regexp_extract(prompts, r"(?s)\n\nDraft: (.*)\z", 1)
    first = F.regexp_extract(prompts, r"\A[^\n]*\n([^\n]*)", 1)
    return F.when(draft != "", draft).otherwise(first)


def answered(rows: DataFrame, generate: Callable[[Column], Column] = extractive) -> DataFrame:
    """Rows (qid, question, context, sources) with answer: a draft, its revision, and the lines of its sources. An empty context
    has a fixed text, and so has a generator that gives null, which is how it says that it failed."""
    first = rows.withColumn("_said", generate(prompt(F.col("question"), F.col("context"))))
    drafts = first.withColumn("_draft", F.when(F.col("_said").isNotNull(), X.drafted(F.col("_said"))))
    again = drafts.withColumn("_said", F.when(F.col("_draft").isNotNull(), generate(reflection(F.col("question"), F.col("context"), F.col("_draft")))))
    made = again.withColumn("_revised", F.when(F.col("_said").isNotNull(), X.prefixed(X.strip(F.col("_said")))))
    empty = X.strip(F.col("context")) == ""
    done = F.when(empty, F.lit(O.NO_DATA)).when(F.col("_revised").isNull(), F.lit(O.FAILED)).otherwise(X.finish_answer(F.col("_revised"), F.col("sources")))
    return made.withColumn("answer", done).drop("_said", "_draft", "_revised")
