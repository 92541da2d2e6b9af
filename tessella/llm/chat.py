"""Chat formatting with a grammar round trip, in DataFrame operations only.

A conversation is its turns in order, each as

    ### <Label>: <body> </turn>\\n

Label is User, Assistant or System for those roles in lower case, and = with the URL-encoded role for any other. The
parser is deterministic: the text is split at every `</turn>` that has no backslash before it, each piece must be
a header and a body, a body may hold no run of three or more # without a backslash before it, and in bodies
a backslash before a backslash, such a run or `</turn>` goes away.

Turns are rendered as they are, reparsed and compared with their source; those that don't come back identical are
rendered again with their content escaped, which always comes back. The whole conversation is parsed once more and
compared. The loss mask holds the bodies of assistant turns, in code points of the formatted text.

Defined results: null texts and roles are empty; rows that tie on turn are ordered by role and text, rows without
turn come first, repeated rows are turns of their own; rows without conv_id are one conversation. An empty table gives
no rows. A conversation is one row of the result, so it must fit into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}
CLOSE = " </turn>\n"
CONTROL = r"(\\|#{3,}|</turn>)"
HEADER = r"(?s)^\n?### (User|Assistant|System|=[^:\\#\s]*): (.*) \z"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, r"\\" + CONTROL, "$1")


def label(role: Column) -> Column:
    out = F.concat(F.lit("="), F.url_encode(role))
    for name, shown in LABELS.items():
        out = F.when(role == name, F.lit(shown)).otherwise(out)
    return out


def role_of(shown: Column) -> Column:
    out = F.url_decode(F.substring(shown, 2, 1 << 30))
    for name, known in LABELS.items():
        out = F.when(shown == known, F.lit(name)).otherwise(out)
    return out


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit("### "), label(role), F.lit(": "), body, F.lit(CLOSE))


def parsed(formatted: Column) -> Column:
    """array<struct<role, text>>; a piece that isn't a turn of the grammar gives nulls."""
    pieces = F.filter(F.split(formatted, r"(?<!\\)</turn>", -1), lambda p, i: ~((p == "\n") & (i > 0)))

    def turn(p: Column) -> Column:
        body = F.regexp_extract(p, HEADER, 2)
        good = p.rlike(HEADER) & ~body.rlike(r"(?<![\\#])#{3,}")
        return F.struct(F.when(good, role_of(F.regexp_extract(p, HEADER, 1))).alias("role"), F.when(good, unescaped(body)).alias("text"))

    return F.transform(pieces, turn)


def source(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask (array<struct<start, end>>), turns (as parsed back), escaped_turns, identical."""
    narrow = rows.select(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = narrow.withColumn("plain", rendered(F.col("role"), F.col("text")))
    back = F.array(source(F.col("role"), F.col("text")))
    # Compared field by field: null from a failed parse is a difference.
    checked = plain.withColumn("same", parsed(F.col("plain")).eqNullSafe(back))
    shown = checked.withColumn("body", F.when(F.col("same"), F.col("text")).otherwise(escaped(F.col("text"))))
    turns = shown.select("conv_id", "turn", "role", "text", "same", rendered(F.col("role"), F.col("body")).alias("shown"), F.length("body").alias("size"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("shown").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = before + F.length("shown") - len(CLOSE)
    spread = turns.withColumns({"number": F.row_number().over(order), "start": end - F.col("size"), "end": end})
    told = spread.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("number", "role", "text", "shown", "start", "end", "same"))).alias("rows"))
    made = told.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["shown"]), "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["role"] == "assistant"), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("loss_mask"),
        F.transform("rows", lambda r: source(r["role"], r["text"])).alias("given"),
        F.size(F.filter("rows", lambda r: ~r["same"])).alias("escaped_turns"),
    )
    read = made.withColumn("turns", parsed(F.col("formatted")))
    return read.select("conv_id", "formatted", "loss_mask", "turns", "escaped_turns", F.col("turns").eqNullSafe(F.col("given")).alias("identical"))


def loss_text(formatted: Column, mask: Column) -> Column:
    """What the mask covers, read from the formatted text and unescaped, nothing between the spans."""
    return F.array_join(F.transform(mask, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
