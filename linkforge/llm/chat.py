"""Relational chat formatting with Spark expressions only.

Grammar of the output: block* where block = ``### `` role newline (text ``</turn>``)+. Adjacent
turns of one role share a block. Inside roles and texts a backslash is written as backslash-s,
``#`` as backslash-h, ``<`` as backslash-l (in roles, a newline as backslash-n), so no control
string can occur in them, and decoding is three plain replacements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>"
CODES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))


def escape(c: Column, role: bool = False) -> Column:
    for plain, code in (*CODES, *([("\n", "\\n")] if role else [])):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, role: bool = False) -> Column:
    for plain, code in (*([("\n", "\\n")] if role else []), *reversed(CODES)):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once: a column that a lambda names may be computed for
    each of its elements."""
    return F.get(F.transform(F.array(value), body), 0)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (array of start, end in code
    points, end exclusive, of the escaped text of each ``loss_role`` turn).

    Turns go by number, nulls first; ties by role, then text, and repeated rows stay. Null texts
    and roles are empty. Rows of null conv_id form one conversation. Other columns, whatever
    their names, are not read. An empty table gives no rows. A conversation is one output value,
    so its turns meet in one row; nothing else is gathered, and every step over the turns is linear
    in them but for their sort.
    """
    part = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = part.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    # where a block starts: the first turn, and each turn whose role differs from the one before
    starts = lambda t: F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
    block = lambda t, s: lambda at, k: F.struct(
        F.get(t, at)["role"].alias("role"),
        F.transform(F.sequence(at, F.coalesce(F.get(s, k + 1), F.size(t)) - 1), lambda i: F.concat(escape(F.get(t, i)["text"]), F.lit(END))).alias("texts"),
    )
    merged = let(F.col("t"), lambda t: let(starts(t), lambda s: F.transform(s, block(t, s))))
    grouped = grouped.select("conv_id", merged.alias("b"))
    line = lambda b: F.concat(F.lit(HEAD), escape(b["role"], True), F.lit("\n"))
    formatted = F.array_join(F.transform("b", lambda b: F.concat(line(b), F.array_join(b["texts"], ""))), "")
    # pieces with their lengths: a header with the flag false, a turn with the flag of its role
    lengths = F.flatten(F.transform("b", lambda b: F.concat(
        F.array(F.struct(F.length(line(b)).alias("n"), F.lit(False).alias("on"))),
        F.transform(b["texts"], lambda x: F.struct(F.length(x).alias("n"), (b["role"] == loss_role).alias("on"))),
    )))
    # their ends are a running sum over the pieces of a conversation, which its rows are dealt by
    # already; the string goes with the first piece
    first = F.transform(lengths, lambda x, i: F.struct(x["n"].alias("n"), x["on"].alias("on"), F.when(i == 0, formatted).alias("f")))
    pieces = grouped.select("conv_id", first.alias("l")).select("conv_id", F.posexplode("l").alias("pos", "x")).select("conv_id", "pos", "x.*")
    end = F.sum("n").over(Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    span = F.struct((F.col("end") - F.col("n")).cast("int").alias("start"), (F.col("end") - len(END)).cast("int").alias("end"))
    return pieces.withColumn("end", end).groupBy("conv_id").agg(
        F.get(F.collect_list("f"), 0).alias("formatted"), F.sort_array(F.collect_list(F.when(F.col("on"), span))).alias("loss_spans"))


def parse_chats(formatted: Column) -> Column:
    """Array of (role, text) structs read back from the formatted string."""
    parts = F.split(formatted, HEAD)
    blocks = F.slice(parts, F.lit(2), F.size(parts))
    cut = lambda b: F.instr(b, "\n")

    def turns(b: Column) -> Column:
        texts = F.split(F.substr(b, cut(b) + 1), END)
        role = unescape(F.substring_index(b, "\n", 1), True)
        return F.transform(F.slice(texts, 1, F.size(texts) - 1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. Spans are cut out of the code points
    at four bytes each, where a place is found without reading what comes before it."""
    piece = lambda wide: lambda s: F.decode(F.substring(wide, s["start"] * 4 + 1, (s["end"] - s["start"]) * 4), "UTF-32")
    return unescape(F.array_join(let(F.encode(formatted, "UTF-32"), lambda wide: F.transform(spans, piece(wide))), ""))


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted strings hold, read back from them."""
    t = chats.withColumns({"turns": parse_chats(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return t.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
