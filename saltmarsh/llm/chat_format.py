"""Chat formatting with a grammar that reads back exactly what was written. DataFrame functions only.

A turn is rendered as ``### role: text</turn>`` and a newline. Control strings inside a text are escaped only as
far as needed: a turn is rendered as it stands, read again by the parser below and compared with its source; on a
difference the control strings are escaped, and if that still reads differently, the escape character as well.
The last form always reads back: each backslash in it starts an escape.

Escapes: ``</turn>`` as backslash t, ``###`` as backslash h, backslash as backslash b; inside roles also the colon
as backslash c. The parser undoes them in every turn, so no turn needs a mark of how it was escaped.

Defined cases: null text or role is empty; turns of a conversation go by (turn, role, text), nulls first; repeated
rows are turns of their own; a null conv_id is a conversation of its own; an empty table gives no rows; other
columns of the input are not read. A conversation is one output value, so it has to fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>"
TURN_END = CLOSE + "\n"
MARK = "###"


def _controls(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(CLOSE), F.lit("\\t")), F.lit(MARK), F.lit("\\h"))


def _full(c: Column) -> Column:
    return _controls(F.replace(c, F.lit("\\"), F.lit("\\b")))


def _role(c: Column) -> Column:
    return F.replace(_full(c), F.lit(":"), F.lit("\\c"))


def unescape(c: Column) -> Column:
    """Undo the escapes of a text; the backslash comes last so that it starts no new escape."""
    c = F.replace(F.replace(c, F.lit("\\t"), F.lit(CLOSE)), F.lit("\\h"), F.lit(MARK))
    return F.replace(c, F.lit("\\b"), F.lit("\\"))


def parse_turn(segment: Column) -> Column:
    """A rendered turn without its end -> struct(role, text); null where the grammar is broken."""
    body = F.substr(segment, F.lit(len(OPEN) + 1))
    at = F.instr(body, SEPARATOR)
    broken = ~F.startswith(segment, F.lit(OPEN)) | (at == 0) | F.contains(body, F.lit(MARK)) | F.contains(body, F.lit(CLOSE))
    role = F.replace(F.substr(body, F.lit(1), at - 1), F.lit("\\c"), F.lit(":"))
    return F.when(~broken, F.struct(unescape(role).alias("role"), unescape(F.substr(body, at + len(SEPARATOR))).alias("text")))


def segments(formatted: Column) -> Column:
    """The turns of a formatted conversation; what follows the last end must be empty."""
    parts = F.split(formatted, TURN_END, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def parse(formatted: Column) -> Column:
    """Formatted conversation -> array of struct(role, text)."""
    return F.transform(segments(formatted), parse_turn)


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_mask.

    loss_mask has one struct a turn: whether its text is under the loss, and the text's place (start and length in code
    points) inside its rendered turn, so that a reader walks turns and mask side by side.
    """
    src = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    head = src.withColumn("head", F.concat(F.lit(OPEN), _role(F.col("role")), F.lit(SEPARATOR)))

    def reads_back(body: Column) -> Column:
        whole = F.concat(F.col("head"), body, F.lit(TURN_END))
        return F.coalesce(parse(whole) == F.array(F.struct(F.col("role"), F.col("text"))), F.lit(False))

    plain, controls = F.col("text"), _controls(F.col("text"))
    rendered = head.withColumn("body", F.when(reads_back(plain), plain).when(reads_back(controls), controls).otherwise(_full(F.col("text"))))
    turns = rendered.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "head", "body"))).alias("turns"))
    mask = F.transform("turns", lambda t: F.struct((t["role"] == loss_role).alias("loss"), F.char_length(t["head"]).alias("start"), F.char_length(t["body"]).alias("length")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))), "")
    return turns.select("conv_id", formatted.alias("formatted"), mask.alias("loss_mask"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))


def verified(formatted: DataFrame) -> DataFrame:
    """Formatted conversations with their turns as read back; a conversation that reads differently is an error."""
    back = formatted.withColumn("parsed", parse(F.col("formatted")))
    same = F.col("parsed") == F.col("source")
    return back.withColumn("parsed", F.when(same, F.col("parsed")).otherwise(F.raise_error(F.lit("a conversation does not read back")).cast(back.schema["parsed"].dataType)))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text holds, read back from it: counts and digests of its turns and of the text under the loss."""
    read = verified(formatted).withColumn("under_loss", F.array_join(F.zip_with(segments(F.col("formatted")), F.col("loss_mask"), lambda s, m: F.when(m["loss"], unescape(F.substr(s, m["start"] + 1, m["length"]))).otherwise(F.lit(""))), ""))
    turns = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("under_loss").cast("long").alias("loss_chars"),
        F.sha2("under_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
