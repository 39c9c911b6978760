r"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn reads `<|im_start|>ROLE\nTEXT<|im_end|>\n`. Every turn is rendered, read back by the
parser and compared with its source; where that differs, its content is escaped, after which
it always reads back the same:

- in texts and roles, `<`, any number of backslashes and `|` get one more backslash;
- in roles, a backslash becomes `\b` and a line break `\n`, so that the role ends its line.

The parser takes one backslash away again; other content is never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
AT_START, AT_END = r"<\|im_start\|>", r"<\|im_end\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    inner = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    return escape(inner)


def unescape_role(role: Column) -> Column:
    inner = F.replace(unescape(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(inner, F.lit("\\b"), F.lit("\\"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text). What stands between an
    end and the next start, and behind a second start, belongs to no turn."""
    closed = F.split(formatted, AT_END, -1)
    closed = F.slice(closed, F.lit(1), F.size(closed) - 1)

    def turn(piece: Column) -> Column:
        body = F.coalesce(F.get(F.split(piece, AT_START, -1), F.lit(1)), F.lit(""))
        role = F.substring_index(body, "\n", 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substr(body, F.char_length(role) + 2)).alias("text"),
        )

    return F.transform(closed, turn)


def format_conversations(rows: DataFrame, learned: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss (array of begin and end, code points of `formatted` from 0,
    end excluded), n_rows and round_trip, one row a conversation.

    Turns stand in the order of turn (null first), then role, then text; repeated rows stay.
    Null roles and texts count as empty; rows without conv_id make one conversation. The
    loss mask covers the texts of turns with the role `learned`. Empty in, empty out.
    """
    whole = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    plain = render(F.col("role"), F.col("text"))
    # A line break behind the end mark is the template's own: nothing may stand there
    same = (parse(plain) == source) & (F.char_length(plain) == F.char_length("role") + F.char_length("text") + len(START + END) + 2)
    turns = whole.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.when(same, F.col("role")).otherwise(escape_role(F.col("role"))).alias("role_as"),
        F.when(same, F.col("text")).otherwise(escape(F.col("text"))).alias("text_as"),
    ).withColumn("part", render(F.col("role_as"), F.col("text_as")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The text ends before the end mark and its line break
    placed = turns.withColumn(
        "end", F.sum(F.char_length("part")).over(so_far) - len(END) - 1
    ).withColumn("begin", F.col("end") - F.char_length("text_as"))
    packed = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("end", "begin", "role", "text", "part"))).alias("t")
    )
    formatted = F.array_join(F.col("t.part"), "")
    loss = F.transform(
        F.filter("t", lambda x: x.role == learned), lambda x: F.struct(x.begin, x.end)
    )
    given = F.transform("t", lambda x: F.struct(x.role, x.text))
    return packed.select(
        "conv_id", formatted.alias("formatted"), loss.alias("loss"), F.size("t").alias("n_rows"), given.alias("given")
    ).select(
        "conv_id",
        "formatted",
        "loss",
        F.col("n_rows").cast("long").alias("n_rows"),
        (parse(F.col("formatted")) == F.col("given")).alias("round_trip"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, round_trip, turns (role and text) and learned (the texts under
    the loss mask, unescaped) of what `format_conversations` returns."""
    cut = F.transform(
        "loss",
        lambda s: unescape(F.substr("formatted", (s.begin + 1).cast("int"), (s.end - s.begin).cast("int"))),
    )
    return formatted.select(
        "conv_id",
        "formatted",
        "round_trip",
        parse(F.col("formatted")).alias("turns"),
        cut.alias("learned"),
    )
