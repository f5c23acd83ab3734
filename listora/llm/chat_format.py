"""Chat formatting by a grammar round trip, in column expressions only.

A conversation is written turn by turn as `[INST]role[/INST]text</s>`. The parser cuts it after every `</s>`, and each
piece at its first `[/INST]`; then it turns character references back. A turn is first written as it stands and read
again: if that does not give exactly the same role and text, its content conflicts with the marks and is written escaped,
which is read again in turn. Marks cannot overlap themselves, so turns that come back alone come back together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, END = "[INST]", "[/INST]", "</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Marks and ampersands as character references."""
    for plain, written in (("&", "&amp;"), (END, "&lt;/s>"), (OPEN, "&#91;INST]"), (MIDDLE, "&#91;/INST]")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for written, plain in (("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(END))


def _split_turn(piece: Column) -> Column:
    """Written role and text of what stands before an end mark, or null if it is no turn."""
    at = F.instr(piece, MIDDLE)
    role = F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
    text = F.substring(piece, at + len(MIDDLE), F.char_length(piece))
    return F.when(
        F.startswith(piece, F.lit(OPEN)) & (at > len(OPEN)), F.struct(role.alias("role"), text.alias("text"))
    )


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation as written (see `unescape`); null if it does not follow the grammar."""
    pieces = F.split(formatted, r"\Q" + END + r"\E", -1)
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), _split_turn)
    whole = (F.element_at(pieces, -1) == "") & ~F.exists(turns, lambda turn: turn.isNull())
    return F.when(whole, turns)


def _comes_back(written: Column, role: Column, text: Column) -> Column:
    turns = parsed(written)
    return F.coalesce(
        (F.size(turns) == 1) & (unescape(turns[0]["role"]) == role) & (unescape(turns[0]["text"]) == text), F.lit(False)
    )


def chat_texts(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and turns (role, text as written, n_head, n_loss) of every conversation.

    Rows are turns with conv_id, turn, role and text, taken in the order of `turn` (null first, then by what is written);
    equal turn numbers and repeated rows all stay. A null role or text is empty; rows with a null conv_id are one
    conversation. The loss mask is run lengths in code points: of each turn, `n_head` without loss up to the text, then
    `n_loss` with loss (0 unless the role is assistant), then the rest of the turn without. Other columns are left out, and
    an empty table gives no rows. A conversation is one row of the result, so it has to fit there (2 GB); its turns reach
    that row through partial aggregates, once. Fails if any conversation does not come back from its text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    as_is = _turn(F.col("role"), F.col("text"))
    escaped = _turn(escape(F.col("role")), escape(F.col("text")))
    written = F.when(_comes_back(as_is, F.col("role"), F.col("text")), as_is).otherwise(
        F.when(_comes_back(escaped, F.col("role"), F.col("text")), escaped)
        .otherwise(F.raise_error(F.lit("a turn does not come back from its text")).cast("string"))
    )
    whole = (
        rows.select("conv_id", "turn", written.alias("written"))
        .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "written"))).alias("rows"))
        .select("conv_id", F.array_join(F.col("rows.written"), "").alias("formatted"), F.size("rows").alias("n_rows"))
    )
    marked = F.transform(
        parsed(F.col("formatted")),
        lambda turn: F.struct(
            turn["role"].alias("role"),
            turn["text"].alias("text"),
            (F.char_length(turn["role"]) + len(OPEN) + len(MIDDLE)).alias("n_head"),
            F.when(unescape(turn["role"]) == LOSS_ROLE, F.char_length(turn["text"])).otherwise(0).alias("n_loss"),
        ),
    )
    found = whole.select("conv_id", "formatted", "n_rows", marked.alias("turns"))
    same = F.coalesce(F.size("turns") == F.col("n_rows"), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation does not come back from its text")).cast("string")
    )
    return found.select("conv_id", checked.alias("formatted"), "turns")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from formatted conversations: turns, digests, and the text under the loss mask."""
    turns = F.col("turns")
    told = F.transform(turns, lambda t: F.concat(unescape(t["role"]), F.lit("\n"), unescape(t["text"]), F.lit("\n")))
    under_loss = F.transform(
        F.filter(turns, lambda t: t["n_loss"] > 0), lambda t: unescape(F.substring(t["text"], F.lit(1), t["n_loss"]))
    )
    return formatted.select(
        "conv_id", "formatted", F.size(turns).cast("long").alias("n_turns"),
        F.array_join(told, "").alias("told"), F.array_join(under_loss, "").alias("loss"),
    ).select(
        "conv_id", "n_turns", F.sha2("told", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
