"""Chat formatting by grammar round trip, in SQL functions alone.

The template's grammar, which a deterministic parser reads back::

    chat := mode turn*          mode := "%raw\\n" | "%esc\\n"
    turn := "### " role ": " text "</turn>\\n"

``role`` and ``text`` hold neither ``###`` nor ``</turn>``, and ``role`` no ``:``.
A conversation is rendered as it is and parsed again. Where the recovered turns
are not the source's, or the grammar is broken, its content is escaped
(``\\`` to ``\\\\``, ``#`` to ``\\h``, ``<`` to ``\\l``, in roles also ``:`` to ``\\c``)
and rendered and parsed once more. An escaped text has no ``#`` and no ``<``, so
that second trip always succeeds; a difference would still stop the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import running_sums

HEAD, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
CONTROL = ("###", "</turn>")
MODE_CHARS = 5


def _escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\h"))
    out = F.replace(out, F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def _unescape(text: Column) -> Column:
    """Pairs of backslashes are found from the left, so each part between them holds single escapes only."""

    def part(x: Column) -> Column:
        x = F.replace(x, F.lit("\\h"), F.lit("#"))
        x = F.replace(x, F.lit("\\l"), F.lit("<"))
        return F.replace(x, F.lit("\\c"), F.lit(":"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def unescape_text(text: Column, escaped: Column) -> Column:
    return F.when(escaped, _unescape(text)).otherwise(text)


def _render(turns: Column, escaped: bool) -> Column:
    role = lambda t: _escape(t["role"], True) if escaped else t["role"]
    text = lambda t: _escape(t["text"]) if escaped else t["text"]
    one = lambda t: F.concat(F.lit(HEAD), role(t), F.lit(AFTER_ROLE), text(t), F.lit(END))
    return F.concat(F.lit("%esc\n" if escaped else "%raw\n"), F.array_join(F.transform(turns, one), ""))


def parse(formatted: Column) -> Column:
    """The turns a formatted conversation holds; null where it is not in the grammar."""
    escaped = F.startswith(formatted, F.lit("%esc\n"))
    body = F.substring(formatted, MODE_CHARS + 1, 2147483647)
    pieces = F.split(body, END, -1)
    count = F.size(pieces) - 1  # the last piece is what follows the last end: nothing

    def turn(piece: Column) -> Column:
        colon = F.instr(piece, AFTER_ROLE)
        role = F.substring(piece, F.lit(len(HEAD) + 1), colon - 1 - len(HEAD))
        text = F.substring(piece, colon + len(AFTER_ROLE), F.lit(2147483647))
        free = lambda x: ~(F.contains(x, F.lit(CONTROL[0])) | F.contains(x, F.lit(CONTROL[1])))
        good = F.startswith(piece, F.lit(HEAD)) & (colon > len(HEAD)) & free(role) & free(text)
        return F.when(
            good,
            F.struct(unescape_text(role, escaped).alias("role"), unescape_text(text, escaped).alias("text")),
        )

    turns = F.transform(F.slice(pieces, F.lit(1), count), turn)
    whole = (F.element_at(pieces, -1) == "") & ~F.exists(turns, lambda t: t.isNull())
    marked = escaped | F.startswith(formatted, F.lit("%raw\n"))
    return F.when(marked & whole, turns)


def format_chats(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, escaped, turns, loss``.

    ``turns`` are read back from ``formatted``; ``loss`` holds the start and end
    (code points, end exclusive) of each assistant text in it. Turns go by turn
    number, nulls first, then by role and text, so ties and repeated rows have
    one order. A null text or role is empty; rows without a conversation id form
    one conversation. No rows give no conversations.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    chats = rows.select(F.col(conv_col).alias("conv_id"), turn.alias("t")).groupBy("conv_id")
    chats = chats.agg(F.sort_array(F.collect_list("t")).alias("t"))
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = chats.select("conv_id", source.alias("source"))
    chats = chats.withColumn("raw", _render(F.col("source"), False))
    chats = chats.withColumn("escaped", ~F.coalesce(parse(F.col("raw")) == F.col("source"), F.lit(False)))
    chats = chats.withColumn("formatted", F.when(F.col("escaped"), _render(F.col("source"), True)).otherwise(F.col("raw")))
    chats = chats.withColumn("turns", parse(F.col("formatted")))
    same = F.coalesce(F.col("turns") == F.col("source"), F.lit(False))
    lost = F.raise_error(F.concat(F.lit("turns are not recovered in conversation "), F.col("conv_id").cast("string")))
    chats = chats.withColumn("turns", F.when(same, F.col("turns")).otherwise(lost))
    return chats.select("conv_id", "formatted", "escaped", "turns", _loss(F.col("formatted"), F.col("escaped")).alias("loss"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where the value is computed once, also if lambdas inside use it often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _loss(formatted: Column, escaped: Column) -> Column:
    """Where the assistant's texts lie in ``formatted``; a running sum over the turns' lengths."""
    body = F.substring(formatted, MODE_CHARS + 1, 2147483647)
    pieces = F.split(body, END, -1)
    turn = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            F.length(p).cast("bigint").alias("n"),
            (F.instr(p, AFTER_ROLE) - 1 + len(AFTER_ROLE)).cast("bigint").alias("at"),
            F.startswith(p, F.lit(f"{HEAD}assistant{AFTER_ROLE}")).alias("own"),
        ),
    )

    def spans(turn: Column) -> Column:
        begin = _bound(F.transform(turn, lambda t: t["n"] + len(END)), lambda n: running_sums(n))
        return F.zip_with(
            turn,
            begin,
            lambda t, b: F.when(
                t["own"],
                F.struct((b + MODE_CHARS + t["at"]).alias("start"), (b + MODE_CHARS + t["n"]).alias("end")),
            ),
        )

    return F.filter(_bound(turn, spans), lambda s: s.isNotNull())


def loss_text(formatted: Column, escaped: Column, loss: Column) -> Column:
    """All text under the loss mask: ``formatted`` cut at each span of ``loss``, without escapes.

    Cuts are made in four bytes a character, where a place is found without counting from the start.
    """

    def cut(chat: Column) -> Column:
        def one(span: Column) -> Column:
            at, n = 4 * span["start"] + 1, 4 * (span["end"] - span["start"])
            return unescape_text(F.decode(F.substring(chat["wide"], at.cast("int"), n.cast("int")), "UTF-32"), chat["escaped"])

        return F.array_join(F.transform(loss, one), "")

    return _bound(F.struct(F.encode(formatted, "UTF-32").alias("wide"), escaped.alias("escaped")), cut)
