"""Chat formatting with a grammar round trip, DataFrame operations only.

A conversation is rendered as turns of

    <|im_start|>role \\n text <|im_end|> \\n

and reparsed by a deterministic parser: cut at each start mark, role up to
the first line break, text up to the first end mark, which must be followed by
one line break and the next turn.  The parser undoes the escapes below.  A turn
whose plain rendering does not come back as itself is escaped, and rendered
again; what then comes back is compared once more (``exact``).

Escapes: in a text, ``<|`` gets a backslash inside, ``<\\|``, and a run that
already looks like that gets one more; in a role, line breaks and per cent
signs become %0A and %25, and ``<|`` as in texts.  No escaped text holds ``<|``,
so no mark can arise inside one or across its border (a mark has no proper
prefix that is also its suffix); turns therefore do not disturb each other and
each is settled by itself, before the shuffle that gathers conversations.

Skew: rendering, reparsing and escaping are done per turn row.  The gathering
shuffle carries finished strings; a conversation is one string, so it has to
fit in a row (2 GB), as its digest has to be taken over the whole of it.

Defined results: null texts and null roles are empty strings; turns are
ordered by turn (null first), then role, then text, repeated rows are kept;
rows with a null conversation id form one conversation; an empty table gives
none; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Array of (role, raw, text, ok): ``raw`` as it stands in the formatted string, ``text`` unescaped."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        rest = F.substring(piece, F.length(role) + 2, F.length(piece))
        raw = F.substring_index(rest, END, 1)
        return F.struct(unescape_role(role).alias("role"), raw.alias("raw"), unescape(raw).alias("text"),
                        (piece == F.concat(role, F.lit("\n"), raw, F.lit(END + "\n"))).alias("ok"))
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _same(formatted: Column, role: Column, text: Column) -> Column:
    """True if ``formatted`` parses to exactly one turn, equal to the source."""
    back = parse(formatted)
    first = F.element_at(back, 1)
    return (F.size(back) == 1) & first["ok"] & (first["role"] == role) & (first["text"] == text)


def render(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, formatted, exact): one row per conversation."""
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")
    rows = rows.withColumn("plain", render_turn(role, text))
    rows = rows.withColumn("turn_text", F.when(_same(F.col("plain"), role, text), F.col("plain"))
                           .otherwise(render_turn(escape_role(role), escape(text))))
    rows = rows.withColumn("exact", _same(F.col("turn_text"), role, text))
    gathered = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "turn_text"))).alias("turns"),
        F.min("exact").alias("exact"), F.count(F.lit(1)).alias("n_turns"))
    return gathered.select("conv_id", "n_turns", F.array_join(F.col("turns.turn_text"), "").alias("formatted"), "exact")


def read_back(formatted: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Adds ``turns`` (the parsed turns) and ``loss_mask``.

    The mask is a run-length code over the formatted string, one (skip, take, trained) per turn: after ``skip``
    code points of marks and role come ``take`` code points of text, under the loss where ``trained``.
    """
    turns = parse(F.col("formatted"))
    header = F.transform(F.split(F.col("formatted"), r"<\|im_start\|>"),
                         lambda p: F.length(F.substring_index(p, "\n", 1)) + len(START) + 1)
    out = formatted.withColumn("turns", turns).withColumn("_head", F.slice(header, 2, F.greatest(F.size("turns"), F.lit(1))))
    mask = F.transform("turns", lambda t, i: F.struct(
        (F.get(F.col("_head"), i) + F.when(i > 0, len(END) + 1).otherwise(0)).alias("skip"),
        F.length(t["raw"]).alias("take"), (t["role"] == trained_role).alias("trained")))
    return out.withColumn("loss_mask", mask).drop("_head")
