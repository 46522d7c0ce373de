"""Chat formatting with DataFrame expressions only.

Turn structs are collected per conversation, sorted, adjacent turns of one role are merged by an array aggregation,
and the merged runs are concatenated into one string. In it

* ``<|im_start|>role\\n`` opens a run and ``<|im_end|>\\n`` closes it; ``<|im_turn|>`` stands between merged turns,
  so that the turns can be read back one by one;
* inside texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``: no text can hold a marker, and unescaping gives the
  text back exactly; a line feed in a role becomes ``<|nl|>``.

The loss mask is an array of (start, end) code points that covers each assistant text and nothing else.

Defined cases: null roles and texts are empty; a null conversation id is a conversation of its own; turns sort by turn
number (null first), ties by role and then text; repeated rows stay, each as a turn; an empty table gives no rows;
columns other than the four named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, TURN, NEW_LINE = "<|im_start|>", "<|im_end|>", "<|im_turn|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _runs(turns: Column) -> Column:
    """Merges adjacent turns of one role: array<struct<role, texts>>, in time that grows with the turns."""
    n = F.size(turns)
    role = lambda i: F.get(turns, i)["role"]
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))

    def run(start: Column, end: Column) -> Column:
        return F.struct(role(start).alias("role"), F.transform(F.slice(turns, start + 1, end - start), lambda t: t["text"]).alias("texts"))

    return F.zip_with(starts, F.concat(F.slice(starts, 2, n), F.array(n)), run)


def _pieces(runs: Column, learnt: str) -> Column:
    """The output in pieces, each with whether it is under the loss mask."""

    def piece(s: Column, loss: Column) -> Column:
        return F.struct(s.alias("s"), loss.alias("loss"))

    no = F.lit(False)

    def of_run(run: Column) -> Column:
        role = F.replace(escape(run["role"]), F.lit("\n"), F.lit(NEW_LINE))
        head = F.array(piece(F.concat(F.lit(START), role, F.lit("\n")), no))
        body = F.flatten(
            F.transform(
                run["texts"],
                lambda t, i: F.array(piece(F.when(i > 0, F.lit(TURN)).otherwise(F.lit("")), no), piece(escape(t), run["role"] == learnt)),
            )
        )
        return F.concat(head, body, F.array(piece(F.lit(END + "\n"), no)))

    return F.flatten(F.transform(runs, of_run))


def _spans(pieces: Column) -> Column:
    """Code points (start, end) of the pieces under the loss mask.

    Places are summed inside stretches of about the square root of all pieces, and then over the stretches: adding to an
    array copies it, so one sum over all pieces would take time that grows with the square of a conversation.
    """
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")

    def add(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.length(p["s"])
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    size = F.ceil(F.sqrt(F.size(pieces))).cast("int")
    stretch = lambda k: F.aggregate(F.slice(pieces, k * size + 1, size), F.struct(F.lit(0).alias("at"), none.alias("spans")), add)

    def join(acc: Column, part: Column) -> Column:
        placed = F.array(F.struct(acc["at"].alias("at"), part["spans"].alias("spans")))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["parts"], placed).alias("parts"))

    empty = F.expr("cast(array() as array<struct<at:int,spans:array<struct<start:int,end:int>>>>)")
    parts = F.aggregate(F.transform(F.sequence(F.lit(0), size - 1), stretch), F.struct(F.lit(0).alias("at"), empty.alias("parts")), join, lambda acc: acc["parts"])
    moved = lambda p: F.transform(p["spans"], lambda x: F.struct((x["start"] + p["at"]).alias("start"), (x["end"] + p["at"]).alias("end")))
    return F.flatten(F.transform(parts, moved))


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learnt: str = "assistant"
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``."""
    turns = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
        ).alias("t"),
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .select("conv_id", _pieces(_runs(F.col("turns")), learnt).alias("pieces"))
        .select(
            "conv_id", F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"), _spans(F.col("pieces")).alias("loss_spans")
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unmerged and unescaped: array<struct<role, text>>."""

    def of_run(run: Column) -> Column:
        head = F.substring_index(run, "\n", 1)
        role = unescape(F.replace(F.substr(head, F.lit(len(START) + 1)), F.lit(NEW_LINE), F.lit("\n")))
        body = F.substr(run, F.length(head) + 2)
        return F.transform(F.split(body, r"<\|im_turn\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    runs = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda run: run != "")
    return F.flatten(F.transform(runs, of_run))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    return formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("losses")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(F.array_join("losses", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("losses", ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# The same figures in SQL: digests of the turns in order, and the length of the format piece by piece.
ORACLE = r"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), m as (
    select *, lag(role) over (partition by conv_id order by turn, role, text) as previous,
        length(replace(replace(text, '\', '\\'), '<|', '<\|')) as n, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 7 * (length(role) - length(replace(role, chr(10), ''))) as k
    from t
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(n + case when role = previous then length('<|im_turn|>') else length('<|im_start|>') + k + 1 + length('<|im_end|>') + 1 end)::bigint as formatted_chars
from m group by 1
"""
