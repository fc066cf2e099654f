"""Chat formatting by a finite-state machine and a declarative template.

Everything is DataFrame functions: one aggregation gathers the turns of a
conversation (a conversation is one record, so it is one row), ``aggregate``
drives the role machine, ``transform`` emits the text segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles are trained on, and which turn orders are valid.

    ``opening`` holds ``{role}``.  Markers must begin with ``<``, which never
    occurs in escaped text, so that the output can be split without doubt.
    ``moves`` maps (state, role) to the next state; ``final`` are the states a
    conversation may end in.
    """

    opening: str = "<turn:{role}>\n"
    closing: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "primed",
            ("start", "user"): "asked",
            ("primed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self) -> None:
        if not (self.opening.startswith("<") and self.closing.startswith("<") and self.opening.count("{role}") == 1):
            raise ValueError("markers begin with '<' and the opening names the role once")
        if (self.opening + self.closing).count("<") != 2 or "&" in self.opening + self.closing:
            raise ValueError("'<' stands only at the start of a marker and '&' nowhere")


def escape(text: Column) -> Column:
    """Make every control string harmless; the inverse of :func:`unescape`."""
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def _walk(turns: Column, template: Template) -> Column:
    """State after all turns; ``invalid`` is a trap."""

    def step(state: Column, turn: Column) -> Column:
        out = None
        for (at, role), to in template.moves.items():
            hit = (state == at) & (turn["role"] == role)
            out = F.when(hit, to) if out is None else out.when(hit, to)
        return (F.lit("invalid") if out is None else out.otherwise("invalid")).cast("string")

    return F.aggregate(turns, F.lit(template.start), step)


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per ``conv_id``: ``segments`` of (text, loss), ``formatted``, ``valid``.

    Rows are ordered by turn, then role, then text (null turns first), so ties
    and repeated rows have one order and all of them are kept.  A null text or
    role is empty; a null ``conv_id`` is a conversation of its own.  Turn orders
    that the machine refuses are formatted all the same, with ``valid`` false.
    Other columns are ignored; an empty table gives an empty result.
    """
    t = template or Template()
    before, after = t.opening.split("{role}")
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda x: F.array(
                F.struct(F.concat(F.lit(before), escape(x["role"]), F.lit(after)).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(x["text"]).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
                F.struct(F.lit(t.closing).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    return chats.select(
        "conv_id",
        _walk(F.col("turns"), t).isin(*t.final).alias("valid"),
        segments.alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Undo :func:`format_chats`: ``turns`` of (role, text) from ``formatted``, ``loss_text`` from ``segments``."""
    t = template or Template()
    before, after = t.opening.split("{role}")
    pieces = F.filter(F.split("formatted", "<", -1), lambda x, i: (i > 0) & ~x.startswith(t.closing[1:]))
    cut = lambda x: F.instr(x, after)
    turns = F.transform(
        pieces,
        lambda x: F.struct(
            unescape(F.substring(x, F.lit(len(before)), cut(x) - F.lit(len(before)))).alias("role"),
            unescape(F.substring(x, cut(x) + F.lit(len(after)), F.char_length(x))).alias("text"),
        ),
    )
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return chats.withColumns({"turns": turns, "loss_text": loss})
