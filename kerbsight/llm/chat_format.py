"""Preference formatting: a shared prompt and two masked completions, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "<|", "|>\n", "<|end|>\n"


def rendered(turn: Column) -> Column:
    """One turn as text: its role's header, its text, an end mark."""
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MID), turn["text"], F.lit(CLOSE))


def rendered_all(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def trained_spans(turns: Column, trained_role: str = "assistant") -> Column:
    """Array of (start, end) character offsets, into the rendered turns, of what is trained on.

    That is the text and end mark of the turns of ``trained_role``; headers and other turns are masked.
    """
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc, t):
        head = acc["at"] + F.length(F.concat(F.lit(OPEN), t["role"], F.lit(MID)))
        end = acc["at"] + F.length(rendered(t))
        span = F.array(F.struct(head.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == trained_role, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(turns: DataFrame, pair_col: str = "pair_id", trained_role: str = "assistant") -> DataFrame:
    """Pairs of conversations as ``(pair, n_common, prompt, chosen, chosen_spans, rejected, rejected_spans)``.

    Input columns: the pair, ``side`` ('chosen' or 'rejected'), ``turn``, ``role``, ``text``. Turns are ordered by
    (turn, role, text), nulls first; null roles and texts count as empty; a turn that is repeated is rendered again.
    The prompt is the longest run of leading turns whose role and text are equal on both sides; each completion is the
    rest of its side, with the spans that a loss would count. A pair that has one side only has that side's turns as
    completion, an empty prompt and an empty other side. Rows with a null pair or another side are left out; other
    columns are ignored.

    One partial aggregation and one shuffle on the pair; the only thing that is gathered is the pair's own two
    conversations, which are the row that is returned.
    """
    t = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where(F.col(pair_col).isNotNull() & F.col("side").isin("chosen", "rejected")).select(F.col(pair_col).alias("_pair"), "side", t.alias("_t"))
    side = lambda name: F.array_sort(F.collect_list(F.when(F.col("side") == name, F.col("_t"))), _by_turn)
    pairs = rows.groupBy("_pair").agg(side("chosen").alias("_c"), side("rejected").alias("_r"))
    both = F.arrays_zip(F.col("_c").alias("c"), F.col("_r").alias("r"))
    differs = F.transform(both, lambda x: ~(x["c"]["role"].eqNullSafe(x["r"]["role"]) & x["c"]["text"].eqNullSafe(x["r"]["text"])))
    n = F.coalesce(F.nullif(F.array_position(differs, True), F.lit(0)) - 1, F.size(both)).cast("int")
    pairs = pairs.select("_pair", "_c", "_r", n.alias("_n"))
    rest = lambda c: F.slice(c, F.col("_n") + 1, F.greatest(F.size(c) - F.col("_n"), F.lit(0)))
    pairs = pairs.select("_pair", "_n", F.slice("_c", 1, F.col("_n")).alias("_p"), rest(F.col("_c")).alias("_c"), rest(F.col("_r")).alias("_r"))
    return pairs.select(
        F.col("_pair").alias(pair_col), F.col("_n").alias("n_common"), rendered_all(F.col("_p")).alias("prompt"),
        rendered_all(F.col("_c")).alias("chosen"), trained_spans(F.col("_c"), trained_role).alias("chosen_spans"),
        rendered_all(F.col("_r")).alias("rejected"), trained_spans(F.col("_r"), trained_role).alias("rejected_spans"),
    )


def _by_turn(a: Column, b: Column) -> Column:
    """Order of two turns: by number, role and text, null numbers first."""
    none = F.lit(-(2**63)).cast("long")
    x, y = F.coalesce(a["turn"].cast("long"), none), F.coalesce(b["turn"].cast("long"), none)
    less = lambda p, q, then: F.when(p < q, -1).when(p > q, 1).otherwise(then)
    return less(x, y, less(a["role"], b["role"], less(a["text"], b["text"], F.lit(0))))


def replaced_replies(conversations: DataFrame) -> DataFrame:
    """Preference pairs out of plain conversations, as input of :func:`format_preferences`.

    Chosen is each conversation as it is. Rejected is the same conversation with its last turns, those with the
    largest number, replaced by the last turns of the conversation with the next id; where there is none, it just
    ends earlier.
    """
    c = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = c.groupBy("pair_id").agg(F.max("turn").alias("_last"))
    marked = c.join(last, "pair_id")
    theirs = marked.where("turn <=> _last").select((F.col("pair_id") - 1).alias("pair_id"), "role", "text").join(last, "pair_id")
    return (
        c.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
        .unionByName(marked.where("not (turn <=> _last)").select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text"))
        .unionByName(theirs.select("pair_id", F.lit("rejected").alias("side"), F.col("_last").alias("turn"), "role", "text"))
    )
