"""Preference formatting: one prompt for the turns two conversations share, two masked completions.

Everything is DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(id, turns)``: each conversation's turns in order.

    A null role or text counts as empty; equal turn numbers are ordered by role
    and text, null numbers come first. Rows without a conversation id belong to
    no conversation. A conversation becomes one training example, so its turns
    must fit one row.
    """
    turn = F.struct(F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    told = turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return told.select("id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per id in both ``(id, turns)`` frames.

    ``n_prompt_turns`` is the length of the longest common prefix of whole turns
    (role and text); ``prompt`` renders it. ``chosen`` and ``rejected`` render
    the turns after it. ``chosen_mask`` and ``rejected_mask`` hold ``[from, to)``
    character ranges to learn from: the text and end mark of assistant turns. The
    prompt is never learned. Equal conversations give two empty completions and
    ``differs`` false. Marks of the template inside a text are broken up, so
    that no text can end its own turn.
    """
    both = chosen.select("id", F.col("turns").alias("c")).join(rejected.select("id", F.col("turns").alias("r")), "id")
    same = F.zip_with("c", "r", lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    end = F.array_position(same, F.lit(False))
    both = both.withColumn("n", F.when(end > 0, end - 1).otherwise(F.size("c")).cast("int"))
    made = both.select("id", "n", _rendered(F.slice("c", F.lit(1), F.col("n"))).alias("p"),
                       _rendered(_after("c", "n")).alias("c"), _rendered(_after("r", "n")).alias("r"))
    text = {x: F.array_join(F.transform(x, lambda t: t["text"]), "") for x in ("p", "c", "r")}
    return made.select("id", F.col("n").cast("bigint").alias("n_prompt_turns"), text["p"].alias("prompt"), text["c"].alias("chosen"), text["r"].alias("rejected"),
                       _mask("c").alias("chosen_mask"), _mask("r").alias("rejected_mask"), (text["c"] != text["r"]).alias("differs"))


def _after(turns: str, n: str) -> Column:
    return F.slice(turns, F.col(n) + 1, F.size(turns))


def _rendered(turns: Column) -> Column:
    """Each turn's text, where its learned part starts, and whether it is learned."""
    def turn(t):
        head = F.concat(F.lit(START), _plain(t["role"]), F.lit("\n"))
        text = F.concat(head, _plain(t["text"]), F.lit(END + "\n"))
        return F.struct(text.alias("text"), F.length(head).alias("skip"), F.length(text).alias("size"), (t["role"] == LEARNED).alias("learned"))
    return F.transform(turns, turn)


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _mask(parts: str) -> Column:
    """Ranges of the learned turns; one pass carries the length so far."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("out"))

    def step(state, t):
        span = F.struct((state["at"] + t["skip"]).alias("from"), (state["at"] + t["size"] - 1).alias("to"))
        return F.struct((state["at"] + t["size"]).alias("at"), F.when(t["learned"], F.array_append(state["out"], span)).otherwise(state["out"]).alias("out"))
    return F.aggregate(parts, zero, step)["out"]


def echo_pairs(told: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations.

    Chosen: the conversation up to its last assistant turn. Rejected: the same
    with that answer replaced by the text of the turn before it, an answer that
    only repeats the question (empty if there is none before). Conversations
    without an assistant turn are kept whole on both sides.
    """
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == LEARNED)
    cut = told.withColumn("last", F.when(F.size(places) > 0, F.element_at(places, -1)).otherwise(F.lit(0)))
    chosen = F.when(F.col("last") > 0, F.slice("turns", F.lit(1), F.col("last"))).otherwise(F.col("turns"))
    echo = F.when(F.col("last") > 1, F.try_element_at("turns", F.greatest(F.col("last") - 1, F.lit(1)))["text"]).otherwise(F.lit(""))
    answer = F.array(F.struct(F.lit(LEARNED).alias("role"), echo.alias("text")))
    rejected = F.when(F.col("last") > 0, F.concat(F.slice("turns", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0))), answer)).otherwise(F.col("turns"))
    return cut.select("id", chosen.alias("turns")), cut.select("id", rejected.alias("turns"))
