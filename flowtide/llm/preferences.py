"""Preference formatting: the turns that chosen and rejected conversations share become one prompt.

A pair is two lists of turns. Their longest common prefix (same role and same text, turn by turn) is rendered once; what follows
on either side is its completion. Of a completion only the assistant's words and their end marks are trained;
every other character is masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the chat template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def _turns(side: str) -> Column:
    """A side's distinct turns in order of number, then role, then text."""
    own = F.collect_set(F.when(F.col("_side") == side, F.struct("turn", "role", "text")))
    return F.transform(F.sort_array(own), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END + "\n"))


def _render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_header(t), _body(t))))


def _trained(turns: Column) -> Column:
    """[start, end) of the trained characters of each assistant turn in the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn))
        end = begin + F.length(_body(turn))
        # the line feed behind the end mark is template, not answer
        span = F.array(F.struct(begin.alias("start"), (end - 1).alias("end")))
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, zero, step, lambda s: s["spans"])


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans), one row per pair.

    Both sides have pair_id, turn, role, text; other columns are not read. Spans are character ranges, from the start of the
    completion, on which a model is trained. Nulls: rows without pair_id take no part; a null turn number comes first, a
    null role or text is an empty string. A turn that is repeated exactly counts once, different turns of
    one number follow in order of role and text. A pair with one side only has an empty prompt and an empty
    other completion; equal sides have only a prompt. Template marks inside a text are broken up by a space.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        text = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|im_"), F.lit("< |im_"))
        return rows.where("pair_id is not null").select(
            "pair_id", F.lit(name).alias("_side"), F.col("turn").cast("bigint").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"),
        )

    both = side(chosen, "chosen").unionByName(side(rejected, "rejected"))
    pairs = both.groupBy("pair_id").agg(_turns("chosen").alias("c"), _turns("rejected").alias("r"))
    same = F.zip_with("c", "r", lambda a, b: F.coalesce(a == b, F.lit(False)))
    shared = pairs.withColumn("n", F.coalesce(F.array_position(same, False).cast("int") - 1, F.lit(0)))
    shared = shared.withColumn("n", F.when(F.col("n") < 0, F.least(F.size("c"), F.size("r"))).otherwise(F.col("n")))
    cut = shared.select(
        "pair_id", F.col("n").alias("prompt_turns"), F.slice("c", F.lit(1), F.col("n")).alias("p"),
        *[F.slice(s, F.col("n") + 1, F.greatest(F.size(s) - F.col("n"), F.lit(0))).alias(s) for s in ("c", "r")],
    )
    return cut.select(
        "pair_id", "prompt_turns", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"),
        _render(F.col("r")).alias("rejected"), _trained(F.col("c")).alias("chosen_spans"), _trained(F.col("r")).alias("rejected_spans"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from ``conversations(conv_id, turn, role, text)``.

    Every conversation is a chosen side. Its rejected side has the same turns, but its last assistant turn says what the
    last assistant turn of its neighbour (conv_id with the lowest bit flipped) says, where there is one.
    """
    chosen = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    answers = chosen.where(F.col("role") == TRAINED_ROLE).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("a"))
    lent = answers.select(F.col("pair_id").bitwiseXOR(F.lit(1).cast("bigint")).alias("pair_id"), F.col("a.text").alias("lent"))
    last = answers.select("pair_id", F.col("a.turn").alias("last")).join(lent, "pair_id")
    swapped = chosen.join(last, "pair_id", "left")
    final = (F.col("role") == TRAINED_ROLE) & (F.col("turn") == F.col("last"))
    return chosen, swapped.select("pair_id", "turn", "role", F.when(final, F.col("lent")).otherwise(F.col("text")).alias("text"))
