"""Chat history: order, clean-up, titles, scripted steps, tool calls, feedback."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import text as X
from tidewatch.operators.windows import running_totals
from tidewatch.params import Params


def message_positions(messages: DataFrame, p: Params) -> DataFrame:
    """Dense position from 0 per conversation, and whether the stored one agrees."""
    ones = messages.select("conversation_id", "position", F.lit(1).cast("bigint").alias("one"))
    run = running_totals(ones, ["conversation_id"], "position", {"n": "one"}, p.hot_key_rows)
    dense = F.col("n") - 1
    return run.select("conversation_id", "position", dense.alias("dense_position"),
                      (dense == F.col("position")).alias("in_sequence"))


def next_positions(messages: DataFrame) -> DataFrame:
    """The position the next message of each conversation gets, and duplicates already there."""
    return messages.groupBy("conversation_id").agg(
        (F.max("position") + 1).alias("next_position"),
        (F.count(F.lit(1)) - F.countDistinct("position")).alias("n_duplicates"))


def append_messages(messages: DataFrame, incoming: DataFrame, p: Params) -> DataFrame:
    """Incoming messages with their positions: after the last stored one, dense, in arrival order."""
    after = messages.groupBy("conversation_id").agg((F.max("position") + 1).alias("start"))
    run = running_totals(incoming.withColumn("one", F.lit(1).cast("bigint")), ["conversation_id"], "arrival", {"n": "one"}, p.hot_key_rows)
    return (run.join(after, "conversation_id", "left")
            .withColumn("position", F.coalesce("start", F.lit(0)) + F.col("n") - 1).drop("one", "n", "start"))


def _clean(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("role").isin("user", "assistant")
                           & (F.length(F.trim(F.coalesce("content", F.lit("")))) > 0))


def sanitize_history(messages: DataFrame) -> DataFrame:
    """Messages that may be replayed: known roles, no blanks, conversation ends with the user."""
    clean = _clean(messages)
    ends = (clean.groupBy("conversation_id").agg(F.max_by("role", "position").alias("last_role"))
            .filter(F.col("last_role") == "user"))
    return clean.join(ends.select("conversation_id"), "conversation_id", "left_semi")


def conversation_titles(messages: DataFrame, width: int = 48) -> DataFrame:
    """Title from the first user message, cut with an ellipsis only when it is longer.

    The title is cut before the rows are grouped, so no message text is shuffled.
    """
    title = X.ellipsis(F.col("content"), width)
    return messages.groupBy("conversation_id").agg(
        F.min_by(title, F.when(F.col("role") == "user", F.col("position"))).alias("title"))


def conversation_list(messages: DataFrame) -> DataFrame:
    """Conversations of every user, latest first.  The id grows with time."""
    per_conv = messages.groupBy("user_id", "conversation_id").agg(
        F.count(F.lit(1)).alias("n_messages"), F.max("position").alias("last_position"))
    return per_conv.orderBy("user_id", F.desc("conversation_id"))


def ordered_messages(messages: DataFrame, conversation_id: int) -> DataFrame:
    return messages.filter(F.col("conversation_id") == conversation_id).orderBy("position")


@dataclass(frozen=True)
class Step:
    prompt: str
    triggers: tuple[str, ...] = ()


def next_step(messages: DataFrame, script: tuple[Step, ...]) -> DataFrame:
    """At most one suggested prompt per conversation.

    The first step that was not sent yet is offered when it has no triggers or
    the last assistant message contains one of them.  Texts are reduced to flags
    before the rows are grouped.
    """
    said = F.lower(F.trim("content"))
    unlocks = F.struct(*[
        (X.contains_any(F.col("content"), [t.lower() for t in s.triggers]) if s.triggers else F.lit(True)).alias(f"u{i}")
        for i, s in enumerate(script)])
    per_conv = messages.groupBy("conversation_id").agg(
        F.max_by(unlocks, F.when(F.col("role") == "assistant", F.col("position"))).alias("last"),
        *[F.coalesce(F.bool_or((F.col("role") == "user") & (said == s.prompt.strip().lower())), F.lit(False)).alias(f"sent{i}")
          for i, s in enumerate(script)])
    step = F.lit(None).cast("string")
    for i, s in reversed(list(enumerate(script))):
        is_open = F.col(f"last.u{i}") if s.triggers else F.lit(True)
        step = F.when(F.col(f"sent{i}"), step).when(is_open, F.lit(s.prompt)).otherwise(F.lit(None).cast("string"))
    return per_conv.select("conversation_id", step.alias("next_prompt"))


def pair_tool_calls(events: DataFrame) -> DataFrame:
    """Tool calls with their last output; an output without an earlier call stays as ``(unknown)``."""
    calls = events.filter(F.col("kind") == "tool_call").select("conversation_id", "call_id", "seq", "name", "args")
    outputs = events.filter(F.col("kind") == "tool_output").select(
        "conversation_id", "call_id", F.col("seq").alias("out_seq"), "output")
    opened = calls.select("conversation_id", "call_id", "seq")
    keys = (F.col("o.conversation_id") == F.col("c.conversation_id")) & (F.col("o.call_id") == F.col("c.call_id"))
    earlier = keys & (F.col("c.seq") < F.col("o.out_seq"))
    answered = (outputs.alias("o").join(opened.alias("c"), earlier)
                .groupBy("o.conversation_id", "o.call_id").agg(F.max_by("output", "out_seq").alias("output")))
    paired = calls.join(answered, ["conversation_id", "call_id"], "left")
    orphans = (outputs.alias("o").join(opened.alias("c"), earlier, "left_anti")
               .select("conversation_id", "call_id", F.col("out_seq").alias("seq"), F.lit("(unknown)").alias("name"),
                       F.lit("").alias("args"), "output"))
    return paired.unionByName(orphans)


def feedback_rollup(feedback: DataFrame) -> DataFrame:
    wide = feedback.filter(F.col("value").isin("up", "down")).groupBy("conversation_id").pivot("value", ["up", "down"]).count()
    return wide.fillna(0, ["up", "down"])


def entity_mentions(messages: DataFrame, text_col: str, prefix: str = "SUB-") -> DataFrame:
    return messages.withColumn("subscriber_id", X.entity_id(F.col(text_col), prefix))
