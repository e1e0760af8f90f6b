"""Records as training texts: chat messages, instruction records, prompt and response, rendered templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import coerce, is_blank

# What the system message says.
SYSTEM_PROMPT = "You are an expert coding assistant."


def messages(prompt: Column, response: Column, system: str = SYSTEM_PROMPT) -> Column:
    """System, user and assistant message, as array of (role, content)."""
    return F.array(*(F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in (("system", F.lit(system)), ("user", prompt), ("assistant", response))))


def prompt_with_input(instruction: Column, input: Column) -> Column:
    """The instruction, with a non-empty input under the heading ``Input:``."""
    return F.when(F.coalesce(input, F.lit("")) != "", F.concat(instruction, F.lit("\n\nInput:\n"), input)).otherwise(instruction)


def chat_messages(instruction: Column, input: Column, output: Column) -> Column:
    """Messages for tokenization: a non-blank input follows the instruction in a fence."""
    user = F.when(~is_blank(input), F.concat(instruction, F.lit("\n\n```\n"), input, F.lit("\n```"))).otherwise(instruction)
    return messages(user, output)


def render(chat: Column) -> Column:
    """Messages as text with start and end marks."""
    return F.array_join(F.transform(chat, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")


def to_alpaca(df: DataFrame, *keep: str) -> DataFrame:
    """(instruction, input, output, _source), stripped; rows with a blank instruction or output drop out."""
    source = coerce(F.col("dataset")) if "dataset" in df.columns else F.lit("unknown")
    text = lambda c: coerce(F.col(c)) if c in df.columns else F.lit("")
    return df.select(*keep, text("instruction").alias("instruction"), text("input").alias("input"), text("output").alias("output"), source.alias("_source")).filter("instruction <> '' AND output <> ''")


def to_prompt_response(df: DataFrame, *keep: str) -> DataFrame:
    """(prompt, response); nulls count as empty texts."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return df.select(*keep, prompt_with_input(text("instruction"), text("input")).alias("prompt"), text("output").alias("response"))
