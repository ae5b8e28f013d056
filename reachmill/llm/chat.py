r"""Chat formatting by prefix-target expansion. Built-in functions only.

A conversation is written turn after turn as <s>role, a line feed, the text, </s>. Each
assistant turn becomes an example of its own: all turns before it and the opening of its
own turn are the prompt, its text and the closing mark are the completion, and only the
text of the completion is trained. If the last turn is not the assistant's, one more row
without completion carries the whole conversation, so every turn is in the output.

Control strings inside texts and roles get a backslash after their first character, and
those that already have backslashes there one more; taking one away again restores any
text exactly.

Defined cases: turns are ordered by turn, then role, then text, nulls first; a null text
or role counts as empty; a null conversation id is a conversation like any other;
repeated rows are turns of their own; an empty table has no examples; other columns are
not read. One conversation is one row, as one training context is: it has to fit into
memory, the table need not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The strings with a meaning to a chat model.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>"]
_TAILS = "|".join(sorted({c[1:].replace("[", r"\[").replace("]", r"\]") for c in CONTROL}))
_TO_ESCAPE = rf"([<\[])(\\*)(?={_TAILS})"
_TO_RESTORE = rf"([<\[])\\(\\*)(?={_TAILS})"
OPEN, CLOSE = "<s>", "</s>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _TO_ESCAPE, r"$1\\$2")


def restored(text: Column) -> Column:
    return F.regexp_replace(text, _TO_RESTORE, "$1$2")


def _one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_back(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def examples(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, example (its number from 0), trainable, prompt, completion, is_last, and the
    code points of prompt and completion. Prompts repeat what came before, so they are only
    built when asked for: a query that reads the lengths alone never makes them."""
    said = turns.select(
        F.col(key).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    talks = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    head = lambda t: F.concat(F.lit(OPEN), escaped(_one_line(t["role"])), F.lit("\n"))
    parts = F.transform(
        "said",
        lambda t: F.struct(head(t).alias("head"), F.concat(escaped(t["text"]), F.lit(CLOSE)).alias("body"), (t["role"] == "assistant").alias("own")),
    )
    parted = talks.select("conv_id", parts.alias("parts"))
    sizes = F.transform("parts", lambda p: F.char_length(p["head"]) + F.char_length(p["body"]))
    # the code points before each turn, as a running sum over the turns
    before = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda seen, n: F.concat(seen, F.array(F.element_at(seen, -1) + n)))
    last = F.size("parts") - 1
    chosen = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(F.col("parts"), i)["own"])
    own_end = F.get(F.col("parts"), last)["own"]
    targets = F.when(own_end, chosen).otherwise(F.concat(chosen, F.array(last + 1)))
    rows = parted.withColumn("before", before).select("conv_id", "parts", "before", F.posexplode(targets).alias("example", "target"))
    part = F.get(F.col("parts"), F.col("target"))
    trainable = F.col("target") < F.size("parts")
    context = F.array_join(F.transform(F.slice("parts", 1, F.col("target")), lambda p: F.concat(p["head"], p["body"])), "")
    return rows.select(
        "conv_id",
        "example",
        trainable.alias("trainable"),
        F.concat(context, F.when(trainable, part["head"]).otherwise("")).alias("prompt"),
        F.when(trainable, part["body"]).otherwise("").alias("completion"),
        (F.col("target") >= F.size("parts") - 1).alias("is_last"),
        (F.get(F.col("before"), F.col("target")) + F.when(trainable, F.char_length(part["head"])).otherwise(0)).alias("prompt_chars"),
        F.when(trainable, F.char_length(part["body"])).otherwise(0).cast("long").alias("completion_chars"),
    )


def trained_text(completion: Column) -> Column:
    """The text under the loss mask: the completion without its closing mark, unescaped."""
    return restored(F.substring(completion, F.lit(1), F.char_length(completion) - len(CLOSE)))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of role and text, as they were."""
    closed = F.split(formatted, CLOSE, -1)
    pieces = F.slice(closed, 1, F.size(closed) - 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            _role_back(restored(F.substring(F.substring_index(p, "\n", 1), len(OPEN) + 1, 1 << 30))).alias("role"),
            restored(F.substring(p, F.char_length(F.substring_index(p, "\n", 1)) + 2, F.lit(1 << 30))).alias("text"),
        ),
    )
