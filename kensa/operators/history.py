"""Chat history as a table: append (U1), clear (U2), roles (U3), numbering
(T7) and ordered replay (T4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.operators.numbering import number_rows

HISTORY_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def append_turns(history: DataFrame, new: DataFrame) -> DataFrame:
    """History followed by new turns (columns matched by name)."""
    return history.unionByName(new.select(*history.columns))


def next_turns(history: DataFrame, role: str, text_col) -> DataFrame:
    """New turns, one per conversation, numbered after its last turn.
    ``text_col`` is a column over the aggregated row (e.g. a prompt built
    from the first turn)."""
    per_conv = history.groupBy("conv_id").agg(
        (F.max("turn") + 1).alias("turn"), F.min_by("text", "turn").alias("first_text"))
    return per_conv.select("conv_id", "turn", F.lit(role).alias("role"), text_col.alias("text"))


def clear_history(spark, table: str) -> None:
    """Empty the history table, keeping its schema and location."""
    spark.createDataFrame([], spark.table(table).schema).write.mode("overwrite").insertInto(table)


def normalise_role(df: DataFrame, role: str = "role") -> DataFrame:
    """``user`` stays ``user``; every other role is shown as ``assistant``."""
    return df.withColumn(role, F.when(F.col(role) == "user", F.lit("user")).otherwise(F.lit("assistant")))


def number_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 out: str = "position") -> DataFrame:
    """1, 2, ... per conversation in turn order (skew-safe numbering)."""
    return number_rows(df, [conv], [turn], out=out)


def transcript(df: DataFrame) -> DataFrame:
    """T4: a replay of each conversation in order, as rows
    ``(conv_id, position, role, text)`` range-sorted by (conv_id, position).

    Rows, not one array per conversation: a very long conversation is never
    gathered into one value or one task.  The numbering leaves them in this order,
    so there is no sort behind it.
    """
    numbered = number_turns(normalise_role(df))
    return numbered.select("conv_id", "position", "role", "text")


def sample_input(df: DataFrame, key: str) -> DataFrame:
    """The first row by ``key`` as a sample model input (an explicit key:
    Spark tables have no row order).  Planned as a top-1, not a sort."""
    return df.orderBy(key).limit(1)
