"""Conversation logs: storing, restoring and querying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import running, top_per_key

SESSION_SCHEMA = "user_id BIGINT, page BIGINT, messages ARRAY<STRUCT<type STRING, content STRING>>"
PAGE = 1000


def positions(messages: DataFrame, key: str = "conv_id") -> DataFrame:
    """Messages with ``position`` 1, 2, ... inside each conversation; turns are blocked by the thousand."""
    return running(
        messages, [key], ["turn", "role", "text"], F.floor(F.col("turn") / 1000), position=F.lit(1).cast("bigint")
    )


def session_pages(messages: DataFrame, page: int = PAGE) -> DataFrame:
    """Conversations as ordered message arrays of at most ``page`` messages."""
    row = F.struct(
        "position",
        F.when(F.col("role") == "user", "human").otherwise("ai").alias("type"),
        F.col("text").alias("content"),
    )
    numbered = positions(messages).withColumn("page", F.floor((F.col("position") - 1) / page))
    packed = numbered.groupBy(F.col("conv_id").alias("user_id"), "page").agg(F.array_sort(F.collect_list(row)).alias("m"))
    return packed.select(
        "user_id", "page", F.transform("m", lambda x: F.struct(x["type"].alias("type"), x["content"].alias("content"))).alias("messages")
    )


def write_sessions(messages: DataFrame, path: str, page: int = PAGE) -> None:
    session_pages(messages, page).write.json(path)


def load_sessions(pages: DataFrame, page: int = PAGE) -> DataFrame:
    """(input, output) pairs in order; a last message without partner is dropped."""
    rows = pages.select("user_id", "page", F.posexplode("messages").alias("i", "m"))
    rows = rows.withColumn("at", F.col("page") * page + F.col("i"))
    pairs = rows.groupBy("user_id", F.floor(F.col("at") / 2).alias("interaction")).agg(
        F.max(F.when(F.col("at") % 2 == 0, F.col("m.content"))).alias("input"),
        F.max(F.when(F.col("at") % 2 == 1, F.col("m.content"))).alias("output"),
        F.count("*").alias("n"),
    )
    return pairs.where(F.col("n") == 2).drop("n")


# ---- history memories


def history_buffer(messages: DataFrame) -> DataFrame:
    """Each message with the size of the buffer up to it.

    The buffer at a turn is the rows with ``position`` up to that turn's, so it is kept as
    positions and running sizes; writing it out at every turn would be quadratic.
    """
    return running(
        messages, ["conv_id"], ["turn", "role", "text"], F.floor(F.col("turn") / 1000),
        position=F.lit(1).cast("bigint"), buffer_chars=F.length("text").cast("bigint"),
    )


def history_at(messages: DataFrame, position: int) -> DataFrame:
    """The buffer of every conversation as it stood at ``position``."""
    return positions(messages).where(F.col("position") <= position)


def history_window(messages: DataFrame, k: int) -> DataFrame:
    """The last ``k`` interactions, that is ``2 k`` messages, of every conversation."""
    order = [F.col("turn").desc(), F.col("role").desc(), F.col("text").desc()]
    return top_per_key(messages, ["conv_id"], order, 2 * k, "age")


def history_budget(messages: DataFrame, budget: int) -> DataFrame:
    """The newest messages whose joint length stays within ``budget`` characters."""
    sized = history_buffer(messages)
    total = messages.groupBy("conv_id").agg(F.sum(F.length("text")).alias("total_chars"))
    sized = sized.join(total, "conv_id")
    used = F.col("total_chars") - F.col("buffer_chars") + F.length("text")
    return sized.withColumn("used_chars", used).where(F.col("used_chars") <= budget)


def history_costs(messages: DataFrame, k: int, budget: int) -> DataFrame:
    """Context characters per conversation under the three memories."""
    chars = F.coalesce(F.sum(F.length("text")), F.lit(0))
    full = messages.groupBy("conv_id").agg(chars.alias("buffer_chars"))
    window = history_window(messages, k).groupBy("conv_id").agg(chars.alias("window_chars"))
    fits = history_budget(messages, budget).groupBy("conv_id").agg(chars.alias("budget_chars"))
    return full.join(window, "conv_id", "left").join(fits, "conv_id", "left").fillna(0, ["window_chars", "budget_chars"])


def migrate_sessions(known: DataFrame, anonymous: DataFrame, logins: DataFrame) -> DataFrame:
    """Append anonymous sessions after the history of the user who logged in, renumbering."""
    moved = anonymous.drop("user_id").join(logins, "conv_id").withColumn("migrated", F.lit(1))
    both = known.withColumn("migrated", F.lit(0)).unionByName(moved)
    block = F.struct("migrated", "conv_id", F.floor(F.col("turn") / 1000).alias("b"))
    return running(both, ["user_id"], ["migrated", "conv_id", "turn", "role", "text"], block, position=F.lit(1).cast("bigint"))


def fold_slots(updates: DataFrame, keys: list[str], slot: str, value: str, order: Column, slots: list[str], required: list[str]) -> DataFrame:
    """Last written value per slot, and whether every required slot is filled."""
    out = updates.groupBy(*keys).agg(
        *[F.max_by(F.when(F.col(slot) == s, F.col(value)), F.when(F.col(slot) == s, order)).alias(s) for s in slots]
    )
    done = F.lit(True)
    for s in required:
        done = done & F.col(s).isNotNull()
    return out.withColumn("is_complete", done)
