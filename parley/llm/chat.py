"""Chat formatting of logged conversations: cumulative snapshots are collapsed, the maximal ones rendered.

A log often holds a conversation again and again, each time longer. A rolling hash over its turns
identifies every prefix of a conversation; one whose last hash is a proper prefix hash of another is
dropped by an anti-join, and of equal ones the smallest id stays. What is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import materialize

# The marks around a turn in the ChatML format.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def snapshots(turns: DataFrame) -> DataFrame:
    """A row for each turn with ``role``, ``text``, its place ``at`` from 1, the rolling hash ``h1, h2`` of all up to it, and whether it is the ``last``.

    The hash is a running sum of 128 bits of hash of place, role and text, so it grows by one addition a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    clean = turns.where("conv_id is not null").select(F.col("conv_id"), F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    # repeated rows go before turns are ordered, so that a conversation logged many times under one id stays small
    once = clean.groupBy("conv_id", "turn", "role", "text").agg(F.lit(1).alias("one")).drop("one")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = once.withColumn("at", F.row_number().over(order)).withColumn("last", F.lead(F.lit(1)).over(order).isNull())
    running = lambda seed: F.sum(F.xxhash64(F.lit(seed), "at", "role", "text").cast("decimal(20,0)")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return placed.select("conv_id", "role", "text", "at", "last", running(1).alias("h1"), running(2).alias("h2"))


def maximal(rows: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations of ``snapshots`` that are no proper prefix of another, and of equal ones the smallest id."""
    prefixes = rows.where("not last").select("h1", "h2").distinct()
    whole = rows.where("last").groupBy("h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    return whole.join(prefixes, ["h1", "h2"], "left_anti").select("conv_id")


def rendered(body: Column, add_prompt: bool = False) -> Column:
    """The conversation in ChatML, one turn after another; optionally the start of an assistant's turn at the end."""
    turns = F.transform(body, lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit("\n"), t["text"], F.lit(TURN_END + "\n")))
    out = F.array_join(turns, "")
    return F.concat(out, F.lit(TURN_START + "assistant\n")) if add_prompt else out


def format_chats(turns: DataFrame, add_prompt: bool = False) -> DataFrame:
    """``conv_id, n_turns, n_chars, rendered``: the maximal conversations of rows ``conv_id, turn, role, text``.

    Turns are ordered by number, then role, then text; a null number comes first, null roles and texts
    count as empty, and rows without an id are left out. Only conversations that are kept are gathered. Rows that repeat a turn word for word count
    once. Two conversations are compared by their roles and texts in order, not by their turns'
    numbers. An empty table gives an empty result; other columns play no part.
    """
    rows, _ = materialize(snapshots(turns), "chat-snapshots")
    kept = rows.join(maximal(rows), "conv_id", "left_semi")
    body = F.sort_array(F.collect_list(F.struct("at", "role", "text")))
    gathered = kept.groupBy("conv_id").agg(body.alias("body"))
    out = gathered.select("conv_id", F.size("body").cast("long").alias("n_turns"), rendered(F.col("body"), add_prompt).alias("rendered"))
    return out.select("conv_id", "n_turns", F.length("rendered").cast("long").alias("n_chars"), "rendered")


CHAT_SQL = """
with t as (select distinct conv_id, coalesce(turn, -1) turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
c as (select conv_id, count(*) n, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by turn, role, text) r,
  string_agg(length(role)::varchar || ':' || role || length(text)::varchar || ':' || text || chr(1), '' order by turn, role, text) k from t group by conv_id)
select conv_id, n::bigint as n_turns, length(r)::bigint as n_chars, r as rendered from c a
where not exists (select 1 from c b where starts_with(b.k, a.k) and length(b.k) > length(a.k))
and not exists (select 1 from c b where b.k = a.k and b.conv_id < a.conv_id)
"""
