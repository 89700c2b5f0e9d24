"""Request planning for the term extractor: chat payloads, token cost, request ids,
and the per-minute budget plan.

Consecutive ids and running totals need a global order. Instead of one window over
the whole table (a single task), rows are range-partitioned on the order key, the
partition membership is pinned with a reliable checkpoint, per-partition totals (one
row per partition) give exclusive prefix offsets, and each partition adds its local
running sum to its offset — the same two-pass scheme as zipWithIndex.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules as R
from ..functions import text as X


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message(role: str, content) -> Column:
    return F.struct(F.lit(role).alias("role"), _col(content).cast("string").alias("content"))


def build_messages(system: str, examples: list[tuple[str, str]], question: str, text) -> Column:
    """system, (user example, assistant answer) x N, then user = question + ' ' + text."""
    msgs = [message("system", F.lit(system))]
    for ask, answer in examples:
        msgs += [message("user", F.lit(ask)), message("assistant", F.lit(answer))]
    msgs.append(message("user", F.concat(F.lit(question + " "), _col(text))))
    return F.array(*msgs)


def payload_json(model: str, messages, temperature: float) -> Column:
    return F.to_json(F.struct(F.lit(model).alias("model"), _col(messages).alias("messages"),
                              F.lit(float(temperature)).alias("temperature")))


def message_tokens(role, content, name=None, counter=X.token_count) -> Column:
    """Tokens of one chat message: 4 framing + role + content (+ name - 1)."""
    t = F.lit(R.TOKENS_PER_MESSAGE) + counter(role) + counter(content)
    if name is not None:
        t = t + F.when(_col(name).isNotNull(), counter(name) - F.lit(1)).otherwise(F.lit(0))
    return t


def request_cost(prompt_tokens, n: int = 1, max_tokens: int = R.COMPLETION_TOKENS) -> Column:
    """Prompt tokens + reply primer + n x completion allowance."""
    return _col(prompt_tokens) + F.lit(R.TOKENS_REPLY_PRIMER) + F.lit(n * max_tokens)


def messages_cost(messages, n: int = 1, max_tokens: int = R.COMPLETION_TOKENS) -> Column:
    """Cost of a request whose messages are an ARRAY<STRUCT<role, content>>."""
    per = F.transform(_col(messages), lambda m: message_tokens(m["role"], m["content"]))
    total = F.aggregate(per, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return request_cost(total, n, max_tokens)


# --- global order: ids and running totals ------------------------------------

_LOCAL_COLS = ("_part", "_off_sum", "_off_cnt")


def running_totals(df: DataFrame, order_col: str, value_col: str, num_partitions: int | None = None,
                   sum_col: str = "cum_value", index_col: str = "row_index") -> DataFrame:
    """Add ``index_col`` (0, 1, 2 … in ``order_col`` order) and ``sum_col`` (running sum
    of ``value_col`` including the row). ``order_col`` must be unique."""
    spark = df.sparkSession
    from ..session import checkpoint_dir
    checkpoint_dir(spark)  # makes sure a reliable checkpoint folder is configured
    # Without an explicit count AQE may coalesce the range partitions to fit the data;
    # it merges only adjacent ranges, so the order is kept. The checkpoint pins the ids.
    ranged = df.repartitionByRange(num_partitions, order_col) if num_partitions \
        else df.repartitionByRange(order_col)
    ranged = ranged.withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)
    totals = ranged.groupBy("_part").agg(F.sum(value_col).alias("_tot"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_tot").over(before), F.lit(0)).cast("double").alias("_off_sum"),
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long").alias("_off_cnt"))
    # one row per partition: bounded by the partition count, so broadcast
    staged = ranged.join(F.broadcast(offsets), "_part", "inner").sortWithinPartitions(order_col)

    out_schema = T.StructType(
        [f for f in staged.schema.fields if f.name not in _LOCAL_COLS]
        + [T.StructField(index_col, T.LongType()), T.StructField(sum_col, T.DoubleType())])
    keep = [f.name for f in staged.schema.fields if f.name not in _LOCAL_COLS]

    def local(batches):
        run_sum, run_cnt = None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            if run_sum is None:
                run_sum = float(pdf["_off_sum"].iloc[0])
                run_cnt = int(pdf["_off_cnt"].iloc[0])
            vals = pdf[value_col].astype("float64").fillna(0.0)
            cum = vals.cumsum() + run_sum
            idx = pd.Series(range(run_cnt, run_cnt + len(pdf)), index=pdf.index, dtype="int64")
            out = pdf[keep].copy()
            out[index_col] = idx
            out[sum_col] = cum
            run_sum = float(cum.iloc[-1])
            run_cnt += len(pdf)
            yield out

    return staged.mapInPandas(local, out_schema)


def budget_minutes(cum_cost, index, max_tokens_per_minute: int = R.MAX_TOKENS_PER_MINUTE,
                   max_requests_per_minute: int = R.MAX_REQUESTS_PER_MINUTE) -> Column:
    """Minute in which a request can start without exceeding either per-minute limit."""
    by_tokens = F.floor((_col(cum_cost) - F.lit(1)) / F.lit(max_tokens_per_minute))
    by_count = F.floor(_col(index) / F.lit(max_requests_per_minute))
    return F.greatest(by_tokens, by_count).cast("long")
