"""Run bookkeeping: row-count reconciliation, status counters, quarantine split,
recency filter. All are aggregations with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(inputs: DataFrame, outputs: DataFrame, by: str) -> DataFrame:
    """(by, n_in, n_out, consistent) — input vs output row counts per group."""
    a = inputs.groupBy(by).agg(F.count(F.lit(1)).alias("n_in"))
    b = outputs.groupBy(by).agg(F.count(F.lit(1)).alias("n_out"))
    j = a.join(b, by, "full_outer")
    return j.select(by, F.coalesce("n_in", F.lit(0)).alias("n_in"), F.coalesce("n_out", F.lit(0)).alias("n_out")) \
            .withColumn("consistent", F.col("n_in") == F.col("n_out"))


def run_status(df: DataFrame, by: str, failed: Column, rate_limited: Column | None = None,
               api_error: Column | None = None) -> DataFrame:
    """Per group: started, succeeded, failed, and of the failed ones rate_limited, api_errors (other
    errors of the service) and other_errors. A NULL condition counts as false."""
    bad, none = F.coalesce(failed, F.lit(False)), F.lit(False)
    limited = bad & F.coalesce(rate_limited if rate_limited is not None else none, none)
    api = bad & ~limited & F.coalesce(api_error if api_error is not None else none, none)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("started"), F.count_if(~bad).alias("succeeded"), F.count_if(bad).alias("failed"),
        F.count_if(limited).alias("rate_limited"), F.count_if(api).alias("api_errors"),
        F.count_if(bad & ~limited & ~api).alias("other_errors"))


def split_quarantine(df: DataFrame, bad: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows + ``result`` = [reason]) — a bad row never fails the job."""
    flagged = df.withColumn("_bad", F.coalesce(bad, F.lit(True)))
    good = flagged.where(~F.col("_bad")).drop("_bad")
    quarantined = flagged.where(F.col("_bad")).drop("_bad").withColumn("result", F.array(reason))
    return good, quarantined


def recent_only(df: DataFrame, ts_col: str, days: int, now=None) -> DataFrame:
    """Rows no older than ``days`` before ``now`` (a datetime; default: the newest row's
    time, found by one aggregate over the time column).

    The cut-off is a typed literal, so the predicate reaches the Parquet scan and row
    groups older than the window are skipped (a subquery bound would not be pushed)."""
    import datetime as dt
    if now is None:
        now = df.agg(F.max(ts_col)).first()[0]
    if now is None:  # empty input
        return df.where(F.lit(False))
    cutoff = now - dt.timedelta(days=days)
    bound = F.lit(cutoff.isoformat(sep=" ")).cast(df.schema[ts_col].dataType)
    return df.where(F.col(ts_col) >= bound)


def threshold_for_recall(scored: DataFrame, score_col: str, label_col: str, recall: float) -> DataFrame:
    """One row (threshold, n_positive, n_kept, recall, precision): the highest score at which the rows from it up hold
    at least ``recall`` of the positive ones (label 1), and what they are then.

    Counts per score are summed in order of the score by :func:`.planning.running_totals`, over as many tasks as there
    are partitions; rows without a score or label don't count; without a positive row the result is empty."""
    from ..session import measured
    from .planning import running_totals
    rows = scored.select(F.col(score_col).alias("score"), F.col(label_col).cast("int").alias("label")).where("score IS NOT NULL AND label IN (0, 1)")
    rows = measured(rows, "scored")  # two numbers a row, read three times
    per = rows.groupBy((-F.col("score")).alias("down")).agg(F.sum(F.col("label").cast("long")).alias("positive"))
    total = per.agg(F.sum("positive")).first()[0] or 0
    found = running_totals(per, "down", "positive", sum_col="so_far", index_col="place")
    # a count of rows is whole, so the share is compared in millionths, without a rounded product
    enough = (F.col("so_far") * F.lit(1e6) >= F.lit(float(round(recall * 1_000_000) * total))) & F.lit(total > 0)
    at = found.where(enough).agg((-F.min("down")).alias("threshold")).where("threshold IS NOT NULL")
    kept = rows.join(F.broadcast(at), F.col("score") >= F.col("threshold"))  # one row
    return kept.groupBy("threshold").agg(F.lit(total).cast("long").alias("n_positive"), F.count(F.lit(1)).alias("n_kept"),
                                         (F.sum("label") / F.lit(total)).alias("recall"), F.avg("label").alias("precision"))
