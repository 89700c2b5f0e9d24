"""Demand counts kept as a state: exact distinct postings of any range of days, without the postings.

Every posting key gets a number when it first comes: the delivery (``batch``) and a number inside it, counted up in each of
``BUCKETS`` hash buckets of the keys, which the number's high bits name.
A day's partial holds, for each set of keywords and of terms that its postings have, the numbers of these postings as 64-bit words of
a bitmap, only the words with a bit: a posting's day costs a row at most, however many keywords and terms it has, and postings with
the same sets a bit each. Words are merged with ``bit_or`` and
counted with ``bit_count``, so a posting that several days hold counts once in their union, in any order and grouping.

A word's postings are all in one bucket, so rows and numbers are dealt by bucket once, then meet, merge and are counted where
they are; keywords and terms are un-nested only there, and no shuffle moves a row for each pair of them.

A delivery replaces the days that it brings; no other day is computed again. The folders of words and of new numbers are immutable,
and a commit log (:mod:`..sources.versioned`) names for every day the folder that stands and the folders of numbers, all
in one commit: a run that dies leaves the former state, two writers can't both commit, and readers see one version.

Defined results: rows without a key are no postings; a NULL date is a day like any other (outside every range), NULL terms and keywords are
values of their own; repeated rows count once; an empty delivery with ``days`` empties those days."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import measured
from ..sources import versioned as VS

BITS = 64
#: Number spaces of a delivery, each a hash bucket of the keys; a state keeps its figure.
BUCKETS = 512
#: Bits of a posting's number, and of a word's, below the bucket.
LOW, WORD_LOW = 33, 27
WORDS = "job_date DATE, kws ARRAY<STRING>, techs ARRAY<STRING>, batch INT, word BIGINT, bits BIGINT"
#: Paths of the log's entries: a folder of new numbers, the folder of a day's words.
NUMBERS, DAY, NO_DAY = "numbers/", "day/", "none"


def day_name(date) -> Column:
    return F.coalesce(F.col(date).cast("string"), F.lit(NO_DAY))


def _entry(path: str, folder: str) -> dict:
    return {"path": path, "mtime": 0, "size": 0, "key": path, "number": "0", "files": [folder]}


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket")


def posting_sets(view: DataFrame, key: str) -> DataFrame:
    """(k, job_date, kws, techs) of the rows that name a posting, from the view or its nested form."""
    lists = [(many if many in view.columns else None, one) for many, one in (("kws", "kw"), ("techs", "tech"))]
    rows = view.where(F.col(key).isNotNull())
    for many, _ in lists:
        rows = rows.where(F.size(many) > 0) if many else rows
    kws, techs = (F.sort_array(F.array_distinct(many)) if many else F.array(one) for many, one in lists)
    return rows.select(F.col(key).alias("k"), "job_date", kws.alias("kws"), techs.alias("techs"))


def deliver(spark: SparkSession, state: str, view: DataFrame, key: str = "job_key", days: DataFrame | None = None, stored: bool = False) -> int:
    """Put ``view`` (key, tech, job_date, kw: the rows of whole days) in the place of what the state held of its days; returns
    the new version. The view may come nested (:func:`..views.jobs_view`: techs, kws). ``days`` (job_date): the days delivered, where
    some of them may have no row. ``stored``: the view only reads a stored table; else it is written first, as it is read twice.

    Raises :class:`~..sources.versioned.CommitConflict` where another writer committed meanwhile; the call can then be repeated."""
    version = VS.last_version(spark, state)
    known = VS.state(spark, state, version).where(F.col("path").startswith(NUMBERS)).select(F.col("files")[0]).collect()
    schema = f"k {view.schema[key].dataType.simpleString()}, batch INT, id BIGINT"
    rows = posting_sets(view, key)
    if not stored:
        rows = measured(rows, "delivered")
    keys = rows.select("k").distinct()
    new, words = uuid.uuid4().hex, uuid.uuid4().hex

    def numbers(folders: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{state}/data/{f}" for f in folders])

    folders = [r[0] for r in known]
    if folders:
        keys = keys.join(numbers(folders), "k", "left_anti")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("k")) - 1
    (keys.select("k", bucket_of("k")).select("k", F.lit(version + 1).alias("batch"), (F.shiftleft(F.col("bucket").cast("long"), LOW) + place).alias("id"))
     .write.parquet(f"{state}/data/{new}"))
    # a key's rows and its number, dealt by bucket: neither the window nor the words need another shuffle; words of equal sets lie
    # side by side, which files and shuffles compress
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("job_date", "kws", "techs")]
    dealt = (rows.select(bucket_of("k"), "k", "job_date", "kws", "techs", F.lit(None).cast("int").alias("batch"), F.lit(None).cast("long").alias("id"))
             .unionAll(numbers([*folders, new]).select(bucket_of("k"), "k", *none, "batch", "id")).repartition("bucket"))
    own = Window.partitionBy("bucket", "k")
    placed = dealt.select("bucket", "job_date", "kws", "techs", F.max("batch").over(own).alias("batch"), F.max("id").over(own).alias("id")).where("kws IS NOT NULL")
    (placed.groupBy("bucket", "job_date", "kws", "techs", "batch", F.expr(f"id div {BITS}").alias("word"))
     .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(id % {BITS} AS INT))")).alias("bits"))
     .sortWithinPartitions(F.xxhash64("kws", "techs"), "job_date", "word").drop("bucket").write.parquet(f"{state}/data/{words}"))
    held = spark.read.schema(WORDS).parquet(f"{state}/data/{words}").select(day_name("job_date").alias("d"))
    if days is not None:
        held = held.unionAll(days.select(day_name("job_date")))
    brought = [r.d for r in held.distinct().collect()]  # a row a calendar day
    return VS.write_commit(spark, state, version + 1, [*[_entry(DAY + d, words) for d in brought], _entry(NUMBERS + new, new)])


def partials(spark: SparkSession, state: str, first=None, last=None, version: int | None = None) -> DataFrame:
    """The words (job_date, kws, techs, batch, word, bits, bucket) of the days that stand, from ``first`` to ``last`` (dates, each may be
    left out), dealt by bucket."""
    days = VS.state(spark, state, version).where(F.col("path").startswith(DAY)).select(
        F.substring("path", len(DAY) + 1, 32).alias("day"), F.col("files")[0].alias("folder"))
    inside = F.lit(True)
    for limit, low in ((first, True), (last, False)):
        if limit is not None:
            days = days.where((F.col("day") != NO_DAY) & (F.col("day") >= str(limit) if low else F.col("day") <= str(limit)))
            inside = inside & (F.col("job_date") >= F.lit(limit).cast("date") if low else F.col("job_date") <= F.lit(limit).cast("date"))
    folders = sorted(r.folder for r in days.select("folder").distinct().collect())  # one a delivery
    if not folders:
        return spark.createDataFrame([], f"{WORDS}, bucket BIGINT")
    rows = spark.read.schema(WORDS).parquet(*[f"{state}/data/{f}" for f in folders]).where(inside)
    rows = rows.withColumn("folder", F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1))
    days = days.select("folder", F.when(F.col("day") != NO_DAY, F.col("day").cast("date")).alias("day"))
    # a row a calendar day: an older folder's rows of a day that came again find no partner
    stand = rows.join(F.broadcast(days), (rows.folder == days.folder) & rows.job_date.eqNullSafe(days.day), "left_semi").drop("folder")
    return stand.withColumn("bucket", F.shiftright("word", WORD_LOW)).repartition("bucket")


def count_postings(words: DataFrame, *by: str) -> DataFrame:
    """(by, n_postings): distinct postings of each group (of kw, tech, job_date), over all the days in ``words``."""
    for many, one in (("kws", "kw"), ("techs", "tech")):
        if one in by:
            words = words.select(*[c for c in words.columns if c != many], F.explode(many).alias(one))
    merged = words.groupBy("bucket", *by, "batch", "word").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bit_count("bits").cast("long")).alias("n_postings"))


def demand(words: DataFrame) -> DataFrame:
    """:func:`..views.demand_by_keyword` of the days in ``words``."""
    return count_postings(words, "kw", "tech")


def trend(words: DataFrame) -> DataFrame:
    """:func:`..views.demand_trend` of the days in ``words``."""
    w = Window.partitionBy("tech").orderBy("job_date")
    return (count_postings(words, "tech", "job_date")
            .withColumn("prev_n_postings", F.lag("n_postings").over(w)).withColumn("prev_date", F.lag("job_date").over(w)))


def touched_days(postings: DataFrame, keys: DataFrame, key: str = "job_key") -> DataFrame:
    """(job_date): the days that hold one of ``keys``, to be delivered again where a search names those postings by new keywords."""
    return postings.join(keys.select(key).distinct(), key, "left_semi").select("job_date").distinct()
