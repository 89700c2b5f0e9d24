"""Operator 3. Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

1. A digest of (seed, id) orders the documents of each source and deals them to ``shards``
   streams through 4096 buckets, so a source that holds a third of all rows spreads over as
   many tasks as any other.
2. Each stream of T words is cut into n = round(T / block_tokens) equal blocks (one word apart).
3. Targets: weights of the sources times ``total_share`` of all words, filled up to at most
   ``max_repeats`` times a source's own words, the excess reshared by weight.
4. Sainte-Lague hands the blocks of the whole mix to the sources by highest quotients
   target / (2k - 1), then each source's blocks to its streams in the same way.
5. A stream with quota q takes every block q div n times and, from a seeded block on, q mod n
   blocks in a row, cyclically. The order is already random, so the run is a random choice. It ends inside
   at most two documents of a stream; ``mixed_documents`` moves those ends to the nearer border.

Defined results: a null text has no words and is never taken; a null source is the last source;
a null id is a value like any other; repeated rows each count; with no words at all every target
is 0; an empty table gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RX, carried, col, packed, stored, unpacked

WEIGHTS, BLOCK_TOKENS, STREAMS, SEED = (5, 2, 1), 32, 8, 7
KEY = ["no_src", "src"]


def seeded(*parts: Column) -> Column:
    """60 bits of a digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], repeats: int) -> DataFrame:
    """(no_src, src, size) -> + weight, target. One row per source. ``share``: a fraction.

    Water level: with the sources sorted by repeats * size / weight, the first k are full; k is
    the smallest for which the level shared by the rest stays below the next one's limit."""
    num, den = share
    everything = Window.orderBy(*KEY)
    s = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                  (F.row_number().over(everything) - 1) % len(weights) + 1).cast("long"))
    s = s.withColumn("cap", F.lit(repeats) * F.col("size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), *KEY)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = (s.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("open", F.sum("weight").over(rest))
         .withColumn("all", F.sum("size").over(whole)))
    # level = (num * all / den - full) / open, kept as one fraction so that it is rounded once
    s = s.withColumn("up", F.lit(num) * F.col("all") - F.lit(den) * F.col("full")).withColumn("down", F.lit(den) * F.col("open"))
    wide = [F.col(c).cast("decimal(19,0)") for c in ("up", "weight", "cap", "down")]
    fits = wide[0] * wide[1] <= wide[2] * wide[3]
    first = F.min(F.when(fits, F.struct("full", F.col("up").alias("u"), F.col("down").alias("d")))).over(whole)
    s = s.withColumn("at", first).withColumn("rank", F.row_number().over(by_level))
    k = F.min(F.when(fits, F.col("rank"))).over(whole)
    return s.withColumn("k", k).select(
        *KEY, "size", "weight",
        F.when((F.col("rank") < F.col("k")) | F.col("k").isNull(), F.col("cap").cast("double"))
        .otherwise((F.col("weight") * F.col("at")["u"]).cast("double") / F.col("at")["d"].cast("double")).alias("target"))


def sainte_lague(parties: DataFrame, by: list[str], order: list[str], votes: str, seats: str) -> DataFrame:
    """Add ``quota``: within each group of equal ``by``, ``seats`` seats go to the rows by highest
    quotients votes / (2k - 1), ties in ``order``.

    With n parties, V votes and H seats the final divisor lies between V / (H + n) and
    V / (H - n), so a party's seats are known up to 2n * votes / V + 2; only those quotients
    are listed, O(n) in all however many seats there are."""
    group = Window.partitionBy(*by)
    p = (parties.withColumn("v_all", F.sum(votes).over(group).cast("double"))
         .withColumn("n_all", F.count("*").over(group)))
    share = F.when(F.col("v_all") > 0, F.col(votes) / F.col("v_all")).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0), F.floor(share * F.greatest(F.lit(0), F.col(seats) - F.col("n_all")) - 1))
    high = F.ceil(share * (F.col(seats) + F.col("n_all")) + 1)
    p = p.withColumn("low", F.when(F.col(votes) > 0, low).otherwise(F.lit(0)).cast("long"))
    p = p.withColumn("high", F.when(F.col(votes) > 0, high).otherwise(F.lit(0)).cast("long"))
    p = p.withColumn("left", F.col(seats) - F.sum("low").over(group))
    bids = (p.filter(F.col("high") > F.col("low"))
            .select(*by, *order, F.col(votes).alias("v"), "left", F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("k")))
    best = Window.partitionBy(*by).orderBy((F.col("v") / (2 * F.col("k") - 1)).desc(), *order)
    won = (bids.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= F.col("left"))
           .groupBy(*by, *order).agg(F.count("*").alias("more")))
    on = list(dict.fromkeys([*by, *order]))
    return (p.join(won, on, "left")
            .withColumn("quota", F.col("low") + F.coalesce(F.col("more"), F.lit(0)))
            .drop("v_all", "n_all", "low", "high", "left", "more"))


def mix_plan(rows: DataFrame, weights, share, repeats, block_tokens, streams, seed) -> DataFrame:
    """One row per (source, bucket): where the bucket starts in its stream and what the stream takes."""
    buckets = stored(rows.groupBy(*KEY, "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    buckets = buckets.withColumn("stream", (F.col("bucket") % streams).cast("int"))
    sizes = buckets.groupBy(*KEY).agg(F.sum("words").alias("size"))
    t = targets(sizes, weights, share, repeats)
    t = t.withColumn("house", F.round(F.sum("target").over(Window.partitionBy()) / block_tokens).cast("long")).withColumn("one", F.lit(1))
    t = sainte_lague(t, ["one"], KEY, "target", "house").withColumnRenamed("quota", "blocks").drop("one", "house")
    per_stream = buckets.groupBy(*KEY, "stream").agg(F.sum("words").alias("words"))
    s = per_stream.join(t, KEY)
    s = sainte_lague(s, KEY, ["stream"], "words", "blocks")
    n = F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / block_tokens))).otherwise(F.lit(0)).cast("long")
    s = s.withColumn("n", n).withColumn("q", F.least(F.col("quota"), F.lit(repeats) * F.col("n")))
    s = s.withColumn("start", F.when(F.col("n") > 0, seeded(F.lit(seed), F.col("src"), F.col("stream")) % F.col("n")).otherwise(F.lit(0)))
    order = Window.partitionBy(*KEY, "stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    b = buckets.withColumn("offset", F.coalesce(F.sum("words").over(order), F.lit(0))).drop("words")
    return b.join(s.select(*KEY, "stream", "size", "target", "words", "n", "q", "start")
                  .withColumnRenamed("size", "source_size"), [*KEY, "stream"])


def edge(block: Column) -> Column:
    """First word of a block: block * words / n, rounded down, in whole numbers of any size."""
    rest = block.cast("decimal(19,0)") * F.expr("CAST(words % n AS DECIMAL(19,0))")
    return block * F.expr("words div n") + F.call_function("div", rest, F.col("n").cast("decimal(19,0)"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), repeats: int = 2,
          block_tokens: int = BLOCK_TOKENS, streams: int = STREAMS, seed: int = SEED, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source",
          carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` packed in ``row`` with size, source_size, target, ``full`` (whole copies)
    and ``parts`` (array of word ranges taken once more), taken."""
    size = F.coalesce(F.regexp_count(col(text_col), F.lit(WORD_RX)), F.lit(0)).cast("long")
    rows = packed(docs, carried(docs, carry), id=col(id_col), no_src=F.isnull(col(source_col)),
                  src=F.coalesce(col(source_col).cast("string"), F.lit("")), size=size)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("size").cast("string")))
    rows = rows.withColumn("h", digest).withColumn("bucket", F.conv(F.substring(F.col("h"), 1, 3), 16, 10).cast("int"))
    plan = stored(mix_plan(rows, weights, share, repeats, block_tokens, streams, seed), "mix-plan")
    inside = Window.partitionBy(*KEY, "bucket").orderBy("h", F.col("id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(plan, [*KEY, "bucket"]).withColumn("a", F.col("offset") + F.col("ahead")).withColumn("z", F.col("a") + F.col("size"))
    rows = rows.withColumn("full", F.when(F.col("n") > 0, F.floor(F.col("q") / F.col("n"))).otherwise(F.lit(0)).cast("int"))
    rows = rows.withColumn("run", F.when(F.col("n") > 0, F.col("q") % F.col("n")).otherwise(F.lit(0)))
    wraps = F.col("start") + F.col("run") > F.col("n")
    one = F.struct(F.greatest(F.col("a"), edge(F.col("start"))).alias("f"),
                   F.least(F.col("z"), F.when(wraps, F.col("words")).otherwise(edge(F.col("start") + F.col("run")))).alias("t"))
    two = F.struct(F.col("a").alias("f"),
                   F.least(F.col("z"), F.when(wraps, edge(F.col("start") + F.col("run") - F.col("n"))).otherwise(F.lit(0))).alias("t"))
    parts = F.when((F.col("run") > 0) & (F.col("size") > 0),
                   F.filter(F.array(two, one), lambda p: p["t"] > p["f"])).otherwise(F.expr("array()"))
    rows = rows.withColumn("parts", F.transform(parts, lambda p: F.struct((p["f"] - F.col("a")).alias("f"), (p["t"] - F.col("a")).alias("t"))))
    extra = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["t"] - p["f"])
    return rows.withColumn("taken", F.col("full") * F.col("size") + extra)


def mix_sources(docs: DataFrame, carry: list[str] | None = None, **kw) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target (its source's) and taken (words). ``carry``:
    the input columns to keep (default: all)."""
    return unpacked(mixed(docs, carry=carry, **kw), carried(docs, carry),
                    {k: F.col(k) for k in ("size", "source_size", "target", "taken")})


def mixed_documents(docs: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per copy, every document whole, byte for byte.
    A run of blocks that ends inside a document ends at its nearer border: the document comes once more
    where the run holds half of its words or more."""
    rows = mixed(docs, text_col=text_col, **kw)
    extra = F.col("taken") - F.col("full") * F.col("size")
    copies = F.col("full") + F.when((extra > 0) & (2 * extra >= F.col("size")), 1).otherwise(0)
    rows = rows.filter(F.col("size") > 0).withColumn("copy", F.explode(F.array_repeat(F.lit(True), copies)))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
