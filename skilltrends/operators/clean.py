"""Term cleaning: removal, rule mapping, stop-lists, aliases, date stamping.

Rule sets in code become literal per-row expressions (no join, no shuffle). A *table* of rules, words or aliases may
have any number of rows: up to ``rule_index.INLINE`` they become the same expressions, more are
resolved once for each distinct term (:mod:`.rule_index`) and joined, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import terms as T
from ..session import measured
from . import rule_index as RI
from .joins import split_join


def remove_terms(df: DataFrame, col: str = "cleaned_techs",
                 patterns: list[str] = R.REMOVE_PATTERNS) -> DataFrame:
    return df.withColumn(col, T.remove_matching(col, patterns))


def map_terms(df: DataFrame, col: str = "cleaned_techs",
              rules: list[tuple[str, str]] = R.MAP_RULES, dedupe: bool = False) -> DataFrame:
    mapped = T.map_first_match(col, rules)
    return df.withColumn(col, F.array_distinct(mapped) if dedupe else mapped)


def clean_terms(df: DataFrame, col: str = "cleaned_techs",
                patterns: list[str] = R.REMOVE_PATTERNS,
                rules: list[tuple[str, str]] = R.MAP_RULES) -> DataFrame:
    """Rows without a term list are dropped; the rest have terms removed, then mapped.

    Removal runs before mapping (a mapped term is never re-tested for removal).
    """
    kept = df.filter(F.col(col).isNotNull())
    return kept.withColumn(col, T.map_first_match(T.remove_matching(col, patterns), rules))


def drop_stoplisted(df: DataFrame, col: str = "cleaned_techs",
                    exact: list[str] = R.STOP_EXACT, partial: list[str] = R.STOP_PARTIAL) -> DataFrame:
    return df.withColumn(col, T.drop_stoplisted(col, exact, partial))


def alias_terms(df: DataFrame, col: str = "cleaned_techs",
                aliases: dict[str, list[str]] = R.ALIASES) -> DataFrame:
    return df.withColumn(col, T.canonicalize(col, R.alias_pairs(aliases)))


def rules_frame(spark, rules: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(rules)],
                                 "rank INT, pattern STRING, replacement STRING")


def inline_rows(rules: DataFrame) -> list | None:
    """The rows of a table that is small enough to become expressions, else None."""
    rows = rules.limit(RI.INLINE + 1).collect()
    return rows if len(rows) <= RI.INLINE else None


def read_rules(rules: DataFrame) -> list[tuple[str, str]] | None:
    """(pattern, replacement) pairs in rank order, or None for a large table."""
    rows = inline_rows(rules.select("rank", "pattern", "replacement"))
    return rows if rows is None else [(r["pattern"], r["replacement"]) for r in sorted(rows, key=lambda r: r["rank"])]


def map_terms_by_table(terms: DataFrame, rules: DataFrame, term_col: str = "term", per_case: int = 200) -> DataFrame:
    """Add ``mapped``: replacement of the lowest-rank rule matching ``term``, else ``term``.

    ``terms`` is one row per term occurrence. A small table becomes literal expressions of ``per_case`` rules
    each, tried in rank order per row; a large one goes through the rule index, whose answers (one row a
    distinct term) are joined so that a frequent term is split."""
    pairs, term = read_rules(rules), F.col(term_col)
    if pairs is not None:
        cases = [T.first_match_case(term, pairs[i:i + per_case], None) for i in range(0, len(pairs), per_case)]
        return terms.withColumn("mapped", F.coalesce(*cases, term))
    found = RI.first_rules(terms.select(term.alias("term")), rules).withColumnRenamed("term", "_term")
    out = split_join(terms.withColumn("_term", term), found, "_term", "left")
    return out.withColumn("mapped", F.when(F.col("rule").isNotNull(), F.col("rule.replacement")).otherwise(term)).drop("_term", "rule")


def rewrite_items(df: DataFrame, col: str, found: Callable[[DataFrame], DataFrame], null_stays: bool = False) -> DataFrame:
    """Rewrite the items of a list column by a table: ``found`` takes the distinct items (``term``) and gives
    (term, mapped) for those that change; a NULL ``mapped`` drops the item. A NULL item stays;
    ``null_stays``: and so does the whole list that holds one."""
    rows = measured(df.withColumn("_rid", F.monotonically_increasing_id()), "items")  # written, so the ids stand
    stays = F.col(col).isNull() | (T.has_null_item(col) if null_stays else F.lit(False))
    items = rows.where(~stays).select("_rid", F.posexplode(col).alias("_pos", "term"))
    table = found(items.select("term").distinct()).select("term", F.struct("mapped").alias("_new"))
    new = split_join(items, table, "term", "left").where("_new IS NULL OR _new.mapped IS NOT NULL").withColumn(
        "_item", F.coalesce("_new.mapped", "term"))
    lists = new.groupBy("_rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_item"))), lambda x: x["_item"]).alias("_list"))
    out = rows.join(lists, "_rid", "left")
    made = F.when(stays, F.col(col)).otherwise(F.coalesce("_list", F.array().cast("array<string>")))
    return out.withColumn(col, made).drop("_rid", "_list")


def remove_terms_by_table(df: DataFrame, words: DataFrame, col: str = "cleaned_techs") -> DataFrame:
    """:func:`remove_terms` with a table of patterns (rank, pattern)."""
    rows = inline_rows(words.select("rank", "pattern"))
    if rows is not None:
        return remove_terms(df, col, [r["pattern"] for r in sorted(rows)])
    rules = words.select("rank", "pattern", F.lit(None).cast("string").alias("replacement"))
    return rewrite_items(df, col, lambda t: RI.first_rules(t, rules).select("term", F.col("rule.replacement").alias("mapped")), null_stays=True)


def alias_terms_by_table(df: DataFrame, aliases: DataFrame, col: str = "cleaned_techs") -> DataFrame:
    """:func:`alias_terms` with a table (name, item) of canonical terms and their aliases. An alias of several names
    stands for the first one by name."""
    rows = inline_rows(aliases.select("name", "item"))
    first = aliases.groupBy(F.lower("item").alias("alias")).agg(F.min("name").alias("mapped"))
    if rows is not None:
        return df.withColumn(col, T.canonicalize(col, sorted((r["item"], r["name"]) for r in rows)))
    return rewrite_items(df, col, lambda t: split_join(t.withColumn("alias", F.lower("term")), first, "alias").select("term", "mapped"))


def drop_stoplisted_by_table(df: DataFrame, lists: DataFrame, col: str = "cleaned_techs") -> DataFrame:
    """:func:`drop_stoplisted` with a table (name, item) of the lists ``exact`` and ``partial``."""
    rows = inline_rows(lists.select("name", "item"))
    if rows is not None:
        return drop_stoplisted(df, col, *[[r["item"] for r in rows if r["name"] == kind] for kind in ("exact", "partial")])
    exact = lists.where("name = 'exact'").select(F.lower("item").alias("low")).distinct()
    partial = lists.where("name = 'partial'").select(F.row_number().over(Window.partitionBy("name").orderBy("item")).alias("rank"),
                                                     F.concat(F.lit("\\Q"), "item", F.lit("\\E")).alias("pattern"), F.lit(None).cast("string").alias("replacement"))
    def found(t: DataFrame) -> DataFrame:
        equal = t.withColumn("low", F.lower("term")).join(exact, "low", "left_semi").select("term")
        holding = RI.first_rules(t, partial).select("term")
        return equal.unionAll(holding).distinct().select("term", F.lit(None).cast("string").alias("mapped"))

    return rewrite_items(df, col, found)


def terms_from_choices(df: DataFrame, choices_col: str = "choices",
                       out_col: str = "cleaned_techs") -> DataFrame:
    """Backfill: the term list is the first choice's message content.

    Content that is already a list is taken as is; a string is parsed as a bracketed
    list; a missing choice gives NULL (the row is then dropped by :func:`clean_terms`).
    """
    content = F.get(F.col(choices_col), 0).getField("message").getField("content")
    dtype = dict(df.select(content.alias("c")).dtypes)["c"]
    terms = content if dtype.startswith("array") else T.parse_bracket_list(content)
    return df.withColumn(out_col, F.when(content.isNotNull(), terms))
