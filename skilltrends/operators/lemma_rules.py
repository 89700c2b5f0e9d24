"""Lemmas of words that no table holds, by suffix-edit rules learned from a table that does.

A pair (token, lemma) is an edit: so many characters off the end, then some characters on. It votes, with its
count, for that edit at every suffix that holds the characters taken off and up to ``CONTEXT`` kept ones before
them. Each suffix keeps its strongest edit; the rules are a trie over reversed words whose nodes are table rows. A
new word takes the rule of its longest suffix in the trie.

An edit that takes off more than ``MAX_STRIP`` characters is no rule (its own token is still found in the table). All work
is on distinct words; tokens of the text meet the result in one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import measured
from .select_text import lemmatize

CONTEXT = 4
MAX_STRIP = 8


def common_prefix(a: str, b: str) -> Column:
    """Length of the common prefix of two columns, linear in them."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, F.lit(False))
    return F.when(differs == 0, F.least(F.length(a), F.length(b))).otherwise(differs - 1).cast("int")


def best_lemmas(pairs: DataFrame) -> DataFrame:
    """(token, lemma): of a token's lemmas the one counted most often, then the smallest. NULL or empty tokens and NULL
    lemmas are no pairs."""
    per = pairs.where("token IS NOT NULL AND token <> '' AND lemma IS NOT NULL").groupBy("token", "lemma").agg(F.sum("n").alias("n"))
    return per.groupBy("token").agg(F.min(F.struct((-F.col("n")).alias("n"), "lemma"))["lemma"].alias("lemma"))


def learn_rules(pairs: DataFrame, context: int = CONTEXT, max_strip: int = MAX_STRIP) -> DataFrame:
    """(suffix, strip, append, n) from (token, lemma, n): the strongest edit of each suffix; ties go to the shorter
    strip, then the smaller ending. The empty suffix says what words do that end like no learned one."""
    p = pairs.where("token IS NOT NULL AND token <> '' AND lemma IS NOT NULL").select("token", "lemma", "n", common_prefix("token", "lemma").alias("same"))
    p = p.select("token", "n", (F.length("token") - F.col("same")).alias("strip"), F.expr("substr(lemma, same + 1)").alias("append")).where(F.col("strip") <= max_strip)
    lengths = F.sequence(F.col("strip"), F.least(F.length("token"), F.col("strip") + F.lit(context)))
    votes = p.select(F.explode(lengths).alias("len"), "token", "strip", "append", "n").groupBy(
        F.expr("right(token, len)").alias("suffix"), "strip", "append").agg(F.sum("n").alias("n"))
    best = votes.groupBy("suffix").agg(F.min(F.struct((-F.col("n")).alias("n"), "strip", "append")).alias("e"))
    return best.select("suffix", "e.strip", "e.append", (-F.col("e.n")).alias("n"))


def apply_rules(words: DataFrame, rules: DataFrame, context: int = CONTEXT, max_strip: int = MAX_STRIP) -> DataFrame:
    """(token, lemma) for distinct ``words`` (token): the edit of the longest suffix that has one; without any, or where
    nothing would be left, the word itself."""
    lengths = F.sequence(F.lit(0), F.least(F.length("token"), F.lit(context + max_strip)))
    cut = words.select("token", F.explode(lengths).alias("len")).select("token", "len", F.expr("right(token, len)").alias("suffix"))
    hit = cut.join(rules.select("suffix", "strip", "append"), "suffix", "left").groupBy("token").agg(
        F.max_by(F.struct("strip", "append"), F.when(F.col("strip").isNotNull(), F.col("len"))).alias("e"))
    edited = F.concat(F.expr("left(token, length(token) - e.strip)"), F.col("e.append"))
    return hit.select("token", F.coalesce(F.nullif(edited, F.lit("")), F.col("token")).alias("lemma"))


def complete_lemmas(words: DataFrame, pairs: DataFrame, context: int = CONTEXT, max_strip: int = MAX_STRIP) -> DataFrame:
    """(token, lemma, known) for each distinct non-empty token of ``words``: from the pairs where they hold it, else by the rules."""
    table = measured(best_lemmas(pairs), "lemmas")
    rules = measured(learn_rules(pairs, context, max_strip), "lemma-rules")
    met = words.where("token IS NOT NULL AND token <> ''").select("token").distinct().join(table, "token", "left")
    met = measured(met, "words")
    new = apply_rules(met.where("lemma IS NULL").select("token"), rules, context, max_strip)
    known = met.where("lemma IS NOT NULL").select("token", "lemma", F.lit(True).alias("known"))
    return known.unionAll(new.select("token", "lemma", F.lit(False).alias("known")))


def lemmatize_all(tokens: DataFrame, pairs: DataFrame, context: int = CONTEXT, max_strip: int = MAX_STRIP) -> DataFrame:
    """``tokens`` with every token replaced by its lemma, unseen ones by the rules; all other columns stay."""
    return lemmatize(tokens, complete_lemmas(tokens, pairs, context, max_strip))
