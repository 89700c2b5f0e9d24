"""Term extraction and merging of extractor responses.

* Dictionary extraction: aliases are tokenised like the texts and found by an Aho-Corasick automaton over word
  numbers; counts per (text, canonical term).
* Pluggable extractor: a Python callable for one text or for a batch of texts, run in Arrow batches over
  (id, text) only, retried up to ``max_attempts``; rows that keep failing carry their error texts in
  ``result`` instead of failing the job.
* Merge: response fields, NULLs too, win over posting fields of the same name; ``metadata`` dropped; a posting
  without a response stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules as R
from ..functions.terms import parse_bracket_list
from ..session import measured
from .joins import split_join

# A word with the marks that technology names carry inside or at the end: node.js, c++, c#.
WORD_RX = r"[\p{L}\p{N}_]++(?:[.][\p{L}\p{N}_]++)*+(?:[+]++|#)?"


BLOCK_WORDS = 1_000_000


def words(text_col: str = "text") -> F.Column:
    return F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD_RX), 0)


def dictionary_frame(spark, aliases: dict[str, list[str]]) -> DataFrame:
    return spark.createDataFrame(R.alias_pairs(aliases), "alias STRING, term STRING")


def alias_blocks(dictionary: DataFrame, block_words: int) -> Iterator[list]:
    """(words, terms) of the distinct aliases, in lists of about ``block_words`` words."""
    d = dictionary.select(words("alias").alias("words"), "term").where(F.size("words") > 0)
    d = measured(d.groupBy("words").agg(F.array_sort(F.collect_set("term")).alias("terms")), "dictionary")
    total = d.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-total // block_words))
    for i in range(n):
        yield (d if n == 1 else d.where(F.pmod(F.xxhash64("words"), F.lit(n)) == i)).collect()


def mention_counter(aliases: list) -> Callable[[pa.Array], Iterator[Counter]]:
    """For an array of word lists, each list's mentions by term: an Aho-Corasick automaton over word numbers reads each list
    once, and its failure links give the aliases that end at each word."""
    import ahocorasick

    number = {w: i + 1 for i, w in enumerate(sorted({w for ws, _ in aliases for w in ws}))}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for ws, terms in aliases:
        automaton.add_word(tuple(number[w] for w in ws), terms)
    automaton.make_automaton()
    vocabulary = pa.array(number, pa.string())

    def counts(lists: pa.Array) -> Iterator[Counter]:
        # the word's number, or 0 for a word of no alias
        ids = pc.fill_null(pc.add(pc.index_in(lists.flatten().cast(pa.string()), value_set=vocabulary), 1), 0).to_pylist()
        at = 0
        for size in pc.fill_null(pc.list_value_length(lists), 0).to_pylist():
            yield Counter(t for _, terms in automaton.iter(tuple(ids[at:at + size])) for t in terms) if size else Counter()
            at += size

    return counts


def count_mentions(staged: DataFrame, key: str, aliases: list) -> DataFrame:
    """(key, term, n) for each row of word lists (``_words``), by :func:`mention_counter`."""
    schema = T.StructType([staged.schema[key], T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])
    held = staged.sparkSession.sparkContext.broadcast([(list(r["words"]), list(r["terms"])) for r in aliases])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held.value:
            return
        counts = mention_counter(held.value)
        for batch in batches:
            place, found, n = [], [], []
            for i, count in enumerate(counts(batch.column("_words"))):
                place += [i] * len(count)
                found += count.keys()
                n += count.values()
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(place, pa.int64())), pa.array(found, pa.string()), pa.array(n, pa.int64())],
                                             names=[key, "term", "n"])

    return staged.mapInArrow(run, schema)


def extract_by_dictionary(df: DataFrame, dictionary: DataFrame, key: str = "doc_id", text_col: str = "text",
                          block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, term, n_mentions). ``dictionary`` is (alias, term); an alias of any number of words matches
    where its words follow one another, overlaps included; an alias of several terms counts for each. The
    dictionary goes to the tasks in blocks of about ``block_words`` words, each a broadcast and a pass over
    the texts; only counts are shuffled, summed per row first."""
    staged = df.select(key, words(text_col).alias("_words"))
    hits = None
    for block in alias_blocks(dictionary, block_words):
        some = count_mentions(staged, key, block)
        hits = some if hits is None else hits.unionAll(some)
    return hits.groupBy(key, "term").agg(F.sum("n").alias("n_mentions"))


def with_dictionary_terms(df: DataFrame, dictionary: DataFrame, text_col: str = "text", out_col: str = "terms",
                          block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add the sorted distinct terms of :func:`extract_by_dictionary` to each row, inside the row: no key, no shuffle. Only the
    words go to Python; the dictionary goes there in blocks."""
    def finder(block: list):
        held = df.sparkSession.sparkContext.broadcast([(list(r["words"]), list(r["terms"])) for r in block])

        def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            counts = mention_counter(held.value) if held.value else None
            for lists in batches:
                yield pa.array([list(c) for c in counts(lists)] if counts else [[]] * len(lists), pa.list_(pa.string()))

        find.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        # marked so that the planner neither repeats the call nor moves it into a later lambda
        return F.arrow_udf(find, T.ArrayType(T.StringType())).asNondeterministic()

    staged = df.withColumn("_words", words(text_col))
    found = [finder(block)("_words") for block in alias_blocks(dictionary, block_words)]
    return staged.withColumn(out_col, F.array_sort(F.array_distinct(F.concat(*found)))).drop("_words")


def each(fn: Callable[[str], list[str]]) -> Callable[[list[str]], list]:
    """A batch extractor from one for single texts; a text that raises gives the exception itself."""
    def batch(texts: list[str]) -> list:
        out = []
        for t in texts:
            try:
                out.append([str(x) for x in fn(t)])
            except Exception as e:  # kept as data, the row is not lost
                out.append(e)
        return out
    return batch


def extract_with(df: DataFrame, fn: Callable[[list[str]], list], key: str = "doc_id", text_col: str = "split_jd",
                 max_attempts: int = R.MAX_ATTEMPTS) -> DataFrame:
    """(key, cleaned_techs, result): the extractor's answer or, after ``max_attempts`` failures, the error
    texts. ``fn`` takes the texts of a batch that have no answer yet and gives for each a list of
    terms or an exception (:func:`each` makes one from a function of one text)."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("cleaned_techs", T.ArrayType(T.StringType())),
                           T.StructField("result", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            terms, errors, left = [None] * len(texts), [[] for _ in texts], list(range(len(texts)))
            for _ in range(max_attempts):
                for i, got in zip(left, fn([texts[i] for i in left])):
                    if isinstance(got, Exception):
                        errors[i].append(f"{type(got).__name__}: {got}")
                    else:
                        terms[i] = got
                left = [i for i in left if terms[i] is None]
                if not left:
                    break
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(terms, strings),
                 pa.array([None if t is not None else e for t, e in zip(terms, errors)], strings)],
                names=[key, "cleaned_techs", "result"])

    return df.select(key, text_col).mapInArrow(run, schema)


def merge_response(base: DataFrame, response: DataFrame, key: str) -> DataFrame:
    """Posting fields plus response fields; on a name clash the response wins. A posting without a
    response keeps its own fields; of several responses to one key one is taken (the first in the
    order of their fields), so no posting is repeated."""
    rest = [c for c in response.columns if c != key]
    fields = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_"))
    one = response.groupBy(key).agg(F.min(fields).alias("_r"))
    merged = split_join(base, one, key, "left")
    there = F.col("_r").isNotNull()  # a NULL field of a response wins too
    kept = [F.when(there, F.col("_r")[c]).otherwise(F.col(c)).alias(c) if c in rest else F.col(c) for c in base.columns]
    added = [F.col("_r")[c].alias(c) for c in rest if c not in base.columns]
    merged = merged.select(*kept, *added)
    return merged.drop("metadata") if "metadata" in merged.columns else merged


def terms_from_answer(df: DataFrame, answer_col: str = "content", out_col: str = "cleaned_techs") -> DataFrame:
    return df.withColumn(out_col, parse_bracket_list(answer_col))
