"""Select the passages of each description that matter.

passages -> tokens -> TF-IDF -> linear relevance score -> keep relevant -> ordered
concat -> newline squeeze -> drop near-empty. All steps are DataFrame operators.

Shuffles: passages, tokens and their counts are made inside the row that holds the text. Fitting the
idf model shuffles tokens, partially counted. Scoring joins (unit, token, count) rows with the model's
tables and sums to one number per passage: the model's frequent tokens, up to ``FREQUENT``, are broadcast and summed
in the task that has the text, so only the rows of rarer tokens move. Text moves only where it is the result: a
row meets the verdicts on its passages once, and the passages are cut again and put together inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import measured

# Token pattern of the passage vocabulary: runs of 2+ letters/digits/underscore.
TOKEN_RX = r"[\p{L}\p{N}_]{2,}"

# Tokens of an idf model that are broadcast at most; the others' rows are joined by a shuffle.
FREQUENT = 1 << 18


def split_count(text_col: str = "text", n: int = 5):
    """Lines per passage: newline count // n."""
    return F.floor(X.count_newlines(text_col) / F.lit(n)).cast("int")


def passage_blocks(text, k, remainder: str = "keep"):
    """All non-overlapping runs of ``k`` consecutive non-empty lines, left to right.

    The text is cut into blocks at blank lines, each block into lines, and each block into runs of
    ``k`` lines: linear in the text. The lines left at a block's end are a last, shorter passage
    (``remainder='keep'``) or are left out (``'drop'``, the reference's rule).

    ``text`` and ``k`` must be plain column references: a lambda re-evaluates any outer
    expression for every element.
    """
    text, k = X._col(text), X._col(k)
    blocks = F.filter(
        F.transform(F.split(text, "\n\n+", -1), lambda b: F.regexp_replace(b, "^\n+|\n+$", "")),
        lambda b: b != F.lit(""))
    block_lines = F.transform(blocks, lambda b: F.split(b, "\n", -1))

    def cut(lines):
        n = F.ceil(F.size(lines) / k) if remainder == "keep" else F.floor(F.size(lines) / k)
        idx = F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - F.lit(1))).otherwise(F.array().cast("array<int>"))
        return F.transform(idx, lambda i: F.array_join(F.slice(lines, i * k + F.lit(1), k), "\n"))

    return F.flatten(F.transform(block_lines, cut))


# Digest of the whole text a passage is of: with the key it names a text, also where rows share a key.
UNIT = "_unit"


def blocks_of_text(text_col: str, k_col: str, short_docs: str = "whole", remainder: str = "keep"):
    """The passages of a text as an array, in order; ``k_col`` has its :func:`split_count`."""
    blocks = F.when(F.col(k_col) > 0, passage_blocks(text_col, k_col, remainder))
    if short_docs == "whole":
        blocks = F.coalesce(blocks, F.when(F.col(text_col).isNotNull(), F.array(F.col(text_col))))
    return blocks


def passages(df: DataFrame, key: str = "doc_id", text_col: str = "text", n: int = 5,
             short_docs: str = "whole", remainder: str = "keep", keep: tuple[str, ...] = (), unit: bool = False) -> DataFrame:
    """(key, pos, passage): non-overlapping runs of k = newlines // n non-empty lines, left to right.

    Documents with k = 0 are one passage (``short_docs='whole'``); lines left at the end of a block are a
    last passage (``remainder='keep'``), so no line is lost. ``short_docs='drop'`` and
    ``remainder='drop'`` give the reference's rule, which leaves both out. A NULL text has no passage.
    ``unit`` adds :data:`UNIT`, so that rows of one key with different texts stay apart.
    """
    if short_docs not in ("whole", "drop") or remainder not in ("keep", "drop"):
        raise ValueError((short_docs, remainder))
    if unit:
        df, keep = df.withColumn(UNIT, F.xxhash64(text_col)), (*keep, UNIT)
    staged = df.select(key, *keep, text_col, split_count(text_col, n).alias("_k"))
    return staged.select(key, *keep, F.posexplode(blocks_of_text(text_col, "_k", short_docs, remainder)).alias("pos", "passage"))


def token_array(text_col: str = "passage"):
    """Lower-case tokens of a text, in order."""
    return F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_RX), 0)


def passage_tokens(p: DataFrame, keys=("doc_id", "pos"), text_col: str = "passage") -> DataFrame:
    """(keys..., token): one row per token occurrence (lower-cased)."""
    return p.select(*keys, F.explode(token_array(text_col)).alias("token"))


def lemmatize(tokens: DataFrame, lemmas: DataFrame, token_col: str = "token") -> DataFrame:
    """Replace each token by its lemma from a (token, lemma) table; unknown tokens stay. Whether the
    table is broadcast is left to its measured size; in a shuffled join a hot token is split."""
    table = measured(lemmas.select(F.col("token").alias("_lt"), F.col("lemma").alias("_lemma")), "lemmas")
    out = tokens.join(table, tokens[token_col] == F.col("_lt"), "left")
    return out.withColumn(token_col, F.coalesce(F.col("_lemma"), F.col(token_col))).drop("_lt", "_lemma")


def counted_passages(p: DataFrame, keys=("doc_id", "pos"), text_col: str = "passage") -> DataFrame:
    """(keys..., _terms): each unit's distinct tokens with their counts, counted inside its row: the tokens are sorted and
    each run's end less the end before it is the count. No shuffle."""
    def runs(s):
        ends = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == F.size(s)) | (F.get(s, i) != F.get(s, i - 1)))
        return F.transform(F.array(ends), lambda e: F.zip_with(
            e, F.concat(F.array(F.lit(0)), F.slice(e, 1, F.greatest(F.size(e) - 1, F.lit(0)))),
            lambda end, before: F.struct(F.get(s, end - 1).alias("token"), (end - before).cast("long").alias("tf"))))[0]

    # sort_array compares natively, array_sort by an expression
    counted = F.transform(F.array(F.sort_array(token_array(text_col))), lambda s: F.when(F.size(s) > 0, runs(s)))[0]
    return p.select(*keys, counted.alias("_terms"))


def term_rows(counted: DataFrame, keys=("doc_id", "pos"), keep: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., token, tf, first) of :func:`counted_passages`: one row per distinct token of each unit. ``first`` marks one
    token of each row, so that a later sum knows how many equal rows it has met."""
    return counted.select(*keys, *keep, F.posexplode("_terms").alias("_i", "_t")).select(
        *keys, *keep, "_t.token", "_t.tf", (F.col("_i") == 0).alias("first"))


def term_frequencies(p: DataFrame, keys=("doc_id", "pos"), text_col: str = "passage") -> DataFrame:
    """(keys..., token, tf, first) of the units in ``p``. No shuffle."""
    return term_rows(counted_passages(p, keys, text_col), keys)


def copies(tf: DataFrame):
    """How many equal rows a group of (unit, token, tf) rows comes from, as an aggregate."""
    return F.count_if("first") if "first" in tf.columns else F.lit(1)


# The empty string is never a token; its document frequency counts the units.
_UNITS = ""


def document_frequencies(p: DataFrame, text_col: str = "passage") -> DataFrame:
    """(token, df): the units that hold each token and, under the empty token, all units. One aggregation pass;
    only tokens are shuffled, partially counted. ``p``: passages, or :func:`counted_passages`."""
    toks = F.coalesce(F.col("_terms.token"), F.array().cast("array<string>")) if "_terms" in p.columns else F.array_distinct(token_array(text_col))
    return p.select(F.explode(F.concat(toks, F.array(F.lit(_UNITS)))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def idf_model(dfreq: DataFrame) -> DataFrame:
    """(token, df, idf) of stored document frequencies, smooth idf = ln((1+n)/(1+df)) + 1."""
    units = dfreq.where(F.col("token") == F.lit(_UNITS)).select("df").first()
    n = int(units[0]) if units else 0
    return (dfreq.where(F.col("token") != F.lit(_UNITS))
            .withColumn("idf", F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)))


def fit_idf(p: DataFrame, text_col: str = "passage") -> DataFrame:
    """Fit the idf model (token, df, idf). The frequencies are written below the shared checkpoint folder, so later
    joins see the model's measured size."""
    return idf_model(measured(document_frequencies(p, text_col), "idf"))


def tfidf(tf: DataFrame, idf: DataFrame, keys=("doc_id", "pos"), most: int | None = None) -> DataFrame:
    """L2-normalised tf*idf per unit; tokens missing from ``idf`` are ignored. A unit that comes in several
    equal rows has its rows as often, each with the unit's own norm.

    ``tf``: rows of :func:`term_rows`, or :func:`counted_passages`, whose rows meet their unit's norm, and its rare tokens'
    idf, before they are spread out: no row of a token is shuffled but the rare ones'."""
    listed = ("idf", "df") if "df" in idf.columns else ("idf",)
    packed = "_terms" in tf.columns
    parts = frequent_tokens(idf.select("token", *listed), most)
    sums = unit_sums(term_rows(tf, keys) if packed else tf, parts, None, keys, listed)
    rare = ["_rare"] if parts[1] is not None else []
    norms = sums.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.sqrt(F.col("_ss") / F.col("_n")).alias("_norm"), *rare)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    met = tf.join(norms, on)
    rows = term_rows(met, keys, ("_norm", *rare)) if packed else met
    found = [F.try_element_at("_rare", F.col("token")).alias("_found")] if rare else []
    w = rows.select("token", *keys, "tf", "_norm", *found).join(parts[0], "token", "left")
    for c in listed if rare else ():
        w = w.withColumn(c, F.coalesce(c, F.col("_found")[c]))
    return (w.where(F.col("idf").isNotNull()).withColumn("w", F.col("tf") * F.col("idf"))
            .select("token", *keys, "tf", *listed, "w", (F.col("w") / F.col("_norm")).alias("weight")))


def frequent_tokens(idf: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The model in two: the tokens of the lowest idf, at most ``most`` (:data:`FREQUENT`) and marked for broadcast, and
    the others, None where there are none. Which token is in which part changes no result.

    Cut by a histogram of the idf, which has a few hundred rows for a corpus of any size."""
    most = FREQUENT if most is None else most
    step = F.floor(F.col("idf") * 64)
    n, last = 0, None
    found = {r["step"]: r["n"] for r in idf.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(found.values()) <= most:
        return F.broadcast(idf), None
    for s in sorted(x for x in found if x is not None):
        n += found[s]
        if n > most:
            break
        last = s
    near = F.lit(False) if last is None else F.coalesce(step <= last, F.lit(False))
    return F.broadcast(idf.where(near)), idf.where(~near)


def unit_sums(tf: DataFrame, parts: tuple[DataFrame, DataFrame | None], coef: DataFrame | None, keys,
              listed: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., _ss, _dot, _n): sums of squared weights and of weight times coefficient of each unit, and how many equal
    rows it comes from. ``parts``: the model by :func:`frequent_tokens`; with ``listed``, columns of it, ``_rare`` maps the
    unit's rare tokens to them.

    One row a unit and one for each of its rare tokens are shuffled."""
    frequent, rare = parts
    w = tf.join(frequent.select("token", "idf"), "token", "left")
    w = w.join(coef.select("token", "coef"), "token", "left") if coef is not None else w.withColumn("coef", F.lit(0.0))
    weight, c = F.col("tf") * F.col("idf"), F.coalesce(F.col("coef"), F.lit(0.0))
    sums = [F.sum(weight * weight).alias("_ss"), F.sum(weight * c).alias("_dot")]
    first = "first" in tf.columns
    met = F.sum("_n") if first else F.lit(1)
    if rare is None:
        return w.groupBy(*keys).agg(*sums, copies(tf).alias("_n"))
    part = w.groupBy(*keys, F.when(F.col("idf").isNull(), F.col("token")).alias("_token")).agg(
        *sums, F.sum(F.col("tf") * F.col("tf")).alias("_tt"), F.sum(F.col("tf") * c).alias("_tc"), copies(tf).alias("_n"))
    # the sums of the frequent tokens meet no row; a number of their own spreads them over the tasks
    spread = F.when(F.col("_token").isNull(), F.xxhash64(*keys))
    table = rare.select(F.struct(F.col("token").alias("t"), F.lit(None).cast("long").alias("u")).alias("_key"), F.col("idf").alias("_idf"),
                        *[F.struct(*listed).alias("_listed")] * bool(listed))
    met_rows = part.join(table, F.struct(F.col("_token").alias("t"), spread.alias("u")) == F.col("_key"), "left")
    more = [F.map_from_entries(F.collect_set(F.when(F.col("_idf").isNotNull(), F.struct("_token", "_listed")))).alias("_rare")] if listed else []
    return met_rows.groupBy(*keys).agg(
        F.sum(F.coalesce("_ss", F.col("_idf") * F.col("_idf") * F.col("_tt"))).alias("_ss"),
        F.sum(F.coalesce("_dot", F.col("_idf") * F.col("_tc"))).alias("_dot"), met.alias("_n"), *more)


def linear_scores(tf: DataFrame, idf: DataFrame, coef: DataFrame, intercept: float,
                  keys=("doc_id", "pos"), most: int | None = None) -> DataFrame:
    """(keys..., score) = intercept + <tfidf_l2(unit), coef>.

    ``coef`` (token, coef) is the fitted model's weight table; it is joined with a
    broadcast hint only when the caller passes a table of bounded size.
    """
    agg = unit_sums(tf, frequent_tokens(idf.select("token", "idf"), most), coef, keys)
    # of a unit in n equal rows both sums are n times its own; without a known token nothing is added
    part = F.coalesce(F.col("_dot") / F.col("_n") / F.sqrt(F.col("_ss") / F.col("_n")), F.lit(0.0))
    return agg.select(*keys, (F.lit(float(intercept)) + part).alias("score"))


def verdicts(scores: DataFrame, intercept: float, threshold: float, key: str = "doc_id") -> DataFrame:
    """(key, UNIT, _odd): for each text the places of the passages that are judged otherwise than one without a token."""
    usual = relevant(F.lit(float(intercept)), threshold)
    return scores.groupBy(key, UNIT).agg(F.collect_list(F.when(relevant(F.col("score"), threshold) != usual, F.col("pos"))).alias("_odd"))


def assemble(df: DataFrame, judged: DataFrame, intercept: float, threshold: float, key: str = "doc_id", text_col: str = "text",
             n: int = 5, short_docs: str = "whole", remainder: str = "keep") -> DataFrame:
    """The rows of ``df`` that have a relevant passage, with ``split_jd``: the kept passages in order joined by one space,
    newline runs squeezed. Each row meets the verdicts on its text in the one shuffle of the texts."""
    usual = relevant(F.lit(float(intercept)), threshold)
    j = judged.select(F.col(key).alias("_key"), F.col(UNIT).alias("_unit"), "_odd")
    met = df.where(F.col(text_col).isNotNull()).join(j, F.col(key).eqNullSafe(F.col("_key")) & (F.xxhash64(text_col) == F.col("_unit")), "left")
    blocks = blocks_of_text(text_col, "_k", short_docs, remainder)
    kept = F.filter(blocks, lambda _, i: F.coalesce(F.array_contains("_odd", i), F.lit(False)) != usual)
    out = met.withColumn("_k", split_count(text_col, n)).withColumn("split_jd", X.squeeze_newlines(F.array_join(kept, " ")))
    return out.where(F.length("split_jd") > 1).select(*df.columns, "split_jd")


def scored_passages(p: DataFrame, scores: DataFrame, intercept: float, key: str = "doc_id") -> DataFrame:
    """(key, pos, passage, score), the text where ``p`` has it: every passage with its score (the intercept when it has no token)."""
    unit = [UNIT] if UNIT in p.columns else []
    s = scores.select(F.col(key).alias("_key"), F.col("pos").alias("_pos"), *[F.col(u).alias("_su") for u in unit], "score")
    on = p[key].eqNullSafe(F.col("_key")) & (p["pos"] == F.col("_pos"))
    out = p.join(s, on & (p[UNIT] == F.col("_su")) if unit else on, "left")
    return out.select(key, *unit, "pos", *[c for c in ("passage",) if c in p.columns], F.coalesce("score", F.lit(float(intercept))).alias("score"))


def relevant(score, threshold: float):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score)) >= F.lit(float(threshold))


def select_relevant(df: DataFrame, idf: DataFrame | None, coef: DataFrame, intercept: float,
                    threshold: float = 0.5, key: str = "doc_id", text_col: str = "text",
                    n: int = 5, short_docs: str = "whole", remainder: str = "keep", every_row: bool = True,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """The whole stage: (key, split_jd) for documents with relevant passages, row by row: a repeated row has its
    result as often (``every_row=False``: once), rows of one key with different texts have their own.

    With ``idf=None`` the idf is fitted on the passages being scored. ``keep``: columns that go along.
    """
    p = passages(df.select(key, text_col), key, text_col, n, short_docs, remainder, unit=True)
    keys = (key, UNIT, "pos")
    counted = counted_passages(p, keys)
    if idf is None:
        counted = measured(counted, "counted")  # read twice: for the model and for the scores
        idf = fit_idf(counted)
    judged = verdicts(linear_scores(term_rows(counted, keys), idf, coef, intercept, keys), intercept, threshold, key)
    texts = df.select(key, *[c for c in keep if c != key], text_col)
    if not every_row:
        texts = texts.dropDuplicates([key, text_col])
    return assemble(texts, judged, intercept, threshold, key, text_col, n, short_docs, remainder).select(
        key, *[c for c in keep if c != key], "split_jd")
