"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the test tables in full. Array results are rendered as
``|``-joined strings so they compare equal with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..functions import text as X
from ..operators import clean as C
from ..operators import extract as EX
from ..operators import demand_state as DS
from ..operators import idf_state as IS
from ..operators import lemma_rules as LR
from ..operators import normalize as NZ
from ..operators import pages as PG
from ..operators import planning as PL
from ..operators import quality as QA
from ..operators import row_audit as RA
from ..operators import select_text as ST
from ..operators import views as V
from ..schemas import CORRUPT_COL, EVENT
from ..sources import drift as DR
from ..sources import jsonl as J
from ..sources import rulefiles as RF
from ..sources import sinks as SK
from ..sources.tables import table
from ..streaming import ingest as IN
from . import analogues as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def joined(col: str = "cleaned_techs") -> F.Column:
    return F.array_join(F.col(col), "|")


# --- term cleaning -----------------------------------------------------------

def clean_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_terms(A.postings(spark, sf_dir), patterns=A.REMOVE_PATTERNS, rules=A.MAP_RULES)


@register
def term_remove(spark, sf_dir):
    df = C.remove_terms(A.postings(spark, sf_dir), patterns=A.REMOVE_PATTERNS)
    return df.select("job_key", "line_no", joined().alias("techs"))


@register
def term_map(spark, sf_dir):
    df = C.map_terms(A.postings(spark, sf_dir), rules=A.MAP_RULES)
    return df.select("job_key", "line_no", joined().alias("techs"))


@register
def clean_terms(spark, sf_dir):
    df = clean_layer(spark, sf_dir)
    return df.select("job_key", "line_no", joined().alias("techs"),
                     F.size("cleaned_techs").alias("n_techs"), "year", "month", "day")


@register
def term_stoplist(spark, sf_dir):
    df = C.drop_stoplisted(A.postings(spark, sf_dir), exact=A.STOP_EXACT, partial=A.STOP_PARTIAL)
    return df.select("job_key", "line_no", joined().alias("techs"))


@register
def term_alias(spark, sf_dir):
    df = C.alias_terms(A.postings(spark, sf_dir), aliases=A.ALIASES)
    return df.select("job_key", "line_no", joined().alias("techs"))


def resource(spark, name: str) -> str:
    """A packaged rule file on shared storage."""
    from importlib import resources
    text = resources.files("skilltrends.resources").joinpath(name).read_text()
    return RF.stage_text(spark, text, S.scratch_path(spark, "rules"))


@register
def rules_words(spark, sf_dir):
    """Removal words read from a word file, applied to every term list."""
    words = RF.load_word_patterns(spark, resource(spark, "part_removal_words.txt"))
    df = C.remove_terms_by_table(A.postings(spark, sf_dir), words)
    return df.select("job_key", "line_no", joined().alias("techs"))


@register
def rules_json(spark, sf_dir):
    """Aliases and stop-lists read from JSON files, applied to every term list."""
    def lists(name):
        return RF.load_json_lists(spark, resource(spark, name))

    df = C.drop_stoplisted_by_table(A.postings(spark, sf_dir), lists("part_stop_lists.json"))
    df = C.alias_terms_by_table(df, lists("part_aliases.json"))
    return df.select("job_key", "line_no", joined().alias("techs"))


@register
def rules_load(spark, sf_dir):
    """Mapping rules read from a rule file on shared storage, applied as a rule table."""
    rules = RF.load_mapping_rules(spark, resource(spark, "part_mappings.txt"))
    terms = A.postings(spark, sf_dir).select(
        "job_key", "line_no", F.posexplode("cleaned_techs").alias("pos", "term"))
    out = C.map_terms_by_table(terms, rules)
    return out.select("job_key", "line_no", "pos", "term", "mapped")


@register
def rules_large(spark, sf_dir):
    """A rule table as large as the vocabulary, through the rule index: every part name is a rule that maps it to
    its type, ranked by part, and rules without a literal (a term's length) come last. Terms are the parts'
    names as lineitems spell them: upper case on returned lines."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.lower("p_type").alias("type"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    by_name = part.select(F.col("p_partkey").cast("int").alias("rank"), F.concat(F.lit(r"^(the )?"), "p_name", F.lit(r"\b")).alias("pattern"),
                          F.col("type").alias("replacement"))
    by_length = spark.range(8, 12).select((F.lit(2_000_000_000) + F.col("id")).cast("int").alias("rank"),
                                          F.concat(F.lit("^.{"), F.col("id").cast("string"), F.lit("}$")).alias("pattern"),
                                          F.concat(F.lit("length "), F.col("id").cast("string")).alias("replacement"))
    name = F.when(F.col("l_returnflag") == "R", F.upper("p_name")).when(F.col("l_returnflag") == "A", F.reverse("p_name")).otherwise(F.col("p_name"))
    terms = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "l_linenumber", name.alias("term"))
    return C.map_terms_by_table(terms, by_name.unionAll(by_length)).select("l_orderkey", "l_linenumber", "term", "mapped")


# --- the view and its consumers ---------------------------------------------

def skills_view_df(spark, sf_dir):
    return V.jobs_view(clean_layer(spark, sf_dir), A.keywords(spark, sf_dir))


@register
def skills_view(spark, sf_dir):
    return skills_view_df(spark, sf_dir)


@register
def skills_view_sql(spark, sf_dir):
    """The same view defined and queried through Spark SQL."""
    V.register_sql_views(spark, clean_layer(spark, sf_dir), A.keywords(spark, sf_dir))
    return spark.sql("SELECT job_key, tech, job_date, kw FROM jobs_view")


@register
def demand_by_keyword(spark, sf_dir):
    return V.demand_by_keyword(skills_view_df(spark, sf_dir))


@register
def demand_trend(spark, sf_dir):
    return V.demand_trend(clean_layer(spark, sf_dir), A.keywords(spark, sf_dir))


def demand_words(spark, sf_dir):
    """The demand state of the postings, that come in three deliveries of whole days, the second of them first without
    every posting's first line and then as it is. The view is written once, nested, and each delivery reads its days from it."""
    state, p, kw = S.scratch_path(spark, "demand-state"), clean_layer(spark, sf_dir), A.keywords(spark, sf_dir)
    part_of = ((F.col("year") * 12 + F.col("month")) % 3).alias("part")
    view = V.jobs_view(p.select("*", part_of), kw, nested=True, keep=("line_no", "part"))
    view = S.measured(view.sortWithinPartitions(F.xxhash64("kws", "techs")), "demand-view")  # equal lists side by side: shuffles compress them
    for part, rows in ((0, view), (1, view.where("line_no > 1")), (2, view), (1, view)):
        DS.deliver(spark, state, rows.where(F.col("part") == part), stored=True)
    return DS.partials(spark, state)


@register
def demand_incremental(spark, sf_dir):
    """``demand_by_keyword`` from days' bitmaps, after a delivery that came again."""
    return DS.demand(demand_words(spark, sf_dir))


@register
def trend_incremental(spark, sf_dir):
    """``demand_trend`` from days' bitmaps, after a delivery that came again."""
    return DS.trend(demand_words(spark, sf_dir))


@register
def top_terms(spark, sf_dir):
    return V.top_terms(skills_view_df(spark, sf_dir), k=3)


@register
def fanout_audit(spark, sf_dir):
    return V.fanout_of(clean_layer(spark, sf_dir), A.keywords_by_day(spark, sf_dir))


@register
def skills_view_weighted(spark, sf_dir):
    """The view with the number of keyword rows behind each of its rows."""
    return V.jobs_view_weighted(clean_layer(spark, sf_dir), A.keywords_by_day(spark, sf_dir))


# --- pages and descriptions ---------------------------------------------------


@register
def html_to_text(spark, sf_dir):
    return PG.page_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


@register
def embedded_blob(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    blob = PG.embedded_blob("html", A.BLOB_PATTERN)
    title = X.html_to_text(F.regexp_extract("html", A.TITLE_PATTERN, 1))
    return p.select("page_id", F.try_variant_get(blob, "$", "int").alias("track_id"),
                    title.alias("title"), blob.isNotNull().alias("has_blob"))


@register
def url_extract(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select("page_id", PG.endpoint_from_url("url", A.URL_PATTERNS).alias("endpoint"),
                    X.last_path_segment("url").alias("last_segment"))


@register
def newline_squeeze(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", X.squeeze_newlines("text").alias("text"))


def doc_passages(spark, sf_dir):
    return ST.passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def block_segment(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = d.select("doc_id", "text", X.count_newlines("text").alias("n_newlines"),
                 ST.split_count("text").alias("k"))
    return ST.passages(d, "doc_id", "text", keep=("n_newlines", "k"))


@register
def passage_terms(spark, sf_dir):
    p = doc_passages(spark, sf_dir)
    p = p.select("doc_id", "pos", ST.token_array().alias("t"))
    return p.select("doc_id", "pos", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@register
def passage_lemmas(spark, sf_dir):
    """Occurrences of each lemma per document, over all passages."""
    toks = ST.lemmatize(ST.passage_tokens(doc_passages(spark, sf_dir)), A.lemma_frame(spark))
    return toks.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@register
def lemma_rules(spark, sf_dir):
    """A lemma for every word of the descriptions: three quarters of them come from a table, the others by the suffix rules
    learned from it. The table's lemma of a word in s is the word without it, where that is a word of the texts too."""
    words = S.measured(ST.passage_tokens(doc_passages(spark, sf_dir)).groupBy("token").agg(F.count(F.lit(1)).alias("n")), "words")
    short = words.select(F.concat("token", F.lit("s")).alias("token"), F.col("token").alias("base"))
    pairs = words.join(short, "token", "left").select("token", F.coalesce("base", "token").alias("lemma"), "n")
    return LR.complete_lemmas(words, pairs.where(F.left(F.md5(F.encode("token", "UTF-8")), F.lit(1)) >= "4"))


PASSAGE_KEYS = ("doc_id", ST.UNIT, "pos")


def passage_tf_idf(spark, sf_dir):
    """The passages with their counted tokens, written once for the model and for the scores, and the idf model."""
    p = ST.passages(table(spark, sf_dir, "documents").select("doc_id", "text"), unit=True)
    counted = S.measured(ST.counted_passages(p, PASSAGE_KEYS), "counted")
    return counted, ST.fit_idf(counted)


@register
def tfidf(spark, sf_dir):
    counted, idf = passage_tf_idf(spark, sf_dir)
    w = ST.tfidf(counted, idf, PASSAGE_KEYS)
    return w.select("doc_id", "pos", "token", "tf", "df", F.round("weight", 6).alias("weight"))


@register
def idf_incremental(spark, sf_dir):
    """The idf model kept as a state: documents come in three deliveries, one of them first without its last ten
    characters a text and then again as it is."""
    state = S.scratch_path(spark, "idf-state")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = d.withColumn("text", F.expr("left(text, greatest(length(text) - 10, 0))"))
    for part, texts in ((0, d), (1, cut), (2, d), (1, d)):
        IS.deliver(spark, state, f"part-{part}", ST.passages(texts.where(F.col("doc_id") % 3 == part)))
    return IS.current_idf(spark, state).select("token", "df", F.round("idf", 6).alias("idf"))


def passage_scores(spark, sf_dir):
    counted, idf = passage_tf_idf(spark, sf_dir)
    s = ST.linear_scores(ST.term_rows(counted, PASSAGE_KEYS), idf, F.broadcast(A.coef_frame(spark)), A.RELEVANCE_INTERCEPT, PASSAGE_KEYS)
    scored = ST.scored_passages(counted, s, A.RELEVANCE_INTERCEPT)
    return scored.withColumn("relevant", ST.relevant(F.col("score"), A.RELEVANCE_THRESHOLD).cast("int"))


@register
def relevance_score(spark, sf_dir):
    s = passage_scores(spark, sf_dir)
    return s.select("doc_id", "pos", F.round("score", 6).alias("score"), "relevant")


@register
def relevant_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ST.select_relevant(d, None, F.broadcast(A.coef_frame(spark)), A.RELEVANCE_INTERCEPT,
                              A.RELEVANCE_THRESHOLD)


@register
def relevance_threshold(spark, sf_dir):
    """The decision threshold that keeps 95 % of the documents labelled good, by their best passage's score."""
    best = passage_scores(spark, sf_dir).groupBy("doc_id").agg(F.round(F.max("score"), 6).alias("score"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    t = QA.threshold_for_recall(best.join(lab, "doc_id"), "score", "quality", 0.95)
    return t.select("threshold", "n_positive", "n_kept", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@register
def relevance_train(spark, sf_dir):
    """MLlib classifier trained on labelled documents; saved to and reloaded from shared storage, then
    applied to every document."""
    from ..operators import relevance as RV
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    train = d.join(lab, "doc_id")
    path = RV.save(RV.train(train), S.scratch_path(spark, "relevance-model"))
    pred = RV.predict(RV.load(path), d.join(lab, "doc_id", "left"), ["doc_id", "label"])
    return pred.select("doc_id", F.col("label").cast("int").alias("quality"), "prediction",
                       F.round("p_relevant", 4).alias("p_relevant"))


# --- postings, keywords, search paging -----------------------------------------


@register
def text_normalize(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey",
                    F.coalesce(X.lower_strip("c_name"), F.lit("")).alias("company"),
                    F.coalesce(X.lower_strip("c_mktsegment"), F.lit("")).alias("job_title"))


def chosen_salary(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    pay_type = F.expr(A.PAY_TYPE_SQL)
    info = F.when(F.col("o_orderstatus") == "F", NZ.salary_struct(
        F.col("o_totalprice") / F.lit(1000.0), F.col("o_totalprice") / F.lit(800.0), pay_type))
    est = F.when(F.col("o_orderstatus") == "O", NZ.salary_struct(
        F.col("o_totalprice") / F.lit(1200.0), F.col("o_totalprice") / F.lit(900.0), pay_type))
    return o.select("o_orderkey", NZ.choose_salary(info, est).alias("s")).select("o_orderkey", "s.*")


@register
def salary_choose(spark, sf_dir):
    return chosen_salary(spark, sf_dir)


@register
def salary_annualize(spark, sf_dir):
    return NZ.annualize(chosen_salary(spark, sf_dir))


@register
def nested_sum(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    tiers = F.array(
        F.struct(F.lit("quantity").alias("tier"), F.col("l_quantity").cast("int").alias("jobCount")),
        F.struct(F.lit("line").alias("tier"), F.col("l_linenumber").alias("jobCount")))
    return li.select("l_orderkey", "l_linenumber", NZ.nested_sum(tiers, "jobCount").alias("num_results"))


@register
def keyword_union(spark, sf_dir):
    """Items found by several searches (part found under several return flags) all
    carry the sorted union of those searches' keywords."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("job_key"), F.col("l_returnflag").alias("keyword"))
    out = NZ.fill_keywords(li, "job_key", "keyword")
    return out.select("l_orderkey", "l_linenumber", "job_key", F.array_join("keyword", "|").alias("keywords"))


@register
def first_seen(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return NZ.first_seen(e, "user_id", ["ts", "event_id"])


@register
def search_grid(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    hits = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("num_results"))
    kw = n.join(hits, n.n_nationkey == hits.c_nationkey, "left").select(
        F.lower("n_name").alias("keyword"), F.coalesce("num_results", F.lit(0)).alias("num_results"))
    return NZ.search_grid(kw, A.SEARCH_LOCATIONS, A.SEARCH_BASE)


@register
def result_positions(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    page_no = F.coalesce(F.regexp_extract("url", A.PAGE_PARAM_PATTERN, 1).try_cast("int"), F.lit(1))
    p = p.select("page_id", ((page_no - F.lit(1)) * F.lit(10)).alias("page_offset"),
                 F.regexp_extract_all("html", F.lit(A.RESULT_LINK_PATTERN), 1).alias("results"))
    return NZ.result_positions(p, "results", "page_offset", keep=("page_id",)).select(
        "page_id", "page", "position", "job_key")


# --- request planning ----------------------------------------------------------


@register
def build_messages(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    msgs = PL.build_messages(A.PROMPT_SYSTEM, A.PROMPT_EXAMPLES, A.PROMPT_QUESTION, "text")
    d = d.select("doc_id", msgs.alias("messages"))
    return d.select("doc_id", F.size("messages").alias("n_messages"),
                    PL.payload_json(A.PROMPT_MODEL, "messages", A.PROMPT_TEMPERATURE).alias("payload"),
                    PL.messages_cost("messages").alias("cost"))


def conversation_costs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "role", "text")
    per = c.select("conv_id", PL.message_tokens("role", "text").alias("t"))
    agg = per.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_messages"), F.sum("t").alias("prompt_tokens"))
    return agg.withColumn("cost", PL.request_cost("prompt_tokens"))


@register
def token_cost(spark, sf_dir):
    return conversation_costs(spark, sf_dir)


@register
def budget_batches(spark, sf_dir):
    costs = conversation_costs(spark, sf_dir).select("conv_id", "cost")
    r = PL.running_totals(costs, "conv_id", "cost", sum_col="cum_cost", index_col="request_id")
    return r.select("conv_id", "request_id", "cost", F.col("cum_cost").cast("long").alias("cum_cost"),
                    PL.budget_minutes("cum_cost", "request_id").alias("minute"))


# --- extraction and responses -------------------------------------------------


@register
def parse_list(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    a = EX.terms_from_answer(p.select("p_partkey", F.expr(A.ANSWER_SQL).alias("content")))
    return a.select("p_partkey", F.size("cleaned_techs").alias("n_terms"),
                    F.array_join("cleaned_techs", "|").alias("terms"))


@register
def backfill_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    choices = F.array(F.struct(F.struct(F.expr(A.ANSWER_SQL).alias("content")).alias("message")))
    b = C.terms_from_choices(p.select("p_partkey", choices.alias("choices")))
    cl = C.clean_terms(b, patterns=A.REMOVE_PATTERNS, rules=A.MAP_RULES)
    return cl.select("p_partkey", F.array_join("cleaned_techs", "|").alias("techs"))


@register
def term_extract(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return EX.extract_by_dictionary(d, EX.dictionary_frame(spark, A.TERM_DICTIONARY))


def word_list_extractor(text: str) -> list[str]:
    """Deterministic stand-in for a remote extractor: dictionary words found in the text;
    an empty text is an error (exercises retry and the error column)."""
    import re
    if not text:
        raise ValueError("empty text")
    words = set(re.findall(r"\w+", text.lower()))
    return sorted(w for w in ("the", "and", "de", "der", "la", "que") if w in words)


@register
def extract_hook(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("split_jd"))
    out = EX.extract_with(d, EX.each(word_list_extractor), "doc_id", "split_jd")
    return out.select("doc_id", F.array_join("cleaned_techs", "|").alias("techs"),
                      F.coalesce(F.size("result"), F.lit(0)).alias("n_errors"))


@register
def merge_response(spark, sf_dir):
    base = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    resp = table(spark, sf_dir, "labels").select(
        "doc_id", "quality", "toxic", F.lit("labeler").alias("source"),
        F.lit(None).cast("string").alias("metadata"))
    return EX.merge_response(base, resp, "doc_id")


# --- run bookkeeping ------------------------------------------------------------


@register
def reconcile(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id")
    return QA.reconcile(d, d.join(lab, "doc_id", "left_semi"), "source")


@register
def reconcile_rows(spark, sf_dir):
    """Orders against a copy with lost, doubled, changed and added rows: each of them is named."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    price = F.when(key % 83 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    out = o.where(key % 97 != 0).withColumn("o_totalprice", price)
    out = out.unionAll(out.where(key % 89 == 0)).unionAll(o.where(key % 101 == 0).withColumn("o_orderkey", -key - 1))
    return RA.reconcile_rows(o, out, ["o_orderkey"])


@register
def run_status(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id")
    failed = F.col("event_type").isin("error", "purchase")
    return QA.run_status(e, "day", failed, rate_limited=F.col("event_type") == "purchase", api_error=F.col("user_id") % 2 == 0)


@register
def quarantine(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    bad = (F.col("event_type") == "error") | F.try_parse_json("props").isNull()
    reason = F.concat(F.lit("failed "), F.col("event_type"), F.lit(": "), F.col("props"))
    _, q = QA.split_quarantine(e, bad, reason)
    return q.select("event_id", "user_id", F.array_join("result", "|").alias("result"))


@register
def recent_only(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return QA.recent_only(e, "ts", A.RECENT_DAYS)


# --- sources, sinks, streaming ---------------------------------------------------


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def land_events(spark, sf_dir, broken_errors: bool = False) -> str:
    """Land the events table as daily JSON-lines files on shared storage.

    With ``broken_errors`` the lines of failed events lose their closing brace
    (a truncated delivery), to exercise corrupt-record handling."""
    root = S.scratch_path(spark, "landing")
    e = table(spark, sf_dir, "events")
    line = F.to_json(F.struct(*EVENT_COLS), {"timestampNTZFormat": J.TS_NTZ_FORMAT})
    if broken_errors:
        line = F.when(F.col("event_type") == "error", F.expr("substring(_l, 1, length(_l) - 1)")).otherwise(F.col("_l"))
        e = e.withColumn("_l", F.to_json(F.struct(*EVENT_COLS), {"timestampNTZFormat": J.TS_NTZ_FORMAT}))
    (e.select(J.daily_file_name("events", "ts").alias("file"), line.alias("value"))
      .write.mode("overwrite").partitionBy("file").text(root))
    return root


@register
def scan_jsonl(spark, sf_dir):
    root = land_events(spark, sf_dir, broken_errors=True)
    df = J.with_file_date(J.scan_jsonl(spark, root, EVENT))
    return df.select("event_id", "user_id", "event_type", "value", "props",
                     F.col(CORRUPT_COL).isNotNull().alias("is_corrupt"), "day", "month", "year")


@register
def date_from_filename(spark, sf_dir):
    df = J.with_file_date(J.scan_jsonl(spark, land_events(spark, sf_dir), EVENT))
    return df.select("event_id", "day", "month", "year")


@register
def date_from_parts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    parts = e.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
                     F.dayofmonth("ts").alias("day"))
    return parts.select("event_id", V.date_from_parts("year", "month", "day").alias("job_date"))


@register
def write_roundtrip(spark, sf_dir):
    path = SK.write_jsonl(table(spark, sf_dir, "events"), S.scratch_path(spark, "roundtrip"))
    return J.scan_jsonl(spark, path, EVENT, corrupt=False, with_path=False)


def with_day_parts(df, ts_col="ts"):
    return (df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))
              .withColumn("day", F.dayofmonth(ts_col)))


@register
def daily_overwrite(spark, sf_dir):
    """All days written, then the newest day re-delivered with corrected values: only
    that day's partition is replaced."""
    e = with_day_parts(table(spark, sf_dir, "events").select("event_id", "ts", "value"))
    path = SK.write_daily(e, S.scratch_path(spark, "daily"))
    last_day = e.select(F.max(F.to_date("ts"))).scalar()
    redelivery = e.where(F.to_date("ts") == last_day).withColumn("value", F.col("value") + F.lit(1.0))
    SK.write_daily(redelivery, path)
    return spark.read.parquet(path).select("event_id", "ts", "value", "year", "month", "day")


@register
def union_drift(spark, sf_dir):
    """Early days were landed without ``props``; later days with ``props`` and a parsed
    ``k``. Both parts are read with their own schema and unioned by name."""
    e = table(spark, sf_dir, "events")
    early = F.dayofmonth("ts") <= 15
    old_root, new_root = S.scratch_path(spark, "drift-old"), S.scratch_path(spark, "drift-new")
    J.write_daily_jsonl(e.where(early).select("event_id", "ts", "event_type"), old_root, "events", "ts")
    J.write_daily_jsonl(e.where(~early).select("event_id", "ts", "event_type", "props",
                                               F.get_json_object("props", "$.k").cast("long").alias("k")),
                        new_root, "events", "ts")
    old_schema = "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING"
    new_schema = old_schema + ", props STRING, k BIGINT"
    from pyspark.sql.types import _parse_datatype_string
    parts = [J.scan_jsonl(spark, old_root, _parse_datatype_string(old_schema), corrupt=False, with_path=False),
             J.scan_jsonl(spark, new_root, _parse_datatype_string(new_schema), corrupt=False, with_path=False)]
    return J.union_by_name(parts)


@register
def incremental_ingest(spark, sf_dir):
    """Landing folder -> clean layer by day and delivery, for each version of a file once. Each day arrives as
    two files (``am`` and ``pm``), the second ones only after the first run; then the ``am`` files are delivered
    again with every ``k`` one higher, in a folder with a higher number; then the ``pm`` files under
    their own paths with every ``k`` two higher. A last run finds nothing new."""
    from ..sources import versioned as VS
    landing, sink = (S.scratch_path(spark, x) for x in ("landing", "clean"))
    e = table(spark, sf_dir, "events")

    def deliver(drop: str, half: str, more: int = 0) -> None:
        part = e.where((F.col("event_id") % 2 == 0) if half == "am" else (F.col("event_id") % 2 != 0))
        k = F.get_json_object("props", "$.k").cast("long") + F.lit(more)
        line = F.to_json(F.struct("event_id", "ts", "event_type", k.alias("k")), {"timestampNTZFormat": J.TS_NTZ_FORMAT})
        (part.select(J.daily_file_name(half, "ts").alias("file"), line.alias("value"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").text(f"{landing}/{drop}"))

    def transform(batch):
        return J.with_file_date(batch).select("event_id", "event_type", "k", "year", "month", "day", "delivery")

    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string("event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, k BIGINT")
    for drop, half, more in (("1", "am", 0), ("2", "pm", 0), ("3", "am", 1), ("2", "pm", 2)):
        deliver(drop, half, more)
        IN.ingest(spark, landing, schema, transform, sink)
    IN.ingest(spark, landing, schema, transform, sink)
    return VS.read_live(spark, sink).select("event_id", "event_type", "k", "year", "month", "day")


def job_pages(spark, sf_dir):
    """Job pages built from orders: the data blob in a script; some pages have none, some a broken one."""
    o = table(spark, sf_dir, "orders")
    pay = F.struct((F.col("o_totalprice") / 2000).alias("salaryMin"), (F.col("o_totalprice") / 1000).alias("salaryMax"),
                   F.when(F.col("o_orderstatus") == "F", "YEARLY").otherwise("HOURLY").alias("salaryType"))
    header = F.struct(F.concat(F.lit(" Clerk "), F.col("o_custkey").cast("string")).alias("companyName"),
                      F.concat(F.col("o_orderpriority"), F.lit(" Caf\u00e9 ")).alias("jobTitle"))
    text = F.concat(F.lit("<p>Status &mdash; "), F.col("o_orderstatus"), F.lit('</p><br><br>it&#8217;s &eacute; \\ {"};'))
    blob = F.to_json(F.struct(
        F.struct(F.struct(text.alias("sanitizedJobDescription"), header.alias("jobInfoHeaderModel")).alias("jobInfoModel")).alias("jobInfoWrapperModel"),
        F.when(F.col("o_orderkey") % 3 != 0, pay).alias("salaryInfoModel")))
    blob = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit('{"broken": '), F.col("o_custkey").cast("string"), F.lit(", }"))).otherwise(blob)
    script = F.when(F.col("o_orderkey") % 7 == 0, F.lit("<p>gone</p>")).otherwise(F.concat(F.lit("<script>window._initialData="), blob, F.lit(";</script>")))
    return o.select((F.col("o_orderkey") % 1000).cast("string").alias("job_key"), F.lower("o_orderpriority").alias("keyword"),
                    F.lit(1).alias("from_age"), F.lit("remote").alias("location"), F.lit(1).alias("page"),
                    F.col("o_orderkey").cast("int").alias("position"), F.lit("https://jobs.example.com").alias("url"), script.alias("html"))


@register
def page_postings(spark, sf_dir):
    """Landed job pages -> postings with the union of their keywords."""
    from . import daily as D
    good, _ = D.collect_stage(job_pages(spark, sf_dir))
    return good.select("job_key", "position", F.array_join("keyword", "|").alias("keywords"), "job_title", "company",
                       "job_description", "salary_min", "salary_max", "salary_type", "salary_estimated_flag")


@register
def page_quarantine(spark, sf_dir):
    """Landed job pages without a data blob, or with a broken one."""
    from . import daily as D
    _, bad = D.collect_stage(job_pages(spark, sf_dir))
    return bad.select("job_key", "position", F.array_join("result", "|").alias("result"))


@register
def daily_flow(spark, sf_dir):
    """The whole daily flow over landed posting files: documents as descriptions, one file per source."""
    from ..schemas import POSTING
    from . import daily as D
    landing, sink = S.scratch_path(spark, "landing"), S.scratch_path(spark, "clean")
    d = table(spark, sf_dir, "documents")
    fields = {"job_key": F.col("doc_id").cast("string"), "keyword": F.array("lang"), "job_description": F.col("text")}
    row = F.struct(*[fields.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in POSTING.fields])
    day = F.concat(F.lit("jobs_"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("_03_2024.json"))
    (d.select(day.alias("file"), F.to_json(row).alias("value")).hint("rebalance", F.col("file"))
      .write.partitionBy("file").text(landing))
    clean = D.daily_run(spark, landing, sink, F.broadcast(A.coef_frame(spark)), A.RELEVANCE_INTERCEPT, A.RELEVANCE_THRESHOLD,
                        dictionary=EX.dictionary_frame(spark, A.TERM_DICTIONARY), patterns=[r"\barticle\b"], rules=[(r"\bthat\b", "which")])
    return clean.select(F.col("job_key").cast("long").alias("doc_id"), joined().alias("techs"), "year", "month", "day")


@register
def json_projection(spark, sf_dir):
    """Narrow read of the landed JSON (two keys), then one nested key of ``props``."""
    from pyspark.sql.types import _parse_datatype_string
    narrow = _parse_datatype_string("event_id BIGINT, props STRING")
    df = J.scan_jsonl(spark, land_events(spark, sf_dir), narrow, corrupt=False, with_path=False)
    return df.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@register
def schema_drift(spark, sf_dir):
    return J.json_field_counts(table(spark, sf_dir, "events").select("props"), "props")


@register
def schema_infer(spark, sf_dir):
    """Merged schema of every landed JSON line (a distributed aggregate, one row)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(land_events(spark, sf_dir))
    return J.merged_schema(lines, "value")


@register
def schema_diff(spark, sf_dir):
    """Landed lines against a declared schema that lacks ``value``, has ``k`` and another type of ``event_type``."""
    from pyspark.sql.types import _parse_datatype_string
    lines = spark.read.option("recursiveFileLookup", "true").text(land_events(spark, sf_dir))
    declared = _parse_datatype_string("event_id BIGINT, ts TIMESTAMP_NTZ, user_id INT, event_type BIGINT, props STRING, k INT")
    return J.schema_diff(lines, "value", declared)


def nested_events(spark, sf_dir):
    """(day, value): events as nested JSON whose shape drifts over a month: ``user.kind`` comes on the 10th, ``reading`` is away
    from the 15th to the 17th, ``user.id`` is a text from the 20th on, ``tags[].k`` is null on the 5th."""
    e = table(spark, sf_dir, "events")
    d, k = F.dayofmonth("ts"), F.get_json_object("props", "$.k").cast("long")
    tags = F.array(F.struct(F.when(d != 5, k).alias("k"), F.lit("a b").alias("odd name")), F.struct(F.when(d != 5, k + 1).alias("k"), F.lit(None).cast("string").alias("odd name")))
    kind = F.when(d >= 10, F.col("event_type")).alias("kind")
    reading = F.when(~d.between(15, 17), F.struct(F.col("event_type").alias("unit"))).alias("reading")

    def line(user_id):
        return F.to_json(F.struct("event_id", F.struct(user_id.alias("id"), kind).alias("user"), tags.alias("tags"), reading))

    return e.select(F.to_date("ts").alias("day"), F.when(d >= 20, line(F.col("user_id").cast("string"))).otherwise(line(F.col("user_id"))).alias("value"))


@register
def schema_paths(spark, sf_dir):
    """Kinds and number of values of every path of the nested lines, a day."""
    states = DR.path_states(nested_events(spark, sf_dir), "value", "day")
    return states.select("day", "path", DR.kind_names("kinds").alias("kinds"), "n")


@register
def nested_drift(spark, sf_dir):
    """New, missing and changed paths of the nested lines, each with its first day."""
    return DR.drift_report(DR.path_states(nested_events(spark, sf_dir), "value", "day"), "day")
