"""DuckDB SQL for each registered query (tables are pre-registered views).

Rule lists (data) are the ones the Spark side uses; every pattern over text, the token classes and the
markup rules are stated here on their own.
"""

from __future__ import annotations

from . import analogues as A

ORACLE: dict[str, str] = {}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_pattern(patterns: list[str]) -> str:
    return "(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")"


def sql_remove(arr: str, patterns: list[str]) -> str:
    return f"list_filter({arr}, lambda x: NOT regexp_matches(x, {q(any_pattern(patterns))}))"


def sql_first_match(x: str, rules: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {q('(?i)' + p)}) THEN {q(r)}" for p, r in rules)
    return f"CASE {whens} ELSE {x} END"


def sql_map(arr: str, rules: list[tuple[str, str]]) -> str:
    return f"list_transform({arr}, lambda x: {sql_first_match('x', rules)})"


def sql_stoplist(arr: str, exact: list[str], partial: list[str]) -> str:
    ex = ", ".join(q(e.lower()) for e in exact)
    conds = [f"NOT list_contains([{ex}], lower(x))"]
    conds += [f"strpos(lower(x), {q(p.lower())}) = 0" for p in partial]
    return f"list_filter({arr}, lambda x: {' AND '.join(conds)})"


def sql_alias(arr: str, aliases: dict[str, list[str]]) -> str:
    seen: dict[str, str] = {}
    for canon, names in aliases.items():
        for n in names:
            seen.setdefault(n.lower(), canon)
    whens = " ".join(f"WHEN {q(a)} THEN {q(c)}" for a, c in seen.items())
    return f"list_transform({arr}, lambda x: coalesce(CASE lower(x) {whens} END, x))"


POSTINGS = """
postings AS (
  SELECT l.l_orderkey AS job_key, l.l_linenumber AS line_no,
         [p.p_name, lower(p.p_type)] AS cleaned_techs,
         CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month,
         CAST(day(l.l_shipdate) AS INTEGER) AS day
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

KEYWORDS = """
keywords_raw AS (
  SELECT o_orderkey AS job_key, [o_orderpriority, o_orderstatus] AS keyword FROM orders
)"""

CLEAN = f"""
clean AS (
  SELECT job_key, line_no, year, month, day,
         {sql_map(sql_remove('cleaned_techs', A.REMOVE_PATTERNS), A.MAP_RULES)} AS cleaned_techs
  FROM postings WHERE cleaned_techs IS NOT NULL
)"""

VIEW = """
t1 AS (
  SELECT job_key, tech, make_date(year, month, day) AS job_date
  FROM clean CROSS JOIN UNNEST(cleaned_techs) AS t(tech)
),
t2 AS (
  SELECT job_key, kw FROM keywords_raw CROSS JOIN UNNEST(keyword) AS t(kw)
  WHERE kw IS NOT NULL
),
jobs_view AS (
  SELECT t1.job_key, t1.tech, t1.job_date, t2.kw FROM t1 JOIN t2 ON t1.job_key = t2.job_key
)"""

WITH_VIEW = f"WITH {POSTINGS},{KEYWORDS},{CLEAN},{VIEW}"

ORACLE["term_remove"] = f"""WITH {POSTINGS}
SELECT job_key, line_no, array_to_string({sql_remove('cleaned_techs', A.REMOVE_PATTERNS)}, '|') AS techs
FROM postings"""

ORACLE["term_map"] = f"""WITH {POSTINGS}
SELECT job_key, line_no, array_to_string({sql_map('cleaned_techs', A.MAP_RULES)}, '|') AS techs
FROM postings"""

ORACLE["clean_terms"] = f"""WITH {POSTINGS},{CLEAN}
SELECT job_key, line_no, array_to_string(cleaned_techs, '|') AS techs,
       CAST(len(cleaned_techs) AS INTEGER) AS n_techs, year, month, day
FROM clean"""

ORACLE["term_stoplist"] = f"""WITH {POSTINGS}
SELECT job_key, line_no,
       array_to_string({sql_stoplist('cleaned_techs', A.STOP_EXACT, A.STOP_PARTIAL)}, '|') AS techs
FROM postings"""

ORACLE["term_alias"] = f"""WITH {POSTINGS}
SELECT job_key, line_no, array_to_string({sql_alias('cleaned_techs', A.ALIASES)}, '|') AS techs
FROM postings"""

ORACLE["rules_load"] = f"""WITH {POSTINGS},
terms AS (
  SELECT job_key, line_no, CAST(pos - 1 AS INTEGER) AS pos, cleaned_techs[pos] AS term
  FROM postings CROSS JOIN generate_series(1, len(cleaned_techs)) AS g(pos)
)
SELECT job_key, line_no, pos, term, {sql_first_match('term', A.MAP_RULES)} AS mapped FROM terms"""

ORACLE["rules_large"] = """
WITH names AS (SELECT lower(p_name) AS name, arg_min(lower(p_type), p_partkey) AS type FROM part GROUP BY ALL),
t AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN upper(p_name) WHEN 'A' THEN reverse(p_name) ELSE p_name END AS term
      FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, term,
       coalesce(type, CASE WHEN length(term) BETWEEN 8 AND 11 THEN 'length ' || length(term) ELSE term END) AS mapped
FROM t LEFT JOIN names ON lower(term) = name"""

ORACLE["skills_view"] = f"""{WITH_VIEW}
SELECT job_key, tech, job_date, kw FROM jobs_view"""

ORACLE["skills_view_sql"] = ORACLE["skills_view"]

ORACLE["demand_by_keyword"] = f"""{WITH_VIEW}
SELECT kw, tech, count(DISTINCT job_key) AS n_postings FROM jobs_view GROUP BY kw, tech"""

ORACLE["demand_trend"] = f"""{WITH_VIEW},
daily AS (
  SELECT tech, job_date, count(DISTINCT job_key) AS n_postings FROM jobs_view GROUP BY tech, job_date
)
SELECT tech, job_date, n_postings,
       lag(n_postings) OVER (PARTITION BY tech ORDER BY job_date) AS prev_n_postings,
       lag(job_date) OVER (PARTITION BY tech ORDER BY job_date) AS prev_date
FROM daily"""

# deliveries that replace days leave the counts of the whole
ORACLE["demand_incremental"] = ORACLE["demand_by_keyword"]
ORACLE["trend_incremental"] = ORACLE["demand_trend"]

ORACLE["top_terms"] = f"""{WITH_VIEW},
counts AS (SELECT kw, tech, count(DISTINCT job_key) AS n_postings FROM jobs_view GROUP BY kw, tech),
ranked AS (
  SELECT kw, tech, n_postings,
         CAST(row_number() OVER (PARTITION BY kw ORDER BY n_postings DESC, tech ASC) AS INTEGER) AS rank
  FROM counts
)
SELECT kw, tech, n_postings, rank FROM ranked WHERE rank <= 3"""

# keywords with a row for each day: the plain un-nest join, with its duplicates counted
BY_DAY = WITH_VIEW.replace(KEYWORDS, """
keywords_raw AS (SELECT l_orderkey AS job_key, [l_returnflag, l_linestatus] AS keyword FROM lineitem)""")
BY_LINE = BY_DAY.replace("l.l_linenumber AS line_no", "row_number() OVER () AS line_no").replace("SELECT job_key, tech, make_date", "SELECT job_key, line_no, tech, make_date").replace(
    "SELECT t1.job_key, t1.tech", "SELECT t1.line_no, t1.job_key, t1.tech").replace("UNNEST(cleaned_techs) AS t(tech)", "(SELECT unnest(cleaned_techs) AS tech, generate_subscripts(cleaned_techs, 1) AS pos)").replace(
    "SELECT job_key, line_no, tech,", "SELECT job_key, line_no, pos, tech,").replace("SELECT t1.line_no,", "SELECT t1.line_no, t1.pos,")

ORACLE["fanout_audit"] = f"""{BY_DAY}
SELECT job_key, tech, kw, job_date, count(*) AS n_rows
FROM jobs_view GROUP BY job_key, tech, kw, job_date HAVING count(*) > 1"""

ORACLE["skills_view_weighted"] = f"""{BY_LINE}
SELECT job_key, tech, job_date, kw, count(*) AS weight
FROM jobs_view GROUP BY job_key, line_no, pos, tech, job_date, kw"""

ORACLE["rules_words"] = ORACLE["term_remove"]

ORACLE["rules_json"] = f"""WITH {POSTINGS}
SELECT job_key, line_no, array_to_string({sql_alias(sql_stoplist('cleaned_techs', ['small ring', 'economy', 'new plate'], ['anvil', 'blue']),
    {"size class": ["small", "medium", "large"], "price class": ["economy", "standard", "promo"], "hot things": ["hot bolt", "hot rod"]})}, '|') AS techs
FROM postings"""


# --- pages and descriptions ---------------------------------------------------

# Patterns, as the contracts state them (RE2).
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f\x{85}\p{Z}]"
MARKUP = [r"(?is)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>",
          r"(?is)<template\b.*?</template\s*>", r"<![^>]*>", r"(?i)</?[a-z][^>]*>"]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "\u00b7"),
            ("&copy;", "\u00a9"), ("&mdash;", "\u2014"), ("&#8217;", "\u2019"), ("&eacute;", "\u00e9"), ("&amp;", "&")]
PASSAGE_TOKEN = r"[\p{L}\p{N}_]{2,}"
COUNTED_TOKEN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"


def sql_decode(x: str) -> str:
    for ent, ch in ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def sql_html_text(x: str) -> str:
    for rx in MARKUP:
        x = f"regexp_replace({x}, {q(rx)}, chr(57344), 'g')"
    return sql_strip(sql_decode(f"regexp_replace({x}, chr(57344) || '+', ' ', 'g')"))


def sql_squeeze(x: str) -> str:
    return f"regexp_replace({x}, {q(f'{WS}*\\n+{WS}*')}, ' ', 'g')"


def sql_first_group(x: str, patterns: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({x}, {q(p)}, 1), '')" for p in patterns) + ")"


NEWLINES = "(length(text) - length(replace(text, chr(10), '')))"

PASSAGES = f"""
docs AS (
  SELECT doc_id, text, CAST({NEWLINES} AS INTEGER) AS n_newlines,
         CAST({NEWLINES} // 5 AS INTEGER) AS k FROM documents
),
blocks AS (
  SELECT doc_id, n_newlines, k,
         CASE WHEN k = 0 THEN [text] ELSE
           regexp_extract_all(text, '[^\\n]+' || repeat('(?:\\n[^\\n]+)?', k - 1)) END AS arr
  FROM docs
),
passages AS (
  SELECT doc_id, n_newlines, k, CAST(g.i - 1 AS INTEGER) AS pos, arr[g.i] AS passage
  FROM blocks CROSS JOIN generate_series(1, len(arr)) AS g(i)
)"""

TFIDF = f"""{PASSAGES},
tokens AS (
  SELECT doc_id, pos, unnest(regexp_extract_all(lower(passage), {q(PASSAGE_TOKEN)})) AS token
  FROM passages
),
tf AS (SELECT doc_id, pos, token, count(*) AS tf FROM tokens GROUP BY doc_id, pos, token),
dfreq AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
npass AS (SELECT count(*) AS n FROM passages),
w AS (
  SELECT tf.doc_id, tf.pos, tf.token, tf.tf, d.df,
         tf.tf * (ln((1.0 + npass.n) / (1.0 + d.df)) + 1.0) AS w
  FROM tf JOIN dfreq d ON tf.token = d.token CROSS JOIN npass
)"""

_coef_rows = ", ".join(f"({q(t)}, {c!r})" for t, c in A.RELEVANCE_COEF)
SCORES = f"""{TFIDF},
coef AS (SELECT * FROM (VALUES {_coef_rows}) AS c(token, coef)),
agg AS (
  SELECT w.doc_id, w.pos, sum(w.w * w.w) AS ss, sum(w.w * coalesce(c.coef, 0.0)) AS dot
  FROM w LEFT JOIN coef c ON w.token = c.token GROUP BY w.doc_id, w.pos
),
scores AS (
  SELECT p.doc_id, p.pos, p.passage,
         coalesce({A.RELEVANCE_INTERCEPT!r} + a.dot / sqrt(a.ss), {A.RELEVANCE_INTERCEPT!r}) AS score
  FROM passages p LEFT JOIN agg a ON p.doc_id = a.doc_id AND p.pos = a.pos
)"""

RELEVANT = f"1.0 / (1.0 + exp(-score)) >= {A.RELEVANCE_THRESHOLD!r}"

ORACLE["html_to_text"] = f"SELECT page_id, {sql_html_text('html')} AS text FROM pages"

ORACLE["embedded_blob"] = f"""
SELECT page_id,
       try_cast(nullif(regexp_extract(html, {q(A.BLOB_PATTERN)}, 1), '') AS INTEGER) AS track_id,
       {sql_html_text(f"regexp_extract(html, {q(A.TITLE_PATTERN)}, 1)")} AS title,
       nullif(regexp_extract(html, {q(A.BLOB_PATTERN)}, 1), '') IS NOT NULL AS has_blob
FROM pages"""

ORACLE["url_extract"] = f"""
SELECT page_id, {sql_first_group('url', A.URL_PATTERNS)} AS endpoint,
       string_split(url, '/')[-1] AS last_segment
FROM pages"""

ORACLE["newline_squeeze"] = f"SELECT doc_id, {sql_squeeze('text')} AS text FROM documents"

ORACLE["block_segment"] = f"""WITH {PASSAGES}
SELECT doc_id, n_newlines, k, pos, passage FROM passages"""

ORACLE["passage_terms"] = f"""WITH {PASSAGES},
t AS (SELECT doc_id, pos, regexp_extract_all(lower(passage), {q(PASSAGE_TOKEN)}) AS toks FROM passages)
SELECT doc_id, pos, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens FROM t"""

ORACLE["tfidf"] = f"""WITH {TFIDF}
SELECT doc_id, pos, token, tf, df,
       round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, pos)), 6) AS weight
FROM w"""

ORACLE["relevance_score"] = f"""WITH {SCORES}
SELECT doc_id, pos, round(score, 6) AS score, CASE WHEN {RELEVANT} THEN 1 ELSE 0 END AS relevant
FROM scores"""

ORACLE["relevance_threshold"] = f"""WITH {SCORES},
best AS (SELECT doc_id, round(max(score), 6) AS score FROM scores GROUP BY doc_id),
rated AS (SELECT score, quality AS label, sum(quality) OVER () AS n_positive,
                 sum(quality) OVER (ORDER BY score DESC RANGE UNBOUNDED PRECEDING) AS so_far
          FROM best JOIN labels USING (doc_id) WHERE quality IN (0, 1)),
cut AS (SELECT max(score) AS threshold FROM rated WHERE 100 * so_far >= 95 * n_positive)
SELECT threshold, any_value(n_positive)::BIGINT AS n_positive, count(*) AS n_kept,
       round(sum(label) / any_value(n_positive), 6) AS recall, round(avg(label), 6) AS precision
FROM rated, cut WHERE score >= threshold GROUP BY threshold"""

ORACLE["relevant_text"] = f"""WITH {SCORES},
kept AS (SELECT doc_id, pos, passage FROM scores WHERE {RELEVANT}),
joined AS (
  SELECT doc_id, {sql_squeeze("string_agg(passage, ' ' ORDER BY pos)")} AS split_jd
  FROM kept GROUP BY doc_id
)
SELECT doc_id, split_jd FROM joined WHERE length(split_jd) > 1"""


# --- postings, keywords, search paging -----------------------------------------

from .. import rules as R  # noqa: E402

ORACLE["text_normalize"] = f"""
SELECT c_custkey, coalesce({sql_strip('lower(c_name)')}, '') AS company,
       coalesce({sql_strip('lower(c_mktsegment)')}, '') AS job_title
FROM customer"""

CHOSEN = f"""
chosen AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1000.0
         WHEN o_orderstatus = 'O' THEN o_totalprice / 1200.0 END AS salary_min,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 800.0
         WHEN o_orderstatus = 'O' THEN o_totalprice / 900.0 END AS salary_max,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN {A.PAY_TYPE_SQL} END AS salary_type,
    CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS salary_estimated_flag
  FROM orders
)"""

ORACLE["salary_choose"] = f"""WITH {CHOSEN}
SELECT o_orderkey, salary_min, salary_max, salary_type, salary_estimated_flag FROM chosen"""

_CONV = "salary_type IS NOT NULL AND salary_type <> 'YEARLY'"
ORACLE["salary_annualize"] = f"""WITH {CHOSEN}
SELECT o_orderkey,
       CASE WHEN {_CONV} THEN salary_min * {R.HOURS_PER_YEAR!r} ELSE salary_min END AS salary_min,
       CASE WHEN {_CONV} THEN salary_max * {R.HOURS_PER_YEAR!r} ELSE salary_max END AS salary_max,
       CASE WHEN {_CONV} THEN 'YEARLY' ELSE salary_type END AS salary_type,
       salary_estimated_flag
FROM chosen"""

ORACLE["nested_sum"] = """
SELECT l_orderkey, l_linenumber,
       CAST(trunc(l_quantity) AS BIGINT) + l_linenumber AS num_results
FROM lineitem"""

ORACLE["keyword_union"] = """
WITH u AS (
  SELECT l_partkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), '|') AS keywords
  FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_partkey
)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS job_key,
       coalesce(u.keywords, l.l_returnflag) AS keywords
FROM lineitem l LEFT JOIN u ON l.l_partkey = u.l_partkey"""

ORACLE["first_seen"] = """
SELECT DISTINCT ON (user_id) user_id, event_id, ts, event_type, value, props
FROM events ORDER BY user_id, ts, event_id"""

ORACLE["search_grid"] = f"""
WITH hits AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey),
kw AS (
  SELECT lower(n_name) AS keyword, coalesce(h.n, 0) AS n
  FROM nation LEFT JOIN hits h ON nation.n_nationkey = h.c_nationkey
),
grid AS (
  SELECT keyword, loc.location, o.page_offset
  FROM kw
  CROSS JOIN (SELECT unnest([{", ".join(q(x) for x in A.SEARCH_LOCATIONS)}]) AS location) loc
  CROSS JOIN LATERAL (
    SELECT unnest(range(0, n + 10, 10)) AS page_offset
  ) o
)
SELECT keyword, location, page_offset,
       {q(A.SEARCH_BASE)} || '?q=' || replace(keyword, ' ', '+') || '&l=' || location
       || '&filter=0&start=' || CAST(page_offset AS VARCHAR) || '&fromage=1' AS url
FROM grid"""

ORACLE["result_positions"] = f"""
WITH p AS (
  SELECT page_id,
         (coalesce(try_cast(regexp_extract(url, {q(A.PAGE_PARAM_PATTERN)}, 1) AS INTEGER), 1) - 1) * 10 AS page_offset,
         regexp_extract_all(html, {q(A.RESULT_LINK_PATTERN)}, 1) AS results
  FROM pages
),
x AS (
  SELECT page_id, page_offset, CAST(g.i - 1 AS INTEGER) AS position, results[g.i] AS job_key
  FROM p CROSS JOIN generate_series(1, len(results)) AS g(i)
)
SELECT page_id, page_offset // 10 + 1 AS page, position, job_key
FROM x WHERE job_key IS NOT NULL AND job_key <> ''"""


# --- request planning ----------------------------------------------------------

def sql_tokens(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, {q(COUNTED_TOKEN)})), 0)"


def _msg_cost(role: str, content: str) -> str:
    return f"({R.TOKENS_PER_MESSAGE} + {sql_tokens(q(role))} + {sql_tokens(content)})"


_fixed_msgs = [("system", q(A.PROMPT_SYSTEM))]
for _ask, _ans in A.PROMPT_EXAMPLES:
    _fixed_msgs += [("user", q(_ask)), ("assistant", q(_ans))]
_last = f"{q(A.PROMPT_QUESTION + ' ')} || text"
_all_msgs = _fixed_msgs + [("user", _last)]
_msgs_sql = ", ".join(f"{{'role': {q(r)}, 'content': {c}}}" for r, c in _all_msgs)
_cost_sql = " + ".join(_msg_cost(r, c) for r, c in _all_msgs)

ORACLE["build_messages"] = f"""
SELECT doc_id, {len(_all_msgs)} AS n_messages,
       CAST(to_json({{'model': {q(A.PROMPT_MODEL)}, 'messages': [{_msgs_sql}],
                'temperature': CAST({A.PROMPT_TEMPERATURE!r} AS DOUBLE)}}) AS VARCHAR) AS payload,
       CAST({_cost_sql} + {R.TOKENS_REPLY_PRIMER} + {R.COMPLETION_TOKENS} AS BIGINT) AS cost
FROM documents"""

COSTS = f"""
costs AS (
  SELECT conv_id, count(*) AS n_messages,
         CAST(sum({R.TOKENS_PER_MESSAGE} + {sql_tokens('role')} + {sql_tokens('text')}) AS BIGINT) AS prompt_tokens
  FROM conversations GROUP BY conv_id
)"""

ORACLE["token_cost"] = f"""WITH {COSTS}
SELECT conv_id, n_messages, prompt_tokens,
       prompt_tokens + {R.TOKENS_REPLY_PRIMER} + {R.COMPLETION_TOKENS} AS cost
FROM costs"""

ORACLE["budget_batches"] = f"""WITH {COSTS},
c AS (SELECT conv_id, prompt_tokens + {R.TOKENS_REPLY_PRIMER} + {R.COMPLETION_TOKENS} AS cost FROM costs),
r AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS request_id, cost,
         sum(cost) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_cost
  FROM c
)
SELECT conv_id, request_id, cost, CAST(cum_cost AS BIGINT) AS cum_cost,
       greatest(floor((cum_cost - 1) / {R.MAX_TOKENS_PER_MINUTE}),
                floor(request_id / {R.MAX_REQUESTS_PER_MINUTE}))::BIGINT AS minute
FROM r"""


# --- extraction and responses -------------------------------------------------

def sql_parse_list(x: str) -> str:
    inner = f"regexp_replace({x}, '^[\\[\\]]+|[\\[\\]]+$', '', 'g')"
    items = f"list_transform(string_split({inner}, ','), lambda s: {sql_strip('s')})"
    return f"CASE WHEN starts_with({x}, '[') THEN {items} ELSE CAST([] AS VARCHAR[]) END"


ORACLE["parse_list"] = f"""
WITH a AS (SELECT p_partkey, {sql_parse_list(f'({A.ANSWER_SQL})')} AS t FROM part)
SELECT p_partkey, CAST(len(t) AS INTEGER) AS n_terms, array_to_string(t, '|') AS terms FROM a"""

ORACLE["backfill_terms"] = f"""
WITH a AS (SELECT p_partkey, {sql_parse_list(f'({A.ANSWER_SQL})')} AS cleaned_techs FROM part)
SELECT p_partkey,
       array_to_string({sql_map(sql_remove('cleaned_techs', A.REMOVE_PATTERNS), A.MAP_RULES)}, '|') AS techs
FROM a"""

_dict_rows = ", ".join(f"({q(a.lower())}, {q(t)})" for a, t in R.alias_pairs(A.TERM_DICTIONARY))
_EXTRACT_WORD = r"[\p{L}\p{N}_]+(?:[.][\p{L}\p{N}_]+)*(?:[+]+|#)?"
ORACLE["term_extract"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), {q(_EXTRACT_WORD)}) AS w FROM documents),
d AS (SELECT *, len(string_split(alias, ' ')) AS n FROM (VALUES {_dict_rows}) AS d(alias, term)),
g AS (SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS alias
      FROM w CROSS JOIN (SELECT DISTINCT n FROM d) WHERE len(w) >= n)
SELECT g.doc_id, d.term, count(*) AS n_mentions FROM g JOIN d ON g.alias = d.alias AND g.n = d.n
GROUP BY g.doc_id, d.term"""

ORACLE["extract_hook"] = """
WITH t AS (SELECT doc_id, text, list_filter(['and', 'de', 'der', 'la', 'que', 'the'],
                  lambda x: regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])' || x || '($|[^\\p{L}\\p{N}_])')) AS found FROM documents)
SELECT doc_id, CASE WHEN text = '' THEN '' ELSE array_to_string(found, '|') END AS techs, CASE WHEN text = '' THEN 5 ELSE 0 END AS n_errors
FROM t"""

ORACLE["merge_response"] = """
SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic, CASE WHEN l.doc_id IS NULL THEN d.source ELSE 'labeler' END AS source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


# --- run bookkeeping ------------------------------------------------------------

ORACLE["reconcile"] = """
WITH a AS (SELECT source, count(*) AS n_in FROM documents GROUP BY source),
b AS (SELECT source, count(*) AS n_out FROM documents
      WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source)
SELECT coalesce(a.source, b.source) AS source, coalesce(n_in, 0) AS n_in, coalesce(n_out, 0) AS n_out,
       coalesce(n_in, 0) = coalesce(n_out, 0) AS consistent
FROM a FULL OUTER JOIN b ON a.source = b.source"""

ORACLE["run_status"] = """
SELECT CAST(ts AS DATE) AS day, count(*) AS started,
       count(*) FILTER (WHERE event_type NOT IN ('error', 'purchase')) AS succeeded,
       count(*) FILTER (WHERE event_type IN ('error', 'purchase')) AS failed,
       count(*) FILTER (WHERE event_type = 'purchase') AS rate_limited,
       count(*) FILTER (WHERE event_type = 'error' AND user_id % 2 = 0) AS api_errors,
       count(*) FILTER (WHERE event_type = 'error' AND user_id % 2 <> 0) AS other_errors
FROM events GROUP BY CAST(ts AS DATE)"""

ORACLE["quarantine"] = """
SELECT event_id, user_id, 'failed ' || event_type || ': ' || props AS result
FROM events WHERE coalesce(event_type = 'error' OR try(json(props)) IS NULL, true)"""

ORACLE["recent_only"] = f"""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {A.RECENT_DAYS} DAY"""


# --- sources, sinks, streaming ---------------------------------------------------

ORACLE["scan_jsonl"] = """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props,
       event_type = 'error' AS is_corrupt,
       CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year
FROM events"""

ORACLE["date_from_filename"] = """
SELECT event_id, CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year FROM events"""

ORACLE["date_from_parts"] = """
SELECT event_id, make_date(year(ts), month(ts), day(ts)) AS job_date FROM events"""

ORACLE["write_roundtrip"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

ORACLE["daily_overwrite"] = """
SELECT event_id, ts,
       CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) THEN value + 1.0 ELSE value END AS value,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM events"""

ORACLE["union_drift"] = """
SELECT event_id, ts, event_type,
       CASE WHEN day(ts) <= 15 THEN NULL ELSE props END AS props,
       CASE WHEN day(ts) <= 15 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events"""

ORACLE["incremental_ingest"] = """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS k,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM events"""

ORACLE["json_projection"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

ORACLE["schema_drift"] = """
SELECT field, count(*) AS n_rows
FROM (SELECT unnest(json_keys(props)) AS field FROM events) GROUP BY field"""

_lemma_rows = ", ".join(f"({q(t)}, {q(x)})" for t, x in A.LEMMAS)
ORACLE["passage_lemmas"] = f"""WITH {PASSAGES},
lemmas AS (SELECT * FROM (VALUES {_lemma_rows}) AS l(token, lemma)),
tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(passage), {q(PASSAGE_TOKEN)})) AS token FROM passages)
SELECT doc_id, coalesce(lemma, t.token) AS token, count(*) AS n
FROM tokens t LEFT JOIN lemmas l ON t.token = l.token GROUP BY ALL"""

ORACLE["schema_diff"] = """
WITH declared AS (SELECT * FROM (VALUES ('event_id', 'bigint', 'bigint', 'same'), ('ts', 'timestamp_ntz', 'string', 'same'),
    ('user_id', 'int', 'bigint', 'same'), ('event_type', 'bigint', 'string', 'other type'), ('props', 'string', 'string', 'same'),
    ('k', 'int', NULL, 'missing'), ('value', NULL, 'decimal', 'new')) d(field, declared_type, found_types, status)),
n AS (SELECT count(event_id) AS event_id, count(ts) AS ts, count(user_id) AS user_id, count(event_type) AS event_type,
             count(props) AS props, count(value) AS value FROM events),
long AS (UNPIVOT n ON event_id, ts, user_id, event_type, props, value INTO NAME field VALUE n_rows)
SELECT field, declared_type, found_types, coalesce(n_rows, 0) AS n_rows, status FROM declared LEFT JOIN long USING (field)"""

_PAGES = """
pages_in AS (SELECT *, o_orderkey % 7 = 0 AS gone, o_orderkey % 11 = 0 AS broken FROM orders),
good AS (SELECT *, (o_orderkey % 1000)::VARCHAR AS job_key FROM pages_in WHERE NOT gone AND NOT broken),
kws AS (SELECT job_key, array_to_string(list_sort(list(DISTINCT lower(o_orderpriority))), '|') AS keywords FROM good GROUP BY job_key)"""
ORACLE["page_postings"] = f"""WITH {_PAGES}
SELECT job_key, o_orderkey::INTEGER AS position, keywords, lower(o_orderpriority) || ' caf\u00e9' AS job_title,
       'clerk ' || o_custkey AS company, 'Status \u2014 ' || o_orderstatus || ' it\u2019s \u00e9 \\ {{"}};' AS job_description,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 2000 * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2080 END END AS salary_min,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice / 1000 * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2080 END END AS salary_max,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'YEARLY' END AS salary_type, 0 AS salary_estimated_flag
FROM good JOIN kws USING (job_key)"""
ORACLE["page_quarantine"] = f"""WITH {_PAGES}
SELECT (o_orderkey % 1000)::VARCHAR AS job_key, o_orderkey::INTEGER AS position,
       CASE WHEN gone THEN 'no data blob in page' ELSE 'data blob is not a JSON object' END AS result
FROM pages_in WHERE gone OR broken"""

ORACLE["daily_flow"] = f"""WITH {SCORES},
kept AS (SELECT doc_id, pos, passage FROM scores WHERE {RELEVANT}),
documents AS (SELECT doc_id, {sql_squeeze("string_agg(passage, ' ' ORDER BY pos)")} AS text FROM kept GROUP BY doc_id),
long AS (SELECT * FROM documents WHERE length(text) > 1),
found AS ({ORACLE["term_extract"].strip().replace("FROM documents)", "FROM long)")}),
terms AS (SELECT doc_id, array_to_string(list_sort(list(term)), '|') AS techs FROM
          (SELECT doc_id, term FROM found) GROUP BY doc_id)
SELECT doc_id, CASE WHEN techs IS NULL THEN '' ELSE
         array_to_string(list_transform(list_filter(string_split(techs, '|'), lambda x: x <> 'article'), lambda x: CASE WHEN x = 'that' THEN 'which' ELSE x END), '|') END AS techs,
       2024 AS year, 3 AS month, (doc_id % 28 + 1)::INTEGER AS day
FROM long LEFT JOIN terms USING (doc_id)"""

# the decimal holds the longest whole part and the longest fraction
ORACLE["schema_infer"] = """
WITH parts AS (SELECT split_part(abs(value)::VARCHAR, '.', 1) AS whole, rtrim(split_part(abs(value)::VARCHAR, '.', 2), '0') AS fraction FROM events)
SELECT 'OBJECT<event_id: BIGINT, event_type: STRING, props: STRING, ts: STRING, user_id: BIGINT, value: DECIMAL('
       || (max(length(whole)) + max(length(fraction))) || ',' || max(length(fraction)) || ')>' AS schema FROM parts"""

_VOTES = f"""{PASSAGES},
words AS (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(passage), {q(PASSAGE_TOKEN)})) AS token FROM passages) GROUP BY token),
pairs AS (SELECT w.token, coalesce(s.token, w.token) AS lemma, w.n FROM words w LEFT JOIN words s ON w.token = s.token || 's' WHERE left(md5(w.token), 1) >= '4'),
votes AS (SELECT right(token, g.len) AS suffix, length(token) - length(lemma) AS strip, sum(n) AS n
          FROM pairs CROSS JOIN generate_series(0, 5) AS g(len)
          WHERE g.len >= length(token) - length(lemma) AND g.len <= least(length(token), length(token) - length(lemma) + 4) GROUP BY ALL),
rules AS (SELECT suffix, arg_min(strip, (-n, strip)) AS strip FROM votes GROUP BY suffix),
cut AS (SELECT token, g.len, strip FROM words CROSS JOIN generate_series(0, 5) AS g(len) JOIN rules ON right(token, g.len) = suffix
        WHERE left(md5(token), 1) < '4' AND g.len <= length(token)),
new AS (SELECT token, arg_max(strip, len) AS strip FROM cut GROUP BY token)"""
ORACLE["lemma_rules"] = f"""WITH {_VOTES}
SELECT token, lemma, true AS known FROM pairs
UNION ALL SELECT token, left(token, length(token) - strip) AS lemma, false AS known FROM new"""

ORACLE["idf_incremental"] = f"""WITH {TFIDF}
SELECT token, df, round(ln((1.0 + n) / (1.0 + df)) + 1.0, 6) AS idf FROM dfreq CROSS JOIN npass"""

ORACLE["reconcile_rows"] = """
WITH o AS (SELECT o_orderkey, o_orderkey % 97 = 0 AS lost, o_orderkey % 89 = 0 AS twice, o_orderkey % 83 = 0 AS other FROM orders)
SELECT o_orderkey, CASE WHEN lost THEN 'lost' WHEN other THEN 'changed' ELSE 'doubled' END AS status, CAST(1 AS BIGINT) AS n_in,
       CAST(CASE WHEN lost THEN 0 WHEN twice THEN 2 ELSE 1 END AS BIGINT) AS n_out
FROM o WHERE lost OR twice OR other
UNION ALL SELECT -o_orderkey - 1, 'added', 0, 1 FROM orders WHERE o_orderkey % 101 = 0"""

_PATHS = """e AS (SELECT CAST(ts AS DATE) AS day, day(ts) AS d, event_type, json_extract(props, '$.k') IS NOT NULL AS has_k FROM events),
found AS (
  SELECT day, '$' AS path, 'object' AS kind, 1 AS n FROM e UNION ALL SELECT day, '$.event_id', 'integer', 1 FROM e
  UNION ALL SELECT day, '$.user', 'object', 1 FROM e UNION ALL SELECT day, '$.user.id', CASE WHEN d >= 20 THEN 'string' ELSE 'integer' END, 1 FROM e
  UNION ALL SELECT day, '$.user.kind', 'string', 1 FROM e WHERE d >= 10 AND event_type IS NOT NULL
  UNION ALL SELECT day, '$.tags', 'array', 1 FROM e UNION ALL SELECT day, '$.tags[]', 'object', 2 FROM e
  UNION ALL SELECT day, '$.tags[].k', 'integer', 2 FROM e WHERE d <> 5 AND has_k
  UNION ALL SELECT day, '$.tags[][''odd name'']', 'string', 1 FROM e
  UNION ALL SELECT day, '$.reading', 'object', 1 FROM e WHERE d NOT BETWEEN 15 AND 17
  UNION ALL SELECT day, '$.reading.unit', 'string', 1 FROM e WHERE d NOT BETWEEN 15 AND 17 AND event_type IS NOT NULL),
paths AS (SELECT day, path, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kinds, CAST(sum(n) AS BIGINT) AS n FROM found GROUP BY day, path)"""
ORACLE["schema_paths"] = f"WITH {_PATHS}\nSELECT day, path, kinds, n FROM paths"

# a path has one kind a day here, so the kinds up to a day are the sorted distinct ones before it
ORACLE["nested_drift"] = f"""WITH {_PATHS},
days AS (SELECT DISTINCT day FROM e),
numbered AS (SELECT day, row_number() OVER (ORDER BY day) AS i, lead(day) OVER (ORDER BY day) AS next_day FROM days),
r AS (SELECT paths.*, i, next_day, lag(i) OVER w AS prev, lead(i) OVER w AS nxt,
             (SELECT coalesce(string_agg(DISTINCT b.kinds, '|' ORDER BY b.kinds), '') FROM paths b WHERE b.path = paths.path AND b.day < paths.day) AS known,
             (SELECT string_agg(DISTINCT b.kinds, '|' ORDER BY b.kinds) FROM paths b WHERE b.path = paths.path AND b.day <= paths.day) AS so_far
      FROM paths JOIN numbered USING (day) WINDOW w AS (PARTITION BY path ORDER BY i))
SELECT path, 'new' AS status, day AS first_day, '' AS before, kinds AS after FROM r WHERE prev IS NULL AND i > 1
UNION ALL SELECT path, 'changed', day, known, kinds FROM r WHERE known <> '' AND NOT list_contains(string_split(known, '|'), kinds)
UNION ALL SELECT path, 'missing', next_day, so_far, '' FROM r WHERE next_day IS NOT NULL AND (nxt IS NULL OR nxt > i + 1)"""
