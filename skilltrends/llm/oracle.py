"""DuckDB SQL of the operators that SQL can express, written from their contracts.

Not here: op4, op6 and op8 (trained models: held-out accuracy), op9 (XXH64) and op10 (tokenizer
library), which tests/llm holds against brute force. op11, op12 and op13 are in both."""

from __future__ import annotations

from . import mix, shard, url_filter

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
windows AS (SELECT r, i, array_to_string(list_slice(w, i, i + 2), ' ') AS s
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n >= 2),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY r),
m AS (SELECT doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             len(l) AS n_lines, coalesce(n, 0) AS n_repeat_words
      FROM d JOIN lines USING (r) LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
            OR 10 * len(regexp_extract_all(text, '[A-Za-z\x{{80}}-\x{{FFFF}}][^\x20\x09-\x0D]*')) < 7 * n_words
            OR 10 * len(regexp_extract_all(text, '[A-Z]{{2,}}[^\x20\x09-\x0Da-z]*!')) > 3 * n_words
            OR 10 * len(regexp_extract_all(text, '[!?]{{2,}}')) > 3 * n_words) AS kept
FROM b
"""

DIGEST60 = "('0x' || substr(md5({}), 1, 15))::BIGINT"


def _rounds() -> str:
    """The six rounds of the network as a chain of sub-queries over (n, l, r, a, b)."""
    sql = "SELECT *, v % a AS l, v // a AS r FROM {source}"
    for j in range(6):
        if j % 2 == 0:
            new = f"(l + {DIGEST60.format(f"'{shard.SEED}:{j}:' || r")} % a) % a AS l, r"
        else:
            new = f"l, (r + {DIGEST60.format(f"'{shard.SEED}:{j}:' || l")} % b) % b AS r"
        sql = f"SELECT * EXCLUDE (l, r), {new} FROM ({sql})"
    return f"SELECT * EXCLUDE (l, r, v), l + a * r AS v FROM ({sql})"


CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) AS c
    FROM range(256) x(i)))"""

OP2 = f"""
WITH RECURSIVE {CRC_TABLE},
bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
                 list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
crc AS (SELECT doc_id, size, xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) AS crc
        FROM bytes, crc_table),
numbered AS (SELECT *, row_number() OVER (ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || size || ':' || crc), 1, 3),
                                          doc_id NULLS FIRST, size, crc) - 1 AS n, count(*) OVER () AS total FROM crc),
side AS (SELECT *, greatest(1, ceil(sqrt(total))::BIGINT) AS a FROM numbered),
rect AS (SELECT doc_id, size, crc, n, total, a, greatest(1, ceil(total / a)::BIGINT) AS b, n::BIGINT AS v FROM side),
walk AS (SELECT * FROM ({_rounds().format(source="rect")})
         UNION ALL
         SELECT * FROM ({_rounds().format(source="(SELECT * FROM walk WHERE v >= total)")}))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (v % {shard.SHARDS})::INTEGER AS shard,
       (v // {shard.SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE v < total
"""

OP3 = f"""
WITH d AS (SELECT doc_id, source IS NULL AS no_src, coalesce(source, '') AS src, len({WORDS}) AS size FROM documents),
h AS (SELECT *, md5('{mix.SEED}:' || coalesce(doc_id::VARCHAR, '-') || ':' || size) AS h FROM d),
p AS (SELECT *, ('0x' || substr(h, 1, 3))::INTEGER AS bucket, ('0x' || substr(h, 1, 3))::INTEGER % {mix.STREAMS} AS stream FROM h),
s AS (SELECT no_src, src, sum(size)::BIGINT AS size, [5, 2, 1][((row_number() OVER (ORDER BY no_src, src) - 1) % 3 + 1)::BIGINT] AS w
      FROM p GROUP BY no_src, src),
c AS (SELECT *, sum(size) OVER () AS total, row_number() OVER o AS k,
             coalesce(sum(2 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
      FROM s WINDOW o AS (ORDER BY 2 * size / w, no_src, src)),
f AS (SELECT *, (3 * total - 2 * full_words) * w <= 2 * size * 2 * open AS fits FROM c),
first AS (SELECT min(k) AS k0 FROM f WHERE fits),
level AS (SELECT 3 * total - 2 * full_words AS up, 2 * open AS down FROM f, first WHERE k = k0),
t AS (SELECT no_src, src, size, CASE WHEN k < k0 THEN (2 * size)::DOUBLE ELSE (w * up)::DOUBLE / down::DOUBLE END AS target
      FROM f, first, level),
house AS (SELECT round(sum(target) / {mix.BLOCK_TOKENS})::BIGINT AS seats FROM t),
won AS (SELECT no_src, src, count(*) AS blocks FROM (
          SELECT no_src, src, row_number() OVER (ORDER BY target / (2 * i - 1) DESC, no_src, src) AS r, seats
          FROM t, house, LATERAL unnest(range(1, seats + 1)) u(i) WHERE target > 0) WHERE r <= seats GROUP BY no_src, src),
st AS (SELECT no_src, src, stream, sum(size)::BIGINT AS words FROM p GROUP BY ALL),
quota AS (SELECT no_src, src, stream, count(*) AS q FROM (
            SELECT no_src, src, stream, blocks, row_number() OVER (PARTITION BY no_src, src ORDER BY words / (2 * i - 1) DESC, stream) AS r
            FROM st JOIN won USING (no_src, src), LATERAL unnest(range(1, blocks + 1)) u(i) WHERE words > 0) WHERE r <= blocks
          GROUP BY no_src, src, stream),
n AS (SELECT st.*, CASE WHEN words > 0 THEN greatest(1, round(words / {mix.BLOCK_TOKENS}))::BIGINT ELSE 0 END AS n, coalesce(q, 0) AS q
      FROM st LEFT JOIN quota USING (no_src, src, stream)),
run AS (SELECT * EXCLUDE (q), least(q, 2 * n) // n AS full_copies, least(q, 2 * n) % n AS run,
               {DIGEST60.format(f"'{mix.SEED}:' || src || ':' || stream")} % n AS first
        FROM n WHERE n > 0),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY no_src, src, stream ORDER BY bucket, h, doc_id NULLS FIRST, size
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM p),
pieces AS (SELECT pl.*, full_copies, a + pl.size AS z, (first * words) // n AS f1,
                  CASE WHEN first + run > n THEN words ELSE ((first + run) * words) // n END AS t1,
                  CASE WHEN first + run > n THEN ((first + run - n) * words) // n ELSE 0 END AS t2
           FROM placed pl LEFT JOIN run USING (no_src, src, stream))
SELECT doc_id, pieces.size::BIGINT AS size, t.size::BIGINT AS source_size, target,
       CASE WHEN pieces.size = 0 THEN 0 ELSE full_copies * pieces.size + greatest(0, least(z, t1) - greatest(a, f1)) + greatest(0, least(z, t2) - a) END::BIGINT AS taken
FROM pieces JOIN t USING (no_src, src)
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
OP5 = rf"""
WITH rules AS (SELECT * FROM (VALUES {_RULES}) r(verdict, rule_host, rule_path)),
u AS (SELECT row_number() OVER () AS r, page_id,
             translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (SELECT r, rule_host || rule_path AS rule, verdict FROM u, rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host) DESC, length(rule_path) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fit USING (r)
"""

OP7 = r"""
WITH lowered AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id::VARCHAR AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), coalesce(item_id::VARCHAR, 'null'), text FROM benchmark),
words AS (SELECT kind, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
item_windows AS (SELECT DISTINCT id AS item, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS s
                 FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS i FROM (SELECT *, least(13, len(w)) AS l FROM words WHERE kind = 'b' AND len(w) > 0))),
lengths AS (SELECT DISTINCT l FROM item_windows),
doc_windows AS (SELECT r, l, i, array_to_string(list_slice(w, i, i + l - 1), ' ') AS s
                FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM words, lengths WHERE kind = 'd' AND len(w) >= l)),
hits AS (SELECT r, l, i, item FROM doc_windows JOIN item_windows USING (l, s)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r) WHERE kind = 'd'
"""

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Equal words q apart make islands; an island of k of them is a stretch of k + q words.
OP11 = rf"""
WITH {CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w,
                list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
h AS (SELECT r, doc_id, w, len(w) AS n, coalesce(xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295), 1) AS h
      FROM docs, crc_table),
p AS (SELECT r, n, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM h),
words AS (SELECT r, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS x
          FROM (SELECT r, w, unnest(range(len(w))) AS i FROM h) JOIN p USING (r)),
same AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.x = y.x AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM same),
stretch AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, s, l, min(q) AS q FROM stretch GROUP BY r, s, l),
best AS (SELECT r, s, l, q FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY l DESC, s, q) = 1),
listed AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS text FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period,
       (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""

OP12 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT row_number() OVER () AS k, item_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM (SELECT DISTINCT item_id, text FROM benchmark)),
total AS (SELECT count(*) FILTER (len(w) > 0) AS nn, sum(len(w)) AS ll FROM docs),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
df AS (SELECT t, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT AS weight FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
part AS (SELECT r, t, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * nn) // ll))) AS s
         FROM tf JOIN docs USING (r) JOIN df USING (t), total),
score AS (SELECT k, r, sum(s)::BIGINT AS score FROM (SELECT DISTINCT k, unnest(w) AS t FROM items) JOIN part USING (t) GROUP BY k, r HAVING sum(s) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM score JOIN items USING (k) JOIN docs USING (r) QUALIFY rank <= 10
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT r, doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS s
            FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
earliest AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM windows JOIN earliest USING (s) WHERE low < doc_id),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1, "op2_feistel_shards": OP2, "op3_source_mix": OP3, "op5_url_filter": OP5, "op7_decontamination": OP7,
    "op11_periodic_runs": OP11, "op12_lexical_search": OP12, "op13_substring_dedup": OP13}
