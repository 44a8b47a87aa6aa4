"""The ``opN_<name>`` queries: each operator over its whole table with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import audit, decontaminate, language, lines, packing, quality, repetition, search, simhash, substring, tokenfile, toxicity, urls
from pricelens.llm.common import held_out

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed_lines", F.col("text").alias("kept_text"))


LLM_ORACLE["op1_line_dedup"] = rf"""
WITH l AS (SELECT doc_id, i, line, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM (
             SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
r AS (SELECT *, (h + coalesce(lag(h) OVER w, 0) * {lines.ROLL}) % {lines.PRIME} % 8 <> 0 OR lead(i) OVER w IS NULL AS ends FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
b AS (SELECT *, coalesce(min(CASE WHEN ends THEN i END) OVER w, i + 7) AS e, max(i) OVER (PARTITION BY doc_id) AS n FROM r
      WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING)),
ch AS (SELECT b.doc_id, b.i AS s, b.e, string_agg(l.line, chr(10) ORDER BY l.i) AS chunk FROM b JOIN l ON l.doc_id = b.doc_id AND l.i BETWEEN b.i AND b.e WHERE b.i < n GROUP BY b.doc_id, b.i, b.e),
d AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, s) > 1 AS later FROM ch WHERE regexp_matches(chunk, '[^\x20\x09-\x0D]')),
x AS (SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS i FROM d WHERE later),
o AS (SELECT l.doc_id, l.i, l.line, x.i IS NOT NULL AS gone FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i)
SELECT t.doc_id, count(o.i)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_removed_lines,
       CASE WHEN any_value(t.text) IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS kept_text
FROM documents t LEFT JOIN o ON t.doc_id = o.doc_id GROUP BY t.doc_id
"""


@query
def op1_line_dedup_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op1_line_dedup, with the chunks of four seeds, which also end after four equal lines."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), seeds=4, equal=4)
    return out.select("doc_id", "n_lines", "n_removed_lines", F.col("text").alias("kept_text"))


LLM_ORACLE["op1_line_dedup_seeds"] = rf"""
WITH l AS (SELECT doc_id, i, line, md5(line) AS m FROM (
             SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
f AS (SELECT *, coalesce(line <> lag(line) OVER (PARTITION BY doc_id ORDER BY i), true) AS begins FROM l),
g AS (SELECT *, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) % 4 = 0 AS fourth FROM g),
h AS (SELECT doc_id, i, line, fourth, k, ('0x' || substr(m, 7 * k::INT + 1, 7))::BIGINT AS h FROM q, range(4) t(k)),
r AS (SELECT *, (h + coalesce(lag(h) OVER w, 0) * {lines.ROLL}) % {lines.PRIME} AS r FROM h WINDOW w AS (PARTITION BY doc_id, k ORDER BY i)),
b AS (SELECT *, fourth OR coalesce(r < lag(r) OVER w AND r <= lead(r) OVER w, false) AS ends FROM r WINDOW w AS (PARTITION BY doc_id, k ORDER BY i)),
n AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM b),
ch AS (SELECT DISTINCT doc_id, s, e, chunk FROM (SELECT doc_id, min(i) AS s, max(i) AS e, string_agg(line, chr(10) ORDER BY i) AS chunk FROM n GROUP BY doc_id, k, c)),
d AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, s) > 1 AS later FROM ch WHERE e > s AND regexp_matches(chunk, '[^\x20\x09-\x0D]')),
x AS (SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS i FROM d WHERE later),
o AS (SELECT l.doc_id, l.i, l.line, x.i IS NOT NULL AS gone FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i)
SELECT t.doc_id, count(o.i)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_removed_lines,
       CASE WHEN any_value(t.text) IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS kept_text
FROM documents t LEFT JOIN o ON t.doc_id = o.doc_id GROUP BY t.doc_id
"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~out))
    return language.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(table(spark, sf_dir, "documents"), window=35)


LLM_ORACLE["op4_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS p FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, p FROM win JOIN (SELECT s FROM win GROUP BY s HAVING count(*) > 1) USING (s)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 34)) AS p FROM rep),
kept AS (SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.p) AS t, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d) k
         ANTI JOIN gone g ON k.doc_id = g.doc_id AND k.p = g.p GROUP BY k.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), similarity=0.8)


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), size=4096, end_id=1)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 4, 2)
    model = quality.train(docs, labels.where(~out))
    return quality.score(docs, model, threshold=0.7).select("doc_id", out.alias("held_out"), "score", "predicted")


#: (host, path, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(str(r) for r in URL_RULES)} AS t(host, path, verdict)")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


LLM_ORACLE["op8_url_filter"] = f"""
WITH rules(rhost, rpath, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS k FROM (SELECT page_id, coalesce(rest, '') AS rest FROM u)),
f AS (SELECT k, rhost || rpath AS rule, v, row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC) AS n
      FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN f ON p.k = f.k AND f.n = 1
"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    learn = labels.where(~out & F.col("toxic").isin(0, 1))
    prior = learn.agg(F.avg("toxic")).first()[0] or 0.0
    model = toxicity.train(docs, learn.where("toxic = 1"), docs.where(~out), prior)
    return toxicity.score(docs, model, threshold=0.7).select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_LIMITS = ", ".join(f"({k}, {v})" for k, v in ({3: 9} | repetition.NGRAM_LIMITS).items())
LLM_ORACLE["op10_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
c AS (SELECT doc_id, coalesce(sum(length(x)), 0)::BIGINT AS word_chars FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY doc_id),
win AS (SELECT doc_id, n, top, p, CASE WHEN n = 3 THEN count(*) OVER (PARTITION BY doc_id, n, s) ELSE row_number() OVER (PARTITION BY doc_id, n, s ORDER BY p) END AS k FROM (
          SELECT doc_id, n, top, p, array_to_string(w[p:p + n - 1], ' ') AS s FROM (
            SELECT doc_id, w, n, top, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, (VALUES {_LIMITS}) l(n, top) WHERE len(w) >= n))),
hit AS (SELECT DISTINCT doc_id, n, top, unnest(generate_series(p, p + n - 1)) AS p FROM win WHERE k > 1),
cov AS (SELECT h.doc_id, n, any_value(top) AS top, count(*) AS words, sum(length(d.w[h.p])) AS chars FROM hit h JOIN d ON d.doc_id = h.doc_id GROUP BY h.doc_id, n),
lim AS (SELECT cov.doc_id, max(CASE WHEN n = 3 THEN words END) AS n_repeat_words, bool_or(n > 3 AND chars / word_chars > top) AS bad FROM cov JOIN c ON c.doc_id = cov.doc_id GROUP BY cov.doc_id),
ln AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS r FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n, count(*) FILTER (r > 1) AS n_dup, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (r > 1) AS chars FROM ln GROUP BY doc_id),
m AS (SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n_dup, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(bad, false) OR coalesce(dup.n_dup / dup.n > {repetition.LINE_LIMIT}, false) OR coalesce(dup.chars / word_chars > {repetition.LINE_CHAR_LIMIT}, false) AS bad
      FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN lim ON lim.doc_id = d.doc_id LEFT JOIN dup ON dup.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR bad) AS kept FROM m
"""


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LLM_ORACLE["op11_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, quality = 1 AS good, toxic = 1 AS tox,
             CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN min(d.doc_id) OVER (PARTITION BY t) < d.doc_id THEN 'E' ELSE '' END AS fails
      FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (tox) AS tox FROM f GROUP BY part, fails),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
perm AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM one a, one b, one c, one d, one e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, step, substr(o, step::INT, 1) AS f, substr(o, 1, step::INT - 1) AS before FROM perm, range(1, 6) t(step)),
x AS (SELECT part, o, step, f, n, good, tox, contains(fails, f) AS bad, translate(fails, before, '') <> fails AS gone, fails = f AS alone FROM cells, steps),
g AS (SELECT part, o, step, f, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed,
             coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
             coalesce(sum(good) FILTER (bad AND NOT gone), 0) AS good_lost, coalesce(sum(tox) FILTER (bad AND NOT gone), 0) AS toxic_lost FROM x GROUP BY part, o, step, f)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM g
"""


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, dictionary = tokenfile.write_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)
    out = tokenfile.read_tokens(files, dictionary)
    return out.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


LLM_ORACLE["op13_ranked_search"] = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
len AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM len),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY term),
norm AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // total AS m FROM len, corpus),
item AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
need AS (SELECT item_id, term, count(*) AS times FROM item GROUP BY item_id, term),
s AS (SELECT item_id, tf.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM need JOIN w ON w.term = need.term JOIN tf ON tf.term = need.term JOIN norm ON norm.doc_id = tf.doc_id GROUP BY item_id, tf.doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
