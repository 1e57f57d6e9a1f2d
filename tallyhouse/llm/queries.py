"""The registered queries of this package and the SQL that states them again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import centroids, chat, decontamination, id_files, jaccard, language_model, packing, quality_rules, repeats, runs, toxicity, warc
from tallyhouse.llm.base import remainder, table
from tallyhouse.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op3_token_counts(spark, folder):
    return count_tokens(table(spark, folder, "documents"), "word_bpe_49k.json")


_WORDS = r"list_filter(regexp_split_to_array({}, '[ \x09-\x0D]+'), LAMBDA x: x <> '')"
_GRAMS = """SELECT rid, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS g
    FROM (SELECT rid, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w) WINDOW o AS (PARTITION BY rid ORDER BY i)"""

SQL["op2_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, {_WORDS.format('t')} AS ws, list_filter(string_split(t, chr(10)), LAMBDA x: regexp_matches(x, '[^ \x09-\x0D]')) AS lines FROM d),
grams AS ({_GRAMS}),
again AS (SELECT rid, i FROM grams WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS p FROM again, range(5) r(k)) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
      FROM w LEFT JOIN covered USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 2 * n_symbols > n_words OR 10 * n_dup_lines > 3 * greatest(n_lines, 1)
       OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM b"""

SQL["op5_jaccard_components"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS rid,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, rid, {_WORDS.format('t')} AS ws FROM d),
s AS (SELECT DISTINCT rid, g FROM ({_GRAMS}) WHERE g IS NOT NULL
      UNION ALL SELECT rid, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT rid, count(*) AS size FROM s GROUP BY rid),
both_ AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * c >= 75 * (x.size + y.size - c)),
reach AS (SELECT rid, rid AS r FROM w UNION SELECT reach.rid, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT w.doc_id, coalesce(any_value(size), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM w LEFT JOIN n USING (rid) JOIN reach USING (rid) JOIN w o ON o.rid = reach.r GROUP BY w.rid, w.doc_id"""


@query
def op4_id_files(spark, folder):
    files = id_files.write(table(spark, folder, "documents"), "byte_bpe_50k.json", end_id=2)
    return id_files.read(spark, files)


@query
def op2_quality_rules(spark, folder):
    return quality_rules.judge(table(spark, folder, "documents"))


@query
def op6_chat_examples(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], turns.schema)
    return chat.digest(spark, chat.write(turns.unionByName(extra)))


SQL["op6_chat_examples"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
  coalesce(sum(length(x)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(15 + length(r) + length(x) + length(regexp_replace(r, '[^\\#<:]', '', 'g')) + length(regexp_replace(x, '[^\\#<]', '', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""


@query
def op9_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), "word_bpe_49k.json", end_id=2)


@query
def op5_jaccard_components(spark, folder):
    return jaccard.similar_components(table(spark, folder, "documents"))


@query
def op10_decontamination(spark, folder):
    return decontamination.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_warc(spark, folder):
    return warc.read(spark, warc.write(table(spark, folder, "pages")))


@query
def op1_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, remainder("doc_id", 5) != 0)
    found = toxicity.score(docs, model)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_language_model(spark, folder):
    docs = table(spark, folder, "documents")
    scored = language_model.train_and_score(docs, remainder("doc_id", 7) != 2, order=3)
    return scored.withColumn("held_out", remainder("doc_id", 7) == 2)


@query
def op11_repeated_passages(spark, folder):
    kept = repeats.remove_repeats(table(spark, folder, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed")
    return kept.select("doc_id", "n_bytes", removed, F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_word_runs(spark, folder):
    return runs.digest(runs.find_runs(table(spark, folder, "documents"), plant=True))


@query
def op13_centroid_clusters(spark, folder):
    return centroids.cluster(table(spark, folder, "embeddings"), k=8, rounds=10, seed=3)


# crc32 of a key as text, bit by bit: a number is a byte to take in, -1 a step over one bit
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    LAMBDA c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    LAMBDA a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END), 4294967295::BIGINT)"""

SQL["op12_word_runs"] = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_CRC32} AS h, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
e AS (SELECT *, len(ws)::BIGINT AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM e),
w AS (SELECT rid, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] AS x
      FROM (SELECT *, unnest(range(n)) AS i FROM f)),
same AS (SELECT l.rid, l.i, r.i - l.i AS q FROM w l JOIN w r ON l.rid = r.rid AND l.x = r.x AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM same),
stretches AS (SELECT rid, q, min(i) AS s, count(*) + q AS n FROM islands GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT rid, s, n, min(q) AS q FROM stretches GROUP BY rid, s, n),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY n / q DESC, s, q) = 1),
lists AS (SELECT rid, count(*) AS c, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM r GROUP BY rid),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS t FROM w
         WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = w.rid AND w.i >= r.s + r.q AND w.i < r.s + r.n) GROUP BY rid)
SELECT doc_id, coalesce(c, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.n::BIGINT AS length, best.q::BIGINT AS period,
  (1000 * best.n // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lists.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM f LEFT JOIN best USING (rid) LEFT JOIN lists USING (rid) LEFT JOIN kept USING (rid)"""

_ROUND = """a{0} AS MATERIALIZED (SELECT rid, arg_min(j, apart * 8 + j) AS j, min(apart) AS apart FROM (
      SELECT v.rid, c.j, list_sum(list_transform(list_zip(v.x, c.x), LAMBDA p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS apart FROM v, c{0} c) GROUP BY rid)"""
_MOVE = """m{0} AS MATERIALIZED (SELECT j, i, sum(v.x[i])::BIGINT AS s, count(*) AS n FROM a{0} JOIN v USING (rid), range(1, 65) r(i) GROUP BY j, i),
    c{1} AS MATERIALIZED (SELECT j, coalesce(y, x) AS x FROM c{0} LEFT JOIN (
      SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS y FROM m{0} GROUP BY j) USING (j))"""

SQL["op13_centroid_clusters"] = f"""
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, LAMBDA x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, LAMBDA x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j, x FROM v QUALIFY j < 8),
{", ".join(_ROUND.format(i) + ", " + _MOVE.format(i, i + 1) for i in range(10))},
{_ROUND.format(10)}
SELECT vec_id, j::INTEGER AS cluster, apart AS distance, (sum(apart) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
  (sum(apart) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a10 JOIN v USING (rid) JOIN c10 c USING (j)"""
