"""One registered query for each operator, with its SQL where SQL can say it. Importing the operators' names only."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitweave.llm import chunks, collocations, conversations, decontaminate, language, packing, secrets, simhash, tokenfile, topk, urls, vectorjoin, warc
from splitweave.sources.paths import shared_scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5"""


@query("op1_exact_top_k", TOP_K_SQL)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), lambda i: i % 50 == 0, k=5)


@query("op2_substring_dedup")
def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.repeated_spans(table(spark, sf, "documents"))


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@query("op4_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, ~held_out(F.col("doc_id")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op5_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query("op6_decontamination")
def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_token_file")
def token_file(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_scratch(spark, "tokens")
    tokenfile.write_token_file(table(spark, sf, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    read = tokenfile.read_documents(tokenfile.read_index(spark, path), path, with_ids=False)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URL_SQL = """
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
r(rhost, rpath, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path, max_by(rhost || rpath, length(rhost) * 100000 + length(rpath)) AS rule,
       coalesce(max_by(v, length(rhost) * 100000 + length(rpath)), 'allow') AS verdict
FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
GROUP BY page_id, host, path"""


@query("op8_url_filter", URL_SQL)
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), RULES)


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest AS d, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON d = payload_digest"""


@query("op9_warc", WARC_SQL)
def warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive(table(spark, sf, "pages"), shared_scratch(spark, "warc"))


@query("op10_secret_scan")
def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    told = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("secrets", lambda s: s["kind"] != "literal")
    return found.select("doc_id", *map(number, ("assign", "access", "hex")), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans"))


VECTOR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""


@query("op11_embedding_near_dedup", VECTOR_SQL)
def embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vectorjoin.near_vectors(table(spark, sf, "embeddings"), threshold=0.95)


PHRASE_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 30),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY 1),
c AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS p1, array_to_string(w[j + 1 : k], ' ') AS p2 FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (
  SELECT x.lang, x.phrase, a, f1.n AS l, f2.n AS r, (2000000::HUGEINT * a // (f1.n::HUGEINT + f2.n))::BIGINT AS score
  FROM x JOIN f f1 ON f1.lang = x.lang AND f1.phrase = p1 JOIN f f2 ON f2.lang = x.lang AND f2.phrase = p2
  QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, j) = 1),
i AS (
  SELECT lang, array_to_string(w[o : o + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS o FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY 1, 2)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank, s.phrase, a, l, r, t.n, score
FROM s JOIN t ON t.lang = s.lang LEFT JOIN i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000"""


@query("op12_phrase_collocations", PHRASE_SQL)
def phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    found = collocations.phrases(table(spark, sf, "documents"), least=30, longest=4, top=2000, inside=80)
    return found.withColumnRenamed("group", "lang")


REPAIR_SQL = """
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS c FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(i))),
h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: xor(a >> 8, c[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM conversations, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM (SELECT *, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE fault <> 0)),
o AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e,
    row_number() OVER w AS i, lag(role[1]) OVER w || role[1] AS pair, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
f AS (SELECT *, e = '' AS blank, e <> '' AND nth > 1 AS duplicate, e <> '' AND nth = 1 AND right(e, 1) NOT IN ('.', '!', '?') AS cut FROM o),
told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY 1),
dp AS (
  SELECT conv_id, n, 0::BIGINT AS i, {'c': 0, 'a': '', 'r': []::VARCHAR[]} AS s0, {'c': 1000000000, 'a': '', 'r': []::VARCHAR[]} AS s1,
    {'c': 1000000000, 'a': '', 'r': []::VARCHAR[]} AS s2, {'c': 1000000000, 'a': '', 'r': []::VARCHAR[]} AS s3 FROM told
  UNION ALL
  SELECT conv_id, n, i + 1, {'c': s0.c + 2, 'a': s0.a || 'D', 'r': s0.r},
    list_min([{'c': s1.c + 2, 'a': s1.a || 'D', 'r': s1.r}, {'c': s0.c + t + CASE WHEN live AND role[1] = 's' THEN 0 ELSE 1000000000 END, 'a': s0.a || 'K', 'r': list_append(s0.r, role || ':' || text)}]),
    list_min([{'c': b2.c + 2, 'a': b2.a || 'D', 'r': b2.r}]
      || list_transform([s0, s1, b3], lambda x: {'c': x.c + t + CASE WHEN live AND role[1] = 'u' THEN 0 ELSE 1000000000 END, 'a': x.a || 'K', 'r': list_append(x.r, role || ':' || text)})
      || list_transform([s0, s1, b3], lambda x: {'c': x.c + t + CASE WHEN live THEN 1 ELSE 1000000000 END, 'a': x.a || 'R', 'r': list_append(x.r, 'user:' || text)})),
    list_min([{'c': b3.c + 2, 'a': b3.a || 'D', 'r': b3.r}, {'c': b2.c + t + CASE WHEN live AND role[1] = 'a' THEN 0 ELSE 1000000000 END, 'a': b2.a || 'K', 'r': list_append(b2.r, role || ':' || text)},
      {'c': b2.c + t + CASE WHEN live THEN 1 ELSE 1000000000 END, 'a': b2.a || 'R', 'r': list_append(b2.r, 'assistant:' || text)}])
  FROM (
    SELECT *, list_min([s3, {'c': b2.c + 5, 'a': b2.a || 'I', 'r': list_append(b2.r, 'assistant:')}]) AS b3 FROM (
      SELECT dp.*, role, text, NOT (blank OR duplicate) AS live, CASE WHEN cut THEN 5 ELSE 0 END AS t,
        list_min([s2] || list_transform([s0, s1, s3], lambda x: {'c': x.c + 5, 'a': x.a || 'I', 'r': list_append(x.r, 'user:')})) AS b2
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1))),
last AS (
  SELECT conv_id, list_min([s0, s3, {'c': b2.c + 5, 'a': b2.a || 'I', 'r': list_append(b2.r, 'assistant:')}]) AS best
  FROM (SELECT *, list_min([s2] || list_transform([s0, s1, s3], lambda x: {'c': x.c + 5, 'a': x.a || 'I', 'r': list_append(x.r, 'user:')})) AS b2 FROM dp WHERE i = n))
SELECT q.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN last ON last.conv_id IS NOT DISTINCT FROM q.conv_id"""


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's faults: rows lost, emptied, without ends of sentences, repeated, or given to the user."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20
    known = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return known.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@query("op13_conversation_repair", REPAIR_SQL)
def conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    broken = damaged(rows)
    found = conversations.summaries(conversations.repair(broken)).withColumnRenamed("conv_id", "_c")
    holes = conversations.gaps(broken).withColumnRenamed("conv_id", "_g")
    whole = rows.select("conv_id").distinct()
    told = whole.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left").join(holes, F.col("conv_id").eqNullSafe(F.col("_g")), "left")
    number = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return told.select("conv_id", *number, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
