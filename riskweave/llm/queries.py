"""Registered queries of this subpackage, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import alignment, decontamination, embedding_dedup, jaccard_join, language_id, language_model, packing, prefix_trie, quality, sharding, surrogates, token_files, transducer
from riskweave.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Classes of small tables: links, then the smallest id over walks along them.
WALK = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
parts AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""
ORACLE_SQL["op4_embedding_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9), {WALK}
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, p.b) AS component_id,
  e.vec_id = least(e.vec_id, p.b) AS kept
FROM embeddings e LEFT JOIN parts p ON p.a = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) d ON d.a = e.vec_id
"""
# Words and shingles as the texts' own lists; hash() only shortens them.
LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPLIT = f"list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
ORACLE_SQL["op10_decontamination"] = f"""
WITH i0 AS (SELECT item_id, {SPLIT.format('text')} AS w FROM benchmark),
i AS (SELECT item_id, len(w) AS n, least(len(w), 5) AS k, w FROM i0 WHERE len(w) > 0),
si AS (SELECT item_id, n, k, h, count(*) AS y FROM (
  SELECT item_id, n, k, unnest(list_transform(range(1, n - k + 2), lambda p: hash(w[p:p+k-1]))) AS h FROM i)
  GROUP BY ALL),
d AS (SELECT doc_id, {SPLIT.format('text')} AS w FROM documents),
sd AS (SELECT doc_id, len(w) AS m, x.k, unnest(range(0, len(w) - x.k + 1)) AS p,
  unnest(list_transform(range(1, len(w) - x.k + 2), lambda p: hash(w[p:p+x.k-1]))) AS h
  FROM d JOIN (SELECT DISTINCT k FROM i) x ON len(w) >= x.k),
hit AS (SELECT DISTINCT sd.doc_id, m, si.item_id, si.n, si.k FROM sd JOIN si ON sd.h = si.h AND sd.k = si.k),
win AS (SELECT *, unnest(range(0, greatest(m - n, 0) + 1)) AS s FROM hit),
c AS (SELECT win.doc_id, win.item_id, s, least(win.m, win.n) - win.k + 1 AS a, win.n - win.k + 1 AS b, sd.h, count(*) AS x
  FROM win JOIN sd ON sd.doc_id = win.doc_id AND sd.k = win.k AND sd.p BETWEEN s AND s + win.n - win.k
  GROUP BY ALL),
v AS (SELECT doc_id, c.item_id, s, a, b, sum(least(x, y)) AS z FROM c JOIN si ON si.item_id = c.item_id AND si.h = c.h
  GROUP BY ALL),
f AS (SELECT doc_id, item_id, max(z / (a + b - z)) AS r FROM v WHERE 4 * z >= 3 * (a + b - z) GROUP BY ALL),
g AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ' ' ORDER BY item_id) AS ids, max(r) AS r FROM f GROUP BY doc_id)
SELECT documents.doc_id, g.n IS NOT NULL AS contaminated, coalesce(g.n, 0)::BIGINT AS n_items, coalesce(ids, '') AS item_ids,
  coalesce(r, 0)::DOUBLE AS similarity
FROM documents LEFT JOIN g ON g.doc_id = documents.doc_id
"""
ORACLE_SQL["op6_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: hash(w[i:i+4]))
    WHEN len(w) > 0 THEN [hash(w)] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
{WALK}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, p.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN parts p ON p.a = d.doc_id
"""

# crc32 one bit a step: a step adds a byte's value or nothing, then shifts.
CRC = """xor(list_reduce([4294967295] || flatten([[ord(x), 0, 0, 0, 0, 0, 0, 0] for x in string_split({}, '')]),
  lambda r, x: xor(xor(r, x) >> 1, 3988292384 * (xor(r, x) & 1))), 4294967295)"""
ORACLE_SQL["op13_prefix_trie"] = f"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS j
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS g, {CRC.format("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM o)),
w AS (SELECT h.c, 0 AS k, o.j, o.r, o.t FROM h JOIN o ON o.c = h.g AND o.j <= h.h
  UNION ALL SELECT h.c, 1, o.j, o.r, o.t FROM h JOIN o ON o.c = h.c AND o.j > h.h),
p AS (SELECT h.c, coalesce(list((r, t) ORDER BY k, j) FILTER (r IS NOT NULL), []) AS p
  FROM h LEFT JOIN w ON w.c = h.c GROUP BY h.c),
m AS (SELECT c, p[1:d] AS p, d, len(p) = d AS ends FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM p)),
n AS (SELECT p, any_value(d) AS d, min(c) AS c, count(*) AS n, sha256(coalesce(string_agg(c, ',' ORDER BY c) FILTER (ends), '')) AS e
  FROM m GROUP BY p),
k AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(k.k, 0) AS k, CASE WHEN d > 0 THEN (n.n - 1) * length(n.p[d][2]) ELSE 0 END AS s FROM n LEFT JOIN k ON k.p = n.p),
b AS (SELECT p, sum(s) AS s, sum((k = 0)::INT) AS l FROM (SELECT p[1:unnest(range(0, d + 1))] AS p, s, k FROM v) GROUP BY p)
SELECT v.c AS conv_id, v.d AS depth, u.c AS parent_conv_id, v.n AS n_convs, v.k AS n_children, b.l::BIGINT AS n_leaves,
  b.s::BIGINT AS saved_tokens, v.e AS ends_sha256
FROM v JOIN b ON b.p = v.p LEFT JOIN n u ON v.d > 0 AND u.p = v.p[1:v.d - 1]
"""


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replaced(docs).withColumnRenamed("_entities", "n_entities")


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    place = token_files.scratch(spark)
    token_files.write(read(spark, folder, "documents"), place)
    return token_files.load(spark, place, digests=True)


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, folder, "embeddings"))


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return transducer.count_tokens(read(spark, folder, "documents"))


@query
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(read(spark, folder, "documents"))


@query
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read(spark, folder, "documents"))


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), with_ids=False)


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read(spark, folder, "pages"), read(spark, folder, "documents"))


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.mark(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.withColumn("item_ids", F.coalesce(F.array_join("item_ids", " "), F.lit("")))


@query
def op11_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(read(spark, folder, "documents"))


@query
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.scored(read(spark, folder, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.turns_of(read(spark, folder, "conversations"))
    return prefix_trie.trie(*prefix_trie.regrouped(turns))
