"""The operators of this package, applied to the given tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonemill.llm import (
    decontam,
    exact,
    kdtree,
    langid,
    lines,
    minhash,
    mixing,
    phrases,
    pii,
    ranked,
    secrets,
    sharding,
    suffix,
)
from tonemill.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401

N_SHARDS = 40
#: Stands for the secret that a user would keep.
PII_KEY = "key of the registered query"

MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS o,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM docs GROUP BY source),
weighted AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (rank - 1) % 3]::DOUBLE AS weight FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(source_size * 2) OVER fill, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0)) AS level
  FROM weighted
  WINDOW fill AS (ORDER BY source_size / weight, rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least((max(level) OVER ()) * weight, (source_size * 2)::DOUBLE) AS target FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS goal,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(least(goal - start, size), 0)
        + greatest(least(goal - start - source_size, size), 0))::BIGINT AS taken
FROM placed
"""

LINES_SQL = r"""
WITH split AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
often AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT *, key IN (SELECT key FROM often) AS gone FROM keyed)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

TOP_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


RANK_SQL = r"""
WITH items AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark),
asked AS (SELECT q, item_id, unnest(terms) AS term FROM items),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sized AS (SELECT *, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
freqs AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM freqs, whole GROUP BY term, n_docs),
scored AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf)
           // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN freqs USING (term) JOIN weights USING (term), whole GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
starts AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
  FROM split, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
often AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*)::BIGINT AS a
  FROM starts GROUP BY ALL HAVING count(*) >= 100),
listed AS (SELECT *, string_split(phrase, ' ') AS w FROM often),
cuts AS (
  SELECT lang, phrase, m, a, k, array_to_string(w[1:k], ' ') AS head,
         array_to_string(w[k + 1:m], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM listed WHERE m > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, h.a AS l, t.a AS r, n,
         (1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a) AS score
  FROM cuts c JOIN often h ON h.lang = c.lang AND h.phrase = c.head
  JOIN often t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals s ON s.lang = c.lang),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
maximal AS (
  SELECT * FROM weakest x WHERE NOT EXISTS (
    SELECT 1 FROM often y WHERE y.lang = x.lang AND y.m > x.m AND y.a >= x.a
      AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM maximal)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

EXACT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(text) AS text_sha256
FROM d WINDOW same AS (PARTITION BY text)
"""


@query("op1_odd_sketch_minhash")
def op1_odd_sketch_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), minhash.NearDup(width=4))


@query("op2_hierarchical_langid")
def op2_hierarchical_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op3_curriculum_mix", MIX_SQL)
def op3_curriculum_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in training order, with the words that the mix takes of each."""
    assigned = mixing.assign(table(spark, sf, "documents"))
    return mixing.in_training_order(assigned, F.get("copies", F.lit(0))["position"], "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op4_feistel_pseudonyms")
def op4_feistel_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY)


@query("op5_bwt_repeats")
def op5_bwt_repeats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


@query("op6_line_dedup", LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_uniform_shards")
def op7_uniform_shards(spark: SparkSession, sf: str) -> DataFrame:
    rows = sharding.keyed(table(spark, sf, "documents"))
    return sharding.shuffle_to_shards(rows, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query("op8_entropy_secrets")
def op8_entropy_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    n = lambda kind: F.size(of(kind)).cast("bigint")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(secrets.joined(of(*secrets.BASE_KINDS)), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"))


@query("op9_bm25_leaks")
def op9_bm25_leaks(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select("item_id", "text")
    return decontam.find_leaks(table(spark, sf, "documents"), items)


@query("op10_kdtree_topk", TOP_SQL)
def op10_kdtree_topk(spark: SparkSession, sf: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op11_limited_accumulators", RANK_SQL)
def op11_limited_accumulators(spark: SparkSession, sf: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 50)


@query("op12_fm_collocations", PHRASE_SQL)
def op12_fm_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"), least=100, top=2000)


@query("op13_radix_exact_dedup", EXACT_SQL)
def op13_radix_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf, "documents"))
