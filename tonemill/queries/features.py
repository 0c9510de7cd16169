"""TF-IDF, pooled vectors, token sequences."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tonemill.constants import (CLS, CONTINUATION, HIST_BINS, MAX_LEN, PAD, PROFILE_MAX_FEATURES,
                                PROFILE_NGRAMS, SEP, STOP_WORDS, TFIDF_MAX_FEATURES, TFIDF_MIN_DF,
                                TFIDF_NGRAMS, TOP_N, UNK)
from tonemill.functions.tokens import ws_tokens
from tonemill.operators import profile, subword, tfidf, vectors
from tonemill.operators.rows import clean, filter_class
from tonemill.plans.materialize import materialize
from tonemill.queries import corpus, sql
from tonemill.queries.registry import query

_VOCAB = sql.vocabulary(sql.FREQUENCY_TERMS, TFIDF_MIN_DF, TFIDF_MAX_FEATURES)
_IDF = f"SELECT term, tf, df, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM ({_VOCAB})"
_SPLIT_TERMS = sql.term_rows(sql.cleaned("frequency", sql.SPLITS), "Processed", STOP_WORDS, 3, "split, ID")


def _words(df, *keep):
    """Written, since a vocabulary reads its words twice; n-grams are made of them where they are read."""
    words = clean(df, "frequency").select(*keep, tfidf.word_array(F.col("Processed")).alias("terms"))
    return materialize(words, "words")


@query("tfidf_vocab", _VOCAB)
def tfidf_vocab(spark, sf):
    return tfidf.fit_vocabulary(_words(corpus.documents(spark, sf)), ngram_range=TFIDF_NGRAMS)


@query("tfidf_idf", f"SELECT term, tf, df, round(idf, 6) AS idf FROM ({_IDF})")
def tfidf_idf(spark, sf):
    docs = corpus.documents(spark, sf)
    vocabulary = tfidf.fit_vocabulary(_words(docs), ngram_range=TFIDF_NGRAMS)
    return (tfidf.fit_idf(vocabulary, tfidf.row_count(docs))
            .withColumn("idf", F.round("idf", 6)))


@query("tfidf_weights", f"""
WITH v AS ({_IDF}), t AS (SELECT split, ID, term, count(*) AS tf FROM ({_SPLIT_TERMS}) GROUP BY ALL),
w AS (SELECT t.split, t.ID, t.term, t.tf * v.idf AS raw FROM t JOIN v ON t.term = v.term)
SELECT split, ID, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY split, ID)), 6) AS weight FROM w""")
def tfidf_weights(spark, sf):
    """Fitted on the training texts, applied to all three splits."""
    rows = _words(corpus.splits(spark, sf), "split", "ID")
    return (tfidf.weights(rows.filter("split = 'train'"), rows, keep=("split", "ID"), ngram_range=TFIDF_NGRAMS)
            .withColumn("weight", F.round("weight", 6)))


def _top_ngrams(name: str, label: int):
    lo, hi = PROFILE_NGRAMS
    source = f"SELECT * FROM ({sql.LABELLED}) WHERE Label = {label}"
    terms = sql.term_rows(source, "Text", sql.english_stop_words(), hi)

    @query(name, f"""
WITH r AS ({terms}),
v AS (SELECT term, tf, ln((1 + (SELECT count(*) FROM ({source}))) / (1 + df)) + 1 AS idf
      FROM ({sql.vocabulary('SELECT * FROM r', 1, PROFILE_MAX_FEATURES)})),
t AS (SELECT ID, term, count(*) AS tf FROM r GROUP BY ALL),
w AS (SELECT t.ID, t.term, t.tf * v.idf AS raw FROM t JOIN v ON t.term = v.term),
u AS (SELECT term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY ID)) AS weight FROM w)
SELECT term, round(sum(weight), 6) AS score FROM u GROUP BY term ORDER BY sum(weight) DESC, term LIMIT {TOP_N}""")
    def run(spark, sf):
        stop = StopWordsRemover.loadDefaultStopWords("english")
        rows = filter_class(corpus.labelled(spark, sf), label).withColumn(
            "terms", tfidf.word_array(F.col("Text"), stop))
        rows = materialize(rows.select("terms"), "words")
        return (tfidf.top_ngrams(rows, max_features=PROFILE_MAX_FEATURES, ngram_range=(lo, hi))
                .withColumn("score", F.round("score", 6)))


_top_ngrams("top_ngrams_pos", 1)
_top_ngrams("top_ngrams_neg", 0)


@query("vector_lookup", f"""
WITH t AS (SELECT ID, unnest({sql.tokens('Processed')}) AS token FROM ({sql.cleaned()}))
SELECT t.ID, t.token, array_to_string(list_transform(v.vector, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',') AS micros FROM t JOIN ({sql.VECTORS}) v ON t.token = v.token""")
def vector_lookup(spark, sf):
    """All components, in millionths, so that both sides print them alike."""
    tokens = profile.token_rows(corpus.cleaned(spark, sf), ws_tokens(F.col("Processed")), ["ID"])
    # Printed once per vector, not once per occurrence of its token.
    printed = materialize(corpus.word_vectors(spark, sf).select(
        "token", F.array_join(F.transform("vector", lambda x: F.round(
            x.cast("double") * 1000000).cast("long").cast("string")), ",").alias("micros")), "micros")
    return vectors.lookup_vectors(tokens, printed).select("ID", "token", "micros")


@query("mean_pool", f"""
WITH t AS (SELECT ID, unnest({sql.tokens('Processed')}) AS token FROM ({sql.cleaned()})),
c AS (SELECT ID, token, count(*) AS tf FROM t GROUP BY ALL),
v AS (SELECT token, unnest(range(len(vector))) AS pos, CAST(unnest(vector) AS DOUBLE) AS x FROM ({sql.VECTORS})),
m AS (SELECT c.ID, v.pos, sum(c.tf * v.x) / sum(c.tf) AS value FROM c JOIN v ON c.token = v.token GROUP BY ALL),
g AS (SELECT ID, unnest(range((SELECT max(len(embedding)) FROM embeddings))) AS pos FROM ({sql.DOCS}))
SELECT g.ID, CAST(g.pos AS INTEGER) AS pos, round(coalesce(m.value, 0.0), 6) + 0.0 AS value
FROM g LEFT JOIN m ON g.ID = m.ID AND g.pos = m.pos""")
def mean_pool(spark, sf):
    pooled = vectors.mean_pool(corpus.cleaned(spark, sf), corpus.word_vectors(spark, sf),
                               corpus.vector_dim(spark, sf))
    return pooled.select("ID", F.posexplode("pooled").alias("pos", "v")).select(
        "ID", "pos", (F.round("v", 6) + 0.0).alias("value"))


# --- token sequences ---------------------------------------------------------------------

_P = r"\p{P}$+<=>^`|~"
_WORDS = (f"regexp_extract_all(lower(regexp_replace(Processed, "
          f"{sql.q('[' + chr(92) + 'x00-' + chr(92) + 'x08' + chr(92) + 'x0b' + chr(92) + 'x0c' + chr(92) + 'x0e-' + chr(92) + 'x1f' + chr(92) + 'x7f]')}, '', 'g')), "
          f"{sql.q(f'[{_P}]|[^{sql.WS}{_P}]+')})")


def _sequences(source: str) -> str:
    """CTEs ending in ``seq``: split, ID, ids and pieces of each text."""
    return f"""
WITH RECURSIVE d AS ({sql.cleaned('contextual', sql.SPLITS)}),
t AS (SELECT split, ID, unnest(range(len({_WORDS}))) AS pos, unnest({_WORDS}) AS word FROM d),
counts AS (SELECT word AS token, count(*) AS n FROM t WHERE split = 'train' GROUP BY word),
chars AS (SELECT DISTINCT unnest(string_split(token, '')) AS token FROM counts),
body AS (SELECT token FROM chars UNION SELECT '{CONTINUATION}' || token FROM chars
         UNION (SELECT token FROM counts ORDER BY n DESC, token LIMIT {corpus.VOCAB_WORDS})),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY token) + 3 AS INTEGER) AS code FROM body
          UNION ALL SELECT '{PAD}', 0 UNION ALL SELECT '{UNK}', 1 UNION ALL SELECT '{CLS}', 2
          UNION ALL SELECT '{SEP}', 3),
w AS (SELECT DISTINCT word FROM t),
cand AS (SELECT word, s, unnest(range(1, length(word) - s + 2)) AS l
         FROM (SELECT word, unnest(range(1, length(word) + 1)) AS s FROM w WHERE length(word) <= 100)),
hit AS (SELECT c.word, c.s, max(c.l) AS l
        FROM cand c JOIN vocab v
        ON v.token = CASE WHEN c.s > 1 THEN '{CONTINUATION}' ELSE '' END || substr(c.word, c.s, c.l)
        GROUP BY c.word, c.s),
walk AS (SELECT word, s, l, 1 AS k FROM hit WHERE s = 1
         UNION ALL SELECT h.word, h.s, h.l, walk.k + 1 FROM walk JOIN hit h ON h.word = walk.word AND h.s = walk.s + walk.l),
done AS (SELECT word FROM walk GROUP BY word HAVING max(s + l) = length(word) + 1),
piece AS (SELECT k.word, k.k, v.token, v.code FROM walk k JOIN done USING (word)
          JOIN vocab v ON v.token = CASE WHEN k.s > 1 THEN '{CONTINUATION}' ELSE '' END || substr(k.word, k.s, k.l)
          UNION ALL SELECT word, 1, '{UNK}', 1 FROM w WHERE word NOT IN (SELECT word FROM done)),
parts AS (SELECT t.split, t.ID, t.pos, p.k, p.token, p.code FROM t JOIN piece p ON t.word = p.word),
lists AS (SELECT split, ID, list_sort(list(struct_pack(pos := pos, k := k, token := token, code := code))) AS l
          FROM parts GROUP BY split, ID),
seq AS (SELECT d.split, d.ID, coalesce(list_transform(l, lambda x: x.code), []) AS ids,
               coalesce(array_to_string(list_transform(l, lambda x: x.token), ' '), '') AS pieces
        FROM d LEFT JOIN lists ON d.split = lists.split AND d.ID = lists.ID)
{source}"""


def _segmented(spark, sf):
    texts = clean(corpus.splits(spark, sf), "contextual")
    vocab = corpus.subword_vocab(spark, sf)
    return subword.subword_tokens(texts, vocab, keys=("split", "ID")), vocab


@query("subword_tokens", _sequences("SELECT split, ID, pieces, array_to_string(ids, ',') AS ids FROM seq"))
def subword_tokens(spark, sf):
    segmented, _ = _segmented(spark, sf)
    return segmented.select("split", "ID", "pieces", F.array_join("ids", ",").alias("ids"))


@query("encode_sequences", _sequences(f"""
SELECT split, ID, array_to_string(list_concat(list_concat([2], ids[1:{MAX_LEN - 2}]),
         list_concat([3], list_transform(range({MAX_LEN} - least(len(ids) + 2, {MAX_LEN})), lambda i: 0))), ',') AS input_ids,
       repeat('1', least(len(ids) + 2, {MAX_LEN})) || repeat('0', {MAX_LEN} - least(len(ids) + 2, {MAX_LEN})) AS attention_mask
FROM seq"""))
def encode_sequences(spark, sf):
    segmented, vocab = _segmented(spark, sf)
    encoded = subword.encode_sequences(segmented, vocab, keys=("split", "ID"))
    return encoded.select("split", "ID", F.array_join("input_ids", ",").alias("input_ids"),
                          F.array_join("attention_mask", "").alias("attention_mask"))


def _lengths(spark, sf):
    segmented, _ = _segmented(spark, sf)
    return subword.sequence_lengths(segmented, ("split", "ID"))


@query("sequence_length", _sequences("SELECT split, ID, CAST(len(ids) + 2 AS INTEGER) AS length FROM seq"))
def sequence_length(spark, sf):
    return _lengths(spark, sf)


@query("max_seqlen", _sequences("SELECT CAST(max(len(ids)) + 2 AS INTEGER) AS max_length FROM seq"))
def max_seqlen(spark, sf):
    return subword.max_sequence_length(_lengths(spark, sf))


@query("seqlen_hist", _sequences(f"""
, x AS (SELECT split, len(ids) + 2 AS length FROM seq WHERE split <> 'test'),
s AS (SELECT split, min(length) AS lo, max(length) AS hi FROM x GROUP BY split),
b AS (SELECT x.split, least((length - lo) * {HIST_BINS} // (hi - lo), {HIST_BINS - 1}) AS bin, count(*) AS n
      FROM x JOIN s USING (split) GROUP BY ALL),
g AS (SELECT *, unnest(range({HIST_BINS})) AS bin FROM s)
SELECT g.split, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / {HIST_BINS}.0::DOUBLE), 6) AS bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / {HIST_BINS}.0::DOUBLE), 6) AS bin_end, CAST(coalesce(b.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN b ON g.split = b.split AND g.bin = b.bin"""))
def seqlen_hist(spark, sf):
    """One histogram for the training and one for the validation texts, each over its own range."""
    lengths = _lengths(spark, sf).filter(F.col("split") != "test")
    return profile.length_histogram(lengths, by="split", common_range=False).select(
        "split", "bin", F.round("bin_start", 6).alias("bin_start"),
        F.round("bin_end", 6).alias("bin_end"), "n")


@query("seqlen_limit", _sequences(f"""
SELECT split, count(*) AS n_rows, CAST(max(len(ids)) + 2 AS INTEGER) AS max_length,
       round(avg(CAST(len(ids) + 2 > {MAX_LEN} AS INTEGER)), 6) AS share_over FROM seq GROUP BY split"""))
def seqlen_limit(spark, sf):
    return profile.limit_share(_lengths(spark, sf), MAX_LEN).withColumn(
        "share_over", F.round("share_over", 6))
