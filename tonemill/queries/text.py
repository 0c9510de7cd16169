"""Sources, row operators, cleaning, tokens."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tonemill.constants import NA_TOKENS, STOP_WORDS
from tonemill.functions import cleaning, scores, tokens
from tonemill.operators import profile, rows
from tonemill.plans.materialize import new_path
from tonemill.queries import corpus, sql
from tonemill.queries.registry import query
from tonemill.sources import tables


# --- sources and sinks -------------------------------------------------------------------

@query("scan_labelled", f"SELECT ID, Text, Label FROM ({sql.LABELLED})")
def scan_labelled(spark, sf):
    path = new_path(spark, "labelled")
    tables.write_text_csv(corpus.labelled(spark, sf).select("ID", "Text", "Label"), path)
    return tables.read_labelled_csv(spark, path)


@query("scan_unlabelled", sql.DOCS)
def scan_unlabelled(spark, sf):
    path = new_path(spark, "unlabelled")
    tables.write_text_csv(corpus.documents(spark, sf), path)
    return tables.read_unlabelled_csv(spark, path)


@query("na_tokens", f"""
SELECT doc_id AS ID, CAST(lang IN {sql.word_list([*NA_TOKENS, 'fr'])} AS INTEGER) AS missing,
       CASE WHEN lang IN {sql.word_list([*NA_TOKENS, 'fr'])} THEN '-' ELSE lang END AS lang
FROM documents""")
def na_tokens(spark, sf):
    df = corpus.table(spark, sf, "documents").select(F.col("doc_id").alias("ID"), "lang")
    out = tables.null_tokens(df, "lang", [*NA_TOKENS, "fr"])
    return out.select("ID", F.col("lang").isNull().cast("int").alias("missing"),
                      F.coalesce("lang", F.lit("-")).alias("lang"))


@query("word_vectors", f"""
SELECT token, unnest(range(len(vector))) AS pos, round(CAST(unnest(vector) AS DOUBLE), 6) + 0.0 AS value
FROM ({sql.VECTORS})""")
def word_vectors(spark, sf):
    return corpus.word_vectors(spark, sf).select(
        "token", F.posexplode("vector").alias("pos", "v")).select(
        "token", F.col("pos").cast("long").alias("pos"),
        (F.round(F.col("v").cast("double"), 6) + 0.0).alias("value"))


@query("submission", f"SELECT ID, prediction AS Label FROM ({sql.SCORED})")
def submission(spark, sf):
    path = new_path(spark, "submission")
    tables.write_predictions(
        corpus.scored(spark, sf).select("ID", F.col("prediction").alias("Label")), path)
    return tables.read_predictions(spark, path)


# --- rows --------------------------------------------------------------------------------

def _maybe_labelled(spark, sf):
    return corpus.documents(spark, sf).join(corpus.labels(spark, sf), "ID", "left")


@query("drop_missing", f"SELECT ID, Text, Label FROM ({sql.LABELLED}) "
                       "WHERE Text IS NOT NULL AND Label IS NOT NULL")
def drop_missing(spark, sf):
    return rows.drop_missing(_maybe_labelled(spark, sf), ["Text", "Label"])


@query("null_literal", """
SELECT d.doc_id AS ID, coalesce(CAST(l.quality AS VARCHAR), 'nan') AS Label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_literal(spark, sf):
    return rows.null_to_literal(_maybe_labelled(spark, sf).select("ID", "Label"), "Label")


@query("filter_class", f"SELECT ID, Text, Label FROM ({sql.LABELLED}) WHERE Label = 1")
def filter_class(spark, sf):
    return rows.filter_class(corpus.labelled(spark, sf), 1)


@query("feature_label", f"SELECT ID, Text AS feature, CAST(Label AS DOUBLE) AS label FROM ({sql.LABELLED})")
def feature_label(spark, sf):
    return rows.feature_label(corpus.labelled(spark, sf))


@query("char_length", f"SELECT ID, CAST(length(Text) AS INTEGER) AS n_chars FROM ({sql.DOCS})")
def char_length(spark, sf):
    return corpus.documents(spark, sf).select("ID", tokens.char_length(F.col("Text")).alias("n_chars"))


@query("word_count", f"SELECT ID, CAST(len({sql.tokens('Text')}) AS INTEGER) AS n_words FROM ({sql.DOCS})")
def word_count(spark, sf):
    return corpus.documents(spark, sf).select("ID", tokens.word_count(F.col("Text")).alias("n_words"))


@query("threshold_logit", f"""
SELECT ID, logit, CAST(1.0 / (1.0 + exp(-logit)) > 0.5 AS INTEGER) AS prediction FROM ({sql.SCORED})""")
def threshold_logit(spark, sf):
    return corpus.scored(spark, sf).select(
        "ID", "logit", scores.threshold_logit(F.col("logit")).alias("prediction"))


@query("softmax_score", f"""
SELECT ID, round(exp(logit / 2) / (exp(logit / 2) + exp(-logit / 2)), 6) AS score FROM ({sql.SCORED})""")
def softmax_score(spark, sf):
    logits = F.array(-F.col("logit") / 2, F.col("logit") / 2)
    return corpus.scored(spark, sf).select("ID", F.round(scores.softmax_score(logits), 6).alias("score"))


@query("argmax_class", f"""
SELECT ID, CASE WHEN logit > 0.0 AND logit >= 1.0 - logit THEN 1
                WHEN 1.0 - logit > 0.0 AND 1.0 - logit > logit THEN 2 ELSE 0 END AS prediction
FROM ({sql.SCORED})""")
def argmax_class(spark, sf):
    logits = F.array(F.lit(0.0), F.col("logit"), 1.0 - F.col("logit"))
    return corpus.scored(spark, sf).select("ID", scores.argmax_class(logits).alias("prediction"))


# --- cleaning steps ----------------------------------------------------------------------

def _step(name: str, column, expression: str):
    @query(name, f"SELECT ID, {expression} AS Text FROM ({sql.DOCS})")
    def run(spark, sf):
        return corpus.documents(spark, sf).select("ID", column(F.col("Text")).alias("Text"))


_step("lowercase", cleaning.lowercase, sql.lower("Text"))
_step("mask_mentions", cleaning.mask_mentions, sql.mentions("Text"))
_step("mask_hashtags", cleaning.mask_hashtags, sql.hashtags("Text"))
_step("strip_punct", cleaning.strip_punct, sql.punct("Text"))
_step("strip_non_ascii", cleaning.strip_non_ascii, sql.non_ascii("Text"))
_step("collapse_spaces", cleaning.collapse_spaces, sql.spaces("Text"))
_step("fix_spelling", lambda c: cleaning.fix_spelling(cleaning.strip_non_ascii(cleaning.lowercase(c))),
      sql.spelling(sql.non_ascii(sql.lower("Text"))))


# Web pages hold the links and apostrophes that the prose lacks.
@query("mask_urls", f"SELECT page_id AS ID, {sql.urls('url')} AS url, {sql.urls('html')} AS Text FROM pages")
def mask_urls(spark, sf):
    return corpus.table(spark, sf, "pages").select(
        F.col("page_id").alias("ID"), cleaning.mask_urls(F.col("url")).alias("url"),
        cleaning.mask_urls(F.col("html")).alias("Text"))


@query("join_apostrophes", f"""
SELECT page_id AS ID, {sql.apostrophes("replace(html, '\"', '''')")} AS Text FROM pages
UNION ALL SELECT doc_id, {sql.apostrophes("replace(replace(text, ',', ''''), ' ''', '''')")} FROM documents""")
def join_apostrophes(spark, sf):
    pages = corpus.table(spark, sf, "pages").select(
        F.col("page_id").alias("ID"), F.translate("html", '"', "'").alias("Text"))
    docs = corpus.documents(spark, sf).select(
        "ID", F.replace(F.translate("Text", ",", "'"), F.lit(" '"), F.lit("'")).alias("Text"))
    return pages.unionAll(docs).select("ID", cleaning.join_apostrophes(F.col("Text")).alias("Text"))


# Run lengths by window functions: the check needs no back-references.
@query("collapse_repeats", f"""
WITH chars AS (
  SELECT ID, unnest(range(1, length(Text) + 1)) AS pos, unnest(string_split(Text, '')) AS c FROM ({sql.DOCS})),
steps AS (
  SELECT *, CAST(c IS DISTINCT FROM lag(c) OVER (PARTITION BY ID ORDER BY pos) AS INTEGER) AS new FROM chars),
runs AS (SELECT *, sum(new) OVER (PARTITION BY ID ORDER BY pos) AS run FROM steps),
sizes AS (SELECT ID, run, any_value(c) AS c, count(*) AS n FROM runs GROUP BY ID, run)
SELECT ID, string_agg(CASE WHEN n >= 3 AND c <> chr(10) THEN c ELSE repeat(c, n) END, '' ORDER BY run) AS Text
FROM sizes GROUP BY ID""")
def collapse_repeats(spark, sf):
    return corpus.documents(spark, sf).select(
        "ID", cleaning.collapse_repeats(F.col("Text")).alias("Text"))


def _profile(profile_name: str):
    @query(f"clean_{profile_name}",
           f"SELECT split, ID, {sql.clean('Text', profile_name)} AS Processed FROM ({sql.SPLITS})")
    def run(spark, sf):
        return rows.clean(corpus.splits(spark, sf), profile_name).select("split", "ID", "Processed")


for _name in ("frequency", "embedding", "contextual"):
    _profile(_name)


# --- tokens ------------------------------------------------------------------------------

@query("ws_tokens", f"SELECT ID, array_to_string({sql.tokens('Processed')}, '|') AS tokens "
                    f"FROM ({sql.cleaned()})")
def ws_tokens(spark, sf):
    return corpus.cleaned(spark, sf).select(
        "ID", F.array_join(tokens.ws_tokens(F.col("Processed")), "|").alias("tokens"))


@query("token_rows", f"SELECT ID, unnest({sql.tokens('Processed')}) AS token FROM ({sql.cleaned()})")
def token_rows(spark, sf):
    return profile.token_rows(corpus.cleaned(spark, sf), tokens.ws_tokens(F.col("Processed")), ["ID"])


@query("word_tokens", f"SELECT ID, array_to_string({sql.words2('Text')}, '|') AS tokens FROM ({sql.DOCS})")
def word_tokens(spark, sf):
    return corpus.documents(spark, sf).select(
        "ID", F.array_join(tokens.word_tokens(F.col("Text")), "|").alias("tokens"))


@query("stop_words", f"""
SELECT ID, array_to_string(list_filter(w, lambda x: x NOT IN {sql.word_list(STOP_WORDS)}), '|') AS custom,
       array_to_string(list_filter(w, lambda x: x NOT IN {sql.word_list(sql.english_stop_words())}), '|') AS english
FROM (SELECT ID, {sql.words2('Text')} AS w FROM ({sql.DOCS}))""")
def stop_words(spark, sf):
    english = StopWordsRemover.loadDefaultStopWords("english")
    words = corpus.documents(spark, sf).select("ID", tokens.word_tokens(F.col("Text")).alias("w"))
    return words.select(
        "ID", F.array_join(tokens.remove_stop_words(F.col("w"), STOP_WORDS), "|").alias("custom"),
        F.array_join(tokens.remove_stop_words(F.col("w"), english), "|").alias("english"))


def _ngrams(hi: int):
    rows_sql = sql.term_rows(sql.cleaned("frequency"), "Processed", STOP_WORDS, hi)

    @query(f"ngrams_1_{hi}", f"SELECT ID, term, count(*) AS tf FROM ({rows_sql}) GROUP BY ID, term")
    def run(spark, sf):
        words = tokens.remove_stop_words(tokens.word_tokens(F.col("Processed")), STOP_WORDS)
        return corpus.cleaned(spark, sf, "frequency").select(
            "ID", F.inline(tokens.value_counts(tokens.ngrams(words, 1, hi))))


_ngrams(2)
_ngrams(3)
