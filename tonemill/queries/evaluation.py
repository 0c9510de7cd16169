"""Metrics of scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonemill.constants import BATCH_SIZE
from tonemill.operators import metrics
from tonemill.queries import corpus, sql
from tonemill.queries.registry import query


def _rounded(df, *keep):
    return df.select(*[F.col(c) if c in keep else F.round(c, 6).alias(c) for c in df.columns])


def _metrics_sql(source: str, by: str) -> str:
    return f"""
WITH c AS (SELECT {by + ',' if by else ''} count(*) AS n, sum(CAST(label = prediction AS INTEGER)) AS hits,
  sum(CAST(label = 1 AND prediction = 1 AS INTEGER)) AS tp, sum(prediction) AS said, sum(label) AS pos
  FROM ({source}) {'GROUP BY ' + by if by else ''}),
m AS (SELECT *, hits / n AS accuracy, CASE WHEN said = 0 THEN 0.0 ELSE tp / said END AS precision,
  CASE WHEN pos = 0 THEN 0.0 ELSE tp / pos END AS recall FROM c)
SELECT {by + ',' if by else ''} n, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1 FROM m"""


@query("binary_metrics", _metrics_sql(sql.SCORED, ""))
def binary_metrics(spark, sf):
    return _rounded(metrics.binary_metrics(corpus.scored(spark, sf)), "n")


@query("compare_models", f"SELECT *, rank() OVER (ORDER BY accuracy DESC) AS rank FROM ({_metrics_sql(sql.MODELS, 'model')})")
def compare_models(spark, sf):
    out = metrics.compare_models(corpus.scored_models(spark, sf))
    return _rounded(out, "model", "n", "rank").withColumn("rank", F.col("rank").cast("long"))


@query("confusion_matrix", f"""
SELECT t.c AS label, p.c AS prediction, count(s.ID) AS n
FROM (VALUES (0), (1)) t(c) CROSS JOIN (VALUES (0), (1)) p(c)
LEFT JOIN ({sql.SCORED}) s ON s.label = t.c AND s.prediction = p.c GROUP BY ALL""")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(corpus.scored(spark, sf))


@query("classification_report", f"""
WITH s AS ({sql.SCORED}),
c AS (SELECT k.c, sum(CAST(label = k.c AND prediction = k.c AS INTEGER)) AS tp,
             sum(CAST(prediction = k.c AS INTEGER)) AS said, sum(CAST(label = k.c AS INTEGER)) AS support
      FROM s, (VALUES (0), (1)) k(c) GROUP BY k.c),
r AS (SELECT c, support, CASE WHEN said = 0 THEN 0.0 ELSE tp / said END AS p,
             CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM c),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM r),
a AS (SELECT avg(CAST(label = prediction AS INTEGER)) AS acc, count(*) AS n FROM s),
u AS (SELECT CAST(c AS VARCHAR) AS class, p, r, f1, support FROM f
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM a
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM u""")
def classification_report(spark, sf):
    return _rounded(metrics.classification_report(corpus.scored(spark, sf)), "class", "support")


@query("performance_gap", f"""
WITH a AS (SELECT avg(CASE WHEN split = 'train' THEN CAST(label = prediction AS INTEGER) END) AS t,
                  avg(CASE WHEN split = 'val' THEN CAST(label = prediction AS INTEGER) END) AS v FROM ({sql.SCORED}))
SELECT round(t, 6) AS train_accuracy, round(v, 6) AS val_accuracy, round(t - v, 6) AS gap FROM a""")
def performance_gap(spark, sf):
    return _rounded(metrics.performance_gap(corpus.scored(spark, sf)))


_STEPS = f"""
WITH g AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM ({sql.MODELS}) GROUP BY model, score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p,
             sum(neg) OVER (PARTITION BY model) AS n, lead(pos) OVER w AS pos2, lead(neg) OVER w AS neg2,
             row_number() OVER w AS rn
      FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


@query("roc_points", f"""{_STEPS}
SELECT model, round(score, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c
WHERE rn = 1 OR pos2 IS NULL OR pos2 <> pos OR neg2 <> neg
UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM g""")
def roc_points(spark, sf):
    return _rounded(metrics.roc_points(corpus.scored_models(spark, sf)), "model")


# Pairs of a positive and a negative row: won counts 1, tied 1/2.
@query("roc_auc", f"""
WITH s AS ({sql.MODELS})
SELECT a.model, round(avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END), 6) AS auc
FROM s a JOIN s b ON a.model = b.model AND a.label = 1 AND b.label = 0 GROUP BY a.model""")
def roc_auc(spark, sf):
    return _rounded(metrics.roc_auc(corpus.scored_models(spark, sf)), "model")


@query("batch_accuracy", f"""
WITH b AS (SELECT (row_number() OVER (ORDER BY ID) - 1) // {BATCH_SIZE} AS batch, CAST(label = prediction AS INTEGER) AS hit
           FROM ({sql.SCORED})),
a AS (SELECT batch, avg(hit) AS acc FROM b GROUP BY batch)
SELECT count(*) AS n_batches, round(avg(acc), 6) AS batch_accuracy FROM a""")
def batch_accuracy(spark, sf):
    return _rounded(metrics.batch_accuracy(corpus.scored(spark, sf)), "n_batches")


_LOSS = "CASE WHEN label = 1 THEN ln(1.0 + exp(-logit)) ELSE ln(1.0 + exp(logit)) END"


@query("log_loss", f"SELECT round(avg({_LOSS}), 6) AS log_loss FROM ({sql.SCORED})")
def log_loss(spark, sf):
    return _rounded(metrics.log_loss(corpus.scored(spark, sf)))


@query("batch_log_loss", f"""
WITH b AS (SELECT (row_number() OVER (ORDER BY ID) - 1) // {BATCH_SIZE} AS batch, {_LOSS} AS loss FROM ({sql.SCORED})),
a AS (SELECT batch, avg(loss) AS loss FROM b GROUP BY batch)
SELECT round(avg(loss), 6) AS batch_log_loss FROM a""")
def batch_log_loss(spark, sf):
    return _rounded(metrics.batch_log_loss(corpus.scored(spark, sf)))
