"""SQL fragments for the checks, written independently of the Spark expressions."""

from __future__ import annotations

import os
import zipfile
from functools import lru_cache
from pathlib import Path

import pyspark
from pyspark.ml.feature import StopWordsRemover

from tonemill.constants import PUNCTUATION, SPELLING, STOP_WORDS

WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
W = r"\p{L}\p{N}_"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(replacement)}, 'g')"


def lower(x: str) -> str:
    return f"lower({x})"


def mentions(x: str) -> str:
    return sub(x, f"@[^{WS}]+", "X")


def urls(x: str) -> str:
    return sub(x, f"http[^{WS}]+", "http")


def hashtags(x: str) -> str:
    return sub(x, f"#[^{WS}]+", "X")


def punct(x: str) -> str:
    return f"translate({x}, {q(PUNCTUATION)}, {q(' ' * len(PUNCTUATION))})"


def apostrophes(x: str) -> str:
    return sub(x, f"([{W}]+)'([{W}]+)", r"\1\2")


def non_ascii(x: str) -> str:
    return sub(x, r"[^\x00-\x7F]+", "")


def repeats(x: str) -> str:
    """Without back-references: one replacement per character that cleaned text can hold."""
    for c in "abcdefghijklmnopqrstuvwxyz0123456789X'":
        x = sub(x, c + "{3,}", c)
    return x


def spaces(x: str) -> str:
    return f"trim({sub(x, f'[{WS}]+', ' ')})"


def spelling(x: str) -> str:
    for k, v in SPELLING.items():
        x = sub(x, rf"\b{k}\b", v)
    return x


STEPS = {
    "frequency": [lower, mentions, urls, punct, apostrophes, non_ascii, repeats, spaces, spelling],
    "embedding": [lower, mentions, urls, hashtags, punct, apostrophes, non_ascii, repeats, spaces,
                  spelling],
    "contextual": [lower, mentions, urls, non_ascii, spelling],
}


def clean(x: str, profile: str) -> str:
    for step in STEPS[profile]:
        x = step(x)
    return x


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(f'[^{WS}]+')})"


def words2(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(f'[{W}]{{2,}}')})"


def word_list(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


@lru_cache(maxsize=1)
def english_stop_words() -> list[str]:
    """The English list of Spark's MLlib, read from its jar, which needs no session."""
    jars = Path(os.environ.get("SPARK_HOME") or Path(pyspark.__file__).parent) / "jars"
    for jar in jars.glob("spark-mllib_*.jar"):
        with zipfile.ZipFile(jar) as z:
            return z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().splitlines()
    return StopWordsRemover.loadDefaultStopWords("english")


DOCS = "SELECT doc_id AS ID, text AS Text FROM documents"
CONV = "SELECT conv_id * 1000000 + turn AS ID, text AS Text FROM conversations"
BENCH = "SELECT item_id AS ID, text AS Text FROM benchmark"
SPLITS = (f"SELECT 'train' AS split, * FROM ({DOCS}) UNION ALL SELECT 'val', * FROM ({CONV}) "
          f"UNION ALL SELECT 'test', * FROM ({BENCH})")
LABELLED = ("SELECT d.doc_id AS ID, d.text AS Text, l.quality AS Label "
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
_DIGIT = "substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 1)"
SPLIT_OF = f"CASE WHEN {_DIGIT} < 'c' THEN 'train' WHEN {_DIGIT} < 'e' THEN 'val' ELSE 'test' END"
SCORED = ("SELECT 'length' AS model, " + SPLIT_OF + " AS split, d.doc_id AS ID, l.quality AS label, "
          "CAST(d.n_chars > 1500 AS INTEGER) AS prediction, d.n_chars / (d.n_chars + 1500.0::DOUBLE) AS score, "
          "(d.n_chars - 1500) / 1000.0::DOUBLE AS logit "
          "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
MODELS = ("SELECT m.model, x.ID, x.label, m.prediction, m.score FROM ("
          "SELECT d.doc_id AS ID, l.quality AS label, l.toxic, d.n_chars AS n "
          "FROM documents d JOIN labels l ON d.doc_id = l.doc_id) x, LATERAL ("
          "SELECT 'long' AS model, CAST(n > 1500 AS INTEGER) AS prediction, n / (n + 1500.0::DOUBLE) AS score "
          "UNION ALL SELECT 'short', CAST(n < 1500 AS INTEGER), 1500.0::DOUBLE / (n + 1500.0::DOUBLE) "
          "UNION ALL SELECT 'mild', 1 - toxic, 1.0::DOUBLE - toxic) m")


def cleaned(profile: str = "embedding", source: str = DOCS) -> str:
    return f"SELECT *, {clean('Text', profile)} AS Processed FROM ({source})"


def token_counts(profile: str = "embedding") -> str:
    return (f"SELECT token, count(*) AS n FROM (SELECT unnest({tokens('Processed')}) AS token "
            f"FROM ({cleaned(profile)})) GROUP BY token")


RANKED = (f"SELECT token, n, row_number() OVER (ORDER BY n DESC, token) - 1 AS rank "
          f"FROM ({token_counts()})")
VECTORS = (f"SELECT r.token, e.embedding AS vector FROM ({RANKED}) r "
           f"JOIN embeddings e ON e.vec_id = r.rank")


def ngrams(words: str, hi: int) -> str:
    """List of all 1- to ``hi``-grams of a list column."""
    parts = [words]
    for n in range(2, hi + 1):
        joined = " || ' ' || ".join(f"{words}[i + {k}]" if k else f"{words}[i]" for k in range(n))
        parts.append(f"list_transform(range(1, greatest(len({words}) - {n - 2}, 1)), lambda i: {joined})")
    return "list_concat(" + ", ".join(parts) + ")" if len(parts) == 2 else (
        f"list_concat(list_concat({parts[0]}, {parts[1]}), {parts[2]})")


def term_rows(source: str, text: str, stop: list[str], hi: int, keys: str = "ID") -> str:
    """``keys, term`` per occurrence."""
    kept = f"list_filter({words2(text)}, lambda w: w NOT IN {word_list(stop)})"
    return (f"SELECT {keys}, unnest({ngrams('ws', hi)}) AS term FROM "
            f"(SELECT {keys}, {kept} AS ws FROM ({source}))")


def vocabulary(rows: str, min_df: int, max_features: int) -> str:
    return (f"SELECT term, count(*) AS tf, count(DISTINCT ID) AS df FROM ({rows}) GROUP BY term "
            f"HAVING count(DISTINCT ID) >= {min_df} ORDER BY tf DESC, term LIMIT {max_features}")


FREQUENCY_TERMS = term_rows(cleaned("frequency"), "Processed", STOP_WORDS, 3)
