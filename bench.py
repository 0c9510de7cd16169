"""Seconds per headline query; prints one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated names (default: the list below)

Each result is computed whole and dropped (the ``noop`` sink). Word vectors and the subword
vocabulary are input tables: they are written before the clock starts. So are the text tables,
with the same rows in one file per core: as given they are one row group, which is one task.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from tonemill.queries import QUERIES, corpus
from tonemill.session import local_session

HEADLINE = [
    "clean_frequency", "clean_embedding", "clean_contextual", "text_stats", "token_counts",
    "vocab_size", "top_tokens", "tfidf_vocab", "tfidf_weights", "top_ngrams_pos",
    "top_ngrams_neg", "mean_pool", "oov_rate", "subword_tokens", "encode_sequences",
    "length_kde", "stratified_folds", "running_best", "binary_metrics", "roc_auc", "lr_fit",
]


def laid_out(spark, sf: str, files: int) -> str:
    """A folder with the same tables, the texts in ``files`` files each."""
    folder = Path(tempfile.mkdtemp(prefix="bench-"))
    for path in Path(sf).glob("*.parquet"):
        if path.stem in ("documents", "conversations"):
            spark.read.parquet(str(path)).repartition(files).write.parquet(str(folder / path.name))
        else:
            (folder / path.name).symlink_to(path)
    return str(folder)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session("bench", cpus, cpus)
    n_bytes = Path(f"{sf}/documents.parquet").stat().st_size
    name, sf = Path(sf).name.removeprefix("sf"), laid_out(spark, sf, cpus)
    n_docs = corpus.table(spark, sf, "documents").count()
    corpus.word_vectors(spark, sf)
    corpus.subword_vocab(spark, sf)
    seconds = {}
    for query in names:
        start = time.perf_counter()
        QUERIES[query](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[query] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": name, "cpus": cpus,
        "documents": n_docs, "file_bytes": n_bytes,
        "documents_per_second": {k: round(n_docs / s) for k, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
