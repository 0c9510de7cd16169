"""Language identification in two steps: the family first, then the language within it.

Both steps vote among linear support vector machines, one for each pair of families and one for
each pair of languages of a family. Features are byte 1- to 4-grams of the lower-cased text,
hashed to ``DIMENSIONS``, as square roots of their shares (so every text has length one). Each
machine is fitted in a task of its own, on a bounded sample of labelled texts; prediction is one
pass over all whole texts without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; null labels and
IDs are not learnt from; with no labelled text at all every text is ``und``, with one language
every text with a letter is that language; equal rows are predicted alike, and rows may share
an ID; of more than ``languages`` labels those with most texts are learnt; other columns are kept
as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonemill.llm import buffers
from tonemill.llm.names import unused

UNDETERMINED = "und"
DIMENSIONS = 4096
#: The bound of the training sample: about so many labelled texts of each language.
SAMPLE = 600
#: The bound of the labels that are learnt, and so of the machines: one for each pair at most.
LANGUAGES = 64
# Families of ISO 639-1 codes; a language of no listed family is its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "hr", "bs", "mk", "sl", "pl", "cs", "sk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "celtic": ("ga", "gd", "cy", "br"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ne", "ur", "sa"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("ar", "he", "am", "mt"),
    "sinitic": ("zh",),
    "malayic": ("id", "ms", "jv", "tl"),
}
_family_of = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _family_of.get(lang, f"={lang}")


def features(column: pa.Array) -> np.ndarray:
    """One row of square-rooted n-gram shares per text."""
    data, offsets = buffers.utf8(pc.utf8_lower(column.fill_null("")))
    n = len(offsets) - 1
    counts = np.zeros(n * DIMENSIONS, np.int64)
    rows = np.repeat(np.arange(n, dtype=np.int64) * DIMENSIONS, np.diff(offsets))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    code = np.zeros(len(data), np.uint32)
    for width in range(1, 5):
        if len(data) < width:
            break
        code = code[: len(data) - width + 1] << np.uint32(8) | data[width - 1:]
        fits = room[: len(code)] >= width
        slot = (code[fits] * np.uint32(0x9E3779B1) + np.uint32(width * 0x85EBCA6B & 0xFFFFFFFF)
                ) * np.uint32(0xC2B2AE35) >> np.uint32(20)
        counts += np.bincount(rows[: len(code)][fits] + slot, minlength=n * DIMENSIONS)
    x = np.sqrt(counts.reshape(n, DIMENSIONS).astype(np.float32))
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Weights and, last, the bias of a squared-hinge machine, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    ridge = 1 / (2 * cost)
    square = (x * x).sum(axis=1) + ridge
    order = np.random.default_rng(5)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            slope = y[i] * (x[i] @ w) - 1 + ridge * alpha[i]
            new = max(0.0, alpha[i] - slope / square[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32)


def _batches(column: pa.Array, rows: int = 256) -> Iterator[tuple[int, int]]:
    for a, b in buffers.slices(column):
        for c in range(a, b, rows):
            yield c, min(b, c + rows)


@dataclass(frozen=True)
class Model:
    """Languages by family, and the weights of each pair ``(first, second)``."""

    families: dict[str, tuple[str, ...]]
    pairs: dict[tuple[str, str], np.ndarray]

    def vote(self, x: np.ndarray, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner among ``names`` and its weakest pairwise probability."""
        k = len(names)
        wins, margins = np.zeros((len(x), k)), np.zeros((len(x), k))
        least = np.ones((len(x), k))
        for i in range(k):
            for j in range(i + 1, k):
                w = self.pairs.get((names[i], names[j]))
                if w is None:
                    continue
                margin = x @ w[:-1] + w[-1]
                sure = 1 / (1 + np.exp(-4.0 * np.clip(margin, -50, 50)))
                wins[:, i] += margin > 0
                wins[:, j] += margin <= 0
                margins[:, i] += margin
                margins[:, j] -= margin
                least[:, i] = np.minimum(least[:, i], sure)
                least[:, j] = np.minimum(least[:, j], 1 - sure)
        best = (wins + 1e-3 * np.tanh(margins)).argmax(axis=1)
        return best, least[np.arange(len(x)), best]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        groups = tuple(sorted(self.families))
        family, score = self.vote(x, groups)
        langs = np.empty(len(x), object)
        for i, group in enumerate(groups):
            own = np.flatnonzero(family == i)
            if len(own):
                names = self.families[group]
                best, sure = self.vote(x[own], names)
                langs[own] = np.array(names, object)[best]
                score[own] = score[own] * sure
        return langs.tolist(), score


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """Fit on about ``sample`` texts of each language, picked by a hash of the row's number.

    The driver gets one row per language, then one row of weights per pair.
    """
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"),
                           F.col(key).alias("key")).filter(
        "text IS NOT NULL AND lang IS NOT NULL AND key IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "lang").limit(languages).collect()}
    families: dict[str, list[str]] = {}
    for name in sorted(counts):
        families.setdefault(family_of(name), []).append(name)
    groups = sorted(families)
    jobs = [(a, b) for i, a in enumerate(groups) for b in groups[i + 1:]]
    jobs += [(a, b) for own in families.values() for i, a in enumerate(own) for b in own[i + 1:]]
    spark = labelled.sparkSession
    done = {f: tuple(names) for f, names in families.items()}
    if not jobs:
        return Model(done, {})
    share = F.coalesce(*[F.when(F.col("lang") == c, sample / n) for c, n in counts.items()])
    # Numbers differ for rows that share an ID or are equal, so no share is all or nothing.
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    spot = F.pmod(F.xxhash64(F.lit(29), "number"), F.lit(1 << 30)) / float(1 << 30)
    roles = spark.createDataFrame(
        [(name, f"{a}|{b}", a, b, sign) for a, b in jobs for sign, side in ((1.0, a), (-1.0, b))
         for name in (families.get(side) or [side])],
        "lang string, job string, first string, second string, sign double")
    picked = numbered.filter(spot < share).join(F.broadcast(roles), "lang")

    def train(table: pa.Table) -> pa.Table:
        column = table.column("text").combine_chunks()
        x = np.vstack([features(column.slice(a, b - a)) for a, b in _batches(column)])
        w = fit_svm(x, table.column("sign").to_numpy())
        return pa.table({"first": table.column("first").slice(0, 1),
                         "second": table.column("second").slice(0, 1),
                         "weights": pa.array([w.tobytes()], pa.binary())})

    fitted = picked.groupBy("job").applyInArrow(
        train, "first string, second string, weights binary").collect()
    return Model(done, {(r["first"], r["second"]): np.frombuffer(bytes(r["weights"]), np.float32)
                        for r in fitted})


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only ``text`` is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    letter = unused(names, "letter")
    docs = docs.select(*[f"`{c}`" for c in names], has_letter(F.col(f"`{text}`")).alias(letter))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for a, b in _batches(batch.column(at)):
                part = batch.slice(a, b - a)
                letter = part.column(len(names)).to_numpy(zero_copy_only=False)
                langs, score = [UNDETERMINED] * len(part), np.zeros(len(part))
                if model.families:
                    langs, score = model.predict(features(part.column(at)))
                    langs = [x if y else UNDETERMINED for x, y in zip(langs, letter)]
                    score = np.where(letter, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(langs, pa.string()), pa.array(score)],
                    [*names, "lang_pred", "score"])

    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def held_out(key: Column) -> Column:
    """A quarter of the IDs, never learnt from; false for a null ID."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
