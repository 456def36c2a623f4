"""Language of documents: sparse multinomial logistic regression on TF-IDF weights of character n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrain.llm.text import mixed, pieces
from daygrain.session import written

FEATURES = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE = 6_000  # labelled texts that fit the classifier
UNKNOWN = "und"

_LETTER = np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)], bool)
_SPACE = 32
_SALT = mixed(np.arange(101, 101 + max(ORDERS), dtype=np.uint64)) | np.uint64(1)


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, with one space for each run of anything else, and at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = _LETTER[codes]
    codes = np.where(keep, codes, _SPACE)
    run = np.ones(len(codes), bool)
    run[1:] = keep[1:] | keep[:-1]
    return codes[run]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of the character n-grams of a whole text; none without letters."""
    codes = letters(text or "")
    if len(codes) < 2:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    wide = codes.astype(np.uint64)
    rolling, found = np.zeros(len(wide), np.uint64), []
    for k in range(max(ORDERS)):
        rolling = rolling[:len(wide) - k] + wide[k:] * _SALT[k]
        if k + 1 in ORDERS:
            # the order is part of the hash; a lone space is no feature
            value = (mixed(rolling + np.uint64(k + 1)) >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)
            found.append(value[codes != _SPACE] if k == 0 else value)
    sums = np.bincount(np.concatenate(found), minlength=FEATURES)
    used = np.flatnonzero(sums)
    return used.astype(np.int32), sums[used].astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (features, languages), sparse after training
    bias: np.ndarray
    temperature: float = 1.0
    zeros: float = field(default=0.0)

    def vector(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[used]
        norm = np.sqrt((x * x).sum())
        return x / norm if norm > 0 else x

    def logits(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(used, counts) @ self.weights[used] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        used, counts = grams(text)
        if not len(used) or not self.languages:
            return UNKNOWN, 0.0
        share = softmax(self.logits(used, counts) / self.temperature)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_regularised_leader(
    model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, alpha: float = 1.0, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.05, seed: int = 3,
) -> None:
    """FTRL-proximal with elastic-net penalties, one row at a time; fills the model's weights and bias.

    A weight is ``-(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2)`` where |z| exceeds l1, and zero elsewhere.
    """
    classes = len(model.languages)
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))
    bias_z, bias_n = np.zeros(classes), np.zeros(classes)

    def weights(z, n, l1):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    vectors = [(used, model.vector(used, counts).astype(np.float32), label) for used, counts, label in rows]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)).tolist():
            used, x, label = vectors[i]
            zu, nu = z[used], n[used]
            w, b = weights(zu, nu, l1), weights(bias_z, bias_n, 0.0)
            error = softmax(x @ w + b)
            error[label] -= 1
            for state_z, state_n, weight, gradient in ((zu, nu, w, x[:, None] * error[None, :]), (bias_z, bias_n, b, error)):
                squared = gradient * gradient
                state_z += gradient - (np.sqrt(state_n + squared) - np.sqrt(state_n)) / alpha * weight
                state_n += squared
            z[used], n[used] = zu, nu
    model.weights, model.bias = weights(z, n, l1), weights(bias_z, bias_n, 0.0)
    model.zeros = float((model.weights == 0).mean())


def calibrated(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """The temperature with the least log loss on rows that taught no weight; golden-section search over its logarithm."""
    if not rows:
        return 1.0
    logits = np.stack([model.logits(used, counts) for used, counts, _ in rows])
    labels = np.array([label for *_, label in rows])

    def loss(log_t: float) -> float:
        return float(-np.log(softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels] + 1e-300).mean())

    low, high, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for part in pieces(batch):
            for text in part.column("text").to_pylist():
                used, _ = grams(text)
                sums[used] += 1
                rows += 1
    if rows:
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(sums[used], rows))], ["feature", "n"]
        )


def _grams(batches):
    for batch in batches:
        for part in pieces(batch):
            found = [grams(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("lang"), part.column("fits"), pa.array([u for u, _ in found], pa.list_(pa.int32())),
                    pa.array([c for _, c in found], pa.list_(pa.int32())),
                ],
                ["lang", "fits", "used", "counts"],
            )


def train(labelled: DataFrame, sample: int = SAMPLE, epochs: int = 3) -> Model:
    """A model from texts with a language (text, lang); rows without either are left out.

    Document frequencies cover all labelled texts.  The classifier is fitted on at most ``sample`` whole texts, the
    first distinct ones by a hash, shared evenly between languages; every tenth of them only calibrates.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counted = rows.select("text").mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = counted.column("feature").to_numpy(), counted.column("n").to_numpy()
    total = int(n[feature < 0].sum())
    idf = np.full(FEATURES, np.log1p(total) + 1.0)
    idf[feature[feature >= 0]] = np.log((1 + total) / (1 + n[feature >= 0])) + 1
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    model = Model(languages, idf, np.zeros((FEATURES, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    # which hashes belong to the sample is found without the texts; equal texts are one
    each = max(1, sample // len(languages))
    drawn = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    lowest = drawn.select("lang", "h").distinct().withColumn("at", first).where(F.col("at") <= each)
    cuts = {r["lang"]: r["h"] for r in lowest.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    drawn = drawn.where(F.col("h") <= cut[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    # the n-grams of the sample, not its texts, come to the driver
    picked = written(drawn.select("text", "lang", (F.pmod("h", F.lit(10)) > 0).alias("fits")), "language-sample")
    kept = picked.repartition(16).mapInArrow(_grams, "lang string, fits boolean, used array<int>, counts array<int>").toArrow()
    number = {lang: i for i, lang in enumerate(languages)}
    fit, check = [], []
    for lang, fits, used, counts in zip(*(kept.column(c) for c in ("lang", "fits", "used", "counts"))):
        used, counts = used.values.to_numpy(), counts.values.to_numpy()
        if len(used):
            (fit if fits.as_py() else check).append((used, counts, number[lang.as_py()]))
    follow_the_regularised_leader(model, fit, epochs)
    model.temperature = calibrated(model, check)
    return model


def _predicted(model: Model):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                found = [model.predict(t) for t in part.column("text").to_pylist()]
                out = part.append_column("lang_pred", pa.array([f[0] for f in found], pa.string()))
                yield out.append_column("score", pa.array([f[1] for f in found], pa.float64()))

    return run


def predict(rows: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``rows`` with the predicted language and its calibrated probability, from column text alone.

    Defined results: ``und`` with score 0 if the text is null or has no letters, or nothing was learnt.  Columns of
    ``rows`` named like the two new ones are replaced.
    """
    rest = [c for c in rows.columns if c not in (pred, score)]
    kept = rows.select(*[F.col(f"`{c}`") for c in rest])
    given = kept.select("text", F.struct(*[F.col(f"`{c}`") for c in rest if c != "text"] or [F.lit(0).alias("none")]).alias("rest"))
    schema = T.StructType([*given.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = given.mapInArrow(_predicted(model), schema)
    picked = [F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in rest]
    return out.select(*picked, F.col("lang_pred").alias(pred), F.col("score").alias(score))


def _lettered(batches):
    for batch in batches:
        for part in pieces(batch):
            yield part.filter(pa.array([len(letters(t or "")) > 1 for t in part.column("text").to_pylist()], pa.bool_()))


def lettered(rows: DataFrame) -> DataFrame:
    """The rows whose text is not null and has letters."""
    return rows.mapInArrow(_lettered, rows.schema)


def held_out(doc_id, folds: int = 3, fold: int = 1):
    """Whether crc32 of the doc_id as text, modulo ``folds``, is ``fold``; a null doc_id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds)) == fold, F.lit(False))


def languages(docs: DataFrame, folds: int = 3, fold: int = 1, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document (doc_id, text, lang); held-out rows teach nothing."""
    rows = docs.select("doc_id", "text", "lang", held_out("doc_id", folds, fold).alias("held_out"))
    model = train(rows.where("NOT held_out"), sample)
    return predict(rows.select("doc_id", "held_out", "text"), model).drop("text")
