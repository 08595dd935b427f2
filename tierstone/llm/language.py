"""Language identification: multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import fold, in_batches, python_values, share, small_batches, stored

UNKNOWN = "und"
#: n-grams of one to three characters are hashed into so many features.
GRAMS, FEATURES = (1, 2, 3), 1 << 14
#: Labelled texts the weights are fitted to, so many of each language at most.
SAMPLE_DOCUMENTS = 1200
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 1e-3, 1e-3
#: Part of the sample kept for the temperature.
CALIBRATION_SHARE = 0.2


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the whole text and how often each occurs; white space runs are one space."""
    chars = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "replace"), "<u4")
    chars = np.concatenate(([32], chars, [32])).astype(np.uint32)
    total = np.zeros(FEATURES, np.int64)
    value = np.zeros(len(chars), np.uint32)
    for n in GRAMS:
        if len(chars) < n:
            break
        value = value[: len(chars) - n + 1] * np.uint32(0x9E3779B1) + chars[n - 1 :] + np.uint32(n)
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA77)
        total += np.bincount(mixed >> np.uint32(32 - 14), minlength=FEATURES)
    found = np.nonzero(total)[0]
    return found.astype(np.int32), total[found]


@dataclass
class Model:
    """Weights by feature and language (zero for most), idf, biases and temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found, counts = gram_counts(text)
        return found, _tf_idf(found, counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability); `und` and 0 for NULL, and for texts without a letter."""
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        found, x = self.features(text)
        odds = softmax((x @ self.weights[found] + self.bias) / self.temperature)
        best = int(np.argmax(odds))
        return self.languages[best], float(odds[best])


def _tf_idf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * idf[found]
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(texts: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all these texts each feature occurs, and their number.

    Each task adds its texts up; what reaches the driver is one number per feature.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES + 1, np.int64), 0
        for (content,) in python_values(batches):
            seen[gram_counts(content)[0]] += 1
            n += 1
        seen[FEATURES] = n
        some = np.nonzero(seen)[0]
        schema = pa.schema([("feature", pa.int32()), ("n", pa.int64())])
        return in_batches(zip(some.tolist(), seen[some].tolist(), strict=True), schema, FEATURES)

    counted = texts.select(text).mapInArrow(work, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    total = np.zeros(FEATURES + 1, np.int64)
    for feature, n in counted.collect():
        total[feature] = n
    return total[:FEATURES], int(total[FEATURES])


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit to rows with a text and a language; nothing else of a row is looked at.

    Document frequencies are counted over all rows. Weights are fitted on `sample`
    different texts of each language, or all where it has fewer: those of the smallest
    hashes. Rows equal in text and language are one example, so copies neither keep a
    language out nor swell the sample. A language with more rows than texts is fitted to
    its texts in turn, as often as it has rows, up to `sample`. With no row to learn from
    the model answers `und` only.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    keys = stored(rows.groupBy("lang", share(F.col("text")).alias("draw")).count(), "draws")
    totals = keys.groupBy("lang").agg(F.count("*"), F.sum("count")).collect()
    counts, copies = ({r[0]: r[k] for r in totals} for k in (1, 2))
    languages = sorted(counts)
    seen, n = document_frequencies(rows) if languages else (np.zeros(FEATURES), 0)
    model = Model(
        languages, np.log((1.0 + n) / (1.0 + seen)) + 1.0,
        np.zeros((FEATURES, len(languages))), np.zeros(len(languages)),
    )
    if not languages:
        return model
    by_language = lambda values: F.create_map(*(F.lit(v) for pair in values.items() for v in pair))[F.col("lang")]
    # Twice as many as needed and some more, so that enough remain to take the smallest of.
    rates = {name: min(1.0, (2 * sample + 50) / counts[name]) for name in languages}
    draws: dict[str, list[float]] = {name: [] for name in languages}
    for name, draw in keys.where(F.col("draw") < by_language(rates)).select("lang", "draw").collect():
        draws[name].append(draw)
    last = {name: sorted(found)[:sample][-1] for name, found in draws.items()}
    drawn = rows.where(share(F.col("text")) <= by_language(last))
    examples = _examples(drawn, model)
    placed, kept = [], []
    for k, name in enumerate(languages):
        own = [e for e in examples if e[2] == k]
        aside = int(CALIBRATION_SHARE * len(own))  # none of fewer than five
        kept += own[:aside]
        fitted, times = own[aside:], min(sample, copies[name]) - aside
        times = max(times, len(fitted))
        placed += [((i + 0.5) / times, k, fitted[i % len(fitted)]) for i in range(times)]
    _follow_the_leader(model, [e for *_, e in sorted(placed, key=lambda x: x[:2])])
    model.temperature = _temperature(model, kept)
    return model


def _examples(drawn: DataFrame, model: Model) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Feature vectors of the sample's different rows, made in the tasks, in an order drawn
    by hash. A task makes each once; what several tasks made is merged before the driver."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            made = set()
            for content, name, order in python_values(batches):
                if (name, order) in made:
                    continue
                made.add((name, order))
                found, x = model.features(content)
                yield found.tobytes(), x.astype(np.float32).tobytes(), name, order

        schema = pa.schema([("f", pa.binary()), ("x", pa.binary()), ("lang", pa.string()), ("o", pa.int64())])
        return in_batches(rows(), schema, 200)

    made = drawn.select("text", "lang", F.xxhash64(F.lit("order"), "text")).mapInArrow(
        work, "f binary, x binary, lang string, o long"
    ).dropDuplicates(["o", "lang"])
    number = {name: i for i, name in enumerate(model.languages)}
    rows = sorted(made.collect(), key=lambda r: (r["o"], r["lang"]))
    return [
        (np.frombuffer(r["f"], np.int32), np.frombuffer(r["x"], np.float32).astype(float), number[r["lang"]])
        for r in rows
    ]


def _follow_the_leader(model: Model, examples: list) -> None:
    """FTRL-proximal: each coordinate's rate falls with its gradients; L1 keeps weights
    at zero until evidence exceeds it, L2 shrinks the rest. The bias is not penalised."""
    width = len(model.languages)
    z, n = np.zeros((FEATURES, width)), np.zeros((FEATURES, width))
    z_bias, n_bias = np.zeros(width), np.zeros(width)

    def leader(z_part, n_part, l1, l2):
        shrunk = np.sign(z_part) * l1 - z_part
        return np.where(np.abs(z_part) <= l1, 0.0, shrunk / ((BETA + np.sqrt(n_part)) / ALPHA + l2))

    for _ in range(EPOCHS):
        for found, x, truth in examples:
            w, b = leader(z[found], n[found], L1, L2), leader(z_bias, n_bias, 0.0, 0.0)
            error = softmax(x @ w + b)
            error[truth] -= 1.0
            gradient = x[:, None] * error[None, :]
            z[found] += gradient - (np.sqrt(n[found] + gradient**2) - np.sqrt(n[found])) / ALPHA * w
            n[found] += gradient**2
            z_bias += error - (np.sqrt(n_bias + error**2) - np.sqrt(n_bias)) / ALPHA * b
            n_bias += error**2
    model.weights, model.bias = leader(z, n, L1, L2), leader(z_bias, n_bias, 0.0, 0.0)


def _temperature(model: Model, examples: list) -> float:
    """The temperature under which rows kept from the fit are likeliest."""
    if not examples:
        return 1.0
    z = np.array([x @ model.weights[found] + model.bias for found, x, _ in examples])
    truth = np.array([t for _, _, t in examples])
    loss = lambda t: -np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean()
    return float(min(np.geomspace(0.1, 5.0, 80), key=loss))


def predicted(model: Model, text: Column) -> Column:
    """Struct column (lang_pred, score) of whole texts."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 4) == 2


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows that are
    not held out.

    NULL texts and texts without a letter are `und` with score 0. Repeated rows are
    predicted each; equal texts get equal answers; NULL ids fold like the empty text.
    Other columns are left out.
    """
    model = train(docs.where(~held_out(F.col(doc_id))), text, lang)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    found = rows.withColumn("found", predicted(model, F.col("text")))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def accepted(docs: DataFrame, least: float = 0.5, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents in a language the model knows, with all their columns. Rejected are
    `und` and those where no language is likelier than `least`."""
    model = train(docs.where(~held_out(F.col(doc_id))), text, lang)
    found = docs.withColumn("__found", predicted(model, F.col(text)))
    keep = (F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.score") >= least)
    return found.where(keep).select(*(F.col(f"`{c}`") for c in docs.columns))
