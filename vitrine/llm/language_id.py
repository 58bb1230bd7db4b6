"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text's features are byte n-grams of its words (each word between two blanks, letters folded to
lower case), hashed into a fixed number of buckets.  The mean of their embeddings goes through a
linear softmax; both are trained by stochastic gradient descent in numpy on a bounded sample of
labelled rows.  Because the model is linear after the mean, embeddings and output weights are
multiplied once after training: a text is scored by its bucket counts times a bucket-by-language
table, whose size depends on neither the corpus nor the text.

Calibration uses labelled rows of the sample that training did not see: a temperature that
minimises their log-loss, then a rejection limit, which is the score that all but
`reject_share` of their correct predictions reach (never above `reject_max`).

Defined cases: a text that is null or has no letter is `und` with score 0 and is rejected; with no
labelled row at all every text is `und`.  Rows with a null language or text train nothing.  Repeated
rows are predicted alike, ties go to the language that sorts first, and other columns play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import fold, map_texts, row_id

LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
PIECE = 1 << 20  # characters turned into features at once


@dataclass
class LanguageModel:
    labels: list[str]
    weights: np.ndarray  # buckets x languages
    temperature: float
    limit: float

    def scores(self, text: str | None) -> tuple[str, float]:
        if not self.labels or text is None or not LETTER.search(text):
            return "und", 0.0
        logits = (bucket_counts(text, len(self.weights)) @ self.weights) / self.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def buckets(text: str, size: int) -> np.ndarray:
    """Hashed 2-, 3- and 4-byte grams of the words of a text."""
    raw = np.frombuffer((" " + NOT_LETTERS.sub(" ", text.lower()) + " ").encode("utf-8", "replace"), np.uint8)
    x = raw.astype(np.uint32)
    blank = raw == 32
    found = []
    gram = x[:-1] * np.uint32(257) + x[1:]
    inner = blank[1:-1]  # a blank may only be a gram's first or last byte
    found.append(gram)
    for n in (3, 4):
        if len(x) < n:
            break
        gram = gram[:-1] * np.uint32(0x01000193) + x[n - 1:]
        crosses = inner if n == 3 else inner[:-1] | inner[1:]
        found.append(gram[~crosses] + np.uint32(n))
    every = np.concatenate(found) * np.uint32(0x9E3779B1)
    return (every >> np.uint32(32 - size.bit_length() + 1)).astype(np.int64)


def bucket_counts(text: str, size: int) -> np.ndarray:
    """Share of each bucket among all grams; very long texts are read piece by piece."""
    total = np.zeros(size)
    for start in range(0, max(1, len(text)), PIECE):
        total += np.bincount(buckets(text[start:start + PIECE], size), minlength=size)
    return total / max(1.0, total.sum())


def fit(samples: list[tuple[str, str]], held: list[tuple[str, str]], size: int = 1 << 14, dim: int = 16,
        epochs: int = 4, rate: float = 0.5, seed: int = 7, reject_share: float = 0.0005,
        reject_max: float = 0.4) -> LanguageModel:
    """Train on (text, language) pairs and calibrate on the held pairs.  `size` is a power of two."""
    labels = sorted({y for _, y in samples})
    if not labels:
        return LanguageModel([], np.zeros((size, 0)), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    features = []
    for text, y in samples:
        if LETTER.search(text):
            index, n = np.unique(buckets(text, size), return_counts=True)
            features.append((index, n / n.sum(), labels.index(y)))
    embed = rng.uniform(-1 / dim, 1 / dim, (size, dim))
    out = np.zeros((dim, len(labels)))
    steps, done = epochs * max(1, len(features)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            index, share, y = features[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ embed[index]
            z = mean @ out
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= step * np.outer(mean, p)
            # The mean spreads its gradient over the grams; the factor keeps long texts learning.
            embed[index] -= step * np.outer(share * min(len(index), 50), back)
    weights = embed @ out
    checked = [(bucket_counts(t, size) @ weights, labels.index(y)) for t, y in held
               if y in labels and LETTER.search(t)]
    temperature, limit = 1.0, 0.0
    if checked:
        z, y = np.array([c[0] for c in checked]), np.array([c[1] for c in checked])

        def scaled(t: float) -> np.ndarray:
            e = np.exp((z - z.max(1, keepdims=True)) / t)
            return e / e.sum(1, keepdims=True)

        temperature = min((float(t) for t in np.geomspace(0.05, 20, 60)),
                          key=lambda t: -np.log(scaled(t)[np.arange(len(y)), y] + 1e-12).mean())
        p = scaled(temperature)
        good = p.max(1)[p.argmax(1) == y]
        limit = min(reject_max, float(np.quantile(good, reject_share))) if len(good) else 0.0
    return LanguageModel(labels, weights, temperature, limit)


def sample_pieces(labelled: DataFrame, rows_per_language: int, piece: int) -> list[tuple[str, str, bool]]:
    """A bounded, repeatable sample: about `rows_per_language` rows of each language, chosen by the
    hash of the row, and of each row up to four pieces of varied length from all over its text.
    The driver receives at most 4 * rows_per_language * piece characters of each language."""
    sizes = labelled.groupBy("lang").count().collect()
    if not sizes:
        return []
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, rows_per_language / r["count"]))])
    pick = F.pmod(F.xxhash64("id", "text", F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
    cuts = []
    for i in range(4):
        long = F.pmod(F.xxhash64("id", F.lit(10 + i)), F.lit(piece)) + 1 if i else F.lit(piece)
        at = F.pmod(F.xxhash64("id", F.lit(20 + i)), F.greatest(F.length("text") - long, F.lit(1)))
        cuts.append(F.substring(F.col("text"), at.cast("int") + 1, long.cast("int")))
    rows = (labelled.where(pick < F.element_at(share, F.col("lang")))
            .select("lang", (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5)) == 0).alias("held"),
                    F.explode(F.array(*cuts)).alias("piece")).orderBy("lang", "held", "piece").collect())
    return [(r["piece"], r["lang"], r["held"]) for r in rows]


def train(documents: DataFrame, rows_per_language: int = 1000, piece: int = 1000, folds: int = 4,
          left_out: int = 2) -> LanguageModel:
    """Learn from documents outside the fold `left_out`: bounded sample, see `sample_pieces`."""
    labelled = (documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                                & (fold("doc_id", folds) != left_out))
                .select(row_id().alias("id"), "text", "lang"))
    rows = sample_pieces(labelled, rows_per_language, piece)
    return fit([(t, y) for t, y, held in rows if not held], [(t, y) for t, y, held in rows if held])


def predict(documents: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """Columns `keep` of every row with lang_pred, score and rejected, from its whole text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(texts: list) -> list[list]:
        m = shared.value
        found = [m.scores(t) for t in texts]
        return [[f[0] for f in found], [f[1] for f in found],
                [f[0] == "und" or f[1] < m.limit for f in found]]

    source = documents.select(*keep, F.col("text").alias("__text"))
    return map_texts(source, "__text", "lang_pred string, score double, rejected boolean", run)


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and rejected for every document."""
    spread = documents.select("doc_id", "text", fold("doc_id", 4).alias("f"))
    return (predict(spread, train(documents), ["doc_id", "f"])
            .select("doc_id", (F.col("f") == 2).alias("held_out"), "lang_pred", "score", "rejected"))


def drop_rejected(documents: DataFrame) -> DataFrame:
    """The documents whose language is told with enough certainty, with their own columns."""
    # The row travels as one value, so that no column of its own meets one of the prediction's.
    rows = documents.select(F.struct(*documents.columns).alias("__row"), "text")
    return predict(rows, train(documents), ["__row"]).where(~F.col("rejected")).select("__row.*")
