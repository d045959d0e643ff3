"""Bradley-Terry quality scores: learned from preference pairs, cut at a quantile of the scores.

A labelled document of a higher label is preferred to one of a lower label. With s(x) = w.x on text statistics x,
P(a preferred to b) = 1 / (1 + exp(s(b) - s(a))); w minimises the logistic loss on feature differences. Such scores have
no zero point, so the cut is the quantile of the training scores at the share of rejected labels; it is mapped to
``threshold`` on a 0 to 1 scale.

The labelled rows are a bounded sample, the ``most_labelled`` ids of least hash; scoring is row by row over all texts.

Edge cases: null texts are scored as empty ones; null labels are no labels; rows that repeat an id train once, with
its lowest label; with no labelled row or one label only there is no pair, and every score is 0.5 (kept).
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import as_bytes, by_value, map_arrow, text_chunks

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#$%&*!|<>{}[]=~^\\/@_+"
STOPS = b".,;:"
# Statistics that are shares of the text; each enters as it is and on a logarithmic scale.
SHARES = ["distinct_words", "adjacent_repeats", "upper", "digits", "symbols", "bars", "exclamations", "stops",
          "line_ends", "repeated_lines", "capital_words"]
N_FEATURES = 3 + 2 * len(SHARES)


def statistics(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), N_FEATURES))
    for row, text in zip(out, texts):
        words = text.split()
        n, size = len(words), max(1, len(text))
        lines = [line for line in text.split(b"\n") if line]

        def share(drop: bytes) -> float:
            return 1 - len(text.translate(None, drop)) / size if text else 0.0

        many = max(1, n)
        shares = np.array([
            len(set(words)) / many, sum(map(eq, words, words[1:])) / many, share(UPPER), share(DIGITS), share(SYMBOLS),
            text.count(b"|") / size, text.count(b"!") / size, share(STOPS), text.count(b"\n") / size,
            1 - len(set(lines)) / max(1, len(lines)), sum(map(bytes.isupper, words)) / many])
        row[:3] = np.log1p(n), np.log1p(len(text)), np.log1p(size / many)
        row[3:] = np.concatenate([shares, np.log1p(200 * shares)])
    return out


@dataclass
class Ranking:
    """score = 1 / (1 + exp(-(w.(x - mean) / spread - cut + logit(threshold))))"""
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    shift: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.spread) @ self.weights + self.shift
        return 1 / (1 + np.exp(-np.clip(s, -60, 60)))


def fit(x: np.ndarray, labels: np.ndarray, threshold: float = 0.3, pairs: int = 100_000, ridge: float = 1e-3, seed: int = 7) -> Ranking | None:
    """Newton steps on the loss of ``pairs`` preference pairs, each of a higher and a lower label."""
    kinds = np.unique(labels)
    if len(kinds) < 2:
        return None
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = (x - mean) / spread
    rng = np.random.default_rng(seed)
    low = rng.choice(np.flatnonzero(labels < kinds[-1]), pairs)
    by_label = [np.flatnonzero(labels > kind) for kind in kinds[:-1]]
    high = np.empty(pairs, np.int64)
    for kind, above in zip(kinds[:-1], by_label):
        at = labels[low] == kind
        high[at] = rng.choice(above, int(at.sum()))
    difference = z[high] - z[low]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -60, 60)))  # of the wrong order
        gradient = -(difference * p[:, None]).mean(0) + ridge * w
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    s = np.sort(z @ w)
    rejected = int((labels < kinds[-1]).sum())
    cut = (s[rejected - 1] + s[rejected]) / 2  # the quantile at the share of rejected labels
    return Ranking(mean, spread, w, float(np.log(threshold / (1 - threshold)) - cut))


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, threshold: float = 0.3,
          id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Ranking | None:
    """Fit on the texts of at most ``most_labelled`` labelled ids; that many rows of statistics reach the driver."""
    marked = (labels.where(labels[label_column].isNotNull() & labels[id_column].isNotNull())
              .groupBy(labels[id_column].cast("long").alias("__id")).agg(F.min(label_column).alias("__label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(most_labelled))
    rows = (docs.select(docs[id_column].cast("long").alias("__id"), F.coalesce(docs[text_column], F.lit("")).alias("__text"))
            .join(F.broadcast(marked), "__id").select("__id", "__label", "__text"))

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(2))
            x = statistics(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.float64()), pa.array(list(x), pa.list_(pa.float64()))],
                                             ["__id", "__label", "__x"])

    found = map_arrow(rows, run, "__id long, __label double, __x array<double>").groupBy("__id").agg(F.min(F.struct("__label", "__x")).alias("r"))
    sample = found.select("__id", "r.*").toPandas().sort_values("__id")
    if sample.empty:
        return None
    return fit(np.array(sample["__x"].tolist()), sample["__label"].to_numpy(), threshold)


def score(text: Column, ranking: Ranking | None) -> Column:
    """Score of a text column, 0 to 1."""
    if ranking is None:
        return F.lit(0.5)

    def run(column: pa.Array) -> pa.Array:
        texts = as_bytes(column)
        found = [ranking.scores(statistics(texts[some])) for some in text_chunks(texts)]
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return F.arrow_udf(by_value(run), "double")(F.coalesce(text, F.lit("")))
