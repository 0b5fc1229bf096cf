"""Quality classifier: regularised quadratic discriminant (operator 2).

``measure`` turns every whole text into transformed document statistics (logs
of counts, square roots of shares).  ``fit`` sums moments per class inside the
tasks, shrinks each class covariance towards the pooled one and the identity,
and keeps the Cholesky factors.  ``score`` solves with those factors: the score
of a document is the posterior of class 1 from the difference of the two
log-densities.

Results on odd input: null and empty texts have all-zero statistics and get a
score like any other; texts of any length are measured whole; labels other
than 0 and 1, and labels without a document, teach nothing; a document with
several labels counts once for each; with one class alone all scores are that
class, with none 0.5; repeated rows are scored each; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import map_batches

FEATURES = ("words", "word_length", "upper", "digits", "symbols", "shouts", "bars", "punctuation", "other_bytes",
            "distinct_words", "repeated_triples", "repeated_lines", "top_word", "entropy", "words_a_line")
#: Share of the pooled covariance in each class covariance, and of the identity (times its mean variance).
TO_POOLED = 0.1
TO_IDENTITY = 0.01

_BYTES = {name: np.isin(np.arange(256), list(chars.encode())) for name, chars in {
    "digits": "0123456789", "symbols": "#*$%&<>@^~{}[]\\_=+", "shouts": "!?", "bars": "|",
    "punctuation": ".,;:'\"()-"}.items()}
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LOWER = np.array([97 <= b <= 122 for b in range(256)])


def statistics(text: str | None) -> list[float]:
    """The FEATURES of one text."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    count = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    total = int(count.sum())
    ink = total - int(count[[9, 10, 13, 32]].sum())
    share = count[count > 0] / total
    lines = [x for x in text.split("\n") if x.strip()]
    triples = max(n - 2, 0)
    kinds = Counter(words)
    upper = int(count[_UPPER].sum())
    root = lambda a, b: float(np.sqrt(a / b)) if b else 0.0
    return [
        float(np.log1p(n)), float(np.log1p(ink / n)), root(upper, upper + int(count[_LOWER].sum())),
        root(count[_BYTES["digits"]].sum(), ink), root(count[_BYTES["symbols"]].sum(), ink),
        root(count[_BYTES["shouts"]].sum(), ink), root(count[_BYTES["bars"]].sum(), ink),
        root(count[_BYTES["punctuation"]].sum(), ink), root(count[128:].sum(), ink),
        float(np.log(len(kinds)) / np.log(n)) if n > 1 else 1.0,
        root(triples - len(set(zip(words, words[1:], words[2:]))), triples),
        root(len(lines) - len(set(lines)), len(lines)), root(max(kinds.values()), n),
        float(-(share * np.log2(share)).sum()), float(np.log1p(n / max(len(lines), 1)))]


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features array<double>) of each row."""
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batch):
        flat = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.float64)
        ends = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))],
                                         names=[id_col, "features"])

    return map_batches(rows, run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, features array<double>")


def _matrix(col: pa.ListArray) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


@dataclass
class Discriminant:
    """Means, Cholesky factors and log-determinants of the classes 0 and 1, and their priors."""

    prior: tuple[float, float]
    mean: list | None = None
    factor: list | None = None
    log_det: list | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.prior[1])
        log = []
        for k in (0, 1):
            z = np.linalg.solve(self.factor[k], (x - self.mean[k]).T)
            log.append(np.log(self.prior[k]) - 0.5 * (self.log_det[k] + (z * z).sum(0)))
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant:
    """Learn from all rows of ``features`` that ``labels`` marks 0 or 1.  Only sums come to the driver: 1 + d + d*d
    numbers a class."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col), F.col(label_col).cast("int").alias("y"))
    rows = features.join(known, id_col).select("y", "features")
    d = len(FEATURES)

    def run(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            y, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for k in (0, 1):
                own = x[y == k]
                if len(own):
                    sums[k] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
        for k in (0, 1):
            if sums[k, 0]:
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sums[k].tolist()])],
                                                 names=["y", "sums"])

    parts = rows.mapInArrow(run, "y int, sums array<double>").select("y", F.posexplode("sums").alias("i", "v"))
    total = np.zeros((2, 1 + d + d * d))
    for r in parts.groupBy("y", "i").agg(F.sum("v").alias("v")).collect():
        total[r.y, r.i] = r.v
    n = total[:, 0]
    if not n.all():
        return Discriminant((0.5, 0.5) if not n.any() else (float(n[0] > 0), float(n[1] > 0)))
    mean = [total[k, 1:1 + d] / n[k] for k in (0, 1)]
    own = [total[k, 1 + d:].reshape(d, d) / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    factor, log_det = [], []
    for k in (0, 1):
        s = (1 - to_pooled) * own[k] + to_pooled * pooled
        s = (1 - to_identity) * s + to_identity * max(np.trace(s) / d, 1e-9) * np.eye(d)
        factor.append(np.linalg.cholesky(s))
        log_det.append(2 * float(np.log(np.diag(factor[k])).sum()))
    return Discriminant((float(n[0] / n.sum()), float(n[1] / n.sum())), mean, factor, log_det)


def score(features: DataFrame, model: Discriminant, id_col: str = "doc_id") -> DataFrame:
    """(id, score) of each row of ``features``."""
    def run(batch):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))],
                                         names=[id_col, "score"])

    rows = features.select(id_col, "features")
    return map_batches(rows, run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")
