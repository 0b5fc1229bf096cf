"""Language by rank-order n-gram profiles (operator 10).

A profile is the list of most frequent letter n-grams (1 to 3 letters, a blank
marks the word border, case folded).  ``learn`` counts n-grams over all
training rows and keeps the first ``PROFILE`` of each language; ``predict``
ranks a document's own n-grams, sums how far each is out of place in a
language's profile (absent ones cost the whole profile) and takes the nearest
language.  The score is the share of that distance that the best language
saves against the worst possible one.

Results on odd input: null texts and texts without a letter get ``und`` and
score 0, as every text does when nothing was learned; rows without a language
teach nothing; equal distances go to the alphabetically first language; texts
of any length are read whole; repeated rows count and are answered each;
columns other than id, text and language are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schemelens.llm.common import map_batches, slices

#: n-grams in the profile of a language, and of a document.
PROFILE = 600
DOC_PROFILE = 400
#: Distinct n-grams that a counting task holds before it hands on its sums.
HELD = 1 << 20


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """True at the code points of letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, one number each (21 bits a letter)."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    c = np.where(letters()[c], c, 32)
    c = np.concatenate(([32], c, [32]))
    gap = c == 32
    c = c[~(gap & np.concatenate(([False], gap[:-1])))]
    if len(c) < 3:
        return np.empty(0, np.int64)
    gap = c == 32
    two = c[:-1] << 21 | c[1:]
    three = (two[:-1] << 21 | c[2:])[~gap[1:-1]]
    return np.concatenate((c[~gap], two, three))


def ranked(text: str, most: int = DOC_PROFILE) -> np.ndarray:
    """The most frequent n-grams, commonest first, ties by number."""
    code, n = np.unique(grams(text), return_counts=True)
    kind = np.uint16 if len(n) and n.max() < 65536 else np.int64
    order = np.argsort((n.max() - n).astype(kind) if len(n) else n, kind="stable")[:most]
    return code[order]


def _sums(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def count_grams(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows, summed inside each task first."""
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def hand_on():
            for lang, (code, n) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code), pa.array(n)],
                                                 names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, [1], 1 << 20):
                texts: dict[str, list[str]] = {}
                for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    texts.setdefault(lang, []).append(t)
                for lang, ts in texts.items():
                    code, n = np.unique(grams("\n".join(ts)), return_counts=True)
                    old = held.get(lang)
                    held[lang] = _sums([old[0], code], [old[1], n]) if old else (code, n)
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield from hand_on()
        yield from hand_on()

    counted = rows.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """Profile of each language; ``size`` numbers a language, so what comes to the driver is bounded by the
    number of languages."""
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = count_grams(df, text_col, lang_col).withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= size)
    out: dict[str, list[int]] = {}
    for r in sorted(top.select("lang", "place", "gram").collect()):
        out.setdefault(r.lang, []).append(r.gram)
    return out


class Profiles:
    def __init__(self, learned: dict[str, list[int]], size: int):
        self.size = size
        self.langs = sorted(learned)
        self.codes = np.unique(np.array([g for p in learned.values() for g in p], np.int64))
        # one column more than codes: n-grams that no profile has
        self.places = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            p = np.array(learned[lang], np.int64)
            self.places[i, np.searchsorted(self.codes, p)] = np.arange(len(p))

    def predict(self, text: str | None) -> tuple[str, float]:
        doc = ranked(text) if text else ()
        if not len(doc) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.codes, doc)
        hit = at < len(self.codes)
        hit[hit] = self.codes[at[hit]] == doc[hit]
        places = self.places[:, np.where(hit, at, len(self.codes))]
        away = np.where(places < 0, self.size, np.minimum(np.abs(places - np.arange(len(doc))), self.size)).sum(1)
        best = int(away.argmin())
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(doc))


def predict(df: DataFrame, learned: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text",
            size: int = PROFILE) -> DataFrame:
    """(id, lang_pred, score) of each row."""
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    profiles = Profiles(learned, size)

    def run(batch):
        got = [profiles.predict(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
            names=[id_col, "lang_pred", "score"])

    return map_batches(rows, run,
                       f"`{id_col}` {rows.schema[0].dataType.simpleString()}, lang_pred string, score double")
