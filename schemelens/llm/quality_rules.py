"""Quality rules with host verdicts (operator 8).

``measure`` counts per document what the rules need.  A document fails its
base rules by itself (too short, or mostly repeated three-word windows).
``hosts`` sums documents and failures of any rule per host, shrinks each
host's failure rate with a beta prior fitted to all hosts by moments, and
rejects hosts whose shrunk rate is over ``HOST_RATE``.  ``judge`` joins the
rejected hosts back, so a document stays if it passes its base rules and its
host is not rejected.

Results on odd input: null and empty texts have no words and fail; rows
without a host are judged by their base rules alone and count for no host;
texts of any length are read whole; repeated rows count each; an empty table
gives empty tables; columns other than those named are not read.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import Scratch, map_batches

MIN_WORDS = 50
#: Rules that count against a host besides the base ones: percent of symbols among characters, of repeated lines.
SYMBOL_PERCENT = 10
LINE_PERCENT = 30
#: A host whose shrunk failure rate is above this is rejected.
HOST_RATE = 0.5
#: Smallest and largest weight of the prior, in documents.
PRIOR_DOCS = (2.0, 1000.0)

_WORDS = re.compile("[^\x20\x09-\x0d]+").findall
_SYMBOLS = re.compile("[#*$%&|<>]").findall
_HAS_WORD = re.compile("[^\x20\x09-\x0d]").search
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def count(text) -> tuple[int, ...]:
    """The COUNTS of one text."""
    if not text:
        return (0,) * len(COUNTS)
    words = _WORDS(text)
    lines = [x for x in text.split("\n") if _HAS_WORD(x)]
    return (len(words), sum(map(len, words)), len(_SYMBOLS(text)), len(lines) - len(set(lines)), len(lines),
            repeat_words(words))


def repeat_words(words: list[str]) -> int:
    """Words in three-word windows that occur twice or more."""
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in windows), np.int64, len(windows))
    again = np.bincount(ids)[ids] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= again
    return int(inside.sum())


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, COUNTS) of each row."""
    rows = df.select(F.col(id_col), F.col(host_col).cast("string").alias("host"),
                     F.col(text_col).cast("string").alias("text"))

    def run(batch):
        got = np.array([count(t) for t in batch.column(2).to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in got.T)],
                                         names=[id_col, "host", *COUNTS])

    kinds = ", ".join(f"{c} long" for c in COUNTS)
    return map_batches(rows, run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, host string, {kinds}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    return (base_failed() | (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("word_chars"))
            | (100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines")))


def hosts(measured: DataFrame) -> DataFrame:
    """(host, n_docs, n_failed, rate, rejected): raw counts, shrunk rate and verdict of every host."""
    per = measured.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(rule_failed().cast("long")).alias("n_failed"))
    share = F.col("n_failed") / F.col("n_docs")
    # moments over hosts; the variance between hosts is what sampling alone does not explain
    m = per.agg(F.sum("n_docs").alias("docs"), F.sum("n_failed").alias("failed"), F.avg(share).alias("mean"),
                F.var_samp(share).alias("var"), F.avg(1 / F.col("n_docs")).alias("inverse")).select(
        (F.col("failed") / F.col("docs")).alias("p"), F.col("var"), F.col("inverse"))
    between = F.col("var") - F.col("p") * (1 - F.col("p")) * F.col("inverse")
    weight = F.when(between > 0, F.least(F.greatest(F.col("p") * (1 - F.col("p")) / between - 1, F.lit(PRIOR_DOCS[0])),
                                         F.lit(PRIOR_DOCS[1]))).otherwise(F.lit(PRIOR_DOCS[1]))
    prior = m.select("p", weight.alias("w")).first()
    p, w = (prior.p, prior.w) if prior.p is not None else (0.0, PRIOR_DOCS[1])
    rate = (F.col("n_failed") + F.lit(p * w)) / (F.col("n_docs") + F.lit(w))
    return per.select("host", "n_docs", "n_failed", rate.alias("rate"), (rate > HOST_RATE).alias("rejected"))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, COUNTS, base_failed, kept) of each row."""
    scratch = Scratch(df.sparkSession, "quality-rules")
    measured = scratch.keep(measure(df, id_col, text_col, host_col))
    bad = scratch.keep(hosts(measured).where("rejected").select("host", F.lit(True).alias("host_bad")))
    return (measured.join(bad, "host", "left").withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & F.col("host_bad").isNull()).drop("host_bad"))


def filter_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     host_col: str = "source") -> DataFrame:
    """The rows of ``df``, all columns, that pass: base rules are counted again where the text is, so no text is
    shuffled; only the rejected hosts are joined."""
    scratch = Scratch(df.sparkSession, "quality-rules")
    measured = scratch.keep(measure(df, id_col, text_col, host_col))
    name = "_bad_host"  # a name that no column of the rows has
    while name in {c.lower() for c in df.columns}:
        name += "_"
    bad = scratch.keep(hosts(measured).where("rejected").select(F.col("host").alias(name)))

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        got = [count(t) for t in texts]
        return pd.Series([g[0] >= MIN_WORDS and 100 * g[-1] <= 50 * g[0] for g in got], dtype=bool)

    return df.where(passes(F.col(text_col).cast("string"))).join(
        bad, F.col(host_col).cast("string") == F.col(name), "left_anti")
