"""The registered queries against their SQL, and the pipeline's stages."""

import random
import re

import pytest

from harness import compare, duck

import corpus_pipeline
from schemelens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name])
    assert ok, msg


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        docs = docs.cache()
        kept.append({r.doc_id: r.text for r in docs.collect()})
    raw, good, single, cut, clean = kept
    words = {i: re.findall("[^\x20\x09-\x0d]+", t) for i, t in raw.items()}
    assert all(len(words[i]) >= 50 for i in good) and len(good) > 0.8 * len(raw)
    assert set(single) < set(good) and set(cut) == set(single) == set(clean)
    assert sum(map(len, cut.values())) < sum(map(len, single.values()))
    assert not any(re.search(r"[a-z]@[a-z]+\.example", t) for t in clean.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(clean)


def edited(rng, w, n):
    """The words with ``n`` of them, far from each other, replaced."""
    out, gap = list(w), len(w) // n
    for i in range(n):
        out[i * gap + gap // 2] = f"new{rng.randrange(10**9)}"
    return out


def shingles(w, width):
    return set(zip(*(w[i:] for i in range(width))))


def test_near_duplicates_stage_takes_five_words(spark):
    """Texts that lie between the measures: near-duplicates by four words, not by five."""
    rng = random.Random(12)
    rows, groups = [], []
    for n_words, edits in ((200, 5), (120, 3), (200, 4), (200, 6), (120, 2)):
        for _ in range(4):
            w = [f"w{rng.randrange(10**9)}" for _ in range(n_words)]
            groups.append((len(rows), len(rows) + 1))
            rows += [w, edited(rng, w, edits)]
    sim = {k: [len(shingles(rows[a], k) & shingles(rows[b], k)) / len(shingles(rows[a], k) | shingles(rows[b], k))
               for a, b in groups] for k in (4, 5)}
    assert sum(x >= 0.8 for x in sim[4]) > sum(x >= 0.8 for x in sim[5]) > 0
    df = spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    want = set(range(len(rows))) - {b for (_, b), x in zip(groups, sim[5]) if x >= 0.8}
    assert {r.doc_id for r in stage(spark, df, SF).collect()} == want


def test_run_writes_every_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
