"""Spelling variants by dynamic programming over sorted word lists (operator 12).

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  To find all near pairs, words are cut into segments by length:
near words agree outside one segment, so a word is listed under each "all but
segment i" of its own length and of the length below (where it is the longer
word of a pair).  A list holds the segments' contents (middles) of words that
agree elsewhere, in sorted order, and is scanned once per word: the banded
edit matrix of word and list entry keeps three cells a row, rows are reused
through the common prefix of adjacent entries, and when no cell of a row is
below two, every entry that shares that prefix is skipped.

Lists are counted first.  Those with more than ``LIST_WORDS`` words are
listed again with twice as many segments, so that a list which holds a third
of all words is split by its own letters, down to segments of one code point,
where a list cannot outgrow the alphabet.  A pair is reported only in the list
of the segment where its words first differ, so no pair comes twice and no
duplicates are removed.

A word's form is its near word with the largest count, if that is ``RATIO``
times its own or more.  Counts grow along forms, so roots are found by pointer
doubling in a few rounds.

Results on odd input: null texts have no words; an empty table gives an empty
vocabulary and no pairs; a word list with repeated words is summed first, null
words are left out; words of any length are compared whole; of equally
frequent near words the first in code-point order is the form.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import Scratch

#: Segments of a word at first, and words of a list above which it is listed again in twice as many.
SEGMENTS = 4
LIST_WORDS = 128
#: How many times as frequent as a word its form is at least.
RATIO = 10
DEAD = 2


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def scan(middles: list[str], longer: list[bool], last: bool) -> list[tuple[int, int]]:
    """Index pairs (a < b) of the sorted ``middles`` that are one edit apart.

    ``longer`` marks entries of the greater length (one code point more); two of
    those are a pair of another list.  Unless this is the ``last`` segment, an
    entry and its continuation belong to a later segment's list.
    """
    n, out = len(middles), []
    shared = [0] + [common_prefix(middles[i - 1], middles[i]) for i in range(1, n)]
    for a in range(n - 1):
        q, lq = middles[a], len(middles[a])
        rows = [(DEAD, 0, 1)]  # cells at columns depth - 1, depth, depth + 1
        b, keep = a + 1, shared[a + 1]
        while b < n:
            w = middles[b]
            del rows[min(keep, shared[b]) + 1:]
            x, y, z = rows[-1]
            depth, size = len(rows) - 1, len(w)
            while depth < size:
                c = w[depth]
                x2 = min(x + (c != q[depth - 1]), y + 1) if 0 < depth <= lq else (y + 1 if depth == 0 else DEAD)
                y2 = min(y + (c != q[depth]), z + 1, x2 + 1) if depth < lq else DEAD
                z2 = min(z + (c != q[depth + 1]), y2 + 1) if depth + 1 < lq else DEAD
                depth += 1
                x, y, z = x2, y2, z2
                rows.append((x, y, z))
                if x >= DEAD and y >= DEAD and z >= DEAD:
                    break
            else:
                d = (x, y, z)[lq - size + 1] if -2 < lq - size < 2 else DEAD
                if d == 1 and not (longer[a] and longer[b]) and (
                        last or not (w.startswith(q) or q.startswith(w)) or lq == size):
                    out.append((a, b))
                keep = size
                b += 1
                continue
            # no cell is alive at this depth: nothing with the same first ``depth`` code points is near
            b += 1
            while b < n and shared[b] >= depth:
                b += 1
            keep = depth - 1
    return out


LISTED = "list long, size int, segment int, longer boolean, middle string, word string, n long"


def listed(words: DataFrame, segments: int) -> DataFrame:
    """Rows of LISTED: every (word, n) under all but each of ``segments`` segments of both lengths.

    ``words`` may name the only lists to refine: columns size and segment (of
    half as many segments) then say in which the word was.
    """
    length = F.length("word")
    if "segment" in words.columns:
        halves = F.array(2 * F.col("segment"), 2 * F.col("segment") + 1)
        at = words.select("word", "n", "size", F.explode(halves).alias("segment"))
    else:
        at = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size")).where("size >= 0").select(
            "word", "n", "size", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"))
    start = F.expr(f"cast(segment * cast(size as bigint) div {segments} as int)")
    end = F.expr(f"cast((segment + 1) * cast(size as bigint) div {segments} as int)")
    cut = at.select("word", "n", "size", "segment", start.alias("start"), (F.col("size") - end).alias("tail"))
    # an empty segment can only hold an insertion, which belongs to the segment after it, or to the last
    cut = cut.where((F.col("start") + F.col("tail") < F.col("size")) | (F.col("segment") == segments - 1))
    middle = F.substring("word", F.col("start") + 1, F.length("word") - F.col("start") - F.col("tail"))
    after = F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail"))
    return cut.select(
        F.xxhash64("size", "segment", F.substring("word", F.lit(1), F.col("start")), after).alias("list"), "size",
        "segment", (F.length("word") > F.col("size")).alias("longer"), middle.alias("middle"), "word", "n")


def scan_lists(rows: DataFrame, segments: int) -> DataFrame:
    """(word, n, near, near_n) of the near pairs in the lists of ``rows`` (LISTED), each pair once."""
    dealt = rows.repartition("list").sortWithinPartitions("list", "size", "segment", "middle")

    def pairs(entries):
        """Near pairs of entries (list, size, segment, longer, middle, word, n) with one list number."""
        size, segment = entries[0][1], entries[0][2]
        if any(e[1] != size or e[2] != segment for e in entries):  # two lists with one number
            for other in {e[1:3] for e in entries}:
                yield from pairs([e for e in entries if e[1:3] == other])
            return
        start, tail = segment * size // segments, size - (segment + 1) * size // segments
        for a, b in scan([e[4] for e in entries], [e[3] for e in entries], segment == segments - 1):
            u, v = entries[a][5], entries[b][5]
            if u[:start] == v[:start] and u[len(u) - tail:] == v[len(v) - tail:]:
                yield u, entries[a][6], v, entries[b][6]

    def run(batches):
        held = []
        for batch in batches:
            out = []
            for entry in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != entry[0]:
                    if len(held) > 1:
                        out.extend(pairs(held))
                    held = []
                held.append(entry)
            yield _pairs_batch(out)
        yield _pairs_batch(list(pairs(held)) if len(held) > 1 else [])

    return dealt.mapInArrow(run, "word string, n long, near string, near_n long")


def _pairs_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["word", "n", "near", "near_n"])


def near_pairs(words: DataFrame, scratch: Scratch, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, n, near, near_n): each pair of ``words`` (word, n; distinct) one edit apart, once."""
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    segments, found, todo = SEGMENTS, [], words
    while True:
        rows = listed(todo, segments)
        counts = rows.groupBy("list").agg(F.count("*").alias("words")).where("words > 1")
        shared = scratch.keep(rows.join(counts, "list"))
        final = segments >= longest  # segments of one code point
        found.append(scratch.keep(scan_lists(
            (shared if final else shared.where(F.col("words") <= list_words)).drop("words"), segments)))
        todo = shared.where(F.col("words") > list_words).select("word", "n", "size", "segment")
        if final or todo.isEmpty():
            return _union(found)
        segments *= 2


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): where following forms ends."""
    at = scratch.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.keep(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(at)
        at = moved
        if moved.where("moved").isEmpty():
            return at.select("word", "root")


def group_variants(words: DataFrame, ratio: int = RATIO, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each distinct word of ``words`` (word, n: long)."""
    scratch = Scratch(words.sparkSession, "spelling")
    vocabulary = scratch.keep(words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    pairs = near_pairs(vocabulary, scratch, list_words)
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    counts = both.groupBy("word").agg(F.count("*").alias("n_near"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    forms = scratch.keep(both.where(F.col("near_n") >= ratio * F.col("n")).groupBy("word").agg(best.alias("best"))
                         .select("word", "best.form", (-F.col("best.less")).alias("form_n")))
    return (vocabulary.join(counts, "word", "left").join(forms, "word", "left").join(roots(forms, scratch), "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))
