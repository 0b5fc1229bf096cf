"""Fill-in-middle transformation by counted quantifiers (operator 11).

A text is read as units (tokens with the white space before them, a last run
of white space alone).  ``regexp_count`` gives their number n.  Two cut points
a <= b drawn from a hash of the row's id make a pattern for that row,
``unit{a}`` and ``unit{b-a}`` as possessive groups and the rest, and one
``regexp_replace`` with it puts prefix, middle and suffix in the order of the
row's form.  Possessive groups are matched in a loop and never given back, so
neither the stack nor the time grows faster than the text.  Everything is a
map over rows of built-in functions.

Forms: ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) and
``spm`` (suffix, prefix, middle).  A text that holds a sentinel stays plain,
so every output can be taken apart again (``restore``).

Results on odd input: null texts are empty; empty texts are plain with n = 0;
texts of any length are cut whole; a null id counts as an empty string in the
hash; repeated rows are cut alike; an empty table gives an empty table; the
columns added replace none of the input, which is returned as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One unit; its character classes exclude each other, so possessive quantifiers match what greedy ones would.
UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of the texts that are cut, and percent of those whose suffix comes first.
CUT_PERCENT = 50
SPM_PERCENT = 80


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(row, n, form, output): the input row as a struct, its units, its form and the transformed text."""
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    rows = df.select(F.struct("*").alias("row")).select("row", text.alias("text"))
    counted = rows.select("row", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                          *(h.alias(f"h{i}") for i, h in enumerate(draws(F.col("row")[id_col], seed), 1)))
    x, y = (F.pmod(F.col(h), F.col("n") + 1) for h in ("h1", "h2"))
    marked = [F.contains("text", F.lit(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("n") == 0) | marked[0] | marked[1] | marked[2] | (F.col("h3") % 100 >= cut_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    cut = counted.select("row", "text", "n", F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), form.alias("form"))
    pattern = F.concat(F.lit(rf"(?s)\A({UNIT}{{"), F.col("a"), F.lit(rf"}}+)({UNIT}{{"), F.col("b") - F.col("a"),
                       F.lit(r"}+)(.*)\z"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return cut.select("row", "n", "form", output.alias("output"))


def parts(output: str = "output", form: str = "form") -> Column:
    """Struct (prefix, middle, suffix) read back from an output; null for plain ones."""
    def between(first: str, last: str) -> Column:
        head = F.substring_index(output, last, 1)
        return F.substring_index(head, first, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    return F.when(F.col(form) == "psm", F.struct(
        between(PREFIX, SUFFIX).alias("prefix"), middle.alias("middle"), between(SUFFIX, MIDDLE).alias("suffix"))
    ).when(F.col(form) == "spm", F.struct(
        between(PREFIX, MIDDLE).alias("prefix"), middle.alias("middle"), between(SUFFIX, PREFIX).alias("suffix")))


def restore(parts_col: Column, output: str = "output") -> Column:
    """The exact text that ``transform`` was given (empty for null)."""
    return F.when(parts_col.isNull(), F.col(output)).otherwise(
        F.concat(parts_col["prefix"], parts_col["middle"], parts_col["suffix"]))
