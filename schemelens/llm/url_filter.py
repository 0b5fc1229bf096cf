"""URL filters with empirical-Bayes host reputation (operator 13).

Hand-written rules (a host and the start of a path) decide the pages they fit;
of several the longest wins.  All other pages are judged by their host.

Page outcomes that are known (here: good or bad by a rule; callers may give
their own) are summed per host, registered domain and suffix.  The share of
bad pages is shrunk through three beta-binomial priors, each centred on the
level above: suffixes on all pages, domains on their suffix, hosts on their
domain.  The weight of each prior follows from how far children differ from
their parent beyond chance (moments over the whole table), and is never more
than what is known of the parent itself.  A host is blocked if the
lower bound of its posterior share, ``Z`` standard deviations below its mean,
exceeds ``BAD_SHARE``; so hosts of which little is known are allowed.

The counts of a host are summed before the shuffle, so a host with a third of
all pages is one row a task; only blocked hosts are joined back, which
adaptive execution splits where one host has most of the pages.

Results on odd input: a null url, or one without ``://``, has an empty host and
path, fits no rule and is allowed; an empty host has no reputation; repeated
rows count each; an empty table gives an empty table; only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import Scratch

#: A host whose lower bound of bad pages is above this share is blocked.
BAD_SHARE = 0.5
#: Standard deviations of the posterior bound.
Z = 1.645
#: Smallest and largest weight of a prior, in pages.
PRIOR_PAGES = (2.0, 1000.0)
#: Suffixes of two labels under which domains are registered; any other suffix is the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "co.za", "com.cn")

ADDRESS = r"^[0-9]+(\.[0-9]+){3}$|^\["


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) text after the first ``://`` up to a slash, question mark or hash; empty without."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), string.ascii_uppercase,
                       string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; of equally long ones the longer host's."""
    by_length = sorted(set(rules), key=lambda r: (-len(r.text), -len(r.host), r.text))
    if len({(r.host, r.path) for r in by_length}) < len(by_length):
        raise ValueError("a rule both allows and blocks")
    chosen = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
                     F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in by_length]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*chosen, none)


def suffix_of(host: Column) -> Column:
    """Suffix under which names are registered: one of SUFFIXES, else the last label; an address is its own."""
    two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(ADDRESS), host).when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label before it."""
    labels = F.when(suffix.isin(*SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return F.when(suffix == host, host).otherwise(labels)


def bare(host: Column) -> Column:
    """The host without user, port and closing dot."""
    for part in (r"\A.*@", r":[0-9]*\z", r"\.\z"):
        host = F.regexp_replace(host, part, "")
    return host


def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def prior_weight(children: DataFrame, parent: list[str]) -> float:
    """Weight in pages of the beta prior of ``children`` (n, bad) around the rate of their ``parent``.

    Moments: the squared distances of children from their parent's rate,
    summed over all parents, less what binomial sampling explains, give the
    intraclass correlation rho; the weight is 1 / rho - 1, within PRIOR_PAGES.
    Children without a known outcome say nothing.
    """
    known = children.where("n > 0")
    share = F.col("bad") / F.col("n")
    per = known.groupBy(*parent).agg(F.count("*").alias("k"), F.sum("n").alias("total"), F.sum("bad").alias("all_bad"),
                                     F.sum(F.col("n") * F.col("n")).alias("squares"),
                                     F.sum(F.col("n") * share * share).alias("raw"))
    rate = F.col("all_bad") / F.col("total")
    v = rate * (1 - rate)
    spread = F.col("raw") - F.col("total") * rate * rate
    chance = v * (F.col("k") - 1)
    room = v * (F.col("total") - F.col("squares") / F.col("total") - (F.col("k") - 1))
    got = per.agg(F.sum(spread - chance).alias("over"), F.sum(room).alias("room")).first()
    least, most = PRIOR_PAGES
    if not got.room or got.room <= 0 or got.over <= 0:
        return most
    return min(max(got.room / got.over - 1, least), most)


def reputation(outcomes: DataFrame) -> DataFrame:
    """(host, n, bad, share, bound, blocked) of every host of ``outcomes`` (host, bad: boolean or null where unknown)."""
    scratch = Scratch(outcomes.sparkSession, "url-filter")
    per_host = outcomes.where(F.col("host") != "").groupBy("host").agg(
        F.count("bad").alias("n"), F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad"))
    name = bare(F.col("host"))
    placed = scratch.keep(per_host.withColumn("suffix", suffix_of(name)).withColumn(
        "domain", domain_of(name, F.col("suffix"))))
    domains = scratch.keep(_sums(placed, ["suffix", "domain"]))
    suffixes = scratch.keep(_sums(domains, ["suffix"]))
    weights = [prior_weight(placed, ["domain"]), prior_weight(domains, ["suffix"]), prior_weight(suffixes, [])]
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    centre = ((total.bad or 0) + 0.5) / ((total.n or 0) + 1)

    def shrunk(prior: Column, weight: Column, name: str) -> list[Column]:
        """Posterior share and weight."""
        return [((F.col("bad") + prior * weight) / (F.col("n") + weight)).alias(f"of_{name}"),
                (F.col("n") + weight).alias(f"known_{name}")]

    weight = F.lit(min(weights[2], (total.n or 0) + 1.0))
    top = suffixes.select("suffix", *shrunk(F.lit(centre), weight, "suffix"))
    weight = F.least(F.lit(weights[1]), F.col("known_suffix"))
    mid = domains.join(top, "suffix").select("domain", *shrunk(F.col("of_suffix"), weight, "domain"))
    weight = F.least(F.lit(weights[0]), F.col("known_domain"))
    share, known = shrunk(F.col("of_domain"), weight, "host")
    judged = placed.join(mid, "domain").select("host", "n", "bad", share.alias("share"), known.alias("known"))
    deviation = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("known") + 1))
    bound = F.col("share") - Z * deviation
    return judged.select("host", "n", "bad", "share", bound.alias("bound"), (bound > BAD_SHARE).alias("blocked"))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
          bad: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict) of each page.

    ``bad`` says which pages are known to be bad (true), good (false) or
    neither (null); without it the pages that a rule decides are the known
    ones.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    known = F.lit(None).cast("boolean") if bad is None else bad.cast("boolean")
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"), known.alias("bad"))
    ruled = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    if bad is None:
        ruled = ruled.withColumn("bad", F.col("rule.verdict") == "block")
    blocked = Scratch(pages.sparkSession, "url-filter").keep(
        reputation(ruled.select("host", "bad")).where("blocked").select("host", F.lit("block").alias("host_verdict")))
    return ruled.join(blocked, "host", "left").select(
        id_col, "host", "path", F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", "host_verdict", F.lit("allow")).alias("verdict"))
