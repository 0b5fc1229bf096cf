"""Eligibility of the whole population without citizen x scheme pairs (f01d, f01e).

The rule compares a citizen's age, income and land with bounds, and category,
location and gender with lists.  The bounds of all rules cut each number line
into intervals, and the lists name the values that matter, so citizens fall
into cells: six codes, equal for citizens whom no rule can tell apart.  NULL is
a code of its own (-1): NULL comparisons fail no rule.  The number of cells
follows from the rules, not from the population, which is read once and counted
per cell with partial sums.

* ``f01d``: the rule expression itself is evaluated once per cell and class of
  equal rules, on one member's values; counts per first failing test follow.
  Cells meet classes by their age interval (an equi-join).  Citizens outside
  the age bounds are the rest of the population.
* ``f01e``: a bitmap index holds, per code of each attribute, the schemes whose
  rule that code passes.  The six bitmaps of a cell are intersected and
  counted, and citizens look their cell up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemelens.functions import rules as R
from schemelens.functions.semantics import checkpoint_table
from schemelens.plans.rule_jobs import REASON_CODE_SQL
from schemelens.registry import register

#: Attribute of the citizen, and what the rules say of it: least value and largest value (with the next larger one).
BOUNDS = {"age": ("r_min_age", "r_max_age", "1"), "annual_income": ("r_min_income", "r_max_income", "0.01"),
          "land_holding_acres": ("r_min_land_acres", None, None)}
LISTS = {"category": "r_allowed_categories", "location_type": "r_location_type", "gender": "r_gender_restriction"}
NULL_CODE = -1


def usable_rules(cat) -> DataFrame:
    """Rules of the schemes that can be judged: active, with exactly one rules row."""
    schemes = cat.dim("scheme").where(~F.coalesce(F.col("is_active") == "N", F.lit(False))).select("scheme_id")
    return R.rules_by_scheme(cat["rules"]).where("r_count = 1").join(schemes, "scheme_id")


def _listed(name: str) -> Column:
    """Values that a rule names, or null where it names none ('ALL')."""
    required = F.col(LISTS[name])
    return F.when(required != "ALL", F.split(required, ",") if name == "category" else F.array(required))


def _least(name: str) -> Column:
    """A rule's least value; null where it does not bind (land of zero or less)."""
    least = F.col(BOUNDS[name][0])
    return F.when(least > 0, least) if name == "land_holding_acres" else least


def _above(name: str) -> Column:
    """The first value above a rule's largest."""
    _, most, step = BOUNDS[name]
    return F.col(most) + F.lit(step).cast("int" if name == "age" else "decimal(3,2)")


def breakpoints(rules: DataFrame) -> DataFrame:
    """One row: per bounded attribute the sorted values at which some rule changes, with the steps of a binary search;
    per listed attribute the values named."""
    cols = []
    for name, (_, most, _) in BOUNDS.items():
        points = F.array(_least(name), _above(name)) if most else F.array(_least(name))
        cols.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(points, lambda p: p.isNotNull())))))
                    .alias(name))
    for name in LISTS:
        cols.append(F.array_sort(F.array_distinct(F.flatten(F.collect_set(_listed(name))))).alias(name))
    row = rules.agg(*cols)
    powers = F.array(*(F.lit(1 << i) for i in range(30, -1, -1)))

    def searched(name: str) -> Column:
        return F.struct(F.col(name).alias("points"), F.filter(powers, lambda p: p <= F.size(name)).alias("steps")).alias(name)

    out = [searched(name) for name in BOUNDS]
    return row.select(F.struct(*out, *LISTS).alias("cuts"))


def interval(value: Column, cut: Column) -> Column:
    """How many of the sorted points are at most ``value``, by binary search."""
    at = F.aggregate(cut["steps"], F.lit(0), lambda pos, step: F.when(
        F.get(cut["points"], pos + step - 1) <= value, pos + step).otherwise(pos))
    return F.when(value.isNull(), F.lit(NULL_CODE)).otherwise(at)


def codes(cuts: Column) -> Column:
    """The cell of a citizen: six codes."""
    numbers = [interval(F.col(name), cuts[name]) for name in BOUNDS]
    values = [F.when(F.col(name).isNull(), F.lit(NULL_CODE)).otherwise(F.array_position(cuts[name], F.col(name)))
              for name in LISTS]
    return F.array(*(c.cast("int") for c in numbers + values))


def passing_codes(cuts: Column) -> list[Column]:
    """Per attribute, the codes that pass a rule's tests of it."""
    out = []
    for name, (_, most, _) in BOUNDS.items():
        low = F.when(_least(name).isNull(), F.lit(0)).otherwise(interval(_least(name), cuts[name]))
        last = F.size(cuts[name]["points"])
        high = F.when(F.col(most).isNull(), last).otherwise(interval(_above(name), cuts[name]) - 1) if most else last
        inside = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        out.append(F.concat(F.array(F.lit(NULL_CODE)), inside))
    for name in LISTS:
        out.append(F.concat(F.array(F.lit(NULL_CODE)), F.coalesce(
            F.array_distinct(_positions(_listed(name), cuts[name])), F.sequence(F.lit(0), F.size(cuts[name])))))
    return out


def _positions(values: Column, among: Column) -> Column:
    return F.transform(values, lambda v: F.array_position(among, v).cast("int"))


def cells_of(cat, cuts: Column) -> DataFrame:
    """(cell, citizens, one member's attributes) of every cell that has citizens."""
    one = [F.min(c).alias(c) for c in R.CITIZEN_RULE_COLUMNS]
    citizens = cat["citizen"].select(*R.CITIZEN_RULE_COLUMNS, cuts.alias("cuts"))
    return citizens.groupBy(codes(F.col("cuts")).alias("cell")).agg(F.count(F.lit(1)).alias("citizens"), *one)


@register("f01d_population_eligibility", oracle="select scheme_id, " + REASON_CODE_SQL
          + " as reason_code, count(*) as citizens from (select s.scheme_id, " + R.eligibility_reason_sql("c", "s", "r")
          + " as e from citizen c cross join scheme s left join " + R.RULES_BY_SCHEME_SQL
          + " r on s.scheme_id = r.scheme_id) t group by all")
def f01d_population_eligibility(cat) -> DataFrame:
    """Citizens per scheme and first failing test (or ELIGIBLE), over the whole population."""
    rules = usable_rules(cat)
    cuts = breakpoints(rules).scalar()
    cells = checkpoint_table(cells_of(cat, cuts))
    # schemes with equal rules are judged once
    attrs = [f"r_{c}" for c in R.RULE_COLUMNS]
    of_class = checkpoint_table(rules.select("scheme_id", F.to_json(F.struct(*attrs)).alias("class"), *attrs))
    classes = of_class.groupBy("class").agg(*(F.min(c).alias(c) for c in attrs))
    ages = classes.withColumn("cuts", cuts).select("class", *attrs, F.explode(passing_codes(F.col("cuts"))[0]).alias("age_code"))
    met = cells.withColumn("age_code", F.col("cell")[0]).join(ages, "age_code")
    told = (met.withColumns({"_s_found": F.lit(True), "_c_found": F.lit(True), "is_active": F.lit("Y"),
                             "r_count": F.lit(1)})
            .select("class", "citizens", R.eligibility_reason().alias("eligibility"))
            .groupBy("class", R.reason_code().alias("reason_code")).agg(F.sum("citizens").alias("citizens")))
    told = checkpoint_table(told)
    everyone = cells.agg(F.coalesce(F.sum("citizens"), F.lit(0)).alias("all")).scalar()
    too_old_or_young = (classes.select("class").join(told.groupBy("class").agg(F.sum("citizens").alias("met")), "class", "left")
                        .select("class", F.lit("AGE").alias("reason_code"),
                                (everyone - F.coalesce("met", F.lit(0))).alias("citizens")))
    judged = of_class.select("scheme_id", "class").join(told.unionByName(too_old_or_young), "class").drop("class")
    # schemes that fail before any citizen is looked at
    rest = cat["scheme"].select("scheme_id", "is_active").join(R.rules_by_scheme(cat["rules"]).select(
        "scheme_id", "r_count"), "scheme_id", "left").select(
        "scheme_id", F.when(F.col("is_active") == "N", "INACTIVE").when(F.col("r_count").isNull(), "NOT_FOUND")
        .when(F.col("r_count") > 1, "ERROR").alias("reason_code"), everyone.alias("citizens"))
    return judged.unionByName(rest.where("reason_code is not null")).where("citizens > 0").select(
        "scheme_id", "reason_code", "citizens")


def bitmap_index(rules: DataFrame, cuts: Column) -> DataFrame:
    """(attribute, code, bucket, schemes): which schemes a code of an attribute passes, as bitmaps of scheme ids."""
    passing = F.array(*(F.struct(F.lit(i).alias("attribute"), c.alias("codes"))
                        for i, c in enumerate(passing_codes(F.col("cuts")))))
    listed = rules.withColumn("cuts", cuts).select("scheme_id", F.explode(passing).alias("p")).select(
        "scheme_id", "p.attribute", F.explode("p.codes").alias("code"))
    return listed.groupBy("attribute", "code", F.bitmap_bucket_number("scheme_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("scheme_id")).alias("schemes"))


def schemes_per_cell(cells: DataFrame, index: DataFrame) -> DataFrame:
    """(cell, schemes): how many schemes pass all attributes of a cell."""
    told = cells.select("cell", F.posexplode("cell").alias("attribute", "code")).join(index, ["attribute", "code"])
    both = told.groupBy("cell", "bucket").agg(F.bitmap_and_agg("schemes").alias("schemes"), F.count(F.lit(1)).alias("n"))
    return both.where(F.col("n") == len(BOUNDS) + len(LISTS)).groupBy("cell").agg(
        F.sum(F.bitmap_count("schemes")).alias("schemes"))


@register("f01e_eligible_schemes", oracle="select c.citizen_id, count(*) filter ("
          + R.eligibility_reason_sql("c", "s", "r") + " = 'ELIGIBLE') as schemes from citizen c left join scheme s on true "
          "left join " + R.RULES_BY_SCHEME_SQL + " r on s.scheme_id = r.scheme_id group by c.citizen_id")
def f01e_eligible_schemes(cat) -> DataFrame:
    """Number of schemes whose rules each citizen passes."""
    rules = usable_rules(cat)
    cuts = breakpoints(rules).scalar()
    cells = cells_of(cat, cuts).select("cell")
    counts = checkpoint_table(schemes_per_cell(cells, bitmap_index(rules, cuts)))
    return (cat["citizen"].withColumn("cuts", cuts).select("citizen_id", codes(F.col("cuts")).alias("cell"))
            .join(cat.small(counts, "eligible_cells"), "cell", "left")
            .select("citizen_id", F.coalesce("schemes", F.lit(0)).cast("long").alias("schemes")))
