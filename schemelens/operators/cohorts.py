"""Target cohorts (c01..c03): the citizen selections the modelled generator
draws its sample applications from, as reusable selections.

A cohort is every citizen that meets its conditions.  ``cap`` asks for the
first n of them by id (a top-k, no full sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.registry import register

# Cohort filters.
FARM_OCCUPATIONS = ("Farmer", "Agricultural Labourer")
FARM_LAND = (0.1, 5)
FARM_INCOME = 250000
RURAL_INCOME = 100000
HEALTH_INCOME = 500000

COLS = ["citizen_id", "full_name", "occupation", "land_holding_acres", "annual_income", "location_type"]
COLS_SQL = "citizen_id, full_name, occupation, cast(land_holding_acres as double) as land_holding_acres, " \
           "cast(annual_income as double) as annual_income, location_type"


def _first(df: DataFrame, cap: int | None) -> DataFrame:
    return df if cap is None else df.orderBy("citizen_id").limit(cap)


@register("c01_farm_cohort", oracle=f"""select {COLS_SQL} from citizen where occupation in {FARM_OCCUPATIONS!r}
 and land_holding_acres between {FARM_LAND[0]} and {FARM_LAND[1]} and annual_income < {FARM_INCOME}""")
def c01_farm_cohort(cat, cap: int | None = None) -> DataFrame:
    """Farmers with 0.1..5 acres and income under 250000."""
    c = cat["citizen"]
    return (c.filter(F.col("occupation").isin(*FARM_OCCUPATIONS)
                     & F.col("land_holding_acres").between(*FARM_LAND) & (F.col("annual_income") < FARM_INCOME))
            .select(*COLS).transform(_first, cap))


@register("c02_rural_low_income", oracle=f"""select {COLS_SQL} from citizen where annual_income < {RURAL_INCOME}
 and location_type = 'RURAL'""")
def c02_rural_low_income(cat, cap: int | None = None) -> DataFrame:
    """Rural citizens with income under 100000."""
    c = cat["citizen"]
    return (c.filter((F.col("annual_income") < RURAL_INCOME) & (F.col("location_type") == "RURAL"))
            .select(*COLS).transform(_first, cap))


@register("c03_health_cohort", oracle=f"""select {COLS_SQL} from citizen where annual_income < {HEALTH_INCOME}""")
def c03_health_cohort(cat, cap: int | None = None) -> DataFrame:
    """Citizens with income under 500000."""
    return cat["citizen"].filter(F.col("annual_income") < HEALTH_INCOME).select(*COLS).transform(_first, cap)
