"""Jobs: compositions of the operators."""

from herdloom.plans.dashboard import (
    animals_by_region,
    herds_by_year_type,
    inseminations_by_week,
    yield_by_breed_region,
)
from herdloom.plans.dataflow import milk_rows, weight_rows
from herdloom.plans.lactation import lactation_extract, lactation_rules
from herdloom.plans.pedigree import pedigree_extract, pedigree_rules
from herdloom.plans.testday import testday_report
from herdloom.plans.weight import weight_extract, weight_rules

__all__ = [
    "animals_by_region",
    "herds_by_year_type",
    "inseminations_by_week",
    "lactation_extract",
    "lactation_rules",
    "milk_rows",
    "pedigree_extract",
    "pedigree_rules",
    "testday_report",
    "weight_extract",
    "weight_rows",
    "weight_rules",
    "yield_by_breed_region",
]
