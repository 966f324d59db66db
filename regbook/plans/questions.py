"""The catalogue of 24 business questions over the clean table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import count_by, distinct_by, mean_by, sum_by
from ..operators.lookups import with_lookup
from ..operators.ranking import (
    above_group_mean,
    first_per_group,
    gap_to_group_min,
    leaders_per_group,
    running_count,
    share_within,
    top_groups,
    top_rows,
)
from ..schema import RegistryTerms


@dataclass(frozen=True)
class Registry:
    """The clean table, its two lookups and the literals asked about."""

    clean: DataFrame
    regions: DataFrame
    operations: DataFrame
    terms: RegistryTerms = field(default_factory=RegistryTerms)

    def where(self, **wanted) -> DataFrame:
        """Clean rows whose columns equal the given values."""
        conditions = [F.col(c) == v for c, v in wanted.items()]
        return self.clean.filter(reduce(Column.__and__, conditions))


def _by_region(df: DataFrame, r: Registry) -> DataFrame:
    return with_lookup(df, r.regions, "REG_ADDR_KOATUU")


def _by_operation(df: DataFrame, r: Registry) -> DataFrame:
    return with_lookup(df, r.operations, "OPER_CODE")


def q01(r: Registry) -> DataFrame:
    """Registrations per known region."""
    return count_by(_by_region(r.clean, r), ["REGION_NAME"])


def q02(r: Registry) -> DataFrame:
    """Five leading brands of the capital."""
    capital = r.regions.filter(F.col("REGION_NAME") == r.terms.capital)
    return top_groups(with_lookup(r.clean, capital, "REG_ADDR_KOATUU"), "BRAND", 5)


def q03(r: Registry) -> DataFrame:
    """Electric vehicles with the text of their operation."""
    electric = _by_operation(r.where(FUEL=r.terms.electric), r)
    return electric.select("BRAND", "MODEL", "OPER_DESC", "MAKE_YEAR")


def q04(r: Registry) -> DataFrame:
    """Mean age of passenger cars per operation."""
    cars = _by_operation(r.where(KIND=r.terms.passenger), r)
    return mean_by(cars, ["OPER_DESC"], "AGE", "avg_age", 1)


def q05(r: Registry) -> DataFrame:
    """Total weight of trucks per region."""
    trucks = _by_region(r.where(KIND=r.terms.truck), r)
    return sum_by(trucks, ["REGION_NAME"], "TOTAL_WEIGHT", "sum_weight")


def q06(r: Registry) -> DataFrame:
    """Operations on one brand."""
    return count_by(_by_operation(r.where(BRAND=r.terms.brand), r), ["OPER_DESC"])


def q07(r: Registry) -> DataFrame:
    """Mean engine capacity of diesel vehicles per region."""
    diesel = _by_region(r.where(FUEL=r.terms.diesel), r)
    return mean_by(diesel, ["REGION_NAME"], "CAPACITY", "avg_cap", 0)


def q08(r: Registry) -> DataFrame:
    """New vehicles per operation."""
    new = r.clean.filter(F.col("AGE") <= r.terms.new_age)
    return count_by(_by_operation(new, r), ["OPER_DESC"])


def q09(r: Registry) -> DataFrame:
    """Leading brand of every body type."""
    return leaders_per_group(r.clean, "BODY", "BRAND")


def q10(r: Registry) -> DataFrame:
    """Heaviest vehicle of every brand."""
    return first_per_group(r.clean, ["BRAND"], ["MODEL"], "TOTAL_WEIGHT", largest=True)


def q11(r: Registry) -> DataFrame:
    """Vehicles whose engine is larger than their brand's mean."""
    return above_group_mean(r.clean.filter(F.col("CAPACITY") > 0), ["BRAND"], "CAPACITY", "avg_brand")


def q12(r: Registry) -> DataFrame:
    """Running count of the tracked colours by make year."""
    tracked = r.clean.filter(F.col("COLOR").isin(*r.terms.tracked_colours))
    return running_count(tracked, "COLOR", "MAKE_YEAR")


def q13(r: Registry) -> DataFrame:
    """Three most popular motorcycle colours."""
    return top_groups(r.where(KIND=r.terms.motorcycle), "COLOR", 3)


def q14(r: Registry) -> DataFrame:
    """Years between each vehicle and the newest of its model."""
    compared = gap_to_group_min(
        r.clean.select("BRAND", "MODEL", "AGE"), ["BRAND", "MODEL"], "AGE", "age_diff"
    )
    return compared.select("BRAND", "MODEL", "AGE", "age_diff")


def q15(r: Registry) -> DataFrame:
    """Share of each fuel within its brand."""
    return share_within(r.clean, "BRAND", "FUEL")


def q16(r: Registry) -> DataFrame:
    """First registration of every brand."""
    return first_per_group(r.clean, ["BRAND"], ["MODEL"], "D_REG")


def q17(r: Registry) -> DataFrame:
    """Registrations of one calendar month per brand."""
    return count_by(r.where(REG_MONTH=r.terms.month), ["BRAND"])


def q18(r: Registry) -> DataFrame:
    """Mean load of special vehicles per body type."""
    load = F.col("TOTAL_WEIGHT") - F.col("OWN_WEIGHT")
    return mean_by(r.where(PURPOSE=r.terms.special), ["BODY"], load, "avg_load", 1)


def q19(r: Registry) -> DataFrame:
    """Recent red passenger cars."""
    red = r.where(COLOR=r.terms.red, KIND=r.terms.passenger)
    return red.filter(F.col("MAKE_YEAR") > r.terms.after_year)


def q20(r: Registry) -> DataFrame:
    """Distinct hybrid models per brand."""
    words = [F.col("FUEL").contains(word) for word in r.terms.hybrid_words]
    hybrids = r.clean.filter(reduce(Column.__and__, words))
    return distinct_by(hybrids, ["BRAND"], "MODEL", "hybrid_models")


def q21(r: Registry) -> DataFrame:
    """Ten oldest vehicles."""
    shown = r.clean.select("BRAND", "MODEL", "MAKE_YEAR", "AGE")
    return top_rows(shown, [F.desc_nulls_last("AGE")], 10, ["BRAND", "MODEL", "MAKE_YEAR"])


def q22(r: Registry) -> DataFrame:
    """Vehicles of unknown colour per brand."""
    return count_by(r.where(COLOR=r.terms.unknown), ["BRAND"])


def q23(r: Registry) -> DataFrame:
    """Mean engine capacity of the compared brands."""
    compared = r.clean.filter(F.col("BRAND").isin(*r.terms.compared_brands))
    return mean_by(compared, ["BRAND"], "CAPACITY", "avg_cap", 0)


def q24(r: Registry) -> DataFrame:
    """Implausibly light vehicles."""
    light = r.clean.filter(F.col("TOTAL_WEIGHT") < r.terms.light_weight)
    return light.select("KIND", "BRAND", "MODEL", "TOTAL_WEIGHT")


QUESTIONS: dict[int, Callable[[Registry], DataFrame]] = {
    number: globals()[f"q{number:02d}"] for number in range(1, 25)
}
