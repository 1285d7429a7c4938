"""The wide table for analysis: one row per doctor, 42 columns with dotted names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.codes import flag, full_year, military_name, school_parts, spreadsheet_text
from quirework.operators.tables import look_up

#: Two-digit years up to this one are of the 1900s. Fixed value.
PIVOT = 18
EMPTY, NONE = "", "NA"


def export_columns() -> dict[str, Column]:
    """The columns by name, in order, over doctors with their city_name and county_name. Fixed names."""
    state = F.upper("publication")
    school = school_parts(F.col("schools"))
    sch_state, sch_no = F.coalesce(school["state"], F.lit(NONE)), F.coalesce(school["number"], F.lit(NONE))
    ident = F.concat(state, F.lit("_"), F.substring(F.col("entry_id"), 6, 1_000))
    year = lambda c: F.coalesce(full_year(c, PIVOT).cast("string"), F.lit(EMPTY))
    blank, nothing = F.lit(EMPTY), F.lit(None).cast("string")
    return {
        "unique.id.normed": ident, "unique.id": ident, "physician.name": F.col("name"),
        "race.black": flag(F.col("col")), "race.black.prob": flag(F.col("col")),
        "orig.state": state, "corr.place.state": state, "orig.place.state": state,
        "orig.city": F.col("city_name"), "orig.county": F.col("county_name"),
        "linked.county.name": blank, "linked.county.GISJOIN2": blank, "linked.county.ICPSRST": blank, "linked.county.ICPSRCTY": blank,
        "school.state.edit": sch_state, "school.number": sch_no, "graduation.date": year(school["year"]),
        "ama.member": flag(F.col("ama_member")), "license.date": full_year(F.col("license_year"), PIVOT), "not.in.practice": flag(F.col("not_in_practice")),
        "doc.lat": blank, "doc.lon": blank, "match.source": blank, "match.type": F.lit("direct_extraction"),
        "school.code": F.when((sch_state != NONE) & (sch_no != NONE), F.concat_ws(".", sch_state, sch_no)).otherwise(F.lit(NONE)),
        "school.name": blank, "school.city": blank, "school.state": sch_state, "school.black": nothing, "school.fraudulent": nothing,
        "school.lat": blank, "school.lon": blank, "school.dist.km": blank,
        "birth.date": year(F.col("birth_year")), "ama.fellow": flag(F.col("ama_fellow")), "address": F.col("address"),
        "office.address": F.col("office"), "hours": spreadsheet_text(F.translate("hours", ";", ":")), "society.memberships": F.col("societies"),
        "specialties": F.translate("specialty", "★", "*"), "medical.corps": military_name(F.col("military")), "misc.info": F.col("other_info"),
    }


def export_wide(doctors: DataFrame, cities: DataFrame) -> DataFrame:
    """One row per doctor; a doctor without a known city has empty city and county names."""
    placed = look_up(doctors, "city_id", cities, "entry_id", {"city_name": "name", "county_name": "county_name"})
    return placed.select(*(c.alias(n) for n, c in export_columns().items()))
