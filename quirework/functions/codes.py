"""Decoding of directory codes: years, licences, schools, military marks, identifiers and file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that a publication's short name leaves out but for a letter, in this order. Fixed values.
SHORTENED = (("New ", "N"), ("North ", "N"), ("South ", "S"), ("West ", "W"))
#: Marks of commissions. Fixed values.
MILITARY = {"▼": "Army Reserve", "▼G": "National Guard", "▼N": "Navy Reserve"}
#: Licence codes: granted before the record began, unknown, by exemption. Fixed values.
LICENCE = {-1: "earlier", -2: "unknown", -3: "exempt"}
#: Steps of confidence and their colours. Fixed values.
COLOURS = ((0.99, "green", ">="), (0.98, "yellow", ">="), (0.95, "orange", ">"))


def publication_short(publication: Column) -> Column:
    short = reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), SHORTENED, publication)
    return F.substring(short, 1, 4)


def entry_id(publication: Column, page: Column, column: Column, row: Column) -> Column:
    """Short publication, page, column and row as one identifier."""
    return F.format_string("%s_%03d_%02d_%06d", publication_short(publication), page, column, row)


def column_entry_id(publication: Column, page: Column, column: Column, ordinal: Column) -> Column:
    """The identifier of an entry by its place within its column."""
    return F.format_string("%s_p%03d_c%03d_e%03d", publication, page, column, ordinal)


def snippet_name(publication: Column, page: Column, column: Column) -> Column:
    return F.format_string("%s_p%02d_r00_c%03d.jpg", publication, page, column)


def parse_request_key(key: Column) -> Column:
    """struct(publication, page, row, col) of a request key such as a_b_Name_p01_r00_c000.jpg; null if the
    name has fewer than six parts. Only what stands before the first dot counts."""
    parts = F.split(F.substring_index(key, ".", 1), "_")
    number = lambda k: F.substring(F.get(parts, k), 2, 9).try_cast("int")
    return F.when(
        F.size(parts) >= 6,
        F.struct(F.get(parts, F.lit(2)).alias("publication"), number(F.lit(3)).alias("page"), number(F.lit(4)).alias("row"), number(F.lit(5)).alias("col")),
    )


def full_year(year: Column, pivot: int) -> Column:
    """A year of four digits: two digits up to `pivot` are of the 1900s, others of the 1800s; one digit is a
    year whose leading zero was lost; codes and other text give null."""
    y = F.regexp_replace(F.trim(year), "^['\"]+|['\"]+$", "")
    two = F.lpad(y, 2, "0").try_cast("int")
    return (
        F.when(y.rlike("^[0-9]{4}$"), y.try_cast("int"))
        .when(y.rlike("^[0-9]{1,2}$"), F.when(two <= pivot, two + 1900).otherwise(two + 1800))
        .otherwise(F.lit(None).cast("int"))
    )


def licence_status(year: Column) -> Column:
    """What the licence field says: a year, one of the coded cases, or nothing."""
    code = F.trim(year).try_cast("int")
    coded = reduce(lambda c, kv: c.when(code == kv[0], kv[1]), LICENCE.items(), F.when(F.lit(False), ""))
    return coded.when(full_year(year, 18).isNotNull(), "year").otherwise("none")


def school_parts(schools: Column) -> Column:
    """struct(state, number, year text) of the first school of a field: the state in capitals and the number
    are split at the last dot before the first comma; null where they are missing."""
    first = F.trim(F.split_part(schools, F.lit(","), F.lit(1)))
    take = lambda k: F.nullif(F.regexp_extract(first, r"(?s)^(.*)\.([^.]*)$", k), F.lit(""))
    year = F.regexp_replace(F.trim(F.split_part(schools, F.lit(","), F.lit(2))), "^['\"]+|['\"]+$", "")
    return F.struct(F.upper(take(1)).alias("state"), take(2).alias("number"), F.nullif(year, F.lit("")).alias("year"))


def flag(boolean: Column) -> Column:
    """1 for true, 0 for false and null; also of the words True and False."""
    return F.coalesce(boolean.try_cast("boolean"), F.lit(False)).cast("int")


def military_name(mark: Column) -> Column:
    return reduce(lambda c, kv: c.when(mark == kv[0], kv[1]), MILITARY.items(), F.when(F.lit(False), "")).otherwise(mark)


def spreadsheet_text(text: Column) -> Column:
    """Text that a spreadsheet takes as text; null stays null."""
    return F.concat(F.lit('="'), text, F.lit('"'))


def confidence_colour(conf: Column) -> Column:
    c = F.when(F.lit(False), "")
    for least, name, how in COLOURS:
        c = c.when(conf >= least if how == ">=" else conf > least, name)
    return c.otherwise("red")


def member_by_capitals(name: Column) -> Column:
    """Members are printed in capitals; one small letter is allowed for names such as McKAY."""
    return F.length(F.regexp_replace(name, r"[^\p{Ll}]", "")) <= 1
