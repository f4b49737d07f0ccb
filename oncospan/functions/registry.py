"""Column rules for registry values: keys, codes, dates and TNM categories. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three-character ICD codes whose extent is classified by TNM.
TNM_CODES = [
    "C00", "C01", "C02", "C03", "C04", "C05", "C06", "C07", "C08", "C09", "C10", "C11", "C12", "C13", "C14", "C15",
    "C16", "C17", "C18", "C19", "C20", "C21", "C22", "C23", "C24", "C25", "C26",
    "C30", "C31", "C32", "C33", "C34",
    "C37", "C38",
    "C40", "C41",
    "C43", "C44", "C45", "C46", "C47", "C48", "C49", "C50", "C51", "C52", "C53", "C54", "C55", "C56", "C57", "C58",
    "C60", "C61", "C62", "C63", "C64", "C65", "C66", "C67", "C68", "C69", "C70",
    "C73", "C74", "C75", "C76",
    "C80",
    "C96",
    "D00", "D01", "D02", "D03", "D04", "D05", "D06", "D07",
    "D09",
    "D17",
    "D37", "D38", "D39", "D40", "D41",
    "D48",
]
# Codes for which T4 N0 M0 is invasive; every other TNM code has no extent for T4 N0 M0.
T4_INVASIVE = ["C34", "C50", "C64"]
# Overall tumor status -> disease dynamic. A code in neither list has no dynamic.
DYNAMIC_BY_STATUS = {"V": "Complete Remission", "R": "Complete Remission", "T": "Partial Remission",
                     "P": "Progression", "K": "Stable Disease", "B": "Stable Disease"}
# States that say nothing, so that the course speaks.
NO_STATUS = ["X", "U", "D", "Y"]
# Dynamic when the local, nodal and distant course agree on one state.
DYNAMIC_BY_COURSE = {"K": "Complete Remission", "T": "Partial Remission", "N": "Stable Disease"}
COURSE_STATES = ["K", "T", "P", "N", "R"]
UNKNOWN_DISTRICT = 17000


def as_date(c: Column) -> Column:
    return c.try_cast("date")


def as_int(c: Column) -> Column:
    return F.coalesce(c.try_cast("long"), c.try_cast("double").cast("long"))


def patient_key(patient_id: Column, register: Column) -> Column:
    return F.concat(patient_id.cast("string"), F.lit("_"), register.cast("string"))


def zero_filled(c: Column, width: int = 2) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def provider_key(district: Column, register: Column) -> Column:
    return F.concat(district.cast("long").cast("string"), zero_filled(register)).cast("long")


def icdo3_code(morphology: Column, topography: Column) -> Column:
    """Null when either part is null."""
    return F.concat(morphology, F.lit("-"), topography)


def without_space(token: Column) -> Column:
    """White space of any script goes, no-break spaces too."""
    return F.regexp_replace(token, r"(?U)\s+", "")


def clean_substance(token: Column) -> Column:
    """No white space, no trailing four-digit version."""
    return F.regexp_replace(without_space(token), r"\d{4}$", "")


def event_date(stated: Column, diagnosis: Column, days: Column) -> Column:
    return F.coalesce(stated, F.date_add(diagnosis, days.cast("int")))


def end_date(start: Column, days: Column) -> Column:
    return F.date_add(start, F.coalesce(days, F.lit(0)).cast("int"))


def _single_digit(value: Column, digits: str) -> Column:
    """The one listed digit the value contains, as a number; null when it contains none or several."""
    hits = reduce(Column.__add__, [F.contains(value, F.lit(d)).cast("int") for d in digits])
    return F.when(hits == 1, F.coalesce(*[F.when(F.contains(value, F.lit(d)), int(d)) for d in digits]))


def t_category(value: Column) -> Column:
    return F.when(F.contains(value, F.lit("is")), 1).otherwise(_single_digit(value, "01234"))


def n_category(value: Column) -> Column:
    return _single_digit(value, "0123")


def m_category(value: Column) -> Column:
    return _single_digit(value, "01")


def course_category(value: Column) -> Column:
    """0 for a complete response of the site, 1 for any other known state."""
    return F.when(value == "K", 0).when(value.isin(COURSE_STATES), 1)


def node_category(examined: Column, affected: Column) -> Column:
    return F.when(as_int(examined) >= as_int(affected), F.when(as_int(affected) == 0, 0).otherwise(1))


def disease_extent(icd3: Column, t: Column, n: Column, m: Column, t4_invasive: list[str]) -> Column:
    return (F.when(m >= 1, F.lit("Metastatic Disease"))
            .when(n >= 1, F.lit("Invasive Disease"))
            .when((t == 4) & icd3.isin(t4_invasive), F.lit("Invasive Disease"))
            .when((t == 4) & ~icd3.isin(T4_INVASIVE), F.lit(None))
            .when(t >= 1, F.lit("Confined Disease")))


def disease_dynamic(overall: Column, local: Column, nodes: Column, distant: Column) -> Column:
    status = F.lit(None).cast("string")
    for code, name in DYNAMIC_BY_STATUS.items():
        status = F.when(overall == code, name).otherwise(status)
    course = F.lit(None).cast("string")
    for code, name in DYNAMIC_BY_COURSE.items():
        course = F.when((local == code) & (nodes == code) & (distant == code), name).otherwise(course)
    return F.when(overall.isNull() | overall.isin(NO_STATUS), course).otherwise(status)
