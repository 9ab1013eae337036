"""Reporting periods from labels (F2): rules of whole labels first, then those of what a longer label holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import normalised

_MONTH = "(?:мес\\.?|месяца|месяцев)"
# What labels say for each period.
MONTHS = {"3": "Q1", "6": "H1", "9": "9M", "12": "FY"}
QUARTERS = {"Q1": "1|I", "Q2": "2|II", "Q3": "3|III", "Q4": "4|IV"}
ORDINAL_QUARTERS = {"Q1": "первый", "Q2": "второй", "Q3": "третий", "Q4": "четвертый|четвёртый"}
HALVES = {"H1": "1|I|первое", "H2": "2|II|второе"}

WHOLE: list[tuple[str, str]] = [
    *((rf"^(\d{{4}})[\s,]+{n}\s+{_MONTH}$", p) for n, p in MONTHS.items()),
    *((rf"^(\d{{4}})[\s,]+(?:{q})\s+квартал$", p) for p, q in QUARTERS.items()),
    *((rf"^(?:{q}|{ORDINAL_QUARTERS[p]})\s+квартал[\s,]+(\d{{4}})$", p) for p, q in QUARTERS.items()),
    *((rf"^(?:{h})\s+полугодие[\s,]+(\d{{4}})$", p) for p, h in HALVES.items()),
    (r"^(\d{4})$", "FY"),
]
# What longer labels hold, # for the year, N for the number of a part, * for any ending.
OF_PART = {"за N квартал #": ("Q", 4), "за N полугодие #": ("H", 2)}
OF_YEAR = ("за # года", "за # год", "за # г.", "за # г", "Бухгалт* отчетность за #", "Бухгалт* отчётность за #")


def _holds(label: str, parts: int = 0) -> str:
    """Pattern of a label; between the year and what follows it blanks may lack."""
    pieces = {"#": r"(\d{4})", "N": f"([1-{parts}])", "*": r"\w+", ".": r"\.", " ": r"\s+"}
    return "".join(pieces.get(c, c) for c in label).replace(r"(\d{4})\s+", r"(\d{4})\s*") + r"(?!\w)"


#: the year is the second group, the number of the part the first
NUMBERED: list[tuple[str, str]] = [(_holds(label, n), letter) for label, (letter, n) in OF_PART.items()]
YEARLY: list[str] = [_holds(label) for label in OF_YEAR]


def reporting_period(label: Column) -> Column:
    """struct(year int, period string), or null if no rule fits."""
    text = normalised(label)
    tries: list[Column] = []

    def found(pattern: str, year_group: int, period: Column) -> None:
        flagged = f"(?iU){pattern}"
        year = F.regexp_extract(text, flagged, year_group).cast("int")
        tries.append(F.when(text.rlike(flagged), F.struct(year.alias("year"), period.alias("period"))))

    for pattern, period in WHOLE:
        found(pattern, 1, F.lit(period))
    for pattern, letter in NUMBERED:
        found(pattern, 2, F.concat(F.lit(letter), F.regexp_extract(text, f"(?iU){pattern}", 1)))
    for pattern in YEARLY:
        found(pattern, 1, F.lit("FY"))
    return F.coalesce(*tries)
