"""Patterns of numbered bill text, as predicates and captures over columns.

``(?U)`` makes white space and word boundaries mean the Unicode ones, so a no-break space counts as space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line forms of the documents.
LINE_NUMBER = r"(?U)^\s{0,3}(\d{1,3})\s+(.*)$"
LINE_PREFIX = r"(?U)^(\s{0,3}\d{1,3}\s+)"
PROGRAM_NAME = r"[A-Z][A-Z0-9 ,&'\-/]*(?:\s+PROGRAM|\s*\([A-Z]+(?:\s+[A-Z]+)?\))"
PROGRAM = rf"(?U)^({PROGRAM_NAME})\s*$"
PROGRAM_AMOUNT = rf"(?U)^({PROGRAM_NAME})\s*\.{{2,}}\s*\$?[\d,]+\s*$"
PROGRAM_SECOND_LINE = r"(?U)^(PROGRAM|\([A-Z]+(?:\s+[A-Z]+)?\))\s*\.{2,}\s*\$?[\d,]+\s*$"
CAPS_LINE = r"(?U)^[A-Z][A-Z0-9 ,&'\-/]*[A-Z]\s*$"
# The names that the documents' alternation of fund families stands for, as lines must equal one of them.
FUND_FAMILIES = ("General Fund", "Special Revenue Funds - Federal", "Special Revenue Funds - Other", "Capital Projects Fund", "Capital Projects Funds", "Capital Projects Fund - Federal", "Capital Projects Fund - Other", "Capital Projects Funds - Federal", "Capital Projects Funds - Other", "Enterprise Funds", "Fiduciary Funds")
CHAPTER_YEAR = r"(?iU)^(?:By|The\s+appropriations?\s+made\s+by)\s+chapter\s+\d+.*?of\s+the\s+laws\s+of\s+(\d{4})(?:.*?as\s+(?:amended|added)\s+by\s+chapter\s+\d+.*?of\s+the\s+laws\s+of\s+(\d{4}))?"
LAWS_OF = r"(?U)of\s+the\s+laws\s+of\s+(\d{4})"
CARRIED_AMOUNT = r"(?U)\(re\.\s*\$?([\d,]+)\s*\)"
END_AMOUNT = r"(?U)\.{2,}\s*\$?([\d,]+)\s*$"
DOTS_AMOUNT = r"(?U)\.{2,}\s*\$?([\d,]+)"
AMOUNT_DOTS = r"(?U)\$?([\d,]+)\s+\.{2,}"
RECORD_ID = r"\((\d{5})\)"
SCHEDULE_ROW = r"(?U)\.{2,}\s*\$?[\d,]+\s+\$?[\d,]+\s*$"
NOISE_LINE = r"(?U)^(Program account subtotal\b|All Funds\b|[-=]{5,}$|SCHEDULE\b|Total of sub-schedule\b|sub-schedule\s*$)"
SUBSCHEDULE_OPEN = r"(?iU)^sub-schedule\s*$"
SUBSCHEDULE_CLOSE = r"(?iU)^Total of sub-schedule\b"
SEPARATOR = r"^(-{5,}|={5,})"
BODY_START = r"(?iU)^(For\b|By\b|The\s+appropriations?\s+made\s+by\b|Notwithstanding\b|Provided\b|Of\s+the\b|Aid\s+to\b)"
AGENCY_WORDS = r"\b(DEPARTMENT|OFFICE|DIVISION|AUTHORITY|CORPORATION|UNIVERSITY|MISCELLANEOUS|COUNCIL|BOARD|COMMISSION|ASSEMBLY|SENATE|SERVICES|COURT|JUDICIARY|GOVERNOR|SECRETARY|COMPTROLLER|ATTORNEY|EXECUTIVE|LEGISLATURE|AGENCY|PROGRAM)\b"
TITLE_WORDS = r"\b(AID TO|STATE OPERATIONS|CAPITAL PROJECTS|DEBT SERVICE|APPROPRIATIONS|REAPPROPRIATIONS|STATE OF NEW YORK|IN SENATE|IN ASSEMBLY|SECTION|BILL NUMBER)\b"
SECTION_TITLE = r"(?i)^(AID TO LOCALITIES|STATE OPERATIONS|CAPITAL PROJECTS)"
UPPER_SHARE = 0.85


def strip(c: Column) -> Column:
    """Trim Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """A captured group of the first match; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def amount(c: Column) -> Column:
    """``$1,234`` as a number; null if no digit is there."""
    return F.regexp_replace(c, r"[$,]", "").try_cast("bigint")


def line_number(raw: Column) -> Column:
    return capture(raw, LINE_NUMBER).try_cast("int")


def line_body(raw: Column, has_number: Column | None = None) -> Column:
    """Text behind the line number, or the trimmed line if it has none (``has_number``, if the caller knows)."""
    body = F.regexp_extract(raw, LINE_NUMBER, 2)
    # only a line that ends in white space has some to lose
    trimmed = F.when(F.right(raw, F.lit(1)).rlike(r"(?U)\s"), F.regexp_replace(body, r"(?U)\s+$", "")).otherwise(body)
    return F.when(raw.rlike(LINE_NUMBER) if has_number is None else has_number, trimmed).otherwise(strip(raw))


def is_blank(raw: Column) -> Column:
    return ~raw.rlike(r"(?U)\S")


def indent(raw: Column) -> Column:
    """Width of line number and white space before the body."""
    return F.length(F.regexp_extract(raw, LINE_PREFIX, 1))


def is_fund_family(body: Column) -> Column:
    return body.isin(*FUND_FAMILIES)


def chapter_year(body: Column) -> Column:
    return capture(body, CHAPTER_YEAR).try_cast("int")


def amending_year(body: Column) -> Column:
    return capture(body, CHAPTER_YEAR, 2).try_cast("int")


def last_dots_amount(c: Column) -> Column:
    return amount(F.try_element_at(F.regexp_extract_all(c, F.lit(DOTS_AMOUNT), F.lit(1)), F.lit(-1)))


def amount_before_dots(c: Column) -> Column:
    return amount(capture(c, AMOUNT_DOTS))


def record_id(c: Column) -> Column:
    return capture(c, RECORD_ID)


def is_agency(text: Column) -> Column:
    """Mostly upper-case letters, no words of a bill's title, a word that agencies have."""
    t = strip(text)
    letters, upper = F.length(F.regexp_replace(t, r"[^\p{L}]", "")), F.length(F.regexp_replace(t, r"[^\p{Lu}]", ""))
    return F.coalesce((letters > 0) & (upper >= UPPER_SHARE * letters) & ~t.rlike(TITLE_WORDS) & t.rlike(AGENCY_WORDS), F.lit(False))


def section(text: Column) -> Column:
    """Which section a title line opens; null for other lines."""
    t = strip(text)
    return F.when(t.rlike(SECTION_TITLE), F.when(F.upper(t).contains("REAPPROPRIATIONS"), "reapprop").otherwise("appropriation"))
