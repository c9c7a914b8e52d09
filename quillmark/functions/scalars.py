"""Scalar normalisers and formats."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of two texts that are compared, and the least balance that counts.
PREFIX, LEAST_BALANCE = 150, 1000


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def fund_name(c: Column) -> Column:
    """Parts of a fund trimmed, empty ones left out, joined by ``; ``."""
    parts = F.transform(F.split(collapse(c), ";"), lambda x: F.trim(x))
    return F.array_join(F.filter(parts, lambda x: x != ""), "; ")


def plain_id(c: Column) -> Column:
    """``13959.0`` as ``13959``; null and what isn't a number as the empty text."""
    return F.coalesce(c.try_cast("double").cast("bigint").cast("string"), F.lit(""))


def round_up(c: Column, unit: int = 1000) -> Column:
    return F.when(c > 0, F.ceil(c / unit) * unit).otherwise(0).cast("bigint")


def eligible(balance: Column, least: int = LEAST_BALANCE) -> Column:
    """Enough balance, before rounding."""
    return F.coalesce(balance >= least, F.lit(False))


def code_prefix(c: Column) -> Column:
    """``23462 - Name`` as ``23462``; the empty text if there is no leading number."""
    return F.regexp_extract(c, r"^\s*(\d+)\s*(?:-|$)", 1)


def fiscal_year(c: Column) -> Column:
    """``A200102`` as 2001."""
    return F.nullif(F.regexp_extract(c, r"^[A-Za-z]?(\d{4})", 1), F.lit("")).try_cast("int")


def number_or(c: Column, *others: Column) -> Column:
    """First number that is there and isn't 0; else 0."""
    tries = [F.nullif(x.try_cast("double").cast("bigint"), F.lit(0).cast("bigint")) for x in (c, *others)]
    return F.coalesce(*tries, F.lit(0).cast("bigint"))


def version_status(prior: Column, current: Column) -> Column:
    return F.when(prior == current, "continued").otherwise("modified")


def carried(amount: Column, dollar: bool = True) -> Column:
    return F.concat(F.lit("(re. $" if dollar else "(re. "), F.format_number(amount.cast("bigint"), 0), F.lit(")"))


def letters(k: Column) -> Column:
    """0 is A, 25 is Z, 26 is AA, 702 is AAA, 18,278 is AAAA, and so on for any bigint: the digits of base 26 behind the shorter texts."""
    k = k.cast("bigint")
    size, above = F.lit(14), F.lit(sum(26**n for n in range(1, 14)))  # 14 letters hold every bigint
    for n in range(13, 0, -1):
        shorter = sum(26**m for m in range(1, n))
        size, above = F.when(k < shorter + 26**n, n).otherwise(size), F.when(k < shorter + 26**n, F.lit(shorter).cast("bigint")).otherwise(above)
    digits = F.lpad(F.conv((k - above).cast("string"), 10, 26), size, "0")
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOP", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def numbered(number: Column, body: Column) -> Column:
    """A line as it stands in a record's text: the number takes at least two places."""
    n = number.cast("string")
    return F.concat(F.when(F.length(n) < 2, F.lpad(n, 2, " ")).otherwise(n), F.lit(" "), body)


REFERENCE = r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*);?"


def code_point(n: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _lookup(d: dict[str, str]) -> Column:
    """A map as one literal."""
    return F.from_json(F.lit(json.dumps(d)), "map<string,string>")


def unescaped(text: Column) -> Column:
    """Character references give way to their characters, numeric and named ones, with and without a semicolon.

    A name that isn't known whole counts up to its longest beginning that needs no semicolon. Numbers of no character are U+FFFD, those of C1 controls
    the characters of Windows-1252, as in HTML. The table of names is the standard library's.
    """
    table = html.entities.html5
    ended, bare = _lookup({k[:-1]: v for k, v in table.items() if k.endswith(";")}), _lookup({k: v for k, v in table.items() if not k.endswith(";")})
    controls = _lookup({str(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)})
    longest = max(len(k) for k in table if not k.endswith(";"))

    def character(ref: Column) -> Column:
        body = F.regexp_replace(ref, "^&#?|;$", "")
        number = F.regexp_replace(body, "^[xX]?0*", "")
        n = F.when(F.length(number) > 8, F.lit(0)).otherwise(F.when(ref.rlike("^&#[xX]"), F.conv(number, 16, 10)).otherwise(number).try_cast("int"))
        fits = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        numeric = F.when(fits, F.coalesce(F.try_element_at(controls, n.cast("string")), code_point(n))).otherwise(F.lit("�"))
        begun = [F.concat(F.try_element_at(bare, F.substring(body, 1, k)), F.substring(ref, k + 2, 1 << 20)) for k in range(longest, 1, -1)]
        name = F.coalesce(F.when(ref.endswith(";"), F.try_element_at(ended, body)), *begun, ref)
        return F.when(ref.startswith("&#"), numeric).otherwise(name)

    parts, refs = F.split(text, REFERENCE, -1), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    # each reference of a text is looked up once, however often it stands there
    known = F.array_distinct(refs)
    told = F.map_from_arrays(known, F.transform(known, character))
    joined = lambda m: F.array_join(F.zip_with(parts, refs, lambda p, r: F.concat(p, F.coalesce(F.try_element_at(m, r), F.lit("")))), "")
    whole = F.get(F.transform(F.array(told), joined), F.lit(0))
    return F.when(text.rlike("&[a-zA-Z#]"), whole).otherwise(text)
