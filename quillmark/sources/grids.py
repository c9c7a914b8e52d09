"""Loading tables whose columns are found by what their heads say.

A grid is (sheet, sheet_no, row, cells array<string>, is_number array<boolean>), as a spreadsheet comes. A grid of many books
has their names in ``book``; each book has columns of its own, which are bound to its rows when these are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import code_prefix, fiscal_year, number_or
from ..operators.joins import dealt_join

HEAD_ROWS, DATA_ROWS, DATA_START = 12, 20, 12
# What the heads of the columns hold.
COLUMNS = {
    "composite": ((("composite_key",), ("composite", "key")), ()),
    "balance": ((("undisbursed", "balance"),), ()),
    "bud_ref": ((("budget", "reference"),), ()),
    "bud_prog": ((("budgetary", "program"),), ("level",)),
    "bud_dept": ((("budgetary", "department"),), ("level",)),
    "orig_amt": ((("original", "approp", "amount"),), ()),
    "curr_amt": ((("current", "appropriation"),), ()),
}


def head_says(cell: Column, groups, exclude=()) -> Column:
    """A cell with all words of any group and none of the excluded ones, in any case."""
    c = F.lower(cell)
    out = F.lit(False)
    for group in groups:
        one = F.lit(True)
        for word in group:
            one &= c.contains(word)
        out |= one
    for word in exclude:
        out &= ~c.contains(word)
    return F.coalesce(out, F.lit(False))


def find_columns(grid: DataFrame, columns: dict = COLUMNS, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, sheet, sheet_no, a column for each name): the first column whose head fits; null if none does."""
    cells = grid.where(F.col("row") < HEAD_ROWS).select(*by, "sheet", "sheet_no", F.posexplode("cells").alias("col", "cell"))
    found = [F.min(F.when(head_says(F.col("cell"), groups, exclude), F.col("col"))).alias(name) for name, (groups, exclude) in columns.items()]
    return cells.groupBy(*by, "sheet", "sheet_no").agg(*found)


def _fit(columns: DataFrame) -> DataFrame:
    """Sheets with a balance and either a composite key or all plain columns, and their ``mode``."""
    plain = F.col("bud_ref").isNotNull() & F.col("bud_prog").isNotNull() & F.col("bud_dept").isNotNull()
    fit = columns.where(F.col("balance").isNotNull() & (F.col("composite").isNotNull() | plain))
    return fit.withColumn("mode", F.when(F.col("composite").isNotNull(), "composite").otherwise("raw"))


def choose_sheet(grid: DataFrame) -> DataFrame:
    """The first sheet with a balance and either a composite key or all plain columns, as (mode, sheet, columns); one row, or an error."""
    fit = _fit(find_columns(grid))
    one = fit.agg(F.min_by(F.struct("mode", "sheet", *COLUMNS), "sheet_no").alias("s"))
    kind = one.schema["s"].dataType
    return one.select(F.coalesce("s", F.raise_error(F.lit("no sheet has the columns that are needed")).cast(kind)).alias("s")).select("s.*")


def first_data_row(grid: DataFrame, column: Column, keys: list[str]) -> DataFrame:
    """(keys, start): the first of 20 rows with a number other than 0 in the column; 12 if there is none."""
    v = F.get("cells", column).try_cast("double")
    is_data = F.coalesce(F.get("is_number", column), F.lit(False)) & (v != 0)
    return grid.where(F.col("row") < DATA_ROWS).groupBy(*keys).agg(F.coalesce(F.min(F.when(is_data, F.col("row"))), F.lit(DATA_START)).alias("start"))


def _data(grid: DataFrame) -> DataFrame:
    chosen = F.broadcast(choose_sheet(grid))  # one row
    rows = grid.join(chosen, "sheet")
    start = first_data_row(rows, F.col("balance"), ["sheet"])
    return rows.join(F.broadcast(start), "sheet").where("row >= start")  # one row for the sheet


def _cell(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.get("cells", F.col(name)))


def load_composite(grid: DataFrame) -> DataFrame:
    """Keys of the form agency|id|year|amount; rows with fewer parts are left out."""
    rows = _data(grid).withColumn("parts", F.split(_cell("composite"), r"\|"))
    part = lambda k: F.trim(F.get("parts", F.lit(k)))
    rows = rows.where(F.get("parts", F.lit(3)).isNotNull())
    return rows.select(
        part(0).alias("agency"), F.coalesce(part(1), F.lit("")).alias("approp_id"), number_or(part(2)).cast("int").alias("chapter_year"), number_or(part(3)).alias("approp_amount"),
        F.lit(0).cast("bigint").alias("reapprop_amount"), _cell("balance").try_cast("double").alias("balance"), F.col("row").cast("bigint").alias("row_idx"),
    )


def load_raw(grid: DataFrame) -> DataFrame:
    """Plain columns: year and id from code prefixes, the current amount where the original is 0; rows without a year go, rows without an id stay."""
    rows = _data(grid).where(_cell("bud_ref").isNotNull() & _cell("bud_prog").isNotNull())
    return rows.select(
        code_prefix(_cell("bud_dept")).alias("dept_code"), code_prefix(_cell("bud_prog")).alias("approp_id"), fiscal_year(_cell("bud_ref")).alias("chapter_year"), number_or(_cell("orig_amt"), _cell("curr_amt")).alias("approp_amount"),
        F.lit(0).cast("bigint").alias("reapprop_amount"), _cell("balance").try_cast("double").alias("balance"), F.col("row").cast("bigint").alias("row_idx"),
    ).where("chapter_year is not null")


def load_legacy(table: DataFrame, names: dict[str, str], agency: str | None = None) -> DataFrame:
    """A lookup table under other names; with ``agency``, its rows only."""
    out = table.withColumnsRenamed(names)
    return out.where(F.col("agency") == agency) if agency else out


def choose_sheets(grid: DataFrame, book: str = "book") -> DataFrame:
    """(book, mode, sheet, columns): the first fitting sheet of each book; books without one aren't in it."""
    fit = _fit(find_columns(grid, by=(book,)))
    return fit.groupBy(book).agg(F.min_by(F.struct("mode", "sheet", *COLUMNS), "sheet_no").alias("s")).select(book, "s.*")


def unfit_books(grid: DataFrame, book: str = "book") -> DataFrame:
    """(book, sheets, reason) of the books that no sheet of which can be loaded; the others are loaded none the less."""
    sheets = grid.groupBy(book).agg(F.count_distinct("sheet").alias("sheets"))
    return sheets.join(choose_sheets(grid, book), book, "left_anti").withColumn("reason", F.lit("no sheet has the columns that are needed"))


def load_books(grid: DataFrame, book: str = "book") -> DataFrame:
    """(book, mode, agency, dept_code, approp_id, chapter_year, approp_amount, reapprop_amount, balance, row_idx) of all books that fit.

    Heads differ from book to book, so a row carries the places of its own book's columns and takes its cells by them; rows of a
    large book are dealt out. Composite books give the agency, raw ones the code of the department. ``unfit_books`` tells of the rest.
    """
    rows = dealt_join(grid, choose_sheets(grid, book), [book, "sheet"], "row")
    start = first_data_row(rows, F.col("balance"), [book])
    rows = dealt_join(rows, start, [book], "row").where("row >= start")
    composite = F.col("mode") == "composite"
    parts = F.when(composite, F.split(_cell("composite"), r"\|"))
    part = lambda k: F.trim(F.get("parts", F.lit(k)))
    whole = F.get("parts", F.lit(3)).isNotNull()
    plain = _cell("bud_ref").isNotNull() & _cell("bud_prog").isNotNull()
    rows = rows.withColumn("parts", parts).where(F.coalesce(F.when(composite, whole).otherwise(plain), F.lit(False)))
    out = rows.select(
        book, "mode", part(0).alias("agency"), F.when(~composite, code_prefix(_cell("bud_dept"))).alias("dept_code"), F.when(composite, F.coalesce(part(1), F.lit(""))).otherwise(code_prefix(_cell("bud_prog"))).alias("approp_id"),
        F.when(composite, number_or(part(2)).cast("int")).otherwise(fiscal_year(_cell("bud_ref"))).alias("chapter_year"),
        F.when(composite, number_or(part(3))).otherwise(number_or(_cell("orig_amt"), _cell("curr_amt"))).alias("approp_amount"),
        F.lit(0).cast("bigint").alias("reapprop_amount"), _cell("balance").try_cast("double").alias("balance"), F.col("row").cast("bigint").alias("row_idx"),
    )
    return out.where("chapter_year is not null")
