"""Edit scripts over lines: which lines stay, what happens to the others, and the text that results.

A line is (doc, page_idx, p_idx, line_num, text, raw_text, is_blank). An edit is a row with ``op`` =
keep, strike, replace, append or insert, ``old`` and ``new`` texts and a deterministic ``change_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.scalars import carried
from .sequences import as_of


def change_id(*cols: Column) -> Column:
    """The same for the same place and text, whenever it is made."""
    return F.substring(F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256), 1, 16)


def kept_lines(lines: DataFrame, ranges: DataFrame, on: list[str]) -> DataFrame:
    """Lines in the ranges: from first (page, line) to last (page, line), with all numbered lines of the pages between.

    A range is joined on its pages, so the join has equal keys throughout.
    """
    pages = ranges.select(*on, "first_page", "first_line", "last_page", "last_line", F.explode(F.sequence("first_page", "last_page")).alias("page_idx"))
    n, page = F.col("line_num"), F.col("page_idx")
    inside = n.isNotNull() & ((page > F.col("first_page")) | (n >= F.col("first_line"))) & ((page < F.col("last_page")) | (n <= F.col("last_line")))
    return lines.join(pages, [*on, "page_idx"]).where(inside).select(*lines.columns).distinct()


def headers_before(lines: DataFrame, starts: DataFrame, is_header: Column, on: list[str], most: int, at: str = "global_p_idx") -> DataFrame:
    """(on, start, header): the header line nearest before each start, with the lines that belong to it (up to ``most``), across pages.

    ``starts``: on, ``at`` of numbered lines. The lines of one header are those behind it up to the next blank or header.
    """
    upto = lambda last: F.last(F.when(is_header, F.col(at)), ignorenulls=True).over(W.partitionBy(*on).orderBy(at).rowsBetween(W.unboundedPreceding, last))
    numbered = lines.where("line_num is not null").withColumns({"__h": upto(0), "__before": upto(-1)})
    found = starts.join(numbered.where("__before is not null").select(*on, at, "__before"), [*on, at])
    found = found.select(*on, F.col(at).alias("start"), F.col("__before").alias("header"))
    nth = F.row_number().over(W.partitionBy(*on, "__h").orderBy(at))
    own = numbered.where("__h is not null").withColumn("nth", nth).where(F.col("nth") <= most).select(*on, F.col("__h").alias("header"), F.col(at).alias("line_at"))
    return found.join(own, [*on, "header"]).where("line_at < start")


def numbered_places(lines: DataFrame, on: list[str]) -> DataFrame:
    """Numbered lines that aren't blank, with ``place``: their number in the document, from the numbers on the pages before."""
    body = lines.where("line_num is not null and not is_blank")
    upto = W.partitionBy(*on).orderBy("page_idx").rowsBetween(W.unboundedPreceding, -1)
    pages = body.groupBy(*on, "page_idx").agg(F.count("*").alias("__n")).select(*on, "page_idx", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"))
    own = F.row_number().over(W.partitionBy(*on, "page_idx").orderBy("p_idx"))
    return body.withColumn("__own", own).join(pages, [*on, "page_idx"]).withColumn("place", F.col("__before") + F.col("__own")).drop("__before", "__own")


def header_groups(places: DataFrame, is_header: Column, on: list[str], most: int, closes: Column | None = None, stops: Column | None = None) -> DataFrame:
    """(on, header, place, page_idx, line_num): each header line of ``numbered_places`` with the lines that go on with it, ``most`` in all.

    A line behind one that ``closes`` the header doesn't belong to it, nor does one that ``stops`` it, nor any behind that.
    """
    flag = lambda c: F.coalesce(c, F.lit(False)) if c is not None else F.lit(False)
    rows = places.select(*on, "place", "page_idx", "line_num", flag(is_header).alias("__head"), flag(closes).alias("__closes"), flag(stops).alias("__stops"))
    heads = rows.where("__head").select(*on, F.col("place").alias("header"), F.explode(F.sequence(F.col("place"), F.col("place") + most - 1)).alias("place"))
    group = heads.join(rows, [*on, "place"])
    w = W.partitionBy(*on, "header").orderBy("place")
    upto, before = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    stopped = F.max(F.col("__stops") & (F.col("place") > F.col("header"))).over(upto) | F.coalesce(F.max("__closes").over(before), F.lit(False))
    return group.withColumn("__stopped", stopped).where("not __stopped").select(*on, "header", "place", "page_idx", "line_num")


def headers_of(places: DataFrame, groups: DataFrame, starts: DataFrame, on: list[str]) -> DataFrame:
    """(on, start, page_idx, line_num): the lines before each start of the header group nearest before it, across pages.

    ``starts``: on, place. A header counts for the starts behind it, so groups are joined once for each start, by their number.
    """
    near = as_of(starts.select(*on, "place").distinct(), groups.select(*on, F.col("header").alias("place")).distinct(), on, ["place"], ["place"], name="__near")
    near = near.select(*on, F.col("place").alias("start"), F.col("__near.place").alias("header"))
    return near.join(groups, [*on, "header"]).where("place < start").select(*on, "start", "page_idx", "line_num")


def replace_first(text: Column, old: Column, new: Column) -> Column:
    """First occurrence only, taken as plain text."""
    at = F.instr(text, old) if isinstance(old, str) else F.position(old, text)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), new, text.substr(at + F.length(old), F.length(text)))).otherwise(text)


def new_amount(text: Column, old: Column, new: Column) -> Column:
    """``(re. $old)`` becomes ``(re. $new)``; a form without the dollar sign is tried next; equal amounts change nothing."""
    with_sign, bare = carried(old), carried(old, dollar=False)
    changed = F.when(F.position(with_sign, text) > 0, replace_first(text, with_sign, carried(new))).otherwise(replace_first(text, bare, carried(new)))
    return F.when(old == new, text).otherwise(changed)


def appended_amount(text: Column, new: Column) -> Column:
    return F.concat(text, F.lit(" ... "), carried(new))


def edit_script(lines: DataFrame, survivors: DataFrame, on: list[str], extra_keeps: DataFrame | None = None) -> DataFrame:
    """Every line with ``op``, ``old`` and ``new``.

    ``survivors``: on, first_page, first_line, last_page, last_line, source, old_amount, new_amount. Their lines stay,
    the amount on their last line changes (or comes in, for an appropriation), all other visible lines
    are struck. ``extra_keeps``: more lines to keep (headers), by on, page_idx and line_num.
    """
    keys = [*on, "page_idx", "line_num"]
    keep = kept_lines(lines, survivors, on).select(*keys)
    if extra_keeps is not None:
        keep = keep.unionByName(extra_keeps.select(*keys))
    keep = keep.distinct().withColumn("__keep", F.lit(True))
    last = survivors.groupBy(*on, F.col("last_page").alias("page_idx"), F.col("last_line").alias("line_num")).agg(F.min_by(F.struct("source", "old_amount", "new_amount"), F.struct("first_page", "first_line")).alias("__s"))
    out = lines.join(keep, keys, "left").join(last, keys, "left")
    stays, s, text = F.coalesce("__keep", F.lit(False)), F.col("__s"), F.col("raw_text")
    append = s["source"] == "appropriation"
    new = F.when(~stays, F.lit(None)).when(s.isNull(), text).when(append, appended_amount(text, s["new_amount"])).otherwise(new_amount(text, s["old_amount"], s["new_amount"]))
    out = out.withColumns({"old": text, "new": F.when(F.col("is_blank"), text).otherwise(new)})
    op = F.when(F.col("is_blank"), "blank").when(~stays, "strike").when(s.isNotNull() & append, "append").when(F.col("new") != text, "replace").otherwise("keep")
    out = out.withColumn("op", op)
    return out.withColumn("change_id", F.when(~F.col("op").isin("keep", "blank"), change_id(*[F.col(c) for c in on], F.col("page_idx"), F.col("p_idx"), F.col("op")))).drop("__keep", "__s")


def labels_before_kept(script: DataFrame, labels: DataFrame, on: list[str]) -> DataFrame:
    """Insert rows: (on, page_idx, p_idx, label): each label comes behind the last visible line before the earliest kept line.

    A label whose earliest kept line is the first visible line of its page is left out.
    """
    kept = F.col("op").isin("keep", "replace", "append")
    first = script.where(kept).groupBy(*on).agg(F.min(F.struct("page_idx", "line_num")).alias("f"))
    page = script.join(first, on).where(F.col("page_idx") == F.col("f.page_idx"))
    at = F.min(F.when(F.col("line_num") == F.col("f.line_num"), F.col("p_idx"))).over(W.partitionBy(*on, "page_idx"))
    page = page.withColumn("__at", at).where((F.col("p_idx") < F.col("__at")) & ~F.col("is_blank"))
    behind = page.groupBy(*on, "page_idx").agg(F.max("p_idx").alias("p_idx"))
    return behind.join(labels.select(*on, "label"), on)


def located(lines: DataFrame, targets: DataFrame, on: list[str]) -> DataFrame:
    """``targets`` (on, page_idx, line) with ``p_idx``: the line of that number, else the last one with a smaller number; 0 for the top, -1 if none."""
    n = lines.where("line_num is not null").select(*on, "page_idx", "p_idx", "line_num")
    t = targets.withColumn("__t", F.struct(*on, "page_idx", "line"))
    keys = t.select("__t", *on, "page_idx", "line").distinct()
    hit = keys.join(n, [*on, "page_idx"], "left").groupBy("__t", "line").agg(
        F.min(F.when(F.col("line_num") == F.col("line"), F.col("p_idx"))).alias("e"), F.max(F.when(F.col("line_num") <= F.col("line"), F.col("p_idx"))).alias("b")
    )
    hit = hit.select("__t", F.when(F.col("line") == 0, 0).otherwise(F.coalesce("e", "b", F.lit(-1))).alias("p_idx"))
    return t.join(hit, "__t").drop("__t")


def with_inserts(lines: DataFrame, inserts: DataFrame, on: list[str], text: Column) -> DataFrame:
    """(on, page_idx, p_idx, label, text): lines and, behind their anchor lines, ``Insert <label>``; smaller labels of one anchor first."""
    base = lines.select(*on, "page_idx", "p_idx", F.lit("").alias("label"), text.alias("text"))
    new = inserts.select(*on, "page_idx", "p_idx", "label", F.concat(F.lit("Insert "), F.col("label")).alias("text"))
    return base.unionByName(new)


def find_text(lines: DataFrame, what: str, text: str = "raw_text") -> DataFrame:
    return lines.where(F.col(text).contains(what))


def replace_nth(lines: DataFrame, what: str, new: str, nth: int, page: list[str], text: str = "raw_text") -> DataFrame:
    """``new_text``: on each page, the line that is number ``nth`` (from 0) among those holding the text has its first occurrence replaced."""
    holds = F.col(text).contains(what)
    rank = F.sum(F.when(holds, 1).otherwise(0)).over(W.partitionBy(*page).orderBy("p_idx").rowsBetween(W.unboundedPreceding, 0))
    return lines.withColumn("new_text", F.when(holds & (rank == nth + 1), replace_first(F.col(text), F.lit(what), F.lit(new))).otherwise(F.col(text)))


def bulk_delete(lines: DataFrame, on: list[str], page: int, first: int, last: int) -> DataFrame:
    """Visible lines of a range of places, struck under one change id."""
    hit = lines.where((F.col("page_idx") == page) & F.col("p_idx").between(first, last) & ~F.col("is_blank"))
    return hit.withColumns({"op": F.lit("strike"), "change_id": change_id(*[F.col(c) for c in on], F.lit(page), F.lit(first), F.lit(last))})


def inline_diff() -> Column:
    """``~~old~~`` and ``++new++`` of a script's row."""
    op, old, new = F.col("op"), F.col("old"), F.col("new")
    struck, added = F.concat(F.lit("~~"), old, F.lit("~~")), F.concat(F.lit("++"), new, F.lit("++"))
    tail = F.concat(old, F.lit("++"), F.substring(new, F.length(old) + 1, F.length(new)), F.lit("++"))
    return F.when(op == "strike", struck).when(op == "replace", F.concat(struck, added)).when(op == "append", tail).when(op == "insert", added).otherwise(old)


def change_counts(script: DataFrame, on: list[str]) -> DataFrame:
    op = F.col("op")
    return script.groupBy(*on).agg(F.count_distinct("page_idx").alias("pages"), F.count_if(op.isin("strike", "replace")).alias("deletions"), F.count_if(op.isin("replace", "append", "insert")).alias("insertions"))


def chosen(plan: DataFrame, labels: list[str] | None = None, first: int | None = None, order: str = "label") -> DataFrame:
    """All, the listed or the first labels of a plan."""
    if labels is not None:
        plan = plan.where(F.col("label").isin(labels))
    return plan.orderBy(order).limit(first) if first else plan


def carried_amount(text: Column) -> Column:
    return P.amount(P.capture(text, P.CARRIED_AMOUNT))
