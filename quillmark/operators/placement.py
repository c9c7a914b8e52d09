"""Finding the place of dropped records in the current version: rules tried in order, groups, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sequences as S
from .lookups import missing_in

#: Rules in the order in which they are tried, with the rank that orders labels at one line.
RULES = {"continued_same_fund": 0, "chyr_header": 1, "after_newer_chyr": 2, "before_next_fund": 3, "fund_header": 4, "program_header": 6, "before_next_program": 5, "doc_start": 7}


def line_before(line: Column) -> Column:
    return F.greatest(line - 1, F.lit(0))


def header_flags(rows: DataFrame, current: DataFrame, scope: list[str], fund: list[str], block: list[str], source: str = "source") -> DataFrame:
    """``needs_chapter_header`` and ``needs_fund_header``: the block or the fund isn't in the current version.

    Records of the appropriation section have no chapter header.
    """
    rows = missing_in(rows, current, [*scope, *fund, *block], "needs_chapter_header")
    rows = missing_in(rows, current, [*scope, *fund], "needs_fund_header")
    return rows.withColumn("needs_chapter_header", F.col("needs_chapter_header") & (F.col(source) != "appropriation"))


def widened(rows: DataFrame) -> DataFrame:
    """``start_page``: an earlier header's page where that header is needed."""
    first = F.col("first_page")
    page = lambda need, at: F.when(F.col(need) & F.col(at).between(0, first - 1), F.col(at))
    return rows.withColumn("start_page", F.least(first, page("needs_chapter_header", "chyr_page"), page("needs_fund_header", "fund_page")))


def cascade(rules: list[tuple[str, Column, Column]]) -> Column:
    """(kind, page, line) of the first rule that has a page; the start of the document if none has."""
    tries = [F.when(page.isNotNull(), F.struct(F.lit(kind).alias("kind"), page.cast("int").alias("page"), line.cast("int").alias("line"))) for kind, page, line in rules]
    return F.coalesce(*tries, F.struct(F.lit("doc_start").alias("kind"), F.lit(0).alias("page"), F.lit(0).alias("line")))


def rank_of(kind: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in RULES.items():
        out = F.when(kind == name, rank).otherwise(out)
    return out


def end_of() -> Column:
    return F.struct(F.coalesce("last_page", "first_page").alias("page"), F.coalesce("last_line", "first_line").alias("line"))


def blocks_of(current: DataFrame, scope: list[str], fund: list[str], block: list[str]) -> DataFrame:
    """Blocks of the current version: place of the first record, ``end`` of the last one."""
    at = F.struct("first_page", "first_line")
    return current.groupBy(*scope, *fund, *block).agg(F.min(at).alias("at"), F.max_by(end_of(), at).alias("end")).select(*scope, *fund, *block, "at.*", "end")


def anchors(
    survivors: DataFrame, prior: DataFrame, current: DataFrame, matches: DataFrame | None, scope: list[str], fund: list[str], block: list[str],
    fund_headers: DataFrame | None = None, program_headers: DataFrame | None = None,
) -> DataFrame:
    """``survivors`` (rows of ``prior``) with ``anchor`` = (kind, page, line).

    ``prior``: scope, source, fund (program and fund name), block (chapter and amending year), rec_idx, position. ``current``: the same with first_page,
    first_line, last_page, last_line. ``matches``: prior_idx, current_idx. ``fund_headers`` and ``program_headers``: scope, key columns, page, line.
    Rules 2 to 7 are joins at the grain of blocks, funds and programs, only rule 1 looks at records. Without ``matches``, survivors say in ``r1`` what rule 1
    finds, ``current`` is its ``blocks_of``, and ``prior`` may be one row for each fund of a source.
    """
    program, fund_name = fund
    part = [*scope, "source"]
    at = ["first_page", "first_line"]
    # 1: the end of the match of an earlier record of the same stretch of one fund
    out, blocks = survivors, current
    if matches is not None:
        ends = matches.join(current.select(F.col("rec_idx").alias("current_idx"), end_of().alias("end")), "current_idx")
        walked = prior.join(ends.select(F.col("prior_idx").alias("rec_idx"), "end"), "rec_idx", "left")
        walked = S.previous_in_run(walked, F.col("end"), fund, scope, ["position"], "r1").select("rec_idx", "r1")
        out, blocks = survivors.join(walked, "rec_idx", "left"), blocks_of(current, scope, fund, block)
    # 2: first record of the same block; 3: last record of the closest newer block
    out = out.join(blocks.select(*scope, *fund, *block, F.struct("first_page", "first_line").alias("r2")), [*scope, *fund, *block], "left")
    out = S.nearest_newer(out, blocks.select(*scope, *fund, *block, "end"), [*scope, *fund], block, ["end"]).withColumnRenamed("newer_end", "r3").drop(*[f"newer_{c}" for c in block])
    # 5 and 6: first record of the fund and of the program
    funds, programs = S.first_positions(blocks, [*scope, *fund], at), S.first_positions(blocks, [*scope, program], at)
    out = out.join(funds.select(*scope, *fund, F.struct(*at).alias("r5")), [*scope, *fund], "left")
    out = out.join(programs.select(*scope, program, F.struct(*at).alias("r6")), [*scope, program], "left")
    # 4 and 7: the next fund of the program, the next program, that the current version has
    place = lambda positions, headers, keys: _header_or_first(positions, headers, [*scope, *keys], at)
    ranked = S.distinct_in_order(prior, part, fund, ["position"]).withColumn("key", F.struct(*fund))
    there = funds.select(*scope, F.struct(*fund).alias("key"))
    nexts = S.next_existing(ranked, there, part, "key", stop=[program]).where("next_key is not null").select(*part, *fund, F.col("next_key.*"))
    names = [f"__{c}" for c in fund]
    nexts = nexts.toDF(*part, *fund, *names)
    where = place(funds, fund_headers, fund).toDF(*scope, *names, "r4")
    out = out.join(nexts.join(where, [*scope, *names]).select(*part, *fund, "r4"), [*part, *fund], "left")
    ranked = S.distinct_in_order(prior, part, [program], ["position"])
    nexts = S.next_existing(ranked, programs.select(*scope, program), part, program).where("next_key is not null").select(*part, program, F.col("next_key").alias("__next"))
    where = place(programs, program_headers, [program]).toDF(*scope, "__next", "r7")
    out = out.join(nexts.join(where, [*scope, "__next"]).select(*part, program, "r7"), [*part, program], "left")
    fund_gone = F.col("r5").isNull()
    rules = [
        ("continued_same_fund", F.col("r1.page"), F.col("r1.line")),
        ("chyr_header", F.col("r2.first_page"), line_before(F.col("r2.first_line"))),
        ("after_newer_chyr", F.col("r3.page"), F.col("r3.line")),
        ("before_next_fund", F.when(fund_gone, F.col("r4.page")), line_before(F.col("r4.line"))),
        ("fund_header", F.col("r5.first_page"), line_before(F.col("r5.first_line"))),
        ("program_header", F.col("r6.first_page"), line_before(F.col("r6.first_line"))),
        ("before_next_program", F.col("r7.page"), line_before(F.col("r7.line"))),
    ]
    return out.withColumn("anchor", cascade(rules)).drop("r1", "r2", "r3", "r4", "r5", "r6", "r7")


def _header_or_first(positions: DataFrame, headers: DataFrame | None, keys: list[str], at: list[str]) -> DataFrame:
    first = F.struct(F.col(at[0]).alias("page"), F.col(at[1]).alias("line"))
    if headers is None:
        return positions.select(*keys, first.alias("at"))
    h = headers.select(*keys, F.struct(F.col("page").cast("int").alias("page"), F.col("line").cast("int").alias("line")).alias("__h"))
    return positions.join(h, keys, "left").select(*keys, F.coalesce(F.col("__h"), first.cast("struct<page:int,line:int>")).alias("at"))


def labelled(groups: DataFrame, page: list[str], page_number: Column) -> DataFrame:
    """``label`` of groups with ``anchor``, ``first_page`` and ``first_line``: by anchor line, rule, then own place."""
    return S.page_labels(groups, page, page_number, ["anchor.line", rank_of(F.col("anchor.kind")), "first_page", "first_line"])


def invariants(survivors: DataFrame, labels: DataFrame, placed: DataFrame, key: str, label: list[str], amount: str) -> DataFrame:
    """(rule, violations): each must be 0 for a plan that is whole.

    Both sides meet once, as counts and sums of each key; what is short or over on a side is the difference of two multisets.
    """
    side = lambda df, s, p: df.select(F.col(key).alias("k"), F.lit(s).alias("s"), F.lit(p).alias("p"), F.col(amount).alias("a"))
    keys = side(survivors, 1, 0).unionByName(side(placed, 0, 1)).groupBy("k").agg(
        F.sum("s").alias("s"), F.sum("p").alias("p"), F.sum(F.when(F.col("s") == 1, F.col("a"))).alias("x"), F.sum(F.when(F.col("p") == 1, F.col("a"))).alias("y")
    )
    over = lambda a, b: F.coalesce(F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0))), F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    rules = {"survivor placed once": F.count_if(F.col("p") > 1), "every survivor placed": over("s", "p"), "only survivors placed": over("p", "s"), "amounts balance": (total("x") != total("y")).cast("bigint")}
    out = keys.agg(F.array(*[F.struct(F.lit(rule).alias("rule"), n.cast("bigint").alias("violations")) for rule, n in rules.items()]).alias("r")).select(F.inline("r"))
    repeated = labels.groupBy(*label).count().where("count > 1").agg(F.count("*").alias("violations"))
    return out.unionByName(repeated.select(F.lit("labels unique").alias("rule"), "violations"))
