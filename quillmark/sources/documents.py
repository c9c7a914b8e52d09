"""Documents as tables of pages and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scalars as X
from .stages import staged

PARAGRAPH = r"(?is)<p\b[^>]*>(.*?)</p>"
# Elements whose start or end tag ends a paragraph.
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
_ENDS = r"(?=[\s/>]|\z)"
#: Before each tag of a div.
DIV_CUT = rf"(?i)(?=</?div{_ENDS})"
#: A tag whose quoted values may hold ``>``, else one up to the next ``>``.
TAG = r"""(?s)^<(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
PLAIN_TAG = r"(?s)^<[^>]*+(?:>|\z)"
INLINE_TAG = r"""(?s)<[a-zA-Z/!?](?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\z))"""
#: A paragraph's start; the paragraph up to the next tag of a block, its own end tag included, with its inside.
P_START = rf"(?i)<p{_ENDS}"
P_WHOLE = rf"""(?is)<p{_ENDS}(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\z))(.*?)(?=</?(?:{'|'.join(BLOCKS)}){_ENDS}|\z)"""
CLASS = r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: Comments, scripts and styles hold no tags; one that isn't ended takes all that follows.
SILENT = r"(?is)<!--.*?-->|<(script|style)\b[^>]*+>.*?</\1\s*>"
SILENT_OPEN = r"(?is)<(?:(!)--|(script|style)\b[^>]*+>).*"
SILENT_ENDS = {"!": "-->", "script": r"</script\s*>", "style": r"</style\s*>"}


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, html, file_name): one row for each file of a folder."""
    files = spark.read.text(path, wholetext=True)
    # names come as parts of an address; a plus sign is one there, not a space
    files = files.select("value", F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file_name"))
    return files.select(F.regexp_replace("file_name", r"\.[^.]*$", "").alias("doc_id"), F.col("value").alias("html"), "file_name")


def first_page_of(file_name: Column) -> Column:
    """The page number in ``... pg315-450 ...``; 1 if there is none."""
    return F.coalesce(P.capture(file_name, r"pg(\d+)-(\d+)").try_cast("int"), F.lit(1))


def text_of(html: Column) -> Column:
    """Text of an element's inside: tags go, character references give way to their characters. A ``<`` before anything but a tag is text."""
    return X.unescaped(F.regexp_replace(html, INLINE_TAG, ""))


def paragraphs(docs: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, p_idx, raw_text): paragraphs of documents without pages."""
    found = F.regexp_extract_all(html_col, F.lit(PARAGRAPH), F.lit(1))
    return docs.select(id_col, F.posexplode(found).alias("p_idx", "inner")).select(id_col, "p_idx", text_of(F.col("inner")).alias("raw_text"))


def paged_lines(docs: DataFrame, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """The lines table of paged documents: a page is a ``div`` of class ``page``, a line a ``p`` in it.

    Markup may be malformed. A paragraph ends at its end tag or at any tag of ``BLOCKS``; end tags of divs that aren't open are
    passed over, divs that aren't ended last to the document's end; values of attributes may be quoted in either way or not at all; comments, scripts
    and styles hold no tags; a div's tag in an attribute's value counts as one. A page within a page is a page of its own, and its lines are lines of both, as its paragraphs lie in both.
    Null and empty documents have no lines.
    """
    pieces = docs.select(F.col(id_col).alias("doc"), F.posexplode(F.split(_loud(F.col(html_col)), DIV_CUT)).alias("n", "piece"))
    return lines_of(pieces, id_col)


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines table of html files of any size: ``doc_id`` is the file's name without its ending.

    Files are read in parts that start at a div, so no file is one string or one task's; lines are those of ``paged_lines(scan(...))``.
    """
    pieces = cleaned(file_pieces(spark, path))
    cut = pieces.select("doc", "n", F.posexplode(F.split("piece", DIV_CUT)).alias("m", "piece"))
    return lines_of(cut.select("doc", F.struct("n.block", "n.row", "m").alias("n"), "piece"))


def file_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(doc, n, piece): files cut where a div starts. ``n`` ascends within a file: the place of the part that a task reads, and the row's place among its rows.

    What stands before a file's first div gets the letters of a div's start, too; nothing of it lies in a page, so that changes no line.
    """
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    n = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("n")
    rows = spark.read.option("lineSep", "<div").text(path)
    return rows.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("doc"), n, F.concat(F.lit("<div"), "value").alias("piece"))


def _loud(text: Column) -> Column:
    """A text without comments, scripts and styles; most texts have none, which plain searches tell."""
    low = F.lower(text)
    some = low.contains("<!--") | low.contains("<script") | low.contains("<style")
    return F.when(some, F.regexp_replace(F.regexp_replace(text, SILENT, ""), SILENT_OPEN, "")).otherwise(text)


def _open_at_end(text: Column) -> Column:
    """Which comment (``!``), script or style a text leaves open; the empty text if none."""
    left = F.regexp_replace(F.coalesce(text, F.lit("")), SILENT, "")
    return F.coalesce(F.nullif(F.regexp_extract(left, SILENT_OPEN, 1), F.lit("")), F.lower(F.regexp_extract(left, SILENT_OPEN, 2)))


def _behind(kind: str) -> Column:
    """What stands behind the first end of an open comment, script or style; null if it doesn't end here."""
    return F.get(F.split("piece", rf"(?i){SILENT_ENDS[kind]}", 2), F.lit(1))


def cleaned(pieces: DataFrame) -> DataFrame:
    """Pieces without comments, scripts and styles, those that last over several pieces included.

    Documents in which one lasts are walked piece by piece, in a sorted stream of what each piece opens and ends; where there are none, nothing is.
    """
    lasting = pieces.where(F.col("piece").rlike(r"(?i)<!--|<(?:script|style)\b")).where(_open_at_end(F.col("piece")) != "").select("doc").distinct()
    if lasting.isEmpty():
        return pieces.withColumn("piece", _loud(F.col("piece")))
    kinds = list(SILENT_ENDS)
    then = [F.when(_behind(k).isNull(), F.lit(k)).otherwise(_open_at_end(_behind(k))).alias(f"then_{j}") for j, k in enumerate(kinds)]
    said = pieces.join(lasting, "doc", "left_semi").select("doc", "n", _open_at_end(F.col("piece")).alias("none"), *then)

    def walk(batches):
        import pyarrow as pa

        doc = state = None
        for b in batches:
            out = []
            for now, none, *ended in zip(*(b.column(c).to_pylist() for c in ("doc", "none", *(f"then_{j}" for j in range(len(kinds))))), strict=True):
                if now != doc:
                    doc, state = now, ""
                out.append(state)
                state = ended[kinds.index(state)] if state else none
            yield pa.record_batch([b.column("doc"), b.column("n"), pa.array(out, pa.string())], ["doc", "n", "inside"])

    kind = pieces.schema["n"].dataType.simpleString()
    inside = said.repartition("doc").sortWithinPartitions("doc", "n").mapInArrow(walk, f"doc string, n {kind}, inside string")
    out = pieces.join(inside, ["doc", "n"], "left")
    rest = F.col("piece")
    for k in kinds:
        rest = F.when(F.col("inside") == k, F.coalesce(_behind(k), F.lit(""))).otherwise(rest)
    return out.select("doc", "n", _loud(rest).alias("piece"))


def _tag(piece: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(piece, TAG, 0), F.lit("")), F.regexp_extract(piece, PLAIN_TAG, 0))


def tagged(pieces: DataFrame) -> DataFrame:
    """(doc, n, piece) with ``d`` (a div starts or ends), ``page`` (it is a page's) and ``own``, the number of paragraphs."""
    piece = F.col("piece")
    starts = piece.rlike(rf"(?i)^<div{_ENDS}")
    step = F.when(starts, 1).when(piece.rlike(rf"(?i)^</div{_ENDS}"), -1).otherwise(0)
    rows = pieces.select("doc", "n", "piece", step.alias("d"), F.when(starts, _tag(piece)).alias("tag"), F.regexp_count(piece, F.lit(P_START)).cast("bigint").alias("own"))
    names = F.concat(*[F.regexp_extract("tag", CLASS, k) for k in (1, 2, 3)])
    return rows.select("doc", "n", "piece", "d", "own", F.coalesce(names.rlike(r"(?:^|\s)page(?:\s|$)") & ~F.col("tag").rlike("^<[^\"'>]*<"), F.lit(False)).alias("page"))


def page_places(rows: DataFrame) -> DataFrame:
    """(doc, n, page_idx, first, first_of_all) of ``tagged`` pieces: the pages that each piece lies in, and how many paragraphs stand before it in the page and in all pages.

    A row for a div's tag carries the whole structure, so windows run over these narrow rows, never over lines. Running depths
    never fall below zero; a start and the end behind it at one depth belong together.
    """
    rows = rows.select("doc", "n", "d", "own", "page")
    upto = W.partitionBy("doc").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("s", F.sum("d").over(upto)).withColumn("low", F.least(F.min("s").over(upto), F.lit(0)))
    stray = (F.col("d") == -1) & (F.col("low") < F.coalesce(F.lag("low").over(W.partitionBy("doc").orderBy("n")), F.lit(0)))
    depth = F.col("s") - F.col("low")
    rows = rows.withColumn("level", F.when(F.col("d") == 1, depth).when((F.col("d") == -1) & ~stray, depth + 1))
    ends = (F.col("d") == -1) & F.col("level").isNotNull() & F.coalesce(F.lag("page").over(W.partitionBy("doc", "level").orderBy("n")), F.lit(False))
    rows = rows.withColumn("turn", F.when(F.col("page"), 1).when(ends, -1).otherwise(0))
    rows = rows.withColumns({"part": F.sum(F.abs("turn")).over(upto), "depth": F.sum("turn").over(upto), "page_idx": F.sum(F.col("page").cast("int")).over(upto) - 1})
    turns = rows.withColumn("last", F.max("part").over(W.partitionBy("doc"))).where("turn <> 0")
    turns = turns.withColumn("at", F.when(F.col("turn") == 1, F.col("depth")).otherwise(F.col("depth") + 1))
    end = F.coalesce(F.lead("part").over(W.partitionBy("doc", "at").orderBy("part")) - 1, F.col("last"))
    parts = turns.withColumn("end", end).where("turn = 1").select(F.col("doc").alias("__doc"), F.col("page_idx").cast("int").alias("__page"), F.explode(F.sequence("part", "end")).alias("__part"))
    inside = rows.where("own > 0").join(parts, rows["doc"].eqNullSafe(F.col("__doc")) & (rows["part"] == F.col("__part"))).select("doc", "n", "own", F.col("__page").alias("page_idx"))
    before = lambda part, *order: F.coalesce(F.sum("own").over(W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return inside.select("doc", "n", "page_idx", before(["doc", "page_idx"], "n").alias("first"), before(["doc"], "page_idx", "n").alias("first_of_all"))


def lines_of(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The lines table of (doc, n, piece); each piece starts at a tag of a div or holds what stands before the first one.

    Pieces are staged, as places and lines read them, so that what makes them runs once.
    """
    pieces = staged(tagged(pieces))
    places = page_places(pieces)
    at = places.select(*[F.col(c).alias(f"__{c}") for c in places.columns])
    # pieces hold the texts: small as their file may be, they aren't for one task or for the driver
    both = pieces.where("own > 0").hint("merge").join(at, pieces["doc"].eqNullSafe(F.col("__doc")) & (pieces["n"] == F.col("__n")))
    lines = both.select(F.col("doc").alias(id_col), F.col("__page_idx").alias("page_idx"), "__first", "__first_of_all", F.posexplode(F.regexp_extract_all("piece", F.lit(P_WHOLE), F.lit(1))).alias("k", "inner"))
    lines = lines.withColumn("inner", F.when(F.col("inner").contains("<"), F.regexp_replace("inner", INLINE_TAG, "")).otherwise(F.col("inner")))
    whole = lambda c: (F.col(c) + F.col("k")).cast("int")
    return told(lines.select(id_col, "page_idx", whole("__first").alias("p_idx"), X.unescaped(F.col("inner")).alias("raw_text"), whole("__first_of_all").alias("global_p_idx")), id_col)


def text_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_size: int | None = None) -> DataFrame:
    """The lines table of plain texts, cut at newlines; ``page_size`` lines make up a page."""
    lines = docs.select(id_col, F.posexplode(F.split(text_col, "\n", -1)).alias("n", "raw_text"))
    page = F.floor(F.col("n") / page_size).cast("int") if page_size else F.lit(0)
    return told(lines.select(id_col, page.alias("page_idx"), (F.col("n") % page_size if page_size else F.col("n")).alias("p_idx"), "raw_text", F.col("n").alias("global_p_idx")), id_col)


def told(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add line_num, text and is_blank to (id, page_idx, p_idx, raw_text, global_p_idx)."""
    raw, number = F.col("raw_text"), F.col("__number")
    # a line with a number isn't blank; the number is looked for once
    lines = lines.withColumn("__number", F.regexp_extract(raw, P.LINE_NUMBER, 1))
    blank = F.when(number != "", F.lit(False)).otherwise(P.is_blank(raw))
    return lines.select(id_col, "page_idx", "p_idx", "raw_text", "global_p_idx", F.when(~blank, number.try_cast("int")).alias("line_num"), P.line_body(raw, number != "").alias("text"), blank.alias("is_blank"))


def page_slice(lines: DataFrame, first: int, last: int) -> DataFrame:
    """Lines of an inclusive range of pages."""
    return lines.where(F.col("page_idx").between(first, last))


def line_kind() -> Column:
    return F.when(F.col("is_blank"), "blank").when(F.col("line_num").isNull(), "header").otherwise("body")


def line_counts(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    kind = line_kind()
    return lines.groupBy(id_col).agg(F.count("*").alias("n_lines"), *[F.count_if(kind == k).alias(f"n_{k}") for k in ("blank", "header", "body")])
