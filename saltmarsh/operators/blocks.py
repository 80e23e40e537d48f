"""Blocks of extracted documents as rows: OCR words to lines, boxes, gaps, sections, page kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BBOX = "array<double>"


def ocr_lines(words: DataFrame, keys: list[str], index: str = "word_no", text: str = "text") -> DataFrame:
    """Words (with x0, y0, x1, y1, conf) as lines: text in word order, the union of boxes, mean of known confidences / 100."""
    held = words.groupBy(*keys).agg(F.collect_list(F.struct(F.col(index).alias("word_no"), F.col(text).alias("text"), *WORD_FIELDS)).alias("words"))
    return packed_lines(held, keys)


#: What a word has besides its place and its text.
WORD_FIELDS = ("x0", "y0", "x1", "y1", "conf")


def packed_lines(lines: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """The same of lines that hold their words, as an array of (word_no, text, x0, y0, x1, y1, conf): no word leaves its row."""

    def of(name: str) -> Column:
        return F.transform(words, lambda w: w[name])

    known = F.filter(of("conf"), lambda c: c >= 0)
    mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, c: a + c) / F.size(known))
    ordered = F.array_sort(F.transform(words, lambda w: F.struct(w["word_no"].alias("word_no"), w["text"].alias("text"))))
    box = [f(of(c)).alias(c) for f, c in ((F.array_min, "x0"), (F.array_min, "y0"), (F.array_max, "x1"), (F.array_max, "y1"))]
    return lines.select(*keys, F.array_join(F.transform(ordered, lambda w: w["text"]), " ").alias("text"), *box, (mean / 100).alias("confidence"))


def ocr_json_items(payload: Column) -> Column:
    """The array of struct(text, score, box) of an OCR engine's JSON, in its newer shape (an object of lists)."""
    shape = "struct<res:struct<rec_texts:array<string>,rec_scores:array<double>,rec_boxes:array<array<double>>,rec_polys:array<array<array<double>>>,dt_polys:array<array<array<double>>>>>"
    res = F.from_json(payload, shape)["res"]
    boxes = F.coalesce(res["rec_boxes"], F.transform(res["rec_polys"], polygon_box), F.transform(res["dt_polys"], polygon_box))
    items = F.arrays_zip(res["rec_texts"].alias("text"), res["rec_scores"].alias("score"), boxes.alias("box"))
    return F.transform(items, lambda i: F.struct(i["text"].alias("text"), F.when(i["score"] > 1, i["score"] / 100).otherwise(i["score"]).alias("score"), i["box"].alias("box")))


def ocr_legacy_items(payload: Column) -> Column:
    """The same of the older shape: a list of pages, each a list of [polygon, [text, score]]; scores stay as they are."""
    pages = F.from_json(payload, "array<array<array<string>>>")
    both = F.transform(F.flatten(pages), lambda x: F.struct(F.from_json(x[0], "array<array<double>>").alias("poly"), F.from_json(x[1], "array<string>").alias("said")))
    return F.transform(both, lambda x: F.struct(x["said"][0].alias("text"), x["said"][1].cast("double").alias("score"), polygon_box(x["poly"]).alias("box")))


def polygon_box(poly: Column) -> Column:
    xs, ys = F.transform(poly, lambda p: p[0]), F.transform(poly, lambda p: p[1])
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def parse_box(c: Column) -> Column:
    """Four numbers in a text, parted by space or comma, with or without brackets; else null."""
    parts = F.transform(F.split(F.trim(F.regexp_replace(c, r"[\[\],\s]+", " ")), " "), lambda x: x.try_cast("double"))
    return F.when((F.size(parts) == 4) & F.forall(parts, lambda x: x.isNotNull()), parts)


def box_union(df: DataFrame, keys: list[str], box: str = "bbox") -> DataFrame:
    return df.groupBy(*keys).agg(F.array(F.min(F.col(box)[0]), F.min(F.col(box)[1]), F.max(F.col(box)[2]), F.max(F.col(box)[3])).alias(box))


def explode_blocks(extractions: DataFrame) -> DataFrame:
    """Extraction rows (source_file, pages array) at the grain of blocks that have a box, in reading order by ``_order``."""
    page = extractions.select("source_file", F.explode("pages").alias("p")).select("source_file", "p.page_number", "p.width", "p.height", F.explode("p.blocks").alias("b"))
    rows = page.select("source_file", "page_number", "width", "height", "b.*").withColumn("bbox", parse_box(F.col("bbox").cast("string")) if dict(page.select("b.*").dtypes)["bbox"] == "string" else F.col("bbox"))
    boxed = rows.where(F.size("bbox") == 4)
    return boxed.withColumn("_order", F.row_number().over(Window.partitionBy("source_file", "page_number").orderBy(F.col("bbox")[1], F.col("bbox")[0], "block_id")))


def keep_below_middle(df: DataFrame, box: str = "bbox", height: str = "height") -> DataFrame:
    """Blocks whose centre is in the lower half; those without a box or a page height stay."""
    b = F.col(box)
    return df.where(b.isNull() | F.col(height).isNull() | ((b[1] + b[3]) / 2 >= F.col(height) * 0.5))


def gap_groups(df: DataFrame, keys: list[str], position: str, gap: Column | float, ties: list[str] | None = None, name: str = "group_no") -> DataFrame:
    """Groups of rows in a row whose positions are no further apart than gap."""
    w = Window.partitionBy(*keys).orderBy(position, *(ties or []))
    away = F.col(position) - F.lag(position).over(w) > gap
    return df.withColumn("_new", F.when(away, 1).otherwise(0)).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def widest_gap(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The widest gap between neighbouring positions of each key and where it ends; of equal gaps the later."""
    following = F.lead(position).over(Window.partitionBy(*keys).orderBy(position))
    gaps = df.withColumn("_next", following).where("_next is not null").withColumn("_gap", F.col("_next") - F.col(position))
    return gaps.groupBy(*keys).agg(F.max(F.struct(F.col("_gap").alias("gap"), F.col("_next").alias("at"))).alias("m")).select(*keys, "m.gap", "m.at")


def carry_forward(df: DataFrame, keys: list[str], order: list[str], label: Column, name: str = "section") -> DataFrame:
    """Each row with the last label at or before it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(label, ignorenulls=True).over(w))


def markdown(block_rows: DataFrame, files: DataFrame) -> DataFrame:
    """(source_file, markdown): every document as Markdown, each line under a comment with its evidence.

    block_rows: source_file, page_number, width, height, block_id, bbox, confidence, method, units, text; files: source_file,
    document_type, engine. Pages and blocks come in their own order, blocks by ``position`` on their page.
    """
    from ..functions.parse import number_text
    from ..functions.text import clean_text, json_string
    from ..sinks import html_escape

    def plain(c: Column) -> Column:
        return number_text(c.cast("decimal(20,6)"))

    def shown(c: Column) -> Column:  # as JSON numbers of a float
        return F.regexp_replace(c.cast("string"), r"^(-?[0-9]+)$", "$1.0")

    lines = block_rows.select("*", F.posexplode(F.split("text", r"\r\n|[\n\r]")).alias("_n", "_raw")).withColumn("_line", clean_text(F.col("_raw"))).where("_line <> ''")
    box = F.when(F.size("bbox") == 4, F.concat(F.lit("["), F.array_join(F.transform("bbox", shown), ","), F.lit("]"))).otherwise("null")
    told = F.concat(F.lit('{"block_id":'), json_string(F.col("block_id")), F.lit(',"bbox":'), box, F.lit(',"confidence":'), F.coalesce(shown(F.col("confidence")), F.lit("null")), F.lit(',"method":'), json_string(F.col("method")), F.lit(',"units":'), json_string(F.col("units")), F.lit("}"))
    said = F.concat(F.lit("<!-- "), told, F.lit(" -->\n- "), F.col("_line"))
    page = lines.groupBy("source_file", "page_number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "_n", said.alias("s")))), lambda x: x["s"]), "\n").alias("_body"))
    sizes = block_rows.groupBy(F.col("source_file").alias("_f"), F.col("page_number").alias("_p")).agg(F.max("width").alias("_w"), F.max("height").alias("_h"))
    whole = sizes.join(page, (F.col("_f") == F.col("source_file")) & (F.col("_p") == F.col("page_number")), "left")
    part = F.concat(F.lit("## Pagina "), F.col("_p").cast("string"), F.lit("\n\n_Dimensiones: "), plain(F.col("_w")), F.lit(" x "), plain(F.col("_h")), F.lit("_\n\n"), F.coalesce(F.concat("_body", F.lit("\n")), F.lit("")))
    pages = whole.groupBy("_f").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", part.alias("s")))), lambda x: x["s"]), "\n").alias("_pages"), F.count("*").alias("_n"))
    head = F.concat(F.lit("# Documento: "), html_escape(F.col("source_file")), F.lit("\n\n- Tipo: `"), html_escape(F.col("document_type")), F.lit("`\n- Motor: `"), html_escape(F.col("engine")), F.lit("`\n- Paginas: "), F.coalesce("_n", F.lit(0)).cast("string"), F.lit("\n\n"))
    out = files.join(pages, F.col("source_file") == F.col("_f"), "left")
    return out.select("source_file", F.concat(F.regexp_replace(F.concat(head, F.coalesce("_pages", F.lit(""))), r"\s+$", ""), F.lit("\n")).alias("markdown"))


def paragraphs(df: DataFrame, keys: list[str], order: str = "top", text: str = "text") -> DataFrame:
    """Lines (top, bottom) joined to paragraphs: a gap above max(12, 1.45 x the median height) parts them."""
    heights = df.groupBy(*keys).agg(F.median(F.col("bottom") - F.col("top")).alias("_h"))
    w = Window.partitionBy(*keys).orderBy(order)
    lines = df.join(heights.hint("merge"), keys).withColumn("_break", F.when(F.col("top") - F.lag("bottom").over(w) > F.greatest(F.lit(12.0), 1.45 * F.col("_h")), 1).otherwise(0))
    numbered = lines.withColumn("_p", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = numbered.groupBy(*keys, "_p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ").alias("_t"))
    return joined.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_t"))), lambda x: x["_t"]), "\n\n").alias(text))


def page_kinds(df: DataFrame, keys: list[str], native: Column) -> DataFrame:
    """text_based if all pages hold native text, scanned if none, else mixed."""
    return df.groupBy(*keys).agg(F.when(F.bool_and(native), "text_based").when(~F.bool_or(native), "scanned").otherwise("mixed").alias("kind"), F.count("*").alias("n_pages"), F.count_if(native).alias("n_native"))
