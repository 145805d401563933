"""Images of circulars: filters, first occurrences, running ids, descriptions, and the box of a drawing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.functions import text as T
from acervo.functions.regex import ci, let, strip

#: Least side in pixels and least size in bytes of an image; height of the letterhead; share of a page that is a full scan.
LEAST_SIDE, LEAST_BYTES, LETTERHEAD, FULL_PAGE = 60, 1000, 150.0, 0.9


def is_drawing(w: str = "w", h: str = "h") -> Column:
    """Images that are no rule, scrap, letterhead or full-page scan."""
    full = ((F.col("x1") - F.col("x0")) >= F.col("page_w") * FULL_PAGE) & ((F.col("y1") - F.col("y0")) >= F.col("page_h") * FULL_PAGE)
    return (F.col(h) >= LEAST_SIDE) & (F.col(w) >= LEAST_SIDE) & (F.col("bytes") >= LEAST_BYTES) & ~((F.col("page") == 1) & (F.col("y0") < LETTERHEAD)) & ~full


INTRO = r"(?:A continuación|se presenta|siguiente)\s+([^\n.]+?(?:esquema|diagrama|plano|figura|croquis|gráfico)[^\n.]*)"
TITLE = r"((?:Figura|Esquema|Diagrama|Plano|Gráfico|Croquis)\s*(?:N?[°º0-9]*\s*[:\-–]?\s*)[^\n.]+)"


def description(page_text: Column, page: Column, w: Column, h: Column) -> Column:
    """Description of a drawing from the text of its page: known drawings, an introducing phrase, a title, else page and size."""

    def of(t: Column) -> Column:
        low = F.lower(t)
        section = low.rlike("corte esquem[aá]tico")
        intro, title = strip(F.regexp_extract(t, ci(INTRO), 1)), strip(F.regexp_extract(t, ci(TITLE), 1))
        return (
            F.when(low.contains("urbanizaciones voluntarias desvinculadas"), "Esquema ilustrativo: Urbanizaciones voluntarias desvinculadas del proceso de división del suelo")
            .when(low.contains("planta azotea") & section, "Esquema ilustrativo: Planta azotea y corte esquemático")
            .when(low.contains("planta azotea"), "Esquema técnico: Planta azotea")
            .when(section, "Esquema técnico: Corte esquemático")
            .when(F.length(intro) > 10, F.concat(F.upper(F.substring(intro, 1, 1)), F.substring(intro, F.lit(2), F.length(intro))))
            .when(F.length(title) > 5, title)
            .otherwise(F.concat(F.lit("Esquema / diagrama técnico en página "), page.cast("string"), F.lit(" ("), w.cast("string"), F.lit("x"), h.cast("string"), F.lit(" px)")))
        )

    return let(T.fix_words(F.coalesce(page_text, F.lit(""))), of)


def kind(text: Column) -> Column:
    return F.when(F.lower(text).contains("esquema"), F.lit("Esquema técnico")).otherwise(F.lit("Imagen / Diagrama"))


def image_manifest(images: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Manifest rows of the kept images: the first occurrence of each reference in a document (on one page the smallest), numbered by page and reference.

    ``images`` has ``doc_id, num, page, xref, w, h, bytes, page_w, page_h, x0, y0, x1, y1``; ``pages`` has ``doc_id, page, text``.
    """
    first = Window.partitionBy("doc_id", "xref").orderBy("page", "w", "h")
    kept = images.where(is_drawing()).withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")
    text = F.lit("")
    if pages is not None:
        kept = kept.join(pages.select("doc_id", "page", F.col("text").alias("_text")), ["doc_id", "page"], "left")
        text = F.col("_text")
    name = description(text, F.col("page"), F.col("w"), F.col("h"))
    rows = kept.select("doc_id", "num", "page", "xref", "w", "h", name.alias("descripcion")).withColumn("k", F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "xref")))
    ident = F.concat(F.lit("DDU_"), F.col("num").cast("string"), F.lit("_img_"), F.col("k").cast("string"))
    return rows.select(
        "doc_id", ident.alias("id"), F.col("descripcion").alias("nombre"), F.col("page").alias("pagina"), kind(F.col("descripcion")).alias("tipo"), F.lit("png").alias("formato"),
        F.concat(F.col("w").cast("string"), F.lit("x"), F.col("h").cast("string")).alias("dimensiones"), F.col("w").alias("ancho"), F.col("h").alias("alto"), "xref", "descripcion",
        F.concat(F.lit("salidas_imagenes/"), ident, F.lit(".png")).alias("archivo_anexo"),
    )


def markdown_images(lines: Column, num: Column) -> Column:
    """Manifest entries of the Markdown images in lines, numbered over the document."""
    one = r"!\[([^\]]*)\]\([^)]+\)"
    alts = F.flatten(F.transform(lines, lambda l, i: F.transform(F.regexp_extract_all(l, F.lit(one), F.lit(1)), lambda a: F.struct(a.alias("a"), (i + 1).alias("n")))))

    def entry(x: Column, k: Column) -> Column:
        name = F.when(strip(x["a"]) != "", strip(x["a"])).otherwise(F.concat(F.lit("Imagen referenciada en línea "), x["n"].cast("string")))
        ident = F.concat(F.lit("DDU_"), num, F.lit("_img_"), (k + 1).cast("string"))
        return F.struct(
            ident.alias("id"), name.alias("nombre"), F.lit(1).alias("pagina"), kind(name).alias("tipo"), F.lit("png").alias("formato"), F.lit("0x0").alias("dimensiones"), F.lit(0).alias("ancho"),
            F.lit(0).alias("alto"), F.lit(0).alias("xref"), name.alias("descripcion"), F.concat(F.lit("salidas_imagenes/"), ident, F.lit(".png")).alias("archivo_anexo"),
        )

    return F.transform(alts, entry)


# Openings of body paragraphs that are no labels.
NARRATIVE = r"(?iu)^(?:En el artículo|Es importante destacar|Se trata de obras|De conformidad|Por otra parte|Asimismo)\b"


def drawing_box(images: DataFrame, blocks: DataFrame) -> DataFrame:
    """Box of the drawings of each page, grown in block order over the labels beside it, with margins, inside the page.

    ``images`` has ``doc_id, page, page_w, page_h, x0, y0, x1, y1``; ``blocks`` the text blocks. The smallest box around the images
    is an aggregate; the growth depends on the order of the blocks and is a fold over the sorted blocks of one page.
    """
    inner = images.where((F.col("y1") < F.col("page_h") - 50) & (F.col("y0") > 100))
    box = inner.groupBy("doc_id", "page").agg(
        *[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"), (F.max, "page_w"), (F.max, "page_h"))]
    )
    label = (strip(F.col("text")) != "") & ~F.col("text").rlike(r"^\s*\d+(?:\.\d+)*\.\s+[A-ZÁÉÍÓÚÑ]") & ~strip(F.col("text")).rlike(NARRATIVE) & (F.length(strip(F.col("text"))) <= 180)
    near = blocks.where(label).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("block_no", "x0", "y0", "x1", "y1"))).alias("bloques"))
    joined = box.join(near, ["doc_id", "page"], "left")
    start = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    page_h = F.col("page_h")

    def step(s: Column, b: Column) -> Column:
        fits = (b["y0"] >= 60) & (b["y1"] <= page_h - 40) & (b["y0"] >= s["y0"] - 25) & (b["y1"] <= s["y1"] + 25) & (b["x0"] >= s["x0"] - 60) & (b["x1"] <= s["x1"] + 60)
        lo = lambda c: F.when(fits, F.least(s[c], b[c].cast("double"))).otherwise(s[c]).alias(c)
        hi = lambda c: F.when(fits, F.greatest(s[c], b[c].cast("double"))).otherwise(s[c]).alias(c)
        return F.struct(lo("x0"), lo("y0"), hi("x1"), hi("y1"))

    none = F.array().cast("array<struct<block_no:int,x0:double,y0:double,x1:double,y1:double>>")
    grown = joined.withColumn("g", F.aggregate(F.coalesce(F.col("bloques").cast("array<struct<block_no:int,x0:double,y0:double,x1:double,y1:double>>"), none), start, step))
    return grown.select(
        "doc_id", "page", F.greatest(F.lit(20.0), F.col("g.x0") - 8).alias("x0"), F.greatest(F.lit(40.0), F.col("g.y0") - 8).alias("y0"),
        F.least(F.col("page_w") - 20, F.col("g.x1") + 8).alias("x1"), F.least(page_h - 20, F.col("g.y1") + 8).alias("y1"),
    )


TRIGGERS = r"(?iu)esquema ilustrativo|siguiente esquema|siguiente figura"


def first_trigger(paragraphs: DataFrame) -> DataFrame:
    """``(doc_id, par_id)``: the first paragraph of a document that introduces a drawing; all its images attach there.

    ``paragraphs`` has ``doc_id, sec_no, par_no, par_id, texto``.
    """
    hits = paragraphs.where(F.col("texto").rlike(TRIGGERS))
    return hits.groupBy("doc_id").agg(F.min_by("par_id", F.struct("sec_no", "par_no")).alias("par_id"))
