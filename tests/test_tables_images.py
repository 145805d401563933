"""Tables and images on small literal cases."""

from pyspark.sql import functions as F

from acervo.operators import images, tables


def test_markdown_table(spark):
    lines = ["Texto:", "| Circular | Cambio | Motivo |", "| --- | --- | --- |", "| DDU 1 | Modifica uno | Nueva |", "| DDU 2 | Modifica dos | |", "Fin", "| solo | dos |", "| --- | --- |"]
    df = spark.createDataFrame([(lines,), ([],)], "l array<string>")
    got = [r[0] for r in df.select(tables.markdown_tables(F.col("l"))).collect()]
    assert len(got[0]) == 1 and got[0][0]["encabezados"] == ["Circular", "Cambio", "Motivo"] and got[0][0]["filas"][1] == ["DDU 2", "Modifica dos", ""] and got[1] == []
    m = df.select(tables.manifest(tables.markdown_tables(F.col("l")), F.lit("7"))).first()[0][0]
    assert (m["id"], m["filas"], m["columnas"], m["paginas"]) == ("DDU_7_tabla_1", 2, 3, [1])


def test_subrows(spark):
    rows = [["DDU 339", "Circular a", "m1"], ["", "cont", "m2"], [None, None, None], ["DDU 322", "x", "1. y"], ["", "", "2. z", "sobra"]]
    df = spark.createDataFrame([(rows,)], "r array<array<string>>")
    assert df.select(tables.merge_subrows(F.col("r"), 3)).first()[0] == [["DDU 339", "Circular a cont", "m1 m2"], ["DDU 322", "x", "1. y\n2. z"]]
    wide = [["a", "1", "", ""], ["", "2", "", ""], ["", "x", "01-02-03", "d"], ["", "", "", "e"]]
    assert len(spark.createDataFrame([(wide,)], "r array<array<string>>").select(tables.merge_subrows(F.col("r"), 4)).first()[0]) == 3


def test_pages(spark):
    parts = [(1, [["x"]]), (2, [["N° CIRCULAR", "FECHA"], ["1", "a"]]), (3, [["", "b"], ["2", "c"]]), (4, [["Tipo de gestión", "Casos que comprende"], ["q", "r"]]), (5, [["p", "q", "r"], ["s", "", ""]])]
    df = spark.createDataFrame([(parts,), ([],)], "p array<struct<pagina:int,filas:array<array<string>>>>")
    got = [r[0] for r in df.select(tables.merge_pages(F.col("p"))).collect()]
    assert [(t["paginas"], t["filas"]) for t in got[0]] == [([2, 3], [["1", "a b"], ["2", "c"]]), ([4, 5], [["q", "r"], ["p", "q"], ["s", ""]])] and got[1] == []
    alone = spark.createDataFrame([([(1, [["p", "q", "r"], ["s", "", ""]])],)], "p array<struct<pagina:int,filas:array<array<string>>>>").select(tables.merge_pages(F.col("p"))).first()[0]
    assert alone[0]["encabezados"] == ["Columna 1", "Columna 2", "Columna 3"] and len(alone[0]["filas"]) == 2


def test_compact(spark):
    df = spark.createDataFrame([([["Col1", "   ", "Col3"], ["v1", " ", "v3"]],), ([["a"]],), ([],)], "r array<array<string>>")
    got = [r[0] for r in df.select(tables.compact(F.col("r"))).collect()]
    assert got[0]["encabezados"] == ["Col1", "Col3"] and got[0]["filas"] == [["v1", "v3"]] and got[1] is None and got[2] is None


def test_images(spark):
    lines = ["![Esquema de planta](a.png) y ![](b.png)", "nada"]
    m = spark.createDataFrame([(lines,)], "l array<string>").select(images.markdown_images(F.col("l"), F.lit("5"))).first()[0]
    assert [(x["id"], x["nombre"], x["tipo"]) for x in m] == [("DDU_5_img_1", "Esquema de planta", "Esquema técnico"), ("DDU_5_img_2", "Imagen referenciada en línea 1", "Imagen / Diagrama")]
