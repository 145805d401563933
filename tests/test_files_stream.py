"""Files, connectors and streams."""

import pytest
from pyspark.sql import functions as F

from acervo.operators import eav
from acervo.sources import files, pages, service
from acervo.streaming import document_stream, record_stream, write_records


def test_eav_files(spark, tmp_path):
    rows = [(1, 'DDU 1', 'con "comillas"; y\nsaltos', None), (2, "DDU 2", "", "Ana")]
    r = spark.createDataFrame(rows, "k int, numero string, materia string, firmante string")
    files.write_eav_csv(r, "k", str(tmp_path / "out"))
    text = next((tmp_path / "out" / "k=1").glob("part*")).read_bytes()
    assert text.startswith(b'"bloque";"campo";"valor_extraido"\r\n') and text.count(b"\r\n") == 17  # 16 lines, and the line feed of a value, which the writer normalises
    back = files.read_eav_csv(spark, str(tmp_path / "out" / "*"))
    wide = {x["numero_ddu"]: x for x in eav.pivot(back).collect()}
    assert wide["DDU 1"]["materia"] == 'con "comillas"; y\nsaltos' and wide["DDU 2"]["firmante"] == "Ana" and back.where("row_no = 0").count() == 2
    bom = tmp_path / "bom.csv"
    bom.write_bytes("﻿bloque;campo;valor_extraido\r\nA;numero_ddu;DDU 9\r\n".encode())
    assert files.read_eav_csv(spark, str(bom)).first()["campo"] == "numero_ddu"


def test_records_of_files(spark):
    rows = [("f", 1, "numero_ddu", "DDU 1"), ("f", 2, "numero_ddu", "DDU 2"), ("f", 3, "fecha_emision", "Santiago, 2020-01-02"), ("f", 4, "cuerpo", "1. Uno. 2. Dos."), ("g", 1, "fecha_emision", "2020")]
    e = spark.createDataFrame(rows, "file string, row_no int, campo string, valor_extraido string")
    got = {r["file"]: r for r in eav.record(eav.pivot(e)).collect()}
    assert got["f"]["numero"] == "DDU 2" and (got["f"]["lugar"], got["f"]["fecha"]) == ("Santiago", "2020-01-02") and got["f"]["secciones"][0]["parrafos"] == ["1. Uno.", "2. Dos."]
    assert got["g"]["fecha"] == "2020" and got["g"]["secciones"] == [] and len(eav.record(eav.pivot(e), False).where("file = 'f'").first()["secciones"][0]["parrafos"]) == 1


def test_master_and_tables(spark, tmp_path):
    r = spark.createDataFrame([("DDU 1", "x")], "numero string, materia string")
    files.write_master_csv(r, str(tmp_path / "m"), single=True)
    back = files.read_master_csv(spark, str(tmp_path / "m"))
    assert len(back.columns) == 14 and back.first()["numero_ddu"] == "DDU 1"
    files.write_table_csv(spark.createDataFrame([("t1", 1, ["a", 'b"c'])], "tabla_id string, orden int, celdas array<string>"), str(tmp_path / "t"))
    assert next((tmp_path / "t" / "tabla_id=t1").glob("part*")).read_bytes() == b'"a";"b""c"\r\n'


def test_documents(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"uno\x00\x00dos")
    (tmp_path / "b.pdf").write_bytes(b"malo")

    def parse(data):
        if data == b"malo":
            raise ValueError("x")
        return data.decode().split("\x00")

    got = {r["file"]: r for r in files.read_documents(spark, str(tmp_path), parse).collect()}
    assert got["a.pdf"]["text"] == "uno\n\ndos" and got["b.pdf"]["text"] is None and "ValueError" in got["b.pdf"]["error"]
    assert files.read_documents(spark, str(tmp_path / "a.pdf"), parse, skip_empty=True).first()["text"] == "uno\ndos"


def test_service():
    answer = lambda status, body="": lambda url: (status, body)
    assert service.query("http://h", "s", "k", {"id": "1"}, answer(200, "ok")) == "ok"
    for status, error in ((401, PermissionError), (403, PermissionError), (404, FileNotFoundError), (500, RuntimeError)):
        with pytest.raises(error):
            service.query("http://h", "s", "k", {}, answer(status))
    with pytest.raises(ValueError):
        service.query("http://h", "s", "", {}, answer(200))


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "DDU 7\nMAT.: Uno."), (2, None)], "doc_id bigint, text string").write.parquet(str(tmp_path / "in"))
    q = write_records(record_stream(document_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r["doc_id"]: r["numero"] for r in spark.read.parquet(str(tmp_path / "out")).select("doc_id", "numero").where(F.col("doc_id").isNotNull()).collect()}
    assert got == {1: "DDU 7", 2: ""}


def test_page_scans(spark, tmp_path):
    """Cells, blocks and images of documents through given engines; a bad document gives its error."""
    (tmp_path / "a.pdf").write_bytes(b"3")
    (tmp_path / "b.pdf").write_bytes(b"x")
    cells = pages.read_cells(spark, str(tmp_path), lambda d: [(1, 1, r, c, f"{r}{c}" if c else None) for r in range(int(d)) for c in range(2)])
    rows = cells.orderBy("file", "row_no", "col_no").collect()
    assert [(r["row_no"], r["col_no"], r["text"]) for r in rows if r["file"] == "a.pdf"] == [(r, c, f"{r}{c}" if c else None) for r in range(3) for c in range(2)]
    assert [r["error"][:10] for r in rows if r["file"] == "b.pdf"] == ["ValueError"]
    blocks = pages.read_blocks(spark, str(tmp_path / "a.pdf"), lambda d: [(1, 1, 0.0, 1.0, 2.0, 3.0, "t", 0)])
    assert blocks.columns == ["file", "page", "block_no", "x0", "y0", "x1", "y1", "text", "type", "error"] and blocks.count() == 1
    images = pages.read_images(spark, str(tmp_path / "a.pdf"), lambda d: [(1, 5, 70, 80, 2, 600.0, 800.0, 0.0, 0.0, 1.0, 1.0, b"ab")])
    done = pages.write_images(images.select(F.lit("d/x.png").alias("archivo_anexo"), "content"), str(tmp_path / "out")).collect()
    assert [(r["bytes"], r["error"]) for r in done] == [(2, None)] and (tmp_path / "out" / "d" / "x.png").read_bytes() == b"ab"
    bad = pages.write_images(images.select(F.lit("../x.png").alias("archivo_anexo"), "content"), str(tmp_path / "out")).collect()
    assert bad[0]["bytes"] == 0 and "ValueError" in bad[0]["error"]
    assert "Error" in pages.read_cells(spark, str(tmp_path / "a.pdf")).first()["error"]  # the optional library is absent


def test_signatures(spark, tmp_path):
    for n in ("a", "b", "c"):
        (tmp_path / f"{n}.pdf").write_bytes(n.encode())
    read = {"a": ["Saluda atentamente a Ud.,", "ROSA PEREZSOTO", "x", "Jefe División de Desarrollo Urbano"], "b": ["Ana Soto Ríos"], "c": []}
    rows = pages.read_signatures(spark, str(tmp_path), lambda d: list(enumerate(read[d.decode()])))
    got = {r["file"]: r["nombre"] for r in pages.signer_read(rows, ((r"\bPEREZSOTO\b", "PEREZ SOTO"),)).collect()}
    assert got == {"a.pdf": "ROSA PEREZ SOTO"}


def test_buckets_and_slices(spark, tmp_path):
    r = spark.createDataFrame([(i, f"DDU {i}", 'a "b"; c') for i in range(20)], "k int, numero string, materia string")
    files.write_eav_buckets(r, "k", str(tmp_path / "b"), 3)
    assert len(list((tmp_path / "b").glob("cubo=*"))) <= 3
    wide = {x["file"]: x for x in eav.pivot(files.read_eav_buckets(spark, str(tmp_path / "b"))).collect()}
    assert len(wide) == 20 and all(wide[str(i)]["numero_ddu"] == f"DDU {i}" and wide[str(i)]["materia"] == 'a "b"; c' for i in range(20))
    reader = service.ServiceReader({"ids": "[1, 2, 3, 4, 5]", "per": "2"})
    assert [p.value for p in reader.partitions()] == [[1, 2], [3, 4], [5]] and len(service.ServiceReader({}).partitions()) == 1


def test_command_line(spark, tmp_path):
    import json

    from acervo import cli

    (tmp_path / "a.txt").write_text("DDU 900\nMAT.: Una materia.\n\nTexto")
    (tmp_path / "b.txt").write_text(" ")
    got = {r["file"]: json.loads(r["json"]) for r in cli.extract(spark, "materia", str(tmp_path)).collect()}
    assert got["a.txt"]["datos"] == {"materia": "Una materia."} and got["a.txt"]["exito"] and not got["b.txt"]["exito"]
    assert json.loads(cli.extract(spark, "todo", str(tmp_path / "a.txt")).first()["json"])["numero"] == "DDU 900"
