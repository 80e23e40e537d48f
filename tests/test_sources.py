import io
import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from saltmarsh import runs
from saltmarsh.sources import documents, tables
from saltmarsh.sources.remote import ImportService, RemoteError


def test_delimited():
    assert tables.parse_delimited("Código;Nombre;Precio\nA-1;Crema;10\nA-2;Jabón\n".encode()) == [["Código", "Nombre", "Precio"], ["A-1", "Crema", "10"], ["A-2", "Jabón"]]
    assert tables.parse_delimited("a\tb\n1\t2\n".encode("utf-8-sig")) == [["a", "b"], ["1", "2"]]
    assert tables.decode("ñ".encode("latin-1")) == "ñ"
    assert tables.headers(["a", " ", "a", None]) == ["a", "column_2", "a__2", "column_4"]
    with pytest.raises(ValueError):
        tables.parser("x.pdf")


def sheet() -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>sku</t></si><si><t>nombre</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="3"><c r="A3"><v>7</v></c><c r="B3" t="b"><v>1</v></c><c r="C3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_sheets_as_they_are_shown():
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><bookViews><workbookView activeTab="1"/></bookViews><sheets><sheet name="S" sheetId="1" r:id="r1"/><sheet name="T" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="&quot;day&quot; 0.0"/><numFmt numFmtId="165" formatCode="dd/mm/yyyy hh:mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" s="1"><v>45292</v></c><c r="B1" s="2"><v>45292</v></c><c r="C1" s="3"><v>45292.5</v></c><c r="D1" t="str" s="1"><v>12</v></c><c r="E1"><v>1.5</v></c></row></sheetData></worksheet>')
    assert tables.parse_sheet(out.getvalue()) == [["2024-01-01", "45292", "2024-01-01 12:00:00", "12", "1.5"]]
    assert tables.parse_sheet(out.getvalue(), "S") == []


def document() -> bytes:
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'

    def row(*cells):
        return "<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{c}</w:t></w:r></w:p></w:tc>" for c in cells) + "</w:tr>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:tbl>{row('Producto', 'Precio POR unid. bs', 'Precio venta A profesional')}{row('Crema 250 g', '36,02', 'Bs 110')}{row('', '1', '2')}</w:tbl></w:body></w:document>")
    return out.getvalue()


def test_sheet_and_document(spark, tmp_path):
    assert tables.parse_sheet(sheet()) == [["sku", None, "nombre"], [], ["7", "TRUE", "x"]]
    with pytest.raises(ValueError):
        tables.parse_sheet(sheet(), "none")
    (tmp_path / "lista.docx").write_bytes(document())
    rows = tables.price_list(tables.read_table(spark, str(tmp_path / "lista.docx")), "B").collect()
    assert [(r.raw_name, float(r.cost), float(r.price), r.source_row) for r in rows] == [("Crema 250 g", 36.02, 110.0, 2)]


def test_run(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Código,Nombre,Precio,Existencias\nPR-1,Crema,89,4\n\n")
    run, checked = runs.validate_file(spark, str(path), "productos", out=str(tmp_path / "out"))
    assert run.status == "ready" and checked.valid.count() == 1
    back = spark.read.parquet(str(tmp_path / "out" / run.run_id / "productos.parquet")).first()
    assert (back.sku, back._source_row, float(back.precio)) == ("PR-1", 2, 89.0)
    assert (tmp_path / "out" / "raw" / f"{run.run_id}__in.csv").read_text() == path.read_text()
    run.approve("ana")
    with pytest.raises(ValueError):
        run.approve("ana")
    run.write(spark, str(tmp_path / "out"))
    assert runs.Run.read(spark, str(tmp_path / "out"), run.run_id) == run
    with pytest.raises(FileExistsError):
        runs.keep_raw(spark, str(path), str(tmp_path / "out"), run.run_id)


class _Service(BaseHTTPRequestHandler):
    seen: list = []
    failing = 0

    def _answer(self, value, status=200):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(value).encode())

    def do_GET(self):
        if self.path.endswith("entidades"):
            return self._answer(["productos"])
        state = "completado" if self.path.endswith("1") else "error"
        return self._answer({"estado": state, "error": "roto", "resultado": {"fallidos": self.failing}})

    def do_POST(self):
        body, size = b"", None
        while size != 0:
            size = int(self.rfile.readline().strip() or b"0", 16)
            body += self.rfile.read(size)
            self.rfile.readline()
        self.seen.append((self.headers["Authorization"], body.decode()))
        self._answer({"trabajo_id": "1"} if b"productos" in body else {"detail": {"message": "no", "code": "x1"}}, 200 if b"productos" in body else 422)

    def log_message(self, *args):
        pass


def test_publishing(spark, tmp_path):
    server = ThreadingHTTPServer(("127.0.0.1", 0), _Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    service = ImportService(f"http://127.0.0.1:{server.server_port}", "secreto", poll_s=0.01)
    assert service.entities() == ["productos"]
    records = spark.createDataFrame([("PR-1", "a, b"), ("PR-2", None)], "sku string, nombre string")

    def approved():
        run = runs.Run("productos", "f", "h", status="ready", report={"valid_rows": 2, "invalid_rows": 0})
        run.approve("ana")
        return run

    with pytest.raises(ValueError):
        runs.publish(approved(), records, service, False)
    run = runs.publish(approved(), records, service, True)
    assert run.status == "published"
    trial, final = (b for _, b in _Service.seen)
    assert "true" in trial and "false" in final and 'sku,nombre\r\nPR-1,"a, b"\r\nPR-2,\r\n' in final and _Service.seen[0][0] == "Bearer secreto"
    _Service.failing, run = 1, approved()
    with pytest.raises(ValueError):
        runs.publish(run, records, service, True)
    assert run.status == "publish_failed"
    with pytest.raises(RemoteError) as e:
        service.send("nada", "f.csv", [b""], {}, True)
    assert (e.value.status, e.value.code) == (422, "x1")
    with pytest.raises(RemoteError):
        service.wait("2")
    with pytest.raises(ValueError):
        ImportService("http://x", "")
    server.shutdown()


def test_documents(spark, tmp_path):
    (tmp_path / "b").mkdir()
    for name, text in (("b/Uno.PDF", "Crema azul grande|1|2"), ("dos.png", "x"), ("tres.pdf", "roto"), ("cuatro.pdf", "|".join("abcdef")), ("nota.txt", "n")):
        (tmp_path / name).write_text(text)

    def pdf(raw):
        if raw == b"roto":
            raise OSError("damaged")
        return [documents.Page(100, 200, [(t, (1.0, 2.0, 3.0, 4.0), None)] if len(t) > 3 else [], lambda t=t: t.encode(), 2.0) for t in raw.decode().split("|")]

    def image(raw):
        return [documents.Page(10, 20, [], lambda: raw, 1.0, "pixels")]

    def reader(png, scale):
        return [(f"leído {png.decode()} {scale:g}", (0.0, 0.0, 1.0, 1.0), 0.5)] if png != b"2" else []

    def broken(png, scale):
        raise RuntimeError("none here")

    got = documents.read_documents(spark, str(tmp_path), {"application/pdf": pdf, "image": image}, {"a": broken, "b": reader}, max_pages=5)
    rows = sorted((r.source_file, r.page_number or 0, r.method, r.engine, r.text) for r in got.collect())
    assert rows == [("b/Uno.PDF", 1, "native", None, "Crema azul grande"), ("b/Uno.PDF", 2, "ocr", "b", "leído 1 2"), ("b/Uno.PDF", 3, "ocr", "none", None), ("cuatro.pdf", 0, None, None, None), ("dos.png", 1, "ocr", "b", "leído x 1"), ("tres.pdf", 0, None, None, None)]
    assert {r.source_file: r.error for r in documents.failures(got).collect()} == {"cuatro.pdf": "ValueError: 6 pages, 5 allowed", "tres.pdf": "OSError: damaged"}
    assert got.where("source_file = 'dos.png'").first().warning == "a: none here" and got.where("source_file = 'dos.png'").first().media_type == "image/png"
    with pytest.raises(ValueError):
        documents.read_documents(spark, str(tmp_path / "nota.txt"))
    with pytest.raises(ValueError):
        documents.recognise(b"", 1.0, {}, "c")


def test_evidence(spark, tmp_path):
    path = tmp_path / "e.jsonl"
    path.write_text('{"a": 1}\n\n{"a": 2}\n[3]\n')
    assert [(r._pos, r.a) for r in tables.read_evidence(spark, str(path), "a int", 2).orderBy("_pos").collect()] == [(0, 1), (1, 2)]
    assert [(r._pos, r.a) for r in tables.read_evidence(spark, None, "a int", 2).collect()] == [(0, None), (1, None)]
    with pytest.raises(ValueError):
        tables.read_evidence(spark, str(path), "a int", 3)


def test_folders(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("h\n1\n")
    (tmp_path / "a" / "x.pdf").write_text("?")
    assert tables.scan(spark, str(tmp_path), recursive=True).count() == 2
    (tmp_path / "a" / "x.csv").unlink()
    with pytest.raises(ValueError):
        tables.scan(spark, str(tmp_path), recursive=True)


def test_blocked_run(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Código;Nombre;Existencias\nPR-1;Crema;-2\n")
    run, _ = runs.validate_file(spark, str(path), "productos")
    assert run.status == "blocked"
    with pytest.raises(ValueError):
        run.approve("ana")


def test_streamed_files(spark, tmp_path):
    from saltmarsh.streaming.ingest import validate_arrivals

    df = spark.createDataFrame([(2, "a", "x"), (3, "b", None)], "row_number int, sku string, nombre string")
    df.write.parquet(str(tmp_path / "in"))
    validate_arrivals(spark, str(tmp_path / "in"), df.schema, "productos", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "valid")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine")).select(F.col("issues")[0]["code"]).first()[0] == "required_field_missing"
