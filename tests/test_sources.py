import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fathomleaf import registry as R
from fathomleaf.config import EngineConfig
from fathomleaf.operators import extract as E
from fathomleaf.operators import retrieval
from fathomleaf.plans import document
from fathomleaf.sources import readers, sinks
from fathomleaf.streaming import ingest

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def packed(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name.replace("__", "/").replace("_xml", ".xml").replace("_rels.", "_rels/").replace("xbook.", "workbook."), data)
    return out.getvalue()


def docx():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(
            "word/document.xml",
            f'<w:document xmlns:w="{W}"><w:body><w:p><w:pPr><w:pStyle'
            f' w:val="Heading1"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:p><w:r><w:t>Hello</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>Spread'
            f' [%]</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>2%</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>',
        )
    return out.getvalue()


def xlsx():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{S}" xmlns:r="{REL}"><sheets><sheet name="One" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="p"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{S}"><si><t>name</t></si><si><t>Acme</t></si></sst>')
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{S}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row><row r="2"/><row r="3"><c'
            f' r="A3" t="s"><v>1</v></c></row></sheetData></worksheet>',
        )
    return out.getvalue()


def tree(root):
    a = root / "Acme"
    (a / "sub").mkdir(parents=True)
    (a / "x.txt").write_text("plain text here")
    (a / "sub" / "d.docx").write_bytes(docx())
    (a / "t.xlsx").write_bytes(xlsx())
    (a / "what.bin").write_bytes(b"1")
    (a / "bad.docx").write_bytes(b"no zip")
    (root / ".hidden").mkdir()
    (root / ".hidden" / "y.txt").write_text("no")
    with zipfile.ZipFile(root / "more.zip", "w") as z:
        z.writestr("z.txt", "zipped text")
    return root


def test_read_documents(spark, tmp_path):
    files = readers.scan(spark, str(tree(tmp_path)))
    rows = {(r.company, r.original_file): r for r in readers.read_documents(files).collect()}
    assert rows["Acme", "x.txt"].text == "plain text here"
    assert rows["Acme", "sub/d.docx"].text == "\n## Title\n\nHello\n\n[TABLE]\nSpread [%] | 2%"
    assert rows["Acme", "t.xlsx"].text == "[SHEET: One]\n| name |  | 5 |\n| Acme |  |  |"
    assert rows["Acme", "what.bin"].metadata["type"] == "unsupported" and rows["Acme", "bad.docx"].metadata["type"] == "error"
    assert rows["more", "z.txt"].text == "zipped text" and not any(c.startswith(".") for c, _ in rows)
    assert sorted(r[0] for r in readers.companies(files).collect()) == ["Acme", "more"]


def test_archives_that_cannot_be_read_have_a_row(spark, tmp_path):
    (tmp_path / "Acme").mkdir()
    (tmp_path / "Acme" / "bad.zip").write_bytes(b"PK no archive")
    (tmp_path / "Acme" / "x.7z").write_bytes(b"7z\xbc\xaf\x27\x1c")
    (tmp_path / "top.zip").write_bytes(b"neither")
    with zipfile.ZipFile(tmp_path / "Acme" / "good.zip", "w") as z:
        z.writestr("in/z.txt", "zipped text")
    for root in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}/"):
        rows = {(r.company, r.original_file): r for r in readers.read_documents(readers.scan(spark, root)).collect()}
        assert set(rows) == {("Acme", "bad.zip"), ("Acme", "x.7z"), ("Acme", "good/in/z.txt"), ("top", "top.zip")}
        assert rows[
            "Acme", "bad.zip"
        ].metadata["type"] == rows["top", "top.zip"].metadata["type"] == "error" and "BadZipFile" in rows["top", "top.zip"].metadata["error"]
        assert rows["Acme", "x.7z"].metadata["type"] in ("unsupported", "error") and rows["Acme", "good/in/z.txt"].text == "zipped text"


def png(width, height):
    return b"\x89PNG\r\n\x1a\n" + bytes(8) + width.to_bytes(4, "big") + height.to_bytes(4, "big")


def test_images_in_workbooks_and_their_sizes():
    out = io.BytesIO(xlsx())
    with zipfile.ZipFile(out, "a") as z:
        z.writestr("xl/media/image1.png", png(200, 100))
        z.writestr("xl/media/image2.png", png(10, 100))
        z.writestr("xl/media/image3.png", png(200, 100))
    calls = []
    text, meta = readers.extract("t.xlsx", out.getvalue(), lambda b: calls.append(b) or "read")
    assert text.endswith("[IMAGE]\nread\n\n[IMAGE]\nread") and meta["images"] == "2" and len(calls) == 2
    assert readers.image_size(png(3, 4)) == (3, 4)
    assert readers.image_size(b"BM" + bytes(16) + (7).to_bytes(4, "little") + (-9).to_bytes(4, "little", signed=True)) == (7, 9)
    assert readers.image_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x20\x00\x40" + bytes(9)) == (64, 32)

    def broken(data):
        raise ValueError

    assert readers.first_of(broken, lambda b: " ", lambda b: "third")(b"") == "third"
    assert readers.extract("old.xls", b"\xd0\xcf\x11\xe0")[1]["type"] in ("unsupported", "error")  # without and with its library


def test_images_and_memo():
    assert readers.worth_reading((60, 60)) and not readers.worth_reading((10, 60)) and not readers.worth_reading((50, 1001))
    calls = []
    seen = {}
    ocr = lambda b: calls.append(b) or "seen"
    assert [readers.extract("a.jpg", b"q", ocr, seen=seen)[0] for _ in range(2)] == ["seen", "seen"] and len(calls) == 1


def test_csv_and_golden(spark, tmp_path):
    (tmp_path / "g.tsv").write_text("A\tB\n1\tx y\n")
    assert [tuple(r) for r in readers.read_golden(spark, str(tmp_path / "g.tsv")).collect()] == [("1", "x y")]
    (tmp_path / "g.xlsx").write_bytes(xlsx())
    assert readers.read_golden(spark, str(tmp_path / "g.xlsx")).columns[0] == "name"
    (tmp_path / "g.data").write_bytes(xlsx())
    assert readers.read_golden(spark, str(tmp_path / "g.data")).columns[0] == "name"
    (tmp_path / "h.data").write_text("A,B\n1,2\n")
    assert readers.read_golden(spark, str(tmp_path / "h.data")).columns == ["A", "B"]
    df = spark.createDataFrame([("c", "x", "a,\n\"b\"")], ["Client Folder", "zz", "Borrower name"])
    sinks.write_csv(df, str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out"))
    assert back.columns == ["Client Folder", "Borrower name", "zz"] and back.first()[1] == 'a,\n"b"'


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, ck = (tmp_path / n for n in ("in", "out", "ck"))
    src.mkdir()
    (src / "a.txt").write_text("first file")
    (src / "b.txt").write_text("   ")
    for n, name in ((1, None), (2, "c.txt")):
        if name:
            (src / name).write_text("second file")
        ingest.ingest(spark, str(src), str(out), str(ck)).awaitTermination(60)
        assert spark.read.parquet(str(out)).count() == n


def test_event_windows(spark, data):
    got = ingest.event_windows(spark.read.parquet(f"{data}/events.parquet"))
    assert got.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{data}/events.parquet").count()


def test_whole_way(spark):
    text = "Facility Agreement\nBorrower name: Acme BV\nSpread [%]: 250 bps\nBase Rate of the facility: EURIBOR\nIs facility syndicated?: Yes\n" + "other words of the agreement here\n" * 5
    files = spark.createDataFrame(
        [("acme", 1, "a.txt", text), ("acme", 2, "b.txt", "\n"), ("zeta", 1, "c.txt", "Upfront Fee [%] | 1% | x\nmore of it")],
        "company string, ord long, file string, text string",
    )
    result = document.run(spark, files)
    rows = {r["Client Folder"]: r for r in result.rows.collect()}
    assert result.rows.columns == [*R.METADATA, *R.FIELDS]
    assert rows["acme"]["Borrower name"] == "Acme BV" and rows["acme"]["Spread [%]"] == "2.50%" and rows["acme"]["Source Files"] == "a.txt"
    assert "1: syndicated without a share" in [i for r in result.issues.collect() for i in r.issues]
    assert {r.step for t in result.traces for r in t.collect()} >= {"facility_detection", "extract", "verification", "deep_extract"}


def embedding_model():
    """What makes a stand-in for an embedding model, counts of letters; workers get it by value."""

    def make():
        return lambda texts: [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]

    return make


def test_whole_way_with_other_retrievers_and_more_facilities(spark):
    text = "FACILITY: A | Term Loan | EUR 1\nFACILITY: B | RCF | EUR 2\nBorrower name: Acme BV\nSpread [%]: 99 bps\n" + "other words of the agreement here\n" * 5
    files = spark.createDataFrame([("acme", 1, "a.txt", text)], "company string, ord long, file string, text string")
    for kind in ("embedding", "hybrid"):
        result = document.run(spark, files, config=EngineConfig(retriever=kind), embedder=embedding_model())
        rows = result.rows.collect()
        assert [r["Spread [%]"] for r in rows] == ["0.99%", "0.99%"] and sorted(r.name for r in result.facilities.collect()) == ["A", "B"]
    with pytest.raises(ValueError):
        document.run(spark, files, config=EngineConfig(retriever="hybrid"))


def test_sinks_of_details_and_traces(spark, tmp_path):
    rows = spark.createDataFrame(
        [("c", 0, "g", "f", "1", "e", "HIGH"), ("c", 1, "g", "f", "2", "e", "LOW")],
        "company string, facility_idx int, `group` string, field string, value string, evidence string, confidence string",
    )
    sinks.write_detailed(E.detailed_json(rows), str(tmp_path / "json"))
    told = json.loads(spark.read.text(str(tmp_path / "json")).first()[0])
    assert told["company"] == "c" and [f["fields"]["f"]["value"] for f in told["facilities"]] == ["1", "2"]
    asked = spark.createDataFrame(
        [("c", "s", "- Spread [%]: x\nDOCUMENT TEXT:\nSpread [%]: 2%", 9)], "company string, system string, prompt string, max_tokens int"
    )
    sinks.write_traces(E.stored_traces(E.call_model(asked, key="fields"), "extract"), str(tmp_path / "traces"))
    trace = spark.read.parquet(str(tmp_path / "traces")).first()
    assert trace.step == "extract" and trace.parsed_ok and trace.tries == 1 and trace.input_tokens == 9
    chunks = spark.createDataFrame([("c", 1, "abc")], "company string, id long, text string")
    sinks.write_embeddings(retrieval.embed(chunks, embedding_model()), "kept_vectors", 2)
    assert spark.table("kept_vectors").count() == 1
    spark.sql("drop table kept_vectors")
    found = readers.manifest(readers.read_documents(readers.scan(spark, str(tree(tmp_path / "t")))), F.lit("en"))
    sinks.append(found, str(tmp_path / "manifest"))
    assert spark.read.parquet(str(tmp_path / "manifest")).filter("company = 'Acme'").count() == 5
