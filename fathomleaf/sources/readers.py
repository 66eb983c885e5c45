"""Readers: trees and archives of documents, JSON, CSV, golden records, embeddings.

Files are read by Spark (``binaryFile``), one row a file, and turned into text in Arrow batches by a reader for their
extension. Text, ZIP, DOCX and XLSX need the standard library only; PDF, MSG and 7z need optional libraries, images an OCR
function; where one is missing the row says so in ``metadata`` and has no text, and the job goes on.
"""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomleaf.config import EngineConfig
from fathomleaf.operators.retrieval import norm

Ocr = Callable[[bytes], str]
Extracted = tuple[str, dict[str, str]]
ARCHIVES = (".zip", ".7z")
IMAGES = (".png", ".jpg", ".jpeg", ".bmp", ".tiff")
LEAST_SIDE, GREATEST_ASPECT = 50, 20
SHEET_BYTES = 64 << 20
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
MEMBER = T.StructType([T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())])
FILE = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("original_file", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)


def scan(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of every file under ``root``; paths relative to it; archives replaced by their members.

    The root is written out in full by its own file system, as the paths of files are, so that a root without a scheme or
    a host is taken off them too.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/") + "/"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return expand_archives(
        raw.select(
            F.when(F.col("path").startswith(base), F.substring("path", len(base) + 1, 1 << 20)).otherwise(F.col("path")).alias("path"), "content"
        )
    )


def expand_archives(files: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                folder, dot, kind = path.rpartition(".")
                if f".{kind.lower()}" not in ARCHIVES or not dot:
                    yield pd.DataFrame({"path": [path], "content": [content]})
                    continue
                try:
                    for name, data in _members(content, kind.lower()):
                        yield pd.DataFrame({"path": [f"{folder}/{name}"], "content": [data]})
                except Exception:  # an archive that cannot be read stays, and its row will say why
                    yield pd.DataFrame({"path": [path if "/" in path.strip("/") else f"{folder}/{path}"], "content": [content]})

    return files.select("path", "content").mapInPandas(run, MEMBER)


def _members(content: bytes, kind: str) -> Iterator[tuple[str, bytes]]:
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            yield from ((i.filename, z.read(i)) for i in z.infolist() if not i.is_dir())
    else:
        import py7zr

        with py7zr.SevenZipFile(io.BytesIO(content)) as z:
            yield from ((n, f.read()) for n, f in z.readall().items())


def company_of(path: Column | str = "path") -> Column:
    """The first folder of a relative path."""
    return F.regexp_extract(path, r"^/?([^/]+)/", 1)


def companies(files: DataFrame, only: str | None = None) -> DataFrame:
    """Distinct companies that do not start with a dot."""
    own = files.select(company_of("path").alias("company")).filter("company <> '' and company not like '.%'").distinct()
    return own.filter(F.col("company") == only) if only else own


def read_text(data: bytes) -> Extracted:
    return data.decode("utf-8", errors="ignore"), {"type": "text"}


def read_docx(data: bytes) -> Extracted:
    """Paragraphs (headings marked), then all tables, cells with bars between."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    out, n_paragraphs, tables = [], 0, []
    for e in body if body is not None else ():
        if e.tag == f"{_W}p" and text(e).strip():
            n_paragraphs += 1
            style = e.find(f"{_W}pPr/{_W}pStyle")
            heading = style is not None and style.get(f"{_W}val", "").startswith("Heading")
            out.append(f"\n## {text(e)}\n" if heading else text(e))
        elif e.tag == f"{_W}tbl":
            tables.append("\n".join(" | ".join(text(c).strip() for c in r.iter(f"{_W}tc")) for r in e.iter(f"{_W}tr")))
    out += [f"\n[TABLE]\n{t}" for t in tables]
    return "\n".join(out), {"type": "docx", "paragraphs": str(n_paragraphs), "tables": str(len(tables))}


def _cell(c: ElementTree.Element, shared: list[str]) -> str:
    kind = c.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_S}t"))
    v = c.findtext(f"{_S}v") or ""
    return shared[int(v)] if kind == "s" and v else v


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]*", ref)[0]:
        n = 26 * n + ord(ch) - 64
    return n - 1


def read_xlsx_rows(data: bytes) -> dict[str, list[list[str]]]:
    """Sheet name -> rows of cell texts, rows without any text left out."""
    out: dict[str, list[list[str]]] = {}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = [
            "".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")
        ] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"):
            target = targets[sheet.get(f"{_R}id")].lstrip("/")
            rows = []
            for r in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_S}row"):
                own: list[str] = []
                for c in r.iter(f"{_S}c"):
                    at = _column(c.get("r", "")) if c.get("r") else len(own)
                    own += [""] * (at + 1 - len(own))
                    own[at] = _cell(c, shared)
                if any(own):
                    rows.append(own)
            out[sheet.get("name", "")] = rows
    return out


def read_xls_rows(data: bytes) -> dict[str, list[list[str]]]:
    """As ``read_xlsx_rows``, of the older binary format."""
    import xlrd

    with xlrd.open_workbook(file_contents=data, on_demand=True) as book:
        return {s.name: [own for r in range(s.nrows) if any(own := [str(v) for v in s.row_values(r)])] for s in book.sheets()}


def sheet_rows(data: bytes) -> dict[str, list[list[str]]]:
    """Rows of a workbook by what it is, not by its name."""
    return read_xlsx_rows(data) if data[:2] == b"PK" else read_xls_rows(data)


def workbook_images(data: bytes) -> list[tuple[str, bytes]]:
    if data[:2] != b"PK":
        return []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [(n, z.read(n)) for n in sorted(z.namelist()) if n.startswith("xl/media/") and "." + n.rpartition(".")[2].lower() in IMAGES]


def read_xlsx(data: bytes, ocr: Ocr | None = None, seen: dict[str, str] | None = None) -> Extracted:
    """Sheets as tables, then what OCR reads in the images of the workbook."""
    sheets = sheet_rows(data)
    parts = []
    for name, rows in sheets.items():
        wide = max((len(r) for r in rows), default=0)
        parts.append("\n".join([f"[SHEET: {name}]", *("| " + " | ".join(r + [""] * (wide - len(r))) + " |" for r in rows)]))
    images = [t for _, image in workbook_images(data) if (t := read_image(image, ocr, seen)).strip()]
    parts += [f"[IMAGE]\n{t}" for t in images]
    return "\n\n".join(parts), {"type": "excel", "sheets": ",".join(sheets), "images": str(len(images))}


def first_of(*readers: Ocr) -> Ocr:
    """OCR by the first reader that finds text; one that fails gives way to the next."""

    def read(data: bytes) -> str:
        for own in readers:
            try:
                if (found := own(data)).strip():
                    return found
            except Exception:  # noqa: S112  the next reader's turn
                continue
        return ""

    return read


def read_image(data: bytes, ocr: Ocr | None, seen: dict[str, str] | None = None) -> str:
    """What OCR makes of an image worth reading; ``seen`` remembers what it made of equal ones."""
    seen = {} if seen is None else seen
    key = hashlib.md5(data).hexdigest()
    if key not in seen:
        seen[key] = ocr(data) if ocr and worth_reading(image_size(data)) else ""
    return seen[key]


def read_pdf(data: bytes, ocr: Ocr | None, config: EngineConfig) -> Extracted:
    """Pages under banners; a page of little text is drawn and read by OCR, if that finds any."""
    import fitz

    pages, read = [], []
    with fitz.open(stream=data, filetype="pdf") as doc:
        for n, page in enumerate(doc, 1):
            text = page.get_text()
            if ocr and len(text.strip()) < config.ocr_below_chars:
                seen = ocr(page.get_pixmap(dpi=config.dpi).tobytes("png"))
                if seen.strip():
                    text = seen
                    read.append(n)
            pages.append(f"\n{'=' * 60}\n[PAGE {n}]\n{'=' * 60}\n{text}")
    return "".join(pages), {"type": "pdf", "pages": str(len(pages)), "ocr_pages": ",".join(map(str, read))}


def read_msg(data: bytes) -> Extracted:
    import extract_msg

    with extract_msg.openMsg(io.BytesIO(data)) as m:
        return f"[EMAIL]\nSubject: {m.subject}\nFrom: {m.sender}\nDate: {m.date}\n\n{m.body}", {
            "type": "msg", "subject": str(m.subject), "sender": str(m.sender), "has_attachments": str(bool(m.attachments))
        }


def png_size(data: bytes) -> tuple[int, int] | None:
    return (int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")) if data[:8] == b"\x89PNG\r\n\x1a\n" else None


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) of PNG, BMP and JPEG images; None where it is not known."""
    if data[:2] == b"BM" and len(data) >= 26:
        return int.from_bytes(data[18:22], "little"), abs(int.from_bytes(data[22:26], "little", signed=True))
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
            at += 2 + size
        return None
    return png_size(data)


def worth_reading(size: tuple[int, int] | None) -> bool:
    """Neither side is tiny and the image is no line."""
    return size is None or (min(size) >= LEAST_SIDE and max(size) <= GREATEST_ASPECT * min(size))


def extract(path: str, data: bytes, ocr: Ocr | None = None, config: EngineConfig = EngineConfig(), seen: dict[str, str] | None = None) -> Extracted:
    """Text and metadata by extension; ``seen`` remembers what OCR made of equal images."""
    kind = "." + path.rpartition(".")[2].lower()
    try:
        if kind == ".txt":
            return read_text(data)
        if kind == ".docx":
            return read_docx(data)
        if kind in (".xlsx", ".xlsm", ".xls"):
            return read_xlsx(data, ocr, seen)
        if kind == ".pdf":
            return read_pdf(data, ocr, config)
        if kind == ".msg":
            return read_msg(data)
        if kind in IMAGES:
            return read_image(data, ocr, seen), {"type": "image"}
        if kind in ARCHIVES:  # only those that could not be opened are still here
            return "", {"type": "archive", "members": str(sum(1 for _ in _members(data, kind[1:])))}
    except ImportError as e:
        return "", {"type": "unsupported", "missing": e.name or str(e)}
    except Exception as e:  # a broken file is a row that says so
        return "", {"type": "error", "error": f"{type(e).__name__}: {e}"}
    return "", {"type": "unsupported"}


def read_documents(files: DataFrame, ocr: Ocr | None = None, config: EngineConfig = EngineConfig()) -> DataFrame:
    """(company, original_file, text, metadata) of scanned files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, str] = {}
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                company, _, name = path.strip("/").partition("/")
                if name and not company.startswith("."):
                    rows.append((company, name, *extract(path, content, ocr, config, seen)))
            yield pd.DataFrame(rows, columns=FILE.names)

    return files.mapInPandas(run, FILE)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ",") -> DataFrame:
    """All columns as strings; quoted fields may hold line feeds and doubled quotes."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep)
    return (reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])) if columns else reader.option("inferSchema", False)).csv(path)


def read_golden(spark: SparkSession, path: str, sheet: int = 0) -> DataFrame:
    """Golden records by extension: CSV, TSV or TXT, workbooks (a reference table of one sheet, ``SHEET_BYTES`` at most).

    A file of any other extension is tried as a workbook, then read as CSV.
    """
    kind = path.rpartition(".")[2].lower()
    if kind in ("tsv", "txt"):
        return read_csv(spark, path, sep="\t")
    if kind == "csv":
        return read_csv(spark, path)
    file = spark.read.format("binaryFile").load(path)
    head = bytes(file.select(F.substring("content", 1, 8)).first()[0])
    if kind not in ("xlsx", "xlsm", "xls") and head[:2] != b"PK" and head != b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        return read_csv(spark, path)
    if file.select("length").first()[0] > SHEET_BYTES:
        raise ValueError(f"{path} is larger than a reference table may be")
    names, *rows = list(sheet_rows(bytes(file.select("content").first()[0])).values())[sheet]
    return spark.createDataFrame([tuple((r + [""] * len(names))[: len(names)]) for r in rows], T.StructType([T.StructField(h, T.StringType()) for h in names]))


def read_embeddings(spark: SparkSession, path: str, vector: str = "vector") -> DataFrame:
    """Stored embeddings, normalised again."""
    return spark.read.parquet(path).withColumn(vector, norm(F.col(vector)))


def manifest(documents: DataFrame, language: Column) -> DataFrame:
    return documents.select("company", "original_file", F.array(language).alias("languages"), "metadata")


def rename_fields(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
