"""Documents as blocks of text: a reader by media type, native text first, then one of several text recognisers.

Readers are functions, so that an installation brings its own: ``native_pdf`` and ``tesseract`` work where their packages are
installed, and anything else can be passed in. A file that cannot be read is a row with its error; it stops nothing else.

Defined cases: an unknown suffix, more pages than allowed, a missing package and a damaged file are errors of that file; a page
without text has no blocks; a folder without documents is an error of the caller.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Media types by suffix; points an inch; limits.
MEDIA = {".pdf": "application/pdf", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp", ".tif": "image/tiff", ".tiff": "image/tiff"}
POINTS = 72
MAX_PAGES, MIN_NATIVE_CHARS, DPI = 100, 10, 220

#: A block: text, box in the page's units, confidence (null for native text).
Block = tuple[str, tuple[float, float, float, float], float | None]
#: A recogniser: the page's image as PNG bytes, and how many of its pixels make a unit of the page.
Recogniser = Callable[[bytes, float], list[Block]]


@dataclass
class Page:
    """A page as a reader gives it: its native blocks, and its image where those may not do."""

    width: float
    height: float
    blocks: list[Block] = field(default_factory=list)
    image: Callable[[], bytes] | None = None
    scale: float = 1.0
    units: str = "points"


Reader = Callable[[bytes], list[Page]]


def native_pdf(raw: bytes, dpi: int = DPI) -> list[Page]:
    """A PDF's pages with their text blocks, by the pymupdf package."""
    import pymupdf

    pages = []
    with pymupdf.open(stream=raw, filetype="pdf") as book:
        for page in book:
            found = [(b[4].strip(), tuple(map(float, b[:4])), None) for b in page.get_text("blocks") if b[6] == 0 and b[4].strip()]
            scale = dpi / POINTS
            png = page.get_pixmap(matrix=pymupdf.Matrix(scale, scale), alpha=False).tobytes("png")
            pages.append(Page(page.rect.width, page.rect.height, found, lambda png=png: png, scale))
    return pages


def raster(raw: bytes) -> list[Page]:
    """An image as one page in pixels, by the pillow package."""
    from PIL import Image

    with Image.open(io.BytesIO(raw)) as image:
        width, height, out = image.width, image.height, io.BytesIO()
        image.convert("RGB").save(out, "PNG")
    return [Page(width, height, [], out.getvalue, 1.0, "pixels")]


def tesseract(png: bytes, scale: float, language: str = "spa+eng", options: str = "--psm 11") -> list[Block]:
    """Lines of an image, by the pytesseract package: words of a line joined, the union of their boxes, the mean confidence."""
    import pytesseract
    from PIL import Image

    data = pytesseract.image_to_data(Image.open(io.BytesIO(png)), lang=language, config=options, output_type=pytesseract.Output.DICT)
    lines: dict[tuple, list[int]] = {}
    for i, word in enumerate(data["text"]):
        if word.strip():
            lines.setdefault((data["block_num"][i], data["par_num"][i], data["line_num"][i]), []).append(i)
    out = []
    for at in lines.values():
        left, top = min(data["left"][i] for i in at), min(data["top"][i] for i in at)
        right, bottom = max(data["left"][i] + data["width"][i] for i in at), max(data["top"][i] + data["height"][i] for i in at)
        known = [float(data["conf"][i]) for i in at if float(data["conf"][i]) >= 0]
        out.append((" ".join(data["text"][i].strip() for i in at), (left / scale, top / scale, right / scale, bottom / scale), sum(known) / len(known) / 100 if known else None))
    return out


def recognise(png: bytes, scale: float, engines: dict[str, Recogniser], engine: str) -> tuple[list[Block], str, str | None]:
    """(blocks, engine that gave them, warning): the named engine, or for ``auto`` the first that finds text, in their order."""
    if engine != "auto":
        if engine not in engines:
            raise ValueError(f"no text recogniser {engine!r}")
        return engines[engine](png, scale), engine, None
    failed = []
    for name, run in engines.items():
        try:
            found = run(png, scale)
        except Exception as e:  # the next one may do
            failed.append(f"{name}: {e}")
            continue
        if found:
            return found, name, "; ".join(failed) or None
        failed.append(f"{name}: no text")
    return [], "none", "; ".join(failed) or "no text recogniser"


_SCHEMA = "source_file string, media_type string, page_number int, width double, height double, units string, method string, engine string, warning string, error string, block_id string, bbox array<double>, confidence double, text string"


def read_documents(spark: SparkSession, folder: str, readers: dict[str, Reader] | None = None, engines: dict[str, Recogniser] | None = None, engine: str = "auto", max_pages: int = MAX_PAGES, min_native_chars: int = MIN_NATIVE_CHARS) -> DataFrame:
    """All documents under a folder, at the grain of blocks; a page without any, and a file that failed, are a row each.

    source_file is the path below the folder. readers: by media type (application/pdf and image). A page whose native text
    has fewer than ``min_native_chars`` characters is recognised from its image.
    """
    if max_pages < 1:
        raise ValueError("the page limit must be positive")
    readers = readers or {"application/pdf": native_pdf, "image": raster}
    engines = engines if engines is not None else {"tesseract": tesseract}
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    known = files.where(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*MEDIA))
    if known.limit(1).count() == 0:
        raise ValueError(f"no documents under {folder}")
    def rows(path: str, raw: bytes) -> Iterator[tuple]:
        media = MEDIA["." + path.rsplit(".", 1)[-1].lower()]
        try:
            pages = readers[media if media in readers else media.split("/")[0]](raw)
            if len(pages) > max_pages:
                raise ValueError(f"{len(pages)} pages, {max_pages} allowed")
            for n, page in enumerate(pages, 1):
                blocks, method, by, warning = page.blocks, "native", None, None
                if sum(len(b[0]) for b in blocks) < min_native_chars and page.image is not None:
                    blocks, by, warning = recognise(page.image(), page.scale, engines, engine)
                    method = "ocr"
                for i, (text, box, confidence) in enumerate(blocks or [(None, None, None)], 1):
                    yield path, media, n, page.width, page.height, page.units, method, by, warning, None, f"p{n}-b{i}" if text is not None else None, list(box) if box else None, confidence, text
        except Exception as e:  # the batch goes on, the file is reported
            yield path, media, *[None] * 7, f"{type(e).__name__}: {e}", *[None] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows(path, raw)), _KINDS)], names=names)

    found = known.select("path", "content").mapInArrow(run, _SCHEMA)
    return found.withColumn("source_file", F.substring(F.regexp_replace("source_file", "^file:/+", "/"), len(_bare(full)) + 2, 1 << 20))


_KINDS = [pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.float64(), pa.string()]


def _bare(path: str) -> str:
    """A path without the scheme of the local file system, which Spark writes in several ways."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def failures(blocks: DataFrame) -> DataFrame:
    """(source_file, error) of the files that could not be read."""
    return blocks.where("error is not null").select("source_file", "error").distinct()
