"""Résumé files: DOCX by the standard library, PDF by pdfplumber where it is installed."""

from __future__ import annotations

import importlib.util
import io
import logging
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.errors import ResumeSourceError
from lodestone.functions.text import no_strings
from lodestone.session import planned
from lodestone.sources.files import exists
from lodestone.sources.recruiter_csv import empty_records, record_id

LOG = logging.getLogger(__name__)
MIME = {"pdf": "application/pdf", "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document"}
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(content: bytes) -> str:
    """Trimmed non-empty paragraphs of the body, not those of tables."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    paragraphs = []
    for p in body.findall(f"{_W}p"):
        marks = {f"{_W}t": lambda e: e.text or "", f"{_W}tab": lambda e: "\t", f"{_W}br": lambda e: "\n", f"{_W}cr": lambda e: "\n"}
        paragraphs.append("".join(marks[e.tag](e) for e in p.iter() if e.tag in marks).strip())
    return "\n".join(filter(None, paragraphs))


def pdf_text(content: bytes) -> str:
    """Trimmed texts of the pages that have any."""
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as pdf:
        return "\n".join(filter(None, ((page.extract_text() or "").strip() for page in pdf.pages)))


def _has_pdf_reader() -> bool:
    return importlib.util.find_spec("pdfplumber") is not None


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for suffix, content in zip(batch.column(1).to_pylist(), batch.column(2)):
            try:
                texts.append({"docx": docx_text, "pdf": pdf_text}[suffix](content.as_py()) or None)
            except Exception as e:  # an unreadable file is skipped, whatever its decoder says
                LOG.warning("skipped an unreadable %s: %s", suffix, e)
                texts.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), batch.column(3)], ["file_path", "suffix", "raw_text", "checksum_sha256"])


def read_resumes(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    """One raw record per PDF or DOCX file of a folder, not below it, or of a single file, in the order of their names.

    Unreadable files and files without text are skipped; a missing path gives no rows and a warning. PDF files without a
    package to read them are an error, raised once, before anything is read.
    """
    if not exists(spark, path):
        LOG.warning("résumé path not found: %s", path)
        return empty_records(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(path)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    if not _has_pdf_reader() and not files.filter(suffix == "pdf").select("path").isEmpty():
        raise ResumeSourceError("PDF documents need the package pdfplumber, which isn't installed")
    wanted = files.select("path", suffix.alias("suffix"), "content", F.sha2("content", 256).alias("sum")).filter(F.col("suffix").isin("pdf", "docx"))
    texts = wanted.mapInArrow(_decode, "file_path string, suffix string, raw_text string, checksum_sha256 string").filter("raw_text is not null")
    return resume_records(texts.withColumn("file_name", F.regexp_extract("file_path", r"([^/]+)$", 1)), batch_id)


def resume_records(texts: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Raw records of decoded documents (file_path, file_name, suffix, raw_text, checksum_sha256). Blank texts go."""
    kind = F.concat(F.lit("resume_"), F.col("suffix"))
    mime = F.when(F.col("suffix") == "pdf", MIME["pdf"]).when(F.col("suffix") == "docx", MIME["docx"]).otherwise("text/plain")
    payload = F.create_map(F.lit("file_name"), F.col("file_name"), F.lit("file_extension"), F.concat(F.lit("."), "suffix"), F.lit("text_length"), F.length("raw_text").cast("string"))
    return planned(texts).filter("trim(raw_text) != ''").select(
        record_id(F.col("file_name"), F.coalesce("checksum_sha256", F.lit("")), F.col("raw_text")).alias("record_id"),
        F.lit(0).cast("long").alias("seq"),
        F.col("file_name").alias("source_name"),
        kind.alias("source_type"),
        "file_name",
        "file_path",
        mime.alias("mime_type"),
        "checksum_sha256",
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.current_timestamp().alias("ingestion_timestamp"),
        no_strings().alias("fieldnames"),
        payload.alias("payload"),
        "raw_text",
        F.array(F.lit("resume"), F.col("suffix")).alias("tags"),
    )
