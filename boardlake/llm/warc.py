"""WARC archives: a writer for crawled pages and a Python data source that reads them.

The writer puts out WARC 1.1 response records, and revisit records for
payloads already held by a smaller page_id, with Spark's text writer: its line
separator is the record separator, so each part file is an archive and its
commit protocol hides the files of lost tasks.  The text codec ``gzip`` makes
``.gz`` archives.

The reader lists archives, plans one partition per file, parses the header of
a record first, and tests the pushed predicates (equality, IN, null tests on
record_type, record_id, target_uri, refers_to and payload_digest) on it.  Only
for records that pass is the block read, and its payload decoded unless the
option ``payload`` is ``false``; other blocks are skipped, by seeking in plain
files and by discarding in compressed ones.

Defined results: a null payload is empty; a null page_id or url leaves its
header out and reads back as null; null ids neither own nor revisit a payload
unless no page with an id has it; rows that repeat a page_id and payload are
written each, the repeated ones as responses too; control and non-ASCII
characters of a url are percent-encoded; an empty table writes no record;
payloads of any length are streamed to the file by Spark, and read one record
at a time.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull,
                                    IsNull)

from boardlake.llm.common import pick, scratch_path, stored

#: Payloads under so many bytes are never written as revisits.
MIN_REVISIT_BYTES = 100
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, digest_ok boolean, payload string")
#: Columns that a pushed predicate may test, and the header each comes from.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
CHUNK = 1 << 20


def header(name: str, value) -> F.Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def safe_uri(url):
    """Percent-encode what a header line can't hold: control characters, spaces, ``%`` itself and non-ASCII."""
    escaped = F.expr(r"""array_join(transform(split(url, ''), c -> CASE WHEN c RLIKE '[!-$&-~]' THEN c
        ELSE regexp_replace(hex(encode(c, 'UTF-8')), '(..)', '%$1') END), '')""")
    return F.when(url.rlike(r"^[!-$&-~]*$"), url).otherwise(escaped)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages(page_id, url, html)`` with digest, size and the page that a revisit refers to."""
    rows = pick(pages, page_id="page_id", url="url", html="html").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    keys = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # Only digests that several pages share are joined back: stored, so the join can split a hot one.
    shared = stored(keys.where("n > 1").select(F.col("digest").alias("shared_digest"), "first_id"), "shared-payloads")
    found = rows.join(shared, F.col("digest") == F.col("shared_digest"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return found.select("page_id", "url", "html", "digest", "size", F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, codec: str = "gzip", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record for every row of ``pages(page_id, url, html)`` to archives under ``path``."""
    rows = with_revisits(pages, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    urn = F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))
    refers = F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), header("WARC-Type", kind), header("WARC-Record-ID", urn), header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", safe_uri(F.col("url"))), header("WARC-Refers-To", refers),
        header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("block")), F.lit("\r\n"), F.col("block"))
    (rows.withColumn("block", block).select(record.alias("value"))
     .write.option("lineSep", END).option("compression", codec).text(path))


class Stream:
    """Reads of exact length and skips over a plain or gzip file."""

    def __init__(self, raw, packed: bool):
        self.raw, self.packed, self.held = raw, packed, b""
        self.unzip = zlib.decompressobj(31) if packed else None

    def _more(self) -> bool:
        if not self.packed:
            data = self.raw.read(CHUNK)
            self.held += data
            return bool(data)
        while True:
            data = self.unzip.unused_data or self.raw.read(CHUNK)
            if not data:
                return False
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
            out = self.unzip.decompress(data)
            if out:
                self.held += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to ``mark``, which is passed over; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise ValueError("archive ends inside a record")
                return None
        out, self.held = self.held[:at], self.held[at + len(mark):]
        return out

    def read(self, n: int) -> bytes:
        parts, missing = [], n
        while missing > len(self.held):
            parts.append(self.held)
            missing -= len(self.held)
            self.held = b""
            if not self._more():
                raise ValueError("archive ends inside a record")
        parts.append(self.held[:missing])
        self.held = self.held[missing:]
        return b"".join(parts)

    def skip(self, n: int) -> None:
        if not self.packed and n > len(self.held):
            self.raw.seek(n - len(self.held), os.SEEK_CUR)
            self.held = b""
            return
        while n > 0:
            step = min(n, max(len(self.held), CHUNK))
            self.read(step)
            n -= step


def file_system(path: str):
    """File system and inner path of a URI or a plain path."""
    from pyarrow import fs
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


def urn_id(value: str | None) -> str | None:
    return value[len("<urn:page:"):-1] if value and value.startswith("<urn:page:") else value


def header_value(name: str, found: dict[str, str]) -> str | None:
    """Value of a column that comes from the header alone."""
    value = found.get(HEADERS[name])
    if name in ("record_id", "refers_to"):
        return urn_id(value)
    if name == "payload_digest":
        return value.removeprefix("sha256:") if value else None
    return unquote(value) if name == "target_uri" and value is not None else value


def passes(test: tuple, found: dict[str, str]) -> bool:
    kind, name, wanted = test
    value = header_value(name, found)
    if kind == "null":
        return (value is None) == wanted
    return value in wanted


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload, self.tests = options["path"], options.get("payload", "true").lower() != "false", []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append(("in", name, {f.value}))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append(("in", name, {v for v in f.value if v is not None}))
            elif name in HEADERS and isinstance(f, (IsNull, IsNotNull)):
                self.tests.append(("null", name, isinstance(f, IsNull)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs
        system, inner = file_system(self.path)
        if system.get_file_info(inner).type == fs.FileType.File:
            return [Archive(self.path)]
        infos = system.get_file_info(fs.FileSelector(inner, recursive=True))
        head = self.path[: len(self.path) - len(inner)] if self.path.endswith(inner) else ""
        names = sorted(i.path for i in infos if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))
        return [Archive(head + n) for n in names]

    def read(self, partition):
        if not isinstance(partition, Archive):
            return
        system, inner = file_system(partition.path)
        with system.open_input_file(inner) as raw:
            rows, size = [], 0
            for row in self.records(Stream(raw, inner.endswith(".gz"))):
                rows.append(row)
                size += len(row["payload"] or "")
                if len(rows) == 1000 or size > 4 * CHUNK:
                    yield self.batch(rows)
                    rows, size = [], 0
            if rows:
                yield self.batch(rows)

    @staticmethod
    def batch(rows: list[dict]) -> pa.RecordBatch:
        text = ("record_id", "record_type", "target_uri", "refers_to", "payload_digest")
        kinds = [*((n, pa.string()) for n in text), ("payload_bytes", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.string())]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    def records(self, stream: Stream):
        while (head := stream.until(b"\r\n\r\n")) is not None:
            lines = head.decode("utf-8").lstrip("\r\n").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record header: {lines[0][:40]!r}")
            found = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            length = int(found["content-length"])
            if not all(passes(t, found) for t in self.tests):
                stream.skip(length + 4)
                continue
            row = {name: header_value(name, found) for name in HEADERS}
            row |= {"payload_bytes": None, "digest_ok": None, "payload": None}
            block = stream.read(length)
            stream.skip(4)
            if found.get("content-type", "").startswith("application/http"):
                http, _, block = block.partition(b"\r\n\r\n")
                for line in http.split(b"\r\n"):
                    if line.lower().startswith(b"content-length:"):
                        row["payload_bytes"] = int(line.split(b":")[1])
            else:
                row["payload_bytes"] = len(block)
            if row["record_type"] == "response":
                row["digest_ok"] = hashlib.sha256(block).hexdigest() == row["payload_digest"]
                if self.payload:
                    row["payload"] = block.decode("utf-8")
            yield row


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, path: str, condition=None, payload: bool = True) -> DataFrame:
    """Records of the archives under ``path`` that meet ``condition``.

    Predicates on header columns are pushed into the reader.  Spark keeps them
    with the loaded relation, so give the condition here and call again for
    another one instead of filtering the same DataFrame in two ways.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    found = spark.read.format("warc").option("payload", str(payload).lower()).load(path)
    return found if condition is None else found.where(condition)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives, read them back, one row per page.

    (page_id, payload_bytes, payload_digest, record_type, refers_to); reading
    fails if a response's payload does not have its record's digest.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    kind = pages.schema["page_id"].dataType
    found = read_warc(spark, path, F.col("record_type").isin("response", "revisit"), payload=False)
    checked = F.when(F.col("digest_ok").isNull() | F.col("digest_ok"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest: page "), F.col("record_id"))))
    return found.select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", checked.alias("payload_digest"),
                        "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
