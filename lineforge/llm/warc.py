"""Web archives: write monolithic gzip files, normalise them to one member per record, read back.

``write_warc`` writes WARC 1.1 records with Spark's text writer, whose gzip codec makes each file
one stream: to reach a record, everything before it has to be inflated. ``normalise`` inflates each
such file once, as a stream, and rewrites every record as a gzip member of its own, with a sidecar
index of offsets beside the archive. ``read_records`` then opens any record by its offset.

Files lie in the cluster's shared folder. A task writes under a name that no other attempt uses, and
the index table, which is committed by Spark, is what counts: an archive of a lost attempt is never
named in it. Streams are read and written by the megabyte, so memory does not follow file or record
sizes. Files hold ``records_per_file`` records at most, which bounds the work of one task.

Defined results: a null html is an empty payload, a null url an opaque address; of equal payloads
of ``least_bytes`` or more the largest ``page_id`` is the response and the others are revisits; rows
that share this largest id are all responses; null ids are never the largest, and if a group has no
other, all of it are responses. Extra columns are ignored; repeated rows are records of their own.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineforge.llm.files import store_of
from lineforge.llm.tables import written
from lineforge.storage import new_path

# Fixed values of the format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20

INDEX = "archive string, offset long, length long, record_id string, record_type string"


def payload_groups(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(digest, keep_id) of payloads that occur more than once: the id of the record that stays."""
    return (
        pages.where(F.octet_length("html") >= least_bytes)
        .groupBy(F.sha1("html").alias("digest"))
        .agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n"))
        .where("n > 1 and keep_id is not null")
        .drop("n")
    )


def warc_records(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """One column ``record``: header, block and, for responses, the payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("urn:page")), r"\s+", "%20").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"),
    ).join(groups, "digest", "left")
    revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn(F.col("page_id")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), urn(F.col("keep_id")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block"),
        F.lit(END),
    )
    return rows.withColumn("block", block).select(F.concat(header, "block").alias("record"))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 1000, records_per_file: int = 100_000) -> None:
    """Monolithic ``*.gz`` files of records; equal payloads are stored once. Runs jobs."""
    groups = written(payload_groups(pages, least_bytes), "payloads")
    (
        warc_records(pages, groups)
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


class _Inflated:
    """The plain bytes of a gzip stream of one or many members, by need."""

    def __init__(self, raw) -> None:
        self._raw, self._inflate, self._rest = raw, zlib.decompressobj(31), b""
        self.buffer = bytearray()

    def more(self) -> bool:
        """Append some bytes to the buffer; false at the end."""
        while True:
            if self._inflate.eof:
                self._rest, self._inflate = self._inflate.unused_data or self._rest, zlib.decompressobj(31)
            data = self._rest or self._raw.read(CHUNK)
            self._rest = b""
            if not data:
                return False
            plain = self._inflate.decompress(data, CHUNK)
            if not self._inflate.eof:
                self._rest = self._inflate.unconsumed_tail
            if plain:
                self.buffer += plain
                return True

    def head(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        seen = 0
        while (at := self.buffer.find(END.encode(), max(0, seen - 3))) < 0:
            seen = len(self.buffer)
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a record's header")
                return None
        head = bytes(self.buffer[: at + 4])
        del self.buffer[: at + 4]
        return head

    def body(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes in pieces."""
        while length:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends within a record")
            piece = bytes(self.buffer[:length])
            del self.buffer[: len(piece)]
            length -= len(piece)
            yield piece


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").strip().split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def rewrite(raw, out) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Records of one stream as members of their own: offset, length and header fields of each."""
    source, offset = _Inflated(raw), 0
    while (head := source.head()) is not None:
        fields, packed, length = fields_of(head), zlib.compressobj(6, zlib.DEFLATED, 31), 0

        def put(data: bytes) -> int:
            out.write(data)
            return len(data)

        length += put(packed.compress(head))
        for piece in source.body(int(fields["content-length"]) + len(END)):
            length += put(packed.compress(piece))
        length += put(packed.flush())
        yield offset, length, fields
        offset += length


def normalise(spark: SparkSession, source: str, target: str, pattern: str = "*.gz") -> DataFrame:
    """Rewrite every archive of a folder; the committed index, one row per record. Runs a job."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                archive = f"{target}/{uuid4().hex}.warc.gz"
                store, path = store_of(uri)
                out_store, out_path = store_of(archive)
                if out_store.type_name == "local":
                    out_store.create_dir(out_path.rpartition("/")[0], recursive=True)
                with (
                    store.open_input_stream(path, compression=None) as raw,
                    out_store.open_output_stream(out_path, compression=None) as out,
                    out_store.open_output_stream(f"{out_path}.idx", compression=None) as sidecar,
                ):
                    rows = []
                    for offset, length, fields in rewrite(raw, out):
                        rows.append((archive, offset, length, fields.get("warc-record-id"), fields.get("warc-type")))
                        sidecar.write(f"{offset} {length} {rows[-1][3]}\n".encode())
                        if len(rows) == 10_000:
                            yield _rows(rows, INDEX)
                            rows = []
                    if rows:
                        yield _rows(rows, INDEX)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path")
    return written(files.mapInArrow(work, INDEX), "warc-index")


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds[t]) for column, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names)
    )


class _Window:
    """A range of an open file as a stream."""

    def __init__(self, file, offset: int, length: int) -> None:
        self._file, self._left = file, length
        file.seek(offset)

    def read(self, n: int) -> bytes:
        data = self._file.read(min(n, self._left))
        self._left -= len(data)
        return data


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per index row: the record's fields, size and digest of its full payload, on wish the payload.

    A revisit holds no payload: its size and digest are those its header states for the payload it
    refers to. A response whose payload differs from the digest in its header is an error.
    """
    schema = "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    schema += ", payload binary" if with_payload else ""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != opened:
                    if file:
                        file.close()
                    store, path = store_of(archive)
                    opened, file = archive, store.open_input_file(path)
                record = _Inflated(_Window(file, offset, length))
                fields = fields_of(record.head())
                http = fields_of(head := record.head())
                digest, size, kept = hashlib.sha1(), 0, []
                for piece in record.body(int(fields["content-length"]) - len(head)):
                    digest.update(piece)
                    size += len(piece)
                    if with_payload:
                        kept.append(piece)
                stated = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "revisit":
                    size = int(http["content-length"])
                elif digest.hexdigest() != stated:
                    raise ValueError(f"{fields['warc-record-id']} in {archive} is damaged")
                row = (fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"), size, stated)
                rows.append((*row, b"".join(kept)) if with_payload else row)
            if rows:
                yield _rows(rows, schema)
        if file:
            file.close()

    return index.select("archive", "offset", "length").mapInArrow(work, schema)


def page_of(urn: F.Column) -> F.Column:
    """The page's id in a record's id; null if it had none."""
    return F.regexp_extract(urn, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages as archives, normalise them, and read every record back. Runs jobs."""
    spark = pages.sparkSession
    source, target = new_path(spark, "warc-monolithic"), new_path(spark, "warc")
    write_warc(pages, source)
    records = read_records(normalise(spark, source, target))
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
