"""WARC archives: writing with revisit records, a normaliser for monolithic gzip files, and reading back.

A monolithic archive is one gzip stream over all records, so no record can be reached without
inflating all before it. The normaliser reads the stream once, in pieces, rewrites every record
as a gzip member of its own and lists the members' places in a sidecar file.

Archives are files. Monolithic ones are written, and read as a stream, by Spark's text source, so no
task holds more than a few records and any store that Spark reaches will do. Normalised archives and
their indexes are written and read by `pyarrow.fs`, which opens local and shared disks and the usual
object stores; where Hadoop's file system is the store, its native client must be installed.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import bound
from textloom.llm.common import HOT_SHARE, blocks, limited, materialize

#: Bytes inflated at a time.
PIECE = 1 << 18
LEVEL = 6
#: Index lines that one task reads records by, about.
READ_RECORDS = 2048
#: Bits of the filter of payload digests that occur more than once: 2 MB at any number of pages.
FILTER_BITS = 1 << 24
_DATE = "2000-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass
class Record:
    """A record's headers (names as written) and its block."""

    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    def get(self, name: str, default: str = "") -> str:
        low = name.lower()
        return next((v for k, v in self.headers.items() if k.lower() == low), default)

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        """The HTTP headers of the block (names in lower case) and what follows them."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
        return {k.strip().lower(): v.strip() for k, v in pairs}, body


def base32(hexadecimal: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hexadecimal: four letters for each five digits."""
    fives = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(hexadecimal, 5 * i + 1, F.lit(5)), 16, 10).cast("int"))
    letter = lambda v, shift: F.substring(F.lit(_BASE32), F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.array_join(F.transform(fives, lambda v: F.concat(*(letter(v, shift) for shift in (15, 10, 5, 0)))), "")


def _clean(value: Column) -> Column:
    """A header value on one line: control characters are percent-encoded, all else stays as it is."""
    encoded = value
    for c in [*range(32), 127]:
        encoded = F.replace(encoded, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return F.when(value.rlike(r"[\x00-\x1F\x7F]"), encoded).otherwise(value)


def _record(page: Column) -> Column:
    """A page's record without the blank lines that end it: a response, or of a payload that another page has a revisit,
    whose HTTP headers keep the full length."""
    key, payload, size = page["page_id"], page["payload"], F.octet_length(page["payload"]).cast("string")
    responds = key.eqNullSafe(page["winner"])
    id_of = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"), F.when(responds, payload).otherwise(""))
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        head("WARC-Type", F.when(responds, "response").otherwise("revisit")),
        head("WARC-Record-ID", id_of(key)),
        head("WARC-Date", F.lit(_DATE)),
        head("X-Page-ID", key.cast("string")),
        head("WARC-Target-URI", _clean(page["url"])),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(page["sha1"]))),
        F.when(~responds, head("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.when(~responds & page["winner"].isNotNull(), head("WARC-Refers-To", id_of(page["winner"]))),
        F.lit("Content-Type: application/http; msgtype=response"),
    )
    return bound(block, lambda whole: F.concat(lines, F.lit("\r\nContent-Length: "), F.octet_length(whole).cast("string"), F.lit("\r\n\r\n"), whole))


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def inflate(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip file of one or many members, or of plain bytes, in pieces of bounded size."""
    engine, plain, first = None, False, True
    for chunk in chunks:
        if first and chunk:
            plain, first = chunk[:2] != b"\x1f\x8b", False
        while chunk:
            if plain:
                yield chunk
                break
            engine = engine or zlib.decompressobj(31)
            piece = engine.decompress(chunk, PIECE)
            if piece:
                yield piece
            if engine.eof:
                chunk, engine = engine.unused_data.lstrip(b"\0"), None
            else:
                chunk = engine.unconsumed_tail
                while not chunk and not engine.eof and len(piece) == PIECE:
                    piece = engine.decompress(b"", PIECE)
                    if piece:
                        yield piece


def read_records(chunks: Iterable[bytes], strict: bool = False) -> Iterator[Record]:
    """Records of an inflated archive, one in memory at a time; a cut last record is left out, if ``strict`` an error."""
    pieces, buffer = iter(chunks), bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        while fill(2) and buffer[:2] == b"\r\n":
            del buffer[:2]
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                if strict and buffer.strip():
                    raise ValueError("the last record's headers are cut")
                return
        lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:20]!r}")
        headers: dict[str, str] = {}
        name = ""
        for line in lines[1:]:
            if line[:1] in (" ", "\t") and name:
                headers[name] += " " + line.strip()
            elif ":" in line:
                name, _, value = line.partition(":")
                headers[name] = value.strip()
        size = int(next((v for k, v in headers.items() if k.lower() == "content-length"), "0"))
        if not fill(end + 4 + size):
            if strict:
                raise ValueError("the last record is cut")
            return
        yield Record(headers, bytes(buffer[end + 4 : end + 4 + size]))
        del buffer[: end + 4 + size]


@dataclass
class Place:
    """A line of the sidecar index: where a member lies in the normalised archive, and whose it is."""

    offset: int
    length: int
    record_id: str
    kind: str


def normalise(chunks: Iterable[bytes], out: io.BufferedIOBase, level: int = LEVEL, strict: bool = False) -> Iterator[Place]:
    """Inflate an archive once and write each record to ``out`` as its own gzip member; yields the index."""
    at = 0
    for record in read_records(inflate(chunks), strict):
        engine = zlib.compressobj(level, zlib.DEFLATED, 31)
        headers = {k: v for k, v in record.headers.items() if k.lower() != "content-length"}
        member = engine.compress(write_record(headers, record.block)) + engine.flush()
        out.write(member)
        yield Place(at, len(member), record.get("WARC-Record-ID"), record.get("WARC-Type"))
        at += len(member)


def record_at(archive: bytes, offset: int, length: int) -> Record:
    """One record by its index line, without inflating any other."""
    return next(read_records([zlib.decompress(archive[offset : offset + length], 31)]))


def with_dedup(pages: DataFrame, payload: str = "html", key: str = "page_id") -> DataFrame:
    """Adds the payload's SHA-1 (``sha1``, hexadecimal) and the largest key among equal payloads (``winner``).

    A null payload is an empty one. Repeats of the row with the largest key are winners each; a null key is smaller
    than any other, and wins only among null keys. Columns named ``sha1`` or ``winner`` are replaced.

    Only digests are shuffled, but for payloads that may occur more than once: a filter of fixed size tells the others,
    which win where they are scanned. Of the rest, digests that more than a thousandth of such rows have are broadcast
    (so fewer than a thousand), and rows of the others are joined by digest.
    """
    pages = pages.drop("sha1", "winner")
    marked = pages.withColumn("sha1", F.sha1(F.coalesce(F.col(payload), F.lit("")).cast("binary")))
    repeated = materialize(marked.groupBy("sha1").agg(F.max(key).alias("__most"), F.count("*").alias("__n")).where("__n > 1").withColumnRenamed("sha1", "__sha1"), "repeated-payloads")
    total = repeated.agg(F.sum("__n")).first()[0]
    if not total:
        return marked.withColumn("winner", F.col(key))
    words, bit = FILTER_BITS // 64, lambda digest: F.pmod(F.xxhash64(digest), F.lit(FILTER_BITS))
    word = lambda digest: F.shiftright(bit(digest), 6).cast("int")
    mask = lambda digest: F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(digest).bitwiseAND(F.lit(63)).cast("int"))
    filled = repeated.groupBy(word("__sha1").alias("at")).agg(F.bit_or(mask("__sha1")).alias("bits"))
    every = pages.sparkSession.range(words).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("bigint").alias("bits")).union(filled).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("bits"))  # one row of FILTER_BITS bits
    maybe = F.get(table.scalar(), word("sha1")).bitwiseAND(mask("sha1")) != 0
    hot = repeated.where(F.col("__n") > HOT_SHARE * total)
    seen = marked.withColumn("__maybe", maybe).join(F.broadcast(hot.select("__sha1", F.col("__most").alias("__hot"), F.lit(True).alias("__is_hot"))), F.col("sha1") == F.col("__sha1"), "left").drop("__sha1")
    placed = seen.where(~F.col("__maybe") | F.col("__is_hot")).withColumn("winner", F.when(F.col("__is_hot"), F.col("__hot")).otherwise(F.col(key)))
    rest = seen.where(F.col("__maybe") & F.col("__is_hot").isNull())
    cold = repeated.where(F.col("__n") <= HOT_SHARE * total).hint("merge")
    joined = rest.join(cold, F.col("sha1") == F.col("__sha1"), "left").withColumn("winner", F.when(F.col("__n").isNotNull(), F.col("__most")).otherwise(F.col(key)))
    return placed.select(*marked.columns, "winner").unionByName(joined.select(*marked.columns, "winner"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Monolithic archives of rows page_id, url, html, sha1, winner in a new ``folder``: a gzip file a task, written as it goes.

    Rows whose page_id is the winner are response records, so equal rows that share the largest
    page_id are all responses; a null page_id is smaller than any other. Other columns are left out
    whatever their names; an empty table gives no record.
    """
    page = F.struct("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"), "sha1", "winner")
    pages.select(bound(page, _record).alias("value")).write.text(folder, compression="gzip", lineSep="\r\n\r\n")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(file, piece of its bytes) of rows (file, line), in order; a piece holds a batch's lines of one file."""
    for batch in batches:
        files, lines = batch.column(0).to_pylist(), batch.column(1)
        at = 0
        for file, same in groupby(files):
            n = sum(1 for _ in same)
            yield file, b"\n".join([*lines.slice(at, n).to_pylist(), b""])
            at += n


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def normalise_archives(spark: SparkSession, path: str, folder: str, level: int = LEVEL, strict: bool = True) -> DataFrame:
    """Rewrites the archive files at ``path`` (a folder or pattern; gzip of one or many members, or plain) into ``folder``.

    A row per file that holds a record: source, archive, index, records, bytes, damaged. An archive is inflated once and
    streamed from and to its files, so its size is not bounded by memory, though a record's is. Beside NAME.warc.gz lies
    its index NAME.idx: a line of offset, length, type and record id for each record. What is no WARC file, or is cut, is an error;
    with ``strict`` false it counts up to the damage. A task that is run again writes files of other names, and
    only those of the run that succeeded are in the result.
    """
    lines = spark.read.schema("value string").option("lineSep", "\n").option("ignoreCorruptFiles", str(not strict).lower()).option("recursiveFileLookup", "true").text(path)
    rows = limited(lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        for source, pieces in groupby(_stream(batches), key=itemgetter(0)):
            name, records, size, damaged = uuid.uuid4().hex, 0, 0, False
            with store.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out, store.open_output_stream(f"{base}/{name}.idx") as index:
                try:
                    for p in normalise((piece for _, piece in pieces), out, level, strict=True):
                        index.write(f"{p.offset}\t{p.length}\t{p.kind}\t{p.record_id}\n".encode())
                        records, size = records + 1, size + p.length
                except ValueError as e:
                    if strict:
                        raise ValueError(f"{source}: {e}") from None
                    damaged = True
            row = [source, f"{folder}/{name}.warc.gz", f"{folder}/{name}.idx", records, size, damaged]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["source", "archive", "index", "records", "bytes", "damaged"])

    return materialize(rows.mapInArrow(run, "source string, archive string, index string, records bigint, bytes bigint, damaged boolean"), "archives")


def read_pages(archives: DataFrame, read_records: int = READ_RECORDS) -> DataFrame:
    """The page records of normalised archives (rows archive, index, records), each reached by its index line.

    A response's length and digest are taken from its payload, and checked against its header, a mismatch being an
    error; a revisit's come from the headers, as its payload lies elsewhere. Records that are neither are passed over. An
    archive's records are dealt to tasks by ranges of its index.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    total = archives.agg(F.sum("records")).first()[0] or 0
    step = F.lit(max(1, read_records))
    ranges = archives.where("records > 0").select("archive", "index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("records") - 1, step)).alias("first"))
    dealt = ranges.repartition(blocks(total, read_records))

    def page(text: str) -> int | None:
        value = text.removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value.lstrip("-").isdigit() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, place = _open(archive)
                with store.open_input_stream(_open(index)[1], compression=None) as lines:
                    own = lines.read().split(b"\n")[first : first + read_records]
                rows = []
                with store.open_input_file(place) as file:
                    for line in own:
                        if not line:
                            continue
                        offset, length = map(int, line.split(b"\t")[:2])
                        file.seek(offset)
                        record = record_at(file.read(length), 0, length)
                        kind = record.get("WARC-Type")
                        if kind not in ("response", "revisit"):
                            continue
                        http, payload = record.http
                        size, digest = int(http["content-length"]), record.get("WARC-Payload-Digest").removeprefix("sha1:")
                        if kind == "response" and (len(payload), digest32(payload)) != (size, digest):
                            raise ValueError(f"{record.get('WARC-Record-ID')}: the payload isn't the one that was written")
                        url = next((v for k, v in record.headers.items() if k.lower() == "warc-target-uri"), None)
                        rows.append((page(record.get("X-Page-ID")), url, size, digest, kind, page(record.get("WARC-Refers-To"))))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return dealt.mapInArrow(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
