"""WARC archives in Zstandard frames, with a dictionary: writer and reader.

An archive starts with a skippable frame that holds the dictionary; after it, every record is
one frame of its own, with content size and checksum. Tasks write whole archives of bounded size
into the given folder, under names that depend on the task and a counter alone: a task that
runs again replaces its own files, each by one rename. The reader takes the archives as binary
files through Spark, loads the dictionary, decodes frame by frame and validates magic numbers,
versions, headers, lengths and digests.

Of pages with equal payloads the one with the largest id is stored as response; the others are
revisit records that refer to it. Equality is decided on (SHA-1, length) of the payload in narrow rows; the
pages, payloads included, then move once, to meet the decision on their digest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm.common import cut, query, read, shared_folder

# The format's numbers.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20      # uncompressed records of an archive, one record more at most
DICTIONARY_BYTES = 32 << 10
SAMPLE_ROWS = 400             # pages that the dictionary is trained on
SAMPLE_BYTES = 8 << 10        # of each of them
DATE = "2020-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    inner = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if inner == "none" else int(inner)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header of its page, not the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url:
        head.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest(payload)),
             ("WARC-Block-Digest", "sha1:" + digest(block))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


class BadArchive(ValueError):
    pass


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, lower-cased names; block) of one record, with version, length and block digest checked."""
    top, sep, rest = record.partition(b"\r\n\r\n")
    lines = top.split(b"\r\n")
    if not sep or lines[0] != VERSION:
        raise BadArchive("not a WARC/1.1 record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "surrogatepass").partition(":")
        if not colon or name.lower() in headers:
            raise BadArchive(f"bad header line {name!r}")
        headers[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(headers)
    if missing:
        raise BadArchive(f"no {sorted(missing)[0]}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the record's length is not what its header says")
    block = rest[:-4]
    if headers.get("warc-block-digest", "sha1:" + digest(block)) != "sha1:" + digest(block):
        raise BadArchive("the block's digest is not what its header says")
    return headers, block


def parse_payload(headers: dict[str, str], block: bytes) -> tuple[bytes | None, int, str]:
    """(payload, or None for a revisit; its full length; its digest), checked against each other."""
    top, sep, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in top.split(b"\r\n")[1:])
    if not sep or not top.startswith(b"HTTP/1.1 ") or not fields.get(b"Content-Length", b"").isdigit():
        raise BadArchive("no HTTP header with a length")
    length, said = int(fields[b"Content-Length"]), headers.get("warc-payload-digest", "")
    if not said.startswith("sha1:"):
        raise BadArchive("no payload digest")
    if headers["warc-type"] == "revisit":
        if payload or headers.get("warc-profile") != PROFILE or "warc-refers-to" not in headers:
            raise BadArchive("bad revisit record")
        return None, length, said[5:]
    if headers["warc-type"] != "response" or len(payload) != length or "sha1:" + digest(payload) != said:
        raise BadArchive("the payload is not what its headers say")
    return payload, length, said[5:]


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends: its blocks are stepped over."""
    try:
        magic, flags = struct.unpack_from("<IB", data, at)
        if magic != FRAME_MAGIC:
            raise BadArchive("not a Zstandard frame")
        single = flags >> 5 & 1
        at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
        while True:
            head = int.from_bytes(data[at:at + 3], "little")
            if len(data) < at + 3:
                raise BadArchive("the archive ends inside a frame")
            at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            if head & 1:
                break
        at += 4 * (flags >> 2 & 1)
    except struct.error as e:
        raise BadArchive("the archive ends inside a frame") from e
    if at > len(data):
        raise BadArchive("the archive ends inside a frame")
    return at


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive."""
    import zstandard
    data = memoryview(archive)
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_MAGIC:
        raise BadArchive("no leading dictionary frame")
    at = 8 + struct.unpack_from("<I", data, 4)[0]
    if at > len(data):
        raise BadArchive("the archive ends inside its dictionary")
    dictionary = bytes(data[8:at])
    if dictionary[:4] == struct.pack("<I", FRAME_MAGIC):
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    while at < len(data):
        end = frame_end(data, at)
        try:
            record = decoder.decompress(data[at:end])
        except zstandard.ZstdError as e:
            raise BadArchive(f"a frame can't be decoded: {e}") from e
        yield parse_record(record)
        at = end


def train_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary from at most `SAMPLE_ROWS` records; too few to train on: their plain bytes."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) + make_record(0, "http://", b"", None, False))[-DICTIONARY_BYTES:]


def _store(folder: str):
    """(file system, path) that a task writes to: the shared folder, whatever its scheme."""
    from pyarrow import fs
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archives in ``folder``;
    returns (archive, records, bytes), one row per archive.

    Null html is an empty payload; empty payloads are equal to each other. A null url leaves
    the target out. Rows that repeat the response's page are responses as well. Pages with a
    null id revisit the response of their payload, or are responses if no page of that payload
    has an id. An empty table writes no archive.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload"))
    p = p.withColumn("same", F.concat_ws(":", F.sha1("payload"), F.octet_length("payload")))
    best = (p.groupBy("same").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 and winner is not null").drop("n"))
    revisits = (p.select("page_id", "same").join(best, "same").filter(~F.col("page_id").eqNullSafe(F.col("winner")))
                .distinct().withColumnsRenamed({"page_id": "__page", "same": "__same"}))
    # A threshold on a hash leaves about twice the sample, whatever the number of pages.
    share = min(1.0, 2 * SAMPLE_ROWS / max(p.count(), 1))
    sample = (p.filter(F.pmod(F.xxhash64("page_id", "same"), F.lit(1 << 40)) < int(share * (1 << 40)))
              .select(F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "page_id", "url").limit(SAMPLE_ROWS).collect())
    dictionary = train_dictionary([make_record(r.page_id, r.url, bytes(r.payload), None, False) for r in sample])
    decided = (p.join(revisits, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("same") == F.col("__same")), "left")
               .select("page_id", "url", "payload", "winner"))

    def run(batches):
        import zstandard
        from pyspark import TaskContext
        context = TaskContext.get()
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        encoder = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True,
                                           dict_data=zstandard.ZstdCompressionDict(dictionary))
        head = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
        held, plain, number = [], 0, 0

        def flush():
            name = f"{context.partitionId():06d}-{number:06d}.warc.zst"
            hidden = f"{base}/_{name}.{context.taskAttemptId()}"
            data = head + b"".join(held)
            with store.open_output_stream(hidden) as f:
                f.write(data)
            store.move(hidden, f"{base}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64()),
                                               pa.array([len(data)], pa.int64())], names=["archive", "records", "bytes"])

        for b in batches:
            for page_id, url, payload, winner in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "winner"))):
                r = make_record(page_id, url, payload, winner, winner is not None)
                held.append(encoder.compress(r))
                plain += len(r)
                if plain >= archive_bytes:
                    yield flush()
                    held, plain, number = [], 0, number + 1
        if held:
            yield flush()

    return cut(decided.mapInArrow(run, "archive string, records long, bytes long"))


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """(archive, page_id, record_type, refers_to, target_uri, payload_bytes, payload_digest,
    payload): every record of the archives in ``folder``; payload is null for revisits, and for
    all records if ``payload`` is false. A damaged archive raises `BadArchive`; a folder
    without archives gives no rows."""
    columns = ["archive", "page_id", "record_type", "refers_to", "target_uri", "payload_bytes", "payload_digest", "payload"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                name, rows, size = path.rsplit("/", 1)[1], [], 0
                for h, block in records(content.as_py()):
                    body, n, d = parse_payload(h, block)
                    refers = page_of(h["warc-refers-to"]) if h["warc-type"] == "revisit" else None
                    rows.append((name, page_of(h["warc-record-id"]), h["warc-type"], refers, h.get("warc-target-uri"),
                                 n, d, body if payload else None))
                    size += len(body or b"") * payload
                    if size > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    return files.mapInArrow(run, "archive string, page_id long, record_type string, refers_to long, target_uri string, "
                                 "payload_bytes long, payload_digest string, payload binary")


_SQL = """
WITH p AS (SELECT page_id, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS h FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(0, 40), lambda i:
        substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', substr(h, CAST(i AS INTEGER) + 1, 1)) - 1) + 1, 4)), '') AS bits FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS winner,
      array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * CAST(substr(bits, 5 * CAST(i AS INTEGER) + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * CAST(i AS INTEGER) + 2, 1) AS INTEGER)
          + 4 * CAST(substr(bits, 5 * CAST(i AS INTEGER) + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * CAST(i AS INTEGER) + 4, 1) AS INTEGER)
          + CAST(substr(bits, 5 * CAST(i AS INTEGER) + 5, 1) AS INTEGER), 1)), '') AS payload_digest FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> winner THEN winner END AS refers_to FROM w"""


@query("op7_warc", _SQL)
def op7_warc(spark, sf_dir):
    folder = shared_folder(spark, "warc")
    if not write_archives(read(spark, sf_dir, "pages"), folder).count():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_archives(spark, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
