"""WARC archives: one gzip member per record, written and read sequentially.

Pages with equal payloads are stored once, as the response of the page with the
largest id; the others are revisit records that name it (WARC 1.1, "identical
payload digest" profile). A task writes its pages to one archive in the shared
folder under a name of its own, and reports the name and the number of records;
only the reports of finished tasks are kept, so a repeated task leaves no record
twice. The reader inflates an archive piece by piece and holds one record."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import as_bytes, map_batches, stored
from replyscope.session import scratch_path

CHUNK = 1 << 18
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
LENGTH = "X-Payload-Length"  # extension field: bytes of the whole payload, also for revisits
PAGE = "X-Page-Id"  # extension field


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One gzip member. Line breaks and other control characters of a URL are
    percent-encoded; a page without a URL has a urn."""
    uri = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or f"urn:page:{page_id}")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + payload if refers_to is None else head
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        (LENGTH, str(len(payload))),
        (PAGE, "" if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    lines = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(lines + block + b"\r\n\r\n") + deflate.flush()


def members(stream) -> Iterator[bytes]:
    """Inflated gzip members of a stream, one after the other. The compressed bytes
    are read in chunks; a member that ends too early is an error."""
    inflate, held, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(CHUNK)
        rest = b""
        if not data:
            if held:
                raise ValueError("archive ends inside a record")
            return
        held.append(inflate.decompress(data))
        if inflate.eof:
            rest = inflate.unused_data
            yield b"".join(held)
            inflate, held = zlib.decompressobj(31), []


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record. Content-Length frames the block; the
    block digest, and for a response the payload digest, are verified."""
    head, separator, body = member.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not separator or not first.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.decode().strip().lower(): v.decode().strip() for k, _, v in (line.partition(b":") for line in lines)}
    size = int(fields["content-length"])
    if body[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')}: Content-Length {size} does not frame its block")
    block = body[:size]
    if fields["warc-block-digest"] != f"sha1:{digest_of(block)}":
        raise ValueError(f"record {fields['warc-record-id']}: block digest differs")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{digest_of(payload)}":
        raise ValueError(f"record {fields['warc-record-id']}: payload digest differs")
    return fields, payload


def plan_records(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, payload, digest, refers_to) of every page. Payload: the html in
    UTF-8, empty if null. Of equal payloads of at least `min_bytes` bytes the page
    with the largest id is stored, the others refer to it; null ids count as the
    smallest, and repeated rows of the largest id are all stored."""
    payload = F.coalesce(as_bytes(html), F.lit(b""))
    all_ = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    all_ = all_.withColumn("sha", F.sha1("payload"))
    light = stored(all_.select("key", "sha", F.octet_length("payload").alias("bytes")), "payloads")
    largest = stored(light.filter(F.col("bytes") >= min_bytes).groupBy("sha").agg(F.max("key").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "equal")
    refers = light.filter(F.col("bytes") >= min_bytes).join(largest, "sha").filter("top IS NOT NULL AND NOT (key <=> top)").select("key", "sha", "top").distinct()
    refers = stored(refers.select(F.coalesce("key", F.lit(-1)).alias("k"), F.col("key").isNull().alias("no_key"), F.col("sha").alias("s"), "top"), "refers")
    same = (F.coalesce("key", F.lit(-1)) == F.col("k")) & (F.col("key").isNull() == F.col("no_key")) & (F.col("sha") == F.col("s"))
    return all_.join(refers, same, "left").select("key", "url", "payload", "sha", F.col("top").alias("refers_to"))


def write_archives(records: DataFrame, folder: str, date: str = DATE) -> DataFrame:
    """Writes the records, one archive per task, and returns (path, records) of
    the archives. `folder` is one that all executors reach."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, written = f"pages-{uuid.uuid4().hex}.warc.gz", 0
        with store.open_output_stream(f"{base}/{name}", compression=None) as out:
            for part in parts:
                for page, url, payload, sha, refers in zip(part["key"], part["url"], part["payload"], part["sha"], part["refers_to"]):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    out.write(record(page, url, bytes(payload), digest, refers, date))
                    written += 1
        yield {"path": [f"{folder}/{name}"], "records": [written]}

    return stored(map_batches(records, run, "path string, records long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to[,
    payload]) of every record of the archives (path, records). A truncated or
    damaged archive, or one with another number of records, is an error. The
    payload of a revisit is null."""

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            for path, expected in zip(part["path"], part["records"]):
                store, file = pyarrow.fs.FileSystem.from_uri(path)
                seen = 0
                with store.open_input_stream(file, compression=None) as stream:
                    rows: list[tuple] = []
                    held = 0
                    for member in members(stream):
                        fields, payload = parse(member)
                        page, refers = fields[PAGE.lower()], fields.get("x-refers-to-page-id")
                        stored_here = fields["warc-type"] == "response"
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        length = len(payload) if stored_here else int(fields[LENGTH.lower()])
                        rows.append((int(page) if page else None, fields["warc-target-uri"], fields["warc-type"], length, digest, int(refers) if refers else None, payload if stored_here else None))
                        seen, held = seen + 1, held + (len(payload) if with_payload else 0)
                        if len(rows) >= 500 or held > 1 << 24:
                            yield dict(zip(names, zip(*rows)))
                            rows, held = [], 0
                    if rows:
                        yield dict(zip(names, zip(*rows)))
                if seen != expected:
                    raise ValueError(f"{path}: {seen} records, {expected} were written")

    names = ("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + (", payload binary" if with_payload else "")
    n = max(1, archives.count())
    return map_batches(archives.repartition(n, "path"), run, schema)


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes every page to WARC archives (in the shared folder, unless another is
    given) and reads them back: the records without their payloads."""
    target = folder or scratch_path(pages.sparkSession, "warc")
    written = write_archives(plan_records(pages, min_bytes, key, url, html), target)
    return read_archives(written, with_payload=False).withColumnRenamed("page_id", key)


__all__ = ["archive", "members", "parse", "plan_records", "read_archives", "record", "write_archives"]
