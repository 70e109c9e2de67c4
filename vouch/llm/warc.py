"""WARC archives of pages: an index of every record first, then reads of merged byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.llm.frames import partitions, releasing
from vouch.llm.skew import lookup
from vouch.sources.staging import new_folder, settle

#: An archive of more bytes is closed and the next one begun.
FILE_BYTES = 1 << 30
#: Ranges of a file that lie this close are read at once, up to so many bytes.
GAP, READ = 1 << 16, 8 << 20
#: Bytes of payload that a task holds before it hands them on.
HELD = 8 << 20

# The format's version, names of its fields, and the profile of records that repeat a payload.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Field of our own, as the format has none for a page's number.
PAGE_ID = "X-Page-Id"

_SAFE = "".join(chr(c) for c in range(33, 127))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: dict[str, str | None], payload: bytes | None) -> bytes:
    """One record as a gzip member: the fields that are not null, and an HTTP answer around the payload.

    A record without payload, a revisit, has the answer's header alone.
    """
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if payload is not None:
        body += b"Content-Length: %d\r\n" % len(payload)
    body += b"\r\n" + (payload or b"")
    fields = {**fields, "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(body))}
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"{VERSION}\r\n{head}\r\n".encode() + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of a record; ValueError where lengths or the payload's digest do not agree."""
    data = zlib.decompress(member, 31)
    head, rest = data.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if version != VERSION or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    payload = rest[:length].split(b"\r\n\r\n", 1)[1]
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != "sha1:" + base32_sha1(payload):
        raise ValueError(f"changed payload in {fields['WARC-Record-ID']}")
    return fields, payload


def _urn(name: str | None) -> str | None:
    return None if name is None else f"<urn:uuid:{uuid.UUID(name)}>"


def planned_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A row per record: type, id, page_id, url, sha1, payload_bytes, refers_to, refers_url, payload (null for a revisit).

    Of pages with equal payloads the one with the largest page_id, then url, is the response. Payloads are compared by
    SHA-256; equal ones combine before the shuffle, and revisits go without them.
    """
    html = F.coalesce("html", F.lit(""))
    hashed = pages.select("page_id", "url", html.cast("binary").alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("bigint"),
        "sha1": F.sha1("payload"),
        "key": F.sha2("payload", 256),
    })
    nothing = F.lit(None).cast("string")
    columns = ["type", "id", "page_id", "url", "sha1", "payload_bytes", "refers_to", "refers_url", "payload"]
    small = hashed.where(F.col("payload_bytes") < min_bytes)
    small = small.withColumns({"type": F.lit("response"), "id": F.replace(F.uuid(), F.lit("-")), "refers_to": nothing, "refers_url": nothing})
    large = hashed.where(F.col("payload_bytes") >= min_bytes)

    kept = large.groupBy("key").agg(
        F.max(F.struct("page_id", "url")).alias("top"), *[F.first(c).alias(c) for c in ("payload", "sha1", "payload_bytes")]
    )
    kept = kept.select("top.page_id", "top.url", "payload", "sha1", "payload_bytes", F.left("key", F.lit(32)).alias("id"))
    kept = kept.withColumns({"type": F.lit("response"), "refers_to": nothing, "refers_url": nothing})

    rows = settle(large.drop("payload").withColumn("row", F.monotonically_increasing_id()))
    tops = rows.groupBy("key").agg(F.max(F.struct("page_id", "url", "row")).alias("top"), F.count("*").alias("copies"))
    tops = settle(tops.where("copies > 1").select("key", "copies", F.col("top.row").alias("first"), F.col("top.url").alias("refers_url")))
    total = tops.agg(F.sum("copies")).first()[0] or 0
    again = lookup(rows, tops, ["key"], F.col("copies"), total).where("row <> first")
    again = again.withColumns({
        "type": F.lit("revisit"),
        "id": F.replace(F.uuid(), F.lit("-")),
        "refers_to": F.left("key", F.lit(32)),
        "payload": F.lit(None).cast("binary"),
    })
    return kept.select(*columns).unionByName(small.select(*columns)).unionByName(again.select(*columns))


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0) -> DataFrame:
    """Archives of all pages in ``folder``, and their index: record_id, page_id, url, type, payload_digest,
    payload_bytes, refers_to, file, offset, length.

    Every task writes files of its own, gzip member after gzip member. The index is a Parquet
    table beside them, ``folder``/index: it holds the records of tasks that ended well, so what
    a lost or repeated task has left behind is never read. ``folder`` is one that ``pyarrow.fs``
    opens on every executor (a shared path, HDFS, S3, GCS). ``date`` stands in every record.

    ``pages`` has page_id, url, html; other columns are ignored, the frame is read twice. A null
    html is empty; null page_id and url leave out their field, and a null page_id is smaller than any. Repeated rows
    are a response and revisits of it. No pages: no archive and an empty index.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    kinds = f"record_id string, page_id {kind}, url string, type string, payload_digest string, payload_bytes bigint, refers_to string, file string, offset bigint, length bigint"
    planned = planned_records(pages, min_bytes).withColumn("page", F.col("page_id").cast("string"))

    @releasing
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                places, ids, digests, refers = [], [], [], []
                fields = [batch.column(c) for c in ("type", "id", "page", "url", "sha1", "refers_to", "refers_url", "payload")]
                for row in zip(*fields, strict=True):
                    type_, id_, page, url, sha1, to, to_url, payload = (v.as_py() for v in row)
                    ids.append(_urn(id_))
                    refers.append(_urn(to))
                    digests.append(base64.b32encode(bytes.fromhex(sha1)).decode())
                    packed = record(
                        {
                            "WARC-Type": type_,
                            "WARC-Record-ID": ids[-1],
                            "WARC-Date": date,
                            "WARC-Target-URI": None if url is None else quote(url, safe=_SAFE),
                            "WARC-Payload-Digest": "sha1:" + digests[-1],
                            "WARC-Profile": PROFILE if type_ == "revisit" else None,
                            "WARC-Refers-To": refers[-1],
                            "WARC-Refers-To-Target-URI": None if to_url is None else quote(to_url, safe=_SAFE),
                            PAGE_ID: None if page is None else quote(page, safe=""),
                        },
                        payload,
                    )
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(packed)
                    places.append((name, at, len(packed)))
                    at += len(packed)
                    if at >= FILE_BYTES:
                        out.close()
                        out = None
                files, offsets, lengths = zip(*places, strict=True) if places else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.string()), batch.column("page_id"), batch.column("url"), batch.column("type"), pa.array(digests, pa.string()),
                        batch.column("payload_bytes"), pa.array(refers, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                    ],
                    names=["record_id", "page_id", "url", "type", "payload_digest", "payload_bytes", "refers_to", "file", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    planned.mapInArrow(write, kinds).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def ranges(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, start, end, numbers of the records in it): neighbours in sorted ``places`` (file, offset, length) merged."""
    file, start, end, members = None, 0, 0, []
    for number, (name, offset, length) in enumerate(places):
        if members and name == file and offset - end <= GAP and offset + length - start <= READ:
            end = max(end, offset + length)
            members.append(number)
        else:
            if members:
                yield file, start, end, members
            file, start, end, members = name, offset, offset + length, [number]
    if members:
        yield file, start, end, members


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the rows of ``index`` (file, offset, length) point at, as their archives hold them: record_id, type,
    page_id (text), url, payload_digest, payload_bytes, refers_to, and payload.

    Places are sorted over the cluster; each task merges near ones into one read. Lengths and
    digests are checked. A revisit has neither payload nor payload_bytes: those are its response's.
    """
    kinds = "record_id string, type string, page_id string, url string, payload_digest string, payload_bytes bigint, refers_to string" + ", payload binary" * payloads
    schema = pa.schema([(f.split()[0], pa.int64() if "bigint" in f else pa.binary() if "binary" in f else pa.string()) for f in kinds.split(", ")])

    @releasing
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        open_name, source = None, None
        rows, held = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            for name, start, end, members in ranges(places):
                if name != open_name:
                    if source:
                        source.close()
                    open_name, source = name, store.open_input_file(f"{root}/{name}")
                data = source.read_at(end - start, start)
                for number in members:
                    _, offset, length = places[number]
                    fields, payload = parse(data[offset - start : offset - start + length])
                    full = fields["WARC-Type"] == "response"
                    page = fields.get(PAGE_ID)
                    row = {
                        "record_id": fields["WARC-Record-ID"],
                        "type": fields["WARC-Type"],
                        "page_id": None if page is None else unquote(page),
                        "url": fields.get("WARC-Target-URI"),
                        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "payload_bytes": len(payload) if full else None,
                        "refers_to": fields.get("WARC-Refers-To"),
                    }
                    rows.append({**row, "payload": payload if full else None} if payloads else row)
                    held += len(payload) if payloads else 0
                    if held > HELD or len(rows) >= 4096:
                        yield batch_of()
                        rows, held = [], 0
        if source:
            source.close()
        if rows:
            yield batch_of()

    n = partitions(index.sparkSession)
    places = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset")
    return places.sortWithinPartitions("file", "offset").mapInArrow(read, kinds)


def read_pages(selected: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """page_id, url, html bytes of the ``selected`` rows of an index: revisits get their response's payload.

    Each response is read once, however many selected records share it.
    """
    wanted = selected.select("record_id", "page_id", "url", F.coalesce("refers_to", "record_id").alias("held_by"))
    needed = wanted.select(F.col("held_by").alias("record_id")).distinct()
    held = read_records(index.join(needed, "record_id", "left_semi"), folder).select(F.col("record_id").alias("held_by"), "payload")
    counted = wanted.groupBy("held_by").agg(F.count("*").alias("copies"))
    copies = settle(held.join(counted, "held_by"))
    found = lookup(wanted, copies, ["held_by"], F.col("copies"), wanted.count())
    return found.select("page_id", "url", F.col("payload").alias("html"))


def archive_digests(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from its archives.

    ``folder`` is a new one in the shared folder unless given. See ``write_archives`` for
    nulls, repeated and empty input.
    """
    folder = folder or new_folder(pages.sparkSession)
    kind = pages.schema["page_id"].dataType
    records = settle(read_records(write_archives(pages, folder, min_bytes=min_bytes), folder, payloads=False))
    records = records.withColumn("page_id", F.col("page_id").cast(kind))
    responses, revisits = records.where("type = 'response'"), records.where("type = 'revisit'")
    copies = revisits.groupBy("refers_to").agg(F.count("*").alias("copies"))
    sources = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("of"), F.col("payload_bytes").alias("size"))
    sources = settle(sources.join(copies, "refers_to"))
    found = lookup(revisits.drop("payload_bytes"), sources, ["refers_to"], F.col("copies"), revisits.count())
    first = responses.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"))
    later = found.select("page_id", F.col("size").alias("payload_bytes"), "payload_digest", F.col("type").alias("record_type"), F.col("of").alias("refers_to"))
    return first.unionByName(later)
