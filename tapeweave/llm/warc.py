"""WARC archives of pages: written by tasks, read back and assembled by transaction.

Every page gives three records: its response (or a revisit that points to the
response of an equal payload), and a request and a metadata record that name it
in WARC-Concurrent-To. Reading parses the archives record by record and joins
the three again by that identifier, in whatever files they lie.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.llm.common import give_back, pieces, saved
from tapeweave.llm.shared_files import attempt_name, open_store

DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
_SPACE = uuid.UUID("b5b8c7d2-6f0e-4a53-9d3e-2f6b1d0c9a11")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(kind: str, page, row) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind}:{page}:{row}')}>"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, body: bytes, headers: list[tuple[str, str | None]], level: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}"]
    lines += [f"{k}: {v}" for k, v in headers if v is not None]
    lines += [f"Content-Length: {len(body)}", "", ""]
    pack = zlib.compressobj(level, wbits=31)  # a gzip member for each record
    return pack.compress("\r\n".join(lines).encode() + body + b"\r\n\r\n") + pack.flush()


def page_records(page, url: str | None, html: str | None, row: int, target: tuple | None, date: str = DATE,
                 level: int = LEVEL) -> list[bytes]:
    """Response or revisit, request and metadata of one page; ``target`` is (page, row) of the response."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    own, digest = _urn("response", page, row), _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    answer = [*head, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if target is None:
        first = _record("response", own, http + payload, answer, level)
    else:
        first = _record("revisit", own, http, [*answer, ("WARC-Profile", _PROFILE),
                                               ("WARC-Refers-To", _urn("response", *target))], level)
    ask = b"GET / HTTP/1.1\r\n\r\n"
    facts = "".join(f"{k}: {v}\r\n" for k, v in (("page-id", page), ("payload-length", len(payload))) if v is not None)
    return [first,
            _record("request", _urn("request", page, row), ask,
                    [*head, ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], level),
            _record("metadata", _urn("metadata", page, row), facts.encode(),
                    [*head, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], level)]


def write(pages: DataFrame, out: str, min_bytes: int = 0, id: str = "page_id", url: str = "url", html: str = "html",
          date: str = DATE, level: int = LEVEL) -> DataFrame:
    """Write one archive per task below ``out``; returns the manifest ``file``, ``records``, ``bytes``.

    Among pages with equal payloads of at least ``min_bytes`` bytes the one with
    the largest id is the response (of rows with that id the last one read) and
    the others revisit it. A null id is smaller than all; a null html is an
    empty payload; a null url leaves the target out. An empty table gives no file.
    """
    rows = pages.select(F.col(id).cast("long").alias("page"), F.col(url).alias("url"), F.col(html).alias("html"),
                        F.monotonically_increasing_id().alias("row"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumn("sha", F.unhex(F.sha1(payload))).withColumn("size", F.length(payload))
    groups = (rows.where(F.col("size") >= min_bytes).groupBy("sha", "size")
              .agg(F.max(F.struct("page", "row")).alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("sha", "size", "target"))
    joined = (rows.join(groups, ["sha", "size"], "left")
              .select("page", "url", "html", "row",
                      F.when(F.struct("page", "row") != F.col("target"), F.col("target")).alias("target")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(out)
        _, name = attempt_name("pages", ".warc.gz")
        sink, records, size = None, 0, 0
        for batch in pieces(batches):
            for page, at, text, row, target in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    store.create_dir(path, recursive=True)
                    sink = store.open_output_stream(f"{path}/{name}")
                for r in page_records(page, at, text, row, target and (target["page"], target["row"]), date, level):
                    sink.write(r)
                    records, size = records + 1, size + len(r)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "records": records, "bytes": size}],
                                             pa.schema([("file", pa.string()), ("records", pa.int64()),
                                                        ("bytes", pa.int64())]))

    return saved(joined.mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


def parse(source, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and body of each record of an open archive; one record is held at a time."""
    unpack, waiting, ended = zlib.decompressobj(wbits=31), b"", False
    data = bytearray()

    def more() -> bool:
        nonlocal unpack, waiting, ended
        while not ended:
            if unpack.eof:
                waiting, unpack = unpack.unused_data or waiting, zlib.decompressobj(wbits=31)
            if not waiting:
                waiting = source.read(chunk)
                if not waiting:
                    ended = True
                    return False
            made = unpack.decompress(waiting)
            waiting = b"" if not unpack.eof else b""
            if made:
                data.extend(made)
                return True
        return False

    while True:
        while b"\r\n\r\n" not in data:
            if not more():
                if data.strip():
                    raise ValueError("archive cut short in a header")
                return
        head, _, _ = bytes(data).partition(b"\r\n\r\n") if len(data) < 1 << 16 else data.partition(b"\r\n\r\n")
        lines = bytes(head).decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin, size = len(head) + 4, int(fields.get("content-length", 0))
        while len(data) < begin + size + 4:
            if not more():
                break
        if len(data) < begin + size:
            raise ValueError("archive cut short in a record")
        yield fields, bytes(data[begin:begin + size])
        del data[:begin + size + 4]


_RECORD = ("type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
           "payload_digest string, payload_bytes long, page_id long, payload binary")


def records(spark: SparkSession, manifest: DataFrame, out: str, payloads: bool = True) -> DataFrame:
    """Rows of all records; digest and length of a response are those of the payload that was read."""
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def row(fields: dict[str, str], body: bytes) -> tuple:
        kind = fields.get("warc-type")
        size, page, payload, digest = None, None, None, fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == "response":
            payload = body.partition(b"\r\n\r\n")[2]
            size, digest = len(payload), _digest(payload)
        elif kind == "metadata":
            facts = dict(x.split(": ", 1) for x in body.decode().split("\r\n") if ": " in x)
            size = int(facts["payload-length"]) if "payload-length" in facts else None
            page = int(facts["page-id"]) if "page-id" in facts else None
        return (kind, fields.get("warc-record-id"), fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
                fields.get("warc-target-uri"), digest, size, page, payload if payloads else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(out)
        kinds = [pa.string()] * 6 + [pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{path}/{name}") as source:
                    held, size = [], 0
                    for fields, body in parse(source):
                        held.append(row(fields, body))
                        size += 500 + (len(body) if payloads else 0)
                        if size > 4 << 20:
                            yield _batch(held, names, kinds)
                            held, size = [], 0
                    if held:
                        yield _batch(held, names, kinds)
        give_back()

    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(run, _RECORD)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with all ``requests`` and ``metadata``
    records that are concurrent to it. Records that are concurrent to none are left out; a capture
    without a request or metadata record has an empty list there; its page is null then.

    ``payload_bytes`` of a revisit is the length that its metadata record states.
    ``found`` is read three times: write it first where that means parsing archives.
    """
    main = found.where(F.col("type").isin("response", "revisit"))
    side = F.struct("record_id", "target_uri", "page_id", "payload_bytes").alias("record")

    def of(kind: str, name: str) -> DataFrame:
        return (found.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
                .select(F.col("concurrent_to").alias("record_id"), side)
                .groupBy("record_id").agg(F.sort_array(F.collect_list("record")).alias(name)))

    none = F.array().cast("array<struct<record_id:string,target_uri:string,page_id:bigint,payload_bytes:bigint>>")
    first: Column = F.try_element_at("metadata", F.lit(1))
    return (main.join(of("request", "requests"), "record_id", "left").join(of("metadata", "metadata"), "record_id", "left")
            .select("record_id", F.col("type").alias("record_type"), first["page_id"].alias("page_id"), "target_uri",
                    "payload_digest", F.coalesce(F.col("payload_bytes"), first["payload_bytes"]).alias("payload_bytes"),
                    "refers_to", F.coalesce("requests", none).alias("requests"),
                    F.coalesce("metadata", none).alias("metadata"), "payload"))
