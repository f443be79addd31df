"""WARC archives: writing monolithic gzip files, normalising them to a member per record, reading by offset.

* `write_archives`: each task streams its records into whole-file gzip streams (one gzip member per file), a new file
  after `file_bytes` of records.
* `normalise`: inflates such a file once, front to back, and writes every record as a gzip member of its own, with an
  index row (offset, length, type, ids) per record: the sidecar table.
* `read_records`: reads records back through the index, member by member.

Files are written and read with pyarrow's file systems below a folder all executors share. A file is named after its
partition and a random token and only counts once its name has come back in a task's committed result, so a task that
is lost or runs twice leaves at most an unnamed file. Payloads are handled one record at a time.

Defined results: a null payload is empty; equal rows are records each; of equal payloads of `min_bytes` or more the
rows with the largest id are responses and all others revisit it (a null id is smaller than any); an empty table gives
no archive. Other columns do not travel.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import stored
from skyherald.session import shared_dir

CHUNK = 1 << 18
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
INDEX_DDL = (
    "archive string, offset long, length long, record_id string, record_type string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string"
)


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def base32_sha1(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(
    record_id: str, kind: str, uri: str, digest_hex: str, payload: bytes, size: int, refers_to: str | None
) -> bytes:
    """One WARC/1.1 record. A revisit has no payload; its digest and length are those of the full payload."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: {base32_sha1(digest_hex)}", f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:] if x)}


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, header block, payload) of each record of an inflated stream. Holds one record at a time."""
    held, eof = bytearray(), False
    at = 0

    def more() -> bool:
        nonlocal eof, at
        if at:
            del held[:at]
            at = 0
        piece = next(chunks, None)
        eof = piece is None
        held.extend(piece or b"")
        return not eof

    while True:
        while (cut := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if len(held) > at:
                    raise ValueError("truncated WARC record")
                return
        head = bytes(held[at:cut])
        fields = parse_head(head)
        at = cut + 4
        size = int(fields["content-length"])
        while len(held) - at < size + 4:
            if not more():
                raise ValueError("truncated WARC record")
        yield fields, head, bytes(held[at : at + size])
        at += size + 4


def inflated(stream, chunk: int = CHUNK) -> Iterator[bytes]:
    """Inflate a whole gzip file in order, whatever the number of its members."""
    inflate = zlib.decompressobj(31)
    while piece := stream.read(chunk):
        while piece:
            # bounded output per step, so that a well-compressed stretch is not inflated at once
            yield inflate.decompress(piece, 4 * chunk)
            piece = inflate.unconsumed_tail
            if inflate.eof:
                piece = inflate.unused_data
                inflate = zlib.decompressobj(31)
    yield inflate.flush()


def plan_records(pages: DataFrame, id_col: str, payload: str, uri: str | None, min_bytes: int) -> DataFrame:
    """Pages with digest, size, record type and the id a revisit refers to.

    The largest id per repeated payload is a pre-aggregated maximum; what is joined back is one row per payload that
    occurs twice or more.
    """
    full = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), full.alias("payload"), F.sha1(full.cast("binary")).alias("digest"),
        F.octet_length(full).cast("long").alias("size"),
        (F.coalesce(F.col(f"`{uri}`"), F.lit("")) if uri else F.lit("")).alias("uri"),
    )
    shared = (
        rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
        .agg(F.max("id").alias("newest"), F.count(F.lit(1)).alias("n")).filter("n >= 2").select("digest", "size", "newest")
    )
    joined = rows.join(stored(shared, "shared-payloads"), ["digest", "size"], "left")
    first = F.col("newest").isNull() | F.col("id").eqNullSafe(F.col("newest"))
    return joined.select(
        "id", "uri", "digest", "size", F.when(first, "response").otherwise("revisit").alias("kind"),
        F.when(~first, F.col("newest")).alias("refers_to"), F.when(first, F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, folder: str, file_bytes: int) -> DataFrame:
    """Write records (`plan_records`) to monolithic .warc.gz files; one row (archive, records) per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        done, out, path, packer, count, size = [], None, None, None, 0, 0

        def close():
            nonlocal out
            if out is not None:
                out.write(packer.flush())
                out.close()
                done.append((path, count))
                out = None

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for r in batch.slice(start, 64).to_pylist():
                    if out is None:
                        files, root = _located(folder)
                        files.create_dir(root, recursive=True)
                        path = f"{folder}/part-{task:05d}-{uuid.uuid4().hex}.warc.gz"
                        out, packer, count, size = _located(path)[0].open_output_stream(_located(path)[1], compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                    raw = record(
                        "" if r["id"] is None else str(r["id"]), r["kind"], r["uri"].replace("\r", "").replace("\n", ""),
                        r["digest"], (r["payload"] or "").encode(), r["size"], r["refers_to"],
                    )
                    out.write(packer.compress(raw))
                    count, size = count + 1, size + len(raw)
                    if size >= file_bytes:
                        close()
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())],
            names=["archive", "records"],
        )

    # the list of files is committed by Spark: only files named in it exist for later steps
    return stored(records.mapInArrow(run, "archive string, records long"), "archive-list")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite monolithic archives with a gzip member per record; returns the sidecar index, one row per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows: list[dict] = []
                files, place = _located(archive)
                target = f"{folder}/{archive.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                out_files, out_place = _located(target)
                out_files.create_dir(_located(folder)[1], recursive=True)
                offset = 0
                with files.open_input_stream(place, compression=None) as stream, out_files.open_output_stream(out_place, compression=None) as out:
                    for fields, head, payload in records_of(inflated(stream)):
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = packer.compress(head + b"\r\n\r\n" + payload + b"\r\n\r\n") + packer.flush()
                        out.write(member)
                        rows.append(_index_row(target, offset, len(member), fields))
                        offset += len(member)
                        if len(rows) >= 4096:
                            yield _index_batch(rows)
                            rows = []
                yield _index_batch(rows)

    # adaptive execution would merge the few bytes of all names into one task; an explicit number stays
    apart = archives.select("archive").repartitionByRange(_tasks(archives, archives.count()), "archive")
    return stored(apart.mapInArrow(run, INDEX_DDL), "archive-index")


def _tasks(df: DataFrame, archives: int) -> int:
    """Tasks for so many archives: one each while they are few, later at most 16 in one."""
    return max(1, min(archives, max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-archives // 16))))


_INDEX = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
])


def _index_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_INDEX)


def _bare(urn: str | None) -> str | None:
    return urn[len("<urn:page:") : -1] if urn else None


def _index_row(archive: str, offset: int, length: int, fields: dict[str, str]) -> dict:
    return {
        "archive": archive, "offset": offset, "length": length, "record_id": _bare(fields["warc-record-id"]) or None,
        "record_type": fields["warc-type"], "target_uri": fields["warc-target-uri"],
        "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "payload_bytes": int(fields["x-payload-length"]), "refers_to": _bare(fields.get("warc-refers-to")),
    }


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Read every indexed record back from its own gzip member; checks a response's payload against its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, stream = None, None
        for batch in batches:
            rows, payloads = [], []
            for r in batch.to_pylist():
                if r["archive"] != opened:
                    if stream is not None:
                        stream.close()
                    files, place = _located(r["archive"])
                    opened, stream = r["archive"], files.open_input_file(place)
                stream.seek(r["offset"])
                (fields, _, payload), *rest = records_of(iter([zlib.decompress(stream.read(r["length"]), 31)]))
                if rest:
                    raise ValueError("more than one record in a member")
                row = _index_row(r["archive"], r["offset"], r["length"], fields)
                if row["record_type"] == "response" and (
                    hashlib.sha1(payload).hexdigest() != row["payload_digest"] or len(payload) != row["payload_bytes"]
                ):
                    raise ValueError(f"payload of {row['record_id']} differs from its digest")
                rows.append(row)
                payloads.append(payload if with_payload else None)
            out = _index_batch(rows)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(payloads, pa.binary())], names=[*_INDEX.names, "payload"])
        if stream is not None:
            stream.close()

    # ranges of records, as many as archives ask for: an index is small beside what it points to
    tasks = _tasks(index, index.select("archive").distinct().count())
    ordered = index.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(run, INDEX_DDL + ", payload binary")


def archived(
    pages: DataFrame, id_col: str = "page_id", payload: str = "html", uri: str | None = "url", min_bytes: int = 1000,
    file_bytes: int = 64 << 20, with_payload: bool = True,
) -> DataFrame:
    """Pages written to archives, normalised, and read back through the index."""
    root = shared_dir(pages.sparkSession, "warc")
    plan = plan_records(pages, id_col, payload, uri, min_bytes)
    listed = write_archives(plan, f"{root}/monolithic", file_bytes)
    return read_records(normalise(listed, f"{root}/records"), with_payload)
