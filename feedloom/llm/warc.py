"""WARC archives: a writer with revisit records and a sequential reader.

Archives hold one gzip member per record.  ``write_archives`` stores a
table's payloads as ``response`` records with an HTTP block; of the records
with equal payloads of at least ``min_revisit_bytes`` bytes only the one with
the smallest id keeps its payload, the others become ``revisit`` records
that name it.  ``read_archives`` streams each archive front to back:
incremental inflation member by member, framing by Content-Length, and the
SHA-256 digests of block and payload recomputed and compared.

Scale: payload digests are grouped on (digest, id) rows with partial
aggregation, so copies meet only as one row per task; the payloads move once,
in a join on the digest that the adaptive skew rule can split.  Tasks write
archives of bounded size into the shared folder and report them in a manifest
that Spark commits; files of failed or repeated attempts are in no manifest
and are never read.  Reading one archive needs one record in memory.

Defined results: a null payload is an empty one; rows with a null id are
written (without a target) as responses unless a row with an id has the same
payload; rows that repeat the smallest id are all responses; a truncated or
corrupt member ends its archive with an ``error`` row, a digest that doesn't
match marks its record ``digest_ok = false``, one of an unknown kind leaves it
null; an empty table gives no archives.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.files import filesystem
from feedloom.operators.fetch import join_on_key

ARCHIVE_BYTES = 64 << 20  # an archive is closed once it holds this much
BATCH_BYTES = 8 << 20     # payload bytes per Arrow batch handed back
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
RECORDS = ("path string, offset long, record_type string, record_id string, target_uri string, "
           "refers_to string, payload_digest string, payload_bytes long, payload binary, "
           "digest_ok boolean, error string")


def plan_records(df: DataFrame, id_col: str, payload: Column, uri: Column,
                 min_revisit_bytes: int = 100) -> DataFrame:
    """(id, uri, payload, digest, refers_to): what each row's record will be."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), uri.cast("string").alias("uri"),
                     F.coalesce(payload.cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    first = (rows.where(F.octet_length("payload") >= min_revisit_bytes)
             .groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
             .where("n > 1 and first_id is not null").select(F.col("digest").alias("first_digest"), "first_id"))
    return (join_on_key(rows, first, ["digest"], ["first_digest"], "left")
            .select("id", "uri", "payload", "digest",
                    F.when(~F.col("id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to")))


def _record_uri(i) -> str:
    return f"urn:feedloom:record:{'null' if i is None else i}"


def encode_record(record_id, uri, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member with one record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    clean = " ".join((uri or "").split())
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<{_record_uri(record_id)}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", clean),
            ("WARC-Payload-Digest", "sha256:" + digest),
            ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
            ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{_record_uri(refers_to)}>"), ("WARC-Profile", PROFILE)]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records; returns the committed manifest of archives."""
    files = f"{folder}/archives"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(files)
        fs.create_dir(base, recursive=True)
        out, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for i, uri, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                member = encode_record(i, uri, payload.encode("utf-8"), digest, refers)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{files}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{files}/{name}", count, size))
        cols = list(zip(*done)) if done else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
            names=["path", "records", "bytes"])

    manifest = f"{folder}/manifest"
    (records.select("id", "uri", "payload", "digest", "refers_to")
     .mapInArrow(write, MANIFEST).write.parquet(manifest))
    return records.sparkSession.read.parquet(manifest)


class Members:
    """Front-to-back reading of a gzip file, one member at a time."""

    def __init__(self, stream, chunk: int = 1 << 18):
        self.stream, self.chunk = stream, chunk
        self.held, self.offset = b"", 0

    def _more(self) -> bool:
        if not self.held:
            self.held = self.stream.read(self.chunk)
        return bool(self.held)

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        """(offset of the member in the file, its inflated bytes)."""
        while self._more():
            at, inflate, parts = self.offset, zlib.decompressobj(31), []
            while not inflate.eof:
                if not self._more():
                    raise ValueError(f"archive ends inside the member at {at}")
                given = self.held
                parts.append(inflate.decompress(given))
                self.held = inflate.unused_data
                self.offset += len(given) - len(self.held)
            yield at, b"".join(parts)


def _headers(block: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        key, sep, value = line.partition(":")
        if sep:
            out.setdefault(key.strip().lower(), value.strip())
    return out


def decode_record(raw: bytes) -> dict:
    """Fields of one record; raises ValueError where the framing is wrong."""
    if not raw.startswith(b"WARC/"):
        raise ValueError("a member doesn't begin with a WARC version line")
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("record headers do not end")
    head = _headers(raw[raw.index(b"\r\n") + 2:end])
    length, begin = int(head["content-length"]) if head.get("content-length", "").isdigit() else -1, end + 4
    if length < 0 or begin + length > len(raw) or raw[begin + length:begin + length + 4] != b"\r\n\r\n":
        raise ValueError("Content-Length does not frame the record")
    block = raw[begin:begin + length]
    kind = head.get("warc-type", "")
    ok = _same(head.get("warc-block-digest"), block)
    payload, size = block, length
    if "application/http" in head.get("content-type", ""):
        cut = block.find(b"\r\n\r\n")
        http = _headers(block[:max(cut, 0)])
        payload = block[cut + 4:] if cut >= 0 else b""
        stated = http.get("content-length", "")
        size = int(stated) if stated.isdigit() else len(payload)
    if kind == "revisit":
        payload = None  # a revisit has no payload of its own; the digest is its target's
    else:
        ok = _both(ok, _both(size == len(payload), _same(head.get("warc-payload-digest"), payload)))
    return {"record_type": kind, "record_id": head.get("warc-record-id", "").strip("<>"),
            "target_uri": head.get("warc-target-uri"),
            "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
            "payload_digest": head.get("warc-payload-digest", "").rpartition(":")[2] or None,
            "payload_bytes": size, "payload": payload, "digest_ok": ok}


# Kinds of digest that archives state (fixed values).
DIGESTS = ("sha1", "md5", "sha256", "sha512")


def _same(stated: str | None, data: bytes) -> bool | None:
    """Whether a digest header agrees with the data, in hex or base 32; an
    absent one does, one of an unknown kind is not judged (None)."""
    kind, sep, value = (stated or "").strip().partition(":")
    if not sep:
        return True
    kind = kind.lower().replace("-", "")
    if kind not in DIGESTS:
        return None
    found = hashlib.new(kind, data).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def _both(a: bool | None, b: bool | None) -> bool | None:
    """Both agree; None where none fails but one is not judged."""
    return False if a is False or b is False else None if a is None or b is None else True


_COLUMNS = [("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
            ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("digest_ok", pa.bool_()), ("error", pa.string())]


def read_archives(paths: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every record of the archives named in column ``path``."""
    spark: SparkSession = paths.sparkSession
    tasks = tasks or max(spark.sparkContext.defaultParallelism, paths.count() // 4)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in rows], t) for n, t in _COLUMNS], names=[n for n, _ in _COLUMNS])

        for given in batches:
            for path in given.column(0).to_pylist():
                rows, held = [], 0
                fs, name = filesystem(path)
                with fs.open_input_stream(name, compression=None) as stream:
                    members = Members(stream)
                    try:
                        for at, raw in members:
                            rows.append({"path": path, "offset": at} | decode_record(raw))
                            held += len(raw)
                            if held >= BATCH_BYTES:
                                yield batch(rows)
                                rows, held = [], 0
                    except (ValueError, zlib.error) as e:
                        rows.append({"path": path, "offset": members.offset, "error": str(e)})
                if rows:
                    yield batch(rows)

    return paths.select("path").where("path is not null").repartition(tasks).mapInArrow(read, RECORDS)
