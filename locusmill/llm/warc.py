"""WARC: archives are written with one transaction per page, read back, and their records assembled into captures."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, no_text, shared_path, table, tidied

#: Payloads of fewer bytes are never revisits.
MIN_BYTES = 1000
#: Bytes of one archive before the next begins.
ARCHIVE_BYTES = 64 << 20
#: Payloads that repeat are sent to all tasks while they are so many at most (about 100 bytes each); beyond, rows are joined by digest.
BROADCAST_ROWS = 200_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: str, own: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    plain = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(plain) + squeeze.flush()


def _one_line(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:none")


def _writing(folder: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out = name = None
        size = n = 0
        done = []
        for batch in batches:
            for page, url, html, digest, n_bytes, target in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(_record("warcinfo", str(uuid.uuid4()), [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"software: locusmill\r\nformat: WARC File Format 1.1\r\n"))
                url = _one_line(url)
                own, asked, told = (str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}:{n}:{k}")) for k in ("capture", "request", "metadata"))
                host = url.split("/")[2] if "://" in url and len(url.split("/")) > 2 else ""
                payload = html or b""
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
                sha = ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
                uri = ("WARC-Target-URI", url)
                kind = ("Content-Type", "application/http; msgtype=response")
                if target is None:
                    main = _record("response", own, [uri, sha, kind], http + payload)
                else:
                    main = _record("revisit", own, [uri, sha, kind, ("WARC-Profile", PROFILE), ("WARC-Refers-To-Page", str(target))], http)
                request = _record("request", asked, [uri, ("WARC-Concurrent-To", f"<urn:uuid:{own}>"), ("Content-Type", "application/http; msgtype=request")], f"GET {url} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
                about = _record("metadata", told, [uri, ("WARC-Concurrent-To", f"<urn:uuid:{own}>"), ("Content-Type", "application/warc-fields")], b"" if page is None else f"page-id: {page}\r\n".encode())
                raw = request + main + about
                out.write(raw)
                size += len(raw)
                n += 1
                if size >= most:
                    out.close()
                    done.append((name, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.RecordBatch.from_pylist([{"file": f, "n": c} for f, c in done], pa.schema([("file", pa.string()), ("n", pa.int64())]))

    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, str]:
    """Write ``pages`` (page_id, url, html) as archives; returns their manifest (file, n captures) and the folder.

    Each page gives a request, a response or revisit, and a metadata record, the others concurrent to the second. Of equal
    payloads of ``min_bytes`` or more, that of the largest page id is the response, and the others revisit it: only the
    digests that repeat are looked up, and pages are not shuffled while those are few. Archives get new names each time a
    task runs; the manifest names those of the tasks that counted.

    Nulls: a null html is an empty payload, a null url is ``urn:none``; pages without id revisit one that has an id. Rows that
    repeat the largest id are all responses. An empty table has no archives.
    """
    bounded_batches(pages.sparkSession)
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    html = no_text(F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(html, "UTF-8").alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("n_bytes"))
    again = rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1 and target is not null").select(F.col("digest").alias("same"), "target")
    again = materialise(again, "warc-again")
    known = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    rows = rows.join(known, (F.col("digest") == F.col("same")) & (F.col("n_bytes") >= min_bytes), "left")
    rows = rows.select("page_id", "url", "html", "digest", "n_bytes", F.when(~F.col("target").eqNullSafe(F.col("page_id")), F.col("target")).alias("target"))
    return materialise(rows.mapInArrow(tidied(_writing(folder, archive_bytes)), "file string, n long"), "warc-manifest"), folder


def records(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an open archive, compressed record by record."""
    rest, plain = b"", b""
    inflate = zlib.decompressobj(31)
    while True:
        chunk = rest or f.read(1 << 20)
        if not chunk:
            break
        plain += inflate.decompress(chunk)
        rest = inflate.unused_data
        if inflate.eof:
            head, _, body = plain.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if not lines[0].startswith("WARC/1."):
                raise ValueError("not a WARC record")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            yield headers, body[: int(headers["content-length"])]
            inflate, plain = zlib.decompressobj(31), b""
        else:
            rest = b""
    if plain:
        raise ValueError("the archive ends within a record")


_RECORD = pa.schema([("file", pa.string()), ("id", pa.string()), ("concurrent_to", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("n_bytes", pa.int64()), ("refers_to", pa.int64()), ("block", pa.binary())])
_RECORD_DDL = "file string, id string, concurrent_to string, type string, uri string, page_id long, digest string, n_bytes long, refers_to long, block binary"


def _reading(folder: str, blocks: bool):
    def row(name: str, head: dict[str, str], block: bytes) -> dict:
        kind = head["warc-type"]
        out = {"file": name, "id": head["warc-record-id"], "concurrent_to": head.get("warc-concurrent-to"), "type": kind, "uri": head.get("warc-target-uri"), "block": block if blocks else None}
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            said = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
            length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            if kind == "response":
                if len(payload) != length or hashlib.sha1(payload).hexdigest() != said:
                    raise ValueError(f"{head['warc-record-id']} of {name}: the payload is not what its headers say")
            else:
                out["refers_to"] = int(head["warc-refers-to-page"])
            out |= {"digest": said, "n_bytes": length}
        elif kind == "metadata":
            for line in block.split(b"\r\n"):
                if line.startswith(b"page-id:"):
                    out["page_id"] = int(line[8:])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    held, size = [], 0
                    for head, block in records(f):
                        held.append(row(name, head, block))
                        size += len(block) if blocks else 0
                        if len(held) >= 2000 or size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, _RECORD)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, _RECORD)

    return run


def read_records(manifest: DataFrame, folder: str, blocks: bool = False) -> DataFrame:
    """A row per record of the archives; ``blocks`` carries their contents too."""
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("file").repartition(n).mapInArrow(tidied(_reading(folder, blocks)), _RECORD_DDL)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: the transaction's key, its request, main record and metadata, joined by concurrent-to.

    A record that is concurrent to another belongs to the other's transaction, one that names none has its own; so does a
    record whose partner is missing. Records without identifiers or of other types are left out.
    """
    key = F.coalesce("concurrent_to", "id")
    fields = F.struct("id", "type", "uri", "page_id", "digest", "n_bytes", "refers_to", "block")
    of = lambda *kinds: F.max(F.when(F.col("type").isin(*kinds), fields))
    kept = found.where(key.isNotNull() & F.col("type").isin("request", "response", "revisit", "metadata"))
    return kept.groupBy("file", key.alias("transaction")).agg(of("request").alias("request"), of("response", "revisit").alias("main"), of("metadata").alias("metadata"), F.count(F.lit(1)).alias("n_records"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = captures(read_records(*write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))))
    main = F.col("main")
    return whole.where(main.isNotNull()).select(F.col("metadata.page_id").alias("page_id"), main["n_bytes"].alias("payload_bytes"), main["digest"].alias("payload_digest"), main["type"].alias("record_type"), main["refers_to"].alias("refers_to"), "n_records")


OP10_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, max(page_id) AS target FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN target IS NOT NULL AND target IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN target IS DISTINCT FROM page_id THEN target END AS refers_to, CAST(3 AS BIGINT) AS n_records
FROM p LEFT JOIN m ON p.d = m.d AND p.n >= 1000
"""
