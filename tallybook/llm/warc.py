"""WARC archives: a writer through Spark's own file output, and a reader that salvages damaged files."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.scratch import stored

END = b"\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
#: Records of fewer payload bytes are never revisits.
LEAST = 100

RECORD = (
    "path string, kind string, at long, length long, type string, record_id string, uri string, refers_to string,"
    " payload_bytes long, payload_digest string, payload binary, reason string"
)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", records_a_file: int = 8192) -> None:
    """Writes one record per row below ``path``; of equal payloads the smallest id is kept, others revisit it.

    Payloads of under 100 bytes are always kept. A null payload is empty, a null url leaves out its line, line
    breaks in a url are escaped. A row that repeats another one, id included, is a response of its own. A null
    id writes an empty number; it never is what others refer to. The files come from Spark's text writer with
    the record's end as separator, so the commit protocol of the output holds and lost tasks leave nothing.
    Payloads are only shuffled if the table of repeated payloads is too large for Spark to broadcast.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    base = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("n"), F.col(url_col).alias("url"), payload.alias("payload"))
    base = base.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    again = (
        base.where(F.col("bytes") >= LEAST)
        .groupBy("digest")
        .agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1 and first is not null")
        .select("digest", "first")
    )
    joined = base.join(stored(again), "digest", "left")
    revisit = F.coalesce(F.col("first") != F.coalesce(F.col("n"), F.col("first") - 1), F.lit(False))
    line = "\r\n"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(line * 2),
    )
    joined = joined.withColumn("revisit", revisit)
    joined = joined.withColumn("block", F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload"))))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "),
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: <urn:page:"),
        F.coalesce("id", F.lit("")),
        F.lit(">"),
        F.coalesce(F.concat(F.lit(f"{line}WARC-Target-URI: "), uri), F.lit("")),
        F.when(F.col("revisit"), F.concat(F.lit(f"{line}WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{line}Content-Type: application/http; msgtype=response{line}WARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit(f"{line}WARC-Block-Digest: sha256:"),
        F.sha2("block", 256),
        F.lit(f"{line}Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(line * 2),
    )
    records = joined.select(F.concat(head, F.col("block")).alias("value"))
    records.write.option("lineSep", END.decode()).option("maxRecordsPerFile", records_a_file).text(path)


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (x.split(b":", 1) for x in lines.split(b"\r\n") if b":" in x)
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, v in pairs}


def _record(data, at: int) -> tuple[dict, int] | str:
    """The record that begins at ``at`` and the place after it, or what is wrong with it."""
    if not VERSION.match(data, at):
        return "no version line"
    top = data.find(END, at)
    if top < 0:
        return "no end of headers"
    head = _headers(data[at:top])
    if not head.get("content-length", "").isdigit() or "warc-type" not in head:
        return "headers lack a type or a length"
    begin = top + len(END)
    end = begin + int(head["content-length"])
    if data[end : end + len(END)] != END:
        return "the block does not end where its length says"
    block = data[begin:end]
    named, _, value = head.get("warc-block-digest", "").partition(":")
    if named == "sha256" and hashlib.sha256(block).hexdigest() != value.lower():
        return "the block's digest differs"
    length, payload = len(block), block
    if head.get("content-type", "").startswith("application/http"):
        first, gap, payload = block.partition(END)
        length = len(payload)
        if head["warc-type"] == "revisit":
            length = int(_headers(first).get("content-length", "0") or 0)
    digest = hashlib.sha256(payload).hexdigest()
    if head["warc-type"] == "revisit":
        digest = head.get("warc-payload-digest", "").partition(":")[2].lower()
    return {
        "type": head["warc-type"],
        "record_id": head.get("warc-record-id", "").strip("<>"),
        "uri": head.get("warc-target-uri"),
        "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": payload,
    }, end + len(END)


def _member(data, at: int) -> tuple[bytes, int] | None:
    """What the gzip member at ``at`` holds and the place after it; None if its check fails."""
    unpack, parts, here = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof and here < len(data):
            parts.append(unpack.decompress(data[here : here + 65536]))
            here += 65536
    except zlib.error:
        return None
    return (b"".join(parts), min(here, len(data)) - len(unpack.unused_data)) if unpack.eof else None


def salvage(data: bytes) -> Iterator[dict]:
    """Records and quarantined gaps of an archive, in order; places and lengths are those in the file.

    After a failed check the search goes on one byte later for a gzip member or version line that holds a
    whole valid record; what lies between is one gap. A record of which the file has several valid copies
    is returned as often. A valid record inside the payload of a damaged one is recovered as well.
    """
    at, gap, reason = 0, -1, ""

    def lost(end: int) -> dict:
        return {"kind": "gap", "at": gap, "length": end - gap, "reason": reason}

    while at < len(data):
        held: list[dict] = []
        wrong, after = "no record begins here", at
        if data[at : at + 3] == GZIP:
            member = _member(data, at)
            if member is None:
                wrong = "the gzip member's check fails"
            else:
                inner = list(salvage(member[0])) if member[0][:3] != GZIP else []
                held = [x for x in inner if x["kind"] == "record"]
                bad = next((x["reason"] for x in inner if x["kind"] == "gap"), "" if held else "the member holds no record")
                after = member[1]
                held = [x | {"at": at, "length": after - at} for x in held]
                if bad:
                    held.append({"kind": "gap", "at": at, "length": after - at, "reason": bad})
        else:
            got = _record(data, at)
            if isinstance(got, str):
                wrong = got
            else:
                held, after = [got[0] | {"kind": "record", "at": at, "length": got[1] - at}], got[1]
        if held:
            if gap >= 0:
                yield lost(at)
                gap = -1
            yield from held
            at = after
            continue
        if gap < 0:
            gap, reason = at, wrong
        found = START.search(data, at + 1)
        at = found.start() if found else len(data)
    if gap >= 0:
        yield lost(len(data))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records (kind 'record') and gaps (kind 'gap') of all archives below ``path``; no files give no rows."""
    names = [field.split()[0] for field in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (f.split() for f in RECORD.split(","))])
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name, rows, held = path.as_py(), [], 0
                for row in salvage(content.as_py()):
                    rows.append({n: row.get(n) for n in names} | {"path": name})
                    held += len(row.get("payload") or b"")
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD)
