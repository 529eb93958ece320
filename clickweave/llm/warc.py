"""WARC archives by way of a chunked record table.

Payloads become rows of (record, chunk number) before they are written and after they are read. The writer walks over a
payload once to digest it and once to cut it, a chunk at a time, with the digest so far on every chunk; a long payload is written as
one ``response`` record and ``continuation`` records of bounded size (the segments of the WARC standard), of which the last has
length and digest of the whole. The reader walks over an archive as a stream, cutting chunks and updating the payload digest as bytes
come in. So beside the value that a table's row already holds, no step has more than some chunks of a record in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column, numbered

#: Bytes of a payload in one record at most (but at least one character).
CHUNK_BYTES = 64 * 1024
#: Bytes of chunks that the writer hands on at a time.
HELD_BYTES = 4 << 20
#: Revisits go to every executor up to this many; beyond, rows and revisits are joined by shuffle, payloads and all.
BROADCAST_ROWS = 500_000
#: Payloads of fewer bytes are never replaced by a revisit record.
REVISIT_BYTES = 100

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
END_OF_RECORD = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

CHUNK_SCHEMA = (
    "page_id bigint, record_type string, refers_to bigint, chunk int, start bigint, chunk_bytes bigint, "
    "digest_so_far string, payload_bytes bigint, payload_digest string, payload string"
)


def parts_of(payload: str | None, chunk_bytes: int) -> Iterator[tuple[int, bytes, str, bool]]:
    """Start, bytes, digest so far and whether it is the last, of the chunks of a payload; characters are not cut.

    An empty payload is one chunk without bytes.
    """
    text, digest, start = payload or "", hashlib.sha256(), 0
    # A character has four bytes at most, so this many fit into a chunk.
    step = max(1, chunk_bytes // 4)
    waiting, at = b"", 0
    while True:
        while at < len(text) and len(waiting) < chunk_bytes:
            waiting += text[at : at + step].encode(errors="replace")
            at += step
        end = min(chunk_bytes, len(waiting))
        while end < len(waiting) and end > 0 and waiting[end] & 0xC0 == 0x80:
            end -= 1
        if end == 0 < len(waiting):
            end = next((i for i in range(1, len(waiting)) if waiting[i] & 0xC0 != 0x80), len(waiting))
        part, waiting = waiting[:end], waiting[end:]
        digest.update(part)
        last = not waiting and at >= len(text)
        yield start, part, digest.hexdigest(), last
        start += len(part)
        if last:
            return


def payload_digest(payload: Column) -> Column:
    """Size and SHA-256 of each payload, digested chunk by chunk."""

    @F.pandas_udf("bytes bigint, digest string")
    def digests(payloads: pd.Series) -> pd.DataFrame:
        out = []
        for value in payloads:
            for start, part, digest, last in parts_of(value, CHUNK_BYTES):
                if last:
                    out.append((start + len(part), digest))
        return pd.DataFrame(out, columns=["bytes", "digest"])

    return digests(payload)


def records(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """One row per page: its payload, and for a page that repeats an earlier one what it revisits, and size and digest.

    A null payload is empty. Of equal payloads of at least ``REVISIT_BYTES`` bytes the smallest id is
    the response and all others are revisits of it; of rows that repeat that id too, each is a response. A null
    id never is the smallest unless all are null.

    Digests alone are grouped and joined to each other; payloads meet the list of revisits, which is broadcast up to
    ``BROADCAST_ROWS`` of them.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "warc-revisits")
    chosen = pages.select(
        column(pages, page_id).cast("bigint").alias("page_id"),
        (F.coalesce(column(pages, url), F.lit("")) if url in pages.columns else F.lit("")).alias("url"),
        column(pages, html).alias("payload"),
    )
    rows = numbered(chosen, "row", scratch)
    found = rows.select("row", "page_id", payload_digest(F.col("payload")).alias("p"))
    found = scratch.keep(found.select("row", "page_id", F.col("p.bytes").alias("payload_bytes"), F.col("p.digest").alias("payload_digest")))
    long_enough = found.where(F.col("payload_bytes") >= REVISIT_BYTES)
    firsts = (
        long_enough.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND refers_to IS NOT NULL")
        .drop("copies")
    )
    # Written first: Spark splits a skewed join only where both sides come straight from a shuffle.
    firsts = scratch.keep(firsts)
    again = long_enough.join(firsts, "payload_digest").where(~F.col("refers_to").eqNullSafe(F.col("page_id")))
    again = scratch.keep(again.select("row", "refers_to", "payload_bytes", "payload_digest"))
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    return rows.join(again, "row", "left").drop("row")


CHUNKS = (
    "page_id bigint, url string, refers_to bigint, chunk int, last boolean, start bigint, digest_so_far string,"
    " payload_bytes bigint, payload_digest string, payload string"
)


def chunks(recs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table: a row per ``chunk_bytes`` bytes of payload; empty payloads and revisits have one.

    ``payload_bytes`` and ``payload_digest`` are on the last chunk only, where they are known.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, held, size = [c.split()[0] for c in CHUNKS.split(", ")], [], 0

        def taken() -> pd.DataFrame:
            return pd.DataFrame(held, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

        for batch in batches:
            columns = (batch[c].astype(object).where(batch[c].notna(), None) for c in ("page_id", "url", "payload", "refers_to", "payload_bytes", "payload_digest"))
            for page, url, payload, refers, known, digest in zip(*columns):
                if refers is not None:
                    held.append((page, url, refers, 0, True, 0, None, known, digest, ""))
                    continue
                for n, (start, part, so_far, last) in enumerate(parts_of(payload, chunk_bytes)):
                    whole = (start + len(part), so_far) if last else (None, None)
                    held.append((page, url, None, n, last, start, so_far, *whole, part.decode()))
                    size += len(part)
                    if size >= HELD_BYTES:
                        yield taken()
                        held, size = [], 0
        if held:
            yield taken()

    return recs.select("page_id", "url", "payload", "refers_to", "payload_bytes", "payload_digest").mapInPandas(cut, CHUNKS)


def write_archives(table: DataFrame, path: str) -> None:
    """Write a chunked record table as gzipped WARC files, one WARC record a chunk.

    Spark's text writer ends every row with the two line ends that end a WARC record.
    """
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    address = F.regexp_replace(F.col("url"), r"\s", "%20")
    kind = (
        F.when(F.col("refers_to").isNotNull(), "revisit").when(F.col("chunk") == 0, "response").otherwise("continuation")
    )
    segmented = (F.col("chunk") > 0) | ~F.col("last")
    block = F.octet_length(F.col("payload"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(":"), F.col("chunk"), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.when(address != "", F.concat(F.lit("WARC-Target-URI: "), address)),
        # A field that is null is left out: length and digest are in the last segment of a record.
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes")),
        F.when(
            F.col("refers_to").isNotNull(),
            F.concat(
                F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(":0>")
            ),
        ),
        F.when(segmented, F.concat(F.lit("WARC-Segment-Number: "), F.col("chunk") + 1)),
        F.when(
            F.col("chunk") > 0, F.concat(F.lit("WARC-Segment-Origin-ID: <urn:page:"), page, F.lit(":0>"))
        ),
        F.when(
            segmented & F.col("last"),
            F.concat(F.lit("WARC-Segment-Total-Length: "), F.col("payload_bytes")),
        ),
        F.concat(F.lit("Content-Length: "), block),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), F.col("payload"))
    table.select(record.alias("value")).write.option("lineSep", END_OF_RECORD).option("compression", "gzip").text(path)


class ArchiveReader:
    """Walks over the bytes of one archive; ``feed`` takes the next bytes and yields finished chunk rows."""

    def __init__(self, chunk_bytes: int):
        self.chunk_bytes = chunk_bytes
        self.waiting = bytearray()
        self.fields: dict[str, str] | None = None
        self.left = 0
        self.origin: tuple | None = None
        self.digest = hashlib.sha256()
        self.start = self.chunk = 0

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.waiting += data
        at = 0
        while True:
            if self.fields is None:
                end = self.waiting.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self._open(self.waiting[at:end].decode())
                at = end + 4
            take = min(self.left, self.chunk_bytes)
            # The four bytes after a payload are its end; they are taken with its last part.
            if len(self.waiting) - at < take + (4 if take == self.left else 0):
                break
            part = bytes(self.waiting[at : at + take])
            at += take
            self.left -= take
            if self.left == 0:
                if self.waiting[at : at + 4] != b"\r\n\r\n":
                    raise ValueError("a WARC record does not end where its Content-Length says")
                at += 4
            yield self._row(part)
            if self.left == 0:
                self.fields = None
        del self.waiting[:at]

    def close(self) -> None:
        if self.waiting or self.fields is not None:
            raise ValueError("an archive ends within a record")

    def _open(self, head: str) -> None:
        version, *lines = head.split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        self.fields = dict(line.split(": ", 1) for line in lines)
        self.left = int(self.fields["Content-Length"])
        if self.fields["WARC-Type"] != "continuation":
            self.digest, self.start, self.chunk = hashlib.sha256(), 0, 0

    def _row(self, part: bytes) -> tuple:
        fields = self.fields
        page = fields["WARC-Record-ID"].split(":")[2]
        refers = fields.get("WARC-Refers-To")
        self.digest.update(part)
        row = (
            None if page == "null" else int(page),
            "revisit" if refers else "response",
            int(refers.split(":")[2]) if refers else None,
            self.chunk,
            self.start,
            len(part),
            self.digest.copy().hexdigest(),
            int(fields["X-Payload-Length"]) if "X-Payload-Length" in fields else None,
            fields["WARC-Payload-Digest"].removeprefix("sha256:") if "WARC-Payload-Digest" in fields else None,
            part,
        )
        self.chunk += 1
        self.start += len(part)
        return row


def _read_files(chunk_bytes: int, with_payload: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in CHUNK_SCHEMA.split(", ")]
        reader, current = None, None
        for batch in batches:
            out = []
            for name, lines in batch.groupby("file", sort=False).value:
                if name != current:
                    if reader is not None:
                        reader.close()
                    reader, current = ArchiveReader(chunk_bytes), name
                out += reader.feed(("\n".join(lines) + "\n").encode())
            frame = pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})
            if not with_payload:
                frame["payload"] = None
            yield frame
        if reader is not None:
            reader.close()

    return read


def read_archives(
    spark: SparkSession, path: str, chunk_bytes: int = 4 * CHUNK_BYTES, with_payload: bool = True
) -> DataFrame:
    """The chunked record table of gzipped archives: ``CHUNK_SCHEMA``, payloads as binary.

    A gzipped file is one split, so a task sees its lines in order. ``digest_so_far`` covers the payload up to
    and with the chunk; at the last chunk of a response it is the digest of all of it. An archive that is
    cut off or whose lengths are wrong raises an error. ``payload_bytes`` and ``payload_digest`` are null on the chunks of a record that
    is not the last segment of its payload.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    schema = CHUNK_SCHEMA.replace("payload string", "payload binary")
    return lines.mapInPandas(_read_files(chunk_bytes, with_payload), schema)


def read_records(table: DataFrame) -> DataFrame:
    """One row per page read back: its last chunk, whose running digest is checked against the header.

    The digest of a response is the one computed from the bytes read; a wrong one raises an error.
    """
    last = (F.col("record_type") == "revisit") | (F.col("start") + F.col("chunk_bytes") == F.col("payload_bytes"))
    sound = (F.col("record_type") == "revisit") | (F.col("digest_so_far") == F.col("payload_digest"))
    digest = F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.lit("payload digest differs")))
    return table.where(last).select(
        "page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to"
    )
