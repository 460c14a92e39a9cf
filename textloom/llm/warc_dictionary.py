"""Dictionary-compressed WARC archives (dealt operator 5).

Every archive starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary
trained on the archive's own first records; each record is then one Zstandard frame that
needs nothing but this dictionary, so any of them can be read by its offset. Payloads of at
least ``REVISIT_BYTES`` that occur more than once are stored once, with the largest id; the other
records are revisits that name it and repeat the digest and, in the stored HTTP header, the length.

Equal payloads are found on (id, SHA-256, length) rows alone; ids of copies are joined back to the
pages by id, so a payload with very many copies is no hot key for the rows that carry text.
Tasks write files of about ``ARCHIVE_BYTES`` to the shared folder under names no other attempt uses; the
manifest, written by Spark, lists those of the attempts that counted, so lost executors
leave only files that nobody reads.

The dictionary is trained on slices of ``SLICE_BYTES`` of an archive's first records, ``SAMPLE_BYTES`` of them in all, a documented bound; archives of
less than ``LEAST_RECORDS`` records have no dictionary frame. Defined results: null html is an empty payload; a null url leaves the
target header out; repeated rows of one id and payload are archived each, with the same type; rows
without an id are always responses; empty tables give no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import open_file, put_file, shuffle_partitions, split_by_ids

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES = 1 << 20
SAMPLE_RECORDS = 512
SLICE_BYTES = 16 << 10
LEAST_RECORDS = 8
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Frame magics, the revisit profile, the date every record carries.
SKIPPABLE_MAGIC = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _header_value(v: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", v)


def _record(kind: str, name: str, url: str | None, block: bytes, extra: list[tuple[str, str]], content: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _header_value(url)))
    head += [*extra, ("Content-Type", content), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """The response or, with ``refers_to``, the revisit record of a page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    extra = [("WARC-Payload-Digest", f"sha1:{digest}")]
    name = f"urn:page:{'' if page_id is None else _header_value(page_id)}"
    if refers_to is None:
        return _record("response", name, url, http + payload, extra, "application/http; msgtype=response")
    extra += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{_header_value(refers_to)}>")]
    return _record("revisit", name, url, http, extra, "application/http; msgtype=response")


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of slices of the records (the first ``SLICE_BYTES`` of each, so that a few large ones don't fill the sample); none for less than ``LEAST_RECORDS``."""
    slices = [r[:SLICE_BYTES] for r in records]
    if len(records) < LEAST_RECORDS:
        return None
    size = max(256, min(DICTIONARY_BYTES, sum(map(len, slices)) // 8))
    try:
        trained = zstandard.train_dictionary(size, slices, k=512, d=8)
    except zstandard.ZstdError:  # slices too short or too alike for the trainer: what they begin with is the content
        trained = None
    if trained is None or not trained.as_bytes().startswith(DICTIONARY_MAGIC):
        return _from_content(slices, size)
    return trained


def _from_content(slices: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from samples that are too few or too alike as they stand: they are repeated with their number before each."""
    many = [b"%d " % i + r for i in range(64) for r in slices]
    for k in (512, 64, 16):
        try:
            trained = zstandard.train_dictionary(max(size, 1024), many, k=k, d=8)
        except zstandard.ZstdError:
            continue
        if trained.as_bytes().startswith(DICTIONARY_MAGIC):
            return trained
    return None


def archive(records: Iterator[bytes], limit: int = ARCHIVE_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """``(chunks, records)`` of archives of about ``limit`` bytes."""
    records, more = iter(records), True
    while more:
        sample, size, more = [], 0, False
        for r in records:
            sample.append(r)
            size += min(len(r), SLICE_BYTES)
            if size >= SAMPLE_BYTES or len(sample) >= SAMPLE_RECORDS or (len(sample) >= LEAST_RECORDS and sum(map(len, sample)) >= limit):
                more = True
                break
        if not sample:
            return
        dictionary = train(sample)
        chunks = []
        if dictionary is not None:
            raw = dictionary.as_bytes()
            chunks.append(struct.pack("<II", SKIPPABLE_MAGIC, len(raw)) + raw)
            dictionary.precompute_compress(level=LEVEL)
            press = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        else:
            press = zstandard.ZstdCompressor(level=LEVEL)
        info = _record("warcinfo", f"urn:uuid:{uuid.uuid4()}", None, b"format: WARC File Format 1.1\r\n", [], "application/warc-fields")
        chunks += [press.compress(info), *(press.compress(r) for r in sample)]
        size, n = sum(map(len, chunks)), len(sample)
        if more:
            more = False
            for r in records:
                chunks.append(press.compress(r))
                size += len(chunks[-1])
                n += 1
                if size >= limit:
                    more = True
                    break
        yield chunks, n


def frames(raw: memoryview) -> Iterator[memoryview]:
    """The Zstandard frames of an archive, skippable ones too, by their headers alone."""
    at = 0
    while at < len(raw):
        begin, magic = at, struct.unpack_from("<I", raw, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", raw, at + 4)[0]
        else:
            head = bytes(raw[at : at + 18])
            at += zstandard.frame_header_size(head)
            last = 0
            while not last:
                h = int.from_bytes(raw[at : at + 3], "little")
                last, kind = h & 1, (h >> 1) & 3
                at += 3 + (1 if kind == 1 else h >> 3)
            at += 4 * zstandard.get_frame_parameters(head).has_checksum
        yield raw[begin:at]


def read_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of every record of an archive."""
    press = zstandard.ZstdDecompressor()
    for k, frame in enumerate(frames(memoryview(raw))):
        if struct.unpack_from("<I", frame)[0] & 0xFFFFFFF0 == 0x184D2A50:
            if k == 0 and struct.unpack_from("<I", frame)[0] == SKIPPABLE_MAGIC:
                press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(frame[8:])))
            continue
        record = press.decompress(frame)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _page_id(name: str) -> str | None:
    from urllib.parse import unquote

    return unquote(name[len("<urn:page:") : -1]) or None


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write WARC archives of all rows to ``folder`` (a path or URI that all workers reach; a scratch folder where none
    is given); returns the manifest ``(path, records, bytes)``."""
    spark = pages.sparkSession
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    key = F.sha2("html", 256)
    keys = p.select("page_id", F.octet_length("html").alias("n"), key.alias("key")).filter((F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
    copies = keys.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("least < refers_to").select("key", "refers_to")
    revisits = materialize(keys.join(copies, "key").filter("page_id < refers_to").select("page_id", "key", "refers_to").distinct(), "warc-revisits")
    # by id and payload: one id can stand with several payloads. Pages that are certainly no revisit are not shuffled
    outside, inside = split_by_ids(p, "page_id", revisits, "page_id")
    again = inside.withColumn("key", key).join(revisits, ["page_id", "key"], "left").select("page_id", "url", "html", "refers_to")
    known = outside.withColumn("refers_to", F.lit(None).cast(p.schema["page_id"].dataType)).unionByName(again)
    known = known.select(F.col("page_id").cast("string"), "url", F.col("html").cast("binary"), F.col("refers_to").cast("string"))
    folder = folder or scratch_path(spark, "warc")

    def run(batches):
        def records():
            for b in batches:
                yield from map(page_record, *(b.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")))

        attempt = uuid.uuid4().hex
        for i, (chunks, n) in enumerate(archive(records())):
            path = f"{folder}/pages-{attempt}-{i:05d}.warc.zst"
            size = put_file(path, chunks)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [size]})

    return materialize(known.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all records, ids as strings; payload digests are checked."""

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                with open_file(path) as f:
                    raw = f.read()
                out = []
                for fields, block in read_records(raw):
                    kind = fields["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} doesn't match its digest")
                    refers = fields.get("WARC-Refers-To")
                    out.append((_page_id(fields["WARC-Record-ID"]), size, digest, kind, _page_id(refers) if refers else None))
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    spread = manifest.select("path").repartition(shuffle_partitions(manifest.sparkSession))
    return spread.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write the archives, read them back; ids in the table's own type."""
    kind = pages.schema[id_col].dataType
    back = read_archives(write_archives(pages, id_col))
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
