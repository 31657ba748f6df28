"""WARC archives: writing, normalising monolithic gzip files, reading by offset index.

An archive is first written as one gzip stream over all its records. The normaliser
inflates that stream once, rewrites every record as a gzip member of its own and writes a
sidecar index of offsets, so that single records can be read. Files live in the shared
folder; an attempt that is repeated writes new files, and only files named in the written
tables count.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from acoustic_spark.llm.common import join_counted, maybe_repeated, repeat_filter, shared_path, text_or_empty, written

#: Uncompressed bytes after which a writer begins the next archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
LEVEL = 4
#: URIs of record types, of the revisit profile, and the end of a record.
PAGE_URN = "urn:x-page:"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def assign_types(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """page_id, url, html, sha1, record_type, refers_to of every row.

    Of rows with equal payloads of `least` bytes or more, the one with the smallest page_id
    (nulls last, one of repeated rows) is the response, the others are revisits of it.
    Only rows whose digest two or more rows may have are shuffled.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text_or_empty(html).alias("html"))
    rows = rows.withColumns({"sha1": F.sha1(F.col("html").cast("binary")), "row": F.monotonically_increasing_id()})
    rows = written(rows, "hashed").withColumns({"h1": F.xxhash64("sha1"), "h2": F.xxhash64(F.lit(1), "sha1")})
    n_rows = rows.count()
    bitmaps = written(repeat_filter(rows.select("h1", "h2"), ["h1", "h2"], n_rows), "bitmaps")
    flagged = maybe_repeated(rows, bitmaps, ["h1", "h2"], n_rows, "flag")
    flagged = flagged.drop("h1", "h2").withColumn("flag", F.col("flag") & (F.octet_length("html") >= least))
    none = F.lit(None).cast("long")
    single = flagged.where(~F.col("flag")).drop("flag", "row").withColumns({"record_type": F.lit("response"), "refers_to": none})

    many = flagged.where("flag").drop("flag")
    many = many.withColumn("order", F.struct(F.col("page_id").isNull().alias("last"), F.col("page_id").alias("id"), "row")).drop("row")
    groups = many.groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("best"))
    joined = join_counted(many, groups, "sha1", "n", n_rows)
    first = F.col("order") == F.col("best")
    joined = joined.withColumns({"record_type": F.when(first, "response").otherwise("revisit"), "refers_to": F.when(~first, F.col("best.id"))})
    return single.unionByName(joined.select(single.columns))


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _header(fields: list[tuple[str, str]], first: str) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def page_urn(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    number = urn.strip("<>").removeprefix(PAGE_URN) if urn else ""
    return int(number) if number else None


def safe_url(url: str) -> str:
    """The URL with control characters, spaces and non-ASCII as percent escapes, so it fits a header line."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, record_type: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record. A revisit holds only the HTTP head, which tells the payload's length."""
    head = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = head if record_type == "revisit" else head + payload
    fields = [("WARC-Type", record_type), ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", safe_url(url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base32(sha1_hex)}"))
    if record_type == "revisit":
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", page_urn(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields, "WARC/1.1") + block + END


def info_record(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    return _header(fields, "WARC/1.1") + block + END


def write_archives(rows: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes rows of `assign_types` as monolithic gzip archives; a written table of their paths and record counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_folder(folder)
        fs.create_dir(root, recursive=True)
        out = gz = path = None
        size = n = 0
        done = []
        for batch in batches:
            ids = [None if pd.isna(v) else int(v) for v in batch["page_id"]]
            to = [None if pd.isna(v) else int(v) for v in batch["refers_to"]]
            for i, url, html, sha1, kind, refers in zip(ids, batch["url"], batch["html"], batch["sha1"], batch["record_type"], to):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, gz, size, n = fs.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                    out.write(gz.compress(info_record(date)))
                data = record(i, url, html.encode(), sha1, kind, refers, date)
                out.write(gz.compress(data))
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.write(gz.flush())
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((path, n))
        yield pd.DataFrame(done, columns=["archive", "records"])

    return written(rows.select("page_id", "url", "html", "sha1", "record_type", "refers_to").mapInPandas(run, "archive string, records long"), "archives")


class Inflated:
    """A gzip file, of one member or many, as a stream of plain bytes, read once from start to end."""

    def __init__(self, source):
        self.source, self.z, self.plain = source, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        """Inflates up to CHUNK bytes more; False at the end of the file."""
        while True:
            if self.z.eof:
                data = self.z.unused_data or self.source.read(CHUNK)
                if not data:
                    return False
                self.z = zlib.decompressobj(31)
            else:
                data = self.z.unconsumed_tail or self.source.read(CHUNK)
                if not data:
                    raise ValueError("archive ends within a gzip member")
            got = self.z.decompress(data, CHUNK)
            if got:
                self.plain += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with `mark`, however many; None at the end of the stream."""
        at = self.plain.find(mark)
        while at < 0:
            seen = max(0, len(self.plain) - len(mark))
            if not self._more():
                if self.plain:
                    raise ValueError("archive ends within a record head")
                return None
            at = self.plain.find(mark, seen)
        out = bytes(self.plain[: at + len(mark)])
        del self.plain[: at + len(mark)]
        return out

    def blocks(self, n: int) -> Iterator[bytes]:
        """The next n bytes in pieces."""
        while n:
            if not self.plain and not self._more():
                raise ValueError("archive ends within a record")
            piece = bytes(self.plain[:n])
            del self.plain[:n]
            n -= len(piece)
            yield piece


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def _put(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def normalise_archive(fs: pafs.FileSystem, path: str) -> tuple[str, str, int]:
    """Rewrites one archive with a gzip member per record; paths of the new archive and of its index, and the records."""
    name = f"{path.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.members.warc.gz"
    index = f"{name}.idx"
    offset = n = 0
    with fs.open_input_stream(path, compression=None) as source, fs.open_output_stream(name, compression=None) as out, fs.open_output_stream(index) as side:
        stream = Inflated(source)
        while (head := stream.until(END)) is not None:
            fields = fields_of(head)
            gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            length = _put(out, gz.compress(head))
            for piece in stream.blocks(int(fields["content-length"])):
                length += _put(out, gz.compress(piece))
            if b"".join(stream.blocks(len(END))) != END:
                raise ValueError(f"record {n} of {path} does not end as it should")
            length += _put(out, gz.compress(END) + gz.flush())
            line = {"id": fields.get("warc-record-id"), "type": fields.get("warc-type"), "offset": offset, "length": length}
            side.write((json.dumps(line) + "\n").encode())
            offset, n = offset + length, n + 1
    return name, index, n


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """A written table (archive, index, records) of normalised archives, one row per archive of `archives`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = open_folder(folder)
        for batch in batches:
            yield pd.DataFrame([normalise_archive(fs, p) for p in batch["archive"]], columns=["archive", "index", "records"])

    spread = archives.repartition(max(1, archives.count()), "archive")
    return written(spread.mapInPandas(run, "archive string, index string, records long"), "normalised")


RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def parse_record(data: bytes, with_payload: bool) -> tuple:
    head, _, block = data.partition(END)
    fields = fields_of(head)
    kind = fields["warc-type"]
    http, _, payload = block[: int(fields["content-length"])].partition(END)
    if kind == "revisit":
        size, digest, payload = int(fields_of(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:"), None
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    url = fields.get("warc-target-uri")
    return page_of(fields["warc-record-id"]), url, payload if with_payload else None, size, digest, kind, page_of(fields.get("warc-refers-to"))


def read_records(normalised: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The response and revisit records of normalised archives, each read at its offset of the sidecar index.

    A response's length and digest are taken from its payload, a revisit's from its headers.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = open_folder(folder)
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for archive, index in zip(batch["archive"], batch["index"]):
                with fs.open_input_stream(index) as side:
                    entries = [json.loads(line) for line in side.read().decode().splitlines()]
                rows, size = [], 0
                with fs.open_input_file(archive) as source:
                    for e in entries:
                        if e["type"] in ("response", "revisit"):
                            source.seek(e["offset"])
                            rows.append(parse_record(zlib.decompress(source.read(e["length"]), 31), with_payload))
                            size += len(rows[-1][2] or b"") + 200
                        if size > 8 * CHUNK:
                            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows, size = [], 0
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return normalised.repartition(max(1, normalised.count()), "archive").mapInPandas(run, RECORDS)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Pages written as WARC, normalised, and read back: one row per row of `pages`.

    A null html is an empty payload, a null url has no target URI, a null page_id gives a
    record without a number. Equal payloads, empty ones too, become revisits of the smallest
    page_id; of rows that repeat a page_id one stays a response. Other columns are not kept;
    an empty table gives an empty result.
    """
    folder = shared_path(pages.sparkSession, "warc")
    archives = write_archives(assign_types(pages, page_id, url, html, least), folder)
    return read_records(normalise(archives, folder), folder)
