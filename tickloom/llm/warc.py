"""WARC archives with a two-level capture index.

Records are gzip members of archive files. The index sorts captures by reversed-host key
into compressed blocks; a sparse directory holds the first key of each block and a top
level the first key of each index file. Looking a capture up takes two binary searches,
one range read of a block and one range read of the record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

# What the WARC standard prescribes.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 1 << 30  # an archive file is closed beyond this size
BLOCK_ROWS = 1_000  # captures in a block
INDEX_ROWS = 2_000_000  # captures in an index file, about
HANDLES = 32  # open archive files of a reader


# --- keys -----------------------------------------------------------------------


def reversed_host_key(url: Column) -> Column:
    """``com,example,www)/path?query``: host labels reversed, so a domain's captures are together."""
    text = F.coalesce(url, F.lit(""))
    pattern = r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)([^#]*)"
    name = F.lower(F.regexp_extract(text, pattern, 1))
    rest = F.regexp_extract(text, pattern, 2)
    turned = F.array_join(F.reverse(F.split(name, r"\.")), ",")
    return F.when(name == "", text).otherwise(F.concat(turned, F.lit(")"), rest))


def capture_key(url: Column, page: Column) -> Column:
    """The sort key: reversed-host key, then the page id at fixed width (a NULL id first)."""
    shifted = page.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    number = F.coalesce(F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit("-"))
    return F.concat(F.translate(reversed_host_key(url), "\n\r\t", "   "), F.lit(" "), number)


# --- records --------------------------------------------------------------------


def _sha1_base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(
    page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One WARC record as a gzip member; with ``refers_to`` it is a revisit without payload."""
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) or "urn:x-none"
    head = [
        _VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{_sha1_base32(digest)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[-2:-2] = [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return gzip.compress(
        "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=6, mtime=0
    )


def parse(member: bytes) -> dict:
    """A record's type, page id, referred page id, payload length and digest, and payload."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != _VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sent = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])

    def page(name: str) -> int | None:
        number = fields.get(name, "")[len("<urn:x-page:") : -1]
        return int(number) if number else None

    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (
        hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(sent["Content-Length"])
    ):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    return {
        "page_id": page("WARC-Record-ID"),
        "payload_bytes": int(sent["Content-Length"]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }


# --- writing --------------------------------------------------------------------


def with_responses(
    pages: DataFrame, min_bytes: int, id_col: str, url_col: str, payload_col: str
) -> DataFrame:
    """Pages with payload digest and, for revisits, the page whose record holds the payload.

    Of equal payloads of at least ``min_bytes`` the largest id holds it. The groups are
    added up before the shuffle; in the join back the pages are the side Spark can split.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    base = pages.select(
        F.col(id_col).cast("long").alias("_page"),
        F.coalesce(F.col(url_col), F.lit("")).alias("_url"),
        payload.alias("_payload"),
        F.sha1(payload.cast("binary")).alias("_digest"),
        F.when(F.octet_length(payload) >= min_bytes, F.sha2(payload, 256)).alias("_same"),
    )
    groups = (
        base.where(F.col("_same").isNotNull())
        .groupBy(F.col("_same").alias("_group"))
        .agg(F.max("_page").alias("_largest"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = base.join(groups, F.col("_same") == F.col("_group"), "left")
    is_largest = F.col("_page").eqNullSafe(F.col("_largest"))
    return joined.select(
        "_page", "_url", "_payload", "_digest",
        F.when(~is_largest, F.col("_largest")).alias("_refers_to"),
        capture_key(F.col("_url"), F.col("_page")).alias("_key"),
    )


def write_archives(records: DataFrame, root: str) -> DataFrame:
    """Write the records to archive files below ``root``; where each one lies (stored).

    A task names its files anew at each attempt and reports them in its rows, so the
    files of a lost or repeated attempt are never referred to.
    """

    def make():
        fs, inner = common.filesystem(f"{root}/archive")
        fs.create_dir(inner, recursive=True)
        state: dict = {"out": None, "name": None, "at": 0}

        def close():
            if state["out"] is not None:
                state["out"].close()
                state["out"] = None

        def fn(batch):
            if batch is None:
                close()
                return
            names, offsets, sizes = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("_page", "_url", "_digest", "_refers_to")]
            payloads = common.texts(batch, "_payload")
            for (page, url, digest, refers_to), payload in zip(zip(*columns), payloads):
                if state["out"] is None or state["at"] >= ARCHIVE_BYTES:
                    close()
                    state["name"], state["at"] = f"{uuid.uuid4().hex}.warc.gz", 0
                    state["out"] = fs.open_output_stream(
                        f"{inner}/{state['name']}", compression=None
                    )
                member = record(page, url, payload, digest, refers_to)
                state["out"].write(member)
                names.append(state["name"])
                offsets.append(state["at"])
                sizes.append(len(member))
                state["at"] += len(member)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(names), pa.array(offsets), pa.array(sizes)],
                names=["key", "file", "offset", "size"],
            )

        return fn

    schema = "key string, file string, offset long, size long"
    return common.stored(
        common.map_batches(records, make, schema, finish=True, rows=64), "captures"
    )


def build_index(captures: DataFrame, root: str) -> None:
    """Sort the captures into index files of compressed blocks and write both directory levels."""
    files = max(1, -(-captures.count() // INDEX_ROWS), _slots(captures))
    ordered = captures.repartitionByRange(files, "key").sortWithinPartitions("key", "file", "offset")

    def make():
        rows: list[str] = []
        directory: list[list] = []
        name = uuid.uuid4().hex
        fs, inner = common.filesystem(f"{root}/index")
        fs.create_dir(inner, recursive=True)
        out = {"file": None, "at": 0}

        def block():
            data = zlib.compress("\n".join(rows).encode(), 6)
            if out["file"] is None:
                out["file"] = fs.open_output_stream(f"{inner}/{name}.blocks", compression=None)
            out["file"].write(data)
            directory.append([rows[0].split("\t", 1)[0], out["at"], len(data)])
            out["at"] += len(data)
            rows.clear()

        def fn(batch):
            if batch is not None:
                columns = [batch.column(c).to_pylist() for c in ("key", "file", "offset", "size")]
                for row in zip(*columns):
                    rows.append("\t".join(map(str, row)))
                    if len(rows) == BLOCK_ROWS:
                        block()
                return
            if rows:
                block()
            if out["file"] is None:
                return
            out["file"].close()
            with fs.open_output_stream(f"{inner}/{name}.directory", compression=None) as f:
                f.write(json.dumps(directory).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([directory[0][0]]), pa.array([name])], names=["first_key", "name"]
            )

        return fn

    top = common.map_batches(ordered, make, "first_key string, name string", finish=True)
    top.write.parquet(f"{root}/top")


def _slots(df: DataFrame) -> int:
    return min(df.sparkSession.sparkContext.defaultParallelism, 64)


# --- reading --------------------------------------------------------------------


class Index:
    """Reader of an index; holds the top level, one directory and one block at a time."""

    def __init__(self, root: str):
        self.fs, self.inner = common.filesystem(root)
        rows = []
        for info in self.fs.get_file_info(pa.fs.FileSelector(f"{self.inner}/top", allow_not_found=True)):
            if info.path.endswith(".parquet"):
                with self.fs.open_input_file(info.path) as f:
                    rows += pq.ParquetFile(f).read().to_pylist()
        rows.sort(key=lambda r: r["first_key"].encode())
        self.first = [r["first_key"].encode() for r in rows]
        self.names = [r["name"] for r in rows]
        self.number, self.directory, self.starts = -1, [], []
        self.at, self.lines, self.keys = (-1, -1), [], []
        self.handles: OrderedDict[str, pa.NativeFile] = OrderedDict()

    def _open(self, path: str) -> pa.NativeFile:
        if path not in self.handles:
            self.handles[path] = self.fs.open_input_file(path)
            if len(self.handles) > HANDLES:
                self.handles.popitem(last=False)[1].close()
        self.handles.move_to_end(path)
        return self.handles[path]

    def _range(self, path: str, offset: int, size: int) -> bytes:
        f = self._open(path)
        f.seek(offset)
        return f.read(size)

    def _file(self, number: int) -> None:
        if number != self.number:
            with self.fs.open_input_file(f"{self.inner}/index/{self.names[number]}.directory") as f:
                self.directory = json.loads(f.read())
            self.starts = [row[0].encode() for row in self.directory]
            self.number = number

    def _block(self, number: int, block: int) -> None:
        if self.at != (number, block):
            _, offset, size = self.directory[block]
            data = self._range(f"{self.inner}/index/{self.names[number]}.blocks", offset, size)
            self.lines = zlib.decompress(data).split(b"\n")
            self.keys = [line.split(b"\t", 1)[0] for line in self.lines]
            self.at = (number, block)

    def lookup(self, key: bytes) -> list[tuple[str, int, int]]:
        """Archive file, offset and size of each capture with this key."""
        number = bisect_right(self.first, key) - 1
        if number < 0:
            return []
        self._file(number)
        block = max(bisect_left(self.starts, key) - 1, 0)
        found = []
        while block < len(self.starts) and self.starts[block] <= key:
            self._block(number, block)
            for line in self.lines[bisect_left(self.keys, key) : bisect_right(self.keys, key)]:
                _, file, offset, size = line.decode().rsplit("\t", 3)
                found.append((file, int(offset), int(size)))
            block += 1
        return found

    def read(self, file: str, offset: int, size: int) -> dict:
        return parse(self._range(f"{self.inner}/archive/{file}", offset, size))


def read_back(lookups: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """The records of the wanted keys (column ``key``, distinct), read through the index.

    The keys are dealt by range and sorted, so a task goes through neighbouring blocks;
    the records of a batch are read in the order in which they lie in the archives.
    """
    parts = max(lookups.sparkSession.sparkContext.defaultParallelism * 2, 1)
    ordered = lookups.repartitionByRange(parts, "key").sortWithinPartitions("key")
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )

    def make():
        index = Index(root)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        n = 5 + with_payload

        def fn(batch):
            places = [p for key in batch.column("key").to_pylist() for p in index.lookup(key.encode())]
            records = [index.read(*p) for p in sorted(places)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in records], t) for c, t in zip(names[:n], types)],
                names=names[:n],
            )

        return fn

    return common.map_batches(ordered, make, schema + ", payload binary" * with_payload)


def archive_round_trip(
    pages: DataFrame,
    root: str,
    min_bytes: int = 1000,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Write a WARC record per page, index the archives, and read every page back through it.

    Returns per page: page_id, payload_bytes, payload_digest, record_type, refers_to. A
    NULL payload or URL is empty; of equal payloads of at least ``min_bytes`` bytes the
    largest id is the response (rows that repeat that id with that payload are all
    responses, as is a payload that only NULL ids have), the others are revisits. An
    empty table gives no rows; further columns are ignored.
    """
    records = with_responses(pages, min_bytes, id_col, url_col, payload_col)
    build_index(write_archives(records, root), root)
    url, page = F.coalesce(F.col(url_col), F.lit("")), F.col(id_col).cast("long")
    return read_back(pages.select(capture_key(url, page).alias("key")).distinct(), root)
