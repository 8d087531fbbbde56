"""Web archives with deduplicated payloads, and their index merged from sorted runs.

Every task writes its records into an archive of its own and sorts its captures by URL key and time:
a run. A sample of the keys cuts the index into ranges of about equal size; the pieces of all runs
that belong to one range are merged by a loser tree. The ranges in order are the history of all
captures, and lead back to every record by file and place.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from streamweir.llm.files import Folder
from streamweir.llm.tables import Workspace, quoted

LEAST_REVISIT = 100
CAPTURE = "url_key STRING, stamp LONG, page_id LONG, file STRING, at LONG, length LONG"
KEY = ["url_key", "stamp", "page_id"]
RECORD = (
    "url_key STRING, stamp LONG, page_id LONG, record_type STRING, refers_to LONG, payload_bytes LONG, "
    "payload_digest STRING, url STRING, payload BINARY, at_range INT, at_place LONG"
)


def url_key(url: str | None) -> str:
    """Host from right to left, then path and query, lower-cased, so that a site's captures stand together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = re.sub(r"^www\d*\.", "", (parts.hostname or "").lower())
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/").lower() + ("?" + parts.query.lower() if parts.query else "")


# --- records ----------------------------------------------------------------------------


def record(kind: str, page_id, url: str | None, date: str, digest: str, size: int, payload: bytes, refers_to) -> bytes:
    """One gzip member with one record; a revisit has no payload but says its digest and size."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=''.join(map(chr, range(33, 127))))}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http)
    return data + packer.compress(payload) + packer.compress(b"\r\n\r\n") + packer.flush()


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(urn: str | None) -> int | None:
    found = re.search(r"urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    data = zlib.decompress(member, 31)
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].split(b"\r\n\r\n", 1)[1]


# --- merging ----------------------------------------------------------------------------


def loser_tree(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Sorted runs as one sorted sequence: each node keeps the loser of its match, the winner goes up.

    After a row has left, only the matches on its run's way to the top are played again. Equal
    rows come in the order of their runs.
    """
    k = len(runs)
    heads = [next(r, None) for r in runs]

    def beats(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        return x is not None and (y is None or x < y or (x == y and a < b))

    losers = [-1] * max(1, k)

    def play(node: int) -> int:
        """Winner below the node; leaves are the numbers from k on."""
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        losers[node], winner = (b, a) if beats(a, b) else (a, b)
        return winner

    winner = play(1) if k > 1 else 0
    while k and heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


# --- operators --------------------------------------------------------------------------


def typed(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, stamp, payload`` plus payload_bytes, payload_digest, record_type and refers_to.

    Digests are counted before they are joined back, so a payload that a third of the pages share is a row
    per task in that count, and on the way back adaptive execution splits it.
    """
    rows = pages.select("page_id", "url", "stamp", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    again = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = again.where("n > 1").select(F.col("payload_digest").alias("digest"), "first")
    met = rows.join(again, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("payload_bytes") >= least)
    return met.select(
        *rows.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
    )


def archived(
    pages: DataFrame, work: Workspace, id: str = "page_id", url: str = "url", html: str = "html", stamp: Column | None = None,
) -> DataFrame:
    """Writes a record per page; returns the captures (url_key, stamp, page_id, file, at, length), each task's sorted.

    The payload is the text in UTF-8, empty for null. Of equal payloads of at least 100 bytes that with the smallest
    id is a response, the others revisit it (equal ids are all responses; a page without an id revisits, and is
    revisited only by name of another). ``stamp`` is the time of capture in seconds (default: the id). Null URLs
    have the empty key. One archive per task, in the shared folder; a page at a time in memory.
    """
    folder = Folder(work.path)
    stamp = F.coalesce(quoted(id), F.lit(0)).cast("long") if stamp is None else stamp
    rows = typed(pages.select(
        quoted(id).cast("long").alias("page_id"), quoted(url).alias("url"), stamp.alias("stamp"),
        F.encode(F.coalesce(quoted(html), F.lit("")), "UTF-8").alias("payload"),
    ))
    dated = rows.withColumn("date", F.date_format(F.timestamp_seconds(F.col("stamp")), "yyyy-MM-dd'T'HH:mm:ss'Z'"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, out, at = None, None, 0
        for batch in batches:
            if out is None:
                name = folder.new_name("archive/pages", ".warc.gz")
                out = folder.create(name)
            captures = []
            for page, link, when, payload, size, digest, kind, refers, date in zip(*(
                batch[c] for c in ("page_id", "url", "stamp", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "date")
            )):
                page, refers = (None if pd.isna(x) else int(x) for x in (page, refers))
                data = record(kind, page, link, date, digest, size, payload if kind == "response" else b"", refers)
                out.write(data)
                captures.append((url_key(link), when, page, name, at, len(data)))
                at += len(data)
            yield pd.DataFrame(captures, columns=[c.split()[0] for c in CAPTURE.split(", ")]).astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    return work.keep(dated.mapInPandas(write, CAPTURE))


def merged(captures: DataFrame, range_rows: int = 200_000, sample: int = 8192) -> DataFrame:
    """The captures in one order: ``at_range`` and ``at_place`` number them by URL key, time and id.

    Ranges hold about ``range_rows`` captures, fewer if that would leave cores idle; their bounds are quantiles of a
    sample of about ``sample`` keys, whose time and id part the captures of one URL as well. A range is merged by
    one task from the pieces that the runs have of it.
    """
    spark = captures.sparkSession
    n = captures.count()
    cores = spark.sparkContext.defaultParallelism
    ranges = max(1, -(-n // range_rows), min(4 * cores, n >> 8))
    drawn = captures.where(F.pmod(F.xxhash64(*KEY, "file", "at"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, n))))
    keys = sorted(_ordered(tuple(r)) for r in drawn.select(*KEY).collect())
    bounds = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    names = [c.split()[0] for c in CAPTURE.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, piece = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = [_ordered(k) for k in zip(*(batch.column(c).to_pylist() for c in KEY))]
            start = 0
            out = []
            while start < len(rows):
                at = bisect_right(bounds, rows[start])
                end = len(rows) if at == len(bounds) else bisect_right(rows, bounds[at], start)
                while at < len(bounds) and end > start and rows[end - 1] >= bounds[at]:
                    end -= 1  # the bound itself belongs to the next range
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch.slice(start, end - start))
                out.append((at, run, piece, sink.getvalue()))
                piece, start = piece + 1, end
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["at_range", "run", "piece", "rows"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        def rows(pieces: pd.DataFrame) -> Iterator[tuple]:
            for data in pieces.sort_values("piece")["rows"]:
                table = pa.ipc.open_stream(data).read_all()
                columns = [table.column(c).to_pylist() for c in names]
                for row in zip(*columns):
                    yield (*_ordered(row[:3]), row)

        runs = [rows(pieces) for _, pieces in group.groupby("run")]
        out = pd.DataFrame((r[-1] for r in loser_tree(runs)), columns=names).astype({"page_id": "Int64"})
        return out.assign(at_range=group["at_range"].iloc[0], at_place=range(len(out)))

    runs = captures.sortWithinPartitions(*KEY)
    pieces = runs.mapInArrow(cut, "at_range INT, run INT, piece INT, rows BINARY")
    return pieces.groupBy("at_range").applyInPandas(merge, f"{CAPTURE}, at_range INT, at_place LONG")


def _ordered(key: tuple) -> tuple:
    """Nulls first, as Spark sorts."""
    return key[0].encode(), key[1], key[2] is not None, key[2] or 0


def read_back(index: DataFrame, work: Workspace, with_payload: bool = True) -> DataFrame:
    """Every capture's record, read from its archive at its place; payloads are checked against their digests."""
    folder = Folder(work.path)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, file = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.file != name:
                    name, file = row.file, folder.open(row.file)
                file.seek(row.at)
                fields, payload = parsed(file.read(row.length))
                digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
                if fields["WARC-Type"] == "response":
                    size, said = len(payload), digest
                    digest = hashlib.sha256(payload).hexdigest()
                    if digest != said:
                        raise ValueError(f"{row.file} is damaged at {row.at}")
                out.append((
                    row.url_key, row.stamp, _number(fields["WARC-Record-ID"]), fields["WARC-Type"], _number(fields.get("WARC-Refers-To")), size, digest,
                    fields["WARC-Target-URI"], payload if with_payload else None, row.at_range, row.at_place,
                ))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RECORD.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = index.repartition("file", F.floor(F.col("at") / (1 << 22))).sortWithinPartitions("file", "at")
    return files.mapInPandas(fetch, RECORD)
