"""WARC derivatives: each response record gives a linked metadata record and a plain-text conversion record.

A record is a row: `warc_type`, `record_id`, `target_uri`, `warc_date`, `headers` (all named fields, in a map) and `block`
(bytes); a field that a record repeats has its values on lines of its own in the map.  Derivatives name the response in
WARC-Refers-To, repeat its target and date, carry digests of their own blocks, and preserve its headers: every WARC field as
it is where it also holds for them (`SHARED`), else under WARC-Source-; the metadata record lists every HTTP field, in order
and with repeats.  Their ids follow from the response's id, so a second run, or a task that runs
again, makes the same records.

`responses` wraps fetched pages as response records, `derive` builds the derivatives in one pass over the responses without
a shuffle, `write` lays records out in gzip files of the output folder through Spark's own writer, and `read` gets records
back from WARC files.

Edge cases: a NULL page is an empty one; a response without an HTTP header has an empty one and its whole block as the
payload; a NULL record_id gives derivatives that refer to nothing and ids from the block's digest; a payload digest in the
response is carried over even if it is wrong, and `payload_intact` says so (NULL without one); repeated rows give repeated
records; records other than responses are passed over; other columns are not looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import html as entities
import io
import re
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import common, main_text

VERSION = "WARC/1.1"
RECORD = "warc_type string, record_id string, target_uri string, warc_date string, headers map<string,string>, block binary"
#: Name spaces of the derivatives' ids.
METADATA, CONVERSION = uuid.uuid5(uuid.NAMESPACE_URL, "warc:metadata"), uuid.uuid5(uuid.NAMESPACE_URL, "warc:conversion")
#: Fields of the response that its derivatives repeat under their own names.
SHARED = ("WARC-IP-Address", "WARC-Warcinfo-ID")
_LINK = re.compile(rb"<(a|img|link|script|iframe|area|form)\b[^>]*?\s(href|src|action)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CHARSET = re.compile(rb"charset=[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def responses(pages: DataFrame, fetched: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table (page_id, url, html); ids follow from url, number and content."""
    body = F.encode(common.whole("html"), "UTF-8")
    seed = F.md5(F.concat_ws("\n", common.whole("url"), F.col("page_id").cast("string"), common.whole("html")))
    part = lambda a, b: F.substring(seed, a, b)
    number = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(F.encode(head, "UTF-8"), body)
    return pages.select(
        "page_id",
        F.lit("response").alias("warc_type"),
        number.alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(fetched).alias("warc_date"),
        F.create_map(
            F.lit("Content-Type"), F.lit("application/http; msgtype=response"),
            F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha256:"), F.sha2(body, 256)),
            F.lit("WARC-Block-Digest"), F.concat(F.lit("sha256:"), F.sha2(block, 256)),
        ).alias("headers"),
        block.alias("block"),
    )


def _fields(lines: Iterable[str]) -> list[tuple[str, str]]:
    """Names and values of header lines, in order; a line that begins with white space goes on with the value before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = out[-1][0], f"{out[-1][1]} {line.strip()}".strip()
        else:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields and payload of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    return status, _fields(lines), payload


def _source_name(name: str) -> str:
    """Under which name a derivative carries a WARC field of its response."""
    if name in SHARED:
        return name
    return "WARC-Source-" + (name.removeprefix("WARC-") if name.startswith("WARC-") else f"Record-{name}")


def _decoded(payload: bytes, content_type: str) -> str:
    found = _CHARSET.search(content_type.encode()) or _CHARSET.search(payload[:2048])
    try:
        return payload.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def plain_text(payload: bytes, content_type: str) -> str:
    """All blocks of a page, one a line; text of other kinds as it is; nothing for what is not text."""
    kind = content_type.partition(";")[0].strip().lower()
    if kind in ("", "text/html", "application/xhtml+xml"):
        return "\n".join(b.text for b in main_text.blocks(_decoded(payload, content_type)))
    return _decoded(payload, content_type) if kind.startswith("text/") else ""


def _derivatives(record_id: str | None, target: str | None, date: str | None, headers: dict[str, str], block: bytes) -> Iterator[dict]:
    status, fields, payload = _http(block)
    kind = next((value for name, value in fields if name.lower() == "content-type"), "")
    links = []
    for m in _LINK.finditer(payload) if "html" in kind or not kind else ():
        value = entities.unescape((m[3] or m[4] or m[5] or b"").decode("utf-8", "replace"))
        links.append(f"outlink: {' '.join(value.split())} {m[1].decode().lower()}/@{m[2].decode().lower()}")
    stated = headers.get("WARC-Payload-Digest")
    actual = digest(payload)
    lines = [f"http-status: {status.split(' ')[1] if status.count(' ') else ''}", f"http-content-type: {kind}", f"payload-length: {len(payload)}", f"payload-digest: {actual}"]
    lines += [f"http-header: {name}: {value}" for name, value in fields]
    lines += links
    source = record_id or digest(block)
    for warc_type, space, content_type, own in (
        ("metadata", METADATA, "application/warc-fields", "".join(f"{line}\r\n" for line in lines).encode("utf-8", "replace")),
        ("conversion", CONVERSION, "text/plain; charset=utf-8", plain_text(payload, kind).encode("utf-8", "replace")),
    ):
        named = {"WARC-Refers-To": record_id, "WARC-Refers-To-Target-URI": target, "WARC-Refers-To-Date": date}
        if warc_type == "conversion":
            named["WARC-Source-Content-Type"] = kind
        named |= {_source_name(k): v for k, v in headers.items() if v and k != "Content-Length"}
        named |= {"Content-Type": content_type, "WARC-Block-Digest": digest(own), "Content-Length": str(len(own))}
        yield {
            "warc_type": warc_type,
            "record_id": f"<{uuid.uuid5(space, source).urn}>",
            "target_uri": target,
            "warc_date": date,
            "headers": {k: v for k, v in named.items() if v is not None},
            "block": own,
            "payload_intact": stated == actual if stated else None,
            "n_links": len(links),
        }


def derive(records: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Metadata and conversion records of all response records; `carry` names simple columns to repeat beside them."""
    common.small_batches(records.sparkSession, 200)
    needed = ("record_id", "target_uri", "warc_date", "headers", "block")
    inner = records.where("warc_type = 'response'").select(*[F.col(c).cast("string").alias(c) for c in carry], *needed)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                headers = dict(row["headers"] or {})
                own = [row[c] if isinstance(row[c], str) else None for c in ("record_id", "target_uri", "warc_date")]
                for made in _derivatives(*own, headers, bytes(row["block"] or b"")):
                    out.append({**{c: row[c] for c in carry}, **made})
            if out:
                yield pd.DataFrame(out)

    made = inner.mapInPandas(run, ", ".join([*(f"{c} string" for c in carry), RECORD, "payload_intact boolean", "n_links int"]))
    return made.withColumns({c: F.col(c).cast(records.schema[c].dataType) for c in carry})



# --- files


def write(records: DataFrame, path: str) -> None:
    """Records whose blocks are UTF-8 text, as all derivatives are, as gzip WARC files below `path`.

    Spark's text writer lays them out; what stands between two rows is the end of a record.
    """
    clean = lambda c: F.regexp_replace(c, "[\r\n]+", " ")
    field = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), clean(c)))
    own = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: (k != "Content-Length") & v.isNotNull())
    named = [
        field("WARC-Type", F.col("warc_type")),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Target-URI", F.col("target_uri")),
        field("WARC-Date", F.col("warc_date")),
    ]
    values = lambda e: F.transform(F.split(e["value"], "\n", -1), lambda v: F.concat(e["key"], F.lit(": "), clean(v)))
    more = F.flatten(F.transform(F.array_sort(F.map_entries(own)), values))
    length = F.concat(F.lit("Content-Length: "), F.coalesce(F.octet_length("block"), F.lit(0)).cast("string"))
    lines = F.concat(F.array(F.lit(VERSION)), F.filter(F.array(*named), lambda x: x.isNotNull()), more, F.array(length))
    text = F.concat(F.array_join(lines, "\r\n"), F.lit("\r\n\r\n"), F.coalesce(F.decode("block", "UTF-8"), F.lit("")))
    records.select(text.alias("value")).write.mode("overwrite").option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[dict]:
    """The records of a plain or gzip WARC file."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        lines = []
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            lines.append(line.decode("utf-8", "replace"))
        named: dict[str, str] = {}
        for name, value in _fields(lines):
            named[name] = f"{named[name]}\n{value}" if name in named else value
        block = stream.read(int(named.pop("Content-Length", "0") or 0))
        yield {
            "warc_type": named.pop("WARC-Type", None),
            "record_id": named.pop("WARC-Record-ID", None),
            "target_uri": named.pop("WARC-Target-URI", None),
            "warc_date": named.pop("WARC-Date", None),
            "headers": named,
            "block": block,
        }


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files below `path`, plain or gzip; a task reads a file at a time, of at most 2 GB."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["content"]:
                held = []
                for record in parse(bytes(data)):
                    held.append(record)
                    if len(held) >= 500:
                        yield pd.DataFrame(held)
                        held = []
                if held:
                    yield pd.DataFrame(held)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, RECORD)


def report(pages: DataFrame) -> DataFrame:
    """One row per derivative record of each page, with digests in place of its block."""
    made = derive(responses(pages), carry=("page_id",))
    header = lambda name: F.try_element_at("headers", F.lit(name))
    return made.select(
        "page_id",
        "warc_type",
        "record_id",
        header("WARC-Refers-To").alias("refers_to"),
        "target_uri",
        "warc_date",
        header("Content-Type").alias("content_type"),
        header("WARC-Source-Payload-Digest").alias("source_payload_digest"),
        header("WARC-Source-Block-Digest").alias("source_block_digest"),
        header("WARC-Block-Digest").alias("block_digest"),
        F.octet_length("block").cast("long").alias("content_length"),
        "payload_intact",
        F.col("n_links").cast("long").alias("n_links"),
    )
