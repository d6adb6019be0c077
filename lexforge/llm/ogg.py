"""Ogg as a column: write a payload as an Ogg file of two logical streams, and read such files back.

Reading checks each page's checksum, reassembles packets from the lacing values (packets that go on over several pages
included), keeps logical streams apart by their serial numbers and derives times from granule positions.

The checksum of Ogg (polynomial 0x04c11db7, highest bit first, no inversion) is computed as zlib's CRC-32 over bytes
whose bits are reversed, with zlib's inversions undone.

A payload file holds: stream `samples`, mono 8-bit samples at RATE a second, whose first packet is a header and whose
granule position counts samples; and stream `note`, a header and one packet with the unpadded length, whose granule
position counts packets. Pages of the two are interleaved. Serial numbers derive from the payload's checksum, so equal
payloads give equal files.

Defined cases: null is an empty text; every payload is padded with bytes 0 to a positive multiple of BLOCK; texts of any
length are stored whole; damaged files raise ValueError in read(), and read_column() gives a null feature and an error;
columns that have the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, replacing

BLOCK, RATE, PACKET = 64, 8000, 16_384
REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))
HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
SAMPLES_ID, NOTE_ID = b"\x01pcm8", b"\x01note"


def page_checksum(page: bytes) -> int:
    """Ogg's CRC of a page whose checksum field is zero."""
    reflected = zlib.crc32(page.translate(REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(reflected.to_bytes(4, "big").translate(REVERSED), "little")


def page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    return head[:22] + struct.pack("<I", page_checksum(head + body)) + head[26:] + body


def paginate(packets: list[tuple[bytes, int]], serial: int) -> list[bytes]:
    """Pages of a stream; packets come with the granule position at their end. The first packet has a page of its own."""
    pages, lacing, body, granule, carried = [], bytearray(), bytearray(), -1, False

    def close(last: bool = False) -> None:
        nonlocal granule, carried
        flags = CONTINUED * carried | FIRST * (not pages) | LAST * last
        pages.append(page(flags, granule, serial, len(pages), bytes(lacing), bytes(body)))
        carried = bool(lacing) and lacing[-1] == 255
        lacing.clear()
        body.clear()
        granule = -1

    for k, (packet, end) in enumerate(packets):
        values = bytes([255]) * (len(packet) // 255) + bytes([len(packet) % 255])
        at = 0
        while values:
            now = values[: 255 - len(lacing)]
            size = sum(now)
            lacing += now
            body += packet[at : at + size]
            at += size
            values = values[len(now) :]
            if not values:
                granule = end
            if k == 0 or len(lacing) == 255:
                if not (k == len(packets) - 1 and not values):
                    close()
    close(last=True)
    return pages


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: For each packet the granule position of its page if it is the last that ends there, else -1.
    granules: list[int] = field(default_factory=list)
    pages: int = 0
    ended: bool = False
    open: bytearray = field(default_factory=bytearray)


def read(data: bytes) -> dict[int, Stream]:
    """The logical streams of a file by serial number; ValueError if it is not sound."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if len(data) - at < HEAD.size:
            raise ValueError("a page is cut off")
        magic, version, flags, granule, serial, number, checksum, n = HEAD.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise ValueError("no page where one must begin")
        body = at + HEAD.size + n
        lacing = data[at + HEAD.size : body]
        end = body + sum(lacing)
        if end > len(data) or len(lacing) < n:
            raise ValueError("a page is cut off")
        if page_checksum(data[at : at + 22] + bytes(4) + data[at + 26 : end]) != checksum:
            raise ValueError("a page's checksum is wrong")
        if (flags & FIRST > 0) == (serial in streams):
            raise ValueError("a stream begins twice, or not at its first page")
        s = streams.setdefault(serial, Stream(serial))
        if number != s.pages or s.ended:
            raise ValueError("a page is missing")
        if (flags & CONTINUED > 0) != bool(s.open):
            raise ValueError("a packet's part is missing")
        s.pages, s.ended = s.pages + 1, flags & LAST > 0
        done = len(s.packets)
        size = 0
        for value in lacing:
            size += value
            if value < 255:
                s.packets.append(bytes(s.open) + data[body : body + size])
                s.granules.append(-1)
                s.open.clear()
                body, size = body + size, 0
        s.open += data[body:end]
        if size and not s.open:
            raise ValueError("a packet's part is missing")
        if len(s.packets) > done:
            s.granules[-1] = granule
        elif granule != -1:
            raise ValueError("a granule position where no packet ends")
        at = end
    if any(s.open or not s.ended for s in streams.values()):
        raise ValueError("a stream has no end")
    return streams


def seconds(stream: Stream, rate: float) -> list[float | None]:
    """The end time of each packet that has a granule position."""
    return [g / rate if g >= 0 else None for g in stream.granules]


def padded(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes((-len(data)) % BLOCK if data else BLOCK), len(data)


def write_payload(payload: bytes, unpadded: int) -> bytes:
    serial = zlib.crc32(payload)
    other = serial ^ 0x5A5A5A5A
    packets = [(SAMPLES_ID + struct.pack("<II", RATE, len(payload)), 0)]
    packets += [(payload[i : i + PACKET], min(len(payload), i + PACKET)) for i in range(0, len(payload), PACKET)]
    main = paginate(packets, serial)
    note = paginate([(NOTE_ID, 0), (struct.pack("<Q", unpadded), 1)], other)
    # all first pages come first, as the format asks
    return b"".join([main[0], note[0], main[1], *note[1:], *main[2:]])


def read_payload(data: bytes) -> dict:
    """The payload of a file of write_payload and what its pages say."""
    streams = read(data)
    kinds = {s.packets[0][:5]: s for s in streams.values() if s.packets}
    if kinds.keys() != {SAMPLES_ID, NOTE_ID}:
        raise ValueError("not the two streams that are expected")
    main, note = kinds[SAMPLES_ID], kinds[NOTE_ID]
    rate, size = struct.unpack("<II", main.packets[0][5:])
    payload = b"".join(main.packets[1:])
    times = [t for t in seconds(main, rate) if t is not None]
    if len(payload) != size or main.granules[-1] != size or times != sorted(times):
        raise ValueError("the samples don't match their granule positions")
    return {"payload": payload, "n_bytes": struct.unpack("<Q", note.packets[1])[0], "streams": len(streams), "pages": sum(s.pages for s in streams.values()), "packets": sum(len(s.packets) for s in streams.values()), "seconds": times[-1]}


def column(payloads: list[str | None]) -> list[dict]:
    """Each text stored, read back and described."""
    out = []
    for text in payloads:
        raw, n = padded(text)
        media = write_payload(raw, n)
        got = read_payload(media)
        back = got["payload"]
        out.append({"n_bytes": got["n_bytes"], "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-BLOCK:]), "media": media, "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "feature": f"streams={got['streams']};pages={got['pages']};packets={got['packets']};seconds={got['seconds']:.6f}"})
    return out


FIELDS = [("n_bytes", pa.int64(), "long"), ("payload_bytes", pa.int64(), "long"), ("payload_sha256", pa.string(), "string"), ("tail_crc32", pa.int64(), "long"), ("media", pa.binary(), "binary"), ("media_bytes", pa.int64(), "long"), ("media_sha256", pa.string(), "string"), ("feature", pa.string(), "string")]


def store_texts(docs: DataFrame, text: str = "text", media: bool = True) -> DataFrame:
    """All columns of docs and, for each text, its stored form (media, if asked for) and what was read back from it."""
    fields = [f for f in FIELDS if media or f[0] != "media"]
    docs = replacing(docs, text, *(n for n, _, _ in fields))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = column(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([g[n] for g in got], t) for n, t, _ in fields)], names=[*batch.schema.names, *(f[0] for f in fields)])

    return map_batches(docs, run, ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), *(f"{n} {t}" for n, _, t in fields)]))


def read_column(files: DataFrame, media: str = "media") -> DataFrame:
    """All columns of files and, for each stored file, its payload, feature and error; a damaged or null file has an error alone."""
    files = replacing(files, media, "payload", "feature", "error")
    at = files.columns.index(media)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for data in batch.column(at).to_pylist():
                try:
                    got = read_payload(data or b"")
                    out.append((got["payload"][: got["n_bytes"]], f"streams={got['streams']};pages={got['pages']};packets={got['packets']};seconds={got['seconds']:.6f}", None))
                except (ValueError, struct.error, IndexError) as e:
                    out.append((None, None, str(e)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.string())], names=[*batch.schema.names, "payload", "feature", "error"])

    return map_batches(files, run, ", ".join([*(f"`{n}` {t}" for n, t in files.dtypes), "payload binary, feature string, error string"]))


def media_of_documents(docs: DataFrame) -> DataFrame:
    return store_texts(docs.select("doc_id", "text"), media=False).drop("text")
