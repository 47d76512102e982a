"""Ogg media columns: bytes are stored as 8-bit samples in an Ogg stream, and streams are read back with every check.

A stored file has two logical streams, multiplexed: samples in packets of 576, and one packet of notes that says how many bytes
were stored. A reader verifies each page's checksum, follows the lacing values to put packets together (over page bounds, too),
keeps the logical streams apart by serial number, and derives each packet's time from the granule positions.

Everything works on one row at a time, so memory is bounded by the longest text. Defined results: a null text is an empty one and
is stored as one packet of padding; equal texts give equal files; a damaged file raises an error;
repeated rows give equal rows; very long texts are written and read whole; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fields, table, text_of

PACKET = 576  # bytes, and so samples
RATE = 8000  # samples a second
SAMPLES, NOTES = 1, 2  # serial numbers
HEAD = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
#: A byte's bits in the other order: with it, zlib's checksum gives Ogg's, which has the same polynomial without reflection.
MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    raw = zlib.crc32(page.translate(MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(raw.to_bytes(4, "little").translate(MIRROR), "big")


def page(serial: int, number: int, granule: int, flags: int, lacing: bytes, body: bytes) -> bytes:
    head = HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    whole = head + lacing + body
    return whole[:22] + struct.pack("<I", checksum(whole)) + whole[26:]


def laced(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


def write(payload: bytes, notes: dict) -> bytes:
    """payload: a positive multiple of PACKET bytes."""
    head = b"\x01raw8" + struct.pack("<IH", RATE, PACKET)
    out = [page(SAMPLES, 0, 0, FIRST, laced(len(head)), head), page(NOTES, 0, 0, FIRST, laced(6), b"\x01notes")]
    said = json.dumps(notes, sort_keys=True).encode()
    out.append(page(NOTES, 1, 0, LAST, laced(len(said)), said))
    each = 255 // len(lacing := laced(PACKET))
    for number, at in enumerate(range(0, len(payload), each * PACKET), 1):
        body = payload[at : at + each * PACKET]
        end = at + len(body)
        out.append(page(SAMPLES, number, end, LAST * (end == len(payload)), lacing * (len(body) // PACKET), body))
    return b"".join(out)


@dataclass
class Stream:
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # where a page ended; else -1
    number: int = 0
    open: list[bytes] = field(default_factory=list)
    ended: bool = False


def read(media: bytes) -> dict[int, Stream]:
    """The logical streams by serial number."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(media):
        mark, version, flags, granule, serial, number, said, n = HEAD.unpack_from(media, at)
        lacing = media[at + HEAD.size : at + HEAD.size + n]
        start = at + HEAD.size + n
        stop = start + sum(lacing)
        whole = media[at:stop]
        if mark != b"OggS" or version or len(lacing) < n or len(whole) < stop - at or checksum(whole[:22] + bytes(4) + whole[26:]) != said:
            raise ValueError(f"damaged Ogg page at byte {at}")
        s = streams.setdefault(serial, Stream())
        if number != s.number or s.ended or bool(flags & FIRST) != (number == 0) or bool(flags & CONTINUED) != bool(s.open):
            raise ValueError(f"Ogg page out of order at byte {at}")
        begin, ends = start, start
        for size in lacing:
            ends += size
            if size < 255:
                s.packets.append(b"".join([*s.open, media[begin:ends]]))
                s.granules.append(-1)
                s.open, begin = [], ends
        if begin < ends or lacing[-1:] == b"\xff":
            s.open.append(media[begin:ends])
        if s.granules and granule >= 0:
            s.granules[-1] = granule
        s.number, s.ended, at = number + 1, bool(flags & LAST), stop
    if any(s.open or not s.ended for s in streams.values()):
        raise ValueError("an Ogg stream does not end")
    return streams


def samples(streams: dict[int, Stream]) -> tuple[bytes, list[float], dict]:
    """The stored samples, the time in seconds at which each packet ends, and the notes."""
    sound = streams[SAMPLES]
    packets, marks = sound.packets[1:], sound.granules[1:]
    rate, _ = struct.unpack_from("<IH", sound.packets[0], 5)
    ends, after = [0] * len(packets), None
    for i in range(len(packets) - 1, -1, -1):  # backwards from where a page says its last packet ends
        ends[i] = marks[i] if marks[i] >= 0 else after
        after = ends[i] - len(packets[i])
    if after != 0:
        raise ValueError("granule positions do not agree with the samples")
    return b"".join(packets), [x / rate for x in ends], json.loads(streams[NOTES].packets[1])


def feature(payload: bytes, times: list[float]) -> str:
    """Length in milliseconds, and for sixteen equal spans the mean level and the mean step between neighbours, as hexadecimal bytes."""
    spans = np.frombuffer(payload, np.uint8).reshape(16, -1).astype(np.int32)
    level = spans.sum(axis=1) // spans.shape[1]
    step = np.abs(np.diff(spans, axis=1)).sum(axis=1) // (spans.shape[1] - 1)
    return f"{round(times[-1] * 1000)}ms:{bytes(level.tolist()).hex()}:{bytes(step.tolist()).hex()}"


def padded(text: str) -> tuple[bytes, int]:
    raw = text.encode()
    return raw + b"\xff" * (max(PACKET, -(-len(raw) // PACKET) * PACKET) - len(raw)), len(raw)


#: Rows that a worker hands back at a time.
SLICE = 500
FOUND = ("n_bytes", "payload", "n_packets", "seconds", "feature")


def sliced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.iloc[at : at + SLICE]


def stored(text: str) -> bytes:
    payload, n = padded(text)
    return write(payload, {"n_bytes": n})


def found(media: bytes) -> tuple:
    payload, times, notes = samples(read(media))
    return notes["n_bytes"], payload, len(times), times[-1], feature(payload, times)


@F.pandas_udf(fields("media binary")["media"].dataType)
def stored_media(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts as Ogg files."""
    for texts in sliced(batches):
        yield pd.Series(list(map(stored, texts)), dtype=object)


@F.pandas_udf(fields("n_bytes long, payload binary, n_packets long, seconds double, feature string"))
def read_media(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """What Ogg files hold."""
    for files in sliced(batches):
        yield pd.DataFrame(list(map(found, files)), columns=FOUND)


@F.pandas_udf(fields("media binary, n_bytes long, payload binary, n_packets long, seconds double, feature string"))
def stored_and_read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Both in one pass: the files, and what is read back from their bytes."""
    for texts in sliced(batches):
        files = list(map(stored, texts))
        yield pd.DataFrame([(media, *found(media)) for media in files], columns=("media", *FOUND))


def op4_ogg_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = table(spark, sf_dir, "documents").select("doc_id", stored_and_read(text_of("text")).alias("r"))
    return back.select(
        "doc_id", "r.n_bytes", F.octet_length("r.payload").cast("long").alias("payload_bytes"), F.sha2("r.payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(r.payload, -32, 32)")).alias("tail_crc32"), F.octet_length("r.media").cast("long").alias("media_bytes"), F.sha2("r.media", 256).alias("media_sha256"), "r.feature", "r.n_packets", "r.seconds",
    )
