"""Ogg media column: write, verify, reassemble, demultiplex, time-stamp.

Two operators. ``ogg_features`` keeps any text or blob as unsigned 8-bit mono samples in an Ogg container with two logical streams: the samples
(1000-sample packets) and an index stream whose packets say where each second of samples starts; then it reads the stored file back. Reading verifies every page's
checksum, puts packets together from the lacing values (across pages too), sorts them by serial number and derives each packet's
time from the granule positions. Everything is a function of the payload, so equal payloads give equal files.

``ogg_streams`` reads a column of files from anywhere, damaged ones too: behind a page that is cut, has a wrong checksum or isn't one it looks for the next capture
pattern, packets of which a page is missing are left out and counted, and what was wrong stands in an error column instead of ending the job.

A row is one file and is handled alone, with no shuffle; repeated rows are handled alike, an empty table gives an empty result, further columns of any name don't
matter. Null counts as an empty text, which is stored as one padding unit. Texts are taken as UTF-8, binary columns as they are.
Memory is some multiples of the longest text or file.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_type

#: Fixed values of the format (RFC 3533).
CAPTURE = b"OggS"
CONTINUED, FIRST, LAST = 1, 2, 4
HEADER = struct.Struct("<4sBBqIIIB")
NO_GRANULE = -1

UNIT = 192
RATE = 8000
PACKET = 1000
SECOND_PACKETS = RATE // PACKET
PAGE_SEGMENTS = 255

_FLIP = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_crc(page: bytes) -> int:
    """CRC with polynomial 0x04C11DB7, most significant bit first, from 0. zlib's runs the other way round: flip its bits."""
    crc = zlib.crc32(page.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_FLIP), "big")


def pad(data: bytes) -> bytes:
    """Appends bytes 32 up to a positive multiple of UNIT."""
    return data + b" " * (-len(data) % UNIT or (0 if data else UNIT))


class _Stream:
    """Packs one logical stream's packets into pages."""

    def __init__(self, serial: int):
        self.serial, self.seq, self.lacing, self.body, self.granule, self.continued = serial, 0, bytearray(), [], NO_GRANULE, False

    def page(self, flags: int = 0) -> bytes:
        head = HEADER.pack(CAPTURE, 0, flags | CONTINUED * self.continued | FIRST * (self.seq == 0), self.granule, self.serial, self.seq, 0, len(self.lacing))
        raw = head + bytes(self.lacing) + b"".join(self.body)
        self.seq, self.lacing, self.body, self.granule, self.continued = self.seq + 1, bytearray(), [], NO_GRANULE, False
        return raw[:22] + struct.pack("<I", page_crc(raw)) + raw[26:]

    def add(self, packet: bytes, granule: int) -> Iterator[bytes]:
        """Lacing: 255 for every full segment, then a last value under 255; a full page goes out, and the packet goes on in the next."""
        at, left = 0, len(packet)
        while True:
            if len(self.lacing) == PAGE_SEGMENTS:
                yield self.page()
                self.continued = at > 0
            n = min(left, 255)
            self.lacing.append(n)
            self.body.append(packet[at : at + n])
            at, left = at + n, left - n
            if n < 255:
                self.granule = granule
                break
        if len(self.lacing) == PAGE_SEGMENTS:
            yield self.page()


def encode(payload: bytes) -> bytes:
    """The payload's bytes as 8-bit samples in an Ogg file."""
    serial = zlib.crc32(payload)
    sound, index = _Stream(serial), _Stream(serial ^ 0x5A5A5A5A)
    out = [*sound.add(b"\x01pcm8\x00" + struct.pack("<IQ", RATE, len(payload)), 0), sound.page(), *index.add(b"\x01index\x00", 0), index.page()]
    for k, at in enumerate(range(0, len(payload), PACKET)):
        if k % SECOND_PACKETS == 0:
            out += index.add(struct.pack("<QI", at, zlib.crc32(payload[at : at + RATE])), at)
        out += sound.add(payload[at : at + PACKET], min(at + PACKET, len(payload)))
    return b"".join([*out, index.page(LAST), sound.page(LAST)])


def pages(media: bytes, at: int = 0) -> Iterator[tuple[int, int, int, int, bytes, bytes]]:
    """(flags, granule, serial, sequence, lacing, body) of each page from ``at`` on. Raises ValueError for a bad capture pattern, length or checksum."""
    while at < len(media):
        if len(media) < at + HEADER.size:
            raise ValueError(f"page at {at} ends early")
        sync, version, flags, granule, serial, seq, crc, n = HEADER.unpack_from(media, at)
        if sync != CAPTURE or version:
            raise ValueError(f"no page at {at}")
        body_at = at + HEADER.size + n
        lacing = media[at + HEADER.size : body_at]
        end = body_at + sum(lacing)
        if len(lacing) < n or end > len(media):
            raise ValueError(f"page at {at} ends early")
        if page_crc(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
            raise ValueError(f"checksum of the page at {at}")
        yield flags, granule, serial, seq, lacing, media[body_at:end]
        at = end


def demultiplex(media: bytes) -> tuple[dict[int, list[tuple[bytes, int]]], int]:
    """The number of pages, and per serial number its packets, each with the granule position of the page on which it ends, if it is the last there, else NO_GRANULE."""
    streams: dict[int, list[tuple[bytes, int]]] = {}
    parts: dict[int, list[bytes]] = {}
    due: dict[int, int] = {}
    n_pages = 0
    for flags, granule, serial, seq, lacing, body in pages(media):
        n_pages += 1
        if seq != due.get(serial, 0) or bool(flags & FIRST) != (seq == 0) or bool(flags & CONTINUED) != bool(parts.get(serial)):
            raise ValueError(f"stream {serial}: page {seq} is out of order")
        due[serial] = seq + 1
        own, at, part = streams.setdefault(serial, []), 0, parts.pop(serial, [])
        ends = [k for k, n in enumerate(lacing) if n < 255]
        for k, n in enumerate(lacing):
            part.append(body[at : at + n])
            at += n
            if n < 255:
                own.append((b"".join(part), granule if k == ends[-1] else NO_GRANULE))
                part = []
        if part:
            parts[serial] = part
    if parts:
        raise ValueError("a packet doesn't end")
    return streams, n_pages


#: How the first packet of a logical stream begins, by codec.
CODECS = ((b"\x01vorbis", "vorbis"), (b"OpusHead", "opus"), (b"\x80theora", "theora"), (b"Speex   ", "speex"), (b"\x7fFLAC", "flac"), (b"fishead\0", "skeleton"), (b"\x01pcm8", "pcm8"), (b"\x01index", "index"))


def seconds_of(codec: str | None, head: bytes):
    """A function from granule positions to seconds, by the stream's first packet; None if the codec has no clock of its own or the packet is too short."""
    try:
        if codec == "opus":
            skip = struct.unpack_from("<H", head, 10)[0]
            return lambda g: max(0, g - skip) / 48000
        if codec == "theora":
            numerator, denominator = struct.unpack_from(">II", head, 22)
            shift = (head[40] & 3) << 3 | head[41] >> 5
            return (lambda g: ((g >> shift) + (g & (1 << shift) - 1)) * denominator / numerator) if numerator and denominator else None
        rate = {
            "vorbis": lambda: struct.unpack_from("<I", head, 12)[0],
            "speex": lambda: struct.unpack_from("<I", head, 36)[0],
            "flac": lambda: int.from_bytes(head[27:30], "big") >> 4 if len(head) >= 30 else 0,
            "pcm8": lambda: struct.unpack_from("<I", head, 6)[0],
            "index": lambda: RATE,
        }.get(codec, lambda: 0)()
    except (struct.error, IndexError):
        return None
    return (lambda g: g / rate) if rate else None


def salvage(media: bytes) -> tuple[list[tuple[int, int, int, int, bytes, bytes]], list[str]]:
    """The sound pages of any bytes, and what is wrong between them. After a fault the search goes on at the next capture pattern."""
    found, wrong, at = [], [], 0
    while at < len(media):
        try:
            page = next(pages(media, at))
            found.append(page)
            at += HEADER.size + len(page[4]) + len(page[5])
        except ValueError as e:
            wrong.append(str(e))
            at = media.find(CAPTURE, at + 1)
            if at < 0:
                break
    return found, wrong


def streams_of(media: bytes | None) -> list[tuple]:
    """(serial, codec, n_pages, n_packets, n_bytes, n_lost, first_seconds, last_seconds, sha256, error) of each logical stream, by serial number. Without any
    sound page, one row with serial null. n_lost: packets left out since a page of theirs is missing, and n_bytes and sha256 are of the others."""
    if not media:
        return [(None, None, 0, 0, 0, 0, None, None, None, "no file" if media is None else "empty file")]
    found, wrong = salvage(media)
    if not found:
        return [(None, None, 0, 0, 0, 0, None, None, None, "; ".join(wrong[:3]))]
    by: dict[int, list[tuple]] = {}
    for page in found:
        by.setdefault(page[2], []).append(page)
    out = []
    for serial, own in sorted(by.items()):
        packets, granules, part, lost, gaps, due = [], [], None, 0, [], own[0][3] if own[0][0] & FIRST else 0
        for flags, granule, _, seq, lacing, body in own:
            if seq != due:
                gaps.append(f"pages {due} to {seq - 1} are missing" if seq > due else f"page {seq} comes after page {due - 1}")
            if part is not None and (seq != due or not flags & CONTINUED):
                lost, part = lost + 1, None
            skipping = bool(flags & CONTINUED) and part is None
            due, at = seq + 1, 0
            for n in lacing:
                part = (part or b"") + body[at : at + n]
                at += n
                if n < 255:
                    if skipping:
                        lost, skipping = lost + 1, False
                    else:
                        packets.append(part)
                    part = None
            if skipping:
                part = None
            if granule != NO_GRANULE:
                granules.append(granule)
        if part is not None:
            lost += 1
            gaps.append("the last packet doesn't end")
        if not own[0][0] & FIRST:
            gaps.insert(0, "the first page is missing")
        if not own[-1][0] & LAST:
            gaps.append("the stream doesn't end")
        head = packets[0] if packets and own[0][0] & FIRST else b""
        codec = next((name for mark, name in CODECS if head.startswith(mark)), None)
        clock = seconds_of(codec, head)
        first, last = (round(clock(g), 6) for g in (granules[0], granules[-1])) if clock and granules else (None, None)
        said = "; ".join([*gaps[:3], *wrong[:3]]) or None
        out.append((serial, codec, len(own), len(packets), sum(map(len, packets)), lost, first, last, hashlib.sha256(b"".join(packets)).hexdigest(), said))
    return out


STREAMS = "serial bigint, codec string, n_pages bigint, n_packets bigint, n_bytes bigint, n_lost bigint, first_seconds double, last_seconds double, packets_sha256 string, error string"


def ogg_streams(files: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """One row per file and logical stream: ``key`` and the columns of STREAMS; one row with serial null for a file without any sound page, null and empty ones too."""
    kind = dict(files.dtypes)[key]
    names = [key, *(x.split()[0] for x in STREAMS.split(", "))]
    types = [batch_type(x.split()[1]) for x in STREAMS.split(", ")]

    def run(batches):
        for batch in batches:
            rows = [(i, *r) for i, value in enumerate(batch[1]) for r in streams_of(value.as_py())]
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch[0].take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], types, strict=True))], names=names)

    return files.select(F.col(key), F.col(media).cast("binary")).mapInArrow(run, f"{key} {kind}, {STREAMS}")


def timestamps(packets: list[tuple[bytes, int]], rate: int = RATE) -> list[tuple[int, float]]:
    """(first sample, seconds) of each sample packet. Pages carry the position after their last packet; the others follow backwards by length."""
    ends, due = [0] * len(packets), None
    for k in range(len(packets) - 1, -1, -1):
        data, granule = packets[k]
        due = granule if granule != NO_GRANULE else due
        if due is None:
            raise ValueError("the last packet has no granule position")
        ends[k] = due
        due -= len(data)
    return [(end - len(data), (end - len(data)) / rate) for end, (data, _) in zip(ends, packets, strict=True)]


def decode(media: bytes) -> tuple[bytes, str]:
    """The payload read back, and a feature string: streams, pages, packets, duration, last packet's time, mean, peak, zero crossings."""
    streams, n_pages = demultiplex(media)
    kinds = {s[0][0][:5]: s for s in streams.values() if s}
    if {b"\x01pcm8", b"\x01inde"} - set(kinds):
        raise ValueError("no streams of samples and index")
    sound, index = kinds[b"\x01pcm8"], kinds[b"\x01inde"]
    rate, length = struct.unpack_from("<IQ", sound[0][0], 6)
    times = timestamps(sound[1:], rate)
    payload = b"".join(data for data, _ in sound[1:])
    if len(payload) != length or (times and times[0][0] != 0):
        raise ValueError("samples are missing")
    for entry, _ in index[1:]:
        at, crc = struct.unpack("<QI", entry)
        if zlib.crc32(payload[at : at + rate]) != crc:
            raise ValueError(f"samples from {at} on differ from their index")
    x = np.frombuffer(payload, np.uint8)
    side = x >= 128
    return payload, (
        f"streams={len(streams)};pages={n_pages};packets={sum(map(len, streams.values()))};"
        f"seconds={length / rate:.4f};last={times[-1][1] if times else 0:.4f};mean={x.mean():.4f};peak={int(x.max())};crossings={int(np.count_nonzero(side[1:] != side[:-1]))}"
    )


SCHEMA = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _bytes(value: str | bytes | None) -> bytes:
    return value if isinstance(value, bytes) else (value or "").encode()


def _row(data: bytes) -> tuple:
    media = encode(pad(data))
    back, feature = decode(media)
    return len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature


def ogg_features(docs: DataFrame, text: str = "text", key: str = "doc_id", keep_media: bool = False) -> DataFrame:
    """One row per input row: ``key``, the columns of SCHEMA and, if asked for, the stored file as ``media``."""
    schema = f"{key} {dict(docs.dtypes)[key]}, {SCHEMA}" + ", media binary" * keep_media
    names = [key, *(x.split()[0] for x in SCHEMA.split(", ")), *["media"] * keep_media]

    def run(batches):
        for batch in batches:
            rows = [(*_row(d), *([encode(pad(d))] if keep_media else [])) for d in (_bytes(v.as_py()) for v in batch[1])]
            cols = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch[0], *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    types = [batch_type(t) for t in ("bigint", "bigint", "string", "bigint", "bigint", "string", "string", *["binary"] * keep_media)]
    own = F.col(text) if dict(docs.dtypes)[text] == "binary" else F.col(text).cast("string")
    return docs.select(F.col(key), own).mapInArrow(run, schema)
