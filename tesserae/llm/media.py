"""Telephony audio in columns: mu-law, A-law and IMA ADPCM to resampled 16-bit PCM, and between each other.

Media are WAV files in a binary column. mu-law and A-law samples expand through tables of 256 entries that are made from
the companding rules; A-law is written by the nearest entry. ADPCM is coded and decoded step by step within a block but
over all blocks of a batch at once, as numpy arrays. PCM is brought from 8 to 16 kHz by linear interpolation and stored
as little-endian 16-bit samples.

A null text counts as empty. Every payload is padded with zero bytes to a positive multiple of 64, so empty texts give
one block of silence. A medium that is null or no whole WAV file of a known codec gives null in all that is made from it;
one without samples gives files without samples. Very long media are whole: a batch holds one of them at a time. Rows are
independent; repeated rows give equal values, an empty table none. The query reads doc_id and text alone, whatever other
columns there are; rendered() keeps all columns but those that it makes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .text import documents, slices

BLOCK = 64
#: Samples of an ADPCM block of BLOCK bytes: one in its head of four bytes, two in each other byte.
FRAMES = 1 + 2 * (BLOCK - 4)
#: WAV format tags.
PCM, ALAW, MULAW, ADPCM = 1, 6, 7, 17

#: Fixed values of IMA ADPCM: step sizes and changes of the step index.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)
CHANGES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = (((code & 0x0F) << 3) + 132 << (code >> 4 & 7)) - 132
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    step, low = code >> 4 & 7, (code & 0x0F) << 4
    size = np.where(step == 0, low + 8, low + 264 << np.maximum(step - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


def adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples (n, 1 + 2 * (size - 4)) of n mono blocks (n, size) of bytes: 16-bit first sample, step index, unused, nibbles."""
    head = blocks[:, 0].astype(np.int32) | blocks[:, 1].astype(np.int32) << 8
    value = np.where(head >= 32768, head - 65536, head)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(STEPS) - 1)
    body = np.ascontiguousarray(blocks[:, 4:].T)
    out = np.empty((1 + 2 * len(body), len(blocks)), np.int16)
    out[0] = value
    for i in range(2 * len(body)):
        code = (body[i >> 1] >> (4 * (i & 1)) & 15).astype(np.int32)
        step = STEPS[index]
        size = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(value + np.where(code & 8, -size, size), -32768, 32767)
        index = np.clip(index + CHANGES[code], 0, len(STEPS) - 1)
        out[i + 1] = value
    return out.T


def coded(pcm: np.ndarray) -> np.ndarray:
    """Blocks (n, BLOCK) of bytes from samples (n, FRAMES): the inverse of adpcm(), with each step coded as near as it allows."""
    n = len(pcm)
    value, index = pcm[:, 0].astype(np.int32), np.zeros(n, np.int32)
    codes = np.empty((FRAMES - 1, n), np.uint8)
    wanted = np.ascontiguousarray(pcm.T).astype(np.int32)
    # the first step is the least that reaches the second sample
    index[:] = np.minimum(np.searchsorted(STEPS, np.abs(wanted[1] - value)), len(STEPS) - 1)
    out = np.zeros((n, BLOCK), np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = value & 255, value >> 8 & 255, index
    for i in range(1, FRAMES):
        step = STEPS[index]
        off = wanted[i] - value
        left, code = np.abs(off), np.where(off < 0, 8, 0).astype(np.int32)
        size = step >> 3
        for bit in (4, 2, 1):
            more = left >= step
            code |= np.where(more, bit, 0)
            size, left = size + np.where(more, step, 0), left - np.where(more, step, 0)
            step = step >> 1
        value = np.clip(value + np.where(off < 0, -size, size), -32768, 32767)
        index = np.clip(index + CHANGES[code], 0, len(STEPS) - 1)
        codes[i - 1] = code
    out[:, 4:] = (codes[::2] | codes[1::2] << 4).T
    return out


def nearest_alaw(pcm: np.ndarray) -> np.ndarray:
    """The codes whose values are the nearest; the smaller one of two as near."""
    order = np.argsort(alaw_table(), kind="stable")
    values = alaw_table()[order].astype(np.int32)
    middle = (values[:-1] + values[1:]) >> 1
    return order[np.searchsorted(middle, pcm.astype(np.int32))].astype(np.uint8)


def doubled(pcm: np.ndarray) -> np.ndarray:
    """Twice the rate: each sample, then the middle between it and the next."""
    out = np.empty(2 * len(pcm), np.int16)
    out[::2] = pcm
    if len(pcm):
        out[1:-1:2] = (pcm[:-1].astype(np.int32) + pcm[1:]) >> 1
        out[-1] = pcm[-1]
    return out


def wav(payload: bytes, tag: int = MULAW, rate: int = 8000, bits: int = 8) -> bytes:
    """A mono WAV file. Its parts have even lengths, as the format asks for, if the payload has one."""
    unit = BLOCK if tag == ADPCM else bits // 8
    per_second = rate * unit if tag != ADPCM else rate * BLOCK // FRAMES
    more = struct.pack("<HH", 2, FRAMES) if tag == ADPCM else b"" if tag == PCM else struct.pack("<H", 0)
    form = struct.pack("<HHIIHH", tag, 1, rate, per_second, unit, bits) + more
    return b"RIFF" + struct.pack("<I", 20 + len(form) + len(payload)) + b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(payload)) + payload


def unwav(media: bytes | None) -> tuple[int, int, bytes] | None:
    """Format tag, rate and samples of a WAV file; other parts are skipped. None if it is no whole file."""
    if media is None or media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if at + 8 + size > len(media):
            return None
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data":
            return form and (form[0], form[2], media[at + 8 : at + 8 + size])
        at += 8 + size + size % 2
    return None


def expanded(tag: int, samples: bytes) -> np.ndarray:
    """16-bit samples of a WAV file's bytes."""
    raw = np.frombuffer(samples, np.uint8)
    if tag == MULAW:
        return mulaw_table()[raw]
    if tag == ALAW:
        return alaw_table()[raw]
    if tag == ADPCM:
        return adpcm(raw[: len(raw) // BLOCK * BLOCK].reshape(-1, BLOCK)).ravel()
    return np.frombuffer(samples[: len(samples) // 2 * 2], "<i2")


def heard(files: list[bytes | None]) -> list[tuple[int, np.ndarray] | None]:
    """Rate and 16-bit samples of WAV files. The ADPCM blocks of all are decoded together."""
    read = [unwav(m) for m in files]
    out = [(r[1], expanded(r[0], r[2])) if r and r[0] in (PCM, ALAW, MULAW) else None for r in read]
    blocks = [(i, np.frombuffer(r[2], np.uint8)) for i, r in enumerate(read) if r and r[0] == ADPCM]
    if blocks:
        parts = [b[: len(b) // BLOCK * BLOCK].reshape(-1, BLOCK) for _, b in blocks]
        pcm = np.split(adpcm(np.concatenate(parts)), np.cumsum([len(p) for p in parts])[:-1])
        for (i, _), p in zip(blocks, pcm):
            out[i] = (read[i][1], p.ravel())
    return out


def as_alaw(sounds: list) -> list[bytes | None]:
    return [s and wav(nearest_alaw(s[1]).tobytes(), ALAW, s[0]) for s in sounds]


def as_adpcm(sounds: list) -> list[bytes | None]:
    """The last block is filled up with the last sample. All blocks are coded together."""
    full = [np.pad(s[1], (0, -len(s[1]) % FRAMES), "edge").reshape(-1, FRAMES) for s in sounds if s and len(s[1])]
    made = iter(np.split(coded(np.concatenate(full)), np.cumsum([len(f) for f in full])[:-1]) if full else ())
    return [s and wav(next(made).tobytes() if len(s[1]) else b"", ADPCM, s[0], 4) for s in sounds]


def as_pcm(sounds: list) -> list[bytes | None]:
    return [s and wav(doubled(s[1]).tobytes(), PCM, 2 * s[0], 16) for s in sounds]


RENDITIONS = {"alaw": as_alaw, "adpcm": as_adpcm, "pcm": as_pcm}


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def stored_batches(batches: Iterator[pa.RecordBatch], tag: int = MULAW, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", most_bytes):
        made = [payload_of(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([n for n, _ in made], pa.int64()), pa.array([wav(p, tag) for _, p in made], pa.binary())], ["doc_id", "n_bytes", "media"]
        )


def stored(docs: DataFrame, tag: int = MULAW) -> DataFrame:
    """doc_id, n_bytes and media: each text's bytes as the samples of a WAV file."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(lambda batches: stored_batches(batches, tag), f"doc_id {kind}, n_bytes long, media binary")


def rendered_batches(batches: Iterator[pa.RecordBatch], into: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "media"):
        sounds = heard(b.column("media").to_pylist())
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(RENDITIONS[c](sounds), pa.binary()) for c in into]], [*b.schema.names, *into])


def rendered(media: DataFrame, into: tuple[str, ...] = ("pcm",)) -> DataFrame:
    """The media's rows with WAV files of the same sound: alaw and adpcm at its rate, pcm with 16 bits at twice the rate."""
    media = media.drop(*into)
    fields = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in media.schema)
    return media.mapInArrow(lambda batches: rendered_batches(batches, into), fields + ", ".join(f"{c} binary" for c in into))


def told(pcm: np.ndarray, rate: int) -> str:
    wide = pcm.astype(np.int64)
    power = int((wide * wide).sum()) // max(1, len(wide))
    turns = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    return f"pcm:rate={rate},samples={len(pcm)},peak={int(np.abs(wide).max(initial=0))},power={power},turns={turns},crc={zlib.crc32(pcm.tobytes())}"


def apart(name: str, sound: np.ndarray, again: np.ndarray) -> str:
    """How far a codec's sound, read back, is from the first: the mean of the distances, and a checksum."""
    off = np.abs(sound.astype(np.int32) - again[: len(sound)]).sum(dtype=np.int64)
    return f"{name}:error={int(off) // max(1, len(sound))},crc={zlib.crc32(again.tobytes())}"


def described_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "media", 1 << 20):
        files = b.column("media").to_pylist()
        read = [unwav(m) for m in files]
        read = [r and r[2] for r in read]
        sound, alaw, adpcm_, pcm = (heard(b.column(c).to_pylist()) for c in ("media", "alaw", "adpcm", "pcm"))
        features = [
            ";".join([told(w[1], w[0]), apart("alaw", s[1], a[1]), apart("adpcm", s[1], d[1])]) if s and a and d and w else None
            for s, a, d, w in zip(sound, alaw, adpcm_, pcm)
        ]
        each = lambda f, values: [None if v is None else f(v) for v in values]
        columns = [
            pa.array(each(len, read), pa.int64()),
            pa.array(each(lambda p: hashlib.sha256(p).hexdigest(), read), pa.string()),
            pa.array(each(lambda p: zlib.crc32(p[-BLOCK:]), read), pa.int64()),
            pa.array(each(len, files), pa.int64()),
            pa.array(each(lambda m: hashlib.sha256(m).hexdigest(), files), pa.string()),
            pa.array(features, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *columns], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


#: Columns of described() beside doc_id.
DIGESTS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def described(media: DataFrame) -> DataFrame:
    """Digests of the stored bytes as read back, and features of the sound as read back from its renditions."""
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media", *RENDITIONS).mapInArrow(described_batches, f"doc_id {kind}, {DIGESTS}")


def digests(docs: DataFrame) -> DataFrame:
    """described(rendered(stored(docs))) with all renditions, in one worker a task: the media, several times as large as the texts, never go through the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return described_batches(rendered_batches(stored_batches(batches, most_bytes=1 << 20), tuple(RENDITIONS)))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, {DIGESTS}")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as mu-law files; A-law, ADPCM and resampled PCM files of the same sound; the features are read from these."""
    return digests(documents(spark, sf_dir))
