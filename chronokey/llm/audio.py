"""Chroma audio fingerprints of a column of WAV recordings, and the alignment of recordings by them.

Audio at 11,025 Hz is cut into frames of 4,096 samples, a third apart; each frame's power between 28 and 3,520 Hz folds
into 12 pitch classes, smoothed over five frames and normalised. Sixteen box filters over this picture, computed
from its integral image, are quantised to two bits each in Gray code: a 32-bit integer for each position.

Alignment: equal integers vote for their offset; at the offset with most votes the bit errors of the overlap are
counted. Search: recordings with equal fingerprints form one class; the classes of a stated set of query recordings
are held, in blocks, against all other classes. A task keeps one block's inverted index and streams classes past it,
so neither a frequent integer nor a large group of near copies is ever expanded into rows. Where a pair of recordings
has many equal integers (long steady tones), their votes are counted by correlation instead of pair by pair.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_schema, written

RATE, FRAME, HOP = 11_025, 4_096, 4_096 // 3
LOW, HIGH = 28.0, 3_520.0
#: Smoothing over frames; then for each filter its kind, first pitch class, height, width and the three
#: bounds of its quantiser.
SMOOTH = (0.25, 0.75, 1.0, 0.75, 0.25)
FILTERS = (
    (0, 4, 3, 15, 1.98215, 2.35817, 2.63523),
    (4, 4, 6, 15, -1.03809, -0.651211, -0.282167),
    (1, 0, 4, 16, -0.298702, 0.119262, 0.558497),
    (3, 8, 2, 12, -0.105439, 0.0153946, 0.135898),
    (3, 4, 4, 8, -0.142891, 0.0258736, 0.200632),
    (4, 0, 3, 5, -0.826319, -0.590612, -0.368214),
    (1, 2, 2, 9, -0.557409, -0.233035, 0.0534525),
    (2, 7, 3, 4, -0.0646826, 0.00620476, 0.0784847),
    (2, 6, 2, 16, -0.192387, -0.029699, 0.215855),
    (2, 1, 3, 2, -0.0397818, -0.00568076, 0.0292026),
    (5, 10, 1, 15, -0.53823, -0.369934, -0.190235),
    (3, 6, 2, 10, -0.124877, 0.0296483, 0.139239),
    (2, 1, 1, 14, -0.101475, 0.0225617, 0.231971),
    (3, 5, 6, 4, -0.0799915, -0.00729616, 0.063262),
    (1, 9, 2, 12, -0.272556, 0.019424, 0.302559),
    (3, 4, 2, 14, -0.164292, -0.0321188, 0.0846339),
)
WIDEST = 16
#: Least votes for an offset and least overlap for a match, in integers.
VOTES, OVERLAP = 3, 16
#: Integers of query classes in a block; classes that one task streams past a block.
BLOCK, SLICE = 2_000_000, 20_000
#: Pairs of equal integers that are written out at once.
EXPAND = 1 << 20


def wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    """16-bit mono WAV of samples in -1..1."""
    data = (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data


def samples(recording: bytes | None) -> np.ndarray:
    """Mono samples at RATE of a 16-bit PCM WAV; none for null, empty or other content."""
    none = np.empty(0, dtype=np.float64)
    if not recording or recording[:4] != b"RIFF" or recording[8:12] != b"WAVE":
        return none
    at, channels, rate = 12, 0, 0
    while at + 8 <= len(recording):
        kind, size = recording[at : at + 4], struct.unpack_from("<I", recording, at + 4)[0]
        body = recording[at + 8 : at + 8 + size]
        if kind == b"fmt " and len(body) >= 16:
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", body)
            if code != 1 or bits != 16 or not channels or not rate:
                return none
        elif kind == b"data" and channels:
            x = np.frombuffer(body[: len(body) // (2 * channels) * 2 * channels], dtype="<i2").reshape(-1, channels).mean(axis=1) / 32768
            if rate != RATE and len(x):
                x = np.interp(np.arange(0, len(x), rate / RATE), np.arange(len(x)), x)
            return x
        at += 8 + size + size % 2
    return none


_bins = np.arange(FRAME // 2 + 1) * (RATE / FRAME)
_used = np.flatnonzero((_bins >= LOW) & (_bins < HIGH))
#: Pitch class of each used bin, A as 0.
_fold = np.zeros((len(_used), 12))
_fold[np.arange(len(_used)), np.floor(12 * np.log2(_bins[_used] / 27.5)).astype(int) % 12] = 1.0
_window = np.hamming(FRAME)


def chroma(x: np.ndarray) -> np.ndarray:
    """Smoothed, normalised picture: a row of 12 pitch classes for each frame. Quiet rows are zero."""
    n = (len(x) - FRAME) // HOP + 1
    if n < len(SMOOTH):
        return np.empty((0, 12))
    rows = []
    for at in range(0, n, 256):  # long recordings in blocks
        frames = np.lib.stride_tricks.as_strided(x[at * HOP :], (min(256, n - at), FRAME), (x.strides[0] * HOP, x.strides[0]))
        power = np.abs(np.fft.rfft(frames * _window, axis=1)[:, _used]) ** 2
        rows.append(power @ _fold)
    raw = np.concatenate(rows)
    m = len(raw) - len(SMOOTH) + 1
    soft = sum(c * raw[k : k + m] for k, c in enumerate(SMOOTH))
    norm = np.sqrt((soft * soft).sum(axis=1, keepdims=True))
    return np.where(norm > 0.01, soft / np.maximum(norm, 0.01), 0.0)


def fingerprint(x: np.ndarray) -> np.ndarray:
    """Packed integers (uint32) of mono samples; none for recordings too short for the widest filter."""
    picture = chroma(x)
    n = len(picture) - WIDEST + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint32)
    total = np.zeros((len(picture) + 1, 13))
    total[1:, 1:] = picture.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def area(x0: int, x1: int, y0: int, y1: int) -> np.ndarray:
        return total[t + x1, y1] - total[t + x0, y1] - total[t + x1, y0] + total[t + x0, y0]

    out = np.zeros(n, dtype=np.uint32)
    for kind, y, h, w, *bounds in FILTERS:
        h2, w2, h3, w3 = h // 2, w // 2, h // 3, w // 3
        whole = area(0, w, y, y + h)
        if kind == 0:
            a = whole
        elif kind == 1:
            a = area(0, w, y + h2, y + h)
        elif kind == 2:
            a = area(w2, w, y, y + h)
        elif kind == 3:
            a = area(0, w2, y + h2, y + h) + area(w2, w, y, y + h2)
        elif kind == 4:
            a = area(0, w, y + h3, y + 2 * h3)
        else:
            a = area(w3, 2 * w3, y, y + h)
        value = np.log1p(a) - (0.0 if kind == 0 else np.log1p(np.maximum(whole - a, 0.0)))
        level = np.searchsorted(bounds, value, side="right").astype(np.uint32)
        out = out << np.uint32(2) | level ^ level >> np.uint32(1)
    return out


def votes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, votes): for each place of a minus place of b at which equal integers stand, how many do.

    Rare integers vote pair by pair, at most EXPAND pairs at a time; an integer whose pairs would cost more than a
    Fourier transform is correlated. Either way the counts are exact.
    """
    kinds, of_a = np.unique(a, return_inverse=True)
    at = np.searchsorted(kinds, b)
    there = kinds[np.minimum(at, len(kinds) - 1)] == b if len(kinds) else np.zeros(len(b), dtype=bool)
    of_b, place_b = at[there], np.flatnonzero(there)
    n_a, n_b = np.bincount(of_a, minlength=len(kinds)), np.bincount(of_b, minlength=len(kinds))
    width = 1 << max(1, (len(a) + len(b)).bit_length())
    heavy = n_a * n_b > 4 * width * width.bit_length()
    total = np.zeros(len(a) + len(b), dtype=np.int64)
    if heavy.any():
        summed = np.zeros(width // 2 + 1, dtype=np.complex128)
        for kind in np.flatnonzero(heavy):
            mark_b = np.zeros(len(b))
            mark_b[place_b[of_b == kind]] = 1.0
            summed += np.fft.rfft((of_a == kind).astype(float), width) * np.conj(np.fft.rfft(mark_b, width))
        found = np.rint(np.fft.irfft(summed, width)).astype(np.int64)
        total[len(b) :] += found[: len(a)]
        total[: len(b)] += found[width - len(b) :]
    order = np.argsort(of_a, kind="stable")
    first = np.r_[0, np.cumsum(n_a)]
    light = np.flatnonzero(~heavy[of_b])
    of_b, place_b = of_b[light], place_b[light]
    n = n_a[of_b]
    for group in np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // EXPAND)) + 1):
        some = n[group]
        if m := int(some.sum()):
            k = np.repeat(first[of_b[group]] + some - np.cumsum(some), some) + np.arange(m)
            total += np.bincount(order[k] - np.repeat(place_b[group], some) + len(b), minlength=len(total))
    offsets = np.flatnonzero(total)
    return offsets - len(b), total[offsets]


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, float] | None:
    """(offset, votes, share of wrong bits): b's position p is a's position p + offset. None below VOTES or OVERLAP."""
    if not len(a) or not len(b):
        return None
    offsets, found = votes(a, b)
    return _judge(a, b, offsets, found) if len(offsets) else None


def _judge(a: np.ndarray, b: np.ndarray, offsets: np.ndarray, votes: np.ndarray) -> tuple[int, int, float] | None:
    best = np.lexsort((offsets, np.abs(offsets), -votes))[0]
    off, v = int(offsets[best]), int(votes[best])
    start, stop = max(0, off), min(len(a), len(b) + off)
    if v < VOTES or stop - start < OVERLAP:
        return None
    wrong = int(np.bitwise_count(a[start:stop] ^ b[start - off : stop - off]).sum())
    return off, v, wrong / (32 * (stop - start))


class _Block:
    """Inverted index of one block of queries."""

    def __init__(self, ids: list[int], prints: list[np.ndarray]):
        self.ids, self.prints = ids, prints
        codes = np.concatenate(prints) if prints else np.empty(0, np.uint32)
        order = np.argsort(codes, kind="stable")
        self.codes = codes[order]
        self.query = np.repeat(np.arange(len(prints)), [len(p) for p in prints])[order]
        self.place = np.concatenate([np.arange(len(p)) for p in prints])[order] if prints else np.empty(0, np.int64)
        self.best: list[tuple] = [(2.0, 0, 0, 0, 0)] * len(ids)

    def see(self, other: int, b: np.ndarray) -> None:
        """Hold one class against all queries; keep each query's best: fewest bit errors, most votes, smallest id."""
        lo, hi = np.searchsorted(self.codes, b, "left"), np.searchsorted(self.codes, b, "right")
        n = hi - lo
        if n.sum() < VOTES:
            return
        if n.sum() > EXPAND:  # query by query, each within bounds
            kinds = np.unique(b)
            runs = zip(np.searchsorted(self.codes, kinds, "left"), np.searchsorted(self.codes, kinds, "right"))
            for q in np.unique(np.concatenate([self.query[i:j] for i, j in runs])):
                self._keep(q, other, align(self.prints[q], b))
            return
        at = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
        key = self.query[at].astype(np.int64) << 32 | (self.place[at] - np.repeat(np.arange(len(b)), n) + (1 << 31))
        key, found = np.unique(key, return_counts=True)
        query, offset = key >> 32, (key & 0xFFFFFFFF) - (1 << 31)
        for q in np.unique(query[found >= VOTES]):
            mine = query == q
            self._keep(q, other, _judge(self.prints[q], b, offset[mine], found[mine]))

    def _keep(self, q: int, other: int, got: tuple[int, int, float] | None) -> None:
        if got and self.ids[q] != other:
            off, v, wrong = got
            self.best[q] = min(self.best[q], (wrong, -v, other, off, 1))


def _search():
    out = arrow_schema("class_id long, bit_error double, votes long, match_class long, match_offset long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, prints, block = None, [], [], None

        def results():
            rows = [(i, b[0], -b[1], b[2], b[3]) for i, b in zip(block.ids, block.best) if b[4]] if block else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], out.field(k).type) for k in range(5)], schema=out)

        for batch in batches:
            for blk, part, is_row, cid, codes in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4)):
                if (blk, part) != group:
                    yield from results()
                    group, ids, prints, block = (blk, part), [], [], None
                own = codes.values.to_numpy(zero_copy_only=False).astype(np.uint32)
                if not is_row:
                    ids.append(cid)
                    prints.append(own)
                    continue
                block = block or _Block(ids, prints)
                block.see(cid, own)
        yield from results()

    return run


def fingerprints(recordings: DataFrame, id_col: str, audio) -> DataFrame:
    """(rec_id, n_samples, codes array<long>) of each row. audio: (columns, function of their values -> WAV bytes), for recordings made on the way."""
    inputs, make = audio
    out = arrow_schema("rec_id long, n_samples long, codes array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids, values = part.column(0).to_pylist(), zip(*(c.to_pylist() for c in part.columns[1:]))
                sizes, codes = [], []
                for v in values:
                    x = samples(make(*v))
                    sizes.append(len(x))
                    codes.append(fingerprint(x).tolist())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(codes, out.field(2).type)], schema=out)

    return recordings.select(F.col(id_col).cast("long"), *inputs).mapInArrow(run, "rec_id long, n_samples long, codes array<long>")


def _same(x: bytes) -> bytes:
    return x


def match(recordings: DataFrame, queries: Column, id_col: str, audio_col: str | None = None, audio=None) -> DataFrame:
    """One row for each recording: rec_id, n_samples, n_codes, codes_crc32, class_id, copies, and for queries the best match.

    class_id: the smallest id with the same fingerprint (null ids aside), copies: how many rows have it. For rows where
    `queries` (over rec_id) holds: match_class, match_offset, votes and bit_error of the best other class; null if
    none reaches VOTES equal integers at one offset and OVERLAP common positions. Null, empty or silent recordings and
    those too short have fingerprints without integers, form one class and match nothing.
    """
    rows = written(fingerprints(recordings, id_col, audio or ([audio_col], _same)), "fingerprints")
    rows = rows.withColumn("asks", F.coalesce(queries, F.lit(False)))
    found = rows.groupBy("codes").agg(F.min("rec_id").alias("class_id"), F.count("*").alias("copies"), F.max("asks").alias("asks"))
    found = written(found, "classes")
    usable = found.where((F.size("codes") > 0) & F.col("class_id").isNotNull())
    size = usable.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("asks"), F.size("codes"))), F.lit(0)).alias("q")).first()
    blocks, parts = max(1, -(-size["q"] // BLOCK)), max(1, -(-size["n"] // SLICE))
    place = F.pmod(F.xxhash64("class_id"), F.lit(blocks).cast("long")).cast("int")
    asks = usable.where("asks").select(place.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("is_row"), "class_id", "codes")
    part = F.pmod(F.xxhash64("class_id", F.lit(1)), F.lit(parts).cast("long")).cast("int")
    seen = usable.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"), F.lit(1).alias("is_row"), "class_id", "codes")
    both = asks.union(seen).repartition("block", "part").sortWithinPartitions("block", "part", "is_row", "class_id")
    near = both.mapInArrow(_search(), "class_id long, bit_error double, votes long, match_class long, match_offset long")
    best = near.groupBy("class_id").agg(F.min(F.struct("bit_error", (-F.col("votes")).alias("v"), "match_class", "match_offset")).alias("b"))
    named = found.join(best, "class_id", "left").select(F.col("codes").alias("c_codes"), "class_id", "copies", "b")
    out = rows.join(named, rows.codes == named.c_codes)
    b = {c: F.when(F.col("asks"), F.col(f"b.{c}")) for c in ("match_class", "match_offset", "bit_error")}
    packed = F.crc32(F.concat_ws(",", F.col("codes").cast("array<string>")).cast("binary"))
    return out.select("rec_id", "n_samples", F.size("codes").cast("long").alias("n_codes"), packed.alias("codes_crc32"), "class_id", "copies", b["match_class"].alias("match_class"), b["match_offset"].alias("match_offset"), F.when(F.col("asks"), -F.col("b.v")).alias("votes"), b["bit_error"].alias("bit_error"))


_tones: dict[int, np.ndarray] = {}
NOTE = 2_048


def tone_row(vector: list[float] | None) -> bytes | None:
    """A vector as a recording: a note for each component, two octaves wide; null where the vector isn't finite."""
    if not vector or any(v is None or v != v or abs(v) == float("inf") for v in vector):
        return None
    if not _tones:
        t, fade = np.arange(NOTE) / RATE, np.minimum(1.0, np.minimum(np.arange(NOTE), np.arange(NOTE)[::-1]) / 128)
        for k in range(24):
            f = 220.0 * 2 ** (k / 12)
            _tones[k] = 0.5 * fade * (np.sin(2 * np.pi * f * t) + 0.4 * np.sin(4 * np.pi * f * t))
    return wav(np.concatenate([_tones[min(23, max(0, int((v + 0.4) * 30)))] for v in vector]))
