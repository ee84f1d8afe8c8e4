"""Fuzzy line deduplication by MinHash.

1. A line (trimmed; A-Z lower-cased) is a class by the 64-bit hash of its characters, so exact repeats are one class.
2. Its character shingles fill the bins of a one-permutation MinHash signature; empty bins borrow from full ones, drawn at
   random but alike for all lines, so that the bins of a band stay apart. Bands of five bins give 13 keys: lines at a similarity of 0.8 meet in one with a chance above 0.99.
3. Classes of one band key are a bucket; keys that hold the same classes are one. A bucket is split where the signatures of its
   long lines, four bits a bin, are far from alike: most buckets hold lines that met by chance. Equal parts are one.
4. A class's line is sent to each of its parts. In a part all pairs are compared exactly by the Jaccard similarity of their shingle
   sets, a large one in pairs of blocks. Nothing is compared that met in no band. Alternating star steps join the true links to components.
5. Of each component the occurrence with the smallest (doc_id, line number) stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from opspark.llm.common import _BASE, _BASE_INVERSE, _powers, chunks, components, mix, small_batches, table, texts_of
from opspark.llm.ngram_join import _batch, linked
from opspark.session import bounded_broadcast, cut_lineage

#: Characters in a shingle; a shorter line is one shingle.
SHINGLE = 5
BANDS, ROWS = 13, 5
PERCENT = 80

#: Band keys are dealt to parts by so many bits, of which a task holds one part at a time; so many entries are packed at once.
PART_BITS = 12
PACKED = 1 << 20

#: Two lines that fill at least so many bins of their own are held apart when fewer of 64 bins agree in four bits. At a similarity of 0.8
#: about 51 agree, give or take 4, so that 28 lies some six deviations below; lines that met by chance agree in about 12.
SKETCHED, AGREE = 50, 28

#: Rows of small buckets whose sketches are compared at once.
SKETCH_ROWS = 1 << 15

#: Bytes of text whose lines are handled at once: their arrays, eight bytes a character, stay near the processor.
LINE_BYTES = 1 << 18

#: Bounds of a block of a bucket.
BLOCK_LINES = 512
BLOCK_BYTES = 2_000_000

#: Buckets of at most so many classes are compared many at once.
SMALL = 32
COMPARED_BYTES = 1 << 16

#: The largest size, as a power of two, of the bits that tell which lines are sent.
MAX_BITS = 26

_BINS = BANDS * ROWS
#: The value of each letter of the basic plane; A-Z count as a-z.
_LETTER = mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(0x51ED27))
_LETTER[65:91] = _LETTER[97:123]
#: Bins that an empty bin asks in turn.
_DONORS = np.random.default_rng(17).integers(0, _BINS, (48, _BINS))


class Lines:
    """The lines of a chunk of texts: text number, line number, place, and the running hash of the characters."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.text = data.tobytes().decode("utf-8", "replace")
        letters = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        at = offsets - np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), offsets)
        rows, n = len(offsets) - 1, len(letters)
        breaks = np.flatnonzero(letters == 10)
        # in order of place the lines of all texts follow each other, and so do their ends
        starts = np.sort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([at[1:], breaks]), kind="stable")
        self.row = np.repeat(np.arange(rows), 1 + np.diff(np.searchsorted(breaks, at)))
        first = np.searchsorted(self.row, np.arange(rows))
        self.number = np.arange(len(self.row)) - first[self.row] if rows else self.row
        space = (letters == 32) | (letters - np.uint32(9) <= 4)
        self.start, self.end, self.blank = starts, ends, starts >= ends
        some = np.flatnonzero(~self.blank)
        outer = some[space[starts[some]] | space[ends[some] - 1]]
        if len(outer):  # the others have nothing to trim
            solid = np.flatnonzero(~space)
            left, right = np.searchsorted(solid, starts[outer]), np.searchsorted(solid, ends[outer])
            self.blank[outer] = left >= right
            padded = np.append(solid, n)
            self.start[outer] = np.where(left >= right, starts[outer], padded[left])
            self.end[outer] = np.where(left >= right, starts[outer], padded[np.maximum(right - 1, 0)] + 1)
        self.letters = letters
        value = np.take(_LETTER, letters, mode="clip")
        far = np.flatnonzero(letters >= len(_LETTER))
        value[far] = mix(letters[far].astype(np.uint64) + np.uint64(0x51ED27))
        value *= _powers(_BASE, "up", n)
        self.running = np.zeros(n + 1, np.uint64)
        np.cumsum(value, out=self.running[1:], dtype=np.uint64)
        self.down = _powers(_BASE_INVERSE, "down", n + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.running[ends] - self.running[starts]) * self.down[starts])

    def names(self) -> np.ndarray:
        return (self.hashes(self.start, self.end) ^ (self.end - self.start).astype(np.uint64)).view(np.int64)

    def shingles(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of the chosen lines, given in order of place, and how many each has."""
        start, length = self.start[which], self.end[which] - self.start[which]
        many = np.maximum(length - SHINGLE + 1, 1)
        long = length >= SHINGLE
        if not long.any():
            return self.hashes(start, start + length), many
        # the places of the long lines, between those that start no shingle of theirs, are hashed by whole arrays
        edge = np.stack([start[long], start[long] + many[long]], 1).ravel()
        held = np.repeat(np.arange(len(edge)) % 2 == 1, np.diff(edge, prepend=0))
        held = np.append(held, np.zeros(len(self.letters) - SHINGLE + 1 - len(held), bool))
        got = self.running[SHINGLE:] - self.running[:-SHINGLE]
        got *= self.down[: len(got)]
        got = mix(got[held])
        if long.all():
            return got, many
        out = np.empty(many.sum(), np.uint64)
        out[np.repeat(long, many)] = got
        short = np.flatnonzero(~long)
        out[(np.cumsum(many) - many)[short]] = self.hashes(start[short], start[short] + length[short])
        return out, many


def _chunked(column: pa.Array) -> Iterator[tuple[int, Lines]]:
    data, offsets = texts_of(column)
    for start, stop in chunks(offsets, LINE_BYTES):
        part = offsets[start : stop + 1]
        yield start, Lines(data[part[0] : part[-1]], part - part[0])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, line, class, row) of each line; class is null for a blank one, row is a number of the text's own."""
    base = TaskContext.get().partitionId() << 40
    for b in batches:
        ids = b.column("doc_id")
        for start, lines in _chunked(b.column("text")):
            yield _batch({
                "doc_id": ids.take(pa.array(lines.row + start)), "line": pa.array(lines.number, pa.int32()),
                "class": pa.array(lines.names(), pa.int64(), mask=lines.blank),
                "row": pa.array(lines.row + (base + start), pa.int64())})
        base += len(ids)


def signature(hashes: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation MinHash (lines, bins), and how many bins a line fills itself.

    The upper half of a hash gives the bin, the lower half the value; an empty bin borrows from a full one, drawn alike for all lines.
    """
    place = hashes >> np.uint64(32)
    place *= np.uint64(_BINS)
    place >>= np.uint64(32)
    place += np.repeat(np.arange(len(many), dtype=np.uint64) * np.uint64(_BINS), many)
    out = np.full(len(many) * _BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(out, place.view(np.int64), hashes & np.uint64(0xFFFFFFFF))
    full = (out != np.iinfo(np.uint64).max).reshape(len(many), _BINS)
    donor = np.tile(np.arange(_BINS), len(many))
    empty = np.flatnonzero(~full.ravel())
    for draw in _DONORS:
        if not len(empty):
            break
        row, drawn = empty // _BINS, draw[empty % _BINS]
        got = full[row, drawn]
        donor[empty[got]] = drawn[got]
        empty = empty[~got]
    if len(empty):  # few bins are full: the next one gives
        row = empty // _BINS
        place = np.where(np.concatenate([full, full], 1), np.arange(2 * _BINS), 4 * _BINS)
        nearest = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :_BINS]
        donor[empty] = nearest.ravel()[empty] % _BINS
    donor = donor.reshape(len(many), _BINS)
    donor += np.arange(0, len(out), _BINS)[:, None]
    return mix(out[donor]), full.sum(1)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, class) of each class, once in a partition."""
    seen: set[int] = set()
    for b in batches:
        for _, lines in _chunked(b.column("text")):
            every = lines.names()
            names, first = np.unique(every, return_index=True)
            blank = lines.blank[first].tolist()
            first = np.array(sorted(i for n, i, none in zip(names.tolist(), first.tolist(), blank) if not none and n not in seen), np.int64)
            if not len(first):
                continue
            names = every[first]
            seen.update(names.tolist())
            sign = signature(*lines.shingles(first))[0].reshape(len(first), BANDS, ROWS)
            band = np.zeros((len(first), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                band = mix(band * np.uint64(0xD6E8FEB86659FD93) + sign[:, :, r])
            yield _batch({"band": band.ravel().view(np.int64), "class": np.repeat(names, BANDS)})


def _packed(bands: list[np.ndarray], names: list[np.ndarray]) -> pa.RecordBatch:
    """(part, keys, names): the entries of each part, 32 bits of the band key and the class."""
    band, name = np.concatenate(bands), np.concatenate(names)
    part = (band >> np.uint64(64 - PART_BITS)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    present, starts = np.unique(part[order], return_index=True)
    ends = np.append(starts, len(part))
    key = (band[order] >> np.uint64(32 - PART_BITS)).astype(np.uint32)
    blobs = [pa.Array.from_buffers(pa.binary(), len(present), [None, pa.py_buffer((ends * v.itemsize).astype(np.int32)), pa.py_buffer(v)])
             for v in (key, np.ascontiguousarray(name[order]))]
    return _batch({"part": present.astype(np.int32), "keys": blobs[0], "names": blobs[1]})


def _packed_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The band keys of each class, once in a partition, packed by part."""
    bands, names, held = [], [], 0
    for b in _bands(batches):
        bands.append(b.column("band").to_numpy().view(np.uint64))
        names.append(b.column("class").to_numpy())
        held += len(names[-1])
        if held >= PACKED:
            yield _packed(bands, names)
            bands, names, held = [], [], 0
    if held:
        yield _packed(bands, names)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, class) of the bands that several classes share, each once, from rows sorted by (band, class).

    All that is carried from batch to batch is the last row, and whether it was given.
    """
    carried, given = None, False
    for b in batches:
        bands, names = (b.column(c).to_numpy() for c in ("band", "class"))
        if not len(bands):
            continue
        if carried:
            bands, names = np.concatenate([carried[0], bands]), np.concatenate([carried[1], names])
        new = np.ones(len(bands), bool)
        new[1:] = (bands[1:] != bands[:-1]) | (names[1:] != names[:-1])
        bands, names = bands[new], names[new]
        same = bands[1:] == bands[:-1]
        shared = np.zeros(len(bands), bool)
        shared[1:] |= same
        shared[:-1] |= same
        last = shared[-1] or given and len(bands) == 1
        if given:
            shared[0] = False
        if shared.any():
            yield _batch({"band": bands[shared], "class": names[shared]})
        carried, given = (bands[-1:], names[-1:]), bool(last)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, class) of the keys that stand several times in a part, sorted, from rows sorted by part."""
    def entries(part: int, keys: list[bytes], names: list[bytes]) -> pa.RecordBatch:
        key, name = np.frombuffer(b"".join(keys), np.uint32), np.frombuffer(b"".join(names), np.int64)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        # most keys stand once; only the others are sorted by class, too
        often = order[np.append(same, False) | np.append(False, same)]
        often = often[np.lexsort((name[often], key[often]))]
        return _batch({"band": (part << 32) + key[often].astype(np.int64), "class": name[often]})

    held, keys, names = None, [], []
    for b in batches:
        for part, key, name in zip(*(b.column(c).to_pylist() for c in ("part", "keys", "names"))):
            if part != held:
                if keys:
                    yield entries(held, keys, names)
                held, keys, names = part, [], []
            keys.append(key)
            names.append(name)
    if keys:
        yield entries(held, keys, names)


def _met_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _met(_unpacked(batches))


def _class_bits(members: DataFrame) -> np.ndarray:
    """Bits that tell whether a class may be in ``members``, sixteen a class, 2^26 at most; a join settles the rest."""
    classes = members.select("class").distinct()
    size = 1 << min(max((16 * classes.count()).bit_length(), 16), MAX_BITS)
    place = F.pmod("class", F.lit(size))
    words = np.zeros(size // 64, np.uint64)
    for r in classes.groupBy(F.floor(place / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(class, {size}) % 64 AS INT))")).alias("bits")
    ).collect():  # size / 64 rows
        words[r["word"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return words


#: Agreeing halves of a byte of two sketches, by the byte's exclusive or.
_ALIKE = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)
_SKETCH = ("s0", "s1", "s2", "s3")


def _sketches(lines: Lines, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four bits of each of 64 bins of the chosen lines as four longs, and how many bins each fills itself."""
    sign, full = signature(*lines.shingles(which))
    bits = sign[:, :64].astype(np.uint8) & np.uint8(15)
    return np.ascontiguousarray(bits[:, ::2] | bits[:, 1::2] << 4).view(np.int64), full


def _line_texts(bits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, line, sketch, full) of the trimmed lines whose bit is set, once in a partition: a line is an eighth of its hashes."""
    words, seen = bits.value, set()
    for b in batches:
        for _, lines in _chunked(b.column("text")):
            every = lines.names()
            place = every.view(np.uint64) & np.uint64(64 * len(words) - 1)
            hit = (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool) & ~lines.blank
            chosen = []
            for i, name in zip(np.flatnonzero(hit).tolist(), every[hit].tolist()):
                if name not in seen:
                    seen.add(name)
                    chosen.append(i)
            if not chosen:
                continue
            sketch, full = _sketches(lines, np.array(chosen))
            found = [lines.text[i:j] for i, j in zip(lines.start[chosen].tolist(), lines.end[chosen].tolist())]
            yield _batch({"class": every[chosen], "line": pa.array(found, pa.string()),
                          **{c: np.ascontiguousarray(sketch[:, k]) for k, c in enumerate(_SKETCH)}, "full": full})


def alike(bucket: np.ndarray, sketch: np.ndarray, full: np.ndarray) -> np.ndarray:
    """(i, j) of the rows of one bucket whose sketches do not rule out that the lines are similar; rows of a bucket stand together."""
    view, at, step, out = sketch.view(np.uint8).reshape(len(bucket), -1), np.arange(len(bucket)), 0, []
    while True:
        step += 1
        at = at[at + step < len(bucket)]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            break
        near = (full[at] < SKETCHED) | (full[at + step] < SKETCHED)
        near |= _ALIKE[view[at] ^ view[at + step]].sum(1) >= AGREE
        out.append(np.stack([at[near], at[near] + step], 1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, class) with each bucket split into what its sketches connect, from rows sorted by bucket, many buckets at once."""
    names = ("bucket", "class", *_SKETCH, "full")

    def parts(held: np.ndarray) -> pa.RecordBatch | None:
        pairs = alike(held[0], np.ascontiguousarray(held[2:6].T), held[6])
        if not len(pairs):
            return None
        label = _smallest(pairs, held.shape[1])
        at = np.flatnonzero(np.bincount(label, minlength=held.shape[1])[label] > 1)
        part = mix(mix(held[0].view(np.uint64)) ^ held[1].view(np.uint64)[label])[at]
        return _batch({"bucket": part.view(np.int64), "class": held[1][at]})

    held = np.zeros((len(names), 0), np.int64)
    for b in batches:
        held = np.concatenate([held, np.stack([b.column(c).to_numpy() for c in names])], 1)
        if held.shape[1] >= SKETCH_ROWS:
            whole = int(np.searchsorted(held[0], held[0, -1]))
            if whole and (got := parts(np.ascontiguousarray(held[:, :whole]))) is not None:
                yield got
            held = held[:, whole:]
    if held.shape[1] and (got := parts(np.ascontiguousarray(held))) is not None:
        yield got


def _shingles_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of lines, and how many each has."""
    data, offsets = texts_of(pa.array(texts, pa.large_string()))
    parts = []
    for start, stop in chunks(offsets, LINE_BYTES):
        part = offsets[start : stop + 1]
        parts.append(Lines(data[part[0] : part[-1]], part - part[0]).shingles(np.arange(stop - start)))
    return np.concatenate([h for h, _ in parts]), np.concatenate([m for _, m in parts])


def line_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of lines."""
    hashes, many = _shingles_of(texts)
    at = np.concatenate([[0], np.cumsum(many)])
    return [np.unique(hashes[at[i] : at[i + 1]]) for i in range(len(many))]


def linked_inside(texts: list[str], group: np.ndarray, percent: int) -> np.ndarray:
    """(i, j) of all similar lines of one group, for many small groups at once; rows of a group stand together."""
    code, many = _shingles_of(texts)
    # shingles of a group by their upper bits, with the line in the lower ones: one sort brings equal ones together and shows repeats
    low_bits = np.uint64(max(len(texts) - 1, 1).bit_length())
    code ^= np.repeat(mix(group.astype(np.uint64) + np.uint64(0x77)), many)
    code >>= low_bits
    code <<= low_bits
    code |= np.repeat(np.arange(len(texts), dtype=np.uint64), many)
    code.sort()
    code = code[np.append(True, code[1:] != code[:-1])]
    row = (code & ((np.uint64(1) << low_bits) - np.uint64(1))).view(np.int64)
    code >>= low_bits
    sizes = np.bincount(row, minlength=len(texts))
    # a cell counts what two lines of a group share
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    m = np.diff(np.append(starts, len(texts)))
    cells = np.concatenate([[0], np.cumsum(m * m)])
    number = np.repeat(np.arange(len(m)), m)
    base = cells[number] + (np.arange(len(texts)) - starts[number]) * m[number] - starts[number]
    shared = np.zeros(cells[-1], np.int64)
    at, step = np.flatnonzero(code[1:] == code[:-1]), 1
    while len(at):
        low, high = row[at], row[at + step]
        inside = number[low] == number[high]
        if not inside.all():
            low, high = low[inside], high[inside]
        shared += np.bincount(base[low] + high, minlength=len(shared))
        step += 1
        at = at[: np.searchsorted(at, len(code) - step)]
        at = at[code[at] == code[at + step]]
    cell = np.flatnonzero(shared)
    g = np.searchsorted(cells, cell, side="right") - 1
    i, j = starts[g] + (cell - cells[g]) // m[g], starts[g] + (cell - cells[g]) % m[g]
    ok = 100 * shared[cell] >= percent * (sizes[i] + sizes[j] - shared[cell])
    return np.stack([i[ok], j[ok]], 1)


def _smallest(pairs: np.ndarray, rows: int) -> np.ndarray:
    """For each row the smallest that it reaches by the pairs."""
    i, j = pairs[:, 0], pairs[:, 1]
    label, before = np.arange(rows), None
    while before is None or (label != before).any():
        before = label.copy()
        np.minimum.at(label, j, before[i])
        np.minimum.at(label, i, before[j])
        label = label[label]
    return label


def _stars(pairs: np.ndarray, names: np.ndarray) -> pa.RecordBatch | None:
    """Edges that join the same rows as the pairs do, each row with the smallest it reaches."""
    if not len(pairs):
        return None
    label = _smallest(pairs, len(names))
    at = np.flatnonzero(label != np.arange(len(names)))
    return _batch({"a": names[label[at]], "b": names[at]})


def _verify(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each bucket, from rows sorted by (bucket, low, high): small ones together, large ones alone."""
    small: list[tuple] = []
    unit: list[tuple] = []
    held = 0

    def of_small() -> pa.RecordBatch | None:
        group = np.cumsum([0, *(x[:3] != y[:3] for x, y in zip(small, small[1:]))])
        return _stars(linked_inside([r[4] for r in small], group, percent), np.array([r[3] for r in small]))

    def of_unit() -> pa.RecordBatch | None:
        block = np.array([r[5] for r in unit])
        found = linked(line_sets([r[4] for r in unit]), percent, block == unit[0][1], block == unit[0][2])
        return _stars(found, np.array([r[3] for r in unit]))

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "low", "high", "class", "line", "block"))):
            if unit and unit[0][:3] != row[:3]:
                if len(unit) > SMALL:
                    if (got := of_unit()) is not None:
                        yield got
                elif len(unit) > 1:
                    small += unit
                    held += sum(len(r[4]) for r in unit)
                unit = []
                if held > COMPARED_BYTES:
                    if (got := of_small()) is not None:
                        yield got
                    small, held = [], 0
            unit.append(row)
    if len(unit) > SMALL:
        if (got := of_unit()) is not None:
            yield got
    else:
        small += unit
    if small and (got := of_small()) is not None:
        yield got


def _different(members: DataFrame) -> DataFrame:
    """(bucket, class, m) of (bucket, class) with buckets that hold the same classes taken once; m counts them."""
    digest = [F.count("*").alias("m"), F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "class")).alias("y")]
    buckets = members.groupBy("bucket").agg(*digest).groupBy("m", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "m")
    return cut_lineage(members.join(buckets, "bucket").select("bucket", "class", "m"))


def linked_lines(texts: DataFrame, percent: int) -> DataFrame:
    """(class, root) of every class of lines that is truly linked to another."""
    spark = texts.sparkSession
    met = cut_lineage(
        texts.mapInArrow(_packed_bands, "part int, keys binary, names binary")
        .repartition("part").sortWithinPartitions("part").mapInArrow(_met_packed, "band long, class long"))
    members = _different(met.withColumnRenamed("band", "bucket"))
    bits = spark.sparkContext.broadcast(_class_bits(members))
    sketch = ", ".join(f"{c} long" for c in (*_SKETCH, "full"))
    # dealt out first: few classes stand in several tasks, so that dropping them before would only sort the texts once more
    found = cut_lineage(
        texts.mapInArrow(partial(_line_texts, bits), f"class long, line string, {sketch}")
        .repartition("class").dropDuplicates(["class"]))
    # a bucket of more lines than a block holds is compared as it is, in pairs of blocks
    small = members.where(F.col("m") <= BLOCK_LINES).join(found.select("class", *_SKETCH, "full"), "class").select(
        "bucket", "class", *_SKETCH, "full")
    small = small.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_split, "bucket long, class long")
    members = _different(cut_lineage(members.where(F.col("m") > BLOCK_LINES).select("bucket", "class").unionByName(small))).drop("m")
    sizes = members.join(found.select("class", F.octet_length("line").alias("n")), "class").groupBy("bucket").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_LINES)).cast("int").alias("blocks"))
    large = bounded_broadcast(cut_lineage(sizes.where("blocks > 1")))
    key = ["bucket", "low", "high"]
    meets = (
        members.join(large, "bucket", "left").fillna(1, ["blocks"]).join(found, "class")
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "line", "block")
    )
    links = meets.repartition(*key).sortWithinPartitions(*key).mapInArrow(partial(_verify, percent), "a long, b long")
    return components(links).select(F.col("node").alias("class"), F.col("component").alias("root"))


def _decided(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, line, class, row) of every line, and (named, root, stays) of the classes that stand more than once or are linked."""
    lines = cut_lineage(texts.mapInArrow(_occurrences, "doc_id long, line int, class long, row long"))
    classes = lines.where("class is not null").groupBy("class").agg(F.min(_place()).alias("first"), F.count("*").alias("copies"))
    joined = linked_lines(texts.select("text"), percent)
    classes = classes.join(joined, "class", "left").where("copies > 1 or root is not null").withColumn("root", F.coalesce("root", "class"))
    classes = cut_lineage(classes)
    roots = classes.groupBy("root").agg(F.min("first").alias("stays"))
    return lines, cut_lineage(classes.join(cut_lineage(roots), "root").select(F.col("class").alias("named"), "root", "stays"))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line", "row")


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text")


def fuzzy_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, line, class, kept, component, row) for every line of (doc_id, text); lines end at a line feed.

    ``row`` tells input rows apart, also those with null or repeated ids.

    Null counts as an empty text, which has one blank line. Blank lines are compared with nothing and kept; their class and
    component are null. Of a component one occurrence is kept, that with the smallest (doc_id, line), null ids last; of rows of
    a repeated doc_id that tie there, one. An empty table gives an empty table.
    """
    lines, named = _decided(_texts(docs), percent)
    return lines.join(named, F.col("class") == F.col("named"), "left").select(
        "doc_id", "line", "class", F.coalesce(F.col("stays").eqNullSafe(_place()) | F.col("named").isNull(), F.lit(True)).alias("kept"),
        F.coalesce("root", "class").alias("component"), "row")


def dropped_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_lines, n_kept, dropped) for every row: its lines, and the sorted numbers of those that ``fuzzy_lines`` does not keep.

    Only lines of classes that stand more than once or are linked travel to their class.
    """
    lines, named = _decided(_texts(docs), percent)
    counted = lines.groupBy("row", "doc_id").agg(F.count("*").alias("n_lines"))
    gone = lines.join(named, F.col("class") == F.col("named")).where(~F.col("stays").eqNullSafe(_place())).groupBy(
        F.col("row").alias("of")).agg(F.sort_array(F.collect_list("line")).alias("gone"))
    return counted.join(gone, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_lines", (F.col("n_lines") - F.coalesce(F.size("gone"), F.lit(0))).alias("n_kept"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("dropped"))


def kept_text(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """(doc_id, text): each document with its kept lines only, for unique doc_ids."""
    gone = decided.where("not kept").groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    lines = F.split("text", "\n", -1)
    return docs.select("doc_id", "text").join(gone, "doc_id", "left").select("doc_id", F.when(
        F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")).alias("text"))


def op2_fuzzy_lines(spark, folder: str) -> DataFrame:
    """Lines of each document, and the numbers of those that go because a line like them stays elsewhere."""
    return dropped_lines(table(spark, folder, "documents"))
