"""Counts of 64-bit keys gathered by Spark, kept as sorted arrays in the shared folder, and mapped by workers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import local_path, new_path

PACKED = "bucket int, keys binary, counts binary"
#: Bytes of text whose keys one bucket is made for, so that a bucket fits a task at any size of corpus.
BUCKET_BYTES = 16 << 20
#: Bytes of text whose words are looked at together.
GROUP_BYTES = 2 << 20
#: Parts of a file of short keys at most.
CELLS = 1 << 16
#: Files that one object keeps mapped.
MAPPED = 1024
#: In joined files: keys that share a cell, those of a cell tried one after another before the rest is halved, places marked
#: by one number, and places whose marks one task makes.
IN_CELL, IN_TURN, IN_MARK, IN_RANGE = 4, 4, 32, 1 << 20
#: In a byte: the number is in a list beside.
LARGE = 255


def bucket_count(df: DataFrame, text_col: str) -> int:
    """Buckets for all keys of ``df``'s texts, in proportion to their bytes."""
    size = df.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(8, -(-size // BUCKET_BYTES))


def bucket_of(keys: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """Ranges of equal width over the keys' bits, so buckets in order are sorted as a whole."""
    top = keys >> np.uint64(bits - 32) if bits > 32 else keys << np.uint64(32 - bits)
    return (top * np.uint64(buckets)) >> np.uint64(32)


def start_of(b: int, buckets: int, bits: int) -> int:
    """The smallest key of a bucket."""
    return -(-(b << 32) // buckets) << (bits - 32)


def cells_of(b: int, buckets: int, bits: int) -> int:
    """Of keys under 64 bits a file holds the low 32 of their distance from the bucket's start, and where each value of
    the bits above begins: so many cells. More than ``CELLS`` are not worth it, then keys are kept whole."""
    if bits >= 64:
        return 0
    cells = ((start_of(b + 1, buckets, bits) - start_of(b, buckets, bits)) >> 32) + 1
    return cells if cells <= CELLS else 0


def lower_bound(values: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where in its own range of ``values``, each sorted, every wanted value stands or would."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = values[middle] < wanted[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def to_planes(values: np.ndarray) -> bytes:
    """Byte by byte of all values: sorted keys' leading bytes and small counts then cost next to nothing compressed."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(parts: pd.Series, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(p, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind) for p in parts])


def packed(keys: np.ndarray, counts: np.ndarray, buckets: int, bits: int = 64) -> pd.DataFrame:
    """Sorted distinct keys with counts, as one row a bucket."""
    at = np.searchsorted(bucket_of(keys, buckets, bits), np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(at))
    counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)
    return pd.DataFrame({"bucket": used.astype(np.int32), "keys": [to_planes(keys[at[b] : at[b + 1]]) for b in used], "counts": [to_planes(counts[at[b] : at[b + 1]]) for b in used]})


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Written aside and renamed: a repeated task leaves the same file, a lost one none."""
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(aside, array)
    os.replace(aside, f"{folder}/{name}.npy")


def make_arrays(rows: DataFrame, buckets: int, what: str, least: int = 1, bits: int = 64) -> tuple[SortedArrays, pd.DataFrame]:
    """Merges packed rows bucket by bucket into files; keys counted fewer than ``least`` times are left out.

    Also returns, by bucket, how many keys were kept, the sum of all counts, and how many keys have count 1, 2, 3, 4, and
    ``LARGE`` or more.
    """
    folder = local_path(new_path(rows.sparkSession, what))
    os.makedirs(folder)

    def merge(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        keys, counts = summed(from_planes(batch["keys"], np.uint64), from_planes(batch["counts"], np.uint32).astype(np.int64))
        seen = np.bincount(np.minimum(counts, 5), minlength=6)
        total = int(counts.sum())
        if least > 1:
            keys, counts = keys[counts >= least], counts[counts >= least]
        if cells := cells_of(bucket, buckets, bits):
            far = keys - np.uint64(start_of(bucket, buckets, bits))
            save(folder, f"d{bucket}", np.searchsorted(far >> np.uint64(32), np.arange(cells + 1)).astype(np.uint32))
            keys = far.astype(np.uint32)
        save(folder, f"k{bucket}", keys)
        save(folder, f"c{bucket}", counts.astype(np.min_scalar_type(int(counts.max(initial=0)))))
        return pd.DataFrame({"bucket": [bucket], "n": [len(keys)], "total": [total], **{f"n{k}": [int(seen[k])] for k in range(1, 5)}, "large": [int((counts >= LARGE).sum())]})

    found = rows.groupBy("bucket").applyInPandas(merge, "bucket int, n long, total long, n1 long, n2 long, n3 long, n4 long, large long").toPandas()  # one row a bucket
    sizes = np.zeros(buckets, dtype=np.int64)
    sizes[found["bucket"]] = found["n"]
    return SortedArrays(folder, sizes, bits), found


class SortedArrays:
    """Sorted keys with their counts in files by bucket; a worker maps the files that it looks into, the last few."""

    def __init__(self, folder: str, sizes: np.ndarray, bits: int = 64):
        self.folder, self.sizes, self.bits = folder, sizes, bits
        self.offsets = np.r_[0, np.cumsum(sizes)]
        self.open: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {**vars(self), "open": {}}

    def array(self, name: str) -> np.ndarray:
        found = self.open.pop(name, None)
        if found is None:
            if len(self.open) >= MAPPED:
                del self.open[next(iter(self.open))]
            found = np.load(f"{self.folder}/{name}.npy", mmap_mode="r")
        self.open[name] = found
        return found

    def keys(self, b: int, places: np.ndarray) -> np.ndarray:
        """The keys at places of one bucket."""
        found = self.array(f"k{b}")[places]
        if not cells_of(b, len(self.sizes), self.bits):
            return np.asarray(found)
        cell = np.searchsorted(self.array(f"d{b}"), places, side="right") - 1
        return (cell.astype(np.uint64) << np.uint64(32)) + found + np.uint64(start_of(b, len(self.sizes), self.bits))

    def at(self, places: np.ndarray, name: str = "k") -> np.ndarray:
        """The keys at sorted places, or their counts (``c``)."""
        at, out = np.searchsorted(places, self.offsets), np.zeros(len(places), dtype=np.uint64)
        for b in np.flatnonzero(np.diff(at)):
            local = places[at[b] : at[b + 1]] - self.offsets[b]
            out[at[b] : at[b + 1]] = self.keys(int(b), local) if name == "k" else self.array(f"{name}{b}")[local]
        return out

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: each key's place among all keys, -1 if it is absent, and its count, 0 if it is absent."""
        place, counts = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        at = np.searchsorted(bucket_of(keys, len(self.sizes), self.bits), np.arange(len(self.sizes) + 1))
        for b in np.flatnonzero(np.diff(at)):
            if self.sizes[b]:
                own, here = self.array(f"k{b}"), keys[at[b] : at[b + 1]]
                if cells_of(int(b), len(self.sizes), self.bits):
                    far = here - np.uint64(start_of(int(b), len(self.sizes), self.bits))
                    begin, cell, here = self.array(f"d{b}"), far >> np.uint64(32), far.astype(np.uint32)
                    end = begin[cell + np.uint64(1)].astype(np.int64)
                    i = lower_bound(own, here, begin[cell].astype(np.int64), end)
                    hit = np.flatnonzero(i < end)
                    hit = hit[own[i[hit]] == here[hit]]
                else:
                    i = np.minimum(np.searchsorted(own, here), len(own) - 1)
                    hit = np.flatnonzero(own[i] == here)
                place[at[b] + hit] = self.offsets[b] + i[hit]
                counts[at[b] + hit] = self.array(f"c{b}")[i[hit]]
        return place, counts


def in_tasks(spark: SparkSession, n: int, work: Callable[[int], int]) -> np.ndarray:
    """``work`` of the numbers up to ``n``, in Spark's tasks; returns what each gave."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "gave": [work(int(i)) for i in batch["id"]]})

    out = np.zeros(n, dtype=np.int64)
    if n:
        found = spark.range(0, n, 1, min(n, 4 * spark.sparkContext.defaultParallelism)).mapInPandas(run, "id long, gave long").toPandas()  # one row a bucket
        out[found["id"]] = found["gave"]
    return out


def reserve(folder: str, name: str, size: int) -> None:
    """An empty file of so many bytes, into which tasks put their parts."""
    with open(f"{folder}/{name}", "wb") as f:
        f.truncate(size)


def put(folder: str, name: str, at: int, values: np.ndarray) -> None:
    """Values from a place on; a repeated task writes the same."""
    with open(f"{folder}/{name}", "r+b") as f:
        f.seek(at * values.itemsize)
        f.write(values.tobytes())


def in_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a byte each, and where they are ``LARGE`` or more; those belong into a list beside."""
    return np.minimum(values, LARGE).astype(np.uint8), np.flatnonzero(values >= LARGE)


class JoinedArrays:
    """Sorted keys with their counts in one file of each kind: a lookup takes the same steps at any number of buckets.

    The leading bits of a key name its cell; a file holds where each begins. Of the keys themselves the low 32 bits are
    kept if these cells are no more than the keys, else the whole. Numbers are bytes with lists of the large ones.
    """

    def __init__(self, parts: SortedArrays, found: pd.DataFrame):
        large = found.set_index("bucket")["large"].reindex(range(len(parts.sizes)), fill_value=0)
        self.folder, self.bits, self.n = parts.folder, parts.bits, int(parts.offsets[-1])
        self.marked = np.zeros(1, dtype=np.int64)
        least, few = max(0, self.bits - 32), max(1, (self.n // IN_CELL).bit_length())
        self.short = 1 << least <= self.n
        self.shift = self.bits - min(self.bits, max(least, few) if self.short else few)
        self.cells = 1 << (self.bits - self.shift)
        self.key_kind = np.uint32 if self.short else np.uint64
        self.place_kind = np.uint32 if self.n < 2**32 else np.uint64
        self.open: dict[str, np.ndarray] = {}
        self._join(parts, np.r_[0, np.cumsum(large)])

    def __getstate__(self) -> dict:
        return {**vars(self), "open": {}}

    def _join(self, parts: SortedArrays, large: np.ndarray) -> None:
        """Moves every bucket's files into the joined ones."""
        folder, offsets, buckets, bits, shift = self.folder, parts.offsets, len(parts.sizes), self.bits, self.shift
        key_kind, place_kind, n, short = self.key_kind, self.place_kind, self.n, self.short
        for name, size in (("keys", n * np.dtype(key_kind).itemsize), ("begin", (self.cells + 1) * np.dtype(place_kind).itemsize), ("counts", n), ("counts-at", int(large[-1]) * 8), ("counts-large", int(large[-1]) * 8)):
            reserve(folder, name, size)

        def move(b: int) -> int:
            keys = np.zeros(0, dtype=np.uint64)
            if parts.sizes[b]:
                try:
                    keys, counts = parts.keys(b, np.arange(parts.sizes[b])), np.array(parts.array(f"c{b}"))
                except FileNotFoundError:  # the task ran before and has moved them
                    return 0
                parts.open.clear()
                small, at = in_bytes(counts)
                put(folder, "keys", int(offsets[b]), (keys & np.uint64((1 << shift) - 1) if short else keys).astype(key_kind))
                put(folder, "counts", int(offsets[b]), small)
                put(folder, "counts-at", int(large[b]), at + offsets[b])
                put(folder, "counts-large", int(large[b]), counts[at].astype(np.int64))
            first, end = (-(-start_of(x, buckets, bits) >> shift) for x in (b, b + 1))
            begin = np.searchsorted(keys, np.arange(first, end, dtype=np.uint64) << np.uint64(shift)) + offsets[b]
            put(folder, "begin", first, (np.r_[begin, n] if b == buckets - 1 else begin).astype(place_kind))
            for name in (f"k{b}", f"c{b}", f"d{b}"):
                if os.path.exists(f"{folder}/{name}.npy"):
                    os.remove(f"{folder}/{name}.npy")
            return 0

        in_tasks(SparkSession.active(), buckets, move)

    def array(self, name: str, kind: type) -> np.ndarray:
        if name not in self.open:
            path = f"{self.folder}/{name}"
            self.open[name] = np.asarray(np.memmap(path, kind, "r")) if os.path.getsize(path) else np.zeros(0, dtype=kind)
        return self.open[name]

    def keys(self, places: np.ndarray) -> np.ndarray:
        """The keys at sorted places."""
        found = self.array("keys", self.key_kind)[places]
        if not self.short:
            return found
        cell = np.searchsorted(self.array("begin", self.place_kind), places.astype(self.place_kind), side="right") - 1
        return (cell.astype(np.uint64) << np.uint64(self.shift)) + found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place among all keys, -1 if it is absent."""
        place = np.full(len(keys), -1, dtype=np.int64)
        own, begin, cell = self.array("keys", self.key_kind), self.array("begin", self.place_kind), (keys >> np.uint64(self.shift)).view(np.int64)
        i, end = begin[cell].astype(np.int64), begin[1:][cell].astype(np.int64)
        left = np.flatnonzero(i < end)  # few keys share a cell, so that most are found at its first or second
        wanted = keys[left]
        if self.short:
            wanted = (wanted & np.uint64((1 << self.shift) - 1)).astype(np.uint32)
        i, end = i[left], end[left]
        for _ in range(IN_TURN):
            key = own[i]
            same = key == wanted
            place[left[same]] = i[same]
            i += 1
            more = np.flatnonzero((key < wanted) & (i < end))
            left, i, end, wanted = left[more], i[more], end[more], wanted[more]
        i = lower_bound(own, wanted, i, end)
        hit = np.flatnonzero(i < end)
        hit = hit[own[i[hit]] == wanted[hit]]
        place[left[hit]] = i[hit]
        return place

    def numbers(self, name: str, places: np.ndarray, width: int = 1) -> np.ndarray:
        """Numbers kept as bytes, ``width`` beside each other in a row, of any places."""
        found = self.array(name, np.uint8).reshape(-1, width)[places]
        out = found.astype(np.int64)
        large = np.flatnonzero(found.reshape(-1) == LARGE)
        if len(large):
            at = np.searchsorted(self.array(f"{name}-at", np.int64), places[large // width] * width + large % width)
            out.reshape(-1)[large] = self.array(f"{name}-large", np.int64)[at]
        return out

    def counts(self, places: np.ndarray) -> np.ndarray:
        """The counts at any places, 0 at -1."""
        out = np.zeros(len(places), dtype=np.int64)
        known = np.flatnonzero(places >= 0)
        out[known] = self.numbers("counts", places[known])[:, 0]
        return out

    def mark(self) -> None:
        """Makes the file by which repeated keys are numbered: of 32 places, which are repeated, and how many before them."""
        folder, n = self.folder, self.n
        ranges = -(-n // IN_RANGE)
        reserve(folder, "marks", (n // IN_MARK + 1) * 8)

        def marks(r: int) -> int:
            many = np.memmap(f"{folder}/counts", np.uint8, "r")[r * IN_RANGE : (r + 1) * IN_RANGE] > 1
            bits = np.packbits(np.pad(many, (0, -len(many) % IN_MARK)), bitorder="little").view("<u4").astype(np.uint64)
            each = np.bitwise_count(bits).astype(np.uint64)
            put(folder, "marks", r * (IN_RANGE // IN_MARK), ((np.cumsum(each) - each) << np.uint64(32)) | bits)
            return int(each.sum())

        self.marked = np.r_[0, np.cumsum(in_tasks(SparkSession.active(), ranges, marks))]

    def number(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many keys before each place are repeated, which numbers the repeated ones, and whether its own is."""
        marks, bit = self.array("marks", np.uint64)[places // IN_MARK], (places % IN_MARK).astype(np.uint64)
        before = np.bitwise_count(marks & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
        return self.marked[places // IN_RANGE] + (marks >> np.uint64(32)).astype(np.int64) + before, (marks >> bit) & np.uint64(1) > 0


SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Stands for the end of a text; no word hashes to it but by chance.
END_HASH = np.uint64(0x0123456789ABCDEF)
#: Bytes that are split and hashed together, so that the arrays stay in the caches.
CHUNK = 1 << 19


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.frombuffer(b" " + b" ".join(texts) + b" " * 9, dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    space = SPACE[joined]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, length = edges[0::2], edges[1::2] - edges[0::2]
    eight = np.ndarray((len(joined) - 7,), dtype="<u8", buffer=joined.data, strides=(1,))
    hashes = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, left, which = begin, length, None
    while len(at):
        part = eight[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        mixed = ((hashes if which is None else hashes[which]) ^ part) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if which is None:
            hashes = mixed
        else:
            hashes[which] = mixed
        more = np.flatnonzero(left > 8)
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    ends = np.cumsum(sizes + 1) + 1
    return hashes, np.diff(np.r_[0, np.searchsorted(begin, ends)])


def word_hashes(texts: Iterable[str], end: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one text after another, and each text's number of words.

    Words are split at ``[\\x20\\x09-\\x0D]`` and lower-cased A-Z; with ``end`` each text has a mark of its end, counted
    as a word. Ten million distinct words hold two of one hash with a probability of 3 in a million.
    """
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append(text.encode("utf-8", "surrogatepass").lower())
        size += len(held[-1])
        if size >= CHUNK:
            parts.append(_hashes(held))
            held, size = [], 0
    if held:
        parts.append(_hashes(held))
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    hashes, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
    if end:
        out = np.full(len(hashes) + len(lengths), END_HASH)
        mark = np.zeros(len(out), dtype=bool)
        mark[np.cumsum(lengths + 1) - 1] = True
        out[~mark] = hashes
        hashes, lengths = out, lengths + 1
    return hashes, lengths


def in_groups(texts: Iterable[str], most: int, end: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole texts as :func:`word_hashes`, in groups of about ``most`` bytes."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield word_hashes(held, end)
            held, size = [], 0
    if held:
        yield word_hashes(held, end)


def packer(keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray], buckets: int, most: int = 10 << 20, bits: int = 64) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A map over batches with ``_text``: keys of whole texts, combined inside the task before the shuffle.

    Keys are made for ``GROUP_BYTES`` of text at a time and counted for about ``most``.
    """

    def counted(held: list[np.ndarray]) -> pd.DataFrame:
        return packed(*np.unique(np.concatenate(held), return_counts=True), buckets, bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for hashes, lengths in in_groups((t for batch in batches for t in batch["_text"]), GROUP_BYTES, end=True):
            held.append(keys_of(hashes, lengths))
            size += len(hashes)
            if size >= most // 6:  # about six bytes a word
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    return run
