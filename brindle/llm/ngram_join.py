"""N-gram Jaccard join: all pairs of documents whose word shingles overlap enough, found exactly."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, drop_written, heavy_join, local_path, new_path, text_of, written
from .components import components
from .hash_arrays import PACKED, SortedArrays, bucket_count, bucket_of, from_planes, in_groups, make_arrays, packed, save, to_planes

#: A document's point has about half as many coordinates as it has shingles, between these bounds, a power of two.
LEAST_GROUPS, MOST_GROUPS = 64, 1 << 16
#: Documents in a leaf of the tree; coordinates of one block that a task holds on either side.
LEAF, PART_COORDINATES = 16, 1 << 20
#: Leading shingles that a pair has in common at least, where its overlap is as large.
COMMON = 5
#: Documents that a block is to have, where shingles leave a choice.
BLOCK_DOCS = 1024
GROUP_BYTES = 4 << 20
#: Bits kept where shingles are only ordered by frequency; a chance meeting there costs a comparison, never a link.
ORDER_BITS, SET_BITS = 40, 56


def shingle_sets(hashes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct 2-word shingles as sorted 64-bit hashes; one word makes a shingle of its own."""
    if not len(hashes):
        return [np.zeros(0, dtype=np.uint64)] * len(lengths)
    follow = np.r_[hashes[1:], np.uint64(0)]
    pairs = (hashes * np.uint64(0x9E3779B97F4A7C15)) ^ ((follow << np.uint64(31)) | (follow >> np.uint64(33)))
    ends = np.cumsum(lengths)
    single = ends[lengths == 1] - 1
    pairs[single] = hashes[single]
    pairs = (pairs ^ (pairs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pairs ^= pairs >> np.uint64(29)
    return [np.unique(pairs[e - n : e - 1 if n > 1 else e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def point_of(found: np.ndarray) -> np.ndarray:
    """Shingles counted by group; a group is some bits of the hash, so that folding halves gives the coarser point."""
    n = LEAST_GROUPS
    while n * 2 < len(found) and n < MOST_GROUPS:
        n *= 2
    return np.bincount(((found >> np.uint64(24)) & np.uint64(n - 1)).astype(np.int64), minlength=n)


def folded(point: np.ndarray, n: int) -> np.ndarray:
    while len(point) > n:
        point = point[: len(point) // 2] + point[len(point) // 2 :]
    return point


def pack_point(point: np.ndarray) -> bytes:
    kind = np.min_scalar_type(int(point.max(initial=0)))
    return bytes([kind.itemsize]) + point.astype(kind).tobytes()


def unpack_point(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int32)


def cut(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys & ~np.uint64((1 << (64 - bits)) - 1)


def digest_of(found: np.ndarray) -> bytes:
    """128 bits: among 10^11 sets two meet with a probability of 10^-17."""
    return xxhash.xxh3_128_digest(found.tobytes())


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection a set of this size can share with any partner: percent of itself, rounded up."""
    return -(-sizes * percent // 100)


def step_of(sizes: np.ndarray) -> np.ndarray:
    """Sizes in steps of a ninth, one byte each; larger sizes never have smaller steps."""
    return np.minimum(8 * np.log2(np.maximum(sizes, 1)) + 1, 255).astype(np.uint8)


#: The least size of each step, rounded down.
STEP_LEAST = np.maximum(np.floor(2.0 ** ((np.arange(256) - 1) / 8)), 1).astype(np.int64)


def spread_order(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """An order that keeps like points together: halves by the coordinate of most variance, until a leaf holds them."""
    out, open_ = [], [np.argsort(sizes, kind="stable")]
    while open_:
        own = open_.pop()
        if len(own) <= LEAF:
            out.append(own)
            continue
        axis = int(points[own].var(axis=0).argmax())
        own = own[np.lexsort((sizes[own], points[own, axis]))]
        middle = LEAF * -(-len(own) // (2 * LEAF))
        open_ += [own[middle:], own[:middle]]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


class Tree:
    """An R-tree over group counts: boxes keep each coordinate's maximum and the sizes' range.

    A query's overlap with anything in a box is at most the sum of coordinate minima with the box's maxima.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        self.order = spread_order(points, sizes)
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        high, low, top = self.points, self.sizes, self.sizes
        while len(high) > LEAF:
            at = np.arange(0, len(high), LEAF)
            high, low, top = np.maximum.reduceat(high, at), np.minimum.reduceat(low, at), np.maximum.reduceat(top, at)
            self.levels.append((high, low, top))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """The entries whose overlap bound and size still allow the similarity, as places in the arrays given."""
        p = self.percent
        at = None
        for high, low, top in reversed(self.levels):
            at = np.arange(len(high)) if at is None else self._children(at, len(high))
            # overlap >= p/(100+p) of the sizes' sum; sizes within p percent of each other
            bound = np.minimum(high[at], point).sum(axis=1)
            ok = ((100 + p) * bound >= p * (size + low[at])) & (100 * top[at] >= p * size) & (100 * size >= p * low[at])
            at = at[ok]
        at = np.arange(len(self.points)) if at is None else self._children(at, len(self.points))
        sizes = self.sizes[at]
        at = at[(100 * sizes >= p * size) & (100 * size >= p * sizes)]
        bound = np.minimum(self.points[at], point).sum(axis=1)
        return self.order[at[(100 + p) * bound >= p * (size + self.sizes[at])]]

    @staticmethod
    def _children(at: np.ndarray, n: int) -> np.ndarray:
        found = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
        return found[found < n]


class Points:
    """Trees over points of each dimension, made when first asked."""

    def __init__(self, points: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.points, self.sizes, self.percent = points, sizes, percent
        self.by: dict[int, np.ndarray] = {}
        dims = np.array([len(p) for p in points])
        for d in np.unique(dims):
            self.by[int(d)] = np.flatnonzero(dims == d)
        self.trees: dict[tuple[int, int], Tree] = {}

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        found = []
        for d, members in self.by.items():
            n = min(d, len(point))
            if (d, n) not in self.trees:
                self.trees[d, n] = Tree(np.stack([folded(self.points[i], n) for i in members]), self.sizes[members], self.percent)
            found.append(members[self.trees[d, n].search(folded(point, n), size)])
        return np.sort(np.concatenate(found))


def candidates(points: list[np.ndarray], sizes: np.ndarray, n: int, inner: bool, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the entries (the first ``n``) that its bounds allow; within one part, entries ask those before them."""
    tree = Points(points[:n], sizes[:n], percent)
    for k in range(n) if inner else range(n, len(points)):
        at = tree.search(points[k], int(sizes[k]))
        if inner:
            at = at[at < k]
        if len(at):
            yield k, at


def linked(sets: list[np.ndarray], n: int, inner: bool, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """The candidates whose sets overlap enough."""
    sizes = np.array([len(s) for s in sets])
    for k, at in candidates([point_of(s) for s in sets], sizes, n, inner, percent):
        own = sets[k]
        flat = np.concatenate([sets[i] for i in at])
        many = sizes[at]
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        shared = np.add.reduceat(hit, np.cumsum(many) - many, dtype=np.int64)
        at = at[100 * shared >= percent * (len(own) + many - shared)]
        if len(at):
            yield k, at


def by_place(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of sorted rows, however the batches cut them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
        other = (rows[names] != rows[names].iloc[-1]).any(axis=1).to_numpy()
        end = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        for _, group in rows.iloc[:end].groupby(names, sort=False):
            yield group
        held = [rows.iloc[end:]]
    if held:
        yield from (group for _, group in held[0].groupby(names, sort=False))


class _Forest:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def _stored(classes: DataFrame, buckets: int) -> SortedArrays:
    """Each class's representative row in mapped arrays, sorted by the digest; both halves of it are compared."""
    folder = local_path(new_path(classes.sparkSession, "lookup"))
    os.makedirs(folder)

    def with_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = halves(batch["digest"].tolist())
            yield pd.DataFrame({"bucket": bucket_of(a, buckets).astype(np.int32), "a": a.view(np.int64), "b": b.view(np.int64), "v": batch["rep"]})

    def store(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        a = batch["a"].to_numpy().view(np.uint64)
        order = np.lexsort((batch["b"].to_numpy().view(np.uint64), a))
        for name, values in (("k", a), ("o", batch["b"].to_numpy()), ("c", batch["v"].to_numpy())):
            save(folder, f"{name}{int(key[0])}", values[order])
        return pd.DataFrame({"bucket": [int(key[0])], "n": [len(batch)]})

    placed = classes.select("digest", "rep").mapInPandas(with_bucket, "bucket int, a long, b long, v long")
    found = placed.groupBy("bucket").applyInPandas(store, "bucket int, n long").toPandas()  # one row a bucket
    sizes = np.zeros(buckets, dtype=np.int64)
    sizes[found["bucket"]] = found["n"]
    return SortedArrays(folder, sizes)


def _row_of_class(classes: SortedArrays, digests: list[bytes]) -> np.ndarray:
    """The representative row of each digest's class; every digest has one."""
    a, b = halves(digests)
    out = np.zeros(len(a), dtype=np.int64)
    bucket = bucket_of(a, len(classes.sizes))
    for k in np.unique(bucket):
        mine = np.flatnonzero(bucket == k)
        keys, other = classes.array(f"k{k}"), classes.array(f"o{k}")
        at = np.searchsorted(keys, a[mine])
        while len(wrong := np.flatnonzero(other[at] != b[mine].view(np.int64))):
            at[wrong] += 1  # digests that share their first half
        out[mine] = classes.array(f"c{k}")[at]
    return out


def _representatives(batches: Iterator[pd.DataFrame], classes: SortedArrays) -> Iterator[tuple[list[bytes], list[np.ndarray]]]:
    """Digest and set of every document that stands for its class, group by group."""
    for batch in batches:
        at = 0
        rows = batch["_row"].to_numpy()
        for hashes, lengths in in_groups(batch["_text"], GROUP_BYTES):
            sets = shingle_sets(hashes, lengths)
            some = [k for k, own in enumerate(sets) if len(own)]
            if some:
                digests = [digest_of(sets[k]) for k in some]
                mine = _row_of_class(classes, digests) == rows[at + np.array(some)]
                yield [d for d, ok in zip(digests, mine, strict=True) if ok], [sets[k] for k, ok in zip(some, mine, strict=True) if ok]
            at += len(sets)


class Rooms:
    """Which blocks hold a document that leads with a shingle: pairs of shingle and block in mapped arrays.

    Beside each pair stand, in steps, the least and largest size of those documents and the most shingles that any has
    left from there. A shingle that leads to one block only is left out.
    """

    def __init__(self, folder: str, buckets: int):
        self.folder, self.buckets = folder, buckets
        self.open: dict[int, tuple[np.ndarray, ...]] = {}

    def __getstate__(self) -> dict:
        return {"folder": self.folder, "buckets": self.buckets, "open": {}}

    @staticmethod
    def merged(keys: np.ndarray, homes: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not len(keys):
            return keys, homes, facts
        order = np.lexsort((homes, keys))
        keys, homes, facts = keys[order], homes[order], facts[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (homes[1:] != homes[:-1])])
        low = np.minimum.reduceat(facts[:, 0], first)
        rest = np.maximum.reduceat(facts[:, 1:], first, axis=0)
        return keys[first], homes[first], np.c_[low, rest]

    @classmethod
    def make(cls, rows: DataFrame, buckets: int) -> Rooms:
        folder = local_path(new_path(rows.sparkSession, "rooms"))
        os.makedirs(folder)

        def merge(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
            k = int(key[0])
            facts = np.concatenate([np.frombuffer(x, dtype=np.uint8).reshape(3, -1).T for x in batch["facts"]])
            keys, homes, facts = cls.merged(from_planes(batch["keys"], np.uint64), from_planes(batch["homes"], np.uint64), facts)
            begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            many = np.diff(np.r_[begin, len(keys)])
            kept = np.repeat(many > 1, many)
            for name, values in (("k", keys), ("h", homes), ("f", facts)):
                save(folder, f"{name}{k}", values[kept])
            return pd.DataFrame({"bucket": [k]})

        rows.groupBy("bucket").applyInPandas(merge, "bucket int").count()
        return cls(folder, buckets)

    def arrays(self, k: int) -> tuple[np.ndarray, ...]:
        if k not in self.open:
            path = f"{self.folder}/{{}}{k}.npy"
            # a bucket that no row fell into has no file
            self.open[k] = tuple(np.load(path.format(x), mmap_mode="r") for x in "khf") if os.path.exists(path.format("f")) else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, 3), np.uint8))
        return self.open[k]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted keys: which key, which block, and the facts, an entry for every block of each key."""
        at = np.searchsorted(bucket_of(keys, self.buckets), np.arange(self.buckets + 1))
        which, homes, facts = [], [], []
        for b in np.flatnonzero(np.diff(at)):
            own, home, fact = self.arrays(int(b))
            here = keys[at[b] : at[b + 1]]
            lo, hi = np.searchsorted(own, here), np.searchsorted(own, here, side="right")
            many = hi - lo
            place = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
            which.append(at[b] + np.repeat(np.arange(len(here)), many))
            homes.append(np.asarray(home[place]))
            facts.append(np.asarray(fact[place]))
        if not which:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, 3), np.uint8)
        return np.concatenate(which), np.concatenate(homes), np.concatenate(facts)


class Leading:
    """The leading shingles of some documents, those that several lead with: flat arrays, and each document's block."""

    def __init__(self, batch: pd.DataFrame, often: SortedArrays, percent: int):
        self.n = batch["n"].to_numpy()
        leads = [from_planes([x], np.uint64) for x in batch["lead"]]
        sizes = np.array([len(x) for x in leads])
        keys = np.concatenate(leads) if leads else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(leads)), sizes)
        place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rest = self.n[doc] - batch["alone"].to_numpy()[doc] - place
        unique, back = np.unique(keys, return_inverse=True)
        g = often.find(unique)[1][back]
        self.common = np.minimum(COMMON, needed(self.n, percent))
        shared = np.bincount(doc[g > 1], minlength=len(leads))
        kept = (g > 1) & (shared >= self.common)[doc]
        self.keys, self.doc, self.rest, g = keys[kept], doc[kept], rest[kept], g[kept]
        # the block of the shingle that about BLOCK_DOCS documents lead with: documents of one family choose alike
        fit = np.minimum(g / BLOCK_DOCS, BLOCK_DOCS / np.maximum(g, 1))
        order = np.lexsort((self.keys, -fit, self.doc))
        first = order[np.flatnonzero(np.r_[True, self.doc[order][1:] != self.doc[order][:-1]])] if len(order) else order
        self.some = self.doc[first]
        self.home = np.zeros(len(leads), dtype=np.uint64)
        self.home[self.some] = self.keys[first]


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 60, part_coordinates: int = PART_COORDINATES, groups: bool = False) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, n_similar, component_id``.

    Words are split at ``[\\x20\\x09-\\x0D]`` and lower-cased A-Z; a set holds the distinct 2-word shingles, or the one word
    there is. Rows link when the intersection is at least ``percent`` of the union; empty or null texts have an empty set
    and no links. ``n_similar`` counts the other rows linked directly, ``component_id`` is the smallest id reachable.
    Null ids are counted but never name a component; an empty table gives an empty result. With ``groups`` there are two
    more columns: ``group``, equal for rows that reach each other whatever their ids and null for an empty set, and ``row``,
    the hash of id and text.

    1. Equal sets form a class; only its first document takes part, weighted by the class's size.
    2. Shingles are ordered by document frequency, rarest first. Sets that link have c = ``COMMON`` shingles in common (all
       of the overlap, where it is smaller) among the first n - ceil(n * percent / 100) + c of each, and a shingle of one
       set alone links nothing: most sets drop out here. They are written once with their points.
    3. Each remaining set goes to one block, that of one of its leading shingles. Which blocks hold a set that leads with
       a shingle is kept in mapped arrays; a set visits every larger block with which it has c leading shingles in common
       whose sizes and places allow the overlap. Every candidate pair thus meets in one place, once, and pairs are never
       written out.
    4. Within a block a tree over group counts bounds the overlap by summed coordinate minima. Only for documents with a
       surviving partner are the sets made again and compared in full; counts and a spanning forest of the links leave
       the task. Blocks of many coordinates are cut into parts that meet two by two.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    source = df.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).withColumn("_row", F.xxhash64("_id", "_text"))
    buckets = bucket_count(source, "_text")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(len(s), digest_of(s)) for group in in_groups(batch["_text"], GROUP_BYTES) for s in shingle_sets(*group)]
            yield pd.DataFrame({"_id": batch["_id"].to_numpy(), "_row": batch["_row"].to_numpy(), "n": [x[0] for x in found], "digest": [x[1] for x in found]})

    kind = source.schema["_id"].dataType.simpleString()
    docs = written(source.mapInPandas(sets_of, f"_id {kind}, _row long, n long, digest binary"), "sets")
    classes = written(docs.where("n > 0").groupBy("digest").agg(F.min("_row").alias("rep"), F.min("_id").alias("first"), F.count(F.lit(1)).alias("m")), "set-classes")
    stored = _stored(classes, buckets)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in _representatives(batches, stored):
            if sets:
                yield packed(*np.unique(cut(np.concatenate(sets), ORDER_BITS), return_counts=True), buckets)

    often, _ = make_arrays(source.mapInPandas(frequencies, PACKED), buckets, "shingles", least=2)

    def leading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for digests, sets in _representatives(batches, stored):
            if not sets:
                continue
            keys, back = np.unique(cut(np.concatenate(sets), ORDER_BITS), return_inverse=True)
            _, counts = often.find(keys)
            counts, keys, at, out = counts[back], keys[back], 0, []
            for digest, own in zip(digests, sets, strict=True):
                n, key = counts[at : at + len(own)], keys[at : at + len(own)]
                at += len(own)
                least = int(needed(len(own), percent))
                first = len(own) - least + min(COMMON, least)
                shared = np.flatnonzero(n)
                alone = len(own) - len(shared)
                if first - alone >= min(COMMON, least):
                    shared = shared[np.lexsort((key[shared], n[shared]))][: first - alone]
                    out.append((digest, len(own), alone, to_planes(key[shared]), pack_point(point_of(own))))
            if out:
                yield pd.DataFrame(out, columns=["digest", "n", "alone", "lead", "point"])

    # rows that repeat id and text stand for their class several times: ``u`` tells them apart, one of them goes on
    points = written(source.mapInPandas(leading, "digest binary, n long, alone long, lead binary, point binary").withColumn("u", F.monotonically_increasing_id()), "leading")
    leads = points.select("digest", "u", "n", "alone", "lead")

    def leaders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield packed(*np.unique(np.concatenate([from_planes([x], np.uint64) for x in batch["lead"]]), return_counts=True), buckets)

    shared, _ = make_arrays(points.select("lead").mapInPandas(leaders, PACKED), buckets, "leaders", least=2)

    def homes_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Leading(batch, shared, percent)
            yield pd.DataFrame({"digest": batch["digest"].to_numpy()[found.some], "u": batch["u"].to_numpy()[found.some], "home": found.home[found.some].view(np.int64), "coordinates": batch["coordinates"].to_numpy()[found.some]})

    coordinates = F.octet_length("point").alias("coordinates")
    homes = points.select("digest", "u", "n", "alone", "lead", coordinates).mapInPandas(homes_of, "digest binary, u long, home long, coordinates int")
    homes = written(homes, "homes")
    single = homes.groupBy("digest").agg(F.min("u").alias("u"), F.first("home").alias("home"), F.first("coordinates").alias("coordinates"))
    homes = written(single, "homes-once")
    rooms = written(homes.groupBy("home").agg(F.count(F.lit(1)).alias("members"), F.sum("coordinates").alias("size")), "home-sizes")

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Leading(batch, shared, percent)
            n = step_of(found.n)[found.doc]
            keys, homes, facts = Rooms.merged(found.keys, found.home[found.doc], np.c_[n, n, step_of(found.rest)])
            at = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(at))
            part = lambda b: slice(at[b], at[b + 1])  # noqa: B023, E731
            yield pd.DataFrame({"bucket": used.astype(np.int32), "keys": [to_planes(keys[part(b)]) for b in used], "homes": [to_planes(homes[part(b)]) for b in used], "facts": [facts[part(b)].T.tobytes() for b in used]})

    hosts = Rooms.make(leads.mapInPandas(entries, "bucket int, keys binary, homes binary, facts binary"), buckets)

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["home"].to_numpy().view(np.uint64)
            order = np.argsort(keys)
            yield packed(keys[order], batch["members"].to_numpy()[order], buckets)

    members_of, _ = make_arrays(rooms.mapInPandas(sized, PACKED), buckets, "room-sizes")

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Leading(batch, shared, percent)
            own, who = batch["digest"].to_numpy(), batch["u"].to_numpy()
            for doc, host in _visits(found, hosts, members_of, percent):
                yield pd.DataFrame({"digest": own[doc], "u": who[doc], "home": host.view(np.int64)})

    visits = leads.mapInPandas(visit, "digest binary, u long, home long").join(homes.select("digest", "u", "coordinates"), ["digest", "u"])
    guests = written(visits, "visits")
    # parts of a block: members by hash, visitors by hash too; a part meets each other part once
    counted = guests.groupBy("home").agg(F.sum("coordinates").alias("guest_size"))
    cut_in = lambda size: F.ceil(F.col(size) / part_coordinates).cast("int")
    rooms = rooms.join(counted, "home", "left").where("members > 1 OR guest_size IS NOT NULL").select("home", cut_in("size").alias("parts"), F.coalesce(cut_in("guest_size"), F.lit(0)).alias("guest_parts"))
    rooms = written(rooms, "home-parts")
    part = lambda parts: F.pmod(F.xxhash64("digest"), F.col(parts)).cast("int")
    here = homes.join(rooms, "home").withColumn("part", part("parts"))
    none = F.array().cast("array<int>")
    index = here.select(
        "digest",
        "u",
        "home",
        F.col("part").alias("i"),
        F.explode(F.concat(F.sequence("part", F.col("parts") - 1), F.when(F.col("guest_parts") > 0, F.transform(F.sequence(F.lit(1), "guest_parts"), lambda k: -k)).otherwise(none))).alias("j"),
        F.lit(0).alias("role"),
    )
    asked = here.where("part > 0").select("digest", "u", "home", F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("i"), F.col("part").alias("j"), F.lit(1).alias("role"))
    come = guests.join(rooms, "home").select("digest", "u", "home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), (-part("guest_parts") - 1).alias("j"), F.lit(1).alias("role"))
    places = index.unionByName(asked).unionByName(come)
    names = ["home", "i", "j"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # said, as few bytes can take long to compare
    pointed = places.join(points.select("digest", "u", "n", "point"), ["digest", "u"]).repartition(tasks, *names).sortWithinPartitions(*names, "role", "digest")

    def flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_place(batches, names):
            n, inner = int((group["role"] == 0).sum()), group["i"].iloc[0] == group["j"].iloc[0]
            ok = np.zeros(len(group), dtype=bool)
            for k, at in candidates([unpack_point(p) for p in group["point"]], group["n"].to_numpy(), n, inner, percent):
                ok[k] = ok[at] = True
            if ok.any():
                yield group.loc[ok, ["digest", *names, "role"]]

    flagged = written(pointed.mapInPandas(flag, "digest binary, home long, i int, j int, role int"), "flagged")
    # sets of flagged documents only, found again in their texts
    wanted, _ = make_arrays(classes.join(flagged.select("digest").distinct(), "digest", "left_semi").select("rep").mapInPandas(lambda batches: _packed_rows(batches, buckets), PACKED), buckets, "wanted")

    def sets_again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, back = np.unique(batch["_row"].to_numpy().view(np.uint64), return_inverse=True)
            mine = np.flatnonzero(wanted.find(keys)[0][back] >= 0)
            sets = [s for group in in_groups(batch["_text"].iloc[mine], GROUP_BYTES) for s in shingle_sets(*group)]
            yield pd.DataFrame({"digest": [digest_of(s) for s in sets], "set": [to_planes(np.unique(cut(s, SET_BITS))) for s in sets]})

    sets = source.select("_row", "_text").mapInPandas(sets_again, "digest binary, set binary")
    rows = flagged.join(classes.select("digest", "m"), "digest").join(sets, "digest")
    rows = rows.repartition(tasks, *names).sortWithinPartitions(*names, "role", "digest")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_place(batches, names):
            group = group.drop_duplicates(["role", "digest"])  # rows that repeat id and text gave their set twice
            n, inner = int((group["role"] == 0).sum()), group["i"].iloc[0] == group["j"].iloc[0]
            digest, m = group["digest"].to_numpy(), group["m"].to_numpy()
            links, forest = np.zeros(len(group), dtype=np.int64), _Forest()
            for k, at in linked([from_planes([x], np.uint64) for x in group["set"]], n, inner, percent):
                links[k] += m[at].sum()
                links[at] += m[k]
                for x in at.tolist():
                    forest.join(k, x)
            some = np.flatnonzero(links)
            if len(some):
                yield pd.DataFrame({"digest": digest[some], "links": links[some], "root": [digest[forest.root(int(k))] for k in some]})

    found = written(rows.mapInPandas(compare, "digest binary, links long, root binary"), "links")
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    named = whole.join(classes.select(F.col("digest").alias("node"), "first"), "node")
    names = named.groupBy("root").agg(F.min("first").alias("component"))
    info = named.join(names, "root").select(F.col("node").alias("digest"), "component", "root").join(links, "digest")
    info = written(classes.select("digest", "first", "m").join(info, "digest", "left"), "class-info")
    for table in (points, homes, guests, flagged):
        drop_written(table)
    some = heavy_join(docs.where("n > 0"), info, "digest", "m").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        (F.col("m") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_similar"),
        F.coalesce("component", "first").alias("component_id"),
        *([F.coalesce("root", "digest").alias("group"), F.col("_row").alias("row")] if groups else []),
    )
    empty = docs.where("n = 0").select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_similar"), F.col("_id").alias("component_id"), *([F.lit(None).cast("binary").alias("group"), F.col("_row").alias("row")] if groups else []))
    return some.unionByName(empty)


def _packed_rows(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield packed(*np.unique(batch["rep"].to_numpy().view(np.uint64), return_counts=True), buckets)


#: Entries of the arrays that are looked at together.
ENTRIES = 1 << 20


def _slices(entries: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
    """Whole documents with about ``ENTRIES`` entries together, one at least, as ranges of leading shingles."""
    ends = np.r_[np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc)] if len(doc) else np.zeros(0, np.int64)
    upto = np.cumsum(entries)[ends - 1] if len(ends) else ends
    at, k = 0, 0
    while k < len(ends):
        before = 0 if k == 0 else upto[k - 1]
        k = max(k + 1, int(np.searchsorted(upto, before + ENTRIES, side="right")))
        yield at, int(ends[k - 1])
        at = int(ends[k - 1])


def _visits(found: Leading, hosts: Rooms, members_of: SortedArrays, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents and the blocks they visit, a few documents at a time."""
    begin = np.searchsorted(found.doc, np.arange(len(found.n) + 1))
    at = 0
    while at < len(found.n):
        # as many documents as have about 4096 leading shingles
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + 4096, side="right")) - 1)
        mine = slice(begin[at], begin[to])
        at = to
        keys, back = np.unique(found.keys[mine], return_inverse=True)
        which, home, facts = hosts.find(keys)
        if not len(which):
            continue
        # entries by key are consecutive: spread them over the leading shingles that have the key
        many = np.bincount(which, minlength=len(keys))
        first = np.cumsum(many) - many
        for lo, hi in _slices(many[back], found.doc[mine]):
            sizes = many[back[lo:hi]]
            lead = np.repeat(np.arange(lo, hi), sizes)
            place = np.repeat(first[back[lo:hi]] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            doc, rest = found.doc[mine][lead], found.rest[mine][lead]
            n, host, fact = found.n[doc], home[place], facts[place]
            small = needed(n, percent)
            low = np.maximum(STEP_LEAST[fact[:, 0]], small)
            overlap = -(-percent * (n + low) // (100 + percent)) - found.common[doc] + 1
            ok = (host != found.home[doc]) & (fact[:, 1] >= step_of(small)) & (fact[:, 0] <= step_of(100 * n // percent)) & (rest >= overlap) & (fact[:, 2] >= step_of(overlap))
            doc, host, asks = doc[ok], host[ok], np.minimum(COMMON, needed(low[ok], percent))
            if not len(doc):
                continue
            order = np.lexsort((host, doc))
            doc, host, asks = doc[order], host[order], asks[order]
            edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (host[1:] != host[:-1])])
            hits, asks = np.diff(np.r_[edge, len(doc)]), np.minimum.reduceat(asks, edge)
            doc, host = doc[edge], host[edge]
            ok = hits >= np.minimum(asks, found.common[doc])
            doc, host = doc[ok], host[ok]
            if not len(doc):
                continue
            both, back_to = np.unique(np.r_[host, found.home[doc]], return_inverse=True)
            size = members_of.find(both)[1][back_to]
            there, here = size[: len(doc)], size[len(doc) :]
            ok = (there > here) | ((there == here) & (host > found.home[doc]))
            yield doc[ok], host[ok]


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) = 1 THEN t ELSE list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) END) AS sh FROM w
), x AS (SELECT doc_id, unnest(sh) AS g FROM s), n AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 60 * (na.n + nb.n - k)
), r AS (
  SELECT doc_id AS node, doc_id AS seen FROM n
  UNION
  SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen
)
SELECT n.doc_id, n.n AS n_shingles, (SELECT count(*) FROM l WHERE l.a = n.doc_id) AS n_similar, (SELECT min(seen) FROM r WHERE r.node = n.doc_id) AS component_id FROM n
"""
