"""Language-model scoring: an interpolated modified Kneser-Ney model, counted in Spark and mapped by workers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, release_shuffles, text_of
from .hash_arrays import GROUP_BYTES, PACKED, JoinedArrays, bucket_count, from_planes, in_bytes, in_groups, in_tasks, make_arrays, packer, put, reserve, save, to_planes

MIX, UNMIX = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: N-grams that are looked up together, and those whose statistics are added up before the shuffle.
PART, SHARE = 400_000, 1_000_000
ORDER = 3
#: Kept beside n-grams: by how many they are preceded; what follows them, in all and how often once, twice, more.
STATS, SINGLE = ("adj", "total", "one", "two", "more"), (1, 1, 1, 0, 0)
ALL = np.uint64(2**64 - 1)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Chen and Goodman's D1, D2, D3+ from counts of counts; 1/2, 1, 3/2 where a small corpus leaves them undefined."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.where((found > 0) & (found < [1, 1, 2, 3]), found, [0.0, 0.5, 1.0, 1.5])


@dataclass
class Level:
    """The n-grams of one length in sorted arrays: an n-gram is the place of its context, one word shorter, and a word.

    The two make one whole number of ``bits`` bits, which is mixed one-to-one, so that a hot context spreads over all
    buckets. Words have a level too, of hashes; there the context before the first word has the number after the last.
    """

    arrays: JoinedArrays
    words: int  # distinct words
    n: int
    d: np.ndarray | None = None  # discounts
    total: int = 0  # of words: continuations in all
    rest: float = 0.0  # of words: what discounts leave
    sparse: bool = True

    def key(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return mixed(context, word, self.words, self.arrays.bits)

    def pair(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and word of the n-grams at sorted places."""
        plain = (self.arrays.keys(places) * np.uint64(UNMIX)) & (ALL >> np.uint64(64 - self.arrays.bits))
        return (plain // np.uint64(self.words)).astype(np.int64), (plain % np.uint64(self.words)).astype(np.int64)

    def stats(self, places: np.ndarray) -> np.ndarray:
        """A row of ``STATS`` for every n-gram, zeros at -1. Those of longer n-grams that occur once are not kept: one
        word precedes and one follows."""
        out = np.zeros((len(places), len(STATS)), dtype=np.int64)
        known = np.flatnonzero(places >= 0)
        number = places[known]
        if self.sparse:
            out[known] = SINGLE
            number, repeated = self.arrays.number(number)
            known, number = known[repeated], number[repeated]
        out[known] = self.arrays.numbers("stats", number, len(STATS))
        return out


def mixed(context: np.ndarray, word: np.ndarray, words: int, bits: int) -> np.ndarray:
    plain = context.astype(np.uint64) * np.uint64(words) + word.astype(np.uint64)
    return (plain * np.uint64(MIX)) & (ALL >> np.uint64(64 - bits))


def places_of(levels: list[Level], word: np.ndarray, lengths: np.ndarray, upto: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every token, by length up to ``upto``: the n-gram that ends there, and its context; -1 if unknown. The places
    of words are given.

    An n-gram may begin with the start of its text, and none reaches beyond: near the start only short ones exist.
    """
    begin = np.cumsum(lengths) - lengths
    place = np.arange(len(word)) - np.repeat(begin, lengths)
    places, contexts = [word], [np.full(len(word), -1, dtype=np.int64)]
    for n in range(2, upto + 1):
        context = np.r_[-1, places[-1][:-1]] if len(word) else word
        if n == 2:
            context[begin[lengths > 0]] = levels[0].n
        else:
            context[place < n - 2] = -1
        contexts.append(context)
        if n > len(levels):
            break
        found = np.full(len(word), -1, dtype=np.int64)
        both = np.flatnonzero((context >= 0) & (word >= 0))
        found[both] = levels[n - 1].arrays.find(levels[n - 1].key(context[both], word[both]))
        places.append(found)
    return places, contexts


def suffix(levels: list[Level], n: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Places, one length shorter, of n-grams without their first word."""
    if n == 2:
        return word
    shorter = levels[n - 2]
    distinct, back = np.unique(context, return_inverse=True)
    before, last = (x[back] for x in shorter.pair(distinct))
    return shorter.arrays.find(shorter.key(suffix(levels, n - 1, before, last), word))


@dataclass
class Model:
    """Files and totals of a trained model: a level for every length of n-gram, words first."""

    levels: list[Level]
    tokens: int

    @property
    def distinct(self) -> int:
        return self.levels[0].n

    def score(self, hashes: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        words = self.levels[0]
        # what is known of a word alone is looked up once for all places where it stands
        distinct, back = np.unique(hashes, return_inverse=True)
        word = words.arrays.find(distinct)
        count = words.arrays.counts(word)
        base = np.log10((count + 1) / (self.tokens + words.n + 1))[back]
        # words by how many others they follow; what is discounted goes evenly to V words and one unknown
        p = np.full(len(word), words.rest / (words.n + 1))
        stats = words.stats(word)
        known = np.flatnonzero(word >= 0)
        n = stats[known, 0]
        p[known] += np.maximum(n - words.d[np.minimum(n, 3)], 0) / max(words.total, 1)
        p, stats, count = p[back], stats[back], count[back]
        places, contexts = places_of(self.levels, word[back], lengths, len(self.levels))
        for k in range(1, len(self.levels)):
            level = self.levels[k]
            # a context is the n-gram that ends one word before, or the start of the text
            before = np.roll(stats, 1, axis=0)
            if k == 1:
                before[contexts[1] == words.n] = words.stats(np.array([words.n]))
            stats = level.stats(places[k]) if k < len(self.levels) - 1 else level.arrays.counts(places[k])[:, None]
            some = np.flatnonzero(contexts[k] >= 0)
            some = some[before[some, 1] > 0]
            total, one, two, more = before[some, 1:].T
            n = stats[some, 0]
            weight = (level.d[1] * one + level.d[2] * two + level.d[3] * more) / total
            p[some] = np.maximum(n - level.d[np.minimum(n, 3)], 0) / total + weight * p[some]
        text = np.repeat(np.arange(len(lengths)), lengths)
        each = lambda x: np.bincount(text, weights=x, minlength=len(lengths))
        return {"n_tokens": lengths, "n_known": each(count > 0).astype(np.int64), "base_score": each(base), "score": each(np.log10(p))}


def _by_bucket(name: str, places: np.ndarray, sums: list[np.ndarray], offsets: np.ndarray) -> pd.DataFrame:
    """Sums by place as one row for every bucket of the places; sorted places are kept as the gaps between them."""
    order = np.argsort(places)
    places = places[order]
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else order
    sums = [np.minimum(np.add.reduceat(x[order], first), 2**32 - 1).astype(np.uint32) if len(first) else x[:0].astype(np.uint32) for x in sums]
    places = places[first]
    at = np.searchsorted(places, offsets)
    used = np.flatnonzero(np.diff(at))
    gaps = [np.diff(places[at[b] : at[b + 1]], prepend=offsets[b]).astype(np.uint64) for b in used]
    return pd.DataFrame({"bucket": used.astype(np.int32), "name": name, "gaps": [to_planes(g) for g in gaps], "sums": [b"".join(to_planes(np.ascontiguousarray(x[at[b] : at[b + 1]])) for x in sums) for b in used]})


def _added(rows: pd.DataFrame, columns: int, size: int) -> list[np.ndarray]:
    """The sums of a bucket's rows, by place within the bucket."""
    out = [np.zeros(size, dtype=np.int64) for _ in range(columns)]
    for gaps, sums in zip(rows["gaps"], rows["sums"], strict=True):
        places = np.cumsum(from_planes([gaps], np.uint64)).astype(np.int64)
        for k, values in enumerate(out):
            values[places] += from_planes([sums[k * 4 * len(places) : (k + 1) * 4 * len(places)]], np.uint32)
    return out


def _statistics(spark: SparkSession, levels: list[Level], n: int) -> None:
    """What the n-grams of length ``n`` say of those one shorter: by how many they are preceded (``adj``), and what
    follows them. Discounts of the shorter ones come from the first.

    The n-grams are divided in shares, and the shorter ones in as many buckets: by their number and not by the text's.
    """
    level, below = levels[n - 1], levels[n - 2]
    folder, dense, last = below.arrays.folder, n == 2, n == len(levels)
    shares = max(1, -(-level.n // SHARE))
    offsets = np.arange(shares + 1) * (below.n + dense) // shares
    rows_at = offsets
    if not dense:
        below.arrays.mark()
        rows_at = np.r_[below.arrays.number(offsets[:-1])[0], below.arrays.marked[-1]]
    reserve(folder, "stats", int(rows_at[-1]) * len(STATS))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for share in batch["id"]:
                adj: list[np.ndarray] = []
                follow: list[tuple[np.ndarray, np.ndarray]] = []
                end = min((int(share) + 1) * SHARE, level.n)
                for at in range(int(share) * SHARE, end, PART):
                    places = np.arange(at, min(at + PART, end))
                    context, word = level.pair(places)
                    place = suffix(levels, n, context, word)
                    value = level.arrays.counts(places) if last else level.stats(places)[:, 0]
                    adj.append(place if dense else place[below.arrays.number(place)[1]])
                    kept = slice(None) if dense else np.flatnonzero(below.arrays.number(context)[1])
                    follow.append((context[kept], value[kept]))
                if adj:
                    place = np.concatenate(adj)
                    yield _by_bucket("adj", place, [np.ones_like(place)], offsets)
                    context, value = (np.concatenate(x) for x in zip(*follow, strict=True))
                    yield _by_bucket("follow", context, [value, (value == 1).astype(np.int64), (value == 2).astype(np.int64), (value > 2).astype(np.int64)], offsets)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        b = int(key[0])
        size = int(offsets[b + 1] - offsets[b])
        (adj,) = _added(rows[rows["name"] == "adj"], 1, size)
        kept = [adj, *_added(rows[rows["name"] == "follow"], 4, size)]
        if not dense:
            own = below.arrays.counts(np.arange(offsets[b], offsets[b + 1]))
            adj = kept[0] = np.where(adj > 0, adj, own)  # nothing precedes the start of a text: such n-grams keep their counts
            kept = [x[own > 1] for x in kept]
        seen = np.bincount(np.minimum(adj, 5), minlength=6)
        values = np.stack(kept, axis=1).reshape(-1)
        small, at = in_bytes(values)
        put(folder, "stats", int(rows_at[b]) * len(STATS), small)
        save(folder, f"large{b}", np.stack([at + rows_at[b] * len(STATS), values[at]]))
        return pd.DataFrame({"bucket": [b], "total": [int(adj.sum())], **{f"n{k}": [int(seen[k])] for k in range(1, 5)}, "more": [int(seen[3:].sum())], "large": [len(at)]})

    # an empty row for every bucket, so that each has its part of the file
    none = spark.range(shares).select(F.col("id").cast("int").alias("bucket"), F.lit("none").alias("name"), F.lit(b"").alias("gaps"), F.lit(b"").alias("sums"))
    rows = spark.range(0, shares, 1, shares).mapInPandas(emit, "bucket int, name string, gaps binary, sums binary").unionByName(none)
    found = rows.groupBy("bucket").applyInPandas(merge, "bucket int, total long, n1 long, n2 long, n3 long, n4 long, more long, large long").toPandas()  # one row a bucket
    lists_at = np.r_[0, np.cumsum(found.set_index("bucket")["large"].sort_index())]
    for name in ("stats-at", "stats-large"):
        reserve(folder, name, int(lists_at[-1]) * 8)

    def listed(b: int) -> int:
        at, values = np.load(f"{folder}/large{b}.npy")
        put(folder, "stats-at", int(lists_at[b]), at)
        put(folder, "stats-large", int(lists_at[b]), values)
        return 0

    in_tasks(spark, shares, listed)
    for b in range(shares):
        os.remove(f"{folder}/large{b}.npy")
    below.d = discounts(*(int(found[f"n{k}"].sum()) for k in range(1, 5)))
    if dense:
        below.total = int(found["total"].sum())
        given = below.d[1] * found["n1"].sum() + below.d[2] * found["n2"].sum() + below.d[3] * found["more"].sum()
        below.rest = float(given / below.total) if below.total else 1.0


def train(df: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Counts all rows of ``df``, whole texts, in n-grams of up to ``order`` words; null texts count as empty and teach
    their end.

    Words are told apart by 64 bits of their hash (among 10^7 words two meet with a probability of 3 in a million) and
    numbered by their place in the sorted array; longer n-grams are exact pairs of numbers, of which 64 bits must hold the
    largest. The highest order counts occurrences, lower ones how many different words precede.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = df.sparkSession
    bounded_batches(spark)
    texts = df.select(text_of(text_col).alias("_text"))
    buckets = bucket_count(texts, "_text")

    arrays, found = make_arrays(texts.mapInPandas(packer(lambda hashes, lengths: hashes, buckets), PACKED), buckets, "lm-words")
    release_shuffles(spark)
    distinct = int(found["n"].sum())
    levels = [Level(JoinedArrays(arrays, found), distinct, distinct, sparse=False)]
    tokens = int(found["total"].sum())
    for n in range(2, order + 1):
        bits = max(33, ((levels[-1].n + 1) * max(distinct, 1)).bit_length())
        if bits > 64:
            raise ValueError(f"the n-grams of {n} words need {bits} bits")

        def grams_in(hashes: np.ndarray, lengths: np.ndarray, n=n, bits=bits, levels=tuple(levels)) -> np.ndarray:
            places, contexts = places_of(list(levels), levels[0].arrays.find(hashes), lengths, n)
            some = contexts[n - 1] >= 0
            return mixed(contexts[n - 1][some], places[0][some], distinct, bits)

        arrays, found = make_arrays(texts.mapInPandas(packer(grams_in, buckets, bits=bits), PACKED), buckets, f"lm-{n}", bits=bits)
        release_shuffles(spark)  # before files are joined, as their indexes take disk too
        levels.append(Level(JoinedArrays(arrays, found), distinct, int(found["n"].sum())))
    levels[-1].d = discounts(*(int(found[f"n{k}"].sum()) for k in range(1, 5)))
    for n in range(order, 1, -1):
        _statistics(spark, levels, n)
        release_shuffles(spark)
    return Model(levels, tokens)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col, n_tokens, n_known, base_score, score`` and the columns of ``keep``.

    Scores are log10 probabilities of the whole text with its end: ``base_score`` of add-one unigrams, ``score`` of the
    model. A null text is an empty one and scores its end. An empty table gives an empty result.
    """
    source = df.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), *keep)
    kept = source.columns[2:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [pd.DataFrame(model.score(*group)) for group in in_groups(batch["_text"], GROUP_BYTES, end=True)]
            if parts:
                scored = pd.concat(parts, ignore_index=True)
                yield pd.DataFrame({"_id": batch["_id"].to_numpy(), **{c: batch[c].to_numpy() for c in kept}}).join(scored)

    fields = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name in kept)
    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInPandas(run, f"_id {kind}{fields}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("_id", id_col)


def held_out(id_col: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2, order: int = ORDER) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``; held-out rows don't teach.

    A row is held out if CRC-32 of its id as text leaves ``fold`` modulo ``folds`` (a null id counts as empty text).
    Perplexity is 10 to the mean negative score a token.
    """
    model = train(df.where(~held_out(id_col, folds, fold)), text_col, order)
    out = score(df, model, id_col, text_col, (held_out(id_col, folds, fold).alias("held_out"),))
    return out.select(id_col, "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
