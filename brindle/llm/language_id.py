"""Language identification: script ranges, per-word scores, and a Viterbi path over mixed-language text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, small, written

#: Labelled documents a language is learned from at most: those of the smallest hashes.
TRAINING_DOCS = 400
FEATURES, ORDERS = 1 << 17, (1, 2, 3, 4)
#: Cells of the table of features by languages, which is broadcast: more languages share fewer features.
CELLS = 1 << 25
#: Cost of changing the language between two words, and the most that one word may speak against a language.
SWITCH, MOST = 14.0, 9.0
#: Scores that one Viterbi pass holds, and that a worker keeps for word forms: words times languages.
PASS_SCORES, KEPT_SCORES = 1_600_000, 1_200_000
#: Characters of a text that are cut into words at once.
PIECE = 1 << 20
#: First code points of script ranges with the script's number; 0 is common to all.
SCRIPTS = [
    (0, 0), (0x41, 1), (0x250, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x750, 6), (0x780, 0), (0x900, 7), (0x980, 8), (0xA00, 9), (0xA80, 10),
    (0xB00, 11), (0xB80, 12), (0xC00, 13), (0xC80, 14), (0xD00, 15), (0xD80, 16), (0xE00, 17), (0xE80, 18), (0xF00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22), (0x1200, 23), (0x1400, 0),
    (0x1780, 24), (0x1800, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2E80, 25), (0x3040, 26), (0x3100, 25), (0x3130, 22), (0x3190, 25), (0x31F0, 26), (0x3400, 25), (0xA000, 0), (0xAC00, 22),
    (0xD7B0, 0), (0xF900, 25), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 1), (0xFF66, 26), (0xFFA0, 22), (0xFFE0, 0), (0x20000, 25), (0x32000, 0),
]
SCRIPT_FROM, SCRIPT_IS = (np.array(x) for x in zip(*SCRIPTS, strict=True))
LETTERS, OTHER = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def pieces(text: str) -> Iterator[str]:
    """A text in parts that end between words, so that a very long one is never a list of words as a whole."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            m = OTHER.search(text, end)
            end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def feature_count(languages: int) -> int:
    n = FEATURES
    while n * languages > CELLS and n > 1 << 10:
        n //= 2
    return n


def script_of(words: list[str]) -> np.ndarray:
    return SCRIPT_IS[np.searchsorted(SCRIPT_FROM, [ord(w[0]) for w in words], side="right") - 1]


def features(words: list[str], count: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of each word with its edges marked: feature numbers, and the word each belongs to."""
    points = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(sizes, sizes) - place
    found, of = [], []
    for n in ORDERS:
        h = np.full(len(points), n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ np.roll(points, -k)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        ok = (left >= n) & ((n > 1) | ((place > 0) & (left > 1)))
        found.append((h[ok] & np.uint64(count - 1)).astype(np.int32))
        of.append(word[ok])
    return np.concatenate(found), np.concatenate(of)


@dataclass
class Model:
    """Languages in code-point order, log weights by feature and language, and each language's scripts."""

    languages: list[str]
    weights: np.ndarray
    scripts: np.ndarray  # script x language: does the language use it

    def score(self, words: list[str]) -> np.ndarray:
        """One row a word, relative to the word's best language; scripts that a language lacks rule it out."""
        found, of = features(words, len(self.weights))
        sums = np.stack([np.bincount(of, weights=self.weights[found, k], minlength=len(words)) for k in range(len(self.languages))], axis=1)
        allowed = self.scripts[script_of(words)]
        sums = np.where(allowed | ~allowed.any(axis=1, keepdims=True), sums, -np.inf)
        sums[~allowed.any(axis=1)] = 0.0
        return np.maximum(sums - sums.max(axis=1, keepdims=True), -MOST).astype(np.float32)


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best path's label for every word; ``scores`` holds the texts' words one after another.

    Texts advance together, longest first, so that each step handles the texts that still have words.
    """
    n, langs = scores.shape
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    longest = int(ordered[0])
    active = np.searchsorted(-ordered, -np.arange(longest), side="left")
    rank = np.arange(n) - np.repeat(np.cumsum(active) - active, active)
    step = np.repeat(np.arange(longest), active)
    place = starts[rank] + step
    timed = scores[place]
    kind = np.min_scalar_type(max(langs - 1, 0))
    back = np.empty((n, langs), dtype=kind)
    own = np.arange(langs, dtype=kind)
    value = timed[: active[0]].copy()
    at = np.zeros(longest + 1, dtype=np.int64)
    np.cumsum(active, out=at[1:])
    finals = np.empty(len(sizes), dtype=kind)
    for t in range(1, longest):
        k = active[t]
        if k < len(value):
            finals[k : len(value)] = value[k:].argmax(axis=1)
            value = value[:k]
        best = value.argmax(axis=1)
        top = value[np.arange(k), best][:, None]
        change = value < top - switch
        back[at[t] : at[t + 1]] = np.where(change, best[:, None].astype(kind), own)
        value = np.where(change, top - switch, value) - top + timed[at[t] : at[t + 1]]
    finals[: len(value)] = value.argmax(axis=1)
    labels = np.empty(n, dtype=kind)
    state = finals.copy()
    for t in range(longest - 1, -1, -1):
        k = active[t]
        labels[place[at[t] : at[t + 1]]] = state[:k]
        if t:
            state[:k] = back[np.arange(at[t], at[t + 1]), state[:k]]
    return labels


def long_viterbi(scores_of: Callable[[int, int], np.ndarray], n: int, most: int, switch: float = SWITCH) -> np.ndarray:
    """The best path of one text of ``n`` words, ``most`` at a time: values are kept between the parts, and each part is
    gone through again on the way back."""

    def forward(value: np.ndarray | None, scores: np.ndarray, back: np.ndarray | None) -> np.ndarray:
        own = np.arange(scores.shape[1])
        for t, score in enumerate(scores):
            if value is None:
                value = score.copy()
                continue
            best = int(value.argmax())
            top = value[best]
            change = value < top - switch
            if back is not None:
                back[t] = np.where(change, best, own)
            value = np.where(change, top - switch, value) - top + score
        return value

    starts, value = [], None
    for at in range(0, n, most):
        starts.append(value)
        value = forward(value, scores_of(at, min(n, at + most)), None)
    labels = np.empty(n, dtype=np.min_scalar_type(len(value) - 1))
    state = int(value.argmax())
    for k in range(len(starts) - 1, -1, -1):
        at = k * most
        scores = scores_of(at, min(n, at + most))
        back = np.empty(scores.shape, dtype=labels.dtype)
        forward(starts[k], scores, back)
        for t in range(len(scores) - 1, -1, -1):
            labels[at + t] = state
            if at + t:
                state = int(back[t, state])
    return labels


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", docs: int = TRAINING_DOCS) -> Model:
    """Weights from at most ``docs`` labelled texts a language: the distinct ones of the smallest hash, over all rows.

    The driver holds the names of the languages and a table of at most ``CELLS`` weights.

    Rows with a null text or language teach nothing; without any the model knows no language.
    """
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_h", F.xxhash64("_text"))
    # copies count once; row_number with a bound is cut on the map side too, so a hot language costs ``docs`` rows a task
    ranked = rows.select("_lang", "_h").distinct().withColumn("_i", F.row_number().over(Window.partitionBy("_lang").orderBy("_h"))).where(F.col("_i") <= docs)
    limits = written(ranked.groupBy("_lang").agg(F.max("_h").alias("_limit")), "language-limits")
    languages = sorted(r["_lang"] for r in limits.select("_lang").collect())  # a row a language
    size = feature_count(len(languages))
    if not languages:
        return Model([], np.zeros((FEATURES, 0), dtype=np.float32), np.zeros((32, 0), dtype=bool))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("_lang")["_text"]:
                words = [w for t in texts for w in words_of(t)]
                if words:
                    for kind, found in (("f", features(words, size)[0]), ("s", script_of(words))):
                        ids, n = np.unique(found, return_counts=True)
                        yield pd.DataFrame({"_lang": lang, "kind": kind, "id": ids.astype(np.int64), "n": n.astype(np.int64)})

    chosen = rows.join(small(limits), "_lang").where("_h <= _limit").dropDuplicates(["_lang", "_h"]).select("_lang", "_text")
    counted = chosen.mapInPandas(count, "_lang string, kind string, id long, n long").groupBy("_lang", "kind", "id").agg(F.sum("n").alias("n")).toPandas()
    column = counted["_lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(dtype=np.int64)
    is_feature = (counted["kind"] == "f").to_numpy()
    counts = np.zeros((size, len(languages)))
    counts[counted["id"].to_numpy()[is_feature], column[is_feature]] = counted["n"].to_numpy()[is_feature]
    scripts = np.zeros((32, len(languages)))
    scripts[counted["id"].to_numpy()[~is_feature], column[~is_feature]] = counted["n"].to_numpy()[~is_feature]
    totals = np.maximum(counts.sum(axis=0), 1)
    shares = counts / totals + 0.5 / totals.max()
    used = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    used[0] = True
    return Model(languages, np.log(shares).astype(np.float32), used)


class Labeller:
    """Labels whole texts; word forms once scored are kept, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.forms = model, {}
        self.table = np.zeros((0, len(model.languages)), dtype=np.float32)

    def label(self, texts: list[str]) -> pd.DataFrame:
        """``lang_pred, score, spans`` of each text."""
        known = self.model.languages
        most = max(1000, PASS_SCORES // max(len(known), 1))
        group: list[int] = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        fresh: list[str] = []
        held = 0
        pred, score, spans = ["und"] * len(texts), [0.0] * len(texts), [""] * len(texts)
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])) if known else []:
            if not any(c.isalpha() for c in texts[i]):
                continue
            own, sizes = [], []
            for piece in pieces(texts[i]):
                words = words_of(piece)
                for w in words:
                    if w not in self.forms:
                        self.forms[w] = len(self.forms)
                        fresh.append(w)
                own.append(np.fromiter(map(self.forms.__getitem__, words), dtype=np.int32, count=len(words)))
                sizes.append(np.fromiter(map(len, words), dtype=np.float64, count=len(words)))
            own = np.concatenate(own)
            if not len(own):
                continue
            group.append(i)
            ids.append(own)
            lengths.append(np.concatenate(sizes))
            held += len(own)
            if held >= most:
                self._pass(group, ids, lengths, fresh, pred, score, spans)
                group, ids, lengths, fresh, held = [], [], [], [], 0
        self._pass(group, ids, lengths, fresh, pred, score, spans)
        return pd.DataFrame({"lang_pred": pred, "score": score, "spans": spans})

    def _pass(self, group: list[int], ids: list[np.ndarray], lengths: list[np.ndarray], fresh: list[str], pred: list, score: list, spans: list) -> None:
        known = self.model.languages
        if fresh:
            self.table = np.concatenate([self.table, *[self.model.score(fresh[i : i + 20_000]) for i in range(0, len(fresh), 20_000)]])
        if not group:
            return
        sizes = np.array([len(x) for x in ids])
        most = max(1000, PASS_SCORES // max(len(known), 1))
        if len(ids) == 1 and sizes[0] > most:
            labels = long_viterbi(lambda a, b: self.table[ids[0][a:b]], int(sizes[0]), most)
        else:
            labels = viterbi(self.table[np.concatenate(ids)], sizes)
        text = np.repeat(np.arange(len(group)), sizes)
        share = np.bincount(text * len(known) + labels.astype(np.int64), weights=np.concatenate(lengths), minlength=len(group) * len(known)).reshape(len(group), -1)
        best, of = share.argmax(axis=1), share / share.sum(axis=1, keepdims=True)
        edge = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])])
        first = np.cumsum(sizes) - sizes
        parts: list[list[str]] = [[] for _ in group]
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(labels)], strict=True):
            parts[text[a]].append(f"{a - first[text[a]]}-{b - first[text[a]]}:{known[labels[a]]}")
        for k, i in enumerate(group):
            pred[i], score[i], spans[i] = known[best[k]], float(of[k, best[k]]), ",".join(parts[k])
        if len(self.forms) * max(len(known), 1) > KEPT_SCORES:
            self.forms, self.table = {}, self.table[:0]


def labels_of(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct ``lang_pred, score, spans`` for each text, null counting as empty.

    The score is the predicted language's share of the letters; ``spans`` has ``first-end:language`` by word number, end
    exclusive. A text without a letter is ``und`` with score 0 and no span. Ties go to the language first in order.
    """
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((model.languages, model.weights, model.scripts))  # features x languages, both bounded

    @F.pandas_udf("lang_pred string, score double, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(Model(*shared.value))
        for batch in batches:
            yield labeller.label(batch.tolist())

    return run.asNondeterministic()(F.coalesce(text.cast("string"), F.lit("")))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, the columns of ``keep``, ``lang_pred, score, spans`` (see :func:`labels_of`).

    Whole texts are read; an empty table gives an empty result.
    """
    labelled = df.select(F.col(id_col).alias("_id"), *keep, labels_of(df.sparkSession, model, F.col(text_col)).alias("_label"))
    return labelled.select("*", "_label.*").drop("_label").withColumnRenamed("_id", id_col)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """``id_col, held_out, lang_pred, score, spans``: learned from the labelled rows that are not held out.

    A row is held out if CRC-32 of its id as text leaves 0 modulo ``folds`` (a null id counts as empty text).
    """
    model = learn(df.where(~held_out(id_col, folds)), text_col, lang_col)
    return identify(df, model, id_col, text_col, (held_out(id_col, folds).alias("held_out"),)).select(id_col, "held_out", "lang_pred", "score", "spans")
