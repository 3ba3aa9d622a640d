"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
import importlib.metadata
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, heavy_join, new_path, text_of, written

#: Distinct word forms whose counts a worker keeps; at the bound it starts afresh.
KEPT_FORMS = 400_000


class PieceCounter:
    """Counts the tokens of a sentencepiece model, word form by word form where that is exact.

    A cut is exact where no piece of the vocabulary spans it: merges only ever build pieces of the vocabulary. The model
    is asked for that once: the only pieces with a space mark beyond their start must be runs of marks, none may hold a
    line feed, and the normaliser must leave texts as they are. If anything else is found, whole texts are encoded.
    """

    def __init__(self, path: str, kept: int = KEPT_FORMS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kept, self.inner, self.starts, self.odd = kept, {}, {}, {}
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        clean = all("▁" not in p[1:] or set(p) == {"▁"} for p in pieces) and not any("\n" in p for p in pieces)
        probe = "  a  b\n\n c ﬁ①Å\tz "
        kept_as_is = "".join(self.model.encode(probe, out_type=str)).replace("<0x0A>", "\n").replace("<0x09>", "\t")
        self.by_form = clean and kept_as_is.startswith("▁▁▁a▁▁b\n\n▁c▁") and kept_as_is.endswith("\tz▁") and len(self.model.encode("\n")) == 2

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_form:
            return len(self.model.encode(text, num_threads=1))
        if len(self.inner) + len(self.starts) + len(self.odd) > self.kept:
            self.inner, self.starts, self.odd = {}, {}, {}
        text = "▁" + text.replace(" ", "▁")
        lines = text.split("\n")
        total, inner = len(lines) - 1, self.inner
        for line in lines:
            if "▁▁" in line:
                for form in re.findall("▁+[^▁]*|[^▁]+", line):
                    n = self.odd.get(form)
                    if n is None:
                        n = self.odd[form] = self._whole(form)
                    total += n
                continue
            first, *rest = line.split("▁")
            if first:
                n = self.starts.get(first)
                if n is None:
                    n = self.starts[first] = self._whole(first)
                total += n
            try:
                total += sum([inner[w] for w in rest])
            except KeyError:
                for w in rest:
                    if w not in inner:
                        inner[w] = self._whole("▁" + w)
                    total += inner[w]
        return total

    def _whole(self, form: str) -> int:
        # the model sets a mark before every text
        return len(self.model.encode(form[1:], num_threads=1)) if form.startswith("▁") and len(form) > 1 else 1 if form == "▁" else len(self.model.encode("\n" + form, num_threads=1)) - 2


def counter_of(path: str) -> Callable[[Iterable[str]], list[int]]:
    """Counts of whole texts as the library for the file gives them, without added special tokens."""
    if path.endswith(".model"):
        counter = PieceCounter(path)
        return lambda texts: [counter.count(t) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def tokenizer_version(path: str) -> str:
    """A digest of the file and of the library's version: counts of another tokenizer never match."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    return hashlib.sha256(Path(path).read_bytes() + f"{library} {importlib.metadata.version(library)}".encode()).hexdigest()


def token_counts(df: DataFrame, tokenizer_path: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per input row: ``id_col, n_bytes, n_tokens, over_limit``.

    Contents are told apart by SHA-256. The cache (Parquet, one folder per tokenizer version) is joined by digest; only
    distinct contents that it lacks are encoded, and their counts are appended to it before the rows are joined. Without
    ``cache_path`` a new cache is begun in the shared folder. ``normalise`` maps texts before digest and count; by default
    they stay as they are. Null texts count as empty and have 0 tokens. Repeated texts are brought together by an
    aggregate with a map side, so that a hot text costs one row per task. An empty table gives an empty result; other
    columns are not read. ``tokenizer_path`` must be readable on the executors.
    """
    spark, version = df.sparkSession, tokenizer_version(tokenizer_path)
    bounded_batches(spark)
    cache = f"{(cache_path or new_path(spark, 'token-cache')).rstrip('/')}/{version}"
    text = text_of(text_col)
    rows = df.select(F.col(id_col).alias("_id"), (normalise(text) if normalise else text).alias("_text"))
    rows = rows.withColumn("_dig", F.unhex(F.sha2("_text", 256)))
    contents = rows.groupBy("_dig").agg(F.first("_text").alias("_text"))
    schema = "_dig binary, n_tokens long"
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)

    def stored() -> DataFrame:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(cache).groupBy("_dig").agg(F.max("n_tokens").alias("n_tokens"))

    misses = contents.join(stored(), "_dig", "left_anti")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter_of(tokenizer_path)
        for batch in batches:
            yield pd.DataFrame({"_dig": batch["_dig"], "n_tokens": count(batch["_text"])})

    misses.mapInPandas(encode, schema).write.parquet(f"{cache}/{uuid.uuid4().hex}")
    keyed = written(rows.select("_id", "_dig", F.octet_length("_text").cast("long").alias("n_bytes")), "token-rows")
    lookup = written(keyed.groupBy("_dig").agg(F.count(F.lit(1)).alias("_n")).join(stored(), "_dig"), "token-lookup")
    found = heavy_join(keyed, lookup, "_dig", "_n")
    return found.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
