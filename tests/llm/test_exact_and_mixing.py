import hashlib
import re

import public_tokenizers
from pyspark.sql import functions as F

from brindle.llm import common, exact_dedup, mixing, ngram_join, queries, token_counts
from tests.compare import duck, rows


def brute(texts):
    groups = {}
    for i, t in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i if i is not None else 0))
    out = []
    for i, t in texts:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[key])
        keep = None if best[1] else best[2]
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_exact_dedup(spark, docs, empty):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(exact_dedup.exact_dedup(docs)) == brute(texts)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_digest_clashes_are_told_apart_by_content(spark):
    texts = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    clash = exact_dedup.exact_dedup(df, digest=lambda c: F.substring(F.sha2(c, 256), 1, 0))
    want = [(a, b, c, d) for a, b, c, d, _ in brute(texts)]
    assert sorted(map(tuple, clash.select("doc_id", "keep_id", "group_size", "kept").collect()), key=str) == sorted(want, key=str)


def test_against_sql(spark, data):
    for name in ("op3_source_mixing", "op4_exact_dedup", "op1_topk_search"):
        assert rows(queries.queries()[name](spark, data).toPandas()) == rows(duck(data).sql(queries.oracle_sql()[name]).df())


def water(sizes, weights, share, most):
    target, left = {}, dict(sizes)
    total = share * sum(sizes.values())
    while left:
        level = (total - sum(target.values())) / sum(weights[k] for k in left)
        full = [k for k in left if most * left[k] < level * weights[k]]
        if not full:
            return target | {k: level * weights[k] for k in left}
        for k in full:
            target[k] = most * left.pop(k)
    return target


def test_targets_and_edges(spark, docs, empty):
    sizes = {f"0s{i}": n for i, n in enumerate([5, 1000, 30, 0, 700, 2, 900])}
    weights = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes))}
    table = spark.createDataFrame(list(sizes.items()), "_key string, source_size long")
    found = {r._key: r.target for r in mixing.source_targets(table).collect()}
    want = water(sizes, weights, 1.5, 2.0)
    assert all(abs(found[k] - want[k]) < 1e-6 for k in want)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == 9 and all(0 <= r.taken <= 2 * r["size"] for r in out)
    assert mixing.mix_sources(empty).count() == 0


def test_words_come_near_targets_and_bins_divide(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.pmod(F.xxhash64("id"), F.lit(40)).cast("int") + 1).alias("text"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    one = mixing.mix_sources(df)
    for r in one.groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r.t - r.g) <= 21
    # opening bins again and again ends in the same sample
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, mixing.mix_sources(df, sorted_rows=0).collect()))


def test_heavy_join_is_a_join(spark):
    rows_ = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 30}") for i in range(6000)], "i long, k string")
    lookup = rows_.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("m"))
    for keys in ("k", ["k"]):
        joined = common.heavy_join(rows_, lookup, keys, "n")
        assert sorted(joined.columns) == ["i", "k", "m", "n"]
        assert sorted(map(tuple, joined.select("i", "k", "n", "m").collect())) == sorted(map(tuple, rows_.join(lookup, "k").select("i", "k", "n", "m").collect()))
    assert common.heavy_join(rows_.limit(0), lookup.limit(0), "k", "n").count() == 0


def test_half_of_all_rows_are_null(spark):
    """One key with half of all rows, for the operators that bring equal contents together."""
    texts = [(i, None if i % 2 else f"the text number {i % 70} of a few words") for i in range(3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert got(exact_dedup.exact_dedup(df)) == brute(texts)
    found = ngram_join.ngram_join(df)
    assert found.where("n_shingles = 0 AND n_similar = 0 AND component_id = doc_id").count() == 1500 and found.where("n_shingles > 0").agg(F.min("n_similar")).first()[0] >= 41
    counted = token_counts.token_counts(df, public_tokenizers.path("piece_bpe_32k.model"))
    assert counted.count() == 3000 and counted.where("n_tokens = 0").count() == 1500 and counted.select("doc_id").distinct().count() == 3000
