"""N-gram join, line dedup, packing, top-k and the pipeline."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import components, cover_tree, line_dedup, ngram_join, packing, stages


def near(texts, percent=60):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else set(w)
    links = {i: set() for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(sets[i]), len(links[i]), min(seen))
    return out


@pytest.mark.parametrize("coordinates", [1 << 20, 300])
def test_ngram_join(spark, coordinates):
    rng = random.Random(7)
    common = [f"w{k}" for k in range(12)]
    texts = []
    for family in range(12):
        base = [rng.choice(common) if rng.random() < 0.4 else f"r{rng.randint(0, 500)}" for _ in range(rng.choice([2, 5, 30, 150]))]
        for _ in range(rng.choice([1, 3, 14])):
            copy = [w if rng.random() > 0.08 else f"n{rng.randint(0, 99)}" for w in base]
            texts.append((len(texts), " ".join(copy)))
    texts += [(len(texts) + k, rng.choice(["w1 w2", "w1", "w1 w2 w3", "", "W1\tw2"])) for k in range(12)]
    got = {r.doc_id: (r.n_shingles, r.n_similar, r.component_id) for r in ngram_join.ngram_join(spark.createDataFrame(texts, "doc_id long, text string"), part_coordinates=coordinates).collect()}
    assert got == near(texts)


def test_ngram_join_of_a_large_family(spark):
    """Thousands of texts from one template, beside texts that share words only, and a text repeated with its id."""
    rng = np.random.default_rng(11)
    base = rng.integers(0, 3000, 60)
    words = np.where(rng.random((4000, 60)) < rng.choice([0.02, 0.08, 0.2], (4000, 1)), rng.integers(0, 3000, (4000, 60)), base)
    words = np.r_[words, rng.integers(0, 60, (600, 60))]
    ids = [*range(len(words)), 17, 17]
    texts = [" ".join(map(str, w)) for w in words]
    sets = [set(zip(w, w[1:])) for w in (words[i].tolist() for i in ids)]
    place = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    held = np.zeros((len(sets), len(place)), dtype=np.float32)
    for k, own in enumerate(sets):
        held[k, [place[x] for x in own]] = 1
    shared, n = held @ held.T, held.sum(axis=1)
    link = 100 * shared >= 60 * (n[:, None] + n[None, :] - shared)
    root = np.array(ids)
    while True:
        after = np.where(link, root[None, :], 1 << 30).min(axis=1)
        if (after == root).all():
            break
        root = after
    want = sorted((i, int(n[k]), int(link[k].sum()) - 1, int(root[k])) for k, i in enumerate(ids))
    df = spark.createDataFrame([(i, texts[i]) for i in ids], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.ngram_join(df, part_coordinates=1 << 16).collect())) == want


def test_ngram_join_edges(docs, empty):
    got = collections.defaultdict(list)
    for r in ngram_join.ngram_join(docs).collect():
        got[r.doc_id].append((r.n_shingles, r.n_similar, r.component_id))
    assert got[2] == [(0, 0, 2)] and got[1] == [(5, 1, 1)] and got[4] == [(5, 1, 1)] and got[6] == [(1, 1, 6)] * 2 and got[None] == [(2, 0, None)]
    assert ngram_join.ngram_join(empty).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64)) for _ in range(2))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.7], b[: len(b) // 4]])
        x, y = ngram_join.point_of(a), ngram_join.point_of(b)
        n = min(len(x), len(y))
        assert np.minimum(ngram_join.folded(x, n), ngram_join.folded(y, n)).sum() >= len(np.intersect1d(a, b))
        assert (ngram_join.unpack_point(ngram_join.pack_point(x)) == x).all()


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)], "a long, b long")
    assert {(r.node, r.root) for r in components.components(edges).collect()} == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}


def copied(docs, least):
    lines = [[(k, x) for k, x in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for _, t in docs]
    words = lambda run: sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for _, x in run)
    places = [(d, p) for d in range(len(docs)) for p in range(len(lines[d]))]
    gone = {i: set() for i, _ in docs}
    for x, (d, p) in enumerate(places):
        for e, q in places[:x]:
            n = 0
            while p + n < len(lines[d]) and q + n < len(lines[e]) and lines[d][p + n][1] == lines[e][q + n][1]:
                n += 1
            if n and words(lines[d][p : p + n]) >= least:
                gone[docs[d][0]].update(k for k, _ in lines[d][p : p + n])
    for (i, _), own in zip(docs, lines, strict=True):
        for (a, _), (b, _) in zip(own, own[1:], strict=False):
            if a in gone[i] and b in gone[i]:
                gone[i].update(range(a, b))
    return gone


@pytest.mark.parametrize("least", [4, 9])
def test_line_dedup(spark, least):
    rng = random.Random(least)
    pool = ["a b c", "d e", "f", "g h i j", "k l", "", "m n o p q r"]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.8 else f"u{rng.random()} v" for _ in range(rng.randint(0, 12)))) for i in range(30)]
    docs += [(30, docs[3][1]), (31, "\n".join(["f"] * 20))]
    want = copied(docs, least)
    for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), min_words=least).collect():
        assert {k for x in r.removed for k in range(x.start, x.end + 1)} == want[r.doc_id]
        lines = dict(docs)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in want[r.doc_id]) and r.n_removed == len(want[r.doc_id]) and r.n_lines == len(lines)


def test_line_dedup_edges(docs, empty):
    got = line_dedup.line_dedup(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed", "removed"] and got.count() == 9 and got.where("n_removed > 0").count() == 0
    assert got.where("doc_id = 2 AND text IS NULL AND n_lines = 0").count() == 1 and line_dedup.line_dedup(empty).count() == 0


def test_bucket_bounds():
    rng = random.Random(1)
    for _ in range(150):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 9) for _ in lengths]
        cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts, strict=True))  # noqa: B023, E731
        for k in (1, 2, 3, 4):
            best = min(cost((*inner, lengths[-1])) for m in range(min(k, len(lengths))) for inner in itertools.combinations(lengths[:-1], m))
            found = packing.bucket_bounds(np.array(lengths), np.array(counts), k)
            assert len(found) <= k and found == sorted(set(found)) and cost(found) == best


def test_pack(spark, docs, empty):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(90))).cast("int")).alias("text"))
    got = packing.pack(df, buckets=4, budget=200, max_length=50).collect()
    size = {r.doc_id: len((r.text or "").split()) for r in df.collect()}
    pieces = collections.defaultdict(list)
    batches = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.n_tokens))
        if r.n_tokens:
            assert r.n_tokens <= r.bucket_len <= 50
            batches[r.bucket_id, r.batch].append((r.slot, r.bucket_len))
    for i, n in size.items():
        at = 0
        for start, k in sorted(pieces[i]):
            assert start == at
            at += k
        assert at == n
    for (bucket, batch), rows in batches.items():
        room = 200 // rows[0][1]
        assert sorted(s for s, _ in rows) == list(range(len(rows))) and len(rows) <= room and (len(rows) == room or batch == max(b for k, b in batches if k == bucket))
    assert packing.pack(empty).count() == 0
    none = packing.pack(docs).where("doc_id IN (2, 3)").collect()
    assert [(r.n_tokens, r.bucket_id) for r in none] == [(0, None)] * 2


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = [rng.normal(size=8).tolist() if i % 5 else rng.integers(-1, 2, 8).astype(float).tolist() for i in range(400)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(900, None), (901, [1.0, None] + [0.0] * 6), (902, [float("nan")] * 8), (None, [0.0] * 8), (950, [1.0, 2.0]), (7, vectors[7]), (1000, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for k, (i, v) in enumerate(good):
        if i % 50 == 0:
            ranked = sorted((-int(v @ w), j) for m, (j, w) in enumerate(good) if m != k and len(w) == len(v))[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(ranked)]
    got = cover_tree.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert cover_tree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e6, 5e13])
def test_top_k_odd_and_large_components(spark, size):
    """NaN or infinity in one component, and components whose scores are beyond 2^53."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=6) * (1 if i % 2 else size)).tolist()) for i in range(200)]
    if size > 1e13:  # scores that a long holds: large components meet small ones only
        rows = [(i, [0.0] * 5 + [float(i % 9)] if i % 2 else [size + 2**-4 * i, *rng.integers(-2, 3, 4).tolist(), float(i)] if i % 50 else [0.0, *rng.integers(-2, 3, 5).astype(float).tolist()]) for i in range(200)]
        rows = [(i, [float(x) for x in v]) for i, v in rows] + [(300, [2.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    odd = [(1000 + k, [100.0 * size] * 5 + [x]) for k, x in enumerate([float("nan"), float("inf"), -float("inf")])]
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for i, v in good:
        if i % 50 == 0:
            ranked = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(ranked)]
    got = cover_tree.top_k(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_cover_tree_covers():
    points = np.random.default_rng(3).normal(size=(700, 5))
    tree = cover_tree.CoverTree.build(points)
    assert sorted(tree.order.tolist()) == list(range(700))
    for k in range(len(tree.centre)):
        own = points[tree.order[tree.begin[k] : tree.end[k]]]
        assert np.linalg.norm(own - points[tree.centre[k]], axis=1).max() <= tree.radius[k] + 1e-9
        if tree.children[k]:
            assert sum(tree.end[c] - tree.begin[c] for c in tree.children[k]) == len(own)


def test_stages(spark, data, docs, empty):
    for stage in (stages.with_known_language, stages.without_copied_lines, stages.without_near_copies, stages.mixed):
        assert stage(docs).columns == docs.columns and stage(empty).count() == 0
    assert stages.packed(docs).count() >= 9
    passage = " ".join(f"long{k}" for k in range(60))
    rows = [(1, f"one first words\n{passage}", "s"), (2, f"two other words\n{passage}\nend of two", "s"), (3, passage, "s")]
    found = {r.doc_id: r for r in stages.without_copied_lines(spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, source string, n_chars long")).collect()}
    assert sorted(found) == [1, 2] and found[2].text == "two other words\nend of two" and found[2].n_chars == len(found[2].text) and found[1].text == rows[0][1]


def test_texts_of_three_languages_stay(spark):
    words = {"en": "the cat and the dog ", "ru": "кошка и собака спят ", "el": "γάτα και σκύλος μαζί "}
    rows = [(i, w * 30, k) for i, (k, w) in enumerate([*words.items()] * 4)]
    rows += [(50, words["en"] * 8 + words["ru"] * 7 + words["el"] * 6, None), (51, "... 123", None), (52, None, "en")]
    stayed = {r.doc_id for r in stages.with_known_language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert stayed == {*range(12), 50}


CLASHING = ["_doc", "_label", "_copy", "_copies", "_stay", "_row", "_i", "_mixed", "kept", "group", "_id", "_text", "_key", "_h", "removed", "n_lines", "digest", "x"]


def test_stages_beside_columns_of_any_name(docs, empty):
    for stage in (stages.with_known_language, stages.without_near_copies, stages.mixed):
        odd = docs.withColumns({c: F.lit("own") for c in CLASHING})
        got = stage(odd)
        assert got.columns == odd.columns and got.where(" AND ".join(f"{c} = 'own'" for c in CLASHING)).count() == stage(docs).count()
        assert stage(empty.withColumns({c: F.lit("own") for c in CLASHING})).count() == 0


def test_one_document_of_each_group_stays(spark):
    family = [f"a common long text of many words {k}" for k in range(3)]
    rows = [(5, family[0]), (None, family[1]), (None, family[2]), (None, "other words stand alone here"), (None, "other words stand alone here"), (8, "tie tie"), (8, "tie tie"), (None, None), (None, None), (9, "")]
    kept = sorted(map(tuple, stages.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert kept == sorted([(5, family[0]), (None, "other words stand alone here"), (8, "tie tie"), (None, None), (None, None), (9, "")], key=str)


def mix_by_hand(rows):
    """Copies of every ``(id, text, source)`` by the rule of Pareto order sampling, in plain Python."""
    import hashlib

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, open_, left = {}, set(sources), 1.5 * sum(total.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * total[s]]
        for s in over or list(open_):
            target[s] = min(share[s], 2.0 * total[s])
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    out = []
    for s in sources:
        ratio = target[s] / total[s] if total[s] else 0.0
        whole, p = int(ratio), ratio - int(ratio)
        drawn = []
        for i, t, x in rows:
            if x == s:
                u = (int(hashlib.sha256(f"mix:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                drawn.append(((u / (1 - u)) / (p / (1 - p)) if p else 0.0, (i is not None, i or 0), size(t), (i, t, x)))
        upto = 0
        for _, _, n, row in sorted(drawn, key=lambda d: d[:3]):
            upto += n
            out += [row] * (whole + (p > 0 and 2 * upto - n <= 2 * (target[s] - whole * total[s])))
    return out


def test_pipeline_by_hand(spark, tmp_path):
    """Every stage's rows, and the run's, against brute force."""
    import corpus_pipeline

    rng = random.Random(12)
    passage = "\n".join(" ".join(f"p{k}x{j}q" for j in range(12)) for k in range(6))
    rows = [(i, " ".join(rng.choice("abcdefgh") + rng.choice("ijkl") + str(rng.randint(0, 300)) + "w" for _ in range(rng.randint(8, 60))), rng.choice(["s0", "s1", None])) for i in range(60)]
    rows += [(100 + i, f"own start {i}\n{passage}\nown end number {i} of these", "s1") for i in range(4)] + [(110, passage, "s0")]
    rows += [(120 + i, rows[i][1] + " extra", "s0") for i in range(8)] + [(130, "123 ...", "s1"), (131, None, "s1"), (132, "", None)]
    df = spark.createDataFrame([(i, t, "en" if i % 2 else "de", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    plain = lambda d: sorted(((r.doc_id, r.text, r.source) for r in d.collect()), key=str)
    now = [(i, t, s) for i, t, s in rows if re.search(r"[^\W\d_]", t or "")]
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = stages.with_known_language(kept)
    assert plain(kept) == sorted(now, key=str)
    gone = copied([(i, t) for i, t, _ in now], line_dedup.MIN_WORDS)
    now = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), s) for i, t, s in now]
    now = [r for r in now if r[1].strip() or not gone[r[0]]]
    kept = stages.without_copied_lines(kept)
    assert plain(kept) == sorted(now, key=str) and sum(map(len, gone.values())) >= 24
    groups = near([(i, t) for i, t, _ in now])
    before = len(now)
    now = [r for r in now if groups[r[0]][2] == r[0]]
    kept = stages.without_near_copies(kept)
    assert plain(kept) == sorted(now, key=str) and len(now) < before
    now = mix_by_hand(now)
    kept = stages.mixed(kept)
    assert plain(kept) == sorted(now, key=str)
    got = [tuple(r) for r in stages.packed(kept).collect()]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str) == sorted(got, key=str)
    lengths = collections.Counter((i, len(t.split())) for i, t, _ in now)
    assert collections.Counter((r[0], r[3]) for r in got) == lengths
    ends = packing.bucket_bounds(np.array(sorted({n for _, n in lengths})), np.array([sum(c for (_, n), c in lengths.items() if n == k) for k in sorted({n for _, n in lengths})]), packing.BUCKETS)
    assert all(r[5] == min(e for e in ends if e >= r[3]) for r in got)


def test_pipeline(spark, data):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "source_mixing", "packing"]
    first, second = (sorted(map(tuple, corpus_pipeline.run(spark, data).collect())) for _ in range(2))
    assert first == second and first
