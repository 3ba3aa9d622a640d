"""Language ID, PII, token counts and language-model scores."""

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from brindle.llm import hash_arrays, kneser_ney, language_id, pii, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    sizes = np.array([5, 1, 6, 3])
    scores = -rng.random((sizes.sum(), 3)).astype(np.float32) * 4
    found, at = language_id.viterbi(scores, sizes, 1.5), 0
    for n in sizes:
        s = scores[at : at + n]
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max(value(p) for p in np.ndindex(*[3] * n))
        assert math.isclose(value(tuple(found[at : at + n])), best, abs_tol=1e-4)
        at += n


def test_long_texts_are_gone_through_in_parts(spark):
    rng = np.random.default_rng(3)
    scores = -rng.random((5000, 4)).astype(np.float32) * 6
    scores[1000:3000, 2] = 0
    want = language_id.viterbi(scores, np.array([5000]), 5.0)
    assert (language_id.long_viterbi(lambda a, b: scores[a:b], 5000, 700, 5.0) == want).all() and len(set(want.tolist())) > 1
    text = "ab cd1ef " * 300_000
    assert [w for p in language_id.pieces(text) for w in language_id.words_of(p)] == language_id.words_of(text)


def plain_language(rows, texts):
    """Counts, word scores and the best path, written out for one word at a time; all texts use one script."""
    langs = sorted({k for _, k in rows})
    mask = (1 << 64) - 1

    def grams(word):
        points = [ord(c) for c in f" {word} "]
        for n in (1, 2, 3, 4):
            for at in range(len(points) - n + 1):
                if n == 1 and at in (0, len(points) - 1):
                    continue
                h = n
                for x in points[at : at + n]:
                    h = ((h ^ x) * 0x9E3779B97F4A7C15) & mask
                    h ^= h >> 29
                yield h % language_id.feature_count(len(langs))

    counts = {k: collections.Counter(g for t in {t for t, lang in rows if lang == k} for w in language_id.words_of(t) for g in grams(w)) for k in langs}
    totals = {k: sum(counts[k].values()) for k in langs}
    least = 0.5 / max(totals.values())
    out = []
    for text in texts:
        words, paths = language_id.words_of(text), {k: (0.0, []) for k in langs}
        for w in words:
            score = {k: sum(math.log(counts[k][g] / totals[k] + least) for g in grams(w)) for k in langs}
            score = {k: max(x - max(score.values()), -language_id.MOST) for k, x in score.items()}
            top = max(paths, key=lambda k: paths[k][0])
            stay = {k: paths[k] if paths[k][0] >= paths[top][0] - language_id.SWITCH else (paths[top][0] - language_id.SWITCH, paths[top][1]) for k in langs}
            paths = {k: (stay[k][0] + score[k], [*stay[k][1], k]) for k in langs}
        letters = collections.Counter()
        for w, k in zip(words, max(paths.values(), key=lambda x: x[0])[1], strict=True):
            letters[k] += len(w)
        best = max(letters, key=letters.get)
        out.append((best, letters[best] / sum(letters.values())))
    return out


def test_language_id_by_hand(spark):
    rng = random.Random(8)
    sounds = {"x": "ka lo mi te ru".split(), "y": "sha pre ont ild ug".split(), "z": "ée ñu ka ont quo".split()}
    say = lambda k, n: " ".join("".join(rng.choice(sounds[k]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = [(say(k, rng.randint(3, 40)), k) for k in sounds for _ in range(12)]
    texts = [t for t, _ in rows] + [say("x", 9) + " " + say("y", 12) + " " + say("z", 7) for _ in range(10)]
    model = language_id.learn(spark.createDataFrame(rows * 2, "text string, lang string"))
    got = language_id.Labeller(model).label(texts)
    for (lang, share), a, b in zip(plain_language(rows, texts), got.lang_pred, got.score, strict=True):
        assert lang == a and math.isclose(share, b, rel_tol=1e-9)


def test_many_languages(spark):
    rng = random.Random(9)
    words = {f"l{k:03}": ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(4)] for k in range(300)}
    df = spark.createDataFrame([(k, " ".join(w * 3), lang) for k, (lang, w) in enumerate(words.items())], "doc_id long, text string, lang string")
    model = language_id.learn(df)
    assert len(model.languages) == 300 and model.weights.size <= language_id.CELLS
    got = language_id.Labeller(model).label([" ".join(w * 2) for w in words.values()])
    assert (got.lang_pred == list(words)).mean() > 0.95


def test_language_id(spark, data, docs, empty):
    frame = spark.read.parquet(f"{data}/documents.parquet")
    got = language_id.language_id(frame).join(frame.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    odd = {r.doc_id: r for r in language_id.language_id(docs).collect()}
    assert odd[2].lang_pred == odd[3].lang_pred == odd[7].lang_pred == "und" and odd[5].lang_pred == "en" and odd[7].score == 0
    assert language_id.language_id(empty).count() == 0


def test_scripts_and_spans(spark):
    rows = [(1, "the cat and the dog " * 30, "en"), (2, "кошка и собака спят " * 30, "ru"), (3, "le chat et le chien " * 30, "fr")]
    model = language_id.learn(spark.createDataFrame(rows, "i int, text string, lang string"))
    got = language_id.Labeller(model).label(["the cat and the dog " * 5 + "кошка и собака спят " * 6, "漢字"])
    assert got.lang_pred[0] == "ru" and got.spans[0] == "0-25:en,25-49:ru" and 0 <= got.score[1] <= 1


def test_copies_teach_once(spark):
    """Whatever their hash, copies neither fill a language's quota nor outweigh its other texts."""
    texts = [(i, f"{w} {w}a", "en") for i, w in enumerate(["cat", "dog", "bird", "fish", "house"])] + [(9, "katze hund", "de")]
    frame = lambda rows: spark.createDataFrame(rows, "i int, text string, lang string")
    for docs in (3, 5):
        want = language_id.learn(frame(texts), docs=docs)
        got = language_id.learn(frame([t for t in texts for _ in range(20)]), docs=docs)
        assert got.languages == want.languages and all(np.array_equal(x, y) for x, y in zip(list(vars(got).values())[1:], list(vars(want).values())[1:], strict=True) if isinstance(x, np.ndarray))


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_patterns():
    rng = random.Random(1)
    for parts in ("a1@.+-4 2(.0", ["4111111111111111", "1.2.3.4", "256", ".", "@", "a", "+1 ", "555", "-", " ", "0", "é@x.y"]):
        for _ in range(4000):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
            assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_disclosing_terms(spark, docs, empty):
    rng = random.Random(2)
    rows = [(i, f"filler {rng.randint(0, 40)} common words about things number{i % 50}") for i in range(400)]
    rows += [(1000 + i, f"note {'abcdefgh'[i]} zanzibar project: write to bob@x.org about common things {i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    terms = {df_text[t.start : t.end] for i in range(1000, 1005) for df_text in [dict(rows)[i]] for t in got[i].terms}
    assert "zanzibar" in terms and "common" not in terms and all(not got[i].terms for i in range(400))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == dict(rows)[0] and "bob@x.org" not in clean[1000] and "zanzibar" not in clean[1000]
    assert got[1000].spans.split(",")[0].startswith("email:")
    assert pii.pii_digest(docs).count() == 9 and pii.find_pii(empty).count() == 0 and pii.sanitise(docs).columns == docs.columns
    assert {r.base_sha256 for r in pii.pii_digest(docs).collect()} == {pii.base_digest("")}


def test_sanitise_beside_columns_of_any_name(spark):
    columns = ["doc_id", "text", "base", "terms", "_x", "_i", "_g", "_h", "_id", "_doc", "_r", "near"]
    df = spark.createDataFrame([(1, "write to bob@x.org", *["v"] * 10), (None, None, *["v"] * 10)], ", ".join(f"{c} {'long' if c == 'doc_id' else 'string'}" for c in columns))
    got = pii.sanitise(df).orderBy("doc_id")
    assert got.columns == columns and [tuple(r)[1:3] for r in got.collect()] == [(None, "v"), ("write to [EMAIL]", "v")]
    assert pii.find_pii(df).count() == 2


def test_disclosing_terms_of_whole_texts(spark):
    """All counts by brute force: names on other lines, far away or repeated, entities of one document, and copies."""
    rng = random.Random(5)
    rows = [f"filler w{'abcdefgh'[rng.randint(0, 7)]}x common words about things" for _ in range(300)]
    far = "common words about things " * 30
    rows += [f"Xanthippe\n{far}\nwrite to xan@y.org\n{far} xanthippe again", f"quokkas {far} 10.0.0.9 {far}", f"quokkas and numbats {far} 10.0.0.9 only", "zorilla met ann@y.org and bob@y.org"]
    rows += [f"tell zebu {far} eve@y.org now"] * 3 + ["zebu alone"] * 40
    got = {r.doc_id: {rows[r.doc_id][t.start : t.end]: t.share for t in r.terms} | {"": len(r.terms)} for r in pii.find_pii(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    words, entities, context = [pii.terms_of(x) for x in rows], [], {}
    for i, x in enumerate(rows):
        entities.append({x[a:b] for _, a, b in pii.base_spans(x)})
        for _, a, b in pii.base_spans(x):
            context[i, x[a:b]] = (x[max(0, a - 120) : a], x[b : b + 120])
    for i, x in enumerate(rows):
        want = {}
        for e in entities[i]:
            holds = [j for j in range(len(rows)) if e in entities[j]]
            for t in words[i]:
                both = [j for j in holds if t in words[j]]
                p = len(rows) * len(both) * (1 - 0.5 / len({context[j, e] for j in both})) / len(holds) / sum(t in w for w in words)
                share = math.log2(p) / math.log2(len(rows) / len(holds))
                if share >= 0.8:
                    want[t] = max(share, want.get(t, 0))
        places = [m for m in re.finditer(r"[^\W\d_]{3,}", x) if m[0].lower() in want and not any(a < m.end() and m.start() < b for _, a, b in pii.base_spans(x))]
        assert got[i].pop("") == len(places) and set(got[i]) == {m[0] for m in places} and all(math.isclose(s, want[t.lower()]) for t, s in got[i].items()), x
    assert {"Xanthippe", "xanthippe"} <= set(got[300]) and "quokkas" in got[301] and "zorilla" in got[303] and "zebu" not in got[304] and "common" not in got[300]


def test_counts_equal_the_library():
    model, counter, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), token_counts.PieceCounter(MODEL, kept=50), random.Random(3)
    assert counter.by_form
    parts = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "漢", "<s>", "\x00", "😀", "word", ".", "\r\n", " ", "ﬁ"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert counter.count(text) == len(model.encode(text)), repr(text)


def test_cache(spark, docs, empty, tmp_path):
    cache = "file://" + str(tmp_path)
    first = sorted(map(tuple, token_counts.token_counts(docs, MODEL, cache).collect()), key=str)
    assert first == sorted(map(tuple, token_counts.token_counts(docs, MODEL, cache).collect()), key=str)
    stored = spark.read.option("recursiveFileLookup", "true").parquet(cache)
    assert stored.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert first == sorted(((r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or "")), len(model.encode(r.text or "")) > 4096) for r in docs.collect()), key=str)
    assert token_counts.token_counts(empty, MODEL).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json"])
def test_other_tokenizers(spark, docs, file):
    assert token_counts.token_counts(docs, public_tokenizers.path(file)).where("n_tokens >= 0").count() == 9


@pytest.mark.parametrize("bits", [33, 40, 47, 63, 64])
def test_sorted_arrays(spark, bits):
    """Short keys in their files against a plain dictionary."""
    rng, buckets = np.random.default_rng(bits), 7
    every = rng.integers(0, 2**bits, 4000, dtype=np.uint64, endpoint=False)
    every[:3] = 0, 2**bits - 1, hash_arrays.start_of(3, buckets, bits)
    keys, counts = np.unique(np.r_[every, every[: 1500]], return_counts=True)
    rows = spark.createDataFrame(hash_arrays.packed(keys, counts, buckets, bits), hash_arrays.PACKED)
    arrays, found = hash_arrays.make_arrays(rows.unionByName(rows), buckets, "test", bits=bits)
    assert found["n"].sum() == len(keys) and found["total"].sum() == 2 * counts.sum()
    place, n = arrays.find(keys)
    assert (place == np.arange(len(keys))).all() and (n == 2 * counts).all() and (arrays.at(place) == keys).all() and (arrays.at(place, "c") == n).all()
    other = np.setdiff1d(np.r_[keys + np.uint64(1), rng.integers(0, 2**bits, 4000, dtype=np.uint64)] & np.uint64(2**bits - 1), keys)
    assert (arrays.find(other)[0] == -1).all() and (hash_arrays.cells_of(0, buckets, bits) > 0) == (bits < 50)


@pytest.mark.parametrize("bits", [33, 47, 64])
@pytest.mark.parametrize("n", [0, 3, 4000])
def test_joined_arrays(spark, bits, n, monkeypatch):
    """Keys and numbers of any size in joined files against plain arrays."""
    monkeypatch.setattr(hash_arrays, "IN_RANGE", 1024)
    rng, buckets = np.random.default_rng(bits + n), 7
    keys = rng.integers(0, 2**bits, n, dtype=np.uint64, endpoint=False)
    keys[:3] = (0, 2**bits - 1, hash_arrays.start_of(3, buckets, bits))[:n]
    keys = np.unique(keys)
    counts = rng.choice([1, 2, 254, 255, 256, 70_000], len(keys))
    parts, found = hash_arrays.make_arrays(spark.createDataFrame(hash_arrays.packed(keys, counts, buckets, bits), hash_arrays.PACKED), buckets, "test", bits=bits)
    arrays = hash_arrays.JoinedArrays(parts, found)
    places = np.arange(len(keys))
    mixed = rng.permutation(places)
    assert (arrays.find(keys[mixed]) == mixed).all() and (arrays.counts(mixed) == counts[mixed]).all() and (arrays.keys(places) == keys).all()
    other = np.setdiff1d(np.r_[keys + np.uint64(1), rng.integers(0, 2**bits, 4000, dtype=np.uint64)] & np.uint64(2**bits - 1), keys)
    assert (arrays.find(other) == -1).all() and arrays.counts(np.array([-1]))[0] == 0 and arrays.short == (bits == 33 and n > 0)
    arrays.mark()
    number, repeated = arrays.number(mixed)
    assert (repeated == (counts[mixed] > 1)).all() and (number == (np.cumsum(counts > 1) - (counts > 1))[mixed]).all() and arrays.marked[-1] == (counts > 1).sum()


def test_lookups_take_few_steps(spark, monkeypatch):
    """Spread keys are found at the first places of their cells, mostly, and keys that all share one by halving; a text's
    words are looked up once each."""
    rng, bits, buckets = np.random.default_rng(9), 47, 7
    plain, halved = hash_arrays.lower_bound, []
    monkeypatch.setattr(hash_arrays, "lower_bound", lambda values, wanted, low, high: halved.append(len(wanted)) or plain(values, wanted, low, high))
    for keys, most in ((np.unique(rng.integers(0, 2**bits, 4000, dtype=np.uint64)), 1000), (np.arange(0, 12_000, 3, dtype=np.uint64), 4000)):
        parts, found = hash_arrays.make_arrays(spark.createDataFrame(hash_arrays.packed(keys, np.ones(len(keys)), buckets, bits), hash_arrays.PACKED), buckets, "test", bits=bits)
        arrays, mixed = hash_arrays.JoinedArrays(parts, found), rng.permutation(len(keys))
        halved.clear()
        assert (arrays.find(keys[mixed]) == mixed).all() and sum(halved) < most
        assert (arrays.find(np.setdiff1d(keys + np.uint64(1), keys)) == -1).all()
    model = kneser_ney.train(spark.createDataFrame([("a b " * 300,), ("b c",)], "text string"))
    plain_find, wanted = hash_arrays.JoinedArrays.find, []
    monkeypatch.setattr(hash_arrays.JoinedArrays, "find", lambda arrays, keys: wanted.append((arrays, keys)) or plain_find(arrays, keys))
    got = model.score(*hash_arrays.word_hashes(["a b " * 300, "b d"], end=True))
    assert [len(k) for arrays, k in wanted if arrays is model.levels[0].arrays] == [4] and got["n_known"].tolist() == [601, 2]


def test_kneser_ney_many_buckets(spark, monkeypatch):
    """What a text's score opens and looks through doesn't grow with the buckets of the corpus."""
    rng = random.Random(5)
    texts = spark.createDataFrame([(i, " ".join(f"w{min(rng.randint(0, 400), rng.randint(0, 400))}" for _ in range(40))) for i in range(150)], "doc_id long, text string")
    few = kneser_ney.lm_scores(texts).collect()
    monkeypatch.setattr(hash_arrays, "BUCKET_BYTES", 100)
    monkeypatch.setattr(kneser_ney, "SHARE", 900)
    assert hash_arrays.bucket_count(texts, "text") > 200
    assert sorted(kneser_ney.lm_scores(texts).collect()) == sorted(few)
    model = kneser_ney.train(texts)
    model.score(*hash_arrays.word_hashes([r.text for r in texts.collect()], end=True))
    for level in model.levels:
        assert len(level.arrays.open) <= 9 and len(os.listdir(level.arrays.folder)) <= 9


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_by_hand(spark, order):
    rng = random.Random(4)
    words = [f"W{min(rng.randint(0, 9), rng.randint(0, 9))}" for _ in range(4000)]
    texts = [(i, rng.choice([" ", "\t", "\x0b\n"]).join(words[i * 13 : i * 13 + rng.randint(0, 14)])) for i in range(250)]
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", t.lower()) + [None] for i, t in texts}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for i in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    grams = [collections.Counter() for _ in range(order + 1)]
    for i in train:
        padded = ["<s>", *tokens[i]]
        for k in range(1, order + 1):
            grams[k].update(tuple(padded[j : j + k]) for j in range(k == 1, len(padded) - k + 1))
    # lower orders count what precedes; what begins a text keeps its count
    for k in range(1, order):
        before = collections.Counter(g[1:] for g in grams[k + 1])
        grams[k] = collections.Counter({g: before[g] or x for g, x in grams[k].items()})
    d = [None] + [kneser_ney.discounts(*(sum(x == k for x in own.values()) for k in range(1, 5))) for own in grams[1:]]
    after, given = collections.Counter(), collections.Counter()
    for k in range(1, order + 1):
        for g, x in grams[k].items():
            after[k, g[:-1]] += x
            given[k, g[:-1]] += d[k][min(x, 3)]

    def p(context, w):
        k = len(context) + 1
        low = p(context[1:], w) if k > 1 else 1 / (v + 1)
        if not after[k, context]:
            return low
        x = grams[k][(*context, w)]
        return (max(x - d[k][min(x, 3)], 0) + given[k, context] * low) / after[k, context]

    for context in [("w0",), ("w0", "w1"), ("<s>", "w2"), ("<s>",)]:
        assert math.isclose(sum(p(context[-order + 1 :], w) for w in c) + p(context[-order + 1 :], "unseen"), 1)
    for r in kneser_ney.lm_scores(spark.createDataFrame(texts, "doc_id long, text string"), order=order).collect():
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
        padded = ["<s>", *t]
        assert math.isclose(r.score, sum(math.log10(p(tuple(padded[max(0, j - order + 1) : j]), padded[j])) for j in range(1, len(padded))))


def test_kneser_ney_edges(spark, docs, empty):
    got = sorted(((r.doc_id, r.n_tokens, round(r.score, 9)) for r in kneser_ney.lm_scores(docs).collect()), key=str)
    sizes = sorted(((r.doc_id, len((r.text or "").split()) + 1) for r in docs.collect()), key=str)
    assert [x[:2] for x in got] == sizes and got.count(next(x for x in got if x[0] == 6)) == 2 and all(x[2] <= 0 for x in got)
    assert kneser_ney.lm_scores(empty).count() == 0
    # all held out: nothing is learned, every word is as likely
    alone = docs.where("doc_id = 5").withColumn("doc_id", F.lit(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)).cast("long"))
    row = kneser_ney.lm_scores(alone).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (30_001, 0, 0, 0.0)
