"""Personal data: fixed patterns, and terms that corpus co-occurrence shows to reveal what the patterns found."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_batches, small, text_of, written

KINDS = ("email", "ip", "card", "phone")
#: Characters on either side of an entity that tell its contexts apart: copies of a text show the same ones.
WINDOW = 120
#: A term discloses if it carries this share of an entity's information; so much is taken off the number of contexts.
DISCLOSURE, DISCOUNT = 0.8, 0.5
#: Bits of the set of candidate terms that the counting pass carries: a fixed 512 KB, whatever the corpus.
FILTER_BITS = 1 << 22

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Takes every run of digits whole, so that a long one is read once.
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @, as neither part of the pattern can hold one; linear in the text."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    """Four numbers at a time from the left of every chain of numbers and points."""
    found = []
    for m in CHAIN.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append((at, end))
            at = end + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans by kind as listed, then start."""
    digits = DIGIT.search(text) is not None
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if digits:
        found += [("ip", *s) for s in ips(text)] + [("card", *s) for s in cards(text)]
        if "+" in text:
            found += [("phone", *s) for s in phones(text)]
    return found


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode()) - (1 << 63)


def terms_of(text: str) -> set[str]:
    """The distinct words of a whole text that count as terms."""
    return {w.lower() for w in set(TERM.findall(text))}


def entities_in(text: str, spans: list[tuple[str, int, int]]) -> dict[int, int]:
    """Each entity with its context: of the characters around its places, the hash that is smallest."""
    found: dict[int, int] = {}
    for kind, a, b in spans:
        entity = _hash(f"{kind}:{text[a:b].lower()}")
        context = _hash(text[max(0, a - WINDOW) : a].lower() + "\n" + text[b : b + WINDOW].lower())
        found[entity] = min(context, found.get(entity, context))
    return found


def term_places(text: str, spans: list[tuple[str, int, int]]) -> dict[int, list[tuple[int, int]]]:
    """The terms of the whole text with all their places outside the spans; none for a term that only spans hold."""
    found: dict[str, list[tuple[int, int]]] = {w: [] for w in terms_of(text)}
    taken = sorted((a, b) for _, a, b in spans)
    k, reach = 0, 0
    for m in TERM.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= m.start():
            found[m[0].lower()].append(m.span())
    return {_hash(w): places for w, places in found.items()}


PLACES = "array<struct<start:int,end:int>>"
SCAN = f"`_id` {{kind}}, _h long, n_email long, n_ip long, n_card long, n_phone long, base string, entities array<struct<entity:long,context:long>>, near array<struct<term:long,places:{PLACES}>>"


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """What each text holds; only texts with an entity list their terms. ``_r`` numbers the rows once written."""
    bounded_batches(df.sparkSession)
    source = df.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).withColumn("_h", F.xxhash64("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["_text"]:
                spans = base_spans(text)
                n = [sum(k == kind for k, _, _ in spans) for kind in KINDS] if spans else [0, 0, 0, 0]
                entities = [{"entity": e, "context": c} for e, c in entities_in(text, spans).items()]
                near = [{"term": t, "places": [{"start": a, "end": b} for a, b in places]} for t, places in term_places(text, spans).items()] if spans else []
                out.append((*n, ",".join(f"{k}:{a}:{b}" for k, a, b in spans), entities, near))
            found = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "entities", "near"])
            found.insert(0, "_id", batch["_id"].to_numpy())
            found.insert(1, "_h", batch["_h"].to_numpy())
            yield found

    return source.mapInPandas(run, SCAN.format(kind=source.schema["_id"].dataType.simpleString())).withColumn("_r", F.monotonically_increasing_id())


def document_frequency(df: DataFrame, scanned: DataFrame, text_col: str) -> DataFrame:
    """``term, n_term``: documents that hold each term of ``scanned``'s texts with an entity, over all rows of ``df``.

    The pass over the texts carries a bit set of fixed size; it lets other terms through by chance, each counted in full.
    """

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            terms = np.concatenate([np.zeros(0, dtype=np.int64), *batch["terms"]]).astype(np.int64)
            yield pd.DataFrame({"slot": np.unique(terms.astype(np.uint64) % np.uint64(FILTER_BITS)).astype(np.int64)})

    slots = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    terms = scanned.where(F.size("near") > 0).select(F.col("near.term").alias("terms"))
    slot = terms.mapInPandas(bits, "slot long").groupBy(F.floor(F.col("slot") / 8).alias("byte")).agg(F.expr("bit_or(shiftleft(1, CAST(slot % 8 AS INT)))").alias("bits")).toPandas()
    slots[slot["byte"].to_numpy(dtype=np.int64)] = slot["bits"].to_numpy(dtype=np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(slots)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, cache = shared.value, {}
        for batch in batches:
            seen: dict[int, int] = {}
            for text in batch["_text"]:
                for word in terms_of(text):
                    h = cache.get(word, 0)
                    if h == 0:
                        if len(cache) > 500_000:
                            cache.clear()
                        value = _hash(word)
                        place = int(np.int64(value).astype(np.uint64) % np.uint64(FILTER_BITS))
                        h = cache[word] = value if held[place >> 3] >> (place & 7) & 1 else None
                    if h is not None:
                        seen[h] = seen.get(h, 0) + 1
            yield pd.DataFrame({"term": np.array(list(seen), dtype=np.int64), "n": np.array(list(seen.values()), dtype=np.int64)})

    return df.select(text_of(text_col).alias("_text")).mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing_terms(scanned: DataFrame, df: DataFrame, text_col: str, disclosure: float = DISCLOSURE, discount: float = DISCOUNT) -> DataFrame:
    """``_r, term, places, share``: for each row of ``scanned`` the terms that reach ``disclosure`` of the information of
    an entity in the same text, and all their places there.

    PMI is log2(N n(e,t) (1 - discount/c) / (n(e) n(t))) and the information of an entity log2(N / n(e)). N and n count all
    documents, whole texts; c is the number of distinct contexts of the entity in documents with the term. Copies raise
    n(e,t), n(e) and n(t) alike and leave c as it is, so they prove nothing; one context still counts, at 1 - discount.

    A pair is left out before it is counted only if n(e,t) <= n(e) already proves its share too small. Entities of one
    document have equal shares with each of its terms, so one of them stands for all.
    """
    entities = written(scanned.select("_r", F.explode("entities").alias("x")).select("_r", "x.*"), "pii-entities")
    known = written(entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "pii-known")
    total, most = float(scanned.count()), known.agg(F.max("n_entity")).first()[0]
    if not most:
        return scanned.select("_r", F.lit(0).cast("long").alias("term"), F.array().cast(PLACES).alias("places"), F.lit(0.0).alias("share")).limit(0)
    n = F.lit(total)
    bound = lambda count: n * F.pow(count / n, F.lit(disclosure)) * (1 + 1e-9)
    entities = entities.join(small(known), "entity")
    entities = entities.where("n_entity > 1").unionByName(entities.where("n_entity = 1").dropDuplicates(["_r"]))
    frequency = written(document_frequency(df, scanned, text_col), "pii-terms")
    limit = bound(F.lit(float(most)))
    hot = F.broadcast(frequency.where(F.col("n_term") > limit).orderBy(F.desc("n_term")).select("term").limit(BROADCAST_ROWS))
    terms = scanned.select("_r", F.explode("near").alias("x")).select("_r", "x.*").join(hot, "term", "left_anti").join(frequency.where(F.col("n_term") <= limit), "term")
    pairs = written(terms.join(entities, "_r").where(F.col("n_term") <= F.greatest(bound(F.col("n_entity")), F.col("n_entity"))), "pii-pairs")
    counted = pairs.groupBy("entity", "term", "n_entity", "n_term", "context").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.groupBy("entity", "term", "n_entity", "n_term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("n_joint"))
    pmi = F.log2(n * F.col("n_joint") * (1 - F.lit(discount) / F.col("contexts")) / (F.col("n_entity") * F.col("n_term")))
    own = F.log2(n / F.col("n_entity"))
    shares = counted.select("entity", "term", F.when(own > 0, pmi / own).otherwise(F.lit(0.0)).alias("share")).where(F.col("share") >= disclosure)
    found = pairs.select("_r", "entity", "term", "places").join(shares, ["entity", "term"])
    return found.groupBy("_r", "term").agg(F.first("places").alias("places"), F.max("share").alias("share"))


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, discount: float = DISCOUNT) -> DataFrame:
    """One row per input row: ``id_col, n_email, n_ip, n_card, n_phone, base, terms, spans``.

    ``base`` holds the pattern spans as ``kind:start:end`` (code points, end exclusive) by kind and start; ``terms`` every
    place of a disclosing term in a text that holds the entity it reveals, with the share of its information; ``spans``
    all of them, the terms' last. Null texts count as empty and hold nothing. Rows that repeat id and text get the same
    result. Whole texts are read; an empty table gives an empty result; other columns are not read.
    """
    scanned = written(scan(df, id_col, text_col), "pii-scan")
    found = disclosing_terms(scanned, df, text_col, disclosure, discount).select("_r", "share", F.explode("places").alias("x"))
    terms = found.groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("x.start", "x.end", "share"))).alias("_terms"))
    out = scanned.drop("entities", "near").join(terms, "_r", "left")
    out = out.withColumn("terms", F.coalesce("_terms", F.array().cast("array<struct<start:int,end:int,share:double>>")))
    listed = F.transform("terms", lambda t: F.concat(F.lit("term:"), t["start"], F.lit(":"), t["end"]))
    spans = F.array_join(F.concat(F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.array("base")), listed), ",")
    return out.select(F.col("_id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base", "terms", spans.alias("spans"), "_h")


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE, remove: float = 1.0) -> DataFrame:
    """``df`` with ``text_col`` sanitised: pattern spans become ``[EMAIL]`` and so on, a disclosing term is generalised
    to ``[TERM]``, or removed where it carries ``remove`` or more of the entity's information.

    Overlapping spans are replaced as one, under the name of the first. Null texts stay null. Equal ids with equal texts
    get equal results; all other columns pass through.
    """
    found = find_pii(df, id_col, text_col, disclosure).select(F.col(id_col).alias("_i"), F.col("_h").alias("_g"), "base", "terms").dropDuplicates(["_i", "_g"])
    own = df.select(F.struct(*df.columns).alias("_doc"), F.col(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_x"))
    joined = own.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_x") == F.col("_g")), "left")

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, bases: pd.Series, terms: pd.Series) -> pd.Series:
        def one(text, base, near):
            if text is None:
                return None
            spans = [(int(a), int(b), f"[{k.upper()}]") for k, a, b in (s.split(":") for s in (base or "").split(",") if s)]
            spans += [(t["start"], t["end"], "" if t["share"] >= remove else "[TERM]") for t in (near if near is not None else [])]
            out, at = [], 0
            for a, b, name in sorted(spans):
                if a >= at:
                    out += [text[at:a], name]
                at = max(at, b)
            return "".join([*out, text[at:]])

        return pd.Series([one(*x) for x in zip(texts, bases, terms, strict=True)])

    text = rewrite(F.col("_doc").getField(text_col), F.col("base"), F.col("terms"))
    return joined.select(*[(text if c == text_col else F.col("_doc").getField(c)).alias(c) for c in df.columns])


def pii_digest(df: DataFrame) -> DataFrame:
    """The query's columns: the counts, the digest of the base spans, and all spans."""
    return find_pii(df).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def base_digest(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text or "")).encode()).hexdigest()
