"""Personal data and the terms that give it away.

Four kinds of personal data are found by their form: e-mail addresses, IP addresses, card and phone numbers. These, and the
groups they belong to (mail domains, network halves, issuers, area codes), are the protected entities. The corpus then
tells which other terms disclose them: for a term t and an entity e, P(e | t) is the share of the texts with t that have e
as well, anywhere, and log2 P(e | t) / P(e) is the information that t gives about e. A term that has enough of both, seen
with the entity in at least `SUPPORT` texts, is generalised wherever it occurs, and removed from a higher share on.
Every row is a text. Terms are words of at least three characters; in scripts that are written
without blanks, pairs of neighbouring characters.

An entity in fewer texts than the support, or in so many that no term could give enough information about it, has no
terms; the pairs of the others are counted inside the tasks before they are shuffled. A term that is with other protected
entities in too many texts for the share is left out before its texts are counted. Which texts have one of these
entities, and how many have a term of those pairs, is asked with a bitmap of at most 2**23 bits (1 MB) over hashes, whose
hits are then joined exactly. No list of entities or terms is broadcast, and a full bitmap costs time, not correctness.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import replacing, settle, whole

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
GENERALISE, REMOVE = 0.5, 0.9
BITS_OF_INFORMATION = 4.0
SHORTEST = 3
FILTER_BITS = 1 << 23
#: Distinct pairs that a task counts before it passes them on.
HELD = 1 << 18
BLOCK_BITS = 32_768

# Fixed patterns of the four kinds and of words.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+")
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
PARTS = re.compile(f"{UNSPACED.pattern}|{UNSPACED.pattern.replace('[', '[^', 1)}")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: before each @ the longest run of its characters, after it a dotted name."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        name = DOMAIN.match(text, at + 1) if start < at else None
        if name:
            yield start, name.end()
            free = name.end()
        else:
            free = at + 1
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            for m in IP.finditer(text, run.start(), run.end()):
                parts = [p.lstrip("0") for p in m.group().split(".")]
                if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
                    yield m.span()


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    return [(kind, *span) for kind, find in FINDERS.items() for span in find(text)]


def entities(kind: str, value: str) -> tuple[str, str]:
    """The protected value behind a span, and the group it belongs to.

    Numbers count without their punctuation, addresses in lower case. Groups are the domain of an e-mail address, the
    upper half of an IP address, the issuer digits of a card and the leading digits of a phone number.
    """
    value = value.lower()
    if kind == "email":
        group = value.split("@", 1)[1]
    elif kind == "ip":
        group = ".".join(value.split(".")[:2])
    else:
        value = NOT_DIGIT.sub("", value)
        group = value[: 6 if kind == "card" else 4]
    return f"{kind}:{value}", f"{kind} group:{group}"


def terms_of(text: str) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of all words and, in scripts without blanks, pairs of characters. Terms are in lower case."""
    for m in WORD.finditer(text):
        word, at = m.group(), m.start()
        if not UNSPACED.search(word):
            if len(word) >= SHORTEST:
                yield word.lower(), at, m.end()
            continue
        for part in PARTS.finditer(word):
            start, end = at + part.start(), at + part.end()
            if UNSPACED.match(part.group()):
                for i in range(start, end - 1):
                    yield text[i : i + 2].lower(), i, i + 2
            elif end - start >= SHORTEST:
                yield part.group().lower(), start, end


def free_terms(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """The terms that do not touch a span."""
    taken = sorted((s, e) for _, s, e in spans)
    starts = [s for s, _ in taken]
    furthest = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
    for term, start, end in terms_of(text):
        i = bisect_left(starts, end)
        if i == 0 or furthest[i - 1] <= start:
            yield term, start, end


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Key, a hash of the text, and the text: rows that agree in both have the same spans."""
    body = whole(text)
    return docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("hash"), body.alias("text"))


def mentions(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of every row `key`, `hash`, `spans` (kind, start, end) and the distinct `entities`."""
    kind = docs.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, named = [], []
            for t in b.column(2):
                text = t.as_py()
                found = base_spans(text)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                named.append(sorted({x for k, s, e in found for x in entities(k, text[s:e])}))
            columns = [b.column(0), b.column(1), pa.array(spans, span), pa.array(named, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "hash", "spans", "entities"])

    schema = f"key {kind}, hash bigint, spans array<struct<kind: string, start: int, end: int>>, entities array<string>"
    return _rows(docs, text, key).mapInArrow(find, schema)


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bytes of the bitmap over the hashes of the distinct `term`s, at most FILTER_BITS / 8 of them."""
    place = F.xxhash64("term").bitwiseAND(FILTER_BITS - 1)
    blocks = terms.select((place / BLOCK_BITS).cast("int").alias("block"), (place % BLOCK_BITS).alias("bit")).distinct()
    rows = blocks.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        at = r["block"] * BLOCK_BITS // 8
        out[at : at + BLOCK_BITS // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


class _Hits:
    """Which strings a bitmap of `term_filter` may hold; answers are remembered."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.seen = bits, {}

    def __call__(self, term: str) -> bool:
        import xxhash

        found = self.seen.get(term)
        if found is None:
            if len(self.seen) > 1_000_000:
                self.seen.clear()
            place = xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), 42) & (FILTER_BITS - 1)
            found = self.seen[term] = bool(self.bits[place >> 3] >> (place & 7) & 1)
        return found


def _words(text: str) -> set[str]:
    """The distinct terms of a text."""
    if UNSPACED.search(text):
        return {t for t, _, _ in terms_of(text)}
    return {w.lower() for w in set(WORD.findall(text)) if len(w) >= SHORTEST}


def _counted(found: Counter, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if len(names) > 2 else [list(found)]
    columns = columns or [[] for _ in names[:-1]]
    arrays = [pa.array(c, pa.string()) for c in columns]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(list(found.values()), pa.int64())], names=names)


def document_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """In how many texts each `term` occurs: (term, df). Terms that only share a bit come along."""
    shared = texts.sparkSession.sparkContext.broadcast(term_filter(terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, found = _Hits(shared.value), Counter()
        for b in batches:
            for t in b.column(0):
                found.update(filter(hits, _words(t.as_py())))
            if len(found) > HELD:
                yield _counted(found, ["term", "n"])
                found.clear()
        yield _counted(found, ["term", "n"])

    return texts.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("df"))


def co_occurrences(texts: DataFrame, protected: DataFrame) -> DataFrame:
    """In how many texts each `entity` and term occur together: (entity, term, n). Entities that only share a bit come along.

    Rows of the entity "" have the number of texts in which the term occurs with any of them.
    """
    shared = texts.sparkSession.sparkContext.broadcast(term_filter(protected.select(F.col("entity").alias("term"))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, found = _Hits(shared.value), Counter()
        for b in batches:
            for t in b.column(0):
                text = t.as_py()
                spans = base_spans(text)
                here = {x for k, s, e in spans for x in entities(k, text[s:e]) if hits(x)}
                if here:
                    words = {w for w, _, _ in free_terms(text, spans)}
                    for x in ("", *here):
                        found.update((x, w) for w in words)
                        if len(found) > HELD:
                            yield _counted(found, ["entity", "term", "n"])
                            found.clear()
        yield _counted(found, ["entity", "term", "n"])

    pairs = texts.select("text").mapInArrow(count, "entity string, term string, n bigint")
    return pairs.groupBy("entity", "term").agg(F.sum("n").alias("n"))


def disclosing(rows: DataFrame, found: DataFrame, support: int = SUPPORT, share: float = GENERALISE) -> DataFrame:
    """Terms that disclose an entity: `term`, `share` (the highest P(e | t)), `bits`.

    `rows` are (key, hash, text), `found` the written result of `mentions`.
    """
    total = found.count()
    named = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("texts"))
    known = (F.col("texts") >= support) & (F.log2(F.lit(float(max(1, total))) / F.col("texts")) >= BITS_OF_INFORMATION)
    protected = settle(named.where(known))
    pairs = settle(co_occurrences(rows, protected).where(F.col("n") >= support))
    # a term is in no fewer texts than those in which it is with any entity: most terms cannot reach the share
    seen = pairs.where(F.col("entity") == "").select("term", F.col("n").alias("least"))
    pairs = pairs.join(seen, "term").where(F.col("n") / F.col("least") >= share).drop("least")
    pairs = settle(pairs.join(protected, "entity"))
    with_counts = pairs.join(settle(document_counts(rows, pairs.select("term").distinct())), "term")
    p = F.col("n") / F.col("df")
    bits = F.log2(p * F.lit(float(max(1, total))) / F.col("texts"))
    strong = with_counts.select("term", p.alias("p"), bits.alias("bits"))
    strong = strong.where((F.col("p") >= share) & (F.col("bits") >= BITS_OF_INFORMATION))
    return strong.groupBy("term").agg(F.max("p").alias("share"), F.max("bits").alias("bits"))


def occurrences(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Where the `term`s stand outside personal data: (key, hash, spans) with spans (kind, start, end, share)."""
    shared = rows.sparkSession.sparkContext.broadcast(term_filter(terms))
    kind = rows.schema["key"].dataType.simpleString()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _Hits(shared.value)
        for b in batches:
            out = []
            for i, t in enumerate(b.column(2)):
                text = t.as_py()
                if any(map(hits, _words(text))):
                    out += [(i, term, s, e) for term, s, e in free_terms(text, base_spans(text)) if hits(term)]
            if out:
                row, term, start, end = zip(*out, strict=True)
                row = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(row),
                        b.column(1).take(row),
                        pa.array(term, pa.string()),
                        pa.array(start, pa.int32()),
                        pa.array(end, pa.int32()),
                    ],
                    names=["key", "hash", "term", "start", "end"],
                )

    at = rows.mapInArrow(locate, f"key {kind}, hash bigint, term string, start int, end int")
    exact = at.join(terms.select("term", "share"), "term")
    span = F.struct(F.lit("term").alias("kind"), "start", "end", "share")
    return exact.groupBy("key", "hash").agg(F.array_sort(F.collect_set(span)).alias("terms"))


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of every row the key, `hash` of its text, `spans` of personal data and `terms` that disclose it.

    Spans are (kind, start, end) in code points, by kind and start; terms are of kind "term" and have the `share` of
    their strongest entity. Null texts are empty. Rows that agree in key and text have the same spans, each its own row.
    """
    rows = _rows(docs, text, key)
    found = settle(mentions(docs, text, key))
    terms = settle(disclosing(rows, found))
    extra = settle(occurrences(rows, terms)).select(F.col("key").alias("_k"), F.col("hash").alias("_h"), "terms")
    joined = found.join(extra, F.col("key").eqNullSafe(F.col("_k")) & (F.col("hash") == F.col("_h")), "left")
    empty = F.array().cast("array<struct<kind: string, start: int, end: int, share: double>>")
    return joined.select(F.col("key").alias(key), "hash", "spans", F.coalesce("terms", empty).alias("terms"))


def spelled(spans: str) -> Column:
    """The spans as kind:start:end, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def sanitised(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows with personal data and disclosing terms replaced in their text.

    Personal data becomes its kind in brackets. A term becomes [TERM], or goes if its share is at least `REMOVE`. Where
    spans of several kinds overlap, the stretch they cover is replaced by the first one's kind. `found` is of `find`.
    """
    span = "struct<kind: string, start: int, end: int>"
    gone = F.filter("terms", lambda t: t["share"] >= REMOVE)
    kept = F.filter("terms", lambda t: t["share"] < REMOVE)
    marks = F.concat(
        "spans",
        F.transform(kept, lambda t: F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["end"].alias("end"))),
        F.transform(gone, lambda t: F.struct(F.lit("").alias("kind"), t["start"].alias("start"), t["end"].alias("end"))),
    ).cast(f"array<{span}>")
    marks = found.select(F.col(key).alias("_k"), F.col("hash").alias("_h"), marks.alias("marks")).where(F.size("marks") > 0)
    marks = marks.dropDuplicates(["_k", "_h"])
    rows = docs.select(F.struct("*").alias("row"))
    old = F.coalesce(F.col("row").getField(text), F.lit(""))
    same = F.col("row").getField(key).eqNullSafe(F.col("_k")) & (F.xxhash64(old) == F.col("_h"))

    @F.pandas_udf("string")
    def replace(texts, marks):
        out = []
        for t, spans in zip(texts, marks, strict=True):
            if spans is None:
                out.append(t)
                continue
            parts, at = [], 0
            for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= at:
                    parts += [t[at : s["start"]], f"[{s['kind'].upper()}]" if s["kind"] else ""]
                at = max(at, s["end"])
            out.append("".join(parts) + t[at:])
        return type(texts)(out)

    joined = rows.join(marks, same, "left")
    return joined.select(*replacing("row", docs.columns, **{text: replace(old, F.col("marks"))}))
