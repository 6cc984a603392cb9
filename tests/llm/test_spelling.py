"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidespan.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = "abcdefghijklmnopqrstuvwxyzßéÿ×"


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return len(b) - len(a) < 2 and a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def slow_vocabulary(rows, least_length=6, least_count=5, noise=199):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def slow_variants(words, near=None):
    near = near or {w: [x for x in words if one_apart(w, x)] for w in words}
    forms = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out)


def near_by_deletion(words):
    """All near pairs of a larger vocabulary: words that agree when a place is left out or ignored."""
    holes, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            holes.setdefault(w[:i] + "\0" + w[i + 1 :], []).append(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    return near


def rows_of(out):
    return sorted(tuple(r) for r in out.select("word", "form", "root", "n", "n_near", "form_n").collect())


def variant(word):
    at, c = random.randrange(len(word) + 1), random.choice(LETTERS)
    return random.choice([word[:at] + c + word[at:], word[:at] + word[at + 1 :], word[:at] + c + word[at + 1 :]])


def test_index_finds_all_words_one_error_apart():
    random.seed(4)
    for _ in range(60):
        letters = "ab" if random.random() < 0.5 else "abcé"
        words = sorted({"".join(random.choices(letters, k=random.randint(1, 9))) for _ in range(random.randint(0, 50))})
        index, patterns = spelling.Bidirectional(words), [*words, "abab", "xé"]
        got = set()
        for side in (True, False):
            got.update(zip(*(x.tolist() for x in index.near(patterns, side)), strict=True))
        assert got == {(i, j) for i, p in enumerate(patterns) for j, w in enumerate(words) if one_apart(p, w)}


@pytest.mark.parametrize("group_chars", [spelling.GROUP_CHARS, 40])
def test_variants_of_random_words(spark, group_chars, monkeypatch):
    """Small groups are split into parts that meet pairwise."""
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (group_chars,))
    random.seed(5)
    words = {"prefix" + "".join(random.choices("ab", k=random.randint(0, 4))): random.choice([5, 5, 30, 200]) for _ in range(60)}
    for w in [*words, "straße", "longword" * 400]:
        for _ in range(3):
            words.setdefault(variant(w), random.choice([1, 6, 40, 1000]))
    words |= {"a": 3, "b": 3, "ab": 90, "longword" * 400: 7}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(spelling.variants(frame)) == slow_variants(words)


def test_texts(spark):
    text = "Straße straße STRASSE Strase, naïve naive Naïve-naive ÀÉÎÕÜ colour color colours"
    rows = [(i, text, "x") for i in range(300)] + [(7, text, "x")] * 3
    rows += [(None, "colour " * 9, "x"), (8, None, "x"), (9, "", None), (10, "colorr " * 5 + "x" * 50_000 + " " + "kolour " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string").withColumnRenamed("n", "word")
    words = slow_vocabulary([r[:2] for r in rows])
    assert any(w in words for w in ("colou", "colur")) or len(words) > 5
    assert rows_of(spelling.group_variants(docs)) == slow_variants(words)
    assert rows_of(spelling.group_variants(docs, noise=0, least_length=3, least_count=1)) == slow_variants(
        slow_vocabulary([r[:2] for r in rows], 3, 1, 0)
    )


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert rows_of(spelling.group_variants(none)) == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    words = slow_vocabulary([tuple(r) for r in docs])
    assert rows_of(queries.QUERIES["op11_spelling_variants"](spark, sf)) == slow_variants(words, near_by_deletion(words))
