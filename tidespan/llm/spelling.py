"""Spelling variants by search schemes over bidirectional FM-indexes.

Words that occur often enough are the vocabulary. Two words are near if one inserted, deleted or replaced character leads
from one to the other. The error then lies in one half of a word, and the other half is whole: a search matches either
half exactly and extends across the other one, allowing one error.

Vocabulary is filed by (side, half, length of the word that looks for it), three lengths a side, so a word and all words
near it meet in a file. Files are dealt into groups of a bounded number of characters, and the words of a larger group
into parts that are met pairwise. A group's words stand between delimiters in one text, whose FM-index and that of the
reversed text together extend a match to the left or right: a match is an interval of suffix ranks in either index, and
both move in step. All searches of a group advance together, one character at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import settle

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form is at least so many times as frequent.
FORM_TIMES = 5
#: One run in so many loses a character; 0: none does.
NOISE = 199
#: Characters of the words that one index holds, about.
GROUP_CHARS = 1 << 16
#: Distinct words that a task counts before it passes them on.
HELD = 1 << 18
#: Characters of the searches that advance together, about.
SEARCH_CHARS = 1 << 15

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
END, MARK = 0, 1  # the end of a text, and the delimiter before and after each of its words


def runs_of(key, text: str, least: int, noise: int) -> Counter:
    """How often each word of at least `least` characters occurs in a text, after noise."""
    found = Counter(r for r in RUN.findall(text) if len(r) >= least)
    lowered: Counter = Counter()
    for run, n in found.items():
        lowered[run.translate(LOWER)] += n
    if not noise:
        return lowered
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), start)
        if h % noise == 0:
            run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def vocabulary(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, noise: int = NOISE,
) -> DataFrame:
    """(word, n): words of all texts with at least so many characters and occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for word, n in runs_of(k, t.as_py(), least_length, noise).items():
                    held[word] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    words = docs.select(F.col(key), F.coalesce(text, F.lit(""))).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Ranks of the text's suffixes by doubling; the text ends with its only END."""
    rank, step = text.astype(np.int64), 1
    while True:
        ahead = np.full(len(text), -1, np.int64)
        ahead[:-step] = rank[step:]
        key = rank * (max(int(rank.max()), len(text)) + 2) + ahead + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(len(text), np.int64)
        rank[order] = fresh
        if fresh[-1] == len(text) - 1:
            return order
        step *= 2


class _Index:
    """The FM-index of one direction.

    `below[i, c]` is the number of characters under `c` among the first `i` of the transformed text.
    """

    def __init__(self, text: np.ndarray, letters: int) -> None:
        self.suffixes = _suffix_order(text)
        last = text[self.suffixes - 1]
        self.below = np.zeros((len(text) + 1, letters + 1), np.int32)
        self.below[np.arange(1, len(text) + 1), last + 1] = 1
        np.cumsum(self.below, axis=0, out=self.below)
        np.cumsum(self.below, axis=1, out=self.below)
        self.first = self.below[-1].astype(np.int64)  # suffixes that begin with a smaller character

    def step(self, lo: np.ndarray, size: np.ndarray, c: np.ndarray):
        """Put `c` before the matches: their interval here, and by how far it moves in the other index."""
        low, high = self.below[lo, c], self.below[lo + size, c]
        before, upto = self.below[lo, c + 1] - low, self.below[lo + size, c + 1] - high
        return self.first[c] + before, (upto - before).astype(np.int64), (high - low).astype(np.int64)


class Bidirectional:
    """Words between delimiters, searched from any place to either side.

    A state of searches is arrays (left, right, size): where the interval of matches begins among the suffixes of the
    text and among those of the reversed text, and how many there are.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.codes = {c: i + 2 for i, c in enumerate(sorted(set("".join(words))))}
        self.letters = len(self.codes) + 2
        line = np.concatenate([np.append(self.spell(w), MARK) for w in words]) if words else np.zeros(0, np.int64)
        line = np.concatenate(([MARK], line)).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        self.size = len(line) + 1
        self.forward = _Index(np.append(line, END), self.letters)
        self.backward = _Index(np.append(line[::-1], END), self.letters)

    def spell(self, word: str) -> np.ndarray:
        """Codes of the characters, -1 where no word has the character."""
        return np.array([self.codes.get(c, -1) for c in word], np.int64)

    def extend(self, state, c: np.ndarray, to_left: bool):
        """The matches with `c` before or after them."""
        left, right, size = state
        known = c >= 0
        c = np.where(known, c, 0)
        if to_left:
            left, inside, moved = self.forward.step(left, size, c)
            right = right + moved
        else:
            right, inside, moved = self.backward.step(right, size, c)
            left = left + moved
        return left, right, np.where(known, inside, 0)

    def word_at(self, left: np.ndarray) -> np.ndarray:
        """The numbers of the words whose delimiter begins the suffixes of these ranks."""
        return np.searchsorted(self.begins, self.forward.suffixes[left])

    def near(self, patterns: list[str], exact_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word): numbers of the words with one error in the half that is not matched exactly."""
        order = np.argsort(np.fromiter(map(len, patterns), np.int64, len(patterns)), kind="stable")
        which, words, batch = [order[:0]], [order[:0]], []
        for k, i in enumerate(order):
            batch.append(i)
            if k + 1 == len(order) or (len(batch) + 1) * len(patterns[order[k + 1]]) > SEARCH_CHARS:
                found, word = self._search([patterns[j] for j in batch], exact_left)
                which.append(np.array(batch)[found])
                words.append(word)
                batch = []
        return np.concatenate(which), np.concatenate(words)

    def _search(self, patterns: list[str], exact_left: bool) -> tuple[np.ndarray, np.ndarray]:
        # the exact half is read from the middle outwards up to its delimiter, the other half likewise
        spelled = [self.spell(p) for p in patterns]
        halves = [(s[: len(s) // 2][::-1], s[len(s) // 2 :]) for s in spelled]
        exact = [np.append(h[0 if exact_left else 1], MARK) for h in halves]
        other = [h[1 if exact_left else 0] for h in halves]
        who = np.arange(len(patterns))
        zero = np.zeros(len(patterns), np.int64)
        state = (zero, zero, np.full(len(patterns), self.size, np.int64))
        lengths = np.fromiter(map(len, exact), np.int64, len(exact))
        padded = _padded(exact)
        for j in range(padded.shape[1]):
            going = j < lengths[who]
            moved = self.extend(tuple(x[going] for x in state), padded[who[going], j], exact_left)
            for x, y in zip(state, moved, strict=True):
                x[going] = y
            alive = state[2] > 0
            who, state = who[alive], tuple(x[alive] for x in state)
        return self._with_error(who, state, other, not exact_left)

    def _with_error(self, who, state, other, to_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """Read the other halves; `who` and `state` have no error so far, `late` and `spoilt` have had theirs."""
        lengths = np.fromiter(map(len, other), np.int64, len(other))
        padded = _padded(other)
        letters = np.arange(MARK + 1, self.letters)
        late, spoilt, ends = who[:0], tuple(x[:0] for x in state), []
        for j in range(padded.shape[1] + 1):
            more = lengths[who] > j
            c = np.full(len(who), -1)
            c[more] = padded[who[more], j] if j < padded.shape[1] else -1
            each, every = np.repeat(np.arange(len(who)), len(letters)), np.tile(letters, len(who))
            differs = every != c[each]  # one more of the same character is found behind it
            each = each[differs]
            wider = self.extend(tuple(x[each] for x in state), every[differs], to_left)
            alive = wider[2] > 0
            each, wider = each[alive], tuple(x[alive] for x in wider)
            late = np.concatenate([late, who[each]])  # an additional character
            spoilt = tuple(map(np.concatenate, zip(spoilt, wider, strict=True)))
            over = lengths[late] == j
            ends.append((late[over], *(x[over] for x in spoilt)))
            late, spoilt = late[~over], tuple(x[~over] for x in spoilt)
            read = padded[late, j] if len(late) else late
            spoilt = self.extend(spoilt, read, to_left)
            other_one = more[each]  # another character
            late = np.concatenate([late, who[each][other_one], who[more]])  # or a missing one
            spoilt = tuple(
                np.concatenate([x, y[other_one], z[more]]) for x, y, z in zip(spoilt, wider, state, strict=True)
            )
            alive = spoilt[2] > 0
            late, spoilt = late[alive], tuple(x[alive] for x in spoilt)
            who, state = who[more], self.extend(tuple(x[more] for x in state), c[more], to_left)
            alive = state[2] > 0
            who, state = who[alive], tuple(x[alive] for x in state)
        late, *spoilt = (np.concatenate(x) for x in zip(*ends, strict=True))
        left, _, size = self.extend(tuple(spoilt), np.full(len(late), MARK), to_left)
        hit = size > 0
        pairs = np.unique(np.stack([late[hit], self.word_at(left[hit])]), axis=1)
        return pairs[0], pairs[1]


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows), default=0)), -1, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _filed(words: DataFrame, reach: int, groups: int) -> DataFrame:
    """(exact_left, group, word, n): each word under its halves, as seen by words of up to `reach` characters more or less."""
    places = []
    for d in range(-reach, reach + 1):
        size = F.length("word") + d
        left = F.substring("word", F.lit(1), F.floor(size / 2).cast("int"))
        right = F.substring("word", F.length("word") - F.ceil(size / 2).cast("int") + 1, F.ceil(size / 2).cast("int"))
        places += [F.struct(F.lit(to).alias("to"), size.alias("size"), h.alias("half")) for to, h in ((True, left), (False, right))]
    group = F.pmod(F.xxhash64("p.size", "p.half"), F.lit(groups)).alias("group")
    filed = words.select("word", "n", F.explode(F.array(*places)).alias("p")).where("p.size > 0")
    return filed.select(F.col("p.to").alias("exact_left"), group, "word", "n").distinct()


def near_pairs(words: DataFrame, group_chars: int = GROUP_CHARS) -> DataFrame:
    """(word, near, n): all ordered pairs of words that are one error apart, with the count of `near`.

    `words` holds every (word, n) once and is read from a written table.
    """
    chars = words.agg(F.sum(F.length("word") + 1).alias("c")).first().c or 0
    groups = max(1, -(-chars * 6 // group_chars))  # three filings a side, half full on average
    place = ["exact_left", "group"]
    indexed, asked = _filed(words, 1, groups), _filed(words, 0, groups)
    sizes = indexed.groupBy(*place).agg(F.ceil(F.sum(F.length("word") + 1) / group_chars).cast("int").alias("parts"))
    split = settle(sizes.where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    mine, others = F.pmod(F.xxhash64(F.lit(1), "word"), parts).cast("int"), F.explode(F.sequence(F.lit(0), parts - 1))
    # every part of a large group's words meets every part of its searches
    indexed = indexed.join(split, place, "left").select(*place, mine.alias("part"), others.alias("asking"), "word", "n")
    asked = asked.join(split, place, "left").select(*place, others.alias("part"), mine.alias("asking"), "word")
    asked = asked.toDF(*asked.columns)  # columns of their own

    def search(key: tuple, held: pa.Table, patterns: pa.Table) -> pa.Table:
        counts = dict(zip(held["word"].to_pylist(), held["n"].to_pylist(), strict=True))
        spelled, vocabulary = patterns["word"].to_pylist(), list(counts)
        which, found = Bidirectional(vocabulary).near(spelled, key[0].as_py()) if counts and spelled else ((), ())
        near = [vocabulary[j] for j in found]
        out = [pa.array([spelled[i] for i in which], pa.string()), pa.array(near, pa.string())]
        return pa.Table.from_arrays([*out, pa.array([counts[w] for w in near], pa.int64())], names=["word", "near", "n"])

    group = [*place, "part", "asking"]
    pairs = indexed.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(search, "word string, near string, n long")
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms (word, form) of words lead in the end; chains are halved until none is left."""
    links = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        links = moved.select("word", "root")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return links


def variants(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """Of every word of (word, n): `form`, `root`, `n`, `n_near` and `form_n`.

    `n_near` counts the words that are one inserted, deleted or replaced character away. The most frequent of them, ties to
    the smallest in code-point order, is the form if it is at least `times` as frequent, else the form is null. `root` is
    where forms lead, the word itself if it has none. Words are distinct and not null; an empty table gives an empty result.
    """
    words = settle(words.select("word", "n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "near")).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= times * F.col("n")
    found = settle(found.select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    ))
    roots = _roots(found.where("form IS NOT NULL"))
    root = F.coalesce("root", "word").alias("root")
    return found.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def group_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", **limits) -> DataFrame:
    """The spelling variants of the vocabulary of all texts; limits as for `vocabulary`.

    Words are runs of letters up to U+00FF, A to Z lowered. Null and empty texts have none; repeated rows count each time;
    a null key is written as nothing where noise is drawn; other columns are not read. Texts and words of any length are whole.
    """
    return variants(vocabulary(docs, text, key, **limits))
