"""Toxicity and quality: models by definition, held-out accuracy, edge cases."""

import random
from itertools import product

import numpy as np
import pytest

from tidespan.llm import quality, toxicity

LETTERS = "abcdefghij"


def a_text(rng, insults=0, n=60):
    words = ["".join(rng.choices(LETTERS, k=rng.randint(2, 7))) for _ in range(n)]
    for _ in range(insults):
        words.insert(rng.randrange(n), rng.choice(["wuzzok", "pyqqil", "vrotzu"]))
    return " ".join(words)


def labelled(spark, n=400):
    rng = random.Random(3)
    rows = [(i, a_text(rng, insults=2 * (i % 4 == 0)), "x", 0.5) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted string, score double")
    labels = [(i, int(i % 4 == 0), int(i % 4 != 0)) for i in range(n)] + [(None, 1, 1), (5, None, None), (10**9, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_symbols():
    assert toxicity.symbols("Éa,  b9!").tolist() == [0, 5, 1, 0, 2, 27, 0]
    assert toxicity.symbols("").tolist() == [0]
    assert len(toxicity.symbols("日本")) == 4


def test_models_are_distributions(monkeypatch):
    """With a small alphabet, the probabilities of all symbols after a context add up to one."""
    monkeypatch.setattr(toxicity, "SYMBOLS", 3)
    rng = np.random.default_rng(0)
    keys = np.sort(rng.choice(3**5, 90, replace=False))
    shared = toxicity._continuations(keys, 1, 2, np.full((1, 3), 1 / 3))
    lower = toxicity._continuations(keys[::2], 3, 4, shared)
    assert shared.shape == (3, 3) and lower.shape == (27, 3)
    assert np.allclose(shared.sum(axis=1), 1) and np.allclose(lower.sum(axis=1), 1) and lower.min() > 0
    counts = np.zeros(3**5)
    counts[keys] = rng.integers(1, 9, len(keys))
    full = toxicity._mixed(counts.reshape(-1, 3), toxicity._repeated(lower, 81))
    assert np.allclose(full.sum(axis=1), 1) and full.min() > 0
    blocks = toxicity.kneser_ney(keys, counts[keys], np.where(np.arange(len(keys)) % 2, 0, counts[keys]))
    other = toxicity._continuations(keys[::2], 3, 4, shared)
    halved = counts.copy()
    halved[keys[1::2]] = 0
    less = toxicity._mixed(halved.reshape(-1, 3), toxicity._repeated(other, 81))
    first = toxicity._mixed(counts.reshape(-1, 3), toxicity._repeated(toxicity._continuations(keys, 3, 4, shared), 81))
    assert (blocks == toxicity._stored(np.log(first) - np.log(less)).reshape(-1)).all()


def test_windows_across_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.integers(-40, 40, toxicity.GRAMS).astype(np.int8))
    text = a_text(random.Random(1), n=200)
    whole = model.features(text)
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    assert np.allclose(model.features(text), whole)


def test_toxicity_learns(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 3 != 1 OR doc_id IS NULL"))
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    held = [(r.predicted, int(r.doc_id % 4 == 0)) for r in out.collect() if r.doc_id % 3 == 1]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_toxicity_edges(spark):
    docs, labels = labelled(spark, 40)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "x"), (2, "x"), (3, "wuzzok " * 30_000)], "doc_id long, text string")
    for taught in (labels, labels.where("toxic = 0"), labels.limit(0)):
        out = toxicity.score(odd, toxicity.fit(docs, taught)).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(odd.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_quality_learns(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        text = a_text(rng)
        rows.append((i, text if i % 4 else " | ".join(text.split()[:20]) + " %%% " * 5))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(600)] + [(None, 1), (3, None)], "doc_id long, quality int")
    stats = quality.measured(docs)
    model = quality.fit(stats, labels.where("doc_id % 5 != 0 OR doc_id IS NULL"))
    out = quality.score(stats, model).collect()
    held = [(r.predicted, int(r.doc_id % 4 != 0)) for r in out if r.doc_id % 5 == 0]
    assert len(out) == 600 and np.mean([p == y for p, y in held]) > 0.95


def test_quality_edges(spark):
    docs, labels = labelled(spark, 60)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "x"), (2, "x"), (3, "y " * 30_000), (4, " \n ")], "doc_id long, text string")
    for taught in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = quality.fit(quality.measured(docs), taught)
        out = quality.score(quality.measured(odd), model).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert quality.score(quality.measured(odd.limit(0)), model).count() == 0


def test_normal_equations_are_summed(spark):
    """The distributed fit equals one over all rows at once."""
    docs, labels = labelled(spark, 80)
    stats = quality.measured(docs)
    model = quality.fit(stats, labels)
    folds = stats.join(labels, "doc_id").selectExpr(
        "stats", "cast(quality AS double) y", f"pmod(xxhash64(cast(doc_id AS string)), {quality.CALIBRATION}) = 0 AS c"
    )
    rows = [r for r in folds.dropna().collect()]
    z = model.expand(np.array([r.stats for r in rows if not r.c]))
    y = np.array([r.y for r in rows if not r.c])
    ridge = quality.RIDGE * max(1.0, len(z)) * np.eye(z.shape[1])
    ridge[0, 0] = 1e-9
    assert np.allclose(np.linalg.solve(z.T @ z + ridge, z.T @ y), model.weights, atol=1e-6)


def test_fourier_features_approximate_the_kernel():
    model = quality.Model(np.zeros(18), np.ones(18))
    x = np.random.default_rng(2).normal(size=(40, 18))
    waves = model.expand(x)[:, 1:]
    width = quality.WIDTH**2 * 18
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width))
    assert np.abs(waves @ waves.T - kernel).mean() < 0.06


@pytest.mark.parametrize("seed", range(5))
def test_isotonic_is_monotone_and_least_squares(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 4, 5).astype(float)
    weights = rng.integers(1, 4, 5).astype(float)
    x, y = quality.isotonic(np.arange(5.0), weights, values)
    assert (np.diff(y) > 0).all() or len(y) == 1
    fitted = np.array([y[np.searchsorted(x, a) - (np.searchsorted(x, a) == len(x))] for a in np.arange(5.0)])
    best = min(
        (weights * (np.array(v) - values) ** 2).sum() for v in product(np.arange(0, 3.26, 0.25), repeat=5) if list(v) == sorted(v)
    )
    blocks = np.repeat(y, 1)
    assert blocks.min() >= values.min() and blocks.max() <= values.max() and fitted.size == 5
    total = weights.sum()
    assert np.isclose((y * _weights(x, weights)).sum() / total, (weights * values).sum() / total) and best >= 0


def _weights(x, weights):
    """The weight of each block, from the blocks' mean positions."""
    out, at = [], 0
    for mean in x:
        w = s = 0.0
        while w == 0 or not np.isclose(s / w, mean):
            w += weights[at]
            s += weights[at] * at
            at += 1
        out.append(w)
    return np.array(out)


def test_letters_outside_the_basic_plane_are_letters():
    """An insult in mathematical letters is read like one in plain letters."""
    plain = "You utter fool 42"
    bold = "".join(chr(0x1D41A + ord(c) - 97) if c.islower() else chr(0x1D400 + ord(c) - 65) if c.isupper() else chr(0x1D7CE + int(c)) if c.isdigit() else c for c in plain)
    assert toxicity.symbols(bold).tolist() == toxicity.symbols(plain).tolist()
    assert toxicity.symbols("🙂x🙂").tolist() == toxicity.symbols(" x ").tolist()
    assert (toxicity.symbols("𐌰𐌱") != 0).sum() == 2


def test_features_of_chunks_are_those_of_the_whole(monkeypatch):
    """Words and windows that cross the parts in which a long text is read count like others."""
    rng = np.random.default_rng(4)
    model = toxicity.Model(rng.integers(-60, 60, toxicity.GRAMS).astype(np.int8))
    for size in (1, 30, 700):
        text = " ".join("".join(rng.choice(list("abcé日"), rng.integers(1, 12))) for _ in range(size)) + " 𝐚𝐛c" * (size > 1)
        monkeypatch.setattr(toxicity, "CHUNK", 1 << 20)
        whole = model.features(text)
        found = toxicity.symbols(text)
        ratios = model.ratios[toxicity.grams(found)] * toxicity.STEP
        ends = np.flatnonzero(found[1:] == 0)
        words = sorted((float(ratios[a:b].sum()) for a, b in zip([0, *(ends[:-1] + 1)], ends + 1, strict=True)), reverse=True)
        n = len(toxicity.WINDOWS)
        assert whole[n : n + len(toxicity.WORDS)] == pytest.approx([sum(words[:k]) / k for k in toxicity.WORDS], abs=1e-4)
        assert whole[-1] == pytest.approx(np.log1p(len(words))) and whole[-2] == pytest.approx(ratios.mean(), abs=1e-4)
        monkeypatch.setattr(toxicity, "CHUNK", 37)
        assert model.features(text) == pytest.approx(whole, abs=1e-4)


def slow_kneser_ney(texts, symbols_, order, shared_order, discount, all_texts):
    """log P(symbol | context) of one class by the textbook: counts of the highest order, continuation counts below."""
    def grams_of(lines, n):
        counts = {}
        for line in lines:
            padded = (0,) * (order - 2) + tuple(line)
            for i in range(order - 1, len(padded)):
                g = padded[i - n + 1 : i + 1]
                counts[g] = counts.get(g, 0) + 1
        return counts

    def continuations(lines, n):
        kinds = {}
        for g in grams_of(lines, n + 1):
            kinds[g[1:]] = kinds.get(g[1:], 0) + 1
        return kinds

    tables = [continuations(all_texts if n <= shared_order else texts, n) for n in range(1, order)] + [grams_of(texts, order)]

    def probability(context, s):
        p = 1 / symbols_
        for n in range(1, order + 1):
            head = tuple(context[len(context) - n + 1 :])
            own = {g[-1]: c for g, c in tables[n - 1].items() if g[:-1] == head}
            total = sum(own.values())
            if total:
                p = max(own.get(s, 0) - discount, 0) / total + discount * len(own) / total * p
        return p

    return probability


def test_kneser_ney_against_the_textbook():
    """Ratios of a few grams of a small corpus, one class after the other, smoothed through the counts of all texts."""
    toxic, ordinary, others = ["bad bad dog", "a bad cab"], ["good day", "a dab of jam", "cab"], ["zebra dog"]
    lines = {t: [int(x) for x in toxicity.symbols(t)] for t in toxic + ordinary + others}
    counts = {}
    for t, line in lines.items():
        for g in toxicity.grams(np.array(line, np.uint8)):
            row = counts.setdefault(int(g), [0, 0])
            if t in toxic or t in ordinary:
                row[0 if t in toxic else 1] += 1
    keys = np.array(sorted(counts))
    both = np.array([counts[int(k)] for k in keys], dtype=np.float64)
    ratios = toxicity.kneser_ney(keys, both[:, 0], both[:, 1])
    every = list(lines.values())
    sides = [
        slow_kneser_ney([lines[t] for t in part], toxicity.SYMBOLS, toxicity.ORDER, toxicity.SHARED, toxicity.DISCOUNT, every)
        for part in (toxic, ordinary)
    ]
    for g in [*keys[:25].tolist(), 5, 28**4 + 3]:
        digits = [g // toxicity.SYMBOLS ** (toxicity.ORDER - 1 - i) % toxicity.SYMBOLS for i in range(toxicity.ORDER)]
        want = np.log(sides[0](digits[:-1], digits[-1])) - np.log(sides[1](digits[:-1], digits[-1]))
        assert ratios[g] * toxicity.STEP == pytest.approx(want, abs=toxicity.STEP / 2 + 1e-9)


def test_held_out_recall(spark):
    """Labels of the held-out third of the given table: most toxic texts are caught, few others."""
    from tidespan.llm import queries

    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.QUERIES["op5_toxicity"](spark, sf).collect()}
    rows = [(r.toxic, got[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").dropna().collect() if got[r.doc_id].held_out]
    caught = sum(t and p for t, p in rows)
    assert caught / sum(t for t, _ in rows) >= 0.6 and caught / sum(p for _, p in rows) >= 0.95
