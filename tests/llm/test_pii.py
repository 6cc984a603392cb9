"""Personal data and disclosing terms against regular expressions and brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tidespan.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The contract's patterns, literally."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("79927398713")


def test_patterns():
    rng = random.Random(1)
    alphabets = ["ab1.2@-+_% 3()5é9", "0123456789. -", "+0123456789(). -x", "a@b.c_"]
    for i in range(20_000):
        text = "".join(rng.choices(alphabets[i % 4], k=rng.randint(0, 45)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+" + "1 " * 100_000, "@" * 100_000])
def test_long_runs_take_linear_time(text):
    assert isinstance(pii.base_spans(text), list)


def corpus():
    rows = []
    for i in range(40):
        where = "Quorvax lab near zed" if i % 4 == 0 else "the usual place with all"
        mail = "ann@quorvax.org" if i % 4 == 0 else f"p{i}@mail{i}.net"
        rows.append((i, f"Please write to {mail} at {where} today, thing{i} common words stay."))
    rows += [(100 + i, f"common words here and there {i}, the usual place with all") for i in range(60)]
    # a name of two characters in the heading, the address far below, and an entity in most texts
    rows += [(300 + i, "王明 " + "filler words " * 30 + f"mail wang@ming.cn, {i}") for i in range(4)]
    rows += [(310 + i, f"call +49 30 1234567{i % 10} everyday {i}") for i in range(30)]
    return rows + [(200, None), (201, ""), (None, rows[0][1]), (None, rows[0][1]), (0, rows[0][1]), (202, "Quorvax only")]


def terms_in(text, spans):
    """Words of three characters or more, and pairs of neighbours in Chinese, outside spans."""
    out = []
    for m in re.finditer(r"[^\W_]+", text):
        for part in re.finditer("[\u3400-\u9fff]+|[^\u3400-\u9fff]+", m.group()):
            s, e = m.start() + part.start(), m.start() + part.end()
            if "\u3400" <= text[s] <= "\u9fff":
                out += [(text[i : i + 2], i, i + 2) for i in range(s, e - 1)]
            elif e - s >= 3:
                out.append((text[s:e].lower(), s, e))
    return [t for t in out if not any(a < t[2] and t[1] < b for _, a, b in spans)]


def brute(rows):
    """Disclosing terms by definition: over whole texts, each row a text."""
    words, both, has = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t in rows:
        t = t or ""
        spans = plain(t)
        for w in {w for w, _, _ in terms_in(t, [])}:
            words[w] += 1
        here = {x for k, s, e in spans for x in pii.entities(k, t[s:e])}
        for x in here:
            has[x] += 1
        for p in {(x, w) for x in here for w, _, _ in terms_in(t, spans)}:
            both[p] += 1
    out = {}
    for (x, w), n in both.items():
        p = n / words[w]
        if n >= pii.SUPPORT and p >= pii.GENERALISE and np.log2(p * len(rows) / has[x]) >= pii.BITS_OF_INFORMATION:
            out[w] = max(out.get(w, 0), p)
    return out


BITS = 2.0


def test_terms_that_disclose(spark, monkeypatch):
    monkeypatch.setattr(pii, "BITS_OF_INFORMATION", BITS)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    found = pii.find(docs)
    got = [(r.doc_id, [tuple(s) for s in r.spans], [(s.start, s.end) for s in r.terms]) for r in found.collect()]
    terms = brute(rows)
    assert {"quorvax", "lab", "王明"} <= set(terms) and "common" not in terms
    want = []
    for i, t in rows:
        t = t or ""
        base = plain(t)
        want.append((i, base, [(a, b) for w, a, b in terms_in(t, base) if w in terms]))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    clean = {(r.doc_id, r.text) for r in pii.sanitised(docs, found).collect()}
    assert (202, " only") in clean or (202, "[TERM] only") in clean
    assert (200, "") in clean and not any("@" in t for _, t in clean)


def test_one_bit_for_all_words_changes_nothing(spark, monkeypatch):
    """A bitmap that every word hits costs time only."""
    monkeypatch.setattr(pii, "BITS_OF_INFORMATION", BITS)
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    want = sorted(map(repr, pii.find(docs).collect()))
    monkeypatch.setattr(pii, "term_filter", lambda terms: np.full(pii.FILTER_BITS // 8, 255, np.uint8))
    assert sorted(map(repr, pii.find(docs).collect())) == want


def test_terms_of_the_given_table(spark):
    """Terms and their places of a whole given table are those of the definition."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()]
    terms = brute(rows)
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    got = {(r.doc_id, s.start, s.end) for r in found for s in r.terms}
    want = {(i, a, b) for i, t in rows if t for w, a, b in terms_in(t, []) if w in terms and (w, a, b) in terms_in(t, plain(t))}
    assert got == want and len(terms) > 0


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(docs).count() == 0 and pii.sanitised(docs, pii.find(docs)).count() == 0


def test_terms_out_of_reach_are_not_counted(spark, monkeypatch):
    """Words that are with many protected entities cannot disclose one of them; whole counts are made of the others only."""
    rows = [(i, f"common words here, note{i % 8} for u{i % 8}@host{i % 8}.example") for i in range(64)]
    rows += [(100 + i, "plain filler") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []
    count = pii.document_counts
    monkeypatch.setattr(pii, "document_counts", lambda texts, terms: asked.extend(r[0] for r in terms.collect()) or count(texts, terms))
    found = pii.settle(pii.mentions(docs))
    out = pii.disclosing(pii._rows(docs, "text", "doc_id"), found).collect()
    assert sorted(asked) == [f"note{i}" for i in range(8)] == sorted(r["term"] for r in out)
    assert all(r["share"] == 1.0 for r in out)
