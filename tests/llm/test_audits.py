"""Whitening, source divergence and license scans against plain definitions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import divergence, licenses, registry, whitening
from tests.conftest import SF001
from tests.llm.brute import lower
from tests.llm.conftest import edge_texts

# ---------------------------------------------------------------- whitening


def _matrices():
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 40, 70):
        a = r.standard_normal((2 * n + 1, n))
        yield a.T @ a
    yield np.eye(12)
    yield np.diag([3.0, 3, 3, 1, 1, 0])
    yield np.kron(np.eye(4), np.ones((3, 3)))  # many equal values, many zeros off the diagonal
    yield np.ones((9, 9))
    yield np.diag([1e300, 1e298, 1e290])
    glued = np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield glued  # pairs of values that agree to nearly all digits


def test_leading_components_equal_a_library_solver():
    for m in _matrices():
        values, rows = whitening.leading_components(m, 32)
        scale = np.abs(m).max()
        want = np.linalg.eigvalsh(m / scale)[::-1][:32] * scale
        assert np.allclose(values / scale, want / scale, atol=1e-13 * len(m))
        assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-12
        assert np.abs((m / scale) @ rows.T - rows.T * (values / scale)).max() < 1e-12 * len(m)


def test_sturm_counts_are_numbers_of_smaller_eigenvalues():
    r = np.random.default_rng(8)
    d, e = r.standard_normal(30), r.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    shifts = np.concatenate((values - 1e-9, values + 1e-9, [-100, 100]))
    assert whitening.sturm_count(d, e, shifts).tolist() == [int((values < s).sum()) for s in shifts]


def _plain_whitening(vectors: dict[int, list[float]], most: int = 32):
    x = {k: [math.floor(64 * c) + 1_000_000 for c in v] for k, v in vectors.items()}
    n, d = len(x), len(next(iter(x.values())))
    s = [sum(v[i] for v in x.values()) for i in range(d)]
    z = np.array([[(n * c - t) / n for c, t in zip(v, s, strict=True)] for v in x.values()])
    values, rows = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:most]
    deviation = {k: sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for k, v in x.items()}
    white = dict(zip(x, z @ rows[:, order] / np.sqrt(values[order]), strict=True))
    return n, deviation, white, values[order] / values.sum()


def test_whitening_of_the_table_equals_the_definition(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    n, deviation, white, share = _plain_whitening({r["vec_id"]: [float(c) for c in r["embedding"]] for r in rows})
    out = registry.op11_whitening(spark, SF001).collect()
    assert dict(registry.op11_whitening(spark, SF001).dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert len(out) == n * 32 and {r["n"] for r in out} == {n}
    assert all(r["deviation"] == deviation[r["vec_id"]] for r in out)
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9
    got = np.zeros((n, 32))
    place = {k: i for i, k in enumerate(white)}
    for r in out:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9
    want = np.array(list(white.values()))
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-6


def test_whitening_of_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 1.0, -0.5]), (3, [3.0, 1.0, 2.25]), (3, [3.0, 1.0, 2.25]), (None, [-4.0, 0.25, 1.0]), (4, None), (5, []), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]),
            (8, [1.0, -inf, 0.0]), (9, [1.0, 2.0]), (10, [1e30, 0.0, 1.0])]
    df = spark.createDataFrame([(*r, "c!", 7) for r in rows], "vec_id bigint, embedding array<double>, component string, n int").repartition(4)
    out = whitening.whiten(df).collect()
    assert sorted(Counter(r["vec_id"] for r in out if r["component"] == 1).items(), key=str) == sorted({1: 1, 2: 1, 3: 2, None: 1}.items(), key=str)
    n, deviation, _, share = _plain_whitening(dict(enumerate(v for _, v in rows[:5])))
    assert {r["n"] for r in out} == {5} and len(out) == 5 * 3
    assert sorted(r["deviation"] for r in out if r["component"] == 2) == sorted(deviation.values())
    assert np.allclose(sorted({r["explained"] for r in out}), sorted(share)) and out[0]["identity_error"] < 1e-9
    # components follow the rank, constant vectors have none, equal numbers of two lengths go to the longer one
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(6)], "vec_id bigint, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}
    assert whitening.whiten(flat.withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0)))).count() == 0
    none = whitening.whiten(flat.limit(0))
    assert none.count() == 0 and none.columns == whitening.whiten(flat).columns
    two = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 5.0]), (3, [1.0]), (4, [2.0])], "vec_id bigint, embedding array<double>")
    assert {r["vec_id"] for r in whitening.whiten(two).collect()} == {1, 2}


def test_whitening_of_large_numbers_is_exact(spark):
    """Entries near 2^50 and a spread over many batches keep exact deviations."""
    r = random.Random(4)
    vectors = {i: [r.choice((1.0, -1.0)) * 2.0**50 + 64.0 * i, float(i % 7), 0.25 * (i % 3)] for i in range(40)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(5)
    _, deviation, _, _ = _plain_whitening(vectors)
    assert {x["vec_id"]: int(x["deviation"]) for x in whitening.whiten(df).collect() if x["component"] == 1} == deviation


# ---------------------------------------------------------------- divergence


def _plain_audit(rows, min_docs=3, top=200):
    terms = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms.findall(lower(text or ""))
        groups.add((lang, source))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])

        def p_of(c, v=v, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        q = p_of(whole)
        own = {s: p_of(counts[lang, s]) for la, s in groups if la == lang}
        for s, p in own.items():
            pair = sorted((-sum((p[t] - r[t]) ** 2 // r[t] for t in kept), o.encode(), o) for o, r in own.items() if o != s)
            out |= {(lang, s, "pair", o, -f, k) for k, (f, _, o) in enumerate(pair, 1)}
            term = sorted((-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[t] > q[t])
            out |= {(lang, s, "term", t, -f, k) for k, (f, _, t) in enumerate(term[:top], 1)}
    return out


def _rows(df):
    rows = df.select("lang", "source", "part", "item", "value", "rank").collect()
    assert len(rows) == len({(r["lang"], r["source"], r["part"], r["item"]) for r in rows})
    return {tuple(r) for r in rows}


def test_divergence_of_the_table_equals_the_definition(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "source", "text").collect()
    assert _rows(registry.op12_divergence(spark, SF001)) == _plain_audit(rows)


def test_divergence_of_edge_rows_and_small_blocks(spark, monkeypatch, empty):
    monkeypatch.setattr(divergence, "BLOCK", 8)
    r = random.Random(6)
    words = ["Stone", "stone", "STONE", "été", "Été", "übel", "漢字", "a1b", "x_y", "İst", "w\x85w", "😀", "under-score", *(chr(97 + i) * 3 for i in range(26))]
    rows = [(r.choice(["en", "de", None, ""]), r.choice(["s0", "s0", "s1", "s2", None, ""]), " ".join(r.choice(words) for _ in range(r.randrange(0, 40)))) for _ in range(150)]
    rows += [("en", "silent", None), ("en", "silent", "1 2 3"), ("fr", "s0", "once only"), ("fr", "s1", ""), ("fr", "s2", None), ("it", "alone", "la la la"), ("en", "s0", "stone " * 3000)]
    rows += [("en", "s1", "same row here")] * 4
    df = spark.createDataFrame([(*x, 1, "c!") for x in rows], "lang string, source string, text string, block int, term string").repartition(3)
    assert _rows(divergence.audit(df)) == _plain_audit(rows)
    monkeypatch.setattr(divergence, "BROADCAST", 0)
    assert _rows(divergence.audit(df, min_docs=2, top=3)) == _plain_audit(rows, 2, 3)
    nothing = divergence.audit(df.limit(0))
    assert nothing.count() == 0 and nothing.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_arrays_and_prices_are_exact():
    r = np.random.default_rng(2)
    for _ in range(40):
        ids = np.unique(r.integers(0, divergence.BLOCK, r.integers(0, 400)))
        counts = r.choice([1, 2, 254, 255, 256, 10**12], len(ids))
        got = divergence.decode(*divergence.encode(ids, counts))
        assert got[0].tolist() == ids.tolist() and got[1].tolist() == counts.tolist()
        other = np.unique(r.integers(0, divergence.BLOCK, r.integers(0, 9000)))
        a, b = divergence.intersect(ids, other)
        assert ids[a].tolist() == other[b].tolist() == np.intersect1d(ids, other).tolist()
    for mass in (1, 7, 10**9 + 7, 9 * 10**15 - 1):
        some = [c for c in (0, 1, 254, 10**9, 10**13, mass - 1) if c < mass]
        assert divergence.price(np.array(some), mass).tolist() == [1 + 10**9 * (c + 1) // mass for c in some]


# ---------------------------------------------------------------- licenses

ALL = (*licenses.PHRASES, *licenses.NOTICES)
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _least_edits(text: str, notice: str) -> int:
    """Least edit distance of the notice to any substring."""
    row = np.arange(len(notice) + 1)
    best, letters = row[-1], np.array([ord(c) for c in notice])
    for c in text:
        new = np.concatenate(([0], np.minimum(row[:-1] + (letters != ord(c)), row[1:] + 1)))
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        best = min(best, row[-1])
    return int(best)


def _plain_scan(text: str | None, fuzzy: bool = True):
    words = WORD.findall(lower(text or ""))
    base, labels = [], set()
    for p in licenses.PHRASES:
        phrase = p.text.split()
        base += [(i, p.label) for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
    joined = " ".join(words)
    for n in licenses.NOTICES if fuzzy else ():
        if _least_edits(joined, n.text) <= n.edits:
            labels.add(n.label)
    base_labels = {label for _, label in base}
    at = [i for i, _ in base]
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)))


def _digest(r):
    return (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])


def _damaged(r: random.Random) -> str:
    n = r.choice(ALL)
    q = list(n.text)
    for _ in range(r.randrange(0, n.edits + 3)):
        k, o = r.randrange(len(q)), r.random()
        q[k : k + (o < 0.66)] = [] if o < 0.33 and len(q) > 2 else [r.choice("abc é")]
    return "".join(q)


def test_scan_of_damaged_notices_equals_least_edit_distances(spark):
    r = random.Random(11)
    filler = ["The", "license", "Public", "MIT", "gnu", "general", "ß", "x1", "under", "漢字", "--", "\n", "*"]
    texts = []
    for _ in range(160):
        parts = [r.choice(filler) for _ in range(r.randrange(0, 9))]
        for _ in range(r.randrange(0, 3)):
            parts.insert(r.randrange(len(parts) + 1), _damaged(r).upper() if r.random() < 0.3 else _damaged(r))
        texts.append(r.choice([" ", " ", "\n", ", "]).join(parts))
    texts += ["mit license", "mit licenses", "xmit license", "MIT LICENSE. MIT-License; mit\nlicense mit 1 license", "license mit", "general public license general public license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    out = {x["doc_id"]: x for x in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        assert _digest(out[i]) == _plain_scan(t), t
        assert (out[i]["score"] > 0) == bool(out[i]["labels"]) and 0 <= out[i]["score"] <= 1
        if out[i]["n_base"]:
            assert out[i]["score"] == 1.0


def test_spans_name_places_of_the_given_text(spark):
    text = "Préface — it's all\tRIGHTS  reserved!\nLicensed under the Apache-Licence, Version 2.0; see https://x.y"
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    spans = {p["notice"]: p for p in row["places"]}
    whole = spans["licensed under the apache license version 2 0"]
    assert text[whole["start"] : whole["stop"]] == "Licensed under the Apache-Licence, Version 2.0" and whole["edits"] == 1
    words = WORD.findall(lower(text))
    assert words[whole["first_word"] : whole["last_word"] + 1] == "licensed under the apache licence version 2 0".split()
    rights = spans["all rights reserved"]
    assert text[rights["start"] : rights["stop"]] == "all\tRIGHTS  reserved" and rights["edits"] == 0
    assert row["labels"] == "apache,proprietary" and row["base_labels"] == ""


def test_scan_of_edge_rows(spark, edges, empty):
    out = licenses.scan(edges).drop("places").collect()
    want = Counter((i, *_plain_scan(t, fuzzy=len(t or "") < 4000)) for i, t in edge_texts())
    assert Counter((r["doc_id"], *_digest(r)) for r in out) == want
    assert licenses.scan(empty).count() == 0
    many = "x " * 30000 + "released under the MIT License. " * 3000  # one notice all over a long text
    (row,) = licenses.scan(spark.createDataFrame([(1, many)], "doc_id bigint, text string")).collect()
    assert (row["n_base"], row["first_word"], row["last_word"], row["labels"]) == (3000, 30003, 30003 + 5 * 2999, "mit")
    assert len(row["places"]) == 6000


def test_base_places_of_the_whole_table(spark):
    texts = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    out = registry.op13_license_scan(spark, SF001)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"}
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        want = _plain_scan(text, fuzzy=False)
        assert _digest(got[doc])[:5] == want[:5]
        labels = set(got[doc]["labels"].split(","))
        assert not want[4] or set(want[4].split(",")) <= labels
        assert ("cc by nc" in labels) == ("Licensed under CC BY-NC 4.0" in (text or ""))


def test_a_notice_shorter_than_its_pieces_is_refused():
    with pytest.raises(ValueError, match="too short"):
        licenses.pieces(licenses.Notice("x", "ab", 2))
