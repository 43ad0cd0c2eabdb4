"""Language id, token files, packing, quality, decontamination: whole texts, document by document."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from daybook.llm import decontam, elias_fano, langid, packing, quality, textbytes, tokens
from tests.conftest import SF001, SF01
from tests.llm import brute
from tests.llm.conftest import edge_texts

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


# ---------------------------------------------------------------- tokens


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("ab'srelvdmt  \n\t\r.,1²é漢　😀", max_size=60)), max_size=6))
def test_ids_are_those_of_the_library(texts):
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    texts = [x if x is None else x.encode("utf-8", "ignore").decode() for x in texts]
    ids, ends = tokens.encoder(BPE).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_a_full_memory_and_special_strings_change_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "CHARS", 50)
    own = tokens.Encoder(BPE)
    texts = [t or "" for _, t in edge_texts()] + ["a <|endoftext|> b", "it's 'll'ved"]
    for _ in range(2):
        ids, ends = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


SPECIAL = ["see <|endoftext|> here", "<|endoftext|>", " <|endoftext|><|endoftext|>\n x", None, "", "<|endoftext| <|endoftext|>'s", "plain", "ab\u1c89cd \ua7cb 1\U00010d40 x"]


def test_added_tokens_and_classes_are_those_of_the_library():
    library = Tokenizer.from_file(BPE)  # with its default settings
    for texts in (SPECIAL, SPECIAL[:1], SPECIAL[3:5], ["a" + chr(c) + "1" + chr(c) + " " for c in [*range(0xA600, 0xAC00), *range(0x1C80, 0x1D00), *range(0x10D00, 0x10E00)]]):
        ids, ends = tokens.encoder(BPE).encode(texts)
        want = [e.ids for e in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == want
    assert tokens.encoder(BPE).encode(SPECIAL[:1])[0].tolist() == [3826, 220, 50256, 994]


def test_a_file_of_another_kind_is_left_to_the_library(tmp_path):
    library = Tokenizer.from_file(BPE)
    library.add_tokens([AddedToken("stone", single_word=True, lstrip=True)])
    library.save(str(tmp_path / "file.json"))
    ids, ends = tokens.encoder(str(tmp_path / "file.json")).encode(["a stone, stones", None, *SPECIAL[:3]])
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [library.encode(x, add_special_tokens=False).ids for x in ["a stone, stones", "", *SPECIAL[:3]]]


def test_token_files_and_packing_take_added_tokens(spark):
    library = Tokenizer.from_file(BPE)
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id bigint, text string")
    want = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in enumerate(SPECIAL)}
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in elias_fano.round_trip(df, BPE, end_id=2).collect()}
    assert got == {d: [*ids, 2] for d, ids in want.items()}
    packed = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.pack(df, BPE, window=2048, end_id=1).where("length = doc_tokens").collect()}
    assert packed and packed == {d: [*want[d], 1] for d in packed}


# ---------------------------------------------------------------- 3: token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700))
def test_elias_fano_returns_its_values(values):
    values = np.sort(np.array(values, np.uint64))
    made = elias_fano.EliasFano.of(values)
    again = elias_fano.EliasFano.load(*made.dump())
    assert again.all().tolist() == values.tolist()
    for i in range(0, len(values), 97):
        assert again.select(i) == int(values[i])
        assert again.between(i, min(i + 300, len(values))).tolist() == values[i : i + 300].tolist()


def test_elias_fano_is_near_minimal():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000)).astype(np.uint64)
    head, raw = elias_fano.EliasFano.of(values).dump()
    assert 8 * len(raw) / len(values) < 2 + np.log2(1000) + 1.5  # against 64 bits in a table


def test_token_files_of_edge_cases(edges, library):
    rows = sorted(elias_fano.round_trip(edges, BPE, end_id=2).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert (r["start"], len(r["ids"])) == (at, 4 * r["n_tokens"])
        at += r["n_tokens"]
    order = [r["doc_id"] for r in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    want = sorted((d is not None, d or 0, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in edge_texts())
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == want


def test_documents_of_the_table_by_select(spark, documents, library, tmp_path):
    """Every document of the whole table, read one by one and in blocks, against the library; no sequence is unpacked whole."""
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    path = f"file://{tmp_path}/tokens"
    files = elias_fano.write_tokens(documents.select("doc_id", "text"), path, BPE)
    want = {d: library.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts.items()}
    seen = {}
    for f in files:
        for k in range(0, f["n_docs"], 7):
            doc, start, ids = elias_fano.document_at(f"{path}/{f['file']}", k)
            assert ids.tolist() == want[doc]
            seen[doc] = f["start"] + start
    rows = elias_fano.read_tokens(spark, path).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows} == want
    assert all(r["start"] == seen[r["doc_id"]] for r in rows if r["doc_id"] in seen) and seen


def test_token_files_of_an_empty_table(empty):
    assert elias_fano.round_trip(empty, BPE).collect() == []


# ---------------------------------------------------------------- 4: packing


def test_most_ids_stay_where_the_rule_placed_them():
    """Ids cut anew at a task's end: few, also for a task of few documents; nothing is padded."""
    rng = np.random.default_rng(7)
    for docs, most in ((300, 0.25), (3000, 0.1)):
        bins = packing.SumOfSquares(2048)
        sizes = np.minimum(rng.lognormal(6, 1.2, docs).astype(int) + 1, 20_000)
        out, total = [], 0
        for d, n in enumerate(sizes.tolist()):
            rest = n % 2048
            total += n
            if rest and (full := bins.place((d, n - rest, n, np.arange(rest)))):
                out.append(full)
        out += list(bins.drain())
        lengths = [sum(len(p[3]) for p in s) for s in out]
        assert sum(lengths) == int((sizes % 2048).sum()) and all(x == 2048 or x & (x - 1) == 0 for x in lengths)
        assert sum(x < 2048 for x in lengths) <= 11 and bins.cut <= most * total
        ids = Counter((p[0], p[1] + k) for s in out for p in s for k in range(len(p[3])))
        assert set(ids.values()) == {1}


def test_a_placement_keeps_the_sum_of_squares_least():
    rng = np.random.default_rng(3)
    bins = packing.SumOfSquares(24)
    for size in rng.integers(1, 24, 400).tolist():
        before = bins.count.copy()

        def after(level):
            n = before.copy()
            if level:
                n[level] -= 1
            if level + size < 24:
                n[level + size] += 1
            return int((n[1:24] ** 2).sum())

        best = min([after(0), *(after(h) for h in range(1, 24 - size + 1) if before[h])])
        bins.place((0, 0, size, np.zeros(size, np.uint32)))
        assert int((bins.count[1:24] ** 2).sum()) == best


def _whole(rows, want, window):
    """Every id in one piece, sequences gapless and padded nowhere but at a power of two."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == list(itertools.accumulate([0, *(r["length"] for r in s[:-1])]))
        fill = s[-1]["offset"] + s[-1]["length"]
        assert fill == window or fill & (fill - 1) == 0
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for d, ids in want.items():
        got = sorted(pieces[d], key=lambda r: (r["start"], r["sequence_id"], r["offset"]))
        assert sum(r["length"] for r in got) == sum(map(len, ids))
        if len(ids) == 1:
            assert [r["start"] for r in got] == list(itertools.accumulate([0, *(r["length"] for r in got[:-1])]))
            assert b"".join(r["ids"] for r in got) == np.array(ids[0], "<u4").tobytes()
            assert {r["doc_tokens"] for r in got} == {len(ids[0])}


def test_packing_of_edge_cases(edges, empty, library):
    want = defaultdict(list)
    for d, t in edge_texts():
        want[d].append(library.encode(t or "", add_special_tokens=False).ids + [1])
    _whole(packing.pack(edges, BPE, window=64).collect(), want, 64)
    assert packing.pack(empty, BPE).collect() == []


def test_packing_pads_next_to_nothing(documents, library):
    rows = packing.pack(documents, BPE, window=512).collect()
    want = {r["doc_id"]: [library.encode(r["text"], add_special_tokens=False).ids + [1]] for r in documents.collect()}
    _whole(rows, want, 512)


# ---------------------------------------------------------------- 8: quality


def test_base_counts_equal_brute_force(edges):
    ratio = np.zeros(1 << quality.BITS)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, *(r[c] for c in names), r["base_failed"], r["kept"]) for r in quality.judge(edges, ratio).collect())
    want = []
    for d, t in edge_texts():
        c = brute.base_counts(t)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want.append((d is not None, d or 0, *c, failed, not failed))
    assert got == sorted(want)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab é\n\t#|\x0b\x85", max_size=40), max_size=5))
def test_base_counts_of_any_text(texts):
    import pyarrow as pa

    r = quality.base_counts(*textbytes.texts_of(pa.array(texts, pa.string())))
    assert list(zip(*(r[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True)) == [brute.base_counts(t) for t in texts]


def test_scores_equal_the_two_multinomials(spark, documents):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    ratio = quality.fit(documents, labels)
    texts = {r["doc_id"]: r["text"].encode() for r in documents.collect()}
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect()}

    def grams(raw):
        out = []
        for i in range(len(raw) - 2):
            x = (raw[i] * 257 + raw[i + 1]) * 257 + raw[i + 2]
            out.append((x * 0x9E3779B1 & 0xFFFFFFFF) >> 16)
        return out

    raw, target = np.ones(1 << 16), np.ones(1 << 16)
    for d, t in texts.items():
        np.add.at(raw, grams(t), 1)
        if d in trusted:
            np.add.at(target, grams(t), 1)
    want = np.log(target / target.sum()) - np.log(raw / raw.sum())
    assert np.allclose(ratio, want)
    judged = {r["doc_id"]: r for r in quality.judge(documents, ratio).collect()}
    for d, t in texts.items():
        score = want[grams(t)].mean() if len(t) > 2 else 0.0
        assert judged[d]["llr"] == pytest.approx(score, abs=1e-9)
        assert judged[d]["kept"] == (not judged[d]["base_failed"] and judged[d]["llr"] >= quality.THRESHOLD)


def test_trusted_documents_stay_and_junk_goes(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.judge(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("not base_failed")
    share = {r["quality"]: r["share"] for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.99 and share[0] < 0.2


def test_quality_without_labels_and_without_rows(edges, empty, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert not quality.fit(edges, none).any()
    assert quality.judge(empty, quality.fit(empty, none)).collect() == []
    kept = quality.keep(edges, quality.fit(edges, none))
    assert kept.columns == edges.columns and 0 < kept.count() < edges.count()


# ---------------------------------------------------------------- 1: language


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    data, offsets = textbytes.texts_of(__import__("pyarrow").array(["ab cd ef\ngh", "ij kl"]))
    c = langid.chains(data, offsets)
    m = langid.Model(["p", "q", "r"], np.empty(0, np.uint64), rng.normal(size=(1 << langid.BITS, 3)), rng.normal(size=(1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    score, expected = m.emissions(c)[c.code], np.zeros((3, 3))
    post = m.posterior(c, expected)
    ends = np.append(c.chain, len(c.code))
    pairs = np.zeros((3, 3))
    for a, b in zip(ends, ends[1:], strict=False):
        total, marginal, joint = 0.0, np.zeros((b - a, 3)), np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=b - a):
            w = np.exp(m.first[y[0]] + sum(score[a + i, k] for i, k in enumerate(y)) + sum(m.steps[p, q] for p, q in itertools.pairwise(y)))
            total += w
            for i, k in enumerate(y):
                marginal[i, k] += w
            for p, q in itertools.pairwise(y):
                joint[p, q] += w
        assert np.allclose(post[a:b], marginal / total)
        pairs += joint / total
    assert np.allclose(expected, pairs)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    out = langid.identify(docs, langid.fit(docs, rest != 2)).join(docs.select("doc_id", "lang"), "doc_id").where(rest == 2)
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_code_switched_text_is_labelled_word_by_word(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    en, de = (docs.where(F.col("lang") == x).orderBy("doc_id").first()["text"].split("\n")[0] for x in ("en", "de"))
    row = langid.identify(spark.createDataFrame([(1, f"{en} {de}")], "doc_id bigint, text string"), model, spans=True).first()
    assert row["n_switches"] >= 1 and {s["lang"] for s in row["spans"]} >= {"en", "de"}
    assert row["spans"][0]["start"] == 0


def test_language_of_edge_cases(spark, edges, empty):
    texts = [None, "", "123 !?", "。。", "漢字", "Élan"]
    model = langid.fit(edges, F.lit(True))
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["und", "und", "und", "und", "en", "en"]
    assert [got[i]["score"] for i in range(4)] == [0.0] * 4
    assert langid.identify(edges, model).count() == edges.count()
    blind = langid.fit(edges, F.lit(False))
    assert langid.identify(edges, blind).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(empty, blind).collect() == []


# ---------------------------------------------------------------- 6: decontamination


def _contained(docs, items):
    out = []
    for i, t in items:
        size = min(5, max(1, len(brute.WORD.findall(t or ""))))  # a short item has shingles of its own length
        x = brute.shingles(t, size)
        for d, u in docs:
            both = len(x & brute.shingles(u, size))
            if both and 100 * both >= 80 * len(x):
                out.append((d is None, d or 0, i is None, i or 0, len(x), both))
    return sorted(out)


def _found(df, items):
    rows = decontam.find(df, items).collect()
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["item_id"] is None, r["item_id"] or 0, r["item_shingles"], r["shared"]) for r in rows)


def test_containment_of_edge_cases(spark, edges, empty, monkeypatch):
    texts = edge_texts()
    words = texts[10][1].split()
    items = [
        (1, " ".join(words[900:940])), (2, " ".join(words[5000:5009]).upper()), (3, None), (4, ""), (5, "one two three four"), (6, "no such passage is in any text of these"),
        (None, " ".join(words[10:60])), (7, " ".join(words[10:60])), (7, " ".join(words[10:60])), (8, " ".join(words[100:130] + ["changed"] + words[131:145])), (9, " ".join(words[200:206])),
        (10, " ".join(words[300:304])), (11, " ".join(words[400:402])), (12, words[7]), (13, " ".join(words[600:612])), (14, " ".join(words[700:712] + ["off"] + words[712:716])),
    ]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    want = _contained(texts, items)
    assert len(want) >= 8
    assert _found(edges, frame) == want
    monkeypatch.setattr(decontam, "ITEMS", 3)  # several blocks
    assert _found(edges, frame) == want
    kept = decontam.keep(edges, frame)
    acts = _contained(texts, [(i, t) for i, t in items if len((t or "").split()) >= decontam.KEEP_WORDS])
    assert kept.columns == edges.columns and kept.count() == len(texts) - sum((d is None, d or 0) in {w[:2] for w in acts} for d, _ in texts)
    assert decontam.find(empty, frame).collect() == [] and decontam.find(edges, frame.where("false")).collect() == []


def test_items_that_share_their_beginning_are_found_by_the_rest(spark):
    """Shingles that very many items share are no keys; every item is still found, with nine words in ten as well."""
    rng = np.random.default_rng(5)
    word = lambda: "w" + str(rng.integers(10**6))
    head = " ".join(word() for _ in range(30))
    items = [(i, head + " " + " ".join(word() for _ in range(25))) for i in range(300)]
    some = [items[i][1].split() for i in (3, 77)]
    some[1][40] = "other"
    docs = [(0, " ".join(word() for _ in range(3000))), (1, " ".join([word() for _ in range(2000)] + some[0] + [word() for _ in range(900)])), (2, " ".join(some[1])), (3, head)]
    index = decontam.Index(items, 5, 80)
    keys, begin, _, _ = index.tables[0]
    assert np.diff(begin).max() == 1  # the head's shingles are left out
    got = _found(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == _contained(docs, items) and {(g[1], g[3]) for g in got} == {(1, 3), (2, 77)}


def test_containment_on_the_tables(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    want = _contained([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert want and _found(docs, items) == want
