"""Edge cases and brute-force forms of the operators: empty and unlabelled tables, clashing names, long texts, explicit kernels."""

import math
import random
import re
import struct
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from kensa.llm import common, decontamination, langid, pii, pipeline, quality, queries, wfst

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or [None] * len(texts))[i], None, None) for i, t in enumerate(texts)], DOCS)


# ---- long texts ---------------------------------------------------------------------

def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    data = np.frombuffer(("the quick " * 300 + "x" * 5000 + " yy " + "é" * 20).encode(), np.uint8)
    starts, ends, _ = common.find_words(data, np.array([0, len(data)]))
    want = common.hash_words(data, starts, ends)
    for size in (16, 100, 4096):
        monkeypatch.setattr(common, "SEGMENT_BYTES", size)
        common._powers.cache_clear()
        assert (common.hash_words(data, starts, ends) == want).all()
    monkeypatch.undo()
    common._powers.cache_clear()
    assert len(set(want.tolist())) == 5


def test_spans_are_searched_in_reasonable_time():
    text = " ".join(f"a{i}.b@host{i % 977}.org" for i in range(40_000))
    began = time.perf_counter()
    found = pii.find(text)
    assert len(found) == 40_000 and time.perf_counter() - began < 10
    assert found == sorted(found) and all(a[1] <= b[0] for a, b in zip(found, found[1:]))


# ---- op 1: a plain BM25 ---------------------------------------------------------------

def plain(t):
    return [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())]


def runs(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def test_op1_against_plain_bm25(spark):
    texts = [(r["doc_id"], plain(r["text"])) for r in common.documents(spark, SF).collect()]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    entries = [(i, [p.tolist() for p in [np.array(x, object)]][0]) for i, t in items.items() for x in np.array_split(np.array(plain(t), object), max(1, -(-len(plain(t)) // 96)))]
    df, mean = Counter(w for _, e in entries for w in set(e)), sum(len(e) for _, e in entries) / len(entries)
    idf = {w: math.log(1 + (len(entries) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    weight = []
    for i, e in entries:
        own = {w: idf[w] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(e) / mean)) for w, n in Counter(e).items()}
        weight.append((i, {w: x / sum(own.values()) for w, x in own.items()}))
    sure, maybe = set(), set()
    for d, w in texts:
        for k in range(max(0, -(-(len(w) - 96) // 48)) + 1):
            passage = set(w[48 * k:48 * k + 96])
            for i, own in weight:
                score = sum(x for v, x in own.items() if v in passage)
                if score < 0.4 - 2e-5:
                    continue
                reach = len(plain(items[i])) if len(plain(items[i])) > 96 else 0
                around = w[max(0, 48 * k - 96 - reach):48 * k + 192 + reach]
                halves = [plain(x) for x in decontamination.split_item(items[i])]
                share = [len(runs(h, min(3, len(h))) & runs(around, min(3, len(h)))) / len(runs(h, min(3, len(h)))) if h else 1 for h in halves]
                if min(share) >= 0.6:
                    maybe.add((d, i))
                    if score > 0.4 + 2e-5:
                        sure.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_decontamination(spark, SF).collect()}
    assert sure and sure <= got <= maybe


# ---- op 2: the kernel written out -------------------------------------------------------

def grams(t):
    t = t.lower()
    return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


@pytest.mark.parametrize("dense", [1 << 22, 0])
def test_kernel_features_equal_shared_ngrams(monkeypatch, dense):
    monkeypatch.setattr(langid, "DENSE", dense)
    rng = random.Random(3)
    word = lambda signs: "".join(rng.choice(signs) for _ in range(rng.randint(1, 7)))
    marks = [" ".join(word(s) for _ in range(30)) for s in ("abcde", "AbÇé", "дежз", "日本語字")]
    lower, two, three, n = langid._compile(marks)
    matrix = np.zeros((n, len(marks)), np.float32)
    model = langid.Model(("x",), lower, two, three, matrix, np.zeros((len(marks) + 1, 1)))
    for j, t in enumerate(marks):
        points = np.frombuffer(t.encode("utf-32-le"), np.uint32)
        for ids in langid._grams(model, points, np.array([0, len(points)])):
            matrix[ids, j] = 1
    matrix[0] = 0
    matrix /= np.sqrt(matrix.sum(0))
    texts = ["", "a", "abC dé", "日本 語 дез", "zzz", *(" ".join(word("abcдежé日") for _ in range(40)) for _ in range(30))]
    body = "".join(texts).encode()
    got, letters = langid.features(model, np.frombuffer(body, np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)]))
    alphabet = set().union(*map(grams, marks))
    for t, row in zip(texts, got):
        own = grams(t) & alphabet
        for mark, value in zip(marks, row):
            assert value == pytest.approx(len(own & grams(mark)) / math.sqrt(max(len(own), 1) * len(grams(mark))), abs=1e-5)
    assert letters.tolist() == [bool(t) for t in texts]


def test_languages_of_short_texts_and_rare_ones_are_learnt(spark):
    common.prepare(spark)
    long = ["the grey geese fly over the lazy river and the old mill", "die graue Gans fliegt über den Fluss und die alte Mühle"]
    texts = [f"{long[i % 2]} {i}" for i in range(200)] + ["да", "нет и", "это он"] * 20 + ["où ça été"]
    langs = ["en", "de"] * 100 + ["ru"] * 60 + ["fr"]
    df = docs(spark, texts, langs)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(df, langid.fit(spark, df)).collect()}
    assert all(got[i] == lang for i, lang in enumerate(langs) if lang != "fr")
    many = docs(spark, [f"{chr(97 + i % 26)}{chr(97 + i // 26)} " * 9 for i in range(300)], [f"l{i}" for i in range(300)])
    assert len(langid.fit(spark, many).languages) == 300      # more languages than landmarks


def test_nothing_to_learn_from(spark, tmp_path):
    common.prepare(spark)
    df = docs(spark, ["some text", None, "да"])
    model = langid.fit(spark, df)
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(df, model).collect()} == {("und", 0.0)}
    learn = quality.with_statistics(df).withColumn("quality", F.lit(None).cast("int")).withColumn("h", F.lit(1).cast("long"))
    scores = quality.score(quality.with_statistics(df), quality.fit(learn)).collect()
    assert {(r["score"], r["predicted"]) for r in scores} == {(0.5, 1)}
    # whole queries over empty tables
    for name in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, run in queries.QUERIES.items():
        assert run(spark, str(tmp_path)).count() == 0, name
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_go_through_all_stages(spark, tmp_path):
    from kensa.llm.pipeline import STAGES
    body = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None), (None, body, "en", "x", 5), (None, None, None, None, None), (3, body, None, None, None)], DOCS)
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = df
    for _, stage in STAGES:
        out = common.scratch(stage(spark, out, str(tmp_path)), "test")
    assert sorted(((r["doc_id"] or 0), r["ids"] is None) for r in out.collect()) == [(0, False), (0, True), (1, True), (2, False), (3, False)]


# ---- op 4: distinctness and coreference over a corpus -----------------------------------

def test_surrogates_over_a_corpus(spark):
    key = pii.demo_key("corpus")
    people = [("Mr", "m", f"Adam{c} Stone{d}") for c in ("son", "sen") for d in ("field", "ford", "well")]
    rows, said = [], []
    for i in range(60):
        title, _, name = people[i % len(people)]
        mail, phone = f"u{i % 20}@site{i % 3}.org", f"+1 (555) 0{i % 30:02d}-{1000 + i % 30}"
        rows.append((i, f"{title} {name} wrote from {mail.upper() if i % 2 else mail} or {phone}.", "k", 1, "v"))
        said.append((name, mail, re.sub(r"\D", "", phone)))
    schema = "doc_id long, text string, doc string, kind int, value string"
    df = spark.createDataFrame(rows, schema).repartition(5)
    got = {r["doc_id"]: r for r in pii.pseudonymise(df, key, count="n").collect()}
    new = [re.fullmatch(r"Mr ([\w ]+) wrote from (\S+@\S+) or (\+\d \(\d{3}\) \d{3}-\d{4})\.", got[i]["text"]).groups() for i in range(60)]
    new = [(n, m.lower(), re.sub(r"\D", "", p)) for n, m, p in new]
    for kind in range(3):
        pairs = {(a[kind], b[kind]) for a, b in zip(said, new)}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})          # one surrogate each, all distinct
        assert not {a for a, _ in pairs} & {b for _, b in pairs}
    assert all(r["doc"] == "k" and r["kind"] == 1 and r["value"] == "v" and r["n"] >= 3 for r in got.values())


# ---- op 7: ridge and calibration by hand --------------------------------------------------

def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(4)
    x = np.round(rng.random(400), 2)
    y = (rng.random(400) < x).astype(float)
    steps, levels = quality.isotonic(x, y)
    assert (np.diff(levels) >= 0).all() and (np.diff(steps) >= 0).all()
    # min-max formula of the isotonic fit, on the distinct values
    xs = np.unique(x)
    total, n = np.array([y[x == v].sum() for v in xs]), np.array([(x == v).sum() for v in xs])
    for k in range(len(xs)):
        means = [[total[i:j + 1].sum() / n[i:j + 1].sum() for j in range(k, len(xs))] for i in range(k + 1)]
        want, got = max(min(m) for m in means), float(np.interp(xs[k], steps, levels))
        size = n[np.searchsorted(xs, steps[np.searchsorted(steps, xs[k], "right") - 1]):].sum()
        assert abs(got - want) < 0.08 or size < 40      # small pools are drawn to a half


def test_ridge_weights_by_hand(spark):
    common.prepare(spark)
    df = common.documents(spark, SF)
    learn = quality.with_statistics(df).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    model = quality.fit(learn)
    rows = [r for r in learn.withColumn("third", F.pmod(F.hash("h"), F.lit(3)) == 0).collect() if not r["third"]]
    x = model.cosines(np.array([np.frombuffer(r["stats"]) for r in rows]))
    y = np.array([float(r["quality"]) for r in rows])
    want = np.linalg.solve(x.T @ x + quality.RIDGE * len(x) / quality.N_COSINES * np.eye(x.shape[1]), x.T @ y)
    assert np.allclose(model.weights, want, atol=1e-6)


# ---- op 10: the pair machine ----------------------------------------------------------------

def test_pairs_equal_carried_out_merges():
    m = wfst.compile_model(Path(queries.TOKENIZER).read_bytes())
    rng, pieces = random.Random(1), [p for p in m.ids if len(p) < 9]
    starts = {}
    for p in pieces:
        starts.setdefault(p[0], []).append(p)
    seen = Counter()
    for _ in range(4000):
        left = rng.choice(pieces)
        right = rng.choice(pieces if rng.random() < 0.5 else starts[rng.choice("aeiostn")])
        if wfst.MARK in right:
            continue
        want = left + right not in m.ids and m.merge(left + right) == [left, right]
        assert m.pair(left, right) == want, (left, right)
        seen[want] += 1
    assert min(seen.values()) > 300
    for p in pieces[:500]:
        assert (m.split(p) is not None) == (m.merge(p) == [p])


def _message(*fields) -> bytes:
    """A protocol buffer message of (number, int, float or bytes)."""
    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)
    return b"".join(varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 5) + struct.pack("<f", v) if isinstance(v, float)
                    else varint(k << 3 | 2) + varint(len(v)) + v for k, v in fields)


def _bpe(pieces: list[str], front: int) -> wfst.Machine:
    """A BPE model of merges, the first the best, over ``<unk>`` and all bytes."""
    made = [(1, _message((1, b"<unk>"), (2, 0.0), (3, 2)))] + [(1, _message((1, b"<0x%02X>" % b), (2, 0.0), (3, 6))) for b in range(256)]
    made += [(1, _message((1, p.encode()), (2, -float(i)), (3, 1))) for i, p in enumerate(pieces)]
    return wfst.compile_model(_message(*made, (2, _message((3, 2), (40, 0))), (3, _message((1, b"identity"), (3, front), (4, front)))))


def test_paths_followed_together_equal_single_paths_and_merges():
    # c, é and the emoji are no pieces, c is in some; "bbb" cannot be made by merges; ties lie between left and right
    pieces = ["aa", "ab", "ba", "▁a", "bc", "aab", "bcb", "abab", "▁aab", "bbb", "baba", "▁▁", "▁", "a", "b", "caa", "ca"]
    rng = random.Random(4)
    texts = ["".join(rng.choices("aaabbbc ▁é\n😀", k=rng.randrange(40))) for _ in range(1500)] + ["", " ", "▁", "a" * 200, "\x00"]
    for m in (_bpe(pieces, 1), _bpe(pieces, 0)):
        together = [np.frombuffer(p, np.int32).tolist() for p in m.packed_ids(texts)]
        for text, ids in zip(texts, together):
            normal = m.normalise(text)
            assert ids == m.merge_path(normal) == m.shortest_path(normal)
            merged = [[m.ids[p]] if p in m.ids else [m.bytes_[b] for b in p.encode()] for p in m.merge(normal)]
            assert ids == [i for part in merged for i in part]
            assert m.decode(ids) == m.plain(text)


def test_new_words_are_not_followed_one_by_one(monkeypatch):
    data = Path(queries.TOKENIZER).read_bytes()
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices(["th", "er", "on", "a", "s", "é", ".\n"], k=rng.randrange(1, 8))) for _ in range(60)) for _ in range(40)] + ["y" * 65 + " it"]
    want = [m.merge_path(m.normalise(t)) for m in [wfst.compile_model(data)] for t in texts]
    single, alone = [], wfst.Machine.merge_path
    monkeypatch.setattr(wfst.Machine, "merge_path", lambda self, t: single.append(t) or alone(self, t))
    monkeypatch.setattr(wfst, "WORDS_KEPT", 500)      # tables change places
    monkeypatch.setattr(wfst, "TOGETHER", 37)
    monkeypatch.setattr(wfst, "PAIR_BITS", 3)         # pairs take each other's places
    m = wfst.compile_model(data)
    got = [np.frombuffer(p, np.int32).tolist() for lo in range(0, len(texts), 7) for p in m.packed_ids(texts[lo:lo + 7])]
    assert got == want
    assert single == ["▁" + "y" * 65] and "y" * 65 not in m.words
    assert len(m.words) <= 500 and len(m.older) <= 500 and m.older


def test_encode_cuts_batches_by_bytes(spark, monkeypatch):
    rows = [(1, "the end " * 40000, "x"), (2, None, "y"), (None, "", None), (2, "thence\nthere  é", "y"), (2, "thence\nthere  é", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string").coalesce(1)
    data = Path(queries.TOKENIZER).read_bytes()
    m = wfst.compile_model(data)
    got = wfst.decode(wfst.encode(df, data, normal="normal"), data).collect()
    assert [(r["doc_id"], r["text"], r["kept"]) for r in got] == rows
    assert [r["ids"] for r in got] == [None if t is None else m.merge_path(m.normalise(t)) for _, t, _ in rows]
    assert all(r["decoded"] == r["normal"] for r in got)
    assert wfst.encode(df.limit(0), data).count() == 0
