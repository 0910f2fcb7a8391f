"""Training-data operators on small fixtures: brute force, round trips, edge cases."""

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from kensa.llm import ann, common, decontamination, langid, licenses, lm, minmax, packed, pii, pipeline, quality, queries, substrings, wfst

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cls long, comp long, u string"
PROSE = "the quick brown fox jumps over the lazy dog while seven grey geese fly south across a cold and windy lake "


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty, one word, a very long text, ties, a repeated row, clashing extra columns."""
    common.prepare(spark)
    long_text = " ".join(f"w{i % 977} x{i % 1009}" for i in range(40_000))
    texts = [None, "", "  \n ", "word", PROSE, PROSE, PROSE + "now", long_text, "a a a a a a a a a a a a a a a a a", "日本語 ▁ \U0001f389", PROSE.upper()]
    rows = [(i, t, None if i % 3 else "en", None, None, 1, 2, "x") for i, t in enumerate(texts)]
    rows += [rows[4], (None, PROSE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_windows(rows):
    first, out = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for k in range(len(w) - 12):
            first[tuple(w[k:k + 13])] = min(i, first.get(tuple(w[k:k + 13]), i))
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        out.setdefault(i, []).append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return {k: sorted(v) for k, v in out.items()}


def test_substrings_edges(edge, nothing):
    got = {}
    for r in substrings.remove_repeats(edge).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"], r["kept"]))
    assert {k: sorted(v) for k, v in got.items()} == brute_windows([(r["doc_id"], r["text"]) for r in edge.collect()])
    assert substrings.remove_repeats(nothing).count() == 0


def test_op3_against_brute_force(spark):
    docs = common.documents(spark, SF).select("doc_id", "text").collect()
    want = {i: v[0] for i, v in brute_windows([(r["doc_id"], r["text"]) for r in docs]).items()}
    for r in queries.op3_substring_dedup(spark, SF).collect():
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


def test_symbols_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    window = rng.integers(0, 6, 13).astype(np.uint64)
    seen = set()
    for _ in range(200):
        a, z = rng.integers(0, 6, rng.integers(0, 5)), rng.integers(0, 6, rng.integers(0, 5))
        text = np.concatenate([a, window, z]).astype(np.uint64)
        h, first = common.mix(text + np.uint64(9)), np.array([0, len(text)])
        starts = substrings.windows(first)
        seen.add(int(substrings.anchors(h, first, starts)[len(a)]))
    assert len(seen) == 1


def shingle_set(t, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_groups(rows, k):
    sets = {i: shingle_set(t, k) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_op6_against_brute_force(spark):
    docs = common.documents(spark, SF).select("doc_id", "text").collect()
    want = brute_groups([(r["doc_id"], r["text"]) for r in docs], 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op6_near_duplicates(spark, SF).collect()}
    assert got == want


def test_minmax_edges(edge, nothing):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minmax.groups(edge, 2).collect()}
    want = brute_groups([(r["doc_id"], r["text"]) for r in edge.collect() if r["doc_id"] is not None], 2)
    assert {g for g in got if g[0] is not None} == {(i, *v) for i, v in want.items()}
    assert {g[2:] for g in got if g[0] is None} == {(None, True)}
    assert minmax.groups(nothing, 2).count() == 0


def test_block_links_are_exact():
    rng = np.random.default_rng(3)
    own = [{"cls": i, "comp": i, "x": np.unique(rng.integers(0, 60, 40).astype(np.uint64)).tobytes()} for i in range(30)]
    a, b = minmax._links(own, own, 50, 100)
    sets = [set(np.frombuffer(r["x"], np.uint64).tolist()) for r in own]
    assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i in range(30) for j in range(30) if i != j and 100 * len(sets[i] & sets[j]) >= 50 * len(sets[i] | sets[j])}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.smallest_labels(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_lm_against_counts(edge, nothing):
    rows = [(r["doc_id"], words(r["text"])) for r in edge.collect()]
    one, two = Counter(x for _, w in rows for x in w), Counter(x for _, w in rows for x in zip(w, w[1:]))
    total, want = sum(one.values()), []
    for i, w in rows:
        u, b, s = Counter(w), Counter(zip(w, w[1:])), 0.0
        for j, x in enumerate(w):
            if j and two[w[j - 1], x] > b[w[j - 1], x]:
                s += math.log((two[w[j - 1], x] - b[w[j - 1], x]) / max(one[w[j - 1]] - u[w[j - 1]], 1))
            else:
                s += math.log(max(one[x] - u[x], 0.5) / max(total - len(w), 1)) + (math.log(0.4) if j else 0)
        want.append((-1 if i is None else i, len(w), s))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["score"]) for r in lm.score(edge).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-9, abs=1e-6)
    assert lm.score(nothing).count() == 0


def test_op9_scores_triples(spark):
    rows = [(r["doc_id"], words(r["text"])) for r in common.documents(spark, SF).collect()]
    runs = [Counter(tuple(w[j:j + k]) for _, w in rows for j in range(len(w) - k + 1)) for k in range(4)]
    total, want = sum(runs[1].values()), []
    for i, w in rows:
        own = [Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) for k in range(4)]
        c = lambda *g: runs[len(g)][g] - own[len(g)][g]
        s = low = 0
        for j, x in enumerate(w):
            top = min(j + 1, 3)
            k = next((k for k in range(top, 1, -1) if c(*w[j - k + 1:j + 1]) > 0), 1)
            s += (top - k) * math.log(0.4) + (math.log(c(*w[j - k + 1:j + 1]) / c(*w[j - k + 1:j])) if k > 1 else math.log(max(c(x), 0.5) / max(total - len(w), 1)))
            low += k < top
        want.append((i, len(w), low, s))
    got = sorted(tuple(r)[:4] for r in queries.op9_lm_scores(spark, SF).collect())
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], rel=1e-9, abs=1e-6)


def test_license_edges(edge, nothing):
    got = {r["doc_id"]: r for r in licenses.scan(edge).collect()}
    assert got[0]["n_words"] == 0 and got[0]["first_word"] is None and got[0]["labels"] == ""
    assert licenses.scan(nothing).count() == 0


def test_license_places(spark):
    df = spark.createDataFrame([(1, "CC-BY. Then: Released under the MIT License\nmit license"), (2, "license mit"), (3, "licensed under the apache license, version 2.0")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (3, 0, 8, "cc-by,mit")
    assert got[1]["labels"] == "cc-by,mit,mit-notice" and got[2]["labels"] == "" and got[3]["labels"] == "apache,apache-2.0"


def test_license_notices_are_found_wrapped(spark):
    mit = """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal"""
    bsd = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:"""
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy"
    gnu = "you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option)"
    texts = [mit, bsd, mpl, gnu.format("", 3), gnu.format("", 2), gnu.format("Affero ", 3), gnu.format("Lesser ", 2.1),
             "hereby granted " + "x " * 30 + "permission free of charge to any person\nobtaining a copy of this software is", None]
    texts += [" ".join(t.split()) for t in texts[:3]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(12)] == ["mit-permission", "bsd-3-clause", "mpl-2.0", "gpl,gpl-3.0", "gpl", "agpl-3.0", "lgpl-2.1", "", "", "mit-permission", "bsd-3-clause", "mpl-2.0"]


def test_decontamination(spark, edge, nothing):
    items = spark.createDataFrame([(1, "Where do seven grey geese fly over the lazy dog? Answer: south across a cold"), (2, None), (3, ""), (4, PROSE)], "item_id long, text string")
    hit = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(edge, items).collect()}
    assert hit == {(4, 4), (5, 4), (6, 4), (10, 4), (None, 4)}
    left = decontamination.clean(edge, items)
    assert left.columns == edge.columns and {r["doc_id"] for r in left.collect()} == {0, 1, 2, 3, 7, 8, 9, None}
    assert decontamination.contaminated(nothing, items).count() == 0
    assert decontamination.contaminated(edge, items.where("item_id = 3")).count() == 0


def test_op1_finds_every_whole_item(spark):
    docs, items = common.documents(spark, SF).collect(), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_decontamination(spark, SF).collect()}
    assert {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]} <= got


def test_decontamination_of_long_items(spark):
    say = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    around = [say("before", 1000), say("after", 1000)]
    long, asked = say("item", 600), say("question", 590) + ". Answer: " + say("reply", 700)
    items = spark.createDataFrame([(1, long), (2, asked), (3, PROSE)], "item_id long, text string")
    docs = [" ".join([around[0][:50 * i], t, around[1]]) for i, t in enumerate([long, asked, say("item", 300), say("question", 590), asked])]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(df, items).collect())
    assert got == [(0, 1), (1, 2), (4, 2)]
    assert sorted(r["doc_id"] for r in decontamination.clean(df, items).collect()) == [2, 3]


def test_decontamination_of_repeated_item_ids(spark):
    one = "Which river runs past the old mill and the seven stone bridges? Answer: the slow green river of the north"
    two = "Name the metal that melts in a warm hand on a summer day. Answer: gallium is the metal that melts there"
    three = "How many moons circle the planet with the widest rings? Answer: more than eighty moons were counted so far"
    items = spark.createDataFrame([("a", one)] * 3 + [("b", two), ("b", three), ("c", PROSE)], "item_id string, text string").repartition(4)
    df = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {two} y"), (3, f"x {three} y"), (4, f"{two} {three}"), (5, "clean")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], round(r["score"], 4)) for r in decontamination.contaminated(df, items).collect())
    assert got == [(1, "a", 1.0), (2, "b", 1.0), (3, "b", 1.0), (4, "b", 1.0)]
    assert [r["doc_id"] for r in decontamination.clean(df, items).collect()] == [5]


def test_pii(edge, nothing, spark):
    key = pii.demo_key("t")
    text = "Mail A.b@x.org or a.B@X.org, call +1 (826) 555-4081 190.137.2.9 4111 1111 1111 1111 and Mrs. Clara Schmidt. token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""
    df = spark.createDataFrame([(1, text), (2, "again 4111111111111111"), (3, "no data here. M. Le")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(df, key, count="n").collect()}
    new = got[1]["text"]
    assert got[1]["n"] == 7 and got[3]["text"] == "no data here. M. Le" and got[3]["n"] == 0
    for old in ("A.b@x.org", "555-4081", "190.137.2.9", "4111 1111", "Schmidt", "04dbebab"):
        assert old not in new
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", new)[0].replace(" ", "")
    assert pii.luhn(card) == 0 and card in got[2]["text"]
    mails = re.findall(r"\S+@example\.org", new)
    assert len(mails) == 2 and mails[0].lower() == mails[1].lower()
    assert re.search(r"Mrs\. \w+ \w+er\.", new) and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)
    assert sorted(map(str, pii.pseudonymise(edge, key).collect())) == sorted(map(str, edge.collect()))
    assert pii.pseudonymise(nothing, key).count() == 0


def test_pii_collisions(spark, monkeypatch):
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, value, attempt=0: str(int(hashlib.md5(f"{value}{attempt}".encode()).hexdigest(), 16) % 97))
    found = spark.createDataFrame([("card", str(i)) for i in range(40)], "kind string, value string").coalesce(1)
    got = pii.assign(found, b"k").collect()
    assert len({r["surrogate"] for r in got}) == 40 and not {r["surrogate"] for r in got} & {str(i) for i in range(40)}


def test_pii_settles_addresses_of_one_shape(spark):
    key = pii.demo_key("t")
    values = [f"{chr(97 + i % 26)}@h{i}.com" for i in range(40)] + ["_@a.com", "_@b.com"]
    got = pii.assign(spark.createDataFrame([("email", v) for v in values], "kind string, value string").coalesce(1), key).collect()
    assert len({r["surrogate"] for r in got}) == len(values) and not {r["surrogate"] for r in got} & set(values)
    new = pii.pseudonymise(spark.createDataFrame([(1, "to _@a.com"), (2, "to _@b.com")], "doc_id long, text string"), key).collect()
    assert len({r["text"] for r in new}) == 2 and all(re.fullmatch(r"to _@(\w+\.)?example\.org", r["text"]) for r in new)


def test_pii_names_of_one_person(spark):
    texts = ["Mr John Smith met Dr John Smith. Mr Smith's car. John Smith left, SMITH too; Smithson stayed", "Mr Łukasz Żak and Dr Παπαδόπουλος, Żak", "Dr Smith, Mr Paul Smith"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    new = [r["text"] for r in sorted(pii.pseudonymise(df, pii.demo_key("t"), count="n").collect())]
    m = re.fullmatch(r"Mr (\w+) (\w+) met Dr \1 \2\. Mr \2's car\. \1 \2 left, (\w+) too; Smithson stayed", new[0])
    assert m and m[1] in pii._GIVEN["latin", "m"] and m[3] == m[2].upper() and "Smith" not in m[2]
    n = re.fullmatch(r"Mr (\w+) (\w+) and Dr (\w+), \2", new[1])
    assert n and n[2] != "Żak" and n[3] != "Παπαδόπουλος" and pii._script(n[3]) == "greek"
    k = re.fullmatch(rf"Dr {m[2]}, Mr (\w+) {m[2]}", new[2])
    assert k and k[1] != m[1]


def test_pii_spaces_grow():
    for kind, value in (("email", "_@a.com"), ("phone", "1234567"), ("secret", "1-----------"), ("name.latin.m", "Smith")):
        sizes = [len(pii.surrogate(b"k", kind, value, a)) for a in (0, 8, 24, 48)]
        assert all(a < b for a, b in zip(sizes, sizes[1:]))
    assert pii.render("phone", "+1 23 45 67", "123456789") == "+1 23 45 6789"


def test_transducer_equals_the_library(edge, nothing):
    import sentencepiece
    data = Path(queries.TOKENIZER).read_bytes()
    ref, m = sentencepiece.SentencePieceProcessor(model_proto=data), wfst.compile_model(data)
    got = wfst.decode(wfst.encode(edge.select("doc_id", "text"), data, normal="normal"), data).collect()
    for r in got:
        assert r["ids"] == (None if r["text"] is None else ref.encode(r["text"])) and r["decoded"] == r["normal"]
    for t in ("\x00 a", "x" * 500, "<s> <0x41> ▁▁", "ﬁ　e"):
        assert m.encode(t) == ref.encode(t) and m.merge_path(m.normalise(t)) == m.shortest_path(m.normalise(t))
    assert wfst.encode(nothing.select("doc_id", "text"), data).count() == 0


def test_language_id(spark, edge, nothing):
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(common.documents(spark, "/root/testdata/sf0.01").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    model = langid.fit(spark, common.documents(spark, SF))
    rows = {r["doc_id"]: r for r in langid.predict(edge, model).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (0, 1, 2)) and 0 <= rows[7]["score"] <= 1
    assert langid.predict(nothing, model).count() == 0


def test_quality(spark, edge, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op7_quality_classifier(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9
    stats = quality.with_statistics(common.documents(spark, SF))
    model = queries.quality_model(spark, SF, stats)
    scores = quality.score(quality.with_statistics(edge), model).collect()
    assert len(scores) == edge.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.score(quality.with_statistics(nothing), model).count() == 0


def test_neighbours(spark):
    common.prepare(spark)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [None] + [1.0] * 7)] + [(700 + i, [3.0] * 8) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", 20).toPandas()
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = m @ m[ids == q][0]
        best = [i for _, i in sorted((-a, i) for a, i in zip(s, ids) if i != q)][:20]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        hit, total = hit + len(set(best) & set(mine["vec_id"])), total + 20
    assert hit / total >= 0.9 and not set(got["query_id"]) & {900, 901, 902, 903}
    assert ann.search(df.where("vec_id >= 900"), df, "vec_id", "embedding").count() == 0


def test_packed_answers_meet_their_keys(spark, edge):
    chunked = packed.chunks(edge)
    n = 5
    back = packed.answer(packed.ask(chunked, n, lm._question), n, np.uint32, lm._total)
    assert chunked.join(back, "cid").count() == chunked.where("n_words > 0").count()


def test_pipeline_on_a_small_corpus(spark):
    import corpus_pipeline
    docs = common.documents(spark, SF)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.scratch(stage(spark, docs, SF), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == docs.count() > 50 and all(r["round_trip"] for r in last)


def test_pipeline_near_duplicates_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in common.documents(spark, SF).collect()]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1]), (rows[3][0], PROSE), (rows[3][0], PROSE + "and then home"), (5, "too short"), (5, "too short"), (5, "short"), (7, None), (7, None), (None, PROSE), (None, PROSE)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sets, group, want = [shingle_set(t, 5) for _, t in rows], list(range(len(rows))), []
    for i, (a, x) in enumerate(rows):
        for j in range(i) if a is not None else ():
            same = len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]) if sets[i] and sets[j] else not sets[i] and not sets[j] and rows[i] == rows[j]
            if rows[j][0] is not None and same and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    for g in set(group):
        want.append(min((r for r, h in zip(rows, group) if h == g), key=lambda r: -1 if r[0] is None else r[0])[0])
    got = pipeline.near_duplicate_stage(spark, df, SF)
    assert got.columns == df.columns
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in got.collect())
