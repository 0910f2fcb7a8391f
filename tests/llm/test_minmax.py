"""Work of the near-duplicate groups on a large group of near copies."""

import random

from kensa.llm import common, minmax


def test_links_of_a_large_group_follow_its_size(spark, monkeypatch):
    """Near copies share many buckets: what is joined to find components stays a few links a class."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(120), 4):
            words[at] = f"x{i}-{at}"
        texts.append((i, " ".join(words)))
    texts.append((300, "another text of its own"))
    given, smallest_labels = [], common.smallest_labels
    monkeypatch.setattr(common, "smallest_labels", lambda links, *ends: given.append(links.count()) or smallest_labels(links, *ends))
    got = minmax.groups(spark.createDataFrame(texts, "doc_id long, text string"), k=2).collect()

    sets = [{tuple(w[j:j + 2]) for j in range(len(w) - 1)} for w in (t.split() for _, t in texts)]
    component = list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = sorted((component[a], component[b]))[::-1]
                component = [new if c == old else c for c in component]
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(component))
    assert sum(given) <= 5 * len(texts), given


def test_joined_components(spark):
    """Links between components known so far bring all their members along."""
    links = lambda *rows: spark.createDataFrame(list(rows), "a long, b long")
    found = minmax._joined(None, links((1, 2), (2, 3), (5, 6), (8, 9)))
    assert {tuple(r) for r in found.collect()} == {(2, 1), (3, 1), (6, 5), (9, 8)}
    assert minmax._joined(found, links((1, 2)).limit(0)) is found
    more = minmax._joined(found, links((3, 6), (7, 9), (10, 11)))
    assert {tuple(r) for r in more.collect()} == {(2, 1), (3, 1), (6, 1), (5, 1), (9, 7), (8, 7), (11, 10)}
