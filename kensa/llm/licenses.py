"""License scan: phrases, and an exact set-similarity join of text lines with notice templates.

Native: DataFrame functions only.  Words are maximal runs of ASCII letters,
digits and non-ASCII characters, A-Z lower-cased.  A block is a line of the
text, or, as notices are wrapped inside their sentences, any run of words a quarter
longer than the template, whatever lines it spans; it matches a template when it holds at least ``CONTAINMENT`` of the
template's distinct words.  All words of all templates are ranked by how many
documents hold them (rarest first).  A block can only match if it shares one of
the template's first ``|T| - need + 1`` words in that order (prefix filter), has
at least ``need`` template words (length filter) and, from the first shared
prefix word on, enough words left on both sides (positional filter); what passes
is verified by its full intersection.  Runs are looked at only where the whole text
holds enough template words and no line holds all of them, and only around the
template's prefix words.  ``NOTICES`` are longer customary wordings, found in runs;
as licences of one family differ in a word or two, these name the words that a run
must hold and must not.  The SQL of ``oracle`` knows lines and ``TEMPLATES`` only: it
finds the same but for wrapped notices and ``NOTICES``.  The templates are a fixed short list, so
their index is literals in the plan and documents are never shuffled.

Null text counts as empty: no words, no labels, score 0.  Very long texts,
repeated rows, null or repeated ids need nothing special, each row is judged by
itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTAINMENT = 0.9

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Customary notice sentences of public licences.
TEMPLATES = {
    "agpl-3.0": "gnu affero general public license version 3",
    "apache-2.0": "licensed under the apache license version 2.0",
    "bsd-3-clause": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-4.0": "licensed under a creative commons attribution 4.0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4.0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "lgpl-2.1": "gnu lesser general public license version 2.1",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "subject to the terms of the mozilla public license version 2.0",
}
# Longer wordings, words that must stand in them and words that must not.
NOTICES = {
    "agpl-3.0": ("under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", {"affero", "3"}, {"lesser"}),
    "cc-by-nc-4.0": ("licensed under a creative commons attribution noncommercial 4.0 international license", {"noncommercial", "4"}, {"sharealike", "noderivatives"}),
    "gpl-3.0": ("under the terms of the gnu general public license as published by the free software foundation either version 3 of the license", {"gnu", "3"}, {"affero", "lesser"}),
    "lgpl-2.1": ("under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license", {"lesser", "2", "1"}, {"affero"}),
}
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(templates: dict[str, str] = TEMPLATES) -> dict[str, list[str]]:
    return {k: sorted(set(v.replace(".", " ").split())) for k, v in templates.items()}


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _stands(parts: list[str]):
    def at(i: Column) -> Column:
        hit = F.lit(True)
        for j, p in enumerate(parts):
            hit = hit & F.coalesce(F.get("__w", i + j) == p, F.lit(False))
        return hit
    return at


def _split(text: Column) -> Column:
    return F.split(text, _BREAK)


def word_ranks(df: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES) -> list[str]:
    """All template words, those in the fewest documents first (ties by the word)."""
    vocabulary = sorted({w for ws in template_words(templates).values() for w in ws})
    held = df.select(F.explode(F.array_intersect(_split(F.lower(F.col(text))), _strings(vocabulary))).alias("w"))
    seen = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def scan(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: dict[str, str] = TEMPLATES,
         notices: dict[str, tuple[str, set, set]] = NOTICES) -> DataFrame:
    """``keep`` plus n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spoken = {f"{k} notice": v for k, (v, _, _) in notices.items()}
    ranked = word_ranks(df, text, templates | spoken)
    rank = {w: i for i, w in enumerate(ranked)}
    short = {w for ws in template_words(templates).values() for w in ws}
    order = [w for w in ranked if w in short]
    sets = {k: sorted(ws, key=rank.get) for k, ws in template_words(templates).items()}
    need = {k: math.ceil(CONTAINMENT * len(ws) - 1e-9) for k, ws in sets.items()}
    prefix = {k: ws[:len(ws) - need[k] + 1] for k, ws in sets.items()}
    said = {k: sorted(ws, key=rank.get) for k, ws in template_words(spoken).items()}
    enough = {k: math.ceil(CONTAINMENT * len(ws) - 1e-9) for k, ws in said.items()}
    ahead = {k: ws[:len(ws) - enough[k] + 1] for k, ws in said.items()}
    triggers = sorted({w for p in [*prefix.values(), *ahead.values()] for w in p} | {"license", "cc"})

    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(*keep, t.alias("__t")).withColumn("__w", _split(F.lower("__t")))
    ends = F.when(F.element_at("__w", 1) == "", 1).otherwise(0) + F.when((F.size("__w") > 1) & (F.element_at("__w", -1) == ""), 1).otherwise(0)
    rows = rows.select(*keep, (F.size("__w") - ends).cast("long").alias("n_words"),
                       F.when(F.arrays_overlap("__w", _strings(triggers)), F.translate("__t", _UPPER, _LOWER)).alias("__low"))
    # from here on __low is null but for the rows that hold a trigger word
    rows = rows.withColumn("__w", F.filter(_split(F.col("__low")), lambda x: x != ""))
    places = {}
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        start = F.when(F.array_contains("__w", parts[0]) & F.array_contains("__w", parts[-1]),
                       F.filter(F.sequence(F.lit(0), F.size("__w") - 1), _stands(parts)))
        places[label] = F.coalesce(start, F.array().cast("array<int>"))
    rows = rows.withColumns({f"__p_{k}": v for k, v in places.items()})
    every = F.concat(*[F.col(f"__p_{k}") for k in places])
    blocks = F.transform(F.split("__low", "\n"), lambda line: F.array_intersect(_strings(order), _split(line)))
    rows = rows.withColumn("__b", F.filter(blocks, lambda b: F.size(b) >= min(need.values())))

    def containment(k):
        words, ahead = _strings(sets[k]), _strings(prefix[k])

        def of(b):
            first = F.get(F.array_intersect(ahead, b), F.lit(0))
            left = 1 + F.least(len(sets[k]) - F.array_position(words, first), F.size(b) - F.array_position(b, first))
            passes = (F.size(b) >= need[k]) & F.arrays_overlap(b, ahead) & (left >= need[k])
            return F.when(passes, F.size(F.array_intersect(words, b)) / F.lit(float(len(sets[k])))).otherwise(0.0)

        return F.coalesce(F.array_max(F.transform("__b", of)), F.lit(0.0))

    def in_runs(words, first, least, wording, must=(), must_not=()):
        """The largest containment in any run of words; 0.0 if too few."""
        length = len(wording.replace(".", " ").split())
        length += length // 4
        all_words, few = _strings(words), F.lit(None).cast("double")

        def run(start):
            held = F.slice("__w", start + 1, length)
            ok = F.size(F.array_intersect(all_words, held)) >= least
            for w in sorted(must):
                ok = ok & F.array_contains(held, w)
            for w in sorted(must_not):
                ok = ok & ~F.array_contains(held, w)
            return F.when(ok, F.size(F.array_intersect(all_words, held)) / F.lit(float(len(words))))

        def around(i):
            lo = F.greatest(i - length + 1, F.lit(0))
            near = F.size(F.array_intersect(all_words, F.slice("__w", lo + 1, 2 * length))) >= least
            return F.when(near, F.array_max(F.transform(F.sequence(lo, i), run))).otherwise(few)

        places = F.filter(F.sequence(F.lit(0), F.size("__w") - 1), lambda i: F.get("__w", i).isin(first))
        whole = F.size(F.array_intersect(all_words, "__w")) >= least
        return F.coalesce(F.when(whole, F.array_max(F.transform(places, around))), F.lit(0.0))

    rows = rows.withColumns({f"__c_{i}": containment(k) for i, k in enumerate(sets)})
    rows = rows.withColumns({f"__r_{i}": F.when(F.col(f"__c_{i}") < 1.0, in_runs(sets[k], prefix[k], need[k], templates[k])).otherwise(F.lit(0.0)) for i, k in enumerate(sets)}
                            | {f"__n_{k}": in_runs(said[f"{k} notice"], ahead[f"{k} notice"], enough[f"{k} notice"], *notices[k]) for k in notices})
    rows = rows.withColumns({f"__c_{i}": F.greatest(f"__c_{i}", f"__r_{i}") for i in range(len(sets))})
    base = [F.when(F.size(f"__p_{k}") > 0, F.lit(k)) for k in places]
    own = [F.when(F.col(f"__c_{i}") >= need[k] / len(sets[k]) - 1e-9, F.lit(k)) for i, k in enumerate(sets)]
    own += [F.when(F.col(f"`__n_{k}`") > 0, F.lit(k)) for k in notices]
    join = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*xs)))), ",")
    best = F.greatest(*[F.when(F.col(f"__c_{i}") >= need[k] / len(sets[k]) - 1e-9, F.col(f"__c_{i}")).otherwise(0.0) for i, k in enumerate(sets)],
                      *[F.col(f"`__n_{k}`") for k in notices])
    return rows.select(*keep, "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                       join(base).alias("base_labels"), join(base + own).alias("labels"),
                       F.when(F.size(every) > 0, 1.0).otherwise(best).alias("score"))


def _duck_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def oracle() -> str:
    """The same result by brute force: every line against every template."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
    sets = template_words()
    values = ", ".join(f"('{k}', {_duck_list(ws)}, {math.ceil(CONTAINMENT * len(ws) - 1e-9)})" for k, ws in sets.items())
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low FROM documents),
w AS (SELECT doc_id, low, regexp_extract_all(low, {word}) AS w FROM d),
p AS (SELECT label, string_split(phrase, ' ') AS ps FROM (VALUES {phrases}) t(phrase, label)),
hits AS (SELECT doc_id, label, pos FROM (
    SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(ps)] = ps)) AS pos
    FROM w CROSS JOIN p WHERE list_contains(w, ps[1]))),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS ls FROM hits GROUP BY doc_id),
b AS (SELECT doc_id, list_distinct(regexp_extract_all(line, {word})) AS b FROM (SELECT doc_id, unnest(string_split(low, chr(10))) AS line FROM d)),
t AS (SELECT * FROM (VALUES {values}) v(name, ts, need)),
m AS (SELECT doc_id, list(DISTINCT name) AS ls, max(len(list_intersect(b, ts)) / len(ts)::DOUBLE) AS c FROM b CROSS JOIN t
      WHERE len(list_intersect(b, ts)) >= need GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       array_to_string(list_sort(coalesce(base.ls, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(m.ls, [])))), ',') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0.0) END AS DOUBLE) AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN m USING (doc_id)"""
