"""License scans: a positional rare-token index over licence notices, in DataFrame operations.

1. The notices (TEMPLATES, or a table of the caller's) become postings (word, template, offset).
2. One pass over the corpus counts the documents that hold each notice word; idf = log((n + 1) / (df + 1)).
3. A template matches only where all its mandatory phrases stand. So of a file's words, those are looked up that have the highest idf of
   some template's mandatory words, all of which the file holds; a place of one votes for (template, place - offset).
4. There the template's other postings are intersected with the file's words by relative position. The score is the share of
   the template's idf weight that stands at its place; the template is reported at MATCH or more, if all its mandatory key
   phrases stand at their places.

The notices are literals of the plan, bounded by their table (some 200 words here) whatever the corpus holds.

Edge cases: null and empty texts have no words, labels are empty and score 0; of words with equal idf a template's first is looked up; of
equal scores all are reported, the greatest label first; texts of any length are searched whole; repeated rows are answered each; an
empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import MARKS, lower_ascii, words

#: label: (notice, mandatory key phrases, each as it stands in the notice).
TEMPLATES = {
    "agpl": ("licensed under the gnu affero general public license version 3", ("affero general public license",)),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    "cc-by": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
    "cc-by-nc-sa": ("licensed under cc by nc sa 4 0", ("cc by nc sa",)),
    "cc-by-sa": ("licensed under cc by sa 4 0", ("cc by sa",)),
    "gpl-2.0": ("this work is licensed under the gnu general public license version 2", ("general public license", "version 2")),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("general public license", "version 3")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute",)),
    "lgpl": ("licensed under the gnu lesser general public license version 3", ("lesser general public license",)),
    "mit": ("released under the mit license", ("mit license",)),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "proprietary": ("all rights reserved no part may be reproduced without written permission", ("all rights reserved",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
}
#: Phrases that the contract counts, with their labels.
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
MATCH = 0.75


def anchors(templates: dict, counts: dict[str, int]) -> list[str]:
    """Few and rare words of which every base phrase, and the mandatory words of every template, hold one: files without any have nothing to find."""
    rest = [set(p) for p in BASE] + [{w for key in keys for w in key.split()} for _, keys in templates.values()]
    found = []
    while rest:
        found.append(max(sorted(set().union(*rest)), key=lambda w: sum(w in p for p in rest) / (counts.get(w, 0) + 1)))
        rest = [p for p in rest if found[-1] not in p]
    return found


def _places(notice: str, phrase: str) -> range:
    """The places in the notice at which the phrase's words stand."""
    n, p = notice.split(), phrase.split()
    start = next(i for i in range(len(n)) if n[i : i + len(p)] == p)
    return range(start, start + len(p))


def _tokens():
    return words(lower_ascii(F.col("text")), MARKS)


def document_counts(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each notice word."""
    held = F.array_distinct(F.filter(_tokens(), lambda x: x.isin(vocabulary)))
    rows = docs.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def scan(docs: DataFrame, templates: dict = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, base: places of base phrases, found: array of (label, score, start), best first)."""
    vocabulary = sorted({w for notice, _ in templates.values() for w in notice.split()} | {w for p in BASE for w in p})
    n, counts = document_counts(docs.select("text"), vocabulary)
    idf = {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6 for w in vocabulary}
    weights = {(name, o): (w, idf[w]) for name, (notice, _) in templates.items() for o, w in enumerate(notice.split())}
    totals = {name: sum(idf[w] for w in notice.split()) for name, (notice, _) in templates.items()}
    rarest: dict[str, list[tuple[str, int]]] = {}
    for name, (notice, keys) in templates.items():
        o = max((i for key in keys for i in _places(notice, key)), key=lambda i: (weights[(name, i)][1], -i))
        rarest.setdefault(weights[(name, o)][0], []).append((name, o))

    t = docs.select("doc_id", F.col("text"))
    likely = F.coalesce(F.col("text").rlike(r"(?i)(?<![^\x00-\x2F\x3A-\x60\x7B-\x7F])(" + "|".join(anchors(templates, counts)) + r")(?![^\x00-\x2F\x3A-\x60\x7B-\x7F])"), F.lit(False))
    # Words are counted in all texts; only texts with an anchor word are looked into.
    t = t.select("doc_id", "text", likely.alias("likely")).select(
        "doc_id",
        F.when(F.col("likely"), F.size(_tokens())).otherwise(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))).cast("long").alias("n_words"),
        F.when(F.col("likely"), _tokens()).otherwise(F.array().cast("array<string>")).alias("w"),
    )

    places = F.filter(F.transform("w", lambda x, i: F.when(x.isin(vocabulary), F.struct(i.alias("i"), x.alias("x")))), lambda x: x.isNotNull())
    t = t.withColumn("places", places)
    index = F.create_map(
        *[x for w, ps in rarest.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(a).alias("label"), F.lit(o).alias("o")) for a, o in ps]))]
    )
    looked = F.filter("places", lambda p: p["x"].isin(sorted(rarest)))
    votes = F.flatten(F.transform(looked, lambda p: F.transform(F.element_at(index, p["x"]), lambda q: F.struct(q["label"].alias("label"), (p["i"] - q["o"]).alias("start")))))
    cands = F.filter(votes, lambda v: v["start"] >= 0)

    def score(c):
        """The share of the template's weight that stands where it should, or null without its key phrases."""
        value = F.lit(None).cast("double")
        for name, (notice, keys) in templates.items():
            tokens = notice.split()
            same = F.lit(0.0)
            for o, word in enumerate(tokens):
                same = same + F.when(F.coalesce(F.get("w", c["start"] + o) == word, F.lit(False)), F.lit(weights[(name, o)][1] / totals[name])).otherwise(0.0)
            must = F.lit(True)
            for key in keys:
                for i in _places(notice, key):
                    must = must & F.coalesce(F.get("w", c["start"] + i) == tokens[i], F.lit(False))
            value = F.when((c["label"] == name) & must, same).otherwise(value)
        return value

    found = F.transform(cands, lambda c: F.struct(score(c).alias("score"), c["label"].alias("label"), c["start"].alias("start")))
    t = t.withColumn("found", F.filter(found, lambda f: F.coalesce(f["score"] >= MATCH, F.lit(False))))
    starts = F.transform("places", lambda p: p["i"])
    base = F.transform(starts, lambda i: F.struct(i.alias("start"), _base_label(i).alias("label")))
    return t.select("doc_id", "n_words", F.filter(base, lambda b: b["label"].isNotNull()).alias("base"), F.sort_array(F.array_distinct("found"), asc=False).alias("found"))


def _base_label(i):
    label = F.lit(None).cast("string")
    for phrase, name in BASE.items():
        cond = F.lit(True)
        for k, word in enumerate(phrase):
            cond = cond & F.coalesce(F.get("w", i + k) == word, F.lit(False))
        label = F.when(cond, name).otherwise(label)
    return label


def query(docs: DataFrame) -> DataFrame:
    starts = F.transform("base", lambda b: b["start"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    both = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda b: b["label"]), F.transform("found", lambda f: f["label"]))))
    return scan(docs).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce(F.get("found", F.lit(0))["score"], F.lit(0.0))).alias("score"),
    )
