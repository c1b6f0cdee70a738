"""Operators against brute-force versions, round trips and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows_of

from siltstone.llm import boosting, compression, decontamination, jaccard, language_model, languages, licenses, packing, pii, rules, toxicity
from siltstone.llm.queries import oracle_sql, queries, tokenizer_json


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, sf_dir, duck, name):
    assert rows_of(queries()[name](spark, sf_dir)) == rows_of(duck.sql(oracle_sql()[name]).df())


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


# op1


def test_language_model_base(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in queries()["op1_language_model"](spark, sf_dir).collect()}
    tokens = {i: [*t.encode().lower().split(), b""] for i, t in texts}
    train = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    for i, ws in tokens.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(w in train for w in ws), n, zlib.crc32(str(i).encode()) % 10 == 0)
        assert math.isclose(r["base_score"], sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # the contexts help on unseen texts


def test_language_model_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, " ".join(random.Random(i).choices("a b c d e f".split(), k=20))) for i in range(30)], "doc_id long, text string")
    blobs = language_model.pack_tokens(docs, 1, {}).where("bucket IS NOT NULL").toPandas()
    b = language_model.Bucket(blobs, [])
    customers = np.bincount(b.context, b.customers, language_model.CLASSES + 1).astype(float)
    s = language_model.Seating(b, 0, 0.5, 0.5, np.zeros_like(customers), customers, (1.0, 1.0, int((b.counts > 0).sum())), np.zeros(0))
    for _ in range(3):
        s.sweep()
        s.tables = np.bincount(b.context, s.contexts.t, language_model.CLASSES + 1).astype(float)
        s.root_customers, s.root_tables = float(s.contexts.t.sum()), float(s.root.t.sum())
        known = b.counts > 0
        assert math.isclose(s.p_word()[known].sum() + s.root_mass() / (language_model.ROOT_THETA + s.root_customers), 1, rel_tol=1e-9)
        assert ((s.contexts.t >= (b.customers > 0)) & (s.contexts.t <= b.customers)).all()
        m = int(customers.argmax())
        p = s.p_word()
        seen = (b.context == m) & (b.customers > 0)
        back = (language_model.THETA + 0.5 * s.tables[m]) / (language_model.THETA + customers[m])
        total = ((b.customers - 0.5 * s.contexts.t)[seen] / (language_model.THETA + customers[m])).sum() + back * (p[known].sum() + s.root_mass() / (language_model.ROOT_THETA + s.root_customers))
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_samples_of_all_buckets_sum_to_one(spark):
    """In each sample, as the operator takes it, each context's probabilities of all words and the unknown one; with frequent words."""
    r = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join(r.choices(["the", *(f"w{k}" for k in range(300))], [300, *[1] * 300], k=200))) for i in range(40)], "doc_id long, text string")
    hot = language_model.hot_words(docs)
    packed = language_model.pack_tokens(docs, 8, hot).where("bucket IS NOT NULL").cache()
    model = spark.sparkContext.broadcast(language_model.totals(packed, 8, hot))
    own = language_model.sample_totals(packed.drop("places", "size"), model)
    seatings = [language_model.seated(g, model.value) for _, g in packed.toPandas().groupby("bucket")]
    customers, words = model.value["customers"], model.value["root"][2]
    d, root_d = model.value["d"], model.value["root_d"]
    assert len(hot) == 2 and len(seatings) == 8
    for k, _ in enumerate(zip(*[s.samples() for s in seatings], strict=True)):
        root_customers, root_tables = own[k]["root"]
        unknown = (language_model.ROOT_THETA + root_d * root_tables) / (words + 1) / (language_model.ROOT_THETA + root_customers)
        parent = unknown + own[k]["p_hot"].sum()
        total = np.zeros(language_model.CLASSES + 1)
        for s in seatings:
            known = s.b.counts > 0
            known[s.b.hot] = False
            parent += (s.root.c[known] - root_d * s.root.t[known]).sum() / (language_model.ROOT_THETA + root_customers) + unknown * known.sum()
            p, seen = s.predictive(own[k]), s.b.customers > 0
            rest = s.root.c - root_d * s.root.t
            p_word = rest / (language_model.ROOT_THETA + root_customers) + unknown
            p_word[s.b.hot] = own[k]["p_hot"][s.b.hot_index]
            back = (language_model.THETA + d * own[k]["tables"][s.b.context]) / (language_model.THETA + customers[s.b.context])
            total += np.bincount(s.b.context[seen], (p - back * p_word[s.b.word])[seen], len(total))
        assert math.isclose(parent, 1, rel_tol=1e-9)
        whole = total + (language_model.THETA + d * own[k]["tables"]) / (language_model.THETA + customers)
        assert np.allclose(whole, 1, rtol=1e-9), (whole.min(), whole.max())
        frozen = total + (language_model.THETA + d * model.value["tables"]) / (language_model.THETA + customers)
        assert not np.allclose(frozen, 1, rtol=1e-3)  # the first seating's totals wouldn't do


def test_frequent_words_are_dealt_out(spark):
    r = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(r.choices(["the", *(f"w{k}" for k in range(300))], [300, *[1] * 300], k=200))) for i in range(40)], "doc_id long, text string")
    hot = language_model.hot_words(docs)
    assert set(hot) == {b"the", b""}
    blobs = language_model.pack_tokens(docs, 8, hot).where("bucket IS NOT NULL").toPandas()
    held = [language_model.Bucket(g, list(hot)) for _, g in blobs.groupby("bucket")]
    assert sum(len(b.hot) > 0 for b in held) == 8 and sum(len(b.of) for b in held) == 40 * 201
    given = language_model.totals(language_model.pack_tokens(docs, 8, hot).where("bucket IS NOT NULL"), 8, hot)
    train = Counter(w for x in docs.collect() if not language_model.held_out(str(x["doc_id"])) for w in language_model.tokens_of(x["text"]))
    assert dict(zip(given["hot"], given["hot_counts"].tolist(), strict=True)) == {w: train[w] for w in hot} and given["root"][2] == len(train) and given["tokens"] == sum(train.values())
    rows = {x["doc_id"]: x for x in language_model.score(docs).collect()}
    for x in docs.collect():
        base = sum(math.log10((train[w] + 0.1) / (sum(train.values()) + 0.1 * (len(train) + 1))) for w in language_model.tokens_of(x["text"]))
        assert math.isclose(rows[x["doc_id"]]["base_score"], base, rel_tol=1e-9)


def test_frequent_words_are_those_of_all_texts(spark):
    """Also where a third of the rows is one text, and far more rows than any sample would hold."""
    r = random.Random(7)
    texts = ["Spam spam buy"] * 2000 + [" ".join(r.choices(["the", *(f"w{k}" for k in range(3000))], [200, *[1] * 3000], k=12)) for _ in range(3999)] + [None]
    r.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = Counter(w for t in texts for w in language_model.tokens_of(t))
    total = counts.total()
    want = {w: n / total for w, n in counts.items() if n >= total / language_model.HOT}
    assert set(want) == {b"spam", b"buy", b"the", b""} and language_model.hot_words(docs) == want
    assert language_model.hot_words(docs.limit(0)) == {b"": 1.0}


def test_stirling_shares():
    """S(3, 2) with discount d is 3 (1 - d) and S(2, 1) = 1 - d, so a customer of three at two tables sits alone with 1/3."""
    a = language_model.alone(0.3)
    assert math.isclose(a[3, 2], 1 / 3) and math.isclose(a[2, 2], 1) and math.isclose(a[2, 1], 0, abs_tol=1e-12)


@pytest.mark.parametrize("c", [5, 200, 1000])
def test_a_sweep_seats_all_customers(c):
    """One sweep, from any seating, gives the mean and spread of S(c, t) a^t."""
    for d in (0.3, 0.8):
        log = np.full(c + 1, -np.inf)
        log[0] = 0
        with np.errstate(divide="ignore"):
            for k in range(1, c + 1):
                log[1:] = np.logaddexp(log[:-1], np.log(np.maximum(k - 1 - d * np.arange(1, c + 1), 0)) + log[1:])
                log[0] = -np.inf
        for a in (0.01, 1.0, 20.0, 300.0):
            p = log[1:] + math.log(a) * np.arange(1, c + 1)
            p = np.exp(p - p.max())
            p /= p.sum()
            mean = p @ np.arange(1, c + 1)
            spread = math.sqrt(p @ (np.arange(1, c + 1) - mean) ** 2)
            level = language_model.Level(np.full(20_000, c), d, np.random.default_rng(1), np.full(20_000, a))
            level.t[:] = c
            level.sweep(np.full(20_000, a))
            assert abs(level.t.mean() - mean) < 0.05 * mean + 0.05 and abs(level.t.std() - spread) < 0.15 * spread + 0.1, (c, d, a, mean, spread)


# op2


def test_rules_base(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in queries()["op2_quality_rules"](spark, sf_dir).collect()}
    for i, t in texts:
        words, r = re.findall(r"[^\x20\x09-\x0D]+", t), rows[i]
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        hit = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lines, seen, dup = t.split("\n"), set(), 0
        for x in lines:
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed)
        assert not (failed and r["kept"])


def test_rules_find_planted_accuracies():
    r = np.random.default_rng(1)
    good = r.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.85])
    votes = np.where(r.random((20_000, 5)) < right, 1, -1) * np.where(good, 1, -1)[:, None] * (r.random((20_000, 5)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, table = rules.fit(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03 and np.abs(table[1, :, 2] / (table[1, :, 2] + table[1, :, 0]) - right).max() < 0.03
    p = rules.posterior(votes, share, table)
    assert ((p > 0.5) == good).mean() > 0.95


# op3, op4, op5


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable")) + 1
    n = int(y.sum())
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.85), ("op5_compression_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries()[name](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    y = np.array([labels[r["doc_id"]] for r in rows])
    assert auc(np.array([r["score"] for r in rows]), y) > least
    assert np.mean([r["predicted"] for r in rows] == y) > least and all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_languages(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries()["op4_language"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.97


def test_ngram_counts_do_not_cross_texts():
    both, one = languages.count(["ab", "cd"]), languages.count(["ab"])
    assert (both[0] == one[0]).all() and both.sum() == one.sum() + languages.count(["cd"]).sum() and languages.count(["12 !"]).sum() == 0


def test_obfuscated_words_are_unmasked():
    m = toxicity.Measure({"idiot": 5.0, "stu-": 4.0})
    at = dict(zip(toxicity.FEATURES, range(len(toxicity.FEATURES)), strict=True))
    for text in ("you 1d1ot", "an id1ot!", "such an id*ot", "i d i o t", "i.d.i.o.t", "idiooooot"):
        assert m(text)[at["obfuscated_hits"]] == 1, text
    x = m("You IDIOT, stupid")
    assert x[at["hits"]] == 2 and x[at["hits_near_second"]] == 2 and x[at["upper_hits"]] == 1 and m("")[at["hits"]] == 0


def test_isotonic_and_trees():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    p = boosting.sigmoid(2 * x[:, 0] - x[:, 1] ** 2)
    y = (r.random(3000) < p).astype(float)
    m = boosting.Calibrated().fit(x[:2000], y[:2000], np.ones(2000))
    s = m.score(x[2000:])
    assert auc(s, y[2000:]) > 0.8 and abs(s.mean() - y[2000:].mean()) < 0.05 and (np.diff(m.value) >= 0).all()
    assert (boosting.Calibrated().fit(x[:5], y[:5], np.ones(5)).score(x) == y[:5].mean()).all()


def test_dictionaries_tell_texts_apart():
    r = random.Random(2)
    make = lambda words, n: [" ".join(r.choices(words, k=60)).encode() for _ in range(n)]
    import zstandard

    good, bad = (zstandard.train_dictionary(4096, make(w.split(), 300)).as_bytes() for w in ("alpha beta gamma delta epsilon zeta", "one two three four five six seven"))
    difference = compression.Difference(good, bad)
    assert difference("alpha gamma beta zeta " * 3) > 0 > difference("one three two seven " * 3) and difference(None) == difference("") == 0


def test_compression_against_brute_force(spark):
    """The scores are those of the dictionaries' own library, calibrated by a plain isotonic regression; ties score alike."""
    import zstandard

    r = random.Random(4)
    make = lambda words: " ".join(f"{w}{r.randrange(30)}" for w in r.choices(words.split(), k=r.randint(5, 60)))
    rows = [(i, make("alpha beta gamma delta epsilon zeta") if i % 3 else make("one two three four five six seven"), int(i % 3 > 0)) for i in range(900)]
    docs, labels = spark.createDataFrame([x[:2] for x in rows] + [(900, rows[0][1])], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    good, bad, calibration = compression.fit(docs, labels, compression.F.lit(True))
    size = lambda t, d: len(zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(d)).compress(t.encode()))
    got = {x["doc_id"]: x["score"] for x in docs.select("doc_id", compression.scorer((good, bad, calibration))("text").alias("score")).collect()}
    numbers = {i: (size(t, bad) - size(t, good)) / len(t.encode()) for i, t, _ in rows}
    assert got[0] == got[900]
    for i, x in numbers.items():
        assert math.isclose(got[i], 0.99 * float(np.interp(x, calibration.at, calibration.value)) + 0.01 / (1 + math.exp(-x / calibration.scale)), rel_tol=1e-9)
    order = sorted(numbers, key=numbers.get)
    assert all(got[a] <= got[b] for a, b in zip(order, order[1:], strict=False))
    assert np.mean([(got[i] > 0.5) == q for i, _, q in rows]) > 0.98
    held, y = np.array([0.3, 0.1, 0.2, 0.5, 0.4]), np.array([0.0, 0.0, 1.0, 1.0, 1.0])
    assert boosting.isotonic(held, y, np.ones(5))[1].tolist() == [0, 0.5, 1, 1] or boosting.isotonic(held, y, np.ones(5))[1].tolist() == [0, 0.5, 1]


# op6


def brute_components(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def shingled(t):
    w = [x.lower() if x.isascii() else x for x in (t or "").split()]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_linked_sets_share_a_signature():
    """Pairs right at the threshold, of all sizes."""
    r = np.random.default_rng(7)
    for _ in range(400):
        n = int(r.integers(1, 300))
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        d = int(r.integers(0, 2 * len(a) // 9 + 1))
        drop = int(r.integers(0, d + 1))
        b = np.unique(np.concatenate([r.permutation(a)[min(drop, len(a)) :], r.integers(0, 2**63, d - drop).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            owner, sign = jaccard.signatures([a, b])
            assert set(sign[owner == 0].tolist()) & set(sign[owner == 1].tolist())
            assert jaccard.differing_bits(jaccard.sketch(a), jaccard.sketch(b)) <= len(a) + len(b) - 2 * common


def test_components_of_near_copies(spark):
    """Large groups of near copies that drift, groups with a common passage, and short texts."""
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    base, passage = [word() for _ in range(120)], [word() for _ in range(40)]
    texts = []
    for _ in range(60):
        base = base.copy()
        base[r.randrange(120)] = word()
        texts.append(" ".join(base))
    texts += [" ".join([word() for _ in range(r.randint(10, 60))] + passage + [word() for _ in range(r.randint(10, 60))]) for _ in range(60)]
    texts += ["a b c", "A B C", "a b", "a b c d e f", "a b c d e f g", "", None, "x"] + texts[:20]
    r.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard.query(docs).orderBy("doc_id").collect()
    sets = [shingled(t) for t in texts]
    assert [x["n_shingles"] for x in rows] == [len(s) for s in sets]
    assert [x["component_id"] for x in rows] == brute_components(sets)
    kept = {x["doc_id"] for x in jaccard.deduplicate(docs).collect()}
    assert kept == {i for i, c in enumerate(brute_components(sets)) if c == i}


# op7


def test_licenses(spark):
    rows = {
        1: "Released under the MIT License.", 2: "x " * 50 + "This work is licensed under the GNU General Public License, version 3. y", 3: "Licensed under CC BY-NC 4.0.", 4: "no licence at all", 5: "mit licenses", 6: "Apache License. MIT license",
        7: "Licensed under the Apache License, Version 2.0 and LICENSED UNDER THE GNU LESSER GENERAL PUBLIC LICENSE version 3", 8: "mit-license",
    }
    got = {r["doc_id"]: r for r in licenses.query(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert (got[1]["base_labels"], got[1]["labels"], got[1]["first_word"], got[1]["score"]) == ("mit", "mit", 3, 1.0)
    assert got[2]["labels"] == "gpl,gpl-3.0" and got[2]["first_word"] == got[2]["last_word"] == 57
    assert got[3]["labels"] == "cc-by-nc" and got[3]["n_base"] == 0 and got[4]["labels"] == "" and got[5]["n_base"] == 0
    assert (got[6]["base_labels"], got[6]["n_base"], got[6]["first_word"], got[6]["last_word"]) == ("apache,mit", 2, 0, 2) and got[8]["n_base"] == 1
    assert got[7]["labels"] == "apache,apache-2.0,gpl,lgpl"


def test_licenses_against_brute_force(spark):
    """All templates at all places of texts made of notices, whole, cut and with words replaced."""
    r = random.Random(12)
    notices = [t.split() for t, _ in licenses.TEMPLATES.values()]
    texts = []
    for _ in range(200):
        text = []
        for _ in range(r.randint(0, 3)):
            part = list(r.choice(notices))
            for _ in range(r.randint(0, 2)):
                part[r.randrange(len(part))] = r.choice(["x", "license", "public"])
            text += part[: r.randint(3, len(part) + 5)] + r.choices(["y", "general", "license"], k=r.randint(0, 3))
        texts.append(text)
    idf = {w: math.log(201 / (sum(w in t for t in texts) + 1)) + 1e-6 for n in notices for w in n}
    want = {}
    for i, t in enumerate(texts):
        found = set()
        for name, (notice, keys) in licenses.TEMPLATES.items():
            v = notice.split()
            places = {o for key in keys for o in licenses._places(notice, key)}
            for k in range(len(t)):
                same = [k + o < len(t) and t[k + o] == w for o, w in enumerate(v)]
                share = sum(idf[w] for w, s in zip(v, same, strict=True) if s) / sum(idf[w] for w in v)
                if all(same[o] for o in places) and share >= licenses.MATCH:
                    found.add((name, k, round(share, 9)))
        want[i] = sorted(found)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x["doc_id"]: sorted((f["label"], f["start"], round(f["score"], 9)) for f in x["found"]) for x in licenses.scan(docs).collect()}
    assert got == want and sum(map(len, want.values())) > 50


def test_license_base_counts(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in queries()["op7_license_scan"](spark, sf_dir).collect()}
    for i, t in texts:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t))
        hits = sorted((k, name) for k in range(len(w)) for p, name in licenses.BASE.items() if tuple(w[k : k + len(p)]) == p)
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(hits), ",".join(sorted({n for _, n in hits})))
        assert (r["first_word"], r["last_word"]) == ((hits[0][0], hits[-1][0]) if hits else (None, None))


# op8


def test_packing_round_trip(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    source = tokenizer_json()
    tokenizer = Tokenizer.from_str(source)
    extra = [(-1, None), (-2, "<|endoftext|> x"), (-3, "русский 中文  "), (-4, "z" * 5000)]
    docs = spark.createDataFrame(texts + extra, "doc_id long, text string")
    rows = packing.pack(docs, source).collect()
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for i, t in texts + extra:
        want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        got = sorted(pieces[i], key=lambda r: r["start"])
        assert np.frombuffer(b"".join(r["ids"] for r in got), "<u4").tolist() == want
        assert [r["start"] for r in got] == np.cumsum([0, *[r["length"] for r in got][:-1]]).tolist() and {r["doc_tokens"] for r in got} == {len(want)}
    padding = 0
    for rs in bins.values():
        rs.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in rs)
        assert [r["offset"] for r in rs] == np.cumsum([0, *[r["length"] for r in rs][:-1]]).tolist() and total <= 1024
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    assert set(bins) == set(range(len(bins))) and padding < 0.03 * 1024 * len(bins)
    crcs = {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in rows}
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.query(docs, source).collect()} == crcs


def test_quick_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    source = tokenizer_json()
    quick, exact = packing.Encoder(source).quick, Tokenizer.from_str(source)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1 '{chr(c)}s\n{chr(c)} " for c in range(0x250)] + ["I'll we've  it's\n\n x ", " \t\n a1b22 c"]
    assert [quick.encode_ordinary(t) for t in texts] == [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]


def test_cuts():
    lengths = packing.class_lengths()
    for n in range(1, 5000):
        c = packing.cut(n, lengths)
        assert sum(c) == n and set(c) <= set(lengths) and len(c) <= n // 1024 + 5


# op9

PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in PATTERNS[0].finditer(t)]
    out += [(m.start(), 1, m.end()) for m in PATTERNS[1].finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in PATTERNS[2].finditer(t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    return sorted(out + [(m.start(), 3, m.end()) for m in PATTERNS[3].finditer(t) if 10 <= len(re.findall("[0-9]", m.group())) <= 15])


def test_pii_base(spark, sf_dir, texts):
    r = random.Random(3)
    for _ in range(4000):
        t = "".join(r.choice("a1.@+-( )0 9%") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(t) == brute_spans(t)
    rows = {x["doc_id"]: x for x in queries()["op9_pii"](spark, sf_dir).collect()}
    for i, t in texts:
        spans = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in brute_spans(t)]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest() and set(spans) <= set(filter(None, rows[i]["spans"].split(",")))


def test_skip_edges_carry_labels():
    """A token that is a secret by its cue is one where it stands without a cue, far away."""
    r = random.Random(4)
    key = lambda: "".join(r.choices("0123456789abcdef", k=40))
    train = []
    for _ in range(200):
        k, other = key(), key()
        train.append(f'some words token = "{k}" and then many other words in between them {k} 12 of 7 and 3. {r.randint(0, 99)}')
        train.append(f"a checksum {other} and many words, among them once more {other} of 5")
    weights = pii.train([pii.graph(t, pii.base_spans(t)) for t in train])
    k, far = key(), "plain words " * 200
    alone = pii.marginals([pii.graph(f"{far} {k} words", [])], weights)[0][5]
    t = f'token = "{k}" {far} {k}'
    cued, repeated = pii.marginals([pii.graph(t, [])], weights)[:, 5]
    assert alone < 0.5 < repeated and cued > 0.9  # the distant cue decides
    assert [x[1] for x in pii.find([t, f"{far} {k}"], weights)[0]] == [4, 4] and not pii.find([f"{far} {k}"], weights)[0]


def test_repeated_tokens_hear_of_a_distant_cue():
    """All of 50 repeats, wherever the cue stands; as many repeats without a cue are left alone; documents don't change each other."""
    r = random.Random(5)
    key = lambda: "".join(r.choices("0123456789abcdef", k=40))
    train = []
    for _ in range(200):
        k, other = key(), key()
        train.append(f'some words token = "{k}" and then many other words in between them {k} 12 of 7 and 3. {r.randint(0, 99)}')
        train.append(f"a checksum {other} and many words, among them once more {other} of 5")
    weights = pii.train([pii.graph(t, pii.base_spans(t)) for t in train])
    k, far = key(), "plain words " * 20
    texts = [f'token = "{k}" ' + f"{far} {k} " * 50, f"{far} {k} " * 25 + f'token = "{k}" ' + f"{far} {k} " * 25, f"{far} {k} " * 50, "", "1 2 3 " * 300]
    found = pii.find(texts, weights)
    assert [sum(x[1] == 4 for x in f) for f in found] == [51, 51, 0, 0, 0]
    assert found == [pii.find([t], weights)[0] for t in texts]


def test_marginals_on_a_chain_are_exact():
    """Without loops, messages give the sums over all labellings."""
    
    r = np.random.default_rng(5)
    weights = r.normal(size=(pii.WIDTH, 6)), r.normal(size=(3, 6, 6))
    g = pii.graph("a1 b22 c333 d4444", [])
    assert len(g[3]) == 3 and not len(g[4]) and not len(g[5])
    total = np.zeros((4, 6))
    for labels in itertools.product(range(6), repeat=4):
        score = sum(weights[0][g[1][i]].sum(0)[k] for i, k in enumerate(labels)) + sum(weights[1][0][labels[a], labels[b]] for a, b in g[3])
        for i, k in enumerate(labels):
            total[i, k] += np.exp(score)
    assert np.allclose(pii.marginals([g], weights), total / total.sum(1, keepdims=True), atol=1e-3)


def test_a_text_of_many_numbers(spark):
    """Learned from by a stretch, and worked on whole."""
    r = random.Random(9)
    text = " ".join(f"{r.randrange(10**9)}" for _ in range(60_000)) + " mail me@example.org"
    g = pii.graph(pii.stretch(text), [])
    assert 0 < len(g[0]) <= pii.SAMPLE_TOKENS
    docs = spark.createDataFrame([(1, text), (2, text), (3, "no 1")], "doc_id long, text string")
    rows = {x["doc_id"]: x for x in pii.query(docs).collect()}
    assert rows[1]["n_email"] == rows[2]["n_email"] == 1 and rows[1]["spans"] == rows[2]["spans"] and rows[3]["spans"] == ""


# op10


def test_decontamination_in_blocks(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(words, k=r.randint(0, 14)))) for i in range(30)] + [(30, None), (31, "w1"), (32, "...")]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 60))) + (" " + items[i % 30][1] if i % 3 == 0 else "")) for i in range(60)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in docs:
        w, hit, names = t.split(), set(), set()
        for n, text in items:
            v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text or "")
            for q in [v[k : k + 10] for k in range(max(1, len(v) - 9))] if v else []:
                for k in range(len(w) - len(q) + 1):
                    if w[k : k + len(q)] == q:
                        hit |= set(range(k, k + len(q)))
                        names.add(str(n))
        want[i] = (len(w), len(hit), sorted(names))
    for block in (10_000, 25):
        got = decontamination.find_matches(d, b, block=block).collect()
        assert {x["doc_id"]: (x["n_words"], len({p for h in x["hits"] for p in range(h["start"], h["start"] + h["n"])}), list(x["items"])) for x in got} == want


def test_proximity_matches(spark):
    """All places where 80 of 100 words agree, also with the rarest words replaced, or words that occur nowhere else."""
    r = random.Random(8)
    word = lambda: r.choice(["a", "b", "c", "d"]) if r.random() < 0.5 else f"w{r.randrange(60)}"
    items = [[word() for _ in range(r.choice([3, 5, 9, 10, 14, 25]))] for _ in range(25)]
    items[0][2] = "nowhere"
    docs = []
    for _ in range(150):
        text = [word() for _ in range(r.randint(0, 15))]
        for _ in range(r.randint(0, 3)):
            part = list(r.choice(items))
            for _ in range(r.randint(0, 3)):
                part[r.randrange(len(part))] = r.choice([word(), f"new{r.random()}".replace(".", "")])
            text += part + [word() for _ in range(r.randint(0, 4))]
        docs.append(text)
    windows = {tuple(v[k : k + 10]) for v in items for k in range(max(1, len(v) - 9))}
    want = {}
    for i, w in enumerate(docs):
        near = set()
        for v in windows:
            for k in range(len(w)):
                same = sum(a == b for a, b in zip(v, w[k:], strict=False))
                if 100 * same >= 80 * len(v) and same < len(v):
                    near.add((k, len(v)))
        want[i] = sorted(near)
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(v)) for i, v in enumerate(items)], "item_id long, text string")
    got = {x["doc_id"]: [(s["start"], s["n"]) for s in x["near"]] for x in decontamination.find_matches(d, b, block=90).collect()}
    assert got == want and sum(map(len, want.values())) > 50
