"""Near-duplicates, decontamination and license scans against brute force."""

import random

import numpy as np
import pytest
from conftest_llm import ODD, prose
from pyspark.sql import functions as F

from millrace.llm import decontaminate, license, neardup
from millrace.llm.shingles import shingle_hashes, word_hashes
from millrace.llm import shingles as shingles_module

TEXTS = "doc_id bigint, text string, lang string"


def words_of(text):
    words = ("".join(c for c in w if c.isalnum()) for w in (text or "").lower().split())
    return [w for w in words if w]


def runs(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def edited(text, n, seed):
    words, chance = text.split(), random.Random(seed)
    for k in chance.sample(range(len(words)), n):
        words[k] = f"new{seed}x{k}"
    return " ".join(words)


def test_hashes_of_words_and_shingles(monkeypatch):
    texts = [t for _, t, _ in ODD] + ["Don't stop, DON'T  stop. ", "a b c d e", "a b c d e f", "e d c b a"]
    hashes, counts = word_hashes(texts)
    assert counts.tolist() == [len(words_of(t)) for t in texts]
    parts = np.split(hashes, np.cumsum(counts)[:-1])
    number: dict = {}
    for text, got in zip(texts, parts, strict=True):
        for word, h in zip(words_of(text), got.tolist(), strict=True):
            assert number.setdefault(word, h) == h
    assert len(set(number.values())) == len(number)
    monkeypatch.setattr(shingles_module, "CHUNK_CHARS", 30)
    again, counts_again = word_hashes(texts)
    assert (again == hashes).all() and (counts_again == counts).all()
    hashes, counts = shingle_hashes(texts)
    for text, got in zip(texts, np.split(hashes, np.cumsum(counts)[:-1]), strict=True):
        assert len(set(got.tolist())) == len(runs(text))
    assert not set(shingle_hashes(["a b c d e"])[0]) & set(shingle_hashes(["e d c b a"])[0])


def test_samples_agree_as_often_as_texts_are_similar():
    base = prose(400, 5)
    other = edited(base, 12, 1)
    idf = np.random.default_rng(1).uniform(1, 8, 1 << neardup.FREQUENCY_BITS).astype(np.float32)
    hashes, weights, counts = neardup.weighted([base, other], idf)
    got = neardup.samples(hashes, weights, np.array([0, counts[0]]), 2000)
    real = neardup.similarities([base], [other], idf)[0]
    assert 0.6 < real < 0.9 and abs((got[0] == got[1]).mean() - real) < 0.04


def classes_by_force(docs, idf, least=0.8):
    ids = sorted({d for d, *_ in docs if d is not None})
    parent = {d: d for d in ids}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    known = [(d, t) for d, t, *_ in docs if d is not None and t is not None]
    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            if s == t or (runs(s) & runs(t) and neardup.similarities([s], [t], idf)[0] >= least):
                a_root, b_root = root(a), root(b)
                parent[max(a_root, b_root)] = min(a_root, b_root)
    return {d: root(d) for d in ids}


def test_classes_are_those_of_brute_force(rows):
    docs, n = [], 0
    for group in range(12):
        base = prose(150 + 20 * group, 100 + group)
        for copy in range(6):
            docs.append((n := n + 1, edited(base, copy * (1 + group % 3), 10 * group + copy), "en"))
        docs.append((n := n + 1, base, "en"))
    frame = rows(docs, TEXTS)
    idf = neardup.inverse_frequencies(frame, "text")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}
    want = classes_by_force(docs, idf)
    assert got == want and 12 < len(set(want.values())) < len(docs)


def test_chain_whose_members_are_no_copies_of_the_pivot(rows):
    """Each text is near the next one only: links that no pivot sees have to be found."""
    base = prose(300, 7).split()
    docs = []
    for k in range(10):
        words = list(base)
        for j in range(k * 4):
            words[j * 5 % 300] = f"step{j}"
        docs.append((k, " ".join(words), "en"))
    frame = rows(docs, TEXTS)
    idf = neardup.inverse_frequencies(frame, "text")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}
    assert got == classes_by_force(docs, idf)


def test_near_duplicates_of_odd_rows(odd, clashing, no_rows):
    for table in (odd, clashing):
        got = {r.doc_id: r.class_id for r in neardup.near_duplicates(table).collect()}
        assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9}
    assert neardup.near_duplicates(no_rows).count() == 0


def test_a_large_group_of_copies_makes_no_more_pairs_than_members(spark):
    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(prose(60, 3)).alias("text"))
    near = spark.range(3000, 3300).select("id", F.concat(F.lit(prose(120, 4) + " end"), F.col("id").cast("string")))
    got = neardup.near_duplicates(copies.union(near))
    assert sorted(r["count"] for r in got.groupBy("class_id").count().collect()) == [300, 3000]


def test_components_of_long_chains(spark, rows):
    links = [(k, k + 1) for k in range(60)] + [(100, 90), (200, 201), (201, 200)]
    got = {r.node: r.label for r in neardup.components(rows(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 90, 90: 90, 200: 200, 201: 200}


def contained_by_force(docs, items, least=0.8):
    out = {}
    for d, text, *_ in docs:
        for i, test in items:
            want = runs(test)
            n = len(want & runs(text))
            if want and n >= least * len(want) - 1e-9:
                out[d, i] = max(out.get((d, i), (0, 1)), (n, len(want)), key=lambda x: x[0] / x[1])
    return out


def found(docs, items):
    got = decontaminate.contaminated(docs, items).collect()
    assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
    return {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in got}


def test_items_inside_long_documents(rows):
    items = [(k, prose(n, 500 + k)) for k, n in enumerate([3, 5, 6, 9, 14, 20, 33, 60, 120, 300])]
    docs, n = [], 0
    for k, text in items:
        for where in (0, 7, 4000):
            around = prose(6000, 900 + k).split()
            docs.append((n := n + 1, " ".join([*around[:where], text.upper().replace(" ", ",  "), *around[where:]]), "en"))
        if len(text.split()) > 19:
            docs.append((n := n + 1, edited(text, 1, k) + " " + prose(500, k), "en"))
            half = len(text) // 2
            docs.append((n := n + 1, text[:half] + " " + prose(200, k + 1) + " " + text[half:], "en"))
            docs.append((n := n + 1, text[:half], "en"))
    docs.append((n + 1, " ".join(t for _, t in items), "en"))
    assert found(rows(docs, TEXTS), rows(items, "item_id bigint, text string")) == contained_by_force(docs, items)


def test_odd_documents_and_items(odd, clashing, no_rows, rows):
    items = [(1, None), (2, ""), (3, "one two"), (None, prose(40, 2)), (4, "..."), (5, prose(40, 2)), (5, "three four"), (5, "three four")]
    bench = rows(items, "item_id bigint, text string")
    want = contained_by_force(ODD, items)
    assert found(odd, bench) == want == found(clashing, bench.withColumn("salt", F.lit(1)).withColumn("doc", F.lit(2)))
    assert found(no_rows, bench) == {} and found(odd, bench.limit(0)) == {}


def licenses_by_force(docs):
    out = {}
    for d, text, *_ in docs:
        w = words_of(text)
        order = [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []
        for name, notice in license.TEMPLATES:
            want = runs(notice)
            half = 1 << max(0, (len(want) - 1).bit_length())
            n = max((len(set(order[b : b + 2 * half]) & want) for b in range(0, len(order), half)), default=0)
            if n >= 0.8 * len(want) - 1e-9:
                out[d, name] = (max(n, out.get((d, name), (0,))[0]), len(want))
    return out


def test_licenses(rows, odd, clashing, no_rows):
    scan = lambda t: {(r.doc_id, r.license): (r.n_shared, r.n_shingles) for r in license.scan_licenses(t).collect()}
    docs, n = list(ODD), 20
    for k, (_, notice) in enumerate(license.TEMPLATES):
        for before in (0, 3, 50, 3001):
            docs.append((n := n + 1, f"{prose(before, k)} {notice.upper()}\n{prose(20, k)}", "en"))
        docs.append((n := n + 1, edited(notice, 1, k) + " " + prose(30, k), "en"))
    docs.append((n + 1, " ".join(t for _, t in license.TEMPLATES), "en"))
    assert scan(rows(docs, TEXTS)) == licenses_by_force(docs)
    assert scan(odd) == scan(clashing) == scan(no_rows) == {}


def test_common_licenses_are_covered_and_have_the_largest_share_of_their_own_text(rows):
    gnu = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU %sGeneral Public License as published by the Free Software Foundation; either version %s of the License, or (at your option) any later version."
    given = {
        "GPL-3.0-notice": gnu % ("", "3"),
        "GPL-2.0-notice": gnu % ("", "2"),
        "LGPL-3.0-notice": gnu % ("Lesser ", "3"),
        "LGPL-2.1-notice": (gnu % ("Lesser ", "2.1")).replace("program", "library"),
        "AGPL-3.0-notice": gnu % ("Affero ", "3"),
    }
    names = "BSD-2-Clause BSD-3-Clause ISC CC-BY-SA-4.0 CC0-1.0 CC0-1.0-notice Unlicense MIT-text Apache-2.0-header".split()
    given |= {n: dict(license.TEMPLATES)[n] for n in names}
    docs = rows([(k, f"{prose(30, k)} {t} {prose(30, k + 99)}", "en") for k, t in enumerate(given.values())], TEXTS)
    shares: dict = {}
    for r in license.scan_licenses(docs).collect():
        shares.setdefault(r.doc_id, {})[r.license] = (r.n_shared / r.n_shingles, r.n_shingles)
    assert {k: max(found, key=found.get) for k, found in shares.items()} == dict(enumerate(given))
    assert shares[0].keys() > {"GPL-3.0-notice"}


def test_license_scan_runs_no_python(odd):
    plan = license.scan_licenses(odd)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_too_many_templates_are_refused(spark):
    with pytest.raises(ValueError, match="templates"):
        license.template_table(spark, [("x", "y")] * (license.MAX_TEMPLATES + 1), 4)
