"""Text statistics and decision lists against plain versions; language ID on held-out texts."""

import random
import re

import numpy as np
from conftest_llm import ODD, prose
from pyspark.sql import functions as F

from millrace.llm import language, quality

TEXTS = "doc_id bigint, text string, lang string"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows, spots = {}, set()
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    for found in windows.values():
        if len(found) > 1:
            spots.update(k for i in found for k in range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(spots)


def some_texts():
    chance = random.Random(11)
    for _ in range(150):
        words = [chance.choice(["a", "bb", "ccc", "#x", "|", "é"]) for _ in range(chance.randint(0, 40))]
        yield "".join(w + chance.choice([" ", " ", "  ", "\n", "\t"]) for w in words)
    phrase = prose(9, 1)
    yield f"{phrase} {prose(7, 2)} {phrase} x {phrase}"
    yield "line\n line\nline\n\n\n \nline"
    yield "w " * 20
    yield prose(20_000, 3) + " " + prose(30, 4) + " " + prose(20_000, 3)


def test_statistics(rows, odd, clashing, no_rows):
    docs = [(k, t, "en") for k, t in enumerate(some_texts())]
    for data, table in ((docs, rows(docs, TEXTS)), (ODD, odd), (ODD, clashing)):
        got = quality.with_statistics(table).select("doc_id", *quality.STATISTICS, "base_failed").collect()
        want = [(d, *plain(t)) for d, t, *_ in data]
        key = lambda r: tuple(map(str, r))
        assert sorted([tuple(r)[:-1] for r in got], key=key) == sorted(want, key=key)
        assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert quality.with_statistics(no_rows).count() == 0


def labelled(rows, n=900):
    """Bad: many symbols, or very long words in long texts. One label in a hundred is wrong."""
    chance, data = random.Random(2), []
    for k in range(n):
        words = chance.randint(20, 400)
        symbols = chance.choice([0, 0, 1, 2, words // 2, words])
        chars = words * chance.choice([4, 5, 6, 12])
        bad = symbols * 3 > words or (chars > 8 * words and words > 200)
        data.append((k, words, chars, symbols, 0, 0, int(not bad) if chance.random() > 0.01 else int(bad), bad))
    return rows(data, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, quality int, bad boolean")


def test_rules_find_what_makes_texts_bad(rows):
    table = labelled(rows)
    rules = quality.learn_rules(table)
    assert 2 <= len(rules) <= quality.MAX_RULES and all(len(r) <= quality.MAX_CONDITIONS for r in rules)
    assert any("n_symbols" in str(c) for c in rules[0]) or any("word_chars" in str(c) for c in rules[0])
    judged = table.withColumn("kept", quality.verdict(rules))
    assert judged.where("kept and bad").count() < 60 and judged.where("not kept and not bad").count() < 10


def brute_condition(data, rule, edges):
    """The best condition by counting rows."""
    covered = [d for d in data if all((d[c.feature] >= c.threshold) == c.above for c in rule)]
    bad, good = sum(d["bad"] for d in covered), sum(not d["bad"] for d in covered)
    best = 0
    for f, bounds in edges.items():
        for e in bounds:
            for above in (False, True):
                p = sum(d["bad"] for d in covered if (d[f] >= e) == above)
                n = sum(not d["bad"] for d in covered if (d[f] >= e) == above)
                if p and bad and good:
                    best = max(best, p * (np.log2(p / (p + n)) - np.log2(bad / (bad + good))))
    return best


def test_grown_conditions_have_the_best_gain(rows):
    table = labelled(rows, 300)
    cells, edges = quality.cells(table, "quality", "doc_id")
    data = [
        {**{f: eval(e, {}, r.asDict()) for f, e in quality.FEATURES.items()}, "bad": r.quality == 0}  # noqa: S307
        for r in table.withColumn("grow", F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).where("grow").collect()
    ]
    rule = []
    for _ in range(2):
        got = quality.best_condition(cells, rule, edges)
        if got is None:
            break
        before = [d for d in data if all((d[c.feature] >= c.threshold) == c.above for c in rule)]
        after = [d for d in before if (d[got.feature] >= got.threshold) == got.above]
        share = lambda ds: np.log2(sum(d["bad"] for d in ds) / len(ds))
        gain = sum(d["bad"] for d in after) * (share(after) - share(before))
        assert abs(gain - brute_condition(data, rule, edges)) < 1e-9
        rule.append(got)
    assert rule


def test_rare_junk_and_junk_amid_good_values_is_found(rows):
    """Three in a hundred have a symbol, as many words of one length that lies between good ones."""
    chance, data = random.Random(4), []
    for k in range(3000):
        kind = chance.choices(["good", "symbols", "length"], [94, 3, 3])[0]
        words = chance.randint(100, 400)
        mean = 6.0 if kind == "length" else chance.choice([chance.uniform(4.5, 5.9), chance.uniform(6.1, 7.5)])
        data.append((k, words, round(words * mean), chance.randint(1, 3) if kind == "symbols" else 0, 0, 0, int(kind == "good"), kind))
    table = rows(data, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, quality int, kind string")
    judged = table.withColumn("kept", quality.verdict(quality.learn_rules(table)))
    left = {(r.kind, r.kept): r["count"] for r in judged.groupBy("kind", "kept").count().collect()}
    assert ("symbols", True) not in left and ("length", True) not in left
    assert left.get(("good", False), 0) <= 5


def test_labels_that_teach_nothing(rows, odd, clashing, no_rows):
    labels = "doc_id bigint, quality int, toxic int"
    for data in ([], [(1, None, 0), (None, 0, 0)], [(4, 1, 0), (4, 1, 0), (5, 0, 0), (5, 1, 1)]):
        got = quality.apply_quality_rules(odd, rows(data, labels)).collect()
        assert len(got) == len(ODD) and all(r.kept == (not r.base_failed) for r in got)
    assert quality.apply_quality_rules(clashing, rows([], labels)).count() == len(ODD)
    assert quality.apply_quality_rules(no_rows, rows([(1, 0, 0)], labels)).count() == 0


def test_statistics_run_no_python(odd):
    plan = quality.with_statistics(odd)._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("Python", "Pandas", "Arrow", "CartesianProduct") if bad in plan]


def grams(text):
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in f" {text} ")
    letters = re.sub(" +", " ", letters)
    return {letters[i : i + n] for n in language.GRAMS for i in range(len(letters) - n + 1)} if letters.strip() else set()


def test_presence_is_that_of_ngrams(monkeypatch):
    texts = ["Hello, wörld!", "hello WÖRLD", "ab", "a", "", None, "12 #", "Ünï 漢字 x", prose(300, 1)]
    rows = language.presence(texts)
    assert (rows[0] == rows[1]).all() and not rows[4:7].any()
    for text, row in zip(texts, rows, strict=True):
        assert abs(row.sum() - len(grams(text or ""))) <= len(grams(text or "")) // 20
    monkeypatch.setattr(language, "CHUNK_CHARS", 7)
    assert (language.presence(texts) == rows).all()
    got = language.kernel(rows[:3], rows[:3])
    a, b = grams(texts[0]), grams(texts[2])
    assert abs(got[0, 2] - len(a & b) / np.sqrt(len(a) * len(b))) < 5e-3 and abs(got[0, 0] - 1) < 1e-6


def test_landmarks_give_exact_ridge_regression_when_they_are_all_texts():
    texts = [prose(30, k) for k in range(12)] + [f"über straße {prose(5, k)} größe" for k in range(12)]
    langs = np.array(["a"] * 12 + ["b"] * 12, object)
    rows = language.presence(texts)
    model = language.ridge(rows, langs, landmarks=24, penalty=0.5)
    rows = np.unpackbits(model.landmarks, axis=1).astype(bool)
    langs = np.array(["a", "b"] * 12, object)  # landmarks are taken from the languages in turn
    k = language.kernel(rows, rows).astype(float)
    target = np.where(langs == "a", 1.0, -1.0)
    middle = np.eye(24) - 1 / 24
    dual = np.linalg.solve(middle @ k @ middle + 0.5 * np.eye(24), target - target.mean())
    want = middle @ k @ middle @ dual + target.mean()
    assert np.allclose((k @ model.weights + model.bias)[:, 0], want, atol=1e-3)


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").union(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    model = language.fit(docs.where(~language.held_out()), most=400)
    got = language.with_language(docs.where(language.held_out()), model)
    n, good = got.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and good >= 0.98 * n
    assert got.where("score < 0 or score > 1").count() == 0


def test_odd_texts_have_no_language_without_letters(rows, odd, clashing, no_rows):
    data = [(k, prose(20, k), "en") for k in range(20)] + [(k, f"größe über {k} straße müde", "de") for k in range(20, 40)]
    model = language.fit(rows(data, TEXTS))
    assert model.languages == ["de", "en"]
    for table in (odd, clashing):
        got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language.with_language(table, model).collect()}
        assert len(got) == len({(d, t) for d, t, _ in ODD})
        for (_, text), (lang, score) in got.items():
            assert (lang == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= score <= 1
            assert score == 0 or lang != "und"
    assert language.with_language(no_rows, model).count() == 0
    for nothing in (no_rows, odd.withColumn("lang", F.lit(None).cast("string"))):
        empty = language.fit(nothing)
        assert {tuple(r) for r in language.with_language(odd, empty).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_a_quarter_is_held_out(spark):
    import zlib

    got = spark.range(200).select("id", language.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(language.held_out("id")).first()[0] is True
