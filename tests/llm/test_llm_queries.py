"""Registered queries against their SQL, and the pipeline stage by stage."""

import collections
import pathlib
import random
import sys

import pytest
from conftest_llm import ODD, prose
from pyspark.sql import functions as F
from test_llm_lines import plain as plain_lines
from test_llm_similar import classes_by_force, contained_by_force

import __spark_entry__
import corpus_pipeline
from millrace.llm import language, neardup
from millrace.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))

from check_oracles import connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def test_entry_registers_every_query():
    names = __spark_entry__.queries()
    assert {"pipeline", *QUERIES} <= set(names) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    want = connect(SF_DIR).execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert collections.Counter(map(tuple, got.select(*columns).collect())) == collections.Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_for_every_document(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def corpus(rows, spark):
    shared = "Shared Line of many texts"
    bench = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").limit(3).collect()]
    base = prose(90, 7)
    texts = [f"{prose(40, 200 + k)}\n{shared} \n{prose(20, 300 + k)}" for k in range(11)]
    texts += [base, base + " end", base.upper(), prose(30, 1) + " " + bench[0] + " " + prose(4000, 2), bench[1], bench[1]]
    texts += [shared, "", None, "123 ### ...", "x"]
    docs = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    docs += [docs[11], (None, prose(25, 9), "en", None, None), (None, None, None, None, None), (400, prose(9, 8), None, None, None)]
    return docs, rows(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_do_what_their_operators_say(spark, rows):
    data, docs = corpus(rows, spark)
    names, functions = zip(*corpus_pipeline.STAGES, strict=True)
    assert names == ("language_id", "line_dedup", "near_dedup", "decontamination", "sentencepiece")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs = docs.withColumn("_lang", F.lit(1)).withColumn("kept", F.lit(2))

    one = functions[0](spark, docs, SF_DIR)
    assert one.columns == corpus_pipeline.COLUMNS
    key = lambda rs: sorted(((r[0], r[1]) for r in rs), key=str)
    assert key(one.collect()) == key(d for d in data if any(c.isalpha() for c in d[1] or ""))

    two = functions[1](spark, one, SF_DIR)
    want = plain_lines([(r.doc_id, r.text) for r in one.collect()], 10)
    assert key(two.collect()) == sorted([(d, kept) for (d, _, _, kept), n in want.items() for _ in range(n)], key=str)
    assert all(r.n_chars == len(r.text) for r in two.collect())

    three = functions[2](spark, two, SF_DIR)
    left = [tuple(r) for r in two.collect()]
    classes = classes_by_force(left, neardup.inverse_frequencies(two, "text"))
    stay = {d for d, c in classes.items() if d == c}
    assert sorted(r.doc_id for r in three.where("doc_id is not null").collect()) == sorted(stay)
    assert three.where("doc_id is null").count() == 1 and len(stay) < len(classes)

    four = functions[3](spark, three, SF_DIR)
    bad = {d for d, _ in contained_by_force([tuple(r) for r in three.collect()], items)}
    assert sorted((r.doc_id for r in four.collect()), key=str) == sorted((r.doc_id for r in three.collect() if r.doc_id not in bad), key=str)
    assert {14, 15} <= bad

    five = functions[4](spark, four, SF_DIR)
    assert five.count() == four.count() and five.where("not round_trip").count() == 0


def test_texts_in_no_learned_language_go(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    chance = random.Random(5)
    letters = lambda n: "".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    strange = [
        "Широкая электрификация южных губерний даст мощный толчок подъёму сельского хозяйства",
        "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία",
        "".join(chr(0x4E00 + chance.randrange(3000)) for _ in range(400)),
        letters(300),
        " ".join(letters(chance.randint(2, 9)) for _ in range(5000)),
    ]
    more = rows([(-k - 1, t, None, None, len(t)) for k, t in enumerate(strange)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id for r in corpus_pipeline.keep_known_language(spark, docs.unionByName(more), SF_DIR).collect()}
    assert got == {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_odd_and_no_rows(spark, odd, stage):
    docs = odd.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(None).cast("bigint"))
    got = stage[1](spark, docs.withColumn("t1", F.lit(1)).withColumn("member", F.lit(1)), SF_DIR)
    assert 0 < got.count() <= len(ODD)
    empty = stage[1](spark, docs.limit(0), SF_DIR)
    assert empty.count() == 0 and empty.columns == got.columns


def test_run_keeps_clean_documents(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()))
    assert language.with_language(docs, model).where("score < 0.3").count() == 0
    assert 0.7 * docs.count() < got.count() < docs.count()
    assert got.where("not round_trip").count() == 0
