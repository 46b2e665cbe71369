"""Line dedup against a plain version."""

import collections

from conftest_llm import ODD
from pyspark.sql import functions as F

from millrace.llm.lines import drop_shared_lines

SPACES = " \t\n\x0b\x0c\r"


def plain(docs, min_docs, min_chars=1):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    found = collections.defaultdict(set)
    for doc, text, *_ in docs:
        for line in (text or "").split("\n"):
            found[key(line)].add(doc)
    out = []
    for doc, text, *_ in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= min_chars and len(found[key(x)]) >= min_docs)]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return collections.Counter(out)


def run(docs, **options):
    got = drop_shared_lines(docs, **options).select("doc_id", "n_lines", "n_dropped", "kept")
    return collections.Counter(map(tuple, got.collect()))


def test_frequent_lines_go_and_others_keep_their_place(spark, rows):
    docs = [(k, f"own {k}\n  Shared LINE\t\nmiddle {k % 4}\n\nshared line\nlast", "en") for k in range(12)]
    docs += [(99, "Shared line", "en"), (100, "\n\n", "en"), (101, "ÄSHARED LINE", "en")]
    frame = rows(docs, "doc_id bigint, text string, lang string")
    assert run(frame, min_docs=3) == plain(docs, 3)
    assert run(frame, min_docs=13) == plain(docs, 13)
    assert run(frame, min_docs=3, min_chars=9) == plain(docs, 3, 9)


def test_documents_are_counted_not_rows(rows):
    docs = [(1, "a\na\nb", "")] * 5 + [(2, "a", "")]
    frame = rows(docs, "doc_id bigint, text string, lang string")
    assert run(frame, min_docs=2) == plain(docs, 2)
    assert run(frame, min_docs=3) == plain(docs, 3)


def test_odd_rows(odd, clashing, no_rows):
    assert run(odd, min_docs=2) == plain(ODD, 2)
    assert run(clashing, min_docs=2) == plain(ODD, 2)
    assert drop_shared_lines(clashing).columns[-3:] == ["n_lines", "n_dropped", "kept"]
    assert drop_shared_lines(no_rows).count() == 0


def test_long_document_and_hot_line(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat_ws("\n", F.lit("hot"), F.col("id").cast("string"), F.lit("hot")).alias("text")
    )
    big = spark.range(1).select(
        F.lit(1000).cast("bigint").alias("doc_id"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40000)), lambda i: F.concat(F.lit("hot\nx"), i.cast("string"))), "\n").alias("text"),
    )
    got = {r.doc_id: r for r in drop_shared_lines(docs.union(big)).collect()}
    assert got[7].kept == "7" and got[7].n_dropped == 2
    assert got[1000].n_lines == 80000 and got[1000].n_dropped == 40000
    assert got[1000].kept.split("\n")[:2] == ["x1", "x2"]


def test_no_python_in_the_plan(odd):
    plan = drop_shared_lines(odd)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
