"""Archives of other writers, and conversations that are very uneven."""

import base64
import gzip
import hashlib
import io
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, language, warc

LOGS = "conv_id bigint, turn bigint, role string, text string"
HTML = b"<html>hello</html>"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"


def member(kind, block, *fields, version="WARC/1.0", length=True):
    head = [version, f"WARC-Type: {kind}", *fields, *([f"Content-Length: {len(block)}"] if length else [])]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def read(raw):
    return [warc.parsed(*m) for m in warc.members(io.BytesIO(raw), "x")]


ID = "WARC-Record-ID: <urn:uuid:0c0a1e4d-0000-4000-8000-000000000001>"
RESPONSE = HTTP + b"\r\n" + HTML


def test_records_of_every_type_and_writer():
    raw = b"".join(
        [
            member("warcinfo", b"software: other/1.0\r\n", ID, "Content-Type: application/warc-fields"),
            member("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", ID, "Content-Type: application/http; msgtype=request", "WARC-Block-Digest: " + sha1(b"GET / HTTP/1.1\r\nHost: a\r\n\r\n")),
            member("response", RESPONSE, ID, "WARC-Target-URI: http://a/", "Content-Type: application/http;\r\n msgtype=response", "WARC-Payload-Digest: " + sha1(HTML), "WARC-Block-Digest: " + sha1(RESPONSE)),
            member("metadata", b"", ID),
            member("resource", b"plain bytes", ID, "WARC-Payload-Digest: md5:" + hashlib.md5(b"plain bytes").hexdigest()),
            member("response", HTTP + b"Transfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n0\r\n\r\n", ID, "Content-Type: application/http", "WARC-Payload-Digest: " + sha1(b"hello")),
            member("revisit", HTTP + b"\r\n", ID, "Content-Type: application/http", "WARC-Refers-To: <urn:uuid:2>", "WARC-Payload-Digest: " + sha1(HTML)),
            member("conversion", b"x", ID, "WARC-Payload-Digest: blake3:00", version="WARC/1.1"),
        ]
    )
    got = read(raw)
    assert [r["record_type"] for r in got] == ["warcinfo", "request", "response", "metadata", "resource", "response", "revisit", "conversion"]
    assert [r["digest_ok"] for r in got] == [None, True, True, None, True, None, None, None]
    assert [r["payload"] for r in got][2:5] == [HTML, b"", b"plain bytes"] and got[6]["payload"] is None
    assert got[2]["payload_bytes"] == len(HTML) and got[2]["payload_digest"] == sha1(HTML) and got[2]["uri"] == "http://a/"
    assert all(r["id"] is None and r["record_id"] == ID.split(": ")[1] for r in got)
    assert got[6]["refers_to"] is None and got[6]["refers_to_id"] == "<urn:uuid:2>" and got[6]["payload_bytes"] is None


def test_wrong_digests_of_other_writers_are_seen(spark, rows, tmp_path):
    raw = member("response", RESPONSE, ID, "Content-Type: application/http", "WARC-Payload-Digest: " + sha1(b"other"))
    assert read(raw)[0]["digest_ok"] is False
    path = tmp_path / "a.warc.gz"
    path.write_bytes(member("warcinfo", b"x", ID) + raw)
    archives = rows([(str(path), 2, 1)], "path string, n_records bigint, n_bytes bigint")
    assert [r["digest_ok"] for r in warc.read_archives(spark, archives, strict=False).collect()] == [None, False]
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archives(spark, archives).collect()


@pytest.mark.parametrize(
    "raw", [member("response", b"x", ID, length=False), member("response", b"x", "Content-Length: many", length=False), gzip.compress(b"GET / HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")]
)
def test_a_head_without_a_length_fails_by_name(raw):
    with pytest.raises(ValueError, match="^x: "):
        read(raw)


def test_a_hot_conversation_is_gathered_by_part(spark, no_broadcast, tmp_path):
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    turns.write.parquet(str(tmp_path / "turns"))
    chats = chat.format_chats(spark.read.parquet(str(tmp_path / "turns")))
    plan = chats._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("collect_set(", 1)  # texts move once, by conversation and part, and not again for the join
    assert re.match(r".*\n[^\n]*Exchange hashpartitioning\(conv#\d+, part#\d+L", below)
    assert re.search(r"SortMergeJoin \[conv#\d+, part#\d+L\]", above) and not re.search("Exchange [^\n]*\n[^\n]*ObjectHashAggregate[^\n]*$", above)
    got = chats.orderBy("part").collect()
    assert [r.n_turns for r in got] == [1024] * 19 + [544] and {r.slice for r in got} == {0}


@pytest.mark.parametrize("turn", [None, -7, 3])
def test_one_turn_with_very_many_texts_comes_in_slices(spark, turn):
    turns = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.lit(turn).cast("bigint").alias("turn"), F.lit("u").alias("role"), F.format_string("%04d", "id").alias("text")
    )
    usual = spark.createDataFrame([(2, 0, "u", "hi"), (2, 0, "u", "hi"), (2, None, None, None)], LOGS)
    extra = turns.union(turns).union(usual).withColumn("part", F.lit("x")).withColumn("slice", F.lit("y")).withColumn("conv", F.lit(5))
    got = chat.format_chats(extra, slice_rows=300).orderBy("conv_id", "part", "slice").collect()
    assert [(r.conv_id, r.slice, r.n_turns) for r in got] == [(1, 0, 300), (1, 1, 300), (1, 2, 300), (1, 3, 100), (2, 0, 2)]
    whole = "".join(r.chat for r in got[:4])
    assert whole == "".join(f"<|im_start|>u\n{k:04d}<|im_end|>\n" for k in range(1000))


def test_the_learned_model_does_not_depend_on_how_rows_are_dealt(spark, rows):
    texts = {"en": "the house and the garden were old", "fr": "la maison et le jardin sont vieux"}
    data = [(k, f"{texts[lang]} {k} {'abcdefgh'[k % 8] * 3}", lang) for k in range(400) for lang in ("en" if k % 2 else "fr",)]
    docs = rows(data, "doc_id bigint, text string, lang string")
    one, other = (language.fit(d, most=50) for d in (docs.coalesce(1), docs.repartition(7)))
    assert (one.landmarks == other.landmarks).all() and (one.weights == other.weights).all()
