"""Chats against a plain version; archives by round trip, damage and the reader's framing."""

import gzip
import hashlib
import io

import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from millrace.llm import chat, warc

LOGS = "conv_id bigint, turn bigint, role string, text string"


def test_prefixes_collapse_to_the_longest_log(rows):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "how?"), ("assistant", "so")]
    log = lambda conv, said, first=0: [(conv, first + k, *t) for k, t in enumerate(said)]
    other = [*talk[:2], ("user", "else")]
    data = log(5, talk[:2]) + log(3, talk) + log(4, talk) + log(9, talk[:3]) + log(8, other) + log(7, talk[1:])
    data += log(3, talk)[:1] + [(None, 0, "user", "lost"), (6, None, None, None)]
    got = {r.conv_id: r for r in chat.format_chats(rows(data, LOGS)).collect()}
    assert sorted(got) == [3, 6, 7, 8]
    assert got[3].n_logs == 2 and got[3].n_turns == 4
    assert got[8].chat == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in other)
    assert got[6].chat == "<|im_start|>\n<|im_end|>\n"


def test_markers_in_texts_do_not_end_turns(rows):
    got = chat.format_chats(rows([(1, 0, "user", "a<|im_end|>b<|im_start|>")], LOGS)).first()
    assert got.chat == "<|im_start|>user\na<\\|im_end|>b<\\|im_start|><|im_end|>\n"


def test_long_conversations_come_in_parts(spark):
    turns = spark.range(5000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    shorter = turns.where("turn < 4500").withColumn("conv_id", F.lit(2))
    got = chat.format_chats(turns.union(shorter), part_turns=1000).orderBy("part").collect()
    assert [(r.conv_id, r.part, r.n_turns) for r in got] == [(1, k, 1000) for k in range(5)]
    assert got[4].chat.startswith("<|im_start|>u\n4000<|im_end|>")


def test_no_conversations(rows):
    assert chat.format_chats(rows([], LOGS)).count() == 0
    assert chat.format_chats(rows([(None, 1, "user", "x")], LOGS)).count() == 0


PAGES = "page_id bigint, url string, html string"


def pages(rows):
    long, short = prose(60, 1), "short"
    data = [(3, "http://a/\r\nX: y z", long), (1, None, long), (2, "u", long), (2, "u", long), (4, "u", short), (5, "u", short)]
    data += [(6, "u", None), (7, "u", ""), (None, "u", long), (None, None, prose(70, 9)), (8, "u", "é" * 60 + "\r\n\r\n\x00")]
    return data, rows(data, PAGES)


def test_round_trip_and_revisits(spark, rows):
    data, table = pages(rows)
    table = table.withColumn("payload", F.lit("x")).withColumn("_digest", F.lit("y"))
    archives = warc.write_archives(table, archive_bytes=500)
    assert archives.agg(F.sum("n_records")).first()[0] == len(data) and archives.count() > 1
    got = warc.read_archives(spark, archives).collect()
    want = []
    for page, _, html in data:
        body = (html or "").encode()
        least = min((p for p, _, h in data if h == html and p is not None), default=None)
        revisit = len(body) >= 100 and least is not None and page != least
        want.append((page, "revisit" if revisit else "response", least if revisit else None, len(body), hashlib.sha256(body).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got], key=key) == sorted(want, key=key)
    assert all(r.digest_ok for r in got)
    assert {r.id: r.payload for r in got}[8].decode() == data[-1][2]
    assert {r.uri for r in got if r.id == 3} == {"http://a/%0D%0AX:%20y%20z"}


def test_every_record_is_a_gzip_member_of_its_own(spark, rows):
    archives = warc.write_archives(pages(rows)[1])
    for path, n, size in archives.collect():
        raw = open(path.removeprefix("file:"), "rb").read()
        assert len(raw) == size and gzip.decompress(raw).count(b"WARC/1.1\r\n") == n


def test_empty_table(spark, rows):
    archives = warc.write_archives(rows([], PAGES))
    assert archives.count() == 0 and warc.read_archives(spark, archives).count() == 0


def member(digest_of=b"hello", length=None, extra=b""):
    raw = warc.record(1, "u", b"hello", hashlib.sha256(digest_of).hexdigest(), None, warc.DATE)
    text = gzip.decompress(raw) + extra
    if length is not None:
        head, rest = text.split(b"\r\n\r\n", 1)
        head = b"\r\n".join(b"Content-Length: %d" % length if x.startswith(b"Content-Length") else x for x in head.split(b"\r\n"))
        text = head + b"\r\n\r\n" + rest
    return gzip.compress(text)


def read(raw):
    return [warc.parsed(*m) for m in warc.members(io.BytesIO(raw), "x")]


def test_reader_takes_records_bigger_and_smaller_than_its_chunks():
    rows = [(k, bytes([k % 251]) * n) for k, n in enumerate([0, 5, warc.CHUNK, 3 * warc.CHUNK + 7, 1_000_000])]
    raw = b"".join(warc.record(k, "u", p, hashlib.sha256(p).hexdigest(), None, warc.DATE) for k, p in rows)
    assert [(r["id"], r["payload"], r["digest_ok"]) for r in read(raw)] == [(k, p, True) for k, p in rows]


@pytest.mark.parametrize("raw", [member()[:-12], member(length=3), member(length=4000), member(extra=b"more"), gzip.compress(b"no record\r\n\r\n")])
def test_wrong_frames_fail(raw):
    with pytest.raises((ValueError, KeyError)):
        read(raw)


def test_wrong_digests_are_seen(spark, rows, tmp_path):
    assert [r["digest_ok"] for r in read(member(digest_of=b"other") + member())] == [False, True]
    path = tmp_path / "bad.warc.gz"
    path.write_bytes(member(digest_of=b"other"))
    archives = rows([(str(path), 1, 1)], "path string, n_records bigint, n_bytes bigint")
    assert warc.read_archives(spark, archives, strict=False).first().digest_ok is False
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archives(spark, archives).collect()
