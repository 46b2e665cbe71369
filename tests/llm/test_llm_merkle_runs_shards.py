"""Manifests, periodic runs and shards against plain versions, and hard inputs."""

import collections
import hashlib
import random
import zlib

import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from millrace.llm import merkle, periodic, sharding

DOC = "doc_id bigint, source string, lang string, n_chars bigint, text string"
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    for level in levels[:-1]:
        run = at // 16 * 16
        yield level[run:at], level[at + 1 : run + 16]
        at //= 16


def plain_manifest(rows):
    sources = collections.defaultdict(list)
    for r in rows:
        leaf = leaf_of(r)
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
        sources[r[1]].append((r[0], leaf, leaf_of((*r[:4], r[4].translate(LOWER))) if hit else leaf))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in sources[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (doc, leaf, now) in enumerate(sources[s]):
            beside = [*path(trees[s], i), *path(top, k)]
            for left, right in beside:
                now = h([*left, now, *right])
            proof = h(x for left, right in beside for x in (*left, *right))
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return collections.Counter(out)


def some_docs():
    chance = random.Random(3)
    rows = [(k, "hot", "en", k, f"Text {k}") for k in range(700)]
    rows += [(1000 + k, f"s{k % 40}", None, None, chance.choice(["ÀB", "", None, "x" * 5000])) for k in range(120)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (5, None, "de", 1, "Null Source"), (None, "hot", "en", 3, "No Id")]
    rows += [(7, "hot", "en", 7, "Text 7"), (7, "hot", "en", 7, "another of 7"), (2000, "", "en", 0, ""), (2001, "é", "en", 0, "A")]
    return rows


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_is_that_of_the_plain_trees(spark, rows, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    docs = rows(some_docs(), DOC).repartition(5)
    got = merkle.merkle_manifest(docs.withColumn("leaf", F.lit("x")).withColumn("idx", F.lit(1)), tampered=merkle.every_fifth(F.col("doc_id")))
    found = collections.Counter(tuple(r) for r in got.collect())
    assert found == plain_manifest(some_docs())
    assert {True, False} == {r[6] for r in found}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 40, 256, 257, 300, 530])
def test_blocks_get_all_that_is_beside_their_path(spark, n):
    names = [h([str(k)]) for k in range(n)]
    nodes = spark.createDataFrame([("k", k, n, d) for k, d in enumerate(names)], "key string, block bigint, blocks bigint, root string")
    got = merkle.butterfly(nodes, ["key"], merkle.levels_for(n)).collect()
    levels = tree(names)
    assert len(got) == n
    for r in got:
        assert r["root"] == levels[-1][0]
        assert list(zip(r["lefts"], r["rights"])) == [("".join(a), "".join(b)) for a, b in path(levels, r["block"])]


def test_manifest_of_no_rows_and_of_one(spark, rows):
    assert merkle.merkle_manifest(rows([], DOC)).count() == 0
    one = [(1, "s", "en", 1, "Text")]
    assert collections.Counter(tuple(r) for r in merkle.merkle_manifest(rows(one, DOC), tampered=F.lit(False)).collect()) == {
        (1, leaf_of(one[0]), leaf_of(one[0]), leaf_of(one[0]), h([]), leaf_of(one[0]), True): 1
    }


# --- runs ----------------------------------------------------------------------------------


def plain_runs(words):
    """Every stretch that a period fills, longest extension, smallest period of equal ones."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def test_runs_of_random_and_periodic_texts():
    chance = random.Random(11)
    for _ in range(120):
        texts = []
        for _ in range(chance.randint(1, 10)):
            n, k = chance.choice([0, 1, 5, 6, 24, 90, 300]), chance.choice([1, 2, 3, 6])
            words = [str(chance.randrange(k)) for _ in range(n)]
            if n and chance.random() < 0.6:
                a = chance.randrange(n)
                p = 1 + (n - a) // chance.randint(3, 10)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        assert periodic.find_runs(texts) == [plain_runs(w) for w in texts]


def test_matches_are_the_common_beginnings():
    chance = random.Random(2)
    for size in (1, 5, 30, 200):
        values = [chance.randint(1, 2) for _ in range(size)] + [9]
        m = periodic.Matches(periodic.np.array(values))
        pairs = [(i, j) for i in range(size) for j in range(i + 1, size)]
        if not pairs:
            continue
        got = m.extend(periodic.np.array([i for i, _ in pairs]), periodic.np.array([j for _, j in pairs]))
        for (i, j), length in zip(pairs, got):
            want = 0
            while j + want < len(values) and values[i + want] == values[j + want]:
                want += 1
            assert length == want


def test_words_beyond_what_fits_packed(monkeypatch):
    monkeypatch.setattr(periodic, "WORD_BITS", 3)
    words = [str(k % 40) for k in range(400)] + ["end"]
    assert periodic.find_runs([words]) == [[(0, 400, 40)]]


def test_periodic_rows(spark, rows, monkeypatch):
    data = [(1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a b"), (4, "A b A b A b A b A"), (4, "A b A b A b A b A"), (5, prose(3000, 1)), (6, "é é é é é é"), (8, "a a a a a")]
    docs = rows(data, "doc_id bigint, text string").withColumn("start", F.lit("x")).withColumn("runs", F.lit(1))
    monkeypatch.setattr(periodic, "PORTION_CHARS", 10)
    got = collections.defaultdict(list)
    for r in periodic.periodic_runs(docs, full=True).collect():
        got[r["doc_id"]].append(r)
    assert len(got[4]) == 2 and got[4][0] == got[4][1]
    assert got[4][0][1:6] == (1, 0, 9, 2, 4500) and got[4][0]["collapsed"] == "A b"
    assert [tuple(x) for x in got[4][0]["runs"]] == [(0, 9, 2)]
    assert got[None][0][1:6] == (1, 0, 6, 1, 6000) and got[None][0]["collapsed"] == "a b"
    for k in (1, 2, 3, 8):  # five words are no run
        assert got[k][0][1:6] == (0, None, None, None, None)
        assert got[k][0]["runs_sha256"] == h([])
    assert got[1][0]["collapsed_sha256"] == h([]) and got[5][0]["collapsed_sha256"] == h([prose(3000, 1)])
    assert got[6][0]["collapsed"] == "é" and got[6][0]["runs_sha256"] == h(["0,6,1\n"])
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_planted_texts_by_the_rule(spark, rows):
    texts = {k: prose(60, k) for k in range(200)}
    docs = rows(sorted(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs, planted=True).collect()}
    for k, text in texts.items():
        words, crc = text.split(), zlib.crc32(str(k).encode())
        if crc % 10 == 0:
            a, g = crc // 10 % 60, crc // 10
            p = 1 + (60 - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(60)]
        want = plain_runs(words)
        assert got[k]["n_runs"] == len(want)
        assert got[k]["runs_sha256"] == h(f"{s},{n},{p}\n" for s, n, p in want)
        drop = {i for s, n, p in want for i in range(s + p, s + n)}
        assert got[k]["collapsed_sha256"] == h([" ".join(w for i, w in enumerate(words) if i not in drop)])
    assert any(r["n_runs"] for r in got.values())


# --- shards --------------------------------------------------------------------------------


def check_shards(got, n, shards):
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == n and set(by) <= set(range(shards))
    counts = [len(by[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def shards_of_texts(got, docs):
    of = {r["doc"]: r["shard"] for r in got}
    texts = collections.defaultdict(list)
    for doc, text in docs:
        texts[text].append(of[doc])
    return texts


def test_equal_texts_meet_and_counts_are_even(spark, rows):
    data = [(k, f"group {k % 40}" if k < 160 else f"alone {k}") for k in range(1003)]
    docs = rows(data, "doc_id bigint, text string").withColumn("size", F.lit("x")).withColumn("node", F.lit(1)).repartition(3)
    got = sharding.balanced_shards(docs).collect()
    check_shards(got, 1003, 16)
    assert all(len(set(s)) == 1 for s in shards_of_texts(got, data).values())
    by_id = {r["doc"]: r for r in got}
    assert all((by_id[d]["size"], by_id[d]["text_crc32"]) == (len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in data)


def test_a_hot_text_fills_shards_one_after_the_other(spark, rows, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 50)  # as if 400 copies were very many
    data = [(k, "hot" if k < 400 else f"pair {k // 2}" if k < 800 else f"alone {k}") for k in range(1200)]
    got = sharding.balanced_shards(rows(data, "doc_id bigint, text string")).collect()
    check_shards(got, 1200, 16)
    texts = shards_of_texts(got, data)
    counts = sorted(collections.Counter(texts.pop("hot")).values(), reverse=True)
    assert sum(counts[:6]) >= 250, counts  # of 400; by hash it would be 150
    assert sum(len(set(s)) > 1 for s in texts.values()) <= 20  # of 200 pairs


def test_counts_are_even_where_all_documents_are_linked(spark, rows):
    data = [(k, "hot" if k < 400 else f"pair {k // 2}") for k in range(1200)]
    got = sharding.balanced_shards(rows(data, "doc_id bigint, text string")).collect()
    check_shards(got, 1200, 16)
    texts = shards_of_texts(got, data)
    texts.pop("hot")
    assert sum(len(set(s)) > 1 for s in texts.values()) <= 200  # of 400; by hash it would be 375


def test_links_of_ones_own(spark, rows):
    docs = rows([(k, f"t{k}") for k in range(320)], "doc_id bigint, text string")
    links = rows([(k, f"site {k // 8}") for k in range(160)] + [(0, None), (None, "site 1")], "doc bigint, link string")
    got = sharding.balanced_shards(docs, links, shards=4).collect()
    check_shards(got, 320, 4)
    of = {r["doc"]: r["shard"] for r in got}
    assert all(len({of[k] for k in range(8 * s, 8 * s + 8)}) == 1 for s in range(20))


def test_odd_rows_in_shards(spark, rows, odd, no_rows):
    got = sharding.balanced_shards(odd).collect()
    check_shards(got, 13, 16)
    nulls = [r for r in got if r["size"] == 1]
    assert {r["text_crc32"] for r in nulls} == {None, 0}
    same = [(1, "x")] * 50 + [(None, None)] * 50
    check_shards(sharding.balanced_shards(rows(same, "doc_id bigint, text string"), shards=3).collect(), 100, 3)
    assert sharding.balanced_shards(no_rows).count() == 0


def test_quotas_leave_every_shard_within_its_capacity():
    chance = random.Random(1)
    for _ in range(200):
        n = chance.randint(2, 6)
        wanted = [[0 if i == j else chance.randint(0, 30) for j in range(n)] for i in range(n)]
        load = [sum(row) + chance.randint(0, 40) for row in wanted]
        capacity = -(-sum(load) // n) + chance.randint(0, 5)
        go = sharding.move_quotas(wanted, load, capacity)
        for j in range(n):
            arriving = sum(go[i][j] for i in range(n))
            assert arriving == 0 or load[j] - sum(go[j]) + arriving <= capacity + 0.5
        assert all(0 <= go[i][j] <= wanted[i][j] for i in range(n) for j in range(n) if i != j)
    # shards that are full exchange documents one for one
    assert sharding.move_quotas([[0, 5], [7, 0]], [10, 10], 10) == [[0, 5], [pytest.approx(5), 0]]
