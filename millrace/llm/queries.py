"""One registered query per operator, and the SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    chat, decontaminate, language, license, lines, merkle, neardup, periodic, quality, sentencepiece, sharding, tokencount, warc,
)
from millrace.llm.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER_LOWER = f"'{lines.UPPER}', '{lines.LOWER}'"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    both = sentencepiece.encode(docs, out_decoded="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


# Distinct runs of five words of each text; a text with fewer words is one run.
SHINGLES = r"""SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS s
  FROM (SELECT id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}\s]', '', 'g'), '\s+'),
                               lambda x: x <> '') AS w FROM {source}) WHERE len(w) > 0"""


@query(f"""
WITH d AS ({SHINGLES.replace('{source}', '(SELECT doc_id AS id, text FROM documents)')}),
b AS ({SHINGLES.replace('{source}', '(SELECT item_id AS id, text FROM benchmark)')}),
n AS (SELECT id, count(*) AS n_shingles FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, n_shingles
FROM d JOIN b USING (s) JOIN n ON n.id = b.id GROUP BY d.id, b.id, n_shingles HAVING 5 * count(*) >= 4 * n_shingles
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that contains an item of the benchmark."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, load(spark, sf_dir, "benchmark"))


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(range(len(ls))) AS p, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {UPPER_LOWER}) AS key
      FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY r, doc_id
""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_shared_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(r"""
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT conv_id, turn, string_agg(role || chr(31) || text, chr(30) ORDER BY role, text) AS said FROM t GROUP BY ALL),
p AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last,
             sha256(string_agg(turn || chr(31) || said, chr(29)) OVER (PARTITION BY conv_id ORDER BY turn)) AS prefix FROM u),
k AS (SELECT min(conv_id) AS conv_id, count(*) AS n_logs FROM p e WHERE turn = last AND NOT EXISTS
      (SELECT 1 FROM p o WHERE o.prefix = e.prefix AND o.turn < o.last) GROUP BY prefix)
SELECT conv_id, part, slice, count(*) AS n_turns, n_logs,
       sha256(string_agg('<|im_start|>' || role || chr(10)
              || regexp_replace(text, '<\|(im_start|im_end)\|>', '<\\|\1|>', 'g') || '<|im_end|>' || chr(10), ''
              ORDER BY turn, role, text)) AS chat_sha256
FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) - 1) // 4096 AS slice
      FROM (SELECT *, CAST(greatest(turn // 1024, 0) AS BIGINT) AS part FROM t)) JOIN k USING (conv_id)
GROUP BY conv_id, part, slice, n_logs
""")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat.format_chats(load(spark, sf_dir, "conversations"))
    return chats.select("conv_id", "part", "slice", "n_turns", "n_logs", F.sha2("chat", 256).alias("chat_sha256"))


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every text with what the other three quarters of the ids teach."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out()))
    return language.with_language(docs, model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


def license_values() -> str:
    quoted = [f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, t in license.TEMPLATES]
    return ", ".join(quoted)


@query(rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\p{{M}}\s]+', '', 'g'), '\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT r, doc_id, unnest(range(greatest(len(w) - 4, 1))) AS p,
             unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
      FROM w WHERE len(w) > 0),
tw AS (SELECT license, list_filter(regexp_split_to_array(
    regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\p{{M}}\s]+', '', 'g'), '\s+'), lambda x: x <> '') AS w
       FROM (VALUES {license_values()}) AS v(license, text)),
t AS (SELECT DISTINCT license, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
                                                      lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM tw),
n AS (SELECT license, count(*) AS n_shingles, CAST(2 ** ceil(log2(count(*))) AS BIGINT) AS half FROM t GROUP BY license),
m AS (SELECT r, doc_id, license, s, n_shingles, unnest([p // half, p // half - 1]) AS w
      FROM s JOIN t USING (s) JOIN n USING (license)),
f AS (SELECT doc_id, license, n_shingles, count(DISTINCT s) AS n_shared FROM m WHERE w >= 0
      GROUP BY r, doc_id, license, n_shingles, w HAVING 5 * count(DISTINCT s) >= 4 * n_shingles)
SELECT doc_id, license, max(n_shared) AS n_shared, n_shingles FROM f GROUP BY doc_id, license, n_shingles
""".replace("\\\\", "\\"))
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice of every document."""
    return license.scan_licenses(load(spark, sf_dir, "documents").select("doc_id", "text"))


@query("""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT page_id, n, d, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > f THEN f END AS refers_to
FROM f
""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the pages as archives and read these back."""
    archives = warc.write_archives(load(spark, sf_dir, "pages"))
    records = warc.read_archives(spark, archives, payload=False)
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return neardup.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of rules learned from the labels."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.apply_quality_rules(docs, load(spark, sf_dir, "labels"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.with_token_counts(docs).select("doc_id", "n_words", "n_tokens")


def tree_sql(name: str, base: str, key: str, levels: int = 8) -> str:
    """Common table expressions of the trees of ``base`` ({key}, idx, d), one per level (a tree ends with one node)
    and, per level, what stands beside each node: for trees of up to 16 ** levels leaves."""
    out = [f"{name}0 AS (SELECT {key}, idx, d, count(*) OVER (PARTITION BY {key}) AS n FROM {base})"]
    for k in range(levels):
        run = f"OVER (PARTITION BY {key}, idx // 16 ORDER BY idx ROWS BETWEEN"
        out.append(
            f"{name}{k + 1} AS (SELECT {key}, idx // 16 AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d, (max(n) + 15) // 16 AS n "
            f"FROM {name}{k} WHERE n > 1 GROUP BY {key}, idx // 16)"
        )
        out.append(
            f"{name}b{k} AS (SELECT {key}, idx, coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE n > 1)"
        )
    roots = " UNION ALL ".join(f"SELECT {key}, d FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    return ",\n".join([*out, f"{name}_root AS ({roots})"])


def path_sql(name: str, tree: str, base: str, key: str, levels: int = 8) -> str:
    """Common table expressions that take rows of ``base`` (r, {key}, idx, acc, proof) up a tree."""
    out = [f"{name}0 AS (SELECT r, {key}, idx, acc, proof FROM {base})"]
    for k in range(levels):
        out.append(
            f"{name}{k + 1} AS (SELECT p.r, p.{key}, p.idx // 16 AS idx, CASE WHEN b.l IS NULL THEN acc ELSE sha256(l || acc || b.r) END AS acc, "
            f"CASE WHEN b.l IS NULL THEN proof ELSE proof || l || b.r END AS proof "
            f"FROM {name}{k} p LEFT JOIN {tree}b{k} b ON b.{key} = p.{key} AND b.idx = p.idx)"
        )
    return ",\n".join(out)


def leaf_sql(text: str) -> str:
    columns = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"


# CRC-32 of the decimal id, byte by byte with the usual table
CRC_SQL = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
crc AS (SELECT doc_id, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table)"""


@query(f"""
WITH {CRC_SQL},
docs AS (SELECT row_number() OVER () AS r, documents.*, coalesce(crc % 5 = 0, false) AS changed FROM documents LEFT JOIN crc USING (doc_id)),
leaves AS (SELECT r, doc_id, source, {leaf_sql('text')} AS d,
  {leaf_sql(f"CASE WHEN changed THEN translate(text, {UPPER_LOWER}) ELSE text END")} AS now FROM docs),
names AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM documents)),
ordered AS (SELECT r, doc_id, s, d, now, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, d) - 1 AS idx
  FROM leaves JOIN names ON leaves.source IS NOT DISTINCT FROM names.source),
{tree_sql('t', 'ordered', 's')},
tops AS (SELECT 0 AS one, s AS idx, d FROM t_root),
{tree_sql('u', 'tops', 'one')},
start AS (SELECT r, s, idx, now AS acc, '' AS proof FROM ordered),
{path_sql('p', 't', 'start', 's')},
above AS (SELECT r, 0 AS one, s AS idx, acc, proof FROM p8),
{path_sql('q', 'u', 'above', 'one')}
SELECT doc_id, ordered.d AS leaf, t_root.d AS subroot, u_root.d AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
       acc = u_root.d AS verified
FROM ordered JOIN q8 USING (r) JOIN t_root ON t_root.s = ordered.s CROSS JOIN u_root
""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proofs of all documents, and what comes of the proof of those that were tampered with."""
    docs = load(spark, sf_dir, "documents")
    return merkle.merkle_manifest(docs, tampered=merkle.every_fifth(F.col("doc_id")))


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every text, every tenth of which is made periodic first."""
    return periodic.periodic_runs(load(spark, sf_dir, "documents"), planted=True)


@query()
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards, equal texts together, counts at most one apart."""
    placed = sharding.balanced_shards(load(spark, sf_dir, "documents"))
    return placed.select(
        F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
