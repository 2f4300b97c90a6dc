"""The operators bound to the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, decontam, hostrules, html, langid, lengths, linecrf, manifest, negatives,
               sharding, simhash, stages, suffix)
from .common import held_out, ready

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ready(spark)
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


@query("op1_simhash")
def _(table) -> DataFrame:
    return simhash.near_duplicates(table("documents"))


# Moments, prior and shrunk rates as in ``hostrules``; windows are compared as text.
OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
counted AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, w,
         row_number() OVER () AS r
  FROM words),
windows AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS v
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM counted WHERE len(w) >= 8)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, v) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
measures AS (
  SELECT doc_id, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM counted LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS f1,
         10 * n_symbols > word_chars AS f2, 10 * n_dup_lines > 3 * n_lines AS f3
  FROM measures),
hosts AS (
  SELECT source, count(*) AS n, count_if(f1) AS a, count_if(f2) AS b, count_if(f3) AS c
  FROM judged WHERE source IS NOT NULL GROUP BY source),
long AS (
  SELECT source, n, 1 AS rule, a AS k FROM hosts UNION ALL SELECT source, n, 2, b FROM hosts
  UNION ALL SELECT source, n, 3, c FROM hosts),
prior AS (
  SELECT rule, m, CASE WHEN v > 0 THEN greatest(1.0, least(10000.0, m * (1 - m) / v - 1))
                       ELSE 10000.0 END AS s
  FROM (SELECT rule, sum(k) / sum(n) AS m,
               sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2 AS v FROM long GROUP BY rule)),
verdict AS (
  SELECT source, max((k + m * s) / (n + s)) > 0.5 AS host_failed
  FROM long JOIN prior USING (rule) GROUP BY source)
SELECT doc_id, judged.source AS host, n_words, word_chars, n_symbols, n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, f1 AS base_failed,
       coalesce(host_failed, false) AS host_failed,
       NOT f1 AND NOT coalesce(host_failed, false) AS kept
FROM judged LEFT JOIN verdict ON judged.source = verdict.source
"""


@query("op2_host_rules", OP2_SQL)
def _(table) -> DataFrame:
    return hostrules.judge(table("documents"))


OP3_SQL = """
WITH known AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
ends AS (
  SELECT conv_id, max(turn) AS at, max_by(text, (turn, text)) AS answer
  FROM known WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id),
doubled AS (
  SELECT 2 * conv_id AS conv_id, turn, role, text FROM known
  UNION ALL
  SELECT 2 * k.conv_id + 1, turn, role,
         CASE WHEN turn = e.at AND role = 'assistant' THEN o.answer ELSE text END
  FROM known k JOIN ends e ON e.conv_id = k.conv_id
       JOIN ends o ON o.conv_id = k.conv_id + 1 - 2 * (((k.conv_id % 2) + 2) % 2)
  WHERE turn IS NULL OR turn <= e.at),
turns AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id, turn
                            ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS tie
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM doubled)),
pairs AS (SELECT DISTINCT conv_id AS pair_id FROM known),
c AS (SELECT pair_id, turn, tie, role, text FROM pairs JOIN turns ON conv_id = 2 * pair_id),
r AS (SELECT pair_id, turn, tie, role, text FROM pairs JOIN turns ON conv_id = 2 * pair_id + 1),
rows AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn,
         coalesce(c.tie, r.tie) AS tie, c.pair_id IS NOT NULL AS in_c, r.pair_id IS NOT NULL AS in_r,
         c.role AS c_role, c.text AS c_text, r.role AS r_role, r.text AS r_text
  FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.turn IS NOT DISTINCT FROM r.turn
       AND c.tie = r.tie),
flags AS (
  SELECT *, in_c AND in_r AND c_role IS NOT DISTINCT FROM r_role
            AND c_text IS NOT DISTINCT FROM r_text AS same FROM rows),
marked AS (
  SELECT *, bool_and(same) OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, tie
                                 ROWS UNBOUNDED PRECEDING) AS common,
         bool_or(in_c) OVER (PARTITION BY pair_id) AND bool_or(in_r) OVER (PARTITION BY pair_id)
           AS paired FROM flags),
parts AS (
  SELECT pair_id, turn, tie, 'prompt' AS part, c_role AS role, c_text AS text, paired
  FROM marked WHERE common
  UNION ALL SELECT pair_id, turn, tie, 'chosen', c_role, c_text, paired
  FROM marked WHERE NOT common AND in_c
  UNION ALL SELECT pair_id, turn, tie, 'rejected', r_role, r_text, paired
  FROM marked WHERE NOT common AND in_r)
SELECT pair_id, part, turn, CAST(tie AS INTEGER) AS tie, role,
       '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10)
         AS rendered,
       CAST(CASE WHEN role = 'assistant' AND part <> 'prompt' THEN 1 ELSE 0 END AS INTEGER) AS trained,
       length(coalesce(text, '')) AS n_chars, paired
FROM parts
"""


@query("op3_preferences", OP3_SQL)
def _(table) -> DataFrame:
    return chat.format_preferences(*chat.swapped(table("conversations")))


@query("op4_language")
def _(table) -> DataFrame:
    documents = table("documents")
    found = langid.identify(documents, documents.filter(~held_out("doc_id", 5, 0)))
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score",
                        "rejected")


OP5_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS v
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs CROSS JOIN sizes WHERE len(w) >= n)),
found AS (SELECT DISTINCT r, i, p.n, item_id FROM places p JOIN windows x ON p.n = x.n AND p.v = x.v),
hit AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r),
who AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN who USING (r)
"""


@query("op5_decontamination", OP5_SQL)
def _(table) -> DataFrame:
    found = decontam.find_passages(table("documents"), table("benchmark"), carry=["doc_id", "text"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op6_shards")
def _(table) -> DataFrame:
    return sharding.pack(table("documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")


# Bytes as pairs of hexadecimal digits; a window is a repeat unless it is the first of its kind.
OP7_SQL = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY v ORDER BY doc_id, p) AS nth
  FROM (SELECT doc_id, p, md5(substring(h, 2 * p + 1, 200)) AS v
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p
              FROM docs WHERE length(h) >= 200))),
starts AS (SELECT doc_id, p FROM windows WHERE nth > 1),
fresh AS (
  SELECT doc_id, p, coalesce(p > 100 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), true) AS new
  FROM starts),
runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS z
  FROM (SELECT doc_id, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM fresh) GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
kept AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
         string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS part
  FROM edges JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(part || substring(h, 2 * last + 1), h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


@query("op7_repeats", OP7_SQL)
def _(table) -> DataFrame:
    cut = suffix.remove_repeats(table("documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_bpe")
def _(table) -> DataFrame:
    coded = bpe.encode(table("documents"), public_tokenizers.path(stages.VOCABULARY),
                       public_tokenizers.PATTERN)
    return stages.with_digests(coded).drop("ids")


@query("op9_line_quality")
def _(table) -> DataFrame:
    documents, labels = table("documents"), table("labels")
    held = held_out("doc_id", 3, 1)
    model = linecrf.learn(documents.filter(~held), labels.filter(~held))
    return linecrf.score(documents, model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op10_main_text")
def _(table) -> DataFrame:
    pages = table("pages")
    return html.extract(pages, html.learn(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# Levels upward by recursion, first in each lang's tree, then above all; siblings by a join of a
# level with itself; then every leaf downward-to-root by recursion again.
OP11_SQL = """
WITH RECURSIVE named AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, n_chars, text,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
             lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
             CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS code
  FROM documents),
heads AS (
  SELECT r, doc_id, t, text, lowered, code,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
  FROM named),
digests AS (
  SELECT r, doc_id, t, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN code % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END
           AS changed
  FROM heads),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM digests),
low AS (
  SELECT 0 AS level, t, i, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, t, i // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY t) AS n FROM low) WHERE n > 1 GROUP BY level, t, i // 8),
subroots AS (SELECT t, arg_max(h, level) AS subroot FROM low GROUP BY t),
high AS (
  SELECT 0 AS level, -1 AS t, t AS i, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, t, i // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY level, t, i // 8),
nodes AS (
  SELECT *, count(*) OVER (PARTITION BY t, level) AS n
  FROM (SELECT * FROM low UNION ALL SELECT * FROM high)),
sides AS (
  SELECT a.t, a.level, a.i,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS g
  FROM nodes a JOIN nodes b ON a.t = b.t AND a.level = b.level AND a.i // 8 = b.i // 8
  WHERE a.n > 1 GROUP BY a.t, a.level, a.i),
inner_ AS (
  SELECT r, t, i, 0 AS level, '' AS proof, coalesce(changed, leaf) AS h FROM leaves
  UNION ALL
  SELECT f.r, f.t, f.i // 8, f.level + 1, f.proof || s.l || s.g, sha256(s.l || f.h || s.g)
  FROM inner_ f JOIN sides s ON f.t = s.t AND f.level = s.level AND f.i = s.i),
outer_ AS (
  SELECT r, t AS i, 0 AS level, proof, h
  FROM (SELECT r, t, arg_max(proof, level) AS proof, arg_max(h, level) AS h FROM inner_ GROUP BY r, t)
  UNION ALL
  SELECT f.r, f.i // 8, f.level + 1, f.proof || s.l || s.g, sha256(s.l || f.h || s.g)
  FROM outer_ f JOIN sides s ON s.t = -1 AND f.level = s.level AND f.i = s.i),
ends AS (SELECT r, arg_max(proof, level) AS proof, arg_max(h, level) AS h FROM outer_ GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM leaves JOIN subroots USING (t) JOIN ends USING (r)
     CROSS JOIN (SELECT arg_max(h, level) AS root FROM high)
"""


@query("op11_manifest", OP11_SQL)
def _(table) -> DataFrame:
    """Where 3 divides the crc32 of the id, the text is put in lower case (A to Z only)."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return manifest.prove(table("documents"), changed,
                          lambda text: F.translate(text, upper, upper.lower()))


@query("op12_token_counts")
def _(table) -> DataFrame:
    return lengths.count_tokens(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""


@query("op13_hard_negatives", OP13_SQL)
def _(table) -> DataFrame:
    """Every seventh label is wrong on purpose, every fiftieth row is an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table("embeddings").withColumn("label", label)
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)
