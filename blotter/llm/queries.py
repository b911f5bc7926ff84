"""Queries that the driver registers for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import merkle, toxicity
from .decontaminate import find_contamination
from .fp_search import rank_documents
from .jaccard_join import jaccard_join
from .licenses import scan_licenses
from .line_dedup import line_dedup
from .lm_scores import score_texts
from .mixing import mix_sources
from .nearest import nearest
from .polytope import near_duplicates
from .quality import CUT, held_out, score_quality, train
from .shared import read_table
from .token_counts import count_tokens, read_ranked_pieces

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, read_table(spark, sf_dir, "benchmark"), docs).drop("text")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "neighbours")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents")).rows


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).drop("source")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"), "quality")
    return score_quality(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                             (F.col("score") >= CUT).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, read_ranked_pieces(tokenizer)).drop("text")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op12_fp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    return merkle.verify(merkle.with_case_tampering(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_nearest": op2_nearest,
    "op3_decontaminate": op3_decontaminate,
    "op4_toxicity": op4_toxicity,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_licenses": op10_licenses,
    "op11_near_vectors": op11_near_vectors,
    "op12_fp_search": op12_fp_search,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}

_LINES = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), common AS (
    SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(common.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.k = common.k
GROUP BY doc_id
"""

_MIX = r"""
WITH base AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 9))::BIGINT AS cell
    FROM documents
), ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
    FROM base GROUP BY source
), levels AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
               - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
              / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST)
), plan AS (
    SELECT source, source_size, least((2 * source_size)::DOUBLE, max(level) OVER () * w) AS target FROM levels
), rests AS (
    SELECT *, target - passes * source_size AS rest
    FROM (SELECT *, coalesce(CASE WHEN source_size > 0 THEN least(2, floor(target / source_size)) END, 0)::BIGINT
                    AS passes FROM plan)
), cells AS (
    SELECT source, cell, sum(size)::BIGINT AS s,
           (sum(sum(size)) OVER (PARTITION BY source ORDER BY cell))::BIGINT AS up_to
    FROM base GROUP BY source, cell
), edge AS (
    SELECT r.source, CASE WHEN 2 * (rest - (up_to - s)) >= s THEN cell + 1 ELSE cell END AS below
    FROM rests r JOIN cells c ON r.source IS NOT DISTINCT FROM c.source
    WHERE up_to - s <= rest AND up_to > rest
)
SELECT b.doc_id, b.size, r.source_size, r.target,
       b.size * (r.passes + CASE WHEN b.cell < coalesce(e.below, 0) THEN 1 ELSE 0 END) AS taken
FROM base b JOIN rests r ON b.source IS NOT DISTINCT FROM r.source
LEFT JOIN edge e ON b.source IS NOT DISTINCT FROM e.source
"""

_NEAREST = r"""
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score
    FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CONTAMINATED = rf"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), phrases AS (
    SELECT DISTINCT item_id, k, array_to_string(w[a:a + k - 1], ' ') AS p
    FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS a
          FROM items WHERE len(w) > 0)
), places AS (
    SELECT doc_id, k, a, array_to_string(w[a:a + k - 1], ' ') AS p
    FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS a
          FROM docs, (SELECT DISTINCT k FROM phrases) WHERE len(w) >= k)
), hits AS (
    SELECT doc_id, k, a, item_id FROM places JOIN phrases USING (k, p)
), words AS (
    SELECT doc_id, count(DISTINCT i) AS n_hit
    FROM (SELECT doc_id, unnest(range(a, a + k)) AS i FROM (SELECT DISTINCT doc_id, a, k FROM hits))
    GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT docs.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words ON docs.doc_id = words.doc_id LEFT JOIN found ON docs.doc_id = found.doc_id
"""

_JACCARD = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[a:a + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS a FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), meets AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM meets JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * c >= 75 * (s.n + t.n - c)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes ON docs.doc_id = sizes.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON docs.doc_id = r.a
"""

_NEAR_VECTORS = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS i, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
    SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.i AS a, y.i AS b FROM good x JOIN good y ON x.label = y.label AND x.i <> y.i AND len(x.e) = len(y.e)
    WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), reach AS (
    SELECT i AS a, i AS b FROM v
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), classes AS (
    SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.i = b GROUP BY a
), counts AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN classes ON classes.a = v.i LEFT JOIN counts ON counts.a = v.i
"""

_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_LOWER)

_RANKED = rf"""
WITH found AS (
    SELECT rowid AS doc, doc_id, {_TERMS} AS terms FROM (SELECT *, row_number() OVER () AS rowid FROM documents)
), totals AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_all FROM found WHERE len(terms) > 0
), tfs AS (
    SELECT doc, any_value(doc_id) AS doc_id, any_value(n) AS n, t, count(*) AS tf
    FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS t FROM found) GROUP BY doc, t
), weights AS (
    SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), totals
), items AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark
), scored AS (
    SELECT item_id, doc, any_value(doc_id) AS doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_all))))::BIGINT AS score
    FROM items JOIN weights USING (t) JOIN tfs USING (t), totals GROUP BY item_id, doc
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

#: CRC-32 of a text's bytes, by the table of its polynomial.
_CRC_TABLE = """
crc AS (
    SELECT list(c ORDER BY i) AS tab FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
                              lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i))
)"""

_MERKLE = rf"""
WITH RECURSIVE {_CRC_TABLE}, texts AS (
    SELECT *, CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
                  list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                  lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 5 = 0
              THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
    FROM documents, crc
), heads AS (
    SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-')
              || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
    FROM texts
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS checked
    FROM heads
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM leaves
), levels AS (
    SELECT s, 0 AS depth, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY s
    UNION ALL
    SELECT s, depth + 1, list_transform(range((len(nodes) + 15) // 16),
                                        lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], '')))
    FROM levels WHERE len(nodes) > 1
), subroots AS (
    SELECT s, depth AS height, nodes[1] AS subroot FROM levels WHERE len(nodes) = 1
), tops AS (
    SELECT 0 AS depth, (SELECT list(subroot ORDER BY s) FROM subroots) AS nodes
    UNION ALL
    SELECT depth + 1, list_transform(range((len(nodes) + 15) // 16),
                                     lambda i: sha256(array_to_string(nodes[i * 16 + 1:i * 16 + 16], '')))
    FROM tops WHERE len(nodes) > 1
), steps AS (
    SELECT p.s, p.pos, l.depth, l.nodes, p.pos // (16 ** l.depth)::BIGINT AS i
    FROM placed p JOIN levels l ON l.s = p.s WHERE len(l.nodes) > 1
    UNION ALL
    SELECT p.s, p.pos, u.height + t.depth, t.nodes, p.s // (16 ** t.depth)::BIGINT
    FROM placed p JOIN subroots u ON u.s = p.s, tops t WHERE len(t.nodes) > 1
), flanks AS (
    SELECT s, pos, depth, coalesce(array_to_string(nodes[i - i % 16 + 1:i], ''), '') AS before,
           coalesce(array_to_string(nodes[i + 2:i - i % 16 + 16], ''), '') AS after
    FROM steps
), folds AS (
    SELECT s, pos, 0 AS depth, checked AS acc FROM placed
    UNION ALL
    SELECT f.s, f.pos, f.depth + 1, sha256(k.before || f.acc || k.after)
    FROM folds f JOIN flanks k ON k.s = f.s AND k.pos = f.pos AND k.depth = f.depth
), ends AS (
    SELECT s, pos, arg_max(acc, depth) AS folded_root FROM folds GROUP BY s, pos
), proofs AS (
    SELECT s, pos, sha256(string_agg(before || after, '' ORDER BY depth)) AS proof FROM flanks GROUP BY s, pos
)
SELECT p.doc_id, p.leaf, u.subroot, r.root, coalesce(proof, sha256('')) AS proof_sha256, e.folded_root,
       e.folded_root = r.root AS verified
FROM placed p JOIN subroots u ON u.s = p.s JOIN ends e ON e.s = p.s AND e.pos = p.pos
LEFT JOIN proofs q ON q.s = p.s AND q.pos = p.pos,
     (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1) r
"""

ORACLES: dict[str, str] = {
    "op11_near_vectors": _NEAR_VECTORS,
    "op12_fp_search": _RANKED,
    "op13_merkle_manifest": _MERKLE,
    "op3_decontaminate": _CONTAMINATED,
    "op5_jaccard_join": _JACCARD,
    "op2_nearest": _NEAREST,
    "op6_line_dedup": _LINES,
    "op7_mix_sources": _MIX,
}
