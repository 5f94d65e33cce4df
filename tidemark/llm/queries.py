"""The operators of this subpackage over the given tables, with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (bpe_count, bradley_terry, collocations, cover_tree, elias_fano,
                          licenses, order_minhash, packing, periodic_runs, skip_chain_pii,
                          soft_mix, toxicity, vp_tree)
from tidemark.llm.shared import fold
from tidemark.sources.shared_folder import new_path

WINDOW = 4096
#: A document is good, or toxic, from this score on.
CUT = 0.7


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nnls_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=WINDOW)
    return packing.digest(pieces)


def op2_elias_fano_files(spark, sf_dir):
    folder = new_path(spark, "token-files")
    elias_fano.write_token_files(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=0)
    return elias_fano.digest(elias_fano.read_token_files(spark, folder))


def scored(rows, folds, held_out, cut):
    """The columns that a scoring query returns; a null id is in no fold."""
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def op3_order_minhash_near_dedup(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_vp_tree_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vp_tree.nearest(vectors, F.col("vec_id") % 50 == 0, k=5, factor=1.0)


def op5_bradley_terry_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    ranking = bradley_terry.learn(docs, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return scored(bradley_terry.score(docs, ranking, keep=["doc_id"]), 4, 2, CUT)


def op6_heap_token_counts(spark, sf_dir):
    counts = bpe_count.count_tokens(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("piece_bpe_32k.model"))
    return bpe_count.flag_long(counts, WINDOW)


def op7_lexicon_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return scored(toxicity.score(docs, lexicon, keep=["doc_id"]), 3, 1, CUT)


#: Weights of the languages in the mixture.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def labelled_languages(docs, labels):
    """The languages of the rows that the labels table lists: all others are predicted."""
    listed = labels.select("doc_id").distinct()
    return docs.join(listed, "doc_id", "left_semi").select("doc_id", F.col("lang").alias("domain"))


def op8_soft_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labelled = labelled_languages(docs, table(spark, sf_dir, "labels"))
    return soft_mix.soft_mix(docs, labelled, TARGETS)


def op9_cover_tree_pairs(spark, sf_dir):
    return cover_tree.similar_vectors(table(spark, sf_dir, "embeddings"))


def op10_license_scan(spark, sf_dir):
    """Documents stand in directories by source and language."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        "text")
    return licenses.scan(files)


def op11_skip_chain_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return skip_chain_pii.digest(skip_chain_pii.find(docs, skip_chain_pii.learn(docs)))


def op12_baier_runs(spark, sf_dir):
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"),
                                    change=periodic_runs.cycled_by_id)
    return periodic_runs.digest(found)


def op13_rollup_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_nnls_packing, op2_elias_fano_files, op3_order_minhash_near_dedup,
    op4_vp_tree_neighbours, op5_bradley_terry_quality, op6_heap_token_counts,
    op7_lexicon_toxicity, op8_soft_mix, op9_cover_tree_pairs,
    op10_license_scan, op11_skip_chain_pii, op12_baier_runs, op13_rollup_collocations)}

VECTORS = """
v AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS e FROM embeddings
  WHERE vec_id IS NOT NULL GROUP BY vec_id),
squares AS (
  SELECT vec_id, e, CASE WHEN len(e) > 0 AND list_count(e) = len(e)
                         THEN list_dot_product(e, e) END AS square FROM v),
sound AS (
  SELECT vec_id, e, sqrt(square) AS norm FROM squares WHERE isfinite(square) AND square > 0)"""

#: Only where SQL can express the operator: by comparing all vectors, counting all phrases.
ORACLE = {
    "op4_vp_tree_neighbours": f"""
WITH {VECTORS.strip()},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (q.norm * c.norm) AS score
  FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    AND len(c.e) = len(q.e)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                 AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op9_cover_tree_pairs": f"""
WITH RECURSIVE {VECTORS.strip()},
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reached AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT reached.vec_id, links.b FROM reached JOIN links ON reached.other = links.a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
components AS (SELECT vec_id, min(other) AS component FROM reached GROUP BY vec_id)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       coalesce(component, vec_id) = vec_id AS kept
FROM v LEFT JOIN counted USING (vec_id) LEFT JOIN components USING (vec_id)""",
    "op13_rollup_collocations": r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda w: w <> '') AS ws
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split(regexp_replace(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]', '.', 'g'), '.')) AS piece
    FROM documents)),
grams AS (
  SELECT lang, unnest([1, 2, 3]) AS words, a, b, c
  FROM (SELECT lang, unnest(ws) AS a, unnest(ws[2:] || [NULL]) AS b,
               unnest(ws[3:] || [NULL, NULL]) AS c FROM pieces WHERE len(ws) > 0)
  WHERE a IS NOT NULL),
phrases AS (
  SELECT lang, words, phrase, count(*) AS f
  FROM (SELECT lang, words, a || CASE WHEN words >= 2 THEN ' ' || b ELSE '' END
                 || CASE WHEN words = 3 THEN ' ' || c ELSE '' END AS phrase FROM grams)
  WHERE phrase IS NOT NULL GROUP BY lang, words, phrase),
sums AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE words = 1 GROUP BY lang),
parts AS (SELECT lang || chr(10) || phrase AS part, f FROM phrases WHERE words <= 2 AND f >= 10),
candidates AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws
  FROM phrases WHERE words >= 2 AND f >= 10),
cut AS (
  SELECT *, lang || chr(10) || array_to_string(ws[1:k], ' ') AS head,
         lang || chr(10) || array_to_string(ws[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)),
cuts AS (
  SELECT lang, words, phrase, a, k, x.f AS l, y.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN parts x ON x.part = head JOIN parts y ON y.part = rest),
scored AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, inner_phrase AS phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS inner_phrase
        FROM candidates WHERE words = 3) GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < 50 * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sums USING (lang)
WHERE rank <= 2000""",
}
