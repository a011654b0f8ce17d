"""The registered queries of this subpackage, on whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lanewatch.llm.collocations import collocations
from lanewatch.llm.common import table
from lanewatch.llm.dual_tree import largest_products
from lanewatch.llm.exact_dedup import copy_report
from lanewatch.llm.jaccard_join import near_groups
from lanewatch.llm.mixing import mix_sources
from lanewatch.llm.nearest import nearest_neighbours
from lanewatch.llm.packing import pack_documents
from lanewatch.llm.page_diff import extract_main_text
from lanewatch.llm.pii import find_personal_data
from lanewatch.llm.suffix_dedup import remove_repeats
from lanewatch.llm.token_alignment import align_tokens
from lanewatch.llm.tool_calls import SCHEMAS, calls_of, link_tool_calls, results_of
from lanewatch.llm.toxicity import toxicity_report

#: The public vocabulary file of the packing query.
PACKING_VOCABULARY = "word_bpe_49k.json"
#: The public vocabulary files that are aligned.
BYTES_VOCABULARY = "byte_bpe_50k.json"
PIECES_VOCABULARY = "piece_bpe_32k.model"


def vocabulary_path(name: str = PACKING_VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pii_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return link_tool_calls(calls_of(conversations), results_of(conversations), SCHEMAS)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_report(table(spark, sf_dir, "documents"))


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), width=3, percent=90)


def op8_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op9_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op10_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op11_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest_products(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(
        table(spark, sf_dir, "documents"), vocabulary_path(BYTES_VOCABULARY),
        vocabulary_path(PIECES_VOCABULARY))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_pii_offsets, op2_toxicity_chain, op3_suffix_dedup, op4_tool_calls, op5_exact_dedup,
        op6_poisson_mixing, op7_ngram_jaccard, op8_hilbert_packing, op9_page_differencing, op10_multiprobe_lsh,
        op11_dual_tree_search, op12_token_alignment, op13_collocations]
    return {function.__name__: function for function in own}


_SPACES = r"'[ \t\n\x0B\f\r]+'"

EXACT_SQL = f"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), {_SPACES}, ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM norm"""


def mixing_sql(documents: str = "documents", seed: int = 17, temperature: float = 0.7,
               columns: str = "doc_id, text, lang, source, n_chars, copy_no, shuffle_key") -> str:
    """The mixture in SQL, with sums of Poisson parts as lists."""
    return f"""
WITH docs AS (SELECT * FROM {documents}),
counts AS (SELECT source, count(*) AS n FROM docs GROUP BY source),
sums AS (SELECT sum(pow(n::DOUBLE, {temperature})) AS w, sum(n)::DOUBLE AS size FROM counts),
rates AS (
  SELECT source, pow(n::DOUBLE, {temperature}) * size / (w * n) AS rate FROM counts, sums),
parts AS (SELECT source, rate, greatest(1, ceil(rate / 16.0))::INT AS parts FROM rates),
steps AS (
  SELECT source, parts, list_transform(range(0, 100), lambda k: list_sum(list_transform(
    range(0, k + 1), lambda j: exp(j * ln(rate / parts) - rate / parts - lgamma(j + 1.0))))) AS steps
  FROM parts),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda j: len(list_filter(steps, lambda s:
    s <= ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || j), 1, 12))::BIGINT
      / 281474976710656.0))))::INT AS n_copies
  FROM docs d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
copies AS (
  SELECT *, unnest(range(1, n_copies + 1))::INT AS copy_no FROM drawn WHERE n_copies > 0)
SELECT {columns} FROM (
  SELECT *, md5('order:{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy_no) AS shuffle_key
  FROM copies)"""


PRODUCTS_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scores)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

_SIGNS = r"'[.,;:!?\n\x0B\f\r]'"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

COLLOCATIONS_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), {_SIGNS})) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM pieces),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM lists GROUP BY lang),
spots AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists),
g1 AS (SELECT lang, ws[i] AS w1, count(*) AS f FROM spots GROUP BY ALL),
g2 AS (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, count(*) AS f
       FROM spots WHERE i < len(ws) GROUP BY ALL HAVING count(*) >= 10),
g3 AS (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3, count(*) AS f
       FROM spots WHERE i + 1 < len(ws) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT g.lang, g.w1 || ' ' || g.w2 AS phrase, g.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM g2 g JOIN g1 x ON x.lang = g.lang AND x.w1 = g.w1 JOIN g1 y ON y.lang = g.lang AND y.w1 = g.w2
  UNION ALL
  SELECT g.lang, g.w1 || ' ' || g.w2 || ' ' || g.w3, g.f, 1, x.f, y.f
  FROM g3 g JOIN g1 x ON x.lang = g.lang AND x.w1 = g.w1
  JOIN g2 y ON y.lang = g.lang AND y.w1 = g.w2 AND y.w2 = g.w3
  UNION ALL
  SELECT g.lang, g.w1 || ' ' || g.w2 || ' ' || g.w3, g.f, 2, x.f, y.f
  FROM g3 g JOIN g2 x ON x.lang = g.lang AND x.w1 = g.w1 AND x.w2 = g.w2
  JOIN g1 y ON y.lang = g.lang AND y.w1 = g.w3),
scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM g3
    UNION ALL SELECT lang, w2 || ' ' || w3, f FROM g3) GROUP BY ALL),
kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inner_phrases i
    ON i.lang = lowest.lang AND i.phrase = lowest.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": EXACT_SQL, "op6_poisson_mixing": mixing_sql(),
            "op11_dual_tree_search": PRODUCTS_SQL, "op13_collocations": COLLOCATIONS_SQL}
