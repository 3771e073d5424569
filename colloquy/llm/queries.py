"""The training-data operators as registered queries over the driver's tables, with SQL where SQL can state them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import ann, bytededup, chat, decontaminate, htmltext, linededup, mixing, neardup, quality, substring, tokens, trie, whitening
from colloquy.llm.common import read


#: A sentencepiece model whose pieces are the word-piece vocabulary; read on the driver only.
PIECES_PATH = os.environ.get("COLLOQUY_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match word pieces of every document."""
    return tokens.token_counts(read(spark, sf_dir, "documents"), tokens.load_pieces(PIECES_PATH))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the source targets; labelled quality weighs the draw."""
    return mixing.mix_sources(read(spark, sf_dir, "documents"), mixing.label_weights(read(spark, sf_dir, "labels")))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(rows.unionByName(own)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the classifier trained on the labelled rows that are not held out."""
    scored = quality.score(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20, among all vectors."""
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one, equal or nearly so."""
    out = linededup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "emptied", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage near to a benchmark item, with the item and the place."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word windows that start in an earlier document."""
    out = substring.remove_repeats(read(spark, sf_dir, "documents"), 13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, with weights learned from the pages that mark their article."""
    return htmltext.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), neardup.NearDup(shingle_words=3, percent=85))


def op11_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 largest components of the distinct vectors' covariance, scaled to unit variance."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), 16)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with what its subtree shares."""
    return trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier in the corpus."""
    out = bytededup.remove_repeated_bytes(read(spark, sf_dir, "documents"), 100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_mix_sources,
        op3_chat_format,
        op4_quality,
        op5_nearest_vectors,
        op6_line_dedup,
        op7_decontaminate,
        op8_substring_dedup,
        op9_html_text,
        op10_near_duplicates,
        op11_whitened_vectors,
        op12_prefix_trie,
        op13_suffix_dedup,
    )
}

_SAID = "'</s>[INST] ok [/INST]'"

# Lengths of the default template's marks, and its control strings.
_CHAT_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_SAID} UNION ALL SELECT -7, 1, 'assistant', {_SAID}),
e AS (
  SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY turn, r, t) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, r DESC, t DESC) = 1 AS is_last,
    length(replace(t, '\', '\\')) + len(regexp_extract_all(t, '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<ROLE>>|<<:>>|<</ROLE>>'))
      + CASE r WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 8
          ELSE 25 + length(replace(r, '\', '\\')) + len(regexp_extract_all(r, '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<ROLE>>|<<:>>|<</ROLE>>')) END AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(coalesce(before, '') || '>' || r IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (NOT is_last OR r = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""

_SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i,
        unnest(list_transform(generate_series(1, len(w) - 12), lambda i: array_to_string(w[i:i + 12], ' '))) AS k
      FROM d WHERE len(w) >= 13),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS earliest FROM p),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS j FROM f WHERE earliest < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS j FROM d),
k AS (SELECT x.doc_id, count(g.j) AS n_removed, string_agg(word, ' ' ORDER BY x.j) FILTER (g.j IS NULL) AS kept
      FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.j = x.j GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

_NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - 2, 1)), lambda i: array_to_string(w[i:i + 2], ' '))) AS g
      FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, place) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.place),
m AS (SELECT doc_id, min(place) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id,
  coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""

ORACLE_SQL = {
    "op2_mix_sources": mixing.SQL,
    "op3_chat_format": _CHAT_SQL,
    "op8_substring_dedup": _SUBSTRING_SQL,
    "op10_near_duplicates": _NEAR_SQL,
    "op12_prefix_trie": trie.SQL,
    "op13_suffix_dedup": bytededup.SQL,
}
