"""The registered query of each operator, and its DuckDB equivalent where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, langid, mixing, phrases, quality, simhash, suffixes, suffixtree, tokens, trie, urlfilter, vptree
from .common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TRAP = f"{chat.END}{chat.START}assistant ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-1, 0, "user", TRAP), (-1, 1, "assistant", TRAP)], rows.schema)
    turns = rows.unionByName(trap).withColumn("parts", chat.text_parts(F.col("text")))
    out = chat.format_chat(turns).withColumn("turns", chat.read_back(F.col("formatted")))
    out = out.withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss_spans")))
    nl = F.lit("\n")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], nl, t["text"], nl)), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES["op3_chat_format"] = op3_chat_format
ORACLES["op3_chat_format"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{TRAP}' UNION ALL SELECT -1, 1, 'assistant', '{TRAP}'),
e AS (SELECT *, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS et,
             replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;') AS er FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, et)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, et) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('{chat.START}' || er || chr(10) || et || '{chat.END}' || chr(10))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES["op7_mix_sources"] = op7_mix_sources
QUERIES["op10_simhash"] = op10_simhash


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES["op9_suffix_dedup"] = op9_suffix_dedup


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    machine = quality.learned(docs, table(spark, sf_dir, "labels"), ~apart)
    return quality.scored(docs, machine).select("doc_id", apart.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    return langid.identified(docs, langid.learned(docs, ~apart)).select("doc_id", apart.alias("held_out"), "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixtree.scored(table(spark, sf_dir, "documents"), ~held_out("doc_id", 7, 2))
    return found.select("doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES["op1_decontaminate"] = op1_decontaminate
QUERIES["op2_nearest"] = op2_nearest
QUERIES["op4_quality"] = op4_quality
QUERIES["op5_language"] = op5_language
QUERIES["op6_token_counts"] = op6_token_counts
QUERIES["op8_suffix_tree"] = op8_suffix_tree


#: Fixed values of the contract: (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judged(table(spark, sf_dir, "pages"), rules)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    paths = trie.encoded(trie.hashed_turns(table(spark, sf_dir, "conversations")))
    joined = trie.rebased(paths, c - c % 20, (F.crc32(c.cast("string").cast("binary")) % 4).cast("int"), most=3)
    return trie.prefix_trie(joined)


QUERIES["op11_url_filter"] = op11_url_filter
QUERIES["op12_collocations"] = op12_collocations
QUERIES["op13_prefix_trie"] = op13_prefix_trie

ORACLES["op12_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, doc, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, k AS size FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, c.size, s.k, array_to_string(w[1:s.k], ' ') AS lw, array_to_string(w[s.k + 1:], ' ') AS rw
         FROM c JOIN (VALUES (1), (2)) AS s(k) ON s.k < c.size),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, cuts.size, cuts.k, fl.a AS l, fr.a AS r,
                  CAST((1000000::HUGEINT * cuts.a * cuts.a) // (fl.a::HUGEINT * fr.a) AS BIGINT) AS score
           FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = lw JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rw),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, part, max(a) AS most FROM (
             SELECT lang, a, array_to_string(w[1:2], ' ') AS part FROM c WHERE size = 3
             UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE size = 3) GROUP BY lang, part),
kept AS (SELECT x.* FROM weakest x LEFT JOIN around y ON y.lang = x.lang AND y.part = x.phrase WHERE y.most IS NULL OR 100 * y.most < 50 * x.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase COLLATE C) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000"""

ORACLES["op13_prefix_trie"] = r"""
WITH t AS (SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(turn ORDER BY place) AS turns FROM t GROUP BY conv_id),
crc AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS step FROM range(256) AS s(i)),
H AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
                                      lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h FROM own, crc),
built AS (SELECT own.conv_id, list_concat(coalesce(base.turns[1:h], []), own.turns[h + 1:]) AS turns
          FROM own JOIN H USING (conv_id) LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 20),
members AS (SELECT conv_id, turns[1:d] AS path, d, len(turns) = d AS ends FROM built, unnest(range(0, len(turns) + 1)) AS s(d)),
nodes AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
          FROM members GROUP BY path, d),
kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
each AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children,
                CASE WHEN nodes.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(nodes.path[-1].text, '[^\x20\x09-\x0D]+')) END AS saved
         FROM nodes LEFT JOIN kids ON kids.path = nodes.path AND kids.depth = nodes.depth),
up AS (SELECT path[1:d] AS path, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
       FROM each, unnest(range(0, depth + 1)) AS s(d) GROUP BY ALL)
SELECT e.conv_id, e.depth, p.conv_id AS parent_conv_id, e.n_convs, e.n_children, up.n_leaves, CAST(up.saved_tokens AS BIGINT) AS saved_tokens, e.ends_sha256
FROM each e JOIN up ON up.path = e.path AND up.depth = e.depth
LEFT JOIN nodes p ON e.depth > 0 AND p.depth = e.depth - 1 AND p.path = e.path[1:e.depth - 1]"""
