"""Queries of this subpackage over the given tables, and their checks in SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from listora.llm import chat_format, decontaminate, html_text, language_id, lm_score, packing, phrases, quality_rules
from listora.llm import spelling, substring_dedup, token_counts, topk_search
from listora.llm.near_dedup import near_duplicates
from listora.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# One scalar for words of a text in DuckDB: runs other than ASCII white space, A-Z folded or not.
FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"


@query("op1_topk_search", """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS parts FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.parts AS asked, c.vec_id, list_sum(list_transform(range(1, len(q.parts) + 1), lambda i: q.parts[i] * c.parts[i]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.parts) = len(q.parts) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 10""")
def _topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_scores(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&"))


def _decoded(text: str) -> str:
    for written, plain in _ENTITIES:
        text = f"replace({text}, '{written}', '{plain}')"
    return text


# The given pages mark their article, so the text the rules should find can be cut out by pattern.
@query("op3_html_text", f"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>|</?b>', ' ', 'g') AS a FROM pages),
b AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'),
  lambda x: trim(regexp_replace({_decoded("x")}, '\\s+', ' ', 'g'))), lambda x: x <> '') AS b FROM a)
SELECT page_id, url, coalesce(array_to_string(b, chr(10)), '') AS text, coalesce(length(array_to_string(b, chr(10))), 0)::BIGINT AS n_chars FROM b""")
def _html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


@query("op4_near_dedup", f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(FOLD.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.seen)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.seen) AS component_id, d.doc_id = min(r.seen) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, n.n""")
def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("set_digest")


@query("op2_packing")
def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, longest=4096, with_ids=False
    )


@query("op5_token_counts")
def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096
    )


@query("op6_language_id")
def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


@query("op7_decontaminate")
def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_substring_dedup", f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
m AS (SELECT win, min(doc_id) AS least FROM p GROUP BY 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM p JOIN m USING (win) WHERE least < doc_id),
r AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws
    ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)""")
def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(table(spark, sf_dir, "documents")).drop("spans")


def _marked(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '&', '&amp;'), '</s>', '&lt;/s>'), '[INST]', '&#91;INST]'), '[/INST]', '&#91;/INST]')"


def _plain(text: str) -> str:
    return f"replace(replace(replace({text}, '&#91;', '['), '&lt;', '<'), '&amp;', '&')"


@query("op10_chat_format", f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))),
f AS (SELECT *, role LIKE '%[/INST]%' OR contains(role || text, '</s>') OR {_plain("role")} <> role OR {_plain("text")} <> text AS clash FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS told,
  coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
  sum(length('[INST][/INST]</s>') + CASE WHEN clash THEN length({_marked("role")}) + length({_marked("text")}) ELSE length(role) + length(text) END) AS n
  FROM f GROUP BY 1)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, n::BIGINT AS formatted_chars FROM c""")
def _chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat_format.chat_digests(chat_format.chat_texts(turns))


@query("op9_lm_score")
def _lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


# crc32 by half bytes: the low half of a byte goes first. The sixteen values follow from the polynomial.
def _crc_half(value: int) -> int:
    for _ in range(4):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


_HALVES = f"[{', '.join(str(_crc_half(half)) for half in range(16))}]"


def _crc32(text: str) -> str:
    digit = "(instr('0123456789ABCDEF', substr(h, (i - i % 2 + 2 - i % 2)::BIGINT, 1)) - 1)::BIGINT"
    halves = f"list_transform(range(0, len(h)), lambda i: {digit})"
    return (
        f"(SELECT xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {halves}),"
        f" lambda c, d: xor({_HALVES}[(xor(c, d) & 15) + 1]::BIGINT, c >> 4))) FROM (SELECT hex(encode({text})) AS h))"
    )


@query("op11_spelling_variants", f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({FOLD.format("coalesce(text, '')")}, '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY 1, 2),
h AS (SELECT run, n, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM d),
c AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
p AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
one AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM p a JOIN p b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM w a JOIN p b ON b.less = a.word
  UNION SELECT b.word, b.n, a.word, a.n FROM w a JOIN p b ON b.less = a.word),
k AS (SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM one QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
  CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM w LEFT JOIN k ON k.word = w.word),
t AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON f.word = t.next)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN t ON t.word = f.word WHERE t.next IS NULL""")
def _spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op12_phrase_collocations", f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM d),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, unnest(range(1, 6)) AS x(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
kept AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (FROM f AS b WHERE b.lang = f.lang AND b.k > f.k AND b.a >= f.a AND contains(' ' || b.phrase || ' ', ' ' || f.phrase || ' '))),
c AS (SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS first, array_to_string(ws[j + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS j FROM kept)),
s AS (SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM c JOIN t ON t.lang = c.lang JOIN f l ON l.lang = c.lang AND l.phrase = first JOIN f r ON r.lang = c.lang AND r.phrase = rest),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM m QUALIFY rank <= 2000""")
def _phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


# The rules and measurements of the ledger, in SQL.
@query("op13_quality_rules", f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
p AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
b AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
r AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM b) GROUP BY 1),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(text, '\\P{{L}}+', '', 'g'))::BIGINT AS n_letters,
  length(regexp_replace(text, '\\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper, length(regexp_replace(text, '[^!]+', '', 'g'))::BIGINT AS n_shouts
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
f AS (SELECT *, ({" + ".join(f"CASE WHEN {rule.fails} THEN {1 << rule.bit} ELSE 0 END" for rule in quality_rules.RULES)})::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {quality_rules.BASE.mask()} > 0 AS base_failed, failed = 0 AS kept, failed FROM f""")
def _quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.ledger(table(spark, sf_dir, "documents"))
    judged = quality_rules.verdicts(found, quality_rules.PROSE)
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.BASE.mask()).cast("long")) != 0
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed"
    )
