"""Queries of the corpus operators: name -> builder(spark, sf_dir), and the
DuckDB statement of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import common

Builder = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Builder]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_register("op10_token_files")
def op10(spark, sf_dir):
    from . import token_files
    return token_files.round_trip(common.table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"))


@_register("op6_packing")
def op6(spark, sf_dir):
    from . import packing
    return packing.pack_documents(common.table(spark, sf_dir, "documents"))


@_register("op3_decontaminate")
def op3(spark, sf_dir):
    from . import decontaminate
    return decontaminate.report(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


@_register("op9_fingerprints")
def op9(spark, sf_dir):
    from . import fingerprints
    return fingerprints.compare(common.table(spark, sf_dir, "documents"))


@_register("op2_quality")
def op2(spark, sf_dir):
    from . import quality
    return quality.predict(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@_register("op5_minhash")
def op5(spark, sf_dir):
    from . import minhash
    return minhash.groups(common.table(spark, sf_dir, "documents"))


@_register("op1_suffix_dedup")
def op1(spark, sf_dir):
    from . import suffix_dedup
    return suffix_dedup.remove_repeats(common.table(spark, sf_dir, "documents"))


@_register("op8_line_dedup")
def op8(spark, sf_dir):
    from . import lines
    return lines.report(common.table(spark, sf_dir, "documents"))


@_register("op4_tool_calls", """
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
asked AS (SELECT DISTINCT conv_id, turn FROM c WHERE role = 'user'),
e AS (
  SELECT c.*, CASE WHEN role = 'user' THEN 'call' WHEN a.turn IS NOT NULL THEN 'result' ELSE 'message' END AS kind,
         CASE WHEN role = 'user' THEN c.conv_id || ':' || c.turn WHEN a.turn IS NOT NULL THEN c.conv_id || ':' || a.turn END AS call_id
  FROM c LEFT JOIN asked a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 AND c.role = 'assistant'),
firsts AS (
  SELECT conv_id, call_id, kind, min(struct_pack(t := turn, m := md5(text))) AS first
  FROM e WHERE call_id IS NOT NULL GROUP BY ALL),
r AS (
  SELECT e.*, k.first AS k, s.first AS s FROM e
  LEFT JOIN firsts k ON k.kind = 'call' AND k.conv_id = e.conv_id AND k.call_id = e.call_id
  LEFT JOIN firsts s ON s.kind = 'result' AND s.conv_id = e.conv_id AND s.call_id = e.call_id),
x AS (
  SELECT *, CASE WHEN kind = 'call' AND (k.t <> turn OR k.m <> md5(text)) THEN 'identifier repeated'
                 WHEN kind = 'result' AND k IS NULL THEN 'no such call'
                 WHEN kind = 'result' AND (s.t <> turn OR s.m <> md5(text)) THEN 'result repeated' END AS error
  FROM r)
SELECT conv_id, turn, 0 AS pos, kind, call_id,
       CASE kind WHEN 'call' THEN s.t WHEN 'result' THEN k.t END AS linked_turn,
       CASE WHEN kind = 'call' THEN 0 END AS level,
       CASE WHEN kind <> 'message' THEN error IS NULL END AS valid, error,
       CASE kind WHEN 'call' THEN to_json({'arguments': {'prompt': text}, 'id': call_id, 'name': 'reply', 'type': 'function'})
                 WHEN 'result' THEN to_json({'content': text, 'role': 'tool', 'tool_call_id': call_id})
                 ELSE to_json({'content': text, 'role': role}) END::VARCHAR AS json
FROM x
""")
def op4(spark, sf_dir):
    from . import toolcalls
    return toolcalls.format_chats(common.table(spark, sf_dir, "conversations"))


@_register("op7_html_extract")
def op7(spark, sf_dir):
    from . import html_extract
    return html_extract.extract(common.table(spark, sf_dir, "pages"))


@_register("op11_ranked_search", r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, totals GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY ALL)
SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
FROM scores WHERE score > 0
QUALIFY rank <= 10
""")
def op11(spark, sf_dir):
    from . import ranking
    return ranking.search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


@_register("op12_spelling", """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\\x{C0}-\\x{FF}]+')) AS run
        FROM documents)
  GROUP BY ALL),
bits AS (
  SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: flatten(list_transform(
              CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END,
              lambda b: list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: ((b >> i) & 1)::BIGINT))))) AS bits
  FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], bits),
                     lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h
  FROM bits),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word)))::INTEGER AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near
  FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS place FROM words
  UNION ALL
  SELECT walk.word, form FROM walk JOIN formed ON formed.word = place WHERE form IS NOT NULL)
SELECT f.word, f.form, place AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk ON walk.word = f.word JOIN formed last ON last.word = place WHERE last.form IS NULL
""")
def op12(spark, sf_dir):
    from . import spelling
    return spelling.group_variants(spelling.word_counts(common.table(spark, sf_dir, "documents"), damage=97))


@_register("op13_url_filter")
def op13(spark, sf_dir):
    from . import url_filter
    return url_filter.judge(common.table(spark, sf_dir, "pages"))
