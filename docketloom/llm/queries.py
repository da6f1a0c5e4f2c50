"""The operators' queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, filteraudit, htmltext, langid, linededup, merkle, mpeg, neardup, packing, secrets, tokenfile, toxicity
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.digest(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.with_probe(table(spark, sf_dir, "conversations")))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine; every executor has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.digest(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontamination": op2_decontamination,
    "op3_mpeg_audio": op3_mpeg_audio,
    "op4_chat_format": op4_chat_format,
    "op5_packing": op5_packing,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_token_files": op7_token_files,
    "op8_html_text": op8_html_text,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_line_dedup": op11_line_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_OP4 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

_OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id JOIN c ON c.x = documents.doc_id
"""

_OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT r, doc_id, line, place, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON f.key = k.key GROUP BY r, doc_id
"""

_OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY t) AS smallest FROM d),
f AS (SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b, 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > smallest, false) AS e FROM w),
s AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (s.good) AS good, count(*) FILTER (s.toxic) AS toxic FROM f LEFT JOIN s USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT v.x || w.x || x.x || y.x || z.x AS filter_order FROM x v, x w, x, x y, x z WHERE len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5),
g AS (SELECT part, filter_order, least(CASE WHEN a THEN strpos(filter_order, 'A') ELSE 9 END, CASE WHEN b THEN strpos(filter_order, 'B') ELSE 9 END, CASE WHEN c THEN strpos(filter_order, 'C') ELSE 9 END,
  CASE WHEN d THEN strpos(filter_order, 'D') ELSE 9 END, CASE WHEN e THEN strpos(filter_order, 'E') ELSE 9 END) AS step, n, good, toxic FROM m, o),
r AS (SELECT part, filter_order, step, sum(n) AS removed, sum(good) AS good_lost, sum(toxic) AS toxic_lost FROM g GROUP BY ALL),
p AS (SELECT part, sum(n) AS docs FROM m GROUP BY part),
l AS (SELECT part, x, sum(n) FILTER (CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS fails,
  sum(n) FILTER (CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AND a::INT + b::INT + c::INT + d::INT + e::INT = 1) AS lone FROM m, x GROUP BY ALL),
q AS (SELECT p.part, docs, filter_order, step, substr(filter_order, step, 1) AS x, coalesce(removed, 0) AS removed, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost
  FROM p CROSS JOIN o CROSS JOIN (SELECT unnest(range(1, 6)) AS step) LEFT JOIN r USING (part, filter_order, step))
SELECT q.part, filter_order, step::INT AS step, (docs - sum(removed) OVER (PARTITION BY q.part, filter_order ORDER BY step))::BIGINT AS kept, removed::BIGINT AS removed,
  (coalesce(fails, 0) - removed)::BIGINT AS redundant, coalesce(lone, 0)::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY q.part, q.x))::BIGINT AS shapley
FROM q LEFT JOIN l ON l.part = q.part AND l.x = q.x
"""

_OP13 = r"""
WITH RECURSIVE c AS (SELECT doc_id, lang, text, [coalesce(strlen(v) || ':' || v, '-') FOR v IN [doc_id::VARCHAR, source, lang, n_chars::VARCHAR]] AS front,
  list_reduce([4294967295] || [ascii(b)::BIGINT FOR b IN string_split(doc_id::VARCHAR, '')],
    lambda u, b: list_reduce([xor(u, b)] || [-1, -1, -1, -1, -1, -1, -1, -1], lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc FROM documents),
a AS (SELECT doc_id, lang, sha256(array_to_string(front, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS told, front FROM c),
leaves AS (SELECT doc_id, lang, leaf, sha256(array_to_string(front, '') || coalesce(strlen(told) || ':' || told, '-')) AS forged,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM a),
tree AS (SELECT lang, 0 AS lv, i, n, leaf AS h FROM leaves
  UNION ALL SELECT lang, lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lang, lv, i // 8, n),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (SELECT 0 AS lv, i, n, subroot AS h FROM subs
  UNION ALL SELECT lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lv, i // 8, n),
ups AS (SELECT t.lang, t.lv, t.i, t.h FROM tree t WHERE t.n > 1),
deep AS (SELECT lang, max(lv) AS levels FROM tree GROUP BY lang),
runs AS (SELECT x.doc_id, x.leaf, x.i AS pos, u.lv AS lv, u.i, u.h, u.i = x.i // (8 ** u.lv)::BIGINT AS own FROM leaves x JOIN ups u ON u.lang IS NOT DISTINCT FROM x.lang AND u.i // 8 = x.i // (8 ** (u.lv + 1))::BIGINT
  UNION ALL SELECT x.doc_id, x.leaf, x.i, deep.levels + o.lv, o.i, o.h, o.i = s.i // (8 ** o.lv)::BIGINT
    FROM leaves x JOIN subs s ON s.lang IS NOT DISTINCT FROM x.lang JOIN deep ON deep.lang IS NOT DISTINCT FROM x.lang JOIN top o ON o.n > 1 AND o.i // 8 = s.i // (8 ** (o.lv + 1))::BIGINT),
fold AS (SELECT lang, i AS pos, 0 AS lv, forged AS h FROM leaves
  UNION ALL SELECT fold.lang, fold.pos, fold.lv + 1, sha256(string_agg(CASE WHEN r.own THEN fold.h ELSE r.h END, '' ORDER BY r.i))
    FROM fold JOIN leaves x ON x.i = fold.pos AND x.lang IS NOT DISTINCT FROM fold.lang JOIN runs r ON r.doc_id IS NOT DISTINCT FROM x.doc_id AND r.leaf = x.leaf AND r.pos = x.i AND r.lv = fold.lv GROUP BY fold.lang, fold.pos, fold.lv),
ends AS (SELECT lang, pos, arg_max(h, lv) AS h FROM fold GROUP BY lang, pos),
proofs AS (SELECT doc_id, leaf, pos, string_agg(h, '' ORDER BY lv, i) FILTER (NOT own) AS p FROM runs GROUP BY doc_id, leaf, pos)
SELECT x.doc_id, x.leaf, s.subroot, root.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM leaves x JOIN subs s ON s.lang IS NOT DISTINCT FROM x.lang JOIN (SELECT h FROM top WHERE n = 1) root ON true
JOIN ends e ON e.lang IS NOT DISTINCT FROM x.lang AND e.pos = x.i LEFT JOIN proofs p ON p.doc_id IS NOT DISTINCT FROM x.doc_id AND p.leaf = x.leaf AND p.pos = x.i
"""

ORACLES: dict[str, str] = {"op11_line_dedup": _OP11, "op12_filter_audit": _OP12, "op13_merkle_manifest": _OP13, "op4_chat_format": _OP4, "op6_near_duplicates": _OP6}
