"""DuckDB SQL for the training-data queries that SQL can express.

The others (trained models, UDF-only hashes, connected components) are held against
brute-force versions in tests/llm.
"""

_MIX_SIZES = """
sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size, sqrt(sum(coalesce(length(text), 0) + 1)::DOUBLE) AS w
  FROM documents GROUP BY source),
total AS (SELECT sum(size) AS n, sum(w) AS w FROM sizes),
rates AS (SELECT s.source, s.w / t.w * t.n / s.size AS rate FROM sizes s, total t),
parts AS (SELECT source, rate, greatest(1, ceil(rate / 32.0))::INT AS pieces FROM rates),
pmf AS (
  SELECT source, pieces, k, CASE WHEN rate = 0 THEN (k = 0)::INT::DOUBLE ELSE exp(k * ln(rate / pieces) - rate / pieces - lgamma(k + 1)) END AS p
  FROM parts, range(0, 121) AS r(k)),
cdf AS (SELECT source, pieces, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
tables AS (SELECT source, any_value(pieces) AS pieces, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source),
drawn AS (
  SELECT d.doc_id, d.source, d.text, t.pieces, t.cdf,
    list_sum(list_transform(range(1, t.pieces + 1), lambda i: len(list_filter(t.cdf, lambda c: c <=
      (('0x' || substr(md5('17|' || coalesce(d.doc_id::VARCHAR, '-') || '|' || md5(coalesce(d.text, '')) || '|' || i::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0))))::INT AS n_copies
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT doc_id, source, text, n_copies, unnest(range(1, n_copies + 1))::INT AS copy FROM drawn WHERE n_copies > 0)
"""

# Matches of a backslash or a control string of the chat template: each costs one escape character.
_ESCAPED = r"(\\|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)"

_ENCODED = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_ENCODED.format(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# DuckDB has no crc32: a fold over the digits of the id, eight shifts of the reversed polynomial for each.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))))"""
_TAMPERED = f"(CASE WHEN doc_id IS NOT NULL AND {_CRC32} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END)"

ORACLE_SQL: dict[str, str] = {
    "op9_chat": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + len(regexp_extract_all(role, '{_ESCAPED}')) + len(regexp_extract_all(role, chr(10))) + 1
    + length(text) + len(regexp_extract_all(text, '{_ESCAPED}')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op4_mixing": f"""
WITH {_MIX_SIZES}
SELECT doc_id, source, text, n_copies, copy,
  md5('17|order|' || coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, '')) || '|' || copy::VARCHAR) AS shuffle_key
FROM copies""",
    "op1_decontamination": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, md5(coalesce(text, '-')) AS h, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(13, len(w))::INT AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM spans),
grams AS (
  SELECT doc_id, h, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, h, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.h, g.n, g.i, x.item_id FROM grams g JOIN spans x ON g.n = x.n AND g.s = x.s),
hit_words AS (SELECT doc_id, h, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, h, unnest(range(i, i + n)) AS p FROM hits) GROUP BY ALL),
hit_items AS (
  SELECT doc_id, h, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, h, item_id::VARCHAR AS item FROM hits) GROUP BY ALL)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(a.n_hit, 0)::BIGINT AS n_hit, coalesce(b.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(b.items, '')) AS items_sha256, coalesce(a.n_hit, 0) > 0 AND 20 * coalesce(a.n_hit, 0) >= len(d.w) AS contaminated
FROM words d
LEFT JOIN hit_words a ON d.doc_id IS NOT DISTINCT FROM a.doc_id AND d.h = a.h
LEFT JOIN hit_items b ON d.doc_id IS NOT DISTINCT FROM b.doc_id AND d.h = b.h""",
    "op13_merkle": f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf(_TAMPERED)} AS shown FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM rows),
tree AS (
  SELECT source, 0 AS lvl, i, n, leaf AS node FROM leaves
  UNION ALL
  SELECT source, lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY source, lvl, n, i // 16),
subroots AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, i, n, subroot AS node FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, n, i // 16),
runs AS (SELECT source, lvl, i // 16 AS up, list(node ORDER BY i) AS run FROM tree WHERE n > 1 GROUP BY source, lvl, i // 16),
top_runs AS (SELECT lvl, i // 16 AS up, list(node ORDER BY i) AS run FROM top WHERE n > 1 GROUP BY lvl, i // 16),
walk AS (
  SELECT doc_id, source, leaf, i AS place, i, n, 0 AS lvl, shown AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.place, w.i // 16, (w.n + 15) // 16, w.lvl + 1,
    sha256(array_to_string(r.run[1 : w.i % 16], '') || w.node || array_to_string(r.run[w.i % 16 + 2 :], '')),
    w.proof || array_to_string(r.run[1 : w.i % 16], '') || array_to_string(r.run[w.i % 16 + 2 :], '')
  FROM walk w JOIN runs r ON w.source IS NOT DISTINCT FROM r.source AND w.lvl = r.lvl AND w.i // 16 = r.up WHERE w.n > 1),
top_walk AS (
  SELECT w.doc_id, w.source, w.leaf, w.place, s.subroot, s.i, s.n, 0 AS lvl, w.node, w.proof
  FROM walk w JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.place, w.subroot, w.i // 16, (w.n + 15) // 16, w.lvl + 1,
    sha256(array_to_string(r.run[1 : w.i % 16], '') || w.node || array_to_string(r.run[w.i % 16 + 2 :], '')),
    w.proof || array_to_string(r.run[1 : w.i % 16], '') || array_to_string(r.run[w.i % 16 + 2 :], '')
  FROM top_walk w JOIN top_runs r ON w.lvl = r.lvl AND w.i // 16 = r.up WHERE w.n > 1)
SELECT w.doc_id, w.leaf, w.subroot, t.node AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = t.node AS verified
FROM top_walk w, (SELECT node FROM top WHERE n = 1) t WHERE w.n = 1""",
}
