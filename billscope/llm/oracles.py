"""The queries of this package as SQL, where SQL expresses them."""



def _escaped(column: str) -> str:
    """The chat template's escapes."""
    out = f"replace({column}, '\\', '\\\\')"
    for control in ("<s>", "</s>", "[INST]", "[/INST]", "[CTX]"):
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


ORACLES = {
    "op2_decontamination": """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS words
  FROM (SELECT item_id, words, least(10, len(words)) AS size,
          unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
        FROM item WHERE len(words) > 0)
), sizes AS (
  SELECT DISTINCT size FROM item_window
), doc_window AS (
  SELECT doc_id, size, pos, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS words
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM doc, sizes WHERE len(words) >= size)
), hit AS (
  SELECT doc_id, size, pos, item_id FROM doc_window JOIN item_window USING (size, words)
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT doc_id, size, pos FROM hit))
  GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op6_chat_formatting": """
WITH chat AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), counted AS (
  SELECT *, strlen(ESC_ROLE) + strlen(ESC_TEXT) + 19 AS tokens,
    length(ESC_ROLE) + length(ESC_TEXT) + 7 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM chat
), headed AS (
  SELECT *, coalesce(max(CASE WHEN place = 0 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS head_tokens,
    max(CASE WHEN place = 0 THEN chars END) OVER (PARTITION BY conv_id) AS head_chars
  FROM counted
), sized AS (
  SELECT *, place = 0 AND head_tokens > 0 AS head, greatest(4096 - 512 - head_tokens, 1024) AS span,
    CASE WHEN place = 0 AND head_tokens > 0 THEN 0 ELSE tokens END AS size
  FROM headed
), started AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) - size AS start FROM sized
), placed AS (
  SELECT *, 2 * (start // span) + CASE WHEN size > 0 AND (start + size - 1) // span > start // span THEN 1 ELSE 0 END AS part
  FROM started
), part AS (
  SELECT conv_id, part, min(start) AS opens, min(place) AS first_place, any_value(head_tokens) AS head_tokens,
    any_value(head_chars) AS head_chars
  FROM placed GROUP BY conv_id, part
), again AS (
  SELECT part.conv_id, sum(chars + 5 + 6) AS chars
  FROM part JOIN placed USING (conv_id)
  WHERE NOT head AND size <= 512 AND place < first_place AND opens - start <= 512 GROUP BY part.conv_id
), again_head AS (
  SELECT conv_id, sum(head_chars + 5 + 6) AS chars FROM part WHERE first_place > 0 AND head_tokens > 0 GROUP BY conv_id
), own AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(chars + CASE WHEN role = 'assistant' THEN 7 ELSE 6 END) AS chars
  FROM placed GROUP BY conv_id
)
SELECT own.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(own.chars + coalesce(again.chars, 0) + coalesce(again_head.chars, 0) AS BIGINT) AS formatted_chars
FROM own LEFT JOIN again ON own.conv_id IS NOT DISTINCT FROM again.conv_id
  LEFT JOIN again_head ON own.conv_id IS NOT DISTINCT FROM again_head.conv_id
""".replace("ESC_ROLE", _escaped("role")).replace("ESC_TEXT", _escaped("text")),
    "op7_embedding_dedup": """
WITH RECURSIVE vector AS (
  SELECT row_number() OVER () AS place, vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
    coalesce(label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0, false) AS fit
  FROM embeddings
), link AS (
  SELECT a.place AS a, b.place AS b FROM vector a JOIN vector b
    ON a.label = b.label AND a.place <> b.place AND len(a.v) = len(b.v) AND a.fit AND b.fit
    AND list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
  SELECT place AS node, place AS other FROM vector
  UNION
  SELECT reached.node, link.b FROM reached JOIN link ON reached.other = link.a
), component AS (
  SELECT node, min(vec_id) AS component_id FROM reached JOIN vector ON other = place GROUP BY node
), counted AS (
  SELECT a, count(*) AS n_links FROM link GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM vector JOIN component ON node = place LEFT JOIN counted ON a = place
""",
    "op8_substring_dedup": """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), doc_window AS (
  SELECT doc_id, pos, array_to_string(list_slice(words, pos, pos + 19), ' ') AS words
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM doc WHERE len(words) >= 20)
), again AS (
  SELECT doc_id, pos FROM doc_window
  QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM again
), word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM doc
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
""",
    "op11_prefix_trie": """
WITH RECURSIVE conv AS (
  SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT c, CAST(c AS VARCHAR) AS digits, 0 AS bit, 4294967295::BIGINT AS v FROM conv
  UNION ALL
  SELECT c, digits, bit + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM (SELECT c, digits, bit, CASE WHEN bit % 8 = 0 THEN xor(v, ascii(digits[bit // 8 + 1])::BIGINT) ELSE v END AS v
        FROM crc WHERE bit < 8 * length(digits))
), opening AS (
  SELECT c, xor(v, 4294967295) % 6 AS h, c - ((c % 100) + 100) % 100 AS first FROM crc WHERE bit = 8 * length(digits)
), said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) - 1 AS place FROM said
), built AS (
  SELECT c, place + 1 AS depth, digest, text FROM opening JOIN own ON own.conv_id = first WHERE place < h
  UNION ALL
  SELECT c, least(h, coalesce(n, 0)) + place - h + 1, digest, text
  FROM opening JOIN own ON own.conv_id = c
  LEFT JOIN (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id) b ON b.conv_id = first WHERE place >= h
), prefix AS (
  SELECT c, 0 AS depth, '' AS key, '' AS text FROM conv
  UNION ALL
  SELECT c, depth, string_agg(digest, '') OVER (PARTITION BY c ORDER BY depth), text FROM built
), node AS (
  SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(text) AS text FROM prefix GROUP BY key, depth
), child AS (
  SELECT left(key, 64 * (depth - 1)) AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL
), known AS (
  SELECT node.*, coalesce(n, 0) AS n_children, (n_convs - 1) * length(text) AS saved FROM node LEFT JOIN child USING (key)
), subtree AS (
  SELECT left(key, 64 * level) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS level FROM known) GROUP BY ALL
), ending AS (
  SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT * FROM prefix QUALIFY row_number() OVER (PARTITION BY c ORDER BY depth DESC) = 1) GROUP BY key
)
SELECT known.conv_id, CAST(known.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, known.n_convs, n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(subtree.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM known JOIN subtree USING (key) LEFT JOIN ending USING (key)
  LEFT JOIN node parent ON known.depth > 0 AND parent.key = left(known.key, 64 * (known.depth - 1))
""",
    "op13_phrase_collocations": """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), spoken AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM piece
), total AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM spoken GROUP BY lang
), gram AS (
  SELECT lang, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM spoken, (SELECT unnest([1, 2, 3]) AS size) WHERE len(words) >= size)
  GROUP BY ALL HAVING count(*) >= 10
), candidate AS (
  SELECT *, string_split(phrase, ' ') AS words FROM gram WHERE size > 1
), cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
    CAST(1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate) c
  JOIN gram l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
  JOIN gram r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase
    FROM candidate WHERE size = 3) GROUP BY lang, phrase
), ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
  FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.phrase = best.phrase
  WHERE longer.f IS NULL OR 100 * longer.f < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
}
