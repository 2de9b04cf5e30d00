"""DuckDB SQL for the queries that SQL can express."""

ORACLES = {
    "op1_mix_sources": """
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1)::BIGINT AS bytes
  FROM documents GROUP BY source
), rates AS (
  SELECT source, 1.0::DOUBLE * (SELECT sum(bytes) FROM sizes)::DOUBLE
    * (1.0::DOUBLE / (SELECT count(*) FROM sizes)::DOUBLE) / bytes::DOUBLE AS rate
  FROM sizes
), rated AS (
  SELECT d.*, rate, greatest(1, ceil(rate / 16.0::DOUBLE))::INTEGER AS parts,
    coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, ''))) AS draw
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), us AS (
  SELECT *, rate / parts AS own,
    list_transform(range(1, parts + 1), lambda i:
      (('0x' || md5('42:' || draw || ':' || i)[1:13])::BIGINT + 0.5::DOUBLE)
        / 4503599627370496.0::DOUBLE) AS u
  FROM rated
), terms AS (
  SELECT *, list_transform(range(0, 112), lambda k:
    exp(-own + k * ln(own) - lgamma(k + 1.0))) AS p FROM us
), counted AS (
  SELECT *, list_sum(list_transform(u, lambda x: len(list_filter(range(1, 112), lambda k:
    list_sum(p[1:k]) < x))))::INTEGER AS n_copies
  FROM terms
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, n_copies,
  ('0x' || md5('42s:' || draw || ':' || copy)[1:15])::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted)
""",
    "op4_chat_format": r"""
WITH plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
  )
), turns AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS escaped,
    replace(replace(role, '\', '\\'), '<|', '<\|') AS shown,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM plain
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
    ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped) + CASE WHEN before = role THEN length('<|part|>')
    ELSE length(shown) + length('<|turn|><|text|><|end|>') END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
""",
    "op12_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op11_bloom_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), norms AS (
  SELECT doc_id, 50 + ((50 * n * docs) // terms) AS m FROM lengths, totals
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals
), scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 50
""",
    "op13_merkle_manifest": """
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS a,
    coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS b,
    coalesce(strlen(text) || ':' || text, '-') AS d
  FROM documents
), shown AS (
  SELECT doc_id, lang, sha256(a || b || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || d) AS leaf,
    -- CRC-32 of the decimal id, byte by byte and bit by bit
    list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
        WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS register,
    CASE WHEN n_chars IS NOT NULL THEN sha256(a || b
      || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || d) ELSE leaf END AS longer
  FROM leaves
), ranked AS (
  SELECT *, CASE WHEN xor(register, 4294967295) % 7 = 0 THEN longer ELSE leaf END AS presented,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS place
  FROM shown
), nodes AS (
  SELECT 0 AS level, lang, place AS spot, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n
  FROM ranked
  UNION ALL
  SELECT level + 1, lang, spot // 2, sha256(string_agg(digest, '' ORDER BY spot)), (max(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY level, lang, spot // 2
), subroots AS (
  SELECT lang, level AS tall, digest,
    row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
  FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, tree AS spot, digest, trees AS n FROM subroots
  UNION ALL
  SELECT level + 1, spot // 2, sha256(string_agg(digest, '' ORDER BY spot)), (max(n) + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, spot // 2
), folded AS (
  SELECT r.doc_id, r.lang, r.leaf, 0 AS level, tall, tree, place, presented AS digest,
    '' AS proof, s.digest AS subroot
  FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT f.doc_id, f.lang, f.leaf, f.level + 1, tall, tree, place,
    CASE WHEN o.digest IS NULL THEN sha256(f.digest)
      WHEN o.spot % 2 = 1 THEN sha256(f.digest || o.digest) ELSE sha256(o.digest || f.digest) END,
    proof || coalesce(o.digest, ''), subroot
  FROM folded f LEFT JOIN (
    SELECT lang, false AS above, level, spot, digest FROM nodes
    UNION ALL SELECT NULL, true, level, spot, digest FROM top) o
    ON o.above = (f.level >= tall)
    AND (o.above OR o.lang IS NOT DISTINCT FROM f.lang)
    AND o.level = CASE WHEN f.level < tall THEN f.level ELSE f.level - tall END
    AND o.spot = xor(CASE WHEN f.level < tall THEN place >> f.level
      ELSE tree >> (f.level - tall) END, 1)
  WHERE f.level < tall + (SELECT max(level) FROM top)
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.digest AS folded_root,
  f.digest = root AS verified
FROM folded f, (SELECT digest AS root FROM top WHERE n = 1)
WHERE level = tall + (SELECT max(level) FROM top)
""",
    "op5_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * common >= 85 * (x.n + y.n - common)
), either AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, either.b FROM reach JOIN either ON reach.other = either.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
""",
    "op8_embedding_itq": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), sound AS (
  SELECT vec_id, v FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(v, lambda x: x * x)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), either AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION
  SELECT reach.vec_id, either.b FROM reach JOIN either ON reach.other = either.a
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
JOIN (SELECT vec_id, count(a) AS n_links FROM vectors LEFT JOIN either ON vec_id = a
  GROUP BY vec_id) USING (vec_id)
""",
}
