"""SQL equivalents (DuckDB) of the queries that SQL can express."""

ORACLES = {}

ORACLES["op8_mix_sources"] = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sums AS (
  SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS most FROM sums
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
  FROM weighed
), targets AS (
  SELECT *, least(most, coalesce(max(CASE WHEN own * weight <= most THEN own END) OVER (), 0) * weight) AS target FROM levels
), house AS (
  SELECT *, round(sum(target) OVER () / 64)::BIGINT AS seats, sum(target) OVER () AS total FROM targets
), quotients AS (
  SELECT rank, s, target / (2 * s + 1) AS q, seats
  FROM (SELECT rank, target, seats, unnest(range(0, CASE WHEN target > 0 THEN (seats * target / total)::BIGINT + 40 ELSE 0 END)) AS s FROM house)
), seated AS (
  SELECT rank, count(*) AS quota
  FROM (SELECT rank, seats, row_number() OVER (ORDER BY q DESC, rank, s) AS r FROM quotients) WHERE r <= seats GROUP BY rank
), placed AS (
  SELECT z.doc_id, z.size, t.rank, t.source_size, t.target, coalesce(q.quota, 0) AS quota,
         ('0x' || substr(md5(concat_ws('|', '7', coalesce(z.doc_id::VARCHAR, '-'), z.size::VARCHAR)), 1, 8))::BIGINT
           % ceil(t.docs / 20000)::BIGINT AS shard,
         ('0x' || substr(md5(concat_ws('|', '9', coalesce(z.doc_id::VARCHAR, '-'), z.size::VARCHAR)), 1, 8))::BIGINT AS place
  FROM sizes z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source LEFT JOIN seated q ON q.rank = t.rank
), lines AS (
  SELECT rank, shard, sum(size)::BIGINT AS line, max(quota) AS seats FROM placed GROUP BY rank, shard
), shares AS (
  SELECT rank, shard, line, seats, sum(line) OVER (PARTITION BY rank) AS total FROM lines
), shard_quotients AS (
  SELECT rank, shard, s, line / (2 * s + 1) AS q, seats
  FROM (SELECT *, unnest(range(0, CASE WHEN line > 0 THEN (seats * line / total)::BIGINT + 40 ELSE 0 END)) AS s FROM shares)
), shard_seats AS (
  SELECT rank, shard, count(*) AS quota
  FROM (SELECT rank, shard, seats, row_number() OVER (PARTITION BY rank ORDER BY q DESC, shard, s) AS r FROM shard_quotients)
  WHERE r <= seats GROUP BY rank, shard
), picked AS (
  SELECT l.rank, l.shard, greatest(l.line, 1) AS line, greatest(round(l.line / 64)::BIGINT, 1) AS blocks,
         least(coalesce(s.quota, 0), 2 * greatest(round(l.line / 64)::BIGINT, 1)) AS picked,
         ('0x' || substr(md5(concat_ws('|', '8', l.rank::VARCHAR, l.shard::VARCHAR)), 1, 8))::BIGINT
           % greatest(round(l.line / 64)::BIGINT, 1) AS start
  FROM lines l LEFT JOIN shard_seats s USING (rank, shard)
), ends AS (
  SELECT p.*, k.line, k.blocks, k.picked, k.start,
         sum(p.size) OVER (PARTITION BY p.rank, p.shard ORDER BY p.place, p.doc_id NULLS FIRST, p.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS e
  FROM placed p JOIN picked k USING (rank, shard)
), both_ends AS (
  SELECT *, e * blocks // line AS be, (e - size) * blocks // line AS bb FROM ends
)
SELECT doc_id, size, source_size, target,
  ((line * ((be * picked + start) // blocks)
    + ((((be + 1) * picked + start) // blocks) - ((be * picked + start) // blocks)) * (e * blocks - be * line)) // blocks
 - (line * ((bb * picked + start) // blocks)
    + ((((bb + 1) * picked + start) // blocks) - ((bb * picked + start) // blocks)) * ((e - size) * blocks - bb * line)) // blocks
  )::BIGINT AS taken
FROM both_ends
"""

ORACLES["op6_chat_round_trip"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *,
    replace(replace(replace(replace(replace(role, '\', '\0'), '<s>', '\1'), '</s>', '\2'), '[INST]', '\3'), '[/INST]', '\4') AS r,
    replace(replace(replace(replace(replace(text, '\', '\0'), '<s>', '\1'), '</s>', '\2'), '[INST]', '\3'), '[/INST]', '\4') AS t,
    regexp_matches(role, '<s>|</s>|\[INST\]|\[/INST\]|\\[0-5]|\n') OR regexp_matches(text, '<s>|</s>|\[INST\]|\[/INST\]|\\[0-4]') AS careful
  FROM turns
), sized AS (
  SELECT *, CASE WHEN careful THEN length(replace(r, chr(10), '\5')) + length(t) ELSE length(role) + length(text) END
    + length('<s>[INST]') + 1 + length('[/INST]</s>') AS chars
  FROM escaped
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES["op5_voronoi_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.w, d.w), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""


def js_distance(p: str, q: str) -> str:
    """Jensen-Shannon distance (base 2) of two lists of shares."""
    halves = [
        f"(CASE WHEN z[{a}] > 0 THEN z[{a}] * log2(2 * z[{a}] / (z[{a}] + z[{b}])) ELSE 0 END)" for a, b in ((1, 2), (2, 1))
    ]
    return f"sqrt(greatest(0, list_sum(list_transform(list_zip({p}, {q}), lambda z: ({halves[0]} + {halves[1]}) / 2))))"


def list_shares(counts: str, total: str) -> str:
    return f"list_transform({counts}, lambda x: x::DOUBLE / greatest({total}, 1)::DOUBLE)"


CLASS_SUMS = "[" + ", ".join(f"sum(classes[{k}])" for k in range(1, 9)) + "]"
ORACLES["op3_quality_rules"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS key, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
    list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda w: length(w) >= 1) AS letters,
    regexp_replace(text, '[a-z]+', '', 'g') AS r0
  FROM texts
), r1 AS (SELECT *, regexp_replace(r0, '[\x20\x09-\x0D]+', '', 'g') AS r1 FROM cut
), r2 AS (SELECT *, regexp_replace(r1, '[A-Z]+', '', 'g') AS r2 FROM r1
), r3 AS (SELECT *, regexp_replace(r2, '[#*$%&|<>]+', '', 'g') AS r3 FROM r2
), r4 AS (SELECT *, regexp_replace(r3, '[0-9]+', '', 'g') AS r4 FROM r3
), r5 AS (SELECT *, regexp_replace(r4, '\p{L}+', '', 'g') AS r5 FROM r4
), r6 AS (SELECT *, regexp_replace(r5, '[[:punct:]]+', '', 'g') AS r6 FROM r5
), measured AS (
  SELECT rid, doc_id, key, letters, len(words) AS n_words, length(text) AS n_chars,
    [length(text) - length(r0), length(r0) - length(r1), length(r1) - length(r2), length(r2) - length(r3),
     length(r3) - length(r4), length(r4) - length(r5), length(r5) - length(r6), length(r6)] AS classes,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM r6
), grams AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM cut WHERE len(words) >= 5)
), repeated AS (
  SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
  SELECT rid, sum(step)::BIGINT AS n_repeat_words
  FROM (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS step FROM repeated) GROUP BY rid
), based AS (
  SELECT m.*, coalesce(c.n_repeat_words, 0) AS n_repeat_words,
    n_words < 10 OR 100 * coalesce(c.n_repeat_words, 0) > 20 * n_words AS base_failed
  FROM measured m LEFT JOIN covered c USING (rid)
), counted AS (
  SELECT key, word, count(*) AS c FROM (SELECT key, unnest(letters) AS word FROM measured) GROUP BY key, word
), top AS (
  SELECT key, list(word ORDER BY c DESC, word) AS ref_words, list(c ORDER BY c DESC, word) AS ref_counts
  FROM (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY key ORDER BY c DESC, word) <= 16) GROUP BY key
), totals AS (
  SELECT key, sum(c)::BIGINT AS ref_total FROM counted GROUP BY key ORDER BY 2 DESC, 1 LIMIT 10000
), first_refs AS (
  SELECT key, """ + CLASS_SUMS + """ AS ref_classes FROM measured GROUP BY key ORDER BY count(*) DESC, key LIMIT 10000
), compared AS (
  SELECT b.key, b.classes, """ + list_shares("b.classes", "b.n_chars") + """ AS pc,
    """ + list_shares("f.ref_classes", "list_sum(f.ref_classes)") + """ AS qc
  FROM based b JOIN first_refs f ON b.key = f.key WHERE NOT b.base_failed
), class_refs AS (
  SELECT key, """ + CLASS_SUMS + """ AS ref_classes FROM compared WHERE round(""" + js_distance("pc", "qc") + """, 6) <= 0.2
  GROUP BY key HAVING count(*) >= 50 ORDER BY count(*) DESC, key LIMIT 10000
), joined AS (
  SELECT b.*, r.ref_classes, o.ref_total, t.ref_counts,
    list_transform(t.ref_words, lambda w: len(list_filter(b.letters, lambda s: s = w))) AS hits
  FROM based b LEFT JOIN class_refs r ON b.key = r.key
  LEFT JOIN totals o ON b.key = o.key LEFT JOIN top t ON o.key = t.key
), histograms AS (
  SELECT *, list_append(hits, len(letters) - list_sum(hits)) AS here,
    list_append(ref_counts, ref_total - list_sum(ref_counts)) AS there FROM joined
), shares AS (
  SELECT *, """ + list_shares("classes", "n_chars") + """ AS pc, """ + list_shares("ref_classes", "list_sum(ref_classes)") + """ AS qc,
    """ + list_shares("here", "len(letters)") + """ AS pw, """ + list_shares("there", "ref_total") + """ AS qw
  FROM histograms
), judged AS (
  SELECT doc_id, n_words, n_chars - classes[2] AS word_chars, classes[4] AS n_symbols, n_dup_lines, n_repeat_words,
    base_failed, len(letters)::BIGINT AS n_letter_words,
    CASE WHEN ref_classes IS NOT NULL AND n_words >= 20 THEN round(""" + js_distance("pc", "qc") + """, 6) END AS class_distance,
    CASE WHEN ref_classes IS NOT NULL AND ref_total IS NOT NULL AND len(letters) >= 20
      THEN round(""" + js_distance("pw", "qw") + """, 6) END AS word_distance
  FROM shares
)
SELECT *, NOT base_failed AND NOT coalesce(class_distance > 0.12 + 0.5 / sqrt(n_words), false)
  AND NOT coalesce(word_distance > 0.02 + 2.66 / sqrt(n_letter_words), false) AS kept FROM judged
"""

ORACLES["op10_near_dedup"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g
  FROM texts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b WHERE 100 * k >= 75 * (x.n + y.n - k)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON reached.r = both_ways.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLES["op12_content_addressed_warc"] = r"""
WITH captures AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
  SELECT page_id, payload, octet_length(payload) AS payload_bytes, sha1(payload) AS d,
         min(page_id) OVER (PARTITION BY payload) AS first FROM captures
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(d, (5 * (k // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests
"""

ORACLES["op13_importance_resampling"] = r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab
  FROM (SELECT unnest(range(256)) AS b)
), texts AS (
  SELECT true AS own, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark
), word_lists AS (
  SELECT row_number() OVER () AS r, own, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
), counts AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM word_lists) GROUP BY r, word
), bytes AS (
  SELECT word, list_transform(range(octet_length(encode(word))), lambda k: ('0x' || substr(hex(encode(word)), (2 * k + 1)::INT, 2))::BIGINT) AS b
  FROM (SELECT DISTINCT word FROM counts)
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tab[((xor(c, x) & 255) + 1)::INT])), 4294967295) % 10000 AS bucket
  FROM bytes, crc
), features AS (
  SELECT r, bucket, sum(n)::BIGINT AS n FROM counts JOIN hashed USING (word) GROUP BY r, bucket
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE NOT own), 0)::DOUBLE AS t
  FROM features JOIN word_lists USING (r) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM totals
), weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM features JOIN gains USING (bucket) GROUP BY r
), scores AS (
  SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(words) >= 20 AS able,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM word_lists LEFT JOIN weights USING (r) WHERE own
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER (PARTITION BY able) AS n FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank FROM ordered
"""
