"""SQL twins of the corpus queries, for DuckDB."""

from __future__ import annotations

from rowan.llm.clusters import CENTROIDS, DIM, ROUNDS, SALT, SCALE
from rowan.llm.lexical import MOST
from rowan.llm.quality_rules import RULES, policy_mask
from rowan.llm.shards import DIGITS, SHARDS

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_FAILED = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES))

OP4 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, {_WORDS} AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM d, unnest(range(1, len(w) - 6)) AS x(i)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, unnest(range(8)) AS y(k) GROUP BY r
), lined AS (
  SELECT r, list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d
), m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS n_capitals
  FROM d JOIN lined USING (r) LEFT JOIN covered USING (r)
), f AS (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM m)
SELECT *, failed & {policy_mask("v1")} <> 0 AS base_failed, failed & {policy_mask("v2")} = 0 AS kept FROM f
"""

OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, doc_id, i, ls[i] AS line,
    translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM d, unnest(range(1, len(ls) + 1)) AS x(i)
), common AS (
  SELECT k, max(coalesce(doc_id, -1)) AS keeper FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT coalesce(doc_id, -1)) >= 5
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (
  SELECT lines.*, coalesce(coalesce(doc_id, -1) <> keeper, false) AS gone FROM lines LEFT JOIN common USING (k)
) GROUP BY r
"""

OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, {_WORDS} AS w FROM documents
), windows AS (
  SELECT r, id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS x(i)
), late AS (
  SELECT r, i FROM (SELECT r, i, id, min(id) OVER (PARTITION BY s) AS least FROM windows) WHERE id > least
), gone AS (SELECT DISTINCT r, i + k AS i FROM late, unnest(range(13)) AS y(k)),
tokens AS (SELECT r, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS x(i)),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS s FROM tokens ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

def _op11(dim: int = DIM, scale: int = SCALE, count: int = CENTROIDS, rounds: int = ROUNDS, salt: int = SALT) -> str:
    """One pair of tables for every round."""
    assigned = """
a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, k := k)) AS best FROM (
    SELECT r, k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM cells v JOIN c{i} c USING (j) GROUP BY ALL
  ) GROUP BY r
)"""
    moved = """
c{n} AS MATERIALIZED (
  SELECT k, j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT k, j, (s - ((s % n) + n) % n) // n AS x FROM (
      SELECT best.k AS k, j, sum(x) AS s, count(*) AS n FROM a{i} JOIN cells USING (r) GROUP BY ALL
    )
  ) m USING (k, j)
)"""
    steps = [assigned.format(i=i) + "," + moved.format(i=i, n=i + 1) for i in range(rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}
), cells AS MATERIALIZED (
  SELECT r, j, CAST(floor({scale} * CAST(e[j] AS DOUBLE)) AS BIGINT) AS x FROM kept, unnest(range(1, {dim + 1})) AS t(j)
), firsts AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{salt}:' || CAST(vec_id AS VARCHAR))) - 1 AS k FROM kept
  WHERE vec_id IS NOT NULL QUALIFY k < {count}
), c0 AS MATERIALIZED (SELECT k, j, x FROM firsts JOIN cells USING (r)),
{",".join(steps)},{assigned.format(i=rounds)},
prints AS (
  SELECT k, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY k
)
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN prints ON prints.k = best.k
"""


_BID = f"""-1 / ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(k AS VARCHAR)), 1, {DIGITS})
  AS BIGINT) + 0.5) / {16**DIGITS}.0)"""

#: CRC-32 of a list of bytes: the table's 256 entries by shifting eight times, then a step for every byte.
_CRC = """
crc_table AS MATERIALIZED (
  SELECT list(list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS entries
  FROM range(256) AS t(b)
)"""
_CRC_STEP = "lambda x, y: xor(x >> 8, entries[(xor(x, y) & 255) + 1])"

OP12 = f"""
WITH {_CRC}, d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents
), summed AS (
  SELECT r, doc_id, size,
    xor(list_reduce(list_prepend(4294967295, bytes), {_CRC_STEP}), 4294967295) AS text_crc32
  FROM d, crc_table
), bids AS (SELECT r, k, {_BID} AS bid FROM d, unnest(range({SHARDS + 1})) AS t(k)),
placed AS (
  SELECT r, CAST(arg_max(k, bid) FILTER (WHERE k < {SHARDS}) AS INTEGER) AS shard,
    CAST(arg_max(k, bid) AS INTEGER) AS grown_shard
  FROM bids GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM summed JOIN placed USING (r)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
size AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d),
postings AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, size GROUP BY term
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), size GROUP BY item_id, r
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
  doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {MOST}
"""

ORACLES: dict[str, str] = {
    "op4_quality_rules": OP4,
    "op6_line_dedup": OP6,
    "op8_substring_dedup": OP8,
    "op11_centroid_clustering": _op11(),
    "op12_rendezvous_sharding": OP12,
    "op13_lexical_search": OP13,
}
