"""DuckDB SQL of the registered queries."""

WORD = r"[^\x20\x09-\x0D]+"
FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "dup_lines": "2 * n_dup_lines > n_word_lines",
}


def _rate(rule: str) -> str:
    return f"""
    SELECT source, docs, fails, mean, strength, (fails + mean * strength) / (docs + strength) AS rate FROM (
      SELECT *, CASE WHEN spread > 0 THEN least(greatest(noise / spread - 1, 1.0), total) ELSE total END AS strength FROM (
        SELECT *, mean * (1 - mean) AS noise, squares / total - mean * mean - mean * (1 - mean) * (hosts - 1) / total AS spread FROM (
          SELECT source, docs, fails, sum(fails) OVER () / sum(docs) OVER () AS mean, sum(docs) OVER ()::DOUBLE AS total,
                 count(*) OVER () AS hosts, sum(fails * fails / docs) OVER () AS squares
          FROM (SELECT source, count(*)::DOUBLE AS docs, sum(({RULES[rule]})::INT)::DOUBLE AS fails FROM measured GROUP BY source))))"""


QUALITY = f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS t FROM base),
repeats AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM repeats) GROUP BY r),
measured AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_word_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered USING (r)),
rates AS (SELECT source, max(rate) AS rate FROM ({" UNION ALL ".join(f"SELECT source, rate FROM ({_rate(r)})" for r in RULES)}) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({RULES["short"]}) OR ({RULES["repetitive"]}) AS base_failed, rate > 0.5 AS host_failed,
       NOT (({RULES["short"]}) OR ({RULES["repetitive"]})) AND NOT (rate > 0.5) AS kept
FROM measured JOIN rates ON measured.source IS NOT DISTINCT FROM rates.source
"""

LINE_DEDUP = f"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (SELECT r, doc_id, pos, line, translate(trim(line, {BLANKS}), {FOLD}) AS k FROM (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split)),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT r, pos, line, keeper IS NOT NULL AND doc_id IS NOT NULL AND doc_id <> keeper AS lost FROM keyed LEFT JOIN shared USING (k)),
kept AS (SELECT r, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '') AS t FROM marked GROUP BY r)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(t) AS kept_sha256 FROM split JOIN kept USING (r)
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('7|' || coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(text, '')) AS key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0 * sum(size) AS most,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM sized GROUP BY source),
levels AS (
  SELECT *, most / weight AS fills,
         (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN rate IS NULL THEN most ELSE least(most, rate * weight) END AS target
  FROM levels, (SELECT arg_min(level, fills) AS rate FROM levels WHERE level <= fills)),
summed AS (
  SELECT sized.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (epochs * size + greatest(0, least(size, round(target - epochs * source_size) - before)))::BIGINT AS taken
FROM summed
"""

STRICT = "adult casino escort gambling malware phishing poker porn sex torrent viagra warez xxx".split()
SOFT = "ad ads affiliate banner bet cheap click coupon crack deal download free promo redirect track tracker win".split()


def _hits(term: str) -> str:
    """Occurrences between boundaries; a boundary may serve two neighbours, so it is doubled first."""
    return f"len(regexp_extract_all(u, '(?:^|[^a-z0-9]){term}(?:$|[^a-z0-9])'))"


def _fitting(host: str, path: str) -> str:
    rules = ("org/", "example.org/es/", "example.org/en/1", "com/fr/", "com/de/")
    fits = []
    for rule in rules:
        of, _, below = rule.partition("/")
        fits.append(f"CASE WHEN ({host} = '{of}' OR ends_with({host}, '.{of}')) AND starts_with({path}, '/{below}') THEN '{rule}' END")
    return f"list_filter([{', '.join(fits)}], lambda r: r IS NOT NULL)"


URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {FOLD}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_replace(translate(coalesce(url, ''), {FOLD}), '([^a-z0-9])', '\\1\\1', 'g') AS u FROM pages),
counted AS (
  SELECT page_id, host, path, [{', '.join(_hits(t) for t in STRICT)}] AS strict, [{', '.join(_hits(t) for t in SOFT)}] AS soft,
         {_fitting("host", "path")} AS fits FROM parts),
judged AS (
  SELECT page_id, host, path, CASE WHEN len(fits) > 0 THEN list_reduce(fits, lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END) END AS rule,
         list_sum(strict)::BIGINT AS strict_hits, list_sum(soft)::BIGINT AS soft_hits,
         len(list_filter(soft, lambda n: n > 0))::BIGINT AS soft_terms FROM counted)
SELECT page_id, host, path, rule, strict_hits, soft_hits, soft_terms, 0.5 * soft_terms::DOUBLE AS soft_weight,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN strict_hits > 0 OR soft_terms >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
q AS (SELECT vec_id AS query_id, min(e) AS w FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
scored AS (
  SELECT query_id, vec_id, list_inner_product(w, e)::BIGINT AS score FROM q JOIN v ON vec_id <> query_id AND len(w) = len(e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

JACCARD = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {FOLD}), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM split),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
met AS (SELECT a.r AS ra, b.r AS rb, any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, count(*) AS i FROM shingles a JOIN shingles b USING (s) WHERE a.r <> b.r GROUP BY 1, 2),
links AS (
  SELECT DISTINCT a, b FROM met JOIN sizes x ON ra = x.r JOIN sizes y ON rb = y.r WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM split UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM split LEFT JOIN sizes USING (r) LEFT JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

CHAT = f"""
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, 'call-' || turn AS call_id, CASE WHEN (turn // 2) % 2 = 0 THEN 'search' ELSE 'answer' END AS name, text,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_words FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL),
once AS (
  SELECT conv_id, turn, call_id, name, count(*) AS n_calls, min(struct_pack(t := text, n := n_words)) AS a FROM calls GROUP BY ALL),
answers AS (
  SELECT conv_id, 'call-' || (turn - 1) AS call_id, min(text) AS result, count(*) AS n_results FROM conversations
  WHERE role = 'user' AND turn > 0 GROUP BY ALL),
levels AS (
  SELECT conv_id, turn, 0 AS level FROM once c WHERE NOT EXISTS (SELECT 1 FROM once p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL SELECT c.conv_id, c.turn, level + 1 FROM levels l JOIN once c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2),
checked AS (
  SELECT *, list_filter([CASE WHEN a.n < 1 THEN '$.n_words: below minimum' END, CASE WHEN name = 'search' AND a.n > 40 THEN '$.n_words: above maximum' END,
    CASE WHEN a.t IS NULL THEN '$.query: missing' END, CASE WHEN a.t = '' THEN '$.query: too short' END], lambda x: x IS NOT NULL) AS found
  FROM once JOIN levels USING (conv_id, turn) LEFT JOIN answers USING (conv_id, call_id))
SELECT conv_id, turn::BIGINT AS turn, call_id, name, level, n_calls, coalesce(n_results, 0) AS n_results, len(found) = 0 AS valid,
       array_to_string(found, '; ') AS errors,
       '{{"arguments":{{"n_words":' || a.n || CASE WHEN a.t IS NULL THEN '' ELSE ',"query":' || to_json(a.t) END || '}},"id":"' || call_id || '","name":"' || name
         || '","result":' || coalesce(to_json(result)::VARCHAR, 'null') || '}}' AS json
FROM checked
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r, a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
counted AS (SELECT r, count(*) AS n FROM links GROUP BY r), used AS (SELECT r, vec_id AS id, e, label FROM v),
numbered AS (SELECT row_number() OVER () AS k, vec_id, label, embedding FROM embeddings),
smallest AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT v.vec_id AS id, v.label AS l, v.e, max(coalesce(counted.n, 0)) AS n FROM v LEFT JOIN counted USING (r) GROUP BY ALL)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(m, vec_id) AS component_id, coalesce(coalesce(m, vec_id) = vec_id, true) AS kept
FROM numbered LEFT JOIN smallest ON vec_id = a
LEFT JOIN n ON n.id = vec_id AND n.l = label AND n.e = list_transform(embedding, lambda x: x::DOUBLE)
"""

#: Of a text of ASCII characters: its checksum by the reflected polynomial 0xEDB88320, bit by bit.
CRC_TABLE = """crc AS (SELECT list(c ORDER BY k) AS t FROM (SELECT k, list_reduce(list_prepend(k, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256))::BIGINT AS k)))"""


def _crc32(value: str) -> str:
    """The unsigned checksum of the UTF-8 bytes of a text, over the table of ``crc``."""
    spelled = f"hex(encode({value}))"
    found = f"list_transform(range(octet_length(encode({value}))), lambda i: ('0x' || substr({spelled}, (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {found}), lambda c, b: xor(crc.t[xor(c & 255, b) + 1], c >> 8)), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(source: str) -> str:
    """All levels of the trees of ``g, i, h``: while a group has several nodes, runs of 8 become one."""
    return f"""SELECT g, 0 AS lvl, i, h, count(*) OVER (PARTITION BY g) AS n FROM {source}
  UNION ALL SELECT g, lvl, i, h, count(*) OVER (PARTITION BY g) AS n FROM (
    SELECT g, lvl + 1 AS lvl, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {{tree}} WHERE n > 1 GROUP BY g, lvl, i // 8)"""


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS h,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, {FOLD})")} ELSE {_leaf("text")} END AS claim FROM documents, crc),
placed AS (SELECT row_number() OVER () AS r, doc_id, g, h, claim, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves),
lower_tree AS ({_tree("placed").format(tree="lower_tree")}),
subroots AS (SELECT g AS lang, h AS subroot, '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h FROM lower_tree WHERE n = 1),
upper_tree AS ({_tree("subroots").format(tree="upper_tree")}),
way AS (
  SELECT p.r, t.lvl, string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < p.i // (8 ** t.lvl)::BIGINT) AS l, string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > p.i // (8 ** t.lvl)::BIGINT) AS rgt
  FROM placed p JOIN (SELECT DISTINCT g, lvl FROM lower_tree WHERE n > 1) t ON t.g = p.g
  JOIN lower_tree s ON s.g = p.g AND s.lvl = t.lvl AND s.i // 8 = p.i // (8 ** (t.lvl + 1))::BIGINT GROUP BY p.r, t.lvl
  UNION ALL
  SELECT p.r, 100 + t.lvl, string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < o.i // (8 ** t.lvl)::BIGINT), string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > o.i // (8 ** t.lvl)::BIGINT)
  FROM placed p JOIN subroots o ON o.lang = p.g JOIN (SELECT DISTINCT lvl FROM upper_tree WHERE n > 1) t ON true
  JOIN upper_tree s ON s.lvl = t.lvl AND s.i // 8 = o.i // (8 ** (t.lvl + 1))::BIGINT GROUP BY p.r, t.lvl),
steps AS (
  SELECT r, list({{'l': coalesce(l, ''), 'r': coalesce(rgt, '')}} ORDER BY lvl) AS path, string_agg(coalesce(l, '') || coalesce(rgt, ''), '' ORDER BY lvl) AS beside FROM way GROUP BY r),
fold AS (
  SELECT r, claim AS node, 1 AS k FROM placed
  UNION ALL SELECT r, sha256(path[k]['l'] || node || path[k]['r']), k + 1 FROM fold JOIN steps USING (r) WHERE k <= len(path)),
ends AS (SELECT r, arg_max(node, k) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, placed.h AS leaf, subroot, root, sha256(coalesce(beside, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots ON subroots.lang = placed.g JOIN ends USING (r) LEFT JOIN steps USING (r), (SELECT h AS root FROM upper_tree WHERE n = 1)
"""

RESAMPLE = f"""
WITH {CRC_TABLE},
texts AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), {FOLD}) AS t FROM documents),
found AS (SELECT r, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
wanted AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {FOLD}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
buckets AS (SELECT w, {_crc32("w")} % 10000 AS b FROM (SELECT w FROM found UNION SELECT w FROM wanted), crc),
sizes AS (SELECT (SELECT count(*) FROM found)::DOUBLE AS s, (SELECT count(*) FROM wanted)::DOUBLE AS t),
gains AS (
  SELECT b, floor(1000 * ln((t.n + 1) * (sizes.s + 10000) / ((s.n + 1) * (sizes.t + 10000))))::BIGINT AS gain
  FROM (SELECT b, count(found.w)::DOUBLE AS n FROM buckets LEFT JOIN found USING (w) GROUP BY b) s
  JOIN (SELECT b, count(wanted.w)::DOUBLE AS n FROM buckets LEFT JOIN wanted USING (w) GROUP BY b) t USING (b), sizes),
weights AS (SELECT r, count(*) AS n, sum(gain) AS weight FROM found JOIN buckets USING (w) JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS k, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 10 * able // 100 THEN k END AS rank FROM scored LEFT JOIN ranked USING (r)
"""
