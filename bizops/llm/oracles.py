"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from bizops.llm.mixing import MAX_COPIES, WEIGHTS
from bizops.llm.secretscan import RULES
from bizops.llm.urlfilter import CONFIDENCE, SUPPORT
from bizops.llm.urlfilter import RULES as URL_RULES


def _spans(number: int) -> str:
    """Rows (doc_id, start, kind, end) of one rule: the texts between the matches and the matches
    alternate, so their lengths give the places."""
    rule = RULES[number]
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
        SELECT doc_id, first + between_ AS start_, {number} AS kind, first + between_ + length(m) AS end_
        FROM (SELECT doc_id, m, g, SUM(length(b)) OVER w AS between_,
                     SUM(length(m)) OVER w - length(m) AS first
              FROM (SELECT doc_id, unnest(found) AS m, unnest(checked) AS g, unnest(list_slice(gaps, 1, len(found))) AS b,
                           unnest(range(len(found))) AS i
                    FROM (SELECT doc_id, regexp_extract_all(text_, {pattern}, 0) AS found,
                                 regexp_extract_all(text_, {pattern}, {rule.group}) AS checked,
                                 string_split_regex(text_, {pattern}) AS gaps FROM texts))
              WINDOW w AS (PARTITION BY doc_id ORDER BY i))
        WHERE length(g) >= {rule.least}"""


def _secrets() -> str:
    kinds = [r.kind for r in RULES]
    counts = ", ".join(f"COUNT(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate(kinds))
    names = "CASE kind " + " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(kinds)) + " END"
    zeros = ", ".join(f"CAST(COALESCE(n_{name}, 0) AS BIGINT) AS n_{name}" for name in kinds)
    return f"""
        WITH texts AS (SELECT doc_id, COALESCE(text, '') AS text_ FROM documents),
        found AS ({" UNION ALL ".join(_spans(k) for k in range(len(kinds)))}),
        listed AS (SELECT doc_id, {counts},
                          string_agg({names} || ':' || CAST(start_ AS BIGINT) || ':' || CAST(end_ AS BIGINT), ',' ORDER BY start_, kind) AS spans
                   FROM found GROUP BY doc_id)
        SELECT doc_id, {zeros}, sha256(COALESCE(spans, '')) AS base_sha256, COALESCE(spans, '') AS spans
        FROM documents LEFT JOIN listed USING (doc_id)"""


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE32 = LETTERS + "234567"
NIBBLES = ", ".join(f"'{i:04b}'" for i in range(16))

WARC = f"""
        WITH digests AS (
            SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha1(COALESCE(html, '')) AS hex FROM pages),
        bits AS (
            SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ([{NIBBLES}])[strpos('0123456789abcdef', substr(hex, i, 1))]), '') AS b,
                   MIN(page_id) OVER (PARTITION BY hex) AS first FROM digests)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1 + CAST(
                   16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT)
                   + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT)
                   + CAST(substr(b, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM bits"""

TOP_K = """
        WITH scaled AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM scaled q JOIN scaled c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores) WHERE r <= 10"""


def _words(table: str, key: str) -> str:
    text = f"translate(COALESCE(text, ''), '{LETTERS}', '{LETTERS.lower()}')"
    return f"SELECT {key}, regexp_extract_all({text}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"


CONTAMINATION = f"""
        WITH docs AS ({_words("documents", "doc_id")}),
        items AS ({_words("benchmark", "item_id")}),
        asked AS (
            SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS phrase
            FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
        there AS (
            SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS phrase
            FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM docs, (SELECT DISTINCT n FROM asked))),
        found AS (SELECT doc_id, item_id, n, i FROM there JOIN asked USING (n, phrase)),
        hits AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
        named AS (
            SELECT doc_id, COUNT(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM found GROUP BY 1)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
               sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

MIX = f"""
        WITH RECURSIVE rows_ AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                   md5(COALESCE(text, '')) AS digest,
                   (CAST('0x' || substr(md5('42:' || COALESCE(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(COALESCE(text, ''))), 1, 13) AS BIGINT) + 0.5) / CAST(4503599627370496 AS DOUBLE) AS u
            FROM documents),
        sources AS (
            SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
                   CAST(([{", ".join(map(str, WEIGHTS))}])[1 + (ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)}] AS DOUBLE) AS weight
            FROM rows_ GROUP BY source),
        filled AS (
            SELECT *, (SUM(source_size) OVER () - COALESCE(SUM({MAX_COPIES} * source_size) OVER (ORDER BY {MAX_COPIES} * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / SUM(weight) OVER (ORDER BY {MAX_COPIES} * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM sources),
        targets AS (
            SELECT source, source_size, round(least(CAST({MAX_COPIES} * source_size AS DOUBLE), weight * (
                       SELECT MIN_BY(level, {MAX_COPIES} * source_size / weight) FROM filled WHERE {MAX_COPIES} * source_size / weight >= level)), 6) AS target
            FROM sources),
        planned AS (
            SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM targets),
        tried AS (
            SELECT source, size, rest, certain, (rest - certain) / CAST(squares - smaller AS DOUBLE) AS c
            FROM (SELECT h.source, h.size, p.target - p.whole * p.source_size AS rest,
                         COALESCE(SUM(h.n * h.size) OVER w, 0) AS certain,
                         COALESCE(SUM(h.n * h.size * h.size) OVER w, 0) AS smaller,
                         SUM(h.n * h.size * h.size) OVER (PARTITION BY h.source) AS squares
                  FROM (SELECT source, size, COUNT(*) AS n FROM rows_ WHERE size > 0 GROUP BY 1, 2) h
                  JOIN planned p ON h.source IS NOT DISTINCT FROM p.source
                  WINDOW w AS (PARTITION BY h.source ORDER BY h.size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
            WHERE rest > 0),
        chances AS (
            SELECT source, MAX(size) AS cut, arg_max(c, size) AS c, arg_max(certain, size) AS certain
            FROM tried WHERE c * size < 1 GROUP BY source),
        ranked AS (
            SELECT r.doc_id, r.source, r.size, p.source_size, p.target, p.whole, COALESCE(r.size > h.cut, FALSE) AS sure,
                   COALESCE(p.target - p.whole * p.source_size - h.certain, 0) AS gap,
                   CASE WHEN h.c * r.size > 0 AND h.c * r.size < 1 AND r.size <= h.cut
                        THEN (u / (1 - u)) / ((h.c * r.size) / (1 - h.c * r.size)) END AS q, r.digest
            FROM rows_ r JOIN planned p ON r.source IS NOT DISTINCT FROM p.source
            LEFT JOIN chances h ON r.source IS NOT DISTINCT FROM h.source),
        numbered AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY q IS NULL, q, doc_id, digest) AS pos FROM ranked),
        fitted AS (
            SELECT source, 0 AS pos, MAX(gap) AS left_ FROM numbered GROUP BY source
            UNION ALL
            SELECT f.source, MIN(n.pos) AS pos, f.left_ - arg_min(n.size, n.pos) AS left_
            FROM fitted f JOIN numbered n ON n.source IS NOT DISTINCT FROM f.source AND n.pos > f.pos
                 AND n.size <= f.left_ AND n.size > 0 AND n.q IS NOT NULL
            GROUP BY f.source, f.left_),
        ends AS (SELECT source, MIN(left_) AS left_ FROM fitted GROUP BY source),
        open_ AS (
            SELECT n.*, f.pos IS NOT NULL OR n.sure AS in_, e.left_
            FROM numbered n JOIN ends e ON n.source IS NOT DISTINCT FROM e.source
            LEFT JOIN fitted f ON n.source IS NOT DISTINCT FROM f.source AND n.pos = f.pos),
        closing AS (
            SELECT source, MIN_BY(pos, (abs(left_ - size), pos)) AS best FROM open_
            WHERE NOT in_ AND q IS NOT NULL AND size > 0 AND abs(left_ - size) < left_ GROUP BY source)
        SELECT doc_id, size, source_size, target, whole + n AS copies, size * (whole + n) AS taken
        FROM (SELECT o.*, CAST(in_ OR COALESCE(pos = best, FALSE) AS BIGINT) AS n
              FROM open_ o LEFT JOIN closing c ON o.source IS NOT DISTINCT FROM c.source)"""


def _crc_table() -> str:
    """The 256 steps of CRC-32 for the reversed polynomial, as an SQL list."""
    steps = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    return "[" + ", ".join(f"{v}::BIGINT" for v in steps) + "]"


IMPORTANCE = f"""
        WITH docs AS ({_words("documents", "doc_id")}),
        items AS ({_words("benchmark", "item_id")}),
        here AS (SELECT doc_id, unnest(w) AS f FROM docs),
        there AS (SELECT unnest(w) AS f FROM items),
        bytes AS (
            SELECT f, list_transform(range(octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS b
            FROM (SELECT f FROM here UNION SELECT f FROM there)),
        buckets AS (
            SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[1 + CAST(xor(c, x) & 255 AS INT)])), 4294967295) % 10000 AS bucket
            FROM bytes, (SELECT {_crc_table()} AS t)),
        corpus AS (SELECT bucket, COUNT(*) AS s FROM here JOIN buckets USING (f) GROUP BY bucket),
        target AS (SELECT bucket, COUNT(*) AS t FROM there JOIN buckets USING (f) GROUP BY bucket),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST((COALESCE(t, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
            FROM corpus LEFT JOIN target USING (bucket), (SELECT COUNT(*) AS all_s FROM here), (SELECT COUNT(*) AS all_t FROM there)),
        means AS (
            SELECT doc_id, CAST(floor(CAST(SUM(gain) AS DOUBLE) / COUNT(*)) AS BIGINT) AS weight
            FROM here JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, COALESCE(weight, 0) AS weight,
                   COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
            FROM docs LEFT JOIN means USING (doc_id)),
        ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
                   COUNT(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranked"""


def _marked(mark: str, part: str, cut: str) -> str:
    lowered = f"translate({part}, '{LETTERS}', '{LETTERS.lower()}')"
    return f"list_transform(list_filter(string_split_regex({lowered}, '{cut}'), lambda x: x <> ''), lambda x: '{mark}' || x)"


def _url_filter() -> str:
    """Mined rules by counting every combination of frequent tokens of every judged URL; no URL of the
    given tables has more of them than mining combines."""
    given = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
    words = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    tokens = " || ".join([
        _marked("h:", "host", "\\."), _marked("p:", "path", words),
        _marked("q:", "regexp_extract(COALESCE(url, ''), '^[^?#]*\\?([^#]*)', 1)", words),
        _marked("f:", "regexp_extract(COALESCE(url, ''), '^[^#]*#(.*)$', 1)", words),
    ])
    return f"""
        WITH rests AS (
            SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parsed AS (
            SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), '{LETTERS}', '{LETTERS.lower()}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
        rules AS (SELECT * FROM (VALUES {given}) AS r(verdict, rule_host, rule_path)),
        fitting AS (
            SELECT page_id, arg_max(rule_host || rule_path, (length(rule_host || rule_path), rule_host || rule_path, verdict)) AS rule,
                   arg_max(verdict, (length(rule_host || rule_path), rule_host || rule_path, verdict)) AS given
            FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id),
        urls AS (SELECT page_id, host, path, rule, given, list_distinct({tokens}) AS tokens FROM parsed LEFT JOIN fitting USING (page_id)),
        examples AS (SELECT * FROM urls WHERE given IS NOT NULL AND len(tokens) > 0),
        total AS (SELECT COUNT(*) AS n FROM examples),
        frequent AS (
            SELECT list(token) AS tokens FROM (
                SELECT token, COUNT(*) AS c FROM (SELECT unnest(tokens) AS token FROM examples) GROUP BY token), total
            WHERE c >= {SUPPORT} * n),
        reduced AS (SELECT given, list_sort(list_intersect(e.tokens, f.tokens)) AS held FROM examples e, frequent f),
        combos AS (
            SELECT given, list_filter(held, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS combo
            FROM (SELECT given, held, unnest(range(1, 1 << CAST(len(held) AS INT))) AS mask FROM reduced)),
        counted AS (SELECT combo, COUNT(*) AS whole, COUNT(*) FILTER (given = 'allow') AS allow, COUNT(*) FILTER (given = 'block') AS block FROM combos GROUP BY combo),
        mined AS (
            SELECT combo, verdict, CAST(good AS DOUBLE) / whole AS confidence, CAST(good AS DOUBLE) / n AS support
            FROM (SELECT combo, whole, 'allow' AS verdict, allow AS good FROM counted UNION ALL SELECT combo, whole, 'block', block FROM counted), total
            WHERE good >= {SUPPORT} * n AND CAST(good AS DOUBLE) / whole >= {CONFIDENCE}),
        parts AS (
            SELECT combo, verdict, confidence, list_filter(combo, lambda x, j: j <> i) AS part
            FROM (SELECT *, unnest(range(1, len(combo) + 1)) AS i FROM mined WHERE len(combo) > 1)),
        kept AS (
            SELECT * FROM mined WHERE (combo, verdict) NOT IN (
                SELECT (p.combo, p.verdict) FROM parts p JOIN mined m ON m.combo = p.part AND m.verdict = p.verdict AND m.confidence >= p.confidence)),
        best AS (
            SELECT page_id, arg_max(verdict, (confidence, support, len(combo), verdict, combo)) AS mined_verdict, MAX(confidence) AS confidence
            FROM urls JOIN kept ON given IS NULL AND list_has_all(tokens, combo) GROUP BY page_id)
        SELECT page_id, host, path, rule, COALESCE(given, mined_verdict, 'allow') AS verdict, confidence FROM urls LEFT JOIN best USING (page_id)"""


ORACLES: dict[str, str] = {
    "op2_secret_scan": _secrets(),
    "op3_warc": WARC,
    "op6_top_k": TOP_K,
    "op7_decontaminate": CONTAMINATION,
    "op9_mix": MIX,
    "op12_importance": IMPORTANCE,
    "op13_url_filter": _url_filter(),
}
