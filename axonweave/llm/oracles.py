"""DuckDB SQL of the operators on URLs, conversations and spellings."""

from __future__ import annotations

from axonweave.llm import url_filter

#: DuckDB has no crc32: its table, and the checksum of the text in column k of a table that is joined with it.
CRC_TABLE = "crc AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"
CRC = """xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(CAST(length(hex(encode(k))) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(k)), 2 * i + 1, 2) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])))"""
ASCII_LOWER = f"translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"


def url_sql() -> str:
    """The rules, and the regression's rounds one after another."""
    labelled = ", ".join(f"('{r.url}', {r.label})" for r in url_filter.labelled_rows())
    rules = ", ".join(f"('{verdict}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for verdict, rule in url_filter.RULES)
    grams = " UNION ALL ".join(
        f"SELECT id, '{mark}' || substr(s, i, {n}) AS g FROM (SELECT id, s, unnest(range(1, greatest(length(s) - {n - 2}, 1))) AS i FROM (SELECT id, {text} AS s FROM %s))"
        for text, mark in (("'^' || host || '$'", "h"), ("path", "p")) for n in url_filter.GRAMS)
    features = f"SELECT DISTINCT id, CAST('0x' || substr(md5(g), 1, 4) AS INTEGER) % {url_filter.BUCKETS} AS f FROM ({grams}) UNION ALL SELECT id, {url_filter.BUCKETS} FROM %s"
    tail = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail"
    parts = f"translate(regexp_extract(tail, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path"
    rounds = "s0 AS (SELECT DISTINCT f, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM occ),"
    for t in range(url_filter.ROUNDS):
        rounds += f"""
        l{t} AS MATERIALIZED (SELECT f, w, w + {t / (t + 3)!r}::DOUBLE * (w - v) AS look FROM s{t}),
        r{t} AS MATERIALIZED (
            SELECT id, CAST(floor(any_value(share) * (any_value(label) - 1 / (1 + exp(-sum(look) / sqrt(any_value(k))))) / sqrt(any_value(k)) * {url_filter.UNIT}) AS BIGINT) AS r
            FROM occ JOIN l{t} USING (f) JOIN lab USING (id) GROUP BY id),
        s{t + 1} AS MATERIALIZED (
            SELECT f, look + {url_filter.STEP!r}::DOUBLE * (r / {url_filter.UNIT}::DOUBLE - {url_filter.DECAY!r}::DOUBLE * look) AS w, w AS v
            FROM l{t} JOIN (SELECT f, CAST(sum(r) AS DOUBLE) AS r FROM occ JOIN r{t} USING (id) GROUP BY f) USING (f)),"""
    return f"""
        WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules}),
        given AS (SELECT row_number() OVER () AS id, url, CAST(label AS DOUBLE) AS label, 0.5::DOUBLE / count(*) OVER (PARTITION BY label) AS share FROM (VALUES {labelled}) x(url, label)),
        table_urls AS (SELECT id, label, share, {parts} FROM (SELECT *, {tail} FROM given)),
        occ AS MATERIALIZED ({features.replace("%s", "table_urls")}),
        lab AS MATERIALIZED (SELECT id, label, share, k FROM table_urls JOIN (SELECT id, count(*) AS k FROM occ GROUP BY id) USING (id)),
        {rounds}
        urls AS MATERIALIZED (SELECT id, page_id, {parts} FROM (SELECT row_number() OVER () AS id, page_id, {tail} FROM pages)),
        page_occ AS ({features.replace("%s", "urls")}),
        scores AS (SELECT id, sum(coalesce(w, 0)) / sqrt(count(*)) AS score FROM page_occ LEFT JOIN s{url_filter.ROUNDS} USING (f) GROUP BY id),
        fits AS (
            SELECT id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY id)
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score > 0 THEN 'block' ELSE 'allow' END) AS verdict
        FROM urls JOIN scores USING (id) LEFT JOIN fits USING (id)"""


def _plus(state: str, cost: int, edit: str) -> str:
    """A string of cost and audit with more of both."""
    return f"printf('%06d', CAST(substr({state}, 1, 6) AS INTEGER) + {cost}) || substr({state}, 7) || '{edit}'"


def _take(state: str, edit: str, cost: str) -> str:
    return f"printf('%06d', CAST(substr({state}, 1, 6) AS INTEGER) + cut + {cost}) || substr({state}, 7) || {edit}"


#: Row by row, not by spans. Per state the cheapest edits of the first rows, cost and audit in one string; then up to two
#: insertions, as three never pay.
REPAIR = rf"""
        WITH RECURSIVE {CRC_TABLE},
        given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        dealt AS (SELECT conv_id, turn, role, text, {CRC} % 20 AS d FROM given, crc),
        hurt AS (
            SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE d WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM dealt WHERE d <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS p, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stripped, substr(role, 1, 1) AS i
            FROM hurt),
        judged AS (
            SELECT *, CASE WHEN stripped = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate' WHEN right(stripped, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair
            FROM placed),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
                count_if(fault = 'truncated') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id),
        step(conv_id, p, s, m, u, a) AS (
            SELECT conv_id, CAST(0 AS BIGINT), '000000', CAST(NULL AS VARCHAR), '000002I', '000004II' FROM counts
            UNION ALL
            SELECT conv_id, p, s, m, least(u, {_plus("s", 2, "I")}, {_plus("m", 2, "I")}, {_plus("a", 2, "I")}), least(a, {_plus("u", 2, "I")}, {_plus("s", 4, "II")}, {_plus("m", 4, "II")})
            FROM (
                SELECT conv_id, j.p, {_plus("s", 3, "D")} AS s,
                    least({_plus("m", 3, "D")}, CASE WHEN ok AND i = 's' THEN {_take("s", "'K'", "0")} END) AS m,
                    least({_plus("u", 3, "D")}, CASE WHEN ok THEN {_take("least(s, m, a)", "CASE i WHEN 'u' THEN 'K' ELSE 'R' END", "CASE i WHEN 'u' THEN 0 ELSE 2 END")} END) AS u,
                    least({_plus("a", 3, "D")}, CASE WHEN ok THEN {_take("u", "CASE i WHEN 'a' THEN 'K' ELSE 'R' END", "CASE i WHEN 'a' THEN 0 ELSE 2 END")} END) AS a
                FROM step JOIN (SELECT conv_id, p, i, fault NOT IN ('blank', 'duplicate') AS ok, CAST(fault = 'truncated' AS INTEGER) AS cut FROM judged) j USING (conv_id)
                WHERE j.p = step.p + 1) x),
        best AS (SELECT step.conv_id, least(step.s, step.a) AS b FROM step JOIN counts ON counts.conv_id = step.conv_id AND step.p = counts.n),
        edits AS (SELECT conv_id, j, b[6 + j] AS e FROM (SELECT conv_id, b, unnest(range(1, length(b) - 5)) AS j FROM best)),
        numbered AS (SELECT *, count_if(e <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS p FROM edits),
        kept AS (
            SELECT n.conv_id, j, e, role, CASE e WHEN 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY n.conv_id ORDER BY j) AS o, coalesce(e = 'K' AND i = 's', false) AS system
            FROM numbered n LEFT JOIN placed r ON r.conv_id = n.conv_id AND r.p = n.p WHERE e <> 'D'),
        named AS (SELECT *, (o + CAST(max(system) OVER (PARTITION BY conv_id) AS INTEGER)) % 2 AS odd FROM kept),
        lines AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN odd = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS whole FROM named GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            coalesce(CAST(substr(b, 1, 6) AS BIGINT), 0) AS cost, coalesce(substr(b, 7), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN lines USING (conv_id)"""

#: By deleted letters, not by sorted lists.
VARIANTS = rf"""
        WITH RECURSIVE {CRC_TABLE},
        runs AS (SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all({ASCII_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY doc_id, run),
        keyed AS (SELECT run, c, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k FROM runs),
        hashed AS (SELECT run, c, {CRC} AS h FROM keyed, crc),
        formed AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
        words AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM formed WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
        cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (
            SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b USING (i, l, r) WHERE a.word <> b.word
            UNION SELECT cut.word, words.word FROM cut JOIN words ON l || r = words.word
            UNION SELECT words.word, cut.word FROM cut JOIN words ON l || r = words.word),
        ranked AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS c, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k FROM pairs JOIN words ON b = word),
        told AS MATERIALIZED (
            SELECT word, w.n, coalesce(c, 0) AS n_near, CASE WHEN r.n >= 2 * w.n THEN b END AS form, CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
            FROM words w LEFT JOIN ranked r ON a = word AND k = 1),
        chain AS (SELECT word, word AS root, form AS next FROM told UNION ALL SELECT chain.word, told.word, told.form FROM chain JOIN told ON chain.next = told.word)
        SELECT told.word, told.form, root, n, n_near, form_n FROM told JOIN chain ON told.word = chain.word AND next IS NULL"""

SQL = {"op11_url_filters": url_sql(), "op12_structure_repair": REPAIR, "op13_spelling_variants": VARIANTS}
