"""Reference SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from orebed.llm.secrets import BASE_RULES, RULES, Rule
from orebed.llm.sketch import BELOW, DIGITS, SHINGLE

WORD = r"[^\x20\x09-\x0D]+"


def _matches(rule: Rule, rank: int) -> str:
    """Spans of one rule: the lengths of matches and of the text between them add up to places."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
    {rule.kind}_parts AS (
      SELECT place, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
             regexp_split_to_array(t, '{pattern}') AS p
      FROM d),
    {rule.kind}_at AS (
      SELECT place, i, length(m[i]) AS long, length(g[i]) AS n,
             list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
      FROM {rule.kind}_parts, unnest(range(1, len(m) + 1)) AS u(i)),
    {rule.kind}_spans AS (
      SELECT place, '{rule.kind}' AS kind, {rank} AS rank, CAST(s AS BIGINT) AS s, CAST(s + long AS BIGINT) AS e
      FROM {rule.kind}_at WHERE n >= {rule.least})"""


def _secrets() -> str:
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES)
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank)"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t FROM documents),
    {",".join(_matches(rule, rank) for rank, rule in enumerate(RULES))},
    spans AS ({" UNION ALL ".join(f"SELECT * FROM {rule.kind}_spans" for rule in RULES)}),
    listed AS (
      SELECT place, {counts}, {listed} FILTER (kind IN ({base})) AS base, {listed} AS spans FROM spans GROUP BY place)
    SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE_RULES)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN listed USING (place)"""


def _mix() -> str:
    return rf"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), 'none') || ':17') AS draw
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
    -- Sources in the order in which a rising level reaches their caps.
    r AS (
      SELECT *, 2.0::DOUBLE * source_size / w AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS total,
             coalesce(sum(2 * source_size) OVER before, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
      FROM s
      WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT (total - capped) / open AS level FROM r WHERE (total - capped) / open < ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
    t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(level, 1e300) * w) AS target FROM r LEFT JOIN level ON true),
    q AS (
      SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
    b AS (
      SELECT d.doc_id, d.size, q.source_size, q.target, q.times,
             CAST(round(q.target - CAST(q.times * q.source_size AS DOUBLE)) AS BIGINT)
               - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, size, source_size, target,
           CAST(times * size + greatest(0, least(size, room)) AS BIGINT) AS taken
    FROM b"""


def _sketch() -> str:
    def hashes(words: str) -> str:
        return f"""list_sort(list_distinct(list_transform(list_filter(
          list_transform(range(1, greatest(len({words}) - {SHINGLE - 1}, least(len({words}), 1)) + 1),
                         lambda i: md5(array_to_string({words}[i:i + {SHINGLE - 1}], ' '))),
          lambda h: h < '{BELOW}'), lambda h: left(h, {DIGITS}))))"""

    def near(one: str, two: str) -> str:
        union = f"len(list_distinct(list_concat({one}, {two})))"
        return f"CASE WHEN {union} = 0 THEN 0.0 ELSE len(list_intersect({one}, {two}))::DOUBLE / {union} END"

    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    o AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, t) AS place, count(*) OVER () AS n FROM d),
    e AS (
      SELECT a.place, a.doc_id, a.t, b.t AS next_t, b.doc_id AS next_doc_id,
             left(a.t, length(a.t) - length(a.t) // 3) || left(b.t, length(a.t) // 3) AS edited
      FROM o a JOIN o b ON b.place = a.place % a.n + 1),
    w AS (
      SELECT *, regexp_extract_all(t, '{WORD}') AS tw, regexp_extract_all(next_t, '{WORD}') AS nw,
             regexp_extract_all(edited, '{WORD}') AS ew
      FROM e),
    h AS (SELECT *, {hashes("tw")} AS th, {hashes("nw")} AS nh, {hashes("ew")} AS eh FROM w)
    SELECT doc_id, length(t) AS n_chars, sha256(edited) AS edited_sha256,
           left(md5(t), 16) || ':' || array_to_string(th, '.') AS fingerprint,
           left(md5(edited), 16) || ':' || array_to_string(eh, '.') AS edited_fingerprint,
           CASE WHEN t = edited THEN 1.0 ELSE {near("th", "eh")} END AS near_edited,
           CASE WHEN t = next_t THEN 1.0 ELSE {near("th", "nh")} END AS near_next,
           next_doc_id
    FROM h"""


# The checksum's table of 256 entries, one for each byte, and the checksum of a text by it, byte after byte.
CRC_TABLE = """(
      SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b::BIGINT) ORDER BY b)
      FROM range(256) AS t(b))"""


def _crc32(text: str) -> str:
    each = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = "lambda c, b: xor(c // 256, crc[(xor(c, b) % 256 + 1)::INTEGER])"
    return f"xor(list_reduce({each}, {step}, 4294967295::BIGINT), 4294967295)"


def _shards() -> str:
    def best(shards: int) -> str:
        return f"arg_min(shard, cost) FILTER (shard < {shards})"

    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t, coalesce(CAST(doc_id AS VARCHAR), 'none') AS key
      FROM documents),
    u AS (
      SELECT place, shard, CAST('0x' || substr(sha256(key || ':' || shard // 4), CAST(shard % 4 * 16 + 1 AS INTEGER), 13) AS BIGINT) AS drawn
      FROM d, range(41) AS s(shard)),
    c AS (SELECT place, shard, -ln((drawn + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS cost FROM u),
    w AS (SELECT place, {best(40)} AS shard, {best(41)} AS grown_shard FROM c GROUP BY place),
    r AS (
      SELECT doc_id, CAST(strlen(t) + 16 AS BIGINT) AS size, {_crc32("t")} AS text_crc32, shard, grown_shard
      FROM d JOIN w USING (place), (SELECT {CRC_TABLE} AS crc))
    SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
           CAST(grown_shard AS INTEGER) AS grown_shard
    FROM r"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _variants() -> str:
    """Near words are those that are equal with one letter left out of either or at one place of both."""
    return rf"""
    WITH RECURSIVE
    runs AS (
      SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run
      FROM documents, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS u(run)),
    drawn AS (
      SELECT run, often, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
      FROM (SELECT doc_id, run, count(*) AS often FROM runs GROUP BY ALL), (SELECT {CRC_TABLE} AS crc)),
    kept AS (
      SELECT often, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) + 2 AS INTEGER))
                    ELSE run END AS word
      FROM drawn),
    words AS (SELECT word, CAST(sum(often) AS BIGINT) AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(often) >= 5),
    cut AS (
      SELECT word, n, i, left(word, CAST(i - 1 AS INTEGER)) || substr(word, CAST(i + 1 AS INTEGER)) AS rest
      FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
    pairs AS (
      SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
    best AS (
      SELECT word, count(*) AS n_near, arg_max(near, near_n) AS some, max(near_n) AS most FROM pairs GROUP BY word),
    first AS (SELECT p.word, min(p.near) AS near FROM pairs p JOIN best b ON p.word = b.word AND p.near_n = b.most GROUP BY p.word),
    formed AS (
      SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 5 * w.n THEN f.near END AS form,
             CASE WHEN b.most >= 5 * w.n THEN b.most END AS form_n
      FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN first f ON w.word = f.word),
    chain AS (
      SELECT word, word AS tip, 0 AS steps FROM formed
      UNION ALL
      SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON c.tip = f.word WHERE f.form IS NOT NULL),
    ends AS (SELECT word, arg_max(tip, steps) AS root FROM chain GROUP BY word)
    SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON f.word = e.word"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _search() -> str:
    def counted(rows: str, key: str) -> str:
        return rf"""
      SELECT {key}, term, count(*) AS tf
      FROM (SELECT {key}, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM {rows})
      GROUP BY ALL"""

    return f"""
    WITH d AS (SELECT row_number() OVER () AS place, doc_id, text FROM documents),
    i AS (SELECT row_number() OVER () AS item, item_id, text FROM benchmark),
    dt AS ({counted("d", "place")}),
    it AS ({counted("i", "item")}),
    lengths AS (SELECT place, CAST(sum(tf) AS BIGINT) AS n FROM dt GROUP BY place),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
    weights AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM dt WHERE term IN (SELECT term FROM it) GROUP BY term), total),
    parts AS (
      SELECT it.item, dt.place,
             it.tf * w * ((1000000000 * dt.tf) // (1000 * dt.tf + 8 * (100 - 75 + (75 * n * docs) // terms))) AS part
      FROM it JOIN dt ON it.term = dt.term JOIN weights ON it.term = weights.term JOIN lengths ON dt.place = lengths.place, total),
    scores AS (SELECT item, place, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY ALL HAVING sum(part) > 0),
    ranks AS (
      SELECT item_id, doc_id, score,
             CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM scores JOIN i USING (item) JOIN d USING (place))
    SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10"""


def statements() -> dict[str, str]:
    return {
        "op2_scaled_sketch": _sketch(),
        "op4_secret_scan": _secrets(),
        "op9_mixing": _mix(),
        "op11_rendezvous": _shards(),
        "op12_spelling_variants": _variants(),
        "op13_reversed_search": _search(),
    }
