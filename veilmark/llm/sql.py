"""SQL with the same results as some of the queries, for checks on small tables."""

from __future__ import annotations

from veilmark.llm import decontaminate as dc
from veilmark.llm import hosts

_REACH = """
    ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(id, c) AS (SELECT id, id FROM ids UNION SELECT r.id, t.b FROM reach r JOIN ties t ON r.c = t.a),
    smallest AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id < y.vec_id
      WHERE list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)) >= 0.98),
    ids AS (SELECT vec_id AS id FROM embeddings), {_REACH},
    n AS (SELECT a AS id, count(*) AS n FROM ties GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM smallest LEFT JOIN n USING (id)"""

JACCARD = f"""
WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    rows AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
    rolled AS (SELECT doc_id, n, word || chr(31) || lead(word, 1) OVER o || chr(31) || lead(word, 2) OVER o AS g
      FROM rows WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    g AS (SELECT DISTINCT doc_id, g FROM rolled WHERE n >= 3 AND g IS NOT NULL
      UNION ALL SELECT doc_id, array_to_string(w, chr(31)) FROM w WHERE len(w) BETWEEN 1 AND 2),
    size AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM common JOIN size s ON s.doc_id = a JOIN size t ON t.doc_id = b WHERE 100 * o >= 90 * (s.n + t.n - o)),
    ids AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM smallest LEFT JOIN size ON doc_id = id"""

_PLAIN = (
    f"regexp_replace(regexp_replace(coalesce(text, ''), '{dc.WITH_UNIT}', ' {dc.P_NUMBER} {dc.P_UNIT} \\2', 'g'), "
    f"'{dc.NUMBER}', ' {dc.P_NUMBER} ', 'g')"
)
_WORDS = f"list_filter(string_split_regex(lower(regexp_replace({_PLAIN}, '{dc.NAME}', '\\1 {dc.P_NAME} ', 'g')), '{dc.SPLIT}'), lambda x: x <> '')"
_LEADS = " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER o" for k in range(1, dc.WIDTH))])


def _side(name: str, table: str) -> str:
    """CTEs: the template words of a table, their windows, and what stands in the slots."""
    return f"""
    {name}_t AS (SELECT {table}_key AS id, text, {_PLAIN} AS plain, {_WORDS} AS w FROM {table}_rows),
    {name}_w AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM {name}_t),
    {name}_g AS (SELECT id, pos, {_LEADS} AS g FROM {name}_w WINDOW o AS (PARTITION BY id ORDER BY pos)),
    {name}_n AS (SELECT id, pos, word AS kind, row_number() OVER (PARTITION BY id, word ORDER BY pos) AS n FROM {name}_w
      WHERE word IN ('{dc.P_NUMBER}', '{dc.P_UNIT}', '{dc.P_NAME}')),
    {name}_s AS (SELECT s.id, pos, kind, lower(CASE kind WHEN '{dc.P_NUMBER}' THEN regexp_extract_all(text, '{dc.NUMBER}')[n]
      WHEN '{dc.P_UNIT}' THEN regexp_extract_all(text, '{dc.WITH_UNIT}', 1)[n]
      ELSE regexp_extract_all(plain, '{dc.NAME}', 2)[n] END) AS value FROM {name}_n s JOIN {name}_t t ON s.id = t.id)"""


def _agreement(name: str, aligned: str) -> str:
    """CTEs: how many slot values of an item stand for one value, under each alignment."""
    return f"""
    {name}_p AS (SELECT DISTINCT doc_id, item_id, shift, item_at + k AS item_at, pos + k AS pos FROM {aligned}, range(0, {dc.WIDTH}) r(k)),
    {name}_v AS (SELECT doc_id, item_id, shift, b.kind, b.value AS item_value, d.value FROM {name}_p p
      JOIN b_s b ON b.id = p.item_id AND b.pos = p.item_at JOIN d_s d ON d.id = p.doc_id AND d.pos = p.pos AND d.kind = b.kind),
    {name} AS (SELECT doc_id, item_id, shift, count(*) AS n_values, count(*) FILTER (n = 1) AS n_agreeing FROM (
      SELECT doc_id, item_id, shift, kind, item_value, count(DISTINCT value) AS n FROM {name}_v GROUP BY ALL) GROUP BY ALL)"""


_RAW = f"list_filter(string_split_regex(lower(coalesce(text, '')), '{dc.SPLIT}'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH documents_rows AS (SELECT doc_id AS documents_key, text FROM documents), benchmark_rows AS (SELECT item_id AS benchmark_key, text FROM benchmark),
    {_side("d", "documents")}, {_side("b", "benchmark")},
    items AS (SELECT id AS item_id, g, min(pos) AS item_at FROM b_g WHERE g IS NOT NULL GROUP BY id, g),
    sizes AS (SELECT item_id, count(*) AS n_windows FROM items GROUP BY item_id),
    aligned AS (SELECT d.id AS doc_id, item_id, item_at, min(d.pos) AS pos FROM d_g d JOIN items USING (g) GROUP BY ALL),
    found AS (SELECT doc_id, item_id, any_value(n_windows) AS n_windows, count(*) AS n_found FROM aligned JOIN sizes USING (item_id)
      GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_windows)),
    first_places AS (SELECT doc_id, item_id, 0 AS shift, item_at, pos FROM aligned JOIN found USING (doc_id, item_id)),
    {_agreement("first_values", "first_places")},
    judged AS (SELECT doc_id, item_id, n_windows, n_found, coalesce(n_values, 0) AS n_values, coalesce(n_agreeing, 0) AS n_agreeing
      FROM found LEFT JOIN first_values USING (doc_id, item_id)),
    offsets AS (SELECT doc_id, item_id, n_windows, i.item_at, d.pos, d.pos - i.item_at AS off
      FROM judged JOIN items i USING (item_id) JOIN d_g d ON d.id = doc_id AND d.g = i.g WHERE n_agreeing < 0.8 * n_values),
    shifts AS (SELECT DISTINCT doc_id, item_id, off AS shift FROM offsets),
    near AS (SELECT * FROM offsets JOIN shifts USING (doc_id, item_id) WHERE abs(off - shift) <= n_windows
      QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift, item_at ORDER BY abs(off - shift), pos) = 1),
    {_agreement("near_values", "near")},
    apart AS (SELECT * FROM (SELECT doc_id, item_id, shift, n_windows, count(*) AS n_found FROM near GROUP BY ALL HAVING count(*) >= 0.8 * n_windows)
      LEFT JOIN near_values USING (doc_id, item_id, shift) WHERE coalesce(n_agreeing, 0) >= 0.8 * coalesce(n_values, 0)
      QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_found DESC, n_agreeing DESC NULLS LAST, shift) = 1),
    short AS (SELECT item_id, r, len(r) AS n FROM (SELECT id AS item_id, {_RAW} AS r FROM b_t WHERE len(w) BETWEEN 4 AND {dc.WIDTH - 1})),
    slots AS (SELECT id AS item_id, count(DISTINCT (kind, value)) AS n_values FROM b_s GROUP BY id),
    raw AS (SELECT id AS doc_id, {_RAW} AS r FROM d_t),
    places AS (SELECT doc_id, n, r, unnest(range(1, len(r) - n + 2)) AS i FROM raw, (SELECT DISTINCT n FROM short)),
    whole AS (SELECT DISTINCT doc_id, item_id FROM places p JOIN short s ON p.n = s.n AND p.r[i:i + p.n - 1] = s.r)
SELECT doc_id, item_id, n_windows, n_found, n_values, n_agreeing FROM judged WHERE n_agreeing >= 0.8 * n_values
UNION ALL SELECT doc_id, item_id, n_windows, n_found, coalesce(n_values, 0), coalesce(n_agreeing, 0) FROM apart
UNION ALL SELECT doc_id, item_id, 1, 1, coalesce(n_values, 0), coalesce(n_values, 0) FROM whole LEFT JOIN slots USING (item_id)"""


def _host_rules() -> str:
    """Quality rules by host, with windows and lines as rows."""
    low, high = hosts.STRENGTH
    rules = hosts.RULES.items()
    sums = ", ".join(f"sum(CAST({r} AS DOUBLE)) AS {r}" for r, _ in rules)
    totals = ", ".join(f"sum({r}) AS {r}, sum({r} * {r} / n) AS {r}_2" for r, _ in rules)
    between = "(({r}_2 - n * ({r} / n) * ({r} / n) - (h - 1) * ({r} / n) * (1 - {r} / n)) / (n - nn / n))"
    priors = ", ".join(
        f"{r} / n AS {r}_m, CASE WHEN h > 1 AND {between.format(r=r)} > 0 "
        f"THEN least(greatest(({r} / n) * (1 - {r} / n) / {between.format(r=r)} - 1, {low}), {high}) ELSE {high} END AS {r}_s"
        for r, _ in rules
    )
    shrunk = ", ".join(f"({r} + {r}_m * {r}_s) / (n + {r}_s) AS rate_{r}" for r, _ in rules)
    worst = "greatest(" + ", ".join(f"rate_{r}" for r, _ in rules) + ")"
    own = " OR ".join(f"({r} AND rate_{r} > 0.25)" for r, _ in rules)
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT id, list_filter(string_split_regex(text, '{hosts.SPACE}'), lambda x: x <> '') AS w FROM d),
    rows AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
    grams AS (SELECT id, i, word || chr(31) || lead(word, 1) OVER o || chr(31) || lead(word, 2) OVER o AS g FROM rows WINDOW o AS (PARTITION BY id ORDER BY i)),
    repeated AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS c FROM grams WHERE g IS NOT NULL) WHERE c > 1),
    covered AS (SELECT id, count(DISTINCT i + k) AS c FROM repeated, range(0, 3) r(k) GROUP BY id),
    lines AS (SELECT id, unnest(string_split(text, chr(10))) AS line FROM d),
    dup AS (SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS c FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY id),
    m AS (SELECT id, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      CAST(length(text) - length(regexp_replace(text, '[{hosts.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
      coalesce(dup.c, 0) AS n_dup_lines, coalesce(covered.c, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM d JOIN w USING (id) LEFT JOIN dup USING (id) LEFT JOIN covered USING (id)),
    f AS (SELECT *, {", ".join(f"({rule}) AS {r}" for r, rule in rules)} FROM m),
    h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {sums} FROM f GROUP BY source),
    t AS (SELECT count(*) AS h, sum(n) AS n, sum(n * n) AS nn, {totals} FROM h),
    p AS (SELECT {priors} FROM t),
    s AS (SELECT source, {shrunk} FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
  NOT (short OR repeats) AND {worst} <= 0.5 AND NOT ({own}) AS kept,
  CASE WHEN {worst} > 0.5 THEN 'bad' WHEN {worst} > 0.25 THEN 'doubtful' ELSE 'good' END AS host_verdict
FROM f JOIN s USING (source)"""


HOSTS = _host_rules()


COLLOCATIONS = """
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT id, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS j FROM (SELECT id, lang, string_split_regex(text, '[.,;:!?\\x0A-\\x0D]') AS p FROM d)),
    w AS (SELECT id, lang, j, unnest(w) AS word, generate_subscripts(w, 1) AS i
      FROM (SELECT id, lang, j, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p)),
    g AS (SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY id, j ORDER BY i)),
    f AS (SELECT lang, [w1] AS w, count(*) AS f FROM g GROUP BY ALL
      UNION ALL SELECT lang, [w1, w2], count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
      UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
      UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
    n AS (SELECT lang, sum(f) AS n FROM f WHERE len(w) = 1 GROUP BY lang),
    c AS (SELECT lang, w, f AS a FROM f WHERE len(w) > 1),
    cuts AS (SELECT c.lang, c.w, a, k, l.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * a) // (l.f + r.f) AS score FROM c, range(1, 4) t(k), f l, f r
      WHERE k < len(c.w) AND l.lang = c.lang AND r.lang = c.lang AND l.w = c.w[1:k] AND r.w = c.w[k + 1:]),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
    subs AS (SELECT lang, w[i:i + m - 1] AS w, max(a) AS longer FROM c, range(2, 4) x(m), range(1, 4) y(i) WHERE m < len(w) AND i + m - 1 <= len(w) GROUP BY ALL),
    kept AS (SELECT best.*, array_to_string(best.w, ' ') AS phrase FROM best LEFT JOIN subs USING (lang, w) WHERE longer IS NULL OR 100 * longer < 80 * a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
