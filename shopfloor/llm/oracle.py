"""The operators' queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from shopfloor.llm import licenses

#: Words, after lower-casing A-Z only.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH items AS (
    SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS k, w[i + 1 : i + least(13, len(w))] AS t
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS i FROM items WHERE len(w) > 0)
), docs AS (
    SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), runs AS (
    SELECT doc_id, k, i, w[i + 1 : i + k] AS t
    FROM (SELECT doc_id, w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS i
          FROM docs CROSS JOIN (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), found AS (
    SELECT r.doc_id, r.i, r.k, x.item_id FROM runs r JOIN windows x ON r.k = x.k AND r.t = x.t
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(l.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(l.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""


def _templates() -> str:
    """The licence templates as rows: name, bigrams, size bounds, and the bigrams with their counts."""
    rows = []
    for name, body in licenses.TEMPLATES:
        grams = licenses.bigrams_of(body)
        low, high = licenses.bounds(sum(grams.values()), licenses.THRESHOLD)
        listed = ", ".join(f"{{gram: '{g}', c: {c}}}" for g, c in sorted(grams.items()))
        rows.append(f"('{name}', {sum(grams.values())}, {low}, {high}, [{listed}])")
    return ",\n".join(rows)


OP1 = rf"""
WITH templates(license, n, low, high, grams) AS (VALUES {_templates()}),
known AS (
    SELECT DISTINCT unnest(list_transform(grams, lambda g: g.gram)) AS gram FROM templates
), plain AS (
    SELECT doc_id, text, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS p FROM documents
), cut AS (
    SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(p, '\n ?(\n ?)+', chr(1), 'g'), chr(1)), lambda u: trim(regexp_replace(u, '[\n ]+', ' ', 'g'))), lambda u: u <> '') AS parts
    FROM plain
), placed AS (
    SELECT doc_id, parts, i, string_split(parts[i], ' ') AS w FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)
), starts AS (
    SELECT DISTINCT doc_id, parts, i FROM (SELECT doc_id, parts, i, unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) AS gram FROM placed) JOIN known USING (gram)
), runs AS (
    SELECT doc_id, array_to_string(parts[i : k], ' ') AS u FROM (SELECT doc_id, parts, i, unnest(range(i + 1, least(len(parts), i + 400) + 1)) AS k FROM starts)
), units AS (
    SELECT DISTINCT doc_id, trim(u) AS u FROM (
        SELECT doc_id, unnest(string_split(p, chr(10))) AS u FROM plain
        UNION ALL
        SELECT doc_id, regexp_replace(unnest(list_append(string_split(regexp_replace(p, '\n ?(\n ?)+', chr(1), 'g'), chr(1)), p)), '[\n ]+', ' ', 'g') FROM plain
        UNION ALL
        SELECT doc_id, regexp_replace(lower(unnest(string_split_regex(regexp_replace(coalesce(text, ''), '[.!?](\s)', chr(1) || '\1', 'g'), chr(1)))), '[^\p{{L}}\p{{N}}]+', ' ', 'g') FROM plain
        UNION ALL
        SELECT doc_id, u FROM runs
    )
), sized AS (
    SELECT doc_id, string_split(u, ' ') AS w, length(u) - length(replace(u, ' ', '')) AS n FROM units
), paired AS (
    SELECT s.doc_id, t.license, s.n AS n_unit, t.n, t.grams, list_transform(range(1, s.n + 1), lambda i: w[i] || ' ' || w[i + 1]) AS b
    FROM sized s JOIN templates t ON s.n BETWEEN t.low AND t.high
), scored AS (
    SELECT doc_id, license,
           2e0 * list_sum(list_transform(grams, lambda g: least(g.c, len(list_filter(b, lambda x: x = g.gram))))) / (n_unit + n) AS dice
    FROM paired
), best AS (
    SELECT doc_id, license, max(dice) AS dice FROM scored WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id, license
), found AS (
    SELECT doc_id, count(*) AS n_licenses, string_agg(license, ',' ORDER BY license) AS licenses,
           max({{dice: dice, license: license}}) AS top FROM best GROUP BY doc_id
)
SELECT d.doc_id, coalesce(f.n_licenses, 0)::BIGINT AS n_licenses, coalesce(f.licenses, '') AS licenses,
       f.top.license AS best_license, round(f.top.dice, 6) AS best_dice
FROM documents d LEFT JOIN found f USING (doc_id)
"""


_SOLID = "regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"

OP11 = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), runs AS (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
    SELECT lang, sum(len(w)) AS n FROM runs GROUP BY lang
), places AS (
    SELECT lang, w, i, k FROM (SELECT lang, w, unnest(range(len(w))) AS i FROM runs WHERE len(w) > 0), range(1, 5) t(k) WHERE i + k <= len(w)
), counts AS (
    SELECT lang, w[i + 1 : i + k] AS t, count(*) AS f FROM places GROUP BY ALL
), candidates AS (
    SELECT lang, t, f AS a FROM counts WHERE len(t) > 1 AND f >= 30
), cuts AS (
    SELECT lang, t, a, unnest(range(1, len(t))) AS k FROM candidates
), scored AS (
    SELECT c.lang, c.t, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.t = c.t[1 : c.k] JOIN counts y ON y.lang = c.lang AND y.t = c.t[c.k + 1 :]
), lowest AS (
    SELECT lang, t, a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, t ORDER BY score, k) = 1
), inner_parts AS (
    SELECT lang, t[i + 1 : i + s] AS t, a FROM candidates, range(2, 4) x(s), range(0, 3) y(i) WHERE s < len(t) AND i + s <= len(t)
), longer AS (
    SELECT lang, t, max(a) AS a FROM inner_parts GROUP BY ALL
), shown AS (
    SELECT w.lang, array_to_string(w.t, ' ') AS phrase, w.a, w.l, w.r, w.score
    FROM lowest w LEFT JOIN longer g ON g.lang = w.lang AND g.t = w.t WHERE g.a IS NULL OR 100::HUGEINT * g.a < 80::HUGEINT * w.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM shown
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

OP12 = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, {_SOLID.format("coalesce(text, '')")} AS w FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(greatest(len(w) - 2, 1)), lambda i: array_to_string(w[i + 1 : i + 3], ' ')))) END AS s FROM split
), nodes AS (
    SELECT min(doc_id) AS node, s FROM shingled WHERE len(s) > 0 GROUP BY s
), having_it AS (
    SELECT node, len(s) AS n, unnest(s) AS g FROM nodes
), links AS (
    SELECT a.node AS a, b.node AS b FROM having_it a JOIN having_it b ON a.g = b.g AND a.node < b.node
    GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(node, root) AS (
    SELECT node, node FROM nodes UNION SELECT r.node, w.b FROM reach r JOIN ways w ON w.a = r.root
), least AS (
    SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(l.root, d.doc_id) AS component_id
FROM shingled d LEFT JOIN nodes n ON n.s = d.s LEFT JOIN least l USING (node)
"""



def _crc_table() -> str:
    """The 256 remainders of crc32, by its rule, as a list."""

    def remainder(c: int) -> int:
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        return c

    return str([remainder(c) for c in range(256)])


OP13 = rf"""
WITH RECURSIVE crc AS (
    SELECT {_crc_table()}::BIGINT[] AS t
), found AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
), runs AS (
    SELECT doc_id, run, count(*) AS times, hex(encode(doc_id || ':' || run)) AS x FROM found WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
    SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x), 2), lambda i: ('0x' || x[i + 1 : i + 2])::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc
), mangled AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed
), words AS (
    SELECT word, sum(times)::BIGINT AS n FROM mangled WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word AS word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.d
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.d = b.word
), near AS (
    SELECT word, count(*) AS n_near, min({{less: -other_n, form: other}}) AS best FROM pairs GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(x.n_near, 0) AS n_near, CASE WHEN -x.best.less >= 2 * w.n THEN x.best.form END AS form, CASE WHEN -x.best.less >= 2 * w.n THEN -x.best.less END AS form_n
    FROM words w LEFT JOIN near x USING (word)
), ways(word, stop, form) AS (
    SELECT word, word, form FROM forms UNION ALL SELECT w.word, f.word, f.form FROM ways w JOIN forms f ON f.word = w.form
)
SELECT f.word, f.form, y.stop AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM forms f JOIN ways y ON y.word = f.word AND y.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": OP1, "op4_decontaminate": OP4, "op11_collocations": OP11, "op12_jaccard_join": OP12, "op13_spelling_variants": OP13}
