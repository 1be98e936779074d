"""DuckDB SQL of operators 11 and 12."""

_CRC = ("(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), [1::UBIGINT, 1, 1, 1, 1, 1, 1, 1]), "
        "lambda x, y: xor(x >> 1, (x & 1::UBIGINT) * 3988292384::UBIGINT))), 4294967295::UBIGINT))")


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(strlen(({value})::VARCHAR), ':', ({value})::VARCHAR) END"


def _leaf(chars: str) -> str:
    return f"sha256(concat({', '.join(_field(c) for c in ('doc_id', 'source', 'lang', chars, 'text'))}))"


MERKLE = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS other FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY g) AS n FROM l),
t AS (SELECT g, 0 AS lvl, i, leaf AS h, n FROM d
      UNION ALL
      SELECT g, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2
      FROM t WHERE n > 1 GROUP BY g, lvl, i // 2),
s AS (SELECT g, h AS subroot, lvl AS height FROM t WHERE n = 1),
o AS (SELECT g, subroot, height, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM s),
u AS (SELECT 0 AS lvl, i, subroot AS h, n FROM o
      UNION ALL
      SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2
      FROM u WHERE n > 1 GROUP BY lvl, i // 2),
r AS (SELECT h AS root, lvl AS height FROM u WHERE n = 1),
p AS (SELECT d.g, d.i, k AS step, (d.i >> k) & 1 AS odd, t.h
      FROM d JOIN o USING (g), unnest(range(o.height)) AS x(k)
      LEFT JOIN t ON t.g = d.g AND t.lvl = k AND t.i = xor(d.i >> k, 1)
      UNION ALL
      SELECT d.g, d.i, o.height + k, (o.i >> k) & 1, u.h
      FROM d JOIN o USING (g), r, unnest(range(r.height)) AS x(k)
      LEFT JOIN u ON u.lvl = k AND u.i = xor(o.i >> k, 1)),
f AS (SELECT g, i, 0 AS step, coalesce(other, leaf) AS h FROM d
      UNION ALL
      SELECT f.g, f.i, f.step + 1, sha256(CASE WHEN p.h IS NULL THEN f.h WHEN p.odd = 1 THEN p.h || f.h ELSE f.h || p.h END)
      FROM f JOIN p ON p.g = f.g AND p.i = f.i AND p.step = f.step),
e AS (SELECT g, i, max_by(h, step) AS folded_root FROM f GROUP BY g, i),
q AS (SELECT g, i, sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof_sha256 FROM p GROUP BY g, i)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN o USING (g) JOIN e ON e.g = d.g AND e.i = d.i LEFT JOIN q ON q.g = d.g AND q.i = d.i, r
"""

PHRASES = """
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
i AS (SELECT lang, id, unnest(ws) AS w1, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM i WINDOW o AS (PARTITION BY id ORDER BY i)),
f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
h AS (SELECT lang, x, y, max(f) AS longest FROM
        (SELECT lang, w1 AS x, w2 AS y, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) AS u GROUP BY ALL),
c AS (SELECT p.lang, concat_ws(' ', p.w1, p.w2) AS phrase, 1 AS cut, p.f AS a, l.f AS l, r.f AS r
      FROM f2 p JOIN f1 l ON l.lang = p.lang AND l.w1 = p.w1 JOIN f1 r ON r.lang = p.lang AND r.w1 = p.w2
      LEFT JOIN h ON h.lang = p.lang AND h.x = p.w1 AND h.y = p.w2
      WHERE p.f >= 10 AND (longest IS NULL OR 100 * longest < 50 * p.f)
      UNION ALL
      SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3), 1, p.f, l.f, r.f
      FROM f3 p JOIN f1 l ON l.lang = p.lang AND l.w1 = p.w1 JOIN f2 r ON r.lang = p.lang AND r.w1 = p.w2 AND r.w2 = p.w3
      UNION ALL
      SELECT p.lang, concat_ws(' ', p.w1, p.w2, p.w3), 2, p.f, l.f, r.f
      FROM f3 p JOIN f2 l ON l.lang = p.lang AND l.w1 = p.w1 AND l.w2 = p.w2 JOIN f1 r ON r.lang = p.lang AND r.w1 = p.w3),
s AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM c),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
