"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def low(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


def named(name: str, values: str) -> str:
    return f"list_transform(list_filter({values}, lambda v: v <> ''), lambda v: '{name}' || v)"


OP1 = f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS cut FROM pages),
b AS (SELECT *, CASE WHEN cut > 0 THEN substr(u, cut + 3) ELSE '' END AS rest FROM a),
c AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h0 FROM b),
d AS (SELECT *, substr(rest, length(h0) + 1) AS after_host FROM c),
e AS (SELECT *, regexp_extract(after_host, '^[^?#]*') AS path FROM d),
f AS (SELECT page_id, u, {low("h0")} AS host, path,
       list_distinct(list_concat(
         {named("s=", f"[CASE WHEN cut > 0 THEN {low('substr(u, 1, cut - 1)')} ELSE '' END]")},
         {named("h=", f"string_split({low('h0')}, '.')")},
         {named("p=", f"string_split(regexp_replace({low('path')}, '[0-9]+', '0', 'g'), '/')")},
         {named("q=", f"regexp_extract_all({low('substr(after_host, length(path) + 1)')}, '[?&]([^=&#]+)', 1)")})) AS held
     FROM e),
policy(rule, verdict) AS (VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
                                 ('com/fr/', 'allow'), ('com/de/', 'block')),
split AS (SELECT *, string_split(rule, '/')[1] AS rh, substr(rule, strpos(rule, '/')) AS rp FROM policy),
fit AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS said
     FROM f JOIN split ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
marked AS (SELECT held, CASE WHEN max(toxic) = 1 OR min(quality) = 0 THEN 1 ELSE 0 END AS bad
     FROM f JOIN labels ON doc_id = page_id GROUP BY page_id, held
     HAVING (max(toxic) = 1 OR min(quality) = 0) IS NOT NULL),
least AS (SELECT greatest(5, ceil(count(*) * 0.005)) AS k FROM marked),
sets AS (SELECT bad, unnest(range(1, CAST(1 << len(held) AS BIGINT))) AS mask, held FROM marked),
subs AS (SELECT bad, list_sort(list_filter(held, lambda x, i: (mask >> CAST(i - 1 AS BIGINT)) & 1 = 1)) AS items FROM sets),
mined AS (SELECT items FROM subs GROUP BY items
     HAVING sum(bad) >= (SELECT k FROM least) AND sum(bad) >= 0.5 * count(*)),
hit AS (SELECT DISTINCT page_id FROM f JOIN mined ON list_has_all(held, items))
SELECT f.page_id, f.host, f.path, fit.rule,
       coalesce(fit.said, CASE WHEN hit.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       fit.said IS NULL AND hit.page_id IS NOT NULL AS mined
FROM f LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)
"""

# Numbers 0 to 4,294,967,295 from the four first groups of the hash's digits.
OP12 = r"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
b AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, len(regexp_extract_all(t, '[^\n]*\n|[^\n]+')) AS n,
       CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
       CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM a),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y FROM b),
d AS (SELECT *, array_to_string(u[1:x], '') AS p, array_to_string(u[x + 1:y], '') AS m, array_to_string(u[y + 1:], '') AS s,
       CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
            WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM d
"""


def crc32(text: str) -> str:
    """crc32 of an ASCII text: the remainder by the reversed polynomial, bit by bit."""
    code = "list_transform(string_split({0}, ''), lambda c: CAST(ord(c) AS BIGINT))".format(text)
    bits = "list_reduce(list_prepend(xor(r, b), range(8)), lambda v, k: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {code}), lambda r, b: {bits}), 4294967295)"


def leaf_field(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def leaf_of(n_chars: str) -> str:
    return "sha256(" + " || ".join(leaf_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP13 = f"""
WITH RECURSIVE a AS (SELECT doc_id, lang, {leaf_of("n_chars")} AS leaf,
       {leaf_of("(n_chars + CASE WHEN " + crc32("coalesce(CAST(doc_id AS VARCHAR), '')") + " % 7 = 0 THEN 1 ELSE 0 END)")} AS claimed FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM a),
up(lang, level, pos, size, digest) AS (
  SELECT lang, 0, pos, size, leaf FROM l
  UNION ALL
  SELECT lang, level + 1, pos // 2, any_value((size + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM up WHERE size > 1 GROUP BY lang, level, pos // 2),
subroots AS (SELECT lang, digest, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM up WHERE size = 1),
top(level, pos, size, digest) AS (
  SELECT 0, pos, size, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, any_value((size + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE size > 1 GROUP BY level, pos // 2),
-- One row per leaf and level, to its own root and on to the root over all.
way AS (
  SELECT l.lang, l.pos AS leaf_at, u.level, u.pos, s.digest AS sibling
  FROM l JOIN up u ON u.lang IS NOT DISTINCT FROM l.lang AND u.pos = l.pos >> u.level AND u.size > 1
  LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = u.level AND s.pos = xor(u.pos, 1)
  UNION ALL
  SELECT l.lang, l.pos, 1000 + t.level, t.pos, s.digest
  FROM l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN top t ON t.pos = r.pos >> t.level AND t.size > 1
  LEFT JOIN top s ON s.level = t.level AND s.pos = xor(t.pos, 1)),
proofs AS (SELECT lang, leaf_at, list(CASE WHEN sibling IS NULL THEN '-' WHEN pos % 2 = 1 THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY level) AS proof,
       string_agg(sibling, '' ORDER BY level) AS told FROM way GROUP BY lang, leaf_at),
folded AS (
  SELECT l.*, coalesce(p.told, '') AS told,
         list_reduce(list_prepend(l.claimed, coalesce(p.proof, [])), lambda d, s: sha256(CASE WHEN s = '-' THEN d
           WHEN s[1] = 'L' THEN s[2:] || d ELSE d || s[2:] END)) AS folded_root
  FROM l LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_at = l.pos)
SELECT f.doc_id, f.leaf, r.digest AS subroot, (SELECT digest FROM top WHERE size = 1) AS root, sha256(f.told) AS proof_sha256,
       f.folded_root, f.folded_root = (SELECT digest FROM top WHERE size = 1) AS verified
FROM folded f JOIN subroots r ON r.lang IS NOT DISTINCT FROM f.lang
"""
