"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SOURCE_DIVERGENCE = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
),
word AS MATERIALIZED (
  SELECT r, lang, source,
         unnest(regexp_extract_all(translate(text, {A_TO_Z}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM doc
),
kept AS MATERIALIZED (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
had AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM word w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term
),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(sum(h.n), 0) + 2 * coalesce(max(v), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) g
  LEFT JOIN had h ON h.lang = g.lang AND h.source = g.source LEFT JOIN size ON size.lang = g.lang
  GROUP BY g.lang, g.source
),
share AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(h.n, 0) + 2)) // g.total AS p
  FROM grp g JOIN kept k ON k.lang = g.lang
  LEFT JOIN had h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
),
whole AS MATERIALIZED (
  SELECT h.lang, h.term,
         1 + (CAST(1000000000 AS HUGEINT) * (sum(h.n) + 2)) // (sum(sum(h.n)) OVER (PARTITION BY h.lang) + 2 * max(s.v)) AS q
  FROM had h JOIN size s USING (lang) GROUP BY h.lang, h.term
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (
    SELECT x.lang, x.source AS one, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM share x JOIN share y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source
    GROUP BY x.lang, x.source, y.source
  ) d ON d.lang = a.lang AND d.one = a.source AND d.other = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, (s.p - w.q) * (s.p - w.q) // (s.p + w.q)
  FROM share s JOIN whole w ON w.lang = s.lang AND w.term = s.term
  WHERE s.n > 0 AND s.p > w.q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _after(url: str) -> str:
    """What follows the first ``://`` of a url; null without one."""
    return f"(CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END)"


def _host(url: str) -> str:
    return f"coalesce(translate(regexp_extract({_after(url)}, '^[^/?#]*'), {A_TO_Z}), '')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({_after(url)}, '^[^/?#]*([^?#]*)', 1), '')"


def _undotted(path: str) -> str:
    """A path without dot segments."""
    parts = f"(CASE WHEN regexp_matches({path}, '/[.][.]?$') THEN string_split({path}, '/') || [''] ELSE string_split({path}, '/') END)"
    fold = (
        f"list_reduce(list_transform({parts}[2:], lambda s: [s]), lambda done, s: "
        "CASE WHEN s[1] = '..' THEN done[1:len(done) - 1] WHEN s[1] = '.' THEN done ELSE done || s END, CAST([] AS VARCHAR[]))"
    )
    return f"(CASE WHEN regexp_matches({path}, '/[.][.]?(/|$)') THEN '/' || array_to_string({fold}, '/') ELSE {path} END)"


def _address(url: str) -> str:
    """Host, path without dot segments, query."""
    path = _path(url)
    query = f"regexp_extract({_after(url)}, '^[^?#]*([?][^#]*)?', 1)"
    return f"(CASE WHEN {_host(url)} <> '' THEN {_host(url)} || (CASE WHEN {path} = '' THEN '/' ELSE {_undotted(path)} END) || {query} END)"


def _attribute(name: str) -> str:
    pattern = rf"""(?i)[\s"''/]{name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    return "(" + " || ".join(f"regexp_extract(tag, '{pattern}', {group})" for group in (1, 2, 3)) + ")"


_HIDDEN = "(?is)<!--.*?-->" + "".join(
    rf"|<{tag}\b.*?</{tag}\s*>" for tag in ("script", "style", "template", "noscript", "textarea", "title")
)
_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _ruled(host: str, path: str, column: int) -> str:
    """The text (column 0) or the verdict (1) of the longest rule that fits."""
    ordered = sorted(_RULES, key=lambda r: -len(r[0] + r[1]))
    value = lambda r: r[0] + r[1] if column == 0 else r[2]
    cases = "".join(
        f" WHEN ({host} = '{r[0]}' OR ends_with({host}, '.{r[0]}')) AND starts_with({path}, '{r[1]}') THEN '{value(r)}'" for r in ordered
    )
    return f"(CASE{cases} END)"


# The rules are fixed in the text; what is blocked spreads over the edges until nothing is added.
URL_FILTER = rf"""
WITH RECURSIVE tag AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '(?i)<(?:link|meta)\s[^>]*>')) AS tag
  FROM pages WHERE lower(html) LIKE '%canonical%' OR lower(html) LIKE '%refresh%'
),
target AS (
  SELECT url, CASE
    WHEN tag ILIKE '<link%' AND regexp_matches({_attribute('rel')}, '(?i)(^|\s)canonical(\s|$)') THEN {_attribute('href')}
    WHEN tag ILIKE '<meta%' AND lower(trim({_attribute('http-equiv')})) = 'refresh'
      THEN regexp_extract({_attribute('content')}, '(?is)^[\s\d.]*[;,]?\s*url\s*=\s*["'']?\s*([^"'']*)', 1)
    END AS ref FROM tag
),
ref AS (SELECT url, replace(regexp_replace(ref, '^\s+|\s+$', '', 'g'), '&amp;', '&') AS ref FROM target WHERE ref IS NOT NULL),
link AS (
  SELECT url, CASE
    WHEN ref = '' OR starts_with(ref, '#') THEN NULL
    WHEN regexp_matches(ref, '(?i)^https?://') THEN ref
    WHEN regexp_matches(ref, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
    WHEN starts_with(ref, '//') THEN regexp_extract(url, '^([^:]*):', 1) || ':' || ref
    WHEN starts_with(ref, '/') THEN regexp_extract(url, '^([^:]*):', 1) || '://' || {_host('url')} || ref
    WHEN starts_with(ref, '?') THEN regexp_extract(url, '^([^:]*):', 1) || '://' || {_host('url')} || {_path('url')} || ref
    ELSE regexp_extract(url, '^([^:]*):', 1) || '://' || {_host('url')}
      || (CASE WHEN {_path('url')} = '' THEN '/' ELSE regexp_extract({_path('url')}, '^(.*/)', 1) END) || ref
    END AS target FROM ref
),
edge AS MATERIALIZED (
  SELECT DISTINCT a, b FROM (SELECT {_address('url')} AS a, {_address('target')} AS b FROM link)
  WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b
),
both_ways AS MATERIALIZED (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
blocked AS (
  SELECT DISTINCT a AS node FROM both_ways
  WHERE {_ruled("regexp_extract(a, '^[^/?#]*')", "regexp_extract(a, '^[^/?#]*([^?#]*)', 1)", 1)} = 'block'
  UNION
  SELECT w.b FROM blocked k JOIN both_ways w ON w.a = k.node
),
page AS (SELECT page_id, url, {_host('url')} AS host, {_path('url')} AS path FROM pages)
SELECT page_id, host, path, {_ruled('host', 'path', 0)} AS rule,
       coalesce({_ruled('host', 'path', 1)},
                CASE WHEN {_address('url')} IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM page
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round is an assignment to all entries and a mean, one after the other."""
    steps = [
        f"""part AS MATERIALIZED (
  SELECT id, label, p, list_transform(vector[p * w + 1 : (p + 1) * w], lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS x
  FROM (SELECT vec_id AS id, label, embedding AS vector, len(embedding) // {parts} AS w FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
       range({parts}) AS r(p)
)""",
        f"""book0 AS MATERIALIZED (
  SELECT p, e, x FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY id) - 1 AS e, x FROM part) WHERE e < {entries}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""near{n} AS MATERIALIZED (
  SELECT id, label, p, any_value(part.x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT part.id, part.label, part.p, part.x, b.e,
           list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM part JOIN book{n} b ON b.p = part.p) AS part
  GROUP BY id, label, p
)"""
        )
        if n < rounds:
            steps.append(
                f"""mean{n} AS (
  SELECT p, e, list(c ORDER BY i) AS x FROM (
    SELECT p, best.e AS e, i, CAST(floor_div(sum(x[i]), count(*)) AS HUGEINT) AS c
    FROM near{n}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY p, best.e, i)
  GROUP BY p, e
),
book{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{n} b LEFT JOIN mean{n} m ON m.p = b.p AND m.e = b.e
)"""
            )
    text = ",\n".join(steps).replace("floor_div(sum(x[i]), count(*))", "(sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*)")
    return f"""WITH {text},
code AS MATERIALIZED (
  SELECT id, label, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY id, label
),
digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: CAST(v AS VARCHAR)), ','), ',' ORDER BY p, e)) AS hex
  FROM book{rounds}
)
SELECT id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, hex AS codebooks_sha256
FROM code, digest
"""
