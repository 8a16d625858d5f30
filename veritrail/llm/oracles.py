"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from veritrail.llm import mixing, phrases, url_filter
from veritrail.llm.common import LOWER, UPPER


def url_sql() -> str:
    """The cascade is exact, so over the table's own hosts its verdict is plain membership of the list."""
    fits = []
    for says, text in sorted(url_filter.RULES, key=lambda r: -len(r[1])):
        name, slash, rest = text.partition("/")
        fits.append((f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + rest}')", text, says))
    rule = " ".join(f"WHEN {w} THEN '{t}'" for w, t, _ in fits)
    verdict = " ".join(f"WHEN {w} THEN '{s}'" for w, _, s in fits)
    listed = r"(^|[.-])(" + "|".join(url_filter.BLOCKED_TERMS) + r")([.-]|$)"
    return f"""WITH r AS (SELECT page_id, url, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
      p AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
      d AS (SELECT *, concat(host, regexp_extract(path, '^(/[^/]*/)?')) AS place FROM p),
      l AS (SELECT DISTINCT host AS key FROM d WHERE regexp_matches(host, '{listed}')
        UNION SELECT place FROM d WHERE host <> '' AND ends_with(place, '/') GROUP BY place
          HAVING count(*) >= {url_filter.LEAST_URLS} AND 2 * count(*) FILTER (regexp_matches(url, '{url_filter.CAMPAIGN}')) > count(*)),
      b AS (SELECT DISTINCT host, place FROM d JOIN l ON key = place OR key = host OR ends_with(host, concat('.', key)))
    SELECT page_id, host, path, CASE {rule} END AS rule,
      CASE {verdict} WHEN (host, place) IN (SELECT (host, place) FROM b) THEN 'block' ELSE 'allow' END AS verdict FROM d"""


def mixing_sql() -> str:
    """One histogram of all levels' bits at once in place of nested ones."""
    bits = mixing.LEVELS * mixing.LEVEL_BITS
    low = mixing.HASH_BITS - bits
    return f"""WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
        CAST(concat('0x', substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {mixing.HASH_BITS // 4})) AS BIGINT) AS h FROM documents),
      s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
      w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {mixing.CYCLE} + 1 AS w, source_size * {mixing.MOST} AS cap FROM s),
      f AS (SELECT *, sum(source_size) OVER () AS total, sum(cap) OVER o - cap AS before, sum(w) OVER () - sum(w) OVER o + w AS rest FROM w
        WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST)),
      o AS (SELECT *, (total - before) * w < cap * rest AS open FROM f),
      l AS (SELECT arg_max(before, rest) AS b, max(rest) AS r FROM o WHERE open),
      t AS (SELECT source, source_size, CASE WHEN open THEN CAST(total - l.b AS DOUBLE) * w / l.r ELSE CAST(cap AS DOUBLE) END AS target FROM o LEFT JOIN l ON true),
      g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
      n AS (SELECT *, CASE WHEN source_size > 0 THEN target - copies * source_size ELSE 0 END AS need FROM g),
      h AS (SELECT source, h >> {low} AS b, sum(size) AS n FROM d GROUP BY ALL),
      c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY b) AS upto FROM h),
      m AS (SELECT n.source, min(c.b) AS b FROM n JOIN c ON n.source IS NOT DISTINCT FROM c.source WHERE c.upto > n.need GROUP BY n.source),
      e AS (SELECT n.*, coalesce((m.b + CASE WHEN 2 * (n.need - (c.upto - c.n)) > c.n THEN 1 ELSE 0 END) << {low}, 0) AS threshold
        FROM n LEFT JOIN m ON n.source IS NOT DISTINCT FROM m.source LEFT JOIN c ON c.source IS NOT DISTINCT FROM m.source AND c.b = m.b)
    SELECT doc_id, size, source_size, target, CAST(size * (copies + CASE WHEN h < threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source"""


def phrase_sql() -> str:
    """All phrases of all lengths at once, each cut looked up among them."""
    return f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
      p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
      w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
      g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, {phrases.MOST_WORDS + 1}) r(k) WHERE len(w) >= k),
      f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
      n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
      c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= {phrases.LEAST}),
      o AS (SELECT lang, a, array_to_string(w[:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y, phrase, j FROM c, range(1, {phrases.MOST_WORDS}) r(j) WHERE j < k),
      s AS (SELECT o.lang, o.phrase, o.a, l.a AS l, r.a AS r, n, j, CAST(1000 AS HUGEINT) * o.a * n // (CAST(l.a AS HUGEINT) * r.a) AS score
        FROM o JOIN n ON o.lang = n.lang JOIN f l ON l.lang = o.lang AND l.phrase = x JOIN f r ON r.lang = o.lang AND r.phrase = y),
      b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS first FROM s),
      i AS (SELECT lang, array_to_string(w[x:x + m - 1], ' ') AS phrase, max(a) AS within FROM c, range(1, {phrases.MOST_WORDS}) q(x), range(2, {phrases.MOST_WORDS}) v(m) WHERE m < k AND x + m - 1 <= k GROUP BY ALL),
      t AS (SELECT b.lang, b.phrase, a, l, r, n, score FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE first = 1 AND coalesce(100 * within < {phrases.SHARE} * a, true)),
      z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t)
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z WHERE rank <= {phrases.FIRST}"""


ORACLES = {"op7_url_filter": url_sql(), "op8_source_mixing": mixing_sql(), "op13_phrase_mining": phrase_sql()}
