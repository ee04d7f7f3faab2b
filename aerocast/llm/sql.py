"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FINE = ("vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 "
         "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0")


def _best(vectors: str, where: str, score: str) -> str:
    """Five best rows of every 50th vector."""
    return f"""
WITH e AS (SELECT vec_id, {vectors} AS v FROM embeddings WHERE {where}),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, {score} AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5"""


JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM s
  UNION SELECT r.id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM s JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) ON id = doc_id"""

SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, array_to_string(list(word ORDER BY p), ' ') AS k
  FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

TOP_K = _best("list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))", _FINE,
              "CAST(list_dot_product(q.v, c.v) AS BIGINT)")

NEAREST = _best("CAST(embedding AS DOUBLE[])", _FINE + " AND len(list_filter(embedding, lambda x: x <> 0)) > 0",
                "list_cosine_similarity(q.v, c.v)")

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT i, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS cnt FROM o GROUP BY ALL HAVING count(DISTINCT i) >= 30),
l AS (SELECT lang, sum(cnt) AS n, count(*) AS v FROM kept GROUP BY lang),
have AS (SELECT o.lang, o.source, o.term, count(*) AS cnt FROM o JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(cnt), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN have USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(h.cnt, 0) AS cnt,
         CAST(1 + (1000000000::HUGEINT * (coalesce(h.cnt, 0) + 5)) // (g.n + 5 * l.v)::HUGEINT AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.cnt + 5)) // (l.n + 5 * l.v)::HUGEINT AS BIGINT) AS q
  FROM g JOIN l USING (lang) JOIN kept k USING (lang) LEFT JOIN have h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE cnt > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50"""


def _ball(rounds: int) -> str:
    """Codes by Lloyd rounds over all entries: what ball k-means must equal."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT r, p, first(k ORDER BY d, k) AS k, min(d) AS d
  FROM (SELECT r, p, k, list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS d FROM x JOIN b{r} USING (p))
  GROUP BY r, p),""")
        if r < rounds:
            steps.append(f"""
b{r + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(m.c, b{r}.c) AS c
  FROM b{r} LEFT JOIN (
    SELECT p, k, list(f ORDER BY i) AS c
    FROM (SELECT p, k, i, floor(sum(y) / count(*)) AS f
          FROM a{r} JOIN (SELECT r, p, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM x) USING (r, p) GROUP BY p, k, i)
    GROUP BY p, k) m USING (p, k)),""")
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT r, vec_id, p, list_slice(v, CAST(p * len(v) // 4 + 1 AS BIGINT), CAST((p + 1) * len(v) // 4 AS BIGINT)) AS x FROM e, range(4) AS t(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM x QUALIFY k < 256),
{"".join(steps)}
book AS (
  SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
  FROM (SELECT p, k, unnest(c) AS y, generate_subscripts(c, 1) AS i FROM b{rounds})),
o AS (
  SELECT r, string_agg(lpad(lower(to_hex(CAST(k AS BIGINT))), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM e JOIN o USING (r), book"""


BALL = _ball(4)


def _perplexity(order: int) -> str:
    """Base rules and Kneser-Ney bands; n-grams as hexadecimal text."""
    steps = []
    for k in range(order - 1, 0, -1):
        steps.append(f"""
t{k} AS MATERIALIZED (SELECT lang, substr(g, 3) AS g, sum((a0 > 0)::INT) AS a0, sum((a1 > 0)::INT) AS a1 FROM t{k + 1} GROUP BY ALL),""")
    for k in range(1, order + 1):
        folds = (0, 1)
        stats = ", ".join(f"sum(a{f}) AS t{f}, sum((a{f} = 1)::INT) AS x{f}, sum((a{f} = 2)::INT) AS y{f}, sum((a{f} > 2)::INT) AS z{f}" for f in folds)
        seen = ", ".join(f"sum((a{f} = {i})::INT)::DOUBLE AS n{f}{i}" for f in folds for i in (1, 2, 3, 4))
        given = ", ".join(
            f"CASE WHEN n{f}1 > 0 AND n{f}2 > 0 AND n{f}3 > 0 AND n{f}4 > 0 "
            f"THEN greatest({{discount}}, least({i}, {i} - {i + 1} * (n{f}1 / (n{f}1 + 2 * n{f}2)) * n{f}{i + 1} / n{f}{i})) ELSE {i / 2} END AS d{f}{i}"
            for f in folds for i in (1, 2, 3))
        p = ", ".join(
            f"CASE WHEN t{f} = 0 THEN low{f} ELSE (greatest(0, a{f} - CASE a{f} WHEN 0 THEN 0 WHEN 1 THEN d{f}1 WHEN 2 THEN d{f}2 ELSE d{f}3 END)"
            f" + (d{f}1 * x{f} + d{f}2 * y{f} + d{f}3 * z{f}) * low{f}) / t{f} END AS p{f}" for f in folds)
        below = f"JOIN (SELECT lang || '|' || g AS lk, p0 AS low0, p1 AS low1 FROM p{k - 1}) USING (lk)" if k > 1 else ""
        lows = "" if k > 1 else ", 1.0::DOUBLE / 256 AS low0, 1.0::DOUBLE / 256 AS low1"
        # one text key per join: on lang beside it, the planner would join contexts and suffixes by lang alone
        steps.append(f"""
c{k} AS MATERIALIZED (SELECT lang || '|' || substr(g, 1, {2 * k - 2}) AS ck, {stats} FROM t{k} GROUP BY ALL),
d{k} AS MATERIALIZED (SELECT lang, {given} FROM (SELECT lang, {seen} FROM t{k} GROUP BY lang)),
p{k} AS MATERIALIZED (
  SELECT lang, g, {p} FROM (SELECT *, lang || '|' || substr(g, 1, {2 * k - 2}) AS ck, lang || '|' || substr(g, 3) AS lk{lows} FROM t{k})
  JOIN c{k} USING (ck) JOIN d{k} USING (lang) {below}),""")
    return f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS i, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
         CASE WHEN substr(md5(coalesce(text, '')), 1, 1) >= '8' THEN 1 ELSE 0 END AS fold,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT i, s, array_to_string(w[s:s + 7], ' ') AS x
  FROM (SELECT i, w, unnest(range(1, len(w) - 6)) AS s FROM doc WHERE len(w) >= 8)),
again AS (SELECT i, s FROM win QUALIFY count(*) OVER (PARTITION BY i, x) > 1),
rep AS (SELECT i, count(DISTINCT p) AS n FROM (SELECT i, unnest(range(s, s + 8)) AS p FROM again) GROUP BY i),
line AS (
  SELECT i, count(*) - count(DISTINCT x) AS n FROM (SELECT i, unnest(string_split(text, chr(10))) AS x FROM doc)
  WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY i),
base AS MATERIALIZED (
  SELECT doc.i, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(line.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         len(w) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(w) AS base_failed
  FROM doc LEFT JOIN line USING (i) LEFT JOIN rep USING (i)),
hx AS (SELECT i, lang, fold, hex(encode(text)) AS h FROM doc),
pos AS MATERIALIZED (
  SELECT i, lang, fold, substr(h, b, {2 * order}) AS g FROM (SELECT *, unnest(range(1, len(h) - {2 * order - 2}, 2)) AS b FROM hx WHERE len(h) >= {2 * order})),
t{order} AS MATERIALIZED (SELECT lang, g, sum((fold = 0)::INT) AS a0, sum((fold = 1)::INT) AS a1 FROM pos GROUP BY ALL),
{"".join(steps)}
cost AS (SELECT lang, g, CAST(round(-1000000 * ln(p0)) AS BIGINT) AS c0, CAST(round(-1000000 * ln(p1)) AS BIGINT) AS c1 FROM p{order}),
nats AS MATERIALIZED (
  SELECT i, sum(CASE WHEN fold = 0 THEN c1 ELSE c0 END)::BIGINT // (1000 * count(*)) AS nats FROM pos JOIN cost USING (lang, g) GROUP BY i),
fit AS (SELECT lang, nats::DOUBLE AS nats FROM base JOIN nats USING (i) WHERE NOT base_failed),
mid AS (SELECT lang, quantile_cont(nats, 0.5) AS mid FROM fit GROUP BY lang),
band AS (SELECT lang, mid, greatest(quantile_cont(abs(nats - mid), 0.5), mid * {{floor}}) AS off FROM fit JOIN mid USING (lang) GROUP BY lang, mid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND nats BETWEEN mid - {{lower}} * off AND mid + {{upper}} * off, false) AS kept
FROM base LEFT JOIN nats USING (i) LEFT JOIN band USING (lang)"""


def perplexity() -> str:
    from aerocast.llm import perplexity as p
    return _perplexity(p.ORDER).format(floor=p.FLOOR, discount=p.DISCOUNT, lower=p.LOWER, upper=p.UPPER)
