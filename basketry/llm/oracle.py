"""DuckDB SQL of the registered queries that SQL can express."""

#: Classes by exact shingle overlap and reachability.
OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS sh FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
u AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(node, lab) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT u.b, r.lab FROM r JOIN u ON u.a = r.node AND r.lab < u.b)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, min(r.lab) AS component_id, s.doc_id = min(r.lab) AS kept
FROM s JOIN r ON r.node = s.doc_id GROUP BY s.doc_id, s.sh
"""

def _level(name: str, parents: str, node: str, budget: str) -> str:
    """Water-filling among siblings, as SQL over ``leaf (domain, lang, source, tokens)``."""
    keys = f"{parents}, {node}" if parents else node
    by = f"PARTITION BY {parents}" if parents else "PARTITION BY 1"
    join = f"JOIN {budget} USING ({parents})" if parents else f"CROSS JOIN {budget}"
    own = f"{', '.join('n.' + p for p in parents.split(', '))}, n.{node}" if parents else f"n.{node}"
    return f"""
{name}_n AS (SELECT {keys}, sum(tokens) * 2 AS cap, floor(sqrt(sum(tokens)::DOUBLE))::HUGEINT AS weight FROM leaf GROUP BY ALL),
{name}_a AS (SELECT {own}, n.cap, n.weight, b.budget::HUGEINT AS budget FROM {name}_n n {join.replace(budget, budget + ' b')} WHERE weight > 0),
{name}_s AS (
  SELECT *, sum(weight) OVER u - weight AS w0, sum(cap) OVER u - cap AS c0, sum(weight) OVER ({by}) AS w FROM {name}_a
  WINDOW u AS ({by} ORDER BY cap::DOUBLE / weight::DOUBLE, {node} ROWS UNBOUNDED PRECEDING)),
{name}_t AS (SELECT *, cap * (w - w0) <= (budget - c0) * weight AS short FROM {name}_s),
{name}_o AS (
  SELECT *, budget - coalesce(sum(CASE WHEN short THEN cap END) OVER ({by}), 0) AS rest,
         sum(CASE WHEN short THEN 0 ELSE weight END) OVER ({by}) AS ow,
         sum(CASE WHEN short THEN 0 ELSE weight END) OVER ({by} ORDER BY cap::DOUBLE / weight::DOUBLE, {node} ROWS UNBOUNDED PRECEDING) AS o1
  FROM {name}_t),
{name} AS (SELECT {keys}, CASE WHEN short THEN cap ELSE least(cap, rest * o1 // ow - rest * (o1 - weight) // ow) END AS budget FROM {name}_o)"""


OP2 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '4' THEN 'd0' WHEN substr(md5(coalesce(source, '')), 1, 1) < '8' THEN 'd1'
              WHEN substr(md5(coalesce(source, '')), 1, 1) < 'c' THEN 'd2' ELSE 'd3' END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::HUGEINT AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
root AS (SELECT sum(tokens) * 9 // 10 AS budget FROM leaf),""" + _level("l1", "", "domain", "root") + "," + _level(
    "l2", "domain", "lang", "l1") + "," + _level("l3", "domain, lang", "source", "l2") + r""",
g AS (SELECT leaf.*, coalesce(budget, 0) // tokens AS whole, coalesce(budget, 0) % tokens AS rest
      FROM leaf LEFT JOIN l3 USING (domain, lang, source) WHERE tokens > 0),
o AS (SELECT d.*, whole, rest, sum(n_tokens) OVER (
        PARTITION BY domain, lang, source ORDER BY md5('7:' || whole || ':' || coalesce(doc_id::VARCHAR, '')) RANGE UNBOUNDED PRECEDING) AS upto
      FROM d LEFT JOIN g USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       coalesce(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END, 0)::INT AS copies FROM o
"""

#: Every 50-byte string with the least document that has it; bytes as two hex digits each.
OP3 = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT w.doc_id, w.p FROM w JOIN m USING (s) WHERE m.least < w.doc_id),
o AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM g),
i AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM r),
t AS (SELECT k.doc_id, string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS parts, max(b) AS stop,
             sum(b - a) AS gone, count(*) AS spans FROM k JOIN d USING (doc_id) GROUP BY k.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(parts, '') || substr(h, 2 * coalesce(stop, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

#: All pairs of a label, then reachability.
OP4 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r(node, lab) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT u.b, r.lab FROM r JOIN u ON u.a = r.node AND r.lab < u.b),
c AS (SELECT node, min(lab) AS lab FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM u GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, lab AS component_id, vec_id = lab AS kept
FROM embeddings JOIN c ON node = vec_id LEFT JOIN n ON a = vec_id
"""

OP9 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 10
"""

ORACLE: dict[str, str] = {"op2_mixing": OP2, "op3_suffix_dedup": OP3, "op4_rabitq": OP4, "op9_kd_topk": OP9, "op10_minhash_bayes": OP10}
