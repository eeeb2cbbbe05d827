"""DuckDB SQL for the named queries (tables are pre-registered views).

Column names equal those of the Spark queries; integer sums are cast to
BIGINT and doubles rounded where Spark rounds.
"""

from __future__ import annotations

_NATION_EXACT = """
SELECT n.n_name, sum(l.l_quantity) / count(l.l_quantity) AS a, count(l.l_quantity) AS n
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name
"""
_NATION_AVG = f"SELECT n_name, round(a, 6) AS avg_quantity, n FROM ({_NATION_EXACT})"

def _murmur3_partition(key: str, n: int) -> str:
    """The partition that Spark's ``repartition(n, key)`` gives a BIGINT: Murmur3 of its two halves, seed 42."""
    steps = [("a", f"CASE WHEN {key} < 0 THEN {key}::HUGEINT + 18446744073709551616 ELSE {key}::HUGEINT END"),
             ("low", "(a % 4294967296)::UBIGINT"), ("high", "(a // 4294967296)::UBIGINT"), ("h0", "42::UBIGINT")]

    def half(k: str, h: str, out: str) -> None:
        steps.extend([(f"{out}a", f"({k} * 3432918353) % 4294967296"), (f"{out}b", f"(({out}a * 32768) % 4294967296) + ({out}a // 131072)"),
                      (f"{out}c", f"({out}b * 461845907) % 4294967296"), (f"{out}d", f"xor({h}, {out}c)"),
                      (f"{out}e", f"(({out}d * 8192) % 4294967296) + ({out}d // 524288)"), (out, f"({out}e * 5 + 3864292196) % 4294967296")])

    half("low", "h0", "h1")
    half("high", "h1", "h2")
    steps += [("f1", "xor(h2, 8::UBIGINT)"), ("f2", "(xor(f1, f1 // 65536) * 2246822507) % 4294967296"),
              ("f3", "(xor(f2, f2 // 8192) * 3266489909) % 4294967296"), ("f4", "xor(f3, f3 // 65536)::BIGINT"),
              ("f5", "CASE WHEN f4 >= 2147483648 THEN f4 - 4294967296 ELSE f4 END")]
    sql = "SELECT * FROM lineitem"
    for name, what in steps:
        sql = f"SELECT *, {what} AS {name} FROM ({sql})"
    return f"SELECT ((f5 % {n}) + {n}) % {n} AS p FROM ({sql})"


def _layout_sql(layout: str, places: str, n: int = 7) -> str:
    return (f"SELECT '{layout}' AS layout, r.p::INTEGER AS partition, count(l.p) AS n_items FROM range({n}) r(p) "
            f"LEFT JOIN ({places}) l ON l.p = r.p GROUP BY r.p")


_TOP = """
SELECT string_agg(CAST(id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, id) AS s
FROM (SELECT {col} AS id, count(*) AS n FROM lineitem WHERE {col} IS NOT NULL
      GROUP BY 1 ORDER BY n DESC, id LIMIT 10)
"""

ORACLE: dict[str, str] = {
    "avg_by_nation": _NATION_AVG,
    "top_avg_nation": f"SELECT n_name, round(a, 6) AS avg_quantity, n FROM ({_NATION_EXACT} ORDER BY a DESC, n_name LIMIT 10)",
    "ranked_nations": f"SELECT row_number() OVER (ORDER BY a DESC, n_name) AS place, n_name, round(a, 6) AS avg_quantity, n "
                      f"FROM ({_NATION_EXACT})",
    "ties_by_avg": """
        SELECT avg_bucket, l_suppkey, count(*) OVER (PARTITION BY avg_bucket) AS n_members
        FROM (SELECT CAST(floor(avg(l_quantity) * 10) AS BIGINT) AS avg_bucket, l_suppkey FROM lineitem GROUP BY l_suppkey)
    """,
    "kpi_report": f"""
        SELECT (SELECT count(*) FROM lineitem) AS n_review,
               (SELECT count(*) FROM lineitem
                 WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01') AS n_review_year,
               (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n_user,
               (SELECT count(DISTINCT l_partkey) FROM lineitem) AS n_business,
               ({_TOP.format(col='l_suppkey')}) AS top10_user,
               ({_TOP.format(col='l_partkey')}) AS top10_business
    """,
    "kpi_report_json": f"""
        WITH tu AS (SELECT l_suppkey AS id, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, id LIMIT 10),
             tb AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, id LIMIT 10)
        SELECT '{{"n_review":' || (SELECT count(*) FROM lineitem)
            || ',"n_review_year":' || (SELECT count(*) FROM lineitem
                 WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01')
            || ',"n_user":' || (SELECT count(DISTINCT l_suppkey) FROM lineitem)
            || ',"top10_user":[' || (SELECT string_agg('{{"id":"' || id || '","n":' || n || '}}', ',' ORDER BY n DESC, id) FROM tu)
            || '],"n_business":' || (SELECT count(DISTINCT l_partkey) FROM lineitem)
            || ',"top10_business":[' || (SELECT string_agg('{{"id":"' || id || '","n":' || n || '}}', ',' ORDER BY n DESC, id) FROM tb)
            || ']}}' AS json
    """,
    "top_users": """
        SELECT CAST(row_number() OVER (ORDER BY n DESC, o_custkey) AS INTEGER) AS rank, o_custkey, n
        FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL
              GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10)
    """,
    "top_items": """
        SELECT CAST(row_number() OVER (ORDER BY n DESC, l_partkey) AS INTEGER) AS rank, l_partkey, n
        FROM (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL
              GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10)
    """,
    "json_fields": """
        SELECT event_id,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k_path,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k_regex,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k_parsed
        FROM events
    """,
    "key_placement": "SELECT l_suppkey, 1::BIGINT AS n_partitions, count(*) AS n_items FROM lineitem GROUP BY l_suppkey",
    # a table of one small file is read as one partition
    "partition_profile": " UNION ALL ".join([
        "SELECT 'default' AS layout, 0 AS partition, count(*) AS n_items FROM lineitem",
        _layout_sql("hash", _murmur3_partition("l_suppkey", 7)),
        _layout_sql("custom", "SELECT ((l_suppkey % 7) + 7) % 7 AS p FROM lineitem")]),
    "partition_summary": "SELECT 'hash' AS layout, 7::BIGINT AS n_partition, count(*) AS n_rows FROM lineitem",
}


# --- baskets and itemsets ----------------------------------------------------

REL_SQL = {
    "order_type": "SELECT DISTINCT l_orderkey AS basket, p_type AS item FROM lineitem "
                  "JOIN part ON l_partkey = p_partkey WHERE p_type IS NOT NULL",
    "order_brand": "SELECT DISTINCT l_orderkey AS basket, p_brand AS item FROM lineitem "
                   "JOIN part ON l_partkey = p_partkey WHERE p_brand IS NOT NULL",
    "user_k": "SELECT DISTINCT user_id AS basket, json_extract_string(props, '$.k') AS item FROM events "
              "WHERE user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL",
    "k_users": "SELECT DISTINCT json_extract_string(props, '$.k') AS basket, CAST(user_id AS VARCHAR) AS item "
               "FROM events WHERE user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL",
    "cust_part": "SELECT DISTINCT o_custkey AS basket, l_partkey AS item FROM lineitem "
                 "JOIN orders ON l_orderkey = o_orderkey",
    "doc_word": "SELECT DISTINCT doc_id AS basket, w AS item FROM (SELECT doc_id, "
                "unnest(regexp_split_to_array(lower(text), '\\s+')) AS w FROM documents) WHERE w <> ''",
}


def _levels_sql(base: str, sup_expr: str, kmax: int, out_support: bool = True) -> str:
    """Frequent itemsets up to ``kmax`` by extending occurrence lists.

    ``occ{k}`` holds ``(i1..ik, basket)`` for every frequent k-set and every
    basket containing it; level k+1 extends each occurrence by a larger item
    of the same basket.  A k-set is only reached through its frequent
    (k-1)-prefix, which loses nothing (every subset of a frequent set is
    frequent).
    """
    ctes = [f"b0 AS ({base})",
            "b AS MATERIALIZED (SELECT basket, CAST(item AS VARCHAR) AS item FROM b0)",
            f"s AS MATERIALIZED (SELECT {sup_expr} AS sup)",
            "l1 AS MATERIALIZED (SELECT item AS i1, count(*) AS support FROM b GROUP BY item "
            "HAVING count(*) >= (SELECT sup FROM s))",
            "bf AS MATERIALIZED (SELECT b.* FROM b JOIN l1 ON b.item = l1.i1)",
            "occ1 AS MATERIALIZED (SELECT item AS i1, basket FROM bf)"]
    for k in range(2, kmax + 1):
        prev = ", ".join(f"o.i{j}" for j in range(1, k))
        cols = ", ".join(f"i{j}" for j in range(1, k + 1))
        ext = (f"SELECT {prev}, x.item AS i{k}, o.basket FROM occ{k - 1} o "
               f"JOIN bf x ON x.basket = o.basket AND x.item > o.i{k - 1}")
        ctes.append(f"e{k} AS MATERIALIZED ({ext})")
        ctes.append(f"l{k} AS MATERIALIZED (SELECT {cols}, count(*) AS support FROM e{k} "
                    f"GROUP BY {cols} HAVING count(*) >= (SELECT sup FROM s))")
        if k < kmax:
            ctes.append(f"occ{k} AS MATERIALIZED (SELECT e.* FROM e{k} e SEMI JOIN l{k} USING ({cols}))")
    parts = []
    for k in range(1, kmax + 1):
        key = " || ',' || ".join(f"i{j}" for j in range(1, k + 1))
        sup_col = ", CAST(support AS BIGINT) AS support" if out_support else ""
        parts.append(f"SELECT CAST({k} AS INTEGER) AS k, {key} AS itemset{sup_col} FROM l{k}")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


def _nb(rel: str, num: int, den: int) -> str:
    return f"greatest(1, (SELECT count(DISTINCT basket) FROM ({rel})) * {num} // {den})"


_MIN_BASKET = ("SELECT * FROM ({r}) WHERE basket IN (SELECT basket FROM ({r}) GROUP BY basket "
               "HAVING count(*) > 3)").format(r=REL_SQL["order_type"])


def _son_candidates_sql() -> str:
    r = REL_SQL["order_type"]
    sup = _nb(r, 24, 100)
    local = f"greatest(1, ({sup}) // 4)"
    per_chunk = []
    for c in range(4):
        base = f"SELECT * FROM ({r}) WHERE ((basket % 4) + 4) % 4 = {c}"
        per_chunk.append(f"SELECT k, itemset FROM ({_levels_sql(base, local, 6, out_support=False)})")
    return "SELECT DISTINCT k, itemset FROM (" + " UNION ALL ".join(per_chunk) + ")"


def _bucket_ids(rel: str) -> str:
    return (f"WITH b AS ({rel}), ids AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS id "
            f"FROM (SELECT DISTINCT item FROM b)), t AS (SELECT basket, id FROM b JOIN ids USING (item)), "
            f"bc AS (SELECT (((y.id - x.id) % 101) + 101) % 101 AS bucket, count(*) AS n_pairs "
            f"FROM t x JOIN t y ON x.basket = y.basket AND x.id < y.id GROUP BY 1)")


ORACLE.update({
    "baskets_user": f"SELECT basket, count(*) AS size FROM ({REL_SQL['user_k']}) GROUP BY basket",
    "baskets_item": f"SELECT item AS basket, count(*) AS size FROM ({REL_SQL['user_k']}) GROUP BY item",
    "baskets_min_size": f"SELECT basket, count(*) AS size FROM ({_MIN_BASKET}) GROUP BY basket",
    "dense_ids": """
        SELECT 'p_type' AS attr, v AS value, row_number() OVER (ORDER BY v) - 1 AS idx
        FROM (SELECT DISTINCT p_type AS v FROM part WHERE p_type IS NOT NULL)
        UNION ALL
        SELECT 'p_brand' AS attr, v AS value, row_number() OVER (ORDER BY v) - 1 AS idx
        FROM (SELECT DISTINCT p_brand AS v FROM part WHERE p_brand IS NOT NULL)
    """,
    "freq_itemsets": _levels_sql(REL_SQL["order_type"], _nb(REL_SQL["order_type"], 12, 100), 6),
    "freq_itemsets_brand": _levels_sql(REL_SQL["order_brand"], _nb(REL_SQL["order_brand"], 27, 1000), 4),
    "freq_itemsets_transposed": _levels_sql(REL_SQL["k_users"], _nb(REL_SQL["k_users"], 3, 10), 5),
    "freq_itemsets_min_basket": _levels_sql(_MIN_BASKET, _nb(_MIN_BASKET, 177, 1000), 6),
    "bucket_counts": _bucket_ids(REL_SQL["user_k"]) + " SELECT bucket, n_pairs FROM bc",
    "bucket_pairs": _bucket_ids(REL_SQL["user_k"]) + f""",
        s AS (SELECT {_nb(REL_SQL['user_k'], 3, 10)} AS sup),
        f AS (SELECT item, id FROM b JOIN ids USING (item) GROUP BY item, id HAVING count(*) >= (SELECT sup FROM s))
        SELECT DISTINCT x.item AS a, y.item AS b FROM (SELECT basket, item, id FROM b JOIN f USING (item)) x
        JOIN (SELECT basket, item, id FROM b JOIN f USING (item)) y ON x.basket = y.basket AND x.item < y.item
        WHERE (((y.id - x.id) % 101) + 101) % 101 IN (SELECT bucket FROM bc WHERE n_pairs >= (SELECT sup FROM s))
    """,
    "son_candidates": _son_candidates_sql(),
    "son_frequent": _levels_sql(REL_SQL["order_type"], _nb(REL_SQL["order_type"], 24, 100), 6),
    "son_bucket": _levels_sql(_MIN_BASKET, _nb(_MIN_BASKET, 177, 1000), 6),
    "apriori_gen": f"""
        WITH l AS ({_levels_sql(REL_SQL['user_k'], _nb(REL_SQL['user_k'], 3, 10), 2)}),
        p AS (SELECT split_part(itemset, ',', 1) AS a, split_part(itemset, ',', 2) AS b FROM l WHERE k = 2)
        SELECT x.a || ',' || x.b || ',' || y.b AS itemset
        FROM p x JOIN p y ON x.a = y.a AND x.b < y.b
        WHERE EXISTS (SELECT 1 FROM p z WHERE z.a = x.b AND z.b = y.b)
    """,
})


# --- similarity --------------------------------------------------------------
from basketry.functions.hashing import MINHASH_PRIME, minhash_params  # noqa: E402


def _sig_sql(n_hashes: int = 240) -> str:
    mins = ", ".join(f"min(({a} * x + {b}) % {MINHASH_PRIME}) AS m{i}"
                     for i, (a, b) in enumerate(minhash_params(n_hashes)))
    return (f"w AS MATERIALIZED ({REL_SQL['doc_word']}), "
            "h AS (SELECT basket AS set_id, CAST(('0x' || substr(md5(item), 1, 7)) AS BIGINT) AS x FROM w), "
            f"sig AS MATERIALIZED (SELECT set_id, {mins} FROM h GROUP BY set_id)")


def _lsh_sql(n_hashes: int = 240, rows: int = 4) -> str:
    band_sel = " UNION ALL ".join(
        "SELECT set_id, {b} AS band, {ks} FROM sig".format(
            b=b, ks=", ".join(f"m{b * rows + r} AS k{r}" for r in range(rows)))
        for b in range(n_hashes // rows))
    cond = " AND ".join(f"x.k{r} = y.k{r}" for r in range(rows))
    return (_sig_sql(n_hashes) + f", bands AS MATERIALIZED ({band_sel}), "
            f"cand AS MATERIALIZED (SELECT DISTINCT x.set_id AS id1, y.set_id AS id2 FROM bands x JOIN bands y "
            f"ON x.band = y.band AND {cond} AND x.set_id < y.set_id)")


_SIZES = "sz AS MATERIALIZED (SELECT basket AS set_id, count(*) AS n FROM w GROUP BY basket)"


def _scored(pairs_inter: str) -> str:
    return (f"SELECT i.id1, i.id2, i.inter / (s1.n + s2.n - i.inter) AS similarity FROM ({pairs_inter}) i "
            "JOIN sz s1 ON s1.set_id = i.id1 JOIN sz s2 ON s2.set_id = i.id2 "
            "WHERE i.inter / (s1.n + s2.n - i.inter) >= 0.5")


ORACLE.update({
    "jaccard_exact": f"WITH w AS MATERIALIZED ({REL_SQL['doc_word']}), {_SIZES} " + _scored(
        "SELECT x.basket AS id1, y.basket AS id2, count(*) AS inter FROM w x JOIN w y "
        "ON x.item = y.item AND x.basket < y.basket GROUP BY 1, 2"),
    "minhash_signatures": "WITH " + _sig_sql() + " SELECT set_id AS doc_id, concat_ws(',', "
                          + ", ".join(f"m{i}" for i in range(240)) + ") AS sig FROM sig",
    "lsh_candidates": "WITH " + _lsh_sql() + " SELECT id1, id2 FROM cand",
    "similar_pairs": "WITH " + _lsh_sql() + f", {_SIZES} " + _scored(
        "SELECT c.id1, c.id2, count(*) AS inter FROM cand c JOIN w x ON x.basket = c.id1 "
        "JOIN w y ON y.basket = c.id2 AND y.item = x.item GROUP BY 1, 2"),
})


# --- graph -------------------------------------------------------------------
_EDGES = (f"w AS MATERIALIZED ({REL_SQL['cust_part']}), "
          "e2 AS MATERIALIZED (SELECT x.basket AS src, y.basket AS dst, count(*) AS shared FROM w x JOIN w y "
          "ON x.item = y.item AND x.basket < y.basket GROUP BY 1, 2 HAVING count(*) >= 2), "
          "reach AS (SELECT shared, sum(count(*)) OVER (ORDER BY shared DESC) AS n FROM e2 GROUP BY shared), "
          "thre AS (SELECT coalesce((SELECT max(shared) FROM reach WHERE n >= (SELECT (count(DISTINCT basket) + 39) // 40 FROM w)), "
          "(SELECT min(shared) FROM reach)) AS t), "
          "e AS MATERIALIZED (SELECT src, dst, shared FROM e2 WHERE shared >= (SELECT t FROM thre)), "
          "adj AS MATERIALIZED (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e), "
          "nodes AS MATERIALIZED (SELECT src AS node FROM e UNION SELECT dst FROM e)")


def _components_sql(edge_cte: str) -> str:
    """Recursive reachability over ``edge_cte``; every node of ``nodes`` labelled."""
    return (f"ra AS (SELECT src, dst FROM {edge_cte} UNION ALL SELECT dst, src FROM {edge_cte}), "
            "r(node, root) AS (SELECT node, node FROM nodes UNION "
            "SELECT ra.dst, r.root FROM r JOIN ra ON ra.src = r.node), "
            "lab AS (SELECT node, min(root) AS component FROM r GROUP BY node)")


def _bfs_sql(levels: int = 48) -> str:
    ctes = ["f0 AS MATERIALIZED (SELECT node AS s, node, CAST(1 AS DOUBLE) AS sigma FROM nodes)"]
    for d in range(1, levels + 1):
        anti = f"NOT EXISTS (SELECT 1 FROM f{d - 1} p WHERE p.s = f.s AND p.node = a.dst)"
        if d >= 2:
            anti += f" AND NOT EXISTS (SELECT 1 FROM f{d - 2} q WHERE q.s = f.s AND q.node = a.dst)"
        ctes.append(f"f{d} AS MATERIALIZED (SELECT f.s, a.dst AS node, sum(f.sigma) AS sigma "
                    f"FROM f{d - 1} f JOIN adj a ON a.src = f.node WHERE {anti} GROUP BY 1, 2)")
    union = " UNION ALL ".join(f"SELECT s, node, {d} AS dist, sigma FROM f{d}" for d in range(levels + 1))
    ctes.append(f"D AS MATERIALIZED ({union})")
    ctes.append("eb AS MATERIALIZED (SELECT least(a.src, a.dst) AS src, greatest(a.src, a.dst) AS dst, "
                "sum(x.sigma * y.sigma / st.sigma) / 2 AS b FROM adj a "
                "JOIN D x ON x.node = a.src JOIN D y ON y.s = a.dst "
                "JOIN D st ON st.s = x.s AND st.node = y.node AND st.dist = x.dist + 1 + y.dist GROUP BY 1, 2)")
    return ", ".join(ctes)


def _communities_sql() -> str:
    """The whole sequence of removals, one recursion step each, and the partition of largest modularity.

    A step computes the betweenness of the edges left (``_bfs_sql`` over
    them; a path beyond its levels is an error) and keeps what is below the
    top score; the recursion ends when no edge is left.  Components of every
    step follow from reachability over its edges.
    """
    levels = 64
    step = (f"WITH adj AS MATERIALIZED (SELECT src, dst FROM gn UNION ALL SELECT dst, src FROM gn), {_bfs_sql(levels)}, "
            "top AS MATERIALIZED (SELECT max(b) AS t FROM eb), "
            f"far AS MATERIALIZED (SELECT CASE WHEN count(*) > 0 THEN error('a path of more levels') ELSE 0 END AS x FROM f{levels}) "
            "SELECT g.step + 1 AS step, g.src, g.dst FROM gn g JOIN eb ON eb.src = g.src AND eb.dst = g.dst, top, far "
            "WHERE eb.b < top.t * (1 - 1e-9) AND far.x = 0")
    return (f"WITH RECURSIVE {_EDGES}, gn(step, src, dst) AS ("
            f"SELECT 0, src, dst FROM e UNION ALL SELECT * FROM ({step})), "
            "g AS MATERIALIZED (SELECT * FROM gn), "
            "steps AS MATERIALIZED (SELECT unnest(range(0, (SELECT max(step) + 2 FROM g)))::INTEGER AS step), "
            "ga AS MATERIALIZED (SELECT step, src, dst FROM g UNION ALL SELECT step, dst, src FROM g), "
            "r(step, node, root) AS (SELECT step, node, node FROM steps, nodes UNION "
            "SELECT r.step, ga.dst, r.root FROM r JOIN ga ON ga.step = r.step AND ga.src = r.node), "
            "lab AS MATERIALIZED (SELECT step, node, min(root) AS community FROM r GROUP BY 1, 2), "
            "m AS MATERIALIZED (SELECT count(*) AS m FROM e), "
            "deg AS (SELECT src AS node, count(*) AS deg FROM adj GROUP BY 1), "
            "ins AS (SELECT x.step, x.community, count(*) AS l FROM e JOIN lab x ON x.node = e.src "
            "JOIN lab y ON y.node = e.dst AND y.step = x.step AND y.community = x.community GROUP BY 1, 2), "
            "dc AS (SELECT step, community, sum(deg) AS d FROM lab JOIN deg USING (node) GROUP BY 1, 2), "
            "q AS MATERIALIZED (SELECT step, sum(coalesce(l, 0) / m - pow(d / (2 * m), 2)) AS q "
            "FROM dc LEFT JOIN ins USING (step, community), m GROUP BY 1), "
            "best AS (SELECT min(step) AS step FROM q WHERE q >= (SELECT max(q) FROM q) - 1e-12) "
            "SELECT node, community FROM lab WHERE step = (SELECT step FROM best)")


ORACLE.update({
    "shared_item_edges": f"WITH {_EDGES} SELECT src, dst, shared FROM e",
    "communities": _communities_sql(),
    "components": f"WITH RECURSIVE {_EDGES}, {_components_sql('e')} SELECT node, component FROM lab",
    "edge_betweenness": f"WITH {_EDGES}, {_bfs_sql()} SELECT src, dst, round(b, 4) AS betweenness FROM eb",
    "split_round": (f"WITH RECURSIVE {_EDGES}, {_bfs_sql()}, "
                    "rem AS MATERIALIZED (SELECT e.src, e.dst FROM e JOIN eb USING (src, dst) "
                    "WHERE eb.b < (SELECT max(b) FROM eb) * (1 - 1e-9)), "
                    f"{_components_sql('rem')} SELECT node, component FROM lab"),
    "modularity": (f"WITH RECURSIVE {_EDGES}, {_components_sql('e')}, "
                   "m AS (SELECT count(*) AS m FROM e), "
                   "deg AS (SELECT src AS node, count(*) AS deg FROM adj GROUP BY 1), "
                   "ins AS (SELECT l1.component AS c, count(*) AS l FROM e JOIN lab l1 ON l1.node = e.src "
                   "JOIN lab l2 ON l2.node = e.dst WHERE l1.component = l2.component GROUP BY 1), "
                   "dc AS (SELECT component AS c, sum(deg) AS d FROM deg JOIN lab USING (node) GROUP BY 1) "
                   "SELECT round(sum(coalesce(ins.l, 0) / (SELECT m FROM m) "
                   "- pow(dc.d / (2 * (SELECT m FROM m)), 2)), 9) AS modularity "
                   "FROM dc LEFT JOIN ins USING (c)"),
})


# --- reports -----------------------------------------------------------------

def _tuple_sql(col: str) -> str:
    return f"'(''' || replace({col}, ',', ''', ''') || ''')'"


def _itemset_report_sql() -> str:
    cands = ORACLE["son_candidates"]
    freq = ORACLE["son_frequent"]
    return (f"SELECT section, k, row_number() OVER (PARTITION BY section, k ORDER BY itemset) AS pos, {_tuple_sql('itemset')} AS text "
            f"FROM (SELECT 'Candidates' AS section, k, itemset FROM ({cands}) UNION ALL "
            f"SELECT 'Frequent Itemsets' AS section, k, itemset FROM ({freq}))")


ORACLE.update({
    "itemset_report": _itemset_report_sql(),
    "pair_report": ("SELECT id1, id2, CAST(id1 AS VARCHAR) || ',' || CAST(id2 AS VARCHAR) || ',' "
                    f"|| CAST(similarity AS VARCHAR) AS line FROM ({ORACLE['similar_pairs']})"),
    "edge_report": ("SELECT src, dst, betweenness, '(''' || CAST(src AS VARCHAR) || ''', ''' || CAST(dst AS VARCHAR) "
                    f"|| '''), ' || CAST(betweenness AS VARCHAR) AS line FROM ({ORACLE['edge_betweenness']})"),
    "community_report": ("SELECT component AS community, count(*) OVER (PARTITION BY component) AS size, "
                         "min(node) OVER (PARTITION BY component) AS first, node, '''' || CAST(node AS VARCHAR) || '''' AS text "
                         f"FROM ({ORACLE['components']})"),
})


# --- files -----------------------------------------------------------------------
ORACLE.update({
    "json_review_averages": """
        SELECT l_partkey::VARCHAR AS business_id, count(*) AS n, count(DISTINCT l_suppkey) AS n_user,
               round(avg(l_quantity), 6) AS stars, max(year(l_shipdate))::INTEGER AS last_year
        FROM lineitem GROUP BY l_partkey
    """,
    "csv_interactions": f"SELECT basket::VARCHAR AS user_id, item AS business_id FROM ({REL_SQL['order_type']})",
    "ranking_csv": f"SELECT n_name, avg_quantity FROM ({_NATION_AVG})",
})
