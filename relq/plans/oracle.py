"""Oracle SQL for every registered query, written for DuckDB over the same Parquet.

Alignment rules (SURVEY §7.4): integer sums are cast to BIGINT, money is
summed as DECIMAL(18,2) and cast to DOUBLE, averages are taken over whole
numbers only, dates use ``strftime`` for the text forms Spark builds with
``date_format``.  Column names equal the Spark query's.
"""

from __future__ import annotations


def _dy(c: str) -> str:
    return f"strftime({c}, '%Y%m%d')"


def _yr(c: str) -> str:
    return f"strftime({c}, '%Y')"


def _ym(c: str) -> str:
    return f"strftime({c}, '%Y%m')"


def _money_sum(c: str) -> str:
    return f"SUM(CAST({c} AS DECIMAL(18,2)))"


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text} 00:00:00'"


ORDERS_BRIEF = f"o_orderkey, {_dy('o_orderdate')} AS basis_dy, o_orderstatus, o_totalprice"
DOCS_LABELS = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
PARTS = "p_partkey, p_name, p_retailprice"
RATE_PCT = "COALESCE(NULLIF(l_discount, 0.0), NULLIF(l_tax, 0.0), 0.0) * 100"
FLAG = "CASE WHEN l_returnflag <> 'N' THEN 'flagged' ELSE 'unflagged' END"
BAND = ("CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' "
        "ELSE 'small' END")
PRIORITY = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' "
            "WHEN '3-MEDIUM' THEN 'medium' ELSE 'other' END")
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' ELSE 'other' END"
NATION_DIM = ("(SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name AS zone "
              "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)")
ORDERS_NATION = (f"(SELECT o.*, {_yr('o.o_orderdate')} AS basis_year, c.c_nationkey "
                 "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)")
ZONE_COLS = [("africa_price", "AFRICA"), ("america_price", "AMERICA"), ("asia_price", "ASIA"),
             ("europe_price", "EUROPE"), ("middle_east_price", "MIDDLE EAST")]
ZONE_PIVOT = (
    "SELECT basis_year, "
    + ", ".join(f"CAST(SUM(CASE WHEN zone = '{z}' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS {n}"
                for n, z in ZONE_COLS)
    + f", CAST({_money_sum('o_totalprice')} AS DOUBLE) AS total_price "
    f"FROM {ORDERS_NATION} f JOIN {NATION_DIM} n ON f.c_nationkey = n.n_nationkey GROUP BY basis_year"
)

ORDERS_PROFILE = [("o_orderkey", "bigint", "text"), ("o_custkey", "bigint", "text"),
                  ("o_orderstatus", "string", "text"), ("o_totalprice", "double", "num"),
                  ("o_orderdate", "timestamp_ntz", "time"), ("o_orderpriority", "string", "text")]


def _profile_sql() -> str:
    parts = []
    for i, (c, dtype, kind) in enumerate(ORDERS_PROFILE):
        src = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if kind == "time" else c
        num = kind == "num"
        parts.append(
            f"SELECT {i} AS ordinal, '{c}' AS column_name, '{dtype}' AS data_type, COUNT(*) AS row_count, "
            f"COUNT({c}) AS non_null, COUNT(DISTINCT {c}) AS distinct_values, "
            f"{f'CAST(MIN({c}) AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS min_num, "
            f"{f'CAST(MAX({c}) AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS max_num, "
            f"{'CAST(NULL AS VARCHAR)' if num else f'CAST(MIN({src}) AS VARCHAR)'} AS min_text, "
            f"{'CAST(NULL AS VARCHAR)' if num else f'CAST(MAX({src}) AS VARCHAR)'} AS max_text "
            "FROM orders")
    return "\nUNION ALL\n".join(parts)


CODE_COLUMNS = {"orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus", "l_linenumber"],
                "customer": ["c_mktsegment", "c_nationkey"], "documents": ["lang", "source"], "labels": ["quality", "toxic"]}


def _domain_sql() -> str:
    parts = []
    for table, cols in CODE_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n_rows, "
                         f"COUNT(*) OVER () AS domain_size, TRUE AS exact FROM {table} GROUP BY {c}")
    return " UNION ALL ".join(parts)


def _snapshots_sql() -> str:
    text = "CAST(NULL AS VARCHAR)"
    parts = []
    for c, dtype in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                     ("o_orderdate", "timestamp_ntz"), ("o_totalprice", "double")):
        whole = [f"{f}({c})" if dtype == "bigint" else "CAST(NULL AS BIGINT)" for f in ("MIN", "MAX")]
        num = [f"CAST({f}({c}) AS DOUBLE)" if dtype in ("bigint", "double") else "CAST(NULL AS DOUBLE)" for f in ("MIN", "MAX")]
        shown = {"string": "{f}({c})", "timestamp_ntz": "strftime({f}({c}), '%Y-%m-%d %H:%M:%S')"}.get(dtype, text)
        low, high = (shown.format(f=f, c=c) for f in ("MIN", "MAX"))
        parts.append(f"SELECT '{c}' AS column_name, '{dtype}' AS data_type, COUNT(*) AS row_count, COUNT({c}) AS non_null, "
                     f"{whole[0]} AS min_whole, {whole[1]} AS max_whole, {num[0]} AS min_num, {num[1]} AS max_num, "
                     f"{low} AS min_text, {high} AS max_text FROM orders WHERE o_orderdate >= {_ts('1997-01-01')}")
    return " UNION ALL ".join(parts)


def _null_sql() -> str:
    declared = {
        "region": ("r_regionkey", ["r_regionkey", "r_name"]),
        "nation": ("n_nationkey", ["n_nationkey", "n_name", "n_regionkey"]),
        "customer": ("c_custkey", ["c_custkey", "c_name", "c_nationkey"]),
        "orders": ("o_orderkey", ["o_orderkey", "o_custkey", "o_orderdate"]),
        "documents": ("doc_id", ["doc_id", "text", "lang", "source", "n_chars"]),
        "labels": ("doc_id", ["doc_id", "quality", "toxic"]),
    }
    parts = []
    for table, (key, cols) in declared.items():
        parts += [f"SELECT '{table}' AS table_name, 'not null' AS rule, '{c}' AS columns, "
                  f"COUNT(*) - COUNT({c}) AS violations, COUNT(*) AS row_count FROM {table}" for c in cols]
        parts.append(f"SELECT '{table}', 'unique', '{key}', (SELECT COUNT(*) FROM (SELECT {key} FROM {table} "
                     f"GROUP BY {key} HAVING COUNT(*) > 1)), COUNT(*) FROM {table}")
    return "\nUNION ALL\n".join(parts)


SQL: dict[str, str] = {
    # S
    "scan_all": "SELECT * FROM nation",
    "scan_ordered": "SELECT * FROM customer ORDER BY c_nationkey, c_custkey",
    "adhoc_sql": ("SELECT o_orderstatus, COUNT(*) AS n_orders, "
                  "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price "
                  "FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus"),
    "profile_table": _profile_sql(),
    "snapshot_load": (f"SELECT {_yr('o_orderdate')} AS basis_year, COUNT(*) AS n_orders, "
                      f"CAST({_money_sum('o_totalprice')} AS DOUBLE) AS total_price FROM orders "
                      f"WHERE NOT ({_yr('o_orderdate')} = '1997' AND o_orderstatus = 'P') GROUP BY 1"),
    "result_sink": ("SELECT COUNT(*) AS rows_stored, COUNT(*) AS rows_seen, COUNT(*) - COUNT(l.quality) AS nulls_seen "
                    f"FROM {DOCS_LABELS}"),
    "profile_domain": _domain_sql(),
    "profile_snapshots": _snapshots_sql(),
    "check_not_null": _null_sql(),
    "check_unique": ("SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem "
                     "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"),
    "check_orphans": ("SELECT doc_id, lang, source, n_chars FROM documents d "
                      "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"),
    # P
    "project_cols": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "project_alias": (f"SELECT o_orderkey AS order_no, {_dy('o_orderdate')} AS basis_dy, "
                      "o_totalprice AS total_price, o_orderpriority AS priority FROM orders"),
    "project_arith": ("SELECT l_orderkey, l_linenumber, l_quantity, "
                      "l_quantity + l_discount + l_tax AS qty_rate_sum FROM lineitem"),
    "unit_convert": "SELECT l_orderkey, l_linenumber, l_discount, l_discount * 100 AS discount_pct FROM lineitem",
    "distinct_one": "SELECT DISTINCT o_orderstatus AS order_status FROM orders",
    "distinct_multi": (f"SELECT DISTINCT o_orderpriority, o_orderstatus, {_yr('o_orderdate')} AS basis_year "
                       "FROM orders WHERE o_orderpriority LIKE '%H%'"),
    # F
    "filter_eq": f"SELECT {ORDERS_BRIEF} FROM orders WHERE o_orderdate = {_ts('1998-06-30')}",
    "filter_cmp": f"SELECT {ORDERS_BRIEF} FROM orders WHERE o_totalprice >= 400000",
    "filter_ne": f"SELECT {ORDERS_BRIEF} FROM orders WHERE o_orderpriority <> '5-LOW'",
    "filter_and": f"SELECT {ORDERS_BRIEF} FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 300000",
    "filter_or_and": (f"SELECT {ORDERS_BRIEF} FROM orders WHERE (o_orderpriority = '1-URGENT' "
                      "OR o_orderpriority = '2-HIGH') AND o_totalprice >= 300000"),
    "filter_not": f"SELECT {ORDERS_BRIEF} FROM orders WHERE NOT (o_orderstatus = 'F')",
    "filter_in": f"SELECT {ORDERS_BRIEF} FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "filter_in_subquery": ("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey IN "
                           "(SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"),
    "filter_between": (f"SELECT {ORDERS_BRIEF} FROM orders WHERE o_orderdate BETWEEN "
                       f"{_ts('1997-01-01')} AND {_ts('1998-12-31')}"),
    "filter_is_null": f"SELECT d.doc_id, d.lang, d.source, l.quality FROM {DOCS_LABELS} WHERE l.quality IS NULL",
    "filter_is_not_null": (f"SELECT d.doc_id, d.lang, d.source, l.quality FROM {DOCS_LABELS} "
                           "WHERE l.quality IS NOT NULL"),
    "like_prefix": f"SELECT {PARTS} FROM part WHERE p_name LIKE 'blue%'",
    "like_suffix": f"SELECT {PARTS} FROM part WHERE p_name LIKE '%bolt'",
    "like_contains": "SELECT doc_id, lang, n_chars FROM documents WHERE text LIKE '%license%'",
    "like_single_char": "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE 'Customer#_________'",
    "like_or_range": (f"SELECT {PARTS} FROM part WHERE (p_name LIKE 'blue%' OR p_name LIKE 'cold%') "
                      "AND p_retailprice >= 980 ORDER BY p_retailprice DESC, p_partkey"),
    "filter_eq_null": (
        "SELECT d.lang, COUNT(*) AS n_docs, COUNT(*) FILTER (WHERE l.quality = NULL) AS n_eq_null, "
        f"COUNT(*) FILTER (WHERE l.quality IS NULL) AS n_is_null FROM {DOCS_LABELS} GROUP BY d.lang"),
    "like_ci": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment ILIKE 'build%'",
    # J
    "join_inner": (f"SELECT o.o_orderkey, {_dy('o.o_orderdate')} AS basis_dy, c.c_name, o.o_totalprice "
                   "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"),
    "join_inner_on_const": ("SELECT c.c_custkey, c.c_name, n.n_name, c.c_mktsegment, c.c_acctbal "
                            "FROM customer c INNER JOIN nation n ON c.c_nationkey = n.n_nationkey "
                            "AND n.n_regionkey <= 2 ORDER BY n.n_name, c.c_custkey"),
    "join_left": f"SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM {DOCS_LABELS} ORDER BY d.doc_id",
    "join_right": ("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM labels l "
                   "RIGHT JOIN documents d ON l.doc_id = d.doc_id"),
    "join_full": (f"SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice FROM customer c "
                  f"FULL OUTER JOIN orders o ON c.c_custkey = o.o_custkey"),
    "join_full_dedup": (f"SELECT c.c_name, o.o_orderstatus FROM customer c LEFT JOIN orders o "
                        "ON c.c_custkey = o.o_custkey UNION "
                        f"SELECT c.c_name, o.o_orderstatus FROM orders o LEFT JOIN customer c "
                        "ON c.c_custkey = o.o_custkey"),
    "join_composite": ("SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, k.n_rows FROM lineitem l "
                       "JOIN (SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem "
                       "GROUP BY l_orderkey, l_linenumber) k "
                       "ON l.l_orderkey = k.l_orderkey AND l.l_linenumber = k.l_linenumber"),
    "join_three": (f"SELECT c.c_name, {_dy('o.o_orderdate')} AS basis_dy, o.o_orderkey, l.l_linenumber, "
                   "l.l_quantity, l.l_extendedprice, o.o_totalprice FROM lineitem l "
                   "JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey "
                   f"WHERE o.o_orderdate BETWEEN {_ts('1997-01-01')} AND {_ts('1997-12-31')} "
                   "ORDER BY basis_dy, c.c_name, o.o_orderkey, l.l_linenumber"),
    "join_four_mixed": ("SELECT o.o_orderkey, c.c_name, n.n_name, t.line_count, t.qty_total, o.o_totalprice "
                        "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
                        f"JOIN {NATION_DIM} n ON c.c_nationkey = n.n_nationkey "
                        "LEFT JOIN (SELECT l_orderkey, COUNT(*) AS line_count, SUM(l_quantity) AS qty_total "
                        "FROM lineitem GROUP BY l_orderkey) t ON o.o_orderkey = t.l_orderkey"),
    "join_dim_filter": (f"SELECT n.n_name, {_dy('o.o_orderdate')} AS basis_dy, o.o_orderkey, o.o_totalprice "
                        "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
                        f"JOIN {NATION_DIM} n ON c.c_nationkey = n.n_nationkey "
                        f"WHERE n.zone = 'ASIA' AND o.o_orderstatus = 'F' AND o.o_orderdate BETWEEN "
                        f"{_ts('1997-01-01')} AND {_ts('1998-12-31')} ORDER BY o.o_totalprice DESC, o.o_orderkey"),
    "join_left_coalesce": ("SELECT d.doc_id, CASE d.lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' "
                           "WHEN 'de' THEN 'German' ELSE 'other' END AS lang_name, "
                           f"COALESCE(l.quality, 0) AS quality FROM {DOCS_LABELS} ORDER BY d.doc_id"),
    # A
    "agg_basic": (f"SELECT {_ym('l_shipdate')} AS basis_ym, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_qty, "
                  f"CAST(ROUND({_money_sum('l_extendedprice')}, 1) AS DOUBLE) AS total_price "
                  "FROM lineitem GROUP BY basis_ym ORDER BY basis_ym"),
    "agg_count_col": (f"SELECT d.lang, COUNT(*) AS n_docs, COUNT(l.quality) AS n_labeled FROM {DOCS_LABELS} "
                      "GROUP BY d.lang"),
    "agg_stats": ("SELECT l_returnflag, COUNT(*) AS n_lines, ROUND(AVG(l_quantity), 0) AS avg_qty, "
                  "MAX(l_quantity) AS max_qty, MIN(l_quantity) AS min_qty FROM lineitem "
                  "GROUP BY l_returnflag ORDER BY avg_qty DESC, l_returnflag"),
    "agg_round": ("SELECT l_returnflag, l_linestatus, CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) "
                  "* (1 - CAST(l_discount AS DECIMAL(18,2)))), 2) AS DOUBLE) AS sum_disc_price, "
                  f"CAST(ROUND({_money_sum('l_extendedprice')}, 1) AS DOUBLE) AS sum_price, "
                  "ROUND(AVG(l_quantity), 0) AS avg_qty FROM lineitem "
                  "GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus"),
    "round_rows": ("SELECT c_custkey, c_acctbal, "
                   + ", ".join(f"CAST(ROUND(CAST(c_acctbal AS DECIMAL(18,2)), {n}) AS DOUBLE) AS {a}"
                               for n, a in ((1, "to_tenths"), (0, "to_units"), (-2, "to_hundreds")))
                   + " FROM customer"),
    "agg_multi_key": (f"SELECT {_yr('l_shipdate')} AS basis_year, l_returnflag, SUM(l_quantity) AS sum_qty "
                      f"FROM lineitem WHERE l_shipdate BETWEEN {_ts('1996-01-01')} AND {_ts('2000-12-31')} "
                      "GROUP BY basis_year, l_returnflag HAVING SUM(l_quantity) >= 70000 "
                      "ORDER BY sum_qty DESC, basis_year, l_returnflag"),
    "having_avg": ("SELECT l_linenumber, ROUND(AVG(l_quantity), 0) AS avg_qty FROM lineitem "
                   "GROUP BY l_linenumber HAVING AVG(l_quantity) >= 25.5 ORDER BY avg_qty DESC, l_linenumber"),
    "where_group_having": (f"SELECT o_custkey, CAST({_money_sum('o_totalprice')} AS DOUBLE) AS total_price, "
                           f"COUNT(*) AS n_orders FROM orders WHERE o_orderdate >= {_ts('1999-01-01')} "
                           f"GROUP BY o_custkey HAVING {_money_sum('o_totalprice')} >= 1000000 "
                           "ORDER BY total_price DESC, o_custkey"),
    "having_scalar_subquery": (f"SELECT {_ym('l_shipdate')} AS basis_ym, SUM(l_quantity) AS sum_qty FROM lineitem "
                               "GROUP BY basis_ym HAVING SUM(l_quantity) >= (SELECT AVG(t) FROM "
                               f"(SELECT SUM(l_quantity) AS t FROM lineitem GROUP BY {_ym('l_shipdate')}) s) "
                               "ORDER BY sum_qty DESC, basis_ym"),
    "cond_agg_pivot": (f"SELECT {_yr('l_shipdate')} AS basis_year, "
                       "SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned_qty, "
                       "SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS accepted_qty, "
                       "SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS none_qty, "
                       "SUM(l_quantity) AS total_qty FROM lineitem GROUP BY basis_year ORDER BY basis_year"),
    "group_code_label": (f"SELECT {_yr('l_shipdate')} AS basis_year, "
                         "CASE l_returnflag WHEN 'R' THEN 'returned' ELSE 'other' END AS return_name, "
                         "SUM(l_quantity) AS sum_qty FROM lineitem "
                         f"GROUP BY {_yr('l_shipdate')}, l_returnflag ORDER BY basis_year, sum_qty DESC"),
    "agg_of_agg": ("SELECT AVG(t) AS avg_total FROM "
                   "(SELECT SUM(l_quantity) AS t FROM lineitem GROUP BY l_suppkey) s"),
    "join_agg": ("SELECT n.n_name, c.c_mktsegment, COUNT(*) AS n_orders, "
                 f"CAST({_money_sum('o.o_totalprice')} AS DOUBLE) AS total_price "
                 "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
                 f"JOIN {NATION_DIM} n ON c.c_nationkey = n.n_nationkey "
                 "GROUP BY n.n_name, c.c_mktsegment ORDER BY n.n_name, c.c_mktsegment"),
    # O, U
    "order_desc": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
    "order_mixed": (f"SELECT {_dy('o.o_orderdate')} AS basis_dy, o.o_orderkey, l.l_linenumber, l.l_extendedprice "
                    "FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey "
                    "ORDER BY basis_dy ASC, l.l_extendedprice DESC, o.o_orderkey, l.l_linenumber"),
    "order_alias": (f"SELECT {_ym('o_orderdate')} AS basis_ym, CAST({_money_sum('o_totalprice')} AS DOUBLE) "
                    "AS total_price FROM orders GROUP BY basis_ym ORDER BY total_price DESC, basis_ym"),
    "order_hidden_col": ("SELECT d.doc_id, d.lang, COALESCE(CAST(l.quality AS VARCHAR), 'unlabeled') AS quality_text "
                         f"FROM {DOCS_LABELS} WHERE l.quality IS NOT NULL ORDER BY l.quality, d.doc_id"),
    "limit_n": f"SELECT {ORDERS_BRIEF} FROM orders ORDER BY o_orderkey LIMIT 10",
    "top_k": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "union_distinct": "SELECT o_custkey AS custkey FROM orders UNION SELECT c_custkey FROM customer",
    # C
    "case_simple": (f"SELECT o_orderkey, {_dy('o_orderdate')} AS basis_dy, o_orderpriority, "
                    f"{PRIORITY} AS priority_name, o_totalprice FROM orders"),
    "case_searched": f"SELECT l_orderkey, l_linenumber, l_returnflag, {FLAG} AS return_status FROM lineitem",
    "case_bands": f"SELECT o_orderkey, o_totalprice, {BAND} AS size_band FROM orders ORDER BY o_totalprice DESC, o_orderkey",
    "case_no_else": ("SELECT l_orderkey, l_linenumber, l_linestatus, "
                     "CASE l_linestatus WHEN 'F' THEN 'filled' END AS status_name FROM lineitem"),
    "coalesce_zero": f"SELECT d.doc_id, l.quality AS quality_raw, COALESCE(l.quality, 0) AS quality FROM {DOCS_LABELS}",
    "coalesce_chain": f"SELECT l_orderkey, l_linenumber, l_discount, l_tax, {RATE_PCT} AS rate_pct FROM lineitem",
    "coalesce_text": (f"SELECT d.doc_id, COALESCE(CAST(l.quality AS VARCHAR), 'unlabeled') AS quality_text "
                      f"FROM {DOCS_LABELS}"),
    "case_in_clauses": (f"SELECT {BAND} AS size_band, COUNT(*) AS n_orders FROM orders "
                        "WHERE CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END = 1 GROUP BY size_band "
                        "ORDER BY CASE size_band WHEN 'large' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END"),
    "coalesce_case": f"SELECT l_orderkey, l_linenumber, {RATE_PCT} AS rate_pct, {FLAG} AS return_status FROM lineitem",
    # R
    "report_status": (f"SELECT basis_year, n.n_name, n.zone, {STATUS} AS status_name, COUNT(*) AS n_orders, "
                      f"CAST(ROUND({_money_sum('o_totalprice')}, 1) AS DOUBLE) AS total_price "
                      f"FROM {ORDERS_NATION} f JOIN {NATION_DIM} n ON f.c_nationkey = n.n_nationkey "
                      "GROUP BY basis_year, n.n_name, n.zone, o_orderstatus "
                      "ORDER BY basis_year DESC, n_orders DESC, n.n_name, status_name"),
    "report_integrated": ("SELECT o.o_orderkey, n.n_name, c.c_acctbal, o.o_totalprice, "
                          "COALESCE(t.qty_total, 0.0) AS qty_total, COALESCE(t.line_count, 0) AS line_count "
                          "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
                          f"JOIN {NATION_DIM} n ON c.c_nationkey = n.n_nationkey "
                          "LEFT JOIN (SELECT l_orderkey, COUNT(*) AS line_count, SUM(l_quantity) AS qty_total "
                          "FROM lineitem GROUP BY l_orderkey) t ON o.o_orderkey = t.l_orderkey "
                          f"WHERE o.o_orderdate >= {_ts('2000-01-01')} ORDER BY o.o_orderkey"),
    "report_zone_pivot": ZONE_PIVOT + " ORDER BY basis_year",
    "report_price": (f"SELECT li.l_orderkey, li.l_linenumber, {RATE_PCT} AS rate_pct, {FLAG} AS return_status, "
                     "o.o_orderpriority FROM lineitem li LEFT JOIN orders o ON li.l_orderkey = o.o_orderkey "
                     "ORDER BY li.l_orderkey, li.l_linenumber"),
    "report_above_average": (ZONE_PIVOT + f" HAVING {_money_sum('o_totalprice')} >= (SELECT AVG(t) FROM "
                             f"(SELECT {_money_sum('o_totalprice')} AS t FROM orders GROUP BY {_yr('o_orderdate')}) s) "
                             "ORDER BY total_price DESC"),
    "report_label_totals": (f"SELECT {_yr('o_orderdate')} AS basis_year, {PRIORITY} AS priority_name, "
                            f"COUNT(*) AS n_orders, CAST({_money_sum('o_totalprice')} AS DOUBLE) AS total_price "
                            f"FROM orders GROUP BY {_yr('o_orderdate')}, o_orderpriority "
                            "ORDER BY basis_year, total_price DESC"),
    "report_product_pivot": (f"SELECT {_yr('o_orderdate')} AS basis_year, "
                             "CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS finished_price, "
                             "CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS open_price, "
                             f"CAST({_money_sum('o_totalprice')} AS DOUBLE) AS total_price FROM orders "
                             "GROUP BY basis_year ORDER BY basis_year"),
}
