"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark plans: frequent sets of size k are a
k-way self-join of the transactions on ``tid`` with ascending items,
``GROUP BY`` the items, ``HAVING sum(weight of the first item) >=
threshold``; rules join every set's subsets, by bitmask, with the sets. Float discipline matches the Spark side: values and confidences
compared as FLOAT, the support ratio taken as a DOUBLE literal and the
threshold truncated (SQL literals like ``0.2`` are decimals otherwise).
"""

from __future__ import annotations

from basketry.plans import tables as fx


def _lit_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _strong(col: str, cutoff: float, inclusive: bool) -> str:
    op = ">=" if inclusive else ">"
    return (f"CAST({col} AS FLOAT) {op} CAST({cutoff!r} AS FLOAT) "
            f"AND NOT isnan({col})")


def _fa_token_pred(tok: str) -> str:
    names = ", ".join("lower('" + n + "')" for n in fx.FA_NAMES)
    return f"(contains({tok}, '{fx.FA_SUBSTRING}') OR lower({tok}) IN ({names}))"


FA_TOKENS = f"""
fa_tok AS (
  SELECT p_partkey AS tid, tok AS category
  FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tok FROM part)
  WHERE {_fa_token_pred('tok')}
)"""

FA_COUNTS = f"""
fa_strong AS (
  SELECT l_partkey AS tid, l_extendedprice AS value FROM lineitem
  WHERE {_strong('l_extendedprice', fx.FA_CUTOFF, False)}
),{FA_TOKENS},
fa_counts AS (
  SELECT t.category, CAST(count(*) AS BIGINT) AS n
  FROM fa_strong s JOIN fa_tok t ON s.tid = t.tid GROUP BY t.category
)"""


def _fb_tx(distinct: bool) -> str:
    if distinct:
        tx = ("SELECT DISTINCT sm.tid, sm.item, CAST(1 AS BIGINT) AS m "
              "FROM sm JOIN ents ON sm.tid = ents.tid")
    else:
        tx = ("SELECT sm.tid, sm.item, CAST(sum(ents.n_ent) AS BIGINT) AS m "
              "FROM sm JOIN ents ON sm.tid = ents.tid GROUP BY sm.tid, sm.item")
    return f"""
sm AS (
  SELECT o.o_custkey AS tid, CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS item
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE {_strong('l.l_extendedprice', fx.FB_CUTOFF, True)}
),
ents AS (
  SELECT c_custkey AS tid, count(*) AS n_ent FROM customer
  WHERE list_has_any(string_split(c_mktsegment, ' '), {_lit_list(fx.FB_CATEGORIES)})
  GROUP BY c_custkey
),
tx AS ({tx}),
stats AS (
  SELECT count(DISTINCT tid) AS n,
         CAST(floor(count(DISTINCT tid) * CAST({fx.FB_MIN_SUPPORT!r} AS DOUBLE)) AS BIGINT) AS th
  FROM tx
)"""


def _level(k: int) -> str:
    if k == 1:
        return """
  SELECT [item] AS items, 1 AS k, CAST(sum(m) AS BIGINT) AS support
  FROM tx GROUP BY item
  HAVING sum(m) >= (SELECT greatest(th, 1) FROM stats)"""
    joins = ["txf a1"]
    for i in range(2, k + 1):
        joins.append(f"JOIN txf a{i} ON a{i}.tid = a1.tid AND a{i}.item > a{i - 1}.item")
    items = ", ".join(f"a{i}.item" for i in range(1, k + 1))
    return f"""
  SELECT [{items}] AS items, {k} AS k, CAST(sum(a1.m) AS BIGINT) AS support
  FROM {' '.join(joins)}
  GROUP BY {items}
  HAVING sum(a1.m) >= (SELECT greatest(th, 1) FROM stats)"""


def _freq(distinct: bool, max_size: int) -> str:
    levels = "\n  UNION ALL".join(f"({_level(k)}\n  )" for k in range(1, max_size + 1))
    return f"""{_fb_tx(distinct)},
l1 AS ({_level(1)}
),
txf AS (SELECT * FROM tx WHERE item IN (SELECT items[1] FROM l1)),
freq AS MATERIALIZED (
  {levels}
)"""


def _rules(min_conf: float | None) -> str:
    where = "" if min_conf is None else f"WHERE conf >= CAST({min_conf!r} AS FLOAT)"
    return f"""
subs AS (
  SELECT items, support,
         list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS ant
  FROM (SELECT items, support, unnest(generate_series(1, (1 << k) - 2)) AS mask
        FROM freq WHERE k >= 2)
),
rules AS (
  SELECT s.ant, list_filter(s.items, lambda x: NOT list_contains(s.ant, x)) AS cons,
         s.support, r.support AS antecedent_support,
         CAST(CAST(s.support AS FLOAT) / CAST(r.support AS FLOAT) AS FLOAT) AS conf
  FROM subs s JOIN freq r ON r.items = s.ant
),
kept AS (SELECT * FROM rules {where})"""


RULES_OUT = """
SELECT array_to_string(ant, ';') AS antecedent, array_to_string(cons, ';') AS consequent,
       support, antecedent_support, CAST(conf AS DOUBLE) AS confidence
FROM kept"""

TEXT_ROWS = """
SELECT CAST(o.o_custkey AS VARCHAR) AS tid,
       CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS item,
       CAST(CAST(l.l_extendedprice AS FLOAT) AS DOUBLE) AS value
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey"""

SETS_OUT = "SELECT array_to_string(items, ';') AS itemset, k, support FROM freq"

REPORT_LINES = """
SELECT CAST(support AS VARCHAR) || chr(9) ||
       string_agg(array_to_string(items, ';'), chr(9) ORDER BY k, items) AS line
FROM freq GROUP BY support"""


_REPORT_LINE = """CAST(support AS VARCHAR) || chr(9) ||
       string_agg(array_to_string(items, ';'), chr(9) ORDER BY k, items)"""

A_PRICE = """(SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice
   LIMIT 1 OFFSET (SELECT CAST(ceil(count(*) * 0.5) AS BIGINT) - 1 FROM lineitem))"""


def oracle_sql() -> dict[str, str]:
    d5 = _freq(True, fx.FB_MAX_SIZE)
    b5 = _freq(False, fx.FB_MAX_SIZE)
    tx_only = lambda distinct: _fb_tx(distinct)
    return {
        "strong_filter_gt": f"""
SELECT l_partkey AS tid, l_extendedprice AS value FROM lineitem
WHERE {_strong('l_extendedprice', fx.FA_CUTOFF, False)}""",
        "strong_filter_ge": f"""
SELECT l_partkey AS tid, l_extendedprice AS value FROM lineitem
WHERE {_strong('l_extendedprice', fx.FA_CUTOFF, True)}""",
        "text_scan_header": TEXT_ROWS,
        "text_roundtrip_writer": TEXT_ROWS,
        "entity_text_scan": "SELECT CAST(c_custkey AS VARCHAR) AS tid, c_mktsegment AS segment "
                            "FROM customer",
        "entity_any_token": f"""
SELECT c_custkey AS tid, c_mktsegment AS segment FROM customer
WHERE list_has_any(string_split(c_mktsegment, ' '), {_lit_list(fx.FB_CATEGORIES)})""",
        "category_tokens": f"WITH {FA_TOKENS.strip()} SELECT tid, category FROM fa_tok",
        "strong_join_entities": f"""
SELECT l.l_partkey AS tid, l.l_extendedprice AS value, p.p_name AS name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE {_strong('l.l_extendedprice', fx.FA_CUTOFF, False)}""",
        "category_counts": f"WITH {FA_COUNTS.strip()} SELECT category, n FROM fa_counts",
        "category_report_lines": f"""
WITH {FA_COUNTS.strip()}
SELECT category || chr(9) || CAST(n AS VARCHAR) AS line FROM fa_counts""",
        "transactions_distinct": f"WITH {tx_only(True).strip()} SELECT tid, item, m FROM tx",
        "transactions_bag": f"WITH {tx_only(False).strip()} SELECT tid, item, m FROM tx",
        "baskets": f"""
WITH {tx_only(True).strip()}
SELECT tid, array_to_string(list(item ORDER BY item), ';') AS items FROM tx GROUP BY tid""",
        "basket_sizes": f"""
WITH {tx_only(False).strip()}
SELECT tid, CAST(count(*) AS BIGINT) AS n_items, CAST(sum(m) AS BIGINT) AS basket_size
FROM tx GROUP BY tid""",
        "support_stats": f"""
WITH {tx_only(False).strip()},
per AS (SELECT tid, sum(m) AS size, max(m) AS w FROM tx GROUP BY tid)
SELECT CAST(count(*) AS BIGINT) AS n_transactions,
       CAST(floor(count(*) * CAST({fx.FB_MIN_SUPPORT!r} AS DOUBLE)) AS BIGINT) AS threshold,
       CAST(coalesce(max(size), 0) AS BIGINT) AS max_basket,
       CAST(coalesce(max(w), 0) AS BIGINT) AS max_weight,
       CAST(least({fx.FB_MAX_SIZE}, coalesce(max(size), 0)) AS BIGINT) AS k_effective
FROM per""",
        "frequent_items": f"WITH {_freq(True, 1).strip()} "
                          "SELECT array_to_string(items, ';') AS itemset, support FROM freq",
        "frequent_pairs": f"WITH {_freq(True, 2).strip()} "
                          "SELECT array_to_string(items, ';') AS itemset, support "
                          "FROM freq WHERE k = 2",
        "frequent_triples": f"WITH {_freq(True, 3).strip()} "
                            "SELECT array_to_string(items, ';') AS itemset, support "
                            "FROM freq WHERE k = 3",
        "frequent_itemsets": f"WITH {d5.strip()} {SETS_OUT}",
        "frequent_itemsets_bag": f"WITH {b5.strip()} {SETS_OUT}",
        "itemset_report_lines": f"""
WITH {d5.strip()}
SELECT support, CAST(count(*) AS BIGINT) AS n_sets,
       CAST(support AS VARCHAR) || chr(9) ||
       string_agg(array_to_string(items, ';'), chr(9) ORDER BY k, items) AS line
FROM freq GROUP BY support""",
        "report_sink": f"WITH {d5.strip()} {REPORT_LINES}",
        "report_streamed": f"WITH {d5.strip()} {REPORT_LINES}",
        "report_parse": f"WITH {d5.strip()} {SETS_OUT}",
        "itemset_max_size": f"WITH {d5.strip()} SELECT max(k) AS max_k FROM freq",
        "proper_subsets": f"""
WITH {d5.strip()},
masks AS (SELECT items, k, unnest(generate_series(1, (1 << k) - 2)) AS mask
          FROM freq WHERE k >= 2)
SELECT array_to_string(items, ';') AS itemset,
       array_to_string(list_filter(items, lambda x, i: ((mask >> (i - 1)) & 1) = 1), ';')
         AS subset
FROM masks""",
        "rules_all": f"WITH {d5.strip()},{_rules(None).strip()} {RULES_OUT}",
        "rules_confident": f"WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()} {RULES_OUT}",
        "rules_ordered": f"WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()} {RULES_OUT}",
        "rules_bag": f"WITH {b5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()} {RULES_OUT}",
        "category_job_text": f"""
WITH {FA_COUNTS.strip()}
SELECT category || chr(9) || CAST(n AS VARCHAR) AS line FROM fa_counts""",
        "itemset_job_text": f"WITH {b5.strip()} {REPORT_LINES}",
        "rule_job_text": f"""
WITH {b5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()}
SELECT array_to_string(ant, ' ') || chr(9) || array_to_string(cons, ' ') || chr(9)
       || CAST(conf AS VARCHAR) AS line
FROM kept""",
        "rule_report_lines": f"""
WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()}
SELECT array_to_string(ant, ' ') || chr(9) || array_to_string(cons, ' ') || chr(9)
       || CAST(conf AS VARCHAR) AS line
FROM kept""",
        "rules_unsorted_report": f"""
WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()}
SELECT array_to_string(list_reverse(ant), ';') AS antecedent,
       array_to_string(list_reverse(cons), ';') AS consequent,
       support, antecedent_support, CAST(conf AS DOUBLE) AS confidence
FROM kept""",
        "rules_text_items": f"""
WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()}
SELECT array_to_string(list_sort(list_transform(ant, lambda x: 'Brand#' || x)), ';') AS antecedent,
       array_to_string(list_sort(list_transform(cons, lambda x: 'Brand#' || x)), ';') AS consequent,
       support, antecedent_support, CAST(conf AS DOUBLE) AS confidence
FROM kept""",
        "rules_grown": f"WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()} {RULES_OUT}",
        "rules_from_table": f"WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()} {RULES_OUT}",
        "strong_filter_gt_tie": f"""
SELECT l_partkey AS tid, l_extendedprice AS value FROM lineitem
WHERE CAST(l_extendedprice AS FLOAT) > CAST({A_PRICE} AS FLOAT)""",
        "strong_filter_ge_tie": f"""
SELECT l_partkey AS tid, l_extendedprice AS value FROM lineitem
WHERE CAST(l_extendedprice AS FLOAT) >= CAST({A_PRICE} AS FLOAT)""",
        "entity_any_of_many_tokens": f"""
SELECT p_partkey AS tid, p_name AS name FROM part
WHERE list_has_any(string_split(p_name, ' '), {_lit_list(fx.FA_TOKEN_LIST)})""",
        "transactions_repeated_entities": f"""
WITH {_fb_tx(False).strip()}
SELECT tid, item, m * (CASE WHEN tid % 2 = 1 THEN 2 ELSE 1 END) AS m FROM tx""",
        "category_counts_ranked": f"""
WITH {FA_COUNTS.strip()}
SELECT category, n, row_number() OVER (ORDER BY n DESC, category) AS rank FROM fa_counts""",
        "itemset_lines_ranked": f"""
WITH {d5.strip()}, lines AS (SELECT support, {_REPORT_LINE} AS line FROM freq GROUP BY support)
SELECT line, row_number() OVER (ORDER BY support DESC) AS rank FROM lines""",
        "rule_lines_ranked": f"""
WITH {d5.strip()},{_rules(fx.FB_MIN_CONFIDENCE).strip()}
SELECT array_to_string(ant, ' ') || chr(9) || array_to_string(cons, ' ') || chr(9)
       || CAST(conf AS VARCHAR) AS line,
       row_number() OVER (ORDER BY conf DESC, ant, cons) AS rank
FROM kept""",
    }
