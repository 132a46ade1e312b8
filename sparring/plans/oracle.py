"""DuckDB SQL twins of the queries, over the same Parquet tables."""

from __future__ import annotations

from sparring.plans.queries import LEAKY_NUMERIC, STATUSES

# Types of the standard tables' columns: n numeric, o other.
COLUMN_TYPES = {
    "region": {"r_regionkey": "n", "r_name": "o"},
    "nation": {"n_nationkey": "n", "n_name": "o", "n_regionkey": "n"},
    "customer": {"c_custkey": "n", "c_name": "o", "c_nationkey": "n", "c_acctbal": "n", "c_mktsegment": "o"},
    "supplier": {"s_suppkey": "n", "s_name": "o", "s_nationkey": "n", "s_acctbal": "n"},
    "part": {
        "p_partkey": "n", "p_name": "o", "p_brand": "o", "p_type": "o", "p_size": "n", "p_retailprice": "n",
    },
    "orders": {
        "o_orderkey": "n", "o_custkey": "n", "o_orderstatus": "o", "o_totalprice": "n", "o_orderdate": "o",
        "o_orderpriority": "o",
    },
    "lineitem": {
        "l_orderkey": "n", "l_partkey": "n", "l_suppkey": "n", "l_linenumber": "n", "l_quantity": "n",
        "l_extendedprice": "n", "l_discount": "n", "l_tax": "n", "l_returnflag": "o", "l_linestatus": "o",
        "l_shipdate": "o",
    },
    "events": {"event_id": "n", "ts": "o", "user_id": "n", "event_type": "o", "value": "n", "props": "o"},
    "documents": {"doc_id": "n", "text": "o", "lang": "o", "source": "o", "n_chars": "n"},
    "embeddings": {"vec_id": "n", "embedding": "o", "label": "n"},
    "pages": {"page_id": "n", "url": "o", "html": "o"},
    "benchmark": {"item_id": "n", "text": "o"},
    "labels": {"doc_id": "n", "quality": "n", "toxic": "n"},
    "conversations": {"conv_id": "n", "turn": "n", "role": "o", "text": "o"},
}


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def plain_split(source: str, key: str) -> str:
    """All columns of `source` and `split`, not stratified."""
    return f"""
    SELECT s.*, CASE WHEN row_number() OVER (
        ORDER BY md5(concat_ws('|', CAST({key} AS VARCHAR), '42')), CAST({key} AS VARCHAR)
      ) <= (SELECT ceil(CAST(0.2 AS DOUBLE) * count(*)) FROM {source}) THEN 'test' ELSE 'train' END AS split
    FROM {source} s"""


def stratified_split(source: str, key: str, target: str) -> str:
    """All columns of `source` and `split`, stratified by `target` with largest remainders."""
    return f"""
    SELECT s.*, CASE WHEN row_number() OVER (
        PARTITION BY s.{target}
        ORDER BY md5(concat_ws('|', CAST({key} AS VARCHAR), '42')), CAST({key} AS VARCHAR)
      ) <= q.quota THEN 'test' ELSE 'train' END AS split
    FROM {source} s JOIN (
      SELECT c, base + CASE WHEN row_number() OVER (
          ORDER BY rest DESC, md5(concat_ws('|', CAST(c AS VARCHAR), '42'))
        ) <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota
      FROM (
        SELECT c, n_test, (n_test * k) // n AS base, (n_test * k) % n AS rest
        FROM (SELECT {target} AS c, count(*) AS k FROM {source} GROUP BY 1),
             (SELECT count(*) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS n_test FROM {source})
      )
    ) q ON s.{target} = q.c"""


LEAKY = """(
    SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_extendedprice, l_linenumber,
      CASE WHEN l_returnflag = 'R' THEN l_tax END AS only_r,
      7 AS always_seven,
      2 * l_quantity + l_discount AS twice_quantity,
      CASE WHEN l_returnflag = 'A' THEN 1 ELSE l_linenumber END AS flat_in_a,
      CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS zero_but_r,
      CASE WHEN l_returnflag = 'R' THEN 3 ELSE l_quantity END AS floor_in_r,
      l_returnflag || l_linestatus AS flag_and_status
    FROM lineitem)"""


def _task_inference() -> str:
    parts = []
    for name, columns in COLUMN_TYPES.items():
        for c, kind in columns.items():
            task = f"CASE WHEN count(DISTINCT {c}) > 15 THEN 'regression' ELSE 'classification' END"
            task = task if kind == "n" else "'classification'"
            source = f"FROM {name}" if kind == "n" else ""
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, {task} AS task {source}")
    return union(parts)


def _column_kinds() -> str:
    parts = []
    for c, kind in COLUMN_TYPES["lineitem"].items():
        if c != "l_shipdate":
            kind = "numeric" if kind == "n" else "categorical"
            parts.append(f"SELECT '{c}' AS col, '{kind}' AS kind, count({c}) AS n_values FROM lineitem")
    return union(parts)


def _id_like() -> str:
    return union(
        f"""SELECT '{c}' AS col, 'id_like' AS rule, round(v, 6) AS stat,
          printf('id_like (high_unique_frac=%.3f)', v) AS reason
        FROM (SELECT (count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) / CAST(count(*) AS DOUBLE)
                AS v FROM {LEAKY}) WHERE v >= 0.8"""
        for c in [*LEAKY_NUMERIC, "l_linestatus", "flag_and_status"]
    )


def _gaps() -> str:
    numeric = union(
        f"""SELECT '{c}' AS col, max(present) - min(present) AS presence_gap, max(zeros) - min(zeros) AS zero_gap,
          bool_or(n_unique = 1) AND NOT bool_and(n_unique = 1) AS mixed_constancy
        FROM (SELECT l_returnflag, avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END) AS present,
                avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS zeros,
                count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique
              FROM {LEAKY} GROUP BY l_returnflag)"""
        for c in LEAKY_NUMERIC
    )
    other = """SELECT 'l_linestatus', max(present) - min(present), NULL, NULL
        FROM (SELECT l_returnflag, avg(CASE WHEN l_linestatus IS NOT NULL THEN 1.0 ELSE 0.0 END) AS present
              FROM lineitem GROUP BY l_returnflag)"""
    return f"{numeric}\nUNION ALL\n{other}"


def _moments() -> str:
    return union(
        f"""SELECT '{c}' AS col, count({c}) AS n_values, CAST(min({c}) AS DOUBLE) AS low,
          CAST(max({c}) AS DOUBLE) AS high, count(DISTINCT {c}) AS n_unique,
          CASE WHEN count(DISTINCT {c}) > 1 THEN corr(CAST({c} AS DOUBLE), l_quantity) END AS corr
        FROM {LEAKY}"""
        for c in LEAKY_NUMERIC[1:]
    )


def _minimum_gaps() -> str:
    return union(
        f"""SELECT '{c}' AS col, max(share) - min(share) AS gap
        FROM (SELECT l_returnflag, avg(CASE WHEN {c} = low THEN 1.0 ELSE 0.0 END) AS share
              FROM (SELECT l_returnflag, {c}, min({c}) OVER (PARTITION BY l_returnflag) AS low FROM {LEAKY})
              GROUP BY l_returnflag)"""
        for c in LEAKY_NUMERIC
    )


def _constant_within_class() -> str:
    return union(
        f"""SELECT '{c}' AS col, 'constant_within_class' AS rule,
          'constant_within_class (per_class_nunique={{' ||
            string_agg('''' || l_returnflag || ''': ' || n, ', ' ORDER BY l_returnflag) || '}})' AS reason
        FROM (SELECT l_returnflag, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n
              FROM {LEAKY} GROUP BY 1)
        HAVING min(n) = 1 AND max(n) <> 1"""
        for c in LEAKY_NUMERIC
    )


def _leak_report() -> str:
    source = """(SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice, o_orderpriority,
      CASE WHEN o_orderstatus = 'O' THEN o_custkey % 7 END AS only_o,
      CASE WHEN o_orderstatus = 'F' THEN 5 ELSE o_custkey % 11 END AS flat_in_f,
      CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 50 = 0 THEN 1 ELSE 0 END
           ELSE o_custkey % 5 + 1 END AS zero_in_f,
      CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 40 = 0 THEN 3 ELSE 2 END
           ELSE o_custkey % 50 + 2 END AS floor_in_f,
      o_orderstatus || CAST(o_custkey % 10 AS VARCHAR) AS status_code
      FROM orders)"""
    numeric = ["o_custkey", "o_totalprice", "only_o", "flat_in_f", "zero_in_f", "floor_in_f"]
    text = ["o_orderpriority", "status_code"]
    found = []
    for c in [*numeric, *text]:
        n_unique = f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
        found.append(
            f"SELECT '{c}' AS col, 1 AS place, 'id_like' AS rule, v AS stat, "
            f"printf('id_like (high_unique_frac=%.3f)', v) AS reason "
            f"FROM (SELECT ({n_unique}) / CAST(count(*) AS DOUBLE) AS v FROM train) WHERE v >= 0.8"
        )
        found.append(
            f"SELECT '{c}', 2, 'presence_diff', v, printf('presence_diff (nonnull_frac_diff=%.3f)', v) FROM "
            f"(SELECT max(p) - min(p) AS v FROM (SELECT avg(CASE WHEN {c} IS NULL THEN 0.0 ELSE 1.0 END) AS p "
            f"FROM train GROUP BY o_orderstatus)) WHERE v > 0.9"
        )
    for c in numeric:
        n_unique = f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
        found.append(
            f"SELECT '{c}', 5, 'constant_within_class', 1.0, 'constant_within_class (per_class_nunique={{' || "
            f"string_agg('''' || o_orderstatus || ''': ' || n, ', ' ORDER BY o_orderstatus) || '}})' FROM "
            f"(SELECT o_orderstatus, {n_unique} AS n FROM train GROUP BY 1) HAVING min(n) = 1 AND max(n) <> 1"
        )
        found.append(
            f"SELECT '{c}', 6, 'zero_fraction_diff', v, printf('zero_fraction_diff (zero_frac_diff=%.3f)', v) FROM "
            f"(SELECT max(z) - min(z) AS v FROM (SELECT avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS z "
            f"FROM train GROUP BY o_orderstatus)) WHERE v >= 0.9"
        )
        found.append(
            f"SELECT '{c}', 7, 'min_value_presence_diff', v, "
            f"printf('min_value_presence_diff (min_fraction_diff=%.3f)', v) FROM "
            f"(SELECT max(m) - min(m) AS v FROM (SELECT avg(CASE WHEN {c} = low THEN 1.0 ELSE 0.0 END) AS m FROM "
            f"(SELECT o_orderstatus, {c}, min({c}) OVER (PARTITION BY o_orderstatus) AS low FROM train) "
            f"GROUP BY o_orderstatus)) WHERE v >= 0.9"
        )
    for c in text:
        found.append(
            f"SELECT '{c}', 8, 'cat_value_maps_to_single_target', NULL, 'cat_value_maps_to_single_target' FROM "
            f"(SELECT max(n) AS m FROM (SELECT {c}, count(DISTINCT o_orderstatus) AS n FROM train GROUP BY 1)) "
            f"WHERE m = 1"
        )
    return f"""WITH source AS {source},
    train AS (SELECT * FROM ({stratified_split('source', 'o_orderkey', 'o_orderstatus')}) WHERE split = 'train'),
    found AS ({union(found)})
    SELECT col, rule, round(stat, 6) AS stat, reason FROM found
    QUALIFY row_number() OVER (PARTITION BY col ORDER BY place) = 1"""


def _routing(source: str, columns: list[str]) -> str:
    return union(
        f"""SELECT '{c}' AS col, n_unique, n_categories,
          CASE WHEN n_unique > 1000 OR n_unique > 0.05 * n THEN 'frequency' ELSE 'onehot' END AS route
        FROM (SELECT count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique,
                count(DISTINCT {c}) AS n_categories, count(*) AS n FROM {source})"""
        for c in columns
    )


def _onehot() -> str:
    rows = f"""SELECT o_orderkey, split, CASE WHEN o_custkey % 17 = 0 THEN NULL
        WHEN o_custkey % 13 = 0 AND split = 'test' THEN '9-NEW' ELSE o_orderpriority END AS priority
      FROM ({stratified_split('orders', 'o_orderkey', 'o_orderstatus')})"""
    cells = ", ".join(
        f"CAST(coalesce(max(CASE WHEN slot = {i} THEN 1 END), 0) AS INTEGER) AS c{i}" for i in range(6)
    )
    return f"""WITH seen AS ({rows}),
    slots AS (SELECT priority, row_number() OVER (ORDER BY priority NULLS LAST) - 1 AS slot
              FROM (SELECT DISTINCT priority FROM seen WHERE split = 'train'))
    SELECT o_orderkey, {cells} FROM seen LEFT JOIN slots ON seen.priority IS NOT DISTINCT FROM slots.priority
    GROUP BY o_orderkey"""


def _shares(group: str, name: str) -> str:
    shares = ", ".join(
        f"count(CASE WHEN o_orderstatus = '{s}' THEN 1 END) / CAST(count(*) AS DOUBLE) AS {name}_{s}"
        for s in STATUSES
    )
    return f"{name} AS (SELECT {group} AS g_{name}, {shares} FROM orders GROUP BY 1)"


SCORED = f"""WITH {_shares('o_orderpriority', 'a')}, {_shares('o_custkey % 7', 'b')}, {_shares('o_custkey % 11', 'c')},
    scored AS (SELECT * FROM orders JOIN a ON o_orderpriority = g_a JOIN b ON o_custkey % 7 = g_b JOIN c ON o_custkey % 11 = g_c)"""


def _argmax(name: str) -> str:
    f, o, p = (f"{name}_{s}" for s in STATUSES)
    return f"CASE WHEN {f} >= {o} AND {f} >= {p} THEN 'F' WHEN {o} >= {p} THEN 'O' ELSE 'P' END"


def _vote(weights: list[float], decide: bool) -> str:
    cells = []
    for s in STATUSES:
        total = " + ".join(f"{n}_{s} * {w}" for n, w in zip("abc", weights))
        cells.append(f"({total}) / CAST({sum(weights)} AS DOUBLE) AS v_{s}")
    shown = ", ".join(f"round(v_{s}, 6) AS v_{s}" for s in STATUSES)
    decision = f", {_argmax('v')} AS decision" if decide else ""
    return f"""{SCORED}, voted AS (SELECT o_orderkey, {', '.join(cells)} FROM scored)
    SELECT o_orderkey, {shown}{decision} FROM voted"""


PREDICTED = """WITH priced AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice / 1000 AS o_totalprice
      FROM orders),
    m1 AS (SELECT o_orderpriority AS g1, avg(o_totalprice) AS m1 FROM priced GROUP BY 1),
    m2 AS (SELECT o_custkey % 7 AS g2, avg(o_totalprice) AS m2 FROM priced GROUP BY 1),
    m3 AS (SELECT o_custkey % 11 AS g3, avg(o_totalprice) AS m3 FROM priced GROUP BY 1),
    predicted AS (SELECT priced.*, m1, m2, m3 FROM priced JOIN m1 ON o_orderpriority = g1
                  JOIN m2 ON o_custkey % 7 = g2 JOIN m3 ON o_custkey % 11 = g3)"""
RUNS = """(SELECT CAST(l_linenumber AS VARCHAR) AS model, round(sum(l_tax), 2) AS train_time,
      CAST(sum(l_orderkey) AS BIGINT) AS model_size FROM lineitem GROUP BY 1)"""


def _classification_scores() -> str:
    parts = []
    for m in ("a", "b", "c"):
        parts.append(f"SELECT '{m}' AS model, o_orderstatus AS y, {_argmax(m)} AS p FROM scored")
    return f"""{SCORED}, decided AS ({union(parts)}),
    per_class AS (
      SELECT model, s.c, sum(CASE WHEN y = s.c THEN 1 ELSE 0 END) AS support,
        sum(CASE WHEN p = s.c THEN 1 ELSE 0 END) AS predicted,
        CAST(sum(CASE WHEN y = s.c AND p = s.c THEN 1 ELSE 0 END) AS DOUBLE) AS hits
      FROM decided, (VALUES ('F'), ('O'), ('P')) s(c) GROUP BY model, s.c)
    SELECT model, round(sum(hits) / sum(support), 6) AS accuracy,
      round(sum(support * CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END) / sum(support), 6) AS precision,
      round(sum(support * CASE WHEN support > 0 THEN hits / support ELSE 0 END) / sum(support), 6) AS recall,
      round(sum(support * CASE WHEN support + predicted > 0 THEN 2 * hits / (support + predicted) ELSE 0 END)
        / sum(support), 6) AS f1,
      CAST(NULL AS DOUBLE) AS roc_auc
    FROM per_class GROUP BY model"""


def _auc() -> str:
    parts = []
    scores = {"continuous": "o_totalprice", "tied": "CAST(o_custkey % 10 AS DOUBLE)", "constant": "0.5"}
    for name, score in scores.items():
        parts.append(
            f"""SELECT '{name}' AS model, round((sum(CASE WHEN pos THEN r END) - np * (np + 1) / 2.0)
              / (CAST(np AS DOUBLE) * nn), 6) AS roc_auc
            FROM (SELECT pos, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r,
                    count(*) FILTER (WHERE pos) OVER () AS np, count(*) FILTER (WHERE NOT pos) OVER () AS nn
                  FROM (SELECT o_orderstatus = 'F' AS pos, {score} AS s FROM orders))
            GROUP BY np, nn"""
        )
    return union(parts)


def _regression_metric_parts(names: dict[str, str]) -> str:
    return union(
        f"""SELECT '{label}' AS model, avg((o_totalprice - {m}) ** 2) AS mse,
          sqrt(avg((o_totalprice - {m}) ** 2)) AS rmse, avg(abs(o_totalprice - {m})) AS mae,
          1 - avg((o_totalprice - {m}) ** 2) / var_pop(o_totalprice) AS r2 FROM predicted"""
        for label, m in names.items()
    )


def _size_text(size: str) -> str:
    cases = " ".join(
        f"WHEN {size} < 1024.0 ** {power + 1} THEN printf('%.2f {unit}', {size} / CAST(1024.0 ** {power} AS DOUBLE))"
        for power, unit in enumerate(("KB", "MB", "GB", "TB"), 1)
    )
    return (
        f"CASE WHEN {size} IS NULL OR {size} = 0 THEN '-' WHEN {size} < 1024 THEN CAST({size} AS VARCHAR) || ' B' "
        f"{cases} ELSE printf('%.2f PB', {size} / CAST(1024.0 ** 5 AS DOUBLE)) END"
    )


def _board() -> str:
    return f"""{PREDICTED}, metrics AS ({_regression_metric_parts({'1': 'm1', '2': 'm2', '3': 'm3'})}),
    board AS (SELECT runs.model, mse, rmse, mae, r2, train_time, model_size
              FROM {RUNS} runs LEFT JOIN metrics ON runs.model = metrics.model)"""


def _display() -> str:
    cells = ", ".join(
        f"CASE WHEN {m} IS NULL THEN '-' ELSE printf('%.4f', {m}) END AS {m}" for m in ("mse", "rmse", "mae", "r2")
    )
    return f"""{_board()} SELECT model AS model_name, {cells}, printf('%.3f', train_time) AS train_seconds,
      {_size_text('model_size')} AS size FROM board"""


WIDE = f"""{PREDICTED} SELECT o_orderkey, round(o_totalprice, 6) AS "Actual", round(m1, 6) AS "By priority",
    round((m1 + m2) / 2.0, 6) AS "By customer + priority" FROM predicted"""


def _content_split() -> str:
    columns = ["l_quantity", "l_discount", "l_returnflag", "l_linestatus"]
    text = " || '|' || ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in columns
    )
    names = ", ".join(columns)
    return f"""WITH keyed AS (
      SELECT {names}, md5(concat_ws('#', {text}, CAST(row_number() OVER (PARTITION BY {names}) - 1 AS VARCHAR)))
        AS row_key FROM lineitem)
    {plain_split('keyed', 'row_key')}"""


def _frequency_hot() -> str:
    rows = "CASE WHEN o_custkey % 3 = 0 THEN 'hot' ELSE CAST(o_custkey AS VARCHAR) END AS word"
    return f"""WITH seen AS (SELECT o_orderkey, split, {rows}
        FROM ({stratified_split('orders', 'o_orderkey', 'o_orderstatus')})),
    counts AS (SELECT word, count(*) AS n FROM seen WHERE split = 'train' GROUP BY 1)
    SELECT o_orderkey, CAST(coalesce(n, 0) AS DOUBLE) AS frequency FROM seen LEFT JOIN counts USING (word)"""


def _scaled() -> str:
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS d_{c}" for c in names)
    cells = ", ".join(f"round(({c} - a_{c}) / d_{c}, 6) + 0.0 AS {c}" for c in names)
    return f"SELECT l_orderkey, l_linenumber, {cells} FROM lineitem, (SELECT {stats} FROM lineitem)"


def _assembled() -> str:
    source = """(SELECT o_orderkey, o_orderstatus, o_custkey,
        CASE WHEN o_totalprice < 200000 THEN 'cheap' ELSE 'dear' END AS price FROM orders)"""
    return f"""WITH seen AS ({stratified_split(source, 'o_orderkey', 'o_orderstatus')}),
    fit AS (SELECT avg(o_custkey) AS m, stddev_pop(o_custkey) AS d FROM seen WHERE split = 'train')
    SELECT o_orderkey, split, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label,
      round((o_custkey - m) / d, 6) + 0.0 AS f0,
      CAST(CASE WHEN price = 'cheap' THEN 1 ELSE 0 END AS DOUBLE) AS f1,
      CAST(CASE WHEN price = 'dear' THEN 1 ELSE 0 END AS DOUBLE) AS f2
    FROM seen, fit"""


def _ols_test_rows() -> str:
    source = "(SELECT o_orderkey, o_totalprice / 1000 AS price, o_custkey % 100 AS customer FROM orders)"
    return f"""WITH seen AS ({plain_split(source, 'o_orderkey')}),
    fit AS (SELECT regr_slope(price, customer) AS slope, regr_intercept(price, customer) AS start
            FROM seen WHERE split = 'train'),
    tested AS (SELECT CAST(o_orderkey AS VARCHAR) AS row_key, price, start + slope * customer AS prediction
               FROM seen, fit WHERE split = 'test')"""


def _planted_classes() -> str:
    """Seven selections that all find the rule."""
    graded = "(SELECT p_partkey, CASE WHEN p_size % 10 < 5 THEN 'low' ELSE 'high' END AS grade FROM part)"
    found = ", ".join(f"grade AS m{i}" for i in range(7))
    rows = stratified_split(graded, "p_partkey", "grade")
    return f"SELECT CAST(p_partkey AS VARCHAR) AS row_key, grade AS actual, {found} FROM ({rows}) WHERE split = 'test'"


def _planted_values() -> str:
    """Three selections that all find the sum."""
    valued = """(SELECT p_partkey, CAST(10 + 3 * (p_size % 2) + CASE WHEN p_size % 3 = 0 THEN 5 ELSE 0 END AS DOUBLE)
        AS worth FROM part)"""
    found = ", ".join(f"worth AS m{i}" for i in range(3))
    rows = plain_split(valued, "p_partkey")
    return f"SELECT CAST(p_partkey AS VARCHAR) AS row_key, worth AS actual, {found} FROM ({rows}) WHERE split = 'test'"


def oracle_sql() -> dict[str, str]:
    gaps, moments, minima = _gaps(), _moments(), _minimum_gaps()
    part_split = plain_split("part", "p_partkey")
    return {
        "csv_scan": """SELECT p_partkey, p_name, p_brand, p_type,
            CAST(CASE WHEN p_size % 10 <> 0 THEN p_size END AS DOUBLE) AS p_size, p_retailprice FROM part""",
        "catalog_scan": "SELECT * FROM supplier",
        "preview_rows": "SELECT * FROM customer ORDER BY c_custkey LIMIT 50",
        "target_column": "SELECT o_orderstatus FROM orders",
        "feature_columns": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
        "column_kinds": _column_kinds(),
        "drop_columns": "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier",
        "task_inference": _task_inference(),
        "numeric_coercion": """SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END
            AS number FROM orders""",
        "split_regression": f"SELECT p_partkey, split FROM ({part_split})",
        "split_stratified": f"""SELECT o_orderkey, o_orderstatus, split
            FROM ({stratified_split('orders', 'o_orderkey', 'o_orderstatus')})""",
        "split_many_classes": f"""WITH source AS (SELECT o_orderkey, o_custkey % 97 AS bucket FROM orders)
            SELECT o_orderkey, bucket, split FROM ({stratified_split('source', 'o_orderkey', 'bucket')})""",
        "split_content_key": _content_split(),
        "leak_id_like": _id_like(),
        "leak_presence_diff": f"""SELECT col, 'presence_diff' AS rule, round(presence_gap, 6) AS stat,
            printf('presence_diff (nonnull_frac_diff=%.3f)', presence_gap) AS reason
            FROM ({gaps}) WHERE presence_gap > 0.9""",
        "leak_constant": f"SELECT col, 'constant_overall' AS rule FROM ({moments}) WHERE n_unique <= 1",
        "leak_high_corr": f"""SELECT col, 'high_corr' AS rule, round(abs(corr), 6) AS stat,
            printf('high_corr (corr=%.3f)', abs(corr)) AS reason FROM ({moments}) WHERE abs(corr) >= 0.95""",
        "target_correlation": f"""SELECT col, n_values, round(low, 6) AS low, round(high, 6) AS high,
            round(corr, 6) AS corr FROM ({moments})""",
        "leak_constant_within_class": _constant_within_class(),
        "leak_zero_fraction": f"""SELECT col, 'zero_fraction_diff' AS rule, round(zero_gap, 6) AS stat,
            printf('zero_fraction_diff (zero_frac_diff=%.3f)', zero_gap) AS reason
            FROM ({gaps}) WHERE zero_gap >= 0.9""",
        "class_spread": f"""SELECT col, round(presence_gap, 6) AS presence_gap, round(zero_gap, 6) AS zero_gap,
            mixed_constancy FROM ({gaps})""",
        "leak_min_value": f"""SELECT col, 'min_value_presence_diff' AS rule, round(gap, 6) AS stat,
            printf('min_value_presence_diff (min_fraction_diff=%.3f)', gap) AS reason
            FROM ({minima}) WHERE gap >= 0.9""",
        "leak_cat_single_target": union(
            f"""SELECT '{c}' AS col, count(*) AS n_categories, count(CASE WHEN n > 1 THEN 1 END) AS n_mixed
            FROM (SELECT {c}, count(DISTINCT l_returnflag) AS n FROM {LEAKY} WHERE {c} IS NOT NULL GROUP BY 1)"""
            for c in ("l_linestatus", "flag_and_status")
        ),
        "leak_report": _leak_report(),
        "cardinality_routing": _routing("labels JOIN documents USING (doc_id)", ["lang", "source", "text"]),
        "frequency_encode_brand": f"""WITH seen AS ({part_split}),
            counts AS (SELECT p_brand, count(*) AS n FROM seen WHERE split = 'train' GROUP BY 1)
            SELECT p_partkey, CAST(coalesce(n, 0) AS DOUBLE) AS frequency FROM seen LEFT JOIN counts USING (p_brand)""",
        "frequency_encode_hot": _frequency_hot(),
        "standard_scale": _scaled(),
        "onehot_priority": _onehot(),
        "svd_width_rule": f"""SELECT total_unique, n_components,
            CASE WHEN total_unique <= n_components THEN 'onehot' ELSE 'svd' END AS mode
            FROM (SELECT total_unique, least(200, greatest(2, total_unique - 1)) AS n_components
                  FROM (SELECT CAST(coalesce(sum(n_categories), 0) AS BIGINT) AS total_unique
                        FROM ({_routing('part', ['p_name', 'p_brand', 'p_type'])}) WHERE route = 'onehot'))""",
        "svd_gram": """WITH cells AS (
              SELECT p_partkey, 1 AS block, p_brand AS v, 'p_brand=' || p_brand AS name FROM part
              UNION ALL SELECT p_partkey, 2, p_type, 'p_type=' || p_type FROM part)
            SELECT x.name AS first, y.name AS second, count(*) AS n FROM cells x JOIN cells y
            ON x.p_partkey = y.p_partkey AND (x.block < y.block OR (x.block = y.block AND x.v <= y.v))
            GROUP BY 1, 2""",
        "svd_components": """SELECT p_partkey, CAST(2 AS DOUBLE) AS square_length,
            CAST((SELECT 2 * count(*) FROM part) AS DOUBLE) AS square_sum FROM part""",
        "planted_classes": _planted_classes(),
        "planted_values": _planted_values(),
        "score_new_rows": """SELECT CAST(p_partkey AS VARCHAR) AS row_key,
            CAST(10 + 3 * (p_size % 2) + CASE WHEN p_size % 3 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS prediction FROM part""",
        "reload_predictions": """SELECT CAST(p_partkey AS VARCHAR) AS row_key, worth AS worth_0, worth AS worth_1,
            true AS same_worth, grade AS grade_0, grade AS grade_1, true AS same_grade
            FROM (SELECT p_partkey, CAST(10 + 3 * (p_size % 2) + CASE WHEN p_size % 3 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS worth,
                    CASE WHEN p_size % 10 < 5 THEN 'low' ELSE 'high' END AS grade FROM part)""",
        "csv_multiline": """SELECT p_partkey, p_name || chr(10) || '"' || p_brand || '", ' || p_type AS words FROM part""",
        "model_save_size": "SELECT 'linear_regression' AS model, true AS size_is_listed",
        "label_encode_numbers": """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_nationkey) - 1 AS INTEGER)
            AS label, c_nationkey AS decoded FROM customer""",
        "sequence_view": """SELECT vec_id, CAST(step - 1 AS INTEGER) AS step,
            round(CAST(embedding[step] AS DOUBLE), 6) + 0.0 AS value
            FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS step FROM embeddings)""",
        "assembled_features": _assembled(),
        "ols_predictions": f"""{_ols_test_rows()} SELECT row_key, round(price, 5) AS actual,
            round(prediction, 5) AS prediction FROM tested""",
        "ols_experiment": f"""{_ols_test_rows()} SELECT 'Linear Regression' AS model,
            round(avg((price - prediction) ** 2), 4) AS mse, round(sqrt(avg((price - prediction) ** 2)), 4) AS rmse,
            round(avg(abs(price - prediction)), 4) AS mae,
            round(1 - avg((price - prediction) ** 2) / var_pop(price), 4) AS r2 FROM tested""",
        "hard_decision": f"""{SCORED} SELECT o_orderkey,
            CASE {_argmax('b')} WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS best,
            CASE WHEN b_O >= CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS from_threshold FROM scored""",
        "onehot_scores": f"""{SCORED} SELECT o_orderkey, s.c AS class,
            CAST(CASE WHEN {_argmax('b')} = s.c THEN 1 ELSE 0 END AS DOUBLE) AS proba
            FROM scored, (VALUES ('F'), ('O'), ('P')) s(c)""",
        "align_model_scores": f"""{SCORED} SELECT o_orderkey, round(b_F, 6) AS mapped_F,
            CAST(0 AS DOUBLE) AS mapped_O, round(b_P, 6) AS mapped_P, round(1 - b_O, 6) AS rest,
            round(b_O, 6) AS only, round((b_F + b_O) / 2, 6) AS spread_F, round((b_F + b_O) / 2, 6) AS spread_O,
            round((b_F + b_O) / 2, 6) AS spread_P FROM scored""",
        "soft_vote_mean": _vote([1, 1, 1], True),
        "soft_vote_weighted": _vote([3, 2, 1], False),
        "mean_regression": f"{PREDICTED} SELECT o_orderkey, round((m1 + m2 + m3) / 3.0, 4) AS prediction FROM predicted",
        "mean_regression_weighted": f"""{PREDICTED} SELECT o_orderkey, round((3 * m1 + m2) / 4.0, 4) AS prediction
            FROM predicted""",
        "ensemble_costs": f"""SELECT ensemble, round(sum(train_time), 4) AS train_time,
            CAST(sum(model_size) AS BIGINT) AS model_size, CAST(0 AS DOUBLE) AS combine_time
            FROM (SELECT DISTINCT CAST(l_suppkey % 5 AS VARCHAR) AS ensemble, CAST(l_linenumber AS VARCHAR) AS model
                  FROM lineitem WHERE l_suppkey % 5 <= l_linenumber) JOIN {RUNS} USING (model) GROUP BY 1""",
        "classification_scores": _classification_scores(),
        "ranking_auc": _auc(),
        "regression_scores": f"""{PREDICTED} SELECT model, round(mse, 4) AS mse, round(rmse, 4) AS rmse,
            round(mae, 4) AS mae, round(r2, 4) AS r2
            FROM ({_regression_metric_parts({'m1': 'm1', 'm2': 'm2', 'm3': 'm3'})})""",
        "leaderboard_display": _display(),
        "run_totals": f"""{_board()} SELECT round(sum(train_time), 4) AS train_time,
            CAST(sum(model_size) AS BIGINT) AS model_size,
            {_size_text('CAST(sum(model_size) AS BIGINT)')} AS size FROM board""",
        "prediction_wide": WIDE,
        "prediction_export": WIDE,
        "ols_one_feature": """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
            round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
            round(regr_r2(l_extendedprice, l_quantity), 4) AS r2 FROM lineitem""",
        "ensemble_description": f"""{PREDICTED} SELECT 'both' AS ensemble_name, 'mean_average' AS method,
            'm1,m2' AS components, round(avg(abs(o_totalprice - (m1 + m2) / 2.0)), 4) AS mae FROM predicted""",
    }
