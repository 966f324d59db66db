"""The same queries as SQL over the test tables.

Written independently of the Spark plans: windows where the library aggregates and
joins, sorted quantiles where it narrows, plain counts where it observes.
"""

from __future__ import annotations

from ..schema import CLEAN_COLUMNS, OTHER, RAW_COLUMNS, SENTINELS, UNINFORMATIVE, UNKNOWN
from .queries import MEASURES, VIEW_CLEANING
from .view import AS_OF, TERMS, view_sql

_TEXT = [c for c in CLEAN_COLUMNS if c not in {
    "D_REG", "MAKE_YEAR", "CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT", "AGE", "REG_YEAR", "REG_MONTH",
}]


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _on_view(body: str) -> str:
    return f"WITH {view_sql()}\n{body}"


def _questions() -> dict[str, str]:
    t = TERMS
    both = " AND ".join(f"FUEL LIKE '%{word}%'" for word in t.hybrid_words)
    bodies = {
        1: 'SELECT REGION_NAME, count(*) AS "count" FROM clean JOIN region USING (REG_ADDR_KOATUU) GROUP BY 1',
        2: f"""SELECT BRAND, count(*) AS "count" FROM clean JOIN region USING (REG_ADDR_KOATUU)
            WHERE REGION_NAME = '{t.capital}' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        3: f"""SELECT BRAND, MODEL, OPER_DESC, MAKE_YEAR FROM clean JOIN operation USING (OPER_CODE)
            WHERE FUEL = '{t.electric}'""",
        4: f"""SELECT OPER_DESC, round(avg(AGE), 1) AS avg_age FROM clean JOIN operation USING (OPER_CODE)
            WHERE KIND = '{t.passenger}' GROUP BY 1""",
        5: f"""SELECT REGION_NAME, round(sum(TOTAL_WEIGHT), 2) AS sum_weight
            FROM clean JOIN region USING (REG_ADDR_KOATUU) WHERE KIND = '{t.truck}' GROUP BY 1""",
        6: f"""SELECT OPER_DESC, count(*) AS "count" FROM clean JOIN operation USING (OPER_CODE)
            WHERE BRAND = '{t.brand}' GROUP BY 1""",
        7: f"""SELECT REGION_NAME, round(avg(CAPACITY), 0) AS avg_cap
            FROM clean JOIN region USING (REG_ADDR_KOATUU) WHERE FUEL = '{t.diesel}' GROUP BY 1""",
        8: f"""SELECT OPER_DESC, count(*) AS "count" FROM clean JOIN operation USING (OPER_CODE)
            WHERE AGE <= {t.new_age} GROUP BY 1""",
        9: """SELECT BODY, BRAND, n AS "count", "rank" FROM (
              SELECT *, cast(rank() OVER (PARTITION BY BODY ORDER BY n DESC) AS integer) AS "rank"
              FROM (SELECT BODY, BRAND, count(*) AS n FROM clean GROUP BY 1, 2)) WHERE "rank" = 1""",
        10: """SELECT BRAND, MODEL, TOTAL_WEIGHT FROM (SELECT *, row_number() OVER (
              PARTITION BY BRAND ORDER BY TOTAL_WEIGHT DESC NULLS LAST, MODEL) AS rn FROM clean) WHERE rn = 1""",
        11: """SELECT * FROM (SELECT *, avg(CAPACITY) OVER (PARTITION BY BRAND) AS avg_brand
              FROM clean WHERE CAPACITY > 0) WHERE CAPACITY > avg_brand""",
        12: f"""SELECT COLOR, MAKE_YEAR, n AS "count", cast(sum(n) OVER (
              PARTITION BY COLOR ORDER BY MAKE_YEAR NULLS FIRST) AS bigint) AS running_total
            FROM (SELECT COLOR, MAKE_YEAR, count(*) AS n FROM clean
              WHERE COLOR IN ({_quoted(t.tracked_colours)}) GROUP BY 1, 2)""",
        13: f"""SELECT COLOR, count(*) AS "count" FROM clean WHERE KIND = '{t.motorcycle}'
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
        14: """SELECT BRAND, MODEL, AGE, AGE - min(AGE) OVER (PARTITION BY BRAND, MODEL) AS age_diff
            FROM clean""",
        15: """SELECT BRAND, FUEL, n AS "count", cast(total AS bigint) AS total,
              round(n / total * 100, 2) AS percentage
            FROM (SELECT *, sum(n) OVER (PARTITION BY BRAND) AS total
              FROM (SELECT BRAND, FUEL, count(*) AS n FROM clean GROUP BY 1, 2))""",
        16: """SELECT BRAND, MODEL, D_REG FROM (SELECT *, row_number() OVER (
              PARTITION BY BRAND ORDER BY D_REG NULLS FIRST, MODEL) AS rn FROM clean) WHERE rn = 1""",
        17: f"""SELECT BRAND, count(*) AS "count" FROM clean WHERE REG_MONTH = {t.month} GROUP BY 1""",
        18: f"""SELECT BODY, round(avg(TOTAL_WEIGHT - OWN_WEIGHT), 1) AS avg_load FROM clean
            WHERE PURPOSE = '{t.special}' GROUP BY 1""",
        19: f"""SELECT * FROM clean WHERE COLOR = '{t.red}' AND MAKE_YEAR > {t.after_year}
            AND KIND = '{t.passenger}'""",
        20: f"""SELECT BRAND, count(DISTINCT MODEL) AS hybrid_models FROM clean WHERE {both} GROUP BY 1""",
        21: """SELECT BRAND, MODEL, MAKE_YEAR, AGE FROM clean
            ORDER BY AGE DESC NULLS LAST, BRAND, MODEL, MAKE_YEAR LIMIT 10""",
        22: f"""SELECT BRAND, count(*) AS "count" FROM clean WHERE COLOR = '{t.unknown}' GROUP BY 1""",
        23: f"""SELECT BRAND, round(avg(CAPACITY), 0) AS avg_cap FROM clean
            WHERE BRAND IN ({_quoted(t.compared_brands)}) GROUP BY 1""",
        24: f"""SELECT KIND, BRAND, MODEL, TOTAL_WEIGHT FROM clean WHERE TOTAL_WEIGHT < {t.light_weight}""",
    }
    return {f"q{n:02d}": _on_view(body) for n, body in bodies.items()}


def _iqr(source: str, target: str, column: str, k: float, where: str = "") -> str:
    """CTEs that keep the rows of ``source`` inside the limits of ``column``."""
    return f"""{target}_q AS (
  SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source}
), {target} AS (
  SELECT {source}.* FROM {source}, {target}_q
  WHERE {column} IS NULL OR q1 IS NULL OR NOT q3 - q1 > 0
     OR {column} BETWEEN greatest(0.0, q1 - {k} * (q3 - q1)) AND q3 + {k} * (q3 - q1)
)"""


def _cleaning_sql(identity: bool = False) -> str:
    """CTEs from ``raw`` to ``filled``, the rows before duplicates are removed; with
    ``identity`` they are already removed, by all columns."""
    c = VIEW_CLEANING
    sentinels = _quoted(c.sentinels)
    columns = RAW_COLUMNS
    distinct = "DISTINCT" if identity else ""
    std = ", ".join(
        f"CASE WHEN upper(trim({x}, ' ')) NOT IN ({sentinels}) THEN upper(trim({x}, ' ')) END AS {x}"
        if x in _TEXT else x for x in columns
    )
    kept = ", ".join(x for x in CLEAN_COLUMNS if x not in {"MODEL", "CAPACITY", *_TEXT})
    text = ", ".join(f"coalesce({x}, '{UNKNOWN}') AS {x}" for x in _TEXT if x != "MODEL")
    return f"""{view_sql()}, twice AS (
  SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE FUEL = '{TERMS.diesel}'
), std AS (
  SELECT *, {c.as_of} - MAKE_YEAR AS AGE, cast(year(D_REG) AS integer) AS REG_YEAR,
    cast(month(D_REG) AS integer) AS REG_MONTH FROM (SELECT {distinct} {std} FROM twice)
), in_range AS (
  SELECT * FROM std WHERE MAKE_YEAR IS NULL OR MAKE_YEAR BETWEEN {c.year_range[0]} AND {c.year_range[1]}
), domain AS (
  SELECT * FROM in_range WHERE OWN_WEIGHT IS NULL OR TOTAL_WEIGHT IS NULL OR TOTAL_WEIGHT >= OWN_WEIGHT
), {_iqr("domain", "s1", "CAPACITY", c.iqr_k)}, {_iqr("s1", "s2", "OWN_WEIGHT", c.iqr_k)},
{_iqr("s2", "s3", "TOTAL_WEIGHT", c.iqr_k)}, rare AS (
  SELECT MODEL FROM s3 WHERE MODEL IS NOT NULL GROUP BY MODEL HAVING count(*) < {c.label_min_count}
), filled AS (
  SELECT {kept}, coalesce(CAPACITY, 0.0) AS CAPACITY, {text},
    CASE WHEN MODEL IN (SELECT MODEL FROM rare) THEN '{OTHER}' ELSE coalesce(MODEL, '{UNKNOWN}') END AS MODEL
  FROM s3 WHERE OWN_WEIGHT IS NOT NULL AND TOTAL_WEIGHT IS NOT NULL
)"""


def _audit_sql() -> str:
    c = VIEW_CLEANING
    low, high = c.year_range

    def removed(step, before, after, column):
        return f"""SELECT {step}, 'outlier', '{column}', greatest(0.0, q1 - {c.iqr_k} * (q3 - q1)),
  q3 + {c.iqr_k} * (q3 - q1), (SELECT count(*) FROM {before}) - (SELECT count(*) FROM {after}) FROM {after}_q"""

    return f"""WITH {_cleaning_sql()}
SELECT 1 AS step, 'range' AS rule, 'MAKE_YEAR' AS "column", {low}.0::double AS lower, {high}.0::double AS upper,
  (SELECT count(*) FROM std) - (SELECT count(*) FROM in_range) AS rows_flagged
UNION ALL SELECT 2, 'order', 'TOTAL_WEIGHT', NULL, NULL,
  (SELECT count(*) FROM in_range) - (SELECT count(*) FROM domain)
UNION ALL {removed(3, "domain", "s1", "CAPACITY")}
UNION ALL {removed(4, "s1", "s2", "OWN_WEIGHT")}
UNION ALL {removed(5, "s2", "s3", "TOTAL_WEIGHT")}
UNION ALL SELECT 6, 'duplicate', NULL, NULL, NULL,
  (SELECT count(*) FROM filled) - (SELECT count(*) FROM (SELECT DISTINCT * FROM filled))"""


def _run_audit_sql() -> str:
    c = VIEW_CLEANING
    low, high = c.year_range

    def step(number, rule, column, lower, upper, before, after, source=None):
        return f"""SELECT {number} AS step, '{rule}' AS rule, {column} AS "column", {lower} AS lower, {upper} AS upper,
  (SELECT count(*) FROM {before}) - (SELECT count(*) FROM {after}) AS rows_flagged,
  (SELECT count(*) FROM {after}) AS rows_left{f" FROM {source}" if source else ""}"""

    def outlier(number, column, before, after):
        q = f"greatest(0.0, q1 - {c.iqr_k} * (q3 - q1))"
        return step(number, "outlier", f"'{column}'", q, f"q3 + {c.iqr_k} * (q3 - q1)", before, after, f"{after}_q")

    none = "cast(NULL AS double)"
    body = _union((
        step(0, "input", "NULL", none, none, "std", "std"),
        step(1, "range", "'MAKE_YEAR'", f"{low}.0", f"{high}.0", "std", "in_range"),
        step(2, "order", "'TOTAL_WEIGHT'", none, none, "in_range", "domain"),
        outlier(3, "CAPACITY", "domain", "s1"),
        outlier(4, "OWN_WEIGHT", "s1", "s2"),
        outlier(5, "TOTAL_WEIGHT", "s2", "s3"),
        f"""SELECT 6, 'fold', 'MODEL', NULL, NULL, (SELECT count(*) FROM s3 JOIN rare USING (MODEL)),
  (SELECT count(*) FROM s3)""",
        step(7, "required", "'OWN_WEIGHT,TOTAL_WEIGHT'", none, none, "s3", "filled"),
        step(8, "duplicate", "NULL", none, none, "filled", "(SELECT DISTINCT * FROM filled)"),
    ))
    return f"""WITH {_cleaning_sql()} SELECT *, (SELECT count(*) FROM (SELECT DISTINCT * FROM filled)) AS rows_written
FROM ({body})"""


RUN_NUMBERS = ("MAKE_YEAR", "CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT", "AGE", "REG_YEAR", "REG_MONTH")


def _run_categories_sql() -> str:
    """Text columns of the raw rows: values and counts of those with up to 20 values, and for
    the others that five values are shown."""
    texts = [c for c in RAW_COLUMNS if c not in {"D_REG", "MAKE_YEAR", "CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT"}]
    counted = _union(f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM twice GROUP BY {c}""" for c in texts)
    return f"""WITH {_cleaning_sql()}, counted AS ({counted}), sized AS (
  SELECT *, count(*) OVER (PARTITION BY "column") AS size FROM counted
)
SELECT "column", true AS listed, size AS n_distinct, value, n AS "count" FROM sized WHERE size <= 20
UNION ALL SELECT DISTINCT "column", false, NULL, NULL, 5 FROM sized WHERE size > 20"""


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _numeric_sql(table: str = "lineitem", columns=MEASURES) -> str:
    quartile = "quantile_disc({c}, {p})"
    metrics = {
        "count": "cast(count({c}) AS double)", "mean": "avg({c})", "stddev": "stddev_samp({c})",
        "min": "min({c})", "25%": quartile.replace("{p}", "0.25"), "50%": quartile.replace("{p}", "0.5"),
        "75%": quartile.replace("{p}", "0.75"), "max": "max({c})",
    }
    return _union(
        f"""SELECT '{c}' AS "column", '{m}' AS metric, round({e.format(c=c)}, 6) AS value FROM {table}"""
        for c in columns for m, e in metrics.items()
    )


def _numeric_approx_sql(table: str = "lineitem", columns=MEASURES) -> str:
    return f"""SELECT "column", metric, CASE WHEN metric NOT LIKE '%\\%' ESCAPE '\\' THEN value END AS value,
  CASE WHEN metric LIKE '%\\%' ESCAPE '\\' THEN true END AS within FROM ({_numeric_sql(table, columns)})"""


def _categories_sql(table: str, columns) -> str:
    """What a category profile with 20 values and samples of 5 has to show per column."""
    return _union(
        f"""SELECT '{c}' AS "column", n <= 20 AS listed, exact, CASE WHEN n <= 20 THEN n ELSE 5 END AS n_values,
  CASE WHEN n <= 20 THEN n ELSE 5 END AS n_present, true AS within
FROM (SELECT count(DISTINCT {c}) AS exact, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n
  FROM {table})"""
        for c in columns
    )


def _binned(column: str, bins: int, table: str = "lineitem") -> str:
    """Subquery (bin, v) with the bin corrected against its edges."""
    return f"""SELECT CASE WHEN v < low + guess * width THEN guess - 1
      WHEN v >= low + (guess + 1) * width AND guess < {bins - 1} THEN guess + 1 ELSE guess END AS bin,
      v, low, high, width
    FROM (SELECT *, cast(least(floor((v - low) / width), {bins - 1}) AS integer) AS guess
      FROM (SELECT {column} AS v, low, high, (high - low) / {bins} AS width
        FROM {table}, (SELECT min({column}) AS low, max({column}) AS high FROM {table}) WHERE {column} IS NOT NULL))"""


def _histogram_sql(bins: int = 30, table: str = "lineitem", columns=MEASURES) -> str:
    return _union(
        f"""SELECT '{c}' AS "column", cast(i AS integer) AS bin, low + i * width AS lower,
  low + (i + 1) * width AS upper, coalesce(n, 0) AS "count"
FROM (SELECT i, low, (high - low) / {bins} AS width FROM range({bins}) AS g(i),
    (SELECT min({c}) AS low, max({c}) AS high FROM {table}))
LEFT JOIN (SELECT bin, count(*) AS n FROM ({_binned(c, bins, table)}) GROUP BY bin) ON bin = i"""
        for c in columns
    )


def _density_sql(grid: int = 200, bins: int = 512) -> str:
    return _union(
        f"""SELECT '{c}' AS "column", cast(i AS integer) AS point, low + i * step AS x,
  round(sum(n * exp(-0.5 * ((low + i * step - center) / h) ** 2)) / (total * h * sqrt(2 * pi())), 9) AS density
FROM (SELECT bin, count(*) AS n, avg(v) AS center FROM ({_binned(c, bins)}) GROUP BY bin), range({grid}) AS g(i),
  (SELECT min({c}) AS low, (max({c}) - min({c})) / {grid - 1} AS step, count({c}) AS total,
    stddev_samp({c}) * count({c}) ** -0.2 AS h FROM lineitem)
GROUP BY i, low, step, total, h"""
        for c in MEASURES
    )


def _correlation_sql(table: str = "clean") -> str:
    return _union(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 8) AS corr FROM {table}"
        for x in RUN_NUMBERS for y in RUN_NUMBERS
    )


def _missing_sql(extra=lambda position, column: "") -> str:
    return _on_view(_union(
        f"""SELECT '{c}' AS "column"{extra(i, c)}, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM raw"""
        for i, c in enumerate(RAW_COLUMNS, start=1)
    ))


def _columns_sql() -> str:
    types = {"D_REG": "date", "MAKE_YEAR": "int", "CAPACITY": "double", "OWN_WEIGHT": "double", "TOTAL_WEIGHT": "double"}
    return _missing_sql(
        lambda i, c: f""", cast({i} AS integer) AS position, '{types.get(c, "string")}' AS "type\""""
    )


def _operators() -> dict[str, str]:
    raw = f"{', '.join(c for c in RAW_COLUMNS if c not in UNINFORMATIVE)}"
    missing_sample = "SELECT {0} AS COLOR, KIND, {1} AS CAPACITY, DEP_CODE FROM raw"
    sentinels = _quoted((*SENTINELS, "HOT RING", "PROMO"))
    tidy = ", ".join(
        f"CASE WHEN upper(trim({c}, ' ')) NOT IN ({sentinels}) THEN upper(trim({c}, ' ')) END AS {c}"
        for c in ("p_name", "p_brand", "p_type")
    )
    return {
        "source_parquet": "SELECT * FROM orders",
        "source_registry_csv": _on_view("SELECT * FROM raw"),
        "source_inferred_csv": """SELECT cast(p_partkey AS integer) AS p_partkey, p_name, p_brand, p_type,
            p_size, p_retailprice FROM part""",
        "sink_csv_results": _union(
            f"""SELECT '{name}' AS name, 'written' AS status, cast({c} AS varchar) AS label, count(*) AS "count"
            FROM lineitem GROUP BY {c}"""
            for name, c in (("flags", "l_returnflag"), ("orders", "l_orderkey"))
        ),
        "parse_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN cast(o_orderdate AS date) END AS day
            FROM orders""",
        "parse_decimals": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_quantity <> 7 THEN l_extendedprice END AS price FROM lineitem""",
        "standardise_text": f"SELECT p_partkey, {tidy} FROM part",
        "keep_in_range": _on_view("""SELECT MAKE_YEAR, OPER_CODE, DEP_CODE, CAPACITY FROM raw
            WHERE MAKE_YEAR IS NULL OR MAKE_YEAR BETWEEN 1996 AND 2000"""),
        "keep_ordered": _on_view("""SELECT BRAND, MODEL, OWN_WEIGHT, TOTAL_WEIGHT FROM raw
            WHERE OWN_WEIGHT IS NULL OR TOTAL_WEIGHT IS NULL OR TOTAL_WEIGHT >= OWN_WEIGHT"""),
        "drop_uninformative": _on_view(f"SELECT {raw} FROM raw"),
        "fill_missing": _on_view(missing_sample.format(f"coalesce(COLOR, '{UNKNOWN}')", "coalesce(CAPACITY, 0.0)")),
        "require": _on_view(
            missing_sample.format("COLOR", "CAPACITY") + " WHERE COLOR IS NOT NULL AND CAPACITY IS NOT NULL"
        ),
        "dedup_documents": "SELECT DISTINCT text, lang, source FROM documents",
        "dedup_without_identity": _on_view("SELECT DISTINCT OPER_CODE, BRAND, MODEL, MAKE_YEAR, KIND FROM raw"),
        "add_features": _on_view(f"""SELECT DEP_CODE, MAKE_YEAR, D_REG, {AS_OF} - MAKE_YEAR AS AGE,
            cast(year(D_REG) AS integer) AS REG_YEAR, cast(month(D_REG) AS integer) AS REG_MONTH FROM raw"""),
        "iqr_filter_events": f"WITH {_iqr('events', 'kept', 'value', 3.0)} SELECT * FROM kept",
        "iqr_filter_documents": f"""WITH {_iqr('documents', 'kept', 'n_chars', 3.0)}
            SELECT doc_id, lang, n_chars FROM kept""",
        "iqr_filter_sequence": f"""WITH {_iqr('lineitem', 'first', 'l_extendedprice', 0.25)},
            {_iqr('first', 'kept', 'l_quantity', 0.25)} SELECT l_orderkey, {', '.join(MEASURES)} FROM kept""",
        "fold_rare": f"""SELECT o_orderkey, CASE WHEN count(*) OVER (PARTITION BY o_custkey) < 10 THEN '{OTHER}'
            ELSE cast(o_custkey AS varchar) END AS customer FROM orders""",
        "clean_registry": f"WITH {_cleaning_sql()} SELECT DISTINCT * FROM filled",
        "clean_registry_by_identity": f"WITH {_cleaning_sql(identity=True)} SELECT * FROM filled",
        "audit_registry": _audit_sql(),
        "profile_shape": "SELECT count(*) AS n_rows, cast(11 AS bigint) AS n_columns FROM lineitem",
        "profile_columns": _columns_sql(),
        "profile_categories": """WITH counted AS (
              SELECT *, count(*) OVER (PARTITION BY "column") AS n_distinct FROM (
                SELECT 'lang' AS "column", lang AS value, count(*) AS "count" FROM documents GROUP BY lang
                UNION ALL
                SELECT 'source', source, count(*) FROM documents GROUP BY source))
            SELECT "column", true AS listed, n_distinct, value, "count" FROM counted WHERE n_distinct <= 20""",
        "profile_categories_wide": _categories_sql("part", ("p_name", "p_brand", "p_type")),
        "profile_categories_documents": _categories_sql("documents", ("text", "lang", "source")),
        "profile_categories_registry": _on_view(_categories_sql("raw", [c for c in RAW_COLUMNS if c not in {
            "D_REG", "MAKE_YEAR", "CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT"}])),
        "profile_numeric": _numeric_sql(),
        "profile_numeric_approx": _numeric_approx_sql(),
        "profile_missing": _missing_sql(),
        "histogram": _histogram_sql(),
        "density": _density_sql(),
        "correlation": _on_view(_correlation_sql()),
        "running_total_rows": """SELECT l_returnflag, line, n AS "count", cast(sum(n) OVER (
              PARTITION BY l_returnflag ORDER BY line) AS bigint) AS running_total
            FROM (SELECT l_returnflag, l_orderkey * 8 + l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
        "top_groups_sketched": 'SELECT l_suppkey, count(*) AS "count" FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7',
        "top_groups_unproven": 'SELECT l_orderkey, count(*) AS "count" FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7',
        "dedup_wide_documents": "SELECT DISTINCT text, lang, source FROM documents",
        "iqr_limits_approx": """SELECT (SELECT count(value) FROM events) + (SELECT count(n_chars) FROM documents) AS n,
            true AS first, true AS third, true AS "limit" """,
        "profile_table_numeric": _numeric_approx_sql(),
        "plan_report_q02": f"SELECT *, true AS sections, true AS scans_nation, true AS pushed FROM ({_questions()['q02']})",
        "sink_manifest": """SELECT 'flags' AS name, 'written' AS status, 0 AS "rows", 0 AS there
            UNION ALL SELECT 'items', 'failed', NULL, (SELECT count(*) FROM lineitem)""",
        "run_raw_categories": _run_categories_sql(),
        "run_standardised_summary": f"WITH {_cleaning_sql()} {_numeric_approx_sql('std', RUN_NUMBERS)}",
        "run_kept_correlation": f"WITH {_cleaning_sql()} {_correlation_sql('s3')}",
        "run_kept_histogram": f"WITH {_cleaning_sql()} {_histogram_sql(30, 's3', RUN_NUMBERS)}",
        "run_kept_missing": f"WITH {_cleaning_sql()} " + _union(
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM s3"""
            for c in CLEAN_COLUMNS
        ),
        "run_audit": _run_audit_sql(),
        "sink_error_report": """SELECT name, status, CASE name WHEN 'flags' THEN n END AS "rows"
            FROM (VALUES ('flags', 'written'), ('state', 'failed'), ('key', 'failed')) AS r(name, status),
                 (SELECT count(*) AS n FROM lineitem)""",
        "count_by": 'SELECT event_type, user_id, count(*) AS "count" FROM events GROUP BY 1, 2',
        "mean_by": "SELECT event_type, round(avg(value), 1) AS mean_value FROM events GROUP BY 1",
        "sum_by": "SELECT l_suppkey, sum(l_quantity) AS total_quantity FROM lineitem GROUP BY 1",
        "distinct_by": "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
        "top_groups": 'SELECT l_suppkey, count(*) AS "count" FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7',
        "top_rows": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
            ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25""",
        "leaders_per_group": """SELECT l_suppkey, l_linenumber, n AS "count", "rank" FROM (
              SELECT *, cast(rank() OVER (PARTITION BY l_suppkey ORDER BY n DESC) AS integer) AS "rank"
              FROM (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE "rank" = 1""",
        "first_per_group": """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (
              PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
        "above_group_mean": """SELECT * FROM (SELECT l_suppkey, l_orderkey, l_quantity,
              avg(l_quantity) OVER (PARTITION BY l_suppkey) AS mean_quantity FROM lineitem)
            WHERE l_quantity > mean_quantity""",
        "gap_to_group_min": """SELECT l_partkey, l_suppkey, l_quantity,
              l_quantity - min(l_quantity) OVER (PARTITION BY l_partkey) AS gap FROM lineitem""",
        "share_within": """SELECT user_id, event_type, n AS "count", cast(total AS bigint) AS total,
              round(n / total * 100, 2) AS percentage
            FROM (SELECT *, sum(n) OVER (PARTITION BY user_id) AS total
              FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2))""",
        "running_count": """SELECT o_orderpriority, day, n AS "count", cast(sum(n) OVER (
              PARTITION BY o_orderpriority ORDER BY day NULLS FIRST) AS bigint) AS running_total
            FROM (SELECT o_orderpriority, cast(o_orderdate AS date) AS day, count(*) AS n FROM orders GROUP BY 1, 2)""",
    }


def all_oracles() -> dict[str, str]:
    return _questions() | _operators()
