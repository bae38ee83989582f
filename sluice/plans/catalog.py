"""Registered queries: one per operator family, each over whole driver tables.

Every entry is ``name -> (build(spark, sf_dir) -> DataFrame, duckdb_sql | None)``. The SQL
is the independent oracle the driver runs on the same parquet files; a ``None`` SQL means
the result is not expressible in SQL (file names, checksums) and is checked by rows only.
Column names agree between the two sides; doubles are never rendered as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import coerce as C
from sluice.functions.render import render_line
from sluice.functions.template import expand_template, time_column
from sluice.operators import process as P
from sluice.operators.cells import cells_to_rows, filter_day_range, rows_to_cells
from sluice.operators.documents import to_bulk_docs
from sluice.operators.report import transfer_report
from sluice.operators.upsert import upsert
from sluice.operators.validate import check_fields
from sluice.plans.tables import register_views, table
from sluice.sources.sql_script import scan_sql

Build = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Build, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: Build) -> Build:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---- flagship: text lines -> split -> filter -> add dt -> mask -> JSON ------------------

EVENT_LINE_FIELDS = ["event_id", "ts", "user_id", "event_type", "props"]


@query("flagship", """
SELECT json_object('event_id', CAST(event_id AS VARCHAR),
                   'dt', strftime(date_trunc('second', ts) - INTERVAL 1 DAY, '%Y-%m-%d'),
                   'user_id', CAST(user_id AS VARCHAR),
                   'event_type', event_type,
                   'props', regexp_replace(props, '[0-9]', '#', 'g'))::VARCHAR AS value
FROM events WHERE event_type = 'purchase'
""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").transform(render_line("\\001", EVENT_LINE_FIELDS))
    return (lines
            .transform(P.split_line(EVENT_LINE_FIELDS, "\\001"))
            .transform(P.filter_row("event_type = 'purchase'"))
            .transform(P.add_field("dt", time_column("ts", "yyyy-MM-dd", "-1d"), after="ts"))
            .transform(P.replace_field("props", "[0-9]", "#"))
            .transform(P.line_to_json(["event_id", "dt", "user_id", "event_type", "props"], [0, 2, 3, 4, 5])))


# ---- row processors ------------------------------------------------------------------

@query("split_line", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_mktsegment, '' AS extra
FROM customer
""")
def q_split_line(spark, sf_dir):
    names = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "extra"]
    c = table(spark, sf_dir, "customer").withColumn("extra", F.lit(""))
    return c.transform(P.replace_delimit("|", names)).transform(P.split_line(names, "|"))


@query("add_field_before_after", """
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS customer_tag, o_orderkey, o_orderstatus, 'x' AS tag, o_custkey FROM orders
""")
def q_add_field(spark, sf_dir):
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
            .transform(P.add_field("tag", F.lit("x"), after="o_orderstatus"))
            .transform(P.add_field("customer_tag", "concat('c', o_custkey)", before="o_orderkey")))


@query("filter_remove_field", "SELECT p_partkey, p_brand, p_size FROM part")
def q_filter_remove(spark, sf_dir):
    return (table(spark, sf_dir, "part")
            .transform(P.filter_field(["p_partkey", "p_name", "p_brand", "p_size"]))
            .transform(P.remove_field("p_name")))


@query("replace_field_regex", r"""
SELECT doc_id, regexp_replace(text, '([0-9]+)', '<\1>', 'g') AS text FROM documents
""")
def q_replace_field(spark, sf_dir):
    return (table(spark, sf_dir, "documents").select("doc_id", "text")
            .transform(P.replace_field("text", "([0-9]+)", "<$1>")))


@query("filter_row", """
SELECT event_id, user_id, event_type FROM events
WHERE event_type IN ('purchase', 'signup') AND value > 20
""")
def q_filter_row(spark, sf_dir):
    return (table(spark, sf_dir, "events")
            .transform(P.filter_row("event_type IN ('purchase', 'signup') AND value > 20"))
            .select("event_id", "user_id", "event_type"))


@query("replace_delimit", """
SELECT concat_ws(chr(1), CAST(s_suppkey AS VARCHAR), coalesce(s_name, ''), CAST(s_nationkey AS VARCHAR)) AS value
FROM supplier
""")
def q_replace_delimit(spark, sf_dir):
    return table(spark, sf_dir, "supplier").transform(P.replace_delimit("\\001", ["s_suppkey", "s_name", "s_nationkey"]))


@query("line_to_json", r"""
SELECT '{"event_id":' || to_json(CAST(event_id AS VARCHAR))
       || CASE WHEN event_type <> 'view' THEN ',"kind":' || to_json(event_type) ELSE '' END
       || ',"who":' || to_json(CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR)
                                    ELSE 'u' || CAST(user_id AS VARCHAR) END)
       || '}' AS value
FROM events
""")
def q_line_to_json(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "view", F.lit("\\N")).otherwise(F.col("event_type")).alias("kind"),
        F.when(F.col("event_type") == "click", F.lit("  ")).otherwise(F.concat(F.lit("u"), "user_id")).alias("who"))
    return ev.transform(P.line_to_json(["event_id", "kind", "who,alt"], [0, 2, "3,1"]))


VALIDATION_RULES = {
    "c_name": [("regex", "Customer#[0-9]{9}")],
    "c_mktsegment": [("regex", "[A-Z]+"), ("regex", "(AUTOMOBILE|BUILDING|FURNITURE|MACHINERY)")],
    "c_acctbal": [("range", "0,5000")],
}


@query("validate_fields", """
SELECT c_custkey,
       concat_ws(';',
         CASE WHEN c_name IS NULL OR NOT regexp_full_match(c_name, 'Customer#[0-9]{9}') THEN 'c_name:regex' END,
         CASE WHEN c_mktsegment IS NULL OR NOT regexp_full_match(c_mktsegment, '[A-Z]+') THEN 'c_mktsegment:regex' END,
         CASE WHEN c_mktsegment IS NULL
                OR NOT regexp_full_match(c_mktsegment, '(AUTOMOBILE|BUILDING|FURNITURE|MACHINERY)')
              THEN 'c_mktsegment:regex' END,
         CASE WHEN c_acctbal IS NULL OR c_acctbal < 0 OR c_acctbal > 5000 THEN 'c_acctbal:range' END) AS errors,
       CAST((CASE WHEN c_name IS NULL OR NOT regexp_full_match(c_name, 'Customer#[0-9]{9}') THEN 1 ELSE 0 END)
          + (CASE WHEN c_mktsegment IS NULL OR NOT regexp_full_match(c_mktsegment, '[A-Z]+') THEN 1 ELSE 0 END)
          + (CASE WHEN c_mktsegment IS NULL
                   OR NOT regexp_full_match(c_mktsegment, '(AUTOMOBILE|BUILDING|FURNITURE|MACHINERY)')
                  THEN 1 ELSE 0 END)
          + (CASE WHEN c_acctbal IS NULL OR c_acctbal < 0 OR c_acctbal > 5000 THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
FROM customer
""")
def q_validate(spark, sf_dir):
    checked = table(spark, sf_dir, "customer").transform(check_fields(VALIDATION_RULES))
    return checked.select("c_custkey", F.concat_ws(";", "_errors").alias("errors"),
                          F.size("_errors").cast("bigint").alias("n_errors"))


# ---- templates -----------------------------------------------------------------------

@query("time_expr_column", """
SELECT event_id,
       strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS dt,
       strftime(ts + INTERVAL 1 HOUR, 'dt=%Y%m%d/hour=%H') AS hour_path,
       strftime(ts - INTERVAL 2 WEEK, '%Y-%m-%d %H:%M:%S') AS two_weeks_ago
FROM events
""")
def q_time_expr(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        time_column("ts", "yyyy-MM-dd", "-1d").alias("dt"),
        time_column("ts", "dt=yyyyMMdd/hour=HH", "+1H").alias("hour_path"),
        time_column("ts", "yyyy-MM-dd HH:mm:ss", "-2w").alias("two_weeks_ago"))


@query("time_expr_month_end", """
SELECT o_orderkey,
       strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m-%d') AS prev_month,
       strftime(o_orderdate - INTERVAL 1 MONTH + INTERVAL 1 DAY, '%Y-%m-%d') AS prev_month_next_day,
       strftime(o_orderdate + INTERVAL 1 YEAR - INTERVAL 3 DAY, '%Y%m%d') AS next_year
FROM orders
""")
def q_time_month_end(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        time_column("o_orderdate", "yyyy-MM-dd", "-1M").alias("prev_month"),
        time_column("o_orderdate", "yyyy-MM-dd", "-1M+1d").alias("prev_month_next_day"),
        time_column("o_orderdate", "yyyyMMdd", "+1y-3d").alias("next_year"))


@query("expand_template", """
SELECT o_orderkey, CAST(e.i * 2 + r.j AS BIGINT) AS pos,
       'dt=' || strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') || '/part=' || e.v || '/r' || r.v AS value
FROM orders,
     (VALUES (0, '00'), (1, '01'), (2, '02')) e(i, v),
     (VALUES (0, '001'), (1, '002')) r(j, v)
""")
def q_expand_template(spark, sf_dir):
    tpl = "dt=${time:yyyyMMdd,-1d}/part=${enum:0~3,2}/r${range:1,2,1,3}"
    out = (table(spark, sf_dir, "orders")
           .transform(expand_template(tpl, base="o_orderdate", keep=["o_orderkey"], with_position=True)))
    return out.select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), "value")


# ---- coercions and rendering ---------------------------------------------------------

ROUND_SQL = {
    "halfup": "round(x, 2)",
    "halfeven": "round_even(x, 2)",
    "ceiling": "CAST(ceil(x * 100) AS DECIMAL(38,0)) * 0.01",
    "floor": "CAST(floor(x * 100) AS DECIMAL(38,0)) * 0.01",
    "up": "CAST(sign(x) * ceil(abs(x) * 100) AS DECIMAL(38,0)) * 0.01",
    "down": "CAST(trunc(x * 100) AS DECIMAL(38,0)) * 0.01",
    "halfdown": "CAST(sign(x) * ceil(abs(x) * 100 - 0.5) AS DECIMAL(38,0)) * 0.01",
}


@query("normalize_numeric", "SELECT l_orderkey, l_linenumber, "
       + ", ".join(f"CAST(CAST({sql} AS DECIMAL(38,2)) AS VARCHAR) AS r_{m}" for m, sql in ROUND_SQL.items())
       + """ FROM (SELECT l_orderkey, l_linenumber,
                 CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(l_discount AS DECIMAL(4,2)) - 0.05) AS x
          FROM lineitem)""")
def q_normalize_numeric(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice").cast("decimal(12,2)") * (F.col("l_discount").cast("decimal(4,2)") - F.lit(0.05).cast("decimal(3,2)"))
    base = li.select("l_orderkey", "l_linenumber", x.alias("x"))
    return base.select("l_orderkey", "l_linenumber",
                       *[C.round_decimal("x", 2, m).cast("decimal(38,2)").cast("string").alias(f"r_{m}")
                         for m in ROUND_SQL])


@query("render_line", r"""
SELECT replace(concat_ws(chr(9), CAST(doc_id AS VARCHAR), replace(text, chr(9), '\t'), replace(lang, chr(9), '\t'),
                         replace(source, chr(9), '\t')), chr(10), '\n') AS value
FROM documents
""")
def q_render_line(spark, sf_dir):
    return table(spark, sf_dir, "documents").transform(render_line("\\t", ["doc_id", "text", "lang", "source"]))


@query("render_line_typed", """
SELECT concat_ws('|', CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id AS VARCHAR),
                 event_type, props) AS value,
       strftime(ts, '%Y-%m-%d') AS day
FROM events
""")
def q_render_line_typed(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(*EVENT_LINE_FIELDS, C.render_date("ts").alias("day"))
    return ev.transform(render_line("|", EVENT_LINE_FIELDS, escape=False, keep=["day"]))


@query("coerce_fields", r"""
SELECT event_id,
       CASE WHEN replace(replace(replace(replace(a, '''', ''), '\\N', ''), '\N', ''), ' ', '') = '' THEN 0
            ELSE TRY_CAST(replace(replace(replace(a, '''', '0'), '\\N', '0'), '\N', '0') AS BIGINT) END AS a,
       replace(replace(replace(b, '''', ''), '\\N', ''), '\N', '') AS b,
       CAST(TRY_CAST(c AS DATE) AS VARCHAR) AS c,
       strftime(TRY_STRPTIME(d, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS d
FROM (SELECT event_id,
             CASE event_type WHEN 'error' THEN '\N' WHEN 'click' THEN ' ' WHEN 'view' THEN '12x'
                  ELSE regexp_extract(props, '[0-9]+') END AS a,
             'it''s ' || event_type || CASE WHEN event_type = 'signup' THEN '\N' ELSE '' END AS b,
             CASE WHEN event_type = 'signup' THEN 'x' ELSE strftime(ts, '%Y-%m-%d') END AS c,
             strftime(ts, '%Y-%m-%d %H:%M:%S') AS d
      FROM events)
""")
def q_coerce_fields(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    raw = ev.select(
        "event_id",
        F.when(et == "error", F.lit("\\N")).when(et == "click", F.lit(" ")).when(et == "view", F.lit("12x"))
         .otherwise(F.regexp_extract("props", "[0-9]+", 0)).alias("a"),
        F.concat(F.lit("it's "), et, F.when(et == "signup", F.lit("\\N")).otherwise(F.lit(""))).alias("b"),
        F.when(et == "signup", F.lit("x")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("c"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("d"))
    typed = C.coerce_fields(raw, {"a": "int", "b": "string", "c": "date", "d": "timestamp"})
    return typed.select("event_id", "a", "b", F.col("c").cast("string").alias("c"),
                        F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("d"))


@query("scrub_controls", """
SELECT doc_id, replace(replace(text, chr(1), ''), chr(2), '') || ' a|b' AS text,
       CAST(length(text) - length(replace(text, ' ', '')) + 2 AS BIGINT) AS planted
FROM documents
""")
def q_scrub(spark, sf_dir):
    """Control characters are planted beside every space of the text, and at its end."""
    marked = F.concat(F.replace("text", F.lit(" "), F.lit("\u0001 ")), F.lit("\u0002 a\u0001|b"))
    docs = table(spark, sf_dir, "documents").select("doc_id", marked.alias("marked"))
    planted = (F.char_length("marked") - F.char_length(C.scrub_controls("marked"))).cast("bigint")
    return docs.select("doc_id", C.scrub_controls("marked").alias("text"), planted.alias("planted"))


@query("encode_nulls", r"""
SELECT d.doc_id,
       CASE WHEN l.quality IS NULL THEN '\N' ELSE CAST(l.quality AS VARCHAR) END AS quality,
       CASE WHEN l.toxic IS NULL THEN '\N' ELSE CAST(l.toxic AS VARCHAR) END AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_encode_nulls(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return C.encode_nulls(joined, ["quality", "toxic"])


# ---- shuffling operators: upsert, cells, bulk documents ---------------------------------

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_UPSERT_INPUTS = """
WITH ex AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
            FROM orders WHERE o_orderstatus IN ('F', 'O')),
inc AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderpriority, 1 AS version
        FROM orders WHERE o_orderstatus IN ('O', 'P')
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2 AS o_totalprice, o_orderpriority, 2 AS version
        FROM orders WHERE o_orderstatus = 'P'),
pick AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM (
           SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version {dir}) AS rn FROM inc) WHERE rn = 1)
"""


def _upsert_inputs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    existing = o.filter(F.col("o_orderstatus").isin("F", "O")).select(*ORDER_COLS)
    v1 = o.filter(F.col("o_orderstatus").isin("O", "P")).select(
        *ORDER_COLS[:3], (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderpriority", F.lit(1).alias("version"))
    v2 = o.filter(F.col("o_orderstatus") == "P").select(
        *ORDER_COLS[:3], (F.col("o_totalprice") + 2).alias("o_totalprice"), "o_orderpriority", F.lit(2).alias("version"))
    return existing, v1.unionByName(v2)


@query("upsert_replace", _UPSERT_INPUTS.format(dir="DESC") + """
SELECT * FROM ex WHERE o_orderkey NOT IN (SELECT o_orderkey FROM pick)
UNION ALL SELECT * FROM pick
""")
def q_upsert_replace(spark, sf_dir):
    existing, incoming = _upsert_inputs(spark, sf_dir)
    return upsert(existing, incoming, ["o_orderkey"], mode="replace", order="version")


@query("upsert_ignore", _UPSERT_INPUTS.format(dir="ASC") + """
SELECT * FROM ex
UNION ALL SELECT * FROM pick WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ex)
""")
def q_upsert_ignore(spark, sf_dir):
    existing, incoming = _upsert_inputs(spark, sf_dir)
    return upsert(existing, incoming, ["o_orderkey"], mode="ignore", order="version")


_ROWKEY_SQL = "c_name || '-' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR)"
CELL_LAYOUT = dict(key_pos=[2, 3, 1], value_pos=[5, 3, 1], qualifiers=["seg", "nation", "key"], family="data")


@query("rows_to_cells", f"""
SELECT {_ROWKEY_SQL} AS rowkey, 'data' AS family, 'seg' AS qualifier, c_mktsegment AS value FROM customer
UNION ALL SELECT {_ROWKEY_SQL}, 'data', 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT {_ROWKEY_SQL}, 'data', 'key', CAST(c_custkey AS VARCHAR) FROM customer
""")
def q_rows_to_cells(spark, sf_dir):
    return table(spark, sf_dir, "customer").transform(rows_to_cells(key_delim="-", **CELL_LAYOUT))


@query("cells_to_rows", f"""
SELECT {_ROWKEY_SQL} AS rowkey, c_mktsegment AS data_seg, CAST(c_nationkey AS VARCHAR) AS data_nation,
       CAST(c_custkey AS VARCHAR) AS data_key,
       {_ROWKEY_SQL} || chr(1) || c_mktsegment || chr(1) || CAST(c_nationkey AS VARCHAR) || chr(1)
         || CAST(c_custkey AS VARCHAR) AS value
FROM customer
""")
def q_cells_to_rows(spark, sf_dir):
    cells = table(spark, sf_dir, "customer").transform(rows_to_cells(key_delim="-", **CELL_LAYOUT))
    return cells.transform(cells_to_rows("data", "seg,nation,key", as_line=True))


@query("filter_day_range", """
SELECT event_id, user_id FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'
""")
def q_filter_day_range(spark, sf_dir):
    return (table(spark, sf_dir, "events").transform(filter_day_range("ts", "2024-01-05", "2024-01-12"))
            .select("event_id", "user_id"))


@query("filter_day_range_epoch", """
SELECT event_id FROM events
WHERE epoch(date_trunc('second', ts)) >= epoch(TIMESTAMP '2024-01-20') AND ts IS NOT NULL
""")
def q_filter_day_range_epoch(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.unix_timestamp("ts").cast("string").alias("epoch_s"))
    return ev.transform(filter_day_range("epoch_s", "2024-01-20", None)).select("event_id")


@query("to_bulk_docs", """
SELECT CAST(user_id AS VARCHAR) AS doc_id,
       '{"index":{"_index":"events","_type":"event","_id":"' || CAST(user_id AS VARCHAR) || '"}}' AS action,
       json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type, 'props', props)::VARCHAR AS doc
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def q_to_bulk_docs(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return ev.transform(to_bulk_docs("events", "event", id_col="user_id", order="event_id"))


# ---- unions, limits, SQL scripts, report ----------------------------------------------

@query("union_sources", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_union_sources(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return P.union_sources(*[o.filter(F.col("o_orderstatus") == s) for s in ("F", "O", "P")])


@query("limit_rows", "SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT * FROM orders LIMIT 100)")
def q_limit_rows(spark, sf_dir):
    capped = table(spark, sf_dir, "orders").transform(P.limit_rows(100))
    return capped.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


SCRIPT = """
CREATE OR REPLACE TEMP VIEW shipped AS
  SELECT l_returnflag, l_linestatus, CAST(l_quantity AS DECIMAL(12,2)) AS qty,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00';
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(qty) AS VARCHAR(40)) AS sum_qty, CAST(sum(price) AS VARCHAR(40)) AS sum_price
FROM shipped GROUP BY l_returnflag, l_linestatus
"""


@query("scan_sql", SCRIPT.replace("CREATE OR REPLACE TEMP VIEW shipped AS", "WITH shipped AS (")
       .replace("00:00:00';", "00:00:00')"))
def q_scan_sql(spark, sf_dir):
    register_views(spark, sf_dir, ["lineitem"])
    return scan_sql(spark, SCRIPT)


@query("transfer_report", """
SELECT event_type, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(length(concat_ws('|', CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'),
                                 CAST(user_id AS VARCHAR), event_type, props))) AS BIGINT) AS chars
FROM events GROUP BY event_type
""")
def q_transfer_report(spark, sf_dir):
    lines = table(spark, sf_dir, "events").transform(
        render_line("|", EVENT_LINE_FIELDS, escape=False, keep=["event_type"]))
    return lines.transform(transfer_report(by="event_type", line_col="value"))


# ---- SQL through the script source: windows, top-k, set operations --------------------

# Top-k per group written so Spark can limit each group *before* the shuffle
# (WindowGroupLimit: only rank-like functions in the window), and the per-group count as a
# GROUP BY with map-side combine -- a customer holding a third of the orders never lands
# whole in one task. A count(*) OVER in the same window would disable that limit.
WINDOW_SCRIPT = r"""
CREATE OR REPLACE TEMP VIEW top3 AS
  SELECT o_custkey, o_orderkey, rk FROM (
    SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
    FROM orders) WHERE rk <= 3;
CREATE OR REPLACE TEMP VIEW per_cust AS
  SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey;
SELECT t.o_custkey, t.o_orderkey, CAST(t.rk AS BIGINT) AS rk, CAST(p.n_orders AS BIGINT) AS n_orders
FROM top3 t JOIN per_cust p ON t.o_custkey = p.o_custkey
"""


@query("scan_sql_window", """
SELECT o_custkey, o_orderkey, CAST(rk AS BIGINT) AS rk, n_orders FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk,
         CAST(count(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS n_orders
  FROM orders) WHERE rk <= 3
""")
def q_scan_sql_window(spark, sf_dir):
    register_views(spark, sf_dir, ["orders"])
    return scan_sql(spark, WINDOW_SCRIPT)


SETOPS_SCRIPT = """
SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier;
SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier
"""


@query("scan_sql_setops", """
(SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL
(SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
""")
def q_scan_sql_setops(spark, sf_dir):
    register_views(spark, sf_dir, ["customer", "supplier"])
    return scan_sql(spark, SETOPS_SCRIPT)


@query("shard_split", """
SELECT CAST(o_orderkey % 8 AS INTEGER) AS shard, CAST(count(*) AS BIGINT) AS n_rows FROM orders GROUP BY 1
""")
def q_shard_split(spark, sf_dir):
    from sluice.operators.shard import assign_shard
    sharded = table(spark, sf_dir, "orders").transform(assign_shard(["o_orderkey"], 8, how="mod"))
    return sharded.groupBy(F.col("shard").cast("int").alias("shard")).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
