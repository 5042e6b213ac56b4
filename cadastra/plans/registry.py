"""Queries: every operator over the test tables, with the DuckDB statement where SQL has one.

The tables hold no gazettes, so table columns take the part of gazette fields: a line item's order
is a notification and its line number a serial number, a conversation is a table whose rows are
turns, and so on.  Each query runs over its whole tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.functions import cells as ce
from cadastra.functions import scalars as sc
from cadastra.functions import text as tx
from cadastra.operators import documents, mapping, merge, records, spans, tables
from cadastra.plans.extract import extract
from cadastra.sources import artifacts, html
from cadastra.streaming import ledger as lg
from cadastra.streaming import pipeline

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as application rows: notification = order, Sr. No. = line number."""
    li, part = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part")
    place = F.element_at(F.array(*[F.lit(t) for t in (*schemas.TALUKAS, "Nowhere", "")]), (F.col("l_suppkey") % 14 + 1).cast("int"))
    rows = li.join(part, li["l_partkey"] == part["p_partkey"], "left").select(
        F.lit("tpch").alias("gazette_id"), F.lit("lineitem").alias("source_filename"), F.col("l_orderkey").cast("string").alias("notification_no"),
        F.lit("change_of_zone").alias("table_variant"), F.concat(F.col("l_linenumber").cast("string"), F.lit(".")).alias("sr_no"),
        F.col("p_brand").alias("applicant"), F.when(F.col("l_partkey") % 11 != 0, F.concat_ws("/", "l_partkey", "l_linenumber")).alias("survey_raw"),
        F.lit("v").alias("village"), F.nullif(place, F.lit("")).alias("taluka"), F.lit("x").alias("existing_use"), F.lit(None).cast("bigint").alias("total_area_sqm"),
        F.lit("y").alias("proposed_use"), F.col("l_quantity").cast("bigint").alias("area_proposed_sqm"), F.col("l_returnflag").alias("decision"), F.lit(1).alias("page_from"),
        F.lit(1).alias("page_to"), F.lit(0.9).alias("confidence"), F.lit(None).cast("string").alias("review_reason"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus").alias("row_seq"),
    )
    key = sc.row_hash(F.col("gazette_id"), F.col("notification_no"), F.col("sr_no"), F.col("survey_raw"), F.col("decision"))
    return rows.withColumn("row_hash", key)


_APPLICATIONS = """
app AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS notification_no, CAST(l_linenumber AS VARCHAR) || '.' AS sr_no, l_linenumber AS sr,
         CASE WHEN l_partkey % 11 <> 0 THEN CAST(l_partkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) END AS survey_raw,
         nullif(['bardez','bicholim','canacona','dharbandora','mormugao','pernem','ponda','quepem','salcete','sanguem','sattari','tiswadi','Nowhere',''][l_suppkey % 14 + 1], '') AS taluka,
         l_returnflag AS decision,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus) AS k
  FROM lineitem)
"""
_ISSUES = """
iss AS (
  SELECT notification_no, sr_no, unnest(list_filter([
      CASE WHEN survey_raw IS NULL THEN 'Missing survey numbers' END,
      CASE WHEN taluka IS NULL THEN 'Missing taluka' WHEN taluka = 'Nowhere' THEN 'Unknown taluka: Nowhere' END,
      CASE WHEN k > 1 THEN 'Duplicate sr_no ' || CAST(sr AS VARCHAR) END], lambda x: x IS NOT NULL)) AS reason
  FROM app)
"""


@query(f"WITH {_APPLICATIONS}, {_ISSUES} SELECT reason, count(*) AS n, count(DISTINCT notification_no) AS notifications FROM iss GROUP BY reason")
def validation_errors(spark, sf_dir):
    issues = records.row_issues(_applications(spark, sf_dir)).select("notification_no", F.explode("issues").alias("reason"))
    return issues.groupBy("reason").agg(F.count("*").alias("n"), F.countDistinct("notification_no").alias("notifications"))


@query(f"WITH {_APPLICATIONS}, {_ISSUES} SELECT notification_no, sr_no, reason FROM iss WHERE reason LIKE 'Duplicate%'")
def sr_duplicate(spark, sf_dir):
    issues = records.row_issues(_applications(spark, sf_dir)).select("notification_no", "sr_no", F.explode("issues").alias("reason"))
    return issues.where(F.col("reason").startswith("Duplicate"))


@query("""
WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem),
g AS (SELECT l_orderkey, n, lag(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS b FROM d),
f AS (SELECT l_orderkey, min(n) AS n, arg_min(b, n) AS b FROM g WHERE n <> b + 1 GROUP BY l_orderkey)
SELECT CAST(l_orderkey AS VARCHAR) AS notification_no,
       'Non-monotonic sr_no sequence gap between ' || CAST(b AS VARCHAR) || ' and ' || CAST(n AS VARCHAR) || ' (notification ' || CAST(l_orderkey AS VARCHAR) || ')' AS reason
FROM f""")
def sr_first_gap(spark, sf_dir):
    return records.gap_issues(_applications(spark, sf_dir)).select("notification_no", "reason")


@query(f"""WITH {_APPLICATIONS}
SELECT notification_no, sr_no, survey_raw, taluka,
  sha256('tpch|' || notification_no || '|' || sr_no || '|' || coalesce(survey_raw, '') || '|' || coalesce(decision, '')) AS row_hash
FROM app WHERE survey_raw IS NOT NULL AND taluka IS NOT NULL AND taluka <> 'Nowhere' AND k = 1""")
def partition_good_rows(spark, sf_dir):
    good, _ = records.validate(_applications(spark, sf_dir))
    return good.select("notification_no", "sr_no", "survey_raw", "taluka", "row_hash")


@query(f"""WITH {_APPLICATIONS}, {_ISSUES},
good AS (SELECT * FROM app WHERE survey_raw IS NOT NULL AND taluka IS NOT NULL AND taluka <> 'Nowhere' AND k = 1),
gaps AS (SELECT DISTINCT l_orderkey FROM (SELECT l_orderkey, n, lag(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS b FROM (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem)) WHERE n <> b + 1)
SELECT 'rows' AS kind, count(*) AS n FROM good UNION ALL SELECT 'plots', count(*) FROM good
UNION ALL SELECT 'review', (SELECT count(*) FROM iss) + (SELECT count(*) FROM gaps)""")
def outbox_by_kind(spark, sf_dir):
    good, issues = records.validate(_applications(spark, sf_dir))
    tagged = records.tagged_records(good, records.plots(good), issues)
    return tagged.groupBy("kind").agg(F.count("payload").alias("n"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tables: the users' turns carry a serial number, the longest others a
    survey and a place of their own."""
    c = _t(spark, sf_dir, "conversations")
    sr = F.when(F.col("role") == "user", F.concat(F.col("turn").cast("string"), F.lit("."))).when(F.length("text") % 13 == 0, "-").otherwise("")
    own = F.when((F.col("role") == "user") | (F.length("text") % 5 == 0), F.lit("s")).otherwise("")
    return c.select(
        F.col("conv_id").alias("gazette_id"), F.col("turn").alias("row_idx"), F.array(sr, own, own, F.col("turn").cast("string")).alias("cells"),
        F.lit(0).alias("sr_col"), F.lit(1).alias("survey_col"), F.lit(2).alias("place_col"),
    )


_MERGE = """
WITH r AS (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN turn END AS sr, role = 'user' AS filled_sr,
         role = 'user' OR length(text) % 13 = 0 AS filled, role = 'user' OR length(text) % 5 = 0 AS own,
         row_number() OVER w AS pos,
         CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) || '.' WHEN length(text) % 13 = 0 THEN '-' ELSE '' END AS c0,
         CASE WHEN role = 'user' OR length(text) % 5 = 0 THEN 's' ELSE '' END AS c1
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (
  SELECT *, sum(CAST(filled AS INT)) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM r),
n AS (
  SELECT *,
    max(CASE WHEN sr IS NOT NULL THEN pos END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo,
    min(CASE WHEN sr IS NOT NULL THEN pos END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi
  FROM s),
v AS (
  SELECT n.*, NOT n.filled AND NOT n.own AND n.pos > 1 AS by_content,
    CASE WHEN n.sr IS NULL AND b.upto - a.upto = 1 AND b.sr > a.sr THEN
      CASE WHEN b.sr = a.sr + 1 THEN TRUE WHEN b.sr - a.sr - 1 = n.hi - n.lo - 1 THEN FALSE END END AS verdict
  FROM n LEFT JOIN s a ON a.conv_id = n.conv_id AND a.pos = n.lo LEFT JOIN s b ON b.conv_id = n.conv_id AND b.pos = n.hi),
c AS (SELECT *, coalesce(verdict, by_content) AS cont FROM v),
d AS (
  SELECT *, cont <> by_content AS clash, sum(CAST(NOT cont AS INT)) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rec FROM c),
hit AS (
  SELECT conv_id, rec AS rec FROM d WHERE clash UNION SELECT conv_id, CASE WHEN cont THEN rec ELSE rec - 1 END FROM d WHERE clash)
"""


@query(_MERGE + """
SELECT conv_id, CAST(rec AS BIGINT) AS record_id, array_to_string(list_filter(list(c0 ORDER BY turn), lambda x: x <> ''), ' ') AS sr,
       array_to_string(list_filter(list(c1 ORDER BY turn), lambda x: x <> ''), ' ') AS survey, string_agg(CAST(turn AS VARCHAR), ' ' ORDER BY turn) AS turns
FROM d GROUP BY conv_id, rec""")
def continuation_merge(spark, sf_dir):
    done = merge.fold_records(merge.number_records(_turns(spark, sf_dir), ("gazette_id",)), ("gazette_id",))
    return done.select(
        F.col("gazette_id").alias("conv_id"), F.col("record_id").cast("long").alias("record_id"), F.get("cells", F.lit(0)).alias("sr"), F.get("cells", F.lit(1)).alias("survey"), F.get("cells", F.lit(3)).alias("turns")
    )


@query(_MERGE + "SELECT DISTINCT conv_id, CAST(rec AS BIGINT) AS record_id FROM hit")
def disputed_records(spark, sf_dir):
    done = merge.fold_records(merge.number_records(_turns(spark, sf_dir), ("gazette_id",)), ("gazette_id",))
    return done.where("disputed").select(F.col("gazette_id").alias("conv_id"), F.col("record_id").cast("long").alias("record_id"))


@query("""SELECT p_partkey, CAST(p_partkey AS VARCHAR) || '/' || CAST(n AS VARCHAR) AS survey_number, p_partkey % 3 = 0 AS is_part
FROM (SELECT p_partkey, unnest(generate_series(10, CAST(p_size AS BIGINT))) AS n FROM part)""")
def survey_explode(spark, sf_dir):
    part = F.when(F.col("p_partkey") % 3 == 0, " (P)").otherwise("")
    raw = F.concat(F.col("p_partkey").cast("string"), F.lit("/10 to "), F.col("p_size").cast("string"), part)
    return sc.explode_surveys(_t(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")), F.col("raw")).drop("raw")


@query("""WITH t AS (SELECT p_partkey, p_size, ['7/' || CAST(p_size AS VARCHAR) || '-A (Part)', '256/2', 'Plot No. ' || CAST(p_partkey AS VARCHAR), '7/' || CAST(p_size AS VARCHAR) || '-A'] AS l FROM part)
SELECT p_partkey, survey_number, is_part FROM (
  SELECT p_partkey, '7/' || CAST(p_size AS VARCHAR) || '-A' AS survey_number, TRUE AS is_part FROM t
  UNION ALL SELECT p_partkey, '256/2', FALSE FROM t UNION ALL SELECT p_partkey, 'Plot No. ' || CAST(p_partkey AS VARCHAR), FALSE FROM t)""")
def survey_singles(spark, sf_dir):
    raw = F.concat(F.lit("7/"), F.col("p_size").cast("string"), F.lit("-A (Part), 256/2, (P), pt, Plot No. "), F.col("p_partkey").cast("string"), F.lit(",\n7/"), F.col("p_size").cast("string"), F.lit("-A"))
    return sc.explode_surveys(_t(spark, sf_dir, "part").select("p_partkey", raw.alias("raw")), F.col("raw")).drop("raw")


@query("""SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS plain, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE NULL END AS total,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE 300 END AS zone FROM orders""")
def indian_int_total_area(spark, sf_dir):
    key = F.col("o_orderkey")
    grouped = F.format_number(F.floor("o_totalprice"), 0)
    total = F.when(key % 3 == 0, F.concat(F.lit("RPG 2021 Total  Area ("), F.format_number("o_orderkey", 0), F.lit(" m2)"))).otherwise("Total Area (none)")
    zone = F.when(key % 3 == 2, "Orchard, Zone 300").otherwise("Orchard, 300")
    return _t(spark, sf_dir, "orders").select("o_orderkey", sc.indian_int(F.concat(F.lit("Area "), grouped, F.lit(" sq"))).alias("plain"), sc.total_area(total).alias("total"), sc.indian_int(zone).cast("int").alias("zone"))


@query("SELECT p_partkey, 'Orchard' AS use, CAST(p_size AS BIGINT) AS sqm FROM part UNION ALL SELECT p_partkey, 'Paddy field', 12 FROM part")
def area_breakdown(spark, sf_dir):
    raw = F.concat(F.lit("Partly Orchard ("), F.col("p_size").cast("string"), F.lit("m2) and partly Paddy field  (12m2), partly x (y)"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.explode(sc.area_breakdown(raw)).alias("e")).select("p_partkey", "e.use", "e.sqm")


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE n_name END AS village,
  CASE WHEN n_nationkey % 3 = 0 THEN r_name WHEN n_nationkey % 3 = 2 THEN 'Ponda' END AS taluka, n_nationkey % 3 = 2 AS known
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def place_split(spark, sf_dir):
    n, r = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    k = F.col("n_nationkey") % 3
    raw = F.when(k == 0, F.concat(F.lit(" "), F.col("n_name"), F.lit(", ,x, "), F.col("r_name"), F.lit(",\t"))).when(k == 1, F.concat(F.col("n_name"), F.lit(" ,"))).otherwise(" Ponda ")
    joined = n.join(r, n["n_regionkey"] == r["r_regionkey"]).withColumn("p", sc.split_place(raw))
    return joined.select("n_nationkey", "p.village", "p.taluka", sc.is_known_taluka(F.col("p.taluka")).alias("known"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  sha256('g|' || coalesce(nullif(CAST(l_orderkey AS VARCHAR), '1'), '') || '|' || CAST(l_linenumber AS VARCHAR) || '||' || coalesce(nullif(l_returnflag, 'N'), '')) AS row_hash,
  sha256('g|' || coalesce(nullif(CAST(l_orderkey AS VARCHAR), '1'), 'None') || '|' || coalesce(nullif(CAST(l_linenumber AS VARCHAR), '2'), 'None') || '|' || CAST(l_partkey AS VARCHAR)) AS plot_hash
FROM lineitem""")
def row_and_plot_hash(spark, sf_dir):
    s = lambda c: F.col(c).cast("string")
    order = F.nullif(s("l_orderkey"), F.lit("1"))
    return _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        sc.row_hash(F.lit("g"), order, s("l_linenumber"), F.lit(None).cast("string"), F.nullif("l_returnflag", F.lit("N"))).alias("row_hash"),
        sc.plot_hash(F.lit("g"), order, F.nullif(s("l_linenumber"), F.lit("2")), s("l_partkey")).alias("plot_hash"),
    )


_HEADERS = (
    (1, ["Sr. No.", "Name of the applicant", "Sy. No./ Sub-div", "Village/Taluka", "Published land use", "Proposed land use", "Area proposed in sq.mts", "Decision of TCP Board"], None),
    (2, ["Sr", "Survey No", "Name of village", "Existing", "Proposed", "In sq. m", "Recommended or not"], "ndz"),
    (3, ["a", "b", "c", "d", "e", "f", "g"], "ndz"),
    (4, ["a", "b", "c", "d", "e", "f", "g", "h"], "change_of_zone"),
    (5, ["Easy approach", "Receipt book"], None),
    (6, ["", "applicant", "name", "survey  no", "decision"], None),
    (7, [f"{i}" for i in range(1, 9)], None),
    (8, ["1", "", "3", "(4)"], None),
    (9, ["1", "3", "2"], None),
    (10, ["Sr", "No Development Zone", ""], None),
)


def _headers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(_HEADERS), "id int, header array<string>, hint string")


_HEADER_VALUES = ", ".join(f"({i}, {h!r}, {'NULL' if v is None else repr(v)})" for i, h, v in _HEADERS)
_ALIAS_VALUES = ", ".join(f"({o}, '{f}', '{a}')" for o, f in enumerate(schemas.FIELDS) for a in mapping.ALIASES[f])


@query(f"""
WITH h(id, header, hint) AS (VALUES {_HEADER_VALUES}), alias(ord, field, word) AS (VALUES {_ALIAS_VALUES}),
cell AS (SELECT id, hint, unnest(generate_series(0, len(header) - 1)) AS col, unnest(header) AS raw FROM h),
cand AS (
  SELECT id, col, ord, field, max(length(word)) AS n FROM cell, alias
  WHERE regexp_matches(trim(regexp_replace(lower(trim(raw)), '\\s+', ' ', 'g')), '(^|[^a-z0-9])' || regexp_escape(word)) AND NOT (field = 'applicant' AND coalesce(hint, '') = 'ndz')
  GROUP BY ALL)
SELECT id, field, CAST(col AS INT) AS col, CAST(n AS INT) AS n FROM cand""")
def header_alias_candidates(spark, sf_dir):
    """Field candidates of headings (the greedy choice among them is in ``column_map``)."""
    each = _headers(spark).select("id", F.explode(mapping.heading_candidates(F.col("header"), F.col("hint"))).alias("c"))
    return each.select("id", "c.field", "c.col", "c.n")


@query(f"""
WITH h(id, header, hint) AS (VALUES {_HEADER_VALUES})
SELECT id, id IN (7, 8) AS number_row, id IN (1, 2, 10) AS text_header, id IN (1, 2, 3, 4, 6) AS is_39a,
  CASE id WHEN 1 THEN 'change_of_zone' WHEN 2 THEN 'ndz' WHEN 3 THEN 'ndz' WHEN 4 THEN 'change_of_zone' WHEN 6 THEN 'change_of_zone' END AS variant,
  CASE id WHEN 1 THEN '0,1,2,3,4,5,6,7' WHEN 2 THEN '0,-,1,2,3,4,5,6' WHEN 3 THEN '0,-,1,2,3,4,5,6' WHEN 4 THEN '0,1,2,3,4,5,6,7' WHEN 6 THEN '-,1,3,-,-,-,-,4' END AS map FROM h""")
def column_map(spark, sf_dir):
    m = _headers(spark).withColumn("m", mapping.heuristic_map(F.col("header"), F.col("hint")))
    shown = F.concat_ws(",", *[F.coalesce(F.col(f"m.column_map.{f}").cast("string"), F.lit("-")) for f in schemas.FIELDS])
    return m.select("id", ce.is_column_number_row(F.col("header")).alias("number_row"), ce.is_text_header_row(F.col("header")).alias("text_header"), "m.is_39a", "m.variant", F.when(F.col("m.is_39a"), shown).alias("map"))


@query("SELECT doc_id, length(trim(text, ' \t\n\r\x0b\x0c')) AS n, CASE WHEN length(trim(text, ' \t\n\r\x0b\x0c')) < 50 THEN 'scanned' ELSE 'digital' END AS page_class FROM documents")
def page_class(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.length(tx.strip(F.col("text"))).alias("n"), tx.page_class(F.col("text")).alias("page_class"))


@query(r"""
SELECT conv_id, turn, regexp_matches(prose, '(?i)section\s+39A|\bsystem\b') AS anchor, nullif(trim(regexp_extract(prose, '(?i)Notification\s+No\.?\s*([^\r\n]+)', 1)), '') AS notification_no,
       prose LIKE '%| cell%' AS cells_left
FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'Notification No. ' || CAST(turn AS VARCHAR) || E'\n' || text || E'\nSection  39A' ELSE role || E'\n' || text END AS prose FROM conversations)""")
def anchor_flags(spark, sf_dir):
    page = F.when(F.col("role") == "user", F.concat(F.lit("  | Section 39A | cell |\nNotification No. "), F.col("turn").cast("string"), F.lit("\n"), F.col("text"), F.lit("\nSection  39A\n| cell"))).otherwise(
        F.concat(F.col("role"), F.lit("\n"), F.col("text"))
    )
    prose = tx.prose(page)
    return _t(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.matches_any(prose, (r"section\s+39A", r"\bsystem\b")).alias("anchor"), tx.notification_no(prose).alias("notification_no"), prose.contains("| cell").alias("cells_left")
    )


@query("""
WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page, event_type FROM events),
s AS (SELECT user_id, page AS a, page + 3 AS b FROM e WHERE event_type = 'signup')
SELECT s.user_id, s.a AS page_start, count(*) AS n_tables, min(e.page) AS first_page, max(e.page) AS last_page
FROM s JOIN e ON e.user_id = s.user_id AND e.page BETWEEN s.a AND s.b GROUP BY ALL""")
def span_range_join(spark, sf_dir):
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("gazette_id"), page.alias("page_no"), "event_type")
    s = e.where(F.col("event_type") == "signup").select("gazette_id", F.col("page_no").alias("span_id"), F.lit("n").alias("notification_no"), F.col("page_no").alias("page_start"), (F.col("page_no") + 3).alias("page_end"), F.lit(None).cast("string").alias("variant_hint"))
    joined = spans.tables_in_spans(e, s)
    return joined.groupBy(F.col("gazette_id").alias("user_id"), "page_start").agg(F.count("*").alias("n_tables"), F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"))


def _event_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    kind = lambda *k: F.col("event_type").isin(*k)
    return _t(spark, sf_dir, "events").select(
        F.col("user_id").alias("gazette_id"), page.alias("page_no"), kind("signup").alias("anchor"), kind("error", "logout").alias("closes"), F.col("event_id").cast("string").alias("notification_no"),
        F.lit(None).cast("string").alias("variant_hint"), F.lit(False).alias("ends_start"), kind("purchase").alias("ends_any"), (F.col("event_id") % 2 == 0).alias("fresh"),
    )


@query("""
WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, event_type = 'signup' AS anchor, event_type IN ('error', 'logout') AS closes,
                            event_type = 'purchase' AS ends FROM events),
w(user_id, p, start, done_start, done_end) AS (
  SELECT user_id, 0, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM (SELECT DISTINCT user_id FROM e)
  UNION ALL
  SELECT w.user_id, e.p,
    CASE WHEN w.start IS NULL THEN CASE WHEN e.anchor THEN e.p END WHEN e.anchor THEN e.p WHEN e.ends OR (e.closes AND e.p > w.start + 1) THEN NULL ELSE w.start END,
    CASE WHEN w.start IS NOT NULL AND (e.anchor OR e.ends OR (e.closes AND e.p > w.start + 1)) THEN w.start END,
    CASE WHEN e.anchor THEN e.p - 1 ELSE e.p END
  FROM w JOIN e ON e.user_id = w.user_id AND e.p = w.p + 1),
last AS (SELECT user_id, start, p FROM w WHERE (user_id, p) IN (SELECT user_id, max(p) FROM w GROUP BY user_id))
SELECT user_id, done_start AS page_start, done_end AS page_end FROM w WHERE done_start IS NOT NULL
UNION ALL SELECT user_id, start, p FROM last WHERE start IS NOT NULL""")
def span_walk(spark, sf_dir):
    return spans.walk_spans(_event_flags(spark, sf_dir)).select(F.col("gazette_id").alias("user_id"), F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"))


def _order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders by date as one-row tables on consecutive pages."""
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    o = _t(spark, sf_dir, "orders").withColumn("at", at)
    return o.select(
        F.col("o_custkey").alias("gazette_id"), F.lit(0).alias("span_id"), F.lit("n").alias("notification_no"), F.lit(1).alias("page_start"), F.lit(9999).alias("page_end"),
        F.lit("ndz").alias("variant_hint"), (F.col("at") + F.when(F.col("o_orderkey") % 5 == 0, 1000).otherwise(0)).cast("int").alias("page_no"), F.col("at").alias("idx"), F.lit(1).alias("n_rows"),
        F.when(F.col("o_orderstatus") == "P", 3).otherwise(2).alias("n_cols"), F.lit(None).cast("array<string>").alias("header"),
        F.array(F.array(F.concat((F.col("o_orderkey") % 50).cast("string"), F.lit(".")), F.col("o_orderpriority"))).alias("grid"),
        F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit("body"))).alias("text_before"), F.lit(None).cast("array<string>").alias("text_after"),
    )


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus = 'P' AS wide, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos FROM orders),
p AS (SELECT *, pos + CASE WHEN o_orderkey % 5 = 0 THEN 1000 ELSE 0 END AS page FROM o),
t AS (SELECT *, page <> lag(page) OVER w + 1 OR wide <> lag(wide) OVER w OR o_orderkey % 7 = 0 OR o_orderkey % 50 <= lag(o_orderkey % 50) OVER w OR lag(page) OVER w IS NULL AS brk
      FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY page, pos)),
c AS (SELECT *, sum(CAST(brk AS INT)) OVER (PARTITION BY o_custkey ORDER BY page, pos) - 1 AS chain FROM t)
SELECT o_custkey, CAST(chain AS INT) AS table_seq, count(*) AS n_rows, string_agg(CAST(o_orderkey % 50 AS VARCHAR) || '. ' || o_orderpriority, ';' ORDER BY page, pos) AS rows FROM c GROUP BY o_custkey, chain""")
def table_chain(spark, sf_dir):
    out = tables.stitch(_order_tables(spark, sf_dir))
    shown = F.array_join(F.transform("rows", lambda r: F.array_join(r, " ")), ";")
    return out.select(F.col("gazette_id").alias("o_custkey"), "table_seq", F.size("rows").cast("long").alias("n_rows"), shown.alias("rows"))


@query("""
WITH i AS (SELECT conv_id, turn, role, text, sum(CAST(role = 'user' AS INT)) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM conversations),
r AS (SELECT conv_id, island, count(*) AS n, string_agg(text, '#' ORDER BY turn) AS texts FROM i WHERE role <> 'user' AND trim(text) <> '' GROUP BY ALL)
SELECT i.conv_id, i.turn, coalesce(b.texts, '') AS before, coalesce(a.texts, '') AS after
FROM i LEFT JOIN r b ON b.conv_id = i.conv_id AND b.island = i.island - 1 LEFT JOIN r a ON a.conv_id = i.conv_id AND a.island = i.island WHERE i.role = 'user'""")
def neighbour_text(spark, sf_dir):
    items = _t(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("gazette_id"), F.lit(1).alias("page_no"), F.col("turn").alias("pos"), F.when(F.col("role") == "user", "table").otherwise("text").alias("kind"), "text"
    )
    out = tables.neighbour_text(items)
    return out.select(F.col("gazette_id").alias("conv_id"), F.col("pos").alias("turn"), F.array_join("text_before", "#").alias("before"), F.array_join("text_after", "#").alias("after"))


@query("SELECT sha256(text) AS sha256, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def content_dedup(spark, sf_dir):
    keyed = _t(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return keyed.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F') GROUP BY ALL")
def ledger_anti(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("row_hash"), "l_orderkey", "l_linenumber")
    emitted = _t(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("row_hash"))
    return lg.new_hashes(rows, emitted).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(user_id AS VARCHAR) AS sha256, arg_max(event_type, event_id) AS status, arg_max(CASE WHEN event_type = 'purchase' THEN 'd' || CAST(event_id AS VARCHAR) END, event_id) AS artifact_dir,
  arg_max(CAST(floor(value) AS INT), event_id) FILTER (WHERE event_type = 'view' OR event_type = 'click') AS page_count,
  CASE WHEN arg_max(event_type, event_id) = 'error' THEN 'e' || CAST(max(event_id) AS VARCHAR) END AS error_message FROM events GROUP BY user_id""")
def status_latest(spark, sf_dir):
    """Events as a status log: newest status, last known fields, newest error or null."""
    e, kind = _t(spark, sf_dir, "events"), F.col("event_type")
    text = F.col("event_id").cast("string")
    log = e.select(
        F.col("user_id").cast("string").alias("sha256"), F.lit("g").alias("gazette_id"), F.lit("f").alias("source_filename"), kind.alias("status"),
        F.when(kind == "purchase", F.concat(F.lit("d"), text)).alias("artifact_dir"), F.when(kind.isin("view", "click"), F.floor("value").cast("int")).alias("page_count"),
        F.when(kind == "error", F.concat(F.lit("e"), text)).alias("error_message"), F.col("ts").cast("string").alias("at"), F.col("event_id").alias("seq"),
    )
    return lg.latest_status(log).select("sha256", "status", "artifact_dir", "page_count", "error_message")


@query("""
WITH x AS (SELECT CAST(event_id // 4 AS VARCHAR) AS id, event_type, event_id FROM events)
SELECT id, count(*) FILTER (WHERE event_type = 'error') AS attempts, arg_max('e' || CAST(event_id AS VARCHAR), event_id) FILTER (WHERE event_type = 'error') AS last_error
FROM x GROUP BY id HAVING NOT bool_or(event_type = 'signup') AND bool_or(event_type = 'view')""")
def outbox_pending(spark, sf_dir):
    """Events as an outbox log: queued = view, failed = error, done = signup."""
    e = _t(spark, sf_dir, "events")
    event = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("view", "queued", "error", "failed", "signup", "done")]), F.col("event_type")), F.lit("other"))
    log = e.select(F.floor(F.col("event_id") / 4).cast("string").alias("id"), F.lit("rows").alias("kind"), F.lit("{}").alias("payload"), event.alias("event"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("error"), F.col("event_id").alias("seq"))
    return lg.pending(log).where(F.col("kind").isNotNull()).select("id", "attempts", "last_error")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS gazette_id, max(n) AS n_rows, 'Gazette 39A — ' || CAST(max(n) AS VARCHAR) || ' new application(s)' AS subject,
  string_agg('- ' || CAST(o_orderkey AS VARCHAR) || ' | N/A | ' || o_orderstatus || ',  | ' || o_orderpriority, chr(10) ORDER BY k) FILTER (WHERE k <= 20) || CASE WHEN max(n) > 20 THEN chr(10) || '... and ' || CAST(max(n) - 20 AS VARCHAR) || ' more' ELSE '' END AS lines
FROM o GROUP BY o_custkey""")
def digest_topk(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    null = F.lit(None).cast("string")
    rows = o.select(
        F.col("o_custkey").cast("string").alias("gazette_id"), F.col("o_orderkey").cast("string").alias("sr_no"), null.alias("applicant"), F.col("o_orderstatus").alias("village"), null.alias("taluka"),
        F.col("o_orderpriority").alias("decision"), F.col("o_orderkey").alias("row_seq"),
    )
    issues = spark.createDataFrame([], "gazette_id string, notification_no string, reason string, severity string, row struct<notification_no:string,sr_no:string>")
    d = records.digest(rows, issues)
    return d.select("gazette_id", "n_rows", "subject", F.array_join("lines", "\n").alias("lines"))


@query(r"""
WITH n AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'SIII_OG' || CAST(page_id AS VARCHAR) || ' 2026-08-06.pdf' WHEN 1 THEN 'siii-og7 5th Aug 2026' WHEN 2 THEN 'x ' || url ELSE '__' END AS name FROM pages)
SELECT page_id, CASE WHEN page_id % 4 < 2 THEN 'SIII' END AS series, CASE page_id % 4 WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 1 THEN '7' END AS issue_no,
  CASE page_id % 4 WHEN 0 THEN '2026-08-06' WHEN 1 THEN '2026-Aug-5' END AS gazette_date,
  coalesce(nullif(substr(trim(regexp_replace(regexp_replace(name, '[^a-zA-Z0-9._-]+', '_', 'g'), '_+', '_', 'g'), '_'), 1, 80), ''), 'gazette') || '_' || substr(sha256(name), 1, 12) AS gazette_id
FROM n""")
def filename_meta_and_id(spark, sf_dir):
    k = F.col("page_id") % 4
    name = F.when(k == 0, F.concat(F.lit("SIII_OG"), F.col("page_id").cast("string"), F.lit(" 2026-08-06.pdf"))).when(k == 1, "siii-og7 5th Aug 2026").when(k == 2, F.concat(F.lit("x "), F.col("url"))).otherwise("__")
    p = _t(spark, sf_dir, "pages").select("page_id", name.alias("name"))
    return p.select("page_id", sc.filename_meta(F.col("name")).alias("m"), sc.gazette_id(F.col("name"), F.sha2(F.col("name").cast("binary"), 256)).alias("gazette_id")).select("page_id", "m.*", "gazette_id")


@query(r"""
SELECT conv_id, string_agg(rtrim('[Page ' || CAST(turn AS VARCHAR) || E']\n\n' || text, E' \t\n\r\x0b\x0c'), E'\n\n---\n\n' ORDER BY turn) || E'\n' AS markdown FROM conversations GROUP BY conv_id""")
def pages_markdown(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("page_no"), "text")
    return documents.to_markdown(c, "conv_id")


@query()
def rag_chunks(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("pos"), F.col("turn").cast("int").alias("page_no"), F.col("role").alias("heading"), "text")
    return documents.chunk(c, 64, id_col="conv_id")


@query("""SELECT c_mktsegment AS page_id, arg_min(v, ord) AS threshold FROM (
  SELECT c_mktsegment, v, row_number() OVER (PARTITION BY c_mktsegment ORDER BY CASE WHEN w1 = 0 THEN 0 ELSE w0 * w1 * (s0 / w0 - s1 / w1) * (s0 / w0 - s1 / w1) END DESC, v) AS ord
  FROM (SELECT c_mktsegment, v, sum(n) OVER u AS w0, sum(n * v) OVER u AS s0, sum(n) OVER t - sum(n) OVER u AS w1, sum(n * v) OVER t - sum(n * v) OVER u AS s1
        FROM (SELECT c_mktsegment, CAST(abs(c_acctbal) AS BIGINT) % 256 AS v, count(*) AS n FROM customer GROUP BY ALL)
        WINDOW u AS (PARTITION BY c_mktsegment ORDER BY v), t AS (PARTITION BY c_mktsegment))) GROUP BY c_mktsegment""")
def otsu_threshold(spark, sf_dir):
    px = _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("page_id"), (F.rint(F.abs("c_acctbal")).cast("long") % 256).alias("value"))
    return documents.otsu_threshold(px)


_MIXED, _DISPUTED = (t.replace("'", "''") for t in (records.MIXED_SURVEY, records.DISPUTED_SPLIT))


@query(f"""
SELECT CAST(l_orderkey AS VARCHAR) AS gazette_id, l_partkey AS part, CAST(l_linenumber AS VARCHAR) || '.' AS sr_no,
  CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS applicant,
  nullif(concat_ws(' ', CASE WHEN l_linenumber IN (2, 5) THEN '{_MIXED}' END, CASE WHEN l_linestatus = 'F' THEN '{_DISPUTED}' END), '') AS review_reason
FROM lineitem""")
def review_reasons(spark, sf_dir):
    """Application rows of records that the stitching doubts."""
    li = _t(spark, sf_dir, "lineitem")
    own = {"sr_no": F.concat(F.col("l_linenumber").cast("string"), F.lit(".")), "applicant": F.col("l_returnflag")}
    raw = F.struct(*[own.get(f, F.lit(None).cast("string")).alias(f) for f in schemas.FIELDS])
    zero, none = F.lit(0), F.lit(None).cast("string")
    made = li.select(
        F.col("l_orderkey").cast("string").alias("gazette_id"), none.alias("source_filename"), F.col("l_partkey").cast("string").alias("notification_no"), raw.alias("raw"),
        F.when(F.col("l_returnflag") == "A", "ndz").otherwise("change_of_zone").alias("variant"), F.lit(0.9).alias("confidence"), F.array(F.lit(2), F.lit(5)).alias("suspect_sr"),
        (F.col("l_linestatus") == "F").alias("disputed"), zero.alias("page_start"), zero.alias("page_end"), zero.alias("span_id"), zero.alias("table_seq"), F.col("l_linenumber").alias("record_id"),
    )
    return records.application_rows(made).select("gazette_id", F.col("notification_no").cast("long").alias("part"), "sr_no", "applicant", "review_reason")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS sha256, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS created_at FROM orders WHERE o_orderstatus = 'F' ORDER BY created_at DESC, sha256 LIMIT 50""")
def ledger_newest(spark, sf_dir):
    """The 50 newest completed gazettes: the ledger's report."""
    o = _t(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed")
    log = o.select(F.col("o_orderkey").cast("string").alias("sha256"), status.alias("status"), F.col("o_orderdate").cast("date").cast("string").alias("created_at"))
    return lg.newest(log, "completed").select("sha256", "created_at")


@query("SELECT event_type AS stage, count(*) AS count, sum(value) AS total_s, avg(value) AS avg_s FROM events GROUP BY event_type")
def timing_stats(spark, sf_dir):
    return documents.timing_stats(_t(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), F.col("value").alias("seconds")))


@query(r"SELECT page_id, length(html) > 0 AS has_html, html LIKE '%<h1>%' AS heading FROM pages")
def html_markdown(spark, sf_dir):
    m = html.markdown_column(F.col("html"))
    return _t(spark, sf_dir, "pages").select("page_id", "html", m.alias("m")).select("page_id", (F.length("m") > 0).alias("has_html"), F.col("m").rlike(r"(^|\n\n)# ").alias("heading"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM (SELECT DISTINCT event_id, user_id, event_type FROM events) GROUP BY event_type")
def stream_ingest(spark, sf_dir):
    """The event file as a stream, each event emitted once."""
    from pyspark.sql.types import StructType

    source = f"{sf_dir}/events.parquet"
    schema: StructType = spark.read.parquet(source).schema
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="cadastra-stream-")
    run = f"{base.rstrip('/')}/cadastra/stream-{uuid.uuid4().hex}"
    parent, name = os.path.split(source)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(parent if "." in name and _is_file(spark, source) else source)
    named = stream.select("*", F.col("_metadata.file_path").alias("_file")).where(F.col("_file").contains("events.parquet")).drop("_file")
    keyed = named.withColumn("row_hash", F.sha2(F.col("event_id").cast("string").cast("binary"), 256))
    pipeline.stream_new_rows(keyed, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{run}/out").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.count("*").alias("n"))


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def gazettes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A gazette per order, made of its line items: two pages, one table that runs across both."""
    li = _t(spark, sf_dir, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax"]
    # grouped by the gazette's own key, so that the extraction finds its rows dealt out; no struct is null, so sort_array orders them alike
    items = li.groupBy(F.col("l_orderkey").cast("string").alias("gazette_id")).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("items"))
    talukas = F.array(*[F.lit(f"Village, {t.title()}") for t in schemas.TALUKAS], F.lit("Village, Nowhere"))

    def cells(x: Column, i: Column) -> Column:
        whole = x["l_quantity"].cast("int").cast("string")
        return F.array(
            F.concat((i + 1).cast("string"), F.lit(".")), F.concat(F.lit("Applicant "), x["l_suppkey"].cast("string")), F.concat(x["l_partkey"].cast("string"), F.lit("/"), x["l_linenumber"].cast("string"), F.lit(" to 7")),
            F.element_at(talukas, (x["l_suppkey"] % 13 + 1).cast("int")), F.concat(F.lit("Orchard, "), whole), F.lit("Settlement"), whole, F.lit("Recommended"),
        )

    header = F.array(*[F.lit(h) for h in _HEADERS[0][1]])
    grids = items.select("gazette_id", F.explode(F.array(F.transform("items", cells))).alias("rows"))
    parts = F.array(F.slice("rows", 1, 3), F.slice("rows", 4, F.greatest(F.size("rows"), F.lit(1))))
    raw = grids.select("gazette_id", F.posexplode(parts).alias("part", "grid")).where(F.size("grid") > 0).select(
        "gazette_id", F.col("part").alias("idx"), (F.col("part") + 10).alias("page_no"), F.size("grid").alias("n_rows"), F.lit(8).alias("n_cols"),
        F.when(F.col("part") == 0, header).alias("header"), "grid", F.lit(None).cast("array<string>").alias("text_before"), F.lit(None).cast("array<string>").alias("text_after"),
    )
    ids = li.select(F.col("l_orderkey").cast("string").alias("gazette_id")).distinct()
    text = F.when(F.col("page_no") == 10, F.concat(F.lit("Notification No. "), F.col("gazette_id"), F.lit("\nSection 39A change of zone"))).otherwise("| table |")
    pages = ids.select("gazette_id", F.explode(F.array(F.lit(10), F.lit(11))).alias("page_no")).select("gazette_id", "page_no", text.alias("text"))
    meta = ids.select("gazette_id", F.concat(F.col("gazette_id"), F.lit(".pdf")).alias("source_filename"), F.sha2(F.col("gazette_id").cast("binary"), 256).alias("sha256"), F.lit(2).alias("page_count"))
    return meta, pages, raw


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS pos FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS gazette_id, CAST(l_orderkey AS VARCHAR) AS notification_no, CAST(pos AS VARCHAR) || '.' AS sr_no, 'Applicant ' || CAST(l_suppkey AS VARCHAR) AS applicant,
  CAST(l_partkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) || ' to 7' AS survey_raw,
  ['Bardez','Bicholim','Canacona','Dharbandora','Mormugao','Pernem','Ponda','Quepem','Salcete','Sanguem','Sattari','Tiswadi','Nowhere'][l_suppkey % 13 + 1] AS taluka,
  CAST(l_quantity AS BIGINT) AS total_area_sqm, CAST(l_quantity AS BIGINT) AS area_proposed_sqm, 10 AS page_from,
  CASE WHEN max(pos) OVER (PARTITION BY l_orderkey) > 3 THEN 11 ELSE 10 END AS page_to,
  sha256(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(pos AS VARCHAR) || '.|' || CAST(l_partkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) || ' to 7|Recommended') AS row_hash
FROM l""")
def extract_applications(spark, sf_dir):
    """The whole extraction over a gazette per order."""
    rows = extract(*gazettes(spark, sf_dir))["rows"]
    return rows.select("gazette_id", "notification_no", "sr_no", "applicant", "survey_raw", "taluka", "total_area_sqm", "area_proposed_sqm", "page_from", "page_to", "row_hash")


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS pos FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS gazette_id, CAST(pos AS VARCHAR) || '.' AS sr_no, CAST(l_partkey AS VARCHAR) || '/' || CAST(n AS VARCHAR) AS survey_number
FROM (SELECT l_orderkey, pos, l_partkey, l_suppkey, unnest(generate_series(CAST(l_linenumber AS BIGINT), 7)) AS n FROM l WHERE l_suppkey % 13 <> 12)""")
def extract_plots(spark, sf_dir):
    """Plots of the accepted applications of the same gazettes."""
    return extract(*gazettes(spark, sf_dir))["plots"].select("gazette_id", "sr_no", "survey_number")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(*gazettes(spark, sf_dir))["good"].drop("row_seq")
