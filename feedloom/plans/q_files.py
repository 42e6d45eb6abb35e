"""Queries for file sources and file sinks: sheets, hub splits, dataset
files, Arrow files / datasets, synthetic rows, JSON-array files.

Landing steps write into a new folder under ``spark.checkpoint.dir`` (the
cluster's shared folder) on every run."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.plans import captures as C
from feedloom.plans.landing import land_text
from feedloom.plans.registry import ORACLES, query
from feedloom.plans.tables import load
from feedloom.session import fresh_dir
from feedloom.sinks import json_array
from feedloom.sources import arrow, datasets, fake, hub, sheets

# -------------------------------------------------------------------- sheets


@query("sheets_strings", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS "Unnamed: 2",
       lower(n_name) AS "n_name.1"
FROM nation
""")
def sheets_strings(spark, d):
    """Header row names the (string) columns: blank -> Unnamed: i, repeat -> .1."""
    nation = load(spark, d, "nation")
    lines = C.sheet_lines(nation, "n_nationkey,n_name,,n_name",
                          [F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey"),
                           F.lower("n_name")], F.col("n_nationkey") + 1)
    return sheets.sheet_from_lines(lines)


_SUPPLIER_TYPED = """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier
"""


def _supplier_lines(spark, d, header):
    s = load(spark, d, "supplier")
    return C.sheet_lines(s, header, [F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey"),
                                     F.col("s_acctbal")], F.col("s_suppkey") + 1)


@query("sheets_typed", _SUPPLIER_TYPED)
def sheets_typed(spark, d):
    """User schema renames columns by position and casts; header skipped."""
    lines = _supplier_lines(spark, d, "s_suppkey,s_name,s_nationkey,s_acctbal")
    return sheets.sheet_from_lines(lines, schema="id bigint, name string, nation int, balance double",
                                   header_n=0)


@query("sheets_quoted", """
SELECT c_custkey AS id, c_name || chr(10) || '"' || c_mktsegment || '", ' || c_nationkey AS note FROM customer
""")
def sheets_quoted(spark, d):
    """Cells with quotes, commas and line breaks stay one cell."""
    cust = load(spark, d, "customer")
    note = F.concat("c_name", F.lit('\n""'), "c_mktsegment", F.lit('"", '), "c_nationkey")
    # CSV texts of at most 64 keys of a nation each, as sheets' exports
    body = cust.groupBy("c_nationkey", F.expr("c_custkey div 64")).agg(F.concat(F.lit("id,note\r\n"), F.array_join(F.collect_list(
        F.concat("c_custkey", F.lit(',"'), note, F.lit('"'))), "\r\n")).alias("body"))
    lines = body.select(F.posexplode(sheets.record_lines(F.col("body"))).alias("n", "line"))
    # every body has the header as its first record
    rows = lines.where("n > 0").select("line", "n").unionByName(lines.where("n = 0").limit(1))
    return sheets.sheet_from_lines(rows, schema="id bigint, note string", header_n=0)


@query("sheets_bare_quotes", """
SELECT p_partkey AS id, (p_partkey % 9) || '" ' || p_name AS label, '"' || p_brand || '" of' || chr(13) || chr(10) || p_type AS note
FROM part
""")
def sheets_bare_quotes(spark, d):
    """A quote inside an unquoted cell is an ordinary character; a quoted cell
    keeps its quotes and line breaks as they are."""
    part = load(spark, d, "part")
    line = F.concat("p_partkey", F.lit(","), F.col("p_partkey") % 9, F.lit('" '), "p_name", F.lit(',"""'), "p_brand",
                    F.lit('"" of\r\n'), "p_type", F.lit('"\r'))
    path = fresh_dir(spark, "sheets")
    part.select(line).write.text(path)  # each row's records as they stand, ended by \r\n
    return sheets.read_sheet(spark, path, has_header=False, schema="id bigint, label string, note string")


@query("sheets_header_break", """
SELECT s_suppkey AS "sup
key", s_name AS name FROM supplier
""")
def sheets_header_break(spark, d):
    """A header cell may hold a line break, in every file."""
    path = fresh_dir(spark, "sheets")
    rows = load(spark, d, "supplier").select(F.concat("s_suppkey", F.lit(","), "s_name").alias("l"), F.col("s_suppkey") % 3)
    for i in range(3):
        head = spark.createDataFrame([('"sup',), ('key",name',)], "l string").coalesce(1)
        head.unionByName(rows.where(rows[1] == i).select("l")).coalesce(1).write.text(f"{path}/{i}")
    return sheets.read_sheet(spark, f"{path}/*").selectExpr("cast(`sup\nkey` as bigint) AS `sup\nkey`", "name")


@query("sheets_csv_split", """
SELECT l_orderkey AS id, l_linenumber AS line, 'says "' || l_linestatus || '",' || chr(10) || chr(10) || l_returnflag AS note FROM lineitem
""")
def sheets_csv_split(spark, d):
    """One CSV file of all line items, with line breaks in quoted cells: as many
    tasks read it as Spark cuts splits."""
    path = fresh_dir(spark, "sheets")
    rows = load(spark, d, "lineitem").select(F.concat(
        "l_orderkey", F.lit(","), "l_linenumber", F.lit(',"says ""'), "l_linestatus", F.lit('"",\n\n'), "l_returnflag", F.lit('"')).alias("l"))
    land_text(rows, path)
    return sheets.read_sheet(spark, path, has_header=False, schema="id bigint, line int, note string")


@query("sheets_no_header", """
SELECT s_suppkey AS a, s_name AS b, s_nationkey AS c, s_acctbal AS d FROM supplier
""")
def sheets_no_header(spark, d):
    """A sheet without a header row, read with a user schema."""
    lines = _supplier_lines(spark, d, None)
    return sheets.sheet_from_lines(lines, has_header=False, schema="a bigint, b string, c int, d double")


@query("sheets_csv_files", _SUPPLIER_TYPED)
def sheets_csv_files(spark, d):
    """Landed CSV exports (several files, each with a header), distributed scan."""
    path = fresh_dir(spark, "sheets")
    load(spark, d, "supplier").write.option("header", True).option("escape", "\"").csv(path)
    return sheets.read_sheet(spark, path, schema="id bigint, name string, nation int, balance double")


@query("sheets_locator", """
WITH u AS (
  SELECT 'https://docs.google.com/spreadsheets/d/' || md5(url) || '/edit' ||
         CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '?gid=' || page_id
              ELSE '?usp=sharing&gid=' || page_id || '#gid=9' END AS url,
         md5(url) AS sid, CASE WHEN page_id % 3 = 0 THEN NULL ELSE CAST(page_id AS VARCHAR) END AS gid
  FROM pages)
SELECT url, sid AS spreadsheet_id, gid AS sheet_id,
       'https://docs.google.com/spreadsheets/d/' || sid || '/gviz/tq?tqx=out%3Acsv'
       || coalesce('&gid=' || gid, '') || '&tq=select+%2A' AS export_url, NULL AS error
FROM u
UNION ALL
SELECT url, NULL, NULL, NULL, 'URL is not a Google Sheets URL' FROM pages
""")
def sheets_locator(spark, d):
    """Sheet urls -> (spreadsheet id, gid, export url); other hosts rejected."""
    urls = C.sheet_urls(load(spark, d, "pages"))
    loc = urls.select("url", sheets.locate(F.col("url")).alias("l"))
    exp = sheets.export_url(F.col("l.spreadsheet_id"), F.col("l.sheet_id"), F.lit("select *"))
    return loc.select("url", "l.spreadsheet_id", "l.sheet_id",
                      F.when(F.col("l.error").isNull(), exp).alias("export_url"), "l.error")


# -------------------------------------------------------------------- hub
def _land_hub(spark, d):
    root = fresh_dir(spark, "hub")
    docs = load(spark, d, "documents").select("doc_id", "text", "lang")
    labels = load(spark, d, "labels")
    docs.join(labels, "doc_id").write.parquet(hub.split_path(root, "docs-set", "train"))
    docs.join(labels, "doc_id", "left_anti").write.parquet(hub.split_path(root, "docs-set", "test"))
    return root


@query("hub_split", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CAST(quality AS VARCHAR) AS quality
FROM documents JOIN labels USING (doc_id)
""")
def hub_split(spark, d):
    """A dataset split, requested columns projected, values as strings."""
    root = _land_hub(spark, d)
    return hub.read_split(spark, root, "docs-set", "train", columns=["doc_id", "text", "quality"])


@query("hub_missing_column", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CAST(NULL AS VARCHAR) AS quality
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def hub_missing_column(spark, d):
    """A requested column the split does not have is null."""
    root = _land_hub(spark, d)
    return hub.read_split(spark, root, "docs-set", "test", columns=["doc_id", "lang", "quality"])


@query("hub_mixed_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN c_nationkey < 12 THEN c_name END AS c_name,
       CASE WHEN c_nationkey >= 12 THEN CAST(c_acctbal AS VARCHAR) END AS c_acctbal
FROM customer
""")
def hub_mixed_schema(spark, d):
    """Files of one split that differ in their columns: all columns count."""
    root = fresh_dir(spark, "hub")
    cust = load(spark, d, "customer")
    path = hub.split_path(root, "customers", "train")
    cust.where("c_nationkey < 12").select("c_custkey", "c_name").write.parquet(path)
    cust.where("c_nationkey >= 12").select("c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal")) \
        .write.mode("append").parquet(path)
    return hub.read_split(spark, root, "customers", columns=["c_custkey", "c_name", "c_acctbal"])


# ------------------------------------------------------------ dataset files
_SUPPLIER_WIDE = """
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier
"""


@query("kaggle_csv", _SUPPLIER_WIDE)
def kaggle_csv(spark, d):
    """Handle + file -> typed table (CSV types inferred, widened to long/double)."""
    root = fresh_dir(spark, "datasets")
    load(spark, d, "supplier").write.option("header", True).option("escape", "\"").csv(
        datasets.resolve(root, "acme/suppliers/versions/2") + "/suppliers.csv")
    return datasets.read_file(spark, root, "acme/suppliers/versions/2", "suppliers.csv")


@query("kaggle_glob", _SUPPLIER_WIDE)
def kaggle_glob(spark, d):
    """Several files matched by a pattern read as one table."""
    root = fresh_dir(spark, "datasets")
    folder = datasets.resolve(root, "acme/suppliers")
    s = load(spark, d, "supplier")
    for name, part in (("low", s.where(F.col("s_nationkey") < 12)),
                       ("high", s.where(F.col("s_nationkey") >= 12))):
        part.write.option("header", True).option("escape", "\"").csv(f"{folder}/suppliers_{name}.csv")
    return datasets.read_file(spark, root, "acme/suppliers", "suppliers_*.csv")


# -------------------------------------------------------------------- arrow
@query("arrow_scan", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem
""")
def arrow_scan(spark, d):
    """Arrow fragments written by tasks, read back split by record batches."""
    path = fresh_dir(spark, "arrow")
    arrow.append_arrow(load(spark, d, "lineitem"), path)
    return arrow.read_arrow(spark, path)


@query("arrow_filter_group", """
SELECT p_brand, count(*) AS n_parts FROM part WHERE p_size > 25 GROUP BY p_brand
""")
def arrow_filter_group(spark, d):
    """Filter before a group-count over an Arrow scan."""
    path = fresh_dir(spark, "arrow")
    arrow.append_arrow(load(spark, d, "part"), path)
    parts = arrow.read_arrow(spark, path, ["p_brand", "p_size"])
    return parts.where(F.col("p_size") > 25).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"))


@query("arrow_glob", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')")
def arrow_glob(spark, d):
    """A glob reads the folders it names, none below them, and two columns only."""
    root = fresh_dir(spark, "arrow")
    orders = load(spark, d, "orders")
    for folder, part in (("set_f", "F"), ("set_o", "O"), ("set_o/below", "P"), ("other", "P")):
        arrow.append_arrow(orders.where(F.col("o_orderstatus") == part), f"{root}/{folder}")
    return arrow.read_arrow(spark, f"{root}/set_?/*.arrow", ["o_orderkey", "o_totalprice"])


@query("arrow_pruned", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey BETWEEN 300 AND 700 AND o_orderstatus IN ('F', 'O') AND o_totalprice > 1000
""")
def arrow_pruned(spark, d):
    """Conditions skip record batches by their zone maps."""
    path = fresh_dir(spark, "arrow")
    arrow.append_arrow(load(spark, d, "orders").repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey"), path)
    return arrow.read_arrow(spark, path, ["o_orderkey", "o_totalprice", "o_orderstatus"], where=[
        ("o_orderkey", ">=", 300), ("o_orderkey", "<=", 700), ("o_orderstatus", "in", ["F", "O"]),
        ("o_totalprice", ">", 1000.0)]).select("o_orderkey", "o_totalprice")


@query("arrow_mixed", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
""")
def arrow_mixed(spark, d):
    """A file without one of the columns: read as null because it is asked for."""
    path = fresh_dir(spark, "arrow")
    cust = load(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    arrow.append_arrow(cust, f"{path}/a")
    arrow.append_arrow(load(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name"), f"{path}/b")
    return arrow.read_arrow(spark, f"{path}/*/*.arrow", missing="null")


@query("arrow_append", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def arrow_append(spark, d):
    """Two appends to one dataset: both sets of fragments are read back."""
    path = fresh_dir(spark, "arrow")
    cust = load(spark, d, "customer")
    arrow.append_arrow(cust, path)
    arrow.append_arrow(cust, path)
    return arrow.read_arrow(spark, path)


# ---------------------------------------------------------- synthetic rows
def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _sql_pick(words, a, b, col="o_orderkey"):
    return f"list_element({_sql_list(words)}, CAST((({col} * {a} + {b}) % {len(words)}) + 1 AS INTEGER))"


@query("fake_batch", f"""
SELECT o_orderkey,
       {_sql_pick(fake.FIRST_NAMES, 7, 1)} || ' ' || {_sql_pick(fake.LAST_NAMES, 13, 5)} AS name,
       strftime(DATE '1970-01-01' + CAST((o_orderkey * 37 + 11) % 20000 AS INTEGER), '%Y-%m-%d') AS date,
       lpad(CAST((o_orderkey * 7919 + 3) % 100000 AS VARCHAR), 5, '0') AS zipcode,
       {_sql_pick(fake.STATES, 17, 2)} AS state
FROM orders
""")
def fake_batch(spark, d):
    """Generated name / date / zipcode / state, one row per order key."""
    return fake.with_fake(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")


# ---------------------------------------------------------------- JSON sink
@query("json_sink", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, o_orderpriority FROM orders
""")
def json_sink(spark, d):
    """Per-task JSON-array files (dates as ISO text), read back."""
    path = fresh_dir(spark, "json")
    json_array.write_json_array(load(spark, d, "orders"), path)
    return json_array.read_json_array(
        spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                     "o_orderdate string, o_orderpriority string")


@query("json_sink_overwrite", "SELECT * FROM customer")
def json_sink_overwrite(spark, d):
    """Overwrite removes the files of earlier writes after the new ones commit."""
    path = fresh_dir(spark, "json")
    json_array.write_json_array(load(spark, d, "nation"), path)
    json_array.write_json_array(load(spark, d, "customer"), path, mode="overwrite")
    return json_array.read_json_array(
        spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                     "c_mktsegment string")


@query("fake_stream", ORACLES["fake_batch"])
def fake_stream(spark, d):
    """Generated columns over a stream of landed order keys (availableNow)."""
    from feedloom.streaming.sources import run_available

    root = fresh_dir(spark, "fake-stream")
    keys = load(spark, d, "orders").select("o_orderkey")
    keys.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(keys.schema).parquet(f"{root}/in")
    run_available(fake.with_fake(stream, "o_orderkey"), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@query("fake_stream_rows", "SELECT * EXCLUDE (o_orderkey) FROM (" + ORACLES["fake_batch"].replace(
    "FROM orders", "FROM (SELECT row_number() OVER () - 1 AS o_orderkey FROM orders)") + ")")
def fake_stream_rows(spark, d):
    """A stream of as many generated rows as there are orders, counted from 0."""
    from feedloom.streaming.sources import fake_stream as generated
    from feedloom.streaming.sources import run_available

    root = fresh_dir(spark, "fake-rows")
    run_available(generated(spark, load(spark, d, "orders").count()), f"{root}/out", f"{root}/ckpt")
    return spark.read.parquet(f"{root}/out")


@query("json_sink_abort", "SELECT c_custkey, c_name FROM customer")
def json_sink_abort(spark, d):
    """A write that fails leaves what was there, and none of its own files."""
    path = fresh_dir(spark, "json-abort")
    cust = load(spark, d, "customer").select("c_custkey", "c_name")
    json_array.write_json_array(cust, path)
    broken = cust.withColumn("c_name", F.when(F.col("c_custkey") == 7, F.raise_error(F.lit("broken row"))).otherwise("x"))
    for mode in ("append", "overwrite"):
        try:
            json_array.write_json_array(broken, path, mode)
        except Exception as e:  # the row's own error, whatever wraps it
            if "broken row" not in str(e):
                raise
    return json_array.read_json_array(spark, path, "c_custkey bigint, c_name string")
