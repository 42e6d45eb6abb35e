"""Queries for fetch and collate."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.fetch import (
    as_capture, call_once, call_stats, enrich, explode_output, fail_on_error, fetch, infer_schema, land, land_each, land_once,
    parse_output, replay, select_output, split_outcome,
)
from feedloom.operators.requests import build_requests, spread
from feedloom.session import fresh_dir
from feedloom.plans import captures
from feedloom.plans.registry import query
from feedloom.plans.tables import load

USERS_URL = captures.API + "/users/{user_id}"


def purchases_by_segment(spark, d):
    """F9 minimal slice: purchases -> distinct users -> lookup -> join back."""
    events = load(spark, d, "events").where(F.col("event_type") == "purchase")
    caps = captures.user_lookup(load(spark, d, "customer"))

    def lookup(keys):
        req = build_requests(keys, USERS_URL, method="GET", query_type="inline")
        got = parse_output(replay(req, caps), "id bigint, name string, segment string")
        return got.select("user_id", F.col("output.segment").alias("c_mktsegment"))

    enriched = enrich(events, "user_id", lookup, ["c_mktsegment"])
    return (enriched.groupBy("c_mktsegment")
            .agg(F.count(F.lit(1)).alias("n_purchases"),
                 F.round(F.sum("value"), 2).alias("revenue")))


query("enrich_events", """
SELECT c.c_mktsegment, count(*) AS n_purchases, round(sum(e.value), 2) AS revenue
FROM events e JOIN customer c ON e.user_id = c.c_custkey
WHERE e.event_type = 'purchase'
GROUP BY c.c_mktsegment
""")(purchases_by_segment)


def _page_requests(spark, d):
    """Every page url, plus one unknown url per page (never captured)."""
    pages = load(spark, d, "pages").select("page_id", "url")
    known = pages.select("page_id", F.col("url").alias("target"))
    unknown = pages.select("page_id", F.concat(F.col("url"), F.lit("/missing")).alias("target"))
    params = known.unionByName(unknown)
    return build_requests(params, F.col("target"), method="GET", param_columns=[])


def _page_responses(spark, d):
    caps = captures.web_pages(load(spark, d, "pages"))
    return replay(_page_requests(spark, d), caps)


_PAGES_ORACLE = """
SELECT page_id, url, 200 AS status, html AS output, NULL AS _corrupt_record FROM pages
UNION ALL
SELECT page_id, url || '/missing', NULL, NULL, 'not captured' FROM pages
"""


@query("rest_replay", f"SELECT * FROM ({_PAGES_ORACLE})")
def rest_replay(spark, d):
    """F1 replay transport: requests left-joined with landed responses."""
    got = parse_output(_page_responses(spark, d))
    return select_output(got.withColumnRenamed("target", "url"),
                         inputs=["page_id", "url", "status"])


@query("rest_body_only", f"SELECT output, _corrupt_record FROM ({_PAGES_ORACLE})")
def rest_body_only(spark, d):
    """``includeInputsInOutput = false`` keeps the output only."""
    return select_output(parse_output(_page_responses(spark, d)), include_inputs=False)


@query("rest_errors",
       f"SELECT page_id, url, _corrupt_record FROM ({_PAGES_ORACLE}) WHERE _corrupt_record IS NOT NULL")
def rest_errors(spark, d):
    """failed calls are rows with ``_corrupt_record``, not a failed job."""
    _ok, failed = split_outcome(_page_responses(spark, d))
    return failed.select("page_id", F.col("target").alias("url"), "_corrupt_record")


@query("rest_stats", """
SELECT count(*) AS total_calls, count(_corrupt_record) AS failed_calls,
       round((count(*) - count(_corrupt_record)) * 100.0 / count(*), 2) AS success_pct
FROM (""" + _PAGES_ORACLE + ")")
def rest_stats(spark, d):
    """F8: total, failed, success % in one aggregate."""
    return call_stats(_page_responses(spark, d))


@query("split_outcome", """
SELECT CASE WHEN _corrupt_record IS NULL THEN 'ok' ELSE 'failed' END AS outcome,
       count(*) AS n_rows, CAST(sum(length(coalesce(output, ''))) AS BIGINT) AS n_chars
FROM (""" + _PAGES_ORACLE + ") GROUP BY 1")
def split_outcome_query(spark, d):
    """successful rows and failed rows as two branches of one result."""
    responses = parse_output(_page_responses(spark, d)).select("output", "_corrupt_record")
    # both branches read the landed rows, the replay runs once
    ok, failed = split_outcome(land(responses, fresh_dir(spark, "outcome"), partition_by=None))

    def summary(df, name):
        return df.agg(F.lit(name).alias("outcome"), F.count(F.lit(1)).alias("n_rows"),
                      F.sum(F.length(F.coalesce("output", F.lit("")))).alias("n_chars"))
    return summary(ok, "ok").unionByName(summary(failed, "failed"))


@query("rest_once", """
SELECT e.event_id, e.user_id, c.c_name AS name, c.c_mktsegment AS segment
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def rest_once(spark, d):
    """Q10: one call per distinct user, result shared by all of its events."""
    events = load(spark, d, "events").select("event_id", "user_id")
    caps = captures.user_lookup(load(spark, d, "customer"))

    def call(distinct):
        req = build_requests(distinct, USERS_URL, method="GET", query_type="inline")
        got = parse_output(replay(req, caps), "name string, segment string")
        return got.select("user_id", F.col("output.name").alias("name"),
                          F.col("output.segment").alias("segment"))

    return call_once(events, ["user_id"], call, ["name", "segment"])


def _captured(spark, d, table, key, path, body):
    """(requests' responses) of GET ``path/{key}`` over a table's rows."""
    rows = load(spark, d, table)
    caps = rows.select(F.lit(table).alias("feed"), F.concat(F.lit(f"{captures.API}/{path}/"), key).alias("key"),
                       F.lit(200).alias("status"), body.alias("body"),
                       F.lit(None).cast("string").alias("error"),
                       F.lit(None).cast("timestamp").alias("fetched_at"))
    req = build_requests(rows.select(key), f"{captures.API}/{path}/{{{key}}}", method="GET", query_type="inline")
    return replay(req, caps)


@query("rest_infer", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def rest_infer(spark, d):
    """response schema inferred from all bodies, then applied."""
    got = _captured(spark, d, "events", "event_id", "events", F.col("props"))
    return parse_output(got, infer_schema(got)).select("event_id", "output.*")


@query("rest_infer_rare", """
SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 0 THEN o_orderpriority END AS rare,
       CAST('12345678901234567890' AS DECIMAL(20, 0)) AS large,
       CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS customer
FROM orders
""")
def rest_infer_rare(spark, d):
    """a field few bodies have, a nested field and a 20-digit integer all survive."""
    body = F.concat(
        F.lit('{"large": 12345678901234567890'),
        F.when(F.col("o_orderkey") % 997 == 0, F.concat(F.lit(', "rare": "'), "o_orderpriority", F.lit('"'))).otherwise(""),
        F.when(F.col("o_orderkey") % 2 == 0,
               F.concat(F.lit(', "who": {"customer": '), F.col("o_custkey"), F.lit("}"))).otherwise(""), F.lit("}"))
    got = _captured(spark, d, "orders", "o_orderkey", "orders", body)
    return parse_output(got, infer_schema(got)).select(
        "o_orderkey", "output.rare", "output.large", F.col("output.who.customer").alias("customer"))


@query("rest_parse_errors", """
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS name,
       CASE WHEN c_custkey % 3 = 0 THEN 'response is not JSON: <p>' || c_name END AS _corrupt_record
FROM customer
""")
def rest_parse_errors(spark, d):
    """a body that is not JSON is an error that keeps its text."""
    body = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("<p>"), "c_name")).otherwise(
        F.to_json(F.struct(F.col("c_name").alias("name"))))
    got = parse_output(_captured(spark, d, "customer", "c_custkey", "customers", body), "name string")
    return got.select("c_custkey", F.col("output.name").alias("name"), "_corrupt_record")


@query("rest_array_body", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def rest_array_body(spark, d):
    """a response may be one object or an array of objects."""
    orders = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    item = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    lists = captures.chunked_lists(orders, ["o_custkey"], "o_orderkey", item)
    # a one-element list is answered as a bare object
    body = F.when(F.size(F.split("body", "},")) == 1,
                  F.regexp_replace(F.regexp_replace("body", r"^\[", ""), r"\]$", "")) \
        .otherwise(F.col("body"))
    caps = lists.select(F.lit("orders").alias("feed"),
                        F.format_string(captures.API + "/customers/%d/orders?chunk=%d",
                                        "o_custkey", "_chunk").alias("key"),
                        F.lit(200).alias("status"), body.alias("body"),
                        F.lit(None).cast("string").alias("error"),
                        F.lit(None).cast("timestamp").alias("fetched_at"))
    params = orders.select("o_custkey", F.expr("o_orderkey div 64").alias("chunk")).distinct()
    req = build_requests(params, captures.API + "/customers/{o_custkey}/orders?chunk={chunk}",
                         method="GET", query_type="inline")
    got = explode_output(replay(req, caps), "o_orderkey bigint, o_totalprice double")
    return got.select("o_custkey", "output.o_orderkey", "output.o_totalprice")


@query("valid_filter", "SELECT c_custkey, c_name AS name FROM customer WHERE c_acctbal > 0")
def valid_filter(spark, d):
    """filter on a nested response field (``output.is_valid``)."""
    cust = load(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    caps = captures.user_lookup(load(spark, d, "customer"))
    req = build_requests(cust, USERS_URL, method="GET", query_type="inline")
    got = parse_output(replay(req, caps), "name string, is_valid boolean")
    return got.where(F.col("output.is_valid")).select(
        F.col("user_id").alias("c_custkey"), F.col("output.name").alias("name"))


@query("score_texts", """
SELECT d.doc_id, CAST(length(d.text) AS INTEGER) AS body_chars, l.quality, l.toxic,
       CASE WHEN l.doc_id IS NULL THEN 'not captured' END AS _corrupt_record
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def score_texts(spark, d):
    """POST each document's whole text, one score object back."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    caps = captures.scores(load(spark, d, "labels"))
    req = build_requests(docs, captures.API + "/score", method="POST")
    got = parse_output(replay(req, caps, on="doc_id"), "quality int, toxic int")
    return got.select("doc_id",
                      F.length(F.get_json_object("req_body", "$.text")).alias("body_chars"),
                      F.col("output.quality").alias("quality"), F.col("output.toxic").alias("toxic"),
                      "_corrupt_record")


def echo_transport(method, url, body, headers):
    """Fixture service: answers every call with the url it was asked for."""
    import json

    return 200, json.dumps({"url": url, "chars": len(url)}), None


_ORDER_URL_SQL = """
SELECT o_orderkey,
       CAST(length('https://api.example.com/orders?o_orderkey=' || o_orderkey || '&o_orderpriority='
              || replace(url_encode(o_orderpriority), '%20', '+')) AS INTEGER) AS chars
FROM orders
"""


@query("rest_fetch_land", _ORDER_URL_SQL)
def rest_fetch_land(spark, d):
    """F1 + F11: live call stage (Arrow batches), landed once, then replayed."""
    params = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    req = build_requests(params, captures.API + "/orders", method="GET")
    got = fetch(req, echo_transport)
    landed = land(as_capture(got, "orders", key="req_url"), fresh_dir(spark, "captures"))
    out = parse_output(replay(req, landed, feed="orders"), "chars int")
    return out.select("o_orderkey", F.col("output.chars").alias("chars"))


@query("rest_spread", _ORDER_URL_SQL)
def rest_spread(spark, d):
    """Q9: requests spread round-robin over a chosen number of tasks."""
    params = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    req = spread(build_requests(params, captures.API + "/orders", method="GET"), 16)
    return req.select("o_orderkey", F.length("req_url").alias("chars"))


def body_transport(method, url, body, headers):
    """Fixture service: answers with the method and the body it was sent."""
    import json

    return 200, json.dumps({"method": method, "sent": body}), None


def _landed_writes(spark, d, method, post_format):
    params = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    req = build_requests(params, captures.API + "/orders", method=method, post_input_format=post_format)
    landed = land_once(fetch(req, body_transport), "orders", fresh_dir(spark, "captures"))
    return parse_output(replay(req, landed, feed="orders", latest=False), "method string, sent string")


@query("rest_post_land", """
SELECT o_orderkey, 'POST' AS method, o_orderkey AS sent_key, o_orderpriority AS sent_priority FROM orders
""")
def rest_post_land(spark, d):
    """POST replies are matched by method, url and body, each row its own."""
    out = _landed_writes(spark, d, "POST", "json")
    sent = F.from_json("output.sent", "o_orderkey bigint, o_orderpriority string")
    return out.select("o_orderkey", "output.method", sent["o_orderkey"].alias("sent_key"),
                      sent["o_orderpriority"].alias("sent_priority"))


@query("rest_put_land", """
SELECT o_orderkey, 'PUT' AS method,
       'o_orderkey=' || o_orderkey || '&o_orderpriority=' || replace(url_encode(o_orderpriority), '%20', '+') AS sent
FROM orders
""")
def rest_put_land(spark, d):
    """the same for PUT with a form body."""
    return _landed_writes(spark, d, "PUT", "form").select("o_orderkey", "output.method", "output.sent")


def accept_transport(method, url, body, headers):
    """Fixture service: answers in the form that the request's headers ask for."""
    import json

    return 200, json.dumps({"form": (headers or {}).get("Accept"), "url": url}), None


@query("rest_headers_land", """
SELECT c_custkey, f.form, 'text/' || f.form AS got FROM customer, (VALUES ('csv'), ('xml')) f(form)
""")
def rest_headers_land(spark, d):
    """requests that differ in headers only keep their own replies."""
    params = load(spark, d, "customer").select("c_custkey")
    parts = []
    for form in ("csv", "xml"):
        req = build_requests(params, captures.API + "/customers/{c_custkey}", method="GET", query_type="inline",
                             headers='{"Accept": "text/%s"}' % form)
        parts.append(req.withColumn("form", F.lit(form)))
    req = parts[0].unionByName(parts[1])
    landed = land_once(fetch(req, accept_transport), "customers", fresh_dir(spark, "captures"))
    out = parse_output(replay(req, landed, latest=False), "form string")
    return out.select("c_custkey", "form", F.col("output.form").alias("got"))


def creating_transport(method, url, body, headers):
    """Fixture service: every call creates something with an id of its own."""
    import json
    import uuid

    return 201, json.dumps({"id": uuid.uuid4().hex}), None


@query("rest_repeat_land", """
SELECT o_orderpriority, 'whole rows' AS landed, count(*) AS calls, count(*) AS created FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT o_orderpriority, 'captures', count(*), count(*) FROM orders GROUP BY o_orderpriority
""")
def rest_repeat_land(spark, d):
    """of n equal calls each keeps its own reply, landed with its row or
    as a capture that is replayed."""
    from feedloom import api

    params = load(spark, d, "orders").select("o_orderpriority")
    whole = api.read(spark, "rest", input=params, url=captures.API + "/orders", method="POST",
                     transport=creating_transport, land_to=fresh_dir(spark, "calls"), schema="id string")
    req = build_requests(params, captures.API + "/orders", method="POST")
    landed = land_each(fetch(req, creating_transport), "orders", fresh_dir(spark, "captures"))
    again = parse_output(replay(req, landed, latest=False), "id string")

    def summary(out, name):
        return out.groupBy("o_orderpriority").agg(F.lit(name).alias("landed"), F.count(F.lit(1)).alias("calls"),
                                                  F.countDistinct("output.id").alias("created"))
    return summary(whole, "whole rows").unionByName(summary(again, "captures"))


@query("rest_misfits", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal END AS balance,
       CASE c_custkey % 4 WHEN 1 THEN 'response does not fit the schema: [' || c_custkey || ']'
            WHEN 2 THEN 'response does not fit the schema: {"balance":"none"}'
            WHEN 3 THEN 'response does not fit the schema: {"tags":[1,{"x":' || c_custkey || '}]}' END AS _corrupt_record
FROM customer
""")
def rest_misfits(spark, d):
    """a body whose values are of another type than the schema's is an error."""
    kind = F.col("c_custkey") % 4
    body = (F.when(kind == 1, F.format_string("[%d]", "c_custkey")).when(kind == 2, F.lit('{"balance":"none"}'))
            .when(kind == 3, F.format_string('{"tags":[1,{"x":%d}]}', "c_custkey"))
            .otherwise(F.to_json(F.struct(F.col("c_acctbal").alias("balance")))))
    got = parse_output(_captured(spark, d, "customer", "c_custkey", "customers", body), "balance double, tags array<int>")
    return got.select("c_custkey", F.col("output.balance").alias("balance"), "_corrupt_record")


@query("rest_fail_fast", f"""
SELECT 'off' AS fail_on_error, count(*) AS n_rows, NULL AS error FROM ({_PAGES_ORACLE})
UNION ALL SELECT 'on, no failure', count(*), NULL FROM ({_PAGES_ORACLE}) WHERE _corrupt_record IS NULL
UNION ALL SELECT 'on', NULL, 'request failed: not captured'
""")
def rest_fail_fast(spark, d):
    """with failOnError the first failed request stops the job."""
    got = _page_responses(spark, d)
    counted = lambda df, name: df.agg(F.lit(name).alias("fail_on_error"), F.count(F.lit(1)).alias("n_rows"),
                                      F.lit(None).cast("string").alias("error"))
    try:
        fail_on_error(got).write.format("noop").mode("overwrite").save()
        text = None
    except Exception as e:
        text = "request failed: not captured" if "request failed: not captured" in str(e) else str(e)
    stopped = spark.createDataFrame([("on", None, text)], "fail_on_error string, n_rows long, error string")
    return (counted(fail_on_error(got, False), "off")
            .unionByName(counted(fail_on_error(got.where("_corrupt_record is null")), "on, no failure")).unionByName(stopped))
