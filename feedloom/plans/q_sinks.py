"""Queries for record delivery to a CRM.

The remote service is played by plain functions (no network): a tree
endpoint that rejects records with a negative revenue, a batch endpoint
that fails for some payloads, and a single-record endpoint."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from feedloom.plans.registry import query
from feedloom.plans.tables import load
from feedloom.session import fresh_dir
from feedloom.sinks import crm

ACCOUNT = ("Name STRING, Industry STRING, AnnualRevenue DOUBLE, NumberOfEmployees INT, "
           "BillingCountry STRING, SignupDate DATE")
NEGATIVE = "AnnualRevenue must not be negative"


def tree_endpoint(object_type: str, payload: str) -> str:
    """Composite-tree double: one result per record, errors for negatives."""
    recs = json.loads(payload)["records"]
    results, errors = [], False
    for r in recs:
        ref = r["attributes"]["referenceId"]
        if r.get("AnnualRevenue", 0) < 0:
            errors = True
            results.append({"referenceId": ref, "errors": [
                {"statusCode": "FIELD_INTEGRITY_EXCEPTION", "message": NEGATIVE}]})
        else:
            results.append({"referenceId": ref, "id": f"001{abs(hash(r['Name'])) % 10**12:012d}"})
    return json.dumps({"hasErrors": errors, "results": results})


def flaky_tree_endpoint(object_type: str, payload: str) -> str:
    """Fails the whole call when a payload holds a MACHINERY account."""
    if '"Industry":"MACHINERY"' in payload:
        raise ConnectionError("batch call failed")
    return tree_endpoint(object_type, payload)


def single_endpoint(object_type: str, record: str) -> str:
    r = json.loads(record)
    if r.get("AnnualRevenue", 0) < 0:
        return json.dumps({"success": False, "errors": [{"message": NEGATIVE}]})
    return json.dumps({"success": True, "id": "001x"})


def _accounts(spark, d):
    c = load(spark, d, "customer").join(load(spark, d, "nation"),
                                        F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        "c_custkey",
        F.col("c_name").alias("Name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("Industry"),
        F.col("c_acctbal").alias("AnnualRevenue"),
        F.col("c_nationkey").alias("NumberOfEmployees"),
        F.col("n_name").alias("BillingCountry"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_custkey").cast("int")).alias("SignupDate"))


def _records(spark, d):
    return crm.records(_accounts(spark, d), key="c_custkey", schema=ACCOUNT)


@query("crm_records", """
SELECT c_custkey AS key, c_name AS Name,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS Industry,
       c_acctbal AS AnnualRevenue, c_nationkey AS NumberOfEmployees, n_name AS BillingCountry,
       strftime(DATE '2020-01-01' + CAST(c_custkey AS INTEGER), '%Y-%m-%d') AS SignupDate,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 5 ELSE 6 END AS n_fields
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def crm_records(spark, d):
    """Rows -> records: nulls left out, dates as ISO text, numbers kept."""
    recs = _records(spark, d)
    parsed = F.from_json("record", "map<string,string>")
    return recs.select(
        F.col("key").cast("bigint").alias("key"),
        parsed["Name"].alias("Name"), parsed["Industry"].alias("Industry"),
        parsed["AnnualRevenue"].cast("double").alias("AnnualRevenue"),
        parsed["NumberOfEmployees"].cast("int").alias("NumberOfEmployees"),
        parsed["BillingCountry"].alias("BillingCountry"), parsed["SignupDate"].alias("SignupDate"),
        F.size(parsed).alias("n_fields"))


@query("crm_batches", """
SELECT count(*) AS total_records, count(*) AS payload_records, count(*) AS keyed_records,
       true AS within_limit
FROM customer
""")
def crm_batches(spark, d):
    """Payloads of at most 200 records, cut per partition without a shuffle."""
    b = crm.batches(_records(spark, d))
    n_in_payload = F.size(F.from_json("payload", "records array<string>")["records"])
    return b.agg(F.sum("n_records").alias("total_records"),
                 F.sum(n_in_payload).alias("payload_records"),
                 F.sum(F.size("keys")).alias("keyed_records"),
                 (F.max("n_records") <= crm.BATCH_SIZE).alias("within_limit"))


@query("crm_results", """
SELECT count(*) FILTER (WHERE c_acctbal >= 0) AS records_ok,
       count(*) FILTER (WHERE c_acctbal < 0) AS records_failed
FROM customer
""")
def crm_results(spark, d):
    """Reply accounting: whole batch when no errors, else results with an id."""
    sent = crm.deliver(crm.batches(_records(spark, d)), tree_endpoint)
    acc = crm.accounting(sent)
    return acc.agg(F.sum("n_ok").alias("records_ok"),
                   (F.sum("n_records") - F.sum("n_ok")).alias("records_failed"))


@query("crm_failures", f"""
SELECT '{NEGATIVE}' AS message, count(*) AS n FROM customer WHERE c_acctbal < 0
""")
def crm_failures(spark, d):
    """Failed record results exploded with their messages."""
    sent = crm.deliver(crm.batches(_records(spark, d)), tree_endpoint)
    return crm.failures(sent).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query("crm_fallback", """
SELECT count(*) FILTER (WHERE c_acctbal >= 0) AS created,
       count(*) FILTER (WHERE c_acctbal < 0) AS failed
FROM customer
""")
def crm_fallback(spark, d):
    """Failed batch calls fall back to one call per record."""
    sent = crm.deliver_landed(crm.batches(_records(spark, d)), flaky_tree_endpoint,
                              fresh_dir(spark, "crm-replies"))
    by_batch = crm.accounting(sent).where(F.col("error").isNull()) \
        .agg(F.coalesce(F.sum("n_ok"), F.lit(0)).alias("ok"),
             F.coalesce(F.sum(F.col("n_records") - F.col("n_ok")), F.lit(0)).alias("bad"))
    single = crm.fallback(sent, single_endpoint) \
        .agg(F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("bad"))
    both = by_batch.unionByName(single)
    return both.agg(F.sum("ok").cast("bigint").alias("created"), F.sum("bad").cast("bigint").alias("failed"))
