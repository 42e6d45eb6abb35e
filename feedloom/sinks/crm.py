"""CRM record delivery: rows -> records -> batched tree payloads -> results.

* ``records``: each row becomes a JSON record; null fields are left out,
  dates / timestamps become ISO text, numbers and booleans stay JSON
  values, anything else is text.  A row with no non-null field is skipped.
  All of it is one ``to_json(struct(...))`` expression.
* ``batches``: inside each partition, records are cut into payloads of at
  most ``batch_size`` (default 200): ``{"records": [{"attributes": {"type",
  "referenceId": "ref<i>"}, ...fields}]}``.  This is a ``mapInPandas`` pass
  with no shuffle; a payload never exceeds the batch size, whatever the
  partition sizes are.
* ``deliver``: one call per payload through an injected transport; errors
  are rows.
* ``accounting`` / ``failures``: ``hasErrors = false`` counts the whole batch,
  otherwise results carrying an ``id``; failed results are exploded with
  their messages.
* ``fallback``: records of batches whose call failed are sent one by one.
* ``deliver_stream``: Structured Streaming ``foreachBatch`` with a ledger of
  accepted keys, a table of rejected records and one of undelivered records
  that the next run sends again.  Delivery is at least once: a crash between
  a call and the landing of its reply repeats that call, nothing else does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType,
    StructType, TimestampNTZType, TimestampType,
)

from feedloom.functions.safe import iso_text
from feedloom.operators.fetch import join_on_key
from feedloom.streaming.log import BatchLog, run_id, written_parts

# Default target object, records per payload, and the default
# account schema (used when no ``schema`` DDL is given).
DEFAULT_OBJECT = "Account"
BATCH_SIZE = 200
DEFAULT_SCHEMA = (
    "Name STRING NOT NULL, Industry STRING, Phone STRING, Website STRING, AnnualRevenue DOUBLE, "
    "NumberOfEmployees INT, BillingStreet STRING, BillingCity STRING, BillingState STRING, "
    "BillingPostalCode STRING, BillingCountry STRING")

_KEEP = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType)

RESULT_SCHEMA = ("hasErrors boolean, results array<struct<referenceId: string, id: string, "
                 "errors: array<struct<statusCode: string, message: string>>>>")


def check_options(username: str | None, password: str | None, security_token: str | None) -> None:
    if not (username and password and security_token):
        raise ValueError("username, password and security_token are required")


def _conformed(df: DataFrame, schema: str | None) -> list[Column]:
    """Fields of the target schema, matched by name (case-insensitive, as
    Spark resolves names); absent fields are null."""
    st = StructType.fromDDL(schema or DEFAULT_SCHEMA)
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in st.fields:
        src = have.get(f.name.lower())
        c = F.col(f"`{src}`") if src is not None else F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return out


def conform(df: DataFrame, schema: str | None = None) -> DataFrame:
    """Select the target object's fields by name, cast; absent fields are null."""
    return df.select(*_conformed(df, schema))


def _field(c: Column, dtype) -> Column:
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return iso_text(c, dtype)
    if isinstance(dtype, _KEEP):
        return c
    return c.cast("string")


def record_json(df: DataFrame, fields: list[str] | None = None) -> Column:
    names = fields or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*[_field(F.col(f"`{n}`"), types[n]).alias(n) for n in names]))


def records(df: DataFrame, key: str | None = None, schema: str | None = None, order: str | None = None) -> DataFrame:
    """(key, record) rows, with the column ``order`` as ``ord`` if one is named;
    records with no field set are dropped.

    With ``schema`` (DDL) the row is conformed to it first (W10); ``key``
    names a column that identifies the row for the delivery ledger.
    """
    cols = _conformed(df, schema) if schema is not None else [F.col(f"`{c}`") for c in df.columns]
    k = F.col(f"`{key}`").cast("string") if key is not None else F.lit(None).cast("string")
    by = [F.col(f"`{order}`").alias("__ord")] if order is not None else []
    src = df.select(k.alias("__key"), *by, *cols)
    fields = src.columns[1 + len(by):]
    return (src.select(F.col("__key").alias("key"), record_json(src, fields).alias("record"),
                       *[F.col("__ord").alias("ord") for _ in by])
            .where(F.col("record") != "{}"))


def batches(recs: DataFrame, batch_size: int = BATCH_SIZE, object_type: str = DEFAULT_OBJECT) -> DataFrame:
    """(batch_key, n_records, keys, payload) per at most ``batch_size`` records."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    head = '{"attributes":{"type":%s,"referenceId":"ref%d"}'
    import json
    otype = json.dumps(object_type)

    def cut(it):
        import pandas as pd
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        seq = 0
        buf_k: list = []
        buf_r: list = []

        def flush():
            nonlocal seq
            items = []
            for i, r in enumerate(buf_r):
                inner = r[1:-1]
                items.append(head % (otype, i) + ("," + inner if inner else "") + "}")
            row = (f"{part}-{seq}", len(buf_r), list(buf_k), '{"records":[' + ",".join(items) + "]}")
            seq += 1
            buf_k.clear()
            buf_r.clear()
            return row

        out = []
        for pdf in it:
            for k, r in zip(pdf["key"], pdf["record"]):
                buf_k.append(k)
                buf_r.append(r)
                if len(buf_r) >= batch_size:
                    out.append(flush())
            if out:
                yield pd.DataFrame(out, columns=["batch_key", "n_records", "keys", "payload"])
                out = []
        if buf_r:
            yield pd.DataFrame([flush()], columns=["batch_key", "n_records", "keys", "payload"])

    return recs.select("key", "record").mapInPandas(
        cut, "batch_key string, n_records int, keys array<string>, payload string")


def deliver(payloads: DataFrame, transport: Callable[[str, str], str],
            object_type: str = DEFAULT_OBJECT) -> DataFrame:
    """One call per payload; ``transport(object_type, payload) -> response``."""
    def call(it):
        for pdf in it:
            resp, err = [], []
            for p in pdf["payload"]:
                try:
                    resp.append(transport(object_type, p))
                    err.append(None)
                except Exception as e:  # noqa: BLE001 - failures become rows
                    resp.append(None)
                    err.append(f"{type(e).__name__}: {e}")
            out = pdf.copy()
            out["response"] = resp
            out["error"] = err
            yield out

    schema = StructType(list(payloads.schema.fields)).add("response", "string").add("error", "string")
    return payloads.mapInPandas(call, schema)


def deliver_landed(payloads: DataFrame, transport: Callable[[str, str], str], path: str,
                   object_type: str = DEFAULT_OBJECT) -> DataFrame:
    """``deliver``, then land the replies in the shared folder and read them
    back: anything that uses the replies twice (accounting *and* fallback)
    must not make the calls twice, and a lost executor must not re-send."""
    deliver(payloads, transport, object_type).write.mode("overwrite").parquet(path)
    return payloads.sparkSession.read.parquet(path)


def accounting(delivered: DataFrame) -> DataFrame:
    """Per batch: records created (``n_ok``) from the reply."""
    r = F.from_json("response", RESULT_SCHEMA)
    with_id = F.coalesce(F.size(F.filter(r["results"], lambda x: x["id"].isNotNull())), F.lit(0))
    n_ok = (F.when(F.col("error").isNotNull(), F.lit(0))
            .when(r["hasErrors"] == F.lit(False), F.col("n_records"))
            .otherwise(with_id))
    return delivered.select("batch_key", "n_records", n_ok.alias("n_ok"), "error")


def failures(delivered: DataFrame) -> DataFrame:
    """One row per failed record result and message."""
    r = F.from_json("response", RESULT_SCHEMA)
    failed = F.filter(r["results"], lambda x: x["id"].isNull())
    rows = delivered.select("batch_key", F.explode(failed).alias("res"))
    return rows.select("batch_key", F.col("res.referenceId").alias("referenceId"),
                       F.explode_outer("res.errors.message").alias("message"))


def single_records(delivered: DataFrame) -> DataFrame:
    """Records of batches whose call failed, one row each (attributes removed)."""
    recs = F.from_json("payload", "records array<string>")["records"]
    bad = delivered.where(F.col("error").isNotNull())
    return bad.select("batch_key", F.posexplode(recs).alias("pos", "rec")).select(
        "batch_key", "pos",
        F.regexp_replace("rec", r'^\{"attributes":\{[^{}]*\},?', "{").alias("record"))


def fallback(delivered: DataFrame, create: Callable[[str, str], str],
             object_type: str = DEFAULT_OBJECT) -> DataFrame:
    """Send records of failed batches one by one: (batch_key, pos, success, error)."""
    singles = single_records(delivered)

    def call(it):
        import json

        for pdf in it:
            ok, err = [], []
            for r in pdf["record"]:
                try:
                    res = json.loads(create(object_type, r))
                    ok.append(bool(res.get("success")))
                    err.append(None if res.get("success") else json.dumps(res.get("errors")))
                except Exception as e:  # noqa: BLE001
                    ok.append(False)
                    err.append(f"{type(e).__name__}: {e}")
            out = pdf[["batch_key", "pos"]].copy()
            out["success"] = ok
            out["error"] = err
            yield out

    return singles.mapInPandas(call, "batch_key string, pos int, success boolean, error string")


def _read_if_exists(spark, path: str):
    """The parquet table at ``path``, or None when nothing was written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


LEDGER_SCHEMA = "key string, id string, batch_id string, bucket int"
LEDGER_BUCKETS = 256


def outcomes(sent: DataFrame) -> DataFrame:
    """One row per delivered record: (key, record, status, id, message).

    ``accepted``: the reply names an id for the record's ``referenceId``, or
    says ``hasErrors = false``.  ``rejected``: the service answered without an
    id for it.  ``failed``: the call failed, or its reply cannot be read.
    """
    r = F.from_json("response", RESULT_SCHEMA)
    recs = F.from_json("payload", "records array<string>")["records"]
    # Replies and payloads are parsed once each, below the explode, and every record is given its own result there.
    # (The explode is an outer one: for a plain one Spark tests the whole expression first, parsing the reply for each record.)
    read = sent.select("error", "keys", r.alias("r"), recs.alias("recs")).select(
        "error", "keys", "r", "recs", F.transform("r.results", lambda x: x["referenceId"]).alias("refs"))
    unreadable = F.col("error").isNotNull() | (F.col("r.hasErrors").isNull() & F.col("refs").isNull())

    def with_result(x, i):
        first = F.array_position(F.col("refs"), F.concat(F.lit("ref"), i.cast("string")))
        return F.struct(x["key"].alias("key"), x["rec"].alias("rec"), F.get(F.col("r.results"), first.cast("int") - 1).alias("one"))

    each = F.transform(F.arrays_zip(F.col("keys").alias("key"), F.col("recs").alias("rec")), with_result)
    rows = read.select("error", unreadable.alias("unreadable"), (F.col("r.hasErrors") == F.lit(False)).alias("no_errors"),
                       each.alias("each")).select("error", "unreadable", "no_errors", F.explode_outer("each").alias("x")).where("x IS NOT NULL")
    one, unreadable = F.col("x.one"), F.col("unreadable")
    status = (F.when(unreadable, "failed")
              .when(one["id"].isNotNull() | F.col("no_errors"), "accepted")
              .otherwise("rejected"))
    message = F.when(unreadable, F.coalesce("error", F.lit("reply cannot be read"))).otherwise(
        F.array_join(F.transform(one["errors"], lambda e: e["message"]), "; "))
    return rows.select(F.col("x.key").alias("key"),
                       F.regexp_replace("x.rec", r'^\{"attributes":\{[^{}]*\},?', "{").alias("record"),
                       status.alias("status"), one["id"].alias("id"), message.alias("message"))


def _land(df: DataFrame, path: str) -> DataFrame:
    """Write once (a retried batch reuses what is there) and read back."""
    spark = df.sparkSession
    have = _read_if_exists(spark, path)
    if have is None:
        df.write.mode("overwrite").parquet(path)
        have = spark.read.parquet(path)
    return have


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(LEDGER_BUCKETS)).cast("int")


def accepted(spark, ledger_path: str) -> DataFrame | None:
    """The ledger: (key, id, batch_id, bucket) of every accepted record."""
    found = BatchLog(spark, ledger_path)
    if found.step >= 0:
        paths = found.fragments()
        return spark.read.schema(LEDGER_SCHEMA).option("basePath", found.root).parquet(*paths) if paths else None
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


SUPERSEDED = "another record of the key was sent"


def deliver_records(recs: DataFrame, batch_id: str, transport: Callable[[str, str], str], ledger_path: str,
                    object_type: str = DEFAULT_OBJECT, batch_size: int = BATCH_SIZE,
                    skip_delivered: bool = True, log: BatchLog | None = None) -> list[str]:
    """Deliver (key, record) rows once and account for each of them.

    Of different records of a key the one of the greatest ``ord`` is sent (if
    there is such a column; then the largest text), the others are listed as
    rejected; rows without a key are all sent.  Keys accepted in other batches are
    skipped: only the ledger's buckets that the records touch are read, in the
    fragments that ``log`` lists for them.
    Payloads whose call failed are sent again record by record.  Replies are
    landed before anything is derived from them, so a retried batch calls
    only for what has no landed reply.  Returns the ledger folders written.
    """
    spark, root = recs.sparkSession, ledger_path.rstrip("/")
    if "ord" not in recs.columns:
        recs = recs.withColumn("ord", F.lit(None).cast("string"))
    keyed = recs.where(F.col("key").isNotNull()).select("key", "record", "ord").distinct()
    recs = keyed.unionByName(recs.where(F.col("key").isNull()).select("key", "record", "ord"))
    log_path = f"{root}_responses/batch_id={batch_id}"
    if _read_if_exists(spark, log_path) is None:
        every = _land(recs, f"{root}_records/batch_id={batch_id}")
        best = (every.where(F.col("key").isNotNull()).groupBy("key")
                .agg(F.max_by("record", F.struct("ord", "record")).alias("record")))
        recs = best.unionByName(every.where(F.col("key").isNull()).select("key", "record"))
        touched = [r[0] for r in every.where(F.col("key").isNotNull()).select(_bucket(F.col("key"))).distinct()
                   .collect()] if skip_delivered else []  # at most LEDGER_BUCKETS numbers
        if log is not None:
            done = log.read("key string, id string", [str(b) for b in touched])
        else:
            done = accepted(spark, ledger_path) if skip_delivered else None
            if done is not None:
                done = done.where(F.col("bucket").isin(touched) & (F.col("batch_id") != batch_id))
        if done is not None:
            recs = recs.join(done.select(F.col("key").alias("_done")), F.col("key") == F.col("_done"), "left_anti")
        payloads = batches(recs, batch_size, object_type)
        deliver(payloads, transport, object_type).write.mode("overwrite").parquet(log_path)
    sent = spark.read.parquet(log_path)
    first = outcomes(sent)
    singles = batches(first.where("status = 'failed'").select("key", "record"), 1, object_type)
    again = _land(deliver(singles, transport, object_type), f"{root}_singles/batch_id={batch_id}")
    every = _land(first.where("status <> 'failed'").unionByName(outcomes(again)), f"{root}_outcomes/batch_id={batch_id}")
    # a few files a bucket, however many tasks had its records
    (every.where("status = 'accepted'").select("key", "id", _bucket(F.col("key")).alias("bucket")).hint("rebalance", "bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch_id={batch_id}"))
    for status in ("rejected", "failed"):
        rows = every.where(F.col("status") == status).select("key", "record", "message")
        if status == "rejected":
            rows = rows.unionByName(_superseded(spark, f"{root}_records/batch_id={batch_id}"))
        rows.write.mode("overwrite").parquet(f"{root}_{status}/batch_id={batch_id}")
    return list(written_parts(spark, f"{root}/batch_id={batch_id}").items())


def _superseded(spark, path: str) -> DataFrame:
    """Records of a batch that gave way to another record of their key."""
    keyed = spark.read.parquet(path).where(F.col("key").isNotNull())
    best = keyed.groupBy("key").agg(F.max_by("record", F.struct("ord", "record")).alias("best"))
    lost = join_on_key(keyed, best.withColumnRenamed("key", "best_key"), ["key"], ["best_key"], "inner")
    return (lost.where(F.col("record") != F.col("best")).select("key", "record").distinct()
            .withColumn("message", F.lit(SUPERSEDED)))


def deliver_batch(batch_df: DataFrame, batch_id: int, key: str, transport: Callable[[str, str], str],
                  ledger_path: str, schema: str | None = None, object_type: str = DEFAULT_OBJECT,
                  batch_size: int = BATCH_SIZE, skip_delivered: bool = True, order: str | None = None,
                  log: BatchLog | None = None) -> list[str]:
    """One micro-batch of streaming delivery (the ``foreachBatch`` body).

    Without ``log`` the batch is named by its number alone, and done once.
    """
    recs = records(batch_df, key=key, schema=schema, order=order)
    if log is not None:
        return deliver_records(recs, str(batch_id), transport, ledger_path, object_type, batch_size, skip_delivered, log)
    run, log = f"batch-{batch_id}", BatchLog(batch_df.sparkSession, ledger_path)
    seq = log.begin(run, 0)
    if seq is None:
        return []
    written = deliver_records(recs, str(seq), transport, ledger_path, object_type, batch_size, skip_delivered, log)
    log.commit(run, 0, {b: f"batch_id={seq}/{n}" for b, n in written})
    return written


def undelivered(spark, ledger_path: str) -> DataFrame | None:
    """(key, record, message, batch_id) of records that no call has delivered."""
    root = ledger_path.rstrip("/")
    failed = _read_if_exists(spark, f"{root}_failed")
    if failed is None:
        return None
    done = accepted(spark, ledger_path)
    resent = _read_if_exists(spark, f"{root}_resent")
    failed = failed.withColumn("batch_id", F.col("batch_id").cast("string"))
    if resent is not None:
        failed = failed.join(resent.select(F.col("source").cast("string").alias("_resent")),
                             F.col("batch_id") == F.col("_resent"), "left_anti")
    if done is not None:
        keys = done.where(F.col("key").isNotNull()).select(F.col("key").alias("_done"))
        failed = failed.join(keys, F.col("key") == F.col("_done"), "left_anti")
    return failed


def resend(spark, ledger_path: str, transport: Callable[[str, str], str], object_type: str = DEFAULT_OBJECT,
           batch_size: int = BATCH_SIZE) -> int:
    """Send undelivered records again; what fails again stays undelivered."""
    root = ledger_path.rstrip("/")
    rest = undelivered(spark, ledger_path)
    if rest is None or rest.isEmpty():
        return 0
    run = f"r{uuid.uuid4().hex}"
    sources = rest.select("batch_id").distinct().withColumnRenamed("batch_id", "source")
    waiting = _land(rest.select("key", "record"), f"{root}_waiting/run={run}")
    _land(sources, f"{root}_sources/run={run}")
    log = BatchLog(spark, ledger_path)
    seq = log.begin(run, 0)
    written = deliver_records(waiting, str(seq), transport, ledger_path, object_type, batch_size, log=log)
    log.commit(run, 0, {b: f"batch_id={seq}/{n}" for b, n in written})
    # From here on the run's own failures stand for those of its sources.
    spark.read.parquet(f"{root}_sources/run={run}").write.mode("append").parquet(f"{root}_resent")
    return waiting.count()


def deliver_stream(stream: DataFrame, key: str, transport: Callable[[str, str], str],
                   ledger_path: str, checkpoint: str, schema: str | None = None,
                   object_type: str = DEFAULT_OBJECT, batch_size: int = BATCH_SIZE,
                   trigger: dict | None = None, dedupe: str = "ledger", order: str | None = None):
    """Streaming delivery (see ``deliver_records``).

    Micro-batches are named by stream and number (``streaming.log``), so a
    stream with a new checkpoint goes on behind what the ledger holds.  Of
    different records of a key in one micro-batch the one greatest in the
    column ``order`` is sent; the others are listed as rejected.

    Each micro-batch skips records whose key is already in the ledger,
    delivers the rest in payloads, sends the records of failed payloads one
    by one, and writes accepted, rejected and undelivered records to the
    ledger, ``<ledger>_rejected`` and ``<ledger>_failed``.  Undelivered records
    of earlier runs are sent again before the stream starts.

    ``dedupe="state"`` moves the "already delivered?" test into the stream's
    state store (``dropDuplicates(key)``: per-key lookups, checkpointed with
    the query; use the RocksDB state store for very large key sets).  The
    ledger is still written as the delivery record.
    """
    if dedupe not in ("ledger", "state"):
        raise ValueError("dedupe must be 'ledger' or 'state'")
    src = stream.dropDuplicates([key]) if dedupe == "state" else stream
    resend(stream.sparkSession, ledger_path, transport, object_type, batch_size)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        run, log = run_id(spark, checkpoint), BatchLog(spark, ledger_path)
        seq = log.begin(run, batch_id)
        if seq is None:
            return
        written = deliver_batch(batch_df, seq, key, transport, ledger_path, schema, object_type, batch_size,
                                skip_delivered=(dedupe == "ledger"), order=order, log=log)
        log.commit(run, batch_id, {b: f"batch_id={seq}/{n}" for b, n in written})
        log.merge([b for b, _ in written], "key string, id string", "bucket")

    w = src.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
