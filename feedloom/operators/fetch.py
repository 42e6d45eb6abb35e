"""Fetch and collate.

A *capture* is the landed form of responses, one row per request:

    feed string, key string, status int, body string, error string, fetched_at timestamp

Two ways produce responses for a request DataFrame:

* ``fetch``  – the live call stage: ``mapInPandas`` over Arrow batches with an
  injected transport function ``(method, url, body, headers) -> (status,
  body, error)``.  It is the only Python stage of a feed plan; the caller
  lands its result (``land``) before anything else reads it, so a lost
  executor never re-calls an API for rows already landed.
* ``replay`` – an equi-join of requests with a capture table on the request
  key (``request_key``: the url of a GET, else method, url and a digest of
  the body; captures landed here also hold a digest of the headers and, if
  wanted, the number of equal requests).  Only the latest response per key
  answers, so repeated fetches never multiply rows.  Joins are on the key
  and its hash, which lets the adaptive skew rule split a hot key.

Everything after that (parsing, error split, accounting, joining back) is
plain Catalyst.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, NullType, StringType, StructField, StructType

from feedloom.operators.numbering import running
from feedloom.session import fresh_dir

CAPTURE_SCHEMA = ("feed string, key string, status int, body string, error string, "
                  "fetched_at timestamp")

RESPONSE_COLUMNS = ("status", "response", "_corrupt_record")
INVALID = "invalid request: a url parameter is null"
PROBE = 2**31 - 1  # a page that no service has

Transport = Callable[[str, str, "str | None", "dict | None"], "tuple[int | None, str | None, str | None]"]


def request_key(df: DataFrame) -> Column:
    """What identifies a request: the url of a GET without body, else method,
    url and the SHA-256 of the body.  Null where the url is null."""
    if "req_method" not in df.columns:
        return F.col("req_url")
    body = F.col("req_body") if "req_body" in df.columns else F.lit(None).cast("string")
    plain = (F.col("req_method") == "GET") & body.isNull()
    return F.when(plain, F.col("req_url")).otherwise(
        F.concat(F.col("req_method"), F.lit(" "), F.col("req_url"), F.lit(" "),
                 F.sha2(F.coalesce(body, F.lit("")), 256)))


def headers_digest(df: DataFrame) -> Column:
    """SHA-256 of a request's headers in order of name; empty without any."""
    if "req_headers" not in df.columns:
        return F.lit("")
    sent = F.array_sort(F.map_entries("req_headers"))
    return F.when(F.size(sent) > 0, F.sha2(F.to_json(sent), 256)).otherwise(F.lit(""))


def _key_col(df: DataFrame, on) -> Column:
    if on is None:
        return request_key(df)
    return F.col(on) if isinstance(on, str) else on


def join_on_key(left: DataFrame, right: DataFrame, left_key: list[str], right_key: list[str],
                how: str) -> DataFrame:
    """Equi-join whose hot keys Spark may split.

    A side that is already partitioned by the key (an aggregate) reaches a
    plain join without an exchange of its own, and the adaptive skew rule
    then leaves that join alone.  The key's hash as a further join column
    asks for an exchange on both sides.
    """
    a = left.withColumn("_left_hash", F.xxhash64(*left_key))
    b = right.withColumn("_right_hash", F.xxhash64(*right_key))
    cond = a["_left_hash"] == b["_right_hash"]
    for x, y in zip(left_key, right_key):
        cond = cond & (a[x] == b[y])
    return a.join(b, cond, how).drop("_left_hash", "_right_hash")


def _time() -> Column:
    return F.coalesce(F.col("fetched_at").cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))


def latest_capture(captures: DataFrame) -> DataFrame:
    """Latest response per key (ties broken by the larger body)."""
    keys = _capture_keys(captures)
    return (captures.groupBy(*keys)
            .agg(F.max_by(F.struct(F.col("status").cast("int").alias("status"),
                                   F.col("body").alias("body"),
                                   F.col("error").alias("error")),
                          F.struct(_time(), F.col("body"))).alias("_r"))
            .select(*keys, "_r.status", "_r.body", "_r.error"))


def _capture_keys(captures: DataFrame) -> list[str]:
    """Columns that tell the captures of different requests apart."""
    return ["key", *[c for c in ("headers", "nth") if c in captures.columns]]


_PLACE = ["_file", "_file_row"]


def _placed(captures: DataFrame) -> DataFrame | None:
    """Captures with the file and row each lies in; None unless they are read
    straight from Parquet files."""
    try:
        node = plan = captures._jdf.queryExecution().analyzed()
    except AttributeError:  # no JVM at hand (Spark Connect)
        return None
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    hidden = plan.metadataOutput()
    kinds = [hidden.apply(i).dataType().simpleString() for i in range(hidden.size())]
    if node.children().size() or not any("row_index" in kind for kind in kinds):
        return None
    return captures.withColumns({"_file": F.col("_metadata.file_path"), "_file_row": F.col("_metadata.row_index")})


def latest_places(placed: DataFrame) -> DataFrame:
    """Per key, the place of its latest response: (key columns, file, row).

    Only keys, times and places are read, sorted and moved; of two responses of
    one time the one in the later file, then the later row, is taken.
    """
    keys = _capture_keys(placed)
    newest = F.max(F.struct(_time().alias("time"), *_PLACE))
    return placed.groupBy(*keys).agg(newest.alias("_n")).select(*keys, *[F.col(f"_n.{c}").alias(c) for c in _PLACE])


def replay(requests: DataFrame, captures: DataFrame, on=None, feed: str | None = None,
           latest: bool = True) -> DataFrame:
    """F1 (replay transport): requests left-joined with landed responses.

    Adds ``status``, ``response`` and ``_corrupt_record``; a request with no
    capture gets the error ``not captured``.  Captures with the columns
    ``headers`` and ``nth`` (``land_once``, ``land_each``) also tell requests
    apart that differ in headers only, and the 1st, 2nd, ... of equal ones.

    With ``latest`` (default) the newest response per key answers.  Captures
    read straight from Parquet files are not moved to find it: the winner's
    file and row are found without the bodies, joined to the requests, and
    only then are the bodies fetched from those places.  Other captures are
    reduced by an aggregate that sorts and shuffles whole bodies.  Pass
    ``latest=False`` for a capture that is unique per key by construction
    (``land_once``) to save either.
    """
    caps = captures if feed is None else captures.where(F.col("feed") == feed)
    req = requests.withColumn("_req_key", _key_col(requests, on).cast("string"))
    mine = ["_req_key"]
    if "headers" in captures.columns and on is None:
        req, mine = req.withColumn("_req_headers", headers_digest(requests)), [*mine, "_req_headers"]
    else:
        caps = caps.drop("headers")
    if "nth" in captures.columns:
        req = running(req, mine, [], fresh_dir(requests.sparkSession, "replay"), "_req_nth")
        mine = [*mine, "_req_nth"]
    theirs = _capture_keys(caps)
    placed = _placed(caps) if latest else None
    if latest:
        # only captures of requested keys are looked at: a small request
        # set is broadcast and filters the capture scan map-side
        wanted = req.select(F.col("_req_key").alias("key")).where(F.col("key").isNotNull()).distinct()
        if placed is not None:
            found = latest_places(placed.select(*theirs, "fetched_at", *_PLACE).join(wanted, "key", "left_semi"))
            found = found.select(*[F.col(c).alias(f"_win_{c}") for c in (*theirs, *_PLACE)])
            req = join_on_key(req, found, mine, [f"_win_{c}" for c in theirs], "left").drop(*[f"_win_{c}" for c in theirs])
            mine, theirs, caps = [f"_win_{c}" for c in _PLACE], _PLACE, placed
        else:
            caps = latest_capture(caps.join(wanted, "key", "left_semi"))
    # capture columns get private names, so request columns called key,
    # status, body or error never collide with them
    caps = caps.select(*[F.col(c).alias(f"_cap_{c}") for c in theirs], F.col("status").cast("int").alias("_cap_status"),
                       F.col("body").alias("_cap_body"), F.col("error").alias("_cap_error"))
    joined = join_on_key(req, caps, mine, [f"_cap_{c}" for c in theirs], "left")
    err = (F.when(F.col("_req_key").isNull(), F.lit(INVALID))
           .when(F.col(f"_cap_{theirs[0]}").isNull(), F.lit("not captured")).otherwise(F.col("_cap_error")))
    out_cols = [c for c in requests.columns if c not in RESPONSE_COLUMNS]
    return joined.select(
        *out_cols,
        F.col("_cap_status").alias("status"),
        F.when(err.isNull(), F.col("_cap_body")).alias("response"),
        err.alias("_corrupt_record"),
    )


def fetch(requests: DataFrame, transport: Transport, partitions: int | None = None,
          concurrency: int = 1) -> DataFrame:
    """F1 (live): one call per request row, in Arrow batches on the executors.

    ``transport`` gets (method, url, body, headers) and returns (status, body,
    error) or raises; an exception becomes the row's ``_corrupt_record``
    (F2) instead of failing the task.  ``concurrency`` > 1 runs that many
    calls at once inside each task (a thread pool per batch, results kept in
    row order), for high-latency services.  Land the result (``land``)
    before using it twice.
    """
    if concurrency < 1:
        raise ValueError("concurrency must be >= 1")
    df = requests.drop(*RESPONSE_COLUMNS)  # the response columns are this stage's output
    df = df if partitions is None else df.repartition(partitions)
    in_schema = df.schema
    out_schema = StructType(list(in_schema.fields) + [
        StructField("status", IntegerType()),
        StructField("response", StringType()),
        StructField("_corrupt_record", StringType()),
    ])

    def one(args):
        method, url, body, headers = args
        hdr = dict(headers) if headers is not None else None
        try:
            if url is None:
                raise ValueError(INVALID)
            st, resp, err = transport(method, url, body, hdr)
        except Exception as e:  # noqa: BLE001 - failures become rows
            st, resp, err = None, None, f"{type(e).__name__}: {e}"
        return st, (resp if err is None else None), err

    def call(batches):
        import pandas as pd
        from concurrent.futures import ThreadPoolExecutor

        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            for pdf in batches:
                n = len(pdf)
                args = zip(pdf["req_method"], pdf["req_url"],
                           pdf["req_body"] if "req_body" in pdf else [None] * n,
                           pdf["req_headers"] if "req_headers" in pdf else [None] * n)
                results = list(pool.map(one, args)) if pool else [one(a) for a in args]
                out = pdf.copy()
                out["status"] = pd.array([r[0] for r in results], dtype="Int32")
                out["response"] = [r[1] for r in results]
                out["_corrupt_record"] = [r[2] for r in results]
                yield out
        finally:
            if pool:
                pool.shutdown()

    return df.mapInPandas(call, out_schema)


def as_capture(responses: DataFrame, feed: str, key=None, headers: bool = False) -> DataFrame:
    """Fetched rows -> capture rows (for landing), with the digest of their
    headers if wanted."""
    more = [headers_digest(responses).alias("headers")] if headers else []
    return responses.select(
        F.lit(feed).alias("feed"),
        _key_col(responses, key).cast("string").alias("key"),
        *more,
        F.col("status").cast("int").alias("status"),
        F.col("response").alias("body"),
        F.col("_corrupt_record").alias("error"),
        F.current_timestamp().alias("fetched_at"),
    )


def land(df: DataFrame, path: str, mode: str = "append", partition_by=("feed",)) -> DataFrame:
    """write to the shared folder and read back (cuts lineage, survives
    executor loss, and keeps live calls from being repeated)."""
    w = df.write.mode(mode)
    cols = [c for c in (partition_by or ()) if c in df.columns]
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def land_once(responses: DataFrame, feed: str, path: str, key=None) -> DataFrame:
    """Land fetched rows with one row per request, for ``replay(latest=False)``.

    Without ``key`` requests that differ in their headers are different ones
    (column ``headers``).  Equal requests were each called; one of their
    replies stays, a successful one if there is any: ``land_each`` keeps all.
    """
    got = as_capture(responses, feed, key, headers=key is None)
    keys = _capture_keys(got)
    best = F.max_by(F.struct(*[c for c in got.columns if c not in keys]),
                    F.struct(F.col("error").isNull(), F.col("body")))
    once = got.groupBy(*keys).agg(best.alias("_r")).select("_r.feed", *keys, "_r.status", "_r.body", "_r.error",
                                                           "_r.fetched_at")
    return land(once, path)


def land_each(responses: DataFrame, feed: str, path: str) -> DataFrame:
    """Land the reply of every call: equal requests keep theirs apart by their
    number (column ``nth``), which ``replay`` deals out again."""
    return running(as_capture(responses, feed, headers=True), ["key", "headers"], [], path, "nth")


def parse_output(df: DataFrame, schema: str | None = None, col: str = "response",
                 out: str = "output") -> DataFrame:
    """JSON bodies -> ``output``.

    With a schema the body is parsed to that type (``from_json``); a body that
    is not JSON, or in which some value is of another type than the schema has
    there, is then an error: its text goes to ``_corrupt_record`` (unless
    the row has an error already), so it is counted as failed and never lost.
    Absent and extra fields and nulls are no errors; one object where an array
    of them is wanted is an array of one.
    Without a schema ``output`` is the body text as received, JSON or not.
    """
    if schema is None:
        return df.withColumn(out, F.col(col))
    body, wanted = F.col(col), _type_of(schema)
    broken = body.isNotNull() & F.try_parse_json(body).isNull()
    text = body
    if isinstance(wanted, ArrayType) and isinstance(wanted.elementType, StructType):
        text = F.when(F.ltrim(body).startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    # Below a field of its own a body of any type is checked, in all its depth.
    read = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), StructType([
        StructField("v", wanted), StructField("_misfit", StringType())]), {"columnNameOfCorruptRecord": "_misfit"})
    misfit = ~broken & read["_misfit"].isNotNull()
    error = (F.when(broken, F.concat(F.lit("response is not JSON: "), body))
             .when(misfit, F.concat(F.lit("response does not fit the schema: "), body)))
    if "_corrupt_record" in df.columns:
        error = F.coalesce(F.col("_corrupt_record"), error)
    return df.withColumn(out, F.when(~broken & ~misfit, read["v"])).withColumn("_corrupt_record", error)


def _type_of(schema: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema)


def explode_output(df: DataFrame, element_schema: str, col: str = "response",
                   out: str = "output") -> DataFrame:
    """a body may be one object or an array of them; rows per element."""
    t = F.ltrim(F.col(col))
    as_array = F.when(t.startswith("["), F.col(col)).otherwise(
        F.concat(F.lit("["), F.col(col), F.lit("]")))
    from pyspark.sql.types import ArrayType, _parse_datatype_string

    element = _parse_datatype_string(element_schema)
    return df.withColumn(out, F.explode_outer(F.from_json(as_array, ArrayType(element))))


def fail_on_error(df: DataFrame, enabled: bool = True, col: str = "_corrupt_record") -> DataFrame:
    """with ``enabled`` the first failed row stops the job."""
    if not enabled:
        return df
    chk = F.when(F.col(col).isNotNull(),
                 F.raise_error(F.concat(F.lit("request failed: "), F.col(col))))
    return df.where(chk.isNull())


def select_output(df: DataFrame, include_inputs: bool = True,
                  inputs: list[str] | None = None, out: str = "output") -> DataFrame:
    """inputs + output (+ error), or output only."""
    if include_inputs:
        keep = inputs if inputs is not None else [
            c for c in df.columns
            if c not in ("req_method", "req_url", "req_body", "req_headers", "_req_key",
                         "status", "response", out, "_corrupt_record")]
        return df.select(*keep, out, "_corrupt_record")
    return df.select(out, "_corrupt_record")


def _without_void(t):
    """The type with STRING where only nulls were seen."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _without_void(f.dataType)) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_without_void(t.elementType))
    return StringType() if isinstance(t, NullType) else t


def _variant_schema_to_ddl(s: str) -> str:
    """``schema_of_variant`` text -> a type ``from_json`` accepts (names in
    back quotes are left alone)."""
    from pyspark.sql.types import _parse_datatype_string

    named = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], s)
    t = _without_void(_parse_datatype_string(f"v {named}")[0].dataType)
    ddl = StructType([StructField("v", t)]).toDDL()
    return ddl[ddl.index(" ") + 1:]


def infer_schema(df: DataFrame, fraction: float = 1.0, min_rows: int = 3, seed: int = 7,
                 col: str = "response") -> str:
    """response schema of the bodies, from all of them by default.

    One distributed aggregate (``schema_of_variant_agg``); only the schema
    text returns to the driver.  ``fraction`` < 1 samples (the option of the
    same meaning); fields that only other bodies have are then absent from
    the parsed output.  A sample of fewer than ``min_rows`` bodies is given
    up for all bodies.
    """
    parsed = df.select(F.try_parse_json(F.col(col)).alias("_v")).where(F.col("_v").isNotNull())

    def schema_of(rows):
        return rows.agg(F.count("*").alias("n"), F.schema_of_variant_agg("_v").alias("s")).first()

    row = schema_of(parsed if fraction >= 1 else parsed.sample(fraction=fraction, seed=seed))
    if fraction < 1 and row["n"] < min_rows:
        row = schema_of(parsed)
    return "STRING" if row["s"] in (None, "VOID") else _variant_schema_to_ddl(row["s"])


def call_stats(df: DataFrame, col: str = "_corrupt_record") -> DataFrame:
    """F8: total, failed and success % in a single aggregate."""
    total = F.count(F.lit(1))
    failed = F.count_if(F.col(col).isNotNull())
    return df.agg(
        total.alias("total_calls"),
        failed.alias("failed_calls"),
        F.when(total > 0, F.round((total - failed) * 100.0 / total, 2)).alias("success_pct"),
    )


def split_outcome(df: DataFrame, col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(successful rows, failed rows) as two branches of one plan.

    Callers that act on both branches should ``land`` the input first so the
    calls are not repeated.
    """
    return df.where(F.col(col).isNull()), df.where(F.col(col).isNotNull())


def call_once(params: DataFrame, key_cols: list[str], call: Callable[[DataFrame], DataFrame],
              result_cols: list[str]) -> DataFrame:
    """Q10: call once per distinct parameter tuple, share the result.

    ``dropDuplicates`` is a hash aggregate (partial, so a hot tuple costs one
    row per map task), the join back is null-safe on every key column.
    """
    distinct = params.select(*key_cols).dropDuplicates(key_cols)
    res = call(distinct).select(*[F.col(k).alias(f"_k_{k}") for k in key_cols],
                                *result_cols)
    cond = None
    for k in key_cols:
        c = params[k].eqNullSafe(res[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return params.join(res, cond, "left").drop(*[f"_k_{k}" for k in key_cols])


def pages_until_empty(keys: DataFrame, call: Callable[[DataFrame], DataFrame], n_items: Column, path: str,
                      first: int = 1, step: int = 4, page_col: str = "page",
                      probe: int | None = PROBE) -> DataFrame:
    """Q11 without a known total: pages of every key up to its first empty one.

    ``call`` answers (key columns, page) rows; ``n_items`` counts a response's
    items (null, zero or less: no more pages; a failed page ends its key and
    is kept).  Pages are asked in rounds, each twice as many as the one
    before, only for keys that are still open, and landed below ``path``; so
    the rounds grow with the logarithm of the longest key and at most twice
    the pages needed are asked for.  The first round also asks each key for
    the page ``probe``, far behind any real one: a service that answers it with
    items doesn't page, and its first page is all.  ``probe=None`` saves that
    call for services known to page.
    """
    if step < 2:
        raise ValueError("step must be >= 2")
    spark, folder = keys.sparkSession, f"{path.rstrip('/')}/pages-{uuid.uuid4().hex}"
    names, open_, rounds, start = list(keys.columns), keys.distinct(), [], first
    while True:
        asked = F.sequence(F.lit(first), F.lit(first + step - 1))
        if first == start and probe is not None:
            asked = F.concat(asked, F.array(F.lit(probe)))
        got = call(open_.withColumn(page_col, F.explode(asked))).withColumn("_items", F.coalesce(n_items, F.lit(0)))
        landed = land(got, f"{folder}/{first}", partition_by=None)
        end = F.min(F.when(F.col("_items") <= 0, F.col(page_col)))
        if first == start and probe is not None:
            far = F.col(page_col) == probe
            end = F.when(F.max(far & (F.col("_items") > 0)), F.lit(start)).otherwise(
                F.min(F.when((F.col("_items") <= 0) & ~far, F.col(page_col))))
            landed, ended = landed.where(~far), landed.groupBy(*names).agg(end.alias("_end"))
        else:
            ended = landed.groupBy(*names).agg(end.alias("_end"))
        rounds.append(landed)
        ended.write.parquet(f"{folder}/end-{first}")
        open_ = spark.read.parquet(f"{folder}/end-{first}").where(F.col("_end").isNull()).select(*names)
        first, step = first + step, 2 * step
        if open_.isEmpty():
            break
    from feedloom.operators.requests import cut_pages

    # The first round's end is known for every key; later rounds only have open keys.
    private = [f"_key_{i}" for i in range(len(names))]
    ends = spark.read.parquet(f"{folder}/end-{start}").where(F.col("_end") == start).select(
        *[F.col(n).alias(p) for n, p in zip(names, private)], "_end")
    every = join_on_key(rounds[0], ends, names, private, "left").drop(*private)
    every = every.where(F.col("_end").isNull() | (F.col(page_col) <= F.col("_end"))).drop("_end")
    for r in rounds[1:]:
        every = every.unionByName(r)
    kept = cut_pages(every.withColumn("_more", F.lit(True)), names, page_col, "_more", "_items").drop("_more")
    failed = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in kept.columns else F.lit(False)
    return kept.where((F.col("_items") > 0) | failed).drop("_items")


def enrich(facts: DataFrame, key: str, lookup: Callable[[DataFrame], DataFrame],
           result_cols: list[str], how: str = "inner") -> DataFrame:
    """distinct keys of a fact table -> lookup -> join back on the key.

    The lookup side has one row per distinct key; Spark / AQE picks a
    broadcast join only when its measured size is under the threshold, and
    splits hot keys otherwise (see ``join_on_key``).
    """
    keys = facts.select(key).where(F.col(key).isNotNull()).distinct()
    looked = lookup(keys).select(F.col(key).alias("_looked_key"), *result_cols)
    return join_on_key(facts, looked, [key], ["_looked_key"], how).drop("_looked_key")
