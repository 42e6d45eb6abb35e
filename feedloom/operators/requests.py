"""Request planning: parameter rows -> one request row each (Q1-Q13).

A parameter table is an ordinary DataFrame whose column names are the API
parameter names.  ``build_requests`` appends four columns and never leaves
the JVM:

``req_method``  GET / POST / PUT / DELETE
``req_url``     final url (query string or inline placeholders filled)
``req_body``    JSON or form body for POST / PUT, else null
``req_headers`` map<string,string> (custom JSON headers, content type,
                Bearer / Basic authorisation, Cookie)

Nothing is collected; the plan is a projection over the parameter scan, so
filters on the parameters still reach the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.encode import param_text, path_quote, query_string

METHODS = ("GET", "POST", "PUT", "DELETE")
QUERY_TYPES = ("querystring", "inline")
POST_FORMATS = ("json", "form")

REQUEST_COLUMNS = ("req_method", "req_url", "req_body", "req_headers")


def _as_col(v) -> Column | None:
    if v is None:
        return None
    return v if isinstance(v, Column) else F.lit(v)


def validate_options(url, params, method: str, query_type: str, post_input_format: str) -> str:
    """Up-front checks (Q13, Q6): fail before any job is planned."""
    if url is None or (isinstance(url, str) and not url):
        raise ValueError("url is required")
    if params is None:
        raise ValueError("input (a parameter DataFrame) is required")
    m = (method or "POST").upper()
    if m not in METHODS:
        raise ValueError(f"unknown method {method!r}; known: {', '.join(METHODS)}")
    if query_type not in QUERY_TYPES:
        raise ValueError(f"unknown queryType {query_type!r}; known: {', '.join(QUERY_TYPES)}")
    if post_input_format not in POST_FORMATS:
        raise ValueError(f"unknown postInputFormat {post_input_format!r}; known: {', '.join(POST_FORMATS)}")
    return m


def querystring_url(url: Column, params: dict[str, Column]) -> Column:
    """Q2: append ``?k=v&...`` (``&...`` when the url already has ``?``)."""
    qs = query_string(params)
    sep = F.when(F.instr(url, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    return F.when(qs == "", url).otherwise(F.concat(url, sep, qs))


def inline_url(url: Column, params: dict[str, Column]) -> Column:
    """Q3: replace each ``{name}`` with the path-quoted value (``/`` kept).

    A null value used by a placeholder makes the url null: the request is
    rejected (reported as ``invalid request``) instead of asking for
    ``.../None``.
    """
    out = url
    for name, value in params.items():
        ph = F.lit("{" + name + "}")
        out = F.when(F.instr(out, "{" + name + "}") > 0, F.replace(out, ph, path_quote(value))) \
            .otherwise(out)
    return out


def json_body(params: DataFrame, names: list[str]) -> Column:
    """Q4: the row as a JSON object, nulls written as ``null``."""
    return F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false"})


def form_body(params: dict[str, Column]) -> Column:
    """Q5: form-encoded body; null parameters are left out."""
    return query_string(params)


def cookie_header(cookie: Column) -> Column:
    """Q8: ``name=value`` split at the first ``=``; no ``=`` -> no cookie."""
    parts = F.split(cookie, "=", 2)
    return F.when(F.instr(cookie, "=") > 0,
                  F.concat(F.get(parts, 0), F.lit("="), F.get(parts, 1)))


def headers_map(custom_headers=None, content_type=None, auth_type=None, token=None,
                user=None, password=None, cookie=None) -> Column:
    """Q7: one map column of request headers.

    Custom headers are a JSON object (text that is not JSON adds nothing);
    later entries win over earlier ones, as with dict updates.
    """
    maps = []
    if custom_headers is not None:
        h = _as_col(custom_headers)
        maps.append(F.coalesce(F.from_json(h, "map<string,string>"),
                               F.create_map().cast("map<string,string>")))
    if content_type is not None:
        maps.append(F.create_map(F.lit("Content-Type"), _as_col(content_type)))
    if auth_type == "Bearer" and token is not None:
        maps.append(F.create_map(F.lit("Authorization"),
                                 F.concat(F.lit("Bearer "), _as_col(token))))
    elif user is not None and password is not None:
        cred = F.base64(F.encode(F.concat(_as_col(user), F.lit(":"), _as_col(password)), "UTF-8"))
        maps.append(F.create_map(F.lit("Authorization"), F.concat(F.lit("Basic "), cred)))
    if cookie is not None:
        c = cookie_header(_as_col(cookie))
        maps.append(F.when(c.isNotNull(), F.create_map(F.lit("Cookie"), c))
                    .otherwise(F.create_map().cast("map<string,string>")))
    if not maps:
        return F.create_map().cast("map<string,string>")
    # map_concat rejects duplicate keys under the default policy, so merge
    # right-to-left: a key is taken from the first map (from the right) having it.
    def not_in(m):
        return lambda k, _v: ~F.map_contains_key(m, k)

    out = maps[0]
    for m in maps[1:]:
        out = F.map_concat(F.map_filter(out, not_in(m)), m)
    return out


def build_requests(params: DataFrame, url, method: str = "POST",
                   query_type: str = "querystring", post_input_format: str = "json",
                   param_columns: list[str] | None = None, headers=None,
                   auth_type: str | None = None, token=None, user=None, password=None,
                   cookie=None) -> DataFrame:
    """Q1-Q8: parameter rows -> request rows (inputs kept, four columns added).

    ``param_columns`` picks which columns are sent (default: all).  ``url``
    and the header options may be literals or Columns.
    """
    m = validate_options(url, params, method, query_type, post_input_format)
    names = (list(param_columns) if param_columns is not None
             else [c for c in params.columns if c not in REQUEST_COLUMNS])
    dtypes = dict((f.name, f.dataType) for f in params.schema.fields)
    texts = {n: param_text(F.col(n), dtypes[n]) for n in names}
    base = _as_col(url)

    content_type = None
    if m == "GET":
        if query_type == "querystring":
            req_url = querystring_url(base, texts)
        else:
            req_url = inline_url(base, texts)
        body = F.lit(None).cast("string")
    elif m == "DELETE":
        req_url, body = base, F.lit(None).cast("string")
    else:
        req_url = base
        if post_input_format == "json":
            body = json_body(params, names)
            content_type = "application/json"
        else:
            body = form_body(texts)
    hdr = headers_map(headers, content_type, auth_type, token, user, password, cookie)
    return params.select(
        "*",
        F.lit(m).alias("req_method"),
        req_url.alias("req_url"),
        body.alias("req_body"),
        hdr.alias("req_headers"),
    )


def spread(requests: DataFrame, partitions: int = 2) -> DataFrame:
    """Q9: spread requests over ``partitions`` tasks (round robin)."""
    if partitions < 1:
        raise ValueError("partitions must be >= 1")
    return requests.repartition(partitions)


def spread_by_index(requests: DataFrame, partitions: int, order: list[str], path: str) -> DataFrame:
    """Q9: the request of index i (from 0, by ``order``) goes to task i mod
    ``partitions``, whatever the partitioning was.  Rows are numbered by
    ranges landed below ``path``; no task sees them all."""
    from feedloom.operators.numbering import running

    if partitions < 1:
        raise ValueError("partitions must be >= 1")
    numbered = running(requests, [], order, path, "_index")
    return numbered.repartitionById(partitions, ((F.col("_index") - 1) % partitions).cast("int")).drop("_index")


def plan_pages(keys: DataFrame, total_col: str, page_size: int, page_col: str = "page",
               probe_extra: bool = True) -> DataFrame:
    """Q11 planning: one request row per page ``1..ceil(total/size)``.

    With ``probe_extra`` one more page is planned, the empty page that a
    client without a known total would read last.
    """
    if page_size < 1:
        raise ValueError("page_size must be >= 1")
    n = F.ceil(F.col(total_col) / F.lit(page_size)).cast("int")
    last = n + F.lit(1 if probe_extra else 0)
    return keys.withColumn(page_col, F.explode(F.sequence(F.lit(1), F.greatest(last, F.lit(1)))))


def cut_pages(pages: DataFrame, key_cols: list[str], page_col: str = "page",
              has_more_col: str = "has_more", n_items_col: str = "n_items") -> DataFrame:
    """Q11 cut: keep pages up to the first empty page or ``has_more = false``.

    One partial aggregate per key finds the stop page; the join back is on the
    key, and Spark may split a hot key (see ``join_on_key``).  ``pages`` is
    read twice: land it first if it is not a table.
    """
    from feedloom.operators.fetch import join_on_key

    stop = F.col(n_items_col).isNull() | (F.col(n_items_col) == 0) | ~F.coalesce(
        F.col(has_more_col), F.lit(False))
    stops = (pages.groupBy(*key_cols)
             .agg(F.min(F.when(stop, F.col(page_col))).alias("_stop_page")))
    private = [f"_stop_{i}" for i in range(len(key_cols))]
    stops = stops.select(*[F.col(k).alias(p) for k, p in zip(key_cols, private)], "_stop_page")
    return (join_on_key(pages, stops, key_cols, private, "left")
            .where(F.col("_stop_page").isNull() | (F.col(page_col) <= F.col("_stop_page")))
            .drop(*private, "_stop_page"))


def split_range(lower: int, upper: int, num_partitions: int) -> list[tuple[int, int, int]]:
    """Q12: ``[lower, upper)`` in equal ranges; the last takes the remainder."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    total = upper - lower
    step = total // num_partitions
    out = []
    for i in range(num_partitions):
        s = lower + i * step
        e = s + step if i < num_partitions - 1 else upper
        out.append((i, s, e))
    return out


def range_index(key: Column, lower: int, upper: int, num_partitions: int) -> Column:
    """Q12 as an expression: the range id of ``key`` (equi-join / groupBy key,
    no theta join).  Keys outside ``[lower, upper)`` give null."""
    step = (upper - lower) // num_partitions
    if step <= 0:
        idx = F.lit(num_partitions - 1)
    else:
        idx = F.least(F.floor((key - F.lit(lower)) / F.lit(step)).cast("int"),
                      F.lit(num_partitions - 1))
    return F.when((key >= lower) & (key < upper), idx)


def range_bounds(df: DataFrame, key: str) -> tuple[int, int]:
    """Min / max bounds of a key column: one aggregate row to the driver."""
    row = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return int(row["lo"]), int(row["hi"]) + 1


def read_ranges(spark, lower: int, upper: int, num_partitions: int) -> DataFrame:
    """Q12 generation side: ``spark.range`` split like the guide's reader."""
    return spark.range(lower, upper, 1, num_partitions)


__all__ = [
    "build_requests", "spread", "plan_pages", "cut_pages", "split_range", "range_index",
    "range_bounds", "read_ranges", "headers_map", "cookie_header", "querystring_url",
    "inline_url", "json_body", "form_body", "validate_options",
]
