"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontam, html, jaccard, licence, packing, pii, quality, runs, shard, tokens, topk, trie, warc
from feedloom.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from feedloom.operators.fetch import join_on_key
from feedloom.session import fresh_dir


def byte_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
    m AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id FROM d)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to,
           true AS digest_ok
    FROM m
""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    planned = warc.plan_records(pages, "page_id", F.col("html"), F.col("url"))
    manifest = warc.write_archives(planned, fresh_dir(spark, "warc"))
    back = warc.read_archives(manifest)
    page = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    return back.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page("refers_to").alias("refers_to"), "digest_ok")


# Words of a text, as ``feedloom.llm.text`` cuts them.
_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"


@query("op2_decontamination", f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT min(item_id) AS item_id, w, len(w) AS n, least(13, len(w)) AS width, row_number() OVER () AS item,
                 CASE WHEN len(w) >= 5 THEN (4 * least(13, len(w)) + 4) // 5 ELSE len(w) END AS least,
                 -- words in a row that agree in any leak: 11 of 13 hold four, 4 of 5 two, shorter items all
                 CASE WHEN len(w) >= 13 THEN 4 WHEN len(w) >= 5 THEN 2 ELSE len(w) END AS g
          FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0 GROUP BY w),
    dg AS (SELECT doc_id, w, g, unnest(range(1, len(w) - g + 2)) AS at FROM d, (SELECT DISTINCT g FROM i) WHERE len(w) >= g),
    ig AS (SELECT item, w, g, unnest(range(1, len(w) - g + 2)) AS at FROM i),
    c AS (SELECT DISTINCT dg.doc_id, ig.item, dg.at - ig.at AS shift
          FROM dg JOIN ig ON dg.g = ig.g AND dg.w[dg.at:dg.at + dg.g - 1] = ig.w[ig.at:ig.at + ig.g - 1]),
    a AS (SELECT c.doc_id, i.item_id, shift, i.n, i.width, i.least,
                 list_transform(range(1, i.n + 1), lambda j:
                     CASE WHEN j + shift >= 1 AND d.w[j + shift] = i.w[j] THEN 1 ELSE 0 END) AS same
          FROM c JOIN i USING (item) JOIN d ON c.doc_id IS NOT DISTINCT FROM d.doc_id),
    g AS (SELECT *, list_filter(range(1, n - width + 2), lambda x: list_sum(same[x:x + width - 1]) >= least) AS good FROM a),
    m AS (SELECT *, list_filter(range(1, n + 1), lambda j:
                     same[j] = 1 AND len(list_filter(good, lambda x: x <= j AND j < x + width)) > 0) AS agreed
          FROM g WHERE len(good) > 0),
    r AS (SELECT doc_id, item_id, CAST(len(agreed) AS BIGINT) AS matched, CAST(n AS BIGINT) AS item_words,
                 CAST(shift + agreed[1] - 1 AS BIGINT) AS text_start, CAST(agreed[1] - 1 AS BIGINT) AS item_start,
                 CAST(agreed[-1] AS BIGINT) AS item_end FROM m)
    SELECT doc_id, item_id, matched, item_words, matched / item_words AS overlap, text_start,
           text_start + item_end - item_start AS text_end, item_start, item_end
    FROM r
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
                               ORDER BY matched DESC, text_start, item_start, item_end DESC) = 1
""")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "text")
            .withColumnsRenamed({"id": "doc_id", "item": "item_id"}))


@query("op3_topk", """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""")
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0, k=10)


@query("op4_jaccard_join", f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
          FROM w),
    k AS (SELECT doc_id, s, md5(array_to_string(list_sort(s), '|')) AS k FROM s),
    c AS (SELECT k, any_value(s) AS s, count(*) AS n, min(doc_id) AS least FROM k GROUP BY k),
    t AS (SELECT k, len(s) AS m, unnest(s) AS t FROM c),
    p AS (SELECT a.k AS a, b.k AS b FROM t a JOIN t b ON a.t = b.t AND a.k <> b.k
          GROUP BY a.k, b.k HAVING 5 * count(*) >= 4 * (any_value(a.m) + any_value(b.m) - count(*))),
    r(k, l) AS (SELECT k, k FROM c UNION SELECT r.k, p.b FROM r JOIN p ON r.l = p.a),
    o AS (SELECT r.k, min(c.least) AS class_id FROM r JOIN c ON r.l = c.k GROUP BY r.k),
    l AS (SELECT p.a AS k, sum(c.n) AS docs, count(*) AS sets FROM p JOIN c ON p.b = c.k GROUP BY p.a)
    SELECT k.doc_id, o.class_id, CAST(c.n - 1 + coalesce(l.docs, 0) AS BIGINT) AS n_links,
           CAST(coalesce(l.sets, 0) AS BIGINT) AS n_set_links
    FROM k JOIN c USING (k) JOIN o USING (k) LEFT JOIN l USING (k)
""")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", k=5, threshold=0.8)
            .withColumnRenamed("id", "doc_id"))


@query("op5_shard")
def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (shard.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", shards=8)
            .select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@query("op6_licence_scan")
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (licence.scan(table(spark, sf_dir, "documents"), "doc_id", "text")
            .withColumnRenamed("id", "doc_id").drop("places"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own, so that every run encodes all distinct texts.
    return (tokens.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", byte_bpe(),
                                fresh_dir(spark, "token-cache"), limit=1024)
            .withColumnRenamed("id", "doc_id"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", byte_bpe(), window=1024)
            .withColumnRenamed("id", "doc_id"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", ("n_chars",))
    return quality.score(docs, model, "doc_id", "text", ("n_chars",)).withColumnRenamed("id", "doc_id")


@query("op10_html_text")
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (html.extract_text(table(spark, sf_dir, "pages"), "page_id", "html")
            .withColumnRenamed("id", "page_id"))


# CRC-32 of a number's decimal digits, unsigned.
_CRC32 = """xor(list_reduce(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
        lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
                                 xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"""


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, ids) of op11's conversations: the first h turns of conversation
    c - c % 5, then c's own after its first h, where h is a hash of c."""
    fresh = fresh_dir(turns.sparkSession, "conversations")
    (turns.groupBy("id").agg(F.max("at").alias("n"), F.sort_array(F.collect_list(
        F.when(F.col("at") <= 8, F.struct("at", "digest", "bytes")))).alias("head"))
     .withColumn("h", F.when(F.col("id") % 5 != 0, F.crc32(F.col("id").cast("string")) % 9).otherwise(0))
     .write.parquet(f"{fresh}/each"))
    each = turns.sparkSession.read.parquet(f"{fresh}/each")
    base = each.select(F.col("id").alias("base"), F.col("head").alias("base_head"))
    (each.select("id", "h").join(base, F.expr("id - id % 5 = base"), "left")
     .select("id", "h", F.coalesce(F.slice("base_head", F.lit(1), F.col("h").cast("int")), F.array()).alias("taken"))
     .write.parquet(f"{fresh}/plan"))
    plan = turns.sparkSession.read.parquet(f"{fresh}/plan")
    cut = plan.select(F.col("id").alias("plan_id"), "h", F.size("taken").alias("kept"))
    own = (join_on_key(turns, cut, ["id"], ["plan_id"], "inner").where("at > h")
           .select("id", F.expr("at - h + kept").alias("at"), "digest", "bytes"))
    return plan.select("id", F.inline("taken")).unionByName(own), plan.select("id")


@query("op11_prefix_trie", f"""
    WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r
               FROM conversations WHERE conv_id IS NOT NULL),
    l AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY r) AS w FROM t GROUP BY conv_id),
    c AS (SELECT conv_id, w, {_CRC32.format('conv_id')} % 9 AS h FROM l),
    b AS (SELECT c.conv_id, list_concat(coalesce(l.w[1:h], []), c.w[h + 1:]) AS w
          FROM c LEFT JOIN l ON l.conv_id = c.conv_id - c.conv_id % 5),
    p AS (SELECT conv_id, w, len(w) AS n, unnest(range(len(w) + 1)) AS depth FROM b),
    k AS (SELECT conv_id, depth, n, w[1:depth] AS k, w[1:depth - 1] AS up, coalesce(octet_length(encode(w[depth].text)), 0) AS bytes
          FROM p),
    nodes AS (SELECT k, any_value(up) AS up, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
                     coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = n), '') AS ends
              FROM k GROUP BY k, depth),
    kids AS (SELECT up AS k, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    x AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k, depth)),
    -- every node with each of its ancestors and itself
    s AS (SELECT k.k, k.depth, sum((x.n_convs - 1) * x.bytes) AS saved, count(*) FILTER (x.n_children = 0) AS n_leaves
          FROM x JOIN k ON k.conv_id = x.conv_id AND k.depth <= x.depth GROUP BY k.k, k.depth)
    SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves,
           CAST(s.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
    FROM x JOIN s USING (k, depth) LEFT JOIN nodes u ON x.depth > 0 AND u.depth = x.depth - 1 AND u.k = x.up
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return trie.prefix_trie(*_rebuilt(turns))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as op13's contract has them: in one document of ten the
    words from a on repeat with period p."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    parts = (docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
             .withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
             .withColumn("a", F.expr("CASE WHEN n > 0 THEN (h div 10) % n END"))
             .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)")))
    again = "array_join(transform(w, (x, i) -> CASE WHEN i < a THEN x ELSE w[cast(a + (i - a) % p as int)] END), ' ')"
    return parts.select("doc_id", F.expr(f"CASE WHEN a IS NULL THEN text ELSE {again} END").alias("text"))


@query("op13_periodic_runs", f"""
    WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC32.format('doc_id')} AS h
               FROM documents),
    f AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
    d AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
              w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w FROM f),
    x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM d),
    -- words with a like word q further on, in stretches
    e AS (SELECT a.doc_id, b.i - a.i AS q, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS g, a.i
          FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.x = b.x AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
    s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM e GROUP BY doc_id, q, g
          HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
    o AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
          FROM r GROUP BY doc_id),
    b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    k AS (SELECT x.doc_id, string_agg(x.x, ' ' ORDER BY x.i) AS kept FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY x.doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN o USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(_with_repeats(table(spark, sf_dir, "documents")), "doc_id", "text")
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    lines = F.expr(r"concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return (found.withColumn("best", best)
            .select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
                    (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.period")).alias("period"),
                    F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


@query("op12_personal_data")
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.fit(docs, "text"), "doc_id", "text")
    joined = "array_join(transform({0}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(F.expr(joined.format("base")).cast("binary"), 256).alias("base_sha256"),
                        F.expr(joined.format("spans")).alias("spans"))
