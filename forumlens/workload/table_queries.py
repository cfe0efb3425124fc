"""Raw posts to flat tables, snapshots, loads and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens import schemas
from forumlens.functions import dates, fields
from forumlens.operators import balance, batches, delta
from forumlens.operators import posts as P
from forumlens.plans import jobs
from forumlens.runtime import new_path
from forumlens.sources import config, ledger, raw, tables
from forumlens.workload import bindings as B
from forumlens.workload.bindings import with_views
from forumlens.workload.registry import query



def _combined(spark, sf):
    return jobs.combine_batch(B.raw_posts(spark, sf), B.seen_ids(spark, sf), B.ts(B.BATCH_TIME))


@query("B1 H16", with_views("SELECT id, post_url AS url, title, content, created_at FROM raw_posts", "raw_posts"))
def post_static(spark, sf):
    return P.post_static(B.raw_posts(spark, sf))


@query("B2", with_views("SELECT id, TIMESTAMP '2024-01-16' AS extracted_at, view_count, upvote_count, downvote_count, comment_count FROM raw_posts", "raw_posts"))
def post_dynamic(spark, sf):
    return P.post_dynamic(B.raw_posts(spark, sf), B.ts(B.BATCH_TIME))


@query("B3", with_views("SELECT id AS post_id, car_id FROM raw_posts", "raw_posts"))
def post_car(spark, sf):
    return P.post_car(B.raw_posts(spark, sf))


@query("B4 I1", with_views("SELECT id, post_id, content, is_reply, created_at FROM raw_comments", "raw_comments"))
def comment_static(spark, sf):
    return P.comment_static(B.raw_posts(spark, sf))


@query("B5 I1", with_views("SELECT id, TIMESTAMP '2024-01-16' AS extracted_at, upvote_count, downvote_count FROM raw_comments", "raw_comments"))
def comment_dynamic(spark, sf):
    return P.comment_dynamic(B.raw_posts(spark, sf), B.ts(B.BATCH_TIME))


@query("B6", "SELECT event_id, user_id % 2 = 1 AS is_reply FROM events")
def is_reply_flag(spark, sf):
    odd = F.col("user_id") % 2 == 1
    mixed = F.when(F.col("event_id") % 2 == 0, odd.cast("string")).otherwise(odd.cast("int").cast("string"))
    return B.table(spark, sf, "events").select("event_id", fields.to_flag(mixed).alias("is_reply"))


@query("C7 M1", with_views(
    "SELECT DISTINCT id, post_url AS url, title, content, created_at FROM raw_posts WHERE id NOT IN (SELECT id FROM seen_ids)", "raw_posts", "seen_ids"))
def unseen_posts(spark, sf):
    return _combined(spark, sf)["post_static"]


@query("C7 D13 M1", with_views(
    """SELECT DISTINCT id, post_id, content, is_reply, created_at FROM raw_comments c
    WHERE NOT EXISTS (SELECT 1 FROM seen_ids s WHERE s.id = c.id)""", "raw_comments", "seen_ids"))
def unseen_comments(spark, sf):
    return _combined(spark, sf)["comment_static"]


@query("A5 M1", with_views(
    "SELECT DISTINCT id FROM (SELECT id FROM raw_posts UNION ALL SELECT id FROM raw_comments) WHERE id NOT IN (SELECT id FROM seen_ids)",
    "raw_posts", "raw_comments", "seen_ids"))
def new_ids(spark, sf):
    return _combined(spark, sf)["new_ids"]


@query("D13", with_views("SELECT DISTINCT id FROM raw_posts", "raw_posts"))
def distinct_ids(spark, sf):
    return P.post_static(B.raw_posts(spark, sf)).select("id").distinct()


@query("B24", with_views("SELECT id FROM posts WHERE title IS NULL", "posts"))
def required_rejects(spark, sf):
    return P.split_required(B.posts(spark, sf), schemas.POST_STATIC)[1].select("id")


@query("A1 A2 A19", with_views(
    "SELECT id, title, content, created_at, car_id, len(string_split(content, chr(10))) - 1 AS comments FROM raw_posts", "raw_posts"))
def raw_json_roundtrip(spark, sf):
    path = new_path(spark, "raw")
    posts = B.raw_posts(spark, sf).withColumns({"date": F.lit("2024-01-16"), "batch": F.lit(0)})
    raw.write_raw_posts(posts, path)
    read, _ = raw.read_raw_posts(spark, path, one_per_file=False)
    return read.select(
        fields.entity_id(F.col("community"), "post", F.col("post_id")).alias("id"), "title", "content",
        dates.parse_iso(F.col("created_at")).alias("created_at"), "car_id", F.size("comments").cast("long").alias("comments"),
    )


@query("A3", "SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN source END AS community FROM documents")
def community_from_path(spark, sf):
    folder = F.when(F.col("doc_id") % 7 != 0, "raw").otherwise("cooked")
    path = F.concat(F.lit("extracted/car/2024-01-16/0/"), folder, F.lit("/"), "source", F.lit("/"), "doc_id", F.lit(".json"))
    return B.table(spark, sf, "documents").select("doc_id", raw.community_from_path(path).alias("community"))


@query("B25 A1", """WITH d AS (SELECT doc_id, doc_id % 5 AS kind FROM documents)
    SELECT CASE WHEN kind < 3 THEN doc_id::VARCHAR END AS post_id, CASE WHEN kind < 3 AND doc_id % 3 = 0 THEN 7 END::INTEGER AS views,
    CASE WHEN kind < 3 THEN CASE WHEN doc_id % 2 = 0 THEN doc_id::BIGINT END END AS comment_id, CASE WHEN kind < 3 THEN 2 END::INTEGER AS comments,
    CASE kind WHEN 3 THEN 'no object' WHEN 4 THEN 'malformed' END AS reason, NULL AS odd FROM d
    UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, NULL, 'comment', '5' FROM d WHERE kind < 3 AND doc_id % 7 = 0""")
def corrupt_records(spark, sf):
    """Two documents in five are JSON null or cut off; others have counters out of range and ids of no number, or a comment that is none."""
    path = new_path(spark, "mixed")
    number = F.col("doc_id")
    comment = F.to_json(F.struct(F.when(number % 2 != 0, "none").otherwise(number.cast("string")).alias("comment_id"), F.lit("x").alias("content")))
    between = F.when(number % 7 == 0, ",5,").otherwise(",")
    views = F.when(number % 3 == 0, F.lit(7).cast("long")).otherwise(F.lit(7 << 40))
    post = F.to_json(F.struct(number.alias("post_id"), F.col("text").alias("content"), views.alias("view_count")))
    whole = F.concat(F.rtrim(post, F.lit("}")), F.lit(',"comments":['), comment, between, comment, F.lit("]}"))
    kind = number % 5
    line = F.when(kind == 3, "null").when(kind == 4, F.substring(whole, 1, 12)).otherwise(whole)
    lines = B.table(spark, sf, "documents").select(line.alias("value"), F.col("source").alias("community"))
    lines.write.partitionBy("community").text(path)
    posts, rejects = raw.read_raw_posts(spark, path, one_per_file=False, glob="*.txt")
    first = F.col("comments")[0]["comment_id"]
    none = [F.lit(None).cast(t).alias(n) for n, t in (("views", "int"), ("comment_id", "long"), ("comments", "int"))]
    good = posts.select(
        "post_id", F.col("view_count").alias("views"), first.alias("comment_id"), F.size("comments").alias("comments"),
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("odd"))
    return good.unionByName(rejects.select("post_id", *none, "reason", F.when(F.col("reason") == "comment", F.col("document")).alias("odd")))


@query("A4 A5", "SELECT DISTINCT source AS id FROM documents UNION SELECT 'doc_' || doc_id FROM documents")
def ledger_roundtrip(spark, sf):
    """A text ledger with blanks is imported, then two batches of ids are added, one of them twice."""
    text, path = new_path(spark, "ids"), new_path(spark, "ledger")
    docs = B.table(spark, sf, "documents")
    docs.select(F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "source", F.lit("  ")))).write.text(text)
    ledger.append_ledger(ledger.import_text_ledger(spark, text).unionByName(docs.select(F.col("source").alias("id"))), path, "import")
    for _ in range(2):
        ledger.append_ledger(docs.select(F.concat(F.lit("doc_"), "doc_id").alias("id")), path, "first")
    return ledger.read_ledger(spark, path)


@query("A4 A5 C7", with_views("SELECT DISTINCT id FROM raw_posts WHERE id NOT IN (SELECT id FROM seen_ids)", "raw_posts", "seen_ids"))
def ledger_compacted(spark, sf):
    """Known ids of many batches, folded but for one that runs again; then a batch reads the buckets of its ids."""
    path, seen = new_path(spark, "ledger"), B.seen_ids(spark, sf)
    batch = F.pmod(F.xxhash64("id"), F.lit(4))
    for n in range(4):
        ledger.append_ledger(seen.where(batch == n), path, f"b{n}")
    ledger.compact(spark, path, ["b0", "b1", "b2"])
    posts = P.post_static(B.raw_posts(spark, sf)).select("id")
    ledger.append_ledger(seen.where(batch == 1).unionByName(posts), path, "b1")  # known by mistake, and taken back by a rerun
    ledger.append_ledger(seen.where(batch == 1), path, "b1")
    return P.first_unseen(posts, ledger.read_ledger(spark, path, only=posts))


@query("A6", with_views("SELECT id, url, coalesce(title, '') AS title, content, created_at FROM posts", "posts"))
def typed_write(spark, sf):
    path = new_path(spark, "typed")
    tables.write_table(B.posts(spark, sf).na.fill("", ["title"]), path, schemas.POST_STATIC)
    return spark.read.parquet(path)


@query("A7 F3", "SELECT count(*) AS posts, true AS within_limit FROM documents")
def chunked_write(spark, sf):
    path = new_path(spark, "chunks")
    posts = B.posts(spark, sf).na.fill("", ["title"])
    tables.write_table(posts, path, schemas.POST_STATIC, rows_per_file=200)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("rows"))
    return files.agg(F.sum("rows").alias("posts"), (F.max("rows") <= 200).alias("within_limit"))


@query("A9", "SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 2 ELSE 1 END AS version FROM documents")
def overwrite_partitions(spark, sf):
    """A second write of two sources replaces their partitions and leaves the others."""
    path = new_path(spark, "static")
    docs = B.table(spark, sf, "documents").select("doc_id", "source")
    tables.write_table(docs.withColumn("version", F.lit(1)), path, mode="overwrite", partition_by=["source"])
    again = docs.where(F.col("source").isin("src1", "src2")).withColumn("version", F.lit(2))
    tables.write_table(again, path, mode="overwrite", partition_by=["source"])
    return spark.read.parquet(path).select("doc_id", "version")


@query("A12 M6", with_views("SELECT id, post_id, content, is_reply, created_at FROM comments", "comments"))
def append_load(spark, sf):
    folder = new_path(spark, "warehouse")
    for turn in (F.col("is_reply"), ~F.col("is_reply")):
        tables.load(B.comments(spark, sf).where(turn), folder, "comment_static")
    return spark.read.parquet(f"{folder}/comment_static")


@query("A13 C8 M6", with_views(
    """SELECT * FROM before WHERE id NOT IN (SELECT id FROM after WHERE view_count % 2 = 0) UNION ALL
    SELECT id, TIMESTAMP '2024-01-15', view_count, upvote_count, downvote_count, comment_count FROM after WHERE view_count % 2 = 0""", "before", "after"))
def upsert_load(spark, sf):
    """Half of the keys arrive again with newer counters, each of them twice."""
    folder = new_path(spark, "warehouse")
    tables.load(B.snapshot(spark, sf, B.BEFORE_TIME), folder, "post_dynamic")
    newer = B.snapshot(spark, sf, B.BATCH_TIME).where("view_count % 2 = 0").withColumn("extracted_at", B.ts(B.BEFORE_TIME))
    tables.load(newer.unionByName(newer), folder, "post_dynamic")
    return spark.read.parquet(f"{folder}/post_dynamic")


@query("A13", with_views("SELECT * FROM deltas WHERE id <> 'post_1' AND extracted_at < TIMESTAMP '2024-01-20' OR extracted_at >= TIMESTAMP '2024-01-20'", "deltas"))
def upsert_by_day(spark, sf):
    """Partitioned upsert: a batch of some days rewrites only those days."""
    path = new_path(spark, "by_day")
    rows = B.deltas(spark, sf).withColumn("day", F.to_date("extracted_at"))
    keys = ["id", "extracted_at"]
    early = rows.where(F.col("day") < "2024-01-20").where("id <> 'post_1'")
    tables.upsert_load(early, path, schemas.V_POST_DYNAMIC, keys, "day")
    tables.upsert_load(rows.where(F.col("day") >= "2024-01-20"), path, schemas.V_POST_DYNAMIC, keys, "day")
    tables.upsert_load(rows.where(F.col("day") >= "2024-01-20"), path, schemas.V_POST_DYNAMIC, keys, "day")
    return spark.read.parquet(path).select(*schemas.V_POST_DYNAMIC.names)


@query("A20", with_views("SELECT id, extracted_at FROM after", "after"))
def prefix_matched_load(spark, sf):
    """Chunks post_0 and post_1 are picked up, post_car is not."""
    folder = new_path(spark, "dynamic")
    rows = B.snapshot(spark, sf, B.BATCH_TIME)
    rows.where("view_count % 2 = 0").write.parquet(f"{folder}/post_0")
    rows.where("view_count % 2 <> 0").write.parquet(f"{folder}/post_1")
    B.post_car(spark, sf).write.parquet(f"{folder}/post_car")
    return tables.read_chunks(spark, folder, "post").select("id", "extracted_at")


@query("A8", "SELECT source, count(*) AS documents FROM documents GROUP BY 1")
def optional_read(spark, sf):
    found = tables.read_optional(spark, f"{sf}/documents.parquet")
    assert tables.read_optional(spark, f"{sf}/no_such_table.parquet") is None
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))


@query("A17", "SELECT 'car' || n_nationkey AS car_id, unnest([n_name, lower(n_name)]) AS keyword FROM nation")
def config_keywords(spark, sf):
    path = new_path(spark, "cars")
    cars = B.table(spark, sf, "nation").select(
        F.concat(F.lit("car"), "n_nationkey").alias("car_id"), F.array("n_name", F.lower("n_name")).alias("keywords"))
    listed = cars.agg(F.to_json(F.collect_list(F.struct("car_id", "keywords"))).alias("value"))  # configuration: 25 nations
    listed.write.text(path)
    return config.car_keywords(config.read_cars(spark, path))


_DAYS_SQL = """SELECT DISTINCT strftime(date_trunc('hour', o_orderdate), '%Y-%m-%d') AS date, (doc.n % 48) * 30 AS batch
    FROM orders, (SELECT unnest([0, 1, 20, 47]) AS n) doc"""


def _batches(spark, sf):
    minutes = F.explode(F.array(*[F.lit(30 * n) for n in (0, 1, 20, 47)]))
    return B.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).distinct().withColumn("batch", minutes)


@query("E5", f"""SELECT date, batch, lag(date) OVER w AS prev_date, lag(batch) OVER w AS prev_batch
    FROM ({_DAYS_SQL}) WINDOW w AS (ORDER BY date, batch)""")
def previous_batch(spark, sf):
    return batches.previous_batch(_batches(spark, sf))


@query("A18 M12", f"""SELECT date, '00:00:00' AS time, batch, prev_date, prev_batch FROM (SELECT date, batch,
    lag(date) OVER w AS prev_date, lag(batch) OVER w AS prev_batch FROM ({_DAYS_SQL}) WINDOW w AS (ORDER BY date, batch))
    ORDER BY date DESC, batch DESC LIMIT 1""")
def batch_ledger(spark, sf):
    """The newest batch is appended to the written list of the others."""
    path = new_path(spark, "batches")
    known = _batches(spark, sf).withColumn("time", F.lit("00:00:00"))
    top = known.agg(F.max(F.struct("date", "batch")).alias("t")).select("t.*")
    current = known.join(top, ["date", "batch"], "left_semi")
    known.join(top, ["date", "batch"], "left_anti").select("date", "time", "batch").write.parquet(path)
    return jobs.batch_ledger(spark, path, current)


@query("C1 B14 H14 M4", with_views(
    """SELECT a.id, a.extracted_at, a.view_count - coalesce(b.view_count, 0) AS v_view_count,
    a.upvote_count - coalesce(b.upvote_count, 0) AS v_upvote_count,
    a.downvote_count - coalesce(b.downvote_count, 0) AS v_downvote_count,
    a.comment_count - coalesce(b.comment_count, 0) AS v_comment_count FROM after a LEFT JOIN before b USING (id)""", "before", "after"))
def snapshot_delta(spark, sf):
    return delta.snapshot_delta(B.snapshot(spark, sf, B.BEFORE_TIME), B.snapshot(spark, sf, B.BATCH_TIME))


@query("B13 M4", with_views(
    """SELECT id, extracted_at, view_count AS v_view_count, upvote_count AS v_upvote_count,
    downvote_count AS v_downvote_count, comment_count AS v_comment_count FROM after""", "after"))
def delta_first_batch(spark, sf):
    return delta.snapshot_delta(None, B.snapshot(spark, sf, B.BATCH_TIME))


@query("A10 G3", with_views(
    """SELECT a.car_id, a.id, a.extracted_at, a.view_count - coalesce(b.view_count, 0) AS v_view_count
    FROM (SELECT *, 'car' || (view_count % 3) AS car_id FROM after) a
    LEFT JOIN (SELECT *, 'car' || (view_count % 3) AS car_id FROM before) b USING (car_id, id)""", "before", "after"))
def delta_by_car(spark, sf):
    """All cars in one job: snapshots are read with their car_id partition and joined on it."""
    folder = new_path(spark, "snapshots")
    for name, time in (("before", B.BEFORE_TIME), ("after", B.BATCH_TIME)):
        car = F.concat(F.lit("car"), F.col("view_count") % 3)
        B.snapshot(spark, sf, time).withColumn("car_id", car).write.partitionBy("car_id").parquet(f"{folder}/{name}")
    jobs.run_delta(spark, f"{folder}/before", f"{folder}/after", f"{folder}/delta", ["car_id", "id"])
    return spark.read.parquet(f"{folder}/delta").select("car_id", "id", "extracted_at", "v_view_count")


@query("E4", with_views("SELECT id, sum(length(content)) OVER (ORDER BY id ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative FROM posts", "posts"))
def running_length(spark, sf):
    rows = B.posts(spark, sf).select("id", F.length("content").alias("characters"))
    return balance.prefix_sum(rows, ["id"], F.col("characters")).select("id", "cumulative")


@query("J1 H15 M3", with_views(
    "SELECT source_id, floor(sum(coalesce(length(content), 0)) OVER (ORDER BY source_id ROWS UNBOUNDED PRECEDING) / 100000)::INTEGER AS partition_id FROM sources", "sources"))
def balanced_partition_id(spark, sf):
    from forumlens.workload.text_queries import title_default

    return balance.balance_by_length(title_default(spark, sf), "content", ["source_id"]).select("source_id", "partition_id")


@query("J1", with_views("SELECT true AS within, sum(length(content))::BIGINT AS characters FROM sources", "sources"))
def balanced_tasks(spark, sf):
    """No partition_id holds more than the limit and one row, and no task more than that or, beyond the most tasks, its share and one row."""
    from forumlens.workload.text_queries import title_default

    limit, source = 20_000, title_default(spark, sf)
    rows = balance.balance_by_length(source, "content", ["source_id"], limit).select("partition_id", F.length("content").alias("n"), F.spark_partition_id().alias("task"))
    held = rows.groupingSets([["task"], ["partition_id"]], "task", "partition_id").agg(F.sum("n").alias("n"), F.max("n").alias("longest"))
    beside, of_task = F.col("n") - F.col("longest"), F.col("task").isNotNull()  # without its longest row
    most = held.agg(F.max(F.when(of_task, beside)).alias("task"), F.max(F.when(~of_task, beside)).alias("part"), F.sum(F.when(of_task, F.col("n"))).alias("characters"))
    share = F.greatest(F.lit(limit), F.col("characters") / balance.MOST_TASKS)
    return most.select(((F.col("part") <= limit) & (F.col("task") <= share)).alias("within"), "characters")


@query("D12", "SELECT source, count(*) AS rows_written FROM documents GROUP BY source")
def counted_writes(spark, sf):
    """The count observed while writing is that of the table written."""
    path, docs = new_path(spark, "counted"), B.table(spark, sf, "documents")
    written = tables.write_counted(docs, path, "documents")
    read = spark.read.parquet(path)
    assert written == read.count()
    return read.groupBy("source").agg(F.count(F.lit(1)).alias("rows_written"))


@query("D12 M1", with_views(
    """SELECT 'post_static' AS output, count(DISTINCT id) AS rows_written FROM raw_posts WHERE id NOT IN (SELECT id FROM seen_ids)
    UNION ALL SELECT 'comment_static', count(DISTINCT id) FROM raw_comments c WHERE NOT EXISTS (SELECT 1 FROM seen_ids s WHERE s.id = c.id)""",
    "raw_posts", "raw_comments", "seen_ids"))
def combine_counts(spark, sf):
    """Rows of the statics of a batch, observed by the write of each."""
    made, out = _combined(spark, sf), new_path(spark, "combined")
    counts = [(name, tables.write_table(made[name], f"{out}/{name}", schemas.LOAD_KEYS[name][0])) for name in ("post_static", "comment_static")]
    return spark.createDataFrame(counts, "output string, rows_written long")


@query("A12 M6", with_views("SELECT id, url, coalesce(title, '') AS title, content, created_at FROM posts", "posts"))
def reload_batch(spark, sf):
    """Two batches are loaded, the first of them twice."""
    folder = new_path(spark, "warehouse")
    rows = B.posts(spark, sf).withColumn("title", F.coalesce("title", F.lit("")))
    even = F.col("id").substr(6, 20).cast("long") % 2 == 0
    for part, batch in ((rows.where(even), "1"), (rows.where(~even), "2"), (rows.where(even), "1")):
        tables.load(part, folder, "post_static", batch=batch)
    return spark.read.parquet(f"{folder}/post_static").drop(tables.BATCH)


@query("H15", "SELECT l_orderkey, l_linenumber, floor(l_partkey / 1000)::INTEGER AS bucket FROM lineitem")
def integer_bucket(spark, sf):
    return B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", balance.bucket(F.col("l_partkey"), 1000).alias("bucket"))


@query("M3", with_views("SELECT id, source_id, from_post, sentence FROM sentence", "sentence"))
def balanced_sentences(spark, sf):
    made = jobs.transform_static(B.posts(spark, sf), B.comments(spark, sf), B.LEXICON, balance_chars=100_000)
    return made["sentence"].drop("created_at")


@query("B15", "SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'")
def time_range(spark, sf):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10 00:00:00", "2024-01-12 00:00:00"))
    return B.table(spark, sf, "events").where(F.col("ts").between(start, end)).select("event_id", "ts")


@query("B16", """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN date_trunc('second', ts) > TIMESTAMP '2024-01-12' THEN 'OVER'
    WHEN date_trunc('second', ts) < TIMESTAMP '2024-01-10' THEN 'UNDER' ELSE 'IN' END AS range_class FROM events""")
def range_class(spark, sf):
    text = F.when(F.col("event_type") == "error", "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10 00:00:00", "2024-01-12 00:00:00"))
    return B.table(spark, sf, "events").select("event_id", dates.range_class(text, start, end).alias("range_class"))


@query("J2 M2", with_views("""SELECT 'sentence' AS output, count(*) AS n FROM sentence
    UNION ALL SELECT 'keyword_category', sum(n)::BIGINT FROM (SELECT count(*) AS n FROM sentence s, LATERAL (SELECT unnest(%s) AS k) WHERE contains(upper(s.sentence), k))""" % [
    k for keywords in B.LEXICON.values() for k in keywords], "sentence"))
def persisted_tags(spark, sf):
    """One frame, read once from the source, for two outputs; the rows of each are counted."""
    out = new_path(spark, "tags")
    source = jobs.transform_static(B.posts(spark, sf), B.comments(spark, sf), B.LEXICON)
    jobs.run_tags(source["post_static"], source["comment_static"], out, B.LEXICON)
    made = [spark.read.parquet(f"{out}/{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("output"), "n") for n in ("sentence", "keyword_category")]
    return made[0].unionByName(made[1])
