"""Queries of entity resolution and streaming's batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from skuweave.operators import resolve as R
from skuweave.operators import shape as H
from skuweave.plans.registry import query
from skuweave.plans.views import table, v_listing
from skuweave.sources.shared import cut, new_path


def _attributes(spark, sf):
    """Listings with their attributes, as a table: they are read more than once, and the patterns cost more than a read."""
    return cut(R.extract_attributes(v_listing(spark, sf).repartition("title_id")), "listings")


def _entity_of(listings):
    return listings.select(F.col("title_id").alias("id"), F.col("entity").alias("w"))


@query("er1_block_pairs", "SELECT a, b, legs FROM v_block")
def er1(spark, sf):
    return R.block_pairs(R.block_keys(_attributes(spark, sf)))


@query("er3_char_minhash")
def er3(spark, sf):
    """Listings that share a band of character 3-grams, 40 bands of 3; tests measure the recall against exact Jaccard."""
    return R.minhash_pairs(v_listing(spark, sf), "title_id", R.brand_shingles(), bands=40, rows=3)


@query("er2_minhash_pairs")
def er2(spark, sf):
    return R.minhash_pairs(table(spark, sf, "documents"), "doc_id", F.split("text", " "))


TOK = "list_distinct(string_split(text, ' '))"
EXACT = f"pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.t, b.t)) AS i, len(a.t) AS na, len(b.t) AS nb FROM (SELECT doc_id, {TOK} AS t FROM documents) a JOIN (SELECT doc_id, {TOK} AS t FROM documents) b ON a.doc_id < b.doc_id AND len(a.t) * 100 >= len(b.t) * 80 AND len(b.t) * 100 >= len(a.t) * 80)"


@query("er4_exact_jaccard", f"WITH {EXACT} SELECT a, b, round_even(i::DOUBLE / (na + nb - i), 4) AS jaccard FROM pairs WHERE i * 100 >= (na + nb - i) * 80")
def er4(spark, sf):
    return R.exact_jaccard_pairs(table(spark, sf, "documents"), "doc_id", F.split("text", " "))


@query("er10_components", f"WITH RECURSIVE {EXACT}, e AS (SELECT a, b FROM pairs WHERE i * 100 >= (na + nb - i) * 80), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.id) SELECT id, min(c) AS cluster_id FROM r GROUP BY id")
def er10(spark, sf):
    d = table(spark, sf, "documents")
    return R.clusters(d, R.similarity_edges(d, "doc_id", F.split("text", " ")), "doc_id")


LEGS = """p AS (SELECT x.a, x.b, i, na, nb FROM (SELECT a.title_id AS a, b.title_id AS b, len(list_intersect(a.toks, b.toks)) AS i, len(a.toks) AS na, len(b.toks) AS nb FROM v_attr a JOIN v_attr b ON a.title_id < b.title_id AND len(a.toks) * 100 >= len(b.toks) * 80 AND len(b.toks) * 100 >= len(a.toks) * 80) x),
 k AS (SELECT leg, id, CASE leg WHEN 'model' THEN 1 WHEN 'prefix' THEN 2 WHEN 'numbers' THEN 4 WHEN 'line' THEN 8 ELSE 16 END AS bit, key FROM v_key),
 keyed AS (SELECT x.id AS a, y.id AS b, bit_or(x.bit) AS bits, count(*) AS n_keys FROM k x JOIN k y ON x.leg = y.leg AND x.key = y.key AND x.id < y.id GROUP BY ALL),
 legs AS (SELECT coalesce(k.a, s.a) AS a, coalesce(k.b, s.b) AS b, (coalesce(k.bits, 0) | CASE WHEN s.a IS NULL THEN 0 ELSE 32 END)::INT AS bits, coalesce(n_keys, 0) AS n_keys
  FROM keyed k FULL JOIN (SELECT a, b FROM p WHERE i * 100 >= (na + nb - i) * 80) s ON s.a = k.a AND s.b = k.b)"""


def _legs(spark, sf, **options):
    return R.candidate_legs(_attributes(spark, sf), **options)


@query("er5_candidate_legs", f"WITH {LEGS} SELECT a, b, bits, n_keys FROM legs")
def er5(spark, sf):
    """Pairs of all blocking keys and of similar titles, with the legs that found them."""
    return _legs(spark, sf)


@query("er5_pruned_legs", f"WITH {LEGS} SELECT a, b, bits, n_keys FROM legs WHERE n_keys >= 2 OR bits & 49 > 0")
def er5_pruned(spark, sf):
    """Without pairs that only one weak key found."""
    return R.prune_legs(_legs(spark, sf))


@query("er5_pruning_loss", f"WITH {LEGS} SELECT count(*) AS pruned, count(*) FILTER (score > 0.72) AS over_the_bar, count(*) FILTER (score >= 0.33 AND score <= 0.72) AS in_review FROM legs JOIN v_scored USING (a, b) WHERE n_keys < 2 AND bits & 49 = 0")
def er5_loss(spark, sf):
    """How the pairs that pruning leaves out would have scored."""
    return R.pruning_loss(_attributes(spark, sf))


@query("er5_hybrid_legs")
def er5_hybrid(spark, sf):
    """With the MinHash legs, which SQL cannot express."""
    return _legs(spark, sf, minhash=True)


@query("st1_leg_union", f"WITH {LEGS} SELECT bits, count(*) AS n_pairs FROM legs GROUP BY bits")
def st1(spark, sf):
    """How many pairs each set of legs found."""
    return _legs(spark, sf).groupBy("bits").agg(F.count("*").alias("n_pairs"))


@query("er7_score_pairs", "SELECT a, b, conflicts, score, brand_ok, state_differs FROM v_scored")
def er7(spark, sf):
    x = _attributes(spark, sf)
    return R.score_blocks(R.Keyed(R.block_keys(x)), x)


@query("er8_route_funnel", "SELECT route, reason, count(*) AS n FROM v_routed GROUP BY route, reason")
def er8(spark, sf):
    x = _attributes(spark, sf)
    return R.route_funnel(R.block_keys(x), x)


@query("er9_adjudicated", "SELECT a, b, route, same, reason FROM v_judged")
def er9(spark, sf):
    x = _attributes(spark, sf)
    return R.adjudicate(R.routed_blocks(R.block_keys(x), x)).select("a", "b", "route", "same", "reason")


@query("er11_guarded_clusters")
def er11(spark, sf):
    x = _attributes(spark, sf)
    return R.resolved(R.block_keys(x), x)


#: Clusters of all pairs that are the same, without a guard, as SQL.
CLUSTERED = "WITH RECURSIVE s AS (SELECT a, b FROM v_judged WHERE same UNION SELECT b, a FROM v_judged WHERE same), r AS (SELECT title_id AS id, title_id AS c FROM v_listing UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.id), k AS (SELECT id, min(c) AS cluster_id FROM r GROUP BY id)"


def _clustered(spark, sf):
    """Listings with the cluster that their pairs give."""
    x = _attributes(spark, sf)
    return R.clusters(v_listing(spark, sf), R.same_pairs(R.block_keys(x), x).select("a", "b"), "title_id")


def _entities(spark, sf):
    t = v_listing(spark, sf)
    return t.join(t.groupBy("entity").agg(F.min("title_id").alias("cluster_id")), "entity").select(F.col("title_id").alias("id"), "cluster_id")


@query("er12_nodes", CLUSTERED + " SELECT cluster_id, arg_min(title, id) AS title, count(*) AS n, string_agg(CAST(id AS VARCHAR), '|' ORDER BY id) AS members, string_agg(DISTINCT market, '|' ORDER BY market) AS markets FROM k JOIN v_listing ON title_id = id GROUP BY cluster_id")
def er12(spark, sf):
    return R.nodes(_clustered(spark, sf), v_listing(spark, sf))


def _shop_listings(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    seller = F.concat(F.left(F.md5("p_name"), F.lit(8)), F.when(k % 3 == 0, "").when(k % 3 == 1, " co").otherwise(".kr"))
    number = F.when(k % 5 < 2, "").otherwise(F.concat(F.lit("R"), F.left(F.md5(F.concat("p_name", F.lit("r"))), F.lit(1))))
    return p.select(k.alias("id"), (k % 4).alias("marketplace"), seller.alias("seller"), number.alias("registration"), (k % 50 == 0).alias("official"))


SHOPS = "SELECT p_partkey AS id, p_partkey % 4 AS marketplace, concat(left(md5(p_name), 8), CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' co' ELSE '.kr' END) AS seller, CASE WHEN p_partkey % 5 < 2 THEN '' ELSE concat('R', left(md5(concat(p_name, 'r')), 1)) END AS registration, p_partkey % 50 = 0 AS official FROM part"
FRONTS = f"SELECT marketplace, seller, min(id) AS front_id, count(*) AS listings, max(registration) AS registration, max(official) AS official FROM ({SHOPS}) GROUP BY marketplace, seller"


@query("er13_storefronts", FRONTS)
def er13(spark, sf):
    return R.storefronts(_shop_listings(spark, sf))


GRAMS = "list_distinct(list_transform(range(1, greatest(length(x), 2)), lambda i: substr(x, i, 2)))"


@query(
    "er14_seller_clusters",
    f"WITH RECURSIVE f AS (SELECT *, {GRAMS} AS g FROM (SELECT *, lower(replace(seller, ' ', '')) AS x FROM ({FRONTS}))), e AS (SELECT a.front_id AS a, b.front_id AS b FROM f a JOIN f b ON a.front_id <> b.front_id WHERE CASE WHEN a.registration <> '' AND b.registration <> '' THEN a.registration = b.registration ELSE len(list_intersect(a.g, b.g)) * 100 >= 60 * len(list_distinct(list_concat(a.g, b.g))) END), "
    "r AS (SELECT front_id AS id, front_id AS c FROM f UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id), k AS (SELECT id, min(c) AS cluster_id FROM r GROUP BY id) "
    "SELECT cluster_id, coalesce(arg_min(registration, front_id) FILTER (registration <> ''), '') AS registration, string_agg(DISTINCT seller, '|' ORDER BY seller) AS names, count(*) AS fronts, CAST(sum(listings) AS BIGINT) AS listings, string_agg(DISTINCT CAST(marketplace AS VARCHAR), '|' ORDER BY CAST(marketplace AS VARCHAR)) AS markets, max(official) AS official, count(DISTINCT seller) > 1 AS multi FROM k JOIN f ON front_id = id GROUP BY cluster_id",
)
def er14(spark, sf):
    c = R.seller_clusters(R.storefronts(_shop_listings(spark, sf)))
    return c.withColumns({"names": F.array_join("names", "|"), "markets": F.array_join(F.transform("markets", lambda m: m.cast("string")), "|")})


@query("er15_truth_pairs", "SELECT a.title_id AS a, b.title_id AS b FROM v_listing a JOIN v_listing b ON a.entity = b.entity AND a.title_id < b.title_id")
def er15(spark, sf):
    return R.truth_pairs(v_listing(spark, sf), "title_id", "entity")


METRICS = "SELECT tp, fp, fn, round_even(tp::DOUBLE / nullif(tp + fp, 0), 4) AS precision, round_even(tp::DOUBLE / nullif(tp + fn, 0), 4) AS recall, round_even(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 4) AS f1"
TRUTH = "SELECT a.title_id AS a, b.title_id AS b, a.entity FROM v_listing a JOIN v_listing b ON a.entity = b.entity AND a.title_id < b.title_id"


@query("er16_pair_metrics", f"WITH t AS ({TRUTH}), m AS (SELECT count(*) FILTER (t.a IS NOT NULL AND f.a IS NOT NULL) AS tp, count(*) FILTER (t.a IS NULL) AS fp, count(*) FILTER (f.a IS NULL) AS fn FROM t FULL JOIN v_block f ON t.a = f.a AND t.b = f.b) {METRICS} FROM m")
def er16(spark, sf):
    x = _attributes(spark, sf)
    return R.block_metrics(R.block_keys(x), _entity_of(x))


SHELVES = "k AS (SELECT title_id AS id, min(title_id) OVER (PARTITION BY split_part(entity, '|', 1), category) AS cluster_id FROM v_listing)"


def _shelves(spark, sf):
    """Clusters that mix products: all of a brand and category."""
    t = v_listing(spark, sf).withColumn("brand", F.split_part("entity", F.lit("|"), F.lit(1)))
    return t.join(t.groupBy("brand", "category").agg(F.min("title_id").alias("cluster_id")), ["brand", "category"]).select(F.col("title_id").alias("id"), "cluster_id")


@query("er17_traps", f"WITH {SHELVES} SELECT x.title_id AS a, y.title_id AS b, concat('same model: ', x.category) AS label, ka.cluster_id <> kb.cluster_id AS kept_separate FROM v_listing x JOIN v_listing y ON y.title_id = x.title_id + 40 JOIN k ka ON ka.id = x.title_id JOIN k kb ON kb.id = y.title_id")
def er17(spark, sf):
    t = v_listing(spark, sf)
    traps = t.select(F.col("title_id").alias("a"), (F.col("title_id") + 40).alias("b"), F.concat(F.lit("same model: "), "category").alias("label"))
    return R.trap_report(traps.join(t.select(F.col("title_id").alias("b")), "b", "left_semi"), _shelves(spark, sf))


@query("er17_cluster_counts", f"WITH {SHELVES}, j AS (SELECT cluster_id, entity FROM k JOIN v_listing ON title_id = id), m AS (SELECT cluster_id, count(DISTINCT entity) AS n FROM j GROUP BY cluster_id), q AS (SELECT entity, count(DISTINCT cluster_id) AS n FROM j GROUP BY entity) SELECT (SELECT count(*) FROM q) AS entities, (SELECT count(*) FROM q WHERE n > 1) AS split, (SELECT count(*) FROM m) AS clusters, (SELECT count(*) FROM m WHERE n > 1) AS mixed")
def er17_counts(spark, sf):
    return R.cluster_counts(_shelves(spark, sf), v_listing(spark, sf), "title_id", "entity")


@query("er18_split_clusters", "SELECT id, cluster_id, CASE WHEN id % 3 = 0 OR cluster_id % 5 = 0 THEN 0 ELSE CAST(1 + id % 2 AS INT) END AS part FROM v_entity")
def er18(spark, sf):
    c, t = _entities(spark, sf), v_listing(spark, sf)
    known = c.where("cluster_id % 5 <> 0 AND id % 3 <> 0").join(t.select(F.col("title_id").alias("id"), "title"), "id")
    return R.split_clusters(c, t, known.select("cluster_id", "title", (1 + F.col("id") % 2).alias("grp")))


@query("er19_split_candidates", "SELECT cluster_id, count(DISTINCT title) AS titles, count(*) AS n FROM v_entity JOIN v_listing ON title_id = id GROUP BY cluster_id HAVING count(DISTINCT title) >= 2 ORDER BY titles DESC, cluster_id LIMIT 12")
def er19(spark, sf):
    return R.split_candidates(_entities(spark, sf), v_listing(spark, sf))


@query("er20_mixed_lines", f"WITH {SHELVES} SELECT cluster_id, count(DISTINCT id) AS n, count(DISTINCT lines[1]) > 1 AS mixed FROM k JOIN v_attr ON title_id = id GROUP BY cluster_id")
def er20(spark, sf):
    return R.mixed_lines(_shelves(spark, sf), R.extract_attributes(v_listing(spark, sf)))


HELD = "left(md5(entity), 1) < '4'"


@query("qv10_held_out_report", f"WITH t AS ({TRUTH}), x AS (SELECT f.a, f.b FROM v_block f), h AS (SELECT title_id, CASE WHEN {HELD} THEN 'held out' ELSE 'in sample' END AS part FROM v_listing), m AS (SELECT part, count(*) FILTER (hit = 2) AS tp, count(*) FILTER (hit = 1) AS fp, count(*) FILTER (hit = 0) AS fn FROM (SELECT ha.part, CASE WHEN t.a IS NOT NULL AND f.a IS NOT NULL THEN 2 WHEN t.a IS NULL THEN 1 ELSE 0 END AS hit FROM t FULL JOIN x f ON t.a = f.a AND t.b = f.b JOIN h ha ON ha.title_id = coalesce(t.a, f.a) JOIN h hb ON hb.title_id = coalesce(t.b, f.b) WHERE ha.part = hb.part) GROUP BY part) {METRICS}, part FROM m")
def qv10(spark, sf):
    t = v_listing(spark, sf)
    part = t.select("title_id", F.when(F.left(F.md5("entity"), F.lit(1)) < "4", "held out").otherwise("in sample").alias("part"))
    return H.metrics_by_part(R.truth_pairs(t, "title_id", "entity"), R.block_pairs(R.block_keys(R.extract_attributes(t))), part, "title_id")


@query("qv10_pair_coverage", f"SELECT t.a, t.b, f.a IS NOT NULL AS covered, coalesce(f.legs, '') AS legs FROM ({TRUTH}) t LEFT JOIN v_block f ON t.a = f.a AND t.b = f.b")
def qv10_coverage(spark, sf):
    x = _attributes(spark, sf)
    return R.truth_coverage(R.block_keys(x), _entity_of(x))


@query("qv11_blockers", f"WITH t AS ({TRUTH}), f AS (SELECT DISTINCT x.leg, x.id AS a, y.id AS b FROM v_key x JOIN v_key y ON x.leg = y.leg AND x.key = y.key AND x.id < y.id), u AS (SELECT * FROM f UNION SELECT 'all', a, b FROM f) SELECT leg, count(*) AS candidates, count(t.a) AS hits, round_even(count(t.a)::DOUBLE / (SELECT count(*) FROM t), 4) AS recall, round_even(count(t.a)::DOUBLE / count(*), 4) AS precision FROM u LEFT JOIN t ON t.a = u.a AND t.b = u.b GROUP BY leg")
def qv11(spark, sf):
    x = _attributes(spark, sf)
    return R.leg_table(R.block_keys(x), _entity_of(x))


@query("stm1_daily_last", "SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, struct_pack(t := ts, e := event_id)) AS value FROM events GROUP BY ALL")
def stm1(spark, sf):
    from skuweave.streaming.jobs import latest_per_day

    return latest_per_day(table(spark, sf, "events"))


@query("stm2_tumbling_counts", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL")
def stm2(spark, sf):
    from skuweave.streaming.jobs import tumbling_counts

    return tumbling_counts(table(spark, sf, "events"), "1 day").select("event_type", F.to_date("start").alias("day"), "n")


@query("stm6_first_wins", "SELECT user_id, event_type, arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id FROM events GROUP BY ALL")
def stm6(spark, sf):
    from skuweave.streaming.jobs import first_wins

    return first_wins(table(spark, sf, "events").select("ts", "event_id", "user_id", "event_type"), ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


def _stream(spark, sf, name, schema):
    """A table as a stream of files."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _run(spark, stream, name, mode="append"):
    """What a stream gives until its source ends, read back from the shared folder."""
    path = new_path(spark, name)
    if mode == "append":
        stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    else:
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out/batch={n}")).start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("stm1_upsert_stream", "SELECT user_id, day, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY user_id, day")
def stm1_upsert(spark, sf):
    """The daily snapshot written by a stream, batch by batch, into the buckets of its keys."""
    from skuweave.sources.keyed import KeyedTable
    from skuweave.streaming.jobs import upsert_batches

    events = table(spark, sf, "events")
    rows = _stream(spark, sf, "events", events.schema).select("user_id", F.to_date("ts").alias("day"), "value", "event_id")
    path = new_path(spark, "daily")
    daily = KeyedTable(spark, f"{path}/table", ["user_id", "day"], rows.schema)
    upsert_batches(rows, daily, ["event_id"], f"{path}/state").awaitTermination()
    return daily.read()


#: Events in two arrivals: the second has every tenth event of the old days, then the newest days.
ARRIVALS = """e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, value, event_id, event_id % 10 = 3 AS behind, ts <= (SELECT max(ts) - INTERVAL 5 DAY FROM events) AS early FROM events),
 seen AS (SELECT CAST(max(ts) AS DATE) - 2 AS bar FROM e WHERE early AND NOT behind), late AS (SELECT e.* FROM e, seen WHERE (behind OR NOT early) AND day < bar)"""


def _late_job(spark, sf):
    from skuweave.sources.keyed import KeyedTable
    from skuweave.streaming.jobs import daily_with_late_side

    events = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "ts", "value", "event_id")
    last = events.agg(F.max("ts")).first()[0]
    second = (F.col("event_id") % 10 == 3) | (F.col("ts") > F.lit(last) - F.expr("interval 5 days"))
    path = new_path(spark, "late-job")
    daily = KeyedTable(spark, f"{path}/table", ["user_id", "day"], events.schema)
    for n, part in enumerate((events.where(~second), events.where(second))):
        part.coalesce(1).write.mode("append").parquet(f"{path}/in")  # the stream runs after each arrival
        daily_with_late_side(spark.readStream.schema(events.schema).parquet(f"{path}/in"), daily, f"{path}/late", f"{path}/state").awaitTermination()
    return daily, f"{path}/late"


@query("stm5_late_side", f"WITH {ARRIVALS} SELECT day, count(*) AS n_late FROM late GROUP BY day")
def stm5_late(spark, sf):
    """How many rows of each day came behind the newest time by more than two days."""
    from skuweave.streaming.jobs import late_counts

    return late_counts(*_late_job(spark, sf))


@query("stm5_replayed", f"WITH {ARRIVALS} SELECT user_id, day, arg_max(value, ts) AS value FROM e GROUP BY user_id, day")
def stm5_replayed(spark, sf):
    """The daily table after the late rows were merged into their days."""
    from skuweave.streaming.jobs import replay_late

    daily, late = _late_job(spark, sf)
    replay_late(daily, late)
    return daily.read().select("user_id", "day", "value")


@query("snk3_replaced_buckets", "SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 100 = 7 THEN -c_custkey ELSE c_custkey END AS mark FROM customer")
def snk3_replaced(spark, sf):
    """A table of key buckets after the rows of some keys were replaced in place."""
    from skuweave.sources.keyed import KeyedTable

    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_custkey").alias("mark"))
    kept = KeyedTable(spark, new_path(spark, "customers"), ["c_custkey"], c.schema)
    kept.replace(c)
    kept.replace(c.where("c_custkey % 100 = 7").withColumn("mark", -F.col("mark")))
    return kept.read()


@query("stm4_velocity", "SELECT user_id, ts, (value - lag(value) OVER w) / greatest(1, floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 86400000000)) AS delta FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def stm4(spark, sf):
    """Velocity of each user's values, kept as state over the stream of events."""
    from skuweave.streaming.jobs import velocity

    events = table(spark, sf, "events")
    return _run(spark, velocity(_stream(spark, sf, "events", events.schema).select("user_id", "ts", "value")), "velocity").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stm5_rerun_days", "SELECT user_id, day, CASE WHEN day = DATE '2024-01-05' THEN -v ELSE v END AS value FROM (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, struct_pack(t := ts, e := event_id)) AS v FROM events GROUP BY ALL) WHERE NOT (day = DATE '2024-01-05' AND user_id % 2 = 1)")
def stm5(spark, sf):
    """A run for an old day replaces that day only, also where it has fewer rows."""
    from skuweave.streaming.jobs import latest_per_day, rerun_days

    daily = latest_per_day(table(spark, sf, "events"))
    again = daily.where("day = date'2024-01-05' and user_id % 2 = 0").withColumn("value", -F.col("value"))
    return rerun_days(daily, again)


@query("stm7_work_status", "WITH r AS (SELECT concat('C', CAST(user_id AS VARCHAR)) AS uid, event_id, CASE event_type WHEN 'error' THEN 'fault' ELSE 'quota' END AS outcome FROM events), c AS (SELECT uid, count(*) FILTER (outcome = 'fault') AS f FROM r GROUP BY uid) SELECT uid, CASE WHEN f >= 5 THEN 'error' ELSE 'pending' END AS status, f::INT AS attempts FROM c")
def stm7(spark, sf):
    """Work states: failures count as attempts up to the cap, quota failures do not."""
    from skuweave.streaming.jobs import work_status

    events = table(spark, sf, "events")
    rows = _stream(spark, sf, "events", events.schema).select(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("uid"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "fault").otherwise("quota").alias("outcome"))
    last = _run(spark, work_status(rows), "status", "update").groupBy("uid").agg(F.max_by(F.struct("status", "attempts"), "batch").alias("s"))
    return last.select("uid", "s.*")


@query("stm8_new_products", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def stm8(spark, sf):
    from skuweave.streaming.jobs import new_keys

    known = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"))
    events = table(spark, sf, "events")
    return _run(spark, new_keys(_stream(spark, sf, "events", events.schema), known, "user_id", late="3650 days"), "new-products").distinct()
