"""Column functions, encoders, vectors, text and window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.functions import columns as C
from causeway.functions import text as X
from causeway.functions import vectors as V
from causeway.operators import ordered, windows
from causeway.plans.common import MEDIA_SQL, PANEL_SQL, POINTS, carried_sql, media_daily, month_index, orders_panel
from causeway.plans.registry import query
from causeway.plans.relational import _CURVE, quantity_curve
from causeway.sources.tables import load

# ---------------------------------------------------------------- dates and numbers


@query("f1_lenient_date", """
SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS day
FROM orders""")
def f1_lenient_date(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return load(spark, sf, "orders").select("o_orderkey", C.parse_date(text).alias("day"))


@query("f2_axis_to_date", f"""WITH {PANEL_SQL} SELECT grp AS "group", time,
CAST(DATE '2000-01-01' + CAST(time - (SELECT min(time) FROM panel) AS INTEGER) AS DATE) AS ds FROM panel""")
def f2_axis_to_date(spark, sf):
    rows = orders_panel(spark, sf)
    origin = rows.agg(F.min("time").alias("origin"))
    return rows.crossJoin(F.broadcast(origin)).select(
        "group", "time", C.axis_to_date(F.col("time"), F.col("origin")).alias("ds"))


@query("f3_logs_and_powers", """SELECT p_partkey, round(ln(p_retailprice), 8) AS ln_price, round(ln(1 + p_size), 8) AS ln1p_size,
round(exp(p_size / 10.0), 6) AS exp_size, round(sqrt(p_retailprice), 8) AS root, round(pow(p_size, 0.7), 8) AS powered FROM part""")
def f3_logs_and_powers(spark, sf):
    part = load(spark, sf, "part")
    C.require_positive(part, ["p_retailprice"])
    return part.select(
        "p_partkey", F.round(F.ln("p_retailprice"), 8).alias("ln_price"), F.round(F.log1p("p_size"), 8).alias("ln1p_size"),
        F.round(F.exp(F.col("p_size") / 10.0), 6).alias("exp_size"), F.round(F.sqrt("p_retailprice"), 8).alias("root"),
        F.round(F.pow("p_size", F.lit(0.7)), 8).alias("powered"))


@query("f4_interval_dummies", f"""WITH {PANEL_SQL} SELECT grp AS "group", time,
CAST(time >= 27 AND time < 54 AS INTEGER) AS d1, CAST(time >= 54 AS INTEGER) AS d2, CAST(time = 27 AS INTEGER) AS at1 FROM panel""")
def f4_interval_dummies(spark, sf):
    t = F.col("time")
    return orders_panel(spark, sf).select(
        "group", "time", C.interval_dummy(t, 27, 54).alias("d1"), C.interval_dummy(t, 54).alias("d2"),
        C.interval_dummy(t, 27, 28).alias("at1"))


@query("f5_period_label", f"""WITH {PANEL_SQL} SELECT grp AS "group", time, CASE WHEN time < 27 THEN 'Pre-intervention'
WHEN time < 54 THEN 'Intervention_D_1' ELSE 'Intervention_D_2' END AS label FROM panel""")
def f5_period_label(spark, sf):
    return orders_panel(spark, sf).select("group", "time", C.period_label(F.col("time"), POINTS).alias("label"))


@query("f6_one_hot_drop_first", """SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS "c_mktsegment_BUILDING",
CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS "c_mktsegment_FURNITURE",
CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS "c_mktsegment_HOUSEHOLD",
CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS "c_mktsegment_MACHINERY" FROM customer""")
def f6_one_hot_drop_first(spark, sf):
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return C.OneHot.fit(rows, ["c_mktsegment"]).transform(rows).drop("c_mktsegment")


@query("f7_ordinal", """SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1
WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 END AS BIGINT) AS priority FROM orders""")
def f7_ordinal(spark, sf):
    levels = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    return load(spark, sf, "orders").select("o_orderkey", C.ordinal(F.col("o_orderpriority"), levels).alias("priority"))


@query("f8_one_hot_all_strings", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(l_returnflag = 'N' AS INTEGER) AS "l_returnflag_N", CAST(l_returnflag = 'R' AS INTEGER) AS "l_returnflag_R",
CAST(l_linestatus = 'O' AS INTEGER) AS "l_linestatus_O" FROM lineitem""")
def f8_one_hot_all_strings(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    texts = C.string_columns(rows)
    return C.OneHot.fit(rows, texts).transform(rows).drop(*texts)


@query("f9_even_grid", """WITH r AS (SELECT p_brand, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1)
SELECT p_brand, round(lo + i * (hi - lo) / 49.0, 7) AS x FROM r CROSS JOIN range(50) g(i)""")
def f9_even_grid(spark, sf):
    ranges = load(spark, sf, "part").groupBy("p_brand").agg(
        F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"))
    return C.even_grid(ranges, F.col("lo"), F.col("hi"), 50).select("p_brand", F.round("x", 7).alias("x"))


@query("f10_mean_scaler", f"""WITH {MEDIA_SQL}, s AS (SELECT avg(x) AS mx, avg(spend) AS ms FROM media WHERE d < DATE '2024-01-21')
SELECT d AS date, channel, round(x / mx, 8) AS x, round(spend / ms, 8) AS spend, round(x / mx * mx, 6) AS x_back
FROM media CROSS JOIN s""")
def f10_mean_scaler(spark, sf):
    rows = media_daily(spark, sf)
    scaler = C.MeanScaler.fit(rows.filter(F.col("date") < F.lit("2024-01-21").cast("date")), ["x", "spend"])
    scaled = scaler.transform(rows)
    back = scaler.inverse(scaled.withColumn("x_back", F.col("x")), {"x_back": "x"})
    return back.select("date", "channel", F.round("x", 8).alias("x"), F.round("spend", 8).alias("spend"),
                       F.round("x_back", 6).alias("x_back"))


@query("f11_hill", f"""WITH {MEDIA_SQL} SELECT d AS date, channel,
round(CASE WHEN spend <= 0 THEN 0 ELSE pow(spend, 0.8) / (pow(spend, 0.8) + pow(2500.0, 0.8)) END, 8) AS saturated FROM media""")
def f11_hill(spark, sf):
    return media_daily(spark, sf).select(
        "date", "channel", F.round(C.hill(F.col("spend"), 2500.0, 0.8), 8).alias("saturated"))


@query("f12_calendar_terms", """WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
 t AS (SELECT day, date_diff('day', DATE '1995-01-01', day) / 365.25::DOUBLE AS ct FROM o)
SELECT day, round(sin(2*pi()*ct), 8) AS sin1, round(cos(2*pi()*ct), 8) AS cos1, round(sin(4*pi()*ct), 8) AS sin2,
 round(cos(4*pi()*ct), 8) AS cos2, round(ct, 8) AS ct, round(sqrt(ct), 8) AS ct_sqrt, isodow(day) AS weekday,
 round(CASE WHEN month(day) = 6 THEN ct ELSE 0 END, 8) AS ct_june FROM t""")
def f12_calendar_terms(spark, sf):
    days = load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    ct = F.date_diff("day", F.lit("1995-01-01").cast("date")) / F.lit(365.25)
    s1, c1, s2, c2 = C.fourier(ct, 1.0, 2)
    june = C.month_trend(F.col("day"), ct)[5]
    named = {"sin1": s1, "cos1": c1, "sin2": s2, "cos2": c2, "ct": ct, "ct_sqrt": F.sqrt(ct), "ct_june": june}
    return days.select("day", *[F.round(v, 8).alias(k) for k, v in named.items()],
                       (F.weekday("day") + 1).cast("bigint").alias("weekday"))


@query("f13_trend_hinges", f"""WITH {PANEL_SQL} SELECT grp AS "group", time, CAST(greatest(time - 20.0, 0) AS DOUBLE) AS h20,
CAST(greatest(time - 40.5, 0) AS DOUBLE) AS h40 FROM panel""")
def f13_trend_hinges(spark, sf):
    t = F.col("time").cast("double")
    return orders_panel(spark, sf).select("group", "time", C.hinge(t, 20.0).alias("h20"), C.hinge(t, 40.5).alias("h40"))


# ---------------------------------------------------------------- vectors and text

_LABELS_SQL = """cells AS (SELECT label, unnest(range(0, 64)) AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings),
 cent AS (SELECT label, dim, avg(v) AS v FROM cells GROUP BY 1, 2)"""


@query("f14_dot_product", """SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * i)), 6) AS dot FROM embeddings""")
def f14_dot_product(spark, sf):
    weights = F.array(*[F.lit(float(i)) for i in range(1, 65)])
    return load(spark, sf, "embeddings").select("vec_id", F.round(V.dot(F.col("embedding"), weights), 6).alias("dot"))


@query("f15_norms", """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS l1,
round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS l2 FROM embeddings""")
def f15_norms(spark, sf):
    v = F.col("embedding")
    return load(spark, sf, "embeddings").select(
        "vec_id", F.round(V.norm_l1(v), 6).alias("l1"), F.round(V.norm_l2(v), 6).alias("l2"))


@query("f16_linear_map", """SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda j: embedding[j]::DOUBLE * (j % 5 - 2))), 6) AS y1,
round(list_sum(list_transform(range(1, 65), lambda j: embedding[j]::DOUBLE * (3 * j % 7 - 3))), 6) AS y2 FROM embeddings""")
def f16_linear_map(spark, sf):
    """All 64 components to two, by a matrix of whole numbers."""
    matrix = [[j % 5 - 2 for j in range(1, 65)], [3 * j % 7 - 3 for j in range(1, 65)]]
    mapped = V.linear_map(F.col("embedding"), matrix)
    return load(spark, sf, "embeddings").select("vec_id", mapped.alias("y")).select(
        "vec_id", F.round(F.col("y")[0], 6).alias("y1"), F.round(F.col("y")[1], 6).alias("y2"))


@query("f17_matrix_product", f"""WITH {_LABELS_SQL} SELECT a.label::BIGINT AS i, b.label::BIGINT AS j, round(sum(a.v * b.v), 8) AS v
FROM cent a JOIN cent b USING (dim) GROUP BY 1, 2""")
def f17_matrix_product(spark, sf):
    cells = load(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x"))
    centroids = cells.groupBy(F.col("label").cast("bigint").alias("i"), F.col("dim").alias("j")).agg(
        F.avg(F.col("x").cast("double")).alias("v"))
    return V.matrix_product(centroids, V.transpose(centroids)).withColumn("v", F.round("v", 8))


@query("f18_strip_class", "SELECT doc_id, regexp_replace(text, '[a-z, !]', '', 'g') AS kept FROM documents")
def f18_strip_class(spark, sf):
    return load(spark, sf, "documents").select("doc_id", X.strip_class(F.col("text"), "[a-z, !]").alias("kept"))


@query("f19_distinct_chars", """WITH p AS (SELECT doc_id, unnest(range(1, length(text) + 1)) AS i, text FROM documents),
 c AS (SELECT doc_id, substr(text, i, 1) AS ch, min(i) AS pos FROM p GROUP BY 1, 2)
SELECT doc_id, string_agg(ch, '' ORDER BY pos) AS chars FROM c GROUP BY 1""")
def f19_distinct_chars(spark, sf):
    return load(spark, sf, "documents").select("doc_id", X.distinct_chars(F.col("text")).alias("chars"))


@query("f20_concat_descending", """SELECT label::BIGINT AS label, string_agg(n::VARCHAR, '' ORDER BY n DESC) AS joined FROM
 (SELECT label, vec_id % 7 AS k, count(*) AS n FROM embeddings GROUP BY 1, 2) GROUP BY 1""")
def f20_concat_descending(spark, sf):
    counts = load(spark, sf, "embeddings").groupBy("label", (F.col("vec_id") % 7).alias("k")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.groupBy(F.col("label").cast("bigint").alias("label")).agg(
        X.concat_descending(F.collect_list("n")).alias("joined"))


@query("f21_codes_to_text", "SELECT p_partkey, p_name AS name FROM part")
def f21_codes_to_text(spark, sf):
    codes = F.transform(F.split("p_name", ""), lambda c: F.ascii(c))
    return load(spark, sf, "part").select("p_partkey", X.codes_to_text(codes).alias("name"))


# ---------------------------------------------------------------- windows


@query("w1_elapsed_time", """WITH o AS (SELECT o_custkey, o_orderkey, (year(o_orderdate)-1995)*12+month(o_orderdate)-1 AS m FROM orders)
SELECT o_custkey, o_orderkey, CAST(m - min(m) OVER (PARTITION BY o_custkey) + 1 AS BIGINT) AS t FROM o""")
def w1_elapsed_time(spark, sf):
    rows = load(spark, sf, "orders").select("o_custkey", "o_orderkey", month_index("o_orderdate").alias("m"))
    return windows.elapsed(rows, ["o_custkey"], "m").drop("m")


@query("w2_running_rows_in_period", """WITH o AS (SELECT o_orderkey, o_orderpriority,
 (year(o_orderdate)-1995)*12+month(o_orderdate)-1 AS m FROM orders)
SELECT o_orderkey, CAST(CASE WHEN m >= 27 AND m < 54 THEN sum(CASE WHEN m >= 27 AND m < 54 THEN 1 ELSE 0 END)
 OVER (PARTITION BY o_orderpriority ORDER BY m RANGE UNBOUNDED PRECEDING) ELSE 0 END AS BIGINT) AS timedelta FROM o""")
def w2_running_rows_in_period(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", month_index("o_orderdate").alias("m"))
    inside = C.interval_dummy(F.col("m"), 27, 54)
    counted = windows.running_rows(rows, ["o_orderpriority"], "m", inside, "n", calendar=True)
    return counted.select("o_orderkey", F.when(inside == 1, F.col("n")).otherwise(0).alias("timedelta"))


@query("w2_running_rows_fine_time", """SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE UNBOUNDED PRECEDING) AS n
FROM events""")
def w2_running_rows_fine_time(spark, sf):
    """Microsecond times: the distinct times of a group are not bounded, so the ordered scan is used."""
    rows = load(spark, sf, "events").select("event_id", "event_type", "ts")
    return windows.running_rows(rows, ["event_type"], "ts", F.lit(1), "n").select("event_id", "n")


@query("w3_row_number", """SELECT o_orderpriority, o_orderkey,
row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS row_number FROM orders""")
def w3_row_number(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return ordered.row_number(rows, ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


_GRADIENT_SQL = """round(CASE WHEN pl IS NULL THEN (nv - y) / (nx - x) WHEN nv IS NULL THEN (y - pv) / (x - pl)
 ELSE ((x-pl)*(x-pl)*nv + ((nx-x)*(nx-x) - (x-pl)*(x-pl))*y - (nx-x)*(nx-x)*pv) / ((x-pl)*(nx-x)*(nx-pl)) END, 6)"""


@query("w4_gradient", f"""WITH {_CURVE}, n AS (SELECT x, y, lag(x) OVER w AS pl, lead(x) OVER w AS nx, lag(y) OVER w AS pv,
 lead(y) OVER w AS nv FROM curve WINDOW w AS (ORDER BY x)), g AS (SELECT x, {_GRADIENT_SQL} AS y FROM n),
 n2 AS (SELECT x, y, lag(x) OVER w AS pl, lead(x) OVER w AS nx, lag(y) OVER w AS pv, lead(y) OVER w AS nv
 FROM g WINDOW w AS (ORDER BY x)) SELECT x, y AS d1, {_GRADIENT_SQL} AS d2 FROM n2""")
def w4_gradient(spark, sf):
    curve = quantity_curve(spark, sf).withColumn("all", F.lit(0))
    first = windows.gradient(curve, ["all"], "x", "y", "d1").withColumn("d1", F.round("d1", 6))
    return windows.gradient(first, ["all"], "x", "d1", "d2").select("x", "d1", F.round("d2", 6).alias("d2"))


@query("w5_interpolation", f"""WITH {_CURVE}, q AS (SELECT * FROM (VALUES (0.5), (10.25), (31.5), (99.0)) v(q)),
 e AS (SELECT q, max(x) FILTER (WHERE x <= q) AS xl, min(x) FILTER (WHERE x >= q) AS xh FROM curve CROSS JOIN q GROUP BY 1)
SELECT CAST(q AS DOUBLE) AS q, round(CASE WHEN xl IS NULL THEN h.y WHEN xh IS NULL THEN l.y WHEN xl = xh THEN l.y
 ELSE l.y + (q - xl) / (xh - xl) * (h.y - l.y) END, 6) AS value
FROM e LEFT JOIN curve l ON l.x = xl LEFT JOIN curve h ON h.x = xh""")
def w5_interpolation(spark, sf):
    points = spark.createDataFrame([(0.5,), (10.25,), (31.5,), (99.0,)], "q double")
    out = windows.interpolate_points(quantity_curve(spark, sf), points.withColumn("x", F.col("q")), [], "x", "y", "value")
    return out.select("q", F.round("value", 6).alias("value"))


@query("w5_interpolation_table", """WITH o AS (SELECT c_nationkey AS g, round(o_totalprice, -3) AS x, avg(c_acctbal) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 = 0 GROUP BY 1, 2),
 p AS (SELECT o_orderkey, c_nationkey AS g, o_totalprice AS x FROM orders JOIN customer ON o_custkey = c_custkey),
 l AS (SELECT p.*, o.x AS xl, o.y AS yl FROM p ASOF LEFT JOIN o ON p.g = o.g AND p.x >= o.x),
 h AS (SELECT l.*, o.x AS xh, o.y AS yh FROM l ASOF LEFT JOIN o ON l.g = o.g AND l.x <= o.x)
SELECT o_orderkey, round(CASE WHEN xl IS NULL THEN yh WHEN xh IS NULL OR xh = xl THEN yl ELSE yl + (x - xl)/(xh - xl)*(yh - yl) END, 2) AS value FROM h""")
def w5_interpolation_table(spark, sf):
    """Every order's price looked up on the balance curve of its customer's nation."""
    orders = load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    points = orders.select("o_orderkey", F.col("c_nationkey").alias("g"), F.col("o_totalprice").alias("x"))
    curve = orders.filter("o_orderkey % 7 = 0").groupBy(F.col("c_nationkey").alias("g"), F.round("o_totalprice", -3).alias("x")).agg(
        F.avg("c_acctbal").alias("y"))
    out = windows.interpolate_points(curve, points, ["g"], "x", "y", "value")
    return out.select("o_orderkey", F.round("value", 2).alias("value"))


@query("w6_adstock", f"""WITH RECURSIVE {MEDIA_SQL}, {carried_sql("0.6")}
SELECT d AS date, channel, round(stock, 6) AS stock FROM carried""")
def w6_adstock(spark, sf):
    stocked = windows.adstock(media_daily(spark, sf), ["channel"], "date", "x", 0.6, "stock")
    return stocked.select("date", "channel", F.round("stock", 6).alias("stock"))


@query("w7_seasonal_profile", """WITH c AS (SELECT month(o_orderdate)::INTEGER AS month, year(o_orderdate)::INTEGER AS year,
 sum(o_totalprice) / count(*) AS m FROM orders GROUP BY 1, 2)
SELECT month, year, round(m, 5) AS mean_value, round(m - avg(m) OVER (PARTITION BY year), 5) AS centred FROM c""")
def w7_seasonal_profile(spark, sf):
    out = windows.seasonal_profile(load(spark, sf, "orders"), "o_orderdate", "o_totalprice", "month")
    return out.withColumns({c: F.round(c, 5) for c in ("mean_value", "centred")})


@query("w7_seasonal_profile_week", """WITH c AS (SELECT weekofyear(o_orderdate)::INTEGER AS week, isoyear(o_orderdate)::INTEGER AS year,
 sum(o_totalprice) / count(*) AS m FROM orders GROUP BY 1, 2)
SELECT week, year, round(m, 5) AS mean_value, round(m - avg(m) OVER (PARTITION BY year), 5) AS centred FROM c""")
def w7_seasonal_profile_week(spark, sf):
    out = windows.seasonal_profile(load(spark, sf, "orders"), "o_orderdate", "o_totalprice", "week")
    return out.withColumns({c: F.round(c, 5) for c in ("mean_value", "centred")})


@query("w8_lagged_features", f"""WITH {PANEL_SQL} SELECT grp AS "group", time, coalesce(lag(n_orders, 1) OVER w, -1) AS lag1,
coalesce(lag(n_orders, 12) OVER w, -1) AS lag12 FROM panel WINDOW w AS (PARTITION BY grp ORDER BY time)""")
def w8_lagged_features(spark, sf):
    out = windows.lags(orders_panel(spark, sf), ["group"], "time", "n_orders", [1, 12])
    return out.select("group", "time", F.coalesce("n_orders_lag1", F.lit(-1)).alias("lag1"),
                      F.coalesce("n_orders_lag12", F.lit(-1)).alias("lag12"))


@query("w9_differencing", f"""WITH {PANEL_SQL}, a AS (SELECT grp, time, n_orders - lag(n_orders) OVER (PARTITION BY grp ORDER BY time) AS x FROM panel),
 b AS (SELECT grp, time, x - lag(x, 12) OVER (PARTITION BY grp ORDER BY time) AS x FROM a)
SELECT grp AS "group", time, x AS diff FROM b WHERE x IS NOT NULL""")
def w9_differencing(spark, sf):
    out = windows.difference(orders_panel(spark, sf), ["group"], "time", ["n_orders"], d=1, seasonal_d=1, period=12)
    return out.filter(F.col("n_orders").isNotNull()).select("group", "time", F.col("n_orders").alias("diff"))
