"""Queries by name over the driver's tables, and the SQL that gives the same rows.

Objects are line items: the stain is the return flag, the region the supplier's nation, the size the quantity.  Vectors stand for positions
in space (their first dimensions), customers for subjects of a study, events for intensities.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import affine, hex_channel, norm, path_entity, rgb_hex, slug, sphere_radius, threshold_mask
from ..functions.predicate import filter_rows
from ..functions.seg_method import parse_method
from ..functions.sidecar import describe_columns
from ..operators import aggregates as agg
from ..operators import graph, levels, regions, spatial, stats, thinning, tiles, volume
from ..sources import chunks
from ..sources import tables as sources
from ..sources.tables import PALETTE, discovered, entities, itksnap_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query by its function's name, with its SQL if SQL can express it."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r4(c: Column | str) -> Column:
    return F.round(c, 4)


# --- regions ---------------------------------------------------------------------------------------------------------------------------------

OBJECTS_SQL = """WITH o AS (SELECT l_returnflag AS stain, n_nationkey AS "index", n_name AS name, l_quantity AS nvoxels, l_extendedprice AS price
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey) """


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice")
    where = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(labels(spark, sf_dir), F.col("s_nationkey") == F.col("index"))
    return items.join(where, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_returnflag").alias("stain"), "index", "name", F.col("l_quantity").alias("nvoxels"), F.col("l_extendedprice").alias("price"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("index"), F.col("n_name").alias("name"))


def fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("index")).agg(F.avg("c_acctbal").alias("fieldfrac"), F.count(F.lit(1)).cast("double").alias("volume"))
    return c.join(labels(spark, sf_dir), "index").select("index", "name", "fieldfrac", "volume")


@query(OBJECTS_SQL + """, a AS (SELECT "index", name, sum(nvoxels) AS nvoxels, avg(price) AS price, count(*) AS c FROM o GROUP BY 1, 2),
f AS (SELECT n_nationkey AS "index", n_name AS name, avg(c_acctbal) AS ff, CAST(count(*) AS DOUBLE) AS volume FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT "index", name, round(coalesce(nvoxels, 0), 4) AS nvoxels, round(coalesce(price, 0), 4) AS price, CAST(coalesce(c, 0) AS DOUBLE) AS count, round(coalesce(ff, 0), 4) AS fieldfrac, volume,
round(coalesce(c, 0) / volume, 4) AS density FROM a FULL JOIN f USING ("index", name)""")
def region_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects, counts and field fractions merged on region keys and collapsed to a row a region."""
    own = objects(spark, sf_dir).select("index", "name", "nvoxels", "price")
    out = regions.region_statistics(own, None, fractions(spark, sf_dir))
    return out.select("index", "name", *[r4(c).alias(c) for c in ("nvoxels", "price", "count", "fieldfrac", "volume", "density")])


@query("""WITH c AS (SELECT c_nationkey AS "index", count(*) AS customers, sum(c_acctbal) AS balance, avg(c_acctbal) AS volume FROM customer WHERE c_acctbal > 0 AND c_nationkey < 15 GROUP BY 1),
s AS (SELECT s_nationkey AS "index", count(*) AS suppliers, sum(s_acctbal) AS balance FROM supplier WHERE s_nationkey > 5 GROUP BY 1)
SELECT "index", coalesce(customers, 0) AS customers, round(volume, 4) AS volume, coalesce(suppliers, 0) AS suppliers FROM c FULL JOIN s USING ("index")""")
def merge_regions_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer merge; the column that both tables have (balance) is dropped, missing numbers but volume become 0."""
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0 and c_nationkey < 15").groupBy(F.col("c_nationkey").alias("index")).agg(F.count(F.lit(1)).alias("customers"), F.sum("c_acctbal").alias("balance"), r4(F.avg("c_acctbal")).alias("volume"))
    s = table(spark, sf_dir, "supplier").where("s_nationkey > 5").groupBy(F.col("s_nationkey").alias("index")).agg(F.count(F.lit(1)).alias("suppliers"), F.sum("s_acctbal").alias("balance"))
    return regions.fill_zero(regions.merge_outer([c, s], ("index",)))


@query(OBJECTS_SQL + """SELECT "index", name, """ + ", ".join(
    f"""nullif(count(*) FILTER (stain = '{s}'), 0) AS "{s}+count", round(sum(nvoxels) FILTER (stain = '{s}'), 4) AS "{s}+nvoxels", round(avg(price) FILTER (stain = '{s}'), 4) AS "{s}+price\"""" for s in "ANR") + " FROM o GROUP BY 1, 2")
def merge_stains_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a region, one group of columns a stain, in a single aggregation."""
    metrics = {"count": F.count("nvoxels"), "nvoxels": r4(F.sum("nvoxels")), "price": r4(F.avg("price"))}
    return regions.wide_by_stain(objects(spark, sf_dir), ["A", "N", "R"], metrics)


@query(OBJECTS_SQL + """, p AS (SELECT "index", name, count(*) AS c, avg(price) AS v FROM o WHERE stain = 'A' GROUP BY 1, 2), q AS (SELECT "index", name, count(*) AS c, avg(price) AS v FROM o WHERE stain = 'R' AND "index" < 12 GROUP BY 1, 2)
SELECT "index", name, p.c AS "A+count", round(p.v, 4) AS "A+price", q.c AS "coloc+count", round(q.v, 4) AS "coloc+price" FROM p FULL JOIN q USING ("index", name)""")
def merge_tables_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region tables of single stains and of pairs side by side, from separate tables."""
    o = objects(spark, sf_dir)
    one = lambda df: df.groupBy("index", "name").agg(F.count(F.lit(1)).alias("count"), r4(F.avg("price")).alias("price"))
    return regions.wide_from_tables({"A": one(o.where("stain = 'A'"))}, one(o.where("stain = 'R' and index < 12")))


@query("""SELECT n_nationkey AS "index", 'left ' || n_name AS name, substr(n_name, 1, 3) || '-L' AS abbreviation FROM nation
UNION ALL SELECT n_nationkey + 10000, 'right ' || n_name, substr(n_name, 1, 3) || '-R' FROM nation""")
def lateralize_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.lateralized(labels(spark, sf_dir).withColumn("abbreviation", F.substring("name", 1, 3)))


@query("""SELECT n_nationkey AS "index", n_name AS name FROM nation WHERE n_nationkey % 5 = n_regionkey
UNION ALL SELECT n_nationkey, 'left ' || n_name FROM nation WHERE n_nationkey % 5 <> n_regionkey
UNION ALL SELECT n_nationkey - n_nationkey % 5 + n_regionkey, 'right ' || n_name FROM nation WHERE n_nationkey % 5 <> n_regionkey""")
def split_union_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("l"), (F.col("n_nationkey") - F.col("n_nationkey") % 5 + F.col("n_regionkey")).alias("r"))
    return regions.split_hemispheres(n, "n_name", "l", "r")


_REQUESTS = ("3", "FRANCE", "CHI", "nowhere", "17", "NATION_4", "NAT")


@query(f"""SELECT DISTINCT n_nationkey AS "index" FROM nation WHERE CAST(n_nationkey AS VARCHAR) IN {_REQUESTS} OR n_name IN {_REQUESTS} OR substr(n_name, 1, 3) IN {_REQUESTS}""")
def resolve_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = spark.createDataFrame([(x,) for x in _REQUESTS], "label string")
    return regions.resolve_labels(labels(spark, sf_dir).withColumn("abbreviation", F.substring("name", 1, 3)), requests)


@query("""SELECT DISTINCT s_nationkey AS "index" FROM supplier WHERE s_nationkey > 0""")
def label_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.label_inventory(table(spark, sf_dir, "supplier"), "s_nationkey")


@query("""SELECT n_nationkey AS "index", n_name AS name, count(c_custkey) AS count FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9000) ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of each region; regions without any count 0."""
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("index"))
    return regions.count_per_region(c, labels(spark, sf_dir))


# --- cohorts and predicates ------------------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey AS participant_id, round(o_totalprice, 4) AS value, c_mktsegment AS treatment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def cohort_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("participant_id"), F.col("c_mktsegment").alias("treatment"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("participant_id"), r4("o_totalprice").alias("value"))
    return regions.with_cohort(o, cohort).select("o_orderkey", "participant_id", "value", "treatment")


@query("""SELECT DISTINCT o_custkey AS participant_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def unmatched_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("participant_id"))
    return regions.unmatched(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("participant_id")), cohort)


@query("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT (c_acctbal < 1000 OR c_nationkey >= 20)""")
def where_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "c_mktsegment in ['BUILDING', 'MACHINERY'] and not (c_acctbal < 1000 or c_nationkey >= 20)"
    return filter_rows(table(spark, sf_dir, "customer"), text, check_empty=False).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("""WITH l AS (SELECT DISTINCT c_mktsegment AS level FROM customer) SELECT 'c_mktsegment' AS factor, a.level AS level_a, b.level AS level_b FROM l a JOIN l b ON a.level < b.level""")
def contrast_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.contrast_table(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("""WITH l AS (SELECT DISTINCT o_orderpriority AS level FROM orders), s AS (SELECT DISTINCT o_orderstatus FROM orders)
SELECT 'o_orderpriority' AS factor, a.level AS level_a, b.level AS level_b, o_orderstatus FROM l a JOIN l b ON a.level < b.level CROSS JOIN s""")
def contrast_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.contrast_table(table(spark, sf_dir, "orders"), "o_orderpriority", ("o_orderstatus",))


@query("""SELECT channels, count(*) AS n_subjects FROM (SELECT o_custkey, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS channels FROM orders GROUP BY 1) GROUP BY 1""")
def channel_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.same_channels(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus")


# --- group statistics ------------------------------------------------------------------------------------------------------------------------


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderpriority").alias("region"), F.lit("price").alias("metric"), F.col("o_totalprice").alias("value"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("o_orderstatus").alias("status"))


_STUDY = """WITH d AS (SELECT o_orderpriority AS region, o_totalprice AS v, c_mktsegment AS level, c_acctbal AS x, o_orderstatus AS status FROM orders JOIN customer ON o_custkey = c_custkey),
g AS (SELECT region, level, count(*) AS n, avg(v) AS m, coalesce(var_samp(v), 0) AS s2, avg(x) AS mx FROM d GROUP BY 1, 2),
p AS (SELECT region, sum((n - 1) * s2) AS rest, CAST(sum(n - 1) AS BIGINT) AS df FROM g GROUP BY 1) """


@query(_STUDY + """SELECT a.region, a.level AS level_a, b.level AS level_b, a.n AS n_a, b.n AS n_b, round(a.m, 4) AS mean_a, round(b.m, 4) AS mean_b, df,
CASE WHEN a.n > 1 AND b.n > 1 THEN round((a.m - b.m) / sqrt(rest / df * (1 / a.n + 1 / b.n)), 6) END AS tstat,
CASE WHEN a.n > 1 AND b.n > 1 THEN round((a.m - b.m) / sqrt(((a.n - 1) * a.s2 + (b.n - 1) * b.s2) / (a.n + b.n - 2)), 6) END AS cohensd
FROM g a JOIN g b ON a.region = b.region AND a.level < b.level JOIN p ON p.region = a.region""")
def group_contrast_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t and Cohen's d of all pairs of levels in closed form, with built-in functions only."""
    d = study(spark, sf_dir)
    out = stats.two_level_tests(d, ["region"], "segment", stats.contrast_table(table(spark, sf_dir, "customer"), "c_mktsegment"))
    return out.select("region", "level_a", "level_b", "n_a", "n_b", r4("mean_a").alias("mean_a"), r4("mean_b").alias("mean_b"), "df", F.round("tstat", 6).alias("tstat"), F.round("cohensd", 6).alias("cohensd"))


@query(_STUDY + """, w AS (SELECT d.region, sum((x - mx) * (v - m)) AS sxy, sum((x - mx) * (x - mx)) AS sxx, sum((v - m) * (v - m)) AS syy, count(*) AS nobs, count(DISTINCT d.level) AS k FROM d JOIN g ON g.region = d.region AND g.level = d.level GROUP BY 1)
SELECT a.region, 'segment+' || a.level || 'vs' || b.level AS contrast, a.n AS n_a, b.n AS n_b, nobs,
round(((a.m - b.m) - sxy / sxx * (a.mx - b.mx)) / sqrt((syy - sxy * sxy / sxx) / (nobs - k - 1) * (1 / a.n + 1 / b.n + (a.mx - b.mx) * (a.mx - b.mx) / sxx)), 5) AS tstat
FROM g a JOIN g b ON a.region = b.region AND a.level < b.level JOIN w ON w.region = a.region""")
def group_ols_covariate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A least-squares fit with a covariate in each region; the SQL removes the covariate within levels first."""
    wanted = stats.contrasts(table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "segment"), "segment")
    out = stats.fitted_contrasts(study(spark, sf_dir), ["region"], "metric ~ C(segment) + balance", wanted)
    return out.select("region", "contrast", "n_a", "n_b", "nobs", F.round("tstat", 5).alias("tstat"))


@query(_STUDY + """, c AS (SELECT region, level, status, count(*) AS n, avg(v) AS m, coalesce(var_samp(v), 0) AS s2, avg(x) AS mx FROM d GROUP BY ALL),
w AS (SELECT region, sum((x - mx) * (v - m)) AS sxy, sum((x - mx) * (x - mx)) AS sxx, sum((v - m) * (v - m)) AS syy, count(*) AS nobs, count(DISTINCT (level, status)) AS k, var_pop(v) * count(*) AS whole FROM d JOIN c USING (region, level, status) GROUP BY 1),
l AS (SELECT DISTINCT level FROM d), s AS (SELECT DISTINCT status FROM d), r AS (SELECT DISTINCT region FROM d),
t AS (SELECT r.region, a.level AS la, b.level AS lb, status FROM r CROSS JOIN l a JOIN l b ON a.level < b.level CROSS JOIN s)
SELECT t.region, 'segment+' || la || 'vs' || lb || '+status-' || t.status AS contrast, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, round(a.m, 1) AS mean_a, round(b.m, 1) AS mean_b,
CASE WHEN a.n > 1 AND b.n > 1 THEN round(((a.m - b.m) - sxy / sxx * (a.mx - b.mx)) / sqrt((syy - sxy * sxy / sxx) / (nobs - k - 1) * (1 / a.n + 1 / b.n + (a.mx - b.mx) * (a.mx - b.mx) / sxx)), 5) END AS tstat,
CASE WHEN a.n > 1 AND b.n > 1 THEN round((a.m - b.m) / sqrt(((a.n - 1) * a.s2 + (b.n - 1) * b.s2) / (a.n + b.n - 2)), 6) END AS cohensd,
CASE WHEN a.n > 1 AND b.n > 1 THEN nobs END AS nobs, CASE WHEN a.n > 1 AND b.n > 1 THEN round(1 - (syy - sxy * sxy / sxx) / whole, 6) END AS r2
FROM t JOIN w ON w.region = t.region LEFT JOIN c a ON a.region = t.region AND a.level = la AND a.status = t.status LEFT JOIN c b ON b.region = t.region AND b.level = lb AND b.status = t.status""")
def group_ols_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contrasts within strata of a model with an interaction: t, Cohen's d and R squared; the SQL removes the covariate within cells first."""
    d = study(spark, sf_dir)
    wanted = stats.contrasts(d.select("segment", "status"), "segment", ("status",))
    out = stats.fitted_contrasts(d, ["region"], "metric ~ C(segment)*C(status) + balance", wanted)
    return out.select("region", "contrast", "n_a", "n_b", F.round("mean_a", 1).alias("mean_a"), F.round("mean_b", 1).alias("mean_b"), F.round("tstat", 5).alias("tstat"), F.round("cohensd", 6).alias("cohensd"), "nobs", F.round("r2", 6).alias("r2"))


@query("""WITH d AS (SELECT o_orderpriority AS region, o_totalprice AS value, c_acctbal AS balance, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey),
c AS (SELECT region, segment, row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, segment) AS r FROM d GROUP BY 1, 2)
SELECT d.region, round(avg(value), 4) AS value, round(avg(balance), 4) AS balance, min(c.segment) AS segment FROM d JOIN c ON c.region = d.region AND c.r = 1 GROUP BY 1""")
def marginal_reference_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.reference_row(study(spark, sf_dir), ["region"], ["value", "balance", "segment"])
    return out.select("region", r4("value").alias("value"), r4("balance").alias("balance"), "segment")


@query(_STUDY + """, t AS (SELECT a.region, a.m AS ma, b.m AS mb, a.n AS na, b.n AS nb, (a.m - b.m) / sqrt(rest / df * (1 / a.n + 1 / b.n)) AS t FROM g a JOIN g b ON a.region = b.region AND a.level = 'AUTOMOBILE' AND b.level = 'BUILDING' JOIN p ON p.region = a.region)
SELECT region, na AS "n_AUTOMOBILE", nb AS "n_BUILDING", round(ma, 4) AS "price_mean_AUTOMOBILE", round(mb, 4) AS "price_mean_BUILDING", round(t, 5) AS price_tstat FROM t""")
def group_stats_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of one contrast as one row a region."""
    fitted = stats.fitted_contrasts(study(spark, sf_dir), ["region"], "metric ~ C(segment)", [stats.Contrast("segment", "AUTOMOBILE", "BUILDING")]).withColumn("metric", F.lit("price"))
    wide = stats.widened(fitted, ["region"], ["price"], "AUTOMOBILE", "BUILDING")
    return wide.select("region", "n_AUTOMOBILE", "n_BUILDING", r4("price_mean_AUTOMOBILE").alias("price_mean_AUTOMOBILE"), r4("price_mean_BUILDING").alias("price_mean_BUILDING"), F.round("price_tstat", 5).alias("price_tstat"))


@query("""SELECT o_custkey AS subject, 'price' AS metric, round(o_totalprice, 4) AS value FROM orders UNION ALL SELECT o_custkey, 'count', NULL FROM orders UNION ALL SELECT o_custkey, 'priority', CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) FROM orders""")
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each metric of a wide table; one that the table lacks is NULL."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("subject"), r4("o_totalprice").alias("price"), F.substring("o_orderpriority", 1, 1).alias("priority"))
    return stats.unpivoted(o, ["subject"], ["price", "count", "priority"], [])


@query(_STUDY + """, t AS (SELECT a.region, a.level AS level_a, b.level AS level_b, (a.m - b.m) / sqrt(rest / df * (1 / a.n + 1 / b.n)) AS t FROM g a JOIN g b ON a.region = b.region AND a.level < b.level JOIN p ON p.region = a.region)
SELECT region, level_a, level_b, round(coalesce(t, 0), 6) AS t_value, round(least(t * t / 2 / ln(10), 3), 6) AS significance, round(max(abs(coalesce(t, 0))) OVER (), 6) AS t_bound FROM t""")
def heatmap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t matrix of regions by contrasts with its symmetric bound; p is the bound exp(-t^2 / 2) here, so that SQL can follow."""
    out = stats.two_level_tests(study(spark, sf_dir), ["region"], "segment", stats.contrast_table(table(spark, sf_dir, "customer"), "c_mktsegment"))
    m = stats.heatmap_matrix(out.withColumn("pval", F.exp(-F.col("tstat") * F.col("tstat") / 2)))
    return m.select("region", "level_a", "level_b", *[F.round(c, 6).alias(c) for c in ("t_value", "significance", "t_bound")])


# --- space -----------------------------------------------------------------------------------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return v.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"pos_{a}") for i, a in enumerate("xyz")])


_V = """WITH v AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings) """
_RADIUS = 0.05


@query(_V + f"""SELECT a.vec_id AS id_a, b.vec_id AS id_b, a.label AS label_a, b.label AS label_b, round(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)), 6) AS distance
FROM v a JOIN v b ON a.label < b.label WHERE sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) <= {_RADIUS}""")
def coloc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of objects of different stains within a radius: an equi-join on grid cells, then the exact test."""
    v = vectors(spark, sf_dir).withColumn("radius", F.lit(_RADIUS))
    pairs = spatial.radius_pairs(v, v, "radius", cell=_RADIUS).where("a.label < b.label")
    return pairs.select(F.col("a.vec_id").alias("id_a"), F.col("b.vec_id").alias("id_b"), F.col("a.label").alias("label_a"), F.col("b.label").alias("label_b"), F.round("distance", 6).alias("distance"))


@query(_V + """, r AS (SELECT *, 0.01 * (1 + vec_id % 7) AS rad FROM v)
SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(1 - sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) / (a.rad + b.rad), 6) AS overlapratio, round((a.x + b.x) / 2, 6) AS pos_coloc_x
FROM r a JOIN r b ON a.label < b.label WHERE sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) <= a.rad AND 1 - sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) / (a.rad + b.rad) > 0""")
def coloc_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping objects of each two of ten stains, whose radii differ: a grid for each octave of radii."""
    v = vectors(spark, sf_dir).withColumns({"stain": F.concat(F.lit("s"), F.col("label")), "object_id": F.col("vec_id"), "radius": 0.01 * (1 + F.col("vec_id") % 7), "nvoxels": F.lit(1), **{f"template_{a}": F.col(f"pos_{a}") for a in "xyz"}})
    pairs = spatial.colocalized(v, [f"s{i}" for i in range(10)])
    return pairs.select(F.col("object_id_a").alias("id_a"), F.col("object_id_b").alias("id_b"), F.round("overlapratio", 6).alias("overlapratio"), F.round("pos_coloc_x", 6).alias("pos_coloc_x"))


@query("""SELECT p_partkey, round(cbrt(3.0 * p_size / (4 * pi())), 6) AS radius, round(log10(p_size + 1), 6) AS log_size FROM part""")
def object_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.round(sphere_radius(F.col("p_size")), 6).alias("radius"), F.round(F.log10(F.col("p_size") + 1), 6).alias("log_size"))


_GRID = [[0.1, 0, 0, -0.5], [0, 0.1, 0, -0.5], [0, 0, 0.1, -0.5], [0, 0, 0, 1]]
_SHAPE = (11, 11, 11)


@query(_V + """SELECT vx, vy, vz, count(*) AS count FROM (SELECT CAST(floor((x + 0.5) / 0.1 + 0.5) AS BIGINT) AS vx, CAST(floor((y + 0.5) / 0.1 + 0.5) AS BIGINT) AS vy, CAST(floor((z + 0.5) / 0.1 + 0.5) AS BIGINT) AS vz FROM v)
WHERE vx BETWEEN 0 AND 10 AND vy BETWEEN 0 AND 10 AND vz BETWEEN 0 AND 10 GROUP BY 1, 2, 3""")
def points_to_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.points_to_grid(vectors(spark, sf_dir), _GRID, _SHAPE)


def _label_grid(spark: SparkSession) -> DataFrame:
    v = spark.range(1331).select((F.col("id") % 11).alias("vx"), (F.floor(F.col("id") / 11) % 11).alias("vy"), F.floor(F.col("id") / 121).alias("vz"))
    return v.withColumn("index", ((F.col("vx") + 2 * F.col("vy") + 3 * F.col("vz")) % 26 - 1).cast("int")).where("index >= 0")


@query(_V + """, p AS (SELECT vec_id, CAST(floor((x + 0.5) / 0.1 + 0.5) AS BIGINT) AS vx, CAST(floor((y + 0.5) / 0.1 + 0.5) AS BIGINT) AS vy, CAST(floor((z + 0.5) / 0.1 + 0.5) AS BIGINT) AS vz FROM v),
l AS (SELECT vec_id, CASE WHEN vx BETWEEN 0 AND 10 AND vy BETWEEN 0 AND 10 AND vz BETWEEN 0 AND 10 AND (vx + 2 * vy + 3 * vz) % 26 >= 1 THEN CAST((vx + 2 * vy + 3 * vz) % 26 - 1 AS INTEGER) ELSE 0 END AS "index" FROM p)
SELECT vec_id, l."index", n_name AS name FROM l LEFT JOIN nation ON n_nationkey = l."index\"""")
def point_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and name of the voxel that holds each point."""
    return spatial.label_points(vectors(spark, sf_dir), _label_grid(spark), _GRID, labels(spark, sf_dir)).select("vec_id", "index", "name")


_SAMPLED = _V + """, n AS (SELECT CAST(round_even((x + 0.5) / 0.1, 0) AS BIGINT) AS gx, CAST(round_even((y + 0.5) / 0.1, 0) AS BIGINT) AS gy, CAST(round_even((z + 0.5) / 0.1, 0) AS BIGINT) AS gz, count(*) AS n FROM v GROUP BY ALL),
g AS (SELECT i % 41 - 15 AS gx, i // 41 % 41 - 15 AS gy, i // 1681 - 15 AS gz FROM (SELECT unnest(range(68921)) AS i)),
grid AS (SELECT g.gx, g.gy, g.gz, coalesce(n, 0) + abs(g.gx * g.gy + g.gz * g.gz) % 7 AS value, abs(g.gx * g.gx + 3 * g.gy) % 5 / 50 AS dy FROM g LEFT JOIN n USING (gx, gy, gz)),
f AS (SELECT vec_id, (x + 0.5) / 0.1 AS x, (y + 0.5) / 0.1 AS y, (z + 0.5) / 0.1 AS z FROM v), d AS (SELECT i % 2 AS i, i // 2 % 2 AS j, i // 4 AS k FROM (SELECT unnest(range(8)) AS i)),
c AS (SELECT vec_id, CAST(floor(x) AS BIGINT) + i AS gx, CAST(floor(y) AS BIGINT) + j AS gy, CAST(floor(z) AS BIGINT) + k AS gz, (CASE i WHEN 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) * (CASE j WHEN 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) * (CASE k WHEN 1 THEN z - floor(z) ELSE 1 - z + floor(z) END) AS w FROM f, d),
s AS (SELECT vec_id, CASE WHEN count(*) = count(value) THEN sum(w * value) END AS value, CASE WHEN count(*) = count(value) THEN sum(w * dy) END AS dy FROM c LEFT JOIN grid USING (gx, gy, gz) WHERE w > 0 GROUP BY 1) """


def _sampled_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid that isn't linear along any axis: how many vectors lie at each voxel, and patterns of its place."""
    voxels = spark.range(41**3).select((F.col("id") % 41 - 15).alias("vx"), (F.floor(F.col("id") / 41) % 41 - 15).alias("vy"), (F.floor(F.col("id") / 1681) - 15).alias("vz"))
    counts = spatial.to_voxels(vectors(spark, sf_dir), _GRID).groupBy(*tiles.AXES).agg(F.count(F.lit(1)).alias("n"))
    pattern = F.abs(F.col("vx") * F.col("vy") + F.col("vz") * F.col("vz")) % 7
    value = (F.coalesce("n", F.lit(0)) + pattern).cast("double")
    return voxels.join(counts, list(tiles.AXES), "left").select(*tiles.AXES, value.alias("value"), (F.abs(F.col("vx") * F.col("vx") + 3 * F.col("vy")) % 5 / 50).alias("dy"))


@query(_SAMPLED + "SELECT vec_id, round(value, 5) AS value FROM s")
def scalar_sample_trilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear interpolation between the eight voxels around each point."""
    return spatial.sample_linear(vectors(spark, sf_dir), "vec_id", _sampled_grid(spark, sf_dir), ["value"], _GRID).select("vec_id", F.round("value", 5).alias("value"))


@query(_SAMPLED + "SELECT vec_id, round(v.x + value / 100, 5) AS template_x, round(v.y + dy, 5) AS template_y, round(v.z, 5) AS template_z FROM v JOIN s USING (vec_id)")
def transform_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points moved by a displacement field on a grid."""
    field = _sampled_grid(spark, sf_dir).select(*tiles.AXES, (F.col("value") / 100).alias("dx"), "dy", F.lit(0.0).alias("dz"))
    return spatial.transform_points(vectors(spark, sf_dir), "vec_id", field, _GRID).select("vec_id", *[F.round(f"template_{a}", 5).alias(f"template_{a}") for a in "xyz"])


@query(_V + """SELECT round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std, round(max(m), 6) AS max FROM (SELECT sqrt(x*x + y*y + z*z) AS m FROM v)""")
def warp_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spatial.magnitude_summary(vectors(spark, sf_dir).withColumnsRenamed({f"pos_{a}": f"d{a}" for a in "xyz"}))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("""WITH v AS (SELECT label, CAST(floor(embedding[1] * 10) AS BIGINT) AS vx, CAST(floor(embedding[2] * 10) AS BIGINT) AS vy, CAST(floor(embedding[3] * 10) AS BIGINT) AS vz FROM embeddings),
b AS (SELECT label, count(*) AS nvoxels, CAST(count(*) AS DOUBLE) / ((max(vx) - min(vx) + 1) * (max(vy) - min(vy) + 1) * (max(vz) - min(vz) + 1)) AS extent, min(vx) AS min_x, max(vx) AS max_x FROM v GROUP BY 1)
SELECT label, nvoxels, round(extent, 6) AS extent, min_x, max_x FROM b WHERE extent >= 0.15""")
def bbox_extent_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of the labels whose box is filled enough to be kept."""
    v = table(spark, sf_dir, "embeddings").select("label", *[F.floor(F.col("embedding")[i] * 10).alias(f"v{a}") for i, a in enumerate("xyz")])
    return spatial.bounding_boxes(volume.cleaned(v)).select("label", "nvoxels", F.round("extent", 6).alias("extent"), "min_x", "max_x")


@query(_V + """SELECT vec_id, 's' || label || '_' || (row_number() OVER (ORDER BY 's' || label, z, y, x, vec_id % 50 + 1) - 1) AS object_id, round(cbrt(3.0 * (vec_id % 50 + 1) * pow(0.002, 3) / (4 * pi())), 8) AS radius FROM v""")
def object_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radius and a stable id of every object, numbered by stain, position and size."""
    v = vectors(spark, sf_dir).withColumn("stain", F.concat(F.lit("s"), F.col("label"))).withColumn("nvoxels", F.col("vec_id") % 50 + 1)
    return spatial.with_object_ids(v).select("vec_id", "object_id", F.round("radius", 8).alias("radius"))


@query("""SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 200""")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 200 objects by a seeded hash: the limit is the operator."""
    return spatial.seeded_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 200)


@query("""SELECT row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) - 1 AS place, o_orderkey FROM orders""")
def seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.seeded_order(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7).select("place", "o_orderkey")


@query("""SELECT row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS place, p_partkey, round(cbrt(3.0 * p_size / (4 * pi())), 6) AS radius FROM part""")
def radius_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects by their radius."""
    out = spatial.ordered_by_radius(table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("nvoxels")))
    return out.select("place", "p_partkey", F.round("radius_sort", 6).alias("radius"))


@query("""SELECT n_nationkey AS "index", n_name AS name FROM nation WHERE n_nationkey > 0 AND n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) ORDER BY 1 LIMIT 25""")
def present_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first labels that a volume has: the limit is the operator."""
    there = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("index"))
    return spatial.present_labels(labels(spark, sf_dir), there, coarse=True)


@query("""WITH a AS (SELECT row_number() OVER (ORDER BY p_partkey) AS i, p_partkey FROM part), b AS (SELECT row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS i, s_suppkey FROM supplier)
SELECT p_partkey, s_suppkey FROM a JOIN b USING (i)""")
def paired_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two tables side by side, each in its own order."""
    pairs = agg.paired_by_position(table(spark, sf_dir, "part").select("p_partkey"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), ["p_partkey"], ["s_acctbal", "s_suppkey"])
    return pairs.select("p_partkey", "s_suppkey")


# --- intensities -----------------------------------------------------------------------------------------------------------------------------


_HIST = """WITH b AS (SELECT unnest(range(50)) AS bin), c AS (SELECT CAST(least(floor(value / 10.0), 49) AS BIGINT) AS bin, count(*) AS count FROM events WHERE value BETWEEN 0 AND 500 GROUP BY 1),
h AS (SELECT CAST(b.bin AS INTEGER) AS bin, b.bin * 10.0 AS lo, (b.bin + 1) * 10.0 AS hi, coalesce(c.count, 0) AS count FROM b LEFT JOIN c ON c.bin = b.bin) """


def _events_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.histogram(table(spark, sf_dir, "events"), "value", 0.0, 500.0, 50)


@query(_HIST + "SELECT bin, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count FROM h")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_histogram(spark, sf_dir)


@query(_HIST + "SELECT bin, CAST(sum(count) OVER (ORDER BY bin) AS BIGINT) AS cum_count, round(sum(count) OVER (ORDER BY bin) / sum(count) OVER (), 6) AS ecdf FROM h")
def histogram_ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.with_ecdf(_events_histogram(spark, sf_dir)).select("bin", "cum_count", F.round("ecdf", 6).alias("ecdf"))


@query(_HIST + """, e AS (SELECT *, (lo + hi) / 2 AS center, sum(count) OVER (ORDER BY bin) / sum(count) OVER () AS ecdf FROM h)
SELECT round(CAST(sum(center * count) / sum(count) AS DOUBLE), 4) AS mean, round(CAST(100.0 * max(count) FILTER (bin = 49) / sum(count) AS DOUBLE), 6) AS saturation_pct, CAST(min(center) FILTER (ecdf >= 0.5) AS DOUBLE) AS q50, CAST(min(center) FILTER (ecdf >= 0.9) AS DOUBLE) AS q90, CAST(min(center) FILTER (ecdf >= 0.99) AS DOUBLE) AS q99 FROM e""")
def hist_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = agg.histogram_summary(_events_histogram(spark, sf_dir))
    return out.select(r4("mean").alias("mean"), F.round("saturation_pct", 6).alias("saturation_pct"), "q50", "q90", "q99")


_AT = (1, 5, 25, 50, 75, 95, 99)


@query("SELECT " + ", ".join(f"round(quantile_cont(l_extendedprice, {a / 100}), 4) AS p{a}" for a in _AT) + " FROM lineitem")
def percentiles_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = agg.percentiles(table(spark, sf_dir, "lineitem").select("l_extendedprice"), "l_extendedprice", _AT)
    return out.select(*[r4(c).alias(c) for c in out.columns])


@query("""SELECT l_returnflag, round(min(l_extendedprice), 4) AS min, round(max(l_extendedprice), 4) AS max, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS std,
round(stddev_pop(l_extendedprice) / avg(l_extendedprice), 6) AS cv FROM lineitem GROUP BY 1""")
def moments_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = agg.moments(table(spark, sf_dir, "lineitem"), "l_extendedprice", ("l_returnflag",))
    return out.select("l_returnflag", *[F.round(c, 6 if c == "cv" else 4).alias(c) for c in ("min", "max", "mean", "std", "cv")])


@query("""SELECT CAST(day(ts) AS INTEGER) AS z, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std FROM events GROUP BY 1""")
def slice_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = agg.slice_profile(table(spark, sf_dir, "events").select(F.dayofmonth("ts").alias("z"), "value"), "z", "value")
    return out.select("z", r4("mean").alias("mean"), r4("std").alias("std"))


@query("""WITH p AS (SELECT n_nationkey AS x, CAST(n_nationkey * n_nationkey AS DOUBLE) AS v FROM nation), i AS (SELECT unnest(range(49)) AS i)
SELECT CAST(i AS BIGINT) AS i, round(a.v + (i / 2.0 - a.x) * (b.v - a.v), 6) AS value FROM i JOIN p a ON a.x = floor(i / 2.0) JOIN p b ON b.x = least(floor(i / 2.0) + 1, 24)""")
def profile_resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") * F.col("n_nationkey")).cast("double").alias("v"))
    return agg.resampled(p, "n_nationkey", "v", 49).select("i", F.round("value", 6).alias("value"))


@query("""SELECT l_returnflag AS stain, count(*) AS count, round(avg(l_quantity), 4) AS mean, round(median(l_quantity), 4) AS median, round(max(l_quantity), 4) AS max, round(sum(l_quantity), 4) AS total,
round(avg(cbrt(3 * l_quantity / (4 * pi()))), 6) AS mean_radius, round(median(cbrt(3 * l_quantity / (4 * pi()))), 6) AS median_radius FROM lineitem GROUP BY 1""")
def object_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("stain"), "l_quantity")
    out = agg.object_summary(items, "l_quantity", sphere_radius(F.col("l_quantity")), ("stain",))
    return out.select("stain", "count", *[r4(c).alias(c) for c in ("mean", "median", "max", "total")], *[F.round(c, 6).alias(c) for c in ("mean_radius", "median_radius")])


@query(OBJECTS_SQL + """, r AS (SELECT stain, "index", name, sum(nvoxels) AS nvoxels FROM o WHERE "index" > 0 GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY stain ORDER BY nvoxels DESC, "index") AS rank FROM r)
SELECT stain, "index", name, round(nvoxels, 4) AS nvoxels, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 20""")
def top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty regions with most voxels of each stain, without the background: the limit is the operator."""
    r = objects(spark, sf_dir).where("index > 0").groupBy("stain", "index", "name").agg(F.sum("nvoxels").alias("nvoxels"))
    return regions.top_n(r, "nvoxels", 20, ("stain",)).select("stain", "index", "name", r4("nvoxels").alias("nvoxels"), "rank")


@query("""SELECT event_type, count(*) AS count FROM events GROUP BY 1""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").count().orderBy(F.desc("count"), "event_type")


@query("""SELECT event_id, CASE WHEN value > 100 THEN 100 ELSE 0 END AS mask FROM events""")
def threshold_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", threshold_mask(F.col("value"), 100).alias("mask"))


_EVENT_VOXELS = """WITH e AS (SELECT CAST(day(ts) AS BIGINT) AS vx, user_id % 20 AS vy, avg(CASE WHEN value > 100 THEN 100.0 ELSE 0.0 END) AS value, max(value) AS top FROM events GROUP BY 1, 2) """


def _event_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.dayofmonth("ts").cast("long").alias("vx"), (F.col("user_id") % 20).alias("vy"), "value")
    return e.groupBy("vx", "vy").agg(F.avg(threshold_mask(F.col("value"), 100).cast("double")).alias("value"), F.max("value").alias("top"))


@query(_EVENT_VOXELS + "SELECT CAST(floor(vx / 4) AS BIGINT) AS vx, CAST(floor(vy / 4) AS BIGINT) AS vy, round(avg(value), 4) AS value FROM e GROUP BY 1, 2")
def block_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field fraction of blocks of 4 by 4 voxels."""
    return agg.block_mean(_event_voxels(spark, sf_dir), 4, "value", ("vx", "vy")).select("vx", "vy", r4("value").alias("value"))


@query(_EVENT_VOXELS + "SELECT vx, round(max(top), 4) AS top FROM e GROUP BY 1")
def max_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.projection(_event_voxels(spark, sf_dir), ("vx",), "top").select("vx", r4("top").alias("top"))


@query(_EVENT_VOXELS + """SELECT CAST((vx + vy) % 5 AS INTEGER) AS "index", round(avg(value), 4) AS fieldfrac, CAST(count(*) * 0.5 AS DOUBLE) AS volume FROM e GROUP BY 1""")
def zonal_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _event_voxels(spark, sf_dir).withColumn("index", ((F.col("vx") + F.col("vy")) % 5).cast("int"))
    return regions.zonal_mean(v, "value", 0.5).select("index", r4("fieldfrac").alias("fieldfrac"), "volume")


@query("""SELECT event_type AS label, count(*) FILTER (value > 30) AS n_in, count(*) FILTER (NOT value > 30) AS n_out FROM events GROUP BY 1 HAVING count(*) FILTER (value > 30) > count(*) FILTER (NOT value > 30)""")
def class_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.class_vote(table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), (F.col("value") > 30).alias("inside")), "inside")


@query(OBJECTS_SQL + """, f AS (SELECT "index", avg(price) AS feature FROM o WHERE "index" < 10 GROUP BY 1)
SELECT o_orderkey, CAST(o_orderkey % 26 AS INTEGER) AS "index", round(coalesce(feature, 0), 4) AS value FROM orders LEFT JOIN f ON f."index" = o_orderkey % 26""")
def feature_paint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voxels painted with a statistic of their label; labels without one become 0."""
    f = objects(spark, sf_dir).where("index < 10").groupBy("index").agg(F.avg("price").alias("feature"))
    v = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 26).cast("int").alias("index"))
    return volume.painted(v, f, "feature").select("o_orderkey", "index", r4("value").alias("value"))


@query(_EVENT_VOXELS + "SELECT vx, vy, CASE WHEN vx < 15 THEN round(value, 4) ELSE 0 END AS value FROM e")
def hemisphere_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = volume.half_zeroed(_event_voxels(spark, sf_dir), 31, "left")
    return v.select("vx", "vy", r4("value").alias("value"))


@query("""WITH q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.995) AS hi FROM events)
SELECT event_id, round_even(least(1, greatest(0, (value - lo) / (hi - lo))) * 255, 0) AS scaled FROM events, q""")
def normalise_uint8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intensities between two percentiles on a scale of 0 to 255."""
    return agg.stretched(table(spark, sf_dir, "events").select("event_id", "value"), "value").select("event_id", "scaled")


@query("""WITH v AS (SELECT event_id, ln(value + 1) AS v FROM events), q AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.995) AS hi FROM v WHERE v > 0)
SELECT event_id, round_even(least(1, greatest(0, (v - lo) / (hi - lo))) * 1000, 0) AS scaled FROM v, q""")
def normalise_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logarithms of intensities between two percentiles of the positive ones, on a scale of 0 to 1000."""
    return agg.stretched(table(spark, sf_dir, "events").select("event_id", "value"), "value", top=1000.0, positive=True, log=True).select("event_id", "scaled")


@query("""SELECT event_type, count(*) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS q50, round(quantile_cont(value, 0.75), 4) AS q75, round(max(value), 4) AS max FROM events GROUP BY 1""")
def summary_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = agg.described(table(spark, sf_dir, "events"), "value", "event_type")
    return out.select("event_type", "count", *[r4(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@query(_V + f"""SELECT label, count(*) AS n_objects, CAST(count(DISTINCT m.id) AS BIGINT) AS n_matched, round(100.0 * count(DISTINCT m.id) / count(DISTINCT v.vec_id), 4) AS pct_matched FROM v LEFT JOIN (SELECT DISTINCT a.vec_id AS id FROM v a JOIN v b ON a.label < b.label
WHERE sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)) <= {_RADIUS}) m ON m.id = v.vec_id GROUP BY 1""")
def match_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each stain's objects that lie close to an object of a later stain."""
    matched = coloc_pairs(spark, sf_dir).select(F.col("id_a").alias("vec_id")).distinct().withColumn("_m", F.lit(1))
    out = vectors(spark, sf_dir).select("vec_id", "label").join(matched, "vec_id", "left").groupBy("label").agg(F.count(F.lit(1)).alias("n_objects"), F.count("_m").alias("n_matched"))
    return out.withColumn("pct_matched", r4(100.0 * F.col("n_matched") / F.col("n_objects")))


_RANGE = "WITH q AS (SELECT quantile_cont(value, {}) AS lo, quantile_cont(value, {}) AS hi FROM events)"


def _bins_sql(width: int) -> str:
    """Non-empty bins of about a width between two percentiles, after ``_RANGE``: bin, center, w."""
    return f""", n AS (SELECT *, CAST(greatest(2, ceil((hi - lo) / {width})) AS BIGINT) AS bins FROM q),
h AS (SELECT bin, lo + (bin + 0.5) * (hi - lo) / bins AS center, count(*) AS w FROM (SELECT CAST(least(floor((value - lo) / ((hi - lo) / bins)), bins - 1) AS BIGINT) AS bin, lo, hi, bins FROM events, n WHERE value BETWEEN lo AND hi) GROUP BY bin, lo, hi, bins)"""


def _mixture_sql(components: int, rounds: int) -> str:
    """Rounds of a mixture's fit to the bins, each from the one before: p{rounds} has a row for each component."""
    parts = [f""", x AS (SELECT center AS x, w / sum(w) OVER () AS w, sum(w) OVER (ORDER BY bin) / sum(w) OVER () AS upto, lag(center) OVER (ORDER BY bin) AS before_x, coalesce(lag(upto_w) OVER (ORDER BY bin) / sum(w) OVER (), 0) AS before FROM (SELECT *, sum(w) OVER (ORDER BY bin) AS upto_w FROM h)),
g AS (SELECT sum(w * x * x) - sum(w * x) * sum(w * x) AS var, greatest((max(x) - min(x)) * (max(x) - min(x)) * 1e-8, 1e-12) AS least FROM x),
t AS (SELECT i, (i + 0.5) / {components} AS goal FROM (SELECT unnest(range({components})) AS i)),
p0 AS (SELECT i AS c, CASE WHEN before_x IS NULL THEN x ELSE before_x + (x - before_x) * (goal - before) / (upto - before) END AS mean, greatest(var, least) AS var, 1.0 / {components} AS part FROM t JOIN x ON upto >= goal AND before < goal CROSS JOIN g)"""]
    for i in range(rounds):
        parts.append(f""", l{i} AS (SELECT x, w, c, ln(part) - 0.5 * ln(2 * pi() * var) - 0.5 * (x - mean) * (x - mean) / var AS lp FROM x CROSS JOIN p{i}),
e{i} AS (SELECT x, w, c, exp(lp - max(lp) OVER (PARTITION BY x)) AS e FROM l{i}), r{i} AS (SELECT x, c, w * e / sum(e) OVER (PARTITION BY x) AS r FROM e{i}),
m{i} AS (SELECT c, sum(r) AS size, sum(r * x) / sum(r) AS mean FROM r{i} GROUP BY c),
p{i + 1} AS (SELECT c, any_value(mean) AS mean, greatest(sum(r * (x - mean) * (x - mean)) / any_value(size), any_value(least)) AS var, any_value(size) / sum(any_value(size)) OVER () AS part FROM r{i} JOIN m{i} USING (c) CROSS JOIN g GROUP BY c)""")
    return "".join(parts)


_MIXTURE_ROUNDS = 4


@query(_RANGE.format(0.0, 0.999) + _bins_sql(1) + """, s AS (SELECT bin, center, sum(w) OVER (ORDER BY bin) AS m, sum(w * center) OVER (ORDER BY bin) AS f, sum(w) OVER () AS mt, sum(w * center) OVER () AS ft FROM h),
o AS (SELECT i.center AS a, j.center AS b, i.f * i.f / i.m + (j.f - i.f) * (j.f - i.f) / (j.m - i.m) + (j.ft - j.f) * (j.ft - j.f) / (j.mt - j.m) AS gain FROM s i JOIN s j ON i.bin < j.bin WHERE j.mt > j.m)""" + _mixture_sql(3, _MIXTURE_ROUNDS) + f"""
SELECT 'th40' AS method, CAST(40 AS DOUBLE) AS threshold UNION ALL SELECT 'otsu+k3i1', round(arg_max(b, gain), 4) FROM o
UNION ALL SELECT 'gmm+n3k1', round(arg_max(mean + sqrt(var), mean), 4) FROM p{_MIXTURE_ROUNDS}""")
def chosen_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds of three methods from one histogram of all values; the mixture's fit stops after a few rounds here, so that SQL can follow."""
    e = table(spark, sf_dir, "events").select("value")
    of = lambda m: round(float(volume.choose_threshold(e, "value", parse_method(m), (0.0, 99.9), rounds=_MIXTURE_ROUNDS)), 4)
    return spark.createDataFrame([(m, of(m)) for m in ("th40", "otsu+k3i1", "gmm+n3k1")], "method string, threshold double")


@query(_RANGE.format(0.01, 0.99) + """, n AS (SELECT *, CAST(greatest(2, ceil((hi - lo) / 5)) AS BIGINT) AS bins FROM q), b AS (SELECT unnest(range(bins)) AS bin, lo, hi, bins FROM n),
c AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / bins)), bins - 1) AS BIGINT) AS bin, count(*) AS count FROM events, n WHERE value BETWEEN lo AND hi GROUP BY 1),
h AS (SELECT b.bin, lo + (b.bin + 0.5) * (hi - lo) / bins AS center, coalesce(count, 0) AS w FROM b LEFT JOIN c USING (bin)),
s AS (SELECT bin, center, sum(w) OVER (ORDER BY bin) AS m, sum(w * center) OVER (ORDER BY bin) AS f, sum(w) OVER () AS mt, sum(w * center) OVER () AS ft FROM h),
p AS (SELECT i.center AS a, j.center AS b, i.f * i.f / i.m + (j.f - i.f) * (j.f - i.f) / (j.m - i.m) + (j.ft - j.f) * (j.ft - j.f) / (j.mt - j.m) AS gain FROM s i JOIN s j ON i.bin < j.bin WHERE i.m > 0 AND j.m > i.m AND j.mt > j.m)
SELECT round(arg_max(b, gain), 6) AS threshold FROM p""")
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second threshold of three classes, from a histogram between the 1st and the 99th percentile; the SQL tries all pairs of bins."""
    e = table(spark, sf_dir, "events").select("value")
    t = volume.choose_threshold(e, "value", parse_method("otsu+k3i1"), (1.0, 99.0), 5.0)
    return spark.createDataFrame([(round(float(t), 6),)], "threshold double")


@query(_RANGE.format(0.01, 0.99) + """, t AS (SELECT CAST(i AS INTEGER) AS step, lo + (hi - lo) * i / 9 AS threshold FROM q, (SELECT unnest(range(10)) AS i))
SELECT event_type, step, round(threshold, 6) AS threshold, count(*) AS n_voxels, count(*) FILTER (value > threshold) AS n_foreground, round(count(*) FILTER (value > threshold) / count(*), 6) AS fraction FROM events, t GROUP BY 1, 2, 3""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreground at ten thresholds, crop by crop (event types)."""
    out = agg.threshold_sweep(table(spark, sf_dir, "events").select("event_type", "value"), "value", groups=("event_type",))
    return out.select("event_type", "step", F.round("threshold", 6).alias("threshold"), "n_voxels", "n_foreground", F.round("fraction", 6).alias("fraction"))


@query("""WITH g AS (SELECT s, i, CAST(row_number() OVER (ORDER BY s, i) - 1 AS BIGINT) AS combo FROM (SELECT unnest([2, 4, 8]) AS s), (SELECT unnest([1, 3]) AS i)), v AS (SELECT combo, value / (1 + s * i) AS v FROM events, g)
SELECT combo, round(min(v), 4) AS min, round(max(v), 4) AS max, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, round(stddev_pop(v) / avg(v), 6) AS cv, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.99), 4) AS p99 FROM v GROUP BY 1""")
def tuning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments and percentiles of an image corrected with each combination of two settings."""
    grid = agg.tuning_grid(spark, spacing=[2, 4, 8], rounds=[1, 3])
    images = table(spark, sf_dir, "events").select("value").crossJoin(F.broadcast(grid)).select("combo", (F.col("value") / (1 + F.col("spacing") * F.col("rounds"))).alias("v"))
    out = agg.tuning_report(images, ("combo",), "v")
    return out.select("combo", *[F.round(c, 6 if c == "cv" else 4).alias(c) for c in ("min", "max", "mean", "std", "cv", "p50", "p99")])


@query(_EVENT_VOXELS + """, g AS (SELECT vx - 1 AS x, vy AS y, top FROM e), t AS (SELECT i, j, i * 30 / 12.0 AS fx, j * 19 / 37.0 AS fy FROM (SELECT unnest(range(13)) AS i), (SELECT unnest(range(38)) AS j))
SELECT i AS vx, j AS vy, round(sum(top * (1 - abs(fx - x)) * (1 - abs(fy - y))), 4) AS top FROM t JOIN g ON x BETWEEN floor(fx) AND floor(fx) + 1 AND y BETWEEN floor(fy) AND floor(fy) + 1 AND abs(fx - x) < 1 AND abs(fy - y) < 1 GROUP BY 1, 2""")
def resized_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image of 31 by 20 voxels on a grid of 13 by 38, by linear interpolation."""
    v = _event_voxels(spark, sf_dir).select((F.col("vx") - 1).alias("vx"), "vy", "top")
    return spatial.resized(v, (31, 20), (13, 38), "top", ("vx", "vy")).select("vx", "vy", r4("top").alias("top"))


_SIGMAS = (1.0, 1.6, 2.56)


def _blobs_sql() -> str:
    """Differences of Gaussians of the event voxels, and the places where one is a maximum: f(vx, vy, sigma, response)."""
    parts = []
    for i, s in enumerate(_SIGMAS):
        tap = f"(SELECT d, exp(-0.5 * pow(d / {s}, 2)) AS w FROM (SELECT unnest(range(-{round(3 * s)}, {round(3 * s) + 1})) AS d))"
        parts.append(f""", x{i} AS (SELECT a.vx, a.vy, sum(b.top * w) / sum(w) AS top FROM e a CROSS JOIN {tap} JOIN e b ON b.vx = a.vx + d AND b.vy = a.vy GROUP BY 1, 2),
g{i} AS (SELECT a.vx, a.vy, sum(b.top * w) / sum(w) AS top FROM e a CROSS JOIN {tap} JOIN x{i} b ON b.vy = a.vy + d AND b.vx = a.vx GROUP BY 1, 2)""")
    levels_ = " UNION ALL ".join(f"SELECT vx, vy, {i} AS k, CAST({s} AS DOUBLE) AS sigma, (g{i}.top - g{i + 1}.top) * {s} AS response FROM g{i} JOIN g{i + 1} USING (vx, vy)" for i, s in enumerate(_SIGMAS[:-1]))
    return _EVENT_VOXELS + "".join(parts) + f""", c AS ({levels_}),
f AS (SELECT vx, vy, sigma, response FROM c a WHERE response > 1 AND NOT EXISTS (SELECT 1 FROM c b WHERE abs(b.vx - a.vx) <= 1 AND abs(b.vy - a.vy) <= 1 AND abs(b.k - a.k) <= 1 AND b.response > a.response))"""


def _blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.blobs(_event_voxels(spark, sf_dir).select("vx", "vy", "top"), _SIGMAS, 1.0, "top", ("vx", "vy"))


@query(_blobs_sql() + " SELECT vx, vy, sigma, round(response, 6) AS response FROM f")
def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bright spots of an image at three scales by differences of Gaussians."""
    return _blobs(spark, sf_dir).select("vx", "vy", "sigma", F.round("response", 6).alias("response"))


@query(_blobs_sql().replace("WITH", "WITH RECURSIVE", 1) + """, n AS (SELECT *, row_number() OVER (ORDER BY response DESC, vx, vy, sigma) AS i FROM f),
p AS (SELECT 0::BIGINT AS i, [{'vx': -1000::BIGINT, 'vy': 0::BIGINT, 'sigma': 0::DOUBLE}] AS kept UNION ALL
SELECT n.i, CASE WHEN len(list_filter(kept, lambda k: sqrt((k.vx - n.vx) * (k.vx - n.vx) + (k.vy - n.vy) * (k.vy - n.vy)) < 0.75 * sqrt(2) * (k.sigma + n.sigma))) = 0 THEN list_append(kept, {'vx': n.vx, 'vy': n.vy, 'sigma': n.sigma}) ELSE kept END FROM p JOIN n ON n.i = p.i + 1)
SELECT k.vx, k.vy, k.sigma FROM (SELECT unnest(kept) AS k FROM p WHERE i = (SELECT max(i) FROM p)) WHERE k.vx > -1000""")
def blobs_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bright spots without those that a stronger one overlaps; the SQL goes through them one by one."""
    return volume.pruned_blobs(_blobs(spark, sf_dir), 0.75, ("vx", "vy")).select("vx", "vy", "sigma")


_LABELLED = "SELECT CAST(l_partkey % 60 AS BIGINT) AS vx, CAST(l_suppkey % 50 AS BIGINT) AS vy, CAST(l_orderkey // 100 AS BIGINT) AS vz, max(l_quantity) AS value, CAST(min(l_orderkey % 9 + CASE WHEN l_partkey % 60 < 30 THEN 0 ELSE 3 END) AS BIGINT) AS \"index\" FROM lineitem GROUP BY 1, 2, 3"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voxels of line items with a value and a label; the volume grows along z with the orders."""
    items = table(spark, sf_dir, "lineitem")
    place = {"vx": F.col("l_partkey") % 60, "vy": F.col("l_suppkey") % 50, "vz": F.expr("l_orderkey div 100")}
    label = F.col("l_orderkey") % 9 + F.when(F.col("l_partkey") % 60 < 30, 0).otherwise(3)
    return items.groupBy(*[c.cast("long").alias(a) for a, c in place.items()]).agg(F.max("l_quantity").alias("value"), F.min(label).cast("long").alias("index"))


@query(f"""WITH v AS ({_LABELLED}), s AS (SELECT * FROM v WHERE "index" IN (0, 2, 11) AND vz BETWEEN 3 AND 20 OR "index" = 5),
b AS (SELECT "index" AS i, min(vx) - 1 AS x0, max(vx) + 1 AS x1, min(vy) - 1 AS y0, max(vy) + 1 AS y1, min(vz) - 1 AS z0, max(vz) + 1 AS z1 FROM s WHERE "index" > 0 GROUP BY 1)
SELECT i AS "index", vx - x0 AS vx, vy - y0 AS vy, vz - z0 AS vz, value FROM v JOIN b ON vx BETWEEN x0 AND x1 AND vy BETWEEN y0 AND y1 AND vz BETWEEN z0 AND z1 WHERE x1 - x0 < 60 + 2 AND z1 - z0 < 40""")
def region_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image cut to the box of each region; boxes with too long a side are left out."""
    v = _labelled(spark, sf_dir)
    some = v.where("(`index` in (0, 2, 11) and vz between 3 and 20) or `index` = 5")
    boxes = volume.region_boxes(some, margin=1, most=62).where("max_z - min_z < 40")
    return volume.box_crops(v.drop("index"), boxes).select("index", *volume.AXES, "value")


@query(f"""WITH v AS ({_LABELLED}), b AS (SELECT "index" AS i, (min(vx) + max(vx) + 1) // 2 AS cx, (min(vy) + max(vy) + 1) // 2 AS cy, (min(vz) + max(vz) + 1) // 2 AS cz FROM v WHERE "index" > 0 GROUP BY 1)
SELECT i AS "index", vx - cx + 8 AS vx, vy - cy + 8 AS vy, value FROM v JOIN b ON vx BETWEEN cx - 8 AND cx + 7 AND vy BETWEEN cy - 8 AND cy + 7 AND vz = cz""")
def roi_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square of the middle slice around the centre of each region's box."""
    v = _labelled(spark, sf_dir)
    centres = volume.region_boxes(v).select(F.col("index").alias("patch_id"), "cx", "cy", "cz")
    return volume.crops(v.drop("index"), centres, (16, 16, 1)).select(F.col("patch_id").alias("index"), "vx", "vy", "value")


@query(f"""WITH v AS ({_LABELLED}), n AS (SELECT max(vz) + 1 AS n FROM v), p AS (SELECT i, CAST(floor(12 + i * 35 / 4) AS BIGINT) AS px, CAST(floor(10 + i * 29 / 4) AS BIGINT) AS py, CAST(floor(floor(n / 5) + i * (floor(n * 4 / 5) - 1 - floor(n / 5)) / 4) AS BIGINT) AS pz FROM n, (SELECT unnest(range(5)) AS i)),
a AS (SELECT 'vx' AS axis, px AS slice, vy AS u, vz AS v, value FROM v JOIN p ON vx = px UNION ALL SELECT 'vy', py, vx, vz, value FROM v JOIN p ON vy = py UNION ALL SELECT 'vz', pz, vx, vy, value FROM v JOIN p ON vz = pz
UNION ALL SELECT 'vx', -1, vy, vz, value FROM v UNION ALL SELECT 'vy', -1, vx, vz, value FROM v UNION ALL SELECT 'vz', -1, vx, vy, value FROM v)
SELECT axis, CAST(slice AS INTEGER) AS slice, u, v, max(value) AS value FROM a GROUP BY ALL""")
def overview_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five slices across each axis of a volume, and its maximum along the axis."""
    v = _labelled(spark, sf_dir)
    depth = table(spark, sf_dir, "lineitem").agg(F.max(F.expr("l_orderkey div 100"))).first()[0] + 1
    return volume.overview(v, (60, 50, depth))


@query(f"""WITH v AS ({_LABELLED}), k AS (SELECT *, row_number() OVER (PARTITION BY "index" ORDER BY md5('42:' || vx || '_' || vy || '_' || vz), vx || '_' || vy || '_' || vz) AS r FROM v WHERE "index" > 0)
SELECT "index", vx, vy, vz FROM k WHERE r <= 6""")
def patch_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six seeded voxels of each region: the number is the operator."""
    v = _labelled(spark, sf_dir).where("`index` > 0").withColumn("key", F.concat_ws("_", "vx", "vy", "vz"))
    return spatial.seeded_sample(v, "key", 6, groups=("index",)).select("index", "vx", "vy", "vz")


@query("""SELECT c_custkey, c_mktsegment FROM customer SEMI JOIN (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'P') USING (c_custkey)""")
def subjects_with_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that another table has as well, under names with a prefix."""
    scans = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.concat(F.lit("sub-"), "o_custkey").alias("c_custkey"))
    return regions.of_subjects(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), scans, "c_custkey")


@query(_EVENT_VOXELS + "SELECT vx, vy, CASE WHEN (vx + vy) % 3 = 0 THEN round(value, 4) ELSE 0 END AS value FROM e")
def mask_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image times mask; voxels that the mask lacks become 0."""
    v = _event_voxels(spark, sf_dir).withColumn("vz", F.lit(0))
    m = v.where("(vx + vy) % 3 = 0").select("vx", "vy", "vz", F.lit(1).alias("mask"))
    return volume.masked(v.withColumn("value", r4("value")), m).select("vx", "vy", "value")


@query(_EVENT_VOXELS + """, c AS (SELECT * FROM (VALUES (1, 5, 5), (2, 30, 19), (3, 12, 2)) t(patch_id, cx, cy))
SELECT patch_id, vx - cx + 4 AS vx, vy - cy + 4 AS vy, round(top, 4) AS top FROM e JOIN c ON vx >= cx - 4 AND vx < cx + 4 AND vy >= cy - 4 AND vy < cy + 4""")
def patch_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a fixed size around centres; those at the edge have fewer voxels."""
    centers = spark.createDataFrame([(1, 5, 5, 0), (2, 30, 19, 0), (3, 12, 2, 0)], "patch_id int, cx long, cy long, cz long")
    v = _event_voxels(spark, sf_dir).select("vx", "vy", F.lit(0).cast("long").alias("vz"), r4("top").alias("top"))
    return volume.crops(v, centers, (8, 8, 1)).select("patch_id", "vx", "vy", "top")


@query(_EVENT_VOXELS + """, f AS (SELECT floor(vx / 4) AS bx, floor(vy / 4) AS b_y, avg(top) AS f FROM e GROUP BY 1, 2)
SELECT vx, vy, round(top / f, 6) AS value FROM e JOIN f ON bx = floor(vx / 4) AND b_y = floor(vy / 4)""")
def bias_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values divided by a coarse field, here their own block means."""
    v = _event_voxels(spark, sf_dir).select("vx", "vy", F.lit(0).cast("long").alias("vz"), F.col("top").alias("value"))
    return volume.bias_corrected(v, agg.block_mean(v, 4, "value"), 4).select("vx", "vy", F.round("value", 6).alias("value"))


@query(_EVENT_VOXELS + """, f AS (SELECT floor(vx / 8) AS bx, floor(vy / 8) AS b_y, avg(top) / 1000 AS f FROM e GROUP BY 1, 2)
SELECT vx, vy, round(top / exp(f), 5) AS value FROM e JOIN f ON bx = floor(vx / 8) AND b_y = floor(vy / 8)""")
def bias_correct_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values divided by the exponential of a coarse field."""
    v = _event_voxels(spark, sf_dir).select("vx", "vy", F.lit(0).cast("long").alias("vz"), F.col("top").alias("value"))
    field = agg.block_mean(v, 8, "value").withColumn("value", F.col("value") / 1000)
    return volume.bias_corrected(v, field, 8, log_field=True).select("vx", "vy", F.round("value", 5).alias("value"))


@query("""SELECT CAST(day(ts) AS BIGINT) AS vx, user_id % 20 AS vy, round(sum(value), 4) AS value FROM events GROUP BY 1, 2""")
def accumulate_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the images of all event types, voxel by voxel."""
    e = table(spark, sf_dir, "events").groupBy("event_type", F.dayofmonth("ts").cast("long").alias("vx"), (F.col("user_id") % 20).alias("vy")).agg(F.sum("value").alias("value"))
    return agg.accumulated(e, "value", ("vx", "vy")).select("vx", "vy", r4("value").alias("value"))


@query("""SELECT DISTINCT c_mktsegment AS stain, c_mktsegment IN ('BUILDING', 'MACHINERY', 'NOWHERE') AS requested FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""")
def stain_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stains that are there, without the ignored ones, and whether they were asked for."""
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "stain string")
    there = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("stain")).distinct().join(one("HOUSEHOLD"), "stain", "left_anti")
    return there.join(one("BUILDING", "MACHINERY", "NOWHERE").withColumn("_r", F.lit(True)), "stain", "left").select("stain", F.coalesce("_r", F.lit(False)).alias("requested"))


@query("""SELECT c_nationkey, arg_min(c_mktsegment, CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 END) AS stain FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING') GROUP BY 1""")
def first_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first stain of a list of preferences that each subject has."""
    rank = F.array_position(F.array(F.lit("MACHINERY"), F.lit("BUILDING")), F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").withColumn("rank", rank).where("rank > 0").groupBy("c_nationkey").agg(F.min_by("c_mktsegment", "rank").alias("stain"))


@query(_EVENT_VOXELS + """, t AS (SELECT unnest(range(-4, 5)) AS d), p AS (SELECT a.vx, a.vy, sum(b.value * exp(-0.5 * pow(d / 1.5, 2))) / sum(exp(-0.5 * pow(d / 1.5, 2))) AS value FROM e a CROSS JOIN t JOIN e b ON b.vx = a.vx + d AND b.vy = a.vy GROUP BY 1, 2)
SELECT a.vx, a.vy, round(sum(b.value * exp(-0.5 * pow(d / 1.5, 2))) / sum(exp(-0.5 * pow(d / 1.5, 2))), 6) AS value FROM e a CROSS JOIN t JOIN p b ON b.vy = a.vy + d AND b.vx = a.vx GROUP BY 1, 2""")
def smoothed_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A separable Gaussian mean of an image over the voxels that are there."""
    v = _event_voxels(spark, sf_dir).select("vx", "vy", F.lit(0).cast("long").alias("vz"), "value")
    return volume.gaussian_smoothed(v, 1.5).select("vx", "vy", F.round("value", 6).alias("value"))


_PYRAMID_VOXELS = "SELECT CAST(day(ts) AS BIGINT) AS vx, user_id % 20 AS vy, CAST(event_id % 7 AS BIGINT) AS vz, avg(value) AS value FROM events GROUP BY 1, 2, 3"


def _levelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.dayofmonth("ts").cast("long").alias("vx"), (F.col("user_id") % 20).cast("long").alias("vy"), (F.col("event_id") % 7).cast("long").alias("vz"), "value")
    return e.groupBy("vx", "vy", "vz").agg(F.avg("value").alias("value"))


@query(f"""WITH v AS ({_PYRAMID_VOXELS}), l AS (SELECT unnest(range(4)) AS k)
SELECT CAST(k AS INTEGER) AS level, CAST(floor(vx / pow(2, k)) AS BIGINT) AS vx, CAST(floor(vy / pow(2, k)) AS BIGINT) AS vy, CAST(floor(vz / pow(2, k)) AS BIGINT) AS vz, round(avg(value), 6) AS value, count(*) AS n FROM v, l GROUP BY ALL""")
def level_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four levels of an image, each voxel the mean of all voxels of its block."""
    return levels.pyramid(_levelled(spark, sf_dir), 3).select("level", *levels.AXES, F.round("value", 6).alias("value"), "n")


@query(f"""WITH v AS (SELECT vx, vy, vz, CAST(floor(value / 40) AS BIGINT) AS label FROM ({_PYRAMID_VOXELS})), c AS (SELECT vx // 3 AS x, vy // 3 AS y, vz // 3 AS z, label, count(*) AS n FROM v GROUP BY ALL),
w AS (SELECT x, y, z, label FROM c QUALIFY row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label) = 1)
SELECT v.*, w.label AS coarse FROM v JOIN w ON x = vx // 3 AND y = vy // 3 AND z = vz // 3""")
def level_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the one that most voxels of their block of three a side have."""
    v = _levelled(spark, sf_dir).select(*levels.AXES, F.floor(F.col("value") / 40).cast("long").alias("label"))
    return levels.lowered(levels.raised(v, 3, "label", "vote"), v, 3, "label")


@query(f"""WITH v AS ({_PYRAMID_VOXELS}), c0 AS (SELECT vx // 4 AS x, vy // 4 AS y, vz // 2 AS z, avg(value) AS value FROM v GROUP BY ALL), t AS (SELECT d, exp(-0.5 * d * d) AS w FROM (SELECT unnest(range(-3, 4)) AS d)),
c1 AS (SELECT a.x, a.y, a.z, sum(b.value * w) / sum(w) AS value FROM c0 a CROSS JOIN t JOIN c0 b ON b.x = a.x + d AND b.y = a.y AND b.z = a.z GROUP BY ALL),
c2 AS (SELECT a.x, a.y, a.z, sum(b.value * w) / sum(w) AS value FROM c0 a CROSS JOIN t JOIN c1 b ON b.y = a.y + d AND b.x = a.x AND b.z = a.z GROUP BY ALL),
c3 AS (SELECT a.x, a.y, a.z, sum(b.value * w) / sum(w) AS value FROM c0 a CROSS JOIN t JOIN c2 b ON b.z = a.z + d AND b.x = a.x AND b.y = a.y GROUP BY ALL),
p AS (SELECT *, (vx + 0.5) / 4 - 0.5 AS px, (vy + 0.5) / 4 - 0.5 AS py, (vz + 0.5) / 2 - 0.5 AS pz FROM v),
f AS (SELECT vx, vy, vz, any_value(p.value) AS value, sum(c.value * (1 - abs(px - x)) * (1 - abs(py - y)) * (1 - abs(pz - z))) / sum((1 - abs(px - x)) * (1 - abs(py - y)) * (1 - abs(pz - z))) AS field
FROM p JOIN c3 c ON x BETWEEN floor(px) AND floor(px) + 1 AND y BETWEEN floor(py) AND floor(py) + 1 AND z BETWEEN floor(pz) AND floor(pz) + 1 GROUP BY ALL)
SELECT vx, vy, vz, round(field, 6) AS field, round(value / field, 6) AS corrected FROM f""")
def bias_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image divided by a smooth field of its block means, interpolated between the blocks."""
    out = levels.bias_field_corrected(_levelled(spark, sf_dir), (4, 4, 2), 1.0)
    return out.select(*levels.AXES, F.round("field", 6).alias("field"), F.round("corrected", 6).alias("corrected"))


# --- graphs ----------------------------------------------------------------------------------------------------------------------------------


_SKELETON = """WITH s AS (SELECT DISTINCT CAST(l_linenumber % 2 AS BIGINT) AS channel, CAST(l_partkey % 60 AS BIGINT) AS x, CAST(l_suppkey % 60 AS BIGINT) AS y, CAST(l_orderkey // 100 AS BIGINT) AS z FROM lineitem),
d AS (SELECT i, j, k FROM (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j), (SELECT unnest([-1, 0, 1]) AS k) WHERE (i, j, k) > (0, 0, 0)),
e AS (SELECT a.channel, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS b_y, b.z AS bz, (a.x + a.y) % 5 AS ra, (b.x + b.y) % 5 AS rb, sqrt((b.x-a.x)*(b.x-a.x)*4 + (b.y-a.y)*(b.y-a.y)*9 + (b.z-a.z)*(b.z-a.z)*16) AS len
FROM (SELECT s.*, x + i AS nx, y + j AS ny, z + k AS nz FROM s CROSS JOIN d) a JOIN s b ON a.channel = b.channel AND b.x = nx AND b.y = ny AND b.z = nz) """
_SPACING = [[2.0, 0, 0, 10], [0, 3.0, 0, 20], [0, 0, 4.0, 30], [0, 0, 0, 1]]


def _skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The voxels of all line items, some more than once; the volume grows along z with the orders."""
    place = {"vox_x": F.col("l_partkey") % 60, "vox_y": F.col("l_suppkey") % 60, "vox_z": F.expr("l_orderkey div 100")}
    s = table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") % 2).cast("long").alias("channel"), *[c.cast("long").alias(a) for a, c in place.items()])
    return s.withColumn("radius", (-(F.col("vox_x") + F.col("vox_y")) % 5).cast("double"))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.skeleton_edges(_skeleton(spark, sf_dir), _SPACING)


@query(_SKELETON + "SELECT channel, ax AS src_vox_x, ay AS src_vox_y, az AS src_vox_z, bx AS dst_vox_x, b_y AS dst_vox_y, bz AS dst_vox_z, round(len, 6) AS edge_length, CAST(ra AS DOUBLE) AS src_radius FROM e")
def edge_list_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of a skeleton between touching voxels, each once."""
    return _edges(spark, sf_dir).select("channel", *[f"{e}_{v}" for e in ("src", "dst") for v in graph.VOXEL], F.round("edge_length", 6).alias("edge_length"), "src_radius")


@query(_SKELETON + """, n AS (SELECT DISTINCT channel, x, y, z, r FROM (SELECT channel, ax AS x, ay AS y, az AS z, ra AS r FROM e UNION ALL SELECT channel, bx, b_y, bz, rb FROM e))
SELECT row_number() OVER (ORDER BY channel, z, y, x) - 1 AS node_id, channel, x AS vox_x, y AS vox_y, z AS vox_z, round(CAST(2 * x + 10 AS DOUBLE), 4) AS x, round(CAST(r AS DOUBLE), 4) AS radius FROM n""")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.skeleton_nodes(_skeleton(spark, sf_dir), _SPACING).select("node_id", "channel", *graph.VOXEL, r4("x").alias("x"), r4("radius").alias("radius"))


@query(_SKELETON + """, n AS (SELECT *, row_number() OVER (ORDER BY channel, z, y, x) - 1 AS id FROM (SELECT channel, ax AS x, ay AS y, az AS z FROM e UNION SELECT channel, bx, b_y, bz FROM e))
SELECT row_number() OVER (ORDER BY e.channel, p.id, q.id) - 1 AS edge_id, e.channel, p.id AS src_node_id, q.id AS dst_node_id, round(len, 6) AS edge_length
FROM e JOIN n p ON p.channel = e.channel AND p.x = ax AND p.y = ay AND p.z = az JOIN n q ON q.channel = e.channel AND q.x = bx AND q.y = b_y AND q.z = bz""")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = graph.skeleton_nodes(_skeleton(spark, sf_dir), _SPACING)
    return graph.skeleton_graph_edges(nodes, _SPACING).select("edge_id", "channel", "src_node_id", "dst_node_id", F.round("edge_length", 6).alias("edge_length"))


def _mask(spark: SparkSession, sf_dir: str, side: int) -> DataFrame:
    """Voxels of the large items in a box of ``side`` by ``side`` that grows along z with the orders."""
    place = {"vx": F.col("l_partkey") % side, "vy": F.col("l_suppkey") % side, "vz": F.expr("l_orderkey div 100")}
    return table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(*[c.cast("long").alias(a) for a, c in place.items()]).distinct()


def _mask_sql(side: int) -> str:
    return f"SELECT DISTINCT l_partkey % {side} AS x, l_suppkey % {side} AS y, l_orderkey // 100 AS z FROM lineitem WHERE l_quantity > 45"


@query(f"""WITH RECURSIVE v AS ({_mask_sql(24)}), m AS (SELECT x, y, z, (x * 24 + y) * 1000000 + z AS id FROM v), d AS (SELECT * FROM (VALUES (1, 0, 0), (0, 1, 0), (0, 0, 1)) t(i, j, k)),
h AS (SELECT a.id AS a, b.id AS b FROM m a CROSS JOIN d JOIN m b ON b.x = a.x + i AND b.y = a.y + j AND b.z = a.z + k), e AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT id AS a, id AS b FROM m UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b), l AS (SELECT a, min(b) AS label FROM r GROUP BY 1)
SELECT round(2 * avg(x) + 10, 6) AS pos_x, round(3 * avg(y) + 20, 6) AS pos_y, round(4 * avg(z) + 30, 6) AS pos_z, count(*) AS nvoxels FROM l JOIN m ON m.id = l.a GROUP BY label""")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects from a mask: voxels that share faces, their mean position and size."""
    out = graph.component_objects(graph.voxel_components(_mask(spark, sf_dir, 24), 6), _SPACING)
    return out.select(*[F.round(f"pos_{a}", 6).alias(f"pos_{a}") for a in "xyz"], "nvoxels")


_VOLUME = "SELECT l_partkey % 40 AS vx, l_suppkey % 30 AS vy, l_orderkey // 100 AS vz, max(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3"


def _written(spark: SparkSession, sf_dir: str, value: Column, width: tuple[int, int]) -> str:
    """A volume of line items as chunks in the shared folder; it grows along z with the orders."""
    items = table(spark, sf_dir, "lineitem")
    place = {"vx": F.col("l_partkey") % width[0], "vy": F.col("l_suppkey") % width[1], "vz": F.expr("l_orderkey div 100")}
    voxels = items.select(*[c.cast("long").alias(a) for a, c in place.items()], value.cast("double").alias("value"))
    depth = items.agg(F.max(F.expr("l_orderkey div 100"))).first()[0]
    path = f"{graph.shared_folder(spark)}/volume-{uuid.uuid4().hex}"
    chunks.write_chunks(voxels, path, [chunks.level_head((*width, int(depth or 0) + 1), (16, 16, 64), (2.0, 2.0, 4.0))], ["items"])
    return path


@query(f"""SELECT vx, vy, vz, value FROM ({_VOLUME}) WHERE vx BETWEEN 5 AND 29 AND vy BETWEEN 10 AND 17 AND vz >= 3""")
def chunk_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of a volume that was written as chunks: the chunks beside it aren't opened."""
    volume_ = chunks.read_chunks(spark, _written(spark, sf_dir, F.col("l_quantity"), (40, 30)), 0, "items", ((5, 30), (10, 18), (0, 1 << 40)))
    return volume_.where("vz >= 3").select(*chunks.AXES, "value")


@query("""WITH v AS (SELECT max(l_suppkey % 30) AS label FROM lineitem GROUP BY l_partkey % 40, l_suppkey % 20, l_orderkey // 100), c AS (SELECT label AS "index", count(*) AS n FROM v WHERE label > 0 GROUP BY 1)
SELECT "index", n_name AS name, coalesce(n, 0) AS n_voxels, n_name IS NOT NULL AS in_table FROM c FULL JOIN (SELECT n_nationkey AS "index", n_name FROM nation WHERE n_nationkey > 0) USING ("index")""")
def atlas_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a volume of chunks beside their table: how many voxels each has, and which the table lacks."""
    path = _written(spark, sf_dir, F.col("l_suppkey") % 30, (40, 20))
    return chunks.label_check(*chunks.read_atlas(spark, path, labels(spark, sf_dir), strict=False))


_STAIN_LEAST = {"A": 3, "R": 5}


@query(f"""WITH RECURSIVE m AS (SELECT DISTINCT l_returnflag AS stain, l_partkey % 24 AS x, l_suppkey % 24 AS y, l_orderkey // 100 AS z FROM lineitem WHERE l_quantity > 35), n AS (SELECT *, (x * 24 + y) * 1000000 + z AS id FROM m), d AS (SELECT * FROM (VALUES (1, 0, 0), (0, 1, 0), (0, 0, 1)) t(i, j, k)),
h AS (SELECT a.stain, a.id AS a, b.id AS b FROM n a CROSS JOIN d JOIN n b ON b.stain = a.stain AND b.x = a.x + i AND b.y = a.y + j AND b.z = a.z + k), e AS (SELECT stain, a, b FROM h UNION ALL SELECT stain, b, a FROM h),
r AS (SELECT stain, id AS a, id AS b FROM n UNION SELECT r.stain, r.a, e.b FROM r JOIN e ON e.stain = r.stain AND e.a = r.b), l AS (SELECT stain, a, min(b) AS label FROM r GROUP BY 1, 2)
SELECT l.stain, round(2 * avg(x) + 10, 6) AS pos_x, count(*) AS nvoxels FROM l JOIN n ON n.stain = l.stain AND n.id = l.a GROUP BY l.stain, label HAVING count(*) >= CASE l.stain WHEN 'A' THEN 3 WHEN 'R' THEN 5 ELSE 2 END""")
def stain_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of each stain that have at least as many voxels as the stain asks for."""
    place = {"vx": F.col("l_partkey") % 24, "vy": F.col("l_suppkey") % 24, "vz": F.expr("l_orderkey div 100")}
    every = table(spark, sf_dir, "lineitem").where("l_quantity > 35").select(F.col("l_returnflag").alias("stain"), *[c.cast("long").alias(a) for a, c in place.items()])
    parts = []
    for stain in ("A", "N", "R"):
        objects_ = graph.component_objects(graph.voxel_components(every.where(F.col("stain") == stain), 6), _SPACING, _STAIN_LEAST.get(stain, 2))
        parts.append(objects_.select(F.lit(stain).alias("stain"), F.round("pos_x", 6).alias("pos_x"), "nvoxels"))
    return parts[0].union(parts[1]).union(parts[2])


@query(f"""WITH RECURSIVE v AS ({_mask_sql(24)}), m AS (SELECT DISTINCT x // 2 AS x, y // 2 AS y, z // 4 AS z FROM v), n AS (SELECT x, y, z, (x * 24 + y) * 1000000 + z AS id FROM m), d AS (SELECT * FROM (VALUES (1, 0, 0), (0, 1, 0), (0, 0, 1)) t(i, j, k)),
h AS (SELECT a.id AS a, b.id AS b FROM n a CROSS JOIN d JOIN n b ON b.x = a.x + i AND b.y = a.y + j AND b.z = a.z + k), e AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT id AS a, id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b), l AS (SELECT a, min(b) AS label FROM r GROUP BY 1),
g AS (SELECT label FROM l JOIN n ON n.id = a GROUP BY label HAVING count(*) >= 0.4 * (max(x) - min(x) + 1) * (max(y) - min(y) + 1) * (max(z) - min(z) + 1))
SELECT v.x AS vx, v.y AS vy, v.z AS vz FROM v JOIN n ON n.x = v.x // 2 AND n.y = v.y // 2 AND n.z = v.z // 4 JOIN l ON l.a = n.id SEMI JOIN g USING (label)""")
def cleaned_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voxels of a mask whose object, on a coarser level, fills enough of its box."""
    return levels.cleaned_at_level(_mask(spark, sf_dir, 24), (2, 2, 4), 0.4, 6)


@query(f"""WITH m AS ({_mask_sql(12)}), s AS (SELECT max(l_orderkey) // 100 + 1 AS n FROM lineitem),
b AS (SELECT i % 12 AS x, i // 12 % 12 AS y, i // 144 AS z FROM (SELECT unnest(range(144 * n)) AS i FROM s)), o AS (SELECT b.* FROM b ANTI JOIN m USING (x, y, z))
SELECT o.x AS vx, o.y AS vy, o.z AS vz, round(sqrt(min((o.x-m.x)*(o.x-m.x)*4 + (o.y-m.y)*(o.y-m.y)*9 + (o.z-m.z)*(o.z-m.z)*16)), 6) AS sdt FROM o CROSS JOIN m GROUP BY 1, 2, 3
UNION ALL SELECT m.x, m.y, m.z, round(-sqrt(min((o.x-m.x)*(o.x-m.x)*4 + (o.y-m.y)*(o.y-m.y)*9 + (o.z-m.z)*(o.z-m.z)*16)), 6) FROM m CROSS JOIN o GROUP BY 1, 2, 3""")
def signed_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact signed distances of a box of voxels to a mask."""
    depth = table(spark, sf_dir, "lineitem").agg(F.max(F.expr("l_orderkey div 100"))).first()[0] + 1
    return volume.signed_distance(_mask(spark, sf_dir, 12), (12, 12, depth), (2.0, 3.0, 4.0)).select("vx", "vy", "vz", F.round("sdt", 6).alias("sdt"))


@query(f"""WITH m AS ({_mask_sql(24)}), v AS (SELECT x, y, z, CAST((x * 7 + y * 3 + z) % 11 AS DOUBLE) AS value FROM m), d AS (SELECT i, j, k FROM (SELECT unnest(range(-2, 3)) AS i), (SELECT unnest(range(-2, 3)) AS j), (SELECT unnest(range(-2, 3)) AS k)),
b AS (SELECT a.x, a.y, a.z, a.x + i AS p, a.y + j AS q, a.z + k AS r FROM v a CROSS JOIN d)
SELECT b.x AS vx, b.y AS vy, b.z AS vz, round(avg(value), 6) AS mean, count(*) AS n FROM b JOIN v ON v.x = p AND v.y = q AND v.z = r GROUP BY 1, 2, 3""")
def tile_stencil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the voxels within two of each voxel along every axis, by tiles with a halo."""
    voxels = _mask(spark, sf_dir, 24).withColumn("value", ((F.col("vx") * 7 + F.col("vy") * 3 + F.col("vz")) % 11).cast("double"))
    return tiles.box_mean(voxels, 2).select(*tiles.AXES, F.round("mean", 6).alias("mean"), "n")


@query()
def thinned_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skeleton voxels of a mask, thinned tile by tile."""
    place = {"vx": F.col("l_partkey") % 24, "vy": F.col("l_suppkey") % 24, "vz": F.expr("l_orderkey div 100")}
    solid = table(spark, sf_dir, "lineitem").where("l_quantity > 20").select(*[c.cast("long").alias(a) for a, c in place.items()]).distinct()
    return thinning.thinned(solid)


_BLOCKS = "SELECT channel, ax AS src_vox_x, ay AS src_vox_y, az AS src_vox_z, bx AS dst_vox_x, b_y AS dst_vox_y, bz AS dst_vox_z, round(len, 6) AS edge_length FROM e WHERE channel = 0"


@query(_SKELETON + _BLOCKS)
def edges_of_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edge lists of overlapping blocks, one that is missing and one that is empty, as one list."""
    e = _edges(spark, sf_dir).where("channel = 0")
    blocks = [e.where("src_vox_x < 40"), None, e.where("src_vox_x >= 30").drop("src_radius"), e.limit(0)]
    return graph.edges_of_blocks(spark, blocks).select("channel", *[f"{a}_{v}" for a in ("src", "dst") for v in graph.VOXEL], F.round("edge_length", 6).alias("edge_length"))


# --- text and metadata -----------------------------------------------------------------------------------------------------------------------


@query("""SELECT page_id, nullif(regexp_extract(url, '(?:^|/)(blog[^/]*)', 1), '') AS participant_id FROM pages""")
def path_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", path_entity(F.col("url"), "blog").alias("participant_id"))


@query("""SELECT p_partkey, printf('%02x%02x%02x', CAST(p_size AS INTEGER), CAST(p_partkey % 256 AS INTEGER), CAST(p_partkey * 7 % 256 AS INTEGER)) AS color, CAST(p_partkey % 256 AS INTEGER) AS green,
CASE WHEN length(trim(regexp_replace(p_name, '[^a-zA-Z0-9]+', '_', 'g'), '_')) > 0 THEN trim(regexp_replace(p_name, '[^a-zA-Z0-9]+', '_', 'g'), '_') ELSE 'idx' || p_partkey END AS slug FROM part""")
def lut_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours to and from hexadecimal digits, and labels as file names."""
    p = table(spark, sf_dir, "part")
    color = rgb_hex(F.col("p_size"), F.col("p_partkey") % 256, F.col("p_partkey") * 7 % 256)
    return p.select("p_partkey", color.alias("color"), hex_channel(color, 1).alias("green"), slug(F.col("p_name"), F.concat(F.lit("idx"), F.col("p_partkey").cast("string"))).alias("slug"))


@query("""SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events""")
def sidecar_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first setting of each JSON object."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.map_values(F.from_json("props", "map<string,string>"))[0].alias("first_value"))


_KNOWN = {
    "index": {"Description": "Label of the region."},
    "count": {"LongName": "Count", "Description": "Objects of the region.", "Units": "objects"},
    "price": {"LongName": "Price", "Units": "money"},
    "tstat": {"LongName": "t statistic", "Description": "Student's t statistic"},
}
_DICTIONARY = {  # what the rules make of each column of the two tables
    "index": (None, "Label of the region.", None),
    "name": (None, None, None),
    **{f"{s}+count": (f"Count ({s})", f"Objects of the region. Stain/channel: {s}.", "objects") for s in "ANR"},
    **{f"{s}+nvoxels": (f"nvoxels ({s})", f"Metric 'nvoxels' for stain/channel '{s}'.", None) for s in "ANR"},
    **{f"{s}+price": (f"Price ({s})", f"Metric 'price' for stain/channel '{s}'.", "money") for s in "ANR"},
    "n_AUTOMOBILE": ("Number of subjects (group: AUTOMOBILE)", "Number of subjects in group 'AUTOMOBILE' contributing data to this row.", None),
    "n_BUILDING": ("Number of subjects (group: BUILDING)", "Number of subjects in group 'BUILDING' contributing data to this row.", None),
    "price_mean_AUTOMOBILE": ("Price – Mean (group: AUTOMOBILE)", "Mean of 'price' for group 'AUTOMOBILE'.", "money"),
    "price_mean_BUILDING": ("Price – Mean (group: BUILDING)", "Mean of 'price' for group 'BUILDING'.", "money"),
    "price_tstat": ("Price – t statistic", "Student's t statistic for metric 'price'.", None),
}


def _dictionary_sql(name: str, columns: list[str]) -> str:
    text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    rows = [f"""SELECT '{name}' AS source, {text(c)} AS "column", {text(a)} AS long_name, {text(b)} AS description, {text(u)} AS units, count("{c}") AS n_values FROM {name}""" for c in columns for a, b, u in [_DICTIONARY[c]]]
    return " UNION ALL ".join(rows)


_WIDE_COLUMNS = ["index", "name", *(f"{s}+{m}" for s in "ANR" for m in ("count", "nvoxels", "price"))]


@query(f"WITH wide AS ({ORACLES['merge_stains_wide']}), stats AS ({ORACLES['group_stats_wide']}) {_dictionary_sql('wide', _WIDE_COLUMNS)} UNION ALL {_dictionary_sql('stats', [c for c in _DICTIONARY if c.startswith(('n_', 'price_'))])}")
def column_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of the columns of a wide region table and of a table of statistics, with how many rows have a value."""
    of = lambda name, df: sources.column_dictionary(df, describe_columns(df.columns, _KNOWN, ("tstat",))).select(F.lit(name).alias("source"), "*")
    return of("wide", merge_stains_wide(spark, sf_dir)).union(of("stats", group_stats_wide(spark, sf_dir).drop("region")))


@query("""WITH c AS (SELECT n_nationkey AS "index", n_name AS name, CASE WHEN n_regionkey = 2 THEN printf('%02x10ff', n_nationkey) END AS color, row_number() OVER (ORDER BY n_nationkey, n_name) - 1 AS i, count(*) OVER () AS n FROM nation),
p AS (SELECT *, coalesce(color, (""" + str(list(PALETTE)) + """)[CAST(least(floor(i / greatest(n - 1, 1) * 20), 19) AS INTEGER) + 1]) AS c FROM c)
SELECT "index", concat_ws(chr(9), "index", CAST('0x' || c[1:2] AS INTEGER), CAST('0x' || c[3:4] AS INTEGER), CAST('0x' || c[5:6] AS INTEGER), (i > 0)::INTEGER, (i > 0)::INTEGER, (i > 0)::INTEGER, '"' || name || '"') AS value FROM p""")
def label_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a label description file; labels without a colour take the palette's at their place."""
    n = table(spark, sf_dir, "nation")
    color = F.when(F.col("n_regionkey") == 2, rgb_hex(F.col("n_nationkey"), F.lit(16), F.lit(255)))
    return itksnap_lines(n.select(F.col("n_nationkey").alias("index"), F.col("n_name").alias("name"), color.alias("color")))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{graph.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""SELECT c_custkey AS "index", CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS name, CASE WHEN c_custkey % 5 <> 0 THEN round(c_acctbal, 2) END AS value, c_custkey % 3 AS size FROM customer""")
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with missing texts and numbers, written with tabs and read again: types are found in what was written."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    out = c.select((k % 3).alias("size"), k.alias("index"), F.when(k % 7 != 0, F.col("c_mktsegment")).alias("name"), F.when(k % 5 != 0, F.round("c_acctbal", 2)).alias("value"))
    path = _scratch(spark, "table")
    sources.write_tsv(out, path, ["index", "name", "value", "size"])
    if sources.header(spark, path) != ["index", "name", "value", "size"]:
        raise ValueError("the columns are not in the order that was asked for")
    return sources.read_tsv(spark, path)


@query("""SELECT 'sub-' || lower(c_mktsegment) AS participant_id, c_nationkey AS "index", count(*) AS count, CASE WHEN c_mktsegment < 'C' THEN round(avg(c_acctbal), 4) END AS balance FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_mktsegment, c_nationkey""")
def subject_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region tables of subjects in files of their own, some without a column and one without a subject in its path, read as one with the subject of each."""
    c, root = table(spark, sf_dir, "customer"), _scratch(spark, "study")
    paths = []
    for (segment,) in c.select("c_mktsegment").distinct().collect():  # a handful of subjects
        own = c.where(F.col("c_mktsegment") == segment).groupBy(F.col("c_nationkey").alias("index")).agg(F.count(F.lit(1)).alias("count"), r4(F.avg("c_acctbal")).alias("balance"))
        paths.append(f"{root}/{'other' if segment == 'MACHINERY' else 'sub-' + segment.lower()}/stats.tsv")
        sources.write_tsv(own if segment < "C" else own.drop("balance"), paths[-1], single=True)
    return sources.read_many(spark, paths).select("participant_id", "index", "count", "balance")


@query("""SELECT 'csv' AS format, n_nationkey AS "index", n_name AS name, substr(n_name, 1, 3) AS abbreviation, NULL AS color FROM nation
UNION ALL SELECT 'json', n_nationkey, n_name, substr(n_name, 1, 3), printf('%02x10ff', n_nationkey) FROM nation UNION ALL SELECT 'text', n_nationkey, n_name, NULL, printf('%02x10ff', n_nationkey) FROM nation""")
def label_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label table in three formats, written and read again; each has the columns that its format knows."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("index"), F.col("n_name").alias("name"), F.substring("n_name", 1, 3).alias("abbreviation"))
    n = n.withColumn("color", rgb_hex(F.col("index"), F.lit(16), F.lit(255)))
    csv, text, json_ = (_scratch(spark, x) for x in ("csv", "itksnap", "json"))
    n.select("abbreviation", "name", "index").write.csv(csv)
    sources.write_itksnap(n, text)
    rows = F.to_json(F.sort_array(F.collect_list(F.array(F.col("index").cast("string"), "color", "abbreviation", "name"))))  # a label table, not data
    n.agg(rows.alias("value")).coalesce(1).write.text(json_)
    none = lambda c: F.lit(None).cast("string").alias(c)
    parts = [sources.read_labels_csv(spark, csv).select(F.lit("csv").alias("format"), "index", "name", "abbreviation", none("color")), sources.read_labels_json(spark, json_).select(F.lit("json").alias("format"), "index", "name", "abbreviation", "color"),
             sources.read_labels_itksnap(spark, text).select(F.lit("text").alias("format"), "index", "name", none("abbreviation"), "color")]
    return parts[0].union(parts[1]).union(parts[2])


@query("""SELECT event_id, k AS setting, json_extract_string(props, '$."' || k || '"') AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def sidecar_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every setting of each JSON object."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("setting", "value"))


@query("""SELECT p_name, nullif(regexp_extract(path, 'sub-([A-Za-z0-9]+)', 1), '') AS sub, nullif(regexp_extract(path, 'stain-([A-Za-z0-9]+)', 1), '') AS stain FROM (SELECT p_name, CASE WHEN p_partkey % 3 = 0 THEN 'data/readme.txt' ELSE 'data/sub-' || p_partkey % 10 || '/micr/sub-' || p_partkey % 10 || CASE WHEN p_partkey % 4 = 0 THEN '_stain-abeta' ELSE '' END || '_SPIM.ome.zarr' END AS path, p_partkey FROM part)
WHERE p_partkey % 3 <> 0 AND p_partkey % 10 IN (1, 2, 3, 4) AND p_partkey % 10 <> 3""")
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a data set by the parts of their names, for some participants and not for others."""
    k = F.col("p_partkey")
    path = F.when(k % 3 == 0, F.lit("data/readme.txt")).otherwise(F.concat(F.lit("data/sub-"), k % 10, F.lit("/micr/sub-"), k % 10, F.when(k % 4 == 0, "_stain-abeta").otherwise(""), F.lit("_SPIM.ome.zarr")))
    files = table(spark, sf_dir, "part").select("p_name", path.alias("path"))
    found = discovered(entities(files), {"extension": ".ome.zarr"}, include=["sub-1", "2", "3", "4"], exclude=["3"])
    return found.select("p_name", "sub", "stain")


@query(_V + "SELECT vec_id, round(0.1 * x - 0.5, 6) AS x, round(sqrt(x * x + y * y), 5) AS size FROM v")
def affine_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(spark, sf_dir)
    x, _, _ = affine(_GRID, F.col("pos_x"), F.col("pos_y"), F.col("pos_z"))
    return v.select("vec_id", F.round(x, 6).alias("x"), F.round(norm(F.col("pos_x"), F.col("pos_y")), 5).alias("size"))
