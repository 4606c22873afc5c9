"""Registered queries, one for each operator family, with the SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.operators import beads, drift as drifts, merging, naming, proximity, qc, shape, summaries, traces, tracing
from spotweave.operators.components import connected_components
from spotweave.operators.geometry import AXES
from spotweave.plans import adapters as ad

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NEAR = 8.0  # threshold in the adapters' units; twelve is denser
SCALE = ad.SCALE
CENTRES = [f"{a}c" for a in AXES]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(c: str | Column, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def cell(c: str) -> Column:
    return naming.int_set_cell(F.col(c)).alias(c)


def dist_sql(a: str, b: str, s: tuple = SCALE) -> str:
    return "sqrt(" + " + ".join(f"pow(({a}.{x}c - {b}.{x}c) * {k}, 2)" for x, k in zip(AXES, s, strict=True)) + ")"


D = dist_sql("a", "b")
PAIRS = "a.fov AS fov, a.channel AS channel, a.roi_id AS roi_id_1, b.roi_id AS roi_id_2, a.timepoint AS timepoint_1, b.timepoint AS timepoint_2"
NEAR_SQL = f"near AS (SELECT a.roi_id AS src, b.roi_id AS dst, {D} AS d FROM roi a JOIN roi b ON a.fov = b.fov AND a.timepoint = b.timepoint AND a.channel = b.channel AND a.roi_id <> b.roi_id WHERE {D} < {NEAR})"
REACH = "reach(node, other) AS (SELECT src, dst FROM near UNION SELECT r.node, n.dst FROM reach r JOIN near n ON n.src = r.other)"
COMP = "comp AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)"


def region_pair_rows(rois: DataFrame) -> DataFrame:
    p = proximity.group_pairs(rois, ["fov", "channel"], "roi_id", ["timepoint"], SCALE, most=4096)
    return p.select(F.col("fov_1").alias("fov"), F.col("channel_1").alias("channel"), "roi_id_1", "roi_id_2", "timepoint_1", "timepoint_2", r6("distance"))


@query(f"WITH {ad.ROI_SQL} SELECT {PAIRS}, round({D}, 6) AS distance FROM roi a JOIN roi b ON a.fov = b.fov AND a.channel = b.channel AND a.roi_id < b.roi_id")
def region_pairs(spark, sf):
    """J4, SC1."""
    return region_pair_rows(ad.roi(spark, sf))


@query(f"WITH {ad.ROI_SQL} SELECT {PAIRS}, round({D}, 6) AS distance FROM shifted a JOIN shifted b ON a.fov = b.fov AND a.channel = b.channel AND a.roi_id < b.roi_id")
def region_pairs_drift(spark, sf):
    """J1, P4, J4."""
    r = ad.roi(spark, sf)
    return region_pair_rows(drifts.shift_centre(drifts.with_drift(r, ad.drift(r))))


@query(f"WITH {ad.TRACE_SQL} SELECT a.trace_id AS trace_id, a.locus AS locus_1, b.locus AS locus_2, round({dist_sql('a', 'b', (1, 1, 1))}, 6) AS distance FROM trace a JOIN trace b ON a.trace_id = b.trace_id AND a.locus < b.locus")
def locus_pairs(spark, sf):
    """J3."""
    p = proximity.group_pairs(ad.trace(spark, sf), ["trace_id"], "locus", [])
    return p.select(F.col("trace_id_1").alias("trace_id"), "locus_1", "locus_2", r6("distance"))


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, fov, timepoint, round(zc, 6) AS zc, round(yc, 6) AS yc, round(xc, 6) AS xc FROM shifted")
def drift_apply(spark, sf):
    """J1, P4."""
    r = ad.roi(spark, sf)
    return drifts.shift_centre(drifts.with_drift(r, ad.drift(r))).select("roi_id", "fov", "timepoint", *[r6(c) for c in CENTRES])


_BOX = {"z": 4.0, "y": 8.0, "x": 8.0}


@query("WITH " + ad.ROI_SQL + " SELECT roi_id, " + ", ".join(f"round({a}c - {h} + coarse + fine, 6) AS {a}_min, round({a}c + {h} + coarse + fine, 6) AS {a}_max" for a, h in _BOX.items()) + " FROM roi JOIN drift USING (fov, timepoint)")
def box_shift(spark, sf):
    """P3, P5."""
    r = ad.roi(spark, sf, True)
    return drifts.shift_box(drifts.with_drift(r, ad.drift(r))).select("roi_id", *[r6(f"{a}_{s}") for a in AXES for s in ("min", "max")])


def assessed(spark, sf) -> DataFrame:
    return proximity.assess_merge(ad.roi(spark, sf, True), NEAR, SCALE)


@query(f"WITH {ad.ROI_SQL}, {NEAR_SQL} SELECT r.roi_id AS roi_id, fov, timepoint, coalesce(string_agg(CAST(dst AS VARCHAR), ' ' ORDER BY dst), '') AS merge_partners FROM roi r LEFT JOIN near ON src = roi_id GROUP BY 1, 2, 3")
def merge_assess(spark, sf):
    """J5."""
    return assessed(spark, sf).select("roi_id", "fov", "timepoint", cell("merge_partners"))


@query(f"WITH RECURSIVE {ad.ROI_SQL}, {NEAR_SQL}, {REACH}, {COMP} SELECT node, component FROM comp")
def components(spark, sf):
    """G1, G2."""
    return connected_components(merging.partner_edges(assessed(spark, sf))).select("node", "component")


_MERGED = f"""WITH RECURSIVE {ad.ROI_SQL}, {NEAR_SQL}, {REACH}, {COMP},
grp AS (SELECT component, avg(zc) AS zc, avg(yc) AS yc, avg(xc) AS xc, min(fov) AS fov, min(timepoint) AS timepoint, string_agg(CAST(roi_id AS VARCHAR), ' ' ORDER BY roi_id) AS merge_partners FROM roi JOIN comp ON node = roi_id GROUP BY component),
num AS (SELECT *, (SELECT max(roi_id) FROM roi) + row_number() OVER (ORDER BY component) AS out_id FROM grp)"""


@query(_MERGED + " SELECT CAST(out_id AS BIGINT) AS roi_id, fov, timepoint, round(zc, 6) AS zc, round(yc, 6) AS yc, round(xc, 6) AS xc, round(zc - 4, 6) AS z_min, merge_partners FROM num UNION ALL SELECT roi_id, fov, timepoint, round(zc, 6), round(yc, 6), round(xc, 6), round(zc - 4, 6), '' FROM roi WHERE roi_id NOT IN (SELECT node FROM comp)")
def merge_execute(spark, sf):
    """G2 to G4, S8, W7, A12, A13."""
    _, out = merging.merge_rois(assessed(spark, sf))
    return out.select("roi_id", "fov", "timepoint", *[r6(c) for c in CENTRES], r6("z_min"), cell("merge_partners"))


@query(_MERGED + " SELECT node AS roi_id, CAST(out_id AS BIGINT) AS merge_output FROM comp JOIN num USING (component)")
def merge_contributors(spark, sf):
    """J16."""
    _, out = merging.merge_rois(assessed(spark, sf))
    return merging.recover_contributors(out, ad.roi(spark, sf)).select("roi_id", "merge_output")


def group_table(spark) -> DataFrame:
    return spark.range(8).select(F.col("id").cast("int").alias("timepoint"), (F.col("id") % 3).cast("int").alias("group_id"))


def exclusion_sql(rule: str) -> str:
    return f"""WITH {ad.ROI_SQL}, close AS (SELECT a.roi_id AS roi_id, b.roi_id AS other FROM shifted a JOIN shifted b ON a.fov = b.fov AND a.channel = b.channel AND a.timepoint <> b.timepoint WHERE {D} < {NEAR} AND {rule}),
bad AS (SELECT roi_id, string_agg(CAST(other AS VARCHAR), ' ' ORDER BY other) AS too_close FROM close GROUP BY roi_id)
SELECT s.roi_id AS roi_id, round(r.zc, 6) AS zc, bad.roi_id IS NULL AS kept, coalesce(too_close, '') AS too_close FROM shifted s JOIN roi r USING (roi_id) LEFT JOIN bad ON bad.roi_id = s.roi_id"""


def exclusion(spark, sf, strategy: str) -> DataFrame:
    r = ad.roi(spark, sf)
    moved = drifts.shift_centre(drifts.with_drift(r, ad.drift(r)))
    keep, gone = proximity.mutual_exclusion(moved, strategy, NEAR, SCALE, group_table(spark))
    cols = lambda d, ok, c: d.select("roi_id", r6("zc_raw", "zc"), F.lit(ok).alias("kept"), c.alias("too_close"))
    return cols(keep, True, F.lit("")).union(cols(gone, False, naming.int_set_cell(F.col("too_close"))))


@query(exclusion_sql("false"))
def mutual_exclusion_permission(spark, sf):
    """C10 without prohibition."""
    return exclusion(spark, sf, "permission")


@query(exclusion_sql("true"))
def mutual_exclusion_universal(spark, sf):
    """J6, J17, S10."""
    return exclusion(spark, sf, "prohibition")


@query(exclusion_sql("a.timepoint % 3 <> b.timepoint % 3"))
def mutual_exclusion_selective_permit(spark, sf):
    return exclusion(spark, sf, "selective_permission")


@query(exclusion_sql("a.timepoint % 3 = b.timepoint % 3"))
def mutual_exclusion_selective_prohibit(spark, sf):
    return exclusion(spark, sf, "selective_prohibition")


_BEADS = f"""WITH {ad.ROI_SQL}, bead AS (SELECT CAST(vec_id AS BIGINT) AS bead_id, CAST(label AS INT) AS fov, CAST(embedding[4] AS DOUBLE) * 1e2 AS zc, CAST(embedding[5] AS DOUBLE) * 1e2 AS yc, CAST(embedding[6] AS DOUBLE) * 1e2 AS xc FROM embeddings WHERE vec_id % 8 = 0),
hit AS (SELECT a.roi_id AS roi_id, string_agg(CAST(b.bead_id AS VARCHAR), ' ' ORDER BY b.bead_id) AS beads FROM shifted a JOIN bead b ON a.fov = b.fov WHERE {D} < 15 GROUP BY 1)"""


def bead_filtered(spark, sf):
    """Every eighth row of the table plays a bead."""
    r = ad.roi(spark, sf)
    e = ad.read(spark, sf, "embeddings").where("vec_id % 8 = 0")
    b = e.select(F.col("vec_id").cast("long").alias("bead_id"), F.col("label").cast("int").alias("fov"), *[(F.element_at("embedding", i + 4).cast("double") * 100.0).alias(f"{a}c") for i, a in enumerate(AXES)])
    return proximity.spot_bead_filter(drifts.shift_centre(drifts.with_drift(r, ad.drift(r))), b, 15.0, SCALE)


@query(_BEADS + " SELECT roi_id, fov, timepoint FROM shifted WHERE roi_id NOT IN (SELECT roi_id FROM hit)")
def spot_bead_keep(spark, sf):
    """J7 keepers."""
    return bead_filtered(spark, sf)[0].select("roi_id", "fov", "timepoint")


@query(_BEADS + " SELECT roi_id, beads FROM hit")
def spot_bead_discard(spark, sf):
    """J7 discards."""
    return bead_filtered(spark, sf)[1].select("roi_id", cell("beads"))


@query(f"WITH RECURSIVE {ad.ROI_SQL}, {NEAR_SQL}, g AS (SELECT roi_id, roi_id % 40 AS group_id FROM roi), own AS (SELECT n.src AS s, n.dst AS t FROM near n JOIN g g1 ON g1.roi_id = n.src JOIN g g2 ON g2.roi_id = n.dst AND g1.group_id = g2.group_id), reach(node, other) AS (SELECT roi_id, roi_id FROM g UNION SELECT r.node, o.t FROM reach r JOIN own o ON o.s = r.other), c AS (SELECT node, min(other) AS component FROM reach GROUP BY node) SELECT group_id, count(DISTINCT component) AS parts FROM g JOIN c ON node = roi_id GROUP BY group_id HAVING count(DISTINCT component) > 1")
def split_groups(spark, sf):
    """G5."""
    a = assessed(spark, sf)
    g = a.select("roi_id", (F.col("roi_id") % 40).alias("group_id"))
    return merging.split_groups(g, g, merging.partner_edges(a)).select("group_id", "parts")


@query(f"WITH {ad.ROI_SQL} SELECT a.roi_id AS roi_id_1, b.roi_id AS roi_id_2, round({D}, 6) AS distance FROM roi a JOIN roi b ON a.fov = b.fov AND a.timepoint = b.timepoint AND a.roi_id < b.roi_id WHERE {D} < 12")
def ungrouped_violations(spark, sf):
    """G6 over all rois."""
    return proximity.ungrouped_violations(ad.roi(spark, sf), 12.0, SCALE).select("roi_id_1", "roi_id_2", r6("distance"))


GROUPS = {"A": [0, 1, 2], "B": [3, 4]}
_TRACE = f"""WITH RECURSIVE {ad.ROI_SQL}, m AS (SELECT * FROM (VALUES (0, 'A', 3), (1, 'A', 3), (2, 'A', 3), (3, 'B', 2), (4, 'B', 2)) v(timepoint, trace_group, size)),
near AS (SELECT a.roi_id AS src, b.roi_id AS dst FROM roi a JOIN m ma ON ma.timepoint = a.timepoint JOIN roi b ON a.fov = b.fov AND a.channel = b.channel JOIN m mb ON mb.timepoint = b.timepoint AND mb.trace_group = ma.trace_group WHERE a.timepoint <> b.timepoint AND {D} < 16),
reach(node, other) AS (SELECT roi_id, roi_id FROM roi UNION SELECT r.node, n.dst FROM reach r JOIN near n ON n.src = r.other), c AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
s AS (SELECT component, count(*) AS n, count(DISTINCT timepoint) AS times, min(trace_group) AS trace_group, min(size) AS size, list(roi_id ORDER BY roi_id) AS ids FROM roi JOIN c ON node = roi_id LEFT JOIN m USING (timepoint) GROUP BY component)"""


def assigned(spark, sf):
    return traces.assign_traces(ad.roi(spark, sf), GROUPS, 16.0, "disjunctive", False, SCALE)


@query(_TRACE + """, e AS (SELECT *, (SELECT max(roi_id) FROM roi) + row_number() OVER (ORDER BY component) AS trace_id FROM s WHERE (n = 1 AND trace_group IS NULL) OR (n > 1 AND times = n))
SELECT roi_id, CAST(trace_id AS BIGINT) AS trace_id, coalesce(trace_group, '') AS trace_group, coalesce((SELECT string_agg(CAST(x AS VARCHAR), ' ' ORDER BY x) FROM unnest(ids) u(x) WHERE x <> roi_id), '') AS trace_partners, CASE WHEN trace_group IS NOT NULL THEN times = size END AS has_all FROM (SELECT *, unnest(ids) AS roi_id FROM e)""")
def trace_assign(spark, sf):
    """Section 2.11, J8, W5."""
    out, _ = assigned(spark, sf)
    return out.select("roi_id", "trace_id", F.coalesce("trace_group", F.lit("")).alias("trace_group"), cell("trace_partners"), F.col("has_all_partners").alias("has_all"))


@query(_TRACE + " SELECT unnest(ids) AS roi_id, 'collision' AS reason FROM s WHERE n > 1 AND times < n")
def trace_assign_skips(spark, sf):
    """T5, A10."""
    return assigned(spark, sf)[1].select("roi_id", "reason")


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, (SELECT max(roi_id) FROM roi) + row_number() OVER (ORDER BY roi_id) AS trace_id FROM roi")
def trace_assign_no_rules(spark, sf):
    """T1, W6."""
    return traces.assign_without_rules(ad.roi(spark, sf)).select("roi_id", "trace_id")


def loci(spark) -> DataFrame:
    return spark.createDataFrame([(4, 1), (4, 2), (5, 3), (5, 6)], "ref_timepoint int, timepoint int")


@query(f"WITH {ad.ROI_SQL}, l AS (SELECT * FROM (VALUES (4, 1), (4, 2), (5, 3), (5, 6)) v(ref_timepoint, locus)) SELECT r.roi_id AS roi_id, r.fov AS fov, r.timepoint AS ref_timepoint, d.timepoint AS timepoint FROM roi r JOIN drift d ON d.fov = r.fov WHERE r.timepoint IN (4, 5) AND (d.timepoint = r.timepoint OR d.timepoint = 0 OR EXISTS (SELECT 1 FROM l WHERE l.ref_timepoint = r.timepoint AND locus = d.timepoint))")
def bounding_expand(spark, sf):
    """J9, J10."""
    r = ad.roi(spark, sf, True)
    return tracing.expand_bounds(r, ad.drift(r), loci(spark), 0, (400, 400, 400)).select("roi_id", "fov", "ref_timepoint", "timepoint")


def _crop_sql(a: str, half: float, n: int) -> str:
    lo, hi = f"({a}c - {half} - (d.coarse - f.coarse))", f"({a}c + {half} - (d.coarse - f.coarse))"
    length = f"round_even({hi} - {lo}, 0)"
    pick = lambda *x: f"CASE WHEN {lo} >= {n} THEN {x[0]} WHEN {hi} <= 0 THEN {x[1]} WHEN {lo} < 0 THEN {x[2]} WHEN {hi} > {n} THEN {x[3]} ELSE {x[4]} END"
    cols = {"lo": pick(n, 0, 0, lo, lo), "hi": pick(n, 0, hi, n, hi), "pad_lo": pick(length, 0, f"-{lo}", 0, 0), "pad_hi": pick(0, length, 0, f"{hi} - {n}", 0)}
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {a}_{k}" for k, c in cols.items())


@query(f"WITH {ad.ROI_SQL} SELECT r.roi_id AS roi_id, d.timepoint AS timepoint, {_crop_sql('z', 4.0, 40)}, {_crop_sql('y', 8.0, 30)}, {_crop_sql('x', 8.0, 30)} FROM roi r JOIN drift d ON d.fov = r.fov JOIN drift f ON f.fov = r.fov AND f.timepoint = r.timepoint")
def crop_pad(spark, sf):
    """SC9, K8's bounds."""
    r = ad.roi(spark, sf, True)
    out = tracing.expand_bounds(r, ad.drift(r), None, None, (40, 30, 30))
    return out.select("roi_id", "timepoint", *[r6(f"{a}_{k}") for a in AXES for k in ("lo", "hi", "pad_lo", "pad_hi")])


_FITS = ad.FIT_SQL + ", u AS (SELECT trace_id, timepoint, min(fov) AS fov, min(z) AS z, min(y) AS y, min(x) AS x FROM fit GROUP BY 1, 2)"


def unique_fits(spark, sf) -> DataFrame:
    return ad.fit(spark, sf).groupBy("trace_id", "timepoint").agg(*[F.min(c).alias(c) for c in ("fov", "z", "y", "x")])


@query(f"WITH {_FITS} SELECT trace_id, timepoint, round(z / 1e1 + 25e-2, 6) AS z_px_dc, round((z / 1e1 + 25e-2) * 300, 6) AS z_nm FROM u WHERE timepoint <> 3")
def pair_rois_fits(spark, sf):
    """J11, FL13, P6, P7."""
    u = unique_fits(spark, sf).withColumn("roi_id", F.col("trace_id"))
    fits = u.where("timepoint <> 3").select("fov", "trace_id", "roi_id", "timepoint", *[(F.col(a) / 10.0).alias(f"{a}_px") for a in AXES])
    rois = u.select("fov", "trace_id", "roi_id", "timepoint", *[F.lit(0.25).alias(f"{a}_fine") for a in AXES])
    out = tracing.to_nanometres(tracing.pair_rois_fits(rois, fits, background=3), (300.0, 100.0, 100.0))
    return out.select("trace_id", "timepoint", r6("z_px_dc"), r6("z", "z_nm"))


@query(f"WITH {_FITS} SELECT a.trace_id AS trace_id, a.timepoint AS timepoint, round(sqrt(pow(a.z - b.z, 2) + pow(a.y - b.y, 2) + pow(a.x - b.x, 2)), 6) AS ref_dist FROM u a LEFT JOIN u b ON a.trace_id = b.trace_id AND b.timepoint = 1")
def reference_distance(spark, sf):
    """J12."""
    return tracing.with_reference_distance(unique_fits(spark, sf), ["trace_id"], F.col("timepoint") == 1, validate=False).select("trace_id", "timepoint", r6("ref_dist"))


LIMITS = {"max_dist": 800.0, "min_snr": 2.0, "max_sigma_xy": 150.0, "max_sigma_z": 400.0}
_BOUND = lambda a, s, n: f"CAST(greatest({s}, 0) < {a} AND {a} < {n} - greatest({s}, 0) AS INT) AS in_bounds_{a}"
_QC = f"""{ad.FIT_SQL}, q AS (SELECT *, CAST(ref_dist < 800 AS INT) AS within_region, CAST(signal > 2 * background AS INT) AS sufficient_snr, CAST(sigma_xy > 0 AND sigma_xy < 150 AS INT) AS dense_xy, CAST(sigma_z > 0 AND sigma_z < 400 AS INT) AS dense_z,
{_BOUND('z', 'sigma_z', 4800)}, {_BOUND('y', 'sigma_xy', 3434)}, {_BOUND('x', 'sigma_xy', 3434)} FROM fit),
f AS (SELECT *, within_region * sufficient_snr * dense_xy * dense_z * in_bounds_z * in_bounds_y * in_bounds_x AS qc_pass FROM q)"""


def labelled(spark, sf) -> DataFrame:
    return qc.label_qc(ad.fit(spark, sf), **LIMITS)


@query(f"WITH {_QC} SELECT trace_id, timepoint, fov, {', '.join(qc.FLAGS)}, qc_pass FROM f")
def qc_flags(spark, sf):
    """FL4."""
    return labelled(spark, sf).select("trace_id", "timepoint", "fov", *qc.FLAGS, "qc_pass")


@query(f"WITH {_QC} SELECT trace_id, timepoint, fov, qc_pass FROM (SELECT *, count(*) OVER (PARTITION BY trace_id) AS n FROM f WHERE qc_pass = 1 AND timepoint NOT IN (2)) WHERE n >= 2")
def qc_filtered(spark, sf):
    """FL7, FL8."""
    return qc.qc_filtered(labelled(spark, sf), ["trace_id"], [2], 2).select("trace_id", "timepoint", "fov", "qc_pass")


@query(f"WITH {_QC} SELECT fail_code, count(*) AS n FROM (SELECT concat_ws(' ', CASE WHEN within_region = 0 THEN 'R' END, CASE WHEN sufficient_snr = 0 THEN 'S' END, CASE WHEN dense_xy = 0 THEN 'xy' END, CASE WHEN dense_z = 0 THEN 'z' END, CASE WHEN in_bounds_z * in_bounds_y * in_bounds_x = 0 THEN 'O' END) AS fail_code FROM f) GROUP BY 1")
def qc_fail_codes(spark, sf):
    """FL5."""
    return labelled(spark, sf).groupBy(qc.fail_codes().alias("fail_code")).agg(F.count("*").alias("n"))


@query(f"WITH {_QC} SELECT display, count(*) AS n FROM (SELECT CASE WHEN NOT (z / 300 > 0 AND z / 300 < 16 AND y / 100 > 0 AND y / 100 < 32 AND x / 100 > 0 AND x / 100 < 32) THEN 'invisible' WHEN qc_pass = 1 THEN 'pass' ELSE 'fail' END AS display FROM f) GROUP BY 1")
def display_classes(spark, sf):
    """FL6."""
    px = labelled(spark, sf).withColumns({"z_px": F.col("z") / 300, "y_px": F.col("y") / 100, "x_px": F.col("x") / 100})
    return px.groupBy(qc.display_class((16, 32, 32)).alias("display")).agg(F.count("*").alias("n"))


@query(f"WITH {ad.FIT_SQL} SELECT trace_id, fov, dense_rank() OVER (PARTITION BY fov ORDER BY trace_id) - 1 AS trace_index FROM (SELECT DISTINCT trace_id, fov FROM fit)")
def reindex_traces(spark, sf):
    """W2."""
    return traces.reindex(ad.fit(spark, sf).select("trace_id", "fov").distinct(), ["fov"], "trace_id", "trace_index")


@query(f"WITH {ad.FIT_SQL} SELECT trace_id, timepoint, dense_rank() OVER (PARTITION BY trace_id ORDER BY timepoint) - 1 AS time_index FROM (SELECT DISTINCT trace_id, timepoint FROM fit)")
def reindex_times(spark, sf):
    """W2 over timepoints."""
    return traces.reindex(ad.fit(spark, sf).select("trace_id", "timepoint").distinct(), ["trace_id"], "timepoint", "time_index")


@query(f"WITH {ad.BEAD_FILE_SQL} SELECT letter, count(*) AS n FROM (SELECT unnest(string_split(fail_code, '')) AS letter FROM bead_file) WHERE letter <> '' GROUP BY 1")
def bead_fail_histogram(spark, sf):
    """A6."""
    return beads.letter_histogram(ad.bead_file(spark, sf))


@query(f"WITH {ad.BEAD_FILE_SQL} SELECT fov, timepoint, round(max_intensity, 6) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY fov, timepoint ORDER BY max_intensity DESC) AS rn FROM bead_file WHERE fail_code IN ('', 'i')) WHERE rn = 10")
def bead_maxmin_intensity(spark, sf):
    """A7, FL14."""
    ok = ad.bead_file(spark, sf).where(F.col("fail_code").isin("", "i"))
    return beads.nth_largest(ok, ["fov", "timepoint"], "max_intensity", 10).select("fov", "timepoint", r6("nth"))


@query(f"WITH {ad.BEAD_FILE_SQL} SELECT fov, timepoint, count(*) AS n_all, count(*) FILTER (fail_code = '') AS n_pass FROM bead_file GROUP BY 1, 2")
def bead_counts(spark, sf):
    """A4, FL2."""
    return beads.counts_by_status(ad.bead_file(spark, sf), ["fov", "timepoint"], beads.passes())


@query(f"WITH {ad.BEAD_FILE_SQL}, n AS (SELECT fov, timepoint, count(*) AS n FROM bead_file WHERE fail_code = '' GROUP BY 1, 2) SELECT fov, timepoint, n, CASE WHEN n < 3 THEN 0 ELSE least(n, 6) END AS shifting, CASE WHEN n < 3 THEN 0 ELSE greatest(least(n - 6, 4), 0) END AS accuracy, CASE WHEN n < 3 THEN 'severe' WHEN n < 6 THEN 'rescued' WHEN n < 10 THEN 'few_accuracy' ELSE 'full' END AS outcome FROM n")
def bead_partition_sizes(spark, sf):
    """C11."""
    n = ad.bead_file(spark, sf).where(beads.passes()).groupBy("fov", "timepoint").agg(F.count("*").alias("n"))
    return beads.partition_sizes(n, 6, 4, 3)


@query(f"WITH {ad.BEAD_FILE_SQL} SELECT bead_id, fov, timepoint, CASE WHEN rn <= 3 THEN 'shifting' WHEN rn <= 5 THEN 'accuracy' END AS part FROM (SELECT *, row_number() OVER (PARTITION BY fov, timepoint ORDER BY bead_id) AS rn FROM bead_file WHERE fail_code = '')")
def bead_partition(spark, sf):
    """W9 in the order of the ids."""
    return beads.partition_beads(ad.bead_file(spark, sf).where(beads.passes()), 3, 2, None).select("bead_id", "fov", "timepoint", "part")


@query(f"WITH {ad.FIT_SQL}, l AS (SELECT timepoint, 'z' AS variable, z AS v FROM fit UNION ALL SELECT timepoint, 'y', y FROM fit) SELECT timepoint, variable, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75, round(avg(v), 4) AS mean, round(avg(v) - 196e-2 * stddev_samp(v) / sqrt(count(v)), 4) AS low, round(avg(v) + 196e-2 * stddev_samp(v) / sqrt(count(v)), 4) AS high FROM l GROUP BY 1, 2")
def drift_error_summary(spark, sf):
    """A5."""
    out = summaries.summarise(ad.fit(spark, sf), "timepoint", ["z", "y"])
    return out.select("timepoint", "variable", *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75", "mean", "low", "high")])


@query(f"WITH {ad.BEAD_FILE_SQL}, r AS (SELECT fov, timepoint, max_intensity AS v, row_number() OVER (PARTITION BY fov, timepoint ORDER BY max_intensity) AS rn, count(*) OVER (PARTITION BY fov, timepoint) AS n FROM bead_file) SELECT fov, timepoint, round(avg(v), 6) AS trimmed FROM r WHERE rn > floor(n * 2e-1) AND rn <= n - floor(n * 2e-1) GROUP BY 1, 2")
def trimmed_mean_drift(spark, sf):
    """A8."""
    g = ad.bead_file(spark, sf).groupBy("fov", "timepoint").agg(F.collect_list("max_intensity").alias("v"))
    return g.select("fov", "timepoint", r6(drifts.trimmed_mean(F.col("v")), "trimmed"))


@query(f"WITH {ad.ROI_SQL} SELECT fov, timepoint, count(*) AS n FROM roi GROUP BY 1, 2")
def spot_counts_by_fov_time(spark, sf):
    """A1."""
    return summaries.count_by(ad.roi(spark, sf), ["fov", "timepoint"])


@query(f"WITH {_QC} SELECT CASE qc_pass WHEN 1 THEN 'filtered' ELSE 'unfiltered' END AS status, timepoint, count(*) AS n FROM f GROUP BY 1, 2")
def spot_counts_by_status(spark, sf):
    """A2, S7."""
    d = labelled(spark, sf)
    both = d.where("qc_pass = 1").withColumn("status", F.lit("filtered")).unionByName(d.where("qc_pass = 0").withColumn("status", F.lit("unfiltered")))
    return summaries.count_by(both, ["status", "timepoint"])


_MAP = f"WITH {ad.TRACE_SQL}, p AS (SELECT a.locus AS locus_1, b.locus AS locus_2, {dist_sql('a', 'b', (1, 1, 1))} AS d FROM trace a JOIN trace b ON a.trace_id = b.trace_id AND a.locus < b.locus)"


def trace_pairs(spark, sf) -> DataFrame:
    return proximity.group_pairs(ad.trace(spark, sf), ["trace_id"], "locus", [])


@query(_MAP + " SELECT locus_1, locus_2, round(median(d), 6) AS median_distance FROM p GROUP BY 1, 2")
def median_distance_map(spark, sf):
    """A15."""
    return shape.median_map(trace_pairs(spark, sf)).select("locus_1", "locus_2", r6("median_distance"))


@query(_MAP + " SELECT locus_1, locus_2, round(CASE WHEN count(*) FILTER (d > 0) = 0 THEN 1 ELSE count(*) FILTER (d < 10) / CAST(count(*) FILTER (d > 0) AS DOUBLE) END, 6) AS contact FROM p GROUP BY 1, 2")
def contact_map(spark, sf):
    """A16."""
    return shape.contact_map(trace_pairs(spark, sf), 10.0).select("locus_1", "locus_2", r6("contact"))


def trace_points(spark, sf) -> DataFrame:
    return ad.trace(spark, sf).select("trace_id", "locus", *[F.col(f"{a}c").alias(a) for a in AXES])


@query(f"WITH {ad.TRACE_SQL} SELECT trace_id, round(sqrt(var_pop(zc) + var_pop(yc) + var_pop(xc)), 4) AS gyration FROM trace GROUP BY 1")
def radius_of_gyration(spark, sf):
    """SC12."""
    return shape.radius_of_gyration(trace_points(spark, sf), ["trace_id"]).select("trace_id", F.round("gyration", 4).alias("gyration"))


@query(f"WITH {ad.TRACE_SQL}, s AS (SELECT trace_id, sqrt(pow(zc - lag(zc) OVER w, 2) + pow(yc - lag(yc) OVER w, 2) + pow(xc - lag(xc) OVER w, 2)) AS d FROM trace WINDOW w AS (PARTITION BY trace_id ORDER BY locus)) SELECT trace_id, round(coalesce(sum(d), 0), 6) AS contour FROM s GROUP BY 1")
def contour_length(spark, sf):
    """W11."""
    return shape.contour_length(trace_points(spark, sf), ["trace_id"], "locus").select("trace_id", r6("contour"))


@query("SELECT round(avg(CAST(none AS DOUBLE)), 6) AS none, round(avg(CAST(c1 AS DOUBLE)), 6) AS class_1, round(avg(CAST(c2 AS DOUBLE)), 6) AS class_2 FROM (SELECT l_orderkey, bool_and(l_linenumber % 3 = 0) AS none, bool_or(l_linenumber % 3 = 1) AS c1, bool_or(l_linenumber % 3 = 2) AS c2 FROM lineitem GROUP BY 1)")
def loop_classes(spark, sf):
    """A20, SC14."""
    t = ad.read(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 3).alias("label"))
    return shape.loop_fractions(t, "l_orderkey", "label").select(r6("none"), r6("class_1"), r6("class_2"))


@query(f"WITH {ad.ROI_SQL}, n AS (SELECT fov, count(DISTINCT timepoint) AS n FROM roi GROUP BY 1) SELECT fov, n, CAST(coalesce(sum(n) OVER (ORDER BY fov ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM n")
def time_offsets(spark, sf):
    """W12, IO23."""
    return naming.time_offsets(ad.roi(spark, sf).groupBy("fov").agg(F.count_distinct("timepoint").alias("n")), "fov")


@query(f"WITH {ad.ROI_SQL} SELECT DISTINCT fov, printf('P%04d', fov + 1) AS name, fov AS back FROM roi")
def fov_names(spark, sf):
    """P10."""
    named = ad.roi(spark, sf).select("fov").distinct().withColumn("name", naming.fov_name(F.col("fov")))
    return named.select("fov", "name", naming.fov_index(F.concat("name", F.lit(".zarr"))).alias("back"))


@query(f"WITH {ad.FIT_SQL} SELECT trace_id, timepoint, count(*) AS n FROM fit GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(spark, sf):
    """A9, J2."""
    from spotweave.operators.checks import repeats

    return repeats(ad.fit(spark, sf), ["trace_id", "timepoint"])


@query(f"WITH {ad.ROI_SQL}, pix AS (SELECT fov, CAST(zc AS INT) AS z, 1 AS l FROM roi WHERE false), m AS (SELECT DISTINCT fov, CAST(trunc(zc) AS BIGINT) AS z, CAST(trunc(yc) AS BIGINT) AS y, CAST(trunc(xc) AS BIGINT) AS x FROM roi WHERE roi_id % 2 = 0) SELECT r.roi_id AS roi_id, CASE WHEN m.fov IS NULL THEN 0 ELSE 1 + r.fov END AS label FROM roi r LEFT JOIN m ON m.fov = r.fov AND m.z = trunc(zc) AND m.y = trunc(yc) AND m.x = trunc(xc)")
def nuclear_labels(spark, sf):
    """J14. The mask is made of the rois of even id."""
    r = ad.roi(spark, sf)
    mask = r.where("roi_id % 2 = 0").select("fov", *[F.col(f"{a}c").cast("long").alias(a) for a in AXES], (F.col("fov") + 1).alias("label")).distinct()
    return tracing.nuclear_label(r, mask).select("roi_id", "label")
