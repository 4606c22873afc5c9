"""Queries on single rows, names, ranks and orders, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators import beads, checks, drift as drifts, merging, naming, pairorder, projections, proximity, qc, ranks, summaries, tracing, voxels
from spotweave.operators.geometry import AXES
from spotweave.plans import adapters as ad
from spotweave.plans.registry import _QC, CENTRES, NEAR_SQL, SCALE, D, assessed, labelled, query, r6

_LABELS = f"WITH {ad.ROI_SQL}, m AS (SELECT DISTINCT fov, CAST(trunc(zc) AS BIGINT) AS z, CAST(trunc(yc) AS BIGINT) AS y, CAST(trunc(xc) AS BIGINT) AS x FROM roi WHERE roi_id % 2 = 0), l AS (SELECT r.roi_id AS roi_id, r.fov AS fov, CASE WHEN m.fov IS NULL THEN 0 ELSE 1 + r.fov END AS label FROM roi r LEFT JOIN m ON m.fov = r.fov AND m.z = trunc(zc) AND m.y = trunc(yc) AND m.x = trunc(xc))"


def nuclei(spark, sf) -> DataFrame:
    """The mask is made of the rois of even id."""
    r = ad.roi(spark, sf)
    mask = r.where("roi_id % 2 = 0").select("fov", *[F.col(f"{a}c").cast("long").alias(a) for a in AXES], (F.col("fov") + 1).alias("label")).distinct()
    return tracing.nuclear_label(r, mask)


@query(_LABELS + " SELECT roi_id, fov, label FROM l WHERE label <> 0")
def nuclear_spots(spark, sf):
    """FL1."""
    return projections.in_nuclei(nuclei(spark, sf)).select("roi_id", "fov", "label")


@query(_LABELS + " SELECT roi_id, fov FROM l WHERE label = 0")
def extranuclear_spots(spark, sf):
    """FL3."""
    return projections.outside_nuclei(nuclei(spark, sf)).select("roi_id", "fov")


_PROPS = "prop AS (SELECT CAST(vec_id AS BIGINT) AS bead_id, CAST(embedding[1] AS DOUBLE) * 1e2 AS zc, CAST(embedding[2] AS DOUBLE) * 1e2 AS yc, CAST(embedding[3] AS DOUBLE) * 1e2 AS xc, abs(CAST(embedding[4] AS DOUBLE)) * 1e3 AS area, abs(CAST(embedding[5] AS DOUBLE)) * 1e3 AS max_intensity FROM embeddings)"


@query(f"WITH {_PROPS} SELECT bead_id, concat(CASE WHEN zc <= 4 THEN 'z' ELSE '' END, CASE WHEN yc <= 8 THEN 'y' ELSE '' END, CASE WHEN xc <= 8 THEN 'x' ELSE '' END, CASE WHEN area > 150 THEN 's' ELSE '' END, CASE WHEN max_intensity < 50 THEN 'i' ELSE '' END, CASE WHEN max_intensity > 200 THEN 'I' ELSE '' END) AS fail_code FROM prop")
def bead_fail_codes(spark, sf):
    """FL9."""
    e = ad.read(spark, sf, "embeddings")
    at = lambda i: F.element_at("embedding", i).cast("double")
    props = e.select(F.col("vec_id").cast("long").alias("bead_id"), *[(at(i + 1) * 100.0).alias(f"{a}c") for i, a in enumerate(AXES)], (F.abs(at(4)) * 1000.0).alias("area"), (F.abs(at(5)) * 1000.0).alias("max_intensity"))
    return props.select("bead_id", beads.bead_fail_code((4, 8, 8), 150.0, 50.0, 200.0).alias("fail_code"))


@query(f"WITH {_QC} SELECT trace_id, timepoint, fov, channel FROM (SELECT *, CAST(trace_id % 2 AS INT) AS channel FROM f) WHERE qc_pass = 1 AND channel = 1")
def channel_passing(spark, sf):
    """FL10."""
    return projections.passing_in_channel(labelled(spark, sf).withColumn("channel", (F.col("trace_id") % 2).cast("int")), 1).select("trace_id", "timepoint", "fov", "channel")


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, fov, timepoint FROM roi WHERE (fov + timepoint) % 5 <> 0")
def without_problem_pairs(spark, sf):
    """FL11."""
    r = ad.roi(spark, sf)
    problems = ad.drift(r).where("(fov + timepoint) % 5 = 0").select("fov", "timepoint")
    return projections.without_pairs(r, problems).select("roi_id", "fov", "timepoint")


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, timepoint FROM roi WHERE zc >= 0")
def eligible_spots(spark, sf):
    """FL12."""
    return projections.eligible(ad.roi(spark, sf), spark.range(8).select(F.col("id").cast("int").alias("timepoint"))).select("roi_id", "timepoint")


@query(f"WITH {ad.ROI_SQL} SELECT 'P0003' AS fov, 7 AS timepoint, 1 AS channel, roi_id, round(zc * 4, 6) AS zc, round(yc * 4, 6) AS yc, round(xc * 4, 6) AS xc FROM roi")
def detected_spots(spark, sf):
    """The context of one image around its spots, found in an image downsampled four times."""
    spots = projections.scaled(ad.roi(spark, sf).select("roi_id", *CENTRES), CENTRES, 4.0)
    return projections.with_context(spots, "P0003", 7, 1).select("fov", "timepoint", "channel", "roi_id", *[r6(c) for c in CENTRES])


def round_table(spark) -> DataFrame:
    return spark.range(8).select(F.col("id").cast("int").alias("timepoint"), F.format_string("probe%d", F.col("id") + 1).alias("timepoint_name"))


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, timepoint, concat('probe', timepoint + 1) AS timepoint_name, ['a', 'b', 'c', 'd', 'e', 'f', 'g', 'h'][timepoint + 1] AS probe_name FROM roi")
def timepoint_names(spark, sf):
    """P8, P9."""
    named = projections.with_timepoint_name(ad.roi(spark, sf), round_table(spark))
    return projections.with_probe_name(named, list("abcdefgh")).select("roi_id", "timepoint", "timepoint_name", "probe_name")


@query(f"WITH {ad.ROI_SQL} SELECT concat('probe', timepoint + 1) AS timepoint_name, count(*) AS n FROM roi GROUP BY 1")
def spot_counts_by_name(spark, sf):
    """A3."""
    return summaries.count_by(projections.with_timepoint_name(ad.roi(spark, sf), round_table(spark)), ["timepoint_name"])


@query("SELECT vec_id, list_sum(d) AS total, d[1] AS first, list_max(d) AS largest FROM (SELECT CAST(vec_id AS BIGINT) AS vec_id, [CAST(trunc(CAST(embedding[i] AS DOUBLE) * 1e3) AS BIGINT) - CAST(trunc(CAST(embedding[i + 32] AS DOUBLE) * 1e3) AS BIGINT) for i in range(1, 33)] AS d FROM embeddings)")
def signed_differences(spark, sf):
    """P11."""
    pixels = ad.read(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: (x.cast("double") * 1000.0).cast("int")).alias("p"))
    d = pixels.select("vec_id", projections.signed_difference(F.slice("p", 1, 32), F.slice("p", 33, 32)).alias("d"))
    return d.select("vec_id", F.aggregate("d", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.get("d", 0).cast("long").alias("first"), F.array_max("d").cast("long").alias("largest"))


@query(f"WITH {ad.FIT_SQL} SELECT trace_id, timepoint, signal / background AS snr, CASE WHEN signal / background >= 2 THEN 1 ELSE 0 END AS qc FROM fit")
def snr_flags(spark, sf):
    """P13."""
    s, b = F.col("signal"), F.col("background")
    return ad.fit(spark, sf).select("trace_id", "timepoint", projections.signal_to_noise(s, b).alias("snr"), projections.snr_flag(s, b, 2.0).alias("qc"))


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, round(zc - 4 + 25e-1, 6) AS zc, round(yc - 8 + 25e-1, 6) AS yc, round(xc - 8 + 25e-1, 6) AS xc FROM roi")
def locus_centres(spark, sf):
    """P14."""
    r = ad.roi(spark, sf, True).withColumns({f"{a}_px": F.lit(2.5) for a in AXES})
    return r.withColumns(projections.box_relative_centre()).select("roi_id", *[r6(c) for c in CENTRES])


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, round(zc - 15e-1 + CASE WHEN timepoint > 5 THEN coarse + fine ELSE 0 END, 6) AS zc, round(yc - 15e-1 + CASE WHEN timepoint > 5 THEN coarse + fine ELSE 0 END, 6) AS yc FROM roi JOIN drift USING (fov, timepoint)")
def nuclear_frame(spark, sf):
    """P15."""
    r = ad.roi(spark, sf)
    moved = drifts.with_drift(r, ad.drift(r)).withColumns({**{f"{a}_nuclear": F.lit(1.5) for a in AXES}, "roi_type": F.when(F.col("timepoint") > 5, "regional").otherwise("locus")})
    return projections.in_nuclear_frame(moved).select("roi_id", r6("zc"), r6("yc"))


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, fov FROM roi WHERE fov <= 3")
def first_fields(spark, sf):
    """The limit is the feature."""
    return projections.first_fields(ad.roi(spark, sf), 3).select("roi_id", "fov")


@query(f"WITH {ad.FIT_SQL} SELECT trace_id, timepoint, round(sigma_z / 1e2 * 300, 6) AS sigma_z, round(sigma_xy / 1e2 * 100, 6) AS sigma_xy, CAST(4800 AS DOUBLE) AS box_z, CAST(3200 AS DOUBLE) AS box_x FROM fit")
def sizes_in_nanometres(spark, sf):
    """P7."""
    px = ad.fit(spark, sf).drop("box_z", "box_y", "box_x").withColumns({"sigma_z_px": F.col("sigma_z") / 100, "sigma_xy_px": F.col("sigma_xy") / 100})
    return tracing.sizes_in_nanometres(px, (300.0, 100.0, 100.0), (16, 32, 32)).select("trace_id", "timepoint", r6("sigma_z"), r6("sigma_xy"), "box_z", "box_x")


@query(f"WITH {ad.BEAD_FILE_SQL}, a AS (SELECT fov, timepoint, count(*) AS n_all FROM bead_file GROUP BY 1, 2), b AS (SELECT fov, timepoint, count(*) AS n_kept FROM bead_file WHERE fail_code = '' AND max_intensity > 150 GROUP BY 1, 2) SELECT fov, timepoint, n_all, coalesce(n_kept, 0) AS n_kept FROM a LEFT JOIN b USING (fov, timepoint)")
def bead_counts_joined(spark, sf):
    """J13."""
    b = ad.bead_file(spark, sf)
    return beads.joined_counts(b, b.where(beads.passes() & (F.col("max_intensity") > 150)), ["fov", "timepoint"])


@query(f"WITH {ad.BEAD_FILE_SQL}, t AS (SELECT max_intensity AS nth FROM (SELECT *, row_number() OVER (PARTITION BY fov, timepoint ORDER BY max_intensity DESC) AS rn FROM bead_file WHERE fail_code IN ('', 'i')) WHERE rn = 10) SELECT round(min(nth), 6) AS nth FROM t")
def bead_threshold(spark, sf):
    """A7 over all files."""
    ok = ad.bead_file(spark, sf).where(F.col("fail_code").isin("", "i"))
    return beads.lowest_threshold(beads.nth_largest(ok, ["fov", "timepoint"], "max_intensity", 10)).select(r6("nth"))


@query(f"WITH {ad.BEAD_FILE_SQL} SELECT bead_id, fov, timepoint FROM (SELECT *, row_number() OVER (PARTITION BY fov, timepoint ORDER BY md5(concat('1:', bead_id)), bead_id) AS rn FROM bead_file) WHERE rn <= 4")
def bead_sample(spark, sf):
    """W10, W9 in the seeded order; the sample is the feature."""
    return beads.sample_beads(ad.bead_file(spark, sf), 4, 1).select("bead_id", "fov", "timepoint")


@query(f"WITH {ad.ROI_SQL}, {NEAR_SQL} SELECT src AS roi_id, dst AS partner_id, fov AS partner_fov, timepoint AS partner_timepoint, round(zc, 6) AS partner_zc FROM near JOIN roi ON roi_id = dst")
def merge_partner_records(spark, sf):
    """J15."""
    found = merging.partner_records(assessed(spark, sf), ad.roi(spark, sf), ["fov", "timepoint", "zc"])
    return found.select("roi_id", "partner_id", "partner_fov", "partner_timepoint", r6("partner_zc"))


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, row_number() OVER (ORDER BY fov, timepoint, zc, roi_id) - 1 AS row_number FROM roi")
def row_numbers(spark, sf):
    """W1, S5."""
    return ranks.numbered_rows(ad.roi(spark, sf), ["fov", "timepoint", "zc", "roi_id"]).select("roi_id", "row_number")


@query(f"WITH {ad.ROI_SQL}, p AS (SELECT a.fov AS fov, a.channel AS channel, a.roi_id AS roi_id_1, b.roi_id AS roi_id_2, a.timepoint AS timepoint_1, b.timepoint AS timepoint_2, round({D}, 6) AS distance FROM roi a JOIN roi b ON a.fov = b.fov AND a.channel = b.channel AND a.roi_id < b.roi_id) SELECT roi_id_1, roi_id_2, row_number() OVER (ORDER BY fov, channel, timepoint_1, timepoint_2, distance, roi_id_1, roi_id_2) - 1 AS place FROM p")
def region_pairs_sorted(spark, sf):
    """S2, with the place of each row."""
    return pairorder.ordered_pairs(ad.roi(spark, sf), ["fov", "channel"], "timepoint", "roi_id", SCALE).select("roi_id_1", "roi_id_2", "place")


@query(f"WITH {ad.TRACE_SQL}, p AS (SELECT a.trace_id AS trace_id, a.locus AS locus_1, b.locus AS locus_2 FROM trace a JOIN trace b ON a.trace_id = b.trace_id AND a.locus < b.locus) SELECT *, row_number() OVER (ORDER BY locus_1, locus_2, trace_id) - 1 AS place FROM p")
def locus_pairs_sorted(spark, sf):
    """S1, with the place of each row."""
    pairs = proximity.group_pairs(ad.trace(spark, sf), ["trace_id"], "locus", [], unique=True).select(F.col("trace_id_1").alias("trace_id"), "locus_1", "locus_2")
    order = [c for c in ranks.LOCUS_PAIR_ORDER if c in pairs.columns]
    return ranks.numbered_rows(pairs, order, "place", ordered=True)


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, fov, timepoint FROM roi ORDER BY roi_id")
def rois_by_index(spark, sf):
    """S3."""
    return ranks.in_order(ad.roi(spark, sf).select("roi_id", "fov", "timepoint"), ("roi_id",))


@query(f"WITH {ad.FIT_SQL} SELECT fov, trace_id, timepoint, count(*) AS n FROM fit GROUP BY 1, 2, 3 ORDER BY 1, 2, 3")
def traces_sorted(spark, sf):
    """S4."""
    return ranks.in_order(ad.fit(spark, sf).groupBy("fov", "trace_id", "timepoint").agg(F.count("*").alias("n")), ranks.TRACE_ORDER)


@query(f"WITH {ad.ROI_SQL} SELECT zc, yc, xc, count(*) AS n FROM roi GROUP BY 1, 2, 3 ORDER BY 1, 2, 3")
def points_sorted(spark, sf):
    """Points of beads in the order of their files."""
    return ranks.in_order(ad.roi(spark, sf).groupBy(*ranks.POINT_ORDER).agg(F.count("*").alias("n")), ranks.POINT_ORDER)


TRACE_GROUPS = {"A": [0, 3, 5], "B": [1, 2, 6, 7]}
REGION_LOCI = {r: [(r + 1) % 8, (r + 3) % 8] for r in range(8)}


@query(f"WITH {ad.ROI_SQL}, m AS (SELECT * FROM (VALUES ('A', 0, 0), ('A', 3, 1), ('A', 5, 2), ('B', 1, 0), ('B', 2, 1), ('B', 6, 2), ('B', 7, 3)) v(g, t, i)) SELECT roi_id, timepoint AS ref_timepoint, CAST(coalesce(i, 0) AS BIGINT) AS region_index FROM roi LEFT JOIN m ON t = timepoint")
def region_ranks(spark, sf):
    """W3."""
    of = F.create_map(*[F.lit(x) for g, ts in TRACE_GROUPS.items() for t in ts for x in (t, g)])
    r = ad.roi(spark, sf).withColumnRenamed("timepoint", "ref_timepoint").withColumn("trace_group", F.try_element_at(of, F.col("ref_timepoint")))
    return ranks.rank_in_trace_group(r, TRACE_GROUPS).select("roi_id", "ref_timepoint", "region_index")


_LOCI = "loci AS (SELECT r AS ref_timepoint, list_sort([r, (r + 1) % 8, (r + 3) % 8]) AS times FROM (SELECT unnest(range(8)) AS r))"


@query(f"WITH {ad.ROI_SQL}, {_LOCI} SELECT roi_id, CAST(t AS INT) AS timepoint, CAST(list_position(times, t) - 1 AS BIGINT) AS time_index FROM (SELECT roi_id, times, unnest(times) AS t FROM roi JOIN loci ON ref_timepoint = timepoint)")
def locus_ranks(spark, sf):
    """W4 within regions."""
    table = F.create_map(*[x for r, ts in REGION_LOCI.items() for x in (F.lit(r), F.array(*[F.lit(t) for t in (r, *ts)]))])
    r = ad.roi(spark, sf).withColumnRenamed("timepoint", "ref_timepoint").withColumn("timepoint", F.explode(F.element_at(table, F.col("ref_timepoint"))))
    return ranks.rank_in_region(r, REGION_LOCI, list(range(8))).select("roi_id", "timepoint", "time_index")


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, timepoint + 10 AS timepoint, CAST(timepoint AS BIGINT) AS time_index FROM roi")
def absolute_ranks(spark, sf):
    """W4 without a grouping."""
    r = ad.roi(spark, sf).withColumn("timepoint", F.col("timepoint") + 10)
    return ranks.rank_in_region(r, None, list(range(10, 18))).select("roi_id", "timepoint", "time_index")


@query(f"WITH {ad.ROI_SQL}, {_LOCI}, v AS (SELECT CAST(vec_id AS BIGINT) AS roi_id, CAST(vec_id % 8 AS INT) AS ref_timepoint, unnest([1, 2, 3]) AS p, embedding FROM embeddings) SELECT roi_id, CAST(times[p] AS INT) AS timepoint, round(CAST(embedding[p] AS DOUBLE), 6) AS volume FROM v JOIN loci USING (ref_timepoint)")
def stack_times(spark, sf):
    """W8."""
    e = ad.read(spark, sf, "embeddings")
    stacks = e.select(F.col("vec_id").cast("long").alias("roi_id"), (F.col("vec_id") % 8).cast("int").alias("ref_timepoint"), F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double")).alias("volumes"))
    return ranks.true_times(stacks, REGION_LOCI).select("roi_id", "timepoint", r6("volume"))


@query("SELECT CAST(event_id AS BIGINT) AS event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS value_position FROM events")
def walk_positions(spark, sf):
    """W13."""
    e = ad.read(spark, sf, "events").select(F.col("event_id").cast("long").alias("event_id"), "user_id", "value")
    return ranks.walk(e, ["user_id"], "event_id", ["value"]).select("event_id", F.round("value_position", 4).alias("value_position"))


_CELL = "concat(' ', CAST(event_id % 97 - 20 AS VARCHAR), CASE WHEN event_id % 4 = 0 THEN 'x' WHEN event_id % 4 = 1 THEN '.5' ELSE ' ' END)"


@query(f"SELECT event_id, round(TRY_CAST(trim(c) AS DOUBLE), 6) AS number, TRY_CAST(CASE WHEN trim(c) NOT LIKE '%.%' THEN trim(c) END AS INT) AS whole, CASE WHEN TRY_CAST(trim(c) AS DOUBLE) > 0 THEN TRY_CAST(trim(c) AS DOUBLE) END AS positive FROM (SELECT CAST(event_id AS BIGINT) AS event_id, {_CELL} AS c FROM events)")
def parsed_numbers(spark, sf):
    """SC3."""
    i = F.col("event_id")
    cell = F.concat(F.lit(" "), (i % 97 - 20).cast("string"), F.when(i % 4 == 0, "x").when(i % 4 == 1, ".5").otherwise(" "))
    c = ad.read(spark, sf, "events").select(i.cast("long").alias("event_id"), cell.alias("c"))
    return c.select("event_id", r6(naming.safe_number(F.col("c")), "number"), naming.safe_number(F.col("c"), "int").alias("whole"), naming.safe_number(F.col("c"), positive=True).alias("positive"))


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, CASE WHEN roi_id % 7 <> 0 THEN fov END AS position, timepoint AS time FROM roi")
def file_places(spark, sf):
    """SC4, IO15's keys: Point and Time in the names of image files; a name with two points has none."""
    r = ad.roi(spark, sf)
    name = F.concat(F.format_string("run_Time%05d_Point%04d", "timepoint", "fov"), F.when(F.col("roi_id") % 7 == 0, "_Point0001").otherwise(""), F.lit(".nd2"))
    return r.select("roi_id", *[c.alias(k) for k, c in voxels.place_and_time(name).items()])


@query(f"WITH {ad.ROI_SQL}, k AS (SELECT roi_id, printf('P%04d', fov + 1) AS fov, timepoint AS ref_timepoint, CASE WHEN roi_id % 3 = 0 THEN 'A_1' END AS trace_group, roi_id + 7 AS trace_id FROM roi) SELECT concat(fov, '_', lpad(CAST(roi_id AS VARCHAR), CAST(greatest(5, length(CAST(roi_id AS VARCHAR))) AS INT), '0'), '_', ref_timepoint, '_', coalesce(trace_group, ''), '_', trace_id) AS name, fov, roi_id, ref_timepoint, trace_group, trace_id, roi_id % 2 = 0 AS found FROM k")
def stack_keys(spark, sf):
    """J19, SC5: names of stacks, parsed back, and met with the names of the stacks of even rois."""
    r = ad.roi(spark, sf).select(naming.fov_name(F.col("fov")).alias("fov"), "roi_id", F.col("timepoint").alias("ref_timepoint"), F.when(F.col("roi_id") % 3 == 0, "A_1").alias("trace_group"), (F.col("roi_id") + 7).alias("trace_id"))
    files = r.where("roi_id % 2 = 0").select(voxels.stack_name(*[F.col(c) for c in voxels.KEY]).alias("name"))
    return voxels.match_stacks(r, files).select("name", "found").select("name", "found", *[c.alias(k) for k, c in voxels.stack_key(F.col("name")).items()])


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, concat(printf('P%04d', fov + 1), '__', 'g', timepoint) AS key, printf('P%04d', fov + 1) AS fov, concat('g', timepoint) AS trace_group FROM roi")
def viewing_keys(spark, sf):
    """SC6."""
    r = ad.roi(spark, sf).withColumn("key", naming.viewing_key(naming.fov_name(F.col("fov")), F.concat(F.lit("g"), F.col("timepoint").cast("string"))))
    return r.select("roi_id", "key", *[c.alias(k) for k, c in naming.viewing_parts(F.col("key")).items()])


@query(f"WITH {ad.ROI_SQL} SELECT roi_id, CASE WHEN roi_id % 5 = 0 THEN NULL ELSE concat(least(timepoint, fov + 100), ' ', greatest(timepoint, fov + 100)) END AS ids FROM roi")
def int_set_cells(spark, sf):
    """SC7: parsed, with repeats as faults, and rendered."""
    r = ad.roi(spark, sf)
    cell = F.concat_ws(" ", F.col("fov") + 100, "timepoint", F.when(F.col("roi_id") % 5 == 0, F.col("timepoint")))
    return r.select("roi_id", naming.int_set_cell(naming.int_set(cell)).alias("ids"))


@query("""SELECT CAST(event_id AS BIGINT) AS event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, concat('{"k":', json_extract_string(props, '$.k'), ',"type":"', event_type, '","user":', user_id, '}') AS combined FROM events""")
def json_fields(spark, sf):
    """SC8."""
    e = ad.read(spark, sf, "events")
    other = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")))
    return e.select(F.col("event_id").cast("long").alias("event_id"), F.get_json_object("props", "$.k").cast("int").alias("k"), naming.combined_json(F.col("props"), other).alias("combined"))


_MASK = "mask AS (SELECT CAST(vec_id % 40 AS INT) AS fov, CAST(label AS INT) AS label, CAST(trunc(CAST(embedding[1] AS DOUBLE) * 1e2) AS BIGINT) AS z, CAST(trunc(CAST(embedding[2] AS DOUBLE) * 1e2) AS BIGINT) AS y, CAST(trunc(CAST(embedding[3] AS DOUBLE) * 1e2) AS BIGINT) AS x FROM embeddings)"


@query(f"WITH {_MASK} SELECT fov, label, round(avg(z), 6) AS zc, round(avg(y), 6) AS yc, round(avg(x), 6) AS xc, count(*) AS area FROM mask WHERE label <> 0 GROUP BY 1, 2")
def mask_centroids(spark, sf):
    """K12."""
    e = ad.read(spark, sf, "embeddings")
    mask = e.select((F.col("vec_id") % 40).cast("int").alias("fov"), F.col("label").cast("int").alias("label"), *[(F.element_at("embedding", i + 1).cast("double") * 100.0).cast("long").alias(a) for i, a in enumerate(AXES)])
    return voxels.labelled_centroids(mask, ["fov"]).select("fov", "label", *[r6(c) for c in CENTRES], "area")


_SOME = "seen AS (SELECT trace_id, locus AS timepoint, yc FROM trace WHERE locus <> 2)"


@query(f"WITH {ad.TRACE_SQL}, {_SOME} SELECT trace_id, t AS timepoint, round(coalesce(yc, 0), 6) AS yc FROM (SELECT DISTINCT trace_id FROM seen) CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS t) LEFT JOIN seen USING (trace_id) WHERE seen.timepoint = t UNION ALL SELECT g.trace_id, g.t, CAST(0 AS DOUBLE) FROM (SELECT trace_id, t FROM (SELECT DISTINCT trace_id FROM seen) CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS t)) g ANTI JOIN seen ON seen.trace_id = g.trace_id AND seen.timepoint = g.t")
def filled_times(spark, sf):
    """K21, K22's grid."""
    some = ad.trace(spark, sf).where("locus <> 2").select("trace_id", F.col("locus").alias("timepoint"), "yc")
    times = spark.range(1, 8).select(F.col("id").cast("int").alias("timepoint"))
    return tracing.fill_times(some, ["trace_id"], times, ["yc"]).select("trace_id", "timepoint", r6("yc"))


@query(f"WITH {ad.FIT_SQL} SELECT trace_id, timepoint, fov FROM fit SEMI JOIN (SELECT trace_id, timepoint FROM fit GROUP BY 1, 2 HAVING count(*) > 1) USING (trace_id, timepoint)")
def repeated_rows(spark, sf):
    """All rows of the keys that repeat."""
    f = ad.fit(spark, sf)
    return f.join(checks.repeats(f, ["trace_id", "timepoint"]), ["trace_id", "timepoint"], "left_semi").select("trace_id", "timepoint", "fov")


@query(f"WITH {_QC} SELECT trace_id, count(*) FILTER (qc_pass = 1) AS passing, count(*) AS n FROM f GROUP BY 1")
def passing_by_trace(spark, sf):
    """FL8's counts, S10."""
    return labelled(spark, sf).groupBy("trace_id").agg(F.count_if(F.col("qc_pass") == 1).alias("passing"), F.count("*").alias("n"))


def qc_points(spark, sf) -> DataFrame:
    px = labelled(spark, sf).withColumns({"z_px": F.col("z") / 300, "y_px": F.col("y") / 100, "x_px": F.col("x") / 100})
    return px.withColumns({"display": qc.display_class((16, 32, 32)), "fail_code": qc.fail_codes()})


@query(f"WITH {_QC}, p AS (SELECT *, CASE WHEN NOT (z / 300 > 0 AND z / 300 < 16 AND y / 100 > 0 AND y / 100 < 32 AND x / 100 > 0 AND x / 100 < 32) THEN 'invisible' WHEN qc_pass = 1 THEN 'pass' ELSE 'fail' END AS display FROM f) SELECT trace_id, timepoint, round(z / 300, 6) AS z, round(y / 100, 6) AS y, round(x / 100, 6) AS x, display FROM p WHERE display <> 'invisible'")
def points_tables(spark, sf):
    """FL6, S10: what the points files hold, passing and failing; what cannot be seen is left out."""
    return qc_points(spark, sf).where("display <> 'invisible'").select("trace_id", "timepoint", r6("z_px", "z"), r6("y_px", "y"), r6("x_px", "x"), "display")
