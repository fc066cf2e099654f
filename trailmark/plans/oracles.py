"""SQL text that gives the same rows as the queries of :mod:`trailmark.plans.catalogue`."""

from __future__ import annotations

from trailmark.plans.adapter import core_ctes

#: Settings of the clustering queries: the usual ones, and coarser ones under which several rounds of refinement matter.
USUAL, COARSE = (10.0, 7.0), (40.0, 21.0)
#: Levels of refinement that the SQL unrolls; more change nothing on these tables.
LEVELS = 7
AS_OF = "2030-01-01"
TARGETS = (1, 2, 5, 10, 50)
HISTOGRAM_BINS, GRID = 50, 40
SAMPLE, FOLDS = 5000, 5
LIMIT, TABLE_LIMITS = 70, {"locality": 20, "geography": 5}

_TEXT = "strftime({}, '%Y-%m-%d')"
_KM = (
    "2e0 * 6371e0 * asin(sqrt(least(1e0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)"
    " + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2))))"
)

#: (expression, name) of the columns of the four-way join.
COLUMNS = [
    ("e.CollectingEventID", "collectingeventid"), (_TEXT.format("e.StartDate"), "startdate"), (_TEXT.format("e.EndDate"), "enddate"), ("e.Remarks", "remarks"), ("e.LocalityID", "localityid"),
    ("o.CollectionObjectID", "collectionobjectid"), ("o.Text1", "text1"), ("l.MinElevation", "minelevation"), ("l.MaxElevation", "maxelevation"), ("l.ElevationAccuracy", "elevationaccuracy"),
    ("l.Latitude1", "latitude1"), ("l.Longitude1", "longitude1"), ("l.LocalityName", "localityname"), ("l.NamedPlace", "namedplace"), ("l.GeographyID", "geographyid"), ("g.CentroidLat", "centroidlat"),
    ("g.CentroidLon", "centroidlon"), ("g.CommonName", "commonname"), ("g.FullName", "fullname"), ("g.Name", "name"),
]


def _merged(same: str = "=") -> str:
    select = ", ".join(f"{e} AS {n}" for e, n in COLUMNS)
    return (
        f"SELECT {select} FROM collectingevent e JOIN collectionobject o ON e.CollectingEventID {same} o.CollectingEventID"
        f" LEFT JOIN locality l ON e.LocalityID {same} l.LocalityID LEFT JOIN geography g ON l.GeographyID {same} g.GeographyID"
    )


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH RECURSIVE " + core_ctes() + "".join(f",\n{n} AS ({q})" for n, q in ctes) + "\n"


MERGED = ("merged", _merged())
PRECISE = ("precise", "SELECT * FROM merged WHERE startdate IS NOT NULL AND latitude1 IS NOT NULL AND longitude1 IS NOT NULL")
FIRST = ("firsts", "SELECT * FROM precise QUALIFY row_number() OVER (PARTITION BY collectingeventid ORDER BY collectionobjectid) = 1")
FIT = (
    "fit",
    f"SELECT * FROM firsts WHERE latitude1 BETWEEN -90 AND 90 AND longitude1 BETWEEN -180 AND 180 AND year(CAST(startdate AS DATE)) >= 1800 AND CAST(startdate AS DATE) <= DATE '{AS_OF}'",
)
BASE = (MERGED, PRECISE, FIRST, FIT)


def _refined(e_dist: float, e_days: float, levels: int = LEVELS) -> str:
    """CTEs p0, p1, ...: (id, lat, lon, day, block) after each split by place (even) and time (odd)."""
    out = ",\npts AS MATERIALIZED (SELECT collectingeventid AS id, latitude1 AS lat, longitude1 AS lon, date_diff('day', DATE '1970-01-01', CAST(startdate AS DATE)) AS day, CAST(0 AS BIGINT) AS block FROM fit)"
    for k in range(levels + 1):
        was = f"p{k - 1}" if k else "pts"
        if k % 2 == 0:
            out += f""",
n{k} AS MATERIALIZED (SELECT block, lat, lon, min(id) AS node FROM {was} GROUP BY ALL),
e{k} AS MATERIALIZED (SELECT a.node AS u, b.node AS v FROM n{k} a JOIN n{k} b ON a.block = b.block AND a.node <> b.node WHERE {_KM.format(a="a", b="b")} <= {e_dist}e0),
c{k}(node, label) USING KEY (node) AS (
  SELECT node, node FROM n{k}
  UNION SELECT e.v, min(c.label) FROM c{k} c JOIN e{k} e ON e.u = c.node JOIN recurring.c{k} r ON r.node = e.v WHERE c.label < r.label GROUP BY e.v),
p{k} AS MATERIALIZED (SELECT id, w.lat, w.lon, day, label AS block FROM {was} w JOIN n{k} n ON w.block = n.block AND w.lat = n.lat AND w.lon = n.lon JOIN c{k} c ON c.node = n.node)"""
        else:
            out += f""",
d{k} AS (SELECT block, day, min(id) AS f FROM {was} GROUP BY ALL),
g{k} AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY block ORDER BY day) > {e_days}e0 THEN 1 ELSE 0 END AS gap FROM d{k}),
i{k} AS (SELECT *, sum(gap) OVER (PARTITION BY block ORDER BY day) AS island FROM g{k}),
t{k} AS (SELECT block, day, min(f) OVER (PARTITION BY block, island) AS label FROM i{k}),
p{k} AS MATERIALIZED (SELECT id, lat, lon, w.day, label AS block FROM {was} w JOIN t{k} t ON w.block = t.block AND w.day = t.day)"""
    return out + "\n"


def _clusters(settings: tuple[float, float], levels: int = LEVELS) -> str:
    last = f",\nfound AS MATERIALIZED (SELECT f.*, block AS cluster_key, dense_rank() OVER (ORDER BY block) - 1 AS spatiotemporal_cluster_id FROM fit f JOIN p{levels} p ON p.id = f.collectingeventid)\n"
    return _with(*BASE).rstrip() + _refined(*settings, levels).rstrip() + last


_ALL = ", ".join(n for _, n in COLUMNS)
_FLAGS = (
    "flags",
    """SELECT o.CollectionObjectID AS collectionobjectid, max(CASE WHEN YesNo2 = 1 OR RedactLocality = 1 THEN 1 ELSE 0 END) AS is_redacted
  FROM collectionobject o LEFT JOIN determination d ON o.CollectionObjectID = d.CollectionObjectID AND IsCurrent = 1 LEFT JOIN vtaxon2 t ON d.TaxonID = t.TaxonID GROUP BY 1""",
)
_HIT = "coalesce(is_redacted, 0) <> 0"
_MASK = (
    f"SELECT collectingeventid, collectionobjectid, {', '.join(f'CASE WHEN {_HIT} THEN {chr(39)}*{chr(39)} ELSE {c} END AS {c}' for c in ('localityname', 'namedplace'))}, text1, "
    + ", ".join(f"CASE WHEN NOT {_HIT} THEN {c} END AS {c}" for c in ("latitude1", "longitude1", "centroidlat", "centroidlon"))
    + f", CAST({_HIT} AS INTEGER) AS is_redacted FROM firsts LEFT JOIN flags USING (collectionobjectid)"
)
_SIZES = ",\nsizes AS (SELECT spatiotemporal_cluster_id, count(*) AS size FROM found GROUP BY 1)\n"


def _nearest() -> str:
    text, taken = _clusters(COARSE).rstrip() + _SIZES.rstrip(), []
    for i, t in enumerate(TARGETS):
        free = f"WHERE spatiotemporal_cluster_id NOT IN ({' UNION ALL '.join(f'SELECT spatiotemporal_cluster_id FROM pick{j}' for j in taken)})" if taken else ""
        text += f",\npick{i} AS MATERIALIZED (SELECT {t} AS target, * FROM sizes {free} ORDER BY abs(size - {t}), spatiotemporal_cluster_id LIMIT 1)"
        taken.append(i)
    return text + "\n" + " UNION ALL ".join(f"SELECT * FROM pick{i}" for i in taken)


_HAND = ",\nhand AS (SELECT *, CASE WHEN collectingeventid % 3 = 0 THEN NULL ELSE localityid % 10 END AS label, localityid % 10 AS cluster FROM found)\n"
_ARI = """,
cells AS (SELECT label AS t, cluster_key AS p, CAST(count(*) AS DOUBLE) AS n FROM hand WHERE label IS NOT NULL GROUP BY ALL),
both_ AS (SELECT sum(n * (n - 1) / 2) AS b, sum(n) AS total FROM cells),
r_ AS (SELECT sum(n * (n - 1) / 2) AS r FROM (SELECT sum(n) AS n FROM cells GROUP BY t)),
c_ AS (SELECT sum(n * (n - 1) / 2) AS c FROM (SELECT sum(n) AS n FROM cells GROUP BY p)),
ari_ AS (SELECT (b - r * c / (total * (total - 1) / 2)) / ((r + c) / 2 - r * c / (total * (total - 1) / 2)) AS ari FROM both_, r_, c_)
"""
_RANGE = "(SELECT min({c}) AS lo, max({c}) AS hi FROM fit)"
_BIN = "CAST(CASE WHEN {r}.hi > {r}.lo THEN least(greatest(floor(({x} - {r}.lo) / ({r}.hi - {r}.lo) * {n}), 0), {n} - 1) ELSE {n} - 1 END AS INTEGER)"


def _grid(by: str) -> str:
    n = GRID - 1
    x, y = _BIN.format(x="longitude1", r="rx", n=n), _BIN.format(x="latitude1", r="ry", n=n)
    day = "startdate AS day, " if by else ""
    centre = lambda k, r: f"round({r}.lo + ({k} + 0.5e0) * ({r}.hi - {r}.lo) / {n}, 9)"
    return (
        _with(*BASE, ("rx", _RANGE.format(c="longitude1")[1:-1]), ("ry", _RANGE.format(c="latitude1")[1:-1]), ("cells", f"SELECT {day}{x} AS x_bin, {y} AS y_bin, count(*) AS n FROM fit, rx, ry GROUP BY ALL"))
        + f"SELECT {'day, ' if by else ''}x_bin, y_bin, n, {centre('x_bin', 'rx')} AS x_centre, {centre('y_bin', 'ry')} AS y_centre"
        + (f", (SELECT min(n) FROM (SELECT {x} AS a, {y} AS b, count(*) AS n FROM fit, rx, ry GROUP BY ALL)) AS n_min, (SELECT max(n) FROM (SELECT {x} AS a, {y} AS b, count(*) AS n FROM fit, rx, ry GROUP BY ALL)) AS n_max" if by else "")
        + " FROM cells, rx, ry"
    )


def _histogram(auto: bool) -> str:
    days = "CAST(date_diff('day', DATE '1970-01-01', CAST(startdate AS DATE)) AS DOUBLE)"
    told = f"SELECT count(*) AS c, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM (SELECT {days} AS x FROM fit)"
    bins = "greatest(1, ceil((hi - lo) / least((hi - lo) / (log2(c) + 1), 2 * iqr / pow(c, 1e0 / 3))))" if auto else str(HISTOGRAM_BINS)
    return (
        _with(*BASE, ("told", told), ("r", f"SELECT lo, hi, {bins} AS bins FROM told"), ("b", f"SELECT {_BIN.format(x=days, r='r', n='bins')} AS bin, count(*) AS n FROM fit, r GROUP BY ALL"))
        + "SELECT bin, round(lo + bin * ((hi - lo) / bins), 9) AS lower, round(lo + (bin + 1) * ((hi - lo) / bins), 9) AS upper, n FROM b, r"
    )


def _related(primary: str) -> str:
    objects = "SELECT * FROM collectionobject WHERE CollectingEventID IS NOT NULL" if primary == "object" else "SELECT * FROM collectionobject WHERE CollectingEventID IN (SELECT CollectingEventID FROM collectingevent)"
    events = "SELECT * FROM collectingevent WHERE CollectingEventID IN (SELECT CollectingEventID FROM ro)" if primary == "object" else "SELECT * FROM collectingevent"
    return (
        _with(("ro", objects), ("re", events), ("rl", "SELECT * FROM locality WHERE LocalityID IN (SELECT LocalityID FROM re)"), ("rg", "SELECT * FROM geography WHERE GeographyID IN (SELECT GeographyID FROM rl)"))
        + "SELECT 'collectionobject' AS source, CollectionObjectID AS id FROM ro UNION ALL SELECT 'collectingevent', CollectingEventID FROM re"
        " UNION ALL SELECT 'locality', LocalityID FROM rl UNION ALL SELECT 'geography', GeographyID FROM rg"
    )


def _keys(tables: dict[str, str], **more: str) -> str:
    """(source, id) of ``tables``: name -> what to read of it."""
    key = {"collectingevent": "CollectingEventID", "collectionobject": "CollectionObjectID", "locality": "LocalityID", "geography": "GeographyID"}
    kept = "".join(f"'{v}' AS {k}, " for k, v in more.items())
    return " UNION ALL ".join(f"SELECT * FROM (SELECT {kept}'{t}' AS source, {key[t]} AS id FROM {t} {rest})" for t, rest in tables.items())


_ORDERED = {"collectingevent": "CollectingEventID", "collectionobject": "CollectionObjectID", "locality": "LocalityID", "geography": "GeographyID"}
_FOLDS = f"""
dealt AS (SELECT *, CAST('0x' || substr(md5('42:' || collectingeventid), 1, 8) AS BIGINT) % {FOLDS} AS fold, CAST(floor(latitude1) AS BIGINT) AS place,
  date_diff('day', DATE '1970-01-01', CAST(startdate AS DATE)) AS day FROM fit),
settings AS (SELECT * FROM (VALUES (1e0), (2e0)) a(side), (VALUES (4000e0), (40000e0)) b(days)),
found AS (SELECT side, days, fold, place AS t, CAST(floor(latitude1 / side) AS BIGINT) * 100000 + CAST(floor(day / days) AS BIGINT) AS p FROM dealt, settings WHERE collectingeventid % 3 <> 0),
cells AS (SELECT side, days, fold, t, p, CAST(count(*) AS DOUBLE) AS n FROM found WHERE t IS NOT NULL GROUP BY ALL),
both_ AS (SELECT side, days, fold, sum(n * (n - 1) / 2) AS b, sum(n) * (sum(n) - 1) / 2 AS pairs FROM cells GROUP BY ALL),
r_ AS (SELECT side, days, fold, sum(n * (n - 1) / 2) AS r FROM (SELECT side, days, fold, t, sum(n) AS n FROM cells GROUP BY ALL) GROUP BY ALL),
c_ AS (SELECT side, days, fold, sum(n * (n - 1) / 2) AS c FROM (SELECT side, days, fold, p, sum(n) AS n FROM cells GROUP BY ALL) GROUP BY ALL)
SELECT side, days, round(sum(greatest(0, (b - r * c / pairs) / ((r + c) / 2 - r * c / pairs))) / {FOLDS}, 9) AS score
FROM both_ JOIN r_ USING (side, days, fold) JOIN c_ USING (side, days, fold) GROUP BY ALL"""

_CENTROIDS = "coalesce(latitude1, centroidlat) AS latitude1, coalesce(longitude1, centroidlon) AS longitude1"
_COALESCED = ", ".join(n for _, n in COLUMNS if n not in ("latitude1", "longitude1")) + ", " + _CENTROIDS
_BOX = "x0, x1, y0, y1"

ORACLES: dict[str, str] = {
    "scan_filter_project": _with() + "SELECT LocalityID AS localityid, LocalityName AS localityname FROM locality WHERE Latitude1 > 0",
    "fetch_by_ids": _with() + f"SELECT LocalityID AS localityid, NamedPlace AS namedplace FROM locality WHERE LocalityID IN (SELECT LocalityID FROM collectingevent WHERE EndDate IS NOT NULL)",
    "core_join_precise": _with(MERGED, PRECISE) + f"SELECT {_ALL} FROM precise",
    "core_join_centroid": _with(MERGED) + f"SELECT * FROM (SELECT {_COALESCED} FROM merged) WHERE startdate IS NOT NULL AND latitude1 IS NOT NULL AND longitude1 IS NOT NULL",
    "core_join_nullsafe": _with(("merged", _merged("IS NOT DISTINCT FROM"))) + f"SELECT {_ALL} FROM merged",
    "semi_related_objects": _related("object"),
    "semi_related_events": _related("event"),
    "clean_coalesce_flag": _with(MERGED) + f"SELECT *, CASE WHEN latitude1 IS NULL THEN 0 ELSE 1 END AS spatial_flag FROM (SELECT collectingeventid, collectionobjectid, startdate, {_CENTROIDS} FROM merged)",
    "spatial_flag_counts": _with(MERGED) + "SELECT CASE WHEN coalesce(latitude1, centroidlat) IS NULL THEN 0 ELSE 1 END AS spatial_flag, count(*) AS n FROM merged GROUP BY 1",
    "centroid_fills": _with(MERGED)
    + "SELECT count(*) FILTER (latitude1 IS NULL AND centroidlat IS NOT NULL) AS n_lat, count(*) FILTER (longitude1 IS NULL AND centroidlon IS NOT NULL) AS n_lon FROM merged",
    "prep_dedupe_validity": _with(*BASE) + "SELECT collectingeventid, collectionobjectid, latitude1, longitude1, startdate FROM fit",
    "spatial_components": _with(*BASE).rstrip() + _refined(*COARSE, 0) + "SELECT id AS collectingeventid, dense_rank() OVER (ORDER BY block) - 1 AS spatial_cluster_id FROM p0",
    "temporal_islands": _with(*BASE).rstrip()
    + _refined(*COARSE, 1)
    + "SELECT p1.id AS collectingeventid, dense_rank() OVER (ORDER BY p0.block) - 1 AS spatial_cluster_id, dense_rank() OVER (PARTITION BY p0.block ORDER BY p1.block) - 1 AS temporal_cluster_id FROM p1 JOIN p0 USING (id)",
    "cluster_steps": _with(*BASE).rstrip()
    + _refined(*COARSE, 5)
    + "SELECT p0.id AS collectingeventid, p0.block AS spatial_key, p1.block AS temporal_key, p2.block AS reconnected_key, p3.block AS combined_key, p4.block AS placed_key, p5.block AS timed_key FROM p0 JOIN p1 USING (id) JOIN p2 USING (id) JOIN p3 USING (id) JOIN p4 USING (id) JOIN p5 USING (id)",
    "cluster_fixpoint": _clusters(USUAL) + "SELECT collectingeventid, cluster_key, spatiotemporal_cluster_id FROM found",
    "cluster_fixpoint_coarse": _clusters(COARSE) + "SELECT collectingeventid, cluster_key, spatiotemporal_cluster_id FROM found",
    # clusters of places alone are one piece in space, but not in time
    "connectivity_check": _with(*BASE).rstrip()
    + _refined(*COARSE, 1)
    + "SELECT dense_rank() OVER (ORDER BY p0.block) - 1 AS spatiotemporal_cluster_id, count(*) AS size, CAST(1 AS BIGINT) AS n_spatial, count(DISTINCT p1.block) AS n_temporal FROM p0 JOIN p1 USING (id) GROUP BY p0.block",
    "cluster_sizes": _clusters(COARSE).rstrip() + _SIZES + "SELECT * FROM sizes",
    "cluster_summary": _clusters(COARSE).rstrip()
    + _SIZES
    + "SELECT CAST(sum(size) AS BIGINT) AS n_records, count(*) AS n_clusters, round(avg(size), 9) AS mean_size, median(size) AS median_size, max(size) AS max_size, min(size) AS min_size FROM sizes",
    "trajectory_segments": _clusters(COARSE).rstrip()
    + """,
steps AS (SELECT spatiotemporal_cluster_id, collectingeventid AS from_id, lead(collectingeventid) OVER w AS to_id, latitude1 AS lat1, longitude1 AS lon1, lead(latitude1) OVER w AS lat2, lead(longitude1) OVER w AS lon2,
  CAST(epoch(CAST(startdate AS DATE)) AS BIGINT) AS t1, CAST(epoch(lead(CAST(startdate AS DATE)) OVER w) AS BIGINT) AS t2 FROM found WINDOW w AS (PARTITION BY spatiotemporal_cluster_id ORDER BY startdate, collectingeventid))
SELECT *, (t1 + t2) / 2e0 AS t_mid FROM steps WHERE to_id IS NOT NULL""",
    "nearest_cluster_sizes": _nearest(),
    "redaction_flags": _with(_FLAGS) + "SELECT * FROM flags",
    "redact_mask": _with(*BASE, _FLAGS) + _MASK,
    "redact_drop": _with(*BASE, _FLAGS) + f"SELECT collectingeventid, collectionobjectid, localityname FROM firsts LEFT JOIN flags USING (collectionobjectid) WHERE NOT {_HIT}",
    "redact_events_strict": _with(*BASE, _FLAGS, ("ev", "SELECT CollectingEventID AS collectingeventid, max(is_redacted) AS flag FROM collectionobject JOIN flags USING (collectionobjectid) GROUP BY 1"))
    + "SELECT collectingeventid, CASE WHEN coalesce(flag, 0) <> 0 THEN '*' ELSE localityname END AS localityname, CASE WHEN coalesce(flag, 0) = 0 THEN latitude1 END AS latitude1 FROM firsts LEFT JOIN ev USING (collectingeventid)",
    "verify_mask": _with(*BASE, _FLAGS, ("hits", "SELECT f.* FROM firsts f JOIN flags USING (collectionobjectid) WHERE is_redacted = 1"))
    + """SELECT 'unmasked' AS frame, count(*) AS flagged_rows, count(*) AS bad_locality_rows, count(*) AS bad_coordinate_rows, count(*) = 0 AS ok FROM hits
UNION ALL SELECT 'texts only', count(*), 0, count(*), count(*) = 0 FROM hits UNION ALL SELECT 'masked', count(*), 0, 0, true FROM hits""",
    "verify_drop": _with(*BASE, _FLAGS, ("hits", "SELECT f.* FROM firsts f JOIN flags USING (collectionobjectid) WHERE is_redacted = 1"))
    + "SELECT 'kept' AS frame, count(*) AS flagged_rows, count(*) = 0 AS ok FROM hits UNION ALL SELECT 'dropped', 0, true",
    "verify_offenders": _with(*BASE, _FLAGS)
    + "SELECT collectionobjectid, min(collectingeventid) AS collectingeventid, '*' AS localityname, false AS bad_locality, true AS bad_coordinates FROM firsts JOIN flags USING (collectionobjectid) WHERE is_redacted = 1 GROUP BY collectionobjectid",
    "drop_offenders": _with(*BASE, _FLAGS) + "SELECT collectionobjectid, min(collectingeventid) AS collectingeventid FROM firsts JOIN flags USING (collectionobjectid) WHERE is_redacted = 1 GROUP BY collectionobjectid",
    "redacted_share": _with(*BASE, _FLAGS)
    + f"SELECT CAST(count(*) FILTER ({_HIT}) AS BIGINT) AS flagged, count(*) AS total, round(100.0 * count(*) FILTER ({_HIT}) / count(*), 9) AS share FROM firsts LEFT JOIN flags USING (collectionobjectid)",
    "map_extent_zoomed": _with(*BASE, ("m", "SELECT min(longitude1) AS x0, max(longitude1) AS x1, min(latitude1) AS y0, max(latitude1) AS y1 FROM fit"))
    + """, z AS (SELECT * FROM (VALUES ('auto', 0.1), ('2', 0.5), ('20', 0.05)) v(name, share)),
b AS (SELECT *, (x1 - x0) * share AS bx, (y1 - y0) * share AS by_ FROM m, z),
w AS (SELECT * FROM b UNION ALL SELECT * REPLACE (name || ' 3:2' AS name, greatest(bx, 1.5 * by_) AS bx, greatest(by_, bx / 1.5) AS by_) FROM b),
a AS (SELECT name, x0 - bx AS x0, x1 + bx AS x1, y0 - by_ AS y0, y1 + by_ AS y1 FROM w)
SELECT name AS view, round(x0, 6) AS west, round(x1, 6) AS east, round(y0, 6) AS south, round(y1, 6) AS north, round((x1 - x0) * 111 / 10, 6) AS bar_km FROM a""",
    "time_ticks": _with(*BASE, ("m", "SELECT epoch(CAST(min(startdate) AS DATE)) AS lo, epoch(CAST(max(startdate) AS DATE)) AS hi FROM fit"))
    + "SELECT CAST(i AS INTEGER) AS tick, round(lo + i * (hi - lo) / 5e0, 6) AS seconds, strftime(DATE '1970-01-01' + CAST(floor((lo + i * (hi - lo) / 5e0) / 86400) AS INTEGER), '%Y-%m-%d') AS label FROM m, range(6) t(i)",
    "seeded_sample": _with(*BASE) + f"SELECT collectingeventid FROM fit ORDER BY md5('42:' || collectingeventid), collectingeventid LIMIT {SAMPLE}",
    "load_limits": _with() + _keys({t: f"ORDER BY {k} LIMIT {LIMIT}" for t, k in _ORDERED.items()}, limits="one")
    + " UNION ALL " + _keys({t: f"ORDER BY {k} LIMIT {TABLE_LIMITS[t]}" if t in TABLE_LIMITS else "" for t, k in _ORDERED.items()}, limits="by table"),
    "related_fallback": _related("object").replace("SELECT 'geography', GeographyID FROM rg", "SELECT 'geography', GeographyID + 1000 FROM geography"),
    "kfold_scores": _with(*BASE).rstrip() + "," + _FOLDS,
    "density_grid": _grid(""),
    "density_by_day": _grid("day"),
    "time_histogram": _histogram(False),
    "time_histogram_auto": _histogram(True),
    "map_extent": _with(*BASE, ("m", "SELECT min(longitude1) AS x0, max(longitude1) AS x1, min(latitude1) AS y0, max(latitude1) AS y1 FROM fit"), ("w", "SELECT x0 - (x1 - x0) / 10 AS x0, x1 + (x1 - x0) / 10 AS x1, y0 - (y1 - y0) / 10 AS y0, y1 + (y1 - y0) / 10 AS y1 FROM m"))
    + "SELECT round(x0, 9) AS west, round(x1, 9) AS east, round(y0, 9) AS south, round(y1, 9) AS north, round((x1 - x0) * 111 / 10, 9) AS bar_km, (SELECT count(*) FROM fit, w WHERE longitude1 BETWEEN x0 AND x1 AND latitude1 BETWEEN y0 AND y1) AS n_inside FROM w",
    "adjusted_rand": _clusters(COARSE).rstrip() + _HAND.rstrip() + _ARI + "SELECT round(ari, 9) AS ari FROM ari_",
    "penalised_ari": _clusters(COARSE).rstrip()
    + _HAND.rstrip()
    + _ARI
    + "SELECT round(ari, 9) AS ari, n_collisions, round(greatest(0, ari - 100 * n_collisions / (SELECT CAST(count(*) AS DOUBLE) FROM hand)), 9) AS score FROM ari_, (SELECT count(*) AS n_collisions FROM hand WHERE label IS NULL AND cluster_key IN (SELECT cluster_key FROM hand WHERE label IS NOT NULL))",
    "size_difference": _clusters(COARSE).rstrip()
    + _HAND.rstrip()
    + """,
m_ AS (SELECT cluster, count(*) AS m, arg_min(cluster_key, collectingeventid) AS p FROM hand WHERE cluster BETWEEN 0 AND 9 GROUP BY 1),
a_ AS (SELECT cluster_key AS p, count(*) AS a FROM hand GROUP BY 1)
SELECT round(sum(abs(m - a) / CAST(m AS DOUBLE)) / 10, 9) AS score FROM m_ JOIN a_ USING (p)""",
}
