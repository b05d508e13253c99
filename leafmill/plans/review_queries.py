"""Queries over evaluations and reviews, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid as G
from ..functions import text as T
from ..operators import evaluate as E
from ..operators import matching as M
from ..operators import review as R
from .table_queries import GOLD, _gold_pred
from .views import HEADERS, V_FRAGMENT, V_GRID, V_REVIEW, table, v_fragment, v_grid, v_review


def _eval_sides(spark, sf):
    g, p = _gold_pred(spark, sf)
    side = lambda d: d.select("doc", "page", F.col("ord").alias("table_id"), "headers", "rows")
    return side(g), side(p.where("page <> 7"))


def eval_metrics(spark, sf):
    return E.metrics(*_eval_sides(spark, sf))


def regression_gate(spark, sf):
    base = spark.range(1).select(F.lit(1.0).alias("precision"), F.lit(0.95).alias("recall"))
    return E.regression(E.metrics(*_eval_sides(spark, sf)), base)


def adjudicate(spark, sf):
    d = R.adjudicate(v_review(spark, sf))
    join = lambda c: F.array_join(c, ",").alias(c)
    return d.select("table_id", "model_action", "final_action", "basis", "resolution", "gate_passed", join("blocking"), join("supported_modes"), join("refuted_modes"))


def review_summary(spark, sf):
    return R.summary(R.adjudicate(v_review(spark, sf))).drop(*[f"mean_{c}" for c in R.RUBRIC])


def mode_histogram(spark, sf):
    return R.histogram(R.adjudicate(v_review(spark, sf)))


def review_normalize(spark, sf):
    """Reviews written as a model would: plain, fenced, with words around, or cut off."""
    v = v_review(spark, sf)
    body = F.to_json(F.struct(F.coalesce("presence", F.lit("unclear")).alias("table_present_on_page"), (F.col("quality") * 2 - 0.25).alias("extraction_quality"), F.initcap("action").alias("recommended_action"), F.col("modes").alias("failure_modes"), F.struct(F.col("structural").alias("structural_fidelity")).alias("rubric")))
    k = F.col("table_id") % 4
    raw = F.when(k == 0, body).when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 2, F.concat(F.lit("Here: "), body, F.lit(" done"))).otherwise(F.regexp_replace(body, r',"failure_modes".*$', ""))
    d = R.normalize(v.select("table_id", raw.alias("raw")))
    return d.select("table_id", "presence", "action", "quality", "risk", "structural", "robustness", F.array_join("modes", ",").alias("modes"))


def backlog_gates(spark, sf):
    a = R.adjudicate(v_review(spark, sf))
    cur, base = a, a.where("table_id % 3 = 0")
    act = lambda d: d.groupBy(F.col("model_action").alias("name")).agg(F.count("*").alias("n")).unionByName(d.where("presence = 'no'").groupBy(F.lit("present_no").alias("name")).agg(F.count("*").alias("n")))
    mode = lambda d: R.histogram(d).where("kind = 'mode'").select(F.col("key").alias("name"), "n")
    rub = lambda d: d.agg(*[F.avg(F.col(c).cast("decimal(12,6)")).cast("double").alias(c) for c in R.RUBRIC]).unpivot([], list(R.RUBRIC), "name", "mean")
    targets = [("global", "recommended_reject_max", 100.0), ("global", "recommended_accept_delta_min", 10.0), ("global", "table_present_no_max", 0.0), ("failure_mode", "ocr_noise", 0.5), ("failure_mode", "unheard_of", 1.0), ("rubric", "completeness_delta_min", 0.05), ("rubric", "units_min", 0.4)]
    d = E.gates(spark.createDataFrame(targets, "section string, name string, target double"), act(cur), mode(cur), rub(cur), act(base), mode(base), rub(base))
    return d.withColumn("actual", F.round("actual", 5))


def risk_score(spark, sf):
    g = v_grid(spark, sf).select("table_id", G.quality(F.col("headers"), F.col("rows")).alias("q"), (F.col("table_id") % 5).cast("int").alias("missing"), (F.col("table_id") % 4).cast("int").alias("depth"))
    flags = v_fragment(spark, sf).select(F.col("frag").alias("table_id"), F.explode(F.when(F.col("frag") % 3 == 0, F.array(F.lit("warn"), F.lit("Error"), F.lit("info"))).otherwise(F.array(F.lit("info")))).alias("severity"))
    return R.risk(g, flags).select("table_id", "flags", "risk")


def rectify_worklist(spark, sf):
    g = v_grid(spark, sf).select((F.col("table_id") % 97).alias("doc"), "table_id", (G.quality(F.col("headers"), F.col("rows"))["empty"] * (F.col("table_id") % 3)).alias("risk"))
    return R.work_list(g, 4).select("doc", "table_id", "place")


def rectify_targets(spark, sf):
    v = R.adjudicate(v_review(spark, sf))
    t = v.select("doc", "table_id")
    return R.targets(t, v, "nonaccept").select("table_id", F.lit("nonaccept").alias("mode")).unionByName(R.targets(t, v, "reject").select("table_id", F.lit("reject").alias("mode")))


def feedback_last(spark, sf):
    e = table(spark, sf, "events").select((F.col("user_id") % 1000).alias("table_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("action"))
    return R.last_feedback(e)


def evidence_support(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 5
    e = F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat(F.lit("−"), F.col("p_size").cast("string"))).when(k == 2, F.regexp_replace("p_name", " ", "-")).when(k == 3, F.concat(F.col("p_name"), F.lit(" extra"))).otherwise(F.lit(" "))
    src = F.concat(F.lit("x "), F.col("p_name"), F.lit(" - "), F.col("p_size").cast("string"), F.lit(" -"), F.col("p_size").cast("string"), F.lit("."))
    return p.select("p_partkey", R.supported_by(e, src).alias("supported"))


def cell_provenance(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 5
    text = lambda n, other: F.when(k == n, F.concat(F.lit("a "), F.col("p_name"), F.lit(" b"))).otherwise(F.lit(other))
    r = R.infer_provenance(F.when(k == 4, F.col("p_name")).otherwise(F.lit("old")), F.col("p_name"), text(0, "m"), text(1, "o"), text(2, "c"))
    return p.select("p_partkey", r.alias("r")).select("p_partkey", "r.source", "r.confidence")


def _repairs(spark, sf):
    g = v_grid(spark, sf)
    k = F.col("table_id") % 8
    rows = F.transform("rows", lambda r: G.fit(r, F.lit(4)))
    new = F.when(k == 0, F.slice(rows, 1, 0)).when(k == 1, F.slice(rows, F.lit(1), F.greatest(F.lit(1), F.floor(F.size("rows") / 2 - 0.5).cast("int")))).when(k == 2, F.transform(rows, lambda r: F.slice(r, 1, 3))).when(k == 3, F.transform(rows, lambda r: F.transform(r, lambda x: F.concat(F.lit("zz"), x)))).otherwise(rows)
    heads = F.when(k == 4, F.array(F.lit("Part"), F.lit(""), F.lit(""), F.lit(""))).when(k == 5, F.array(F.lit("Part"), F.lit("Quantity"), F.lit("Price"), F.lit("Discount"))).otherwise(F.col("headers"))
    return R.validate(g.select("table_id", "headers", "rows", heads.alias("new_headers"), new.alias("new_rows"), F.lit("kg USD").alias("evidence")))


def rectify_validate(spark, sf):
    return _repairs(spark, sf).select("table_id", "reason")


def rectify_apply(spark, sf):
    d = R.restore(R.apply_repairs(_repairs(spark, sf)).withColumn("repaired", F.size("rows")))
    return d.select("table_id", "rectified", F.col("repaired").alias("rows"), F.col("q.unstable").alias("unstable"), F.size(F.flatten("rows")).alias("cells_before"))


PER_MODE = "list_filter(modes, lambda m: {})"
BELOW = " OR ".join(f"(m = '{m}' AND {s} < {x})" for m, (s, x) in R.BELOW.items())
SUPP = f"(m NOT IN {(*R.BELOW, *R.NEVER)} OR {BELOW})"
PASSING = " AND ".join(f"{s} >= {x}" for s, x in R.PASSING.items())
ADJ = f"""{V_REVIEW}, a0 AS (SELECT *, CASE WHEN action IN ('accept', 'reject') THEN action ELSE 'review' END AS model_action, coalesce(presence, 'yes') AS seen,
  list_sort(list_distinct(list_filter(modes, lambda m: {SUPP}))) AS supported_modes, list_sort(list_distinct(list_filter(modes, lambda m: NOT {SUPP}))) AS refuted_modes, risk <= {R.MOST_RISK} AND {PASSING} AS gate_passed FROM v_review),
a1 AS (SELECT *, list_sort(list_distinct(list_concat(list_filter([CASE WHEN seen IN ('no', 'uncertain') THEN 'table_presence:' || seen END, CASE WHEN model_action = 'reject' THEN 'model_recommended_reject' END, CASE WHEN len(missing) > 0 THEN 'missing_required_information' END,
  CASE WHEN robustness IN ('failed', 'fragile') AND quality < 0.7 THEN 'overall_robustness:' || robustness END], lambda x: x IS NOT NULL), list_transform(supported_modes, lambda m: 'failure_mode:' || m)))) AS blocking FROM a0),
a2 AS (SELECT *, CASE WHEN len(blocking) > 0 THEN 'reject' WHEN model_action = 'accept' OR gate_passed THEN 'accept' ELSE 'reject' END AS final_action,
  CASE WHEN len(blocking) > 0 THEN 'blocking_findings' WHEN model_action = 'accept' THEN 'model_accept_no_blockers' WHEN gate_passed THEN 'review_refuted_by_quality_gate' ELSE 'review_supported_by_quality_shortfall' END AS basis FROM a1),
adj AS (SELECT *, CASE WHEN model_action <> 'review' THEN 'n/a' WHEN final_action = 'accept' THEN 'refuted' ELSE 'supported' END AS resolution FROM a2)"""
HIST = "hist AS (SELECT kind, key, count(*) AS n FROM (SELECT 'mode' AS kind, unnest(modes) AS key FROM adj UNION ALL SELECT 'review_reason', unnest(modes) FROM adj WHERE model_action = 'review' UNION ALL SELECT 'blocking', unnest(blocking) FROM adj) GROUP BY ALL)"
NUMRE = r"[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?"
EVAL = rf"""{GOLD}, e1 AS (SELECT doc, page, headers, rows, row_number() OVER (PARTITION BY doc, page ORDER BY ord::varchar) AS n FROM g), e2 AS (SELECT doc, page, headers, rows, row_number() OVER (PARTITION BY doc, page ORDER BY ord::varchar) AS n FROM p WHERE page <> 7),
m AS (SELECT page, n, e1.headers AS gh, e1.rows AS gr, e2.headers AS ph, e2.rows AS pr FROM e1 JOIN e2 USING (doc, page, n)),
c AS (SELECT lower(trim(coalesce(gr[i][j], ''))) AS a, lower(trim(coalesce(pr[i][j], ''))) AS b FROM (SELECT *, unnest(range(1, least(len(gh), len(ph)) + 1)) AS j FROM (SELECT *, unnest(range(1, least(len(gr), len(pr)) + 1)) AS i FROM m))),
k AS (SELECT count(*) AS cells, count(*) FILTER (a = b) AS same, count(*) FILTER (regexp_matches(a, '{NUMRE}')) AS numbers, count(*) FILTER (regexp_matches(a, '{NUMRE}') AND regexp_matches(b, '{NUMRE}')) AS parsed FROM c),
s AS (SELECT count(*) AS pairs, count(*) FILTER (len(gr) = len(pr)) AS rows_ok, count(*) FILTER (len(gh) = len(ph)) AS cols_ok FROM m),
d AS (SELECT count(*) FILTER (x.page IS NOT NULL AND y.page IS NOT NULL) AS tp, count(*) FILTER (x.page IS NULL) AS fp, count(*) FILTER (y.page IS NULL) AS fn FROM (SELECT DISTINCT doc, page FROM g) x FULL JOIN (SELECT DISTINCT doc, page FROM p WHERE page <> 7) y ON x.doc = y.doc AND x.page = y.page),
em AS (SELECT (SELECT count(*) FROM g) AS gold_tables, (SELECT count(*) FROM p WHERE page <> 7) AS pred_tables, tp AS matched_pages, tp / greatest(tp + fp, 1) AS precision, tp / greatest(tp + fn, 1) AS recall, pairs AS matched_tables, rows_ok / greatest(pairs, 1) AS row_count_match, cols_ok / greatest(pairs, 1) AS column_count_match,
  same / greatest(cells, 1) AS cell_accuracy, CASE WHEN numbers = 0 THEN 1.0 ELSE parsed / numbers END AS numeric_parse, numbers AS numeric_cells FROM d, s, k)"""
AVG = "avg({0}::decimal(12,6))"

VALID = f"""{V_GRID}, vw AS (SELECT *, list_distinct(flatten(list_transform(flatten(list_transform(rows, lambda r: list_resize(r, 4, ''))), lambda x: regexp_extract_all('zz' || lower(x), '[a-z0-9]+')))) AS w FROM v_grid),
vd AS (SELECT table_id, rows, CASE table_id % 8 WHEN 0 THEN 'no_rows' WHEN 4 THEN 'header_loss' WHEN 1 THEN CASE WHEN greatest(1, floor(len(rows) / 2 - 0.5)) < 0.5 * len(rows) THEN 'row_loss' ELSE '' END WHEN 2 THEN 'structure_unlocked' WHEN 5 THEN 'unit_loss'
  WHEN 3 THEN CASE WHEN len(list_filter(w, lambda x: x LIKE 'zz%')) > greatest(3, floor(0.2 * (len(w) + 6))) THEN 'ungrounded_tokens' ELSE '' END ELSE '' END AS reason FROM vw)"""

QUERIES = {f.__name__: f for f in (eval_metrics, regression_gate, adjudicate, review_summary, mode_histogram, review_normalize, backlog_gates, risk_score, rectify_worklist, rectify_targets, feedback_last, evidence_support, cell_provenance, rectify_validate, rectify_apply)}
SQL = {
    "eval_metrics": f"WITH {EVAL} SELECT * FROM em",
    "regression_gate": f"""WITH {EVAL} SELECT 'precision_drop' AS name, precision::double AS actual, 1.0::double - 0.03::double AS "limit" FROM em WHERE 1.0 - precision > 0.03 UNION ALL SELECT 'recall_drop', recall, 0.95::double - 0.03::double FROM em WHERE 0.95 - recall > 0.03 UNION ALL SELECT 'numeric_parse_floor', numeric_parse, 0.8 FROM em WHERE numeric_cells > 0 AND numeric_parse < 0.8""",
    "adjudicate": f"WITH {ADJ} SELECT table_id, model_action, final_action, basis, resolution, gate_passed, array_to_string(blocking, ',') AS blocking, array_to_string(supported_modes, ',') AS supported_modes, array_to_string(refuted_modes, ',') AS refuted_modes FROM adj",
    "review_summary": f"""WITH {ADJ} SELECT doc, count(*) AS reviewed, {", ".join(f"count(*) FILTER (model_action = '{a}') AS model_{a}" for a in ("accept", "review", "reject"))}, {", ".join(f"count(*) FILTER (final_action = '{a}') AS final_{a}" for a in ("accept", "reject"))},
  count(*) FILTER (resolution = 'supported') AS supported, count(*) FILTER (resolution = 'refuted') AS refuted, count(*) FILTER (presence = 'yes') AS present_yes, count(*) FILTER (presence = 'no') AS present_no, count(*) FILTER (presence IS NULL OR presence = 'uncertain') AS present_uncertain,
  {", ".join(f"count(*) FILTER (robustness = '{r}') AS {r}" for r in ("robust", "mostly_robust", "fragile", "failed"))}, {", ".join(f"sum({c}::decimal(12,6))::decimal(38,6) AS total_{c}" for c in R.RUBRIC)} FROM adj GROUP BY ROLLUP (doc)""",
    "mode_histogram": f"WITH {ADJ}, {HIST} SELECT kind, key, n, row_number() OVER (PARTITION BY kind ORDER BY n DESC, key)::int AS place FROM hist",
    "review_normalize": f"""WITH {V_REVIEW}, a AS (SELECT *, table_id % 4 = 3 AS part, least(greatest(quality * 2 - 0.25, 0), 1) AS q, CASE WHEN table_id % 4 = 3 THEN 0 ELSE structural END AS st FROM v_review)
SELECT table_id, CASE WHEN presence IN ('yes', 'no') THEN presence ELSE 'uncertain' END AS presence, CASE WHEN action IN ('accept', 'reject') THEN action ELSE 'review' END AS action, q AS quality, 1 - q AS risk, st AS structural, CASE WHEN st / 5 >= 0.45 THEN 'fragile' ELSE 'failed' END AS robustness, CASE WHEN part THEN '' ELSE coalesce(array_to_string(modes, ','), '') END AS modes FROM a""",
    "backlog_gates": f"""WITH {ADJ}, z AS (SELECT *, table_id % 3 = 0 AS b FROM adj), m AS (SELECT b, unnest(modes) AS mode FROM z),
v AS (SELECT (SELECT count(*) FROM z WHERE model_action = 'reject')::double AS rej, ((SELECT count(*) FROM z WHERE model_action = 'accept') - (SELECT count(*) FROM z WHERE b AND model_action = 'accept'))::double AS acc, (SELECT count(*) FROM z WHERE presence = 'no')::double AS pno, (SELECT count(*) FROM m WHERE mode = 'ocr_noise') AS mc, (SELECT count(*) FROM m WHERE b AND mode = 'ocr_noise') AS mb,
  (SELECT avg(completeness::decimal(12,6)) FROM z) - (SELECT avg(completeness::decimal(12,6)) FROM z WHERE b) AS dc, (SELECT avg(units::decimal(12,6)) FROM z) AS u),
r AS (SELECT 'global' AS section, 'recommended_reject_max' AS name, rej AS actual, 100.0::double AS target, rej <= 100 AS pass FROM v UNION ALL SELECT 'global', 'recommended_accept_delta_min', acc, 10, acc >= 10 FROM v UNION ALL SELECT 'global', 'table_present_no_max', pno, 0, pno <= 0 FROM v
  UNION ALL SELECT 'failure_mode', 'ocr_noise', CASE WHEN mb = 0 THEN CASE WHEN mc = 0 THEN 1 ELSE 0 END ELSE greatest(0, (mb - mc) / mb) END, 0.5, mb = 0 OR (mb - mc) / mb >= 0.5 FROM v UNION ALL SELECT 'failure_mode', 'unheard_of', 1, 1, true FROM v UNION ALL SELECT 'rubric', 'completeness_delta_min', dc, 0.05, dc >= 0.05 FROM v UNION ALL SELECT 'rubric', 'units_min', u, 0.4, u >= 0.4 FROM v)
SELECT section, name, round(actual, 5) AS actual, target, pass FROM r""",
    "risk_score": None,
    "rectify_worklist": None,
    "rectify_targets": f"WITH {ADJ} SELECT table_id, 'nonaccept' AS mode FROM adj WHERE final_action = 'reject' OR model_action IN ('review', 'reject') UNION ALL SELECT table_id, 'reject' FROM adj WHERE final_action = 'reject'",
    "feedback_last": "SELECT user_id % 1000 AS table_id, max(event_id) AS seq, arg_max(event_type, event_id) AS action FROM events GROUP BY 1",
    "evidence_support": r"""SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN false WHEN p_partkey % 5 = 3 THEN len(list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]+'))) / (len(list_distinct(list_append(regexp_extract_all(lower(p_name), '[a-z0-9]+'), 'extra')))) >= 0.7 ELSE true END AS supported FROM part""",
    "cell_provenance": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'marker' WHEN 1 THEN 'ocr' WHEN 2 THEN 'context' END AS source, CASE p_partkey % 5 WHEN 0 THEN 0.86 WHEN 1 THEN 0.81 WHEN 2 THEN 0.72 END::double AS confidence FROM part",
    "rectify_validate": f"WITH {VALID} SELECT table_id, reason FROM vd",
    "rectify_apply": f"""WITH {VALID} SELECT table_id, reason = '' AS rectified, CASE WHEN reason = '' AND table_id % 8 = 1 THEN greatest(1, floor(len(rows) / 2 - 0.5)) ELSE len(rows) END::int AS rows, CASE WHEN reason = '' THEN 0 ELSE len(list_filter(rows, lambda r: len(r) <> 4)) / len(rows) END::double AS unstable, len(flatten(rows))::int AS cells_before FROM vd""",
}
from .table_queries import Q  # noqa: E402

SQL["risk_score"] = f"""WITH {Q}, f AS (SELECT o_orderkey AS table_id, 2 AS n FROM orders WHERE o_orderkey % 3 = 0)
SELECT table_id, coalesce(n, 0)::bigint AS flags, round(greatest(0, least(1, 0.45::double * greatest(empty, repeated, unstable) + 0.20::double * least(table_id % 5 / 3.0::double, 1) + 0.15::double * (CASE table_id % 4 WHEN 3 THEN 1.0 WHEN 2 THEN 0.6 ELSE 0 END)::double + 0.20::double * least(coalesce(n, 0) / 3.0::double, 1))), 4) AS risk FROM q LEFT JOIN f USING (table_id)"""
SQL["rectify_worklist"] = f"WITH {Q} SELECT * FROM (SELECT table_id % 97 AS doc, table_id, row_number() OVER (PARTITION BY table_id % 97 ORDER BY empty * (table_id % 3) DESC, table_id)::int AS place FROM q) WHERE place <= 4"
