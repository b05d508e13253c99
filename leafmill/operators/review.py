"""Model reviews of tables: normalising, adjudication, summaries, risk, work lists, evidence checks of repaired grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid as G
from ..functions import text as T

# Modes that always block; modes that block below a score; a mode that never does.
HARD = ("row_shift_or_merge", "column_shift_or_merge", "partial_table_extracted", "duplicate_or_hallucinated_rows", "missing_required_columns", "table_not_present")
BELOW = {"multi_level_header_loss": ("structural", 0.8), "header_misalignment": ("structural", 0.82), "symbol_or_unit_loss": ("units", 0.85), "code_legend_unresolved": ("context", 0.78), "split_table_continuation": ("completeness", 0.9), "ocr_noise": ("quality", 0.65), "other": ("quality", 0.72)}
NEVER = ("caption_mismatch",)
# Least scores for a review to be overruled.
PASSING = {"quality": 0.78, "structural": 0.78, "completeness": 0.88, "units": 0.82, "context": 0.75}
MOST_RISK = 0.35
RUBRIC = ("structural", "completeness", "units", "context")

PAYLOAD = "table_present_on_page string, extraction_quality string, false_positive_risk string, recommended_action string, issues array<string>, failure_modes array<string>, missing_required_information array<string>, rubric struct<formatting_fidelity:string,structural_fidelity:string,data_completeness:string,unit_symbol_fidelity:string,context_resolution:string,overall_robustness:string>"


def action_of(c: Column) -> Column:
    a = F.lower(F.trim(T.blank(c)))
    return F.when(a.isin("accept", "review", "reject"), a).otherwise("review")


def partial_fields(raw: Column) -> Column:
    """What regular expressions find in a cut-off answer: struct(presence, action, quality, risk)."""
    text = lambda k: F.nullif(F.regexp_extract(T.blank(raw), rf'"{k}"\s*:\s*"([^"]*)"', 1), F.lit(""))
    num = lambda k: F.nullif(F.regexp_extract(T.blank(raw), rf'"{k}"\s*:\s*([-0-9.]+)', 1), F.lit("")).try_cast("double")
    return F.struct(text("table_present_on_page").alias("presence"), text("recommended_action").alias("action"), num("extraction_quality").alias("quality"), num("false_positive_risk").alias("risk"))


def normalize(answers: DataFrame, raw: str = "raw") -> DataFrame:
    """Model answers as review rows: the JSON object salvaged, names lowered, scores held to 0..1, defaults filled."""
    d = answers.withColumn("p", F.from_json(T.salvage_json(F.col(raw)), PAYLOAD)).withColumn("part", partial_fields(F.col(raw)))
    whole = F.col("p").isNotNull()
    pick = lambda a, b: F.when(whole, F.col(a)).otherwise(F.col(b).cast("string"))
    seen = F.lower(F.trim(T.blank(pick("p.table_present_on_page", "part.presence"))))
    seen = F.when(seen.isin("true", "present"), "yes").when(seen.isin("false", "absent"), "no").when(seen.isin("yes", "no"), seen).otherwise("uncertain")
    quality = T.clamp01(pick("p.extraction_quality", "part.quality"), 0.0)
    risk = pick("p.false_positive_risk", "part.risk")
    risk = F.when(risk.isNull(), T.clamp01(1 - quality, 1.0)).otherwise(T.clamp01(risk, 1.0))
    rub = lambda k: T.clamp01(F.col(f"p.rubric.{k}"), 0.0)
    mean = (rub("formatting_fidelity") + rub("structural_fidelity") + rub("data_completeness") + rub("unit_symbol_fidelity") + rub("context_resolution")) / 5
    given = F.lower(F.trim(T.blank(F.col("p.rubric.overall_robustness"))))
    band = F.when(mean >= 0.9, "robust").when(mean >= 0.75, "mostly_robust").when(mean >= 0.45, "fragile").otherwise("failed")
    clean = lambda c: F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.trim(T.blank(x))), lambda x: x != "")
    keep = [c for c in answers.columns if c != raw]
    return d.select(
        *keep, seen.alias("presence"), action_of(pick("p.recommended_action", "part.action")).alias("action"), quality.alias("quality"), risk.alias("risk"), rub("formatting_fidelity").alias("formatting"), rub("structural_fidelity").alias("structural"),
        rub("data_completeness").alias("completeness"), rub("unit_symbol_fidelity").alias("units"), rub("context_resolution").alias("context"), F.when(given.isin("robust", "mostly_robust", "fragile", "failed"), given).otherwise(band).alias("robustness"),
        clean("p.failure_modes").alias("modes"), clean("p.missing_required_information").alias("missing"), clean("p.issues").alias("issues"),
    )


def adjudicate(reviews: DataFrame) -> DataFrame:
    """reviews with final_action (accept or reject), basis, resolution, blocking reasons, supported and refuted modes."""
    seen = F.coalesce("presence", F.lit("yes"))  # a row without the field is older than it
    act = action_of(F.col("action"))

    def supported(m: Column) -> Column:
        out = ~m.isin(*BELOW, *NEVER)  # hard and unknown modes
        for mode, (score, least) in BELOW.items():
            out = F.when(m == mode, F.coalesce(F.col(score), F.lit(0.0)) < least).otherwise(out)
        return out

    modes = F.filter(F.transform("modes", lambda m: F.trim(m)), lambda m: m != "")
    d = reviews.withColumn("model_action", act).withColumn("_all", modes)
    d = d.withColumn("supported_modes", F.array_sort(F.array_distinct(F.filter("_all", supported)))).withColumn("refuted_modes", F.array_sort(F.array_distinct(F.filter("_all", lambda m: ~supported(m)))))
    reasons = F.array(
        F.when(seen.isin("no", "uncertain"), F.concat(F.lit("table_presence:"), seen)), F.when(act == "reject", F.lit("model_recommended_reject")), F.when(F.size("missing") > 0, F.lit("missing_required_information")),
        F.when(F.col("robustness").isin("failed", "fragile") & (F.coalesce("quality", F.lit(0.0)) < 0.7), F.concat(F.lit("overall_robustness:"), "robustness")),
    )
    blocking = F.concat(F.filter(reasons, lambda x: x.isNotNull()), F.transform("supported_modes", lambda m: F.concat(F.lit("failure_mode:"), m)))
    gate = F.coalesce("risk", F.lit(1.0)) <= MOST_RISK
    for score, least in PASSING.items():
        gate = gate & (F.coalesce(F.col(score), F.lit(0.0)) >= least)
    d = d.withColumn("blocking", F.array_sort(F.array_distinct(blocking))).withColumn("gate_passed", gate)
    blocked = F.size("blocking") > 0
    d = d.withColumn("final_action", F.when(blocked, "reject").when((act == "accept") | F.col("gate_passed"), "accept").otherwise("reject"))
    basis = F.when(blocked, "blocking_findings").when(act == "accept", "model_accept_no_blockers").when(F.col("gate_passed"), "review_refuted_by_quality_gate").otherwise("review_supported_by_quality_shortfall")
    d = d.withColumn("basis", basis).withColumn("resolution", F.when(act != "review", "n/a").when(F.col("final_action") == "accept", "refuted").otherwise("supported"))
    return d.drop("_all")


def summary(adjudicated: DataFrame, by_doc: bool = True) -> DataFrame:
    """Counts and rubric means of all reviews, and of each document (doc null: all)."""
    n = lambda c, v: F.count_if(F.col(c) == v)
    cols = [F.count("*").alias("reviewed"), *[n("model_action", a).alias(f"model_{a}") for a in ("accept", "review", "reject")], *[n("final_action", a).alias(f"final_{a}") for a in ("accept", "reject")]]
    cols += [n("resolution", r).alias(r) for r in ("supported", "refuted")] + [n("presence", "yes").alias("present_yes"), n("presence", "no").alias("present_no"), F.count_if(~F.coalesce(F.col("presence"), F.lit("")).isin("yes", "no")).alias("present_uncertain")]
    cols += [n("robustness", r).alias(r) for r in ("robust", "mostly_robust", "fragile", "failed")] + [F.avg(F.coalesce(F.col(c), F.lit(0.0))).alias(f"mean_{c}") for c in RUBRIC]
    cols += [F.sum(F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(12,6)")).cast("decimal(38,6)").alias(f"total_{c}") for c in RUBRIC]
    return (adjudicated.rollup("doc") if by_doc else adjudicated.groupBy()).agg(*cols)


def histogram(adjudicated: DataFrame) -> DataFrame:
    """(kind, key, n, place): failure modes, of reviews to review also, and blocking reasons, commonest first."""
    part = lambda kind, c, d: d.select(F.lit(kind).alias("kind"), F.explode(c).alias("key"))
    u = part("mode", "modes", adjudicated).unionByName(part("review_reason", "modes", adjudicated.where("model_action = 'review'"))).unionByName(part("blocking", "blocking", adjudicated))
    g = u.where("trim(key) <> ''").groupBy("kind", "key").agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "key")))


def last_feedback(feedback: DataFrame) -> DataFrame:
    """feedback (table_id, seq, ..): the last row of each table."""
    rest = [c for c in feedback.columns if c != "table_id"]
    return feedback.groupBy("table_id").agg(F.max_by(F.struct(*rest), "seq").alias("r")).select("table_id", "r.*")


def risk(tables: DataFrame, flags: DataFrame) -> DataFrame:
    """tables (table_id, q, missing: n, depth: n) with their risk: quality 0.45, missing fields 0.20, header depth 0.15, flags 0.20."""
    f = flags.where(F.lower("severity").isin("warn", "error")).groupBy("table_id").agg(F.count("*").alias("flags"))
    d = tables.join(f, "table_id", "left").na.fill(0, ["flags"])
    third = lambda c: F.least(F.col(c) / 3.0, F.lit(1.0))
    depth = F.when(F.col("depth") >= 3, 1.0).when(F.col("depth") == 2, 0.6).otherwise(0.0)
    r = 0.45 * F.greatest("q.empty", "q.repeated", "q.unstable") + 0.20 * third("missing") + 0.15 * depth + 0.20 * third("flags")
    return d.withColumn("risk", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), r)), 4))


def work_list(tables: DataFrame, most: int = 0) -> DataFrame:
    """tables (doc, table_id, risk) riskiest first; the first `most` of a document (0: all)."""
    d = tables.withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("risk"), "table_id")))
    return d.where(F.col("place") <= most) if most else d


def targets(tables: DataFrame, adjudicated: DataFrame, mode: str = "nonaccept") -> DataFrame:
    """Tables whose review asks for repair."""
    r = adjudicated
    hit = (F.col("final_action") == "reject") | F.col("model_action").isin("review", "reject") if mode == "nonaccept" else F.col("final_action") == "reject"
    return tables if mode == "all" else tables.join(r.where(hit).select("table_id"), "table_id", "left_semi")


def supported_by(evidence: Column, source: Column) -> Column:
    """Whether a source text backs a piece of evidence: as it is, as a number, by its letters and digits, or by most of its words."""
    n, h = T.ocr_cell(evidence), T.ocr_cell(source)
    tight = lambda c: F.translate(F.regexp_replace(F.lower(c), r"\s+", ""), "−–—", "---")
    ns, hs = T.alnum_signature(n), T.alnum_signature(h)
    nt, ht = T.tokens(n), T.tokens(h)
    words = (F.size(nt) > 0) & F.exists(nt, lambda x: x.rlike("[a-z]")) & (F.size(F.array_intersect(nt, ht)) / F.greatest(F.size(nt), F.lit(1)) >= 0.7)
    letters = F.length(F.regexp_replace(ns, "[^a-z]", ""))
    return (
        F.when(n == "", False).when(F.contains(F.lower(h), F.lower(n)), True).when(tight(n).rlike(r"^[-+<>=~]*[0-9][0-9.,e%+\-]*$"), F.contains(tight(h), tight(n)))
        .when((ns != "") & F.contains(hs, ns) & ((F.length(ns) >= 6) | (letters >= 3)), True).otherwise(words)
    )


def infer_provenance(old: Column, new: Column, marker: Column, ocr: Column, context: Column) -> Column:
    """Where a changed cell's text comes from: struct(source, confidence); null for an unchanged cell or no source."""
    has = lambda c: F.contains(F.lower(T.blank(c)), F.lower(T.ocr_cell(new)))
    pick = lambda s, c: F.struct(F.lit(s).alias("source"), F.lit(c).alias("confidence"))
    none = F.lit(None)
    return F.when(T.ocr_cell(old).eqNullSafe(T.ocr_cell(new)) | (T.ocr_cell(new) == ""), none).when(has(marker), pick("marker", 0.86)).when(has(ocr), pick("ocr", 0.81)).when(has(context), pick("context", 0.72)).when(has(old), pick("old", 0.66))


def validate(tables: DataFrame) -> DataFrame:
    """tables (headers, rows, new_headers, new_rows, evidence) with the first reason against the repaired grid, or an empty string.

    A repair may not lose structure (40 % of headers, half of the rows), symbols or units, and may bring few new words.
    """
    named = lambda c: F.size(F.filter(F.col(c), lambda h: T.ocr_cell(h) != ""))
    flat = lambda h, r: G.flatten_text(F.col(h), F.col(r))
    old, new = flat("headers", "rows"), flat("new_headers", "new_rows")
    chars = lambda c: F.array_distinct(F.regexp_extract_all(F.translate(c, "−–—", "---"), F.lit(r"([^\x00-\x7F])"), F.lit(1)))
    novel = F.array_except(T.tokens(new), F.array_union(T.tokens(old), T.tokens(F.col("evidence"))))
    units = lambda c: F.exists(F.col(c), lambda h: h.rlike(r"\([^)]+\)"))
    reason = (
        F.when(F.size("new_rows") == 0, "no_rows").when(named("new_headers") < 0.6 * named("headers"), "header_loss").when(F.size("new_rows") < 0.5 * F.size("rows"), "row_loss")
        .when(F.exists("new_rows", lambda r: F.size(r) != F.size("new_headers")), "structure_unlocked")
        .when(F.size(F.array_except(chars(old), chars(new))) > 0, "symbol_loss").when(units("headers") & ~units("new_headers"), "unit_loss")
        .when(F.size(novel) > F.greatest(F.lit(3), F.floor(0.2 * F.size(T.tokens(new)))), "ungrounded_tokens").otherwise("")
    )
    return tables.withColumn("reason", reason)


def apply_repairs(tables: DataFrame) -> DataFrame:
    """validate()'s rows: accepted grids replaced, what was there kept in `before`, quality measured anew."""
    ok = F.col("reason") == ""
    d = tables.withColumn("before", F.when(ok, F.struct("headers", "rows"))).withColumn("headers", F.when(ok, F.col("new_headers")).otherwise(F.col("headers"))).withColumn("rows", F.when(ok, F.col("new_rows")).otherwise(F.col("rows")))
    return d.withColumn("q", G.quality(F.col("headers"), F.col("rows"))).withColumn("rectified", ok).drop("new_headers", "new_rows")


def restore(tables: DataFrame) -> DataFrame:
    """Grids before repair, for a rerun."""
    return tables.withColumn("headers", F.coalesce("before.headers", "headers")).withColumn("rows", F.coalesce("before.rows", "rows")).drop("before")
