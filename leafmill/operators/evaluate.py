"""Evaluation against gold tables, and regression gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def pairs(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Tables (doc, page, table_id, headers, rows) of a document's page paired by their place in the order of ids.

    Only ids are ranked; grids join their places afterwards.
    """
    place = F.row_number().over(Window.partitionBy("doc", "page").orderBy(F.col("table_id").cast("string")))
    ids = lambda d, c: d.where("page > 0").select("doc", "page", "table_id").withColumn("n", place).withColumnRenamed("table_id", c)
    j = ids(gold, "g_id").join(ids(pred, "p_id"), ["doc", "page", "n"])
    g = gold.select("doc", "page", F.col("table_id").alias("g_id"), F.col("headers").alias("gh"), F.col("rows").alias("gr"))
    p = pred.select("doc", "page", F.col("table_id").alias("p_id"), F.col("headers").alias("ph"), F.col("rows").alias("pr"))
    return j.join(g, ["doc", "page", "g_id"]).join(p, ["doc", "page", "p_id"]).select("doc", "page", "n", "gh", "gr", "ph", "pr")


def metrics(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """One row: page-level detection, shape matches, cell accuracy, share of gold numbers that parse in the prediction."""
    pages = lambda d, c: d.where("page > 0").select("doc", "page").distinct().withColumn(c, F.lit(1))
    both = pages(gold, "g").join(pages(pred, "p"), ["doc", "page"], "full_outer").agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    norm = lambda c: F.lower(T.squeeze(c))
    # what grids are joined for: the headers' number, and rows as one text of normal cells, which hold no tabs
    slim = lambda d: d.select("doc", "page", "table_id", F.size("headers").alias("headers"), F.transform("rows", lambda r: F.array_join(F.transform(r, norm), "\t")).alias("rows"))
    m = pairs(slim(gold), slim(pred))
    rows = F.arrays_zip(F.slice("gr", F.lit(1), F.least(F.size("gr"), F.size("pr"))).alias("g"), F.slice("pr", F.lit(1), F.least(F.size("gr"), F.size("pr"))).alias("p"))
    split = lambda c: F.split(T.blank(F.col("r")[c]), "\t", -1)
    cells = m.select(F.least("gh", "ph").alias("n"), F.explode(rows).alias("r")).where("n > 0").select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("c"), split("g").alias("g"), split("p").alias("p"))
    cells = cells.select(T.blank(F.get("g", F.col("c"))).alias("g"), T.blank(F.get("p", F.col("c"))).alias("p"))
    is_num = T.number_in(F.col("g")).isNotNull()
    c = cells.agg(F.count("*").alias("cells"), F.count_if(F.col("g") == F.col("p")).alias("same"), F.count_if(is_num).alias("numbers"), F.count_if(is_num & T.number_in(F.col("p")).isNotNull()).alias("parsed"))
    s = m.agg(F.count("*").alias("pairs"), F.count_if(F.size("gr") == F.size("pr")).alias("rows_ok"), F.count_if(F.col("gh") == F.col("ph")).alias("cols_ok"))
    one = F.lit(1)
    j = both.withColumn("_k", one)
    for d in (c, s, gold.agg(F.count("*").alias("gold_tables")), pred.agg(F.count("*").alias("pred_tables"))):
        j = j.join(d.withColumn("_k", one), "_k")  # one row each
    share = lambda a, b: F.col(a) / F.greatest(b, one)
    return j.select(
        "gold_tables", "pred_tables", F.col("tp").alias("matched_pages"), share("tp", F.col("tp") + F.col("fp")).alias("precision"), share("tp", F.col("tp") + F.col("fn")).alias("recall"), F.col("pairs").alias("matched_tables"),
        share("rows_ok", F.col("pairs")).alias("row_count_match"), share("cols_ok", F.col("pairs")).alias("column_count_match"), share("same", F.col("cells")).alias("cell_accuracy"),
        F.when(F.col("numbers") == 0, 1.0).otherwise(share("parsed", F.col("numbers"))).alias("numeric_parse"), F.col("numbers").alias("numeric_cells"),
    )


def regression(current: DataFrame, baseline: DataFrame, drop: float = 0.03, floor: float = 0.8) -> DataFrame:
    """Violations (name, actual, limit) of one row of metrics beside one of a baseline (precision, recall)."""
    j = current.withColumn("_k", F.lit(1)).join(baseline.select(F.col("precision").alias("bp"), F.col("recall").alias("br"), F.lit(1).alias("_k")), "_k")
    row = lambda when, name, a, b: F.when(when, F.struct(F.lit(name).alias("name"), a.cast("double").alias("actual"), b.cast("double").alias("limit")))
    found = F.array(
        row(F.col("bp") - F.col("precision") > drop, "precision_drop", F.col("precision"), F.col("bp") - drop),
        row(F.col("br") - F.col("recall") > drop, "recall_drop", F.col("recall"), F.col("br") - drop),
        row((F.col("numeric_cells") > 0) & (F.col("numeric_parse") < floor), "numeric_parse_floor", F.col("numeric_parse"), F.lit(floor)),
    )
    return j.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select("v.*")


def gate(value: Column, target: Column, how: Column) -> Column:
    """Passed: at most, at least."""
    return F.when(how == "max", value <= target).otherwise(value >= target)


def gates(targets: DataFrame, actions: DataFrame, modes: DataFrame, rubric: DataFrame, base_actions: DataFrame, base_modes: DataFrame, base_rubric: DataFrame) -> DataFrame:
    """Checks (name, actual, target, pass) of targets (section, name, target).

    actions and modes are (name, n); rubric is (name, mean). Reductions are relative; without a baseline count they pass.
    """
    b = lambda d, v: d.select("name", F.col(v).alias(f"base_{v}"))
    act = actions.join(b(base_actions, "n"), "name", "full_outer").na.fill(0)
    act = act.withColumn("name", F.when(F.col("name") == "reject", "recommended_reject_max").when(F.col("name") == "accept", "recommended_accept_delta_min").when(F.col("name") == "present_no", "table_present_no_max"))
    g = targets.where("section = 'global'").join(act, "name", "left").na.fill(0)
    value = F.when(F.col("name") == "recommended_accept_delta_min", F.col("n") - F.col("base_n")).otherwise(F.col("n")).cast("double")
    how = F.when(F.col("name").endswith("_max"), "max").otherwise("min")
    g = g.select("section", "name", value.alias("actual"), "target", gate(value, F.col("target"), how).alias("pass"))
    m = targets.where("section = 'failure_mode'").join(modes.join(b(base_modes, "n"), "name", "full_outer").na.fill(0), "name", "left").na.fill(0)
    cut = F.when(F.col("base_n") <= 0, F.when(F.col("n") == 0, 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), (F.col("base_n") - F.col("n")) / F.col("base_n")))
    m = m.select("section", "name", cut.alias("actual"), "target", ((F.col("base_n") <= 0) | (cut >= F.col("target"))).alias("pass"))
    r = targets.where("section = 'rubric'").withColumn("key", F.regexp_replace("name", "_(delta_min|min)$", ""))
    r = r.join(rubric.select(F.col("name").alias("key"), "mean"), "key", "left").join(base_rubric.select(F.col("name").alias("key"), F.col("mean").alias("base_mean")), "key", "left").na.fill(0.0)
    value = F.when(F.col("name").endswith("_delta_min"), F.col("mean") - F.col("base_mean")).otherwise(F.col("mean"))
    r = r.select("section", "name", value.alias("actual"), "target", (value >= F.col("target")).alias("pass"))
    return g.unionByName(m).unionByName(r)
