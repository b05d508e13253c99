"""Structured payloads: coordinates, table structures, lenient JSON, anchors, paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def coordinates(raw: Column) -> Column:
    """'page,x,y,w,h;..' as structs; parts with fewer than five numbers or other text are dropped."""
    def one(part: Column) -> Column:
        s = F.split(part, ",")
        n = [F.get(s, F.lit(i)).try_cast("double") for i in range(5)]
        return F.when(n[0].isNotNull() & n[1].isNotNull() & n[2].isNotNull() & n[3].isNotNull() & n[4].isNotNull(), F.struct(n[0].cast("int").alias("page"), n[1].alias("x"), n[2].alias("y"), n[3].alias("w"), n[4].alias("h")))

    return F.filter(F.transform(F.split(T.blank(raw), ";"), one), lambda x: x.isNotNull())


CELL = "struct<row:bigint,row_start:bigint,row_end:bigint,col:bigint,col_start:bigint,col_end:bigint,text:string>"
BODY = f"rows:bigint,row_count:bigint,num_rows:bigint,cols:bigint,col_count:bigint,num_cols:bigint,header_rows:bigint,cells:array<{CELL}>"
PAYLOAD = f"struct<{BODY},structure:struct<{BODY}>,result:struct<{BODY}>,data:struct<{BODY}>,prediction:struct<{BODY}>,output:struct<{BODY}>>"


def structure(payload: Column) -> Column:
    """A detector's answer as struct(rows, cols, header_rows, cells): wrappers opened, names unified, sizes inferred from cells; zeros if unreadable."""
    p = F.from_json(payload, PAYLOAD)
    b = F.coalesce(*[F.when(p[w]["cells"].isNotNull(), p[w]) for w in ("structure", "result", "data", "prediction", "output")], F.struct(*[p[n.split(":")[0]].alias(n.split(":")[0]) for n in BODY.split(",cells")[0].split(",")], p["cells"].alias("cells")))

    def cell(c: Column) -> Column:
        r0, c0 = F.coalesce(c["row_start"], c["row"], F.lit(0)), F.coalesce(c["col_start"], c["col"], F.lit(0))
        r1, c1 = F.coalesce(c["row_end"], r0), F.coalesce(c["col_end"], c0)
        i = lambda x, name: x.cast("int").alias(name)
        return F.struct(i(F.least(r0, r1), "r0"), i(F.greatest(r0, r1), "r1"), i(F.least(c0, c1), "c0"), i(F.greatest(c0, c1), "c1"), c["text"].alias("text"))

    cells = F.transform(F.coalesce(b["cells"], F.array().cast(f"array<{CELL}>")), cell)
    far = lambda k: F.coalesce(F.array_max(F.transform(cells, lambda c: c[k])), F.lit(-1)) + 1
    return F.struct(
        F.coalesce(b["rows"], b["row_count"], b["num_rows"], far("r1")).cast("int").alias("rows"), F.coalesce(b["cols"], b["col_count"], b["num_cols"], far("c1")).cast("int").alias("cols"),
        F.coalesce(b["header_rows"], F.lit(0)).cast("int").alias("header_rows"), cells.alias("cells"),
    )


def joined_cells(cells: Column) -> Column:
    """Cells over more than one row or column."""
    return F.filter(cells, lambda c: (c["r1"] > c["r0"]) | (c["c1"] > c["c0"]))


def json_objects(lines: DataFrame, line: str) -> DataFrame:
    """Rows whose line is a JSON object; blank, broken and other lines go."""
    t = F.trim(T.blank(F.col(line)))
    return lines.where(T.is_json_object(t))


def as_list(raw: Column) -> Column:
    """A JSON value as a list of strings: a list's items, a scalar alone, none for null."""
    t = F.trim(T.blank(raw))
    return F.when(t.startswith("["), F.from_json(t, "array<string>")).when((t == "null") | (t == ""), F.array().cast("array<string>")).otherwise(F.array(F.regexp_replace(t, '^"|"$', "")))


def anchors(blocks: DataFrame, width: Column, height: Column) -> DataFrame:
    """blocks (.., x, y, w, h, text) with squeezed text and corners as shares of the page."""
    d = blocks.withColumn("text", T.squeeze(F.col("text")))
    return d.withColumns({"x0": F.col("x") / width, "y0": F.col("y") / height, "x1": (F.col("x") + F.col("w")) / width, "y1": (F.col("y") + F.col("h")) / height})


def portable(path: Column, root: str) -> Column:
    return F.when(path.startswith(root.rstrip("/") + "/"), F.substring(path, len(root.rstrip("/")) + 2, 1 << 20)).otherwise(path)
