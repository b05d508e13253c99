"""Expressions over ragged grids: headers array<string>, rows array<array<string>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UNITS, cell_text, numericish

EMPTY = "cast(array() as array<string>)"


def let(value: Column, use) -> Column:
    """use(value), with value worked out once a row; spelled out in a lambda it would be once for each place and item."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def upto(n: Column) -> Column:
    """0 .. n - 1; nothing for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def pad(row: Column, n: Column) -> Column:
    return F.concat(row, F.array_repeat(F.lit(""), n - F.size(row)))


def fit(row: Column, n: Column) -> Column:
    """Padded or cut to n cells."""
    return F.slice(pad(row, n), F.lit(1), n)


def width(headers: Column, rows: Column) -> Column:
    return F.greatest(F.size(headers), F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0)))


def column(rows: Column, c: Column) -> Column:
    return F.transform(rows, lambda r: F.coalesce(F.get(r, c), F.lit("")))


def transpose(headers: Column, rows: Column) -> Column:
    """Columns of the padded grid; the first is the new header."""
    n, grid = width(headers, rows), F.concat(F.array(headers), rows)
    return F.transform(upto(n), lambda c: column(grid, c))


def collapse_headers(header_rows: Column) -> Column:
    """One header per column: its distinct consecutive texts as 'a (b / c)'."""

    def one(rows: Column, c: Column) -> Column:
        texts = F.filter(column(rows, c), lambda x: x != "")
        none = F.array().cast("array<string>")
        kept = F.aggregate(texts, none, lambda a, x: F.when(F.element_at(F.concat(F.array(F.lit("")), a), -1) == x, a).otherwise(F.concat(a, F.array(x))))
        more = lambda k: F.concat(F.get(k, F.lit(0)), F.lit(" ("), F.array_join(F.slice(k, 2, 1000), " / "), F.lit(")"))
        return let(kept, lambda k: F.when(F.size(k) == 0, "").when(F.size(k) == 1, F.get(k, F.lit(0))).otherwise(more(k)))

    def all_of(rows: Column) -> Column:
        return F.transform(upto(F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))), lambda c: one(rows, c))

    return let(F.transform(header_rows, lambda r: F.transform(r, cell_text)), all_of)


def share(rows: Column, test) -> Column:
    return F.size(F.filter(rows, test)) / F.greatest(F.size(rows), F.lit(1))


def most_common_share(rows: Column) -> Column:
    """Share of the most frequent cell text, blanks included: the longest run of the sorted cells."""
    cells = F.array_sort(F.flatten(rows))
    zero = F.struct(F.lit(None).cast("string").alias("v"), F.lit(0).alias("n"), F.lit(0).alias("top"))

    def step(a: Column, x: Column) -> Column:
        n = F.when(a["v"] == x, a["n"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("v"), n.alias("n"), F.greatest(a["top"], n).alias("top"))

    return F.aggregate(cells, zero, step, lambda a: a["top"]) / F.greatest(F.size(cells), F.lit(1))


def quality(headers: Column, rows: Column) -> Column:
    """struct(empty, repeated, unstable): shares of blank cells, of the commonest cell, of rows of another width."""
    blank_cells = F.size(F.filter(F.flatten(rows), lambda x: F.trim(x) == ""))
    total = F.greatest(F.size(headers), F.lit(1)) * F.greatest(F.size(rows), F.lit(1))
    unstable = F.when(F.size(rows) == 0, F.lit(0.0)).otherwise(share(rows, lambda r: F.size(r) != F.size(headers)))
    return F.struct((blank_cells / total).alias("empty"), most_common_share(rows).alias("repeated"), unstable.alias("unstable"))


def fails_quality(q: Column) -> Column:
    return (q["empty"] > 0.35) | (q["repeated"] > 0.45) | (q["unstable"] > 0.20)


def escalation_improves(before: Column, after: Column) -> Column:
    keys = ("empty", "repeated", "unstable")
    better = [before[k] - after[k] >= 0.05 for k in keys]
    worse = [after[k] - before[k] > 0.05 for k in keys]
    return (better[0] | better[1] | better[2]) & ~(worse[0] | worse[1] | worse[2])


def catastrophic(headers: Column, rows: Column) -> Column:
    """First reason to leave a table out, or an empty string."""
    named = F.filter(F.transform(headers, lambda h: F.trim(F.coalesce(h, F.lit("")))), lambda h: h != "")
    longest = F.coalesce(F.array_max(F.transform(headers, F.length)), F.lit(0))
    return (
        F.when(F.size(rows) == 0, "no_data_rows")
        .when((F.size(headers) >= 4) & (F.size(named) <= 1), "sparse_headers")
        .when((F.size(named) >= 3) & (F.size(F.array_distinct(named)) <= 1), "duplicate_headers")
        .when(longest >= 180, F.concat(F.lit("header_cell_too_long:"), longest.cast("string")))
        .otherwise("")
    )


def orientation(headers: Column, rows: Column) -> Column:
    """How much headers read as headers and the first column as names."""
    n = F.greatest(F.size(headers), F.lit(1))
    full = F.size(F.filter(headers, lambda h: cell_text(h) != ""))
    words = F.size(F.filter(headers, lambda h: (cell_text(h) != "") & ~numericish(h)))
    head = 0.6 * (words / n) + 0.4 * (full / n)
    firsts = F.transform(F.filter(rows, lambda r: F.size(r) > 0), lambda r: F.get(r, F.lit(0)))
    body = 0.45 * head + 0.30 * share(F.flatten(rows), numericish) + 0.25 * share(firsts, lambda x: (cell_text(x) != "") & ~numericish(x))
    return F.when(F.size(headers) == 0, F.lit(0.0)).when(F.size(rows) == 0, head).otherwise(body)


def unshift(headers: Column, rows: Column) -> tuple[Column, Column]:
    """Rows without a blank column that most of them have too many at one end; and the reason."""
    n, need = F.size(headers), F.greatest(F.lit(1), F.floor(F.lit(0.7) * F.size(rows)))
    lead = F.size(F.filter(rows, lambda r: (F.size(r) == n + 1) & (cell_text(F.get(r, F.lit(0))) == "")))
    trail = F.size(F.filter(rows, lambda r: (F.size(r) == n + 1) & (cell_text(F.get(r, F.size(r) - 1)) == "")))
    why = F.when(n == 0, "").when(lead >= need, "leading_empty_column_shift").when(trail >= need, "trailing_empty_column_shift").otherwise("")
    cut_lead = F.transform(rows, lambda r: F.when(F.size(r) > n, F.slice(r, F.lit(2), F.size(r))).otherwise(r))
    cut_trail = F.transform(rows, lambda r: F.when(F.size(r) > n, F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))
    return F.when(why.startswith("lead"), cut_lead).when(why.startswith("trail"), cut_trail).otherwise(rows), why


def flatten_text(headers: Column, rows: Column) -> Column:
    line = lambda r: F.array_join(F.transform(r, cell_text), " | ")
    return F.array_join(F.concat(F.when(F.size(headers) > 0, F.array(line(headers))).otherwise(F.array().cast("array<string>")), F.transform(rows, line)), "\n")


def row_kinds(rows: Column, header_rows: Column) -> Column:
    """header, empty, group (a name with at most notes beside it) or data, for each row."""
    note = r"^(?:[*†‡§a-z]|\([a-z]\)|\[[0-9]+\])$"

    def kind(r: Column, i: Column) -> Column:
        return F.when(i < header_rows, "header").otherwise(let(F.transform(r, cell_text), lambda cells: let(F.filter(F.slice(cells, 2, 100000), lambda x: x != ""), lambda tail: below(cells, tail))))

    def below(cells: Column, tail: Column) -> Column:
        first = F.coalesce(F.get(cells, F.lit(0)), F.lit(""))
        few = F.size(F.filter(tail, lambda x: x.rlike("[0-9]"))) <= F.greatest(F.lit(1), F.floor(F.size(tail) / 3))
        group = first.rlike("[A-Za-z]") & (F.forall(tail, lambda x: x.rlike(note)) | few)
        return F.when(~F.exists(cells, lambda x: x != ""), "empty").when(group, "group").otherwise("data")

    return F.transform(rows, kind)


def required_missing(headers: Column, caption: Column, mappings: Column, unresolved: Column, sparse_first: Column) -> Column:
    """Sorted names of what a table lacks."""
    head = F.array_join(F.transform(headers, cell_text), " ")
    named = F.size(F.filter(headers, lambda h: cell_text(h) != ""))
    found = F.array(
        F.when(cell_text(caption).rlike(UNITS) & ~head.rlike(UNITS), F.lit("units_not_propagated_from_caption")),
        F.when(F.size(unresolved) > 0, F.concat(F.lit("unresolved_code_mappings:"), F.array_join(F.array_sort(unresolved), ","))),
        F.when(named <= 1, F.lit("missing_required_columns")),
        F.when(sparse_first, F.lit("incomplete_identifier_column")),
        F.when((F.size(mappings) == 0) & F.lower(head).contains("code"), F.lit("missing_context_mappings")),
    )
    return F.array_sort(F.filter(found, lambda x: x.isNotNull()))


def hierarchy(header_rows: Column) -> Column:
    return F.transform(header_rows, lambda r, i: F.struct((i + 1).alias("level"), r.alias("cells")))
