"""Steps whose work or bytes must not outgrow their input."""

import random

from pyspark.sql import functions as F

from leafmill.operators import matching as M

GRIDS = "doc int, page int, ord long, headers array<string>, rows array<array<string>>"


def readings(spark, n=60):
    """Two readings of pages with ties, copies, tables without words and words in common."""
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 2)
    side = lambda: [(d, p, i, [word() for _ in range(rng.randint(0, 4))], [[word() for _ in range(rng.randint(0, 6))] for _ in range(rng.randint(0, 3))]) for d in range(3) for p in range(2) for i in rng.sample(range(1000), n // 3 * (d + 1))]
    return spark.createDataFrame(side(), GRIDS), spark.createDataFrame(side(), GRIDS)


def plain_pairs(left, right, least):
    """Scores by Python sets."""
    out = []
    words = lambda t: {w for c in t.headers + (t.rows[0] if t.rows else []) for w in [c.lower()] if w}
    like = lambda a, b: 1 - abs(a - b) / max(a, b, 1)
    for a in left:
        for b in right:
            if (a.doc, a.page) == (b.doc, b.page):
                x, y = words(a), words(b)
                same = 1.0 if not x and not y else len(x & y) / len(x | y)
                score = 0.7 * same + 0.2 * like(len(a.headers), len(b.headers)) + 0.1 * like(len(a.rows), len(b.rows))
                if score >= least:
                    out.append((a.doc, a.page, a.ord, b.ord, score))
    return out


def test_candidates_are_scored_in_many_parts(spark):
    """Pairs of a page are shared out among tasks; adaptive execution joins the parts of small tables otherwise."""
    l, r = readings(spark)
    got = M.candidates(l, r)
    assert sorted(map(tuple, got.collect())) == sorted(plain_pairs(l.collect(), r.collect(), 0.25))
    assert got.rdd.getNumPartitions() >= 64


def test_candidates_from_a_high_score_meet_by_rare_words(spark):
    l, r = readings(spark)
    for least in (0.31, 0.6, 0.9, 1.0):
        got = M.candidates(l, r, least)
        assert sorted(map(tuple, got.collect())) == sorted(plain_pairs(l.collect(), r.collect(), least)), least
        assert "_word" in got._jdf.queryExecution().optimizedPlan().toString()


def test_match_is_greedy_over_all_candidates(spark):
    l, r = readings(spark)
    for least in (0.0, 0.25, 0.7):
        ls, rs, want = set(), set(), set()
        for x in sorted(plain_pairs(l.collect(), r.collect(), least), key=lambda x: (*x[:2], -x[4], x[2], x[3])):
            if (*x[:2], x[2]) not in ls and (*x[:2], x[3]) not in rs:
                ls.add((*x[:2], x[2])), rs.add((*x[:2], x[3]))
                want.add(x)
        assert {tuple(x) for x in M.match(l, r, least).collect()} == want and want
    plan = M.match(l, r)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # no pairs below the walk


def test_escalation_reads_each_grid_once(spark):
    from conftest import DATA

    from leafmill.plans import table_queries as Q

    assert Q.escalation_budget(spark, DATA)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_normal_dois_skip_the_searches(spark):
    """Plain DOIs and all other texts come out as the long way gives them; texts with spaces between words are no DOIs."""
    from leafmill.functions import text as T

    texts = ["10.1000/AB1", "10.1000/ab.,", "doi: 10.1000/X", " 10.1000/a ", "(10.1000/a)", "10.1000/a b", "10.1000/", "10.1000/É", "10.1000/a\n", "https://doi.org/10.1/x", "see 10.1000/q and 10.2000/r", None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert d.where(~T.normalize_doi(F.col("t")).eqNullSafe(T._normalize_doi(F.col("t")))).count() == 0
    plan = d.select(T.doi_candidates(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_url_decode") <= 3 and plan.count("(?U)^") <= 8
    got = {r.i: r.d for r in d.select("i", T.doi_candidates(F.col("t")).alias("d")).collect()}
    assert got[2] == ["10.1000/x"] and got[5] == ["10.1000/a"] and got[10] == ["10.1000/q", "10.2000/r"] and got[11] == []


def test_evidence_of_equal_tags_is_planned_once():
    from leafmill.functions import parse

    rng = random.Random(5)
    bits = ["<table>", "<tr>", "</tr>", "<td>", "</td>", "<td colspan=2>", "<th rowspan='2'>", "<td class=\"a>b\">", "<br/>", "<b>", "<!-- x -->", "<!-- <td>a><b -->", "a b", " 1.5", "x &lt; y", "<", ">", "'", '"', "", "\0", " "]
    for _ in range(4000):
        html = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert parse.evidence_of(html) == parse._evidence_of(html), html
    parse._plans.clear()
    for i in range(50):
        parse.evidence_of(f"<table><tr><td>{i}</td><td colspan=2>b{i} c</td></tr></table>")
    assert len(parse._plans) == 1


def test_rows_and_grids_are_gathered_without_a_window(spark):
    from conftest import DATA

    from leafmill.plans import views as V

    rows, grids = V.v_row(spark, DATA), V.v_grid(spark, DATA)
    for d in (rows, grids):
        assert "Window" not in d._jdf.queryExecution().optimizedPlan().toString()
    nested = rows.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("idx", "cells")))["cells"].alias("want"))
    assert grids.join(nested, "table_id").where("rows = want").count() == grids.count() > 0


def test_short_ratios_without_a_sequence_matcher(monkeypatch):
    from difflib import SequenceMatcher

    from leafmill.functions import similarity as S

    rng = random.Random(11)
    text = lambda n: "".join(rng.choices("ab |1.", k=n))
    pairs = [(text(rng.randint(0, 260)), text(rng.randint(0, 260))) for _ in range(150)]
    pairs += [(a, a[: len(a) // 2] + text(3) + a[len(a) // 2 :]) for a, _ in pairs]
    want = [SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    asked = []
    monkeypatch.setattr(S, "SequenceMatcher", lambda *a: asked.append(a) or SequenceMatcher(*a))
    assert [S.sequence_ratio(a, b) for a, b in pairs] == want
    assert asked and all(len(a[2]) >= 200 for a in asked)


def test_grids_meet_whole_and_are_patched_as_row_by_row(spark):
    rng = random.Random(13)
    cell = lambda: rng.choice(["", "", "abc", "abd µ", "±1", "12 µm", "12", "a<br>b", "a b", "ab", None])
    l = [(d, 1, i, ["h", cell()], [[cell() for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(0, 3))]) for d in range(4) for i in range(60)]
    r = [(d, p, i, h, [[cell() if rng.random() < 0.4 else c for c in row] for row in rows]) for d, p, i, h, rows in l]
    left, right = spark.createDataFrame(l, GRIDS), spark.createDataFrame(r, GRIDS)
    pairs = left.select("doc", "page", F.col("ord").alias("l"), F.col("ord").alias("r"))
    got = M.patch_grids(left, right, pairs)
    sig = lambda c: "".join(x for x in " ".join(y for y in c if y is not None).lower() if x.isascii() and x.isalnum())
    from difflib import SequenceMatcher

    cells = [(d, p, i, n - 1, c, n == 0 or SequenceMatcher(None, sig(x), sig(y)).ratio() >= 0.9, a, b) for (d, p, i, h, rows), (*_, h2, rows2) in zip(l, r) for n, (x, y) in enumerate(zip([h, *rows], [h2, *rows2])) for c, (a, b) in enumerate(zip(x, y))]
    want = M.patch_cells(spark.createDataFrame(cells, "doc int, page int, ord long, row int, col int, fill boolean, a string, b string")).select("doc", "page", "ord", "row", "col", "text", "reason")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    found = sorted(tuple(x) for x in got.collect() if x.reason)
    assert sorted(map(tuple, M.patch_grids(left, right, pairs, changed=True).collect())) == found and {x[-1] for x in found} == {"empty_fill", "symbol_patch", "format_patch"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("Join") and plan.count("Join") == 2 and plan.rindex("Generate") < plan.index("Join")


def test_evaluation_joins_slim_grids(spark):
    """Blank, missing and odd cells count as they did; headers meet as numbers."""
    from leafmill.operators import evaluate as E

    s = "doc int, page int, table_id string, headers array<string>, rows array<array<string>>"
    gold = spark.createDataFrame([(1, 1, "a", ["s", "v", "w"], [["A", "1\t2", None], [], ["", "x 3"], None]), (1, 2, "a", ["s"], []), (1, 0, "z", ["s"], [])], s)
    pred = spark.createDataFrame([(1, 1, "a", ["s", "v", "w"], [[" a ", "1  2", ""], [""], ["4"], ["q"]]), (2, 1, "a", ["s"], [])], s)
    m = E.metrics(gold, pred).first()
    assert (m.gold_tables, m.pred_tables, m.matched_pages, m.precision, m.recall, m.matched_tables) == (3, 2, 1, 0.5, 0.5, 1)
    # twelve cells: those of the first two rows and two of the last are the same, one of two numbers is read
    assert (m.cell_accuracy, m.numeric_parse, m.numeric_cells, m.row_count_match, m.column_count_match) == (9 / 12, 0.5, 2, 1.0, 1.0)
    assert "size(gh" not in E.metrics(gold, pred)._jdf.queryExecution().optimizedPlan().toString()
