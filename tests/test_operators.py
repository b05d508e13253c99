"""Operators on small literal cases, and beside sequential definitions."""

import itertools
import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from leafmill.functions import geometry as O
from leafmill.functions import grid as G
from leafmill.functions import parse, similarity
from leafmill.functions import text as T
from leafmill.operators import assembly as Y
from leafmill.operators import context as C
from leafmill.operators import doi as D
from leafmill.operators import evaluate as E
from leafmill.operators import facts as X
from leafmill.operators import matching as M
from leafmill.operators import pages as P
from leafmill.operators import review as R
from leafmill.operators import tables as B


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def arr(*xs):
    return F.array(*[F.lit(x) for x in xs])


def test_cells(spark):
    r = one(spark, a=T.cell_text(F.lit("$\\mu_{x}$<br/> \\(y\\)  \\alphabet")), b=T.ocr_cell(F.lit(" <EMPTY> ")), c=T.table_number(F.lit("see Tab. IV here")), d=T.continued(F.lit("Table 2 (continued)")), e=T.table_number(F.lit(None).cast("string")))
    assert (r.a, r.b, r.c, r.d, r.e) == ("μ_x y \\alphabet", "", "iv", True, "")


def test_doi(spark):
    r = one(spark, a=T.normalize_doi(F.lit(" https://doi.org/10.1000/ABC ")), b=T.doi_candidates(F.lit("x 10.1000/a, y 10.1000/A; 10.5555%2Fq")))
    assert r.a == "10.1000/abc" and r.b == ["10.1000/a", "10.5555/q"]


def test_routes(spark):
    h = lambda s: P.route(P.heuristics(F.lit(s)))
    r = one(spark, a=h("Hello world " * 60), b=h("cid:123 cid:456 " * 30), c=h(""), d=P.route(P.heuristics(F.lit("")), "anchored"))
    assert (r.a, r.b, r.c, r.d) == ("anchored", "unanchored", "unanchored", "anchored")


def test_headers(spark):
    rows = F.array(arr("Polymer", "Solvent", "X", "X"), arr("", "", "a", "n"))
    assert one(spark, h=G.collapse_headers(rows)).h == ["Polymer", "Solvent", "X (a)", "X (n)"]
    assert one(spark, h=G.collapse_headers(F.array().cast("array<array<string>>"))).h == []


def test_leading_column(spark):
    d = spark.range(1).select(arr("Sample", "A", "B").alias("headers"), F.array(arr("", "S1", "1", "2"), arr("", "S2", "3", "4")).alias("rows"))
    r = B.topology(d).first()
    assert r.rows == [["S1", "1", "2"], ["S2", "3", "4"]] and r.reasons == ["leading_empty_column_shift"]


def test_quality_empty(spark):
    none = F.array().cast("array<array<string>>")
    r = one(spark, q=G.quality(arr("a", "b"), none), c=G.catastrophic(arr("a", "b"), none), t=G.transpose(F.array().cast("array<string>"), none))
    assert (r.q.empty, r.q.repeated, r.q.unstable, r.c, r.t) == (0, 0, 0, "no_data_rows", [])


@pytest.mark.parametrize("pages,caps,tokens,want", [((2, 3), ("Table 2: Data", "Table 2 (continued)"), (["a"], ["b"]), 1), ((1, 8), ("Table 1", "Table 1"), (["a"], ["a"]), 2), ((2, 3), ("Table 5", "Table 5"), (["a"], ["b"]), 2), ((2, 3), ("Table 5", "Table 5"), (["a"], ["a"]), 1), ((2, 2), ("x", "x"), (["a"], ["a"]), 2)])
def test_chains(spark, pages, caps, tokens, want):
    d = spark.createDataFrame([("d", p, f"f{i}", c, t) for i, (p, c, t) in enumerate(zip(pages, caps, tokens))], "doc string, page int, frag string, caption string, tokens array<string>")
    assert B.chains(d).select("group_key").distinct().count() == want


def test_chains_beside_loop(spark):
    rng, rows = random.Random(1), []
    for doc in range(60):
        for i in range(rng.randint(1, 12)):
            rows.append((doc, rng.randint(1, 6), f"f{i:02d}", rng.choice(["Table 1", "Table 1 (cont.)", "Table 2", "plain"]), rng.choice([["a", "b", "c"], ["a", "b", "c", "d"], ["x"]])))
    want = {}
    for doc in range(60):
        chains = {}
        for r in sorted((r for r in rows if r[0] == doc), key=lambda r: (r[1], r[2])):
            n = r[3].split()[1][0] if r[3].startswith("Table") else ""
            if not n:
                want[doc, r[2]] = f"fragment:{r[2]}"
                continue
            c = chains.setdefault(n, [])
            ok = c and 0 <= r[1] - c[-1][-1][1] <= 1 and ("cont" in r[3] or "cont" in c[-1][-1][3] or len({*r[4]} & {*c[-1][-1][4]}) / len({*r[4]} | {*c[-1][-1][4]}) >= 0.75)
            c[-1].append(r) if ok else c.append([r])
            want[doc, r[2]] = f"number:{n}:{len(c)}"
    got = B.chains(spark.createDataFrame(rows, "doc int, page int, frag string, caption string, tokens array<string>"))
    assert {(r.doc, r.frag): r.group_key for r in got.collect()} == want


def test_continuations_beside_loop(spark):
    rng, rows = random.Random(2), []
    for doc in range(80):
        for i in range(rng.randint(1, 9)):
            rows.append((doc, f"t{i}", i + 1 + rng.randint(0, 1), rng.choice(["Table 3", "cont table 3", "x"]), rng.random() < 0.5))
    rows = [(d, t, p, p, c, e) for d, t, p, c, e in rows]
    want = set()
    num = lambda c: "3" if "able 3" in c else ""
    for doc in range(80):
        o = sorted((r for r in rows if r[0] == doc), key=lambda r: (r[2], r[1]))
        i = 0
        while i < len(o):
            if i + 1 < len(o):
                a, b = o[i], o[i + 1]
                if b[2] - a[3] == 1 and a[5] and not b[5] and num(a[4]) and num(b[4]) in ("", num(a[4])) and not b[4].lower().startswith("table "):
                    want.add((doc, a[1], b[1]))
                    i += 2
                    continue
            i += 1
    got = B.continuation_pairs(spark.createDataFrame(rows, "doc int, table_id string, page_min int, page_max int, caption string, empty_body boolean"))
    assert {tuple(r) for r in got.collect()} == want and want


def test_greedy_beside_loop(spark):
    rng = random.Random(3)
    rows = [(d, p, l, r, rng.randint(0, 9) / 10) for d in range(5) for p in range(4) for l in range(6) for r in range(5)]
    want = set()
    for d, p in itertools.product(range(5), range(4)):
        ls, rs = set(), set()
        for x in sorted((x for x in rows if x[:2] == (d, p)), key=lambda x: (-x[4], x[2], x[3])):
            if x[2] not in ls and x[3] not in rs:
                ls.add(x[2]), rs.add(x[3])
                want.add(x)
    got = M.greedy(spark.createDataFrame(rows, "doc int, page int, l int, r int, score double"))
    assert {tuple(r) for r in got.collect()} == want


def test_cell_patches(spark):
    rows = [("", "±1", True), ("", "±1", False), ("1.2", "1.2 µm", True), ("abc", "µ", True), ("a<br>b", "a b", True), ("a", "", True), ("qqqq", "zzzz µ", True)]
    got = [(r.text, r.reason) for r in M.patch_cells(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, fill boolean")).orderBy("i").collect()]
    assert got == [("±1", "empty_fill"), ("±1", "symbol_patch"), ("1.2 µm", "symbol_patch"), ("µ", "symbol_patch"), ("a b", ""), ("a", ""), ("qqqq", "")]


def test_ratio(spark):
    rng = random.Random(4)
    pairs = [("".join(rng.choices("abcd ", k=rng.randint(0, 12))), "".join(rng.choices("abcd ", k=rng.randint(0, 12)))) for _ in range(200)] + [("abcd", "bcde")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.ratio(F.col("a"), F.col("b")).alias("r"), similarity.ratio_bound(F.col("a"), F.col("b")).alias("most")).collect()
    for r in got:
        assert r.r == SequenceMatcher(None, r.a, r.b).ratio()
        assert r.r <= r.most or not (r.a or r.b)


def test_context(spark):
    tables = spark.createDataFrame([("d", "t", 2, ["Sample", "v"], [["P1", "1"], ["P2", "2"], ["kg", "3"]])], "doc string, table_id string, page int, headers array<string>, rows array<array<string>>")
    lines = spark.createDataFrame([("d", 1, 0, "P1 = poly(styrene)."), ("d", 2, 0, "made of old glass (P1)"), ("d", 9, 0, "P2 = far away")], "doc string, page int, idx int, line string")
    got = {r.code: r.resolved for r in C.resolve(tables, lines).collect()}
    assert got == {"P1": "poly(styrene)", "P2": None}


def test_facts(spark):
    d = spark.createDataFrame([("d", "t", 1, "", ["Material", None, "Value"], [["A", "skip", "10"]]), ("d", "u", 1, "", ["One"], [["x"]])], "doc_id string, table_id string, page int, caption string, headers array<string>, rows array<array<string>>")
    got = X.errors(X.from_tables(d)).collect()
    assert len(got) == 1 and got[0].source.col_index == 2 and got[0].value_numeric == 10.0 and got[0].confidence == 0.85 and got[0].errors == []


def test_evaluation(spark):
    s = "doc int, page int, table_id string, headers array<string>, rows array<array<string>>"
    gold = spark.createDataFrame([(1, 1, "a", ["s", "v"], [["A", "1.2"], ["B", "2.4"]])], s)
    pred = spark.createDataFrame([(1, 1, "a", ["s", "v"], [["A", "1.2"], ["B", "oops"]])], s)
    other = spark.createDataFrame([(2, 1, "a", ["s", "v"], [["A", "1.2"], ["B", "2.4"]])], s)
    assert E.pairs(gold, other).count() == 0
    m = E.metrics(gold, pred).first()
    assert (m.precision, m.recall, m.cell_accuracy, m.numeric_parse) == (1, 1, 0.75, 0.5)
    bad = E.regression(E.metrics(gold, pred), spark.createDataFrame([(1.0, 1.0)], "precision double, recall double")).collect()
    assert [r.name for r in bad] == ["numeric_parse_floor"]


def test_adjudication(spark):
    s = "doc string, table_id string, action string, presence string, quality double, risk double, structural double, completeness double, units double, context double, robustness string, modes array<string>, missing array<string>"
    rows = [("d", "t1", "review", "yes", 0.6, 0.5, 0.7, 0.8, 0.8, 0.5, "fragile", ["caption_mismatch"], []), ("d", "t2", "accept", None, 0.9, 0.1, 0.9, 0.95, 0.95, 0.9, "robust", [], []), ("d", "t3", "review", "yes", 0.8, 0.3, 0.8, 0.9, 0.85, 0.8, "robust", ["ocr_noise"], []), ("d", "t4", "x", "no", None, None, None, None, None, None, None, ["new_kind"], ["u"])]
    got = {r.table_id: (r.final_action, r.basis, r.resolution, r.blocking) for r in R.adjudicate(spark.createDataFrame(rows, s)).collect()}
    assert got["t1"] == ("reject", "blocking_findings", "supported", ["overall_robustness:fragile"])
    assert got["t2"] == ("accept", "model_accept_no_blockers", "n/a", [])
    assert got["t3"] == ("accept", "review_refuted_by_quality_gate", "refuted", [])
    assert got["t4"][3] == ["failure_mode:new_kind", "missing_required_information", "table_presence:no"]


def test_landing_metadata(spark):
    html = '<meta name="citation_title" content="C"><meta name="DC.title" content="D"><meta property="dc.creator" content="X, Y"><script type="application/ld+json">{"name": "L", "isPartOf": {"name": "J"}, "datePublished": "2001-02-03"}</script>'
    r = one(spark, m=D.landing_metadata(F.lit(html)), n=D.landing_metadata(F.lit(None).cast("string"))).asDict()
    assert tuple(r["m"]) == ("C", "X, Y", "2001", "J") and tuple(r["n"]) == ("", "", "", "")


def test_near_equal_candidates_need_review(spark):
    rows = spark.createDataFrame([("1", "", "", "A study of spark plans", "", "2001", "")], "row_index string, doi_raw string, url_raw string, title string, author string, year string, container string")
    items = spark.createDataFrame([("1", f"10.1000/{i}", "A study of spark plan", ["Doe"], "2001", "book", "") for i in range(2)], "row_index string, doi string, title2 string, families array<string>, year2 string, type string, container2 string")
    none = spark.createDataFrame([], "doi string, agency string")
    got = D.resolve(rows, none, spark.createDataFrame([], "doi string, canonical string"), D.accepted(D.score(rows, items))).first()
    assert got.doi_status == "needs_review" and got.doi_canonical == ""


def test_parsers():
    assert parse.html_rows("<table><tr><th colspan=2>H</th></tr><tr><td rowspan=2>A</td><td>1</td></tr><tr><td>2</td></tr></table>") == {"header_rows": [["H", "H"]], "data_rows": [["A", "1"], ["A", "2"]]}
    assert parse.table_cells("x <TABLE><tr><td colspan='2' class=\"a>b\">1 &lt; 2 < 3<br/>z</td><!-- <td>no</td> --><th>h</th></tr>") == [[["1 < 2 < 3 z", 1, 2, False], ["h", 1, 1, True]]]
    assert parse.html_rows("") == {"header_rows": [], "data_rows": []}
    t = parse.markdown_tables_of("Table 1: x\n\n|  | A | B |  |\n|---|---|---|---|\n|  | 1 | 2 |  |\n| short |\n")
    assert t == [{"headers": ["", "A", "B", ""], "rows": [["", "1", "2", ""]], "caption": "Table 1: x", "start_line": 3, "end_line": 5}]
    assert parse.front_matter_of("---\na: 1\n---\nbody") == {"meta": {"a": "1"}, "body": "body"}
    assert parse.front_matter_of("---\nbroken\n---\nbody")["body"].startswith("---")
    deep = '{"block_type": "Page", "id": "/page/0/P/1", "children": ' * 300 + "[]" + "}" * 300
    assert len(parse.blocks_of(deep)) == 1 and parse.blocks_of("nope") == []


def test_boxes(spark):
    r = one(spark, a=O.bbox_pixels(arr(0.0, 0.0, 0.5, 0.5), F.lit(400), F.lit(200)), b=O.bbox_pixels(arr(200.0, 100.0, 400.0, 200.0), F.lit(400), F.lit(200)), c=O.bbox_pixels(arr(5.0, 5.0, 5.0, 9.0), F.lit(400), F.lit(200)))
    assert (r.a, r.b, r.c) == ([0, 0, 200, 100], [200, 100, 400, 200], None)


def test_spans(spark):
    c = spark.createDataFrame([("t", 0, 0, 0, 0, 1, "Header"), ("t", 1, 1, 1, 0, 0, "A"), ("t", 2, 1, 1, 1, 1, "B")], "table_id string, ord int, r0 int, r1 int, c0 int, c1 int, text string")
    got = {(r.row, r.col): r.text for r in B.grid_from_spans(c).collect()}
    assert got == {(0, 0): "Header", (0, 1): "Header", (1, 0): "A", (1, 1): "B"}


def test_plans_stay_native(spark):
    from conftest import DATA

    from leafmill.plans import catalog

    python = {"page_match_greedy", "ocr_patch", "compare_readings", "ratio_self", "title_similarity", "doi_resolution", "html_grid_round_trip", "markdown_table_round_trip", "block_tree_tables", "html_evidence", "front_matter"}
    for name, query in ((n, q) for n, q in catalog.QUERIES.items() if not n.startswith("export_")):  # these run as they are built
        plan = query(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert ("Python" in plan or "Pandas" in plan or "Arrow" in plan) == (name in python), name
        assert "CartesianProduct" not in plan, name


def test_columns_are_pruned(spark):
    from conftest import DATA

    from leafmill.plans import catalog

    plan = catalog.QUERIES["facts_summary"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in plan and "ReadSchema" in plan


def test_matching_stays_whole_behind_a_join_broadcast_at_run_time(spark):
    """A page's pairs reach one walk even where the join below was dealt by page and turned into a broadcast."""
    from leafmill.operators import matching as M

    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    d = spark.range(3000).select((F.col("id") % 20).cast("int").alias("doc"), F.lit(1).alias("page"), (F.col("id") % 7).alias("l"), F.col("id").alias("r"), (1 / (F.col("id") + 1)).alias("score")).repartition(9).checkpoint()
    on = d.select("doc", "page").distinct().checkpoint()
    for k, v in zip(old, ("-1", "10MB", "false")):
        spark.conf.set(k, v)
    try:
        n = M.greedy(d.join(on.where("doc >= 0"), ["doc", "page"])).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert n == 20 * 7


def test_fixed_lists(spark):
    """Units are no codes, other short names are; stop words and headings are the fixed ones."""
    words = ["ms", "Hz", "HZ", "kg", "PPM", "MPA", "K", "PVA", "P1", "abc", "Ab", "A", "wt", "DL"]
    got = one(spark, **{f"w{i}": T.is_code(F.lit(w)) for i, w in enumerate(words)}).asDict()
    assert [w for i, w in enumerate(words) if got[f"w{i}"]] == ["PPM", "MPA", "PVA", "P1", "Ab", "DL"]
    lines = ["Result", "3.1 Results", "Conclusion", "Conclusions", "Experimental", "Methods", "Results:", "materials and methods", "Acknowledgments"]
    got = one(spark, **{f"w{i}": F.lit(w).rlike(P.PLAIN_HEADING) for i, w in enumerate(lines)}).asDict()
    assert [w for i, w in enumerate(lines) if got[f"w{i}"]] == ["Result", "3.1 Results", "Conclusion", "Methods", "materials and methods"]


def test_doi_candidates_like_the_rules(spark):
    import re
    from urllib.parse import parse_qs, unquote, urlparse

    match, prefix, tail = re.compile(r"10\.\d{4,9}/[^\s\"'<>]+", re.I), re.compile(r"^(?:https?://(?:dx\.)?doi\.org/|doi:)", re.I), ".,;:)]}>\"'"

    def norm(s):
        d = prefix.sub("", s.strip()).strip().strip("<>{}[]()")
        return d.rstrip(tail).strip().lower()

    def rules(text):
        out = []
        for s in dict.fromkeys([text.strip(), unquote(text.strip())]):
            u = urlparse(s)
            more = [*(parse_qs(u.query).get("doi", []) if u.scheme and u.netloc else []), *([u.path.lstrip("/")] if u.scheme and "doi.org" in u.netloc.lower() and u.path else [])]
            for c in [s, *match.findall(s), *more]:
                if (d := norm(c)) and match.fullmatch(d) and d not in out:
                    out.append(d)
        return out

    texts = ["", "none here", "doi: 10.1000/ABC.", "(10.1000/a_b*c!)", "https://doi.org/10.1000/x;y?z=1", "https://x.org/a?b=1&doi=10.5555%2Fq%2Bw&c=2#d", "http://dx.doi.org//10.1234/(a)<b>", "see 10.1000/a, and 10.1000/A; 10.12345678/é", "10.1/short", '"10.1000/quoted"', "https%3A%2F%2Fdoi.org%2F10.7777%2Fenc", "100% of 10.1000/pc%zz", "a+b 10.1000/x+y"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.doi_candidates(F.col("t")).alias("d")).collect()
    assert {r.i: r.d for r in got} == {i: rules(t) for i, t in enumerate(texts)}


def test_bibliography_like_the_rules(spark):
    page = "# [Viscosity](x) of *Dilute* Polymer Solutions\n\nAnn B. Lee, Carl Oh-Niel and Eve Doe*\nDepartment of Physics, Some University\nJournal of Flow 12 (2003) 1-9 doi:10.1000/JF.2003.\nAbstract\nWe measure."
    short = "doi:10.1000/only\nTwo words\nA longer line of text with five words\nAnn Lee\nKeywords: x\nBob Lee, Eve Doe"
    d = spark.createDataFrame([(1, 1, page), (2, 1, short), (3, 1, None), (1, 2, "Another page of the same document")], "doc int, page int, text string")
    got = {r.doc: r for r in P.bibliography(d).collect()}
    assert set(got) == {1, 2, 3}
    r = got[1]
    assert (r.title, r.authors, r.year, r.doi, r.journal_ref) == ("Viscosity of Dilute Polymer Solutions", ["Ann B. Lee", "Carl Oh-Niel", "Eve Doe"], "2003", "10.1000/JF.2003", "Journal of Flow 12 (2003) 1-9 .")
    assert (got[2].title, got[2].authors, got[2].year, got[2].doi) == ("A longer line of text with five words", [], "", "10.1000/only")
    assert (got[3].title, got[3].authors, got[3].journal_ref) == ("", [], "")


def test_abstract_beside_plain_python(spark):
    """Whole texts of five pages, some with a heading, blank lines, other headings and keywords."""
    import random
    import re

    rng = random.Random(5)
    parts = ["One sentence here. Another one! A third? ", "", "## Abstract", "Abstract:", "# Heading", "Introduction", "Keywords: a, b", "*some* [text](link) without stop", "doi: 10.1000/x", "long " * 120 + "end."]
    pages = [(d, p, "\n".join(rng.choices(parts, k=rng.randint(0, 9)))) for d in range(150) for p in range(1, 8)]

    def clean(s):
        s = re.sub(r"\[([^\]]+)\]\([^)]+\)", r"\1", re.sub(r"^#{1,6}\s+", "", s.strip()))
        return re.sub(r"\s+", " ", re.sub(r"[`*_~]+", "", s)).strip()

    def clip(s):
        s = re.sub(r"\s+", " ", s).strip()
        out = " ".join(re.split(r"(?<=[.!?])\s+", s)[:2]).strip()
        return out if len(out) <= 480 else out[:477].rstrip() + "..."

    mark, plain = re.compile(r"^\s{0,3}(#{1,6})\s+(.+?)\s*$"), re.compile(P.PLAIN_HEADING)
    for doc, got in [(r.doc, r.abstract) for r in Y.abstract(P.lines(spark.createDataFrame(pages, "doc int, page int, text string"))).collect()]:
        lines = [x.strip() for d, p, t in pages if d == doc and p <= 5 for x in [f"# Page {p}", "", *t.split("\n"), ""]]
        said, on = [], False
        for x in lines:
            if not x:
                if on and said:
                    break
                continue
            if re.match(r"(?i)^(?:#{1,6}\s*)?abstract\s*:?\s*$", x):
                on = True
            elif on:
                if mark.match(x) or plain.match(x) or x.lower().startswith("keywords"):
                    break
                said.append(clean(x))
        if not said:
            for x in [x.strip() for d, p, t in pages if d == doc and p <= 2 for x in [f"# Page {p}", "", *t.split("\n"), ""]]:
                if not x:
                    if said:
                        break
                    continue
                if mark.match(x) or not clean(x) or clean(x).lower().startswith(("keywords", "doi:")):
                    continue
                said.append(clean(x))
        assert got == clip(" ".join(said)), (doc, lines)


@pytest.mark.parametrize(("block", "meta"), [
    ("a: 1\nb: 'it''s'\nc: \"x: y\"\nd:\n", {"a": "1", "b": "it's", "c": "x: y", "d": None}),
    ("# comment\nauthors:\n  - Ann Lee\n  - name: Bob\n    year: 2001\nwhere:\n  city: Rome # old\n  at: [1, 2.5, 'c, d', {k: v}]\nlast: true\n", {"authors": '["Ann Lee", {"name": "Bob", "year": 2001}]', "where": '{"city": "Rome", "at": [1, 2.5, "c, d", {"k": "v"}]}', "last": "true"}),
    ("tags:\n- a\n- b\nurl: http://x.org/a\n", {"tags": '["a", "b"]', "url": "http://x.org/a"}),
    ("- only\n- a list\n", {}), ("", {}),
])
def test_front_matter_nested(block, meta):
    assert parse.front_matter_of(f"---\n{block}---\nbody\n---\n") == {"meta": meta, "body": "body\n---\n"}


@pytest.mark.parametrize("block", ["no map here\n", "a: 'open\n", "a: b: c\n", "a: 1\n    b: 2\n", "a: [1, 2\n", "a: |\n  text\n"])
def test_front_matter_that_cannot_be_read_stays(block):
    t = f"---\n{block}---\nbody"
    assert parse.front_matter_of(t) == {"meta": {}, "body": t}



def test_definitions_beside_a_plain_search(spark):
    """Every definition of random lines, as a plain regular expression finds it."""
    rng = random.Random(7)
    parts = ["P1", "PS-2", "AB", "resin", "of ", " ", ":", "=", "(", ")", ";", ",", " (P3)", "a long name (Q4) ", "é", ".", "x9 = ", "  "]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["", "P1 = " + "word " * 40 + "(R7)"]
    d = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(lines)], "doc string, page int, idx int, line string")
    got = {(r.idx, r.code, r.resolved, r.kind, r.seq) for r in C.definitions(d).collect()}
    tidy = lambda t: re.sub(r"[.,;]+$", "", t.strip())
    token, want = C.TOKEN, []
    for i, line in enumerate(lines):
        t = re.sub(r"\s+", " ", line).strip()
        for kind, pattern, code, text in (("equals", rf"^({token})\s*[:=]\s*(.+)$", 1, 2), ("inline_equals", rf"\b({token})\s*[:=]\s*([^;]+)", 1, 2), ("paren_reverse", rf"([A-Za-z][A-Za-z0-9\s,\-]{{2,80}})\(\s*({token})\s*\)", 2, 1)):
            want += [(i, m.group(code), tidy(m.group(text)), kind, n) for n, m in enumerate(re.finditer(pattern, t))]
    w = spark.createDataFrame(want, "idx int, code string, resolved string, kind string, seq int")
    want = {tuple(r) for r in w.where(T.is_code(F.col("code")) & (F.col("resolved") != "")).collect()}
    assert len(want) > 500 and {k for _, _, _, k, _ in want} == {"equals", "inline_equals", "paren_reverse"}
    assert got == want


def test_plain_text_decodes_references(spark):
    import html

    texts = ["a &mu;m &ndash; b", "5 &lt; 6 &amp;lt; &quot;x&#39;", "T = 20&deg;C<br/>&amp;mu;", "R&D &x y & z", "&nbsp;&alpha;&amp", "", None, "<b>plain</b>  é"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.p for r in d.select("i", T.plain_text(F.col("t")).alias("p")).collect()}
    want = {i: " ".join(html.unescape(re.sub("<[^>]+>", " ", re.sub(r"(?i)<br\s*/?>", "\n", t or ""))).split()) for i, t in enumerate(texts)}
    assert got == want


def test_plain_text_query_equals_sql_on_unclosed_references(spark, duck, tmp_path):
    from conftest import same_rows

    from leafmill.plans import catalog

    html = ["<p>token = &quot p{margin:0}</p>", "5 &lt 6&gt;&copy 2&middot 3", "cut &quo", "x&#39y&amp z&nbsp", "", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(html)], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    sql = catalog.SQL["html_plain_text"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert same_rows(duck, catalog.QUERIES["html_plain_text"](spark, str(tmp_path)), sql) == (0, len(html))


def test_span_text_query_equals_sql_on_empty_texts(spark, duck, tmp_path):
    from conftest import same_rows

    from leafmill.plans import catalog

    texts = ["a\n\nb", "", "\n\n", None, " \n"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sql = catalog.SQL["span_text"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert same_rows(duck, catalog.QUERIES["span_text"](spark, str(tmp_path)), sql) == (0, len(texts))


def test_review_context_deals_out_no_copies_of_texts(spark):
    """Above the join that gives each table its page texts no shuffle stands."""
    from leafmill.operators import assembly as Y

    pages = spark.createDataFrame([(1, p, f"page {p}") for p in (1, 2, 3)], "doc int, page int, text string")
    f = spark.createDataFrame([(1, i, f"caption {i}") for i in range(6)], "doc int, frag int, caption string")
    t = f.select("doc", F.col("frag").alias("table_id"), F.array(F.col("frag").cast("string")).alias("fragment_ids"), F.when(F.col("frag") < 5, F.array(F.col("frag") % 3 + 1, F.col("frag") % 3 + 2)).alias("pages"))
    d = Y.review_context(t, f, pages)
    got = {r.table_id: (r.fragments, r.captions, r.page_text) for r in d.collect()}
    assert got == {i: (1, f"caption {i}", ("page 1\npage 2", "page 2\npage 3", "page 3")[i % 3] if i < 5 else "") for i in range(6)}
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "page_text" not in joins[1] and "at#" in joins[0]


def test_plain_cells_are_left_as_they_are(spark):
    cells = ["P1", "", " a", "a b", "1,5", "$x$", "a\\mu", "{a}", "a<br>b", "a\n", "é", "a\u00a0", "<empty>", "N/A", "|~[]^_`!-#%@", "x>y", None]
    d = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r for r in d.select(T.cell_text(F.col("c")), T.ocr_cell(F.col("c"))).collect()] == [r for r in d.select(T._cell_text(F.col("c")), F.when(F.lower(T.squeeze(F.col("c"))).isin("<empty>", "[empty]", "(empty)", "empty", "n/a"), "").otherwise(T.squeeze(F.col("c")))).collect()]


def test_repeated_parts_of_grid_expressions_are_worked_out_once(spark):
    """A part that a lambda spells out is worked out for each place; bound by let it stands in the plan once."""
    from leafmill.functions import grid as G
    from leafmill.operators import assembly as Y

    d = spark.createDataFrame([([["a", "b"]], "[]")], "g array<array<string>>, answer string")
    g = F.col("g")
    for c in (Y.prefilled(g, g, F.lit(4), F.lit(3)), Y.grid_markdown(F.concat(g, g), F.lit(2)), G.collapse_headers(F.concat(g, g)), G.row_kinds(g, F.lit(1)), Y.missing_values(g, F.concat(g, g))):
        plan = d.select(c.alias("c"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("concat(g#") <= 1 and plan.count("(?U)") <= 4, plan


def test_block_trees_are_parsed_once_and_repairs_are_not_joined(spark):
    from conftest import DATA

    from leafmill.plans import catalog

    trees = catalog.QUERIES["block_tree_tables"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "_block_tree" not in trees
    assert "Join" not in catalog.QUERIES["rectify_apply"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
