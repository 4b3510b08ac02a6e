"""Cross-site line dedup against brute force and SQL."""

import duckdb
from pyspark.sql import functions as F

from orderlake.llm import linededup, oracles, queries
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def brute(rows, min_sites):
    """Removed positions by row number: rows are (id, text, site)."""
    sites, first = {}, {}
    places = sorted(((i is None, i if i is not None else 0), k, p, line.strip(" \t\r"), s)
                    for k, (i, t, s) in enumerate(rows) if t is not None for p, line in enumerate(t.split("\n")))
    for order, k, p, line, site in ((o, k, p, line, s) for o, k, p, line, s in places):
        if line:
            sites.setdefault(line, set()).add(site)
            first.setdefault(line, (k, p))
    out = {k: [] for k in range(len(rows))}
    for _, k, p, line, _ in sorted(places, key=lambda x: (x[1], x[2])):
        if line and len(sites[line]) >= min_sites and first[line] != (k, p):
            out[k].append(p)
    return out


def test_lines_on_many_sites_stay_once(spark):
    shared, two = prose(1, 12), prose(2, 12)
    rows = [(5, f"{shared}\nown 5\n\n{shared}", "a"), (2, f" {shared} \nown 2\n{two}", "b"), (7, f"own 7\r\n{shared}\r", "c"),
            (8, f"{two}\n{two}", "a"), (9, shared, None), (10, "own 10", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for n in (2, 3, 4, 5):
        got = {r.doc_id: r for r in linededup.dedup_lines(df, min_sites=n).collect()}
        want = brute(rows, n)
        for k, (i, t, _) in enumerate(rows):
            assert got[i].removed_lines == want[k] and got[i].n_removed == len(want[k]), (n, i)
            assert got[i].text == "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want[k])


def test_spreads_near_the_threshold_are_exact(spark):
    # lines on 90 to 110 sites each, around a threshold of 100
    df = spark.range(90, 111).selectExpr("id as spread", "explode(sequence(1, id)) as site").selectExpr(
        "spread * 1000 + site as doc_id", "concat('line ', spread) as text", "concat('s', site) as source")
    removed = linededup.dedup_lines(df, min_sites=100).where("n_removed > 0").selectExpr("doc_id div 1000 as spread").distinct()
    assert sorted(r.spread for r in removed.collect()) == list(range(100, 111))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.execute(oracles.OP4)
    names = [d[0] for d in want.description]
    got = queries.QUERIES["op4_line_dedup"](spark, SF).select(*names)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_awkward_rows(spark, awkward, nothing):
    got = linededup.dedup_lines(awkward, min_sites=1)
    rows = got.collect()
    assert len(rows) == awkward.count() and set(awkward.columns) <= set(got.columns)
    ones = [r for r in rows if r.doc_id == 1 and r.source == "a"]
    assert len(ones) == 2 and ones[0].text == ones[1].text == prose(1, 60)  # equal rows are one document
    assert all(r.text is None and r.n_lines == 0 for r in rows if r.doc_id == 2)
    assert linededup.dedup_lines(nothing).collect() == []


def test_a_text_of_many_removed_lines(spark):
    many = "\n".join(f"line {k}" for k in range(20_000))
    df = spark.createDataFrame([(1, many, "a"), (2, many, "b"), (3, many + "\nown", "c")], "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    assert got == {1: many, 2: "", 3: "own"}
    assert df.where(F.col("doc_id") > 3).count() == 0
