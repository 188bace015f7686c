import random
from collections import defaultdict

from conftest import rows
from texts import edges, empty, frame

from cartlake.llm import line_dedup
from cartlake.llm.line_dedup import boilerplate_lines, remove_boilerplate


def by_hand(data, least):
    sites = defaultdict(set)
    for _, text, site in data:
        for line in (text or "").split("\n"):
            if line.strip(" ") and site is not None:
                sites[line.strip(" ")].add(site)
    bad = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for i, text, _ in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_random_texts(spark):
    rnd = random.Random(3)
    lines = [f"line {i}" for i in range(30)] + ["", "  ", " line 1 ", "only here"]
    data = [
        (i, "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(9))), rnd.choice([None, *"abcdefghij"]))
        for i in range(80)
    ]
    data += [(99, None, "a"), (100, "line 1", None)]
    for least in (1, 4, 9):
        found = remove_boilerplate(frame(spark, data), min_sites=least)
        assert rows(found, "doc_id", "clean_text", "n_lines", "n_removed") == by_hand(data, least)


def test_spread_around_the_threshold_is_exact(spark):
    """With a coarse sketch only the exact counts can tell 95 sites from 105."""
    data = [(f"h{n}", f"s{i}") for n in range(60, 141, 5) for i in range(n)]
    df = spark.createDataFrame(data, "hash string, site string")
    found = boilerplate_lines(df.unionByName(df), min_sites=100, log_k=8)
    assert rows(found) == sorted((f"h{n}",) for n in range(100, 141, 5))


def test_edges(spark):
    found = remove_boilerplate(edges(spark), min_sites=2)
    assert found.count() == edges(spark).count()
    assert rows(found.where("doc_id = 1"), "clean_text", "n_removed") == [("", 1)]
    assert rows(found.where("doc_id = 3"), "clean_text", "n_lines") == [("", 1)]
    clash = edges(spark).selectExpr("*", "1 AS clean_text", "2 AS hash", "3 AS n_lines")
    assert remove_boilerplate(clash).columns == [*edges(spark).columns, "hash", "clean_text", "n_lines", "n_removed"]
    assert remove_boilerplate(empty(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = remove_boilerplate(edges(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and 0 < line_dedup.MARGIN < 1
