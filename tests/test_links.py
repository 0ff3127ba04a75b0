"""Link scans, names within links and merged coverage against plain forms."""

import random
from datetime import date
from html.parser import HTMLParser

from pyspark.sql import functions as F

from recordlake.operators import coverage
from recordlake.sources import links


class Plain(HTMLParser):
    def __init__(self, html):
        super().__init__()
        self.found = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        href = next((v for k, v in attrs if k == "href"), None)
        if tag == "a" and "href" in dict(attrs):
            self.found.append(href or "")


def test_links_are_those_of_a_parser():
    """Quotes of all kinds, references, upper case, attributes before and after, comments, scripts, anchors that are not closed."""
    rng = random.Random(3)
    values = ['"/a.zip"', "'/b?x=1&amp;y=2'", "/c.zip", '"/d\'s"', "''", '"/e > f"']
    for _ in range(400):
        html = "".join(
            rng.choice([
                "text ", "<p>", "<br/>", "<!-- <a href=/no> -->", "<script>var a = '<a href=/no>';</script>", "<a name=x>", "</a>",
                f"<{rng.choice('aA')} {rng.choice(['class=k ', '', 'data-href=/no '])}{rng.choice(['href', 'HREF'])}{rng.choice(['=', ' = '])}{rng.choice(values)}{rng.choice(['', ' target=_new'])}>", "<b title='<a href=/no>'>",
            ])
            for _ in range(12)
        )
        assert [h for h, _ in links.scanned_links(html)] == Plain(html).found, html


def test_texts_of_links(spark):
    pages = spark.createDataFrame([(1, "<a href=x>a <b>b</b>&amp;\n c</a><a href=y>open<p><a href='z'>last", "k"), (2, None, "k"), (3, "", "k"), (4, "<a href=\"x", "k")], "page_id long, html string, link_no string")
    got = links.parsed_links(pages.drop("link_no")).orderBy("page_id", "link_no").collect()
    assert [tuple(r) for r in got] == [(1, 0, "x", "a b& c"), (1, 1, "y", "open"), (1, 2, "z", "last")]
    part = "<a href='" * 20_000
    assert list(links.scanned_links(part)) is not None  # in linear time


def test_names_within_links(spark):
    """Short and long names, names in names, the same run in many names; no link meets all names."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    names = sorted({word(rng.choice([1, 2, 5, 7, 8, 9, 12, 14])) for _ in range(60)}) + ["é" * 9, ""]
    hrefs = sorted({word(rng.choice([0, 3, 10, 30, 60])) for _ in range(60)}) + ["x" + "é" * 9 + "y"]
    a, b = spark.createDataFrame([(n,) for n in names] + [(names[0],)], "file_name string"), spark.createDataFrame([(h,) for h in hrefs] + [(None,)], "href string")
    got = coverage.contained_names(a, b)
    assert sorted(tuple(r) for r in got.collect()) == sorted((n, h) for n in names for h in hrefs if n and n in h)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert coverage.missing_files(a, b, within=True).count() == len([n for n in names + [names[0]] if not n or not any(n in h for h in hrefs)])


def test_runs_of_links_are_never_broadcast(spark):
    """Links look small before they are cut into runs; names are what is sent, or both sides are shuffled."""
    rng = random.Random(6)
    names = spark.createDataFrame([(f"f{k}_{k % 7}.zip",) for k in range(3000)] + [("f1",), ("f22_",)], "file_name string")
    hrefs = spark.createDataFrame([(f"/get?f=f{rng.randrange(4000)}_{k % 7}.zip&v={k}",) for k in range(2000)], "href string")
    want = None
    for options in ({}, {"few": 10}):
        got = coverage.contained_names(names.repartition(3), hrefs.repartition(3), **options)
        rows = sorted(tuple(r) for r in got.collect())
        assert rows and rows == (want or rows)
        want = rows
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "BuildLeft" in x and "run#" in x]
        assert not options or "SortMergeJoin" in plan


def test_sets_merge_in_any_order(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(120):
        a = date(2010 + rng.randrange(8), 1 + rng.randrange(12), 1 + rng.randrange(28))
        b = date(a.year + rng.choice([0, 0, 0, 1]), 1 + rng.randrange(12), 1 + rng.randrange(28))
        rows.append((f"s{rng.randrange(6)}", a, b))
    rows += [("back", date(2020, 5, 1), date(2020, 1, 1)), ("back", date(2020, 1, 1), date(2020, 2, 1)), rows[0]]
    df = spark.createDataFrame(rows, "series string, start date, end date").withColumn("k", F.monotonically_increasing_id() % 5)
    want = sorted(tuple(r) for r in coverage.coverage(df, F.lit("2099-01-01").cast("date")).collect())
    parts = [coverage.interval_sets(df.filter(F.col("k") == k)) for k in (3, 0, 4, 2, 1)]
    left = coverage.merge_sets(coverage.merge_sets(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    both = coverage.merge_sets(left.unionByName(coverage.merge_sets(parts[3].unionByName(parts[4]))))
    assert sorted(tuple(r) for r in coverage.coverage_of(both).collect()) == want
    assert sorted(tuple(r) for r in coverage.coverage_of(coverage.merge_sets(both.unionByName(parts[0]))).collect()) == want  # a part given again
