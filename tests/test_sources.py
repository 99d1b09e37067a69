"""Sources that fail, keyword tables, and elements cut by nesting."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from barloom import session
from barloom.functions.nesting import elements
from barloom.operators import keywords
from barloom.sources import guarded


def _rows(spark, names):
    return spark.createDataFrame([(n,) for n in names], "v string")


def test_one_source_fails_and_the_others_load(spark, tmp_path):
    reason = F.when(F.col("v") == "", "blank")
    spark.createDataFrame([("not parquet",)], "value string").write.text(str(tmp_path / "broken"))
    makers = {
        "good": lambda: _rows(spark, ["a", "", "b"]),
        "missing": lambda: spark.read.parquet(str(tmp_path / "nowhere")),
        "broken": lambda: spark.read.schema("v string").parquet(str(tmp_path / "broken")),
        "late": lambda: _rows(spark, ["c"]).withColumn("v", F.when(F.col("v") == "c", F.raise_error(F.lit("no"))).otherwise(F.col("v"))),
        "empty": lambda: _rows(spark, ["x"]).filter("false"),
    }
    loaded = [guarded.load(spark, n, m, reason) for n, m in makers.items()]
    got = {r["source"]: (r["loaded"], r["rejected"], r["error"]) for r in guarded.report(spark, loaded).collect()}
    assert got["good"] == (2, 1, None) and got["empty"] == (0, 0, None)
    assert got["missing"] == (0, 0, "PATH_NOT_FOUND") and got["broken"][2] and got["late"][2]
    by = {x.name: x for x in loaded}
    assert sorted(r.v for r in by["good"].rows.collect()) == ["a", "b"]
    assert [(r.v, r.reason) for r in by["good"].rejected.collect()] == [("", "blank")]
    assert by["empty"].rows.columns == ["v"] and by["empty"].rows.collect() == []
    assert by["broken"].rows is None


def test_faults_of_the_program_go_on(spark):
    with pytest.raises(ZeroDivisionError):
        guarded.load(spark, "x", lambda: 1 / 0, F.lit(None).cast("string"))


def plain_first(text, listed):
    bare = "".join((text or "").split())
    hits = [(r, k) for k, r in listed if k and r is not None and "".join(k.split()) and "".join(k.split()) in bare]
    return min(hits, default=(None, None))


@pytest.mark.parametrize("most", [50_000, 40])
def test_first_keyword_of_a_table(spark, monkeypatch, most):
    """Against a plain loop: overlapping, nested and repeated keywords, blanks, ties; in one pass and in many."""
    monkeypatch.setattr(keywords, "PASS_KEYWORDS", most)
    r = random.Random(3)
    listed = [("".join(r.choice("abc ") for _ in range(r.randrange(1, 7))), r.randrange(200)) for _ in range(400)]
    listed += [("", 0), ("  ", 0), (None, 0), ("abc", None), ("買い 増し", 1), ("増し", 0), ("a.b", 2)]
    texts = ["".join(r.choice("abcd ") for _ in range(r.randrange(30))) for _ in range(300)] + [None, "", "買い増 し", "a. b", "xaxbx"]
    rows = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "id int, title string, rank int")
    table = spark.createDataFrame(listed, "keyword string, rank int")
    got = keywords.first_listed(rows, table)
    assert got.columns == ["id", "title", "rank", "keyword", "keyword_rank"]
    bare = [(k, x) for k, x in listed if k]
    for x in got.collect():
        rank, word = plain_first(x.title, bare)
        assert x.keyword_rank == rank
        assert (x.keyword is None) == (word is None) and (word is None or "".join(x.keyword.split()) in "".join(x.title.split()))
    assert [x.keyword for x in keywords.first_listed(rows, table.limit(0)).collect()] == [None] * len(texts)


def test_keyword_passes_do_not_add_copies_of_the_texts(spark, monkeypatch, tmp_path):
    """Twenty passes over texts of which half hold no keyword take less disk than five copies of the texts, and find the smallest rank."""
    monkeypatch.setattr(keywords, "PASS_KEYWORDS", 10)
    made = itertools.count()
    for module in (session, keywords):
        monkeypatch.setattr(module, "shared_dir", lambda _, purpose: str(tmp_path / f"{purpose}-{next(made)}"), raising=False)
    r = random.Random(5)
    texts = ["".join(chr(r.randrange(0x4E00, 0x9E00)) for _ in range(500)) + ("" if k % 2 else f" zz{k % 200:03d} zz{k % 150:03d}") for k in range(600)]
    rows = spark.createDataFrame(list(enumerate(texts + texts[:3])), "id int, title string")
    table = spark.createDataFrame([(f"z z{k:03d}", 1000 - k) for k in range(200)], "keyword string, rank int")
    got = {x.id: x.keyword_rank for x in keywords.first_listed(rows, table).collect()}
    want = [None if k % 2 else 1000 - max(k % 200, k % 150) for k in range(600)]
    assert [got[k] for k in range(603)] == want + want[:3]
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 5 * sum(len(t.encode()) for t in texts)


PAGES = {
    "<li class='a'>1</li><li class=\"b a\">2<ul><li>x</li></ul>3</li>": ["<li class='a'>1</li>", '<li class="b a">2<ul><li>x</li></ul>3</li>'],
    "<LI CLASS=a>1<li class=a>2</LI>3</li>\n<li class='ab'>no</li>": ["<LI CLASS=a>1<li class=a>2</LI>3</li>"],
    "<!-- <li class=a> --><script>'<li class=a>'</script><p title='</li>'>t</p>": [],
    "\n<p>\n<li class=a t='</li>'>1<!-- </li> -->2</li\n>3": ["<li class=a t='</li>'>1<!-- </li> -->2</li\n>"],
    "<li class=a>never <li>closed</li>": ["<li class=a>never <li>closed</li>"],
    "</li></li><li class='a'/><li class=a>1</li>": ["<li class='a'/>", "<li class=a>1</li>"],
    "": [],
}


def test_elements_by_nesting(spark):
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(PAGES)] + [(99, None)], "id int, html string")
    got = {r.id: r.e for r in rows.select("id", elements(F.col("html"), "li", "a").alias("e")).collect()}
    assert got[99] is None
    assert [got[k] for k in range(len(PAGES))] == list(PAGES.values())
    inner = rows.filter("id = 0").select(elements(F.col("html"), "li", "a", outer=False).alias("e")).first().e
    assert inner == ["1", "2<ul><li>x</li></ul>3"]
