"""Document queries on nested, null, missing, malformed and repeated values."""

import json

import pytest
from pyspark.sql import functions as F

from lakestead.functions import documents as docs
from lakestead.functions import paths
from lakestead.sources import adapters

DOC = '{"a":1,"b":null,"n":{"x":[1,2]},"s":"1","t":true}'


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(1, DOC), (2, "{}"), (3, '{"a":"1"}'), (4, '{"a":'), (5, '{"a":1,"a":2}'), (6, None)]
    return spark.createDataFrame(rows, "raw_id long, data string")


def values(frame, expression):
    return [r[0] for r in frame.orderBy("raw_id").select(expression).collect()]


def test_key_exists_counts_null_values(frame):
    assert values(frame, docs.has_key(F.col("data"), "b")) == [True] + [False] * 5


def test_path_exists(frame):
    assert values(frame, docs.path_exists(F.col("data"), "$.b"))[:2] == [True, False]
    assert values(frame, docs.path_exists(F.col("data"), "$.n.x[1]"))[0] is True
    assert values(frame, docs.path_exists(F.col("data"), "$.n.x[2]"))[0] is False


@pytest.mark.parametrize(
    ("pattern", "expected"),
    [
        ({}, True),
        ({"a": 1}, True),
        ({"a": 1.0}, True),
        ({"a": "1"}, False),
        ({"s": "1"}, True),
        ({"s": 1}, False),
        ({"b": None}, True),
        ({"c": None}, False),
        ({"t": True}, True),
        ({"t": False}, False),
        ({"n": {"x": [2]}}, True),
        ({"n": {"x": [2, 1, 2]}}, True),
        ({"n": {"x": [3]}}, False),
        ({"n": {}}, True),
        ({"n": {"x": []}}, True),
        ({"a": {}}, False),
    ],
)
def test_contains(frame, pattern, expected):
    assert values(frame, docs.contains(F.col("data"), pattern))[0] is expected


def test_contains_is_false_for_unreadable_documents(frame):
    assert values(frame, docs.contains(F.col("data"), {"a": 1})) == [True] + [False] * 5


def test_merge_keeps_types_and_right_side_wins(frame):
    merged = values(frame, docs.merge(F.col("data"), {"a": {"k": [1]}, "new": None}))
    assert json.loads(merged[0]) == {**json.loads(DOC), "a": {"k": [1]}, "new": None}
    assert json.loads(merged[1]) == {"a": {"k": [1]}, "new": None}
    assert merged[3] == '{"a":' and merged[5] is None


def test_set_field_without_creating(frame):
    kept = values(frame, docs.set_field(F.col("data"), "b", "x", create_missing=False))
    assert json.loads(kept[0])["b"] == "x" and kept[1] == "{}"


def test_each_text_and_keys(frame):
    pairs = {tuple(r) for r in docs.each_text(frame.filter("raw_id = 1"), "data", ["raw_id"]).collect()}
    assert pairs == {
        (1, "a", "1"),
        (1, "b", None),
        (1, "n", '{"x":[1,2]}'),
        (1, "s", "1"),
        (1, "t", "true"),
    }
    assert {r[0] for r in docs.distinct_keys(frame, "data").collect()} == set("abnst")


def test_null_or_empty(frame):
    assert values(frame, docs.is_null_or_empty(F.col("data"))) == [False, True, False, False, False, True]


def test_sub_document_and_pretty(frame):
    assert values(frame, docs.sub_document(F.col("data"), "$.n"))[0] == '{"x":[1,2]}'
    text = values(frame, docs.pretty(F.col("data")))[0]
    assert json.loads(text) == json.loads(DOC) and len(text.split("\n")) == 12


def test_repeated_and_quoted_keys_and_search_of_wildcards(spark, rows):
    df = spark.createDataFrame(
        [(1, '{"a":"1","b":null,"a":"2","o\'k":"v"}'), (2, '{"x":"50%_off\\\\"}'), (3, "{}"), (4, None)], "id long, d string"
    )
    got = rows(docs.each_text(df, "d", ["id"]))
    assert got == sorted([(1, "a", "2"), (1, "b", None), (1, "o'k", "v"), (2, "x", "50%_off\\")], key=repr)
    assert rows(df.select("id", docs.field_text(F.col("d"), "o'k")))[0] == (1, "v")
    for text, found in (("50%_OFF", [(2,)]), ("5__", []), ("%", [(2,)]), ("_", [(2,)]), ("A", [(1,)])):
        assert rows(df.filter(docs.search(F.col("d"), text)), "id") == found, text


# ---- paths, pretty print, names with quotes --------------------------------------------------
NESTED = (
    '{"a":1,"b":{"c":[1,{"x":"q{,\\"z","a":5}],"d":{},"e":[]},"it\'s":{"a":"7"},"t":["u","v"],"n":null,'
    '"say \\"hi\\"":[true]}'
)


def one_column(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "d string")


@pytest.mark.parametrize(
    ("path", "want"),
    [
        ("$", 1),
        ("$.a", ["1"]),
        ("$.nothing", []),
        ("$.b.c[*]", ["1", '{"a":5,"x":"q{,\\"z"}']),
        ("$.b.c[1].a", ["5"]),
        ("$.b.c.a", ["5"]),
        ("$..a", ["1", '"7"', "5"]),
        ('$."it\'s".a', ['"7"']),
        ('$."say \\"hi\\""[*]', ["true"]),
        ('$.t[*] ? (@ == "u")', ['"u"']),
        ('$.t ? (@ != "u")', ['"v"']),
        ('$.t ? (!(@ starts with "u"))', ['"v"']),
        ("$.n ? (@ == null)", ["null"]),
        ("$.a[0]", ["1"]),
        ("$.a[1]", []),
        ("$.a[*]", ["1"]),
        ("$ ? (@.a == @.b.c[0]).t[1]", ['"v"']),
        ("$ ? (@.a > 1 || exists(@.n)).a", ["1"]),
        ('$ ? (@.a >= 1 && @.t == "w").a', []),
        ('$ ? (@.a == "1").a', []),
    ],
)
def test_paths(spark, path, want):
    found = one_column(spark, [NESTED]).select(paths.query_text(F.col("d"), path).alias("r")).first().r
    assert len(found) == want if isinstance(want, int) else found == want


def test_paths_without_a_document(spark):
    df = one_column(spark, [None, "bad", "{}", "[1, 2]", '"s"'])
    assert [r[0] for r in df.select(paths.query_text(F.col("d"), "$[*]")).collect()] == [[], [], ["{}"], ["1", "2"], ['"s"']]
    assert [r[0] for r in df.select(paths.exists(F.col("d"), "$.*")).collect()] == [False] * 5


@pytest.mark.parametrize("path", ["", "a", "$.", "$[x]", "$ ? (@ = 1)", "$ ? (@ == )", "$.a $", "$ ? (@ == 1", '$."a'])
def test_paths_that_cannot_be_read(path):
    with pytest.raises(ValueError, match="cannot be read"):
        paths._Compiler(path).compile()


def test_a_descent_has_a_limit(spark):
    for depth, fails in ((paths.DEEPEST, False), (paths.DEEPEST + 2, True)):
        text = '{"k":' * depth + "1" + "}" * depth
        df = one_column(spark, [text]).select(F.size(paths.query(F.col("d"), "$..k")))
        if fails:
            with pytest.raises(Exception, match="deeper than"):
                df.collect()
        else:
            assert df.first()[0] == depth


def test_pretty_text_is_the_same_document(spark):
    deep = {"a": [1, [2, {"b": []}], {}], "s": 'x",{[:\\', "e": {"f": None, "g": [True, -1.5e3]}, "": "é"}
    texts = [json.dumps(deep), json.dumps(deep, indent=1), "[]", "7", '"s"', "{}", json.dumps({f"k{i}": [i] * 9 for i in range(300)})]
    got = [r[0] for r in one_column(spark, [*texts, "bad", None]).select(docs.pretty(F.col("d"))).collect()]
    assert got[-2:] == [None, None]
    for text, pretty in zip(texts, got, strict=False):
        want = json.dumps(json.loads(text), indent=4).replace("-1500.0", "-1.5e3" if "-1.5e3" in text else "-1500.0")
        assert json.loads(pretty) == json.loads(text)
        assert len(pretty.split("\n")) == len(want.split("\n"))


def test_containment_with_quotes_in_a_name(spark):
    df = one_column(spark, [NESTED, "{}"])
    for pattern in ({"it's": {"a": "7"}}, {'say "hi"': [True]}):
        assert [r[0] for r in df.select(docs.contains(F.col("d"), pattern)).collect()] == [True, False]
    both = one_column(spark, ['{"a\'b\\"c":1}'])
    assert both.select(docs.contains(F.col("d"), {"a'b\"c": 1})).first()[0]


# ---- work per document ----------------------------------------------------------------------
def test_documents_are_dealt_and_tokens_cut_once(spark):
    documents = adapters.customer_documents(spark, "/root/testdata/sf0.001")
    assert documents.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    plan = documents.select(docs.pretty(F.col("data")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
