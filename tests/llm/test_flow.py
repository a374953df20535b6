"""WARC archives, mixing, packing and the pipeline against brute force and round trips."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestead.llm import queries
from lakestead.llm.common import table, tune
from lakestead.llm.mixing import Mix, mix_sources
from lakestead.llm.packing import Packing, best_fit_packing, pack
from lakestead.llm.warc import Archive, read_records, write_archives
from lakestead.session import scratch_dir

from .test_dedup import brute_components, fold
from .test_models import brute_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.001"


def page_rows():
    odd = "head\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1\r\nWARC/1.1\r\n"
    rows = [(1, None), (2, ""), (3, "WARC/1.1\r\n"), (4, odd), (5, odd * 30), (6, "\r\n\r\n"), (7, "é" * 999)]
    rows += [(8, "x" * 1000), (9, "x" * 1000), (10, "x" * 1000), (11, "y" * 999), (12, "y" * 999)]
    rows += [(13, "漢\U0001f600" * 5000), (14, odd * 30), (None, "z" * 2000), (15, "z" * 2000)]
    return rows


@pytest.mark.parametrize("chunk", [1 << 16, 700, 3])
def test_warc_round_trip(spark, chunk):
    tune(spark)
    rows = page_rows()
    pages = spark.createDataFrame(
        [(i, f"http://a b\r\nWARC-Type: {i}", h, "c") for i, h in rows], "page_id long, url string, html string, row string"
    )
    path = scratch_dir(spark, "archives")
    write_archives(pages.repartition(3), path, rules=Archive(chunk=chunk))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = read_records(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    largest = {}
    for i, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), i if i is not None else -1)
    want = []
    for i, h in rows:
        data = (h or "").encode()
        keeper = largest[h or ""] if len(data) >= 1000 else i
        again = keeper != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None, True))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_warc_repeated_rows_and_no_rows(spark):
    tune(spark)
    pages = spark.createDataFrame([(1, None, "a" * 5000)] * 2 + [(2, "u", "b")], "page_id long, url string, html string")
    for given, n in ((pages, 3), (pages.limit(0), 0)):
        path = scratch_dir(spark, "archives")
        write_archives(given, path, rules=Archive(chunk=999))
        got = read_records(spark, path).collect()
        assert len(got) == n and all(r.intact and r.payload_bytes in (5000, 1) for r in got)


def test_every_reference_names_one_record(spark):
    """As another reader sees the files: by record ids alone, with one profile per revisit."""
    tune(spark)
    rows = page_rows() + [(20, "q" * 3000), (20, "q" * 3000), (19, "q" * 3000), (20, "r" * 2000), (21, "r" * 2000)]
    pages = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    path = scratch_dir(spark, "archives")
    write_archives(pages.repartition(4), path, rules=Archive(chunk=500))
    text = "".join(bytes(r.content).decode() for r in spark.read.format("binaryFile").load(path).collect())
    heads = [h for h in re.findall(r"WARC/1\.1\r\n((?:[A-Z][A-Za-z-]*: [^\r\n]*\r\n)+)\r\n", text)]
    records = [dict(line.split(": ", 1) for line in h.strip().split("\r\n")) for h in heads]
    records = [r for r in records if "WARC-Record-ID" in r]
    ids = Counter(r["WARC-Record-ID"] for r in records)
    assert set(ids.values()) == {1}
    by_id = {r["WARC-Record-ID"]: r for r in records}
    revisits = [r for r in records if r["WARC-Type"] == "revisit"]
    assert len(revisits) == 6
    for r in revisits:
        target = by_id[r["WARC-Refers-To"]]
        assert target["WARC-Type"] == "response"
        assert target["WARC-Payload-Digest"] == r["WARC-Payload-Digest"]
        assert r["WARC-Profile"].endswith("identical-payload-digest") and r["Content-Length"] == "0"
    for r in records:
        if r["WARC-Type"] == "continuation":
            assert r["WARC-Segment-Origin-ID"] in by_id


def brute_mix(rows, mix):
    """rows: (id, path, n). Water filling by repeated rounds, then prefixes in MD5 order."""
    tokens = Counter()
    for _, path, n in rows:
        tokens[path] += n
    weight = lambda node: mix.weights[len(node) - 1].get(node[-1], 1)
    have = {p: t * mix.max_epochs * all(weight(p[: k + 1]) for k in range(len(p))) for p, t in tokens.items()}
    budget = {(): sum(tokens.values()) * mix.percent // 100}
    for depth in range(len(mix.weights)):
        families = defaultdict(Counter)
        for p, a in have.items():
            families[p[:depth]][p[: depth + 1]] += a
        for family, nodes in families.items():
            left, open_nodes, short = budget[family], set(nodes), {}
            while True:
                total = sum(weight(n) for n in open_nodes)
                full = {n for n in open_nodes if nodes[n] * total <= left * weight(n)}
                if not full:
                    break
                # One short node at a time, the shortest first.
                n = min(full, key=lambda x: (nodes[x] / weight(x) if weight(x) else 0, x))
                open_nodes.remove(n)
                short[n] = nodes[n]
                left -= nodes[n]
            total = sum(weight(n) for n in open_nodes)
            budget |= short | {n: left * weight(n) // total if total else 0 for n in open_nodes}
    out = Counter()
    for path, t in tokens.items():
        whole, rest = divmod(budget[path], max(t, 1))
        key = lambda i, whole=whole: hashlib.md5(f"{mix.seed}|{whole}|{i}".encode()).hexdigest()
        upto = 0
        for i, _, n in sorted((r for r in rows if r[1] == path), key=lambda r: key(r[0])):
            upto += n
            for e in range(whole + (rest > 0 and upto <= rest)):
                out[(i, e)] += 1
    return out


@pytest.mark.parametrize(
    "mix",
    [
        Mix(({}, {}, {}), 60, 2, "s"),
        Mix(({"d1": 5}, {"l0": 0, "l1": 3}, {"s3": 9}), 90, 3, "t"),
        Mix(({"d0": 0, "d1": 0, "d2": 0}, {}, {}), 50, 2),
        Mix(({}, {}, {}), 500, 2),
        Mix(({"d2": 7}, {"l1": 2}, {}), 0, 2),
    ],
)
def test_mixing(spark, mix):
    tune(spark)
    r = random.Random(4)
    rows = []
    for i in range(400):
        hot = r.random() < 0.4
        path = ("d0", "l1", "s0") if hot else (f"d{r.randrange(3)}", f"l{r.randrange(2)}", f"s{r.randrange(5)}")
        rows.append((i, path, r.choice([0, 1, 5, 40, 300])))
    docs = spark.createDataFrame(
        [(i, " ".join("w" * 1 for _ in range(n)) or None, *p, 7, "n") for i, p, n in rows],
        "doc_id long, text string, a string, b string, c string, node0 int, whole string",
    )
    levels = {"x": F.col("a"), "y": F.col("b"), "z": F.col("c")}
    got = mix_sources(docs, levels, mix).collect()
    assert Counter((x.doc_id, x.epoch) for x in got) == brute_mix(rows, mix)
    assert all(x.n_tokens == len(WORD.findall(x.text or "")) and x.node0 == 7 for x in got)


def test_mixing_odd_cases(spark):
    tune(spark)
    docs = spark.createDataFrame(
        [(None, "a b", None, "l"), (1, "a b", "d", None), (1, "a b", "d", None), (2, None, None, None)],
        "doc_id long, text string, a string, b string",
    )
    levels = {"x": F.col("a"), "y": F.col("b")}
    got = mix_sources(docs, levels, Mix(({}, {}), 200, 2)).collect()
    assert Counter((x.doc_id, x.epoch) for x in got) == {(None, 0): 1, (None, 1): 1, (1, 0): 2, (1, 1): 2}
    assert mix_sources(docs.limit(0), levels, Mix(({}, {}))).count() == 0


def check_packing(got, tokens, rules):
    """Every token of every row in one place; no bin over its capacity, or in a larger one than it needs."""
    bins = defaultdict(list)
    spans = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
        spans[r.doc_id].append((r.start, r.n_tokens))
    for i, s in spans.items():
        end = Counter()
        for start, n in s:
            end[start] += 1
            end[start + n] -= 1
        assert all(v == 0 for k, v in end.items() if k not in (0, tokens[i][0])) and end[0] == tokens[i][1]
        assert sum(n for _, n in s) == tokens[i][0] * tokens[i][1]
    assert set(spans) == set(tokens)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.bin_offset):
            assert r.bin_offset == at and r.n_tokens > 0
            at += r.n_tokens
        assert {r.bin_capacity for r in rows} == {min(c for c in rules.capacities if c >= at)}
    return sum(r.n_tokens for r in got) / sum(rows[0].bin_capacity for rows in bins.values())


@pytest.mark.parametrize("rules", [Packing(), Packing((64, 16, 40), 2, 50)])
def test_packing(spark, rules):
    tune(spark)
    r = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(int(r.expovariate(1 / 150))))) for i in range(500)]
    rows += [(600, None), (601, ""), (602, "w " * 9001), (603, "w " * 4095), (603, "w " * 4095)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, bin_id int")
    copies = Counter(i for i, _ in rows)
    tokens = {i: (len(WORD.findall(t or "")) + 1, copies[i]) for i, t in rows}
    got = best_fit_packing(docs, rules=rules).collect()
    assert check_packing(got, tokens, rules) > 0.9
    assert sorted(got) == sorted(best_fit_packing(docs.repartition(5), rules=rules).collect())
    assert best_fit_packing(docs.limit(0), rules=rules).count() == 0


def plain_pack(lengths, rules):
    """The same packing with lists that are searched from end to end."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins, place = [], {}

    def trial(first, rest, capacity):
        used = first
        for n in rest:
            if used + n <= capacity:
                used += n
        return used

    for k, i in enumerate(order):
        n = lengths[i]
        fitting = [b for b in bins if b["cap"] - b["used"] >= n]
        if fitting:
            best = min(fitting, key=lambda b: (b["cap"] - b["used"], b["no"]))
        else:
            rest = [lengths[j] for j in order[k + 1 :]]
            able = [c for c in rules.capacities if c >= n]
            cap = min(able, key=lambda c: ((c + rules.overhead) / trial(n, rest, c), -c))
            best = {"no": len(bins), "cap": cap, "used": 0}
            bins.append(best)
        place[i] = best["no"], best["used"]
        best["used"] += n
    sizes = [min(c for c in rules.capacities if c >= b["used"]) for b in bins]
    return [place[i][0] for i in range(len(lengths))], [place[i][1] for i in range(len(lengths))], sizes


@pytest.mark.parametrize("seed", range(6))
def test_packing_equals_plain_lists(seed):
    r = random.Random(seed)
    rules = r.choice([Packing(), Packing((16, 40, 64), 3), Packing((10,), 0), Packing((8, 9, 30), 20)])
    top = max(rules.capacities)
    for n in (0, 1, 5, 60, 250):
        lengths = [min(top, 1 + int(r.expovariate(1 / (top / r.choice([2, 5, 20]))))) for _ in range(n)]
        assert pack(lengths, rules) == plain_pack(lengths, rules)


def test_packing_opens_the_least_cost_and_downsizes():
    # 68 for 60 tokens in one bin, against 24 for 20 in each of three.
    bins, offsets, capacities = pack([10] * 6, Packing((16, 20, 64), 4))
    assert capacities == [64] and sorted(offsets) == [0, 10, 20, 30, 40, 50]
    # 24 for 20 tokens in each of two, against 68 for 40.
    assert pack([10] * 4, Packing((16, 20, 64), 4))[2] == [20, 20]
    assert pack([20, 20], Packing((16, 20, 64), 1))[2] == [20, 20]
    assert pack([5], Packing((16, 20, 64), 1))[2] == [16]
    assert pack([], Packing())[2] == []


def test_pipeline_stages(spark):
    """Each stage on the output of the one before, by brute force."""
    tune(spark)
    docs = table(spark, DATA, "documents")
    extra = docs.select("*", F.lit(1).alias("kept"), F.lit("x").alias("key"), F.lit(2.0).alias("n_tokens"))
    trusted = {r.doc_id for r in queries.trusted_ids(spark, DATA).collect()}
    rows = {r.doc_id: r for r in extra.collect()}
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        extra = stage(spark, extra, DATA)
        assert extra.columns == [*docs.columns, "kept", "key", "n_tokens"]
        out[name] = extra.collect()
        extra = spark.createDataFrame(out[name], extra.schema)
    quality = brute_quality([(i, r.text) for i, r in rows.items()], trusted, queries.quality_rules.Rules())
    assert sorted(out["quality rules"]) == sorted(r for i, r in rows.items() if quality[i][-1])
    key = lambda line: fold(line.strip(" \t\n\x0b\x0c\r"))
    before = out["quality rules"]
    found = Counter(k for r in before for k in {key(x) for x in r.text.split("\n")} if k)
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if found[key(x)] < 10 or not key(x)) for r in before}
    assert {r.doc_id: r.text for r in out["line dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in out["line dedup"])
    groups = brute_components([(r.doc_id, r.text) for r in out["line dedup"]], 80)
    assert sorted(out["near dedup"]) == sorted(r for r in out["line dedup"] if groups[r.doc_id][2])
    path = lambda r: (f"d{int(r.source[3:]) % 4}", r.lang, r.source)
    sized = [(r.doc_id, path(r), len(WORD.findall(r.text))) for r in out["near dedup"]]
    want = Counter(i for i, e in brute_mix(sized, queries.MIX).elements())
    assert Counter(r.doc_id for r in out["mixing"]) == want
    tokens = {r.doc_id: (len(WORD.findall(r.text)) + 1, want[r.doc_id]) for r in out["mixing"]}
    packed = corpus_pipeline.STAGES[-1][1](spark, extra, DATA).collect()
    check_packing(packed, tokens, Packing())
    assert sorted(corpus_pipeline.run(spark, DATA).collect()) == sorted(packed)


def test_pipeline_without_documents(spark):
    docs = table(spark, DATA, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0
