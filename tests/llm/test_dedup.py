"""Line, exact, near and substring dedup against brute force, with the odd cases of each."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakestead.llm.common import tune
from lakestead.llm.exact_dedup import exact_dedup
from lakestead.llm.line_dedup import line_dedup
from lakestead.llm import near_dedup as nd
from lakestead.llm.near_dedup import Near, components, near_dedup
from lakestead.llm.substring_dedup import Repeats, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, id string, h1 int, key string, kept int, sha string, n_lines int, pos string"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def corpus(seed=5, n=120):
    """Texts of shared lines, copies, near copies and shared passages; ids are unique."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Élan", "ÀB", "x\x1fy", " ", "ÑU"]
    words = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passage = words(60)
    common = ["Share this", "  share THIS\t", "All rights reserved."]
    base = words(90)
    texts = [None, "", " ", "\n", "\n\n", "a", "A", "one two", "ONE two", "one\ttwo", " ".join(words(9000))]
    while len(texts) < n:
        kind = r.randrange(6)
        own = words(r.randrange(1, 120))
        if kind == 0:
            own = own[:10] + passage[r.randrange(20) :] + own[10:]
        if kind == 1:
            own = list(base)
            for _ in range(r.randrange(4)):
                own[r.randrange(len(own))] = "edit"
        text = " ".join(own)
        if kind == 2:
            text += "\n" + r.choice(common) + "\n" + " ".join(words(5)) + "\r"
        if kind == 3 and texts[-1]:
            text = r.choice([texts[-1], texts[-1].upper(), texts[-1] + " tail"])
        texts.append(text)
    r.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    tune(spark)
    return spark.createDataFrame([(i, t, "x", 1, None, 0, "s", 9, "p") for i, t in rows], SCHEMA)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_line_dedup(spark):
    rows = corpus()
    got = line_dedup(frame(spark, rows), min_docs=4)
    assert got.columns == [c for c in SCHEMA.replace(",", "").split()[::2] if c != "n_lines"] + ["n_lines", "n_dropped"]
    key = lambda line: fold(line.strip(SPACE))
    found = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    want = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (key(x) and found[key(x)] >= 4)]
        want[i] = ("\n".join(stay), len(lines), len(lines) - len(stay))
    assert any(w[2] for w in want.values())
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got.collect()} == want


def test_line_dedup_counts_documents_not_rows(spark):
    """Ten rows of an id are one document, and all rows without one are another."""
    rows = [(None, "x\ny"), (None, "x\nz")] + [(1, "X \n1")] * 10 + [(2, "x\nX\n2")]
    texts = lambda least: sorted(
        (r.doc_id or 0, r.text, r.n_dropped) for r in line_dedup(frame(spark, rows), min_docs=least).collect()
    )
    assert texts(4) == sorted((i or 0, t, 0) for i, t in rows)
    assert texts(3) == [(0, "y", 1), (0, "z", 1)] + [(1, "1", 1)] * 10 + [(2, "2", 2)]


def test_line_dedup_replaces_its_columns_in_any_spelling(spark):
    df = spark.createDataFrame([(1, "a", 5, 6)], "doc_id long, text string, N_lines int, n_DROPPED int")
    got = line_dedup(df)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"] and tuple(got.first()) == (1, "a", 1, 0)


@pytest.mark.parametrize("max_bits", [1 << 30, 1])
def test_exact_dedup(spark, max_bits):
    """The same result with a filter that is far too small."""
    rows = corpus()
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t or "")].append(i)
    want = {
        i: (max(groups[fold(t or "")]), len(groups[fold(t or "")]), i == max(groups[fold(t or "")]), digest(fold(t or "")))
        for i, t in rows
    }
    got = exact_dedup(frame(spark, rows + rows[:9]), max_bits=max_bits).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.sha.hex()) for r in got} == want
    odd = exact_dedup(frame(spark, [(None, "q"), (4, "Q"), (None, None)])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in odd} == {(None, 4, False), (4, 4, True), (None, None, True)}


def shingles(text, k=5):
    w = WORD.findall(fold(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def brute_components(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize(("near", "seed"), [(Near(percent=85), 5), (Near(percent=80, bands=32, rows=4, block=4), 8)])
def test_near_dedup(spark, near, seed):
    rows = corpus(seed, 150)
    got = near_dedup(frame(spark, rows), near=near).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(rows, near.percent)


def test_near_dedup_finds_links_that_no_leader_has(spark):
    """A chain of edits: neighbours are alike, the ends are not; small blocks."""
    r = random.Random(3)
    rows, text = [], [f"t{i}" for i in range(100)]
    for i in range(60):
        rows.append((r.randrange(10**6) * 100 + i, " ".join(text)))
        text[r.randrange(100)] = f"new{i}"
    for near in (Near(percent=85), Near(percent=85, block=3), Near(percent=85, block=3, spread=1)):
        got = near_dedup(frame(spark, rows), near=near).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(rows, 85)


def template_rows(n, seed=9):
    """Documents of one template, few of them linked."""
    r = random.Random(seed)
    template = [f"t{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = list(template)
        for _ in range(r.randrange(5, 14)):
            words[r.randrange(150)] = f"v{r.randrange(n * 4)}"
        out.append((i, " ".join(words)))
    return out


def test_near_dedup_of_one_template(spark, monkeypatch):
    """The work on open buckets grows with their members, and the result is that of all pairs."""
    units = []
    given = nd.open_units
    monkeypatch.setattr(nd, "open_units", lambda *a: units.append(given(*a)) or units[-1])
    for n in (150, 300):
        rows = template_rows(n)
        got = near_dedup(frame(spark, rows), near=Near(percent=85, block=4, spread=2)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(rows, 85)
    # Large buckets are dealt by rare shingles, where each member would have been sent once per block.
    assert all(u.filter("kind = 1").count() > 0 for u in units)
    assert [u.count() < 6 * n for u, n in zip(units, (150, 300), strict=True)] == [True, True]


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_token_of_their_prefixes(percent):
    r = np.random.default_rng(percent)
    rarity = r.integers(0, 5, 1 << nd.RARITY_BITS).astype(np.int32)
    for _ in range(300):
        n = int(r.integers(1, 60))
        x = np.unique(r.integers(0, 1 << 32, n).astype(np.uint32))
        y = x[r.random(len(x)) < 0.95]
        y = np.unique(np.append(y, r.integers(0, 1 << 32, int(r.integers(0, 5))).astype(np.uint32)))
        common = len(np.intersect1d(x, y))
        if len(y) and 100 * common >= percent * (len(x) + len(y) - common):
            prefixes = [set(nd.prefix(s, rarity, percent).tolist()) for s in (x, y)]
            assert prefixes[0] & prefixes[1]


def test_near_dedup_null_and_repeated_ids(spark):
    got = near_dedup(frame(spark, [(None, "a b"), (3, "a b"), (3, "a b"), (5, "a b"), (7, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 1, 0, True), (3, 1, 3, True), (3, 1, 3, True), (5, 1, 3, False), (7, 0, 7, True),
    ]


def test_components_of_a_long_path(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (200, 200)]
    got = rows(components(spark.createDataFrame(edges, "a long, b long")))
    assert got == sorted([(i, 0) for i in range(41)] + [(90, 90), (95, 90), (100, 90)], key=repr)


def brute_substrings(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    places = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - width + 1):
            if places[tuple(w[k : k + width])] > 1:
                gone |= set(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, kept, len(w), len(gone), digest(kept)))
    return out


@pytest.mark.parametrize(("rules", "seed"), [(Repeats(), 5), (Repeats(width=12, seed=4, max_bits=1), 6), (Repeats(width=3, seed=2), 7)])
def test_substring_dedup(spark, rules, seed):
    rows = corpus(seed, 150)
    rows += [(1000, "a b " * 80), (1001, "z " * 50), (1002, rows[7][1])]
    got = substring_dedup(frame(spark, rows), rules=rules).collect()
    want = brute_substrings(rows, rules.width)
    assert sum(w[3] for w in want) > 0
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_substring_dedup_of_repeated_rows(spark):
    text = " ".join(f"v{i}" for i in range(40))
    got = substring_dedup(frame(spark, [(None, text), (None, text), (2, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 40, 40), (0, 40, 40), (2, 0, 0)]


def test_empty_tables(spark):
    empty = frame(spark, [])
    for operator in (line_dedup, exact_dedup, near_dedup, substring_dedup):
        assert operator(empty).count() == 0
