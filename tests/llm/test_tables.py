"""Merkle manifest, SentencePiece and centroid clustering against plain Python, with the odd cases of each."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lakestead.llm import centroids, merkle, sentencepieces
from lakestead.llm.centroids import Clusters, Search
from lakestead.llm.common import tune

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_leaf(row, fields):
    texts = [None if row[f] is None else str(row[f]) for f in fields]
    return H(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def plain_tree(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def plain_siblings(levels, pos, fanout):
    out = []
    for level in levels[:-1]:
        start = pos - pos % fanout
        out += [level[j] for j in range(start, min(start + fanout, len(level))) if j != pos]
        pos //= fanout
    return out


def plain_manifest(rows, fields, fanout):
    """(id, leaf, subroot, root, path) of every row, as sorted tuples."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    first = lambda v: (v is not None, v if v is not None else 0)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        ranked = sorted((first(r["doc_id"]), plain_leaf(r, fields), r["doc_id"]) for r in groups[g])
        trees[g] = ranked, plain_tree([leaf for _, leaf, _ in ranked], fanout)
    top = plain_tree([trees[g][1][-1][0] for g in order], fanout)
    out = []
    for rank, g in enumerate(order):
        ranked, levels = trees[g]
        for pos, (_, leaf, i) in enumerate(ranked):
            path = plain_siblings(levels, pos, fanout) + plain_siblings(top, rank, fanout)
            out.append((i, leaf, levels[-1][0], top[-1][0], "".join(path)))
    return sorted(out, key=repr)


DOCS = "doc_id long, source string, lang string, n_chars long, text string, node int, path string, PART int, pos long"


def docs_frame(spark, rows):
    tune(spark)
    return spark.createDataFrame(
        [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"], 1, "p", 2, 3) for r in rows], DOCS
    ).repartition(5)


def some_docs(n, seed=1):
    r = random.Random(seed)
    langs = [None, "", "de", "en", "Zz", "é"] + ["hot"] * 10
    rows = [
        {
            "doc_id": r.choice([i, i, i, -i, None, 7]),
            "source": r.choice([None, "", "s1", "s:1"]),
            "lang": r.choice(langs),
            "n_chars": r.choice([None, 0, i]),
            "text": r.choice([None, "", "text ä", "x" * r.randrange(50)]),
        }
        for i in range(n)
    ]
    return rows + rows[: n // 10]


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize(("n", "fanout", "levels"), [(0, 2, 8), (1, 2, 8), (2, 2, 1), (150, 2, 2), (400, 3, 2), (300, 5, 1)])
def test_manifest_equals_plain_trees(spark, n, fanout, levels):
    rows = some_docs(n)
    tree = merkle.Tree(fanout, levels)
    made = merkle.manifest(docs_frame(spark, rows), FIELDS, tree=tree)
    text = lambda c: merkle.as_text(F.col(c)).alias(c)
    checked = made.withColumn("folded", merkle.folded(F.col("leaf"), tree))
    got = checked.select("doc_id", *[text(c) for c in ("leaf", "subroot", "root", "path", "folded")]).collect()
    assert sorted([tuple(r[:5]) for r in got], key=repr) == plain_manifest(rows, FIELDS, fanout)
    assert all(r.folded == r.root for r in got)


def test_changed_fields_lead_to_another_root(spark):
    rows = some_docs(60, seed=4)
    changed = F.when(F.col("doc_id") % 2 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    made = merkle.manifest(docs_frame(spark, rows), FIELDS, tampered={"n_chars": changed})
    got = made.withColumn("folded", merkle.folded(F.coalesce("claimed", "leaf"))).collect()
    hit = [r for r in got if r.claimed is not None]
    expected = sum(1 for r in rows if r["doc_id"] is not None and r["doc_id"] % 2 == 0 and r["n_chars"] is not None)
    assert len(hit) == expected > 0
    assert all(r.folded != r.root for r in hit)
    assert all(r.folded == r.root for r in got if r.claimed is None)


def test_paths_of_a_full_tree_span_rounds(spark):
    rows = [{"doc_id": i, "source": "s", "lang": "en", "n_chars": i, "text": "t"} for i in range(512)]
    made = merkle.manifest(docs_frame(spark, rows), FIELDS, tree=merkle.Tree(2, 3))
    got = made.agg(F.max("n"), F.min(F.octet_length("path")), F.max(F.octet_length("path"))).first()
    assert tuple(got) == (512, 9 * 32, 9 * 32)


# ---- SentencePiece --------------------------------------------------------------------------
TEXTS = [
    None, "", " ", "  ", "\n", "\n\n", " \n ", "a", " a", "a ", "a  b   c", "▁", "▁▁a", "a▁b", "a\nb", "a\n b \nc",
    "Hello, World! 123 don't", "ÄÖÜ ß é — 漢字 漢 🙂🙂 ​ x", "\t\tx\ty", "x\x00y", "</s> <s> <0x0A> <unk>",
    "w" * 3000, "ab " * 500, " " * 40 + "x" + " " * 17, "\r\n\r\n a",
]


def library_says(texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = lib.encode([t or "" for t in texts])
    return ids, lib.decode(ids)


def texts_frame(spark, texts):
    tune(spark)
    return spark.createDataFrame(
        [(i, t, 1, "c", 2) for i, t in enumerate(texts)], "n int, text string, chunk int, carried string, h1 int"
    ).repartition(3)


def random_texts(n, seed=3):
    r = random.Random(seed)
    alphabet = list("aeinrst  \n▁.é漢") + ["the", " of ", "ing", "🙂", "\t"]
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(n)]


@pytest.mark.parametrize("hot", [sentencepieces.Hot(), sentencepieces.Hot(20, 3), sentencepieces.Hot(0, 32)])
def test_ids_and_texts_are_those_of_the_library(spark, hot):
    texts = TEXTS + random_texts(150) + TEXTS
    ids, decoded = library_says(texts)
    encoded = sentencepieces.encode(texts_frame(spark, texts), MODEL, hot=hot)
    assert encoded.columns == ["n", "chunk", "carried", "h1", "ids"]
    rows = {r.n: r for r in encoded.collect()}
    assert [rows[i].ids for i in range(len(texts))] == ids
    assert all((r.chunk, r.carried, r.h1) == (1, "c", 2) for r in rows.values())
    back = {r.n: r.text for r in sentencepieces.decode(encoded, MODEL).collect()}
    assert [back[i] for i in range(len(texts))] == decoded


def test_ids_and_texts_in_one_pass(spark):
    texts = TEXTS + random_texts(40)
    ids, decoded = library_says(texts)
    got = sentencepieces.encode(texts_frame(spark, texts), MODEL, decoded=True)
    rows = {r.n: r for r in got.collect()}
    assert [(rows[i].ids, rows[i].decoded) for i in range(len(texts))] == list(zip(ids, decoded, strict=True))


def test_chunks_are_cut_where_no_piece_crosses():
    model = sentencepieces.Model(open(MODEL, "rb").read())
    chunks, first = sentencepieces.chunked(pa.array(["the cat,\n\nthe  cat", None, "", "a▁é"]), model.cuts)
    assert chunks.to_pylist() == [
        b" the", b" cat", b",", b"\n", b"\n", b"the", b"  cat", b" a", " é".encode()
    ]
    assert first.tolist() == [0, 7, 7, 7, 9]
    assert [len(i) for i in model.segment([" the", ",", "\n", " "])] == [1, 1, 1, 1]


def test_each_distinct_chunk_is_segmented_once(spark):
    model = sentencepieces.shared(spark, MODEL)
    texts = texts_frame(spark, ["the cat, the dog, the end"] * 30 + ["once"]).select("text").coalesce(1)
    named = sentencepieces.named_chunks(texts, "text", model)
    assert {bytes(r.chunk).decode(): r.n for r in named.collect()} == {
        " the": 90, " cat": 30, ",": 60, " dog": 30, " end": 30
    }
    chunks, ids = sentencepieces.hot_chunks(named, model, sentencepieces.Hot(2, 32))
    assert chunks.to_pylist() == [b" the", b","] and len(ids) == 2


def test_the_hot_chunks_keep_their_bound(spark):
    rows = [(bytes(f"c{i}", "ascii"), i // 7 + 1) for i in range(500)] + [(b"x" * 99, 10**6)]
    table = spark.createDataFrame(rows, "chunk binary, n long")
    model = sentencepieces.shared(spark, MODEL)
    for most in (0, 1, 7, 50, 1000):
        chunks, ids = sentencepieces.hot_chunks(table, model, sentencepieces.Hot(most, 32))
        assert len(chunks) == len(ids) <= most and b"x" * 99 not in chunks.to_pylist()
        assert most < 50 or len(chunks) > 0


def test_long_lists_decode_in_blocks():
    model = sentencepieces.Model(open(MODEL, "rb").read())
    assert model.cuts is not None
    for text in [" ".join(random_texts(200)), "▁▁ x " * 300, "漢字🙂" * 400, " lead", "é" * 500]:
        ids = np.array(model.library.encode(text))
        assert model.decode(ids, block=16) == model.library.decode(ids.tolist())


def test_numbers_of_seven_bits():
    given = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 28) - 1])
    data, sizes = sentencepieces.varints(given)
    numbers, starts = sentencepieces.from_varints(data)
    assert numbers.tolist() == given.tolist()
    assert np.diff(np.append(starts, len(data))).tolist() == sizes.tolist()


def test_models_that_cross_words_take_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(sentencepieces.Model, "cuts", None)
    chunks, first = sentencepieces.chunked(pa.array(["a b", None, "", "c\nd"]), None)
    assert chunks.to_pylist() == [b"a b", b"c\nd"] and first.tolist() == [0, 1, 1, 1, 2]
    model = sentencepieces.Model(open(MODEL, "rb").read())
    assert model.segment(["a b"]) == [model.library.encode("a b")]


def test_no_texts_give_no_rows(spark):
    encoded = sentencepieces.encode(texts_frame(spark, ["x"]).limit(0), MODEL)
    assert encoded.collect() == [] and sentencepieces.decode(encoded, MODEL).collect() == []


# ---- clustering -----------------------------------------------------------------------------
def plain_clusters(rows, how):
    vectors = []
    for i, v in rows:
        if v is not None and len(v) == how.dims and all(x is not None and np.isfinite(x) for x in v):
            vectors.append((i, [int(np.floor(how.scale * x)) for x in v]))
    mark = lambda i: H(f"{how.salt}:{'' if i is None else i}")
    found = [v for _, v in sorted(vectors, key=lambda r: (mark(r[0]), r[1]))[: how.k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(found))

    for _ in range(how.rounds):
        members = {}
        for _, v in vectors:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, m in members.items():
            found[n] = [sum(x) // len(m) for x in zip(*m, strict=True)]
    out = [(i, *nearest(v)[::-1]) for i, v in vectors]
    inertia = sum(r[2] for r in out)
    per = {n: sum(r[2] for r in out if r[1] == n) for n in range(how.k)}
    digest = [H(",".join(map(str, c))) for c in found]
    return sorted([(i, n, d, per[n], inertia, digest[n]) for i, n, d in out], key=repr)


def vectors_frame(spark, rows):
    tune(spark)
    return spark.createDataFrame(
        [(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string, id int"
    ).repartition(3)


@pytest.mark.parametrize("how", [Clusters(4, 5, 6), Clusters(8, 3, 2, 10, "z"), Clusters(1, 2, 3), Clusters(30, 2, 4, 1)])
def test_clusters_equal_plain_rounds(spark, how):
    r = random.Random(how.k)
    value = lambda: r.choice([r.gauss(0, 1), r.gauss(0, 1), 0.0, float(r.randrange(-2, 3))])
    rows = [(i, [value() for _ in range(how.dims)]) for i in range(200)]
    rows += [(5, [1.0] * how.dims), (None, [0.5] * how.dims), (None, [0.25] * how.dims)] + rows[:9] + rows[:9]
    odd = [None, [], [1.0] * (how.dims + 1), [float("nan")] * how.dims, [float("-inf")] * how.dims, [None] * how.dims]
    rows += [(900 + i, v) for i, v in enumerate(odd)]
    placed, found = centroids.cluster(vectors_frame(spark, rows), how=how)
    got = centroids.with_inertia(placed, found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
    assert sorted([tuple(x) for x in got.collect()], key=repr) == plain_clusters(rows, how)


def test_few_vectors_and_none(spark):
    how = Clusters(4, 2)
    placed, found = centroids.cluster(vectors_frame(spark, [(1, [0.5, 1.0])]), how=how)
    assert len(found) == 1 and [tuple(r) for r in placed.collect()] == [(1, 0, 0)]
    placed, found = centroids.cluster(vectors_frame(spark, [(1, [0.5])]), how=how)
    assert centroids.with_inertia(placed, found).collect() == []


@pytest.mark.parametrize("scale", [1, 1000, 1 << 27])
def test_search_finds_the_nearest_and_skips_distances(scale):
    r = np.random.default_rng(scale)
    spots = r.integers(-scale, scale + 1, (40, 64))
    spots[7] = spots[3]
    given = np.concatenate([r.integers(-scale, scale + 1, (300, 64)), spots, spots + r.integers(-1, 2, spots.shape)])
    given[:40] += np.arange(-20, 20)[:, None] * scale // 8 if scale < 1 << 27 else 0
    distance = np.stack([((given - c).astype(object) ** 2).sum(axis=1) for c in spots], axis=1)
    want = [(min(range(40), key=lambda n: (row[n], n)), min(row)) for row in distance.tolist()]
    found, best, computed = Search(spots).nearest(given)
    assert list(zip(found.tolist(), best.tolist(), strict=True)) == want
    assert computed < given.shape[0] * 40 or scale == 1
