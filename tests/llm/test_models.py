"""Quality rules, classifier and language models: brute force, round trips and held-out accuracy."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from lakestead.llm import language_id, quality_cnn, queries
from lakestead.llm.common import tune
from lakestead.llm.language_id import Models, Tables, identify, normalise
from lakestead.llm.quality_cnn import Network, classify, lay_out, probabilities, start_weights
from lakestead.llm.quality_rules import Rules, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.01"


def brute_quality(rows, trusted, rules):
    """Counts, score in millionths, verdicts; the same arithmetic with dictionaries."""
    h = lambda x, seed=42: xxhash.xxh64(x.encode(), seed=seed).intdigest()

    def grams(words):
        pairs = [h(b, h(a)) for a, b in zip(words, words[1:], strict=False)]
        return [x % rules.buckets for x in [h(w) for w in words] + pairs]

    words = [WORD.findall(t or "") for _, t in rows]
    corpus, target = Counter(), Counter()
    for (i, _), w in zip(rows, words, strict=True):
        corpus.update(grams(w))
        if i in trusted:
            target.update(grams(w))
    n, m = corpus.total() + rules.buckets, target.total() + rules.buckets
    ratio = lambda b: round(math.log(((target[b] + 1) / m) / ((corpus[b] + 1) / n)) * 1e6)
    out = {}
    for (i, t), w in zip(rows, words, strict=True):
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(k, k + 3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        total = sum(map(ratio, grams(w))) if target else 0
        failed = len(w) < rules.min_words or 100 * len(covered) > rules.max_repeat_percent * len(w)
        out[i] = (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
            len(covered), failed, not failed and total >= rules.min_score * max(2 * len(w) - 1, 0),
        )
    return out


def some_rows():
    r = random.Random(2)
    rows = [(1, None), (2, ""), (3, "one"), (4, "a b a b a b a b"), (5, "x\n\n x\nx\n#*"), (6, " " * 5 + "\x1fé")]
    rows.append((7, " ".join(r.choice(["q", "r", "s", "tt"]) for _ in range(20000))))
    for i in range(10, 60):
        junk = "$$" if i % 5 == 0 else ""
        rows.append((i, " ".join(f"w{r.randrange(90)}{junk}" for _ in range(r.randrange(90))) + "\nend\nend"))
    return rows


@pytest.mark.parametrize("trusted", [[11, 12, 13, 14, 16, 17, 18, 21], [], [1, 999]])
def test_quality_rules(spark, trusted):
    tune(spark)
    rules = Rules(min_words=6, buckets=512)
    schema = "doc_id long, text string, model int, judged string, trusted_id int"
    docs = spark.createDataFrame([(i, t, 1, "j", 5) for i, t in some_rows()], schema)
    ids = spark.createDataFrame([(i,) for i in trusted + trusted[:1]], "good long")
    got = quality_rules(docs, ids, rules=rules)
    assert {"model", "judged", "trusted_id"} <= set(got.columns)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert {r.doc_id: tuple(r[n] for n in names) for r in got.collect()} == brute_quality(some_rows(), trusted, rules)
    assert quality_rules(docs.limit(0), ids, rules=rules).count() == 0


def test_quality_rules_separate_labels(spark):
    judged = queries.op6_quality_rules(spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = judged.join(labels, "doc_id").filter("not base_failed").select("quality", "kept").collect()
    good, bad = ([r.kept for r in found if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.2


def test_filters_cover_every_byte_and_no_other_document():
    """A document's probability does not depend on its neighbours, and every byte can change it."""
    net = Network(width=8, stride=4, chunk=32, filters=64)
    w = start_weights(net)
    texts = ["a" * 50, None, "", "é" * 333, "b"]
    together = probabilities(w, pa.array(texts, pa.string()), net)
    alone = [probabilities(w, pa.array([t], pa.string()), net)[0] for t in texts]
    np.testing.assert_allclose(together, alone, rtol=1e-5)
    small = probabilities(w, pa.array(texts * 9, pa.string()), Network(**(vars(net) | {"block": 64})))
    np.testing.assert_allclose(small, np.tile(together, 9), rtol=1e-5)
    laid, begins = lay_out(np.arange(1, 51, dtype=np.uint8), np.array([0, 20, 20, 50]), net)
    assert sorted(laid[laid > 0].tolist()) == list(range(1, 51)) and len(laid) == begins[-1] * net.half
    assert (np.diff(begins) >= 2).all()


def plain_probability(w, text, net):
    """The network for one document, place by place."""
    data = list((text or "").encode())
    n_halves = max(-(-(len(data) + net.width) // net.half), 2)
    padded = data + [0] * (n_halves * net.half - len(data))
    halves = np.zeros((n_halves, net.filters))
    for at in range(0, len(padded), net.stride):
        seen = padded[at : at + net.width]
        if len(seen) == net.width:
            x = np.concatenate([w["bytes"][b] for b in seen]).astype(np.float64)
            response = np.maximum(x @ w["filters"] + w["filter_bias"], 0)
            halves[at // net.half] = np.maximum(halves[at // net.half], response)
    chunks = np.maximum(halves[:-1], halves[1:])
    length = math.log1p(len(data)) / 5 - 1
    pooled = np.concatenate([chunks.max(axis=0), chunks.mean(axis=0), chunks.min(axis=0), [length]])
    hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
    return 1 / (1 + math.exp(-(hidden @ w["out"] + w["out_bias"][0])))


@pytest.mark.parametrize("block", [1, 64, 1 << 20])
def test_probabilities_equal_a_plain_network(block):
    net = Network(width=8, stride=4, chunk=32, filters=5, depth=3, hidden=4, block=block)
    w = start_weights(net)
    r = random.Random(2)
    texts = ["".join(r.choice("abc é漢") for _ in range(n)) for n in (0, 1, 7, 8, 15, 16, 17, 40, 333, 1000)] + [None]
    got = probabilities(w, pa.array(texts, pa.string()), net)
    np.testing.assert_allclose(got, [plain_probability(w, t, net) for t in texts], rtol=1e-4)


def test_a_very_long_text_takes_a_few_bytes_per_byte():
    net, size = Network(), 32 << 20
    w, texts = start_weights(net), pa.array(["lorem ipsum " * (size // 12)])
    tracemalloc.start()
    try:
        assert 0 <= probabilities(w, texts, net)[0] <= 1
        assert tracemalloc.get_traced_memory()[1] < 7 * size
    finally:
        tracemalloc.stop()


def test_gradients():
    """Against differences of the loss."""
    net = Network(depth=3, width=8, stride=4, chunk=32, filters=5, hidden=4)
    w = {k: v.astype(np.float64) for k, v in start_weights(net).items()}
    texts, y = ["some text of a document " * 3, "zz", "an other ÄÖ one, longer " * 9], np.array([1.0, 0.0, 1.0])
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    laid, begins = lay_out(np.concatenate(data), offsets, net)
    lengths = np.diff(offsets)

    def loss():
        top = quality_cnn._responses(w, laid, begins, net).max(axis=1)
        p = quality_cnn._head(w, quality_cnn._pool(top, begins, lengths)[0])[1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality_cnn._gradients(w, laid, begins, lengths, y, net)
    draw = np.random.default_rng(1)
    for name, g in grads.items():
        for _ in range(6):
            at = tuple(draw.integers(0, n) for n in g.shape)
            keep, step = w[name][at], 1e-4
            w[name][at] = keep + step
            up = loss()
            w[name][at] = keep - step
            down = loss()
            w[name][at] = keep
            assert abs((up - down) / (2 * step) - g[at]) < 2e-4, name


def test_classifier_on_held_out_labels(spark):
    scored = queries.op1_quality_cnn(spark, DATA)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    found = scored.collect()
    assert len(found) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(labels[r.doc_id], r.score) for r in found if r.held_out and r.doc_id in labels]
    good, bad = ([s for y, s in held if y == q] for q in (1, 0))
    wins = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert wins > 0.85


def test_classifier_odd_cases(spark):
    tune(spark)
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "x" * 9000, 0.5)], "doc_id long, text string, score double")
    for labels, want in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, None), (None, 0)], 0.5)):
        given = spark.createDataFrame(labels, "doc_id long, quality int")
        assert [r.score for r in classify(docs, given).collect()] == [want] * 3
    given = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in classify(docs, given).collect())
    assert classify(docs.limit(0), given).count() == 0


def test_normalise():
    text, begins, letters = normalise(["Ab-- c1D", None, "  x", "ß\U00010400.", ""], 4)
    parts = ["".join(map(chr, text[a:b])) for a, b in zip(begins, begins[1:], strict=False)]
    assert parts[:3] == ["   ab c d ", "   ", "   x "] and parts[4] == "   "
    assert len(parts[3]) == 6 and letters.tolist() == [4, 0, 1, 2, 0]


def brute_kneser_ney(texts, order):
    """Probability of a character after a context, by the textbook recursion."""
    def grams(text):
        chars, _, _ = normalise([text], order)
        return [tuple(chars[i : i + order].tolist()) for i in range(len(chars) - order + 1)]

    tables = {order: Counter(g for t in texts for g in grams(t))}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def discount(n):
        counts = Counter(tables[n].values())
        return counts[1] / (counts[1] + 2 * counts[2]) if counts[1] and counts[2] else 0.5

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / (1 << 16)
        mine = {g: c for g, c in tables[n].items() if g[:-1] == gram[:-1]}
        if not mine:
            return p(gram[1:])
        total, d = sum(mine.values()), discount(n)
        return max(mine.get(gram, 0) - d, 0) / total + d * len(mine) / total * p(gram[1:])

    return p, grams


def test_language_tables_are_kneser_ney():
    order = 3
    texts = {"aa": ["banana bandana", "an abbab"], "bb": ["xyzzy banana", "zyx"]}
    counts, brute = {}, {}
    for lang, some in texts.items():
        brute[lang] = brute_kneser_ney(some, order)
        found = Counter(g for t in some for g in brute[lang][1](t))
        packed = {sum(c << 16 * (order - 1 - k) for k, c in enumerate(g)): n for g, n in found.items()}
        keys = sorted(packed)
        counts[lang] = (np.array(keys, np.uint64), np.array([packed[k] for k in keys]))
    tables = Tables(["aa", "bb"], counts, order)
    for text in ["banana", "zany bab", "x"]:
        nats, n, _ = tables.cross_entropies([text])
        for k, lang in enumerate(["aa", "bb"]):
            p, grams = brute[lang]
            want = -np.mean([math.log(p(g)) for g in grams(text)])
            assert n[0] == len(grams(text)) and abs(nats[0, k] - want) < 1e-4


def packed_counts(texts, order):
    chars, begins, _ = normalise(texts, order)
    grams, n = np.unique(language_id._grams(chars, begins, order)[0], return_counts=True)
    return grams, n


@pytest.mark.parametrize("order", [1, 2, 4])
def test_blocks_of_a_text_are_the_whole(order):
    r = random.Random(order)
    for _ in range(200):
        text = "".join(r.choice("ab é\U00010400-. ") for _ in range(r.randrange(1, 40)))
        chars, begins, letters = normalise([text], order)
        whole = language_id._grams(chars, begins, order)[0].tolist()
        for block in (1, 2, 3, 7, 100):
            parts = list(language_id.blocks(text, order, block))
            assert [g for part, _ in parts for g in part.tolist()] == whole
            assert sum(n for _, n in parts) == letters[0]


def test_long_texts_score_as_in_one_piece():
    tables = Tables(["aa", "bb"], {"aa": packed_counts(["banana bandana"], 3), "bb": packed_counts(["xyzzy zany"], 3)}, 3)
    texts = ["banana " * 50, None, "zany xyz-" * 40, "", "é" * 300]
    whole, pieces = tables.cross_entropies(texts), tables.cross_entropies(texts, block=17)
    for a, b in zip(whole, pieces, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-6)


def test_many_languages_keep_the_bound():
    models, r = Models(table_bytes=1 << 20), random.Random(4)
    langs = [f"l{i:03}" for i in range(200)]
    counts = {}
    for lang in langs:
        own = "".join(r.sample("abcdefghijklmnopqrstuvwxyz", 9))
        counts[lang] = packed_counts(["".join(r.choice(own + " ") for _ in range(4000))], models.order)
    most = models.grams_per_lang(len(langs))
    kept = {}
    for lang, (grams, n) in counts.items():
        some = np.sort(np.argsort(-n, kind="stable")[:most])
        kept[lang] = grams[some], n[some]
    tables = Tables(langs, kept, models.order)
    assert sum(m.size() for m in tables.models) <= models.table_bytes
    assert sum(m.size() for m in Tables(langs, counts, models.order).models) > models.table_bytes


def test_language_ties_copies_and_clashing_columns(spark):
    tune(spark)
    schema = "doc_id long, text string, lang string, score double, accepted int"
    labelled = spark.createDataFrame([(1, "abab abab", "bb"), (2, "abab abab", "aa")], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(5, "abab", "x", 9.0, 7)] * 3 + [(None, "abab", None, 1.0, 1)], schema)
    got = identify(docs, labelled).collect()
    assert {(r.doc_id, r.lang) for r in got} == {(5, "aa"), (None, "aa")} and len(got) == 4
    assert len({r.score for r in got}) == 1


def test_language_on_held_out_documents(spark):
    found = queries.op10_language_id(spark, DATA)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score", "accepted"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    rows = found.collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in rows if r.held_out]) > 0.97
    assert np.mean([r.accepted for r in rows]) > 0.9
    assert not any(r.accepted for r in rows if r.lang_pred == "und")


def test_language_odd_cases(spark):
    tune(spark)
    docs = spark.createDataFrame([(1, None), (2, "12 $$"), (None, "abc"), (4, "漢字 \U00020000")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None, "en"), (None, "x", "en"), (3, "x", None)], "id long, text string, lang string")
    assert {(r.lang, r.score, r.accepted) for r in identify(docs, none).collect()} == {("und", 0.0, False)}
    some = spark.createDataFrame([(1, "abc abd abe", "l1"), (2, "xyz xxy zyx", "l2")], "id long, text string, lang string")
    got = {r.doc_id: r.lang for r in identify(docs, some, models=Models(order=3)).collect()}
    assert got[1] == got[2] == "und" and got[None] == "l1" and got[4] in ("l1", "l2")
    assert identify(docs.limit(0), some).count() == 0
    assert language_id.UNKNOWN == "und"
