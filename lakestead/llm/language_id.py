"""Language identification with interpolated Kneser-Ney character models.

Texts become lower-case letters with one blank for every run of other characters. A bounded sample of
labelled documents per language (``docs_per_lang``, whole texts, chosen by a hash of the id) gives the
counts of character n-grams, added up by Spark. Four fifths of it make the models; the rest calibrates
the rejection: a text whose cross-entropy is above ``reject_quantile`` of its language's calibration
texts, plus ``reject_margin``, is not accepted.

Each language has a table per order: sorted 64-bit hashes of its n-grams, with the log probability and the weight of
the n-gram as a context. The different n-grams of a batch cost one binary search per language, and more only where an n-gram
is new to it. The prediction is the language of least cross-entropy per character over the whole text.

All tables together take ``table_bytes`` at most: where the languages have more n-grams, each keeps its most
frequent ones. They go to the tasks as a broadcast value. Scoring is one pass without a shuffle; texts of more
than ``block`` characters are scored block by block.

Defined cases: a null text, or one without a letter, is `und` with score 0. With no labelled row every text is `und`.
Equal cross-entropies go to the first language by name. Rows without an id are scored, not learned from.
Repeated rows and extra columns make no difference.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestead.llm.arrays import mix, pieces, signed
from lakestead.llm.common import written

UNKNOWN = "und"


@dataclass(frozen=True)
class Models:
    order: int = 4
    docs_per_lang: int = 400
    reject_quantile: float = 0.99
    reject_margin: float = 0.5
    #: Characters of evidence that the score counts at most.
    score_chars: int = 50
    #: Bound of the tables of all languages.
    table_bytes: int = 64 << 20
    block: int = 1 << 18

    def grams_per_lang(self, langs: int) -> int:
        """An n-gram has at most one entry per order, and one as a context there; an entry takes 16 bytes."""
        return max(self.table_bytes // (max(langs, 1) * self.order * 2 * 16), 1)


def _letters() -> np.ndarray:
    """For each code point below 65536 the lower-case letter, or a blank."""
    out = np.full(1 << 16, ord(" "), np.uint16)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
    return out


_LETTERS: list[np.ndarray] = []


def normalise(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and blanks of all texts, each led by order - 1 blanks and ended by one; where each begins
    (and the last ends); letters per text. Letters beyond 16 bits are folded into them."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    pad = " " * (order - 1)
    lengths = np.array([len(t or "") for t in texts], np.int64) + order
    joined = "".join(f"{pad}{t or ''} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    beyond = np.flatnonzero(codes > 0xFFFF)
    out = _LETTERS[0][np.minimum(codes, 0xFFFF)]
    for i in beyond.tolist():
        out[i] = (codes[i] & 0x7FFF) | 0x8000 if chr(codes[i]).isalpha() else ord(" ")
    begins = np.concatenate([[0], np.cumsum(lengths)])
    letter = out != ord(" ")
    letters = np.add.reduceat(letter, begins[:-1]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank of a run
    for k in range(order - 1):
        keep[begins[:-1] + k] = True
    # A blank right after the leading ones would lengthen them.
    after = begins[:-1] + order - 1
    keep[after[~letter[after]]] = False
    upto = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], upto[begins], letters


def _grams(chars: np.ndarray, begins: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams that end at each predicted character, the rows' begins among them, and the lengths."""
    wide = chars.astype(np.uint64)
    n = len(wide) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(begins), np.int64), np.zeros(max(len(begins) - 1, 0), np.int64)
    packed = np.zeros(n, np.uint64)
    for k in range(order):
        packed = (packed << np.uint64(16)) | wide[k : k + n]
    counts = np.maximum(np.diff(begins) - order + 1, 0)
    first = np.repeat(begins[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return packed[first + np.arange(counts.sum())], np.concatenate([[0], np.cumsum(counts)]), counts


def _low(packed: np.ndarray, n: int) -> np.ndarray:
    """The last n characters."""
    return packed & np.uint64((1 << 16 * n) - 1) if n < 4 else packed


def gram_counts(sample: DataFrame, models: Models) -> DataFrame:
    """(lang, gram, n) of sample(lang, text): packed n-grams of the highest order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), object)
            chars, begins, _ = normalise(batch.column("text").to_pylist(), models.order)
            packed, _, counts = _grams(chars, begins, models.order)
            of = np.repeat(langs, counts)
            for lang in sorted(set(langs)):
                grams, n = np.unique(packed[of == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(signed(grams)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    counted = sample.select("lang", "text").mapInArrow(work, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _adjusted(grams: np.ndarray, counts: np.ndarray, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of the highest order; below it the number of different characters in front."""
    out = {order: (grams, counts)}
    for n in range(order - 1, 0, -1):
        out[n] = np.unique(_low(out[n + 1][0], n), return_counts=True)
    return out


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def _by_context(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts, the context of each gram, and per context the total count and the weight of the order below."""
    contexts, of = np.unique(grams >> np.uint64(16), return_inverse=True)
    total = np.bincount(of, counts)
    return contexts, of, total, _discount(counts) * np.bincount(of) / total


FLOOR = np.log(1.0 / (1 << 16))


class Language:
    """The model of one language. Per order: keys (sorted hashes), logp and back-off weight, as logarithms."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, chars: np.ndarray):
        """grams are sorted; chars are the characters of all languages."""
        self.keys: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.back: list[np.ndarray] = []
        tables = _adjusted(grams, counts, order)
        for n in range(1, order + 1):
            own, of_own = tables[n]
            contexts, of, total, weight = _by_context(own, of_own)
            # Contexts of the order above may be new here; they have an entry for their weight.
            above = _by_context(*tables[n + 1]) if n < order else (np.zeros(0, np.uint64),) * 4
            entries = np.union1d(own, above[0])
            lower = self.values(_low(entries, n - 1), n - 1) if n > 1 else np.full(len(entries), FLOOR)
            ctx = entries >> np.uint64(16)
            where = np.minimum(np.searchsorted(contexts, ctx), len(contexts) - 1)
            logp = np.where(contexts[where] == ctx, np.log(weight[where]), 0.0) + lower
            at = np.searchsorted(entries, own)
            seen = np.maximum(of_own - _discount(of_own), 0) / total[of] + weight[of] * np.exp(lower[at])
            logp[at] = np.log(seen)
            back = np.zeros(len(entries))
            back[np.searchsorted(entries, above[0])] = np.log(above[3].astype(np.float64))
            hashed = mix(entries + np.uint64(n))
            by = np.argsort(hashed)
            self.keys.append(hashed[by])
            self.logp.append(logp[by].astype(np.float32))
            self.back.append(back[by].astype(np.float32))
            if n == 1:
                # A character of other languages is one that was not seen; one of none costs a nat more than any.
                self.others = np.setdiff1d(chars, own)
                self.unseen = np.float32(np.log(weight[0]) + FLOOR)
                least = self.logp[0].min()
                self.strange = (min(least, self.unseen) if len(self.others) else least) - np.float32(1.0)

    def _find(self, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        keys, hashed = self.keys[n - 1], mix(grams + np.uint64(n))
        at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
        return at, keys[at] == hashed

    def values(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Log probability of the last character of each gram after the others."""
        at, found = self._find(grams, n)
        out = self.logp[n - 1][at].astype(np.float64)
        new = np.flatnonzero(~found)
        if len(new):
            missing = grams[new]
            if n == 1:
                out[new] = np.where(np.isin(missing, self.others), self.unseen, self.strange)
            else:
                context, known = self._find(missing >> np.uint64(16), n - 1)
                out[new] = np.where(known, self.back[n - 2][context], 0.0) + self.values(_low(missing, n - 1), n - 1)
        return out

    def size(self) -> int:
        return sum(a.nbytes for a in (*self.keys, *self.logp, *self.back))


class Tables:
    """The models of all languages, and the cross-entropy above which each rejects a text."""

    def __init__(self, langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int):
        self.langs, self.order = langs, order
        self.limits = np.full(len(langs), np.inf)
        chars = np.unique(np.concatenate([_low(counts[lang][0], 1) for lang in langs]))
        self.models = [Language(*counts[lang], order, chars) for lang in langs]

    def _sums(self, packed: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log probabilities added up from each start to the next, one column per language."""
        grams, of = np.unique(packed, return_inverse=True)
        return np.stack([np.add.reduceat(m.values(grams, self.order)[of], starts) for m in self.models], axis=1)

    def cross_entropies(
        self, texts: list[str | None], block: int = 1 << 18
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nats per character for each text and language; characters; letters."""
        out = np.zeros((len(texts), len(self.langs)))
        counts, letters = np.zeros((2, len(texts)), np.int64)
        long = [i for i, t in enumerate(texts) if t and len(t) > block]
        chars, begins, letters[:] = normalise([None if i in set(long) else t for i, t in enumerate(texts)], self.order)
        packed, rows, counts[:] = _grams(chars, begins, self.order)
        full = np.flatnonzero(counts > 0)
        if len(full):
            out[full] = -self._sums(packed, rows[full])
        for i in long:
            for part, found in blocks(texts[i], self.order, block):
                letters[i] += found
                counts[i] += len(part)
                if len(part):
                    out[i] -= self._sums(part, np.zeros(1, np.int64))[0]
        return out / np.maximum(counts, 1)[:, None], counts, letters


def blocks(text: str, order: int, block: int) -> Iterator[tuple[np.ndarray, int]]:
    """The packed n-grams of one text, and its letters, a block of characters at a time; the same as of the whole."""
    blank = np.full(1, ord(" "), np.uint16)
    tail = np.repeat(blank, max(order - 1, 1))
    for start in range(0, len(text), block):
        part = text[start : start + block]
        some, _, letters = normalise([part], 1)  # without a blank in front, and with one behind
        goes_on = start + block < len(text) and part[-1].isalpha()
        some = some[:-1] if goes_on and len(some) else some
        if tail[-1] != blank[0] and not part[0].isalpha():
            some = np.concatenate([blank, some])
        joined = np.concatenate([tail[len(tail) - order + 1 :], some])
        yield _grams(joined, np.array([0, len(joined)]), order)[0], int(letters[0])
        tail = np.concatenate([tail, some])[-max(order - 1, 1) :]


def _sample(labelled: DataFrame, models: Models) -> DataFrame:
    """(lang, text, part) of labelled(id, text, lang): at most docs_per_lang rows of each language."""
    named = labelled.filter("lang is not null and text is not null and id is not null")
    named = named.withColumn("h", F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(1 << 40)))
    sizes = written(named.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    near = named.join(sizes, "lang").filter(
        F.col("h") < F.lit(float(1 << 40)) * F.lit(2.0 * models.docs_per_lang + 20) / F.col("rows")
    )
    first = Window.partitionBy("lang").orderBy("h", "id")
    taken = near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= models.docs_per_lang)
    return taken.select("lang", "text", (F.col("place") % 5 == 0).alias("calibrate"))


def learn(labelled: DataFrame, models: Models = Models()) -> Tables | None:  # noqa: B008
    """The models, from labelled(id, text, lang)."""
    sample = written(_sample(labelled, models), "language_sample")
    counts = written(gram_counts(sample.filter("not calibrate"), models), "gram_counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    # The most frequent of each language, so many that all tables keep their bound.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = counts.withColumn("place", place).filter(F.col("place") <= models.grams_per_lang(len(langs)))
    counted = kept.drop("place").toArrow()
    names = np.array(counted["lang"].to_pylist(), object)
    grams, n = counted["gram"].to_numpy().astype(np.int64).view(np.uint64), counted["n"].to_numpy()
    counts = {}
    for lang in langs:
        mine = np.flatnonzero(names == lang)
        mine = mine[np.argsort(grams[mine])]
        counts[lang] = (grams[mine], n[mine])
    tables = Tables(langs, counts, models.order)
    held = score(sample.filter("calibrate").select("lang", "text"), tables, models, "lang")
    for row in (
        held.filter("lang = key")
        .groupBy("lang")
        .agg(F.percentile("cross_entropy", models.reject_quantile).alias("limit"))
        .collect()
    ):
        tables.limits[langs.index(row["lang"])] = row["limit"] + models.reject_margin
    return tables


def score(texts: DataFrame, tables: Tables | None, models: Models, key: str) -> DataFrame:
    """(key, lang, accepted, score, cross_entropy) of texts(key, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(tables)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 20):
            found = shared.value
            rows = batch.column("text").to_pylist()
            if found is None:
                known, best, lang = np.zeros(len(rows), bool), np.zeros(len(rows)), [UNKNOWN] * len(rows)
                accepted, sure = known, best
            else:
                nats, counts, letters = found.cross_entropies(rows, models.block)
                known, pick = letters > 0, nats.argmin(axis=1)
                best = np.where(known, nats.min(axis=1), 0.0)
                evidence = np.minimum(counts, models.score_chars)[:, None]
                sure = np.where(known, 1 / np.exp(-(nats - nats.min(axis=1)[:, None]) * evidence).sum(axis=1), 0.0)
                accepted = known & (best <= found.limits[pick])
                lang = [found.langs[p] if k else UNKNOWN for p, k in zip(pick, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(lang, pa.string()), pa.array(accepted), pa.array(sure), pa.array(best)],
                names=["key", "lang", "accepted", "score", "cross_entropy"],
            )

    kind = dict(texts.dtypes)[key]
    return texts.select(F.col(key).alias("key"), "text").mapInArrow(
        work, f"key {kind}, lang string, accepted boolean, score double, cross_entropy double"
    )


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    models: Models = Models(),  # noqa: B008
) -> DataFrame:
    """(id, lang, accepted, score, cross_entropy) per row of docs. labelled: id, text, lang."""
    tables = learn(labelled.toDF("id", "text", "lang"), models)
    slim = docs.select(F.col(id_col), F.col(text).alias("text"))
    return score(slim, tables, models, id_col).withColumnRenamed("key", id_col)
